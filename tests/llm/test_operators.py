"""The ten operators against brute force, round trips and held-out accuracy, and on odd input."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from noteflow.llm import bytenet, embedding_dedup, exact_dedup, language, licenses, mixing, near_dedup, packing, quality, sharding, token_counts, tokens
from noteflow.llm import shingles as S

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, _d string, rid int"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not mounted")


def odd_texts():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    long = " ".join(word() for _ in range(9000))
    texts = ["", None, " \t\n", "a", "a b", "A b", "a  b\n", "ab", "x y", "1234 !?", long, long + " tail", long.replace(" ", "  "), "日本語 テキスト", "'s it's ''ll"]
    for _ in range(25):
        base = [word() for _ in range(rng.randint(5, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    return texts + ["same text in many rows of five words"] * 70


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns whose names clash."""
    rows = []
    for k, t in enumerate(odd_texts()):
        rows.append((k if k % 17 else None, t, [None, "en", "de"][k % 3], [None, "b", "a", "c"][k % 4] if k % 5 else "b", 1, False, 0.5, "x", 3))
    rows += [rows[20], rows[20], rows[3], (7, "another text for id seven", "en", "a", 1, True, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def squeeze(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


@pytest.mark.parametrize("chars,bits", [(2048, 64), (3, 64), (5, 4)])
def test_exact_dedup(odd, chars, bits):
    rows = odd.collect()
    got = exact_dedup.exact_dedup(odd, block_chars=chars, address_bits=bits).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[squeeze(r.text)].append((-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
    want = Counter()
    for r in rows:
        g = groups[squeeze(r.text)]
        best = min(g)
        want[(r.doc_id, None if best[1] else best[2], len(g), hashlib.sha256(squeeze(r.text).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter({hashlib.sha256(x.encode()).hexdigest(): 1 for x in groups})
    # Identity and text agree one to one.
    assert len({(r.level, r.name) for r in got}) == len(groups)


def test_exact_dedup_rows(odd):
    kept = exact_dedup.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted(squeeze(r.text) for r in kept.collect()) == sorted({squeeze(r.text) for r in odd.collect()})


def near_brute(rows, t=0.8):
    sets = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    n, links, root = len(rows), Counter(), list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= t:
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    classes = defaultdict(list)
    for k in range(n):
        classes[find(k)].append((rows[k].doc_id is None, rows[k].doc_id or 0))
    name = lambda k: None if min(classes[find(k)])[0] else min(classes[find(k)])[1]
    return Counter((rows[k].doc_id, name(k), links[k]) for k in range(n)), len(classes)


@pytest.mark.parametrize("listed,block", [(48, 512), (3, 2), (3, 16)])
def test_near_duplicates(odd, listed, block):
    got = near_dedup.near_duplicates(odd, listed=listed, block=block).collect()
    want, classes = near_brute(odd.collect())
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == want
    assert sum(r.kept for r in got) == classes


def test_near_dedup_rows(odd):
    kept = near_dedup.keep_first(odd)
    assert kept.columns == odd.columns
    assert kept.count() <= near_brute(odd.collect())[1]


def test_pruning_rule():
    rule = S.least_matches(0.8, 1e-9)
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 32, (4000, S.VALUES), dtype=np.uint32)
    for chance, low, high in ((0.8, 1.0, 1.0), (0.2, 0.0, 0.001)):
        b = np.where(rng.random(a.shape) < chance, a, a + 1)
        assert low <= len(S.survivors(a, b, rule)) / len(a) <= high


@needs_tables
def test_quality_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for k, r in got.items())
    held = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert np.mean([p == q for p, q in held]) >= 0.9
    assert np.mean([p for p, q in held if q == 1]) >= 0.95


def test_quality_odd(spark, odd, none):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(1, 60)] + [(None, 1, 0), (5, 0, 0), (8, None, 0), (9, 7, 0)], "doc_id long, quality int, toxic int")
    assert quality.classify(odd, labels).count() == odd.count()
    assert quality.classify(none, labels).count() == 0
    one = quality.classify(odd, labels.filter("quality = 1")).select("score").distinct().collect()
    assert len(one) == 1
    assert quality.accepted(odd, 1.0).columns == odd.columns


@needs_tables
def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = language.identify(docs).collect()
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in got if r.held_out]) >= 0.95


def test_language_odd(odd, none):
    got = language.identify(odd).collect()
    assert len(got) == odd.count()
    assert Counter(r.lang_pred == "und" for r in got)[True] == sum(not re.search(r"[^\W\d_]", r.text or "") for r in odd.collect())
    assert language.identify(none).count() == 0
    assert {r.lang_pred for r in language.identify(odd.drop("lang").selectExpr("*", "CAST(NULL AS STRING) AS lang")).collect()} == {"und"}


def test_windows_cover_texts():
    f = bytenet.Filters(64, 4, 2, ((2, 3), (5, 3)))
    for n in (0, 1, 63, 64, 65, 48, 49, 500):
        rows, starts = f.cut(np.array([n, 0, n]))
        mine = starts[rows == 0]
        assert mine[0] == 0 and mine[-1] + f.window >= n and (len(mine) == 1 or mine[-2] + f.window < n)
        assert (np.diff(mine) == f.step).all() and (rows == 1).sum() == 1


def test_network_gradients():
    f, rng = bytenet.Filters(32, 2, 3, ((1, 2), (3, 2))), np.random.default_rng(1)
    for p in f.parameters():
        p.resize(p.shape)
    f.embed, f.weights, f.bias = (p.astype(np.float64) for p in f.parameters())
    x, slope = rng.integers(1, 255, (5, 32)).astype(np.uint8), rng.normal(size=(5, 4))
    _, kept = f.learn(x)
    for p, g in zip(f.parameters(), f.gradients(kept, slope)):
        at = tuple(rng.integers(0, s) for s in p.shape) if p is not f.embed else (int(x[0, 0]), 1)
        p[at] += 1e-6
        up = (f.features(x) * slope).sum()
        p[at] -= 2e-6
        down = (f.features(x) * slope).sum()
        p[at] += 1e-6
        assert (up - down) / 2e-6 == pytest.approx(g[at], abs=1e-4)


def test_sharding(odd, none):
    got, n = sharding.assign(odd).collect(), odd.count()
    counts = Counter(r.shard for r in got)
    assert len(got) == n and max(counts.values()) - min(counts.values()) <= 1 and set(counts) <= set(range(8))
    for s, c in counts.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(c))
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in odd.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    again = sharding.assign(odd.repartition(3)).collect()
    assert sorted((r.text_crc32, r.size, r.shard, r.slot) for r in again) == sorted((r.text_crc32, r.size, r.shard, r.slot) for r in got)
    assert sharding.assign(none).count() == 0


def test_ring_by_hand():
    counts = {c: (c * 7) % 5 for c in range(64)}
    nodes = sharding.ring(3, 4, 6)
    owner = lambda cell: next((s for c, s in nodes if c >= cell), nodes[0][1])
    total = sum(counts.values())
    room = {s: total // 3 + (s < total % 3) for s in range(3)}
    plain, late = Counter(), []
    for cell in range(64):
        for _ in range(counts[cell]):
            s = owner(cell)
            if plain[s] < room[s]:
                plain[s] += 1
            else:
                late.append(cell)
    moved = sum(hi - lo for c, lo, hi, s, _ in sharding.segments(counts, 3, 4, 6) if s != owner(c))
    assert moved == len(late)


def test_licences(spark, none):
    lines = {
        "Licensed under the Apache License, Version 2.0.": "apache-2.0", "Released under the MIT License.": "mit", "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0", "Distributed under the Zeta Shared License, version 4.": "unknown",
    }
    rng = random.Random(1)
    plain = [" ".join("".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 8))) for _ in range(60)) for _ in range(300)]
    rows = [(k, "\n".join([p, "", line, p[:40]]) if line else p) for k, (p, line) in enumerate(zip(plain, list(lines) * 40 + [""] * 100))]
    docs = spark.createDataFrame([*rows, (None, None), (5, ""), (5, "  \n\n")], "doc_id long, text string").selectExpr("*", "1 AS family", "2 AS words", "3 AS features")
    got = {(r.doc_id, r.place): r for r in licenses.scan(docs).collect()}
    for k, text in rows:
        line = list(lines)[k % 5] if k < 200 else None
        if line:
            assert (k, 2) in got and got[(k, 2)].family == lines[line], line
            assert got[(k, 2)].confirmed == (lines[line] != "unknown")
    assert not [g for g in got.values() if g.confirmed and g.place != 2]
    assert licenses.scan(none).count() == 0


def fuzz_texts():
    rng = random.Random(2)
    alphabet = "ab 'stmdrevl  \n\t\r1２½é!?,_-  ͅ中😀ŝ'’"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    return texts + ["", "'s", "it's", "we'll've", "''s", " 's", "\n's", "x'", "'", "<|endoftext|> a", "word " * 3000]


@pytest.mark.parametrize("remembered,batch", [(500_000, 1 << 21), (300, 200), (40, 5000)])
def test_token_ids(monkeypatch, remembered, batch):
    import public_tokenizers

    monkeypatch.setattr(tokens, "MOST_PIECES", remembered)
    monkeypatch.setattr(tokens, "BATCH_CHARS", batch)
    coder, texts = tokens.ByteCoder(public_tokenizers.path("byte_bpe_50k.json")), fuzz_texts()
    want = [e.ids for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in coder.encode(texts)] == want


def reference_ids(rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([r.text or "" for r in rows], add_special_tokens=False)]


@pytest.mark.parametrize("block", [1 << 20, 3000])
def test_packing(odd, none, block):
    pieces = packing.pack_documents(odd, block_tokens=block).collect()
    rows = odd.collect()
    ids = [x + [0] for x in reference_ids(rows)]
    assert sum(p.length for p in pieces) == sum(map(len, ids))
    left = Counter()
    by_id = defaultdict(list)
    for r, x in zip(rows, ids):
        by_id[(r.doc_id, len(x))].append(x)
    for p in pieces:
        assert p.start + p.length <= p.doc_tokens
        crcs = {zlib.crc32(np.array(x[p.start : p.start + p.length], "<u4").tobytes()) for x in by_id[(p.doc_id, p.doc_tokens)]}
        assert p.ids_crc32 in crcs
        left[(p.doc_id, p.doc_tokens)] += p.length
    assert left == Counter({k: sum(map(len, v)) for k, v in by_id.items()})
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for s in sequences.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:])) and sum(s[-1]) <= 1024
    assert packing.pack_documents(none).count() == 0


def test_pack_is_tight_and_balanced():
    lengths = np.random.default_rng(0).integers(1, 1500, 700).tolist()
    pieces = packing.pack(lengths, 1024)
    used = Counter()
    for _, _, n, s, _ in pieces:
        used[s] += n
    assert len(used) <= -(-sum(lengths) // 1024) + 1
    assert packing.pack([5, 3], 8) == [(0, 0, 5, 0, 0), (1, 0, 3, 0, 5)]
    # Two sequences: the two long ones part, the short one goes to the cheaper.
    assert [p[3] for p in packing.pack([6, 5, 4], 8)][:2] == [0, 1]


def test_token_counts(odd, none):
    hist = token_counts.histogram(odd, ("source",))
    rows = odd.collect()
    sizes = defaultdict(list)
    for r, x in zip(rows, reference_ids(rows)):
        sizes[r.source].append(len(x))
    got = hist.collect()
    assert {(r.source, r.n_tokens) for r in got} == {(s, n) for s, v in sizes.items() for n in v}
    for r in got:
        v, n = sizes[r.source], r.n_tokens
        assert (r.docs, r.docs_from, r.tokens_from, r.tokens_total) == (v.count(n), sum(x >= n for x in v), sum(x for x in v if x >= n), sum(v))
        assert r.truncated_total == sum(min(x, n) for x in v) and r.share_within == pytest.approx(sum(x <= n for x in v) / len(v))
    for r in token_counts.at_limits(hist, [8, 1024], ("source",)).collect():
        assert r.truncated_total == sum(min(x, r.limit) for x in sizes[r.source]) and r.docs_over == sum(x > r.limit for x in sizes[r.source])
    for r in token_counts.quantiles(hist, [0.5, 1.0], ("source",)).collect():
        v = sorted(sizes[r.source])
        assert r.n_tokens == v[int(np.ceil(r.share * len(v))) - 1]
    assert token_counts.histogram(none).count() == 0


@pytest.mark.parametrize("block,pivots", [(2048, 64), (8, 6), (40, 3)])
def test_embeddings(spark, block, pivots):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 8))
    x = np.repeat(base, 12, 0) + rng.normal(size=(144, 8)) * rng.uniform(0.02, 0.5, (144, 1))
    rows = [(int(k), [float(np.float32(v)) for v in row], int(k % 3)) for k, row in enumerate(x)]
    rows += [(200, None, 1), (201, [0.0] * 8, 1), (202, [None] + [1.0] * 7, 1), (203, [float("nan")] + [1.0] * 7, 1), (204, [float("inf")] + [1.0] * 7, 1)]
    rows += [(205, [1.0] * 8, None), (206, [1.0] * 8, None), (207, [1.0] * 5, 1), (208, [2.0] * 5, 1), (None, [3.0] * 5, 1), (209, [], 1), rows[0], (210, [1e30] * 8, 2), (211, [3e30] * 8, 2)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS rid", "2 AS node")
    rows = [tuple(r)[:3] for r in table.collect()]
    ok = lambda r: r[1] and r[2] is not None and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])
    n, links, root = len(rows), Counter(), list(range(len(rows)))
    for _ in range(2):
        links.clear()
        for i in range(n):
            for j in range(i):
                a, b = rows[i], rows[j]
                if ok(a) and ok(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                    u, v = np.array(a[1]) / np.linalg.norm(a[1]), np.array(b[1]) / np.linalg.norm(b[1])
                    if u @ v >= 0.93:
                        links[i] += 1
                        links[j] += 1
                        low, high = sorted((root[i], root[j]))
                        root = [low if r == high else r for r in root]
    names = {k: min((rows[i][0] for i in range(n) if root[i] == k and rows[i][0] is not None), default=None) for k in set(root)}
    want = Counter((rows[i][0], links[i], names[root[i]], rows[i][0] is not None and rows[i][0] == names[root[i]]) for i in range(n))
    got = embedding_dedup.near_vectors(table, block=block, most_pivots=pivots)
    assert Counter(map(tuple, got.select("vec_id", "n_links", "component_id", "kept").collect())) == want
    assert embedding_dedup.near_vectors(table.limit(0)).count() == 0


def test_mixing(odd, none):
    got, rows = mixing.mix(odd).collect(), odd.collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for r in rows:
        sizes[r.source] += size(r.text)
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight, target, left = {s: [5, 2, 1][k % 3] for k, s in enumerate(order)}, {}, float(sum(sizes.values()))
    free = set(order)
    while free:
        full = {s for s in free if left * weight[s] / sum(weight[x] for x in free) > 3 * sizes[s]}
        if not full:
            target |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
            break
        target |= {s: 3.0 * sizes[s] for s in full}
        left, free = left - sum(3 * sizes[s] for s in full), free - full
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r.doc_id, size(r.text)) for r in rows)
    want = Counter((r.doc_id, sizes[r.source], round(target[r.source], 6)) for r in rows)
    assert Counter((r.doc_id, r.source_size, round(r.target, 6)) for r in got) == want
    assert all(r.taken <= 3 * r.size and (r.size == 0) <= (r.taken == 0) for r in got)
    for s in order:
        mine = [r for r in got if r.source_size == sizes[s] and round(r.target, 6) == round(target[s], 6)]
        assert abs(sum(r.taken for r in mine) - target[s]) <= max(r.size for r in mine) / 2 + 1
    again = mixing.mix(odd.repartition(2)).collect()
    assert sorted((str(r.doc_id), r.size, r.taken) for r in again) == sorted((str(r.doc_id), r.size, r.taken) for r in got)
    mixed = mixing.mixed_rows(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(r.copies for r in got)
    assert mixing.mix(none).count() == 0 and mixing.mixed_rows(none).count() == 0


def test_empty_tables(none):
    assert exact_dedup.exact_dedup(none).count() == 0 and exact_dedup.keep_first(none).count() == 0
    assert near_dedup.near_duplicates(none).count() == 0 and near_dedup.keep_first(none).count() == 0


@pytest.mark.parametrize("sample", [1, 2000])
def test_embeddings_unsampled_lengths(spark, sample):
    """A length that the pivot sample doesn't hold, and a table of one repeated vector, are compared whole."""
    rows = [(k, [1.0, k % 2 * 1.0, 0.0], 1) for k in range(40)] + [(100 + k, [1.0, 0.0, 0.0, k % 3 * 1.0, 0.0], k % 2) for k in range(30)]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), block=4, sample=sample)
    unit = [np.array(e) / np.linalg.norm(e) for _, e, _ in rows]
    near = [[j for j, b in enumerate(rows) if len(a[1]) == len(b[1]) and a[2] == b[2] and unit[i] @ unit[j] >= 0.93] for i, a in enumerate(rows)]
    want = {(a[0], len(near[i]) - 1, rows[near[i][0]][0], near[i][0] == i) for i, a in enumerate(rows)}
    assert set(map(tuple, got.collect())) == want and got.count() == len(rows)
    same = spark.range(400).selectExpr("id AS vec_id", "array(1f, 2f, 3f) AS embedding", "1 AS label")
    got = embedding_dedup.near_vectors(same, block=64, sample=sample)
    assert {tuple(r) for r in got.collect()} == {(k, 399, 0, k == 0) for k in range(400)}


def test_wrapped_licences(spark):
    """Statements over two or three lines, in comments too, are one row with their family at their first line."""
    notices = {
        "gpl-3.0": "# This program is free software: you can redistribute it and/or modify it under\n# the terms of the GNU General Public License as published by the Free Software\n"
                   "# Foundation, either version 3 of the License, or (at your option) any later version.",
        "apache-2.0": "// This work is licensed under the Apache\n// License, Version 2.0.", "cc-by-nc": "This work is licensed under the Creative\r\nCommons Attribution-NonCommercial\r\n4.0 License.",
        "lgpl": "This file is released under the GNU\nLesser General Public License.",
    }
    rng = random.Random(6)
    plain = [" ".join("".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 8))) for _ in range(60)) for _ in range(200)]
    rows = [(k, "\n".join([p, "", list(notices.values())[k % 4], "", p[:40]]) if k < 80 else p + "\n" + p[:90]) for k, p in enumerate(plain)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    first = {"gpl-3.0": 3}
    want = Counter((k, first.get(list(notices)[k % 4], 2), list(notices)[k % 4]) for k in range(80))
    assert Counter((r.doc_id, r.place, r.family) for r in got if r.confirmed) == want
    # Only the last line of the third notice, behind its template, may be a row of its own.
    assert all((r.doc_id % 4, r.place) == (2, 4) for r in got if not r.confirmed)


def test_licence_footers(spark):
    """Footers without a licence word are not learned as ordinary text."""
    footers = {"Released under CC BY-NC 4.0.": "cc-by-nc", "Distributed under GPLv3.": "gpl-3.0", "Released under the MPL 2.0.": "mpl-2.0", "Made available under GPL-2.0": "gpl-2.0"}
    rng = random.Random(8)
    plain = [" ".join("".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 8))) for _ in range(40)) for _ in range(200)]
    # A different name in each footer, so that each is a line of its own.
    rows = [(k, p + "\n\n" + list(footers)[k % 4] + f" Edition {k}") for k, p in enumerate(plain)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.place) for r in got) == Counter((k, 2) for k in range(200))
    # The number may share its hash with a word of another family.
    assert sum(r.family == list(footers.values())[r.doc_id % 4] for r in got) >= 198


@pytest.mark.parametrize("labels", [[], [0, 0, 0], [1]])
def test_quality_stage_without_two_classes(spark, tmp_path, labels):
    """The stage keeps every row if no network can be fitted."""
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(20)], "doc_id long, text string")
    spark.createDataFrame(list(enumerate(labels)), "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    assert sorted(map(tuple, quality.stage(spark, docs, str(tmp_path)).collect())) == sorted(map(tuple, docs.collect()))


def test_licence_units(spark, monkeypatch):
    """The words around each line break, against a walk over the lines."""
    rng = random.Random(8)
    texts = ["\n".join(rng.choice(["", " ", "--", "a b", "C, d e.", "w " * rng.randint(1, 30)]) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    texts += [None, "", "\r\n\r", "x" + "\r" * 50 + "y", "one line", "é ü"]
    rows = [(None if k % 9 == 0 else k, t) for k, t in enumerate(texts)] + [(1, texts[1])] * 3
    want = Counter()
    for k, t in rows:
        lines = re.split("\r\n|\r|\n", t) if t is not None else []
        words = [re.findall("[a-z0-9]+", x.lower()) for x in lines]
        for i, own in enumerate(words):
            if own:
                after = []
                for j in range(i + 1, min(len(lines), i + 1 + licenses.WRAP)):
                    if not re.search(r"\S", lines[j], re.A):
                        break
                    after += words[j]
                want[k, i, False, tuple(own)] += 1
                if after:
                    want[k, i, True, tuple(own[-licenses.WRAP :] + after[: licenses.WRAP])] += 1
    got = licenses.units(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.place, r.joined, tuple(r.words)) for r in got) == want
