"""Divergence audit, URL rules and conversation trie against brute force, on odd input and on single hot groups."""

import hashlib
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from noteflow.llm import divergence, prefix_trie, url_filter

# --- divergence ------------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, n long, term int, p long"


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(2)
    words = [f"w{c}" for c in "abcdefghijklmnop"] + ["É", "é", "ü漢", "A", "aZ"] + ["t" + "".join(rng.choice("abc") for _ in range(3)) for _ in range(60)]
    rows = []
    for i in range(400):
        lang, source = rng.choice(["en", "de", None, "x"]), rng.choice([f"s{k}" for k in range(9)] + ["é", None])
        text = None if i % 29 == 0 else "".join(rng.choice(words) + rng.choice([" ", "1", "_", ".\n"]) for _ in range(rng.randint(0, 40)))
        rows.append((i if i % 7 else None, "12 34" if lang == "x" else text, lang, "only" if lang == "x" else source, 1, 3, 4))
    return [*rows, (9, "longwordword " * 20000, "en", "s1", 0, 0, 0), *rows[:20]]


def plain_audit(rows, least=3, top=200):
    low = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    found = [(r[2] or "", r[3] or "", [w.translate(low) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", r[1] or "")]) for r in rows]
    groups, out = sorted({(lang, source) for lang, source, _ in found}), []
    for lang in {g[0] for g in groups}:
        held, total, count = Counter(), Counter(), defaultdict(Counter)
        for _, source, words in (x for x in found if x[0] == lang):
            held.update(set(words))
            total.update(words)
            count[source].update(words)
        kept = [w for w in held if held[w] >= least]
        n = {s: sum(count[s][w] for w in kept) for g, s in groups if g == lang}
        n_all = sum(total[w] for w in kept)
        p = {s: {w: 1 + 10**9 * (count[s][w] + 1) // (n[s] + len(kept)) for w in kept} for s in n}
        q = {w: 1 + 10**9 * (total[w] + 1) // (n_all + len(kept)) for w in kept}
        f = lambda a, b: (a - b) ** 2 // b
        for s in n:
            pair = sorted((-sum(f(p[s][w], p[o][w]) for w in kept), o.encode()) for o in n if o != s)
            term = sorted((-f(p[s][w], q[w]), w.encode()) for w in kept if count[s][w] and p[s][w] > q[w])[:top]
            out += [(lang, s, part, i.decode(), -v, k + 1) for part, x in (("pair", pair), ("term", term)) for k, (v, i) in enumerate(x)]
    return sorted(out)


@pytest.mark.parametrize("kw", [{}, {"top": 3, "tile": 2, "part_rows": 10, "fan_in": 2}, {"top": 5, "tile": 4, "part_rows": 50, "least": 1}, {"least": 50}])
def test_audit(spark, docs, kw):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = divergence.audit(spark.createDataFrame(docs, DOCS).repartition(7), **kw).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(tuple(r) for r in got) == plain_audit(docs, kw.get("least", 3), kw.get("top", 200))


def test_audit_of_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0


def test_shares_are_exact_beyond_long_products(spark):
    n = 30_000_000_000_001
    got = spark.range(1).select(divergence.share(divergence.F.lit(n), divergence.F.lit(3 * n), divergence.F.lit(17)).alias("p")).first()["p"]
    assert got == 1 + 10**9 * (n + 1) // (3 * n + 17)


@pytest.mark.parametrize("k,block,piece", [(1, 7, 40), (5, 16, 33), (200, 512, 1000)])
def test_skyband(monkeypatch, k, block, piece):
    """Kept are exactly the terms that fewer than k others dominate, however the rows are cut."""
    rng = np.random.default_rng(k)
    n, n_all = rng.integers(1, 12, 900), rng.integers(1, 30, 900)
    term = [f"{i:03x}é" for i in rng.permutation(900)]
    rows = sorted(zip(n.tolist(), n_all.tolist(), term), key=lambda r: (-r[0], r[1], r[2].encode()))
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "SLICE", piece)
    cols = {"lang": ["l"] * 900, "source": ["s"] * 900, "term": [r[2] for r in rows], "n": [r[0] for r in rows], "all_n": [r[1] for r in rows], "p": [1] * 900, "q": [1] * 900}
    batches = pa.table(cols).to_batches(max_chunksize=171)
    got = {t for b in divergence._skyband(k)(iter(batches)) for t in b.column("term").to_pylist()}
    want = {c[2] for c in rows if sum(o[0] >= c[0] and o[1] <= c[1] and o[2].encode() < c[2].encode() for o in rows) < k}
    assert got == want


# --- URL rules -------------------------------------------------------------------------------

HOSTS = ["a", "b", "c.d", "x.y.z", "org", "example.org", "A.Example.ORG", "q.example.org", "", ".org", "org."]
PATHS = ["", "/", "/es/", "/es/1", "/en/1", "/en/12", "/e", "/en/", "//x", "/é/1", "/es/" + "x" * 3000]
RULES = "host string, path string, action string"


def plain_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        host, path = re.search(r"://([^/?#]*)([^?#]*)", url, re.S).groups()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = []
    for h, p, action in rules:
        if h is not None and p is not None and action in ("allow", "block") and p[:1] in ("", "/"):
            h = h.lower()
            if (host == h or host.endswith("." + h)) and path.startswith(p):
                fit.append((len(h + p), len(h), h + p, action == "block"))
    best = max(fit, default=None)
    return host, path, best and best[2], "block" if best and best[3] else "allow"


@pytest.mark.parametrize("bits,rate", [(url_filter.MOST_BITS, None), (64, None), (url_filter.MOST_BITS, 0.5), (200, 0.4)])
def test_url_rules(spark, bits, rate):
    """Also with filters that take half of all keys for listed ones, and with a list dealt into several."""
    rng = random.Random(1)
    urls = [None, "", "no scheme/es/", "http://", "x://y\n.org/es/\n1"] + [f"http://{h}{p}{t}" for h in HOSTS for p in PATHS for t in ("", "?q=/es/", "#a")]
    rows = [(i if i % 7 else None, u, True, "k") for i, u in enumerate(urls + urls[:9] + ["http://example.org/es/"] * 200)]
    rules = [(rng.choice(HOSTS), rng.choice([*PATHS, "noslash"]), rng.choice(["allow", "block", "other"])) for _ in range(60)] + [(None, "/", "block"), ("a", None, "allow")]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule boolean, _keys string").repartition(3)
    got = url_filter.judge(pages, spark.createDataFrame(rules, RULES), most_bits=bits, rate=rate).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str((r[0], *plain_verdict(r[1], rules))) for r in rows)


def test_url_rules_without_rules_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    assert [tuple(r) for r in url_filter.judge(pages, spark.createDataFrame([], RULES), default="block").collect()] == [(1, "a.org", "/x", None, "block")]
    assert url_filter.judge(pages.limit(0), spark.createDataFrame(url_filter.RULES, RULES)).count() == 0


def test_url_rules_have_no_join_on_the_pages(spark, capsys):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    url_filter.judge(pages, spark.createDataFrame(url_filter.RULES, RULES)).explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan and "Exchange" not in plan and "Python" not in plan


# --- conversations ---------------------------------------------------------------------------

TALK = "conv_id long, turn long, role string, text string, d long, a string, least int"


def plain_trie(rows):
    own = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            role, text = r[2] or "", r[3] or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[r[0]].append(((r[1] is not None, r[1] or 0, tie), (role, text)))
    own = {c: [t for _, t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - int(np.fmod(c, 5)), [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    out = []
    for p, cs in members.items():
        under = [q for q in members if q[: len(p)] == p]
        leaf = lambda q: not any(len(o) == len(q) + 1 and o[:-1] == q for o in members)
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in under if q)
        ends = ",".join(map(str, sorted(c for c in cs if built[c] == p)))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), sum(len(q) == len(p) + 1 for q in under), sum(map(leaf, under)), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def talk():
    rng = random.Random(3)
    rows = []
    for c in [*range(-7, 60), 1000, 1001, 10**15]:
        for k in range(rng.choice([0, 1, 2, 5, 12])):
            rows.append((c, rng.choice([None, k, k, k - 3]), rng.choice(["u", None]), rng.choice(["x", "é", "", None, "yy"]), 1, "a", 2))
    rows += [(c, k, "u", "same", 1, "a", 2) for c in range(100, 140) for k in range(9)]
    return [*rows, *rows[:30], (None, 1, "u", "lost", 0, "", 0), (3, 50, "u", "z" * 100_000, 0, "", 0)]


@pytest.mark.parametrize("max_rows", [None, 5])
def test_trie(spark, talk, max_rows):
    got = prefix_trie.trie(spark.createDataFrame(talk, TALK).repartition(5), max_rows=max_rows).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_trie(talk)


def test_trie_of_one_long_conversation_and_of_nothing(spark):
    long = spark.range(3000).selectExpr("5L AS conv_id", "id AS turn", "'u' AS role", "concat('t', id % 3) AS text")
    got = prefix_trie.trie(long, max_rows=200)
    assert got.count() == 3001
    top = got.filter("depth = 0").first()
    assert (top["conv_id"], top["n_convs"], top["n_children"], top["n_leaves"], top["saved_tokens"]) == (5, 1, 1, 1, 0)
    assert prefix_trie.trie(long.limit(0)).count() == 0


def test_end_list_of_many_copies(spark):
    """A list that is cut into many pieces has the digest of the whole."""
    whole = spark.range(40_000).selectExpr("2L AS d", "7L AS a", "8L AS b", "9L AS sum", "id AS conv_id").repartition(6)
    got = prefix_trie.sequences(whole).collect()
    assert [tuple(r) for r in got] == [(2, 7, 8, 9, 0, 40_000, hashlib.sha256(",".join(map(str, range(40_000))).encode()).hexdigest())]
