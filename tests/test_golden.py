"""Hand-computed rows for the operators."""

import math

import pytest
from pyspark.sql import functions as F

from noteflow.functions import scalar as K
from noteflow.operators import expand as E
from noteflow.operators import lyrics as Y
from noteflow.operators import manifest as M
from noteflow.operators import scores as S
from noteflow.operators import workplan as W
from noteflow.sources import score_io


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def line(start, n, dur=0.4, gap=0.05, pitch=60):
    return [(round(start + i * (dur + gap), 3), round(start + i * (dur + gap) + dur, 3), pitch) for i in range(n)]


def test_monophony_cases(notes):
    df = notes({
        "poly": [(0.2, 0.8, 60), (0.5, 1.1, 64)],
        "legato": [(0.2, 0.7, 62), (0.7, 1.2, 62), (1.25, 1.7, 64)],
    })
    assert rows(S.monophony(df), "score_id", "monophonic", "n_overlaps") == [("legato", True, 0), ("poly", False, 1)]


def test_threshold(notes):
    four = notes({"a": [(i, i + 0.25, 60) for i in range(4)]})
    got = S.learn_min_note_ms(four).first()
    assert got["data_percentile_ms"] == pytest.approx(250.0) and got["min_note_ms"] == pytest.approx(250.0)
    short = notes({"a": [(0, 0.005, 60), (1, 1.006, 60), (2, 2.007, 60)]})
    assert S.learn_min_note_ms(short).first()["min_note_ms"] == 50.0
    assert S.learn_min_note_ms(notes({"a": [(0, 0.02, 60)]}), hops={"x": 80.0}).first()["min_note_ms"] == 80.0
    empty = S.learn_min_note_ms(short.filter("false")).first()
    assert (empty["n_notes"], empty["min_note_ms"]) == (0, 50.0)


def test_phrases(notes):
    two = S.segment_phrases(notes({"a": line(0.0, 5) + line(10.0, 5)}))
    assert {r["score_id"] for r in two.collect()} == {"a_p000", "a_p001"}
    assert two.agg(F.min("onset_s")).first()[0] < 0.3
    low = S.segment_phrases(notes({"a": line(0.0, 6, pitch=33)}))
    assert all(55 <= r["pitch_midi"] <= 79 for r in low.collect()) and low.count() == 6
    assert S.segment_phrases(notes({"a": line(0.0, 2)})).count() == 0
    long = S.segment_phrases(notes({"a": line(0.0, 60)}), max_phrase_s=10.0)
    spans = long.groupBy("score_id").agg((F.max("offset_s") - F.min("onset_s")).alias("s")).collect()
    assert len(spans) >= 2 and all(r["s"] <= 12 for r in spans)


def test_skyline_and_melody(spark):
    ev = spark.createDataFrame(
        [("x", 0, "p", False, 0.0, 1.0, 60), ("x", 0, "p", False, 0.0, 1.0, 67), ("x", 0, "p", False, 1.0, 2.0, 62), ("x", 0, "p", False, 1.0, 2.0, 69),
         ("y", 0, "chords", False, 0.0, 3.0, 48), ("y", 1, "Melody", False, 0.0, 1.0, 64), ("y", 1, "Melody", False, 1.0, 2.0, 67), ("y", 1, "Melody", False, 2.0, 3.0, 65),
         ("z", 0, "drums", True, 0.0, 1.0, 40), ("w", 0, "p", False, 0.0, 2.0, 60), ("w", 0, "p", False, 0.5, 1.0, 50), ("w", 0, "p", False, 1.0, 1.5, 70)],
        "song_id string, track int, track_name string, is_drum boolean, start_s double, end_s double, pitch int",
    )
    top = S.skyline(S.pick_melody_track(ev))
    assert rows(top.filter("song_id = 'x'"), "start_s", "end_s", "pitch") == [(0.0, 1.0, 67), (1.0, 2.0, 69)]
    # Truncated at 1.0 by the higher note; the note hidden under the held one is gone.
    assert rows(top.filter("song_id = 'w'"), "start_s", "end_s", "pitch") == [(0.0, 1.0, 60), (1.0, 1.5, 70)]
    stats = {r["song_id"]: r for r in S.melody_stats(ev, S.melody_lines(ev)).collect()}
    assert stats["y"]["method"] == "melody_track" and stats["x"]["method"] == "skyline" and stats["z"]["reject_reason"] == "no pitched notes"


def test_slurs(spark):
    data = [
        ("ok", [60.0, 60.0, 62.0, 0.0, 64.0], ["n_i", "—", "h_ao", "SP", "m_a"], [0.0, 0.2, 0.5, 0.8, 0.9], [0.2, 0.5, 0.8, 0.9, 1.2]),
        ("change", [60.0, 62.0], ["n_i", "—"], [0.0, 0.2], [0.2, 0.5]),
        ("short", [60.0] * 5, ["a"] * 5, [0.0] * 5, [0.2]),
    ]
    df = spark.createDataFrame(data, "segment_id string, note_midi array<double>, note_lyrics array<string>, note_start_times array<double>, note_end_times array<double>")
    got, outcome = S.merge_slurs(df)
    assert rows(got.filter("score_id = 'ok'"), "onset_s", "offset_s", "pitch_midi") == [(0.0, 0.5, 60), (0.5, 0.8, 62), (0.9, 1.2, 64)]
    assert got.filter("score_id = 'change'").count() == 2
    assert rows(outcome, "segment_id", "outcome") == [("change", "usable"), ("ok", "usable"), ("short", "arrays differ in length")]


def test_syllables(spark):
    words = spark.createDataFrame([(k, w) for k, w in enumerate(("winter", "water", "la", "cat", "table", "longing", "make", "hmm"))], "k int, w string")
    got = [r["s"] for r in words.select("k", Y._split(F.col("w"), Y.ENGLISH_VOWELS, True).alias("s")).orderBy("k").collect()]
    assert got == [
        ["win", "ter"], ["wa", "ter"], ["la"], ["cat"], ["tab", "le"], ["lon", "ging"], ["make"], ["hmm"]]
    df = spark.createDataFrame([(1, "さくら", "ja"), (2, "春天", "cmn"), (3, "사랑", "ko"), (4, "123 ", "en")], "doc_id int, text string, lang string")
    got = Y.syllabify(df, lang="lang").groupBy("doc_id").count()
    assert rows(got, "doc_id", "count") == [(1, 3), (2, 2), (3, 2)]
    assert rows(Y.syllable_count(df, lang="lang"), "doc_id", "syllables") == [(1, 3), (2, 2), (3, 2), (4, 0)]


def test_seed_matches_definition(spark):
    import hashlib

    want = []
    for i in range(200):
        text = "\x1f".join(["42", f"s{i}", "v"]).encode()
        want.append(int.from_bytes(hashlib.sha256(text).digest()[:8], "big") & (2**63 - 1))
    df = spark.range(200).select("id", K.derive_seed(42, F.concat(F.lit("s"), F.col("id").cast("string")), F.lit("v")).alias("s"))
    assert [r["s"] for r in df.orderBy("id").collect()] == want


def manifest_rows(spark, recs):
    from noteflow.schemas import MANIFEST

    base = spark.createDataFrame(recs, "sample_id string, lane string, voice_id string, status string, base_score_id string, score_aug_transform string")
    return base.select(
        "*", F.struct("status").alias("verdict"), F.lit(None).cast("string").alias("augmentation_profile"),
        F.lit("a").alias("audio_path"), F.lit("s").alias("score_path"), F.monotonically_increasing_id().alias("ord"),
    )


def test_split_counts(spark):
    recs = [(f"{s}{i}", "det", s, "accepted", None, None) for s in "ab" for i in range(5)] + [("bad", "det", "a", "rejected", None, None)]
    m = manifest_rows(spark, recs)
    split = M.val_split(m, 0.4)
    assert rows(M.per_source_counts(split), "total", "train", "val") == [(5, 3, 2), (5, 3, 2)]
    assert tuple(M.split_disjoint(split, m).first()) == (0, 0, 0)
    pair = manifest_rows(spark, recs[:2])
    assert rows(M.per_source_counts(M.val_split(pair, 0.2)), "total", "val") == [(2, 0)]


def test_variant_coverage(spark):
    recs = [("o", "det", "v", "accepted", None, None)] + [(t, "det", "v", "accepted", "o", t) for t in ("t+12", "t-12", "hum0", "vol")]
    got = M.score_aug_coverage(manifest_rows(spark, recs)).first()
    assert (got["variant_share"], got["effective_multiplier"]) == (0.8, 5.0)
    assert got["by_transform"] == {"t+12": 1, "t-12": 1, "hum0": 1, "vol": 1}


def test_expansion(notes):
    base = notes({"t1": [(0.2, 0.6, 60, "la"), (0.7, 1.1, 62, "le"), (1.2, 1.6, 64, "li")], "x__y": [(0, 1, 60)]})
    prof = E.VariantProfile("p", E.Transpose((12,)), E.Humanize(draws=2), E.Volume())
    got = E.expand_variants(base, [prof], 1)
    per = got.notes.groupBy("score_id").agg(F.count(F.lit(1)).alias("n"), F.concat_ws("", F.array_sort(F.collect_list("lyric"))).alias("l"))
    assert rows(per, "score_id", "n", "l") == [(f"t1__{t}", 3, "laleli") for t in ("hum0", "hum1", "t+12", "vol")]
    mono = S.monophony(got.notes.select("score_id", "note_idx", "onset_s", "offset_s", "pitch_midi"))
    assert all(r["monophonic"] for r in mono.collect())
    with pytest.raises(ValueError):
        E.Transpose((1,), "wrap")
    with pytest.raises(ValueError):
        E.expand_variants(base, [prof, prof], 1)


def plain_fold(score, knob, seed_text):
    """The left-to-right correction over a whole score, with draws from the seed definition."""
    import hashlib

    def seed(*parts):
        text = "\x1f".join(str(p) for p in parts).encode()
        return int.from_bytes(hashlib.sha256(text).digest()[:8], "big") & (2**63 - 1)

    def gauss(s, tag, i):
        u, v = (seed(s, tag, x, i) / 2.0**63 for x in "uv")
        return math.sqrt(-2.0 * math.log(1.0 - u)) * math.cos(2.0 * math.pi * v)

    draw, end, out = seed(seed_text, 0), 0.0, []
    for i, (base_on, base_off, _) in enumerate(score):
        lim = lambda x: max(-knob.max_dev_s, min(knob.max_dev_s, x))
        dur = base_off - base_on
        on = base_on + lim(gauss(draw, "onset", i) * knob.onset_sigma_s)
        off = base_on + dur + lim(gauss(draw, "duration", i) * knob.duration_sigma_s)
        on = max(on, end)
        if abs(on - base_on) > knob.max_dev_s + 1e-9:
            on = max(base_on, end)
        off = max(off, on + knob.min_dur_s)
        if abs(off - base_off) > knob.max_dev_s + 1e-9:
            off = min(max(base_off, on + knob.min_dur_s), on + dur + knob.max_dev_s)
        out.append((on, off))
        end = off
    return out


def test_humanize_islands_equal_one_fold(notes):
    """Splitting at rests must not change the fold, also where short notes push each other late."""
    dense = [(i * 0.02, i * 0.02 + 0.015, 60) for i in range(40)]
    score = dense + [(1.2, 1.5, 60), (1.5, 1.9, 61), (9.0, 9.4, 62), (9.41, 9.5, 62)]
    knob = E.Humanize(0.02, 0.02, 0.03, 1, 0.05)
    got = E.humanize(notes({"a": score}), knob, F.lit(5)).orderBy("note_idx").collect()
    want = plain_fold(score, knob, 5)
    assert [(r["onset_s"], r["offset_s"]) for r in got] == [pytest.approx(w, abs=1e-9) for w in want]


def test_best_take(spark):
    df = spark.createDataFrame(
        [("a", 0, "rejected", None, 1.0), ("a", 1, "accepted", 5.0, 9.0), ("a", 2, "accepted", 8.0, 9.0), ("b", 0, "rejected", None, 3.0), ("b", 1, "flagged", None, 3.0), ("b", 2, "rejected", None, 7.0)],
        "base_id string, take int, status string, snr_db double, shift_ms double",
    )
    got = {r["base_id"]: r for r in W.best_take(df).collect()}
    assert (got["a"]["take"], got["a"]["admitted"], got["a"]["takes_tried"]) == (2, True, 3)
    assert (got["b"]["take"], got["b"]["admitted"], got["b"]["takes_tried"]) == (0, False, 3)


def test_score_files_round_trip(spark, notes, tmp_path):
    (tmp_path / "a.tsv").write_text("# onset\n0.2\t0.5\t60\tla\n\n0.6 0.9 61.5\nbad row here\n2 1 60\n")
    got, rejects = score_io.read_scores(spark, str(tmp_path))
    assert rows(got, "score_id", "note_idx", "onset_s", "offset_s", "pitch_midi", "lyric") == [("a", 0, 0.2, 0.5, 60, "la"), ("a", 1, 0.6, 0.9, 62, None)]
    assert rejects.count() == 1
    out = str(tmp_path / "out")
    score_io.write_scores(got, out)
    assert sorted(r["value"] for r in spark.read.text(out).collect()) == ["0.200000\t0.500000\t60\tla", "0.600000\t0.900000\t62\t"]
    made = notes({"a b+c%": [(0.5, 0.9, 61), (0.5, 0.9, 60, "la")], "x/y": [(0.1, 0.2, 70)], "p.1": [(0.1, 0.2, 71)]})
    score_io.write_scores(made, str(tmp_path / "made"))
    back, _ = score_io.read_scores(spark, str(tmp_path / "made"))
    names = ("score_id", "note_idx", "onset_s", "offset_s", "pitch_midi", "lyric")
    assert rows(back, *names) == rows(made, *names)


def test_score_identity(spark, tmp_path):
    for name in ("s1/score.tsv", "s2/score.tsv", "set/one.tsv", "other/one.tsv"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("0.2\t0.5\t62\n0.2\t0.5\t60\n")
    got, _ = score_io.read_scores(spark, str(tmp_path))
    assert rows(got, "score_id", "note_idx", "pitch_midi") == sorted((s, k, p) for s in ("s1", "s2", "set/one", "other/one") for k, p in ((0, 62), (1, 60)))


def test_pitch_functions(spark):
    got = spark.range(1).select(
        K.midi_to_hz(F.lit(69)).alias("a"), K.hz_to_midi(F.lit(880.0)).alias("b"), K.hz_to_midi(F.lit(float("nan"))).alias("c"),
        K.hz_to_midi(F.lit(-1.0)).alias("d"), K.cents(F.lit(440.0), F.lit(220.0)).alias("e"),
    ).first()
    assert (got["a"], got["b"], got["c"], got["d"], got["e"]) == (440.0, 81.0, None, None, 1200.0)
    assert math.isclose(spark.range(1).select(K.hnr_db(F.lit(0.5))).first()[0], 0.0, abs_tol=1e-9)


def test_keyed_permutation(spark):
    """One to one for any size, the same as the rounds by hand, and another order for another key."""
    import hashlib

    from noteflow.operators.lyrics import PRIME, ROUNDS, keyed_position

    def by_hand(x, n, *key):
        for r in range(ROUNDS):
            k = int(hashlib.sha256("\x1f".join(map(str, (*key, r))).encode()).hexdigest()[:15], 16)
            other = (k % n - x) % n
            if (max(x, other) * (k >> 29) + k % (1 << 29)) % PRIME >= 1 << 30:
                x = other
        return x

    for n in (1, 2, 3, 7, 64, 1001):
        rows = spark.range(n).select("id", keyed_position(F.col("id"), n, F.lit(5), F.lit(1)).alias("a"), keyed_position(F.col("id"), n, F.lit(6), F.lit(1)).alias("b")).collect()
        assert sorted(r["a"] for r in rows) == sorted(r["b"] for r in rows) == list(range(n))
        assert all(r["a"] == by_hand(r["id"], n, 5, 1) for r in rows)
        assert n < 64 or sum(r["a"] == r["b"] for r in rows) < n / 8


def test_large_inventory(spark):
    """A hundred thousand syllables: none comes twice before all have come, and the next round has another order."""
    from noteflow.operators.lyrics import auto_syllables

    n = 100_003
    inventory = spark.range(n).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("syllable"))
    notes = spark.range(2 * n).select(F.lit("x").alias("score_id"), F.col("id").cast("int").alias("note_idx"))
    got = auto_syllables(notes, inventory.union(inventory.limit(5)), F.lit(3)).withColumn("chunk", F.floor(F.col("note_idx") / n))
    per = got.groupBy("chunk").agg(F.count_distinct("syllable").alias("k"), F.count("*").alias("m")).collect()
    assert [(r["k"], r["m"]) for r in per] == [(n, n)] * 2
    again = got.groupBy(F.col("note_idx") % n).agg(F.count_distinct("syllable").alias("k")).filter("k = 1").count()
    assert again < 50
