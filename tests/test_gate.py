"""The gate, label alignment, decoding and matching against hand-made and brute-force results."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from noteflow.operators import align as A
from noteflow.operators import decode as D
from noteflow.operators import gate as G
from noteflow.operators import matching as X


def hz(p):
    return 440.0 * 2 ** ((p - 69) / 12)


def frames_of(spark, sid, spans, length):
    """Voiced 20 ms frames for [(a, b, pitch)]."""
    rows = []
    for k in range(int(length / 0.02)):
        t = k * 20 / 1000
        hit = next((p for a, b, p in spans if a - 1e-9 <= t < b - 1e-9), None)
        rows.append((sid, k, t, hz(hit) if hit else None, hit is not None))
    return spark.createDataFrame(rows, "sample_id string, frame_idx bigint, t_s double, f0_hz double, voiced boolean")


def judge(spark, df, frames, snr=None, peak=0.5, min_ms=50.0):
    meta = df.select(F.col("score_id").alias("sample_id")).distinct().select("sample_id", F.lit(snr).cast("double").alias("snr_db"), F.lit(peak).alias("peak"))
    return G.verdict(G.note_checks(df, frames, tol=G.Tolerances(min_note_ms=min_ms)), meta).first()


def test_verdict_precedence(spark, notes):
    score = [(0.2, 0.6, 60), (0.7, 1.1, 62)]
    df, fr = notes({"a": score}), frames_of(spark, "a", score, 1.6)
    assert judge(spark, df, fr)["status"] == "accepted"
    assert judge(spark, df, fr, min_ms=500.0)["status"] == "flagged"
    assert judge(spark, df, fr, peak=1.2)["status"] == "rejected"
    assert judge(spark, df, fr, snr=-1.0, peak=1.2)["status"] == "quarantined"
    wrong = frames_of(spark, "a", [(0.2, 0.6, 60), (0.7, 1.1, 63)], 1.6)
    got = judge(spark, df, wrong)
    assert got["status"] == "rejected" and got["n_reasons"] == 3
    empty = spark.createDataFrame([("e", None, 0.5)], "sample_id string, snr_db double, peak double")
    assert G.verdict(G.note_checks(df, fr), empty).first()["status"] == "rejected"


def test_same_pitch_neighbours(spark, notes):
    score = [(0.2, 0.6, 60), (0.66, 1.1, 60)]
    gap = frames_of(spark, "a", score, 1.6)
    assert judge(spark, notes({"a": score}), gap)["status"] == "accepted"
    # A late second onset is measured at its own rising edge, not at the first note's sound.
    late = frames_of(spark, "a", [(0.2, 0.6, 60), (0.76, 1.1, 60)], 1.6)
    got = judge(spark, notes({"a": score}), late)
    assert not got["onset_ok"] and abs(got["max_onset_dev_ms"] - 100) < 1e-6


def test_mix_rejudged(spark):
    df = spark.createDataFrame(
        [("moved", "rejected", False, True, True, None, 80.0), ("kept", "rejected", False, True, True, "note 0", 10.0), ("masked", "rejected", False, True, False, None, 0.0),
         ("short", "rejected", False, True, True, "notes shorter than min_note_ms=50", 0.0), ("quiet", "quarantined", True, True, True, None, 0.0)],
        "sample_id string, status string, onset_ok boolean, offset_ok boolean, f0_ok boolean, reason string, max_note_shift_ms double",
    )
    got = {r["sample_id"]: r["status"] for r in G.preserved_timing(df).collect()}
    assert got == {"moved": "rejected", "kept": "accepted", "masked": "rejected", "short": "flagged", "quiet": "quarantined"}


def dense_path(on, off, pitch, t, midi):
    """The whole table of costs at once; going on wins ties."""
    n, m = len(pitch), len(t)
    cost = np.minimum(np.nan_to_num(np.abs(midi - pitch[:, None]), nan=A.UNVOICED_COST), A.UNVOICED_COST)
    cost = cost + A.TIMING_WEIGHT * np.maximum(0, np.maximum(on[:, None] - t, t - off[:, None]))
    best, went = np.full((n, m), np.inf), np.zeros((n, m), int)
    best[0, 0] = cost[0, 0]
    for j in range(1, m):
        for i in range(n):
            went[i, j] = i > 0 and best[i - 1, j - 1] <= best[i, j - 1]
            best[i, j] = cost[i, j] + best[i - went[i, j], j - 1]
    path, i = [], n - 1
    for j in range(m - 1, -1, -1):
        path.append(i)
        i -= went[i, j]
    return path[::-1]


def song(rng, n, m):
    on = np.cumsum(rng.integers(1, 6, n)) * 0.05
    midi = np.where(rng.random(m) < 0.2, np.nan, rng.integers(60, 64, m) + rng.choice([0, 0.3], m))
    return on, on + rng.integers(1, 6, n) * 0.03, rng.integers(60, 64, n).astype(float), np.arange(m) * 0.02, midi


@pytest.mark.parametrize("limits", [(1 << 26, 1 << 18), (60, 100), (20, 7), (3, 1)])
def test_alignment_in_blocks_equals_the_dense_one(limits):
    rng = np.random.default_rng(3)
    for _ in range(60):
        n = int(rng.integers(1, 12))
        args = song(rng, n, int(rng.integers(n, 70)))
        assert A.Alignment(*args, *limits).solve().tolist() == dense_path(*args)


def test_alignment_of_a_long_recording_is_bounded():
    """A table of all notes and frames would take 400 MB a column of doubles; rows and bits stay under 40."""
    import tracemalloc

    args = song(np.random.default_rng(4), 1500, 36_000)
    tracemalloc.start()
    path = A.Alignment(*args, block_cells=1 << 22).solve()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert path[0] == 0 and path[-1] == 1499 and set(np.diff(path)) <= {0, 1} and most < 40e6


def test_align_and_repair(spark, notes):
    score, sung = [(0.2, 0.6, 60), (0.7, 1.1, 62)], [(0.3, 0.68, 60), (0.8, 1.2, 62)]
    df, fr = notes({"a": score}), frames_of(spark, "a", sung, 1.6)
    got = [(r["onset_s"], r["offset_s"]) for r in A.align_dtw(df, fr).orderBy("note_idx").collect()]
    assert got == [(0.3, 0.68), (0.8, 1.2)]
    meta = spark.createDataFrame([("a", None, 0.5)], "sample_id string, snr_db double, peak double")
    fixed = A.relabel_repair(df, fr, meta).orderBy("note_idx").collect()
    assert [(r["onset_s"], r["repaired"]) for r in fixed] == [(0.3, True), (0.8, True)]
    ok = A.relabel_repair(notes({"a": sung}), fr, meta)
    assert not any(r["repaired"] for r in ok.collect())


def brute_matching(edges):
    """Size of a maximum matching by exhaustive search."""
    def best(i, used_r, used_e):
        if i == len(edges):
            return 0
        r, e = edges[i]
        skip = best(i + 1, used_r, used_e)
        if r in used_r or e in used_e:
            return skip
        return max(skip, 1 + best(i + 1, used_r | {r}, used_e | {e}))

    return best(0, frozenset(), frozenset())


def test_matching_against_brute_force(spark):
    rnd = random.Random(5)
    ref, est = [], []
    for s in range(30):
        for i in range(5):
            on = round(rnd.randrange(0, 20) * 0.01, 3)
            ref.append((f"s{s}", i, on, round(on + rnd.choice([0.1, 0.3]), 3), rnd.choice([60, 72, 61])))
            on = round(rnd.randrange(0, 20) * 0.01, 3)
            est.append((f"s{s}", i, on, round(on + rnd.choice([0.1, 0.3]), 3), rnd.choice([60, 72, 61])))
    cols = "song_id string, {} bigint, onset_s double, offset_s double, pitch int"
    cand = X.match_candidates(spark.createDataFrame(ref, cols.format("ref_idx")), spark.createDataFrame(est, cols.format("est_idx")))
    pairs = cand.collect()
    got = X.match_notes(cand).collect()
    for mode, tests in X.MODES.items():
        mine = [r for r in got if r["mode"] == mode]
        assert len({(r["song_id"], r["ref_idx"]) for r in mine}) == len(mine) == len({(r["song_id"], r["est_idx"]) for r in mine})
        want = 0
        for s in range(30):
            want += brute_matching([(p["ref_idx"], p["est_idx"]) for p in pairs if p["song_id"] == f"s{s}" and all(p[t] for t in tests)])
        assert len(mine) == want, mode


def test_matching_in_onset_order(spark):
    """Chords, repeats and a long unbroken run: matched by close onsets alone, notes pair up in the order of onset and number."""
    rnd = random.Random(8)
    notes = {"ref": [], "est": []}
    for s, n in [(f"s{k}", 12) for k in range(20)] + [("long", 6000)]:
        for rows in notes.values():
            rows += [(s, i, rnd.randrange(0, 2 * n) * 0.01, 100.0, rnd.choice([60, 64, 72])) for i in range(n)]
    cols = "song_id string, {} bigint, onset_s double, offset_s double, pitch int"
    tables = [spark.createDataFrame(rows, cols.format(f"{k}_idx")) for k, rows in notes.items()]
    got = {(r["song_id"], r["ref_idx"], r["est_idx"]) for r in X.match_notes(X.match_candidates(*tables), ("COn",)).collect()}
    want = set()
    for s in {r[0] for r in notes["ref"]}:
        rs, es = (sorted((n[2], n[1]) for n in rows if n[0] == s) for rows in notes.values())
        while rs and es:
            near = round(abs(rs[0][0] - es[0][0]), 4) <= 0.05
            if near:
                want.add((s, rs[0][1], es[0][1]))
            ahead = rs[0][0] < es[0][0]
            rs, es = rs[near or ahead:], es[near or not ahead:]
    assert got == want


def test_matching_modes(spark):
    cols = "song_id string, {} bigint, onset_s double, offset_s double, pitch int"
    ref = spark.createDataFrame([("a", 0, 1.0, 2.0, 60), ("a", 1, 3.0, 4.0, 60), ("g", 0, 1.0, 2.0, 60), ("g", 1, 1.04, 2.0, 60), ("n", 0, 0.0, 1.0, 60)], cols.format("ref_idx"))
    est = spark.createDataFrame([("a", 0, 1.0, 2.0, 72), ("a", 1, 3.0, 4.6, 60), ("g", 0, 1.03, 2.0, 60), ("g", 1, 0.96, 2.0, 60)], cols.format("est_idx"))
    prf = X.note_prf(ref, est, X.match_notes(X.match_candidates(ref, est)))
    got = {(r["song_id"], r["mode"]): r for r in prf.collect()}
    size = lambda s, m: got[(s, m)]["matched"]
    assert (size("a", "COnP"), size("a", "COnPC"), size("a", "COnPOff")) == (1, 2, 0)
    assert size("g", "COn") == 2  # taking the nearest pair first would leave one note over
    assert got[("n", "COn")]["f1"] == 0.0 and got[("n", "COn")]["pitch_mse"] == float("inf")


def test_decode_poly(spark):
    rows = []
    for f in range(60):
        for p, on, start, end in ((60, 0.9, 10, 30), (61, 0.6, 10, 30), (70, 0.8, 40, 50)):
            onset = on if f == start else on / 3 if abs(f - start) == 1 else 0.0
            rows.append(("a", f, p, onset, 0.8 if start <= f < end else 0.0))
    post = spark.createDataFrame(rows, "song_id string, frame bigint, pitch int, onset_p double, frame_p double")
    got = D.decode_poly(post, [(0.5, 0.3)], infer_onsets=False)
    found = sorted((round(r["onset_s"] * 62.5), round(r["offset_s"] * 62.5), r["pitch"]) for r in got.collect())
    # Both adjacent pitches peak at frame 10; the higher one is visited first and takes the energy of the other.
    assert found == [(10, 30, 61), (40, 50, 70)]
    assert D.decode_poly(post, [(0.5, 0.3), (0.95, 0.3)], infer_onsets=False).filter("onset_thresh > 0.9").count() == 0


def test_decode_poly_to_the_end_of_a_song(spark):
    """A missing cell is silence, so a note whose last cell is the last one stored ends a frame later if the song goes on."""
    rows = [("a", f, 60, 0.9 if f == 10 else 0.0, 0.8) for f in range(9, 20)]
    post = spark.createDataFrame(rows, "song_id string, frame bigint, pitch int, onset_p double, frame_p double")
    ends = lambda n: [round(r["offset_s"], 3) for r in D.decode_poly(post, [(0.5, 0.3)], infer_onsets=False, lengths=n).collect()]
    assert ends(None) == [0.304]
    assert ends(spark.createDataFrame([("a", 40)], "song_id string, n_frames bigint")) == [0.32]


def test_threshold_sweep_equals_single_decodings(spark):
    rows = [
        ("ab"[k % 2], f, p, on if f == start else 0.0, fr if start <= f < end else 0.0)
        for k, (p, on, fr, start, end) in enumerate([(60, 0.9, 0.8, 10, 30), (64, 0.6, 0.4, 5, 25), (70, 0.8, 0.3, 40, 50), (72, 0.4, 0.9, 30, 60)])
        for f in range(start - 2, end + 2)
    ]
    post = spark.createDataFrame(rows, "song_id string, frame bigint, pitch int, onset_p double, frame_p double").coalesce(1)
    ref = spark.createDataFrame([("a", 0, 0.16, 0.48, 60), ("a", 1, 0.64, 0.8, 70), ("b", 0, 0.08, 0.4, 64), ("c", 0, 0.0, 1.0, 60)], "song_id string, ref_idx int, onset_s double, offset_s double, pitch int")
    lengths = spark.createDataFrame([(s, 100) for s in "abc"], "song_id string, n_frames bigint")
    swept = X.threshold_sweep(post, ref, onset_grid=(0.5,), frame_grid=(0.2, 0.5), mode="COn", lengths=lengths)
    got = {(r["onset_thresh"], r["frame_thresh"]): r for r in swept.collect()}
    for pair, row in got.items():
        est = D.decode_poly(post, [pair], lengths=lengths).withColumn("est_idx", F.monotonically_increasing_id())
        f1 = {r["song_id"]: r["f1"] for r in X.note_prf(ref, est, X.match_notes(X.match_candidates(ref, est), ("COn",))).filter("mode = 'COn'").collect()}
        assert row["mean_f1"] == pytest.approx(sum(f1.values()) / 3) and row["n_est"] == est.count() and row["songs"] == 3
    best = X.best_thresholds(swept).first()
    assert best["mean_f1"] == max(r["mean_f1"] for r in got.values()) > 0


def test_spaced_peaks(spark):
    peaks = spark.createDataFrame([("a", 1, 0.5), ("a", 3, 0.9), ("a", 5, 0.6), ("a", 20, 0.4)], "song_id string, frame bigint, height double")
    got = sorted(r["frame"] for r in D.spaced_peaks(peaks, 4).collect())
    assert got == [3, 20]
