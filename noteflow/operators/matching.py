"""Transcription metrics: candidate pairs, one-to-one matching, precision, recall and F1."""

from __future__ import annotations

import heapq
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noteflow.operators.decode import ENERGY_TOL_FRAMES, FRAME_S, MIN_NOTE_FRAMES, decode_poly, decodings_by_part, lists_of, song_rows, sounding_lists
from noteflow.operators.scan import BLK, by_size, interval_join, join_dimension, ordered_scan, place

# The match modes and what each one asks of a pair beyond the onset.
MODES = {
    "COn": (), "COnP": ("pitch_ok",), "COnOff": ("offset_ok",), "COnPOff": ("pitch_ok", "offset_ok"),
    "COnPC": ("class_ok",), "COnPCOff": ("class_ok", "offset_ok"),
}
ONSET_TOL_S = 0.05
OFFSET_MIN_TOL_S = 0.05
OFFSET_RATIO = 0.2
PITCH_TOL_CENTS = 50.0
# The threshold grid of the sweep.
ONSET_GRID = tuple(float(x) for x in np.linspace(0.1, 0.9, 5))
FRAME_GRID = tuple(float(x) for x in np.linspace(0.03, 0.9, 10))


def match_candidates(ref: DataFrame, est: DataFrame, onset_tol: float | str = ONSET_TOL_S, bin_s: float = 4.0) -> DataFrame:
    """Pairs whose onsets are close, with the pitch, pitch-class and offset tests of each.

    ``onset_tol`` is a number or a column of ``ref``. Distances are compared at four decimals.
    """
    tol = F.col(onset_tol) if isinstance(onset_tol, str) else F.lit(onset_tol)
    r = ref.withColumn("_tol", tol)
    e = est.select(
        "song_id", *[c for c in est.columns if c not in ("song_id", "onset_s", "offset_s", "pitch")],
        F.col("onset_s").alias("e_on"), F.col("offset_s").alias("e_off"), F.col("pitch").alias("e_pitch"),
    )
    reach = F.col("_tol") + 1e-4
    pairs = interval_join(
        r, e, ["song_id"], (F.col("onset_s") - reach, F.col("onset_s") + reach), (F.col("e_on"), F.col("e_on")), bin_s
    )
    near = F.round(F.abs(F.col("onset_s") - F.col("e_on")), 4) <= F.col("_tol")
    dur = F.col("offset_s") - F.col("onset_s")
    off_tol = F.greatest(F.lit(OFFSET_RATIO) * dur, F.lit(OFFSET_MIN_TOL_S))
    step = PITCH_TOL_CENTS / 100.0
    gap = F.abs(F.pmod("pitch", F.lit(12)) - F.pmod("e_pitch", F.lit(12)))
    return pairs.filter(near).withColumns({
        "pitch_ok": F.abs(F.col("pitch") - F.col("e_pitch")) <= step,
        "class_ok": gap <= step,
        "offset_ok": F.round(F.abs(F.col("offset_s") - F.col("e_off")), 4) <= off_tol,
    }).drop("_tol")


def _kuhn(left: np.ndarray, right: np.ndarray) -> list[int]:
    """Positions of the edges of a maximum matching; edges listed earlier are preferred."""
    edges: dict[int, list[int]] = {}
    for pos, a in enumerate(left):
        edges.setdefault(int(a), []).append(pos)
    taken: dict[int, int] = {}

    def place(a: int, seen: set) -> bool:
        # Depth-first search over alternating paths, with its own stack.
        stack = [(a, iter(edges[a]))]
        path: list[int] = []
        while stack:
            node, it = stack[-1]
            for pos in it:
                b = int(right[pos])
                if b in seen:
                    continue
                seen.add(b)
                path.append(pos)
                if b not in taken:
                    for p in path:
                        taken[int(right[p])] = p
                    return True
                nxt = int(left[taken[b]])
                stack.append((nxt, iter(edges[nxt])))
                break
            else:
                stack.pop()
                if path:
                    path.pop()
        return False

    for a in edges:
        place(a, set())
    return list(taken.values())


def _sweep(ref: np.ndarray, at: np.ndarray, onset: np.ndarray) -> np.ndarray | None:
    """Positions of the edges of a maximum matching, or None if the partners of some reference note have gaps.

    ``at`` numbers the estimated notes in order. Each takes, of the free reference notes it is close to, the one whose
    last partner comes first; of those the one with the earliest onset, then the smallest number.
    """
    n_ref, n_est = int(ref.max()) + 1, int(at.max()) + 1
    first, last, starts_at = np.full(n_ref, n_est), np.zeros(n_ref, dtype=np.int64), np.zeros(n_ref)
    np.minimum.at(first, ref, at)
    np.maximum.at(last, ref, at)
    if np.any(last - first + 1 != np.bincount(ref)):
        return None
    starts_at[ref] = onset
    coming, k = np.argsort(first, kind="stable"), 0
    free: list[tuple[int, float, int]] = []
    taken = []
    for p in range(n_est):
        while k < n_ref and first[coming[k]] == p:
            r = coming[k]
            heapq.heappush(free, (int(last[r]), float(starts_at[r]), int(r)))
            k += 1
        while free and free[0][0] < p:
            heapq.heappop(free)
        if free:
            taken.append(heapq.heappop(free)[2] * n_est + p)
    code = ref.astype(np.int64) * n_est + at
    order = np.argsort(code)
    return order[np.searchsorted(code[order], np.array(taken, dtype=np.int64))]


def _stripe(pdf: pd.DataFrame, tests: tuple) -> np.ndarray:
    """What estimated notes are ordered by before their onset: pairs of a mode with a pitch test stay within it."""
    if "pitch_ok" in tests:
        return pdf["e_pitch"].to_numpy()
    return pdf["e_pitch"].to_numpy() % 12 if "class_ok" in tests else np.zeros(len(pdf))


def _match_block(pdf: pd.DataFrame, modes: list[str]) -> pd.DataFrame:
    """Matched pairs of every mode for rows that hold whole islands."""
    out = []
    group = pdf.groupby(["_key", "_island"], sort=False).ngroup().to_numpy()
    for mode in modes:
        mask = np.ones(len(pdf), dtype=bool)
        for test in MODES[mode]:
            mask &= pdf[test].to_numpy()
        pos = np.flatnonzero(mask)
        if not pos.size:
            continue
        g = group[pos].astype(np.int64)
        # One code per note: its island in the high part, its index in the low part.
        r = (g << 32) | pdf["ref_idx"].to_numpy()[pos].astype(np.int64)
        e = (g << 32) | pdf["est_idx"].to_numpy()[pos].astype(np.int64)
        _, ri, rc = np.unique(r, return_inverse=True, return_counts=True)
        _, ei, ec = np.unique(e, return_inverse=True, return_counts=True)
        alone = (rc[ri] == 1) & (ec[ei] == 1)
        keep = [pos[alone]]
        rest = np.flatnonzero(~alone)
        if rest.size:
            held = pdf.iloc[pos[rest]]
            _, ref = np.unique(ri[rest], return_inverse=True)
            # Estimated notes by island, stripe, onset and number.
            by = np.lexsort((held["est_idx"], held["e_on"], _stripe(held, MODES[mode]), g[rest]))
            fresh = np.diff(ei[rest][by], prepend=-1) != 0
            at = np.empty(len(by), dtype=np.int64)
            at[by] = np.cumsum(fresh) - 1
            got = _sweep(ref, at, held["onset_s"].to_numpy())
            if got is None:
                got = np.argsort(held["_dist"].to_numpy(), kind="stable")
                got = got[_kuhn(ref[got], at[got])]
            keep.append(pos[rest[got]])
        chosen = pdf.iloc[np.concatenate(keep)].copy()
        chosen["mode"] = mode
        out.append(chosen)
    return pd.concat(out) if out else pdf.iloc[:0].assign(mode="")


def match_notes(candidates: DataFrame, modes: tuple = tuple(MODES), keys: tuple = ("song_id",)) -> DataFrame:
    """One-to-one maximum matching per mode: (keys, mode, ref_idx, est_idx, pitch_error).

    Pairs that share a note overlap in time, so stretches between which no pair reaches across are
    independent: the matching of a long song is the sum over them. Pairs without a rival are taken
    by array operations. Where the partners of each note follow each other without a gap, as close onsets do, one sweep
    with a heap of last partners matches the others, in the order of onset and number; else augmenting paths do.
    """
    key = F.concat_ws("\x1f", *keys) if len(keys) > 1 else F.col(keys[0])
    pairs = candidates.select(
        *keys, key.alias("_key"), "ref_idx", "est_idx", F.least("onset_s", "e_on").alias("_from"),
        F.greatest("onset_s", "e_on").alias("_to"), F.abs(F.col("onset_s") - F.col("e_on")).alias("_dist"),
        (F.col("e_pitch") - F.col("pitch")).cast("double").alias("pitch_error"), "onset_s", "e_on", "e_pitch", "pitch_ok", "class_ok", "offset_ok",
    )
    order = ["_from", "ref_idx", "est_idx"]
    pairs, cut = place(pairs, "_key", order)
    seen = ordered_scan(pairs, "_key", order, max_before={"_held": "_to"}, cut=cut)
    opens = F.col("_held").isNull() | (F.col("_from") > F.col("_held"))
    marked = seen.withColumn("_open", F.when(opens, F.col("_from")))
    placed = ordered_scan(marked, "_key", order, max_before={"_last": "_open"}, cut=cut)
    placed = placed.withColumn("_island", F.coalesce("_open", "_last")).drop("_open", "_last", "_held", "_from", "_to", BLK)
    out_schema = T.StructType(
        [f for f in placed.schema.fields if f.name in keys]
        + list(T.StructType.fromDDL("mode string, ref_idx bigint, est_idx bigint, pitch_error double").fields)
    )
    wanted = list(modes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            if not len(pdf):
                continue
            last = pdf.iloc[-1]
            same = ((pdf["_key"] == last["_key"]) & (pdf["_island"] == last["_island"])).to_numpy()
            held = pdf[same]
            if not same.all():
                yield _match_block(pdf[~same].reset_index(drop=True), wanted)[out_schema.fieldNames()]
        if held is not None and len(held):
            yield _match_block(held.reset_index(drop=True), wanted)[out_schema.fieldNames()]

    spread = placed.repartition("_key", "_island").sortWithinPartitions("_key", "_island", "ref_idx", "est_idx")
    return spread.mapInPandas(run, out_schema)


def _prf(matched: Column, n_ref: Column, n_est: Column) -> tuple[Column, Column, Column]:
    p = F.when(n_est > 0, matched / n_est).otherwise(0.0)
    r = F.when(n_ref > 0, matched / n_ref).otherwise(0.0)
    return p, r, F.when(p + r > 0, 2.0 * p * r / (p + r)).otherwise(0.0)


def note_prf(ref: DataFrame, est: DataFrame, matches: DataFrame) -> DataFrame:
    """Precision, recall, F1 per song and mode; zeros and an infinite pitch error without matches."""
    n_ref = ref.groupBy("song_id").agg(F.count(F.lit(1)).alias("n_ref"))
    n_est = est.groupBy("song_id").agg(F.count(F.lit(1)).alias("n_est"))
    modes = F.explode(F.array(*[F.lit(m) for m in MODES]))
    got = matches.groupBy("song_id", "mode").agg(F.count(F.lit(1)).alias("matched"), F.avg(F.pow("pitch_error", F.lit(2.0))).alias("_mse"))
    base = n_ref.join(n_est, "song_id", "left").withColumn("mode", modes).join(got, ["song_id", "mode"], "left")
    base = base.withColumns({"n_est": F.coalesce("n_est", F.lit(0)), "matched": F.coalesce("matched", F.lit(0))})
    p, r, f1 = _prf(F.col("matched"), F.col("n_ref"), F.col("n_est"))
    mse = F.when(F.col("mode") == "COn", F.coalesce("_mse", F.lit(float("inf"))))
    return base.select("song_id", "mode", "n_ref", "n_est", "matched", p.alias("precision"), r.alias("recall"), f1.alias("f1"), mse.alias("pitch_mse"))


def f1_by_status_source(scores: DataFrame, m: DataFrame) -> DataFrame:
    """Mean F1 and count overall, by verdict and by source; a NULL F1 (no reference) is left out."""
    source = F.concat_ws("/", "lane", "voice_id", F.nullif("augmentation_profile", F.lit("")))
    rec = m.select("sample_id", F.coalesce("verdict.status", F.lit("?")).alias("status"), source.alias("source"))
    joined = scores.filter("f1 IS NOT NULL").join(rec, "sample_id").select("f1", "status", "source")
    joined = joined.groupingSets([[], [F.col("status")], [F.col("source")]], "status", "source")
    return joined.agg(F.avg("f1").alias("note_f1_mean"), F.count(F.lit(1)).alias("n"))


def metric_by_source(scores: DataFrame, m: DataFrame) -> DataFrame:
    rec = m.select("sample_id", "lane", "voice_id", F.coalesce("augmentation_profile", F.lit("")).alias("profile"))
    return scores.join(rec, "sample_id").groupBy("lane", "voice_id", "profile").agg(F.avg("f1").alias("f1"), F.count(F.lit(1)).alias("n"))


def _within(a: float, b: float, tol: float) -> bool:
    """Whether two times are no more than ``tol`` apart at four decimals, rounded like a column."""
    d = abs(a - b)
    if abs(d - tol) > 1e-4:
        return d < tol
    return float(Decimal(repr(d)).quantize(Decimal("0.0001"), ROUND_HALF_UP)) <= tol


class _Scorer:
    """Sizes of maximum matchings of one song's reference notes (onset, offset, pitch, tolerance), in order of onset, with decoded notes, as ``match_notes`` finds them.

    The partners of a part's notes are looked up once for each way the part is decoded. Parts in which no note has a rival, and that share no
    partner, just add up.
    """

    def __init__(self, ref: list[tuple], tests: tuple):
        self.ref, self.tests = ref, tests
        self.onsets = [r[0] for r in ref]
        self.reach = max(r[3] for r in ref) + 2e-4
        self.known: dict[int, tuple] = {}

    def _partners(self, e_on: float, e_off: float, e_pitch: int) -> list[int]:
        step, out = PITCH_TOL_CENTS / 100.0, []
        for i in range(bisect_left(self.onsets, e_on - self.reach), bisect_right(self.onsets, e_on + self.reach)):
            on, off, pitch, tol = self.ref[i]
            if "pitch_ok" in self.tests and abs(pitch - e_pitch) > step or "class_ok" in self.tests and abs(pitch % 12 - e_pitch % 12) > step:
                continue
            if _within(on, e_on, tol) and ("offset_ok" not in self.tests or _within(off, e_off, max(OFFSET_RATIO * (off - on), OFFSET_MIN_TOL_S))):
                out.append(i)
        return out

    def _part(self, notes: list) -> tuple:
        """Its (note, partner) pairs, the partners, and whether no note has a rival. Kept by the list itself, which the song's decodings hold."""
        got = self.known.get(id(notes))
        if got is None:
            pairs = [(k, i) for k, (a, b, p) in enumerate(notes) for i in self._partners(a * FRAME_S, b * FRAME_S, p)]
            refs = {i for _, i in pairs}
            alone = len(refs) == len(pairs) == len({k for k, _ in pairs})
            got = self.known[id(notes)] = pairs, refs, alone
        return got

    def matched(self, parts: list[list]) -> int:
        held, n, plain = set(), 0, True
        for notes in parts:
            pairs, refs, alone = self._part(notes)
            plain = plain and alone and held.isdisjoint(refs)
            held |= refs
            n += len(pairs)
        if plain:
            return n
        left = [i for notes in parts for _, i in self._part(notes)[0]]
        right = [(at, k) for at, notes in enumerate(parts) for k, _ in self._part(notes)[0]]
        number = {x: j for j, x in enumerate(dict.fromkeys(right))}
        return len(_kuhn(left, [number[x] for x in right]))


def _song_scores(post: DataFrame, ref: DataFrame, grid: list, mode: str, onset_tol: float | str, lengths: DataFrame | None) -> DataFrame:
    """Sums of F1 and of found notes for every pair of the grid, over songs that one task may hold.

    A song's cells meet its reference notes in one row. Pairs that decode alike share one decoding and one matching, and
    a batch of songs returns one row per pair.
    """
    cells = song_rows(post, lengths)
    tol = F.col(onset_tol) if isinstance(onset_tol, str) else F.lit(onset_tol)
    note = F.struct("onset_s", "offset_s", F.col("pitch").alias("pitch"), tol.cast("double").alias("tol"))
    rows = cells.join(ref.groupBy("song_id").agg(F.sort_array(F.collect_list(note)).alias("ref")).hint("merge"), "song_id")
    tests, at = MODES[mode], np.array(grid, dtype=float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, count = [0.0] * len(grid), [0] * len(grid)
            refs, frames = list(lists_of(batch, "ref")), batch.column("n_frames").to_pylist()
            for song, pitch, frame, value, peak in sounding_lists(batch, grid, True, 24, 127):
                scorer, scored = _Scorer(list(zip(*refs[song])), tests), {}
                for k, found in enumerate(decodings_by_part(frame, pitch, value, peak, frames[song], grid, ENERGY_TOL_FRAMES, MIN_NOTE_FRAMES)):
                    if not found:
                        continue
                    if id(found) not in scored:
                        m, n = scorer.matched(found), sum(map(len, found))
                        p, r = m / n, m / len(scorer.ref)
                        scored[id(found)] = 2.0 * p * r / (p + r) if m else 0.0, n
                    total[k] += scored[id(found)][0]
                    count[k] += scored[id(found)][1]
            yield pa.RecordBatch.from_arrays([pa.array(at[:, 0]), pa.array(at[:, 1]), pa.array(total), pa.array(count, pa.int64())], ["onset_thresh", "frame_thresh", "s", "n_est"])

    return rows.mapInArrow(run, "onset_thresh double, frame_thresh double, s double, n_est bigint")


def _long_song_scores(post: DataFrame, ref: DataFrame, grid: list, mode: str, onset_tol: float | str, lengths: DataFrame | None) -> DataFrame:
    """The same for songs that are cut: their notes and pairs are rows."""
    est = decode_poly(post, grid, lengths=lengths)
    keys = ("song_id", "onset_thresh", "frame_thresh")
    est = est.withColumn("est_idx", F.rint(F.col("onset_s") * 62.5).cast("long") * 128 + F.col("pitch"))
    pairs = match_candidates(ref, est, onset_tol)
    got = match_notes(pairs, (mode,), keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("matched"))
    n_est = est.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_est"))
    n_ref = ref.groupBy("song_id").agg(F.count(F.lit(1)).alias("n_ref"))
    p, r, f1 = _prf(F.coalesce("matched", F.lit(0)), F.col("n_ref"), F.col("n_est"))
    per = n_est.join(got, list(keys), "left").join(n_ref, "song_id").withColumn("f1", f1)
    return per.groupBy("onset_thresh", "frame_thresh").agg(F.sum("f1").alias("s"), F.sum("n_est").alias("n_est"))


def threshold_sweep(
    post: DataFrame, ref: DataFrame, *, onset_grid: tuple = ONSET_GRID, frame_grid: tuple = FRAME_GRID,
    mode: str = "COnPOff", onset_tol: float | str = ONSET_TOL_S, lengths: DataFrame | None = None, sizes: DataFrame | None = None,
) -> DataFrame:
    """Mean F1 over all songs of every (onset, frame) threshold pair; see ``best_thresholds``. ``lengths`` and ``sizes`` as in ``decode_poly``.

    Songs where a pair finds nothing count as zero without being listed.
    """
    grid = [(a, b) for a in onset_grid for b in frame_grid]
    songs = ref.select("song_id").distinct().agg(F.count(F.lit(1)).alias("songs"))
    small, large = by_size(post, "song_id", sizes=sizes)
    sums = _song_scores(small, ref, grid, mode, onset_tol, lengths)
    if large is not None:
        sums = sums.unionByName(_long_song_scores(large, ref, grid, mode, onset_tol, lengths))
    sums = sums.groupBy("onset_thresh", "frame_thresh").agg(F.sum("s").alias("s"), F.sum("n_est").alias("n_est"))
    cells = F.explode(F.array(*[F.struct(F.lit(a).alias("onset_thresh"), F.lit(b).alias("frame_thresh")) for a, b in grid]))
    return (
        songs.select("songs", cells.alias("g")).select("songs", "g.*")  # one row per pair of the grid
        .join(F.broadcast(sums), ["onset_thresh", "frame_thresh"], "left")
        .select(
            "onset_thresh", "frame_thresh", "songs", F.coalesce("n_est", F.lit(0)).alias("n_est"),
            (F.coalesce("s", F.lit(0.0)) / F.col("songs")).alias("mean_f1"),
        )
    )


def best_thresholds(sweep: DataFrame) -> DataFrame:
    """The pair with the highest mean F1; the first in grid order on ties."""
    rank = F.struct((-F.round("mean_f1", 12)).alias("r"), "onset_thresh", "frame_thresh", "mean_f1")
    return sweep.agg(F.min(rank).alias("b")).select("b.onset_thresh", "b.frame_thresh", "b.mean_f1")


def metrics_by_dataset(per_song: DataFrame, datasets: DataFrame) -> DataFrame:
    """Mean metrics of every dataset; ``datasets`` maps songs to their dataset."""
    return per_song.join(datasets, "song_id").groupBy("dataset", "mode").agg(
        F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.count(F.lit(1)).alias("songs")
    )


def test_metrics(per_song: DataFrame, datasets: DataFrame) -> DataFrame:
    """Means per dataset and over everything (dataset NULL)."""
    joined = per_song.join(datasets, "song_id")
    sets = joined.groupingSets([[F.col("dataset"), F.col("mode")], [F.col("mode")]], "dataset", "mode")
    return sets.agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.count(F.lit(1)).alias("songs"))


def with_tolerance(ref: DataFrame, datasets: DataFrame, tolerances: DataFrame) -> DataFrame:
    """Reference notes with the onset tolerance of their dataset."""
    named = ref.join(datasets, "song_id")
    return join_dimension(named, tolerances, ["dataset"], "inner")


def pitch_error_hist(matches: DataFrame) -> DataFrame:
    """Counts in unit bins from -12.5 to 12.5; the last bin is closed."""
    e = F.col("pitch_error")
    inside = matches.filter(e.between(-12.5, 12.5))
    bin_at = F.least(F.floor(e + 0.5), F.lit(12))
    return inside.groupBy(bin_at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def pitch_error_stats(matches: DataFrame) -> DataFrame:
    """Mean, population deviation and median over all errors, from one row per distinct error."""
    from noteflow.operators.scan import exact_percentiles

    got = exact_percentiles(matches, "pitch_error", [0.5])
    return matches.agg(
        F.count(F.lit(1)).alias("n"), F.avg("pitch_error").alias("mean"), F.stddev_pop("pitch_error").alias("std"),
        F.lit(got["values"][0]).cast("double").alias("median"),
    )
