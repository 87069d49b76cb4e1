"""The alignment gate: measured frames against labelled notes, and what follows from it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noteflow.functions.scalar import cents, midi_to_hz
from noteflow.operators.scan import BLK, all_small, ordered_scan, place, with_halo
from noteflow.operators.scores import next_onset
from noteflow.session import ensure_checkpoint_dir

@dataclass(frozen=True)
class Tolerances:
    """What the gate allows; the defaults are fixed values."""

    onset_ms: float = 50.0
    offset_min_ms: float = 50.0
    offset_fraction: float = 0.20
    f0_cents: float = 25.0
    f0_coverage: float = 0.80
    snr_floor_db: float = 0.0
    min_note_ms: float = 50.0
    #: Measured times are this much late.
    group_delay_ms: float = 0.0

    def offset_ms(self, duration_ms: Column) -> Column:
        return F.greatest(F.lit(self.offset_min_ms), F.lit(self.offset_fraction) * duration_ms)


DEFAULT = Tolerances()
CLIP_PEAK = 1.0 + 1e-6

#: Seconds of the time bins on which notes and frames meet, and frames of a block of the neighbour window.
BIN_S = 0.64
BLOCK_FRAMES = 4096


def note_windows(notes: DataFrame, tol: Tolerances = DEFAULT, whole: bool = False) -> DataFrame:
    """Search windows of every note: onset ± win, offset window capped at the next onset, sustain. ``whole`` as in ``next_onset``."""
    win = max(0.15, 3.0 * tol.onset_ms / 1000.0)
    dur = F.col("offset_s") - F.col("onset_s")
    off_tol = tol.offset_ms(dur * 1000.0)
    off_win = F.greatest(F.lit(win), off_tol / 1000.0)
    return next_onset(notes, whole).withColumns({
        "on_lo": F.col("onset_s") - win, "on_hi": F.col("onset_s") + win,
        "off_lo": F.col("offset_s") - off_win,
        "off_hi": F.least(F.col("offset_s") + off_win, F.col("next_onset_s")),
        "sus_lo": F.col("onset_s") + F.lit(0.1) * dur, "sus_hi": F.col("offset_s") - F.lit(0.1) * dur,
        "off_tol_ms": off_tol,
    })


def neighbour_frames(frames: DataFrame, delay_s: float = 0.0, block_frames: int = BLOCK_FRAMES, bin_s: float = BIN_S) -> DataFrame:
    """Frames by time bin with their pitch in cents and that of both neighbours.

    The logarithm is taken once per frame; against a note it is then a subtraction. The pitch is
    NULL where a frame is unvoiced. Neighbours are found by frame number, bins by the measured time less
    the delay, so any hop and any delay will do.
    """
    level = F.when(F.col("voiced"), cents("f0_hz", F.lit(440.0)))
    slim = frames.select("sample_id", "frame_idx", (F.col("t_s") - delay_s if delay_s else F.col("t_s")).alias("t_s"), level.alias("cents"))
    w = Window.partitionBy("sample_id", BLK).orderBy("frame_idx")
    look = {}
    for name, fn in (("prev", F.lag), ("next", F.lead)):
        look[f"{name}_cents"] = fn("cents").over(w)
        look[f"has_{name}"] = fn("frame_idx").over(w).isNotNull()
    near = with_halo(slim, "frame_idx", block_frames, before=1, after=1).withColumns(look).filter("_own").drop("_own")
    return near.withColumn(BLK, F.floor(F.col("t_s") / bin_s))


def _in_tune(level: str, tol: float = DEFAULT.f0_cents) -> Column:
    return F.coalesce(F.abs(F.col(level) - F.col("ref_cents")) <= tol, F.lit(False))


def _ref_cents() -> Column:
    return (F.col("pitch_midi") - 69) * 100.0


def note_frame_join(notes: DataFrame, frames: DataFrame, tol: Tolerances = DEFAULT, whole: bool = False) -> DataFrame:
    """Notes with every frame inside any of their windows, and the edge flags of that frame."""
    return _note_bins(notes, frames, tol, whole=whole).filter(F.col("t_s").between(F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")


def _note_bins(notes: DataFrame, frames: DataFrame, tol: Tolerances, bin_s: float = BIN_S, whole: bool = False) -> DataFrame:
    """Left join of notes and frames on (sample, time bin).

    A note is listed in each bin it touches, a frame in one. The optimizer does not see how many rows
    an explode makes, so the frames are kept from being broadcast. A note without frames stays.
    """
    wide = note_windows(notes, tol, whole).withColumnRenamed("score_id", "sample_id")
    lo = F.least("on_lo", "off_lo")
    hi = F.greatest("on_hi", "off_hi", "offset_s")
    bins = F.sequence(F.floor(lo / bin_s), F.floor(hi / bin_s))
    listed = wide.withColumns({"_lo": lo, "_hi": hi, "ref_cents": _ref_cents()}).withColumn(BLK, F.explode(bins))
    near = neighbour_frames(frames, tol.group_delay_ms / 1000.0, bin_s=bin_s)
    joined = listed.join(near.hint("merge"), ["sample_id", BLK], "left")
    tuned = joined.withColumns({
        "in_tune": _in_tune("cents", tol.f0_cents), "prev_tune": _in_tune("prev_cents", tol.f0_cents), "next_tune": _in_tune("next_cents", tol.f0_cents),
    })
    return tuned.withColumns({
        "rising": F.col("in_tune") & F.coalesce(F.col("has_prev"), F.lit(False)) & ~F.col("prev_tune"),
        "falling": F.col("in_tune") & F.coalesce(F.col("has_next"), F.lit(False)) & ~F.col("next_tune"),
    }).drop(BLK, "cents", "ref_cents", "prev_cents", "next_cents", "has_prev", "has_next", "prev_tune", "next_tune")


def note_checks(notes: DataFrame, frames: DataFrame, tol: Tolerances = DEFAULT, whole: bool = False) -> DataFrame:
    """Per note: nearest onset edge, last offset edge, sustained coverage, and the three verdicts.

    Only minima, maxima and counts, so partial aggregation happens before the shuffle.
    """
    t = F.col("t_s")
    in_on = t.between(F.col("on_lo"), F.col("on_hi"))
    in_off = t.between(F.col("off_lo"), F.col("off_hi"))
    in_sus = t.between(F.col("sus_lo"), F.col("sus_hi"))
    in_note = t.between(F.col("onset_s"), F.col("offset_s"))
    # The nearest edge is the last one at or before the onset or the first one after it.
    before, after = t <= F.col("onset_s"), t >= F.col("onset_s")
    agg = {
        "on_b": F.max(F.when(F.col("rising") & in_on & before, t)),
        "on_a": F.min(F.when(F.col("rising") & in_on & after, t)),
        "any_b": F.max(F.when(F.col("in_tune") & in_on & before, t)),
        "any_a": F.min(F.when(F.col("in_tune") & in_on & after, t)),
        "off_edge": F.max(F.when(F.col("falling") & in_off, t)),
        "off_any": F.max(F.when(F.col("in_tune") & in_off, t)),
        "n_sus": F.count_if(in_sus), "c_sus": F.count_if(in_sus & F.col("in_tune")),
        "n_all": F.count_if(in_note), "c_all": F.count_if(in_note & F.col("in_tune")),
    }
    per = _note_bins(notes, frames, tol, whole=whole).groupBy(
        "sample_id", "note_idx", "onset_s", "offset_s", "off_tol_ms"
    ).agg(*[c.alias(n) for n, c in agg.items()])

    def nearest(b: str, a: str) -> Column:
        left, right = F.col("onset_s") - F.col(b), F.col(a) - F.col("onset_s")
        return (
            F.when(F.col(a).isNull(), F.col(b)).when(F.col(b).isNull(), F.col(a))
            .when(left <= right, F.col(b)).otherwise(F.col(a))
        )

    edge = nearest("on_b", "on_a")
    found = per.withColumns({
        "onset_t": F.coalesce(edge, nearest("any_b", "any_a")),
        "offset_t": F.coalesce("off_edge", "off_any"),
        "coverage": F.when(F.col("n_sus") > 0, F.col("c_sus") / F.col("n_sus"))
        .when(F.col("n_all") > 0, F.col("c_all") / F.col("n_all")).otherwise(0.0),
    })
    checked = found.withColumns({
        "onset_dev_ms": F.abs(F.col("onset_t") - F.col("onset_s")) * 1000.0,
        "offset_dev_ms": F.abs(F.col("offset_t") - F.col("offset_s")) * 1000.0,
    })
    return checked.select(
        "sample_id", "note_idx", "onset_s", "offset_s", "onset_t", "offset_t", "onset_dev_ms", "offset_dev_ms", "off_tol_ms", "coverage",
        F.coalesce(F.col("onset_dev_ms") <= tol.onset_ms, F.lit(False)).alias("onset_ok"),
        F.coalesce(F.col("offset_dev_ms") <= F.col("off_tol_ms"), F.lit(False)).alias("offset_ok"),
        ((F.col("n_all") + F.col("n_sus") > 0) & (F.col("coverage") >= tol.f0_coverage)).alias("f0_ok"),
        ((F.col("offset_s") - F.col("onset_s")) * 1000.0 + 1e-6 < tol.min_note_ms).alias("short"),
    )


def verdict(checks: DataFrame, samples: DataFrame, snr_floor_db: float = DEFAULT.snr_floor_db) -> DataFrame:
    """Per sample: the three checks over all notes and the status by precedence.

    quarantined (level ratio) > rejected (clipping or a failed check) > flagged (short) > accepted.
    ``samples`` holds sample_id, snr_db, peak; a sample without notes is rejected.
    """
    per = checks.groupBy("sample_id").agg(
        F.bool_and("onset_ok").alias("onset_ok"), F.bool_and("offset_ok").alias("offset_ok"),
        F.bool_and("f0_ok").alias("f0_ok"), F.count_if("short").alias("n_short"),
        F.coalesce(F.max("onset_dev_ms"), F.lit(0.0)).alias("max_onset_dev_ms"),
        (F.count_if(~F.col("onset_ok")) + F.count_if(~F.col("offset_ok")) + F.count_if(~F.col("f0_ok"))).alias("n_reasons"),
    )
    empty = F.col("onset_ok").isNull()
    clip = F.coalesce(F.col("peak") > CLIP_PEAK, F.lit(False))
    noisy = F.coalesce(F.col("snr_db") < snr_floor_db, F.lit(False))
    status = (
        F.when(empty, "rejected").when(noisy, "quarantined")
        .when(clip | ~(F.col("onset_ok") & F.col("offset_ok") & F.col("f0_ok")), "rejected")
        .when(F.col("n_short") > 0, "flagged").otherwise("accepted")
    )
    ok = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return samples.join(per, "sample_id", "left").select(
        "sample_id", status.alias("status"), ok("onset_ok"), ok("offset_ok"), ok("f0_ok"), "snr_db",
        (~empty & clip).alias("clipping"), (~empty & noisy).alias("snr_fail"),
        F.coalesce("n_short", F.lit(0)).alias("n_short"), F.coalesce("n_reasons", F.lit(0)).alias("n_reasons"),
        F.coalesce("max_onset_dev_ms", F.lit(0.0)).alias("max_onset_dev_ms"),
    )


def verdict_reasons(checks: DataFrame, samples: DataFrame, tol: Tolerances = DEFAULT) -> DataFrame:
    """One row per failed check, in the order (note_idx, seq) a report lists them.

    A table instead of one string per sample: a long sample may fail in very many notes. Reasons of the
    sample as a whole (clipping, level ratio) have no note; a short note is a reason unless the sample is
    rejected. ``samples`` holds sample_id, snr_db, peak.
    """
    text = lambda fmt, *cols: F.format_string(fmt, "note_idx", *cols)
    pct = F.format_string("%.0f%%", F.bround(F.col("coverage") * 100))
    onset = F.when(F.col("onset_t").isNull(), text("note %d: no in-tune onset detected")).otherwise(
        text(f"note %d: onset off by %.0f ms (> {tol.onset_ms:.0f} ms)", "onset_dev_ms")
    )
    offset = F.when(F.col("offset_t").isNull(), text("note %d: no in-tune offset detected")).otherwise(
        text("note %d: offset off by %.0f ms (> %.0f ms)", "offset_dev_ms", "off_tol_ms")
    )
    # Judged by sample and told by note: written out once instead of measured twice.
    ensure_checkpoint_dir(checks.sparkSession)
    checks = checks.checkpoint()
    f0 = text(f"note %d: f0 in tune for %s of the note (< {tol.f0_coverage * 100:.0f}%%)", pct)
    judged = verdict(checks, samples, tol.snr_floor_db)
    told = checks.join(judged.select("sample_id", "status"), "sample_id")
    short = F.when(F.col("short") & (F.col("status") != "rejected"), text(f"note %d: shorter than min_note_ms={tol.min_note_ms:.1f}"))
    reasons = F.array(
        F.when(~F.col("onset_ok"), onset), F.when(~F.col("offset_ok"), offset), F.when(~F.col("f0_ok"), f0), short
    )
    notes = told.select("sample_id", "note_idx", F.posexplode(reasons).alias("seq", "reason"))
    whole = F.array(
        F.when(F.col("clipping"), F.format_string("clipping: peak=%.3f > 1.0", "peak")),
        F.when(F.col("snr_fail"), F.format_string(f"snr %.1f dB below floor {tol.snr_floor_db} dB", "snr_db")),
    )
    of_sample = judged.join(samples.select("sample_id", "peak"), "sample_id").select(
        "sample_id", F.lit(None).cast(checks.schema["note_idx"].dataType).alias("note_idx"), F.posexplode(whole).alias("k", "reason")
    ).select("sample_id", "note_idx", (F.col("k") + 4).alias("seq"), "reason")
    return notes.unionByName(of_sample).filter("reason IS NOT NULL")


def preserved_timing(rows: DataFrame, onset_tol_ms: float = DEFAULT.onset_ms) -> DataFrame:
    """Re-judge a mix over an untouched vocal by the measured note shift.

    A larger shift, a quarantine, clipping or a failed pitch check stands; otherwise the timing
    counts as kept and only a short-note flag remains.
    """
    reason = F.coalesce("reason", F.lit(""))
    stands = (
        (F.col("max_note_shift_ms") > onset_tol_ms) | (F.col("status") == "quarantined")
        | reason.contains("clipping") | ~F.col("f0_ok")
    )
    short = reason.contains("shorter than min_note_ms")
    return rows.withColumns({
        "status": F.when(stands, F.col("status")).when(short, "flagged").otherwise("accepted"),
        "onset_ok": F.col("onset_ok") | ~stands, "offset_ok": F.col("offset_ok") | ~stands,
        "reason": F.when(stands | short, F.col("reason")),
    })


def final_verdict(rows: DataFrame) -> DataFrame:
    """Largest of the lane's and the gate's onset deviation; a status forced by the lane wins."""
    forced = F.col("force_status").isNotNull()
    return rows.withColumns({
        "max_onset_dev_ms": F.greatest("max_onset_dev_ms", F.coalesce("lane_dev_ms", F.lit(0.0))),
        "reason": F.when(forced, F.coalesce("reject_reason", "reason")).otherwise(F.col("reason")),
        "status": F.coalesce("force_status", "status"),
    })


# --- labels from measurements ----------------------------------------------------------------


def edges(frames: DataFrame, pitch: DataFrame) -> DataFrame:
    """Rising and falling in-tune edges of frames against one reference pitch per sample."""
    near = neighbour_frames(frames).join(pitch, "sample_id").withColumn("ref_cents", _ref_cents())
    now, prev, nxt = _in_tune("cents"), _in_tune("prev_cents"), _in_tune("next_cents")
    return near.select(
        "sample_id", "frame_idx", (now & F.col("has_prev") & ~prev).alias("rising"), (now & F.col("has_next") & ~nxt).alias("falling")
    )


REL_FLOOR = 0.12
MIN_RUN_FRAMES = 2


def voiced_runs(rms: DataFrame) -> DataFrame:
    """Runs of two or more frames above 0.12 of the sample's loudest: (sample, run_idx, first, last).

    Frame positions are dense, so a run starts where the frame before is not loud.
    """
    small = all_small(rms, "sample_id")
    if small:
        # One sort does for the loudest frame and all scans.
        w = Window.partitionBy("sample_id").orderBy("frame_idx").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        near = rms.withColumn("_peak", F.max("rms").over(w)).filter("_peak > 0")
    else:
        peaks = rms.groupBy("sample_id").agg(F.max("rms").alias("_peak")).filter("_peak > 0")
        near = rms.join(peaks, "sample_id")
    loud = near.filter(F.col("rms") > REL_FLOOR * F.col("_peak")).select("sample_id", "frame_idx", "t_s")
    loud, cut = (loud, False) if small else place(loud, "sample_id", ["frame_idx"])
    seen = ordered_scan(loud, "sample_id", ["frame_idx"], lag={"_p": "frame_idx"}, cut=cut)
    opens = F.coalesce(F.col("frame_idx") - F.col("_p") > 1, F.lit(True))
    marked = seen.withColumn("_s", F.when(opens, F.col("frame_idx")))
    grouped = ordered_scan(marked, "sample_id", ["frame_idx"], max_before={"_l": "_s"}, cut=cut)
    runs = grouped.groupBy("sample_id", F.coalesce("_s", "_l").alias("first")).agg(
        F.max("frame_idx").alias("last"), F.min("t_s").alias("t_first"), F.max("t_s").alias("t_last")
    ).filter(F.col("last") - F.col("first") + 1 >= MIN_RUN_FRAMES)
    ranked = ordered_scan(runs, "sample_id", ["first"], row_number="_rn", cut=False if small else None)
    return ranked.withColumn("run_idx", F.col("_rn") - 1).drop("_rn")


def pair_segments(notes: DataFrame, runs: DataFrame, frame_s: float, parts: int | None = None) -> DataFrame:
    """Each note with its voiced run: by rank when the counts agree, otherwise by nearest centre.

    The nearest run is the last centre at or before the note's centre or the first one after it, so
    notes and runs are merged on one time axis instead of forming all pairs. ``parts``: the number of partitions by
    score in which the notes lie, where no score had to be cut.
    """
    # One row per run, used three times below: written out once instead of measured three times.
    ensure_checkpoint_dir(runs.sparkSession)
    runs = runs.checkpoint()
    whole = parts is not None and all_small(runs, "sample_id")
    if whole:
        runs = runs.repartition(parts, "sample_id")
    sizes = notes.groupBy("score_id").agg(F.count(F.lit(1)).alias("n_notes"))
    run_sizes = runs.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_runs")).withColumnRenamed("sample_id", "score_id")
    both = sizes.join(run_sizes, "score_id", "left")
    r = runs.withColumnRenamed("sample_id", "score_id").withColumn("centre", (F.col("t_first") + F.col("t_last") + frame_s) / 2.0)
    n = notes.join(both, "score_id").withColumn("centre", (F.col("onset_s") + F.col("offset_s")) / 2.0)
    by_rank = n.filter("n_notes = n_runs").join(
        r.select("score_id", F.col("run_idx").alias("_rank"), "run_idx", "t_first", "t_last"),
        (n["score_id"] == r["score_id"]) & (n["note_idx"] == F.col("_rank")), "left",
    ).select(n["score_id"], "note_idx", "run_idx", "t_first", "t_last")
    axis = n.filter("n_runs IS NULL OR n_notes <> n_runs").select(
        "score_id", "centre", F.lit(1).alias("_kind"), F.col("note_idx").cast("long").alias("_i"), F.lit(None).cast("struct<centre:double,run_idx:bigint,t_first:double,t_last:double>").alias("_run")
    ).unionByName(
        r.join(both.filter("n_notes <> n_runs"), "score_id", "left_semi").select(
            "score_id", "centre", F.lit(0).alias("_kind"), F.col("run_idx").cast("long").alias("_i"),
            F.struct("centre", F.col("run_idx").cast("long").alias("run_idx"), "t_first", "t_last").alias("_run"),
        )
    )
    order = ["centre", "_kind", "_i"]
    up = ordered_scan(axis, "score_id", order, max_before={"_before": "_run"}, cut=False if whole else None)
    down = up.withColumns({"_nc": -F.col("centre"), "_nk": -F.col("_kind"), "_ni": -F.col("_i"),
                           "_flip": F.when(F.col("_run").isNotNull(), F.struct((-F.col("_run.centre")).alias("c"), (-F.col("_run.run_idx")).alias("i"), F.col("_run").alias("r")))})
    looked = ordered_scan(down, "score_id", ["_nc", "_nk", "_ni"], max_before={"_after": "_flip"}, cut=False if whole else None)
    a, b = F.col("_before"), F.col("_after.r")
    near = F.when(b.isNull() | (F.abs(a["centre"] - F.col("centre")) <= F.abs(b["centre"] - F.col("centre"))), a).otherwise(b)
    near = F.when(a.isNull(), b).otherwise(near)
    by_centre = looked.filter("_kind = 1").withColumn("_got", near).select(
        "score_id", F.col("_i").cast("int").alias("note_idx"), F.col("_got.run_idx").alias("run_idx"),
        F.col("_got.t_first").alias("t_first"), F.col("_got.t_last").alias("t_last"),
    )
    return by_rank.unionByName(by_centre)


def derive_labels(notes: DataFrame, rms: DataFrame, hop_s: float, group_delay_s: float = 0.0, parts: int | None = None) -> DataFrame:
    """Onset and offset of each note from its voiced run; a note without runs keeps its own. ``parts`` as in ``pair_segments``."""
    frame_s = 2 * hop_s
    runs = voiced_runs(rms)
    paired = notes.join(pair_segments(notes, runs, frame_s, parts), ["score_id", "note_idx"])
    onset = F.greatest(F.lit(0.0), F.col("t_first") - group_delay_s)
    offset = F.col("t_last") + frame_s - group_delay_s
    dur = F.col("offset_s") - F.col("onset_s")
    offset = F.when(offset <= onset, onset + F.greatest(F.lit(frame_s), dur)).otherwise(offset)
    has = F.col("t_first").isNotNull()
    return paired.select(
        "score_id", "note_idx",
        F.when(has, onset).otherwise(F.col("onset_s")).alias("onset_s"),
        F.when(has, offset).otherwise(F.col("offset_s")).alias("offset_s"),
        "pitch_midi",
        F.when(has, F.abs(onset - F.col("onset_s")) * 1000.0).otherwise(0.0).alias("onset_dev_ms"),
    )


def refine_offsets(notes: DataFrame, frames: DataFrame) -> DataFrame:
    """Offsets moved to the last in-tune (±100 cents) frame, inside the note's own span."""
    width = BIN_S
    hi = F.least(F.col("offset_s") + 0.2, F.col("next_onset_s"))
    n = next_onset(notes).withColumns({"_hi": hi, "f_ref": midi_to_hz("pitch_midi")})
    listed = n.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("onset_s") / width), F.floor(F.greatest("_hi", "onset_s") / width))))
    f = frames.filter("voiced AND f0_hz > 0").select(
        F.col("sample_id").alias("score_id"), F.floor(F.col("t_s") / width).alias("_bin"), "t_s", "f0_hz"
    )
    hit = F.col("t_s").between(F.col("onset_s"), F.col("_hi")) & (F.abs(cents("f0_hz", F.col("f_ref"))) <= 100)
    last = listed.join(f.hint("merge"), ["score_id", "_bin"], "left").groupBy(
        "score_id", "note_idx", "onset_s", "offset_s", "next_onset_s", "pitch_midi"
    ).agg(F.max(F.when(hit, F.col("t_s"))).alias("_t"))
    off = F.greatest(F.col("onset_s") + 0.03, F.coalesce("_t", "offset_s"))
    off = F.when(F.col("next_onset_s") > F.col("onset_s"), F.least(off, F.col("next_onset_s") - 0.001)).otherwise(off)
    return last.select("score_id", "note_idx", "onset_s", F.round(off, 3).alias("offset_s"), "pitch_midi")
