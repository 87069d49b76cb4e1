"""Chunks of a recording, label grids on the frame raster, and context windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noteflow.functions.scalar import GRID_HOP, GRID_RATE, n_frames
from noteflow.operators.scan import interval_join

# Label codes of the grid.
ONSET_LABEL, ACTIVE_LABEL = 3, 2


def make_chunks(lengths: DataFrame, length: int, samples: str = "n_samples") -> DataFrame:
    """Chunk starts of each recording; the last chunk is moved back to end with it."""
    n = F.col(samples)
    tail = n - length
    starts = F.when(n <= length, F.array(F.lit(0).cast("long"))).otherwise(
        F.array_distinct(
            F.concat(F.transform(F.sequence(F.lit(0).cast("long"), n - 1, F.lit(length).cast("long")), lambda s: F.least(s, tail)), F.array(tail))
        )
    )
    return lengths.withColumn("chunk_start", F.explode(starts))


def _chunk_span(length: int) -> tuple[Column, Column]:
    lo = F.col("chunk_start") / float(GRID_RATE)
    return lo, (F.col("chunk_start") + length) / float(GRID_RATE)


def note_chunk_overlap(chunks: DataFrame, notes: DataFrame, length: int, bin_s: float = 8.0) -> DataFrame:
    """Chunks that any note overlaps, found by a semi-join on time bins."""
    lo, hi = _chunk_span(length)
    bins = lambda a, b: F.explode(F.sequence(F.floor(a / bin_s), F.floor(b / bin_s)))
    c = chunks.withColumns({"_lo": lo, "_hi": hi}).withColumn("_bin", bins(F.col("_lo"), F.col("_hi")))
    n = notes.select(
        F.col("score_id").alias("_sid"), "onset_s", "offset_s", bins(F.col("onset_s"), F.col("offset_s")).alias("_nbin")
    )
    hit = (c["score_id"] == n["_sid"]) & (c["_bin"] == n["_nbin"]) & (n["offset_s"] > c["_lo"]) & (n["onset_s"] < c["_hi"])
    return c.join(n, hit, "left_semi").select(*chunks.columns).distinct()


def rasterize(chunks: DataFrame, notes: DataFrame, length: int) -> DataFrame:
    """Sparse label cells (score, chunk, frame, pitch): 3 at the onset, then 2; later notes win."""
    steps = (length - 1) // GRID_HOP + 1
    lo, hi = _chunk_span(length)
    pairs = interval_join(
        chunks, notes, ["score_id"], (lo, hi), (F.col("onset_s"), F.col("offset_s")), width=8.0
    )
    on, off = F.col("onset_s") - lo, F.col("offset_s") - lo
    kept = pairs.filter((off >= 0) & (on < length / float(GRID_RATE)))
    rate = float(GRID_RATE)
    left = F.rint(on * rate / float(GRID_HOP)).cast("long")
    right = F.least(F.lit(steps), F.rint(off * rate / float(GRID_HOP)).cast("long"))
    cells = kept.withColumns({"_left": left, "_right": right})
    first = F.greatest(F.lit(0).cast("long"), F.col("_left"))
    last = F.greatest(F.col("_right") - 1, F.when(F.col("_left") >= 0, F.least(F.col("_left"), F.lit(steps - 1))).otherwise(F.lit(-1)))
    cells = cells.filter((last >= first) & (F.col("_left") < steps)).withColumn("frame", F.explode(F.sequence(first, last)))
    label = F.when(F.col("frame") == F.col("_left"), ONSET_LABEL).otherwise(ACTIVE_LABEL)
    # The note order rides in the high part of one number, so that the aggregate stays a hash one.
    code = F.max(F.col("note_idx").cast("long") * 4 + label)
    return (
        cells.groupBy("score_id", "chunk_start", "frame", F.col("pitch_midi").alias("pitch"))
        .agg((code % 4).cast("tinyint").alias("label"))
        .withColumns({"onset": (F.col("label") == ONSET_LABEL).cast("int"), "active": (F.col("label") >= ACTIVE_LABEL).cast("int")})
    )


def pianoroll(notes: DataFrame, resolution_ms: int = 50) -> DataFrame:
    """Occupied (pitch, bin) cells of each score, with truncating bins."""
    step = resolution_ms / 1000.0
    a, b = F.floor(F.col("onset_s") / step), F.floor(F.col("offset_s") / step)
    cells = notes.withColumns({"_a": a, "_b": b}).filter("_b > _a")
    return cells.select(
        "score_id", F.col("pitch_midi").alias("pitch"), F.explode(F.sequence("_a", F.col("_b") - 1)).alias("bin")
    ).distinct()


def context_chunks(lengths: DataFrame, step: int, context: int, samples: str = "n_samples") -> DataFrame:
    """Windows of step + 2·context samples every ``step``, with the zero padding each one needs."""
    n = F.col(samples)
    count = F.floor((n + context - 1) / step) + 1 + context // step
    rows = lengths.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)))
    start, end = F.col("chunk") * step - context, (F.col("chunk") + 1) * step + context
    width = F.lit(step + 2 * context)
    return rows.withColumns({
        "start": start, "end": end,
        "pad_left": F.least(F.greatest(-start, F.lit(0)), width),
        "pad_right": F.least(F.greatest(end - n, F.lit(0)), width),
    })


def stitch_chunks(windows: DataFrame, step_frames: int, context_frames: int) -> DataFrame:
    """Frames of context windows back on one axis: context dropped, cut at the song length."""
    own = F.col("frame").between(context_frames, context_frames + step_frames - 1)
    position = F.col("chunk") * step_frames + F.col("frame") - context_frames
    return windows.filter(own).withColumn("frame", position).filter(F.col("frame") < F.col("n_frames")).drop("chunk")


def song_frames(lengths: DataFrame, samples: str = "n_samples") -> DataFrame:
    return lengths.withColumn("n_frames", n_frames(samples))


def median_pitch_correction(notes: DataFrame, frames: DataFrame, strength: float = 1.0, min_frames: int = 3) -> DataFrame:
    """Pull the voiced frames of each note towards its pitch by the note's median f0."""
    from noteflow.functions.scalar import midi_to_hz

    voiced = frames.filter("f0_hz > 0").withColumnRenamed("sample_id", "score_id")
    t = F.col("t_s")
    pairs = interval_join(
        notes.select("score_id", "note_idx", "onset_s", "offset_s", "pitch_midi"),
        voiced.select("score_id", "frame_idx", "t_s", "f0_hz"),
        ["score_id"], (F.col("onset_s"), F.col("offset_s")), (t, t), width=4.0,
    ).filter((t >= F.col("onset_s")) & (t < F.col("offset_s")))
    medians = pairs.groupBy("score_id", "note_idx").agg(
        F.expr("percentile(f0_hz, 0.5)").alias("_med"), F.count(F.lit(1)).alias("_n"), F.max("pitch_midi").alias("_p")
    ).filter((F.col("_n") >= min_frames) & (F.col("_med") > 0))
    ratio = F.pow(midi_to_hz("_p") / F.col("_med"), F.lit(float(strength)))
    # A frame under two notes takes the later one.
    owner = pairs.join(medians, ["score_id", "note_idx"]).groupBy("score_id", "frame_idx").agg(
        F.max_by(ratio, "note_idx").alias("_ratio")
    )
    return (
        frames.join(owner.withColumnRenamed("score_id", "sample_id").hint("merge"), ["sample_id", "frame_idx"], "left")
        .withColumn("f0_hz", F.when(F.col("_ratio").isNotNull(), F.col("f0_hz") * F.col("_ratio")).otherwise(F.col("f0_hz")))
        .drop("_ratio")
    )
