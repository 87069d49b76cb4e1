"""Note tables: checks, thresholds, phrase segmentation, melody reduction, slur merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noteflow.operators.folds import sorted_fold
from noteflow.operators.scan import BLK, exact_percentiles, one_row, ordered_scan, place

#: Two notes may touch or overlap by this much, in seconds.
OVERLAP_SLACK_S = 1e-9
#: Floor of the learned note length: the onset tolerance.
ONSET_TOLERANCE_MS = 50.0


# --- validity --------------------------------------------------------------------------------


def reject_reason() -> Column:
    """Why a note row is unusable; NULL when it is valid."""
    return (
        F.when(~F.coalesce(F.col("onset_s") >= 0, F.lit(False)) | F.isnan("onset_s"), F.lit("onset below zero"))
        .when(
            ~F.coalesce(F.col("offset_s") > F.col("onset_s"), F.lit(False)) | F.isnan("offset_s"),
            F.lit("offset not after onset"),
        )
        .when(~F.coalesce(F.col("pitch_midi").between(0, 127), F.lit(False)), F.lit("pitch outside 0..127"))
    )


def valid_notes(notes: DataFrame) -> DataFrame:
    return notes.filter(reject_reason().isNull())


def note_rejects(notes: DataFrame) -> DataFrame:
    return notes.withColumn("reason", reject_reason()).filter("reason IS NOT NULL")


def sort_notes(notes: DataFrame) -> DataFrame:
    """Number the notes of a score by (onset, offset); the input position breaks ties."""
    order = ["onset_s", "offset_s", "note_idx"]
    ranked = ordered_scan(notes, "score_id", order, row_number="_rank")
    return ranked.withColumn("note_idx", (F.col("_rank") - 1).cast("int")).drop("_rank")


def next_onset(notes: DataFrame, whole: bool = False) -> DataFrame:
    """Adds ``next_onset_s``: infinity for the last note. ``whole``: no score is known to need a cut, so they are not counted."""
    out = ordered_scan(notes, "score_id", ["onset_s", "note_idx"], lead={"next_onset_s": "onset_s"}, cut=False if whole else None)
    return out.withColumn("next_onset_s", F.coalesce("next_onset_s", F.lit(float("inf"))))


def monophony(notes: DataFrame, whole: bool = False) -> DataFrame:
    """Per score: does every note end before the next begins, and how many pairs do not."""
    gap_ok = F.col("offset_s") <= F.col("next_onset_s") + OVERLAP_SLACK_S
    overlap = F.col("next_onset_s") + OVERLAP_SLACK_S < F.col("offset_s")
    return (
        next_onset(notes, whole)
        .groupBy("score_id")
        .agg(
            F.bool_and(gap_ok).alias("monophonic"),
            F.count_if(overlap).alias("n_overlaps"),
            F.count(F.lit(1)).alias("n_notes"),
            F.max("offset_s").alias("duration_s"),
        )
    )


# --- thresholds and distributions ------------------------------------------------------------


def learn_min_note_ms(notes: DataFrame, percentile: float = 1.0, hops: dict[str, float] | None = None) -> DataFrame:
    """One row: the shortest acceptable note, and what it was learned from."""
    hops = hops or {}
    durations = notes.select(((F.col("offset_s") - F.col("onset_s")) * 1000.0).alias("ms"))
    found = exact_percentiles(durations, "ms", [percentile / 100.0])
    value = found["values"][0] if found["n"] else 0.0
    hop = max(hops.values(), default=0.0)
    made = F.create_map(*[F.lit(x) for kv in hops.items() for x in kv]) if hops else F.create_map()
    return notes.sparkSession.range(1).select(
        F.lit(max(value, hop, ONSET_TOLERANCE_MS)).alias("min_note_ms"),
        F.lit(value).alias("data_percentile_ms"),
        F.lit(float(percentile)).alias("percentile"),
        F.lit(hop).alias("largest_frame_hop_ms"),
        F.lit(ONSET_TOLERANCE_MS).alias("onset_tolerance_ms"),
        F.lit(found["n"]).cast("long").alias("n_notes"),
        made.cast("map<string,double>").alias("method_frame_hops_ms"),
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """One row: count, min, quartiles, max, mean; only the count when there are no values."""
    found = exact_percentiles(df, column, [0.25, 0.5, 0.75])
    p25, median, p75 = found["values"]
    d = lambda v: F.lit(v).cast("double")
    return df.sparkSession.range(1).select(
        F.lit(found["n"]).cast("long").alias("count"), d(found["min"]).alias("min"),
        d(p25).alias("p25"), d(median).alias("median"), d(p75).alias("p75"),
        d(found["max"]).alias("max"), d(found["mean"]).alias("mean"),
    )


def upper_median(df: DataFrame, keys: list[str], column: str, name: str = "median") -> DataFrame:
    """``sorted(values)[n // 2]`` per group, for a column with few distinct values (pitches)."""
    counts = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_c"))
    up_to = Window.partitionBy(*keys).orderBy(column).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    placed = counts.select(
        *keys, column, F.sum("_c").over(up_to).alias("_cum"), F.sum("_c").over(whole).alias("_n")
    )
    return placed.filter(F.col("_cum") > F.floor(F.col("_n") / 2)).groupBy(*keys).agg(F.min(column).alias(name))


def octave_shift(median: Column, lo: int, hi: int) -> Column:
    """Whole octaves, half-even rounded, that bring the median to the middle of the range."""
    return (F.rint((F.lit((lo + hi) / 2) - median) / 12.0) * 12).cast("int")


def octave_centre(notes: DataFrame, lo: int = 55, hi: int = 79, keys: list[str] | None = None) -> DataFrame:
    """Adds ``shift`` and the shifted pitch, and marks the notes still out of range."""
    keys = keys or ["score_id"]
    shifts = upper_median(notes, keys, "pitch_midi").select(
        *keys, octave_shift(F.col("median"), lo, hi).alias("shift")
    )
    moved = notes.join(shifts, keys)
    pitch = F.col("pitch_midi") + F.col("shift")
    return moved.withColumns({"pitch_midi": pitch, "in_range": pitch.between(lo, hi)})


# --- phrases ---------------------------------------------------------------------------------


def rest_split(notes: DataFrame, gap_s: float = 0.4, whole: bool = False) -> DataFrame:
    """Adds ``rest_group``: index of the last note that followed a rest of ``gap_s`` or more. ``whole``: no score has to be cut."""
    order = ["onset_s", "note_idx"]
    placed, cut = (notes, False) if whole else place(notes, "score_id", order)
    prev = ordered_scan(placed, "score_id", order, lag={"_prev": "offset_s"}, cut=cut)
    starts = F.col("_prev").isNull() | (F.col("onset_s") - F.col("_prev") >= gap_s)
    marked = prev.withColumn("_start", F.when(starts, F.col("note_idx")))
    out = ordered_scan(marked, "score_id", order, max_before={"_open": "_start"}, cut=cut)
    return out.withColumn("rest_group", F.coalesce("_start", "_open")).drop("_prev", "_start", "_open", BLK)


def phrase_cuts(notes: DataFrame, gap_s: float = 0.4, max_phrase_s: float = 12.0, whole: bool = False) -> DataFrame:
    """Adds ``phrase_start``: index of the first note of the phrase, cut at rests and at the cap.

    A rest resets the running phrase start, so the fold is keyed by the rest group. ``whole``: the scores lie in one piece each, and are folded there.
    """

    def step():
        state = {"first": 0.0, "idx": 0}

        def fn(new_group, row):
            onset, idx, offset = row[:3]
            if new_group or offset - state["first"] > max_phrase_s:
                state["first"], state["idx"] = onset, idx
            return (state["idx"],)

        return fn

    grouped = rest_split(notes, gap_s, whole).select(
        "score_id", "rest_group", "onset_s", "note_idx", "offset_s", "pitch_midi"
    )
    return sorted_fold(
        grouped, ["score_id", "rest_group"], ["onset_s", "note_idx"], step, "phrase_start int", whole
    )


def segment_phrases(
    notes: DataFrame, *, gap_s: float = 0.4, max_phrase_s: float = 12.0, min_notes: int = 4,
    min_phrase_s: float = 1.0, lo: int = 55, hi: int = 79, max_out_of_range_frac: float = 0.2, parts: int | None = None,
) -> DataFrame:
    """Octave-centred phrases, re-zeroed to 0.2 s, numbered over the kept phrases of a score.

    ``parts``: the number of partitions by score in which the notes lie, where no score had to be cut. Then notes move once, after the fold.
    """
    key = ["score_id", "phrase_start"]
    whole = parts is not None
    cut = phrase_cuts(notes, gap_s, max_phrase_s, whole)
    out = lambda df: df.select(
        F.format_string("%s_p%03d", "score_id", "_p").alias("score_id"),
        "note_idx",
        F.round(F.col("onset_s") - F.col("_t0"), 3).alias("onset_s"),
        F.round(F.col("offset_s") - F.col("_t0"), 3).alias("offset_s"),
        (F.col("pitch_midi") + F.col("shift")).alias("pitch_midi"),
    )
    if whole:
        return out(_whole_phrases(cut.drop("rest_group").repartition(parts, "score_id"), key, min_notes, min_phrase_s, lo, hi, max_out_of_range_frac))
    pitches = cut.groupBy(*key, "pitch_midi").agg(
        F.count(F.lit(1)).alias("_c"), F.min("onset_s").alias("_on"),
        F.max(F.struct("note_idx", "offset_s")).alias("_last"),
    )
    up_to = Window.partitionBy(*key).orderBy("pitch_midi").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*key)
    spread = pitches.select(
        *key, "pitch_midi", "_c", F.sum("_c").over(up_to).alias("_cum"), F.sum("_c").over(whole).alias("_n"),
        F.min("_on").over(whole).alias("_first"), F.max("_last").over(whole).alias("_end"),
    )
    stats = spread.groupBy(*key).agg(
        F.max("_n").alias("n"), F.max(F.col("_end.offset_s") - F.col("_first")).alias("span"),
        F.max("_first").alias("first_s"),
        F.min(F.when(F.col("_cum") > F.floor(F.col("_n") / 2), F.col("pitch_midi"))).alias("median"),
    ).filter((F.col("n") >= min_notes) & (F.col("span") >= min_phrase_s))
    shifted = stats.withColumn("shift", octave_shift(F.col("median"), lo, hi))
    inside = (F.col("pitch_midi") + F.col("shift")).between(lo, hi)
    kept = (
        pitches.join(shifted, key)
        .filter(inside)
        .groupBy(*key, "n", "shift")
        .agg(F.sum("_c").alias("n_kept"), F.min("_on").alias("t_first"))
        .filter((F.col("n") - F.col("n_kept")) / F.col("n") <= max_out_of_range_frac)
    )
    numbered = ordered_scan(kept, "score_id", ["phrase_start"], row_number="_p").select(*key, "shift", (F.col("t_first") - 0.2).alias("_t0"), (F.col("_p") - 1).alias("_p"))
    return out(cut.join(numbered, key).filter(inside))


def _whole_phrases(cut: DataFrame, key: list[str], min_notes: int, min_phrase_s: float, lo: int, hi: int, max_out_of_range_frac: float) -> DataFrame:
    """The notes of kept phrases inside the range with their ``shift``, number and zero, where scores lie whole: windows under one sort."""
    phrase = Window.partitionBy(*key)
    seen = cut.filter(" AND ".join(f"{k} IS NOT NULL" for k in key)).withColumns({
        "_n": F.count(F.lit(1)).over(phrase), "_first": F.min("onset_s").over(phrase), "_last": F.max(F.struct("note_idx", "offset_s")).over(phrase),
        "_nth": F.row_number().over(phrase.orderBy("pitch_midi")),
    }).filter((F.col("_n") >= min_notes) & (F.col("_last.offset_s") - F.col("_first") >= min_phrase_s))
    median = F.min(F.when(F.col("_nth") > F.floor(F.col("_n") / 2), F.col("pitch_midi"))).over(phrase)
    shifted = seen.withColumn("_median", median).withColumn("shift", octave_shift(F.col("_median"), lo, hi))
    inside = shifted.filter((F.col("pitch_midi") + F.col("shift")).between(lo, hi))
    kept = inside.withColumns({"_kept": F.count(F.lit(1)).over(phrase), "_t0": F.min("onset_s").over(phrase) - 0.2})
    kept = kept.filter((F.col("_n") - F.col("_kept")) / F.col("_n") <= max_out_of_range_frac)
    return kept.withColumn("_p", F.dense_rank().over(Window.partitionBy("score_id").orderBy("phrase_start")) - 1)


# --- melody reduction ------------------------------------------------------------------------

# Parts of a track name that mark a melody.
MELODY_NAMES = ("melody", "vocal", "lead", "voice", "sing")


def pick_melody_track(events: DataFrame) -> DataFrame:
    """Events of the first melody-named pitched track of a song, otherwise of all pitched tracks."""
    named = F.lower(F.trim("track_name")).rlike("|".join(MELODY_NAMES))
    pitched = events.filter(~F.col("is_drum"))
    chosen = pitched.filter(named).groupBy("song_id").agg(F.min("track").alias("_melody"))
    return (
        pitched.join(chosen, "song_id", "left")
        .filter(F.col("_melody").isNull() | (F.col("_melody") == F.col("track")))
        .withColumn("method", F.when(F.col("_melody").isNotNull(), F.lit("melody_track")).otherwise(F.lit("skyline")))
        .drop("_melody")
    )


def sounding_islands(events: DataFrame) -> DataFrame:
    """Adds ``island``: start time of the stretch without silence that an event belongs to."""
    order = ["start_s", "neg_pitch", "track", "end_s"]
    ev = events.withColumn("neg_pitch", -F.col("pitch"))
    ev, cut = place(ev, "song_id", order)
    held = ordered_scan(ev, "song_id", order, max_before={"_held": "end_s"}, cut=cut)
    opens = F.col("_held").isNull() | (F.col("start_s") >= F.col("_held"))
    marked = held.withColumn("_open", F.when(opens, F.col("start_s")))
    out = ordered_scan(marked, "song_id", order, max_before={"_last": "_open"}, cut=cut)
    return out.withColumn("island", F.coalesce("_open", "_last")).drop("_held", "_open", "_last", BLK)


def skyline(events: DataFrame) -> DataFrame:
    """Top line: a higher note cuts the held lower one short, a lower note under it is hidden.

    Remnants of a millisecond or less vanish. The fold only decides which events enter the line; an
    entered note then ends where the next one enters.
    """

    def step():
        top = {"end": 0.0, "pitch": 0}

        def fn(new_group, row):
            start, neg, _track, end = row[:4]
            if not new_group and start < top["end"] and -neg <= top["pitch"]:
                return (False,)
            top["end"], top["pitch"] = end, -neg
            return (True,)

        return fn

    order = ["start_s", "neg_pitch", "track", "end_s"]
    ev = sounding_islands(events)
    entered = sorted_fold(ev, ["song_id", "island"], order, step, "entered boolean").filter("entered")
    line = ordered_scan(entered, "song_id", order, lead={"_next": "start_s"})
    cut = F.col("_next") < F.col("end_s")
    end = F.when(cut, F.col("_next")).otherwise(F.col("end_s"))
    remnant = F.coalesce(cut, F.lit(False)) & (end - F.col("start_s") <= 1e-3)
    return (
        line.filter(~remnant & (F.col("end_s") > F.col("start_s")))
        .withColumn("end_s", end)
        .drop("neg_pitch", "island", "entered", "_next")
    )


def singable(pitch: Column, length_s: Column, lo: int = 55, hi: int = 79, min_note_s: float = 0.08) -> Column:
    """Why a note is dropped: out of range is counted before short; NULL when it stays."""
    return F.when(~pitch.between(lo, hi), F.lit("out_of_range")).when(length_s < min_note_s, F.lit("short"))


def melody_lines(events: DataFrame, *, lo: int = 55, hi: int = 79, min_note_s: float = 0.08) -> DataFrame:
    """Reduced, octave-centred line of every song with the drop reason of each note."""
    line = skyline(pick_melody_track(events))
    shifts = upper_median(line, ["song_id"], "pitch").select(
        "song_id", octave_shift(F.col("median"), lo, hi).alias("shift")
    )
    moved = line.join(shifts, "song_id").withColumn("out_pitch", F.col("pitch") + F.col("shift"))
    return moved.withColumn(
        "drop_reason", singable(F.col("out_pitch"), F.col("end_s") - F.col("start_s"), lo, hi, min_note_s)
    )


def melody_notes(lines: DataFrame) -> DataFrame:
    """Kept notes of each line, moved so that the first onset is at 0.2 s."""
    kept = lines.filter("drop_reason IS NULL")
    first = kept.groupBy("song_id").agg((F.min("start_s") - 0.2).alias("_t0"))
    return kept.join(first, "song_id").select(
        "song_id",
        F.round(F.col("start_s") - F.col("_t0"), 3).alias("onset_s"),
        F.round(F.col("end_s") - F.col("_t0"), 3).alias("offset_s"),
        F.col("out_pitch").alias("pitch_midi"),
    )


def melody_stats(events: DataFrame, lines: DataFrame) -> DataFrame:
    """Per song: method, notes in and out, drops, pitch ranges, and why it was rejected."""
    kept = F.col("drop_reason").isNull()
    per = lines.groupBy("song_id").agg(
        F.first("method").alias("_method"), F.count(F.lit(1)).alias("notes_in"),
        F.count_if(kept).alias("notes_out"),
        F.count_if(F.col("drop_reason") == "out_of_range").alias("dropped_out_of_range"),
        F.count_if(F.col("drop_reason") == "short").alias("dropped_short"),
        F.max("shift").alias("transposed_semitones"),
        F.min("pitch").alias("pitch_in_lo"), F.max("pitch").alias("pitch_in_hi"),
        F.min(F.when(kept, F.col("out_pitch"))).alias("pitch_out_lo"),
        F.max(F.when(kept, F.col("out_pitch"))).alias("pitch_out_hi"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    songs = events.select("song_id").distinct().join(per, "song_id", "left")
    return songs.select(
        "song_id",
        F.when(F.col("notes_out") > 0, F.col("_method")).otherwise(F.lit("rejected")).alias("method"),
        *[zero(c) for c in ("notes_in", "notes_out", "dropped_out_of_range", "dropped_short", "transposed_semitones")],
        "pitch_in_lo", "pitch_in_hi", "pitch_out_lo", "pitch_out_hi",
        F.when(F.col("_method").isNull(), F.lit("no pitched notes"))
        .when(F.col("notes_out") == 0, F.lit("nothing in singable range")).otherwise(F.lit(""))
        .alias("reject_reason"),
    )


def extraction_report(stats: DataFrame) -> DataFrame:
    """One row of yield, methods, note totals and pitch ranges over the accepted songs."""
    ok = (F.col("method") != "rejected") & (F.col("notes_out") > 0)
    total = lambda c: F.coalesce(F.sum(F.when(ok, F.col(c))), F.lit(0))
    n = F.count(F.lit(1))
    return stats.agg(
        n.alias("files"), F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("rejected"),
        F.coalesce(F.round(F.count_if(ok) / n, 3), F.lit(0.0)).alias("yield"),
        F.count_if(F.col("method") == "melody_track").alias("melody_track"),
        F.count_if(F.col("method") == "skyline").alias("skyline"),
        total("notes_in").alias("notes_in_total"), total("notes_out").alias("notes_out_total"),
        total("dropped_out_of_range").alias("dropped_out_of_range"),
        total("dropped_short").alias("dropped_short"),
        F.min(F.when(ok, F.col("pitch_in_lo"))).alias("pitch_in_lo"),
        F.max(F.when(ok, F.col("pitch_in_hi"))).alias("pitch_in_hi"),
        F.min(F.when(ok, F.col("pitch_out_lo"))).alias("pitch_out_lo"),
        F.max(F.when(ok, F.col("pitch_out_hi"))).alias("pitch_out_hi"),
    )


def ingest_report(notes_in: DataFrame, phrases: DataFrame) -> DataFrame:
    """One row: songs, phrases, phrases per song, note retention (0 for no input)."""
    a = notes_in.agg(F.count_distinct("score_id").alias("songs"), F.count(F.lit(1)).alias("notes_in"))
    b = phrases.agg(F.count_distinct("score_id").alias("phrases"), F.count(F.lit(1)).alias("notes_out"))
    ratio = lambda x, y, d: F.when(F.col(y) > 0, F.bround(F.col(x) / F.col(y), d)).otherwise(0.0)
    return one_row(a, b).select(
        "songs", "phrases", ratio("phrases", "songs", 1).alias("phrases_per_song"), "notes_in",
        "notes_out", ratio("notes_out", "notes_in", 3).alias("note_retention"),
    )


# --- parallel-array sources ------------------------------------------------------------------

# Lyric marks of a slur, and how far its onset may lie from the previous offset.
SLUR_MARKS = ("—", "-", "_")
SLUR_GAP_S = 0.002


def merge_slurs(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(notes, outcome per segment row) of parallel-array note rows.

    Works inside each row's arrays: rests go, a slur mark at the same pitch within 2 ms of the
    previous note extends it. One faulty note makes the whole row invalid.
    """
    n = F.size("note_midi")
    same = (F.size("note_start_times") == n) & (F.size("note_end_times") == n) & (F.size("note_lyrics") == n)
    cells = F.arrays_zip(
        F.transform("note_midi", lambda p: F.rint(p).cast("int")).alias("pitch"),
        F.col("note_start_times").alias("on"), F.col("note_end_times").alias("off"),
        F.transform("note_lyrics", lambda s: F.trim(s)).alias("lyric"),
    )
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    fault = lambda c: (
        F.when(~finite(c["on"]) | ~finite(c["off"]), 3)
        .when((c["on"] < 0) | (c["off"] <= c["on"]), 2)
        .when(c["pitch"] > 127, 1)
        .otherwise(0)
    )

    def extend(notes: Column, c: Column) -> Column:
        last = F.try_element_at(notes, F.lit(-1))
        slur = (
            c["lyric"].isin(*SLUR_MARKS)
            & (last["pitch_midi"] == c["pitch"])
            & (F.abs(last["offset_s"] - c["on"]) <= SLUR_GAP_S)
        )
        note = F.struct(
            F.when(F.coalesce(slur, F.lit(False)), last["onset_s"]).otherwise(c["on"]).alias("onset_s"),
            c["off"].alias("offset_s"), c["pitch"].alias("pitch_midi"),
        )
        kept = F.when(F.coalesce(slur, F.lit(False)), F.slice(notes, 1, F.size(notes) - 1)).otherwise(notes)
        return F.when(c["pitch"] > 0, F.concat(kept, F.array(note))).otherwise(notes)

    empty = F.array().cast("array<struct<onset_s:double,offset_s:double,pitch_midi:int>>")
    overlapping = F.aggregate(
        "notes", F.struct(F.lit(float("-inf")).alias("end"), F.lit(False).alias("bad")),
        lambda acc, x: F.struct(
            x["offset_s"].alias("end"),
            (acc["bad"] | (acc["end"] > x["onset_s"] + OVERLAP_SLACK_S)).alias("bad"),
        ),
        lambda acc: acc["bad"],
    )
    full = (
        rows.withColumn("same", F.coalesce(same, F.lit(False)))
        .withColumn("cells", F.when(F.col("same"), cells))
        .withColumn("worst", F.coalesce(F.array_max(F.transform("cells", fault)), F.lit(0)))
        # Array order of a struct is (onset, offset, pitch), the order of a score.
        .withColumn("notes", F.array_sort(F.aggregate("cells", empty, extend)))
        .withColumn(
            "outcome",
            F.when(F.coalesce(F.trim("segment_id"), F.lit("")) == "", F.lit("segment_id is empty"))
            .when(~F.col("same"), F.lit("arrays differ in length"))
            .when(F.col("worst") == 3, F.lit("note timing is not finite"))
            .when(F.col("worst") == 2, F.lit("invalid note timing"))
            .when(F.col("worst") == 1, F.lit("pitch outside 1..127"))
            .when(overlapping, F.lit("overlapping notes"))
            .when(F.size("notes") == 0, F.lit("empty"))
            .otherwise(F.lit("usable")),
        )
    )
    usable = F.when(F.col("outcome") == "usable", F.col("notes"))
    notes = full.select(
        F.col("segment_id").alias("score_id"), F.posexplode(usable).alias("note_idx", "n")
    )
    outcome = full.select(*[c for c in rows.columns if not c.startswith("note_")], "outcome")
    return notes.select("score_id", "note_idx", "n.*"), outcome


def ingest_counters(outcome: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """selected / invalid / empty / usable / existing / written over segment outcomes."""
    if existing is not None:
        have = existing.select("segment_id").distinct().withColumn("_have", F.lit(True))
        outcome = outcome.join(have, "segment_id", "left")
    else:
        outcome = outcome.withColumn("_have", F.lit(None).cast("boolean"))
    usable, empty = F.col("outcome") == "usable", F.col("outcome") == "empty"
    have = F.coalesce(F.col("_have"), F.lit(False))
    return outcome.agg(
        F.count(F.lit(1)).alias("selected"), F.count_if(~usable & ~empty).alias("invalid"),
        F.count_if(empty).alias("empty"), F.count_if(usable).alias("usable"),
        F.count_if(usable & have).alias("existing"), F.count_if(usable & ~have).alias("written"),
    )
