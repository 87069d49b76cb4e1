"""Frames are made where the notes of their sample lie, and are not moved from there."""

import re

import pytest
from pyspark.sql import functions as F

from noteflow.plans import catalog
from noteflow.plans.registry import QUERIES
from noteflow.sources import adapters

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["note_checks", "note_frame_join", "median_pitch_correction", "rasterize", "verdict_reasons"])
def test_no_exchange_by_time_bin(spark, name, monkeypatch):
    monkeypatch.setattr(adapters, "PART_NOTES", 500)
    catalog.load()
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", _plan(QUERIES[name](spark, SF)))
    assert moved and not [m for m in moved if re.search(r"_blk|_bin|frame", m)], moved


def test_partitions_follow_the_number_of_notes(spark, monkeypatch):
    monkeypatch.setattr(adapters, "PART_NOTES", 500)
    t = adapters.Tables(spark, SF)
    assert t.f0_frames.rdd.getNumPartitions() == t.raw("lineitem").count() // 500 + 1
    assert t.note_rows() is t.note_rows()


def test_rounds_are_digested_once_a_chunk(spark):
    from pyspark.sql import functions as F

    from noteflow.operators import lyrics as Y

    notes = spark.range(60).select(F.when(F.col("id") < 40, "a").alias("score_id"), F.col("id").cast("int").alias("note_idx"))
    inventory = spark.createDataFrame([(f"s{i}",) for i in range(7)], "syllable string")
    out = Y.auto_syllables(notes, inventory, F.lit(3))
    assert "Aggregate [score_id" in out._jdf.queryExecution().optimizedPlan().toString()
    want = notes.withColumn("at", Y.keyed_position(F.pmod("note_idx", F.lit(7)), 7, F.lit(3), F.floor(F.col("note_idx") / 7)))
    assert {(r.score_id, r.note_idx, r.syllable) for r in out.collect()} == {(r.score_id, r.note_idx, f"s{r.at}") for r in want.collect()}


def test_runs_are_measured_once(spark):
    catalog.load()
    plan = QUERIES["pair_segments"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "rms" not in plan and "Scan ExistingRDD" in plan.replace("LogicalRDD", "Scan ExistingRDD")


def test_variants_are_compared_where_their_base_lies(spark, monkeypatch):
    monkeypatch.setattr(adapters, "PART_NOTES", 500)
    catalog.load()
    plan = _plan(QUERIES["criteria_reexpand"](spark, SF))
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\), ENSURE_REQUIREMENTS", plan)
    # One row per variant is left to move, and no line of it.
    assert len(moved) <= 1, moved


def test_lines_by_base_are_the_plain_lines(spark):
    from noteflow.sources import score_io

    rows = [("a__x", "a", 0, 0.0, 1.0, 60, None), ("a__x", "a", 1, 1.0, 2.0, 61, "la"), ("b__x", "b", 0, 0.0, 0.5, 62, None)]
    notes = spark.createDataFrame(rows, "score_id string, base string, note_idx int, onset_s double, offset_s double, pitch_midi int, lyric string")
    plain = lambda df: sorted(tuple(r) for r in df.select("score_id", "note_idx", "line").collect())
    assert plain(score_io.score_lines(notes, "base")) == plain(score_io.score_lines(notes))
    assert plain(score_io.score_lines(notes.drop("lyric"))) == plain(score_io.score_lines(notes.withColumn("lyric", notes.base.substr(9, 1))))


def test_mono_frames_are_made_for_peaks_and_votes_only(spark, monkeypatch):
    monkeypatch.setattr(adapters, "PART_NOTES", 500)
    catalog.load()
    plan = _plan(QUERIES["decode_mono"](spark, SF))
    assert plan.count("REPARTITION_BY_NUM") == 2 and "ENSURE_REQUIREMENTS" not in plan


def test_mono_notes_of_cut_songs(spark, monkeypatch):
    from noteflow.operators import decode as D
    from noteflow.operators import scan

    rows = adapters.Tables(spark, SF).mono_posteriors.filter("hash(song_id) % 40 = 0").localCheckpoint()
    # A note at the song's end, a drop right after an onset, and frames that are missing.
    rows = rows.filter("frame % 37 <> 5")
    found = lambda: sorted(tuple(r) for r in D.decode_mono(rows, 0.4, 0.5).collect())
    whole = found()
    monkeypatch.setattr(scan, "HOT_ROWS", 40)
    assert whole and found() == whole
    # Written out: the frames from each onset up to its end, and the mode of their pitches.
    want, by_song = [], {}
    for r in rows.collect():
        by_song.setdefault(r.song_id, []).append((r.frame, r.vad_p, r.oct.index(max(r.oct)) * 12 + r.pc.index(max(r.pc))))
    peaks = {(r.song_id, r.frame) for r in D.plateau_peaks(rows, "onset_p", 0.4).collect()}
    for song, frames in by_song.items():
        frames.sort()
        onsets = [f for f, _, _ in frames if (song, f) in peaks]
        for k, on in enumerate(onsets):
            seg = [x for x in frames if on <= x[0] and (k + 1 == len(onsets) or x[0] < onsets[k + 1])]
            end = min([f for f, v, _ in seg if v < 0.5 and f > on], default=seg[-1][0] + 1)
            held = [m for f, _, m in seg if f < end]
            pitch = min(set(held), key=lambda m: (-held.count(m), m))
            if end * D.FRAME_S - on * D.FRAME_S >= 0.07 and 24 <= pitch <= 108:
                want.append((song, on * D.FRAME_S, end * D.FRAME_S, pitch))
    assert whole == sorted(want)


@pytest.mark.parametrize("name", ["decode_poly", "inferred_onsets", "onset_peaks"])
def test_cells_stay_with_their_song(spark, name, monkeypatch):
    monkeypatch.setattr(adapters, "PART_NOTES", 500)
    catalog.load()
    plan = _plan(QUERIES[name](spark, SF))
    assert "ENSURE_REQUIREMENTS" not in plan and "REPARTITION_BY_COL" not in plan
    assert plan.count("REPARTITION_BY_NUM") <= 2


def test_cut_songs_decode_and_score_like_whole_ones(spark, monkeypatch):
    from noteflow.operators import decode as D
    from noteflow.operators import matching as X
    from noteflow.operators import scan

    t = adapters.Tables(spark, SF)
    some = lambda df: df.filter("hash(song_id) % 200 = 0").localCheckpoint()
    post, ref, lengths = some(t.posteriors), some(t.ref_notes), some(t.song_lengths)
    pairs = [(0.3, 0.2), (0.5, 0.3), (0.9, 0.6)]
    rows = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())

    def results():
        yield rows(D.decode_poly(post, pairs, lengths=lengths))
        yield rows(D.decode_poly(post, pairs))
        yield rows(D.inferred_onsets(post))
        yield rows(D.onset_peaks(post).select(*post.columns, "is_peak"))
        for mode in ("COnPOff", "COnOff"):
            yield rows(X.threshold_sweep(post, ref, onset_grid=(0.3, 0.9), frame_grid=(0.2, 0.6), mode=mode, lengths=lengths))

    whole = list(results())
    assert all(whole)
    monkeypatch.setattr(scan, "HOT_ROWS", 150)
    for a, b in zip(whole, results(), strict=True):
        assert a == b


def test_pairs_that_decode_alike_share_a_list():
    from noteflow.operators import decode as D

    nan = float("nan")
    frame, pitch = list(range(12)) + list(range(12)), [60] * 12 + [61] * 12
    value, peak = [0.8] * 12 + [0.4] * 12, [nan, 0.9] + [nan] * 10 + [nan, 0.6] + [nan] * 10
    found = D.decodings(frame, pitch, value, peak, 40, [(0.1, 0.1), (0.5, 0.3), (0.7, 0.3), (0.5, 0.5)], 8, 4)
    assert found[0] is found[1] and found[2] is not found[1]
    assert found[0] == [(1, 12, 61)] and found[2] == [(1, 12, 60)] and found[3] == [(1, 12, 60)]


def test_frames_of_both_gates_of_a_repair_stay(spark, monkeypatch):
    monkeypatch.setattr(adapters, "PART_NOTES", 500)
    catalog.load()
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", _plan(QUERIES["relabel_repair"](spark, SF)))
    assert moved and not [m for m in moved if re.search(r"_blk|_bin|frame", m)], moved


def test_repair_aligns_samples_where_they_lie(spark, monkeypatch):
    monkeypatch.setattr(adapters, "PART_NOTES", 500)
    catalog.load()
    assert "REPARTITION_BY_COL" not in _plan(QUERIES["align_dtw"](spark, SF))
    plan = _plan(QUERIES["relabel_repair"](spark, SF))
    # What was aligned is placed with the frames before it is listed by time bin, so no listed note moves.
    listed = [m for m in re.findall(r"Exchange hashpartitioning\([^)]*\), ENSURE_REQUIREMENTS.*\n(.*)", plan) if "Generate" in m]
    assert not listed and "RoundRobin" not in plan


@pytest.mark.parametrize("name", ["verdict", "nearest_onset", "last_offset", "note_frame_join", "note_checks_pyin", "note_checks_crepe"])
def test_notes_are_shuffled_once(spark, name, monkeypatch):
    monkeypatch.setattr(adapters, "PART_NOTES", 500)
    catalog.load()
    df = QUERIES[name](spark, SF)
    df.collect()
    final = _plan(df).split("Initial Plan")[0]
    placed = [line for line in final.splitlines() if "REPARTITION_BY_NUM" in line]
    assert len(placed) > 1 and sum("ReusedExchange" not in line for line in placed) == 1


def test_labels_are_derived_from_frames_counted_once(spark, monkeypatch):
    from noteflow.operators import scan

    monkeypatch.setattr(adapters, "PART_NOTES", 500)
    catalog.load()
    counted, plain = [], scan._large_groups
    monkeypatch.setattr(scan, "_large_groups", lambda df, key, most: counted.append(key) or plain(df, key, most))
    QUERIES["derive_labels"](spark, SF)
    # The scores themselves, and nothing that is made from them.
    assert len(counted) == 1, counted


def test_stitched_cells_are_made_once(spark, monkeypatch):
    monkeypatch.setattr(adapters, "PART_NOTES", 500)
    catalog.load()
    from noteflow.operators import decode as D

    plan = _plan(QUERIES["stitch_chunks"](spark, SF))
    # The cells, the windows that see a cell, and no second making for the ends; nothing is sorted but the notes.
    assert plan.count("sequence((f_on") == 1 and "SortMergeJoin" not in plan
    t = adapters.Tables(spark, SF)
    assert t.cell_ends.exceptAll(D.song_ends(t.posteriors)).isEmpty() and D.song_ends(t.posteriors).exceptAll(t.cell_ends).isEmpty()


def test_steady_window_reads_a_row_once(spark):
    import math

    from noteflow.operators import clips as C

    level = [0.1, 0.3, 0.2, 0.2, 0.2, None, 0.2, 0.2, 0.2, 0.5]
    frames = spark.createDataFrame([("a", k, x) for k, x in enumerate(level)] + [("b", k, 0.0) for k in range(5)] + [("c", k, 0.4) for k in range(3)], "sample_id string, frame_idx long, rms double")
    out = C.steady_window(frames, 3, 4)
    assert "stddev" not in _plan(out)
    assert {r.sample_id: (r.start_frame, r.cv) for r in out.collect()} == {"a": (2, 0.0), "b": (0, math.inf), "c": (0, None)}


def test_words_are_cut_once(spark):
    from noteflow.operators import lyrics as Y

    words = ["table", "moonlight", "the", "make", "sky", "area", "e", "ae", "strengths", "little", "winter"]
    df = spark.createDataFrame([(w,) for w in words], "word string").select("word", Y._split(F.col("word"), Y.ENGLISH_VOWELS, True).alias("syl"))
    plan = df._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all(") == 1 and plan.count("split(") == 1
    assert {r.word: r.syl for r in df.collect()}["table"] == ["tab", "le"] and all("".join(r.syl) == r.word for r in df.collect())


def test_songs_are_sized_without_their_cells(spark, monkeypatch):
    from noteflow.operators import scan

    catalog.load()
    t = adapters.Tables(spark, SF)
    most, made = (df.groupBy("song_id").agg(n.alias(c)) for df, n, c in ((t.cell_counts, F.sum("rows"), "most"), (t.posteriors, F.count(F.lit(1)), "made")))
    both = made.join(most, "song_id", "left")
    assert both.filter("most >= made").count() == both.count() > 0
    told, plain = [], scan._large_groups
    monkeypatch.setattr(scan, "_large_groups", lambda df, key, *a: told.extend([(a[1].columns, a[0])] if key == "song_id" else []) or plain(df, key, *a))
    for name in ("inferred_onsets", "decode_poly", "threshold_sweep"):
        QUERIES[name](spark, SF)
    assert told == [(["song_id", "rows"], scan.HOT_ROWS)] * 3
    # A song that may have more rows than fit is cut, others are not.
    post = t.posteriors
    small, large = scan.by_size(post, "song_id", 10, spark.createDataFrame([("s1", 6), ("s1", 6), ("s2", 9)], "song_id string, rows long"))
    assert {r[0] for r in large.select("song_id").distinct().collect()} == {"s1"} and small.filter("song_id = 's1'").isEmpty()


def test_parts_of_a_song_decode_once_for_all_pairs(monkeypatch):
    from noteflow.operators import decode as D
    from noteflow.operators import matching as X

    # Three notes that cannot touch: two far apart at one pitch, one at another; and two that do, at adjacent pitches.
    spans = [(0, 60, 0.9), (100, 60, 0.5), (0, 70, 0.7), (50, 80, 0.9), (55, 81, 0.6)]
    cells = sorted((p, f, level, level if f == on else float("nan")) for on, p, level in spans for f in range(on, on + 12))
    pitch, frame, value, peak = map(list, zip(*cells))
    parts = D._apart(frame, pitch, 8)
    assert sorted(map(len, parts)) == [12, 12, 12, 24]
    grid = [(a / 10, b / 10) for a in range(1, 10) for b in range(1, 10)]
    made, plain = [], D._Sounding
    monkeypatch.setattr(D, "_Sounding", lambda loud: made.append(1) or plain(loud))
    got = D.decodings_by_part(frame, pitch, value, peak, 200, grid, 8, 4)
    # Once for each part, and again for what is left of the two that touch.
    assert len(made) <= 8
    whole = dict(zip(grid, got))
    for (on, fr), found in whole.items():
        alone = [(s, s + 12, p) for s, p, level in spans[:3] if level >= on and level >= fr]
        assert sorted(n for part in found for n in part if n[2] < 80) == sorted(alone)
    ref = [(0.0, 12 * D.FRAME_S, 60, 0.05), (0.0, 12 * D.FRAME_S, 70, 0.05), (0.01, 12 * D.FRAME_S, 60, 0.05)]
    scorer = X._Scorer(ref, X.MODES["COnP"])
    assert scorer.matched(whole[0.1, 0.1]) == 2 and scorer.matched(whole[0.8, 0.1]) == 1 and scorer.matched([]) == 0
    # Two parts whose notes share a partner.
    assert X._Scorer(ref[:1], X.MODES["COn"]).matched([[(0, 12, 60)], [(0, 12, 70)]]) == 1


def test_phrases_move_their_notes_once(spark, monkeypatch):
    from noteflow.operators import scan
    from noteflow.operators import scores as S

    monkeypatch.setattr(adapters, "PART_NOTES", 500)
    catalog.load()
    counted, plain = [], scan._large_groups
    monkeypatch.setattr(scan, "_large_groups", lambda df, key, *a: counted.append(key) or plain(df, key, *a))
    got = QUERIES["segment_phrases"](spark, SF)
    # The scores themselves, and nothing that is made from them.
    assert len(counted) == 1
    plan = _plan(got)
    assert "ENSURE_REQUIREMENTS" not in plan and "REPARTITION_BY_COL" not in plan
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(got) == rows(S.segment_phrases(adapters.Tables(spark, SF).long_notes)) != []
    done = [line for line in _plan(got).split("Initial Plan")[0].splitlines() if "REPARTITION_BY_NUM" in line]
    # The notes before the fold and after it.
    assert sum("ReusedExchange" not in line for line in done) == 2, done


def test_notes_stay_while_syllables_are_dealt(spark, monkeypatch):
    from noteflow.operators import lyrics as Y

    monkeypatch.setattr(adapters, "PART_NOTES", 500)
    catalog.load()
    t = adapters.Tables(spark, SF)
    inventory = spark.createDataFrame([(f"s{i}",) for i in range(3)], "syllable string")
    assert not re.search(r"score_id.*ENSURE_REQUIREMENTS", _plan(Y.auto_syllables(t.notes, inventory, F.lit(7))))
    # Chunks of three, with a score that has no name: each goes through the whole inventory, as a note alone would.
    notes = spark.createDataFrame([(s, i) for s in ("a", "b", None) for i in range(7)], "score_id string, note_idx int")
    got = {(r.score_id, r.note_idx): r.syllable for r in Y.auto_syllables(notes, inventory, F.lit(7)).collect()}
    place = Y.keyed_position(F.col("note_idx") % 3, 3, F.lit(7), F.floor(F.col("note_idx") / 3)).alias("at")
    assert got == {(r.score_id, r.note_idx): f"s{r.at}" for r in notes.select("*", place).collect()} and len(got) == 21
