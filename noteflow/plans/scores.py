"""Queries over note tables: reading, checking, segmenting, reducing."""

from __future__ import annotations

from pyspark.sql import functions as F

from noteflow.operators import scores as S
from noteflow.plans.registry import query
from noteflow.plans.views import VIEWS
from noteflow.sources import score_io
from noteflow.sources.adapters import Tables

# --- reading and writing ---------------------------------------------------------------------

# Score text with headers, blanks, short rows, bad numbers and bad notes in it; one text for both.
SCORE_LINES_SQL = """
SELECT 'scores/s' || CAST(l_orderkey AS STRING) || '.tsv' AS path,
  CASE l_partkey % 50 WHEN 0 THEN '# onset,offset,note' WHEN 1 THEN '  ' WHEN 2 THEN 'x' || chr(9) || '1' || chr(9) || '60'
    WHEN 3 THEN '1.0 2.0' WHEN 4 THEN '2.0 1.0 60' WHEN 5 THEN '0.5 0.75 128' WHEN 6 THEN '-0.5 0.75 60'
    WHEN 7 THEN 'nan 1 60' WHEN 8 THEN '1_0.5' || chr(9) || '1_1.5' || chr(9) || '60' WHEN 9 THEN ' 1e0  2e0 60.5  la la '
    ELSE CASE l_partkey % 3
      WHEN 0 THEN CAST(CAST(l_quantity AS INT) AS STRING) || '.25 ' || CAST(CAST(l_quantity AS INT) + 1 AS STRING) || '.5  ' || CAST(36 + l_partkey % 61 AS STRING)
      WHEN 1 THEN CAST(CAST(l_quantity AS INT) AS STRING) || chr(9) || CAST(CAST(l_quantity AS INT) + 1 AS STRING) || chr(9) || CAST(36 + l_partkey % 61 AS STRING) || '.5'
      ELSE CAST(CAST(l_quantity AS INT) AS STRING) || chr(9) || CAST(CAST(l_quantity AS INT) + 1 AS STRING) || chr(9) || CAST(36 + l_partkey % 61 AS STRING) || chr(9) || ' winter ' END
  END AS value
FROM {lineitem}
"""
VIEWS["score_lines"] = SCORE_LINES_SQL.format(lineitem="lineitem")
_NUM = r"^[+-]?((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+)?$"


def _num(i: int) -> str:
    c = f"c[{i}]"
    return (
        f"CASE WHEN regexp_matches({c}, '{_NUM}') THEN CAST(replace({c}, '_', '') AS DOUBLE) "
        f"WHEN regexp_matches(lower({c}), '^[+-]?(nan|inf|infinity)$') THEN CAST({c} AS DOUBLE) END"
    )


VIEWS["parsed_lines"] = f"""
SELECT path, value AS line, regexp_extract(path, '([^/]+)\\.tsv$', 1) AS score_id, onset_s, offset_s,
  CAST(round_even(p, 0) AS INTEGER) AS pitch_midi, CASE WHEN c[4] <> '' THEN c[4] END AS lyric,
  CASE WHEN NOT onset_s >= 0 OR isnan(onset_s) THEN 'onset below zero' WHEN NOT offset_s > onset_s OR isnan(offset_s) THEN 'offset not after onset'
    WHEN round_even(p, 0) NOT BETWEEN 0 AND 127 THEN 'pitch outside 0..127' END AS reason
FROM (SELECT path, value, c, {_num(1)} AS onset_s, {_num(2)} AS offset_s, {_num(3)} AS p FROM (
  SELECT path, value, CASE WHEN contains(t, chr(9)) THEN list_transform(string_split(t, chr(9)), lambda x: trim(x))
    ELSE regexp_split_to_array(t, '\\s+') END AS c
  FROM (SELECT path, value, trim(value, ' ' || chr(9)) AS t FROM @score_lines)) WHERE len(c) >= 3)
WHERE onset_s IS NOT NULL AND offset_s IS NOT NULL AND p IS NOT NULL"""


def _lines(t: Tables):
    return t.spark.sql(SCORE_LINES_SQL, lineitem=t.raw("lineitem"))


@query("read_score_tsv", "SELECT score_id, onset_s, offset_s, pitch_midi, lyric FROM @parsed_lines WHERE reason IS NULL")
def _(t: Tables):
    return score_io.parse_score_lines(_lines(t))[0]


@query("score_rejects", "SELECT path, line, reason FROM @parsed_lines WHERE reason IS NOT NULL")
def _(t: Tables):
    return score_io.parse_score_lines(_lines(t))[1]


@query(
    "read_hash_header_tsv",
    """SELECT score_id, count(*) AS notes, count(*) FILTER (lyric IS NOT NULL) AS sung
    FROM @parsed_lines WHERE reason IS NULL AND NOT starts_with(line, '#') GROUP BY score_id""",
)
def _(t: Tables):
    notes, _ = score_io.parse_score_lines(_lines(t))
    return notes.groupBy("score_id").agg(F.count(F.lit(1)).alias("notes"), F.count("lyric").alias("sung"))


@query(
    "write_score_tsv",
    """SELECT score_id, note_idx, printf('%.6f' || chr(9) || '%.6f' || chr(9) || '%d', onset_s, offset_s, pitch_midi)
      || CASE WHEN max(CASE WHEN lyric IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY score_id) = 1
         THEN chr(9) || coalesce(lyric, '') ELSE '' END AS line FROM @notes""",
)
def _(t: Tables):
    return score_io.score_lines(t.notes)


@query(
    "export_notes",
    "SELECT score_id, printf('%.6f', onset_s) AS onset, printf('%.6f', offset_s) AS \"offset\", CAST(pitch_midi AS VARCHAR) AS pitch FROM @notes",
)
def _(t: Tables):
    return score_io.export_rows(t.notes)


@query(
    "audio_catalogue",
    """SELECT url AS path FROM pages WHERE regexp_matches(lower(url), '\\.(wav|mp3|flac|ogg|m4a|aac)$')
    UNION ALL SELECT path FROM (SELECT 'a/' || doc_id || CASE doc_id % 4 WHEN 0 THEN '/x.WAV' WHEN 1 THEN '/y.tsv' WHEN 2 THEN '/skip.mp3' ELSE '/z.flac' END AS path FROM documents)
    WHERE regexp_matches(lower(path), '\\.(wav|mp3|flac)$') AND regexp_matches(path, '^a/.*[02468]') AND NOT regexp_matches(path, 'skip')""",
)
def _(t: Tables):
    tail = F.element_at(F.array(*[F.lit(x) for x in ("/x.WAV", "/y.tsv", "/skip.mp3", "/z.flac")]), (F.col("doc_id") % 4 + 1).cast("int"))
    docs = t.documents.select(F.concat(F.lit("a/"), F.col("doc_id").cast("string"), tail).alias("path"))
    pages = t.raw("pages").select(F.col("url").alias("path"))
    chosen = score_io.audio_catalogue(docs, include="^a/.*[02468]", exclude="skip")
    return score_io.audio_catalogue(pages).unionByName(chosen)


_FILES = """SELECT unnest([d || '/audio.wav', d || '/x' || doc_id || '.mp3']) AS path FROM (SELECT 'c/' || doc_id AS d, doc_id FROM documents)
UNION ALL SELECT 'c/' || doc_id || CASE WHEN doc_id % 3 = 0 THEN '/score.tsv' ELSE '/x' || doc_id || '.tsv' END FROM documents"""


@query(
    "paired_files",
    f"""WITH f AS ({_FILES}), p AS (SELECT path, regexp_extract(path, '^(.*)/', 1) AS dir, regexp_extract(path, '([^/]+)\\.[^./]+$', 1) AS stem, regexp_extract(path, '\\.([^./]+)$', 1) AS ext FROM f)
    SELECT a.path AS audio_path, l.path AS label_path FROM p a JOIN p l ON a.dir = l.dir AND l.ext = 'tsv' AND a.ext <> 'tsv'
      AND l.stem = CASE WHEN a.stem = 'audio' THEN 'score' ELSE a.stem END""",
)
def _(t: Tables):
    d = F.concat(F.lit("c/"), F.col("doc_id").cast("string"))
    own = F.concat(F.lit("/x"), F.col("doc_id").cast("string"))
    label = F.when(F.col("doc_id") % 3 == 0, F.lit("/score.tsv")).otherwise(F.concat(own, F.lit(".tsv")))
    names = F.array(F.concat(d, F.lit("/audio.wav")), F.concat(d, own, F.lit(".mp3")), F.concat(d, label))
    return score_io.paired_files(t.documents.select(F.explode(names).alias("path")))


@query("read_projected_parquet", "SELECT vec_id, label FROM embeddings")
def _(t: Tables):
    return score_io.read_projected_parquet(t.spark, f"{t.sf_dir}/embeddings.parquet", ["vec_id", "label"])


# --- checks ----------------------------------------------------------------------------------

# Raw rows, some of them invalid.
_RAW = """SELECT score_id, note_idx, onset_s - CASE WHEN pk % 20 = 0 THEN 0.5e0 ELSE 0 END AS onset_s,
  offset_s - CASE WHEN pk % 21 = 0 THEN 1e0 ELSE 0 END AS offset_s, pitch_midi + CASE WHEN pk % 22 = 0 THEN 60 ELSE 0 END AS pitch_midi FROM @notes"""
_REASON = """CASE WHEN NOT onset_s >= 0 THEN 'onset below zero' WHEN NOT offset_s > onset_s THEN 'offset not after onset'
  WHEN pitch_midi NOT BETWEEN 0 AND 127 THEN 'pitch outside 0..127' END"""


def _raw_notes(t: Tables):
    rows = t.note_rows()
    pk = F.col("pk")
    return rows.select(
        "score_id", "note_idx",
        (F.col("onset_ms") / 1000.0 - F.when(pk % 20 == 0, 0.5).otherwise(0.0)).alias("onset_s"),
        (F.col("offset_ms") / 1000.0 - F.when(pk % 21 == 0, 1.0).otherwise(0.0)).alias("offset_s"),
        (F.col("pitch_midi") + F.when(pk % 22 == 0, 60).otherwise(0)).alias("pitch_midi"),
    )


@query("valid_notes", f"SELECT * FROM ({_RAW}) WHERE {_REASON} IS NULL")
def _(t: Tables):
    return S.valid_notes(_raw_notes(t))


@query("note_rejects", f"SELECT *, {_REASON} AS reason FROM ({_RAW}) WHERE {_REASON} IS NOT NULL")
def _(t: Tables):
    return S.note_rejects(_raw_notes(t))


@query(
    "sort_notes",
    f"""SELECT score_id, CAST(row_number() OVER (PARTITION BY score_id ORDER BY onset_s, offset_s, note_idx) - 1 AS INTEGER) AS note_idx,
    onset_s, offset_s, pitch_midi FROM ({_RAW})""",
)
def _(t: Tables):
    return S.sort_notes(_raw_notes(t))


_NEXT = """SELECT score_id, note_idx, onset_s, offset_s, lead(onset_s, 1, CAST('inf' AS DOUBLE)) OVER (PARTITION BY score_id ORDER BY onset_s, note_idx) AS next_onset_s FROM @notes"""
VIEWS["next_onsets"] = _NEXT


@query("next_onset", "SELECT score_id, note_idx, round(next_onset_s, 6) AS next_onset_s FROM @next_onsets WHERE next_onset_s < 1e300")
def _(t: Tables):
    out = S.next_onset(t.notes)
    return out.filter("next_onset_s < 1e300").select("score_id", "note_idx", F.round("next_onset_s", 6).alias("next_onset_s"))


VIEWS["mono"] = """SELECT score_id, bool_and(offset_s <= next_onset_s + 1e-9) AS monophonic,
  count(*) FILTER (next_onset_s + 1e-9 < offset_s) AS n_overlaps, count(*) AS n_notes, max(offset_s) AS duration_s FROM @next_onsets GROUP BY score_id"""


@query("monophony", "SELECT score_id, monophonic, n_notes, duration_s FROM @mono")
def _(t: Tables):
    return S.monophony(t.notes).drop("n_overlaps")


@query("score_overlap_count", "SELECT score_id, n_overlaps FROM @mono WHERE n_overlaps > 0")
def _(t: Tables):
    return S.monophony(t.notes).filter("n_overlaps > 0").select("score_id", "n_overlaps")


@query(
    "learn_min_note_ms",
    """SELECT round(greatest(p, 10e0, 50e0), 6) AS min_note_ms, round(p, 6) AS data_percentile_ms, 1e0 AS percentile, 10e0 AS largest_frame_hop_ms,
    50e0 AS onset_tolerance_ms, n AS n_notes FROM (SELECT quantile_cont((offset_s - onset_s) * 1e3, 0.01) AS p, count(*) AS n FROM @notes)""",
)
def _(t: Tables):
    out = S.learn_min_note_ms(t.notes, 1.0, {"align": 10.0, "f0": 5.0}).drop("method_frame_hops_ms")
    return out.withColumns({c: F.round(c, 6) for c in ("min_note_ms", "data_percentile_ms")})


@query(
    "distribution",
    """SELECT 'pitch' AS measure, count(*) AS count, min(pitch_midi)::DOUBLE AS min, quantile_cont(pitch_midi::DOUBLE, 0.25) AS p25,
      quantile_cont(pitch_midi::DOUBLE, 0.5) AS median, quantile_cont(pitch_midi::DOUBLE, 0.75) AS p75, max(pitch_midi)::DOUBLE AS max, round(avg(pitch_midi), 6) AS mean FROM @notes
    UNION ALL SELECT 'duration_ms', count(*), round(min(d), 6), round(quantile_cont(d, 0.25), 6), round(quantile_cont(d, 0.5), 6), round(quantile_cont(d, 0.75), 6), round(max(d), 6), round(avg(d), 6)
    FROM (SELECT (offset_s - onset_s) * 1e3 AS d FROM @notes)""",
)
def _(t: Tables):
    notes = t.notes.withColumn("d", (F.col("offset_s") - F.col("onset_s")) * 1000.0)
    both = S.distribution(notes, "pitch_midi").withColumn("measure", F.lit("pitch")).unionByName(
        S.distribution(notes, "d").withColumn("measure", F.lit("duration_ms"))
    )
    return both.withColumns({c: F.round(c, 6) for c in ("min", "p25", "median", "p75", "max", "mean")})


# --- segmentation ----------------------------------------------------------------------------

VIEWS["centred"] = """
SELECT n.score_id, note_idx, pitch_midi + shift AS pitch_midi, shift, pitch_midi + shift BETWEEN 55 AND 79 AS in_range
FROM @notes n JOIN (SELECT score_id, CAST(12 * round_even((67 - list_sort(list(pitch_midi))[count(*) // 2 + 1]) / 12e0, 0) AS INTEGER) AS shift
  FROM @notes GROUP BY score_id) s ON n.score_id = s.score_id"""


@query("octave_centre", "SELECT * FROM @centred")
def _(t: Tables):
    return S.octave_centre(t.notes).select("score_id", "note_idx", "pitch_midi", "shift", "in_range")


@query(
    "singable_filter",
    """SELECT score_id, n, count(*) FILTER (r = 'out_of_range') AS out_of_range, count(*) FILTER (r = 'short') AS short FROM (
    SELECT score_id, count(*) OVER (PARTITION BY score_id) AS n, CASE WHEN pitch_midi NOT BETWEEN 55 AND 79 THEN 'out_of_range' WHEN offset_s - onset_s < 0.08e0 THEN 'short' END AS r FROM @notes)
    GROUP BY score_id, n""",
)
def _(t: Tables):
    reason = S.singable(F.col("pitch_midi"), F.col("offset_s") - F.col("onset_s"))
    return t.notes.withColumn("r", reason).groupBy("score_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("r") == "out_of_range").alias("out_of_range"),
        F.count_if(F.col("r") == "short").alias("short"),
    )


@query(
    "rest_split",
    """SELECT score_id, note_idx, max(s) OVER (PARTITION BY score_id ORDER BY note_idx) AS rest_group FROM (
    SELECT *, CASE WHEN p IS NULL OR onset_s - p >= 0.4e0 THEN note_idx END AS s FROM (
    SELECT *, lag(offset_s) OVER (PARTITION BY score_id ORDER BY note_idx) AS p FROM @long_notes))""",
)
def _(t: Tables):
    return S.rest_split(t.long_notes, 0.4).select("score_id", "note_idx", "rest_group")


VIEWS["phrase_fold"] = """
SELECT * FROM (WITH RECURSIVE n AS (SELECT *, lag(offset_s) OVER (PARTITION BY score_id ORDER BY note_idx) AS p FROM @long_notes),
f AS (SELECT score_id, note_idx, onset_s, offset_s, pitch_midi, onset_s AS first, note_idx AS phrase_start FROM n WHERE note_idx = 0
  UNION ALL SELECT n.score_id, n.note_idx, n.onset_s, n.offset_s, n.pitch_midi,
    CASE WHEN n.onset_s - n.p >= 0.4e0 OR n.offset_s - f.first > 12e0 THEN n.onset_s ELSE f.first END,
    CASE WHEN n.onset_s - n.p >= 0.4e0 OR n.offset_s - f.first > 12e0 THEN n.note_idx ELSE f.phrase_start END
  FROM f JOIN n ON n.score_id = f.score_id AND n.note_idx = f.note_idx + 1)
SELECT * FROM f)"""
VIEWS["phrases"] = """
SELECT score_id || '_p' || lpad(CAST(pi AS VARCHAR), CAST(greatest(3, length(CAST(pi AS VARCHAR))) AS INTEGER), '0') AS score_id, note_idx,
  round(onset_s - t0, 3) AS onset_s, round(offset_s - t0, 3) AS offset_s, pitch FROM (
SELECT *, dense_rank() OVER (PARTITION BY score_id ORDER BY phrase_start) - 1 AS pi FROM (
SELECT *, min(onset_s) OVER (PARTITION BY score_id, phrase_start) - 0.2e0 AS t0, count(*) OVER (PARTITION BY score_id, phrase_start) AS kept FROM (
SELECT f.*, pitch_midi + shift AS pitch, n FROM @phrase_fold f JOIN (
  SELECT score_id, phrase_start, count(*) AS n, max_by(offset_s, note_idx) - min(onset_s) AS span,
    CAST(12 * round_even((67 - list_sort(list(pitch_midi))[count(*) // 2 + 1]) / 12e0, 0) AS INTEGER) AS shift
  FROM @phrase_fold GROUP BY ALL) s USING (score_id, phrase_start)
WHERE n >= 4 AND span >= 1 AND pitch_midi + shift BETWEEN 55 AND 79)) WHERE (n - kept) / n <= 0.2e0)"""


@query("segment_phrases", "SELECT score_id, note_idx, onset_s, offset_s, pitch AS pitch_midi FROM @phrases")
def _(t: Tables):
    return S.segment_phrases(t.long_notes, parts=t.long_parts)


@query(
    "ingest_report",
    """SELECT a.songs, b.phrases, round_even(b.phrases / a.songs, 1) AS phrases_per_song, a.notes_in, b.notes_out, round_even(b.notes_out / a.notes_in, 3) AS note_retention
    FROM (SELECT count(DISTINCT score_id) AS songs, count(*) AS notes_in FROM @long_notes) a, (SELECT count(DISTINCT score_id) AS phrases, count(*) AS notes_out FROM @phrases) b""",
)
def _(t: Tables):
    return S.ingest_report(t.long_notes, S.segment_phrases(t.long_notes))


# --- melody ----------------------------------------------------------------------------------

VIEWS["picked"] = """
SELECT e.*, CASE WHEN m.melody IS NOT NULL THEN 'melody_track' ELSE 'skyline' END AS method FROM @events_poly e LEFT JOIN (
  SELECT song_id, min(track) AS melody FROM @events_poly WHERE NOT is_drum AND regexp_matches(lower(trim(track_name)), 'melody|vocal|lead|voice|sing') GROUP BY song_id) m USING (song_id)
WHERE NOT is_drum AND (m.melody IS NULL OR m.melody = track)"""
VIEWS["line"] = """
SELECT * FROM (WITH RECURSIVE o AS (SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY start_s, -pitch, track, end_s) AS i FROM @picked),
f AS (SELECT song_id, i, start_s, end_s, pitch, method, end_s AS te, pitch AS tp, true AS entered FROM o WHERE i = 1
  UNION ALL SELECT o.song_id, o.i, o.start_s, o.end_s, o.pitch, o.method,
    CASE WHEN o.start_s < f.te AND o.pitch <= f.tp THEN f.te ELSE o.end_s END, CASE WHEN o.start_s < f.te AND o.pitch <= f.tp THEN f.tp ELSE o.pitch END,
    NOT (o.start_s < f.te AND o.pitch <= f.tp) FROM f JOIN o ON o.song_id = f.song_id AND o.i = f.i + 1)
SELECT song_id, start_s, least(end_s, coalesce(nx, end_s)) AS end_s, pitch, method, i FROM (
  SELECT *, lead(start_s) OVER (PARTITION BY song_id ORDER BY i) AS nx FROM f WHERE entered)
WHERE NOT (coalesce(nx < end_s, false) AND nx - start_s <= 1e-3))"""
VIEWS["melody"] = """
SELECT *, CASE WHEN out_pitch NOT BETWEEN 55 AND 79 THEN 'out_of_range' WHEN end_s - start_s < 0.08e0 THEN 'short' END AS r FROM (
SELECT l.*, pitch + shift AS out_pitch, shift FROM @line l JOIN (SELECT song_id,
  CAST(12 * round_even((67 - list_sort(list(pitch))[count(*) // 2 + 1]) / 12e0, 0) AS INTEGER) AS shift FROM @line GROUP BY song_id) s ON l.song_id = s.song_id)"""
VIEWS["melody_stats"] = """
SELECT song_id, CASE WHEN notes_out > 0 THEN method ELSE 'rejected' END AS method, coalesce(notes_in, 0) AS notes_in, coalesce(notes_out, 0) AS notes_out,
  coalesce(oor, 0) AS dropped_out_of_range, coalesce(sh, 0) AS dropped_short, coalesce(shift, 0) AS transposed_semitones, pitch_in_lo, pitch_in_hi, pitch_out_lo, pitch_out_hi,
  CASE WHEN method IS NULL THEN 'no pitched notes' WHEN notes_out = 0 THEN 'nothing in singable range' ELSE '' END AS reject_reason
FROM (SELECT DISTINCT song_id FROM @events_poly) LEFT JOIN (
  SELECT song_id, min(method) AS method, count(*) AS notes_in, count(*) FILTER (r IS NULL) AS notes_out, count(*) FILTER (r = 'out_of_range') AS oor,
    count(*) FILTER (r = 'short') AS sh, max(shift) AS shift, min(pitch) AS pitch_in_lo, max(pitch) AS pitch_in_hi,
    min(out_pitch) FILTER (r IS NULL) AS pitch_out_lo, max(out_pitch) FILTER (r IS NULL) AS pitch_out_hi FROM @melody GROUP BY song_id) USING (song_id)"""


@query("pick_melody_track", "SELECT song_id, track, start_s, end_s, pitch, method FROM @picked")
def _(t: Tables):
    return S.pick_melody_track(t.events_poly).select("song_id", "track", "start_s", "end_s", "pitch", "method")


@query("skyline", "SELECT song_id, start_s, end_s, pitch FROM @line")
def _(t: Tables):
    return S.skyline(S.pick_melody_track(t.events_poly)).select("song_id", "start_s", "end_s", "pitch")


@query(
    "extract_melody",
    """SELECT song_id, round(start_s - t0, 3) AS onset_s, round(end_s - t0, 3) AS offset_s, out_pitch AS pitch_midi FROM (
    SELECT *, min(start_s) OVER (PARTITION BY song_id) - 0.2e0 AS t0 FROM @melody WHERE r IS NULL)""",
)
def _(t: Tables):
    return S.melody_notes(S.melody_lines(t.events_poly))


@query("melody_stats", "SELECT * FROM @melody_stats")
def _(t: Tables):
    return S.melody_stats(t.events_poly, S.melody_lines(t.events_poly))


@query(
    "extraction_report",
    """SELECT count(*) AS files, count(*) FILTER (ok) AS accepted, count(*) FILTER (NOT ok) AS rejected, round(count(*) FILTER (ok) / count(*), 3) AS yield,
    count(*) FILTER (method = 'melody_track') AS melody_track, count(*) FILTER (method = 'skyline') AS skyline,
    sum(notes_in) FILTER (ok)::BIGINT AS notes_in_total, sum(notes_out) FILTER (ok)::BIGINT AS notes_out_total, sum(dropped_out_of_range) FILTER (ok)::BIGINT AS dropped_out_of_range,
    sum(dropped_short) FILTER (ok)::BIGINT AS dropped_short, min(pitch_in_lo) FILTER (ok) AS pitch_in_lo, max(pitch_in_hi) FILTER (ok) AS pitch_in_hi,
    min(pitch_out_lo) FILTER (ok) AS pitch_out_lo, max(pitch_out_hi) FILTER (ok) AS pitch_out_hi
    FROM (SELECT *, method <> 'rejected' AND notes_out > 0 AS ok FROM @melody_stats)""",
)
def _(t: Tables):
    return S.extraction_report(S.melody_stats(t.events_poly, S.melody_lines(t.events_poly)))


# --- parallel arrays -------------------------------------------------------------------------

VIEWS["cells"] = """
SELECT row_key, i, CAST(round_even(note_midi[i], 0) AS INTEGER) AS pitch, note_start_times[i] AS s, note_end_times[i] AS e, trim(note_lyrics[i]) AS l
FROM (SELECT *, unnest(range(1, len(note_midi) + 1)) AS i FROM @parallel_notes)"""
VIEWS["slurred"] = """
SELECT row_key, g, min(s) AS onset_s, max_by(e, i) AS offset_s, min(pitch) AS pitch_midi FROM (
SELECT *, sum(CASE WHEN l IN ('—', '-', '_') AND pitch = pp AND abs(pe - s) <= 0.002e0 THEN 0 ELSE 1 END) OVER (PARTITION BY row_key ORDER BY i) AS g FROM (
SELECT *, lag(pitch) OVER w AS pp, lag(e) OVER w AS pe FROM @cells WHERE pitch > 0 WINDOW w AS (PARTITION BY row_key ORDER BY i))) GROUP BY row_key, g"""
VIEWS["segments"] = """
SELECT row_key, segment_id, CASE WHEN segment_id = '' THEN 'segment_id is empty' WHEN len(note_end_times) <> len(note_midi) THEN 'arrays differ in length'
  WHEN bad_time THEN 'invalid note timing' WHEN high THEN 'pitch outside 1..127' WHEN ov THEN 'overlapping notes' WHEN n IS NULL THEN 'empty' ELSE 'usable' END AS outcome
FROM @parallel_notes LEFT JOIN (SELECT row_key, bool_or(s < 0 OR e <= s) AS bad_time, bool_or(pitch > 127) AS high FROM @cells GROUP BY row_key) USING (row_key)
LEFT JOIN (SELECT row_key, count(*) AS n, bool_or(coalesce(offset_s > nx + 1e-9, false)) AS ov FROM (SELECT *, lead(onset_s) OVER (PARTITION BY row_key ORDER BY onset_s) AS nx FROM @slurred) GROUP BY row_key) USING (row_key)"""


@query(
    "merge_slurs",
    """SELECT segment_id AS score_id, CAST(row_number() OVER (PARTITION BY row_key ORDER BY onset_s) - 1 AS INTEGER) AS note_idx, onset_s, offset_s, pitch_midi
    FROM @slurred JOIN @segments USING (row_key) WHERE outcome = 'usable'""",
)
def _(t: Tables):
    return S.merge_slurs(t.parallel_notes)[0]


@query("segment_outcomes", "SELECT segment_id, row_key, outcome FROM @segments")
def _(t: Tables):
    return S.merge_slurs(t.parallel_notes)[1]


@query(
    "ace_ingest_counters",
    """SELECT count(*) AS selected, count(*) FILTER (outcome NOT IN ('usable', 'empty')) AS invalid, count(*) FILTER (outcome = 'empty') AS empty,
    count(*) FILTER (outcome = 'usable') AS usable, count(*) FILTER (outcome = 'usable' AND row_key % 9 = 0) AS existing, count(*) FILTER (outcome = 'usable' AND row_key % 9 <> 0) AS written FROM @segments""",
)
def _(t: Tables):
    _, outcome = S.merge_slurs(t.parallel_notes)
    have = t.raw("orders").filter("o_orderkey % 9 = 0").select(F.concat(F.lit("seg/"), F.col("o_orderkey").cast("string")).alias("segment_id"))
    return S.ingest_counters(outcome, have)
