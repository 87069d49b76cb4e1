"""Queries over sample arrays, chunks, label grids and decoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from noteflow.operators import clips as C
from noteflow.operators import decode as D
from noteflow.operators import rasters as R
from noteflow.plans.registry import query
from noteflow.plans.views import VIEWS
from noteflow.sources.adapters import Tables


def r5(c):
    return F.round(c, 5)


_SQ = "list_sum(list_transform({x}, lambda v: v::DOUBLE * v::DOUBLE))"


def _rms(x: str) -> str:
    return f"sqrt({_SQ.format(x=x)} / len({x}))"


@query(
    "rms_envelope",
    f"""SELECT clip_id, k AS frame_idx, k * 8 / 64e0 AS t_s, round({_rms('samples[k * 8 + 1 : k * 8 + 16]')}, 5) AS rms
    FROM (SELECT *, unnest(range(1 + greatest(0, CAST(ceil((len(samples) - 16) / 8e0) AS BIGINT)))) AS k FROM @clips)""",
)
def _(t: Tables):
    return C.rms_envelope(t.clips.drop("vec_id"), 64, 8).withColumn("rms", r5("rms"))


@query(
    "note_rms",
    f"""SELECT score_id, note_idx, round(CASE WHEN len(p) > 0 THEN {_rms('p')} ELSE 0 END, 5) AS rms FROM (
    SELECT score_id, note_idx, samples[a + 1 : least(b, len(samples))] AS p FROM (
      SELECT n.score_id, note_idx, samples, CAST(floor(onset_s * 32) AS BIGINT) AS a, CAST(floor(offset_s * 32) AS BIGINT) AS b FROM @notes n JOIN @clips c ON n.score_id = 's' || c.vec_id))""",
)
def _(t: Tables):
    clips = t.clips.withColumn("score_id", F.concat(F.lit("s"), F.col("vec_id").cast("string")))
    return C.note_rms(clips, t.notes, 32).withColumn("rms", r5("rms"))


@query(
    "mix_at_snr",
    f"""SELECT a.clip_id, round(20 * log10(rv / (rs * (rv / pow(10e0, 0.6e0) / rs))), 5) AS snr_db, round(least(0.99e0, list_max(list_transform(m, lambda v: abs(v)))), 4) AS peak
    FROM (SELECT *, list_transform(range(1, len(samples) + 1), lambda i: samples[i]::DOUBLE * 4 + s2[i]::DOUBLE * (rv / pow(10e0, 0.6e0) / rs)) AS m FROM (
      SELECT x.clip_id, x.samples, y.samples AS s2, 4 * {_rms('x.samples')} AS rv, {_rms('y.samples')} AS rs FROM @clips x JOIN @clips y ON y.vec_id = x.vec_id + 1)) a""",
)
def _(t: Tables):
    stem = t.clips.select((F.col("vec_id") - 1).alias("vec_id"), F.col("samples").alias("stem"))
    pairs = t.clips.withColumn("vocal", F.transform("samples", lambda v: v.cast("double") * 4)).join(stem, "vec_id")
    mixed = C.mix_at_snr(pairs, "vocal", "stem", F.lit(12.0))
    return mixed.select("clip_id", r5("snr_db").alias("snr_db"), F.round(C.peak("mix"), 4).alias("peak"))


@query(
    "peak_normalize",
    """SELECT clip_id, round(list_max(list_transform(samples, lambda v: abs(v::DOUBLE * (0.9e0 / p)))), 5) AS peak, round(list_sum(list_transform(samples, lambda v: v::DOUBLE * (0.9e0 / p))), 4) AS total
    FROM (SELECT *, list_max(list_transform(samples, lambda v: abs(v)))::DOUBLE AS p FROM @clips)""",
)
def _(t: Tables):
    n = t.clips.withColumn("n", C.peak_normalize("samples"))
    return n.select("clip_id", r5(C.peak("n")).alias("peak"), F.round(F.aggregate("n", F.lit(0.0), lambda a, v: a + v), 4).alias("total"))


@query(
    "remove_dc",
    """SELECT clip_id, round(list_max(list_transform(samples, lambda v: v::DOUBLE - m)), 5) AS top, round(samples[1]::DOUBLE - m, 5) AS first
    FROM (SELECT *, list_sum(list_transform(samples, lambda v: v::DOUBLE)) / len(samples) AS m FROM @clips)""",
)
def _(t: Tables):
    n = t.clips.withColumn("n", C.remove_dc("samples"))
    return n.select("clip_id", r5(F.array_max("n")).alias("top"), r5(F.get("n", F.lit(0))).alias("first"))


@query(
    "trim_silence",
    """SELECT clip_id, CASE WHEN f IS NULL THEN len(samples) ELSE least(len(samples), l - 1 + 3) - greatest(0, f - 1 - 3) END AS n, round(CASE WHEN f IS NULL THEN samples[1] ELSE samples[greatest(0, f - 1 - 3) + 1] END::DOUBLE, 5) AS first
    FROM (SELECT *, list_min(i) AS f, list_max(i) AS l FROM (SELECT *, list_filter(range(1, len(samples) + 1), lambda k: abs(samples[k])::DOUBLE > pow(10e0, -14 / 20e0)) AS i FROM @clips))""",
)
def _(t: Tables):
    cut = t.clips.withColumn("n", C.trim_silence("samples", 64, -14.0))
    return cut.select("clip_id", F.size("n").alias("n"), r5(F.get("n", F.lit(0)).cast("double")).alias("first"))


@query(
    "periodicity",
    """SELECT clip_id, round(list_max(list_transform(range(2, 25), lambda g: list_sum(list_transform(range(1, len(samples) - g + 1), lambda i: samples[i]::DOUBLE * samples[i + g]::DOUBLE)))) / (list_sum(list_transform(samples, lambda v: v::DOUBLE * v::DOUBLE)) + 1e-9), 5) AS p FROM @clips""",
)
def _(t: Tables):
    return t.clips.select("clip_id", r5(C.periodicity("samples", 2000)).alias("p"))


@query("latency_align")
def _(t: Tables):
    shifted = F.concat(F.array_repeat(F.lit(0.0).cast("float"), 5), F.slice("samples", 1, 59))
    got = t.clips.select("clip_id", C.latency_align(shifted, "samples", 500).alias("r"))
    return got.select("clip_id", "r.latency_ms", F.size("r.samples").alias("n"))


@query(
    "steady_window",
    """SELECT sample_id, CASE WHEN n <= 10 THEN 0 ELSE b.k END AS start_frame, CASE WHEN n > 10 THEN b.cv END AS cv FROM (
    SELECT sample_id, count(*) AS n, min({'cv': cv, 'k': frame_idx}) FILTER (cv IS NOT NULL) AS b FROM (
      SELECT sample_id, frame_idx, CASE WHEN count(rms) OVER w = 10 THEN CASE WHEN avg(rms) OVER w > 1e-9 THEN round(stddev_pop(rms) OVER w / avg(rms) OVER w, 9) ELSE CAST('inf' AS DOUBLE) END END AS cv
      FROM @rms_frames WINDOW w AS (PARTITION BY sample_id ORDER BY frame_idx ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)) GROUP BY sample_id)""",
)
def _(t: Tables):
    return C.steady_window(t.rms_frames, 10)


# --- chunks and grids ------------------------------------------------------------------------

L = 16_000
VIEWS["lengths"] = "SELECT score_id, CAST(max(offset_ms) * 16 + 8000 AS BIGINT) AS n_samples FROM @notes GROUP BY score_id"
VIEWS["chunks"] = f"""
SELECT DISTINCT score_id, n_samples, unnest(CASE WHEN n_samples <= {L} THEN [0] ELSE list_append(list_transform(range(0, n_samples, {L}), lambda s: least(s, n_samples - {L})), n_samples - {L}) END) AS chunk_start FROM @lengths"""


def lengths(t: Tables):
    n = t.note_rows().groupBy("score_id").agg(F.max("offset_ms").alias("m"))
    return n.select("score_id", (F.col("m") * 16 + 8000).alias("n_samples"))


@query("make_chunks", "SELECT score_id, chunk_start FROM @chunks")
def _(t: Tables):
    return R.make_chunks(lengths(t), L).select("score_id", "chunk_start")


@query("note_chunk_overlap", f"SELECT score_id, chunk_start FROM @chunks c WHERE EXISTS (SELECT 1 FROM @notes n WHERE n.score_id = c.score_id AND offset_s > chunk_start / 16e3 AND onset_s < (chunk_start + {L}) / 16e3)")
def _(t: Tables):
    return R.note_chunk_overlap(R.make_chunks(lengths(t), L), t.notes, L).select("score_id", "chunk_start")


@query(
    "rasterize",
    f"""SELECT score_id, chunk_start, frame, pitch, arg_max(label, note_idx) AS label, CASE WHEN arg_max(label, note_idx) = 3 THEN 1 ELSE 0 END AS onset, CASE WHEN arg_max(label, note_idx) >= 2 THEN 1 ELSE 0 END AS active FROM (
    SELECT score_id, chunk_start, note_idx, pitch_midi AS pitch, frame, CASE WHEN frame = l THEN 3 ELSE 2 END AS label FROM (
    SELECT *, unnest(range(greatest(0, l), greatest(least(r, 63), CASE WHEN l >= 0 THEN least(l, 62) + 1 ELSE 0 END))) AS frame FROM (
    SELECT *, CAST(round_even(a * 16e3 / 256e0, 0) AS BIGINT) AS l, CAST(round_even(b * 16e3 / 256e0, 0) AS BIGINT) AS r FROM (
    SELECT n.*, chunk_start, onset_s - chunk_start / 16e3 AS a, offset_s - chunk_start / 16e3 AS b FROM @notes n JOIN @chunks USING (score_id)) WHERE b >= 0 AND a < {L} / 16e3) WHERE l < 63)) GROUP BY ALL""",
)
def _(t: Tables):
    return R.rasterize(R.make_chunks(lengths(t), L).select("score_id", "chunk_start"), t.notes, L)


@query(
    "pianoroll",
    "SELECT DISTINCT score_id, pitch_midi AS pitch, unnest(range(CAST(floor(onset_s / 0.05e0) AS BIGINT), CAST(floor(offset_s / 0.05e0) AS BIGINT))) AS bin FROM @notes",
)
def _(t: Tables):
    return R.pianoroll(t.notes)


@query(
    "context_chunks",
    """SELECT score_id, c AS chunk, c * 4000 - 512 AS start, (c + 1) * 4000 + 512 AS "end", least(greatest(512 - c * 4000, 0), 5024) AS pad_left, least(greatest((c + 1) * 4000 + 512 - n_samples, 0), 5024) AS pad_right
    FROM (SELECT *, unnest(range((n_samples + 511) // 4000 + 1)) AS c FROM @lengths)""",
)
def _(t: Tables):
    return R.context_chunks(lengths(t), 4000, 512).drop("n_samples")


@query("stitch_chunks", "SELECT song_id, frame, count(*) AS cells, round(sum(onset_p), 5) AS onset_p FROM @posteriors GROUP BY song_id, frame")
def _(t: Tables):
    step, ctx = 64, 8
    p = t.posteriors
    # A song is there once, so the hash tables spread evenly, and the cells are made once and not sorted.
    p = p.join(t.cell_ends.hint("shuffle_hash"), "song_id")
    # Every frame is seen by its own window and, near a border, as context of the next one.
    seen = F.sequence(F.floor((F.col("frame") - ctx) / step), F.floor((F.col("frame") + ctx) / step))
    win = p.withColumn("chunk", F.explode(seen)).withColumn("frame", F.col("frame") - F.col("chunk") * step + ctx)
    out = R.stitch_chunks(win, step, ctx)
    return out.groupBy("song_id", "frame").agg(F.count(F.lit(1)).alias("cells"), F.round(F.sum("onset_p"), 5).alias("onset_p"))


@query(
    "median_pitch_correction",
    """WITH m AS (SELECT score_id, note_idx, any_value(pitch_midi) AS p, median(f0_hz) AS med, count(*) AS n FROM @notes JOIN @f0_frames ON sample_id = score_id AND t_s >= onset_s AND t_s < offset_s AND f0_hz > 0 GROUP BY score_id, note_idx),
    o AS (SELECT f.sample_id, f.frame_idx, arg_max(pow(440e0 * pow(2e0, (m.p - 69) / 12e0) / med, 0.5e0), n.note_idx) AS ratio FROM @f0_frames f JOIN @notes n ON f.sample_id = n.score_id AND t_s >= onset_s AND t_s < offset_s AND f0_hz > 0
      JOIN m ON m.score_id = n.score_id AND m.note_idx = n.note_idx AND m.n >= 3 GROUP BY ALL)
    SELECT f.sample_id, f.frame_idx, round(f0_hz * coalesce(ratio, 1), 4) AS f0_hz FROM @f0_frames f LEFT JOIN o USING (sample_id, frame_idx)""",
)
def _(t: Tables):
    out = R.median_pitch_correction(t.notes, t.f0_frames, 0.5)
    return out.select("sample_id", "frame_idx", F.round("f0_hz", 4).alias("f0_hz"))


# --- decoders --------------------------------------------------------------------------------

_PEAK = """SELECT p.song_id, frame, pitch, onset_p FROM (SELECT *, CASE WHEN lag(frame) OVER w = frame - 1 THEN lag({v}) OVER w ELSE 0 END AS a, CASE WHEN lead(frame) OVER w = frame + 1 THEN lead({v}) OVER w ELSE 0 END AS b
  FROM {src} WINDOW w AS (PARTITION BY song_id, pitch ORDER BY frame)) p JOIN (SELECT song_id, max(frame) AS last FROM {src} GROUP BY song_id) e USING (song_id) WHERE {v} > a AND {v} > b AND frame > 0 AND frame < last"""


@query("onset_peaks", "SELECT song_id, frame, pitch FROM (" + _PEAK.format(v="onset_p", src="@posteriors") + ") WHERE onset_p >= 0.5")
def _(t: Tables):
    return D.onset_peaks(t.posteriors).filter("is_peak AND onset_p >= 0.5").select("song_id", "frame", "pitch")


VIEWS["raised"] = """
SELECT song_id, frame, pitch, frame_p, greatest(onset_p, CASE WHEN mr > 0 THEN mo * rise / mr ELSE rise END) AS onset_p FROM (
SELECT *, max(onset_p) OVER (PARTITION BY song_id) AS mo, max(rise) OVER (PARTITION BY song_id) AS mr FROM (
SELECT *, CASE WHEN frame < 2 THEN 0 ELSE greatest(least(frame_p - CASE WHEN l1 = frame - 1 THEN v1 ELSE 0 END, frame_p - CASE WHEN l2 = frame - 2 THEN v2 WHEN l1 = frame - 2 THEN v1 ELSE 0 END), 0) END AS rise FROM (
SELECT *, lag(frame) OVER w AS l1, lag(frame_p) OVER w AS v1, lag(frame, 2) OVER w AS l2, lag(frame_p, 2) OVER w AS v2 FROM @posteriors WINDOW w AS (PARTITION BY song_id, pitch ORDER BY frame))))"""


@query("inferred_onsets", "SELECT song_id, frame, pitch, round(onset_p, 6) AS onset_p FROM @raised")
def _(t: Tables):
    return D.inferred_onsets(t.posteriors, t.cell_counts).select("song_id", "frame", "pitch", F.round("onset_p", 6).alias("onset_p"))


@query("decode_poly")
def _(t: Tables):
    return D.decode_poly(t.posteriors, [(0.5, 0.3)], lengths=t.song_lengths, sizes=t.cell_counts)


VIEWS["mono_frames"] = """
SELECT song_id, frame, CASE WHEN frame = f_on + 2 AND pk % 4 = 0 THEN 0.45e0 WHEN frame = f_on THEN 0.5e0 + pk % 5 / 10e0 ELSE pk % 11 / 100e0 END AS onset_p,
  CASE WHEN frame >= f_on AND frame < f_off THEN 0.9e0 ELSE 0.1e0 END AS vad_p, CASE WHEN p >= 96 THEN p - 12 ELSE p END AS midi
FROM (SELECT score_id AS song_id, pk, pitch_midi, unnest(range(CASE WHEN note_idx = 0 THEN 0 ELSE (onset_ms + 15) // 16 END, (next_ms + 15) // 16)) AS frame, pitch_midi + CASE WHEN frame % 5 = 0 AND pk % 2 = 0 THEN 1 ELSE 0 END AS p, (onset_ms + 15) // 16 AS f_on, (offset_ms + 15) // 16 AS f_off FROM @note_rows)"""


@query(
    "first_below",
    "SELECT song_id, frame, min(CASE WHEN vad_p < 0.5 THEN frame END) OVER (PARTITION BY song_id ORDER BY frame ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS below FROM @mono_frames",
)
def _(t: Tables):
    return D.first_below(t.mono_posteriors.select("song_id", "frame", "vad_p"), 0.5).select("song_id", "frame", "below")


VIEWS["mono_peaks"] = """
SELECT song_id, (first + last) // 2 AS frame FROM (SELECT *, lag(v) OVER w AS pv, lead(v) OVER w AS nv FROM (
  SELECT song_id, g, min(frame) AS first, max(frame) AS last, any_value(onset_p) AS v FROM (SELECT *, sum(c) OVER (PARTITION BY song_id ORDER BY frame) AS g FROM (
    SELECT *, CASE WHEN onset_p = lag(onset_p) OVER (PARTITION BY song_id ORDER BY frame) THEN 0 ELSE 1 END AS c FROM @mono_frames)) GROUP BY song_id, g)
  WINDOW w AS (PARTITION BY song_id ORDER BY first)) WHERE v > pv AND v > nv AND v >= 0.4"""
VIEWS["mono_segments"] = """
SELECT song_id, onset, frame, midi, vad_p FROM (SELECT m.*, max(p.frame) OVER (PARTITION BY m.song_id ORDER BY m.frame) AS onset FROM @mono_frames m LEFT JOIN @mono_peaks p ON p.song_id = m.song_id AND p.frame = m.frame) WHERE onset IS NOT NULL"""


@query(
    "decode_mono",
    """SELECT song_id, onset * 0.016e0 AS onset_s, e * 0.016e0 AS offset_s, arg_min(midi, [-n, midi]) AS pitch FROM (
    SELECT s.song_id, s.onset, e, midi, count(*) AS n FROM @mono_segments s JOIN (
      SELECT song_id, onset, coalesce(min(frame) FILTER (vad_p < 0.5 AND frame > onset), max(frame) + 1) AS e FROM @mono_segments GROUP BY song_id, onset) x ON x.song_id = s.song_id AND x.onset = s.onset
    WHERE s.frame < e AND e * 0.016e0 - s.onset * 0.016e0 >= 0.07 GROUP BY ALL) GROUP BY song_id, onset, e HAVING arg_min(midi, [-n, midi]) BETWEEN 24 AND 108""",
)
def _(t: Tables):
    return D.decode_mono(t.mono_posteriors, 0.4, 0.5)
