"""Queries over transcription metrics, alignment and label repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from noteflow.operators import align as A
from noteflow.operators import gate as G
from noteflow.operators import matching as X
from noteflow.plans.gate import gated_notes
from noteflow.plans.registry import query
from noteflow.plans.views import VIEWS
from noteflow.sources.adapters import Tables

VIEWS["candidates"] = """
SELECT r.song_id, ref_idx, est_idx, e.pitch - r.pitch AS pitch_error, e.pitch = r.pitch AS pitch_ok, e.pitch % 12 = r.pitch % 12 AS class_ok,
  round(abs(r.offset_s - e.offset_s), 4) <= greatest(0.2e0 * (r.offset_s - r.onset_s), 0.05e0) AS offset_ok
FROM @ref_notes r JOIN @est_notes e ON r.song_id = e.song_id AND round(abs(r.onset_s - e.onset_s), 4) <= 0.05e0"""


def candidates(t: Tables):
    return X.match_candidates(t.ref_notes, t.est_notes)


@query("match_candidates", "SELECT song_id, ref_idx, est_idx, pitch_ok, class_ok, offset_ok FROM @candidates")
def _(t: Tables):
    return candidates(t).select("song_id", "ref_idx", "est_idx", "pitch_ok", "class_ok", "offset_ok")


@query("match_notes")
def _(t: Tables):
    return X.match_notes(candidates(t))


@query("note_prf")
def _(t: Tables):
    return X.note_prf(t.ref_notes, t.est_notes, X.match_notes(candidates(t)))


@query(
    "note_prf_totals",
    """SELECT count(*) AS songs, sum(n_ref)::BIGINT AS n_ref, sum(n_est)::BIGINT AS n_est FROM (SELECT song_id, count(*) AS n_ref FROM @ref_notes GROUP BY song_id) LEFT JOIN (SELECT song_id, count(*) AS n_est FROM @est_notes GROUP BY song_id) USING (song_id)""",
)
def _(t: Tables):
    per = X.note_prf(t.ref_notes, t.est_notes, X.match_notes(candidates(t), ("COn",))).filter("mode = 'COn'")
    return per.agg(F.count(F.lit(1)).alias("songs"), F.sum("n_ref").alias("n_ref"), F.sum("n_est").alias("n_est"))


# Modes whose pairs are close onsets within one class: with one tolerance, taking pairs in onset order is a maximum matching.
MEASURED = ("COn", "COnP")
VIEWS["onset_lists"] = """
SELECT song_id, mode, cls, coalesce(list(onset_s ORDER BY onset_s, idx) FILTER (is_ref), []) AS rs, coalesce(list(onset_s ORDER BY onset_s, idx) FILTER (NOT is_ref), []) AS es,
  list(pitch ORDER BY onset_s, idx) FILTER (is_ref) AS rp, list(pitch ORDER BY onset_s, idx) FILTER (NOT is_ref) AS ep
FROM (SELECT song_id, onset_s, idx, pitch, CASE mode WHEN 'COn' THEN 0 ELSE pitch END AS cls, mode, is_ref FROM (
  SELECT song_id, onset_s, pitch, ref_idx AS idx, true AS is_ref FROM @ref_notes UNION ALL SELECT song_id, onset_s, pitch, est_idx, false FROM @est_notes), (VALUES ('COn'), ('COnP')) v(mode)) GROUP BY song_id, mode, cls"""
_STEPS = """steps AS (
  SELECT song_id, mode, cls, rs, es, rp, ep, 1 AS i, 1 AS j, 0 AS m, CAST(NULL AS DOUBLE) AS pitch_error FROM @onset_lists
  UNION ALL
  SELECT song_id, mode, cls, rs, es, rp, ep, CASE WHEN near OR rs[i] < es[j] THEN i + 1 ELSE i END, CASE WHEN near OR rs[i] >= es[j] THEN j + 1 ELSE j END, m + CASE WHEN near THEN 1 ELSE 0 END, CASE WHEN near THEN CAST(ep[j] - rp[i] AS DOUBLE) END
  FROM (SELECT *, round(abs(rs[i] - es[j]), 4) <= 0.05e0 AS near FROM steps WHERE i <= len(rs) AND j <= len(es))
)"""
_MEASURED = _STEPS + """, matched AS (SELECT song_id, mode, sum(m) AS m FROM steps WHERE i > len(rs) OR j > len(es) GROUP BY song_id, mode
), per_song AS (
  SELECT song_id, mode, p AS precision, r AS recall, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0e0 END AS f1, 'd' || (o_custkey % 5) AS dataset, 'r' || o_orderkey AS sample_id
  FROM (SELECT song_id, mode, CASE WHEN n_est > 0 THEN m::DOUBLE / n_est ELSE 0e0 END AS p, m::DOUBLE / n_ref AS r
    FROM (SELECT song_id, count(*) AS n_ref FROM @ref_notes GROUP BY song_id) JOIN matched USING (song_id) LEFT JOIN (SELECT song_id, count(*) AS n_est FROM @est_notes GROUP BY song_id) USING (song_id))
  JOIN orders ON song_id = 's' || o_orderkey
)"""


def _per_song(t: Tables):
    """Scores of every transcribed song from its one-to-one matches."""
    return X.note_prf(t.ref_notes, t.est_notes, X.match_notes(candidates(t), MEASURED)).filter(F.col("mode").isin(*MEASURED))


def _scores(t: Tables):
    """F1 of each record's transcription, with pitch; records without labels have none."""
    key = F.concat(F.lit("r"), F.substring("song_id", 2, 20))
    return _per_song(t).filter("mode = 'COnP'").select(key.alias("sample_id"), "f1")


_F1 = f"WITH RECURSIVE {_MEASURED}, judged AS (SELECT m.*, f1 FROM @manifest m JOIN per_song p USING (sample_id) WHERE p.mode = 'COnP')"


@query(
    "f1_by_status_source",
    f"""{_F1} SELECT status, source, round(avg(f1), 6) AS note_f1_mean, count(*) AS n FROM (SELECT *, lane || '/' || voice_id || CASE WHEN coalesce(augmentation_profile, '') <> '' THEN '/' || augmentation_profile ELSE '' END AS source FROM judged)
    GROUP BY GROUPING SETS ((), (status), (source))""",
)
def _(t: Tables):
    return X.f1_by_status_source(_scores(t), t.manifest).withColumn("note_f1_mean", F.round("note_f1_mean", 6))


@query("metric_by_source", f"{_F1} SELECT lane, voice_id, coalesce(augmentation_profile, '') AS profile, round(avg(f1), 6) AS f1, count(*) AS n FROM judged GROUP BY ALL")
def _(t: Tables):
    return X.metric_by_source(_scores(t), t.manifest).withColumn("f1", F.round("f1", 6))


def _datasets(t: Tables):
    song = F.concat(F.lit("s"), F.col("o_orderkey").cast("string"))
    return t.raw("orders").select(song.alias("song_id"), F.concat(F.lit("d"), (F.col("o_custkey") % 5).cast("string")).alias("dataset"))


_MEAN = "round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(f1), 6) AS f1, count(*) AS songs FROM per_song"


def _round_means(df):
    return df.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query("metrics_by_dataset", f"WITH RECURSIVE {_MEASURED} SELECT dataset, mode, {_MEAN} GROUP BY dataset, mode")
def _(t: Tables):
    return _round_means(X.metrics_by_dataset(_per_song(t), _datasets(t)))


@query("test_metrics", f"WITH RECURSIVE {_MEASURED} SELECT dataset, mode, {_MEAN} GROUP BY GROUPING SETS ((dataset, mode), (mode))")
def _(t: Tables):
    return _round_means(X.test_metrics(_per_song(t), _datasets(t)))


@query("dataset_tolerance", "SELECT song_id, ref_idx, CASE WHEN CAST(substr(song_id, 2) AS BIGINT) % 2 = 0 THEN 0.075e0 ELSE 0.05e0 END AS onset_tol FROM @ref_notes")
def _(t: Tables):
    k = F.col("o_orderkey")
    datasets = t.raw("orders").select(F.concat(F.lit("s"), k.cast("string")).alias("song_id"), F.when(k % 2 == 0, "sung").otherwise("rendered").alias("dataset"))
    tol = t.spark.createDataFrame([("sung", 0.075), ("rendered", 0.05)], "dataset string, onset_tol double")
    return X.with_tolerance(t.ref_notes, datasets, tol).select("song_id", "ref_idx", "onset_tol")


_ERRORS = f"WITH RECURSIVE {_STEPS}, errors AS (SELECT pitch_error FROM steps WHERE mode = 'COn' AND pitch_error IS NOT NULL)"


def _errors(t: Tables):
    return X.match_notes(candidates(t), ("COn",))


@query("pitch_error_hist", f"{_ERRORS} SELECT CAST(least(floor(pitch_error + 0.5), 12) AS INTEGER) AS bin, count(*) AS n FROM errors WHERE pitch_error BETWEEN -12.5 AND 12.5 GROUP BY 1")
def _(t: Tables):
    return X.pitch_error_hist(_errors(t))


@query("pitch_error_stats", f"{_ERRORS} SELECT count(*) AS n, round(avg(pitch_error), 6) AS mean, round(stddev_pop(pitch_error), 6) AS std, median(pitch_error)::DOUBLE AS median FROM errors")
def _(t: Tables):
    return X.pitch_error_stats(_errors(t)).withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query("threshold_sweep")
def _(t: Tables):
    return X.threshold_sweep(t.posteriors, t.ref_notes, lengths=t.song_lengths, sizes=t.cell_counts)


@query("best_thresholds")
def _(t: Tables):
    return X.best_thresholds(X.threshold_sweep(t.posteriors, t.ref_notes, lengths=t.song_lengths, sizes=t.cell_counts))


VIEWS["gated"] = "SELECT n.* FROM @notes n SEMI JOIN @mono_ids USING (score_id)"
VIEWS["dtw_songs"] = """
SELECT s.*, m FROM (SELECT score_id, count(*) AS n, list(onset_s ORDER BY note_idx) AS ons, list(offset_s ORDER BY note_idx) AS offs, list(pitch_midi ORDER BY note_idx) AS ps FROM @gated GROUP BY score_id) s
JOIN (SELECT sample_id, count(*) AS m FROM @f0_frames GROUP BY sample_id) f ON f.sample_id = s.score_id WHERE m >= n"""
VIEWS["dtw_frames"] = """
SELECT f.sample_id, row_number() OVER w - 1 AS j, t_s, lead(t_s) OVER w - t_s AS step, voiced AND f0_hz > 0 AS on_air, 69e0 + 12e0 * log2(f0_hz / 440e0) AS midi
FROM @f0_frames f SEMI JOIN @dtw_songs s ON s.score_id = f.sample_id WINDOW w AS (PARTITION BY f.sample_id ORDER BY frame_idx)"""
#: One row of the dynamic programme for each frame, the note of each frame from the last to the first, and the notes' new bounds.
_COST = "least(CASE WHEN on_air THEN abs(midi - ps[i]) ELSE 1e3 END, 1e3) + 6e0 * greatest(0e0, ons[i] - t_s, t_s - offs[i])"
_ALIGNED = f"""dp AS MATERIALIZED (
  SELECT sample_id, j, list_transform(range(1, n + 1), lambda i: CASE WHEN i = 1 THEN {_COST} ELSE 'infinity'::DOUBLE END) AS best, []::BOOLEAN[] AS went
  FROM @dtw_frames JOIN @dtw_songs ON score_id = sample_id WHERE j = 0
  UNION ALL
  SELECT sample_id, j, list_transform(range(1, n + 1), lambda i: CASE WHEN went[i] THEN old[i - 1] ELSE old[i] END + {_COST}), went FROM (
    SELECT f.*, s.n, s.ons, s.offs, s.ps, dp.best AS old, list_transform(range(1, s.n + 1), lambda i: i > 1 AND dp.best[i - 1] <= dp.best[i]) AS went
    FROM dp JOIN @dtw_frames f ON f.sample_id = dp.sample_id AND f.j = dp.j + 1 JOIN @dtw_songs s ON s.score_id = dp.sample_id)
), walk AS MATERIALIZED (
  SELECT score_id AS sample_id, m - 1 AS j, n AS i FROM @dtw_songs
  UNION ALL
  SELECT walk.sample_id, walk.j - 1, walk.i - CASE WHEN dp.went[walk.i] THEN 1 ELSE 0 END FROM walk JOIN dp ON dp.sample_id = walk.sample_id AND dp.j = walk.j WHERE walk.j > 0
), held AS (
  SELECT sample_id, i, coalesce(min(j) FILTER (tuned), min(j)) AS b, coalesce(max(j) FILTER (tuned), max(j)) AS e
  FROM (SELECT walk.*, on_air AND abs(midi - ps[i]) <= 1 AS tuned FROM walk JOIN @dtw_frames USING (sample_id, j) JOIN @dtw_songs ON score_id = sample_id) GROUP BY ALL
), ends AS (
  SELECT held.sample_id, i, fb.t_s AS new_on, fe.t_s + hop AS raw_off, lead(fb.t_s) OVER (PARTITION BY held.sample_id ORDER BY i) AS nxt
  FROM held JOIN @dtw_frames fb ON fb.sample_id = held.sample_id AND fb.j = b JOIN @dtw_frames fe ON fe.sample_id = held.sample_id AND fe.j = e
  JOIN (SELECT sample_id, coalesce(step, 0.01e0) AS hop FROM @dtw_frames WHERE j = 0) h ON h.sample_id = held.sample_id
), moved AS (
  SELECT g.score_id, note_idx, pitch_midi, onset_s AS old_on, offset_s AS old_off, new_on, CASE WHEN nxt > new_on THEN least(raw_off, nxt) ELSE raw_off END AS cut_off
  FROM @gated g LEFT JOIN ends ON sample_id = g.score_id AND i = note_idx + 1
), aligned AS (
  SELECT score_id, note_idx, pitch_midi, coalesce(round_even(new_on, 3), old_on) AS onset_s, coalesce(round_even(new_off, 3), old_off) AS offset_s,
    coalesce(abs(new_on - old_on) * 1e3, 0) AS onset_dev_ms, coalesce(abs(new_off - old_off) * 1e3, 0) AS offset_dev_ms
  FROM (SELECT *, CASE WHEN cut_off > new_on THEN cut_off ELSE new_on + greatest(0.02e0, (old_off - old_on) * 0.5e0) END AS new_off FROM moved)
)"""


@query("align_dtw", f"""WITH RECURSIVE {_ALIGNED}
SELECT score_id AS sample_id, note_idx, onset_s, offset_s, pitch_midi, round(onset_dev_ms, 6) AS onset_dev_ms, round(offset_dev_ms, 6) AS offset_dev_ms FROM aligned""")
def _(t: Tables):
    return A.align_dtw(gated_notes(t), t.f0_frames).withColumns({c: F.round(c, 6) for c in ("onset_dev_ms", "offset_dev_ms")})


#: The gate over the labels as they are, and once more over the aligned ones.
_SHORT = f"< {G.DEFAULT.min_note_ms} AS short"
VIEWS["checks_plain"] = VIEWS["checks"].replace("< 100 AS short", _SHORT)
VIEWS["verdicts_plain"] = VIEWS["verdicts"].replace("@checks", "@checks_plain")
_AGAIN = {
    "gate2": VIEWS["gate_notes"].replace("@notes SEMI JOIN @mono_ids USING (score_id)", "aligned").replace(
        "SELECT score_id, note_idx, next_onset_s FROM @next_onsets",
        "SELECT score_id, note_idx, lead(onset_s, 1, 'infinity'::DOUBLE) OVER (PARTITION BY score_id ORDER BY onset_s, note_idx) AS next_onset_s FROM aligned"),
    "frames2": VIEWS["note_frames"].replace("@gate_notes", "gate2"),
    "checks2": VIEWS["checks_plain"].replace("@note_frames", "frames2"),
    "verdicts2": VIEWS["verdicts"].replace("@checks", "checks2"),
}


@query("relabel_repair", f"""WITH RECURSIVE {_ALIGNED}, {", ".join(f"{k} AS ({v})" for k, v in _AGAIN.items())}
SELECT g.score_id, g.note_idx, coalesce(a.onset_s, g.onset_s) AS onset_s, coalesce(a.offset_s, g.offset_s) AS offset_s, g.pitch_midi, a.score_id IS NOT NULL AS repaired
FROM @gated g LEFT JOIN (
  SELECT aligned.* FROM aligned SEMI JOIN (SELECT sample_id FROM @verdicts_plain WHERE status <> 'accepted') x ON x.sample_id = aligned.score_id
  SEMI JOIN (SELECT sample_id FROM verdicts2 WHERE status = 'accepted') y ON y.sample_id = aligned.score_id
) a ON a.score_id = g.score_id AND a.note_idx = g.note_idx""")
def _(t: Tables):
    return A.relabel_repair(gated_notes(t), t.f0_frames, t.sample_meta, t.parts)
