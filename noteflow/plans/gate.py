"""Queries over the alignment gate and label re-derivation."""

from __future__ import annotations

from pyspark.sql import functions as F

import noteflow.plans.scores  # noqa: F401 - its views are used here
from noteflow.operators import gate as G
from noteflow.operators import scores as S
from noteflow.plans.registry import query
from noteflow.plans.views import VIEWS
from noteflow.sources.adapters import Tables

VIEWS["mono_ids"] = "SELECT score_id FROM @mono WHERE monophonic"
VIEWS["gate_notes"] = """
SELECT n.*, next_onset_s, onset_s - 0.15e0 AS on_lo, onset_s + 0.15e0 AS on_hi, offset_s - off_win AS off_lo, least(offset_s + off_win, next_onset_s) AS off_hi,
  onset_s + 0.1e0 * (offset_s - onset_s) AS sus_lo, offset_s - 0.1e0 * (offset_s - onset_s) AS sus_hi, 440e0 * pow(2e0, (pitch_midi - 69) / 12e0) AS f_ref
FROM (SELECT *, greatest(0.15e0, tol / 1e3) AS off_win FROM (
  SELECT *, greatest(50e0, 0.2e0 * ((offset_s - onset_s) * 1e3)) AS tol FROM @notes SEMI JOIN @mono_ids USING (score_id))) n
JOIN (SELECT score_id, note_idx, next_onset_s FROM @next_onsets) x USING (score_id, note_idx)"""
VIEWS["near_frames"] = """
SELECT *, lag(f0_hz) OVER w AS pf, lag(voiced) OVER w AS pv, lag(frame_idx) OVER w AS pi, lead(f0_hz) OVER w AS nf, lead(voiced) OVER w AS nv, lead(frame_idx) OVER w AS ni
FROM @f0_frames WINDOW w AS (PARTITION BY sample_id ORDER BY frame_idx)"""
_TUNE = "coalesce({v} AND abs(1200e0 * log2({f} / f_ref)) <= 25, false)"
VIEWS["note_frames"] = f"""
SELECT *, cur AND pi IS NOT NULL AND NOT prv AS rising, cur AND ni IS NOT NULL AND NOT nxt AS falling FROM (
SELECT n.*, frame_idx, t_s, pi, ni, {_TUNE.format(v='voiced', f='f0_hz')} AS cur, {_TUNE.format(v='pv', f='pf')} AS prv, {_TUNE.format(v='nv', f='nf')} AS nxt
FROM @gate_notes n LEFT JOIN @near_frames f ON f.sample_id = n.score_id AND t_s BETWEEN least(on_lo, off_lo) AND greatest(on_hi, off_hi, offset_s))"""
VIEWS["checks"] = """
SELECT *, abs(onset_t - onset_s) * 1e3 AS onset_dev_ms, abs(offset_t - offset_s) * 1e3 AS offset_dev_ms,
  coalesce(abs(onset_t - onset_s) * 1e3 <= 50, false) AS onset_ok, coalesce(abs(offset_t - offset_s) * 1e3 <= tol, false) AS offset_ok,
  (n_sus + n_all > 0) AND coverage >= 0.8e0 AS f0_ok, (offset_s - onset_s) * 1e3 + 1e-6 < 100 AS short FROM (
SELECT score_id AS sample_id, note_idx, onset_s, offset_s, tol,
  coalesce(arg_min(t_s, [abs(t_s - onset_s), t_s]) FILTER (rising AND t_s BETWEEN on_lo AND on_hi), arg_min(t_s, [abs(t_s - onset_s), t_s]) FILTER (cur AND t_s BETWEEN on_lo AND on_hi)) AS onset_t,
  coalesce(max(t_s) FILTER (falling AND t_s BETWEEN off_lo AND off_hi), max(t_s) FILTER (cur AND t_s BETWEEN off_lo AND off_hi)) AS offset_t,
  count(*) FILTER (t_s BETWEEN sus_lo AND sus_hi) AS n_sus, count(*) FILTER (t_s BETWEEN onset_s AND offset_s) AS n_all,
  CASE WHEN n_sus > 0 THEN count(*) FILTER (cur AND t_s BETWEEN sus_lo AND sus_hi) / n_sus WHEN n_all > 0 THEN count(*) FILTER (cur AND t_s BETWEEN onset_s AND offset_s) / n_all ELSE 0 END AS coverage
FROM @note_frames GROUP BY ALL)"""
VIEWS["verdicts"] = """
SELECT sample_id, CASE WHEN v.onset_ok IS NULL THEN 'rejected' WHEN coalesce(snr_db < 0, false) THEN 'quarantined' WHEN peak > 1 + 1e-6 OR NOT (v.onset_ok AND v.offset_ok AND v.f0_ok) THEN 'rejected'
    WHEN n_short > 0 THEN 'flagged' ELSE 'accepted' END AS status, coalesce(v.onset_ok, false) AS onset_ok, coalesce(v.offset_ok, false) AS offset_ok, coalesce(v.f0_ok, false) AS f0_ok, snr_db,
  v.onset_ok IS NOT NULL AND peak > 1 + 1e-6 AS clipping, v.onset_ok IS NOT NULL AND coalesce(snr_db < 0, false) AS snr_fail, coalesce(n_short, 0) AS n_short, coalesce(n_reasons, 0) AS n_reasons, coalesce(dev, 0) AS dev
FROM @sample_meta m LEFT JOIN (SELECT sample_id, bool_and(onset_ok) AS onset_ok, bool_and(offset_ok) AS offset_ok, bool_and(f0_ok) AS f0_ok, count(*) FILTER (short) AS n_short, max(onset_dev_ms) AS dev,
  count(*) FILTER (NOT onset_ok) + count(*) FILTER (NOT offset_ok) + count(*) FILTER (NOT f0_ok) AS n_reasons FROM @checks GROUP BY sample_id) v USING (sample_id)"""

#: Another floor than the learned one, so that short notes occur in the test tables.
FLOOR = G.Tolerances(min_note_ms=100.0)
#: Other measurement grids: frames per 20 ms as a fraction, and the delay of the measured times in ms.
GRIDS = {"pyin": (441, 512, 0), "crepe": (2, 1, 15)}

# The same views with the learned floor, and over each of the grids.
VIEWS["floor"] = "SELECT greatest(quantile_cont((offset_s - onset_s) * 1e3, 0.01), 10e0, 50e0) AS floor_ms FROM @notes"
VIEWS["checks_learned"] = VIEWS["checks"].replace("< 100 AS short", "< (SELECT floor_ms FROM @floor) AS short")
VIEWS["verdicts_learned"] = VIEWS["verdicts"].replace("@checks", "@checks_learned")
for grid, (up, down, delay) in GRIDS.items():
    VIEWS[f"f0_{grid}"] = f"""
SELECT sample_id, j AS frame_idx, (j * {20 * down} + {delay * up})::DOUBLE / {1000.0 * up}::DOUBLE - {delay / 1000.0}::DOUBLE AS t_s, f0_hz, voiced FROM (
SELECT *, unnest(range((frame_idx * {up} + {down - 1}) // {down}, ((frame_idx + 1) * {up} + {down - 1}) // {down})) AS j FROM @f0_frames)"""
    VIEWS[f"near_{grid}"] = VIEWS["near_frames"].replace("@f0_frames", f"@f0_{grid}")
    VIEWS[f"frames_{grid}"] = VIEWS["note_frames"].replace("@near_frames", f"@near_{grid}")
    VIEWS[f"checks_{grid}"] = VIEWS["checks"].replace("@note_frames", f"@frames_{grid}")


def gated_notes(t: Tables):
    """Notes of the monophonic scores; the others are refused before any measurement."""
    notes = t.notes
    mono = S.monophony(notes, t.whole).filter("monophonic").select("score_id")
    return notes.join(mono, "score_id", "left_semi")


def checks(t: Tables):
    return G.note_checks(gated_notes(t), t.f0_frames, FLOOR, t.whole)


@query("note_frame_join", "SELECT score_id AS sample_id, note_idx, frame_idx, cur AS in_tune, rising, falling FROM @note_frames WHERE frame_idx IS NOT NULL")
def _(t: Tables):
    return G.note_frame_join(gated_notes(t), t.f0_frames, whole=t.whole).select("sample_id", "note_idx", "frame_idx", "in_tune", "rising", "falling")


@query("nearest_onset", "SELECT sample_id, note_idx, round(onset_t, 6) AS onset_t, round(onset_dev_ms, 6) AS onset_dev_ms, onset_ok FROM @checks")
def _(t: Tables):
    return checks(t).select("sample_id", "note_idx", F.round("onset_t", 6).alias("onset_t"), F.round("onset_dev_ms", 6).alias("onset_dev_ms"), "onset_ok")


@query("last_offset", "SELECT sample_id, note_idx, round(offset_t, 6) AS offset_t, round(offset_dev_ms, 6) AS offset_dev_ms, offset_ok FROM @checks")
def _(t: Tables):
    return checks(t).select("sample_id", "note_idx", F.round("offset_t", 6).alias("offset_t"), F.round("offset_dev_ms", 6).alias("offset_dev_ms"), "offset_ok")


@query("note_checks", "SELECT sample_id, note_idx, onset_ok, offset_ok, f0_ok, short, round(coverage, 6) AS coverage FROM @checks")
def _(t: Tables):
    return checks(t).select("sample_id", "note_idx", "onset_ok", "offset_ok", "f0_ok", "short", F.round("coverage", 6).alias("coverage"))


for _grid in GRIDS:

    @query(f"note_checks_{_grid}", f"SELECT sample_id, note_idx, round(onset_dev_ms, 4) AS onset_dev_ms, onset_ok, offset_ok, f0_ok, round(coverage, 6) AS coverage FROM @checks_{_grid}")
    def _(t: Tables, grid: str = _grid):
        """The gate over another hop and group delay."""
        up, down, delay = GRIDS[grid]
        tol = G.Tolerances(min_note_ms=100.0, group_delay_ms=float(delay))
        out = G.note_checks(gated_notes(t), t.f0_frames_at(up, down, delay), tol, t.whole)
        return out.select("sample_id", "note_idx", F.round("onset_dev_ms", 4).alias("onset_dev_ms"), "onset_ok", "offset_ok", "f0_ok", F.round("coverage", 6).alias("coverage"))


@query("verdict", "SELECT * EXCLUDE (dev), round(dev, 6) AS max_onset_dev_ms FROM @verdicts")
def _(t: Tables):
    return G.verdict(checks(t), t.sample_meta).withColumn("max_onset_dev_ms", F.round("max_onset_dev_ms", 6))


@query(
    "verdict_reasons",
    """SELECT sample_id, note_idx, CAST(seq AS INTEGER) AS seq, reason FROM (
    SELECT sample_id, note_idx, 0 AS seq, CASE WHEN onset_t IS NULL THEN printf('note %d: no in-tune onset detected', note_idx) ELSE printf('note %d: onset off by %.0f ms (> 50 ms)', note_idx, onset_dev_ms) END AS reason FROM @checks WHERE NOT onset_ok
    UNION ALL SELECT sample_id, note_idx, 1, CASE WHEN offset_t IS NULL THEN printf('note %d: no in-tune offset detected', note_idx) ELSE printf('note %d: offset off by %.0f ms (> %.0f ms)', note_idx, offset_dev_ms, tol) END FROM @checks WHERE NOT offset_ok
    UNION ALL SELECT sample_id, note_idx, 2, printf('note %d: f0 in tune for %.0f%% of the note (< 80%%)', note_idx, coverage * 100) FROM @checks WHERE NOT f0_ok
    UNION ALL SELECT sample_id, note_idx, 3, printf('note %d: shorter than min_note_ms=100.0', note_idx) FROM @checks JOIN @verdicts USING (sample_id) WHERE short AND status <> 'rejected'
    UNION ALL SELECT sample_id, NULL, 4, printf('clipping: peak=%.3f > 1.0', peak) FROM @verdicts JOIN @sample_meta USING (sample_id) WHERE clipping
    UNION ALL SELECT sample_id, NULL, 5, printf('snr %.1f dB below floor 0.0 dB', snr_db) FROM @verdicts WHERE snr_fail)""",
)
def _(t: Tables):
    return G.verdict_reasons(checks(t), t.sample_meta, FLOOR)


@query("gate_summary", "SELECT status, count(*) AS samples FROM @verdicts_learned GROUP BY status")
def _(t: Tables):
    """Acceptance by verdict: read, check, learn the floor, measure, judge."""
    floor = S.learn_min_note_ms(t.notes, 1.0, {"align": 10.0, "f0": 5.0}).first()["min_note_ms"]
    found = G.note_checks(gated_notes(t), t.f0_frames, G.Tolerances(min_note_ms=floor), t.whole)
    return G.verdict(found, t.sample_meta).groupBy("status").agg(F.count(F.lit(1)).alias("samples"))


@query(
    "edges",
    f"""SELECT sample_id, frame_idx, cur AND pi IS NOT NULL AND NOT prv AS rising, cur AND ni IS NOT NULL AND NOT nxt AS falling FROM (
    SELECT f.*, {_TUNE.format(v='voiced', f='f0_hz')} AS cur, {_TUNE.format(v='pv', f='pf')} AS prv, {_TUNE.format(v='nv', f='nf')} AS nxt
    FROM @near_frames f JOIN (SELECT score_id AS sample_id, 440e0 * pow(2e0, (pitch_midi - 69) / 12e0) AS f_ref FROM @notes WHERE note_idx = 0) USING (sample_id))""",
)
def _(t: Tables):
    first = t.notes.filter("note_idx = 0").select(F.col("score_id").alias("sample_id"), "pitch_midi")
    return G.edges(t.f0_frames, first)


_MIX = """SELECT sample_id, status, onset_ok, offset_ok, f0_ok, reason, coalesce(acc_shift_ms, ord % 90) AS shift FROM @manifest"""
_STANDS = "(shift > 50 OR status = 'quarantined' OR contains(coalesce(reason, ''), 'clipping') OR NOT f0_ok)"


@query(
    "mix_verdict",
    f"""SELECT sample_id, CASE WHEN {_STANDS} THEN status WHEN contains(coalesce(reason, ''), 'shorter than min_note_ms') THEN 'flagged' ELSE 'accepted' END AS status,
    onset_ok OR NOT {_STANDS} AS onset_ok, offset_ok OR NOT {_STANDS} AS offset_ok, CASE WHEN {_STANDS} OR contains(coalesce(reason, ''), 'shorter than min_note_ms') THEN reason END AS reason FROM ({_MIX})""",
)
def _(t: Tables):
    rows = t.manifest_flat.withColumn("max_note_shift_ms", F.coalesce("acc_shift_ms", F.col("ord") % 90))
    return G.preserved_timing(rows).select("sample_id", "status", "onset_ok", "offset_ok", "reason")


@query(
    "final_verdict",
    """SELECT sample_id, greatest(max_onset_dev_ms, coalesce(lane_dev, 0)) AS max_onset_dev_ms, coalesce(forced, status) AS status, CASE WHEN forced IS NOT NULL THEN coalesce(rej, reason) ELSE reason END AS reason
    FROM (SELECT *, CASE WHEN ord % 5 = 0 THEN (ord % 100)::DOUBLE END AS lane_dev, CASE WHEN ord % 7 = 0 THEN 'rejected' END AS forced, CASE WHEN ord % 14 = 0 THEN 'late onset' END AS rej FROM @manifest)""",
)
def _(t: Tables):
    o = F.col("ord")
    rows = t.manifest_flat.withColumns({
        "lane_dev_ms": F.when(o % 5 == 0, (o % 100).cast("double")), "force_status": F.when(o % 7 == 0, "rejected"),
        "reject_reason": F.when(o % 14 == 0, "late onset"),
    })
    return G.final_verdict(rows).select("sample_id", "max_onset_dev_ms", "status", "reason")


# --- labels ----------------------------------------------------------------------------------

VIEWS["runs"] = """
SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY first) - 1 AS run_idx FROM (
SELECT sample_id, min(frame_idx) AS first, max(frame_idx) AS last, min(t_s) AS t_first, max(t_s) AS t_last FROM (
SELECT *, frame_idx - row_number() OVER (PARTITION BY sample_id ORDER BY frame_idx) AS g FROM (
SELECT *, max(rms) OVER (PARTITION BY sample_id) AS peak FROM @rms_frames) WHERE rms > 0.12e0 * peak) GROUP BY sample_id, g HAVING count(*) >= 2)"""
VIEWS["pairs"] = """
SELECT score_id, note_idx, CASE WHEN n_notes = n_runs THEN r2.run_idx ELSE r1.run_idx END AS run_idx FROM (
  SELECT n.score_id, n.note_idx, arg_min(run_idx, [abs((t_first + t_last + 0.04e0) / 2e0 - (n.onset_s + n.offset_s) / 2e0), run_idx]) AS run_idx
  FROM @notes n LEFT JOIN @runs r ON r.sample_id = n.score_id GROUP BY ALL) r1
JOIN (SELECT score_id, count(*) AS n_notes FROM @notes GROUP BY score_id) USING (score_id)
LEFT JOIN (SELECT sample_id AS score_id, count(*) AS n_runs FROM @runs GROUP BY sample_id) USING (score_id)
LEFT JOIN (SELECT sample_id AS score_id, run_idx AS note_idx, run_idx FROM @runs) r2 USING (score_id, note_idx)"""


@query("voiced_runs", "SELECT sample_id, run_idx, first, last, t_first, t_last FROM @runs")
def _(t: Tables):
    return G.voiced_runs(t.rms_frames).select("sample_id", "run_idx", "first", "last", "t_first", "t_last")


@query("pair_segments", "SELECT score_id, note_idx, run_idx FROM @pairs")
def _(t: Tables):
    runs = G.voiced_runs(t.rms_frames)
    return G.pair_segments(t.notes, runs, 0.04, t.parts).select("score_id", "note_idx", "run_idx")


@query(
    "derive_labels",
    """SELECT score_id, note_idx, round(CASE WHEN t_first IS NULL THEN onset_s ELSE a END, 6) AS onset_s, round(CASE WHEN t_first IS NULL THEN offset_s WHEN b <= a THEN a + greatest(0.04e0, offset_s - onset_s) ELSE b END, 6) AS offset_s,
    round(CASE WHEN t_first IS NULL THEN 0 ELSE abs(a - onset_s) * 1e3 END, 6) AS onset_dev_ms FROM (
    SELECT n.*, t_first, greatest(0e0, t_first - 0.01e0) AS a, t_last + 0.04e0 - 0.01e0 AS b FROM @notes n JOIN @pairs p USING (score_id, note_idx) LEFT JOIN @runs r ON r.sample_id = n.score_id AND r.run_idx = p.run_idx)""",
)
def _(t: Tables):
    out = G.derive_labels(t.notes, t.rms_frames, 0.02, 0.01, t.parts)
    return out.select("score_id", "note_idx", *[F.round(c, 6).alias(c) for c in ("onset_s", "offset_s", "onset_dev_ms")])


@query(
    "refine_offsets",
    """SELECT score_id, note_idx, round(CASE WHEN next_onset_s > onset_s THEN least(o, next_onset_s - 0.001e0) ELSE o END, 3) AS offset_s FROM (
    SELECT n.score_id, n.note_idx, n.onset_s, n.next_onset_s, greatest(n.onset_s + 0.03e0, coalesce(max(t_s), n.offset_s)) AS o
    FROM (SELECT x.*, pitch_midi FROM @next_onsets x JOIN @notes USING (score_id, note_idx)) n LEFT JOIN @f0_frames f ON f.sample_id = n.score_id AND voiced AND t_s BETWEEN n.onset_s AND least(n.offset_s + 0.2e0, n.next_onset_s)
      AND abs(1200e0 * log2(f0_hz / (440e0 * pow(2e0, (n.pitch_midi - 69) / 12e0)))) <= 100 GROUP BY n.score_id, n.note_idx, n.onset_s, n.offset_s, n.next_onset_s)""",
)
def _(t: Tables):
    return G.refine_offsets(t.notes, t.f0_frames).select("score_id", "note_idx", "offset_s")
