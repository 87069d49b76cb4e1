"""The derived tables once more, as SQL for the oracle engine."""

from __future__ import annotations

from noteflow.sources.adapters import GAPS, LONG_GAPS, MANIFEST_SQL, SYLLABLES


def _case(expr: str, values: tuple) -> str:
    lit = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return f"CASE {expr} " + " ".join(f"WHEN {i} THEN {lit(v)}" for i, v in enumerate(values)) + " END"


def _rows(key: str, other: str, gaps: tuple) -> str:
    return f"""
SELECT score_id, CAST(rn - 1 AS INTEGER) AS note_idx, onset_ms, onset_ms + dur_ms AS offset_ms,
  onset_ms + dur_ms + gap_ms AS next_ms, pitch_midi, lyric, pk
FROM (SELECT *, row_number() OVER w AS rn,
    CAST(200 + coalesce(sum(dur_ms + gap_ms) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS onset_ms
  FROM (SELECT 's' || {key} AS score_id, l_linenumber, l_shipdate, l_partkey AS pk, l_quantity, l_extendedprice,
      l_discount, l_tax, l_returnflag, l_linestatus, {other} AS other,
      CAST(40 + 12 * l_quantity AS BIGINT) AS dur_ms, CAST({_case("l_partkey % 5", gaps)} AS BIGINT) AS gap_ms,
      CAST(36 + l_partkey % 61 AS INTEGER) AS pitch_midi,
      CASE WHEN l_partkey % 7 <> 0 THEN {_case("l_partkey % 6", SYLLABLES)} END AS lyric
    FROM lineitem)
  WINDOW w AS (PARTITION BY score_id ORDER BY l_linenumber, l_shipdate, pk, l_quantity, l_extendedprice,
    l_discount, l_tax, l_returnflag, l_linestatus, other))"""


_NOTES = """SELECT score_id, note_idx, onset_ms / 1e3 AS onset_s, offset_ms / 1e3 AS offset_s, pitch_midi, lyric, pk,
  onset_ms, offset_ms FROM @{src}"""


def seed_sql(*parts: str) -> str:
    """SQL of the 63-bit seed of unit-separated text parts."""
    text = " || chr(31) || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST(CAST('0x' || substr(sha256({text}), 1, 16) AS UBIGINT) % 9223372036854775808 AS BIGINT)"


def uniform_sql(*parts: str) -> str:
    return f"(CAST({seed_sql(*parts)} AS DOUBLE) / 9223372036854775808e0)"


VIEWS: dict[str, str] = {
    "note_rows": _rows("l_orderkey", "l_suppkey", GAPS),
    "long_rows": _rows("l_suppkey", "l_orderkey", LONG_GAPS),
    "notes": _NOTES.format(src="note_rows"),
    "long_notes": _NOTES.format(src="long_rows"),
    "events_poly": """
SELECT 'm' || l_orderkey AS song_id, CAST(l_suppkey % 4 AS INTEGER) AS track,
  CASE WHEN l_suppkey % 4 = 1 AND l_orderkey % 3 = 0 THEN 'Lead Vocal' ELSE 'inst' || (l_suppkey % 4) END AS track_name,
  l_suppkey % 4 = 3 AS is_drum,
  (100 + (l_linenumber - 1) * 300 + l_partkey % 7 * 40) / 1e3 AS start_s,
  CAST(100 + (l_linenumber - 1) * 300 + l_partkey % 7 * 40 + 40 + 12 * l_quantity AS BIGINT) / 1e3 AS end_s,
  CAST(36 + l_partkey % 61 AS INTEGER) AS pitch FROM lineitem""",
    "frame_rows": """
SELECT *, frame_idx * 20 AS t_ms, frame_idx * 20 >= a_ms AND frame_idx * 20 < e_ms AS sounding FROM (
SELECT score_id AS sample_id, pk, pitch_midi, unnest(range(k0, k1 + 1)) AS frame_idx, a_ms, e_ms, cents FROM (
SELECT score_id, pk, pitch_midi, CASE WHEN note_idx = 0 THEN 0 ELSE (onset_ms + 19) // 20 END AS k0,
  (next_ms + 19) // 20 - 1 AS k1,
  onset_ms + CASE WHEN pk % 40 = 0 THEN 80 WHEN pk % 40 = 1 THEN 40 ELSE pk % 3 * 5 END AS a_ms,
  offset_ms + CASE WHEN pk % 37 = 0 THEN -260 WHEN pk % 37 = 1 THEN -30 ELSE pk % 2 * -10 END AS e_ms,
  CASE WHEN pk % 41 = 0 THEN 40 WHEN pk % 41 = 1 THEN -30 ELSE pk % 5 * 6 - 12 END AS cents
FROM @note_rows) WHERE k1 >= k0)""",
    "f0_frames": """
SELECT sample_id, frame_idx, t_ms / 1e3 AS t_s, CASE WHEN voiced THEN
  440e0 * pow(2e0, (pitch_midi + cents / 100e0 - 69e0) / 12e0) END AS f0_hz, voiced
FROM (SELECT *, sounding AND NOT (pk % 43 = 0 AND frame_idx % 2 = 0) AS voiced FROM @frame_rows)""",
    "rms_frames": """
SELECT sample_id, frame_idx, t_ms / 1e3 AS t_s,
  CASE WHEN sounding THEN 0.05e0 + pk % 20 / 100e0 ELSE 0.001e0 + frame_idx % 3 / 2000e0 END AS rms FROM @frame_rows""",
    "sample_meta": """
SELECT 's' || o_orderkey AS sample_id,
  CASE WHEN o_orderkey % 23 = 0 THEN -3e0 WHEN o_orderkey % 2 = 0 THEN 20e0 END AS snr_db,
  CASE WHEN o_orderkey % 29 = 0 THEN 1.2e0 ELSE 0.9e0 END AS peak FROM orders""",
    "posteriors": """
SELECT song_id, frame, pitch, max(onset_p) AS onset_p, max(frame_p) AS frame_p FROM (
SELECT song_id, frame, CAST(pitch_midi + up AS INTEGER) AS pitch,
  greatest(0e0, 0.5e0 + pk % 5 / 10e0 - abs(frame - f_on) * 0.375e0) * w AS onset_p,
  CASE WHEN frame >= f_on AND frame < f_off THEN CASE WHEN frame % 9 = 0 AND pk % 3 = 0 THEN 0.2e0 ELSE 0.5e0 + pk % 7 / 20e0 END ELSE 0.01e0 END * w AS frame_p
FROM (SELECT *, unnest(range(f_on - 2, f_off + 3)) AS frame FROM (
  SELECT score_id AS song_id, pk, pitch_midi, CAST(round_even(onset_ms / 16e0, 0) AS BIGINT) AS f_on,
    CAST(round_even(offset_ms / 16e0, 0) AS BIGINT) AS f_off FROM @note_rows))
JOIN (VALUES (0, 1e0), (1, 0.75e0)) u(up, w) ON up = 0 OR pk % 6 = 0)
GROUP BY ALL""",
    "est_notes": """
SELECT score_id AS song_id, note_idx AS est_idx, (onset_ms + shift) / 1e3 AS onset_s,
  greatest(offset_ms + shift + cut, onset_ms + shift + 20) / 1e3 AS offset_s, CAST(pitch_midi + bend AS INTEGER) AS pitch
FROM (SELECT *, CASE WHEN pk % 13 = 0 THEN 60 WHEN pk % 13 = 1 THEN -20 ELSE pk % 3 * 10 END AS shift,
  CASE WHEN pk % 17 = 0 THEN -200 ELSE pk % 2 * 30 END AS cut,
  CASE WHEN pk % 19 = 0 THEN 12 WHEN pk % 19 = 1 THEN 1 ELSE 0 END AS bend FROM @note_rows WHERE pk % 11 <> 0)""",
    "ref_notes": """
SELECT score_id AS song_id, note_idx AS ref_idx, onset_s, offset_s, pitch_midi AS pitch FROM @notes""",
    "scores": "SELECT 's' || o_orderkey AS score_id, 'set' || (o_custkey % 7) AS dir FROM orders",
    "voices": """
SELECT 'v' || s_suppkey AS voice_id,
  CASE s_suppkey % 3 WHEN 0 THEN 'deterministic_donor' WHEN 1 THEN 'svs_voicebank' ELSE 'voice_conversion' END AS kind,
  CASE s_nationkey % 4 WHEN 0 THEN 'CC0' WHEN 1 THEN 'CC-BY 4.0' WHEN 2 THEN 'CC-BY-NC 4.0' ELSE '' END AS license,
  s_acctbal >= 0 AS consent_verified, s_name AS model_ref FROM supplier""",
    "manifest": MANIFEST_SQL.format(orders="orders", customer="customer"),
    "clips": "SELECT 'c' || vec_id AS clip_id, embedding AS samples, vec_id FROM embeddings",
    "parallel_notes": """
SELECT k AS row_key, CASE WHEN k % 43 = 0 THEN '' ELSE 'seg/' || k END AS segment_id,
  list_transform(range(n), lambda i: CAST(CASE WHEN (k + i) % 4 = 3 THEN 0 ELSE 60 + (k + i // 2) % 5 END
    + CASE WHEN k % 31 = 0 THEN 100 ELSE 0 END AS DOUBLE)) AS note_midi,
  list_transform(range(n), lambda i: CASE WHEN (k + i) % 3 = 0 THEN '—' ELSE 'n_i' END) AS note_lyrics,
  list_transform(range(n), lambda i: i * 300 / 1e3) AS note_start_times,
  list_transform(range(CASE WHEN k % 41 = 0 THEN n - 1 ELSE n END), lambda i: (i * 300 + CASE WHEN k % 37 = 0 THEN 320 ELSE 300 END) / 1e3) AS note_end_times
FROM (SELECT o_orderkey AS k, 3 + o_orderkey % 5 AS n FROM orders)""",
}
