"""Queries over score variants and the criteria that compare them with their bases."""

from __future__ import annotations

from pyspark.sql import functions as F

from noteflow.functions.scalar import derive_seed
from noteflow.operators import expand as E
from noteflow.operators import manifest as M
from noteflow.operators import workplan as W
from noteflow.plans.registry import query
from noteflow.plans.views import VIEWS, seed_sql, uniform_sql
from noteflow.sources import score_io
from noteflow.sources.adapters import Tables
from noteflow.transforms import Param, at_least, library

MASTER = 42
PROFILE = E.VariantProfile(
    "prof", E.Transpose((12, -5, 24), "drop", (30, 100)), E.Humanize(0.02, 0.02, 0.03, 2, 0.05), E.Volume((-6.0, 6.0))
)
CLAMP = E.Transpose((7, -9), "clamp", (48, 84))

VIEWS["offsets"] = "SELECT * FROM (VALUES (12, 't+12'), (-5, 't-5'), (24, 't+24')) v(o, tr)"
VIEWS["transposed"] = """SELECT n.*, o, tr, pitch_midi + o AS p FROM @notes n, @offsets v
  WHERE (score_id, tr) NOT IN (SELECT score_id, tr FROM @notes, @offsets WHERE pitch_midi + o NOT BETWEEN 30 AND 100)"""
_AXIS = lambda a: seed_sql(seed_sql("'42'", "score_id", "'score_aug'", "'prof'"), f"'{a}'")
_G = lambda tag: (
    f"sqrt(-2e0 * ln(1e0 - {uniform_sql('seed', chr(39) + tag + chr(39), chr(39) + 'u' + chr(39), 'note_idx')})) * "
    f"cos(2e0 * pi() * {uniform_sql('seed', chr(39) + tag + chr(39), chr(39) + 'v' + chr(39), 'note_idx')})"
)
VIEWS["drawn"] = f"""
SELECT *, greatest(-0.03e0, least(0.03e0, {_G('onset')} * 0.02e0)) AS d_on, greatest(-0.03e0, least(0.03e0, {_G('duration')} * 0.02e0)) AS d_dur
FROM (SELECT n.*, d, {seed_sql(_AXIS('humanize'), 'd')} AS seed FROM @notes n, (VALUES (0), (1)) v(d))"""
# One correction step, written with nested sub-selects: a = pushed onset, b = pinned onset, c, e = offsets.
_STEP = """
SELECT score_id, d, note_idx, pitch_midi, seed, b AS on2, e AS off2, (onset_s + d_on < pe - 1e-9) OR (abs(a - onset_s) > 0.03e0 + 1e-9) OR (o0 < b + 0.05e0) OR (abs(c - offset_s) > 0.03e0 + 1e-9) AS h FROM (
SELECT *, CASE WHEN abs(c - offset_s) > 0.03e0 + 1e-9 THEN least(greatest(offset_s, b + 0.05e0), b + (offset_s - onset_s) + 0.03e0) ELSE c END AS e FROM (
SELECT *, CASE WHEN o0 < b + 0.05e0 THEN b + 0.05e0 ELSE o0 END AS c FROM (
SELECT *, CASE WHEN abs(a - onset_s) > 0.03e0 + 1e-9 THEN greatest(onset_s, pe) ELSE a END AS b FROM (
SELECT *, CASE WHEN onset_s + d_on < pe - 1e-9 THEN pe ELSE onset_s + d_on END AS a, onset_s + ((offset_s - onset_s) + d_dur) AS o0 FROM ({src})))))"""
VIEWS["hum_steps"] = f"""
SELECT * FROM (WITH RECURSIVE f AS ({_STEP.format(src="SELECT *, 0e0 AS pe FROM @drawn WHERE note_idx = 0")}
  UNION ALL {_STEP.format(src="SELECT n.*, f.off2 AS pe FROM f JOIN @drawn n ON n.score_id = f.score_id AND n.d = f.d AND n.note_idx = f.note_idx + 1")})
SELECT * FROM f)"""
_GAIN = f"pow(10e0, (-6e0 + {uniform_sql(_AXIS('volume'), chr(39) + 'gain' + chr(39), 'note_idx')} * 12e0) / 20e0)"


def expansion(t: Tables) -> E.Expansion:
    return E.expand_variants(t.notes, [PROFILE], MASTER)


@query("transpose", "SELECT score_id, note_idx, onset_s, offset_s, CAST(p AS INTEGER) AS pitch_midi, tr AS transform FROM @transposed")
def _(t: Tables):
    return E.transpose(t.notes, PROFILE.transpose).drop("lyric")


@query(
    "named_transforms",
    """SELECT score_id, note_idx, CAST(least(greatest(pitch_midi + o, 48), 84) AS INTEGER) AS pitch_midi, tr AS transform, printf('%.3f', offset_s - onset_s) AS held
    FROM @notes, (VALUES (7, 't+7'), (-9, 't-9')) v(o, tr)""",
)
def _(t: Tables):
    """A built-in transform by name, then one that a user has added."""
    lib = library()
    lib.register("held", lambda df, p: df.withColumn("held", F.format_string(f"%.{p['digits']}f", F.col("offset_s") - F.col("onset_s"))), "held string", adds=True, params={"digits": Param(at_least(0), 3)})
    out = lib.chain(t.notes, [("transpose", {"offsets": [7, -9], "policy": "clamp", "window": (48, 84)}), ("held", {})])
    return out.select("score_id", "note_idx", "pitch_midi", "transform", "held")


@query(
    "transpose_clamp",
    """SELECT score_id, o AS "offset", count(*) FILTER (pitch_midi + o NOT BETWEEN 48 AND 84) AS clamped, min(least(greatest(pitch_midi + o, 48), 84)) AS lo, max(least(greatest(pitch_midi + o, 48), 84)) AS hi
    FROM @notes, (VALUES (7), (-9)) v(o) GROUP BY ALL""",
)
def _(t: Tables):
    plan = E.transpose_plan(t.notes, CLAMP).select("score_id", "offset", "clamped")
    moved = E.transpose(t.notes, CLAMP).withColumn("offset", F.expr("int(substring(transform, 2))"))
    spans = moved.groupBy("score_id", "offset").agg(F.min("pitch_midi").alias("lo"), F.max("pitch_midi").alias("hi"))
    return plan.join(spans, ["score_id", "offset"])


@query("humanize", "SELECT score_id, CAST(d AS INTEGER) AS draw, note_idx, round(on2, 6) AS onset_s, round(off2, 6) AS offset_s, h AS constraint_hit FROM @hum_steps")
def _(t: Tables):
    seed = derive_seed(derive_seed(MASTER, "score_id", F.lit("score_aug"), F.lit("prof")), F.lit("humanize"))
    out = E.humanize(t.notes, PROFILE.humanize, seed)
    return out.select("score_id", "draw", "note_idx", F.round("onset_s", 6).alias("onset_s"), F.round("offset_s", 6).alias("offset_s"), "constraint_hit")


@query("volume", f"SELECT score_id, note_idx, round({_GAIN}, 6) AS gain FROM @notes")
def _(t: Tables):
    seed = derive_seed(derive_seed(MASTER, "score_id", F.lit("score_aug"), F.lit("prof")), F.lit("volume"))
    return E.volume(t.notes, PROFILE.volume, seed).select("score_id", "note_idx", F.round("gain", 6).alias("gain"))


@query(
    "jitter_timing",
    f"""SELECT score_id, note_idx, round(a, 6) AS onset_s, round(a + (offset_s - onset_s), 6) AS offset_s FROM (SELECT *, greatest(0e0, onset_s + CASE WHEN {uniform_sql('sd', "'sign'", 'note_idx')} < 0.5 THEN 1e0 ELSE -1e0 END * (0.5e0 + {uniform_sql('sd', "'frac'", 'note_idx')} * 0.5e0) * 30e0 / 1e3) AS a
    FROM (SELECT *, {seed_sql("'1'", 'score_id')} AS sd FROM @notes))""",
)
def _(t: Tables):
    out = E.jitter_timing(t.notes, 30.0, derive_seed(1, "score_id"))
    return out.select("score_id", "note_idx", F.round("onset_s", 6).alias("onset_s"), F.round("offset_s", 6).alias("offset_s"))


VIEWS["expanded"] = f"""
SELECT score_id || '__' || tr AS score_id, note_idx, onset_s, offset_s, CAST(p AS INTEGER) AS pitch_midi, 'transpose' AS axis, {_AXIS('transpose')} AS seed FROM @transposed
UNION ALL SELECT score_id || '__hum' || d, note_idx, on2, off2, pitch_midi, 'humanize', seed FROM @hum_steps
UNION ALL SELECT score_id || '__vol', note_idx, onset_s, offset_s, pitch_midi, 'volume', {_AXIS('volume')} FROM @notes"""


@query("expand_variants", "SELECT score_id, note_idx, round(onset_s, 6) AS onset_s, round(offset_s, 6) AS offset_s, pitch_midi, axis, seed FROM @expanded")
def _(t: Tables):
    n = expansion(t).notes
    return n.select("score_id", "note_idx", F.round("onset_s", 6).alias("onset_s"), F.round("offset_s", 6).alias("offset_s"), "pitch_midi", "axis", "seed")


@query(
    "dropped_variants",
    f"""SELECT DISTINCT score_id AS base_score_id, tr AS transform, {_AXIS('transpose')} AS seed, 'offset ' || printf('%+d', o) || ' pushes a note outside the window (30, 100) (policy=drop)' AS reason
    FROM @notes, @offsets WHERE pitch_midi + o NOT BETWEEN 30 AND 100""",
)
def _(t: Tables):
    return expansion(t).drops.select("base_score_id", "transform", "seed", "reason")


@query(
    "union_originals_variants",
    "SELECT score_id, CAST(NULL AS VARCHAR) AS base_score_id, false AS variant FROM @scores UNION ALL SELECT DISTINCT score_id, split_part(score_id, '__', 1), true FROM @expanded",
)
def _(t: Tables):
    return W.union_originals_variants(t.scores, expansion(t).variants)


@query("budget_join", "SELECT sample_id, CASE WHEN score_aug_profile = 'prof' THEN 0.03e0 END AS max_dev_s FROM @vpairs")
def _(t: Tables):
    budgets = t.spark.createDataFrame([("prof", 0.03), ("other", 0.05)], "score_aug_profile string, max_dev_s double")
    pairs = M.variant_base_pairs(t.manifest)
    return pairs.join(F.broadcast(budgets), "score_aug_profile", "left").select("sample_id", "max_dev_s")


@query(
    "projected_count",
    """SELECT (SELECT count(*) FROM @scores) * 7 * (SELECT count(*) FROM @voices WHERE kind IN ('deterministic_donor', 'svs_voicebank')) * 4 AS projected, (SELECT count(*) FROM @scores) * 6 AS variants""",
)
def _(t: Tables):
    lanes = t.spark.createDataFrame([("deterministic_donor",), ("svs_voicebank",)], "kind string")
    return E.projected_count(t.scores, [PROFILE], lanes, t.voices, 3)


# Labels of every manifest record: base notes, and the variants a run would have stored for them.
VIEWS["stored"] = """
SELECT score_id, note_idx, onset_s, offset_s, pitch_midi FROM @notes
UNION ALL SELECT score_id || '__t+12', note_idx, onset_s, offset_s, pitch_midi + CASE WHEN pk % 50 = 0 THEN 11 ELSE 12 END FROM @notes
UNION ALL SELECT score_id || '__t-5', note_idx, onset_s, offset_s, pitch_midi - 5 FROM @notes WHERE pk % 60 <> 0
UNION ALL SELECT score_id || '__hum0', note_idx, onset_s + CASE WHEN pk % 70 = 0 THEN 0.04e0 ELSE 0.01e0 END, offset_s + 0.01e0, pitch_midi FROM @notes
UNION ALL SELECT score_id || '__vol', note_idx, onset_s, offset_s, pitch_midi FROM @notes"""


def stored_notes(t: Tables):
    rows = t.note_rows()
    pk = F.col("pk")
    base = rows.select("score_id", "note_idx", (F.col("onset_ms") / 1000.0).alias("onset_s"), (F.col("offset_ms") / 1000.0).alias("offset_s"), "pitch_midi", "pk")
    kinds = F.explode(F.array(*[F.lit(k) for k in ("", "__t+12", "__t-5", "__hum0", "__vol")]))
    k = F.col("k")
    made = base.withColumn("k", kinds).filter(~((k == "__t-5") & (pk % 60 == 0)))
    step = F.when(k == "__t+12", F.when(pk % 50 == 0, 11).otherwise(12)).when(k == "__t-5", -5).otherwise(0)
    late = F.when(k == "__hum0", F.when(pk % 70 == 0, 0.04).otherwise(0.01)).otherwise(0.0)
    tail = F.when(k == "__hum0", 0.01).otherwise(0.0)
    return made.select(
        F.col("score_id").alias("base_score_id"), F.concat("score_id", "k").alias("score_id"), "note_idx", (F.col("onset_s") + late).alias("onset_s"),
        (F.col("offset_s") + tail).alias("offset_s"), (F.col("pitch_midi") + step).cast("int").alias("pitch_midi"),
    )


VIEWS["vchecks"] = """
SELECT sample_id, n_notes, n_base, n_notes = n_base AS same_count, pitch_exact, timing_same, valid, in_budget FROM (
SELECT sample_id, any_value(base_score_id) AS base_score_id, count(*) AS n_notes, bool_and(coalesce(pitch = bp + coalesce(CASE WHEN starts_with(tr, 't') THEN CAST(tr[2:] AS INTEGER) END, 0) AND pitch BETWEEN 0 AND 127, false)) AS pitch_exact,
  bool_and(coalesce(a = ba AND b = bb, false)) AS timing_same, bool_and(b > a AND (nx IS NULL OR b <= nx + 1e-9)) AS valid, bool_and(coalesce(abs(a - ba) <= 0.03e0 + 1e-9 AND abs(b - bb) <= 0.03e0 + 1e-9, true)) AS in_budget
FROM (SELECT v.sample_id, v.base_score_id, v.score_aug_transform AS tr, s.pitch_midi AS pitch, s.onset_s AS a, s.offset_s AS b, s.nx, n.pitch_midi AS bp, n.onset_s AS ba, n.offset_s AS bb
  FROM @vpairs v JOIN (SELECT *, lead(onset_s) OVER (PARTITION BY score_id ORDER BY onset_s, note_idx) AS nx FROM @stored) s USING (score_id) LEFT JOIN @notes n ON n.score_id = v.base_score_id AND n.note_idx = s.note_idx) GROUP BY sample_id)
LEFT JOIN (SELECT score_id AS base_score_id, count(*) AS n_base FROM @notes GROUP BY score_id) USING (base_score_id)"""


@query("variant_note_checks", "SELECT sample_id, n_notes, coalesce(same_count, false) AS same_count, pitch_exact, timing_same, valid, in_budget FROM @vchecks")
def _(t: Tables):
    pairs = M.variant_base_pairs(t.manifest)
    return M.variant_note_checks(pairs, stored_notes(t), {"prof": 0.03}).select("sample_id", "n_notes", "same_count", "pitch_exact", "timing_same", "valid", "in_budget")


@query(
    "criteria_score_aug",
    """WITH w AS (SELECT count(*) FILTER (orig) AS orig, count(*) FILTER (orig AND score_aug_axis IS NULL AND score_aug_profile IS NULL AND NOT aug) AS clean, count(*) FILTER (v) AS nv,
      count(*) FILTER (v AND score_aug_profile <> '' AND coalesce(score_aug_transform, '') <> '' AND score_aug_seed IS NOT NULL AND (score_path = '' OR aug)) AS traced, count(*) FILTER (score_path <> '' AND ((v AND NOT aug) OR (orig AND aug))) AS mis,
      count(*) FILTER (status = 'accepted' AND v) AS av, count(*) FILTER (status = 'accepted' AND NOT v) AS ao, count(*) FILTER (status = 'accepted' AND score_aug_axis = 'transpose') AS ntr, count(*) FILTER (score_aug_axis = 'humanize') AS nhu
      FROM (SELECT *, base_score_id IS NOT NULL AS v, base_score_id IS NULL AND lane <> 'score_augmentation' AS orig, contains(score_path, 'augmented/') AS aug FROM @manifest)),
    g AS (SELECT count(*) FILTER (status = 'accepted' AND score_aug_axis = 'transpose' AND base_sample_id IS NOT NULL AND same_count AND pitch_exact AND timing_same) AS tr,
      count(*) FILTER (score_aug_axis = 'humanize' AND n_notes > 0 AND valid AND (NOT (base_sample_id IS NOT NULL AND coalesce(same_count, false)) OR in_budget)) AS hu FROM @vpairs LEFT JOIN @vchecks USING (sample_id)),
    c AS (SELECT count(*) AS col FROM (SELECT path FROM (SELECT score_path AS path FROM @manifest UNION ALL SELECT audio_path FROM @manifest) WHERE path <> '' GROUP BY path HAVING count(*) > 1)),
    k AS (SELECT count(DISTINCT score_aug_transform) AS tf, count(*) / count(*) FILTER (base_score_id IS NULL) AS mult FROM @manifest WHERE status = 'accepted'),
    z AS (SELECT * FROM w, g, c, k)
    SELECT 'SC-001' AS sc, round(clean / orig, 6)::DOUBLE AS value, 1e0 AS threshold, clean = orig AS passed, true AS gated FROM z UNION ALL SELECT 'SC-002', round(tr / ntr, 6), 1, tr = ntr, ntr > 0 FROM z UNION ALL SELECT 'SC-003', round(hu / nhu, 6), 1, hu = nhu, nhu > 0 FROM z
    UNION ALL SELECT 'SC-006', round(traced / nv, 6), 1, traced = nv, nv > 0 FROM z UNION ALL SELECT 'SC-007', CASE WHEN av = 0 OR (tf > 0 AND abs(mult - (av + ao) / ao) < 1e-9) THEN 1 ELSE 0 END, 1, av = 0 OR (tf > 0 AND abs(mult - (av + ao) / ao) < 1e-9), av > 0 FROM z UNION ALL SELECT 'SC-009', CASE WHEN col = 0 AND mis = 0 THEN 1 ELSE 0 END, 1, col = 0 AND mis = 0, true FROM z""",
)
def _(t: Tables):
    return M.criteria_score_aug(t.manifest, stored_notes(t), {"prof": 0.03}).withColumn("value", F.round("value", 6))


VIEWS["levels"] = """SELECT sample_id, note_idx, CASE WHEN base_score_id IS NULL THEN 0.1e0 + (onset_ms % 7) / 100e0 ELSE 0.1e0 + (onset_ms % (7 + ord % 9)) / 90e0 END AS rms
FROM @manifest m JOIN @notes n ON n.score_id = coalesce(m.base_score_id, m.score_id)"""


@query(
    "criteria_volume",
    """WITH s AS (SELECT sample_id, stddev_pop(rms) AS sd, count(*) AS n FROM @levels GROUP BY sample_id)
    SELECT *, round(CASE WHEN n_vol = 0 THEN 1 ELSE widened / n_vol END, 6) AS value, widened = n_vol AND labels_ok = n_vol AS passed FROM (
    SELECT count(*) AS n_vol, count(*) FILTER (a.n > 1 AND b.n > 1 AND a.sd > b.sd + 1e-9) AS widened, count(*) FILTER (base_sample_id IS NOT NULL AND timing_same AND pitch_exact AND same_count) AS labels_ok
    FROM @vpairs_accepted v LEFT JOIN s a ON a.sample_id = v.sample_id LEFT JOIN s b ON b.sample_id = v.base_sample_id LEFT JOIN @vchecks c ON c.sample_id = v.sample_id WHERE status = 'accepted' AND score_aug_axis = 'volume')""",
)
def _(t: Tables):
    m = t.manifest
    rows = t.note_rows().select("score_id", "note_idx", "onset_ms")
    ref = m.select("sample_id", "ord", F.col("base_score_id").isNull().alias("base"), F.coalesce("base_score_id", "score_id").alias("score_id"))
    ms = F.col("onset_ms")
    level = F.when(F.col("base"), F.lit(0.1) + ms % 7 / 100.0).otherwise(F.lit(0.1) + ms % (F.lit(7) + F.col("ord") % 9) / 90.0)
    levels = ref.join(rows, "score_id").select("sample_id", "note_idx", level.alias("rms"))
    pairs = M.variant_base_pairs(m, accepted_bases=True)
    checks = M.variant_note_checks(pairs, stored_notes(t), {"prof": 0.03})
    return M.criteria_volume(pairs, levels, checks).withColumn("value", F.round("value", 6))


_LINE = "printf('%.6f' || chr(9) || '%.6f' || chr(9) || '%d', onset_s, offset_s, pitch_midi)"


@query(
    "criteria_reexpand",
    f"""SELECT count(*) AS checked, count(*) FILTER (same) AS reproduced, round(count(*) FILTER (same) / count(*), 6) AS value, count(*) FILTER (same) = count(*) AS passed FROM (
    SELECT score_id, bool_and(coalesce(e.line = s.line, false)) AS same FROM (SELECT score_id, note_idx, {_LINE} AS line FROM @expanded) e
    FULL JOIN (SELECT score_id, note_idx, {_LINE} AS line FROM @stored WHERE contains(score_id, '__')) s USING (score_id, note_idx) GROUP BY score_id HAVING count(e.line) > 0 AND count(s.line) > 0)""",
)
def _(t: Tables):
    base = "base_score_id"
    made = score_io.score_lines(expansion(t).notes.drop("lyric"), base)
    stored = stored_notes(t).filter(F.col("score_id").contains("__"))
    return M.criteria_reexpand(made, score_io.score_lines(stored, base), base).withColumn("value", F.round("value", 6))
