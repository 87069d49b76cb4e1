"""Queries over the manifest: statistics, criteria, audit, splits, set checks, work lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from noteflow.functions.scalar import source_key
from noteflow.operators import manifest as M
from noteflow.operators import workplan as W
from noteflow.plans.functions import NC_SQL
from noteflow.plans.registry import query
from noteflow.plans.views import VIEWS, seed_sql
from noteflow.sources import manifest_io as IO
from noteflow.sources import score_io
from noteflow.sources.adapters import Tables
from noteflow.streaming import manifest_stream as ST

VIEWS["acc"] = "SELECT * FROM @manifest WHERE status = 'accepted'"

# --- reading, filters ------------------------------------------------------------------------


@query("read_manifest", "SELECT sample_id, score_id, lane, status, snr_db, acc_mode AS mode, consent_verified FROM @manifest WHERE ord % 37 <> 0")
def _(t: Tables):
    """Manifest rows written as JSON text, some lines spoiled, read back with the fixed schema."""
    m = t.manifest
    o = F.col("ord")
    line = F.when(o % 74 == 0, F.lit("{not json")).when(o % 37 == 0, F.lit(" ")).otherwise(F.to_json(F.struct(*[c for c in m.columns if c != "ord"])))
    good, _ = IO.split_corrupt(IO.parse_manifest(m.select(line.alias("value"))))
    return good.select("sample_id", "score_id", "lane", "verdict.status", "verdict.snr_db", "accompaniment.mode", "consent_verified")


@query("manifest_rejects", "SELECT '{not json' AS line, 'not a manifest record' AS reason FROM @manifest WHERE ord % 74 = 0")
def _(t: Tables):
    m = t.manifest
    line = F.when(F.col("ord") % 74 == 0, F.lit("{not json")).otherwise(F.to_json(F.struct(*[c for c in m.columns if c != "ord"])))
    return IO.split_corrupt(IO.parse_manifest(m.select(line.alias("value"))))[1]


@query("accepted", "SELECT sample_id FROM @acc")
def _(t: Tables):
    return M.accepted(t.manifest).select("sample_id")


@query("synthesized", "SELECT sample_id FROM @manifest WHERE status <> 'license_refused'")
def _(t: Tables):
    return M.synthesized(t.manifest).select("sample_id")


@query("originals_variants", "SELECT sample_id, base_score_id IS NULL AND lane <> 'score_augmentation' AS original, base_score_id IS NOT NULL AS variant FROM @manifest")
def _(t: Tables):
    return t.manifest.select("sample_id", M.is_original().alias("original"), M.is_variant().alias("variant"))


@query(
    "license_policy",
    """SELECT s_suppkey, CASE WHEN s_nationkey % 4 NOT IN (0, 1) THEN 'license not in policy' WHEN s_suppkey % 3 = 0 THEN 'mode not supported' END AS skip_reason FROM supplier""",
)
def _(t: Tables):
    lic = F.element_at(F.array(*[F.lit(x) for x in ("MIT", "CC-BY 4.0", "CC-BY-NC 4.0", "other")]), (F.col("s_nationkey") % 4 + 1).cast("int"))
    modes = F.when(F.col("s_suppkey") % 3 == 0, F.array(F.lit("complete"))).otherwise(F.array(F.lit("lego"), F.lit("complete")))
    b = t.raw("supplier").select("s_suppkey", lic.alias("model_license"), modes.alias("modes"))
    return W.license_policy(b, ["MIT", "CC-BY 4.0"], "lego").select("s_suppkey", "skip_reason")


# --- statistics ------------------------------------------------------------------------------


@query(
    "run_summary",
    "SELECT count(*) AS attempted, count(*) FILTER (status = 'accepted') AS accepted, " + ", ".join(f"count(*) FILTER (status = '{s}') AS n_{s}" for s in M.STATUSES) + " FROM @manifest",
)
def _(t: Tables):
    return M.run_summary(t.manifest)


@query(
    "corpus_stats",
    """SELECT (SELECT count(*) FROM @manifest) AS total_samples, count(*) AS accepted, count(DISTINCT score_id) AS unique_scores, count(DISTINCT voice_id) AS unique_voices,
    count(DISTINCT (voice_id, coalesce(augmentation_profile, ''))) AS timbre_identities, round(count(*) FILTER (coalesce(augmentation_profile, '') <> '') / count(*), 6) AS augmentation_coverage FROM @acc""",
)
def _(t: Tables):
    return M.corpus_stats(t.manifest).withColumn("augmentation_coverage", F.round("augmentation_coverage", 6))


@query(
    "score_aug_coverage",
    """SELECT v > 0 AS enabled, round(v / n, 6) AS variant_share, round(n / (n - v), 6) AS effective_multiplier, by_transform FROM (
    SELECT count(*) AS n, count(base_score_id) AS v, (SELECT string_agg(k || ':' || c, ',' ORDER BY k) FROM (SELECT coalesce(score_aug_transform, '?') AS k, count(*) AS c FROM @acc WHERE base_score_id IS NOT NULL GROUP BY k)) AS by_transform FROM @acc)""",
)
def _(t: Tables):
    out = M.score_aug_coverage(t.manifest)
    listed = F.transform(F.map_entries("by_transform"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))
    return out.select("enabled", *[F.round(c, 6).alias(c) for c in ("variant_share", "effective_multiplier")], F.array_join(listed, ",").alias("by_transform"))


@query(
    "lyric_stats",
    """SELECT 'source' AS facet, lyric_source AS value, count(*) AS records, sum(lyric_multisyllable_supplied)::BIGINT AS multisyllable FROM @manifest GROUP BY 2
    UNION ALL SELECT 'language', lyric_language, count(*), sum(lyric_multisyllable_supplied)::BIGINT FROM @manifest GROUP BY 2""",
)
def _(t: Tables):
    return M.lyric_stats(t.manifest)


@query("labels_of", "SELECT sample_id, n.score_id, note_idx FROM @acc m JOIN @notes n ON m.score_id = n.score_id WHERE score_path <> ''")
def _(t: Tables):
    return M.labels_of(t.manifest, t.notes).select("sample_id", "score_id", "note_idx")


# --- criteria --------------------------------------------------------------------------------

_FR = "CASE WHEN {d} = 0 THEN 1 ELSE {n} / {d} END"
VIEWS["core"] = f"""
WITH w AS (SELECT count(*) FILTER (ok) AS acc, count(*) FILTER (ok AND onset_ok) AS o1, count(*) FILTER (ok AND offset_ok) AS o2, count(*) FILTER (status <> 'license_refused') AS syn, count(*) FILTER (ok AND NOT consent_verified) AS unc,
  count(DISTINCT (voice_id, coalesce(augmentation_profile, ''))) FILTER (ok) AS ids, count(*) FILTER (ok AND coalesce(augmentation_profile, '') <> '') AS aug, count(*) FILTER (lane = 'augmentation') AS al,
  count(*) FILTER (ok AND lane = 'svs') AS svs, count(*) FILTER (ok AND lane = 'svs' AND max_onset_dev_ms < 50) AS svi FROM (SELECT *, status = 'accepted' AS ok FROM @manifest)),
v AS (SELECT *, {_FR.format(n='o1', d='acc')} AS f1, {_FR.format(n='o2', d='acc')} AS f2, {_FR.format(n='acc', d='syn')} AS f7, {_FR.format(n='aug', d='acc')} AS f6, {_FR.format(n='svi', d='svs')} AS f10 FROM w)
SELECT 'SC-001' AS sc, f1::DOUBLE AS value, 0.99e0 AS threshold, f1 >= 0.99 AS passed, true AS gated FROM v UNION ALL SELECT 'SC-002', f2, 0.99, f2 >= 0.99, true FROM v
UNION ALL SELECT 'SC-007', f7, 0.95, f7 >= 0.95, true FROM v UNION ALL SELECT 'SC-008', unc, 0, unc = 0, true FROM v UNION ALL SELECT 'SC-004', ids, 1000, ids >= 1000, acc >= 1000 FROM v
UNION ALL SELECT 'SC-006', f6, 0.6, f6 >= 0.6, al > 0 FROM v UNION ALL SELECT 'SC-010', f10, 0.9, f10 >= 0.9, svs > 0 FROM v"""
VIEWS["accomp"] = f"""
WITH w AS (SELECT count(*) FILTER (a) AS acc, count(*) FILTER (a AND acc_mode = 'lego') AS lego, count(*) FILTER (a AND acc_mode = 'complete') AS comp, count(*) FILTER (a AND acc_mode = 'lego' AND NOT acc_bit_exact) AS t, count(*) FILTER (a AND acc_mode = 'lego' AND NOT acc_stem) AS ns,
  count(*) FILTER (a AND acc_mode = 'complete' AND onset_ok AND offset_ok) AS tm, count(*) FILTER (a AND acc_shift_ms > 50) AS mv,
  count(*) FILTER (a AND (acc_model_id = '' OR acc_license = '' OR {NC_SQL.format('acc_license')} OR (starts_with(upper(acc_license), 'CC-BY') AND coalesce(acc_attribution, '') = ''))) AS bad
  FROM (SELECT *, status = 'accepted' AND lane = 'accompaniment' AND acc_mode IS NOT NULL AS a FROM @manifest)), v AS (SELECT *, {_FR.format(n='tm', d='comp')} AS f FROM w)
SELECT 'ACC-001' AS sc, t::DOUBLE AS value, 0e0 AS threshold, t = 0 AS passed, lego > 0 AS gated FROM v UNION ALL SELECT 'ACC-002', f, 0.99, f >= 0.99, comp > 0 FROM v UNION ALL SELECT 'ACC-004', bad, 0, bad = 0, acc > 0 FROM v
UNION ALL SELECT 'ACC-005', mv, 0, mv = 0, acc > 0 FROM v UNION ALL SELECT 'ACC-008', ns, 0, ns = 0, lego > 0 FROM v"""


def _rounded(df):
    return df.withColumn("value", F.round("value", 6))


@query("criteria_core", "SELECT * EXCLUDE (value), round(value, 6) AS value FROM @core")
def _(t: Tables):
    return _rounded(M.criteria_core(t.manifest))


@query("criteria_accompaniment", "SELECT * EXCLUDE (value), round(value, 6) AS value FROM @accomp")
def _(t: Tables):
    return _rounded(M.criteria_accompaniment(t.manifest))


@query("eval_report", "SELECT bool_and(passed OR NOT gated) AS passed, count(*) AS criteria, count(*) FILTER (NOT passed AND gated) AS failed FROM (SELECT * FROM @core UNION ALL SELECT * FROM @accomp)")
def _(t: Tables):
    m = t.manifest
    return M.eval_report(M.criteria_core(m).unionByName(M.criteria_accompaniment(m)))


VIEWS["bases"] = "SELECT score_id AS base_score_id, lane, voice_id, arg_max(sample_id, ord) AS base_sample_id FROM @manifest WHERE base_score_id IS NULL AND lane <> 'score_augmentation' GROUP BY ALL"
VIEWS["vpairs"] = "SELECT v.*, base_sample_id FROM @manifest v LEFT JOIN @bases b USING (base_score_id, lane, voice_id) WHERE base_score_id IS NOT NULL"
VIEWS["bases_accepted"] = VIEWS["bases"].replace("WHERE", "WHERE status = 'accepted' AND")
VIEWS["vpairs_accepted"] = VIEWS["vpairs"].replace("@bases", "@bases_accepted")


@query("variant_base_pairs", "SELECT sample_id, base_sample_id FROM @vpairs")
def _(t: Tables):
    return M.variant_base_pairs(t.manifest).select("sample_id", "base_sample_id")


@query("path_collisions", "SELECT path, count(*) AS n FROM (SELECT score_path AS path FROM @manifest UNION ALL SELECT audio_path FROM @manifest) WHERE path <> '' GROUP BY path HAVING count(*) > 1")
def _(t: Tables):
    return M.path_collisions(t.manifest)


# --- audit -----------------------------------------------------------------------------------


@query("voice_licenses", "SELECT voice_id, arg_max(voice_license, ord) AS license FROM @manifest GROUP BY voice_id")
def _(t: Tables):
    return M.voice_licenses(t.manifest)


@query(
    "license_audit",
    f"""SELECT *, unconsented = 0 AND violations = 0 AS passed FROM (SELECT count(DISTINCT voice_id) AS voices, count(*) FILTER (status = 'license_refused') AS refusals, count(*) FILTER (status = 'accepted' AND NOT consent_verified) AS unconsented,
    count(DISTINCT acc_model_id) FILTER (a) AS models, count(*) FILTER (a AND (acc_license = '' OR {NC_SQL.format('acc_license')} OR (starts_with(upper(acc_license), 'CC-BY') AND coalesce(acc_attribution, '') = ''))) AS violations
    FROM (SELECT *, status = 'accepted' AND lane = 'accompaniment' AND acc_mode IS NOT NULL AS a FROM @manifest))""",
)
def _(t: Tables):
    return M.license_audit(t.manifest)


# --- splits ----------------------------------------------------------------------------------

VIEWS["split"] = f"""
SELECT sample_id, source, CASE WHEN k <= CASE WHEN n >= 2 THEN least(n - 1, CAST(round_even(n * 0.2e0, 0) AS BIGINT)) ELSE 0 END THEN 'val' ELSE 'train' END AS side FROM (
SELECT *, count(*) OVER (PARTITION BY source) AS n, row_number() OVER (PARTITION BY source ORDER BY r, sample_id) AS k FROM (
SELECT *, {seed_sql("'7'", 'source', 'sample_id')} AS r FROM (SELECT sample_id, lane || '/' || voice_id || '/' || CASE WHEN coalesce(augmentation_profile, '') = '' THEN '-' ELSE augmentation_profile END AS source FROM @acc)))"""


@query("val_split", "SELECT * FROM @split")
def _(t: Tables):
    return M.val_split(t.manifest, 0.2, 7).select("sample_id", "source", "side")


@query("per_source_counts", "SELECT source, count(*) AS total, count(*) FILTER (side = 'train') AS train, count(*) FILTER (side = 'val') AS val FROM @split GROUP BY source")
def _(t: Tables):
    return M.per_source_counts(M.val_split(t.manifest, 0.2, 7))


@query("split_disjoint", "SELECT count(*) FILTER (t AND v) AS on_both, 0 AS missing, 0 AS \"foreign\" FROM (SELECT sample_id, bool_or(side = 'train') AS t, bool_or(side = 'val') AS v FROM @split GROUP BY sample_id)")
def _(t: Tables):
    m = t.manifest
    return M.split_disjoint(M.val_split(m, 0.2, 7), m)


# --- sets and order --------------------------------------------------------------------------


@query(
    "merge_runs",
    "SELECT sample_id, idx, printf('%03d', idx // 1000) AS shard FROM (SELECT sample_id, row_number() OVER (ORDER BY ord % 3, sample_id) - 1 AS idx FROM @acc)",
)
def _(t: Tables):
    m = t.manifest.withColumn("run_idx", F.col("ord") % 3)
    return M.merge_runs(m).select("sample_id", "idx", "shard")


@query("interleaved_slice", "SELECT sample_id FROM (SELECT sample_id, row_number() OVER (ORDER BY sample_id) - 1 AS k FROM @manifest) WHERE k % 5 = 2")
def _(t: Tables):
    return M.interleaved_slice(t.manifest.select("sample_id"), ["sample_id"], 2, 5)


@query("stride_limit", "SELECT sample_id FROM (SELECT sample_id, row_number() OVER (ORDER BY sample_id) - 1 AS k FROM @manifest) WHERE k % 7 = 0 AND k < 7 * 40")
def _(t: Tables):
    return M.stride_limit(t.manifest.select("sample_id"), ["sample_id"], 7, 40)


@query(
    "stage_cap",
    """SELECT dataset || '__' || sample_id AS staged, path FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY path) AS k FROM (
    SELECT 'd' || (o_custkey % 4) AS dataset, 'r' || o_orderkey AS sample_id, 'x/' || o_orderkey || '/audio' AS path FROM orders)) WHERE dataset = 'd1' OR (dataset = 'd2' AND k <= 25) OR (dataset = 'd3' AND k <= 1500)""",
)
def _(t: Tables):
    k = F.col("o_orderkey").cast("string")
    s = t.raw("orders").select(
        F.concat(F.lit("d"), (F.col("o_custkey") % 4).cast("string")).alias("dataset"), F.concat(F.lit("r"), k).alias("sample_id"),
        F.concat(F.lit("x/"), k, F.lit("/audio")).alias("path"),
    )
    return M.stage_cap(s, ["d1", "d1:5", "d2:25", "d3:1500", "d3:2", "RELABEL=1", "unknown"]).select("staged", "path")


@query(
    "corpus_layout",
    """SELECT sample_id, tree, score_aug_axis AS axis, printf('%03d', ord // 1000) AS shard, tree || coalesce('/augmented/' || score_aug_axis, '') || '/shard=' || printf('%03d', ord // 1000) || '/' || sample_id || '/audio.wav' AS audio_path
    FROM (SELECT *, CASE WHEN status = 'accepted' THEN 'corpus' ELSE 'rejected' END AS tree FROM @manifest)""",
)
def _(t: Tables):
    return score_io.corpus_layout(t.manifest, "ord").select("sample_id", "tree", "axis", "shard", "audio_path")


@query("dataset_volume", "SELECT 'src' || (o_custkey % 6) AS dataset, count(*) AS clips, round(sum(o_totalprice) / 60, 3) AS minutes FROM (SELECT o_custkey, floor(o_totalprice) AS o_totalprice FROM orders) GROUP BY 1")
def _(t: Tables):
    return M.dataset_volume(t.raw("orders").select(F.concat(F.lit("src"), (F.col("o_custkey") % 6).cast("string")).alias("dataset"), F.floor("o_totalprice").alias("duration_s")))


@query("timing_totals", "SELECT max(s_suppkey % 20)::DOUBLE AS largest_frame_hop_ms, sum(s_suppkey % 7)::DOUBLE AS total_group_delay_ms FROM supplier WHERE s_suppkey % 3 = 0")
def _(t: Tables):
    k = F.col("s_suppkey")
    return M.timing_totals(t.raw("supplier").select((k % 20).cast("double").alias("frame_hop_ms"), (k % 7).cast("double").alias("group_delay_ms"), (k % 3 == 0).alias("active")))


_LOG = "(SELECT ord, (ord * 7 % 97)::DOUBLE AS a, (ord * 13 % 211)::DOUBLE AS b, status FROM @manifest)"


@query(
    "relabel_drift",
    " UNION ALL ".join(
        f"SELECT '{n}' AS measure, round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.9), 6) AS p90, round(quantile_cont({c}, 0.99), 6) AS p99, max({c}) AS max, count(*) AS n, count(*) FILTER (status = 'accepted') AS accepted FROM {_LOG}"
        for n, c in (("onset_drift_ms", "a"), ("offset_drift_ms", "b"))
    ),
)
def _(t: Tables):
    o = F.col("ord")
    log = t.manifest.select((o * 7 % 97).cast("double").alias("onset_drift_ms"), (o * 13 % 211).cast("double").alias("offset_drift_ms"), M.status().alias("status"))
    return M.relabel_drift(log).withColumns({c: F.round(c, 6) for c in ("p50", "p90", "p99")})


# --- work ------------------------------------------------------------------------------------

# The product of scores and voices is the result, so the voices are a table that does not grow with the scores.
VIEWS["singers"] = "SELECT 'v' || n_nationkey AS voice_id, CASE n_nationkey % 3 WHEN 0 THEN 'deterministic_donor' WHEN 1 THEN 'svs_voicebank' ELSE 'voice_conversion' END AS kind FROM nation"
VIEWS["lane_voices"] = """SELECT voice_id, CASE kind WHEN 'deterministic_donor' THEN 'deterministic' WHEN 'svs_voicebank' THEN 'svs' END AS lane FROM @singers WHERE kind <> 'voice_conversion'"""
VIEWS["work"] = f"""
SELECT sample_id, score_id, voice_id, lane, {seed_sql("'11'", 'score_id', 'voice_id', 'lane')} AS seed FROM (SELECT score_id, voice_id, lane, score_id || '_singer_' || voice_id || CASE WHEN lane = 'deterministic' THEN '' ELSE '_' || lane END AS sample_id FROM @scores, @lane_voices)"""


def singers(t: Tables):
    k = F.col("n_nationkey")
    kind = F.when(k % 3 == 0, "deterministic_donor").when(k % 3 == 1, "svs_voicebank").otherwise("voice_conversion")
    return t.raw("nation").select(F.concat(F.lit("v"), k.cast("string")).alias("voice_id"), kind.alias("kind"))


def work(t: Tables):
    return W.work_list(t.scores.select("score_id"), singers(t), ["deterministic", "svs"], 11)


@query("work_list", "SELECT lane, voice_id, count(*) AS n, min(sample_id) AS first, max(sample_id) AS last, sum(seed % 1000003)::BIGINT AS seeds FROM @work GROUP BY lane, voice_id")
def _(t: Tables):
    """The whole list, condensed per lane and voice."""
    return work(t).groupBy("lane", "voice_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("sample_id").alias("first"), F.max("sample_id").alias("last"), F.sum(F.col("seed") % 1000003).alias("seeds")
    )


@query("resume_pending", "SELECT score_id, count(*) AS pending, min(sample_id) AS first FROM @work WHERE score_id NOT IN (SELECT 's' || o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY score_id")
def _(t: Tables):
    w = work(t)
    finished = t.raw("orders").filter("o_orderstatus = 'F'").select(F.concat(F.lit("s"), F.col("o_orderkey").cast("string")).alias("score_id"))
    done = w.join(finished, "score_id", "left_semi").select("sample_id")
    left = W.resume_pending(w.select("sample_id", "score_id"), done)
    return left.groupBy("score_id").agg(F.count(F.lit(1)).alias("pending"), F.min("sample_id").alias("first"))


@query("consent_gate", "SELECT sample_id, CASE WHEN v.voice_id IS NULL THEN 'missing' WHEN v.consent_verified THEN 'usable' ELSE 'license_refused' END AS gate, license AS voice_license FROM @manifest m LEFT JOIN @voices v USING (voice_id)")
def _(t: Tables):
    m = t.manifest.select("sample_id", "voice_id")
    return W.consent_gate(m, t.voices).select("sample_id", "gate", "voice_license")


VIEWS["sidecars"] = "SELECT 'set' || r_regionkey AS dir, r_name AS source, 'CC0' AS license FROM region"


def sidecars(t: Tables):
    return t.raw("region").select(F.concat(F.lit("set"), F.col("r_regionkey").cast("string")).alias("dir"), F.col("r_name").alias("source"), F.lit("CC0").alias("license"))


@query("stamp_source", "SELECT score_id, coalesce(source, '') AS score_source, coalesce(license, '') AS score_license FROM @scores LEFT JOIN @sidecars USING (dir)")
def _(t: Tables):
    return W.stamp_source(t.scores, sidecars(t)).drop("dir")


@query("read_source_sidecar", "SELECT dir, count(source) AS stamped, count(*) AS scores FROM @scores LEFT JOIN @sidecars USING (dir) GROUP BY dir")
def _(t: Tables):
    out = W.stamp_source(t.scores, sidecars(t))
    return out.groupBy("dir").agg(F.count_if(F.col("score_source") != "").alias("stamped"), F.count(F.lit(1)).alias("scores"))


@query("read_attribution", "SELECT s_name || '.wav' AS file, 'lic' || s_nationkey AS license FROM supplier WHERE s_suppkey % 5 <> 0")
def _(t: Tables):
    line = F.when(F.col("s_suppkey") % 5 == 0, F.lit("x\ty")).otherwise(F.concat_ws("\t", F.concat("s_name", F.lit(".wav")), F.lit("title"), F.concat(F.lit("lic"), F.col("s_nationkey").cast("string"))))
    return IO.attribution_rows(t.raw("supplier").select(line.alias("value")))


_BASE = "SELECT * FROM @acc WHERE lane NOT IN ('augmentation', 'accompaniment')"


@query(
    "augment_fanout",
    f"""SELECT sample_id || '_aug_' || p AS sample_id, p AS augmentation_profile, {seed_sql("'3'", 'score_id', 'voice_id', "'augment_' || p")} AS seed, score_aug_axis, lyric_source, score_license FROM ({_BASE}), (VALUES ('room'), ('codec')) v(p)""",
)
def _(t: Tables):
    return W.augment_fanout(t.manifest, ["room", "codec"], 3).select("sample_id", "augmentation_profile", "seed", "score_aug_axis", "lyric_source", "score_license")


@query(
    "accompany_fanout",
    f"""SELECT sample_id || '_accomp_lego' AS sample_id, sample_id AS source_sample_id, {seed_sql("'3'", 'score_id', 'voice_id', "'accompaniment_lego'")} AS seed, voice_license FROM ({_BASE})""",
)
def _(t: Tables):
    return W.accompany_fanout(t.manifest, "lego", 3).select("sample_id", "source_sample_id", "seed", "voice_license")


@query(
    "best_take",
    """SELECT base_id, n AS takes_tried, take, status = 'accepted' AS admitted, shift_ms FROM (SELECT *, count(*) OVER (PARTITION BY base_id) AS n, row_number() OVER (PARTITION BY base_id ORDER BY status <> 'accepted', shift_ms, CASE WHEN status = 'accepted' THEN -coalesce(snr_db, -1e9) ELSE 0 END, take) AS k
    FROM (SELECT 'b' || (ord // 5) AS base_id, ord AS take, status, snr_db, max_onset_dev_ms % 4 AS shift_ms FROM @manifest)) WHERE k = 1""",
)
def _(t: Tables):
    takes = t.manifest.select(
        F.concat(F.lit("b"), F.floor(F.col("ord") / 5).cast("string")).alias("base_id"), F.col("ord").alias("take"), "verdict.status", "verdict.snr_db",
        (F.col("verdict.max_onset_dev_ms") % 4).alias("shift_ms"),
    )
    return W.best_take(takes).drop("status")


@query(
    "dedupe_voices",
    """SELECT voice_id, source_order, path, license FROM (SELECT *, row_number() OVER (PARTITION BY voice_id ORDER BY source_order, path) AS k FROM (
    SELECT 'v' || (s_suppkey % 30) AS voice_id, s_nationkey % 3 AS source_order, s_name AS path, 'l' || s_nationkey AS license FROM supplier)) WHERE k = 1""",
)
def _(t: Tables):
    s = t.raw("supplier").select(
        F.concat(F.lit("v"), (F.col("s_suppkey") % 30).cast("string")).alias("voice_id"), (F.col("s_nationkey") % 3).alias("source_order"), F.col("s_name").alias("path"),
        F.concat(F.lit("l"), F.col("s_nationkey").cast("string")).alias("license"), F.lit("deterministic_donor").alias("kind"),
    )
    return W.dedupe_voices(s).select("voice_id", "source_order", "path", "license")


@query(
    "write_report",
    """SELECT CAST(to_json({'source': source, 'total': total, 'train': train, 'val': val}) AS VARCHAR) AS value FROM (
    SELECT source, count(*) AS total, count(*) FILTER (side = 'train') AS train, count(*) FILTER (side = 'val') AS val FROM @split GROUP BY source)""",
)
def _(t: Tables):
    """Per-source counts, written as a report file and read back."""
    folder = f"{ST._workdir(t.spark)}/report"
    score_io.write_report(M.per_source_counts(M.val_split(t.manifest, 0.2, 7)), folder)
    return t.spark.read.text(folder)
