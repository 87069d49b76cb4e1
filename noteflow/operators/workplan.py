"""The work of a run: score × lane × voice, gates before cost, fan-out, resume."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noteflow.functions.scalar import accompanied_id, augmented_id, derive_seed, sample_id
from noteflow.operators.scan import join_dimension, join_few_keys

# The kind of voice that each lane renders.
LANE_KINDS = {
    "deterministic": "deterministic_donor",
    "svs": "svs_voicebank",
    "voice_conversion": "voice_conversion",
}


def config_hash(config: dict) -> str:
    """Digest of the configuration as JSON with sorted keys and no blanks."""
    text = json.dumps(config, sort_keys=True, separators=(",", ":"))
    return "sha256:" + hashlib.sha256(text.encode("utf-8")).hexdigest()


def stamp_config(records: DataFrame, config: dict) -> DataFrame:
    return records.withColumn("config_hash", F.lit(config_hash(config)))


def work_list(scores: DataFrame, voices: DataFrame, lanes: list[str], master_seed: int) -> DataFrame:
    """Every enabled lane for every score with every voice of the lane's kind, id and seed.

    The product is the result; a large voice table is salted, since there are only three kinds.
    """
    enabled = [name for name in lanes if name in LANE_KINDS]
    if not enabled:
        raise ValueError("no lane is enabled")
    pairs = F.array(*[F.struct(F.lit(n).alias("lane"), F.lit(LANE_KINDS[n]).alias("kind")) for n in enabled])
    listed = scores.withColumn("_l", F.explode(pairs)).select(*scores.columns, "_l.lane", "_l.kind")
    placed = join_few_keys(listed, voices.select("voice_id", "kind"), "kind")
    return placed.withColumns({
        "sample_id": sample_id("score_id", "voice_id", "lane"),
        "seed": derive_seed(master_seed, "score_id", "voice_id", "lane"),
    }).drop("kind")


def resume_pending(work: DataFrame, done: DataFrame) -> DataFrame:
    """Work whose sample id has not been completed."""
    return work.join(done.select("sample_id"), "sample_id", "left_anti")


def consent_gate(work: DataFrame, voices: DataFrame) -> DataFrame:
    """Adds the voice's licence and the gate outcome: usable, license_refused, or missing."""
    known = voices.select(
        "voice_id", F.col("license").alias("voice_license"), F.coalesce("consent_verified", F.lit(False)).alias("consent_verified"),
        F.lit(True).alias("_known"),
    )
    gate = (
        F.when(F.col("_known").isNull(), "missing").when(F.col("consent_verified"), "usable").otherwise("license_refused")
    )
    return join_dimension(work, known, ["voice_id"], "left").withColumn("gate", gate).drop("_known")


def license_policy(backends: DataFrame, policy: list[str], mode: str) -> DataFrame:
    """Adds ``skip_reason``: NULL when the model's licence is allowed and the mode supported."""
    refused = ~F.coalesce(F.col("model_license").isin(*policy), F.lit(False))
    unsupported = ~F.array_contains("modes", mode)
    return backends.withColumn(
        "skip_reason", F.when(refused, "license not in policy").when(unsupported, "mode not supported")
    )


def stamp_source(scores: DataFrame, sidecar: DataFrame) -> DataFrame:
    """Source and licence of each score's folder; empty text where there is none."""
    s = sidecar.select("dir", F.col("source").alias("score_source"), F.col("license").alias("score_license"))
    out = join_dimension(scores, s, ["dir"], "left")
    return out.withColumns({c: F.coalesce(c, F.lit("")) for c in ("score_source", "score_license")})


def _accepted() -> Column:
    return F.col("verdict.status") == "accepted"


CARRIED = (
    "score_id", "voice_id", "voice_license", "consent_verified", "config_hash", "base_score_id", "score_aug_profile",
    "score_aug_axis", "score_aug_transform", "score_aug_seed", "dynamics_applied", "lyric_source", "lyric_hash",
    "lyric_model", "lyric_model_license", "lyric_articulated", "lyric_multisyllable_supplied", "lyric_language",
    "score_source", "score_license",
)


def augment_fanout(manifest: DataFrame, profiles: list[str], master_seed: int) -> DataFrame:
    """One augmentation row per accepted base record and profile; labels and lineage are carried."""
    base = manifest.filter(_accepted() & ~F.col("lane").isin("augmentation", "accompaniment"))
    rows = base.withColumn("augmentation_profile", F.explode(F.array(*[F.lit(p) for p in profiles])))
    stage = F.concat(F.lit("augment_"), F.col("augmentation_profile"))
    return rows.select(
        augmented_id("sample_id", "augmentation_profile").alias("sample_id"), F.lit("augmentation").alias("lane"),
        "augmentation_profile", derive_seed(master_seed, "score_id", "voice_id", stage).alias("seed"),
        F.col("sample_id").alias("source_sample_id"), *CARRIED,
    )


def accompany_fanout(manifest: DataFrame, mode: str, master_seed: int) -> DataFrame:
    """One accompaniment row per accepted base record; the labels stay those of the vocal."""
    base = manifest.filter(_accepted() & ~F.col("lane").isin("augmentation", "accompaniment"))
    return base.select(
        accompanied_id("sample_id", F.lit(mode)).alias("sample_id"), F.lit("accompaniment").alias("lane"),
        derive_seed(master_seed, "score_id", "voice_id", F.lit(f"accompaniment_{mode}")).alias("seed"),
        F.col("sample_id").alias("source_sample_id"), F.lit(mode).alias("mode"),
        "score_id", "voice_id", "voice_license", "consent_verified", "config_hash", "score_source", "score_license",
    )


def union_originals_variants(originals: DataFrame, variants: DataFrame) -> DataFrame:
    """Work list of base scores and their variants; ``variant`` tells which."""
    return originals.select("score_id", F.lit(None).cast("string").alias("base_score_id")).unionByName(
        variants.select("score_id", "base_score_id")
    ).withColumn("variant", F.col("base_score_id").isNotNull())


def best_take(takes: DataFrame) -> DataFrame:
    """Per base the take to keep: smallest shift then highest level ratio among accepted takes.

    Without an accepted take, the failure with the smallest shift; the earlier take wins ties.
    """
    snr = F.when(F.col("status") == "accepted", -F.coalesce("snr_db", F.lit(-1e9))).otherwise(0.0)
    rank = F.struct((F.col("status") != "accepted").alias("failed"), F.col("shift_ms"), snr.alias("s"), F.col("take"))
    return takes.groupBy("base_id").agg(
        F.count(F.lit(1)).alias("takes_tried"), F.min(F.struct(rank.alias("rank"), "take", "status", "shift_ms")).alias("b")
    ).select("base_id", "takes_tried", "b.take", "b.status", "b.shift_ms", (F.col("b.status") == "accepted").alias("admitted"))


def dedupe_voices(sources: DataFrame) -> DataFrame:
    """First voice of each id, by source order then path; an aggregate, so no id gathers its copies."""
    keep = F.min(F.struct("source_order", "path", "license", "kind"))
    return sources.groupBy("voice_id").agg(keep.alias("v")).select("voice_id", "v.*")
