"""Manifest rows: nested schema, JSON-lines reader and appender, reject side table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noteflow.schemas import ACCOMPANIMENT, MANIFEST

CORRUPT = "_corrupt_record"


def nest_manifest(flat: DataFrame) -> DataFrame:
    """Flat provenance columns to the nested manifest schema, plus the append order ``ord``."""
    verdict = F.struct(
        "status", "onset_ok", "offset_ok", "f0_ok", "snr_db", "reason", "max_onset_dev_ms"
    )
    lego = F.col("acc_mode") == "lego"
    acc = F.struct(
        F.col("acc_mode").alias("mode"),
        F.col("acc_model_id").alias("model_id"),
        F.lit("1").alias("model_version"),
        F.col("acc_license").alias("model_license"),
        F.col("acc_attribution").alias("attribution_text"),
        F.col("acc_bit_exact").alias("vocal_bit_exact"),
        F.col("acc_source_id").alias("source_vocal_sample_id"),
        F.lit(1).alias("takes_tried"),
        F.col("acc_shift_ms").alias("max_note_shift_ms"),
        (~lego).alias("free_time"),
        F.lit("band").alias("target_instrument"),
        F.col("acc_stem").alias("stem_available"),
    ).cast(ACCOMPANIMENT)
    return flat.select(
        "sample_id", "score_id", "score_path", "audio_path", "lane", "voice_id",
        "augmentation_profile", "seed", "voice_license", "consent_verified", "config_hash",
        verdict.alias("verdict"), "lyric_source",
        F.lit(None).cast("string").alias("lyric_hash"),
        F.lit(None).cast("string").alias("lyric_model"),
        F.lit(None).cast("string").alias("lyric_model_license"),
        F.lit(False).alias("lyric_articulated"),
        "lyric_multisyllable_supplied", "lyric_language",
        F.when(F.col("acc_mode").isNotNull(), acc).alias("accompaniment"),
        "base_score_id", "score_aug_profile", "score_aug_axis", "score_aug_transform",
        "score_aug_seed", F.lit(False).alias("dynamics_applied"), "score_source", "score_license",
        F.create_map().cast("map<string,string>").alias("notes"),
        F.col("ord"),
    )


def parse_manifest(lines: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON text to manifest rows; blank lines are skipped, unreadable ones keep their text. ``keep`` names columns of the lines to carry along."""
    schema = f"{MANIFEST}, {CORRUPT} string"
    text = lines.filter(F.trim(F.col(column)) != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return text.withColumn("_r", F.from_json(column, schema, options)).select("_r.*", *keep)


def split_corrupt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows, rejects): a row is rejected when unreadable or without its identifiers."""
    bad = F.col(CORRUPT).isNotNull() | F.col("sample_id").isNull() | F.col("verdict.status").isNull()
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("not a manifest record")).otherwise(
        F.lit("required field missing")
    )
    rejects = rows.filter(bad).select(F.col(CORRUPT).alias("line"), reason.alias("reason"))
    return rows.filter(~bad).drop(CORRUPT), rejects


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Usable records of all files with their append order ``ord``, by which the last record of a sample can be told.

    ``ord`` compares by the time a file was finished, then its name and the place of the line in it. Records that one append wrote by
    several tasks have the order in which these ended.
    """
    meta = F.col("_metadata")
    at = F.struct(meta["file_modification_time"].alias("time"), meta["file_path"].alias("path"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("n"))
    # Inside one block of a file the last number grows with the lines.
    lines = spark.read.text(path).select("value", at.alias("ord"))
    good, _ = split_corrupt(parse_manifest(lines, keep=("ord",)))
    return good


def append_manifest(df: DataFrame, path: str) -> None:
    """One JSON object per attempted sample; earlier files are never rewritten."""
    df.select(*[c for c in T.StructType.fromDDL(MANIFEST).fieldNames() if c in df.columns]).write.mode("append").json(path)


def read_sidecar(spark: SparkSession, path: str) -> DataFrame:
    """``_source.json`` files as (dir, source, license, url)."""
    from noteflow.schemas import SIDECAR

    rows = spark.read.schema(SIDECAR).option("multiLine", True).json(path)
    return rows.select(
        F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1).alias("dir"), "source", "license", "url"
    )


def read_attribution(spark: SparkSession, path: str) -> DataFrame:
    return attribution_rows(spark.read.text(path))


def attribution_rows(lines: DataFrame, column: str = "value") -> DataFrame:
    """Tab-separated attribution lines to (file, license); short lines are skipped."""
    cols = F.split(F.col(column), "\t")
    return lines.filter(F.size(cols) >= 3).select(cols[0].alias("file"), cols[2].alias("license"))
