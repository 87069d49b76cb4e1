"""Score text: parsing with rejects, canonical lines, exports, file catalogues, layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noteflow.operators.scores import reject_reason

# A number as the score format accepts it; digits may be grouped by underscores.
NUMBER = r"^[+-]?((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+)?$"
NOT_A_LENGTH = r"(?i)^[+-]?(nan|inf|infinity)$"

# File extensions taken as audio.
AUDIO_EXTENSIONS = ("wav", "mp3", "flac", "ogg", "m4a", "aac")


def _number(c: Column) -> Column:
    plain = F.when(c.rlike(NUMBER), F.regexp_replace(c, "_", "").cast("double"))
    return plain.when(c.rlike(NOT_A_LENGTH), F.regexp_replace(F.lower(c), "^[+]", "").cast("double"))


def parse_score_lines(lines: DataFrame, path: str = "path", text: str = "value", keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(notes, rejects) of score lines; blank, short and non-numeric lines are skipped.

    The score is named by the stem of its file; ``keep`` lists columns that notes carry on.
    """
    stripped = F.regexp_replace(F.col(text), r"^\s+|\s+$", "")
    cells = F.when(stripped.contains("\t"), F.transform(F.split(stripped, "\t"), lambda c: F.trim(c))).otherwise(
        F.split(stripped, r"\s+")
    )
    rows = lines.withColumn("_c", cells).filter(F.size("_c") >= 3)
    get = lambda i: F.try_element_at("_c", F.lit(i))
    pitch = F.rint(_number(get(3)))
    parsed = rows.select(
        F.regexp_replace(F.regexp_extract(F.col(path), r"([^/]+)$", 1), r"(?<=.)\.[^.]*$", "").alias("score_id"),
        F.col(path).alias("path"), F.col(text).alias("line"),
        _number(get(1)).alias("onset_s"), _number(get(2)).alias("offset_s"),
        F.when(~F.isnan(pitch) & (F.abs(pitch) < 2**31), pitch.cast("int")).alias("pitch_midi"),
        F.nullif(get(4), F.lit("")).alias("lyric"),
        pitch.isNotNull().alias("_numeric"), *[c for c in keep if c != "path"],
    ).filter("onset_s IS NOT NULL AND offset_s IS NOT NULL AND _numeric").drop("_numeric")
    labelled = parsed.withColumn("reason", reject_reason())
    notes = labelled.filter("reason IS NULL").drop("reason", "line", *([] if "path" in keep else ["path"]))
    return notes, labelled.filter("reason IS NOT NULL").select("path", "line", "reason")


def score_name(path: Column, root: str) -> Column:
    """The score of a file: its ``score_id=`` folder, else its path below ``root`` without the extension.

    A file named score.tsv stands for its folder.
    """
    plain = F.url_decode(F.regexp_replace(path, r"\+", "%2B"))
    folder = F.regexp_extract(plain, r"/score_id=([^/]*)/", 1)
    top = root.rstrip("/").rsplit(":", 1)[-1].lstrip("/")
    below = F.element_at(F.split(plain, "\\Q" + top + "/\\E", 2), -1)
    stem = F.regexp_replace(below, r"(?<=[^/])\.[^./]*$", "")
    return F.when(folder != "", F.url_decode(F.regexp_replace(folder, r"\+", "%2B"))).otherwise(F.regexp_replace(stem, r"(?<=[^/])/score$", ""))


def read_scores(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(numbered notes, rejects) of every score file under ``path``; notes that tie keep their order in the file."""
    from noteflow.operators.scores import sort_notes

    at = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"), "value"]
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(*at)
    # Inside one block of a file this number grows with the lines.
    lines = lines.withColumn("_line", F.struct("_block", F.monotonically_increasing_id().alias("n")))
    notes, rejects = parse_score_lines(lines, keep=("path", "_line"))
    named = notes.withColumn("score_id", score_name(F.col("path"), path)).withColumn("note_idx", F.col("_line"))
    return sort_notes(named.drop("path", "_line")), rejects


_LINE = "%.6f\t%.6f\t%d"


def score_lines(notes: DataFrame, base: str | None = None) -> DataFrame:
    """(score_id, note_idx, line): the lyric column is written for a score that has any lyric, and never without such a column.

    ``base`` names a column that every score has one value of, the score it was made from; it is kept, and notes that lie by it stay where they lie.
    """
    keys = [base, "score_id"] if base else ["score_id"]
    if "lyric" not in notes.columns:
        return notes.select(*keys, "note_idx", F.format_string(_LINE, "onset_s", "offset_s", "pitch_midi").alias("line"))
    has = F.coalesce(F.col("lyric"), F.lit("")) != ""
    sung = notes.groupBy(*keys).agg(F.bool_or(has).alias("_sung"))
    plain = F.format_string(_LINE, "onset_s", "offset_s", "pitch_midi")
    full = F.concat(plain, F.lit("\t"), F.coalesce("lyric", F.lit("")))
    return notes.join(sung, keys).select(
        *keys, "note_idx", F.when(F.col("_sung"), full).otherwise(plain).alias("line")
    )


def write_scores(notes: DataFrame, path: str) -> None:
    """One folder per score; rows inside each file are in note order."""
    lines = score_lines(notes)
    (
        lines.repartitionByRange("score_id", "note_idx")
        .sortWithinPartitions("score_id", "note_idx")
        .select("score_id", "line")
        .write.mode("append")
        .partitionBy("score_id")
        .text(path)
    )


def export_notes(notes: DataFrame, path: str, fmt: str) -> None:
    """Notes as tsv, csv or json with the header onset, offset, pitch."""
    if fmt not in ("tsv", "csv", "json"):
        raise ValueError(f"unknown export format {fmt!r}")
    rows = export_rows(notes)
    if fmt == "json":
        rows.selectExpr("score_id", "double(onset) AS onset", "double(offset) AS offset", "int(pitch) AS pitch").write.partitionBy("score_id").json(path)
    else:
        rows.write.partitionBy("score_id").option("header", True).option("sep", "\t" if fmt == "tsv" else ",").csv(path)


def export_rows(notes: DataFrame) -> DataFrame:
    return notes.select(
        "score_id", F.format_string("%.6f", "onset_s").alias("onset"),
        F.format_string("%.6f", "offset_s").alias("offset"), F.col("pitch_midi").cast("string").alias("pitch"),
    )


# --- file catalogues -------------------------------------------------------------------------


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes) of all files below ``path``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("bytes"))


def audio_catalogue(files: DataFrame, include: str | None = None, exclude: str | None = None) -> DataFrame:
    """Audio files of a listing, by extension and optional patterns."""
    ext = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    out = files.filter(ext.isin(*AUDIO_EXTENSIONS))
    if include:
        out = out.filter(F.col("path").rlike(include))
    if exclude:
        out = out.filter(~F.col("path").rlike(exclude))
    return out


def paired_files(files: DataFrame) -> DataFrame:
    """Audio with its label: ``score.tsv`` beside ``audio.wav``, or a tsv of the same stem."""
    parts = files.select(
        "path", F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("dir"),
        F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("stem"),
        F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).alias("ext"),
    )
    audio = parts.filter(F.col("ext").isin(*AUDIO_EXTENSIONS)).withColumn(
        "_label", F.when(F.col("stem") == "audio", F.lit("score")).otherwise(F.col("stem"))
    )
    labels = parts.filter("ext = 'tsv'").select("dir", F.col("stem").alias("_label"), F.col("path").alias("label_path"))
    return audio.join(labels, ["dir", "_label"]).select(F.col("path").alias("audio_path"), "label_path")


# --- corpus layout ---------------------------------------------------------------------------

SHARD_SIZE = 1000


def corpus_layout(records: DataFrame, index: str = "idx", shard_size: int = SHARD_SIZE) -> DataFrame:
    """Adds tree, shard and the relative audio and score paths of each record."""
    tree = F.when(F.col("verdict.status") == "accepted", F.lit("corpus")).otherwise(F.lit("rejected"))
    axis = F.coalesce(F.nullif("score_aug_axis", F.lit("")), F.lit(None))
    base = F.when(axis.isNotNull(), F.concat(tree, F.lit("/augmented/"), axis)).otherwise(tree)
    shard = F.format_string("%03d", F.floor(F.col(index) / shard_size))
    folder = F.concat(base, F.lit("/shard="), shard, F.lit("/"), F.col("sample_id"))
    return records.withColumns({
        "tree": tree, "axis": axis, "shard": shard,
        "audio_path": F.concat(folder, F.lit("/audio.wav")),
        "score_path": F.concat(folder, F.lit("/score.tsv")),
    })


def write_corpus(records: DataFrame, path: str) -> None:
    corpus_layout(records).write.mode("append").partitionBy("tree", "axis", "shard").json(path)


def report_lines(report: DataFrame) -> DataFrame:
    """Report rows as JSON text with sorted keys."""
    cols = sorted(report.columns)
    return report.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value"))


def write_report(report: DataFrame, path: str) -> None:
    report_lines(report).write.mode("overwrite").text(path)


def read_projected_parquet(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Only the named columns are read from the files."""
    return spark.read.parquet(path).select(*columns)
