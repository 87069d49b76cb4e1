"""Structured Streaming over append-only inputs: tail, dedupe, tally, phrases, gate.

Every function maps streaming frames to a streaming frame; ``drain`` runs one over the files that
are there and returns what it wrote as a table.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noteflow.operators.scan import join_dimension
from noteflow.schemas import MANIFEST
from noteflow.session import ensure_checkpoint_dir

NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def stream_files(spark: SparkSession, folder: str, schema, fmt: str = "parquet", glob: str | None = None, files: int | None = None) -> DataFrame:
    """Tail a folder of files with a fixed schema; at most ``files`` of them in a batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder)


def stream_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Tail an append-only manifest folder of JSON lines."""
    return stream_files(spark, folder, MANIFEST, "json")


def stream_dedupe(rows: DataFrame, key: str = "sample_id", ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """Each key once within the delay, so that a restarted run does not repeat its samples."""
    return rows.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def stream_tally(rows: DataFrame, by: str = "status") -> DataFrame:
    """Running counts; write in update or complete mode."""
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def stream_phrases(rows: DataFrame, key: str, ts: str = "ts", gap: str = "5 minutes", delay: str = "1 hour") -> DataFrame:
    """Phrases of a key: runs without a rest of ``gap`` or more."""
    session = F.session_window(ts, gap)
    return rows.withWatermark(ts, delay).groupBy(key, session.alias("w")).agg(F.count(F.lit(1)).alias("n")).select(
        key, F.col("w.start").alias("start"), (F.col("w.end") - F.expr(f"INTERVAL {gap}")).alias("end"), "n"
    )


def stream_acceptance(
    rows: DataFrame, width: str, slide: str | None = None, *, accepted: str = "accepted", ts: str = "ts", status: str = "status", delay: str = "1 hour",
) -> DataFrame:
    """Accepted share of the attempts in tumbling or, with ``slide``, sliding event-time windows: start, end, n, accepted, rate.

    In append mode a window appears once, after the watermark has passed its end; in update mode with every batch that changes it. A row
    later than ``delay`` no longer counts in a window that is closed.
    """
    span = F.window(ts, width, slide) if slide else F.window(ts, width)
    counted = rows.withWatermark(ts, delay).groupBy(span.alias("w")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(status) == accepted).alias("accepted"))
    return counted.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "accepted", (F.col("accepted") / F.col("n")).alias("rate"))


def frame_packets(frames: DataFrame, span: str) -> DataFrame:
    """Frames (sample_id, frame_idx, ts) as a recorder sends them, all of a sample within a stretch of ``span`` in one row: sample_id, ts of the first, frames."""
    at = F.floor(F.unix_micros("ts") / _micros(span))
    told = frames.groupBy("sample_id", at.alias("_at")).agg(F.min("ts").alias("ts"), F.sort_array(F.collect_list(F.struct("ts", "frame_idx"))).alias("frames"))
    return told.drop("_at")


def _micros(interval: str) -> Column:
    return F.expr(f"unix_micros(timestamp_seconds(0) + INTERVAL {interval})")


def stream_gate(
    notes: DataFrame, frames: DataFrame, win: str = "150 milliseconds", longest: str = "1 minute", delay: str = "10 minutes", packet: str = "0 seconds",
) -> DataFrame:
    """Frames that reach a note's onset or offset windows, as both arrive.

    ``notes``: sample_id, note_idx, on_ts, off_ts; ``frames``: sample_id, frame_idx, ts, or their ``frame_packets`` of at most
    ``packet`` from first to last frame: one row of state for all frames of a packet. Both sides
    carry watermarks and the time bound lets old state go. A note longer than ``longest`` is cut into
    consecutive pieces of that length, each with its own start, so the bound holds for notes of any length
    and a frame meets one piece of a note.
    """
    step, reach = _micros(longest), _micros(win)
    on, off = F.unix_micros("on_ts"), F.unix_micros("off_ts")
    last = F.greatest(F.ceil((off - on) / step) - 1, F.lit(0))
    n = notes.withColumn("_last", last).withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"))))
    n = n.withColumn("_from", F.timestamp_micros(on + F.col("_piece") * step)).withWatermark("_from", delay).withColumnRenamed("sample_id", "n_sample")
    if "frames" not in frames.columns:
        frames = frames.select("sample_id", "ts", F.array(F.struct("ts", "frame_idx")).alias("frames"))
    f = frames.withWatermark("ts", delay)
    near = (
        (F.col("n_sample") == F.col("sample_id"))
        & (F.col("ts") >= F.col("_from") - F.expr(f"INTERVAL {win}") - F.expr(f"INTERVAL {packet}"))
        & (F.col("ts") <= F.col("_from") + F.expr(f"INTERVAL {longest}") + F.expr(f"INTERVAL {win}"))
        & (F.unix_micros("ts") <= F.unix_micros("off_ts") + reach)
    )
    met = n.join(f, near).drop("ts").withColumn("_f", F.explode("frames")).drop("frames").withColumns({"frame_idx": F.col("_f.frame_idx"), "ts": F.col("_f.ts")})
    reached = (
        (F.col("ts") >= F.col("_from") - F.expr(f"INTERVAL {win}"))
        & (F.col("ts") <= F.col("_from") + F.expr(f"INTERVAL {longest}") + F.expr(f"INTERVAL {win}"))
        & ((F.col("_piece") == 0) | (F.col("ts") >= F.col("_from")))
        & ((F.col("_piece") == F.col("_last")) | (F.unix_micros("ts") < F.unix_micros("_from") + step))
        & (F.unix_micros("ts") <= F.unix_micros("off_ts") + reach)
    )
    return met.filter(reached).drop("n_sample", "_from", "_piece", "_last", "_f")


def _workdir(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"


def drain(stream: DataFrame, mode: str = "append", *, key: list[str] | None = None, work: str | None = None, closing: bool = True) -> DataFrame:
    """Run over all files present and read the result back.

    Append results go to one table of files. In complete mode each batch replaces the table, so the last one is read; in update mode the latest
    row of each ``key`` is. Offsets, state and results live in the session's shared checkpoint folder; a run with the
    ``work`` folder of an earlier one goes on from there. Without ``closing`` there is no last batch without input, which releases the rows
    that the watermark has passed; an inner join holds none back.
    """
    spark = stream.sparkSession
    work = work or _workdir(spark)
    writer = stream.writeStream.option("checkpointLocation", f"{work}/state").trigger(availableNow=True)
    if mode == "append":
        writer = writer.format("parquet").option("path", f"{work}/out").outputMode("append")
        # A query keeps the settings it was started with.
        before = spark.conf.get(NO_DATA)
        spark.conf.set(NO_DATA, str(closing and before == "true").lower())
        try:
            query = writer.start()
        finally:
            spark.conf.set(NO_DATA, before)
        query.awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{work}/out")
    batches: list[int] = []

    def replace(df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{work}/out/epoch={epoch}")
        batches.append(epoch)

    query = writer.foreachBatch(replace).outputMode(mode).start()
    query.awaitTermination()
    if mode == "update":
        names = stream.columns
        if not batches:
            return spark.createDataFrame([], stream.schema)
        told = spark.read.option("basePath", f"{work}/out").parquet(f"{work}/out")
        return told.groupBy(*key).agg(F.max_by(F.struct(*names), "epoch").alias("r")).select("r.*")
    if not batches:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(f"{work}/out/epoch={max(batches)}")


def drain_once(stream: DataFrame, folder: str, key: str = "sample_id") -> DataFrame:
    """Write each key of a stream once, however long it stays away and over any number of restarts; returns the table.

    Watermarks forget keys; here the table that was written is what guards against repeats. A batch is reduced to one row for each key (the first
    by the row's digest) and meets the keys written by earlier batches: those are cut down to the batch's own keys first, which
    are broadcast if counted small, so only known keys are shuffled. A batch has its own folder, so one that is run again after a
    failure replaces what it had written. Rows without a key are not written.
    """
    spark = stream.sparkSession
    rows, schema = f"{folder}/rows", T.StructType([*stream.schema.fields, T.StructField("epoch", T.LongType())])

    def put(batch: DataFrame, epoch: int) -> None:
        columns = batch.columns
        first = F.min_by(F.struct(*columns), F.xxhash64(*[F.col(c) for c in columns]))
        fresh = batch.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(first.alias("r")).select("r.*").persist()
        try:
            if epoch:
                written = spark.read.schema(schema).option("basePath", rows).parquet(rows).filter(F.col("epoch") < epoch).select(key)
                known = join_dimension(written, fresh.select(key), [key], "left_semi")
                fresh.join(known, key, "left_anti").select(*columns).write.mode("overwrite").parquet(f"{rows}/epoch={epoch}")
            else:
                fresh.write.mode("overwrite").parquet(f"{rows}/epoch=0")
        finally:
            fresh.unpersist()

    query = stream.writeStream.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(put).start()
    query.awaitTermination()
    return spark.read.schema(schema).option("basePath", rows).parquet(rows).drop("epoch")


def write_for_stream(df: DataFrame, files: int | None = 4, *, shard: Column | None = None) -> str:
    """Write a table as files that a stream can pick up, without ``files`` one for each partition where it lies; returns the folder.

    With ``shard``, a number, rows go to one folder for each of its values; see ``shard_folders``.
    """
    folder = f"{_workdir(df.sparkSession)}/in"
    df = df.repartition(files) if files else df
    if shard is None:
        df.write.parquet(folder)
    else:
        df.withColumn("_shard", shard).write.partitionBy("_shard").parquet(folder)
    return folder


def shard_folders(spark: SparkSession, folder: str, schema) -> dict[int, str]:
    """The folder of every shard that has rows."""
    found = (re.match(r"(.*/_shard=(\d+))/", f) for f in spark.read.schema(schema).parquet(folder).inputFiles())
    return {int(m[2]): m[1] for m in found if m}
