"""Streaming queries drained over the given tables."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noteflow.plans.registry import query
from noteflow.sources.adapters import Tables
from noteflow.sources.manifest_io import append_manifest
from noteflow.streaming import manifest_stream as ST


#: Notes whose pieces, and the packets of their samples, are the state of one stream.
SHARD_NOTES = 2_000_000


def _events(t: Tables, closing: str | None = None):
    """The events as a stream. With ``closing``, a last row that much later moves the watermark past all others."""
    table = t.raw("events")
    schema = table.schema
    if closing:
        last = table.agg((F.max("ts") + F.expr(f"INTERVAL {closing}")).alias("ts"))
        e = ST.stream_files(t.spark, ST.write_for_stream(table.unionByName(last, allowMissingColumns=True)), schema)
    else:
        e = ST.stream_files(t.spark, t.sf_dir, schema, glob="events.parquet")
    return e.withColumns({
        "ts": F.col("ts").cast("timestamp"),
        "sample_id": F.concat_ws("_", F.col("user_id").cast("string"), "event_type"), "status": F.col("event_type"),
    })


@query("append_manifest", "SELECT status, count(*) AS n, count(DISTINCT sample_id) AS ids FROM @manifest GROUP BY status")
def _(t: Tables):
    """Two appends to one folder, read back as a table."""
    from noteflow.sources.manifest_io import read_manifest

    folder = f"{ST._workdir(t.spark)}/manifest"
    m = t.manifest
    append_manifest(m.filter("ord % 2 = 0"), folder)
    append_manifest(m.filter("ord % 2 = 1"), folder)
    back = read_manifest(t.spark, folder)
    return back.groupBy(F.col("verdict.status").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("sample_id").alias("ids"))


@query("stream_manifest", "SELECT sample_id, lane, status FROM @manifest")
def _(t: Tables):
    folder = f"{ST._workdir(t.spark)}/manifest"
    append_manifest(t.manifest, folder)
    tail = ST.stream_manifest(t.spark, folder).select("sample_id", "lane", F.col("verdict.status").alias("status"))
    return ST.drain(tail)


@query("stream_dedupe", "SELECT DISTINCT user_id || '_' || event_type AS sample_id FROM events")
def _(t: Tables):
    return ST.drain(ST.stream_dedupe(_events(t))).select("sample_id")


@query("stream_tally", "SELECT event_type AS status, count(*) AS n FROM events GROUP BY event_type")
def _(t: Tables):
    return ST.drain(ST.stream_tally(_events(t)), "complete")


@query(
    "stream_phrases",
    """SELECT user_id, min(ts) AS start, max(ts) AS "end", count(*) AS n FROM (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM (
    SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS b FROM events)) GROUP BY user_id, g""",
)
def _(t: Tables):
    out = ST.drain(ST.stream_phrases(_events(t, closing="1 day"), "user_id", gap="2 hours"))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


_RATE = """SELECT start, start + INTERVAL 1 DAY AS "end", count(*) AS n, count(*) FILTER (event_type = 'purchase') AS accepted, count(*) FILTER (event_type = 'purchase') / count(*) AS rate
FROM (SELECT event_type, {start} AS start FROM events) GROUP BY start"""


def _local(out):
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@query("stream_acceptance", _RATE.format(start="date_trunc('day', ts)::TIMESTAMP"))
def _(t: Tables):
    """Share of purchases of each day, once the day is closed."""
    return _local(ST.drain(ST.stream_acceptance(_events(t, closing="2 days"), "1 day", accepted="purchase")))


@query("stream_acceptance_sliding", _RATE.format(start="time_bucket(INTERVAL 6 HOUR, ts)::TIMESTAMP - unnest(range(4)) * INTERVAL 6 HOUR"))
def _(t: Tables):
    """The same over a day, every six hours, kept up to date by batches of one file."""
    table = t.raw("events")
    files = ST.stream_files(t.spark, ST.write_for_stream(table), table.schema, files=1).withColumns({"ts": F.col("ts").cast("timestamp"), "status": F.col("event_type")})
    return _local(ST.drain(ST.stream_acceptance(files, "1 day", "6 hours", accepted="purchase", delay="3650 days"), "update", key=["start"]))


@query("stream_resume", "SELECT user_id || '_' || event_type AS sample_id FROM events GROUP BY 1")
def _(t: Tables):
    """Every sample once over batches of one file and a restart in between."""
    table = t.raw("events").select(F.concat_ws("_", F.col("user_id").cast("string"), "event_type").alias("sample_id"), "event_id")
    work = ST._workdir(t.spark)
    for part in (0, 1):
        table.filter(F.col("event_id") % 2 == part).repartition(2).write.mode("append").parquet(f"{work}/in")
        out = ST.drain_once(ST.stream_files(t.spark, f"{work}/in", table.schema, files=1), f"{work}/done")
    return out.select("sample_id")


@query(
    "stream_gate",
    """SELECT score_id AS sample_id, note_idx, count(*) AS frames FROM @note_rows n JOIN @frame_rows f ON f.sample_id = n.score_id AND t_ms BETWEEN onset_ms - 150 AND offset_ms + 150 GROUP BY ALL""",
)
def _(t: Tables):
    """Notes, and frames in packets, written as files, joined as streams, counted per note.

    All samples begin at the same time, so no watermark lets state go while the files are read. Samples are dealt to shards, and each
    shard is a stream of its own, one after the other.
    """
    at = lambda ms: F.timestamp_millis(ms + F.lit(1_700_000_000_000))
    notes = t.note_rows().select(F.col("score_id").alias("sample_id"), "note_idx", at(F.col("onset_ms")).alias("on_ts"), at(F.col("offset_ms")).alias("off_ts"))
    frames = t.frame_rows().select("sample_id", "frame_idx", at(F.col("t_ms")).alias("ts"))
    packets = ST.frame_packets(frames, "500 milliseconds")
    shards = math.ceil((t.raw("lineitem").count() + 1) / SHARD_NOTES)
    # Samples that lie in one partition are of one shard, so a partition is one file.
    slots = max(t.parts or 1, shards)
    shard = F.floor(F.pmod(F.hash("sample_id"), F.lit(slots)) * shards / slots)
    a, b = (ST.shard_folders(t.spark, ST.write_for_stream(df, None, shard=shard), df.schema) for df in (notes, packets))

    def joined(k: int) -> DataFrame:
        # Most notes are longer than the bound, so they are joined in pieces.
        sides = ST.stream_files(t.spark, a[k], notes.schema), ST.stream_files(t.spark, b[k], packets.schema)
        return ST.drain(ST.stream_gate(*sides, longest="200 milliseconds", packet="500 milliseconds"), closing=False).select("sample_id", "note_idx")

    met = [joined(k) for k in sorted(a.keys() & b.keys())]
    met = reduce(DataFrame.unionByName, met) if met else notes.select("sample_id", "note_idx").limit(0)
    return met.groupBy("sample_id", "note_idx").agg(F.count(F.lit(1)).alias("frames"))
