"""Late rows, restarts and keys that come back long after."""

from datetime import datetime, timedelta

import pytest

from noteflow.streaming import manifest_stream as ST

DAY = datetime(2024, 1, 1)
SCHEMA = "sample_id string, status string, ts timestamp"


@pytest.fixture
def feed(spark, tmp_path):
    """Adds files to a folder that a stream tails."""

    def add(*rows):
        made = [(k, s, DAY + timedelta(hours=h)) for k, s, h in rows]
        spark.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        return ST.stream_files(spark, str(tmp_path / "in"), SCHEMA)

    return add


def test_late_rows_of_closed_windows(feed, tmp_path):
    work = str(tmp_path / "work")
    rate = lambda stream: ST.drain(ST.stream_acceptance(stream, "2 hours", delay="1 hour"), work=work)
    rate(feed(("a", "accepted", 0.5), ("b", "rejected", 1.0), ("c", "accepted", 6.0)))
    # The first comes too late, the second within the delay.
    rate(feed(("d", "accepted", 1.5), ("e", "rejected", 5.5)))
    out = rate(feed(("f", "accepted", 12.0)))
    got = {r["start"]: (r["n"], r["accepted"], r["rate"]) for r in out.collect()}
    assert got == {DAY: (2, 1, 0.5), DAY + timedelta(hours=4): (1, 0, 0.0), DAY + timedelta(hours=6): (1, 1, 1.0)}


def test_windows_are_updated(feed, tmp_path):
    work = str(tmp_path / "work")
    rate = lambda stream: ST.drain(ST.stream_acceptance(stream, "2 hours", "1 hour", delay="1 hour"), "update", key=["start"], work=work)
    rate(feed(("a", "accepted", 0.5)))
    out = rate(feed(("b", "rejected", 0.7)))
    got = {r["start"]: (r["n"], r["rate"]) for r in out.collect()}
    assert got == {DAY: (2, 0.5), DAY - timedelta(hours=1): (2, 0.5)}


def test_keys_stay_single_for_good(feed, tmp_path):
    folder = str(tmp_path / "done")
    once = lambda stream: ST.drain_once(stream, folder)
    once(feed(("a", "accepted", 0), ("a", "accepted", 0), ("b", "rejected", 1), (None, "accepted", 2)))
    once(feed(("c", "accepted", 24 * 30)))
    out = once(feed(("a", "rejected", 24 * 400), ("d", "accepted", 24 * 400), ("c", "rejected", 24 * 401)))
    assert sorted((r["sample_id"], r["status"]) for r in out.collect()) == [("a", "accepted"), ("b", "rejected"), ("c", "accepted"), ("d", "accepted")]
    # Nothing new.
    assert ST.drain_once(feed(("d", "accepted", 24 * 900)), folder).count() == 4


def test_gate_by_packets_equals_gate_by_frames(spark):
    from pyspark.sql import functions as F

    at = lambda ms: F.timestamp_millis(ms + F.lit(1_700_000_000_000))
    ids = F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("sample_id")
    notes = spark.range(12).select(ids, F.col("id").cast("int").alias("note_idx"), at(F.col("id") * 170).alias("on_ts"), at(F.col("id") * 170 + 30 + F.col("id") % 5 * 260).alias("off_ts"))
    frames = spark.range(360).select(ids, F.col("id").alias("frame_idx"), at(F.floor(F.col("id") / 3) * 20).alias("ts"))
    packets = ST.frame_packets(frames, "500 milliseconds")
    assert packets.count() == 15 and packets.select(F.sum(F.size("frames"))).first()[0] == 360

    def reached(b, **more):
        sides = [ST.stream_files(spark, ST.write_for_stream(df, None), df.schema) for df in (notes, b)]
        rows = ST.drain(ST.stream_gate(*sides, longest="200 milliseconds", **more)).select("sample_id", "note_idx", "frame_idx", "ts").collect()
        return sorted(map(tuple, rows))

    near = F.col("ts").between(F.col("on_ts") - F.expr("INTERVAL 150 milliseconds"), F.col("off_ts") + F.expr("INTERVAL 150 milliseconds"))
    want = notes.join(frames, "sample_id").filter(near).select("sample_id", "note_idx", "frame_idx", "ts").collect()
    assert reached(frames) == reached(packets, packet="500 milliseconds") == sorted(map(tuple, want))


def test_gate_by_shards(spark, monkeypatch):
    """A stream holds the state of its own shard's samples only; together they meet what one stream over all meets."""
    from pyspark.sql import functions as F

    from noteflow.plans import catalog, streams
    from noteflow.plans.registry import QUERIES

    catalog.load()

    held = []

    def drain(stream, *a, **k):
        out = drained(stream, *a, **k)
        held.append({r["sample_id"] for r in out.select("sample_id").distinct().collect()})
        return out

    drained = ST.drain
    monkeypatch.setattr(ST, "drain", drain)
    rows = lambda: sorted(map(tuple, QUERIES["stream_gate"](spark, "/root/testdata/sf0.001").collect()))
    whole = rows()
    assert len(held) == 1 and sum(r[2] for r in whole) > 0
    everyone = held.pop()
    monkeypatch.setattr(streams, "SHARD_NOTES", 1500)
    assert rows() == whole
    assert len(held) > 2 and sum(map(len, held)) == len(set.union(*held)) == len(everyone)

    df = spark.range(30).select(F.col("id"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("sample_id"))
    folders = ST.shard_folders(spark, ST.write_for_stream(df, None, shard=F.floor(F.col("id") % 6 / 2)), df.schema)
    assert sorted(folders) == [0, 1, 2] and all(spark.read.parquet(f).count() == 10 for f in folders.values())
    assert ST.shard_folders(spark, ST.write_for_stream(df.limit(0), None, shard=F.floor("id")), df.schema) == {}
