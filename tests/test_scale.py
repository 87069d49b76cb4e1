"""Cut groups and partition counts must not change results."""

import pytest
from pyspark.sql import functions as F

from noteflow.operators import expand
from noteflow.operators import gate as G
from noteflow.operators import scan
from noteflow.operators import scores as S


def table(df, *cols):
    return sorted(tuple(str(v) for v in r) for r in (df.select(*cols) if cols else df).collect())


@pytest.fixture(scope="module")
def long_score(spark):
    n = spark.range(4000)
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 50).cast("string")))
    on = F.col("id") * 0.3 + F.when(F.col("id") % 11 == 0, 0.25).otherwise(0.0)
    return n.select(
        key.alias("score_id"), F.col("id").cast("int").alias("note_idx"), on.alias("onset_s"),
        (on + 0.2 + F.col("id") % 7 / 10.0).alias("offset_s"), (F.lit(55) + F.col("id") % 20).cast("int").alias("pitch_midi"),
        F.lit(None).cast("string").alias("lyric"),
    )


@pytest.fixture
def cut_at(monkeypatch):
    return lambda rows: monkeypatch.setattr(scan, "HOT_ROWS", rows)


@pytest.mark.parametrize("rows", [40, 500, 1300])
def test_cut_scans_equal_whole_scans(long_score, rows):
    args = dict(
        row_number="rn", sum_before={"s": "pitch_midi"}, max_before={"m": "offset_s"}, xor_before={"x": "note_idx"},
        lag={"p": "offset_s", "pl": "lyric"}, lead={"n": "onset_s"},
    )
    order = ["onset_s", "note_idx"]
    some = long_score.withColumn("score_id", F.when(F.col("score_id") != "s1", F.col("score_id")))
    whole = scan.ordered_scan(some, "score_id", order, **args)
    cut = scan.ordered_scan(some, "score_id", order, max_rows=rows, **args)
    assert cut.columns == whole.columns and table(cut) == table(whole)


def test_pieces_are_bounded(long_score):
    placed, cut = scan.place(long_score, "score_id", ["onset_s", "note_idx"], 100)
    sizes = placed.filter("score_id = 'hot'").groupBy(scan.BLK).count().collect()
    assert cut and len(sizes) > 8 and max(r["count"] for r in sizes) < 200
    assert placed.filter("score_id <> 'hot'").select(scan.BLK).distinct().count() == 1
    assert scan.place(long_score, "score_id", ["onset_s", "note_idx"]) == (long_score, False)


def test_operators_with_one_long_score(long_score, cut_at):
    made = lambda: (table(S.monophony(long_score)), table(S.rest_split(long_score, 0.4)), table(S.segment_phrases(long_score)))
    whole = made()
    cut_at(100)
    assert made() == whole


def test_one_score_long_in_frames(spark, long_score, cut_at):
    """Notes are few, frames are many: the runs are cut where the notes are not."""
    rms = spark.range(6000).select(
        F.lit("hot").alias("sample_id"), F.col("id").alias("frame_idx"), (F.col("id") * 0.02).alias("t_s"),
        F.when(F.col("id") % 23 < 17, 0.8).otherwise(0.01).alias("rms"),
    )
    few = long_score.filter("score_id = 'hot' AND note_idx < 300")
    whole = table(G.voiced_runs(rms)), table(G.derive_labels(few, rms, 0.01))
    cut_at(500)
    assert (table(G.voiced_runs(rms)), table(G.derive_labels(few, rms, 0.01))) == whole


def test_one_score_long_in_variants(long_score, cut_at):
    knob = expand.Humanize(draws=2, onset_sigma_s=0.02, duration_sigma_s=0.02, max_dev_s=0.05)
    made = lambda: table(expand.humanize(long_score, knob, F.lit(5).cast("long")))
    whole = made()
    cut_at(100)
    assert made() == whole


def test_frames_across_bins(spark):
    f = spark.range(1000).select(
        F.lit("a").alias("sample_id"), F.col("id").alias("frame_idx"), (F.col("id") * 0.02).alias("t_s"),
        F.when(F.col("id") % 5 != 0, 440.0).alias("f0_hz"), (F.col("id") % 5 != 0).alias("voiced"),
    )
    pitch = spark.createDataFrame([("a", 69)], "sample_id string, pitch_midi int")
    got = table(G.edges(f, pitch))
    want = sorted(("a", str(i), str(i % 5 == 1 and i > 0), str(i % 5 == 4 and i < 999)) for i in range(1000))
    assert got == want


@pytest.mark.parametrize("parts", [1, 13])
def test_partition_count_does_not_matter(spark, long_score, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    whole = table(S.segment_phrases(long_score))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert table(S.segment_phrases(long_score)) == whole
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_exact_percentiles(spark):
    import numpy as np

    df = spark.range(5000).select(((F.col("id") * 7919) % 1013 / 10.0).alias("x"))
    x = [r["x"] for r in df.collect()]
    got = scan.exact_percentiles(df, "x", [0.0, 0.01, 0.25, 0.5, 0.99, 1.0], accuracy=200)
    assert got["values"] == pytest.approx([float(np.percentile(x, p)) for p in (0, 1, 25, 50, 99, 100)])


@pytest.mark.parametrize("held", [3, 60, 5000])
def test_quantiles_in_rounds(spark, held):
    """Many rounds, one value that fills a third of a column, nulls, and two columns at once."""
    import numpy as np

    ps = [0.0, 0.1, 0.33, 0.34, 0.5, 0.66, 0.9, 1.0]
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 50.0).otherwise((F.col("id") * 7919) % 6007 / 60.0).alias("a"),
        F.when(F.col("id") % 5 != 0, F.exp(F.col("id") / 300.0)).alias("b"), F.lit(None).cast("double").alias("none"),
    )
    got = scan.exact_quantiles(df, {"a": ps, "b": ps, "none": [0.5]}, accuracy=500, held=held)
    rows = df.collect()
    for c in "ab":
        x = [r[c] for r in rows if r[c] is not None]
        assert got[c]["values"] == pytest.approx([float(np.percentile(x, 100 * p)) for p in ps], rel=1e-12)
        assert (got[c]["n"], got[c]["min"], got[c]["max"]) == (len(x), min(x), max(x)) and got[c]["mean"] == pytest.approx(np.mean(x))
    assert got["none"] == {"n": 0, "min": None, "max": None, "mean": None, "values": [None]}


def test_quantiles_of_many_distinct_values(spark):
    """A million values, all within the first bracket."""
    df = spark.range(1_000_000).select(((F.col("id") * 7919) % 1_000_003 / 7.0).alias("x"))
    got = scan.exact_quantiles(df, {"x": [0.25, 0.5]}, accuracy=1000, held=2000)["x"]["values"]
    x = sorted(i * 7919 % 1_000_003 / 7.0 for i in range(1_000_000))
    assert got == pytest.approx([x[249_999] + 0.75 * (x[250_000] - x[249_999]), (x[499_999] + x[500_000]) / 2], rel=1e-14)


def test_rank_rows(spark):
    df = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 101 == 0, None).otherwise(F.sha1(F.col("id").cast("string"))).alias("k"),
        F.lit("more").alias("_n"), F.floor(F.col("id") / 2).alias("v"),
    ).repartition(7)
    ranked = scan.rank_rows(df, ["k"])
    got = ranked.collect()
    assert ranked.columns == ["k", "_n", "v", "rank"] and sorted(r["rank"] for r in got) == list(range(600))
    assert [r["k"] for r in sorted(got, key=lambda r: r["rank"])] == sorted((r["k"] for r in df.collect()), key=lambda k: (k is not None, k or ""))
    assert table(scan.rank_rows(df, ["k"], keep=F.col("rank") % 7 == 2)) == table(ranked.filter("rank % 7 = 2"))
    assert scan.rank_rows(df.filter("false"), ["k"]).count() == 0
    plan = scan.rank_rows(df.filter("k <> 'hot'"), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_global_rank(spark):
    df = spark.range(500).select(F.sha1(F.col("id").cast("string")).alias("k"))
    got = scan.global_rank(df.repartition(7), ["k"]).collect()
    assert {r["k"]: r["rank"] for r in got} == {k: i for i, k in enumerate(sorted(r["k"] for r in df.collect()))}


def test_large_dimension_is_salted(spark):
    left = spark.range(300).select((F.col("id") % 2).alias("kind"), "id")
    dim = spark.range(40).select((F.col("id") % 2).alias("kind"), F.col("id").alias("v"))
    assert table(scan.join_few_keys(left, dim, "kind", max_rows=5), "id", "v") == table(scan.join_few_keys(left, dim, "kind"), "id", "v")
