"""Transforms by name: one of each kind, wrong parameters, wrong schemas."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from noteflow import transforms as X


@pytest.fixture
def three(notes):
    return notes({"a": [(0.0, 0.5, 60, "la"), (1.0, 1.4, 62)], "b": [(0.0, 1.0, 100, "lo li")]})


def got(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_built_in_chain(three):
    lib = X.library()
    out = lib.chain(three, [("valid_notes", {}), ("transpose", {"offsets": [12], "policy": "clamp", "window": (50, 110)})])
    assert got(out, "score_id", "note_idx", "pitch_midi", "transform") == [("a", 0, 72, "t+12"), ("a", 1, 74, "t+12"), ("b", 0, 110, "t+12")]
    for name, params in (("jitter_timing", {"ms": 5.0}), ("phrases", {})):
        lib.apply(three, name, params)


@pytest.mark.parametrize("params, text", [
    ({"offsets": [1], "policy": "wrap"}, "policy must be one of drop, clamp"), ({"offsets": [1], "window": (90, 20)}, "window must be a pair"),
    ({"offsets": [1], "window": (0, 128)}, "window must be a pair"), ({}, "offsets is required"), ({"offsets": [1, 1]}, "must not repeat"),
    ({"offsets": [1], "other": 2}, "no parameter other"),
])
def test_wrong_parameters(three, params, text):
    with pytest.raises(ValueError, match=text):
        X.library().apply(three, "transpose", params)


def test_wrong_names_and_columns(three):
    lib = X.library()
    with pytest.raises(ValueError, match="no transform 'nothing'"):
        lib.apply(three, "nothing")
    with pytest.raises(ValueError, match="no column lyric"):
        lib.apply(three.drop("lyric"), "valid_notes")
    with pytest.raises(ValueError, match="registered already"):
        lib.register("transpose", lambda df, p: df, "x int")
    with pytest.raises(ValueError, match="above 0"):
        lib.apply(three, "jitter_timing", {"ms": True})


def test_column_function(three):
    @F.pandas_udf("double")
    def length(on: pd.Series, off: pd.Series) -> pd.Series:
        return off - on

    lib = X.Transforms()
    lib.register_column("length", length, ["onset_s", "offset_s"], "length_s", "double")
    assert got(lib.apply(three, "length"), "score_id", "length_s") == [("a", pytest.approx(0.4)), ("a", 0.5), ("b", 1.0)]
    lib.register_column("misdeclared", length, ["onset_s", "offset_s"], "length_s", "int")
    with pytest.raises(ValueError, match="returns .*length_s double.* instead of .*length_s int"):
        lib.apply(three, "misdeclared")


def test_grouped_function(three):
    def span(group, p):
        return pd.DataFrame({"score_id": group["score_id"][:1], "span_s": [(group["offset_s"].max() - group["onset_s"].min()) * p["scale"]]})

    lib = X.Transforms()
    lib.register_grouped("span", ["score_id"], span, "score_id string, span_s double", {"scale": X.Param(X.at_least(1), 1)})
    assert got(lib.apply(three, "span", {"scale": 10}), "score_id", "span_s") == [("a", 14.0), ("b", 10.0)]
    with pytest.raises(ValueError, match="at least 1"):
        lib.apply(three, "span", {"scale": 0})


def test_table_function(three):
    @F.udtf(returnType="part int, syllable string")
    class Parts:
        def eval(self, lyric: str):
            for i, word in enumerate((lyric or "").split()):
                yield i, word

    lib = X.Transforms()
    lib.register_table("parts", Parts, ["lyric"], "part int, syllable string")
    assert got(lib.apply(three, "parts"), "score_id", "part", "syllable") == [("a", 0, "la"), ("b", 0, "lo"), ("b", 1, "li")]


def test_export_formats(three, spark, tmp_path):
    from noteflow.sources.score_io import export_notes

    want = [("a", 0.0, 0.5, 60), ("a", 1.0, 1.4, 62), ("b", 0.0, 1.0, 100)]
    for fmt, sep in (("tsv", "\t"), ("csv", ","), ("json", None)):
        folder = str(tmp_path / fmt)
        export_notes(three, folder, fmt)
        reader = spark.read.schema("onset double, offset double, pitch int, score_id string")
        back = reader.json(folder) if fmt == "json" else reader.option("header", True).option("sep", sep).option("enforceSchema", False).csv(folder)
        assert got(back, "score_id", "onset", "offset", "pitch") == want
    with pytest.raises(ValueError, match="unknown export format"):
        export_notes(three, str(tmp_path / "x"), "mid")


def test_append_order(spark, tmp_path):
    """The last record of a sample wins, over appends and within a file."""
    from noteflow.sources import manifest_io as IO

    folder = str(tmp_path / "m")
    flat = lambda rows: spark.createDataFrame(rows, "sample_id string, status string").select("sample_id", F.struct("status").alias("verdict")).coalesce(1)
    IO.append_manifest(flat([("x", "failed"), ("y", "failed"), ("x", "flagged")]), folder)
    IO.append_manifest(flat([("y", "accepted")]), folder)
    got_ = IO.read_manifest(spark, folder).groupBy("sample_id").agg(F.max_by("verdict.status", "ord").alias("s")).collect()
    assert {r["sample_id"]: r["s"] for r in got_} == {"x": "flagged", "y": "accepted"}
