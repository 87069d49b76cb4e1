"""The pipeline's stages against plain versions, and the queries against the oracle engine."""

import os
import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from compare import compare, duck
from noteflow.llm import catalog, mixing, quality
from noteflow.llm.store import fold

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not mounted")


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_oracle(spark, name):
    ok, text = compare(spark, duck(SF), SF, name, entry.queries(), entry.oracle_sql())
    assert ok, text


def test_every_operator_has_a_query():
    assert {int(re.match(r"op(\d+)_", k)[1]) for k in catalog.QUERIES if k != "pipeline"} == set(range(1, 11))


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    outs = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        outs.append((docs, spark.read.parquet(str(tmp_path / name))))
        docs = outs[-1][1]
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    before, after = outs[0]
    net = quality.train(before, spark.read.parquet(f"{SF}/labels.parquet"), fold("_id", quality.FOLDS) == quality.HELD_OUT)
    rows = before.collect()
    data = [(r.text or "").encode() for r in rows]
    p = net.score(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in data])]))
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r, x in zip(rows, p) if x >= quality.THRESHOLD)

    before, after = outs[1]
    best = {}
    for r in before.collect():
        key = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
        best[key] = min(best.get(key, (1, 0)), (-len(r.text or ""), r.doc_id))
    assert sorted(r.doc_id for r in after.collect()) == sorted(d for _, d in best.values())

    before, after = outs[2]
    rows = sorted(before.collect(), key=lambda r: r.doc_id)
    sets = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                low, high = sorted((root[i], root[j]))
                root = [low if x == high else x for x in root]
    assert sorted(r.doc_id for r in after.collect()) == [rows[k].doc_id for k in sorted(set(root))]

    before, after = outs[3]
    want = Counter({r.doc_id: r.copies for r in mixing.mix(before).collect() if r.copies})
    assert Counter(r.doc_id for r in after.collect()) == want

    before, after = outs[4]
    assert after.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()
    assert Counter(r.doc_id for r in after.filter("start = 0").collect()) == want
