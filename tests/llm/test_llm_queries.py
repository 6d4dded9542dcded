"""The registered queries against their SQL, and the pipeline against its stages taken one by one."""

import os

import oracle
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chunkloom.llm import odd_sketch, quality_rules, raking, suffix_arrays
from chunkloom.llm.oracles import ORACLES
from chunkloom.llm.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    found = QUERIES[name](spark, FOLDER)
    rows = [tuple(r) for r in found.collect()]
    table = "pages" if name.startswith(("op4_", "op8_")) else "documents"
    if not name.startswith(("op12_", "op13_")):
        assert len(rows) == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()
    if name in ORACLES:
        columns, expected = oracle.oracle_rows(oracle.connect(FOLDER), ORACLES[name])
        assert oracle.bag(found.columns, rows) == oracle.bag(columns, expected)


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    left = docs
    for (name, stage), verdict in zip(
        corpus_pipeline.STAGES,
        (
            lambda d: quality_rules.clean_lines(d).where("kept").select("doc_id"),
            lambda d: odd_sketch.near_duplicates(d).where("kept").select("doc_id"),
            lambda d: suffix_arrays.contamination(d, bench).where("NOT contaminated").select("doc_id"),
            lambda d: raking.sampling_plan(d).where("kept").select("doc_id"),
            lambda d: d.select("doc_id"),
        ),
        strict=True,
    ):
        path = str(tmp_path / name)
        stage(spark, left, str(tmp_path)).write.parquet(path)
        after = spark.read.parquet(path)
        assert sorted(r[0] for r in after.select("doc_id").collect()) == sorted(r[0] for r in verdict(left).collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns
            assert after.count() > 0
        left = after
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, left.collect()))
    assert whole.agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0] == whole.agg(F.sum("n_tokens")).first()[0]
