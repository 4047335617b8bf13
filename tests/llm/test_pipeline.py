"""The registered queries and the pipeline on the smallest tables."""

import pathlib

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="no test tables")


def test_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
    assert entry.oracle_sql().keys() <= names.keys()


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n.startswith("op")))
def test_query_next_to_its_sql(spark, name):
    query, sql = entry.queries()[name], entry.oracle_sql()[name]
    result = compare(spark, connect(SF_DIR), name, query, sql, SF_DIR)
    assert result["rows"] > 0 and result["same"] and result["types"], result


def test_pipeline(spark):
    source = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs, columns, before = source, source.columns, set()
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF_DIR)
        rows = after.collect()
        if name != "sharding":
            assert after.columns == columns and after.schema == source.schema
        kept = {r.doc_id for r in rows}
        assert rows and (not before or kept <= before)
        before, docs = kept, spark.createDataFrame(rows, after.schema)
    places = sorted((r.shard, r.slot) for r in rows)
    assert len(set(places)) == len(rows) and len({s for s, _ in places}) == 16


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame([], stage(spark, docs, SF_DIR).schema)
        assert docs.count() == 0
