"""Every registered query next to its SQL on the smallest tables."""

import pathlib

import duckdb
import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from linkweave.operators import product, skew
from linkweave.plans.oracle import SQL
from linkweave.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_each_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= entry.queries().keys()


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    result = compare(
        spark, connection, name, entry.queries()[name], entry.oracle_sql()[name], SF_DIR
    )
    assert result["rows"] > 0
    assert result["same"] and result["types"], result


@needs_tables
def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["item_id", "other_item_id", "n_both", "score", "rank"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """The tables with a third of the events from one user and hot items in both logs."""
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    changed = {
        "events": """SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id,
            CASE WHEN event_id % 5 = 0 THEN '{"k": 5}' ELSE props END AS props)""",
        "lineitem": """SELECT * REPLACE (CASE WHEN l_linenumber = 1 THEN 7 ELSE l_partkey END
            AS l_partkey)""",
        "orders": """SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE o_custkey END
            AS o_custkey)""",
        "part": "SELECT *",
    }
    for table, select in changed.items():
        con.execute(
            f"COPY ({select} FROM '{SF_DIR}/{table}.parquet') TO '{folder}/{table}.parquet'"
        )
    return str(folder)


@needs_tables
@pytest.mark.parametrize(
    "name", ["top_k_similar", "cross_cooccurrence", "cross_recs", "item_links_docs", "encode_prefs"]
)
def test_skewed_tables(spark, skewed, monkeypatch, name):
    """Small tiles and low limits, so that the tables take the paths for hot keys."""
    monkeypatch.setattr(product.pair_counts, "__defaults__", (None, None, 16, None))
    monkeypatch.setattr(product.matrix_product, "__defaults__", (None, None, 16, None))
    monkeypatch.setattr(skew.hot_keys, "__defaults__", (20,))
    result = compare(
        spark, connect(skewed), name, entry.queries()[name], entry.oracle_sql()[name], skewed
    )
    assert result["rows"] > 0
    assert result["same"] and result["types"], result
