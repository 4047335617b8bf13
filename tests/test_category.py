"""The category query over lists, next to plain Python."""

import random
from collections import Counter

import pyarrow as pa
import pytest

from linkweave.operators import product, search

N = 4


def made(seed=5, users=30, items=40):
    """History, links, categories and preferred ones, with ties, nulls and items without any."""
    chance = random.Random(seed)
    history = {(u, chance.randrange(items)) for u in range(users) for _ in range(6)}
    history |= {(99, i) for i in range(items)} | {(None, 3), (None, 7), (5, None)}
    links = {(chance.randrange(items), i) for i in range(items) for _ in range(9)}
    links |= {(i, 7) for i in range(items)} | {(None, 3), (None, 7), (4, None)}
    categories = [(i, "abc"[i % 3]) for i in range(items - 8)] + [(items - 8, None)]
    preferred = [(u, "abcd"[u % 4]) for u in range(users - 3)] + [(99, "b"), (1_000, "a")]
    return history, links, categories, preferred


def best(history, links, categories, preferred, boost):
    category, prefers = dict(categories), dict(preferred)
    found = set()
    for user in {u for u, _ in history}:
        counts = Counter(i for u, w in history if u == user and w is not None for i, x in links if x == w)
        mine = prefers.get(user)
        scores = {
            i: n * (boost if i is not None and mine is not None and category.get(i) == mine else 1.0)
            for i, n in counts.items()
        }
        order = sorted(scores, key=lambda i: (-scores[i], i is None, -(i or 0)))[:N]
        found |= {(user, i, scores[i], rank) for rank, i in enumerate(order, 1)}
    return found


@pytest.mark.parametrize("terms", [150, 4_000_000], ids=["long", "even"])
@pytest.mark.parametrize("sent", [True, False])
@pytest.mark.parametrize("boost", [2.0, 0.5])
def test_category_query(spark, monkeypatch, terms, sent, boost):
    monkeypatch.setattr(search, "LISTED_TERMS", terms)
    monkeypatch.setattr(product, "sent_whole", lambda table: sent)
    monkeypatch.setattr(product, "TILE", 5)
    rows = made()
    tables = [
        spark.createDataFrame([*t], schema)
        for t, schema in zip(
            rows,
            ("user_id bigint, item_id bigint", "item_id bigint, other_item_id bigint",
             "item_id bigint, category string", "user_id bigint, category string"),
            strict=True,
        )
    ]
    found = search.query_category(*tables, boost=boost, n=N)
    assert {tuple(r) for r in found.collect()} == best(*rows, boost)
    assert found.dtypes == [("user_id", "bigint"), ("item_id", "bigint"), ("score", "double"), ("rank", "int")]


def test_category_query_of_names(spark):
    """Items that are not numbers are added up as rows."""
    history, links, categories, preferred = made()
    history = [(u, f"{i:03}") for u, i in history if i is not None]
    links = [(f"{i:03}", f"{w:03}") for i, w in links if i is not None and w is not None]
    categories = [(f"{i:03}", c) for i, c in categories]
    tables = [
        spark.createDataFrame(history, "user_id bigint, item_id string"),
        spark.createDataFrame(links, "item_id string, other_item_id string"),
        spark.createDataFrame(categories, "item_id string, category string"),
        spark.createDataFrame(preferred, "user_id bigint, category string"),
    ]
    numbers = [[tuple(int(x) if isinstance(x, str) and x.isdigit() else x for x in row) for row in t]
               for t in (history, links, categories)]
    found = search.query_category(*tables, n=N).collect()
    assert {(r[0], int(r[1]), r[2], r[3]) for r in found} == best(*numbers, preferred, 2.0)


def test_category_matches_are_not_rows(spark):
    """a user's matches are counted where they meet, without a row for each."""
    history, links, categories, preferred = made()
    tables = [
        spark.createDataFrame([*history], "user_id bigint, item_id bigint"),
        spark.createDataFrame([*links], "item_id bigint, other_item_id bigint"),
        spark.createDataFrame(categories, "item_id bigint, category string"),
        spark.createDataFrame(preferred, "user_id bigint, category string"),
    ]
    plan = search.query_category(*tables, n=N)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan
    assert "Generate" not in plan


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_users_over_batches(size):
    """A user's rows may come in several batches."""
    rows = [(1, [5, 7], [5]), (1, [7], []), (1, [9, None], []), (2, [], []), (None, [4], [4]), (3, [8, 8], [])]
    types = {"user_id": pa.int64(), "items": pa.list_(pa.int64()), "same": pa.list_(pa.int64())}
    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows[k : k + size], strict=True), types.values(), strict=True)],
            list(types),
        )
        for k in range(0, len(rows), size)
    ]
    found = [tuple(r.values()) for b in search.best_counted(2.0, 3)(iter(batches)) for r in b.to_pylist()]
    assert found == [(1, 7, 2.0, 1), (1, 5, 2.0, 2), (1, 9, 1.0, 3), (None, 4, 2.0, 1), (3, 8, 2.0, 1)]
    assert not [*search.best_counted(2.0, 3)(iter([]))]


def test_few_users_of_many_links(spark):
    """A history smaller than the links leaves each user's matches in one task all the same."""
    chance = random.Random(8)
    links = sorted({(chance.randrange(300), w) for w in range(300) for _ in range(60)})
    history = [(u, w) for u in range(3) for w in range(u, 300, 7)]
    categories = [(i, "abc"[i % 3]) for i in range(300)]
    preferred = [(u, "abc"[u]) for u in range(3)]
    tables = [
        spark.createDataFrame(history, "user_id bigint, item_id bigint"),
        spark.createDataFrame(links, "item_id bigint, other_item_id bigint").repartition(8),
        spark.createDataFrame(categories, "item_id bigint, category string"),
        spark.createDataFrame(preferred, "user_id bigint, category string"),
    ]
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        found = search.query_category(*tables, n=N).collect()
    finally:
        spark.conf.set(setting, before)
    assert len(found) == 3 * N
    assert {tuple(r) for r in found} == best(history, links, categories, preferred, 2.0)
