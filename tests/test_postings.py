"""Index queries over posting lists: the same rows as from all lists, from fewer postings."""

import random

import pytest
from pyspark.sql import functions as F

from linkweave.operators import postings, product, search


def tables_of(spark, seed=1):
    """Rare and frequent words; users with few and many; a third of the history is one's."""
    chance = random.Random(seed)
    links = {(d, min(int(chance.expovariate(0.15)), 60)) for d in range(80) for _ in range(14)}
    links |= {(d, w) for d in range(80) for w in (70, 71) if d % 9}
    history = {(u, chance.randrange(64)) for u in range(30) for _ in range(chance.choice([1, 4, 12]))}
    history |= {(u, w) for u in range(0, 30, 2) for w in (70, 71)}
    history |= {(99, w) for w in range(72)}
    links_df = spark.createDataFrame(sorted(links), "item_id int, other_item_id int")
    history_df = spark.createDataFrame(sorted(history), "user_id int, item_id int")
    docs = (
        links_df.groupBy(F.col("item_id").alias("id"))
        .agg(F.array_join(F.collect_list("other_item_id").cast("array<string>"), " ").alias("f"))
        .withColumn("part", F.lit(0))
    )
    return links_df, history_df, docs


def rows_of(df):
    return sorted(tuple(r) for r in df.select("user_id", "item_id", "n_match", "rank").collect())


@pytest.mark.parametrize("n", [1, 3, 200])
@pytest.mark.parametrize("idf", [False, True])
def test_same_rows(spark, n, idf):
    links, history, docs = tables_of(spark)
    expected = search.query_history([(history, links)], n, idf=idf)
    index = postings.build_index(docs, "f").cache()
    count = docs.count() if idf else None
    assert rows_of(postings.query_index(history, index, n, count)) == rows_of(expected)


def test_small_blocks_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(postings, "BLOCK", 5)
    monkeypatch.setattr(product.matrix_product, "__defaults__", (None, None, 4, None))
    monkeypatch.setattr(product.product_tiles, "__defaults__", (4,))
    links, history, docs = tables_of(spark, 2)
    index = postings.build_index(docs, "f").cache()
    # Blocks are dealt by hash, so a block is of about that size.
    assert index.agg(F.max(F.size("documents"))).first()[0] < 25
    assert index.where("word = '70'").count() > 5
    expected = search.query_history([(history, links)], 3)
    assert rows_of(postings.query_index(history, index, 3)) == rows_of(expected)


def test_fewer_postings(spark):
    """For some users the longest lists are skipped."""
    links, history, docs = tables_of(spark)
    index = postings.build_index(docs, "f").cache()
    words = postings.query_words(history, index)
    lists = index.select("word", F.explode("documents").alias("item_id"))
    planned, users = postings.plan_lists(words, lists, 3)
    read = planned.where("essential").agg(F.sum("postings")).first()[0]
    everything = words.agg(F.sum("postings")).first()[0]
    assert read < 0.9 * everything
    assert users.where("skipped >= least").count() == 0 and users.count() > 5


def test_odd_input(spark):
    links, history, docs = tables_of(spark)
    index = postings.build_index(docs.withColumn("f", F.replace("f", F.lit(" "), F.lit("|"))), "f", "|")
    assert index.agg(F.sum(F.size("documents"))).first()[0] == links.count()
    assert postings.query_index(history.limit(0), index).count() == 0
    unknown = history.withColumn("item_id", F.lit(5000))
    assert postings.query_index(unknown, index).count() == 0
    empty = postings.build_index(docs.limit(0), "f")
    assert postings.query_index(history, empty).count() == 0
    blank = spark.createDataFrame([(1, 0, ""), (2, 0, None), (3, 0, "7 7 8")], "id int, part int, f string")
    found = {r.word: (r.n_docs, r.documents) for r in postings.build_index(blank, "f").collect()}
    assert found == {"7": (1, [3]), "8": (1, [3])}
