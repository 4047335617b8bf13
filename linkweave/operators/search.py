"""The queries a search index over the documents answers, for all users at once.

Links are (item_id, other_item_id, ...): item_id is the document, other_item_id a word
of its link field. The score of a document is the number of words it shares with the
query, or their summed idf; ties go to the greater id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    IntegralType,
    StringType,
    StructField,
    StructType,
)

from linkweave.functions.similarity import scaled, unscaled
from linkweave.operators.packed import packed_tags, unpacked_tags
from linkweave.operators.product import LISTED_TERMS, listed_rows, matrix_product, task_count
from linkweave.operators.ranking import top_k
from linkweave.operators.skew import (
    group_sizes,
    group_summary,
    joined_by_rows,
    lookup,
    with_group_size,
)
from linkweave.session import settled


def matches(history: DataFrame, links: DataFrame) -> DataFrame:
    """Shared words of each user's history and each document: (user_id, item_id, n_match)."""
    words = links.select(F.col("other_item_id").alias("__word"), "item_id")
    query = history.select("user_id", F.col("item_id").alias("__word")).distinct()
    return matrix_product(query, words, "__word", "user_id", "item_id").select(
        "user_id", "item_id", F.col("value").alias("n_match")
    )


def idf_matches(history: DataFrame, links: DataFrame) -> DataFrame:
    """Like `matches`, with ln(1 + documents / documents with the word) per word."""
    n_docs = links.agg(F.countDistinct("item_id")).scalar()
    words = with_group_size(
        links.select(F.col("other_item_id").alias("__word"), "item_id"),
        "__word",
        ["item_id"],
        "__docs",
    ).select("__word", "item_id", scaled(F.log1p(n_docs / F.col("__docs"))).alias("__idf"))
    query = history.select("user_id", F.col("item_id").alias("__word")).distinct()
    return matrix_product(
        query, words, "__word", "user_id", "item_id", None, "__idf"
    ).select("user_id", "item_id", unscaled(F.col("value")).alias("n_match"))


def query_history(
    fields: list[tuple[DataFrame, DataFrame]], n: int = 10, idf: bool = False
) -> DataFrame:
    """Best documents for each user: (user_id, item_id, n_match, rank).

    Each field is a history and the links it is matched with; matches of several fields
    add up. The histories are any (user_id, item_id) tables, also ones newer than the model.
    """
    match = idf_matches if idf else matches
    found = [match(history, links) for history, links in fields]
    total = found[0]
    if len(found) > 1:
        total = (
            reduce(DataFrame.unionByName, found)
            .groupBy("user_id", "item_id")
            .agg(F.sum("n_match").alias("n_match"))
        )
    return top_k(
        total, "user_id", [F.desc("n_match"), F.desc("item_id")], n, ["item_id"]
    )


def similar_items(requests: DataFrame, links: DataFrame) -> DataFrame:
    """Ranked links of the requested items: (item_id, other_item_id, rank)."""
    wanted = requests.select("item_id").distinct()
    return links.join(wanted, "item_id", "left_semi").select("item_id", "other_item_id", "rank")


def query_category(
    history: DataFrame,
    links: DataFrame,
    categories: DataFrame,
    preferred: DataFrame,
    boost: float = 2.0,
    n: int = 10,
) -> DataFrame:
    """History query that favours a category: (user_id, item_id, score, rank).

    `categories` is (item_id, category), each item once; `preferred` is (user_id, category),
    each user once. The categories join the links and the histories, which are smaller than
    the matches. Where items are whole numbers and categories names or whole numbers, a
    user's matches go to one task as lists and are counted there; users with too many for
    one task have theirs added up as rows.
    """
    # An item has at most k links, so its category needs no care for frequent keys.
    words = settled(
        links.join(categories, "item_id", "left").select(
            F.col("other_item_id").alias("__word"), "item_id", "category"
        ),
        "tagged-links",
    )
    query = settled(
        lookup(
            history.select("user_id", "item_id"), preferred, "user_id", ["item_id"], "left"
        ).select("user_id", F.col("item_id").alias("__word"), "category").distinct(),
        "tagged-history",
    )
    kinds = [table.schema["category"].dataType for table in (words, query)]
    plain = kinds[0] == kinds[1] and isinstance(kinds[0], (StringType, IntegralType))
    if not plain or not isinstance(words.schema["item_id"].dataType, IntegralType):
        return _best_added(query, words, boost, n)
    long = _long_queries(query, words)
    if long is None:
        return _best_listed(query, words, boost, n)
    same = F.col("user_id").eqNullSafe(F.col("__long"))
    return _best_listed(query.join(long, same, "left_anti"), words, boost, n).unionByName(
        _best_added(query.join(long, same, "left_semi"), words, boost, n)
    )


def _long_queries(query: DataFrame, words: DataFrame) -> DataFrame | None:
    """Users whose words have more links than one task should hold; None if there are none."""
    longest = group_summary(words, "__word").largest
    if group_summary(query, "user_id").largest * longest <= LISTED_TERMS:
        return None
    sizes = group_sizes(words, "__word", "__links")
    asked = lookup(query, sizes, "__word", ["user_id"])
    terms = asked.groupBy(F.col("user_id").alias("__long")).agg(F.sum("__links").alias("__links"))
    long = settled(terms.where(F.col("__links") > LISTED_TERMS).select("__long"), "long-queries")
    return None if long.isEmpty() else long


def _best_added(query: DataFrame, words: DataFrame, boost: float, n: int) -> DataFrame:
    """Best documents of each user, whose matches are added up as rows."""
    found = matrix_product(
        query, words, "__word", "user_id", "item_id", "category", "category",
        sums={"same": lambda mine, its: F.coalesce(mine == its, F.lit(False)).cast("bigint")},
    )
    # The categories of a user and an item are alike in all terms or in none.
    factor = F.when(F.col("same") > 0, F.lit(float(boost))).otherwise(F.lit(1.0))
    scored = found.select("user_id", "item_id", (F.col("n_terms") * factor).alias("score"))
    return top_k(scored, "user_id", [F.desc("score"), F.desc("item_id")], n, ["item_id"])


def _best_listed(query: DataFrame, words: DataFrame, boost: float, n: int) -> DataFrame:
    """Best documents of each user, whose matches are counted in lists of whole numbers.

    The lists travel as bytes, with the places of the user's category.
    """

    def places(mine: Column, its: Column) -> Column:
        at = F.array_position(its["tags"], mine)
        return F.when(at > 0, F.get(its["places"], (at - 1).cast("int")))

    rows = listed_rows(
        query, words, "__word", "user_id", "item_id", "category", "category", packed_tags,
        kept={
            "first": lambda mine, its: its["first"],
            "steps": lambda mine, its: its["steps"],
            "width": lambda mine, its: its["width"],
            "nulls": lambda mine, its: its["nulls"],
            "same": places,
        },
    )
    of = {"user_id": query.schema["user_id"].dataType, "item_id": words.schema["item_id"].dataType}
    unpacked = unpacked_tags("user_id", to_arrow_type(of["item_id"]))
    count = best_counted(float(boost), n)
    of |= {"score": DoubleType(), "rank": IntegerType()}
    schema = StructType([StructField(c, t) for c, t in of.items()])
    return rows.sortWithinPartitions("user_id").mapInArrow(lambda batches: count(unpacked(batches)), schema)


def best_counted(boost: float, n: int) -> Callable[[Iterator], Iterator]:
    """A function of Arrow batches (user_id, items, same) in which a user's rows follow each other.

    The score of an item is the number of its times in `items`, times `boost` if it is in
    `same`. The n best of each user are (user_id, item_id, score, rank). The function needs
    nothing of this package where it runs.
    """

    def best_of(ids, n_null, same):
        """Items, whether each is null, and their scores, best first."""
        found, counts = np.unique(ids, return_counts=True)
        factor = np.ones(len(found))
        factor[np.searchsorted(found, same)] = boost
        scores = counts * factor
        if len(scores) > n:
            least = np.partition(scores, len(scores) - n)[len(scores) - n]
            high = scores >= least
            found, scores = found[high], scores[high]
        order = np.lexsort((found, scores))[::-1][:n]
        found, scores, null = found[order], scores[order], np.zeros(len(order), bool)
        if n_null:
            # An item without a number comes after the others of its score.
            at = np.searchsorted(-scores, -float(n_null), "right")
            found, null = np.insert(found, at, 0)[:n], np.insert(null, at, True)[:n]
            scores = np.insert(scores, at, float(n_null))[:n]
        return found, null, scores

    def best_of_all(table, starts):
        """The result for rows of whole users, the first rows of which are `starts`."""
        items, same = (table.column(c).combine_chunks() for c in ("items", "same"))
        ids, its = (a.values.fill_null(0).to_numpy(zero_copy_only=False) for a in (items, same))
        absent = items.values.is_null().to_numpy(zero_copy_only=False) if items.values.null_count else None
        ends = [*starts[1:], table.num_rows]
        of_items, of_same = (a.offsets.to_numpy() for a in (items, same))
        best = []
        for start, end in zip(starts, ends, strict=True):
            part = slice(of_items[start], of_items[end])
            mine, n_null = ids[part], 0
            if absent is not None:
                mine, n_null = mine[~absent[part]], int(absent[part].sum())
            best.append(best_of(mine, n_null, its[of_same[start] : of_same[end]]))
        sizes = [len(scores) for _, _, scores in best]
        found, null, scores = (np.concatenate(c) for c in zip(*best, strict=True))
        ranks = np.concatenate([np.arange(1, size + 1, dtype=np.int32) for size in sizes])
        users = table.column("user_id").take(pa.array(np.repeat(starts, sizes))).combine_chunks()
        columns = [users, pa.array(found, items.type.value_type, mask=null), pa.array(scores), pa.array(ranks)]
        return pa.RecordBatch.from_arrays(columns, ["user_id", "item_id", "score", "rank"])

    def best(batches):
        # Rows of the last user, which may go on in the next batch.
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            users = held.column("user_id").combine_chunks().dictionary_encode("encode").indices
            starts = np.flatnonzero(np.diff(users.to_numpy(), prepend=-1))
            if len(starts) > 1:
                yield best_of_all(held.slice(0, starts[-1]), starts[:-1])
            held = held.slice(starts[-1])
        if held is not None:
            yield best_of_all(held, np.zeros(1, int))

    return best


def query_cold_start(
    seeds: DataFrame, links: DataFrame, categories: DataFrame, boost: float = 2.0, n: int = 10
) -> DataFrame:
    """Links of the item being looked at, biased to its category.

    `links` has a score and is best a written table: its rows are counted first, and dealt
    to as many tasks as they ask for. The result is (seed_item_id, item_id, score, rank).
    """
    tasks = task_count(links, links.count(), LISTED_TERMS)
    if tasks > task_count(links, 0):
        links = links.repartition(tasks, "item_id")
    # Seeds and categories may be as many as there are items, in files of a few megabytes.
    wanted = joined_by_rows(seeds.select("item_id").distinct())
    shown = links.join(wanted, "item_id", "left_semi")
    shown = shown.select(F.col("item_id").alias("seed_item_id"), "other_item_id", "score")
    # A seed has at most k links; an item can be linked from any number of seeds.
    own = categories.select(
        F.col("item_id").alias("seed_item_id"), F.col("category").alias("__seed")
    )
    shown = shown.join(joined_by_rows(own), "seed_item_id", "left")
    shown = lookup(
        shown,
        categories.select(
            F.col("item_id").alias("other_item_id"), F.col("category").alias("__other")
        ),
        "other_item_id",
        ["seed_item_id"],
        "left",
    )
    same = F.col("__seed") == F.col("__other")
    factor = F.when(same, F.lit(float(boost))).otherwise(F.lit(1.0))
    scored = shown.select(
        "seed_item_id", F.col("other_item_id").alias("item_id"), (F.col("score") * factor).alias("score")
    )
    return top_k(
        scored, "seed_item_id", [F.desc("score"), F.desc("item_id")], n, ["item_id"]
    )
