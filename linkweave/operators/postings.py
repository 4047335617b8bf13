"""Index queries over posting lists that are read from the written documents.

The index has, for each word, its documents in blocks of bounded size, so that a frequent
word spreads over many rows. A query reads the short lists of a user's words first. What
the n-th best document has then is the least a document needs; as long as the longest
lists together give less, no document is looked for in them, and only documents that the
other lists have found get their share of them. The result is that of reading all lists.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave.functions.similarity import scaled, unscaled
from linkweave.operators.product import matrix_product, product_tiles
from linkweave.operators.ranking import top_k
from linkweave.operators.skew import bucket_of, lookup
from linkweave.session import settled

# Documents in one block of a posting list, about.
BLOCK = 1_024

# Share of a user's postings that the first look takes, shortest lists first.
FIRST_LOOK = 0.5


def build_index(docs: DataFrame, field: str, delim: str = " ") -> DataFrame:
    """Posting lists (word, block, n_docs, documents) of one field of documents.

    `docs` is (id, part, field) as the documents are written. `n_docs` is the number of the
    word's documents over all its blocks.
    """
    words = F.explode(F.split(F.col(field), re.escape(delim)))
    pairs = settled(
        docs.select(F.col("id").alias("item_id"), words.alias("word")).where("word <> ''").distinct(),
        "index-words",
    )
    sizes = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_docs"))
    blocks = F.ceil(F.col("n_docs") / F.lit(BLOCK)).cast("bigint")
    return (
        lookup(pairs, sizes, "word", ["item_id"])
        .withColumn("block", bucket_of(["item_id"], blocks))
        .groupBy("word", "block")
        .agg(F.max("n_docs").alias("n_docs"), F.collect_list("item_id").alias("documents"))
        .select("word", "block", "n_docs", "documents")
    )


def query_words(
    history: DataFrame, index: DataFrame, n_documents: int | None = None
) -> DataFrame:
    """(user_id, word, class, postings, weight) of each user's words that the index has.

    The class is that of the list's length by powers of two. A word weighs 1, or its idf in
    whole units if the number of all documents is given.
    """
    lists = index.groupBy("word").agg(F.max("n_docs").alias("postings"))
    asked = settled(
        history.select("user_id", F.col("item_id").cast("string").alias("word")).distinct(),
        "query-words",
    )
    weight = F.lit(1).cast("bigint")
    if n_documents is not None:
        weight = scaled(F.log1p(F.lit(n_documents) / F.col("postings")))
    return lookup(asked, lists, "word", ["user_id"]).select(
        "user_id", "word", F.ceil(F.log2("postings")).alias("class"), "postings", weight.alias("weight")
    )


def _matches(words: DataFrame, postings: DataFrame) -> DataFrame:
    """(user_id, item_id, value): the weights of the words that a document has."""
    return matrix_product(words, postings, "word", "user_id", "item_id", "weight").drop("n_terms")


def _classes(words: DataFrame) -> DataFrame:
    """Of each user and class, postings and weights of this and the shorter or longer ones."""
    cells = words.groupBy("user_id", "class").agg(
        F.sum("postings").alias("__postings"), F.sum("weight").alias("__weight")
    )
    shorter = Window.partitionBy("user_id").orderBy("class")
    longer = Window.partitionBy("user_id").orderBy(F.desc("class"))
    return cells.select(
        "user_id",
        "class",
        F.sum("__postings").over(shorter).alias("__upto"),
        F.sum("__postings").over(Window.partitionBy("user_id")).alias("__all"),
        F.row_number().over(shorter).alias("__place"),
        F.sum("__weight").over(longer).alias("__from"),
    )


def plan_lists(words: DataFrame, postings: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """The words with `essential`, and (user_id, least, skipped) of the users.

    `least` is what a user's n-th best document has at least, `skipped` the weight of all
    words that are not essential; it is less than `least`.
    """
    classes = settled(_classes(words), "classes")
    first = classes.where(
        (F.col("__place") == 1) | (F.col("__upto") <= F.col("__all") * F.lit(FIRST_LOOK))
    ).select("user_id", "class")
    look = settled(words.join(first, ["user_id", "class"], "left_semi"), "first-look")
    best = top_k(_matches(look, postings), "user_id", [F.desc("value"), F.desc("item_id")], n, ["item_id"])
    least = best.where(F.col("rank") == n).select("user_id", F.col("value").alias("least"))
    skipped = settled(
        classes.join(least, "user_id")
        .where(F.col("__from") < F.col("least"))
        .groupBy("user_id")
        .agg(
            F.min("class").alias("__skip"),
            F.max("least").alias("least"),
            F.max("__from").alias("skipped"),
        ),
        "skipped-lists",
    )
    cut = lookup(words, skipped.select("user_id", "__skip"), "user_id", ["word"], "left")
    essential = F.coalesce(F.col("class") < F.col("__skip"), F.lit(True))
    return cut.withColumn("essential", essential).drop("__skip"), skipped.drop("__skip")


def query_index(
    history: DataFrame, index: DataFrame, n: int = 10, n_documents: int | None = None
) -> DataFrame:
    """Best documents for each user: (user_id, item_id, n_match, rank), as `query_history`.

    `index` is best a written table. With the number of all documents the words count by
    their idf.
    """
    words = settled(query_words(history, index, n_documents), "weighted-words")
    postings = settled(index.select("word", F.explode("documents").alias("item_id")), "postings")
    planned, users = plan_lists(words, postings, n)
    planned = settled(planned, "planned-words")
    found = _matches(planned.where("essential"), postings)
    found = lookup(settled(found, "found"), users, "user_id", ["item_id"], "left")
    open_ = F.col("skipped").isNotNull()
    done = found.where(~open_).select("user_id", "item_id", "value")
    # Documents that still can be among the best, beside the user's words that were skipped.
    rest = settled(
        found.where(open_ & (F.col("value") + F.col("skipped") >= F.col("least"))).select(
            "user_id", "item_id", "value"
        ),
        "candidates",
    )
    left, right, keys = product_tiles(
        rest.select(F.col("user_id").alias("__shared"), F.col("item_id").alias("__row"), F.lit(0).alias("__v")),
        planned.where(~F.col("essential")).select(
            F.col("user_id").alias("__shared"), F.col("word").alias("__col"), F.col("weight").alias("__w")
        ),
    )
    beside = left.join(right, keys).select(
        F.col("__shared").alias("user_id"), F.col("__row").alias("item_id"),
        F.col("__col").alias("word"), F.col("__w").alias("value"),
    )
    more = beside.join(postings, ["word", "item_id"], "left_semi").drop("word")
    total = (
        done.unionByName(rest)
        .unionByName(more)
        .groupBy("user_id", "item_id")
        .agg(F.sum("value").alias("value"))
    )
    score: Column = F.col("value") if n_documents is None else unscaled(F.col("value"))
    named = total.select("user_id", "item_id", score.alias("n_match"))
    return top_k(named, "user_id", [F.desc("n_match"), F.desc("item_id")], n, ["item_id"])
