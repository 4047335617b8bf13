"""Quality rules: simple counts, and a likelihood ratio of hashed n-grams.

Two multinomials over hashed n-grams are estimated by counting, one from the documents
that are trusted and one from all. A document's score is the mean log-likelihood ratio of
its n-grams; below a fixed threshold it is rejected. The n-grams are of characters at the
ends of words (the last three of a word; those with the first two of the next word), since
word ends are few and known in any sample, and junk shows in them as it does in words.

Only DataFrame functions are used: nothing leaves the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.llm.text import sent_if_small, word_array
from linkweave.session import settled

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
REPEAT_PERCENT = 50

# Hash buckets of the n-grams; the table of ratios has one row for each at most.
BUCKETS = 1 << 14

# N-grams, dealt like those of all documents, that are added to the trusted ones: with few
# trusted documents the ratios shrink towards 0, and nothing is rejected for being rare.
PRIOR = 1 << 14

# Least mean log-likelihood ratio of a kept document.
THRESHOLD = -0.5


def repeated_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more in the array."""
    next_words = [F.slice(words, k, F.greatest(F.size(words) - 2, F.lit(0))) for k in (1, 2, 3)]
    return F.transform(
        F.arrays_zip(*[w.alias(n) for w, n in zip(next_words, "abc", strict=True)]),
        lambda w, place: F.struct(F.xxhash64(w["a"], w["b"], w["c"]).alias("h"), place.alias("at")),
    )


def _with_counts(docs: DataFrame) -> DataFrame:
    """Add the counts of the base rules: n_words, word_chars, n_symbols and so on."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    windows = F.when(F.size("words") > 2, repeated_words(F.col("words")))
    counted = (
        docs.withColumn("words", word_array(F.col("text")))
        .withColumn("lines", lines)
        .withColumn("windows", windows)
        .withColumn("codes", F.transform("windows", lambda w: w["h"]))
    )
    some = F.size(F.array_distinct("codes")) < F.size("codes")
    ordered = counted.withColumn("ordered", F.when(some, F.sort_array("windows")))
    # Windows with an equal neighbour in the order of their hashes, by place.
    same = lambda w, k: F.coalesce(F.get("ordered", k)["h"] == w["h"], F.lit(False))
    starts = F.sort_array(
        F.transform(
            F.filter("ordered", lambda w, k: same(w, k - 1) | same(w, k + 1)), lambda w: w["at"]
        )
    )
    with_starts = ordered.withColumn("starts", starts).withColumn(
        "gaps",
        F.zip_with(
            F.slice("starts", 2, F.greatest(F.size("starts"), F.lit(1))),
            F.slice("starts", 1, F.greatest(F.size("starts") - 1, F.lit(0))),
            lambda after, at: F.least(after - at, F.lit(3)),
        ),
    )
    covered = F.aggregate("gaps", F.lit(3), lambda total, gap: total + gap)
    as_long = lambda column: F.coalesce(column, F.lit(0)).cast("bigint")
    return with_starts.select(
        *docs.columns,
        "words",
        as_long(F.size("words")).alias("n_words"),
        as_long(F.length(F.array_join("words", ""))).alias("word_chars"),
        as_long(F.regexp_count(text, F.lit(SYMBOLS))).alias("n_symbols"),
        as_long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        as_long(F.when(F.size("starts") > 0, covered)).alias("n_repeat_words"),
    )


def _pairs(words: str) -> Column:
    """The end of each word with the start of the next one, as an array."""
    after = F.slice(words, 2, F.greatest(F.size(words), F.lit(1)))
    return F.arrays_zip(F.col(words).alias("word"), after.alias("after"))


def _buckets(pair: Column, buckets: int) -> tuple[Column, Column]:
    """Bucket of a word's end, and of that with the start of the next word."""
    end = F.right(pair["word"], F.lit(3))
    begin = F.coalesce(F.left(pair["after"], F.lit(2)), F.lit(""))
    hashes = (F.xxhash64(end), F.xxhash64(end, begin))
    return tuple(F.pmod(h, F.lit(buckets)).cast("int") for h in hashes)


def bucket_counts(
    docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS
) -> DataFrame:
    """(bucket, in_all, in_trusted): n-grams of all documents and of the trusted ones.

    `trusted` has the doc_ids of the trusted documents. Tasks count before they shuffle.
    """
    ids = trusted.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    marked = docs.select("doc_id", "text").join(
        sent_if_small(settled(ids.withColumn("__trusted", F.lit(1)), "trusted")), "doc_id", "left"
    )
    pairs = marked.select("__trusted", word_array(F.col("text")).alias("words")).select(
        "__trusted", F.explode(_pairs("words")).alias("pair")
    )
    return (
        pairs.select("__trusted", F.explode(F.array(*_buckets(F.col("pair"), buckets))).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("in_all"), F.count("__trusted").alias("in_trusted"))
    )


def bucket_ratios(counts: DataFrame, buckets: int, prior: float = PRIOR) -> list[float]:
    """Log ratio of each bucket's chance in the trusted documents and in all.

    The list has one number per bucket. Without trusted documents all are 0.
    """
    ratios = [0.0] * buckets
    found = counts.collect()  # at most one row per bucket
    n_all = sum(r.in_all for r in found)
    n_trusted = sum(r.in_trusted for r in found)
    if not n_trusted:
        return ratios
    for r in found:
        chance = r.in_all / n_all
        own = (r.in_trusted + prior * chance) / (n_trusted + prior)
        ratios[r.bucket] = math.log(own / chance)
    return ratios


def _mean_ratio(ratios: list[float]) -> Column:
    buckets = len(ratios)
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    total = F.aggregate(
        _pairs("words"),
        F.lit(0.0),
        lambda acc, pair: sum((F.get(table, b) for b in _buckets(pair, buckets)), acc),
    )
    return F.when(F.col("n_words") > 0, total / (2 * F.col("n_words")))


def quality_rules(
    docs: DataFrame,
    trusted: DataFrame,
    min_words: int = MIN_WORDS,
    repeat_percent: int = REPEAT_PERCENT,
    threshold: float = THRESHOLD,
    buckets: int = BUCKETS,
    prior: float = PRIOR,
) -> DataFrame:
    """`docs` with the counts, `base_failed`, `llr` and `kept`; every row is judged.

    llr is the mean log-likelihood ratio over a document's n-grams, null without words.
    The base rules fail a document with few words or with too many of them in repeated
    three-word windows. Kept are those that pass the base rules and reach the threshold.

    A null text counts as empty and fails for want of words. Rows with the same doc_id or
    none are judged one by one; a null doc_id is never trusted. With no trusted documents
    the ratio is 0 and rejects nothing. No rows give no rows. Columns of `docs` are kept;
    those with the name of a new one are replaced.
    """
    ratios = bucket_ratios(bucket_counts(docs, trusted, buckets), buckets, prior)
    ours = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = docs.drop(*ours, "base_failed", "llr", "kept", *_WORKING)
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words")
    )
    return (
        _with_counts(rows)
        .withColumn("base_failed", failed)
        .withColumn("llr", _mean_ratio(ratios))
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("llr") >= threshold, F.lit(False)))
        .drop("words")
    )


# Names that the counts use on the way; columns of the input with these names are dropped
# from the result of quality_rules, not from that of keep_good.
_WORKING = ("words", "lines", "windows", "codes", "ordered", "starts", "gaps")


def keep_good(docs: DataFrame, trusted: DataFrame, **options) -> DataFrame:
    """The documents that quality_rules keeps, with the columns of `docs`."""
    packed = docs.select("doc_id", "text", F.struct(*docs.columns).alias("__row"))
    judged = quality_rules(packed, trusted, **options)
    # A filter would be pushed below the steps of the counts and repeat them all; rows are
    # generated from the verdict instead.
    row = F.explode(F.when(F.col("kept"), F.array("__row")))
    return judged.select(row.alias("__row")).select("__row.*")


def trusted_documents(labels: DataFrame) -> DataFrame:
    """The doc_ids that are labelled as of good quality."""
    return labels.where(F.col("quality") == 1).select("doc_id")
