"""Item-to-item tables from one action and from two."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.functions.similarity import (
    VALUE_MEASURES,
    Measure,
    PairSums,
    ValueMeasure,
    dependent,
    log_likelihood,
    resolve,
)
from linkweave.operators.product import (
    LISTED_TERMS,
    matrix_product,
    pair_counts,
    pair_sums,
    task_count,
)
from linkweave.operators.pruning import pairs_above, pairs_for_top
from linkweave.operators.ranking import top_k
from linkweave.operators.skew import GroupSummary, group_summary, lookup, with_group_size
from linkweave.session import settled

# Type of the sums of values of one item.
SUM = "decimal(38,12)"


def _both_ways(pairs: DataFrame, *carried: str) -> DataFrame:
    """Each pair (low, high) once from either end."""
    ends = F.array(
        F.struct(F.col("low").alias("item_id"), F.col("high").alias("other_item_id")),
        F.struct(F.col("high").alias("item_id"), F.col("low").alias("other_item_id")),
    )
    return pairs.select(F.explode(ends).alias("__end"), *carried).select("__end.*", *carried)


def cooccurrence(history: DataFrame) -> DataFrame:
    """Users with both items, as (item_id, other_item_id, n_both)."""
    return _both_ways(pair_counts(history, "user_id", "item_id"), "n_both")


def item_similarity(
    history: DataFrame,
    measure: str | Measure = "SIMILARITY_LOGLIKELIHOOD",
    threshold: float | None = None,
) -> DataFrame:
    """Score of each pair with a common user: (item_id, other_item_id, n_both, score).

    `history` is best a written table: its users are counted first. The users per item
    travel with the entries, since joining them to the pairs later would shuffle the far
    larger table. Scores of zero are dropped. With a threshold above zero, pairs that
    cannot reach it are not made, as far as the measure has bounds (see `pruning`).
    """
    score = resolve(measure)
    summary = group_summary(history, "user_id")
    sized = with_group_size(history, "item_id", ["user_id"], "__users")
    if threshold is not None and threshold > 0:
        pairs = pairs_above(settled(sized, "sized"), score, threshold, summary)
    else:
        pairs = pair_counts(sized, "user_id", "item_id", "__users", summary)
    scored = _scored(pairs, score, summary)
    if threshold is not None:
        scored = scored.where(F.col("score") >= threshold)
    return _both_ways(scored, "n_both", "score")


def top_k_similarity(
    history: DataFrame, k: int, measure: str | Measure = "SIMILARITY_LOGLIKELIHOOD"
) -> DataFrame:
    """`top_similar` of `item_similarity`, without making all pairs.

    Users with few items tell what each item's k-th score is at least; then pairs whose
    sizes do not allow as much for either item are skipped as they are made. A caller's own
    measure has no such bounds and is worked out for all pairs.
    """
    score = resolve(measure)
    summary = group_summary(history, "user_id")
    sized = settled(with_group_size(history, "item_id", ["user_id"], "__users"), "sized")
    pairs = pairs_for_top(sized, score, k, summary)
    return top_similar(_both_ways(_scored(pairs, score, summary), "n_both", "score"), k)


def _scored(pairs: DataFrame, score: Measure, summary: GroupSummary) -> DataFrame:
    """(low, high, n_both, score) of counted pairs; pairs without any link are dropped."""
    counts = (*(F.col(c) for c in ("n_both", "n_low", "n_high")), F.lit(summary.keys))
    if score is log_likelihood:
        pairs = pairs.where(dependent(*counts))
    value = score(*counts)
    # As a generated column the score is computed once: a filter on a plain one would be
    # pushed below it and compute it again.
    return pairs.select("low", "high", "n_both", F.explode(F.array(value)).alias("score"))


def value_similarity(
    matrix: DataFrame,
    measure: str | ValueMeasure = "SIMILARITY_COSINE",
    threshold: float | None = None,
) -> DataFrame:
    """Score of each pair from the values of its preferences, as `item_similarity` gives it.

    `matrix` is (user_id, item_id, value) as `prefs.valued_matrix` makes it, best a written
    table. Sums, sums of squares and products are exact decimals, made in one pass over the
    pairs of each user; the sums per item travel with the entries, as doubles.
    """
    if not callable(measure) and measure not in VALUE_MEASURES:
        raise ValueError(f"{measure!r} has no form for values; known: {sorted(VALUE_MEASURES)}")
    score = measure if callable(measure) else VALUE_MEASURES[measure]
    summary = group_summary(matrix, "user_id")
    per_item = matrix.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("value").cast(SUM).cast("double").alias("sum"),
        F.sum(F.col("value") * F.col("value")).cast(SUM).cast("double").alias("squares"),
    )
    entries = lookup(matrix, per_item, "item_id", ["user_id"])
    sums = pair_sums(entries, "user_id", "item_id", "value", ["n", "sum", "squares"], summary)
    names = [
        "n_both", "dot", "shared_low", "shared_high", "n_low", "n_high", "sum_low", "sum_high",
        "squares_low", "squares_high",
    ]
    value = score(PairSums(*[F.col(c).cast("double") for c in names]))
    scored = sums.select("low", "high", "n_both", F.explode(F.array(value)).alias("score"))
    scored = scored.where(F.col("score").isNotNull() & (F.col("score") != 0))
    if threshold is not None:
        scored = scored.where(F.col("score") >= threshold)
    return _both_ways(scored, "n_both", "score")


def most_links(history: DataFrame) -> float:
    """What the rows of `item_similarity` are at most. `history` is best a written table."""
    items = float(group_summary(history, "item_id").keys)
    return min(group_summary(history, "user_id").squares, items * items)


def top_similar(
    similarity: DataFrame, k: int, score: str = "score", rows: float | None = None
) -> DataFrame:
    """The k strongest partners of each item, ties by the greater id.

    If the number of rows is known and asks for more tasks than a shuffle has by default,
    items are dealt to as many.
    """
    if rows is not None:
        tasks = task_count(similarity, rows, LISTED_TERMS)
        if tasks > task_count(similarity, 0):
            similarity = similarity.repartition(tasks, "item_id")
    order = [F.desc(score), F.desc("other_item_id")]
    return top_k(similarity, "item_id", order, k, ["other_item_id"])


def cross_cooccurrence(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Users with the primary action on item_id and the secondary on other_item_id."""
    others = secondary.select("user_id", F.col("item_id").alias("other_item_id"))
    return matrix_product(primary, others, "user_id", "item_id", "other_item_id").select(
        "item_id", "other_item_id", F.col("value").alias("n_users")
    )
