"""Recommendations for all users."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.functions.similarity import LIMBS, from_limbs, limbs
from linkweave.operators.product import matrix_product
from linkweave.operators.ranking import top_k


def top_recs(scored: DataFrame, n: int | None) -> DataFrame:
    """The n best items of each user, ties by the greater id; None keeps all."""
    if n is None:
        return scored
    return top_k(
        scored, "user_id", [F.desc("score"), F.desc("item_id")], n, ["item_id"]
    )


def drop_known(scored: DataFrame, history: DataFrame) -> DataFrame:
    return scored.join(history.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def _power(table: DataFrame, column: str) -> int:
    """The least power of two, from 1 on, that no value of a column exceeds in size."""
    greatest = table.agg(F.max(F.abs(F.col(column)))).first()[0]
    return math.ceil(math.log2(max(1.0, greatest or 0.0)))


def primary_recs(
    links: DataFrame,
    history: DataFrame,
    n: int | None = 10,
    score_mode: str = "sum",
    known: DataFrame | None = None,
    value: str | None = None,
) -> DataFrame:
    """Items whose links hold items of the user's history.

    `links` is (item_id, other_item_id, score), best a written table: its greatest score is
    looked up first. In `sum` mode the score is the sum of the similarities, each times the
    preference's `value` if that column of `history` is named. `weighted_average` divides
    that by the sum of the similarities' sizes and asks for two supporting items; without
    values, which then are all 1, it is 1. Items in `known` are left out.
    """
    if score_mode not in ("sum", "weighted_average"):
        raise ValueError(f"unknown score_mode {score_mode!r}")
    average = score_mode == "weighted_average"
    by_link = links.select(
        F.col("other_item_id").alias("__link"), "item_id", F.col("score").cast("double").alias("__score")
    )
    columns = [F.col(value).cast("double").alias("__value")] if value else []
    taken = history.select("user_id", F.col("item_id").alias("__link"), *columns)
    # Sums are exact whatever the sizes of the scores; the powers say where the digits start.
    power = _power(by_link, "__score")
    top = power + (_power(taken, "__value") if value else 0)

    def limb(k: int) -> Callable[[Column, Column], Column]:
        return lambda v, w: limbs(v * w if value else w, top)[k]

    def size_limb(k: int) -> Callable[[Column, Column], Column]:
        return lambda v, w: limbs(F.abs(w), power)[k]

    sums = {c: limb(k) for k, c in enumerate(LIMBS)}
    if average and value:
        sums |= {f"size_{c}": size_limb(k) for k, c in enumerate(LIMBS)}
    found = matrix_product(
        taken, by_link, "__link", "user_id", "item_id", "__value" if value else None, "__score",
        sums=sums, without=known,
    )
    score = from_limbs(top)
    if average:
        found = found.where(F.col("n_terms") > 1)
        size = from_limbs(power, "size_") if value else None
        score = F.when(size > 0, score / size) if value else F.lit(1.0)
    scored = found.select("user_id", "item_id", score.alias("score"))
    return top_recs(scored.dropna(subset=["score"]) if average and value else scored, n)


def cross_recs(cross: DataFrame, secondary: DataFrame, n: int | None = None) -> DataFrame:
    """Sum of the cross counts over the items of the user's secondary history."""
    by_link = cross.select(F.col("other_item_id").alias("__link"), "item_id", "n_users")
    taken = secondary.select("user_id", F.col("item_id").alias("__link"))
    found = matrix_product(taken, by_link, "__link", "user_id", "item_id", None, "n_users")
    scored = found.select("user_id", "item_id", F.col("value").cast("double").alias("score"))
    return top_recs(scored, n)


def blended_recs(weighted: list[tuple[DataFrame, float]], n: int | None = None) -> DataFrame:
    """Linear combination of recommendation tables, as (user_id, item_id, score).

    Each table has a user's item once; its share is added in the order of the list.
    """
    parts = [
        recs.select(
            "user_id", "item_id", F.lit(number).alias("__table"), F.col("score").cast("double").alias("__s")
        )
        for number, (recs, _) in enumerate(weighted)
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    found = union.groupBy("user_id", "item_id").agg(
        *[F.max(F.when(F.col("__table") == k, F.col("__s"))).alias(f"__{k}") for k in range(len(parts))]
    )
    score = F.lit(0.0)
    for number, (_, weight) in enumerate(weighted):
        score = score + F.coalesce(F.col(f"__{number}"), F.lit(0.0)) * F.lit(float(weight))
    return top_recs(found.select("user_id", "item_id", score.alias("score")), n)
