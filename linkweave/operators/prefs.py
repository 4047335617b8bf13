"""Preferences: actions split by role, then one (user, item) table per role."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.operators.ranking import top_k
from linkweave.operators.skew import group_sizes, lookup

# Type of the values of preferences.
VALUE = "decimal(18,6)"

PRIMARY, SECONDARY, OTHER = "primary", "secondary", "other"


def role_of(action: Column, primary: str, secondary: str) -> Column:
    """Role of an action; names are compared exactly, and the primary name wins."""
    return (
        F.when(action == primary, PRIMARY).when(action == secondary, SECONDARY).otherwise(OTHER)
    )


def split_actions(log: DataFrame, primary: str, secondary: str) -> DataFrame:
    """The log with a `role` and the preference weight; repeats are kept.

    The weight is the `value` of a log that has values, and 1 otherwise.
    """
    weight = F.col("value").cast("double") if "value" in log.columns else F.lit(1.0)
    return log.withColumn("role", role_of(F.col("action"), primary, secondary)).withColumn(
        "weight", weight
    )


def primary_prefs(log: DataFrame, primary: str) -> DataFrame:
    return log.where(F.col("action") == primary).select(
        "user_id", "item_id", F.lit(1.0).alias("weight")
    )


def secondary_prefs(log: DataFrame, primary: str, secondary: str) -> DataFrame:
    chosen = (F.col("action") == secondary) & (F.col("action") != primary)
    return log.where(chosen).select("user_id", "item_id", F.lit(1.0).alias("weight"))


def other_actions(log: DataFrame, primary: str, secondary: str) -> DataFrame:
    return log.where(~F.col("action").isin(primary, secondary))


def history_matrix(prefs: DataFrame) -> DataFrame:
    """The distinct (user, item) pairs: a repeated preference counts once."""
    return prefs.select("user_id", "item_id").distinct()


def valued_matrix(
    prefs: DataFrame, value: str = "weight", order: str | None = None, keep_zero: bool = False
) -> DataFrame:
    """(user_id, item_id, value) with each pair once.

    Of a repeated preference the last one by `order` counts, without an order the greatest.
    Values are kept to six decimal places, so that their sums do not depend on the order of
    addition. A preference without a value, or with the value 0, is none; `keep_zero` keeps
    those with 0, which a matrix does not have but a list of preferences does.
    """
    kept = F.col(value).cast(VALUE)
    one = F.max(kept) if order is None else F.max_by(kept, F.struct(F.col(order), kept))
    valued = prefs.where(kept.isNotNull()).groupBy("user_id", "item_id").agg(one.alias("value"))
    return valued if keep_zero else valued.where(F.col("value") != 0)


def min_prefs(history: DataFrame, at_least: int) -> DataFrame:
    """Keep the users with at least so many distinct items.

    `history` is best a written table: its frequent users are looked up first.
    """
    if at_least <= 1:
        return history
    enough = group_sizes(history, "user_id", "__items").where(F.col("__items") >= at_least)
    return lookup(history, enough, "user_id", ["item_id"]).drop("__items")


def downsample_prefs(
    history: DataFrame, cap: int, order: list[Column] | None = None
) -> DataFrame:
    """At most `cap` items per user: a repeatable sample, or the first ones in `order`."""
    order = order or [F.xxhash64("user_id", "item_id"), F.col("item_id")]
    return top_k(history, "user_id", order, cap, ["item_id"], "__rank").drop("__rank")


def recent_history(prefs: DataFrame, n: int, ts: str = "ts") -> DataFrame:
    """The n items each user acted on last, as (user_id, item_id, rank)."""
    latest = prefs.groupBy("user_id", "item_id").agg(F.max(ts).alias("__ts"))
    order = [F.desc("__ts"), F.desc("item_id")]
    return top_k(latest, "user_id", order, n, ["item_id"]).drop("__ts")

