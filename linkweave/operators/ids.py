"""Dictionaries between the ids of the log and dense numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave.operators.skew import hot_keys, lookup, sent_whole
from linkweave.session import settled

# monotonically_increasing_id() keeps the partition above bit 33.
PARTITION_SHIFT = 33
ROW_MASK = (1 << PARTITION_SHIFT) - 1


def assign_ids(log: DataFrame, id_col: str, first_seen: Column) -> DataFrame:
    """Number the distinct ids 0, 1, 2, ... in the order they are first seen.

    The ids are sorted over all tasks and settled, so that counting the rows of each
    partition and numbering them work on the same rows.
    """
    ordered = settled(
        log.groupBy(F.col(id_col).alias("ext_id"))
        .agg(F.min(first_seen).alias("__first"))
        .orderBy("__first", "ext_id")
        .select("ext_id", F.monotonically_increasing_id().alias("__seq"))
    )
    numbered = ordered.select(
        "ext_id",
        F.shiftright("__seq", PARTITION_SHIFT).alias("__part"),
        F.col("__seq").bitwiseAND(F.lit(ROW_MASK)).alias("__row"),
    )
    # One row per partition of the sort, so the window and the broadcast stay small.
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        numbered.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select(
            "__part", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__start")
        )
    )
    return numbered.join(F.broadcast(starts), "__part").select(
        "ext_id", (F.col("__start") + F.col("__row")).alias("int_id")
    )


def matrix_dims(log: DataFrame) -> DataFrame:
    """Distinct users and items over all actions, as one row."""
    return log.agg(
        F.countDistinct("user_id").alias("n_users"),
        F.countDistinct("item_id").alias("n_items"),
    )


def encode(prefs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Replace the ids by their numbers, as (user_int, item_int, ...).

    `prefs` and the dictionaries are best written tables: frequent ids are looked up first
    where a dictionary is too large to be sent to all tasks.
    """
    rest = [c for c in prefs.columns if c not in ("user_id", "item_id")]
    sides = {
        column: dictionary.select(F.col("ext_id").alias(column), F.col("int_id").alias(number))
        for column, number, dictionary in (
            ("user_id", "user_int", users),
            ("item_id", "item_int", items),
        )
    }
    hot = _hot_of(prefs, sides)
    coded = lookup(prefs, sides["user_id"], "user_id", ["item_id"], hot=hot["user_id"])
    coded = lookup(coded, sides["item_id"], "item_id", ["user_int"], hot=hot["item_id"])
    return coded.select("user_int", "item_int", *rest)


def _hot_of(df: DataFrame, sides: dict[str, DataFrame]) -> dict[str, DataFrame | None]:
    """The frequent keys of each column whose dictionary is not sent to all tasks."""
    return {
        column: None if sent_whole(dictionary) else hot_keys(df, column)
        for column, dictionary in sides.items()
    }


def decode(
    matrix: DataFrame,
    sides: dict[str, tuple[str, DataFrame]],
) -> DataFrame:
    """Add the original ids of numbered columns.

    `sides` gives, for each of two numbered columns, the name of the column to add and the
    dictionary. `matrix` and the dictionaries are best written tables, as for `encode`.
    """
    named = {
        column: dictionary.select(F.col("int_id").alias(column), F.col("ext_id").alias(name))
        for column, (name, dictionary) in sides.items()
    }
    hot = _hot_of(matrix, named)
    for column, names in named.items():
        spread = [other for other in sides if other != column]
        matrix = lookup(matrix, names, column, spread, hot=hot[column])
    return matrix
