"""Matrices in long form, and packed into rows of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.operators.ranking import group_ranks
from linkweave.operators.skew import group_summary, with_group_size

# Entries of a packed row. A longer vector continues in further parts.
PART_ENTRIES = 100_000


def transpose(matrix: DataFrame) -> DataFrame:
    """Swap the roles of (row_id, col_id); nothing moves."""
    return matrix.select(
        F.col("col_id").alias("row_id"), F.col("row_id").alias("col_id"), "value"
    )


def pack_vectors(
    entries: DataFrame,
    key: str,
    entry: str,
    name: str,
    count: str,
    part_entries: int = PART_ENTRIES,
) -> DataFrame:
    """One array per key and part, ordered by entry: (key, part, name, count).

    Each part holds `part_entries` entries, the last one the rest, in the order of the
    entries; the count is that of the whole vector in every part. No task ever holds the
    whole of a very long one. `entries` is best a written table: its longest vector is
    looked up first.
    """
    rows = entries.select(key, entry)
    if group_summary(entries, key).largest <= part_entries:
        packed = rows.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias(name))
        return packed.select(
            key, F.lit(0).alias("part"), name, F.size(name).cast("bigint").alias(count)
        )
    sized = with_group_size(rows, key, [entry], count).withColumn("__weight", F.lit(0))
    # Ranks go down from the greatest entry.
    place = F.col(count) - F.col("__rank")
    ranked = group_ranks(sized, key, "__weight", entry, "__rank").withColumn(
        "part", F.floor(place / F.lit(part_entries)).cast("int")
    )
    return (
        ranked.groupBy(key, "part", count)
        .agg(F.sort_array(F.collect_list(entry)).alias(name))
        .select(key, "part", name, count)
    )


def user_vectors(history: DataFrame, part_entries: int = PART_ENTRIES) -> DataFrame:
    return pack_vectors(history, "user_id", "item_id", "items", "n_items", part_entries)


def item_vectors(history: DataFrame, part_entries: int = PART_ENTRIES) -> DataFrame:
    return pack_vectors(history, "item_id", "user_id", "users", "n_users", part_entries)


def active_user_counts(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Users with preferences in either matrix, and whether the numbers agree."""
    users = primary.select("user_id", F.lit(1).alias("p"), F.lit(0).alias("s")).unionAll(
        secondary.select("user_id", F.lit(0).alias("p"), F.lit(1).alias("s"))
    )
    per_user = users.groupBy("user_id").agg(F.max("p").alias("p"), F.max("s").alias("s"))
    counts = per_user.agg(
        F.coalesce(F.sum("p"), F.lit(0)).alias("n_users_primary"),
        F.coalesce(F.sum("s"), F.lit(0)).alias("n_users_secondary"),
    )
    return counts.withColumn(
        "n_users_equal", F.col("n_users_primary") == F.col("n_users_secondary")
    )
