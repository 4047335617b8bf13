"""Helpers that keep one very frequent key from landing in one task."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.session import settled

# Hot keys that are sent to all tasks: some megabytes at most.
MAX_SENT_KEYS = 100_000

# Rows of a table that may be sent to all tasks: some ten megabytes, which pass through the
# driver. Spark's own limit is on its estimate, which counts compressed files.
MAX_SENT_ROWS = 500_000

# Estimates that are taken as they are, as shares of Spark's limit: those below the first as
# small, those above the second as large, even where a later job reads a column of several only.
SURE_SHARES = (1 / 16, 8)

# Rows of one key that may stay together. A key with more is dealt over as many buckets
# as give each about this number.
HOT_ROWS = 100_000


def bucket_of(columns: list[str], buckets: int | Column) -> Column:
    """A bucket number that depends on the values only, so a re-run task repeats it."""
    count = F.lit(buckets) if isinstance(buckets, int) else buckets
    return F.pmod(F.xxhash64(*columns), count)


class GroupSummary(NamedTuple):
    """Number of keys, rows of the most frequent one, and the sum of squared rows."""

    keys: int
    largest: int
    squares: float


def group_summary(df: DataFrame, key: str) -> GroupSummary:
    """Sizes of the groups of `key`, from a job that counts before it shuffles."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).cast("double").alias("__rows"))
    row = sizes.agg(
        F.count(key), F.max("__rows"), F.sum(F.col("__rows") * F.col("__rows"))
    ).first()
    return GroupSummary(row[0], int(row[1] or 0), row[2] or 0.0)


def _names(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def hot_keys(df: DataFrame, key: str | list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key, __buckets) of every key with more than `hot_rows` rows, written once.

    The table has at most rows / hot_rows keys, so that it is tiny next to `df`.
    """
    keys = _names(key)
    return settled(
        df.dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .where(F.col("__rows") > hot_rows)
        .select(*keys, F.ceil(F.col("__rows") / F.lit(hot_rows)).cast("bigint").alias("__buckets")),
        "hot-keys",
    )


def _share_of_limit(table: DataFrame) -> float:
    """Spark's estimate of a table's size before anything runs, by its size limit for joins.

    The estimate of a written table is the size of the columns read in its files.
    """
    limit = table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return float(str(size)) / limit if limit > 0 else math.inf


def sent_whole(table: DataFrame) -> bool:
    """Whether a join sends the table to all tasks: by Spark's size limit, and by its rows.

    Rows are counted where files of the estimated size may hold too many.
    """
    share = _share_of_limit(table)
    return share <= SURE_SHARES[0] or (share <= 1 and table.count() <= MAX_SENT_ROWS)


def joined_by_rows(table: DataFrame) -> DataFrame:
    """The table, to be joined, as one that Spark does not send whole if it has too many rows."""
    small, large = SURE_SHARES
    if small < _share_of_limit(table) <= large and table.count() > MAX_SENT_ROWS:
        return table.hint("merge")
    return table


def lookup(
    df: DataFrame,
    table: DataFrame,
    on: str | list[str],
    spread: list[str],
    how: str = "inner",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join `df` to a table that has each `on` once.

    Rows of each frequent key are dealt over buckets by the values of `spread`, as many
    as the key's rows ask for, and the table repeats only those keys. Unless `hot_keys` of
    `df` are given, a first job finds them, and `df` is then best a written table; it is
    left out for a table that Spark sends to all tasks, since `df` then stays where it is.
    How keys are dealt changes the work, never the result.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    if hot is None:
        if sent_whole(table):
            return df.join(table, on, how)
        hot = hot_keys(df, on)
    n_hot = hot.count()
    if not n_hot:
        return df.join(joined_by_rows(table), on, how)
    # The hot keys are few by their definition; Spark sends a small table to all tasks.
    # Beyond that, its rows meet those of `df` key by key, which adaptive execution splits.
    if n_hot <= MAX_SENT_KEYS:
        hot = F.broadcast(hot)
    zero = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")
    left = df.join(hot, on, "left").withColumn(
        "__bucket",
        F.when(F.col("__buckets").isNull(), zero).otherwise(
            bucket_of(spread, F.col("__buckets"))
        ),
    )
    last = F.coalesce(F.col("__buckets"), one) - one
    right = table.join(hot, on, "left").withColumn(
        "__bucket", F.explode(F.sequence(zero, last))
    )
    return left.drop("__buckets").join(
        joined_by_rows(right.drop("__buckets")), [*_names(on), "__bucket"], how
    ).drop("__bucket")


def group_sizes(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows per key, as (key, name). Tasks count before they shuffle."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def with_group_size(
    df: DataFrame, key: str, spread: list[str], name: str
) -> DataFrame:
    """`df` with the number of rows of its key. It is best a written table."""
    return lookup(df, group_sizes(df, key, name), key, spread)
