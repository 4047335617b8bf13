"""Rankings within groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave.operators.skew import bucket_of

# Fixed value: up to this rank Spark filters each task's rows before the shuffle
# (the default of spark.sql.optimizer.windowGroupLimitThreshold).
PRUNED_RANK = 1_000

# Buckets of a key within which a large k is cut first.
BUCKETS = 512

# Numeric ids per block in `group_ranks`.
ID_BLOCK = 65_536


def top_k(
    df: DataFrame,
    key: str,
    order: list[Column],
    k: int,
    spread: list[str],
    rank: str = "rank",
) -> DataFrame:
    """The first k rows of each key, with their rank from 1.

    For a small k every task keeps only k rows per key before the shuffle. For a
    large one the same is done per bucket of the key.
    """
    if k > PRUNED_RANK:
        within = Window.partitionBy(key, "__bucket").orderBy(*order)
        df = (
            df.withColumn("__bucket", bucket_of(spread, BUCKETS))
            .withColumn("__rank", F.row_number().over(within))
            .where(F.col("__rank") <= k)
            .drop("__bucket", "__rank")
        )
    overall = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(overall)).where(F.col(rank) <= k)


def group_ranks(
    df: DataFrame,
    key: str,
    weight: str,
    tie_id: str,
    rank: str = "rank",
    block: int = ID_BLOCK,
) -> DataFrame:
    """Rank the rows of each key by weight and then id, both descending.

    No group is sorted as a whole. A rank is the number of rows with a greater weight,
    plus those of the same weight in later blocks of ids, plus the place in the block;
    `tie_id` is unique in a group, so the rows of a block are at most `block`.
    """
    cell = [key, weight, "__block"]
    rows = df.withColumn("__block", F.floor(F.col(tie_id) / F.lit(block)))
    before = (Window.unboundedPreceding, -1)

    cells = rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("__rows"))
    heavier = (
        cells.groupBy(key, weight)
        .agg(F.sum("__rows").alias("__rows"))
        .select(
            key,
            weight,
            F.sum("__rows")
            .over(Window.partitionBy(key).orderBy(F.desc(weight)).rowsBetween(*before))
            .alias("__heavier"),
        )
    )
    later = cells.select(
        *cell,
        F.sum("__rows")
        .over(Window.partitionBy(key, weight).orderBy(F.desc("__block")).rowsBetween(*before))
        .alias("__later"),
    )
    starts = later.join(heavier, [key, weight]).select(
        *cell,
        (F.coalesce("__heavier", F.lit(0)) + F.coalesce("__later", F.lit(0))).alias("__start"),
    )
    place = F.row_number().over(Window.partitionBy(*cell).orderBy(F.desc(tie_id)))
    return (
        rows.withColumn("__place", place)
        .join(starts, cell)
        .withColumn(rank, F.col("__start") + F.col("__place"))
        .drop("__block", "__place", "__start")
    )
