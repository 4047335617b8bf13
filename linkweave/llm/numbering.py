"""Global row numbers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkweave.operators.ids import PARTITION_SHIFT, ROW_MASK
from linkweave.session import settled


def row_numbers(df: DataFrame, order: list[str], name: str = "row_number") -> DataFrame:
    """`df` with numbers 0, 1, 2, ... in the order of some columns.

    The rows are sorted over all tasks and written, so that counting the rows of each
    partition and numbering them see the same rows. Rows equal in the order columns are
    numbered in any order. The table of offsets has one row per partition.
    """
    columns = df.columns
    ordered = settled(
        df.orderBy(*order).withColumn("__seq", F.monotonically_increasing_id()), "ordered"
    )
    part = F.shiftright("__seq", PARTITION_SHIFT)
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ordered.groupBy(part.alias("__part"))
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select("__part", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__start"))
    )
    place = F.col("__seq").bitwiseAND(F.lit(ROW_MASK))
    return (
        ordered.withColumn("__part", part)
        .join(F.broadcast(starts), "__part")
        .select(*columns, (F.col("__start") + place).alias(name))
    )
