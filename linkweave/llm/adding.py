"""Arrays of numbers from all tasks, added up in levels.

Each task gives one array in blocks. A group holds a block of at most FAN_IN tasks, then
of as many sums, and so on, so that no task reads something from all tasks of a large run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.text import record_batches

# Arrays in a group, and levels of groups; the last level takes what is left, which is one
# array for each 65,536 tasks.
FAN_IN = 256
LEVELS = 3

PARTS = "task int, block int, n bigint, numbers array<float>"
SUMS = "task int, block int, n bigint, numbers array<double>"

_PART = pa.schema(
    [
        ("task", pa.int32()),
        ("block", pa.int32()),
        ("n", pa.int64()),
        ("numbers", pa.list_(pa.float32())),
    ]
)


def parts_of(numbers: np.ndarray, blocks: int) -> Iterator[pa.RecordBatch]:
    """The rows (task, block, n, numbers) of one task, for mapInArrow with schema PARTS."""
    task = TaskContext.get().partitionId()
    cut = np.array_split(numbers.astype(np.float32).ravel(), blocks)
    return record_batches(((task, block, 1, part) for block, part in enumerate(cut)), _PART)


def _added(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    block, task = key
    total = np.sum(np.stack(frame["numbers"].to_list()), axis=0, dtype=np.float64)
    return pd.DataFrame(
        {"task": [task], "block": [block], "n": [frame["n"].sum()], "numbers": [total]}
    )


def added_up(parts: DataFrame, fan_in: int = FAN_IN) -> tuple[np.ndarray | None, int]:
    """Sum of the arrays of all tasks, and the number of tasks that gave one.

    Give numbers whose sums are exact as doubles, such as whole numbers or 16-bit floats:
    the sum then does not depend on the order. Without any row the sum is None.
    """
    for level in range(LEVELS):
        task = F.expr(f"task div {fan_in}") if level < LEVELS - 1 else F.lit(0)
        parts = parts.withColumn("task", task.cast("int"))
        parts = parts.groupBy("block", "task").applyInPandas(_added, SUMS)
    rows = parts.orderBy("block").collect()  # one row per block
    if not rows:
        return None, 0
    return np.concatenate([np.array(r.numbers) for r in rows]), rows[0].n
