"""Shards by a Feistel permutation of global row numbers.

The permutation is computed, not stored: a row number gives its shard and slot, and a
shard and slot give the row number back. Row numbers follow doc_id, so that the same
table always gives the same shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.numbering import row_numbers
from linkweave.llm.text import GOLDEN, mix, utf8_size

SHARDS = 16
ROUNDS = 6
SEED = 20_240_917


class Feistel:
    """A permutation of 0 .. size - 1 from a seed.

    The network permutes the next even power of two; a number that lands outside is sent
    through again (cycle walking) until it lands inside. The power is under 4 * size, so
    that takes less than four steps on average.
    """

    def __init__(self, size: int, seed: int = SEED, rounds: int = ROUNDS):
        if size < 1:
            raise ValueError("a permutation needs at least one number")
        self.size = size
        self.half = np.uint64(max(1, -(-max(1, (size - 1).bit_length()) // 2)))
        self.mask = (np.uint64(1) << self.half) - np.uint64(1)
        self.keys = mix(np.arange(rounds, dtype=np.uint64) * GOLDEN + np.uint64(seed))

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys:
            left, right = right, left ^ (mix(right + key) & self.mask)
        return (left << self.half) | right

    def _once_back(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys[::-1]:
            left, right = right ^ (mix(left + key) & self.mask), left
        return (left << self.half) | right

    def _walk(self, numbers: np.ndarray, step) -> np.ndarray:
        found = step(np.asarray(numbers).astype(np.uint64))
        outside = np.flatnonzero(found >= self.size)
        while len(outside):
            found[outside] = step(found[outside])
            outside = outside[found[outside] >= self.size]
        return found.astype(np.int64)

    def place(self, numbers: np.ndarray) -> np.ndarray:
        """Place of each row number in the shuffled order."""
        return self._walk(numbers, self._once)

    def number(self, places: np.ndarray) -> np.ndarray:
        """Row number at each place; undoes `place`."""
        return self._walk(places, self._once_back)


def locate(permutation: Feistel, numbers: np.ndarray, shards: int = SHARDS):
    """(shard, slot) of row numbers."""
    return np.divmod(permutation.place(numbers), shards)[::-1]


def row_at(permutation: Feistel, shard: int, slot: int, shards: int = SHARDS) -> int:
    """The row number in a slot of a shard."""
    return int(permutation.number(np.array([slot * shards + shard]))[0])


def with_places(numbered: DataFrame, size: int, seed: int = SEED) -> DataFrame:
    """Add `place`, the shuffled place of `row_number`."""
    permutation = Feistel(max(1, size), seed)

    def places(numbers: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in numbers:
            yield pd.Series(permutation.place(batch.to_numpy()))

    return numbered.withColumn("place", F.pandas_udf(places, "bigint")("row_number"))


def _ordered(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    narrow = docs.select(
        "doc_id",
        (utf8_size(F.col("text")) + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("text_crc32"),
    )
    return narrow, ["doc_id", "text_crc32", "size"]


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Shard and slot of each document, a row per input row.

    (doc_id, size, text_crc32, row_number, shard, slot): size is the UTF-8 bytes of the text
    plus 1, text_crc32 their unsigned checksum. Rows are numbered by doc_id, null first;
    rows with the same doc_id by checksum and size, so that only rows equal in all three
    can change places. Shards differ by at most one row, and the slots of a shard have no
    gap. A null text counts as empty. No rows give no rows; other columns are not read.
    """
    narrow, order = _ordered(docs)
    numbered = row_numbers(narrow, order)
    size = numbered.count()
    return with_places(numbered, size, seed).select(
        "doc_id",
        "size",
        "text_crc32",
        "row_number",
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("place") / F.lit(shards)).cast("bigint").alias("slot"),
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """`docs` with the shard and slot that `shard` gives; other columns stay.

    Columns named shard, slot, place or row_number are replaced or dropped. The rows are
    sorted as a whole once, so that no join is needed to bring places to texts.
    """
    rows = docs.drop("shard", "slot", "place", "row_number")
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    ordered = rows.withColumn("__size", utf8_size(F.col("text")) + 1).withColumn(
        "__crc", F.crc32(text)
    )
    numbered = row_numbers(ordered, ["doc_id", "__crc", "__size"]).drop("__crc", "__size")
    placed = with_places(numbered, numbered.count(), seed)
    return placed.select(
        *rows.columns,
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("place") / F.lit(shards)).cast("bigint").alias("slot"),
    )
