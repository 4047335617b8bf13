"""Words, their hashes, and small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a word is a run of bytes other than blank, tab, LF, VT, FF and CR.
# bytes.split() cuts at the same six.
WORD = r"[^\x20\x09-\x0D]+"

# Entries of a worker's word cache before it is emptied; a cached word takes about 150 bytes.
CACHED_WORDS = 1_000_000

# Odd multipliers of a well-known 64-bit mixing function.
_MIX_1 = np.uint64(0xFF51AFD7ED558CCD)
_MIX_2 = np.uint64(0xC4CEB9FE1A85EC53)
_HALF = np.uint64(33)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers evenly; a bijection."""
    x = (x ^ (x >> _HALF)) * _MIX_1
    x = (x ^ (x >> _HALF)) * _MIX_2
    return x ^ (x >> _HALF)


class WordHashes(dict):
    """64-bit hash of each word seen, as a signed integer; words are bytes."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(self.form(word)) - (1 << 63)
        return value

    def form(self, word: bytes) -> bytes:
        return word

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def raw_words(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` words; a shorter text is one run, an empty one none."""
    words = words.view(np.uint64)
    size = min(size, len(words))
    if not size:
        return words
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total = mix(total + words[k : len(words) - size + 1 + k] + GOLDEN)
    return total


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[str | None]:
    """The texts of a batch, one at a time."""
    values = batch.column(column)
    return (values[k].as_py() for k in range(len(values)))


def utf8_size(text: Column) -> Column:
    """Bytes of a text, 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def word_array(text: Column) -> Column:
    """The words of a text as an array, empty for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


# Ids that may be sent to all tasks: 16 bytes each, so 32 MB at most.
MAX_SENT_ROWS = 2_000_000


def sent_if_small(table: DataFrame, limit: int = MAX_SENT_ROWS) -> DataFrame:
    """Broadcast a narrow table of at most `limit` rows; a larger one is joined by shuffle."""
    return F.broadcast(table) if table.limit(limit + 1).count() <= limit else table


def record_batches(
    rows: Iterable[tuple], schema: pa.Schema, size: int = 4096
) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of up to `size` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )
