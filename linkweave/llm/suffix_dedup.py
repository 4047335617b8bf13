"""Removal of long repeated passages by prefix-free parsing.

Every text is parsed into phrases by triggers: the trigger of a 400-byte string is the
k-gram in it whose rolling hash is least, the last one if several are. Neighbouring
strings with the same trigger form a phrase, from the first byte of the first string to
the last byte of the last one. So phrases overlap by 399 bytes, every 400-byte string lies
whole in one phrase, and equal strings have the same trigger at the same place.

The parse is the list of phrases of each text, the dictionary the distinct phrases. A
phrase that occurs twice in the parse is repeated as a whole. The other phrases matter
only beside a different phrase with the same trigger; the suffixes of those dictionary
phrases are sorted into a suffix array, and neighbours in it with a common prefix of 400
bytes are repeats. Where a trigger has too many phrases for one task, their strings meet
by a hash of these bytes instead.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.text import mix, record_batches
from linkweave.operators.skew import lookup
from linkweave.session import settled

# Bytes of a repeated string, and of the k-gram in it that serves as trigger.
LENGTH = 400
TRIGGER = 200

# Bytes of the texts that are parsed together, and of one part of a very long text.
SLICE = 1 << 18
PART = 1 << 22

# Odd bases of two rolling hashes, and the size of the position in a
# trigger's order.
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
_POSITION_BITS = np.uint64(23)
_POSITION = (np.uint64(1) << _POSITION_BITS) - np.uint64(1)


class RollingHash:
    """Hashes of any substring of a byte array, from sums of its bytes times powers."""

    def __init__(self, base: int):
        self.base = base
        self.inverse = pow(base, -1, 1 << 64)
        self.letters = mix(np.arange(256, dtype=np.uint64) + np.uint64(base))
        self.powers = self.backwards = np.ones(1, np.uint64)

    def _extend(self, size: int) -> None:
        if len(self.powers) < size:
            for name, factor in (("powers", self.base), ("backwards", self.inverse)):
                steps = np.full(2 * size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._extend(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.letters[data] * self.powers[: len(data)], out=total[1:])
        return total

    def windows(self, sums: np.ndarray, size: int) -> np.ndarray:
        """Hash of every substring of this size."""
        return (sums[size:] - sums[:-size]) * self.backwards[: len(sums) - size]

    def ranges(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (sums[ends] - sums[starts]) * self.backwards[starts]


class Hashes(NamedTuple):
    trigger: RollingHash
    content: RollingHash

    @classmethod
    def new(cls) -> Hashes:
        return cls(*map(RollingHash, _BASES))


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Least value of every window, by windows of doubling size."""
    done = 1
    while 2 * done <= size:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = size - done
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class Phrases(NamedTuple):
    """Of the bytes parsed together: first and last string start, trigger place, hashes."""

    first: np.ndarray
    last: np.ndarray
    place: np.ndarray
    trigger: np.ndarray
    content: np.ndarray


def parse(data: np.ndarray, ends: np.ndarray, hashes: Hashes, length: int, k: int) -> Phrases:
    """Phrases of texts that lie one after the other and end at `ends`.

    No phrase crosses an end; texts shorter than `length` have none.
    """
    sums = hashes.trigger.sums(data)
    grams = hashes.trigger.windows(sums, k)
    # The order of triggers: the hash, then the later place first.
    backward = _POSITION - np.arange(len(grams), dtype=np.uint64)
    order = (mix(grams) & ~_POSITION) | backward
    least = sliding_min(order, length - k + 1)
    places = (_POSITION - (least & _POSITION)).astype(np.int64)
    starts = np.arange(len(places))
    whole = starts + length <= ends[np.searchsorted(ends, starts, side="right")]
    starts, places = starts[whole], places[whole]
    if not len(starts):
        empty = np.zeros(0, np.int64)
        return Phrases(empty, empty, empty, empty, empty)
    new = np.flatnonzero((np.diff(places) != 0) | (np.diff(starts) != 1)) + 1
    first, last = starts[np.r_[0, new]], starts[np.r_[new - 1, len(starts) - 1]]
    place = places[np.r_[0, new]]
    content = hashes.content.ranges(hashes.content.sums(data), first, last + length)
    # Where the trigger lies in the phrase is part of its content.
    content = mix(content + mix((place - first).astype(np.uint64)) + (last - first).astype(np.uint64))
    return Phrases(first, last, place, grams[place].view(np.int64), content.view(np.int64))


def _key(text: bytes) -> bytes:
    return hashlib.md5(text).digest()


def _parts(text: bytes, length: int, part: int = PART) -> Iterator[tuple[int, bytes]]:
    """A very long text in parts, each with the strings that start in it."""
    for base in range(0, max(1, len(text) - length + 1), part):
        yield base, text[base : base + part + length - 1]


_PARSED = pa.schema(
    [
        ("text_key", pa.binary()),
        ("n", pa.int64()),
        ("first", pa.int64()),
        ("last", pa.int64()),
        ("trigger", pa.int64()),
        ("content", pa.int64()),
    ]
)


def _parse_texts(length: int, k: int):
    """Phrases of all texts; equal texts of a batch are parsed once and counted as n."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes.new()
        for batch in batches:
            values = (v.as_buffer().to_pybytes() for v in batch.column("text") if v.is_valid)
            copies = Counter(v for v in values if len(v) >= length)
            held: list[tuple[bytes, int, int, bytes]] = []
            size = 0
            for text, n in copies.items():
                key = _key(text)
                for base, part in _parts(text, length):
                    held.append((key, n, base, part))
                    size += len(part)
                    if size >= SLICE:
                        yield _phrase_batch(held, hashes, length, k)
                        held, size = [], 0
            if held:
                yield _phrase_batch(held, hashes, length, k)

    return run


def _phrase_batch(held: list[tuple], hashes: Hashes, length: int, k: int) -> pa.RecordBatch:
    keys, copies, bases, parts = zip(*held, strict=True)
    ends = np.cumsum([len(p) for p in parts])
    phrases = parse(np.frombuffer(b"".join(parts), np.uint8), ends, hashes, length, k)
    of = np.searchsorted(ends, phrases.first, side="right")
    shift = np.array(bases, np.int64)[of] - np.r_[0, ends[:-1]][of]
    columns = [
        pa.array(keys, pa.binary()).take(pa.array(of)),
        pa.array(np.array(copies, np.int64)[of]),
        pa.array(phrases.first + shift),
        pa.array(phrases.last + shift),
        pa.array(phrases.trigger),
        pa.array(phrases.content),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_PARSED)


_EDGE = pa.schema(
    [
        ("trigger", pa.int64()),
        ("text_key", pa.binary()),
        ("first", pa.int64()),
        ("place", pa.int64()),
        ("bytes", pa.binary()),
    ]
)


def _cut_edges(length: int, k: int):
    """The bytes of the phrases asked for, each text of a batch once."""

    def rows(batches):
        hashes = Hashes.new()
        for batch in batches:
            seen = set()
            columns = (batch.column(c) for c in ("text_key", "text", "edges"))
            for key, text, edges in zip(*columns, strict=True):
                key = key.as_py()
                if key in seen:
                    continue
                seen.add(key)
                text = text.as_buffer().to_pybytes()
                for edge in edges.as_py():
                    data = text[edge["first"] : edge["last"] + length]
                    place = _place(data, edge["trigger"], hashes, k)
                    yield edge["trigger"], key, edge["first"], place, data

    return lambda batches: record_batches(rows(batches), _EDGE, 512)


def _place(phrase: bytes, trigger: int, hashes: Hashes, k: int) -> int:
    """Where the trigger lies in the phrase: its last occurrence."""
    sums = hashes.trigger.sums(np.frombuffer(phrase, np.uint8))
    return int(np.flatnonzero(hashes.trigger.windows(sums, k).view(np.int64) == trigger)[-1])


def _suffix_codes(phrases: list[tuple[int, bytes]], hashes: Hashes, length: int):
    """(number of the phrase, start in it, code) of every string in the phrases.

    The code stands for the distance from the trigger and the string's bytes.
    """
    data = np.frombuffer(b"".join(p for _, p in phrases), np.uint8)
    sizes = np.array([len(p) for _, p in phrases])
    begins = np.cumsum(sizes) - sizes
    strings = sizes - length + 1
    of = np.repeat(np.arange(len(phrases)), strings)
    start = np.arange(len(of)) - np.repeat(np.cumsum(strings) - strings, strings)
    at = begins[of] + start
    content = hashes.content.ranges(hashes.content.sums(data), at, at + length)
    distance = np.array([place for place, _ in phrases])[of] - start
    return of, start, mix(content + mix(distance.astype(np.uint64))).view(np.int64)


_SPAN = pa.schema([("text_key", pa.binary()), ("first", pa.int64()), ("last", pa.int64())])


def _runs(positions: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last of each run of neighbouring numbers."""
    cut = np.flatnonzero(np.diff(positions) != 1) + 1
    for run in np.split(positions, cut):
        yield int(run[0]), int(run[-1])


def suffix_order(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of the given starts by their first `length` bytes, and equal neighbours.

    The second array tells of each suffix but the first whether its longest common prefix
    with the one before it in the order reaches `length`. Ranks of 8 bytes are doubled to
    ranks of 16, 32, ... bytes; two of the last ones that overlap give the order of `length`
    bytes. Bytes are compared, not hashes.
    """
    padded = np.concatenate((data, np.zeros(length + 8, np.uint8))).astype(np.uint64)
    size = min(8, length)
    n = len(data) + length
    rank = np.zeros(n, np.uint64)
    for k in range(size):
        rank = (rank << np.uint64(8)) | padded[k : k + n]
    while 2 * size < length:
        _, rank = np.unique(rank, return_inverse=True)
        ahead = np.concatenate((rank[size:], np.zeros(size, rank.dtype)))
        rank = (rank.astype(np.uint64) << np.uint64(32)) | ahead.astype(np.uint64)
        size *= 2
    _, rank = np.unique(rank, return_inverse=True)
    both = (rank[starts].astype(np.uint64) << np.uint64(32)) | rank[starts + length - size].astype(np.uint64)
    order = np.argsort(both, kind="stable")
    return order, both[order[1:]] == both[order[:-1]]


# Bytes of phrases whose suffixes are ordered together; those of one trigger are never parted.
ORDERED_BYTES = 1 << 21


def _repeats_of_trigger(length: int):
    """Repeats among the phrases of each trigger; rows come sorted by trigger."""

    def rows(batches):
        # Phrases of the triggers that are complete, and of the one that is being read.
        held: list[tuple[bytes, int, bytes]] = []
        size, current = 0, None
        phrases: dict[tuple[bytes, int], bytes] = {}

        def complete():
            nonlocal size, phrases
            if len(phrases) > 1:
                held.extend((key, first, data) for (key, first), data in phrases.items())
                size += sum(map(len, phrases.values()))
            phrases = {}

        for batch in batches:
            for row in batch.to_pylist():
                if row["trigger"] != current:
                    complete()
                    current = row["trigger"]
                    if size >= ORDERED_BYTES:
                        yield from _repeats(held, length)
                        held, size = [], 0
                phrases[row["text_key"], row["first"]] = row["bytes"]
        complete()
        yield from _repeats(held, length)

    return lambda batches: record_batches(rows(batches), _SPAN)


def _repeats(
    phrases: list[tuple[bytes, int, bytes]], length: int
) -> Iterator[tuple[bytes, int, int]]:
    """Strings that two phrases share, as spans of their starts.

    Equal strings have the same trigger at the same place, so they cannot lie in one phrase
    twice, and phrases of different triggers share none.
    """
    if not phrases:
        return
    data = np.frombuffer(b"".join(p for *_, p in phrases), np.uint8)
    sizes = np.array([len(p) for *_, p in phrases])
    begins = np.cumsum(sizes) - sizes
    strings = sizes - length + 1
    of = np.repeat(np.arange(len(phrases)), strings)
    start = np.arange(len(of)) - np.repeat(np.cumsum(strings) - strings, strings)
    order, same = suffix_order(data, begins[of] + start, length)
    repeated = np.zeros(len(of), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    for number in np.unique(of[repeated]).tolist():
        low, high = np.searchsorted(of, [number, number + 1])
        key, first, _ = phrases[number]
        for begin, end in _runs(start[low:high][repeated[low:high]]):
            yield key, first + begin, first + end


_CODE = pa.schema(
    [("trigger", pa.int64()), ("code", pa.int64()), ("text_key", pa.binary()), ("first", pa.int64())]
)


def _codes_of_phrases(length: int):
    """A row per string, for triggers with too many phrases for one task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes.new()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = batch.slice(lo, 256).to_pylist()
                of, start, codes = _suffix_codes([(r["place"], r["bytes"]) for r in rows], hashes, length)
                firsts = np.array([r["first"] for r in rows])[of] + start
                take = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r["trigger"] for r in rows], pa.int64()).take(take),
                        pa.array(codes),
                        pa.array([r["text_key"] for r in rows], pa.binary()).take(take),
                        pa.array(firsts),
                    ],
                    schema=_CODE,
                )

    return run


# Phrases of one trigger that are compared in one task: about two megabytes.
TASK_PHRASES = 4_096


def _edge_repeats(edges: DataFrame, length: int, task_phrases: int) -> DataFrame:
    """(text_key, first, last) of the strings that different phrases share."""
    few = (
        edges.where(F.col("phrases") <= task_phrases)
        .repartition("trigger")
        .sortWithinPartitions("trigger")
        .select("trigger", "text_key", "first", "place", "bytes")
        .mapInArrow(_repeats_of_trigger(length), "text_key binary, first bigint, last bigint")
    )
    many = edges.where(F.col("phrases") > task_phrases)
    if not many.limit(1).count():
        return few
    codes = settled(
        many.dropDuplicates(["text_key", "first"])
        .select("trigger", "text_key", "first", "place", "bytes")
        .mapInArrow(
            _codes_of_phrases(length), "trigger bigint, code bigint, text_key binary, first bigint"
        ),
        "codes",
    )
    twice = codes.groupBy("trigger", "code").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = lookup(codes, twice.drop("n"), ["trigger", "code"], ["text_key", "first"])
    return few.unionAll(shared.select("text_key", "first", F.col("first").alias("last")))


def repeated_strings(
    docs: DataFrame, length: int = LENGTH, k: int = TRIGGER, task_phrases: int = TASK_PHRASES
) -> DataFrame:
    """(text_key, spans) of each text with repeats: first and last starts of repeated strings.

    A text is named by the MD5 of its bytes, so that rows without a doc_id, or with the
    same one, need no care.
    """
    parsed = settled(
        docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(
            _parse_texts(length, k),
            "text_key binary, n bigint, first bigint, last bigint, trigger bigint, content bigint",
        ),
        "parsed",
    )
    triggers = settled(
        parsed.groupBy("trigger")
        .agg(
            F.sum("n").alias("n"),
            (F.min("content") != F.max("content")).alias("several"),
        )
        .where(F.col("n") > 1)
        .select("trigger", "several"),
        "triggers",
    )
    # Only phrases whose trigger occurs twice can hold a repeat.
    likely = settled(_join_small(parsed, triggers, "trigger"), "likely")
    dictionary = settled(
        likely.groupBy("trigger", "content").agg(
            F.sum("n").alias("n"),
            F.max("several").alias("several"),
            F.min(F.struct("text_key", "first", "last")).alias("at"),
        ),
        "dictionary",
    )
    whole = lookup(
        likely.select("trigger", "content", "text_key", "first", "last"),
        dictionary.where(F.col("n") > 1).select("trigger", "content"),
        ["trigger", "content"],
        ["text_key", "first"],
    ).select("text_key", "first", "last")

    sides = dictionary.where("several").select("trigger", "at.*")
    sizes = sides.groupBy("trigger").agg(F.count(F.lit(1)).alias("phrases"))
    wanted = settled(
        sides.groupBy("text_key").agg(
            F.collect_list(F.struct("trigger", "first", "last")).alias("edges")
        ),
        "wanted",
    )
    edges = settled(
        lookup(
            settled(
                _join_small(_keyed(docs), wanted, "text_key", lists="edges")
                .select("text_key", "text", "edges")
                .mapInArrow(
                    _cut_edges(length, k),
                    "trigger bigint, text_key binary, first bigint, place bigint, bytes binary",
                ),
                "cut",
            ),
            sizes,
            "trigger",
            ["text_key"],
        ),
        "edges",
    )
    spans = whole.unionAll(_edge_repeats(edges, length, task_phrases))
    lists = spans.groupBy("text_key").agg(
        F.sort_array(F.collect_set(F.struct("first", "last"))).alias("spans")
    )
    schema = "text_key binary, spans array<struct<first:bigint,last:bigint>>"
    return settled(lists.mapInArrow(_joined_spans, schema), "spans")


def _joined_spans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of each text with neighbouring and overlapping ones put together."""
    for batch in batches:
        column = batch.column("spans")
        lengths = np.diff(column.offsets.to_numpy())
        flat = column.flatten()
        first, last = (flat.field(k).to_numpy() for k in (0, 1))
        of = np.repeat(np.arange(len(lengths)), lengths)
        # Spans come in order within their text; what they reach so far, text by text.
        step = int(last.max(initial=0)) + 2
        reach = np.maximum.accumulate(last + of * step)
        begins = np.ones(len(first), bool)
        begins[1:] = (of[1:] != of[:-1]) | (first[1:] + of[1:] * step > reach[:-1] + 1)
        at = np.flatnonzero(begins)
        ends = np.append(at[1:], len(first)) - 1
        spans = pa.StructArray.from_arrays(
            [pa.array(first[at]), pa.array(reach[ends] - of[at] * step)], names=["first", "last"]
        )
        offsets = np.searchsorted(of[at], np.arange(len(lengths) + 1))
        yield pa.RecordBatch.from_arrays(
            [batch.column("text_key"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)],
            names=["text_key", "spans"],
        )


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("binary")
    return docs.select("doc_id", text.alias("text"), F.unhex(F.md5(text)).alias("text_key"))


# Entries of a table that may be sent to all tasks: at most 64 bytes each, 64 MB together.
SENT_ENTRIES = 1_000_000


def _join_small(
    rows: DataFrame, table: DataFrame, on: str, how: str = "inner", lists: str | None = None
) -> DataFrame:
    """Join a table that has each key once: sent to all tasks if small, else by salted keys.

    Small is meant in entries, which are a list's where the table has one.
    """
    entries = F.greatest(F.lit(1), F.size(lists)) if lists else F.lit(1)
    if (table.agg(F.sum(entries)).first()[0] or 0) <= SENT_ENTRIES:
        return rows.join(F.broadcast(table), on, how)
    return lookup(rows, table, on, [c for c in ("doc_id", "first") if c in rows.columns], how)


def covered(spans: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes under the strings that start in the spans."""
    runs: list[list[int]] = []
    for span in spans:
        begin, end = span["first"], span["last"] + length
        if runs and begin <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([begin, end])
    return [tuple(run) for run in runs]


_DIGEST = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
    ]
)


def kept_bytes(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    ends = [0, *(end for _, end in runs)]
    begins = [*(begin for begin, _ in runs), len(text)]
    return b"".join(text[a:b] for a, b in zip(ends, begins, strict=True))


def _digests(length: int):
    def rows(batches):
        for batch in batches:
            columns = (batch.column(c) for c in ("doc_id", "text", "spans"))
            for doc_id, value, spans in zip(*columns, strict=True):
                text = value.as_buffer().to_pybytes() if value.is_valid else b""
                runs = covered(spans.as_py() or [], length)
                kept = kept_bytes(text, runs)
                digest = hashlib.sha256(kept).hexdigest()
                yield doc_id.as_py(), len(text), len(text) - len(kept), len(runs), digest

    return lambda batches: record_batches(rows(batches), _DIGEST)


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, k: int = TRIGGER, task_phrases: int = TASK_PHRASES
) -> DataFrame:
    """Digest of each document without its repeated bytes, a row per input row.

    Bytes under a `length`-byte string that also starts anywhere else, in the same or
    another document, are removed; strings overlap, and are judged on the input. Texts are
    UTF-8 bytes, so that what is left may cut a character.

    A null text counts as empty and has n_bytes 0; a text under `length` bytes is kept
    whole. Repeated rows are repeats like any other. No rows give no rows. Other columns
    are not read.
    """
    spans = repeated_strings(docs, length, k, task_phrases)
    return (
        _join_small(_keyed(docs), spans, "text_key", "left", "spans")
        .select("doc_id", "text", "spans")
        .mapInArrow(
            _digests(length),
            "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
        )
    )
