"""Periodic runs of words: grid candidates, extended exactly in a recompressed grammar.

A run is a stretch of consecutive words with smallest period q and at least
max(MIN_WORDS, 2 q) words that neither neighbour extends. A stretch of 2 q words holds
two neighbouring points of the grid 0, q, 2 q, ..., and the words there are equal. So all
pairs (i, i + q) on these grids with equal words are candidates, about n ln n for n
words, and each is extended in both directions by longest-common-extension queries.

The queries run on a grammar made by recompression: blocks of one symbol become a symbol,
then pairs that a coin for each symbol picks become symbols, and so on until a document is
one symbol. Equal stretches are cut alike but for their ends, so a query climbs over a
few symbols of each level and comes down again: O(log n) steps, no suffix array. Texts are
put into one grammar in groups, with a separator of its own after each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.llm.text import GOLDEN, mix, raw_words, texts_of

MIN_WORDS = 12

# Words of a group of texts that are worked on at once; a longer text is a group of its own.
GROUP_WORDS = 200_000

# Grid pairs that are compared at once.
GRID_PAIRS = 2_000_000

# Texts up to this length share one table of grid pairs, of about 35,000 entries.
GRID_WORDS = 4_096

# A run has so many equal pairs of words in a row at least, whatever its period.
LEAST_MATCHES = MIN_WORDS // 2

# Which word of the text stands at each place; None leaves the text as it is.
Arrange = Callable[[int | None, int], np.ndarray | None]

RUN = ("start", "length", "period")
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class _Level:
    """One level of the grammar: its symbols, where they start, and how the next one cuts them."""

    def __init__(self, symbols: np.ndarray, starts: np.ndarray):
        self.symbols = symbols
        self.starts = starts  # one more than symbols: the last is the end
        self.opens = np.ones(len(symbols), bool)  # begins a symbol of the next level
        self.block_ends: np.ndarray | None = None  # after a block step: end of its block

    def forward(self, a: np.ndarray, b: np.ndarray):
        """Symbols at two lists of places: equal or not, and the places after them.

        At a level that is cut into blocks the shorter rest of the two blocks is taken.
        The last value tells whether both have come to the end of their symbol or block.
        """
        ka, kb = np.searchsorted(self.starts, a), np.searchsorted(self.starts, b)
        same = self.symbols[ka] == self.symbols[kb]
        if self.block_ends is None:
            return same, ka, kb, self.starts[ka + 1], self.starts[kb + 1], same
        rest_a, rest_b = self.block_ends[ka] - ka, self.block_ends[kb] - kb
        common = np.minimum(rest_a, rest_b)
        after_a, after_b = self.starts[ka + common], self.starts[kb + common]
        return same, ka, kb, after_a, after_b, same & (rest_a == rest_b)


class Grammar:
    """Run-length grammar of a list of symbols.

    `symbols` are numbers below `n_letters`; those from `n_words` on are separators, each
    used once, and the list ends with one.
    """

    def __init__(self, symbols: np.ndarray, n_words: int, n_letters: int):
        self._separators = (n_words, n_letters)
        self._next = n_letters
        self.levels = [_Level(symbols, np.arange(len(symbols) + 1))]
        rounds = 0
        while self._unfinished():
            self._blocks()
            self._pairs(rounds)
            rounds += 1

    def _frozen(self, symbols: np.ndarray) -> np.ndarray:
        low, high = self._separators
        return (symbols >= low) & (symbols < high)

    def _unfinished(self) -> bool:
        frozen = self._frozen(self.levels[-1].symbols)
        return bool((~frozen[1:] & ~frozen[:-1]).any())

    def _named(self, keys: np.ndarray) -> np.ndarray:
        """A new symbol for each different key."""
        names, number = np.unique(keys, return_inverse=True)
        first, self._next = self._next, self._next + len(names)
        return first + number

    def _blocks(self) -> None:
        level = self.levels[-1]
        s = level.symbols
        first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        if len(first) == len(s):
            return
        ends = np.append(first[1:], len(s))
        length = ends - first
        symbols = s[first]
        long = np.flatnonzero(length > 1)
        symbols[long] = self._named((symbols[long] << 32) | length[long])
        level.opens = np.zeros(len(s), bool)
        level.opens[first] = True
        level.block_ends = np.repeat(ends, length)
        self.levels.append(_Level(symbols, np.append(level.starts[first], level.starts[-1])))

    def _pairs(self, rounds: int) -> None:
        level = self.levels[-1]
        s = level.symbols
        salt = np.full(1, rounds + 1, np.uint64) * GOLDEN
        coin = (mix(s.astype(np.uint64) + salt) & np.uint64(1)) == 1
        free = ~self._frozen(s)
        both = free[1:] & free[:-1]
        rises, falls = both & ~coin[:-1] & coin[1:], both & coin[:-1] & ~coin[1:]
        chosen = rises if rises.sum() >= falls.sum() else falls
        left = np.flatnonzero(chosen)
        if not len(left):
            return
        symbols = s.copy()
        symbols[left] = self._named((s[left] << 32) | s[left + 1])
        level.opens = np.ones(len(s), bool)
        level.opens[left + 1] = False
        keep = level.opens
        self.levels.append(
            _Level(symbols[keep], np.append(level.starts[:-1][keep], level.starts[-1]))
        )

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common stretch from each two places; i and j differ."""
        at_i, at_j = i.copy(), j.copy()
        top = len(self.levels) - 1
        turned = np.full(len(i), top)
        up = np.arange(len(i))
        for number, level in enumerate(self.levels[:-1]):
            same, ka, kb, after_a, after_b, level_with = level.forward(at_i[up], at_j[up])
            on = same & level.opens[ka] & level.opens[kb]
            step = same & ~on
            at_i[up[step]], at_j[up[step]] = after_a[step], after_b[step]
            climbs = on | (step & level_with)
            turned[up[~climbs]] = number
            up = up[climbs]
            if not len(up):
                break
        for number in range(turned.max(initial=-1), -1, -1):
            level = self.levels[number]
            here = np.flatnonzero(turned >= number)
            while len(here):
                same, _, _, after_a, after_b, _ = level.forward(at_i[here], at_j[here])
                here = here[same]
                at_i[here], at_j[here] = after_a[same], after_b[same]
        return at_i - i


def _divisor_pairs(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All grid pairs (i, i + q) below n by their second place, and how many there are
    up to each second place."""
    q = np.concatenate([np.full((n - 1) // q, q) for q in range(1, n)])
    j = np.concatenate([np.arange(q, n, q) for q in range(1, n)])
    order = np.argsort(j, kind="stable")
    j, q = j[order], q[order]
    return j - q, j, np.searchsorted(j, np.arange(n + 1))


_GRID: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []


def grid(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The grid pairs of a text of n words, in lists of bounded length."""
    if n <= GRID_WORDS:
        if not _GRID:
            _GRID.append(_divisor_pairs(GRID_WORDS))
        i, j, upto = _GRID[0]
        yield i[: upto[n]], j[: upto[n]]
        return
    low = 1
    while low <= n // 2:
        # Every period from `low` on has at most n / low pairs.
        high = min(n // 2 + 1, low + max(1, GRID_PAIRS * low // n))
        for first in range(0, (n - 1) // low, GRID_PAIRS):
            periods = np.arange(low, high)
            counts = np.clip((n - 1) // periods - first, 0, GRID_PAIRS)
            q = np.repeat(periods, counts)
            place = np.arange(len(q)) - np.repeat(np.cumsum(counts) - counts, counts) + first
            yield place * q, (place + 1) * q
        low = high


def _candidates(text: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid pairs of one text whose words are equal, with enough equal ones around them.

    The separator after the n words, which is also before the first one by Python's
    count from the end, equals no word.
    """
    for i, j in grid(n):
        equal = np.flatnonzero(text[i] == text[j])
        if not len(equal):
            continue
        i, j = i[equal], j[equal]
        matches = np.ones(len(i), np.int64)
        for direction in (1, -1):
            alive = np.arange(len(i))
            for step in range(1, LEAST_MATCHES):
                a, b = i[alive] + direction * step, j[alive] + direction * step
                alive = alive[text[a] == text[b]]
                if not len(alive):
                    break
                matches[alive] += 1
        enough = matches >= LEAST_MATCHES
        if enough.any():
            yield i[enough], j[enough]


class _Extender:
    """Extends grid pairs of a list of symbols to the whole stretch, in both directions."""

    def __init__(self, text: np.ndarray, n_words: int, n_letters: int):
        self._forward = Grammar(text, n_words, n_letters)
        # Behind a place lies what is ahead of it in the reversed text. There a separator
        # comes before its words; the last text is closed by the one that came first.
        backward = np.append(text[::-1][1:], text[-1])
        self._backward = Grammar(backward, n_words, n_letters)
        self._last = len(text) - 2

    def runs(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Runs (start, length, period) with these pairs, each once; the period need not
        be the least one."""
        period = j - i
        order = np.lexsort((i, period))
        i, j, period = i[order], j[order], period[order]
        ahead = self._forward.common(i, j)
        # A pair that the one before it on its grid reaches lies in the same stretch.
        reached = np.zeros(len(i), bool)
        reached[1:] = (period[1:] == period[:-1]) & (i[1:] == j[:-1]) & (ahead[:-1] >= period[:-1])
        i, j, period, ahead = (x[~reached] for x in (i, j, period, ahead))
        behind = self._backward.common(self._last - (j - 1), self._last - (i - 1))
        start, length = i - behind, behind + period + ahead
        enough = length >= np.maximum(MIN_WORDS, 2 * period)
        return np.unique(np.stack((start, length, period), 1)[enough], axis=0)


def _with_least_period(rows: np.ndarray) -> np.ndarray:
    """Each stretch with the least of its periods; the others are multiples of that."""
    rows = np.unique(rows, axis=0)
    least = np.ones(len(rows), bool)
    least[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    rows = rows[least]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _runs_of_long(text: np.ndarray, n_words: int, n_letters: int) -> np.ndarray:
    """Runs of one text, its pairs extended list by list."""
    extender, rows = None, np.empty((0, 3), np.int64)
    for i, j in _candidates(text, len(text) - 1):
        extender = extender or _Extender(text, n_words, n_letters)
        rows = _with_least_period(np.concatenate((rows, extender.runs(i, j))))
    return rows


def _runs_of_short(
    texts: dict[int, np.ndarray], n_words: int, n_letters: int
) -> dict[int, np.ndarray]:
    """Runs of texts that have one list of pairs each, all in one grammar."""
    pairs = {}
    for number, text in texts.items():
        for pair in _candidates(text, len(text) - 1):
            pairs[number] = pair
    if not pairs:
        return {}
    # The grammar holds only the texts with candidates.
    starts = np.cumsum([0] + [len(texts[k]) for k in pairs])
    i, j = (
        np.concatenate([pair[side] + at for pair, at in zip(pairs.values(), starts, strict=False)])
        for side in (0, 1)
    )
    whole = np.concatenate([texts[k] for k in pairs])
    rows = _with_least_period(_Extender(whole, n_words, n_letters).runs(i, j))
    bounds = np.searchsorted(rows[:, 0], starts)
    return {
        k: rows[bounds[n] : bounds[n + 1]] - [starts[n], 0, 0] for n, k in enumerate(pairs)
    }


def find_runs(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Runs of each list of words, as rows (start, length, period) by start, then period."""
    lengths = np.array([len(t) for t in texts], np.int64)
    flat = np.empty(int(lengths.sum()), object)
    flat[:] = [word for words in texts for word in words]
    codes, distinct = pd.factorize(flat)
    n_words, n_letters = len(distinct), len(distinct) + len(texts)
    # Each text is followed by a separator of its own.
    ends = np.cumsum(lengths + 1)
    symbols = np.insert(codes.astype(np.int64), np.cumsum(lengths), n_words + np.arange(len(texts)))
    runs = [np.empty((0, 3), np.int64)] * len(texts)
    short = {}
    for number, (end, n) in enumerate(zip(ends.tolist(), lengths.tolist(), strict=True)):
        if n > GRID_WORDS:
            runs[number] = _runs_of_long(symbols[end - n - 1 : end], n_words, n_letters)
        elif n >= MIN_WORDS:
            short[number] = symbols[end - n - 1 : end]
    for number, rows in _runs_of_short(short, n_words, n_letters).items():
        runs[number] = rows
    return runs


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by blanks, of each run only the first period."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[k] for k in kept.tolist()])


_SCHEMA = pa.schema(
    [
        ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([(n, pa.int64()) for n in RUN]))),
        ("collapsed", pa.string()),
    ]
)


def _group_batch(ids: list, texts: list[list[bytes]], id_type: pa.DataType) -> pa.RecordBatch:
    runs = find_runs(texts)
    rows = np.concatenate(runs)
    ends = np.cumsum([len(r) for r in runs])
    structs = pa.StructArray.from_arrays(
        [pa.array(rows[:, k]) for k in range(3)], fields=list(_SCHEMA.field("runs").type.value_type)
    )
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), structs)
    short = [collapsed(t, r) for t, r in zip(texts, runs, strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, id_type),
            pa.array([len(t) for t in texts], pa.int64()),
            lists,
            pa.array(short, pa.binary()).cast(pa.string()),
        ],
        names=["doc_id", *_SCHEMA.names],
    )


def periodic_runs(docs: DataFrame, arrange: Arrange | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of each row of `docs`.

    `runs` has (start, length, period) in words by start, then period; `collapsed` is the
    text without the words that any run holds after its first period. `arrange` may give
    another order of a text's words first. Null and empty texts have no words and no runs;
    repeated rows and null ids stay rows of their own; no rows give none; extra columns
    are left out. A text is worked on as a whole, its grid pairs in lists of bounded
    length. Rows do not meet, so nothing is shuffled.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held = [], [], 0
            column = batch.column("doc_id")
            for key, text in zip(column.to_pylist(), texts_of(batch), strict=True):
                words = raw_words(text)
                order = arrange(key, len(words)) if arrange else None
                if order is not None:
                    words = [words[k] for k in order.tolist()]
                ids.append(key)
                texts.append(words)
                held += len(words)
                if held >= GROUP_WORDS:
                    yield _group_batch(ids, texts, column.type)
                    ids, texts, held = [], [], 0
            if ids:
                yield _group_batch(ids, texts, column.type)

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_words bigint, runs {RUNS}, collapsed string"
    )


def longest_run(runs: Column) -> Column:
    """The run with most words; of equal ones the first, then that of the least period."""
    ordered = F.transform(
        runs, lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"], r.alias("run"))
    )
    return F.array_max(ordered)["run"]


def run_lines(runs: Column) -> Column:
    """`start,length,period` and a line end for each run."""
    line = F.transform(
        runs, lambda r: F.concat(F.concat_ws(",", *[r[n].cast("string") for n in RUN]), F.lit("\n"))
    )
    return F.array_join(line, "")
