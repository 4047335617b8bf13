"""Benchmark items inside documents, within an error budget.

An item that may differ in k edits is cut into k + 1 pieces; one of them must occur
unchanged. The pieces form a tree: a part with budget k is cut into two whose budgets add
up to k - 1, so that one of the two keeps within its own budget. An exact hit of a leaf
climbs the tree, and at each step a bit-parallel edit distance checks the larger part in
the text around the hit. Most chance hits end at the first step.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.text import record_batches, texts_of

# Edits allowed per character of an item.
ERROR_RATE = 0.1

# Characters of benchmark items that are searched for in one pass over the documents.
BLOCK_CHARS = 4_000_000


def normalised(text: str | None) -> str:
    """Lower case, with one blank between words."""
    return " ".join(text.lower().split()) if text else ""


class Part(NamedTuple):
    """A stretch of an item with its budget; up is the part it was cut from."""

    low: int
    high: int
    budget: int
    up: Part | None


def leaves(low: int, high: int, budget: int, up: Part | None = None) -> Iterator[Part]:
    """The budget + 1 pieces of a stretch, of about equal length."""
    part = Part(low, high, budget, up)
    if budget == 0:
        yield part
        return
    left = (budget - 1) // 2
    cut = low + (high - low) * (left + 1) // (budget + 1)
    yield from leaves(low, cut, left, part)
    yield from leaves(cut, high, budget - 1 - left, part)


def _beside(text: str, leaf: Part) -> tuple[int, int, tuple[str, ...]]:
    """Where the other half of a leaf's parent lies, and pieces of which one must be there.

    The pieces are again one more than the parent's budget.
    """
    if leaf.up is None:
        return 0, 0, ()
    parent, right = leaf.up, leaf.low == leaf.up.low
    low, high = (leaf.high, parent.high) if right else (parent.low, leaf.low)
    cuts = [low + (high - low) * n // (parent.budget + 1) for n in range(parent.budget + 2)]
    pieces = tuple(text[a:b] for a, b in zip(cuts, cuts[1:], strict=False))
    if right:
        return 0, high - leaf.low + parent.budget, pieces
    return leaf.low - low + parent.budget, 0, pieces


def letter_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for k, letter in enumerate(pattern):
        masks[letter] = masks.get(letter, 0) | 1 << k
    return masks


def best_match(masks: dict[str, int], size: int, text: str) -> tuple[int, int]:
    """Least edit distance of a pattern to any substring, and that substring's end.

    The column of the distance table is kept as two bit vectors of differences, so that a
    character takes a few operations on integers of the pattern's length.
    """
    full = (1 << size) - 1
    top = 1 << (size - 1)
    up, down = full, 0
    distance = best = size
    end = 0
    for place, letter in enumerate(text, 1):
        same = masks.get(letter, 0)
        vertical = same | down
        across = (((same & up) + up) ^ up) | same
        rise = down | (full & ~(across | up))
        fall = up & across
        if rise & top:
            distance += 1
        elif fall & top:
            distance -= 1
        rise = (rise << 1) & full
        up = ((fall << 1) & full) | (full & ~(vertical | rise))
        down = rise & vertical
        if distance < best:
            best, end = distance, place
    return best, end


class Matcher:
    """Finds every item of a block in a text."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        pieces: dict[str, list[tuple[int, Part, tuple]]] = {}
        self.items = [(item_id, text) for item_id, text in items if text]
        for number, (_, text) in enumerate(self.items):
            for leaf in leaves(0, len(text), int(error_rate * len(text))):
                piece = text[leaf.low : leaf.high]
                pieces.setdefault(piece, []).append((number, leaf, _beside(text, leaf)))
        self.masks: dict[tuple[int, int, int], dict[str, int]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        if pieces:
            self.automaton.make_automaton()
        self.empty = not pieces

    def _distance(self, number: int, part: Part, text: str) -> tuple[int, int]:
        name = (number, part.low, part.high)
        if name not in self.masks:
            self.masks[name] = letter_masks(self.items[number][1][part.low : part.high])
        return best_match(self.masks[name], part.high - part.low, text)

    def find(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of matches; start is where the budget allows it.

        Overlapping matches of one item are reported once, with the first one found.
        """
        if self.empty:
            return
        done: dict[int, int] = {}
        for last, (size, places) in self.automaton.iter(text):
            at = last + 1 - size
            for number, leaf, (reach_left, reach_right, beside) in places:
                near = text[max(0, at - reach_left) : at + reach_right]
                if beside and not any(p in near for p in beside):
                    continue
                item_id, item = self.items[number]
                if at - leaf.low < done.get(number, -1):
                    continue
                distance, begin, end = 0, at, at + size
                part = leaf.up
                while part is not None:
                    begin = max(0, at - (leaf.low - part.low) - part.budget)
                    window = text[begin : at + (part.high - leaf.low) + part.budget]
                    distance, end = self._distance(number, part, window)
                    if distance > part.budget:
                        break
                    end += begin
                    part = part.up
                else:
                    start = max(0, end - len(item))
                    done[number] = end
                    yield item_id, distance, start, end


def item_blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items in blocks of bounded size; null and blank ones are left out."""
    held: list[tuple[int, str]] = []
    size = 0
    rows = benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator()
    for row in rows:
        text = normalised(row.text)
        if not text:
            continue
        if held and size + len(text) > block_chars:
            yield held
            held, size = [], 0
        held.append((row.item_id, text))
        size += len(text)
    if held:
        yield held


_MATCH = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("item_id", pa.int64()),
        ("distance", pa.int32()),
        ("start", pa.int64()),
        ("end", pa.int64()),
    ]
)


def _matches(items: list[tuple[int, str]], error_rate: float):
    def rows(batches):
        matcher = Matcher(items, error_rate)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, texts_of(batch), strict=True):
                for match in matcher.find(normalised(text)):
                    yield doc_id, *match

    return lambda batches: record_batches(rows(batches), _MATCH)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    error_rate: float = ERROR_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Every benchmark item found in a document: (doc_id, item_id, distance, start, end).

    Texts are compared in lower case with single blanks; start and end are places in that
    form of the document, and an item of n characters may differ by floor(error_rate * n)
    edits. The benchmark is read in blocks of `block_chars`, one pass over the documents
    for each, so that what a task holds is bounded.

    Null and empty documents match nothing, and so do null and blank items. A repeated row
    repeats its matches, a repeated item id is matched by each of its texts. An empty
    table on either side gives no rows. Other columns are not read.
    """
    found = None
    for items in item_blocks(benchmark, block_chars):
        part = docs.select("doc_id", "text").mapInArrow(
            _matches(items, error_rate),
            "doc_id bigint, item_id bigint, distance int, start bigint, end bigint",
        )
        found = part if found is None else found.unionAll(part)
    if found is None:
        empty = "doc_id bigint, item_id bigint, distance int, start bigint, end bigint"
        return docs.sparkSession.createDataFrame([], empty)
    return found


def _clean(items: list[tuple[int, str]], error_rate: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items, error_rate)
        for batch in batches:
            clean = [next(matcher.find(normalised(t)), None) is None for t in texts_of(batch)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    error_rate: float = ERROR_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The documents without any match of `contamination`, all columns kept.

    Null and empty documents stay. Nothing is shuffled.
    """
    for items in item_blocks(benchmark, block_chars):
        docs = docs.mapInArrow(_clean(items, error_rate), docs.schema)
    return docs
