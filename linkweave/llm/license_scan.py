"""License notices in documents, by MinHash bands over text windows.

Each text is seen through overlapping windows of words. Templates are cut into pieces that
fit into a window whole wherever they stand. A window that holds a piece of m shingles has
a Jaccard similarity of at least m / w to it, w being the shingles of a window; with single
rows as bands, at least one of the bands agrees with probability 1 - (1 - m / w)**bands.
What is retrieved is verified by the exact containment of the template's shingles in the
text around the window.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from linkweave.llm.license_texts import NOTICES
from linkweave.llm.text import GOLDEN, WordHashes, mix, raw_words, record_batches, shingles, texts_of

# Words of a shingle and share of a template's shingles that make a match.
SHINGLE_WORDS = 3
CONTAINMENT = 0.8

# Shingles between the starts of windows; a window is three times as long. A piece of up
# to 9 shingles (8 after the first) fits into some window whole.
STRIDE = 4
WINDOW = 3 * STRIDE
PIECE = WINDOW - STRIDE + 1

# The shortest template has 3 shingles: it is missed with probability (1 - 3/12)**48, one
# in a million.
BANDS = 48

# Shingles of a notice that words may be put into.
LONG = 20

# Words that are scanned together.
SLICE_WORDS = 1 << 16


class PlainWordHashes(WordHashes):
    """Words without case and without anything but letters and digits."""

    def form(self, word: bytes) -> bytes:
        plain = word.decode().lower()
        return (plain if plain.isalnum() else re.sub(r"[\W_]+", "", plain)).encode()


def plain_words(text: str | None, hashes: PlainWordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words that have letters or digits, and their places among all words.

    The marks of a comment stand alone at the start of a line and are no words of a notice.
    """
    words = hashes.of(raw_words(text))
    places = np.flatnonzero(words != hashes[b""])
    return words[places], places


class Templates(NamedTuple):
    """Shingle sets of the templates, and the bands of their pieces in order."""

    names: list[str]
    shingles: list[np.ndarray]
    words: list[int]
    keys: list[np.ndarray]  # of each band, the minima of the pieces in order
    of: list[np.ndarray]  # the template of each minimum
    marks: np.ndarray  # of each band, which low bits occur in the minima


def _bands() -> np.ndarray:
    return mix(np.arange(1, BANDS + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)


def _ranks(hashes: np.ndarray, band: np.uint64) -> np.ndarray:
    """Another order of the shingles for each band."""
    product = hashes * band
    return product ^ (product >> np.uint64(29))


def _low_bits(minima: np.ndarray) -> np.ndarray:
    return (minima & np.uint64(0xFFFF)).astype(np.int64)


def templates_of(notices: Iterable[tuple[str, str]]) -> Templates:
    hashes = PlainWordHashes()
    names, sets, words, pieces = [], [], [], []
    for name, text in notices:
        own, _ = plain_words(text, hashes)
        found = shingles(own, SHINGLE_WORDS)
        if not len(found):
            continue
        starts = list(range(0, max(1, len(found) - PIECE + 1), PIECE))
        if starts[-1] + PIECE < len(found):
            starts.append(len(found) - PIECE)
        pieces += [(len(names), found[start : start + PIECE]) for start in starts]
        names.append(name)
        sets.append(np.unique(found))
        words.append(len(own))
    keys, of = [], []
    marks = np.zeros((BANDS, 1 << 16), bool)
    owners = np.array([number for number, _ in pieces], np.int64)
    for band, factor in enumerate(_bands()):
        minima = np.array([_ranks(piece, factor).min() for _, piece in pieces], np.uint64)
        order = np.argsort(minima, kind="stable")
        keys.append(minima[order])
        of.append(owners[order])
        marks[band, _low_bits(minima)] = True
    return Templates(names, sets, words, keys, of, marks)


def candidates(found: np.ndarray, templates: Templates) -> np.ndarray:
    """(template, first shingle of the window), one row per window and template.

    The shingles may be those of several texts, each padded to whole strides. Windows also
    begin before the first and end after the last one.
    """
    pairs = []
    for band, factor in enumerate(_bands()):
        least = _ranks(found, factor).reshape(-1, STRIDE).min(axis=1)
        wide = np.r_[np.repeat(least[:1], 2), least, np.repeat(least[-1:], 2)]
        minima = np.minimum(np.minimum(wide[:-2], wide[1:-1]), wide[2:])
        likely = np.flatnonzero(templates.marks[band][_low_bits(minima)])
        keys = templates.keys[band]
        low = np.searchsorted(keys, minima[likely], side="left")
        high = np.searchsorted(keys, minima[likely], side="right")
        for hit in np.flatnonzero(high > low):
            for key in range(low[hit], high[hit]):
                pairs.append((templates.of[band][key], (likely[hit] - 2) * STRIDE))
    return np.unique(np.array(pairs, np.int64).reshape(-1, 2), axis=0)


def _padded(found: np.ndarray) -> np.ndarray:
    """Whole strides; the last shingle repeated changes no minimum."""
    return np.r_[found, np.repeat(found[-1:], -len(found) % STRIDE)]


def matches(texts: list[np.ndarray], templates: Templates, containment: float):
    """(text, template, containment, first word, words) of the matches in several texts.

    `texts` are hashes of plain words. Matches of a template do not overlap.
    """
    found = [shingles(words, SHINGLE_WORDS) for words in texts]
    padded = [_padded(f) for f in found]
    ends = np.cumsum([len(p) for p in padded])
    if not len(ends) or not ends[-1]:
        return
    hits = candidates(np.concatenate(padded), templates)
    stretches: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for number, start in hits.tolist():
        # The window may reach into neighbouring texts.
        inside = np.clip([start, start + WINDOW - 1], 0, ends[-1] - 1)
        first, last = np.searchsorted(ends, inside, side="right")
        reach = templates.words[number] + _slack(len(templates.shingles[number]), containment)
        for text in range(first, last + 1):
            at = start - int(ends[text - 1] if text else 0)
            low, high = max(0, at - reach), min(len(found[text]), at + WINDOW + reach)
            joined = stretches.setdefault((text, number), [])
            # Windows of a template come in order of their starts.
            if joined and low <= joined[-1][1]:
                joined[-1] = (joined[-1][0], max(high, joined[-1][1]))
            else:
                joined.append((low, high))
    for (text, number), joined in sorted(stretches.items()):
        # A text or template of fewer words than a shingle has one of all its words.
        size = min(SHINGLE_WORDS, len(texts[text]))
        for low, high in joined:
            for first, last, share in _verified(found[text][low:high], number, templates, containment):
                yield text, number, share, low + first, last - first + size


def _slack(n_shingles: int, containment: float) -> int:
    """Words that may be put into a notice: no more than the shingles it may lack.

    None into a short one, where a word more may name another license.
    """
    return int((1 - containment) * n_shingles + 1e-9) if n_shingles >= LONG else 0


def _verified(
    found: np.ndarray, number: int, templates: Templates, containment: float
) -> Iterator[tuple[int, int, float]]:
    """(first shingle, last shingle, share) of the places that hold enough of a template.

    From left to right, none overlapping. A place has the template's length, and some words
    more only if it does not hold enough otherwise.
    """
    wanted = templates.shingles[number]
    length = max(1, templates.words[number] - SHINGLE_WORDS + 1)
    slack = _slack(len(wanted), containment)
    at = np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)
    own = wanted[at] == found
    # Enough shingles, repeated ones counted again: few places are left to look at.
    sums = np.r_[0, np.cumsum(own)]
    ends = np.minimum(np.arange(len(found)) + length + slack, len(found))
    likely = np.flatnonzero(own & (sums[ends] - sums[:-1] >= containment * len(wanted) - 1e-9))

    def place(first: int) -> tuple[float, int, int, int] | None:
        for size in (length, length + slack):
            spots = first + np.flatnonzero(own[first : first + size])
            new = spots[np.unique(at[spots], return_index=True)[1]]
            share = len(new) / len(wanted)
            if share >= containment:
                last = int(new.max())
                return share, first - last, -first, last
        return None

    free = 0
    for first in likely.tolist():
        if first < free:
            continue
        best = place(first)
        if not best:
            continue
        # A stray shingle may stand just before the notice.
        near = likely[(likely > first) & (likely <= first + slack)].tolist()
        best = max([best, *filter(None, map(place, near))])
        share, _, start, last = best
        yield -start, last, share
        free = last + SHINGLE_WORDS


def best_of_places(rows: list[tuple], templates: Templates) -> list[bool]:
    """Whether no other match at the place of each one holds more of its template.

    `rows` are the matches in a text. Those that share half of the shorter one's words are at
    one place. What counts is the number of shingles, so that a notice wins over another that
    is its beginning; among equal numbers it is the containment.
    """
    order = sorted(range(len(rows)), key=lambda k: rows[k][3])
    worth = [(round(row[2] * len(templates.shingles[row[1]])), row[2]) for row in rows]
    best = [True] * len(rows)
    held: list[int] = []
    for k in order:
        first, length = rows[k][3:]
        held = [x for x in held if rows[x][3] + rows[x][4] > first]
        for x in held:
            shared = min(rows[x][3] + rows[x][4], first + length) - first
            if 2 * shared >= min(rows[x][4], length) and worth[x] != worth[k]:
                best[min(x, k, key=worth.__getitem__)] = False
        held.append(k)
    return best


_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("license", pa.string()),
        ("template", pa.int32()),
        ("containment", pa.float64()),
        ("first_word", pa.int64()),
        ("n_words", pa.int32()),
        ("best", pa.bool_()),
    ]
)


def _scan(notices: tuple[tuple[str, str], ...], containment: float):
    def rows(batches):
        hashes, templates = PlainWordHashes(), templates_of(notices)
        held: list[tuple[int, np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, texts_of(batch), strict=True):
                held.append((doc_id, *plain_words(text, hashes)))
                size += len(held[-1][1])
                if size >= SLICE_WORDS:
                    yield from found_in(held, templates)
                    held, size = [], 0
        yield from found_in(held, templates)

    def found_in(held, templates):
        texts = [words for _, words, _ in held]
        for text, rows in groupby(matches(texts, templates, containment), itemgetter(0)):
            rows = list(rows)
            doc_id, _, places = held[text]
            for (_, number, share, first, length), best in zip(
                rows, best_of_places(rows, templates), strict=True
            ):
                first, last = int(places[first]), int(places[first + length - 1])
                yield doc_id, templates.names[number], number, share, first, last - first + 1, best

    return lambda batches: record_batches(rows(batches), _FOUND)


def scan_licenses(
    docs: DataFrame,
    notices: tuple[tuple[str, str], ...] = NOTICES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """Every notice found: (doc_id, license, template, containment, first_word, n_words, best).

    Words are compared without case and punctuation, in shingles of three; a template of
    fewer words is one shingle. Words of punctuation only, such as the marks of a comment,
    are passed over, but first_word and n_words count all words of the text, from the first
    to the last one that the template has too. A template may be found several times in a
    document, and two templates of similar wording at the same place: best marks the one
    with most shingles there, such as the version or the variant that the text names.

    Null and empty texts have no notices; a repeated row repeats its matches. No rows, or
    no notices, give no rows. Other columns are not read, and nothing is shuffled.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _scan(tuple(notices), containment),
        "doc_id bigint, license string, template int, containment double, first_word bigint, "
        "n_words int, best boolean",
    )
