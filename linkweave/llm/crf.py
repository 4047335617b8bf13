"""Linear-chain conditional random field over word shapes, trained and decoded in numpy.

Texts are cut into tokens (runs of letters, runs of digits, single symbols) and units that
end at a line end or a sentence end; a unit is one chain. A token's features are the shapes
of the five tokens around it, the pairs of its shape with its neighbours', and those of the
five words that occur in the labelled table. Nothing else about a word is known.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

# Numbers of shapes, twice: a token after white space has a shape of its own.
SHAPES = 512
PAIR_BUCKETS = 1 << 13
REACH = 2

# A word that the labelled table has so often is a feature of its own.
KNOWN_TIMES = 8

# Steps of the training, their size, and the pull of weights to zero.
STEPS = 80
RATE = 0.15
DECAY = 2e-3

# White space beyond ASCII, and the dashes and quotes of U+2010 to U+2027.
_BLANKS = [0x85, 0xA0, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x3000]
_MARKS = (0x2010, 0x2028)
_SPACE, _LOWER, _UPPER, _DIGIT, _SYMBOL = range(5)
_KINDS = np.full(0x3001, _LOWER, np.uint8)
_KINDS[:0x80] = _SYMBOL
_KINDS[:0x21] = _SPACE
_KINDS[ord("a") : ord("z") + 1] = _LOWER
_KINDS[ord("A") : ord("Z") + 1] = _UPPER
_KINDS[ord("0") : ord("9") + 1] = _DIGIT
_KINDS[_MARKS[0] : _MARKS[1]] = _SYMBOL
_KINDS[_BLANKS] = _SPACE
_ENDS = np.array([ord(c) for c in ".!?"])
_NEVER = -1e4


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Tokens(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    shape: np.ndarray
    word: np.ndarray  # hash of the lower-case letters, 0 for other tokens
    units: np.ndarray  # number of the first token of each unit


def tokens_of(points: np.ndarray) -> Tokens:
    """Tokens of a text and the chains they form."""
    kind = _KINDS[np.minimum(points, len(_KINDS) - 1)]
    group = np.where(kind == _UPPER, _LOWER, kind)
    new = np.ones(len(points), bool)
    new[1:] = (group[1:] != group[:-1]) | (group[1:] == _SYMBOL)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(points))
    solid = group[first] != _SPACE
    start, end = first[solid], last[solid]
    if not len(start):
        none = np.empty(0, np.int64)
        return Tokens(none, none, none, none.astype(np.uint64), none)
    length = end - start
    token_kind = group[start]

    upper = np.concatenate(([0], np.cumsum(kind == _UPPER)))
    uppers = upper[end] - upper[start]
    title = (kind[start] == _UPPER) & (uppers == 1)
    case = np.where(uppers == 0, 0, np.where(title, 1, np.where(uppers == length, 2, 3)))
    letters = 4 * (np.minimum(length, 8) - 1) + case  # 0 to 31
    value = points[start].astype(np.int64) - ord("0")
    for k in (1, 2):
        more = (token_kind == _DIGIT) & (length > k)
        digit = points[np.minimum(start + k, len(points) - 1)].astype(np.int64) - ord("0")
        value = np.where(more, 10 * value + digit, value)
    small = (length <= 3) & (value <= 255)
    digits = 32 + 2 * (np.minimum(length, 20) - 1) + small  # 32 to 71
    symbols = 72 + np.minimum(points[start], 0x80)  # 72 to 200
    shape = np.where(
        token_kind == _DIGIT, digits, np.where(token_kind == _SYMBOL, symbols, letters)
    )
    gap = np.ones(len(start), bool)
    gap[1:] = start[1:] > end[:-1]
    shape = 1 + 2 * shape + gap

    # Hash of the letters: a sum of powers, each letter in lower case.
    lower = points.astype(np.uint64) + np.where(kind == _UPPER, 32, 0).astype(np.uint64)
    place = np.arange(len(points)) - np.repeat(first, last - first)
    powers = np.full(64, 0x9E3779B97F4A7C15, np.uint64)
    powers = np.cumprod(powers, dtype=np.uint64)
    sums = np.concatenate(([0], np.cumsum(lower * powers[place % 64], dtype=np.uint64)))
    word = sums[end] - sums[start] + length.astype(np.uint64)
    word = np.where(token_kind == _LOWER, word, np.uint64(0))

    # A unit ends with a line, or with . ! ? before white space and a letter.
    line = np.concatenate(([0], np.cumsum((points == 10) | (points == 13))))
    begins = np.ones(len(start), bool)
    after_line = line[start[1:]] > line[end[:-1]]
    after_sentence = (
        np.isin(points[start[:-1]], _ENDS) & gap[1:] & (token_kind[1:] == _LOWER)
    )
    begins[1:] = after_line | after_sentence
    return Tokens(start, end, shape, word, np.flatnonzero(begins))


class Crf:
    """Weights of the features and of the steps between labels; the first label is "none"."""

    def __init__(self, labels: list[str], words: np.ndarray):
        self.labels = labels
        self.words = np.sort(words)
        n_words = len(words) + 1
        sizes = [SHAPES] * (2 * REACH + 1) + [PAIR_BUCKETS] * 2 + [n_words] * (2 * REACH + 1)
        self._bases = np.concatenate(([0], np.cumsum(sizes)))
        self.weights = np.zeros((self._bases[-1], len(labels)), np.float32)
        n = len(labels)
        # steps[a, b]: from label a to b; first[b]: a unit begins with b.
        self.steps, self.first = np.zeros((n, n), np.float32), np.zeros(n, np.float32)
        self.allowed = np.ones((n, n), bool)
        for b, label in enumerate(labels):
            if label.startswith("I-"):
                same = [x[2:] == label[2:] for x in labels]
                self.allowed[:, b] = same
        self.may_begin = np.array([not x.startswith("I-") for x in labels])

    def features(self, tokens: Tokens) -> list[np.ndarray]:
        """Row numbers of the weights of each token, one list for each kind of feature."""
        n = len(tokens.start)
        unit = np.zeros(n, np.int64)
        unit[tokens.units[1:]] = 1
        unit = np.cumsum(unit)
        at = np.minimum(np.searchsorted(self.words, tokens.word), max(len(self.words) - 1, 0))
        known = self.words[at] == tokens.word if len(self.words) else np.zeros(n, bool)
        word = np.where(known, at + 1, 0)

        def moved(values: np.ndarray, by: int) -> np.ndarray:
            """Values of the tokens `by` places on, 0 beyond the unit."""
            out = np.zeros(n, np.int64)
            if by == 0:
                return values.astype(np.int64)
            here, there = (slice(0, -by), slice(by, n)) if by > 0 else (slice(-by, n), slice(0, by))
            out[here] = np.where(unit[here] == unit[there], values[there], 0)
            return out

        places = range(-REACH, REACH + 1)
        shapes = {k: moved(tokens.shape, k) for k in places}
        pairs = [shapes[k] * SHAPES + shapes[k + 1] for k in (-1, 0)]
        rows = [shapes[k] for k in places]
        rows += [(p * 40503 + (p >> 7)) % PAIR_BUCKETS for p in pairs]
        rows += [moved(word, k) for k in places]
        return [r + base for r, base in zip(rows, self._bases, strict=False)]

    def emissions(self, tokens: Tokens) -> np.ndarray:
        total = np.zeros((len(tokens.start), len(self.labels)), np.float32)
        for rows in self.features(tokens):
            total += self.weights[rows]
        return total

    def _scores(self) -> tuple[np.ndarray, np.ndarray]:
        return (
            np.where(self.allowed, self.steps, _NEVER),
            np.where(self.may_begin, self.first, _NEVER),
        )

    def decode(self, tokens: Tokens) -> np.ndarray:
        """The best label of each token, by Viterbi over all units at once."""
        emissions = self.emissions(tokens)
        labels = np.zeros(len(emissions), np.int64)
        if not len(emissions):
            return labels
        steps, first = self._scores()
        ends = np.append(tokens.units[1:], len(emissions))
        # A stretch of other labels changes one step more than it has tokens. Where every
        # token loses more than two of the best such steps win, the best path has none.
        gain = emissions[:, 1:].max(1) - emissions[:, 0]
        best_step = max(0.0, float(max((steps - steps[0, 0]).max(), (first - first[0]).max())))
        wanted = np.flatnonzero(np.maximum.reduceat(gain, tokens.units) + 2 * best_step >= 0)
        starts, lengths = tokens.units[wanted], (ends - tokens.units)[wanted]
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        if not len(starts):
            return labels
        score = first + emissions[starts]
        back = []
        for t in range(1, lengths[0]):
            n = np.searchsorted(-lengths, -t)
            ways = score[:n, :, None] + steps
            back.append(ways.argmax(1).astype(np.uint8))
            score[:n] = ways.max(1) + emissions[starts[:n] + t]
        label = score.argmax(1)
        for t in range(lengths[0] - 1, -1, -1):
            n = np.searchsorted(-lengths, -t) if t else len(lengths)
            labels[starts[:n] + t] = label[:n]
            if t:
                label[:n] = back[t - 1][np.arange(n), label[:n]]
        return labels

    def loss(self, tokens: Tokens, gold: np.ndarray):
        """Negative log-likelihood of the labels, and its slopes by emission, step and start."""
        emissions = self.emissions(tokens).astype(np.float64)
        steps, first = (x.astype(np.float64) for x in self._scores())
        n, k = emissions.shape
        ends = np.append(tokens.units[1:], n)
        lengths = ends - tokens.units
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = tokens.units[order], lengths[order]
        ahead, behind = np.empty((n, k)), np.zeros((n, k))
        ahead[starts] = first + emissions[starts]
        for t in range(1, lengths[0]):
            at = starts[: np.searchsorted(-lengths, -t)] + t
            ahead[at] = _log_sum(ahead[at - 1][:, :, None] + steps, 1) + emissions[at]
        for t in range(lengths[0] - 1, 0, -1):
            at = starts[: np.searchsorted(-lengths, -t)] + t
            behind[at - 1] = _log_sum(steps + (emissions[at] + behind[at])[:, None, :], 2)
        total = _log_sum(ahead[starts + lengths - 1], 1)
        whole = np.empty(n)
        whole[np.concatenate([np.arange(s, s + m) for s, m in zip(starts, lengths, strict=True)])] = (
            np.repeat(total, lengths)
        )
        by_emission = np.exp(ahead + behind - whole[:, None])
        inner = np.ones(n, bool)
        inner[starts] = False
        at = np.flatnonzero(inner)
        both = np.exp(
            ahead[at - 1][:, :, None] + steps + (emissions[at] + behind[at])[:, None, :]
            - whole[at][:, None, None]
        )
        by_step, by_first = both.sum(0), by_emission[starts].sum(0)
        path = emissions[np.arange(n), gold].sum() + first[gold[starts]].sum()
        path += steps[gold[at - 1], gold[at]].sum()
        by_emission[np.arange(n), gold] -= 1
        np.add.at(by_step, (gold[at - 1], gold[at]), -1)
        np.add.at(by_first, gold[starts], -1)
        return total.sum() - path, by_emission, by_step, by_first

    def fit(self, tokens: Tokens, gold: np.ndarray) -> Crf:
        """Minimise the loss over all units by adaptive gradient steps."""
        rows = self.features(tokens)
        kinds, rows = len(rows), np.concatenate(rows)
        n_units = len(tokens.units)
        values = [self.weights, self.steps, self.first]
        means = [np.zeros(v.shape) for v in values]
        squares = [np.zeros(v.shape) for v in values]
        for turn in range(1, STEPS + 1):
            _, by_emission, by_step, by_first = self.loss(tokens, gold)
            by_weight = np.stack(
                [np.bincount(rows, np.tile(x, kinds), len(self.weights)) for x in by_emission.T], 1
            )
            for value, slope, mean, square in zip(
                values, (by_weight, by_step, by_first), means, squares, strict=True
            ):
                slope = slope / n_units + DECAY * value
                mean += 0.1 * (slope - mean)
                square += 0.01 * (slope * slope - square)
                step = mean / (1 - 0.9**turn) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
                value -= (RATE * step).astype(np.float32)
        return self


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis, keepdims=True)
    return np.log(np.exp(values - top).sum(axis)) + top.squeeze(axis)


def train(texts: list[str], spans: list[list[tuple[str, int, int]]], kinds: list[str]) -> Crf:
    """A field for spans (kind, start, end) of some kinds, from labelled texts."""
    labels = ["O", *[f"{p}-{kind}" for kind in kinds for p in "BI"]]
    number = {label: k for k, label in enumerate(labels)}
    # One text after the other, each a unit of its own or several.
    whole, marks = "", []
    for text, found in zip(texts, spans, strict=True):
        marks += [(kind, len(whole) + a, len(whole) + b) for kind, a, b in found]
        whole += text + "\n"
    tokens = tokens_of(code_points(whole))
    gold = np.zeros(len(tokens.start), np.int64)
    for kind, a, b in marks:
        inside = np.flatnonzero((tokens.start >= a) & (tokens.end <= b))
        gold[inside] = number[f"I-{kind}"]
        gold[inside[:1]] = number[f"B-{kind}"]
    words, times = np.unique(tokens.word, return_counts=True)
    return Crf(labels, words[(words > 0) & (times >= KNOWN_TIMES)]).fit(tokens, gold)


def spans_of(crf: Crf, tokens: Tokens, labels: np.ndarray) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) of decoded tokens, in order."""
    found: list[tuple[str, int, int]] = []
    for k in np.flatnonzero(labels).tolist():
        name = crf.labels[labels[k]]
        if name.startswith("B-"):
            found.append((name[2:], int(tokens.start[k]), int(tokens.end[k])))
        else:
            kind, start, _ = found[-1]
            found[-1] = (kind, start, int(tokens.end[k]))
    return found
