"""Log-probability of texts under a hashed maximum-entropy language model.

Frequent training words are leaves of their own; all others share a leaf with the words
of the same hashed ending. Leaves are grouped into classes, and a token's probability is
that of its class, times that of its leaf in the class, times the word's share of the
leaf. The first two are softmaxes over hashed features of the words before: the last word,
the last two leaves, and the leaf before the last alone (a skip). The share is a smoothed
count over the whole training corpus.

Weights are trained in rounds. In each, every task takes gradient steps over its own
documents from the common weights, and the mean of their changes is added to them.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave.llm.adding import PARTS, added_up, parts_of
from linkweave.llm.text import CACHED_WORDS, GOLDEN, WordHashes, mix, texts_of
from linkweave.session import delete_path, scratch_path, settled

# Leaves, in classes of equal size. Leaf 0 is the end of a text; the upper half are endings.
CLASSES = 32
PER_CLASS = 32
LEAVES = CLASSES * PER_CLASS
ENDINGS = LEAVES // 2

# Rows of weights for classes and for leaves, at most 2**16 each, and features of a token.
CLASS_ROWS = 1 << 13
LEAF_ROWS = 1 << 14
FEATURES = 3

ROUNDS = 2
STEP = 0.3
BATCH = 1 << 12

# Tokens that are prepared together.
SLICE = 1 << 15

# Documents that share a dictionary of their words' counts.
CHUNK_BITS = 11

# Blocks in which the tasks' changes are added up.
BLOCKS = 16

# Fixed value: the code of the end token, which no word has.
END = -1


def learns(doc_id: Column) -> Column:
    """Whether a document is learned from; a null doc_id is."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) != 1, F.lit(True))


class WordCodes(WordHashes):
    """A hash of each word with its hashed ending in the low bits; never END."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        code = xxhash.xxh64_intdigest(word) >> 1
        ending = xxhash.xxh64_intdigest(word[-3:]) % ENDINGS
        value = self[word] = code - code % ENDINGS + ending
        return value


_CODES = WordCodes()


def shared_codes() -> WordCodes:
    """The word cache of this worker process; it outlives a task."""
    return _CODES


def token_codes(text: str | None, codes: WordCodes) -> np.ndarray:
    """Codes of the words, A-Z in lower case, and of the end."""
    words = text.encode().lower().split() if text else []
    found = np.empty(len(words) + 1, np.int64)
    found[:-1] = codes.of(words)
    found[-1] = END
    return found


@dataclass(frozen=True)
class Vocabulary:
    """What the model keeps of the training counts; its size does not grow with them."""

    tokens: int
    types: int
    top: np.ndarray  # codes of the frequent words, sorted
    top_leaf: np.ndarray
    leaf_tokens: np.ndarray
    leaf_types: np.ndarray

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        leaf = LEAVES - ENDINGS + codes % ENDINGS
        if len(self.top):
            at = np.minimum(np.searchsorted(self.top, codes), len(self.top) - 1)
            leaf = np.where(self.top[at] == codes, self.top_leaf[at], leaf)
        leaf[codes == END] = 0
        return leaf

    def log_share(self, leaf: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Log of a word's share of its leaf; one word is all of an own leaf."""
        total = self.leaf_tokens[leaf] + 0.5 * (self.leaf_types[leaf] + 1)
        return np.where(leaf >= LEAVES - ENDINGS, np.log((counts + 0.5) / total), 0.0)


@dataclass
class Weights:
    class_bias: np.ndarray
    leaf_bias: np.ndarray
    of_class: np.ndarray
    of_leaf: np.ndarray

    @classmethod
    def start(cls, vocabulary: Vocabulary) -> Weights:
        """Biases at the unigram chances, everything else 0."""
        mass = np.log(vocabulary.leaf_tokens + 0.5).reshape(CLASSES, PER_CLASS)
        return cls(
            np.logaddexp.reduce(mass, axis=1).astype(np.float32),
            mass.astype(np.float32),
            np.zeros((CLASS_ROWS, CLASSES), np.float32),
            np.zeros((LEAF_ROWS, PER_CLASS), np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.class_bias, self.leaf_bias, self.of_class, self.of_leaf]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def moved(self, change: np.ndarray) -> Weights:
        cuts = np.cumsum([p.size for p in self.parts()])[:-1]
        changes = np.split(change.astype(np.float32), cuts)
        return Weights(*(p + c.reshape(p.shape) for p, c in zip(self.parts(), changes, strict=True)))


def features(codes: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """Hashes of each token's features, one column each.

    Texts lie one after the other, each with its end; an end stands before every text.
    """
    last = np.r_[np.int64(END), codes[:-1]]
    last_leaf = np.r_[np.int64(0), leaf[:-1]]
    before = np.r_[np.int64(0), last_leaf[:-1]]
    before[last == END] = 0
    found = np.stack([last, last_leaf * LEAVES + before, before], axis=1)
    salts = np.arange(1, FEATURES + 1, dtype=np.uint64) * GOLDEN
    return mix(found.view(np.uint64) + salts)


def _rows(hashes: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the class and of the leaf weights; the latter depend on the class too."""
    of_class = hashes & np.uint64(CLASS_ROWS - 1)
    shifted = (hashes >> np.uint64(20)) + classes.astype(np.uint64)[:, None] * GOLDEN
    return of_class.astype(np.uint16), (
        (shifted >> np.uint64(3)) & np.uint64(LEAF_ROWS - 1)
    ).astype(np.uint16)


def _softmax(scores: np.ndarray) -> np.ndarray:
    # Within 60 of the bias sums of 32 terms neither overflow nor vanish in 32 bits.
    np.clip(scores, -60, 60, out=scores)
    np.exp(scores, out=scores)
    scores /= (scores @ np.ones(scores.shape[1], scores.dtype))[:, None]
    return scores


def _scores(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    total = np.take(table, rows[:, 0], axis=0)
    for k in range(1, rows.shape[1]):
        total += np.take(table, rows[:, k], axis=0)
    return total


def log_chances(weights: Weights, hashes: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """Log of the chance of each token's leaf."""
    out = np.empty(len(leaf))
    for at in range(0, len(leaf), BATCH):
        here = leaf[at : at + BATCH]
        group, member = np.divmod(here, PER_CLASS)
        of_class, of_leaf = _rows(hashes[at : at + BATCH], group)
        spot = np.arange(len(here))
        p = _softmax(_scores(weights.of_class, of_class) + weights.class_bias)[spot, group]
        q = _softmax(_scores(weights.of_leaf, of_leaf) + weights.leaf_bias[group])[spot, member]
        out[at : at + BATCH] = np.log(np.maximum(p, 1e-30)) + np.log(np.maximum(q, 1e-30))
    return out


class Trainer:
    """Gradient steps with a step size for each row, from common weights."""

    def __init__(self, weights: Weights):
        self.start = weights.flat()
        self.weights = Weights(*(p.copy() for p in weights.parts()))
        self.class_seen = np.full(CLASS_ROWS, 1e-2, np.float32)
        self.leaf_seen = np.full(LEAF_ROWS, 1e-2, np.float32)

    def _update(self, table: np.ndarray, seen: np.ndarray, rows: np.ndarray, error: np.ndarray):
        order = np.argsort(rows, kind="stable")
        sorted_rows = rows[order]
        starts = np.flatnonzero(np.r_[True, sorted_rows[1:] != sorted_rows[:-1]])
        slopes = np.add.reduceat(np.take(error, order, axis=0), starts, axis=0)
        touched = sorted_rows[starts].astype(np.intp)
        squares = np.take(seen, touched) + np.einsum("ij,ij->i", slopes, slopes)
        seen[touched] = squares
        slopes *= (-STEP / np.sqrt(squares))[:, None]
        table[touched] += slopes

    def learn(self, hashes: np.ndarray, leaf: np.ndarray) -> None:
        w = self.weights
        for at in range(0, len(leaf), BATCH):
            here = leaf[at : at + BATCH]
            group, member = np.divmod(here, PER_CLASS)
            of_class, of_leaf = _rows(hashes[at : at + BATCH], group)
            spot = np.arange(len(here))
            error = _softmax(_scores(w.of_class, of_class) + w.class_bias)
            error[spot, group] -= 1
            leaf_error = _softmax(_scores(w.of_leaf, of_leaf) + w.leaf_bias[group])
            leaf_error[spot, member] -= 1
            for k in range(FEATURES):
                self._update(w.of_class, self.class_seen, of_class[:, k], error)
                self._update(w.of_leaf, self.leaf_seen, of_leaf[:, k], leaf_error)

    def change(self) -> np.ndarray:
        return self.weights.flat() - self.start


CODED = "doc_id bigint, held_out boolean, codes array<bigint>"


def _coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The codes of each text's tokens; texts are cut into words here and nowhere else."""
    codes = shared_codes()
    for batch in batches:
        held: list[np.ndarray] = []
        size = first = 0
        for number, text in enumerate(texts_of(batch), 1):
            held.append(token_codes(text, codes))
            size += len(held[-1])
            if size >= SLICE or number == len(batch):
                ends = np.cumsum([0, *map(len, held)])
                lists = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.concatenate(held))
                )
                rows = batch.slice(first, number - first)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("held_out"), lists],
                    names=["doc_id", "held_out", "codes"],
                )
                held, size, first = [], 0, number


def _codes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All codes of a column of lists, one after the other, and the length of each list."""
    return column.flatten().to_numpy(), np.diff(column.offsets.to_numpy())


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training counts of the distinct tokens of each chunk in a batch, 0 if held out only."""
    schema = pa.schema([("chunk", pa.int64()), ("code", pa.int64()), ("n", pa.int64())])
    for batch in batches:
        chunks = batch.column("chunk").to_numpy()
        held_out = batch.column("held_out").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.r_[True, chunks[1:] != chunks[:-1], True])
        for low, high in zip(cuts, cuts[1:], strict=False):
            found, sizes = _codes_of(batch.column("codes").slice(low, high - low))
            learned = np.repeat(~held_out[low:high], sizes)
            distinct, which = np.unique(found, return_inverse=True)
            counts = np.bincount(which, weights=learned, minlength=len(distinct))
            columns = [np.full(len(distinct), chunks[low]), distinct, counts.astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)


def _vocabulary(known: DataFrame) -> Vocabulary:
    """Totals, the frequent words and the totals of each ending: all of bounded size."""
    types = known.where("one")
    row = types.agg(F.sum("total"), F.count(F.lit(1))).first()
    words = types.where(F.col("code") != END)
    top = words.orderBy(F.desc("total"), "code").limit(LEAVES - ENDINGS - 1).select("code", "total").collect()
    sums = (
        words.groupBy((F.col("code") % ENDINGS).alias("ending"))
        .agg(F.sum("total").alias("tokens"), F.count(F.lit(1)).alias("types"))
        .collect()
    )
    leaf_tokens, leaf_types = np.zeros(LEAVES), np.zeros(LEAVES)
    for s in sums:
        leaf_tokens[LEAVES - ENDINGS + s.ending] = s.tokens
        leaf_types[LEAVES - ENDINGS + s.ending] = s.types
    for number, t in enumerate(top, 1):
        leaf_tokens[number], leaf_types[number] = t.total, 1
        leaf_tokens[LEAVES - ENDINGS + t.code % ENDINGS] -= t.total
        leaf_types[LEAVES - ENDINGS + t.code % ENDINGS] -= 1
    ends = types.where(F.col("code") == END).agg(F.sum("total")).first()[0] or 0
    leaf_tokens[0], leaf_types[0] = ends, 1
    codes = np.array([t.code for t in top], np.int64)
    order = np.argsort(codes)
    return Vocabulary(
        row[0] or 0, row[1] or 0, codes[order], order + 1, leaf_tokens, leaf_types
    )


def _train(vocabulary: Vocabulary, weights: Weights):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, any_text = Trainer(weights), False
        held: list[np.ndarray] = []
        size = 0

        def learn():
            if held:
                found = np.concatenate(held)
                for at in _cuts(found):
                    part = found[at]
                    leaf = vocabulary.leaves(part)
                    trainer.learn(features(part, leaf), leaf)

        for batch in batches:
            found, _ = _codes_of(batch.column("codes"))
            any_text = any_text or len(found) > 0
            held.append(found)
            size += len(found)
            if size >= SLICE:
                learn()
                held, size = [], 0
        learn()
        if any_text:
            # As halves, whose sums are exact in any order.
            yield from parts_of(trainer.change().astype(np.float16), BLOCKS)

    return run


def _cuts(codes: np.ndarray) -> Iterator[slice]:
    """Slices of about SLICE tokens, each of whole texts."""
    ends = np.flatnonzero(codes == END) + 1
    first = 0
    while first < len(codes):
        last = ends[np.searchsorted(ends, min(first + SLICE, len(codes)))]
        yield slice(first, int(last))
        first = int(last)


def train(stored: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Weights:
    """Weights after all rounds; each round learns from its share of the documents."""
    weights = Weights.start(vocabulary)
    for number in range(rounds):
        turn = F.pmod(F.xxhash64("chunk", "doc_id"), F.lit(rounds)) == number
        changes = (
            stored.where(~F.col("held_out") & turn)
            .select("codes")
            .mapInArrow(_train(vocabulary, weights), PARTS)
        )
        total, tasks = added_up(changes)
        if tasks:
            weights = weights.moved(total / tasks)
    return weights


_SCORED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("train_tokens", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)


def _score(vocabulary: Vocabulary, weights: Weights):
    base = math.log(vocabulary.tokens + 0.5 * (vocabulary.types + 1))

    def run(docs: pa.Table, counts: pa.Table) -> pa.Table:
        known = counts.column("code").to_numpy()
        order = np.argsort(known)
        known, totals = known[order], counts.column("total").to_numpy()[order]

        def scored(part: pa.RecordBatch):
            found, sizes = _codes_of(part.column("codes"))
            n = np.zeros(len(found), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, found), len(known) - 1)
                n = np.where(known[at] == found, totals[at], 0)
            leaf = vocabulary.leaves(found)
            chances = log_chances(weights, features(found, leaf), leaf)
            seen, own, score = (
                np.add.reduceat(x.astype(np.float64), np.cumsum(sizes) - sizes)
                for x in (n > 0, np.log(n + 0.5) - base, chances + vocabulary.log_share(leaf, n))
            )
            columns = [
                part.column("doc_id"),
                part.column("held_out"),
                sizes.astype(np.int64),
                seen.astype(np.int64),
                np.full(len(sizes), vocabulary.tokens, np.int64),
                own / math.log(10),
                score / math.log(10),
            ]
            arrays = [pa.array(c, f.type) if isinstance(c, np.ndarray) else c for c, f in zip(columns, _SCORED, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=_SCORED)

        def parts():
            for batch in docs.to_batches():
                sizes = np.diff(batch.column("codes").offsets.to_numpy())
                number = np.cumsum(sizes) // SLICE
                cuts = np.flatnonzero(np.r_[True, number[1:] != number[:-1], True])
                for low, high in zip(cuts, cuts[1:], strict=False):
                    if high > low:
                        yield scored(batch.slice(low, high - low))

        return pa.Table.from_batches(list(parts()), schema=_SCORED)

    return run


def score_texts(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Scores of all documents, a row per input row.

    (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score). Tokens are words
    with A-Z in lower case and one end for each text. Documents whose checksum of the
    doc_id is 1 modulo 5 are held out, all others are learned from. base_score is the
    log10 probability under smoothed unigrams, score that under the model; both sum over
    the tokens, the end included.

    The codes of the tokens are written once in chunks; a chunk meets the counts of its own words
    only, so that no task needs the whole vocabulary. Words are counted by a 63-bit hash.

    A null text counts as empty: one token, the end. Rows with the same doc_id are scored
    one by one and all learned from or none; a null doc_id is learned from. Without any
    document to learn from train_tokens is 0 and all words are unknown. No rows give no
    rows; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.count()
    chunks = min(100_000, (rows >> CHUNK_BITS) + 1)
    path, name = scratch_path(spark, "chunks"), f"chunks_{uuid.uuid4().hex}"
    chunk = F.shiftright(F.monotonically_increasing_id(), CHUNK_BITS)
    # Files by chunk: the scores read them without a shuffle of the codes.
    (
        docs.select(
            F.col("doc_id").cast("bigint"), "text", (~learns(F.col("doc_id"))).alias("held_out")
        )
        .mapInArrow(_coded, CODED)
        .withColumn("chunk", chunk)
        .write.bucketBy(chunks, "chunk")
        .option("path", path)
        .saveAsTable(name)
    )
    stored = spark.table(name)
    plain = spark.read.schema(stored.schema).parquet(path)
    of_word = Window.partitionBy("code")
    known = settled(
        plain.mapInArrow(_word_counts, "chunk bigint, code bigint, n bigint")
        .select(
            "chunk",
            "code",
            F.sum("n").over(of_word).alias("total"),
            (F.row_number().over(of_word.orderBy("chunk")) == 1).alias("one"),
        )
        .where(F.col("total") > 0),
        "known",
    )
    vocabulary = _vocabulary(known)
    weights = train(plain, vocabulary, rounds)
    scored = settled(
        stored.groupBy("chunk")
        .cogroup(known.select("chunk", "code", "total").groupBy("chunk"))
        .applyInArrow(
            _score(vocabulary, weights),
            "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
            "train_tokens bigint, base_score double, score double",
        ),
        "scores",
    )
    # The bucketed table needs a name in the catalog while it is read.
    spark.sql(f"DROP TABLE {name}")
    delete_path(spark, path)
    return scored
