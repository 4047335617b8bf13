"""Quality scores from random-indexing word vectors and a small neural network.

Each word form has a sparse random index vector, made from a hash. Its context vector is
the sum of the index vectors of its neighbours over all documents. A document is
the mean of its words' index and context vectors with a few ratios; a network of two layers
turns it into a probability, and a temperature fitted on training documents that the
network has not seen calibrates it.

Word forms are the character class pattern and the ends of a word, so that words never
seen before have vectors too; they are hashed into a fixed number of buckets.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.llm.adding import PARTS, added_up, parts_of
from linkweave.llm.text import WordHashes, raw_words, record_batches, texts_of
from linkweave.session import settled

# The network is fitted on at most this many labelled documents, those with the least
# hashes of their doc_id.
TRAINING_DOCUMENTS = 12_000

# Buckets of word forms, numbers in a vector, and non-zero ones in an index vector.
FORMS = 1 << 12
SIZE = 48
NON_ZERO = 6

# Neighbours on either side whose index vectors a word collects.
REACH = 2

HIDDEN = 24
EPOCHS = 60
CUT = 0.7
SEED = 7

# Blocks in which the context vectors are added up.
BLOCKS = 16

# Words of a text whose neighbours are added up together; it bounds what a text takes.
SLICE = 1 << 16


def learns(doc_id: Column) -> Column:
    """Whether a document may be learned from; the rest are held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) != 2, F.lit(True))


def word_form(word: str) -> str:
    """Case and symbols of a word, with its first and last letters in lower case."""
    kind = "A" if word.isupper() else "a"
    symbols = re.sub(r"\w", "", word)
    plain = re.sub(r"\W", "", word).lower()
    return f"{kind}{symbols[-3:]}|{plain[:1]}{plain[-2:]}"


class FormIds(WordHashes):
    """Bucket of each word's form."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1_000_000:
            self.clear()
        code = xxhash.xxh64_intdigest(word_form(word.decode()).encode())
        value = self[word] = code % FORMS
        return value


def index_vectors(seed: int = SEED) -> np.ndarray:
    """Sparse random vectors of +1 and -1, the same everywhere."""
    chance = np.random.default_rng(seed)
    vectors = np.zeros((FORMS, SIZE), np.float32)
    for row in vectors:
        row[chance.choice(SIZE, NON_ZERO, replace=False)] = chance.choice([-1.0, 1.0], NON_ZERO)
    return vectors


def _slices(forms: np.ndarray) -> Iterator[tuple[np.ndarray, int, int]]:
    """A text's words in slices of at most SLICE, with up to REACH neighbours on either side.

    (words, low, high): those from low to high are the slice's own.
    """
    for at in range(0, len(forms), SLICE):
        first = max(0, at - REACH)
        last = min(at + SLICE, len(forms))
        yield forms[first : last + REACH], at - first, last - first


def context_sums(texts: Iterable[np.ndarray], index: np.ndarray) -> np.ndarray:
    """Sum of the index vectors of neighbours, for each word form."""
    sums = np.zeros((FORMS, SIZE), np.float64)
    for forms in texts:
        if len(forms) < 2:
            continue
        for part, low, high in _slices(forms):
            near = np.zeros((len(part), SIZE), np.float32)
            vectors = index[part]
            for step in range(1, min(REACH, len(part) - 1) + 1):
                near[step:] += vectors[:-step]
                near[:-step] += vectors[step:]
            own, near = part[low:high], near[low:high]
            order = np.argsort(own, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(own[order]) != 0])
            sums[own[order][starts]] += np.add.reduceat(near[order], starts, axis=0)
    return sums


def word_vectors(index: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Index and context vector of each word form side by side, contexts at length one."""
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    contexts = np.divide(sums, norm, out=np.zeros_like(sums), where=norm > 0)
    return np.hstack([index, contexts]).astype(np.float32)


def pooled(forms: np.ndarray, text: str | None, vectors: np.ndarray) -> np.ndarray:
    """Mean of a document's word vectors, and a few ratios of its words and lines."""
    out = np.zeros(vectors.shape[1] + 4, np.float32)
    n = len(forms)
    if n:
        counts = np.bincount(forms, minlength=FORMS)
        used = np.flatnonzero(counts)
        out[:-4] = (counts[used].astype(np.float32) @ vectors[used]) / n
        lines = [line for line in text.split("\n") if line.strip()]
        out[-4:] = (
            np.log1p(n) / 10,
            len(used) / n,
            np.mean(forms[1:] == forms[:-1]) if n > 1 else 0.0,
            len(set(lines)) / len(lines) if lines else 0.0,
        )
    return out


@dataclass(frozen=True)
class Network:
    """Two layers over scaled inputs, and a temperature for the logit."""

    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.scale @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0.0, logits) - y * logits))


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = SEED) -> Network:
    """Fit on four fifths of the rows, then the temperature on the rest.

    Without rows the score is 0.5 everywhere; with one class, near that class's share.
    """
    size = x.shape[1] if x.ndim == 2 else 2 * SIZE + 4
    if not len(y):
        zero = np.zeros(size)
        return Network(zero, zero + 1, np.zeros((size, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0, 1.0)
    chance = np.random.default_rng(seed)
    order = chance.permutation(len(y))
    cut = max(1, len(y) * 4 // 5)
    train, rest = order[:cut], order[cut:] if len(y) > cut else order
    mean, scale = x[train].mean(axis=0), x[train].std(axis=0) + 1e-3
    z = (x - mean) / scale
    weights = [
        chance.normal(0, size**-0.5, (size, HIDDEN)),
        np.zeros(HIDDEN),
        chance.normal(0, HIDDEN**-0.5, HIDDEN),
        np.zeros(1),
    ]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    step = 0
    for _ in range(EPOCHS):
        mixed = chance.permutation(train)
        for at in range(0, len(mixed), 128):
            rows = mixed[at : at + 128]
            hidden = np.tanh(z[rows] @ weights[0] + weights[1])
            logits = hidden @ weights[2] + weights[3]
            error = (1.0 / (1.0 + np.exp(-np.clip(logits, -40, 40))) - y[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (1 - hidden**2)
            slopes = [
                z[rows].T @ back + 1e-4 * weights[0],
                back.sum(axis=0),
                hidden.T @ error + 1e-4 * weights[2],
                np.array([error.sum()]),
            ]
            step += 1
            for w, slope, (m, v) in zip(weights, slopes, moments, strict=True):
                m += 0.1 * (slope - m)
                v += 0.001 * (slope**2 - v)
                w -= 0.005 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    plain = Network(mean, scale, weights[0], weights[1], weights[2], float(weights[3][0]), 1.0)
    logits = plain.logits(x[rest])
    tried = np.geomspace(0.25, 8.0, 61)
    best = min(tried, key=lambda t: _loss(logits / t, y[rest]))
    return Network(*(getattr(plain, f) for f in list(Network.__dataclass_fields__)[:-1]), float(best))


def _training_rows(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """(doc_id, text, quality) of the bounded sample that is learned from."""
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & learns(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    chosen = settled(chosen, "chosen")
    return settled(
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality"),
        "training",
    )


def _sums_of_tasks(index: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = FormIds()
        sums, any_text = np.zeros((FORMS, SIZE)), False
        for batch in batches:
            sums += context_sums((ids.of(raw_words(t)) for t in texts_of(batch)), index)
            any_text |= batch.num_rows > 0
        if any_text:
            yield from parts_of(sums, BLOCKS)

    return run


def _features(vectors: np.ndarray):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("quality", pa.int32()), ("x", pa.list_(pa.float32()))]
    )

    def rows(batches):
        ids = FormIds()
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "quality")), strict=True)
            for (doc_id, quality), text in zip(keys, texts_of(batch), strict=True):
                yield doc_id, quality, pooled(ids.of(raw_words(text)), text, vectors)

    return lambda batches: record_batches(rows(batches), schema)


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_DOCUMENTS) -> tuple[np.ndarray, Network]:
    """Word vectors from all documents, network from a bounded sample of labelled ones.

    Context vectors are added up by tasks; what comes to the driver is their sum and one
    row of numbers for each labelled doc_id, `limit` rows at most. A doc_id with several
    texts is learned from once, by the one whose numbers are least.
    """
    rows = _training_rows(docs, labels, limit)
    index = index_vectors()
    total, _ = added_up(docs.select("text").mapInArrow(_sums_of_tasks(index), PARTS))
    sums = np.zeros((FORMS, SIZE)) if total is None else total.reshape(FORMS, SIZE)
    vectors = word_vectors(index, sums)
    # One row for each doc_id, however often it is in the table: at most `limit` rows.
    found = (
        rows.mapInArrow(_features(vectors), "doc_id bigint, quality int, x array<float>")
        .groupBy("doc_id")
        .agg(F.min(F.struct("quality", "x")).alias("least"))
        .select("doc_id", "least.*")
        .collect()
    )
    found.sort(key=lambda r: r.doc_id)
    x = np.array([r.x for r in found], np.float64).reshape(len(found), vectors.shape[1] + 4)
    return vectors, fit_network(x, np.array([r.quality for r in found], np.float64))


_SCORE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("score", pa.float64()),
        ("predicted", pa.int32()),
    ]
)


def _score(vectors: np.ndarray, network: Network, cut: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = FormIds()
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array([pooled(ids.of(raw_words(t)), t, vectors) for t in texts_of(batch)])
            scores = network.scores(x.astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(scores),
                    pa.array((scores >= cut).astype(np.int32)),
                ],
                schema=_SCORE,
            )

    return run


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    cut: float = CUT,
    limit: int = TRAINING_DOCUMENTS,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, a row per input row.

    Only labels of documents whose checksum of the doc_id is not 2 modulo 4 are learned
    from; held_out marks the others. Word vectors are of all documents, labelled or not,
    and use no label. The score uses nothing but the text. A null text
    counts as empty and is scored like any text; a document with several labels has the
    greatest; rows with the same doc_id are scored one by one and learned from once; labels
    other than 0 and 1 are ignored; a null doc_id is never held out and never learned from. Without labels every score is 0.5. No rows give no rows; other
    columns are not read.
    """
    vectors, network = fit(docs, labels, limit)
    return (
        docs.select("doc_id", "text", (~learns(F.col("doc_id"))).alias("held_out"))
        .mapInArrow(
            _score(vectors, network, cut),
            "doc_id bigint, held_out boolean, score double, predicted int",
        )
    )
