"""Near duplicates by weighted MinHash with darts, banded joins and exact checks.

A document is the multiset of its five-word shingles. Each copy of a shingle owns a unit
square of (weight, rank); hashing throws a Poisson number of darts into it, and a dart's
rank and coordinate come from its hash. The signature keeps the earliest dart of each
coordinate. So two documents agree in a coordinate with their weighted Jaccard similarity,
and a document costs its length plus its signature instead of their product.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.llm.components import connected_components
from linkweave.llm.text import (
    GOLDEN,
    WORD,
    WordHashes,
    mix,
    raw_words,
    record_batches,
    sent_if_small,
    shingles,
    texts_of,
)
from linkweave.operators.skew import hot_keys, lookup
from linkweave.session import settled

SHINGLE_WORDS = 5
SIMILARITY = 0.8

# 24 bands of 4: a pair at 0.8 is missed with probability (1 - 0.8**4)**24 = 3e-6.
BANDS = 24
ROWS = 4

# Members of a bucket that meet in one task when different classes share it.
CHUNK = 1_024

# Chance of at most n darts in a unit square: the Poisson distribution of mean 1.
_DARTS = np.cumsum([math.exp(-1) / math.factorial(n) for n in range(20)])
_UNIT = 2.0**-53


class LowerWordHashes(WordHashes):
    """Words that differ in case only are one."""

    def form(self, word: bytes) -> bytes:
        return word.decode().lower().encode()


def weighted_cells(shingle_hashes: np.ndarray) -> np.ndarray:
    """One number per unit of weight: the n-th copy of a shingle has the same in any text."""
    ordered = np.sort(shingle_hashes)
    place = np.arange(len(ordered))
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    copy = place - np.maximum.accumulate(np.where(first, place, 0))
    return mix(ordered + copy.astype(np.uint64) * GOLDEN)


def dart_signature(cells: np.ndarray, size: int) -> np.ndarray:
    """The earliest dart of each of `size` coordinates.

    Ranks are taken strip by strip, one unit each, until every coordinate has a dart:
    whatever lies in a later strip comes later. Small documents take several strips at
    a time.
    """
    signature = np.zeros(size, np.uint64)
    missing = np.ones(size, bool)
    per_step = max(1, math.ceil(size * math.log(size) / len(cells)))
    strip = 0
    while missing.any():
        strips = np.arange(strip, strip + per_step, dtype=np.uint64)
        strip += per_step
        squares = mix(cells[:, None] ^ mix(strips + GOLDEN)[None, :])
        counts = np.searchsorted(_DARTS, (squares >> np.uint64(11)) * _UNIT, side="right")
        counts = counts.ravel()
        of = np.repeat(np.arange(squares.size), counts)
        if not len(of):
            continue
        starts = np.cumsum(counts) - counts
        number = (np.arange(len(of)) - np.repeat(starts, counts)).astype(np.uint64)
        darts = mix(squares.ravel()[of] + (number + np.uint64(1)) * GOLDEN)
        ranks = strips[of % per_step] + (darts >> np.uint64(11)) * _UNIT
        spots = (mix(darts ^ GOLDEN) % np.uint64(size)).astype(np.int64)
        order = np.argsort(ranks, kind="stable")
        found, at = np.unique(spots[order], return_index=True)
        new = missing[found]
        signature[found[new]] = darts[order][at[new]]
        missing[found] = False
    return signature


def band_hashes(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    table = signature.reshape(bands, rows)
    total = np.arange(bands, dtype=np.uint64)
    for k in range(rows):
        total = mix(total + table[:, k] + GOLDEN)
    return total.view(np.int64)


def weighted_jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Of two sorted arrays of cells without repeats."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


_SIGNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("node", pa.int64()),
        ("text_id", pa.int64()),
        ("weight", pa.int32()),
        ("bands", pa.list_(pa.int64())),
    ]
)


def _signed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = LowerWordHashes()

    def rows():
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, texts_of(batch), strict=True):
                words = hashes.of(raw_words(text))
                if not len(words):
                    yield doc_id, None, None, 0, None
                    continue
                cells = weighted_cells(shingles(words, SHINGLE_WORDS))
                bands = band_hashes(dart_signature(cells, BANDS * ROWS))
                digest = hashlib.md5(words.tobytes()).digest()
                node = int.from_bytes(digest[:8], "little", signed=True)
                # The same number as _text_id: Spark hashes with seed 42.
                text_id = -(xxhash.xxh64_intdigest(text.encode(), 42) >> 1)
                yield doc_id, node, text_id, len(cells), bands

    return record_batches(rows(), _SIGNED)


_LINK = pa.schema([("x", pa.int64()), ("y", pa.int64())])


def _similar_pairs(similarity: float):
    """Keep the pairs whose texts have at least this weighted Jaccard similarity."""

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = LowerWordHashes()
        held: dict[int, np.ndarray] = {}

        def cells(doc_id: int, text: str) -> np.ndarray:
            # Pairs come sorted by x, so that its text is taken apart once.
            if doc_id not in held:
                if len(held) > 256:
                    held.clear()
                words = hashes.of(raw_words(text))
                held[doc_id] = np.sort(weighted_cells(shingles(words, SHINGLE_WORDS)))
            return held[doc_id]

        def rows():
            for batch in batches:
                xs, ys = (batch.column(c).to_pylist() for c in ("x", "y"))
                texts = zip(texts_of(batch, "x_text"), texts_of(batch, "y_text"), strict=True)
                for x, y, (x_text, y_text) in zip(xs, ys, texts, strict=True):
                    if weighted_jaccard(cells(x, x_text), cells(y, y_text)) >= similarity:
                        yield x, y

        return record_batches(rows(), _LINK)

    return check


def verified_links(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (x, y) that are similar enough; `texts` has (node, text) once per node.

    A bucket's root meets all its members, so the rows of a frequent x are dealt out.
    """
    x_side = texts.select(F.col("node").alias("x"), F.col("text").alias("x_text"))
    y_side = texts.select(F.col("node").alias("y"), F.col("text").alias("y_text"))
    both = lookup(pairs.join(y_side, "y"), x_side, "x", ["y"], hot=hot_keys(pairs, "x", CHUNK))
    return settled(both.mapInArrow(_similar_pairs(similarity), "x bigint, y bigint"), "links")


def _comparable(similarity: float):
    """Weights too far apart rule out the similarity; a little is left for rounding."""
    small = F.least("__x_weight", "__y_weight")
    return small >= F.lit(similarity - 1e-9) * F.greatest("__x_weight", "__y_weight")


def _star_pairs(members: DataFrame, similarity: float) -> DataFrame:
    """Each member of a bucket with the bucket's first document."""
    return settled(
        members.where(F.col("node") != F.col("root.node"))
        .select(
            F.col("root.node").alias("x"),
            F.col("node").alias("y"),
            F.col("root.weight").alias("__x_weight"),
            F.col("weight").alias("__y_weight"),
        )
        .where(_comparable(similarity))
        .select("x", "y")
        .distinct(),
        "star-pairs",
    )


def _cells_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """32 bits of each cell: two cells of a text are taken for one by chance of 1e-9."""
    hashes = LowerWordHashes()
    schema = pa.schema([("node", pa.int64()), ("cells", pa.list_(pa.int32()))])

    def rows():
        for batch in batches:
            nodes = batch.column("node").to_pylist()
            for node, text in zip(nodes, texts_of(batch), strict=True):
                cells = weighted_cells(shingles(hashes.of(raw_words(text)), SHINGLE_WORDS))
                yield node, (cells >> np.uint64(32)).astype(np.uint32).view(np.int32)

    return record_batches(rows(), schema, 256)


class _Tile:
    """Members of one chunk of a bucket, and others that may be linked to them."""

    def __init__(self):
        self.sides = ([], [])

    def add(self, side: int, node: int, of_class: int, cells: np.ndarray) -> None:
        self.sides[side].append((node, of_class, cells))

    def links(self, similarity: float) -> Iterator[tuple[int, int]]:
        """A link from each other to each class of members that it is similar to."""
        others, members = self.sides
        if not others or not members:
            return
        members.sort(key=lambda m: (len(m[2]), m[0]))
        sizes = np.array([len(m[2]) for m in members])
        nodes, classes = (np.array([m[k] for m in members]) for k in (0, 1))
        flat = np.concatenate([m[2] for m in members])
        ends = np.cumsum(sizes)
        known, places = np.unique(flat, return_inverse=True)
        for node, of_class, cells in others:
            # Sizes too far apart rule out the similarity.
            low = np.searchsorted(sizes, similarity * len(cells) - 1e-6)
            high = np.searchsorted(sizes, len(cells) / similarity + 1e-6, side="right")
            if low >= high:
                continue
            marked = np.zeros(len(known), np.int32)
            at = np.searchsorted(known, cells)
            at = at[at < len(known)]
            marked[at[np.isin(known[at], cells)]] = 1
            first = ends[low] - sizes[low]
            both = np.add.reduceat(
                marked[places[first : ends[high - 1]]], ends[low:high] - sizes[low:high] - first
            )
            alike = both >= similarity * (sizes[low:high] + len(cells) - both) - 1e-6
            found = low + np.flatnonzero(alike & (classes[low:high] != of_class))
            for k in found[np.unique(classes[found], return_index=True)[1]]:
                yield min(node, int(nodes[k])), max(node, int(nodes[k]))


def _links_of_tiles(similarity: float):
    """Links in each tile; rows come sorted by tile."""

    def rows(batches):
        current, tile = None, _Tile()
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in _TILE), strict=True))
            columns = (batch.column(c).to_pylist() for c in ("side", "node", "class"))
            for key, side, node, of_class, cells in zip(
                keys, *columns, batch.column("cells"), strict=True
            ):
                if key != current:
                    yield from tile.links(similarity)
                    current, tile = key, _Tile()
                tile.add(side, node, of_class, cells.values.to_numpy())
        yield from tile.links(similarity)

    return lambda batches: record_batches(rows(batches), _LINK)


_TILE = ("bucket", "other_chunk", "chunk")


def _further_links(
    members: DataFrame, classes: DataFrame, texts: DataFrame, similarity: float
) -> DataFrame:
    """Links between nodes of a bucket that the first links left in different classes.

    The members of a bucket's largest class need no comparison among themselves; all
    others meet everyone in the bucket, tile by tile. The comparisons stay inside a task
    and only links come out, for each node one to each class at most.
    """
    placed = settled(
        members.select("bucket", "node")
        .join(classes, "node", "left")
        .withColumn("class", F.coalesce("class", "node")),
        "placed",
    )
    sizes = placed.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("n"))
    mixed = settled(
        sizes.groupBy("bucket")
        .agg(
            F.max(F.struct("n", "class")).alias("main"),
            F.sum("n").alias("rows"),
            F.count(F.lit(1)).alias("classes"),
        )
        .where(F.col("classes") > 1)
        .select(
            "bucket",
            F.col("main.class").alias("main"),
            F.ceil(F.col("rows") / F.lit(CHUNK)).cast("bigint").alias("chunks"),
        ),
        "mixed-buckets",
    )
    inside = settled(lookup(placed, mixed, "bucket", ["node"]), "mixed-members")
    wanted = inside.select("node").distinct()
    cells = settled(
        texts.join(wanted, "node", "left_semi").mapInArrow(_cells_of, "node bigint, cells array<int>"),
        "cells",
    )
    own = F.pmod(F.xxhash64("node"), F.col("chunks"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1))
    sides = [
        inside.where(F.col("class") != F.col("main")).select(
            "bucket", own.alias("other_chunk"), every.alias("chunk"), F.lit(0).alias("side"),
            "node", "class",
        ),
        inside.select(
            "bucket", every.alias("other_chunk"), own.alias("chunk"), F.lit(1).alias("side"),
            "node", "class",
        ),
    ]
    tiles = sides[0].unionAll(sides[1]).join(cells, "node")
    return settled(
        tiles.repartition(*_TILE)
        .sortWithinPartitions(*_TILE)
        .select(*_TILE, "side", "node", "class", "cells")
        .mapInArrow(_links_of_tiles(similarity), "x bigint, y bigint")
        .distinct(),
        "further-links",
    )


def _text_id() -> Column:
    return -F.shiftrightunsigned(F.xxhash64("text"), 1)


def _classes(docs: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, node, weight), nodes (node, class), and classes (class, first).

    A node is a hash of a text's words, null without words; first is the row
    (nameless, doc_id, text_id) that stands for a class, that with its least doc_id.
    """
    signed = settled(
        docs.select("doc_id", "text").mapInArrow(
            _signed,
            "doc_id bigint, node bigint, text_id bigint, weight int, bands array<bigint>",
        ),
        "signed",
    )
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_id")
    nodes = settled(
        signed.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            F.min(row).alias("first"),
            F.any_value("weight").alias("weight"),
            F.any_value("bands").alias("bands"),
        ),
        "nodes",
    )
    banded = settled(
        nodes.select("node", "weight", F.explode("bands").alias("bucket")), "banded"
    )
    roots = (
        banded.groupBy("bucket")
        .agg(F.min(F.struct("node", "weight")).alias("root"), F.max("node").alias("last"))
        .where(F.col("root.node") != F.col("last"))
        .select("bucket", "root")
    )
    members = settled(lookup(banded, roots, "bucket", ["node"]), "members")
    wanted = nodes.select("node", "first").join(members.select("node").distinct(), "node", "left_semi")
    texts = settled(
        _rows_of(docs.select("doc_id", "text"), settled(wanted, "wanted"))
        .groupBy("node")
        .agg(F.any_value("text").alias("text")),
        "texts",
    )

    links = verified_links(_star_pairs(members, similarity), texts, similarity)
    classes = connected_components(links)
    more = _further_links(members, classes, texts, similarity)
    if more.limit(1).count():
        classes = connected_components(settled(links.unionAll(more), "all-links"))

    placed = settled(
        nodes.select("node", "first")
        .join(classes, "node", "left")
        .select("node", F.coalesce("class", "node").alias("class"), "first"),
        "classes",
    )
    firsts = settled(placed.groupBy("class").agg(F.min("first").alias("first")), "firsts")
    return signed, placed.select("node", "class"), firsts


def _rows_of(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """The rows of `docs` with the doc_id and text of a `first`, next to the other columns."""
    others = [c for c in firsts.columns if c != "first"]
    table = firsts.select(
        *others, F.col("first.doc_id").alias("__doc_id"), F.col("first.text_id").alias("__first")
    )
    return (
        docs.withColumn("__text_id", _text_id())
        .join(
            sent_if_small(table),
            F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("__text_id") == F.col("__first")),
        )
        .drop("__doc_id", "__first")
    )


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Class of each document: (doc_id, class_id, n_shingles), a row per input row.

    Two documents are linked if the multisets of their five-word shingles (words in lower
    case; a shorter text is one shingle) have a weighted Jaccard similarity of at least
    `similarity`. A class is what links connect; its id is its least doc_id.

    Texts with the same words are one node throughout. In each bucket every node is
    checked against the first one; nodes of a bucket that are then still in different
    classes are checked against each other, so that no link between classes is lost. A
    node has as many classes in a bucket to be checked against as it has strangers there:
    that work grows with their number times the bucket's size, in tiles of bounded size.

    Documents without words (null, empty, blank) are alone: class_id is their doc_id. Rows
    with the same words share a class, whatever their doc_id; unlike texts do not, even with
    the same doc_id. Of several classes with the same least doc_id one has it as its id. The
    others, and those of rows without a doc_id, get a negative class_id made from a text.
    No rows give no rows. Other columns are not read.
    """
    signed, of_node, firsts = _classes(docs, similarity)
    clashes = settled(
        firsts.where(F.col("first.doc_id").isNotNull())
        .groupBy(F.col("first.doc_id").alias("least"))
        .agg(F.min("class").alias("owner"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select("least", "owner"),
        "clashes",
    )
    least, other = F.col("first.doc_id").alias("least"), F.col("first.text_id").alias("other")
    named = settled(
        lookup(firsts.select("class", least, other), clashes, "least", ["class"], "left").select(
            "class",
            F.when(F.coalesce("owner", "class") == F.col("class"), F.coalesce("least", "other"))
            .otherwise(F.col("other"))
            .alias("class_id"),
        ),
        "named",
    )
    found = settled(
        lookup(of_node, named, "class", ["node"]).select("node", "class_id"), "class-ids"
    )
    placed = lookup(
        signed.select("doc_id", "node", F.col("weight").alias("n_shingles")),
        found, "node", ["doc_id"], "left",
    )
    return placed.select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), "n_shingles"
    )


def deduplicate(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class of `near_duplicates`, all columns kept.

    It is the row with the class's least doc_id, rows without a doc_id last; of several rows
    that are equal in doc_id and text any one. Rows without words stay, those with the same
    doc_id and text once; without a doc_id all of them stay.
    """
    *_, firsts = _classes(docs, similarity)
    with_words = _rows_of(docs, firsts.select("first"))
    blank = docs.where(~F.coalesce("text", F.lit("")).rlike(WORD))
    with_id = blank.where(F.col("doc_id").isNotNull()).withColumn("__text_id", _text_id())
    kept = with_words.unionByName(with_id).dropDuplicates(["doc_id", "__text_id"]).drop("__text_id")
    return kept.unionByName(blank.where(F.col("doc_id").isNull()))
