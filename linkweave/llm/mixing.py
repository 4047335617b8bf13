"""A corpus mixed to target weights by a low-discrepancy schedule.

Slot i of the schedule is the fractional part of i times the golden ratio, mapped through
the sources' cumulative shares, so that any stretch of slots holds the sources in nearly
their shares. The r-th slot of a source takes the r-th block of its documents, which are
shuffled by a hash and cut into blocks of equal numbers of words; after the last block
comes the first one again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave.llm.text import sent_if_small, word_array
from linkweave.operators.skew import lookup
from linkweave.session import settled

# Weights by the order of the sources, repeated.
WEIGHTS = (5, 2, 1)

# A source is taken at most this often.
REPEATS = 3

# Slots of a schedule; a block has about the total size divided by this.
SLOTS = 1 << 20

# Fixed value: the golden ratio's fractional part, in units of 2**-30; odd.
GOLDEN_STEP = 663_608_943
CIRCLE = 1 << 30

# Shares of slots are whole numbers of this part, so that sums are exact in any order.
SLOT_UNITS = 1_024

# Slots that one window numbers, parts of the circle in which shares are looked up, and
# hexadecimal digits of the hash that name the ranges in which sizes are added up.
SLOT_RANGE = 1 << 14
SECTORS = 1 << 10
RANGE_DIGITS = 3

# Documents alike in source, doc_id and size that become rows in one task.
EQUAL_ROWS = 1 << 16

# Sources whose table may be sent to all tasks; a row takes about 100 bytes.
MAX_SENT_SOURCES = 200_000

_BEFORE = (Window.unboundedPreceding, -1)


def _before(column: str, window) -> Column:
    return F.coalesce(F.sum(column).over(window.rowsBetween(*_BEFORE)), F.lit(0))


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS
) -> DataFrame:
    """(source, source_size, weight, target) of (source, size); a row per source.

    Sources take weights in code point order, null last. Shares by weight of the total
    stop at `repeats` times a source's size; what is over goes to the others by weight
    until none is above. That fixed point is found at once: with the sources ordered by
    limit / weight, it is the level at which the full ones stop and the rest share.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    listed = F.array(*[F.lit(w) for w in weights])
    weighted = sources.withColumn(
        "weight", F.get(listed, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))))
    ).withColumn("limit", F.col("source_size") * repeats)
    everything = Window.partitionBy()
    by_level = Window.orderBy(
        F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    left = F.sum("source_size").over(everything) - _before("limit", by_level)
    weight_left = F.sum("weight").over(everything) - _before("weight", by_level)
    levels = weighted.withColumn("level", left / weight_left).withColumn(
        "place", F.row_number().over(by_level)
    )
    # The first source that the level does not fill fixes it for all that follow.
    is_open = F.col("level") <= F.col("limit") / F.col("weight")
    level = F.min(F.when(is_open, F.struct("place", "level"))).over(everything)
    share = F.least(F.col("limit").cast("double"), F.col("weight") * level["level"])
    return levels.select(
        "source",
        "source_size",
        "weight",
        F.coalesce(share, F.col("limit").cast("double")).alias("target"),
    )


def schedule(shares: DataFrame, slots: int) -> DataFrame:
    """(slot, source_no, rank) of `slots` slots; `shares` has (source_no, low, high).

    low and high are a source's part of the circle 0 .. 2**30. Shares are looked up by
    sector of the circle and slots are numbered by ranges of slots, so that neither a
    source with most of the slots nor their number meets in one task.
    """
    spark = shares.sparkSession
    point = F.pmod(F.col("slot") * F.lit(GOLDEN_STEP), F.lit(CIRCLE))
    width = CIRCLE // SECTORS
    points = spark.range(slots).select(F.col("id").alias("slot")).select(
        "slot", point.alias("point"), F.floor(point / F.lit(width)).alias("sector")
    )
    parts = shares.where(F.col("low") < F.col("high")).withColumn(
        "sector",
        F.explode(
            F.sequence(
                F.floor(F.col("low") / F.lit(width)),
                F.floor((F.col("high") - 1) / F.lit(width)),
            )
        ),
    )
    placed = settled(
        points.join(parts, "sector")
        .where((F.col("point") >= F.col("low")) & (F.col("point") < F.col("high")))
        .select("slot", "source_no", F.floor(F.col("slot") / F.lit(SLOT_RANGE)).alias("range")),
        "schedule",
    )
    counts = placed.groupBy("source_no", "range").agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select(
        "source_no",
        "range",
        _before("n", Window.partitionBy("source_no").orderBy("range")).alias("start"),
    )
    within = F.row_number().over(Window.partitionBy("source_no", "range").orderBy("slot"))
    return (
        placed.withColumn("place", within - 1)
        .join(starts, ["source_no", "range"])
        .select("slot", "source_no", (F.col("start") + F.col("place")).alias("rank"))
    )


def _streams(equal: DataFrame) -> DataFrame:
    """A row for each document with `start`: the words of its source before it when shuffled.

    `equal` has the documents that are alike in source, doc_id and size as one row with their
    number, `rows`. They lie side by side, so that their places follow from that number and
    an id of any number of documents is sorted as one row for each of its sizes. Words are
    added up by range of the hash first, so that a hot source is no single sort.
    """
    code = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    hashed = (
        equal.withColumn("words", F.col("size") * F.col("rows"))
        .withColumn("code", code)
        .withColumn("range", F.left("code", F.lit(RANGE_DIGITS)))
    )
    sums = hashed.groupBy("source_no", "range").agg(F.sum("words").alias("in_range"))
    starts = sums.select(
        "source_no",
        "range",
        _before("in_range", Window.partitionBy("source_no").orderBy("range")).alias("base"),
    )
    inside = Window.partitionBy("source_no", "range").orderBy("code", "doc_id", "size")
    placed = (
        hashed.withColumn("inside", _before("words", inside))
        .join(starts, ["source_no", "range"])
        .withColumn("start", F.col("base") + F.col("inside"))
        .drop("code", "range", "inside", "base", "words")
    )
    # Stretches of equal documents are dealt to tasks before they become rows.
    tasks = int(equal.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rows") - 1, F.lit(EQUAL_ROWS)))
    last = F.least(F.col("first") + EQUAL_ROWS, F.col("rows")) - 1
    return (
        placed.withColumn("first", first)
        .repartition(tasks, "source_no", "start", "doc_id", "size", "first")
        .withColumn("number", F.explode(F.sequence(F.col("first"), last)))
        .withColumn("start", F.col("start") + F.col("number") * F.col("size"))
        .drop("first", "number", "rows")
    )


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
    slots: int = SLOTS,
) -> DataFrame:
    """Words taken from each document: (doc_id, size, source_size, target, taken).

    size is the number of words, 0 for a null text; taken counts repeats and is at most
    `repeats` times size. Each source's taken words come within a few blocks of its
    target, and a block has about total / slots words, at least one. A document lies in
    one or more blocks and is taken with each of them, so that one at the last block's
    edge may be taken in part.

    Null sources are a source of their own, after all others; a null doc_id is an id like
    any other. Rows equal in doc_id and size may change places. Documents without words
    are not taken. No rows give no rows; other columns are not read.
    """
    mixed, _ = _mixed(docs, weights, repeats, slots)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def _mixed(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
    slots: int = SLOTS,
) -> tuple[DataFrame, DataFrame]:
    """The rows of `mix_sources` with `source_no`, and the sources by that number."""
    sized = settled(
        docs.select(
            "doc_id", "source", F.size(word_array(F.col("text"))).cast("bigint").alias("size")
        ),
        "sized",
    )
    targets = source_targets(sized, weights, repeats)
    total = F.sum("source_size").over(Window.partitionBy())
    block = F.greatest(F.lit(1), F.floor(total / F.lit(slots)))
    blocks = F.ceil(F.col("source_size") / F.col("block"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    # Slots that a source should get; a third of its blocks makes a third of its words.
    wanted = F.when(
        F.col("source_size") > 0,
        F.round(F.col("target") * F.col("blocks") / F.col("source_size") * SLOT_UNITS),
    ).otherwise(F.lit(0.0))
    table = settled(
        targets.withColumn("block", block)
        .withColumn("blocks", blocks)
        .withColumn("wanted", wanted.cast("bigint"))
        .withColumn("all_wanted", F.sum("wanted").over(Window.partitionBy()))
        .withColumn("below", _before("wanted", by_name))
        .withColumn("source_no", F.row_number().over(by_name) - 1),
        "sources",
    )
    units = table.agg(F.max("all_wanted")).first()[0] or 0
    edge = f"({{}} * {CIRCLE}L) div all_wanted"
    shares = table.where(F.col("wanted") > 0).select(
        "source_no",
        F.expr(edge.format("below")).alias("low"),
        F.expr(edge.format("(below + wanted)")).alias("high"),
    )
    n_slots = -(-units // SLOT_UNITS)
    # Block b of a source with n blocks is taken by the ranks b, b + n, b + 2n, ...
    uses = (
        schedule(shares, n_slots)
        .join(sent_if_small(table.select("source_no", "blocks"), MAX_SENT_SOURCES), "source_no")
        .where(F.col("rank") < F.col("blocks") * repeats)
        .groupBy("source_no", F.pmod("rank", F.col("blocks")).alias("block_no"))
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    known = table.select("source", "source_no", "source_size", "target", "blocks")
    equal = sized.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("rows"))
    rows = equal.join(
        sent_if_small(known, MAX_SENT_SOURCES), equal["source"].eqNullSafe(known["source"])
    ).drop("source")
    streamed = settled(_streams(rows), "streams")
    # Block b holds the words from size * b / n on; the word at place p is in block
    # floor((p * n + n - 1) / size) as the edges are rounded down.
    first = F.expr("((start + 1) * blocks - 1) div source_size")
    last = F.expr("((start + size) * blocks - 1) div source_size")
    spread = streamed.where(F.col("size") > 0).withColumn(
        "block_no", F.explode(F.sequence(first, last))
    )
    low = F.expr("(block_no * source_size) div blocks")
    high = F.expr("((block_no + 1) * source_size) div blocks")
    inside = F.least(F.col("start") + F.col("size"), high) - F.greatest(F.col("start"), low)
    taken = (
        spread.join(uses, ["source_no", "block_no"], "left")
        .withColumn("part", inside * F.coalesce("uses", F.lit(0)))
        .groupBy("doc_id", "size", "source_size", "target", "source_no", "start")
        .agg(F.sum("part").alias("taken"))
        .select("doc_id", "size", "source_no", "source_size", "target", "taken")
    )
    untaken = streamed.where(F.col("size") == 0).select(
        "doc_id", "size", "source_no", "source_size", "target", F.lit(0).cast("bigint").alias("taken")
    )
    return taken.unionAll(untaken), known


def repeat_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows: each document as often as its words are taken, rounded.

    All columns are kept, and those taken less than half are left out. Rows of a source
    that share doc_id and size, null ids included, share the mean of their counts: each is
    repeated the whole part of it, and once more for as many of them as the rest asks for,
    by a hash of their texts. Rows equal in all of that are repeated alike. Texts without
    words are not taken; no rows give no rows.
    """
    mixed, known = _mixed(docs, **options)
    counts = settled(
        mixed.where(F.col("size") > 0)
        .groupBy("source_no", "doc_id", "size")
        .agg(F.sum("taken").alias("taken"), F.count(F.lit(1)).alias("__rows"))
        .where(F.col("taken") > 0)
        .select(
            F.col("source_no").alias("__no"),
            F.col("doc_id").alias("__doc"),
            F.col("size").alias("__size"),
            (F.col("taken") / (F.col("size") * F.col("__rows"))).alias("__mean"),
            "__rows",
        ),
        "counts",
    )
    sources = known.select(F.col("source").alias("__source"), F.col("source_no").alias("__source_no"))
    rows = docs.withColumn("__words", F.size(word_array(F.col("text"))).cast("bigint")).join(
        sent_if_small(sources), docs["source"].eqNullSafe(F.col("__source"))
    )
    joined = rows.join(
        counts,
        (F.col("__source_no") == F.col("__no"))
        & docs["doc_id"].eqNullSafe(F.col("__doc"))
        & (F.col("__words") == F.col("__size")),
    )
    parts = 1 << 20
    chance = F.pmod(F.xxhash64("text"), F.lit(parts)) / F.lit(parts)
    edge = F.when(F.col("__rows") == 1, F.lit(0.5)).otherwise(chance)
    copies = F.floor(F.col("__mean") + edge).cast("int")
    return (
        joined.withColumn("__copies", copies)
        .where(F.col("__copies") > 0)
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .select(*[docs[c] for c in docs.columns])
    )
