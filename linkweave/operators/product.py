"""Products of sparse matrices in long form, as joins on the shared dimension.

A row of the shared dimension with n entries on one side and m on the other gives
n * m terms. Long rows are therefore cut into tiles of about TILE x TILE terms by a
hash of the entry. A tile is one join key, so a long row spreads over many tasks, and
each task adds up its terms by cell before the shuffle to the result.

Where that adds up next to nothing, because a task has few terms of the same cell, the
terms are sent to the row of the result they belong to as lists, and added up there: a
list's entry is a fraction of a row's size. Rows with very many terms go the other way.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.operators.skew import (
    GroupSummary,
    bucket_of,
    group_sizes,
    group_summary,
    lookup,
    sent_whole,
)
from linkweave.session import settled

# Entries of one row that stay together.
TILE = 1_024


# Terms that one task should add up, and the most tasks for one product.
TASK_TERMS = 20_000_000
MAX_TASKS = 100_000

# Terms that one task should take if it is sent them as lists. It holds their cells at once.
LISTED_TERMS = 4_000_000

# Lists are sent unless a task that adds up first has this many terms for each cell.
TERMS_PER_CELL = 2


def task_count(df: DataFrame, terms: float, each: int = TASK_TERMS) -> int:
    """Partitions for a join that yields about `terms` rows.

    Its input is small next to what it yields, so the number is set here instead of
    being merged by input size.
    """
    spark = df.sparkSession
    at_least = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        spark.sparkContext.defaultParallelism,
    )
    return max(at_least, min(MAX_TASKS, math.ceil(terms / each)))


def _chunks(size: str, tile: int) -> Column:
    return F.coalesce(F.ceil(F.col(size) / F.lit(tile)), F.lit(1)).cast("bigint")


def _entries(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select(*[column.alias(name) for name, column in columns.items()])


def _pairs(
    entries: DataFrame,
    shared: str,
    item: str,
    carried: list[str],
    summary: GroupSummary | None,
    tile: int,
    totals: list[Column],
    wanted: Callable[[], Column] | None = None,
) -> DataFrame:
    """The `totals` of each pair's rows (low, high, c_low, c_high for each carried c).

    There is a row for each shared row of a pair. `wanted` is a condition on these columns
    that holds or fails for a pair as a whole; other pairs are dropped as they are made,
    before anything is added up.
    """
    rows = _entries(
        entries,
        {"__shared": F.col(shared), "__item": F.col(item)}
        | {f"__c_{c}": F.col(c) for c in carried},
    )
    summary = summary or group_summary(entries, shared)

    def added(pairs: DataFrame) -> DataFrame:
        pairs = pairs.where(wanted()) if wanted else pairs
        return pairs.groupBy("low", "high").agg(*totals)

    terms = summary.squares / 2
    if summary.largest > tile:
        return added(joined_pairs(rows, carried, summary, tile))
    items = group_summary(rows, "__item")
    if terms / task_count(rows, terms) > TERMS_PER_CELL * float(items.keys) ** 2 / 2:
        return added(joined_pairs(rows, carried, summary, tile))
    most = TASK_TERMS // max(1, summary.largest)
    if items.largest <= most:
        return added(_listed_pairs(rows, carried, terms))
    # Items with so many users that one task might get too many terms of theirs.
    hot = group_sizes(rows, "__item", "__size").where(F.col("__size") > most)
    hot = settled(hot.select("__item", F.lit(True).alias("__hot")), "hot-items")
    return added(_listed_pairs(rows, carried, terms, hot)).unionByName(
        added(joined_pairs(rows, carried, summary, tile, hot))
    )


def _pair_names(carried: list[str]) -> dict[str, str]:
    """Columns of an entry, by what stands before "low" and "high" in those of a pair."""
    return {"": "__item"} | {f"{c}_": f"__c_{c}" for c in carried}


def _listed_pairs(
    rows: DataFrame, carried: list[str], terms: float, hot: DataFrame | None = None
) -> DataFrame:
    """Pairs in the task of their lower item, which gets the others of each user as a list.

    Items in `hot` are left out as the lower one.
    """
    names = _pair_names(carried)
    entry = F.sort_array(F.collect_list(F.struct(*names.values())))
    lists = (
        rows.dropna(subset=["__shared", "__item"])
        .groupBy("__shared")
        .agg(entry.alias("__list"))
        .where(F.size("__list") > 1)
        .select(*[F.col(f"__list.{c}").alias(c) for c in names.values()])
    )
    last = F.size("__item") - 1
    each = lists.select("*", F.explode(F.sequence(F.lit(1), last)).alias("__place"))
    low = [F.element_at(c, F.col("__place")).alias(f"{c}_x") for c in names.values()]
    rest = [F.slice(c, F.col("__place") + 1, F.size(c)).alias(f"{c}_y") for c in names.values()]
    each = each.select(*low, *rest)
    if hot is not None:
        known = hot.select(F.col("__item").alias("__item_x"), "__hot")
        each = each.join(known, "__item_x", "left_anti")
    dealt = each.repartition(task_count(rows, terms, LISTED_TERMS), "__item_x")
    found = dealt.select("*", F.posexplode("__item_y").alias("__at", "__high"))
    return found.where(F.col("__item_x") < F.col("__high")).select(
        *[F.col(f"{c}_x").alias(f"{name}low") for name, c in names.items()],
        F.col("__high").alias("high"),
        *[F.get(f"{c}_y", F.col("__at")).alias(f"{name}high") for name, c in names.items() if name],
    )


def joined_pairs(
    rows: DataFrame,
    carried: list[str],
    summary: GroupSummary,
    tile: int,
    lows: DataFrame | None = None,
) -> DataFrame:
    """Pairs as a join of the entries with themselves, in tiles where a user has many.

    With `lows`, only those whose lower item is in it; no user may then need tiles.
    """
    tasks = task_count(rows, summary.squares / 2)
    keys = ["__shared"]
    left = right = rows
    if lows is not None:
        left = rows.join(lows, "__item", "left_semi")
    if summary.largest > tile:
        keys = ["__shared", "__a", "__b"]
        left, right = _pair_tiles(rows, tile)
    names = _pair_names(carried)
    left = left.select(*keys, *[F.col(c).alias(f"{c}_x") for c in names.values()])
    right = right.select(*keys, *[F.col(c).alias(f"{c}_y") for c in names.values()])

    in_order = F.col("__item_x") < F.col("__item_y")
    pairs = left.repartition(tasks, *keys).join(right.repartition(tasks, *keys), keys)
    ends = {name: (F.col(f"{c}_x"), F.col(f"{c}_y")) for name, c in names.items()}
    if summary.largest <= tile:
        pairs = pairs.where(in_order)
    else:
        # Two different chunks meet once only, with their items in either order.
        pairs = pairs.where(in_order | (F.col("__a") != F.col("__b")))
        ends = {name: _oriented(in_order, x, y) for name, (x, y) in ends.items()}
    return pairs.select(
        *[x.alias(f"{name}low") for name, (x, _) in ends.items()],
        *[y.alias(f"{name}high") for name, (_, y) in ends.items()],
    )


def pair_counts(
    entries: DataFrame,
    shared: str,
    item: str,
    item_size: str | None = None,
    summary: GroupSummary | None = None,
    tile: int = TILE,
    wanted: Callable[[], Column] | None = None,
) -> DataFrame:
    """Count, for each two items, the shared rows that hold both.

    `entries` has each (shared, item) once, and is best a written table: unless the
    `summary` of its rows is given, a job looks it up first. The result has each pair once,
    as (low, high, n_both) with low < high. With `item_size`, a column that is constant per
    item, also (n_low, n_high); `wanted` may then be a condition on the columns
    `<item_size>_low` and `<item_size>_high` that pairs have to meet.
    """
    carried = [item_size] if item_size else []
    totals = [F.count(F.lit(1)).alias("n_both")]
    if item_size:
        totals += [F.max(f"{item_size}_{end}").alias(f"n_{end}") for end in ("low", "high")]
    return _pairs(entries, shared, item, carried, summary, tile, totals, wanted)


def pair_sums(
    entries: DataFrame,
    shared: str,
    item: str,
    value: str,
    constants: list[str],
    summary: GroupSummary | None = None,
    tile: int = TILE,
) -> DataFrame:
    """Sums over the shared rows of each two items, made like `pair_counts`.

    (low, high, n_both, dot, shared_low, shared_high, <c>_low, <c>_high): the number of
    shared rows, the sum of the products of their values, the sums of either item's values
    in them, and the `constants` of either item.
    """
    low, high = F.col(f"{value}_low"), F.col(f"{value}_high")
    totals = [
        F.count(F.lit(1)).alias("n_both"),
        F.sum(low * high).alias("dot"),
        F.sum(low).alias("shared_low"),
        F.sum(high).alias("shared_high"),
        *[F.max(f"{c}_{end}").alias(f"{c}_{end}") for c in constants for end in ("low", "high")],
    ]
    return _pairs(entries, shared, item, [value, *constants], summary, tile, totals)


def _oriented(in_order: Column, x: Column, y: Column) -> tuple[Column, Column]:
    return F.when(in_order, x).otherwise(y), F.when(in_order, y).otherwise(x)


def _pair_tiles(rows: DataFrame, tile: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of a self-join by tiles (__a, __b) with __a <= __b."""
    sizes = group_sizes(rows, "__shared", "__size").where(F.col("__size") > tile)
    chunked = (
        lookup(rows, sizes, "__shared", ["__item"], "left")
        .withColumn("__chunks", _chunks("__size", tile))
        .withColumn("__chunk", bucket_of(["__item"], F.col("__chunks")))
    )
    onward = F.sequence(F.col("__chunk"), F.col("__chunks") - 1)
    back = F.sequence(F.lit(0).cast("bigint"), F.col("__chunk"))
    left = chunked.withColumn("__a", F.col("__chunk")).withColumn("__b", F.explode(onward))
    right = chunked.withColumn("__b", F.col("__chunk")).withColumn("__a", F.explode(back))
    return left, right


def matrix_product(
    left: DataFrame,
    right: DataFrame,
    shared: str,
    row: str,
    col: str,
    left_value: str | None = None,
    right_value: str | None = None,
    tile: int = TILE,
    sums: dict[str, Callable[[Column, Column], Column]] | None = None,
    *,
    without: DataFrame | None = None,
) -> DataFrame:
    """Sum of products over the shared dimension, as (row, col, value, n_terms).

    `left` has each (shared, row) once and `right` each (shared, col). A side without a
    value column counts as 1 per entry. `sums` replaces the one sum by others, each of a
    function of the two values. Cells (row, col) that are in `without` are left out. Both
    sides are best written tables: the sizes of their rows are looked up first.
    """
    sums = sums or {"value": lambda v, w: v * w}
    one = F.lit(1).cast("bigint")
    lhs = _entries(
        left,
        {
            "__shared": F.col(shared),
            "__row": F.col(row),
            "__v": F.col(left_value) if left_value else one,
        },
    )
    rhs = _entries(
        right,
        {
            "__shared": F.col(shared),
            "__col": F.col(col),
            "__w": F.col(right_value) if right_value else one,
        },
    )
    cell = [F.col("__row").alias(row), F.col("__col").alias(col)]
    totals = [F.sum(f(F.col("__v"), F.col("__w"))).alias(name) for name, f in sums.items()]
    totals.append(F.count(F.lit(1)).alias("n_terms"))

    def joined(lhs: DataFrame) -> DataFrame:
        x, y, keys = product_tiles(lhs, rhs, tile)
        found = x.join(y, keys).groupBy(*cell).agg(*totals)
        if without is None:
            return found
        return found.join(without.select(row, col), [row, col], "left_anti")

    sizes = [group_summary(side, "__shared") for side in (lhs, rhs)]
    rows, cols = group_summary(lhs, "__row"), group_summary(rhs, "__col")
    terms = math.sqrt(sizes[0].squares * sizes[1].squares)
    if terms / task_count(lhs, terms) > TERMS_PER_CELL * float(rows.keys) * cols.keys:
        return joined(lhs)

    def listed(lhs: DataFrame) -> DataFrame:
        lists = _lists(rhs, sizes[1].largest, right_value is not None)
        out = None
        if without is not None:
            out = without.select(F.col(row).alias("__row"), F.col(col).alias("__out"))
        terms_of_rows = _listed_terms(lhs, lists, out, task_count(lhs, terms, LISTED_TERMS), tile)
        found = terms_of_rows.groupBy(*cell).agg(*totals, F.max("__left_out").alias("__left_out"))
        return found.where(~F.col("__left_out")).drop("__left_out")

    # Rows that may have too many terms for one task.
    most = TASK_TERMS // max(1, sizes[1].largest)
    if rows.largest <= most:
        return listed(lhs)
    hot = group_sizes(lhs, "__row", "__size").where(F.col("__size") > most)
    hot = settled(hot.select(F.col("__row").alias("__hot")), "hot-rows")
    same = F.col("__row").eqNullSafe(F.col("__hot"))
    return listed(lhs.join(hot, same, "left_anti")).unionByName(
        joined(lhs.join(hot, same, "left_semi"))
    )


def _lists(rhs: DataFrame, largest: int, valued: bool) -> DataFrame:
    """The columns and values of each shared row as lists of at most about TILE entries."""
    blocked = rhs.dropna(subset=["__shared"])
    if largest > TILE:
        sizes = group_sizes(blocked, "__shared", "__size").where(F.col("__size") > TILE)
        blocked = lookup(blocked, sizes, "__shared", ["__col"], "left").withColumn(
            "__block", bucket_of(["__col"], _chunks("__size", TILE))
        )
    else:
        blocked = blocked.withColumn("__block", F.lit(0).cast("bigint"))
    ws = [F.col("__list.__w").alias("__ws")] if valued else []
    return (
        blocked.groupBy("__shared", "__block")
        .agg(F.collect_list(F.struct("__col", "__w")).alias("__list"))
        .select(
            "__shared",
            "__block",
            F.struct(F.col("__list.__col").alias("__cols"), *ws).alias("__w"),
        )
    )


def _listed_terms(
    lhs: DataFrame, lists: DataFrame, out: DataFrame | None, tasks: int, tile: int
) -> DataFrame:
    """(__row, __col, __v, __w, __left_out) of each term, in the task of its row.

    Cells of `out`, which are (__row, __out), come along as terms that are marked.
    """
    lists_type = lists.schema["__w"].dataType
    no_cell = F.lit(None).cast(lists_type["__cols"].dataType.elementType).alias("__out")

    def with_out(met: DataFrame, absent: str) -> DataFrame:
        met = met.select("__row", "__v", absent, no_cell)
        if out is None:
            return met
        blank = [F.lit(None).cast(met.schema[c].dataType).alias(c) for c in ("__v", absent)]
        cells = out.dropna().select("__row", *blank, "__out")
        return met.unionByName(cells)

    if sent_whole(lists):
        # The lists are at every task, so that only the entries travel.
        dealt = with_out(lhs, "__shared").repartition(tasks, "__row")
        met = dealt.join(lists, "__shared", "left")
        met = met.where(F.col("__w").isNotNull() | F.col("__out").isNotNull())
    else:
        written = settled(lists, "lists").withColumnRenamed("__block", "__col")
        left, right, keys = product_tiles(lhs, written, tile)
        met = with_out(left.join(right, keys), "__w").repartition(tasks, "__row")
    left_out = F.col("__out").isNotNull()
    cols = F.when(left_out, F.array("__out")).otherwise(F.col("__w.__cols"))
    valued = "__ws" in lists_type.names
    found = met.select(
        "__row", "__v", "__w", left_out.alias("__left_out"), F.posexplode(cols).alias("__at", "__col")
    )
    w = F.get("__w.__ws", F.col("__at")) if valued else F.lit(1).cast("bigint")
    return found.select("__row", "__col", "__v", w.alias("__w"), "__left_out")


def listed_rows(
    left: DataFrame,
    right: DataFrame,
    shared: str,
    row: str,
    col: str,
    left_value: str,
    right_value: str,
    pack: Callable[[DataFrame], DataFrame],
    kept: dict[str, Callable[[Column, Column], Column]],
    tile: int = TILE,
) -> DataFrame:
    """The terms of `matrix_product` as lists, in the task of their row: (row, *kept).

    There is a row for each entry of `left` and each list of at most about TILE entries of
    its shared row. `pack` turns the lists (__shared, __block, __w), whose __w holds the
    arrays __cols and __ws, into ones with another __w, each once. `kept` are functions of
    the left value and this __w, and what they give is all that travels. Both sides are
    best written tables.
    """
    lhs = _entries(left, {"__shared": F.col(shared), "__row": F.col(row), "__v": F.col(left_value)})
    rhs = _entries(right, {"__shared": F.col(shared), "__col": F.col(col), "__w": F.col(right_value)})
    sizes = [group_summary(side, "__shared") for side in (lhs, rhs)]
    tasks = task_count(lhs, math.sqrt(sizes[0].squares * sizes[1].squares), LISTED_TERMS)
    lists = pack(_lists(rhs, sizes[1].largest, True))
    parts = (F.col("__v"), F.col("__w"))
    columns = [F.col("__row").alias(row), *[f(*parts).alias(name) for name, f in kept.items()]]
    if sent_whole(lists):
        met = lhs.join(lists, "__shared")
    elif max(size.largest for size in sizes) <= tile:
        # One list for each shared row, so that an entry meets one at most.
        met_in = task_count(lhs, sizes[0].squares)
        met = lhs.repartition(met_in, "__shared").join(lists, "__shared")
    else:
        written = settled(lists, "lists").withColumnRenamed("__block", "__col")
        x, y, keys = product_tiles(lhs, written, tile)
        met = x.join(y, keys)
    # Dealt after the join, of which Spark may send either side to all tasks.
    return met.select(*columns).repartition(tasks, row)


def product_tiles(
    lhs: DataFrame, rhs: DataFrame, tile: int = TILE
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of a join on __shared, dealt to tasks by the rows it yields, and its keys.

    `lhs` is (__shared, __row, __v) and `rhs` (__shared, __col, __w).
    """
    keys = ["__shared"]
    sizes = [group_summary(side, "__shared") for side in (lhs, rhs)]
    # No more than this many rows, by the Cauchy-Schwarz inequality.
    tasks = task_count(lhs, math.sqrt(sizes[0].squares * sizes[1].squares))
    if any(size.largest > tile for size in sizes):
        keys = ["__shared", "__a", "__b"]
        lhs, rhs = _product_tiles(lhs, rhs, tile)
    return lhs.repartition(tasks, *keys), rhs.repartition(tasks, *keys), keys


def _product_tiles(
    lhs: DataFrame, rhs: DataFrame, tile: int
) -> tuple[DataFrame, DataFrame]:
    """Both sides cut by tiles (__a, __b): a chunk of the left and one of the right."""
    # Either side needs to know into how many chunks the other one is cut.
    sizes = _both_sizes(lhs, rhs, tile)
    left_chunks, right_chunks = _chunks("__left", tile), _chunks("__right", tile)
    zero = F.lit(0).cast("bigint")
    left = lookup(lhs, sizes, "__shared", ["__row"], "left")
    right = lookup(rhs, sizes, "__shared", ["__col"], "left")
    return (
        left.select(
            "__shared",
            "__row",
            "__v",
            bucket_of(["__row"], left_chunks).alias("__a"),
            F.explode(F.sequence(zero, right_chunks - 1)).alias("__b"),
        ),
        right.select(
            "__shared",
            "__col",
            "__w",
            F.explode(F.sequence(zero, left_chunks - 1)).alias("__a"),
            bucket_of(["__col"], right_chunks).alias("__b"),
        ),
    )


def _both_sizes(lhs: DataFrame, rhs: DataFrame, tile: int) -> DataFrame:
    """(__shared, __left, __right) for the rows that are long on either side."""
    entries = lhs.select("__shared", F.lit(1).alias("__l"), F.lit(0).alias("__r")).unionAll(
        rhs.select("__shared", F.lit(0).alias("__l"), F.lit(1).alias("__r"))
    )
    return (
        entries.groupBy("__shared")
        .agg(F.sum("__l").alias("__left"), F.sum("__r").alias("__right"))
        .where((F.col("__left") > tile) | (F.col("__right") > tile))
    )
