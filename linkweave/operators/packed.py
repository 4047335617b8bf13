"""Lists of whole numbers as bytes: sorted ids travel as the steps between them.

The functions that run in Arrow batches need nothing of this package where they run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.operators.product import LISTED_TERMS, joined_pairs, task_count
from linkweave.operators.skew import GroupSummary, group_sizes, group_summary
from linkweave.session import settled

# Bounds are loosened by this share, so that rounding never drops a pair.
SLACK = 1e-6

# Terms that are worked out at once; a row with more has all of its own at once.
CHUNK_TERMS = 500_000


def number_bytes() -> tuple[Callable, ...]:
    """(widths, pack, unpack, column, parts) for lists of numbers without a sign, one after another.

    All numbers of a list take the same number of bytes: 1, 2, 4 or 8.
    """

    def widths(values, starts):
        """Bytes that the numbers of each list take; the lists have one at least."""
        most = np.maximum.reduceat(values, starts) if len(starts) else values
        return 1 + (most > 0xFF) + 2 * (most > 0xFFFF) + 4 * (most > 0xFFFFFFFF)

    def pack(values, counts, width):
        """The bytes of all lists, and how many each takes."""
        sizes = counts * width
        data = np.empty(sizes.sum(), np.uint8)
        for w in np.unique(width):
            of = width == w
            data[np.repeat(of, sizes)] = values[np.repeat(of, counts)].astype(f"<u{w}").view(np.uint8)
        return data, sizes

    def unpack(data, sizes, width):
        """What `pack` was given: the numbers, and how many each list has."""
        counts = sizes // width
        values = np.empty(counts.sum(), np.uint64)
        for w in np.unique(width):
            of = width == w
            values[np.repeat(of, counts)] = data[np.repeat(of, sizes)].view(f"<u{w}")
        return values, counts

    def column(data, sizes):
        """An Arrow column of bytes."""
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data)])

    def parts(array):
        """The bytes of an Arrow column, and how many each row takes; none where it is null."""
        array = array.cast(pa.large_binary()).fill_null(b"")
        _, ends, data = array.buffers()
        ends = np.frombuffer(ends, np.int64)[array.offset : array.offset + len(array) + 1]
        data = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]
        return data, np.diff(ends)

    return widths, pack, unpack, column, parts


def pair_dots(
    entries: DataFrame, shared: str, item: str, value: str, norm: str, least: float, summary: GroupSummary
) -> DataFrame:
    """(low, high, n_both, dot, norm_low) of each two rows that share `least` ** 2 of the low one's norm.

    `entries` has whole numbers only: the rows `item` of a matrix with their `value` above
    zero in the columns `shared`, none of which needs tiles, and their sum of squares
    `norm`. By the Cauchy-Schwarz inequality no other pair has a cosine of `least`. As in
    `pair_sums`, pairs meet in the task of the lower row, which gets the others of each
    column as a list: here as bytes, added up in Arrow batches.
    """
    rows = entries.select(
        F.col(shared).alias("__shared"),
        F.col(item).cast("bigint").alias("__item"),
        F.col(value).cast("bigint").alias("__c_value"),
        F.col(norm).cast("bigint").alias("__c_norm"),
    ).dropna(subset=["__shared", "__item"])
    names = ["__item", "__c_value", "__c_norm"]
    # The lists are far less than what is made of them, so their tasks follow the terms too.
    terms = summary.squares / 2
    lists = (
        rows.repartition(task_count(rows, terms), "__shared")
        .groupBy("__shared")
        .agg(F.sort_array(F.collect_list(F.struct(*names))).alias("__list"))
        .where(F.size("__list") > 1)
        .select(*[F.col(f"__list.{c}").alias(c) for c in names])
    )
    arrays = ", ".join(f"{c} array<bigint>" for c in names)
    packed = lists.mapInArrow(
        _steps(), f"{arrays}, __ids binary, __id_width int, __values binary, __value_width int"
    )
    last = F.size("__item") - 1
    each = packed.select("*", F.explode(F.sequence(F.lit(1), last)).alias("__place")).select(
        *[F.element_at(c, F.col("__place")).alias(c) for c in names],
        F.expr("substring(__ids, (__place - 1) * __id_width + 1)").alias("__ids"),
        "__id_width",
        F.expr("substring(__values, __place * __value_width + 1)").alias("__values"),
        "__value_width",
    )
    schema = "low bigint, high bigint, n_both bigint, dot bigint, norm_low bigint"
    tasks = task_count(rows, terms, LISTED_TERMS)

    def listed(each: DataFrame) -> DataFrame:
        dealt = each.repartition(tasks, "__item").sortWithinPartitions("__item")
        return dealt.mapInArrow(added_dots(least), schema)

    # Rows with so many entries that one task might get too many terms of theirs.
    most = LISTED_TERMS // max(1, summary.largest)
    if group_summary(rows, "__item").largest <= most:
        return listed(each)
    hot = group_sizes(rows, "__item", "__size").where(F.col("__size") > most)
    hot = settled(hot.select("__item", F.lit(True).alias("__hot")), "hot-items")
    pairs = joined_pairs(rows, ["value", "norm"], summary, summary.largest, hot)
    low, high = F.col("value_low"), F.col("value_high")
    summed = pairs.groupBy("low", "high").agg(
        F.count(F.lit(1)).alias("n_both"),
        F.sum(low * high).alias("dot"),
        F.max("norm_low").alias("norm_low"),
        F.sum(low * low).cast("double").alias("__common"),
    )
    enough = F.col("__common") >= F.col("norm_low") * F.lit(least * least * (1.0 - SLACK))
    return listed(each.join(hot, "__item", "left_anti")).unionByName(
        summed.where(enough).drop("__common")
    )


def _steps() -> Callable[[Iterator], Iterator]:
    """A function of Arrow batches that adds sorted ids, as steps, and their values as bytes."""
    widths, pack, _, column, _ = number_bytes()

    def numbers(batch, name):
        array = batch.column(name)
        return array.flatten().to_numpy(zero_copy_only=False), np.diff(array.offsets.to_numpy())

    def packed(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, counts = numbers(batch, "__item")
            values, _ = numbers(batch, "__c_value")
            starts = np.cumsum(counts) - counts
            inner = np.ones(len(ids), bool)
            inner[starts] = False
            steps = np.diff(ids, prepend=ids[:1]).view(np.uint64)[inner]
            values = values.view(np.uint64)
            id_width = widths(steps, starts - np.arange(len(starts)))
            value_width = widths(values, starts)
            columns = [
                column(*pack(steps, counts - 1, id_width)),
                pa.array(id_width, pa.int32()),
                column(*pack(values, counts, value_width)),
                pa.array(value_width, pa.int32()),
            ]
            names = ["__ids", "__id_width", "__values", "__value_width"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])

    return packed


def added_dots(least: float, chunk: int = CHUNK_TERMS) -> Callable[[Iterator], Iterator]:
    """A function of Arrow batches in which a low row's lists follow each other; see `pair_dots`.

    What pairs have in common is first added up by a hash of the high row, which can only
    be too much, and only what is left where that is enough is sorted by pair.
    """
    _, _, unpack, _, parts = number_bytes()
    share = least * least * (1.0 - SLACK)

    def dots(table):
        """The result for all lists of some low rows."""
        low, mine, norms, id_width, value_width = (
            table.column(c).to_numpy()
            for c in ("__item", "__c_value", "__c_norm", "__id_width", "__value_width")
        )
        new = np.diff(low, prepend=low[:1]) != 0
        new[0] = True
        first = np.flatnonzero(new)
        row_of_list = np.cumsum(new) - 1
        steps, counts = unpack(*parts(table.column("__ids").combine_chunks()), id_width)
        values, _ = unpack(*parts(table.column("__values").combine_chunks()), value_width)
        ends = np.cumsum(counts)
        total = np.cumsum(steps)
        before = np.concatenate([[np.uint64(0)], total])[ends - counts]
        high = total + np.repeat(low.view(np.uint64) - before, counts)
        row = np.repeat(row_of_list, counts)
        square = np.repeat(mine.astype(np.float64) ** 2, counts)
        # A row that comes twice in a column is no pair with itself.
        square[high == np.repeat(low.view(np.uint64), counts)] = 0.0
        bits = max(1, int(len(high) // len(first)).bit_length())
        cell = (high * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
        cell = cell.view(np.int64) + (row << bits)
        common = np.bincount(cell, square, len(first) << bits)
        need = norms[first].astype(np.float64) * share
        common[common < np.repeat(need, 1 << bits)] = 0.0
        left = np.flatnonzero((common[cell] > 0) & (square > 0))
        high, row, square = high[left].view(np.int64), row[left], square[left]
        product = np.repeat(mine, counts)[left] * values[left].view(np.int64)
        order = np.lexsort((high, row))
        high, row = high[order], row[order]
        start = np.flatnonzero((np.diff(high, prepend=0) != 0) | (np.diff(row, prepend=-1) != 0))
        if not len(start):
            return None
        enough = np.add.reduceat(square[order], start) >= need[row[start]]
        both = np.diff(start, append=len(high))[enough]
        dot = np.add.reduceat(product[order], start)[enough]
        high, row = high[start][enough], row[start][enough]
        columns = [low[first][row], high, both, dot, norms[first][row]]
        names = ["low", "high", "n_both", "dot", "norm_low"]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    def cut(table, last):
        """Tables of whole rows with about `chunk` terms each, and what may go on later."""
        low = table.column("__item").to_numpy()
        starts = np.flatnonzero(np.diff(low)) + 1
        starts = np.concatenate([[0], starts, [len(low)] if last else []]).astype(np.int64)
        if len(starts) == 1:
            return [], table
        _, sizes = parts(table.column("__ids").combine_chunks())
        terms = np.concatenate([[0], np.cumsum(sizes // table.column("__id_width").to_numpy())])
        of = terms[starts] // chunk
        cuts = starts[np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1])]
        cuts = np.unique(np.concatenate([cuts, [0, starts[-1]]]))
        whole = [table.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return whole, table.slice(starts[-1])

    def added(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            whole, held = cut(table, last=False)
            for found in map(dots, whole):
                if found is not None:
                    yield found
        if held is not None:
            whole, _ = cut(held, last=True)
            for found in map(dots, whole):
                if found is not None:
                    yield found

    return added


def packed_tags(lists: DataFrame) -> DataFrame:
    """Lists of whole numbers __cols with tags __ws, in __w, as bytes: see `listed_rows`.

    The numbers of a list are sorted. Its __w is then (first, steps, width, nulls, tags,
    places): the first number, the steps to the others and their width in bytes, how many
    entries have no number, each tag once, and the places of its numbers in the list.
    """
    parts = lists.schema["__w"].dataType
    tag = parts["__ws"].dataType.elementType.simpleString()
    shared, block = (lists.schema[c].dataType.simpleString() for c in ("__shared", "__block"))
    plain = lists.select(
        "__shared",
        "__block",
        F.col("__w.__cols").cast("array<bigint>").alias("__cols"),
        F.col("__w.__ws").alias("__ws"),
    )
    names = ("first", "steps", "width", "nulls", "tags", "places")
    packed = plain.mapInArrow(
        _tagged(),
        f"__shared {shared}, __block {block}, first bigint, steps binary, width int, nulls int, "
        f"tags array<{tag}>, places array<binary>",
    )
    return packed.select("__shared", "__block", F.struct(*names).alias("__w"))


def _tagged() -> Callable[[Iterator], Iterator]:
    """The function of Arrow batches for `packed_tags`."""
    widths, pack, _, column, _ = number_bytes()

    def ends(counts):
        return pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())

    def tagged(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            cols, ws = batch.column("__cols"), batch.column("__ws").flatten().dictionary_encode()
            sizes = np.diff(cols.offsets.to_numpy())
            flat = cols.flatten()
            valid = flat.is_valid().to_numpy(zero_copy_only=False)
            ids = flat.fill_null(0).to_numpy(zero_copy_only=False)[valid]
            of = np.repeat(np.arange(n), sizes)[valid]
            order = np.lexsort((ids, of))
            ids = ids[order]
            code = ws.indices.fill_null(-1).to_numpy(zero_copy_only=False)[valid][order]
            counts = np.bincount(of, minlength=n)
            starts = np.cumsum(counts) - counts
            some = counts > 0
            inner = np.ones(len(ids), bool)
            inner[starts[some]] = False
            first = np.zeros(n, np.int64)
            first[some] = ids[starts[some]]
            steps = np.diff(ids, prepend=ids[:1]).view(np.uint64)[inner]
            step_counts = np.maximum(counts - 1, 0)
            width, more = np.ones(n, np.int64), step_counts > 0
            width[more] = widths(steps, (np.cumsum(step_counts) - step_counts)[more])
            # Places by list and tag.
            place = np.arange(len(ids)) - np.repeat(starts, counts)
            has = code >= 0
            key = of[has] * max(1, len(ws.dictionary)) + code[has]
            by_tag = np.argsort(key, kind="stable")
            key, place = key[by_tag], place[has][by_tag]
            group = np.flatnonzero(np.diff(key, prepend=-1))
            owner, tag = np.divmod(key[group], max(1, len(ws.dictionary)))
            group_counts = np.diff(group, append=len(key))
            place_width = np.where(counts[owner] > 0x10000, 4, 2)
            groups = ends(np.bincount(owner, minlength=n))
            columns = [
                batch.column("__shared"),
                batch.column("__block"),
                pa.array(first, pa.int64(), mask=~some),
                column(*pack(steps, step_counts, width)),
                pa.array(width, pa.int32()),
                pa.array(sizes - counts, pa.int32()),
                pa.ListArray.from_arrays(groups, ws.dictionary.take(pa.array(tag))),
                pa.ListArray.from_arrays(
                    groups, column(*pack(place.astype(np.uint64), group_counts, place_width))
                ),
            ]
            names = ["__shared", "__block", "first", "steps", "width", "nulls", "tags", "places"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return tagged


def unpacked_tags(key: str, whole: pa.DataType) -> Callable[[Iterator], Iterator]:
    """A function of Arrow batches (key, first, steps, width, nulls, same) of packed lists.

    It gives (key, items, same): a list's numbers, of type `whole`, with a null for each
    entry without one, and those at the places `same`, which are none where it is null.
    """
    _, _, unpack, _, parts = number_bytes()

    def lists(values, counts):
        ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        return pa.ListArray.from_arrays(ends, values)

    def unpacked(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            first, nulls = batch.column("first"), batch.column("nulls").to_numpy()
            some = first.is_valid().to_numpy(zero_copy_only=False)
            steps, counts = unpack(*parts(batch.column("steps")), batch.column("width").to_numpy())
            counts = counts + some
            starts = np.cumsum(counts) - counts
            inner = np.ones(counts.sum(), bool)
            inner[starts[some]] = False
            ids = np.empty(len(inner), np.uint64)
            ids[inner] = steps
            ids[~inner] = first.drop_null().to_numpy().view(np.uint64)
            total = np.concatenate([[np.uint64(0)], np.cumsum(ids)])
            ids = (total[1:] - np.repeat(total[starts], counts)).view(np.int64)
            places, same_counts = unpack(*parts(batch.column("same")), np.where(counts > 0x10000, 4, 2))
            same = ids[np.repeat(starts, same_counts) + places.view(np.int64)]
            absent = None
            if nulls.any():
                at = np.arange(len(ids)) + np.repeat(np.cumsum(nulls) - nulls, counts)
                absent = np.ones(len(ids) + nulls.sum(), bool)
                absent[at] = False
                numbers = np.zeros(len(absent), np.int64)
                numbers[at] = ids
                ids, counts = numbers, counts + nulls
            items = pa.array(ids, pa.int64(), mask=absent).cast(whole)
            columns = [lists(items, counts), lists(pa.array(same, pa.int64()).cast(whole), same_counts)]
            yield pa.RecordBatch.from_arrays([batch.column(key), *columns], [key, "items", "same"])

    return unpacked
