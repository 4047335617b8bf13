"""Link and history documents: one text field of ordered ids per action.

The input of a field is (id, part, other_int, other_id, weight): the original id of the
row, and the number, original id and weight of each linked one. Documents are (id, part,
fields). The part is 0 unless an id has more than `part_links` links; the links then
go on, in order, in parts 1, 2, ...
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.operators.ids import decode
from linkweave.operators.ranking import group_ranks
from linkweave.operators.skew import group_summary, with_group_size
from linkweave.session import settled

# Links in one document row.
PART_LINKS = 100_000


def with_parts(links: DataFrame, key: str, part_links: int = PART_LINKS) -> DataFrame:
    """Add the document part of each link; links are ordered by weight, then number.

    `links` is (key, other_int, weight), with `rank` if it was cut to the top k. It is best
    a written table: its largest document is looked up first.
    """
    part = F.floor((F.col("rank") - 1) / F.lit(part_links)).cast("int")
    if "rank" in links.columns:
        return links.withColumn("part", part).drop("rank")
    if group_summary(links, key).largest <= part_links:
        return links.withColumn("part", F.lit(0))
    sized = with_group_size(links, key, ["other_int"], "__links")
    short = sized.where(F.col("__links") <= part_links).withColumn("part", F.lit(0))
    long = sized.where(F.col("__links") > part_links)
    ranked = group_ranks(long, key, "weight", "other_int").withColumn("part", part)
    return short.drop("__links").unionByName(ranked.drop("__links", "rank"))


def decode_links(
    matrix: DataFrame,
    row: str,
    col: str,
    weight: str,
    rows: DataFrame,
    cols: DataFrame,
    part_links: int = PART_LINKS,
) -> DataFrame:
    """Field input from a numbered matrix and the dictionaries of its two sides."""
    numbered = matrix.select(
        F.col(row).alias("__row"),
        F.col(col).alias("other_int"),
        F.col(weight).cast("double").alias("weight"),
        *[c for c in ("rank",) if c in matrix.columns],
    )
    parts = with_parts(numbered, "__row", part_links)
    named = decode(parts, {"__row": ("id", rows), "other_int": ("other_id", cols)})
    return named.select("id", "part", "other_int", "other_id", "weight")


def ordered_links(field: Column) -> Column:
    """Aggregate: links by weight and then number, both descending."""
    return F.sort_array(F.collect_list(field), asc=False)


def link_text(links: Column, delim: str = " ") -> Column:
    return F.array_join(F.transform(links, lambda x: x["other_id"].cast("string")), delim)


def documents(
    fields: dict[str, DataFrame],
    how: str = "inner",
    delim: str = " ",
) -> DataFrame:
    """Documents with one text column per field.

    The rows of all fields meet in one grouping by (id, part). With `inner` an id must
    have links in every field; with `full` a missing field is empty.
    """
    if how not in ("inner", "full"):
        raise ValueError(f"how must be inner or full, not {how!r}")
    names = list(fields)
    entry = F.struct("weight", "other_int", "other_id")
    rows = reduce(
        DataFrame.unionByName,
        [
            fields[name].select(
                "id", "part", F.lit(number).alias("__field"), entry.alias("__entry")
            )
            for number, name in enumerate(names)
        ],
    )
    if how == "inner" and len(names) > 1:
        # Read twice below.
        rows = settled(rows, "document-rows")
    of_field = [F.col("__field") == number for number in range(len(names))]
    packed = rows.groupBy("id", "part").agg(
        *[
            ordered_links(F.when(of, F.col("__entry"))).alias(name)
            for of, name in zip(of_field, names, strict=True)
        ]
    )
    if how == "inner" and len(names) > 1:
        # Ids found in every field, repeated for their parts: the join then keeps the
        # (id, part) layout of the grouping, and a long document stays spread out.
        has = [F.max(of).alias(f"__has_{n}") for n, of in enumerate(of_field)]
        complete = rows.groupBy("id").agg(*has, F.max("part").alias("__last"))
        for n in range(len(names)):
            complete = complete.where(F.col(f"__has_{n}"))
        wanted = complete.select(
            "id", F.explode(F.sequence(F.lit(0), F.col("__last"))).alias("part")
        )
        packed = packed.join(wanted, ["id", "part"], "left_semi")
    return packed.select("id", "part", *[link_text(F.col(n), delim).alias(n) for n in names])


def item_links_docs(own: DataFrame, cross: DataFrame | None = None, **options) -> DataFrame:
    """Documents (id, part, b_b_links[, b_a_links])."""
    fields = {"b_b_links": own}
    if cross is not None:
        fields["b_a_links"] = cross
    return documents(fields, **options)


def user_history_docs(
    primary: DataFrame, secondary: DataFrame | None = None, **options
) -> DataFrame:
    """Documents (id, part, b_history[, a_history])."""
    fields = {"b_history": primary}
    if secondary is not None:
        fields["a_history"] = secondary
    return documents(fields, **options)
