"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.operators.skew import hot_keys, lookup
from linkweave.session import settled


def _with_least_neighbour(links: DataFrame) -> DataFrame:
    """Each (node, other) with the least of the node's others, as `least`."""
    least = links.groupBy("node").agg(F.min("other").alias("least"))
    return lookup(links, least, "node", ["other"], hot=hot_keys(links, "node"))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, class) of every node of the links (x, y); the class is its least node.

    Rounds of two steps after the published large-star and small-star scheme: every node
    sends its greater neighbours to its least one, then its lesser ones. The links shrink
    to stars around the least nodes; the number of rounds grows with the logarithm of the
    number of nodes. Each round is written, so that a lost executor repeats one round.
    """
    down = settled(
        links.where(F.col("x") != F.col("y"))
        .select(F.greatest("x", "y").alias("node"), F.least("x", "y").alias("other"))
        .distinct(),
        "star",
    )
    while True:
        both = settled(
            down.unionAll(down.select(F.col("other").alias("node"), F.col("node").alias("other"))),
            "both-ways",
        )
        large = settled(
            _with_least_neighbour(both)
            .where(F.col("other") > F.col("node"))
            .select(
                F.col("other").alias("node"),
                F.least("node", "least").alias("other"),
            )
            .distinct(),
            "large-star",
        )
        # Every link points down here, so the least of a node's others is below it.
        with_least = _with_least_neighbour(large)
        small = settled(
            with_least.where(F.col("other") != F.col("least"))
            .select(F.col("other").alias("node"), F.col("least").alias("other"))
            .unionAll(with_least.select("node", F.col("least").alias("other")))
            .distinct(),
            "small-star",
        )
        if _summary(small) == _summary(down):
            return small.select("node", F.col("other").alias("class")).unionAll(
                small.select(F.col("other").alias("node"), F.col("other").alias("class")).distinct()
            )
        down = small


def _summary(links: DataFrame) -> tuple:
    """Rows and a sum of their hashes: equal for equal tables."""
    code = F.xxhash64("node", "other").cast("decimal(38,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(code)).first())
