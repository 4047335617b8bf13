"""Pairs of items that can still matter: thresholds and top-k lists without all pairs.

Two items whose score reaches a threshold share a user that is early in the order "fewest
items first" for both of them, because what comes late cannot reach the threshold alone.
So pairs are made from the early entries of each item only, and the pairs found are then
counted in full. Bounds that follow from the two items' sizes skip pairs as they are made.
All of it changes the work and never the result.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from linkweave.functions import similarity as sim
from linkweave.functions.similarity import Measure
from linkweave.operators.packed import SLACK, pair_dots
from linkweave.operators.product import TILE, pair_counts, pair_sums, product_tiles
from linkweave.operators.skew import (
    GroupSummary,
    bucket_of,
    group_sizes,
    group_summary,
    lookup,
)
from linkweave.session import settled

# Buckets of the features of equal frequency: one is early or late as a whole.
BUCKETS = 1_024

# Early entries are used where they make at most this share of all pairs.
PREFIX_SHARE = 0.5

# From this many terms on, rows that are whole numbers meet as packed lists.
PACKED_TERMS = 10_000_000

# Share of all pairs made to find out what each item's k-th score is at least.
PROBE_SHARE = 0.1


class Bounds(NamedTuple):
    """What a threshold asks of counts: the users that two items of given sizes must share,
    and those that an item of some size must share with whatever partner."""

    common: Callable[[Column, Column, float], Column]
    own: Callable[[Column, float], Column]


def _distance(n: Column, most: float) -> Column:
    return n - F.lit(most)


def _root_distance(threshold: float) -> float:
    return (1.0 / threshold - 1.0) ** 2


BOUNDS: dict[Measure, Bounds] = {
    sim.tanimoto: Bounds(lambda n, m, t: (n + m) * F.lit(t / (1.0 + t)), lambda n, t: n * F.lit(t)),
    sim.cosine: Bounds(lambda n, m, t: F.sqrt(n.cast("double") * m) * F.lit(t), lambda n, t: n * F.lit(t * t)),
    sim.euclidean: Bounds(
        lambda n, m, t: _distance(n + m, _root_distance(t)) / 2,
        lambda n, t: _distance(n, _root_distance(t)),
    ),
    sim.city_block: Bounds(
        lambda n, m, t: _distance(n + m, 1.0 / t - 1.0) / 2,
        lambda n, t: _distance(n, 1.0 / t - 1.0),
    ),
    sim.cooccurrence_count: Bounds(lambda n, m, t: F.lit(t), lambda n, t: F.lit(t)),
}


def upper_bound(measure: Measure, n: Column, m: Column, n_users: Column) -> Column | None:
    """The greatest score of two items with n and m users; None for a caller's measure.

    The named measures grow with the common users, but for the log-likelihood ratio, which
    has its greatest value at either end.
    """
    if measure not in BOUNDS and measure is not sim.log_likelihood:
        return None
    most = F.least(n, m)
    best = measure(most, n, m, n_users)
    if measure is sim.log_likelihood:
        least = F.greatest(F.lit(1).cast("bigint"), n + m - n_users)
        best = F.greatest(best, measure(least, n, m, n_users))
    return best * F.lit(1.0 + SLACK)


def _x_log_x(x: Column) -> Column:
    return F.when(x > 0, x * F.ln(x)).otherwise(F.lit(0.0))


def size_terms(n: Column, n_users: Column) -> Column:
    """What `likelihood_bound` needs of an item with n users, worked out once for each item."""
    n, n_users = n.cast("double"), n_users.cast("double")
    return F.struct(_x_log_x(n).alias("own"), _x_log_x(n_users - n).alias("others"))


def likelihood_bound(
    n: Column, m: Column, n_terms: Column, m_terms: Column, n_users: Column
) -> Column:
    """`upper_bound` of the log-likelihood ratio with a logarithm or two, as it is worked out
    for each pair that is made. It is short, so that it is compiled along with what makes them.

    The ratio is greatest where all users of the rarer item are common or, if the items have
    more users than independence allows without common ones, as few as can be. Either way a
    cell of the table is empty and most others are of one item only, or of its absence. The
    bound is loosened by what large terms may lose in a difference.
    """
    total = n_users.cast("double")
    all_users = _x_log_x(total)
    n, m = n.cast("double"), m.cast("double")
    own = F.when(n <= m, m_terms["own"]).otherwise(n_terms["own"])
    others = F.when(n <= m, n_terms["others"]).otherwise(m_terms["others"])
    nested = _x_log_x(F.abs(m - n)) - own - others
    neither = total - n - m
    absent = F.when(neither >= 0, n_terms["others"] + m_terms["others"]).otherwise(
        n_terms["own"] + m_terms["own"]
    )
    apart = F.when(n * m > total, _x_log_x(F.abs(neither)) - absent)
    ratio = 2.0 * (all_users + F.greatest(nested, apart)) + all_users * F.lit(1e-12)
    return (1.0 - 1.0 / (1.0 + F.greatest(F.lit(0.0), ratio) * F.lit(1.0 + SLACK))) * F.lit(1.0 + SLACK)


def early_entries(
    entries: DataFrame, item: str, feature: str, mass: str, need: Column
) -> DataFrame:
    """Entries of each item that come early in the order "rarest feature first".

    An entry is late if it and all later ones of the item have less than `need` of its
    mass; `need` is a Column of the item's total `__mass`. Two items that share as much as
    either needs have a feature that is early for both. Features of equal frequency are
    ordered by buckets, and a bucket is early as a whole.
    """
    rarity = group_sizes(entries, feature, "__frequency")
    placed = lookup(entries, rarity, feature, [item]).withColumn(
        "__bucket", bucket_of([feature], BUCKETS)
    )
    cell = [item, "__frequency", "__bucket"]
    cells = placed.groupBy(*cell).agg(F.sum(mass).alias("__cell_mass"))
    later = Window.partitionBy(item).orderBy(F.desc("__frequency"), F.desc("__bucket"))
    total = Window.partitionBy(item)
    kept = (
        cells.withColumn("__mass", F.sum("__cell_mass").over(total))
        .withColumn("__rest", F.sum("__cell_mass").over(later))
        .where(F.col("__rest") >= need * F.lit(1.0 - SLACK))
        .select(*cell)
    )
    return placed.join(kept, cell, "left_semi").drop("__frequency", "__bucket")


def summed_pairs(
    candidates: DataFrame, entries: DataFrame, item: str, feature: str, value: str | None = None
) -> DataFrame:
    """What each candidate pair shares: (low, high, n_both, dot) over all its features.

    The entries of the item with fewer of them are put beside each of its pairs, in tiles
    where both are many, and meet those of the other item.
    """
    one = F.lit(1).cast("bigint")
    plain = entries.select(
        F.col(item).alias("__item"),
        F.col(feature).alias("__feature"),
        (F.col(value) if value else one).alias("__w"),
    )
    sizes = group_sizes(plain, "__item", "__n")
    pairs = candidates.select("low", "high")
    for end in ("low", "high"):
        named = sizes.select(F.col("__item").alias(end), F.col("__n").alias(f"__n_{end}"))
        pairs = lookup(settled(pairs, "candidates"), named, end, ["high" if end == "low" else "low"])
    first = F.col("__n_low") <= F.col("__n_high")
    short = F.when(first, F.col("low")).otherwise(F.col("high"))
    long = F.when(first, F.col("high")).otherwise(F.col("low"))
    ends = settled(
        pairs.select(short.alias("__shared"), long.alias("__row"), first.alias("__v")), "ends"
    )
    shorts = plain.select(
        F.col("__item").alias("__shared"), F.col("__feature").alias("__col"), "__w"
    )
    left, right, keys = product_tiles(ends, shorts)
    beside = left.join(right, keys).select(
        F.col("__shared").alias("__short"),
        F.col("__row").alias("__item"),
        F.col("__col").alias("__feature"),
        "__v",
        F.col("__w").alias("__x"),
    )
    met = beside.join(plain, ["__item", "__feature"])
    low = F.when(F.col("__v"), F.col("__short")).otherwise(F.col("__item"))
    high = F.when(F.col("__v"), F.col("__item")).otherwise(F.col("__short"))
    return met.groupBy(low.alias("low"), high.alias("high")).agg(
        F.count(F.lit(1)).alias("n_both"), F.sum(F.col("__x") * F.col("__w")).alias("dot")
    )


def candidate_pairs(
    sized: DataFrame, measure: Measure, threshold: float, summary: GroupSummary
) -> DataFrame | None:
    """Pairs (low, high) among which are all that reach the threshold.

    None where the measure has no bounds, or where the early entries would make about as
    many pairs as all entries do.
    """
    bounds = BOUNDS.get(measure)
    if bounds is None or threshold <= 0:
        return None
    marked = sized.withColumn("__one", F.lit(1).cast("bigint"))
    need = F.greatest(F.lit(1.0), bounds.own(F.col("__mass").cast("double"), threshold))
    early = settled(early_entries(marked, "item_id", "user_id", "__one", need), "early")
    reduced = group_summary(early, "user_id")
    if reduced.squares > PREFIX_SHARE * summary.squares:
        return None

    def possible() -> Column:
        low, high = (F.col(f"__users_{end}") for end in ("low", "high"))
        return F.least(low, high) >= bounds.common(low, high, threshold) * F.lit(1.0 - SLACK)

    found = pair_counts(
        early, "user_id", "item_id", "__users", reduced, wanted=possible
    )
    return found.select("low", "high", "n_low", "n_high")


def pairs_above(
    sized: DataFrame, measure: Measure, threshold: float, summary: GroupSummary
) -> DataFrame:
    """Counts (low, high, n_both, n_low, n_high) of all pairs that may reach the threshold.

    `sized` is (user_id, item_id, __users) with the users of each item.
    """
    candidates = candidate_pairs(sized, measure, threshold, summary)
    if candidates is None:
        users = F.lit(summary.keys)

        def possible() -> Column:
            low, high = (F.col(f"__users_{end}") for end in ("low", "high"))
            return upper_bound(measure, low, high, users) >= F.lit(threshold)

        known = upper_bound(measure, F.lit(1), F.lit(1), users) is not None
        return pair_counts(
            sized, "user_id", "item_id", "__users", summary, wanted=possible if known else None
        )
    candidates = settled(candidates, "candidates")
    counted = summed_pairs(candidates, sized, "item_id", "user_id").drop("dot")
    return counted.join(candidates, ["low", "high"])


def kth_scores(
    sized: DataFrame, measure: Measure, k: int, summary: GroupSummary
) -> DataFrame | None:
    """(item_id, __kth): what the k-th best score of an item is at least.

    Only users with few items are looked at, as many as make PROBE_SHARE of all pairs.
    What they count is no more than the true count, and the score at it no more than the
    true score; for the log-likelihood ratio this holds from the count of independence on.
    Items with fewer than k such pairs have no row.
    """
    per_user = group_sizes(sized, "user_id", "__items")
    # One row for each power of two.
    classes = (
        per_user.groupBy(F.ceil(F.log2("__items")).alias("power"))
        .agg(F.sum(F.col("__items").cast("double") * F.col("__items")).alias("squares"))
        .orderBy("power")
        .collect()
    )
    limit, made = 0, 0.0
    for row in classes:
        made += row.squares
        if made > PROBE_SHARE * summary.squares:
            break
        limit = 2**row.power
    if limit < 2:
        return None
    light = per_user.where(F.col("__items") <= limit).select("user_id")
    probe = settled(sized.join(light, "user_id", "left_semi"), "probe")
    pairs = pair_counts(probe, "user_id", "item_id", "__users")
    counts = (*(F.col(c) for c in ("n_both", "n_low", "n_high")), F.lit(summary.keys))
    score = measure(*counts)
    if measure is sim.log_likelihood:
        above = F.col("n_both").cast("double") * summary.keys >= F.col("n_low").cast("double") * F.col("n_high")
        score = F.when(above, score).otherwise(F.lit(0.0))
    scored = pairs.select("low", "high", score.alias("score"))
    ends = F.array(F.col("low"), F.col("high"))
    both = scored.select(F.explode(ends).alias("item_id"), "score").where(F.col("score") > 0)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"))
    ranked = both.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= k)
    return (
        ranked.groupBy("item_id")
        .agg(F.count(F.lit(1)).alias("__found"), F.min("score").alias("__kth"))
        .where(F.col("__found") == k)
        .select("item_id", "__kth")
    )


def pairs_for_top(
    sized: DataFrame, measure: Measure, k: int, summary: GroupSummary
) -> DataFrame:
    """Counts, as `pairs_above` gives them, of all pairs in the top k of either item."""
    if upper_bound(measure, F.lit(1), F.lit(1), F.lit(1)) is None:
        return pair_counts(sized, "user_id", "item_id", "__users", summary)
    least = kth_scores(sized, measure, k, summary)
    if least is None:
        return pair_counts(sized, "user_id", "item_id", "__users", summary)
    bounded = lookup(sized, settled(least, "kth-scores"), "item_id", ["user_id"], "left")
    users = F.lit(summary.keys)
    fast = measure is sim.log_likelihood
    kth = F.coalesce("__kth", F.lit(0.0)).alias("kth")
    terms = [size_terms(F.col("__users"), users).alias("terms")] if fast else []
    item = F.struct(F.col("__users").alias("n"), kth, *terms)
    bounded = settled(bounded.select("user_id", "item_id", item.alias("__item_bound")), "bounded")

    def possible() -> Column:
        low, high = (F.col(f"__item_bound_{end}") for end in ("low", "high"))
        if fast:
            best = likelihood_bound(low["n"], high["n"], low["terms"], high["terms"], users)
        else:
            best = upper_bound(measure, low["n"], high["n"], users)
        return best >= F.least(low["kth"], high["kth"])

    found = pair_counts(
        bounded, "user_id", "item_id", "__item_bound", summary, wanted=possible
    )
    return found.select(
        "low", "high", "n_both", F.col("n_low.n").alias("n_low"), F.col("n_high.n").alias("n_high")
    )


def _packed(matrix: DataFrame, summary: GroupSummary) -> bool:
    """Whether the pairs of rows are many, their ids whole numbers and no column needs tiles."""
    whole = isinstance(matrix.schema["item_id"].dataType, IntegralType)
    return whole and summary.largest <= TILE and summary.squares / 2 > PACKED_TERMS


def row_similarity(counts: DataFrame, threshold: float) -> DataFrame:
    """Cosine of each two rows of a counted matrix that reaches the threshold.

    `counts` is (item_id, other_item_id, n_users), as `similar.cross_cooccurrence` gives
    it, best a written table; the result is (item_id, other_item_id, n_common, score), each
    pair from either end. The squares of each row are summed first. A row's late entries,
    whose squares are less than threshold**2 of all, cannot reach the threshold with any
    other row, so pairs are made from early entries and only those summed in full, unless
    that would be most of the pairs anyway.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    matrix = counts.where(F.col("n_users") > 0).select(
        "item_id",
        "other_item_id",
        F.col("n_users").cast("bigint").alias("__value"),
        (F.col("n_users").cast("double") * F.col("n_users")).alias("__square"),
    )
    matrix = settled(matrix, "rows")
    need = F.col("__mass") * F.lit(threshold * threshold)
    early = settled(
        early_entries(matrix, "item_id", "other_item_id", "__square", need), "early-rows"
    )
    norms = matrix.groupBy("item_id").agg(
        F.sum(F.col("__value") * F.col("__value")).alias("__norm")
    )
    summary = group_summary(matrix, "other_item_id")
    reduced = group_summary(early, "other_item_id")
    if reduced.squares > PREFIX_SHARE * summary.squares:
        normed = lookup(matrix, norms, "item_id", ["other_item_id"])
        if _packed(matrix, summary):
            args = ("other_item_id", "item_id", "__value", "__norm", threshold, summary)
            found = settled(pair_dots(normed, *args), "pairs")
            whole = matrix.schema["item_id"].dataType
            named = norms.select(F.col("item_id").alias("high"), F.col("__norm").alias("__norm_high"))
            found = lookup(
                found.select(
                    *[F.col(end).cast(whole).alias(end) for end in ("low", "high")],
                    "n_both",
                    "dot",
                    F.col("norm_low").alias("__norm_low"),
                ),
                named,
                "high",
                ["low"],
            )
        else:
            found = pair_sums(normed, "other_item_id", "item_id", "__value", ["__norm"], summary)
    else:
        pairs = pair_counts(early, "other_item_id", "item_id", summary=reduced)
        found = summed_pairs(pairs, matrix, "item_id", "other_item_id", "__value")
        for end in ("low", "high"):
            named = norms.select(
                F.col("item_id").alias(end), F.col("__norm").alias(f"__norm_{end}")
            )
            found = found.join(named, end)
    score = F.col("dot").cast("double") / F.sqrt(
        F.col("__norm_low").cast("double") * F.col("__norm_high")
    )
    scored = found.select("low", "high", F.col("n_both").alias("n_common"), score.alias("score"))
    ends = F.array(
        F.struct(F.col("low").alias("item_id"), F.col("high").alias("other_item_id")),
        F.struct(F.col("high").alias("item_id"), F.col("low").alias("other_item_id")),
    )
    return (
        scored.where(F.col("score") >= threshold)
        .select(F.explode(ends).alias("__end"), "n_common", "score")
        .select("__end.*", "n_common", "score")
    )
