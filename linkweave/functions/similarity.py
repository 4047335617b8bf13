"""Similarity of two items from four counts.

Every measure takes the users with both items, the users with each item, and all
users, and returns a Column. They are symmetric in the two items.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

Measure = Callable[[Column, Column, Column, Column], Column]

# Logarithms of counts are summed as whole numbers of this part, so that the order of
# addition does not matter. It is a power of two: scaling loses nothing.
SCORE_UNITS = float(1 << 32)


def _cell(count: Column, row: Column, column: Column, n_users: Column) -> Column:
    ratio = count.cast("double") * n_users / (row.cast("double") * column)
    return F.when(count > 0, count * F.ln(ratio)).otherwise(F.lit(0.0))


def likelihood_ratio(both: Column, n_i: Column, n_j: Column, n_users: Column) -> Column:
    """Dunning's ratio of the two-by-two table, to seven significant digits.

    Each cell is weighed against what independence would give, so that large counts do not
    cancel. The digits are those of a 32-bit float, which any engine cuts alike.
    """
    not_i, not_j = n_users - n_i, n_users - n_j
    ratio = 2.0 * (
        _cell(both, n_i, n_j, n_users)
        + _cell(n_i - both, n_i, not_j, n_users)
        + _cell(n_j - both, not_i, n_j, n_users)
        + _cell(n_users - n_i - n_j + both, not_i, not_j, n_users)
    )
    return F.greatest(F.lit(0.0), ratio).cast("float").cast("double")


def log_likelihood(both: Column, n_i: Column, n_j: Column, n_users: Column) -> Column:
    """Dunning's ratio, squeezed into [0, 1)."""
    return 1.0 - 1.0 / (1.0 + likelihood_ratio(both, n_i, n_j, n_users))


def dependent(both: Column, n_i: Column, n_j: Column, n_users: Column) -> Column:
    """Whether the counts differ from independence, decided on whole numbers."""
    both, n_i, n_j, n_users = (c.cast("decimal(19,0)") for c in (both, n_i, n_j, n_users))
    return both * n_users != n_i * n_j


def cosine(both: Column, n_i: Column, n_j: Column, n_users: Column) -> Column:
    return both / F.sqrt(n_i.cast("double") * n_j)


def tanimoto(both: Column, n_i: Column, n_j: Column, n_users: Column) -> Column:
    return both / (n_i + n_j - both)


def euclidean(both: Column, n_i: Column, n_j: Column, n_users: Column) -> Column:
    return 1.0 / (1.0 + F.sqrt(n_i + n_j - 2 * both))


def city_block(both: Column, n_i: Column, n_j: Column, n_users: Column) -> Column:
    return 1.0 / (1.0 + n_i + n_j - 2 * both)


def cooccurrence_count(both: Column, n_i: Column, n_j: Column, n_users: Column) -> Column:
    return both.cast("double")


# The names users select a measure by.
MEASURES: dict[str, Measure] = {
    "SIMILARITY_LOGLIKELIHOOD": log_likelihood,
    "SIMILARITY_EUCLIDEAN": euclidean,
    "SIMILARITY_EUCLIDEAN_DISTANCE": euclidean,
    "SIMILARITY_COSINE": cosine,
    "SIMILARITY_TANIMOTO_COEFFICIENT": tanimoto,
    "SIMILARITY_CITY_BLOCK": city_block,
    "SIMILARITY_COOCCURRENCE": cooccurrence_count,
}


def resolve(measure: str | Measure) -> Measure:
    """A measure by name, or the caller's own function of the four counts."""
    if callable(measure):
        return measure
    if measure not in MEASURES:
        raise ValueError(f"unknown similarity {measure!r}; known: {sorted(MEASURES)}")
    return MEASURES[measure]


# Similarity from the values of preferences. Every measure takes the sums of a pair.


class PairSums(NamedTuple):
    """Sums over two items' vectors of values; `shared_` ones are over common users."""

    both: Column
    dot: Column
    shared_i: Column
    shared_j: Column
    n_i: Column
    n_j: Column
    sum_i: Column
    sum_j: Column
    squares_i: Column
    squares_j: Column


ValueMeasure = Callable[[PairSums], Column]


def cosine_of_values(p: PairSums) -> Column:
    return p.dot / F.sqrt(p.squares_i * p.squares_j)


def euclidean_of_values(p: PairSums) -> Column:
    squares = p.squares_i + p.squares_j - 2.0 * p.dot
    return 1.0 / (1.0 + F.sqrt(F.greatest(F.lit(0.0), squares)))


def pearson(p: PairSums) -> Column:
    """Cosine of the vectors with their means over their own users taken off.

    A vector without any deviation has no correlation, which is null.
    """
    mean_i, mean_j = p.sum_i / p.n_i, p.sum_j / p.n_j
    dot = p.dot - mean_i * p.shared_j - mean_j * p.shared_i + p.both * mean_i * mean_j
    squares = (p.squares_i - p.sum_i * mean_i) * (p.squares_j - p.sum_j * mean_j)
    return F.when(squares > 0, dot / F.sqrt(squares))


# Names of the measures that look at the values; all others count users.
VALUE_MEASURES: dict[str, ValueMeasure] = {
    "SIMILARITY_COSINE": cosine_of_values,
    "SIMILARITY_EUCLIDEAN": euclidean_of_values,
    "SIMILARITY_EUCLIDEAN_DISTANCE": euclidean_of_values,
    "SIMILARITY_PEARSON_CORRELATION": pearson,
}

# Sums of scores are taken in three whole numbers of this many bits each, so that the order
# of addition does not matter. They reach 90 bits below the power of two above all scores.
LIMB_BITS = 30
LIMBS = ("limb_1", "limb_2", "limb_3")
_LIMB = float(1 << LIMB_BITS)


def limbs(score: Column, top: int) -> list[Column]:
    """A score of size at most 2**top as three whole numbers; each holds the next 30 bits."""
    rest = score * F.lit(2.0 ** (LIMB_BITS - top))
    parts = []
    for _ in LIMBS:
        parts.append(F.floor(rest))
        rest = (rest - parts[-1]) * F.lit(_LIMB)
    return [part.cast("bigint") for part in parts]


def from_limbs(top: int, prefix: str = "") -> Column:
    """The score whose three sums are in the columns LIMBS, after a prefix of their names."""
    first, second, third = (F.col(f"{prefix}{c}").cast("double") for c in LIMBS)
    total = (third / F.lit(_LIMB) + second) / F.lit(_LIMB) + first
    return total * F.lit(2.0 ** (top - LIMB_BITS))


def scaled(score: Column) -> Column:
    """A score below 2**31, and not much below 1, in whole units."""
    return F.floor(score * F.lit(SCORE_UNITS) + F.lit(0.5)).cast("bigint")


def unscaled(units: Column) -> Column:
    return units.cast("double") / F.lit(SCORE_UNITS)
