"""Preferences with values, and sums of scores of any size."""

import itertools
import math
import random
from collections import defaultdict
from decimal import Decimal

import pytest

from linkweave import UpdateConfig
from linkweave.operators import prefs, recommend, similar
from linkweave.plans.update import update


def matrix(spark, rows):
    frame = spark.createDataFrame(rows, "user_id bigint, item_id bigint, weight double")
    return prefs.valued_matrix(frame)


def random_values(users=14, items=9, seed=2):
    chance = random.Random(seed)
    rows = [
        (u, i, chance.choice([-2.5, 0.125, 1.0, 3.0, 4.75]))
        for u in range(users)
        for i in range(items)
        if chance.random() < 0.6
    ]
    # A third of all preferences are one user's.
    return rows + [(99, i, 1.0 + i % 3) for i in range(items)]


def brute(rows, measure):
    vectors = defaultdict(dict)
    for u, i, w in rows:
        vectors[i][u] = w
    found = {}
    for i, j in itertools.permutations(vectors, 2):
        a, b = vectors[i], vectors[j]
        common = a.keys() & b.keys()
        if not common:
            continue
        if measure == "pearson":
            mean_a, mean_b = sum(a.values()) / len(a), sum(b.values()) / len(b)
            a = {u: w - mean_a for u, w in a.items()}
            b = {u: w - mean_b for u, w in b.items()}
        dot = sum(a[u] * b[u] for u in common)
        norms = sum(w * w for w in a.values()), sum(w * w for w in b.values())
        if measure == "euclidean":
            score = 1 / (1 + math.sqrt(max(0.0, sum(norms) - 2 * dot)))
        elif norms[0] * norms[1] < 1e-12:
            continue
        else:
            score = dot / math.sqrt(norms[0] * norms[1])
        if abs(score) > 1e-9:
            found[i, j] = (len(common), score)
    return found


@pytest.mark.parametrize("measure", ["cosine", "euclidean", "pearson"])
@pytest.mark.parametrize("tile", [4, 1024])
def test_value_measures(spark, monkeypatch, measure, tile):
    from linkweave.operators import product

    monkeypatch.setattr(product.pair_sums, "__defaults__", (None, tile))
    names = {
        "cosine": "SIMILARITY_COSINE",
        "euclidean": "SIMILARITY_EUCLIDEAN_DISTANCE",
        "pearson": "SIMILARITY_PEARSON_CORRELATION",
    }
    rows = random_values()
    scored = similar.value_similarity(matrix(spark, rows), names[measure]).collect()
    expected = brute(rows, measure)
    found = {(r.item_id, r.other_item_id): (r.n_both, r.score) for r in scored}
    found = {k: v for k, v in found.items() if abs(v[1]) > 1e-9}
    assert found.keys() == expected.keys()
    for key, (n, score) in expected.items():
        assert found[key] == (n, pytest.approx(score, rel=1e-9))


def test_own_measure_and_unknown_names(spark):
    rows = matrix(spark, random_values())
    own = similar.value_similarity(rows, lambda p: p.dot / (p.squares_i + p.squares_j - p.dot))
    cosine = similar.value_similarity(rows)
    assert 0 < own.where("score < 1").count() <= cosine.count()
    with pytest.raises(ValueError, match="no form for values"):
        similar.value_similarity(rows, "SIMILARITY_LOGLIKELIHOOD")


def test_valued_matrix(spark):
    rows = [(1, 1, 2.0, 5), (1, 1, 1.0, 9), (1, 2, None, 1), (1, 3, 0.0, 1), (2, 1, 0.1234567, 1)]
    frame = spark.createDataFrame(rows, "user_id int, item_id int, weight double, ts int")
    last = {tuple(r) for r in prefs.valued_matrix(frame, order="ts").collect()}
    assert last == {(1, 1, Decimal("1.000000")), (2, 1, Decimal("0.123457"))}
    greatest = {r.value for r in prefs.valued_matrix(frame).where("user_id = 1").collect()}
    assert greatest == {Decimal("2.000000")}
    assert prefs.valued_matrix(frame.limit(0)).count() == 0


def recs_of(spark, links, history, **options):
    links = spark.createDataFrame(links, "item_id bigint, other_item_id bigint, score double")
    schema = "user_id bigint, item_id bigint" + (", value double" if options.get("value") else "")
    found = recommend.primary_recs(links, spark.createDataFrame(history, schema), **options)
    return [tuple(r) for r in found.orderBy("user_id", "rank").collect()]


@pytest.mark.parametrize(
    "sizes", [(1e-10, 0.9e-10), (3e9, 2.7e9), (1e-15, 0.99e-15), (1e18, 3e9), (3e9, 1e-10)]
)
def test_scores_of_any_size(spark, sizes):
    found = recs_of(spark, [(10, 1, sizes[0]), (20, 1, sizes[1])], [(7, 1)])
    assert [(r[1], r[3]) for r in found] == [(10, 1), (20, 2)]
    for row, size in zip(found, sizes, strict=True):
        assert row[2] == pytest.approx(size, rel=1e-9)


def test_sums_over_any_size(spark):
    """Sums beyond 2**31, of unlike sizes, and of either sign, in whatever order they come."""
    links = [(10, k, 1.5e9) for k in range(5)] + [(20, 0, 1e12), (20, 1, 1e-3), (20, 2, -1e12)]
    history = [(7, k) for k in range(5)]
    for seed in range(3):
        random.Random(seed).shuffle(links)
        assert recs_of(spark, links, history) == [(7, 10, 7.5e9, 1), (7, 20, pytest.approx(1e-3), 2)]


def test_weighted_average(spark):
    links = [(10, 1, 0.5), (10, 2, 0.25), (20, 1, 0.5), (30, 1, 0.5), (30, 2, -0.5)]
    history = [(7, 1, 4.0), (7, 2, 1.0)]
    found = recs_of(spark, links, history, score_mode="weighted_average", value="value")
    # Item 20 has one supporting item only.
    assert found == [(7, 10, 3.0, 1), (7, 30, 1.5, 2)]
    summed = recs_of(spark, links, history, value="value")
    assert [r[1:3] for r in summed] == [(10, 2.25), (20, 2.0), (30, 1.5)]


def test_blend_keeps_small_and_great_scores(spark):
    schema = "user_id bigint, item_id bigint, score double"
    one = spark.createDataFrame([(1, 1, 1e-12), (1, 2, 4e9), (1, 3, 2.0)], schema)
    two = spark.createDataFrame([(1, 2, 4e9), (1, 4, 1e-15)], schema)
    found = recommend.blended_recs([(one, 1.0), (two, 0.5)], 4).orderBy("rank").collect()
    assert [(r.item_id, r.score) for r in found] == [(2, 6e9), (3, 2.0), (1, 1e-12), (4, 5e-16)]


def test_update_with_values(spark, tmp_path):
    """The value column of a log reaches the preferences, the links and the recommendations."""
    rows = random_values(seed=5)
    logs = tmp_path / "logs"
    logs.mkdir()
    lines = [f"u{u}\tpurchase\ti{i}\t{w}" for u, i, w in rows] + ["u1\tpurchase\ti1\tnone"]
    (logs / "a.tsv").write_text("\n".join(lines))
    config = UpdateConfig(
        str(logs), str(tmp_path / "model"), value_col=3, on_bad_line="quarantine",
        similarity="SIMILARITY_COSINE", score_mode="weighted_average", exclude_known=False,
    )
    result = update(spark, config)
    assert [r.raw for r in result["bad_lines"].collect()] == ["u1\tpurchase\ti1\tnone"]
    names = {r.int_id: r.ext_id for r in result["items"].collect()}
    expected = {(f"i{i}", f"i{j}"): v for (i, j), v in brute(rows, "cosine").items()}
    found = {
        (names[r.item_id], names[r.other_item_id]): (r.n_both, pytest.approx(r.score))
        for r in result["p_sims"].collect()
    }
    assert {k: v for k, v in found.items() if k in expected} == expected
    scores = {r.score for r in result["p_recs"].collect()}
    assert len(scores) > 3
