"""Products whose terms are sent as lists, next to plain Python."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from linkweave.operators import product, pruning, search, similar
from linkweave.plans import registry


def made(seed=4, users=40, items=60):
    """Sparse rows (user, item, weight), one frequent item and one user with many items."""
    chance = random.Random(seed)
    rows = {(u, chance.randrange(items)) for u in range(users) for _ in range(4)}
    rows |= {(u, 7) for u in range(0, users, 2)} | {(99, i) for i in range(0, items, 3)}
    return [(u, i, chance.randrange(1, 9)) for u, i in sorted(rows)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("per_cell", [0, 1e9], ids=["joined", "lists"])
@pytest.mark.parametrize("terms", [60, 20_000_000], ids=["hot", "even"])
def test_pairs_as_lists(spark, monkeypatch, per_cell, terms):
    rows = made()
    monkeypatch.setattr(product, "TERMS_PER_CELL", per_cell)
    monkeypatch.setattr(product, "TASK_TERMS", terms)
    expected = defaultdict(lambda: [0, 0, 0, 0])
    for u, i, v in rows:
        for w, j, x in rows:
            if u == w and i < j:
                for k, more in enumerate((1, v * x, v, x)):
                    expected[i, j][k] += more
    odd = [(None, 3, 1), (5, None, 1), (None, None, 1)]
    table = spark.createDataFrame(rows + odd, "u bigint, i bigint, v bigint")
    table = table.withColumn("c", F.col("i") * 10)
    found = product.pair_sums(table, "u", "i", "v", ["c"]).collect()
    assert {(r[0], r[1]): list(r[2:6]) for r in found} == expected
    assert all(r.c_low == 10 * r.low and r.c_high == 10 * r.high for r in found)
    few = product.pair_counts(table, "u", "i", "c", wanted=lambda: F.col("c_low") + F.col("c_high") > 500)
    wanted = {(i, j): n[0] for (i, j), n in expected.items() if 10 * (i + j) > 500}
    assert {(r.low, r.high): r.n_both for r in few.collect()} == wanted


@pytest.mark.parametrize("per_cell", [0, 1e9], ids=["joined", "lists"])
@pytest.mark.parametrize("sent", [True, False])
@pytest.mark.parametrize("terms, block", [(60, 1_024), (20_000_000, 3)], ids=["hot", "blocks"])
def test_products_as_lists(spark, monkeypatch, per_cell, sent, terms, block):
    rows = made()
    monkeypatch.setattr(product, "TERMS_PER_CELL", per_cell)
    monkeypatch.setattr(product, "TASK_TERMS", terms)
    monkeypatch.setattr(product, "TILE", block)
    monkeypatch.setattr(product, "sent_whole", lambda table: sent)
    links = [(i, c, 1 + (i * c) % 5) for i in range(60) for c in range(i % 4, 60, 7)]
    expected, counts = Counter(), Counter()
    for u, i, v in rows:
        for j, c, w in links:
            if i == j:
                expected[u, c] += v * w
                counts[u, c] += 1
    known = {(u, c) for u, c in expected if (u + c) % 3 == 0} | {(1_000, 5), (None, 5), (5, None)}
    left = spark.createDataFrame([*rows, (None, 3, 1), (4, None, 1)], "u bigint, i bigint, v bigint")
    right = spark.createDataFrame([*links, (None, 1, 1)], "i bigint, c bigint, w bigint")
    without = spark.createDataFrame([*known], "u bigint, c bigint")
    found = product.matrix_product(left, right, "i", "u", "c", "v", "w", without=without).collect()
    ours = {(r.u, r.c): r.value for r in found if r.u is not None}
    assert ours == {k: v for k, v in expected.items() if k not in known}
    # A row without a name is a row like others.
    assert {r.c for r in found if r.u is None} == {c for j, c, _ in links if j == 3}
    plain = product.matrix_product(left, right, "i", "u", "c").collect()
    assert {(r.u, r.c): (r.value, r.n_terms) for r in plain if r.u is not None} == {
        k: (n, n) for k, n in counts.items()
    }


def test_row_similarity_sends_lists(spark, monkeypatch):
    """terms of two rows are not shuffled as rows of their own."""
    monkeypatch.setattr(pruning, "PREFIX_SHARE", 0)
    table = spark.createDataFrame(made(), "item_id bigint, other_item_id bigint, n_users bigint")
    found = pruning.row_similarity(table, 0.9)
    plan = plan_of(found)
    assert "posexplode" in plan
    terms = plan[: plan.index("posexplode")]
    assert "Exchange" not in terms and "Join" not in terms
    vectors = defaultdict(dict)
    for i, j, n in made():
        vectors[i][j] = n
    best = {}
    for i, x in vectors.items():
        for j, y in vectors.items():
            dot = sum(n * y.get(k, 0) for k, n in x.items())
            norms = [sum(n * n for n in v.values()) for v in (x, y)]
            if i != j and dot * dot >= 0.81 * norms[0] * norms[1]:
                best[i, j] = dot / (norms[0] * norms[1]) ** 0.5
    assert {(r[0], r[1]): pytest.approx(r.score) for r in found.collect()} == best


def test_value_of_zero_is_a_preference(spark, tmp_path):
    """a value of 0 is written with the others; a matrix leaves it out."""
    rows = [(n, n, u, "purchase", v, f'{{"k": {k}}}') for n, (u, k, v) in enumerate(
        [(1, 5, 2.5), (1, 5, 0.0), (1, 6, 0.0), (2, 5, 0.0), (2, 5, 7.25), (3, 5, None)]
    )]
    spark.createDataFrame(
        rows, "event_id bigint, ts bigint, user_id bigint, event_type string, value double, props string"
    ).write.parquet(f"{tmp_path}/events.parquet")
    found = registry.valued_prefs(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == [(1, 5, 0.0), (1, 6, 0.0), (2, 5, 7.25)]
    matrix = registry.prefs.valued_matrix(registry.event_log(spark, str(tmp_path)), "value", "event_id")
    assert sorted((r.user_id, r.item_id) for r in matrix.collect()) == [(2, 5)]


def test_short_bound_of_the_likelihood_ratio(spark):
    """as much as `upper_bound` at least, next to it."""
    n_users = F.lit(60).cast("bigint")
    sizes = spark.range(1, 61).select(F.col("id").alias("n"))
    both = sizes.crossJoin(sizes.withColumnRenamed("n", "m"))
    terms = [pruning.size_terms(F.col(c), n_users) for c in ("n", "m")]
    short = pruning.likelihood_bound(F.col("n"), F.col("m"), *terms, n_users)
    long = pruning.upper_bound(pruning.sim.log_likelihood, F.col("n"), F.col("m"), n_users)
    rows = both.select("n", "m", short.alias("short"), long.alias("long")).collect()
    assert len(rows) == 3_600
    assert all(r.short >= r.long * (1 - 1e-9) for r in rows)
    # Where a common user is what independence gives or more, both are the same.
    assert all(r.short <= r.long + 1e-5 for r in rows if r.n * r.m <= 60)


def test_top_links_in_more_tasks(spark, monkeypatch):
    """many rows are ranked in as many tasks as they ask for, few as before."""
    history = spark.createDataFrame(made(), "user_id bigint, item_id bigint, w bigint").drop("w")
    links = similar.item_similarity(history)
    expected = sorted(map(tuple, similar.top_similar(links, 3).collect()))
    few = similar.top_similar(links, 3, rows=similar.most_links(history))
    assert "REPARTITION_BY_NUM" not in plan_of(few).split("Window")[1].split("Aggregate")[0]
    monkeypatch.setattr(similar, "LISTED_TERMS", 50)
    many = similar.top_similar(links, 3, rows=similar.most_links(history))
    tasks = -(-similar.most_links(history) // 50)
    assert tasks > 8 and "hashpartitioning(item_id" in plan_of(many)
    assert f", {int(tasks)}), REPARTITION_BY_NUM" in plan_of(many)
    assert sorted(map(tuple, many.collect())) == expected


def test_cold_start_in_more_tasks(spark, monkeypatch):
    """the same rows, and no shuffle of the links into the default number of tasks."""
    rows = [(i, j, 1.0 / (1 + (i * j) % 7)) for i in range(12) for j in range(12) if i != j]
    links = spark.createDataFrame(rows, "item_id bigint, other_item_id bigint, score double")
    tags = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(10)], "item_id bigint, category string")
    few = search.query_cold_start(tags, links, tags, n=3)
    monkeypatch.setattr(search, "LISTED_TERMS", 10)
    many = search.query_cold_start(tags, links, tags, n=3)
    assert "hashpartitioning(item_id" in plan_of(many)
    assert ", 14), REPARTITION_BY_NUM" in plan_of(many) and "REPARTITION_BY_NUM" not in plan_of(few)
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))
    assert few.count() == 30
