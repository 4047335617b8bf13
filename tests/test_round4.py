"""Lists that travel as bytes, and joins that keep large tables off the driver."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkweave.operators import packed, pruning, search, skew


def cells(seed=3, far=1):
    """A counted matrix with repeated cells, rows without an id, and ids far apart."""
    chance = random.Random(seed)
    counted = Counter((chance.randrange(40), int(chance.expovariate(0.1))) for _ in range(900))
    rows = [(i * far - 7, j, n * (1 if j % 5 else 70_000)) for (i, j), n in counted.items()]
    # Alike rows, cells that come twice, and a row with an entry in every column.
    rows += [(9_000 * far, j, 2) for j in range(9)] + [(9_001 * far, j, 4) for j in range(9)]
    rows += [(3 * far - 7, 5, 2), (3 * far - 7, 5, 2), (4 * far - 7, 5, 6), (None, 5, 3), (8, None, 2)]
    return rows + [(-60 * far, j, 1 + j % 300) for j in range(60)] + [(2, 3, 0)]


def alike(rows, threshold):
    vectors, norms = defaultdict(lambda: defaultdict(list)), Counter()
    for i, j, n in rows:
        if n > 0:
            norms[i] += n * n
            vectors[i][j].append(n)
    found = {}
    for a in vectors.keys() - {None}:
        for b in vectors.keys() - {None, a}:
            common = vectors[a].keys() & vectors[b].keys() - {None}
            pairs = [(x, y) for c in common for x in vectors[a][c] for y in vectors[b][c]]
            score = sum(x * y for x, y in pairs) / (float(norms[a]) * norms[b]) ** 0.5
            if pairs and score >= threshold:
                found[a, b] = (len(pairs), pytest.approx(score))
    return found


@pytest.mark.parametrize("threshold", [0.2, 0.75])
@pytest.mark.parametrize("far", [1, 100_003, 10**15])
@pytest.mark.parametrize("terms", [600, 4_000_000], ids=["hot", "even"])
def test_rows_meet_as_bytes(spark, monkeypatch, threshold, far, terms):
    """what a row gets of the others are bytes, a few for each, and no longer their norms."""
    monkeypatch.setattr(pruning, "PREFIX_SHARE", 0)
    monkeypatch.setattr(pruning, "PACKED_TERMS", 0)
    monkeypatch.setattr(packed, "LISTED_TERMS", terms)
    rows = cells(far=far)
    made = []

    def pair_dots(*args):
        made.append(packed.pair_dots(*args))
        return made[-1]

    monkeypatch.setattr(pruning, "pair_dots", pair_dots)
    table = spark.createDataFrame(rows, "item_id bigint, other_item_id bigint, n_users bigint")
    found = pruning.row_similarity(table, threshold).collect()
    assert {(r[0], r[1]): (r.n_common, r.score) for r in found} == alike(rows, threshold)
    assert (9_000 * far, 9_001 * far) in {r[:2] for r in found}
    plan = made[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2 and "substring(__ids" in plan
    assert ("LeftAnti" in plan) == (terms == 600)
    # The tasks that make the bytes, and those that read them, are set by the terms.
    assert plan.count("RepartitionByExpression") >= 2


def test_rows_with_ids_of_other_types(spark, monkeypatch):
    monkeypatch.setattr(pruning, "PREFIX_SHARE", 0)
    monkeypatch.setattr(pruning, "PACKED_TERMS", 0)
    rows = [(i, j, n) for i, j, n in cells() if i is not None and j is not None]
    expected = alike(rows, 0.3)
    small = spark.createDataFrame(rows, "item_id int, other_item_id int, n_users int")
    found = pruning.row_similarity(small, 0.3)
    assert found.dtypes[:2] == [("item_id", "int"), ("other_item_id", "int")]
    assert {(r[0], r[1]): (r.n_common, r.score) for r in found.collect()} == expected
    names = small.selectExpr("cast(item_id as string) item_id", "other_item_id", "n_users")
    found = pruning.row_similarity(names, 0.3).collect()
    assert {(int(r[0]), int(r[1])): (r.n_common, r.score) for r in found} == expected


def test_numbers_as_bytes():
    widths, pack, unpack, column, parts = packed.number_bytes()
    lists = [[1, 255], [256, 0, 3], [7], [2**32, 1], [2**64 - 1], [65_536, 65_535]]
    values = np.array([x for numbers in lists for x in numbers], np.uint64)
    counts = np.array([len(numbers) for numbers in lists])
    width = widths(values, np.cumsum(counts) - counts)
    assert width.tolist() == [1, 2, 1, 8, 8, 4]
    array = column(*pack(values, counts, width))
    assert [len(x) for x in array.to_pylist()] == [2, 6, 1, 16, 8, 8]
    for at in (0, 2):
        found, sizes = unpack(*parts(array.slice(at)), width[at:])
        assert found.tolist() == [x for numbers in lists[at:] for x in numbers]
        assert sizes.tolist() == counts[at:].tolist()


@pytest.mark.parametrize("size", [1, 3, 1_000])
@pytest.mark.parametrize("chunk", [1, 20, 1_000])
def test_rows_over_batches(size, chunk):
    """A row's lists may come in several batches, and several rows are worked out at once."""
    _, _, _, column, _ = packed.number_bytes()
    chance = random.Random(6)
    lists = [
        (low, sorted(low + 1 + chance.randrange(40) for _ in range(chance.randrange(1, 9))), 1 + k % 3)
        for low in (-5, 2, 3, 90)
        for k in range(12)
    ]
    batches = []
    for k in range(0, len(lists), size):
        part = lists[k : k + size]
        steps = [np.diff([low, *highs]).astype(np.uint8) for low, highs, _ in part]
        sizes = [len(s) for s in steps]
        columns = {
            "__item": pa.array([low for low, _, _ in part]),
            "__c_value": pa.array([v for _, _, v in part]),
            "__c_norm": pa.array([60] * len(part)),
            "__ids": column(np.concatenate(steps), sizes),
            "__id_width": pa.array([1] * len(part), pa.int32()),
            "__values": column(np.full(sum(sizes), 2, np.uint8), sizes),
            "__value_width": pa.array([1] * len(part), pa.int32()),
        }
        batches.append(pa.RecordBatch.from_pydict(columns))
    expected, both, common = Counter(), Counter(), Counter()
    for low, highs, v in lists:
        for high in highs:
            expected[low, high] += 2 * v
            both[low, high] += 1
            common[low, high] += v * v
    found = [tuple(r.values()) for b in packed.added_dots(0.5, chunk)(iter(batches)) for r in b.to_pylist()]
    assert sorted(found) == sorted(
        (*k, both[k], expected[k], 60) for k, shared in common.items() if shared >= 15
    )
    assert 0 < len(found) < len(expected)
    assert not [*packed.added_dots(0.5)(iter([]))]


def test_many_seeds_stay_off_the_driver(spark, tmp_path, monkeypatch):
    """tables of many rows in small files are not sent to all tasks through the driver."""
    rows = 4_000
    tags = spark.range(rows).selectExpr("id item_id", "if(id % 2 = 0, 'a', 'b') category")
    links = spark.range(3 * rows).selectExpr(
        f"id % {rows} item_id", f"(id * 7 + 1) % {rows} other_item_id", "(id % 5) / 5.0D score"
    )
    for name, table in (("tags", tags), ("links", links)):
        table.write.parquet(f"{tmp_path}/{name}")
    tags, links = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("tags", "links"))
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    found, looked_at = {}, []
    hot_keys = skew.hot_keys

    def seen(df, key):
        looked_at.append(df.select(key))
        return hot_keys(df, key)

    monkeypatch.setattr(skew, "hot_keys", seen)
    try:
        for most in (rows, rows - 1):
            monkeypatch.setattr(skew, "MAX_SENT_ROWS", most)
            # Of the two columns more than the limit, of one of them less.
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "15KB")
            assert 1 / 16 < skew._share_of_limit(tags.select("item_id")) <= 1 < skew._share_of_limit(tags)
            best = search.query_cold_start(tags, links, tags, n=2)
            found[most] = sorted(map(tuple, best.collect()))
            # The job that reads the keys alone sent those of the categories to all tasks.
            plan = looked_at.pop()._jdf.queryExecution().executedPlan().toString()
            assert ("BroadcastExchange" in plan) == (most == rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert found[rows] == found[rows - 1] and len(found[rows]) > rows


@pytest.mark.parametrize("far", [1, 70_000, 2**40])
def test_tagged_lists_travel_as_bytes(spark, far):
    """what a user gets of a word's links are bytes, and what it got is read from them."""
    chance = random.Random(far)
    lists = []
    for k in range(50):
        items = [chance.choice([None, *(far * chance.randrange(-90, 90) for _ in range(9))]) for _ in range(k)]
        lists.append((k, 0, (items, [chance.choice(["a", "b", None]) for _ in items])))
    lists.append((50, 1, ([3 * far] * 70_000, ["a"] * 69_999 + ["b"])))
    table = spark.createDataFrame(
        lists, "__shared int, __block bigint, __w struct<__cols: array<bigint>, __ws: array<string>>"
    )
    at = F.array_position("__w.tags", F.lit("a"))
    kept = packed.packed_tags(table).select(
        "__shared", "__w.first", "__w.steps", "__w.width", "__w.nulls",
        F.when(at > 0, F.get("__w.places", (at - 1).cast("int"))).alias("same"),
    )
    sizes = {r[0]: len(r.steps) for r in kept.collect()}
    assert sizes[50] == 69_999 and sizes[49] <= 48 * {1: 1, 70_000: 4, 2**40: 8}[far]
    unpacked = packed.unpacked_tags("__shared", pa.int64())
    schema = "__shared int, items array<bigint>, same array<bigint>"
    found = {r[0]: r for r in kept.mapInArrow(unpacked, schema).collect()}
    assert len(found) == 51
    for k, _, (items, tags) in lists:
        assert Counter(found[k]["items"]) == Counter(items)
        assert Counter(found[k].same) == Counter(
            i for i, t in zip(items, tags, strict=True) if t == "a" and i is not None
        )


def test_category_matches_are_bytes(spark):
    """no array of items and no comparison by item where lists are sent to users."""
    rows = [(i, w) for i in range(60) for w in range(i % 7, 60, 5)]
    links = spark.createDataFrame(rows, "item_id int, other_item_id int")
    history = spark.createDataFrame([(u, (u * 7 + k) % 60) for u in range(9) for k in range(4)], "user_id int, item_id int")
    tags = spark.createDataFrame([(i, i % 3) for i in range(60)], "item_id int, category int")
    mine = spark.createDataFrame([(u, u % 4) for u in range(8)], "user_id int, category int")
    found = search.query_category(history, links, tags, mine, n=3)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2 and "filter(" not in plan
    scores = defaultdict(Counter)
    for u, w in {(u, (u * 7 + k) % 60) for u in range(9) for k in range(4)}:
        scores[u].update(i for i, other in rows if other == w)
    expected = set()
    for u, counts in scores.items():
        best = {i: c * (2.0 if u < 8 and i % 3 == u % 4 else 1.0) for i, c in counts.items()}
        for rank, i in enumerate(sorted(best, key=lambda i: (-best[i], -i))[:3], 1):
            expected.add((u, i, best[i], rank))
    assert {tuple(r) for r in found.collect()} == expected
    # Categories that are neither names nor whole numbers are compared by Spark.
    as_doubles = [t.withColumn("category", F.col("category").cast("double")) for t in (tags, mine)]
    assert {tuple(r) for r in search.query_category(history, links, *as_doubles, n=3).collect()} == expected
