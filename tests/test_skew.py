"""Hot keys, long rows and long documents, against brute force in plain Python."""

import collections
import itertools
import random

import pytest
from pyspark.sql import functions as F

from linkweave import session
from linkweave.operators import documents, ids, prefs, product, ranking, similar, skew, vectors


def skewed_entries(seed, users=30, items=40):
    """Distinct (user, item) entries: user 0 has a third of them, item 0 has most users."""
    rng = random.Random(seed)
    rows = {(0, i) for i in range(items)}
    for u in range(1, users):
        rows |= {(u, rng.randrange(items)) for _ in range(rng.randrange(1, 5))}
        if rng.random() < 0.8:
            rows.add((u, 0))
    return sorted(rows)


def by_first(rows):
    groups = collections.defaultdict(list)
    for key, value in rows:
        groups[key].append(value)
    return groups


@pytest.fixture(scope="module")
def entries():
    return skewed_entries(1)


def frame(spark, rows, names=("user_id", "item_id")):
    return spark.createDataFrame(rows, ", ".join(f"{n} bigint" for n in names))


@pytest.mark.parametrize("tile", [3, 1024])
def test_pair_counts(spark, entries, tile):
    expected = collections.Counter()
    for items in by_first(entries).values():
        expected.update(itertools.combinations(sorted(items), 2))
    n_users = collections.Counter(i for _, i in entries)
    sized = skew.with_group_size(frame(spark, entries), "item_id", ["user_id"], "n")
    found = product.pair_counts(sized, "user_id", "item_id", "n", tile=tile).collect()
    assert {(r.low, r.high): r.n_both for r in found} == expected
    assert all((r.n_low, r.n_high) == (n_users[r.low], n_users[r.high]) for r in found)
    assert len(found) == len(expected)


@pytest.mark.parametrize("tile", [3, 1024])
def test_matrix_product(spark, entries, tile):
    right = [(k, c, (k * 7 + c) % 5 + 1) for k, c in skewed_entries(2, items=25)]
    expected, terms = collections.Counter(), collections.Counter()
    weights = collections.defaultdict(list)
    for k, c, w in right:
        weights[k].append((c, w))
    for k, r in entries:
        for c, w in weights[k]:
            expected[r, c] += w
            terms[r, c] += 1
    found = product.matrix_product(
        frame(spark, entries, ("k", "r")),
        frame(spark, right, ("k", "c", "w")),
        "k", "r", "c", None, "w", tile=tile,
    ).collect()
    assert {(x.r, x.c): x.value for x in found} == expected
    assert {(x.r, x.c): x.n_terms for x in found} == terms


@pytest.mark.parametrize("hot_rows", [5, 10**6])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup(spark, entries, hot_rows, how):
    names = [(i, i * 10) for i in range(0, 40, 2)]
    df = frame(spark, [*entries, (99, None)])
    hot = skew.hot_keys(df, "item_id", hot_rows)
    counts = collections.Counter(i for _, i in entries)
    assert {r.item_id: r["__buckets"] for r in hot.collect()} == {
        i: -(-n // hot_rows) for i, n in counts.items() if n > hot_rows
    }
    found = skew.lookup(
        df, frame(spark, names, ("item_id", "name")), "item_id", ["user_id"], how, hot
    )
    known = dict(names)
    expected = [(u, i, known.get(i)) for u, i in [*entries, (99, None)]]
    if how == "inner":
        expected = [row for row in expected if row[2] is not None]
    rows = [(r.user_id, r.item_id, r.name) for r in found.collect()]
    assert collections.Counter(rows) == collections.Counter(expected)


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_ids_and_back(spark, entries, monkeypatch, limit):
    """Dictionaries that are sent to all tasks, and ones that meet the ids by salted keys."""
    looked_for = []

    def counted(df, key, hot_rows=5):
        looked_for.append(key)
        return skew.hot_keys(df, key, hot_rows)

    monkeypatch.setattr(ids, "hot_keys", counted)
    dictionaries = [
        session.settled(frame(spark, sorted({(x, 7 * x) for x in side}), ("ext_id", "int_id")))
        for side in zip(*entries, strict=True)
    ]
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        assert [skew.sent_whole(d) for d in dictionaries] == [limit != "-1"] * 2
        coded = session.settled(ids.encode(frame(spark, entries), *dictionaries))
        sides = dict(zip(("user_int", "item_int"), zip(("u", "i"), dictionaries), strict=True))
        back = ids.decode(coded, sides).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert sorted((r.user_int, r.item_int) for r in back) == sorted((7 * u, 7 * i) for u, i in entries)
    assert sorted((r.u, r.i) for r in back) == sorted(entries)
    assert len(looked_for) == (0 if limit != "-1" else 4)


def test_lookup_refuses_other_joins(spark, entries):
    df = frame(spark, entries)
    with pytest.raises(ValueError, match="inner or left"):
        skew.lookup(df, df, "item_id", ["user_id"], "full")


def test_group_size(spark, entries):
    sizes = collections.Counter(u for u, _ in entries)
    df = frame(spark, entries)
    sized = skew.with_group_size(df, "user_id", ["item_id"], "n")
    assert {tuple(r) for r in sized.select("user_id", "item_id", "n").collect()} == {
        (u, i, sizes[u]) for u, i in entries
    }
    squares = sum(n * n for n in sizes.values())
    assert skew.group_summary(df, "user_id") == (len(sizes), max(sizes.values()), squares)
    assert skew.group_summary(df.where("false"), "user_id") == (0, 0, 0)


def weighted_rows(seed, n=300):
    rng = random.Random(seed)
    rows = [(0, i, float(rng.randrange(4))) for i in range(n)]
    return rows + [(g, i, float(rng.randrange(3))) for g in range(1, 5) for i in range(7)]


def ranked(rows):
    groups = collections.defaultdict(list)
    for g, i, w in rows:
        groups[g].append((w, i))
    return {g: sorted(group, reverse=True) for g, group in groups.items()}


def test_group_ranks(spark):
    rows = weighted_rows(3)
    df = spark.createDataFrame(rows, "g bigint, i bigint, w double")
    found = ranking.group_ranks(df, "g", "w", "i", block=16).collect()
    expected = {
        (g, i, rank) for g, group in ranked(rows).items() for rank, (_, i) in enumerate(group, 1)
    }
    assert {(r.g, r.i, r["rank"]) for r in found} == expected
    assert len(found) == len(rows)


@pytest.mark.parametrize("k", [5, 1500])
def test_top_k(spark, k):
    rows = weighted_rows(4, n=4000)
    df = spark.createDataFrame(rows, "g bigint, i bigint, w double")
    found = ranking.top_k(df, "g", [F.desc("w"), F.desc("i")], k, ["i"]).collect()
    expected = {
        (g, i, rank)
        for g, group in ranked(rows).items()
        for rank, (_, i) in enumerate(group[:k], 1)
    }
    assert {(r.g, r.i, r["rank"]) for r in found} == expected
    assert len(found) == len(expected)


def test_long_documents_continue(spark):
    rows = weighted_rows(5, n=50)
    matrix = spark.createDataFrame(rows, "g bigint, i bigint, w double")
    names = spark.createDataFrame(
        [(f"n{i}", i) for i in range(60)], "ext_id string, int_id bigint"
    )
    links = documents.decode_links(matrix, "g", "i", "w", names, names, part_links=8)
    few = documents.decode_links(matrix.where("i < 3"), "g", "i", "w", names, names)
    found = documents.documents({"x": links, "y": few}).collect()
    whole = collections.defaultdict(list)
    for r in sorted(found, key=lambda r: (r.id, r.part)):
        words = r.x.split(" ")
        assert len(words) <= 8
        assert (r.y != "") == (r.part == 0)
        whole[r.id] += words
    assert whole == {f"n{g}": [f"n{i}" for _, i in group] for g, group in ranked(rows).items()}
    assert [r.part for r in sorted(found, key=lambda r: r.part) if r.id == "n0"] == list(range(7))


def test_long_document_without_partner_is_left_out(spark):
    names = spark.createDataFrame([(f"n{i}", i) for i in range(40)], "ext_id string, int_id bigint")
    left = spark.createDataFrame(
        [(0, i, 1.0) for i in range(20)] + [(1, 2, 1.0)], "g bigint, i bigint, w double"
    )
    right = spark.createDataFrame([(1, 3, 1.0), (2, 3, 1.0)], "g bigint, i bigint, w double")
    fields = {
        name: documents.decode_links(m, "g", "i", "w", names, names, part_links=8)
        for name, m in (("x", left), ("y", right))
    }
    inner = documents.documents(fields).collect()
    assert [tuple(r) for r in inner] == [("n1", 0, "n2", "n3")]
    full = documents.documents(fields, how="full").collect()
    assert {(r.id, r.part) for r in full} == {("n0", 0), ("n0", 1), ("n0", 2), ("n1", 0), ("n2", 0)}


def test_long_vectors_are_cut(spark, entries):
    packed = vectors.user_vectors(frame(spark, entries), part_entries=6).collect()
    sizes = collections.Counter(u for u, _ in set(entries))
    assert all(r["items"] == sorted(r["items"]) and r.n_items == sizes[r.user_id] for r in packed)
    assert all(len(r["items"]) == 6 for r in packed if (r.part + 1) * 6 <= r.n_items)
    assert len([r for r in packed if r.user_id == 0]) > 1
    assert {(r.user_id, i) for r in packed for i in r["items"]} == set(entries)
    whole = vectors.item_vectors(frame(spark, entries)).collect()
    assert {(r.item_id, tuple(r.users)) for r in whole} == {
        (i, tuple(users)) for i, users in by_first([(i, u) for u, i in entries]).items()
    }


def test_same_result_for_any_partitioning(spark, entries):
    results = []
    for parts in (1, 7):
        history = frame(spark, entries).repartition(parts)
        top = similar.top_similar(similar.item_similarity(history), 5)
        results.append(sorted(map(tuple, top.collect())))
    assert results[0] == results[1]


def test_properties(spark, entries):
    history = frame(spark, entries)
    other = frame(spark, skewed_entries(9))
    pairs = {
        (r.item_id, r.other_item_id): r.n_both for r in similar.cooccurrence(history).collect()
    }
    assert all(pairs[j, i] == n and i != j for (i, j), n in pairs.items())
    for name in ("LOGLIKELIHOOD", "COSINE", "TANIMOTO_COEFFICIENT", "EUCLIDEAN", "CITY_BLOCK"):
        scores = similar.item_similarity(history, f"SIMILARITY_{name}").collect()
        assert all(0 < r.score <= 1 for r in scores)
    cross = similar.cross_cooccurrence(history, other).agg(F.sum("n_users")).first()[0]
    b, a = by_first(entries), by_first(skewed_entries(9))
    assert cross == sum(len(b[u]) * len(a[u]) for u in b.keys() & a.keys())


def test_min_prefs_and_sample(spark, entries):
    history = frame(spark, entries)
    sizes = collections.Counter(u for u, _ in entries)
    kept = {r.user_id for r in prefs.min_prefs(history, 4).collect()}
    assert kept == {u for u, n in sizes.items() if n >= 4}
    assert prefs.min_prefs(history, 1) is history
    samples = [
        {tuple(r) for r in prefs.downsample_prefs(history.repartition(p), 3).collect()}
        for p in (1, 5)
    ]
    assert samples[0] == samples[1] <= set(entries)
    assert collections.Counter(u for u, _ in samples[0]) == {u: min(n, 3) for u, n in sizes.items()}
