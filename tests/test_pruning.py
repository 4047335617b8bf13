"""Thresholds, top-k lists and row similarity: the same rows as from all pairs, from fewer."""

import math
import random
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from linkweave.functions.similarity import MEASURES
from linkweave.operators import product, pruning, similar
from linkweave.operators.skew import group_summary, with_group_size

NAMED = sorted(MEASURES)


def history_rows(seed=1, users=60, items=40):
    """Rare and frequent items, light and heavy users, and one user with a third of all rows."""
    chance = random.Random(seed)
    rows = set()
    for u in range(users):
        for _ in range(chance.choice([2, 3, 5, 12])):
            rows.add((u, min(int(chance.expovariate(0.12)), items - 1)))
    # Items that go together.
    for u in range(0, users, 7):
        rows |= {(u, 100), (u, 101)}
    rows |= {(u, 102) for u in range(0, users, 14)}
    rows |= {(999, i) for i in range(items)}
    return sorted(rows)


@pytest.fixture(scope="module")
def history(spark):
    return spark.createDataFrame(history_rows(), "user_id bigint, item_id bigint").cache()


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("measure", NAMED)
@pytest.mark.parametrize("threshold", [0.2, 0.55, 0.9])
def test_threshold(history, monkeypatch, measure, threshold):
    """With and without early entries, as the limit on their share decides."""
    if measure == "SIMILARITY_COOCCURRENCE":
        threshold *= 8
    everything = similar.item_similarity(history, measure).where(F.col("score") >= threshold)
    expected = rows_of(everything)
    for share in (0.0, 1e9):
        monkeypatch.setattr(pruning, "PREFIX_SHARE", share)
        assert rows_of(similar.item_similarity(history, measure, threshold)) == expected


def test_own_measure_with_threshold(history):
    def overlap(both, n_i, n_j, n_users):
        return both / F.least(n_i, n_j)

    expected = similar.item_similarity(history, overlap).where("score >= 0.7")
    assert rows_of(similar.item_similarity(history, overlap, 0.7)) == rows_of(expected)


def sized(history):
    return with_group_size(history, "item_id", ["user_id"], "__users")


def test_fewer_pairs_for_a_threshold(history, monkeypatch):
    monkeypatch.setattr(pruning, "PREFIX_SHARE", 1e9)
    table, summary = sized(history), group_summary(history, "user_id")
    everything = product.pair_counts(history, "user_id", "item_id").count()
    for name in ("SIMILARITY_TANIMOTO_COEFFICIENT", "SIMILARITY_COSINE"):
        made = pruning.candidate_pairs(table, MEASURES[name], 0.6, summary)
        assert 0 < made.count() < everything / 3


def test_fewer_pairs_for_top_lists(spark, monkeypatch):
    """Triples of rare items and some frequent ones, which one heavy user all has."""
    monkeypatch.setattr(pruning, "PROBE_SHARE", 0.5)
    rows = [(u, 3 * t + k) for t in range(15) for u in range(10 * t, 10 * t + 3) for k in range(3)]
    rows += [(u, 1000 + k) for u in range(200, 260) for k in range(4)]
    rows += [(999, i) for i in {i for _, i in rows}]
    frame = spark.createDataFrame(rows, "user_id bigint, item_id bigint")
    table, summary = sized(frame), group_summary(frame, "user_id")
    everything = product.pair_counts(frame, "user_id", "item_id").count()
    for name in ("SIMILARITY_TANIMOTO_COEFFICIENT", "SIMILARITY_LOGLIKELIHOOD"):
        made = pruning.pairs_for_top(table, MEASURES[name], 2, summary)
        assert 0 < made.count() < everything * 0.9
        expected = similar.top_similar(similar.item_similarity(frame, name), 2)
        assert rows_of(similar.top_k_similarity(frame, 2, name)) == rows_of(expected)


@pytest.mark.parametrize("measure", NAMED)
@pytest.mark.parametrize("probe", [0.02, 0.5])
def test_top_k(history, monkeypatch, measure, probe):
    monkeypatch.setattr(pruning, "PROBE_SHARE", probe)
    expected = similar.top_similar(similar.item_similarity(history, measure), 3)
    assert rows_of(similar.top_k_similarity(history, 3, measure)) == rows_of(expected)


def test_top_k_small_tiles(history, monkeypatch):
    monkeypatch.setattr(product.pair_counts, "__defaults__", (None, None, 4, None))
    monkeypatch.setattr(pruning, "PROBE_SHARE", 0.5)
    expected = similar.top_similar(similar.item_similarity(history), 3)
    assert rows_of(similar.top_k_similarity(history, 3)) == rows_of(expected)


def test_top_k_of_own_measure_and_empty(history):
    own = lambda both, n_i, n_j, n_users: both / n_i / n_j
    expected = similar.top_similar(similar.item_similarity(history, own), 2)
    assert rows_of(similar.top_k_similarity(history, 2, own)) == rows_of(expected)
    assert similar.top_k_similarity(history.limit(0), 2).count() == 0
    assert similar.item_similarity(history.limit(0), "SIMILARITY_COSINE", 0.5).count() == 0


def brute_rows(cells, threshold):
    rows = defaultdict(dict)
    for i, j, n in cells:
        rows[i][j] = n
    found = []
    for a, b in permutations(rows, 2):
        common = rows[a].keys() & rows[b].keys()
        dot = sum(rows[a][c] * rows[b][c] for c in common)
        norm = math.prod(sum(n * n for n in rows[k].values()) for k in (a, b))
        if common and dot / math.sqrt(norm) >= threshold:
            found.append((a, b, len(common), pytest.approx(dot / math.sqrt(norm))))
    return sorted(found, key=lambda r: r[:2])


@pytest.mark.parametrize("threshold", [0.3, 0.75, 1.0])
@pytest.mark.parametrize("share", [0.0, 1e9])
def test_row_similarity(spark, monkeypatch, threshold, share):
    monkeypatch.setattr(pruning, "PREFIX_SHARE", share)
    chance = random.Random(threshold)
    counted = Counter((chance.randrange(25), int(chance.expovariate(0.1))) for _ in range(700))
    cells = [(i, j, n) for (i, j), n in counted.items()]
    # Proportional rows, and a row with an entry in every column.
    cells += [(50, 900, 3), (50, 901, 4), (51, 900, 6), (51, 901, 8)]
    cells += [(60, j, 1 + j % 9) for j in range(60)]
    frame = spark.createDataFrame(cells, "item_id bigint, other_item_id bigint, n_users bigint")
    found = rows_of(pruning.row_similarity(frame, threshold))
    assert found == brute_rows(cells, threshold)
    assert {(50, 51), (51, 50)} <= {r[:2] for r in found}


def test_row_similarity_threshold(spark):
    empty = spark.createDataFrame([], "item_id int, other_item_id int, n_users int")
    assert pruning.row_similarity(empty, 0.5).count() == 0
    with pytest.raises(ValueError, match="threshold"):
        pruning.row_similarity(empty, 0.0)
