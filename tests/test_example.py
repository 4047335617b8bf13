"""The 20-row example, end to end and operator by operator."""

import pytest
from pyspark.sql import functions as F

from linkweave.config import UpdateConfig
from linkweave.operators import ids, prefs, recommend, similar
from linkweave.plans.update import update


def rows(df, *columns):
    """The rows as tuples; the expected scores have six decimals."""
    return {
        tuple(round(v, 6) if isinstance(v, float) else v for v in row)
        for row in df.select(*columns).collect()
    }


@pytest.fixture(scope="module")
def b(example_log):
    return prefs.history_matrix(prefs.primary_prefs(example_log, "purchase"))


@pytest.fixture(scope="module")
def a(example_log):
    return prefs.history_matrix(prefs.secondary_prefs(example_log, "purchase", "view"))


def test_dictionaries(example_log):
    users = ids.assign_ids(example_log, "user_id", F.col("seq"))
    items = ids.assign_ids(example_log, "item_id", F.col("seq"))
    assert rows(users, "ext_id", "int_id") == {("u1", 0), ("u2", 1), ("u3", 2), ("u4", 3)}
    assert rows(items, "ext_id", "int_id") == {
        ("iphone", 0), ("ipad", 1), ("nexus", 2), ("galaxy", 3), ("surface", 4),
    }
    assert ids.matrix_dims(example_log).collect()[0].asDict() == {"n_users": 4, "n_items": 5}


# iphone/ipad, nexus/galaxy, iphone/galaxy
@pytest.mark.parametrize(
    ("measure", "expected"),
    [
        ("SIMILARITY_LOGLIKELIHOOD", (0.633175, 0.633175, None)),
        ("SIMILARITY_TANIMOTO_COEFFICIENT", (0.5, 0.5, 0.333333)),
        ("SIMILARITY_COSINE", (0.707107, 0.707107, 0.5)),
        ("SIMILARITY_CITY_BLOCK", (0.5, 0.5, 0.333333)),
        ("SIMILARITY_EUCLIDEAN", (0.5, 0.5, 0.414214)),
        ("SIMILARITY_EUCLIDEAN_DISTANCE", (0.5, 0.5, 0.414214)),
        ("SIMILARITY_COOCCURRENCE", (1.0, 1.0, 1.0)),
    ],
)
def test_measures(b, measure, expected):
    pairs = [("iphone", "ipad"), ("nexus", "galaxy"), ("iphone", "galaxy")]
    wanted = {
        (x, y, s)
        for (p, q), s in zip(pairs, expected, strict=True)
        if s is not None
        for x, y in ((p, q), (q, p))
    }
    found = similar.item_similarity(b, measure)
    assert rows(found, "item_id", "other_item_id", "score") == wanted


def test_own_measure_and_unknown_name(b):
    found = similar.item_similarity(b, lambda both, n_i, n_j, n: both / n)
    assert {r.score for r in found.collect()} == {0.25}
    with pytest.raises(ValueError, match="unknown similarity"):
        similar.item_similarity(b, "SIMILARITY_NONE")


def test_cross(b, a):
    cross = similar.cross_cooccurrence(b, a)
    expected = {
        "iphone": {"iphone": 2, "ipad": 2, "nexus": 1, "galaxy": 2},
        "ipad": {"iphone": 1, "ipad": 1, "nexus": 1, "galaxy": 1},
        "nexus": {"iphone": 1, "ipad": 1, "nexus": 1, "galaxy": 1},
        "galaxy": {"iphone": 2, "ipad": 2, "nexus": 1, "galaxy": 2},
        "surface": {"nexus": 1, "surface": 1},
    }
    assert rows(cross, "item_id", "other_item_id", "n_users") == {
        (i, j, n) for i, row in expected.items() for j, n in row.items()
    }
    recs = recommend.cross_recs(cross, a)
    scores = {
        "u1": {"iphone": 7, "ipad": 4, "nexus": 4, "galaxy": 7, "surface": 1},
        "u2": {"iphone": 7, "ipad": 4, "nexus": 4, "galaxy": 7, "surface": 1},
        "u3": {"iphone": 1, "ipad": 1, "nexus": 1, "galaxy": 1, "surface": 2},
        "u4": {"iphone": 6, "ipad": 3, "nexus": 3, "galaxy": 6},
    }
    assert rows(recs, "user_id", "item_id", "score") == {
        (u, i, float(s)) for u, row in scores.items() for i, s in row.items()
    }


def test_primary_recs(b):
    links = similar.top_similar(similar.item_similarity(b), 100)
    recs = recommend.primary_recs(links, b, known=b)
    assert rows(recs, "user_id", "item_id", "score") == {
        ("u4", "ipad", 0.633175),
        ("u4", "nexus", 0.633175),
    }
    averaged = recommend.primary_recs(links, b, score_mode="weighted_average", known=b)
    assert averaged.count() == 0


LINKS = {
    ("iphone", "ipad", "galaxy ipad iphone nexus"),
    ("ipad", "iphone", "galaxy nexus ipad iphone"),
    ("nexus", "galaxy", "galaxy nexus ipad iphone"),
    ("galaxy", "nexus", "galaxy ipad iphone nexus"),
}
HISTORIES = {
    ("u1", "ipad iphone", "galaxy nexus ipad iphone"),
    ("u2", "galaxy nexus", "galaxy nexus ipad iphone"),
    ("u3", "surface", "surface nexus"),
    ("u4", "galaxy iphone", "galaxy ipad iphone"),
}


@pytest.mark.parametrize(("pattern", "delim"), [(".*tsv", "\t"), (".csv", ",")])
def test_update(spark, example_files, tmp_path, pattern, delim):
    config = UpdateConfig(
        str(example_files), str(tmp_path / "out"), file_pattern=pattern, input_delim=delim, cross=True
    )
    for _ in range(1 if delim == "," else 2):  # a second run replaces the first
        result = update(spark, config)
    assert rows(result["item_links_docs"], "id", "b_b_links", "b_a_links") == LINKS
    assert rows(result["user_history_docs"], "id", "b_history", "a_history") == HISTORIES
    assert result["dims"].collect()[0].asDict() == {"n_users": 4, "n_items": 5}
    assert rows(result["p_recs"], "user_id", "item_id", "score", "rank") == {
        (3, 2, 0.633175, 1),
        (3, 1, 0.633175, 2),
    }
    prefs_dir = tmp_path / "out" / "prefs" / "by-action"
    lines = [
        line
        for part in (prefs_dir / "action_dir=purchase").glob("part-*")
        for line in part.read_text().splitlines()
    ]
    assert sorted(lines) == sorted(
        f"{u}\t{i}\t1.0" for u, i in [(0, 0), (0, 1), (1, 2), (1, 3), (2, 4), (3, 0), (3, 3)]
    )
    headers = {
        part.read_text().splitlines()[0]
        for part in (tmp_path / "out" / "item-links-docs" / "part=0").glob("part-*")
    }
    assert headers == {"id,b_b_links,b_a_links"}


def test_update_full_join_and_single_action(spark, example_files, tmp_path):
    full = update(
        spark,
        UpdateConfig(
            str(example_files / "action-logs.tsv"),
            str(tmp_path / "full"),
            cross=True,
            documents_join="full",
        ),
    )
    found = rows(full["item_links_docs"], "id", "b_b_links", "b_a_links")
    assert set(found) == LINKS | {
        ("surface", "", "surface nexus")
    }
    single = update(spark, UpdateConfig(str(example_files), str(tmp_path / "single")))
    assert rows(single["item_links_docs"], "id", "b_b_links") == {x[:2] for x in LINKS}
    assert rows(single["user_history_docs"], "id", "b_history") == {x[:2] for x in HISTORIES}
    assert not (tmp_path / "single" / "s-recs").exists()
