"""The quality classifier and the language model."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from linkweave.llm import adding, lm_score, quality_model

PLAIN = "the of and river stone light under morning walks slowly green hill home".split()


def prose(seed, n=60):
    return " ".join(random.Random(seed).choices(PLAIN, k=n))


def junk(seed, n=60):
    return " ".join(w.upper() + "!!" for w in prose(seed, n).split())


ODD = [(900, None), (901, ""), (None, "the river"), (902, prose(1, 9000)), (3, prose(3)), (903, "\x0b \r")]


@pytest.fixture
def table(docs):
    rows = [(n, junk(n) if n % 4 == 0 else prose(n)) for n in range(200)]
    return docs(rows + ODD)


def held_out(doc_id, modulus, value):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulus == value


def test_adding_in_levels(spark):
    """As many tasks as take several groups on each level."""

    def numbers(batches):
        rows = sum(batch.num_rows for batch in batches)
        if rows:
            yield from adding.parts_of(np.arange(10) * rows + 0.5, 3)

    parts = spark.range(0, 60, 1, 23).mapInArrow(numbers, adding.PARTS)
    total, tasks = adding.added_up(parts, fan_in=2)
    assert tasks == 23 and total.tolist() == (np.arange(10) * 60 + 23 * 0.5).tolist()
    assert adding.added_up(parts.limit(0)) == (None, 0)


def test_quality_scores(spark, table):
    labels = spark.createDataFrame(
        [(n, int(n % 4 != 0), 0) for n in range(0, 200, 2)] + [(1, None, 0), (None, 1, 0), (5, 1, 0), (5, 1, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    found = quality_model.score_quality(table, labels).collect()
    assert len(found) == 206
    for r in found:
        assert r.held_out == held_out(r.doc_id, 4, 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    hidden = [r for r in found if r.held_out and r.doc_id < 200]
    assert len(hidden) > 20
    assert np.mean([r.predicted == (r.doc_id % 4 != 0) for r in hidden]) > 0.95
    # A score depends on the text alone.
    assert len({r.score for r in found if r.doc_id in (900, 901, 903)}) == 1
    assert quality_model.score_quality(table.limit(0), labels).count() == 0


def test_held_out_labels_change_nothing(spark, table):
    labels = [(n, int(n % 4 != 0)) for n in range(200)]
    turned = [(n, 1 - q if held_out(n, 4, 2) else q) for n, q in labels]
    scores = [
        {
            (r.doc_id, r.score)
            for r in quality_model.score_quality(
                table, spark.createDataFrame(rows, "doc_id bigint, quality int")
            ).collect()
        }
        for rows in (labels, turned)
    ]
    assert scores[0] == scores[1]


def test_word_vectors_are_of_all_documents(spark, docs):
    rows = [(n, junk(n) if n % 4 == 0 else prose(n)) for n in range(20)]
    labels = spark.createDataFrame([(n, int(n % 4 != 0)) for n in range(20)], "doc_id bigint, quality int")
    ids = quality_model.FormIds()
    unseen, near = "Zyxwv#%", "Qqkkj+="
    form = ids[unseen.encode()]
    assert form not in {ids[w.encode()] for _, t in rows for w in t.split()}
    vectors, _ = quality_model.fit(docs([*rows, (99, f"{unseen} {near}")]), labels, limit=5)
    index = quality_model.index_vectors()
    wanted = index[ids[near.encode()]]
    assert np.allclose(vectors[form, quality_model.SIZE :], wanted / np.linalg.norm(wanted))


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def test_language_model(table):
    found = lm_score.score_texts(table).collect()
    rows = [(r.doc_id, r.text) for r in table.collect()]
    counts = Counter(w for d, t in rows if not held_out(d, 5, 1) for w in tokens(t))
    total, types = sum(counts.values()), len(counts)
    wanted = []
    for doc_id, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (types + 1))) for w in own)
        wanted.append((doc_id or -1, held_out(doc_id, 5, 1), len(own), sum(counts[w] > 0 for w in own), total, round(base, 6)))
    assert sorted(
        (r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
        for r in found
    ) == sorted(wanted)
    assert all(r.score < 0 for r in found)
    hidden = [r for r in found if r.held_out]
    assert sum(r.score for r in hidden) > sum(r.base_score for r in hidden)


def test_language_model_of_nothing(docs):
    assert lm_score.score_texts(docs([(1, "a")]).limit(0)).count() == 0
    hidden = next(n for n in range(50) if held_out(n, 5, 1))
    (row,) = lm_score.score_texts(docs([(hidden, "a b")])).collect()
    assert (row.train_tokens, row.n_known, row.n_tokens) == (0, 0, 3)


def test_chances_add_up_to_one():
    leaf_tokens = np.arange(lm_score.LEAVES, dtype=float)
    vocabulary = lm_score.Vocabulary(10, 3, np.zeros(0, np.int64), np.zeros(0, np.int64), leaf_tokens, leaf_tokens * 0)
    weights = lm_score.Weights.start(vocabulary)
    chance = np.random.default_rng(1)
    weights.of_class[:] = chance.normal(size=weights.of_class.shape)
    weights.of_leaf[:] = chance.normal(size=weights.of_leaf.shape)
    hashes = np.repeat(chance.integers(0, 2**63, (1, 3)).astype(np.uint64), lm_score.LEAVES, axis=0)
    found = lm_score.log_chances(weights, hashes, np.arange(lm_score.LEAVES))
    assert np.exp(found).sum() == pytest.approx(1, abs=1e-4)


def test_every_feature_learns_from_every_token():
    leaf_tokens = np.ones(lm_score.LEAVES)
    vocabulary = lm_score.Vocabulary(10, 3, np.zeros(0, np.int64), np.zeros(0, np.int64), leaf_tokens, leaf_tokens)
    weights = lm_score.Weights.start(vocabulary)
    chance = np.random.default_rng(2)
    leaf = chance.integers(0, lm_score.LEAVES, 300)
    hashes = chance.integers(0, 2**63, (300, lm_score.FEATURES)).astype(np.uint64)
    trainer = lm_score.Trainer(weights)
    trainer.learn(hashes, leaf)
    of_class, of_leaf = lm_score._rows(hashes, leaf // lm_score.PER_CLASS)
    for k in range(lm_score.FEATURES):
        assert np.abs(trainer.weights.of_class[of_class[:, k]]).max(axis=1).all()
        assert np.abs(trainer.weights.of_leaf[of_leaf[:, k]]).max(axis=1).all()


def test_frequent_words_have_leaves_of_their_own(docs):
    known = docs([(1, None)]).sparkSession.createDataFrame(
        [(0, n, 5, True) for n in range(600)], "chunk bigint, code bigint, total bigint, one boolean"
    )
    found = lm_score._vocabulary(known)
    assert len(found.top) == 511 and len(set(found.leaves(found.top))) == 511
