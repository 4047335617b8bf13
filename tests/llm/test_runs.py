"""Periodic runs next to brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from linkweave.llm import periodic_runs, queries
from linkweave.llm.periodic_runs import Grammar, find_runs


def brute_runs(words):
    found = set()
    n = len(words)
    for q in range(1, n // 2 + 1):
        x = 0
        while x + q < n:
            first = x
            while x + q < n and words[x] == words[x + q]:
                x += 1
            if x - first + q >= max(12, 2 * q) and x > first:
                found.add((first, x - first + q, q))
            x += 1
    least = {}
    for start, length, q in sorted(found, key=lambda r: r[2]):
        least.setdefault((start, length), q)
    return sorted((s, m, q) for (s, m), q in least.items())


def random_text(chance):
    n = chance.choice([0, 1, 11, 12, 13, 30, 60, 150])
    letters = chance.choice([1, 2, 3, 20])
    words = [b"w%d" % chance.randrange(letters) for _ in range(n)]
    if n > 20 and chance.random() < 0.6:
        a = chance.randrange(n)
        p = 1 + (n - a) // chance.randint(3, 10)
        words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
    return words


def test_runs_equal_brute_force():
    chance = random.Random(5)
    seen = 0
    for _ in range(150):
        texts = [random_text(chance) for _ in range(chance.randint(1, 12))]
        for words, runs in zip(texts, find_runs(texts), strict=True):
            expected = brute_runs(words)
            assert [tuple(r) for r in runs.tolist()] == expected
            seen += len(expected)
    assert seen > 300


def test_long_texts_in_lists(monkeypatch):
    """Texts beyond the shared grid, with few pairs in a list."""
    monkeypatch.setattr(periodic_runs, "GRID_WORDS", 16)
    monkeypatch.setattr(periodic_runs, "GRID_PAIRS", 37)
    monkeypatch.setattr(periodic_runs, "_GRID", [])
    chance = random.Random(6)
    for _ in range(30):
        words = random_text(chance) + [b"x", b"y"] * chance.randint(0, 30)
        assert [tuple(r) for r in find_runs([words, words[:5]])[0].tolist()] == brute_runs(words)


def test_common_stretches():
    chance = np.random.default_rng(3)
    for _ in range(30):
        text = np.append(chance.integers(0, chance.integers(1, 5), 200), 9)
        i, j = np.sort(chance.integers(0, 200, (2, 300)), axis=0)
        i, j = i[i < j], j[i < j]
        expected = []
        for a, b in zip(i, j, strict=True):
            n = 0
            while text[a + n] == text[b + n]:
                n += 1
            expected.append(n)
        assert Grammar(text, 9, 10).common(i, j).tolist() == expected


def test_very_long_text():
    (run,) = find_runs([[b"a"] * 30_000 + [b"b"]])[0].tolist()
    assert run == [0, 30_000, 1]


def expected_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
    runs = brute_runs(words)
    dropped = {k for s, m, q in runs for k in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = " ".join(w for k, w in enumerate(words) if k not in dropped)
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


@pytest.fixture
def fixture_rows():
    chance = random.Random(8)
    rows = [(n, " ".join(w.decode() for w in random_text(chance))) for n in range(120)]
    rows += [(3, rows[3][1]), (None, "a b " * 9), (None, None), (500, None), (501, ""), (502, " \n\t")]
    rows += [(503, "é x y " * 13), (504, "a\x1cb\x85 " * 12 + "ß"), (505, "l1 l2\nl3\r\x0bl4\x0cl5 " * 4)]
    return rows


def test_query(spark, docs, fixture_rows, tmp_path):
    docs(fixture_rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_periodic_runs(spark, str(tmp_path))
    names = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert found.columns == names
    assert {t for _, t in found.dtypes if t != "string"} == {"bigint"}
    expected = [expected_row(*row) for row in fixture_rows]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))


def test_operator_itself(docs):
    """Its own output: runs and collapsed text, without the query's word order."""
    rows = [(1, "say it " + "now or never " * 6 + "ok"), (2, None)]
    one, none = sorted(periodic_runs.periodic_runs(docs(rows)).collect(), key=lambda r: r.doc_id)
    assert [tuple(r) for r in one.runs] == [(2, 18, 3)] and one.n_words == 21
    assert one.collapsed == "say it now or never ok"
    assert (none.n_words, none.runs, none.collapsed) == (0, [], "")
    assert periodic_runs.periodic_runs(docs(rows).limit(0)).count() == 0
