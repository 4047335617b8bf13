"""Personal data: patterns next to plain regular expressions, the field next to brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkweave.llm import crf, personal_data, queries
from linkweave.llm.personal_data import KINDS, pattern_spans

# The four patterns as the contract states them.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain_spans(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                "card": 14 <= len(digits) <= 19 and plain_luhn(digits or "1"),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((kind, *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def test_patterns():
    chance = random.Random(4)
    pieces = [
        "a", "B9", "@", ".", "..", "@x.y", "1", "255", "256", "007", "+1", "+", "-", " ", "(", ")",
        "4111111111111111", "4111 1111-1111 1111", "1.2.3.4", "%", "é", "²", "٣", "mail.de", "\n",
    ]
    for _ in range(4000):
        text = "".join(chance.choices(pieces, k=chance.randint(0, 14)))
        assert pattern_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("text", ["1" * 300_000, "a" * 300_000 + "@", "@a" * 100_000, "+1 " * 99_999])
def test_patterns_on_long_texts(text):
    """Each takes about as long as the text is."""
    assert all(k in KINDS for k, *_ in pattern_spans(text))


def small_field(chance):
    field = crf.Crf(["O", "B-x", "I-x", "B-y", "I-y"], np.empty(0, np.uint64))
    for table in (field.weights, field.steps, field.first):
        table[...] = chance.normal(size=table.shape)
    return field


def best_path(field, emissions):
    steps, first = field._scores()
    best = None
    for path in itertools.product(range(len(field.labels)), repeat=len(emissions)):
        score = first[path[0]] + sum(emissions[t, p] for t, p in enumerate(path))
        score += sum(steps[a, b] for a, b in itertools.pairwise(path))
        if best is None or score > best[0]:
            best = (score, path)
    return best[1]


def test_decoding():
    chance = np.random.default_rng(2)
    text = "One, 2 a@b\nx\nA b 3. No 5-5 k\n\n  \nZz 1.2"
    for shift in (0.0, 6.0):
        field = small_field(chance)
        field.weights[:, 0] += shift / 5  # with the larger one most units are passed over
        tokens = crf.tokens_of(crf.code_points(text))
        emissions, labels = field.emissions(tokens), field.decode(tokens)
        ends = [*tokens.units[1:], len(labels)]
        assert len(ends) == 5
        for a, b in zip(tokens.units, ends, strict=True):
            assert tuple(labels[a:b]) == best_path(field, emissions[a:b])


def test_slopes():
    chance = np.random.default_rng(3)
    field = small_field(chance)
    tokens = crf.tokens_of(crf.code_points("One, 2 a@b\nx\nA b 3. No 5"))
    n = len(tokens.start)
    gold = np.zeros(n, np.int64)
    gold[1], gold[2] = 1, 2
    _, by_emission, by_step, by_first = field.loss(tokens, gold)
    rows = field.features(tokens)
    weights, steps, first = field.weights, field.steps, field.first
    slope = np.zeros(weights.shape)
    for r in rows:
        np.add.at(slope, r, by_emission)
    small = 1e-2
    places = [(weights, slope, (rows[2][k], c)) for k in (0, 3) for c in (0, 2)]
    places += [(steps, by_step, (0, 1)), (steps, by_step, (1, 2)), (first, by_first, (3,))]
    for table, slopes, at in places:
        kept = table[at]
        table[at] = kept + small
        up = field.loss(tokens, gold)[0]
        table[at] = kept - small
        down = field.loss(tokens, gold)[0]
        table[at] = kept
        assert (up - down) / (2 * small) == pytest.approx(slopes[at], abs=2e-3)


@pytest.fixture(scope="module")
def field(spark):
    return personal_data.train_field(personal_data.labelled_table(spark))


def test_held_out(spark, field):
    """Sentences of other words and numbers than those learned from."""
    rows = personal_data.labelled_table(spark, 600, seed=99).collect()
    found = personal_data.field_spans(field, [r.text for r in rows])
    right = marked = guessed = 0
    for row, spans in zip(rows, found, strict=True):
        gold = {tuple(s) for s in row.spans}
        right += len(gold & set(spans))
        marked += len(gold)
        guessed += len(spans)
    assert right / guessed > 0.95 and right / marked > 0.9


def test_same_field_again(spark, field):
    again = personal_data.train_field(personal_data.labelled_table(spark).repartition(5))
    assert (again.weights == field.weights).all() and (again.steps == field.steps).all()


TEXTS = [
    (1, "Call +1 (017) 555-7713 or (030) 555-7713 today."),
    (2, "é a.b@c.de\nfrom 10.0.0.256 and 10.0.0.25, 4111111111111111"),
    (3, None), (4, ""), (None, "x@y.zz"), (None, None), (2, "é a.b@c.de"), (2, "é a.b@c.de"),
    (5, "Nothing in here, at all. Version 2.0 of 2024-05-06"),
    (6, "w " * 150_000 + "x@y.zz"),
    (7, "visa 4111.1111.1111.1111, more"),
]


def test_query(spark, docs, tmp_path):
    docs(TEXTS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op12_personal_data(spark, str(tmp_path)).collect()
    assert rows[0].__fields__ == [
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added",
    ]
    expected = []
    for key, text in TEXTS:
        base = plain_spans(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        counts = [sum(s[0] == k for s in base) for k in KINDS]
        expected.append((key, *counts, hashlib.sha256(joined.encode()).hexdigest()))
        for r in rows:
            if (r.doc_id, r.base_sha256) == (key, expected[-1][-1]):
                assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
                assert r.n_added == len(list(filter(None, r.spans.split(",")))) - len(base)
    assert sorted(map(str, expected)) == sorted(str(tuple(r)[:6]) for r in rows)
    added = {r.doc_id: r.spans for r in rows if r.n_added}
    assert added == {1: "phone:5:22,phone:26:40", 7: "card:5:24"}


def test_masked(spark, docs, field):
    found = personal_data.personal_data(docs(TEXTS[:3]), field)
    whole = found.join(docs(TEXTS[:3]), "doc_id")
    texts = whole.select("doc_id", personal_data.masked(F.col("text"), F.col("spans")).alias("t"))
    assert {r.doc_id: r.t for r in texts.collect()} == {
        1: "Call <phone> or <phone> today.",
        2: "é <email>\nfrom 10.0.0.256 and <ip>, <card>",
        3: None,
    }


def test_pieces_and_no_rows(monkeypatch, docs, field):
    text = "\n".join(["tel. 030-555-1234, now", "plain words here"] * 20)
    whole = personal_data.field_spans(field, [text, "", text])
    assert len(whole[0]) == 20 and whole[2] == whole[0]
    monkeypatch.setattr(personal_data, "PIECE", 50)
    monkeypatch.setattr(personal_data, "GROUP", 120)
    assert personal_data.field_spans(field, [text, "", text]) == whole
    assert personal_data.personal_data(docs(TEXTS).limit(0), field).count() == 0


def test_empty_labelled_table(spark, docs):
    field = personal_data.train_field(personal_data.labelled_table(spark).limit(0))
    (row,) = personal_data.personal_data(docs(TEXTS[:1]), field).collect()
    assert [tuple(s) for s in row.spans] == [("phone", 5, 22)]
