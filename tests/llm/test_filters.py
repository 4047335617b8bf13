"""License scan, decontamination and quality rules next to brute force."""

import collections
import random
import re
import textwrap

from linkweave.llm import decontaminate, license_scan, quality_rules

WORD = r"[^\x20\x09-\x0D]+"


def prose(seed, n):
    chance = random.Random(seed)
    return " ".join("".join(chance.choices("abcdefgh", k=chance.randint(1, 7))) for _ in range(n))


def distance_inside(pattern, text):
    column = list(range(len(pattern) + 1))
    best = len(pattern)
    for letter in text:
        next_column = [0]
        for k, own in enumerate(pattern, 1):
            next_column.append(
                min(column[k] + 1, next_column[-1] + 1, column[k - 1] + (own != letter))
            )
        column = next_column
        best = min(best, column[-1])
    return best


def edited(text, edits, chance):
    letters = list(text)
    for _ in range(edits):
        at = chance.randrange(len(letters))
        kind = chance.randrange(3)
        if kind == 0:
            letters[at] = chance.choice("xyz")
        elif kind == 1:
            del letters[at]
        else:
            letters.insert(at, chance.choice("xyz"))
    return "".join(letters)


def test_bit_parallel_distance():
    chance = random.Random(2)
    for _ in range(300):
        p = "".join(chance.choices("abc", k=chance.randint(1, 70)))
        t = "".join(chance.choices("abc", k=chance.randint(0, 90)))
        best, _ = decontaminate.best_match(decontaminate.letter_masks(p), len(p), t)
        assert best == distance_inside(p, t)


def test_every_item_within_the_budget_is_found():
    chance = random.Random(3)
    items = [(n, prose(n, 30)) for n in range(6)]
    matcher = decontaminate.Matcher(items, 0.1)
    for number, item in items * 6:
        for edits in (0, 5, len(item) // 10, len(item) // 5):
            text = decontaminate.normalised(f"{prose(99, 20)} {edited(item, edits, chance)} {prose(98, 9)}")
            found = {m[0] for m in matcher.find(text)}
            assert (number in found) == (distance_inside(item, text) <= len(item) // 10)


def test_contamination_and_edge_cases(spark, docs):
    item = prose(1, 25)
    benchmark = spark.createDataFrame(
        [(7, item), (8, None), (9, " "), (10, prose(2, 25))], "item_id bigint, text string"
    )
    table = docs(
        [(1, f"{prose(5, 9)}\n{item.upper()}  {prose(6, 9)}"), (2, None), (3, ""), (4, prose(7, 4000)),
         (5, item), (5, item), (None, item)]
    )
    for block in (10**6, 10):
        found = decontaminate.contamination(table, benchmark, block_chars=block).collect()
        assert sorted((r.doc_id or 0, r.item_id, r.distance) for r in found) == [
            (0, 7, 0), (1, 7, 0), (5, 7, 0), (5, 7, 0),
        ]
        clean = decontaminate.decontaminate(table, benchmark, block_chars=block)
        assert clean.columns == table.columns
        assert sorted(r.doc_id for r in clean.collect()) == [2, 3, 4]
    assert decontaminate.contamination(table, benchmark.limit(0)).count() == 0
    assert decontaminate.decontaminate(table.limit(0), benchmark).count() == 0


def test_license_scan(docs):
    notices = license_scan.NOTICES
    rows = [(n, f"{prose(n, n * 7 % 40)}\n{text}\n{prose(n + 50, 30)}") for n, (_, text) in enumerate(notices)]
    rows += [(100, notices[0][1].upper()), (101, None), (102, ""), (103, prose(3, 9000)), (None, notices[2][1])]
    long = notices[4][1].split()
    long[3] = "changed"
    rows.append((104, " ".join(long)))
    found = license_scan.scan_licenses(docs(rows)).collect()
    got = collections.defaultdict(set)
    for r in found:
        got[r.doc_id].add(r.template)
        assert r.containment >= 0.8
    for n in range(len(notices)):
        assert n in got[n]
    assert got[100] == {0} and got[None] >= {2} and 4 in got[104]
    assert not got.keys() & {101, 102, 103}
    first = next(r for r in found if r.doc_id == 1 and r.template == 1)
    assert first.first_word == 7
    assert license_scan.scan_licenses(docs(rows).limit(0)).count() == 0
    assert license_scan.scan_licenses(docs(rows), ()).count() == 0


def test_license_notices_in_comments(docs):
    """Every notice wrapped as in source code, after a line of code."""
    rows, wanted = [], {}
    for n, (_, text) in enumerate(license_scan.NOTICES):
        for k, mark in enumerate(("*", "#", "//")):
            lines = textwrap.wrap(text, 60, break_on_hyphens=False)
            block = "\n".join(f" {mark} {line}" for line in lines)
            rows.append((10 * n + k, f"int x = {n};\n {mark}\n{block}\n {mark}\n{prose(n, 30)}"))
            wanted[10 * n + k] = (n, 6, len(text.split()) + len(lines) - 1)
    found = collections.defaultdict(set)
    for r in license_scan.scan_licenses(docs(rows)).collect():
        if r.containment == 1:
            found[r.doc_id].add((r.template, r.first_word, r.n_words))
    assert all(place in found[doc_id] for doc_id, place in wanted.items())


def test_license_notice_with_words_put_in(docs):
    words = license_scan.NOTICES[4][1].split()
    for at in (24, 14):
        words[at:at] = ["dnl"]
    (row,) = license_scan.scan_licenses(docs([(1, f"a b {' '.join(words)} c d")])).collect()
    assert (row.template, row.first_word, row.n_words) == (4, 2, len(words))


def test_notices_in_direct_succession(docs):
    notices = license_scan.NOTICES
    texts = [" ".join([notices[n][1]] * times) for n in (2, 4) for times in (2, 3)]
    found = license_scan.scan_licenses(docs(list(enumerate(texts)))).collect()
    sizes = [len(notices[n][1].split()) for n in (2, 2, 4, 4)]
    for doc_id, (number, times) in enumerate([(2, 2), (2, 3), (4, 2), (4, 3)]):
        places = sorted(r.first_word for r in found if (r.doc_id, r.template) == (doc_id, number))
        assert places == [k * sizes[doc_id] for k in range(times)]


def test_similar_licenses_are_told_apart(docs):
    gnu = (
        "{} is free software: you can redistribute it and/or modify it under the terms of the GNU {} "
        "as published by the Free Software Foundation, either version {} of the License, or (at your "
        "option) any later version."
    )
    notices = license_scan.NOTICES
    texts = {
        "GPL-2.0-or-later": gnu.format("This program", "General Public License", "2"),
        "GPL-3.0-or-later": gnu.format("This program", "General Public License", "3"),
        "LGPL-3.0-or-later": gnu.format("This program", "Lesser General Public License", "3"),
        "LGPL-2.1-or-later": gnu.format("This library", "Lesser General Public License", "2.1"),
        "AGPL-3.0-or-later": gnu.format("This program", "Affero General Public License", "3"),
        "BSD-2-Clause": next(t for n, t in notices if n == "BSD-2-Clause"),
        "BSD-3-Clause": next(t for n, t in notices if n == "BSD-3-Clause").replace("copyright holder", "Foo", 1),
    }
    rows = list(enumerate(texts.values())) + [(100 + n, t) for n, (_, t) in enumerate(notices)]
    wanted = dict(enumerate(texts)) | {100 + n: name for n, (name, _) in enumerate(notices)}
    best = collections.defaultdict(set)
    for r in license_scan.scan_licenses(docs(rows)).collect():
        if r.best:
            best[r.doc_id].add(r.license)
    assert best == {k: {name} for k, name in wanted.items()}


def base_counts(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = collections.Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for k in range(len(words) - 2):
        if windows[tuple(words[k : k + 3])] > 1:
            covered |= {k, k + 1, k + 2}
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered),
    )


def common(seed, n):
    """Prose of a few hundred words, so that a small sample knows their ends."""
    return " ".join(random.Random(seed).choices(prose(0, 250).split(), k=n))


def test_quality_rules(spark, docs):
    good = [(n, common(n, 200)) for n in range(40)]
    junk = [(n, " ".join(w.upper() + "!!" for w in common(n, 200).split())) for n in range(40, 60)]
    odd = [
        (60, None), (61, ""), (62, "a b c a b c"), (63, "w " * 400), (64, "é\x0b漢字\x0cü\r\n\n x \nx\n x "),
        (65, common(1, 9_000)), (None, common(65, 200)), (66, "a b c " * 80), (1, good[1][1]),
    ]
    table = docs([*good, *junk, *odd])
    trusted = spark.createDataFrame([(n,) for n in range(0, 40, 2)] * 2, "doc_id bigint")
    judged = quality_rules.quality_rules(table, trusted, prior=1_000).collect()
    assert len(judged) == 69
    for r in judged:
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert counts == base_counts(r.text)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert r.base_failed == failed
        if r.doc_id is None or r.doc_id < 40 or r.doc_id == 65:
            assert r.kept
        else:
            assert not r.kept
    kept = quality_rules.keep_good(table, trusted, prior=1_000)
    assert kept.columns == table.columns and kept.count() == 43
    assert quality_rules.quality_rules(table.limit(0), trusted).count() == 0
    without = quality_rules.quality_rules(table, trusted.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in without)
