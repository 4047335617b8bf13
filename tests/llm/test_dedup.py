"""Near duplicates and repeated strings next to brute force."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from linkweave.llm import near_dedup, suffix_dedup
from linkweave.llm.components import connected_components
from linkweave.llm.text import raw_words, shingles


def words(seed, n):
    chance = random.Random(seed)
    return ["".join(chance.choices("abcdefgh", k=4)) for _ in range(n)]


def cells(text):
    hashes = near_dedup.LowerWordHashes()
    own = shingles(hashes.of(raw_words(text)), 5)
    return np.sort(near_dedup.weighted_cells(own)) if len(own) else own


def brute_classes(rows):
    """Least doc_id of the component of each row with words."""
    table = [(d, cells(t)) for d, t in rows]
    least = {k: d for k, (d, _) in enumerate(table)}
    for _ in table:
        for (x, (_, p)), (y, (_, q)) in itertools.combinations(enumerate(table), 2):
            if len(p) and len(q) and near_dedup.weighted_jaccard(p, q) >= 0.8:
                least[x] = least[y] = min(least[x], least[y])
        if len(table) > 40:
            break
    return least


def test_signatures_agree_with_the_similarity():
    base = words(1, 300)
    other = base[:150] + words(2, 20) + base[150:]
    x, y = cells(" ".join(base)), cells(" ".join(other))
    wanted = near_dedup.weighted_jaccard(x, y)
    p, q = (near_dedup.dart_signature(c, 4096) for c in (x, y))
    assert abs((p == q).mean() - wanted) < 0.03
    # A short text takes several strips of darts.
    assert near_dedup.dart_signature(cells("one"), 96).all()


def test_weights_count_copies():
    once, thrice = cells("a b c d e"), cells(" ".join(["a b c d e"] * 3))
    assert len(once) == 1 and len(thrice) == 11
    assert near_dedup.weighted_jaccard(once, thrice) == 1 / 11


def near_copy(base, seed, edits):
    chance, copy = random.Random(seed), list(base)
    for _ in range(edits):
        copy[chance.randrange(len(copy))] = f"new{chance.random()}"
    return " ".join(copy)


def test_near_duplicates(docs):
    base = words(3, 200)
    rows = [(100 + n, near_copy(base, n, n % 9)) for n in range(30)]
    rows += [(n, " ".join(words(n, 60))) for n in range(10, 16)]
    rows += [(50, rows[-1][1]), (51, rows[-1][1].upper()), (52, "one two"), (53, "One  two")]
    odd = [(1, None), (2, ""), (3, " \n"), (None, "only here"), (None, "only here"), (None, rows[-5][1])]
    found = near_dedup.near_duplicates(docs(rows + odd)).collect()
    assert len(found) == len(rows) + len(odd)
    got = {r.doc_id: r.class_id for r in found if r.doc_id is not None}
    wanted = brute_classes(rows)
    for k, (doc_id, _) in enumerate(rows):
        assert got[doc_id] == wanted[k], doc_id
    assert [got[n] for n in (1, 2, 3)] == [1, 2, 3]
    nameless = sorted(r.class_id for r in found if r.doc_id is None)
    assert nameless[0] == nameless[1] < 0 and nameless[2] == 15
    kept = near_dedup.deduplicate(docs(rows + odd + [(1, None), (10, rows[30][1])]))
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted(set(wanted.values()) | {1, 2, 3})
    assert near_dedup.near_duplicates(docs(rows).limit(0)).count() == 0


def test_repeated_and_missing_ids(docs):
    base = words(4, 200)
    rows = [(7, " ".join(words(n, 60))) for n in range(20, 40)]
    rows += [(None, near_copy(base, n, 1)) for n in range(6)] + [(None, " ".join(base))] * 3
    rows += [(8, " ".join(words(50, 60))), (None, " ".join(words(50, 60))), (8, " ".join(words(50, 60)))]
    rows += [(None, ""), (None, None), (7, ""), (7, None), (7, None)]
    table = docs(rows)
    found = near_dedup.near_duplicates(table).collect()
    with_words = [r.class_id for r in found if r.n_shingles]
    assert len(found) == len(rows) and len(set(with_words)) == 20 + 1 + 1
    assert {r.class_id for r in found if r.n_shingles and r.doc_id == 7} >= {7}
    kept = near_dedup.deduplicate(table)
    assert kept.columns == table.columns
    got = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    nameless = [key for key in got if key[0] is None and key[1]]
    assert len(nameless) == 1 and set(got.values()) == {1}
    assert got.keys() - set(nameless) == {k for k in rows if k[0] is not None or not k[1]}


def test_strangers_in_a_large_bucket_are_linked(docs, monkeypatch):
    """Copies too far from the first one are linked among themselves, tile by tile."""
    base = words(5, 150)
    far = near_copy(base, 77, 6).split()
    rows = [(n, near_copy(base, n, 1)) for n in range(30)]
    rows += [(500 + n, near_copy(far, 900 + n, 1)) for n in range(30)]
    monkeypatch.setattr(near_dedup, "CHUNK", 7)
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs(rows)).collect()}
    wanted = brute_classes(rows)
    groups = collections.defaultdict(set)
    for k, (doc_id, _) in enumerate(rows):
        groups[got[doc_id]].add(wanted[k])
    assert len({got[n] for n in range(30)}) == 1
    assert len({got[500 + n] for n in range(30)}) == 1


def test_components(spark):
    chance = random.Random(4)
    links = [(chance.randrange(200), chance.randrange(200)) for _ in range(120)]
    links += [(1000 + n, 1001 + n) for n in range(40)] + [(5000, 5001 + n) for n in range(50)]
    least = {n: n for pair in links for n in pair}
    for _ in least:
        for x, y in links:
            least[x] = least[y] = min(least[x], least[y])
    table = spark.createDataFrame(links, "x bigint, y bigint")
    linked = {n for x, y in links if x != y for n in (x, y)}
    assert {r.node: r["class"] for r in connected_components(table).collect()} == {
        n: least[n] for n in linked
    }


def brute_repeats(rows, length):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = collections.Counter(t[s : s + length] for _, t in texts for s in range(len(t) - length + 1))
    out = []
    for doc_id, text in texts:
        covered = bytearray(len(text))
        for s in range(len(text) - length + 1):
            if seen[text[s : s + length]] > 1:
                covered[s : s + length] = b"\1" * length
        kept = bytes(b for b, c in zip(text, covered, strict=True) if not c)
        runs = len(re.findall(b"\1+", bytes(covered)))
        out.append((doc_id, len(text), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return out


def repetitive(seed):
    chance = random.Random(seed)
    pieces = ["".join(chance.choices("ab", k=chance.randint(0, 120))) for _ in range(20)]
    rows = []
    for n in range(120):
        text = "".join(chance.choice(pieces) for _ in range(chance.randint(0, 4)))
        if n % 5 == 0:
            text = "a" * chance.randint(0, 200)
        if n % 7 == 0 and text:
            at = chance.randrange(len(text))
            text = f"{text[:at]}ö{text[at + 1 :]}"
        rows.append((n, text))
    return [*rows, (5, None), (None, rows[3][1]), (None, ""), (7, "ab" * 3000)]


@pytest.mark.parametrize("task_phrases", [4096, 2])
def test_repeated_strings(docs, task_phrases):
    rows = repetitive(task_phrases)
    found = suffix_dedup.remove_repeats(docs(rows), 20, 8, task_phrases).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, found), key=key) == sorted(brute_repeats(rows, 20), key=key)
    assert suffix_dedup.remove_repeats(docs(rows).limit(0), 20, 8).count() == 0


def test_query_removes_long_passages_and_leaves_the_size_of_the_input(spark, docs, tmp_path):
    """Passages of over 50 words in two texts each: from 400 bytes on they go, n_bytes stays."""
    long = [" ".join(words(seed, 90)) for seed in range(100, 110)]
    short = [" ".join(words(seed, 60)) for seed in range(200, 210)]
    assert {len(p) for p in long} == {449} and {len(p) for p in short} == {299}
    rows = []
    for n in range(60):
        before, after = (" ".join(words(1000 * k + n, 40 + n)) for k in (3, 4))
        # Texts 0 to 19 hold the long passages, 20 to 39 the short ones, the rest none.
        passage = [*long, *long, *short, *short, *[""] * 20][n]
        rows.append((n, f"{before} {passage} {after}"))
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    from linkweave.llm.queries import LLM_QUERIES

    found = sorted(LLM_QUERIES["op7_suffix_dedup"](spark, str(tmp_path)).collect())
    assert list(map(tuple, found)) == brute_repeats(rows, 400)
    assert [r.n_bytes for r in found] == [len(text) for _, text in rows]
    assert all(449 <= r.n_removed < 470 and r.n_spans == 1 for r in found[:20])
    assert not any(r.n_removed or r.n_spans for r in found[20:])


def test_parts_of_long_texts_cover_every_string():
    text = bytes(range(256)) * 3
    starts = [base + s for base, part in suffix_dedup._parts(text, 20, 37) for s in range(len(part) - 19)]
    assert starts == list(range(len(text) - 19))


def test_phrases_hold_each_string_once():
    data = np.random.default_rng(1).integers(97, 99, 4000).astype(np.uint8)
    ends = np.array([10, 700, 701, 4000])
    phrases = suffix_dedup.parse(data, ends, suffix_dedup.Hashes.new(), 40, 16)
    starts = [s for a, b in zip(phrases.first, phrases.last, strict=True) for s in range(a, b + 1)]
    whole = [s for s in range(4000) for e in [ends[np.searchsorted(ends, s, side="right")]] if s + 40 <= e]
    assert starts == whole


@pytest.mark.parametrize("length", [3, 8, 11, 20, 64, 400])
def test_suffix_order(length):
    chance = np.random.default_rng(length)
    data = chance.integers(97, 97 + chance.integers(1, 4), 1500).astype(np.uint8)
    data[700:1300] = data[100:700]
    starts = np.flatnonzero(chance.random(1500 - length + 1) < 0.7)
    order, same = suffix_dedup.suffix_order(data, starts, length)
    text = data.tobytes()
    suffixes = [text[k : k + length] for k in starts[order].tolist()]
    assert suffixes == sorted(suffixes)
    assert same.tolist() == [a == b for a, b in itertools.pairwise(suffixes)]


def test_joined_spans():
    import pyarrow as pa

    chance = random.Random(9)
    texts = [
        sorted({(a, a + chance.randint(0, 6)) for a in chance.sample(range(60), chance.randint(1, 9))})
        for _ in range(40)
    ]
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    lists = [[{"first": a, "last": b} for a, b in spans] for spans in texts]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([b"%d" % n for n in range(40)]), pa.array(lists, kind)], names=["text_key", "spans"]
    )
    (joined,) = suffix_dedup._joined_spans([batch.slice(3)])
    for row, spans in zip(joined.to_pylist(), texts[3:], strict=True):
        starts = {k for a, b in spans for k in range(a, b + 1)}
        found = [(s["first"], s["last"]) for s in row["spans"]]
        assert {k for a, b in found for k in range(a, b + 1)} == starts
        assert all(b + 1 < c for (_, b), (c, _) in itertools.pairwise(found))
