"""Every stage of the pipeline, on odd rows, next to the same stage in plain Python."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from linkweave.llm import mixing, quality_rules, sharding

WORD = r"[^\x20\x09-\x0D]+"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars int, size int, words string, class string, shard string, kept string, node bigint"


def prose(seed, n):
    """Words of a small vocabulary, so that good documents know the ends of each other's."""
    chance = random.Random(seed)
    known = random.Random(0)
    words = ["".join(known.choices("abcdefgh", k=known.randint(2, 7))) for _ in range(200)]
    return " ".join(chance.choices(words, k=n))


def changed(text, share, seed):
    chance = random.Random(seed)
    words = text.split()
    for at in chance.sample(range(len(words)), int(share * len(words))):
        words[at] = "changed"
    return " ".join(words)


ITEMS = [(1, prose(901, 25)), (2, prose(902, 30)), (3, None), (4, " "), (1, prose(903, 20))]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    texts = [(n, prose(n, 60 + n), "abc"[n % 3] if n % 4 else "a") for n in range(48)]
    texts += [(100 + n, prose(200 + n, 90).upper().replace(" ", "!! "), "b") for n in range(8)]
    texts += [
        (200, None, "a"), (201, "", "a"), (202, "\x0b \r\n", None), (203, "too short", "b"),
        (204, "x y z " * 60, "c"), (205, prose(7, 9_000), "a"), (None, prose(300, 70), "b"),
        (None, prose(301, 80), None), (None, texts[3][1], "c"), (5, prose(302, 75), "b"),
        # Repeated rows, exact copies, copies with other blanks and case, and near copies.
        texts[6], texts[6], (210, texts[8][1], "c"), (211, texts[9][1].upper().replace(" ", "\n"), "b"),
        (212, changed(texts[20][1], 0.01, 1), "b"), (213, changed(texts[21][1], 0.2, 1), "a"),
        (214, f"{prose(303, 40)} {ITEMS[0][1].upper()} {prose(304, 30)}", "a"),
        (215, f"{prose(305, 40)} {ITEMS[1][1][:60]}q{ITEMS[1][1][61:]} {prose(306, 30)}", "a"),
        (216, f"{prose(307, 60)}\n{ITEMS[4][1]}", None),
    ]
    rows = [
        (d, t, "en", s, len(t or ""), n, "x", None, "y", "z", n) for n, (d, t, s) in enumerate(texts)
    ]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/documents.parquet")
    labels = [(n, int(n < 100), 0) for n in [*range(0, 48, 2), 100, 205, *range(0, 48, 2)]]
    labels += [(None, 1, 0), (1, None, 0)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def signed(code):
    return code - (1 << 64) * (code >> 63)


def grams(text):
    words = re.findall(WORD, text or "")
    for word, after in zip(words, [*words[1:], ""], strict=False):
        end = xxhash.xxh64_intdigest(word[-3:].encode(), seed=42)
        yield signed(end) % quality_rules.BUCKETS
        yield signed(xxhash.xxh64_intdigest(after[:2].encode(), seed=end)) % quality_rules.BUCKETS


def good(rows, trusted):
    every = collections.Counter(g for r in rows for g in grams(r.text))
    own = collections.Counter(g for r in rows if r.doc_id in trusted for g in grams(r.text))
    n_all, n_own, prior = sum(every.values()), sum(own.values()), quality_rules.PRIOR
    table = {g: math.log((own[g] + prior * n / n_all) / (n_own + prior) / (n / n_all)) for g, n in every.items()}
    for r in rows:
        words = re.findall(WORD, r.text or "")
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        times = collections.Counter(windows)
        repeated = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(3)}
        if len(words) < 50 or 100 * len(repeated) > 50 * len(words):
            continue
        logs = [table[g] for g in grams(r.text)]
        if sum(logs) / len(logs) >= quality_rules.THRESHOLD:
            yield r


def distinct(rows):
    """One row of each class of texts that share four fifths of their shingles."""
    bags = []
    for r in rows:
        words = r.text.lower().split()
        size = min(5, len(words))
        bags.append(collections.Counter(tuple(words[k : k + size]) for k in range(len(words) - size + 1)))
    least = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 10 * (bags[i] & bags[j]).total() >= 8 * (bags[i] | bags[j]).total():
                old, new = least[i], least[j]
                least = [new if x == old else x for x in least]
    classes = collections.defaultdict(list)
    for r, number in zip(rows, least, strict=True):
        classes[number].append(r)
    return [min(c, key=lambda r: (r.doc_id is None, r.doc_id or 0)) for c in classes.values()]


def plain(text):
    return " ".join((text or "").lower().split())


def distance_inside(pattern, text):
    """Least edit distance of a pattern to any substring, a row of the table at a time."""
    above = np.zeros(len(text) + 1, int)
    letters = np.array(list(text))
    steps = np.arange(len(text) + 1)
    for k, own in enumerate(pattern, 1):
        row = np.empty_like(above)
        row[0] = k
        row[1:] = np.minimum(above[1:] + 1, above[:-1] + (letters != own))
        above = np.minimum.accumulate(row - steps) + steps
    return int(above.min())


def clean(rows):
    items = [plain(t) for _, t in ITEMS if plain(t)]
    return [r for r in rows if all(distance_inside(i, plain(r.text)) > len(i) // 10 for i in items)]


def mixed(rows, taken):
    """Rows as often as the words taken of their source, doc_id and size ask for."""
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r.source, r.doc_id, len(r.text.split())].append(r)
    for key, members in groups.items():
        mean = taken[key] / (key[2] * len(members))
        for r in members:
            edge = 0.5 if len(members) == 1 else signed(xxhash.xxh64_intdigest(r.text.encode(), seed=42)) % (1 << 20) / (1 << 20)
            yield from [r] * math.floor(mean + edge)


def placed(rows):
    crc = lambda r: zlib.crc32(r.text.encode())
    order = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, crc(r), len(r.text.encode())))
    places = sharding.Feistel(len(order)).place(np.arange(len(order)))
    return [(r.doc_id, r.text, int(p) % 16, int(p) // 16) for r, p in zip(order, places, strict=True)]


def keys(rows):
    return collections.Counter((r.doc_id, r.text, r.source) for r in rows)


def test_stages_next_to_brute_force(spark, folder):
    source = spark.read.parquet(f"{folder}/documents.parquet")
    docs, rows = source, source.collect()
    trusted = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if r.quality == 1} - {None}
    sizes = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, folder)
        found = after.collect()
        if name == "sharding":
            got = collections.Counter((r.doc_id, r.text, r.shard, r.slot) for r in found)
            assert got == collections.Counter(placed(rows))
            assert set(after.columns) == set(source.columns) | {"slot"}
            break
        assert after.columns == source.columns and after.schema == source.schema
        if name == "quality_rules":
            wanted = list(good(rows, trusted))
        elif name == "near_duplicates":
            wanted = distinct(rows)
        elif name == "decontamination":
            wanted = clean(rows)
        else:
            # The words taken are compared with SQL elsewhere; here it is their rows.
            words, (taken, sources) = collections.Counter(), mixing._mixed(docs)
            for r in taken.join(sources.select("source_no", "source"), "source_no").collect():
                words[r.source, r.doc_id, r["size"]] += r.taken
            wanted = list(mixed(rows, words))
        assert keys(found) == keys(wanted), name
        sizes[name] = len(found)
        docs, rows = spark.createDataFrame(found, after.schema), found
    # Each stage had something to do, and clean documents were left alone.
    assert len(source.collect()) > sizes["quality_rules"] > sizes["near_duplicates"] > sizes["decontamination"] > 40
    assert sizes["mixing"] != sizes["decontamination"]
