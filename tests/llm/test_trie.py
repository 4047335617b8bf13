"""The conversation trie next to brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from linkweave.llm import prefix_trie, queries
from linkweave.llm.prefix_trie import SlotTable

COLUMNS = (
    "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"
).split()


def turn_digest(turn):
    _, role, text = turn
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute_trie(rows, group=None, openings=None):
    talks = collections.defaultdict(list)
    for c, *turn in rows:
        if c is not None:
            talks[c].append(tuple(turn))
    for turns in talks.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, turn_digest(t)))
    talks = {c: [(role or "", text or "") for _, role, text in t] for c, t in talks.items()}
    if group:
        full = {}
        for c, turns in talks.items():
            h = zlib.crc32(str(c).encode()) % openings
            full[c] = talks.get(c - c % group, [])[:h] + turns[h:]
        talks = full
    nodes = collections.defaultdict(list)
    for c, turns in talks.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    children = collections.defaultdict(list)
    for node in nodes:
        if node:
            children[node[:-1]].append(node)
    sums = {}
    for node in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[node]) - 1) * (len(node[-1][1]) if node else 0)
        below = [sums[k] for k in children[node]]
        sums[node] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
    found = []
    for node, ids in nodes.items():
        ends = sorted(c for c in ids if len(talks[c]) == len(node))
        found.append((
            min(ids), len(node), min(nodes[node[:-1]]) if node else None, len(ids),
            len(children[node]), *sums[node],
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(map(str, found))


def make(spark, rows):
    full = [(*r, "x", 7) for r in rows]
    schema = "conv_id bigint, turn int, role string, text string, size string, digest int"
    return spark.createDataFrame(full, schema)


def found_rows(trie):
    assert trie.columns == COLUMNS
    assert [t for _, t in trie.dtypes] == ["bigint"] * 7 + ["string"]
    return sorted(str(tuple(r)) for r in trie.collect())


def conversations(seed):
    chance = random.Random(seed)
    rows = []
    for c in [*range(0, 45), 100, 105, 199, 201, 203, 1000]:
        for turn in range(chance.randint(1, 6)):
            text = chance.choice(["a", "é ß", "", None, "x" * 40])
            rows.append((c, turn, chance.choice(["user", None]), text))
    # Turns without a number, of equal number, repeated rows, and rows of no conversation.
    rows += [(7, None, "system", "s"), (7, None, None, None), (7, 1, "user", "again")] * 2
    rows += [(None, 1, "user", "lost"), (None, None, None, None)]
    # A third of all rows in one conversation, and many copies of another.
    rows += [(1100, t, "user", f"t{t % 3}") for t in range(70)]
    rows += [(c, t, "user", f"copy {t}") for c in range(2000, 2030) for t in range(3)]
    return rows


@pytest.mark.parametrize(
    ("subtree", "block", "hot"), [(2048, 1024, 100_000), (6, 4, 20), (1, 8, 100_000)]
)
def test_trie(spark, monkeypatch, subtree, block, hot):
    """Also with small limits, so that the crown, blocks and hot keys are in use."""
    monkeypatch.setattr(prefix_trie, "SUBTREE_ROWS", subtree)
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "HOT_ROWS", hot)
    rows = conversations(subtree)
    trie = prefix_trie.conversation_trie(make(spark, rows).repartition(3))
    assert found_rows(trie) == brute_trie(rows)


@pytest.mark.parametrize("subtree", [2048, 5])
def test_query(spark, monkeypatch, tmp_path, subtree):
    monkeypatch.setattr(prefix_trie, "SUBTREE_ROWS", subtree)
    rows = conversations(3)
    make(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op13_prefix_trie(spark, str(tmp_path))
    assert found_rows(found) == brute_trie(rows, 100, 6)


def test_turnless_conversations(spark, tmp_path):
    """A conversation whose group has no first one, and whose own turns are all replaced."""
    rows = [(c, 0, "user", "hi") for c in range(301, 330)]
    make(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op13_prefix_trie(spark, str(tmp_path))
    assert found_rows(found) == brute_trie(rows, 100, 6)


def test_empty_table(spark):
    assert prefix_trie.conversation_trie(make(spark, [(1, 1, "", "")]).limit(0)).count() == 0


def test_slot_table():
    chance = np.random.default_rng(1)
    keys = np.unique(chance.integers(0, 50, (3000, 4)), axis=0)
    table = SlotTable(keys)
    slots = table.slots(keys)
    assert sorted(slots) == list(range(len(keys)))
    assert (table.keys[slots] == keys).all()
    known = {tuple(k) for k in keys.tolist()}
    others = chance.integers(0, 50, (3000, 4))
    strange = np.array([k for k in others if tuple(k.tolist()) not in known])
    assert (table.slots(strange) == -1).all()
    assert len(SlotTable(keys[:0]).keys) == 0
    assert SlotTable(keys[:1]).slots(keys[:2]).tolist() == [0, -1]
