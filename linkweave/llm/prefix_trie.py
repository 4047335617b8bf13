"""Prefix trie of conversations: a table of nodes with sums over their subtrees.

A node is the sequence of the first d turns. Its digest is a sum of hashes of (place,
turn), 144 bits in three parts, so that the digests of all prefixes of a conversation are
running sums, taken in blocks of its turns; no task needs a whole conversation.

Nodes are dealt to shards by subtree. In a shard the distinct digests get slots by a
minimal perfect hash, verified against the digest kept in the slot; counts are scattered
into flat arrays by slot and added up through the slots of the parents, deepest first.
Subtrees with more than SUBTREE_ROWS turns are not put into one shard. Their upper nodes,
the crown, get their sums by another way: every subtree below the crown and every crown
node adds to the crown nodes on the path of its smallest member, which is a running sum
along that conversation.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave.llm.numbering import row_numbers
from linkweave.llm.text import GOLDEN, mix
from linkweave.operators.skew import HOT_ROWS, lookup
from linkweave.session import settled

# Turns in a subtree that may stay together, counted once for each member.
SUBTREE_ROWS = 2_048

# Turns of the subtrees of one shard, about.
SHARD_ROWS = 100_000

# Turns of one conversation whose running sums are taken together.
BLOCK = 1_024

# A digest has three parts of 48 bits: sums over a block stay below 2**63.
DIGEST = ["k1", "k2", "k3"]
PARENT = ["p1", "p2", "p3"]
NODE = ["depth", *DIGEST]
_HEX = 12
_RANGE = 1 << (4 * _HEX)

# Ids of one piece of a member list: those of so long a stretch of numbers.
ID_BLOCK = 65_536


def _hot(table: DataFrame, keys: list[str], rows: str) -> DataFrame:
    """Keys with many rows and their buckets, as `lookup` takes them."""
    buckets = F.ceil(F.col(rows) / F.lit(HOT_ROWS)).cast("bigint")
    return table.where(F.col(rows) > HOT_ROWS).select(*keys, buckets.alias("__buckets"))


def ordered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, place, digest, size) with places from 1, and (conv_id, n_turns).

    Turns are ordered by `turn`, null first; equal ones by the hash of their role and text,
    null being empty. Repeated rows are turns of their own. Rows without a conv_id belong
    to no conversation and are left out. All turns are sorted together and numbered, so
    that a very long conversation spreads over many tasks.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.length(text).cast("bigint").alias("size"),
        F.monotonically_increasing_id().alias("__row"),
    )
    numbered = row_numbers(turns, ["conv_id", "turn", "digest", "__row"], "__at")
    starts = settled(
        numbered.groupBy("conv_id").agg(
            F.min("__at").alias("__start"), F.count(F.lit(1)).alias("n_turns")
        ),
        "conversations",
    )
    hot = _hot(starts, ["conv_id"], "n_turns")
    placed = lookup(numbered, starts, "conv_id", ["__at"], hot=hot)
    place = (F.col("__at") - F.col("__start") + 1).alias("place")
    return (
        placed.select("conv_id", place, "digest", "size", "n_turns"),
        starts.select("conv_id", "n_turns"),
    )


def share_openings(
    turns: DataFrame, members: DataFrame, group: int, openings: int
) -> tuple[DataFrame, DataFrame]:
    """Conversations that open as the first one of their group does.

    Conversation c takes the first h turns of conversation c - c % group, then its own
    turns after the first h; h is a hash of c below `openings`.
    """
    spread = F.crc32(F.col("conv_id").cast("string").cast("binary")) % openings
    firsts = members.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("__first"))
    plan = (
        members.withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
        .withColumn("opening", spread)
        .join(firsts, "base", "left")
        .withColumn("taken", F.least("opening", F.coalesce("__first", F.lit(0))))
        .withColumn(
            "rebuilt", F.col("taken") + F.greatest(F.col("n_turns") - F.col("opening"), F.lit(0))
        )
        .select("conv_id", "base", "opening", "taken", "rebuilt")
    )
    plan = settled(plan, "openings")
    own = lookup(
        turns, plan.drop("base"), "conv_id", ["place"], hot=_hot(members, ["conv_id"], "n_turns")
    ).where(F.col("place") > F.col("opening"))
    place = F.col("place") - F.col("opening") + F.col("taken")
    own = own.select("conv_id", place.alias("place"), "digest", "size", F.col("rebuilt").alias("n_turns"))
    # At most group x openings rows for each first conversation.
    given = turns.where(
        (F.col("place") < openings) & (F.col("conv_id") % group == 0)
    ).select(F.col("conv_id").alias("base"), "place", "digest", "size")
    taken = plan.join(given, "base").where(F.col("place") <= F.col("taken"))
    taken = taken.select("conv_id", "place", "digest", "size", F.col("rebuilt").alias("n_turns"))
    return own.unionByName(taken), plan.select("conv_id", F.col("rebuilt").alias("n_turns"))


def running_sums(
    rows: DataFrame, key: str, place: Column, values: list[str], several_blocks: bool
) -> DataFrame:
    """Replace `values` by their running sums along `place` within each key.

    Sums are taken within blocks of places; those of the earlier blocks, a row for each
    block, are added where some key has several.
    """
    rows = rows.withColumn("__place", place).withColumn(
        "__block", F.floor(F.col("__place") / F.lit(BLOCK))
    )
    within = (
        Window.partitionBy(key, "__block")
        .orderBy("__place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = rows.withColumns({v: F.sum(v).over(within) for v in values})
    if several_blocks:
        wide = "decimal(38,0)"
        totals = rows.groupBy(key, "__block").agg(
            *[F.sum(F.col(v).cast(wide)).alias(f"__{v}") for v in values]
        )
        earlier = (
            Window.partitionBy(key).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
        )
        starts = totals.select(
            key, "__block", *[F.sum(f"__{v}").over(earlier).alias(f"__{v}") for v in values]
        ).dropna()
        summed = summed.join(starts, [key, "__block"], "left").withColumns(
            {
                v: (F.col(v).cast(wide) + F.coalesce(F.col(f"__{v}"), F.lit(0).cast(wide)))
                for v in values
            }
        )
    return summed.drop("__place", "__block", *[f"__{v}" for v in values])


def _prefixes(turns: DataFrame, members: DataFrame) -> DataFrame:
    """A row for each member of each node: digests of the node and its parent, the size of
    its last turn, and the member's turns after it."""
    salted = F.sha2(F.concat_ws(":", F.col("place").cast("string"), "digest"), 256)
    parts = {
        k: F.conv(F.substring(salted, 1 + n * _HEX, _HEX), 16, 10).cast("bigint")
        for n, k in enumerate(DIGEST)
    }
    hashed = turns.select(
        "conv_id",
        F.col("place").alias("depth"),
        "size",
        (F.col("n_turns") - F.col("place")).alias("rest"),
        *[part.alias(k) for k, part in parts.items()],
        *[part.alias(f"__own_{k}") for k, part in parts.items()],
    )
    longest = members.agg(F.max("n_turns")).first()[0] or 0
    summed = running_sums(hashed, "conv_id", F.col("depth"), DIGEST, longest > BLOCK - 1)
    nodes = summed.select(
        "conv_id",
        F.col("depth").cast("bigint").alias("depth"),
        *[F.pmod(F.col(k), F.lit(_RANGE)).cast("bigint").alias(k) for k in DIGEST],
        *[
            F.pmod(F.col(k) - F.col(f"__own_{k}"), F.lit(_RANGE)).cast("bigint").alias(p)
            for k, p in zip(DIGEST, PARENT, strict=True)
        ],
        "size",
        F.col("rest").cast("bigint").alias("rest"),
    )
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    root = members.select(
        "conv_id",
        zero.alias("depth"),
        *[zero.alias(k) for k in DIGEST],
        *[none.alias(p) for p in PARENT],
        zero.alias("size"),
        F.col("n_turns").cast("bigint").alias("rest"),
    )
    return nodes.unionByName(root)


class SlotTable:
    """Slots 0 to n - 1 for n distinct keys, by a minimal perfect hash in levels.

    At each level the keys left over fall on half again as many places; those alone on
    theirs stay. A key's slot is the number of taken places before its own. Each slot
    keeps its key, so that a key that is not in the table is told from one that is.
    """

    def __init__(self, keys: np.ndarray):
        self._levels: list[tuple[np.ndarray, np.ndarray]] = []
        slots = np.empty(len(keys), np.int64)
        left, placed = np.arange(len(keys)), 0
        while len(left):
            size = len(left) + len(left) // 2 + 1
            at = self._place(keys[left], len(self._levels), size)
            taken = np.bincount(at, minlength=size) == 1
            slot = placed + np.cumsum(taken) - 1
            self._levels.append((taken, slot))
            alone = taken[at]
            slots[left[alone]] = slot[at[alone]]
            left, placed = left[~alone], placed + int(taken.sum())
        self.keys = np.empty_like(keys)
        self.keys[slots] = keys

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        total = np.full(len(keys), level + 1, np.uint64)
        for column in keys.T:
            total = mix(total + column.astype(np.uint64) + GOLDEN)
        return (total % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for one that has none."""
        found = np.full(len(keys), -1)
        left = np.arange(len(keys))
        for level, (taken, slot) in enumerate(self._levels):
            at = self._place(keys[left], level, len(taken))
            hit = taken[at]
            found[left[hit]] = slot[at[hit]]
            left = left[~hit]
        known = found >= 0
        known[known] = (self.keys[found[known]] == keys[known]).all(1)
        return np.where(known, found, -1)


def _distinct(keys: np.ndarray) -> np.ndarray:
    ordered = keys[np.lexsort(keys.T)]
    new = np.ones(len(ordered), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(1)
    return ordered[new]


def _member_digests(slots: np.ndarray, ids: np.ndarray, n: int) -> list[str]:
    """SHA-256 of the ascending ids of each slot."""
    digests = [hashlib.sha256(b"").hexdigest()] * n
    order = np.lexsort((ids, slots))
    slots, ids = slots[order], ids[order]
    firsts = np.flatnonzero(np.concatenate(([True], slots[1:] != slots[:-1]))) if len(slots) else []
    for first, last in zip(firsts, [*firsts[1:], len(slots)], strict=True):
        text = ",".join(map(str, ids[first:last].tolist()))
        digests[slots[first]] = hashlib.sha256(text.encode()).hexdigest()
    return digests


_SHARD_SCHEMA = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string, top boolean, "
    "p1 bigint, p2 bigint, p3 bigint"
)


def _shard_nodes(shard: pa.Table) -> pa.Table:
    """The nodes of the whole subtrees whose member rows these are."""
    column = {n: shard.column(n).to_numpy() for n in ("conv_id", "size", "rest", *NODE, *PARENT)}
    keys = np.stack([column[n] for n in NODE], 1)
    table = SlotTable(_distinct(keys))
    n = len(table.keys)
    slot = table.slots(keys)
    depth = table.keys[:, 0]
    size, parent_keys = np.empty(n, np.int64), np.empty((n, 4), np.int64)
    size[slot] = column["size"]
    parent_keys[:, 0] = depth - 1
    for k, name in enumerate(PARENT, 1):
        parent_keys[slot, k] = column[name]
    n_convs = np.bincount(slot, minlength=n)
    smallest = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(smallest, slot, column["conv_id"])
    parent = table.slots(parent_keys)
    inside = parent >= 0
    n_children = np.bincount(parent[inside], minlength=n)
    n_leaves = (n_children == 0).astype(np.int64)
    saved = (n_convs - 1) * size
    by_depth = np.argsort(-depth, kind="stable")
    by_depth = by_depth[inside[by_depth]]
    bounds = np.flatnonzero(np.diff(depth[by_depth])) + 1
    for nodes in np.split(by_depth, bounds):
        np.add.at(n_leaves, parent[nodes], n_leaves[nodes])
        np.add.at(saved, parent[nodes], saved[nodes])
    end = column["rest"] == 0
    digests = _member_digests(slot[end], column["conv_id"][end], n)
    return pa.table(
        {
            "conv_id": smallest,
            "depth": depth,
            "parent_conv_id": pa.array(smallest[np.maximum(parent, 0)], mask=~inside),
            "n_convs": n_convs,
            "n_children": n_children,
            "n_leaves": n_leaves,
            "saved_tokens": saved,
            "ends_sha256": digests,
            "top": ~inside,
            **{name: parent_keys[:, k] for k, name in enumerate(PARENT, 1)},
        }
    )


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's id lists, which come in order, a piece at a time."""
    current, state = None, None

    def done() -> pa.RecordBatch:
        values = [pa.array([v], pa.int64()) for v in current]
        return pa.RecordBatch.from_arrays(
            [*values, pa.array([state.hexdigest()])], names=[*NODE, "ends_sha256"]
        )

    for batch in batches:
        for row in batch.to_pylist():
            node = tuple(row[n] for n in NODE)
            if node != current:
                if current is not None:
                    yield done()
                current, state = node, hashlib.sha256()
            else:
                state.update(b",")
            state.update(row["ids"].encode())
    if current is not None:
        yield done()


def _crown_ends(crown_rows: DataFrame) -> DataFrame:
    """Digests of the members that end at a crown node.

    The members are joined in pieces of bounded length first; a node's pieces are then
    hashed one after the other, since a SHA-256 has no parallel form.
    """
    pieces = (
        crown_rows.where("rest = 0")
        .groupBy(*NODE, F.floor(F.col("conv_id") / F.lit(ID_BLOCK)).alias("__piece"))
        .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    )
    ordered = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "__piece")
    schema = ", ".join(f"{n} bigint" for n in NODE) + ", ends_sha256 string"
    return ordered.select(*NODE, "ids").mapInArrow(_hash_pieces, schema)


def _crown_sums(
    crown_rows: DataFrame, crown: DataFrame, tops: DataFrame, deepest: int
) -> DataFrame:
    """Leaves and saved tokens below each crown node.

    What a subtree or a crown node adds stands at its smallest member; the running sum
    from the deepest crown node of that conversation up takes it to all nodes above.
    """
    added = crown.select(
        "conv_id",
        "depth",
        (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
    ).unionByName(
        tops.select("conv_id", (F.col("depth") - 1).alias("depth"), "n_leaves", "saved_tokens")
    )
    sums = [F.sum(c).alias(c) for c in ("n_leaves", "saved_tokens")]
    added = added.groupBy("conv_id", "depth").agg(*sums)
    zero = F.lit(0).cast("bigint")
    rows = crown_rows.select("conv_id", *NODE).join(added, ["conv_id", "depth"], "left")
    rows = rows.withColumns({c: F.coalesce(F.col(c), zero) for c in ("n_leaves", "saved_tokens")})
    height = F.lit(deepest) - F.col("depth")
    values = ["n_leaves", "saved_tokens"]
    upward = running_sums(rows, "conv_id", height, values, deepest >= BLOCK)
    return upward.groupBy(*NODE).agg(*sums)


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """Nodes of the trie of all conversations, the root among them.

    `turns` is (conv_id, place, digest, size, n_turns), with places from 1 without gaps
    and equal digests for equal turns; `members` is (conv_id, n_turns) of every
    conversation, also those without turns. A row for each node: conv_id (smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.
    No members give no rows, not even the root.
    """
    rows = settled(_prefixes(turns, members), "prefixes")
    spark = rows.sparkSession
    nodes = rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("size").alias("size"),
        F.sum(F.col("rest") + 1).alias("__below"),
        *[F.max(p).alias(p) for p in PARENT],
    )
    crown = settled(nodes.where((F.col("__below") > SUBTREE_ROWS) | (F.col("depth") == 0)), "crown")
    hot = _hot(crown, NODE, "n_convs")
    marks = crown.select(*NODE, F.lit(True).alias("__crown"))
    marked = lookup(rows, marks, NODE, ["conv_id"], "left", hot)
    crown_rows = settled(marked.where("__crown").drop("__crown"), "crown-rows")
    # Below the crown a conversation has at most SUBTREE_ROWS turns, and so has a subtree.
    highest = F.min(F.struct(*NODE)).over(Window.partitionBy("conv_id"))
    below = marked.where("__crown IS NULL").withColumn("__top", F.xxhash64(highest)).drop("__crown")
    shards = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / SHARD_ROWS)
    )
    below = below.withColumn("__shard", F.pmod(F.col("__top"), F.lit(shards))).drop("__top")
    shard_nodes = settled(
        below.groupBy("__shard").applyInArrow(_shard_nodes, _SHARD_SCHEMA), "shard-nodes"
    )
    tops = shard_nodes.where("top")
    up = {"depth": F.col("depth") - 1, **{k: F.col(p) for k, p in zip(DIGEST, PARENT, strict=True)}}
    parents = [c.alias(n) for n, c in up.items()]
    children = (
        tops.select(*parents)
        .unionByName(crown.where("depth > 0").select(*parents))
        .groupBy(*NODE)
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    counted = crown.join(children, NODE, "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("bigint"))
    )
    deepest = crown.agg(F.max("depth")).first()[0] or 0
    crown_nodes = (
        counted.drop("size", "__below")
        .join(_crown_sums(crown_rows, counted, tops, deepest), NODE)
        .join(_crown_ends(crown_rows), NODE, "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    )
    # The parent of the uppermost node of a shard, and of a crown node, is a crown node.
    names = [f"__{n}" for n in NODE]
    above = crown.select(
        *[F.col(n).alias(name) for n, name in zip(NODE, names, strict=True)],
        F.col("conv_id").alias("__parent"),
    )
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256",
    ]
    kept = [c for c in columns if c != "parent_conv_id"]
    linked = (
        tops.select(*kept, *PARENT)
        .unionByName(crown_nodes.select(*kept, *PARENT))
        .select(*kept, *[up[n].alias(name) for n, name in zip(NODE, names, strict=True)])
    )
    linked = lookup(linked, above, names, ["conv_id"], "left", _hot_parents(children, names))
    return (
        linked.withColumnRenamed("__parent", "parent_conv_id")
        .withColumns({c: F.col(c).cast("bigint") for c in ("n_leaves", "saved_tokens")})
        .select(*columns)
        .unionByName(shard_nodes.where("NOT top").select(*columns))
    )


def _hot_parents(children: DataFrame, names: list[str]) -> DataFrame:
    hot = _hot(children, NODE, "n_children")
    return settled(hot.toDF(*names, "__buckets"), "hot-parents")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text) as they are.

    Null roles and texts are empty, null turns come first, rows without a conv_id are left
    out, and extra columns are ignored.
    """
    return prefix_trie(*ordered_turns(conversations))
