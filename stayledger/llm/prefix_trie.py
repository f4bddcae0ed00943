"""Prefix trie of conversations in balanced parentheses, built in shards whose spines merge.

Every turn becomes a step of 16 bytes, a conversation the string of its steps. Equal strings are
counted first, so a conversation with very many copies is one row. The distinct strings are cut
into ranges of their order; each range is a shard. A shard writes its trie in preorder as
parentheses, one pair for each node, and keeps the excess of opened ones with the least excess
of each block: a tree of these minima finds the parenthesis that closes a node, so subtrees are
ranges. The rank of leaf pairs ``()`` counts leaves, running sums give members and savings.

Only nodes on the first and last string of a shard, its spines, can have parts in other shards.
The shard with the least number owns such a node and counts it once; parts are added by key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayledger.llm.common import store

#: Bytes of a step, and steps that a shard holds on average.
STEP, SHARD = 16, 20_000
#: Excess values in one block of the range minima.
BLOCK = 128
_NONE = np.iinfo(np.int64).max


def conversations(turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """(conv_id, steps): a row for each conversation, ``steps`` its turns as
    array<struct<step: hex string, size: long>> in order.

    Turns go by number, null numbers first, then role, then text; null roles and texts are empty;
    repeated rows are turns of their own; rows without an id are one conversation; other columns
    play no part. ``size`` counts the code points of the text.
    """
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = turns.select(F.col(id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                        role_.alias("role"), text_.alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    step = F.substring(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256),
                       1, 2 * STEP)
    numbered = rows.select("conv_id", F.row_number().over(order).alias("nth"), step.alias("step"),
                           F.length("text").cast("long").alias("size"))
    listed = F.array_sort(F.collect_list(F.struct("nth", "step", "size")))
    return numbered.groupBy("conv_id").agg(F.transform(listed, lambda t: F.struct(t.step, t.size)).alias("steps"))


def min_tree(excess: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """The excess in rows of one block each, and a heap whose leaves are the least of each row."""
    rows = np.full((-(-len(excess) // block), block), _NONE, np.int64)
    rows.reshape(-1)[:len(excess)] = excess
    leaves = 1 << (len(rows) - 1).bit_length()
    tree = np.full(2 * leaves, _NONE, np.int64)
    tree[leaves:leaves + len(rows)] = rows.min(axis=1)
    for k in range(leaves - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])
    return rows, tree


def find_close(excess: np.ndarray, opens: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Position of the parenthesis that closes each of ``opens``: the next one whose excess is
    one less. Searched in its own block, then by the minima, then in the block they name."""
    rows, tree = min_tree(excess, block)
    leaves, out = len(tree) // 2, np.full(len(opens), -1, np.int64)
    column = np.arange(block)

    def inside(which: np.ndarray, blocks: np.ndarray, after: np.ndarray) -> None:
        for at in range(0, len(which), 4096):
            w, b, a = (x[at:at + 4096] for x in (which, blocks, after))
            hit = (rows[b] < excess[opens[w]][:, None]) & (column > a[:, None])
            found = hit.any(axis=1)
            out[w[found]] = b[found] * block + hit.argmax(axis=1)[found]

    inside(np.arange(len(opens)), opens // block, opens % block)
    which = np.nonzero(out < 0)[0]
    goal, node = excess[opens[which]], leaves + opens[which] // block
    climbing = np.ones(len(which), bool)
    while climbing.any():
        right = climbing & (node % 2 == 0) & (tree[np.minimum(node + 1, len(tree) - 1)] < goal)
        node = np.where(right, node + 1, np.where(climbing, node >> 1, node))
        climbing &= ~right
    while (down := node < leaves).any():
        left = tree[np.where(down, 2 * node, 0)] < goal
        node = np.where(down, np.where(left, 2 * node, 2 * node + 1), node)
    inside(which, node - leaves, np.full(len(which), -1))
    return out


def _shared(a: bytes, b: bytes) -> int:
    """Steps that two strings begin with alike."""
    n = min(len(a), len(b)) // STEP * STEP
    if a[:n] == b[:n]:
        return n // STEP
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int((x != y).argmax()) // STEP


def keys(path: bytes) -> list[bytes]:
    """Names of the nodes on a string, root first."""
    state, out = hashlib.sha256(), []
    for at in range(0, len(path) + 1, STEP):
        out.append(state.copy().digest()[:STEP])
        state.update(path[at:at + STEP])
    return out


class Shard:
    """The trie of distinct strings in ascending order; nodes are numbered in preorder, root 0."""

    def __init__(self, paths: list[bytes]):
        self.paths = paths
        depth = np.array([len(p) // STEP for p in paths], np.int64)
        shared = np.array([0] + [_shared(a, b) for a, b in zip(paths, paths[1:])], np.int64)
        closed = np.concatenate(([0], depth[:-1] - shared[1:]))
        opened = depth - shared
        runs = np.concatenate(([1], np.stack([closed, opened], axis=1).reshape(-1), [depth[-1] + 1]))
        kinds = np.concatenate(([1], np.tile([0, 1], len(paths)), [0]))
        self.bits = np.repeat(kinds, runs).astype(bool)
        self.excess = np.cumsum(np.where(self.bits, 1, -1))
        self.opens = np.nonzero(self.bits)[0]
        self.closes = find_close(self.excess, self.opens)
        self.stop = np.arange(len(self.opens)) + (self.closes - self.opens + 1) // 2
        self.depth = self.excess[self.opens] - 1
        self.ends = np.cumsum(opened)  # node at which each string ends
        self.parent = np.arange(-1, len(self.opens) - 1)
        path = np.zeros(int(depth.max()) + 1, np.int64)
        for d, s, end in zip(depth.tolist(), shared.tolist(), self.ends.tolist()):
            if d > s:
                self.parent[end - (d - s) + 1] = path[s]
                path[s + 1:d + 1] = np.arange(end - (d - s) + 1, end + 1)
        self.first, self.last = np.arange(depth[0] + 1), path[:depth[-1] + 1]

    def below(self, values: np.ndarray) -> np.ndarray:
        """Sum of ``values``, one for each node, over every subtree."""
        total = np.concatenate(([0], np.cumsum(values)))
        return total[self.stop] - total[:-1]

    def leaves(self, counted: np.ndarray) -> np.ndarray:
        """Pairs ``()`` inside every subtree, of nodes that are ``counted``."""
        pair = np.zeros(len(self.bits), np.int64)
        pair[:-1] = self.bits[:-1] & ~self.bits[1:]
        pair[self.opens[~counted]] = 0
        rank = np.cumsum(pair)
        return rank[self.closes] - rank[self.opens] + pair[self.opens]

    def least(self, values: np.ndarray) -> np.ndarray:
        """Least of ``values``, one for each string, over the strings of every subtree."""
        before = np.searchsorted(self.ends, np.arange(len(self.opens)))
        after = np.searchsorted(self.ends, self.stop)
        bounds = np.stack([before, after], axis=1).reshape(-1)
        return np.minimum.reduceat(np.append(values, _NONE), bounds)[::2]


_NODES = ("key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
          "n_children long, n_leaves long, saved_tokens long, ends_sha256 string")


def _long(values: np.ndarray, unknown: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.int64), pa.int64(), mask=unknown)


def _nodes(strings: pa.Table, spines: pa.Table) -> pa.Table:
    """Nodes of one shard; those on its spines have a key and hold this shard's part."""
    if not strings.num_rows:
        return pa.schema([("key", pa.binary()), ("parent_key", pa.binary()), *[(c, pa.int64()) for c in (
            "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
            ("ends_sha256", pa.string())]).empty_table()
    strings = strings.sort_by("path")
    trie = Shard(strings["path"].to_pylist())
    n = len(trie.opens)
    number, owned, parts, name = strings["shard"][0].as_py(), np.ones(n, bool), np.zeros(n, bool), np.empty(n, object)
    inner = np.zeros(n, bool)
    for last, depth, owner, child in zip(*(spines[c].to_pylist() for c in ("last", "depth", "owner", "child"))):
        v = (trie.last if last else trie.first)[depth]
        owned[v], inner[v] = owner == number, inner[v] or child
    for nodes, path in ((trie.first, trie.paths[0]), (trie.last, trie.paths[-1])):
        parts[nodes] = True
        name[nodes] = keys(path)
    sizes = strings["sizes"].combine_chunks()
    starts = np.concatenate(([0], np.cumsum(sizes.value_lengths().to_numpy(zero_copy_only=False))))
    of = np.searchsorted(trie.ends, np.arange(1, n))  # string that brought each node in
    size = np.concatenate(([0], sizes.flatten().to_numpy(zero_copy_only=False)[starts[of] + trie.depth[1:] - 1]))
    count, digest = np.zeros(n, np.int64), np.full(n, None, object)
    count[trie.ends] = strings["n"].to_numpy()
    digest[trie.ends] = strings["digest"].to_pylist()
    n_convs = trie.below(count)
    children = np.bincount(trie.parent[1:], weights=owned[1:], minlength=n).astype(np.int64)
    smallest = trie.least(strings["least"].fill_null(_NONE).to_numpy(zero_copy_only=False))
    up = np.maximum(trie.parent, 0)
    root = np.arange(n) == 0
    return pa.table({
        "key": pa.array(np.where(parts, name, None).tolist(), pa.binary()),
        "parent_key": pa.array(np.where(parts[up] & ~root, name[up], None).tolist(), pa.binary()),
        "depth": pa.array(trie.depth, pa.int64()),
        "conv_id": _long(smallest, smallest == _NONE),
        "parent_conv_id": _long(smallest[up], root | parts[up] | (smallest[up] == _NONE)),
        "n_convs": pa.array(n_convs, pa.int64()), "n_children": pa.array(children, pa.int64()),
        "n_leaves": pa.array(trie.leaves(owned & ~inner), pa.int64()),
        "saved_tokens": pa.array(trie.below((n_convs - owned) * size), pa.int64()),
        "ends_sha256": pa.array(digest.tolist(), pa.string())})


def _spines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes on the first and the last string of each shard."""
    for batch in batches:
        for shard, low, high in zip(*(batch[c].to_pylist() for c in ("shard", "low", "high"))):
            for last, path in ((False, low), (True, high)):
                names = keys(path)
                yield pa.record_batch({
                    "shard": pa.array([shard] * len(names), pa.int32()), "last": pa.array([last] * len(names)),
                    "depth": pa.array(range(len(names)), pa.int64()), "key": pa.array(names, pa.binary()),
                    "child": pa.array([d < len(names) - 1 for d in range(len(names))])})


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each string, from parts that come in order, one after the other."""
    now = state = None
    glue = ""
    for batch in batches:
        out = []
        for path, ids in zip(batch["seq"].to_pylist(), batch["ids"].to_pylist()):
            if path != now:
                if now is not None:
                    out.append((now, state.hexdigest()))
                now, state, glue = path, hashlib.sha256(), ""
            if ids:
                state.update((glue + ids).encode())
                glue = ","
        yield pa.record_batch({"seq": pa.array([x for x, _ in out], pa.binary()),
                               "digest": pa.array([x for _, x in out], pa.string())})
    if now is not None:
        yield pa.record_batch({"seq": pa.array([now], pa.binary()), "digest": pa.array([state.hexdigest()])})


def _strings(chats: DataFrame) -> DataFrame:
    """(path, sizes, n, least, digest): each distinct string with its members."""
    path = F.unhex(F.array_join(F.transform("steps", lambda t: t.step), ""))
    rows = chats.select("conv_id", path.alias("path"), F.transform("steps", lambda t: t.size).alias("sizes"))
    rows = store(rows.withColumn("seq", F.unhex(F.substring(F.sha2("path", 256), 1, 2 * STEP))), "strings")
    distinct = rows.groupBy("seq").agg(
        F.first("path").alias("path"), F.first("sizes").alias("sizes"), F.count("*").alias("n"),
        F.min("conv_id").alias("least"))
    # ranges of ids: a string with very many members is joined in many tasks
    parts = store(rows.select("seq", "conv_id").repartitionByRange("seq", "conv_id").groupBy(
        "seq", F.spark_partition_id().alias("part")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids")).select(
            "seq", F.try_element_at("ids", F.lit(1)).alias("low"),
            F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids")), "members")
    digests = parts.repartition("seq").sortWithinPartitions("seq", F.asc_nulls_last("low")).mapInArrow(
        _digests, "seq binary, digest string")
    return distinct.join(digests, "seq").drop("seq")


def trie(chats: DataFrame, per_shard: int = SHARD) -> DataFrame:
    """A row for each distinct beginning of the conversations ``chats`` (conv_id, steps), which
    hold an id once: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256).

    ``conv_id`` is the smallest member, ``n_convs`` counts members, ``n_leaves`` the childless
    nodes of the subtree, ``saved_tokens`` sums (members - 1) times the size of the last step over
    the subtree, ``ends_sha256`` digests the ids of members that end there. A null id counts as a
    member, but is nobody's smallest and in no digest. Conversations without turns end at the root;
    no conversations give no rows. A string is held whole by one task, copies of it are not.
    """
    strings = store(_strings(chats), "distinct")
    steps = strings.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    shards = store(strings.repartitionByRange(-(-steps // per_shard) or 1, "path").withColumn(
        "shard", F.spark_partition_id()), "shards")
    spines = shards.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high")).mapInArrow(
        _spines, "shard int, last boolean, depth long, key binary, child boolean")
    spines = store(spines, "spines")
    known = spines.groupBy("key").agg(F.min("shard").alias("owner"), F.max("child").alias("child"))
    flags = spines.drop("child").join(known, "key").select("shard", "last", "depth", "owner", "child")
    nodes = store(shards.groupBy("shard").cogroup(flags.groupBy("shard")).applyInArrow(_nodes, _NODES), "nodes")
    sums = {c: F.sum(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")}
    merged = store(nodes.where("key IS NOT NULL").groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[f.alias(c) for c, f in sums.items()], F.max("ends_sha256").alias("ends_sha256")), "merged")
    columns = ["depth", "conv_id", "parent_conv_id", *sums, "ends_sha256"]
    whole = nodes.where("key IS NULL AND parent_key IS NULL").select(columns)
    root = merged.where("parent_key IS NULL").withColumn("parent_conv_id", F.lit(None).cast("long")).select(columns)
    below = merged.where("parent_key IS NOT NULL").unionByName(
        nodes.where("key IS NULL AND parent_key IS NOT NULL").select(merged.columns)).join(
            merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")), "parent_key").select(columns)
    nothing = hashlib.sha256(b"").hexdigest()
    return whole.unionByName(root).unionByName(below).select(
        "conv_id", "depth", "parent_conv_id", *sums, F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
