"""A prefix trie of conversations: ternary search trees over dictionary-encoded turn ids, one a range shard, joined at boundary nodes.

Conversations are sorted by their sequences of turns over all partitions; each partition is cut into shards of about SHARD_TURNS turns. A
shard numbers its turns, inserts its distinct sequences medians first, and adds up members, leaves and savings in one traversal. Nodes
on the way to a shard's first and last sequence may have members elsewhere: their parts are added by key, and what lies below them is summed
along those ways. All other nodes are whole as they are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import blake2b, sha256

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.functions.shared import stage

#: Turns of the sequences of a shard; a longer sequence is a shard of its own.
SHARD_TURNS = 1 << 17
#: Ids of members in one row while the hash of a boundary node's members is put together.
CHUNK = 1 << 14
_NONE = sha256(b"").hexdigest()


def turn_key(role: Column, text: Column) -> Column:
    """16 bytes that stand for a turn: MD5 of role and text, told apart by the role's length."""
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, key, length) of all rows that belong to a conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(F.col("conv_id").try_cast("bigint").alias("conv_id"), "turn", turn_key(role, text).alias("key"), F.length(text).cast("bigint").alias("length"))
    return rows.where("conv_id IS NOT NULL")


def _in_order(turns: Column) -> Column:
    """Collected (turn, key, length) by turn, nulls first, as (key, length)."""
    return F.transform(F.sort_array(turns), lambda t: F.struct(t["key"].alias("key"), t["length"].alias("length")))


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, path): each conversation's turns as they are."""
    return _turns(conversations).groupBy("conv_id").agg(_in_order(F.collect_list(F.struct("turn", "key", "length"))).alias("path"))


def rebuilt(conversations: DataFrame, *, every: int = 100, most: int = 6) -> DataFrame:
    """(conv_id, path): the first h turns of conversation c - c % every, then c's own after its first h; h is crc32(c) % most.

    One shuffle brings a base and all that build on it together: at most 2 * every conversations.
    """
    base = (F.col("conv_id") - F.col("conv_id") % every).alias("base")
    rows = _turns(conversations).select(base, "*").repartition("base")
    own = rows.groupBy("base", "conv_id").agg(_in_order(F.collect_list(F.struct("turn", "key", "length"))).alias("own"))
    head = F.first(F.when(F.col("conv_id") == F.col("base"), F.slice("own", 1, most - 1)), ignorenulls=True).over(W.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    own = own.select("conv_id", "own", head.alias("head"), h.alias("h"))
    rest = F.slice("own", F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0)))
    return own.select("conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("own", 1, 0)), rest).alias("path"))


class TernaryTree:
    """Sequences of small integers. Node 0 is the root; the turns that follow a node form a search tree by ``low`` and ``high``, entered by ``next``."""

    def __init__(self):
        self.turn, self.low, self.high, self.next, self.n, self.conv, self.length, self.end = [-1], [-1], [-1], [-1], [0], [None], [0], [-1]

    def insert(self, turns: Sequence[int], lengths: Sequence[int], n: int, conv: int, end: int) -> list[int]:
        """Add a sequence of ``n`` members, the smallest of which is ``conv``; the nodes on its way."""
        turn, low, high, nxt = self.turn, self.low, self.high, self.next
        at, way = 0, [0]
        for t, length in zip(turns, lengths, strict=True):
            side, of, child = nxt, at, nxt[at]
            while child >= 0 and turn[child] != t:
                side, of = (low if t < turn[child] else high), child
                child = side[child]
            if child < 0:
                child = side[of] = len(turn)
                turn.append(t)
                for links in (low, high, nxt, self.end):
                    links.append(-1)
                self.n.append(0)
                self.conv.append(None)
                self.length.append(length)
            at = child
            way.append(at)
        for x in way:
            self.n[x] += n
            self.conv[x] = conv if self.conv[x] is None else min(conv, self.conv[x])
        self.end[at] = end
        return way

    def parents_first(self) -> Iterator[tuple[int, int, int]]:
        """(node, parent, depth), a parent before what follows it."""
        stack = [(0, -1, 0)]
        while stack:
            at, parent, depth = stack.pop()
            yield at, parent, depth
            if parent >= 0:
                stack.extend((x, parent, depth) for x in (self.low[at], self.high[at]) if x >= 0)
            if self.next[at] >= 0:
                stack.append((self.next[at], at, depth + 1))


def medians_first(n: int) -> Iterator[int]:
    """0 to n - 1, the middle of each range before its halves."""
    ranges = [(0, n)]
    for low, high in ranges:
        if low < high:
            mid = (low + high) // 2
            yield mid
            ranges += [(low, mid), (mid + 1, high)]


def _ids(convs: Sequence[int]) -> bytes:
    return ",".join(map(str, convs)).encode()


_PARTS = "boundary boolean, path bigint, depth int, key binary, above binary, conv_id bigint, parent_conv_id bigint, length bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, ends_sha256 string, ends array<binary>"
_NAMES = [c.split()[0] for c in _PARTS.split(", ")]


def _shard(path: int, chunk: int, keys: np.ndarray, lengths: np.ndarray, offsets: np.ndarray, convs: list[int]) -> Iterator[tuple]:
    """Rows of _PARTS for the sequences of a shard, which come sorted; keys are 16 bytes each."""
    _, numbers = np.unique(keys, return_inverse=True)  # the shard's dictionary, in the order of the keys
    flat, lengths, keys, cut = numbers.tolist(), lengths.tolist(), keys.tobytes(), offsets.tolist()
    starts = [k for k in range(len(convs)) if not k or flat[cut[k - 1] : cut[k]] != flat[cut[k] : cut[k + 1]]]
    groups = list(zip(starts, [*starts[1:], len(convs)], strict=True))
    tree, ways = TernaryTree(), {}
    for g in medians_first(len(groups)):
        a, b = groups[g]
        way = tree.insert(flat[cut[a] : cut[a + 1]], lengths[cut[a] : cut[a + 1]], b - a, min(convs[a:b]), g)
        if g in (0, len(groups) - 1):
            ways[g] = way
    open_at, ways = {}, [ways[0], ways[len(groups) - 1]]
    for side, way in enumerate(ways):
        for depth, x in enumerate(way):
            open_at.setdefault(x, (path + side, depth))
    order = list(tree.parents_first())
    n = len(tree.turn)
    parent, kids, leaves, saved = [-1] * n, [0] * n, [0] * n, [0] * n
    for x, above, _ in reversed(order):
        parent[x] = above
        if x in open_at:
            continue
        leaves[x] += not kids[x]
        saved[x] += (tree.n[x] - 1) * tree.length[x]
        kids[above] += 1
        leaves[above] += leaves[x]
        saved[above] += saved[x]
    members = lambda x: convs[slice(*groups[tree.end[x]])] if tree.end[x] >= 0 else []
    for x, above, depth in order:
        if x not in open_at:
            up = open_at.get(above)
            yield False, up and up[0], depth, None, None, tree.conv[x], None if up else tree.conv[above], None, tree.n[x], kids[x], leaves[x], saved[x], sha256(_ids(members(x))).hexdigest(), None
    for side, (way, g) in enumerate(zip(ways, (0, len(groups) - 1), strict=True)):
        hashed, above, at = blake2b(digest_size=16), None, cut[groups[g][0]]
        for depth, x in enumerate(way):
            if depth:
                hashed.update(keys[16 * (at + depth - 1) : 16 * (at + depth)])
            key = hashed.digest()
            if open_at[x] == (path + side, depth):
                own = members(x)
                ends = [own[k : k + chunk] for k in range(0, len(own), chunk)]
                yield True, path + side, depth, key, above, tree.conv[x], None, tree.length[x], tree.n[x], kids[x], leaves[x], saved[x], None, [(e[0] + (1 << 63)).to_bytes(8, "big") + _ids(e) for e in ends]
            else:  # the way to the first sequence has it already
                yield True, path + side, depth, key, above, tree.conv[x], None, tree.length[x], 0, 0, 0, 0, None, []
            above = key


def _shards(most: int, chunk: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        schema = pa.schema([("boundary", pa.bool_()), ("path", pa.int64()), ("depth", pa.int32()), ("key", pa.binary()), ("above", pa.binary()), *((c, pa.int64()) for c in ("conv_id", "parent_conv_id", "length", "n_convs", "n_children", "n_leaves", "saved")), ("ends_sha256", pa.string()), ("ends", pa.list_(pa.binary()))])
        path = TaskContext.get().partitionId() << 33

        def done(held):
            nonlocal path
            keys, lengths, sizes, convs = zip(*held, strict=True)
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            rows = _shard(path, chunk, np.frombuffer(b"".join(keys), "S16"), np.concatenate(lengths), offsets, np.concatenate(convs).tolist())
            path += 2
            while block := [x for _, x in zip(range(1 << 13), rows, strict=False)]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*block, strict=True), schema, strict=True)], schema=schema)

        held, turns = [], 0
        for b in batches:
            ends = np.cumsum(np.diff(b["path"].offsets.to_numpy()))
            at = 0
            while at < b.num_rows:  # as many of the sequences as the shard still takes, one at least
                before = int(ends[at - 1]) if at else 0
                past = max(at + 1, int(np.searchsorted(ends, before + most - turns, side="right")))
                part = b.slice(at, past - at)
                flat = part["path"].flatten()
                held.append((b"".join(flat.field("key").to_pylist()), flat.field("length").to_numpy(), np.diff(part["path"].offsets.to_numpy()), part["conv_id"].to_numpy()))
                turns += len(flat) + (past - at)
                at = past
                if turns >= most:
                    yield from done(held)
                    held, turns = [], 0
        if held:
            yield from done(held)

    return run


def _hashed(batches: Iterator) -> Iterator:
    """(key, ends_sha256) of sorted (key, chunk): a chunk in memory at a time."""
    import pyarrow as pa

    key, state, out = None, None, []
    for b in batches:
        for k, chunk in zip(b["key"].to_pylist(), b["chunk"].to_pylist(), strict=True):
            if k != key:
                out += [(key, state.hexdigest())] if state else []
                key, state = k, sha256()
            else:
                state.update(b",")
            state.update(chunk[8:])
        if len(out) > 1 << 13:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["key", "ends_sha256"])
            out = []
    out += [(key, state.hexdigest())] if state else []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["key", "ends_sha256"])


def prefix_trie(seqs: DataFrame, *, shard_turns: int = SHARD_TURNS, chunk: int = CHUNK) -> DataFrame:
    """A row for each distinct prefix of ``seqs`` (conv_id, path of (key, length)), the empty one included.

    conv_id: the smallest member, a conversation that begins so; depth; parent_conv_id: the parent's (root: null); n_convs: members; n_children;
    n_leaves: childless nodes of its subtree, itself included; saved_tokens: over its subtree, (n_convs - 1) times the length of a node's last
    turn; ends_sha256: of the members that end there, ascending, in decimal and joined by commas.

    Memory: a task holds a shard. Equal sequences, however many, are cut by conv_id into shards like any other; the hash of their members
    is a sequential one, so one task reads their ids, ``chunk`` at a time. A conversation is one row of about 30 bytes a turn.

    Defined results: conversations without turns end at the root; equal ids are members each; an empty table has no nodes.
    """
    seqs = seqs.select("conv_id", "path").repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    parts = stage(seqs.mapInArrow(_shards(shard_turns, chunk), _PARTS), "trie-parts", ("boundary",)).select(_NAMES)
    inner, ways = parts.where("NOT boundary"), parts.where("boundary")
    whole = ways.groupBy("key").agg(F.first("above").alias("above"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("length").alias("length"), F.min("path").alias("main"),
                                    *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")])
    below = whole.where("above IS NOT NULL").groupBy(F.col("above").alias("key")).agg(F.count("*").alias("more"))
    whole = whole.join(below, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    own_leaves = F.col("n_leaves") + (F.col("n_children") == 0).cast("bigint")
    own_saved = F.col("saved") + (F.col("n_convs") - 1) * F.col("length")
    whole = stage(whole.select("key", "above", "conv_id", "depth", "main", "n_convs", "n_children", own_leaves.alias("leaves"), own_saved.alias("saved")), "trie-boundary")
    # a node counts once, on the first way that holds it; what lies below a node is the rest of all ways through it
    along = ways.select("key", "path", "depth").join(whole.select("key", "main", "leaves", "saved", "conv_id"), "key")
    rest = W.partitionBy("path").orderBy(F.desc("depth"))
    once = lambda c: F.sum(F.when(F.col("main") == F.col("path"), F.col(c)).otherwise(0)).over(rest)
    sums = along.select("key", once("leaves").alias("n_leaves"), once("saved").alias("saved_tokens")).groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    chunks = ways.select("key", F.explode("ends").alias("chunk")).repartition("key").sortWithinPartitions("key", "chunk")
    hashes = chunks.mapInArrow(_hashed, "key binary, ends_sha256 string")
    up = whole.select(F.col("key").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    outer = whole.join(up, "above", "left").join(sums, "key").join(hashes, "key", "left")
    outer = outer.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_NONE)).alias("ends_sha256"))
    inner = inner.select("conv_id", "path", (F.col("depth") - 1).alias("up"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256")
    parents = along.select("path", F.col("depth").alias("up"), F.col("conv_id").alias("boundary_conv"))  # each shard has its own copy of a hot parent
    hung = inner.where("path IS NOT NULL").join(parents, ["path", "up"]).withColumn("parent_conv_id", F.col("boundary_conv"))
    return outer.unionByName(inner.where("path IS NULL").select(outer.columns)).unionByName(hung.select(outer.columns)).withColumn("depth", F.col("depth").cast("bigint"))
