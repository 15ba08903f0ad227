"""The prefix trie of conversations, as balanced parentheses per shard.

A conversation is its sequence of turn digests. Conversations sorted by their
sequences are cut into shards of consecutive ones, so all members of a prefix
are neighbours: a prefix that neither the first nor the last conversation of a
shard starts with lies in that shard alone. A shard writes its trie as balanced
parentheses; ``findclose`` over blocks of least excess delimits each subtree,
the rank of leaf pairs ``()`` counts leaves, and cumulative arrays in preorder
give members and savings. The prefixes of a shard's first and last conversation,
its spines, may go on in other shards: they are merged by their hash, and what
only merged counts can tell is added up along each spine once.

Ids may be of any type that sorts. Rows without an id belong to no conversation
and are left out; null roles and texts are empty; null turns come first, equal
ones in order of their digests; an empty table gives no node. Only digests and
sizes move, never texts. A single conversation must fit in a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from balcao.session import written

#: Turns of a shard, about.
SHARD_TURNS = 1 << 18
DIGEST = 16
NOTHING = hashlib.sha256(b"").hexdigest()


def paths(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and its turns in order as (digest, bytes of the text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    one = F.struct(F.col("turn").alias("turn"), digest.alias("digest"), F.octet_length(text).alias("bytes"))
    listed = turns.filter(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("path"))
    return listed.withColumn("path", F.transform("path", lambda t: F.struct(t["digest"].alias("digest"), t["bytes"].alias("bytes"))))


class Parens:
    """Balanced parentheses (1 opens) with the least excess of every block and of every pair of blocks above."""

    BLOCK = 64

    def __init__(self, bits: np.ndarray):
        self.excess = np.cumsum(np.where(bits, 1, -1), dtype=np.int32)
        self.blocks = np.full((-(-len(bits) // self.BLOCK), self.BLOCK), np.iinfo(np.int32).max, np.int32)
        self.blocks.reshape(-1)[: len(bits)] = self.excess
        self.least = [self.blocks.min(1)]
        while len(self.least[-1]) > 1:
            low = self.least[-1]
            if len(low) % 2:
                low = self.least[-1] = np.append(low, np.iinfo(np.int32).max)
            self.least.append(low.reshape(-1, 2).min(1))

    def _in_block(self, block: np.ndarray, target: np.ndarray, after: np.ndarray) -> np.ndarray:
        """The first place in ``block`` beyond column ``after`` with an excess of ``target`` or less; -1 if none."""
        out = np.full(len(block), -1, np.int64)
        for lo in range(0, len(block), 1 << 15):
            part = slice(lo, lo + (1 << 15))
            low = (self.blocks[block[part]] <= target[part, None]) & (np.arange(self.BLOCK) > after[part, None])
            found = low.any(1)
            out[part] = np.where(found, block[part] * self.BLOCK + low.argmax(1), -1)
        return out

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """The places of the parentheses that close those at ``opens``."""
        target = self.excess[opens] - 1
        block = opens // self.BLOCK
        close = self._in_block(block, target, opens % self.BLOCK)
        far = np.flatnonzero(close < 0)
        if not len(far):
            return close
        want, at = target[far], block[far] + 1
        level = np.full(len(far), -1)
        for k, least in enumerate(self.least):  # up, until a range reaches down to the target
            here = np.flatnonzero((level < 0) & ((at % 2 == 1) | (len(least) == 1)))
            hit = here[least[np.minimum(at[here], len(least) - 1)] <= want[here]]
            level[hit] = k
            up = level < 0
            at[up] = (at[up] + 1) // 2
        for k in range(len(self.least) - 1, 0, -1):  # down, to its first block that does
            here = np.flatnonzero(level >= k)
            left = 2 * at[here]
            at[here] = np.where(self.least[k - 1][left] <= want[here], left, left + 1)
        close[far] = self._in_block(at, want, np.full(len(far), -1))
        return close


def _shared_turns(digests: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How many turns each sequence shares with the one before it."""
    shared = np.zeros(len(n), np.int64)
    same = np.arange(1, len(n))
    depth = 0
    while len(same):
        same = same[np.minimum(n[same], n[same - 1]) > depth]
        same = same[(digests[first[same] + depth] == digests[first[same - 1] + depth]).all(1)]
        depth += 1
        shared[same] = depth
    return shared


class ShardTrie:
    """The trie of sorted sequences; arrays are by node in preorder, the root first."""

    def __init__(self, digests: np.ndarray, sizes: np.ndarray, n: np.ndarray, rank: np.ndarray):
        first = np.cumsum(n) - n
        shared = _shared_turns(digests, first, n)
        fresh = n - shared
        total = 1 + int(fresh.sum())
        row = np.repeat(np.arange(len(n)), fresh)
        begin = np.cumsum(fresh) - fresh
        nth = np.arange(total - 1) - begin[row]
        self.depth = np.concatenate([[0], shared[row] + nth + 1])
        self.bytes = np.concatenate([[0], sizes[first[row] + self.depth[1:] - 1]])
        self.end = np.maximum.accumulate(np.where(fresh > 0, begin + fresh, 0))  # node where each sequence ends

        opens = 2 * np.arange(total) - self.depth
        bits = np.zeros(2 * total, bool)
        bits[opens] = True
        close = Parens(bits).findclose(opens)
        self.after = np.arange(total) + (close - opens + 1) // 2  # the first node beyond the subtree
        self.leaf = ~bits[opens + 1]
        self.convs = self._within(np.bincount(self.end, minlength=total))
        order = np.argsort(self.depth, kind="stable")
        levels = np.split(order, np.cumsum(np.bincount(self.depth))[:-1])
        self.parent = np.full(total, -1, np.int64)
        for above, level in zip(levels, levels[1:]):
            self.parent[level] = above[np.searchsorted(above, level) - 1]
        self.least = np.full(total, len(n), np.int64)
        np.minimum.at(self.least, self.end, rank)
        for level in levels[:0:-1]:
            np.minimum.at(self.least, self.parent[level], self.least[level])
        nodes, last = np.arange(total), self.end[-1]
        self.on_first = nodes <= n[0]
        self.on_last = (nodes <= last) & (self.after > last)
        self.spine = self.on_first | self.on_last

        whole = ~self.spine
        self.children = np.bincount(self.parent[1:][whole[1:]], minlength=total)
        self.leaves = self._within(self.leaf & whole)
        self.saved = self._within(np.where(whole, (self.convs - 1) * self.bytes, 0))

    def _within(self, values: np.ndarray) -> np.ndarray:
        """The sum of ``values`` over each subtree."""
        upto = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return upto[self.after] - upto[: len(self.after)]


def _prefix_hashes(digests: np.ndarray) -> list[bytes]:
    hashed = hashlib.md5()
    out = [hashed.digest()]
    for one in digests:
        hashed.update(one.tobytes())
        out.append(hashed.copy().digest())
    return out


def _shard_rows(ids: pa.Array, keys: pa.Array, sizes: pa.Array, shard: int, schema: pa.Schema) -> pa.RecordBatch:
    digests = np.frombuffer(b"".join(keys.to_pylist()), np.uint64).reshape(-1, 2)
    n = np.diff(sizes.offsets.to_numpy())
    order = pa.compute.sort_indices(ids).to_numpy().astype(np.int64)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    trie = ShardTrie(digests, sizes.flatten().to_numpy().astype(np.int64), n, rank)

    texts = ids.cast(pa.string()).to_pylist()
    bounds = np.flatnonzero(np.diff(trie.end, prepend=-1))
    ended = {int(trie.end[a]): ",".join(texts[a:b]) for a, b in zip(bounds, [*bounds[1:], len(texts)])}
    names: dict[int, bytes] = {}
    for row, path in ((0, trie.on_first), (-1, trie.on_last)):
        own = digests[: n[0]] if row == 0 else digests[len(digests) - n[-1] :]
        names.update(zip(np.flatnonzero(path).tolist(), _prefix_hashes(own)))

    spine, parent = trie.spine, trie.parent
    below_spine = (parent >= 0) & spine[parent]
    named = ids.take(pa.array(order)).take(pa.array(trie.least))
    inner = pa.array(np.where(below_spine | (parent < 0), 0, parent), mask=below_spine | (parent < 0))
    listed = range(len(spine))
    columns = {
        "conv_id": named, "depth": trie.depth, "parent_conv_id": named.take(inner), "n_convs": trie.convs,
        "n_children": trie.children, "n_leaves": trie.leaves, "saved_tokens": trie.saved,
        "ends_sha256": [None if spine[k] else hashlib.sha256(ended[k].encode()).hexdigest() if k in ended else NOTHING for k in listed],
        "shard": np.full(len(spine), shard), "on_first": trie.on_first, "on_last": trie.on_last, "bytes": trie.bytes,
        "node": [names.get(k) for k in listed], "parent": [names[p] if b else None for p, b in zip(parent.tolist(), below_spine)],
        "ended": [ended.get(k) if spine[k] else None for k in listed],
    }
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name]).cast(f.type) for f in schema], schema=schema)


def _sharded(listed: DataFrame, shards: int) -> DataFrame:
    """The nodes of every shard; spines bring what their shard knows of them."""
    kind = listed.schema["conv_id"].dataType
    long, flag, raw, text = T.LongType(), T.BooleanType(), T.BinaryType(), T.StringType()
    fields = {
        "conv_id": kind, "depth": long, "parent_conv_id": kind, "n_convs": long, "n_children": long, "n_leaves": long,
        "saved_tokens": long, "ends_sha256": text, "shard": long, "on_first": flag, "on_last": flag, "bytes": long,
        "node": raw, "parent": raw, "ended": text,
    }
    schema = T.StructType([T.StructField(k, v) for k, v in fields.items()])

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        table = pa.Table.from_batches([b for b in batches if b.num_rows] or [pa.RecordBatch.from_pylist([])])
        if not table.num_rows:
            return
        ids, keys, sizes = (table.column(c).combine_chunks() for c in ("conv_id", "key", "sizes"))
        whole = _shard_rows(ids, keys, sizes, TaskContext.get().partitionId(), to_arrow_schema(schema))
        for lo in range(0, whole.num_rows, 1 << 16):
            yield whole.slice(lo, 1 << 16)

    # The path as fixed-width digests, in one pass over it; binary values sort byte by byte.
    key = F.unhex(F.array_join("path.digest", ""))
    rows = listed.select("conv_id", key.alias("key"), F.col("path.bytes").alias("sizes"))
    return rows.repartitionByRange(shards, "key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(nodes, schema)


def _ended(spines: DataFrame) -> DataFrame:
    """The hash of all ids that end at a spine, shard by shard: a node's ids are never held together."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for here, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if here != node:
                    if node is not None:
                        done.append((node, sha.hexdigest()))
                    node, sha = here, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([sha.hexdigest()])], ["node", "ends_sha256"])

    told = spines.filter("ended is not null").select("node", "ended", "shard")
    ordered = told.repartition("node").sortWithinPartitions("node", "shard").drop("shard")
    return ordered.mapInArrow(hashed, "node binary, ends_sha256 string")


def _merged(spines: DataFrame) -> DataFrame:
    """One row per distinct spine node, with merged counts."""
    side = F.when(F.col("on_first"), 0).otherwise(1)
    nodes = spines.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent").alias("parent"),
        F.sum("n_convs").alias("n_convs"), F.max("bytes").alias("bytes"), F.min(F.struct("shard", side.alias("side"))).alias("owner"),
        *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")],
    )
    nodes = written(nodes, "trie-spines")
    kids = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("kids"))
    counted = nodes.join(kids, "node", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
    counted = written(counted.withColumns({
        "own_saved": (F.col("n_convs") - 1) * F.col("bytes"), "own_leaf": (F.col("n_children") == 0).cast("long"),
    }), "trie-spines")

    # A node is owned by the first spine that it is on, and a spine owns the lower end of its path. Summing
    # what it owns from there up gives each of its nodes the share of its subtree.
    sides = F.filter(F.array(F.when(F.col("on_first"), 0), F.when(F.col("on_last"), 1)), lambda s: s.isNotNull())
    steps = spines.select("node", "shard", F.explode(sides).alias("side")).join(
        counted.select("node", "depth", "owner", "own_saved", "own_leaf"), "node"
    )
    own = F.col("owner") == F.struct("shard", "side")
    upward = Window.partitionBy("shard", "side").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    below = steps.select(
        "node", *[F.sum(F.when(own, F.col(c)).otherwise(0)).over(upward).alias(c) for c in ("own_saved", "own_leaf")]
    ).groupBy("node").agg(F.sum("own_saved").alias("spine_saved"), F.sum("own_leaf").alias("spine_leaves"))
    return counted.join(below, "node").join(_ended(spines), "node", "left").select(
        "node", "parent", "conv_id", "depth", "n_convs", "n_children",
        (F.col("n_leaves") + F.col("spine_leaves")).alias("n_leaves"),
        (F.col("saved_tokens") + F.col("spine_saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )


def trie(listed: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per distinct prefix of the conversations in ``listed`` (see ``paths``), the empty one included.

    conv_id is the smallest member; saved_tokens sums, over the subtree, the
    bytes that all members but one share.
    """
    listed = written(listed.select("conv_id", "path"), "trie-paths")
    turns = listed.agg(F.sum(F.size("path") + 1)).first()[0] or 0
    stored = written(_sharded(listed, max(1, -(-turns // shard_turns))), "trie")
    spine = F.col("on_first") | F.col("on_last")
    spines = stored.filter(spine)
    merged = written(_merged(spines), "trie-merged")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]

    # Each shard needs the merged names of its own spines only.
    names = merged.select("node", F.col("conv_id").alias("name"))
    known = spines.select("shard", "node").join(names, "node").withColumnRenamed("node", "parent")
    whole = stored.filter(~spine).join(known, ["shard", "parent"], "left")
    whole = whole.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "name")).select(columns)
    shared = merged.join(names.select(F.col("node").alias("parent"), F.col("name").alias("parent_conv_id")), "parent", "left")
    return whole.unionByName(shared.select(columns))
