"""Packing documents into sequences of a fixed length by a grouping genetic algorithm.

Documents become token ids, those longer than a sequence are cut into pieces,
and full pieces are sequences of their own. The others are dealt by a hash of
their row to shards of a bounded number of pieces, and each shard is packed on
its own by several islands. An individual is a whole packing. Crossover injects
whole well-filled bins of one parent into the other, removes the bins that held
any of their pieces, and puts the displaced pieces where they fit best, longest
first; mutation dissolves the emptiest bins in the same way. After each epoch
every island's best individuals move to the next island of their shard. The
emptiest bins of all shards are then dissolved and packed anew together, in
ever fewer shards.

Only lengths travel between islands. Null texts are empty; a document of no
tokens still has its end token; rows of equal or null ids are documents of their
own; an empty table gives no piece. Texts are tokenized whole, word by word.
"""

from __future__ import annotations

import os
import random
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from balcao.llm.texts import groups
from balcao.session import written

#: Pieces of a shard, about.
SHARD_PIECES = 4096
ISLANDS = 3
EPOCHS = 2
POPULATION = 6
CHILDREN = 6
ELITE = 2
#: Of a shard's bins one in so many, the emptiest, are packed again with those of other shards.
AGAIN = 16
#: Words a worker remembers the ids of; beyond, it starts anew.
WORDS_KNOWN = 1_000_000


class WordIds:
    """Token ids by word; a tokenizer that drops white space sees each word by itself."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.starts = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]

    def _learn(self, words: list[str]) -> None:
        found = [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        flat = np.fromiter((i for one in found for i in one), np.uint32, int(sizes.sum()))
        self.ids = [np.concatenate([*self.ids, flat])]
        self.starts = [np.concatenate([*self.starts, self.starts[-1][-1] + np.cumsum(sizes)])]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin."""
        texts = pc.fill_null(texts, "")
        # Cutting a letter from the mark after it changes no token, but a special token's spelling must stay.
        plain = pc.invert(pc.match_substring(texts, "<|"))
        cut = pc.replace_substring_regex(pc.ascii_lower(texts), pattern=r"([a-z])([.,;:!?])", replacement=r"\1 \2")
        words = pc.ascii_split_whitespace(pc.if_else(plain, cut, texts))
        coded = words.flatten().dictionary_encode()
        spelled = coded.dictionary.to_pylist()
        if len(self.known) + len(spelled) > WORDS_KNOWN:
            self._forget()
        self._learn([w for w in spelled if w not in self.known])
        which = np.fromiter((self.known[w] for w in spelled), np.int64, len(spelled))[coded.indices.to_numpy()]
        ids, starts = self.ids[0], self.starts[0]
        sizes = starts[which + 1] - starts[which]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        flat = ids[np.repeat(starts[which] - upto[:-1], sizes) + np.arange(upto[-1])]
        offsets = words.offsets.to_numpy()
        return flat, upto[offsets - offsets[0]]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def pieces(docs: DataFrame, tokenizer: str, limit: int, end: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of all pieces of at most ``limit`` ids; ``end`` closes each document."""
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for lo, hi in groups(batch.column("text")):
                ids, starts = word_ids(tokenizer).encode(batch.column("text").slice(lo, hi - lo))
                ids = np.insert(ids, starts[1:], end).astype("<u4")
                starts = starts + np.arange(len(starts))
                n = np.diff(starts)
                parts = -(-n // limit)
                row = np.repeat(np.arange(hi - lo), parts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                length = np.minimum(n[row] - piece * limit, limit)
                begin = starts[row] + piece * limit
                data = memoryview(ids.tobytes())
                crc = [zlib.crc32(data[4 * b : 4 * (b + m)]) for b, m in zip(begin.tolist(), length.tolist())]
                own = batch.column("doc_id").slice(lo, hi - lo).take(pa.array(row))
                columns = [own, piece, piece * limit, length, crc]
                yield pa.RecordBatch.from_arrays([pa.array(c).cast(f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, arrow)], schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


class Room:
    """Bins by the room left in them; the least room that holds a piece is found by bits."""

    def __init__(self, limit: int):
        self.bits, self.bins = 0, [[] for _ in range(limit + 1)]

    def put(self, room: int, which: int) -> None:
        self.bins[room].append(which)
        self.bits |= 1 << room

    def take(self, size: int) -> tuple[int, int]:
        """(room, bin) of the tightest fit, taken out; room -1 if nothing fits."""
        above = self.bits >> size
        if not above:
            return -1, -1
        room = size + (above & -above).bit_length() - 1
        held = self.bins[room]
        which = held.pop()
        if not held:
            self.bits ^= 1 << room
        return room, which


def best_fit(lengths: np.ndarray, order: np.ndarray, bins: np.ndarray, used: np.ndarray, limit: int) -> np.ndarray:
    """Put the pieces in ``order`` where they fit best; ``bins`` holds each piece's bin (-1: none) and is changed.

    ``used`` is the fill of the bins that are there; returns ``bins`` with numbers without gaps.
    """
    room = Room(limit)
    for which in np.flatnonzero((used > 0) & (used < limit)).tolist():
        room.put(limit - int(used[which]), which)
    fresh = len(used)
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        left, which = room.take(size)
        if left < 0:
            left, which, fresh = limit, fresh, fresh + 1
        bins[i] = which
        if left > size:
            room.put(left - size, which)
    return np.unique(bins, return_inverse=True)[1]


def fills(lengths: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return np.bincount(bins, weights=lengths).astype(np.int64)


def fitness(lengths: np.ndarray, bins: np.ndarray, limit: int) -> float:
    """Mean squared fill: fewer and less even bins are better."""
    return float(np.mean((fills(lengths, bins) / limit) ** 2))


def _replaced(lengths: np.ndarray, bins: np.ndarray, out: np.ndarray, limit: int, order: np.ndarray | None = None) -> np.ndarray:
    """Dissolve the bins in the mask ``out`` and best-fit their pieces, longest first unless an order is given."""
    loose = np.flatnonzero(out[bins])
    used = np.where(out, 0, fills(lengths, bins))
    if order is None:
        order = loose[np.argsort(-lengths[loose], kind="stable")]
    new = bins.copy()
    new[loose] = -1
    return best_fit(lengths, order, new, used, limit)


def crossover(lengths: np.ndarray, mother: np.ndarray, father: np.ndarray, limit: int, rng: np.random.Generator) -> np.ndarray:
    """The mother's packing with some of the father's well-filled bins injected whole."""
    fill = fills(lengths, father)
    good = np.flatnonzero(fill >= np.quantile(fill, 0.5))
    chosen = np.zeros(len(fill), bool)
    chosen[rng.choice(good, max(1, int(len(good) * rng.uniform(0.1, 0.5))), replace=False)] = True
    injected = chosen[father]
    hit = np.zeros(int(mother.max()) + 1, bool)
    hit[mother[injected]] = True
    child = np.where(injected, father + len(hit), mother)  # injected bins beside the mother's
    loose = np.flatnonzero(hit[mother] & ~injected)
    child[loose] = 0
    used = np.bincount(child, weights=np.where(hit[mother] & ~injected, 0, lengths), minlength=len(hit) + len(fill)).astype(np.int64)
    return best_fit(lengths, loose[np.argsort(-lengths[loose], kind="stable")], child, used, limit)


def mutated(lengths: np.ndarray, bins: np.ndarray, limit: int, rng: np.random.Generator) -> np.ndarray:
    """The emptiest bins and a few others dissolved and best-fitted."""
    fill = fills(lengths, bins)
    out = fill <= np.quantile(fill, 0.02)
    out[rng.integers(0, len(fill), max(1, len(fill) // 50))] = True
    return _replaced(lengths, bins, out, limit)


def first_packings(lengths: np.ndarray, limit: int, n: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Best fit by decreasing length, and by lengths blurred more and more."""
    out = []
    for i in range(n):
        blurred = lengths * rng.uniform(1 - 0.15 * i, 1, len(lengths)) if i else lengths
        start = np.full(len(lengths), -1, np.int64)
        out.append(best_fit(lengths, np.argsort(-blurred, kind="stable"), start, np.zeros(0, np.int64), limit))
    return out


def evolve(lengths: np.ndarray, packings: list[np.ndarray], limit: int, seed: int) -> list[np.ndarray]:
    """One epoch on one island: the best packings, the very best first."""
    rng = np.random.default_rng(seed)
    pick = random.Random(seed)
    least = -(-int(lengths.sum()) // limit)
    crowd = packings + first_packings(lengths, limit, max(0, POPULATION - len(packings)), rng)
    scored = sorted(((fitness(lengths, p, limit), i, p) for i, p in enumerate(crowd)), key=lambda s: (-s[0], s[1]))
    for step in range(CHILDREN):
        if int(scored[0][2].max()) + 1 <= least:
            break
        ranked = [p for _, _, p in scored]
        mother, father = ranked[min(pick.randrange(len(ranked)), pick.randrange(len(ranked)))], ranked[pick.randrange(len(ranked))]
        child = crossover(lengths, mother, father, limit, rng)
        if step % 2:
            child = mutated(lengths, child, limit, rng)
        scored = sorted([*scored, (fitness(lengths, child, limit), len(crowd) + step, child)], key=lambda s: (-s[0], s[1]))[:POPULATION]
    return [p for _, _, p in scored[:ELITE]]


def _epoch(crowds: DataFrame, limit: int, number: int) -> DataFrame:
    """Evolve every island's crowd by itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, island = batch.column("shard")[i].as_py(), batch.column("island")[i].as_py()
                lengths = batch.column("lengths")[i].values.to_numpy().astype(np.int64)
                found = [p.values.to_numpy().astype(np.int64) for p in batch.column("packings")[i].values] if len(batch.column("packings")[i]) else []
                best = evolve(lengths, found, limit, zlib.crc32(f"{shard},{island},{number}".encode()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int64()), pa.array([island], pa.int32()), pa.array([[p.tolist() for p in best]], pa.list_(pa.list_(pa.int32())))],
                    ["shard", "island", "best"],
                )

    return crowds.select("shard", "island", "lengths", "packings").mapInArrow(run, "shard long, island int, best array<array<int>>")


def _packed(rows: DataFrame, n_pieces: int, limit: int) -> DataFrame:
    """Shards of ``rows`` with their items and the best packing of all islands as an array of bins."""
    n_shards = -(-n_pieces // SHARD_PIECES)
    number = F.monotonically_increasing_id()  # rows come from a written table, so a repeated task numbers them alike
    item = F.struct("number", *[c for c in rows.columns])
    shards = (
        rows.withColumn("number", number).withColumn("shard", F.pmod(F.xxhash64("number"), F.lit(n_shards)))
        .groupBy("shard").agg(F.sort_array(F.collect_list(item)).alias("items"))
    )
    shards = written(shards, "pack-shards")
    lengths = shards.select("shard", F.expr("transform(items, i -> int(i.length))").alias("lengths"))
    islands = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island")
    crowds = lengths.select("shard", "lengths", islands, F.array().cast("array<array<int>>").alias("packings"))
    crowds = crowds.repartition("shard", "island")
    for epoch in range(EPOCHS):
        evolved = _epoch(crowds, limit, epoch)
        if epoch + 1 < EPOCHS:  # the best stay, and go to the next island too
            islands = F.array("island", F.pmod(F.col("island") + 1, F.lit(ISLANDS)))
            met = evolved.select("shard", F.explode(islands).alias("to"), "island", "best")
            met = met.groupBy("shard", F.col("to").alias("island")).agg(
                F.flatten(F.expr("transform(sort_array(collect_list(struct(island, best))), s -> s.best)")).alias("packings")
            )
            crowds = met.join(lengths, "shard")
    first = F.col("best")[0]
    fewest = F.min_by(first, F.struct(F.array_max(first), "island"))
    return shards.join(evolved.groupBy("shard").agg(fewest.alias("bins")), "shard")


def pack(found: DataFrame, limit: int) -> DataFrame:
    """``found`` (see ``pieces``) with sequence_id and offset, in as few sequences as it can."""
    stored = written(found, "pieces")
    full = F.col("length") == limit
    alone = stored.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).filter(full).withColumn("offset", F.lit(0).cast("long"))
    rest, out, level = stored.filter(~full), [alone], 0
    columns = [F.col(f"item.{c}").alias(c) for c in stored.columns]
    n = rest.count()
    while n:
        single = n <= SHARD_PIECES or level == 3
        placed = _packed(rest, n, limit).select("shard", F.explode(F.arrays_zip(F.col("items").alias("item"), F.col("bins").alias("bin"))).alias("one"))
        placed = placed.select("shard", "one.item", "one.bin")
        own = Window.partitionBy("shard", "bin")
        order = own.orderBy("item.number").rowsBetween(Window.unboundedPreceding, -1)
        placed = placed.withColumns({
            "offset": F.coalesce(F.sum("item.length").over(order), F.lit(0).cast("long")), "fill": F.sum("item.length").over(own),
        })
        # The emptiest bins by rank of fill, at least one a shard.
        rank = F.dense_rank().over(Window.partitionBy("shard").orderBy("fill", "bin"))
        n_bins = F.max("bin").over(Window.partitionBy("shard")) + 1
        placed = written(placed.withColumn("again", F.lit(False) if single else rank <= F.ceil(n_bins / AGAIN)), "packed")
        # 20 bits hold a bin of a shard, 42 a shard, and two the level.
        sequence = F.shiftleft(F.lit(level).cast("long"), 61) + F.shiftleft(F.col("shard").cast("long"), 20) + F.col("bin")
        out.append(placed.filter(~F.col("again")).select(*columns, sequence.alias("sequence_id"), "offset"))
        rest, level = placed.filter("again").select(*columns), level + 1
        n = rest.count() if not single else 0
    result = out[0]
    for part in out[1:]:
        result = result.unionByName(part)
    return result
