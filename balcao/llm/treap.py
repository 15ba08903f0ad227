"""Ranked lexical search by a K2-treap over the term-document grid.

The index has one row per shard of documents: a grid of the shard's terms (rows,
the most frequent first) by its documents (columns, in order of length), and in
each cell the impact of the term on the document's score. The grid is a
quadtree; every node of it holds the largest impact of its square with its
place, taken out of the squares below, so each impact is stored once. Squares
without impacts have no node. Levels are stored as child masks, falls of the
maximum from parent to child, and steps between places, compressed.

A query follows one row path per term, all of them together down ranges of
documents. A range's bound is the best score found in it so far plus, per term,
the maximum of the node that its path has reached; ranges are opened best first
until none can beat the k-th document. Results are exact: every document is
ranked, and bounds only tell which are not opened.

Terms are compared as 64-bit hashes. Null and empty texts have no term and are
never found; documents of equal ids are ranked each by itself; a null id ranks
before others at equal scores; empty tables give no row. Texts are indexed
whole; one text must fit in a task.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from balcao.llm.texts import ALNUM, Words, groups, utf8
from balcao.session import written

#: A shard ends with the document that reaches either.
SHARD_BYTES = 8 << 20
SHARD_DOCS = 4096
#: Queries that are held at once.
BLOCK = 512
#: Ranges opened together.
WIDTH = 32
_POPULATION = np.array([bin(i).count("1") for i in range(16)], np.int64)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (10**9 * tf) // (1000 * tf + 12 * m)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits moved apart, to every second place."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def _gathered(x: np.ndarray) -> np.ndarray:
    """Every second bit moved together."""
    x = x & np.uint64(0x5555555555555555)
    for shift, mask in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF), (8, 0x0000FFFF0000FFFF), (16, 0x00000000FFFFFFFF)):
        x = (x | (x >> np.uint64(shift))) & np.uint64(mask)
    return x.astype(np.int64)


def grown(rows: np.ndarray, cols: np.ndarray, values: np.ndarray) -> bytes:
    """The treap of a grid's cells, as compressed levels."""
    height = max(1, int(max(rows.max(), cols.max())).bit_length())
    code = _spread(rows) << np.uint64(1) | _spread(cols)
    order = np.argsort(code)
    code, values = code[order], values[order]
    cells, tops, places = [], [], []
    for level in range(height + 1):
        if not len(code):
            break
        cell = code >> np.uint64(2 * (height - level))
        starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        top = np.maximum.reduceat(values, starts)
        which = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(code))))
        hit = np.flatnonzero(values == top[which])
        hit = hit[np.concatenate([[True], which[hit][1:] != which[hit][:-1]])]
        cells.append(cell[starts])
        tops.append(top)
        places.append(code[hit])
        left = np.ones(len(code), bool)
        left[hit] = False
        code, values = code[left], values[left]
    masks, falls = [], [tops[0]]
    for level, cell in enumerate(cells):
        if level + 1 == len(cells):
            masks.append(np.zeros(len(cell), np.uint8))
            continue
        child = cells[level + 1]
        parent = np.searchsorted(cell, child >> np.uint64(2))
        bits = np.left_shift(1, (child & np.uint64(3)).astype(np.int64))
        masks.append(np.bincount(parent, weights=bits, minlength=len(cell)).astype(np.uint8))
        falls.append(tops[level][parent] - tops[level + 1])
    head = np.array([height, len(cells), *map(len, cells)], np.int64)
    steps = np.concatenate([np.diff(p, prepend=np.uint64(0)) for p in places])
    raw = b"".join([head.tobytes(), np.concatenate(masks).tobytes(), np.concatenate(falls).astype(np.uint32).tobytes(), steps.tobytes()])
    return zstandard.ZstdCompressor(level=1).compress(raw)


class Treap:
    """A treap to search: per node its child mask, first child, maximum and the place of that; the last node is none."""

    def __init__(self, data: bytes):
        raw = zstandard.ZstdDecompressor().decompress(data)
        self.height, n_levels = np.frombuffer(raw, np.int64, 2).tolist()
        sizes = np.frombuffer(raw, np.int64, n_levels, 16)
        total, at = int(sizes.sum()), 16 + 8 * n_levels
        masks = np.frombuffer(raw, np.uint8, total, at)
        falls = np.frombuffer(raw, np.uint32, total, at + total).astype(np.int64)
        steps = np.frombuffer(raw, np.uint64, total, at + 5 * total)
        values, places = falls.copy(), steps.copy()
        begin = 0
        for size, above in zip(sizes.tolist(), [0, *sizes.tolist()]):
            here = slice(begin, begin + size)
            places[here] = np.cumsum(steps[here], dtype=np.uint64)
            if begin:
                up = slice(begin - above, begin)
                values[here] = np.repeat(values[up], _POPULATION[masks[up]]) - falls[here]
            begin += size
        children = _POPULATION[masks]
        self.masks = np.append(masks.astype(np.int64), 0)
        self.first = np.append(1 + np.cumsum(children) - children, 0)
        self.values = np.append(values, 0)
        self.rows = np.append(_gathered(places >> np.uint64(1)), -1)
        self.cols = np.append(_gathered(places), 0)

    def best(self, rows: np.ndarray, weights: np.ndarray, k: int, floor: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(columns, scores) of the documents that can be among the best ``k``, all with scores of ``floor`` or more."""
        found = np.zeros(width, np.int64)
        level, block = np.zeros(1, np.int64), np.zeros(1, np.int64)
        nodes = np.zeros((1, len(rows)), np.int64)
        hit = rows == self.rows[0]
        found[self.cols[0]] += int((weights * self.values[0])[hit].sum())
        bound = np.array([int(weights.sum()) * int(self.values[0]) + int(found.max())])
        done: list[np.ndarray] = [np.zeros(0, np.int64)]
        while True:
            keep = bound >= floor
            if not keep.all():
                level, block, nodes, bound = level[keep], block[keep], nodes[keep], bound[keep]
            if not len(bound):
                break
            if len(bound) > WIDTH:
                order = np.argpartition(-bound, WIDTH)
                now, later = order[:WIDTH], order[WIDTH:]
            else:
                now, later = np.arange(len(bound)), np.zeros(0, np.int64)
            shift = self.height - 1 - level[now]
            mask = self.masks[nodes[now]][:, None, :]
            quarter = 2 * ((rows >> shift[:, None]) & 1)[:, None, :] + np.array([[0], [1]])
            child = np.where((mask >> quarter) & 1 == 1, self.first[nodes[now]][:, None, :] + _POPULATION[mask & ((1 << quarter) - 1)], -1)
            child = child.reshape(-1, len(rows))
            which, term = np.nonzero((child >= 0) & (self.rows[child] == rows))
            if len(which):
                hit = child[which, term]
                np.add.at(found, self.cols[hit], self.values[hit] * weights[term])
            child[self.masks[child] == 0] = -1  # nothing is left below
            rest = (self.values[child] * weights).sum(1)
            lo = (np.repeat(2 * block[now], 2) + np.tile([0, 1], len(now))) << np.repeat(shift, 2)
            hi = np.minimum(lo + (1 << np.repeat(shift, 2)), width)
            there = lo < width
            lo, hi, rest, child = lo[there], hi[there], rest[there], child[there]
            top = np.maximum.reduceat(np.append(found, 0), np.column_stack([lo, hi]).reshape(-1))[::2]
            over = rest == 0
            ended = [np.arange(a, b) for a, b, t in zip(lo[over].tolist(), hi[over].tolist(), top[over].tolist()) if t >= floor]
            if ended:
                done.append(np.concatenate(ended))
                scores = found[np.concatenate(done)]
                if len(scores) >= k:
                    floor = max(floor, int(np.partition(scores, len(scores) - k)[-k]))
            open_ = ~over
            at = np.repeat(level[now] + 1, 2)[there][open_]
            level, block = np.concatenate([level[later], at]), np.concatenate([block[later], lo[open_] >> (self.height - at)])
            nodes, bound = np.concatenate([nodes[later], child[open_]]), np.concatenate([bound[later], (rest + top)[open_]])
        cols = np.concatenate(done)
        cols = cols[found[cols] >= floor]
        return cols, found[cols]


def _sizes(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and terms of all documents with repeats."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_docs = n_terms = 0
            for lo, hi in groups(batch.column(0)):
                data, at = utf8(batch.column(0).slice(lo, hi - lo))
                inside = ALNUM.table[data] != 0
                begins = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
                own = np.diff(np.searchsorted(begins, at))
                n_docs, n_terms = n_docs + int((own > 0).sum()), n_terms + int(own.sum())
            yield pa.RecordBatch.from_pydict({"n_docs": pa.array([n_docs], pa.int64()), "n_terms": pa.array([n_terms], pa.int64())})

    counted = docs.select("text").mapInArrow(count, "n_docs long, n_terms long")
    row = counted.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    return row[0] or 0, row[1] or 0


def _postings(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, tf) of all terms in each text, and the terms of each text with repeats."""
    words = Words(texts, ALNUM)
    n = np.diff(words.first)
    terms, code = np.unique(words.hashes, return_inverse=True)
    pairs, tf = np.unique(np.repeat(np.arange(len(n)), n) * len(terms) + code, return_counts=True)
    return pairs // max(1, len(terms)), terms[pairs % max(1, len(terms))], tf, n


class _Shard:
    """Documents gathered until they make a shard."""

    def __init__(self, n_docs: int, n_terms: int):
        self.total = n_docs, n_terms
        self.clear()

    def clear(self) -> None:
        self.ids, self.parts, self.bytes, self.docs = [], [], 0, 0

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        doc, term, tf, n = _postings(texts)
        self.ids.append(ids)
        self.parts.append((doc + self.docs, term, tf, n))
        self.docs += len(ids)
        self.bytes += texts.nbytes

    def row(self, kind: pa.DataType) -> pa.RecordBatch | None:
        doc, term, tf, n = (np.concatenate(c) for c in zip(*self.parts))
        if not len(doc):
            return None
        n_docs, n_terms = self.total
        m = 100 - 25 + (25 * n * n_docs) // n_terms
        order = np.argsort(n, kind="stable")
        order = order[n[order] > 0]
        column = np.zeros(len(n), np.int64)
        column[order] = np.arange(len(order))
        terms, code, df = np.unique(term, return_inverse=True, return_counts=True)
        frequent = np.argsort(-df, kind="stable")
        place = np.empty(len(terms), np.int64)
        place[frequent] = np.arange(len(terms))
        tree = grown(place[code], column[doc], impact(tf, m[doc]))
        ids = pa.concat_arrays(self.ids).take(pa.array(order))
        held = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        raw = [terms.astype("<u8").tobytes(), df.astype("<u4").tobytes(), place.astype("<u4").tobytes()]
        return pa.RecordBatch.from_arrays(
            [held.cast(pa.list_(kind)), *[pa.array([r], pa.binary()) for r in (*raw, tree)]], ["ids", "terms", "dfs", "places", "tree"]
        )


def index(docs: DataFrame) -> tuple[DataFrame, int]:
    """The written index of all of ``docs`` and the number of documents that have a term.

    One row per shard: ids by column, the terms' hashes in order with their documents' number and row, the treap.
    """
    n_docs, n_terms = _sizes(docs)
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("ids", T.ArrayType(kind)), *[T.StructField(c, T.BinaryType()) for c in ("terms", "dfs", "places", "tree")]
    ])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(n_docs, n_terms)
        for batch in batches:
            for lo, hi in groups(batch.column("text"), SHARD_BYTES // 4):
                for a in range(lo, hi, SHARD_DOCS // 4):
                    part = batch.slice(a, min(hi, a + SHARD_DOCS // 4) - a)
                    shard.add(part.column("doc_id"), part.column("text"))
                    if shard.bytes >= SHARD_BYTES or shard.docs >= SHARD_DOCS:
                        if (row := shard.row(part.column("doc_id").type)) is not None:
                            yield row
                        shard.clear()
        if shard.docs and (row := shard.row(shard.ids[0].type)) is not None:
            yield row

    return written(docs.select("doc_id", "text").mapInArrow(build, schema), "treap"), n_docs


def _queries(items: DataFrame) -> DataFrame:
    """item_id with its distinct terms and how often each occurs."""
    schema = T.StructType([items.schema["item_id"], T.StructField("terms", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words = Words(batch.column("text"), ALNUM)
            split = [np.unique(words.hashes[a:b], return_counts=True) for a, b in zip(words.first[:-1], words.first[1:])]
            yield pa.RecordBatch.from_arrays([
                batch.column("item_id"), pa.array([t.view(np.int64) for t, _ in split], pa.list_(pa.int64())),
                pa.array([c for _, c in split], pa.list_(pa.int64())),
            ], schema.names)

    return items.select("item_id", "text").mapInArrow(read, schema)


def _frequencies(built: DataFrame, terms: np.ndarray) -> dict[int, int]:
    """How many documents hold each of the block's ``terms`` (sorted), from the shards' own counts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                own = np.frombuffer(batch.column(0)[i].as_py(), "<u8")
                at = np.minimum(np.searchsorted(own, terms), len(own) - 1)
                total += np.where(own[at] == terms, np.frombuffer(batch.column(1)[i].as_py(), "<u4")[at], 0)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"which": pa.array(some, pa.int64()), "df": pa.array(total[some], pa.int64())})

    summed = built.select("terms", "dfs").mapInArrow(count, "which long, df long").groupBy("which").agg(F.sum("df").alias("df"))
    return {int(terms[r["which"]]): r["df"] for r in summed.collect()}


def _searched(built: DataFrame, block: list[tuple], k: int, schema: T.StructType) -> DataFrame:
    """The best documents of every task for each query of the block: (place in the block, doc_id, score)."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        best: list[list[tuple]] = [[] for _ in block]
        for batch in batches:
            for i in range(batch.num_rows):
                own = np.frombuffer(batch.column("terms")[i].as_py(), "<u8")
                places = np.frombuffer(batch.column("places")[i].as_py(), "<u4")
                ids = batch.column("ids")[i].values
                tree = Treap(batch.column("tree")[i].as_py())
                for number, (terms, weights) in enumerate(block):
                    at = np.minimum(np.searchsorted(own, terms), len(own) - 1)
                    here = own[at] == terms
                    if not here.any():
                        continue
                    floor = best[number][-1][0] if len(best[number]) == k else 1
                    cols, scores = tree.best(places[at[here]].astype(np.int64), weights[here], k, floor, len(ids))
                    if len(cols):
                        told = zip(scores.tolist(), ids.take(pa.array(cols)).to_pylist())
                        best[number] = heapq.nsmallest(k, [*best[number], *told], key=lambda s: (-s[0], s[1] is not None, s[1]))
        rows = [(number, d, s) for number, found in enumerate(best) for s, d in found]
        arrow = to_arrow_schema(schema)
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], schema=arrow)

    return built.mapInArrow(find, schema)


def search(built: DataFrame, n_docs: int, items: DataFrame, k: int) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``k`` best documents; blocks of items go over the whole index."""
    kind = built.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("number", T.LongType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())])
    told = T.StructType([T.StructField("number", T.LongType()), items.schema["item_id"]])
    queries = written(_queries(items), "treap-queries")
    lines, out = queries.toLocalIterator(), []
    while rows := list(islice(lines, BLOCK)):
        terms = np.unique(np.array([t for r in rows for t in r["terms"]], np.int64).view(np.uint64))
        df = _frequencies(built, terms) if len(terms) else {}
        block = []
        for r in rows:
            own = np.array(r["terms"], np.int64).view(np.uint64)
            weights = np.array([weight(n_docs, df[int(t)]) * c if int(t) in df else 0 for t, c in zip(own, r["times"])], np.int64)
            block.append((own[weights > 0], weights[weights > 0]))
        found = _searched(built, block, k, schema)
        order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = built.sparkSession.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], told)
        # At most BLOCK names.
        out.append(ranked.join(F.broadcast(names), "number").select("item_id", "rank", "doc_id", "score"))
    result = out[0] if out else built.sparkSession.createDataFrame([], T.StructType([
        items.schema["item_id"], T.StructField("rank", T.IntegerType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())
    ]))
    for part in out[1:]:
        result = result.unionByName(part)
    return result
