"""Repeated passages by longest previous factors over sparse suffix order.

A byte is removed if a string of ``length`` bytes that covers it also occurs at
an earlier place (or, on request, at any other): if the longest previous factor
at the string's start has ``length`` bytes or more. In suffix order the previous
and the next suffix of smaller position agree with a suffix on that factor, or on
less; of the two the longer one is it.

Suffixes are sorted only around anchors: of all grams of GRAM bytes inside a
string of ``length`` bytes, the one of the smallest hash. Equal strings have equal
anchors at equal places, so they meet in the group of their anchor's hash. Within
a group the texts right of the anchors are sorted as suffixes and the texts left
of them as reversed prefixes, with the lengths on which neighbours agree. These
two orders give the suffix order at each distance to the anchor, and how far
neighbours in it agree.

Anchors that occur once are dropped before any text moves. Anchors that occur
more than HOT times are not sorted in one task: their strings are hashed and
counted by groupings that pre-aggregate.

Ids are whole numbers, or texts that name one. Null texts are empty, and texts
below ``length`` bytes lose nothing; a single text must fit in a task. Rows may
repeat, ids be missing and other columns have any name; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.llm.texts import PIECE, mixed, powers
from balcao.session import written

LENGTH = 200
GRAM = 64
#: More places of one anchor than this are counted instead of sorted.
HOT = 50_000
#: Rows that are sorted at once; a group is never divided.
CHUNK = 20_000
_BASE = 0x9E3779B97F4A7C15
_PLACE_BITS = 21


class Anchors:
    """Anchors of one text: hash, place, and the first and last start of the strings they stand for."""

    def __init__(self, text: bytes, length: int = LENGTH, gram: int = GRAM):
        parts = []
        data = np.frombuffer(text, np.uint8)
        for at in range(0, max(0, len(data) - length + 1), PIECE):
            parts.append(_piece(data[at : at + PIECE + length - 1], at, length, gram))
        none = (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
        self.hashes, self.places, self.first, self.last = (np.concatenate(c) for c in zip(none, *parts))


def _piece(data: np.ndarray, at: int, length: int, gram: int) -> tuple[np.ndarray, ...]:
    grams = gram_hashes(data, gram)
    span = length - gram + 1
    # The place in the low bits lets the leftmost of equal hashes win.
    low = np.uint64((1 << _PLACE_BITS) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    places = (least & low).astype(np.int64)
    begins = np.flatnonzero(np.diff(places, prepend=-1))
    ends = np.append(begins[1:], len(places)) - 1
    places = places[begins]
    return grams[places], places + at, begins + at, ends + at


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of each run of ``gram`` bytes."""
    forward, back = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * forward[: len(data)], out=total[1:])
    n = len(data) - gram + 1
    return mixed((total[gram:] - total[:n]) * back[:n])


_TABLES: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES or len(_TABLES[0]) < n:
        size = max(n, PIECE + 4 * LENGTH)
        _TABLES[:] = [powers(_BASE, size), powers(pow(_BASE, -1, 1 << 64), size)]
    return _TABLES[0], _TABLES[1]


def _anchor_hashes(text: Column, length: int) -> Column:
    @F.arrow_udf("array<bigint>")
    def hashes(texts: pa.Array) -> pa.Array:
        parts = [Anchors(t.as_py().encode("utf-8", "surrogatepass"), length).hashes.view(np.int64) for t in texts]
        ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else [], pa.int64()))

    return hashes(text)


def _cut_out(length: int, hot: bool):
    """From ``text, first_id, text_id`` and its repeated ``hashes``: the surroundings of each anchor, or, of hot ones, the hash of every string."""
    left, right = length - GRAM, length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for text, first_id, text_id, wanted in zip(*(batch.column(i) for i in range(4))):
                data = text.as_py().encode("utf-8", "surrogatepass")
                anchors = Anchors(data, length)
                for i in np.flatnonzero(np.isin(anchors.hashes.view(np.int64), wanted.values.to_numpy())):
                    place, begin, end = int(anchors.places[i]), int(anchors.first[i]), int(anchors.last[i])
                    who = first_id.as_py(), text_id.as_py()
                    if hot:
                        rows += [
                            (hashlib.blake2b(data[s : s + length], digest_size=16).digest(), *who, s) for s in range(begin, end + 1)
                        ]
                        held += 64 * (end + 1 - begin)
                    else:
                        around = data[max(0, place - left) : place].rjust(left, b"\0") + data[place : place + right].ljust(right, b"\0")
                        rows.append((int(anchors.hashes[i].view(np.int64)), *who, place, place - end, place - begin, around))
                        held += len(around)
                if held > 1 << 23:
                    yield _batch(rows, hot)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, hot)

    return cut


_STRINGS = pa.schema([("string", pa.binary()), ("first_id", pa.int64()), ("text_id", pa.int64()), ("start", pa.int64())])
_AROUND = pa.schema([
    ("anchor", pa.int64()), ("first_id", pa.int64()), ("text_id", pa.int64()), ("place", pa.int64()),
    ("near", pa.int32()), ("far", pa.int32()), ("around", pa.binary()),
])
_RUNS = pa.schema([("text_id", pa.int64()), ("first_start", pa.int64()), ("last_start", pa.int64())])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "bigint", pa.int32(): "int", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _batch(rows: list[tuple], hot: bool) -> pa.RecordBatch:
    schema = _STRINGS if hot else _AROUND
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _order(group: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows by group and bytes, and on how many bytes each agrees with the row before; -1 for another group."""
    width = -(-texts.shape[1] // 8) * 8
    padded = np.zeros((len(texts), width), np.uint8)
    padded[:, : texts.shape[1]] = texts
    columns = padded.view(">u8").astype(np.uint64)
    order = np.lexsort((*columns.T[::-1], group))
    ranked = texts[order]
    differ = ranked[1:] != ranked[:-1]
    agreed = np.where(differ.any(axis=1), differ.argmax(axis=1), texts.shape[1])
    agreed[group[order][1:] != group[order][:-1]] = -1
    return order, np.concatenate([[-1], agreed])


class _Least:
    """The least of any range of an array, from the least of all ranges of powers of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 * (step := 1 << len(self.levels) - 1) <= len(values):
            below = self.levels[-1]
            self.levels.append(np.minimum(below[: len(below) - step], below[step:]))

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of places ``first`` to ``last``, both included."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for k in np.unique(level):
            here = np.flatnonzero(level == k)
            values = self.levels[k]
            out[here] = np.minimum(values[first[here]], values[last[here] - (1 << int(k)) + 1])
        return out


def _smaller_before(rank: np.ndarray, agreed: np.ndarray, length: int) -> np.ndarray:
    """By place in suffix order: on how many bytes a suffix agrees with the nearest before it of smaller rank.

    ``agreed`` tells it of the one right before. Every suffix follows the pointers of
    those it passes, all at once; one that agrees on less than ``length`` stops, as
    no factor of that length is left.
    """
    pointer, common = np.arange(len(rank)) - 1, agreed.copy()
    going = np.flatnonzero(common >= length)
    while len(going):
        going = going[rank[pointer[going]] > rank[going]]
        at = pointer[going]
        common[going] = np.minimum(common[going], common[at])
        pointer[going] = pointer[at]
        going = going[common[going] >= length]
    return np.where(common >= length, common, 0)


def factors(group: np.ndarray, around: np.ndarray, near: np.ndarray, far: np.ndarray, rank: np.ndarray, length: int, later: bool = False) -> np.ndarray:
    """By row and distance to the anchor: the longest previous factor of the suffix that starts there; 0 if below ``length``.

    ``rank`` orders rows by position; with ``later`` the longest next factor, of
    larger positions, counts as well. Suffixes that start ``distance`` before
    their anchors are in suffix order if those with the same bytes up to the anchor
    are in the order of what follows it; others agree on less than ``length``, and
    their order plays no part. The previous and the next of smaller position in
    that order give the factor. It is cut where the text kept around the anchor ends.
    """
    left = length - GRAM
    found = np.zeros((len(group), left + 1), np.int64)
    by_right, right_agreed = _order(group, around[:, left:])
    by_left, left_agreed = _order(group, around[:, :left][:, ::-1])
    right_place, left_class = np.empty(len(group), np.int64), np.empty(len(group), np.int64)
    right_place[by_right] = np.arange(len(group))
    least = _Least(right_agreed)
    for distance in range(int(near.min(initial=left + 1)), min(left, int(far.max(initial=-1))) + 1):
        left_class[by_left] = np.cumsum(left_agreed < distance)
        rows = np.flatnonzero((near <= distance) & (distance <= far))
        rows = rows[np.argsort(left_class[rows] * len(group) + right_place[rows])]
        same = np.flatnonzero(left_class[rows][1:] == left_class[rows][:-1])
        agreed = np.zeros(len(rows), np.int64)  # with the row before
        agreed[same + 1] = distance + least.between(right_place[rows[same]] + 1, right_place[rows[same + 1]])
        alone = agreed < length
        alone[:-1] &= agreed[1:] < length
        rows, agreed = rows[~alone], agreed[~alone]
        if not len(rows):
            continue
        behind = np.append(agreed[1:], 0)[::-1]
        for own in (rank[rows], -rank[rows])[: 1 + later]:
            previous = _smaller_before(own, agreed, length)
            following = _smaller_before(own[::-1], behind, length)[::-1]
            found[rows, distance] = np.maximum(found[rows, distance], np.maximum(previous, following))
    return found


def _sorted_groups(length: int, keep_first: bool):
    def told(rows: pa.Table) -> pa.RecordBatch:
        anchor, first_id, text_id, place = (rows.column(c).to_numpy() for c in ("anchor", "first_id", "text_id", "place"))
        low = rows.column("near").to_numpy()
        order = np.lexsort((low, place, text_id, first_id, anchor))
        fresh = np.ones(len(order), bool)  # a row repeated as a whole is one text
        fresh[1:] = np.any([np.diff(c[order]) != 0 for c in (anchor, text_id, place, low)], axis=0)
        at = order[fresh]
        around = np.frombuffer(b"".join(rows.column("around").to_pylist()), np.uint8).reshape(len(order), -1)[at]
        near, far = (rows.column(c).to_numpy()[at] for c in ("near", "far"))
        found = factors(anchor[at], around, near, far, np.arange(len(at)), length, later=not keep_first) >= length
        edge = np.diff(found.astype(np.int8), axis=1, prepend=0, append=0)
        row, low = np.nonzero(edge == 1)
        high = np.nonzero(edge == -1)[1] - 1
        return pa.RecordBatch.from_arrays(
            [pa.array(text_id[at][row]), pa.array(place[at][row] - high), pa.array(place[at][row] - low)], schema=_RUNS
        )

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < CHUNK:
                continue
            rows = pa.Table.from_batches(held)
            anchor = rows.column("anchor").to_numpy()
            cut = int(np.searchsorted(anchor, anchor[-1]))  # the last group may go on
            if cut:
                yield told(rows.slice(0, cut))
                held = rows.slice(cut).to_batches()
        if held and sum(map(len, held)):
            yield told(pa.Table.from_batches(held))

    return sort


def _without(text: Column, runs: Column, length: int) -> Column:
    """Removed bytes, maximal removed runs, digest and text of what is left; broken characters are replaced."""
    @F.arrow_udf("struct<n_removed:bigint,n_spans:bigint,kept_sha256:string,kept_text:string>")
    def cut(texts: pa.Array, starts: pa.Array) -> pa.Array:
        rows = []
        for text, own in zip(texts, starts):
            data = text.as_py().encode("utf-8", "surrogatepass")
            kept, done, spans = [], 0, 0
            for one in sorted((r["first_start"], r["last_start"]) for r in own.as_py()):
                if one[0] > done or not spans:
                    kept.append(data[done : one[0]])
                    spans += 1
                    done = one[1] + length
                else:
                    done = max(done, one[1] + length)
            left = b"".join([*kept, data[done:]])
            rows.append((len(data) - len(left), spans, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "replace")))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        columns = list(zip(*rows)) or [()] * 4
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["n_removed", "n_spans", "kept_sha256", "kept_text"]
        )

    return cut(text, runs)


def repeated_runs(docs: DataFrame, length: int, keep_first: bool, hot: int) -> tuple[DataFrame, DataFrame]:
    """The texts by row, and the texts that lose some bytes with what is left of them.

    Texts that occur as a whole more than once are compared once, under the
    smallest id they have.
    """
    text_id, digest = F.xxhash64("text"), F.unhex(F.sha2("text", 256))
    base = written(
        docs.select(
            "doc_id", text_id.alias("text_id"), digest.alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"),
            _anchor_hashes(F.col("text"), length).alias("hashes"),
        ),
        "anchors",
    )
    texts = written(
        base.groupBy("text_id", "digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")), "digests"
    )
    places = base.select("text_id", F.posexplode("hashes").alias("i", "anchor"))
    place = F.xxhash64("text_id", "i")
    counts = places.groupBy("anchor").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.count(F.lit(1)).alias("n"))
    repeated = written(counts.where("a <> b").select("anchor", (F.col("n") > hot).alias("hot")), "repeated")
    by_text = places.select("text_id", "anchor").join(repeated, "anchor").groupBy("text_id").agg(
        F.collect_set(F.when(~F.col("hot"), F.col("anchor"))).alias("anchors"),
        F.collect_set(F.when(F.col("hot"), F.col("anchor"))).alias("hot_anchors"),
    )
    wanted = written(by_text.join(texts.select("text_id", "first_id"), "text_id"), "wanted")
    same = (F.col("t.text_id") == F.col("w.text_id")) & F.col("t.doc_id").eqNullSafe(F.col("w.first_id"))
    candidates = written(
        docs.withColumn("text_id", text_id).alias("t").join(wanted.alias("w"), same)
        .select("t.text", "w.first_id", "w.text_id", digest.alias("digest"), "anchors", "hot_anchors"),
        "candidates",
    )
    around = candidates.where(F.size("anchors") > 0).select("text", "first_id", "text_id", "anchors").mapInArrow(
        _cut_out(length, False), _ddl(_AROUND)
    )
    runs = around.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_sorted_groups(length, keep_first), _ddl(_RUNS))
    if not repeated.where("hot").isEmpty():
        strings = candidates.where(F.size("hot_anchors") > 0).select("text", "first_id", "text_id", "hot_anchors").mapInArrow(
            _cut_out(length, True), _ddl(_STRINGS)
        ).distinct()
        strings = written(strings.withColumn("at", F.struct("first_id", "text_id", "start")), "strings")
        least = written(
            strings.groupBy("string").agg(F.min("at").alias("least"), F.max("at").alias("most")).where("least <> most"), "equal"
        )
        again = strings.join(least, "string")
        if keep_first:
            again = again.where(F.col("at") != F.col("least"))
        runs = runs.unionByName(again.select("text_id", F.col("start").alias("first_start"), F.col("start").alias("last_start")))
    starts = written(runs.groupBy("text_id").agg(F.collect_list(F.struct("first_start", "last_start")).alias("runs")), "starts")
    cut = candidates.dropDuplicates(["text_id", "digest"]).join(starts, "text_id").select(
        "text_id", "digest", _without(F.col("text"), F.col("runs"), length).alias("cut")
    )
    return base.drop("hashes").join(texts, ["text_id", "digest"]), written(cut.select("text_id", "digest", "cut.*"), "cut")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, keep_first: bool = True, hot: int = HOT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept_text (null if nothing was removed).

    The first place of a passage, by id and place in the text, stays; with
    ``keep_first=False`` no place does. Null is an empty text, and texts below
    ``length`` bytes lose nothing. Of texts that are equal as a whole the
    smallest id is the first; rows without an id come after it, and rows
    repeated under one id are first together.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    whole, cut = repeated_runs(rows, length, keep_first, hot)
    copy = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    if keep_first:
        copy = copy & ~F.col("doc_id").eqNullSafe(F.col("first_id"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return whole.join(cut, ["text_id", "digest"], "left").select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, nothing).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest")))).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
    )
