"""Benchmark decontamination by winnowing.

A document is contaminated by the words it shares with benchmark items. Of every
WINDOW consecutive words the smallest hash of K consecutive ones is kept as a
fingerprint. The choice depends on the words alone, so a window of an item and
its copy in a document keep the same fingerprint at the same place: any shared
span of WINDOW words or more is found. A fingerprint of a document is extended to
each whole window that keeps it; those are joined with the items' windows by the
fingerprint, its place and a 128-bit digest of all the words.

Items of fewer than WINDOW words are one window each. For every such length that
occurs, all runs of that many words of a document are fingerprints.

Before the join, documents drop fingerprints, and then windows, whose bit is not
set in maps made from the benchmark, of MAP_SHARE bits per window up to MOST_BITS.
The maps drop nothing that the join would find.

Null and empty texts have no words, on both sides; an item without words is in no
document, and one without an id hits but names no item. Texts are read whole, one
at a time beyond a few megabytes. Documents that share an id, or have none, each
have the hits of their own text. Other columns are kept, whatever their names.
Empty tables give no rows, and an empty benchmark no hits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.llm.texts import ALNUM, Words, give_back, groups, mixed, rolled, utf8
from balcao.session import written

WINDOW = 13
K = 9
#: Bits of the maps per window of the benchmark, and at least and at most.
MAP_SHARE, LEAST_BITS, MOST_BITS = 64, 1 << 16, 1 << 27


def _short(hashes: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of the runs of ``n`` words that short items are found by."""
    return mixed(rolled(hashes, n) + np.uint64(n))


def chosen(grams: np.ndarray, window: int = WINDOW, k: int = K) -> np.ndarray:
    """Whether each gram is the smallest of any ``window - k + 1`` consecutive ones; ties all count."""
    span = window - k + 1
    if len(grams) < span:
        return np.zeros(len(grams), bool)
    n = len(grams) - span + 1
    least = grams[:n].copy()
    for i in range(1, span):
        np.minimum(least, grams[i : n + i], out=least)
    kept = np.zeros(len(grams), bool)
    for i in range(span):
        kept[i : n + i] |= grams[i : n + i] == least
    return kept


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _own_words(words: Words, a: int, b: int) -> list[bytes]:
    """The folded words ``a`` to ``b`` (exclusive)."""
    if b <= a:
        return []
    begin = words.starts[a]
    folded = ALNUM.table[words.data[begin : words.ends[b - 1]]].tobytes()
    return [folded[s:e] for s, e in zip((words.starts[a:b] - begin).tolist(), (words.ends[a:b] - begin).tolist())]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per window of an item: item, number of words, fingerprint, its place in the window, hash and digest of the whole."""
    for batch in batches:
        for first, last in groups(batch.column(1)):
            words = Words(batch.column(1).slice(first, last - first), ALNUM)
            rows = []
            for i in range(last - first):
                a, b = words.first[i], words.first[i + 1]
                own, hashes = _own_words(words, a, b), words.hashes[a:b]
                size = min(WINDOW, len(own))
                for at in range(len(own) - size + 1 if size else 0):
                    if size < WINDOW:
                        place, print_ = 0, _short(hashes, size)[0]
                        whole = print_
                    else:
                        grams = rolled(hashes[at : at + size], K)
                        place = int(np.argmin(grams))
                        print_ = grams[place]
                        whole = rolled(hashes[at : at + size], size)[0]
                    rows.append((batch.column(0)[first + i].as_py(), size, int(print_.view(np.int64)), place, int(whole.view(np.int64)), _digest(own[at : at + size])))
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()))],
                ["item", "size", "print", "place", "whole", "digest"],
            )


def benchmark_windows(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """The windows of all items, a window once per item that it occurs in."""
    rows = benchmark.select(F.col(key).cast("string").alias("item"), F.col(text).alias("text"))
    windows = rows.mapInArrow(_windows, "item string, size int, print bigint, place int, whole bigint, digest binary")
    return written(windows.distinct(), "windows")


def _map_of(windows: DataFrame, column: str, bits: int) -> np.ndarray:
    """The bits of all values of ``column``, which come to the driver in rows of 4 KB."""
    bit = F.col(column).bitwiseAND(F.lit(bits - 1)) + 1
    rows = windows.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    ).collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        at = (r.bucket - 1) * len(r.bits)
        out[at : at + len(r.bits)] = np.frombuffer(bytes(r.bits), np.uint8)
    return np.unpackbits(out, bitorder="little").astype(bool)


def _candidates(text: Column, bits: np.ndarray, whole_bits: np.ndarray, lengths: list[int]) -> Column:
    """Struct of n_words and the whole windows around fingerprints that the maps let through."""
    packed, packed_whole = np.packbits(bits), np.packbits(whole_bits)
    mask = np.uint64(len(bits) - 1)

    @F.arrow_udf("struct<n_words:bigint,found:array<struct<print:bigint,place:int,digest:binary,start:int,size:int>>>")
    def candidates(texts: pa.Array) -> pa.Array:
        there, whole_there = np.unpackbits(packed).astype(bool), np.unpackbits(packed_whole).astype(bool)
        n_words, found = [], []
        for first, last in groups(texts):
            words = Words(texts.slice(first, last - first), ALNUM)
            grams, inside = words.grams(K)
            # A choice across two texts only adds fingerprints that lie within one.
            prints = np.flatnonzero(inside & chosen(grams) & there[grams & mask])
            # Every window that has the fingerprint: it may begin WINDOW - K words before, or at it.
            starts = np.unique((prints[:, None] - np.arange(WINDOW - K + 1)).ravel())
            wholes, inside = words.grams(WINDOW)
            starts = starts[(starts >= 0) & (starts < len(wholes))]
            starts = starts[inside[starts] & whole_there[wholes[starts] & mask]]
            around = grams[starts[:, None] + np.arange(WINDOW - K + 1)] if len(starts) else np.zeros((0, 1), np.uint64)
            place = around.argmin(1) if len(starts) else np.zeros(0, np.int64)
            own = [(starts, np.full(len(starts), WINDOW), around[np.arange(len(starts)), place], place)]
            for n in lengths:
                short, inside = words.grams(n)
                short = mixed(short + np.uint64(n))
                at = np.flatnonzero(inside & there[short & mask])
                own.append((at, np.full(len(at), n), short[at], np.zeros(len(at), np.int64)))
            at, size, print_, place = (np.concatenate(c) for c in zip(*own))
            text_of = np.searchsorted(words.first, at, "right") - 1
            by_text: list[list[dict]] = [[] for _ in range(last - first)]
            for i, a, n, p, o in zip(text_of.tolist(), at.tolist(), size.tolist(), print_.view(np.int64).tolist(), place.tolist()):
                by_text[i].append({
                    "print": p, "place": o, "digest": _digest(_own_words(words, a, a + n)), "start": a - int(words.first[i]), "size": n,
                })
            n_words += np.diff(words.first).tolist()
            found += by_text
        give_back()
        kind = pa.list_(pa.struct([("print", pa.int64()), ("place", pa.int32()), ("digest", pa.binary()), ("start", pa.int32()), ("size", pa.int32())]))
        return pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), pa.array(found, kind)], ["n_words", "found"])

    return candidates(text)


def _covered(spans: Column) -> Column:
    """Words inside any of the spans (start, size)."""
    def add(state: Column, span: Column) -> Column:
        end = span["start"] + span["size"]
        fresh = F.greatest(F.lit(0), end - F.greatest(state["end"], span["start"]))
        return F.struct(F.greatest(state["end"], end).alias("end"), (state["n"] + fresh).alias("n"))

    empty = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(F.array_sort(spans), empty, add, lambda state: state["n"])


def overlaps(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Struct ``row`` of all columns of ``docs``, and ``n_words``, ``n_hit``, ``items``.

    Hits go by id and text, so rows without an id, or that share one, do not
    meet; equal rows have equal hits. A text's items are joined once, by the
    distinct windows that occur in it.
    """
    windows = benchmark_windows(benchmark)
    lengths = sorted(r["size"] for r in windows.where(F.col("size") < WINDOW).select("size").distinct().collect())
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (MAP_SHARE * windows.count()).bit_length()))
    found = _candidates(F.col(text), _map_of(windows, "print", bits), _map_of(windows, "whole", bits), lengths)
    same = [F.col(key).alias("key"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_id")]
    print_ = ["print", "place", "size", "digest"]
    told = docs.select(*same, found.alias("c")).where(F.size("c.found") > 0).select("key", "text_id", F.explode("c.found").alias("one"))
    hits = told.select("key", "text_id", "one.*").distinct().join(windows.select(*print_).distinct(), print_)
    hits = written(hits, "hits")
    spans = hits.groupBy("key", "text_id").agg(_covered(F.collect_set(F.struct("start", "size"))).alias("n_hit"))
    named = hits.select("key", "text_id", *print_).distinct().join(windows.where("item IS NOT NULL").select("item", *print_), print_)
    items = named.groupBy("key", "text_id").agg(F.sort_array(F.collect_set("item")).alias("items"))

    def meet(a: str, b: str) -> Column:
        return F.col(f"{a}.key").eqNullSafe(F.col(f"{b}.key")) & (F.col(f"{a}.text_id") == F.col(f"{b}.text_id"))

    hit = spans.alias("s").join(items.alias("i"), meet("s", "i"), "left").select(
        F.col("s.key").alias("hit_key"), F.col("s.text_id").alias("hit_text"), "n_hit", "items"
    )
    hit = written(hit, "hit-rows")
    # Columns stay apart until after the join, so those that are not asked for do not move.
    own = {f"_own{i}": c for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(o) for o, c in own.items()], *same, _word_count(F.col(text)).alias("n_words"))
    # Merged at any size, as hits grow with the corpus.
    joined = rows.join(hit.hint("merge"), F.col("key").eqNullSafe(F.col("hit_key")) & (F.col("text_id") == F.col("hit_text")), "left")
    return joined.select(
        F.struct(*[F.col(o).alias(c) for o, c in own.items()]).alias("row"), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def _word_count(text: Column) -> Column:
    """As many words as there are places where one begins."""
    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        out = [np.zeros(0, np.int64)]
        for first, last in groups(texts):
            data, at = utf8(texts.slice(first, last - first))
            inside = ALNUM.table[data] != 0
            begins = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
            out.append(np.diff(np.searchsorted(begins, at)))
        give_back()
        return pa.array(np.concatenate(out))

    return count(text)


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """A twentieth of the words or more are hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def clean_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows that are not contaminated, all columns kept."""
    found = overlaps(docs, benchmark)
    return found.where(~contaminated(F.col("n_hit"), F.col("n_words"))).select("row.*")
