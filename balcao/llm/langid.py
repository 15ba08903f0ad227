"""Language by rank-order profiles of character n-grams.

Each language is a list of its most frequent n-grams of one to three letters. A
document makes the same list of its own text, and the language whose list
differs least by out-of-place distance is predicted: each n-gram of the document
adds how many places its rank is off, or the full profile length if the language
does not list it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UNKNOWN = "und"
#: n-grams in a profile, of languages and of documents.
PROFILE = 300
#: Profiles go to the driver and to every task: at most so many languages times PROFILE entries of 14 bytes. More is an
#: error, as such a column holds no languages.
MOST_LANGUAGES = 20_000
#: The lowest score of an accepted document.
MIN_SCORE = 0.3
_BITS = np.uint64(21)
_CODES = 0x110002  # code points shifted by two; 1 stands between words
_COUNTED_BINS = 1 << 22


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """By code point its code if a letter, else 1."""
    return np.array([c + 2 if chr(c).isalpha() else 1 for c in range(0x110000)], np.uint64)


def letter_codes(text: str) -> np.ndarray:
    """Codes of the lower-cased letters with a 1 before, between and after words."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.concatenate([[np.uint64(1)], _letters()[points], [np.uint64(1)]])
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 1) | (codes[:-1] != 1)
    return codes[keep]


def ngrams(codes: np.ndarray) -> np.ndarray:
    """All n-grams of one to three codes as numbers; none spans two words."""
    one = codes[codes != 1]
    two = codes[:-1] << _BITS | codes[1:]
    middle = codes[1:-1] != 1
    three = ((codes[:-2] << _BITS | codes[1:-1]) << _BITS | codes[2:])[middle]
    return np.concatenate([one, two, three])


def profile(text: str | None) -> np.ndarray:
    """The most frequent n-grams of a text, ties by their code; empty without letters."""
    codes = letter_codes(text) if text else np.zeros(0, np.uint64)
    if len(codes) < 3:
        return np.zeros(0, np.uint64)
    grams, counts = np.unique(ngrams(codes), return_counts=True)
    return grams[np.argsort(-counts, kind="stable")[:PROFILE]]


def gram_counts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a long text and their counts; small alphabets without a sort."""
    seen = np.zeros(_CODES, bool)
    seen[codes] = True
    alphabet = np.flatnonzero(seen).astype(np.uint64)
    size = len(alphabet)
    if size**3 > _COUNTED_BINS:
        return np.unique(ngrams(codes), return_counts=True)
    place = np.zeros(_CODES, np.int64)
    place[alphabet] = np.arange(size)
    at = place[codes]
    grams, counts = [], []
    for n, valid in ((1, codes != 1), (2, slice(None)), (3, codes[1:-1] != 1)):
        number = at[: len(at) - n + 1].copy()
        for i in range(1, n):
            number = number * size + at[i : len(at) - n + 1 + i]
        found = np.bincount(number[valid], minlength=1)
        hit = np.flatnonzero(found)
        gram = np.zeros(len(hit), np.uint64)
        for i in range(n):
            gram = gram << _BITS | alphabet[hit // size ** (n - 1 - i) % size]
        grams.append(gram)
        counts.append(found[hit])
    return np.concatenate(grams), np.concatenate(counts)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        held: dict[str, list[str]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held.setdefault(lang, []).append(text)
        for lang, texts in held.items():
            for at in _runs(texts):
                codes = letter_codes("\n".join(at))
                if len(codes) < 3:
                    continue
                grams, counts = gram_counts(codes)
                if lang in totals:
                    grams = np.concatenate([totals[lang][0], grams])
                    counts = np.concatenate([totals[lang][1], counts])
                    grams, where = np.unique(grams, return_inverse=True)
                    counts = np.bincount(where, counts).astype(np.int64)
                totals[lang] = grams, counts
    for lang, (grams, counts) in totals.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(grams)), pa.array(grams.view(np.int64)), pa.array(counts.astype(np.int64))],
            ["lang", "gram", "n"],
        )


def _runs(texts: list[str], limit: int = 1 << 20) -> Iterator[list[str]]:
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= limit:
            yield run
            run, size = [], 0
    if run:
        yield run


@dataclass(frozen=True)
class Profiles:
    """Languages with their ranks: sorted n-grams, and from ``starts`` on the languages that list each and at what rank."""

    languages: tuple[str, ...]
    grams: np.ndarray
    starts: np.ndarray
    which: np.ndarray
    ranks: np.ndarray

    def nearest(self, text: str | None) -> tuple[str, float]:
        """Language and score in 0 to 1: one less the distance over the largest possible."""
        own = profile(text)
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        places = np.flatnonzero(self.grams[at] == own)
        begin, n = self.starts[at[places]], np.diff(self.starts)[at[places]]
        listed = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
        # What a listed n-gram is nearer than one that is not.
        nearer = PROFILE - np.abs(self.ranks[listed].astype(np.int64) - np.repeat(places, n))
        saved = np.bincount(self.which[listed], weights=nearer, minlength=len(self.languages))
        best = int(np.argmax(saved))
        return self.languages[best], float(saved[best] / (PROFILE * len(own)))


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Profiles:
    """Profiles of every non-null ``lang``, counted over all of the texts.

    Every partition sums its own n-grams first; what is shuffled grows with the
    alphabets, and only the ranked PROFILE entries of each language are collected.
    """
    labelled = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = labelled.mapInArrow(_count_batches, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows = counts.withColumn("rank", rank).where(F.col("rank") <= PROFILE).select("lang", "gram", "rank").limit(MOST_LANGUAGES * PROFILE + 1).collect()
    languages = tuple(sorted({r.lang for r in rows}))
    if len(rows) > MOST_LANGUAGES * PROFILE:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    number = {name: i for i, name in enumerate(languages)}
    listed = np.array([r.gram for r in rows], np.int64).view(np.uint64)
    which, ranks = np.array([number[r.lang] for r in rows], np.int32), np.array([r["rank"] - 1 for r in rows], np.int16)
    order = np.lexsort((which, listed))
    grams, starts = np.unique(listed[order], return_index=True)
    return Profiles(languages, grams, np.append(starts, len(listed)), which[order], ranks[order])


def detect(text: Column, profiles: Profiles) -> Column:
    """Struct of ``lang_pred`` and ``score``; ``und`` and 0 for texts that are null or have no letter."""

    @F.arrow_udf("lang_pred string, score double")
    def nearest(texts: pa.Array) -> pa.Array:
        found = [profiles.nearest(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
            ["lang_pred", "score"],
        )

    return nearest(text)


def held_out(key: Column) -> Column:
    """The fifth of the keys that nothing is learned from; a null key is neither."""
    return F.crc32(key.cast("string")) % 5 == 0


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Language and score of every row, learned from the rows not held out.

    Rows with a null key are predicted and not learned from. Repeated rows count
    as often as they occur. Without any labelled row everything is ``und``.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    profiles = train(rows.where(~held_out(F.col("doc_id"))))
    return rows.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), detect(F.col("text"), profiles).alias("_found"),
    ).select("doc_id", "held_out", "_found.*")


def keep_known(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", min_score: float = MIN_SCORE) -> DataFrame:
    """Rows of a known language with a score of ``min_score`` or more, all columns kept."""
    profiles = train(docs.where(~held_out(F.col(key))), text, lang)
    found = detect(F.col("row")[text], profiles)
    return (
        docs.select(F.struct("*").alias("row"))
        .withColumn("found", found)
        .where((F.col("found.lang_pred") != UNKNOWN) & (F.col("found.score") >= min_score))
        .select("row.*")
    )
