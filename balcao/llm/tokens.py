"""Token counts by byte-pair merging with a heap and a linked list.

A text starts as one symbol per character. The adjacent pair of the lowest rank
(the leftmost among equals) is merged again and again until no pair is in the
vocabulary. Only the number of merges is kept: tokens are the initial symbols
minus the merges, where a character outside the vocabulary counts as its UTF-8
bytes. No identifier is ever made.

Null texts are empty and have no token. Long texts are counted whole, unit by
unit. Rows do not depend on each other, other columns are left out, whatever their
names, and an empty table gives no row.
"""

from __future__ import annotations

import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Units whose count a worker remembers, about 100 MB.
REMEMBERED = 600_000
#: Longer units are rare repeats and are counted anew.
LONGEST_REMEMBERED = 64


class PieceVocabulary:
    """Merge ranks of a sentencepiece BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [
            i for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        self.ranks = {model.id_to_piece(i): -model.get_score(i) for i in plain}
        if model.normalize(" a  ﬁ") != f"{SPACE}{SPACE}a{SPACE}{SPACE}ﬁ" or not model.is_byte(model.piece_to_id("<0x0A>")):
            raise ValueError(f"{path}: only identity normalization with a space before and byte fallback is counted")
        # No merge can cross a place that is inside no piece, so texts are cut there.
        words = all(SPACE not in piece.lstrip(SPACE) for piece in self.ranks)
        lines = all("\n" not in piece for piece in self.ranks)
        self.unit = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n" if words and lines else "(?s).+")
        self.counts = _Remembered(self)

    def count(self, text: str | None) -> int:
        """Tokens of a text, without begin, end or special tokens; none in an empty one."""
        if not text:
            return 0
        return sum(map(self.counts.__getitem__, self.unit.findall(SPACE + text.replace(" ", SPACE))))

    def merged(self, unit: str) -> int:
        """Symbols left of a unit after all merges."""
        ranks = self.ranks
        symbols: list[str | None] = list(unit)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[pair], i, pair) for i, pair in enumerate(map("".join, zip(unit, unit[1:]))) if pair in ranks]
        heapify(heap)
        merges = 0
        while heap:
            _, left, pair = heappop(heap)
            right = after[left]
            if symbols[left] is None or right == n or symbols[left] + symbols[right] != pair:
                continue  # one of the two has been merged since
            symbols[left], symbols[right] = pair, None
            merges += 1
            then = after[left] = after[right]
            if then < n:
                before[then] = left
                longer = pair + symbols[then]
                if longer in ranks:
                    heappush(heap, (ranks[longer], left, longer))
            if (prior := before[left]) >= 0:
                longer = symbols[prior] + pair
                if longer in ranks:
                    heappush(heap, (ranks[longer], prior, longer))
        unknown = sum(len(s.encode()) - 1 for s in symbols if s is not None and len(s) == 1 and s not in ranks)
        return n - merges + unknown


class _Remembered(dict):
    """Counts of units seen before, up to a bound; the rest is counted each time."""

    def __init__(self, vocabulary: PieceVocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, unit: str) -> int:
        found = self.vocabulary.merged(unit)
        if len(self) < REMEMBERED and len(unit) <= LONGEST_REMEMBERED:
            self[unit] = found
        return found


@lru_cache(maxsize=2)
def vocabulary(path: str) -> PieceVocabulary:
    return PieceVocabulary(path)


def n_tokens(text: Column, path: str) -> Column:
    """Tokens of each text under the model file at ``path``, which every executor must have."""

    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        count = vocabulary(path).count
        return pa.array([count(t.as_py()) for t in texts], pa.int64())

    return counted(text)


def token_counts(docs: DataFrame, path: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, UTF-8 bytes, tokens, and whether it has more than ``limit`` tokens.

    Null and empty texts have no bytes and no tokens. Rows with equal or null
    keys stay separate rows. Other columns are not looked at.
    """
    return (
        docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
        .select(
            "doc_id",
            F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
            n_tokens(F.col("text"), path).alias("n_tokens"),
        )
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
