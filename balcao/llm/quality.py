"""Quality rules as a short-circuit cascade.

A row is dropped by the first rule that rejects it, so cheap rules that reject
much should come first. Each rule is run alone over a sample to estimate what it
costs beyond the figures that every row is given, and the share it rejects of the
rows that pass the base; the rules then run in falling order of rejection per
cost. The order changes the time only: a row is kept if no rule rejects it.

Null and empty texts have no words and fail the base; texts are read whole, one
at a time. Repeated rows and rows without an id each get their own verdict, ties
between rules go by cost and name, other columns are left out, whatever their
names, and an empty table gives no row.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from copy import copy
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows the costs and selectivities are estimated on.
SAMPLE_ROWS = 400
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


class Measures:
    """Figures of one text, each computed when a rule first asks for it."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode("utf-8", "surrogatepass").split()  # at ASCII blanks only

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, BLANKS))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        """Lines that have a word."""
        return [line for line in self.text.split("\n") if line.strip(BLANKS)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside a window of three that the text has twice or more."""
        windows = list(zip(self.words, self.words[1:], self.words[2:]))
        if len(set(windows)) == len(windows):
            return 0
        counts = Counter(windows)
        covered = bytearray(self.n_words)
        for at, window in enumerate(windows):
            if counts[window] > 1:
                covered[at] = covered[at + 1] = covered[at + 2] = 1
        return sum(covered)

    @cached_property
    def top_word(self) -> int:
        return max(Counter(self.words).values(), default=0)

    @cached_property
    def n_upper(self) -> int:
        """Capitals A to Z."""
        return sum(map(self.text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))

    @cached_property
    def n_mute_words(self) -> int:
        """Words of ASCII signs and digits alone."""
        return sum(not any(97 <= b <= 122 or b >= 128 for b in w.lower()) for w in self.words)


Rule = Callable[[Measures], bool]

#: What every row is given.
FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What every document is measured by first: too short, or mostly repeated.
BASE: dict[str, Rule] = {
    "few_words": lambda m: m.n_words < 50,
    "repeated_words": lambda m: 100 * m.n_repeat_words > 50 * m.n_words,
}
RULES: dict[str, Rule] = {
    "symbols": lambda m: 10 * m.n_symbols > m.n_words,
    "word_length": lambda m: not 2 * m.n_words <= m.word_chars <= 15 * m.n_words,
    "repeated_lines": lambda m: 100 * m.n_dup_lines > 50 * len(m.lines),
    "capitals": lambda m: 100 * m.n_upper > 30 * m.word_chars,
    "one_word": lambda m: 100 * m.top_word > 30 * m.n_words,
    "mute_words": lambda m: 100 * m.n_mute_words > 30 * m.n_words,
}


def trials(docs: DataFrame, rules: dict[str, Rule], text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[tuple[str, float, float]]:
    """Per rule its mean seconds and its share of rejected rows, over ``sample_rows`` rows.

    A rule is charged for what it asks for beyond the base figures, and tried on
    the rows that get so far. Rows are drawn from the first partitions that fill
    the sample; the texts stay on the executors.
    """
    names = list(rules)

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in batch.column(0):
                known, spent, rejected = Measures(one.as_py()), [], []
                for figure in FIGURES:
                    getattr(known, figure)
                if any(rule(known) for rule in BASE.values()):
                    spent, rejected = [0] * len(names), [False] * len(names)
                for name in names[len(spent) :]:
                    measures = copy(known)
                    start = time.perf_counter_ns()
                    rejected.append(bool(rules[name](measures)))
                    spent.append(time.perf_counter_ns() - start)
                yield pa.RecordBatch.from_arrays([pa.array([spent]), pa.array([rejected])], ["spent", "rejected"])

    rows = docs.select(F.col(text)).mapInArrow(tried, "spent array<bigint>, rejected array<boolean>").take(sample_rows)
    n = max(1, len(rows))
    return [
        (name, sum(r.spent[i] for r in rows) / n / 1e9, sum(r.rejected[i] for r in rows) / n)
        for i, name in enumerate(names)
    ]


def cheapest_order(tried: list[tuple[str, float, float]]) -> list[str]:
    """Rules by rejection per cost, best first, ties by name."""
    return [name for name, cost, share in sorted(tried, key=lambda t: (-t[2] / max(t[1], 1e-9), t[1], t[0]))]


def assess(text: Column, order: list[str], rules: dict[str, Rule]) -> Column:
    """The base figures, ``base_failed``, and ``kept``: whether no rule in ``order`` rejects."""
    figures = FIGURES

    @F.arrow_udf(", ".join(f"{name} long" for name in figures) + ", base_failed boolean, kept boolean")
    def assessed(texts: pa.Array) -> pa.Array:
        columns: list[list] = [[] for _ in range(len(figures) + 2)]
        for one in texts:
            m = Measures(one.as_py())
            failed = any(rule(m) for rule in BASE.values())
            kept = not failed and not any(rules[name](m) for name in order)
            for column, value in zip(columns, [*(getattr(m, name) for name in figures), failed, kept]):
                column.append(value)
        kinds = [pa.int64()] * len(figures) + [pa.bool_()] * 2
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], [*figures, "base_failed", "kept"]
        )

    return assessed(text)


def quality(docs: DataFrame, rules: dict[str, Rule] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Figures and verdict of every row.

    Null and empty texts have no words and fail the base. Repeated rows and rows
    with null keys each get their own verdict.
    """
    rules = RULES if rules is None else rules
    order = cheapest_order(trials(docs, rules, text))
    return docs.select(
        F.col(key).alias("doc_id"), assess(F.col(text), order, rules).alias("_found")
    ).select("doc_id", "_found.*")
