"""Near duplicates by bottom-k sketches from one hash function.

A document is the set of hashes of its shingles; its sketch is the SKETCH
smallest of them. Documents of equal sets are one class, so copies are never
compared. Inverted lists hold, for every run of three values that follow one
another in a sketch (or its start), the classes that have the run. Two sets of a
similarity of 0.8 share such a run: of sets within SKETCH values always, as at
most a fifth of their union's values differ, and of larger ones but for about 1
of 10^10 pairs at 0.8 exactly.

Short lists are compared in full. Classes of long lists, which may share no more
than a common passage, are listed anew by single values of their full sets: sets
that are similar have 0.8 of their values in common, so if each leaves out one
less than that, those that most of these classes have, they still share one of
the rest, and the first they share leaves enough behind it in both. Long lists of these are checked against one hub at a time, first the class with
the longest lists, and lists whose classes are linked already are done, so a
large group of similar classes costs about its size per round, not its square.
What is still open after HUB_ROUNDS is compared in full. A checked pair passes
the sizes, then the similarity estimated from the smallest values of both
sketches' union, and is confirmed on the full sets of both texts.

Null texts, and those without words, have no shingle and are linked with nothing;
texts are read whole, and one must fit in a task. Other columns are kept, whatever
their names. An empty table gives no row.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from balcao.llm.components import components
from balcao.llm.texts import PIECE, SPACED, Words, give_back, groups
from balcao.session import written

SHINGLE = 5
#: The least similarity, as a percentage.
PERCENT = 80
SKETCH = 64
HUB_ROUNDS = 1
#: Lists of so many classes are short.
SHORT_LIST = 8
#: Larger sets are confirmed only if so many percent of the union's sketch are shared: 11 deviations below 80.
LEAST_ESTIMATE = 45


def shingle_sets(texts: pa.Array, shingle: int):
    """The sorted distinct shingles of each text: all runs of words, or all words where they are fewer."""
    for first, last in groups(texts, PIECE):
        words = Words(texts.slice(first, last - first), SPACED)
        grams, _ = words.grams(shingle)
        grams = grams.view(np.int64)
        for a, b in zip(words.first[:-1], words.first[1:]):
            if b - a >= shingle:
                yield np.unique(grams[a : b - shingle + 1])
            elif b > a:
                yield _whole(words.hashes[a:b])
            else:
                yield grams[:0]


def _whole(hashes: np.ndarray) -> np.ndarray:
    from balcao.llm.texts import rolled

    return rolled(hashes, len(hashes)).view(np.int64)


def _sketched(text: Column, shingle: int) -> Column:
    @F.arrow_udf("struct<n:bigint,set_id:binary,sketch:array<bigint>>")
    def sketched(texts: pa.Array) -> pa.Array:
        sizes, ids, parts = [], [], []
        for values in shingle_sets(texts, shingle):
            sizes.append(len(values))
            ids.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
            parts.append(values[:SKETCH].copy())  # a view would hold on to the whole set
        ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
        give_back()
        sketches = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else [], pa.int64()))
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), sketches], ["n", "set_id", "sketch"]
        )

    return sketched(text)


@lru_cache(maxsize=64)
def _set_of(text: str, shingle: int) -> np.ndarray:
    return next(shingle_sets(pa.array([text]), shingle))


def _full_set(text: Column, shingle: int) -> Column:
    @F.arrow_udf("array<bigint>")
    def full(texts: pa.Array) -> pa.Array:
        sets = list(shingle_sets(texts, shingle))
        give_back()
        ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets) if sets else [], pa.int64()))

    return full(text)


def _similar(a: Column, b: Column, shingle: int, percent: int) -> Column:
    @F.arrow_udf("boolean")
    def similar(left: pa.Array, right: pa.Array) -> pa.Array:
        found = []
        for one, two in zip(left, right):
            x, y = _set_of(one.as_py(), shingle), _set_of(two.as_py(), shingle)
            both = len(np.intersect1d(x, y, assume_unique=True))
            found.append(bool(100 * both >= percent * (len(x) + len(y) - both)))
        _set_of.cache_clear()
        give_back()
        return pa.array(found, pa.bool_())

    return similar(a, b)


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _same_row(id_: str, digest: str) -> Column:
    return F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col("digest") == F.col(digest))


def _all_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """``x, y``: classes of one list with different labels that have enough values from it on in common."""
    x, y = (
        rows.select("run", F.struct("node", "n").alias(c), (F.col("n") - F.col("place")).alias(f"left_{c}"), F.col("label").alias(f"label_{c}"))
        for c in "xy"
    )
    enough = (100 + percent) * F.least("left_x", "left_y") >= percent * (F.col("x.n") + F.col("y.n"))
    return x.join(y, "run").where(
        (F.col("label_x") != F.col("label_y")) & (F.col("x.node") < F.col("y.node")) & enough
    ).select("x", "y")


class _Search:
    """The tables of one run over ``doc_id, text``."""

    def __init__(self, rows: DataFrame, shingle: int, percent: int):
        self.rows, self.shingle, self.percent = rows, shingle, percent
        found = rows.select("doc_id", _digest(F.col("text")).alias("digest"), _sketched(F.col("text"), shingle).alias("s"))
        self.sketches = written(found.select("doc_id", "digest", "s.*"), "sketches")
        # The id alone orders first rows; a missing one comes last.
        first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest"))
        sets = self.sketches.where("n > 0").groupBy("set_id").agg(
            first.alias("first"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
        )
        self.classes = written(
            sets.select("set_id", "first.doc_id", "first.digest", "copies", "n", "sketch").withColumn(
                "node", F.monotonically_increasing_id()
            ),
            "classes",
        )

    def lists(self) -> DataFrame:
        """``run, node, n, place, short, weight`` of all lists that several classes are in.

        ``place`` tells how many values of the class come before that of the list;
        ``weight`` of a class adds up the lengths of its lists by value.
        """
        runs = F.expr(
            "transform(sequence(0, size(sketch) - 2), i -> xxhash64(if(i = 0, null, sketch[i - 1]), sketch[i], sketch[i + 1]))"
        )
        own = self.classes.where(F.size("sketch") > 1).select(F.explode(runs).alias("run"), "node", "n")
        shared = written(own.groupBy("run").agg(F.count(F.lit(1)).alias("length")).where("length > 1"), "runs")
        by_run = written(own.join(shared, "run"), "by-run")
        self.texts = self.listed_texts(by_run)
        by_value = written(self.rare_values(by_run.where(F.col("length") > SHORT_LIST).select("node").distinct()), "rare")
        lengths = by_value.groupBy("run").agg(F.count(F.lit(1)).alias("length")).where("length > 1")
        by_value = by_value.join(lengths, "run")
        weights = by_value.groupBy("node").agg(F.sum("length").alias("weight"))
        short = by_run.where(F.col("length") <= SHORT_LIST).select(
            "run", "node", "n", F.lit(0).cast("long").alias("place"), F.lit(True).alias("short"), F.lit(0).cast("long").alias("weight")
        )
        return written(
            short.unionByName(
                by_value.join(weights, "node").select("run", "node", "n", "place", (F.col("length") <= SHORT_LIST).alias("short"), "weight")
            ),
            "lists",
        )

    def rare_values(self, nodes: DataFrame) -> DataFrame:
        """``run, node, n, place``: the values of each of ``nodes`` that the fewest of them have, a fifth and one more."""
        texts = self.texts.join(nodes, "node", "left_semi")
        sets = texts.select("node", F.explode(_full_set(F.col("text"), self.shingle)).alias("value"))
        values = written(sets, "values")
        common = values.groupBy("value").agg(F.count(F.lit(1)).alias("holders"))
        ordered = Window.partitionBy("node").orderBy("holders", "value")
        whole = Window.partitionBy("node")
        ranked = values.join(common, "value").select(
            "node", "value", "holders", F.row_number().over(ordered).alias("place"), F.count(F.lit(1)).over(whole).alias("n")
        )
        least = F.call_function("div", F.col("n") * self.percent + 99, F.lit(100))
        return ranked.where((F.col("place") <= F.col("n") - least + 1) & (F.col("holders") > 1)).select(
            F.xxhash64(F.lit("value"), "value").alias("run"), "node", "n", (F.col("place") - 1).cast("long").alias("place")
        )

    def listed_texts(self, lists: DataFrame) -> DataFrame:
        """``node, text`` of the classes in lists, one row each.

        The rows are merged with those wanted at any size: the corpus is moved
        once, and nothing that grows with it is broadcast.
        """
        wanted = written(
            self.classes.join(lists.select("node").distinct(), "node", "left_semi")
            .select("node", F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")),
            "wanted",
        )
        rows = self.rows.withColumn("digest", _digest(F.col("text"))).join(wanted.hint("merge"), _same_row("_id", "_digest"))
        return written(rows.groupBy("node").agg(F.first("text").alias("text")), "texts")

    def links(self, pairs: DataFrame, sketches: DataFrame) -> DataFrame:
        """The pairs ``a, b`` that are similar."""
        def side(table: DataFrame, key: str, *columns: str) -> DataFrame:
            return table.select(F.col("node").alias(key), *[F.col(c).alias(f"{c}_{key}") for c in columns])

        both = pairs.join(side(sketches, "a", "n", "sketch"), "a").join(side(sketches, "b", "n", "sketch"), "b")
        union = F.array_sort(F.array_union("sketch_a", "sketch_b"))
        common = F.array_intersect("sketch_a", "sketch_b")
        whole = (F.col("n_a") <= SKETCH) & (F.col("n_b") <= SKETCH)
        least = F.slice(union, 1, SKETCH)
        told = both.select(
            "a", "b", whole.alias("whole"),
            F.when(whole, 100 * F.size(common) >= self.percent * F.size(union))
            .otherwise(100 * F.size(F.array_intersect(least, common)) >= LEAST_ESTIMATE * F.size(least)).alias("likely"),
        ).where("likely")
        told = written(told, "likely")
        confirmed = (
            told.where("NOT whole").join(side(self.texts, "b", "text"), "b").join(side(self.texts, "a", "text"), "a")
            .where(_similar(F.col("text_a"), F.col("text_b"), self.shingle, self.percent)).select("a", "b")
        )
        return told.where("whole").select("a", "b").unionByName(confirmed)

    def pairs(self, lists: DataFrame, labels: DataFrame | None, turn: int) -> DataFrame | None:
        """Pairs ``a, b`` of unlinked classes that share a run, of sizes that can be similar; None if no list is open.

        Short lists give all pairs in the first turn; long ones those with one
        hub, and in the last turn all that are still open.
        """
        long = lists.where("NOT short")
        if labels is None:
            open_ = long.withColumn("label", F.col("node"))
        else:
            open_ = long.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        chosen = F.struct(-F.col("weight"), "node") if turn == 0 else F.xxhash64("node", F.lit(turn))
        several = open_.groupBy("run").agg(
            F.min("label").alias("least"), F.max("label").alias("most"), F.min_by(F.struct("node", "n", "label"), chosen).alias("hub"),
        ).where("least < most")
        several = written(several.select("run", "hub"), "open")
        if turn and several.isEmpty():
            return None
        if turn == HUB_ROUNDS:
            near = _all_pairs(open_.join(several.select("run"), "run"), self.percent)
        else:
            near = open_.join(several, "run").where(F.col("label") != F.col("hub.label")).select(
                F.struct("node", "n").alias("x"), F.struct("hub.node", "hub.n").alias("y")
            )
        if turn == 0:
            near = near.unionByName(_all_pairs(lists.where("short").withColumn("label", F.col("node")), self.percent))
        sizes = 100 * F.least("x.n", "y.n") >= self.percent * F.greatest("x.n", "y.n")
        return near.where(sizes).select(
            F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
        ).distinct()

    def labels(self) -> DataFrame:
        """``node, label``: classes that are linked with others, by component."""
        lists = self.lists()
        involved = written(
            self.classes.join(lists.select("node").distinct(), "node", "left_semi").select("node", "n", "sketch"), "involved"
        )
        links = checked = labels = None
        for turn in range(HUB_ROUNDS + 1):
            pairs = self.pairs(lists, labels, turn)
            if pairs is None:
                break
            if checked is not None:
                pairs = pairs.join(checked, ["a", "b"], "left_anti")
            pairs = written(pairs, "pairs")
            checked = pairs if checked is None else checked.unionByName(pairs)
            found = written(self.links(pairs, involved), "links")
            if found.isEmpty():
                continue
            links = found if links is None else links.unionByName(found)
            labels = written(components(links), "labels")
        if labels is None:
            return lists.select("node", F.col("node").alias("label")).limit(0)
        return labels

    def grouped(self) -> DataFrame:
        """``set_id, keeper`` of classes with copies or links; the keeper is the first row of the component."""
        linked = self.classes.select("node", "set_id", "copies", "doc_id", "digest").join(self.labels(), "node", "left")
        linked = written(linked.where("copies > 1 OR label IS NOT NULL").withColumn("label", F.coalesce("label", "node")), "linked")
        first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")).alias("keeper")
        keepers = written(linked.groupBy("label").agg(first), "keepers")
        return written(linked.select("set_id", "label").join(keepers, "label").select("set_id", "keeper"), "grouped")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept (the id is the component's smallest).

    Rows without words are alone. Rows that share an id each have the component
    of their own text. A row without an id has the smallest id of its component,
    or null, in which case it is kept.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    search = _Search(rows, shingle, percent)
    component = F.when(F.col("keeper").isNotNull(), F.col("keeper.doc_id")).otherwise(F.col("doc_id"))
    return (
        search.sketches.select("doc_id", "n", "set_id").join(search.grouped(), "set_id", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each component, that of its smallest id, with all columns; rows without words all stay."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    search = _Search(rows, shingle, percent)
    member = search.sketches.join(search.grouped(), "set_id").select("doc_id", "digest", "keeper")
    same = F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("digest") == F.col("keeper.digest"))
    # Rows repeated as a whole are in one component, and the keeper itself may be such a row.
    repeated = member.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("times"), F.bool_or(same).alias("keeps"))
    told = written(
        repeated.where("times > 1 OR NOT keeps").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "keeps"), "told"
    )
    marked = docs.select(F.struct("*").alias("row"), F.col(key).alias("doc_id"), _digest(F.col(text)).alias("digest"))
    # Merged at any size: rows that go grow with the corpus. Keepers repeated as a whole are few as a rule.
    others = marked.join(told.hint("merge"), _same_row("_id", "_digest"), "left_anti").select("row.*")
    again = marked.join(written(told.where("keeps"), "told-again"), _same_row("_id", "_digest"))
    once = F.row_number().over(Window.partitionBy("_id", "_digest").orderBy(F.to_json("row")))
    return others.unionByName(again.withColumn("once", once).where("once = 1").select("row.*"))
