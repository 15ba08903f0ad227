"""Mixing sources to target weights by Pfair scheduling.

The documents of each source are cut into blocks. Block j of a source of weight
w may be placed from slot floor(j / w) on and has to be placed before slot
ceil((j + 1) / w). In every slot the released block of the earliest deadline is
placed, so after any number of slots each source is less than one block from its
share, as long as it has blocks. A source that has run out leaves its slots
empty; no row is dropped or repeated.

Weights are kept as they are given. The schedule repeats after the sum of the
weights divided by their greatest common divisor; as many slots as that, or as
the blocks need if these are fewer, are computed in one row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from balcao.session import written

#: Slots of one period of ``whole_slots``; at least the number of sources is used.
PERIOD = 1000
#: Rows of a block.
BLOCK_ROWS = 32
#: Slots that one output file holds in a row.
RUN_SLOTS = 128
#: Slots placed between two copies of the schedule so far, and blocks of a source that a row of it holds.
STEP = 256
#: Rows of a bucket of the shuffled order, about, if all were of one source.
BUCKET_ROWS = 4096


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def whole_slots(weights: DataFrame, period: int = PERIOD) -> DataFrame:
    """``source`` and ``slots`` of each: its share of a period, largest remainders rounded up.

    ``weights`` has one row per source with a whole, non-negative ``weight``. Every
    source of some weight gets one slot at least, so the period grows by those.
    """
    everything = Window.partitionBy()
    shares = weights.where("weight > 0").select("source", F.col("weight").cast("decimal(38,0)").alias("weight")).select(
        "source",
        _div(F.col("weight") * period, F.sum("weight").over(everything)).alias("least"),
        ((F.col("weight") * period) % F.sum("weight").over(everything)).alias("rest"),
    )
    left = period - F.sum("least").over(everything)
    place = F.row_number().over(Window.orderBy(F.desc("rest"), F.asc_nulls_first("source")))
    return shares.select("source", F.greatest(F.col("least") + F.when(place <= left, 1).otherwise(0), F.lit(1)).cast("int").alias("slots"))


def _gcd(weights: Column) -> Column:
    """By Euclid; two whole numbers of 64 bits take at most 92 steps."""

    def of_two(a: Column, b: Column) -> Column:
        pair = F.struct(a.alias("a"), b.alias("b"))
        step = lambda p, _: F.when(p["b"] == 0, p).otherwise(F.struct(p["b"].alias("a"), (p["a"] % F.nullif(p["b"], F.lit(0))).alias("b")))
        return F.aggregate(F.sequence(F.lit(1), F.lit(92)), pair, step, lambda p: p["a"])

    return F.aggregate(weights, F.lit(0).cast("bigint"), of_two)


def schedule(weights: DataFrame, blocks: DataFrame) -> DataFrame:
    """``source``, ``period``, ``weight`` in a period, ``part``, and ``places``: slots of STEP blocks of the source in order.

    ``weights`` as ``mix`` takes them; ``blocks`` has the ``blocks`` of each
    ``source``. Earliest deadline first, in one row of as many steps as slots up to
    the last block's deadline, one period at most. Equal deadlines go by the order
    of sources. Releases and deadlines are added up in whole numbers.
    """
    own = blocks.select(F.col("source").alias("_source"), "blocks")
    # One row: the sources in order; as many entries as sources.
    table = weights.where("weight > 0").join(own, F.col("source").eqNullSafe(F.col("_source")), "left").agg(
        F.array_sort(F.collect_list(F.struct("source", F.col("weight").cast("bigint").alias("weight"), F.coalesce("blocks", F.lit(0)).alias("blocks")))).alias("sources")
    )
    table = written(table.select("sources", F.greatest(_gcd(F.col("sources.weight")), F.lit(1)).alias("gcd")), "mix-sources")
    table = written(
        table.select(
            F.transform("sources", lambda s: s.withField("weight", _div(s["weight"], F.col("gcd")))).alias("sources"),
            F.aggregate("sources", F.lit(0).cast("bigint"), lambda n, s: n + _div(s["weight"], F.col("gcd"))).alias("period"),
        ),
        "mix-sources",
    )
    period = F.col("period")
    wide = lambda c: c.cast("decimal(19,0)")
    last = F.array_max(F.transform("sources", lambda s: _div(wide(s["blocks"]) * wide(period) + s["weight"] - 1, wide(s["weight"]))))
    table = written(
        table.select(
            "period", F.coalesce(F.least(period, last), F.lit(0)).alias("slots"), "sources",
            F.transform("sources", lambda s: F.struct(
                s["weight"].alias("weight"), _div(period, s["weight"]).alias("whole"), (period % s["weight"]).alias("rest"),
            )).alias("steps"),
        ),
        "mix-sources",
    )

    def placed(state: Column, slot: Column) -> Column:
        ready = F.transform(state["now"], lambda s, i: F.when(
            s["release"] <= slot, F.struct((s["next"] + F.when(s["rest"] > 0, 1).otherwise(0)).alias("deadline"), i.alias("which"))
        ))

        def moved(old: Column, chosen: Column) -> Column:
            s, by = F.get(old["now"], chosen), F.get("steps", chosen)
            rest = s["rest"] + by["rest"]
            over = rest >= by["weight"]
            after = F.struct(
                (s["block"] + 1).alias("block"), s["next"].alias("release"),
                (s["next"] + by["whole"] + F.when(over, 1).otherwise(0)).alias("next"),
                (rest - F.when(over, by["weight"]).otherwise(0)).alias("rest"),
            )
            one = F.struct(chosen.alias("which"), s["block"].alias("block"), slot.alias("slot"))
            return F.struct(
                F.concat(F.slice(old["now"], F.lit(1), chosen), F.array(after), F.slice(old["now"], chosen + 2, F.size("steps"))).alias("now"),
                F.concat(old["order"], F.array(one)).alias("order"),
            )

        # null only if no block is released, which full shares rule out; a fold over one value computes it once
        return F.aggregate(F.array(F.array_min(ready)["which"]), state, moved)

    none = "array<struct<which:int,block:bigint,slot:bigint>>"
    nought = F.lit(0).cast("bigint")

    def run(state: Column, first: Column) -> Column:
        slots = F.sequence(first, F.least(first + STEP, F.col("slots")) - 1)
        part = F.aggregate(slots, F.struct(state["now"].alias("now"), F.array().cast(none).alias("order")), placed)
        return F.aggregate(F.array(part), state, lambda old, new: F.struct(
            new["now"].alias("now"), F.concat(old["orders"], F.array(new["order"])).alias("orders")
        ))

    begin = F.struct(
        F.transform("steps", lambda s: F.struct(nought.alias("block"), nought.alias("release"), s["whole"].alias("next"), s["rest"].alias("rest"))).alias("now"),
        F.array().cast(f"array<{none}>").alias("orders"),
    )
    firsts = F.when(F.col("slots") > 0, F.sequence(nought, F.col("slots") - 1, F.lit(STEP).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    order = table.select(F.explode(F.aggregate(firsts, begin, run, lambda s: s["orders"])).alias("part"))
    places = order.select(F.explode("part").alias("one")).groupBy("one.which", _div(F.col("one.block"), F.lit(STEP)).alias("part")).agg(
        F.array_sort(F.collect_list("one.slot")).alias("places")
    )
    named = table.select("period", F.posexplode("sources").alias("place", "own"))
    return places.join(F.broadcast(named), F.col("which") == F.col("place")).select(
        F.col("own.source").alias("source"), "period", F.col("own.weight").alias("weight"), "part", "places"
    )


def root_weights(docs: DataFrame, source: str = "source") -> DataFrame:
    """A weight for each source: the square root of its rows, in thousandths."""
    return docs.groupBy(F.col(source).alias("source")).agg(
        F.floor(F.sqrt(F.count(F.lit(1)).cast("double")) * 1000).alias("weight")
    )


def mix(docs: DataFrame, weights: DataFrame, key: str = "doc_id", source: str = "source", block_rows: int = BLOCK_ROWS, period: int | None = None) -> DataFrame:
    """Struct ``row`` of all columns of ``docs``, with ``block``, ``slot`` and ``place`` in the block.

    Rows of a source follow the digests of their keys; equal digests go by key,
    and repeated rows follow one another. Null sources are a source of their own.
    Rows of sources without weight are left out, as no slot is theirs. With a
    ``period``, weights are rounded to its ``whole_slots`` first.

    A source is numbered in buckets of its shuffled order, so no task has a whole
    source: the counts of the buckets before give the number its bucket begins at.
    There are more buckets as there are more rows. Only rows of one key share a
    digest, and those stay in one bucket. Texts play no part; an empty table gives
    no row.
    """
    digits = max(1, math.ceil(math.log(max(1, docs.count() / BUCKET_ROWS), 16)))
    rows = docs.select(
        F.col(source).alias("source"),
        F.col(key).alias("key"),
        F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("digest"),
        F.struct("*").alias("row"),
    ).withColumn("bucket", F.substring("digest", 1, digits))
    counts = rows.groupBy("source", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(
        counts.select(
            F.col("source").alias("_source"), F.col("bucket").alias("_bucket"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), "n",
        ),
        "mix-starts",
    )
    if period is not None:
        weights = whole_slots(weights, period).withColumnRenamed("slots", "weight")
    blocks = starts.groupBy(F.col("_source").alias("source")).agg(_div(F.sum("n") + block_rows - 1, F.lit(block_rows)).alias("blocks"))
    plan = written(schedule(weights, blocks).withColumnRenamed("source", "_source").withColumnRenamed("part", "_part"), "mix-plan")
    each = written(plan.select("_source", "period", "weight").distinct(), "mix-periods")
    in_bucket = F.row_number().over(Window.partitionBy("source", "bucket").orderBy("digest", "key"))
    number = F.col("start") + F.col("in_bucket") - 1
    same_source = F.col("source").eqNullSafe(F.col("_source"))
    block = _div(F.col("number"), F.lit(block_rows))
    nth = block % F.col("weight")
    return (
        rows.withColumn("in_bucket", in_bucket)
        .join(starts, same_source & (F.col("bucket") == F.col("_bucket")))
        .withColumn("number", number)
        .drop("_source", "_bucket")
        .join(each, same_source)
        .drop("_source")
        .join(plan.drop("period", "weight"), same_source & (_div(nth, F.lit(STEP)) == F.col("_part")))
        .select(
            "row",
            block.alias("block"),
            (_div(block, F.col("weight")) * F.col("period") + F.get("places", (nth % STEP).cast("int"))).alias("slot"),
            (F.col("number") % block_rows).alias("place"),
        )
    )


def in_order(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of ``mix``: ``columns`` of the row, its ``mix_slot`` and ``mix_place``.

    Runs of RUN_SLOTS slots stay in one file, in order. Columns of the row that
    have one of the two names are left out.
    """
    own = [F.col("row")[c].alias(c) for c in columns if c.lower() not in ("mix_slot", "mix_place")]
    return (
        mixed.repartition(_div(F.col("slot"), F.lit(RUN_SLOTS)))
        .sortWithinPartitions("slot", "place")
        .select(*own, F.col("slot").alias("mix_slot"), F.col("place").alias("mix_place"))
    )
