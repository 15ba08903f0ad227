"""Row numbers, running sums and average ranks over a global order.

A window without PARTITION BY sends every row to one task. Here the rows are
range-partitioned on the whole sort key instead, whose last column is unique:
heavy ties and hot values split like any others. Each row then needs only its
place in its partition plus the totals of the partitions before it, a table of
one row per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from balcao.session import written

# monotonically_increasing_id keeps the partition above this bit.
_ROW_BITS = 33


def _placed(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` in order: the range of each row (``_part``) and its place (``_pos``).

    ``order`` must end in a unique key. The placed rows are written once, since
    range bounds are sampled anew whenever a plan is planned again. There are
    at most ``spark.sql.shuffle.partitions`` ranges; small ones are merged at
    run time, which keeps their order.
    """
    return written(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_pos", F.monotonically_increasing_id()),
        "placed",
    ).withColumn("_part", F.shiftright("_pos", _ROW_BITS))


def number_rows(df: DataFrame, order: list[Column], running: tuple[str, ...] = ()) -> DataFrame:
    """Add ``row_num`` and ``n_rows``; ``run_x`` and ``total_x`` per ``running`` column.

    ``order`` must end in a unique key. Only running sums move the placed rows
    a second time.
    """
    placed = _placed(df, order)
    sums = [F.sum(c).alias(f"_sum_{c}") for c in running]
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"), *sums)
    # One row per range from here to the broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
        F.sum("_size").over(everything).alias("n_rows"),
        *[F.sum(f"_sum_{c}").over(before).alias(f"_before_{c}") for c in running],
        *[F.sum(f"_sum_{c}").over(everything).alias(f"total_{c}") for c in running],
    )
    in_part = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    numbered = placed.join(F.broadcast(offsets), "_part").withColumn(
        "row_num", F.col("_before") + in_part + 1
    )
    so_far = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    for c in running:
        carried = F.coalesce(F.col(f"_before_{c}"), F.col(c) * 0)
        numbered = numbered.withColumn(f"run_{c}", F.sum(c).over(so_far) + carried)
    return numbered.drop("_part", "_pos", "_before", *[f"_before_{c}" for c in running])


def div(a: Column, b: Column) -> Column:
    """Whole-number division, exact beyond the range of doubles."""
    return F.call_function("div", a, b)


def tile(row_num: Column, n_rows: Column, tiles: int) -> Column:
    """NTILE from a row number: the first ``n mod k`` tiles hold one row more."""
    small = div(n_rows, F.lit(tiles))
    larger = n_rows % tiles
    in_larger = larger * (small + 1)
    return (
        F.when(row_num <= in_larger, div(row_num - 1, small + 1) + 1)
        .otherwise(div(row_num - 1 - in_larger, F.nullif(small, F.lit(0).cast("long"))) + larger + 1)
        .cast("int")
    )


def average_ranks(rows: DataFrame, key: str, measures: list[str]) -> DataFrame:
    """``key`` and per measure the average rank of the row among all, less the mean rank.

    All measures are sorted together, as one narrow row per row and measure,
    and the rank is added in place: rows of equal value in one range are
    neighbours. A value can go on in other ranges only as the first or last of
    each, and what those hold of it is a table of one row per range and measure.
    The ranks meet by row once. No value is NULL, and ``key`` is unique.
    """
    values = F.array(*[F.struct(F.lit(i).alias("m"), F.col(c).cast("decimal(18,2)").alias("v")) for i, c in enumerate(measures)])
    placed = _placed(rows.select(key, F.inline(values)), [F.col("m"), F.col("v"), F.col(key)])
    run = Window.partitionBy("_part", "m", "v")
    runs = placed.select(key, "_part", "m", "v", F.min("_pos").over(run).alias("_first"), F.count(F.lit(1)).over(run).alias("_ties"))

    # One row per range, measure and edge value from here to the broadcast.
    edges = placed.groupBy("_part", "m").agg(
        F.count(F.lit(1)).alias("size"), F.min("_pos").alias("start"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )
    edges = written(edges, "ranges")
    sides = edges.select("_part", "m", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("v"))
    held = placed.join(F.broadcast(sides), ["_part", "m", "v"]).groupBy("_part", "m", "v").agg(F.count(F.lit(1)).alias("copies"))
    value = Window.partitionBy("m", "v")
    earlier = value.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spread = held.select(
        "_part", "m", "v", F.coalesce(F.sum("copies").over(earlier), F.lit(0)).alias("before"), F.sum("copies").over(value).alias("all"),
    ).groupBy("_part", "m").agg(F.collect_list(F.struct("v", "before", "all")).alias("edges"))
    order = Window.partitionBy("m").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = edges.select(
        "_part", "m", "start", F.coalesce(F.sum("size").over(order), F.lit(0)).alias("offset"),
        F.sum("size").over(Window.partitionBy("m")).alias("n"),
    ).join(spread, ["_part", "m"])

    def at_edge(name: str, inside: Column) -> Column:
        hit = F.filter("edges", lambda e: e["v"] == F.col("v"))
        return F.coalesce(F.get(hit, F.lit(0))[name], inside)

    ranked = runs.join(F.broadcast(ranges), ["_part", "m"])
    first = F.col("offset") + F.col("_first") - F.col("start") - at_edge("before", F.lit(0).cast("long"))
    rank = first + (at_edge("all", F.col("_ties")) + 1) / F.lit(2.0)
    centred = ranked.select(key, "m", (rank - (F.col("n") + 1) / F.lit(2.0)).alias("rank"))
    return centred.groupBy(key).agg(*[F.max(F.when(F.col("m") == i, F.col("rank"))).alias(c) for i, c in enumerate(measures)])
