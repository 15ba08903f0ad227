"""Exact order statistics without sorting all rows.

One pass counts the rows per bucket of a logarithmic histogram, a mergeable
quantile sketch whose counts are exact. They tell which bucket holds a wanted
rank and how many rows lie before it, and only the distinct values of those
buckets are sorted. Rows are never moved whole, and never all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from balcao.operators.ordered import div, number_rows
from balcao.session import written

#: Buckets per doubling of the value, of which a group's histogram has at most some hundred thousand in all. A bucket
#: spans 0.02 % of its value, so it holds a bounded number of distinct amounts, however many rows.
OCTAVE = 4096

#: A rank counted from 0 as a column, from the column of the group's size.
Rank = Callable[[Column], Column]


def _bucket(v: Column) -> Column:
    """Grows with ``v``, which has two decimals."""
    size = F.floor(F.log2(F.abs(v).cast("double") * 100 + 1) * OCTAVE)
    return F.when(v < 0, -size).otherwise(size).cast("int").alias("_bucket")


def at_ranks(items: DataFrame, groups: list[str], targets: dict[str, Rank], whole: DataFrame | None = None) -> DataFrame:
    """Per group ``n`` and for each target the value at its rank, with the rows of smaller values and of the same.

    ``items`` has ``groups`` and ``v``, a decimal of two places, and is read twice,
    so it should come from a written table. ``whole`` is its ``histogram``, where
    that is known. Targets are structs (v, before, copies); NULL where the rank is
    out of range.
    """
    hist = written(histogram(items, groups), "histogram") if whole is None else whole
    # A group has few buckets, which do not grow with its rows.
    own = Window.partitionBy(*groups)
    before = F.coalesce(F.sum("_size").over(own.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sized = hist.select(*groups, "_bucket", "_size", before.alias("_before"), F.sum("_size").over(own).alias("n"))

    def spots(start: Column, size: Column) -> Column:
        """The targets whose rank is one of ``size`` from ``start``."""
        named = [F.when((at(F.col("n")) >= start) & (at(F.col("n")) < start + size), F.lit(name)) for name, at in targets.items()]
        return F.filter(F.array(*named), lambda s: s.isNotNull())

    held = sized.withColumn("_spots", spots(F.col("_before"), F.col("_size"))).filter(F.size("_spots") > 0)
    # At most one row per group and target, written so that the engine knows the size.
    held = written(held.select(*groups, "n", "_bucket", "_before"), "held")
    values = (
        items.select(*groups, "v", _bucket(F.col("v"))).join(held, [*groups, "_bucket"])
        .groupBy(*groups, "n", "_bucket", "_before", "v").agg(F.count(F.lit(1)).alias("copies"))
    )
    smaller = Window.partitionBy(*groups, "_bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    values = values.withColumn("before", F.col("_before") + F.coalesce(F.sum("copies").over(smaller), F.lit(0)))
    values = values.withColumn("_spots", spots(F.col("before"), F.col("copies")))
    found = F.struct("v", "before", "copies")
    return values.filter(F.size("_spots") > 0).groupBy(*groups, "n").agg(
        *[F.max(F.when(F.array_contains("_spots", name), found)).alias(name) for name in targets]
    )


def histogram(items: DataFrame, groups: list[str], *more: Column) -> DataFrame:
    """Rows per group and bucket, merged before they move; ``more`` aggregates besides."""
    return items.groupBy(*groups, _bucket(F.col("v"))).agg(F.count(F.lit(1)).alias("_size"), *more)


def distribution(items: DataFrame, groups: list[str], value: str, probs: dict[str, tuple[int, int]]) -> DataFrame:
    """Per group n, min, max, mean, stddev_samp and exact interpolated quantiles; NULL values are left out.

    ``items`` is read twice, so it should come from a written table. ``probs``
    maps output names to fractions (numerator, denominator). All figures but the
    quantiles follow from the histogram, which keeps each bucket's moments.
    """
    rows = items.filter(F.col(value).isNotNull()).select(*groups, F.col(value).cast("decimal(18,2)").alias("v"))
    number = F.col("v").cast("double")
    moments = (F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("v").alias("sum"), F.avg(number).alias("avg"), F.var_pop(number).alias("var"))
    hist = written(histogram(rows, groups, *moments), "histogram")
    size = F.col("_size")
    mean = hist.groupBy(*groups).agg(
        F.sum(size).alias("n"), F.min("lo").alias("minimum"), F.max("hi").alias("maximum"),
        (F.sum("sum") / F.sum(size)).alias("mean"),
    )
    # The spread around the mean is that within the buckets and that between them.
    off = F.col("avg") - F.col("mean").cast("double")
    spread = hist.join(mean.select(*groups, "mean"), groups).groupBy(*groups).agg(F.sum(size * (F.col("var") + off * off)).alias("_squares"))

    def low(num: int, den: int) -> Rank:
        return lambda n: div((n - 1) * num, F.lit(den))

    def high(num: int, den: int) -> Rank:
        return lambda n: div((n - 1) * num, F.lit(den)) + F.when(((n - 1) * num) % den > 0, 1).otherwise(0)

    targets = {f"{name}_{end}": at(num, den) for name, (num, den) in probs.items() for end, at in (("low", low), ("high", high))}
    found = at_ranks(rows, groups, targets, hist).drop("n")
    quantiles = []
    for name, (num, den) in probs.items():
        rest = (((F.col("n") - 1) * num) % den).cast("decimal(10,0)")
        quantiles.append(((F.col(f"{name}_low.v") * (den - rest) + F.col(f"{name}_high.v") * rest) / den).cast("decimal(24,6)").alias(name))
    return mean.join(spread, groups).join(found, groups).select(
        *groups, "n", "minimum", "maximum", F.col("mean").cast("decimal(24,6)").alias("mean"),
        F.sqrt(F.try_divide(F.col("_squares"), F.col("n") - 1)).alias("stddev"), *quantiles,
    )


class Tiles:
    """NTILE of stored rows over several orders at once, by the last row of every tile.

    ``orders`` maps names to ascending numeric keys; ``ties``, a unique column,
    breaks their ties. A row's tile is one more than the number of tiles that end
    before it, so the rows themselves are neither sorted nor written. Only where
    a tile ends among rows of equal key are those sorted, by ``ties`` alone.
    ``upto`` leaves out the ends of later tiles; their rows then share one number.
    """

    def __init__(self, rows: DataFrame, orders: dict[str, Column], ties: str, tiles: int, upto: int | None = None):
        self.orders, self.ties = orders, ties
        keyed = F.array(*[F.struct(F.lit(name).alias("order"), key.cast("decimal(18,2)").alias("v")) for name, key in orders.items()])
        items = rows.select(F.inline(keyed), ties)

        def end(t: int) -> Rank:
            return lambda n: t * div(n, F.lit(tiles)) + F.least(F.lit(t).cast("long"), n % tiles) - 1

        targets = {f"t{t}": end(t) for t in range(1, (upto or tiles - 1) + 1)}
        # One row per order: the key that each tile ends with, and the place of its last row among those of equal key.
        places = [F.struct(f"{t}.v", f"{t}.before", f"{t}.copies", (end(int(t[1:]))(F.col("n")) - F.col(f"{t}.before")).alias("nth")).alias(t) for t in targets]
        found = {r["order"]: [r[t] for t in targets] for r in at_ranks(items, ["order"], targets).select("order", *places).collect()}
        ends = sorted({(o, e["v"], e["nth"], e["copies"]) for o, own in found.items() for e in own})
        split = [e for e in ends if e[2] + 1 < e[3]]
        cut = dict.fromkeys(ends)
        if split:
            keys = sorted({e[:2] for e in split})
            which = F.coalesce(*[F.when((F.col("order") == o) & (F.col("v") == F.lit(v)), i) for i, (o, v) in enumerate(keys)])
            tied = number_rows(items.select(which.alias("_key"), ties).filter("_key is not null"), [F.col("_key"), F.col(ties)])
            copies = {e[:2]: e[3] for e in split}
            begin = {k: sum(copies[other] for other in keys[:i]) for i, k in enumerate(keys)}
            wanted = {begin[e[:2]] + e[2] + 1: e for e in split}
            cut |= {wanted[r["row_num"]]: r[ties] for r in tied.filter(F.col("row_num").isin(*wanted)).select("row_num", ties).collect()}
        self.ends = {o: [(e["v"], cut[(o, e["v"], e["nth"], e["copies"])]) for e in own] for o, own in found.items()}

    def of(self, order: str) -> Column:
        """The tile of a row."""
        key, out = self.orders[order].cast("decimal(18,2)"), F.lit(1)
        for v, tie in self.ends.get(order, []):
            beyond = key > F.lit(v)
            if tie is not None:
                beyond = beyond | ((key == F.lit(v)) & (F.col(self.ties) > F.lit(tie)))
            out = out + F.when(beyond, 1).otherwise(0)
        return out
