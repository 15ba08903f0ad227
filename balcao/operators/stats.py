"""Descriptive statistics, price outliers and correlation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.operators.cuts import distribution
from balcao.operators.kpis import completed
from balcao.operators.ordered import average_ranks
from balcao.session import written

QUARTILES = {"q1": (1, 4), "median": (1, 2), "q3": (3, 4)}
ITEM_MEASURES = ["unit_price", "quantity", "amount"]
DESCRIBED = ["unit_price", "quantity", "item_amount", "order_amount"]
CUSTOMER_MEASURES = ["recency_days", "frequency", "monetary"]


def describe_sales(sales: DataFrame) -> DataFrame:
    """Min, quartiles, mean, max and deviation of price, quantity, item and order amount."""
    base = written(completed(sales).select("order_id", "unit_price", "quantity", "amount"), "items")
    wide = "decimal(18,2)"
    items = base.select(
        F.col("unit_price").cast(wide).alias("unit_price"),
        F.col("quantity").cast(wide).alias("quantity"),
        F.col("amount").cast(wide).alias("item_amount"),
    ).unpivot([], ["unit_price", "quantity", "item_amount"], "metric", "value")
    orders = written(base.groupBy("order_id").agg(F.sum("amount").cast(wide).alias("value")).select("value"), "orders")
    values = items.unionByName(orders.select(F.lit("order_amount").alias("metric"), "value"))
    spread = distribution(values, ["metric"], "value", QUARTILES)
    metrics = sales.sparkSession.createDataFrame([(m,) for m in DESCRIBED], "metric string")
    return metrics.join(spread, "metric", "left").select("metric", "minimum", "q1", "median", "mean", "q3", "maximum", "stddev")


def price_outliers(sales: DataFrame) -> DataFrame:
    """Per category the Tukey and three-sigma upper limits and how many prices exceed each."""
    prices = written(completed(sales).select("category", "unit_price"), "prices")
    limits = distribution(prices, ["category"], "unit_price", QUARTILES).select(
        "category", "n", "q1", "q3",
        (F.col("q3") + F.lit("1.5").cast("decimal(2,1)") * (F.col("q3") - F.col("q1"))).alias("upper_iqr"),
        (F.col("mean").cast("double") + 3 * F.col("stddev")).alias("upper_z"),
    )
    price = F.col("unit_price")
    return (
        prices.join(written(limits, "limits"), "category")
        .groupBy("category", "n", "q1", "q3", "upper_iqr", "upper_z")
        .agg(
            F.count_if(price > F.col("upper_iqr")).alias("outliers_iqr"),
            F.count_if(price.cast("double") > F.col("upper_z")).alias("outliers_z"),
        )
        .select(
            "category", "n",
            *[F.round(c, 2).cast("decimal(24,2)").alias(c) for c in ("q1", "q3", "upper_iqr", "upper_z")],
            "outliers_iqr", "outliers_z",
        )
    )


def _matrix(df: DataFrame, measures: list[str], pair: dict[tuple[str, str], Column], name: str) -> DataFrame:
    """One aggregate over all pairs, unfolded to one row per ordered pair."""
    values = df.agg(*[c.alias(f"{a}|{b}") for (a, b), c in pair.items()])
    cells = []
    for a in measures:
        for b in measures:
            key = f"{a}|{b}" if (a, b) in pair else f"{b}|{a}"
            cells.append(
                F.struct(F.lit(a).alias("measure_a"), F.lit(b).alias("measure_b"), F.col(f"`{key}`").alias(name))
            )
    return values.select(F.inline(F.array(*cells)))


def _pairs(measures: list[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(measures) for b in measures[i + 1 :]]


def _varies(spread: Column) -> Column:
    """Correlation of a measure with itself: NULL when it is constant."""
    return F.when(spread > 0, F.lit(1.0))


def pearson_matrix(df: DataFrame, measures: list[str]) -> DataFrame:
    """Pearson correlation of every pair of ``measures`` in one pass."""
    def double(m: str) -> Column:
        return F.col(m).cast("double")

    # The built-in corr divides by zero on a constant measure in ANSI mode.
    pair = {
        (a, b): F.try_divide(
            F.covar_pop(double(a), double(b)), F.stddev_pop(double(a)) * F.stddev_pop(double(b))
        )
        for a, b in _pairs(measures)
    } | {(m, m): _varies(F.var_pop(double(m))) for m in measures}
    return _matrix(df, measures, pair, "pearson")


def spearman_matrix(df: DataFrame, measures: list[str]) -> DataFrame:
    """Spearman correlation: Pearson over average ranks, of the rows that have every measure.

    Ranks come centred on their known mean, so products are summed directly.
    """
    whole = df.select(*measures).dropna().withColumn("_row", F.monotonically_increasing_id())
    ranked = average_ranks(written(whole, "measures"), "_row", measures)

    def total(a: str, b: str) -> Column:
        return F.sum(F.col(a) * F.col(b))

    pair = {
        (a, b): F.try_divide(total(a, b), F.sqrt(total(a, a)) * F.sqrt(total(b, b)))
        for a, b in _pairs(measures)
    } | {(m, m): _varies(total(m, m)) for m in measures}
    return _matrix(ranked, measures, pair, "spearman")


def item_measures(sales: DataFrame) -> DataFrame:
    return completed(sales).select(*ITEM_MEASURES)
