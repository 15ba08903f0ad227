"""Star schema: dimensions with dense keys, the fact and the enriched view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao import vocab
from balcao.functions.dates import year_month
from balcao.operators.ordered import number_rows

NATURAL_KEYS = {
    "customer_key": ["customer_id"], "product_key": ["product", "category"], "location_key": ["city", "state", "country"],
}


def dim_calendar(days: DataFrame, horizon_months: int = vocab.HORIZON) -> DataFrame:
    """One row per day from the first month with data to ``horizon_months`` past the last.

    ``days`` holds ``sale_date``. The calendar is bounded by the date type.
    """
    bounds = days.agg(
        F.trunc(F.min("sale_date"), "MM").alias("lo"),
        F.last_day(F.add_months(F.max("sale_date"), horizon_months)).alias("hi"),
    )
    return calendar_days(bounds.filter("lo is not null").select(F.explode(F.sequence("lo", "hi")).alias("day")))


def calendar_days(days: DataFrame) -> DataFrame:
    """Calendar attributes of ``day``."""
    names = F.array(*map(F.lit, vocab.MONTH_NAMES))
    return days.select(
        "day",
        F.year("day").alias("year"),
        F.month("day").alias("month"),
        F.element_at(names, F.month("day")).alias("month_name"),
        F.quarter("day").alias("quarter"),
        year_month("day").alias("year_month"),
    )


def _dimension(rows: DataFrame, key: str, natural: list[str]) -> DataFrame:
    """Distinct natural keys in binary order with a dense key from 1."""
    numbered = number_rows(rows.select(*natural).distinct(), [F.col(c) for c in natural])
    return numbered.select(F.col("row_num").alias(key), *natural)


def dim_customer(rows: DataFrame) -> DataFrame:
    return _dimension(rows, "customer_key", ["customer_id"])


def dim_product(rows: DataFrame) -> DataFrame:
    return _dimension(rows, "product_key", ["product", "category"])


def dim_location(rows: DataFrame) -> DataFrame:
    return _dimension(rows, "location_key", ["city", "state", "country"])


def amount() -> Column:
    """The generated column: quantity times unit price."""
    return (F.col("quantity") * F.col("unit_price")).cast("decimal(14,2)")


def load_fact(rows: DataFrame, customers: DataFrame, products: DataFrame, locations: DataFrame) -> DataFrame:
    """Accepted rows with natural keys replaced by dimension keys.

    Joins carry no hint: the dimensions were written, so their sizes are known;
    small ones are broadcast and a large one is shuffled, where skewed keys are
    split at run time. The dimensions of several texts come first, so the rows
    are narrow by the time they may have to move for the customers.
    """
    return (
        rows.join(locations, ["city", "state", "country"])
        .join(products, ["product", "category"])
        .join(customers, "customer_id")
        .select(
            "txn_id", "order_id", "sale_date", "customer_key", "product_key", "location_key",
            "quantity", "unit_price", amount().alias("amount"), "payment_method", "status",
            *[c for c in rows.columns if c == "ordinal"],
        )
    )


def in_cells(rows: DataFrame) -> DataFrame:
    """What the monthly state is made of, from accepted rows: equal to the enriched fact, without joining it again.

    A row that lacks a day or a natural key finds no dimension row, so it is in neither.
    """
    return rows.dropna(subset=["sale_date", "customer_id", "product", "category", "city", "state", "country"]).select(
        "order_id", "sale_date", year_month("sale_date").alias("year_month"), F.year("sale_date").alias("year"),
        F.month("sale_date").alias("month"), "customer_id", "category", "state", "quantity", amount().alias("amount"), "status",
    )


def add_sale_key(fact: DataFrame) -> DataFrame:
    """Dense ``sale_key`` in staging order; a full sort, needed by no report."""
    return number_rows(fact, [F.col("ordinal")]).withColumnRenamed("row_num", "sale_key").drop("n_rows", "ordinal")


def sales_enriched(
    fact: DataFrame, calendar: DataFrame, customers: DataFrame, products: DataFrame, locations: DataFrame
) -> DataFrame:
    """Fact with its dimensions, one row per item; a stored fact's month comes along, for filters to prune by."""
    months = calendar.select(F.col("day").alias("sale_date"), "year_month", "year", "month")
    joined = (
        fact.join(months, "sale_date")
        .join(customers, "customer_key")
        .join(products, "product_key")
        .join(locations, "location_key")
    )
    def own(name: str) -> list[str]:
        return [name] if name in fact.columns else []

    return joined.select(
        *own("sale_key"), "txn_id", "order_id", "sale_date", "year_month", "year", "month", "customer_id", "product",
        "category", "city", "state", "country", "quantity", "unit_price", "amount", "payment_method", "status",
        *own("sale_month"),
    )


def status_summary(sales: DataFrame) -> DataFrame:
    """Per status: items, distinct orders and revenue; every status."""
    return sales.groupBy("status").agg(
        F.count(F.lit(1)).alias("items"),
        F.count_distinct("order_id").alias("orders"),
        F.sum("amount").alias("revenue"),
    )


def constraint_violations(
    fact: DataFrame, calendar: DataFrame, customers: DataFrame, products: DataFrame, locations: DataFrame, natural: bool = False
) -> DataFrame:
    """Rows breaking each table constraint: repeated keys, orphans (rows without a key too), bad ranges.

    A fact that has no dimension keys yet refers to the dimensions by their ``natural`` ones. The fact is read once per
    key and once for all ranges, so it should be written. Its rows are counted per key before they meet a dimension.
    """
    keys = NATURAL_KEYS if natural else {key: [key] for key in NATURAL_KEYS}

    def repeats(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select((F.col("n") - 1).alias("n"))

    def orphans(key: list[str], dim: DataFrame) -> DataFrame:
        used = fact.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        return used.join(dim.select(*key), key, "left_anti").select("n")

    checks = {
        "fact txn_id repeated": repeats(fact, "txn_id"),
        "customer repeated": repeats(customers, "customer_id"),
        "product repeated": repeats(products, "product", "category"),
        "location repeated": repeats(locations, "city", "state", "country"),
        "date outside calendar": orphans(["sale_date"], calendar.withColumnRenamed("day", "sale_date")),
        "customer orphan": orphans(keys["customer_key"], customers),
        "product orphan": orphans(keys["product_key"], products),
        "location orphan": orphans(keys["location_key"], locations),
    }
    ranges = fact.agg(
        F.count_if(F.col("quantity") <= 0).alias("quantity not positive"),
        F.count_if(F.col("unit_price") < 0).alias("price negative"),
    )
    counts = [
        df.agg(F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("violations"))
        .select(F.lit(name).alias("constraint"), "violations")
        for name, df in checks.items()
    ]
    result = ranges.unpivot([], ranges.columns, "constraint", "violations")
    for other in counts:
        result = result.unionByName(other)
    return result
