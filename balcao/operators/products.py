"""Product concentration and growth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from balcao import vocab
from balcao.functions.dates import month_of, year_month
from balcao.functions.exact import change_pct, percent
from balcao.operators.kpis import completed
from balcao.operators.ordered import number_rows


def pareto(sales: DataFrame) -> DataFrame:
    """Per product name: revenue, share, running share and position."""
    per_product = completed(sales).groupBy("product").agg(F.sum("amount").alias("revenue"))
    ranked = number_rows(per_product, [F.col("revenue").desc(), F.col("product")], running=("revenue",))
    return ranked.select(
        "product", "revenue",
        percent(F.col("revenue"), F.col("total_revenue"), 2).alias("share_pct"),
        percent(F.col("run_revenue"), F.col("total_revenue"), 2).alias("running_pct"),
        F.col("row_num").alias("position"),
    )


def product_metrics(sales: DataFrame) -> DataFrame:
    """Per product and category: revenue, quantity, growth of the last 3 months on the 3 before."""
    base = completed(sales)
    last = base.agg(F.trunc(F.max("sale_date"), "MM").alias("m")).scalar()
    tagged = base.select(
        "product", "category", "amount", "quantity",
        F.months_between(last, month_of("sale_date")).cast("int").alias("age"),
    )
    recent = F.sum(F.when(F.col("age") <= 2, F.col("amount")))
    prior = F.sum(F.when(F.col("age").between(3, 5), F.col("amount")))
    return tagged.groupBy("product", "category").agg(
        F.sum("amount").alias("revenue"),
        F.sum("quantity").alias("quantity"),
        change_pct(recent, prior).alias("growth_pct"),
    )


def category_mom(sales: DataFrame) -> DataFrame:
    """Revenue per month and category, and change on the category's previous month with sales."""
    monthly = completed(sales).groupBy("year_month", "category").agg(F.sum("amount").alias("revenue"))
    before = F.lag("revenue").over(Window.partitionBy("category").orderBy("year_month"))
    return monthly.select("year_month", "category", "revenue", change_pct(F.col("revenue"), before).alias("mom_pct"))


def yoy(sales: DataFrame) -> DataFrame:
    """Revenue per month, the value 12 rows earlier and the change on it.

    The window spans the months of the calendar, a few rows.
    """
    monthly = (
        completed(sales).groupBy(month_of("sale_date").alias("month_start"))
        .agg(F.sum("amount").alias("revenue"))
    )
    before = F.lag("revenue", 12).over(Window.orderBy("month_start"))
    return monthly.withColumn("revenue_year_before", before).select(
        year_month("month_start").alias("year_month"), "revenue", "revenue_year_before",
        change_pct(F.col("revenue"), F.col("revenue_year_before")).alias("yoy_pct"),
    )


def product_highlights(metrics: DataFrame) -> DataFrame:
    """``product_metrics`` with growth, each product's role: top volume, growth, decline or rest.

    Ties go to the first name; a product named for one role keeps it.
    """
    valid = metrics.filter("growth_pct is not null")
    tie = F.struct("product", "category")
    # min_by over (measure, name) picks the best measure and then the first name.
    roles = valid.agg(
        F.min_by("product", F.struct(-F.col("revenue"), tie)).alias("a"),
        F.min_by("product", F.struct(-F.col("growth_pct"), tie)).alias("b"),
        F.min_by("product", F.struct(F.col("growth_pct"), tie)).alias("c"),
    )
    volume, growth, decline = (roles.select(c).scalar() for c in "abc")
    return valid.select(
        "product", "category", "revenue", "growth_pct",
        F.when(F.col("product") == volume, vocab.TOP_VOLUME)
        .when(F.col("product") == growth, vocab.TOP_GROWTH)
        .when(F.col("product") == decline, vocab.TOP_DECLINE)
        .otherwise(vocab.OTHER_PRODUCTS).alias("role"),
    )
