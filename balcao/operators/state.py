"""What is stored of every month, so that questions need not read the items again.

Three tables are refreshed with a load or extended by new months: a cube of sums,
bitmaps of the orders in each of its cells, and one row per customer with the
months it bought in. Each merges with rows of other months into exactly what all
the sales together give.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.operators import kpis
from balcao.operators.ordered import number_rows

#: What a cube's rows are told apart by.
CELL = ["year_month", "year", "month", "category", "state", "status"]


# ---- cube -------------------------------------------------------------------


def sales_cube(sales: DataFrame) -> DataFrame:
    """Sums per month, category, state and status, under the items' own names: amount, quantity, n_rows."""
    return sales.groupBy(*CELL).agg(
        F.sum("amount").cast("decimal(24,2)").alias("amount"), F.sum("quantity").alias("quantity"), F.count(F.lit(1)).alias("n_rows")
    )


def merge_cubes(stored: DataFrame, new: DataFrame) -> DataFrame:
    """The cube of both; cells of the same month add up."""
    return stored.unionByName(new).groupBy(*CELL).agg(
        F.sum("amount").cast("decimal(24,2)").alias("amount"), F.sum("quantity").alias("quantity"), F.sum("n_rows").alias("n_rows")
    )


# ---- orders -----------------------------------------------------------------


def order_numbers(sales: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """order_id and a dense number from 1 in order of first sale, so a month's orders lie together.

    With ``known`` numbers only further orders are numbered, after the last of them.
    """
    first = sales.groupBy("order_id").agg(F.min("sale_date").alias("first_sale"))
    if known is not None:
        first = first.join(known, "order_id", "left_anti")
    numbered = number_rows(first, [F.col("first_sale"), F.col("order_id")])
    if known is None:
        return numbered.select("order_id", F.col("row_num").alias("order_key"))
    last = known.agg(F.coalesce(F.max("order_key"), F.lit(0)).alias("last")).scalar()
    return known.unionByName(numbered.select("order_id", (F.col("row_num") + last).alias("order_key")))


def order_months(sales: DataFrame, numbers: DataFrame) -> DataFrame:
    """The orders in each cell as bitmaps over blocks of 32,768 numbers."""
    key = F.col("order_key")
    return sales.select(*CELL, "order_id").join(numbers, "order_id").groupBy(*CELL, F.bitmap_bucket_number(key).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("orders")
    )


def merge_orders(stored: DataFrame, new: DataFrame) -> DataFrame:
    return stored.unionByName(new).groupBy(*CELL, "block").agg(F.bitmap_or_agg("orders").alias("orders"))


def distinct_orders(bitmaps: DataFrame, *groups: str) -> DataFrame:
    """Distinct orders of each group of cells, an order that is in several counted once."""
    merged = bitmaps.groupBy(*groups, "block").agg(F.bitmap_or_agg("orders").alias("orders"))
    return merged.groupBy(*groups).agg(F.sum(F.bitmap_count("orders")).alias("orders"))


# ---- customers --------------------------------------------------------------


def _month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def _packed(pairs: Column) -> Column:
    """(first_month, active, last_days) from sorted (month, day) pairs of distinct months.

    Bit i of ``active``, 64 to a word, is the i-th month after the first.
    """
    first, last = F.get(pairs, F.lit(0))["month"], F.element_at(pairs, -1)["month"]

    def word(w: Column) -> Column:
        own = F.filter(pairs, lambda p: F.shiftright(p["month"] - first, 6) == w)
        bit = lambda p: F.call_function("shiftleft", F.lit(1).cast("long"), (p["month"] - first) % 64)
        return F.aggregate(own, F.lit(0).cast("long"), lambda bits, p: bits.bitwiseOR(bit(p)))

    return F.struct(
        first.alias("first_month"), F.transform(F.sequence(F.lit(0), F.shiftright(last - first, 6)), word).alias("active"),
        F.transform(pairs, lambda p: p["day"]).alias("last_days"),
    )


def _history(pairs: DataFrame) -> DataFrame:
    return pairs.select("customer_id", _packed(F.col("pairs")).alias("h")).select("customer_id", "h.*")


def customer_history(sales: DataFrame) -> DataFrame:
    """Per customer with a completed sale: the first month (year * 12 + month - 1), a bitmap of the months
    bought in, and the last day bought on in each of them."""
    day = F.col("sale_date")
    months = kpis.completed(sales).groupBy("customer_id", _month_number(day).alias("month")).agg(F.dayofmonth(F.max(day)).alias("day"))
    return _history(months.groupBy("customer_id").agg(F.sort_array(F.collect_list(F.struct("month", "day"))).alias("pairs")))


def _set(months: Column) -> Column:
    """Whether the customer bought ``months`` after its first month."""
    word = F.get("active", F.shiftright(months, 6))
    return F.coalesce(F.bit_get(word, months % 64) == 1, F.lit(False))


def _offsets() -> Column:
    """The months bought in, counted from the first."""
    return F.filter(F.sequence(F.lit(0), F.size("active") * 64 - 1), _set)


def _pairs() -> Column:
    months = F.transform(_offsets(), lambda i: (i + F.col("first_month")).alias("month"))
    return F.zip_with(months, "last_days", lambda m, d: F.struct(m.alias("month"), d.alias("day")))


def merge_histories(stored: DataFrame, new: DataFrame) -> DataFrame:
    """The history of both, customer by customer; of a month in both the later day stays."""
    rows = stored.unionByName(new).select("customer_id", _pairs().alias("pairs"))
    merged = rows.groupBy("customer_id").agg(F.sort_array(F.flatten(F.collect_list("pairs"))).alias("pairs"))
    # Sorted by month and day, the last of a month is the one before another month or the end.
    last = F.filter("pairs", lambda p, i: F.coalesce(F.get("pairs", i + 1)["month"] != p["month"], F.lit(True)))
    return _history(merged.select("customer_id", last.alias("pairs")))


def activity(history: DataFrame) -> DataFrame:
    """One row per customer and active month with its neighbours in time, as ``kpis.customer_activity``
    gives it from the items, but without a shuffle; revenue is not known here."""
    def date(p: Column) -> Column:
        return F.make_date(F.floor(p["month"] / 12).cast("int"), p["month"] % 12 + 1, p["day"])

    days = history.select("customer_id", F.transform(_pairs(), date).alias("days"))
    rows = days.select("customer_id", "days", F.posexplode("days").alias("i", "last_sale"))
    before, after = F.get("days", F.col("i") - 1), F.get("days", F.col("i") + 1)
    return rows.select(
        "customer_id", F.trunc("last_sale", "MM").alias("month_start"), "last_sale", F.lit(None).cast("decimal(24,2)").alias("revenue"),
        F.trunc(F.get("days", F.lit(0)), "MM").alias("first_month"), F.trunc(before, "MM").alias("previous_month"),
        F.trunc(after, "MM").alias("next_month"), after.alias("next_sale"),
    )


def active_customers(history: DataFrame) -> DataFrame:
    """Per month: customers that bought, bought for the first time, and bought in the month before as well."""
    months = history.select("first_month", "active", F.explode(_offsets()).alias("i"))
    return months.groupBy((F.col("first_month") + F.col("i")).alias("month")).agg(
        F.count(F.lit(1)).alias("active_customers"), F.count_if(F.col("i") == 0).alias("new_customers"),
        F.count_if(_set(F.col("i") - 1) & (F.col("i") > 0)).alias("retained"),
    ).withColumn("month_start", F.make_date(F.floor(F.col("month") / 12).cast("int"), F.col("month") % 12 + 1, F.lit(1))).drop("month")


# ---- figures ----------------------------------------------------------------


def monthly_orders(cube: DataFrame, bitmaps: DataFrame, *keys: str) -> DataFrame:
    """Completed revenue and distinct orders per month and ``keys``, without the items."""
    groups = [*keys, "year_month"]
    revenue = kpis.completed(cube).groupBy(*groups).agg(F.sum("amount").alias("revenue"))
    orders = distinct_orders(kpis.completed(bitmaps), *groups)
    same = [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in groups]
    joined = revenue.alias("a").join(orders.alias("b"), same)
    return joined.select(*[F.col(f"a.{g}").alias(g) for g in groups], "revenue", "orders", F.to_date("a.year_month", "yyyy-MM").alias("month_start"))


def monthly_base(cube: DataFrame, bitmaps: DataFrame, history: DataFrame) -> DataFrame:
    """``kpis.monthly_base`` from the stored state."""
    return monthly_orders(cube, bitmaps).join(active_customers(history).select("month_start", "active_customers"), "month_start").select(
        "month_start", "revenue", "orders", "active_customers", "year_month"
    )


def status_summary(cube: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``star.status_summary`` from the stored state."""
    sums = cube.groupBy("status").agg(F.sum("n_rows").alias("items"), F.sum("amount").alias("revenue"))
    return sums.join(distinct_orders(bitmaps, "status"), "status").select("status", "items", "orders", "revenue")


def kpi_monthly(cube: DataFrame, bitmaps: DataFrame, history: DataFrame) -> DataFrame:
    """``kpis.kpi_monthly`` from the stored state."""
    return kpis.kpi_rows(activity(history), monthly_orders(cube, bitmaps).select("month_start", "revenue", "orders"))
