"""Monthly revenue, retention and churn.

Customers are reduced to one row per active month first, merged before the
shuffle, so a customer holding much of the data ends up as a few rows. Every
customer measure is then local to such a row given its neighbours in time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from balcao import vocab
from balcao.functions.dates import month_of, year_month
from balcao.functions.exact import percent, ratio
from balcao.session import written


def completed(sales: DataFrame) -> DataFrame:
    """Rows that count as a sale."""
    return sales.filter(F.col("status").isin(vocab.COMPLETED))


def revenue_cube(sales: DataFrame) -> DataFrame:
    """Revenue and items by month, category, state and status; every status."""
    return sales.groupBy("year_month", "year", "month", "category", "state", "status").agg(
        F.sum("amount").alias("revenue"), F.sum("quantity").alias("items")
    )


def monthly_base(sales: DataFrame) -> DataFrame:
    """Revenue, distinct orders and distinct customers per month."""
    return (
        completed(sales)
        .groupBy(month_of("sale_date").alias("month_start"))
        .agg(
            F.sum("amount").alias("revenue"),
            F.count_distinct("order_id").alias("orders"),
            F.count_distinct("customer_id").alias("active_customers"),
        )
        .withColumn("year_month", year_month("month_start"))
    )


def month_spine(sales: DataFrame) -> DataFrame:
    """Every calendar month from the first to the last sale."""
    return _spine(completed(sales).agg(_first_month("sale_date"), _last_month("sale_date")))


def _first_month(day: str) -> Column:
    return F.trunc(F.min(day), "MM").alias("lo")


def _last_month(day: str) -> Column:
    return F.trunc(F.max(day), "MM").alias("hi")


def _spine(bounds: DataFrame) -> DataFrame:
    return bounds.filter("lo is not null").select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month_start")
    )


def customer_activity(sales: DataFrame) -> DataFrame:
    """One row per customer and active month, with its neighbours in time.

    Two shuffles: the first merges items to customer months on the map side,
    the second moves those few rows per customer together.
    """
    months = (
        completed(sales)
        .groupBy("customer_id", month_of("sale_date").alias("month_start"))
        .agg(F.max("sale_date").alias("last_sale"), F.sum("amount").alias("revenue"))
    )
    by_month = Window.partitionBy("customer_id").orderBy("month_start")
    return months.withColumns(
        {
            "first_month": F.min("month_start").over(by_month),
            "previous_month": F.lag("month_start").over(by_month),
            "next_month": F.lead("month_start").over(by_month),
            "next_sale": F.lead("last_sale").over(by_month),
        }
    )


def stored_activity(sales: DataFrame) -> DataFrame:
    """``customer_activity`` written once, for measures that also need the first or last month."""
    return written(customer_activity(sales), "activity")


def _active_at(month: Column, sale: Column, days: int) -> Column:
    return F.datediff(F.last_day(month), sale) <= days


def _monthly_flow(activity: DataFrame, days: int) -> DataFrame:
    """All customer counts per month in one aggregate.

    A customer month spreads over the month itself (step 0) and the months
    after it that still see the customer active; each such month puts the
    customer in the churn base of the month that follows. ``days`` bounds how
    many months a purchase can reach, hence the fan-out.
    """
    reach = days // 28 + 1
    steps = activity.select("*", F.explode(F.sequence(F.lit(0), F.lit(reach))).alias("step"))
    here = F.add_months("month_start", F.col("step"))
    before = F.add_months("month_start", F.col("step") - 1)
    first = F.col("step") == 0
    spans = F.col("next_month").isNull() | (before < F.col("next_month"))
    base = ~first & spans & _active_at(before, F.col("last_sale"), days)
    latest = F.when(here == F.col("next_month"), F.col("next_sale")).otherwise(F.col("last_sale"))
    return (
        steps.select(
            here.alias("month_start"),
            F.when(first, F.col("revenue")).alias("revenue"),
            first.alias("is_active"),
            (first & (F.col("month_start") == F.col("first_month"))).alias("is_new"),
            (first & (F.col("previous_month") == F.add_months("month_start", -1))).alias("is_retained"),
            base.alias("in_base"),
            (base & ~_active_at(here, latest, days)).alias("is_churned"),
        )
        .filter("is_active or in_base")
        .groupBy("month_start")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.count_if("is_active").alias("active_customers"),
            F.count_if("is_new").alias("new_customers"),
            F.count_if("is_retained").alias("retained"),
            F.count_if("in_base").alias("churn_base"),
            F.count_if("is_churned").alias("churned"),
        )
    )


def new_customers(sales: DataFrame) -> DataFrame:
    """Customers by the month of their first purchase."""
    first = completed(sales).groupBy("customer_id").agg(month_of(F.min("sale_date")).alias("month_start"))
    return (
        first.groupBy("month_start").agg(F.count(F.lit(1)).alias("new_customers"))
        .select(year_month("month_start").alias("year_month"), "new_customers")
    )


def retained_customers(sales: DataFrame) -> DataFrame:
    """Per month, customers whose previous active month is the month before."""
    return retained_in(customer_activity(sales))


def retained_in(activity: DataFrame) -> DataFrame:
    return (
        activity
        .groupBy("month_start")
        .agg(F.count_if(F.col("previous_month") == F.add_months("month_start", -1)).alias("retained"))
        .select(year_month("month_start").alias("year_month"), "retained")
    )


def active_status(sales: DataFrame, days: int = vocab.CHURN_DAYS) -> DataFrame:
    """Per customer and month from the first purchase on: bought in the last ``days`` days.

    A customer month holds until the next one, so the months between are
    unfolded in place: no join of customers with the calendar.
    """
    return status_in(stored_activity(sales), days)


def status_in(activity: DataFrame, days: int = vocab.CHURN_DAYS) -> DataFrame:
    last = activity.agg(F.max("month_start").alias("hi")).scalar()
    until = F.coalesce(F.add_months("next_month", -1), last)
    return (
        activity
        .withColumn("at", F.explode(F.sequence("month_start", until, F.expr("interval 1 month"))))
        .select(
            "customer_id",
            year_month("at").alias("year_month"),
            _active_at(F.col("at"), F.col("last_sale"), days).alias("active"),
        )
    )


def churn_monthly(sales: DataFrame, days: int = vocab.CHURN_DAYS) -> DataFrame:
    """Active at the end of the previous month, and those of them no longer active."""
    return churn_in(stored_activity(sales), days)


def churn_in(activity: DataFrame, days: int = vocab.CHURN_DAYS) -> DataFrame:
    flow = _monthly_flow(activity, days)
    bounds = activity.agg(F.min("month_start").alias("lo"), F.max("month_start").alias("hi"))
    later = _spine(bounds.filter("lo < hi").withColumn("lo", F.add_months("lo", 1)))
    zero = F.lit(0).cast("long")
    return later.join(flow, "month_start", "left").select(
        year_month("month_start").alias("year_month"),
        F.coalesce("churn_base", zero).alias("churn_base"),
        F.coalesce("churned", zero).alias("churned"),
    )


def kpi_monthly(sales: DataFrame, days: int = vocab.CHURN_DAYS) -> DataFrame:
    """Revenue, orders, tickets, customers, retention and churn per month.

    Months without a sale have no row; retention divides by the customers of
    the previous row but counts those who bought in the month right before.
    The window over months is bounded by the calendar.
    """
    months = (
        completed(sales)
        .groupBy(month_of("sale_date").alias("month_start"))
        .agg(F.count_distinct("order_id").alias("orders"))
    )
    return kpi_rows(customer_activity(sales), months, days)


def kpi_rows(activity: DataFrame, months: DataFrame, days: int = vocab.CHURN_DAYS) -> DataFrame:
    """The KPIs from customer months and from ``months``: month_start, orders, and revenue unless the activity has it."""
    flow = _monthly_flow(activity, days).filter("active_customers > 0")
    if "revenue" in months.columns:
        flow = flow.drop("revenue")
    in_time = Window.orderBy("month_start")
    before = F.lag("active_customers").over(in_time)
    return flow.join(months, "month_start").select(
        year_month("month_start").alias("year_month"),
        "revenue",
        "orders",
        ratio(F.col("revenue"), F.col("orders"), 2).alias("avg_ticket"),
        "active_customers",
        "new_customers",
        ratio(F.col("revenue"), F.col("active_customers"), 2).alias("avg_ticket_per_customer"),
        percent(F.col("retained"), before).alias("retention_rate"),
        percent(F.col("churned"), F.col("churn_base")).alias("churn_rate"),
    )


def monthly_series(sales: DataFrame, *keys: str) -> DataFrame:
    """Completed revenue and distinct orders per month, for each combination of ``keys``."""
    return (
        completed(sales)
        .groupBy(*keys, month_of("sale_date").alias("month_start"))
        .agg(
            F.round(F.sum("amount"), 2).alias("revenue"),
            F.count_distinct("order_id").alias("orders"),
        )
        .select(*keys, year_month("month_start").alias("year_month"), "month_start", "revenue", "orders")
    )
