"""The filter selection and the questions asked of filtered data."""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from balcao import vocab
from balcao.functions.exact import change_pct, percent, ratio
from balcao.operators.ordered import number_rows

PERIOD, CATEGORY, STATE, STATUS = "period", "category", "state", "status"
ALL_AXES = (PERIOD, CATEGORY, STATE, STATUS)
#: The column that names a stored fact's month folders.
MONTH = "sale_month"


@dataclass(frozen=True)
class Selection:
    """A period, inclusive at both ends (None is no bound), and value lists; an empty list selects all."""

    start: dt.date | None
    end: dt.date | None
    categories: tuple[str, ...] = ()
    states: tuple[str, ...] = ()
    statuses: tuple[str, ...] = field(default=())


def filter_options(sales: DataFrame) -> DataFrame:
    """Distinct category, state and status values, one row each, as (axis, value)."""
    return sales.unpivot([], ["category", "state", "status"], "axis", "value").distinct()


def date_bounds(sales: DataFrame) -> DataFrame:
    """First and last sale date over all statuses, one row."""
    return sales.agg(F.min("sale_date").alias("first_date"), F.max("sale_date").alias("last_date"))


def default_selection(sales: DataFrame) -> Selection:
    """Everything, with the completed statuses that occur."""
    bounds = date_bounds(sales).first()
    present = sales.filter(F.col("status").isin(vocab.COMPLETED)).select("status").distinct()
    found = {row["status"] for row in present.take(len(vocab.COMPLETED))}
    return Selection(
        bounds["first_date"], bounds["last_date"],
        statuses=tuple(s for s in vocab.COMPLETED if s in found),
    )


def default_period(sales: DataFrame) -> DataFrame:
    """The default selection as a row: bounds and the completed statuses that occur, by name."""
    done = F.collect_set(F.when(F.col("status").isin(vocab.COMPLETED), F.col("status")))
    return sales.agg(
        F.min("sale_date").alias("first_date"), F.max("sale_date").alias("last_date"),
        F.array_join(F.sort_array(done), ", ").alias("statuses"),
    )


def preset_periods(sales: DataFrame) -> DataFrame:
    """Start and end of every preset over the sales; no row without sales."""
    first, last = F.col("first_date"), F.col("last_date")
    starts = {vocab.PRESET_ALL: first}
    starts |= {name: F.date_sub(last, days) for name, days in vocab.PRESET_DAYS.items()}
    starts[vocab.PRESET_YEAR] = F.trunc(last, "year")
    rows = [F.struct(F.lit(p).alias("preset"), s.alias("first_date"), last.alias("last_date")) for p, s in starts.items()]
    return date_bounds(sales).filter(last.isNotNull()).select(F.inline(F.array(*rows)))


def resolve_period(
    preset: str, first: dt.date, last: dt.date, custom: tuple[dt.date, dt.date] | None = None
) -> tuple[dt.date, dt.date]:
    """Period of a preset, counted back from the last sale instead of the clock."""
    if preset == vocab.PRESET_ALL:
        return first, last
    if preset in vocab.PRESET_DAYS:
        return last - dt.timedelta(days=vocab.PRESET_DAYS[preset]), last
    if preset == vocab.PRESET_YEAR:
        return dt.date(last.year, 1, 1), last
    if preset == vocab.PRESET_CUSTOM and custom:
        return custom
    raise ValueError(f"unknown period preset {preset!r}")


def month_text(day: dt.date | None) -> str | None:
    """``yyyy-mm``, also below the year 1000."""
    return day.isoformat()[:7] if day else None


def first_of_month(bound: dt.date | str | None) -> dt.date | None:
    """The month of a day or of a ``yyyy-mm`` text, as its first day."""
    if bound is None:
        return None
    return dt.date.fromisoformat(f"{month_text(bound) if isinstance(bound, dt.date) else bound}-01")


def in_months(sales: DataFrame, start: dt.date | str | None, end: dt.date | str | None) -> DataFrame:
    """Sales of the whole months from that of ``start`` to that of ``end``; None is no bound.

    Over a stored fact the test is on the column of its month folders, so other
    folders are not opened, through the star join too. Sales without that column
    are tested by day.
    """
    lo, hi = first_of_month(start), first_of_month(end)
    column = next((c for c in (MONTH, "sale_date", "year_month") if c in sales.columns), None)
    if column is None:
        return sales
    if column == "sale_date" and hi is not None:
        hi = dt.date(hi.year, hi.month, calendar.monthrange(hi.year, hi.month)[1])
    if column == "year_month":
        lo, hi = month_text(lo), month_text(hi)
    if lo is not None:
        sales = sales.filter(F.col(column) >= F.lit(lo))
    return sales if hi is None else sales.filter(F.col(column) <= F.lit(hi))


def axis_test(df: DataFrame, chosen: Selection, axis: str) -> Column:
    """Whether a row of ``df`` is chosen on one axis; an axis without a column or a choice keeps every row.

    The period works on days where ``sale_date`` exists, else on whole months.
    """
    test = F.lit(True)
    if axis == PERIOD:
        column = next((c for c in ("sale_date", "year_month") if c in df.columns), None)
        bounds = (chosen.start, chosen.end)
        if column == "year_month":
            bounds = tuple(month_text(day) for day in bounds)
        if column and bounds[0] is not None:
            test = test & (F.col(column) >= F.lit(bounds[0]))
        if column and bounds[1] is not None:
            test = test & (F.col(column) <= F.lit(bounds[1]))
        return test
    values = {CATEGORY: chosen.categories, STATE: chosen.states, STATUS: chosen.statuses}[axis]
    return F.col(axis).isin(*values) if values and axis in df.columns else test


def apply_selection(df: DataFrame, chosen: Selection, axes: Iterable[str] = ALL_AXES) -> DataFrame:
    """Filter ``df`` on the named axes; an axis whose column is missing is skipped."""
    axes, out = set(axes), df
    unknown = axes - set(ALL_AXES)
    if unknown:
        raise ValueError(f"unknown filter axes: {sorted(unknown)}")
    if PERIOD in axes and MONTH in df.columns:
        out = in_months(out, chosen.start, chosen.end)
    for axis in ALL_AXES:
        if axis in axes:
            out = out.filter(axis_test(df, chosen, axis))
    return out


def kpi_vs_previous(kpis: DataFrame, chosen: Selection) -> DataFrame:
    """Chosen months against as many months before them, one row.

    ``kpis`` has one row per month, so the ranking windows are a few rows long.
    """
    lo, hi = month_text(chosen.start), month_text(chosen.end)
    current = F.col("year_month").between(lo, hi)
    tagged = kpis.withColumn("current", current).withColumn("earlier", F.col("year_month") < lo)
    width = F.count_if("current").over(Window.partitionBy())
    back = F.row_number().over(Window.partitionBy("earlier").orderBy(F.desc("year_month")))
    tagged = tagged.withColumn("previous", F.col("earlier") & (back <= width))

    def total(column: str, flag: str):
        return F.sum(F.when(F.col(flag), F.col(column)))

    def mean(column: str, flag: str):
        own = F.when(F.col(flag), F.col(column))
        return F.sum(own).cast("decimal(24,2)") / F.nullif(F.count(own), F.lit(0).cast("long"))

    sums = tagged.agg(
        *[total(c, f).alias(f"{c}_{f}") for c in ("revenue", "orders") for f in ("current", "previous")],
        *[mean(c, f).alias(f"{c}_{f}") for c in ("retention_rate", "churn_rate") for f in ("current", "previous")],
    )

    def ticket(flag: str):
        wide = "decimal(24,2)"
        return F.col(f"revenue_{flag}").cast(wide) / F.nullif(F.col(f"orders_{flag}").cast(wide), F.lit(0).cast(wide))

    def points(column: str):
        return F.round(F.col(f"{column}_current") - F.col(f"{column}_previous"), 4).cast("decimal(18,4)")

    # Change of revenue per order as one quotient of exact products.
    crossed = F.col("revenue_current") * F.col("orders_previous")
    return sums.select(
        F.col("revenue_current").alias("revenue"),
        F.round(ticket("current"), 2).cast("decimal(24,2)").alias("ticket"),
        F.round("retention_rate_current", 4).cast("decimal(18,4)").alias("retention_rate"),
        F.round("churn_rate_current", 4).cast("decimal(18,4)").alias("churn_rate"),
        change_pct(F.col("revenue_current"), F.col("revenue_previous"), 2).alias("revenue_change_pct"),
        change_pct(crossed, F.col("revenue_previous") * F.col("orders_current"), 2).alias("ticket_change_pct"),
        points("retention_rate").alias("retention_change_pp"),
        points("churn_rate").alias("churn_change_pp"),
    )


def revenue_by_month(cube: DataFrame) -> DataFrame:
    """Revenue per month of a filtered cube."""
    return cube.groupBy("year_month").agg(F.sum("revenue").alias("revenue"))


def revenue_peak(cube: DataFrame) -> DataFrame:
    """Month of highest revenue and how far it is above the monthly mean, one row."""
    months = revenue_by_month(cube)
    return months.agg(
        F.min_by("year_month", F.struct(-F.col("revenue"), "year_month")).alias("peak_month"),
        F.max("revenue").alias("peak_revenue"),
        percent(
            F.max("revenue") * F.count(F.lit(1)) - F.sum("revenue"), F.sum("revenue"), 1
        ).alias("above_mean_pct"),
    )


def seasonality(cube: DataFrame) -> DataFrame:
    """Revenue by year and calendar month, of every year."""
    return cube.groupBy("year", "month").agg(F.sum("revenue").alias("revenue"))


def season_extremes(cube: DataFrame) -> DataFrame:
    """Best and worst calendar month and their ratio; NULL below two years or twelve months."""
    span = cube.agg(
        (
            (F.count_distinct("year") >= 2) & (F.count_distinct("year_month") >= 12)
        ).alias("enough")
    ).scalar()
    months = cube.groupBy("month").agg(F.sum("revenue").alias("revenue"))
    best = F.min_by("month", F.struct(-F.col("revenue"), "month"))
    worst = F.min_by("month", F.struct("revenue", "month"))
    return (
        months.agg(
            best.alias("best"), worst.alias("worst"),
            ratio(F.max("revenue"), F.min("revenue"), 1).alias("ratio"),
        )
        .withColumn("enough", span)
        .select(
            F.when(F.col("enough"), F.col("best")).alias("best_month"),
            F.when(F.col("enough"), F.col("worst")).alias("worst_month"),
            F.when(F.col("enough"), F.col("ratio")).alias("best_to_worst"),
        )
    )


def category_ranking(cube: DataFrame) -> DataFrame:
    """Revenue per category with its share."""
    revenue = cube.groupBy("category").agg(F.sum("revenue").alias("revenue"))
    total = cube.agg(F.sum("revenue").alias("t")).scalar()
    return revenue.select("category", "revenue", percent(F.col("revenue"), total, 2).alias("share_pct"))


def category_leader(cube: DataFrame) -> DataFrame:
    """Leading category, its share and how many of the smallest reach it together.

    NULL count when all others together stay below the leader, and with a
    single category. The running sum goes through the ranked primitive, so the
    number of categories is free.
    """
    revenue = cube.groupBy("category").agg(F.sum("revenue").alias("revenue"))
    # Ties in revenue: the last name leads, so it also comes last here.
    placed = number_rows(revenue, [F.col("revenue"), F.col("category")], running=("revenue",))
    tops = placed.filter("row_num = n_rows").select("revenue").scalar()
    is_top = F.col("row_num") == F.col("n_rows")
    rows = placed.withColumn("top", tops)
    below = F.count_if(~is_top & (F.col("run_revenue") < F.col("top")))
    others = F.max(F.when(~is_top, F.col("run_revenue")))
    return rows.agg(
        F.max(F.when(is_top, F.col("category"))).alias("leader"),
        percent(F.max("top"), F.max("total_revenue")).alias("leader_pct"),
        F.when(others >= F.max("top"), below + 1).alias("smallest_to_match"),
    )


def product_headline(sales: DataFrame, pareto: DataFrame) -> DataFrame:
    """Active products and leading category of filtered sales; leader and top-fifth share of all.

    The top fifth is rounded to whole products, at least one.
    """
    revenue = sales.groupBy("category").agg(F.sum("amount").alias("revenue"))
    leader = revenue.agg(F.min_by("category", F.struct(-F.col("revenue"), "category")).alias("c")).scalar()
    products = sales.agg(F.count_distinct("product").alias("active_products"))
    size = pareto.agg(F.count(F.lit(1)).alias("n")).scalar()
    fifth = F.greatest(F.lit(1), F.round(size * F.lit("0.2").cast("decimal(2,1)"), 0).cast("long"))
    lead_product = pareto.filter("position = 1").select("product").scalar()
    at_fifth = (
        pareto.withColumn("fifth", fifth).filter("position = fifth").select("running_pct").scalar()
    )
    return products.select(
        "active_products", leader.alias("leading_category"), lead_product.alias("leading_product"),
        fifth.alias("top_products"), at_fifth.alias("top_share_pct"),
    )
