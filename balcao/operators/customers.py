"""RFM, cohorts, revenue concentration and purchase intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from balcao import vocab
from balcao.functions.dates import months_apart, year_month
from balcao.functions.exact import percent, ratio
from balcao.operators.cuts import Tiles, distribution
from balcao.operators.kpis import completed, customer_activity, stored_activity
from balcao.session import written

SCORES = [1, 2, 3, 4, 5]


def rfm_base(sales: DataFrame) -> DataFrame:
    """Recency in days before the last sale of all, distinct orders and revenue per customer."""
    base = completed(sales)
    last = base.agg(F.max("sale_date").alias("d")).scalar()
    return (
        base.groupBy("customer_id")
        .agg(
            F.max("sale_date").alias("last_sale"),
            F.count_distinct("order_id").alias("frequency"),
            F.sum("amount").alias("monetary"),
        )
        .select("customer_id", F.datediff(last, "last_sale").alias("recency_days"), "frequency", "monetary")
    )


def rfm_scores(sales: DataFrame) -> DataFrame:
    """Quintiles of recency, frequency and monetary, 5 the best; ties by customer id.

    The customers are written once; their scores are a projection of them.
    """
    base = written(rfm_base(sales), "customers")
    orders = {"score_r": -F.col("recency_days"), "score_f": F.col("frequency"), "score_m": F.col("monetary")}
    tiles = Tiles(base, orders, "customer_id", 5)
    return base.withColumns({name: tiles.of(name) for name in orders})


def segment_of(r: Column, f: Column) -> Column:
    """Segment name from the recency and frequency scores, first match wins."""
    return (
        F.when((r >= 4) & (f >= 4), vocab.CHAMPIONS)
        .when((r >= 4) & (f >= 2), vocab.POTENTIAL_LOYAL)
        .when(r >= 4, vocab.NEW)
        .when((r == 3) & (f >= 4), vocab.LOYAL)
        .when((r == 3) & (f >= 2), vocab.NEED_ATTENTION)
        .when(r == 3, vocab.PROMISING)
        .when(f >= 4, vocab.CANNOT_LOSE)
        .when(f >= 2, vocab.AT_RISK)
        .when(r == 2, vocab.ABOUT_TO_SLEEP)
        .otherwise(vocab.LOST)
    )


def rfm(sales: DataFrame) -> DataFrame:
    """Scores and segment, one row per customer."""
    return rfm_scores(sales).withColumn("segment", segment_of(F.col("score_r"), F.col("score_f")))


def segment_summary(segments: DataFrame) -> DataFrame:
    """Customers and revenue per segment, from ``rfm``."""
    return segments.groupBy("segment").agg(
        F.count("customer_id").alias("customers"), F.sum("monetary").alias("revenue")
    )


def segment_actions(segments: DataFrame) -> DataFrame:
    """Every segment with its rule, suggested action, customers and revenue."""
    spark = segments.sparkSession
    lookup = spark.createDataFrame(vocab.SEGMENT_ACTIONS, "segment string, rule string, action string")
    summary = segment_summary(segments)
    # The summary has at most one row per segment name.
    return lookup.join(F.broadcast(summary), "segment", "left").select(
        "segment", "rule", "action",
        F.coalesce("customers", F.lit(0).cast("long")).alias("customers"),
        F.coalesce("revenue", F.lit(0).cast("decimal(24,2)")).alias("revenue"),
    )


def rfm_grid(segments: DataFrame) -> DataFrame:
    """Customers per frequency score (rows) and recency score (columns), zeros filled."""
    counts = segments.groupBy("score_f").pivot("score_r", SCORES).agg(F.count(F.lit(1)))
    rows = segments.sparkSession.range(1, 6).select(F.col("id").cast("int").alias("score_f"))
    filled = rows.join(counts, "score_f", "left").fillna(0)
    return filled.select("score_f", *[F.col(str(r)).alias(f"r{r}") for r in SCORES])


def rfm_points(segments: DataFrame) -> DataFrame:
    """Recency and monetary per customer, three segments highlighted."""
    return segments.select(
        "customer_id", "recency_days", "monetary",
        F.when(F.col("segment").isin(vocab.HIGHLIGHT_SEGMENTS), F.col("segment"))
        .otherwise(vocab.OTHER_SEGMENTS).alias("highlight"),
    )


def top_decile_share(sales: DataFrame) -> DataFrame:
    """Share of revenue from the best tenth of customers, one row."""
    per_customer = completed(sales).groupBy("customer_id").agg(F.sum("amount").alias("revenue"))
    stored = written(per_customer, "customers")
    best = Tiles(stored, {"best": -F.col("revenue")}, "customer_id", 10, upto=1).of("best") == 1
    return stored.agg(
        percent(F.sum(F.when(best, F.col("revenue"))), F.sum("revenue")).alias("top_decile_pct")
    )


def _cohort_cells(activity: DataFrame) -> DataFrame:
    """Customers active per cohort and months since; the cohort's size is its month 0."""
    return (
        activity.groupBy(
            F.col("first_month").alias("cohort_start"),
            months_apart(F.col("month_start"), F.col("first_month")).alias("months_since"),
        )
        .agg(F.count(F.lit(1)).alias("retained"))
    )


def cohort_retention(sales: DataFrame) -> DataFrame:
    """Per first-purchase month and months since: customers back that month; empty cells absent."""
    return cohorts_in(customer_activity(sales))


def cohorts_in(activity: DataFrame) -> DataFrame:
    cohort = Window.partitionBy("cohort_start")
    size = F.max(F.when(F.col("months_since") == 0, F.col("retained"))).over(cohort)
    return (
        _cohort_cells(activity)
        .withColumn("cohort_size", size)
        .select(
            year_month("cohort_start").alias("cohort"), "months_since", "cohort_size", "retained",
            percent(F.col("retained"), F.col("cohort_size")).alias("retained_pct"),
        )
    )


def cohort_rows(cells: DataFrame) -> DataFrame:
    """``cohort_retention`` with one row per cohort: how many months it has and ``month=percentage`` of each, in order."""
    cell = F.struct("months_since", F.concat_ws("=", "months_since", F.col("retained_pct").cast("decimal(9,1)")).alias("told"))
    return cells.groupBy("cohort").agg(F.sort_array(F.collect_list(cell)).alias("cells")).select(
        "cohort", F.size("cells").cast("long").alias("n_months"), F.array_join("cells.told", " ").alias("retained")
    )


def cohort_matrix(cells: DataFrame) -> DataFrame:
    """``cohort_retention`` wide: one row per cohort, one column per months since."""
    span = cells.agg(F.max("months_since").alias("m")).first()["m"]
    months = list(range((-1 if span is None else span) + 1))
    wide = cells.groupBy("cohort").pivot("months_since", months).agg(F.first("retained_pct"))
    return wide.select("cohort", *[F.col(str(m)).alias(f"m{m}") for m in months]).orderBy("cohort")


def retention_curve(sales: DataFrame) -> DataFrame:
    """Mean retention by months since, weighted by cohort size.

    Every month a cohort could have been seen counts, with zero where nobody
    came back. Month 0 holds the cohort's size and unfolds it over that span,
    so one pass over the cells adds both sums.
    """
    return curve_in(stored_activity(sales))


def curve_in(activity: DataFrame) -> DataFrame:
    last = activity.agg(F.max("month_start").alias("m")).scalar()
    start = F.col("months_since") == 0
    span = F.sequence(F.lit(0), months_apart(last, F.col("cohort_start")))
    steps = _cohort_cells(activity).withColumn(
        "at", F.explode(F.when(start, span).otherwise(F.array("months_since")))
    )
    size = F.sum(F.when(start, F.col("retained")))
    seen = F.sum(F.when(F.col("at") == F.col("months_since"), F.col("retained")).otherwise(0))
    return (
        steps.groupBy(F.col("at").alias("months_since"))
        .agg(size.alias("size"), seen.alias("seen"))
        .select("months_since", percent(F.col("seen"), F.col("size")).alias("mean_pct"))
    )


def customer_headline(kpis: DataFrame, top_decile: DataFrame) -> DataFrame:
    """Mean active, new, revenue per active customer of the chosen months; top-decile share."""
    return kpis.agg(
        F.round(F.sum("active_customers").cast("decimal(24,2)") / F.count(F.lit(1)), 4)
        .cast("decimal(24,4)").alias("mean_active"),
        F.sum("new_customers").alias("new_customers"),
        ratio(F.sum("revenue"), F.sum("active_customers"), 2).alias("avg_ticket_per_customer"),
    ).withColumn("top_decile_pct", top_decile.scalar())


def _gaps(sales: DataFrame) -> DataFrame:
    """Days between a customer's purchase dates.

    Two orders on one day give a gap of zero, which no report keeps, so dates
    are made distinct first and a customer is never larger than the calendar.
    """
    own = Window.partitionBy("customer_id").orderBy("sale_date")
    return (
        completed(sales).select("customer_id", "sale_date").distinct()
        .select(F.datediff("sale_date", F.lag("sale_date").over(own)).alias("gap_days"))
        .filter("gap_days > 0")
    )


def purchase_intervals(sales: DataFrame) -> DataFrame:
    """Distribution of the gaps, one row even without gaps."""
    gaps = written(_gaps(sales), "gaps").select(F.lit("gap_days").alias("metric"), "gap_days")
    probs = {"median": (1, 2), "p75": (3, 4), "p90": (9, 10), "p95": (19, 20)}
    spread = distribution(gaps, ["metric"], "gap_days", probs)
    metrics = sales.sparkSession.createDataFrame([("gap_days",)], "metric string")
    return metrics.join(spread, "metric", "left").select(
        F.coalesce("n", F.lit(0).cast("long")).alias("n_intervals"), F.col("minimum").cast("int"), "median", "mean",
        "p75", "p90", "p95", F.col("maximum").cast("int"),
    )


def interval_share(sales: DataFrame, days: int = vocab.CHURN_DAYS) -> DataFrame:
    """Share of gaps of at most ``days`` days, one row."""
    return _gaps(sales).agg(
        percent(F.count_if(F.col("gap_days") <= days), F.count(F.lit(1))).alias("share_pct")
    )
