"""Times the headline queries and prints one JSON line."""

import json
import os
import time

from balcao.plans.catalog import QUERIES
from balcao.plans.load import store_sales
from balcao.session import local_session
from balcao.sources.staged import sales_house, staged_feed

HEADLINE = [
    "kpi_monthly", "revenue_cube", "rfm", "top_decile_share", "cohort_retention", "retention_curve",
    "churn_monthly", "pareto", "product_metrics", "category_mom", "yoy", "describe_sales", "price_outliers",
    "purchase_intervals", "pearson_items", "spearman_items", "forecast_table", "model_metrics",
    "kpi_vs_previous", "category_ranking", "reject_reason", "split_accepted", "load_balance", "load_fact",
    "sales_enriched", "duplicate_census",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = local_session(cores, int(cores) if cores.isdigit() else 8)
    QUERIES["month_spine"](spark, sf_dir).collect()  # start the workers
    # The feed is staged and the warehouse loaded once, as a job finds them, and both timed by themselves.
    start = time.perf_counter()
    for clashing in (False, True):
        staged_feed(spark, sf_dir, clashing).count()
    staging = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    sales_house(spark, sf_dir, store_sales)
    loading = round(time.perf_counter() - start, 3)
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "staging": staging, "loading": loading,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
