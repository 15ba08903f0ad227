"""Every query against its SQL on the smallest tables, and the analytics on edge cases."""

import oracle_check
import pytest
from scenarios import SCENARIOS, write_tables

import __spark_entry__ as contract
from balcao.plans.catalog import QUERIES

SMALL = "/root/testdata/sf0.001"
ANALYTICS = [
    "churn_monthly", "kpi_monthly", "active_90d", "rfm", "cohort_retention", "retention_curve", "top_decile_share",
    "purchase_intervals", "interval_share", "pareto", "product_metrics", "category_mom", "yoy", "describe_sales",
    "price_outliers", "pearson_items", "spearman_items", "forecast_table", "forecast_metrics", "kpi_vs_previous", "season_extremes",
    "category_leader", "product_headline", "product_highlights", "revenue_peak",
]
# Queries that may have nothing to report on a scenario.
MAY_BE_EMPTY = {"churn_monthly", "product_highlights"}


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name):
    assert oracle_check.difference(spark, oracle_check.connect(SMALL), name, SMALL) is None


@pytest.mark.parametrize("scenario", list(SCENARIOS))
def test_analytics_on_edge_cases(spark, tmp_path, scenario):
    folder = write_tables(tmp_path / scenario, SCENARIOS[scenario]())
    con = oracle_check.connect(folder)
    found = {n: oracle_check.difference(spark, con, n, folder) for n in ANALYTICS}
    wrong = {n: d for n, d in found.items() if d and not (n in MAY_BE_EMPTY and d == "no rows")}
    assert not wrong


@pytest.mark.parametrize("partitions", ["1", "23"])
def test_same_result_for_any_partition_count(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        con = oracle_check.connect(SMALL)
        for name in ("rfm", "pareto", "describe_sales", "spearman_items", "kpi_monthly", "dim_product"):
            assert oracle_check.difference(spark, con, name, SMALL) is None, name
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
