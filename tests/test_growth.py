"""Work that grows with the tables is done once: feeds, dimensions, judged rows, the monthly state."""

import datetime as dt
from decimal import Decimal

import pytest
from plans import fixed_plans, metric
from pyspark.sql import functions as F
from scenarios import hot_customer, write_tables

from balcao import vocab
from balcao.operators import quality, star
from balcao.plans import catalog, load
from balcao.sources import staged
from balcao.sources.driver_tables import dirty_feed

SALES = ("txn_id string, order_id string, sale_date date, customer_id string, product string, category string, city string, "
         "state string, country string, quantity int, unit_price decimal(12,2), payment_method string, status string, ordinal long")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _sales(spark):
    rows = [[f"t{i}", f"o{i // 2}", dt.date(2024, 1 + i % 5, 3), f"c{i % 7}", f"p{i % 3}", "k", "x", "y", "z", 1 + i % 2,
             Decimal(10 + i), "PIX", vocab.DELIVERED, i] for i in range(40)]
    for i, column in ((3, 2), (5, 3), (8, 4), (9, 5), (12, 6), (13, 7), (14, 8)):
        rows[i][column] = None
    return spark.createDataFrame(rows, SALES)


def test_a_census_makes_only_its_columns_and_stages_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staged, "_STAGED", {})
    folder = write_tables(tmp_path / "t", hot_customer())
    for name, unread in (("money_forms", "p_name"), ("unmatched_dates", "p_name"), ("null_census", "RoundRobin"), ("reject_reason", "RoundRobin")):
        assert unread not in _plan(catalog.QUERIES[name](spark, folder))
    assert not staged._STAGED


def test_wide_feed_rows_are_not_moved(spark, tmp_path):
    folder = write_tables(tmp_path / "t", hot_customer())
    assert "RoundRobin" not in _plan(dirty_feed(spark, folder))
    monthly = catalog.QUERIES["dim_calendar"](spark, folder)
    assert monthly.count() > 0


@pytest.mark.parametrize("name, columns", [
    ("dim_calendar", ["txn_id", "sale_date", "ordinal"]),
    ("dim_customer", ["txn_id", "customer_id", "ordinal"]),
    ("dim_product", ["txn_id", "product", "category", "ordinal"]),
    ("dim_location", ["txn_id", "city", "state", "country", "ordinal"]),
    ("generated_amount", ["txn_id", "unit_price", "quantity", "ordinal"]),
    ("dedup_keep_first", [*quality.CLEAN_COLUMNS, "ordinal"]),
    ("split_accepted", [*quality.CLEAN_COLUMNS, "ordinal"]),
    ("status_domain", ["txn_id", "status", "ordinal"]),
])
def test_accepted_rows_are_judged_once_and_no_wider_than_read(spark, tmp_path, monkeypatch, name, columns):
    monkeypatch.setattr(staged, "_STAGED", {})
    folder = write_tables(tmp_path / "t", hot_customer())
    calls, tables, tag = [], {}, quality.tag
    monkeypatch.setattr(quality, "tag", lambda *a: calls.append(1) or tag(*a))
    for module in (quality, catalog):
        monkeypatch.setattr(module, "written", lambda df, label, write=module.written: tables.update({label: df.columns}) or write(df, label))
    assert catalog.QUERIES[name](spark, folder).count() > 0
    assert not staged._STAGED and len(calls) == 1 and tables["valid"] == columns and "accepted" not in tables


def test_violations_of_a_feed_judge_its_rows_once_and_join_none(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staged, "_STAGED", {})
    folder = write_tables(tmp_path / "t", hot_customer())
    calls, labels, tag, write = [], [], quality.tag, catalog.written
    monkeypatch.setattr(quality, "tag", lambda *a: calls.append(1) or tag(*a))
    monkeypatch.setattr(catalog, "written", lambda df, label: labels.append(label) or write(df, label))
    found = {r["constraint"]: r["violations"] for r in catalog.QUERIES["constraint_violations_dirty"](spark, folder).collect()}
    assert not staged._STAGED and len(calls) == 1 and labels == ["tagged", "accepted"]
    rows = tag(dirty_feed(spark, folder)).select("clean.*")
    assert found["customer orphan"] == rows.filter("customer_id is null").count() > 0 and found["customer repeated"] == 0


def test_census_of_repeats_moves_only_rows_that_may_repeat(spark, tmp_path):
    ids = [f"t{i}" for i in range(2000)] + ["t7", "t7", "", "", None, None]
    others = [c for c in vocab.STAGING_COLUMNS if c != "txn_id"]
    feed = spark.createDataFrame([(i,) for i in ids], "txn_id string").select("txn_id", *[F.lit("x").alias(c) for c in others])
    feed.write.parquet(str(tmp_path / "feed"))
    feed = spark.read.parquet(str(tmp_path / "feed"))
    found = quality.duplicate_census(feed)
    assert found.columns == [*vocab.STAGING_COLUMNS, "copies"]
    assert sorted((r["txn_id"], r["copies"]) for r in found.collect()) == [("", 2)] * 2 + [("t7", 3)] * 3
    with fixed_plans(spark):
        assert metric(quality.duplicate_census(feed), "ShuffleExchangeExec", "shuffleRecordsWritten") < 100
    assert quality.duplicate_census(feed.filter("txn_id > 't8'")).count() == 0


def test_fact_is_not_moved_for_small_dimensions(spark, tmp_path):
    path = str(tmp_path / "accepted")
    _sales(spark).write.parquet(path)
    with fixed_plans(spark):
        assert "SortMergeJoin" not in _plan(load.star_from(spark.read.parquet(path))["fact_sales"])


def test_report_unfolds_three_facts_a_row(spark, tmp_path):
    folder = write_tables(tmp_path / "t", hot_customer())
    feed = dirty_feed(spark, folder).localCheckpoint()
    n = feed.count()
    with fixed_plans(spark):
        assert metric(quality.load_report(quality.tag(feed)), "GenerateExec", "numOutputRows") < 6 * n


def test_a_load_judges_its_rows_once(spark, tmp_path, monkeypatch):
    feed = tmp_path / "feed.csv"
    texts = ["1", "o", "2024-01-02", "c", "p", "k", "9.5", "2", "a/b/c", "PIX", "Entregue"]
    feed.write_text("\n".join([",".join(vocab.RAW_HEADERS), *(",".join([str(i // 2), *texts[1:]]) for i in range(8))]) + "\n")
    calls, tag = [], quality.tag
    monkeypatch.setattr(quality, "tag", lambda rows: calls.append(1) or tag(rows))
    counts = load.run_load(spark, str(feed), str(tmp_path / "house"))
    assert (counts["staging"], counts["fact_sales"], counts["duplicates"]) == (8, 4, 4) and len(calls) == 1


def test_state_is_made_of_the_rows_of_the_enriched_fact(spark, tmp_path):
    path = str(tmp_path / "sales")
    _sales(spark).write.parquet(path)
    sales = spark.read.parquet(path)
    told = star.in_cells(sales)
    joined = load.enriched(load.star_from(sales)).select(*told.columns)
    assert joined.schema.simpleString() == told.schema.simpleString()
    assert sorted(map(str, told.collect())) == sorted(map(str, joined.collect())) and told.count() == 33
