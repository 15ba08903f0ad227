"""What a job leaves on disk: no tables that only a step of it read, no shuffled files, no lines moved that stand for themselves."""

import os
import time

import pytest
from pyspark.sql import functions as F
from scenarios import hot_customer, write_tables

from balcao import session, vocab
from balcao.plans import catalog
from balcao.sources import raw, staged


def _left(spark, run):
    """Labels of the scratch tables that ``run`` leaves, and what it returns."""
    root = os.path.dirname(session.scratch_path(spark, "x")).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    found = run()
    return sorted(name.rsplit("-", 1)[0] for name in set(os.listdir(root)) - before), found


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    return write_tables(tmp_path_factory.mktemp("disk") / "t", hot_customer())


@pytest.mark.parametrize("name", [
    "selected_kpis", "stored_active_90d", "stored_series_by_place", "revenue_by_month", "category_leader"])
def test_a_house_is_all_that_its_build_leaves(spark, tables, monkeypatch, name):
    monkeypatch.setattr(staged, "_STAGED", {})
    left, found = _left(spark, lambda: catalog.QUERIES[name](spark, tables))
    # The leader ranks its categories after the house is built.
    assert left == (["placed", "sales-house"] if name == "category_leader" else ["sales-house"])
    assert found.collect() is not None


@pytest.mark.parametrize("name", ["load_pipeline", "layer_counts"])
def test_a_load_leaves_its_warehouse(spark, tables, name):
    left, found = _left(spark, lambda: catalog.QUERIES[name](spark, tables))
    assert left == ["warehouse"] and found.count() > 0


@pytest.mark.parametrize("name, kept", [
    ("load_fact", ["accepted", "dim_customer", "dim_location", "dim_product", "placed", "placed", "placed"]),
    ("fact_with_sale_key", ["placed"]),
    ("sales_enriched", ["dim_calendar", "dim_customer", "dim_location", "dim_product", "placed", "placed", "placed", "placed"]),
])
def test_star_queries_leave_what_their_result_reads(spark, tables, name, kept):
    left, found = _left(spark, lambda: catalog.QUERIES[name](spark, tables))
    assert left == kept and found.count() > 0


def _shuffled(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffled_files_go_with_the_write(spark, tmp_path):
    before, setting = _shuffled(spark), spark.conf.get(session.RELEASE, None)
    rows = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    session.save(spark, rows.write, str(tmp_path / "rows"))
    assert spark.conf.get(session.RELEASE, None) == setting
    until = time.time() + 20
    while _shuffled(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffled(spark) - before
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 100


def test_tables_of_a_step_go_also_when_it_fails(spark):
    def fail():
        with pytest.raises(ZeroDivisionError), session.passing(spark):
            with session.lasting():
                session.written(spark.range(3), "kept")
            with session.passing(spark), session.lasting():
                session.written(spark.range(3), "inner")
            1 / session.written(spark.range(3), "gone").filter("id > 5").count()

    assert _left(spark, fail)[0] == ["kept"]


def test_only_lines_of_records_of_several_move(spark, tmp_path, monkeypatch):
    fields = ["o", "2024-01-02", "c", "p", "k", "9.5", "2", "a/b/c", "PIX", "Entregue"]
    rows = [",".join([f"T{i}", *fields]) for i in range(3000)]
    rows[1500] = rows[1500].replace(",p,", ',"p\n1,2,3\nq",')
    (tmp_path / "feed.csv").write_text("\n".join([",".join(vocab.RAW_HEADERS), *rows]) + "\n")
    plans, sizes, write = {}, {}, raw.written

    def spied(df, label):
        if "line" in df.columns:
            plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        out = write(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(raw, "written", spied)
    found = raw.read_raw_sales(spark, str(tmp_path / "feed.csv"))
    assert found.filter("malformed is null").count() == 3000
    assert found.filter("txn_id = 'T1500'").first()["product"] == "p\n1,2,3\nq"
    assert not any("Window" in plan for plan in plans.values())
    assert sizes["torn-records"] < 10
