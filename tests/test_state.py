"""The stored monthly state: merged month by month, read instead of the items."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from balcao.operators import kpis, selection, state
from balcao.plans import load
from balcao.plans.registry import DATASETS, filtered_view, stored_view
from balcao.sources.driver_tables import load_sales
from balcao.sources.staged import sales_house
from balcao.sources.warehouse import STATE, TABLES, Warehouse

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def house(spark):
    return sales_house(spark, SMALL, load.store_sales)


def rows(df):
    return sorted(map(str, df.collect()))


def figures(house):
    """What follows from the state, whatever numbers the orders have."""
    cube, orders, history = (house.read(t) for t in ("sales_cube", "order_months", "customer_history"))
    return [rows(d) for d in (
        cube.select(sorted(cube.columns)), history, state.kpi_monthly(cube, orders, history), state.status_summary(cube, orders),
        state.distinct_orders(orders, *state.CELL), state.monthly_orders(cube, orders, "category"),
    )]


def test_merged_parts_equal_a_full_build(spark, house, tmp_path):
    """Parts that share months, customers, orders and cells."""
    sales = load_sales(spark, SMALL)
    day = F.col("sale_date")
    parts = [day < "1997-06-15", (day >= "1997-06-15") & (day < "1999-01-01"), (day >= "1999-01-01") & (F.col("quantity") < 20),
             (day >= "1999-01-01") & (F.col("quantity") >= 20)]
    own = Warehouse(spark, str(tmp_path / "own"))
    version = own.new_version()
    load.store_state(own, sales.filter(parts[0]), version)
    own.publish(version, STATE)
    for part in parts[1:]:
        load.extend_state(own, sales.filter(part))
    assert figures(own) == figures(house)
    numbers = own.read("dim_order").agg(F.min("order_key"), F.max("order_key"), F.count_distinct("order_key"), F.count_distinct("order_id")).first()
    assert numbers[0] == 1 and numbers[1] == numbers[2] == numbers[3]
    load.extend_state(own, sales.limit(0))
    assert figures(own) == figures(house)


def test_activity_of_the_history_equals_that_of_the_items(spark, house):
    ours = state.activity(house.read("customer_history")).drop("revenue")
    theirs = kpis.customer_activity(load_sales(spark, SMALL, "customer_id", "sale_date", "status", "amount")).select(ours.columns)
    assert rows(ours) == rows(theirs)


def test_history_spans_many_words(spark):
    """Months far apart, before and after a multiple of 64, and a year below 1000."""
    days = [dt.date(980, 2, 28), dt.date(980, 3, 1), dt.date(985, 6, 1), dt.date(985, 7, 30), dt.date(2024, 2, 29), dt.date(2024, 2, 3)]
    sales = spark.createDataFrame([("c", d, "Entregue") for d in days], "customer_id string, sale_date date, status string")
    history = state.customer_history(sales)
    assert history.first()["first_month"] == 980 * 12 + 1 and len(history.first()["active"]) == (2024 - 980) * 12 // 64 + 1
    assert [r["last_sale"] for r in state.activity(history).orderBy("last_sale").collect()] == sorted(days)[:4] + [dt.date(2024, 2, 29)]
    halves = [state.customer_history(sales.filter(f"day(sale_date) % 2 = {i}")) for i in (0, 1)]
    assert state.merge_histories(*halves).collect() == history.collect()


def tables_read(df):
    return {name for name in TABLES for f in df.inputFiles() if f"/{name}/" in f}


@pytest.mark.parametrize("name", [n for n, d in DATASETS.items() if d.axes])
def test_which_table_is_read(spark, house, name):
    chosen = selection.Selection(dt.date(1999, 3, 15), dt.date(2000, 5, 2), ("PROMO",), (), ("Entregue",))
    view = stored_view(house, name, chosen)
    read = tables_read(view)
    assert ("sales_cube" in read) == DATASETS[name].additive and ("fact_sales" in read) != DATASETS[name].additive
    assert rows(view) == rows(filtered_view(name, load_sales(spark, SMALL), chosen).select(view.columns))


def test_kpis_read_no_items(house):
    names = {"sales_cube", "order_months", "customer_history"}
    assert tables_read(state.kpi_monthly(*map(house.read, ("sales_cube", "order_months", "customer_history")))) == names
