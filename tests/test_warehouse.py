"""Month pruning over a stored fact."""

import datetime as dt
from pathlib import Path

import plans
import pytest

from balcao.operators import selection
from balcao.plans import load
from balcao.plans.registry import DATASETS, filtered_view
from balcao.sources.driver_tables import load_sales
from balcao.sources.staged import sales_house
from balcao.sources.warehouse import Warehouse

SMALL = "/root/testdata/sf0.001"
CHOSEN = selection.Selection(dt.date(2000, 3, 15), dt.date(2000, 5, 2))


@pytest.fixture(scope="module")
def house(spark):
    return sales_house(spark, SMALL, load.store_sales)


def files_of(house: Warehouse, first: str, last: str) -> int:
    folder = Path(house.path("fact_sales").removeprefix("file:"))
    return sum(len(list(m.glob("*.parquet"))) for m in folder.iterdir() if f"sale_month={first}" <= m.name <= f"sale_month={last}")


@pytest.mark.parametrize("name", [n for n, d in DATASETS.items() if selection.PERIOD in d.axes])
def test_a_period_opens_only_its_month_folders(spark, house, name):
    sales = load.sales_of(house)
    first = "0000" if DATASETS[name].looks_back else "2000-03-01"
    with plans.fixed_plans(spark):
        view = filtered_view(name, sales, CHOSEN, [selection.PERIOD])
        plan = view._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(sale_month" in plan
        opened = plans.metric(house.read("fact_sales"), "FileSourceScanExec", "numFiles")
        dims = sum(plans.metric(house.read(t), "FileSourceScanExec", "numFiles") for t in ("dim_calendar", "dim_customer", "dim_product", "dim_location"))
        read = plans.metric(view, "FileSourceScanExec", "numFiles")
    scans = plan.count("sale_month=") or plan.count("PartitionFilters: [isnotnull(sale_month")
    fact = files_of(house, first, "2000-05-01")
    assert 0 < fact < opened and fact <= read <= scans * (fact + dims)
    assert view.exceptAll(filtered_view(name, load_sales(spark, SMALL), CHOSEN, [selection.PERIOD])).count() == 0


def test_month_bounds_from_days_and_texts():
    assert selection.first_of_month(dt.date(999, 7, 31)) == dt.date(999, 7, 1)
    assert selection.first_of_month("2024-02") == dt.date(2024, 2, 1)
    assert selection.first_of_month(None) is None


def test_months_without_folders_are_tested_by_day(spark):
    sales = load_sales(spark, SMALL, "sale_date")
    kept = selection.in_months(sales, "2000-02", "2000-02").agg({"sale_date": "min"}).first()[0], selection.in_months(sales, None, dt.date(2000, 2, 1)).agg({"sale_date": "max"}).first()[0]
    assert kept[0] >= dt.date(2000, 2, 1) and dt.date(2000, 2, 1) < kept[1] <= dt.date(2000, 2, 29)
    by_month = load_sales(spark, SMALL, "year_month")
    assert {r[0] for r in selection.in_months(by_month, "2000-02", "2000-03").distinct().collect()} == {"2000-02", "2000-03"}
    assert selection.in_months(sales.select(), None, None).count() == sales.count()
