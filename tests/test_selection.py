"""Selections, the filter contract, segments and empty input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from balcao import vocab
from balcao.operators import customers, forecast, kpis, products, selection, stats
from balcao.operators.ordered import number_rows, tile
from balcao.plans.registry import DATASETS, filtered_view
from balcao.sources.driver_tables import SALES_COLUMNS, load_sales

SMALL = "/root/testdata/sf0.001"
FIRST, LAST = dt.date(2024, 7, 3), dt.date(2026, 6, 30)


@pytest.mark.parametrize(
    "preset, want",
    [
        ("Tudo", (FIRST, LAST)),
        ("Últimos 30 dias", (dt.date(2026, 5, 31), LAST)),
        ("Últimos 90 dias", (dt.date(2026, 4, 1), LAST)),
        ("Últimos 180 dias", (dt.date(2026, 1, 1), LAST)),
        ("Ano corrente", (dt.date(2026, 1, 1), LAST)),
    ],
)
def test_presets_count_back_from_the_last_sale(preset, want):
    assert selection.resolve_period(preset, FIRST, LAST) == want


def test_custom_period():
    own = (dt.date(2025, 1, 1), dt.date(2025, 2, 1))
    assert selection.resolve_period("Personalizado", FIRST, LAST, own) == own
    with pytest.raises(ValueError):
        selection.resolve_period("Ontem", FIRST, LAST)


def test_default_selection_keeps_completed_statuses_that_exist(spark):
    sales = load_sales(spark, SMALL, "sale_date", "status")
    assert selection.default_selection(sales).statuses == ("Entregue", "Enviado")
    shipped = sales.filter(F.col("status") != "Entregue")
    assert selection.default_selection(shipped).statuses == ("Enviado",)


def test_datasets_refuse_filters_that_would_change_their_question(spark):
    sales = load_sales(spark, SMALL)
    own = selection.Selection(FIRST, LAST)
    with pytest.raises(ValueError, match="state"):
        filtered_view("category_mom", sales, own, ["period", "state"])
    with pytest.raises(ValueError, match="period"):
        filtered_view("pareto", sales, own, ["period"])
    assert DATASETS["kpi_monthly"].axes == ("period",)


def test_status_filter_reaches_a_stored_fact(spark, tmp_path, capsys):
    path = str(tmp_path / "sales")
    load_sales(spark, SMALL, "sale_date", "status", "category", "amount").write.parquet(path)
    own = selection.Selection(dt.date(1996, 1, 1), dt.date(1996, 2, 1), ("PROMO",), (), ("Entregue",))
    selection.apply_selection(spark.read.parquet(path), own).explain("formatted")
    plan = capsys.readouterr().out
    pushed = plan[plan.index("PushedFilters"):]
    assert all(f in pushed for f in ("GreaterThanOrEqual(sale_date", "EqualTo(category,PROMO", "EqualTo(status,Entregue"))


def test_every_score_pair_has_one_segment(spark):
    pairs = spark.range(25).select((F.col("id") % 5 + 1).alias("r"), (F.floor(F.col("id") / 5) + 1).alias("f"))
    got = {(x["r"], x["f"]): x["s"] for x in pairs.select("*", customers.segment_of(F.col("r"), F.col("f")).alias("s")).collect()}
    assert len(got) == 25 and set(got.values()) == {s[0] for s in vocab.SEGMENT_ACTIONS}
    assert [got[1, 1], got[2, 1], got[1, 2], got[2, 5], got[5, 1]] == [
        "Perdidos", "Prestes a dormir", "Em Risco", "Não pode perder", "Novos"]


@pytest.mark.parametrize("rows, tiles", [(1, 5), (3, 5), (5, 5), (7, 5), (23, 10), (580, 5)])
def test_tiles_match_ntile(spark, rows, tiles):
    sizes = [rows // tiles + (i < rows % tiles) for i in range(tiles)]
    want = [t + 1 for t, size in enumerate(sizes) for _ in range(size)]
    df = number_rows(spark.range(rows), [F.col("id")])
    got = df.select("id", tile(F.col("row_num"), F.col("n_rows"), tiles).alias("t")).orderBy("id").collect()
    assert [r["t"] for r in got] == want


def test_running_sums_carry_over_ranges(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 3).alias("g"), F.lit(2).cast("long").alias("x"))
    got = number_rows(df, [F.col("g"), F.col("id").desc()], running=("x",))
    bad = got.filter("run_x <> 2 * row_num or total_x <> 10000 or n_rows <> 5000")
    assert got.count() == 5000 and bad.count() == 0
    assert got.filter("row_num = 1").first()["id"] == 4998


def test_future_month_takes_its_own_effect(spark):
    """A series ending in June: July repeats July, whichever months are ahead."""
    rows = [("s", dt.date(2024 + i // 12, i % 12 + 1, 1), 100.0 + (50.0 if i % 12 == 6 else 0.0)) for i in range(30)]
    model = forecast.Forecast(spark.createDataFrame(rows, "series string, month_start date, y double"))
    ahead = {r["month_start"].month: r["forecast"] for r in model.projection().collect()}
    assert sorted(ahead) == [7, 8, 9, 10, 11, 12]
    assert ahead[7] == pytest.approx(150) and ahead[8] == pytest.approx(100)


def test_short_series_has_no_forecast(spark):
    rows = [("s", dt.date(2025, m, 1), float(m)) for m in range(1, 11)]
    model = forecast.Forecast(spark.createDataFrame(rows, "series string, month_start date, y double"))
    assert [r["forecast"] for r in model.projection().collect()] == [None] * 6
    errors = {r["model"]: r["mae"] for r in model.metrics().collect()}
    assert errors["regressao"] is None and errors["media_movel"] is not None


def test_empty_sales(spark):
    sales = load_sales(spark, SMALL).limit(0)
    assert sales.columns == SALES_COLUMNS
    for build in (kpis.kpi_monthly, kpis.active_status, customers.rfm, customers.cohort_retention, products.pareto,
                  customers.retention_curve, products.product_metrics, stats.price_outliers):
        assert build(sales).count() == 0
    assert customers.purchase_intervals(sales).first()["n_intervals"] == 0
    assert customers.top_decile_share(sales).first()[0] is None
