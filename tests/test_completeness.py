"""Nothing is lost: old years, years below 1000, and series of odd keys."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from balcao.operators import forecast, selection
from balcao.plans import catalog

CUBE = "year_month string, year int, month int, category string, state string, status string, revenue decimal(14,2)"


def test_seasonality_has_every_year(spark):
    rows = [(f"{y:04d}-05", y, 5, "c", "s", "Entregue", Decimal(y)) for y in (999, 1500, 2020, 2021, 2022, 2023)]
    cube = spark.createDataFrame(rows, CUBE)
    assert {r.year for r in selection.seasonality(cube).collect()} == {999, 1500, 2020, 2021, 2022, 2023}
    whole = selection.apply_selection(cube, selection.Selection(None, None))
    assert whole.count() == 6
    early = selection.Selection(dt.date(999, 1, 1), dt.date(1600, 1, 1))
    assert sorted(r.year for r in selection.apply_selection(cube, early).collect()) == [999, 1500]


def test_series_of_different_keys_stay_apart(spark):
    keys = [("a/b", "c"), ("a", "b/c"), (None, "S1"), ("S1", None), ("\\N", "S1"), ("a\\", "c"), ("a", "\\/c"), ("a\\/", "c")]
    rows = [(a, b, dt.date(2024, m, 1), Decimal(100 * i + m), "Entregue") for i, (a, b) in enumerate(keys) for m in range(1, 10)]
    schema = "category string, state string, sale_date date, amount decimal(14,2), status string"
    sales = spark.createDataFrame(rows, schema).withColumns({
        "txn_id": F.monotonically_increasing_id().cast("string"), "order_id": F.lit("o"), "customer_id": F.lit("k"),
        "quantity": F.lit(1), "year_month": F.date_format("sale_date", "yyyy-MM"),
    })
    series = forecast.series_index(forecast.revenue_series(sales, "category", "state"))
    assert series.select("series").distinct().count() == len(keys)
    assert series.count() == 9 * len(keys) and series.groupBy("series").agg(F.max("t").alias("t")).where("t <> 8").count() == 0


def test_queries_have_fixed_columns(spark):
    found = catalog.QUERIES["cohort_matrix"](spark, "/root/testdata/sf0.001")
    assert found.columns == ["cohort", "n_months", "retained"]


def test_fit_equals_least_squares_on_month_columns(spark):
    """The closed form against a regression on an intercept, the trend and eleven month columns."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rows = [("s", dt.date(2020 + i // 12, i % 12 + 1, 1), 100.0 + 3.5 * i + 20 * ((i * 7) % 5) - (i % 12) ** 2) for i in range(40)]
    points = forecast.series_index(spark.createDataFrame(rows, "series string, month_start date, y double"))
    ours = {r.month: (r.slope, r.effect) for r in forecast.fit_trend_seasonal(points).collect()}
    names = [f"m{m}" for m in range(2, 13)]
    columns = points.select("y", F.col("t").cast("double"), *[(F.col("month") == m).cast("double").alias(f"m{m}") for m in range(2, 13)])
    fit = LinearRegression(labelCol="y", solver="normal", standardization=False).fit(
        VectorAssembler(inputCols=["t", *names], outputCol="features").transform(columns))
    slope, *months = fit.coefficients
    for month, more in enumerate([0.0, *months], start=1):
        assert abs(ours[month][0] - slope) < 1e-6 and abs(ours[month][1] - fit.intercept - more) < 1e-5


def test_every_constraint_can_fail(spark):
    from balcao.operators import star

    day = dt.date(2024, 1, 1)
    fact = spark.createDataFrame(
        [("a", day, 1, 1, 1, 1, 1.0), ("a", day, 9, 1, 1, 0, 1.0), ("b", dt.date(2030, 1, 1), 1, 9, None, 1, -1.0)],
        "txn_id string, sale_date date, customer_key long, product_key long, location_key long, quantity int, unit_price double")
    customers = spark.createDataFrame([(1, "c"), (2, "c")], "customer_key long, customer_id string")
    products = spark.createDataFrame([(1, "p", "k"), (2, "p", "k")], "product_key long, product string, category string")
    places = spark.createDataFrame([(1, "x", "y", "z"), (2, "x", "y", "z")], "location_key long, city string, state string, country string")
    calendar = spark.createDataFrame([(day,)], "day date")
    found = star.constraint_violations(fact, calendar, customers, products, places).collect()
    assert len(found) == 10 and {r["violations"] for r in found} == {1}
