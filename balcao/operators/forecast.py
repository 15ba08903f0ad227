"""Monthly revenue forecasts for many series at once.

A series is all rows sharing ``series``. Each holds at most one row per
calendar month, so every window here is short; the work spreads over series.
The regression is least squares on an intercept, a trend and month-of-year
effects. Demeaning by month of year removes the effects, which leaves one
slope in closed form and the effects as month means minus the trend.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from balcao import vocab
from balcao.functions.dates import year_month
from balcao.operators.kpis import monthly_series
from balcao.session import written

MONEY = "decimal(24,2)"


def settled(value: Column) -> Column:
    """Money rounded half up, with float noise below six places dropped first.

    Means of whole cents often end in exactly half a cent, where the order of
    a floating-point sum would decide the rounding.
    """
    return value.cast("decimal(30,6)").cast(MONEY)


def revenue_series(sales: DataFrame, *keys: str) -> DataFrame:
    """Monthly completed revenue as (series, month_start, y); one series without ``keys``.

    ``series`` joins the keys by ``/``. A slash or backslash inside a key is marked
    by a backslash and NULL is written ``\\N``, so different keys stay different.
    """
    marked = [F.coalesce(F.regexp_replace(F.col(k), r"([/\\])", r"\\$1"), F.lit(r"\N")) for k in keys]
    name = F.concat_ws("/", *marked) if keys else F.lit("total")
    return monthly_series(sales, *keys).select(
        name.alias("series"), "month_start", F.col("revenue").cast("double").alias("y")
    )


def series_index(series: DataFrame) -> DataFrame:
    """Add t = 0.. by month, the month of year and the points after each row."""
    in_time = Window.partitionBy("series").orderBy("month_start")
    size = F.count(F.lit(1)).over(Window.partitionBy("series"))
    return (
        series.withColumn("t", F.row_number().over(in_time) - 1)
        .withColumn("points_after", (size - F.col("t") - 1).cast("int"))
        .withColumn("month", F.month("month_start"))
    )


def temporal_split(indexed: DataFrame, test_points: int = vocab.TEST_POINTS) -> DataFrame:
    """The last ``test_points`` points are test, the rest train."""
    return indexed.withColumn(
        "phase", F.when(F.col("points_after") < test_points, vocab.TEST).otherwise(vocab.TRAIN)
    )


def moving_average(points: DataFrame, width: int = 3) -> DataFrame:
    """Add ``baseline``: mean of the ``width`` points before, NULL if there are fewer."""
    before = Window.partitionBy("series").orderBy("t").rowsBetween(-width, -1)
    full = F.count("y").over(before) == width
    return points.withColumn("baseline", F.when(full, F.avg("y").over(before)))


def fit_trend_seasonal(points: DataFrame) -> DataFrame:
    """Slope and month effect per (series, month).

    NULL slope where no month of year repeats: the trend cannot be told from
    the effects. A month never seen has no row, hence no prediction.
    """
    same_month = Window.partitionBy("series", "month")
    centred = points.select(
        "series", "month", "t", "y",
        (F.col("t") - F.avg("t").over(same_month)).alias("dt"),
        (F.col("y") - F.avg("y").over(same_month)).alias("dy"),
    )
    months = centred.groupBy("series", "month").agg(
        F.avg("t").alias("mean_t"), F.avg("y").alias("mean_y"),
        F.sum(F.col("dt") * F.col("dy")).alias("sty"), F.sum(F.col("dt") * F.col("dt")).alias("stt"),
    )
    whole = Window.partitionBy("series")
    slope = F.sum("sty").over(whole) / F.nullif(F.sum("stt").over(whole), F.lit(0.0))
    return months.withColumn("slope", slope).select(
        "series", "month", "slope", (F.col("mean_y") - F.col("slope") * F.col("mean_t")).alias("effect")
    )


def predict(points: DataFrame, fit: DataFrame, name: str) -> DataFrame:
    """Add the fitted value of (series, month, t) as ``name``."""
    value = F.col("effect") + F.col("slope") * F.col("t")
    return points.join(fit, ["series", "month"], "left").withColumn(name, value).drop("effect", "slope")


class Forecast:
    """One evaluated and projected forecast over all series of a frame.

    Builds only lazy plans; the indexed points are the shared start.
    """

    def __init__(
        self, series: DataFrame, test_points: int = vocab.TEST_POINTS, horizon: int = vocab.HORIZON
    ):
        self.horizon = horizon
        self.points = moving_average(temporal_split(series_index(series), test_points))
        train = self.points.filter(F.col("phase") == vocab.TRAIN)
        test = self.points.filter(F.col("phase") == vocab.TEST)
        self.train = train
        self.test = predict(test, fit_trend_seasonal(train), "fitted")

    def _errors(self, model: str, column: str) -> DataFrame:
        """MAE, MAPE (%) and R2 of one model on the test points of each series."""
        residual = F.col("y") - F.col(column)
        whole = Window.partitionBy("series")
        rows = self.test.select(
            "series", "y", residual.alias("e"), (F.col("y") - F.avg("y").over(whole)).alias("dy")
        )
        sums = rows.groupBy("series").agg(
            (F.count("e") == F.count("y")).alias("complete"),
            F.avg(F.abs("e")).alias("mae"),
            (F.avg(F.abs(F.try_divide("e", "y"))) * 100).alias("mape"),
            F.sum(F.col("e") * F.col("e")).alias("sse"),
            F.sum(F.col("dy") * F.col("dy")).alias("sst"),
        )
        # A constant test series scores 1 when hit exactly, else 0.
        r2 = F.when(F.col("sst") > 0, 1 - F.try_divide("sse", "sst")).otherwise(
            F.when(F.col("sse") == 0, 1.0).otherwise(0.0)
        )

        def known(value: Column) -> Column:
            return F.when(F.col("complete"), value)

        return sums.select(
            "series", F.lit(model).alias("model"),
            settled(known(F.col("mae"))).alias("mae"),
            known(F.col("mape")).cast("decimal(18,4)").alias("mape"),
            known(r2).cast("decimal(18,4)").alias("r2"),
        )

    def metrics(self) -> DataFrame:
        """Two rows per series: moving average and regression."""
        return self._errors(vocab.MOVING_AVERAGE, "baseline").unionByName(
            self._errors(vocab.REGRESSION, "fitted")
        )

    def band(self) -> DataFrame:
        """Half width of the forecast band per series: 1.96 deviations of the test residuals."""
        residual = F.col("y") - F.col("fitted")
        return self.test.groupBy("series").agg(
            (F.lit(vocab.BAND_SIGMAS) * F.stddev_samp(residual)).alias("width")
        )

    def projection(self) -> DataFrame:
        """The next months from a fit on the whole series, with the band.

        The band is constant over the horizon. A month of year takes its own
        effect, whatever other months are projected.
        """
        ends = self.points.filter("points_after = 0").select(
            "series", "month_start", "t", F.explode(F.sequence(F.lit(1), F.lit(self.horizon))).alias("step")
        )
        ahead = ends.select(
            "series",
            F.add_months("month_start", F.col("step")).alias("month_start"),
            (F.col("t") + F.col("step")).alias("t"),
        ).withColumn("month", F.month("month_start"))
        return (
            predict(ahead, fit_trend_seasonal(self.points), "forecast")
            .join(self.band(), "series", "left")
            .select(
                "series", "month_start", "forecast",
                (F.col("forecast") - F.col("width")).alias("band_low"),
                (F.col("forecast") + F.col("width")).alias("band_high"),
            )
        )

    def table(self) -> DataFrame:
        """Train, test and future rows of every series."""
        nothing = F.lit(None).cast(MONEY)

        def rows(df: DataFrame, phase: str, **given: str) -> DataFrame:
            values = [
                (settled(F.col(given[c])) if c in given else nothing).alias(c)
                for c in ("actual", "fitted", "forecast", "band_low", "band_high")
            ]
            month = year_month("month_start").alias("year_month")
            return df.select("series", month, *values, F.lit(phase).alias("phase"))

        return (
            rows(self.train, vocab.TRAIN, actual="y")
            .unionByName(rows(self.test, vocab.TEST, actual="y", fitted="fitted"))
            .unionByName(
                rows(
                    self.projection(), vocab.FUTURE,
                    forecast="forecast", band_low="band_low", band_high="band_high",
                )
            )
        )


def model_of(sales: DataFrame, *keys: str) -> Forecast:
    """The forecast of the monthly series, which are few rows against the sales and read by several branches."""
    return Forecast(written(revenue_series(sales, *keys), "series"))


def next_month_headline(table: DataFrame, metrics: DataFrame) -> DataFrame:
    """Per series the first future month with its band and the regression's errors."""
    own = Window.partitionBy("series").orderBy("year_month")
    first = (
        table.filter(F.col("phase") == vocab.FUTURE)
        .withColumn("_n", F.row_number().over(own)).filter("_n = 1")
        .select("series", "year_month", "forecast", "band_low", "band_high")
    )
    regression = metrics.filter(F.col("model") == vocab.REGRESSION).select("series", "mae", "mape", "r2")
    return first.join(regression, "series")
