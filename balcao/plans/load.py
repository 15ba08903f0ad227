"""The full-refresh load: CSV -> staging -> validation -> star schema -> forecast."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao.operators import forecast, quality, star, state
from balcao.session import lasting, passing, settled, written
from balcao.sources.files import Files
from balcao.sources.raw import read_raw_sales, stage
from balcao.sources.warehouse import STATE, Warehouse, quarantine_records


DIMENSIONS = ("dim_customer", "dim_product", "dim_location")


def dimensions(accepted: DataFrame) -> dict[str, DataFrame]:
    """Dimensions of accepted rows, which should be a written table."""
    return {
        "dim_calendar": star.dim_calendar(accepted),
        "dim_customer": star.dim_customer(accepted),
        "dim_product": star.dim_product(accepted),
        "dim_location": star.dim_location(accepted),
    }


def written_dimensions(accepted: DataFrame) -> dict[str, DataFrame]:
    """Dimensions, those with keys written before anything joins them.

    A plan's guess of their size is so large that a fact would be moved by a few places.
    """
    tables = dimensions(accepted)
    return tables | {name: written(tables[name], name) for name in DIMENSIONS}


def star_from(accepted: DataFrame) -> dict[str, DataFrame]:
    """Dimensions and fact from accepted rows, which should be a written table."""
    tables = written_dimensions(accepted)
    return {**tables, "fact_sales": star.load_fact(accepted, *(tables[name] for name in DIMENSIONS))}


def enriched(tables: dict[str, DataFrame]) -> DataFrame:
    """The enriched sales view over star tables."""
    return star.sales_enriched(
        tables["fact_sales"], tables["dim_calendar"], tables["dim_customer"],
        tables["dim_product"], tables["dim_location"],
    )


def keyed_fact(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """The fact that ``make`` gives, with its sale keys; only the numbered rows stay.

    The fact is written before it is sorted, so what its joins moved is gone by then.
    """
    with passing(spark):
        fact = settled(spark, "fact", make)
        with lasting():
            return star.add_sale_key(fact)


def run_load(
    spark: SparkSession, csv_path: str, root: str, multi_line: bool = False, sale_keys: bool = True, keep_feed: bool = True
) -> dict[str, int]:
    """Replace the whole warehouse from a CSV feed; returns the run summary.

    ``sale_keys`` numbers the fact rows in feed order, which sorts the fact;
    without it the enriched sales have no ``sale_key``. ``keep_feed=False`` is for
    an export made for this load alone, which is removed once it is staged.

    Rows are typed and judged once and written, for quarantine, report and accepted
    rows; those are written once too, and feed all dimensions, the fact and the
    monthly state. Each such table is removed when the last that is made of it is written.
    Nothing is published before the counts balance, nor if another load was
    published since this one began.
    """
    house = Warehouse(spark, root)
    version, base = house.new_version(), house.newest()
    staged = house.folder("staging", version)
    with passing(spark):
        stage(read_raw_sales(spark, csv_path, multi_line), staged)
    if not keep_feed:
        Files(spark, csv_path).remove(csv_path)
    stored, kept = {"staging": spark.read.parquet(staged)}, []

    def judged() -> DataFrame:
        tagged = written(quality.tag(stored["staging"]), "tagged")
        records = quarantine_records(quality.rejected(tagged)).withColumn("created_at", F.current_timestamp())
        stored["quarantine"] = house.store("quarantine", records, version)
        stored["load_report"] = house.store("load_report", quality.load_report(tagged), version)
        return quality.accepted_of(tagged)

    def joined() -> DataFrame:
        accepted = settled(spark, "accepted", judged)
        kept.append(accepted.count())
        for name, table in dimensions(accepted).items():
            stored[name] = house.store(name, table, version)
        store_state(house, star.in_cells(accepted), version)
        return star.load_fact(accepted, *(stored[name] for name in DIMENSIONS))

    with passing(spark):
        fact = keyed_fact(spark, joined) if sale_keys else settled(spark, "fact", lambda: joined().drop("ordinal"))
        stored["fact_sales"] = house.store_fact(fact, version)
    counts = summary(stored, *kept)
    house.publish(version, [*stored, *STATE], base)
    return counts


def state_of(sales: DataFrame, numbers: DataFrame) -> dict[str, DataFrame]:
    return {
        "sales_cube": state.sales_cube(sales), "order_months": state.order_months(sales, numbers),
        "customer_history": state.customer_history(sales),
    }


def store_state(house: Warehouse, sales: DataFrame, version: str) -> None:
    """Write the monthly state of all ``sales``, unpublished."""
    numbers = house.store("dim_order", state.order_numbers(sales), version)
    for name, df in state_of(sales, numbers).items():
        house.store(name, df, version)


def extend_state(house: Warehouse, sales: DataFrame) -> None:
    """Publish the monthly state with further ``sales`` merged in; items that are in it are not read again."""
    version, before = house.new_version(), house.snapshot()
    numbers = house.store("dim_order", state.order_numbers(sales, before.read("dim_order")), version)
    merge = {"sales_cube": state.merge_cubes, "order_months": state.merge_orders, "customer_history": state.merge_histories}
    for name, df in state_of(sales, numbers).items():
        house.store(name, merge[name](before.read(name), df), version)
    house.publish(version, STATE, before.at)


def summary(stored: dict[str, DataFrame], kept: int) -> dict[str, int]:
    """Row counts of the written tables, which come from file footers, for ``kept`` accepted rows.

    Staged rows that were neither quarantined nor accepted are duplicates. The
    load fails unless every accepted row found its keys and reached the fact.
    """
    tables = ("staging", "fact_sales", "quarantine", "dim_customer", "dim_product", "dim_location")
    counts = {name: stored[name].count() for name in tables}
    counts["duplicates"] = counts["staging"] - counts["quarantine"] - kept
    if counts["fact_sales"] != kept or counts["duplicates"] < 0:
        raise RuntimeError(f"load does not balance: {kept} accepted rows, {counts}")
    return counts


def store_sales(house: Warehouse, sales: DataFrame) -> None:
    """Replace the star tables by clean sales, as a load does with accepted rows."""
    version, base = house.new_version(), house.newest()
    stored = {}

    def joined() -> DataFrame:
        rows = written(sales, "sales")
        stored.update({name: house.store(name, table, version) for name, table in dimensions(rows).items()})
        store_state(house, star.in_cells(rows), version)
        return star.load_fact(rows, *(stored[d] for d in DIMENSIONS))

    with passing(house.spark):
        stored["fact_sales"] = house.store_fact(settled(house.spark, "fact", joined), version)
    house.publish(version, [*stored, *STATE], base)


def sales_of(house: Warehouse) -> DataFrame:
    """The enriched sales view over the stored star tables.

    It has the fact's ``sale_month`` besides, by which ``filtered_view`` and
    ``in_months`` prune the month folders.
    """
    names = ("dim_calendar", "dim_customer", "dim_product", "dim_location", "fact_sales")
    house = house if house.at is not None else house.snapshot()  # tables of one load, whatever is published meanwhile
    return enriched({name: house.read(name) for name in names})


def run_model(house: Warehouse) -> None:
    """Replace the forecast and metrics tables from the stored sales."""
    store_model(house, forecast.model_of(sales_of(house)))


def store_model(house: Warehouse, model: forecast.Forecast) -> None:
    house.replace(monthly_forecast=model.table(), model_metrics=model.metrics())


def forecast_view(house: Warehouse) -> DataFrame:
    """The stored forecast, column by column."""
    return house.read("monthly_forecast").select(
        "series", "year_month", "actual", "fitted", "forecast", "band_low", "band_high", "phase"
    )


def metrics_view(house: Warehouse) -> DataFrame:
    """The stored model metrics, column by column."""
    return house.read("model_metrics").select("series", "model", "mae", "mape", "r2")
