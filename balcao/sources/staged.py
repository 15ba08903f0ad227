"""The driver tables as a job finds them: the feed in a staging table, the sales in a warehouse.

Both are written once per application and folder, in as many files as the last
join has tasks; wide rows are not moved for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from balcao.session import scratch_path
from balcao.sources.driver_tables import dirty_feed, load_sales
from balcao.sources.warehouse import Warehouse

_STAGED: dict[tuple, str] = {}


def once(spark: SparkSession, what: str, sf_dir: str, write) -> str:
    """The path of ``what`` made from ``sf_dir``; ``write(path)`` makes it the first time."""
    key = (spark.sparkContext.applicationId, what, sf_dir)
    if key not in _STAGED:
        path = scratch_path(spark, what)
        write(path)
        _STAGED[key] = path
    return _STAGED[key]


def staged_feed(spark: SparkSession, sf_dir: str, clashing_ids: bool = False) -> DataFrame:
    """The raw feed as a staging table."""
    def write(path: str) -> None:
        dirty_feed(spark, sf_dir, clashing_ids).write.parquet(path)

    return spark.read.parquet(once(spark, "feed-clashing" if clashing_ids else "feed", sf_dir, write))


def sales_house(spark: SparkSession, sf_dir: str, store) -> Warehouse:
    """The clean sales in a warehouse, by month folders; ``store(house, sales)`` fills it."""
    return Warehouse(spark, once(spark, "sales-house", sf_dir, lambda path: store(Warehouse(spark, path), load_sales(spark, sf_dir))))
