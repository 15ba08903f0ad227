"""Warehouse tables on Parquet: one folder per table and version, published together."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao import vocab
from balcao.session import save
from balcao.sources.files import Files

TABLES = [
    "staging", "quarantine", "dim_calendar", "dim_customer", "dim_product", "dim_location",
    "fact_sales", "load_report", "monthly_forecast", "model_metrics",
    "sales_cube", "dim_order", "order_months", "customer_history",
]
#: What is stored of every month besides the items.
STATE = ["sales_cube", "dim_order", "order_months", "customer_history"]


class Superseded(RuntimeError):
    """Another refresh published the same tables meanwhile."""


class Warehouse:
    """Readers and writers of one warehouse folder.

    Each refresh writes its tables to folders of a new version and publishes
    them together as the next numbered manifest, which names the version of
    every table. A manifest is complete before it gets its number, and a number
    is given once: of two refreshes that publish at a time, one takes the next
    number and the other tries again, or gives up if its tables were replaced
    since it began. No clock decides. A failed load leaves the last manifest.

    A warehouse opened ``at`` a manifest reads those versions throughout.
    """

    def __init__(self, spark: SparkSession, root: str, at: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.at = at
        self.files = Files(spark, self.root)

    @staticmethod
    def new_version() -> str:
        return uuid.uuid4().hex

    def folder(self, table: str, version: str) -> str:
        if table not in TABLES:
            raise KeyError(f"unknown table {table}")
        return f"{self.root}/{table}/{version}"

    # ---- manifests ------------------------------------------------------------

    def _numbers(self) -> list[int]:
        return [int(name[: -len(".json")]) for name in self.files.list(f"{self.root}/manifest") if name.endswith(".json")]

    def _manifest(self, number: int) -> dict:
        return json.loads(self.files.read(f"{self.root}/manifest/{number:012d}.json"))

    def newest(self) -> int:
        """The number of the newest manifest; 0 before the first."""
        return max(self._numbers(), default=0)

    def versions(self, number: int | None = None) -> dict[str, str]:
        """The version of every table in a manifest: ``number``, else the one opened, else the newest."""
        number = number if number is not None else self.at if self.at is not None else self.newest()
        return self._manifest(number)["tables"] if number else {}

    def snapshot(self) -> Warehouse:
        """This warehouse as it is now, whatever is published later."""
        return Warehouse(self.spark, self.root, self.newest())

    def publish(self, version: str, tables: list[str], base: int | None = None) -> int:
        """Publish tables of ``version`` together; returns the manifest's number.

        With ``base``, the newest manifest when the refresh began, it fails if one
        of the tables was replaced since: what was read then is out of date.
        """
        known = self.versions(base) if base is not None else None
        while True:
            number = self.newest()
            held = self.versions(number)
            if known is not None and any(held.get(t) != known.get(t) for t in tables):
                raise Superseded(f"{', '.join(tables)} published since manifest {base}")
            manifest = {"tables": {**held, **dict.fromkeys(tables, version)}, "published": time.time()}
            draft = f"{self.root}/manifest/draft-{uuid.uuid4().hex}"
            self.files.write(draft, json.dumps(manifest))
            if self.files.claim(draft, f"{self.root}/manifest/{number + 1:012d}.json"):
                return number + 1
            self.files.remove(draft)

    def path(self, table: str) -> str:
        """Folder of the published version."""
        version = self.versions().get(table)
        if version is None:
            raise ValueError(f"{table} was never published in {self.root}")
        return self.folder(table, version)

    # ---- readers and expiry ---------------------------------------------------

    @contextmanager
    def reading(self, hours: float = 24) -> Iterator[Warehouse]:
        """A snapshot whose files no expiry removes while it is open, at most ``hours``."""
        lease = f"{self.root}/readers/{uuid.uuid4().hex}"
        while True:
            house = self.snapshot()
            self.files.write(lease, json.dumps({"manifest": house.at, "until": time.time() + 3600 * hours}))
            if house.at in self._numbers() or not house.at:  # else it was expired before the lease was seen
                break
        try:
            yield house
        finally:
            self.files.remove(lease)

    def expire(self, grace: float = 86_400) -> list[str]:
        """Remove the folders that no manifest in use names; returns them.

        In use are the newest manifest, those that were the newest within ``grace``
        seconds, and those that a reader has open. Folders of no manifest at all
        may belong to a refresh at work and stay, unless they are named by a
        manifest that goes now.
        """
        now, numbers = time.time(), sorted(self._numbers())
        held = {n: self._manifest(n) for n in numbers}
        used = set(numbers[-1:])
        used |= {n for n, after in zip(numbers, numbers[1:]) if now - held[after]["published"] < grace}
        for name in self.files.list(f"{self.root}/readers"):
            lease = json.loads(self.files.read(f"{self.root}/readers/{name}"))
            if lease["until"] > now:
                used.add(lease["manifest"])
        kept = {(t, v) for n in used if n in held for t, v in held[n]["tables"].items()}
        gone = {(t, v) for n in numbers if n not in used for t, v in held[n]["tables"].items()} - kept
        for number in numbers:
            if number not in used:
                self.files.remove(f"{self.root}/manifest/{number:012d}.json")
        folders = [self.folder(t, v) for t, v in sorted(gone)]
        for folder in folders:
            self.files.remove(folder)
        return folders

    # ---- tables ---------------------------------------------------------------

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def store(self, table: str, df: DataFrame, version: str) -> DataFrame:
        """Write a table of an unpublished version; returns it as stored."""
        save(self.spark, df.write, self.folder(table, version))
        return self.spark.read.parquet(self.folder(table, version))

    def store_fact(self, fact: DataFrame, version: str) -> DataFrame:
        """Fact by month folders; a test on ``sale_month`` opens only those of the period.

        The rebalance hint lets the engine split a month that holds much of the
        data over several files and merge small ones.
        """
        by_month = fact.withColumn("sale_month", F.trunc("sale_date", "MM")).hint("rebalance", "sale_month")
        save(self.spark, by_month.write.partitionBy("sale_month"), self.folder("fact_sales", version))
        return self.spark.read.parquet(self.folder("fact_sales", version))

    def replace(self, **tables: DataFrame) -> None:
        """Store and publish tables together."""
        version, base = self.new_version(), self.newest()
        for name, df in tables.items():
            self.store(name, df, version)
        self.publish(version, list(tables), base)


def quarantine_records(rejected: DataFrame) -> DataFrame:
    """Rejected rows whole as JSON, NULL fields kept, with reason and stage; a malformed line as its text."""
    record = F.to_json("raw", {"ignoreNullFields": "false"})
    if "malformed" in rejected.columns:
        line = F.to_json(F.struct(F.col("malformed").alias("line")))
        record = F.when(F.col("malformed").isNotNull(), line).otherwise(record)
    return rejected.select(
        record.alias("record"),
        "reason",
        F.lit(vocab.STAGE).alias("stage"),
    )


def layer_counts(staging: DataFrame, fact: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Rows per layer."""
    layers = {"staging": staging, "fact": fact, "quarantine": quarantine}
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("layer"), "n_rows")
        for name, df in layers.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])
