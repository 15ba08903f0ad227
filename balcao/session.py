"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from balcao.sources.files import Files

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: The JVM never compiles a method beyond this size; wider generated stages run faster as separate operators.
METHOD_LIMIT, LARGEST_COMPILED = "spark.sql.codegen.hugeMethodLimit", "8000"
#: A job removes what it shuffled when it ends.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str = "8", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster the launcher builds it."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("balcao")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config(METHOD_LIMIT, LARGEST_COMPILED)
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def compiled(spark: SparkSession) -> None:
    """Let wide stages of this session run as compiled code, unless its launcher set the limit; results are the same."""
    if spark.conf.get(METHOD_LIMIT, "65535") == "65535":
        spark.conf.set(METHOD_LIMIT, LARGEST_COMPILED)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a temporary folder, because there the executors are this
    process.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="balcao-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for intermediate data in the shared folder, under the application id."""
    return f"{shared_dir(spark).rstrip('/')}/balcao-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


class _Step:
    """The tables written for a step, and the step around it."""

    def __init__(self, around: _Step | None = None):
        self.paths: list[str] = []
        self.around = around


_STEP: ContextVar[_Step | None] = ContextVar("step", default=None)


@contextmanager
def _in_step(step: _Step) -> Iterator[None]:
    token = _STEP.set(step)
    try:
        yield
    finally:
        _STEP.reset(token)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """A step that leaves no intermediate tables: those ``written`` inside are removed when it ends.

    No frame that outlives the step may read them, unless they were made ``lasting``.
    """
    step = _Step(_STEP.get())
    try:
        with _in_step(step):
            yield
    finally:
        for path in step.paths:
            Files(spark, path).remove(path)


@contextmanager
def lasting(always: bool = False) -> Iterator[None]:
    """Within a step: tables that outlive it. They go with the step around it, or stay if there is none or ``always``."""
    step = _STEP.get()
    around = step.around if step and not always else None
    with _in_step(around or _Step()):
        yield


def settled(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns, written; the tables it wrote on the way are removed."""
    with passing(spark):
        found = make()
        with lasting():
            return written(found, label)


def save(spark: SparkSession, writer: DataFrameWriter, path: str) -> None:
    """Write a Parquet table that takes little room, and remove what was shuffled for it as soon as it is written.

    Else shuffled files stay until the driver happens to collect its garbage. A
    table is planned by itself, so no other job reads them.
    """
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        writer.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage like a checkpoint, survives lost executors, and unlike one
    keeps column pruning, filter pushdown and true sizes for the readers. In a
    step (see ``passing``) it is removed with it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    step = _STEP.get()
    if step is None:
        df.write.parquet(path)
    else:
        step.paths.append(path)
        save(spark, df.write, path)
    return spark.read.schema(df.schema).parquet(path)
