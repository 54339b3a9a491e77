"""Session helpers: where shared scratch data goes and how a local session is tuned."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from threading import Lock
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

_local_scratch: dict[str, str] = {}

_FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing: WeakKeyDictionary[SparkSession, tuple[int, str]] = WeakKeyDictionary()  # writes under way, and the setting before them
_lock = Lock()


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("epidw")
        .config("spark.driver.memory", os.environ.get("EPIDW_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def tune(spark: SparkSession) -> SparkSession:
    """Settings the wide projections need, at the level of the running session.

    Projections over some forty text columns compile to methods above the 8,000
    bytecodes that HotSpot is willing to compile; past this limit Spark splits the
    projection into small methods instead, which runs about twice as fast.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, private to this application.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where
    driver and executors share one disk, may fall back to a temporary folder.
    """
    application = spark.sparkContext.applicationId
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return f"{configured.rstrip('/')}/epidw/{application}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if application not in _local_scratch:
        _local_scratch[application] = tempfile.mkdtemp(prefix="run-epidw-")
    return _local_scratch[application]


def literal_rows(spark: SparkSession, schema: T.StructType, rows: Sequence[tuple]) -> DataFrame:
    """A frame of a few configured rows, made of literals in one partition."""
    structs = [
        F.struct(*(F.lit(value).cast(field.dataType).alias(field.name) for field, value in zip(schema, row)))
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes issued within give their shuffle files back when they end, not when the driver happens to collect its garbage.

    Only for writes, whose plan runs once. Blocks of several threads may overlap; the last to end restores the setting.
    """
    with _lock:
        writes, before = _writing.get(spark, (0, None))
        if not writes:
            before = spark.conf.get(_FILE_CLEANUP, "false")
            spark.conf.set(_FILE_CLEANUP, "true")
        _writing[spark] = writes + 1, before
    try:
        yield
    finally:
        with _lock:
            writes, before = _writing[spark]
            _writing[spark] = writes - 1, before
            if writes == 1:
                spark.conf.set(_FILE_CLEANUP, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and carry on from the written files.

    A lost executor then costs a re-read, never a recomputation, and two passes
    over the result are guaranteed to see the same rows in the same partitions.
    """
    path = f"{shared_folder(df.sparkSession)}/scratch/{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
