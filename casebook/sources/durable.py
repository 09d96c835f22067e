"""Cutting a long lineage with a table in the shared folder of the cluster."""

from __future__ import annotations

import contextlib
import contextvars
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: Written tables stay until a run is over; zstd files take about two thirds of the default's space.
CODEC = "zstd"

#: With this a write removes its shuffle files when it ends; else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_scopes: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("scopes", default=())


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are settled inside are removed at its end, but for the lasting ones, which belong to the scope around it.

    What is read later must be settled as lasting, or not rest on what was settled inside.
    """
    held = _scopes.set((*_scopes.get(), []))
    try:
        yield
    finally:
        places = _scopes.get()[-1]
        _scopes.reset(held)
        for place in places:
            remove(spark, place)


def remove(spark: SparkSession, place: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Writes inside remove their shuffle files when they end."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="casebook-")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; in local mode one of our own where it names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.conf.get("spark.master").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _own_folder()
    return folder.rstrip("/")


def new_place(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/casebook/{name}-{uuid.uuid4().hex}"


def settle_counted(df: DataFrame, name: str, lasting: bool = False) -> tuple[DataFrame, int]:
    """`settle`, and the number of rows, counted while they are written."""
    seen = Observation(name)
    written = settle(df.observe(seen, F.count(F.lit(1)).alias("rows")), name, lasting)
    return written, int(seen.get["rows"])


def settle(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """Write a step's result once and go on from the written table.

    Unlike `checkpoint()`, this computes the step a single time and leaves columnar files, so the
    readers prune columns and executors lost later never force the step to run again. Inside `scratch` the
    table goes with the scope, or if `lasting` with the one around it; without one it stays.
    """
    place = new_place(df.sparkSession, name)
    scopes = _scopes.get()[: -1 if lasting else None]
    if scopes:
        scopes[-1].append(place)
    with tidy(df.sparkSession):
        df.write.option("compression", CODEC).parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)
