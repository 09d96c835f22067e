"""Structured Streaming ingestion of landed record pages into the projects table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from casebook.functions.text import safe_date
from casebook.operators.upsert import Rule, upsert
from casebook.schemas import PROJECTS, RECORD_PAGES
from casebook.sources.durable import remove, scratch, settle, tidy
from casebook.sources.landed import first_seen, raw_projects

#: A stored version: projects, the pull they were last read by, and their place in it (status order, page, position).
VERSION = T.StructType(
    [
        *PROJECTS.fields,
        T.StructField("pull_id", T.StringType()),
        T.StructField(
            "pull_order",
            T.StructType(
                [T.StructField("status_ord", T.LongType()), T.StructField("page", T.LongType()), T.StructField("pos", T.LongType())]
            ),
        ),
    ]
)


def start_ingest(
    spark: SparkSession,
    landing: str,
    versions: str,
    progress: str,
    statuses: Sequence[str],
    normalize: Callable[[DataFrame], DataFrame],
    as_of: datetime,
    files_per_batch: int | None = None,
    pull_id: str = "pull",
    small_source: bool = True,
) -> StreamingQuery:
    """Upsert every page that landed since the last run, then stop.

    Each micro-batch writes a new version of the table below `versions`, named after the batch and
    built on the newest one before it. A batch that is run again overwrites its own version from
    the same base, so a restart after a lost driver gives the same table; versions before that base
    are removed. Copies of a project inside one pull keep the first in pull order, whichever batch
    brings it, as the batch run does; a later `pull_id` replaces what earlier pulls stored.
    """
    reader = spark.readStream.schema(RECORD_PAGES)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def upsert_batch(pages: DataFrame, batch_id: int) -> None:
        session = pages.sparkSession
        base = max((n for n in finished_versions(session, versions) if n < batch_id), default=None)
        target = session.createDataFrame([], VERSION) if base is None else _version(session, versions, base)
        with scratch(session), tidy(session):
            first = settle(first_seen(raw_projects(pages, statuses)), "landed-records")
            place = F.struct(*[F.col(c).cast("long").alias(c) for c in ("status_ord", "page", "pos")])
            places = first.select(F.col("id").cast("string").alias("scoro_id"), place.alias("pull_order"))
            batch = settle(normalize(first).join(places, "scoro_id").withColumn("pull_id", F.lit(pull_id)), "landed-projects")
            stored = target.filter(F.col("pull_id") == pull_id).select("project_id", F.col("pull_order").alias("before"))
            newer = settle(
                batch.join(stored, "project_id", "left")
                .filter(F.col("before").isNull() | (F.col("pull_order") < F.col("before")))
                .drop("before"),
                "projects-to-store",
            )
            now = F.lit(as_of).cast("timestamp")
            dated = newer.withColumns({c: safe_date(F.col(c).cast("string")) for c in ("start_date", "due_date")})
            # Written once because the upsert reads it three times, so that the large table need not shuffle.
            merged = upsert(target, dated, ["project_id"], VERSION, {"imported_at": Rule(now, now)}, small_source)
            merged.write.mode("overwrite").parquet(f"{versions}/batch={batch_id}")
        for old in finished_versions(session, versions):
            if base is not None and old < base:
                remove(session, f"{versions}/batch={old}")

    return (
        reader.json(landing)
        .writeStream.foreachBatch(upsert_batch)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )


def _folder(spark: SparkSession, path: str):
    """Hadoop's file system and path object of a folder, in whatever store it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def finished_versions(spark: SparkSession, versions: str) -> list[int]:
    """Numbers of the completely written versions, from the listing alone."""
    fs, place = _folder(spark, versions)
    if not fs.exists(place):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(place)]
    numbers = [int(name.removeprefix("batch=")) for name in names if name.startswith("batch=")]
    return sorted(n for n in numbers if fs.exists(_folder(spark, f"{versions}/batch={n}/_SUCCESS")[1]))


def _version(spark: SparkSession, versions: str, number: int) -> DataFrame:
    return spark.read.schema(VERSION).parquet(f"{versions}/batch={number}")


def newest_version(spark: SparkSession, versions: str) -> DataFrame:
    """The table as of the last finished micro-batch; only its files are read."""
    finished = finished_versions(spark, versions)
    if not finished:
        return spark.createDataFrame([], PROJECTS)
    return _version(spark, versions, finished[-1]).select(*PROJECTS.names)
