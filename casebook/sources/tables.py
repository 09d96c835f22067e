"""Reading stored tables under the current schema, point lookups, appends and the run log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.functions.text import filled
from casebook.schemas import RUNS
from casebook.sources.durable import CODEC, tidy
from casebook.sources.search_results import cut


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A table without rows that the optimizer knows to be empty, so a merge into it neither joins nor shuffles its source."""
    return spark.createDataFrame([], schema).limit(0)


def align_to_schema(df: DataFrame, schema: T.StructType, fill_text: bool = True) -> DataFrame:
    """Read any version of a table under one schema: columns it lacks become typed NULLs.

    With `fill_text`, missing text reads as the empty string; zero and false stay what they are.
    """
    present = set(df.columns)
    selected = []
    for wanted in schema.fields:
        value = F.col(wanted.name) if wanted.name in present else F.lit(None)
        value = value.cast(wanted.dataType)
        if fill_text and isinstance(wanted.dataType, T.StringType):
            value = F.coalesce(value, F.lit(""))
        selected.append(value.alias(wanted.name))
    return df.select(*selected)


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if f.name not in df.columns]


def project_by_id(projects: DataFrame, project_id: str) -> DataFrame:
    return projects.filter(F.col("project_id") == project_id).limit(1)


def projects_by_ids(projects: DataFrame, ids: DataFrame) -> DataFrame:
    return projects.join(ids.select("project_id"), "project_id", "left_semi")


def append_rows(rows: DataFrame, path: str) -> None:
    """Append a batch; a failing row fails the write and an empty batch adds nothing."""
    with tidy(rows.sparkSession):
        rows.write.mode("append").option("compression", CODEC).parquet(path)


def run_log(runs: DataFrame, message_chars: int | None = None) -> DataFrame:
    """Rows of the run log: an empty message is NULL, a long one cut if asked, missing counts are 0."""
    aligned = align_to_schema(runs, RUNS, fill_text=False)
    return aligned.withColumns(
        {
            "records_read": F.coalesce("records_read", F.lit(0).cast("bigint")),
            "records_written": F.coalesce("records_written", F.lit(0).cast("bigint")),
            "error_message": cut(filled(F.col("error_message")), message_chars),
        }
    )


def run_entry(
    spark: SparkSession,
    job_name: str,
    run_id: str,
    started_at: datetime,
    finished_at: datetime,
    status: str,
    records_read: int = 0,
    records_written: int = 0,
    error_message: str | None = None,
    message_chars: int | None = None,
) -> DataFrame:
    """The one run-log row of a step."""
    row = (run_id, job_name, started_at, finished_at, status, records_read, records_written, error_message)
    return run_log(spark.createDataFrame([row], RUNS), message_chars)
