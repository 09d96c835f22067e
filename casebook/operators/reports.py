"""Quality and run reports over the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.schemas import CLOSED_STATUSES_OF_REPORT
from casebook.sources.search_results import cut


def _newest(df: DataFrame, moment: str, keys: list[str], n: int) -> DataFrame:
    return df.orderBy(F.col(moment).desc_nulls_last(), *keys).limit(n)


def recent_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    columns = ["job_name", "status", "records_read", "records_written", "started_at"]
    return _newest(runs, "started_at", ["run_id"], n).select("run_id", *columns)


def recent_projects(projects: DataFrame, n: int = 20) -> DataFrame:
    return _newest(projects, "imported_at", ["project_id"], n).select("project_id", "project_no", "project_name", "status")


def recent_documents(documents: DataFrame, n: int = 20, preview_chars: int | None = None) -> DataFrame:
    return _newest(documents, "imported_at", ["document_id"], n).select(
        "document_id", "title", cut(F.col("text_preview"), preview_chars).alias("preview")
    )


def recent_mappings(document_map: DataFrame, n: int = 20) -> DataFrame:
    return _newest(document_map, "classified_at", ["project_id", "document_id"], n).select(
        "project_id", "document_id", "confidence_score", "classifier_reason"
    )


def docs_per_source(documents: DataFrame) -> DataFrame:
    return documents.groupBy("source_system").agg(F.count(F.lit(1)).alias("docs"))


def mapped_docs_report(document_map: DataFrame, projects: DataFrame) -> DataFrame:
    """Map rows per project with number and name; counted before the join, so one row per project moves."""
    counts = document_map.groupBy("project_id").agg(F.count(F.lit(1)).alias("mapped_docs"))
    return counts.join(projects.select("project_id", "project_no", "project_name"), "project_id", "left").orderBy(
        F.col("mapped_docs").desc(), "project_id"
    )


def runs_of_job(runs: DataFrame, job_name: str, n: int = 50) -> DataFrame:
    columns = ["job_name", "status", "records_read", "records_written", "error_message", "started_at"]
    return _newest(runs.filter(F.col("job_name") == job_name), "started_at", ["run_id"], n).select("run_id", *columns)


def duplicate_mappings(document_map: DataFrame) -> DataFrame:
    return (
        document_map.groupBy("project_id", "document_id")
        .agg(F.count(F.lit(1)).alias("duplicate_count"))
        .filter("duplicate_count > 1")
        .orderBy(F.col("duplicate_count").desc(), "project_id", "document_id")
    )


def status_counts(projects: DataFrame) -> DataFrame:
    return projects.groupBy("status").agg(F.count(F.lit(1)).alias("projects")).orderBy(
        F.col("projects").desc(), F.col("status").asc_nulls_first()
    )


def mapped_active_projects(document_map: DataFrame, projects: DataFrame, n: int = 20) -> DataFrame:
    """Open projects (a future one counts as open here) with their number of mapped documents."""
    counts = document_map.groupBy("project_id").agg(F.count("document_id").alias("mapped_document_count"))
    still_open = projects.filter(~F.lower(F.col("status").cast("string")).isin(*CLOSED_STATUSES_OF_REPORT))
    return still_open.join(counts, "project_id").orderBy(F.col("mapped_document_count").desc(), "project_id").limit(n)
