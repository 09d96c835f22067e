"""Which projects to work on and which documents belong to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casebook.schemas import CLOSED_STATUSES


def _newest_first(projects: DataFrame, limit: int | None) -> DataFrame:
    """The newest `limit` projects; all of them, in no order, without a limit."""
    if limit is None:
        return projects
    return projects.orderBy(F.col("start_date").desc_nulls_last(), "project_id").limit(limit)


def open_projects(projects: DataFrame) -> DataFrame:
    """Projects whose status is stated and not a closed one."""
    return projects.filter(~F.lower(F.col("status").cast("string")).isin(*CLOSED_STATUSES))


def active_projects(projects: DataFrame, limit: int | None = None) -> DataFrame:
    return _newest_first(open_projects(projects), limit)


def all_projects(projects: DataFrame, limit: int | None = None) -> DataFrame:
    return _newest_first(projects, limit)


def projects_for_processing(projects: DataFrame, mode: str = "active", limit: int | None = None) -> DataFrame:
    return all_projects(projects, limit) if mode.lower() == "all" else active_projects(projects, limit)


def _best_links(links: DataFrame, documents: DataFrame, best, ties: list[str], k: int | None) -> DataFrame:
    """Best link of every (project, document), then the k best of every project (all without k), numbered from 1.

    Only link columns and document keys take part, so no document text moves through the windows.
    Both `row_number` filters become group limits that cut every group before its shuffle, which
    keeps a hot project or a hot pair to k rows (or one) per input partition.
    """
    # An inner join lets few links be the small side; copies of a document id would fall to `nth = 1`.
    existing = links.join(documents.select("document_id"), "document_id")
    per_pair = Window.partitionBy("project_id", "document_id").orderBy(best, *ties)
    per_project = Window.partitionBy("project_id").orderBy(best, "document_id")
    ranked = (
        existing.withColumn("nth", F.row_number().over(per_pair))
        .filter("nth = 1")
        .drop("nth")
        .withColumn("position", F.row_number().over(per_project))
    )
    return ranked if k is None else ranked.filter(F.col("position") <= k)


def candidate_links(candidates: DataFrame, documents: DataFrame, k: int | None = None) -> DataFrame:
    """The k best-ranked candidate documents of every project, keys only."""
    links = candidates.select("project_id", "document_id", "rank", "discovery_query")
    return _best_links(links, documents, F.col("rank").asc(), ["discovery_query"], k).select(
        "project_id",
        "document_id",
        F.col("rank").alias("candidate_rank"),
        F.col("discovery_query").alias("candidate_query"),
        "position",
    )


def candidates_per_project(candidates: DataFrame, documents: DataFrame, k: int | None = None) -> DataFrame:
    """The k best-ranked candidate documents of every project with all document columns."""
    return candidate_links(candidates, documents, k).join(documents, "document_id")


def mapped_links(document_map: DataFrame, documents: DataFrame, k: int | None = None) -> DataFrame:
    """The k most confident mapped documents of every project, keys only."""
    links = document_map.select("project_id", "document_id", "confidence_score")
    return _best_links(links, documents, F.col("confidence_score").desc_nulls_last(), [], k)


def documents_per_project(document_map: DataFrame, documents: DataFrame, k: int | None = None) -> DataFrame:
    """The k most confident mapped documents of every project with all document columns."""
    return mapped_links(document_map, documents, k).join(documents, "document_id")


def mapped_project_counts(document_map: DataFrame, limit: int | None = None) -> DataFrame:
    """Map rows per project, most first; duplicates in the append-only map count."""
    counts = (
        document_map.groupBy("project_id")
        .agg(F.count(F.lit(1)).alias("mapped_document_count"))
        .filter("mapped_document_count > 0")
    )
    return counts if limit is None else counts.orderBy(F.col("mapped_document_count").desc(), "project_id").limit(limit)
