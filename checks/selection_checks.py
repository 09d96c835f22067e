"""Queries and reference SQL: project and document selection, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.operators import reports as rp
from casebook.operators import selection as sel
from checks.fixtures import fixture

# Small enough to cut real groups of the stand-ins.
TOP = 3


def _projects(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "fx_projects").withColumn("imported_at", F.col("imported_on").cast("timestamp"))


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "fx_documents").withColumn("imported_at", F.col("imported_on").cast("timestamp"))


def _map(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "fx_map").withColumn("classified_at", F.col("classified_on").cast("timestamp"))


def _day(name: str):
    return F.col(name).cast("string").alias(name)


def active_projects(spark: SparkSession, sf: str) -> DataFrame:
    return sel.active_projects(_projects(spark, sf), 100).select("project_id", "project_no", "status", _day("start_date"))


def all_projects(spark: SparkSession, sf: str) -> DataFrame:
    return sel.all_projects(_projects(spark, sf), 500).select("project_id", "project_no", "status", _day("start_date"))


def projects_for_processing(spark: SparkSession, sf: str) -> DataFrame:
    projects = _projects(spark, sf)
    modes = [
        sel.projects_for_processing(projects, mode, None).select("project_id", F.lit(mode).alias("mode"))
        for mode in ("active", "all")
    ]
    return modes[0].unionByName(modes[1])


def candidates_per_project(spark: SparkSession, sf: str) -> DataFrame:
    return sel.candidates_per_project(fixture(spark, sf, "fx_candidates"), _documents(spark, sf), TOP).select(
        "project_id", "document_id", "title", "url", "candidate_rank", "candidate_query", "position",
        F.md5("full_text").alias("text_md5"),
    )


def mapped_project_counts(spark: SparkSession, sf: str) -> DataFrame:
    return sel.mapped_project_counts(_map(spark, sf), 100)


def documents_per_project(spark: SparkSession, sf: str) -> DataFrame:
    return sel.documents_per_project(_map(spark, sf), _documents(spark, sf), TOP).select(
        "project_id", "document_id", "title", "confidence_score", "position", F.md5("full_text").alias("text_md5")
    )


def recent_runs(spark: SparkSession, sf: str) -> DataFrame:
    return rp.recent_runs(fixture(spark, sf, "fx_runs"), 10).drop("started_at")


def recent_projects(spark: SparkSession, sf: str) -> DataFrame:
    return rp.recent_projects(_projects(spark, sf), 20)


def recent_documents(spark: SparkSession, sf: str) -> DataFrame:
    return rp.recent_documents(_documents(spark, sf), 20, 100)


def recent_mappings(spark: SparkSession, sf: str) -> DataFrame:
    return rp.recent_mappings(_map(spark, sf), 20).select("project_id", "document_id", "confidence_score")


def docs_per_source(spark: SparkSession, sf: str) -> DataFrame:
    return rp.docs_per_source(_documents(spark, sf))


def mapped_docs_report(spark: SparkSession, sf: str) -> DataFrame:
    return rp.mapped_docs_report(_map(spark, sf), _projects(spark, sf))


def runs_of_job(spark: SparkSession, sf: str) -> DataFrame:
    return rp.runs_of_job(fixture(spark, sf, "fx_runs"), "wiki-generate", 50).drop("started_at")


def duplicate_mappings(spark: SparkSession, sf: str) -> DataFrame:
    return rp.duplicate_mappings(_map(spark, sf))


def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return rp.status_counts(_projects(spark, sf))


def mapped_active_projects(spark: SparkSession, sf: str) -> DataFrame:
    return rp.mapped_active_projects(_map(spark, sf), _projects(spark, sf), 20).select(
        "project_id", "project_no", "status", "mapped_document_count"
    )


QUERIES = {
    f.__name__: f
    for f in (
        active_projects, all_projects, projects_for_processing, candidates_per_project, mapped_project_counts,
        documents_per_project, recent_runs, recent_projects, recent_documents, recent_mappings, docs_per_source,
        mapped_docs_report, runs_of_job, duplicate_mappings, status_counts, mapped_active_projects,
    )
}

CLOSED = "('done', 'completed', 'cancelled', 'closed', 'future')"

DEFINITIONS = {
    "ex_candidate_links": """select *, row_number() over (partition by project_id order by rank, document_id) as position from
 (select project_id, document_id, rank, discovery_query from fx_candidates semi join fx_documents using (document_id)
 qualify row_number() over (partition by project_id, document_id order by rank, discovery_query) = 1)""",
    "ex_mapped_links": """select *, row_number() over (partition by project_id order by confidence_score desc, document_id) as position from
 (select project_id, document_id, max(confidence_score) as confidence_score from fx_map semi join fx_documents using (document_id) group by project_id, document_id)""",
}

ORACLES = {
    "active_projects": f"""select project_id, project_no, status, cast(start_date as varchar) as start_date from fx_projects
 where lower(status) not in {CLOSED} order by start_date desc nulls last, project_id limit 100""",
    "all_projects": """select project_id, project_no, status, cast(start_date as varchar) as start_date from fx_projects
 order by fx_projects.start_date desc nulls last, project_id limit 500""",
    "projects_for_processing": f"""select project_id, 'active' as mode from fx_projects where lower(status) not in {CLOSED}
 union all select project_id, 'all' from fx_projects""",
    "candidates_per_project": f"""select l.project_id, l.document_id, d.title, d.url, l.rank as candidate_rank, l.discovery_query as candidate_query,
 l.position, md5(d.full_text) as text_md5 from ex_candidate_links l join fx_documents d using (document_id) where position <= {TOP}""",
    "mapped_project_counts": """select project_id, count(*) as mapped_document_count from fx_map group by project_id
 order by count(*) desc, project_id limit 100""",
    "documents_per_project": f"""select l.project_id, l.document_id, d.title, l.confidence_score, l.position, md5(d.full_text) as text_md5
 from ex_mapped_links l join fx_documents d using (document_id) where position <= {TOP}""",
    "recent_runs": """select run_id, job_name, status, records_read, records_written from fx_runs
 order by started_at desc nulls last, run_id limit 10""",
    "recent_projects": """select project_id, project_no, project_name, status from fx_projects order by imported_on desc, project_id limit 20""",
    "recent_documents": """select document_id, title, left(text_preview, 100) as preview from fx_documents order by imported_on desc, document_id limit 20""",
    "recent_mappings": """select project_id, document_id, confidence_score from fx_map order by classified_on desc, project_id, document_id limit 20""",
    "docs_per_source": "select source_system, count(*) as docs from fx_documents group by source_system",
    "mapped_docs_report": """select m.project_id, p.project_no, p.project_name, count(*) as mapped_docs from fx_map m
 left join fx_projects p on m.project_id = p.project_id group by all""",
    "runs_of_job": """select run_id, job_name, status, records_read, records_written, error_message from fx_runs where job_name = 'wiki-generate'
 order by started_at desc nulls last, run_id limit 50""",
    "duplicate_mappings": """select project_id, document_id, count(*) as duplicate_count from fx_map group by project_id, document_id having count(*) > 1""",
    "status_counts": "select status, count(*) as projects from fx_projects group by status",
    "mapped_active_projects": """select p.project_id, p.project_no, p.status, count(m.document_id) as mapped_document_count from fx_projects p
 join fx_map m on p.project_id = m.project_id where lower(p.status) not in ('done', 'completed', 'cancelled', 'closed')
 group by p.project_id, p.project_no, p.status order by mapped_document_count desc, p.project_id limit 20""",
}
