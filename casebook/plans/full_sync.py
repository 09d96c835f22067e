"""Whole runs: project sync, discovery, classification, pages, with a run log."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.operators.discovery import discovery_outcome
from casebook.operators.pages import batch_outcome, replace_chunks, replace_pages, stored_chunks, stored_pages
from casebook.operators.selection import mapped_project_counts, projects_for_processing
from casebook.operators.upsert import assert_unique, upsert_candidates, upsert_documents, upsert_projects
from casebook.sources.durable import scratch, settle, settle_counted
from casebook.sources.store import append_table, load_table, merge_table, rows_of_keys
from casebook.plans.steps import (
    Scorer,
    Search,
    WikiSettings,
    Writer,
    classify,
    discover_all,
    failures_of,
    write_all_pages,
    write_pages,
)
from casebook.schemas import (
    CANDIDATES,
    CHUNKS,
    DOCUMENT_MAP,
    DOCUMENTS,
    ERRORS,
    JOB_NAMES,
    PAGES,
    PROJECTS,
    RUNS,
)
from casebook.sources.tables import align_to_schema, empty_table, project_by_id, run_entry

SCHEMAS = {
    "projects": PROJECTS,
    "documents": DOCUMENTS,
    "candidates": CANDIDATES,
    "document_map": DOCUMENT_MAP,
    "pages": PAGES,
    "chunks": CHUNKS,
    "runs": RUNS,
    "errors": ERRORS,
}
Tables = dict[str, DataFrame]
StepResult = tuple[Tables, int, int, int]  # tables, rows read, rows written, error rows


def empty_tables(spark: SparkSession) -> Tables:
    return {name: empty_table(spark, schema) for name, schema in SCHEMAS.items()}


@dataclass(frozen=True)
class RunSettings:
    """What a run works on. Limits are off unless stated; `strict` ends a step at its first error row.

    `clock` tells when steps begin and end. With `folder`, tables are stored there by name: rows with keys go into
    buckets, of which only the touched ones are rewritten, other rows are appended. Without it the run returns new tables.
    With `resume`, steps that the run log has as finished under this run id are not done again.
    """

    run_id: str
    as_of: datetime
    mode: str = "active"
    project_limit: int | None = None
    candidate_limit: int | None = None
    wiki: WikiSettings = field(default_factory=WikiSettings)
    scorer: Scorer | None = None
    writer: Writer | None = None
    strict: bool = False
    clock: Callable[[], datetime] = datetime.now
    query_description_chars: int | None = None
    classifier_preview_chars: int | None = None
    error_message_chars: int | None = None
    folder: str | None = None
    resume: bool = False


class ErrorsFound(RuntimeError):
    """A strict run met input or replies that it cannot use; `tables` holds the errors."""

    def __init__(self, job: str, count: int, tables: Tables):
        super().__init__(f"{job}: {count} errors")
        self.tables = tables


def _merged(
    tables: Tables, name: str, keys: list[str], source: DataFrame, merge: Callable[[DataFrame], DataFrame], settings: RunSettings
) -> DataFrame:
    """The table after `merge`, which upserts or replaces the keys of `source`."""
    if settings.folder is None:
        return settle(merge(tables[name]), name, lasting=True)
    return merge_table(source.sparkSession, settings.folder, name, SCHEMAS[name], keys, source, merge)


def _appended(tables: Tables, name: str, rows: DataFrame, settings: RunSettings) -> DataFrame:
    if settings.folder is None:
        return tables[name].unionByName(rows)
    return append_table(rows.sparkSession, settings.folder, name, align_to_schema(rows, SCHEMAS[name], fill_text=False))


def load_tables(spark: SparkSession, folder: str) -> Tables:
    """All tables of a folder under the current schemas; what is not there yet is empty."""
    return {name: load_table(spark, folder, name, schema) for name, schema in SCHEMAS.items()}


def _noted(tables: Tables, job: str, errors: DataFrame | None, settings: RunSettings) -> tuple[Tables, int]:
    """Tables with the error rows (key, error, record) of a step, and their number; in strict mode any of them ends the step."""
    if errors is None:
        return tables, 0
    rows = errors.select(
        F.lit(settings.run_id).alias("run_id"), F.lit(job).alias("job_name"), *[F.col(c).cast("string") for c in ("key", "error", "record")]
    )
    rows, count = settle_counted(rows, "errors", lasting=settings.folder is None)
    noted = tables | {"errors": _appended(tables, "errors", rows, settings)} if count else tables
    if count and settings.strict:
        raise ErrorsFound(job, count, noted)
    return noted, count


def _unless_all_failed(job: str, attempts: DataFrame | None, tables: Tables) -> None:
    """A step whose every request failed is no success; others go on without the failed ones."""
    if attempts is not None:
        outcome = batch_outcome(attempts).first()
        if outcome.status == "error":
            raise ErrorsFound(job, outcome.projects_failed, tables)


def sync_projects(tables: Tables, rows: DataFrame, settings: RunSettings, errors: DataFrame | None = None) -> StepResult:
    tables, faults = _noted(tables, JOB_NAMES[0], errors, settings)
    rows, count = settle_counted(rows, "project-rows")
    assert_unique(rows, ["project_id"])
    merged = _merged(tables, "projects", ["project_id"], rows, lambda t: upsert_projects(t, rows, settings.as_of), settings)
    return tables | {"projects": merged}, count, count, faults


def sync_documents(tables: Tables, search: Search, settings: RunSettings) -> StepResult:
    """Queries that the search could not answer are error rows; the step fails when nothing at all was found because of them."""
    turn = projects_for_processing(tables["projects"], settings.mode, settings.project_limit)
    chosen, read = settle_counted(turn, "projects-in-turn")
    documents, candidates, failed = discover_all(chosen, search, settings.query_description_chars)
    found = candidates.count()
    failed = settle(failed, "failed-queries")
    rows = failed.select(
        F.col("project_id").alias("key"), F.concat(F.lit("search failed: "), "error").alias("error"), F.col("query").alias("record")
    )
    tables, faults = _noted(tables, JOB_NAMES[1], rows, settings)
    if faults:
        per_project = candidates.groupBy("project_id").agg(F.count("*").alias("candidates"))
        attempts = failed.groupBy("project_id").agg(F.min("error").alias("error")).join(per_project, "project_id", "full")
        if discovery_outcome(attempts.withColumn("error", F.when(F.col("candidates").isNull(), F.col("error")))).first().status == "error":
            raise ErrorsFound(JOB_NAMES[1], faults, tables)
    assert_unique(documents, ["document_id"])
    merged = {
        "documents": _merged(
            tables, "documents", ["document_id"], documents, lambda t: upsert_documents(t, documents, settings.as_of), settings
        ),
        "candidates": _merged(
            tables, "candidates", ["project_id", "document_id"], candidates,
            lambda t: upsert_candidates(t, candidates, settings.run_id, settings.as_of, ("query_ord",)), settings,
        ),
    }
    return tables | merged, read, found, faults


def sync_mappings(tables: Tables, settings: RunSettings) -> StepResult:
    """Reads what the classifier is given: at most k candidates a project, with existing documents.

    Projects at which the scorer fails are error rows; the step fails when it fails at all of them.
    """
    chosen = projects_for_processing(tables["projects"], settings.mode, settings.project_limit)
    found, errors, asked, attempts = classify(
        chosen, tables["candidates"], tables["documents"], settings.run_id, settings.as_of,
        settings.candidate_limit, settings.scorer, preview_chars=settings.classifier_preview_chars,
    )
    mappings, written = settle_counted(found, "mappings", lasting=settings.folder is None)
    tables, faults = _noted(tables, JOB_NAMES[2], errors, settings)
    _unless_all_failed(JOB_NAMES[2], attempts, tables)
    return tables | {"document_map": _appended(tables, "document_map", mappings, settings)}, asked.count(), written, faults


def sync_pages(tables: Tables, settings: RunSettings) -> StepResult:
    """Pages of the mapped projects; those that are no project, or whose page cannot be written, are error rows."""
    most_mapped = settle(mapped_project_counts(tables["document_map"], settings.project_limit), "mapped-projects")
    unknown = most_mapped.join(tables["projects"], "project_id", "left_anti").select(
        F.col("project_id").alias("key"), F.lit("mapped project not found").alias("error"), F.lit(None).alias("record")
    )
    tables, faults = _noted(tables, JOB_NAMES[3], unknown, settings)
    own = tables["projects"].join(most_mapped.select("project_id"), "project_id", "left_semi")
    chosen, _ = settle_counted(own, "page-projects")
    state, _, written, failed = _store(tables, chosen, settings)
    return state, most_mapped.count(), written, faults + failed


def _store(tables: Tables, chosen: DataFrame, settings: RunSettings) -> StepResult:
    found, attempts = write_all_pages(
        chosen, tables["document_map"], tables["documents"], settings.as_of, settings.wiki, settings.writer
    )
    errors = None if attempts is None else failures_of(attempts, "page failed: ")
    tables, faults = _noted(tables, JOB_NAMES[3], errors, settings)
    _unless_all_failed(JOB_NAMES[3], attempts, tables)
    # The text lies in the chunks; `stored_pages` takes the first of them.
    written, count = settle_counted(found.drop("markdown"), "written-pages")
    pages, chunks = stored_pages(written), stored_chunks(written)
    stored = {
        "pages": _merged(tables, "pages", ["project_id"], pages, lambda t: replace_pages(t, pages), settings),
        "chunks": _merged(tables, "chunks", ["project_id"], pages, lambda t: replace_chunks(t, pages, chunks), settings),
    }
    return tables | stored, count, count, faults


def full_sync(
    spark: SparkSession, tables: Tables, project_rows: DataFrame, search: Search, settings: RunSettings,
    scan_errors: DataFrame | None = None,
) -> Tables:
    """Run the four steps in order; every step leaves a run-log row, a failing one ends the run.

    Tables of older versions are read under the current schemas. What a step cannot use (`scan_errors` of the landed
    input, replies, projects) goes to the errors table, is counted in the step's message, and ends the step in strict mode.
    Between the steps the tables are written to the shared folder, so each step starts from files and no plan grows
    over the run; what only a step needs is removed at its end. One bad row does not end a step: where a scorer, a writer or an isolating search fails, its row becomes an
    error, and the step fails only when all do.
    """
    steps: list[tuple[str, Callable[[Tables], StepResult]]] = [
        (JOB_NAMES[0], lambda t: sync_projects(t, project_rows, settings, scan_errors)),
        (JOB_NAMES[1], lambda t: sync_documents(t, search, settings)),
        (JOB_NAMES[2], lambda t: sync_mappings(t, settings)),
        (JOB_NAMES[3], lambda t: sync_pages(t, settings)),
    ]
    state = {name: _aligned(tables.get(name), spark, schema) for name, schema in SCHEMAS.items()}
    began = settings.clock()
    finished = _finished(state, settings) if settings.resume else set()
    for job, step in steps:
        if job in finished:
            continue
        start = settings.clock()
        try:
            with scratch(spark):
                state, read, written, faults = step(state)
        except Exception as error:
            state = error.tables if isinstance(error, ErrorsFound) else state
            state = _logged(spark, state, job, settings, start, "error", message=str(error))
            state = _logged(spark, state, JOB_NAMES[4], settings, began, "error", message=f"Step {job} failed: {error}")
            raise StepFailed(job, state) from error
        state = _logged(spark, state, job, settings, start, "success", read, written, f"{faults} errors" if faults else None)
    return _logged(spark, state, JOB_NAMES[4], settings, began, "success")


def _aligned(table: DataFrame | None, spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A stored table under the current schema; a missing one is empty."""
    if table is None:
        return empty_table(spark, schema)
    return table if table.schema.names == schema.names else align_to_schema(table, schema, fill_text=False)


def _finished(tables: Tables, settings: RunSettings) -> set[str]:
    """Steps that this run has finished; at most one name a step reaches the driver."""
    own = (F.col("run_id") == settings.run_id) & (F.col("status") == "success")
    return {r.job_name for r in tables["runs"].where(own).select("job_name").distinct().collect()}


class StepFailed(RuntimeError):
    """A step failed; `tables` holds what the run had reached, with the run log."""

    def __init__(self, step: str, tables: Tables):
        super().__init__(f"step {step} failed")
        self.step = step
        self.tables = tables


def _logged(
    spark: SparkSession, tables: Tables, job: str, settings: RunSettings, start: datetime, status: str,
    read: int = 0, written: int = 0, message: str | None = None,
) -> Tables:
    entry = run_entry(
        spark, job, settings.run_id, start, settings.clock(), status, read, written, message, settings.error_message_chars
    )
    return tables | {"runs": _appended(tables, "runs", entry, settings)}


def historical_sync(
    spark: SparkSession, tables: Tables, project_rows: DataFrame, search: Search, settings: RunSettings,
    scan_errors: DataFrame | None = None,
) -> Tables:
    """The same run over all projects, closed ones included."""
    return full_sync(spark, tables, project_rows, search, replace(settings, mode="all"), scan_errors)


def single_project(tables: Tables, project_id: str, settings: RunSettings) -> DataFrame:
    """Page row of one project; the filter reaches the scans of projects and map."""
    chosen = project_by_id(tables["projects"], project_id)
    own_map = tables["document_map"].filter(tables["document_map"]["project_id"] == project_id)
    return write_pages(chosen, own_map, tables["documents"], settings.as_of, settings.wiki, settings.writer)


def stored_project(spark: SparkSession, project_id: str, settings: RunSettings) -> DataFrame:
    """Page row of one project out of the stored tables in `settings.folder`.

    Its own bucket of projects is read, and of documents the buckets of the mapped ids.
    """

    def looked_up(name: str, key: str, wanted: DataFrame) -> DataFrame:
        return rows_of_keys(spark, settings.folder, name, SCHEMAS[name], [key], wanted)

    document_map = load_table(spark, settings.folder, "document_map", SCHEMAS["document_map"])
    own_map = settle(document_map.filter(F.col("project_id") == project_id), "own-map")
    tables = {
        "projects": looked_up("projects", "project_id", spark.createDataFrame([(project_id,)], "project_id string")),
        "document_map": own_map,
        "documents": looked_up("documents", "document_id", own_map.select("document_id").distinct()),
    }
    return single_project(tables, project_id, settings)
