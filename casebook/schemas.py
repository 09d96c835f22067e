"""Table schemas and the fixed values every operator shares."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(data_type: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, data_type) for name in names]


TEXT, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()
MOMENT, DAY, DOUBLE, FLAG = T.TimestampType(), T.DateType(), T.DoubleType(), T.BooleanType()

# The column names of the stored tables.
PROJECTS = T.StructType(
    _fields(
        TEXT,
        "project_id", "scoro_id", "project_no", "project_name", "status", "status_name", "project_manager",
        "project_manager_name", "project_members",
    )
    + _fields(DAY, "start_date", "due_date")
    + _fields(
        TEXT,
        "completed_date", "description", "client_company", "client_contacts", "project_type", "client_country",
        "business_area", "business_line_division", "budget_type", "po_number", "open_po_number",
        "related_project", "google_drive_link", "project_priority", "tags",
    )
    + _fields(MOMENT, "imported_at")
)

DOCUMENTS = T.StructType(
    _fields(TEXT, "document_id", "source_system", "source_type", "title", "folder_path", "url", "source_url", "author")
    + _fields(MOMENT, "created_at", "modified_at")
    + _fields(TEXT, "text_preview", "full_text")
    + _fields(MOMENT, "imported_at")
)

CANDIDATES = T.StructType(
    _fields(TEXT, "project_id", "document_id", "discovery_query")
    + _fields(LONG, "rank")
    + _fields(TEXT, "title", "url", "source_url", "text_preview")
    + _fields(MOMENT, "discovered_at")
    + _fields(TEXT, "run_id")
)

DOCUMENT_MAP = T.StructType(
    _fields(TEXT, "project_id", "document_id")
    + _fields(DOUBLE, "confidence_score")
    + _fields(TEXT, "matching_method", "classifier_reason")
    + _fields(MOMENT, "classified_at")
    + _fields(TEXT, "run_id")
)

RUNS = T.StructType(
    _fields(TEXT, "run_id", "job_name")
    + _fields(MOMENT, "started_at", "finished_at")
    + _fields(TEXT, "status")
    + _fields(LONG, "records_read", "records_written")
    + _fields(TEXT, "error_message")
)

ERRORS = T.StructType(_fields(TEXT, "run_id", "job_name", "key", "error", "record"))

SOURCE_ENTRY = T.StructType(_fields(INT, "index") + _fields(TEXT, "title", "document_id", "type", "url"))

PAGES = T.StructType(
    _fields(
        TEXT,
        "project_id", "project_name", "project_no", "client_company", "client_contacts", "project_manager",
        "project_members", "status_name", "tags", "business_area", "client_country", "google_drive_link",
    )
    + _fields(MOMENT, "generated_at")
    + _fields(T.ArrayType(TEXT), "source_document_ids")
    + _fields(T.ArrayType(SOURCE_ENTRY), "source_documents")
    + _fields(TEXT, "markdown", "wiki_status", "generated_by_model")
    + _fields(FLAG, "markdown_chunked")
    + _fields(INT, "markdown_chunk_count")
    + _fields(LONG, "markdown_total_bytes")
)

CHUNKS = T.StructType(
    _fields(TEXT, "project_id") + _fields(INT, "index") + _fields(TEXT, "content") + _fields(INT, "total_chunks")
)

# One landed reply of the list call: the status asked for, the page number, the records.
RECORD_PAGES = T.StructType(
    _fields(TEXT, "status") + _fields(LONG, "page") + _fields(T.ArrayType(T.VariantType()), "data")
)

USERS = T.StructType(_fields(TEXT, "id", "user_id", "firstname", "lastname", "full_name", "email"))
CONTACTS = T.StructType(_fields(TEXT, "contact_id", "id", "contact_type", "name", "lastname", "search_name", "position"))
COMPANIES = T.StructType(_fields(TEXT, "company_id", "contact_id", "id", "name", "company_name"))

# They must equal the ones the source systems and the stored tables use.
PROJECT_ID_PREFIX = "scoro_"
ACTIVE_STATUS = "inprogress"
ALL_STATUSES = (
    "pending",
    "inprogress",
    "cancelled",
    "completed",
    "future",
    "additional1",
    "additional2",
    "additional3",
    "additional4",
)
CLOSED_STATUSES = ("done", "completed", "cancelled", "closed", "future")
CLOSED_STATUSES_OF_REPORT = ("done", "completed", "cancelled", "closed")
ENRICH_STATUSES = ("inprogress", "pending", "future", "plan")
JOB_NAMES = ("scoro-sync", "document-discovery", "taxonomy-sync", "wiki-generate", "full-sync")

SEARCH_PAGE_SIZE = 25
WIKI_SOURCE_LIMIT = 50
WIKI_PREFILTER_CAP = 35
WIKI_FALLBACK_LIMIT = 10
WIKI_MIN_SOURCES = 4
CONFIDENCE_FLOOR = 0.75
CHUNK_BYTES = 900_000
