"""Queries and reference SQL: sources, schemas, upserts, run log, page store."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.operators import pages as pg
from casebook.operators import upsert as up
from casebook.sources.durable import new_place
from casebook.schemas import CANDIDATES, DOCUMENT_MAP, DOCUMENTS, PROJECTS
from casebook.sources import landed, search_results, tables
from checks.fixtures import fixture
from checks.records import landed_pages

AS_OF = datetime(2026, 1, 2, 3, 4, 5)
NOW = "2026-01-02 03:04:05"
STATUSES = ("inprogress", "Pending", "Completed", "cancelled", "future", "")


def moment(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def raw_projects_scan(spark: SparkSession, sf: str) -> DataFrame:
    place = new_place(spark, "landing")
    landed_pages(spark, sf, place)
    raw = landed.raw_projects(landed.read_pages(spark, place), STATUSES)
    return raw.select(
        "status", "status_ord", "page", "pos",
        F.try_variant_get("rec", "$.project_id", "bigint").alias("k"),
        F.try_variant_get("rec", "$.project_name", "string").alias("project_name"),
    )


def status_scope(spark: SparkSession, sf: str) -> DataFrame:
    projects = fixture(spark, sf, "fx_projects")
    return landed.status_scope(projects, "all", "inprogress, Pending ,,Completed").select("project_id", "status")


def dedup_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    rec = F.parse_json(F.to_json(F.struct(F.col("id").alias("project_id"), F.col("project_no").alias("no"))))
    pulls = fixture(spark, sf, "fx_pulls").select("status_ord", "page", "pos", rec.alias("rec"))
    return landed.first_seen(pulls).select(
        "id", "status_ord", "page", "pos", F.try_variant_get("rec", "$.no", "string").alias("project_no")
    )


def search_result_json(spark: SparkSession, sf: str) -> DataFrame:
    """Search results as JSON: snake and camel case keys, content and pageContent, missing ids."""
    docs = fixture(spark, sf, "fx_documents")
    pk = F.col("pk")
    answer = F.struct(
        F.when(pk % 5 != 0, F.concat(F.lit("Answer "), F.col("text_preview"))).alias("content"),
        F.concat(F.lit("Page "), F.col("text_preview")).alias("pageContent"),
    )
    segment = F.struct(F.col("full_text").alias("content"), F.lit(None).cast("string").alias("pageContent"))
    result = F.struct(
        F.struct(
            F.when(pk % 10 != 3, F.col("document_id")).alias("id"),
            F.when(pk % 10 != 3, F.concat(F.lit("HTTPS://names.example.com/"), pk.cast("string")))
            .when(pk % 20 == 3, F.concat(F.lit("projects/x/"), F.col("document_id")))
            .alias("name"),
            F.struct(
                F.when(pk % 3 == 0, F.col("title")).alias("title"),
                F.when(pk % 3 == 0, F.col("url")).alias("uri"),
                F.when(pk % 8 == 0, F.col("source_url")).alias("canonicalUri"),
            ).alias("structData"),
            F.struct(
                F.when(pk % 3 == 1, F.col("title")).alias("title"),
                F.when(pk % 7 == 0, F.col("url")).alias("link"),
                F.when(pk % 6 != 0, F.array(F.struct(F.concat(F.lit("Snip "), pk.cast("string")).alias("snippet")))).alias("snippets"),
                F.when(pk % 2 == 0, F.array(answer)).otherwise(F.filter(F.array(answer), lambda a: F.lit(False))).alias("extractive_answers"),
                F.when(pk % 2 == 1, F.array(answer, answer)).alias("extractiveAnswers"),
                F.array(segment).alias("extractiveSegments"),
            ).alias("derivedStructData"),
        ).alias("document")
    )
    return docs.select(F.to_json(result).alias("result"))


def search_results_parse(spark: SparkSession, sf: str) -> DataFrame:
    return search_results.parse_search_results(search_result_json(spark, sf), preview_chars=1000, text_chars=12_000)


def align_schema(spark: SparkSession, sf: str) -> DataFrame:
    old = fixture(
        spark, sf, "select project_id, project_no, project_name, status, start_date, due_date, client_company from fx_projects"
    )
    return tables.align_to_schema(old, PROJECTS).drop("imported_at").withColumns(
        {"start_date": F.col("start_date").cast("string"), "due_date": F.col("due_date").cast("string")}
    )


def project_by_id(spark: SparkSession, sf: str) -> DataFrame:
    projects = fixture(spark, sf, "fx_projects")
    return tables.projects_by_ids(projects, fixture(spark, sf, "fx_map")).select("project_id", "project_no", "project_name")


PROJECT_TARGET = """select project_id, scoro_id, project_no, project_name, status, start_date, due_date, client_company,
 description, imported_on from fx_projects where imported_on < date '1997-01-01'"""
PROJECT_SOURCE = """select project_id, scoro_id, project_no, project_name || ' (rev)' as project_name, status,
 case when k % 4 = 0 then '2024-1-5' when k % 4 = 1 then '2024-13-45' when k % 4 = 2 then '2024-02-29T1' else '' end as start_date,
 cast(due_date as string) as due_date, client_company from fx_projects where imported_on >= date '1995-01-01'"""


def _projects_after(spark: SparkSession, sf: str, small: bool) -> DataFrame:
    target = tables.align_to_schema(
        fixture(spark, sf, PROJECT_TARGET).withColumn("imported_at", F.col("imported_on").cast("timestamp")), PROJECTS, False
    )
    source = fixture(spark, sf, PROJECT_SOURCE)
    names = [f.name for f in PROJECTS if f.name not in source.columns + ["imported_at"]]
    source = source.withColumns({n: F.lit("") for n in names})
    return up.upsert_projects(target, source, AS_OF, small).select(
        "project_id", "project_name", "status", "client_company", "description", "tags",
        F.col("start_date").cast("string").alias("start_date"), F.col("due_date").cast("string").alias("due_date"),
        moment("imported_at"),
    )


def upsert_projects(spark: SparkSession, sf: str) -> DataFrame:
    return _projects_after(spark, sf, False)


def upsert_projects_small_batch(spark: SparkSession, sf: str) -> DataFrame:
    return _projects_after(spark, sf, True)


DOCUMENT_TARGET = """select document_id, source_system, title, url, source_url, text_preview, full_text, 'old folder' as folder_path,
 'author ' || cast(pk as string) as author, imported_on from fx_documents where imported_on < date '2025-06-01'"""
DOCUMENT_SOURCE = """select document_id, 'discovery_engine' as source_system, 'search_result' as source_type, title || ' (new)' as title, url, source_url,
 text_preview, full_text, 'new folder' as folder_path, '' as author from fx_documents where imported_on >= date '2024-06-01'"""


def upsert_documents(spark: SparkSession, sf: str) -> DataFrame:
    target = fixture(spark, sf, DOCUMENT_TARGET).withColumns(
        {n: F.col("imported_on").cast("timestamp") for n in ("imported_at", "created_at", "modified_at")}
    )
    result = up.upsert_documents(
        tables.align_to_schema(target, DOCUMENTS, False), fixture(spark, sf, DOCUMENT_SOURCE), AS_OF
    )
    return result.select(
        "document_id", "source_system", "source_type", "title", "folder_path", "author",
        moment("created_at"), moment("modified_at"), moment("imported_at"), F.md5("full_text").alias("text_md5"),
    )


def upsert_candidates(spark: SparkSession, sf: str) -> DataFrame:
    target = fixture(spark, sf, "select * from fx_candidates where l_linenumber <= 3")
    target = up.best_ranked(target, ["discovery_query"]).withColumn("discovered_at", F.lit("2020-01-01").cast("timestamp"))
    source = fixture(spark, sf, "select *, 'from ' || discovery_query as title from fx_candidates where l_linenumber >= 2")
    result = up.upsert_candidates(tables.align_to_schema(target, CANDIDATES), source.drop("run_id"), "run_9", AS_OF)
    return result.select(
        "project_id", "document_id", "discovery_query", "rank", "title", moment("discovered_at"), "run_id"
    )


def assert_unique_source(spark: SparkSession, sf: str) -> DataFrame:
    return up.duplicate_keys(fixture(spark, sf, "fx_candidates"), ["project_id", "document_id"])


def append_mappings(spark: SparkSession, sf: str) -> DataFrame:
    place = new_place(spark, "map")
    rows = fixture(spark, sf, "fx_map").withColumn("run_id", F.lit("run_1"))
    first = tables.align_to_schema(rows, DOCUMENT_MAP, False)
    second = tables.align_to_schema(rows.withColumn("run_id", F.lit("run_2")), DOCUMENT_MAP, False)
    for batch in (first, second, first.limit(0)):
        tables.append_rows(batch, place)
    return spark.read.schema(DOCUMENT_MAP).parquet(place).select(
        "project_id", "document_id", "confidence_score", "classifier_reason", "run_id"
    )


def run_log_append(spark: SparkSession, sf: str) -> DataFrame:
    runs = fixture(spark, sf, "fx_runs").withColumn("finished_at", F.col("started_at"))
    return tables.run_log(runs, 1000).select(
        "run_id", "job_name", "status", "records_read", "records_written", "error_message", moment("started_at")
    )


SMALL_CHUNK, LARGE_CHUNK = 3000, 8000


def _chunked(spark: SparkSession, sf: str, limit: int, sql: str = "fx_page_texts") -> DataFrame:
    return pg.chunked_pages(fixture(spark, sf, sql), limit)


def store_pages(spark: SparkSession, sf: str) -> DataFrame:
    return pg.stored_pages(_chunked(spark, sf, SMALL_CHUNK)).select(
        "project_id", F.md5("markdown").alias("inline_md5"), "markdown_chunked",
        F.col("markdown_chunk_count").cast("bigint").alias("markdown_chunk_count"), "markdown_total_bytes",
    )


def stored_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return pg.stored_chunks(_chunked(spark, sf, SMALL_CHUNK)).select(
        "project_id", F.col("index").cast("bigint").alias("index"), F.md5("content").alias("content_md5"),
        F.col("total_chunks").cast("bigint").alias("total_chunks"),
    )


def stale_chunks(spark: SparkSession, sf: str) -> DataFrame:
    old = pg.stored_chunks(_chunked(spark, sf, SMALL_CHUNK))
    rewritten = _chunked(spark, sf, LARGE_CHUNK, "select * from fx_page_texts where lang = 'en'")
    return pg.stale_chunks(old, rewritten, pg.stored_chunks(rewritten)).select(
        "project_id", F.col("index").cast("bigint").alias("index")
    )


def utf8_chunks(spark: SparkSession, sf: str) -> DataFrame:
    pages = _chunked(spark, sf, LARGE_CHUNK)
    return pages.select(
        "project_id",
        F.size("chunks").cast("bigint").alias("chunk_count"),
        "markdown_total_bytes",
        (F.array_join("chunks", "") == F.col("markdown")).alias("joins_again"),
        F.forall("chunks", lambda c: F.octet_length(c) <= LARGE_CHUNK).alias("within_limit"),
    )


def reassemble_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = _chunked(spark, sf, SMALL_CHUNK)
    texts = pg.reassembled_pages(pg.stored_pages(pages), pg.stored_chunks(pages))
    return texts.select("project_id", F.md5("text").alias("text_md5"))


QUERIES = {
    f.__name__: f
    for f in (
        raw_projects_scan, status_scope, dedup_first_seen, search_results_parse, align_schema, project_by_id,
        upsert_projects, upsert_projects_small_batch, upsert_documents, upsert_candidates, assert_unique_source,
        append_mappings, run_log_append, store_pages, stored_chunks, stale_chunks, utf8_chunks, reassemble_pages,
    )
}


def chunk_definitions(name: str, limit: int, pages: str) -> dict[str, str]:
    """Byte-safe cuts by a running byte count over characters and one recursion step per chunk."""
    return {
        "ex_chars": """select project_id, c.nr, sum(octet_length(encode(c.ch))) over (partition by project_id order by c.nr) as bytes
 from (select project_id, unnest(list_transform(regexp_extract_all(markdown, '(?s).'), lambda ch, nr: {'ch': ch, 'nr': nr})) as c from fx_page_texts)""",
        f"{name}_cuts": f"""select project_id, 0 as index, cast(0 as hugeint) as from_bytes, cast(0 as bigint) as from_at from {pages}
 union all
 select c.project_id, c.index + 1, max(h.bytes), max(h.nr) from {name}_cuts c join ex_chars h on h.project_id = c.project_id
  and h.bytes > c.from_bytes and h.bytes <= c.from_bytes + {limit} group by c.project_id, c.index, c.from_bytes""",
        name: f"""select project_id, index - 1 as index, substr(markdown, cast(lag_at + 1 as bigint), cast(from_at - lag_at as bigint)) as content,
 count(*) over (partition by project_id) as total
 from (select *, lag(from_at) over (partition by project_id order by index) as lag_at from {name}_cuts) join fx_page_texts using (project_id)
 where index > 0""",
    }


DEFINITIONS = {
    "ex_project_target": PROJECT_TARGET,
    "ex_project_source": PROJECT_SOURCE,
    "ex_document_target": DOCUMENT_TARGET,
    "ex_document_source": DOCUMENT_SOURCE,
    "ex_cand_target": """select * exclude n from (select *, row_number() over (partition by project_id, document_id order by rank, discovery_query) n
 from fx_candidates where l_linenumber <= 3) where n = 1""",
    "ex_cand_source": """select * exclude n from (select *, row_number() over (partition by project_id, document_id order by rank, discovery_query) n
 from fx_candidates where l_linenumber >= 2) where n = 1""",
    **chunk_definitions("ex_small_chunks", SMALL_CHUNK, "fx_page_texts"),
    **chunk_definitions("ex_large_chunks", LARGE_CHUNK, "fx_page_texts"),
    "ex_hit_parts": """select *, case when pk % 10 <> 3 then document_id when pk % 20 = 3 then 'projects/x/' || document_id end as shown_id,
 case when pk % 10 <> 3 then 'HTTPS://names.example.com/' || pk when pk % 20 = 3 then 'projects/x/' || document_id else '' end as name,
 case when pk % 6 <> 0 then 'Snip ' || pk else '' end as snippet,
 case when pk % 5 <> 0 then 'Answer ' || text_preview else 'Page ' || text_preview end as answer
 from fx_documents""",
    "ex_hit_urls": """select *, coalesce(case when pk % 7 = 0 then nullif(url, '') end, case when pk % 8 = 0 then nullif(source_url, '') end,
  case when name ilike 'http%' then name end, '') as shown_source,
 concat_ws(chr(10) || chr(10), nullif(snippet, ''), answer, case when pk % 2 = 1 then answer end, nullif(full_text, '')) as body from ex_hit_parts""",
}

PROJECT_MERGE = f"""select coalesce(s.project_id, t.project_id) as project_id,
 case when s.project_id is null then t.project_name else s.project_name end as project_name,
 case when s.project_id is null then t.status else s.status end as status,
 case when s.project_id is null then t.client_company else s.client_company end as client_company,
 case when s.project_id is null then t.description else '' end as description,
 case when s.project_id is null then null else '' end as tags,
 case when s.project_id is null then cast(t.start_date as varchar)
  when s.start_date = '2024-1-5' then '2024-01-05' when s.start_date = '2024-02-29T1' then '2024-02-29' end as start_date,
 case when s.project_id is null then cast(t.due_date as varchar) else s.due_date end as due_date,
 case when s.project_id is null then strftime(cast(t.imported_on as timestamp), '%Y-%m-%d %H:%M:%S') else '{NOW}' end as imported_at
 from ex_project_target t full join ex_project_source s on t.project_id = s.project_id"""

ORACLES = {
    "raw_projects_scan": f"""select status, list_position([{', '.join(repr(s) for s in STATUSES)}], status) as status_ord,
 cast(floor(k / 100) as bigint) as page, row_number() over (partition by status, floor(k / 100) order by k) - 1 as pos, k, project_name
 from fx_projects where status is not null""",
    "status_scope": "select project_id, status from fx_projects where status in ('inprogress', 'Pending', 'Completed')",
    "dedup_first_seen": """select id, status_ord, page, pos, project_no from fx_pulls where id is not null
 qualify row_number() over (partition by id order by status_ord, page, pos) = 1""",
    "search_results_parse": """select shown_id as document_id, 'discovery_engine' as source_system, 'search_result' as source_type,
 case when pk % 3 <> 2 then title else shown_id end as title, '' as folder_path,
 coalesce(nullif(shown_source, ''), case when pk % 3 = 0 then url end, name) as url, shown_source as source_url, '' as author,
 left(coalesce(nullif(snippet, ''), body), 1000) as text_preview, left(body, 12000) as full_text
 from ex_hit_urls where shown_id is not null""",
    "align_schema": """select project_id, '' as scoro_id, project_no, project_name, coalesce(status, '') as status, '' as status_name,
 '' as project_manager, '' as project_manager_name, '' as project_members, cast(start_date as varchar) as start_date, cast(due_date as varchar) as due_date,
 '' as completed_date, '' as description, client_company, '' as client_contacts, '' as project_type, '' as client_country, '' as business_area,
 '' as business_line_division, '' as budget_type, '' as po_number, '' as open_po_number, '' as related_project, '' as google_drive_link,
 '' as project_priority, '' as tags from fx_projects""",
    "project_by_id": "select project_id, project_no, project_name from fx_projects where project_id in (select project_id from fx_map)",
    "upsert_projects": PROJECT_MERGE,
    "upsert_projects_small_batch": PROJECT_MERGE,
    "upsert_documents": f"""select coalesce(s.document_id, t.document_id) as document_id,
 case when s.document_id is null then t.source_system else s.source_system end as source_system,
 s.source_type as source_type, coalesce(s.title, t.title) as title, coalesce(t.folder_path, s.folder_path) as folder_path,
 coalesce(t.author, s.author) as author,
 strftime(cast(t.imported_on as timestamp), '%Y-%m-%d %H:%M:%S') as created_at, strftime(cast(t.imported_on as timestamp), '%Y-%m-%d %H:%M:%S') as modified_at,
 case when s.document_id is null then strftime(cast(t.imported_on as timestamp), '%Y-%m-%d %H:%M:%S') else '{NOW}' end as imported_at,
 md5(coalesce(s.full_text, t.full_text)) as text_md5
 from ex_document_target t full join ex_document_source s on t.document_id = s.document_id""",
    "upsert_candidates": f"""select coalesce(s.project_id, t.project_id) as project_id, coalesce(s.document_id, t.document_id) as document_id,
 coalesce(s.discovery_query, t.discovery_query) as discovery_query, coalesce(s.rank, t.rank) as rank,
 case when s.project_id is null then '' else 'from ' || s.discovery_query end as title,
 case when s.project_id is null then '2020-01-01 00:00:00' else '{NOW}' end as discovered_at,
 case when s.project_id is null then t.run_id else 'run_9' end as run_id
 from ex_cand_target t full join ex_cand_source s on t.project_id = s.project_id and t.document_id = s.document_id""",
    "assert_unique_source": """select project_id, document_id, count(*) as copies from fx_candidates group by project_id, document_id having count(*) > 1""",
    "append_mappings": """select project_id, document_id, confidence_score, classifier_reason, run_id
 from fx_map cross join (select unnest(['run_1', 'run_2']) as run_id)""",
    "run_log_append": """select run_id, job_name, status, records_read, records_written, left(nullif(error_message, ''), 1000) as error_message,
 strftime(started_at, '%Y-%m-%d %H:%M:%S') as started_at from fx_runs""",
    "store_pages": """select project_id, md5(content) as inline_md5, total > 1 as markdown_chunked, total as markdown_chunk_count,
 octet_length(encode(markdown)) as markdown_total_bytes from ex_small_chunks join fx_page_texts using (project_id) where index = 0""",
    "stored_chunks": """select project_id, cast(index as bigint) as index, md5(content) as content_md5, total as total_chunks
 from ex_small_chunks where total > 1""",
    "stale_chunks": """select o.project_id, cast(o.index as bigint) as index from ex_small_chunks o join fx_page_texts p using (project_id)
 where o.total > 1 and p.lang = 'en' and not exists
 (select 1 from ex_large_chunks n where n.project_id = o.project_id and n.index = o.index and n.total > 1)""",
    "utf8_chunks": f"""select project_id, total as chunk_count, octet_length(encode(any_value(markdown))) as markdown_total_bytes,
 string_agg(content, '' order by index) = any_value(markdown) as joins_again, max(octet_length(encode(content))) <= {LARGE_CHUNK} as within_limit
 from ex_large_chunks join fx_page_texts using (project_id) group by project_id, total""",
    "reassemble_pages": "select project_id, md5(markdown) as text_md5 from fx_page_texts",
}
