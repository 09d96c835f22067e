"""Queries and reference SQL: wiki sources, pages, whole runs, incremental ingestion."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.functions.markdown import source_table
from casebook.operators import pages as pg
from casebook.operators import selection as sel
from casebook.operators import wiki_sources as ws
from casebook.operators.normalize import normalize_projects
from casebook.plans import full_sync as runs
from casebook.sources.durable import new_place, settle
from casebook.plans.steps import Dimensions, WikiSettings, corpus_search, project_rows, write_pages
from casebook.sources.landed import read_pages, scan_pages
from casebook.sources.search_results import search_result_errors
from casebook.sources.store import append_table, merge_table
from casebook.sources.tables import align_to_schema
from casebook.streaming.ingest import newest_version, start_ingest
from checks.discovery_checks import DEFINITIONS as DISCOVERY_DEFINITIONS
from checks.discovery_checks import WORDS
from checks.fixtures import fixture
from checks.normalize_checks import _companies, _contacts, _users
from checks.records import landed_pages, records
from checks.source_checks import STATUSES

AS_OF = datetime(2026, 1, 2, 3, 4, 5)
# Small enough to reach every branch: the stand-ins have at most 13 documents per project.
CAP, FALLBACK, MINIMUM, SOURCES = 3, 2, 2, 5
CHUNK_LIMIT = 700
SETTINGS = WikiSettings(SOURCES, CAP, FALLBACK, MINIMUM, CHUNK_LIMIT, content_chars=18_000)


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "fx_documents")


def _links(spark: SparkSession, sf: str) -> DataFrame:
    return sel.mapped_links(fixture(spark, sf, "fx_map"), _documents(spark, sf), SOURCES)


def _described(spark: SparkSession, sf: str) -> DataFrame:
    documents = _documents(spark, sf).select("document_id", "title", "source_url", "url")
    numbers = fixture(spark, sf, "fx_projects").select("project_id", "project_no")
    return _links(spark, sf).join(documents, "document_id").join(numbers, "project_id")


def _sources(spark: SparkSession, sf: str) -> DataFrame:
    selected = ws.select_sources(_described(spark, sf), CAP, FALLBACK, MINIMUM)
    return ws.source_rows(selected, _documents(spark, sf), 18_000)


def _lists(spark: SparkSession, sf: str) -> DataFrame:
    return ws.source_lists(_sources(spark, sf))


def title_features(spark: SparkSession, sf: str) -> DataFrame:
    return ws.title_features(_documents(spark, sf)).select("document_id", "version", "base", "noise", "quote", "link")


def doc_types(spark: SparkSession, sf: str) -> DataFrame:
    return ws.document_types(_documents(spark, sf)).select("document_id", "doc_type")


def prefilter_sources(spark: SparkSession, sf: str) -> DataFrame:
    return ws.prefilter_sources(_described(spark, sf), CAP).select(
        "project_id", "document_id", "version", "base", F.col("kept_order").cast("bigint").alias("kept_order")
    )


def source_fallback(spark: SparkSession, sf: str) -> DataFrame:
    return ws.select_sources(_described(spark, sf), CAP, FALLBACK, MINIMUM).select(
        "project_id", "document_id", "branch", F.col("index").cast("bigint").alias("index")
    )


def source_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _sources(spark, sf).withColumn("index", F.col("index").cast("bigint"))


def source_table_md(spark: SparkSession, sf: str) -> DataFrame:
    return _lists(spark, sf).select("project_id", source_table(F.col("sources")).alias("source_table"))


def background_paragraph(spark: SparkSession, sf: str) -> DataFrame:
    return pg.with_background(fixture(spark, sf, "fx_projects")).select("project_id", "background")


def no_source_page(spark: SparkSession, sf: str) -> DataFrame:
    return pg.no_source_pages(fixture(spark, sf, "fx_projects"), _links(spark, sf))


def _prompts(spark: SparkSession, sf: str) -> DataFrame:
    return pg.wiki_prompts(fixture(spark, sf, "fx_projects"), _lists(spark, sf))


def wiki_prompts(spark: SparkSession, sf: str) -> DataFrame:
    prompts = _prompts(spark, sf)
    return prompts.select(
        "project_id", "background", F.to_json("sources").alias("sources"),
        F.endswith("prompt", F.lit(pg.PROMPT_RULES + "\n")).alias("has_rules"),
    )


def batch_generate(spark: SparkSession, sf: str) -> DataFrame:
    return pg.template_bodies(_prompts(spark, sf)).select("project_id", "body")


def batch_generate_by_function(spark: SparkSession, sf: str) -> DataFrame:
    """A stand-in writer: title and background taken out of the prompt."""

    def writer(batch: pd.DataFrame) -> pd.Series:
        return batch["prompt"].str.split("\n\nSource documents:\n", n=1).str[0]

    return pg.batch_generate(_prompts(spark, sf), writer)


def _own_section(body):
    """Give a body a source section of its own, which has to be replaced."""
    return F.concat(body, F.lit("\n## SOURCE documents  \n\n| made up | [7] |\n"))


def replace_sources_section(spark: SparkSession, sf: str) -> DataFrame:
    bodies = pg.template_bodies(_prompts(spark, sf)).withColumn("body", _own_section(F.col("body")))
    table = source_table(F.col("sources"))
    return bodies.select("project_id", pg.replace_sources_section(F.col("body"), table).alias("markdown"))


def linkify_citations(spark: SparkSession, sf: str) -> DataFrame:
    """Single and grouped citations, linked and parenthesised ones, numbers without a source and of any length."""
    text = F.concat(
        F.lit("See [1] and [1, 2],[02][99]; kept [1](u), ([2]), [x]. Of "), "project_id",
        F.lit(": [99999999999999999999], [1, 99999999999999999999]"),
    )
    return _lists(spark, sf).select(
        "project_id", pg.linkify_citations(text, pg.source_links(F.col("sources"))).alias("linked")
    )


def finalize_pages(spark: SparkSession, sf: str) -> DataFrame:
    bodies = pg.template_bodies(_prompts(spark, sf)).withColumn("body", _own_section(F.col("body")))
    return pg.finalize_pages(bodies)


def _page_columns(pages: DataFrame) -> DataFrame:
    return pages.select(
        "project_id", "project_no", "project_name", "client_company", "project_manager", "project_members", "status_name", "tags",
        F.date_format("generated_at", "yyyy-MM-dd HH:mm:ss").alias("generated_at"),
        F.array_join("source_document_ids", ",").alias("source_document_ids"),
        F.array_join(
            F.transform("source_documents", lambda s: F.concat_ws(" ", s["index"].cast("string"), s["type"], s["url"])), ";"
        ).alias("source_documents"),
        F.md5(F.array_join("chunks", "")).alias("markdown_md5"), "wiki_status", "generated_by_model", "markdown_chunked",
        F.col("markdown_chunk_count").cast("bigint").alias("markdown_chunk_count"), "markdown_total_bytes",
    )


def page_records(spark: SparkSession, sf: str) -> DataFrame:
    projects = fixture(spark, sf, "fx_projects")
    return _page_columns(write_pages(projects, fixture(spark, sf, "fx_map"), _documents(spark, sf), AS_OF, SETTINGS))


def wiki_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Outcome of writing the pages of all projects with mapped documents."""
    projects = fixture(spark, sf, "fx_projects")
    mapped = sel.mapped_project_counts(fixture(spark, sf, "fx_map"), None)
    chosen = projects.join(mapped.select("project_id"), "project_id", "left_semi")
    pages = write_pages(chosen, fixture(spark, sf, "fx_map"), _documents(spark, sf), AS_OF, SETTINGS)
    attempts = chosen.select("project_id").join(pages.select("project_id", "wiki_status"), "project_id", "left").select(
        "project_id", F.when(F.col("wiki_status").isNull(), "no page written").alias("error")
    )
    return pg.batch_outcome(attempts)


# --- whole runs -------------------------------------------------------------------------------


def _project_rows(spark: SparkSession, sf: str, place: str | None = None) -> DataFrame:
    if place is None:
        place = new_place(spark, "landing")
        landed_pages(spark, sf, place)
    dimensions = Dimensions(_users(spark, sf), _companies(spark, sf), _contacts(spark, sf))
    return project_rows(read_pages(spark, place), STATUSES, dimensions, prefix="prj_")


def _partly_broken_pages(spark: SparkSession, sf: str) -> str:
    """Landed pages, and a line that ends early for every fiftieth project."""
    place = new_place(spark, "landing")
    landed_pages(spark, sf, place)
    lines = fixture(spark, sf, "fx_projects").filter("k % 50 = 0").select(F.concat(F.lit('{"page":'), F.col("k").cast("string")).alias("value"))
    lines.write.mode("append").text(place)
    return place


def scan_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Landed lines and search results that cannot be read."""
    results = _documents(spark, sf).select(
        F.expr(
            """case pk % 9 when 0 then '{"document": ' || document_id when 1 then '{"document": {"title": "' || document_id || '"}}'
             else '{"document": {"id": "' || document_id || '"}}' end"""
        ).alias("result")
    )
    return scan_pages(spark, _partly_broken_pages(spark, sf))[1].unionByName(search_result_errors(results))


def _unsure_scorer(batch: pd.DataFrame) -> pd.Series:
    """A stand-in scorer: some replies are no JSON, some state a score in words, the others match nothing."""
    kind = batch["project_id"].str.slice(4).astype("int64") % 13
    worded = '{"matches": [{"document_id": "d", "decision": "strong_match", "confidence_score": "high"}]}'
    return kind.map({5: "{ no json", 6: worded}).fillna('{"matches": []}')


def full_sync_errors(spark: SparkSession, sf: str) -> DataFrame:
    place = _partly_broken_pages(spark, sf)
    settings = runs.RunSettings("run_1", AS_OF, wiki=SETTINGS, scorer=_unsure_scorer)
    tables = runs.full_sync(
        spark, runs.empty_tables(spark), _project_rows(spark, sf, place), landed_search(spark, sf), settings, scan_pages(spark, place)[1]
    )
    return tables["errors"].select("run_id", "job_name", "key", "error")


def _number_of(ids: pd.Series) -> pd.Series:
    return ids.str.slice(4).astype("int64")


def _failing_scorer(batch: pd.DataFrame) -> pd.Series:
    """A stand-in scorer that raises at every thirteenth project and takes the first document of the others."""
    import json

    if (_number_of(batch["project_id"]) % 13 == 5).any():
        raise ValueError("no reply")
    first = batch["documents"].map(lambda d: json.loads(d)[0]["document_id"])
    match = {"decision": "strong_match", "confidence_score": 0.9, "reason": "first"}
    return first.map(lambda d: json.dumps({"matches": [match | {"document_id": d}]}))


def _failing_writer(batch: pd.DataFrame) -> pd.Series:
    if (_number_of(batch["project_id"]) % 11 == 3).any():
        raise ValueError("no page")
    return "# " + batch["project_id"]


def full_sync_failures(spark: SparkSession, sf: str) -> DataFrame:
    """Pages and errors of a run whose scorer and writer fail at some projects."""
    settings = runs.RunSettings("run_1", AS_OF, wiki=SETTINGS, scorer=_failing_scorer, writer=_failing_writer)
    tables = runs.full_sync(spark, runs.empty_tables(spark), _project_rows(spark, sf), landed_search(spark, sf), settings)
    errors = tables["errors"].select("job_name", F.col("key").alias("project_id"), "error")
    pages = tables["pages"].select(F.lit("wiki-generate").alias("job_name"), "project_id", F.lit(None).cast("string").alias("error"))
    return errors.unionByName(pages)


def landed_search(spark: SparkSession, sf: str):
    """Search results as landed files would give them: a query with an order's number finds its documents."""
    documents = _documents(spark, sf)
    number = F.concat(F.lit(""), (500000 + F.col("ok")).cast("string"))
    results = documents.select(
        number.alias("query_id"), F.col("pk").alias("result_pos"), "document_id", F.lit("discovery_engine").alias("source_system"),
        F.lit("search_result").alias("source_type"), "title", F.lit("").alias("folder_path"), "url", "source_url",
        F.lit("").alias("author"), "text_preview", "full_text",
    )
    return lambda requests: results.join(requests.select("query_id"), "query_id", "left_semi")


def _run(spark: SparkSession, sf: str, mode: str) -> runs.Tables:
    settings = runs.RunSettings("run_1", AS_OF, project_limit=None, wiki=SETTINGS)
    step = runs.historical_sync if mode == "all" else runs.full_sync
    return step(spark, runs.empty_tables(spark), _project_rows(spark, sf), landed_search(spark, sf), settings)


def full_sync_twice(spark: SparkSession, sf: str) -> DataFrame:
    """The stored tables after a whole run and a second one that lands every tenth project again."""
    folder = new_place(spark, "tables")
    settings = runs.RunSettings("run_1", AS_OF, wiki=SETTINGS, folder=folder)
    rows, search = settle(_project_rows(spark, sf), "rows"), landed_search(spark, sf)
    runs.full_sync(spark, runs.load_tables(spark, folder), rows, search, settings)
    some = rows.filter("cast(substr(project_id, 5) as bigint) % 10 = 0")
    again = replace(settings, run_id="run_2")
    return _stored_columns(spark, runs.full_sync(spark, runs.load_tables(spark, folder), some, search, again))


def _stored_columns(spark: SparkSession, tables: runs.Tables) -> DataFrame:
    texts = pg.reassembled_pages(tables["pages"], tables["chunks"])
    return tables["pages"].join(texts, "project_id").select(
        "project_id", "project_name", "project_members", "wiki_status",
        F.array_join("source_document_ids", ",").alias("source_document_ids"), F.md5("text").alias("markdown_md5"),
        F.col("markdown_chunk_count").cast("bigint").alias("markdown_chunk_count"), "markdown_total_bytes",
    )


def full_sync(spark: SparkSession, sf: str) -> DataFrame:
    return _stored_columns(spark, _run(spark, sf, "active"))


def historical_sync(spark: SparkSession, sf: str) -> DataFrame:
    return _stored_columns(spark, _run(spark, sf, "all"))


def full_sync_run_log(spark: SparkSession, sf: str) -> DataFrame:
    return _run(spark, sf, "active")["runs"].select("run_id", "job_name", "status", "records_read", "records_written")


def single_project(spark: SparkSession, sf: str) -> DataFrame:
    """The page of the project with most mapped documents."""
    tables = {
        "projects": fixture(spark, sf, "fx_projects"),
        "document_map": fixture(spark, sf, "fx_map"),
        "documents": _documents(spark, sf),
    }
    project_id = sel.mapped_project_counts(tables["document_map"], 1).first()["project_id"]
    settings = runs.RunSettings("run_1", AS_OF, wiki=SETTINGS)
    return _page_columns(runs.single_project(tables, project_id, settings))


def stored_project(spark: SparkSession, sf: str) -> DataFrame:
    """The same page out of stored tables, of which only the buckets of its keys are read."""
    folder = new_place(spark, "stored-project")
    projects, mapped, documents = fixture(spark, sf, "fx_projects"), fixture(spark, sf, "fx_map"), _documents(spark, sf)
    for name, key, rows in (("projects", "project_id", projects), ("documents", "document_id", documents)):
        rows = align_to_schema(rows, runs.SCHEMAS[name], fill_text=False)
        merge_table(spark, folder, name, runs.SCHEMAS[name], [key], rows, lambda _, rows=rows: rows)
    append_table(spark, folder, "document_map", align_to_schema(mapped, runs.SCHEMAS["document_map"], fill_text=False))
    project_id = sel.mapped_project_counts(mapped, 1).first()["project_id"]
    settings = runs.RunSettings("run_1", AS_OF, wiki=SETTINGS, folder=folder)
    return _page_columns(runs.stored_project(spark, project_id, settings))


def search_by_content(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates that the own index finds for every open project in the corpus of documents.

    The corpus is the stand-in documents with title and text; every project asks all its queries.
    """
    from casebook.plans.steps import discover

    corpus = _documents(spark, sf).withColumn("full_text", F.concat_ws(" ", "title", "text_preview", "full_text"))
    projects = sel.open_projects(fixture(spark, sf, "fx_projects"))
    _, candidates = discover(projects, corpus_search(corpus, k=3))
    return candidates.select("project_id", "document_id", "rank", "discovery_query")


def incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of the batch run, although later files list some projects again, under a status that is pulled later."""
    landing, versions, progress = (new_place(spark, n) for n in ("landing", "projects", "progress"))
    landed_pages(spark, sf, landing, files=4)
    again = F.replace(F.to_json("rec"), F.lit('"project_name":"'), F.lit('"project_name":"Late '))
    late = records(spark, sf).filter("status in ('inprogress', 'Pending')").select(
        F.concat(F.lit('{"status":"future","page":9999,"data":['), again, F.lit("]}")).alias("value")
    )
    late.repartition(2).write.mode("append").text(landing)
    users, companies, contacts = _users(spark, sf), _companies(spark, sf), _contacts(spark, sf)

    def normalize(raw: DataFrame) -> DataFrame:
        records = raw.withColumn("related", F.lit(None).cast("variant"))
        return normalize_projects(records, users, companies, contacts, prefix="prj_")

    query = start_ingest(spark, landing, versions, progress, STATUSES, normalize, AS_OF, files_per_batch=2)
    query.awaitTermination()
    return newest_version(spark, versions).select(
        "project_id", "project_name", "status", "client_company", "client_contacts", "project_members",
        F.col("start_date").cast("string").alias("start_date"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        title_features, doc_types, prefilter_sources, source_fallback, source_documents, source_table_md, background_paragraph,
        no_source_page, wiki_prompts, batch_generate, batch_generate_by_function, replace_sources_section, linkify_citations,
        finalize_pages, page_records, wiki_batch, full_sync, historical_sync, full_sync_run_log, single_project,
        search_by_content, incremental_ingest, scan_errors, full_sync_errors, full_sync_failures,
        full_sync_twice, stored_project,
    )
}

VERSION = r"[_\s-]v(\d+)([_.\s]|$)"
NOISE = r"Utilization_Report|PLANNING\s|Agency_Purchased|project.categories|\bJira\b|^TV\s*-\s*\d|_OP\s+Summary_|Handover_"


def page_definitions(prefix: str, facts: str, links: str) -> dict[str, str]:
    """The chain from linked documents to final pages, over a CTE of project facts and one of links."""
    p = prefix
    return {
        f"{p}_docs": f"""select l.project_id, l.position, t.*, f.project_no, contains(t.title, f.project_no) as own
 from {links} l join ex_titles t on t.document_id = l.document_id join {facts} f on f.project_id = l.project_id where l.position <= {SOURCES}""",
        f"{p}_kept": f"""select *, row_number() over (partition by project_id order by version desc, base_position) as kept_order from
 (select *, min(position) over (partition by project_id, base) as base_position, row_number() over (partition by project_id, base order by version desc, position) as nth
  from {p}_docs where not noise and (own or quote) and not ((contains(title, '_OP Summary_') or contains(title, '_OP_Summary_')) and not own)) where nth = 1""",
        f"{p}_counts": f"select d.project_id, (select count(*) from {p}_kept k where k.project_id = d.project_id and k.kept_order <= {CAP}) as n from (select distinct project_id from {p}_docs) d",
        f"{p}_chosen": f"""select project_id, document_id, 'filtered' as branch, 0 as part, kept_order as ord from {p}_kept where kept_order <= {CAP}
 union all select d.project_id, d.document_id, 'fallback', 0, d.position from {p}_docs d join {p}_counts c on c.project_id = d.project_id where c.n = 0 and d.position <= {FALLBACK}
 union all select d.project_id, d.document_id, 'supplement', 1, d.position from {p}_docs d join {p}_counts c on c.project_id = d.project_id
  where c.n > 0 and c.n < {MINIMUM} and not d.noise and not exists (select 1 from {p}_kept k where k.project_id = d.project_id and k.document_id = d.document_id and k.kept_order <= {CAP})""",
        f"{p}_listed": f"""select * from (select project_id, document_id, branch, row_number() over (partition by project_id order by part, ord) as index from {p}_chosen)
 where branch = 'fallback' or index <= {CAP}""",
        f"{p}_sources": f"""select l.project_id, l.index, d.title, l.document_id, t.type, case when d.source_url <> '' then d.source_url when d.url like 'http%' then d.url else '' end as url,
 left(coalesce(nullif(d.full_text, ''), d.text_preview), 18000) as content
 from {p}_listed l join fx_documents d on d.document_id = l.document_id join ex_titles t on t.document_id = l.document_id""",
        f"{p}_tables": f"""select project_id, concat('## Source Documents', chr(10), chr(10), '| # | Document | Type | Link |', chr(10), '|---|----------|------|------|',
 string_agg(chr(10) || '| ' || index || ' | ' || case when url <> '' then '[' || title || '](' || url || ')' else title end || ' | ' || type || ' | ' ||
  case when url <> '' then '[Open ↗](' || url || ')' else '—' end || ' |', '' order by index)) as source_table from {p}_sources group by project_id""",
        f"{p}_background": f"""select project_id, concat_ws(' ',
 case when project_type <> '' then project_no || ' is a ' || project_type || ' project' ||
  case when client_company <> '' then ' for ' || client_company || case when business_area <> '' then ' in the ' || business_area || ' practice area' else '' end else '' end ||
  case when start_text <> '' or due_text <> '' then ', running ' || coalesce(nullif(start_text, ''), '?') || ' to ' || coalesce(nullif(due_text, ''), 'ongoing') else '' end || '.' end,
 case when client_contacts <> '' then 'Client-side contacts: ' || client_contacts || '.' end,
 case when description <> '' then rtrim(trim(description), '.') || '.' end,
 case when manager || project_members <> '' then 'The Agency team on this project: ' || concat_ws(', ', nullif(manager, ''), nullif(project_members, '')) || '.' end,
 case when client_country <> '' then 'Client country: ' || client_country || '.' end,
 case when po_number <> '' then 'PO reference: ' || po_number || '.' end,
 case when tags <> '' then 'Tags: ' || tags || '.' end) as background from {facts}""",
        f"{p}_bodies": f"""select f.project_id, '# ' || project_name || chr(10) || chr(10) || '## Overview' || chr(10) || chr(10) || background || chr(10) || chr(10) || '## Findings' || chr(10) as head,
 notes, linked_notes from {facts} f join {p}_background b on b.project_id = f.project_id join
 (select project_id, string_agg(chr(10) || '- ' || note || ' [' || index || ']', '' order by index) as notes,
  string_agg(chr(10) || '- ' || note || ' [' || index || '](' || coalesce(nullif(url, ''), '#source-' || index) || ')', '' order by index) as linked_notes from
  (select *, coalesce(nullif(trim(split_part(content, '.', 1)), ''), title) as note from {p}_sources) group by project_id) n on n.project_id = f.project_id""",
        f"{p}_no_sources": f"""select project_id, '# ' || project_name || chr(10) || chr(10) || trim('Agency runs project **' || project_no || '** ' ||
 concat_ws(' ', case when client_company <> '' then 'for **' || client_company || '**' end, case when project_type <> '' then '(' || project_type || ')' end)) || '.' ||
 case when description <> '' then chr(10) || chr(10) || description else '' end || coalesce(chr(10) || chr(10) || '## Overview' || chr(10) || chr(10) || nullif(concat_ws(chr(10),
  case when status_text <> '' then '- **Status:** ' || status_text end,
  case when start_text <> '' or due_text <> '' then '- **Period:** ' || coalesce(nullif(start_text, ''), '—') || ' → ' || coalesce(nullif(due_text, ''), 'ongoing') end,
  case when manager <> '' then '- **Project manager:** ' || manager end, case when project_members <> '' then '- **Team:** ' || project_members end,
  case when client_contacts <> '' then '- **Client contacts:** ' || client_contacts end, case when business_area <> '' then '- **Business area:** ' || business_area end,
  case when client_country <> '' then '- **Client country:** ' || client_country end, case when tags <> '' then '- **Tags:** ' || tags end), ''), '') ||
 chr(10) || chr(10) || '_Document intelligence for this project is still being indexed._' as markdown from {facts}
 where project_id not in (select project_id from {links})""",
        f"{p}_final": f"""select b.project_id, head || linked_notes || chr(10) || chr(10) || source_table as markdown from {p}_bodies b join {p}_tables t on t.project_id = b.project_id
 union all select project_id, markdown from {p}_no_sources""",
        # One step per chunk: the texts have no multi-byte character except in the table, so cuts are found by bytes.
        f"{p}_chars": f"""select project_id, c.nr, sum(octet_length(encode(c.ch))) over (partition by project_id order by c.nr) as bytes from
 (select project_id, unnest(list_transform(regexp_extract_all(markdown, '(?s).'), lambda ch, nr: {{'ch': ch, 'nr': nr}})) as c from {p}_final)""",
        f"{p}_cuts": f"""select project_id, 0 as index, cast(0 as hugeint) as from_bytes from {p}_final
 union all select c.project_id, c.index + 1, max(h.bytes) from {p}_cuts c join {p}_chars h on h.project_id = c.project_id
  and h.bytes > c.from_bytes and h.bytes <= c.from_bytes + {CHUNK_LIMIT} group by c.project_id, c.index, c.from_bytes""",
        f"{p}_chunks": f"select project_id, max(index) as chunk_count, max(from_bytes) as total_bytes from {p}_cuts group by project_id",
        f"{p}_pages": f"""select f.*, m.markdown, i.ids, s.shown, cast(c.chunk_count as bigint) as chunk_count, cast(c.total_bytes as bigint) as total_bytes,
 case when i.ids is null then 'no_sources' when c.chunk_count > 1 then 'generated_chunked' else 'generated' end as wiki_status
 from {facts} f join {p}_final m on m.project_id = f.project_id join {p}_chunks c on c.project_id = f.project_id
 left join (select project_id, string_agg(document_id, ',' order by position) as ids from {links} group by project_id) i on i.project_id = f.project_id
 left join (select project_id, string_agg(concat_ws(' ', index, type, url), ';' order by index) as shown from {p}_sources group by project_id) s on s.project_id = f.project_id""",
    }


DEFINITIONS = DISCOVERY_DEFINITIONS | {
    "ex_titles": rf"""select *, regexp_replace(lower(regexp_replace(title, '{VERSION}', '', 'gi')), '[._ -]+$', '') as base,
 coalesce(try_cast(nullif(regexp_extract(title, '{VERSION}', 1, 'i'), '') as bigint), 0) as version,
 regexp_matches(title, '{NOISE}', 'i') as noise, upper(title) like 'CE\_%' escape '\' as quote,
 case when ends_with(lower(title), '.pptx') then 'Presentation'
  when ends_with(lower(title), '.pdf') then case when starts_with(lower(title), 'ce_') or contains(lower(title), 'quote') then 'Cost Estimate'
   when contains(lower(title), 'po') then 'PO Summary' else 'PDF Deliverable' end
  when ends_with(lower(title), '.indd') then 'InDesign File' when ends_with(lower(title), '.png') then 'Image Asset'
  when ends_with(lower(title), '.docx') then 'Word Document' when ends_with(lower(title), '.xlsx') then 'Spreadsheet'
  when starts_with(lower(title), 'ce_') then 'Cost Estimate' else 'Document' end as type from (select document_id, title, url as shown_url from fx_documents)""",
    "ex_wiki_facts": """select project_id, project_no, project_name, client_company, '' as client_contacts, '' as manager, '' as project_members,
 coalesce(status, '') as status_text, project_type, '' as business_area, client_country, tags, '' as po_number, description,
 coalesce(cast(start_date as varchar), '') as start_text, coalesce(cast(due_date as varchar), '') as due_text from fx_projects""",
    **page_definitions("ex_wiki", "ex_wiki_facts", "ex_mapped_links"),
    # The whole run: every landed project, its own documents by number, the evidence rules.
    "ex_landed": """select n.* replace (case when r.k % 3 = 1 then case when r.direct <> '' then r.direct else r.company_name end else n.client_company end as client_company,
  split_part(n.project_name, '_', 2) as client_contacts, coalesce(t.team, '') as project_members)
 from ex_normalized n join ex_client_direct r on r.k = n.k left join ex_landed_team t on t.k = n.k where n.k <> 0 and r.status is not null""",
    "ex_landed_team": """select k, string_agg(name, ', ' order by ord) as team from
 (select k, trim(name) as name, min(ord) as ord from ex_mentions where trim(name) <> '' and ord <> 1000002 group by k, trim(name)) group by k""",
    "ex_run_pairs": rf"""select p.project_id, d.document_id, row_number() over (partition by p.project_id order by d.pk, d.document_id) as rank, d.title as shown_title,
 lower(d.title) as title, {WORDS.format('d.title')} as name, {WORDS.format("d.title || ' ' || d.text_preview")} as body,
 {WORDS.format('p.project_no')} as no, {WORDS.format('c.clean_name')} as clean, {WORDS.format('p.client_company')} as client, p.project_no, p.status, p.k,
 regexp_extract(lower(d.title), '^(\d{{5,}})_', 1) as lead_no
 from ex_landed p join ex_clean c on c.k = p.k join fx_documents d on cast(500000 + d.ok as varchar) = p.project_no""",
    "ex_run_decided": r"""select project_id, document_id, status, rank, case when regexp_matches(title, 'org[ _-]?chart|holiday|timesheet|employee[ _-]list|curriculum|(^|[_ ])(cv|hr)([_ .]|$)') then 0.05
 when contains(name, no) then 0.95 when lead_no <> '' and lead_no <> project_no then 0.10
 when starts_with(title, 'handover_') and not contains(body, clean) then 0.15
 when client <> '  ' and contains(body, client) and contains(body, clean) then 0.90
 when contains(body, no) then 0.85 when contains(body, clean) then 0.80 else 0.20 end as confidence_score from ex_run_pairs""",
    "ex_run_links": """select project_id, document_id, confidence_score, status, row_number() over (partition by project_id order by confidence_score desc, document_id) as position
 from ex_run_decided where confidence_score >= 0.75""",
    "ex_open_links": f"""select * from ex_run_links where lower(status) not in ('done', 'completed', 'cancelled', 'closed', 'future')""",
    "ex_run_facts": """select project_id, project_no, project_name, client_company, client_contacts, project_manager as manager, project_members, status as status_text,
 project_type, business_area, client_country, tags, po_number, description, coalesce(start_date, '') as start_text, coalesce(due_date, '') as due_text from ex_landed""",
    "ex_open_facts": "select * from ex_run_facts where project_id in (select project_id from ex_open_links)",
    "ex_all_facts": "select * from ex_run_facts where project_id in (select project_id from ex_run_links)",
    **page_definitions("ex_open", "ex_open_facts", "ex_open_links"),
    **page_definitions("ex_all", "ex_all_facts", "ex_run_links"),
}

PAGE_COLUMNS = """project_id, project_no, project_name, client_company, manager as project_manager, project_members, status_text as status_name, tags,
 '2026-01-02 03:04:05' as generated_at, coalesce(ids, '') as source_document_ids, shown as source_documents, md5(markdown) as markdown_md5, wiki_status,
 case when ids is null then 'none' else 'template' end as generated_by_model, chunk_count > 1 as markdown_chunked, chunk_count as markdown_chunk_count, total_bytes as markdown_total_bytes"""
STORED_COLUMNS = """project_id, project_name, project_members, wiki_status, coalesce(ids, '') as source_document_ids, md5(markdown) as markdown_md5,
 chunk_count as markdown_chunk_count, total_bytes as markdown_total_bytes"""

ORACLES = {
    "title_features": "select document_id, version, base, noise, quote, case when shown_url like 'http%' then shown_url else '' end as link from ex_titles",
    "doc_types": "select document_id, type as doc_type from ex_titles",
    "prefilter_sources": f"select project_id, document_id, version, base, kept_order from ex_wiki_kept where kept_order <= {CAP}",
    "source_fallback": "select project_id, document_id, branch, index from ex_wiki_listed",
    "source_documents": "select project_id, index, title, document_id, type, url, content from ex_wiki_sources",
    "source_table_md": "select project_id, source_table from ex_wiki_tables",
    "background_paragraph": "select project_id, background from ex_wiki_background",
    "no_source_page": "select project_id, markdown from ex_wiki_no_sources",
    "wiki_prompts": """select s.project_id, b.background, s.sources, true as has_rules from ex_wiki_background b join
 (select project_id, cast(to_json(list({'index': index, 'title': title, 'document_id': document_id, 'type': type, 'url': url, 'content': content} order by index)) as varchar) as sources
  from ex_wiki_sources group by project_id) s on s.project_id = b.project_id""",
    "batch_generate": "select project_id, head || notes || chr(10) as body from ex_wiki_bodies",
    "batch_generate_by_function": """select b.project_id, '# ' || project_name || chr(10) || chr(10) || 'Background:' || chr(10) || background as body
 from ex_wiki_background b join ex_wiki_facts f on f.project_id = b.project_id where b.project_id in (select project_id from ex_wiki_sources)""",
    "replace_sources_section": """select b.project_id, head || notes || chr(10) || chr(10) || source_table as markdown
 from ex_wiki_bodies b join ex_wiki_tables t on t.project_id = b.project_id""",
    "linkify_citations": """select project_id, 'See [1](' || one || ') and [1](' || one || '), [2](' || two || '),[2](' || two || ')[99](#source-99); kept [1](u), ([2]), [x]. Of ' || project_id ||
 ': [99999999999999999999](#source-99999999999999999999), [1](' || one || '), [99999999999999999999](#source-99999999999999999999)' as linked from
 (select project_id, coalesce(nullif(max(url) filter (index = 1), ''), '#source-1') as one, coalesce(nullif(max(url) filter (index = 2), ''), '#source-2') as two
  from ex_wiki_sources group by project_id)""",
    "finalize_pages": "select project_id, markdown from ex_wiki_final where project_id in (select project_id from ex_wiki_bodies)",
    "page_records": f"select {PAGE_COLUMNS} from ex_wiki_pages",
    "wiki_batch": """select count(*) as projects_succeeded, 0 as projects_failed, 'ok' as status from ex_wiki_final
 where project_id in (select project_id from fx_map)""",
    "full_sync": f"select {STORED_COLUMNS} from ex_open_pages",
    "full_sync_twice": f"select {STORED_COLUMNS} from ex_open_pages",
    "historical_sync": f"select {STORED_COLUMNS} from ex_all_pages",
    "full_sync_run_log": """select 'run_1' as run_id, job_name, 'success' as status, records_read, records_written from (
 select 'scoro-sync' as job_name, count(*) as records_read, count(*) as records_written from ex_landed
 union all select 'document-discovery', (select count(*) from ex_landed where lower(status) not in ('done', 'completed', 'cancelled', 'closed', 'future')),
  (select count(*) from ex_run_decided where lower(status) not in ('done', 'completed', 'cancelled', 'closed', 'future'))
 union all select 'taxonomy-sync', (select count(*) from ex_run_decided where lower(status) not in ('done', 'completed', 'cancelled', 'closed', 'future')), (select count(*) from ex_open_links)
 union all select 'wiki-generate', (select count(*) from ex_open_facts), (select count(*) from ex_open_facts)
 union all select 'full-sync', 0, 0)""",
    "scan_errors": """select 'landed page' as key, 'unreadable line' as error, '{"page":' || k as record from fx_projects where k % 50 = 0
 union all select 'search result', case pk % 9 when 0 then 'unreadable result' else 'result without id and name' end,
  case pk % 9 when 0 then '{"document": ' || document_id else '{"document": {"title": "' || document_id || '"}}' end from fx_documents where pk % 9 < 2""",
    "full_sync_errors": """select 'run_1' as run_id, 'scoro-sync' as job_name, 'landed page' as key, 'unreadable line' as error from fx_projects where k % 50 = 0
 union all select 'run_1', 'taxonomy-sync', project_id, e.error from
  (select distinct project_id, cast(substr(project_id, 5) as bigint) % 13 as kind from ex_run_decided
   where lower(status) not in ('done', 'completed', 'cancelled', 'closed', 'future')) p
  join (values (5, 'invalid JSON'), (6, 'score is no number'), (6, 'document was not asked about')) e(kind, error) on e.kind = p.kind""",
    "full_sync_failures": """select case when n % 13 = 5 then 'taxonomy-sync' else 'wiki-generate' end as job_name, project_id,
 case when n % 13 = 5 then 'request failed: ValueError: no reply' when n % 11 = 3 then 'page failed: ValueError: no page' end as error from
 (select distinct project_id, cast(substr(project_id, 5) as bigint) as n from ex_run_decided
  where lower(status) not in ('done', 'completed', 'cancelled', 'closed', 'future'))""",
    "single_project": f"""select {PAGE_COLUMNS} from ex_wiki_pages where project_id = (select project_id from fx_map group by project_id order by count(*) desc, project_id limit 1)""",
    "stored_project": f"""select {PAGE_COLUMNS} from ex_wiki_pages where project_id = (select project_id from fx_map group by project_id order by count(*) desc, project_id limit 1)""",
    "incremental_ingest": "select project_id, project_name, status, client_company, client_contacts, project_members, start_date from ex_landed",
}
