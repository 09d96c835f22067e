"""The four steps as functions from tables to tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions.text import first_filled
from casebook.operators.block_search import search_index
from casebook.operators.classify import (
    accept_matches,
    classifier_payload,
    evidence_score,
    mapping_rows,
    match_rows,
    parse_replies,
    project_facts,
    reply_errors,
    unasked_matches,
)
from casebook.operators.discovery import (
    decisive_hits,
    discover_candidates,
    hits_of_projects,
    project_queries,
    ranked_hits,
    search_requests,
    with_results,
)
from casebook.operators.isolation import isolated_values
from casebook.operators.normalize import budgeted_enrichment, normalize_projects
from casebook.operators.pages import (
    finalize_pages,
    no_source_pages,
    page_records,
    template_bodies,
    wiki_prompts,
)
from casebook.operators.retrieval import corpus_stats, extractive_passages, retrieve_top_k, term_index
from casebook.operators.selection import candidate_links, mapped_links
from casebook.operators.wiki_sources import named_sources, select_sources, source_lists, source_rows
from casebook.sources.durable import scratch, settle
from casebook.schemas import (
    CHUNK_BYTES,
    PROJECT_ID_PREFIX,
    SEARCH_PAGE_SIZE,
    WIKI_FALLBACK_LIMIT,
    WIKI_MIN_SOURCES,
    WIKI_PREFILTER_CAP,
    WIKI_SOURCE_LIMIT,
)
from casebook.sources.landed import first_seen, raw_projects
from casebook.sources.search_results import cut
from casebook.sources.term_store import TermStore

Search = Callable[[DataFrame], DataFrame]
Scorer = Callable[[pd.DataFrame], pd.Series]
Writer = Callable[[pd.DataFrame], pd.Series]


@dataclass(frozen=True)
class Dimensions:
    """Label tables of users, companies and contacts (see `operators.normalize`)."""

    users: DataFrame
    companies: DataFrame
    contacts: DataFrame


@dataclass(frozen=True)
class WikiSettings:
    source_limit: int = WIKI_SOURCE_LIMIT
    cap: int = WIKI_PREFILTER_CAP
    fallback: int = WIKI_FALLBACK_LIMIT
    minimum: int = WIKI_MIN_SOURCES
    chunk_bytes: int = CHUNK_BYTES
    content_chars: int | None = None
    org: str = "Agency"
    model: str = "template"


def project_rows(
    pages: DataFrame,
    statuses: Sequence[str],
    dimensions: Dimensions,
    details: DataFrame | None = None,
    related: DataFrame | None = None,
    budget: int | None = None,
    prefix: str = PROJECT_ID_PREFIX,
) -> DataFrame:
    """Step 1: landed pages to normalised project rows, enriched within the call budget."""
    raw = first_seen(raw_projects(pages, statuses)).withColumn("ord", F.struct("status_ord", "page", "pos"))
    if details is not None and related is not None:
        enriched = budgeted_enrichment(raw, details, related, dimensions.companies, budget)
    else:
        enriched = raw.withColumn("related", F.lit(None).cast("variant"))
    return normalize_projects(enriched, dimensions.users, dimensions.companies, dimensions.contacts, prefix)


def corpus_search(
    corpus: DataFrame,
    text: str = "full_text",
    k: int = SEARCH_PAGE_SIZE,
    preview_chars: int | None = None,
    text_chars: int | None = None,
    store: TermStore | None = None,
) -> Search:
    """Search over a documents table: BM25 hits with their best passages as document rows.

    A standing index (`store`, kept up to date by its `update`) is searched where there is one; else an index of the
    whole corpus is written once and read by every stage of the search.
    """
    if store is None:
        index = settle(term_index(corpus, text), "term-index")
        stats = settle(corpus_stats(corpus, text), "corpus-stats")

    def search(requests: DataFrame) -> DataFrame:
        found = retrieve_top_k(requests, index, stats, k) if store is None else search_index(store, requests, k)
        hits = settle(found, "hits")
        passages = extractive_passages(hits, requests, corpus, text)
        parts = F.array_join(
            F.filter(
                F.concat(F.array("snippet"), F.col("extractive_answers"), F.col("extractive_segments")["content"]),
                lambda part: part != "",
            ),
            "\n\n",
        )
        described = corpus.select("document_id", "title", "url", "source_url")
        return passages.withColumn("_parts", parts).join(described, "document_id").select(
            "query_id",
            "result_pos",
            "document_id",
            F.lit("discovery_engine").alias("source_system"),
            F.lit("search_result").alias("source_type"),
            "title",
            F.lit("").alias("folder_path"),
            "url",
            "source_url",
            F.lit("").alias("author"),
            cut(first_filled(F.col("snippet"), F.col("_parts")), preview_chars).alias("text_preview"),
            cut(F.col("_parts"), text_chars).alias("full_text"),
        )

    return search


def discover(projects: DataFrame, search: Search, description_chars: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Step 2: (document rows, candidate rows) found for the given projects; see `discover_all`."""
    return discover_all(projects, search, description_chars)[:2]


def discover_all(
    projects: DataFrame, search: Search, description_chars: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Document rows, candidate rows, and the queries (project_id, query, error) that the search could not answer.

    A search that isolates failures marks them by a column `error`; the other queries of a project count all the same.

    Hits are ranked and chosen by their keys; texts of the results join the chosen ones, once for both tables, as the hit
    that gives a document is one of the candidates.

    Projects are processed by start date, newest first; `project_ord` says so as a sort key.
    """
    queries = project_queries(projects, description_chars)
    failed = queries.limit(0).select("project_id", "query", F.lit("").alias("error"))
    with scratch(projects.sparkSession):  # the results, and what the search wrote to find them, end here
        results = settle(search(search_requests(queries)), "search-results")
        if "error" in results.columns:
            unanswered = results.where("error is not null").select(F.col("query_id").alias("query"), "error")
            failed = settle(queries.join(unanswered, "query").select("project_id", "query", "error"), "failed-queries", lasting=True)
            results = results.where("error is null").drop("error")
        hits = hits_of_projects(queries, results.select("query_id", "result_pos", "document_id"))
        turn = F.struct(
            F.when(F.col("start_date").isNull(), 1).otherwise(0), -F.unix_date("start_date"), F.col("project_id")
        ).alias("project_ord")
        ranked = ranked_hits(hits.join(projects.select("project_id", turn), "project_id"))
        described = [c for c in results.columns if c not in ("query_id", "result_pos", "document_id")]
        shown = [c for c in ("title", "url", "source_url", "text_preview") if c in described]
        keys = decisive_hits(discover_candidates(ranked))
        found = settle(with_results(keys, results, described), "found-hits", lasting=True)
    return (
        found.where("decisive").drop("decisive"),
        found.select(*[c for c in keys.columns if c != "decisive"], *shown),
        failed,
    )


def classify(
    projects: DataFrame,
    candidates: DataFrame,
    documents: DataFrame,
    run_id: str,
    as_of: datetime,
    k: int | None = None,
    scorer: Scorer | None = None,
    method: str = "evidence_rules",
    preview_chars: int | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame | None]:
    """Step 3: rows for the document map, by the native rules or a user-supplied batch scorer.

    Also returns errors (key, error, record): requests at which the scorer failed, replies that cannot be read, scores
    that are no number, matches of documents nobody asked about; the (project_id, document_id) that were decided on; and
    with a scorer the attempts (project_id, error).
    """
    links = settle(candidate_links(candidates.join(projects.select("project_id"), "project_id", "left_semi"), documents, k), "asked")
    asked = links.select("project_id", "document_id")
    if scorer is None:
        described = documents.select("document_id", "title", "folder_path", "text_preview")
        pairs = links.join(described, "document_id").join(project_facts(projects), "project_id")
        matches = evidence_score(pairs).withColumn("evidence", F.lit(None).cast("string"))
        errors = asked.limit(0).select(*[F.lit("").alias(c) for c in ("key", "error", "record")])
        attempts = None
    else:
        payload = classifier_payload(projects, links.join(documents, "document_id"), preview_chars)
        attempts = settle(isolated_values(payload, scorer, "reply"), "replies")
        replies = attempts.where("error is null").drop("error")
        parsed = parse_replies(replies)
        matches = match_rows(parsed)
        unread = reply_errors(parsed, matches).join(replies, "project_id").select(
            F.col("project_id").alias("key"), "error", F.col("reply").alias("record")
        )
        unasked = unasked_matches(matches, asked).select(
            F.col("project_id").alias("key"), F.lit("document was not asked about").alias("error"), F.col("document_id").alias("record")
        )
        errors = failures_of(attempts, "request failed: ").unionByName(unread).unionByName(unasked)
    return mapping_rows(accept_matches(matches), method, run_id, as_of), errors, asked, attempts


def failures_of(attempts: DataFrame, prefix: str) -> DataFrame:
    """Error rows (key, error, record) of the attempts (project_id, error) that failed."""
    return attempts.where("error is not null").select(
        F.col("project_id").alias("key"), F.concat(F.lit(prefix), "error").alias("error"), F.lit(None).cast("string").alias("record")
    )


def write_pages(
    projects: DataFrame,
    document_map: DataFrame,
    documents: DataFrame,
    as_of: datetime,
    settings: WikiSettings = WikiSettings(),
    writer: Writer | None = None,
) -> DataFrame:
    """Step 4: page rows with chunks for the given projects, from their mapped documents; a failing writer raises."""
    pages, attempts = write_all_pages(projects, document_map, documents, as_of, settings, writer)
    if attempts is not None and (failed := attempts.where("error is not null").first()):
        raise RuntimeError(f"{failed.project_id}: {failed.error}")
    return pages


def write_all_pages(
    projects: DataFrame,
    document_map: DataFrame,
    documents: DataFrame,
    as_of: datetime,
    settings: WikiSettings = WikiSettings(),
    writer: Writer | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """The pages that could be written, and with a writer the attempts (project_id, error)."""
    own_map = document_map.join(projects.select("project_id"), "project_id", "left_semi")
    links = settle(mapped_links(own_map, documents), "page-links")
    best = links.filter(F.col("position") <= settings.source_limit)
    numbers = projects.select("project_id", first_filled(F.col("project_no"), F.col("project_id")).alias("project_no"))
    described = documents.select("document_id", "title", "source_url", "url")
    docs = best.join(described, "document_id").join(numbers, "project_id")
    chosen = select_sources(docs, settings.cap, settings.fallback, settings.minimum, settings.org)
    selected = settle(chosen, "page-sources")
    sources = source_lists(source_rows(selected, documents, settings.content_chars))
    prompts = wiki_prompts(projects, sources, settings.org)
    if writer is None:
        bodies, attempts = template_bodies(prompts), None
    else:
        attempts = settle(isolated_values(prompts.select("project_id", "prompt"), writer, "body"), "page-bodies")
        bodies = attempts.where("error is null").drop("error").join(sources, "project_id")
    markdown = finalize_pages(bodies).unionByName(no_source_pages(projects, links, settings.org))
    named = source_lists(named_sources(selected))
    return page_records(projects, links, named, markdown, settings.model, as_of, settings.chunk_bytes), attempts
