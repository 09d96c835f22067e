"""Wiki pages: background, prompt, body, final Markdown, page and chunk tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions.markdown import (
    linkify_citations,
    replace_sources_section,
    source_links,
    source_table,
    utf8_chunks,
)
from casebook.functions.text import first_filled, is_filled, rstrip, strip
from casebook.schemas import CHUNK_BYTES, CHUNKS, PAGES

ORG = "Agency"
PAGE_FACTS = (
    "project_name", "client_company", "client_contacts", "project_members", "project_type", "business_area",
    "client_country", "tags", "po_number", "google_drive_link", "start_date", "due_date", "description",
)


def page_facts(projects: DataFrame) -> DataFrame:
    """Project facts as text, missing ones empty; number, manager and status with their fallbacks."""

    def fact(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in projects.columns else F.lit("")

    return projects.select(
        "project_id",
        first_filled(fact("project_no"), F.col("project_id")).alias("project_no"),
        first_filled(fact("project_manager_name"), fact("project_manager")).alias("project_manager"),
        first_filled(fact("status_name"), fact("status")).alias("status_name"),
        *[fact(name).alias(name) for name in PAGE_FACTS],
    )


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


# The sentences and bullets of the page texts below must equal those of stored pages.
def background_paragraph(org: str = ORG) -> Column:
    """Prose about a project from the facts that are known."""
    c = {name: F.col(name) for name in (*PAGE_FACTS, "project_no", "project_manager")}
    has = {name: is_filled(value) for name, value in c.items()}
    dated = has["start_date"] | has["due_date"]
    client = F.when(
        has["client_company"],
        _text(
            " for ", c["client_company"],
            F.when(has["business_area"], _text(" in the ", c["business_area"], " practice area")).otherwise(""),
        ),
    ).otherwise("")
    period = F.when(
        dated, _text(", running ", first_filled(c["start_date"], F.lit("?")), " to ", first_filled(c["due_date"], F.lit("ongoing")))
    ).otherwise("")
    team = F.concat_ws(", ", F.nullif(c["project_manager"], F.lit("")), F.nullif(c["project_members"], F.lit("")))
    sentences = F.concat_ws(
        " ",
        F.when(has["project_type"], _text(c["project_no"], " is a ", c["project_type"], " project", client, period, ".")),
        F.when(has["client_contacts"], _text("Client-side contacts: ", c["client_contacts"], ".")),
        F.when(has["description"], _text(rstrip(strip(c["description"]), "."), ".")),
        F.when(team != "", _text(f"The {org} team on this project: ", team, ".")),
        F.when(has["client_country"], _text("Client country: ", c["client_country"], ".")),
        F.when(has["po_number"], _text("PO reference: ", c["po_number"], ".")),
        F.when(has["tags"], _text("Tags: ", c["tags"], ".")),
    )
    return first_filled(sentences, _text(c["project_no"], " — ", c["project_name"], "."))


def with_background(projects: DataFrame, org: str = ORG) -> DataFrame:
    return page_facts(projects).withColumn("background", background_paragraph(org))


def no_source_markdown(org: str = ORG) -> Column:
    """Factual page from the project record alone."""
    c = {name: F.col(name) for name in (*PAGE_FACTS, "project_no", "project_manager", "status_name")}

    def bullet(label: str, name: str) -> Column:
        return F.when(is_filled(c[name]), _text(f"- **{label}:** ", c[name]))

    intro = F.concat_ws(
        " ",
        F.when(is_filled(c["client_company"]), _text("for **", c["client_company"], "**")),
        F.when(is_filled(c["project_type"]), _text("(", c["project_type"], ")")),
    )
    period = F.when(
        is_filled(c["start_date"]) | is_filled(c["due_date"]),
        _text("- **Period:** ", first_filled(c["start_date"], F.lit("—")), " → ", first_filled(c["due_date"], F.lit("ongoing"))),
    )
    folder = F.when(
        F.lower(c["google_drive_link"]).startswith("http"),
        _text("- **Project folder:** [Google Drive](", c["google_drive_link"], ")"),
    )
    facts = F.concat_ws(
        "\n",
        bullet("Status", "status_name"),
        period,
        bullet("Project manager", "project_manager"),
        bullet("Team", "project_members"),
        bullet("Client contacts", "client_contacts"),
        bullet("Business area", "business_area"),
        bullet("Client country", "client_country"),
        bullet("Tags", "tags"),
        folder,
    )
    return _text(
        "# ", c["project_name"], "\n\n",
        strip(_text(f"{org} runs project **", c["project_no"], "** ", intro)), ".",
        F.when(is_filled(c["description"]), _text("\n\n", c["description"])).otherwise(""),
        F.when(facts != "", _text("\n\n## Overview\n\n", facts)).otherwise(""),
        "\n\n_Document intelligence for this project is still being indexed._",
    )


def no_source_pages(projects: DataFrame, links: DataFrame, org: str = ORG) -> DataFrame:
    """Pages of projects that have no mapped document in the documents table."""
    without = projects.join(links.select("project_id"), "project_id", "left_anti")
    return page_facts(without).select("project_id", no_source_markdown(org).alias("markdown"))


PROMPT_RULES = """Write the internal wiki page of this project for a colleague who takes it over.
- Plain present tense; connected prose; every claim backed by the background or by a source.
- Cite sources as [N] with the number of the source; do not repeat file names or links in the text.
- Leave out a section you know nothing about. Invent nothing. Do not list the sources at the end.
Sections: Overview, Client & Brief, Deliverables, Production Notes, Team & Stakeholders,
Timeline & Milestones, Risks & Open Items. Answer with Markdown only."""


def wiki_prompts(projects: DataFrame, sources: DataFrame, org: str = ORG, rules: str = PROMPT_RULES) -> DataFrame:
    """One prompt per project with sources: background, numbered sources as JSON, fixed rules."""
    prompt = _text(
        "# ", F.col("project_name"), "\n\nBackground:\n", F.col("background"),
        "\n\nSource documents:\n", F.to_json("sources", {"ignoreNullFields": "false"}), "\n\n", rules, "\n",
    )
    return with_background(projects, org).join(sources, "project_id").select(
        "project_id", "project_name", "background", "sources", prompt.alias("prompt")
    )


FIRST_SENTENCE = r"^\s*([^.!?\n]*)"


def template_body() -> Column:
    """Deterministic page body: the background, then the first sentence of every source, cited."""

    def note(source: Column) -> Column:
        said = strip(F.regexp_extract(source["content"], FIRST_SENTENCE, 1))
        return _text("\n- ", first_filled(said, source["title"]), " [", source["index"].cast("string"), "]")

    return _text(
        "# ", F.col("project_name"), "\n\n## Overview\n\n", F.col("background"),
        "\n\n## Findings\n", F.array_join(F.transform("sources", note), ""), "\n",
    )


def template_bodies(prompts: DataFrame) -> DataFrame:
    return prompts.select("project_id", "sources", template_body().alias("body"))


def batch_generate(prompts: DataFrame, writer: Callable[[pd.DataFrame], pd.Series]) -> DataFrame:
    """Page bodies from a user-supplied function over batches of (project_id, prompt)."""

    def write(batches):
        for batch in batches:
            yield batch[["project_id"]].assign(body=writer(batch))

    return prompts.select("project_id", "prompt").mapInPandas(write, "project_id string, body string")


def finalize_pages(bodies: DataFrame) -> DataFrame:
    """(project_id, body, sources) -> final Markdown: source table appended, citations linked."""
    return bodies.withColumn("_page", replace_sources_section(F.col("body"), source_table(F.col("sources")))).select(
        "project_id",
        linkify_citations(F.col("_page"), source_links(F.col("sources"))).alias("markdown"),
    )


def chunked_pages(pages: DataFrame, max_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Adds the chunks of the full Markdown, their number, the flag and the size in bytes."""
    return pages.withColumn("chunks", utf8_chunks(F.col("markdown"), max_bytes)).withColumns(
        {
            "markdown_chunk_count": F.size("chunks"),
            "markdown_chunked": F.size("chunks") > 1,
            "markdown_total_bytes": F.octet_length(F.coalesce("markdown", F.lit(""))).cast("bigint"),
        }
    )


def stored_pages(chunked: DataFrame) -> DataFrame:
    """Page rows: chunk 0 stays inline."""
    return chunked.withColumn("markdown", F.get("chunks", 0)).drop("chunks")


def stored_chunks(chunked: DataFrame) -> DataFrame:
    """Chunk rows of the pages that have more than one chunk."""
    return (
        chunked.filter("markdown_chunked")
        .select("project_id", F.posexplode("chunks").alias("index", "content"), F.size("chunks").alias("total_chunks"))
        .select(*CHUNKS.names)
    )


def replace_chunks(old: DataFrame, written_pages: DataFrame, new: DataFrame) -> DataFrame:
    """Chunk table after a write: pages not written keep theirs, written ones have only the new."""
    kept = old.join(written_pages.select("project_id"), "project_id", "left_anti")
    return kept.select(*CHUNKS.names).unionByName(new.select(*CHUNKS.names))


def replace_pages(old: DataFrame, new: DataFrame) -> DataFrame:
    kept = old.join(new.select("project_id"), "project_id", "left_anti")
    return kept.select(*PAGES.names).unionByName(new.select(*PAGES.names))


def stale_chunks(old: DataFrame, written_pages: DataFrame, new: DataFrame) -> DataFrame:
    """Old chunks of rewritten pages that the new version no longer has."""
    rewritten = old.join(written_pages.select("project_id"), "project_id", "left_semi")
    return rewritten.join(new.select("project_id", "index"), ["project_id", "index"], "left_anti")


def reassembled_pages(pages: DataFrame, chunks: DataFrame) -> DataFrame:
    """Full text of every page: inline, or its chunks in order."""
    texts = chunks.groupBy("project_id").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("index", "content")))["content"], "").alias("joined")
    )
    whole = F.when(F.col("markdown_chunked"), F.coalesce("joined", F.lit(""))).otherwise(F.coalesce("markdown", F.lit("")))
    return pages.join(texts, "project_id", "left").select("project_id", whole.alias("text"))


def source_document_ids(links: DataFrame) -> DataFrame:
    """Ids of all mapped documents of a project in order of confidence."""
    return links.groupBy("project_id").agg(
        F.array_sort(F.collect_list(F.struct("position", "document_id")))["document_id"].alias("source_document_ids")
    )


def page_records(
    projects: DataFrame,
    links: DataFrame,
    sources: DataFrame,
    markdown: DataFrame,
    model: str,
    as_of: datetime,
    max_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Page rows with their chunks still attached (see `stored_pages` and `stored_chunks`)."""
    shown = F.transform(
        "sources",
        lambda s: F.struct(*[s[n].alias(n) for n in ("index", "title", "document_id", "type", "url")]),
    )
    has_sources = F.col("source_document_ids").isNotNull()
    joined = (
        page_facts(projects)
        .join(markdown.select("project_id", "markdown"), "project_id")
        .join(source_document_ids(links), "project_id", "left")
        .join(sources.select("project_id", shown.alias("source_documents")), "project_id", "left")
    )
    status = F.when(~has_sources, "no_sources").when(F.col("markdown_chunked"), "generated_chunked").otherwise("generated")
    return (
        chunked_pages(joined, max_bytes)
        .withColumns(
            {
                "generated_at": F.lit(as_of).cast("timestamp"),
                "wiki_status": status,
                "generated_by_model": F.when(has_sources, model).otherwise("none"),
                "source_document_ids": F.coalesce("source_document_ids", F.array().cast("array<string>")),
            }
        )
        .select(*PAGES.names, "chunks")
    )


def batch_outcome(attempts: DataFrame) -> DataFrame:
    """One row from attempts (project_id, error): the batch is an error only if every page failed."""
    return attempts.agg(
        F.count(F.when(F.col("error").isNull(), 1)).alias("projects_succeeded"), F.count("error").alias("projects_failed")
    ).withColumn(
        "status",
        F.when((F.col("projects_succeeded") == 0) & (F.col("projects_failed") > 0), "error").otherwise("ok"),
    )
