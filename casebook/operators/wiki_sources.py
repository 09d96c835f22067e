"""Choosing and numbering the source documents of a wiki page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.functions.text import first_filled, is_filled
from casebook.functions.titles import (
    base_name,
    best_url,
    clickable_url,
    document_type,
    is_noise,
    is_order_summary,
    is_quote,
    version_number,
)
from casebook.schemas import (
    WIKI_FALLBACK_LIMIT,
    WIKI_MIN_SOURCES,
    WIKI_PREFILTER_CAP,
)
from casebook.sources.search_results import cut


def title_features(documents: DataFrame, org: str = "Agency") -> DataFrame:
    title = F.coalesce("title", F.lit(""))
    return documents.withColumns(
        {
            "version": version_number(title),
            "base": base_name(title),
            "noise": is_noise(title, org),
            "quote": is_quote(title),
            "link": clickable_url(F.col("url")),
        }
    )


def document_types(documents: DataFrame) -> DataFrame:
    return documents.withColumn("doc_type", document_type(F.coalesce("title", F.lit(""))))


def _marked(docs: DataFrame, org: str) -> DataFrame:
    """Adds whether the title qualifies and, among those, the best version per base name.

    Expects the mapped documents of every project (bounded by the source limit) with `position`
    in order of confidence. All windows here share the partitioning by project.
    """
    title = F.coalesce("title", F.lit(""))
    number = F.coalesce(F.col("project_no"), F.lit(""))
    own = is_filled(number) & title.contains(number)
    featured = title_features(docs, org).withColumn(
        "qualified", ~F.col("noise") & (own | F.col("quote")) & ~(is_order_summary(title) & ~own)
    )
    versions = Window.partitionBy("project_id", "base", "qualified")
    best_version = versions.orderBy(F.col("version").desc(), "position")
    marked = featured.withColumns(
        {"base_position": F.min("position").over(versions), "version_no": F.row_number().over(best_version)}
    ).withColumn("kept", F.col("qualified") & (F.col("version_no") == 1))
    in_order = Window.partitionBy("project_id", "kept").orderBy(F.col("version").desc(), "base_position")
    return marked.withColumn("kept_order", F.row_number().over(in_order))


def prefilter_sources(docs: DataFrame, cap: int = WIKI_PREFILTER_CAP, org: str = "Agency") -> DataFrame:
    """Documents with the project number or a quote prefix, newest version each, at most `cap`."""
    return _marked(docs, org).filter(F.col("kept") & (F.col("kept_order") <= cap)).select(
        *docs.columns, "version", "base", "kept_order"
    )


def select_sources(
    docs: DataFrame,
    cap: int = WIKI_PREFILTER_CAP,
    fallback: int = WIKI_FALLBACK_LIMIT,
    minimum: int = WIKI_MIN_SOURCES,
    org: str = "Agency",
) -> DataFrame:
    """The filtered sources of every project; too few are completed, none are replaced.

    Nothing left: the first `fallback` documents by confidence. Fewer than `minimum`: all documents
    that are no noise follow, up to `cap`. One pass of windows over rows already grouped by project.
    """
    project = Window.partitionBy("project_id")
    filtered = F.col("kept") & (F.col("kept_order") <= cap)
    counted = _marked(docs, org).withColumn("filtered", filtered).withColumn(
        "n_filtered", F.count(F.when(F.col("filtered"), 1)).over(project)
    )
    none_left = F.col("n_filtered") == 0
    few_left = (F.col("n_filtered") > 0) & (F.col("n_filtered") < minimum)
    branch = (
        F.when(none_left & (F.col("position") <= fallback), "fallback")
        .when(F.col("filtered"), "filtered")
        .when(few_left & ~F.col("noise"), "supplement")
    )
    chosen = counted.withColumn("branch", branch).filter("branch is not null")
    listing = project.orderBy(
        F.when(F.col("branch") == "supplement", 1).otherwise(0),
        F.when(F.col("branch") == "filtered", F.col("kept_order")).otherwise(F.col("position")),
    )
    numbered = chosen.withColumn("index", F.row_number().over(listing))
    within = (F.col("branch") == "fallback") | (F.col("index") <= cap)
    return numbered.filter(within).select(*docs.columns, "version", "base", "branch", "index")


def source_rows(selected: DataFrame, documents: DataFrame, max_chars: int | None = None) -> DataFrame:
    """Numbered sources with type, link and content; only here does document text join in.

    Contents are whole unless `max_chars` cuts them.
    """
    texts = documents.select("document_id", "full_text", "text_preview")
    content = cut(first_filled(F.col("full_text"), F.col("text_preview")), max_chars)
    return _described(selected.join(texts, "document_id", "left"), content.alias("content"))


def named_sources(selected: DataFrame) -> DataFrame:
    """Numbered sources with type and link, without document text."""
    return _described(selected)


def _described(rows: DataFrame, *more: Column) -> DataFrame:
    return rows.select(
        "project_id",
        "index",
        F.coalesce("title", F.lit("")).alias("title"),
        "document_id",
        document_type(F.coalesce("title", F.lit(""))).alias("type"),
        best_url(F.col("source_url"), F.col("url")).alias("url"),
        *more,
    )


def source_lists(sources: DataFrame) -> DataFrame:
    """project_id -> ordered array of source structs; at most cap entries per project."""
    entry = F.struct(*[c for c in ("index", "title", "document_id", "type", "url", "content") if c in sources.columns])
    return sources.groupBy("project_id").agg(F.array_sort(F.collect_list(entry)).alias("sources"))
