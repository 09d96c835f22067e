"""Rows of the documents table from nested search results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions.text import filled, first_filled

PASSAGES = "array<struct<content:string,pageContent:string>>"
SEARCH_RESULT = (
    "document struct<id:string,name:string,"
    "structData:struct<title:string,uri:string,link:string,url:string,source_url:string,canonicalUri:string>,"
    "derivedStructData:struct<title:string,link:string,canonicalUrl:string,sourceUrl:string,"
    "snippets:array<struct<snippet:string>>,"
    f"extractive_answers:{PASSAGES},extractiveAnswers:{PASSAGES},"
    f"extractive_segments:{PASSAGES},extractiveSegments:{PASSAGES}>>"
)


def _first_non_empty(snake: Column, camel: Column) -> Column:
    """The snake-case list unless it is missing or empty, then the camel-case one."""
    return F.when(F.coalesce(F.size(snake), F.lit(0)) > 0, snake).otherwise(camel)


def _contents(passages: Column) -> Column:
    texts = F.transform(passages, lambda p: F.coalesce(filled(p["content"]), filled(p["pageContent"])))
    return F.coalesce(F.array_compact(texts), F.array().cast("array<string>"))


def cut(text: Column, chars: int | None) -> Column:
    return text if chars is None else F.substring(text, 1, chars)


def search_result_errors(results: DataFrame, json_column: str = "result") -> DataFrame:
    """Results that `parse_search_results` leaves out, as rows (key, error, record)."""
    parsed = results.select(json_column, F.explode_outer(F.array(F.from_json(json_column, SEARCH_RESULT)["document"])).alias("_doc"))
    doc = F.col("_doc")
    readable = F.coalesce(F.schema_of_variant(F.try_parse_json(json_column)).startswith("OBJECT"), F.lit(False))
    unnamed = first_filled(doc["id"], doc["name"]) == ""
    error = F.when(~readable, "unreadable result").when(F.coalesce(unnamed, F.lit(True)), "result without id and name")
    judged = parsed.select(json_column, F.explode_outer(F.array(error)).alias("error")).filter("error is not null")
    return judged.select(F.lit("search result").alias("key"), "error", F.col(json_column).alias("record"))


def parse_search_results(
    results: DataFrame, json_column: str = "result", preview_chars: int | None = None, text_chars: int | None = None
) -> DataFrame:
    """One documents row per search result; results without id and name are dropped.

    Texts are whole unless `preview_chars` and `text_chars` cut them.
    """
    carried = [c for c in results.columns if c != json_column]
    doc = F.col("_item.document")
    derived, struct = F.col("_item.document.derivedStructData"), F.col("_item.document.structData")
    name = F.coalesce(doc["name"], F.lit(""))
    name_url = F.when(F.lower(name).rlike("^https?://"), name)
    snippet = F.coalesce(F.get(derived["snippets"], 0)["snippet"], F.lit(""))
    parts = F.concat(
        F.when(snippet != "", F.array(snippet)).otherwise(F.array().cast("array<string>")),
        _contents(_first_non_empty(derived["extractive_answers"], derived["extractiveAnswers"])),
        _contents(_first_non_empty(derived["extractive_segments"], derived["extractiveSegments"])),
    )
    source_url = first_filled(
        derived["link"], derived["canonicalUrl"], derived["sourceUrl"],
        struct["link"], struct["url"], struct["source_url"], struct["canonicalUri"], name_url,
    )
    parsed = (
        # Exploded, so that the filter and the columns below share one parse of each result.
        results.select("*", F.explode_outer(F.array(F.from_json(json_column, SEARCH_RESULT))).alias("_item"))
        .withColumn("document_id", first_filled(doc["id"], doc["name"]))
        .filter(F.col("document_id") != "")
        .withColumn("_text", F.array_join(parts, "\n\n"))
        .withColumn("_snippet", snippet)
        .withColumn("_source_url", source_url)
    )
    return parsed.select(
        *carried,
        "document_id",
        F.lit("discovery_engine").alias("source_system"),
        F.lit("search_result").alias("source_type"),
        first_filled(derived["title"], struct["title"], F.col("document_id")).alias("title"),
        F.lit("").alias("folder_path"),
        first_filled(F.col("_source_url"), struct["uri"], name).alias("url"),
        F.col("_source_url").alias("source_url"),
        F.lit("").alias("author"),
        cut(first_filled(F.col("_snippet"), F.col("_text")), preview_chars).alias("text_preview"),
        cut(F.col("_text"), text_chars).alias("full_text"),
    )
