"""Queries and reference SQL: the standing term index and the search over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casebook.operators.block_search import search_index
from casebook.sources.durable import new_place
from casebook.sources.term_store import TermStore
from checks.discovery_checks import DEFINITIONS as DISCOVERY_DEFINITIONS
from checks.discovery_checks import PAGE
from checks.fixtures import fixture

# The index first holds half the text of German documents, no French ones, and documents that are gone later.
BEFORE = """select document_id, case when lang = 'de' then left(full_text, cast(length(full_text) / 2 as int)) else full_text end as full_text
 from fx_lang_corpus where coalesce(lang, '') <> 'fr'
 union all select 'old_' || document_id as document_id, full_text from fx_lang_corpus where lang = 'es'"""
CHANGED = "select document_id, full_text from fx_lang_corpus where lang in ('de', 'fr')"
GONE = "select 'old_' || document_id as document_id from fx_lang_corpus where lang = 'es'"


def _updated(spark: SparkSession, sf: str) -> TermStore:
    store = TermStore(spark, new_place(spark, "index"))
    store.update(fixture(spark, sf, BEFORE))
    store.update(fixture(spark, sf, CHANGED), fixture(spark, sf, GONE))
    return store


def index_update_postings(spark: SparkSession, sf: str) -> DataFrame:
    """Live postings after an update that replaced, added and removed documents."""
    store = _updated(spark, sf)
    live = store.postings(store.state())
    return live.selectExpr("term", "document_id", "cast(doc_terms as bigint) as doc_terms", "cast(tf as bigint) as tf")


def index_search_top_k(spark: SparkSession, sf: str) -> DataFrame:
    """Block-wise search over the updated index."""
    return search_index(_updated(spark, sf), fixture(spark, sf, "fx_searches"), PAGE)


QUERIES = {f.__name__: f for f in (index_update_postings, index_search_top_k)}
DEFINITIONS = DISCOVERY_DEFINITIONS
ORACLES = {
    "index_update_postings": "select term, document_id, doc_terms, tf from ex_postings join ex_lengths using (document_id)",
    "index_search_top_k": "select query_id, document_id, score, result_pos from ex_hits",
}
