"""Queries and reference SQL: search queries, retrieval, discovery, classification."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.operators import classify as cl
from casebook.operators import discovery as ds
from casebook.operators import retrieval as rt
from casebook.operators import selection as sel
from casebook.sources.durable import settle
from checks.fixtures import fixture
from checks.normalize_checks import DEFINITIONS as NORMALIZE_DEFINITIONS
from checks.selection_checks import DEFINITIONS as SELECTION_DEFINITIONS
from checks.selection_checks import TOP

PAGE = 5
AS_OF = datetime(2026, 1, 2, 3, 4, 5)


def project_queries(spark: SparkSession, sf: str) -> DataFrame:
    return ds.project_queries(fixture(spark, sf, "fx_projects"), 200)


def term_index(spark: SparkSession, sf: str) -> DataFrame:
    return rt.term_index(fixture(spark, sf, "fx_corpus")).withColumn("doc_terms", F.col("doc_terms").cast("bigint"))


def _hits(spark: SparkSession, sf: str) -> DataFrame:
    corpus = fixture(spark, sf, "fx_corpus")
    index = settle(rt.term_index(corpus), "term-index")
    stats = settle(rt.corpus_stats(corpus), "corpus-stats")
    return rt.retrieve_top_k(fixture(spark, sf, "fx_searches"), index, stats, PAGE)


def retrieve_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return _hits(spark, sf)


def extractive_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Passages of every hit of the retrieval."""
    found = rt.extractive_passages(
        _hits(spark, sf).select("query_id", "document_id"), fixture(spark, sf, "fx_searches"), fixture(spark, sf, "fx_corpus")
    )
    return found.select(
        "query_id", "document_id", "snippet",
        F.array_join("extractive_answers", " | ").alias("answers"),
        F.array_join(
            F.transform("extractive_segments", lambda s: F.concat(s["score"].cast("string"), F.lit(": "), s["content"])), " | "
        ).alias("segments"),
    )


def discover_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return ds.discover_candidates(fixture(spark, sf, "fx_hits")).select(
        "project_id", "document_id", "discovery_query", "rank", "title"
    )


def discover_documents(spark: SparkSession, sf: str) -> DataFrame:
    return ds.discover_documents(fixture(spark, sf, "fx_hits")).select("document_id", "title")


def discovery_outcome(spark: SparkSession, sf: str) -> DataFrame:
    return ds.discovery_outcome(fixture(spark, sf, "fx_attempts"))


def _payload(spark: SparkSession, sf: str) -> DataFrame:
    documents = fixture(spark, sf, "fx_documents")
    candidates = sel.candidates_per_project(fixture(spark, sf, "fx_candidates"), documents, TOP)
    return cl.classifier_payload(fixture(spark, sf, "fx_projects"), candidates, 500)


def classifier_payload(spark: SparkSession, sf: str) -> DataFrame:
    return _payload(spark, sf).withColumn("document_count", F.col("document_count").cast("bigint"))


_NUMBER = "cast(500000 + ok as string)"
EVIDENCE_TITLE = (
    f"case pk % 7 when 0 then replace(title, {_NUMBER}, {_NUMBER} || '0')"
    f" when 1 then replace(title, {_NUMBER}, 'Ab' || {_NUMBER}) else title end"
)
EVIDENCE_FOLDER = f"case pk % 7 when 2 then 'jobs/' || {_NUMBER} || '/final' else '' end"
EVIDENCE_NUMBER = "case when cast(substr(project_id, 5) as bigint) % 3 = 0 then 'aB' || project_no else project_no end"


def evidence_score(spark: SparkSession, sf: str) -> DataFrame:
    """Titles with longer numbers, numbers with letters in either case, and numbers that only the folder states."""
    documents = fixture(spark, sf, "fx_documents")
    links = sel.candidate_links(fixture(spark, sf, "fx_candidates"), documents, 50)
    described = documents.select(
        "document_id", F.expr(EVIDENCE_TITLE).alias("title"), F.expr(EVIDENCE_FOLDER).alias("folder_path"), "text_preview"
    )
    facts = cl.project_facts(fixture(spark, sf, "fx_projects")).withColumn("project_no", F.expr(EVIDENCE_NUMBER))
    pairs = links.join(described, "document_id").join(facts, "project_id")
    return cl.evidence_score(pairs).select("project_id", "document_id", "decision", "confidence_score", "reason")


def batch_model_score(spark: SparkSession, sf: str) -> DataFrame:
    """A stand-in scorer: every document whose file name carries the project number is a match."""

    def scorer(batch: pd.DataFrame) -> pd.Series:
        import json

        def reply(number: str, documents: str) -> str:
            matches = [
                {"document_id": d["document_id"], "decision": "strong_match", "confidence_score": 0.9, "reason": "number"}
                for d in json.loads(documents)
                if number in d["filename"]
            ]
            return json.dumps({"matches": matches})

        return pd.Series([reply(n, d) for n, d in zip(batch["project_no"], batch["documents"])], index=batch.index)

    replies = cl.batch_model_replies(_payload(spark, sf), scorer)
    return cl.match_rows(cl.parse_replies(replies)).select("project_id", "document_id", "decision", "confidence_score")


def _replies(spark: SparkSession, sf: str) -> DataFrame:
    """JSON replies per project; some are broken, some lack the list of matches."""
    match = F.struct("document_id", "decision", "confidence_score", "evidence", "reason")
    replies = (
        fixture(spark, sf, "fx_replies")
        .groupBy("project_id")
        .agg(F.to_json(F.struct(F.collect_list(match).alias("matches"))).alias("reply"))
    )
    number = F.substring("project_id", 5, 20).cast("bigint")
    return replies.withColumn(
        "reply", F.when(number % 13 == 5, "{ no json").when(number % 13 == 6, '{"note": "none"}').otherwise(F.col("reply"))
    )


def parse_matches(spark: SparkSession, sf: str) -> DataFrame:
    parsed = cl.parse_replies(_replies(spark, sf))
    return cl.match_rows(parsed).select(
        "project_id", "document_id", "decision", "confidence_score", F.coalesce("reason", F.lit("")).alias("reason"), "evidence"
    )


def reply_errors(spark: SparkSession, sf: str) -> DataFrame:
    parsed = cl.parse_replies(_replies(spark, sf))
    return cl.reply_errors(parsed, cl.match_rows(parsed))


def accept_matches(spark: SparkSession, sf: str) -> DataFrame:
    return cl.accept_matches(fixture(spark, sf, "fx_replies")).select("project_id", "document_id", "decision", "confidence_score")


def mapping_rows(spark: SparkSession, sf: str) -> DataFrame:
    accepted = cl.accept_matches(fixture(spark, sf, "fx_replies"))
    return cl.mapping_rows(accepted, "evidence_rules", "run_7", AS_OF).withColumn(
        "classified_at", F.date_format("classified_at", "yyyy-MM-dd HH:mm:ss")
    )


def mapping_totals(spark: SparkSession, sf: str) -> DataFrame:
    replies = fixture(spark, sf, "fx_replies")
    return cl.mapping_totals(fixture(spark, sf, "fx_projects"), fixture(spark, sf, "fx_candidates"), cl.accept_matches(replies))


def unasked_matches(spark: SparkSession, sf: str) -> DataFrame:
    documents = fixture(spark, sf, "fx_documents")
    asked = sel.candidate_links(fixture(spark, sf, "fx_candidates"), documents, TOP)
    return cl.unasked_matches(fixture(spark, sf, "fx_replies"), asked).select("project_id", "document_id", "decision")


QUERIES = {
    f.__name__: f
    for f in (
        project_queries, term_index, retrieve_top_k, extractive_segments, discover_candidates, discover_documents,
        discovery_outcome, classifier_payload, evidence_score, batch_model_score, parse_matches, reply_errors,
        accept_matches, mapping_rows, mapping_totals, unasked_matches,
    )
}

TERMS = r"list_filter(regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')"
WORDS = r"' ' || trim(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) || ' '"
PASSAGES = """list_sort(list_filter(list_transform(regexp_split_to_array(full_text, '{0}'), lambda p, nr: {{'minus':
 -len(list_distinct(list_intersect({1}, wanted))), 'nr': nr, 'content': trim(p, ' ')}}), lambda s: s.minus < 0))[1:3]"""

DEFINITIONS = NORMALIZE_DEFINITIONS | SELECTION_DEFINITIONS | {
    "ex_project_queries": """select p.project_id, q.nr as nr, trim(q.q) as query from
 (select project_id, unnest(list_transform([
   project_no, '"' || clean_name || '" ' || project_no, clean_name,
   case when client_company <> '' then client_company || ' ' || clean_name end,
   case when client_company <> '' then concat_ws(' ', client_company, nullif(project_type, ''), nullif(tags, '')) end,
   case when client_company <> '' and description <> '' then client_company || ' ' || left(description, 200) end], lambda q, nr: {'q': q, 'nr': nr})) as q
  from fx_projects join ex_clean using (k)) p where q.q is not null""",
    "ex_postings": f"""select document_id, term, count(*) as tf from (select document_id, unnest({TERMS.format('full_text')}) as term from fx_corpus)
 group by document_id, term""",
    "ex_lengths": f"select document_id, len({TERMS.format('full_text')}) as doc_terms from fx_corpus",
    "ex_df": "select term, count(*) as df from ex_postings group by term",
    "ex_scores": f"""select query_id, document_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * doc_terms / mean_terms))), 6) as score
 from (select query_id, unnest(list_distinct({TERMS.format('query')})) as term from fx_searches) q
 join ex_df using (term) join ex_postings using (term) join ex_lengths using (document_id)
 cross join (select count(*) as n, avg(doc_terms) as mean_terms from ex_lengths) s group by query_id, document_id""",
    "ex_hits": f"""select *, row_number() over (partition by query_id order by score desc, document_id) as result_pos from ex_scores
 qualify result_pos <= {PAGE}""",
    "ex_ranked": "select *, row_number() over (partition by project_id order by query_ord, result_pos, document_id) as rank from fx_hits",
    "ex_facts": """select project_id, project_no, project_name, clean_name, client_company, project_type, client_country, tags, description,
 coalesce(cast(start_date as varchar), '') || ' to ' || coalesce(cast(due_date as varchar), '') as period from fx_projects join ex_clean using (k)""",
    "ex_valid_replies": """select *, cast(substr(project_id, 5) as bigint) % 13 as kind from fx_replies""",
    "ex_features": rf"""select project_id, document_id, lower(title) as title, {WORDS.format("title || ' ' || folder")} as name,
 {WORDS.format("title || ' ' || folder || ' ' || text_preview")} as body, {WORDS.format('no')} as no, lower(no) as plain_no,
 {WORDS.format('clean_name')} as clean, {WORDS.format('client_company')} as client, regexp_extract(lower(title), '^(\d{{5,}})_', 1) as lead_no
 from (select l.project_id, l.document_id, {EVIDENCE_TITLE} as title, {EVIDENCE_FOLDER} as folder, d.text_preview,
  f.clean_name, f.client_company, f.no from ex_candidate_links l join fx_documents d using (document_id)
  join (select *, {EVIDENCE_NUMBER} as no from ex_facts) f on f.project_id = l.project_id where position <= 50)""",
    "ex_rules": r"""select *, case when regexp_matches(title, 'org[ _-]?chart|holiday|timesheet|employee[ _-]list|curriculum|(^|[_ ])(cv|hr)([_ .]|$)') then 1
 when contains(name, no) then 2 when lead_no <> '' and lead_no <> plain_no then 3
 when starts_with(title, 'handover_') and not contains(body, clean) then 4
 when client <> '  ' and contains(body, client) and contains(body, clean) then 5
 when contains(body, no) then 6 when contains(body, clean) then 7
 when client <> '  ' and contains(body, client) then 8 else 9 end as rule from ex_features""",
    "ex_decided": """select project_id, document_id,
 ['reject', 'strong_match', 'reject', 'reject', 'strong_match', 'strong_match', 'possible_match', 'possible_match', 'reject'][rule] as decision,
 cast([0.05, 0.95, 0.10, 0.15, 0.90, 0.85, 0.80, 0.50, 0.20][rule] as double) as confidence_score,
 ['internal document', 'project number in title', 'other project number', 'hand-over without deliverable', 'client and deliverable',
  'project number in text', 'deliverable', 'client only', 'weak or no evidence'][rule] as reason from ex_rules""",
}

ORACLES = {
    "project_queries": """select project_id, row_number() over (partition by project_id order by nr) - 1 as query_ord, query from
 (select * from ex_project_queries where query <> '' qualify row_number() over (partition by project_id, lower(query) order by nr) = 1)""",
    "term_index": "select term, document_id, doc_terms, tf from ex_postings join ex_lengths using (document_id)",
    "retrieve_top_k": "select query_id, document_id, score, result_pos from ex_hits",
    "extractive_segments": f"""select query_id, document_id, coalesce(answers[1].content, '') as snippet,
 array_to_string(list_transform(answers, lambda a: a.content), ' | ') as answers,
 array_to_string(list_transform(segments, lambda a: cast(-a.minus as varchar) || ': ' || a.content), ' | ') as segments from
 (select query_id, document_id, {PASSAGES.format('[.!?' + chr(92) + 'n]+', TERMS.format('p'))} as answers,
  {PASSAGES.format(chr(92) + 'n+', TERMS.format('p'))} as segments from
  (select h.query_id, h.document_id, c.full_text, list_distinct({TERMS.format('query')}) as wanted
   from ex_hits h join fx_searches s on s.query_id = h.query_id join fx_corpus c on c.document_id = h.document_id))""",
    "discover_candidates": """select project_id, document_id, discovery_query, rank, title from ex_ranked
 qualify row_number() over (partition by project_id, document_id order by rank) = 1""",
    "discover_documents": """select document_id, title from ex_ranked
 qualify row_number() over (partition by document_id order by project_ord desc, rank) = 1""",
    "discovery_outcome": """select count(*) as records_read, coalesce(sum(candidates) filter (error is null), 0) as records_written, count(error) as failures,
 case when coalesce(sum(candidates) filter (error is null), 0) = 0 and count(error) > 0 then 'error' else 'success' end as status from fx_attempts""",
    "classifier_payload": f"""select f.project_id, project_no, project_name, clean_name, client_company, '' as client_contacts, project_type, '' as business_area, tags,
 '' as project_manager, '' as project_members, period, description, document_count, documents from ex_facts f join
 (select project_id, count(*) as document_count, cast(to_json(list({{'document_id': document_id, 'filename': title, 'folder_path': '', 'author': '',
  'created_at': cast(null as varchar), 'modified_at': cast(null as varchar), 'preview': left(text_preview, 500)}} order by position)) as varchar) as documents
  from ex_candidate_links join fx_documents using (document_id) where position <= {TOP} group by project_id) d on d.project_id = f.project_id""",
    "evidence_score": "select project_id, document_id, decision, confidence_score, reason from ex_decided",
    "batch_model_score": f"""select l.project_id, l.document_id, 'strong_match' as decision, cast(0.9 as double) as confidence_score
 from ex_candidate_links l join fx_documents d using (document_id) join fx_projects p on p.project_id = l.project_id
 where position <= {TOP} and contains(d.title, p.project_no)""",
    "parse_matches": "select project_id, document_id, decision, confidence_score, reason, evidence from ex_valid_replies where kind not in (5, 6)",
    "reply_errors": "select distinct project_id, 'invalid JSON' as error from ex_valid_replies where kind = 5",
    "accept_matches": """select project_id, document_id, decision, confidence_score from fx_replies
 where lower(decision) <> 'reject' and coalesce(confidence_score, 0) >= 0.75""",
    "mapping_rows": """select project_id, document_id, confidence_score, 'evidence_rules' as matching_method, coalesce(nullif(reason, ''), evidence) as classifier_reason,
 '2026-01-02 03:04:05' as classified_at, 'run_7' as run_id from fx_replies where lower(decision) <> 'reject' and coalesce(confidence_score, 0) >= 0.75""",
    "mapping_totals": """select (select count(*) from fx_projects) as projects_total, (select count(*) from fx_candidates) as documents_total,
 (select count(*) from fx_replies where lower(decision) <> 'reject' and coalesce(confidence_score, 0) >= 0.75) as mappings_total""",
    "unasked_matches": f"""select project_id, document_id, decision from fx_replies r where not exists
 (select 1 from ex_candidate_links l where l.project_id = r.project_id and l.document_id = r.document_id and l.position <= {TOP})""",
}
