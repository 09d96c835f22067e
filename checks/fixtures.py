"""Inputs of the operators, derived from the given tables by SQL that both engines accept."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

FIXTURES: dict[str, str] = {
    "fx_projects": """
select o_orderkey as k, o_custkey as custkey,
 'prj_' || cast(o_orderkey as string) as project_id,
 cast(o_orderkey as string) as scoro_id,
 cast(500000 + o_orderkey as string) as project_no,
 'Campaign ' || cast(o_orderkey % 50 as string) || '_' || upper(substr(c_mktsegment,1,1)) || lower(substr(c_mktsegment,2)) || ' Team_' ||
   case when o_orderkey % 3 = 0 then 'Phase 2' else upper(substr(n_name,1,1)) || 'x B' end as project_name,
 case when o_orderstatus='P' then 'inprogress' when o_orderstatus='O' and o_orderkey % 10 = 0 then null when o_orderstatus='O' then 'Pending'
  when o_orderkey % 4 = 0 then 'Completed' when o_orderkey % 4 = 1 then 'cancelled' when o_orderkey % 4 = 2 then 'future' else '' end as status,
 case when o_orderkey % 17 = 0 then null else cast(o_orderdate as date) end as start_date,
 cast(o_orderdate + interval 30 days as date) as due_date,
 case when o_orderkey % 5 = 0 then '' else c_name end as client_company,
 case when o_orderkey % 4 = 0 then '' else c_mktsegment end as project_type,
 n_name as client_country,
 substr(o_orderpriority,3) as tags,
 case when o_orderkey % 6 = 0 then '' else 'Order ' || o_orderpriority || ' of ' || c_name || '.' end as description,
 cast(o_orderdate as date) as imported_on
from orders join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey""",
    "fx_links": """
select 'prj_' || cast(l_orderkey as string) as project_id,
 'doc_' || cast(l_orderkey as string) || '_' || cast(l_partkey as string) as document_id,
 l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_discount, cast(l_shipdate as date) as shipped_on
from lineitem""",
    "fx_documents": """
select l_orderkey as ok, l_partkey as pk,
 'doc_' || cast(l_orderkey as string) || '_' || cast(l_partkey as string) as document_id,
 case when l_partkey % 2 = 0 then 'discovery_engine' else 'upload' end as source_system,
 case when l_partkey % 11 = 0 then 'Handover_' || p_type || '.xlsx'
      when l_partkey % 13 = 0 then 'CE_' || p_type || '_v' || cast(p_size % 4 as string) || '.pdf'
      when l_partkey % 7 = 0 then cast(500001 + l_orderkey as string) || '_' || p_type || '.docx'
      when l_partkey % 17 = 0 then cast(500000 + l_orderkey as string) || '_OP_Summary_' || p_type || '.pdf'
      when l_partkey % 19 = 0 then 'x_OP_Summary_' || p_type || '.pdf'
      else cast(500000 + l_orderkey as string) || '_' || p_type || '_V' || cast(p_size % 4 as string) ||
        case l_partkey % 5 when 0 then '.pptx' when 1 then '.pdf' when 2 then '.indd' when 3 then '.PNG' else '' end end as title,
 case when l_partkey % 3 = 0 then 'gs://bucket/' || cast(l_partkey as string) else 'https://files.example.com/' || cast(l_partkey as string) end as url,
 case when l_partkey % 4 = 0 then 'https://drive.example.com/' || cast(l_partkey as string) else '' end as source_url,
 p_name || ' ' || p_brand || ' ' || p_type as text_preview,
 case when l_partkey % 9 = 0 then '' else p_name || ' ' || p_brand || ' ' || p_type || ' for order ' || cast(l_orderkey as string) end as full_text,
 date '2024-01-01' + cast(l_orderkey % 1000 as int) as imported_on
from (select distinct l_orderkey, l_partkey from lineitem) k join part on l_partkey=p_partkey""",
    "fx_candidates": """
select project_id, document_id, l_linenumber, 'q' || cast(l_linenumber as string) as discovery_query,
 cast(l_linenumber * 100 + l_suppkey % 100 as bigint) as rank, 'run_' || cast(l_partkey % 2 as string) as run_id from fx_links""",
    "fx_replies": """
select project_id, document_id, shipped_on,
 case when l_partkey % 23 = 0 then 'STRONG_MATCH' when l_returnflag='A' then 'strong_match' when l_returnflag='N' then 'possible_match'
  when l_partkey % 29 = 0 then 'Reject' else 'reject' end as decision,
 case when l_partkey % 31 = 0 then null else round(1 - 5 * l_discount, 2) end as confidence_score,
 case when l_partkey % 2 = 0 then 'number in title' else '' end as reason, 'line ' || cast(l_linenumber as string) as evidence from fx_links""",
    "fx_map": """
select project_id, document_id, confidence_score, reason as classifier_reason, shipped_on as classified_on
from fx_replies where coalesce(lower(decision),'') <> 'reject' and coalesce(confidence_score,0) >= 0.75""",
    "fx_runs": """
select 'run_' || cast(event_id as string) as run_id,
 case event_type when 'view' then 'scoro-sync' when 'click' then 'document-discovery' when 'purchase' then 'taxonomy-sync' when 'signup' then 'wiki-generate' else 'full-sync' end as job_name,
 ts as started_at, case when event_type='error' then 'error' else 'success' end as status,
 cast(user_id as bigint) as records_read, cast(event_id % 7 as bigint) as records_written,
 case when event_type='error' then repeat('search failed; ', 100) when event_id % 3 = 0 then '' else null end as error_message from events""",
    # The same record pulled under several statuses; some copies come without an id.
    "fx_pulls": """
select scoro_id as id, project_no, 1 + k % 3 as status_ord, k % 11 as page, k % 100 as pos from fx_projects
union all
select case when k % 13 = 0 then null else scoro_id end as id, project_no || 'b' as project_no, 1 + k % 5 as status_ord, k % 7 as page, 100 + k % 100 as pos from fx_projects""",
    "fx_members": """
select l_orderkey as k, l_suppkey as s, row_number() over (partition by l_orderkey order by l_linenumber, l_suppkey) as nth from lineitem""",
    "fx_users": """
select cast(s_suppkey as string) as id, '' as user_id, case when s_suppkey % 9 = 0 then '' else s_name end as firstname,
 case when s_suppkey % 2 = 0 then ' Nation ' || cast(s_nationkey as string) else '' end as lastname,
 '' as full_name, case when s_suppkey % 18 = 0 then '' else 'u' || cast(s_suppkey as string) || '@example.com' end as email, s_suppkey as ord
from supplier""",
    "fx_contacts": """
select cast(c_custkey as string) as contact_id, '' as id, case when c_custkey % 3 = 0 then 'person' else 'company' end as contact_type,
 case when c_custkey % 8 = 0 then '' else c_name end as name, lower(c_mktsegment) as lastname,
 case when c_custkey % 6 = 0 then 'S. ' || c_name else '' end as search_name, case when c_custkey % 4 = 0 then ' Buyer ' else '' end as position, c_custkey as ord
from customer
union all
select '' as contact_id, cast(c_custkey as string) as id, 'company' as contact_type, c_name || ' II' as name, '' as lastname, '' as search_name, '' as position, 1000000000 + c_custkey as ord
from customer where c_acctbal < 0""",
    "fx_companies": """
select cast(c_custkey as string) as company_id, '' as contact_id, '' as id, case when c_custkey % 4 = 0 then '' else 'Co ' || c_name end as name,
 case when c_custkey % 12 = 0 then '' else 'Alt ' || c_name end as company_name, c_custkey as ord
from customer""",
    # Search hits: a document is found by two queries of a project and by many projects.
    "fx_hits": """
select 'prj_' || cast(l_orderkey as string) as project_id, l_orderkey as project_ord, l_linenumber % 3 as query_ord,
 'q' || cast(l_linenumber % 3 as string) as discovery_query, l_linenumber as result_pos, 'part_' || cast(l_partkey as string) as document_id,
 'seen by ' || cast(l_orderkey as string) || ' in ' || cast(l_linenumber as string) as title from lineitem
union all
select 'prj_' || cast(l_orderkey as string) as project_id, l_orderkey as project_ord, 3 + l_linenumber % 2 as query_ord,
 'r' || cast(l_linenumber % 2 as string) as discovery_query, 10 + l_linenumber as result_pos, 'part_' || cast(l_partkey as string) as document_id,
 'seen again by ' || cast(l_orderkey as string) || ' in ' || cast(l_linenumber as string) as title from lineitem""",
    "fx_attempts": """
select project_id, count(*) as candidates, case when min(l_partkey) % 5 = 0 then 'search failed' else null end as error from fx_links group by project_id""",
    "fx_corpus": "select cast(doc_id as string) as document_id, text as full_text from documents",
    "fx_lang_corpus": "select cast(doc_id as string) as document_id, text as full_text, lang from documents",
    "fx_searches": "select cast(item_id as string) as query_id, text as query from benchmark",
    "fx_page_texts": "select cast(doc_id as string) as project_id, lang, text as markdown from documents",
}


def with_clause(sql: str, definitions: dict[str, str] | None = None) -> str:
    """Put the definitions a statement needs in front of it, in dependency order."""
    known = FIXTURES | (definitions or {})
    ordered: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:fx|ex)_\w+", text):
            if name in known and name not in seen:
                seen.add(name)
                visit(known[name])
                ordered.append(name)

    visit(sql)
    if not ordered:
        return sql
    return "with recursive " + ",\n".join(f"{n} as ({known[n].strip()})" for n in ordered) + "\n" + sql


def fixture(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A stand-in (by name) or a statement over stand-ins as a DataFrame on the files below sf_dir."""
    statement = with_clause(sql if " " in sql else f"select * from {sql}").replace("with recursive", "with", 1)
    on_files = re.sub(
        rf"\b(from|join)\s+({'|'.join(BASE_TABLES)})\b",
        lambda m: f"{m.group(1)} parquet.`{sf_dir.rstrip('/')}/{m.group(2)}.parquet`",
        statement,
    )
    return spark.sql(on_files)


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
