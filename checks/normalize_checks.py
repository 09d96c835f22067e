"""Queries and reference SQL: project normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.functions.records import any_text, custom_fields
from casebook.functions.text import clean_project_name, name_hints, safe_date
from casebook.operators import normalize as nm
from checks.fixtures import fixture
from checks.records import records

def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return records(spark, sf).select("k", "id", "rec", "related")


def _users(spark: SparkSession, sf: str) -> DataFrame:
    return nm.user_labels(fixture(spark, sf, "fx_users"))


def _contacts(spark: SparkSession, sf: str) -> DataFrame:
    return nm.contact_labels(fixture(spark, sf, "fx_contacts"))


def _companies(spark: SparkSession, sf: str) -> DataFrame:
    return nm.company_labels(fixture(spark, sf, "fx_companies"), fixture(spark, sf, "fx_contacts"))


def custom_fields_map(spark: SparkSession, sf: str) -> DataFrame:
    entries = _raw(spark, sf).select("id", F.explode(F.expr(custom_fields("rec"))).alias("key", "v"))
    return entries.select("id", "key", F.expr(any_text("v")).alias("value"))


def custom_value(spark: SparkSession, sf: str) -> DataFrame:
    raw = nm.with_custom_fields(_raw(spark, sf))
    keys = ("c_projecttype", "c_clientcountry", "c_businessarea", "c_ponumber", "hours", "no_such_key")
    return raw.select("id", *[nm.custom_column(key).alias(key) for key in keys])


def overlay_detail(spark: SparkSession, sf: str) -> DataFrame:
    rows = records(spark, sf)
    details = rows.filter("detail is not null").select("id", "detail")
    merged = nm.with_custom_fields(nm.overlay_details(rows.select("id", "rec"), details))
    keys = ("c_projecttype", "c_project_priority", "c_ponumber", "c_businessarea")
    return merged.select(
        "id",
        F.coalesce(nm.record_text("description"), F.lit("")).alias("description"),
        F.coalesce(nm.record_text("company_name"), F.lit("")).alias("company_name"),
        F.try_variant_get("rec", "$.open", "string").alias("is_open"),
        F.try_variant_get("rec", "$.hours", "string").alias("hours"),
        *[nm.custom_column(key).alias(key) for key in keys],
    )


def name_hint_parts(spark: SparkSession, sf: str) -> DataFrame:
    hints = name_hints(F.col("project_name"))
    return fixture(spark, sf, "fx_projects").select(
        "project_id", hints["contact"].alias("contact"), hints["colleague"].alias("colleague")
    )


def contact_labels(spark: SparkSession, sf: str) -> DataFrame:
    return _contacts(spark, sf)


def user_labels(spark: SparkSession, sf: str) -> DataFrame:
    return _users(spark, sf)


def company_labels(spark: SparkSession, sf: str) -> DataFrame:
    return _companies(spark, sf)


def project_team(spark: SparkSession, sf: str) -> DataFrame:
    return nm.project_team(_raw(spark, sf), _users(spark, sf))


def client_info(spark: SparkSession, sf: str) -> DataFrame:
    raw = nm.with_custom_fields(_raw(spark, sf))
    return nm.client_info(raw, _companies(spark, sf), _contacts(spark, sf)).select("id", "client_company", "client_contacts")


def enrich_scope(spark: SparkSession, sf: str) -> DataFrame:
    projects = fixture(spark, sf, "fx_projects")
    return projects.filter(nm.in_enrich_scope(F.col("status"))).select("project_id", "status")


def needs_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    return nm.needs_enrichment(_raw(spark, sf), _companies(spark, sf)).select(
        "id", "no_client", "thin_team", "no_manager", "needs"
    )


def budgeted_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    rows = records(spark, sf)
    result = nm.budgeted_enrichment(
        rows.select("id", "k", "rec"),
        rows.filter("detail is not null").select("id", "detail"),
        rows.filter("related is not null").select("id", "related"),
        _companies(spark, sf),
        budget=250,
        order="k",
    )
    return result.select(
        "id", "detail_granted", "related_granted",
        F.coalesce(nm.record_text("description"), F.lit("")).alias("description"),
    )


def normalize_projects(spark: SparkSession, sf: str) -> DataFrame:
    return nm.normalize_projects(
        _raw(spark, sf), _users(spark, sf), _companies(spark, sf), _contacts(spark, sf), prefix="prj_"
    )


def safe_dates(spark: SparkSession, sf: str) -> DataFrame:
    stated = fixture(
        spark, sf,
        """select k, case k % 6 when 0 then cast(start_date as string) || 'T10:00' when 1 then '2024-1-5' when 2 then '' when 3 then '2024-13-45'
        when 4 then 'soon' else cast(due_date as string) end as stated from fx_projects""",
    )
    return stated.select("k", "stated", safe_date(F.col("stated")).cast("string").alias("day"))


def status_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return nm.status_breakdown(fixture(spark, sf, "fx_projects"))


def clean_project_names(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "fx_projects").select("project_id", clean_project_name(F.col("project_name")).alias("clean_name"))


QUERIES = {
    f.__name__: f
    for f in (
        custom_fields_map, custom_value, overlay_detail, contact_labels, user_labels, company_labels, project_team,
        client_info, enrich_scope, needs_enrichment, budgeted_enrichment, normalize_projects, safe_dates,
        status_breakdown, clean_project_names,
    )
} | {"name_hints": name_hint_parts}

DEFINITIONS = {
    "ex_user_labels": """select id as user_id, label from (select id, coalesce(nullif(concat_ws(' ', nullif(trim(firstname), ''), nullif(trim(lastname), '')), ''), email) as label
 from fx_users) where label <> ''""",
    "ex_contact_rows": """select coalesce(nullif(contact_id, ''), id) as contact_id, contact_type, name, ord, trim(position) as role,
 coalesce(nullif(search_name, ''), trim(concat_ws(' ', nullif(name, ''), nullif(lastname, '')))) as person from fx_contacts""",
    "ex_contact_labels": """select contact_id, label from (select contact_id, ord,
 case when contact_type = 'person' then person || case when person <> '' and role <> '' then ' (' || role || ')' else '' end else trim(name) end as label from ex_contact_rows)
 where label <> '' qualify row_number() over (partition by contact_id order by ord desc) = 1""",
    "ex_company_labels": """select company_id, label from (
 select company_id, trim(coalesce(nullif(name, ''), company_name)) as label, 0 as list_no, ord from fx_companies
 union all select contact_id, trim(name), 1, ord from ex_contact_rows where contact_type = 'company')
 where label <> '' qualify row_number() over (partition by company_id order by list_no desc, ord desc) = 1""",
    "ex_records": """select p.*, scoro_id as id, case when k % 4 <> 0 then cast(custkey % 120 + 1 as varchar) end as manager_id,
 case when k % 8 <> 1 then 'm' || custkey || '@example.com' end as manager_email,
 case when k % 5 <> 2 and custkey <> 0 then cast(custkey as varchar) end as company_ref, case when k % 5 = 3 then ' ' || client_company else '' end as company_name,
 case when k % 3 < 2 then project_type else '' end as c_projecttype, case when k % 3 = 1 then '' else client_country end as c_clientcountry,
 case when k % 3 = 0 then 'Brand, ' || tags else '' end as c_businessarea, case when k % 3 = 1 then 'PO-' || scoro_id else '' end as c_ponumber,
 case when k % 7 = 0 then tags || ', extra' else tags end as all_tags from fx_projects p""",
    "ex_mentions": """select k, nth as ord, case when k % 2 = 0 and s % 4 = 0 then 'Lead ' || s else coalesce(label, cast(s as varchar)) end as name
 from fx_members left join ex_user_labels on user_id = cast(s as varchar)
 union all select k, 1000000, coalesce(label, manager_email) from ex_records left join ex_user_labels on user_id = manager_id where manager_id is not null
 union all select k, 1000001, split_part(project_name, '_', 3) from ex_records
 union all select k, 1000002, 'Rel ' || client_country from ex_records where k % 3 = 1""",
    "ex_team": """select k, string_agg(name, ', ' order by ord) as project_team from
 (select k, trim(name) as name, min(ord) as ord from ex_mentions where trim(name) <> '' group by k, trim(name)) group by k""",
    "ex_client_direct": """select r.*, coalesce(nullif(trim(company_name), ''), co.label, ct.label, '') as direct, co.label as company_label
 from ex_records r left join ex_company_labels co on co.company_id = company_ref left join ex_contact_labels ct on ct.contact_id = company_ref""",
    "ex_client": """select *, case when direct <> '' then direct when k % 3 = 1 then 'Holding ' || client_country else company_name end as client,
 split_part(project_name, '_', 2) || case when k % 3 = 1 then case when direct <> '' then ', Holding ' || client_country else '' end ||
  ', Partner ' || tags || ', Ann ' || client_country || ' (Buyer)' else '' end as client_contacts from ex_client_direct""",
    "ex_needs": """select c.*, trim(company_name) = '' and company_label is null as no_client, coalesce(team_size, 0) < 2 as thin_team, manager_id is null as no_manager
 from ex_client_direct c left join (select k, count(*) as team_size from fx_members group by k) using (k)""",
    "ex_costs": """select k, case when k % 2 = 0 then 1 else 0 end as detail_cost,
 case when k % 3 = 1 and ((no_client and k % 6 <> 0) or thin_team) then 1 else 0 end as related_cost
 from ex_needs where (no_client or thin_team or no_manager) and lower(coalesce(status, '')) in ('inprogress', 'pending', 'future', 'plan')""",
    "ex_grants": """select k, detail_cost > 0 and spent < 250 as detail_granted, related_cost > 0 and spent + detail_cost < 250 as related_granted from
 (select *, coalesce(sum(detail_cost + related_cost) over (order by k rows between unbounded preceding and 1 preceding), 0) as spent from ex_costs)""",
    "ex_manager": """select k, coalesce(nullif(label, ''), nullif(manager_email, ''), manager_id, '') as manager from ex_records left join ex_user_labels on user_id = manager_id""",
    "ex_clean": """select k, case when k % 3 = 0 then split_part(project_name, '_', 1) || ' ' || split_part(project_name, '_', 3) else split_part(project_name, '_', 1) end as clean_name from fx_projects""",
    "ex_normalized": """select k, project_id, scoro_id, project_no, project_name, coalesce(status, '') as status, '' as status_name,
 manager as project_manager, manager as project_manager_name, coalesce(project_team, '') as project_members,
 cast(start_date as varchar) as start_date, cast(due_date as varchar) as due_date, '' as completed_date, description, client as client_company,
 client_contacts, c_projecttype as project_type, c_clientcountry as client_country, c_businessarea as business_area, '' as business_line_division,
 '' as budget_type, c_ponumber as po_number, '' as open_po_number, '' as related_project, '' as google_drive_link, '' as project_priority, all_tags as tags
 from ex_client join ex_manager using (k) left join ex_team using (k)""",
}

ORACLES = {
    "custom_fields_map": """select id, 'c_projecttype' as key, c_projecttype as value from ex_records where k % 3 < 2
 union all select id, 'c_clientcountry', c_clientcountry from ex_records where k % 3 = 0
 union all select id, 'c_businessarea', c_businessarea from ex_records where k % 3 = 0
 union all select id, 'c_ponumber', c_ponumber from ex_records where k % 3 = 1""",
    "custom_value": "select id, c_projecttype, c_clientcountry, c_businessarea, c_ponumber, '' as hours, '' as no_such_key from ex_records",
    "overlay_detail": """select id, case when k % 4 = 2 then 'From the detail record' else description end as description,
 case when k % 6 = 0 then 'Detail ' || client_country else company_name end as company_name, case when k % 2 = 0 then 'true' else 'false' end as is_open, '0' as hours,
 case when k % 2 = 0 then 'detail type' else c_projecttype end as c_projecttype, case when k % 2 = 0 then 'low' else '' end as c_project_priority,
 c_ponumber, c_businessarea from ex_records""",
    "name_hints": "select project_id, split_part(project_name, '_', 2) as contact, split_part(project_name, '_', 3) as colleague from fx_projects",
    "contact_labels": "select contact_id, label from ex_contact_labels",
    "user_labels": "select user_id, label from ex_user_labels",
    "company_labels": "select company_id, label from ex_company_labels",
    "project_team": "select cast(k as varchar) as id, project_team from ex_team",
    "client_info": "select id, client as client_company, client_contacts from ex_client",
    "enrich_scope": "select project_id, status from fx_projects where lower(status) in ('inprogress', 'pending', 'future', 'plan')",
    "needs_enrichment": "select id, no_client, thin_team, no_manager, no_client or thin_team or no_manager as needs from ex_needs",
    "budgeted_enrichment": """select id, coalesce(detail_granted, false) as detail_granted, coalesce(related_granted, false) as related_granted,
 case when detail_granted and k % 4 = 2 then 'From the detail record' else description end as description from ex_records left join ex_grants using (k)""",
    "normalize_projects": "select * exclude k from ex_normalized",
    "safe_dates": """select k, stated, cast(case k % 6 when 0 then start_date when 1 then date '2024-01-05' when 5 then due_date end as varchar) as day from
 (select *, case k % 6 when 0 then cast(start_date as varchar) || 'T10:00' when 1 then '2024-1-5' when 2 then '' when 3 then '2024-13-45'
        when 4 then 'soon' else cast(due_date as varchar) end as stated from fx_projects)""",
    "status_breakdown": "select coalesce(nullif(status, ''), 'unknown') as status, count(*) as projects from fx_projects group by 1",
    "clean_project_names": "select project_id, clean_name from fx_projects join ex_clean using (k)",
}
