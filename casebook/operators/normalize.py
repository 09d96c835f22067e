"""Project records of the source API to flat project rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.functions.records import (
    EMPTY_JSON,
    NO_VARIANTS,
    any_text_at,
    contact_name,
    custom_fields,
    custom_text,
    custom_texts,
    elements,
    elements_at,
    field,
    is_object,
    let,
    person_label,
    text as variant_text,
    text_at,
    text_of,
)
from casebook.functions.text import filled, first_filled, is_filled, name_hints, safe_date, strip
from casebook.schemas import ENRICH_STATUSES, PROJECT_ID_PREFIX
from casebook.sources.durable import settle

MEMBER_FIELDS = ("project_users", "members", "project_users_list")


def record_text(*names: str, record: str = "rec") -> Column:
    return F.expr(text_of(record, *names))


def with_custom_fields(raw: DataFrame) -> DataFrame:
    """Adds the custom fields of `rec` as map<string,string>."""
    return raw.withColumn("custom", F.expr(custom_texts(custom_fields("rec"))))


def custom_column(key: str) -> Column:
    return F.expr(custom_text("custom", "rec", key))


# --- dimensions -------------------------------------------------------------------------------


def _last_labels(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One label per key; the last one read wins. Rows without key or label are dropped."""
    latest = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return (
        rows.filter(is_filled(F.col(key)) & is_filled(F.col("label")))
        .withColumn("nth", F.row_number().over(latest))
        .filter("nth = 1")
        .select(key, "label")
    )


def contact_labels(contacts: DataFrame, order: str = "ord") -> DataFrame:
    """contact_id -> display label of persons and companies."""
    person = F.col("contact_type") == "person"
    label = F.when(
        person,
        F.expr(person_label("name", "lastname", "search_name", "position")),
    ).otherwise(strip(F.coalesce("name", F.lit(""))))
    rows = contacts.select(first_filled(F.col("contact_id"), F.col("id")).alias("contact_id"), label.alias("label"), order)
    return _last_labels(rows, "contact_id", [order])


def user_labels(users: DataFrame, order: str = "ord") -> DataFrame:
    """user_id -> first and last name, else the full name, else the e-mail address."""
    first, last = (filled(strip(F.coalesce(c, F.lit("")))) for c in ("firstname", "lastname"))
    label = first_filled(F.concat_ws(" ", first, last), F.col("full_name"), F.col("email"))
    rows = users.select(first_filled(F.col("id"), F.col("user_id")).alias("user_id"), label.alias("label"), order)
    return _last_labels(rows, "user_id", [order])


def company_labels(companies: DataFrame | None, contacts: DataFrame, order: str = "ord") -> DataFrame:
    """company_id -> name from the company list and company-type contacts; contacts win."""
    of_type = contacts.filter(F.col("contact_type") == "company")
    from_contacts = of_type.select(
        first_filled(F.col("contact_id"), F.col("id")).alias("company_id"),
        strip(F.coalesce("name", F.lit(""))).alias("label"),
        F.lit(1).alias("list_no"),
        order,
    )
    if companies is None:
        return _last_labels(from_contacts, "company_id", ["list_no", order])
    from_companies = companies.select(
        first_filled(F.col("company_id"), F.col("contact_id"), F.col("id")).alias("company_id"),
        strip(first_filled(F.col("name"), F.col("company_name"))).alias("label"),
        F.lit(0).alias("list_no"),
        order,
    )
    return _last_labels(from_companies.unionByName(from_contacts), "company_id", ["list_no", order])


def with_label(rows: DataFrame, ref: str, labels: DataFrame, key: str, out: str, spread: str) -> DataFrame:
    """Left join a label dimension on a reference that may be NULL or name one hot id.

    Rows without a reference get a key of their own (built from `spread`), so they hash apart
    instead of meeting in the NULL partition. The join strategy is left to Catalyst: a broadcast
    when the dimension is known to be small, otherwise a sort-merge join with skew splitting.
    """
    lookup = labels.select(F.col(key).alias("_ref"), F.col("label").alias(out))
    spread_key = F.coalesce(F.col(ref), F.concat(F.lit("\u0000"), F.col(spread).cast("string")))
    return rows.withColumn("_ref", spread_key).join(lookup, "_ref", "left").drop("_ref")


# --- enrichment -------------------------------------------------------------------------------


def in_enrich_scope(status: Column, scope: str = "active") -> Column:
    if scope.lower() == "all":
        return F.lit(True)
    return F.lower(F.coalesce(status, F.lit(""))).isin(*ENRICH_STATUSES)


def thinness(raw: DataFrame, companies: DataFrame) -> DataFrame:
    """Adds what a record lacks: `no_client`, `thin_team`, `no_manager`."""
    company_field = let(custom_fields("rec"), "fs", "try_element_at(fs, 'c_clientcompany')")
    company = f"coalesce({text_at('rec', 'company_id')}, {let(company_field, 'v', variant_text('v'))})"
    users = field("rec", "project_users")
    team = f"if(coalesce(to_json({users}) not in {EMPTY_JSON}, false), {elements(users)}, {elements(field('rec', 'members'))})"
    staged = raw.withColumns(
        {
            "_company": F.expr(company),
            "_stated": strip(F.coalesce(record_text("company_name"), F.lit(""))),
            "thin_team": F.expr(f"coalesce(size({team}), 0) < 2"),
            "no_manager": record_text("managerId", "manager_id").isNull(),
        }
    )
    labelled = with_label(staged, "_company", companies, "company_id", "_label", "id")
    return labelled.withColumn("no_client", ~(is_filled(F.col("_stated")) | is_filled(F.col("_label")))).drop(
        "_company", "_stated", "_label"
    )


def needs_enrichment(raw: DataFrame, companies: DataFrame) -> DataFrame:
    return thinness(raw, companies).withColumn("needs", F.col("no_client") | F.col("thin_team") | F.col("no_manager"))


def overlay(base: str = "rec", detail: str = "detail") -> Column:
    """Lay a detail record over a list record: its non-empty fields win, custom fields merge."""
    as_map = "try_variant_get({0}, '$', 'map<string,variant>')"
    custom_names = "('customFields', 'custom_fields')"
    wins = f"map_filter(d, (k, v) -> k not in {custom_names} and to_json(v) not in ('null', '\"\"', '[]', '{{}}'))"
    has_custom = f"exists(map_keys(d), k -> k in {custom_names})"
    kept = f"map_filter(b, (k, v) -> not map_contains_key(w, k) and not (k in {custom_names} and {has_custom}))"
    merged_fields = let(
        custom_fields(detail), "df", f"map_concat(map_filter({custom_fields(base)}, (k, v) -> not map_contains_key(df, k)), df)"
    )
    custom = f"if({has_custom}, map('customFields', to_variant_object({merged_fields})), cast(map() as map<string,variant>))"
    merged = let(
        as_map.format(base), "b", let(as_map.format(detail), "d", let(wins, "w", f"to_variant_object(map_concat({kept}, w, {custom}))"))
    )
    return F.expr(f"case when {detail} is null or {as_map.format(detail)} is null then {base} else {merged} end")


def overlay_details(raw: DataFrame, details: DataFrame) -> DataFrame:
    """raw (id, rec, ...) with the detail record (id, detail) laid over where one exists."""
    return raw.join(details.select("id", "detail"), "id", "left").withColumn("rec", overlay()).drop("detail")


def _running_total(priced: DataFrame, order: str) -> DataFrame:
    """`priced` with `spent`, the cost of all rows before it; written once, as ranges are cut by a sample."""
    ranged = settle(priced.repartitionByRange(order, "id").withColumn("range", F.spark_partition_id()), "priced-ranges")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = (
        ranged.groupBy("range")
        .agg(F.sum("cost").alias("sum"))
        .select("range", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("offset"))
    )
    so_far = Window.partitionBy("range").orderBy(order, "id").rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumn("inside", F.coalesce(F.sum("cost").over(so_far), F.lit(0)))
    return inside.join(offsets, "range").withColumn("spent", F.col("inside") + F.col("offset"))


def budgeted_enrichment(
    raw: DataFrame,
    details: DataFrame,
    related: DataFrame,
    companies: DataFrame,
    budget: int | None = None,
    scope: str = "active",
    order: str = "ord",
) -> DataFrame:
    """Records with granted detail and related objects, in project order until the budget is used.

    One call for a detail record, one more for related objects where client or team are still thin
    after it. Without a budget every call is granted. The running total is taken range by range of
    the order, with the sums of the earlier ranges added, so no task holds the whole queue.
    """
    scoped = needs_enrichment(raw, companies).filter(
        F.col("needs") & in_enrich_scope(record_text("status"), scope)
    )
    tried = scoped.select("id", order, "rec").join(details.select("id", "detail"), "id", "left")
    after = thinness(tried.withColumn("rec", overlay()), companies)
    priced = (
        after.join(related.select("id", F.lit(1).alias("has_related")), "id", "left")
        .withColumn("detail_cost", F.when(F.col("detail").isNotNull(), 1).otherwise(0))
        .withColumn(
            "related_cost",
            F.when((F.col("no_client") | F.col("thin_team")) & F.col("has_related").isNotNull(), 1).otherwise(0),
        )
        .withColumn("cost", F.col("detail_cost") + F.col("related_cost"))
        .filter("cost > 0")
        .select("id", order, "detail_cost", "related_cost", "cost")
    )
    within = F.lit(True) if budget is None else F.col("spent") < budget
    within_both = F.lit(True) if budget is None else F.col("spent") + F.col("detail_cost") < budget
    queue = priced.withColumn("spent", F.lit(0)) if budget is None else _running_total(priced, order)
    granted = (
        queue.withColumn("detail_granted", (F.col("detail_cost") > 0) & within)
        .withColumn("related_granted", (F.col("related_cost") > 0) & within_both)
        .filter("detail_granted or related_granted")
        .select("id", "detail_granted", "related_granted")
    )
    granted_details = details.join(granted.filter("detail_granted"), "id").select("id", "detail")
    granted_related = related.join(granted.filter("related_granted"), "id").select("id", "related")
    return (
        raw.join(granted_details, "id", "left")
        .join(granted_related, "id", "left")
        .withColumn("detail_granted", F.col("detail").isNotNull())
        .withColumn("related_granted", F.col("related").isNotNull())
        .withColumn("rec", overlay())
        .drop("detail")
    )


# --- team and client --------------------------------------------------------------------------


def _person(label: str, ref: str, fallback: str) -> str:
    """One mention of a person: stated label, id to look up, text to show if both fail."""
    return f"named_struct('label', cast({label} as string), 'ref', cast({ref} as string), 'fallback', cast({fallback} as string))"


def _members(name: str) -> str:
    """A team entry is an object or a bare id."""
    ref, bare = text_of("m", "user_id", "id"), "try_variant_get(m, '$', 'string')"
    as_object = _person(text_of("m", "full_name", "name"), ref, f"coalesce({text_at('m', 'email')}, {ref})")
    return f"transform({elements_at('rec', name)}, m -> if({is_object('m')}, {as_object}, {_person('null', bare, bare)}))"


def _items(module: str) -> str:
    """Related objects of a module, given as a list or as {items: list}; only objects count."""
    node = field("related", module)
    listed = f"coalesce({elements(node)}, {elements(field(node, 'items'))}, {NO_VARIANTS})"
    return f"filter({listed}, o -> {is_object('o')})"


def _related_users() -> str:
    both = f"nullif(trim(concat_ws(' ', {text_at('u', 'firstname')}, {text_at('u', 'lastname')})), '')"
    name = f"coalesce({text_at('u', 'full_name')}, {both}, {text_at('u', 'email')})"
    return f"transform({_items('users')}, u -> {_person(name, 'null', 'null')})"


def project_team(raw: DataFrame, users: DataFrame) -> DataFrame:
    """id -> comma list of distinct team names in order of first mention.

    Input columns: id, rec, related (variant, may be NULL). Names are reduced to one row per
    (project, name) before the list of a project is collected.
    """
    manager = text_of("rec", "managerId", "manager_id")
    manager_mention = f"if({manager} is null, {_person('null', 'null', 'null')}, {_person('null', manager, text_at('rec', 'manager_email'))})"
    people = (
        f"concat({', '.join(_members(name) for name in MEMBER_FIELDS)}, "
        f"array({manager_mention}, {_person('_hint', 'null', 'null')}), {_related_users()})"
    )
    mentions = (
        raw.select("id", "rec", "related", name_hints(record_text("project_name"))["colleague"].alias("_hint"))
        # Outer, so that no size filter is inferred that would build the list twice; it is never empty.
        .select("id", F.posexplode_outer(F.expr(people)).alias("nth", "person"))
        .select(
            "id", "nth", "person.label", "person.fallback",
            F.when(F.col("person.label").isNull(), filled(F.col("person.ref"))).alias("ref"),
        )
        .filter("label is not null or ref is not null or fallback is not null")
    )
    named = with_label(mentions, "ref", users, "user_id", "known_name", "id").withColumn(
        "name", strip(first_filled(F.col("label"), F.col("known_name"), F.col("fallback")))
    )
    firsts = named.filter("name <> ''").groupBy("id", "name").agg(F.min("nth").alias("nth"))
    return firsts.groupBy("id").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("nth", "name")))["name"], ", ").alias("project_team")
    )


def client_info(raw: DataFrame, companies: DataFrame, contacts: DataFrame) -> DataFrame:
    """Adds client_company and client_contacts to rows (id, rec, custom, related)."""
    staged = raw.withColumns(
        {
            "_company_name": record_text("company_name"),
            "_ref_company": F.coalesce(record_text("company_id"), filled(custom_column("c_clientcompany"))),
            "_hint": name_hints(record_text("project_name"))["contact"],
            "_companies": F.expr(
                f"filter(transform({_items('companies')}, c -> trim(coalesce({text_at('c', 'name')}, ''))), n -> n <> '')"
            ),
            "_contacts": F.expr(f"transform({_items('contacts')}, c -> trim(coalesce({contact_name('c')}, '')))"),
        }
    )
    by_company = with_label(staged, "_ref_company", companies, "company_id", "_company_label", "id")
    by_contact = with_label(by_company, "_ref_company", contacts, "contact_id", "_contact_label", "id")
    stated = strip(F.coalesce("_company_name", F.lit("")))
    resolved = by_contact.withColumn("_direct", first_filled(stated, F.col("_company_label"), F.col("_contact_label")))
    # Without any other client the first related company is the client, the others are contacts.
    others = F.expr("if(_direct = '', slice(_companies, 2, greatest(size(_companies), 1)), _companies)")
    labels = F.concat(F.array("_hint"), others, F.col("_contacts"))
    return resolved.withColumns(
        {
            "client_company": first_filled(F.col("_direct"), F.get("_companies", 0), F.col("_company_name")),
            "client_contacts": F.array_join(F.array_distinct(F.filter(labels, lambda n: n != "")), ", "),
        }
    ).drop("_company_name", "_ref_company", "_hint", "_companies", "_contacts", "_company_label", "_contact_label", "_direct")


# --- project rows -----------------------------------------------------------------------------


def normalize_projects(
    raw: DataFrame,
    users: DataFrame,
    companies: DataFrame,
    contacts: DataFrame,
    prefix: str = PROJECT_ID_PREFIX,
) -> DataFrame:
    """Records (id, rec, related) to the 26 text columns of a project row.

    Dates stay text of at most ten characters; the upsert parses them.
    """
    base = with_custom_fields(raw.select("id", "rec", "related"))
    clients = client_info(base, companies, contacts)
    managed = with_label(
        clients.withColumn("_manager", record_text("managerId", "manager_id")), "_manager", users, "user_id", "_manager_name", "id"
    )
    full = managed.join(project_team(raw, users), "id", "left")

    def plain(*names: str) -> Column:
        return F.coalesce(record_text(*names), F.lit(""))

    manager = first_filled(F.col("_manager_name"), record_text("manager_email"), F.col("_manager"))
    return full.select(
        F.concat(F.lit(prefix), F.col("id")).alias("project_id"),
        F.col("id").alias("scoro_id"),
        plain("no").alias("project_no"),
        plain("project_name", "name").alias("project_name"),
        plain("status").alias("status"),
        plain("statusName", "status_name").alias("status_name"),
        manager.alias("project_manager"),
        manager.alias("project_manager_name"),
        F.coalesce("project_team", F.lit("")).alias("project_members"),
        F.substring(record_text("date", "start_date"), 1, 10).alias("start_date"),
        F.substring(record_text("deadline", "due_date"), 1, 10).alias("due_date"),
        plain("completed_date").alias("completed_date"),
        plain("description").alias("description"),
        "client_company",
        "client_contacts",
        first_filled(custom_column("c_projecttype"), plain("project_type")).alias("project_type"),
        custom_column("c_clientcountry").alias("client_country"),
        custom_column("c_businessarea").alias("business_area"),
        custom_column("c_businesslinedivision").alias("business_line_division"),
        first_filled(custom_column("c_budgettype"), plain("budget_type")).alias("budget_type"),
        custom_column("c_ponumber").alias("po_number"),
        custom_column("c_openponr").alias("open_po_number"),
        custom_column("c_relatedproject").alias("related_project"),
        first_filled(custom_column("c_gdrivelink"), custom_column("c_drivelink")).alias("google_drive_link"),
        custom_column("c_project_priority").alias("project_priority"),
        F.expr(any_text_at("rec", "tags")).alias("tags"),
    )


def safe_dates(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: safe_date(F.col(c)) for c in columns})


def status_breakdown(projects: DataFrame) -> DataFrame:
    return projects.groupBy(first_filled(F.col("status"), F.lit("unknown")).alias("status")).agg(
        F.count(F.lit(1)).alias("projects")
    )
