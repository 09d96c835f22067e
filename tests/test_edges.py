"""Edge rows of single operators."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from casebook.functions import markdown as md
from casebook.functions import titles
from casebook.functions.records import custom_fields, text_of
from casebook.functions.text import clean_project_name, name_hints, safe_date
from casebook.operators import classify as cl
from casebook.operators import discovery as ds
from casebook.operators import normalize as nm
from casebook.operators import pages as pg
from casebook.operators import selection as sel
from casebook.operators import upsert as up
from casebook.operators import wiki_sources as ws
from casebook.schemas import CANDIDATES, DOCUMENTS, PROJECTS, USERS
from casebook.sources import landed, search_results, tables

NOW = datetime(2026, 1, 2, 3, 4, 5)


def one(spark, value, column, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(column).first()[0]


def records(spark, items):
    rows = [(str(i), json.dumps(item)) for i, item in enumerate(items)]
    return spark.createDataFrame(rows, "id string, j string").select("id", F.parse_json("j").alias("rec"))


# --- records ----------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "record, expected",
    [
        ({"customFields": {"a": "1"}}, {"a": "1"}),
        ({"customFields": []}, {}),
        ({"customFields": [{"name": "a", "value": 1}, {"field_name": "b", "value": 2}]}, {"a": "1", "b": "2"}),
        ({"customFields": [{"code": "c", "value": 3}, {"key": "d", "value": 4}, {"id": 5, "values": ["x", "y"]}]}, {"c": "3", "d": "4", "5": "x, y"}),
        ({"customFields": [{"name": "a", "value": "old"}, {"name": "a", "value": "new"}, "junk", 7]}, {"a": "new"}),
        ({"customFields": [{"name": "a", "value": None, "values": "never"}]}, {"a": None}),
        ({"customFields": None, "custom_fields": {"a": "snake"}}, {"a": "snake"}),
        ({"customFields": "text"}, {}),
        ({}, {}),
    ],
)
def test_custom_field_shapes(spark, record, expected):
    row = nm.with_custom_fields(records(spark, [record])).first()
    assert (row["custom"] or {}) == expected


def test_zero_and_false_count_as_missing(spark):
    rec = [{"a": 0, "b": "0", "c": False, "d": True, "e": "", "f": 7, "g": None}]
    got = records(spark, rec).select(*[F.expr(text_of("rec", n)).alias(n) for n in "abcdefg"]).first()
    assert got.asDict() == {"a": None, "b": "0", "c": None, "d": "True", "e": None, "f": "7", "g": None}


def test_overlay_keeps_list_data(spark):
    base = {"name": "n", "tags": ["x"], "hours": 5, "open": True, "custom_fields": {"a": "1", "b": "2"}}
    detail = {"name": "", "tags": [], "note": None, "meta": {}, "hours": 0, "open": False, "customFields": {"b": "3"}}
    raw = records(spark, [base]).withColumn("detail", F.parse_json(F.lit(json.dumps(detail))))
    merged = json.loads(raw.select(F.to_json(nm.overlay())).first()[0])
    assert merged == {"name": "n", "tags": ["x"], "hours": 0, "open": False, "customFields": {"a": "1", "b": "3"}}


def test_first_seen(spark):
    rows = [(2, 1, 0, '{"project_id": 1, "n": "late"}'), (1, 2, 0, '{"id": 1, "n": "first"}'), (1, 1, 0, '{"n": "no id"}')]
    raw = spark.createDataFrame(rows, "status_ord int, page int, pos int, j string").withColumn("rec", F.parse_json("j"))
    got = landed.first_seen(raw).select(F.try_variant_get("rec", "$.n", "string")).collect()
    assert [r[0] for r in got] == ["first"]


def test_pages_behind_the_short_page_are_ignored(spark):
    lines = [("s", 1, '[{"id":1},{"id":2}]'), ("s", 2, '[{"id":3}]'), ("s", 3, '[{"id":4}]'), ("t", 1, "[]"), ("u", 1, '[{"id":9}]')]
    pages = spark.createDataFrame(lines, "status string, page bigint, j string").select(
        "status", "page", F.try_variant_get(F.parse_json("j"), "$", "array<variant>").alias("data")
    )
    got = landed.raw_projects(pages, ["s", "t"], per_page=2).select(F.try_variant_get("rec", "$.id", "int")).collect()
    assert sorted(r[0] for r in got) == [1, 2, 3]


def test_landed_lists_give_dimensions(spark, tmp_path):
    lines = [{"page": 2, "data": [{"id": 7, "firstname": "New", "lastname": " N "}]}, {"page": 1, "data": [{"id": 7, "firstname": "Old"}, {"user_id": 8, "email": "e@x"}, {"id": 9}]}]
    (tmp_path / "users.json").write_text("\n".join(map(json.dumps, lines)))
    users = nm.user_labels(landed.read_list(spark, str(tmp_path), USERS))
    assert {(r.user_id, r.label) for r in users.collect()} == {("7", "New N"), ("8", "e@x")}


def test_written_tables_need_a_shared_folder(spark):
    from casebook.sources.durable import new_place, settle

    assert "/casebook/x-" in new_place(spark, "x")
    assert settle(spark.range(3).withColumn("v", F.col("id").cast("variant")), "x").count() == 3


def test_statuses_to_read():
    assert landed.statuses_to_read() == ["inprogress"]
    assert landed.statuses_to_read("all", " a, ,b ") == ["a", "b"]
    assert len(landed.statuses_to_read("all")) == 9


# --- names, dates, titles ---------------------------------------------------------------------


@pytest.mark.parametrize(
    "name, hints",
    [("plain", ("", "")), ("a__b", ("b", "")), ("a_b_c", ("b", "c")), ("a_ b _c_d", ("b", "c")), ("", ("", "")), (None, ("", ""))],
)
def test_name_hints(spark, name, hints):
    assert tuple(one(spark, name, name_hints(F.col("v")))) == hints


@pytest.mark.parametrize(
    "name, clean",
    [
        ("Web 26_Diana Silander_Kowalska A", "Web 26"),
        ("Web_phase two_Phase 2", "Web phase two Phase 2"),
        ("Web_Łucja Żak_Śliwa O'Neil", "Web"),
        ("Anna Nowak", "Anna Nowak"),
        ("One Two_A B C D", "One Two A B C D"),
        ("a__b", "a b"),
        ("_Solo_", "_Solo_"),
    ],
)
def test_clean_project_name(spark, name, clean):
    assert one(spark, name, clean_project_name(F.col("v"))) == clean


@pytest.mark.parametrize(
    "stated, day",
    [(None, None), ("", None), ("2024-1-5", date(2024, 1, 5)), ("2024-01-05T10:00", date(2024, 1, 5)), ("0000-00-00", None), ("2024-13-45", None)],
)
def test_safe_date(spark, stated, day):
    assert one(spark, stated, safe_date(F.col("v"))) == day


@pytest.mark.parametrize(
    "title, version, base",
    [
        ("a_v2.pdf", 2, "apdf"),
        ("a-V10 final.pdf", 10, "afinal.pdf"),
        ("a v3", 3, "a"),
        ("av3.pdf", 0, "av3.pdf"),
        ("a_v2_v5.pdf", 2, "av5.pdf"),
        ("A_.-", 0, "a"),
        ("x_v20240101120000123", 20240101120000123, "x"),
    ],
)
def test_versions(spark, title, version, base):
    row = spark.createDataFrame([(title,)], "v string").select(
        titles.version_number(F.col("v")).alias("n"), titles.base_name(F.col("v")).alias("b")
    ).first()
    assert (row.n, row.b) == (version, base)


@pytest.mark.parametrize(
    "title, noise",
    [("TV - 12", True), ("x_OP Summary_y", True), ("x_OP_Summary_y", False), ("my Jira list", True), ("Jiras", False), ("planning 3", True), ("agency_purchased x", True)],
)
def test_noise(spark, title, noise):
    assert one(spark, title, titles.is_noise(F.col("v"))) is noise


@pytest.mark.parametrize(
    "title, kind",
    [
        ("Report.pdf", "PO Summary"), ("ce_1.PDF", "Cost Estimate"), ("a quote.pdf", "Cost Estimate"), ("x.pdf", "PDF Deliverable"),
        ("a.ppt", "Presentation"), ("a.indd", "InDesign File"), ("a.ai", "Design Asset"), ("a.svg", "Image Asset"), ("a.doc", "Word Document"),
        ("a.csv", "Spreadsheet"), ("a.mov", "Video"), ("CE_x", "Cost Estimate"), ("x", "Document"),
    ],
)
def test_document_type(spark, title, kind):
    assert one(spark, title, titles.document_type(F.col("v"))) == kind


# --- search -----------------------------------------------------------------------------------


def parsed(spark, document):
    df = spark.createDataFrame([(json.dumps({"document": document}),)], "result string")
    return search_results.parse_search_results(df).collect()


def test_search_result_edges(spark):
    assert parsed(spark, {"structData": {"title": "t"}}) == []
    row = parsed(spark, {"name": "HTTPS://x/y", "derivedStructData": {"extractiveAnswers": [{"pageContent": "p"}], "extractiveSegments": [{"content": "s" * 13000}]}})[0]
    assert (row.document_id, row.title, row.source_url, row.url) == ("HTTPS://x/y",) * 4
    assert row.full_text.startswith("p\n\nsss") and len(row.full_text) == 13003 and len(row.text_preview) == 13003
    row = parsed(spark, {"id": "1", "name": "projects/1", "structData": {"uri": "gs://a"}})[0]
    assert (row.url, row.source_url, row.text_preview) == ("gs://a", "", "")


def test_queries_without_repeats(spark):
    schema = "project_id string, project_name string, project_no string, client_company string, description string, tags string"
    rows = [("p", "", "", "", "d", "t"), ("q", "ABC", "abc", None, "", ""), ("r", "Web", "7", "Acme", " " * 3, "t")]
    got = ds.project_queries(spark.createDataFrame(rows, schema)).orderBy("project_id", "query_ord").collect()
    texts = [(r.project_id, r.query) for r in got]
    assert [t for p, t in texts if p == "p"] == []
    assert [t for p, t in texts if p == "q"] == ["abc", '"ABC" abc']
    assert [t for p, t in texts if p == "r"] == ["7", '"Web" 7', "Web", "Acme Web", "Acme t", "Acme"]


def test_discovery_fails_only_when_nothing_was_found(spark):
    schema = "project_id string, candidates bigint, error string"
    failed = spark.createDataFrame([("a", 0, "x")], schema)
    assert ds.discovery_outcome(failed).first()["status"] == "error"
    mixed = spark.createDataFrame([("a", 0, "x"), ("b", 2, None)], schema)
    row = ds.discovery_outcome(mixed).first()
    assert (row.status, row.records_read, row.records_written, row.failures) == ("success", 2, 2, 1)


# --- classification ---------------------------------------------------------------------------


def test_replies(spark):
    replies = {
        "bad": "{", "list": "[]", "none": "{}",
        "ok": json.dumps({"matches": [
            {"document_id": "a", "decision": "strong_match", "confidence_score": 0.75},
            {"document_id": "b", "decision": "strong_match", "confidence_score": 0.7499},
            {"document_id": "c", "decision": "Reject", "confidence_score": 1},
            {"document_id": "d", "confidence_score": "0.9"},
            {"document_id": "", "decision": "strong_match", "confidence_score": 1},
            {"document_id": "e", "decision": "strong_match"},
            {"document_id": "f", "decision": "strong_match", "confidence_score": "high"},
        ]}),
    }
    parsed_replies = cl.parse_replies(spark.createDataFrame(list(replies.items()), "project_id string, reply string"))
    matches = cl.match_rows(parsed_replies)
    assert sorted(r.document_id for r in cl.accept_matches(matches).collect()) == ["a", "d"]
    errors = {(r.project_id, r.error) for r in cl.reply_errors(parsed_replies, matches).collect()}
    assert errors == {("bad", "invalid JSON"), ("list", "invalid JSON"), ("ok", "score is no number")}
    none = spark.createDataFrame([("ok", "a")], "project_id string, document_id string")
    assert {r.document_id for r in cl.unasked_matches(cl.accept_matches(matches), none).collect()} == {"d"}


# --- selection, upserts -----------------------------------------------------------------------


def test_active_projects_order(spark):
    rows = [("a", None, date(2024, 1, 1)), ("b", "DONE", date(2024, 1, 1)), ("c", "Open", None), ("d", "open", date(2023, 1, 1)), ("e", "x", date(2023, 1, 1))]
    df = spark.createDataFrame(rows, "project_id string, status string, start_date date")
    assert [r.project_id for r in sel.active_projects(df, 9).collect()] == ["d", "e", "c"]
    assert {r.project_id for r in sel.active_projects(df).collect()} == {"c", "d", "e"}
    assert [r.project_id for r in sel.all_projects(df, 2).collect()] == ["a", "b"]


@pytest.mark.parametrize("small", [False, True])
def test_upsert_documents_keeps_and_repeats(spark, small):
    target = spark.createDataFrame(
        [("a", "old", "folder", "me"), ("z", "stays", "f", "you")], "document_id string, title string, folder_path string, author string"
    )
    target = tables.align_to_schema(target, DOCUMENTS, False)
    source = spark.createDataFrame([("a", "new", "", ""), ("b", "added", "g", "us")], "document_id string, title string, folder_path string, author string")
    source = tables.align_to_schema(source, DOCUMENTS, True)
    once = up.upsert_documents(target, source, NOW, small)
    got = {r.document_id: (r.title, r.folder_path, r.author, r.created_at) for r in once.collect()}
    assert got == {"a": ("new", "folder", "me", None), "z": ("stays", "f", "you", None), "b": ("added", "g", "us", None)}
    twice = up.upsert_documents(once, source, NOW, small)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))
    empty = spark.createDataFrame([], DOCUMENTS)
    assert up.upsert_documents(empty, source, NOW, small).count() == 2
    assert up.upsert_documents(target, empty, NOW, small).count() == 2


def test_candidates_are_reduced_first(spark):
    source = spark.createDataFrame(
        [("p", "d", 5, "q5"), ("p", "d", 2, "q2"), ("p", "d", 2, "q1"), ("p", "e", None, "q")],
        "project_id string, document_id string, rank bigint, discovery_query string",
    )
    got = up.upsert_candidates(spark.createDataFrame([], CANDIDATES), source, "r", NOW).collect()
    assert {(r.document_id, r.rank, r.discovery_query, r.run_id) for r in got} == {("d", 2, "q1", "r"), ("e", 0, "q", "r")}


def test_doubled_source_is_refused(spark):
    doubled = spark.createDataFrame([("a",), ("a",)], "project_id string")
    with pytest.raises(ValueError):
        up.assert_unique(doubled, ["project_id"])
    up.assert_unique(doubled.distinct(), ["project_id"])


def test_align_to_schema(spark):
    old = spark.createDataFrame([("p", None)], "project_id string, status string")
    row = tables.align_to_schema(old, PROJECTS).first()
    assert (row.project_id, row.status, row.tags, row.start_date) == ("p", "", "", None)
    assert "tags" in tables.missing_columns(old, PROJECTS)


# --- budget -----------------------------------------------------------------------------------


@pytest.mark.parametrize("budget, granted", [(0, {}), (1, {"0": (True, False)}), (2, {"0": (True, True)}), (9, {"0": (True, True), "1": (False, True), "2": (True, True)})])
def test_budget(spark, budget, granted):
    raw = records(spark, [{"status": "pending"}] * 3).withColumn("ord", F.col("id").cast("int"))
    details = records(spark, [{"name": "x"}] * 3).withColumnRenamed("rec", "detail").filter("id <> '1'")
    related = records(spark, [{"users": []}] * 3).withColumnRenamed("rec", "related")
    companies = spark.createDataFrame([], "company_id string, label string")
    got = nm.budgeted_enrichment(raw, details, related, companies, budget).collect()
    assert len(got) == 3
    assert {r.id: (r.detail_granted, r.related_granted) for r in got if r.detail_granted or r.related_granted} == granted


# --- wiki -------------------------------------------------------------------------------------


def docs(spark, titles_of, number="500123"):
    rows = [("p", f"d{i}", t, number, i + 1, "", "") for i, t in enumerate(titles_of)]
    return spark.createDataFrame(
        rows, "project_id string, document_id string, title string, project_no string, position int, source_url string, url string"
    )


def chosen(spark, titles_of, number="500123", **limits):
    rows = ws.select_sources(docs(spark, titles_of, number), **limits).orderBy("index").collect()
    return [(r.title, r.branch) for r in rows]


def test_equal_versions_keep_the_first_and_its_place(spark):
    got = chosen(spark, ["500123_a.pdf", "500123_b_v1.x", "500123_b_v3.x", "500123_c_v3.x", "500123_c-v3.x"])
    assert got == [("500123_b_v3.x", "filtered"), ("500123_c_v3.x", "filtered"), ("500123_a.pdf", "filtered"),
                   ("500123_b_v1.x", "supplement"), ("500123_c-v3.x", "supplement")]


def test_source_fallbacks(spark):
    assert chosen(spark, ["a", "b", "Handover_c"], fallback=2) == [("a", "fallback"), ("b", "fallback")]
    four = ["CE_1", "ce_2", "500123", "CE_4", "other"]
    assert [b for _, b in chosen(spark, four)] == ["filtered"] * 4
    assert [b for _, b in chosen(spark, four[1:])] == ["filtered"] * 3 + ["supplement"]
    assert chosen(spark, ["500123_OP_Summary_x", "9_OP_Summary_x CE_"], fallback=1)[0][1] == "filtered"
    assert chosen(spark, ["x", "CE_y"], number="") == [("CE_y", "filtered"), ("x", "supplement")]


def test_replace_section(spark):
    def replaced(text):
        return one(spark, text, md.replace_sources_section(F.col("v"), F.lit("T")))

    assert replaced("a\n") == "a\n\nT"
    assert replaced("a\n## source DOCUMENTS \nx\n## More\ny") == "a\n\nT"
    assert replaced("## Source Documents\nx") == "## Source Documents\nx\n\nT"


def test_citations(spark):
    links = F.map_from_arrays(F.array(F.lit("1"), F.lit("2")), F.array(F.lit("u"), F.lit("")))

    def linked(text):
        return one(spark, text, md.linkify_citations(F.col("v"), links))

    assert linked("[1]") == "[1](u)"
    assert linked("a [1,  2] b") == "a [1](u), [2](#source-2) b"
    assert linked("[1](u) ([1]) [99] [a]") == "[1](u) ([1]) [99](#source-99) [a]"
    assert linked("[1][2]") == "[1](u)[2](#source-2)"
    assert linked("") == ""
    assert linked("[001] [0]") == "[1](u) [0](#source-0)"
    assert linked("[99999999999999999999]") == "[99999999999999999999](#source-99999999999999999999)"
    assert linked("[1, 99999999999999999999]") == "[1](u), [99999999999999999999](#source-99999999999999999999)"
    assert linked("[١]") == "[1](u)"


@pytest.mark.parametrize(
    "text, limit, expected",
    [
        ("", 4, [""]), (None, 4, [""]), ("abcd", 4, ["abcd"]), ("abcde", 4, ["abcd", "e"]), ("abcéd", 4, ["abc", "éd"]),
        ("a😀b", 4, ["a", "😀", "b"]), ("ééé", 4, ["éé", "é"]),
    ],
)
def test_chunks(spark, text, limit, expected):
    assert one(spark, text, md.utf8_chunks(F.col("v"), limit)) == expected


def test_chunk_limit_below_one_character(spark):
    with pytest.raises(ValueError):
        md.utf8_chunks(F.col("v"), 3)


def test_chunks_of_mixed_text(spark):
    text = "aé😀ßx漢" * 40
    for limit in (4, 5, 7, 11, 64):
        pieces = one(spark, text, md.utf8_chunks(F.col("v"), limit))
        assert "".join(pieces) == text
        assert max(len(p.encode()) for p in pieces) <= limit
        assert all(len((a + b[0]).encode()) > limit for a, b in zip(pieces, pieces[1:]))


def test_rewritten_page_loses_its_old_chunks(spark):
    old = spark.createDataFrame([("p", 0, "a", 2), ("p", 1, "b", 2), ("q", 0, "c", 2)], "project_id string, index int, content string, total_chunks int")
    pages = spark.createDataFrame([("p", "short")], "project_id string, markdown string")
    written = pg.chunked_pages(pages, 100)
    left = pg.replace_chunks(old, written, pg.stored_chunks(written)).collect()
    assert [(r.project_id, r["index"]) for r in left] == [("q", 0)]
    assert pg.stale_chunks(old, written, pg.stored_chunks(written)).count() == 2


def test_bare_project_page(spark):
    projects = spark.createDataFrame([("p", "Name")], "project_id string, project_name string")
    nothing = spark.createDataFrame([], "project_id string")
    page = pg.no_source_pages(projects, nothing).first()["markdown"]
    assert page == "# Name\n\nAgency runs project **p**.\n\n_Document intelligence for this project is still being indexed._"
    assert pg.with_background(projects).first()["background"] == "p — Name."


def test_all_pages_failed(spark):
    failed = spark.createDataFrame([("a", "x")], "project_id string, error string")
    assert pg.batch_outcome(failed).first()["status"] == "error"
    assert pg.batch_outcome(failed.limit(0)).first()["status"] == "ok"
