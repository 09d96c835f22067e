"""Shape of the physical plans, and whole-run invariants."""

import os
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as registry
from casebook.operators import upsert as up
from casebook.plans import full_sync as runs
from casebook.plans.steps import WikiSettings
from checks import wiki_checks
from checks.fixtures import base_table

NATIVE = (
    "candidates_per_project", "documents_per_project", "upsert_projects", "discover_candidates", "evidence_score",
    "source_documents", "finalize_pages", "normalize_projects", "term_index",
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_in_native_operators(spark, sf_dir, name):
    text = plan(registry.queries()[name](spark, sf_dir))
    assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups", text)


@pytest.mark.parametrize("name", ["candidates_per_project", "documents_per_project", "dedup_first_seen", "discover_documents"])
def test_groups_are_cut_before_their_shuffle(spark, sf_dir, name):
    assert "WindowGroupLimit" in plan(registry.queries()[name](spark, sf_dir))


def test_no_nested_loops_or_cross_joins(spark, sf_dir):
    for name in ("candidates_per_project", "evidence_score", "source_documents", "client_info", "project_team"):
        assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan(registry.queries()[name](spark, sf_dir)))


def test_top_n_is_not_a_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(registry.queries()["active_projects"](spark, sf_dir))


def test_small_batch_never_shuffles_the_table(spark, sf_dir):
    """With a batch below the broadcast threshold no exchange is left but the broadcasts."""
    orders = base_table(spark, sf_dir, "orders")
    target = orders.select("o_orderkey", "o_orderstatus")
    batch = target.filter("o_orderkey < 50")
    text = plan(up.upsert(target, batch, ["o_orderkey"], target.schema, small_source=True))
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text


def test_windows_of_the_page_sources_share_one_partitioning(spark, sf_dir):
    text = plan(registry.queries()["source_fallback"](spark, sf_dir))
    by_project = re.findall(r"Exchange hashpartitioning\(project_id#\d+, \d+\)", text)
    assert len(by_project) <= 3


def test_single_project_filter_reaches_the_scan(spark, sf_dir, tmp_path):
    from checks.fixtures import fixture

    for name, sql in (("projects", "fx_projects"), ("document_map", "fx_map"), ("documents", "fx_documents")):
        fixture(spark, sf_dir, sql).write.parquet(str(tmp_path / name))
    tables = {n: spark.read.parquet(str(tmp_path / n)) for n in ("projects", "document_map", "documents")}
    settings = runs.RunSettings("r", datetime(2026, 1, 1), wiki=WikiSettings())
    some_id = tables["document_map"].first()["project_id"]
    page = runs.single_project(tables, some_id, settings)
    pushed = [line for line in plan(page).splitlines() if "PushedFilters" in line and f"EqualTo(project_id,{some_id})" in line]
    assert pushed
    assert page.count() == 1


def test_failing_step_is_logged(spark):
    def search(requests):
        raise RuntimeError("search is down")

    rows = spark.createDataFrame([], wiki_checks.runs.PROJECTS).drop("imported_at").withColumns(
        {c: F.col(c).cast("string") for c in ("start_date", "due_date")}
    )
    with pytest.raises(runs.StepFailed) as failure:
        runs.full_sync(spark, runs.empty_tables(spark), rows, search, runs.RunSettings("r", datetime(2026, 1, 1)))
    assert all(r.started_at < r.finished_at for r in failure.value.tables["runs"].collect())
    log = {(r.job_name, r.status, r.error_message) for r in failure.value.tables["runs"].collect()}
    assert log == {
        ("scoro-sync", "success", None),
        ("document-discovery", "error", "search is down"),
        ("full-sync", "error", "Step document-discovery failed: search is down"),
    }


def _rows(spark, n):
    columns = [c for c in runs.PROJECTS.names if c != "imported_at"]
    rows = [tuple({"project_id": f"p{i}", "status": "open", "project_no": str(50_000 + i)}.get(c, "") for c in columns) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


def _no_hits(spark):
    columns = ["query_id string", "result_pos int", *[f"{c} string" for c in runs.DOCUMENTS.names if not c.endswith("_at")]]
    return lambda requests: spark.createDataFrame([], ", ".join(columns))


def test_whole_runs_have_no_limit_by_default(spark):
    settings = runs.RunSettings("r", datetime(2026, 1, 1))
    tables = runs.historical_sync(spark, runs.empty_tables(spark), _rows(spark, 101), _no_hits(spark), settings)
    read = {r.job_name: r.records_read for r in tables["runs"].collect()}
    assert tables["projects"].count() == 101 and read["document-discovery"] == 101


def test_lost_input_is_noted_or_ends_a_strict_run(spark):
    errors = spark.createDataFrame([("landed page", "unreadable line", "{")], "key string, error string, record string")
    mapped = spark.createDataFrame([("gone", "d", 1.0, "m", "", None, "r0")], runs.DOCUMENT_MAP)
    old = runs.empty_tables(spark) | {"document_map": mapped, "projects": spark.createDataFrame([("q", "x")], "project_id string, status string")}
    settings = runs.RunSettings("r", datetime(2026, 1, 1))
    tables = runs.full_sync(spark, old, _rows(spark, 2), _no_hits(spark), settings, errors)
    noted = {(r.job_name, r.key, r.error) for r in tables["errors"].collect()}
    assert noted == {("scoro-sync", "landed page", "unreadable line"), ("wiki-generate", "gone", "mapped project not found")}
    assert {r.project_id for r in tables["projects"].collect()} == {"p0", "p1", "q"}
    assert {r.error_message for r in tables["runs"].collect()} == {"1 errors", None}
    strict = runs.RunSettings("r", datetime(2026, 1, 1), strict=True)
    with pytest.raises(runs.StepFailed) as failure:
        runs.full_sync(spark, old, _rows(spark, 2), _no_hits(spark), strict, errors)
    assert failure.value.step == "scoro-sync" and failure.value.tables["errors"].count() == 1


def test_ingest_keeps_pull_order_and_reads_one_version(spark, tmp_path):
    from casebook.streaming.ingest import finished_versions, newest_version, start_ingest

    def land(name, status, page, title):
        (tmp_path / "landing").mkdir(exist_ok=True)
        record = f'{{"project_id": 7, "project_name": "{title}"}}'
        (tmp_path / "landing" / name).write_text(f'{{"status": "{status}", "page": {page}, "data": [{record}]}}\n')

    def normalize(raw):
        columns = [c for c in runs.PROJECTS.names if c not in ("imported_at", "project_id", "scoro_id", "project_name")]
        name = F.try_variant_get("rec", "$.project_name", "string").alias("project_name")
        return raw.select(F.col("id").alias("project_id"), F.col("id").alias("scoro_id"), name, *[F.lit("").alias(c) for c in columns])

    def pull(pull_id):
        versions, progress = str(tmp_path / "versions"), str(tmp_path / "progress")
        start_ingest(
            spark, str(tmp_path / "landing"), versions, progress, ("open", "closed"), normalize, datetime(2026, 1, 1), 1, pull_id
        ).awaitTermination()
        return [r.project_name for r in newest_version(spark, versions).collect()]

    land("a.json", "closed", 1, "second")
    assert pull("one") == ["second"]
    land("b.json", "open", 2, "first")
    assert pull("one") == ["first"]
    land("c.json", "open", 3, "third")
    assert pull("one") == ["first"]
    land("d.json", "closed", 9, "of the next pull")
    assert pull("two") == ["of the next pull"]
    table = newest_version(spark, str(tmp_path / "versions"))
    assert len({f.rsplit("/", 2)[1] for f in table.inputFiles()}) == 1
    assert finished_versions(spark, str(tmp_path / "versions")) == [2, 3]


def test_small_batch_leaves_other_buckets_alone(spark, tmp_path):
    from casebook.operators.upsert import upsert
    from casebook.sources.store import load_table, merge_table

    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.StringType()), T.StructField("new", T.StringType())])
    folder, old = str(tmp_path), T.StructType(schema.fields[:2])

    def store(rows, fields):
        batch = spark.createDataFrame(rows, fields)
        return merge_table(spark, folder, "t", fields, ["id"], batch, lambda target: upsert(target, batch, ["id"], fields), 16)

    store([(f"k{i}", "a") for i in range(200)], old)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    after = store([("k3", "b", "x"), ("k999", "c", "y")], schema)
    rows = {r.id: (r.v, r.new) for r in after.collect()}
    assert len(rows) == 201 and rows["k3"] == ("b", "x") and rows["k999"] == ("c", "y") and rows["k4"] == ("a", None)
    kept = [p for p, t in before.items() if p.exists() and p.stat().st_mtime_ns == t]
    assert len(before) == 16 and len(kept) >= 14
    assert load_table(spark, folder, "missing", schema).count() == 0


def test_lookup_reads_only_the_buckets_of_its_keys(spark, tmp_path):
    from casebook.sources.store import merge_table, rows_of_keys

    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.StringType())])
    rows = spark.range(500).selectExpr("concat('k', id) id", "cast(id as string) v")
    merge_table(spark, str(tmp_path), "t", schema, ["id"], rows, lambda _: rows, 16)
    wanted = spark.createDataFrame([("k7",), ("k7",), ("nobody",), (None,)], "id string")
    found = rows_of_keys(spark, str(tmp_path), "t", schema, ["id"], wanted, 16)
    assert [tuple(r) for r in found.collect()] == [("k7", "7")]
    assert len({r[0] for r in found.select(F.input_file_name()).collect()}) == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan
    none = rows_of_keys(spark, str(tmp_path), "missing", schema, ["id"], wanted, 16)
    assert none.count() == 0 and none.schema == schema


def test_a_large_bucket_has_several_writing_tasks(spark, tmp_path):
    from casebook.sources.store import merge_table

    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.StringType())])
    rows = spark.range(0, 40_000, 1, 8).selectExpr("concat('k', id) id", "sha2(cast(id as string), 256) v")
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "256k")
    try:
        after = merge_table(spark, str(tmp_path), "t", schema, ["id"], rows, lambda _: rows, 2)
    finally:
        spark.conf.set(name, before)
    files = [len(list(folder.glob("*.parquet"))) for folder in (tmp_path / "t").glob("bucket=*")]
    assert len(files) == 2 and min(files) > 1
    assert after.count() == after.select("id").distinct().count() == 40_000


def test_first_run_merges_without_a_join(spark):
    rows = _rows(spark, 10)
    merged = up.upsert_projects(runs.empty_tables(spark)["projects"], rows, datetime(2026, 1, 2))
    assert not re.search("Join|Exchange", plan(merged))
    assert merged.where("project_id is not null and imported_at is not null").count() == 10


def test_results_join_the_hits_once(spark):
    """The rows that give the documents are candidates, also where projects share a document or rank it differently."""
    from casebook.plans.steps import discover_all

    projects = spark.createDataFrame(
        [("p1", "1", "A", "2024-01-02"), ("p2", "2", "A", "2024-03-02"), ("p3", "3", "B", None)],
        "project_id string, project_no string, project_name string, start_date string",
    ).selectExpr("project_id", "project_no", "project_name", "cast(start_date as date) start_date")
    hits = [("A", 1, "d1"), ("A", 2, "d2"), ("1", 1, "d2"), ("2", 1, "d3"), ("3", 1, "d1"), ("3", 2, "d1")]
    results = spark.createDataFrame([(q, n, d, f"{d} by {q} at {n}", f"text {q}") for q, n, d in hits], "query_id string, result_pos int, document_id string, title string, full_text string")
    documents, candidates, _ = discover_all(projects, lambda requests: results)
    assert {(r.document_id, r.title, r.full_text) for r in documents.collect()} == {
        ("d1", "d1 by 3 at 1", "text 3"), ("d2", "d2 by 1 at 1", "text 1"), ("d3", "d3 by 2 at 1", "text 2")
    }
    assert sorted((r.project_id, r.document_id, r.rank) for r in candidates.collect()) == [
        ("p1", "d1", 2), ("p1", "d2", 1), ("p2", "d1", 2), ("p2", "d2", 3), ("p2", "d3", 1), ("p3", "d1", 1)
    ]
    assert "decisive" not in documents.columns + candidates.columns and "full_text" not in candidates.columns
    assert set(documents.inputFiles()) == set(candidates.inputFiles())


@pytest.mark.parametrize("name, parses", [("search_results_parse", 1), ("raw_projects_scan", 1), ("scan_errors", 2)])
def test_every_input_is_parsed_once(spark, sf_dir, name, parses):
    assert plan(registry.queries()[name](spark, sf_dir)).count("from_json(") == parses


def test_a_run_keeps_only_its_tables(spark, sf_dir, monkeypatch):
    from casebook.plans import full_sync as runs
    from casebook.sources import durable
    from checks import wiki_checks

    made = []
    monkeypatch.setattr(durable, "new_place", lambda s, name, new=durable.new_place: made.append(new(s, name)) or made[-1])
    settings = runs.RunSettings("run_1", wiki_checks.AS_OF, wiki=wiki_checks.SETTINGS)
    rows, search = wiki_checks._project_rows(spark, sf_dir), wiki_checks.landed_search(spark, sf_dir)
    made.clear()
    tables = runs.full_sync(spark, runs.empty_tables(spark), rows, search, settings)
    left = sorted(os.path.basename(p).rpartition("-")[0] for p in made if os.path.exists(p))
    assert [name for name in left if name != "errors"] == ["candidates", "chunks", "documents", "mappings", "pages", "projects"]
    assert all(table.count() for name, table in tables.items() if name != "errors")
