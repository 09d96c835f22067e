"""The registered queries: whole tables, the pipeline against brute force, and SQL where there is any."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
import corpus_pipeline
from casebook.llm import queries
from casebook.llm.common import table
from checks.compare import compare
from test_operators import brute_components, brute_hits, brute_repeats


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in registry.queries() if n in queries.QUERIES]
    assert sorted(n.split("_")[0] for n in names) == sorted([*(f"op{i}" for i in range(1, 14)), "pipeline"])


@pytest.mark.parametrize("name", queries.ORACLES)
def test_against_sql(spark, sf_dir, name):
    assert compare(spark, queries.QUERIES[name], queries.ORACLES[name], sf_dir) is None


@pytest.mark.parametrize("name", ["op2_compression_quality", "op6_toxicity", "op8_language_filters"])
def test_scores_are_one_a_document(spark, sf_dir, name):
    got = queries.QUERIES[name](spark, sf_dir)
    assert got.count() == table(spark, sf_dir, "documents").count() == got.select("doc_id").distinct().count()
    assert got.where("score < 0 or score > 1 or score is null").count() == 0


def test_documents_against_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    linked = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op1_ngram_jaccard(spark, sf_dir).collect()}
    assert linked == brute_components(rows, 3, 90)
    assert sorted(map(tuple, queries.op3_suffix_repeats(spark, sf_dir).collect()), key=str) == brute_repeats(rows, 35)
    assert sorted(map(tuple, queries.op7_fm_index(spark, sf_dir).collect()), key=str) == brute_hits(rows, items, 13)


def test_pages_against_brute_force(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").collect()
    got = {r.page_id: r for r in queries.op9_warc(spark, sf_dir).collect()}
    assert len(got) == len(pages)
    for p in pages:
        data = (p.html or "").encode()
        assert (got[p.page_id].payload_bytes, got[p.page_id].payload_digest) == (len(data), hashlib.sha256(data).hexdigest())


def test_pipeline_stage_by_stage(spark, sf_dir):
    """Each stage against a plain version on what its predecessor kept."""
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    extra = [(10_001, None, None, None, 0), (10_002, "123 !!", "en", "src1", 6), (None, "the rest of that is an other", "en", None, 28)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema)).repartition(5)
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stage(spark, docs, sf_dir)
        docs = corpus_pipeline.settle(docs, "test-stage")
        after = docs.collect()
        kept = sorted(str(r.doc_id) for r in after)
        if name == "language":
            assert kept == sorted(str(r.doc_id) for r in before if r.text and any(map(str.isalpha, r.text)))
        elif name == "near_copies":
            groups = brute_components([(r.doc_id, r.text) for r in before], 5, 80)
            assert kept == sorted([str(i) for i, (_, c) in groups.items() if i == c] + ["None"])
        elif name == "benchmark":
            items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
            bad = {r[0] for r in brute_hits([(r.doc_id, r.text) for r in before], items, 13) if r[5]}
            assert kept == sorted(str(r.doc_id) for r in before if r.doc_id not in bad)
        elif name == "secrets":
            assert kept == sorted(str(r.doc_id) for r in before)
            assert not any("token = \"0" in r.text for r in after) and all(r.n_chars == len(r.text) for r in after)
        if name != "mixture":
            assert docs.columns == columns
    assert docs.where("taken <= 0").count() == 0
    totals = docs.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("most"))
    assert totals.where("abs(taken - target) > most").count() == 0


def test_pipeline_of_no_documents(spark, tmp_path, sf_dir):
    place = str(tmp_path)
    table(spark, sf_dir, "documents").limit(0).write.parquet(f"{place}/documents.parquet")
    table(spark, sf_dir, "benchmark").limit(0).write.parquet(f"{place}/benchmark.parquet")
    assert corpus_pipeline.run(spark, place).count() == 0


def test_pipeline_of_rows_that_share_ids_and_column_names(spark, tmp_path):
    """Rows of one doc_id are judged by their own text, and columns named like the added ones stay."""
    place = str(tmp_path)
    words = [f"{a}{b}" for a in ("stone", "river", "cloud", "field") for b in ("ing", "er", "s", "ed", "ly", "ful", "less", "ness")]
    rng = random.Random(5)
    text = [" ".join(rng.choices(words, k=60)) for _ in range(6)]
    near = text[0].replace(" ", "  ", 1)
    rows = [(1, text[0]), (1, text[1]), (1, text[0]), (1, near), (2, near), (3, text[2]), (3, text[3]), (None, text[3]), (None, text[4])]
    rows += [(4, ""), (4, None), (5, text[5]), (5, text[5])]
    docs = spark.createDataFrame([(*r, "en", "s", 1, "x", "y", "z", "w") for r in rows],
        "doc_id long, text string, lang string, source string, size int, target string, digest string, h string, taken string").repartition(4)
    kept = corpus_pipeline.drop_near_copies(spark, docs, place)
    assert kept.columns == docs.columns
    got = sorted((str(r.doc_id), str(r.text)) for r in kept.collect())
    first = [x for x in got if x[0] == "1" and x[1] in (text[0], near)]
    assert len(first) == 1
    rest = [("1", text[1]), ("3", text[2]), ("3", text[3]), ("None", text[3]), ("None", text[4]), ("4", ""), ("4", "None"), ("5", text[5])]
    assert got == sorted(first + rest)
    spark.createDataFrame([(9, text[3])], "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    clean = corpus_pipeline.drop_contaminated(spark, docs, place)
    assert clean.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in clean.collect()) == sorted((str(i), str(t)) for i, t in rows if t != text[3])
    mixed = corpus_pipeline.mix_by_source(spark, docs, place)
    assert mixed.columns == [*docs.columns, "size_", "source_size", "target_", "taken_"]
    row = mixed.where("doc_id = 2").first()
    assert (row["size"], row["target"], row["h"], row["taken"], row["size_"]) == (1, "x", "z", "w", 60)
