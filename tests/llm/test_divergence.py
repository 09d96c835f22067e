"""The source audit against a plain version, with colliding digests, nulls, empty tables and many sources."""

import random
import re
from collections import Counter, defaultdict

import pytest

from casebook.llm.divergence import audit_sources

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string"


def brute_audit(rows, least=10, top=10):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        whole = Counter()
        for g in counts:
            if g[0] == lang:
                whole.update(counts[g])

        def shares(n):
            total = sum(n[t] for t in kept)
            return {t: 1 + 10**9 * (n[t] + 2) // (total + 2 * len(kept)) for t in kept}

        q = shares(whole)
        p = {g[1]: shares(counts[g]) for g in counts if g[0] == lang}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for source in p:
            pair = [(sum(f(p[source][t], p[other][t]) for t in kept), other) for other in p if other != source]
            term = [(f(p[source][t], q[t]), t) for t in kept if counts[lang, source][t] and p[source][t] > q[t]]
            for part, found, most in (("pair", pair, len(pair)), ("term", term, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, source, part, item, value, i) for i, (value, item) in enumerate(found[:most], 1)]
    return sorted(out)


def audited(spark, rows, **settings):
    made = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA).repartition(4)
    return sorted(map(tuple, audit_sources(made, **settings).collect()))


def random_rows(seed, n, sources):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{'äß語'[i % 3] * (i % 4)}" for i in range(60)] + ["The", "THE", "the"]
    return [
        (
            rng.choice([None, "", "12 34 ..", " ".join(rng.choices(words, range(1, 64), k=rng.randint(1, 40)))]),
            rng.choice(["en", "en", "de", None, ""]),
            rng.choice(sources + [None, ""]),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("bits, held", [(64, 200_000), (3, 20), (1, 200_000), (64, 1)])
def test_equals_brute_force_whatever_the_digests(spark, bits, held):
    rows = random_rows(bits, 300, ["a", "b", "B", "ü"])
    assert audited(spark, rows, bits=bits, held=held, terms=held) == brute_audit(rows)


def test_names_are_counted_together_before_they_meet_the_kept_terms(spark, monkeypatch):
    """A common term has a row in every task; a semi join below the aggregation would hand on all of them."""
    from casebook.llm import divergence

    plans = {}

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return settle(df, name)

    settle = divergence.settle
    monkeypatch.setattr(divergence, "settle", noted)
    rows = [("common words in every row", "en", "ab"[i % 2]) for i in range(40)]
    assert audited(spark, rows) == brute_audit(rows)
    assert "Join Inner" in plans["audit-names"] and "LeftSemi" not in plans["audit-names"]


def test_ties_go_by_bytes_and_only_ten_ranks(spark):
    rows = [(" ".join(f"t{c}" for c in "zyxwvutsrqponmlk") + " é", "en", "a")] * 10 + [("other", "en", "b")] * 10
    found = audited(spark, rows)
    assert found == brute_audit(rows)
    assert [r[3] for r in found if r[1] == "a" and r[2] == "term"] == [f"t{c}" for c in "klmnopqrst"]


def test_groups_without_kept_terms(spark):
    rows = [("rare words", "en", "a"), (None, "en", "b"), ("", None, None), ("x", "de", "only")]
    assert audited(spark, rows) == brute_audit(rows) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_many_sources_of_one_language(spark):
    rng = random.Random(5)
    rows = [(" ".join(rng.choices("abcdefgh", k=5)), "en", f"s{i % 60}") for i in range(240)]
    assert audited(spark, rows) == brute_audit(rows)


def test_pairs_of_a_term_of_very_many_sources_are_worked_on_in_parts(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    from casebook.llm import divergence

    rng = np.random.default_rng(1)
    held = [[{"number": int(i), "p": int(rng.integers(1, 10**9)), "zero": 7} for i in rng.permutation(40)] for _ in range(3)]
    kind = pa.list_(pa.struct([("number", pa.int64()), ("p", pa.int64()), ("zero", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([pa.array([5] * 3), pa.array(held, kind)], names=["lang_key", "held"])

    def sums():
        out = Counter()
        for part in divergence._shared(iter([batch])):
            for _, g, h, value in zip(*(c.to_pylist() for c in part.columns)):
                out[g, h] += value
        return out

    whole = sums()
    monkeypatch.setattr(divergence, "PAIRS", 100)
    assert sums() == whole and len(whole) == 40 * 39 // 2


def test_long_text_empty_table_and_other_columns(spark):
    long = ("Alpha beta " * 150_000, "en", "a")
    rows = [long] * 2 + [("alpha", "en", "b")] * 9
    assert audited(spark, rows) == brute_audit(rows)
    made = spark.createDataFrame([(i, *r, 1, "x") for i, r in enumerate(rows)], SCHEMA + ", digest int, split string")
    assert sorted(map(tuple, audit_sources(made).collect())) == brute_audit(rows)
    assert audit_sources(made.limit(0)).collect() == []
