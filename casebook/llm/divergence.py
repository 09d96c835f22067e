"""Source divergence audit: how far the words of every source depart from those of its language.

Strings are materialised late:

1. Tasks count terms per (lang, source) in memory of bounded size and write, per flush, a row of fixed width for each
   (group, term): the digests of language, group and term, occurrences and documents; and once per term its text.
2. Shuffles of counts move those fixed-width rows. What enough documents of a language hold is gathered into one row a
   (language, term) with the counts of its sources.
3. The smallest and the largest string of each digest show a collision where they differ. Only the rows of such digests
   look up which of the flush's strings they mean and are counted again by string (`split`), so results are exact
   whatever the digests. Digests of languages and sources are salted until they differ.
4. Divergences are whole numbers. Two sources of a language are compared over all kept terms without visiting terms
   that both lack: a histogram of each source's values against the other's value of an absent term, corrected by the
   terms both hold, which one row a term brings together.
5. Only terms that can still be among the best of their group meet their text again.

Null text, lang and source count as ''. Every row counts as a document, repeated ids too. Sources and terms in ties are
ordered by their bytes. No documents give no rows. Other columns are ignored. Per term, as many values meet in one row
as a language has sources; every pair of sources of a language is a row of the result.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm.common import pieces, settle, word_hashes

#: Distinct terms, and distinct (group, term), that a task holds before it writes them.
TERMS, HELD = 300_000, 1_000_000
#: Pairs of values that are worked on at a time.
PAIRS = 1 << 20
#: Rows handed on at a time.
ROWS = 50_000

_TALLIES = pa.schema(
    [(c, pa.int64()) for c in ("flush", "lang_key", "group_key", "digest")]
    + [("twin", pa.int32()), ("n", pa.int64()), ("docs", pa.int64()), ("term", pa.binary())]
)
_TALLY = "flush long, lang_key long, group_key long, digest long, twin int, n long, docs long, term binary"
_SHARED = pa.schema([("lang_key", pa.int64()), ("g", pa.int64()), ("h", pa.int64()), ("value", pa.int64())])


def _folded(byte: int) -> int:
    if 65 <= byte <= 90:
        return byte + 32
    return byte if 97 <= byte <= 122 or byte >= 128 else 32


#: Letters of ASCII in lower case, every byte beyond ASCII as it is, all else a space.
FOLD = bytes(map(_folded, range(256)))


def _summed(codes: list[np.ndarray], sums: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct codes and the sums of the numbers that belong to each."""
    found, which = np.unique(np.concatenate(codes), return_inverse=True)
    return found, [np.bincount(which, np.concatenate(x), len(found)).astype(np.int64) for x in zip(*sums)]


class Tally:
    """Counts of (group, term) of one task, as sorted codes: number of the group, number of the term."""

    def __init__(self, bits: int, terms: int, held: int):
        self.bits, self.terms, self.most = bits, terms, held
        self.flush = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        self._begin()

    def _begin(self) -> None:
        self.numbers: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
        self.groups: dict[tuple[int, int], int] = {}
        self.codes: list[np.ndarray] = []
        self.sums: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.before = 0

    def add(self, group: tuple[int, int], text: bytes) -> bool:
        """Count a document; whether it is time to flush."""
        number = self.groups.setdefault(group, len(self.groups))
        own: tuple[np.ndarray, np.ndarray] | None = None
        for piece in pieces(text.translate(FOLD)):
            words = piece.split()
            found, n = np.unique(np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)), return_counts=True)
            if own is not None:
                found, (n,) = _summed([own[0], found], [(own[1],), (n,)])
            own = found, n
        if own is None:
            return False
        self.codes.append(own[0] | number << 32)
        self.sums.append((own[1], np.ones(len(own[1]), np.int64)))
        self.size += len(own[0])
        if self.size >= 2 * max(self.before, self.most // 2):
            self._compact()
        return self.size >= self.most or len(self.numbers) >= self.terms

    def _compact(self) -> None:
        codes, sums = _summed(self.codes, self.sums)
        self.codes, self.sums, self.size = [codes], [tuple(sums)], len(codes)
        self.before = self.size

    def rows(self) -> Iterator[pa.RecordBatch]:
        """All that was counted, and the texts of the terms; counting begins anew."""
        if self.codes:
            self._compact()
            codes, (n, docs) = self.codes[0], self.sums[0]
            texts = list(self.numbers)
            digest = next(word_hashes([b" ".join(texts)])) >> np.uint64(64 - self.bits)
            digest = digest.view(np.int64)
            order = np.argsort(digest, kind="stable")
            head = np.maximum.accumulate(np.where(np.diff(digest[order], prepend=~digest[order[:1]]) != 0, np.arange(len(order)), 0))
            twin = np.empty(len(order), np.int32)
            twin[order] = np.arange(len(order)) - head
            keys = np.array(list(self.groups), dtype=np.int64).reshape(-1, 2)
            for at in range(0, len(codes), ROWS):
                group, term = codes[at : at + ROWS] >> 32, codes[at : at + ROWS] & 0xFFFFFFFF
                yield self._batch(
                    lang_key=keys[group, 0], group_key=keys[group, 1], digest=digest[term], twin=twin[term],
                    n=n[at : at + ROWS], docs=docs[at : at + ROWS],
                )
            for at in range(0, len(texts), ROWS):
                yield self._batch(digest=digest[at : at + ROWS], twin=twin[at : at + ROWS], term=texts[at : at + ROWS])
        self.flush += 1
        self._begin()

    def _batch(self, **columns) -> pa.RecordBatch:
        size = len(columns["digest"])
        columns["flush"] = np.full(size, self.flush)
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in _TALLIES], schema=_TALLIES
        )


def _tally(bits: int, terms: int, held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(bits, terms, held)
        for batch in batches:
            for lang, group, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if tally.add((lang, group), text.as_py()):
                    yield from tally.rows()
        yield from tally.rows()

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What pairs of sources that both hold a term differ from terms that only one of them holds."""
    for batch in batches:
        langs = np.asarray(batch.column(0))
        lists = batch.column(1)
        flat, offsets = lists.flatten(), np.asarray(lists.offsets)
        offsets = offsets - offsets[0]
        number, p, zero = (np.asarray(flat.field(i)) for i in range(3))
        length = np.diff(offsets)
        for lang in np.unique(langs):
            own = np.flatnonzero(langs == lang)
            for size in np.unique(length[own]):
                rows = offsets[:-1][own[length[own] == size]]
                step, at_once = max(1, PAIRS // (size * size)), max(1, PAIRS // size)
                for at in range(0, len(rows), step):
                    cells = rows[at : at + step, None] + np.arange(size)
                    for first in range(0, size - 1, at_once):  # one turn, but for terms of very many sources
                        i, j = np.triu_indices(size, 1, size) if at_once >= size else _corner(first, at_once, size)
                        left, right = cells[:, i].ravel(), cells[:, j].ravel()
                        value = (
                            difference(p[left], p[right]) - difference(p[left], zero[right])
                            - difference(zero[left], p[right]) + difference(zero[left], zero[right])
                        )
                        low, high = np.minimum(number[left], number[right]), np.maximum(number[left], number[right])
                        order = np.lexsort((high, low))
                        low, high = low[order], high[order]
                        head = np.flatnonzero((np.diff(low, prepend=-1) != 0) | (np.diff(high, prepend=-1) != 0))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(head), lang), pa.int64()),
                                pa.array(low[head], pa.int64()),
                                pa.array(high[head], pa.int64()),
                                pa.array(np.add.reduceat(value[order], head), pa.int64()),
                            ],
                            schema=_SHARED,
                        )


def _corner(first: int, rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j below `size` with i in `rows` numbers from `first`."""
    i, j = np.meshgrid(np.arange(first, min(first + rows, size - 1)), np.arange(size), indexing="ij")
    return i[i < j], j[i < j]


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)) of whole numbers below 2^31."""
    return (p - q) ** 2 // (p + q)


def _difference(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _share(n: str, total: str = "total") -> Column:
    """p of a term: one and the share of its count, in billionths; exact at any count."""
    return F.expr(f"1L + (1000000000BD * cast({n} + 2 as decimal(20, 0))) div cast({total} + 2 * vocabulary as decimal(20, 0))")


def _seen_groups(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every (lang, source) with its keys, all different; and the texts with their keys."""
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    texts = documents.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")), text)
    seen = settle(texts.select("lang", "source").distinct(), "audit-seen")
    for salt in itertools.count():
        lang_key, group_key = F.xxhash64(F.lit(salt), "lang"), F.xxhash64(F.lit(salt), "lang", "source")
        same = (F.count_distinct("lang") == F.count_distinct(lang_key)) & (F.count("*") == F.count_distinct(group_key))
        if seen.agg(same).first()[0]:
            keys = lang_key.alias("lang_key"), group_key.alias("group_key")
            return seen.select("lang", "source", *keys), texts.select(*keys, "text")


def counted_terms(
    texts: DataFrame, least_docs: int = 10, bits: int = 64, terms: int = TERMS, held: int = HELD
) -> tuple[DataFrame, DataFrame]:
    """The kept terms of every language, and their names.

    First lang_key, digest, split, n_lang and the sources' counts (group_key, n); then digest, split, term. `bits`
    shortens the digests, `terms` and `held` the memory of a task; none changes a result.
    """
    tallies = settle(texts.mapInArrow(_tally(bits, terms, held), _TALLY), "audit-tallies")
    rows, names = tallies.where("n is not null"), tallies.where("n is null")
    no_split = F.lit(b"").alias("split")

    def held_by_sources(counts: DataFrame) -> DataFrame:
        own = counts.groupBy("lang_key", "group_key", "digest", "split").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        held = F.collect_list(F.struct("group_key", "n")).alias("held")
        whole = own.groupBy("lang_key", "digest", "split").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang"), held)
        return whole.where(F.col("docs") >= least_docs).drop("docs")

    kept = settle(held_by_sources(rows.select("*", no_split)), "audit-kept")
    ends = names.groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high"))
    # An inner join, because a semi join would be moved below the aggregation, where every task has rows of a common term.
    named = settle(ends.join(kept.select("digest").distinct(), "digest"), "audit-names")
    collided = named.where("low <> high").select("digest")
    named = named.where("low = high").select("digest", no_split, F.col("low").alias("term"))
    if not collided.isEmpty():
        meant = names.join(collided, "digest", "left_semi").select("flush", "digest", "twin", F.col("term").alias("split"))
        again = rows.join(collided, "digest", "left_semi").join(meant, ["flush", "digest", "twin"])
        apart = held_by_sources(again)
        kept = settle(kept.join(collided, "digest", "left_anti").unionByName(apart), "audit-kept-apart")
        named = named.union(meant.select("digest", "split", F.col("split").alias("term")).distinct())
    return kept, named


def _groups(seen: DataFrame, kept: DataFrame) -> DataFrame:
    """Every (lang, source): number in its language, kept words, terms of the language, own terms, p of an absent term."""
    counts = kept.select("lang_key", F.explode("held").alias("own")).select("lang_key", "own.*")
    own = counts.groupBy("group_key").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    langs = kept.groupBy("lang_key").agg(F.count("*").alias("vocabulary"), F.sum("n_lang").alias("total_lang"))
    by_name = Window.partitionBy("lang_key").orderBy("source")
    return (
        seen.join(own, "group_key", "left")
        .join(langs, "lang_key", "left")
        .na.fill(0, ["total", "kinds", "vocabulary", "total_lang"])
        .withColumn("number", F.row_number().over(by_name).cast("long"))
        .withColumn("zero", F.when(F.col("vocabulary") > 0, _share("0L")))
    )


def _valued(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """One row a (group, kept term that it holds) with p, q and what is known of the group."""
    counts = kept.select("lang_key", "digest", "split", "n_lang", F.explode("held").alias("own"))
    counts = counts.select("lang_key", "digest", "split", "n_lang", "own.*")
    known = groups.select("group_key", "number", "total", "total_lang", "vocabulary", "zero")
    return counts.join(known, "group_key").select(
        "lang_key", "group_key", "digest", "split", "number", "zero", _share("n").alias("p"), _share("n_lang", "total_lang").alias("q")
    )


def _best_terms(valued: DataFrame, groups: DataFrame, named: DataFrame, top: int) -> DataFrame:
    """Terms more usual in a source than in its language; text joins those that reach the value of the last rank."""
    better = valued.where("p > q").select("group_key", "digest", "split", _difference("p", "q").alias("value"))
    by_value = Window.partitionBy("group_key").orderBy(F.col("value").desc())
    near = better.withColumn("at", F.rank().over(by_value)).where(F.col("at") <= top)
    texts = near.join(named, ["digest", "split"]).select("group_key", F.col("term").cast("string").alias("item"), "value")
    best = Window.partitionBy("group_key").orderBy(F.col("value").desc(), "item")
    ranked = texts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(groups.select("group_key", "lang", "source"), "group_key")


def _pairs(valued: DataFrame, groups: DataFrame) -> DataFrame:
    """Every ordered pair of sources of a language with the sum of their differences over all its kept terms."""
    holders = valued.groupBy("lang_key", "digest", "split").agg(F.collect_list(F.struct("number", "p", "zero")).alias("held"))
    shared = (
        holders.where(F.size("held") > 1).select("lang_key", "held")
        .mapInArrow(_shared, "lang_key long, g long, h long, value long")
        .groupBy("lang_key", "g", "h").agg(F.sum("value").alias("value"))
    )
    others = groups.select("lang_key", F.col("number").alias("h"), F.col("zero").alias("absent"), F.col("kinds").alias("more"))
    steps = valued.groupBy("lang_key", F.col("number").alias("g"), "p").agg(F.count("*").alias("terms"))
    alone = steps.join(others, "lang_key").where("g <> h").select("lang_key", "g", "h", (F.col("terms") * _difference("p", "absent")).alias("value"))
    alone = alone.groupBy("lang_key", "g", "h").agg(F.sum("value").alias("value"))
    pairs = groups.select("lang_key", F.col("number").alias("g"), "zero", "kinds", "vocabulary").join(others, "lang_key").where("g <> h")
    neither = F.col("vocabulary") - F.col("kinds") - F.col("more")
    base = pairs.select("lang_key", "g", "h", F.coalesce(neither * _difference("zero", "absent"), F.lit(0)).alias("value"))
    one_way = base.union(shared).union(alone)
    back = shared.union(alone).select("lang_key", F.col("h").alias("g"), F.col("g").alias("h"), "value")
    total = one_way.union(back).groupBy("lang_key", "g", "h").agg(F.sum("value").alias("value"))
    left = groups.select("lang_key", F.col("number").alias("g"), "lang", "source")
    right = groups.select("lang_key", F.col("number").alias("h"), F.col("source").alias("item"))
    told = total.join(left, ["lang_key", "g"]).join(right, ["lang_key", "h"]).select("lang", "source", "item", "value")
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return told.withColumn("rank", F.row_number().over(best))


def audit_sources(
    documents: DataFrame, least_docs: int = 10, top: int = 10, bits: int = 64, terms: int = TERMS, held: int = HELD
) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank of every group (see the module)."""
    seen, texts = _seen_groups(documents)
    kept, named = counted_terms(texts, least_docs, bits, terms, held)
    groups = settle(_groups(seen, kept), "audit-groups")
    valued = settle(_valued(kept, groups), "audit-values")
    parts = {"pair": _pairs(valued, groups), "term": _best_terms(valued, groups, named, top)}
    told = [x.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, x in parts.items()]
    return told[0].union(told[1])


ORACLE = r"""
WITH docs AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS row_no,
        regexp_extract_all(
            translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'
        ) AS terms
    FROM documents
),
words AS (SELECT lang, source, row_no, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT row_no) >= 10),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counted AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
grid AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n
    FROM (SELECT DISTINCT lang, source FROM docs) g
    JOIN kept k ON g.lang = k.lang
    LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
shares AS (
    SELECT lang, source, term, n,
        1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p
    FROM grid JOIN sizes USING (lang)
),
whole AS (
    SELECT lang, term, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q
    FROM (SELECT lang, term, sum(n)::HUGEINT AS n FROM grid GROUP BY lang, term) JOIN sizes USING (lang)
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL
),
every_pair AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
    FROM (SELECT DISTINCT lang, source FROM docs) a
    JOIN (SELECT DISTINCT lang, source FROM docs) b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
),
every_term AS (
    SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value
    FROM shares JOIN whole USING (lang, term)
    WHERE n > 0 AND p > q
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM every_pair UNION ALL SELECT * FROM every_term)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""
