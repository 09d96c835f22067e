"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed 60-bit hash of its id. For a source, the documents under a hash threshold hold a number of
words that grows with the threshold, so any budget has a threshold and smaller budgets are nested in larger ones. Words
are summed by source and hash bucket; only the bucket in which a source's budget runs out is split again by the next bits
of the hash, until few hashes are left in it. Then a filter on the hash takes the documents; no table is sorted.

Targets: the sources, by code point and null last, weigh `weights`, repeating, and share `share_percent` of all words. No
target exceeds `most` times its source's size; what is cut off goes to the others by weight until none is above.
A source takes each of its documents floor(target / size) times, and once more those under its threshold; the threshold
is the one whose sum comes nearest to the rest (ties: the smaller), so a source misses its target by half of one
document at most (rows of one doc_id count as one document here).

Null texts have no words, a null source is a source, rows without doc_id share one hash. Sources without words take
nothing. One row per source passes through single-task windows; nothing else does. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm.common import settle

BITS = 60


def n_words(text: str) -> Column:
    """Runs of bytes other than white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hash_of(key: str) -> Column:
    """The first 60 bits of the md5 of a key as text."""
    digits = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), 1, BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share_percent: int = 150, most: int = 2) -> DataFrame:
    """(source, source_size) with the column `target`."""
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    capped = ranked.select(
        "source", "source_size", "rank", weight.cast("long").alias("w"), (F.col("source_size") * most).alias("cap")
    )
    by_need = Window.orderBy(F.col("cap") / F.col("w"), "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    summed = capped.select(
        "*",
        (F.sum("cap").over(by_need) - F.col("cap")).alias("cap_before"),
        (F.sum("w").over(everything) - F.sum("w").over(by_need) + F.col("w")).alias("w_left"),
        (F.sum("source_size").over(everything) * share_percent).alias("budget"),
    )
    full = summed.withColumn(
        "full", (F.col("budget") - 100 * F.col("cap_before")) * F.col("w") >= 100 * F.col("cap") * F.col("w_left")
    )
    left = F.col("budget") - 100 * F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0))
    weights_left = F.coalesce(F.sum(F.when(~F.col("full"), F.col("w"))).over(everything), F.lit(0))
    shared = (F.col("w") * left).cast("double") / (100 * weights_left).cast("double")
    return full.select(
        "source", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(shared).alias("target")
    )


def thresholds(sized: DataFrame, targets: DataFrame, bits: int = 10, few: int = 1000) -> DataFrame:
    """(source, source_size, target, epochs, last): what a source takes, for the columns source, size and h of `sized`.

    `bits` of the hash split a bucket; a bucket with at most `few` hashes is looked at hash by hash.
    """
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    bounds = targets.select("*", epochs.cast("long").alias("epochs")).select(
        "*",
        (F.col("target") - F.col("epochs") * F.col("source_size")).alias("rest"),
        F.lit(0).cast("long").alias("start"),
        F.lit(0).cast("long").alias("below"),
    )
    bounds = settle(bounds, "mix-bounds")
    inside = sized.select("source", "size", "h")
    left = BITS
    while True:
        left -= bits
        step = F.shiftright("h", left)
        counts = inside.groupBy("source", step.alias("bucket")).agg(
            F.sum("size").alias("words"), F.count("*").alias("rows")
        )
        of = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        found = (
            counts.withColumnRenamed("source", "s")
            .join(bounds.select("source", "rest", "below"), F.col("s").eqNullSafe(F.col("source")))
            .withColumn("upto", F.col("below") + F.sum("words").over(of))
            .where(F.col("upto") >= F.col("rest"))
            .groupBy("source")
            .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"), "rows")).alias("hit"))
        )
        kept = bounds.withColumnRenamed("source", "s").join(found, F.col("s").eqNullSafe(F.col("source")))
        bounds = settle(
            kept.select(
                "source", "source_size", "target", "epochs", "rest",
                F.shiftleft(F.col("hit.bucket"), left).alias("start"),
                F.col("hit.before").alias("below"), F.col("hit.rows").alias("rows"),
            ),
            "mix-bounds",
        )
        ends = bounds.select(F.col("source").alias("s"), "start")
        within = (F.col("s").eqNullSafe(F.col("source"))) & (F.col("start") == F.shiftleft(step, left))
        inside = sized.select("source", "size", "h").join(ends, within).select("source", "size", "h")
        if left < bits or (bounds.agg(F.max("rows")).first()[0] or 0) <= few:
            break
    of = Window.partitionBy("source").orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    single = inside.groupBy("source", "h").agg(F.sum("size").alias("words"))
    steps = single.select(F.col("source").alias("s"), "h", F.sum("words").over(of).alias("words"))
    reach = bounds.join(steps, F.col("s").eqNullSafe(F.col("source"))).select(
        "source", "h", "rest", (F.col("below") + F.col("words")).alias("sum")
    )
    none = bounds.select("source", (F.col("start") - 1).alias("h"), "rest", F.col("below").alias("sum"))
    nearest = (
        reach.union(none)
        .groupBy("source")
        .agg(F.min(F.struct(F.abs(F.col("sum") - F.col("rest")).alias("off"), "sum", "h")).alias("best"))
        .select(F.col("source").alias("s"), F.col("best.h").alias("last"))
    )
    out = bounds.join(nearest, F.col("s").eqNullSafe(F.col("source")))
    return settle(out.select("source", "source_size", "target", "epochs", "last"), "mix-thresholds")


def mix_rows(sized: DataFrame, limits: DataFrame) -> DataFrame:
    """`sized` (with source, size, h) joined by source with source_size, target and the words `taken`."""
    limits = limits.withColumnRenamed("source", "s")
    times = F.col("epochs") + F.when(F.col("h") <= F.col("last"), 1).otherwise(0)
    joined = sized.join(limits, F.col("s").eqNullSafe(F.col("source")))
    return joined.withColumn("taken", F.col("size") * times).drop("s", "epochs", "last", "h")


def mix_sources(documents: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share_percent: int = 150, most: int = 2) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document (see the module)."""
    sized = settle(
        documents.select("doc_id", "source", n_words("text").alias("size"), hash_of("doc_id").alias("h")), "mix-sizes"
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    limits = thresholds(sized, source_targets(sources, weights, share_percent, most))
    return mix_rows(sized, limits).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
    cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 15) as bigint) as h from documents),
ranked as (
  select source, sum(size) as source_size, row_number() over (order by source nulls last) - 1 as r from sized group by source),
weighed as (select *, [3, 1, 2][r % 3 + 1] as w, 2 * source_size as cap from ranked),
need as (
  select *, sum(cap) over n - cap as cap_before, sum(w) over () - sum(w) over n + w as w_left,
    150 * sum(source_size) over () as budget
  from weighed window n as (order by cap / w, r rows between unbounded preceding and current row)),
marked as (select *, (budget - 100 * cap_before) * w >= 100 * cap * w_left as full_up from need),
aimed as (
  select source, source_size, case when full_up then cast(cap as double) else
    cast(w * (budget - 100 * coalesce(sum(cap) filter (full_up) over (), 0)) as double)
    / cast(100 * sum(w) filter (not full_up) over () as double) end as target
  from marked),
budgets as (
  select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as epochs from aimed),
reach as (
  select source, h, sum(sum(size)) over (partition by source order by h) as upto from sized group by source, h
  union all select source, -1, 0 from budgets),
limits as (
  select b.source, source_size, target, epochs,
    arg_min(h, row(abs(upto - (target - epochs * source_size)), upto, h)) as last_h
  from budgets b join reach r on b.source is not distinct from r.source group by all)
select doc_id, cast(size as bigint) as size, cast(source_size as bigint) as source_size, target,
  cast(size * (epochs + case when h <= last_h then 1 else 0 end) as bigint) as taken
from sized s join limits l on s.source is not distinct from l.source
"""
