"""Embedding near-duplicates by a pivot-permutation index.

Vectors that are equal under one label are one class from the start. Every class is described by its `near` nearest
reference points (pivots), nearest first; it stands in the inverted list of each of them, list by label. Two classes are
candidates when their descriptions share at least `shared` pivots, and are compared in the list of the smallest pivot they
share, so once. Lists are dealt into tiles of `block` by `block` classes, so no task holds a whole list; a tile counts
shared pivots by a product of incidence matrices and verifies candidates by cosine in double precision.

Where pivots crowd, a few of many almost equally near ones say little. A class is crowded when all pivots of its
description lie within twice the angle of a link (and there are at least `near` of them); every pair with a crowded class
is compared exactly, in cells. Centres are pivots picked one by one, none within that angle of another; a crowded class
lives in the cell of its nearest centre and every class visits each cell in which a link of it can live (the distance to
the plane between two centres and the radius of a cell bound that, so no link is lost). Cells are lists too, dealt into
tiles; a pair of two crowded classes belongs to the smaller of their cells. The index holds the classes that are not
crowded. All pairs of a crowd are compared: that many comparisons are what counting its links takes.

A tile returns each class's number of links and a spanning forest of them, not all pairs. The pivots are the vectors with
the smallest hash of their id, `pivots` of them or, by default, twice the square root of the number of classes, between 64
and 2,048: a bounded sample of what is indexed, while every vector is indexed.

Rows without label, vector or vec_id, and vectors that are zero or hold null, infinite or undefined components, link with
nothing. Vectors of other lengths than the most common first one are compared among their length only (the length is part
of the label). Rows that repeat vec_id, label and vector count once and are returned once each. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import components, settle

_NO_CELL = (1 << 31) - 1  # the cell of a class that is not crowded
_SLACK = 1e-7  # on bounds, for rounding


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, near: int) -> np.ndarray:
    """Numbers of the nearest pivots of unit vectors, nearest first (ties: the smaller number)."""
    return np.argsort(-np.round(vectors @ pivots.T, 12), axis=1, kind="stable")[:, :near]


def centres_of(pivots: np.ndarray, apart: float) -> np.ndarray:
    """Numbers of pivots picked in order, none of which has a cosine of `apart` or more with another."""
    free, out = np.ones(len(pivots), dtype=bool), []
    for i in range(len(pivots)):
        if free[i]:
            out.append(i)
            free &= pivots @ pivots[i] < apart
    return np.array(out, dtype=np.int64)


def cells_to_visit(v: np.ndarray, centres: np.ndarray, radius: np.ndarray, least: float) -> np.ndarray:
    """Places of the centres in whose cells (largest angle `radius`, negative when empty) a link of a unit vector can live."""
    cosine = centres @ v
    home = int(np.argmax(cosine))
    apart = np.linalg.norm(centres - centres[home], axis=1)
    beyond = cosine[home] - cosine <= math.sqrt(max(0.0, 2 - 2 * least)) * apart + _SLACK
    within = np.arccos(np.clip(cosine, -1, 1)) <= radius + math.acos(min(1.0, least)) + _SLACK
    return np.flatnonzero((radius >= 0) & beyond & within)


def link_vectors(
    left: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray],
    right: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None,
    pivot: int, shared: int, least: float,
) -> np.ndarray:
    """Matrix of links between two blocks of (vectors, norms, incidence, cell), or inside one, that belong to a list.

    The list is a pivot's or, for negative numbers, the cell of the centre -1 - pivot.
    """
    other = left if right is None else right
    if pivot < 0:
        links = np.minimum.outer(left[3], other[3]) == -1 - pivot
    else:
        links = (left[2] @ other[2].T >= shared) & (left[2][:, :pivot] @ other[2][:, :pivot].T == 0)
    links &= (left[0] @ other[0].T) / np.outer(left[1], other[1]) >= least
    return np.triu(links, 1) if right is None else links


def forest(links: np.ndarray, inside: bool) -> list[tuple[int, int]]:
    """Pairs (row, column) that connect what the links connect; columns count on from the rows unless `inside`."""
    label = np.arange(links.shape[1] if inside else sum(links.shape))
    shift = 0 if inside else links.shape[0]
    out = []
    for i in np.flatnonzero(links.any(axis=1)):
        for j in np.flatnonzero(links[i]) + shift:
            if label[j] != label[i]:
                out.append((int(i), int(j)))
                label[label == label[j]] = label[i]
    return out


def _describe(shared_pivots, near: int, crowd: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length = shared_pivots.value
        for batch in batches:
            vectors = [np.array(v, dtype=np.float64) for v in batch.column(2).to_pylist()]
            found, cells, angles = [], [], []
            for v in vectors:
                pivots, centres = by_length[len(v)]
                unit = v / np.linalg.norm(v)
                nearest = nearest_pivots(unit[None, :], pivots, near)[0]
                found.append(nearest.tolist())
                crowded = len(nearest) == near and pivots[nearest[-1]] @ unit >= crowd
                cosine = pivots[centres] @ unit
                cells.append(int(centres[np.argmax(cosine)]) if crowded else _NO_CELL)
                angles.append(math.acos(min(1.0, max(-1.0, float(cosine.max())))))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), batch.column(3), pa.array([v.tobytes() for v in vectors], pa.binary()),
                    pa.array(found, pa.list_(pa.int32())), pa.array(cells, pa.int32()), pa.array(angles, pa.float64()),
                ],
                names=["rep", "label", "copies", "vector", "nearest", "cell", "angle"],
            )

    return run


def _lists(shared_cells, least: float):
    """Adds the lists in which a class stands: its pivots (unless crowded), and the cells it lives in or visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length = shared_cells.value
        for batch in batches:
            lists = []
            for data, near, cell in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(5).to_pylist()):
                own = list(near) if cell == _NO_CELL else []
                v = np.frombuffer(data)
                if len(v) in by_length:
                    names, centres, radius = by_length[len(v)]
                    own += (-1 - names[cells_to_visit(v / np.linalg.norm(v), centres, radius, least)]).tolist()
                lists.append(own)
            kept = [batch.column(i) for i in range(6)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(lists, pa.list_(pa.int32()))], names=["rep", "label", "copies", "vector", "nearest", "cell", "lists"]
            )

    return run


def _tile(pivots: int, shared: int, least: float):
    def run(key: tuple[pa.Scalar, ...], whole: pa.Table) -> pa.Table:
        pivot, low, high = key[2].as_py(), key[3].as_py(), key[4].as_py()
        block = whole["block"].to_numpy()
        rep, copies = whole["rep"].to_numpy(), whole["copies"].to_numpy()
        vectors = np.stack([np.frombuffer(v) for v in whole["vector"].to_pylist()])
        cell = whole["cell"].to_numpy()
        inside = np.zeros((len(rep), pivots if pivot >= 0 else 0), dtype=np.float32)
        if pivot >= 0:
            for i, near in enumerate(whole["nearest"].to_pylist()):
                inside[i, near] = 1
        norms = np.linalg.norm(vectors, axis=1)
        rows = np.flatnonzero(block == low)
        columns = rows if low == high else np.flatnonzero(block == high)
        side = lambda at: (vectors[at], norms[at], inside[at], cell[at])
        links = link_vectors(side(rows), None if low == high else side(columns), pivot, shared, least)
        many = links.astype(np.int64)
        if low == high:
            counts = (many + many.T) @ copies[rows]
            names = rep[rows]
        else:
            counts = np.concatenate([many @ copies[columns], copies[rows] @ many])
            names = np.concatenate([rep[rows], rep[columns]])
        pairs = forest(links, low == high)
        at = np.flatnonzero(counts)
        a = [*names[at].tolist(), *(int(names[i]) for i, _ in pairs)]
        b = [*[None] * len(at), *(int(names[j]) for _, j in pairs)]
        n = [*counts[at].tolist(), *[0] * len(pairs)]
        return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["a", "b", "links"])

    return run


def near_vectors(
    embeddings: DataFrame, least: float = 0.93, near: int = 16, shared: int = 2, pivots: int | None = None, block: int = 1000
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector (see the module)."""
    spark = embeddings.sparkSession
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "label"
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    length = F.size("embedding")
    mark = F.when(usable, F.xxhash64("label", "embedding"))
    marked = rows.select("vec_id", "label", "embedding", mark.alias("mark"))
    once = marked.where("mark is not null").dropDuplicates(["vec_id", "mark"])
    classes = settle(
        once.groupBy("mark", F.col("label").cast("string").alias("label"), "embedding").agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("copies")
        ),
        "vector-classes",
    )
    n = classes.count()
    most = pivots or min(2048, max(64, 2 * math.isqrt(n)))
    order = F.xxhash64("rep", F.lit(7))
    crowd = max(-1.0, 2 * least * least - 1)  # the cosine of twice the angle of a link
    points: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for size in sorted(r[0] for r in classes.select(F.size("embedding")).distinct().collect()):
        chosen = classes.where(F.size("embedding") == size).orderBy(order, "rep").limit(most).select("embedding").collect()
        own = np.array([r[0] for r in chosen], dtype=np.float64)
        own /= np.linalg.norm(own, axis=1, keepdims=True)
        points[size] = own, centres_of(own, crowd)
    shared_points = spark.sparkContext.broadcast(points)
    described = settle(
        classes.select("rep", "label", "embedding", "copies").mapInArrow(
            _describe(shared_points, near, crowd),
            "rep long, label string, copies long, vector binary, nearest array<int>, cell int, angle double",
        ),
        "vector-prefixes",
    )
    radii: dict[int, dict[int, float]] = {}  # at most one row for each centre
    for r in described.where(F.col("cell") != _NO_CELL).groupBy(F.length("vector"), "cell").agg(F.max("angle")).collect():
        radii.setdefault(r[0] // 8, {})[r[1]] = r[2]
    cells = {
        size: (points[size][1], points[size][0][points[size][1]], np.array([radii[size].get(int(c), -1.0) for c in points[size][1]]))
        for size in radii
    }
    listed = settle(
        described.drop("angle").mapInArrow(
            _lists(spark.sparkContext.broadcast(cells), least),
            "rep long, label string, copies long, vector binary, nearest array<int>, cell int, lists array<int>",
        ),
        "vector-lists",
    )
    entries = listed.select("label", "cell", F.length("vector").alias("length"), F.explode("lists").alias("pivot"))
    lists = entries.groupBy("label", "length", "pivot").agg(
        F.ceil(F.count("*") / block).alias("blocks"), F.max(F.col("cell") == -1 - F.col("pivot")).alias("lived_in")
    )
    lists = lists.where("pivot >= 0 or lived_in").drop("lived_in")
    posted = listed.select(
        "rep", "label", "copies", "vector", "nearest", "cell", F.length("vector").alias("length"), F.explode("lists").alias("pivot")
    )
    placed = posted.join(lists, ["label", "length", "pivot"]).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    dealt = placed.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)"))).select(
        "label", "length", "pivot", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "rep", "copies", "vector", "nearest", "cell",
    )
    tiles = dealt.groupBy("label", "length", "pivot", "low", "high").applyInArrow(
        _tile(most, shared, least), "a long, b long, links long"
    )
    found = settle(tiles, "vector-links")
    named = settle(components(found.where("b is not null").select("a", "b"), "vector-ties"), "vector-components")
    counts = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    result = settle(
        classes.select("mark", F.col("label").alias("l"), F.col("embedding").alias("e"), "rep", "copies")
        .join(counts, "rep", "left")
        .join(named.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            F.col("mark").alias("m"), "l", "e", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "rep").alias("component"),
        ),
        "vector-results",
    )
    same = (F.col("mark") == F.col("m")) & (F.col("label").cast("string") == F.col("l")) & (F.col("embedding") == F.col("e"))
    return marked.join(result, same, "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        (F.col("vec_id") == F.coalesce("component", "vec_id")).alias("kept"),
    )
