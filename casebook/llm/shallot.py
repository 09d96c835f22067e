"""Centroid clustering with Shallot's search: exact k-means in whole numbers that measures few distances.

Components become integers floor(scale * x), so sums, centroids and squared distances are exact and ties go to the
smaller cluster number. Every vector carries its nearest and second-nearest centroid, an upper bound of the distance to
the first and a lower bound of the distance to every other one:

1. After centroids moved, the bounds give way by how far. A vector whose upper bound stays below its lower bound, or
   below half the way from its centroid to the nearest other one, keeps its cluster without any measurement.
2. Otherwise both remembered centroids are measured, and the search starts from the closer one. Its neighbours are
   visited by rising distance from it; the ball that can hold a better centroid has the radius of the nearest plus the
   second-nearest distance found so far and shrinks as the second comes closer. What lies in it is measured in integers.

A round is one pass over a table that holds vectors and bounds; each task adds its clusters' sums to the same pass, and
the next round reads its predecessor's table, so a lost executor repeats a part of one round at most. The driver holds
k centroids. Vectors are worked on in blocks of bounded size.

Kept are vectors with exactly `dimension` components that are neither null nor non-finite and whose integers fit in 56
bits. Repeated rows count each; a null vec_id hashes as the empty text. Squared distances and their sums that do not
fit a long are null. No kept vectors give no rows; fewer than k give as many centroids. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import settle

#: Vectors worked on at a time.
BLOCK = 8192
#: Components below this keep every squared distance of at most 256 components within 63 bits.
SMALL = 1 << 26
#: Relative slack of bounds in floating point.
SLACK = 1e-9

_STATE = "vec_id long, vector binary, near int, second int, upper double, lower double, cluster int, members long, sums array<decimal(38,0)>"
_DONE = "vec_id long, cluster int, distance decimal(38,0)"


def integers(embeddings: DataFrame, dimension: int = 64, scale: int = 64) -> DataFrame:
    """vec_id and the kept vectors as packed little-endian 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            values = np.asarray(lists.flatten()).astype(np.float64).reshape(-1, dimension)
            with np.errstate(over="ignore", invalid="ignore"):
                scaled = np.floor(values * scale)
            whole = np.abs(scaled).max(axis=1, initial=0) < float(1 << 56)  # NaN and infinities fail as well
            packed = [row.tobytes() for row in scaled[whole].astype("<i8")]
            yield pa.RecordBatch.from_arrays([ids.filter(pa.array(whole)), pa.array(packed, pa.binary())], names=["vec_id", "vector"])

    vector = F.transform("embedding", lambda x: x.cast("double"))
    sized = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("embedding")).where(
        (F.size("embedding") == dimension) & ~F.exists("embedding", lambda x: x.isNull())
    )
    return sized.mapInArrow(run, "vec_id long, vector binary")


def unpacked(column: pa.Array) -> np.ndarray:
    """Vectors of a packed column; Python integers where 64 bits could not hold a squared distance."""
    rows = column.to_pylist()
    vectors = np.frombuffer(b"".join(rows), dtype="<i8").reshape(len(rows), -1).astype(np.int64)
    return vectors if np.abs(vectors).max(initial=0) < SMALL and vectors.shape[1] <= 256 else vectors.astype(object)


@dataclass(frozen=True)
class Centroids:
    """Integer centroids, their mutual distances and how far each one moved last."""

    points: list[list[int]]
    moved: list[float]

    def array(self) -> np.ndarray:
        points = np.array(self.points, dtype=object)
        small = max((abs(x) for row in self.points for x in row), default=0) < SMALL and len(self.points[0]) <= 256
        return points.astype(np.int64) if small else points


def squared(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows that belong together."""
    if vectors.dtype != points.dtype:
        vectors, points = vectors.astype(object), points.astype(object)
    return ((vectors - points) ** 2).sum(axis=1)


def _roots(values: np.ndarray) -> np.ndarray:
    return np.sqrt(values.astype(np.float64))


class Search:
    """What the vectors of one round share: neighbours of every centroid by rising distance."""

    def __init__(self, centroids: Centroids):
        self.points = centroids.array()
        k = len(self.points)
        self.apart = np.stack([_roots(squared(self.points, np.broadcast_to(c, self.points.shape))) for c in self.points])
        self.order = np.argsort(self.apart + np.diag(np.full(k, -1.0)), axis=1, kind="stable")[:, 1:]
        self.half = np.sort(self.apart + np.diag(np.full(k, np.inf)), axis=1)[:, 0] / 2
        self.moved = np.array(centroids.moved)
        rest = np.sort(self.moved)[::-1]
        #: The farthest that any centroid but the numbered one moved.
        self.others = np.where(self.moved == rest[0], rest[1] if k > 1 else 0.0, rest[0])
        self.measured = 0

    def assign(self, vectors: np.ndarray, near: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> None:
        """Bring the state of a block of vectors up to the centroids, in place."""
        if len(self.points) == 1:
            near[:], second[:], upper[:], lower[:] = 0, 0, np.inf, np.inf
            return
        upper += self.moved[near]
        lower -= self.others[near]
        open_ = np.flatnonzero(~(upper * (1 + SLACK) < np.maximum(lower * (1 - SLACK), self.half[near] * (1 - SLACK))))
        if len(open_):
            first, other, a, b = self._search(vectors[open_], near[open_], second[open_])
            near[open_], second[open_] = first, other
            upper[open_], lower[open_] = _roots(a), _roots(b)

    def _search(self, vectors: np.ndarray, one: np.ndarray, two: np.ndarray):
        """Nearest and second-nearest centroid of every vector with their squared distances."""
        a, b = squared(vectors, self.points[one]), squared(vectors, self.points[two])
        self.measured += 2 * len(vectors)
        swap = (b < a) | ((b == a) & (two < one))
        best, runner = np.where(swap, two, one), np.where(swap, one, two)
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        start = best.copy()
        from_start = _roots(a)
        for centre in np.unique(start):
            live = np.flatnonzero(start == centre)
            for at in self.order[centre]:
                # A better second lies within the second's distance of the vector, the vector within `from_start` of the centre.
                ball = (from_start[live] + _roots(b[live])) * (1 + SLACK)
                live = live[self.apart[centre, at] <= ball]
                if not len(live):
                    break
                seen = live[(runner[live] != at)]
                if not len(seen):
                    continue
                d = squared(vectors[seen], np.broadcast_to(self.points[at], (len(seen), vectors.shape[1])))
                self.measured += len(seen)
                first = (d < a[seen]) | ((d == a[seen]) & (at < best[seen]))
                later = ~first & ((d < b[seen]) | ((d == b[seen]) & (at < runner[seen])))
                up, mid = seen[first], seen[later]
                runner[up], b[up] = best[up], a[up]
                best[up], a[up] = at, d[first]
                runner[mid], b[mid] = at, d[later]
        return best, runner, a, b


def _round(centroids: Centroids):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        k, width = search.points.shape
        members, sums = np.zeros(k, dtype=np.int64), np.zeros((k, width), dtype=object)
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                vectors = unpacked(batch.column(1))
                near, second, upper, lower = (np.array(batch.column(i)) for i in range(2, 6))
                search.assign(vectors, near, second, upper, lower)
                for c in np.unique(near):
                    own = vectors[near == c]
                    members[c] += len(own)
                    sums[c] += own.sum(axis=0).astype(object)
                state = [batch.column(0), batch.column(1), *(pa.array(x) for x in (near, second, upper, lower))]
                yield _state_rows(state, batch.num_rows)
        full = np.flatnonzero(members)
        total = [[int(x) for x in sums[c]] for c in full]
        yield _state_rows([None] * 6 + [pa.array(full, pa.int32()), pa.array(members[full]), pa.array(total, _SUMS)], len(full))

    return run


_SUMS = pa.list_(pa.decimal128(38, 0))
_STATES = pa.schema(
    [("vec_id", pa.int64()), ("vector", pa.binary()), ("near", pa.int32()), ("second", pa.int32()), ("upper", pa.float64())]
    + [("lower", pa.float64()), ("cluster", pa.int32()), ("members", pa.int64()), ("sums", _SUMS)]
)


def _state_rows(columns: list, n: int) -> pa.RecordBatch:
    columns = columns + [None] * (len(_STATES) - len(columns))
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, f.type) if c is None else c.cast(f.type) for c, f in zip(columns, _STATES)], schema=_STATES
    )


def _last(centroids: Centroids):
    """Cluster and exact distance of every vector; only the own centroid is measured where the bounds decide."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                vectors = unpacked(batch.column(1))
                near, second, upper, lower = (np.array(batch.column(i)) for i in range(2, 6))
                search.assign(vectors, near, second, upper, lower)
                distance = [int(x) for x in squared(vectors, search.points[near])]
                columns = [batch.column(0), pa.array(near, pa.int32()), pa.array(distance, pa.decimal128(38, 0))]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return run


def first_centroids(vectors: DataFrame, k: int) -> list[list[int]]:
    """The vectors with the smallest SHA-256 of `1:<vec_id>`, in the order of the hashes; k rows reach the driver."""
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("key"), "vector").orderBy("key", "vector").limit(k).collect()
    return [np.frombuffer(r.vector, dtype="<i8").tolist() for r in rows]


def moved_centroids(state: DataFrame, before: Centroids) -> Centroids:
    """Componentwise floor of the means; a cluster without vectors keeps its centroid. One row a component is collected."""
    parts = state.where("cluster is not null").select("cluster", "members", F.posexplode("sums").alias("at", "part"))
    summed = parts.groupBy("cluster", "at").agg(F.sum("members").alias("members"), F.sum("part").alias("total"))
    points = [list(p) for p in before.points]
    for r in summed.collect():
        points[r.cluster][r.at] = int(r.total) // r.members
    way = [sum((x - y) ** 2 for x, y in zip(new, old)) for new, old in zip(points, before.points)]
    return Centroids(points, [float(x) ** 0.5 * (1 + SLACK) for x in way])


def cluster_vectors(embeddings: DataFrame, k: int = 16, rounds: int = 3, dimension: int = 64, scale: int = 64) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 and centroid of every kept vector (see the module)."""
    spark = embeddings.sparkSession
    vectors = settle(integers(embeddings, dimension, scale), "shallot-vectors")
    points = first_centroids(vectors, k)
    if not points:
        return spark.createDataFrame([], _RESULT)
    centroids = Centroids(points, [0.0] * len(points))
    start = [F.lit(0).alias("near"), F.lit(min(1, len(points) - 1)).alias("second")]
    bounds = [F.lit(float("inf")).alias("upper"), F.lit(0.0).alias("lower")]
    state = vectors.select("vec_id", "vector", *start, *bounds)
    for _ in range(rounds):
        state = settle(state.mapInArrow(_round(centroids), _STATE), "shallot-round")
        centroids = moved_centroids(state, centroids)
        state = state.where("cluster is null").select("vec_id", "vector", "near", "second", "upper", "lower")
    placed = settle(state.mapInArrow(_last(centroids), _DONE), "shallot-placed")
    inertia = {r.cluster: int(r.total) for r in placed.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    whole = sum(inertia.values())
    told = [
        (c, _long(total), _long(whole), hashlib.sha256(",".join(map(str, centroids.points[c])).encode()).hexdigest(), centroids.points[c])
        for c, total in inertia.items()
    ]
    names = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<long>"
    # One row a cluster: k is a parameter, so this side is small by construction.
    named = placed.join(F.broadcast(spark.createDataFrame(told, names)), "cluster")
    return named.select(
        "vec_id", "cluster", F.col("distance").try_cast("long").alias("distance"),
        "cluster_inertia", "inertia", "centroid_sha256", "centroid",
    )


_RESULT = (
    "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<long>"
)


def _long(value: int) -> int | None:
    return value if value < 1 << 63 else None


def _oracle(k: int, rounds: int) -> str:
    """The same by measuring every vector against every centroid in every round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS (
    SELECT row_no, any_value(vec_id) AS vec_id, any_value(v) AS v, min(d * {k} + c) % {k} AS c, min(d * {k} + c) // {k} AS d
    FROM (
        SELECT kept.row_no, kept.vec_id, kept.v, c{r}.c,
            list_sum(list_transform(list_zip(kept.v, c{r}.v), lambda z: ((z[1] - z[2]) * (z[1] - z[2]))::HUGEINT)) AS d
        FROM kept, c{r}
    ) GROUP BY row_no
)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS (
    SELECT c{r}.c, coalesce(m.v, c{r}.v) AS v
    FROM c{r} LEFT JOIN (
        SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v
        FROM (
            SELECT c, i, sum(x) AS s, count(*) AS n
            FROM (SELECT c, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM a{r}) GROUP BY c, i
        ) GROUP BY c
    ) m ON m.c = c{r}.c
)""")
    return f"""
WITH kept AS (
    SELECT vec_id, row_number() OVER () AS row_no, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
c0 AS (
    SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, v
    FROM kept ORDER BY sha256('1:' || vec_id) LIMIT {k}
),
{", ".join(steps)}
SELECT vec_id, a.c::INT AS cluster, d::BIGINT AS distance, sum(d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia,
    sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} ON c{rounds}.c = a.c
"""


ORACLE = _oracle(16, 3)
