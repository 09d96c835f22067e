"""What several of the operators share: table access, folds, word hashes, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.sources.durable import scratch, settle

#: Bytes hashed at a time; a longer text is cut between two words.
PIECE = 1 << 20

_BYTE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, text: int, rows: int = 4000, held: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most `rows` rows, which end with the row whose text (a column's number) fills `held` bytes."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        full = np.searchsorted(sizes, (sizes[at - 1] if at else 0) + held) + 1
        end = int(min(at + rows, batch.num_rows, full))
        yield batch.slice(at, end - at)
        at = end


def give_back() -> None:
    """Hand freed memory back to the system: a worker keeps it otherwise, also while it waits for its next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of some systems has none
    if trim is not None:
        trim(0)


def lean(run: Callable) -> Callable:
    """A function for mapInArrow that gives memory back after every batch it has read, and at its end."""

    def fed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            give_back()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(fed(batches))
        give_back()

    return whole


def sieve(hashes: DataFrame, per_key: int = 64, most: int = 1 << 27) -> Callable[[Column], Column]:
    """Tells of a 64-bit hash whether it may be one of `hashes` (a column of longs): of one that is it always says so.

    Each hash sets one of `per_key` bits for every hash there is, of at most `most` (16 MB) in all, which the driver
    sends to the tasks. So rows that a large table has to look up among few keys need not move unless they may be found.
    """
    (column,) = hashes.columns
    bits = min(most, 1 << max(10, (per_key * hashes.count()).bit_length()))
    at = hashes.select(F.col(column).bitwiseAND(bits - 1).alias("at"))
    words = at.groupBy(F.expr("shiftright(at, 6)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("set"))
    found = words.toArrow()
    whole = np.zeros(bits >> 6, dtype=np.int64)
    whole[found["word"].to_numpy()] = found["set"].to_numpy()
    sent = hashes.sparkSession.sparkContext.broadcast(whole)

    @F.pandas_udf("boolean")
    def listed(values: pd.Series) -> pd.Series:
        own = values.to_numpy(dtype=np.int64) & (bits - 1)
        return pd.Series((sent.value[own >> 6] >> (own & 63)) & 1 == 1)

    return listed


def fold_of(key: str, folds: int) -> Column:
    """crc32 of a key as text, modulo `folds`; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of the splitmix generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(str(base))
    if have is None or len(have) < n:
        steps = np.full(max(n, PIECE + 65), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[str(base)] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def _hashed(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of every run of bytes other than white space."""
    raw = np.frombuffer(blob, dtype=np.uint8)
    word = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=0, append=0))
    starts, ends = edge[::2], edge[1::2]
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * _power(_BASE, len(raw)), out=total[1:])
    inverse = pow(_BASE, -1, 1 << 64)
    return starts, mix((total[ends] - total[starts]) * _power(inverse, len(raw) + 1)[starts])


def word_hashes(blobs: list[bytes]) -> Iterator[np.ndarray]:
    """For each text one array with the 64-bit hash of each of its words `[^\\x20\\x09-\\x0D]+`, in order."""
    at = 0
    while at < len(blobs):
        end, size = at, 0
        while end < len(blobs) and (end == at or size + len(blobs[end]) < PIECE):
            size += len(blobs[end]) + 1
            end += 1
        if size <= PIECE:
            starts, hashes = _hashed(b" ".join(blobs[at:end]))
            bounds = np.cumsum([0, *(len(b) + 1 for b in blobs[at:end])])
            cuts = np.searchsorted(starts, bounds)
            for i in range(end - at):
                yield hashes[cuts[i] : cuts[i + 1]]
        else:
            yield np.concatenate([_hashed(piece)[1] for piece in pieces(blobs[at])])
        at = end


def pieces(blob: bytes, size: int = PIECE) -> Iterator[bytes]:
    """A long text cut at white space; a longer word stays whole."""
    at = 0
    while at < len(blob):
        end = min(len(blob), at + size)
        while end < len(blob) and not _SPACE[blob[end]]:
            end += 1
        yield blob[at:end]
        at = end


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) of an undirected graph of long ids; a component is named by its smallest node.

    Large-star and small-star steps by turns; every round is written to the shared folder. A hub's edges meet in joins
    that can be split, the smallest neighbour is found by an aggregation that combines before its shuffle.
    """
    with scratch(edges.sparkSession):  # every round but the last is removed
        links = settle(
            edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), name
        )
        before = None
        while True:
            both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
            far = links.join(least, "a").select(F.col("low").alias("a"), "b").where("a < b").distinct()
            up = far.groupBy("b").agg(F.min("a").alias("low"))
            near = far.join(up, "b").select(F.col("low").alias("a"), F.explode(F.array("a", "b")).alias("b"))
            links = settle(near.where("a < b").distinct(), name)
            now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
            if now == before:
                break
            before = now
        links = settle(links, name, lasting=True)
    heads = links.select(F.col("a").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("b").alias("node"), F.col("a").alias("component")).union(heads)
