"""Benchmark decontamination with an FM-index per training shard.

The windows of a benchmark are its runs of `window` words; an item with fewer words, but not none, is one window. The
benchmark is taken in blocks of about `block_words` words; one block at a time is sent to all tasks.

A task gathers documents into shards. A shard's text is the sequence of word numbers of its documents, without what no
window can cover: words that occur in no item, and runs of other words that are shorter than the shortest window. Over
this text it builds a suffix array (prefix doubling; run ends are told apart by place), the Burrows-Wheeler transform with
a wavelet matrix for ranks, and samples of suffix positions. All windows are searched backward at once; occurrences are
located by walking to the next sample. Occurrences cover words, and covered words merge into removal spans.

A document is contaminated when it has covered words and they are at least one in `ratio` of its words. Null texts have
no words; rows without doc_id are scanned like others; repeated rows each get a row. With several blocks, rows that share
doc_id and text are told apart from others by a digest of the text. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import lean, settle

#: Lower-cases A-Z and turns every byte that is no word byte into a blank.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lower-cased."""
    return text.translate(_WORD_BYTES).split() if text else []


class FMIndex:
    """Backward search in a sequence of positive numbers, parted by zeros and ending with one."""

    def __init__(self, text: np.ndarray, sample: int = 8):
        n = len(text)
        order, rank = self._sorted_suffixes(text)
        before = np.where(order > 0, text[order - 1], 0)
        self.bwt, self.n = before, n
        most = int(text.max()) if n else 0
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=most + 1))])
        self.levels, current = [], before
        for level in reversed(range(max(1, most.bit_length()))):
            bit = (current >> level) & 1
            self.levels.append((level, np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]), n - int(bit.sum())))
            current = np.concatenate([current[bit == 0], current[bit == 1]])
        place = np.arange(n)
        starts = np.concatenate([[True], text[:-1] == 0]) if n else np.zeros(0, bool)
        sampled = (place % sample == 0) | starts
        self.sampled = sampled[order]
        self.known = order[self.sampled]
        self.nth = np.cumsum(self.sampled) - 1

    @staticmethod
    def _sorted_suffixes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(text)
        ends = text == 0
        rank = np.where(ends, np.cumsum(ends) - 1, text.astype(np.int64) + int(ends.sum()))
        step = 1
        while True:
            follow = np.zeros(n, dtype=np.int64)
            follow[: n - step] = rank[step:] + 1 if step < n else 0
            key = rank * np.int64(rank.max() + 2 if n else 1) + follow
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            fresh = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])]) if n else np.zeros(0, np.int64)
            rank = np.empty(n, dtype=np.int64)
            rank[order] = fresh
            if not n or fresh[-1] == n - 1:
                return order, rank
            step *= 2

    def ranks(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in the transform before its place."""
        start, place = np.zeros_like(places), places
        for level, ones, zeros in self.levels:
            bit = ((symbols >> level) & 1).astype(bool)
            start = np.where(bit, zeros + ones[start], start - ones[start])
            place = np.where(bit, zeros + ones[place], place - ones[place])
        return place - start

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [from, to) of the suffixes that begin with each pattern (patterns of one length)."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.n, dtype=np.int64)
        for column in patterns.T[::-1]:
            inside = column < len(self.below) - 1
            symbol = np.where(inside, column, 0)
            low, high = (np.where(inside, self.below[symbol] + self.ranks(symbol, x), 0) for x in (low, high))
            high = np.maximum(low, high)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the text of the suffixes in the given rows."""
        out = np.zeros(len(rows), dtype=np.int64)
        left, at, steps = np.arange(len(rows)), rows, 0
        while len(left):
            hit = self.sampled[at]
            out[left[hit]] = self.known[self.nth[at[hit]]] + steps
            left, at = left[~hit], at[~hit]
            symbol = self.bwt[at]
            at = self.below[symbol] + self.ranks(symbol, at)
            steps += 1
        return out


class Benchmark:
    """Word numbers and distinct windows of one block of items."""

    def __init__(self, items: list[tuple[int, bytes]], window: int):
        self.numbers: dict[bytes, int] = {}
        found: dict[tuple[int, ...], list[int]] = {}
        for item, text in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            width = min(window, len(ids))
            for at in range(len(ids) - width + 1 if ids else 0):
                owners = found.setdefault(tuple(ids[at : at + width]), [])
                if not owners or owners[-1] != item:
                    owners.append(item)
        self.groups = []
        for width in sorted({len(w) for w in found}):
            same = [w for w in found if len(w) == width]
            self.groups.append((width, np.array(same, dtype=np.int64), [found[w] for w in same]))
        self.shortest = self.groups[0][0] if self.groups else 0


def covered(runs: list[np.ndarray], bench: Benchmark) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """For the concatenated runs, each followed by a zero: covered places, the run of each place, (run, item) hits."""
    lengths = np.array([len(r) + 1 for r in runs])
    text = np.zeros(int(lengths.sum()), dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    for start, run in zip(starts, runs):
        text[start : start + len(run)] = run
    owner = np.repeat(np.arange(len(runs)), lengths)
    index = FMIndex(text)
    change = np.zeros(len(text) + 1, dtype=np.int64)
    items: set[tuple[int, int]] = set()
    for width, patterns, owners in bench.groups:
        low, high = index.search(patterns)
        count = high - low
        which = np.repeat(np.arange(len(patterns)), count)
        rows = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        at = index.locate(rows)
        np.add.at(change, at, 1)
        np.add.at(change, at + width, -1)
        for run, pattern in np.unique(np.stack([owner[at], which], axis=1), axis=0).tolist():
            items.update((run, item) for item in owners[pattern])
    return np.cumsum(change[:-1]) > 0, owner, list(items)


def _scan(shared, shard_symbols: int, shard_documents: int, every: bool, digest: bool):
    """Rows doc_id, digest, n_words, spans (flat from, to) and items; only of documents with hits unless `every`."""

    def flush(docs: list, runs: list) -> pa.RecordBatch:
        spans: list[list[int]] = [[] for _ in docs]
        items: list[set] = [set() for _ in docs]
        if runs:
            cover, owner, hits = covered([r[2] for r in runs], shared.value)
            edges = np.flatnonzero(np.diff(np.concatenate([[False], cover, [False]]).astype(np.int8)))
            first = np.searchsorted(owner, np.arange(len(runs)))
            for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
                doc, offset, _ = runs[owner[start]]
                shift = offset - int(first[owner[start]])
                spans[doc] += [start + shift, end + shift]
            for run, item in hits:
                items[runs[run][0]].add(item)
        kept = [i for i in range(len(docs)) if every or spans[i]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([docs[i][0] for i in kept], pa.int64()),
                pa.array([docs[i][1] for i in kept], pa.string()),
                pa.array([docs[i][2] for i in kept], pa.int64()),
                pa.array([spans[i] for i in kept], pa.list_(pa.int64())),
                pa.array([sorted(items[i]) for i in kept], pa.list_(pa.int64())),
            ],
            names=["doc_id", "digest", "n_words", "spans", "items"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = shared.value
        number, shortest = bench.numbers.get, bench.shortest
        docs, runs, symbols = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                text = text.as_py()
                words = words_of(text)
                mark = hashlib.sha256(text or b"").hexdigest() if digest else ""
                docs.append((doc_id, mark, len(words)))
                if shortest and len(words) >= shortest:
                    ids = np.fromiter(map(number, words, repeat(0)), dtype=np.int64, count=len(words))
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], ids > 0, [0]])))
                    for start, end in zip(edges[::2], edges[1::2]):
                        if end - start >= shortest:
                            runs.append((len(docs) - 1, int(start), ids[start:end]))
                            symbols += int(end - start) + 1
                if symbols >= shard_symbols or len(docs) >= shard_documents:
                    yield flush(docs, runs)
                    docs, runs, symbols = [], [], 0
        if docs:
            yield flush(docs, runs)

    return run


_HITS = "doc_id long, digest string, n_words long, spans array<long>, items array<long>"


def _merged(window_spans: list[int]) -> list[int]:
    out: list[int] = []
    for start, end in sorted(zip(window_spans[::2], window_spans[1::2])):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def _judged(ratio: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for row in rows:
                spans = _merged(row["spans"])
                items = sorted(set(row["items"]))
                hit = sum(spans[1::2]) - sum(spans[::2])
                out.append(
                    {
                        "doc_id": row["doc_id"], "digest": row["digest"], "n_words": row["n_words"], "n_hit": hit, "n_items": len(items),
                        "items_sha256": hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest(),
                        "contaminated": hit > 0 and ratio * hit >= row["n_words"], "spans": spans, "items": items,
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema=_JUDGED)

    return run


def _both(first, then):
    """Two functions for mapInArrow as one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from then(first(batches))

    return run


_JUDGED = pa.schema(
    [("doc_id", pa.int64()), ("digest", pa.string()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string())]
    + [("contaminated", pa.bool_()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.int64()))]
)
JUDGED = (
    "doc_id long, digest string, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
    "spans array<long>, items array<long>"
)


def contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = 13, ratio: int = 20, block_words: int = 1_000_000,
    shard_symbols: int = 1_000_000, shard_documents: int = 5_000, digest: bool = False,
) -> DataFrame:
    """Words, covered words, items, verdict and removal spans (flat from, to in words) of every document.

    With `digest`, the column of that name holds the SHA-256 of the text (null: empty), to tell rows of one doc_id apart.
    """
    spark = documents.sparkSession
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    words = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(words // (6 * block_words)) + 1
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found, extra = None, None
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        shared = spark.sparkContext.broadcast(Benchmark([(r.item_id, r.text.encode()) for r in own], window))
        scan = lean(_scan(shared, shard_symbols, shard_documents, block == 0, digest or blocks > 1))
        if blocks == 1:  # nothing to merge: judged where it is found, by the same worker
            return rows.mapInArrow(_both(scan, _judged(ratio)), JUDGED)
        hits = rows.mapInArrow(scan, _HITS)
        if block == 0:
            found = hits
        else:
            hits = settle(hits, "benchmark-hits")
            extra = hits if extra is None else extra.union(hits)
    if extra is not None:
        merged = extra.groupBy("doc_id", "digest").agg(
            F.flatten(F.collect_list("spans")).alias("more_spans"), F.flatten(F.collect_list("items")).alias("more_items")
        )
        none = F.array().cast("array<long>")
        same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.digest") == F.col("b.digest"))
        found = found.alias("a").join(merged.alias("b"), same, "left").select(
            "a.doc_id", "a.digest", "a.n_words",
            F.concat("spans", F.coalesce("more_spans", none)).alias("spans"),
            F.concat("items", F.coalesce("more_items", none)).alias("items"),
        )
    return found.mapInArrow(_judged(ratio), JUDGED)
