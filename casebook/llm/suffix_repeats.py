"""Substring dedup with prefix-partitioned suffix trees.

A window is a run of `window` words. Suffixes are sampled so that every window holds one: of all runs of `prefix` words in
it, the leftmost with the smallest hash begins the suffix that stands for the window (its anchor). Equal windows have equal
anchors at the same place, so suffixes that begin with different prefixes never meet, and those whose prefix occurs once
are left out.

1. Every text gives the hashes of its anchors. Hashes are packed by range and paired up range by range; what repeats
   inside a batch is settled there, and one entry stands for it outside.
2. Texts with repeated anchors are read again. Each such anchor sends the words its windows span, keyed by its prefix.
3. Groups of suffixes with one prefix, many groups at a time up to `group_words` words, become a subtree: the ranks of all
   suffixes cut at depth 1, 2, 4, ... and finally `window` words name its nodes level by level (prefix doubling). A node at
   that depth with two leaves or more is a repeat; every window start below it is one.
4. A prefix that is frequent inside a batch is split by batch, so its group takes the batch's number as a longer prefix;
   distinct windows of split groups are matched once more by a 128-bit digest of their words.
5. Repeated windows next to each other merge into spans; a text's spans are cut out of its words.

Windows are judged on the input. Rows with equal word sequences share their result, also when they share a doc_id or have
none. Null texts have no words; words are bytes of the text between white space. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import mix, settle, word_hashes

_ROWS = 2000  # documents of a batch; must fit 16 bits
_LOW, _SHIFT = np.uint64(0xFFFF), np.uint64(16)
_STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)
_EMPTY = hashlib.sha256(b"").hexdigest()

_SIGNED = pa.schema(
    [("node", pa.int64()), ("doc_id", pa.int64()), ("mark", pa.int64()), ("n_words", pa.int64()), ("sha", pa.string())]
    + [("first", pa.bool_()), ("copied", pa.bool_()), ("part", pa.int32()), ("base", pa.int64()), ("keys", pa.binary())]
)
_SIGNED_DDL = (
    "node long, doc_id long, mark long, n_words long, sha string, first boolean, copied boolean, part int, base long, keys binary"
)


def anchors(words: np.ndarray, window: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text's word hashes: their hash, their word, and the first and last window start they stand for."""
    n = len(words) - window + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none.view(np.uint64), none, none, none
    runs = len(words) - prefix + 1
    gram = np.zeros(runs, dtype=np.uint64)
    for j in range(prefix):
        gram = mix(gram * _STEP[1] + words[j : j + runs] * _STEP[0])
    width, span, best = window - prefix + 1, 1, np.arange(runs)
    while 2 * span <= width:  # best[i]: leftmost smallest of the runs i .. i + span - 1
        a, b = best[:-span], best[span:]
        best = np.where(gram[a] <= gram[b], a, b)
        span *= 2
    a, b = best[:n], best[width - span : width - span + n]
    at = np.where(gram[a] <= gram[b], a, b)
    head = np.flatnonzero(np.diff(at, prepend=-1))
    tail = np.append(head[1:], n) - 1
    return gram[at[head]], at[head], head, tail


def _sign(window: int, prefix: int, parts: int):
    """Rows of documents, and rows of packed anchor keys: by part, or (part null) known to be repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = (TaskContext.get().partitionId() + 1) << 24
        for whole in batches:
            for begin in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(begin, _ROWS)
                chunk += 1
                base = chunk << 16
                texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
                shas = [hashlib.sha256(b" ".join(t.split())).hexdigest() for t in texts]
                seen: dict[str, int] = {}
                copies = Counter(shas)
                nodes, counts, keys = [], [], []
                for i, words in enumerate(word_hashes(texts)):
                    node = seen.setdefault(shas[i], i)
                    nodes.append(base + node)
                    counts.append(len(words))
                    if node == i:
                        gram = anchors(words, window, prefix)[0]
                        keys.append((gram & ~_LOW) | np.uint64(i))
                first = [node - base == i for i, node in enumerate(nodes)]
                copied = [copies[s] > 1 for s in shas]
                yield _rows(
                    node=nodes, doc_id=batch.column(0), mark=batch.column(2), n_words=counts, sha=shas, first=first, copied=copied
                )
                packed = np.sort(np.concatenate(keys))
                if not len(packed):
                    continue
                value = packed >> _SHIFT
                head = np.flatnonzero(np.diff(value, prepend=~value[:1]))
                length = np.diff(head, append=len(packed))
                repeated = np.unique(packed[np.repeat(length, length) > 1])
                if len(repeated):
                    yield _rows(base=[base], keys=[repeated.tobytes()])
                once = packed[head]
                part = ((once >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
                cuts = np.searchsorted(part, np.arange(parts + 1))
                full = [p for p in range(parts) if cuts[p] < cuts[p + 1]]
                yield _rows(part=full, base=[base] * len(full), keys=[once[cuts[p] : cuts[p + 1]].tobytes() for p in full])

    return run


def _rows(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _SIGNED], schema=_SIGNED
    )


def _pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the parts in one task: keys that several batches have, as (node, packed keys)."""
    keys, nodes = [], []
    for batch in batches:
        for base, packed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            own = np.frombuffer(packed, dtype=np.uint64)
            keys.append(own >> _SHIFT)
            nodes.append((own & _LOW).astype(np.int64) + base)
    if not keys:
        return
    key, node = np.concatenate(keys), np.concatenate(nodes)
    order = np.argsort(key)
    key, node = key[order], node[order]
    head = np.flatnonzero(np.diff(key, prepend=~key[:1]))
    length = np.diff(head, append=len(key))
    again = np.repeat(length, length) > 1
    yield from _by_node(node[again], key[again])


def _by_node(node: np.ndarray, key: np.ndarray) -> Iterator[pa.RecordBatch]:
    order = np.argsort(node, kind="stable")
    node, key = node[order], key[order]
    head = np.flatnonzero(np.diff(node, prepend=-1))
    cuts = np.append(head, len(node))
    for at in range(0, len(head), 10_000):
        rows = range(at, min(at + 10_000, len(head)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[head[at : at + 10_000]]), pa.array([key[cuts[i] : cuts[i + 1]].tobytes() for i in rows], pa.binary())],
            names=["node", "keys"],
        )


def _known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys repeated inside a batch, by node."""
    for batch in batches:
        for base, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = np.frombuffer(packed, dtype=np.uint64)
            yield from _by_node((own & _LOW).astype(np.int64) + base, own >> _SHIFT)


_CONTEXT = "key long, salt long, node long, start int, windows int, many boolean, words binary"


def _contexts(window: int, prefix: int, frequent: int):
    """Of texts with repeated anchors: the words that the windows of each such anchor span.

    `many` marks words that stand for several texts of the batch; their windows are known to be repeated, which rows
    with `windows` 0 and `words` null say (start and salt give the span). A row without node warns the unsplit group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = (TaskContext.get().partitionId() + 1) << 24
        for whole in batches:
            for begin in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(begin, _ROWS)
                chunk += 1
                texts = batch.column(1).cast(pa.binary()).to_pylist()
                spans: dict[tuple[int, bytes], list] = {}
                for i, words in enumerate(word_hashes(texts)):
                    wanted = np.frombuffer(b"".join(batch.column(2)[i].as_py()), dtype=np.uint64)
                    gram, at, low, high = anchors(words, window, prefix)
                    parts = texts[i].split()
                    node = batch.column(0)[i].as_py()
                    for j in np.flatnonzero(np.isin(gram >> _SHIFT, wanted)):
                        words_of = b" ".join(parts[low[j] : high[j] + window])
                        place = (node, int(low[j]), int(high[j] - low[j]) + 1)
                        spans.setdefault((int(gram[j].view(np.int64)), words_of), []).append(place)
                often = Counter(key for key, _ in spans)
                rows: list[tuple] = []
                for (key, words_of), places in spans.items():
                    node, start, windows = places[0]
                    salt = chunk if often[key] > frequent else 0
                    rows.append((key, salt, node, start, windows, len(places) > 1, words_of))
                    if len(places) > 1:
                        rows += [(key, w, n, s, 0, True, None) for n, s, w in places]
                rows += [(key, 0, None, 0, 0, False, None) for key, n in often.items() if n > frequent]
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
                columns = list(zip(*rows)) or [()] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_CONTEXT.replace(",", "").split()[::2])

    return run


def tree_nodes(ids: np.ndarray, depth: int) -> np.ndarray:
    """Names of the nodes at a depth above which the suffixes of a number sequence stand (-1 where it ends before)."""
    n = len(ids)
    ranks, step = {1: ids.astype(np.int64)}, 1
    while 2 * step <= depth:
        ranks[2 * step] = _join(ranks[step], ranks[step], step)
        step *= 2
    out, done = ranks[step], step
    if done < depth:
        out = _join(out, out, depth - step)
    return np.concatenate([out, np.full(n - len(out), -1)])


def _join(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
    m = max(0, len(a) - shift)
    if not m:
        return np.zeros(0, dtype=np.int64)
    return np.unique(a[:m] * (int(b.max()) + 1) + b[shift : shift + m], return_inverse=True)[1].astype(np.int64)


def _subtrees(window: int, group_words: int):
    """Repeated spans of the groups in a task (node, start, end), and windows of split groups to match once more.

    Rows come sorted by key and salt. Rows with a digest belong to split groups; their node is null if the window is
    already known to be repeated.
    """

    def build(rows: list[tuple], warned: set[int]) -> pa.RecordBatch:
        numbers: dict[bytes, int] = {}
        words: list[list[int]] = []
        for row in rows:
            words.append([numbers.setdefault(w, len(numbers)) for w in row[6].split()])
        lengths = np.array([len(w) for w in words])
        name = tree_nodes(np.concatenate([np.array(w, dtype=np.int64) for w in words]), window)
        firsts = np.cumsum(lengths) - lengths
        windows = np.array([row[4] for row in rows])
        which = np.repeat(np.arange(len(rows)), windows)
        offset = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
        node_of = name[np.repeat(firsts, windows) + offset]
        weight = np.where(np.array([row[5] for row in rows]), 2, 1)[which]
        leaves = np.bincount(node_of, weights=weight)
        again = leaves[node_of] > 1
        out: list[tuple] = []
        cuts = np.searchsorted(which, np.arange(len(rows) + 1))
        for i, row in enumerate(rows):
            if row[5]:
                continue
            edge = np.flatnonzero(np.diff(np.concatenate([[False], again[cuts[i] : cuts[i + 1]], [False]]).astype(np.int8)))
            out += [(row[2], row[3] + a, row[3] + b - 1 + window, None) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]
        split = np.array([row[1] != 0 or row[0] in warned for row in rows])[which]
        if split.any():
            some = np.flatnonzero(split)
            some = some[np.unique(node_of[some], return_index=True)[1]]
            for i in some.tolist():
                row, at = rows[which[i]], int(offset[i])
                text = b" ".join(row[6].split()[at : at + window])
                digest = hashlib.blake2b(text, digest_size=16).digest()
                start = row[3] + at
                out.append((None if again[i] else row[2], start, start + window, digest))
        columns = list(zip(*out)) or [()] * 4
        types = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["node", "start", "end", "digest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        warned: set[int] = set()
        held, last = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                group = row[:2]
                if held >= group_words and (group != last or held >= 4 * group_words):
                    going_on = {row[0]} if group == last else set()  # a group cut here counts as split
                    yield build(rows, warned | going_on)
                    rows, held, warned = [], 0, going_on
                last = group
                if row[2] is None:
                    warned.add(row[0])
                else:
                    rows.append(row)
                    held += row[4] + window
        if rows:
            yield build(rows, warned)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, shas = [], []
        for text, spans in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
            words = text.split()
            gone = np.zeros(len(words) + 1, dtype=np.int64)
            for span in spans:
                gone[span["start"]] += 1
                gone[span["end"]] -= 1
            keep = np.cumsum(gone[:-1]) == 0
            removed.append(len(words) - int(keep.sum()))
            shas.append(hashlib.sha256(b" ".join([words[i] for i in np.flatnonzero(keep)])).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(removed, pa.int64()), pa.array(shas, pa.string())], names=["node", "removed", "kept"]
        )


def repeated_spans(
    documents: DataFrame, window: int = 35, prefix: int = 8, group_words: int = 1_000_000, frequent: int = 20, part_bytes: int = 32 << 20
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of the documents by node, texts of nodes with repeated anchors, and the repeated spans (node, start, end)."""
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark"))
    signed = settle(docs.mapInArrow(_sign(window, prefix, 1024), _SIGNED_DDL), "repeat-anchors")
    packed = signed.where("part is not null").select("part", "base", "keys")
    held = packed.agg(F.sum(F.length("keys"))).first()[0] or 0
    tasks = int(min(1024, max(1, held // part_bytes, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    across = packed.repartition(tasks, "part").mapInArrow(_pair, "node long, keys binary")
    inside = signed.where("part is null and keys is not null").select("base", "keys").mapInArrow(_known, "node long, keys binary")
    wanted = across.union(inside).groupBy("node").agg(F.collect_list("keys").alias("wanted"))
    of = signed.where("first").select("node", "doc_id", "mark")
    asked = wanted.join(of, "node").select("node", F.col("doc_id").alias("d"), F.col("mark").alias("m"), "wanted")
    same = (F.col("mark") == F.col("m")) & F.col("doc_id").eqNullSafe(F.col("d"))
    texts = settle(docs.join(asked, same).select("node", "text", "wanted"), "repeat-texts")
    contexts = texts.mapInArrow(_contexts(window, prefix, frequent), _CONTEXT)
    sent = settle(contexts, "repeat-contexts")
    groups = sent.where("words is not null or node is null").repartition("key", "salt").sortWithinPartitions("key", "salt")
    found = settle(groups.mapInArrow(_subtrees(window, group_words), "node long, start int, end int, digest binary"), "repeat-spans")
    known = sent.where("words is null and node is not null").select("node", "start", (F.col("start") + F.col("salt") - 1 + window).cast("int").alias("end"))
    split = found.where("digest is not null")
    twice = split.groupBy("digest").agg(F.count("*").alias("n"), F.max(F.col("node").isNull()).alias("sure")).where("n > 1 or sure")
    late = split.where("node is not null").join(twice, "digest").select("node", "start", "end")
    spans = found.where("digest is null").select("node", "start", "end").union(known).union(late)
    return signed.where("n_words is not null"), texts, spans


def cut_repeats(
    documents: DataFrame, window: int = 35, prefix: int = 8, group_words: int = 1_000_000, frequent: int = 20
) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document (see the module)."""
    rows, texts, spans = repeated_spans(documents, window, prefix, group_words, frequent)
    listed = spans.groupBy("node").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    cut = texts.select("node", "text").join(listed, "node").mapInArrow(_cut, "node long, removed long, kept string")
    result = settle(cut.dropDuplicates(["node"]), "repeat-results")
    whole = F.col("copied") & (F.col("n_words") >= window)
    return rows.join(result, "node", "left").select(
        "doc_id",
        "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(_EMPTY)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    )
