"""N-gram Jaccard join: size-banded tiles of sets, bounded by hashed bitmaps before the exact intersection.

1. Every document becomes a sorted array of distinct 64-bit shingle hashes. Sizes fall into bands; two sets that reach
   the threshold lie in one band or in neighbouring ones and differ in at most H elements, H fixed by the band. Cut by
   element hash into more than H parts, such sets agree in a whole part. So sets that share no part need no comparison.
   A part may be empty. A set with E empty parts and more than H + E parts in all shares a part that is not empty with
   every partner; so empty parts count only for sets where that fails.
2. Equal sets link. They are told by a digest of the set, and the smallest of them stands for all: the others have no part
   in what follows, so copies, which share every key, are not tied anew in every range of keys.
   Of the rest, sets that share a part key are tied: inside a batch before anything is shuffled, then in each range of keys.
   Either hands on a forest, one row at most a set, that ties the sets of a group to the smallest; the connected groups of
   these ties hold every pair that can link.
3. A group is dealt into tiles of bounded size: blocks of a size band against each other and against those of the next
   band; a group that fits into one block is one tile. In a tile a bitmap of each
   set bounds the overlap from above: every bit that only one of the two has stands for an element the other lacks. Only
   pairs under the bound and not yet connected are intersected exactly.
4. The links found, and those of equal sets, connect documents; the smallest doc_id names each component.

Nulls and texts without words have no set and link with nothing. Rows that share a doc_id are told apart by a digest of
their text; rows without one are returned unlinked. Ids are integers. Shingles are told apart by 64-bit hashes. Other
columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import components, give_back, lean, mix, scratch, settle, slices, word_hashes

_STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
_PARTS = 4096  # ranges of key hashes, by their twelve highest bits
_RANGES = 256  # ranges of key hashes, by their highest byte, as a batch writes them
_SIGNED = (
    "node long, doc_id long, digest long, n_shingles long, head boolean, same binary, a long, b long, key_range int, first long, keys binary"
)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of k words; of the whole sequence where it is shorter."""
    if not len(words):
        return words
    width = min(k, len(words))
    total = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for j in range(width):
        total = mix(total * _STEP[1] + words[j : len(words) - width + 1 + j] * _STEP[0])
    return np.unique(total)


def bands(threshold: float, most: int) -> np.ndarray:
    """Lower ends of the size bands, so that sets reaching the threshold are at most one band apart."""
    ends = [1]
    while ends[-1] <= most:
        ends.append(int(np.floor(ends[-1] / threshold)) + 1)
    ends.append(int(np.floor(ends[-1] / threshold)) + 1)
    return np.array(ends)


def part_keys(sets: np.ndarray, band: int, ends: np.ndarray, threshold: float) -> np.ndarray:
    """Part keys of a set in the tiles of its own band and of the band below (hash of tile, part and content)."""
    out = []
    for tile in (band, band - 1):
        if tile < 0:
            continue
        largest = ends[tile + 1] - 1
        differ = int(np.floor((largest + largest / threshold) * (1 - threshold) / (1 + threshold) + 1e-9))
        parts = differ + 3 + differ // 10 if differ else 1
        where = ((sets >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)  # grows with the hash
        sums = np.zeros(len(sets) + 1, dtype=np.uint64)
        np.cumsum(mix(sets), out=sums[1:])
        cuts = np.searchsorted(where, np.arange(parts + 1, dtype=np.uint64))
        content = sums[cuts[1:]] - sums[cuts[:-1]]
        keys = mix(content * _STEP[0] + mix(np.arange(parts, dtype=np.uint64) + np.uint64(tile << 32)))
        filled = cuts[1:] > cuts[:-1]
        out.append(keys[filled] if parts - differ > parts - filled.sum() else keys)
    return np.concatenate(out)


def _sign(k: int, threshold: float):
    ends = bands(threshold, 1 << 40)
    shift = np.uint64(16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = (TaskContext.get().partitionId() + 1) << 24
        for whole in batches:
            for batch in slices(whole, 1):
                chunk += 1
                base = chunk << 16
                ids = batch.column(0)
                texts = [(t or "").encode().translate(_LOWER) for t in batch.column(1).to_pylist()]
                seen: dict[bytes, int] = {}
                nodes, sizes, heads, same, keys = [], [], [], [], []
                for i, words in enumerate(word_hashes(texts)):
                    sets = shingles(words, k)
                    sizes.append(len(sets))
                    linked = len(sets) and ids[i].is_valid
                    node = seen.setdefault(sets.tobytes(), i) if linked else i
                    nodes.append(base + node if ids[i].is_valid else None)
                    heads.append(bool(linked) and node == i)
                    same.append(hashlib.blake2b(sets.tobytes(), digest_size=16).digest() if heads[i] else None)
                    if heads[i]:
                        band = int(np.searchsorted(ends, len(sets), side="right")) - 1
                        own = part_keys(sets, band, ends, threshold)
                        keys.append((own & ~np.uint64(0xFFFF)) | np.uint64(i))
                yield _rows(node=nodes, doc_id=ids, digest=batch.column(2), n_shingles=sizes, head=heads, same=same)
                if not keys:
                    continue
                packed = np.concatenate(keys)
                del keys, texts
                packed.sort()
                head = np.flatnonzero(np.diff(packed >> shift, prepend=~packed[:1] >> shift))
                firsts = np.repeat(packed[head], np.diff(head, append=len(packed)))
                a, b = forest((firsts & np.uint64(0xFFFF)).astype(np.int64), (packed & np.uint64(0xFFFF)).astype(np.int64))
                yield _rows(a=base + a, b=base + b)
                once = packed[head]
                cuts = np.searchsorted(once >> np.uint64(56), np.arange(_RANGES + 1, dtype=np.uint64))
                full = [p for p in range(_RANGES) if cuts[p] < cuts[p + 1]]
                low = once.view(np.uint8).reshape(-1, 8)[:, :7]  # the range states the highest byte
                yield _rows(key_range=full, first=[base] * len(full), keys=[low[cuts[p] : cuts[p + 1]].tobytes() for p in full])

    return run


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_FIELDS = pa.schema(
    [("node", pa.int64()), ("doc_id", pa.int64()), ("digest", pa.int64()), ("n_shingles", pa.int64()), ("head", pa.bool_())]
    + [("same", pa.binary()), ("a", pa.int64()), ("b", pa.int64()), ("key_range", pa.int32()), ("first", pa.int64()), ("keys", pa.binary())]
)


def _rows(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _FIELDS], schema=_FIELDS
    )


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node that the edges connect to a smaller one, with the smallest node of its component."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        now = label.copy()
        for end in (label[left], label[right]):  # the roots of both ends take the smaller name
            np.minimum.at(now, end, low)
        while not np.array_equal(step := now[now], now):
            now = step
        if (now == label).all():
            break
        label = now
    tied = label != np.arange(len(nodes))
    return nodes[label[tied]], nodes[tied]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key_range, first, keys, gone) by part (part, first, keys), without the keys of the nodes `gone`.

    A row's keys are sorted, and their part is stated by the range and the highest four bits that the row holds.
    """
    step = _PARTS // _RANGES
    for batch in batches:
        ranges, firsts, packed, gone = (c.to_pylist() for c in batch.columns)
        parts, bases, keys = [], [], []
        for key_range, first, blob, without in zip(ranges, firsts, packed, gone):
            low = np.frombuffer(blob, dtype=np.uint8).reshape(-1, 7)
            if without is not None:
                away = np.zeros(1 << 16, dtype=bool)
                away[without] = True
                low = low[~away[low[:, 0].astype(np.int64) | low[:, 1].astype(np.int64) << 8]]
            cuts = np.searchsorted(low[:, 6] >> 4, np.arange(step + 1))
            for p in range(step):
                if cuts[p] < cuts[p + 1]:
                    parts.append(key_range * step + p)
                    bases.append(first)
                    keys.append(low[cuts[p] : cuts[p + 1]].tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.int32()), pa.array(bases, pa.int64()), pa.array(keys, pa.binary())], names=["part", "first", "keys"]
        )


def _ties(held: int, most: int = 1 << 20):
    """Ties of nodes to the smallest one of their group, by the keys of the parts that one task holds.

    Each part is whole in its task and its rows follow each other; parts are worked off when `held` bytes of keys have
    come, and their ties made one forest whenever there are `most`. So a task hands on one row a node at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tied = [np.zeros((2, 0), dtype=np.int64)]
        found: list[np.ndarray] = []
        nodes: list[np.ndarray] = []
        size, bound, last = 0, most, None
        for batch in batches:
            for part, first, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if part != last and size >= held:
                    tied.append(_tied(found, nodes))
                    found, nodes, size = [], [], 0
                    if sum(t.shape[1] for t in tied) > bound:
                        tied = [np.stack(forest(*np.concatenate(tied, axis=1)))]
                        bound = max(most, 2 * tied[0].shape[1])
                last, size = part, size + len(packed)
                wide = np.full((len(packed) // 7, 8), part >> 4, dtype=np.uint8)
                wide[:, :7] = np.frombuffer(packed, dtype=np.uint8).reshape(-1, 7)
                own = wide.view(np.uint64).ravel()
                found.append(own >> np.uint64(16))
                nodes.append((own & np.uint64(0xFFFF)).astype(np.int64) + first)
        if found:
            tied.append(_tied(found, nodes))
        ties = np.stack(forest(*np.concatenate(tied, axis=1)))
        for at in range(0, ties.shape[1], 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 100_000]) for x in ties], names=["a", "b"])

    return run


def _tied(found: list[np.ndarray], nodes: list[np.ndarray]) -> np.ndarray:
    """The forest of the nodes that share a key."""
    key, node = np.concatenate(found), np.concatenate(nodes)
    order = np.argsort(key, kind="stable")
    key, node = key[order], node[order]
    head = np.flatnonzero(np.diff(key, prepend=~key[:1]))
    length = np.diff(head, append=len(key))
    shared = np.repeat(length, length) > 1
    return np.stack(forest(np.repeat(node[head], length)[shared], node[shared]))


def shared_keys(packed: DataFrame, part_bytes: int) -> DataFrame:
    """Ties (a, b) of nodes by the keys of `packed` (part, first, keys).

    The number of tasks is that of the shuffle and does not grow with the keys: a node may be tied in every one of them.
    """
    tasks = min(_PARTS, int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    whole = packed.repartition(tasks, "part").sortWithinPartitions("part")
    return whole.mapInArrow(lean(_ties(part_bytes)), "a long, b long")


def equal_sets(heads: DataFrame) -> DataFrame:
    """(a, b): every node b of `heads` (node, same) that an equal set with the smaller node a stands for."""
    first = heads.groupBy("same").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    return heads.join(first, "same").where("node > a").select("a", F.col("node").alias("b"))


def keys_by_part(ranges: DataFrame, gone: DataFrame) -> DataFrame:
    """(part, first, keys) of all rows of `ranges` (key_range, first, keys) without the nodes `b` of `gone`.

    The nodes of a batch are listed in one row, so the list is as long as a batch at most.
    """
    of_batch = F.col("b").bitwiseAND(F.lit(~0xFFFF)).alias("first")
    listed = gone.select(of_batch, F.col("b").bitwiseAND(0xFFFF).cast("int").alias("i")).groupBy("first").agg(F.collect_list("i").alias("gone"))
    joined = ranges.join(listed, "first", "left").select("key_range", "first", "keys", "gone")
    return joined.mapInArrow(lean(_parts), "part int, first long, keys binary")


def _sets(texts: pa.ChunkedArray, k: int) -> list[np.ndarray]:
    out = []
    for at in range(0, len(texts), 2000):
        blobs = [t.encode().translate(_LOWER) for t in texts.slice(at, 2000).to_pylist()]
        out += [shingles(words, k) for words in word_hashes(blobs)]
    return out


def link_tile(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int, inner: bool = False) -> list[tuple[int, int]]:
    """Links that connect the sets of a tile, as a spanning forest.

    Compared are pairs inside `left`, or between `left` and `right`, with `inner` both.

    Numbers of `right` follow those of `left`. A pair links when 100 * intersection >= percent * union.
    """
    sets = left + (right or [])
    size = np.array([len(x) for x in sets])
    order = np.argsort(size, kind="stable")
    size = size[order]
    side = order < len(left)
    width = int(min(8192, max(64, 1 << int(8 * np.median(size)).bit_length())))
    bits = np.zeros((len(sets), width // 64), dtype=np.uint64)
    for row, i in enumerate(order):
        at = (sets[i] >> np.uint64(20)) % np.uint64(width)
        np.bitwise_or.at(bits[row], (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    label = np.arange(len(sets))
    out = []
    for i in range(len(sets)):
        stop = np.searchsorted(size, size[i] * 100 // percent, side="right")
        rest = np.arange(i + 1, stop)
        rest = rest[label[rest] != label[i]]
        if right is not None:
            rest = rest[side[rest] | side[i]] if inner else rest[side[rest] != side[i]]
        if not len(rest):
            continue
        lack = np.bitwise_count(bits[i] & ~bits[rest]).sum(axis=1)
        extra = np.bitwise_count(bits[rest] & ~bits[i]).sum(axis=1)
        most = np.minimum(size[i] - lack.astype(np.int64), size[rest] - extra.astype(np.int64))
        for j in rest[100 * most >= percent * (size[i] + size[rest] - most)]:
            if label[j] == label[i]:
                continue
            common = len(np.intersect1d(sets[order[i]], sets[order[j]], assume_unique=True))
            if 100 * common >= percent * (size[i] + size[j] - common):
                out.append((int(order[i]), int(order[j])))
                label[label == label[j]] = label[i]
    return out


def _tile(k: int, percent: int):
    def run(key: tuple[pa.Scalar, ...], whole: pa.Table) -> pa.Table:
        upper = np.array(whole["upper"].to_pylist(), dtype=bool)
        nodes = whole["node"].to_numpy()
        sets = _sets(whole["text"], k)
        left, right = np.flatnonzero(~upper), np.flatnonzero(upper)
        same = key[1].as_py() == key[3].as_py() and key[2].as_py() == key[4].as_py()
        names = nodes[np.concatenate([left, right])]
        pairs = link_tile([sets[i] for i in left], None if same else [sets[i] for i in right], percent, whole["inner"][0].as_py())
        a, b = [int(names[i]) for i, _ in pairs], [int(names[j]) for _, j in pairs]
        large = whole.nbytes >= 1 << 20
        del whole, sets
        if large:
            give_back()
        return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


#: Tiles (low_band, low, high_band, high) of a set and whether it is on their upper side: the blocks of its own band, and
#: those of the bands beside it. A band of one block below another has no tile of its own: it is compared in itself
#: (`inner`) where it meets the first block of the next band.
_TILES = """concat(
    transform(if(own > 1 or above = 0, sequence(0L, own - 1), cast(array() as array<bigint>)),
        o -> named_struct('low_band', band, 'low', least(block, o), 'high_band', band, 'high', greatest(block, o), 'upper', block > o, 'inner', false)),
    transform(if(below > 0, sequence(0L, below - 1), cast(array() as array<bigint>)),
        o -> named_struct('low_band', band - 1, 'low', o, 'high_band', band, 'high', block, 'upper', true, 'inner', below = 1 and block = 0)),
    transform(if(above > 0, sequence(0L, above - 1), cast(array() as array<bigint>)),
        o -> named_struct('low_band', band, 'low', block, 'high_band', band + 1, 'high', o, 'upper', false, 'inner', own = 1 and o = 0))
)"""


def dealt_members(groups: DataFrame, sizes: DataFrame, threshold: float, block: int, held: int = 4 << 20) -> DataFrame:
    """Rows of `sizes` (node, n_shingles and more) of all groups, with their tile in place of the size.

    A tile says the group, the set's band and block, and the blocks it has to meet. A group of at most `block` sets with
    `held` shingles is one tile. A larger one is dealt by size band, each band into blocks by hash that keep either
    bound, and meets only blocks of its own band and of the bands beside it: no other sizes can reach the threshold.
    """
    ends = F.array(*[F.lit(int(e)) for e in bands(threshold, 1 << 40)])
    band = F.size(F.filter(ends, lambda e: e <= F.col("n_shingles"))).cast("long")
    others = [c for c in sizes.columns if c not in ("node", "n_shingles")]
    banded = groups.join(sizes, "node").select("node", "component", band.alias("band"), "n_shingles", *others)
    counts = banded.groupBy("component", "band").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("shingles") / held))
    per_group = counts.groupBy("component").agg(
        F.sum("n").alias("whole"), F.sum("shingles").alias("shingles"),
        F.map_from_entries(F.collect_list(F.struct("band", blocks.alias("blocks")))).alias("blocks"),
    )
    placed = banded.drop("n_shingles").join(per_group, "component")
    placed = placed.withColumn("one", (F.col("whole") <= block) & (F.col("shingles") <= held))
    at = lambda step: F.when(F.col("one"), 0).otherwise(F.coalesce(F.try_element_at("blocks", F.col("band") + step), F.lit(0))).cast("long")
    counted = placed.select(
        "node", "component", F.when(F.col("one"), 0).otherwise(F.col("band")).cast("long").alias("band"),
        F.greatest(at(0), F.lit(1)).alias("own"), at(-1).alias("below"), at(1).alias("above"), *others,
    )
    dealt = counted.withColumn("block", F.pmod(F.xxhash64("node"), F.col("own")))
    return dealt.select("node", F.struct("component", "band", "block", "own", "below", "above").alias("tile"), *others)


def jaccard_components(documents: DataFrame, k: int = 5, percent: int = 80, block: int = 8000, part_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, n_shingles and component_id of every document (see the module).

    `percent` is the similarity in hundredths, `block` the sets of a tile's side, `part_bytes` the packed keys that
    one task works on at a time.
    """
    return jaccard_rows(documents, k, percent, block, part_bytes).select("doc_id", "n_shingles", "component_id")


def jaccard_rows(documents: DataFrame, k: int = 5, percent: int = 80, block: int = 8000, part_bytes: int = 4 << 20) -> DataFrame:
    """`jaccard_components` with the digest of the text (`text_digest`) and the row's group (`component`), both long."""
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_digest("text").alias("digest"))
    with scratch(spark):
        with scratch(spark):  # the keys, about as large as the texts, are needed for the ties alone
            signed = settle(docs.mapInArrow(lean(_sign(k, percent / 100)), _SIGNED), "shingle-keys")
            rows = signed.where("n_shingles is not null").select("node", "doc_id", "digest", "n_shingles", "head")
            nodes = settle(rows, "shingle-nodes", lasting=True)
            copies = settle(equal_sets(signed.where("head").select("node", "same")), "shingle-copies", lasting=True)
            packed = keys_by_part(signed.where("key_range is not null").select("key_range", "first", "keys"), copies)
            # Of a key that several sets of a batch have, one entry left it; where that one's node is gone, its equal set has the key.
            ties = signed.where("a is not null").select("a", "b").union(copies).union(shared_keys(packed, part_bytes))
            groups = settle(components(ties, "shingle-ties"), "shingle-groups", lasting=True)
        heads = nodes.where("head").select("node", "n_shingles", "doc_id", "digest")  # one row of each node
        heads = heads.join(copies.select(F.col("b").alias("node")), "node", "left_anti")
        links = tile_links(docs, dealt_members(groups, heads, percent / 100, block), k, percent)
        named = settle(components(links.union(copies), "shingle-links"), "shingle-components")
        return name_components(nodes.select("node", "doc_id", "digest", "n_shingles"), named)


def tile_links(docs: DataFrame, wanted: DataFrame, k: int, percent: int, held: int = 2, least: int = 256 << 20) -> DataFrame:
    """Links (a, b) found in the tiles of the sets `wanted` (node, tile, doc_id, digest).

    Texts travel, not sets: they are less than half as large, and a tile shingles its own. A text goes to as many tiles as its
    group has blocks beside it; so the tiles are worked off in rounds, each of which deals out at most about `held` times the
    texts of all groups (or `least` bytes), however many blocks a group has.
    """
    with scratch(docs.sparkSession):
        texts = docs.join(wanted, ["doc_id", "digest"]).select("node", "tile.*", "text")
        texts = settle(texts.withColumns({"n_bytes": F.octet_length("text"), "n_tiles": F.size(F.expr(_TILES))}), "shingle-texts")
        whole, dealt = texts.agg(F.sum("n_bytes"), F.sum(F.col("n_bytes").cast("long") * F.col("n_tiles"))).first()
        rounds = max(1, -(-(dealt or 0) // max(least, held * (whole or 0))))
        tiles = texts.select("component", "node", "text", F.explode(F.expr(_TILES)).alias("at"))
        sides = ["component", "low_band", "low", "high_band", "high"]
        given = tiles.select("component", "at.low_band", "at.low", "at.high_band", "at.high", "at.upper", "at.inner", "node", "text")
        found = []
        for turn in range(rounds):
            own = given if rounds == 1 else given.where(F.pmod(F.xxhash64(*sides), F.lit(rounds)) == turn)
            pairs = own.groupBy(*sides).applyInArrow(_tile(k, percent), "a long, b long")
            found.append(settle(pairs, "shingle-pairs", lasting=True))
        return functools.reduce(DataFrame.union, found)


def text_digest(text: str) -> Column:
    """What tells apart the texts of rows that share a doc_id."""
    return F.xxhash64(text)


def name_components(of: DataFrame, named: DataFrame) -> DataFrame:
    """Rows of `of` (node, doc_id, digest, n_shingles) with their component and its smallest doc_id."""
    placed = settle(
        of.join(named, "node", "left").select("doc_id", "digest", "n_shingles", F.coalesce("component", "node").alias("component")),
        "shingle-placed", lasting=True,
    )
    least = settle(placed.groupBy("component").agg(F.min("doc_id").alias("component_id")), "shingle-names", lasting=True)
    return placed.join(least, "component", "left").select("doc_id", "n_shingles", "component_id", "digest", "component")
