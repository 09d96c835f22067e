"""SentencePiece encoding that keeps offsets, and decoding.

1. Normalisation: at each place the longest prefix that the model's compiled character map knows (a double-array trie)
   is replaced, other characters stay; the model's rules about white space follow. Every byte of the result records the
   byte of the source it comes from. Only places whose first two bytes can begin a rule are looked at one by one.
2. The pieces of the normalised text are merged by the sentencepiece library, loaded with the model's pieces and its
   normaliser switched off; long texts in parts, cut at a word sign (U+2581) that no piece of the model reaches over.
3. Every piece is projected through the recorded bytes to a span of the source text. Begin and end ids have empty spans
   at its ends. Of the bytes of an unknown character all but the last have empty spans at its start, as in the library.

A null text is empty and gives the begin and end ids alone. Bytes that are not UTF-8 count as U+FFFD each. Repeated rows
are encoded each. The id column is passed on as it is; other columns are ignored. The model file is read by the driver
and sent with the tasks. Texts are worked on one by one, results leave in batches of bounded size.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructField, StructType

WORD_SIGN = "▁".encode()
#: Bytes of normalised text that the library merges at a time.
PART = 1 << 20
#: Bytes of text after which a batch of results is handed on.
HANDED_ON = 4 << 20

_CONTROL, _USER_DEFINED, _UNUSED, _BYTE = 3, 4, 5, 6


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield number, message[at : at + size]
        at += size


def field(number: int, value: int | bytes) -> bytes:
    """A field of a protocol buffer message."""

    def varint(x: int) -> bytes:
        return bytes([x & 127 | 128]) + varint(x >> 7) if x > 127 else bytes([x])

    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


class CharacterMap:
    """The compiled character map: longest rule that begins at a place of a text."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], dtype="<u4").tolist()
        self.texts = blob[4 + size :]
        self.single = np.zeros(256, dtype=bool)
        self.double = np.zeros((256, 256), dtype=bool)
        if not self.units:
            return
        for first in range(1, 256):
            place, ends = self._step(self._offset(0), first)
            if place is None:
                continue
            self.single[first] = ends
            for second in range(1, 256):
                self.double[first, second] = self._step(place, second)[0] is not None

    def _offset(self, place: int) -> int:
        unit = self.units[place]
        return place ^ ((unit >> 10) << ((unit & 512) >> 6))

    def _step(self, place: int, byte: int) -> tuple[int | None, bool]:
        """Where the children of the node reached by a byte begin, and whether a rule ends there."""
        child = place ^ byte
        if child >= len(self.units) or self.units[child] & 0x800000FF != byte:
            return None, False
        return self._offset(child), bool(self.units[child] >> 8 & 1)

    def places(self, raw: np.ndarray) -> np.ndarray:
        """Where a rule may begin."""
        if not self.units or not len(raw):
            return np.zeros(0, dtype=np.int64)
        able = self.single[raw]
        able[:-1] |= self.double[raw[:-1], raw[1:]]
        return np.flatnonzero(able)

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest rule at a place."""
        found, place = None, self._offset(0)
        for i in range(at, len(text)):
            place, ends = self._step(place, text[i]) if text[i] else (None, False)
            if place is None:
                break
            if ends:
                found = i + 1 - at, self.units[place] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.texts[found[1] : self.texts.index(b"\0", found[1])]


def broken_bytes(text: bytes) -> list[int]:
    """Places of the bytes that belong to no UTF-8 character."""
    out, at = [], 0
    while True:
        try:
            text[at:].decode()
            return out
        except UnicodeDecodeError as error:
            at += error.start
            out.append(at)
            at += 1


@dataclass(frozen=True)
class Rules:
    """What a model says about normalisation."""

    character_map: bytes = b""
    dummy_prefix: bool = True
    remove_extra: bool = True
    escape: bool = True
    as_suffix: bool = False
    symbols: tuple[bytes, ...] = ()


class Normaliser:
    def __init__(self, rules: Rules):
        self.rules = rules
        self.map = CharacterMap(rules.character_map)
        longest_first = sorted(rules.symbols, key=len, reverse=True)
        self.symbol = re.compile(b"|".join(map(re.escape, longest_first))) if longest_first else None

    def _edits(self, text: bytes, raw: np.ndarray) -> list[tuple[int, int, bytes]]:
        """(start, length, replacement), from left to right."""
        broken = set(broken_bytes(text))
        places = set(self.map.places(raw).tolist()) | broken
        if self.symbol:
            places |= {m.start() for m in re.finditer(b"(?=" + self.symbol.pattern + b")", text)}
        out, end = [], 0
        for at in sorted(places):
            if at < end:
                continue
            if self.symbol and (frozen := self.symbol.match(text, at)):
                length, new = len(frozen[0]), frozen[0]
            elif rule := self.map.longest(text, at) if self.map.units else None:
                length, new = rule
            elif at in broken:
                length, new = 1, "�".encode()
            else:
                continue
            out.append((at, length, new))
            end = at + length
        return out

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text and, for each of its bytes and its end, the byte of the source."""
        raw = np.frombuffer(text, dtype=np.uint8)
        start = np.where(raw & 0xC0 != 0x80, np.arange(len(raw)), 0)
        source = np.maximum.accumulate(start) if len(raw) else start
        chunk = source  # bytes that were put in together share a chunk
        parts, froms, at, length = [], [], 0, len(raw)
        nothing = length  # the first place that is replaced by nothing
        for place, size, new in self._edits(text, raw):
            nothing = nothing if new else min(nothing, place)
            parts += [text[at:place], new]
            froms += [source[at:place], np.full(len(new), place)]
            at = place + size
        if parts:
            text = b"".join([*parts, text[at:]])
            raw = np.frombuffer(text, dtype=np.uint8)
            source = chunk = np.concatenate([*froms, source[at:]])
        return self._spaced(raw, source, chunk, length, nothing) if length else (b"", np.zeros(1, dtype=np.int64))

    def _spaced(self, raw: np.ndarray, source: np.ndarray, chunk: np.ndarray, length: int, nothing: int) -> tuple[bytes, np.ndarray]:
        rules = self.rules
        sign = WORD_SIGN if rules.escape else b" "
        space = raw == 32
        begins = 0
        if rules.remove_extra:
            if len(raw):
                head = np.maximum.accumulate(np.where(np.diff(chunk, prepend=-1) != 0, np.arange(len(raw)), 0))
                other = np.maximum.accumulate(np.where(space, -1, np.arange(len(raw))))
                leading = space & (other < head)  # spaces with which a chunk begins
                drop = leading & ((head == 0) | space[head - 1])
                whole = np.flatnonzero(~space | (np.diff(chunk, append=-1) == 0))
                nothing = min(nothing, int(source[whole[0]])) if len(whole) else nothing
                raw, source, space = raw[~drop], source[~drop], space[~drop]
            begins = nothing  # where anything but plain spaces begins
            if begins == length:
                return b"", np.full(1, length)
        wide = np.where(space, len(sign), 1)
        source = np.repeat(source, wide)
        out = np.repeat(raw, wide)
        if rules.escape:
            ends = np.cumsum(wide)[space]
            for i, byte in enumerate(sign):
                out[ends - len(sign) + i] = byte
        text, end = out.tobytes(), length
        if rules.dummy_prefix and not rules.as_suffix:
            text, source = sign + text, np.concatenate([np.full(len(sign), begins), source])
        if rules.remove_extra:
            kept = len(text)
            while text.endswith(sign, 0, kept):
                kept -= len(sign)
                end = int(source[kept])
            text, source = text[:kept], source[:kept]
        if rules.dummy_prefix and rules.as_suffix:
            text, source = text + sign, np.concatenate([source, np.full(len(sign), end)])
        return text, np.append(source, end)


_OFF = field(1, b"identity") + field(2, b"") + field(3, 0) + field(4, 0) + field(5, 0)


class PieceModel:
    """A SentencePiece model: encoding with spans of the source, and decoding."""

    def __init__(self, proto: bytes):
        pieces: list[tuple[bytes, int]] = []
        trainer: dict[int, int | bytes] = {}
        normal: dict[int, int | bytes] = {}
        for number, value in fields(proto):
            if number == 1:
                own = dict(fields(value))
                pieces.append((own[1], own.get(3, 1)))
            elif number == 2:
                trainer |= dict(fields(value))
            elif number == 3:
                normal |= dict(fields(value))
        rules = Rules(
            character_map=normal.get(2, b""), dummy_prefix=bool(normal.get(3, 1)), remove_extra=bool(normal.get(4, 1)),
            escape=bool(normal.get(5, 1)), as_suffix=bool(trainer.get(24, 0)),
            symbols=tuple(p for p, kind in pieces if kind == _USER_DEFINED),
        )
        self.normaliser = Normaliser(rules)
        self.merger = sentencepiece.SentencePieceProcessor(model_proto=proto + field(3, _OFF), num_threads=1)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto, num_threads=1)
        joined = [p for p, kind in pieces if kind not in (_CONTROL, _UNUSED) and WORD_SIGN in p.lstrip(WORD_SIGN)]
        apart = not joined and WORD_SIGN in {p for p, _ in pieces} and b" " not in b"".join(rules.symbols)
        self.apart = apart
        self.border = re.compile(b"(?s)(?<!%s).(?=%s)" % (WORD_SIGN[:2], WORD_SIGN))
        single = {i: int(p[3:5], 16) for i, (p, kind) in enumerate(pieces) if kind == _BYTE}
        self.byte = np.array([single.get(i, -1) for i in range(len(pieces))])
        width = np.array([0 if i in single else len(p) for i, (p, _) in enumerate(pieces)])
        self.width = width if len(single) == 256 and trainer.get(35, 0) else None  # else an unknown character has no fixed width
        self.begin = [x for x in [self.library.bos_id()] if x >= 0]
        self.end = [x for x in [self.library.eos_id()] if x >= 0]

    def _merged(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a normalised text with their spans in it."""
        if self.width is None:
            found = self.merger.encode(text, return_type="offset_mapping")
            spans = np.array(found["offsets"], dtype=np.int64).reshape(-1, 2)
            return np.array(found["ids"], dtype=np.int64), spans[:, 0], spans[:, 1]
        ids = self.merger.encode(text, return_type="numpy")
        width, byte = self.width[ids], self.byte[ids]
        single = np.flatnonzero(byte >= 0)
        if len(single):  # bytes of one character: the last one holds it
            follows = byte[single] & 0xC0 == 0x80
            size = np.diff(np.flatnonzero(~follows), append=len(single))
            width[single[np.cumsum(size) - 1]] = size
        ends = np.cumsum(width)
        return ids, ends - width, ends

    def _parts(self, text: bytes) -> Iterator[bytes]:
        """A long normalised text cut where no piece reaches over: before a word sign that follows another character."""
        at = 0
        while self.apart and len(text) - at > PART and (border := self.border.search(text, at + PART)):
            yield text[at : border.start() + 1]
            at = border.start() + 1
        yield text[at:]

    def encode(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids with begin and end id, and the byte spans of the source."""
        normal, source = self.normaliser(text)
        out, at = [(self.begin, [0] * len(self.begin), [0] * len(self.begin))], 0
        for part in self._parts(normal):
            ids, starts, ends = self._merged(part)
            out.append((ids, source[starts + at], source[ends + at]))
            at += len(part)
        out.append((self.end, [len(text)] * len(self.end), [len(text)] * len(self.end)))
        return tuple(np.concatenate([part[i] for part in out]).astype(kind) for i, kind in enumerate(("<u4", "<i4", "<i4")))

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


@functools.lru_cache(maxsize=2)
def piece_model(proto: bytes) -> PieceModel:
    return PieceModel(proto)


def _schema(key: StructField, columns: dict[str, object]) -> StructType:
    return StructType([key, *(StructField(n, t) for n, t in columns.items())])


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode_documents(
    documents: DataFrame, model: bytes, text: str = "text", key: str = "doc_id", packed: bool = False, decoded: bool = False
) -> DataFrame:
    """key, n_tokens, ids, starts and ends (byte spans of the UTF-8 source, end exclusive) of every row.

    The lists are arrays of integers, or with `packed` little-endian 32-bit integers in binaries. `decoded` adds the text
    that the ids decode to.
    """
    kind = BinaryType() if packed else ArrayType(IntegerType())
    columns = {"n_tokens": IntegerType(), "ids": kind, "starts": kind, "ends": kind}
    columns |= {"decoded": StringType()} if decoded else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = piece_model(model)
        for batch in batches:
            at, size = 0, 0
            rows: list[tuple] = []
            for i in range(batch.num_rows):
                own = batch.column(1)[i].as_py()
                lists = made.encode(own)
                rows.append((len(lists[0]), *lists, *([made.decode(lists[0])] if decoded else [])))
                size += len(own)
                if size >= HANDED_ON or i + 1 == batch.num_rows:
                    yield _lists(batch.column(0).slice(at, i + 1 - at), rows, key, packed, decoded)
                    at, size, rows = i + 1, 0, []

    source = documents.select(F.col(key), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_source"))
    return source.mapInArrow(run, _schema(source.schema[0], columns))


def _lists(keys: pa.Array, rows: list[tuple], key: str, packed: bool, decoded: bool) -> pa.RecordBatch:
    columns = [keys, pa.array([r[0] for r in rows], pa.int32())]
    for i in (1, 2, 3):
        if packed:
            columns.append(pa.array([r[i].tobytes() for r in rows], pa.binary()))
        else:
            offsets = np.cumsum([0, *(len(r[i]) for r in rows)])
            values = np.concatenate([r[i] for r in rows]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values)))
    names = [key, "n_tokens", "ids", "starts", "ends"]
    if decoded:
        columns.append(pa.array([r[4] for r in rows], pa.string()))
        names.append("decoded")
    return pa.RecordBatch.from_arrays(columns, names=names)


def decode_documents(encoded: DataFrame, model: bytes, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """key and decoded text of rows of ids, in arrays or packed; null ids give null, no ids the empty text."""
    packed = isinstance(encoded.schema[ids].dataType, BinaryType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = piece_model(model)
        for batch in batches:
            texts = []
            for x in batch.column(1).to_pylist():
                numbers = np.frombuffer(x or b"", dtype="<u4") if packed else np.array(x or [], dtype=np.int64)
                texts.append(None if x is None else made.decode(numbers))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "decoded"])

    source = encoded.select(key, F.col(ids).alias("_ids"))
    return source.mapInArrow(run, _schema(source.schema[0], {"decoded": StringType()}))


def digests(documents: DataFrame, model: bytes) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and spans_sha256 (starts, then ends, as 32-bit integers)."""
    encoded = encode_documents(documents, model, packed=True, decoded=True)
    return encoded.select(
        "doc_id",
        F.col("n_tokens").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.sha2(F.concat("starts", "ends"), 256).alias("spans_sha256"),
    )
