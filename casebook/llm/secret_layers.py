"""Secret scans with a worklist of decoded layers.

The text is the first layer. A layer is scanned by the base patterns and unwrapped: percent escapes and Unicode escapes
are decoded in place, base64 runs become layers of their own, and base64 that holds gzip or zlib data is unpacked. New
layers go to the worklist until none is left; a layer that has been seen at the same place is not taken again, which ends
cycles. Every layer keeps, for each of its characters, the stretch of the original text it stems from, so that spans of
all layers are spans of the original text (code points, end exclusive).

Base64 may run over several lines; its lines are decoded one by one and joined. Bytes that are not UTF-8 text are scanned as
Latin-1, and stretches of ASCII in UTF-16 or UTF-32 once more without their zeros. Unpacked data is taken in pieces of about
`piece` bytes, cut only where no match can go on, so nothing is left out and memory is bounded unless one match is longer;
every member of a gzip file is read. What damaged or truncated data gave before its end is scanned; such data counts in
`n_unread`, and its bytes are scanned as they are, too. Null texts are scanned as empty ones. Rows are
scanned one by one, in a single pass without a shuffle; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns and the lengths that count.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")  # whole runs of 16 or more
ASSIGN_VALUE, ACCESS_LENGTH = 12, 18

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}")
NEXT_LINE = re.compile(r"[ \t]*(?:\r\n?|\n|\\r\\n|\\n)[ \t>]*([A-Za-z0-9+/_-]+)(={0,2})([ \t]*(?=[\r\n\"'<\\]|\Z))?")
WIDE = re.compile(r"\x00*(?:[\x09-\x0d\x20-\x7e]\x00{1,3}){7,}[\x09-\x0d\x20-\x7e]?")
CUT = re.compile(rb"[,{}();<!*|~^]|(?<=[a-z]{4}) (?=[A-Za-z0-9])")  # no match goes on after these
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")


class Span(NamedTuple):
    start: int
    kind: int
    end: int

    def __str__(self) -> str:
        return f"{KINDS[self.kind]}:{self.start}:{self.end}"


class Layer(NamedTuple):
    """A decoded text; `starts` and `ends` give each character's stretch, or one pair stands for all of them."""

    text: str
    starts: list[int]
    ends: list[int]
    whole: bool

    def span(self, start: int, end: int) -> tuple[int, int]:
        return (self.starts[0], self.ends[0]) if self.whole else (self.starts[start], self.ends[end - 1])


def base_spans(text: str) -> list[Span]:
    """Base matches of a text, by start and then kind."""
    found = []
    low = text.lower()
    if any(w in low for w in WORDS):
        found += [Span(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [Span(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [Span(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every match of a pattern decoded in place; None without a match."""
    parts, starts, ends, at = [], [], [], 0
    for m in pattern.finditer(layer.text):
        for start, end, new in decode(m):
            parts.append(layer.text[at:start] + new)
            if not layer.whole:
                starts += layer.starts[at:start] + [layer.starts[start]] * len(new)
                ends += layer.ends[at:start] + [layer.ends[end - 1]] * len(new)
            at = end
    if not parts:
        return None
    parts.append(layer.text[at:])
    if layer.whole:
        return layer._replace(text="".join(parts))
    return Layer("".join(parts), starts + layer.starts[at:], ends + layer.ends[at:], False)


def _percent(m: re.Match) -> Iterator[tuple[int, int, str]]:
    raw = binascii.unhexlify(m.group().replace("%", ""))
    at = 0
    while at < len(raw):
        first = raw[at]
        length = 1 if first < 0xC0 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        try:
            new = raw[at : at + length].decode()
        except UnicodeDecodeError:
            length, new = 1, "�"
        yield m.start() + 3 * at, m.start() + 3 * (at + length), new
        at += length


def _escape(m: re.Match) -> Iterator[tuple[int, int, str]]:
    code = int(m[3]) if m[3] else int(m[1] or m[2] or m[4], 16)
    if code < 0x110000 and not 0xD800 <= code < 0xE000:
        yield m.start(), m.end(), chr(code)


def _packed(raw: bytes) -> bool:
    return raw[:2] == b"\x1f\x8b" or len(raw) > 1 and raw[0] & 15 == 8 and (raw[0] << 8 | raw[1]) % 31 == 0


def _unpacked(raw: bytes) -> Iterator[bytes | None]:
    """Content of gzip or zlib data, member by member, in small parts; None at last if it is damaged or ends too early."""
    while _packed(raw):
        unpack, at = zlib.decompressobj(47), 0
        while at < len(raw) and not unpack.eof:
            part = raw[at : at + 4096]
            at += len(part)
            try:
                while part:
                    before = unpack.copy()
                    yield unpack.decompress(part, 1 << 20)
                    part = unpack.unconsumed_tail
            except zlib.error:
                yield from _before_damage(before, part)
                yield None
                return
        if not unpack.eof:
            yield unpack.flush()
            yield None
            return
        raw = (unpack.unused_data + raw[at:]).lstrip(b"\0")


def _before_damage(unpack, part: bytes) -> Iterator[bytes]:
    """What a part gives byte by byte up to its error."""
    try:
        for i in range(len(part)):
            yield unpack.decompress(part[i : i + 1])
    except zlib.error:
        return


def _pieces(parts: Iterator[bytes], piece: int) -> Iterator[bytes]:
    """The parts joined to pieces that end where no match goes on."""
    held, size, wanted = [], 0, piece
    for part in parts:
        held.append(part)
        size += len(part)
        if size >= wanted:
            whole = b"".join(held)
            cut = max((m.end() for m in CUT.finditer(whole, max(0, len(whole) - 4096))), default=0)
            cut = cut or max((m.end() for m in CUT.finditer(whole)), default=0)
            if cut:
                yield whole[:cut]
            held, size = [whole[cut:]], len(whole) - cut
            wanted = max(piece, 2 * size)
    if size:
        yield b"".join(held)


def _read(raw: bytes) -> Iterator[str]:
    """The texts that bytes may stand for."""
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        text = raw.decode("latin-1")
    yield text
    if "\0" in text and WIDE.search(text):
        yield WIDE.sub(lambda m: m.group().replace("\0", ""), text)


def scan(text: str | None, piece: int = 1 << 24) -> tuple[list[Span], list[Span], int]:
    """Base spans, all spans, and the number of layers not read to their end."""
    text = text or ""
    base = base_spans(text)
    found, unread = set(base), 0
    worklist = [_below(Layer(text, [], [], False), True, piece)]
    seen: set[tuple[bytes, int]] = set()
    while worklist:
        layer = next(worklist[-1], False)
        if layer is False:
            worklist.pop()
            continue
        if layer is None:
            unread += 1
            continue
        mark = (hashlib.sha256(layer.text.encode("utf-8", "surrogatepass")).digest(), layer.starts[0] if layer.starts else 0)
        if mark in seen:
            continue
        seen.add(mark)
        for hit in base_spans(layer.text):
            start, end = layer.span(hit.start, hit.end)
            found.add(Span(start, hit.kind, end))
        worklist.append(_below(layer, False, piece))
    return base, sorted(found), unread


def _base64_runs(text: str) -> Iterator[tuple[int, int, str, bool]]:
    """Start, end and letters of base64 runs, single lines and lines joined to blocks, and whether a run is no part of a block."""
    done = 0
    for m in BASE64.finditer(text):
        if m.start() < done:
            yield m.start(), m.end(), m.group().rstrip("="), False
            continue
        lines, ended = [(m.start(), m.end(), m.group().rstrip("="))], m.group().endswith("=")
        while not ended and (more := NEXT_LINE.match(text, lines[-1][1])):
            ended = bool(more[2]) or more[3] is None
            if more[3] is None and not more[2] and len(more[1]) % 4 and sum(len(x[2]) for x in lines) % 4 == 0:
                break  # a whole block, then a word of prose
            lines.append((more.start(1), more.end(2), more[1]))
        done = lines[-1][1]
        yield *lines[0], len(lines) == 1
        blocks = [[lines[0]]]
        for line in lines[1:]:
            width = len(blocks[-1][0][2])
            if len(blocks[-1][-1][2]) == width >= len(line[2]):
                blocks[-1].append(line)
            else:
                blocks.append([line])
        for block in [*blocks, *([lines] if len(blocks) > 1 else [])]:
            if len(block) > 1:
                yield block[0][0], block[-1][1], "".join(x[2] for x in block), True


def _below(layer: Layer, first: bool, piece: int) -> Iterator[Layer | None]:
    """The layers found in a layer, and None for each that was not read to its end. The characters of the first one are only numbered when something is decoded in place."""
    text = layer.text
    in_place = [(p, d) for mark, p, d in (("%", PERCENT, _percent), ("\\", ESCAPE, _escape), ("&#", ESCAPE, _escape)) if mark in text and p.search(text)]
    if in_place and first:
        layer = Layer(text, list(range(len(text))), list(range(1, len(text) + 1)), False)
    for pattern, decode in dict(in_place).items():
        new = _replaced(layer, pattern, decode)
        if new is not None:
            yield new
    for at, to, run, alone in _base64_runs(text):
        run = run[: len(run) - (len(run) % 4 == 1)]
        raw = base64.urlsafe_b64decode(run.replace("+", "-").replace("/", "_") + "=" * (-len(run) % 4))
        start, end = (at, to) if first else layer.span(at, to)
        if _packed(raw):
            state = {"whole": True, "some": False}
            for content in _pieces(_noted(_unpacked(raw), state), piece):
                for new in _read(content):
                    yield Layer(new, [start], [end], True)
            if alone and state["some"] and not state["whole"]:
                yield None
            if state["whole"]:
                continue
        for new in _read(raw):
            yield Layer(new, [start], [end], True)


def _noted(parts: Iterator[bytes | None], state: dict[str, bool]) -> Iterator[bytes]:
    for part in parts:
        if part is None:
            state["whole"] = False
        elif part:
            state["some"] = True
            yield part


def redact(text: str | None, mask: str = "[SECRET]") -> str | None:
    """The text with every stretch of spans replaced by the mask."""
    if text is None:
        return None
    out, at = [], 0
    for start, _, end in scan(text)[1]:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: tuple[list, ...] = ([], [], [], [], [], [])
        for text in batch.column(1):
            base, every, unread = scan(text.as_py())
            kinds = [s.kind for s in base]
            row = [kinds.count(0), kinds.count(1), kinds.count(2)]
            row += [hashlib.sha256(",".join(map(str, base)).encode()).hexdigest(), ",".join(map(str, every)), unread]
            for column, value in zip(counts, row):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, t) for c, t in zip(counts, kinds)]],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_unread"],
        )


def secret_spans(documents: DataFrame) -> DataFrame:
    """doc_id, numbers of base spans, their digest, all spans as text, and layers not read to the end."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(
        _digests, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_unread long"
    )


def _redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        columns = list(batch.columns)
        columns[at] = pa.array([redact(text.as_py()) for text in columns[at]], pa.string())
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def redact_documents(documents: DataFrame) -> DataFrame:
    """The documents with all secrets of their texts masked."""
    return documents.mapInArrow(_redacted, documents.schema)
