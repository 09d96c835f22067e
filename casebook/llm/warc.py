"""WARC archives of pages: written record by record, read back by a reader that salvages damaged files.

Writing: every record is a gzip member of its own. Pages whose payload (UTF-8 of the html, null: empty) has at least
`least` bytes and occurs before (under a smaller page_id) become revisit records; these name the record they repeat and
carry its HTTP head, whose Content-Length is that of the full payload. Every task writes files under names of its own
and returns them as rows, so files of lost or repeated attempts are never read. Rows that repeat a page_id with the same
payload are all responses; rows without page_id are responses. Line breaks and blanks in a url are written as %XX.

Reading: archives are read through a sliding window, gzip members or plain records. When a member cannot be
unpacked, ends early, has no version line, another length than declared or another payload digest, the reader searches
the next gzip magic or version line from which a valid record can be read, goes on there, and logs the bytes between.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import settle
from casebook.sources.durable import new_place

MAGIC, VERSION = b"\x1f\x8b\x08", b"WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "archive string, from_byte long, to_byte long, damage string, payload binary"
)
_SCHEMA = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    + [("record_type", pa.string()), ("refers_to", pa.int64()), ("archive", pa.string()), ("from_byte", pa.int64())]
    + [("to_byte", pa.int64()), ("damage", pa.string()), ("payload", pa.binary())]
)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record, not compressed."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {target}"] if url is not None else []),
        f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"] if refers_to is not None else []),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _open(uri: str):
    return pyarrow.fs.FileSystem.from_uri(uri)


def _writer(folder: str, archive_bytes: int, level: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open(folder)
        fs.create_dir(path, recursive=True)
        out, name, size, records = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pylist([{"archive": name, "records": records, "bytes": size}])

        for batch in batches:
            for row in zip(*[batch.column(i) for i in range(5)]):
                page_id, url, html, digest, refers_to = (x.as_py() for x in row)
                if out is None:
                    file = f"{uuid.uuid4().hex}.warc.gz"
                    name, out, size, records = f"{folder}/{file}", fs.open_output_stream(f"{path}/{file}", compression=None), 0, 0
                pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                data = pack.compress(record(page_id, url, (html or "").encode(), digest, refers_to, date)) + pack.flush()
                out.write(data)
                size, records = size + len(data), records + 1
                if size >= archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return run


def write_archives(
    pages: DataFrame, folder: str, least: int = 100, archive_bytes: int = 64 << 20, level: int = 1,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write page_id, url and html of `pages` to archives under `folder`; the files that count, as rows."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha2(payload, 256).alias("digest"))
    seen = settle(rows.select("page_id", "digest", F.octet_length(F.coalesce("html", F.lit(""))).alias("n")), "warc-digests")
    firsts = (
        seen.where(F.col("n") >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
        .where(F.col("refers_to") < F.col("last"))
        .drop("last")
    )
    firsts = settle(firsts, "warc-firsts")
    repeats = seen.join(firsts, "digest").where(F.col("page_id") > F.col("refers_to")).distinct()
    ready = rows.join(repeats.drop("n"), ["page_id", "digest"], "left").select("page_id", "url", "html", "digest", "refers_to")
    written = ready.mapInArrow(_writer(folder, archive_bytes, level, date), "archive string, records long, bytes long")
    return settle(written, "warc-files")


class _Window:
    """Random reads near one moving place of a file."""

    def __init__(self, file, step: int = 4 << 20):
        self.file, self.size, self.step = file, file.size(), step
        self.start, self.data = 0, b""

    def read(self, at: int, n: int) -> bytes:
        if at < self.start or at + n > self.start + len(self.data):
            self.file.seek(at)
            self.start, self.data = at, self.file.read(min(max(n, self.step), max(0, self.size - at)))
        return self.data[at - self.start : at - self.start + n]

    def find(self, at: int) -> int:
        """The next place, from `at`, where a member or plain record may begin; the end of the file if none."""
        while at < self.size:
            data = self.read(at, min(self.step, self.size - at))
            hits = [i for i in (data.find(MAGIC), data.find(VERSION)) if i >= 0]
            if hits:
                return at + min(hits)
            at += max(1, len(data) - len(VERSION) + 1) if at + len(data) < self.size else len(data)
        return self.size


    def find_blank_line(self, at: int) -> int:
        """Where the next empty line ends a head, from `at`; -1 if nowhere in the file."""
        step = 1 << 14
        while at < self.size:
            hit = self.read(at, min(step, self.size - at)).find(b"\r\n\r\n")
            if hit >= 0:
                return at + hit
            at += max(1, min(step, self.size - at) - 3)
            step = min(step << 1, self.step)
        return -1


class Damage(Exception):
    pass


def _unpacked(window: _Window, at: int) -> tuple[bytes, int]:
    """The content of the gzip member at a place, and where it ends."""
    unpack, out, pos = zlib.decompressobj(31), [], at
    while not unpack.eof:
        chunk = window.read(pos, min(1 << 14, window.size - pos))
        if not chunk:
            raise Damage("member ends early")
        try:
            out.append(unpack.decompress(chunk))
        except zlib.error as error:
            raise Damage(f"member cannot be unpacked: {error}") from None
        pos += len(chunk)
    return b"".join(out), pos - len(unpack.unused_data)


def _plain(window: _Window, at: int) -> tuple[bytes, int]:
    """The plain record at a place, and where it ends."""
    end = window.find_blank_line(at)
    if end < 0:
        raise Damage("head has no end")
    head = _head(window.read(at, end - at))
    length = end - at + 4 + _length(head) + 4
    if at + length > window.size:
        raise Damage("record ends early")
    return window.read(at, length), at + length


def _head(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise Damage("no version line")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def _length(head: dict[str, str]) -> int:
    if not head.get("content-length", "").isdecimal():
        raise Damage("no length")
    return int(head["content-length"])


def _number(urn: str | None) -> int | None:
    text = (urn or "").strip("<>").rpartition(":")[2]
    return int(text) if text.lstrip("-").isdecimal() else None


def parse(data: bytes) -> dict:
    """The checked fields of one whole record."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise Damage("head has no end")
    head = _head(data[:end])
    block = data[end + 4 : -4]
    if len(block) != _length(head) or not data.endswith(b"\r\n\r\n"):
        raise Damage("another length than declared")
    kind = head.get("warc-type", "")
    http, _, payload = block.partition(b"\r\n\r\n")
    declared = [x.split(b":", 1)[1].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    digest = head.get("warc-payload-digest", "").removeprefix("sha256:")
    if kind == "response" and digest and hashlib.sha256(payload).hexdigest() != digest:
        raise Damage("another payload digest than declared")
    size = len(payload) if kind == "response" else int(declared[0]) if declared and declared[0].isdigit() else None
    return {
        "page_id": _number(head.get("warc-record-id")), "url": head.get("warc-target-uri"), "payload_bytes": size,
        "payload_digest": digest, "record_type": kind, "refers_to": _number(head.get("warc-refers-to")), "payload": payload,
    }


def salvage(file) -> Iterator[dict]:
    """Records of an open archive; damaged stretches as rows with from_byte, to_byte and the damage alone."""
    window, at, gap, reason = _Window(file), 0, None, ""
    while at < window.size:
        try:
            start = window.read(at, min(len(VERSION), window.size - at))
            if start.startswith(MAGIC):
                data, end = _unpacked(window, at)
            elif start == VERSION:
                data, end = _plain(window, at)
            else:
                raise Damage("neither member nor version line")
            found = parse(data)
        except Damage as damage:
            if gap is None:
                gap, reason = at, str(damage)
            at = window.find(at + 1)
            continue
        if gap is not None:
            yield {"from_byte": gap, "to_byte": at, "damage": reason}
            gap = None
        yield found | {"from_byte": at, "to_byte": end}
        at = end
    if gap is not None:
        yield {"from_byte": gap, "to_byte": window.size, "damage": reason}


def _reader(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, path = _open(name)
                rows, held = [], 0
                with fs.open_input_file(path) as file:
                    for row in salvage(file):
                        held += len(row.get("payload") or b"") if with_payload else 0
                        rows.append(row | {"archive": name} | ({} if with_payload else {"payload": None}))
                        if len(rows) >= 2000 or held >= 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    return run


def read_archives(archives: DataFrame, with_payload: bool = False, task_bytes: int = 64 << 20) -> DataFrame:
    """Records and damaged stretches (rows with `damage`) of the archives named in the column `archive`.

    The tasks that read follow the column `bytes`, `task_bytes` each, and use all cores for less; without that column
    every archive has a task. Their number is stated, as the file names alone would be merged into few tasks.
    """
    size = F.sum("bytes") if "bytes" in archives.columns else F.count("*") * task_bytes
    files, held = archives.agg(F.count("*"), size).first()
    least = archives.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(files, max(least, -(-int(held or 0) // task_bytes))))
    return archives.select("archive").repartition(tasks).mapInArrow(_reader(with_payload), RECORDS)


def read_back(archives: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records without payloads, and the gaps (archive, from_byte, to_byte, damage): both stored by one reading."""
    read = settle(read_archives(archives).drop("payload"), "warc-records")
    return read.where("damage is null").drop("damage"), read.where("damage is not null").select("archive", "from_byte", "to_byte", "damage")


def archived_pages(pages: DataFrame, least: int = 100) -> DataFrame:
    """Write `pages` to archives in the shared folder and read them back: a row per record."""
    records, _ = read_back(write_archives(pages, new_place(pages.sparkSession, "warc"), least))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
