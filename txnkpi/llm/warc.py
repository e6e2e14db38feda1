"""WARC archives: written from a table of pages, read back record by record.

An archive is a run of gzip members, one for each record, so it can be read from any member on.
The reader goes through a file once: it inflates a member in small steps, frames the record by
its ``Content-Length`` and hashes block and payload while they pass, so the size of a record is
bounded by nothing but its payload, and by little if payloads are not asked for. A record whose
framing, checksum or digests are wrong is reported in ``problem``; after broken framing the
reader looks for the next member that begins a record.

Equal payloads of at least ``least_bytes`` are stored once: the row with the smallest id is a
``response``, the others are ``revisit`` records that name it. Digests are SHA-256 of the full
payload, in hexadecimal.

Writing: every task writes files of its own names straight to the shared folder and returns
them as rows of a manifest table. Files of a task that was run again or lost are in no
manifest, and readers take files from the manifest only.

Defined cases: a NULL payload is empty; a NULL id comes after all others and is read back as
NULL, and so is a NULL address; of rows with equal id and payload one is the response and the
others revisit it. Blanks, control and non-ASCII characters of an address are percent-encoded.
An empty table gives no archives and no rows; further columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnkpi.llm.common import small, written
from txnkpi.sources import paths

VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
GZIP = b"\x1f\x8b\x08"
STEP = 1 << 16
MOST_HEADER = 1 << 20
VISIBLE = "".join(map(chr, range(33, 127)))

MANIFEST = "file string, records bigint"
RECORD = (
    "file string, offset bigint, record_id string, record_type string, row_id string, url string, refers_to_id string, "
    "payload_bytes bigint, payload_digest string, payload binary, problem string"
)


@dataclass(frozen=True)
class Settings:
    #: Shorter payloads are stored each time; an archive is closed beyond this size.
    least_bytes: int = 100
    most_file_bytes: int = 256 * 2**20
    date: str = "1970-01-01T00:00:00Z"


# --- writing


def planned(pages: DataFrame, cfg: Settings, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """Rows to write: id, url, payload, its digest and length, and the record it revisits, if any."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({
        "digest": F.sha2("payload", 256), "n": F.octet_length("payload").cast("bigint"), "row": F.monotonically_increasing_id(),
    })
    rows = written(rows, "pages")  # from here on a row's number stays its own
    record = F.md5(F.concat_ws(":", "digest", "row"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row", record.alias("record"))).alias("first")
    firsts = rows.filter(F.col("n") >= cfg.least_bytes).groupBy("digest").agg(F.count("*").alias("c"), first).filter("c > 1")
    firsts = small(written(firsts.select("digest", F.col("first.row").alias("first"), F.col("first.record").alias("refers")), "firsts"))
    refers = F.when(F.col("row") != F.col("first"), F.col("refers"))
    return rows.join(firsts, "digest", "left").select(
        F.col("id").cast("string").alias("id"), F.col("url").cast("string").alias("url"), record.alias("record"), refers.alias("refers"),
        "digest", "n", F.when(refers.isNull(), F.col("payload")).alias("payload"),
    )


def _urn(record: str) -> str:
    return f"<urn:uuid:{uuid.UUID(record)}>"


def _member(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    headers = [*headers, ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()), ("Content-Length", str(len(block)))]
    lines = [VERSION, *(f"{name}: {value}".encode() for name, value in headers if value is not None)]
    return gzip.compress(b"\r\n".join(lines) + END + block + END, compresslevel=6, mtime=0)


def _record(row: dict, date: str) -> bytes:
    """One row as a gzip member."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['n']}".encode() + END
    headers = [
        ("WARC-Type", "response" if row["refers"] is None else "revisit"), ("WARC-Record-ID", _urn(row["record"])), ("WARC-Date", date),
        ("WARC-Target-URI", None if row["url"] is None else quote(row["url"], safe=VISIBLE)),
        ("WARC-Payload-Digest", "sha256:" + row["digest"]), ("X-Row-ID", row["id"]), ("Content-Type", "application/http; msgtype=response"),
    ]
    if row["refers"] is None:
        return _member(headers, head + row["payload"])
    headers += [("WARC-Refers-To", _urn(row["refers"])), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return _member(headers, head)


def write_archives(
    pages: DataFrame, folder: str, cfg: Settings = Settings(), id_col: str = "page_id", url_col: str = "url", payload_col: str = "html"
) -> DataFrame:
    """Write a record per row to archives in a shared folder; returns their manifest, written too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, name, count, size = None, "", 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, count = store.open_output_stream(f"{base}/{name}", compression=None), 0
                    info = b"software: txnkpi\r\nformat: WARC File Format 1.1\r\n"
                    about = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _urn(uuid.uuid4().hex)), ("WARC-Date", cfg.date)]
                    size = out.write(_member([*about, ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], info))
                size += out.write(_record(row, cfg.date))
                count += 1
                if size >= cfg.most_file_bytes:
                    out.close()
                    out = None
                    yield closed(name, count)
        if out is not None:
            out.close()
            yield closed(name, count)

    def closed(name: str, count: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([count], pa.int64())], ["file", "records"])

    return written(planned(pages, cfg, id_col, url_col, payload_col).mapInArrow(run, MANIFEST), "manifest")


# --- reading


class Broken(ValueError):
    """A member that is no whole record."""


class Member:
    """The bytes of the gzip member that starts at ``offset``, inflated as they are asked for."""

    def __init__(self, stream, offset: int):
        stream.seek(offset)
        self.stream, self.offset, self.fed = stream, offset, 0
        self.inflate, self.raw, self.ready = zlib.decompressobj(31), b"", b""

    def more(self) -> bool:
        """Inflate a little further; False at the member's end, which zlib has checked then."""
        while not self.inflate.eof:
            if not self.raw:
                self.raw = self.stream.read(STEP)
                self.fed += len(self.raw)
                if not self.raw:
                    raise Broken("file ends inside a member")
            try:
                piece = self.inflate.decompress(self.raw, STEP)
            except zlib.error as e:
                raise Broken(str(e)) from e
            self.raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if piece:
                self.ready += piece
                return True
        return False

    @property
    def end(self) -> int:
        """Where the next member starts, once this one is at its end."""
        return self.offset + self.fed - len(self.raw)

    def until(self, mark: bytes, most: int) -> bytes:
        """Bytes up to a mark, which is passed over."""
        while (at := self.ready.find(mark)) < 0:
            if len(self.ready) > most or not self.more():
                raise Broken("header without end")
        found, self.ready = self.ready[:at], self.ready[at + len(mark) :]
        return found

    def pieces(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes, as they come."""
        while n:
            if not self.ready and not self.more():
                raise Broken("record shorter than its Content-Length")
            piece, self.ready = self.ready[:n], self.ready[n:]
            n -= len(piece)
            yield piece


@dataclass
class Record:
    offset: int
    headers: dict[str, str] = field(default_factory=dict)
    payload_bytes: int | None = None
    payload_digest: str | None = None
    payload: bytes | None = None
    problem: str | None = None


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _length(headers: dict[str, str]) -> int:
    value = headers.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", value):
        raise Broken("no Content-Length")
    return int(value)


def _bare(digest: str | None) -> str | None:
    """The hexadecimal of a labelled SHA-256 digest; other digests are not checked."""
    label, _, value = (digest or "").partition(":")
    return value.lower() if label.lower() in ("sha256", "sha-256") else None


def _read(member: Member, keep: bool) -> Record:
    """The record in a member, to the member's end."""
    lines = member.until(END, MOST_HEADER).split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise Broken("not a WARC record")
    record = Record(member.offset, _fields(lines[1:]))
    block, payload, head, kept = hashlib.sha256(), hashlib.sha256(), b"", []
    http = record.headers.get("content-type", "").startswith("application/http")
    size, inside = 0, not http
    for piece in member.pieces(_length(record.headers)):
        block.update(piece)
        if not inside:
            head += piece
            at = head.find(END)
            if at < 0:
                if len(head) > MOST_HEADER:
                    raise Broken("HTTP header without end")
                continue
            inside, piece, head = True, head[at + len(END) :], head[:at]
        payload.update(piece)
        size += len(piece)
        if keep:
            kept.append(piece)
    if b"".join(member.pieces(len(END))) != END:
        raise Broken("record longer than its Content-Length")
    if member.ready or member.more():
        raise Broken("more than one record in a member")
    told, own = _bare(record.headers.get("warc-payload-digest")), payload.hexdigest()
    if _bare(record.headers.get("warc-block-digest")) not in (None, block.hexdigest()):
        record.problem = "block digest differs"
    if record.headers.get("warc-type") == "revisit":
        record.payload_digest = told
        record.payload_bytes = _length(_fields(head.split(b"\r\n")[1:]))
    else:
        record.payload_digest, record.payload_bytes = own, size
        record.payload = b"".join(kept) if keep else None
        if told not in (None, own):
            record.problem = "payload digest differs"
    return record


def _next_member(stream, offset: int) -> int | None:
    """Where the next member that begins a record starts, from ``offset`` on."""
    stream.seek(offset)
    tail, at = b"", offset
    while data := stream.read(STEP):
        data, at = tail + data, at - len(tail)
        found = data.find(GZIP)
        while found >= 0:
            member = Member(stream, at + found)
            try:
                while len(member.ready) < 5 and member.more():
                    pass
            except Broken:
                pass
            if member.ready.startswith(b"WARC/"):
                return at + found
            found = data.find(GZIP, found + 1)
        at, tail = at + len(data), data[-2:]
        stream.seek(at)
    return None


def records(stream, keep: bool = False) -> Iterator[Record]:
    """All records of a seekable stream, in order."""
    offset, size = 0, stream.size()
    while offset is not None and offset < size:
        member = Member(stream, offset)
        try:
            yield _read(member, keep)
            offset = member.end
        except Broken as e:
            yield Record(offset, problem=str(e))
            offset = _next_member(stream, offset + 1)


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """All records of the archives (column ``file``) of a written manifest; ``payloads`` adds their bytes."""
    limit = 8 * 2**20

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                store, path = fs.FileSystem.from_uri(file)
                with store.open_input_file(path) as stream:
                    out, size = [], 0
                    for r in records(stream, payloads):
                        get = r.headers.get
                        out.append((
                            file, r.offset, get("warc-record-id"), get("warc-type"), get("x-row-id"), get("warc-target-uri"),
                            get("warc-refers-to"), r.payload_bytes, r.payload_digest, r.payload, r.problem,
                        ))
                        size += 500 + len(r.payload or b"")
                        if size > limit:
                            yield table(out)
                            out, size = [], 0
                    if out:
                        yield table(out)

    text, number = pa.string(), pa.int64()
    types = [text, number, text, text, text, text, text, number, text, pa.binary(), text]
    names = [column.split()[0] for column in RECORD.split(", ")]

    def table(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    tasks = max(1, min(manifest.count(), 100_000))
    return manifest.select("file").repartition(tasks).mapInArrow(run, RECORD)


def resolved(read: DataFrame) -> DataFrame:
    """Pages of records read: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A record with a problem, or a revisit whose response is missing or has another payload, is
    an error.
    """
    failed = F.raise_error(F.concat(F.lit("archive "), "file", F.lit(" at "), F.col("offset").cast("string"), F.lit(": "), "problem"))
    sound = F.when(F.col("problem").isNotNull(), failed.cast("string")).otherwise(F.col("record_type"))
    read = written(read.withColumn("record_type", sound).drop("payload", "url"), "records").filter("record_type != 'warcinfo'")
    wanted = read.filter("refers_to_id is not null").select(F.col("refers_to_id").alias("record_id")).distinct()
    firsts = read.join(wanted, "record_id").select(
        F.col("record_id").alias("refers_to_id"), F.col("row_id").alias("refers_to"), F.col("payload_digest").alias("digest"), F.col("payload_bytes").alias("bytes")
    )
    rows = read.join(small(written(firsts, "responses")), "refers_to_id", "left")
    wrong = F.col("refers_to_id").isNotNull() & ~(
        F.col("digest").eqNullSafe(F.col("payload_digest")) & F.col("bytes").eqNullSafe(F.col("payload_bytes"))
    )
    kind = F.when(wrong, F.raise_error(F.concat(F.lit("unresolved revisit "), "record_id")).cast("string")).otherwise(F.col("record_type"))
    return rows.select(
        F.col("row_id").alias("page_id"), "payload_bytes", "payload_digest", kind.alias("record_type"), "refers_to"
    )


def archived(
    pages: DataFrame, cfg: Settings = Settings(), id_col: str = "page_id", url_col: str = "url", payload_col: str = "html"
) -> DataFrame:
    """Write archives of all pages to the shared folder, read them back, one row per page."""
    folder = paths.scratch(pages.sparkSession, "warc")
    found = resolved(read_archives(write_archives(pages, folder, cfg, id_col, url_col, payload_col)))
    kind = pages.schema[id_col].dataType
    return found.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})
