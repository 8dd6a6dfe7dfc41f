"""WARC archives: a deduplicating writer and a reader that salvages what damage leaves.

Records are written one gzip member each, in files of bounded size, below a folder every executor reaches. The first
page of each payload is a ``response``; the others are ``revisit`` records that name it and carry its digest and
length. The reader checks every record. Where a check fails it searches for the next valid gzip member or, in
uncompressed files, the next version line, goes on from there, and logs the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.llm.common import materialise, working_path

VERSION = b"WARC/1.1"
MAGIC = b"\x1f\x8b\x08"
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_FIELD = re.compile(rb"([!#$%&'*+\-.^_`|~0-9A-Za-z]+):[ \t]*(.*)")
_FIELD_START = re.compile(rb"[!#$%&'*+\-.^_`|~0-9A-Za-z]+:")
#: An archive is closed when it has this many bytes; one record may exceed it.
ARCHIVE_BYTES = 32 << 20
#: Bytes read at once, and the bytes unpacked at once.
CHUNK, PIECE = 1 << 20, 1 << 14

RECORD_SCHEMA = ("archive string, position long, stored long, record_type string, page_id string, refers_to string, "
                 "uri string, payload_digest string, payload_bytes long, payload binary, problem string")


def digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1 of a payload."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(kind: str, page: str, uri: str, payload: bytes, refers_to: str | None) -> bytes:
    """One record. A revisit has an empty block; its digest and length are those of the full payload."""
    block = payload if kind == "response" else b""
    # Header values are one line each: line ends in a uri are escaped.
    clean = uri.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{page}>"), ("WARC-Target-URI", clean),
        ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("WARC-Payload-Length", str(len(payload))),
    ]
    if kind == "revisit":
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields += [("Content-Type", "application/octet-stream"), ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + b"\r\n"
    return head + block + b"\r\n\r\n"


def member(data: bytes, level: int = 3) -> bytes:
    """One gzip member without a time stamp, so that a repeated task writes the same bytes."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Damaged(ValueError):
    """A record that fails a check."""


@dataclass
class Record:
    fields: dict[str, str]
    block: bytes

    def row(self, archive: str, position: int, stored: int) -> dict:
        ident = lambda name: (self.fields.get(name) or "").removeprefix("<urn:page:").removesuffix(">") or None
        uri = self.fields.get("warc-target-uri")
        kind = self.fields.get("warc-type")
        length = self.fields.get("warc-payload-length") or str(len(self.block))
        return {
            "archive": archive, "position": position, "stored": stored, "record_type": kind, "page_id": ident("warc-record-id"),
            "refers_to": ident("warc-refers-to"),
            "uri": uri and uri.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%"),
            "payload_digest": (self.fields.get("warc-payload-digest") or f"sha1:{digest(self.block)}").removeprefix("sha1:"),
            "payload_bytes": int(length) if length.isdigit() else len(self.block),
            "payload": self.block if kind != "revisit" else None, "problem": None,
        }


def parse_record(data: bytes, whole: bool = True) -> tuple[Record, int]:
    """The record at the start of ``data`` and its length. ``Damaged`` if a check fails: version line, header
    lines, length, end of the block, block digest, payload digest of a response, and nothing left over if ``whole``."""
    if not _VERSION_LINE.match(data):
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise Damaged("header without end")
    fields: dict[str, str] = {}
    for line in data[:end].split(b"\r\n")[1:]:
        found = _FIELD.fullmatch(line)
        if not found:
            raise Damaged("header line")
        try:
            fields[found[1].decode().lower()] = found[2].decode()
        except UnicodeDecodeError:
            raise Damaged("header text") from None
    length = fields.get("content-length", "")
    if not length.isdigit():
        raise Damaged("no length")
    start, size = end + 4, int(length)
    block = data[start:start + size]
    if len(block) < size or data[start + size:start + size + 4] != b"\r\n\r\n":
        raise Damaged("block cut off or of another length")
    stop = start + size + 4
    if whole and stop != len(data):
        raise Damaged("bytes after the record")
    for name, wanted in (("warc-block-digest", True), ("warc-payload-digest", fields.get("warc-type") == "response")):
        if wanted and name in fields and fields[name] != f"sha1:{digest(block)}":
            raise Damaged(name)
    return Record(fields, block), stop


class Window:
    """The unread part of a stream, from ``at`` on; grows by chunks and drops what is behind now and then."""

    def __init__(self, read: Callable[[int], bytes]):
        self.read, self.data, self.at, self.base, self.ended = read, b"", 0, 0, False

    def __len__(self) -> int:
        return len(self.data) - self.at

    @property
    def position(self) -> int:
        return self.base + self.at

    def more(self) -> bool:
        if self.ended:
            return False
        # A doubling read keeps the cost of a large record in proportion to its length.
        chunk = self.read(max(CHUNK, len(self)))
        self.ended = not chunk
        self.data, self.base, self.at = self.data[self.at:] + chunk, self.base + self.at, 0
        return not self.ended

    def head(self, n: int) -> bytes:
        return self.data[self.at:self.at + n]

    def find(self, what: bytes, start: int, stop: int | None = None) -> int:
        """Place of ``what`` counted from ``at``, or -1."""
        found = self.data.find(what, self.at + start, len(self.data) if stop is None else self.at + stop)
        return found - self.at if found >= 0 else -1

    def forget(self, n: int) -> None:
        self.at += n


def _next_member(w: Window) -> tuple[Record, int]:
    """The record in the gzip member at the start of the window and the member's length."""
    if w.head(3) != MAGIC:
        raise Damaged("no gzip member")
    unpacker, out, used = zlib.decompressobj(31), [], 0
    while True:
        if used == len(w) and not w.more():
            raise Damaged("gzip member cut off")
        piece = w.data[w.at + used:w.at + used + PIECE]
        try:
            out.append(unpacker.decompress(piece))
        except zlib.error as e:
            raise Damaged(f"gzip: {e}") from None
        used += len(piece) - len(unpacker.unused_data)
        if unpacker.eof:
            return parse_record(b"".join(out))[0], used


def _next_plain(w: Window) -> tuple[Record, int]:
    if w.head(7) != b"WARC/1.":
        raise Damaged("no version line")
    # A header may be of any length, but each of its lines must be one: damage ends the search at the first that is none.
    version = _VERSION_LINE.match(w.head(16))
    if not version:
        raise Damaged("no version line")
    at, length = version.end(), None
    while True:
        stop = w.find(b"\r\n", at)
        while stop < 0:
            # Field names are short; what has no colon soon is no field, however far its line goes.
            if not _FIELD_START.match(w.head(at + 256)[at:]) and len(w) >= at + 256:
                raise Damaged("header line")
            seen = max(at, len(w) - 1)
            if not w.more():
                raise Damaged("header without end")
            stop = w.find(b"\r\n", seen)
        if stop == at:
            break
        found = _FIELD.fullmatch(w.head(stop)[at:])
        if not found:
            raise Damaged("header line")
        if found[1].lower() == b"content-length":
            length = found[2]
        at = stop + 2
    if length is None or not re.fullmatch(rb"\d{1,15}", length):
        raise Damaged("no length")
    size = at + 2 + int(length) + 4
    while len(w) < size and w.more():
        pass
    return parse_record(w.head(size), whole=False)


def salvage(archive: str, read: Callable[[int], bytes]) -> Iterator[dict]:
    """Rows of ``RECORD_SCHEMA`` from a stream: records, and a row with ``problem`` for each quarantined gap.

    A gap runs from the first byte that failed a check to the next byte at which a whole record passes all of them. At
    most one record, and the bytes searched so far, are held.
    """
    w = Window(read)
    gap_at, why = None, ""

    def gap(stop: int) -> dict:
        return dict.fromkeys(("record_type", "page_id", "refers_to", "uri", "payload_digest", "payload_bytes", "payload")) | {
            "archive": archive, "position": gap_at, "stored": stop - gap_at, "problem": why}

    while len(w) or w.more():
        # Starts that a chunk's end may cut need a few bytes more.
        while len(w) < 16 and w.more():
            pass
        try:
            record, used = _next_member(w) if w.head(2) == MAGIC[:2] else _next_plain(w)
        except Damaged as e:
            if gap_at is None:
                gap_at, why = w.position, str(e)
            step = 1
            while True:
                starts = [k for k in (w.find(MAGIC, step), w.find(b"WARC/1.", step)) if k >= 0]
                if starts:
                    w.forget(min(starts))
                    break
                w.forget(max(len(w) - 8, min(step, len(w))))
                step = 0
                if not w.more():
                    w.forget(len(w))
                    break
            continue
        if gap_at is not None:
            yield gap(w.position)
            gap_at = None
        yield record.row(archive, w.position, used)
        w.forget(used)
    if gap_at is not None:
        yield gap(w.position)


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record per row into archives below ``folder``; returns ``(archive, records, bytes)``.

    Payloads of at least ``min_bytes`` are told apart by digest and length: the row of smallest id is the response, rows
    of other ids revisit it. Rows that share the smallest id are responses alike. Null ids come after
    all others and are written as empty ids. Null html is an empty payload. The join that names
    the response meets narrow rows per digest on one side; a payload with very many pages is split there.
    """
    source = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"),
                          F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    keyed = source.withColumn("key", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    first = keyed.where(F.col("size") >= min_bytes).groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("key", "first")
    marked = keyed.join(first, "key", "left").select(
        F.col("page_id").cast("string").alias("page"), "url", "payload",
        F.when(F.col("first") != F.col("page_id"), F.col("first")).when(F.col("page_id").isNull(), F.col("first")).cast("string").alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        fs, base = _filesystem(folder)
        state: dict = {"out": None, "n": 0, "number": 0, "bytes": 0}
        done: list[tuple[str, int, int]] = []

        def close():
            if state["out"] is not None:
                state["out"].close()
                # An attempt writes under its own name; the last step gives the file the task's name.
                fs.move(state["path"], state["final"])
                done.append((state["final"], state["n"], state["bytes"]))
                state.update(out=None, n=0, bytes=0, number=state["number"] + 1)

        for batch in batches:
            for page, uri, payload, refers in zip(*(batch.column(i) for i in range(4)), strict=True):
                refers = refers.as_py()
                data = member(record_bytes("response" if refers is None else "revisit", page.as_py() or "", uri.as_py() or "", payload.as_py(), refers))
                if state["out"] is None:
                    name = f"part-{context.partitionId():06d}-{state['number']:05d}"
                    state["path"] = f"{base}/_attempts/{name}-{context.taskAttemptId()}-{uuid.uuid4().hex}"
                    state["final"] = f"{base}/{name}.warc.gz"
                    fs.create_dir(f"{base}/_attempts", recursive=True)
                    state["out"] = fs.open_output_stream(state["path"], compression=None)
                state["out"].write(data)
                state["n"] += 1
                state["bytes"] += len(data)
                if state["bytes"] >= archive_bytes:
                    close()
        close()
        columns = list(zip(*done, strict=True)) if done else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
                                         names=["archive", "records", "bytes"])

    return marked.mapInArrow(run, "archive string, records long, bytes long")


def read_archives(spark: SparkSession, folder: str, archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Rows of ``RECORD_SCHEMA`` from the files named in ``archives``: records and quarantined gaps.

    Files are dealt out one by one and streamed. ``payloads=False`` leaves the payload column null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = _filesystem(folder)
        names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in RECORD_SCHEMA.split(", ")])
        rows, held = [], 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], schema.field(n).type) for n in names], schema=schema)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                with fs.open_input_stream(path, compression=None) as stream:
                    for row in salvage(path.rsplit("/", 1)[-1], stream.read):
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        held += 500 + len(row["payload"] or b"")
                        if held > 8 << 20:
                            yield flush()
                            rows, held = [], 0
        if rows:
            yield flush()

    names = archives.select("archive").distinct()
    # A task per file: the names are distinct, so their ranges deal them out evenly, and a fixed number is not coalesced.
    return names.repartitionByRange(max(1, min(names.count(), 20_000)), "archive").mapInArrow(run, RECORD_SCHEMA)


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives and read them back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    Every row gives a row, or the call fails; ids have the type they had. An empty table gives none.
    """
    spark = pages.sparkSession
    folder = working_path(spark, "warc")
    written = materialise(write_archives(pages, folder, page_id, url, html, min_bytes), "warc-archives")
    kind = pages.schema[page_id].dataType
    records = read_archives(spark, folder, written, payloads=False)
    back = materialise(records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem"), "warc-records")
    count = F.coalesce(F.sum("records"), F.lit(0))
    expected = written.agg(count).first()[0]
    found, gaps = back.agg(F.count_if(F.col("problem").isNull()), F.count("problem")).first()
    if gaps or found != expected:
        raise RuntimeError(f"{expected} records were written to {folder}; {found} were read back, with {gaps} quarantined gaps")
    return back.select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
