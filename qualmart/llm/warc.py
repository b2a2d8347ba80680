"""WARC archives: a writer with revisit records and a reader that salvages damaged files.

Archives are ``.warc.gz`` files, one gzip member per record, written by the tasks into a folder
that all executors share (opened through its URI, so any file system that Arrow knows will do).
Each task attempt writes files of its own; a manifest names those of the attempts that succeeded,
and only these are read.

The reader takes versions 0.17 to 1.1. Header names count regardless of case, lines may be folded, and
the blank behind a colon may lack. It checks each record (gzip member and its checksum, version line,
header, length, block and payload digest); digests may be MD5 or SHA-1 to SHA-512, in hexadecimal or
base32 of either case, and those of any other kind are not checked. When a check fails it looks for the next member or version line, whatever the
file began with, that passes all checks, goes on from there, and reports the bytes in between as a
quarantined gap. It holds one record at a time, of at most ``MAX_RECORD`` bytes, and reads a plain
record's body only if it ends where its header says.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualmart.llm.common import join_counted
from qualmart.session import materialize, scratch_path

#: Payloads from this size on are stored once; smaller ones are always written whole.
REVISIT_BYTES = 1000
#: A task begins another archive file when one has reached this size.
ROLL_BYTES = 32 << 20
#: Stored with every record; pages carry no capture time.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_CHUNK = 1 << 20
_MAGIC = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/(?:0\.1[78]|1\.[01])\r\n")
_MARK = re.compile(re.escape(_MAGIC) + b"|" + _VERSION.pattern)
_END = b"\r\n\r\n"
#: The reader holds no more of one record than this; a longer one is reported as a gap.
MAX_RECORD = 512 << 20
#: Hash functions that are checked, with the bytes of their values.
_KINDS = {"md5": 16, "sha1": 20, "sha256": 32, "sha384": 48, "sha512": 64}


# ------------------------------------------------------------------ writing

def plan_records(pages: DataFrame, *, id_col: str = "page_id", payload_col: str = "html",
                 url_col: str = "url", revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): ``refers_to`` is null for responses.

    Of records with equal payloads of at least ``revisit_bytes`` bytes the one with the largest id
    is the response. A null payload is empty. Repeated rows of a response's id are responses; rows
    without an id revisit the response, or are responses if no equal payload has an id.
    """
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                     F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("digest", F.sha1("payload"))
    large = p.where(F.octet_length("payload") >= revisit_bytes).groupBy("digest")
    first = materialize(large.agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
                             .where("n > 1 AND first IS NOT NULL"), "warc-repeated")
    out = join_counted(p, first, "digest", "n", how="left")
    return out.select("page_id", "url", "payload", "digest", F.when(
        F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first")).alias("refers_to"))


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record with an HTTP response block; a revisit's block has the HTTP header alone."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    name = "" if page_id is None else page_id
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Date", DATE)]
    if url:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head += [("WARC-Payload-Digest", _digest(payload)), ("WARC-Block-Digest", _digest(block)),
             ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + _END


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_archives(planned: DataFrame, folder: str, *, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write the records of ``plan_records`` below ``folder``; returns the manifest (path, bytes,
    records), written and read back, so that each archive is written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = pafs.FileSystem.from_uri(folder)
        out, done = None, []
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    target.create_dir(base, recursive=True)
                    name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = target.open_output_stream(f"{base}/{name}", compression=None)
                data = _member(record(page_id, url, payload, refers_to))
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= roll_bytes:
                    out.close()
                    out = done.append((f"{folder}/{name}", size, n))
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", size, n))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*done, strict=True) if done else [[]] * 3,
                                                  (pa.string(), pa.int64(), pa.int64()), strict=True)],
            ["path", "bytes", "records"])

    columns = planned.select("page_id", "url", "payload", "refers_to")
    return materialize(columns.mapInArrow(run, "path string, bytes long, records long"), "warc-manifest")


# ------------------------------------------------------------------ reading

class _Reader:
    """Reads anywhere in a file through a buffer of a few chunks."""

    def __init__(self, file: pa.NativeFile):
        self._file, self.size = file, file.size()
        self._at, self._data = 0, b""

    def get(self, at: int, n: int) -> bytes:
        if not (self._at <= at and at + n <= self._at + len(self._data)):
            self._file.seek(at)
            self._at, self._data = at, self._file.read(max(n, _CHUNK))
        return self._data[at - self._at: at - self._at + n]

    def peek(self, at: int, n: int) -> bytes:
        """A few bytes elsewhere, past the buffer."""
        if self._at <= at and at + n <= self._at + len(self._data):
            return self._data[at - self._at: at - self._at + n]
        self._file.seek(at)
        return self._file.read(n)

    def find(self, what: re.Pattern, at: int, overlap: int) -> int:
        """Offset of the next match at or after ``at``; the file's size if there is none."""
        while at < self.size:
            block = self.get(at, _CHUNK)
            if m := what.search(block):
                return at + m.start()
            if at + len(block) >= self.size:
                break
            at += len(block) - overlap
        return self.size


class Damaged(ValueError):
    """A check failed."""


class Head(dict):
    """Header fields; names are the same in any case."""

    def __init__(self, text: str):
        super().__init__()
        last = None
        for line in text.split("\r\n"):
            if line[:1] in (" ", "\t") and last:
                dict.__setitem__(self, last, f"{self[last]} {line.strip()}".strip())
                continue
            name, colon, value = line.partition(":")
            last = name.strip().lower()
            if not colon or not last:
                raise Damaged("bad header")
            if last not in self:
                dict.__setitem__(self, last, value.strip())

    def __getitem__(self, name: str) -> str:
        return super().__getitem__(name.lower())

    def get(self, name: str, default: str | None = None) -> str | None:
        return super().get(name.lower(), default)


def stated_digest(value: str | None) -> tuple[str, bytes] | None:
    """(kind, digest) of a labelled digest; None if there is none of a known kind and form."""
    kind, _, text = (value or "").partition(":")
    kind = kind.strip().lower().replace("-", "")
    size, text = _KINDS.get(kind), text.strip()
    if not size:
        return None
    if re.fullmatch(rf"[0-9A-Fa-f]{{{2 * size}}}", text):
        return kind, bytes.fromhex(text)
    try:
        bare = text.rstrip("=").upper()
        raw = base64.b32decode(bare + "=" * (-len(bare) % 8))
    except ValueError:
        return None
    return (kind, raw) if len(raw) == size else None


def _agrees(value: str | None, data: bytes) -> bool:
    """Whether a stated digest is that of the data, or can't be checked."""
    stated = stated_digest(value)
    return stated is None or hashlib.new(stated[0], data).digest() == stated[1]


def _parse(data: bytes) -> dict:
    """A whole record, checked."""
    if not _VERSION.match(data):
        raise Damaged("no version line")
    end = data.find(_END)
    if end < 0:
        raise Damaged("header has no end")
    try:
        head = Head(data[data.index(b"\r\n") + 2:end].decode())
        length = int(head["Content-Length"])
    except (ValueError, KeyError) as e:
        raise Damaged("bad header") from e
    block, tail = data[end + 4:end + 4 + length], data[end + 4 + length:]
    if length < 0 or len(block) != length or tail != _END:
        raise Damaged("wrong length")
    if not _agrees(head.get("WARC-Block-Digest"), block):
        raise Damaged("wrong block digest")
    http, _, payload = block.partition(_END)
    if head.get("WARC-Type") == "response" and not _agrees(head.get("WARC-Payload-Digest"), payload):
        raise Damaged("wrong payload digest")
    return {"head": head, "http": http, "payload": payload}


def _gzip_record(r: _Reader, at: int) -> tuple[dict, int]:
    if r.get(at, 3) != _MAGIC:
        raise Damaged("no gzip member")
    z, parts, total, pos, block = zlib.decompressobj(31), [], 0, at, b""
    try:
        while not z.eof:
            if not block:
                if pos >= r.size:
                    raise Damaged("truncated")
                block = r.get(pos, min(1 << 16, r.size - pos))
                pos += len(block)
            part = z.decompress(block, _CHUNK)
            block = z.unconsumed_tail
            if total < 5 <= total + len(part) and not (b"".join(parts) + part).startswith(b"WARC/"):
                raise Damaged("no version line")
            parts.append(part)
            total += len(part)
            if total > MAX_RECORD:
                raise Damaged("too long")
    except zlib.error as e:
        raise Damaged("bad gzip member") from e
    return _parse(b"".join(parts)), pos - len(z.unused_data)


def _plain_record(r: _Reader, at: int) -> tuple[dict, int]:
    if not _VERSION.match(r.get(at, 11)):
        raise Damaged("no version line")
    n = 4096
    while (end := (head := r.get(at, min(n, r.size - at))).find(_END)) < 0:
        if len(head) < n or n > _CHUNK:
            raise Damaged("header has no end")
        n *= 2
    length = re.search(rb"(?i)\r\nContent-Length[ \t]*:\s*(\d{1,18})[ \t]*\r\n", head[:end + 2])
    if not length:
        raise Damaged("bad header")
    stop = at + end + 4 + int(length[1]) + 4
    if stop > r.size:
        raise Damaged("truncated")
    if stop - at > MAX_RECORD:
        raise Damaged("too long")
    if r.peek(stop - 4, 4) != _END:
        raise Damaged("wrong length")
    return _parse(r.get(at, stop - at)), stop


def salvage(file: pa.NativeFile) -> Iterator[tuple[int, int, dict | None, str | None]]:
    """(start, end, record, None) for each record that passes all checks, and (start, end, None,
    reason) for each gap between them, in file order, without a byte left out. Whatever the file
    begins with, each place is read as what its first bytes say. An empty file gives nothing."""
    r = _Reader(file)
    at, gap, reason = 0, None, None
    while at < r.size:
        try:
            found, end = (_gzip_record if r.get(at, 3) == _MAGIC else _plain_record)(r, at)
        except Damaged as e:
            if gap is None:
                gap, reason = at, str(e)
            at = r.find(_MARK, at + 1, 16)
            continue
        if gap is not None:
            yield gap, at, None, reason
            gap = None
        yield at, end, found, None
        at = end
    if gap is not None:
        yield gap, r.size, None, reason


_ROW = pa.schema([("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                  ("gap", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()),
                  ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary()),
                  ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])


def _page(name: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(m[1]) if m else None


def _row(path: str, start: int, end: int, found: dict | None, reason: str | None, payload: bool) -> dict:
    row = {"path": path, "start": start, "end": end, "gap": reason}
    if found:
        head = found["head"]
        kind = head.get("WARC-Type")
        stated = re.search(rb"(?i)\r\nContent-Length: *(\d+)", found["http"])
        told = stated_digest(head.get("WARC-Payload-Digest"))
        digest = told[1].hex() if told and told[0] == "sha1" else (
            None if kind == "revisit" else hashlib.sha1(found["payload"]).hexdigest())
        row |= {"record_type": kind, "page_id": _page(head.get("WARC-Record-ID")),
                "refers_to": _page(head.get("WARC-Refers-To")), "url": head.get("WARC-Target-URI"),
                "payload": found["payload"] if payload and kind == "response" else None,
                "payload_bytes": int(stated[1]) if stated and kind == "revisit" else len(found["payload"]),
                "payload_digest": digest}
    return row


def read_archives(manifest: DataFrame, *, payload: bool = True) -> DataFrame:
    """Rows for all records and gaps of the archives in ``manifest`` (column ``path``): path, start,
    end, gap (the reason, or null for a record), page_id, record_type, refers_to, url, payload
    (of responses, if asked for), payload_bytes and payload_digest (hex SHA-1) of the full payload.

    One task reads a file at a time, a record at a time; files are dealt round robin."""
    spark = manifest.sparkSession
    files = manifest.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                source, inside = pafs.FileSystem.from_uri(path)
                rows, held = [], 0
                with source.open_input_file(inside) as file:
                    for found in salvage(file):
                        rows.append(_row(path, *found, payload))
                        held += len(rows[-1].get("payload") or b"") + 500
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _ROW)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, _ROW)

    wide = max(1, min(files, 4 * spark.sparkContext.defaultParallelism + int(
        spark.conf.get("spark.sql.shuffle.partitions"))))
    schema = ("path string, start long, end long, gap string, page_id long, record_type string, "
              "refers_to long, url string, payload binary, payload_bytes long, payload_digest string")
    return manifest.select("path").repartition(wide).mapInArrow(run, schema)


def archived(pages: DataFrame, folder: str | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """Write ``pages`` to archives below ``folder`` (by default a fresh one in the shared checkpoint
    folder) and read them back: (records, gaps). An empty table gives no archives and no rows."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    if "://" not in folder and not folder.startswith("/"):
        folder = "file://" + folder.removeprefix("file:")
    manifest = write_archives(plan_records(pages, **options), folder)
    rows = read_archives(manifest, payload=False)
    return rows.where("gap IS NULL").drop("gap"), rows.where("gap IS NOT NULL").select(
        "path", "start", "end", "gap")


#: DuckDB SQL of the records' digest columns over ``pages``.
SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 1000
                     THEN max(page_id) OVER (PARTITION BY payload_digest) END AS f FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN f IS NULL OR page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f IS NULL OR page_id = f THEN NULL ELSE f END AS refers_to
FROM f
"""
