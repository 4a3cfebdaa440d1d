"""WARC archives: a writer with revisit records and a splittable reader.

Every record is a gzip member of its own. The reader deals byte ranges of the
archives to tasks. A task looks for the gzip magic in its range, accepts a candidate
only if it decodes to a whole record with readable headers and is followed by another
member or the end of the file, and owns the records that start inside its range; the
last one may end beyond it. No index and no pass over the whole file is needed.

Tasks write archives under names of their own. Only the manifest, which Spark commits,
says which of them count, so a repeated task leaves no double records.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pandas as pd
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import utf8
from tidemark.session import materialize, scratch_path

MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
SPLIT_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
LEVEL = 3

# Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_READ = 1 << 20

MANIFEST = "path string, bytes long, records long"
RECORDS = (
    "path string, start long, record_type string, page_id long, target_uri string, payload_bytes long, "
    "payload_digest string, digest_ok boolean, refers_to long, payload binary"
)


def record(kind: str, page_id: int | None, url: str | None, size: int, digest: str, refers_to: int | None, payload: bytes, date: str) -> bytes:
    """One uncompressed record; a revisit carries the HTTP headers and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{kind}|{digest}')}>",
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url),
        "WARC-Page-ID": page_id,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Profile": PROFILE if kind == "revisit" else None,
        "WARC-Refers-To-Page-ID": refers_to if kind == "revisit" else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = LEVEL) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def digest_column(payload: Column) -> Column:
    return F.sha1(payload)


def with_roles(pages: DataFrame, id_col: str, url_col: str, html_col: str, least: int) -> DataFrame:
    """Columns id, url, html, size, digest, latest: the largest id of a repeated payload, else null."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), utf8(F.col(html_col)).alias("html"))
    rows = rows.withColumns({"size": F.octet_length("html").cast("long"), "digest": digest_column(F.col("html"))})
    repeated = rows.where(F.col("size") >= least).groupBy("digest").agg(F.max("id").alias("latest"), F.count("*").alias("n"))
    repeated = materialize(repeated.where("n > 1").select("digest", "latest"), "warc-repeated")
    return rows.join(repeated, "digest", "left")


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least: int = MIN_REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    level: int = LEVEL,
    date: str = DATE,
) -> DataFrame:
    """Writes one record per row below ``path`` and returns the manifest: path, bytes, records.

    A null page is an empty payload. Of payloads of at least ``least`` bytes that occur
    more than once, the row with the largest id is the response and the others are
    revisits; rows that repeat that id, and rows of a group without ids, are all
    responses. An empty table gives an empty manifest. Other columns are not read.
    """
    rows = with_roles(pages, id_col, url_col, html_col, least)
    revisit = F.col("latest").isNotNull() & ~F.col("id").eqNullSafe(F.col("latest"))
    rows = rows.select("id", "url", "size", "digest", "latest", revisit.alias("revisit"), F.when(~revisit, F.col("html")).alias("html"))

    def write(frames):
        store, base = pyarrow.fs.FileSystem.from_uri(path)
        store.create_dir(base, recursive=True)
        out = name = None
        done = size = 0
        for pdf in frames:
            for row in pdf.itertuples(index=False):
                if out is None:
                    name, done, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                ids = [None if pd.isna(x) else int(x) for x in (row.id, row.latest)]
                kind = "revisit" if row.revisit else "response"
                url = row.url if isinstance(row.url, str) else None
                data = member(record(kind, ids[0], url, int(row.size), row.digest, ids[1], row.html or b"", date), level)
                out.write(data)
                done, size = done + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield pd.DataFrame([(f"{path}/{name}", size, done)], columns=["path", "bytes", "records"])
        if out is not None:
            out.close()
            yield pd.DataFrame([(f"{path}/{name}", size, done)], columns=["path", "bytes", "records"])

    rows = rows.withColumns({c: F.col(c).cast("string") for c in ("id", "latest")})
    return materialize(rows.mapInPandas(write, MANIFEST), "warc-manifest")


class Range:
    """Reads a file forward from any offset, holding only what a member needs."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.data = file, size, 0, b""

    def get(self, start: int, length: int) -> bytes:
        """Up to ``length`` bytes from ``start``; less at the end of the file."""
        stop = min(start + length, self.size)
        if start < self.at or stop > self.at + len(self.data):
            self.file.seek(start)
            self.at, self.data = start, self.file.read(max(stop - start, min(_READ, self.size - start)))
        return self.data[start - self.at : stop - self.at]


def decode(source: Range, start: int) -> tuple[bytes, int] | None:
    """The record in the member at ``start`` and where the member ends; None if there is no whole record."""
    packer, parts, at = zlib.decompressobj(31), [], start
    try:
        while not packer.eof:
            chunk = source.get(at, _READ if at > start else 1 << 14)
            if not chunk:
                return None
            parts.append(packer.decompress(chunk))
            if not parts[0].startswith(b"WARC/1."[: max(1, len(parts[0]))]) and parts[0]:
                return None
            at += len(chunk)
    except zlib.error:
        return None
    data = b"".join(parts)
    return (data, at - len(packer.unused_data)) if headers(data) is not None else None


def headers(data: bytes) -> tuple[dict[str, str], bytes] | None:
    """Header fields in lower case and the block; None if they are not those of a whole record."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"WARC/1."):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    length = fields.get("content-length", "")
    if not length.isdigit() or "warc-type" not in fields or rest[int(length) :] != b"\r\n\r\n":
        return None
    return fields, rest[: int(length)]


def members(source: Range, start: int, end: int):
    """Offset and record of the members that start in [start, end)."""
    at, synced = start, start == 0
    while at < end:
        if source.get(at, 3) != MAGIC:
            synced = False
            window = source.get(at, min(_READ, end - at) + 2)
            hit = window.find(MAGIC)
            if hit < 0:
                at += max(1, len(window) - 2)
                continue
            at += hit
            if at >= end:
                return
        found = decode(source, at)
        if found and (synced or found[1] >= source.size or source.get(found[1], 3) == MAGIC):
            yield at, found[0]
            at, synced = found[1], True
        else:
            at, synced = at + 1, False


def parse(data: bytes) -> tuple:
    """Type, page, address, size, digest, whether it holds, page referred to, payload."""
    fields, block = headers(data)
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    number = lambda name: int(fields[name]) if name in fields else None
    told = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "revisit":
        length = re.search(rb"(?im)^content-length:\s*(\d+)", http)
        size, digest, ok, payload = int(length[1]) if length else None, told, None, None
    else:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
        ok = digest == told if told else None
    return kind, number("warc-page-id"), fields.get("warc-target-uri"), size, digest, ok, number("warc-refers-to-page-id"), payload


def read_archives(files: DataFrame, split_bytes: int = SPLIT_BYTES, payload: bool = True) -> DataFrame:
    """Records of the archives in ``files`` (``path``, ``bytes``): one row each, see ``RECORDS``.

    ``payload_bytes`` and ``payload_digest`` (SHA-1) are those of the full payload, for
    a revisit as its headers give them; ``digest_ok`` compares the payload with its
    header. Bytes that are no whole record are passed over. With ``payload`` false the
    payloads stay in the task.
    """
    count = files.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1
    spots = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))
    splits = files.where("bytes > 0").select("path", F.col("bytes").alias("size"), F.explode(spots).alias("start"))
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def read(frames):
        for pdf in frames:
            for path, size, start in zip(pdf["path"], pdf["size"], pdf["start"]):
                store, name = pyarrow.fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with store.open_input_file(name) as file:
                    for at, data in members(Range(file, int(size)), int(start), min(int(start) + split_bytes, int(size))):
                        kind, page, url, length, digest, ok, refers, body = parse(data)
                        rows.append((path, at, kind, page, url, length, digest, ok, refers, body if payload else None))
                        held += len(body or b"") if payload else 100
                        if held > 8 << 20:
                            yield frame(rows)
                            rows, held = [], 0
                yield frame(rows)

    def frame(rows):
        pdf = pd.DataFrame(rows, columns=names)
        return pdf.astype({c: "Int64" for c in ("start", "page_id", "payload_bytes", "refers_to")} | {"digest_ok": "boolean"})

    return splits.repartition(int(count)).mapInPandas(read, RECORDS)


def round_trip(pages: DataFrame, split_bytes: int = SPLIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes ``pages`` to the shared folder and reads the archives back, one row per page."""
    files = write_archives(pages, scratch_path(pages.sparkSession, "warc"), archive_bytes=archive_bytes)
    return read_archives(files, split_bytes, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
g as (select payload_digest, max(page_id) as latest, count(*) as n from p where payload_bytes >= 1000 group by payload_digest)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
    case when n > 1 and page_id <> latest then 'revisit' else 'response' end as record_type,
    case when n > 1 and page_id <> latest then latest end as refers_to
from p left join g using (payload_digest)
"""
