"""WARC archives: written with an index, read back by byte ranges that the index gives.

A record is a gzip member of its own. A payload that an earlier page has too is stored once;
its other pages are revisit records, whose block is the HTTP head alone.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import slices
from tidemark.llm.prefix import dealt
from tidemark.llm.store import Folder, open_input
from tidemark.session import cut, fresh_path

# The profile of revisit records and header names of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = (
    "path string, offset long, length long, page_id long, url string, digest string, "
    "payload_bytes long, record_type string, refers_to long"
)


def payload_digest(html: Column) -> Column:
    return F.sha2(F.coalesce(html, F.lit("")).cast("binary"), 256)


def with_types(pages: DataFrame, key: str = "page_id", html: str = "html", least: int = 100) -> DataFrame:
    """(page_id, url, html, digest, record_type, refers_to): of equal payloads of at least
    ``least`` bytes, the smallest id's is the response and the others revisit it.

    Rows that share the smallest id are all responses; null ids come last, and a group
    without an id has only responses. Digests and ids are combined before they move; the
    join splits the payload that many pages share.
    """
    size = F.coalesce(F.octet_length(html), F.lit(0))
    base = pages.select(F.col(key).cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col(html).alias("html"), payload_digest(F.col(html)).alias("digest"))
    large = pages.filter(size >= least).select(F.col(key).cast("long").alias("page_id"), payload_digest(F.col(html)).alias("digest"))
    shared = cut(large.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first")).filter("n > 1 AND first IS NOT NULL").drop("n"))
    out = base.join(shared, "digest", "left")
    revisits = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return out.withColumns({"record_type": F.when(revisits, "revisit").otherwise("response"), "refers_to": F.when(revisits, F.col("first"))}).drop("first")


def _line(name: str, value: str) -> bytes:
    return f"{name}: {value}\r\n".encode("utf-8", "surrogatepass")


def _one_line(url: str) -> str:
    """A url as a header value: controls are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None, date: str) -> bytes:
    """One record, uncompressed. The HTTP head gives the full payload's size."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + _line("Content-Length", str(len(payload))) + b"\r\n"
    block = http if kind == "revisit" else http + payload
    head = f"{VERSION}\r\n".encode()
    head += _line("WARC-Type", kind) + _line("WARC-Record-ID", f"<urn:page:{page_id}>") + _line("WARC-Date", date)
    head += _line("WARC-Target-URI", _one_line(url)) if url is not None else b""
    head += _line("WARC-Payload-Digest", f"sha256:{digest}")
    if kind == "revisit":
        head += _line("WARC-Profile", PROFILE) + _line("WARC-Refers-To", f"<urn:page:{refers_to}>")
    head += _line("Content-Type", "application/http; msgtype=response") + _line("Content-Length", str(len(block)))
    return head + b"\r\n" + block + b"\r\n\r\n"


def write(typed: DataFrame, date: str = "1970-01-01T00:00:00Z", level: int = 3, file_bytes: int = 1 << 28) -> DataFrame:
    """Writes the rows of with_types as archives in the shared folder; returns their index.

    A task writes its rows into files of about ``file_bytes``. The index has offset, length,
    url and digest of each record; files of attempts that it does not name do not count.
    """
    root = fresh_path(typed.sparkSession, "warc")
    columns = ["page_id", "url", "html", "digest", "record_type", "refers_to"]

    def run(batches):
        folder, out, path, offset = Folder(root, ".warc.gz"), None, None, 0
        try:
            for batch in slices(batches, 2):
                rows = []
                for page, url, html, digest, kind, first in zip(*(batch.column(k).to_pylist() for k in range(6))):
                    if out is None or offset >= file_bytes:
                        if out is not None:
                            out.close()
                        (path, out), offset = folder.next(), 0
                    payload = (html or "").encode("utf-8", "surrogatepass")
                    data = gzip.compress(record(page, url, payload, digest, kind, first, date), level, mtime=0)
                    out.write(data)
                    rows.append((path, offset, len(data), page, url, digest, len(payload), kind, first))
                    offset += len(data)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES) if rows else pa.RecordBatch.from_arrays([pa.array([], t) for t in _TYPES], names=_NAMES)
        finally:
            if out is not None:
                out.close()

    return cut(typed.select(*columns).mapInArrow(run, INDEX))


_NAMES = [f.split()[0] for f in INDEX.split(", ")]
_TYPES = [pa.int64() if f.split()[1] == "long" else pa.string() for f in INDEX.split(", ")]


def parse(data: bytes) -> dict:
    """Headers, payload and the size that the HTTP head gives, of one gzip member."""
    raw = zlib.decompress(data, wbits=31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != VERSION:
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    return {"headers": headers, "payload": payload, "size": size}


def _page(urn: str | None) -> int | None:
    value = (urn or "None")[len("<urn:page:") : -1] if urn else "None"
    return None if value == "None" else int(value)


def ranges(offsets: np.ndarray, lengths: np.ndarray, gap: int, most: int) -> list[tuple[int, int]]:
    """Slices of sorted records to be read at once: neighbours at most ``gap`` bytes apart,
    up to ``most`` bytes.
    """
    out, a = [], 0
    ends = offsets + lengths
    for k in range(1, len(offsets) + 1):
        if k == len(offsets) or offsets[k] - ends[k - 1] > gap or ends[k] - offsets[a] > most:
            out.append((a, k))
            a = k
    return out


def read(selected: DataFrame, payloads: bool = True, gap: int = 1 << 16, most: int = 1 << 23, section: int = 1 << 23) -> DataFrame:
    """Reads the records that a (part of an) index names.

    Returns page_id, url, record_type, refers_to, payload (null for a revisit, whose payload
    its response holds), payload_bytes and payload_digest of the full payload. Digests and
    sizes of responses are taken from the payload itself, those of revisits from their
    headers. Byte ranges are sorted and coalesced within sections of a file, a section to a
    task at a time.
    """
    schema = "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string"
    names = [f.split()[0] for f in schema.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string()]

    def run(batches):
        for batch in batches:
            table = batch.to_pydict()
            paths = np.array(table["path"], object)
            offsets, lengths = np.array(table["offset"], np.int64), np.array(table["length"], np.int64)
            for path in dict.fromkeys(table["path"]):
                mine = np.flatnonzero(paths == path)
                mine = mine[np.argsort(offsets[mine], kind="stable")]
                with open_input(path) as f:
                    for a, b in ranges(offsets[mine], lengths[mine], gap, most):
                        start = int(offsets[mine[a]])
                        data = f.read_at(int(offsets[mine[b - 1]] + lengths[mine[b - 1]]) - start, start)
                        rows = []
                        for k in mine[a:b]:
                            at = int(offsets[k]) - start
                            got = parse(data[at : at + int(lengths[k])])
                            rows.append(_row(got, table["url"][k], payloads))
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    part = (F.col("offset") / section).cast("long")
    sorted_ = dealt(selected.select("path", "offset", "length", "url"), "path", part).sortWithinPartitions("path", "offset")
    return sorted_.mapInArrow(run, schema)


def _row(got: dict, url: str | None, payloads: bool) -> tuple:
    headers, payload = got["headers"], got["payload"]
    kind = headers["WARC-Type"]
    stated = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "revisit":
        digest, size, payload = stated, got["size"], None
    else:
        digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
        if digest != stated:
            raise ValueError("a payload does not match its digest")
    page, first = _page(headers["WARC-Record-ID"]), _page(headers.get("WARC-Refers-To"))
    return page, url, kind, first, payload if payloads else None, size, digest
