"""WARC archives of pages: a deterministic sharded writer, and a reader.

Records are range-sorted by page id, so the archives' content depends on the
pages alone. A page whose payload another page has (same digest, at least
``REVISIT_BYTES``) is written once, as the response of the smallest page id; the
others become revisit records. A task writes its range as one or more files of
gzip members, one per record, and begins a new file when the compressed size
passes ``roll_bytes``. Files are written under temporary names, renamed when
whole, and listed in a manifest; the reader takes the manifest's files only.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from contextlib import ExitStack

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import run_dir
from .common import arrow_batches, stored
from .files import open_file, whole_file

REVISIT_BYTES = 100
ROLL_BYTES = 128 << 20
DATE = "2024-01-01T00:00:00Z"  # records carry a date; a fixed one keeps the archives deterministic
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122


def _name(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{digest}')}>"


def _header_text(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c not in "\r\n" else f"%{ord(c):02X}" for c in value)


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, date: str = DATE) -> bytes:
    """One WARC record: a response with its payload, or a revisit of page ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_name(page_id, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_text(url)}")
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_name(refers_to, digest)}", f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page: {refers_to}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head += [f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def _member(raw: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def _writer(folder: str, roll_bytes: int):
    def run(batches):
        part, made, mark = TaskContext.get().partitionId(), [], None
        with ExitStack() as files:
            out = sha = None
            for batch in batches:
                for page, digest, is_record, first, url, html in zip(*(batch.column(i).to_pylist() for i in range(6))):
                    if not is_record:  # a mark stands right before the records that it turns into revisits
                        mark = (page, digest, first)
                        continue
                    refers_to = mark[2] if mark and mark[:2] == (page, digest) else None
                    if out is None or made[-1][4] > roll_bytes:
                        if out is not None:
                            made[-1][5] = sha.hexdigest()
                            files.close()
                        name = f"pages-{part:06d}-{len(made):05d}.warc.gz"
                        out, sha = files.enter_context(whole_file(folder, name)), hashlib.sha256()
                        made.append([part, len(made), name, 0, 0, ""])
                    raw = _member(record(page, url, (html or "").encode("utf-8", "surrogatepass"), digest, refers_to))
                    out.write(raw)
                    sha.update(raw)
                    made[-1][3] += 1
                    made[-1][4] += len(raw)
            if out is not None:
                made[-1][5] = sha.hexdigest()
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made) if made else [[]] * 6, kinds)], names=["part", "seq", "file", "records", "bytes", "sha256"])

    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write all pages and return the manifest: part, seq, file, records, bytes, sha256."""
    arrow_batches(pages.sparkSession, 128)
    p = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    p = p.withColumn("digest", F.sha2(F.coalesce(F.col("html"), F.lit("")).cast("binary"), 256))
    light = p.where(F.octet_length(F.coalesce("html", F.lit(""))) >= REVISIT_BYTES).select("page", "digest")
    shared = light.groupBy("digest").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null").drop("n")
    marks = light.join(shared, "digest").where("page is null or page <> first").distinct()
    rows = p.select("page", "digest", F.lit(True).alias("is_record"), F.lit(None).cast("long").alias("first"), "url", "html").unionByName(
        marks.select("page", "digest", F.lit(False).alias("is_record"), "first", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html")))
    ordered = rows.repartitionByRange("page", "digest").sortWithinPartitions("page", "digest", "is_record", "url")
    return stored(ordered.mapInArrow(_writer(folder, roll_bytes), "part long, seq long, file string, records long, bytes long, sha256 string"), "warc/manifest")


def parse(stream):
    """(headers, block) of every record of an uncompressed WARC stream."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError("a record must begin with its version")
        head = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            k, _, v = line.partition(b":")
            head[k.decode().lower()] = v.strip().decode("utf-8", "surrogatepass")
        block = stream.read(int(head["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record must end with two line ends")
        yield head, block


def _reader(folder: str):
    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with open_file(folder, name) as src, gzip.GzipFile(fileobj=src) as stream:
                    for head, block in parse(stream):
                        if "sha256:" + hashlib.sha256(block).hexdigest() != head["warc-block-digest"]:
                            raise ValueError(f"block digest is wrong in {name}")
                        kind, digest, n = head["warc-type"], head["warc-payload-digest"].removeprefix("sha256:"), int(head["x-payload-length"])
                        if kind == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            digest, n = hashlib.sha256(payload).hexdigest(), len(payload)
                        page, of = head.get("x-page-id"), head.get("x-refers-to-page")
                        rows.append((None if page is None else int(page), n, digest, kind, None if of is None else int(of), head.get("warc-target-uri"), name))
                        if len(rows) >= 4096:
                            yield _rows(rows)
                            rows = []
                yield _rows(rows)

    return run


def _rows(rows: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 7, kinds)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "file"])


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """A row per record of the manifest's files; digests of blocks and payloads are worked out anew."""
    n = manifest.sparkSession.sparkContext.defaultParallelism * 4
    return manifest.select("file").repartition(n).mapInArrow(
        _reader(folder), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, file string")


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write all pages as archives, read them back: a row per page.

    A null html is an empty payload; a null url has no target header. Pages
    that share an id and a payload are written alike, each as response or
    revisit. A null id is never the smallest: such a page is a response unless
    a page with an id has its payload. Other columns are not read. An empty
    table gives an empty result.
    """
    folder = run_dir(pages.sparkSession, "warc/files")
    return read_archives(write_archives(pages, folder, id_col, url_col, html_col, roll_bytes), folder)
