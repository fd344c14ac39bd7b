"""WARC archives with an index: offset, length, URL and digest of each record come first.

Equal payloads are found by digest in a light aggregate that is joined back, which
adaptive execution can split at a frequent payload. Each task then appends its records,
a gzip member each, to archives of its own and returns their index rows; the stored
index names only the archives of tasks that ended well, so files of lost or repeated
tasks are never read. Readers pick rows of the index, sort them by place, join
neighbouring ranges into one read, and cut the records out of what they get.

Archives lie below the shared folder, which must be one that pyarrow opens by its URI
(a mounted folder, HDFS, S3, GCS). Null html is an empty payload and a null URL is left
out of the record. Of records with equal payloads those of the smallest page id (null
first), then URL, are stored, the others refer to that page; rows equal in both are each
stored. The archives stay until the shared folder is cleaned.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordops.llm.base import bounded, settle, slices
from recordops.session import scratch_dir

END = b"\r\n\r\n"
GAP, LONGEST = 64 << 10, 8 << 20  # ranges that lie closer are read at once, up to so many bytes
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_of_hex(hex_digest: Column) -> Column:
    """Upper-case base32 of a 160-bit digest in hex: four groups of 40 bits."""
    groups = [F.lpad(F.conv(F.substring(hex_digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*groups)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", least_bytes: int = 0) -> DataFrame:
    """Each page with its digest, the type of its record and the page it refers to.

    Payloads of fewer than `least_bytes` bytes are stored each time.
    """
    html = F.coalesce(F.col(html_column), F.lit("")).cast("binary")
    rows = bounded(pages).select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), html.alias("payload"))
    rows = rows.withColumn("digest", base32_of_hex(F.sha1("payload")))
    first = rows.groupBy("digest").agg(F.min(F.struct("page_id", "url")).alias("first"))
    stored = (F.octet_length("payload") < least_bytes) | F.struct("page_id", "url").eqNullSafe(F.col("first"))
    rows = rows.join(first, "digest").withColumn("stored", stored)
    return rows.select("page_id", "url", "digest", "stored", F.when(~F.col("stored"), F.col("first.page_id")).alias("refers_to"), "payload")


def build(page, url, digest: str, stored: bool, refers_to, payload: bytes) -> bytes:
    """A record: headers, then the HTTP response, without its body if the record is a revisit."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(payload) + END
    block = http + payload if stored else http
    name = lambda x: f"<urn:page:{'null' if x is None else x}>"
    lines = ["WARC/1.1", f"WARC-Type: {'response' if stored else 'revisit'}", f"WARC-Record-ID: {name(page)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    lines += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if not stored:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block + END


def parse(record: bytes) -> tuple:
    """Type, page referred to, bytes and digest of the payload, URL, payload (none for a revisit)."""
    head, _, rest = record.partition(END)
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    block = rest[: -len(END)]
    if not head.startswith(b"WARC/1.") or len(block) != int(fields["Content-Length"]):
        raise ValueError("no record at this offset")
    http, _, payload = block.partition(END)
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(http.rpartition(b"Content-Length: ")[2])
    url = fields.get("WARC-Target-URI")
    if fields["WARC-Type"] == "revisit":
        return "revisit", fields["WARC-Refers-To"].removeprefix("<urn:page:").removesuffix(">"), size, stated, url, None
    found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if found != stated or len(payload) != size:
        raise ValueError("payload differs from its digest")
    return "response", None, size, found, url, payload


def gz(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write(rows: DataFrame, folder: str, archive_bytes: int = 64 << 20) -> DataFrame:
    """Writes archives of up to about `archive_bytes` and returns their stored index."""
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches):
        out, path, offset, listed = None, None, 0, []

        def close(page_type):
            """Index rows leave only when their archive is complete."""
            out.close()
            kinds = [page_type, pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in listed], k) for i, k in enumerate(kinds)], names=["page_id", "url", "digest", "path", "offset", "length"])

        for batch in batches:
            for a, b in slices(batch.column(5), 1 << 20):
                for row in zip(*(c.to_pylist() for c in batch.slice(a, b - a).columns)):
                    if out is None:
                        path, offset, listed = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, []
                        out = create(path)
                    member = gz(build(*row))
                    out.write(member)
                    listed.append((row[0], row[1], row[2], path, offset, len(member)))
                    offset += len(member)
                    if offset >= archive_bytes:
                        yield close(batch.schema.field(0).type)
                        out = None
        if out is not None:
            yield close(batch.schema.field(0).type)

    index = rows.mapInArrow(run, f"page_id {kind}, url string, digest string, path string, offset long, length long")
    return settle(index, "warc-index")


def fetch(index: DataFrame) -> DataFrame:
    """The records that rows of the index name, read in ranges: headers, payload and its digest."""
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = index.schema["page_id"].dataType.simpleString()
    picked = index.withColumn("piece", F.floor(F.col("offset") / LONGEST)).repartition(n, "path", "piece")
    picked = picked.sortWithinPartitions("path", "offset").select("page_id", "path", "offset", "length")

    def ranges(rows):
        """Neighbouring records of one archive, joined while they lie close."""
        held: list = []
        for row in rows:
            if held and (row[1] != held[0][1] or row[2] - (held[-1][2] + held[-1][3]) > GAP or row[2] + row[3] - held[0][2] > LONGEST):
                yield held
                held = []
            held.append(row)
        if held:
            yield held

    def run(batches):
        source, path = None, None
        for batch in batches:
            kinds = [batch.schema.field(0).type, pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
            for held in ranges(zip(*(c.to_pylist() for c in batch.columns))):
                if held[0][1] != path:
                    path = held[0][1]
                    source = open_archive(path)
                start = held[0][2]
                source.seek(start)
                data = source.read(held[-1][2] + held[-1][3] - start)
                found = [(page, *parse(zlib.decompress(data[o - start : o - start + n], 31))) for page, _, o, n in held]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], k) for i, k in enumerate(kinds)], names=["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "url", "payload"])

    return picked.mapInArrow(run, f"page_id {kind}, record_type string, refers_to string, payload_bytes long, payload_digest string, url string, payload binary")


def store(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def create(uri: str):
    target, path = store(uri)
    target.create_dir(path.rpartition("/")[0], recursive=True)
    return target.open_output_stream(path, compression=None)  # members are compressed one by one


def open_archive(uri: str):
    source, path = store(uri)
    return source.open_input_file(path)


def archive(pages: DataFrame, **columns) -> DataFrame:
    """Writes all pages as archives in the shared folder and reads every record back."""
    folder = scratch_dir(pages.sparkSession, "warc")
    return fetch(write(records(pages, **columns), folder))
