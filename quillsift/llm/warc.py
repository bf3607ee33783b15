"""WARC archives: written with an index first, read by coalesced byte ranges.

Each page is a record of its own gzip member. While a task writes its archive it notes offset, length, URL
and digest of each record; that index is the table that readers select from. Selected records are dealt by
ranges of (file, offset), sorted, and neighbours are read in one request.

Payloads are the HTML in UTF-8; null counts as empty. Of equal payloads of at least `least` bytes the one
with the smallest page_id is a response and the others are revisits that refer to it; repeated rows of
that page_id are responses too. A null page_id is written as an empty header and is never referred to. An
empty table writes nothing. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, lean, open_fs, saved, scratch, shuffle_partitions, write_bytes

INDEX = "file string, offset bigint, length bigint, url string, digest string, page_id bigint, record_type string"
RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string"
#: Bytes between two records that are read along, and the most in one request.
GAP, REQUEST = 1 << 16, 1 << 23
DATE = "2024-01-01T00:00:00Z"


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A record, uncompressed. A revisit has no payload, only its size and digest."""
    revisit = refers_to is not None
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if revisit else payload)
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Target-URI: {url}", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}", f"Content-Length: {len(body)}", "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = {}
    for line in head.decode().split("\r\n")[1:]:
        name, _, value = line.partition(": ")
        headers[name.lower()] = value
    return headers, rest[: int(headers["content-length"])].partition(b"\r\n\r\n")[2]


def page_number(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def with_referred(pages: DataFrame, least: int) -> DataFrame:
    """Pages with digest, size and, for revisits, the page_id referred to. Only digests that repeat are joined."""
    rows = pages.select(F.col("page_id").cast("bigint"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload"))
    first = rows.filter(F.col("size") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first")
    out = rows.join(saved(first, "repeated"), "digest", "left")
    return out.withColumn("refers_to", F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("first")), F.col("first"))).drop("first", "size")


def write(pages: DataFrame, least: int = 100) -> DataFrame:
    """Writes an archive for each task; gives the index."""
    folder = scratch(pages.sparkSession, "warc")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        index: list[tuple] = []

        def members() -> Iterator[bytes]:
            at = 0
            for batch in batches:
                for page_id, url, payload, digest, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                    url = url.replace("\r", "%0D").replace("\n", "%0A")
                    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
                    member = packer.compress(record(page_id, url, payload, digest, refers_to)) + packer.flush()
                    index.append((f"{folder}/{name}", at, len(member), url, digest, page_id, "response" if refers_to is None else "revisit"))
                    at += len(member)
                    yield member

        source = members()
        first = next(source, None)
        if first is None:
            return
        write_bytes(folder, name, (m for part in ([first], source) for m in part))
        names, types = zip(*(c.split() for c in INDEX.split(", ")))
        yield pa.record_batch([pa.array(c, pa.string() if t == "string" else pa.int64()) for c, t in zip(zip(*index), types)], names=list(names))

    arrow_batches(pages.sparkSession)
    return saved(with_referred(pages, least).mapInArrow(lean(archive), INDEX), "warc-index")


def requests(rows: list[tuple[int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """(first row, row after the last, start, end) of each request for sorted (offset, length) rows of a file."""
    first, start, end = 0, *((rows[0][0], rows[0][0] + rows[0][1]) if rows else (0, 0))
    for k, (offset, length) in enumerate(rows):
        if offset - end > GAP or offset + length - start > REQUEST and k > first:
            yield first, k, start, end
            first, start, end = k, offset, offset + length
        end = max(end, offset + length)
    if rows:
        yield first, len(rows), start, end


def read(index: DataFrame) -> DataFrame:
    """The records of index rows, with what the archives hold: payloads are hashed anew, revisits trust their headers."""
    import hashlib

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = zip(*(c.split() for c in RECORD.split(", ")))
        for batch in batches:
            files, places, out = batch.column("file").to_pylist(), list(zip(batch.column("offset").to_pylist(), batch.column("length").to_pylist())), []
            cuts = [0, *(k for k in range(1, len(files)) if files[k] != files[k - 1]), len(files)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                fs, path = open_fs(files[a])
                with fs.open_input_file(path) as f:
                    for i, j, start, end in requests(places[a:b]):
                        data = memoryview(f.read_at(end - start, start))
                        for offset, length in places[a + i : a + j]:
                            headers, payload = parse(zlib.decompress(data[offset - start : offset - start + length], 31))
                            kind = headers["warc-type"]
                            noted = headers["warc-payload-digest"].removeprefix("sha256:")
                            digest = hashlib.sha256(payload).hexdigest() if kind == "response" else noted
                            if digest != noted:
                                raise ValueError(f"{files[a]}: the record at {offset} is damaged")
                            size = len(payload) if kind == "response" else int(headers["x-payload-length"])
                            out.append((page_number(headers["warc-record-id"]), size, digest, kind, page_number(headers.get("warc-refers-to")), headers["warc-target-uri"]))
            if out:
                yield pa.record_batch([pa.array(c, pa.string() if t == "string" else pa.int64()) for c, t in zip(zip(*out), types)], names=list(names))

    spark = index.sparkSession
    arrow_batches(spark)
    rows = index.select("file", "offset", "length").repartitionByRange(shuffle_partitions(spark), "file", "offset").sortWithinPartitions("file", "offset")
    return rows.mapInArrow(lean(fetch), RECORD)
