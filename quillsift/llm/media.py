"""Media columns: payloads as grayscale PNG images in tar shards, addressed by the digest of their content.

A task stores each payload once in its shard, under its digest. The rows keep digest, shard, offset and
length. The catalogue takes, for each digest, one of the places where it is stored. Metadata columns are
filled by reading the first bytes of each image alone; features by reading whole images, sorted by place,
neighbours in one request.

Texts are UTF-8, null counts as empty, so a payload is never empty. Rows with a null or repeated doc_id
are rows of their own. An empty table stores nothing. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, lean, open_fs, saved, scratch, shuffle_partitions, write_bytes
from .warc import requests

#: Samples of an image row; a payload is a whole number of rows, filled up with FILL.
WIDTH, FILL = 576, 255
SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Signature and IHDR chunk.
HEADER_BYTES = 33
PLACES = "doc_id bigint, n_bytes bigint, digest string, shard string, offset bigint, length bigint"


def payload_of(text: bytes) -> bytes:
    return text + bytes([FILL]) * ((-len(text)) % WIDTH or (0 if text else WIDTH))


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def png(payload: bytes) -> bytes:
    """The payload as an 8-bit grayscale image; each row has filter 0, none."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), np.uint8)
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines, 6)) + chunk(b"IEND", b"")


def png_header(data: bytes) -> tuple[int, int, int, int]:
    """Width, height, bits of a sample and colour type, from an image's first bytes."""
    if data[:8] != SIGNATURE or data[12:16] != b"IHDR":
        raise ValueError("no PNG image")
    return struct.unpack(">IIBB", data[16:26])


def png_payload(data: bytes) -> bytes:
    """The samples of an image that png() wrote."""
    width, height, bits, colour = png_header(data)
    if (bits, colour) != (8, 0):
        raise ValueError("not 8-bit grayscale")
    at, packed = 8, b""
    while at < len(data):
        (n,), kind = struct.unpack(">I", data[at : at + 4]), data[at + 4 : at + 8]
        if zlib.crc32(data[at + 4 : at + 8 + n]) != struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("a chunk is damaged")
        packed += data[at + 8 : at + 8 + n] if kind == b"IDAT" else b""
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("a row has a filter")
    return lines[:, 1:].tobytes()


def feature(payload: bytes) -> str:
    """Mean, deviation, share of changes between neighbours, and the mean of 16 levels of brightness as hex digits."""
    x = np.frombuffer(payload, np.uint8)
    n = len(x)
    hist = np.bincount(x, minlength=256)
    mean = float(hist @ np.arange(256)) / n
    deviation = float(hist @ (np.arange(256) - mean) ** 2 / n) ** 0.5
    turns = float(np.count_nonzero(x[1:] != x[:-1])) / n
    level = hist.reshape(16, 16).sum(1)
    return f"{mean:.3f}:{deviation:.3f}:{turns:.4f}:" + "".join(f"{int(v):x}" for v in np.minimum(15, level * 16 // n))


def store(docs: DataFrame) -> DataFrame:
    """Writes the payloads of all texts into tar shards; gives the place of each row's payload."""
    folder = scratch(docs.sparkSession, "media")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"shard-{task.partitionId():06d}-{task.taskAttemptId()}.tar"
        rows: list[tuple] = []
        places: dict[bytes, tuple[int, int]] = {}

        def members() -> Iterator[bytes]:
            at = 0
            for batch in batches:
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    payload = payload_of(text)
                    digest = hashlib.sha256(payload).digest()
                    if digest not in places:
                        image = png(payload)
                        info = tarfile.TarInfo(f"{digest.hex()}.png")
                        info.size = len(image)
                        places[digest] = at + 512, len(image)
                        member = info.tobuf(tarfile.USTAR_FORMAT) + image + bytes(-len(image) % 512)
                        at += len(member)
                        yield member
                    rows.append((doc_id, len(text), digest.hex(), f"{folder}/{name}", *places[digest]))
            yield bytes(1024)

        source = members()
        first = next(source)
        if not rows and not places:
            return
        write_bytes(folder, name, (m for part in ([first], source) for m in part))
        names, types = zip(*(c.split() for c in PLACES.split(", ")))
        yield pa.record_batch([pa.array(c, pa.string() if t == "string" else pa.int64()) for c, t in zip(zip(*rows), types)], names=list(names))

    arrow_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return saved(texts.mapInArrow(lean(write), PLACES), "media-rows")


def catalogue(rows: DataFrame) -> DataFrame:
    """One place for each digest."""
    one = rows.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("at")).select("digest", "at.*")
    return saved(one, "media-catalogue")


def sorted_by_place(places: DataFrame) -> DataFrame:
    """Dealt by ranges of places and sorted, so that neighbours in a shard are read together."""
    return places.repartitionByRange(shuffle_partitions(places.sparkSession), "shard", "offset").sortWithinPartitions("shard", "offset")


def _reader(schema: str, length: int | None, columns):
    """A function for mapInArrow: reads the catalogue's images (their first bytes, if length is given) and makes columns of each."""
    names, types = zip(*(c.split() for c in schema.split(", ")))
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards, digests = batch.column("shard").to_pylist(), batch.column("digest").to_pylist()
            places, out = list(zip(batch.column("offset").to_pylist(), batch.column("length").to_pylist())), []
            if length:
                places = [(o, min(n, length)) for o, n in places]
            cuts = [0, *(k for k in range(1, len(shards)) if shards[k] != shards[k - 1]), len(shards)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                fs, path = open_fs(shards[a])
                with fs.open_input_file(path) as f:
                    if length:  # the headers lie far apart: one short read each
                        out += [(digests[a + k], *columns(f.read_at(n, o))) for k, (o, n) in enumerate(places[a:b])]
                        continue
                    for i, j, start, end in requests(places[a:b]):
                        data = f.read_at(end - start, start)
                        out += [(digests[a + k], *columns(data[o - start : o - start + n])) for k, (o, n) in enumerate(places[a + i : a + j], i)]
            if out:
                yield pa.record_batch([pa.array(c, kinds[t]) for c, t in zip(zip(*out), types)], names=list(names))

    return read


def metadata(places: DataFrame) -> DataFrame:
    """Per digest: width, height, bits and colour type of the image, from its header alone."""
    schema = "digest string, width int, height int, bits int, colour int"
    return sorted_by_place(places).mapInArrow(lean(_reader(schema, HEADER_BYTES, png_header)), schema)


def features(places: DataFrame) -> DataFrame:
    """Per digest: size and digest of the payload read back and of the stored image, and the feature."""
    schema = "digest string, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"

    def columns(image: bytes) -> tuple:
        payload = png_payload(image)
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(image), hashlib.sha256(image).hexdigest(), feature(payload)

    return sorted_by_place(places).mapInArrow(lean(_reader(schema, None, columns)), schema)
