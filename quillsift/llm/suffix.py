"""Removal of bytes that an earlier document has too, by interval expansion on Burrows-Wheeler transforms.

Every string of LEAST bytes has one anchor: of its ANCHOR-byte strings the one with the smallest hash, the
first of several. Equal strings have equal anchors, so they meet wherever the anchors do:

1. Texts are put into blocks, kept in files in the shared folder. Each block sends its anchors' hashes,
   once each, to buckets.
2. A bucket answers which anchors occur in two documents at least, and which of them in many blocks.
3. A block sends, for each such anchor, the digest of the stretch of text whose strings have that anchor,
   once for equal stretches; for anchors of many blocks it sends the strings one by one, dealt by their own
   hash, so that a common anchor with ever different surroundings never meets in one bucket. A bucket
   answers which stretches a smaller document has too, and which anchors have different stretches. Only of
   those the bytes are sent. Equal stretches are told by 128 bits: 40 of the anchor's hash or, for strings
   sent one by one, of their own, 24 more of their own, and 64 of a hash to another base.
4. A bucket finds their equal strings. Its intervals (strings with a common prefix, in suffix order) begin
   with the empty prefix; each round puts the preceding byte, the Burrows-Wheeler column, before the prefix
   and splits the intervals by it: breadth first, common prefixes grow by one, and intervals within one
   document are left. At LEAST it stops; a string is removed if its interval has a smaller doc_id.
5. A block covers what was found and cuts it out.

Only hashes, digests, stretches that may repeat in part, and results are shuffled. Null counts as an empty text. Rows with a
null doc_id come after all others, and repeated doc_ids are one document: no smaller doc_id, no removal.
An empty table gives an empty result. Other columns are carried along only when asked for.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .common import arrow_batches, lean, open_fs, ranges, saved, scratch, shuffle_partitions, trim, utf8

LEAST, ANCHOR = 50, 32
#: Bytes of a block, and bytes that are hashed at once.
BLOCK, STEP = 1 << 20, 1 << 18
#: The most strings of a stretch.
LONGEST = 128
#: An anchor in more blocks than this sends its strings one by one.
MANY = 64
NEVER = np.iinfo(np.int64).max
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Of the second hash of a stretch.
OTHER = np.uint64(0xD6E8FEB86659FD93)


def hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each string of that many bytes, by doubling."""
    with np.errstate(over="ignore"):
        part, length, power = data.astype(np.uint64) + np.uint64(1), 1, BASE
        out, done = None, 0
        while True:
            if size & length:
                if out is None:
                    out, done = part, length
                else:
                    n = len(data) - done - length + 1
                    out = out[:n] * power + part[done : done + n]
                    done += length
            if done == size:
                break
            part = part[:-length] * power + part[length:]
            power, length = power * power, 2 * length
        out = out ^ (out >> np.uint64(31))
        out *= np.uint64(0xBF58476D1CE4E5B9)
        return out ^ (out >> np.uint64(29))


def smallest(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    now, n = x, 1
    while 2 * n <= width:
        now, n = np.minimum(now[:-n], now[n:]), 2 * n
    rest = len(x) - width + 1
    return np.minimum(now[:rest], now[width - n : width - n + rest]) if n < width else now


def anchored(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings of LEAST bytes with one anchor: the anchor's hash, the first start, the number of starts, the document's number."""
    width, out = LEAST - ANCHOR + 1, []
    for at in range(0, max(0, len(data) - LEAST + 1), STEP):
        piece = data[at : at + STEP + LEAST - 1]
        if len(piece) < LEAST:
            break
        low = smallest(hashes(piece, ANCHOR), width)
        first = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
        out.append((low[first], first + at, np.diff(np.concatenate((first, [len(low)])))))
    if not out:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3
    key, start, count = (np.concatenate(x) for x in zip(*out))
    with np.errstate(over="ignore"):
        key = (key ^ (key >> np.uint64(32))) * BASE  # least hashes are small: spread them again
        key ^= key >> np.uint64(32)
    # Runs are cut where a document ends: its last starts lie LEAST - 1 bytes before.
    sizes = np.diff(offsets)
    docs = np.flatnonzero(sizes >= LEAST)
    lo, hi = offsets[docs], offsets[docs + 1] - LEAST + 1
    a, b = np.searchsorted(start + count, lo, side="right"), np.searchsorted(start, hi, side="left")
    many = b - a
    run = ranges(a, many)
    doc = np.repeat(np.arange(len(docs)), many)
    begin = np.maximum(start[run], lo[doc])
    end = np.minimum(start[run] + count[run], hi[doc])
    pieces = -(-(end - begin) // LONGEST)  # periodic text has one anchor's hash again and again
    of = np.repeat(np.arange(len(run)), pieces)
    begin = begin[of] + LONGEST * ranges(np.zeros(len(run), np.int64), pieces)
    return key[run][of], begin, np.minimum(LONGEST, end[of] - begin), docs[doc[of]]


def buckets_of(key: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket numbers; they ascend with the hash."""
    return (((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def dealt(order_by: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted bucket numbers."""
    return np.searchsorted(order_by, np.arange(buckets + 1))


def distinct_anchors(key: np.ndarray, doc_ids: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A block's distinct anchors, ascending; whether two documents have it; where each bucket begins; each run's anchor."""
    if not len(key):
        return key, np.zeros(0, bool), np.zeros(buckets + 1, np.int64), np.zeros(0, np.int64)
    by = np.argsort(key, kind="stable")
    key, ids = key[by], doc_ids[by]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    first, of = np.flatnonzero(new), np.empty(len(key), np.int64)
    of[by] = np.cumsum(new) - 1
    several = np.minimum.reduceat(ids, first) < np.maximum.reduceat(ids, first)
    return key[first], several, dealt(buckets_of(key[first], buckets), buckets), of


class BlockFile:
    """A task's blocks in one file of the shared folder."""

    def __init__(self, folder: str):
        task = TaskContext.get()
        self.path = f"{folder}/blocks-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        fs, base = open_fs(folder)
        fs.create_dir(base, recursive=True)
        self.stream, self.at = fs.open_output_stream(open_fs(self.path)[1]), 0

    def add(self, block: pa.RecordBatch) -> tuple[int, int]:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, block.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(block)
        return self.add_bytes(sink.getvalue().to_pybytes())

    def add_bytes(self, data: bytes) -> tuple[int, int]:
        self.stream.write(data)
        self.at += len(data)
        return self.at - len(data), len(data)


def load(path: str, offset: int, length: int) -> pa.RecordBatch:
    fs, name = open_fs(path)
    with fs.open_input_file(name) as f:
        return pa.ipc.open_stream(f.read_at(length, offset)).read_all().combine_chunks().to_batches()[0]


def order_of(block: pa.RecordBatch, column: str) -> np.ndarray:
    return block.column(column).fill_null(NEVER).to_numpy(zero_copy_only=False).astype(np.int64)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays in a row, compressed, after their sizes."""
    raw = b"".join([np.array([len(a) for a in arrays], "<i8").tobytes(), *(a.tobytes() for a in arrays)])
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    sizes, at, out = np.frombuffer(raw, "<i8", len(kinds)), 8 * len(kinds), []
    for n, kind in zip(sizes, kinds):
        out.append(np.frombuffer(raw, kind, n, at))
        at += int(n) * np.dtype(kind).itemsize
    return out


def narrow(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents' numbers as the least one and the differences, in two bytes each where they fit."""
    base = doc.min(initial=NEVER)
    apart = (doc.astype("<i8") - base).view("<u8")
    return np.array([base], "<i8"), apart.astype("<u2") if apart.max(initial=np.uint64(0)) < 1 << 16 else apart


def as_bytes(pair: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return pair[0], pair[1].view(np.uint8)


def wide(base: np.ndarray, apart: np.ndarray, n: int) -> np.ndarray:
    apart = apart.view("<u2" if len(apart) == 2 * n else "<u8").astype("<u8")
    return (apart + base.astype("<u8")[0]).astype("<i8")


def runs_by(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[list[dict]]:
    """Rows with the same value of a column, as sorted batches bring them. After a block memory goes back to the system."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[-1][column] != row[column]:
                yield held
                held = []
                if column == "block":
                    trim()
            held.append(row)
    if held:
        yield held


def bits(x: np.ndarray) -> bytes:
    return np.packbits(x).tobytes()


def unbits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def short(keys: np.ndarray, size: int = 5) -> bytes:
    """The low bytes of each hash: where an anchor is matched falsely, that costs a comparison, no more."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def unshort(data: bytes, size: int = 5) -> np.ndarray:
    out = np.zeros((len(data) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8).reshape(-1, size)
    return out.view("<u8").ravel()


def judged(key: np.ndarray, other: np.ndarray, digest: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which stretches a smaller document has too; and which others have an anchor with different stretches."""
    if not len(key):
        return np.zeros(0, bool), np.zeros(0, bool)
    by = np.lexsort((digest, other, key))
    k, o, g, d = key[by], other[by], digest[by], doc[by]
    new_key = np.concatenate(([True], k[1:] != k[:-1]))
    new = new_key | np.concatenate(([True], (o[1:] != o[:-1]) | (g[1:] != g[:-1])))
    first = np.flatnonzero(new)
    low = np.minimum.reduceat(d, first)[np.cumsum(new) - 1]
    kinds = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_key))[np.cumsum(new_key) - 1]
    whole, asked = np.empty(len(key), bool), np.empty(len(key), bool)
    whole[by], asked[by] = d > low, (d == low) & (kinds > 1)
    return whole, asked


def occurrences(rows: list[dict], many_blocks: int) -> list[tuple[bytes, bytes]]:
    """For each block's anchors in a bucket: which occur in two documents, and which in many blocks, as bits."""
    keys = [unshort(r["keys"]) for r in rows]
    several = np.concatenate([unbits(r["flags"], len(k)) for r, k in zip(rows, keys)])
    every = np.concatenate(keys)
    if not len(every):
        return [(b"", b"")] * len(rows)
    by = np.argsort(every, kind="stable")
    ordered = every[by]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    n = np.diff(np.concatenate((first, [len(ordered)])))
    shared = (n > 1) | np.bitwise_or.reduceat(several[by], first)
    yes, many = np.empty(len(every), bool), np.empty(len(every), bool)
    yes[by], many[by] = np.repeat(shared, n), np.repeat(n > many_blocks, n)
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    return [(bits(y), bits(m)) for y, m in zip(np.split(yes, cuts), np.split(many, cuts))]


def string_hashes(data: np.ndarray, start: np.ndarray, length: np.ndarray, part: int = 1 << 20, base: np.uint64 = BASE) -> np.ndarray:
    """A hash of each string, from sums over all bytes up to a place: (S(end) - S(start)) / base**start modulo 2**64."""
    out, longest = np.empty(len(start), np.uint64), int(length.max(initial=0))
    n = min(len(data), part + longest)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, base, np.uint64))))
        back = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, np.uint64(pow(int(base), -1, 1 << 64)), np.uint64))))
        where = start // part
        for k in np.unique(where):
            own = np.flatnonzero(where == k)
            piece = data[k * part : (k + 1) * part + longest]
            sums = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * power[: len(piece)], out=sums[1:])
            a, size = start[own] - k * part, length[own]
            total = (sums[a + size] - sums[a]) * back[a]
            total ^= (total >> np.uint64(32)) ^ (size.astype(np.uint64) << np.uint64(48))
            total *= base
            out[own] = total ^ (total >> np.uint64(29))
    return out


def first_of_equal(data: np.ndarray, start: np.ndarray, length: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts strings so that equal ones are neighbours, the smallest document first; and which begin a group. Bytes decide, not hashes."""
    total = string_hashes(data, start, length)
    by = np.lexsort((doc, length, total))
    new = np.ones(len(by), bool)
    alike = np.flatnonzero((total[by][1:] == total[by][:-1]) & (length[by][1:] == length[by][:-1]))
    if len(alike):
        a, b, n = start[by][alike], start[by][alike + 1], length[by][alike]
        differ = np.bitwise_or.reduceat(data[ranges(a, n)] ^ data[ranges(b, n)], np.cumsum(n) - n)
        new[alike[differ == 0] + 1] = False
    return by, new


def expand(data: np.ndarray, start: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The smallest document of the strings of LEAST bytes that are equal to the one at each start."""
    least = doc.copy()
    active, interval = np.arange(len(start)), np.zeros(len(start), np.int64)
    for common in range(LEAST):
        if not len(active):
            break
        before = data[start[active] + (LEAST - 1 - common)]  # the column of bytes before the common prefix
        by = np.argsort(before, kind="stable")
        active, interval, before = active[by], interval[by], before[by]
        new = np.concatenate(([True], (before[1:] != before[:-1]) | (interval[1:] != interval[:-1])))
        first = np.flatnonzero(new)
        low, high = np.minimum.reduceat(doc[active], first), np.maximum.reduceat(doc[active], first)
        number = np.cumsum(new) - 1
        if common == LEAST - 1:
            least[active] = low[number]
        keep = (low < high)[number]
        active, interval = active[keep], number[keep]
    return least


def cover(starts: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes, as begins and ends, that strings of LEAST bytes at runs of starts cover."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    by = np.argsort(starts, kind="stable")
    a, b = starts[by], (starts + counts)[by] + LEAST - 1
    b = np.maximum.accumulate(b)
    new = np.concatenate(([True], a[1:] > b[:-1]))
    return a[new], b[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(a) - 1]))]


PLACES = "bucket int, block bigint, path string, at bigint, size bigint, places string, places_at bigint, places_size bigint, data binary"
PLACES_ARROW = pa.schema([(c.split()[0], {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]]) for c in PLACES.split(", ")])


class Removal:
    """The steps over one table."""

    def __init__(self, docs: DataFrame, carry: list[str], block: int, many: int):
        self.spark, self.block, self.many = docs.sparkSession, block, many
        self.rows = docs.select(F.struct(*[docs[c] for c in carry]).alias("carry"), F.col("doc_id").cast("bigint").alias("__order"), F.coalesce("text", F.lit("")).cast("binary").alias("__text"))
        self.folder = scratch(self.spark, "blocks")
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.parts = shuffle_partitions(self.spark)
        self.buckets = int(max(4 * self.parts, size >> 24))
        arrow_batches(self.spark)

    def anchors(self) -> DataFrame:
        folder, buckets, block_bytes = self.folder, self.buckets, self.block

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            base, file, waiting, n = TaskContext.get().partitionId() << 24, None, [], 0

            def done() -> pa.RecordBatch:
                nonlocal base, file
                file = file or BlockFile(folder)
                block = pa.concat_batches(waiting)
                data, offsets = utf8(block.column("__text"))
                key, _, _, doc = anchored(data, offsets)
                key, several, cuts, _ = distinct_anchors(key, order_of(block, "__order")[doc], buckets)
                offset, length = file.add(block)
                # A bucket without anchors of this block gets no row; the first bucket always does.
                used = np.union1d(np.flatnonzero(np.diff(cuts)), [base % buckets])
                rows = {
                    "bucket": pa.array(used, pa.int32()), "block": pa.array([base] * len(used), pa.int64()), "path": pa.array([file.path] * len(used)), "at": pa.array([offset] * len(used), pa.int64()), "size": pa.array([length] * len(used), pa.int64()),
                    "keys": pa.array([short(key[cuts[k] : cuts[k + 1]]) for k in used], pa.binary()), "flags": pa.array([bits(several[cuts[k] : cuts[k + 1]]) for k in used], pa.binary()),
                }
                base += 1
                return pa.record_batch(list(rows.values()), names=list(rows))

            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    part = batch.slice(at, 64)
                    n += part.column("__text").nbytes
                    waiting.append(part)
                    if n >= block_bytes:
                        yield done()
                        waiting, n = [], 0
                        trim()
            if waiting:
                yield done()
            if file:
                file.stream.close()

        return self.rows.mapInArrow(lean(blocks), "bucket int, block bigint, path string, at bigint, size bigint, keys binary, flags binary")

    def answers(self) -> DataFrame:
        many_blocks = self.many

        def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in runs_by(batches, "bucket"):
                found = occurrences(rows, many_blocks)
                columns = [pa.array([r[c] for r in rows], t) for c, t in (("bucket", pa.int32()), ("block", pa.int64()), ("path", pa.string()), ("at", pa.int64()), ("size", pa.int64()))]
                yield pa.record_batch([*columns, pa.array([y for y, _ in found], pa.binary()), pa.array([m for _, m in found], pa.binary())], names=["bucket", "block", "path", "at", "size", "shared", "many"])

        dealt_rows = self.by_bucket(self.anchors()).sortWithinPartitions("bucket", "block")
        return saved(dealt_rows.mapInArrow(lean(answer), "bucket int, block bigint, path string, at bigint, size bigint, shared binary, many binary"), "anchors")

    def by_bucket(self, rows: DataFrame) -> DataFrame:
        """Deals buckets in turn: as many to each task, not as a hash has it."""
        n = min(self.buckets, 2 * self.parts)
        return rows.repartitionById(n, F.pmod("bucket", F.lit(n)).cast("int"))

    def digests(self, answers: DataFrame) -> DataFrame:
        """For each block and bucket: anchor, digest and document of each stretch. The stretches' places are kept in files."""
        buckets, folder = self.buckets, self.folder + "/stretches"

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            file = None
            for rows in runs_by(batches, "block"):
                block = load(rows[0]["path"], rows[0]["at"], rows[0]["size"])
                data, offsets = utf8(block.column("__text"))
                key, start, count, doc = anchored(data, offsets)
                ids = order_of(block, "__order")[doc]
                own, _, cuts, place = distinct_anchors(key, ids, buckets)
                shared, many = np.zeros(len(own), bool), np.zeros(len(own), bool)
                for r in rows:
                    a, b = cuts[r["bucket"]], cuts[r["bucket"] + 1]
                    shared[a:b], many[a:b] = unbits(r["shared"], b - a), unbits(r["many"], b - a)
                yes, single = shared[place], shared[place] & many[place]
                # Stretches, and the strings of common anchors one by one, dealt by their own hash.
                each, rest = np.flatnonzero(single), np.flatnonzero(yes & ~single)
                lone = ranges(start[each].astype(np.int32), count[each])
                s = np.concatenate((start[rest].astype(np.int32), lone))
                c = np.concatenate((count[rest].astype(np.int32), np.ones(len(lone), np.int32)))
                d = np.concatenate((ids[rest], np.repeat(ids[each], count[each])))
                del lone, start, count, doc, place, ids
                digest = string_hashes(data, s, c + LEAST - 1) if len(s) else np.zeros(0, np.uint64)
                to = np.concatenate((key[rest], digest[len(rest) :]))
                other = string_hashes(data, s, c + LEAST - 1, base=OTHER) if len(s) else digest
                del key, data
                by = np.lexsort((d, other, digest))
                new = np.concatenate(([True], (np.diff(digest[by]) != 0) | (np.diff(other[by]) != 0))) if len(by) else np.zeros(0, bool)
                low = d[by][new][np.cumsum(new) - 1]
                again = by[d[by] > low]  # a smaller document of this block has the same
                one = by[d[by] == low]  # a document may have it twice
                one = one[np.argsort(to[one], kind="stable")]
                file = file or BlockFile(folder)
                places = pack(s[one].astype("<u4"), c[one].astype("<u1"), d[one].astype("<i8"), s[again].astype("<u4"), c[again].astype("<u2"))
                at, size = file.add_bytes(places)
                edge = dealt(buckets_of(to[one], buckets), buckets)
                used = np.union1d(np.flatnonzero(np.diff(edge)), [rows[0]["block"] % buckets])  # at least one row
                digest >>= np.uint64(64 - 24)
                own = [one[edge[k] : edge[k + 1]] for k in used]
                blobs = [pack(*(np.frombuffer(short(x[o], size), np.uint8) for x, size in ((to, 5), (other, 8), (digest, 3))), *as_bytes(narrow(d[o]))) for o in own]
                n = len(used)
                out = {
                    "bucket": pa.array(used, pa.int32()), "block": pa.array([rows[0]["block"]] * n, pa.int64()), "path": pa.array([rows[0]["path"]] * n), "at": pa.array([rows[0]["at"]] * n, pa.int64()), "size": pa.array([rows[0]["size"]] * n, pa.int64()),
                    "places": pa.array([file.path] * n), "places_at": pa.array([at] * n, pa.int64()), "places_size": pa.array([size] * n, pa.int64()), "data": pa.array(blobs, pa.binary()),
                }
                yield pa.record_batch(list(out.values()), names=list(out))
            if file:
                file.stream.close()

        by_block = answers.repartition(4 * self.parts, "block").sortWithinPartitions("block", "bucket")
        return by_block.mapInArrow(lean(send), PLACES)

    def verdicts(self, digests: DataFrame) -> DataFrame:
        """For each stretch, as bits: whether a smaller document has the same, and whether its bytes are asked for."""

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in runs_by(batches, "bucket"):
                parts = [unpack(r["data"], "<u1", "<u1", "<u1", "<i8", "<u1") for r in rows]
                key, other, digest = (unshort(b"".join(p[k].tobytes() for p in parts), size) for k, size in enumerate((5, 8, 3)))
                sizes = [len(p[0]) // 5 for p in parts]
                doc = np.concatenate([wide(p[3], p[4], n) for p, n in zip(parts, sizes)])
                whole, asked = judged(key, other, digest, doc)
                cuts = np.cumsum(sizes)[:-1]
                for r, w, a in zip(rows, np.split(whole, cuts), np.split(asked, cuts)):
                    r["data"] = len(w).to_bytes(4, "little") + bits(w) + bits(a)
                yield pa.RecordBatch.from_pylist(rows, schema=PLACES_ARROW)

        dealt_rows = self.by_bucket(digests).sortWithinPartitions("bucket", "block")
        return saved(dealt_rows.mapInArrow(lean(judge), PLACES), "verdicts")

    def stretches(self, verdicts: DataFrame) -> DataFrame:
        """The bytes that are asked for, by bucket; what is removed already goes under negative buckets."""
        buckets = self.buckets

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in runs_by(batches, "block"):
                first = rows[0]
                fs, name = open_fs(first["places"])
                with fs.open_input_file(name) as f:
                    s, c, d, s_gone, c_gone = (x.astype(np.int64) for x in unpack(f.read_at(first["places_size"], first["places_at"]), "<u4", "<u1", "<i8", "<u4", "<u2"))
                whole, asked, bucket = [np.zeros(0, bool)], [np.zeros(0, bool)], []
                for r in rows:
                    n = int.from_bytes(r["data"][:4], "little")
                    half = (n + 7) // 8
                    whole.append(unbits(r["data"][4 : 4 + half], n))
                    asked.append(unbits(r["data"][4 + half :], n))
                    bucket.append(np.full(n, r["bucket"]))
                whole, asked, bucket = np.concatenate(whole), np.concatenate(asked), np.concatenate(bucket)
                out = [(-1 - first["block"] % buckets, pack(np.concatenate((s_gone, s[whole])).astype("<u4"), np.concatenate((c_gone, c[whole])).astype("<u2")))]
                if asked.any():
                    data, _ = utf8(load(first["path"], first["at"], first["size"]).column("__text"))
                    for k in np.unique(bucket[asked]):
                        mine = np.arange(*np.searchsorted(bucket, [k, k + 1]))
                        mine = mine[asked[mine]]
                        n = c[mine] + LEAST - 1
                        out.append((int(k), pack(c[mine].astype("<u1"), d[mine].astype("<i8"), s[mine].astype("<u4"), data[ranges(s[mine], n)])))
                head = [pa.array([first[x]] * len(out), t) for x, t in (("block", pa.int64()), ("path", pa.string()), ("at", pa.int64()), ("size", pa.int64()))]
                yield pa.record_batch([pa.array([k for k, _ in out], pa.int32()), *head, pa.array([x for _, x in out], pa.binary())], names=["bucket", "block", "path", "at", "size", "data"])

        by_block = verdicts.repartition(4 * self.parts, "block").sortWithinPartitions("block", "bucket")
        return by_block.mapInArrow(lean(send), "bucket int, block bigint, path string, at bigint, size bigint, data binary")

    def found(self, stretches: DataFrame) -> DataFrame:
        """Runs of strings to remove, by block. Rows with a negative bucket are such already."""

        def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in runs_by(batches, "bucket"):
                if rows[0]["bucket"] < 0:
                    kinds = (pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
                    yield pa.record_batch([pa.array([r[c] for r in rows], t) for c, t in zip(rows[0], kinds)], names=list(rows[0]))
                    continue
                parts = [unpack(r["data"], "<u1", "<i8", "<u4", "<u1") for r in rows]
                count, doc, place = (np.concatenate([p[k] for p in parts]).astype(np.int64) for k in range(3))
                data = np.concatenate([p[3] for p in parts])
                owner = np.repeat(np.arange(len(rows)), [len(p[0]) for p in parts])
                length = count + LEAST - 1
                start = np.cumsum(length) - length
                by, new = first_of_equal(data, start, length, doc)
                heads = by[new]
                low = doc[heads]
                whole = by[doc[by] > low[np.cumsum(new) - 1]]
                # The strings of each distinct stretch, with the smallest document that has the stretch.
                strings, of = ranges(start[heads], count[heads]), np.repeat(np.arange(len(heads)), count[heads])
                removed = expand(data, strings, low[of]) < low[of]
                inner = np.cumsum(count[heads]) - count[heads]
                run_start, run_count, run_of = string_runs(removed, of)
                group = np.cumsum(new) - 1
                # Every stretch equal to the head and of its document loses what the head loses.
                same = by[doc[by] == low[group]]
                same_group = group[doc[by] == low[group]]
                per = np.bincount(run_of, minlength=len(heads))
                run_at = np.cumsum(per) - per
                pick = ranges(run_at[same_group], per[same_group])
                who = np.repeat(same, per[same_group])
                s = np.concatenate((place[whole], place[who] + run_start[pick] - inner[run_of[pick]]))
                c = np.concatenate((count[whole], run_count[pick]))
                o = np.concatenate((owner[whole], owner[who]))
                by_owner = np.argsort(o, kind="stable")
                s, c, o = s[by_owner], c[by_owner], o[by_owner]
                cuts = np.searchsorted(o, np.arange(len(rows) + 1))
                used = np.flatnonzero(np.diff(cuts))
                if len(used):
                    columns = [pa.array([rows[k][n] for k in used], t) for n, t in (("block", pa.int64()), ("path", pa.string()), ("at", pa.int64()), ("size", pa.int64()))]
                    yield pa.record_batch([pa.array([rows[k]["bucket"] for k in used], pa.int32()), *columns, pa.array([pack(s[cuts[k] : cuts[k + 1]].astype("<u4"), c[cuts[k] : cuts[k + 1]].astype("<u2")) for k in used], pa.binary())], names=["bucket", "block", "path", "at", "size", "data"])

        dealt_rows = self.by_bucket(stretches).sortWithinPartitions("bucket", "block")
        return saved(dealt_rows.mapInArrow(lean(match), stretches.schema), "removed", "none")

    def kept(self) -> DataFrame:
        """carry, a struct of the carried columns, with n_bytes, n_removed, n_spans and kept, the bytes that stay."""
        removed = self.found(self.stretches(self.verdicts(self.digests(self.answers()))))
        schema = StructType([self.rows.schema["carry"]] + [StructField(c, LongType()) for c in ("n_bytes", "n_removed", "n_spans")] + [StructField("kept", BinaryType())])

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in runs_by(batches, "block"):
                block = load(rows[0]["path"], rows[0]["at"], rows[0]["size"])
                data, offsets = utf8(block.column("__text"))
                starts, counts = (np.concatenate(x).astype(np.int64) for x in zip(*(unpack(r["data"], "<u4", "<u2") for r in rows)))
                doc = np.searchsorted(offsets, starts, side="right") - 1
                out = np.zeros((len(offsets) - 1, 3), np.int64)
                out[:, 0] = np.diff(offsets)
                stay = np.ones(len(data), bool)
                by = np.argsort(doc, kind="stable")
                edges = np.searchsorted(doc[by], np.arange(len(offsets)))
                for k in np.unique(doc):
                    own = by[edges[k] : edges[k + 1]]
                    a, b = cover(starts[own], counts[own], len(data))
                    out[k, 1:] = (b - a).sum(), len(a)
                    stay[ranges(a, b - a)] = False
                ends = np.concatenate(([0], np.cumsum(out[:, 0] - out[:, 1])))
                left = data[stay]
                whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(out), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(left)]).cast(pa.binary())
                yield pa.record_batch([block.column("carry"), *(pa.array(out[:, k]) for k in range(3)), whole], names=["carry", "n_bytes", "n_removed", "n_spans", "kept"])

        by_block = removed.repartition(4 * self.parts, "block").sortWithinPartitions("block", "bucket")
        return by_block.mapInArrow(lean(cut), schema)


def string_runs(removed: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of removed strings within a stretch: first string, number of strings, stretch."""
    at = np.flatnonzero(removed)
    if not len(at):
        return at, at, at
    new = np.concatenate(([True], (np.diff(at) > 1) | (np.diff(of[at]) > 0)))
    first = np.flatnonzero(new)
    return at[first], np.diff(np.concatenate((first, [len(at)]))), of[at[first]]


def removal(docs: DataFrame, carry: list[str], block: int = BLOCK, many: int = MANY) -> DataFrame:
    """For each row: the carried columns, n_bytes, n_removed, n_spans, and kept, the bytes that stay."""
    return Removal(docs, carry, block, many).kept().select("carry.*", "n_bytes", "n_removed", "n_spans", "kept")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of docs with what an earlier document has cut out of text; n_chars, if there is one, follows.

    A character that is cut into goes too. Rows of which nothing is left but white space are dropped; rows
    that were empty before stay, with an empty text for null.
    """
    carry = [c for c in docs.columns if c != "text"]
    found = Removal(docs, carry, BLOCK, MANY).kept()
    schema = StructType([found.schema["carry"], StructField("text", StringType()), StructField("n_removed", LongType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [x.decode("utf-8", "ignore") for x in batch.column("kept").to_pylist()]
            yield pa.record_batch([batch.column("carry"), pa.array(text, pa.string()), batch.column("n_removed")], names=schema.names)

    out = found.mapInArrow(lean(decode), schema).filter("n_removed = 0 or length(trim(text)) > 0")
    out = out.select(*[F.col("text") if c == "text" else F.col("carry").getField(c).alias(c) for c in docs.columns])
    if "n_chars" in carry:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
