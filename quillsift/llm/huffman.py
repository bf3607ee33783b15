"""Token ids in files: canonical length-limited Huffman codes from global counts, in independent blocks.

A file holds, in order: magic, a length-prefixed JSON header, the code length of every id (deflated), the
codes, the block table (bit offset and count of each block: the checkpoints), and the document table. The
code follows from the lengths alone. A block is decoded from its bit offset without any other block, so
all blocks of a file are decoded in step, a table look-up for each id.

Nulls and empty texts have the end id alone. Rows with a null doc_id come first; rows that repeat a doc_id
follow each other by their number of ids, then by a hash of them, and may be cut into several files. An
empty table writes nothing and gives an empty result.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, lean, open_fs, ranges, saved, scratch, shuffle_partitions, temporary, write_bytes
from .tokens import encoder, together, with_end

MAGIC = b"QSHUF001"
#: The longest code; a table of 2**LIMIT entries decodes it.
LIMIT = 18
#: Ids of a block, and of a run of blocks that is coded at once.
BLOCK, RUN = 512, 1 << 18
#: Files that share a sum on the driver; the most tasks that read files.
GROUP, MOST_TASKS = 1000, 1 << 16


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """The code length of each symbol (0 where the count is 0), optimal among those up to limit: package-merge."""
    symbols = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(symbols) <= 1:
        out[symbols] = 1
        return out
    if len(symbols) > 1 << limit:
        raise ValueError("limit is too short for so many symbols")
    symbols = symbols[np.argsort(counts[symbols], kind="stable")]
    weights = counts[symbols].astype(np.float64)
    n, coins, levels = len(symbols), weights, []
    for _ in range(limit - 1):
        packages = coins[: len(coins) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate((weights, packages))
        by = np.argsort(both, kind="stable")
        levels.append(by < n)
        coins = both[by]
    # Of the last list, the first 2n - 2 coins are taken; each package among them takes two of the list before.
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for single in reversed(levels):
        own = int(single[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    lengths[:take] += 1
    out[symbols] = lengths
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each symbol: by length, then by symbol."""
    codes = np.zeros(len(lengths), np.uint64)
    code = 0
    used = np.flatnonzero(lengths)
    by = used[np.argsort(lengths[used], kind="stable")]
    per = np.bincount(lengths[by], minlength=LIMIT + 2)
    at = 0
    for length in range(1, len(per)):
        code <<= 1
        n = int(per[length])
        codes[by[at : at + n]] = code + np.arange(n, dtype=np.uint64)
        code, at = code + n, at + n
    return codes


def pack_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Big-endian 32-bit words of the codes in a row, and the bit offset of each code."""
    upper = codes << (64 - lengths.astype(np.uint64))  # each code at the top of 64 bits
    size = lengths[ids]
    ends = np.cumsum(size, dtype=np.int64)
    at = ends - size
    value = upper[ids] >> (at & 31).astype(np.uint64)
    word = at >> 5
    first = np.flatnonzero(np.diff(word, prepend=-1))  # codes are shorter than a word: one begins in each
    words = np.zeros(int(word[-1]) + 2, np.uint64)
    words[:-1] = np.add.reduceat(value >> np.uint64(32), first)
    words[1:] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
    return words[: -(-int(ends[-1]) // 32)].astype(">u4"), at


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """For each prefix of the longest code's length: symbol times 32, plus the code's length."""
    used = np.flatnonzero(lengths)
    longest = int(lengths[used].max())
    by = used[np.argsort(lengths[used], kind="stable")]
    span = np.left_shift(1, longest - lengths[by].astype(np.int64))
    table = np.ones(1 << longest, np.uint32)
    table[: int(span.sum())] = np.repeat((by * 32 + lengths[by]).astype(np.uint32), span)
    return table, longest


def decode_blocks(words: np.ndarray, offsets: np.ndarray, counts: np.ndarray, table: tuple[np.ndarray, int]) -> np.ndarray:
    """The ids of blocks, each decoded from its own bit offset; all blocks advance together."""
    entries, longest = table
    padded = np.concatenate((words.astype(np.uint64), np.zeros(2, np.uint64)))
    pair = (padded[:-1] << np.uint64(32)) | padded[1:]
    most = int(counts.max())
    out, at = np.empty((most, len(counts)), np.uint32), offsets.astype(np.int64)
    drop = np.uint64(64 - longest)
    for k in range(most):
        peek = (pair.take(at >> 5, mode="clip") << (at & 31).astype(np.uint64)) >> drop
        entry = entries.take(peek.view(np.int64))
        out[k] = entry >> 5
        at += entry & 31
    return out.T.ravel()[ranges(np.arange(len(counts)) * most, counts.astype(np.int64))]


def file_bytes(runs: Iterator[np.ndarray], lengths: np.ndarray, doc_ids: list[pa.Array], doc_counts: list[np.ndarray]) -> Iterator[bytes]:
    """A file's bytes, run by run; the lists of documents are whole when the runs have ended."""
    codes, offsets, counts, base, words = canonical(lengths), [], [], 0, 0
    packed_lengths = zlib.compress(lengths.tobytes(), 6)
    head = json.dumps({"symbols": len(lengths), "lengths_bytes": len(packed_lengths), "block": BLOCK}).encode()
    yield MAGIC + len(head).to_bytes(4, "little") + head + packed_lengths
    for ids in runs:
        data, at = pack_bits(ids, codes, lengths)
        offsets.append(at[::BLOCK] + base)
        counts.append(np.minimum(BLOCK, len(ids) - np.arange(0, len(ids), BLOCK)))
        base += 32 * len(data)
        words += len(data)
        yield data.tobytes()
    documents = pa.record_batch([pa.concat_arrays(doc_ids), pa.array(np.concatenate(doc_counts), pa.int64())], names=["doc_id", "n_tokens"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, documents.schema) as writer:
        writer.write_batch(documents)
    table, blocks = sink.getvalue().to_pybytes(), sum(map(len, offsets))
    yield np.concatenate(offsets).astype("<u8").tobytes() + np.concatenate(counts).astype("<u2").tobytes() + table
    yield np.array([words, blocks, len(table)], "<u8").tobytes()


def read_file(path: str, run_blocks: int = 8192) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """A file's documents with their ids, some blocks at a time; a document's ids are never split."""
    fs, name = open_fs(path)
    with fs.open_input_file(name) as f:
        end = f.size()
        words, blocks, table_bytes = (int(x) for x in np.frombuffer(f.read_at(24, end - 24), "<u8"))
        top = f.read_at(12, 0)
        if top[:8] != MAGIC:
            raise ValueError(f"{path} is no token file")
        head_bytes = int.from_bytes(top[8:12], "little")
        head = json.loads(f.read_at(head_bytes, 12))
        at = 12 + head_bytes
        lengths = np.frombuffer(zlib.decompress(f.read_at(head["lengths_bytes"], at)), np.uint8)
        at += head["lengths_bytes"]
        tables = f.read_at(10 * blocks + table_bytes, at + 4 * words)
        offsets, counts = np.frombuffer(tables, "<u8", blocks).astype(np.int64), np.frombuffer(tables, "<u2", blocks, 8 * blocks).astype(np.int64)
        documents = pa.ipc.open_stream(tables[10 * blocks :]).read_all().combine_chunks().to_batches()[0]
        table, sizes = decode_table(lengths), documents.column("n_tokens").to_numpy()
        held, doc = np.zeros(0, np.uint32), 0
        for k in range(0, blocks, run_blocks):
            o, c = offsets[k : k + run_blocks], counts[k : k + run_blocks]
            stop = 4 * words if k + run_blocks >= blocks else int(offsets[k + run_blocks] + 31) // 32 * 4
            first = int(o[0]) // 32 * 4
            data = np.frombuffer(f.read_at(stop - first, at + first), ">u4")
            held = np.concatenate((held, decode_blocks(data, o - 8 * first, c, table)))
            whole = int(np.searchsorted(np.cumsum(sizes[doc:]), len(held), side="right"))
            used = int(sizes[doc : doc + whole].sum())
            if whole:
                yield held[:used], documents.slice(doc, whole)
            held, doc = held[used:], doc + whole


def encoded(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian, 16 bits where the vocabulary allows) of each document."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(tokenizer)
        kind = "<u2" if e.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        for batch in together(batches):
            ids, counts = with_end(*e.encode(batch.column("text")), end_id)
            data = ids.astype(kind)
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int64) * data.itemsize
            blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.binary())
            yield pa.record_batch([batch.column("doc_id"), pa.array(counts), blobs, pa.array([data.itemsize] * len(counts), pa.int32())], names=["doc_id", "n_tokens", "ids", "width"])

    arrow_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(lean(encode, True), "doc_id bigint, n_tokens bigint, ids binary, width int")


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    if not batch.num_rows:
        return np.zeros(0, np.uint32)
    column = batch.column("ids").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], f"<u{batch.column('width')[0].as_py()}", (offsets[-1] - offsets[0]) // batch.column("width")[0].as_py(), offsets[0]).astype(np.uint32)


def global_counts(ids: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents: at most a row for each id of the vocabulary reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            own = np.bincount(_ids(batch), minlength=len(total))
            own[: len(total)] += total
            total = own
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(total[used])], names=["id", "n"])

    rows = ids.select("ids", "width").mapInArrow(lean(count), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(int(max(rows.column("id").to_pylist(), default=-1)) + 1, np.int64)
    counts[rows.column("id").to_numpy()] = rows.column("n").to_numpy()
    return counts


def write_files(ids: DataFrame, lengths: np.ndarray, folder: str, files: int) -> DataFrame:
    """Writes the documents in ascending doc_id order, a file for each range. Gives each file's order, path and ids."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        documents, sizes, stored = [], [], [0]

        def runs() -> Iterator[np.ndarray]:
            waiting, n = [], 0
            for batch in batches:
                if not batch.num_rows:
                    continue
                documents.append(batch.column("doc_id"))
                sizes.append(batch.column("n_tokens").to_numpy())
                waiting.append(_ids(batch))
                n += len(waiting[-1])
                stored[0] += len(waiting[-1])
                if n >= RUN:
                    yield np.concatenate(waiting)
                    waiting, n = [], 0
            if n:
                yield np.concatenate(waiting)

        source = runs()
        first = next(source, None)
        if first is None:
            return

        def again() -> Iterator[np.ndarray]:
            yield first
            yield from source

        path = write_bytes(folder, f"part-{task.partitionId():06d}-{task.taskAttemptId()}.qsh", file_bytes(again(), lengths, documents, sizes))
        yield pa.record_batch([pa.array([task.partitionId()], pa.int64()), pa.array([path]), pa.array([stored[0]], pa.int64())], names=["part", "path", "n"])

    arrow_batches(ids.sparkSession)
    order = ("doc_id", "n_tokens", "__hash")
    rows = ids.withColumn("__hash", F.xxhash64("ids")).repartitionByRange(files, *order).sortWithinPartitions(*order)
    return rows.drop("__hash").mapInArrow(lean(write), "part bigint, path string, n bigint")


def placed(files: DataFrame) -> DataFrame:
    """Files (part, path, n) with start, the ids of all files before. The driver holds a sum for each GROUP of files."""
    group = F.floor(F.col("part") / GROUP)
    sums = {r["g"]: r["n"] for r in files.groupBy(group.alias("g")).agg(F.sum("n").alias("n")).collect()}
    before = files.sparkSession.createDataFrame([(g, sum(n for h, n in sums.items() if h < g)) for g in sums], "g bigint, before bigint")
    own = F.coalesce(F.sum("n").over(Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return files.withColumn("g", group).join(F.broadcast(before), "g").select("part", "path", "n", (own + F.col("before")).alias("start"))


def read_files(files: DataFrame) -> DataFrame:
    """Per document of files (part, path and start, the ids before it): doc_id, start, n_tokens and the CRC of its ids as 32-bit integers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                for ids, documents in read_file(path):
                    data, counts = memoryview(ids.astype("<u4").tobytes()), documents.column("n_tokens").to_numpy()
                    ends = np.cumsum(counts)
                    crcs = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip((ends - counts).tolist(), ends.tolist())]
                    yield pa.record_batch([documents.column("doc_id"), pa.array(start + ends - counts), documents.column("n_tokens"), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                    start += len(ids)

    arrow_batches(files.sparkSession)
    dealt = files.repartitionByRange(min(max(1, files.count()), MOST_TASKS), "part")
    return dealt.select("path", "start").mapInArrow(lean(read), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def store(docs: DataFrame, tokenizer: str, end_id: int = 2, file_tokens: int = 1 << 23) -> tuple[DataFrame, np.ndarray]:
    """Encodes and writes all documents. Gives the table of files (part: their order, path, n: their ids, start: the ids before) and the global counts."""
    spark = docs.sparkSession
    with temporary(spark):
        ids = saved(encoded(docs, tokenizer, end_id), "ids")
        counts = global_counts(ids)
        total = int(counts.sum())
        files = max(1, -(-total // file_tokens), min(shuffle_partitions(spark), -(-total // RUN)))
        written = saved(write_files(ids, code_lengths(counts), scratch(spark, "tokens", True), files), "token-files", lasting=True)
    return placed(written), counts
