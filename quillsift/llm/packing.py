"""Packing of documents into token windows by Karmarkar-Karp multiway differencing.

Every document is encoded once; its ids, an end id last, are cut into pieces of at most `piece` ids. The
pieces are dealt by a hash into groups of about `group` windows. In a group, each piece starts as a
partition of the windows with one of them loaded. The two partitions of the largest imbalance are merged,
the fullest window of one with the emptiest of the other, until one partition is left: its windows are
nearly equal. If one exceeds the capacity, the group gets one window more and is differenced again.

Nulls and empty texts have the end id alone. Rows with a null or repeated doc_id are documents of their
own. An empty table gives an empty result. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, lean, saved, shuffle_partitions
from .tokens import encoder, together, with_end

#: Bytes of text encoded at once, and pieces that a worker remembers: in a pipeline the executor's heap is full already.
AT_ONCE, PIECES_KNOWN = 3 << 20, 400_000
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PACKED = PIECES + ", sequence_id bigint, offset bigint"


def difference(lengths: np.ndarray, windows: int) -> np.ndarray:
    """The window of each length, by multiway differencing into that many windows."""
    n = len(lengths)
    # A slot of a partition is a node: items are 0..n-1, merged nodes have two children, -1 is nothing.
    left, right = np.full(n + 1, -1, np.int64), np.full(n + 1, -1, np.int64)
    chunks_l, chunks_r, nodes = [left[:n]], [right[:n]], n
    heap = [(-int(length), i, i, None) for i, length in enumerate(lengths)]
    heapq.heapify(heap)
    order, dense = n, {}

    def spread(i: int, item: int | None) -> tuple[np.ndarray, np.ndarray]:
        if item is None:
            return dense.pop(i)
        sums, slots = np.zeros(windows, np.int64), np.full(windows, -1, np.int64)
        sums[0], slots[0] = lengths[item], item
        return sums, slots

    while len(heap) > 1:
        _, _, a, a_dense = heapq.heappop(heap)
        _, _, b, b_dense = heapq.heappop(heap)
        sums, slots = spread(a, None if a_dense else a)
        if b_dense:
            other, theirs = dense.pop(b)
            sums, other, theirs = sums + other[::-1], None, theirs[::-1]
            both = np.flatnonzero((slots >= 0) & (theirs >= 0))
            slots = np.where(slots >= 0, slots, theirs)
        else:
            sums[-1] += lengths[b]
            both = np.array([windows - 1]) if slots[-1] >= 0 else np.zeros(0, np.int64)
            theirs = None
            if not len(both):
                slots[-1] = b
        if len(both):
            chunks_l.append(slots[both].copy())
            chunks_r.append(theirs[both] if theirs is not None else np.array([b]))
            slots[both] = np.arange(nodes, nodes + len(both))
            nodes += len(both)
        by = np.argsort(-sums, kind="stable")
        sums, slots = sums[by], slots[by]
        dense[order] = (sums, slots)
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), order, order, True))
        order += 1
    _, _, last, is_dense = heap[0]
    _, slots = spread(last, None if is_dense else last)
    left, right = np.concatenate(chunks_l), np.concatenate(chunks_r)
    of = np.full(nodes, -1, np.int64)
    of[slots[slots >= 0]] = np.flatnonzero(slots >= 0)
    for node in range(nodes - 1, n - 1, -1):
        of[left[node]] = of[right[node]] = of[node]
    return of[:n]


def pack_group(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Window and offset of each piece, and the number of windows: the least that differencing fills within capacity."""
    windows = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        of = difference(lengths, windows)
        if np.bincount(of, lengths, windows).max() <= capacity:
            break
        windows += 1
    by = np.argsort(of, kind="stable")
    ends = np.cumsum(lengths[by])
    starts = ends - lengths[by]
    first = np.searchsorted(of[by], np.arange(windows))
    offsets = np.empty(len(lengths), np.int64)
    offsets[by] = starts - starts[np.minimum(first, len(starts) - 1)][of[by]]
    return of, offsets, windows


def document_pieces(docs: DataFrame, tokenizer: str, piece: int, end_id: int = 2) -> DataFrame:
    """The pieces of every document, with the CRC of their ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, PIECES_KNOWN).encode
        for batch in together(batches, least=AT_ONCE):
            ids, counts = with_end(*encode(batch.column("text")), end_id)
            data = memoryview(ids.astype("<u4").tobytes())
            doc_ids, rows, at = batch.column("doc_id").to_pylist(), [], 0
            for doc_id, n in zip(doc_ids, counts.tolist()):
                for start in range(0, n, piece):
                    length = min(piece, n - start)
                    rows.append((doc_id, start, length, zlib.crc32(data[4 * (at + start) : 4 * (at + start + length)]), n))
                at += n
            names = [c.split()[0] for c in PIECES.split(", ")]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 5, names=names)

    arrow_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(lean(cut, True), PIECES)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, piece: int = 512, group: int = 256, end_id: int = 2) -> DataFrame:
    """Packs whole documents into sequences of at most capacity ids; a row per piece."""
    spark = docs.sparkSession
    pieces = saved(document_pieces(docs, tokenizer, min(piece, capacity), end_id), "pieces")
    total = pieces.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // (capacity * group)))
    tasks = min(groups, max(shuffle_partitions(spark), total // (1 << 28)))
    target = capacity * group

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        waiting: list[pa.RecordBatch] = []
        tokens = 0

        def emit(rows: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal base
            of, offsets, windows = pack_group(rows.column("length").to_numpy(), capacity)
            out = pa.record_batch([*rows.columns, pa.array(of + base), pa.array(offsets)], names=[c.split()[0] for c in PACKED.split(", ")])
            base += windows
            return out

        for batch in batches:
            ends = np.cumsum(batch.column("length").to_numpy()) + tokens
            at = 0
            while len(ends) > at and ends[-1] >= target:
                cut = int(np.searchsorted(ends, target, side="right"))
                yield emit(pa.concat_batches([*waiting, batch.slice(at, cut - at)]))
                ends = ends - (ends[cut - 1] if cut else tokens)
                waiting, tokens, at = [], 0, cut
            waiting.append(batch.slice(at))
            tokens = int(ends[-1]) if len(ends) > at else 0
        if rows := [w for w in waiting if w.num_rows]:
            yield emit(pa.concat_batches(rows))

    return pieces.repartition(int(tasks), F.xxhash64("doc_id", "start", "ids_crc32")).sortWithinPartitions("doc_id", "start", "ids_crc32").mapInArrow(lean(packed), PACKED)
