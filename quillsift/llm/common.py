"""What the operators of this subpackage share: scratch folders, saved tables, Arrow helpers."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import hashlib
import os
import pathlib
import shutil
import sys
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch handed to Python: documents are long, so batches are short.
BATCH_ROWS = 512


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='quillsift-')}"
        spark.sparkContext.setCheckpointDir(found)
    return found if ":" in found.split("/")[0] else f"file://{os.path.abspath(found)}"


#: Names that scratch() gave within each temporary() that is open.
_open: list[list[str]] = []


def scratch(spark: SparkSession, tag: str, lasting: bool = False) -> str:
    """A new folder name in the shared folder. Within temporary(), what is not lasting is deleted at its end."""
    path = f"{shared_dir(spark).rstrip('/')}/quillsift/{tag}-{uuid.uuid4().hex[:12]}"
    if _open and not lasting:
        _open[-1].append(path)
    elif len(_open) > 1:
        _open[-2].append(path)  # it lasts as long as what is around
    return path


def saved(df: DataFrame, tag: str, codec: str = "zstd", lasting: bool = False) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts the lineage, and a lost executor costs no earlier stage."""
    spark = df.sparkSession
    path = scratch(spark, tag, lasting)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def temporary(spark: SparkSession):
    """Deletes, at its end, the folders that were named within it and do not last: results that are read later must be saved as lasting."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors, once, where they may not have it installed."""
    sc = spark.sparkContext
    if not getattr(sc, "_quillsift_shipped", False):
        root, folder = pathlib.Path(__file__).resolve().parents[1], tempfile.mkdtemp(prefix="quillsift-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        with zipfile.ZipFile(f"{folder}/quillsift.zip", "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(f"{folder}/quillsift.zip")
        sc._quillsift_shipped = True


def arrow_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bounds the rows of the Arrow batches that this session sends to Python."""
    ship(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) != rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


LIBC = ctypes.CDLL(None) if sys.platform == "linux" and hasattr(ctypes.CDLL(None), "malloc_trim") else None
_kept: dict[str, object] = {}


def kept(name: str, make):
    """What a worker keeps between tasks under a name: one thing at a time, so that operators do not add up."""
    if name not in _kept:
        _kept.clear()
        trim()
        _kept[name] = make()
    return _kept[name]


def trim() -> None:
    """Gives memory that is free back to the system: a worker lives on beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    if LIBC is not None:
        LIBC.malloc_trim(0)


def lean(function, keeps: bool = False):
    """A function for mapInArrow whose worker holds little before and after it; keeps: what is kept stays."""

    def run(batches):
        begin(keeps)
        yield from function(batches)
        trim()

    return run


def begin(keeps: bool) -> None:
    if not keeps:
        _kept.clear()
    pa.set_memory_pool(pa.system_memory_pool())
    trim()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """A file system that any executor can open, and the path in it."""
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def write_bytes(folder: str, name: str, chunks) -> str:
    """Writes a file under an attempt's own name and moves it in place when it is whole. Returns its path."""
    fs, base = open_fs(folder)
    fs.create_dir(base, recursive=True)
    unfinished, path = f"{base}/.{name}.{uuid.uuid4().hex}", f"{base}/{name}"
    with fs.open_output_stream(unfinished) as out:
        for chunk in chunks:
            out.write(chunk)
    fs.move(unfinished, path)
    return f"{folder}/{name}"


def utf8(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one after another, in the type of starts."""
    ends = np.cumsum(lengths, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = starts.dtype if total < 1 << 31 else np.dtype(np.int64)
    out = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
    out += np.arange(total, dtype=kind)
    return out


def located(df: DataFrame) -> DataFrame:
    """df with __path and __row, where each of its rows is stored. What is no plain scan of files is saved first."""
    if df._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        df = saved(df, "located")
    return df.select("*", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__row"))


def noted(rows: DataFrame, columns: list[str]) -> str:
    """Notes whole numbers about stored rows (__path, __row and the columns) in a file for each path; gives the folder.

    Tasks that scan the rows look their notes up there, so that no text is shuffled to join them.
    """
    folder = scratch(rows.sparkSession, "notes")

    def write(batches):
        held: list[pa.RecordBatch] = []

        def done() -> pa.RecordBatch:
            path, sink = held[0].column("__path")[0].as_py(), pa.BufferOutputStream()
            table = pa.concat_batches(held).select(["__row", *columns])
            with pa.ipc.new_stream(sink, table.schema) as out:
                out.write_batch(table)
            return pa.record_batch([pa.array([write_bytes(folder, note_name(path), [sink.getvalue().to_pybytes()])])], names=["file"])

        for batch in batches:
            for path in dict.fromkeys(batch.column("__path").to_pylist()):
                if held and held[0].column("__path")[0].as_py() != path:
                    yield done()
                    held.clear()
                held.append(batch.filter(pc.equal(batch.column("__path"), path)))
        if held:
            yield done()

    arrow_batches(rows.sparkSession, 1 << 14)
    dealt = rows.select("__path", F.col("__row").cast("bigint"), *[F.col(c).cast("bigint") for c in columns]).repartition("__path").sortWithinPartitions("__path", "__row")
    saved(dealt.mapInArrow(lean(write), "file string"), "note-files")
    return folder


def note_name(path: str) -> str:
    return hashlib.sha1(path.encode()).hexdigest() + ".arrow"


class Notes:
    """The notes of a folder, path by path."""

    def __init__(self, folder: str):
        self.folder, self.path, self.table = folder, None, None

    def of(self, path: str) -> pa.RecordBatch | None:
        if path != self.path:
            fs, name = open_fs(f"{self.folder}/{note_name(path)}")
            self.path, self.table = path, None
            if fs.get_file_info(name).type != pafs.FileType.NotFound:
                with fs.open_input_file(name) as f:
                    self.table = pa.ipc.open_stream(f.read()).read_all().combine_chunks().to_batches()[0]
        return self.table

    def find(self, batch: pa.RecordBatch) -> tuple[np.ndarray, pa.RecordBatch | None]:
        """The numbers of a batch's rows (with __path and __row) that have notes, and those."""
        paths, rows, at, notes = batch.column("__path").to_pylist(), batch.column("__row").to_numpy(), [], []
        cuts = [0, *(k for k in range(1, len(paths)) if paths[k] != paths[k - 1]), len(paths)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b or (table := self.of(paths[a])) is None:
                continue
            known = table.column("__row").to_numpy()
            place = np.minimum(np.searchsorted(known, rows[a:b]), len(known) - 1)
            hit = np.flatnonzero(known[place] == rows[a:b])
            at.append(a + hit)
            notes.append(table.take(pa.array(place[hit])))
        if not at:
            return np.zeros(0, np.int64), None
        return np.concatenate(at), pa.concat_batches(notes)
