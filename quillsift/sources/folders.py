"""Folders of data through Hadoop's file systems: what is there, how large; export, deletion and resetting of parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def opened(spark: SparkSession, path: str):
    """The file system of a path, and the path there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = opened(spark, path)
    return bool(fs.exists(p))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly in a folder; none if there is no such folder."""
    fs, p = opened(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> int:
    """Deletes a file or a folder with all in it; how many files that were."""
    fs, p = opened(spark, path)
    if not fs.exists(p):
        return 0
    files = int(fs.getContentSummary(p).getFileCount())
    fs.delete(p, True)
    return files


def reset(spark: SparkSession, root: str, parts: tuple[str, ...], only: set[str] | None = None, but: set[str] = frozenset()) -> dict[str, int]:
    """Empties the parts of a data folder: all, or only some, but for others. How many files each had."""
    unknown = ((only or set()) | set(but)) - set(parts)
    if unknown:
        raise ValueError(f"no such parts: {', '.join(sorted(unknown))}")
    found = {}
    for part in parts:
        if (not only or part in only) and part not in but:
            found[part] = delete(spark, f"{root}/{part}")
            fs, p = opened(spark, f"{root}/{part}")
            fs.mkdirs(p)
    return found


def sizes(spark: SparkSession, root: str) -> dict[str, int]:
    """Bytes in each part of a folder."""
    out = {}
    for name in names(spark, root):
        fs, p = opened(spark, f"{root}/{name}")
        out[name] = int(fs.getContentSummary(p).getLength())
    return out


def export(spark: SparkSession, source: str, target: str) -> None:
    """Copies a file or folder; the copy is put in place when it is whole."""
    fs, p = opened(spark, source)
    to, q = opened(spark, target)
    part = opened(spark, f"{target}.part")[1]
    to.delete(part, True)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, to, part, False, True, spark._jsc.hadoopConfiguration())
    to.delete(q, True)
    if not to.rename(part, q):
        raise OSError(f"cannot put {target} in place")


def read_artefacts(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON artefacts, a file each: entity and question (the folders a file is in), name, its text as artefact, empty for a file that is no JSON object; with a schema also its values."""
    rows = spark.read.text(path, wholetext=True).withColumn("__path", F.input_file_name())
    place = lambda k: F.regexp_extract("__path", r"([^/]+)/([^/]+)/([^/]+)$", k)
    parsed = F.try_parse_json("value")
    good = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    out = rows.select(place(1).alias("entity"), place(2).alias("question"), place(3).alias("name"), F.when(good, F.col("value")).otherwise("{}").alias("artefact"))
    return out if schema is None else out.withColumn("values", F.from_json("artefact", schema))


def write_conclusions(rows: DataFrame, path: str, question: str = "question") -> None:
    """A record for each question, in JSON lines."""
    rows.repartitionByRange(1, question).sortWithinPartitions(question).write.mode("overwrite").json(path)


def read_conclusions(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The records of questions; none if there are none or they cannot be read."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def write_parsed(rows: DataFrame, path: str, warning: str = "_parse_warning") -> bool:
    """Parsed rows under all, those with a warning under warnings if there are any; whether there were."""
    from .files import write_csv

    write_csv(rows, f"{path}/all")
    delete(rows.sparkSession, f"{path}/warnings")
    if warning not in rows.columns:
        return False
    warned = rows.filter(F.trim(F.coalesce(F.col(warning), F.lit(""))) != "")
    if warned.isEmpty():
        return False
    write_csv(warned, f"{path}/warnings")
    return True
