"""Read and write tables in any format Spark knows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from scrublens.operators.columns import column

DEFAULT_FORMAT = "parquet"

#: Formats whose tables are files in a folder. Others commit writes by themselves.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "text", "avro")
_PUBLISHED = ("errorifexists", "error", "ignore", "overwrite")
_STAGING, _REPLACED = ".staging-", ".replaced-"


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = DEFAULT_FORMAT,
    schema: StructType | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """The table, or the rows for which ``where`` holds. A condition on the columns the table
    is partitioned by decides which folders are listed and read at all."""
    reader = spark.read.format(fmt)
    table = (reader.schema(schema) if schema else reader).load(path)
    return table if where is None else table.filter(where)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = DEFAULT_FORMAT,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
) -> bool:
    """Write ``df``; by default an existing path is an error. Returns whether anything was
    written, which is always so unless ``ignore`` met an existing path.

    A table of files appears whole or not at all: it is written beside ``path`` and renamed
    when it is complete, and a write that fails leaves ``path`` as it was. What a driver
    that was killed left behind is named ``<path>.staging-...`` (see :func:`clear_staging`).
    ``append`` adds files by Spark's own commit. ``overwrite_partitions`` replaces the
    partitions that ``df`` has rows of and leaves the others alone.
    """
    writer = df.write.format(fmt).partitionBy(*partition_by)
    if mode == "overwrite_partitions":
        if not partition_by:
            raise ValueError("no columns to tell which partitions to overwrite")
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)
    elif fmt in FILE_FORMATS and mode in _PUBLISHED:
        return _publish(df.sparkSession, writer, path, mode)
    elif mode == "ignore":
        raise ValueError(f"{fmt!r} does not say whether it wrote; 'ignore' is for files")
    elif mode not in ("append", *_PUBLISHED):
        raise ValueError(f"unknown mode {mode!r}")
    else:
        writer.mode(mode).save(path)
    return True


def _publish(spark: SparkSession, writer, path: str, mode: str) -> bool:
    files = _Files(spark, path)
    if files.exists(path) and mode != "overwrite":
        if mode == "ignore":
            return False
        raise FileExistsError(f"{path} exists already")
    path = path.rstrip("/")
    staged, replaced = (f"{path}{kind}{uuid.uuid4().hex}" for kind in (_STAGING, _REPLACED))
    try:
        writer.mode("errorifexists").save(staged)
        if files.exists(path):
            if mode != "overwrite":
                raise FileExistsError(f"{path} appeared while it was written")
            files.rename(path, replaced)
        try:
            files.rename(staged, path)
        except Exception:
            if files.exists(replaced):
                files.rename(replaced, path)
            raise
    except Exception:
        files.delete(staged)
        raise
    files.delete(replaced)
    return True


def clear_staging(spark: SparkSession, path: str) -> int:
    """Delete what unfinished writes to ``path`` left beside it, and say how many there were.
    None may be under way."""
    files = _Files(spark, path)
    left = files.beside(path.rstrip("/"), _STAGING)
    for found in left:
        files.delete(found)
    return len(left)


class _Files:
    """The file system of a path, whichever it is."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark._jvm
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def rename(self, old: str, new: str) -> None:
        if not self._fs.rename(self._path(old), self._path(new)):
            raise OSError(f"cannot rename {old} to {new}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def beside(self, path: str, ending: str) -> list[str]:
        found = self._fs.globStatus(self._path(f"{path}{ending}*"))
        return [status.getPath().toString() for status in found or ()]


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a table written along the way."""
    _Files(spark, path).delete(path)


def scratch_path(spark: SparkSession) -> str:
    """A fresh path for a table written along the way: below ``spark.checkpoint.dir``, else
    below the warehouse, which all executors share too. On a cluster that must not be a folder
    of one machine. Whoever has read the table removes it (:func:`drop_table`).
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        shared = spark.conf.get("spark.sql.warehouse.dir")
        local = spark.sparkContext.master.startswith("local")
        if not local and shared.startswith(("file:", "/")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"


def same_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` with its columns in this order: a reader puts those of partitions last."""
    return df.select(*map(column, names))
