"""Stream source (S5): files arriving in a folder, replayable."""

from __future__ import annotations

import os
import shutil
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``; None without a JVM (Spark Connect)."""
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    except (AttributeError, PySparkException):
        return None, path
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def path_kind(spark: SparkSession, path: str) -> str | None:
    """``"dir"``, ``"file"`` or ``None`` (missing), through the Hadoop
    FileSystem so that any cluster store works; the local file system when
    the JVM is not reachable (Spark Connect).  A store that cannot be read
    raises: only a path that is not there counts as missing."""
    fs, p = _file_system(spark, path)
    if fs is None:
        if not os.path.exists(path):
            return None
        return "dir" if os.path.isdir(path) else "file"
    if not fs.exists(p):
        return None
    return "dir" if fs.getFileStatus(p).isDirectory() else "file"


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Entry names directly below ``path`` (empty when it is missing)."""
    fs, p = _file_system(spark, path)
    if fs is None:
        return os.listdir(path) if os.path.isdir(path) else []
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None,
                options: dict | None = None) -> DataFrame:
    """A streaming DataFrame over the files of ``path`` (schema declared, never
    inferred).  ``glob`` restricts which files count (``pathGlobFilter``);
    ``max_files_per_trigger`` splits a backlog into several micro-batches;
    ``options`` go to the reader as they are (e.g. ``recursiveFileLookup``).
    A single file is streamed from its folder with a filter on its name."""
    if glob is None and path_kind(spark, path) == "file":
        path, glob = path.rstrip("/").rsplit("/", 1)
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        reader = reader.option("header", True)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load(path)


@dataclass
class FileInput:
    """A folder of files that a stream reads, and any of them as a batch."""

    path: str
    schema: T.StructType
    fmt: str = "parquet"
    glob: str | None = None
    options: dict = field(default_factory=dict)

    def stream(self, spark: SparkSession, max_files_per_trigger: int | None = None,
               glob: str | None = None) -> DataFrame:
        return file_stream(spark, self.path, self.schema, self.fmt, glob or self.glob,
                           max_files_per_trigger, self.options)

    def rows(self, spark: SparkSession, paths: Sequence[str] | None = None) -> DataFrame:
        """The rows of ``paths``, by default of all files."""
        reader = spark.read.schema(self.schema).format(self.fmt).options(**self.options)
        if self.fmt == "csv":
            reader = reader.option("header", True)
        if paths is not None:
            return reader.load(list(paths))
        return (reader.option("pathGlobFilter", self.glob) if self.glob else reader).load(self.path)


def modified(spark: SparkSession, path: str) -> dict[str, float]:
    """When the entries directly below ``path`` were last changed, by name
    (seconds since the epoch)."""
    fs, p = _file_system(spark, path)
    if fs is None:
        names = os.listdir(path) if os.path.isdir(path) else []
        return {n: os.path.getmtime(f"{path}/{n}") for n in names}
    if not fs.exists(p):
        return {}
    return {st.getPath().getName(): st.getModificationTime() / 1000 for st in fs.listStatus(p)}


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete ``path`` and what is below it."""
    fs, p = _file_system(spark, path)
    if fs is None:
        shutil.rmtree(path, ignore_errors=True)
    else:
        fs.delete(p, True)
