"""Folders of finished writes, seen from the driver through the file system of the path."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrameWriter, SparkSession

#: Spark writes this file last, so a folder that has it is whole.
DONE = "_SUCCESS"
#: Of messages it needs half the bytes of Spark's default, at about the same time.
COMPRESSION = "zstd"
MARK_DONE = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


#: What Spark escapes in the names of partition folders, besides control characters.
ESCAPED = "\"#%'*/:=?\\\x7f{[]^"


def escaped(value: str) -> str:
    """A value as Spark spells it in the name of a partition folder."""
    return "".join(f"%{ord(c):02X}" if c in ESCAPED or c < " " else c for c in value)


def _path(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, in order; none where nothing is there."""
    fs, path = _path(spark, pattern)
    return sorted(str(s.getPath().toString()) for s in fs.globStatus(path) or [])


def marked(writer: DataFrameWriter) -> DataFrameWriter:
    """A writer that marks its folder when it is whole, whatever the session says."""
    return writer.option(MARK_DONE, "true")


def finished(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a glob pattern and were written to their end."""
    return [p.removesuffix(f"/{DONE}") for p in matching(spark, f"{pattern}/{DONE}")]


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, where there is none yet."""
    fs, file = _path(spark, path)
    fs.createNewFile(file)


def remove(spark: SparkSession, path: str) -> None:
    fs, folder = _path(spark, path)
    fs.delete(folder, True)


def rename(spark: SparkSession, path: str, target: str) -> None:
    fs, source = _path(spark, path)
    if not fs.rename(source, _path(spark, target)[1]):
        raise OSError(f"could not move {path} to {target}")


def named_value(path: str, name: str) -> str:
    """The value of a ``name=value`` folder in a path."""
    return unquote(re.search(f"(?:^|/){name}=([^/]*)", path)[1])
