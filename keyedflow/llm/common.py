"""What the corpus operators share: tables, scratch tables and row keys."""

from __future__ import annotations

import re
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyedflow.session import scratch_folder
from keyedflow.sinks.files import remove

#: The row key that operators carry. Inputs may hold any column but this one.
ROW = "__row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of one Arrow batch between Spark and a Python worker; a batch of long texts has fewer rows.
ARROW_BATCH_BYTES = 2 << 20


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that workers can import it.

    Also bounds the session's Arrow batches by bytes, where it hasn't set a bound itself: by rows alone, ten
    thousand long texts would have to fit in memory several times over.
    """
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit) == "67108864b":  # the default
        spark.conf.set(limit, ARROW_BATCH_BYTES)
    context = spark.sparkContext
    if getattr(context, "_keyedflow_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="keyedflow-code-")) / "keyedflow_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._keyedflow_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors share.

    Where that is unset, a local session gets a folder of its own; a cluster has to name one.
    """
    if not spark.conf.get("spark.checkpoint.dir", None) and LOCAL.match(spark.sparkContext.master):
        base = tempfile.mkdtemp(prefix="keyedflow-llm-")
        spark.sparkContext.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    return scratch_folder(spark, name)


#: Masters whose tasks run in the driver's process.
LOCAL = re.compile(r"local(\[|$)")

#: Frees the shuffle files of a query when it ends; what it wrote is complete then, and no later job reads them.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(frame: DataFrame, name: str, compression: str = "zstd") -> tuple[DataFrame, str]:
    """Rows in a shared scratch table, and its folder, for ``freed`` when no frame that is still to run reads it.

    The shuffle files behind the table are removed as soon as it is written.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        frame.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(frame.schema).parquet(path), path


def freed(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more."""
    for path in paths:
        remove(spark, path)


def saved(frame: DataFrame, name: str) -> DataFrame:
    """Write the rows to a shared scratch table and read them back, which cuts the lineage."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def with_row_key(frame: DataFrame) -> DataFrame:
    """Number the rows, for use in a single job; ``numbered_once`` is for keys that several jobs read."""
    return frame.withColumn(ROW, F.monotonically_increasing_id())


def numbered_once(frame: DataFrame) -> DataFrame:
    """The rows with a key, written to the shared scratch folder, so that all readings see the same keys.

    Splits of a scan may differ from one job to the next, as executors come and go, and row numbers with them.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, "numbered-rows")
    keyed = with_row_key(frame)
    keyed.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(keyed.schema).parquet(path)


def drop_rows(frame: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of a numbered frame whose key is not among the distinct keys of ``dropped``; unnumbered again."""
    return frame.join(dropped.select(ROW), ROW, "left_anti").drop(ROW)


def release(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; at their end, memory that Arrow keeps for later goes back to the system."""
    yield from batches
    pa.default_memory_pool().release_unused()


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
