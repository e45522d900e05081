"""Token ids in Parquet list columns that can be read in parts.

Files hold rows in ascending identifier order, in row groups of a set size, with dictionary or delta encoded
ids and page indexes, so a reader takes single columns, identifier ranges or row groups.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyedflow.llm.common import ROW, release, scratch_path, ship_package, with_row_key
from keyedflow.llm.tokens import encoder, groups_of

END = 0
#: Words whose ids a worker keeps. No other work shares the worker's memory, so there may be many.
CACHE_WORDS = 700_000
ROW_GROUP_BYTES, PAGE_ROWS = 16 << 20, 2_000
FILE_SCHEMA = "doc_id long, part int, before long, n_tokens long, tokens array<int>"


def tokenizer_task(path: str, end: int | None):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, CACHE_WORDS).encode_column
        close = b"" if end is None else int(end).to_bytes(4, "little")
        part, before = TaskContext.get().partitionId(), 0
        for batch in release(batches):
            texts = batch["text"]
            for start, stop in groups_of(texts):
                ids, offsets = encode(texts[start:stop], close)
                offsets = offsets // 4
                ends, sizes = offsets[1:], np.diff(offsets)
                values = pa.array(np.frombuffer(ids, "<i4"), pa.int32())
                offsets = pa.array(offsets.astype(np.int32))
                yield pa.record_batch(
                    {
                        "doc_id": batch["doc_id"].slice(start, stop - start),
                        "part": pa.array(np.full(stop - start, part, np.int32)),
                        "before": pa.array(before + ends - sizes),
                        "n_tokens": pa.array(sizes),
                        "tokens": pa.ListArray.from_arrays(offsets, values),
                    }
                )
                before += int(ends[-1])

    return make


def write_tokens(
    rows: DataFrame,
    path: str,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end: int | None = END,
    encoding: str = "dictionary",
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Encode every text and write the files.

    Null texts are empty; rows with a null identifier come first; equal identifiers stay next to each other, though
    very many of one, or without one, are dealt over several files.
    Each row also holds its file's number and how many ids of that file come before it.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError("encoding is 'dictionary' or 'delta'")
    ship_package(rows.sparkSession)
    slim = rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = with_row_key(slim).repartitionByRange("doc_id", ROW).sortWithinPartitions("doc_id").drop(ROW)
    (
        ordered.mapInArrow(tokenizer_task(tokenizer_path, end), FILE_SCHEMA)
        .write.option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
        .option("parquet.writer.version", "PARQUET_2_0" if encoding == "delta" else "PARQUET_1_0")
        .option("parquet.block.size", str(row_group_bytes))
        .option("parquet.page.row.count.limit", str(page_rows))
        .option("compression", "zstd")
        .parquet(path)
    )


def read_tokens(
    spark: SparkSession, path: str, first: int | None = None, last: int | None = None, columns: list[str] | None = None
) -> DataFrame:
    """Rows of the files, all or those with identifiers from ``first`` to ``last``, with chosen columns.

    Ranges are pushed down to row groups and pages; columns that are not chosen are not read.
    """
    rows = spark.read.schema(FILE_SCHEMA).parquet(path)
    if first is not None:
        rows = rows.filter(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.filter(F.col("doc_id") <= last)
    return rows.select(*columns) if columns else rows


def file_starts(spark: SparkSession, path: str) -> DataFrame:
    """``part``, ``file_start``: how many ids all earlier files hold. Reads two columns; one row per file."""
    sums = read_tokens(spark, path, columns=["part", "n_tokens"]).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("file_start"))


def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch["tokens"]
        values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        offsets = lists.offsets.to_numpy()
        sums = [zlib.crc32(values[s:e]) for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
        sizes = np.diff(offsets).astype(np.int64)
        yield pa.record_batch(
            {
                "doc_id": batch["doc_id"],
                "part": batch["part"],
                "before": batch["before"],
                "n_tokens": pa.array(sizes),
                "ids_crc32": pa.array(sums, pa.int64()),
            }
        )


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` of every row, from the files alone."""
    read = read_tokens(spark, path, columns=["doc_id", "part", "before", "tokens"])
    found = read.mapInArrow(checksums, "doc_id long, part int, before long, n_tokens long, ids_crc32 long")
    return found.join(file_starts(spark, path), "part").select(
        "doc_id", (F.col("before") + F.col("file_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_round_trip(rows: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Write the rows' tokens to a scratch folder and return ``token_index`` of it."""
    path = scratch_path(rows.sparkSession, "token-files")
    write_tokens(rows, path, tokenizer_path, **options)
    return token_index(rows.sparkSession, path)
