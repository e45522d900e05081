"""Exact token counts for every context limit, from a histogram of encoded lengths."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyedflow.llm.common import release, saved, ship_package
from keyedflow.llm.tokens import encoder, groups_of


def counter(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_column
        for batch in release(batches):
            texts = batch["text"]
            for start, end in groups_of(texts):
                lengths = np.diff(encode(texts[start:end])[1]) // 4
                # Equal lengths of a batch are one row before anything is shuffled.
                values, counts = np.unique(lengths, return_counts=True)
                yield pa.record_batch({"n_tokens": values, "n_docs": counts.astype(np.int64)})

    return count


def length_histogram(rows: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """``n_tokens``, ``n_docs``: how many rows have each encoded length. Null texts have length 0."""
    ship_package(rows.sparkSession)
    slim = rows.select(F.col(text_col).alias("text"))
    counted = slim.mapInArrow(counter(tokenizer_path), "n_tokens long, n_docs long")
    return counted.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def limits(histogram: DataFrame) -> DataFrame:
    """One row per occurring length with suffix sums over it and all longer ones.

    ``docs_at_least`` and ``tokens_at_least`` cover the documents of that length or more; ``tokens_truncated``
    is what is left when every document is cut to that length; ``quantile`` is the share of documents that
    are no longer. An empty histogram gives no rows.

    Lengths are put in blocks of 1/64 of their power of two. Sums run within a block and over the blocks, of
    which there are some thousands at most, so no task holds all lengths of a very long-tailed histogram.
    """
    shift = F.greatest(F.length(F.bin("n_tokens")) - 7, F.lit(0))
    blocks = histogram.withColumn("block", shift * 64 + F.expr("shiftright(n_tokens, int(greatest(length(bin(n_tokens)) - 7, 0)))"))
    blocks = saved(blocks, "length-histogram")
    tokens = F.col("n_tokens") * F.col("n_docs")
    within = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    longer = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = (
        blocks.groupBy("block")
        .agg(F.sum("n_docs").alias("docs"), F.sum(tokens).alias("tokens"))
        .select(
            "block",
            F.coalesce(F.sum("docs").over(longer), F.lit(0)).alias("docs_after"),
            F.coalesce(F.sum("tokens").over(longer), F.lit(0)).alias("tokens_after"),
            F.sum("docs").over(everything).alias("all_docs"),
            F.sum("tokens").over(everything).alias("all_tokens"),
        )
    )
    summed = blocks.select(
        "block", "n_tokens", "n_docs",
        F.sum("n_docs").over(within).alias("docs_in"),
        F.sum(tokens).over(within).alias("tokens_in"),
    ).join(totals, "block")
    docs, held = F.col("docs_in") + F.col("docs_after"), F.col("tokens_in") + F.col("tokens_after")
    return summed.select(
        "n_tokens",
        "n_docs",
        docs.alias("docs_at_least"),
        held.alias("tokens_at_least"),
        (F.col("all_tokens") - held + F.col("n_tokens") * docs).alias("tokens_truncated"),
        ((F.col("all_docs") - docs + F.col("n_docs")) / F.col("all_docs")).alias("quantile"),
    )


def token_counts(rows: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """See ``limits``; further columns of the input are ignored."""
    return limits(length_histogram(rows, tokenizer_path, text_col))


def truncated_total(answers: DataFrame, limit: int) -> DataFrame:
    """Tokens left when every document is cut to ``limit``, from the rows of ``limits``: one row, ``tokens``."""
    shorter = F.when(F.col("n_tokens") <= limit, F.col("n_tokens")).otherwise(limit)
    return answers.agg(F.coalesce(F.sum(shorter * F.col("n_docs")), F.lit(0)).alias("tokens"))
