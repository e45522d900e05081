"""Exact duplicates by a tree-merge of sorted digest runs.

Every input partition becomes sorted runs of digests, one per digest range. In each round neighbouring
runs of a range are exchanged and merged into one, until each range has a single run. Every level keeps one
entry per digest: the identifier that stays, and how many rows it stands for. A group that holds a third of
all rows is thus one entry per partition before the first exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyedflow.llm.common import ROW, ascii_lower, drop_rows, numbered_once, saved, ship_package, text_of, with_row_key

#: SHA-256 (32 bytes), the text's length in bytes (8), and an independent 64-bit hash of it (8).
KEY_BYTES = 48
#: Entries that a final run should hold at most, on average.
RANGE_ENTRIES = 50_000
#: Runs that the partitions are dealt to, and how many of them one merge takes.
RUNS, FAN = 64, 4

ENTRY = np.dtype([("key", f"S{KEY_BYTES}"), ("id", "<i8"), ("known", "?"), ("row", "<i8"), ("n", "<i8")])
RUN_SCHEMA = "slot long, run int, entries binary"
MERGED_SCHEMA = "key binary, keep_id long, keep_row long, group_size long"


def combine(entries: np.ndarray, keep: str) -> np.ndarray:
    """Entries sorted by key, one per key: the kept identifier and row, and the summed counts.

    A known identifier goes before a null one; among equal identifiers the first row stays.
    """
    if not len(entries):
        return entries
    rank = entries["id"] if keep == "smallest" else ~entries["id"]  # ~x orders the other way without overflow
    order = np.lexsort((entries["row"], rank, ~entries["known"]))
    order = order[np.argsort(entries["key"][order], kind="stable")]  # a merge, as runs are sorted already
    entries = entries[order]
    starts = np.flatnonzero(np.concatenate(([True], entries["key"][1:] != entries["key"][:-1])))
    merged = entries[starts].copy()
    merged["n"] = np.add.reduceat(entries["n"], starts)
    return merged


def slots_of(entries: np.ndarray, ranges: int) -> np.ndarray:
    """The digest range of each entry, from the first four bytes of the key."""
    head = np.frombuffer(entries["key"].tobytes(), dtype=np.uint8).reshape(-1, KEY_BYTES)[:, :4]
    return (head.astype(np.uint64) @ np.array([1 << 24, 1 << 16, 1 << 8, 1], dtype=np.uint64)) * ranges >> 32


def packed(entries: np.ndarray, slots: np.ndarray, run: int) -> pa.RecordBatch:
    cuts = np.flatnonzero(np.concatenate(([True], slots[1:] != slots[:-1]))) if len(slots) else np.array([], int)
    parts = np.split(entries, cuts[1:]) if len(cuts) else []
    return pa.record_batch(
        {
            "slot": pa.array(slots[cuts].astype(np.int64) if len(cuts) else [], pa.int64()),
            "run": pa.array([run] * len(parts), pa.int32()),
            "entries": pa.array([part.tobytes() for part in parts], pa.binary()),
        }
    )


def run_maker(ranges: int, keep: str):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = TaskContext.get().partitionId() % RUNS
        for batch in batches:
            if not batch.num_rows:
                continue
            entries = np.zeros(batch.num_rows, ENTRY)
            entries["key"] = np.frombuffer(b"".join(batch["key"].to_pylist()), f"S{KEY_BYTES}")
            entries["known"] = batch["id"].is_valid().to_numpy(zero_copy_only=False)
            entries["id"] = batch["id"].fill_null(0).to_numpy(zero_copy_only=False)
            entries["row"] = batch[ROW].to_numpy(zero_copy_only=False)
            entries["n"] = 1
            entries = combine(entries, keep)
            yield packed(entries, slots_of(entries, ranges), run)

    return make


def merger(keep: str):
    def merge(key: tuple, runs: pa.Table) -> pa.Table:
        merged = combine(np.frombuffer(b"".join(runs["entries"].to_pylist()), ENTRY), keep)
        return pa.table(
            {
                "slot": pa.array([key[0].as_py()], pa.int64()),
                "run": pa.array([key[1].as_py()], pa.int32()),
                "entries": pa.array([merged.tobytes()], pa.binary()),
            }
        )

    return merge


def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in batch["entries"]:
            entries = np.frombuffer(run.as_py(), ENTRY)
            keys = np.frombuffer(entries["key"].tobytes(), np.uint8).reshape(-1, KEY_BYTES)
            yield pa.record_batch(
                {
                    "key": pa.array([k.tobytes() for k in keys], pa.binary()),
                    "keep_id": pa.array(entries["id"], pa.int64(), mask=~entries["known"]),
                    "keep_row": pa.array(entries["row"], pa.int64()),
                    "group_size": pa.array(entries["n"], pa.int64()),
                }
            )


def digests(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Row key, identifier and verified digest of every row; null texts count as empty."""
    text = ascii_lower(text_of(text_col))
    # unhex of a 16-digit number keeps all bits of a long; sha2 gives 64 hex digits.
    wide = lambda number: F.lpad(F.hex(number), 16, "0")
    return (
        rows.select(ROW, F.col(id_col).cast("long").alias("id"), text.alias("__text"))
        .select(
            ROW,
            "id",
            F.unhex(
                F.concat(
                    F.sha2("__text", 256),
                    wide(F.octet_length("__text").cast("long")),
                    wide(F.xxhash64("__text")),
                )
            ).alias("key"),
        )
    )


def merge_digests(keyed: DataFrame, keep: str = "smallest") -> DataFrame:
    """One row per distinct key: ``keep_id``, ``keep_row`` and ``group_size``.

    ``keyed`` has the columns of ``digests`` and is read twice (a count, then the runs), so give a table.
    Runs are binary rows; a final run holds about ``RANGE_ENTRIES`` entries whatever the size of the input.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    ship_package(keyed.sparkSession)
    ranges = max(1, -(-keyed.count() // RANGE_ENTRIES))
    runs = keyed.mapInArrow(run_maker(ranges, keep), RUN_SCHEMA)
    left = RUNS
    while left > 1:
        left = -(-left // FAN)
        runs = (
            runs.withColumn("run", F.floor(F.col("run") / FAN).cast("int"))
            .groupBy("slot", "run")
            .applyInArrow(merger(keep), RUN_SCHEMA)
        )
    return runs.mapInArrow(unpack, MERGED_SCHEMA)


def exact_duplicates(
    rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """One row per input row: ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The row with the smallest
    (or largest) identifier of a group stays; null identifiers stay only where a group has no other. Rows
    that repeat both identifier and text are one group of which only the first row is kept. An empty table
    gives no rows; further columns of the input are ignored.
    """
    keyed = saved(digests(with_row_key(rows), id_col, text_col), "digests")
    groups = saved(merge_digests(keyed, keep), "digest-groups")
    return keyed.join(groups, "key").select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col(ROW) == F.col("keep_row")).alias("kept"),
        F.lower(F.substring(F.hex("key"), 1, 64)).alias("text_sha256"),
    )


def drop_exact_duplicates(
    rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """The input without the rows that ``exact_duplicates`` does not keep, all columns as they are."""
    numbered = numbered_once(rows)
    keyed = saved(digests(numbered, id_col, text_col), "digests")
    groups = merge_digests(keyed, keep).select("key", "keep_row")
    dropped = keyed.join(groups, "key").filter(F.col(ROW) != F.col("keep_row"))
    return drop_rows(numbered, saved(dropped.select(ROW), "exact-dropped"))
