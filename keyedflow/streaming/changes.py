"""Newest row per key of a stream, kept in state from batch to batch.

A stream of messages repeats itself: late ones, repeated ones, ones that say nothing new. Of these only the rows
that replace the newest one of their key go on, so that what comes after sees each change once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Prefix of the columns that rows carry to the state.
STATE = "_newest_"

#: Pandas types that keep 64-bit integers exact beside nulls.
EXACT = {pa.int64(): pd.Int64Dtype(), pa.int32(): pd.Int32Dtype()}


def use_rocksdb(spark: SparkSession) -> SparkSession:
    """Keep state of queries that start from now on on the executors' disks, with changes in the checkpoint."""
    spark.conf.set(PROVIDER, ROCKSDB)
    return spark


def newest_in_batches(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """At most one row per key for each Arrow batch of a partition: the newest.

    It keeps a key that holds much of a stream from sending all its rows to one task.
    """

    def newest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by = [(c, "ascending") for c in (*keys, *order)]
            ranked = pc.sort_indices(batch, sort_keys=by, null_placement="at_start")
            named = batch.select(list(keys)).take(ranked).to_pandas(types_mapper=EXACT.get)
            yield batch.take(ranked.filter(pa.array(~named.duplicated(keep="last"))))

    return df.mapInArrow(newest, df.schema)


class Newest(StatefulProcessor):
    """Holds the rank of each key's newest row, and a digest of what it says, and lets newer rows through."""

    def __init__(self, state: T.StructType, columns: Sequence[str], expires: bool):
        self.state, self.columns, self.expires = state, tuple(columns), expires

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("newest", self.state)

    @staticmethod
    def rank(state: Sequence) -> tuple:
        """What tells newer from older: all but the digest, nulls being older than all else."""
        return tuple((value is not None, value) if value is not None else (False,) for value in state[:-1])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        state, newest = max(((tuple(row[c] for c in self.state.names), row) for row in rows), key=lambda pair: self.rank(pair[0]))
        held = self.held.get()
        if held is not None and self.rank(held) >= self.rank(state):
            return
        self.held.update(state)
        if self.expires:
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            if state[0] is not None:
                self.handle.registerTimer(state[0] // 1000 + 1)
        if held is None or state[-1] is None or held[-1] != state[-1]:
            yield Row(*self.columns)(*[newest[c] for c in self.columns])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def changed_per_key(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    content: Sequence[str] = (),
    late: str | None = None,
) -> DataFrame:
    """Rows of a stream that replace the newest row of their key; columns as they come.

    Per key and micro-batch at most the newest row comes out, and only where its ``order`` is greater than that
    of every row before, whatever batch that came in; nulls in ``order`` are older than all else, and null keys
    are a key of their own. So the last row that came out per key is what ``latest_per_key`` gives of the whole
    stream, and older and repeated rows give nothing. With ``content``, a newer row whose values there are those
    of the row it replaces moves the order on but does not come out.

    State holds ``order`` and a digest of ``content`` per key. Without ``late`` it is never dropped. With it, such
    as ``7 days``, the first order column must be a timestamp, and rows more than that behind the newest of all
    are dropped as too late, as are rows without that timestamp; a key's state goes when no row that is still let
    in could be older than it, so dropping it changes no result. A restart goes on from the checkpoint. Needs
    :func:`use_rocksdb`. The stream may have any columns but such that start with ``_newest_``.
    """
    spark = stream.sparkSession
    if spark.conf.get(PROVIDER, "") != ROCKSDB:
        raise ValueError("state per key needs use_rocksdb(spark) before the stream starts")
    times = {f.name for f in stream.schema if isinstance(f.dataType, T.TimestampType)}
    state = {f"{STATE}{i}": F.unix_micros(c) if c in times else F.col(c) for i, c in enumerate(order)}
    state[f"{STATE}digest"] = F.sha2(F.to_json(F.struct(*content)), 256) if content else F.lit(None).cast("string")
    ranked = newest_in_batches(stream, keys, order).withColumns(state)
    if late is not None:
        if order[0] not in times:
            raise ValueError(f"{order[0]} is no timestamp, so rows can't be late by it")
        ranked = ranked.withWatermark(order[0], late)
    processor = Newest(T.StructType([ranked.schema[c] for c in state]), stream.columns, late is not None)
    mode = "None" if late is None else "EventTime"
    return ranked.groupBy(*keys).transformWithState(processor, stream.schema, "Update", mode)
