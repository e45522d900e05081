"""Newest row per key, within one table and across two."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key; null keys form groups of their own.

    Spark limits each partition to its newest row per key before the shuffle, so a key that holds a
    large share of the table sends one row per partition and no more. List enough order columns to
    leave no ties.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rank", F.row_number().over(newest_first)).filter("_rank = 1").drop("_rank")


def latest_per_key_aggregated(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The same result as an aggregate with partial aggregation; suits narrow rows."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "_newest.*").select(*df.columns)


#: Columns of a row's address: its file by two hashes of the path, and its place in there.
ADDRESS = ("_file", "_file_too", "_row")


def with_address(df: DataFrame) -> DataFrame:
    """Rows read from Parquet files with their address, which stays the same however the scan is split."""
    path = F.col("_metadata.file_path")
    address = (F.xxhash64(path), F.xxhash64(path, F.lit(1)), F.col("_metadata.row_index"))
    return df.select("*", *[c.alias(name) for name, c in zip(ADDRESS, address, strict=True)])


def rows_at(df: DataFrame, addresses: DataFrame) -> DataFrame:
    """The rows of a Parquet scan at the given addresses.

    Spark broadcasts the addresses below its threshold, and then no row is shuffled. Above it, rows whose address
    is not asked for are left out before the shuffle by a Bloom filter of the addresses, where runtime filters
    (``spark.sql.optimizer.runtime.bloomFilter``) judge that worth while.
    """
    return with_address(df).join(addresses.select(*ADDRESS), list(ADDRESS), "left_semi").drop(*ADDRESS)


def latest_per_key_late(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """:func:`latest_per_key` of rows read from Parquet files, shuffling keys, order and addresses only.

    The rest of each winner is fetched by its address. Ties that ``order`` leaves are broken by address.
    """
    slim = with_address(df).select(*dict.fromkeys((*keys, *order)), *ADDRESS)
    return rows_at(df, latest_per_key(slim, keys, [*order, *ADDRESS]))


def merge_newer(
    base: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Upsert ``changes`` into ``base`` where they are newer; ``base`` has one row per key.

    Every row of ``base`` is joined with the newest change of its key, if there is one, and gives way to a
    newer one; changes of new keys are found with the key columns of ``base`` alone, of which only
    those among the changes go on. Spark broadcasts changes below
    ``spark.sql.autoBroadcastJoinThreshold``, and then ``base`` is not shuffled. Keys come straight
    from either side, so that filters on them reach both scans. Nulls in ``order`` are older than all else. On a tie ``base`` holds.
    """
    newest = latest_per_key(changes, keys, order)
    changed = newest.select(F.struct(*base.columns).alias("change"), *[F.col(k).alias(f"_key_{k}") for k in keys])
    held = base.select(F.struct(*base.columns).alias("held"), *keys)
    same_key, newer, equal = F.lit(True), F.lit(False), F.lit(True)
    for k in keys:
        same_key = same_key & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    for c in order:
        mine, other = F.col(f"held.{c}"), F.col(f"change.{c}")
        greater = F.coalesce(other > mine, other.isNotNull() & mine.isNull())
        newer, equal = newer | (equal & greater), equal & mine.eqNullSafe(other)
    joined = held.join(changed, same_key, "left")
    chosen = F.when(F.col("change").isNotNull() & newer, F.col("change")).otherwise(F.col("held"))
    known = base.select(*keys).join(changed, same_key, "left_semi")
    fresh = changed.join(known, same_key, "left_anti")
    return joined.select(
        *[F.col(c) if c in keys else chosen[c].alias(c) for c in base.columns]
    ).unionByName(fresh.select(*[F.col(f"_key_{c}").alias(c) if c in keys else f"change.{c}" for c in base.columns]))
