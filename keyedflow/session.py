"""Session checks and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

UTC_NAMES = {"UTC", "Etc/UTC", "Z", "GMT", "Etc/GMT", "UCT", "+00:00"}


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session to UTC, the zone every text form in this package is written in."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(
            f"spark.sql.session.timeZone is {zone!r}; dates and time texts are defined in UTC, "
            "so set it to 'UTC'"
        )


def free_shuffles(spark: SparkSession) -> None:
    """Let the driver collect its garbage, with which go the shuffle files of queries that have ended."""
    spark.sparkContext._jvm.System.gc()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
