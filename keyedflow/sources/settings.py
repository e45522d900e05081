"""Settings kept as rows of a table, the newest active one counting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def read_settings(spark: SparkSession, path: str, format: str | None = None) -> DataFrame:
    """The settings table, in the session's default format unless told otherwise."""
    return spark.read.load(path, format=format)


def newest_row(df: DataFrame, condition: str | Column, order: Sequence[str]) -> DataFrame:
    """The one row with the greatest ``order`` among those meeting the condition."""
    newest_first = [F.col(c).desc_nulls_last() for c in order]
    return df.filter(condition).orderBy(*newest_first).limit(1)


def active_setting(
    settings: DataFrame,
    module: str,
    order: Sequence[str] = ("insertion_datetime",),
    fields: Sequence[str] = ("*",),
) -> Row:
    """The newest active settings row of a module, brought to the driver."""
    condition = (F.col("module_name") == module) & (F.col("status") == "Active")
    row = newest_row(settings, condition, order).select(*fields).first()
    if row is None:
        raise LookupError(f"no active settings row for module {module!r}")
    return row
