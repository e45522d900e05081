"""Naming an intermediate value inside one column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body mentions it."""
    return F.transform(F.array(value), body)[0]


def let_sql(value: Column, function: str) -> Column:
    """:func:`let` with the body as a SQL lambda, for arithmetic that reads better in SQL."""
    return F.call_function("transform", F.array(value), F.expr(function))[0]
