"""From JSON text to columns, with bad rows set aside instead of lost."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyedflow.config import Field
from keyedflow.functions.json import STRICT_JSON, in_list, in_object, is_one_value, scanned_member

INVALID_JSON = "invalid_json"
MISSING_FIELD = "missing_field"
INVALID_DATE = "invalid_date"
INVALID_ENQUEUE_TIME = "invalid_enqueue_time"


def parse_json(df: DataFrame, body: str, schema: T.StructType, out: str = "message") -> DataFrame:
    """Add struct column ``out``: the object in ``body``, or null when that is not one JSON object.

    Text after the object makes it invalid, see ``is_one_value``. Going through a generator keeps the
    parser out of later filters, where the optimizer would otherwise repeat it once per condition.
    """
    text = F.col(body)
    parsed = F.from_json(in_object(text), T.StructType([T.StructField("m", schema)]), STRICT_JSON)
    whole = F.when(is_one_value(text), parsed["m"])
    return df.select("*", F.explode(F.array(whole)).alias(out))


#: Kinds of JSON values that a field of a type takes, as ``from_json`` has it; others make it null.
VARIANT_KINDS = {"boolean": "BOOLEAN", "bigint": "BIGINT", "int": "BIGINT", "double": "BIGINT|DOUBLE|DECIMAL.*"}
REPEATED_NAMES = "spark.sql.variant.allowDuplicateKeys"


def allow_repeated_names(spark: SparkSession) -> SparkSession:
    """Let the last of several equal names in a JSON object win in variants too, as it does elsewhere here."""
    spark.conf.set(REPEATED_NAMES, "true")
    return spark


def parse_variant(df: DataFrame, body: str, schema: T.StructType, out: str = "message") -> DataFrame:
    """:func:`parse_json` by way of a variant, kept in column ``<out>_variant`` for fields outside the schema.

    One parse gives validity, all fields and the variant; a scan finds text after the object. It differs from
    ``parse_json`` in three points: ``NaN`` makes a text invalid, numbers in text fields are written as numbers
    (``-0.0`` as ``0``) and objects in text fields with their names in order, and a list or object with one
    value of the wrong type is null as a whole. Needs :func:`allow_repeated_names`.
    """
    if df.sparkSession.conf.get(REPEATED_NAMES, "false") != "true":
        raise ValueError("variants refuse repeated names: call allow_repeated_names(spark) first")
    text = F.col(body)
    listed = F.when(scanned_member(text), F.try_parse_json(in_list(text)))
    single = F.try_variant_get(listed, "$[1]", "variant").isNull() & F.schema_of_variant(listed).startswith("ARRAY<OBJECT<")
    whole = F.when(single, F.try_variant_get(listed, "$[0]", "variant"))
    kept = df.select("*", F.explode(F.array(whole)).alias(f"{out}_variant"))
    value = F.col(f"{out}_variant")
    fields = F.struct(*[_variant_field(value, f).alias(f.name) for f in schema])
    return kept.withColumn(out, F.when(value.isNotNull(), fields))


def _variant_field(value: Column, field: T.StructField) -> Column:
    path = f"$[{json.dumps(field.name, ensure_ascii=False)}]"
    kind = field.dataType.simpleString()
    found = F.try_variant_get(value, path, kind)
    if kind not in VARIANT_KINDS:
        return found
    return F.when(F.schema_of_variant(F.try_variant_get(value, path, "variant")).rlike(f"^({VARIANT_KINDS[kind]})$"), found)


def flatten(message: str, fields: Iterable[Field]) -> list[Column]:
    """Columns for the listed fields of a struct column; names may hold blanks and hyphens."""
    columns = []
    for f in fields:
        value = F.col(message).getField(f.source)
        columns.append((f.clean(value) if f.clean else value).alias(f.target))
    return columns


def all_present(columns: Iterable[str]) -> Column:
    """True when no listed column is null."""
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(name).isNotNull()
    return condition


def reject_reason(broken: Column, required: Iterable[str], day: Column, enqueued: Column) -> Column:
    """Why a row cannot become a document; null for a good row."""
    return (
        F.when(broken, INVALID_JSON)
        .when(~all_present(required), MISSING_FIELD)
        .when(day.isNull(), INVALID_DATE)
        .when(enqueued.isNull(), INVALID_ENQUEUE_TIME)
    )


def split_rejects(df: DataFrame, reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """Good rows without the reason column, and the rejected rows with it."""
    return df.filter(F.col(reason).isNull()).drop(reason), df.filter(F.col(reason).isNotNull())
