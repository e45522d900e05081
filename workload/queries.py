"""One query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyedflow.config import KeySpec, MapGroup
from keyedflow.functions.json import is_valid_json
from keyedflow.functions.text import map_name, strip_hyphens, strip_leading_zeros
from keyedflow.functions.timestamps import iso_text, lag_seconds
from keyedflow.operators import documents as docs
from keyedflow.operators.attributes import (
    attach_map,
    explode_items,
    group_map,
    item_map,
    pivot_rows,
    with_alias_keys,
)
from keyedflow.operators.keys import with_business_key
from keyedflow.operators.latest import latest_per_key, latest_per_key_aggregated, latest_per_key_late
from keyedflow.operators.parse import all_present, allow_repeated_names, parse_json, parse_variant
from keyedflow.operators.times import normalize_timestamps, with_valid_date
from keyedflow.operators.versions import MERGE, names_as_of
from keyedflow.plans.job import job_from_setting, start_job
from keyedflow.plans.pipeline import batch_handler, changed_documents, file_sinks, process_batch
from keyedflow.presets.flight import FALL_BACKS, FLIGHT
from keyedflow.session import free_shuffles, scratch_folder
from keyedflow.sinks import snapshot
from keyedflow.sinks.append import AppendTable, BatchId, append_batch, read_appended
from keyedflow.sinks.files import matching
from keyedflow.sinks.snapshot import Snapshot
from keyedflow.sources.messages import MessageSource, decode, read_stream
from keyedflow.sources.settings import active_setting, newest_row, read_settings
from keyedflow.streaming.attach import attach_stream
from keyedflow.streaming.changes import changed_per_key, use_rocksdb
from keyedflow.streaming.runner import start_stream
from workload.tables import MESSAGE_SCHEMA, events, flight_messages, landed_messages, spelled_time, table

MESSAGES = MessageSource("table")
LINE_NAMES = {f"L.{n}": f"line_{n}" for n in range(1, 8)}
FLAG_NAMES = {"RF.A": "flag", "RF.N": "flag", "RF.R": "flag", "LS.F": "line_status", "LS.O": "line_status"}
EVENT_NAMES = {"click": "clicked", "view": "viewed", "purchase": "bought"}


def batch_of_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(flight_messages(spark, sf_dir), MESSAGES)


def parsed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.parse_messages(batch_of_messages(spark, sf_dir), FLIGHT)


# --- sources and parsing ------------------------------------------------------------------------


def decode_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = MessageSource("table", body="body", enqueued="ts", sequence="event_id")
    raw = events(spark, sf_dir).withColumns(
        {
            "body": F.col("props").cast("binary"),
            "arrived": F.timestamp_micros(F.unix_micros("ts") + F.col("k") * 900_000),
        }
    )
    envelope = decode(raw, source, received="arrived")
    return envelope.select(
        "json_body",
        iso_text(F.col("ingestiontime")).alias("ingestiontime"),
        iso_text(F.col("enqueuedTime")).alias("enqueued"),
        "time_difference_seconds",
        "sequenceNumber",
    )


def parse_json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType.fromDDL("k bigint, absent string")
    raw = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    return parse_json(raw, "props", schema).select("event_id", "event_type", "message.k", "message.absent")


def json_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, k = F.col("event_type"), F.col("k")
    tails = [" tail", "],[", '],["a"', ',"x":1', '} cut off {"', ',"m":{}', "] [", " "]
    tail = F.element_at(F.lit(tails), (k % len(tails) + 1).cast("int"))
    body = (
        F.when(kind == "error", F.substring("props", F.lit(1), F.length("props") - 1))
        .when(kind == "signup", F.concat("props", tail))
        .when(kind == "purchase", F.concat(F.lit("1"), tail))
        .when(kind == "view", F.lit(None))
        .otherwise(F.col("props"))
    )
    return events(spark, sf_dir).select("event_id", is_valid_json(body).alias("valid"))


def message_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    lag = lag_seconds(F.col("l_shipdate").cast("timestamp"), F.col("o_orderdate").cast("timestamp"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", lag.alias("lag_seconds"))


# --- scalar operators ---------------------------------------------------------------------------


def business_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    rows = joined.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("c_name")).alias("number"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T00:00:00.000+0000'").alias("day"),
        F.when(F.col("o_orderstatus") != "F", F.col("n_name")).alias("place"),
        F.lower("o_orderstatus").alias("kind"),
    )
    keyed = with_business_key(rows, KeySpec(kind="kind", **FALL_BACKS))
    return keyed.select("o_orderkey", "key", "number", "carrier", "kind")


def normalize_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = spelled_time(F.col("ts"), F.col("k"), F.col("event_id"))
    spelled = events(spark, sf_dir).select("event_id", text.alias("normalized"))
    return normalize_timestamps(spelled, ["normalized"])


def validate_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = spelled_time(F.col("ts"), F.col("k"), F.col("event_id"))
    spelled = events(spark, sf_dir).select("event_id", text.alias("text"))
    return with_valid_date(spelled, "text", "day").filter("day is not null").drop("text")


def map_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "events").select(
        "event_id", map_name(F.col("event_type"), EVENT_NAMES).alias("friendly_name")
    )
    return named.filter("friendly_name is not null")


def name_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary of event types with many versions of each, made from parts; some retire a name, some tie."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    kinds = F.lit(["click", "view", "purchase", "signup", "unseen"])
    minutes = F.col("p_partkey") * 37 % 43_200
    return parts.select(
        F.element_at(kinds, (F.col("p_size") % 5 + 1).cast("int")).alias("name"),
        F.timestamp_seconds(F.lit(1_704_067_200) + minutes * 60).alias("valid_from"),
        F.when(F.col("p_size") % 10 > 0, F.concat_ws("/", "p_brand", "p_partkey")).alias("target"),
        "p_partkey",
    )


def _as_of(spark: SparkSession, sf_dir: str, way: str | None) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", "event_type", "ts")
    named = names_as_of(rows, name_versions(spark, sf_dir), "event_type", "ts", "friendly_name", ["p_partkey"], way)
    return named.drop("ts")


def versioned_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name that a dictionary table gave each event's type at its time."""
    return _as_of(spark, sf_dir, None)


def versioned_names_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as for a dictionary too large to broadcast."""
    return _as_of(spark, sf_dir, MERGE)


def strip_and_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        strip_hyphens(F.col("o_orderpriority")).alias("priority"),
        F.upper("o_orderstatus").alias("status"),
        strip_leading_zeros(F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("number"),
    )


def _with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    return e.select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("acdm_id"),
        F.nullif("user_id", F.lit(0).cast("bigint")).alias("flight_number"),
        F.when(F.col("k") >= 10, iso_text(F.col("ts"))).alias("scheduledate"),
        F.when(F.col("k") < 90, F.col("event_type")).alias("origin"),
    )


def null_rules_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_gaps(spark, sf_dir).filter(all_present(FLIGHT.required))


def null_rules_keylog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_gaps(spark, sf_dir).filter(all_present(["flight_number", "scheduledate", "origin"]))


# --- newest per key -----------------------------------------------------------------------------

EVENT_COLUMNS = ("user_id", "event_type", "event_id", "value", "props")


def latest_per_key_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(*EVENT_COLUMNS, "ts")
    newest = latest_per_key(rows, ["user_id", "event_type"], ["ts", "event_id"])
    return newest.select(*EVENT_COLUMNS)


def latest_per_key_maxby(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(*EVENT_COLUMNS, "ts")
    newest = latest_per_key_aggregated(rows, ["user_id", "event_type"], ["ts", "event_id"])
    return newest.select(*EVENT_COLUMNS)


def latest_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"
    )
    newest = latest_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"])
    return newest.drop("l_shipdate")


# --- attribute lists ----------------------------------------------------------------------------


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a list of attributes: a repeated name, an unknown one and a null one.

    Returned lines have an empty list, and lines of zero discount none at all.
    """

    def item(name, value):
        typed = F.struct(F.lit("S").alias("type"), value.cast("string").alias("value"))
        return F.struct(name.alias("name"), typed.alias("value"))

    flag = F.concat(F.lit("RF."), F.col("l_returnflag"))
    items = F.array(
        item(flag, F.col("l_suppkey")),
        item(F.concat(F.lit("LS."), F.col("l_linestatus")), F.date_format("l_shipdate", "yyyy-MM-dd")),
        item(F.lit("unknown"), F.col("l_partkey")),
        item(F.lit(None).cast("string"), F.col("l_partkey")),
        item(flag, F.concat(F.lit(" "), F.col("l_partkey"), F.lit(" "))),
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
        "l_partkey",
        "l_linestatus",
        F.when(F.col("l_returnflag") == "R", F.slice(items, 1, 0))
        .when(F.col("l_discount") > 0, items)
        .alias("items"),
    )


LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "ship_day")


def _line_key() -> list:
    day = F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_day")
    return ["l_orderkey", "l_linenumber", "l_partkey", day]


def explode_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explode_items(line_items(spark, sf_dir), "items")
    return rows.select(*_line_key(), F.col("position").cast("int").alias("position"), "name", "value")


def pivot_attributes_arrayform(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = line_items(spark, sf_dir).withColumn("attributes", item_map(F.col("items"), FLAG_NAMES))
    return mapped.select(
        *_line_key(),
        F.size("attributes").alias("n_attributes"),
        F.col("attributes")["flag"].alias("flag"),
        F.col("attributes")["line_status"].alias("line_status"),
    )


def _line_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.concat(F.lit("L."), F.col("l_linenumber")).alias("name"),
        F.col("l_partkey").cast("string").alias("value"),
        "l_shipdate",
        "l_partkey",
    )
    return pivot_rows(lines, ["l_orderkey"], "name", "value", ["l_shipdate", "l_partkey"], LINE_NAMES)


def pivot_attributes_rowform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_maps(spark, sf_dir).select("l_orderkey", F.explode("attributes").alias("name", "value"))


def _orders_with_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    return attach_map(orders, _line_maps(spark, sf_dir), ["l_orderkey"])


def attach_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_with_maps(spark, sf_dir).select(
        "l_orderkey",
        F.size("attributes").alias("n_attributes"),
        F.col("attributes")["line_1"].alias("line_1"),
    )


def alias_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = {"first": "line_1", "second": "line_2"}
    mapped = _orders_with_maps(spark, sf_dir).withColumn(
        "attributes", with_alias_keys(F.col("attributes"), aliases)
    )
    return mapped.select(
        "l_orderkey",
        F.size("attributes").alias("n_attributes"),
        *[F.col("attributes")[k].alias(k) for k in ("first", "line_1", "second", "line_2")],
    )


def typed_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = (
        MapGroup("low", ("line_1", "line_2"), kind="F", kind_keys=("line_7",)),
        MapGroup("high", ("line_5", "line_6"), kind="O", kind_keys=("line_7",)),
    )
    mapped = _orders_with_maps(spark, sf_dir)
    grouped = mapped.withColumns(
        {g.target: group_map(F.col("attributes"), g, F.col("o_orderstatus")) for g in groups}
    )
    low, high = F.col("low")[0], F.col("high")[0]
    return grouped.select(
        "l_orderkey",
        F.size(low).alias("n_low"),
        F.size(high).alias("n_high"),
        low["line_1"].alias("low_1"),
        low["line_2"].alias("low_2"),
        low["line_7"].alias("low_7"),
        high["line_5"].alias("high_5"),
        high["line_6"].alias("high_6"),
        high["line_7"].alias("high_7"),
    )


# --- messages to documents ----------------------------------------------------------------------

STAMPS = ("ingestion_datetime", "cosmos_date", "cosmos_process_datetime")


def document_scalars(df: DataFrame) -> DataFrame:
    """Documents without wall-clock stamps, with map sizes and the lifted values in place of maps."""
    kept = [c for c in FLIGHT.document_columns if c not in (*STAMPS, "arrival", "departure")]
    return df.select(
        *kept,
        F.size(F.col("arrival")[0]).alias("n_arrival"),
        F.size(F.col("departure")[0]).alias("n_departure"),
    )


def document_entries(df: DataFrame) -> DataFrame:
    """One row per document, map and key."""
    sides = [
        F.struct(F.lit(side).alias("side"), F.col(side)[0].alias("entries")) for side in ("arrival", "departure")
    ]
    rows = df.select("id", F.inline(F.array(*sides)))
    return rows.select("id", "side", F.explode("entries").alias("name", "value"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_scalars(docs.documents(parsed_messages(spark, sf_dir), FLIGHT))


def document_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_entries(docs.documents(parsed_messages(spark, sf_dir), FLIGHT))


def documents_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents by way of variants."""
    allow_repeated_names(spark)
    parsed = docs.parse_messages(batch_of_messages(spark, sf_dir), FLIGHT, parse_variant)
    return document_scalars(docs.documents(parsed, FLIGHT))


def rejects_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    allow_repeated_names(spark)
    return _rejects(docs.parse_messages(batch_of_messages(spark, sf_dir), FLIGHT, parse_variant))


def documents_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents with bodies fetched for the newest messages only."""
    return document_scalars(docs.documents_late(batch_of_messages(spark, sf_dir), FLIGHT))


def latest_per_key_late_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_per_key_late(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"])
    return newest.select(*EVENT_COLUMNS)


def key_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = docs.key_log(parsed_messages(spark, sf_dir), FLIGHT)
    return log.select("flight_key", iso_text(F.col("enqueuedTime")).alias("enqueued"))


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rejects(parsed_messages(spark, sf_dir))


def _rejects(parsed: DataFrame) -> DataFrame:
    rejected = docs.rejects(parsed, FLIGHT)
    enqueued = iso_text(F.col("enqueued_datetime")).alias("enqueued")
    return rejected.select("reject_reason", "sequence_number", enqueued)


def top1_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_settings(spark, f"{sf_dir}/orders.parquet")
    newest = newest_row(orders, "o_orderstatus = 'F'", ["o_orderdate", "o_orderkey"])
    return newest.select("o_orderkey", "o_custkey", "o_orderstatus")


# --- sinks --------------------------------------------------------------------------------------


def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts that the writes of one whole batch report about themselves."""
    batch = batch_of_messages(spark, sf_dir)
    sinks = file_sinks(spark, scratch_folder(spark, "metrics"), FLIGHT)
    counts = process_batch(batch, BatchId("query", 0), FLIGHT, sinks)
    return spark.createDataFrame(list(counts.items()), "sink string, n_rows bigint")


def append_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches partitioned by day, the second with a further column, the first written twice."""
    rows = events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    old = rows.filter("ts < '2024-01-15'").select("event_id", "user_id", "event_type", "day")
    new = rows.filter("ts >= '2024-01-15'").select("event_id", "user_id", "event_type", "props", "day")
    log = AppendTable(scratch_folder(spark, "append"), partition_by=("day",), rebalance=True)
    append_batch(old, log, BatchId("query", 0))
    append_batch(new, log, BatchId("query", 1))
    append_batch(old, log, BatchId("query", 0))
    return read_appended(spark, log).select(
        "event_id", "user_id", "event_type", "props", F.col("day").cast("string").alias("day")
    )


def _event_snapshot(spark: SparkSession, sf_dir: str) -> tuple[Snapshot, DataFrame]:
    rows = events(spark, sf_dir).select("user_id", "event_type", "event_id", "ts", "value")
    target = Snapshot(
        scratch_folder(spark, "snapshot"),
        rows.schema,
        ("user_id", "event_type"),
        ("ts", "event_id"),
        partition_by=("event_type",),
    )
    snapshot.create(spark, target)
    return target, rows


def _upsert_late(rows: DataFrame, target: Snapshot) -> None:
    """Newer events first, then the older ones, which must replace nothing, then the first again."""
    newer, older = rows.filter("ts >= '2024-01-10'"), rows.filter("ts < '2024-01-10'")
    snapshot.upsert(newer, target, BatchId("query", 0))
    snapshot.upsert(older, target, BatchId("query", 1))
    snapshot.upsert(newer, target, BatchId("query", 0))


def upsert_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, rows = _event_snapshot(spark, sf_dir)
    _upsert_late(rows, target)
    return snapshot.read(spark, target).drop("ts")


def compacted_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the newest batch folded into the base before the older ones arrive."""
    target, rows = _event_snapshot(spark, sf_dir)
    snapshot.upsert(rows.filter("ts >= '2024-01-10'"), target, BatchId("query", 5))
    snapshot.compact(spark, target)
    _upsert_late(rows, target)
    snapshot.compact(spark, target)
    return snapshot.read(spark, target).drop("ts")


# --- streams ------------------------------------------------------------------------------------


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events file as a stream of messages whose body is ``props``."""
    schema = table(spark, sf_dir, "events").schema
    # The table may be one file or a folder of part files; a stream wants a pattern for the one.
    path = f"{sf_dir}/[e]vents.parquet"
    source = MessageSource("parquet", {}, path, schema, "props", "ts", "event_id", 1)
    return read_stream(spark, source)


def message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All flight messages, written as many files and streamed one part of them at a time."""
    landing, files = landed_messages(spark, sf_dir)
    schema = T.StructType.fromDDL(MESSAGE_SCHEMA)
    return read_stream(spark, MessageSource("parquet", {}, landing, schema, max_per_trigger=files))


def stream_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = event_stream(spark, sf_dir)
    raw = AppendTable(scratch_folder(spark, "raw"))

    def land(batch: DataFrame, number: int) -> None:
        append_batch(batch, raw, BatchId("stream", number))

    checkpoint = scratch_folder(spark, "checkpoint")
    start_stream(stream, land, checkpoint, available_now=True).awaitTermination()
    landed = read_appended(spark, raw)
    return landed.select("json_body", iso_text(F.col("enqueuedTime")).alias("enqueued"), "sequenceNumber")


def _streamed(spark: SparkSession, sf_dir: str):
    sinks = file_sinks(spark, scratch_folder(spark, "stream"), FLIGHT)
    checkpoint = scratch_folder(spark, "checkpoint")

    def free(number: int, counts: dict[str, int]) -> None:
        """What a batch shuffled, and what a compaction has replaced, as nobody reads meanwhile."""
        snapshot.free(spark, sinks.documents, keep=1)
        free_shuffles(spark)

    handler = batch_handler(FLIGHT, sinks, on_done=free, compact_every=2)
    start_stream(message_stream(spark, sf_dir), handler, checkpoint, available_now=True).awaitTermination()
    return sinks


def stream_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline over several micro-batches; the snapshot equals one big batch."""
    sinks = _streamed(spark, sf_dir)
    return document_scalars(snapshot.read(spark, sinks.documents))


def stream_key_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_appended(spark, _streamed(spark, sf_dir).key_log)
    return log.select("flight_key", iso_text(F.col("enqueuedTime")).alias("enqueued"))


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events streamed file by file into a snapshot, later files holding older events, with the
    first two batches folded into the base on the way."""
    landing = scratch_folder(spark, "landing")
    target, rows = _event_snapshot(spark, sf_dir)
    rows.repartitionByRange(4, F.col("ts").desc()).write.parquet(landing)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(landing)

    def upsert(batch: DataFrame, number: int) -> None:
        snapshot.upsert(batch, target, BatchId("stream", number))
        if number == 1:
            snapshot.compact(spark, target)

    checkpoint = scratch_folder(spark, "checkpoint")
    start_stream(stream, upsert, checkpoint, available_now=True).awaitTermination()
    return snapshot.read(spark, target).drop("ts")


#: What arrives batch by batch: newer events first, then older ones, the first again, the newest, the rest.
ARRIVALS = (
    "ts >= '2024-01-15' AND ts < '2024-01-20'",
    "ts < '2024-01-10'",
    "ts >= '2024-01-15' AND ts < '2024-01-20'",
    "ts >= '2024-01-20'",
    "ts >= '2024-01-10' AND ts < '2024-01-15'",
)


def stream_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that replace the newest of their key, by the batch they come out of; restarted after two batches."""
    use_rocksdb(spark)
    rows = events(spark, sf_dir).select("user_id", "event_type", "event_id", "ts", "value")
    landing, landed = scratch_folder(spark, "landing"), scratch_folder(spark, "changes")
    checkpoint = scratch_folder(spark, "checkpoint")
    log = AppendTable(landed)

    def land(batch: DataFrame, number: int) -> None:
        append_batch(batch, log, BatchId("stream", number))

    for arrivals in (ARRIVALS[:2], ARRIVALS[2:]):
        for condition in arrivals:
            rows.filter(condition).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(landing)
        changed = changed_per_key(stream, ["user_id", "event_type"], ["ts", "event_id"])
        start_stream(changed, land, checkpoint, available_now=True, output="update").awaitTermination()
    return read_appended(spark, log, rows.schema).select("batch_id", "user_id", "event_type", "event_id", "value")


def stream_changed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages as a stream of changed documents into a snapshot, which equals one big batch."""
    use_rocksdb(spark)
    target = Snapshot(scratch_folder(spark, "documents"), docs.document_schema(FLIGHT), partition_by=(FLIGHT.day,))
    snapshot.create(spark, target)
    changed = changed_documents(message_stream(spark, sf_dir), FLIGHT)

    def upsert(batch: DataFrame, number: int) -> None:
        snapshot.upsert(batch, target, BatchId("stream", number), deduplicated=True)

    checkpoint = scratch_folder(spark, "checkpoint")
    start_stream(changed, upsert, checkpoint, available_now=True, output="update").awaitTermination()
    return document_scalars(snapshot.read(spark, target))


#: Ranges of time in the order in which they arrive, of six that cover the orders' dates.
SPANS = (1, 0, 3, 2, 5, 4)


def _dated(rows: DataFrame, at: str) -> DataFrame:
    """Rows with the number of the 430 days that they fall in; later ones belong to the last."""
    days = F.datediff(at, F.lit("1992-01-01"))
    return rows.withColumn("span", F.least(F.floor(days / 430), F.lit(5)).cast("int"))


def _attach_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders with what is shipped within 60 days, a hot order's lines dealt to two lanes."""
    return attach_stream(
        orders, lines, ["l_orderkey"], "ordered", "shipped", LINE_NAMES, "900 days", after="60 days", order=["l_partkey"], lanes=2
    ).select("l_orderkey", F.size("attributes").alias("n_attributes"), F.col("attributes")["line_1"].alias("line_1"))


#: Rows that a landing file of a range of time holds, if ranges were equal.
FILE_ROWS = 500_000


def _land_span(part: DataFrame, folder: str, files: int) -> None:
    """Write one range of time as so many files, so that a batch of that many files is the range and no more.

    Rows are dealt by all columns; tasks without rows write no file, so empty files make up the number.
    """
    spark, before = part.sparkSession, len(matching(part.sparkSession, f"{folder}/part-*"))
    part = part.repartition(files, *part.columns) if files > 1 else part.coalesce(1)
    part.write.mode("append").parquet(folder)
    for _ in range(before + files - len(matching(spark, f"{folder}/part-*"))):
        spark.createDataFrame([], part.schema).coalesce(1).write.mode("append").parquet(folder)


def stream_attach_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and lines as two streams whose ranges of time arrive out of order, restarted on the way.

    A last message in each stream, far ahead and of an order of its own, lets all time before it pass.
    """
    landing, checkpoint = scratch_folder(spark, "landing"), scratch_folder(spark, "checkpoint")
    log = AppendTable(scratch_folder(spark, "attached"))
    order_key, ordered = F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("timestamp").alias("ordered")
    orders = _dated(table(spark, sf_dir, "orders").select(order_key, ordered), "ordered")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.concat(F.lit("L."), F.col("l_linenumber")).alias("name"),
        F.col("l_partkey").cast("string").alias("value"),
        F.col("l_shipdate").cast("timestamp").alias("shipped"),
        "l_partkey",
    )
    lines = _dated(lines, "shipped")
    sides = {"orders": orders, "lines": lines}
    ahead = F.to_timestamp(F.lit("2020-01-01"))
    last = {"l_orderkey": F.lit(-1), "name": F.lit("L.1"), "ordered": ahead, "shipped": ahead}
    stream = {side: rows.drop("span").schema for side, rows in sides.items()}
    files = {side: -(-rows.count() // (len(SPANS) * FILE_ROWS)) or 1 for side, rows in sides.items()}

    def land(batch: DataFrame, number: int) -> None:
        append_batch(batch, log, BatchId("stream", number))

    for spans in (SPANS[:3], (*SPANS[3:], None)):
        for span in spans:
            for side, rows in sides.items():
                if span is None:
                    part = spark.range(1).select(*[last.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in stream[side]])
                else:
                    part = rows.filter(F.col("span") == span).drop("span")
                _land_span(part, f"{landing}/{side}", files[side])
        read = {s: spark.readStream.schema(t).option("maxFilesPerTrigger", files[s]).parquet(f"{landing}/{s}") for s, t in stream.items()}
        attached = _attach_lines(read["orders"], read["lines"])
        start_stream(attached, land, checkpoint, available_now=True).awaitTermination()
    return read_appended(spark, log).select("l_orderkey", "n_attributes", "line_1")


def active_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole stream through the job that the newest active settings row describes.

    Settings are made from orders. Besides the documents there is the row that was chosen, and whether the
    stamps of arrival and processing lie within the run.
    """
    base = scratch_folder(spark, "job")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("module_name"),
        F.when(F.col("o_orderkey") % 3 > 0, "Active").otherwise("Off").alias("status"),
        F.col("o_orderdate").alias("insertion_datetime"),
        "o_orderkey",
        *[F.concat_ws("-", F.lit(f"{base}/{d}"), "o_orderkey").alias(f"{d}_dir") for d in ("raw", "product", "checkpoint")],
    )
    setting = active_setting(orders, "F", ("insertion_datetime", "o_orderkey"))
    began = spark.range(1).select(F.current_timestamp()).first()[0]
    job = job_from_setting(spark, setting, FLIGHT)
    start_job(message_stream(spark, sf_dir), job, FLIGHT, available_now=True).awaitTermination()
    ended = spark.range(1).select(F.current_timestamp()).first()[0]

    landed = read_appended(spark, job.sinks.raw).select("sequenceNumber", "ingestiontime", "ingest_date")
    log = snapshot.read(spark, job.sinks.documents)
    inside = lambda stamp: stamp.between(F.lit(began), F.lit(ended))
    processed = F.to_timestamp("cosmos_process_datetime")
    # Texts of stamps have milliseconds only.
    processed_inside = processed.between(F.lit(began) - F.expr("INTERVAL 1 SECOND"), F.lit(ended))
    days = F.col("ingest_date").between(F.lit(began).cast("date"), F.lit(ended).cast("date"))
    return log.join(landed, F.col("sequence_number") == F.col("sequenceNumber")).select(
        "id",
        F.lit(setting["o_orderkey"]).alias("o_orderkey"),
        inside(F.col("ingestiontime")).alias("arrived_in_run"),
        processed_inside.alias("processed_in_run"),
        (days & (F.col("cosmos_date") == F.substring("cosmos_process_datetime", 1, 10))).alias("dated_in_run"),
    )


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch taken through the pipeline twice: every raw row is there once."""
    batch = batch_of_messages(spark, sf_dir)
    sinks = file_sinks(spark, scratch_folder(spark, "replay"), FLIGHT)
    for _ in range(2):
        process_batch(batch, BatchId("query", 0), FLIGHT, sinks)
    landed = read_appended(spark, sinks.raw)
    return landed.select("sequenceNumber", iso_text(F.col("enqueuedTime")).alias("enqueued"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        decode_envelope,
        parse_json_fields,
        json_validity,
        message_lag,
        business_key,
        normalize_timestamp,
        validate_date,
        map_names,
        versioned_names,
        versioned_names_merged,
        strip_and_upper,
        null_rules_main,
        null_rules_keylog,
        latest_per_key_window,
        latest_per_key_maxby,
        latest_with_ties,
        latest_per_key_late_fetch,
        explode_attributes,
        pivot_attributes_arrayform,
        pivot_attributes_rowform,
        attach_attributes,
        alias_keys,
        typed_groups,
        documents,
        document_maps,
        documents_variant,
        documents_late,
        key_log,
        rejects,
        rejects_variant,
        top1_config,
        batch_metrics,
        append_partitioned,
        upsert_snapshot,
        compacted_snapshot,
        stream_raw,
        stream_documents,
        stream_key_log,
        stream_latest,
        stream_changes,
        stream_changed_documents,
        stream_attach_attributes,
        active_config,
        stream_replay,
    )
}
