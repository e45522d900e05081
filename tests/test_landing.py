"""How the input of the message queries is made: whole, in parts, and without shuffles of bodies."""

from __future__ import annotations

from pyspark.sql import functions as F

from keyedflow.sinks.files import matching
from workload.queries import _land_span, _streamed, message_stream
from workload.tables import flight_messages, landed_messages, made_messages

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def event_folder(spark, path):
    """Events with null and repeated identifiers, in one file."""
    made = spark.range(600).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 500).alias("event_id"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 977).alias("ts"),
        (F.col("id") % 40).alias("user_id"),
        F.element_at(F.lit(["click", "view", "purchase", "error"]), (F.col("id") % 4 + 1).cast("int")).alias("event_type"),
        F.col("id").cast("double").alias("value"),
        F.concat(F.lit('{"k": '), F.col("id") % 100, F.lit("}")).alias("props"),
    )
    made.select(*[F.col(c.split()[0]) for c in EVENTS.split(", ")]).coalesce(1).write.parquet(f"{path}/events.parquet")
    return str(path)


def hashes(messages):
    return sorted(r[0] for r in messages.select(F.xxhash64("Body", "enqueuedTime", "sequenceNumber")).collect())


def test_no_body_is_shuffled(spark, tmp_path):
    made = made_messages(spark, event_folder(spark, tmp_path), 20)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    before_exchange = plan.split("RepartitionByExpression")
    assert len(before_exchange) == 2 and "Body" in before_exchange[0]
    assert "Body" not in before_exchange[1] and "to_json" not in before_exchange[1]


def test_landed_messages_are_all_messages(spark, tmp_path):
    sf_dir = event_folder(spark, tmp_path)
    landed = flight_messages(spark, sf_dir)
    assert landed.count() == 600 and hashes(landed) == hashes(made_messages(spark, sf_dir))


def test_a_streamed_query_leaves_no_replaced_documents(spark, tmp_path):
    sinks = _streamed(spark, event_folder(spark, tmp_path))
    generations = matching(spark, f"{sinks.documents.path}/generations/generation=*")
    assert len(generations) == 1
    # Of five batches four are folded; the last waits.
    assert len(matching(spark, f"{sinks.documents.path}/changes/run_id=*/batch_id=*/try=*")) == 1
    assert all(".zstd." in p for p in matching(spark, f"{landed_messages(spark, str(tmp_path))[0]}/part-*"))


def test_a_stream_takes_the_landed_files_in_five_parts(spark, tmp_path):
    sf_dir = event_folder(spark, tmp_path)
    folder, files = landed_messages(spark, sf_dir)
    assert len(matching(spark, f"{folder}/part-*")) == 5 * files
    sizes = []
    stream = message_stream(spark, sf_dir).writeStream.option("checkpointLocation", f"{tmp_path}/cp")
    stream.trigger(availableNow=True).foreachBatch(lambda b, n: sizes.append(b.count())).start().awaitTermination()
    assert len(sizes) == 5 and sum(sizes) == 600


def test_a_span_lands_in_a_set_number_of_files(spark, tmp_path):
    rows = spark.range(1000).select("id", F.lit("x").alias("name"))
    for part in (rows, rows.limit(2), rows.filter("id < 0")):
        _land_span(part, f"{tmp_path}/in", 4)
    assert len(matching(spark, f"{tmp_path}/in/part-*")) == 12
    assert spark.read.parquet(f"{tmp_path}/in").count() == 1002
