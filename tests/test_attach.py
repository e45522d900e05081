from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from keyedflow.streaming.attach import attach_stream
from keyedflow.streaming.runner import start_stream

NAMES = {"A": "a", "A2": "a", "B": "b"}
FLIGHT, ITEM = "k string, at long, gate string", "k string, at long, name string, value string, n long"


def timed(frame):
    return frame.withColumn("at", F.timestamp_seconds("at"))


def attached(flights, items, lanes=1):
    return attach_stream(
        flights, items, ["k"], "at", "at", NAMES, "100 seconds", "5 seconds", "20 seconds", order=["n"], lanes=lanes
    )


def by_hand(flights, items):
    out = []
    for k, at, gate in set(flights):
        held = {}
        for key, when, name, value, n in items:
            if None not in (k, at) and key == k and name in NAMES and when is not None and at - 5 <= when <= at + 20:
                held[NAMES[name]] = max(held.get(NAMES[name], ((-1, -1), None)), ((when, n), value))
        out.append((k, at, gate, sorted((name, value) for name, (_, value) in held.items())))
    return sorted(out, key=repr)


def collected(frame):
    return sorted(
        ((r["k"], r["s"], r["gate"], sorted(r["attributes"].items())) for r in frame.withColumn("s", F.unix_seconds("at")).collect()), key=repr
    )


def made(seed, spans):
    """Flights and items by ranges of 50 seconds: a hot key, null keys, unknown names, repeated rows."""
    r, flights, items = random.Random(seed), [], []
    for span in spans:
        keys = ["hot", "hot", None, *"abcd"]
        second = lambda: 1000 + span * 50 + r.randrange(50)
        flights.append([(r.choice(keys), second(), f"g{r.randrange(3)}") for _ in range(12)])
        # Values follow from time and number, so that repeated rows are equal rows.
        rows = [(r.choice(keys), second(), r.choice(["A", "A2", "B", "X", None]), r.randrange(10**6)) for _ in range(60)]
        items.append([(k, s, name, f"v{n}", n) for k, s, name, n in rows] + [("a", 1000 + span * 50, "A", "v1", 1)] * 2)
        flights[-1].append(flights[-1][0])
    return flights, items


@pytest.mark.parametrize("lanes", [1, 3])
def test_tables(spark, lanes):
    flights, items = ([x for part in parts for x in part] for parts in made(1, range(3)))
    flights += [("a", None, "no time"), ("z", 1000, "no items")]
    items += [("a", None, "A", "no time", 0)]
    got = attached(timed(spark.createDataFrame(flights, FLIGHT)), timed(spark.createDataFrame(items, ITEM)), lanes)
    assert got.columns == ["k", "at", "gate", "attributes"]
    assert collected(got) == by_hand(flights, items)


def test_empty_tables(spark):
    none, no_items = timed(spark.createDataFrame([], FLIGHT)), timed(spark.createDataFrame([], ITEM))
    assert attached(none, no_items).collect() == []
    assert collected(attached(timed(spark.createDataFrame([("a", 1, "g")], FLIGHT)), no_items)) == [("a", 1, "g", [])]


@pytest.mark.parametrize("lanes", [1, 2])
def test_streams_out_of_order_equal_tables(spark, tmp_path, lanes):
    flights, items = made(2, [1, 0, 2, 4, 3])
    out = []

    def land(batch, number):
        out.extend((number, *row) for row in collected(batch))

    def run():
        read = lambda name, schema: timed_stream(spark, f"{tmp_path}/{name}", schema)
        joined = attached(read("flights", FLIGHT), read("items", ITEM), lanes)
        start_stream(joined, land, f"{tmp_path}/cp", available_now=True).awaitTermination()

    def timed_stream(spark, path, schema):
        kind = spark.createDataFrame([], schema).schema
        return timed(spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(path))

    def add(some_flights, some_items):
        spark.createDataFrame(some_flights, FLIGHT).coalesce(1).write.mode("append").parquet(f"{tmp_path}/flights")
        spark.createDataFrame(some_items, ITEM).coalesce(1).write.mode("append").parquet(f"{tmp_path}/items")

    for part in range(3):
        add(flights[part], items[part])
    run()
    early = len(out)
    for part in range(3, 5):
        add(flights[part], items[part])
    add([("last", 5000, "last")], [("last", 5000, "A", "last", 0)])
    # Far behind both streams by now: neither comes out.
    add([("late", 900, "late")], [("late", 900, "A", "late", 0)])
    run()
    assert early < len(out)
    assert sorted((row[1:] for row in out), key=repr) == by_hand(sum(flights, []), sum(items, []))


def streamed(spark, path, flights, items, before, after, order):
    """What comes out of streams of these rows, with a last row far ahead in each, and the query that did it."""
    out = []
    reads = []
    for name, rows, schema in (("flights", flights, FLIGHT), ("items", items, f"{ITEM}, rest string")):
        last = ("last", 9000, "last") if name == "flights" else ("last", 9000, "A", "last", 0, None)
        for number, part in enumerate((rows[::2], rows[1::2], [last])):
            spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{path}/{name}/{number}")
        kind = spark.createDataFrame([], schema).schema
        reads.append(timed(spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{path}/{name}/*")))
    joined = attach_stream(*reads, ["k"], "at", "at", NAMES, "4000 seconds", before, after, order=order, lanes=2, buckets=3)
    query = start_stream(joined, lambda b, n: out.extend(collected(b)), f"{path}/cp", available_now=True)
    query.awaitTermination()
    return sorted(out, key=repr), query


@pytest.mark.parametrize(("before", "after"), [(20, 0), (-3, 7)])
def test_ends_of_ranges_beside_ends_of_stretches(spark, tmp_path, before, after):
    """Stretches are 250 seconds long; rows lie on both sides of their ends."""
    times = [base + d for base in (250, 500, 750, 1250) for d in (-21, -20, -8, -7, -1, 0, 1, 3, 7, 8, 20)]
    flights = [(k, t, f"g{t % 2}") for t in times for k in ("a", "b", None)]
    # At equal times nulls come first, then the greater text.
    items = [("a", t, name, f"{name}{t}{n}{rest}", n, rest) for t in times for name in "AB" for n, rest in ((1, None), (None, "x"), (1, "é"), (1, "z"))]
    got, _ = streamed(spark, str(tmp_path), flights, items, f"{before} seconds", f"{after} seconds", ["n", "rest"])
    expected = []
    for k, at, gate in set(flights):
        held = {}
        for key, when, name, value, n, rest in items:
            if k == key and at - before <= when <= at + after:
                rank = (when, n is not None, n or 0, rest is not None, (rest or "").encode())
                held[NAMES[name]] = max(held.get(NAMES[name], ((), None)), (rank, value))
        expected.append((k, at, gate, sorted((name, value) for name, (_, value) in held.items())))
    assert got == sorted(expected, key=repr)


def test_state_is_one_list_of_packets_and_a_few_bytes_a_row(spark, tmp_path):
    flights = [(f"k{i}", i % 50, "g") for i in range(2_000)]
    items = [(f"k{i % 2_000}", i % 60, "A" if i % 3 else "B", f"v{i}", i, None) for i in range(60_000)]
    got, query = streamed(spark, str(tmp_path), flights, items, "5 seconds", "20 seconds", ["n"])
    assert len(got) == 2_000
    states = [p.stateOperators for p in query.recentProgress]
    assert {len(s) for s in states} == {1}
    assert 0 < max(s[0].memoryUsedBytes for s in states) < 60_000 * 100
