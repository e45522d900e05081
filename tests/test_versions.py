from __future__ import annotations

import random

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from keyedflow.operators import versions
from keyedflow.operators.versions import BROADCAST, MERGE, names_as_of

DICTIONARY = "name string, valid_from timestamp, target string, recorded int"
ROWS = "id long, original string, at timestamp, name string, _name string, target string"


def tables(spark, seed, rows=3000):
    r = random.Random(seed)
    names = ["hot", "a", "b", "c", "unlisted"]
    listed = [(r.choice(names[:4]), r.choice([None, *range(0, 400, 10)]), r.choice([None, f"t{i}"]), r.randrange(3)) for i in range(120)]
    listed += [(None, 5, "nameless", 1), ("hot", 100, "tie", 9), ("hot", 100, "tied", 9)]
    seen = [(r.randrange(50), "hot" if i % 3 else r.choice([None, *names]), r.choice([None, *range(-20, 420)])) for i in range(rows)]
    seen += seen[:100]
    instant = F.timestamp_seconds("t")
    dictionary = spark.createDataFrame(listed, "name string, t long, target string, recorded int")
    events = spark.createDataFrame(seen, "id long, original string, t long")
    return (
        events.select("id", "original", instant.alias("at"), *[F.lit("x").alias(c) for c in ("name", "_name", "target")]),
        dictionary.select("name", instant.alias("valid_from"), "target", "recorded"),
    )


def by_hand(events, dictionary):
    held = {}
    for v in dictionary:
        if v["name"] is not None and v["valid_from"] is not None:
            rank = (v["valid_from"], v["recorded"], v["target"] is not None, v["target"] or "")
            held.setdefault(v["name"], []).append((rank, v["target"]))
    found = []
    for e in events:
        valid = [x for x in held.get(e["original"], []) if e["at"] is not None and x[0][0] <= e["at"]]
        found.append((*e, max(valid)[1] if valid else None))
    return sorted(found, key=repr)


@pytest.mark.parametrize("way", [BROADCAST, MERGE])
def test_names_as_of(spark, way):
    events, dictionary = tables(spark, 3)
    got = names_as_of(events, dictionary, "original", "at", "friendly", ["recorded"], way)
    assert got.columns == [*events.columns, "friendly"]
    assert sorted(map(tuple, got.collect()), key=repr) == by_hand(events.collect(), dictionary.collect())
    for none in (names_as_of(events.limit(0), dictionary, "original", "at", "friendly", way=way),):
        assert none.count() == 0
    unmapped = names_as_of(events, dictionary.limit(0), "original", "at", "friendly", way=way)
    assert unmapped.count() == events.count() and unmapped.filter("friendly is not null").count() == 0


def test_a_hot_name_is_spread(spark, monkeypatch):
    events, dictionary = tables(spark, 4)
    monkeypatch.setattr(versions, "HOT_SHARE", 1 / 50)
    sizes = []
    window = versions.Window.partitionBy

    def counted(*keys):
        sizes.append(keys)
        return window(*keys)

    monkeypatch.setattr(versions.Window, "partitionBy", counted)
    got = names_as_of(events, dictionary, "original", "at", "friendly", ["recorded"], MERGE)
    assert sizes[-1] == ("_name", "_group")
    assert sorted(map(tuple, got.collect()), key=repr) == by_hand(events.collect(), dictionary.collect())


def test_the_way_follows_the_size_of_the_dictionary(spark):
    events, dictionary = tables(spark, 5, rows=50)
    joined = lambda: plan_of(names_as_of(events, dictionary, "original", "at", "friendly"))
    assert "_version" in joined() and "Window" in joined() and "BroadcastHashJoin" in joined()
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "1kb")
    try:
        assert "_group" in joined()
    finally:
        spark.conf.set(setting, before)
