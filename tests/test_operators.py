from __future__ import annotations

import random
import re

import pytest
from helpers import item, plan_of
from pyspark.sql import functions as F

from keyedflow.config import KeySpec, MapGroup
from keyedflow.operators.attributes import (
    attach_map,
    explode_items,
    group_map,
    item_map,
    pivot_rows,
    with_alias_keys,
)
from keyedflow.operators.keys import with_business_key
from keyedflow.operators.latest import latest_per_key, latest_per_key_aggregated, merge_newer
from keyedflow.operators.parse import parse_json
from keyedflow.presets.flight import FALL_BACKS

FLIGHT_KEY = KeySpec("flight_number", "scheduledate", "origin", "flight_type", "flight_key", "airline", **FALL_BACKS)
ITEMS = "array<struct<name:string,value:struct<type:string,value:string>>>"


def keyed(spark, number, day, place):
    columns = "flight_number string, scheduledate string, origin string, flight_type string"
    return with_business_key(spark.createDataFrame([(number, day, place, "arrival")], columns), FLIGHT_KEY).first()


def test_business_key(spark):
    row = keyed(spark, "EY0112", "2025-12-25T00:00:00.000+0000", "BCN")
    assert (row.flight_key, row.flight_number) == ("EY-112-2025-12-25-BCN", "112")
    assert (row.flight_type, row.airline) == ("ARRIVAL", "EY")


@pytest.mark.parametrize(
    ("number", "day", "place", "key"),
    [
        ("123", "2025-12-25", "BCN", "-123-2025-12-25-BCN"),
        (None, "2025-12-25", "BCN", "no_carrier-no_fn-2025-12-25-BCN"),
        ("EY123", "2025-12-25", None, "EY-123-2025-12-25-no_orig"),
        ("EY123", "bad", "BCN", "EY-123-no_date-BCN"),
        ("EY000", "2025-12-25", "BCN", "EY--2025-12-25-BCN"),
    ],
)
def test_business_key_edges(spark, number, day, place, key):
    assert keyed(spark, number, day, place).flight_key == key


def test_parse_is_done_once_and_whole(spark):
    schema = spark.createDataFrame([], "a string, b boolean, n struct<x:string>").schema
    texts = ['{"a":1,"b":"false"}', '{"a":{"q":1},"n":{"x":false}}', '{"a":"x"} tail', '{"a"', "[]", "5", None]
    texts += ['{"a":"x"}} cut off {"', '{"a":"x"},"x":1', '{"a":"x"},"m":{"a":"y"}', '{"a":"x"},{"a":"y"}', "{'a':'x'}"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    parsed = parse_json(df, "t", schema).orderBy("i")
    rows = [r.message for r in parsed.collect()]
    assert [r and r.a for r in rows] == ["1", '{"q":1}'] + [None] * 10
    assert rows[0].b is None and rows[1].n.x == "false" and rows[2:] == [None] * 10
    quoted = ["{'a':'x'}", """{"a":"x",'b':true}""", """{"a":"x","n":{'x':"y"}}""", """{"a":"x","z":['q']}""", '{"a":"x","z":NaN}']
    quoted = spark.createDataFrame(list(enumerate(quoted)), "i int, t string")
    assert [r.message and r.message.a for r in parse_json(quoted, "t", schema).orderBy("i").collect()] == [None] * 4 + ["x"]
    filtered = parse_json(df, "t", schema).select("message.*").filter("a is not null and b is not null")
    assert plan_of(filtered).count("from_json(") == 3  # the object, and two wrappers for what the scans refuse


def random_rows(n, keys, seed):
    r = random.Random(seed)
    return [(r.choice(keys), r.randrange(5) if r.random() > 0.1 else None, i, f"v{i}") for i in range(n)]


COLUMNS = "k string, t int, s long, v string"


def rank(row):
    return (row[1] is not None, row[1] or 0, row[2])


def newest_by_hand(rows):
    best = {}
    for row in rows:
        if row[0] not in best or rank(row) > rank(best[row[0]]):
            best[row[0]] = row
    return set(best.values())


def test_latest_per_key_both_forms(spark):
    rows = random_rows(500, ["a", "b", "c", None], 1)
    df = spark.createDataFrame(rows, COLUMNS).repartition(7)
    for operator in (latest_per_key, latest_per_key_aggregated):
        assert {tuple(r) for r in operator(df, ["k"], ["t", "s"]).collect()} == newest_by_hand(rows)


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_of(latest_per_key(df, ["k"], ["id"]))
    tree = plan[: plan.index("\n\n")]
    assert tree.count("WindowGroupLimit") == 2 and tree.count("Exchange") == 1


def test_merge_newer(spark):
    keys = [f"k{i}" for i in range(40)] + [None]
    base = newest_by_hand(random_rows(120, keys[:30], 2))
    changes = random_rows(200, keys[20:], 3)
    merged = merge_newer(
        spark.createDataFrame(list(base), COLUMNS), spark.createDataFrame(changes, COLUMNS), ["k"], ["t", "s"]
    )
    got = [tuple(r) for r in merged.collect()]
    best = {}
    for row in [*changes, *base]:
        if row[0] not in best or rank(row) >= rank(best[row[0]]):
            best[row[0]] = row
    assert sorted(got, key=repr) == sorted(best.values(), key=repr)


def test_merge_newer_shuffles_no_wide_base_for_few_changes(spark, tmp_path):
    spark.range(100_000).selectExpr("id k", "id t", "repeat('x', 100) v").write.parquet(str(tmp_path / "b"))
    spark.range(10).selectExpr("id k", "id + 1 t", "'new' v").write.parquet(str(tmp_path / "c"))
    base, changes = (spark.read.parquet(str(tmp_path / p)) for p in ("b", "c"))
    merged = merge_newer(base, changes, ["k"], ["t"])
    plan = plan_of(merged)
    scans = re.findall(r"Location: InMemoryFileIndex \[file:\S+/(\w)\].*?ReadSchema: (\S+)", plan, re.S)
    assert sorted(s for folder, s in scans if folder == "b") == ["struct<k:bigint,t:bigint,v:string>", "struct<k:bigint>"]
    merged.collect()
    ran = merged._jdf.queryExecution().executedPlan().toString()
    ran = ran[: ran.index("Initial Plan")]
    assert "SortMergeJoin" not in ran  # so base is shuffled nowhere
    assert merged.count() == 100_000 and merged.filter("v = 'new'").count() == 10


NAMES = {"A": "a", "B": "b", "C": "c"}


def items_of(spark, lists):
    return spark.createDataFrame(list(enumerate(lists)), f"i int, items {ITEMS}")


LISTS = [
    [item("A", "1"), item("B", "2025-12-25"), item("X", "3"), item("A", " 4 "), item(None, "5")],
    [item("C", None), item("B", "null")],
    [item("X", "1")],
    [],
    None,
    [{"name": "A", "value": None}, item("C", "7")],
]
MAPS = [
    {"a": "4", "b": "2025-12-25T00:00:00.000Z"},
    {"c": None, "b": None},
    {},
    {},
    {},
    {"a": None, "c": "7"},
]


def test_item_map(spark):
    df = items_of(spark, LISTS).withColumn("m", item_map(F.col("items"), NAMES)).orderBy("i")
    assert [r.m for r in df.collect()] == MAPS
    plan = plan_of(df)
    assert "Exchange hashpartitioning" not in plan and "EvalPython" not in plan


def test_item_map_equals_rows_form(spark):
    exploded = explode_items(items_of(spark, LISTS), "items")
    maps = pivot_rows(exploded, ["i"], "name", "value", ["position"], NAMES, "m")
    base = spark.range(len(LISTS)).select(F.col("id").cast("int").alias("i"))
    attached = attach_map(base, maps, ["i"], "m").orderBy("i").collect()
    direct = items_of(spark, LISTS).withColumn("m", item_map(F.col("items"), NAMES)).orderBy("i").collect()
    assert [r.m for r in attached] == [r.m for r in direct] == MAPS


def test_a_key_with_a_third_of_all_rows(spark):
    """It reaches the only shuffle with one row per partition, as long as the dictionary."""
    n = 60_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"),
        F.element_at(F.lit(["A", "B", "X"]), (F.col("id") % 2 + 1).cast("int")).alias("name"),
        F.col("id").cast("string").alias("value"),
        "id",
    )
    maps = pivot_rows(rows, ["k"], "name", "value", ["id"], NAMES, "m")
    plan = plan_of(maps)
    assert plan[: plan.index("\n\n")].count("Exchange") == 1 and "partial_max_by" in plan
    assert maps.count() == 1 + n - n // 3
    assert maps.filter("k = -1").first().m == {"a": str(n - 6), "b": str(n - 3)}
    newest = latest_per_key(rows, ["k"], ["id"])
    assert newest.count() == 1 + n - n // 3 and newest.filter("k = -1").first().id == n - 3


def test_explode_keeps_rows_without_items(spark):
    rows = explode_items(items_of(spark, LISTS), "items").groupBy("i").count().orderBy("i").collect()
    assert [r["count"] for r in rows] == [5, 2, 1, 1, 1, 2]


def test_attach_map_null_key_matches_nothing(spark):
    base = spark.createDataFrame([("x",), (None,)], "k string")
    maps = spark.createDataFrame([("x", {"a": "1"}), (None, {"a": "2"})], "k string, attributes map<string,string>")
    assert {r.k: r.attributes for r in attach_map(base, maps, ["k"]).collect()} == {"x": {"a": "1"}, None: {}}


def test_alias_and_group(spark):
    df = spark.createDataFrame(
        [("IN", {"a": "1"}), ("OUT", {"b": "2"}), (None, {})], "kind string, m map<string,string>"
    )
    aliased = with_alias_keys(F.col("m"), {"first": "a"})
    group = MapGroup("g", ("a", "first"), kind="IN", kind_keys=("b",))
    rows = df.select(aliased.alias("m"), group_map(aliased, group, F.col("kind")).alias("g")).collect()
    assert rows[0].m == {"a": "1", "first": "1"} and rows[1].m == {"b": "2", "first": None}
    assert [r.g for r in rows] == [
        [{"a": "1", "first": "1", "b": None}],
        [{"a": None, "first": None}],
        [{"a": None, "first": None}],
    ]
