from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

import pytest
from dateutil import parser
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keyedflow.functions.json import is_valid_json
from keyedflow.functions.text import carrier_prefix, map_name, plain_number, strip_hyphens, strip_leading_zeros
from keyedflow.functions.timestamps import lag_seconds, lenient_date, normalize_timestamp, valid_date
from keyedflow.presets.flight import FLIGHT


def apply(spark, texts, function):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r.o for r in rows.select("i", function(F.col("t")).alias("o")).orderBy("i").collect()]


NORMALIZED = {
    None: None,
    "": None,
    " null ": None,
    "NULL": None,
    "1234567890": "1234567890",
    "20251225": "20251225",
    " -1.5e3 ": "-1.5e3",
    "nan": "nan",
    "2025-12-25T00:00:00.000Z": "2025-12-25T00:00:00.000Z",
    "2025-12-25T10:00:00Z": "2025-12-25T10:00:00Z",
    "2025-12-25T00:00:00.000+0000": "2025-12-25T00:00:00.000Z",
    "2025-12-25T02:30:00.123999+0530": "2025-12-24T21:00:00.123Z",
    "2025-12-25": "2025-12-25T00:00:00.000Z",
    "2025-12": "2025-12-01T00:00:00.000Z",
    "2025-12-25 10:30": "2025-12-25T10:30:00.000Z",
    "2025-12-25T24:00": "2025-12-26T00:00:00.000Z",
    "2025-12-25T24:01": "2025-12-25T24:01",
    "2025-13-01": "2025-13-01",
    "2025-359": "2025-12-25T00:00:00.000Z",
    "2025-W52-4": "2025-12-25T00:00:00.000Z",
    "not-a-date": "not-a-date",
    "10:30": "10:30",
    "2025-1-5": "2025-1-5",
    "9999-12-31T23:59-05:00": "9999-12-31T23:59-05:00",
    "99991231T2359-0500": "99991231T2359-0500",
    "0001-01-01T00:00+05:00": "0001-01-01T00:00+05:00",
    "0001-01-01T05:00+05:00": "0001-01-01T00:00:00.000Z",
}


def test_normalized_golden(spark):
    assert apply(spark, NORMALIZED, normalize_timestamp) == list(NORMALIZED.values())


def by_the_rules(text):
    """What the ISO reader of dateutil makes of a text, as the form documents use."""
    text = None if text is None else text.strip()
    if not text or text.lower() == "null":
        return None
    if text.isdigit() or (text.endswith("Z") and "T" in text):
        return text
    try:
        moment = parser.isoparse(text)
    except ValueError:
        return text
    aware = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    try:
        utc = aware.astimezone(timezone.utc)
    except OverflowError:
        return text
    return utc.strftime("%Y-%m-%dT%H:%M:%S.") + f"{utc.microsecond // 1000:03d}Z"


DATES = [
    "2025-12-25", "20251225", "2025-12", "202512", "2025-359", "2025359", "2024-366", "2025-366", "2025-000",
    "2025-W52-4", "2025W524", "2025-W01-1", "2020-W53-7", "2025-W54-1", "2025-W10-8", "2025-W10", "2025W10",
    "2024-02-29", "2025-02-29", "2025-1-5", "1999-12-31",
]
TIMES = [
    "", "T10", "T10:30", "T1030", "T10:30:15", "T103015", "T10:30:15.5", "T10:30:15,123456789", "T103015.001",
    " 10:30:15.999999", "t10:30:15", "x10:30", "T24:00", "T24:00:00.000", "T24:00:01", "T23:59:60", "T10:60",
    "T25:00", "T1030:15", "T10:3015", "-10:30", "T",
]
ZONES = ["", "Z", "z", "+00", "+0000", "+00:00", "-05:30", "+0530", "+23:59", "-24:00", "+05:60", "+5"]


def test_normalized_like_dateutil(spark):
    texts = [d + t + z for d in DATES for t in TIMES for z in ZONES]
    got = apply(spark, texts, normalize_timestamp)
    differing = [(t, g, by_the_rules(t)) for t, g in zip(texts, got) if g != by_the_rules(t)]
    assert differing == []


def test_normalized_outside_utc_is_refused(spark):
    from keyedflow.operators.times import normalize_timestamps

    spark.conf.set("spark.sql.session.timeZone", "Asia/Dubai")
    try:
        with pytest.raises(ValueError, match="UTC"):
            normalize_timestamps(spark.createDataFrame([("x",)], "t string"), ["t"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.datetimes(datetime(1900, 1, 1), datetime(2200, 1, 1)), min_size=50, max_size=80), st.integers(-1439, 1439))
def test_any_offset_time_becomes_utc(spark, moments, minutes):
    zone = timezone(timedelta(minutes=minutes))
    texts = [m.replace(tzinfo=zone).isoformat(timespec="microseconds") for m in moments]
    assert apply(spark, texts, normalize_timestamp) == [by_the_rules(t) for t in texts]


DAYS = {
    "2025-12-25T00:00:00.000+0000": "2025-12-25",
    "2025-12-25T00:00:00.000+0530": "2025-12-24",
    "2025-12-25T10:00:00Z": "2025-12-25",
    "2025-12-25Tjunk": "2025-12-25",
    "2025-1-5": "2025-01-05",
    "2025-02-30": None,
    "20251225": None,
    "20251225T100000": "2025-12-25",
    "20251225T100000Z": None,
    "2025-12-25 junk": None,
    "invalid-date": None,
    "": None,
    None: None,
}


def test_valid_date(spark):
    assert apply(spark, DAYS, valid_date) == list(DAYS.values())


def test_lenient_date(spark):
    days = {
        "2025-12-25T00:00:00.000+0530": "2025-12-24",
        "2025-1-5": "2025-01-05",
        "2025": "2025-01-01",
        "10:30": None,
        "T10:30": None,
        "bad": None,
        None: None,
    }
    assert apply(spark, days, lenient_date) == list(days.values())


def test_json_validity_like_the_json_module(spark):
    texts = [
        '{"a": 1}', "not-json", "", " ", "null", "5", "[1, 2]", '"s"', "NaN", "-Infinity", '{"a":1,"a":2}',
        "{'a':1}", "{}", '{"a":1} tail', '{"a":1}{"b":2}', '{"a":1},{"b":2}', '{"a":1', '{"a":1,}', '{"a":01}',
        '{"a":"\x01"}', '{"a":"\\x"}', " {} \n", "tru", "true", ".5", "1.", "+1", "1e5", '["a",]', "// c\n{}",
        "1],[2", '{"a":1}],[', '{"a":1}] junk', '1,"m":2', '{"a":1}} x {"', '{"a":1},"m":{"b":2}', '1],["m"', "1}", "1]",
    ]

    def valid(text):
        try:
            json.loads(text)
        except ValueError:
            return False
        return True

    assert apply(spark, texts, is_valid_json) == [valid(t) for t in texts]
    assert apply(spark, [None], is_valid_json) == [False]


def test_names(spark):
    names = ["DIS.ESBT_gate_open", "BRD.start", "UNKNOWN.EVENT", None]
    expected = ["gate_open", "boarding_start", None, None]
    assert apply(spark, names, lambda c: map_name(c, FLIGHT.names)) == expected
    assert len(FLIGHT.names) == 54


def test_flight_number_parts(spark):
    numbers = ["EY0112", "9W123", "EY123A", "000", "", None]
    assert apply(spark, numbers, carrier_prefix) == ["EY", "", "EY", "", "", None]
    assert apply(spark, numbers, plain_number) == ["112", "123", "", "", "", None]
    assert apply(spark, ["007", "0", "70"], strip_leading_zeros) == ["7", "", "70"]
    assert apply(spark, ["A6-BN-B", None], strip_hyphens) == ["A6BNB", None]


def test_lag(spark):
    row = spark.sql("select timestamp'2025-01-01 00:00:01.9' a, timestamp'2025-01-01 00:00:00.1' b")
    assert row.select(lag_seconds(F.col("a"), F.col("b"))).first()[0] == 1
