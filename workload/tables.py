"""The given tables, and the messages and texts derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyedflow.presets.flight import FLIGHT
from keyedflow.session import scratch_folder, use_utc
from keyedflow.sinks.files import COMPRESSION

#: Payload fields that hold a label of their own and the event's number, so that none can stand in for another.
LABELLED_FIELDS = {
    "Baggage Offloading Finish": "bof",
    "Catering_Arrived": "cta",
    "Catering_Requested": "ctr",
    "Departure - Boarding Held for Temp": "bht",
    "Departure - Temp for Boarding": "tfb",
    "aircraftCallSign": "acs",
    "aircraftType": "act",
    "cargo_door_closed": "not read",
    "delay_code2": "dc2",
    "delay_code3": "dc3",
    "delay_duration_1": "dd1",
    "delay_duration_2": "dd2",
    "delay_duration_3": "dd3",
    "et": "eta",
    "flightStatus": "fst",
    "flightStatusAD": "fad",
    "flightStatusCode": "fsc",
    "linkedFlight": "lfl",
    "source": "src",
    "sourceLocation": "slo",
    "stand": "std",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with instants and the number in ``props`` as ``k`` (0 to 99)."""
    return table(spark, sf_dir, "events").withColumns(
        {"ts": F.col("ts").cast("timestamp"), "k": F.get_json_object("props", "$.k").cast("int")}
    )


def stamp(ts: Column, rest: str = "") -> Column:
    """``yyyy-MM-ddTHH:mm:ss.SSS`` and a literal rest."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit(rest))


def spelled_time(ts: Column, k: Column, number: Column) -> Column:
    """The instant in many spellings, good and bad; ``k`` picks one."""
    day = F.date_format(ts, "yyyy-MM-dd")
    iso_week = F.concat_ws(
        "-",
        F.extract(F.lit("YEAROFWEEK"), ts).cast("string"),
        F.concat(F.lit("W"), F.lpad(F.weekofyear(ts).cast("string"), 2, "0")),
        (F.weekday(ts) + 1).cast("string"),
    )
    return (
        F.when(k < 5, F.lit(None).cast("string"))
        .when(k < 10, "")
        .when(k < 15, " null ")
        .when(k < 20, number.cast("string"))
        .when(k < 25, "not-a-date")
        .when(k < 40, stamp(ts, "+0000"))
        .when(k < 50, day)
        .when(k < 60, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(k < 68, F.date_format(ts, "yyyyMMdd'T'HHmmss"))
        .when(k < 76, F.date_format(ts, "' 'yyyy-MM-dd HH:mm'+0530 '"))
        .when(k < 84, F.concat_ws("-", F.date_format(ts, "yyyy"), F.lpad(F.dayofyear(ts).cast("string"), 3, "0")))
        .when(k < 92, iso_week)
        .otherwise(F.concat(F.replace(stamp(ts), F.lit("."), F.lit(",")), F.lit("-03:00")))
    )


def _item(name: Column, kind: str, value: Column) -> Column:
    return F.struct(
        name.cast("string").alias("name"),
        F.struct(F.lit(kind).alias("type"), value.cast("string").alias("value")).alias("value"),
    )


def _lit(text: str) -> Column:
    return F.lit(text)


def hours_later(ts: Column, hours: int) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + hours * 3_600_000_000)


MESSAGE_SCHEMA = "Body binary, enqueuedTime timestamp, sequenceNumber long"

#: Messages arrive in so many parts, each of several files, and a file holds about so many messages.
ARRIVING_PARTS, FILE_MESSAGES = 5, 50_000

_landed: dict[tuple[str, str, str], tuple[str, int]] = {}


def landed_messages(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """Folder of the messages of :func:`made_messages`, written once per application, and files in a part of it.

    Events are dealt to tasks before messages are made of them, so bodies are neither shuffled nor sorted. They are
    dealt by all columns, since identifiers may be null or repeat; the number of tasks grows with the table.
    """
    base = spark.conf.get("spark.checkpoint.dir", "")
    place = (spark.sparkContext.applicationId, base, sf_dir)
    if place not in _landed:
        folder = scratch_folder(spark, "messages")
        rows = table(spark, sf_dir, "events").count()
        files = max(4, -(-rows // (ARRIVING_PARTS * FILE_MESSAGES)))
        made_messages(spark, sf_dir, ARRIVING_PARTS * files).write.option("compression", COMPRESSION).parquet(folder)
        _landed[place] = folder, files
    return _landed[place]


def flight_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of :func:`made_messages` as they land."""
    return use_utc(spark).read.schema(MESSAGE_SCHEMA).parquet(landed_messages(spark, sf_dir)[0])


def made_messages(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """One flight message per event, as ``Body`` (binary), ``enqueuedTime`` and ``sequenceNumber``.

    Events are dealt to ``tasks`` first, if given.

    ``error`` events give broken JSON of several kinds; ``k`` decides on missing fields, bad dates, lists and
    spelling. Every field and every event name of the dictionary occurs. Enqueue times are whole hours, so
    many messages of a flight share one and the sequence number decides.
    """
    e = events(spark, sf_dir)
    if tasks is not None:
        e = e.repartition(tasks, *e.columns)
    ts, k, kind = F.col("ts"), F.col("k"), F.col("event_type")
    user = F.col("user_id").cast("string")
    midnight = F.date_trunc("day", ts)
    carrier = F.when(kind == "click", "EY").when(kind == "view", "qr").when(kind == "purchase", "").otherwise("AB")
    schedule = (
        F.when(k.between(5, 9), "n/a")
        .when(k < 40, stamp(midnight, "+0000"))
        .when(k < 60, F.date_format(midnight, "yyyy-MM-dd"))
        .when(k < 80, stamp(midnight, "+0530"))
        .otherwise(stamp(midnight, "Z"))
    )
    names = F.lit(list(FLIGHT.names))
    items = F.array(
        _item(
            F.element_at(names, (F.col("event_id") % len(FLIGHT.names) + 1).cast("int")),
            "S",
            F.concat(F.lit("v"), F.col("event_id")),
        ),
        _item(_lit("DIS.ESBT_gate_open"), "D", stamp(ts, "+0000")),
        _item(
            F.when(kind == "click", "DBD.dbd_start")
            .when(kind == "view", "BRD.start")
            .when(kind == "purchase", "CLN.start")
            .otherwise("DIS.cargo_door_closed"),
            "D",
            stamp(hours_later(ts, 1), "+0530"),
        ),
        _item(_lit("BRD.held"), "B", _lit("false")),
        _item(_lit("BRD.start"), "D", stamp(hours_later(ts, 2), "Z")),
        _item(F.when(k < 50, "CTR.stop").otherwise("FUE.stop"), "N", k),
        _item(F.lit(None), "N", k),
        _item(_lit("stand"), "S", F.concat(F.lit(" "), kind, F.lit(" "))),
    )
    # Lists, texts and bodies come out of generators, which keeps each step within the compiler's limit.
    listed = F.when(k < 90, items).when(k < 95, F.slice(items, 1, 0))
    e = e.select("*", F.explode(F.array(listed)).alias("listed"))
    payload = F.struct(
        F.when(k >= 5, F.concat(F.lit('{"h":"'), F.col("user_id"), F.lit('"}'))).alias("acdmId"),
        F.concat(carrier, F.when(k % 2 == 0, F.lpad(user, 8, "0")).otherwise(user)).alias("flightNumber"),
        schedule.alias("scheduleDate"),
        F.when(~k.between(10, 14), F.when(kind == "click", "BCN").otherwise("AUH")).alias("origin"),
        F.upper(kind).alias("destination"),
        F.concat(F.lit("A6-"), F.col("user_id"), F.lit("-X")).alias("aircraftReg"),
        F.when(kind == "click", "arrival").when(kind == "view", "Departure").otherwise("other").alias("flightType"),
        F.lit("ETD").alias("airline"),
        (k > 90).alias("cancelled"),
        (k < 20).alias("partial"),
        (k % 3 == 0).alias("diverted"),
        F.lit("no").alias("deleted"),  # of the wrong type
        stamp(ts, "+0000").alias("st"),
        F.when(k < 50, k.cast("string")).otherwise(" null ").alias("at"),
        F.col("event_id").cast("string").alias("gate"),
        k.alias("delay_code1"),
        F.concat(F.lit("PT"), k, F.lit("M")).alias("total_delay_duration"),
        kind.alias("Departure - Temp on Arrival"),
        stamp(ts).alias("Baggage Offloading Start"),
        F.col("listed").alias("flightDataUpdateItem"),
        *[F.concat(F.lit(f"{label}-"), F.col("event_id")).alias(name) for name, label in LABELLED_FIELDS.items()],
    )
    e = e.select("event_id", "ts", "k", "event_type", F.explode(F.array(F.to_json(payload))).alias("whole"))
    whole = F.col("whole")
    broken = (
        F.when(k % 5 == 0, F.substring(whole, F.lit(1), F.length(whole) - 1))
        .when(k % 5 == 1, F.concat(whole, F.lit('} cut off {"')))
        .when(k % 5 == 2, F.concat(whole, F.lit(',"x":1')))
        .when(k % 5 == 3, F.concat(whole, F.lit(',"m":'), whole))
        .otherwise(F.concat(whole, F.lit(" tail")))
    )
    body = F.when(kind == "error", broken).otherwise(whole)
    return e.select(
        body.cast("binary").alias("Body"),
        F.date_trunc("hour", ts).alias("enqueuedTime"),
        F.col("event_id").alias("sequenceNumber"),
    )
