"""Names looked up in a dictionary that is a table and changes over time.

The dictionary holds ``name``, ``valid_from`` and ``target``: from that instant on the name means the target,
until the name's next version. A null target retires the name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyedflow.operators.latest import latest_per_key

#: A name with more than this share of all rows is spread; there can't be more than 1,000 of those.
HOT_SHARE = 1 / 1000

#: Versions of one name up to which a row may be compared with all of them.
MOST_VERSIONS = 100

BROADCAST, MERGE = "broadcast", "merge"


def names_as_of(
    rows: DataFrame,
    versions: DataFrame,
    name: str,
    time: str,
    out: str,
    tie: Sequence[str] = (),
    way: str | None = None,
) -> DataFrame:
    """Add ``out``: the target that the row's name had at the row's time.

    It is null for names and times before any version, for retired names, and for a null name or time. Of
    versions of one name and instant the one with the greatest ``tie`` counts, then the greatest target. Rows
    keep their columns and their number, repeats included.

    A dictionary below ``spark.sql.autoBroadcastJoinThreshold``, by a count of its bytes, is broadcast, and rows
    are not shuffled; each is compared with the versions of its name. A larger one, or one with many versions of
    a name, meets the rows by name, and both are merged in order of time, so that a
    row costs the same however many versions its name has. Names with many rows are spread over several
    groups, each with all versions of the name. ``way`` forces one of the two.
    """
    keyed = versions.filter("name is not null and valid_from is not null")
    single = latest_per_key(keyed, ["name", "valid_from"], [*tie, "target"]).select("name", "valid_from", "target")
    if way is None:
        size, most = _size(single)
        way = BROADCAST if size <= _threshold(rows) and most <= MOST_VERSIONS else MERGE
    return (_with_broadcast if way == BROADCAST else _with_merge)(rows, single, name, time, out)


def _threshold(rows: DataFrame) -> int:
    spark = rows.sparkSession
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def _size(versions: DataFrame) -> tuple[int, int]:
    """Bytes of the names and targets, with what a row takes besides, and the most versions of one name."""
    size = F.octet_length("name") + F.coalesce(F.octet_length(F.col("target").cast("string")), F.lit(0)) + 64
    each = versions.groupBy("name").agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("versions"))
    found = each.agg(F.sum("bytes"), F.max("versions")).first()
    return found[0] or 0, found[1] or 0


def _with_broadcast(rows: DataFrame, versions: DataFrame, name: str, time: str, out: str) -> DataFrame:
    following = F.lead("valid_from").over(Window.partitionBy("name").orderBy("valid_from"))
    held = F.broadcast(versions.withColumn("valid_to", following).select(F.struct("*").alias("_version")))
    v = "_version."
    then = (F.col(time) >= F.col(f"{v}valid_from")) & (F.col(f"{v}valid_to").isNull() | (F.col(time) < F.col(f"{v}valid_to")))
    found = rows.join(held, (F.col(name) == F.col(f"{v}name")) & then, "left")
    return found.select(*[F.col(c) for c in rows.columns], F.col(f"{v}target").alias(out))


def _with_merge(rows: DataFrame, versions: DataFrame, name: str, time: str, out: str) -> DataFrame:
    named = rows.filter(F.col(name).isNotNull())
    counts = named.groupBy(F.col(name).alias("_name")).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    bound = max(1.0, total * HOT_SHARE)
    # At most one name for each thousandth of the rows.
    spread = F.broadcast(
        counts.filter(F.col("_rows") > bound).select("_name", F.ceil(F.col("_rows") / bound).alias("_groups"))
    )
    groups = F.coalesce(F.col("_groups"), F.lit(1))

    dealt = named.select(F.col(name).alias("_name"), F.col(time).alias("_time"), F.struct("*").alias("_row"))
    dealt = dealt.join(spread, "_name", "left").select(
        "_name",
        F.pmod(F.monotonically_increasing_id(), groups).alias("_group"),
        "_time",
        F.lit(1).alias("_kind"),
        "_row",
    )
    held = versions.join(spread, versions["name"] == F.col("_name"), "left").select(
        F.col("name").alias("_name"),
        F.explode(F.sequence(F.lit(0).cast("long"), groups - 1)).alias("_group"),
        F.col("valid_from").alias("_time"),
        F.lit(0).alias("_kind"),
        F.struct("target").alias("_version"),
    )
    so_far = Window.partitionBy("_name", "_group").orderBy("_time", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    merged = dealt.unionByName(held, allowMissingColumns=True).withColumn(
        "_version", F.last("_version", ignorenulls=True).over(so_far)
    )
    found = merged.filter("_kind = 1").select("_row.*", F.col("_version.target").alias(out))
    nameless = rows.filter(F.col(name).isNull()).withColumn(out, F.lit(None).cast(found.schema[out].dataType))
    return found.unionByName(nameless)
