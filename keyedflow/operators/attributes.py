"""Lists of name/value attributes: exploded, pivoted to maps, attached and regrouped."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyedflow.config import MapGroup
from keyedflow.functions.binding import let
from keyedflow.functions.text import map_name
from keyedflow.functions.timestamps import normalize_timestamp

STRING_MAP = "map<string,string>"


def empty_map() -> Column:
    return F.create_map().cast(STRING_MAP)


def explode_items(df: DataFrame, items: str, name: str = "name", value: str = "value") -> DataFrame:
    """One row per list entry; a null or empty list keeps its row, with null name and value.

    The position is kept so that a later step can tell which of two equal names came last.
    """
    rest = [c for c in df.columns if c != items]
    rows = df.select(*rest, F.posexplode_outer(items).alias("position", "_item"))
    return rows.select(
        *rest,
        "position",
        F.col("_item.name").alias(name),
        F.col("_item.value.value").alias(value),
    )


def item_map(
    items: Column,
    names: Mapping[str, str],
    values: Callable[[Column], Column] = normalize_timestamp,
) -> Column:
    """Fold a list of name/value entries into a map, row by row and without a shuffle.

    Names outside the dictionary are dropped, the last of several equal names wins, values are
    brought to the common time form, and a null or empty list gives an empty map. Work per row grows
    with the length of the list times that of the dictionary at most.
    """
    entries = F.transform(
        items, lambda i: F.struct(map_name(i["name"], names).alias("name"), i["value"]["value"].alias("value"))
    )
    known = F.reverse(F.filter(entries, lambda e: e["name"].isNotNull()))

    def columns(e: Column) -> Column:
        return F.struct(
            F.array_distinct(e["name"]).alias("distinct"), e["name"].alias("names"), e["value"].alias("values")
        )

    def fold(c: Column) -> Column:
        def newest(name: Column) -> Column:
            return F.element_at(c["values"], F.array_position(c["names"], name).cast("int"))

        chosen = F.transform(c["distinct"], newest)
        return F.map_from_arrays(c["distinct"], F.transform(chosen, lambda v: values(v)))

    return F.coalesce(let(known, lambda e: let(columns(e), fold)), empty_map())


def pivot_rows(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    value: str,
    order: Sequence[str],
    names: Mapping[str, str],
    out: str = "attributes",
    values: Callable[[Column], Column] = normalize_timestamp,
) -> DataFrame:
    """The same fold for entries that arrive as rows of their own: one map per key.

    One aggregate keeps the newest value of each dictionary entry, partly before the only shuffle, so a key
    sends one row per partition, with no more values than the dictionary has, however many rows it has.
    """
    mapped = df.withColumn("_name", map_name(F.col(name), names)).filter("_name is not null")
    ranked = mapped.withColumn("_rank", F.struct(*order))
    return newest_values(ranked, keys, "_name", value, "_rank", names, out, values)


def newest_values(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    value: str,
    rank: str,
    names: Mapping[str, str],
    out: str,
    values: Callable[[Column], Column],
) -> DataFrame:
    """One map per key of rows whose names are mapped already: of each name the value of greatest rank.

    A key whose rows have null names only gets an empty map. Serves tables and, in append mode, streams.
    """
    targets = sorted(set(names.values()))
    found = F.struct(F.col(value).alias("value"))

    def newest(target: str) -> Column:
        mine = F.col(name) == target
        return F.max_by(F.when(mine, found), F.when(mine, F.col(rank)))

    folded = df.groupBy(*keys).agg(*[newest(t).alias(f"_{i}") for i, t in enumerate(targets)])
    return folded.select(*keys, held_map(targets, values).alias(out))


def held_map(targets: Sequence[str], values: Callable[[Column], Column]) -> Column:
    """The map of columns ``_0``, ``_1`` and so on: for each target a struct of its value, null where it has none."""
    entries = F.array(*[F.struct(F.lit(t).alias("name"), F.col(f"_{i}").alias("held")) for i, t in enumerate(targets)])
    present = F.filter(entries, lambda e: e["held"].isNotNull())
    pairs = F.transform(present, lambda e: F.struct(e["name"], values(e["held"]["value"])))
    return F.map_from_entries(pairs)


def attach_map(
    base: DataFrame, maps: DataFrame, keys: Sequence[str], out: str = "attributes"
) -> DataFrame:
    """Left join of a map per key; rows without one get an empty map. Null keys match nothing."""
    return base.join(maps, list(keys), "left").withColumn(out, F.coalesce(F.col(out), empty_map()))


def with_alias_keys(attributes: Column, aliases: Mapping[str, str]) -> Column:
    """Add further keys that repeat the value of existing ones, null where those are missing."""
    if not aliases:
        return attributes

    def extended(m: Column) -> Column:
        pairs = [part for alias, key in aliases.items() for part in (F.lit(alias), m[key])]
        return F.map_concat(m, F.create_map(*pairs))

    return let(attributes, extended)


def fixed_map(attributes: Column, keys: Column) -> Column:
    """A map with exactly the listed keys, null where the source has none."""

    def pick(bound: Column) -> Column:
        return F.map_from_arrays(bound["keys"], F.transform(bound["keys"], lambda k: bound["source"][k]))

    return let(F.struct(attributes.alias("source"), keys.alias("keys")), pick)


def group_map(attributes: Column, group: MapGroup, kind: Column) -> Column:
    """One-element list of the group's map, with the further keys for rows of the group's kind."""
    keys = F.lit(list(group.keys))
    if group.kind is not None:
        keys = F.when(kind == group.kind, F.lit([*group.keys, *group.kind_keys])).otherwise(keys)
    return F.array(fixed_map(attributes, keys))
