"""Attribute maps for flights whose attributes come by a stream of their own."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from keyedflow.functions.text import map_name
from keyedflow.functions.timestamps import normalize_timestamp
from keyedflow.operators.attributes import held_map, newest_values

#: Types whose order and equality are the same in Arrow as in Spark.
PLAIN = ("boolean", "tinyint", "smallint", "int", "bigint", "date", "timestamp", "timestamp_ntz", "string", "binary")

#: Rows that a task gathers before it cuts them into packets, and of its results that it hands on at once.
PACKED_ROWS, HANDED_ROWS = 500_000, 20_000

#: The time that late rows are waited for is cut into so many stretches at most, and none is shorter than a second.
STRETCHES, SHORTEST = 16, 1_000_000

#: Where a row belongs, and a packet of such rows with their greatest time.
PLACE = ("_packet_time", "_packet_bucket", "_packet_lane")
PACKET = "_time timestamp, _stretch long, _bucket int, _lane int, _rows binary"


def attach_stream(
    flights: DataFrame,
    items: DataFrame,
    keys: Sequence[str],
    at: str,
    item_at: str,
    names: Mapping[str, str],
    late: str,
    before: str = "0 seconds",
    after: str = "0 seconds",
    name: str = "name",
    value: str = "value",
    order: Sequence[str] = (),
    out: str = "attributes",
    values: Callable[[Column], Column] = normalize_timestamp,
    lanes: int = 1,
    buckets: int = 64,
) -> DataFrame:
    """Each flight with the map of its attributes, both as streams in any order, or both as tables.

    An attribute belongs to a flight with equal ``keys`` when its ``item_at`` lies between ``before`` the flight's
    ``at`` and ``after`` it, ends included. Names outside the dictionary are dropped; of equal names the greatest by
    ``item_at`` and then ``order`` wins. A flight comes out once, in append mode, when no attribute of its time can
    still come, which is when both streams have passed its stretch of time by ``late`` and ``after``; one without
    attributes has an empty map. Null keys match nothing. Flights that are equal in all columns are one; columns must
    be such that can be grouped by. Rows more than ``late`` behind their stream are dropped once their stretch is
    over, as are flights without ``at`` from streams; in a table both count, and such a flight has an empty map.
    Attributes without keys or with unknown names are left out before their time is looked at, so they do not let
    time pass.

    State holds flights and known attributes, without further columns, until their time has passed, so it grows with
    the rate of the streams and not with their age. Streams of plain columns are kept as compressed packets of rows,
    by stretch of time and by ``buckets`` of keys, see :func:`_packets`; others as rows, by a join of Spark's.
    ``buckets`` must stay the same as long as a checkpoint is in use. A key that holds much of the attributes is
    spread with ``lanes``: each lane takes a share of the attributes and a copy of the flights, and lanes meet with
    the attributes that count for a flight only.
    """
    keyed = [F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]
    rank = [F.col(item_at).alias("at"), *[F.col(c).alias(f"order_{i}") for i, c in enumerate(order)]]
    known = items.select(
        *keyed,
        F.col(item_at).alias("_item_at"),
        map_name(F.col(name), names).alias("_name"),
        F.col(value).alias("_value"),
        F.struct(*rank).alias("_rank"),
    ).filter("_name is not null")
    lane = F.pmod(F.xxhash64("_name", "_value", "_rank"), F.lit(lanes)).cast("int")
    known = known.withColumn("_item_lane", lane)
    span = {name: _micros(flights.sparkSession, text) for name, text in {"late": late, "before": before, "after": after}.items()}
    if _plain(flights, known, keys, at) and None not in span.values():
        return _packets(flights, known, keys, at, names, late, span, out, values, lanes, buckets)

    known = known.withWatermark("_item_at", late)
    spread = flights.withColumn("_lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))).withWatermark(at, late)
    same = [F.col(k) == F.col(f"_key_{i}") for i, k in enumerate(keys)]
    near = F.col("_item_at").between(
        F.col(at) - F.expr(f"INTERVAL '{before}'"), F.col(at) + F.expr(f"INTERVAL '{after}'")
    )
    condition = near & (F.col("_lane") == F.col("_item_lane"))
    for equal in same:
        condition = condition & equal
    # One column of event time goes on, that of the flights.
    joined = spread.join(known, condition, "left").select(*flights.columns, "_name", "_value", "_rank")
    return newest_values(joined, flights.columns, "_name", "_value", "_rank", names, out, values)


def _micros(spark: SparkSession, text: str) -> int | None:
    """Microseconds of an interval; none where it has months, which differ in length."""
    since = "unix_micros(timestamp'{}' + INTERVAL '{}') - unix_micros(timestamp'{}')"
    days = ("2001-02-01", "2001-03-01", "2000-02-01")
    found = set(spark.range(1).selectExpr(*[since.format(day, text, day) for day in days]).first())
    return found.pop() if len(found) == 1 else None


def _plain(flights: DataFrame, known: DataFrame, keys: Sequence[str], at: str) -> bool:
    """Both are streams, with columns that packets can hold and keys of equal types."""
    mine, other = dict(flights.dtypes), dict(known.dtypes)
    if not (flights.isStreaming and known.isStreaming) or mine[at] != "timestamp" or other["_item_at"] != "timestamp":
        return False
    kinds = [*mine.values(), other["_value"], *[f.dataType.simpleString() for f in known.schema["_rank"].dataType]]
    same = all(mine[k] == other[f"_key_{i}"] for i, k in enumerate(keys))
    return same and all(kind in PLAIN or kind.startswith("decimal") for kind in kinds)


def _packets(
    flights: DataFrame,
    known: DataFrame,
    keys: Sequence[str],
    at: str,
    names: Mapping[str, str],
    late: str,
    span: Mapping[str, int],
    out: str,
    values: Callable[[Column], Column],
    lanes: int,
    buckets: int,
) -> DataFrame:
    """The join of :func:`attach_stream` by one aggregate that keeps compressed packets of rows.

    Time is cut into stretches no shorter than ``before`` and ``after``, so the attributes of a flight lie in its own
    stretch and those beside it. Tasks cut their rows into packets by stretch, bucket of keys and lane; the state is
    a list of packets for each window of such stretches, bucket and lane. When time has passed a window, its flights
    and attributes meet as columns: sorted by key, name and rank, a flight's attribute of a name is the last one that
    is not after its time. What is of one window, bucket and lane is held by one task then.
    """
    before, after = span["before"], span["after"]
    stretch = max(abs(before), abs(after), -(-span["late"] // STRETCHES), SHORTEST)
    earlier, later = int(before > 0 or after < 0), int(after > 0 or before < 0)
    targets = sorted(set(names.values()))
    ranked = known.select("*", "_rank.*").drop("_rank", "at")
    ranks = [c for c in ranked.columns if c.startswith("order_")]
    item_keys = [f"_key_{i}" for i in range(len(keys))]
    for key in item_keys:
        ranked = ranked.filter(F.col(key).isNotNull())

    def packed(rows: DataFrame, columns: Sequence[str], time: str, by: Sequence[str], lane: Column) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*by), F.lit(buckets)) if by else F.lit(0)
        place = [c.alias(name) for c, name in zip((F.col(time), bucket.cast("int"), lane), PLACE, strict=True)]
        placed = rows.select(*columns, *place).filter(F.col(PLACE[0]).isNotNull())
        return placed.mapInArrow(_packer(stretch), PACKET).withWatermark("_time", late)

    every = F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))
    ours = packed(flights, flights.columns, at, keys, F.lit(0)).withColumn("_lane", every)
    theirs = packed(ranked, [*item_keys, "_item_at", "_name", "_value", *ranks], "_item_at", item_keys, F.col("_item_lane"))
    both = ours.withColumn("_side", F.lit(0)).unionByName(theirs.withColumn("_side", F.lit(1)))
    window = F.window("_time", f"{(1 + earlier + later) * stretch} microseconds", f"{stretch} microseconds")
    in_windows = both.select(window.alias("_window"), "_stretch", "_bucket", "_lane", "_side", "_rows")
    own = F.unix_micros("_window.start") == (F.col("_stretch") - earlier) * stretch
    held = in_windows.filter((F.col("_side") == 1) | own).groupBy("_window", "_bucket", "_lane")
    listed = held.agg(F.collect_list(F.struct("_side", "_rows")).alias("_held"))
    # Rows of one window, bucket and lane follow each other.
    passed = listed.select(F.unix_micros("_window.start").alias("_start"), "_bucket", "_lane", F.inline("_held"))

    kind = known.schema["_value"].dataType
    meeting = _Meeting(tuple(keys), at, before, after, tuple(targets), tuple(ranks), flights.columns, to_arrow_type(kind))
    if lanes > 1:
        shared = passed.mapInArrow(meeting.share, "_start long, _bucket int, _flights binary, _items binary")
        passed, meet = shared.repartition("_start", "_bucket"), meeting.of_lanes(lanes)
    else:
        meet = meeting.of_packets
    columns = [*flights.schema, *[T.StructField(f"_{i}", T.StructType([T.StructField("value", kind)])) for i in range(len(targets))]]
    return passed.mapInArrow(meet, T.StructType(columns)).select(*flights.columns, held_map(targets, values).alias(out))


def _written(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def _read(packets: Sequence[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(p).read_all() for p in packets]).combine_chunks()


def _packer(stretch: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cuts a task's rows into packets by stretch, bucket and lane."""

    def cut(gathered: Sequence[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(gathered).combine_chunks()
        time, bucket, lane = (table[c].cast(pa.int64()).to_numpy() for c in PLACE)
        number = time // stretch
        by = np.lexsort((lane, bucket, number))
        place = np.stack([number, bucket, lane])[:, by]
        first = np.flatnonzero(np.r_[True, (place[:, 1:] != place[:, :-1]).any(axis=0)])
        rows = table.drop_columns(list(PLACE)).take(pa.array(by)).combine_chunks()
        ends = np.r_[first[1:], len(by)]
        packets = pa.array([_written(rows.slice(a, b - a)) for a, b in zip(first, ends, strict=True)], pa.binary())
        newest = pa.array(np.maximum.reduceat(time[by], first)).cast(pa.timestamp("us", "UTC"))
        number, bucket, lane = place[:, first]
        columns = [newest, pa.array(number), pa.array(bucket.astype("int32")), pa.array(lane.astype("int32")), packets]
        return pa.RecordBatch.from_arrays(columns, ["_time", "_stretch", "_bucket", "_lane", "_rows"])

    def packets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, count = [], 0
        for batch in batches:
            if batch.num_rows:
                gathered.append(batch)
                count += batch.num_rows
            if count >= PACKED_ROWS:
                yield cut(gathered)
                gathered, count = [], 0
        if gathered:
            yield cut(gathered)

    return packets


class _Meeting:
    """Flights and attributes of one window and bucket, as columns."""

    def __init__(self, keys, at, before, after, targets, ranks, columns, kind):
        self.keys, self.at, self.before, self.after = keys, at, before, after
        self.targets, self.ranks, self.columns, self.kind = targets, ranks, columns, kind

    def distinct(self, flights: pa.Table) -> pa.Table:
        return flights.group_by(self.columns, use_threads=False).aggregate([]).select(self.columns)

    def codes(self, flights: pa.Table, items: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """A number for each key, the same on both sides; below zero where a key is null."""
        code = np.zeros(len(flights) + len(items), "int64")
        null = np.zeros(len(code), bool)
        for i, key in enumerate(self.keys):
            chunks = [*flights[key].chunks, *items[f"_key_{i}"].chunks]
            index = pa.chunked_array(chunks).combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy()
            null |= index < 0
            code = np.unique(code * (int(index.max(initial=0)) + 2) + index + 1, return_inverse=True)[1]
        code = np.where(null, -1, code)
        return code[: len(flights)], code[len(flights) :]

    def newest(self, flights: pa.Table, items: pa.Table) -> Iterator[np.ndarray]:
        """For each target the row of the attribute that each flight has, below zero where it has none."""
        code, item_code = self.codes(flights, items)
        of_target = pc.index_in(items["_name"], pa.array(self.targets, pa.string())).to_numpy()
        time = items["_item_at"].cast(pa.int64()).to_numpy()
        segment = item_code * len(self.targets) + of_target
        ranks = {c: pc.cast(items[c], pa.int8()) if pa.types.is_boolean(items[c].type) else items[c] for c in self.ranks}
        by = pa.table({"_segment": segment, "_time": time, **ranks})
        row = pc.sort_indices(by, [(c, "ascending") for c in by.column_names], null_placement="at_start").to_numpy().astype("int64")
        segment, time = segment[row], time[row]
        times = np.unique(time)
        spot = segment * (len(times) + 1) + np.searchsorted(times, time)
        at = flights[self.at].cast(pa.int64()).to_numpy()
        last = np.searchsorted(times, at + self.after, "right") - 1
        for i in range(len(self.targets)):
            mine = code * len(self.targets) + i
            found = np.searchsorted(spot, mine * (len(times) + 1) + last, "right") - 1
            held = np.maximum(found, 0)
            fits = (found >= 0) & (code >= 0)
            if len(row):
                fits &= (segment[held] == mine) & (time[held] >= at - self.before)
                yield np.where(fits, row[held], -1)
            else:
                yield np.full(len(at), -1)

    def attached(self, flights: Sequence[bytes], items: Sequence[bytes]) -> pa.Table:
        mine = self.distinct(_read(flights))
        theirs = _read(items) if items else None
        found = self.newest(mine, theirs) if items else [np.full(len(mine), -1)] * len(self.targets)
        for i, row in enumerate(found):
            none = row < 0
            place = pa.array(np.maximum(row, 0), mask=none)
            value = pa.chunked_array(theirs["_value"].take(place)).combine_chunks() if items else pa.nulls(len(row), self.kind)
            mine = mine.append_column(f"_{i}", pa.StructArray.from_arrays([value], ["value"], mask=pa.array(none)))
        return mine

    @staticmethod
    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, ...], tuple[list[bytes], list[bytes]]]]:
        """Packets of flights and of attributes by window, bucket and lane, where there are flights."""
        place, held = None, ([], [])
        for batch in batches:
            for *mine, side, rows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if mine != place:
                    if held[0]:
                        yield place, held
                    place, held = mine, ([], [])
                held[side].append(rows)
        if held[0]:
            yield place, held

    def of_packets(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return self.handed(self.attached(*held) for _, held in self.groups(batches))

    def share(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row a lane: the attributes that count for a flight among the lane's own, and of the first lane the flights."""
        for (start, bucket, lane), (flights, items) in self.groups(batches):
            mine = self.distinct(_read(flights))
            counting = None
            if items:
                theirs = _read(items)
                row = np.unique(np.concatenate(list(self.newest(mine, theirs))))
                counting = _written(theirs.take(pa.array(row[row >= 0])))
            columns = [[start], [bucket], [None if lane else _written(mine)], [counting]]
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["_start", "_bucket", "_flights", "_items"])

    def of_lanes(self, lanes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """Lanes of a window and bucket come out of the state in one batch, so they meet in one task without a state."""

        def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
            waiting: dict[tuple[int, int], list[tuple]] = {}
            for batch in batches:
                for start, bucket, *held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    parts = waiting.setdefault((start, bucket), [])
                    parts.append(held)
                    if len(parts) == lanes:
                        flights, items = zip(*waiting.pop((start, bucket)), strict=True)
                        yield self.attached([f for f in flights if f], [i for i in items if i])
            if waiting:
                raise RuntimeError(f"lanes are missing for {len(waiting)} windows")

        return lambda batches: self.handed(met(batches))

    @staticmethod
    def handed(tables: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        """Batches of about the same size, whatever the tables hold."""
        gathered, count = [], 0
        for table in tables:
            gathered.append(table)
            count += len(table)
            if count >= HANDED_ROWS:
                yield from pa.concat_tables(gathered).combine_chunks().to_batches(max_chunksize=HANDED_ROWS)
                gathered, count = [], 0
        if gathered:
            yield from pa.concat_tables(gathered).combine_chunks().to_batches(max_chunksize=HANDED_ROWS)
