"""Vectors as short codes: each part of a vector becomes the number of its nearest codebook entry.

Distances run over a trie. The distinct parts of a block of vectors, in lexicographic order, are the leaves;
parts with the same first components share a path, and what those components add to the distances from all
entries is worked out once for the path. The walk is depth first, a run of leaves at a time: it keeps one vector
of distances per depth for the path that leads into the next run, so memory does not grow with the block.
A leaf takes its nearest entry and adds its components, times the number of its vectors, to that entry's sums.

Sums of blocks add up, so blocks are independent and vectors are never shuffled; a round of training sends one
row per codebook number and task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyedflow.llm.common import release, saved, ship_package

#: Vectors of one block, and the bytes of components at which a block is closed before that.
BLOCK_ROWS, BLOCK_BYTES = 1 << 14, 16 << 20

#: Leaves of one step of the walk.
LEAVES = 2048

#: Components as integers stay below this, so that squares over thousands of them fit in 64 bits.
COMPONENT_BOUND = 1 << 24

#: A label with more than this share of all rows is a hot one; there can't be more than 1,000 of those.
HOT_SHARE = 1 / 1000


@dataclass(frozen=True)
class CodeSpec:
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096

    def __post_init__(self) -> None:
        if not 1 <= self.entries <= 256:
            raise ValueError("a code has two hex digits a part: 1 to 256 entries")


def distinct_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows in lexicographic order, how often each occurs, and the place of every row among them."""
    order = np.lexsort(parts.T[::-1])
    ordered = parts[order]
    first = np.ones(len(parts), bool)
    first[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    place = np.empty(len(parts), np.int64)
    place[order] = np.cumsum(first) - 1
    return ordered[first], np.diff(np.append(np.flatnonzero(first), len(parts))), place


def walk(leaves: np.ndarray, entries: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Squared distances of distinct, ordered leaves from all entries, for one run of leaves after the other."""
    depth, k = leaves.shape[1], len(entries)
    # The depth at which each leaf leaves the path of the one before it.
    branch = np.zeros(len(leaves), np.int64)
    branch[1:] = (leaves[1:] != leaves[:-1]).argmax(axis=1)
    path = [np.zeros((1, k), np.int64) for _ in range(depth)]
    for begin in range(0, len(leaves), LEAVES):
        run = slice(begin, min(begin + LEAVES, len(leaves)))
        # Node 0 of each depth is the one on the path so far; the run adds the others in order.
        above, node_of = np.zeros((1, k), np.int64), np.zeros(run.stop - begin, np.int64)
        for d in range(depth):
            new = np.flatnonzero(branch[run] <= d)
            step = leaves[run][new, d, None] - entries[:, d]
            nodes = np.concatenate((path[d], above[node_of[new]] + step * step))
            path[d] = nodes[-1:]
            node_of = np.cumsum(branch[run] <= d)
            above = nodes
        yield run, above[node_of]


def blocks(batches: Iterator[pa.RecordBatch], bytes_per_row: int) -> Iterator[pa.Table]:
    """Arrow batches joined to blocks of a bounded size."""
    rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // max(1, bytes_per_row)))
    held: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            room = rows - sum(b.num_rows for b in held)
            held.append(batch.slice(0, room))
            batch = batch.slice(room)
            if sum(b.num_rows for b in held) == rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def integers(block: pa.Table, spec: CodeSpec, width: int) -> np.ndarray:
    """Components as integers, by vector, part and position; vectors of another length are an error."""
    vectors = block["_vector"].combine_chunks()
    lengths = np.diff(vectors.offsets.to_numpy())
    if len(lengths) and (lengths != width).any():
        raise ValueError(f"vectors have {width} components and {int(lengths[lengths != width][0])}")
    scaled = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * spec.scale)
    if len(scaled) and np.abs(scaled).max() >= COMPONENT_BOUND:
        raise ValueError(f"a component times {spec.scale} is {COMPONENT_BOUND} or more, too large for exact sums")
    return scaled.astype(np.int64).reshape(len(block), spec.parts, width // spec.parts)


def usable(vectors: DataFrame, vector_column: str) -> DataFrame:
    """Rows whose vector is there and has finite components only."""
    finite = F.forall(vector_column, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return vectors.filter(F.col(vector_column).isNotNull() & finite)


def first_codebooks(kept: DataFrame, spec: CodeSpec) -> np.ndarray | None:
    """The parts of the vectors with the smallest identifiers, by part, entry and position; none without vectors.

    Of equal identifiers the lexicographically smallest vector comes first, null identifiers come last.
    """
    smallest = kept.orderBy(F.col("_id").asc_nulls_last(), "_vector").limit(spec.entries).select("_vector")
    first = smallest.toArrow()
    if not first.num_rows:
        return None
    width = len(first["_vector"][0])
    if not width or width % spec.parts:
        raise ValueError(f"vectors of {width} components can't be cut into {spec.parts} equal parts")
    return integers(first, spec, width).transpose(1, 0, 2).copy()


def trie_leaves(kept: DataFrame, spec: CodeSpec, width: int) -> DataFrame:
    """The leaves of every block's tries: one row per block and part, written once and read by each round."""

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, 8 * width):
            numbers = integers(block, spec, width)
            found = [distinct_parts(numbers[:, p])[:2] for p in range(spec.parts)]
            yield pa.record_batch(
                {
                    "part": pa.array(range(spec.parts), pa.int32()),
                    "leaves": pa.array([part.astype("<i4").tobytes() for part, _ in found], pa.binary()),
                    "weights": pa.array([weights.astype("<i4").tobytes() for _, weights in found], pa.binary()),
                }
            )

    narrow = kept.select("_vector")
    rows = narrow.mapInArrow(lambda b: release(leaves(b)), "part int, leaves binary, weights binary")
    return saved(rows, "trie-leaves")


def entry_sums(leaves: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Per part and entry, the sums of the components that fall to it and, last, their number."""
    parts, entries, width = codebooks.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                p = row["part"]
                keys = np.frombuffer(row["leaves"], "<i4").reshape(-1, width).astype(np.int64)
                weights = np.frombuffer(row["weights"], "<i4").astype(np.int64)
                for run, distances in walk(keys, codebooks[p]):
                    # Ties go to the lower number.
                    nearest = distances.argmin(axis=1)
                    weighted = np.column_stack((keys[run], np.ones(len(nearest), np.int64))) * weights[run, None]
                    np.add.at(total[p], nearest, weighted)
        p, e, j = np.nonzero(total)
        yield pa.record_batch({"part": p, "entry": e, "position": j, "total": total[p, e, j]})

    shares = leaves.mapInArrow(sums, "part long, entry long, position long, total long")
    added = shares.groupBy("part", "entry", "position").agg(F.sum("total").alias("total"))
    result = np.zeros((parts, entries, width + 1), np.int64)
    # One row per codebook number, whatever the table holds.
    for row in added.collect():
        result[row["part"], row["entry"], row["position"]] = row["total"]
    return result


def trained(leaves: DataFrame, codebooks: np.ndarray, rounds: int) -> np.ndarray:
    """Codebooks after so many rounds; an entry that nothing falls to stays as it is."""
    for _ in range(rounds):
        sums = entry_sums(leaves, codebooks)
        counts = sums[:, :, -1:]
        codebooks = np.where(counts > 0, sums[:, :, :-1] // np.maximum(counts, 1), codebooks)
    return codebooks


def codebook_digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def assigned(kept: DataFrame, codebooks: np.ndarray, spec: CodeSpec) -> DataFrame:
    """Code and error of every vector."""
    width = codebooks.shape[0] * codebooks.shape[2]
    types = {c: kept.schema[c].dataType.simpleString() for c in ("_id", "_label")}

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, 8 * width):
            numbers = integers(block, spec, width)
            codes = np.empty((len(block), spec.parts), np.uint8)
            errors = np.zeros(len(block), np.int64)
            for p in range(spec.parts):
                keys, _, place = distinct_parts(numbers[:, p])
                nearest, distance = np.empty(len(keys), np.uint8), np.empty(len(keys), np.int64)
                for run, distances in walk(keys, codebooks[p]):
                    nearest[run], distance[run] = distances.argmin(axis=1), distances.min(axis=1)
                codes[:, p] = nearest[place]
                errors += distance[place]
            digits = codes.tobytes().hex()
            step = 2 * spec.parts
            yield pa.record_batch(
                {
                    "_id": block["_id"].combine_chunks(),
                    "_label": block["_label"].combine_chunks(),
                    "code": pa.array([digits[i : i + step] for i in range(0, len(digits), step)], pa.string()),
                    "error": errors,
                }
            )

    schema = f"_id {types['_id']}, _label {types['_label']}, code string, error long"
    return kept.mapInArrow(lambda b: release(coded(b)), schema)


def with_label_errors(rows: DataFrame) -> DataFrame:
    """Add the sum of errors over rows of the same label, nulls being one label.

    Labels that hold more than a thousandth of all rows are at most a thousand, so their sums are broadcast.
    The others meet their sums in a shuffle in which no label is large. ``rows`` is a written table.
    """
    sums = rows.groupBy("_label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_rows"))
    sums = saved(sums.select(F.struct("_label").alias("_of"), "label_error", "_rows"), "label-errors")
    bound = HOT_SHARE * (sums.agg(F.sum("_rows")).first()[0] or 0)
    same = F.col("_label").eqNullSafe(F.col("_of._label"))
    hot = F.broadcast(sums.filter(F.col("_rows") > bound))
    few = rows.join(hot.select("_of"), same, "left_anti").join(sums.filter(F.col("_rows") <= bound), same)
    columns = [*rows.columns, "label_error"]
    return rows.join(hot, same).select(*columns).unionByName(few.select(*columns))


def vector_codes(
    vectors: DataFrame,
    spec: CodeSpec = CodeSpec(),
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """Per usable vector: the identifier, ``code``, ``error``, ``label_error`` and ``codebooks_sha256``.

    Rows whose vector is null or holds a null or non-finite component are left out; null identifiers and null
    labels stay, and repeated rows come out as often as they go in. Fewer vectors than entries give smaller
    codebooks. A table without usable vectors gives no rows. Vectors of different lengths, a length that the
    parts don't divide and components too large for exact sums are errors. Other columns are not read.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    types = {c: vectors.schema[c].dataType for c in (id_column, label_column)}
    kept = usable(vectors, vector_column).select(
        F.col(id_column).alias("_id"), F.col(vector_column).alias("_vector"), F.col(label_column).alias("_label")
    )
    codebooks = first_codebooks(kept, spec)
    if codebooks is None:
        empty = T.StructType().add(id_column, types[id_column]).add("code", "string").add("error", "long")
        return spark.createDataFrame([], empty.add("label_error", "long").add("codebooks_sha256", "string"))
    leaves = trie_leaves(kept, spec, codebooks.shape[0] * codebooks.shape[2])
    codebooks = trained(leaves, codebooks, spec.rounds)
    rows = saved(assigned(kept, codebooks, spec), "vector-codes")
    return with_label_errors(rows).select(
        F.col("_id").alias(id_column),
        "code",
        "error",
        "label_error",
        F.lit(codebook_digest(codebooks)).alias("codebooks_sha256"),
    )
