"""Packing of documents into fixed windows by non-negative least squares.

Whole windows are cut off the front of each document. For the tails, combinations of two or three lengths
that fill a window are enumerated; non-negative least squares finds how often to use each so that together
they use up the histogram of tail lengths; the counts are rounded down to what the histogram holds. Tails
that are left over are laid end to end, longest first, and cut at window ends. Only the last window can have
room left.

The plan depends on the histogram alone, which has fewer rows than the window has tokens, so it is made on
the driver whatever the size of the input. A document's place follows from its rank among equal tail lengths.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyedflow.llm.common import release, saved, ship_package
from keyedflow.llm.tokens import encoder, groups_of

WINDOW, END = 1024, 0
ITERATIONS = 400
#: Words whose ids a worker keeps; the plan comes after the encoding, so there may be many.
CACHE_WORDS = 700_000

TOKENIZED = "id long, n long, part int, tail int, rank long, full_before long, crcs array<long>, rest binary"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def cutter(path: str, window: int, end: int | None):
    """Encode documents; checksums of their whole windows, and the ids of their tails."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, CACHE_WORDS).encode_column
        close = b"" if end is None else int(end).to_bytes(4, "little")
        part, full_before = TaskContext.get().partitionId(), 0
        seen: Counter[int] = Counter()
        for batch in release(batches):
            texts = batch["text"]
            for begin, stop in groups_of(texts):
                columns: dict[str, list] = {k: [] for k in ("n", "tail", "rank", "full_before", "crcs", "rest")}
                data, offsets = encode(texts[begin:stop], close)
                for first, last in pairwise(offsets.tolist()):
                    ids = data[first:last]
                    n = len(ids) // 4
                    full, tail = divmod(n, window)
                    columns["n"].append(n)
                    columns["tail"].append(tail)
                    columns["rank"].append(seen[tail])
                    columns["full_before"].append(full_before)
                    columns["crcs"].append([zlib.crc32(ids[4 * window * i : 4 * window * (i + 1)]) for i in range(full)])
                    columns["rest"].append(ids[4 * window * full :].tobytes())
                    seen[tail] += 1
                    full_before += full
                yield pa.record_batch(
                    {
                        "id": batch["id"].slice(begin, stop - begin),
                        "n": pa.array(columns["n"], pa.int64()),
                        "part": pa.array([part] * (stop - begin), pa.int32()),
                        "tail": pa.array(columns["tail"], pa.int32()),
                        "rank": pa.array(columns["rank"], pa.int64()),
                        "full_before": pa.array(columns["full_before"], pa.int64()),
                        "crcs": pa.array(columns["crcs"], pa.list_(pa.int64())),
                        "rest": pa.array(columns["rest"], pa.binary()),
                    }
                )

    return cut


def pairs(lengths: np.ndarray, window: int) -> np.ndarray:
    """Two occurring lengths that sum to the window, as rows padded with zero, each set once."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    a = lengths[lengths * 2 <= window]
    return np.stack([a, window - a, np.zeros_like(a)], axis=1)[there[window - a]].astype(np.int64)


def triples(lengths: np.ndarray, window: int) -> np.ndarray:
    """Three occurring lengths that sum to the window, each set once."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    first, second = (x.ravel() for x in np.meshgrid(lengths, lengths, indexing="ij"))
    third = window - first - second
    fits = (first <= second) & (second <= third)
    first, second, third = first[fits], second[fits], third[fits]
    return np.stack([first, second, third], axis=1)[there[third]].astype(np.int64)


def solve(combos: np.ndarray, histogram: np.ndarray, iterations: int = ITERATIONS) -> np.ndarray:
    """Non-negative repeat counts that bring the lengths used closest to the histogram, in least squares.

    Accelerated projected gradient; residuals are weighted by the root of the counts, so that rare lengths
    matter as well. Padding (length 0) takes no part.
    """
    if not len(combos):
        return np.zeros(0)
    scale = 1 / np.maximum(histogram, 1)
    scale[0] = 0

    def used(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(combos[:, k], x, len(histogram)) for k in range(3))

    weight = sum(used_per_combo for used_per_combo in (scale[combos[:, k]] for k in range(3)))
    load = used(np.ones(len(combos))) * scale
    step = 1 / np.maximum((load[combos] * (combos > 0)).sum(axis=1), weight)  # a diagonal bound of the curvature
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(iterations):
        residual = (used(y) - histogram) * scale
        gradient = residual[combos[:, 0]] + residual[combos[:, 1]] + residual[combos[:, 2]]
        new = np.maximum(0, y - step * gradient)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


class Plan:
    """Where the tail with a given length and rank goes."""

    def __init__(self, histogram: dict[int, int], window: int = WINDOW):
        self.window = window
        counts = np.zeros(window + 1, np.int64)
        for length, n in histogram.items():
            counts[length] = n
        counts[0] = counts[window] = 0
        slots: dict[int, list[tuple[int, int, int]]] = {}
        used = np.zeros(window + 1, np.int64)
        sequence = 0
        for shape in (pairs, triples):  # the shallow ones first, the others for what these leave
            left = counts - used
            combos = shape(np.flatnonzero(left), window)
            wanted = solve(combos, left.astype(float))
            # The most wanted first; rounded, and down to what the histogram still holds.
            for i in np.argsort(-wanted, kind="stable"):
                members = [int(m) for m in combos[i] if m]
                need = Counter(members)
                times = min(int(wanted[i] + 0.5), *(int(counts[m] - used[m]) // k for m, k in need.items()))
                if times < 1:
                    continue
                offset = 0
                for m in sorted(members, reverse=True):
                    slots.setdefault(m, []).append((int(used[m]), sequence, offset))
                    used[m] += times
                    offset += m
                sequence += times
        #: By length: first ranks of its slots, the sequence of that rank, and the offset in it.
        self.slots = {m: tuple(np.array(x, np.int64) for x in zip(*s, strict=True)) for m, s in slots.items()}
        self.used = used
        self.combined = sequence
        left = (counts - used) * np.arange(window + 1)
        after = np.cumsum(left[::-1])[::-1]
        #: Tokens of left-over tails that are longer, which come first in the stream.
        self.stream = np.append(after[1:], 0)
        self.sequences = sequence + -(-int(after[0]) // window)

    def place(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """Pieces of a tail: start in it, length, sequence, offset."""
        if rank < self.used[length]:
            firsts, sequences, offsets = self.slots[length]
            k = int(np.searchsorted(firsts, rank, side="right")) - 1
            return [(0, length, int(sequences[k]) + rank - int(firsts[k]), int(offsets[k]))]
        position = int(self.stream[length]) + (rank - int(self.used[length])) * length
        pieces, at = [], 0
        while at < length:
            sequence, offset = divmod(position + at, self.window)
            size = min(length - at, self.window - offset)
            pieces.append((at, size, self.combined + sequence, offset))
            at += size
        return pieces


def placer(sent, window: int):
    """``sent``: a broadcast plan, whose size is bounded by the window's."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan: Plan = sent.value
        for batch in batches:
            found: list[tuple] = []
            for row in batch.to_pylist():
                doc, n, tail = row["id"], row["n"], row["tail"]
                first = plan.sequences + row["full_before"] + row["full_start"]
                for i, crc in enumerate(row["crcs"]):
                    found.append((doc, i * window, window, crc, n, first + i, 0))
                if not tail:
                    continue
                for at, size, sequence, offset in plan.place(tail, row["rank"] + row["rank_start"]):
                    crc = zlib.crc32(row["rest"][4 * at : 4 * (at + size)])
                    found.append((doc, n - tail + at, size, crc, n, sequence, offset))
            columns = list(zip(*found, strict=True)) or [()] * 7
            names = [c.split()[0] for c in PIECES.split(", ")]
            yield pa.record_batch({k: pa.array(c, pa.int64()) for k, c in zip(names, columns, strict=True)})

    return place


def pack(
    rows: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end: int | None = END,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    Every id of a document, the end id included, is in exactly one piece; sequences have no gaps, and all but
    one are full. Null texts are empty and are packed as their end id (without one they have no pieces). Null
    and repeated identifiers are packed like others. No rows give no pieces.
    """
    spark = rows.sparkSession
    ship_package(spark)
    slim = rows.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    cut = saved(slim.mapInArrow(cutter(tokenizer_path, window, end), TOKENIZED), "cut-documents")
    per_part = saved(cut.groupBy("part", "tail").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("crcs")).alias("full")), "tails")
    histogram = {r["tail"]: r["n"] for r in per_part.groupBy("tail").agg(F.sum("n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(Plan(histogram, window))
    earlier = lambda w: w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select(
        "part", "tail", F.coalesce(F.sum("n").over(earlier(Window.partitionBy("tail"))), F.lit(0)).alias("rank_start")
    )
    full = per_part.groupBy("part").agg(F.sum("full").alias("full"))
    full = full.select("part", F.coalesce(F.sum("full").over(earlier(Window)), F.lit(0)).alias("full_start"))
    placed = cut.join(starts.join(full, "part"), ["part", "tail"])
    return placed.mapInArrow(placer(plan, window), PIECES)


def padding(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row: sequences, tokens, and padding tokens. A sequence whose length is a power of two takes none."""
    filled = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    bits = F.bit_count("n")
    return filled.agg(
        F.count(F.lit(1)).alias("sequences"),
        F.sum("n").alias("tokens"),
        F.sum(F.when(bits == 1, 0).otherwise(F.lit(window) - F.col("n"))).alias("padding"),
    )
