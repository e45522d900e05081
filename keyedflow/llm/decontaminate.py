"""Benchmark decontamination with an FM-index per training shard.

Each task indexes blocks of its documents: the Burrows-Wheeler transform of their word sequence in a wavelet
matrix, with sampled suffix positions. The benchmark's windows are searched backward through wavelet ranks,
all at once, and their occurrences located by walking to a sampled position. Words that occur in no window
break the sequence: no window can cross one, so runs shorter than the shortest window need no index.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyedflow.llm.common import ROW, drop_rows, numbered_once, release, saved, ship_package, with_row_key

#: Runs of digits, a-z and everything beyond ASCII, in UTF-8 after lower-casing A-Z.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
WINDOW = 10
#: Benchmark text in bytes that is searched in one pass over the documents; more text takes more passes.
PASS_BYTES = 32 << 20
#: Symbols of one index, and how many text positions lie between sampled suffixes.
SHARD_SYMBOLS, SAMPLE = 1 << 20, 8


def words_of(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []


class Windows:
    """The windows of benchmark items: symbols of their words, and the items of every distinct window."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.symbols: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set] = {}
        for item, text in items:
            words = [self.symbols.setdefault(w, len(self.symbols) + 1) for w in words_of(text)]
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if words else 0):
                owners.setdefault(tuple(words[i : i + size]), set()).add(item)
        by_length: dict[int, list[tuple[int, ...]]] = {}
        for found in owners:
            by_length.setdefault(len(found), []).append(found)
        #: By length: a matrix of windows, and for each row of it the identifiers of its items.
        self.groups = [
            (n, np.array(rows, np.int64), [tuple(owners[r]) for r in rows]) for n, rows in sorted(by_length.items())
        ]
        self.shortest = min(by_length, default=0)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of a sequence whose last symbol is its only zero, by prefix doubling."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    size, step = len(text), 1
    while True:
        second = np.zeros(size, np.int64)
        second[:-step] = rank[step:] + 1 if step < size else 0
        key = rank * (size + 1) + second
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = np.empty(size, np.int64)
        rank[order] = fresh
        step *= 2
        if fresh[-1] == size - 1 or step >= size:
            return order


class WaveletMatrix:
    """Rank and access over a sequence of small integers, a bit vector per binary digit."""

    def __init__(self, sequence: np.ndarray, top: int):
        self.levels = max(1, int(top).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bits = (sequence >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bits))).astype(np.int32))
            self.zeros.append(int(len(bits) - bits.sum()))
            sequence = np.concatenate((sequence[bits == 0], sequence[bits == 1]))

    def rank(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its position."""
        start = np.zeros_like(position)
        for depth in range(self.levels):
            ones, zeros = self.ones[depth], self.zeros[depth]
            up = (symbol >> (self.levels - 1 - depth)) & 1 == 1
            ones_start, ones_position = ones[start], ones[position]
            start = np.where(up, zeros + ones_start, start - ones_start)
            position = np.where(up, zeros + ones_position, position - ones_position)
        return position - start

    def access(self, position: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(position)
        for depth in range(self.levels):
            ones, zeros = self.ones[depth], self.zeros[depth]
            bit = ones[position + 1] - ones[position]
            symbol = symbol * 2 + bit
            position = np.where(bit == 1, zeros + ones[position], position - ones[position])
        return symbol


class FMIndex:
    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        """Index of symbols above zero; the end is marked with a zero."""
        text = np.append(text, 0).astype(np.int64)
        order = suffix_array(text)
        before = text[order - 1]
        top = int(text.max())
        self.wavelet = WaveletMatrix(before, top)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1))))
        self.top, self.size = top, len(text)
        marked = order % sample == 0
        self.marked = marked
        self.sampled_before = np.concatenate(([0], np.cumsum(marked)))
        self.samples = order[marked]

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last (exclusive) suffix of every row of a matrix of equally long windows."""
        low = np.zeros(len(windows), np.int64)
        high = np.full(len(windows), self.size, np.int64)
        for column in range(windows.shape[1] - 1, -1, -1):
            symbol = windows[:, column]
            known = symbol <= self.top
            symbol = np.where(known, symbol, 0)
            low = np.where(known, self.first[symbol] + self.wavelet.rank(symbol, low), 0)
            high = np.where(known, self.first[symbol] + self.wavelet.rank(symbol, high), 0)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by steps back to a sampled one."""
        where = np.empty(len(rows), np.int64)
        todo, at, steps = np.arange(len(rows)), rows, 0
        while len(todo):
            done = self.marked[at]
            where[todo[done]] = self.samples[self.sampled_before[at[done]]] + steps
            todo, at = todo[~done], at[~done]
            symbol = self.wavelet.access(at)
            at = self.first[symbol] + self.wavelet.rank(symbol, at)
            steps += 1
        return where


class Shard:
    """Documents of one task that wait for an index, and the runs of known words in them."""

    def __init__(self, windows: Windows):
        self.windows = windows
        self.rows: list[tuple] = []
        self.runs: list[np.ndarray] = []
        self.at: list[tuple[int, int]] = []  # document and first word of each run
        self.symbols = 0

    def add(self, row: int, doc_id: int | None, text: bytes | None) -> None:
        words = words_of(text)
        document = len(self.rows)
        self.rows.append((row, doc_id, len(words)))
        if not self.windows.shortest or len(words) < self.windows.shortest:
            return
        codes = np.fromiter(map(self.windows.symbols.get, words, repeat(0)), np.int64, len(words))
        known = np.concatenate(([0], (codes > 0).astype(np.int8), [0]))
        edges = np.flatnonzero(np.diff(known))
        starts, ends = edges[::2], edges[1::2]
        for i in np.flatnonzero(ends - starts >= self.windows.shortest):
            self.runs.append(codes[starts[i] : ends[i]])
            self.at.append((document, int(starts[i])))
            self.symbols += int(ends[i] - starts[i]) + 1

    def hits(self) -> dict[int, tuple[list[tuple[int, int]], set]]:
        """By document: merged spans of hit words, and the items with windows there."""
        if not self.runs:
            return {}
        gap = len(self.windows.symbols) + 1
        begins = np.cumsum([0] + [len(r) + 1 for r in self.runs[:-1]])
        text = np.concatenate([np.append(r, gap) for r in self.runs])
        index = FMIndex(text)
        spans: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set] = {}
        for length, matrix, owners in self.windows.groups:
            low, high = index.search(matrix)
            found = np.flatnonzero(high > low)
            counts = high[found] - low[found]
            if not len(found):
                continue
            ends = np.cumsum(counts)
            suffixes = np.arange(ends[-1]) - np.repeat(ends - counts, counts) + np.repeat(low[found], counts)
            places = index.locate(suffixes)
            runs = np.searchsorted(begins, places, side="right") - 1
            for window, place, run in zip(np.repeat(found, counts), places, runs, strict=True):
                document, first = self.at[run]
                start = first + int(place - begins[run])
                spans.setdefault(document, []).append((start, start + length))
                items.setdefault(document, set()).update(owners[window])
        return {d: (merge_spans(s), items[d]) for d, s in spans.items()}


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return [tuple(s) for s in merged]


HITS = pa.schema(
    [
        (ROW, pa.int64()),
        ("id", pa.int64()),
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("items", pa.list_(pa.string())),
    ]
)


def searcher(windows):
    """``windows``: a broadcast of one pass's windows."""

    def flush(shard: Shard) -> pa.RecordBatch:
        hits = shard.hits()
        none: tuple[list, set] = ([], set())
        found = [hits.get(i, none) for i in range(len(shard.rows))]
        return pa.record_batch(
            [
                pa.array([r[0] for r in shard.rows], pa.int64()),
                pa.array([r[1] for r in shard.rows], pa.int64()),
                pa.array([r[2] for r in shard.rows], pa.int64()),
                pa.array([[{"start": s, "end": e} for s, e in f[0]] for f in found], HITS.field("spans").type),
                pa.array([sorted(str(i) for i in f[1] if i is not None) for f in found], HITS.field("items").type),
            ],
            schema=HITS,
        )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = windows.value
        shard = Shard(known)
        for batch in release(batches):
            texts = batch["text"].cast(pa.binary())
            for row, doc_id, text in zip(batch[ROW].to_pylist(), batch["id"].to_pylist(), texts, strict=True):
                shard.add(row, doc_id, text.as_py())
                if shard.symbols >= SHARD_SYMBOLS or len(shard.rows) >= SHARD_SYMBOLS:
                    yield flush(shard)
                    shard = Shard(known)
        if shard.rows:
            yield flush(shard)

    return search


HITS_DDL = f"{ROW} long, id long, n_words long, spans array<struct<start:long,end:long>>, items array<string>"


def passes_over(benchmark: DataFrame, text_col: str, pass_bytes: int) -> int:
    size = benchmark.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(1, -(-size // pass_bytes))


def benchmark_hits(
    rows: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """Row key, ``id``, ``n_words``, ``spans`` of hit words (merged, end exclusive) and ``items`` of a numbered frame.

    The benchmark is searched in passes of about ``pass_bytes`` of its text, so what is broadcast is bounded
    whatever its size; the spans of several passes are merged per document. Null texts have no words, on
    either side. Items without an identifier hit but are not listed; an identifier on several rows is listed
    once. An empty benchmark hits nothing.
    """
    spark = rows.sparkSession
    ship_package(spark)
    slim = rows.select(ROW, F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    bench = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
    passes = passes_over(bench, "text", pass_bytes)
    bench = bench.withColumn("pass", F.pmod(F.xxhash64("text"), F.lit(passes)))
    found = None
    for i in range(passes):
        items = [(r["item"], r["text"].encode() if r["text"] else None) for r in bench.filter(F.col("pass") == i).collect()]
        sent = spark.sparkContext.broadcast(Windows(items, window))
        part = slim.mapInArrow(searcher(sent), HITS_DDL)
        if passes > 1:
            part = saved(part, "benchmark-pass")
            sent.unpersist()
        found = part if found is None else found.union(part)
    if passes == 1:
        return found
    merged = found.groupBy(ROW).agg(
        F.first("id").alias("id"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return merged.mapInArrow(remerge, HITS_DDL)


def remerge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [merge_spans([(s["start"], s["end"]) for s in row]) for row in batch["spans"].to_pylist()]
        column = pa.array([[{"start": s, "end": e} for s, e in row] for row in spans], HITS.field("spans").type)
        yield pa.record_batch([batch[ROW], batch["id"], batch["n_words"], column, batch["items"]], schema=HITS)


def contamination(
    rows: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", pass_bytes: int = PASS_BYTES, **options
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated`` and the spans, per row.

    With several passes the rows are numbered once, as each pass is a job of its own.
    """
    several = passes_over(benchmark, options.get("item_text_col", "text"), pass_bytes) > 1
    numbered = numbered_once(rows.select(id_col, text_col)) if several else with_row_key(rows)
    hits = benchmark_hits(numbered, benchmark, id_col, text_col, pass_bytes=pass_bytes, **options)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return hits.select(
        F.col("id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        "spans",
    )


def drop_contaminated(rows: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The input without the rows that hold a window of the benchmark."""
    numbered = numbered_once(rows)
    hits = benchmark_hits(numbered, benchmark, **options)
    return drop_rows(numbered, saved(hits.filter(F.size("spans") > 0).select(ROW), "contaminated"))


def items_digest(items: list[str]) -> str:
    """What ``items_sha256`` holds, for tests and other readers."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
