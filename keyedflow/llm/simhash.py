"""Near duplicates by SimHash fingerprints and covering locality-sensitive hashing.

Bit ``i`` of a fingerprint gets a label ``m(i)``, one of the 15 non-zero vectors of four bits. Table ``v`` (one
per non-zero vector) compares the bits whose label has an odd inner product with ``v``. Any three labels lie
in a hyperplane, so for every set of three or fewer differing bits some ``v`` is orthogonal to all their
labels: the two fingerprints collide in that table. No pair within the radius is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyedflow.llm.common import ROW, drop_rows, numbered_once, release, saved, ship_package, with_row_key
from keyedflow.llm.components import components

SEED = 42
RADIUS = 3
VECTORS = range(1, 16)
#: Shingles whose bits are counted at once, which bounds memory for long texts.
SHINGLE_BLOCK = 1 << 16
#: Fingerprints of one bucket that are compared directly; a larger bucket is covered again on its free bits.
DIRECT = 4096
#: With so few free bits a bucket holds 4,096 distinct fingerprints at most and is compared whatever its size.
FEWEST_FREE = 12

BITS = [np.uint64(1 << i) for i in range(64)]


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of the shingles of a text; zero for a text without words."""
    words = text.lower().split()  # bytes: A-Z only, and the six ASCII white-space characters
    if not words:
        return 0
    width = min(shingle, len(words))
    total = len(words) - width + 1
    grams = map(b" ".join, zip(*(words[i : i + total] for i in range(width)), strict=True))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, total)
    ones = np.zeros(64, np.int64)
    for at in range(0, total, SHINGLE_BLOCK):
        block = hashes[at : at + SHINGLE_BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def fingerprinter(shingle: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in release(batches):
            texts = batch["text"].cast(pa.binary())
            prints = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts))
            yield pa.record_batch({ROW: batch[ROW], "id": batch["id"], "fp": pa.array(prints.view(np.int64))})

    return make


def fingerprints(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """Row key, ``id`` and 64-bit ``fp`` of every row of a numbered frame; null texts count as empty."""
    ship_package(rows.sparkSession)
    slim = rows.select(ROW, F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(fingerprinter(shingle), f"{ROW} long, id long, fp long")


def odd(label: int, vector: int) -> bool:
    return bin(label & vector).count("1") % 2 == 1


def covering_masks(free: int) -> dict[int, int]:
    """For every table vector the bits it compares, out of those set in ``free``."""
    bits = [i for i in range(64) if free >> i & 1]
    return {v: sum(1 << bit for j, bit in enumerate(bits) if odd(1 + j % 15, v)) for v in VECTORS}


def free_bits(path: list[int]) -> int:
    """Bits that no table on the path compares."""
    free = (1 << 64) - 1
    for vector in path:
        free &= ~covering_masks(free)[vector]
    return free


def signed(bits: int) -> int:
    return bits - (1 << 64) if bits >= 1 << 63 else bits


@lru_cache(maxsize=1 << 14)
def tables_below(path: str) -> tuple[list[str], np.ndarray]:
    """Names of the tables below a path, and the bits that members of their buckets share."""
    taken = [int(x) for x in path.split(".") if x]
    free = free_bits(taken)
    masks = covering_masks(free)
    shared = [(mask | ~free) & ((1 << 64) - 1) for mask in masks.values()]
    return [".".join(map(str, [*taken, v])) for v in masks], np.array(shared, np.uint64)


def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``path``, ``key``, ``fp``: each fingerprint in the tables below its path."""
    for batch in batches:
        paths = batch["path"].dictionary_encode()
        codes, prints = paths.indices.to_numpy(), batch["fp"].to_numpy().view(np.uint64)
        for code, path in enumerate(paths.dictionary.to_pylist()):
            names, shared = tables_below(path)
            mine = prints[codes == code]
            keys = (mine[:, None] & shared).ravel()
            yield pa.record_batch(
                {
                    "path": pa.DictionaryArray.from_arrays(np.tile(np.arange(len(names), dtype=np.int32), len(mine)), names).cast(pa.string()),
                    "key": pa.array(keys.view(np.int64)),
                    "fp": pa.array(np.repeat(mine, len(names)).view(np.int64)),
                }
            )


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def spanning_links(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join the members of one bucket as far as steps within the radius do; one fewer than members."""
    links, left = [], prints
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = popcount(left ^ at) <= radius
            if near.any():
                found = left[near]
                links.extend((int(at), int(x)) for x in found)
                frontier.extend(found)
                left = left[~near]
    return links


class Buckets:
    """Reads rows sorted by bucket; gives links, and the members of a bucket that is too large to compare."""

    def __init__(self, radius: int, direct: int):
        self.radius, self.direct = radius, direct
        self.name: tuple | None = None
        self.members: list[np.ndarray] = []
        self.held, self.large, self.may_grow = 0, False, True

    def close(self) -> Iterator[tuple]:
        if not self.large and self.held > 1:
            prints = np.concatenate(self.members).view(np.uint64)
            for a, b in spanning_links(prints, self.radius):
                yield ("", signed(a), signed(b))
        self.members, self.held, self.large = [], 0, False

    def add(self, name: tuple, prints: np.ndarray) -> Iterator[tuple]:
        if name != self.name:
            yield from self.close()
            self.name = name
            self.may_grow = bin(free_bits([int(x) for x in name[0].split(".")])).count("1") > FEWEST_FREE
        self.members.append(prints)
        self.held += len(prints)
        if self.large or (self.held > self.direct and self.may_grow):
            self.large = True
            for member in np.concatenate(self.members):
                yield (name[0], int(member), None)
            self.members = []


def linker(radius: int, direct: int):
    def rows(found: list[tuple]) -> pa.RecordBatch:
        path, a, b = zip(*found, strict=True) if found else ((), (), ())
        return pa.record_batch(
            {"path": pa.array(path, pa.string()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}
        )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(radius, direct)
        for batch in batches:
            if not batch.num_rows:
                continue
            prints = batch["fp"].to_numpy(zero_copy_only=False)
            keys = batch["key"].to_numpy(zero_copy_only=False)
            paths = batch["path"].dictionary_encode()
            codes, names = paths.indices.to_numpy(), paths.dictionary.to_pylist()
            starts = np.flatnonzero(
                np.concatenate(([True], (keys[1:] != keys[:-1]) | (codes[1:] != codes[:-1])))
            )
            ends = np.append(starts[1:], len(prints))
            found: list[tuple] = []
            last = len(starts) - 1
            sizes = ends - starts
            # Buckets of one that lie within the batch link nothing; the first and last may go on.
            for i in np.flatnonzero((sizes > 1) | (np.arange(last + 1) == 0) | (np.arange(last + 1) == last)):
                s, e = starts[i], ends[i]
                found.extend(buckets.add((names[codes[s]], int(keys[s])), prints[s:e]))
            yield rows(found)
        yield rows(list(buckets.close()))

    return link


def near_links(prints: DataFrame, radius: int = RADIUS, direct: int = DIRECT) -> DataFrame:
    """``a``, ``b``: links of distinct fingerprints ``fp``, at least one path of them for every near pair.

    Buckets of more than ``direct`` members are covered again on the bits their tables left free, twice at most:
    then so few bits are free that a bucket can't hold many. Nothing is capped or dropped.
    """
    spark = prints.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    links = None
    todo = prints.select(F.lit("").alias("path"), "fp")
    while True:
        buckets = todo.mapInArrow(deal, "path string, key long, fp long")
        buckets = buckets.repartition(parts, "path", "key").sortWithinPartitions("path", "key")
        found = saved(buckets.mapInArrow(linker(radius, direct), "path string, a long, b long"), "bucket-links")
        direct_links = found.filter(F.col("b").isNotNull()).select("a", "b")
        links = direct_links if links is None else links.union(direct_links)
        large = found.filter(F.col("b").isNull())
        if large.isEmpty():
            return links
        todo = large.select("path", F.col("a").alias("fp"))


def simhash_components(
    rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = RADIUS
) -> DataFrame:
    """Row key, ``id``, ``fp`` and ``component_id`` of every row of a numbered frame.

    ``component_id`` is the smallest identifier reachable over links of at most ``radius`` (3 or fewer)
    differing bits. Null and empty texts, and texts of white space, have fingerprint zero and are linked like
    any other. Rows without an identifier take part; a component of none but such rows has a null id. Equal
    fingerprints are one node, so copies cost one row each.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError("the tables cover a radius of 3 at most")
    prints = saved(fingerprints(rows, id_col, text_col, shingle), "fingerprints")
    nodes = saved(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    groups = components(near_links(nodes, radius))
    labelled = nodes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    labelled = saved(labelled, "labelled-fingerprints")
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    names = saved(labelled.join(least, "component").select("fp", "component", "component_id"), "component-names")
    return prints.join(names, "fp")


def simhash_duplicates(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``; see ``simhash_components``."""
    found = simhash_components(with_row_key(rows), id_col, text_col, shingle)
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """The input with one row of each component, the one with the smallest identifier (then row number)."""
    numbered = numbered_once(rows)
    found = simhash_components(numbered, id_col, text_col, shingle)
    order = F.struct(F.col("id").isNull().alias("unknown"), "id", ROW)
    keep = found.groupBy("component").agg(F.min(order).alias("keep")).select("component", F.col(f"keep.{ROW}").alias("keep"))
    dropped = found.join(keep, "component").filter(F.col(ROW) != F.col("keep"))
    return drop_rows(numbered, saved(dropped.select(ROW), "near-dropped"))
