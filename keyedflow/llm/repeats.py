"""Removal of passages that an earlier document holds, by suffix arrays over the shared parts of the corpus.

Every string of ``length`` bytes is named by an anchor: the short gram of smallest hash in it. Equal strings
have equal anchors, so documents meet in buckets of anchors, and only anchors of two or more documents go on.
Neighbouring strings with one anchor are one fragment. A fragment that a smaller identifier has as well goes
whole; each task settles that among its own texts first, so that a passage of very many documents sends one
entry a task, not one a document. Of what is left, fragments of one anchor that differ are fetched, stripped of
what no other fragment has, and put in order by a suffix array (linear grouping); equal strings are then
neighbours, and each class of them belongs to its earliest document. Copies of whole texts count once, before
anything is exchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyedflow.llm.common import ROW, freed, ship_package, stored, text_of, with_row_key
from keyedflow.llm.suffix import suffix_array

LENGTH, GRAM = 50, 16
#: Bytes of text that are hashed at once, which keep to a processor's cache, and the longest single stretch.
HASH_BYTES, STRETCH = 1 << 17, 1 << 23
#: Anchors that a task holds before it sends them on.
HELD_ANCHORS = 1 << 20
#: Bytes of text whose anchors share a bucket, which one task holds at a time, and fewest buckets a shuffle partition.
BUCKET_BYTES, BUCKETS_PER_PARTITION = 8 << 20, 2
#: Bytes of text in one suffix array; fragments that share a string are never in two.
BLOCK_BYTES = 1 << 17
#: Stands for the identifier of rows without one, which counts as larger than all.
NO_ID = np.iinfo(np.int64).max

POSITION = np.uint64((1 << 24) - 1)
_RANDOM = np.random.Generator(np.random.PCG64(2024))
BYTE_VALUES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
MIX = _RANDOM.integers(1, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    found = np.full(n, base, np.uint64)
    found[:1] = 1
    return np.cumprod(found, dtype=np.uint64)


class Hashes:
    """Hashes of any stretch of a byte sequence, from sums of weighted byte values modulo 2**64."""

    def __init__(self, data: np.ndarray):
        self.sums = np.concatenate(
            (np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[data] * powers(BASE, len(data)), dtype=np.uint64))
        )
        self.back = powers(BASE_INVERSE, len(data) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.back[start]
        h ^= h >> np.uint64(32)
        h *= MIX[7]
        return h ^ (h >> np.uint64(29))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from every position on, built by doubling."""
    h, size, step = BYTE_VALUES[data], 1, 0
    while size < gram:
        more = min(size, gram - size)
        h = h[:-more] * MIX[step % 6] + h[more:]
        h ^= h >> np.uint64(31)
        size, step = size + more, step + 1
    h *= MIX[6]
    return h ^ (h >> np.uint64(29))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size < width:
        more = min(size, width - size)
        values = np.minimum(values[:-more], values[more:])
        size += more
    return values


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Fragments of texts: text, first string start, number of string starts, anchor hash, fragment hash."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    grams = gram_hashes(data, gram)
    packed = (grams & ~POSITION) | np.arange(len(grams), dtype=np.uint64)
    place = (sliding_minimum(packed, length - gram + 1) & POSITION).astype(np.int64)
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(place)]
    # A string that would run over the end of its text is none.
    whole = np.arange(len(place)) + length <= (begins + sizes)[owner]
    first = whole.copy()
    first[1:] &= (place[1:] != place[:-1]) | (owner[1:] != owner[:-1]) | ~whole[:-1]
    starts = np.flatnonzero(first)
    counts = np.add.reduceat(whole, starts).astype(np.int64) if len(starts) else starts
    fragments = Hashes(data).of(starts, starts + counts + length - 1)
    return owner[starts], starts - begins[owner[starts]], counts, grams[place[starts]], fragments


ENTRY = ("gram", "<u4"), ("fragment", "<u8"), ("id", "<i8"), ("row", "<i8"), ("start", "<i8"), ("count", "u1")


#: Ranges of string starts that a task knows to be repeats.
RANGE = ("row", "<i8"), ("start", "<i8"), ("stop", "<i8")


def pack_columns(columns: dict[str, np.ndarray], layout: tuple = ENTRY) -> bytes:
    """Columns byte by byte, so that bytes which hardly change stand together and compress."""
    planes = [np.ascontiguousarray(columns[n].astype(t).reshape(-1, 1).view(np.uint8).T) for n, t in layout]
    return b"".join(p.tobytes() for p in planes)


def unpack_columns(data: bytes, layout: tuple = ENTRY) -> dict[str, np.ndarray]:
    width = sum(np.dtype(t).itemsize for _, t in layout)
    n, at, found = len(data) // width, 0, {}
    for name, kind in layout:
        item = np.dtype(kind).itemsize
        plane = np.frombuffer(data, np.uint8, n * item, at).reshape(item, n)
        found[name] = np.ascontiguousarray(plane.T).view(kind).ravel()
        at += n * item
    return found


SENT = pa.schema([("bucket", pa.int64()), ("entries", pa.binary()), ("ranges", pa.binary())])


def starts_of(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins in sorted columns."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    change = np.ones(len(columns[0]), bool)
    change[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(change)


def after_first(ids: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Whether an identifier is larger than the first of its run, runs being in order of identifiers."""
    return ids > np.repeat(ids[runs], np.diff(np.append(runs, len(ids))))


def merged_ranges(row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> dict[str, np.ndarray]:
    """Ranges in order of rows, those that meet as one. Ranges of a row don't overlap."""
    order = np.lexsort((start, row))
    row, start, stop = row[order], start[order], stop[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (start[1:] != stop[:-1])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(row))[: len(first)] - 1
    return {"row": row[first], "start": start[first], "stop": stop[last]}


class AnchorTask:
    """Anchors of a task's texts, each distinct text once, sent on by bucket."""

    def __init__(self, buckets: int, length: int):
        self.buckets, self.length = buckets, length
        self.seen: set[bytes] = set()
        self.texts: list[bytes] = []
        self.rows: list[tuple[int, int, int]] = []  # row, identifier, start of the stretch
        self.size, self.held = 0, 0
        self.columns: list[dict[str, np.ndarray]] = []

    def add(self, row: int, doc_id: int, text: bytes) -> Iterator[pa.RecordBatch]:
        if len(text) < self.length:
            return
        digest = hashlib.blake2b(text, digest_size=16).digest()
        if digest in self.seen:
            return  # rows come in ascending order of identifiers, so the first copy is the earliest
        self.seen.add(digest)
        for start in range(0, max(1, len(text) - self.length + 1), STRETCH):
            self.texts.append(text[start : start + STRETCH + self.length - 1])
            self.rows.append((row, doc_id, start))
            self.size += len(self.texts[-1])
            if self.size >= HASH_BYTES:
                yield from self.hash()

    def hash(self) -> Iterator[pa.RecordBatch]:
        if self.texts:
            text, start, count, gram, fragment = anchors(self.texts, self.length)
            rows = np.array(self.rows, np.int64)[text].reshape(-1, 3)
            self.columns.append(
                {"hash": gram, "fragment": fragment, "id": rows[:, 1], "row": rows[:, 0], "start": start + rows[:, 2], "count": count}
            )
            self.held += len(gram)
            self.texts, self.rows, self.size = [], [], 0
        if self.held >= HELD_ANCHORS:
            yield self.flush()

    def flush(self) -> pa.RecordBatch:
        if not self.columns:
            return pa.record_batch([pa.array([], t) for t in SENT.types], schema=SENT)
        columns = {n: np.concatenate([c[n] for c in self.columns]) for n in self.columns[0]}
        self.columns, self.held = [], 0
        columns["bucket"] = (columns["hash"] % np.uint64(self.buckets)).astype(np.int64)
        columns["gram"] = columns.pop("hash") >> np.uint64(32)
        order = np.lexsort((columns["id"], columns["fragment"], columns["gram"], columns["bucket"]))
        columns = {n: c[order] for n, c in columns.items()}
        later = after_first(columns["id"], starts_of(columns["bucket"], columns["gram"], columns["fragment"]))
        gone = merged_ranges(columns["row"][later], columns["start"][later], (columns["start"] + columns["count"])[later])
        columns = {n: c[~later] for n, c in columns.items()}
        bucket = columns.pop("bucket")
        cuts = starts_of(bucket)
        ends = np.append(cuts[1:], len(bucket))
        blobs = [pack_columns({n: c[s:e] for n, c in columns.items()}) for s, e in zip(cuts, ends, strict=True)]
        # The settled ranges travel with the entries, in equal shares.
        shares = np.linspace(0, len(gone["row"]), len(blobs) + 1).astype(np.int64)
        ranges = [pack_columns({n: c[s:e] for n, c in gone.items()}, RANGE) for s, e in zip(shares, shares[1:], strict=False)]
        return pa.record_batch([pa.array(bucket[cuts], pa.int64()), pa.array(blobs, pa.binary()), pa.array(ranges, pa.binary())], schema=SENT)


def anchor_maker(buckets: int, length: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = AnchorTask(buckets, length)
        for batch in batches:
            ids = batch["id"].fill_null(NO_ID).to_pylist()
            for row, doc_id, text in zip(batch[ROW].to_pylist(), ids, batch["text"], strict=True):
                yield from task.add(row, doc_id, text.as_py())
        yield from task.hash()
        yield task.flush()

    return make


#: Kind 0: string starts from ``start`` to ``stop`` of a row are removed. Kind 1: an occurrence of a fragment.
#: Kind 2: the occurrence whose text is to be fetched for that fragment.
SHARED = "kind int, bucket long, anchor long, fragment long, id long, row long, start long, stop long"
_SHARED_NAMES = [c.split()[0] for c in SHARED.split(", ")]


def shared_table(kind: int, bucket: int, **columns: np.ndarray) -> pa.Table:
    n = len(columns["row"])
    zero = np.zeros(n, np.int64)
    found = {"kind": np.full(n, kind, np.int32), "bucket": np.full(n, bucket, np.int64)}
    found |= {name: np.asarray(columns.get(name, zero), np.int64) for name in _SHARED_NAMES[2:]}
    return pa.table(found)


def share(key: tuple, blobs: pa.Table) -> pa.Table:
    """What the documents of a bucket have in common."""
    bucket = key[0].as_py()
    settled = [unpack_columns(b.as_py(), RANGE) for b in blobs["ranges"]]
    settled = {n: np.concatenate([p[n] for p in settled]) for n, _ in RANGE}
    parts = [unpack_columns(b.as_py()) for b in blobs["entries"]]
    c = {n: np.concatenate([p[n] for p in parts]) for n, _ in ENTRY}
    order = np.lexsort((c["row"], c["id"], c["fragment"], c["gram"]))
    c = {n: v[order] for n, v in c.items()}
    groups = starts_of(c["gram"])
    sizes = np.diff(np.append(groups, len(c["gram"])))
    shared = np.minimum.reduceat(c["id"], groups) != np.maximum.reduceat(c["id"], groups)
    keep = np.repeat(shared, sizes)
    c = {n: v[keep] for n, v in c.items()}
    stop = c["start"] + c["count"]
    # A fragment that a smaller identifier has goes whole, whatever else the anchor has.
    fragments = starts_of(c["gram"], c["fragment"])
    later = after_first(c["id"], fragments)
    ranges = {n: np.concatenate((settled[n], v[later])) for n, v in (("row", c["row"]), ("start", c["start"]), ("stop", stop))}
    gone = shared_table(0, bucket, **merged_ranges(**ranges))
    groups = starts_of(c["gram"])
    sizes = np.diff(np.append(groups, len(c["gram"])))
    anchor = np.repeat(np.arange(len(groups)), sizes)
    number = np.repeat(np.arange(len(fragments)), np.diff(np.append(fragments, len(anchor))))
    alike = np.repeat(number[groups] == number[np.append(groups[1:], len(anchor))[: len(groups)] - 1], sizes)
    rest = np.flatnonzero(~alike & ~later)
    first = fragments[~alike[fragments]]
    entry = lambda i: {"anchor": anchor[i], "fragment": number[i], "id": c["id"][i], "row": c["row"][i], "start": c["start"][i], "stop": stop[i]}
    return pa.concat_tables([gone, shared_table(1, bucket, **entry(rest)), shared_table(2, bucket, **entry(first))])


def string_classes(pieces: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Strings of ``length`` bytes in the pieces, in suffix order: piece and start, a class of equals at a time, packed.

    Yields arrays: the places of all strings as (piece, start) rows in suffix order, and the first of each class.
    """
    sizes = np.array([len(p) for p in pieces])
    begins = np.cumsum(sizes + 1) - sizes - 1
    text = np.frombuffer(b"\x00".join(pieces) + b"\x00", np.uint8)
    symbols = text.astype(np.int64) + 2
    symbols[begins + sizes] = 1  # between pieces
    order = np.array(suffix_array([*symbols.tolist(), 0]))
    piece = np.searchsorted(begins, order, side="right") - 1
    inside = order + length <= (begins + sizes)[piece]
    order, piece = order[inside], piece[inside]
    strings = np.lib.stride_tricks.sliding_window_view(text, length)[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (strings[1:] != strings[:-1]).any(axis=1)
    yield np.stack([piece, order - begins[piece]], axis=1), np.flatnonzero(fresh)


def joined(first: np.ndarray, second: np.ndarray, size: int) -> np.ndarray:
    """The smallest member of each of ``size`` elements' set after joining pairs."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[first], label[second])
        new = label.copy()
        np.minimum.at(new, first, low)
        np.minimum.at(new, second, low)
        np.minimum.at(new, label[first], low)
        np.minimum.at(new, label[second], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def earliest(anchor: np.ndarray, texts: list[bytes], owner: np.ndarray, length: int) -> list[np.ndarray]:
    """For every string of every fragment the smallest identifier of a document that holds it.

    ``owner`` has the smallest identifier of each whole fragment. Strings that no second fragment of the anchor
    has, by their hashes, are left out of the suffix arrays, and so are repeats of what remains of a fragment.
    """
    sizes = np.array([len(t) for t in texts])
    counts = sizes - length + 1
    ends = np.cumsum(counts)
    fragment = np.repeat(np.arange(len(texts)), counts)
    offset = np.arange(len(fragment)) - np.repeat(ends - counts, counts)
    begins = np.cumsum(sizes) - sizes
    at = begins[fragment] + offset
    hashes = Hashes(np.frombuffer(b"".join(texts), np.uint8)).of(at, at + length)
    best = owner[fragment].copy()
    order = np.lexsort((fragment, hashes, anchor[fragment]))
    a, h, f = anchor[fragment][order], hashes[order], fragment[order]
    runs = starts_of(a, h)
    lengths = np.diff(np.append(runs, len(order)))
    several = np.repeat(f[runs] != f[np.append(runs[1:], len(order)) - 1], lengths)
    common = np.zeros(len(order), bool)
    common[order[several]] = True
    # Stretches of common strings, each a piece of its fragment; equal pieces of an anchor are one.
    edge = common.copy()
    edge[1:] &= ~common[:-1] | (fragment[1:] != fragment[:-1])
    firsts = np.flatnonzero(edge)
    if not len(firsts):
        return np.split(best, ends[:-1])
    spans = np.add.reduceat(common, firsts)
    known: dict[tuple[int, bytes], int] = {}
    numbers = np.empty(len(firsts), np.int64)
    pieces: list[bytes] = []
    for i, (s, n) in enumerate(zip(firsts.tolist(), spans.tolist(), strict=True)):
        f0, o = int(fragment[s]), int(offset[s])
        piece = texts[f0][o : o + n + length - 1]
        numbers[i] = known.setdefault((int(anchor[f0]), piece), len(known))
        if numbers[i] == len(pieces):
            pieces.append(piece)
    # Pieces that share a string, directly or over others, go into one suffix array.
    place = np.repeat(numbers, spans)  # piece of every common string
    index = np.flatnonzero(common)
    by = np.lexsort((place, hashes[index], anchor[fragment[index]]))
    a, h, p = anchor[fragment[index]][by], hashes[index][by], place[by]
    same = (a[1:] == a[:-1]) & (h[1:] == h[:-1])
    cluster = joined(p[1:][same], p[:-1][same], len(pieces))
    # The smallest identifier of each string of a piece: over its fragments first, then over equal strings.
    piece_sizes = np.array([len(x) - length + 1 for x in pieces])
    piece_begins = np.cumsum(piece_sizes) - piece_sizes
    least = np.full(int(piece_sizes.sum()), NO_ID)
    inner = np.arange(len(place)) - np.repeat(np.cumsum(spans) - spans, spans)
    slots = piece_begins[place] + inner
    np.minimum.at(least, slots, best[index])
    for block in blocks_of(cluster, pieces):
        for found, classes in string_classes([pieces[i] for i in block], length):
            where = piece_begins[np.array(block)[found[:, 0]]] + found[:, 1]
            minima = np.minimum.reduceat(least[where], classes)
            least[where] = np.repeat(minima, np.diff(np.append(classes, len(where))))
    best[index] = np.minimum(best[index], least[slots])
    return np.split(best, ends[:-1])


def blocks_of(cluster: np.ndarray, pieces: list[bytes]) -> Iterator[list[int]]:
    """Pieces in blocks of about ``BLOCK_BYTES``, clusters kept whole."""
    block: list[int] = []
    size, last = 0, -1
    for i in np.argsort(cluster, kind="stable").tolist():
        if size >= BLOCK_BYTES and cluster[i] != last:
            yield block
            block, size = [], 0
        block.append(i)
        size += len(pieces[i]) + 1
        last = cluster[i]
    if block:
        yield block


def resolver(length: int):
    def resolve(key: tuple, occurrences: pa.Table, texts: pa.Table) -> pa.Table:
        """Removed string starts of the occurrences of a bucket's differing fragments."""
        names = texts["of_fragment"].to_numpy()
        order = np.argsort(names, kind="stable")
        names = names[order]
        anchor = texts["of_anchor"].to_numpy()[order]
        contents = [texts["content"][int(i)].as_py() for i in order]
        c = {n: occurrences[n].to_numpy() for n in ("fragment", "id", "row", "start")}
        place = np.searchsorted(names, c["fragment"])
        owner = np.full(len(names), NO_ID)
        np.minimum.at(owner, place, c["id"])
        best = earliest(anchor, contents, owner, length) if len(names) else []
        # Runs of strings with one earliest document, fragment by fragment.
        run_of, run_id, run_from, run_to = [], [], [], []
        for i, ids in enumerate(best):
            cuts = starts_of(ids)
            run_of.append(np.full(len(cuts), i))
            run_id.append(ids[cuts])
            run_from.append(cuts)
            run_to.append(np.append(cuts[1:], len(ids)))
        if not run_of or not len(place):
            return removed_table(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        run_of, run_id, run_from, run_to = (np.concatenate(x) for x in (run_of, run_id, run_from, run_to))
        per = np.bincount(run_of, minlength=len(names))
        first = np.cumsum(per) - per
        copies = per[place]
        who = np.repeat(np.arange(len(place)), copies)
        run = np.arange(len(who)) - np.repeat(np.cumsum(copies) - copies, copies) + first[place[who]]
        gone = run_id[run] < c["id"][who]
        who, run = who[gone], run[gone]
        return removed_table(c["row"][who], c["start"][who] + run_from[run], c["start"][who] + run_to[run])

    return resolve


REMOVED = f"{ROW} long, start long, stop long"


def removed_table(row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.Table:
    return pa.table({ROW: row.astype(np.int64), "start": start.astype(np.int64), "stop": stop.astype(np.int64)})


def cover(starts: np.ndarray, stops: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by strings that start in the given ranges."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], stops[order] + length - 1
    reach = np.maximum.accumulate(stops)
    cuts = np.flatnonzero(np.concatenate(([True], starts[1:] > reach[:-1])))
    return list(zip(starts[cuts].tolist(), reach[np.append(cuts[1:], len(starts)) - 1].tolist(), strict=True))


CLEANED = f"{ROW} long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,stop:long>>"


def cleaner(length: int):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans_of, digests = [], [], []
            for text, ranges in zip(batch["text"], batch["ranges"], strict=True):
                text = text.as_py()
                ranges = ranges.values
                spans = cover(ranges.field("start").to_numpy(), ranges.field("stop").to_numpy(), length)
                digest, at = hashlib.sha256(), 0
                for start, stop in spans:
                    digest.update(text[at:start])
                    at = stop
                digest.update(text[at:])
                removed.append(sum(stop - start for start, stop in spans))
                spans_of.append([{"start": s, "stop": e} for s, e in spans])
                digests.append(digest.hexdigest())
            yield pa.record_batch(
                {
                    ROW: batch[ROW],
                    "n_removed": pa.array(removed, pa.int64()),
                    "n_spans": pa.array([len(s) for s in spans_of], pa.int64()),
                    "kept_sha256": pa.array(digests, pa.string()),
                    "spans": pa.array(spans_of, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                }
            )

    return clean


def repeated_passages(
    rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH
) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``spans``.

    A byte is removed if a string of ``length`` bytes over it also starts in a row with a smaller identifier,
    judged on the input. Null texts are empty. Rows without an identifier count as later than all others; rows
    that share an identifier don't remove each other's text. Texts shorter than ``length`` keep all their
    bytes. An empty table gives no rows.
    """
    spark = rows.sparkSession
    ship_package(spark)
    slim = rows.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).cast("binary").alias("text"))
    numbered, numbered_path = stored(with_row_key(slim), "numbered-rows")
    keyed, keyed_path = stored(
        numbered.select(ROW, "id", F.sha2("text", 256).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes")),
        "text-digests",
    )
    earliest_row = F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", F.col(ROW).alias("row")))
    originals = keyed.groupBy("digest").agg(earliest_row.alias("first"))
    state = keyed.join(originals, "digest").select(
        ROW,
        "id",
        "digest",
        "n_bytes",
        F.col("first.row").alias("first_row"),
        # A copy of an earlier text goes whole, if it is long enough to hold a string.
        (F.col("first.id").isNotNull() & (F.col("id").isNull() | (F.col("id") > F.col("first.id"))) & (F.col("n_bytes") >= length)).alias("copy"),
    )
    state, _ = stored(state, "text-states")
    freed(spark, keyed_path)

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = state.filter(~F.col("copy")).agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(partitions * BUCKETS_PER_PARTITION, -(-size // BUCKET_BYTES))
    blobs = numbered.sortWithinPartitions(F.col("id").asc_nulls_last(), ROW).mapInArrow(
        anchor_maker(buckets, length), "bucket long, entries binary, ranges binary"
    )
    shared, shared_path = stored(blobs.groupBy("bucket").applyInArrow(share, SHARED), "shared-anchors")
    alike = shared.filter("kind = 0").select(F.col("row").alias(ROW), "start", "stop")
    wanted = shared.filter("kind = 2").select(
        F.col("row").alias(ROW),
        F.col("bucket").alias("of_bucket"),
        F.col("anchor").alias("of_anchor"),
        F.col("fragment").alias("of_fragment"),
        "start",
        "stop",
    )
    texts = numbered.select(ROW, "text")
    contents = texts.join(wanted, ROW).select(
        "of_bucket",
        "of_anchor",
        "of_fragment",
        F.substring("text", F.col("start").cast("int") + 1, (F.col("stop") - F.col("start")).cast("int") + length - 1).alias("content"),
    )
    differing, differing_path = stored(
        shared.filter("kind = 1")
        .select("bucket", "fragment", "id", "row", "start")
        .groupBy("bucket")
        .cogroup(contents.groupBy("of_bucket"))
        .applyInArrow(resolver(length), REMOVED),
        "differing-fragments",
    )
    ranges = alike.union(differing).groupBy(ROW).agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    cleaned, _ = stored(texts.join(ranges, ROW).mapInArrow(cleaner(length), CLEANED), "cleaned-texts")
    freed(spark, numbered_path, shared_path, differing_path)
    found = state.join(cleaned.withColumnRenamed(ROW, "first_row"), "first_row", "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop")))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        F.when(F.col("copy"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("copy"), none).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
        F.when(F.col("copy"), whole).otherwise(F.coalesce("spans", F.array().cast("array<struct<start:long,stop:long>>"))).alias("spans"),
    )
