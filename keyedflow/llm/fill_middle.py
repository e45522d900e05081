"""Fill-in-the-middle: documents cut in three and laid out so that a model learns to fill the gap.

Cuts fall between units of a text, which are letter runs and single other characters, or single characters.
Units, characters and bytes are three ways to count the same text. They differ only where one unit has several
bytes, so two of them are converted by a sparse index of just those places: position and excess bytes of each.
Between its entries both counts move in step, and a cut is a ``searchsorted`` and an addition. Plain ASCII has
no entries at all in the index of characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyedflow.llm.common import release, ship_package, text_of

PLAIN, PREFIX_FIRST, SUFFIX_FIRST = "plain", "psm", "spm"
WORDS, CHARACTERS = "words", "characters"

LETTER = np.zeros(256, bool)
LETTER[ord("A") : ord("Z") + 1] = LETTER[ord("a") : ord("z") + 1] = True


@dataclass(frozen=True)
class Layout:
    """Markers before prefix, suffix and middle, and how many of a hundred documents take which form.

    A marker starts with the same character as the others, which none holds a second time. So no marker can
    arise where a text without markers meets one, and the parts are found again exactly.
    """

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    transformed_percent: int = 90
    suffix_first_percent: int = 20
    seed: int = 1

    def __post_init__(self) -> None:
        first = {m[:1] for m in self.markers}
        distinct = all(a == b or not a.startswith(b) for a in self.markers for b in self.markers)
        if len(first) != 1 or "" in first or len(set(self.markers)) != 3 or not distinct:
            raise ValueError("markers must be three different texts that start alike, none the start of another")
        if any(m.count(m[0]) != 1 for m in self.markers):
            raise ValueError("the first character of a marker must not come again in it")

    @property
    def markers(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


class SparseIndex:
    """Places of a byte sequence where one unit has several bytes: their starts and excess bytes."""

    def __init__(self, inner: np.ndarray):
        """``inner`` marks the bytes that go on with the unit of the byte before them."""
        edges = np.flatnonzero(np.diff(inner, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        self.bytes = starts - 1
        self.excess = np.concatenate(([0], np.cumsum(ends - starts)))
        self.units = self.bytes - self.excess[:-1]
        self.count = len(inner) - int(self.excess[-1])

    def to_bytes(self, units: np.ndarray) -> np.ndarray:
        """Byte offsets of the starts of the given units."""
        return units + self.excess[np.searchsorted(self.units, units)]

    def to_units(self, offsets: np.ndarray) -> np.ndarray:
        """How many units lie before the given byte offsets, each the start of a unit."""
        return offsets - self.excess[np.searchsorted(self.bytes, offsets)]


def indexes(data: np.ndarray, unit: str) -> tuple[SparseIndex, SparseIndex]:
    """The index of characters and that of units of a UTF-8 text."""
    inside = (data & 0xC0) == 0x80
    characters = SparseIndex(inside)
    if unit == CHARACTERS:
        return characters, characters
    letters = LETTER[data]
    inside[1:] |= letters[1:] & letters[:-1]
    return characters, SparseIndex(inside)


def transform(text: bytes, draws: tuple[int, int, int, int], layout: Layout, unit: str) -> tuple:
    """Number of units, form, characters of prefix and middle (null if plain), and the laid-out text."""
    if not text:
        return 0, PLAIN, None, None, text
    characters, units = indexes(np.frombuffer(text, np.uint8), unit)
    first, second, kind, order = draws
    marked = any(m.encode() in text for m in layout.markers)
    if marked or kind % 100 >= layout.transformed_percent:
        return units.count, PLAIN, None, None, text
    cuts = np.sort(np.array([first % (units.count + 1), second % (units.count + 1)]))
    start, end = offsets = units.to_bytes(cuts)
    before, through = characters.to_units(offsets)
    prefix, suffix, middle = text[:start], text[end:], text[start:end]
    p, s, m = (marker.encode() for marker in layout.markers)
    if order % 100 < layout.suffix_first_percent:
        return units.count, SUFFIX_FIRST, before, through - before, b"".join((s, suffix, p, prefix, m, middle))
    return units.count, PREFIX_FIRST, before, through - before, b"".join((p, prefix, s, suffix, m, middle))


def draws(id_column: str, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers that seed and identifier determine; a null identifier counts as no text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"_h{i}") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, layout: Layout = Layout(), unit: str = WORDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per document: the identifier, ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``output`` is the whole text as laid out. The cuts depend on seed and identifier alone, so repeated rows
    come out alike, and a text never depends on its neighbours. Null texts count as empty. Empty texts and
    texts that hold a marker stay as they are, ``plain``, with null character counts. Cuts that coincide give
    an empty middle. An empty table gives no rows; other columns are neither read nor returned. No shuffle.
    """
    if unit not in (WORDS, CHARACTERS):
        raise ValueError(f"unknown unit {unit!r}")
    ship_package(docs.sparkSession)
    narrow = docs.select(
        F.col(id_column).alias("_id"), text_of(text_column).cast("binary").alias("_text"), *draws(id_column, layout.seed)
    )
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"

    def laid_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (t.as_py() for t in batch["_text"])
            drawn = zip(*(batch[f"_h{i}"].to_pylist() for i in range(4)), strict=True)
            rows = [transform(t, d, layout, unit) for t, d in zip(texts, drawn, strict=True)]
            n, form, before, middle, output = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.record_batch(
                {
                    "_id": batch["_id"],
                    "n": pa.array(n, pa.int64()),
                    "form": pa.array(form, pa.string()),
                    "prefix_chars": pa.array(before, pa.int64()),
                    "middle_chars": pa.array(middle, pa.int64()),
                    "output": pa.array(output, pa.string()),
                }
            )

    result = narrow.mapInArrow(lambda batches: release(laid_out(batches)), schema)
    return result.withColumnRenamed("_id", id_column)


def restored(output: Column, form: Column, layout: Layout = Layout()) -> Column:
    """The text that an output was made of."""
    pattern = "|".join(f"\\Q{m}\\E" for m in layout.markers)
    parts = F.split(output, pattern)
    return (
        F.when(form == PREFIX_FIRST, F.concat(parts[1], parts[3], parts[2]))
        .when(form == SUFFIX_FIRST, F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )
