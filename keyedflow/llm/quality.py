"""Quality of documents, scored by gradient-boosted trees over statistics of their whole texts.

The trees are grown on histograms: each statistic is cut into bins once, and a split is the best boundary of the
summed gradients per bin. A grown model is a few flat arrays, in which a batch of documents steps from node to
node together.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyedflow.llm.common import release, ship_package, text_of


@dataclass(frozen=True)
class QualitySpec:
    """``sample_rows`` bounds the labelled documents of each class that a model is fitted on."""

    sample_rows: int = 10_000
    trees: int = 80
    depth: int = 4
    bins: int = 64
    rate: float = 0.15
    penalty: float = 1.0
    smallest_leaf: float = 5.0
    threshold: float = 0.7


# --- statistics of a text -------------------------------------------------------------------------

#: Characters of a block. Shares of distinct words and the like are taken within blocks, so that they mean the
#: same for short and long texts and need bounded memory.
BLOCK = 1 << 15

STATISTICS = (
    "characters",
    "words",
    "word_length",
    "longest_word",
    "letters",
    "capitals",
    "digits",
    "white_space",
    "sentence_marks",
    "other_marks",
    "commonest_mark",
    "not_ascii",
    "byte_entropy",
    "compressed",
    "distinct_words",
    "commonest_word",
    "distinct_triples",
    "repeated_lines",
    "line_length",
    "lines_ending_sentences",
    "words_ending_in_marks",
    "words_of_marks",
    "one_letter_words",
    "words_in_capitals",
    "sentence_length",
)

_KIND = {
    "letters": b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": b"0123456789",
    "white_space": b" \t\n\r\f\v",
    "sentence_marks": b".,;:?!'\"()-",
}
KINDS = {name: np.isin(np.arange(256), list(members)) for name, members in _KIND.items()}
HIGH = np.arange(256) >= 0x80
MARKS = (np.arange(256) > 0x20) & ~HIGH & ~KINDS["letters"] & ~KINDS["digits"]
OTHER_MARKS = MARKS & ~KINDS["sentence_marks"]
STOPS = (".", "!", "?")


def _blocks(text: str) -> Iterator[str]:
    """The text in blocks that end between words where there is a gap near."""
    begin = 0
    while begin < len(text):
        end = begin + BLOCK
        if end < len(text):
            gap = text.find(" ", end, end + BLOCK)
            end = gap if gap >= 0 else end
        yield text[begin:end]
        begin = end


def statistics(text: str) -> list[float]:
    """The values of ``STATISTICS`` for one text; all zero for an empty one."""
    if not text:
        return [0.0] * len(STATISTICS)
    counts = np.zeros(256, np.int64)
    size = packed = words = length = longest = distinct = commonest = triples = distinct_triples = 0
    ending = marks = single = capital = 0
    lines = repeated = closed = 0
    for block in _blocks(text):
        data = block.encode("utf-8", "surrogatepass")
        counts += np.bincount(np.frombuffer(data, np.uint8), minlength=256)
        size += len(data)
        packed += len(zlib.compress(data, 1))
        found = block.split()
        words += len(found)
        if found:
            sizes = [len(w) for w in found]
            length += sum(sizes)
            longest = max(longest, *sizes)
            folded = [w.lower() for w in found]
            tally = Counter(folded)
            distinct += len(tally)
            commonest += max(tally.values())
            triples += max(0, len(folded) - 2)
            distinct_triples += len(set(zip(folded, folded[1:], folded[2:])))
            ending += sum(not w[-1].isalnum() and w[-1] not in ".,;:" for w in found)
            marks += sum(not w[0].isalnum() and not w[-1].isalnum() for w in found)
            single += sizes.count(1)
            capital += sum(n > 1 and w.isupper() for w, n in zip(found, sizes))
        parts = [line for line in block.split("\n") if line.strip()]
        lines += len(parts)
        repeated += len(parts) - len(set(parts))
        closed += sum(line.rstrip().endswith(STOPS) for line in parts)

    def share(part: float, whole: float) -> float:
        return float(part) / whole if whole else 0.0

    filled = counts[counts > 0] / size
    letters = counts[KINDS["letters"]].sum()
    stops = sum(counts[ord(c)] for c in STOPS)
    return [
        float(np.log1p(len(text))),
        float(np.log1p(words)),
        share(length, words),
        float(np.log1p(longest)),
        share(letters + counts[HIGH].sum(), size),
        share(counts[KINDS["capitals"]].sum(), letters),
        share(counts[KINDS["digits"]].sum(), size),
        share(counts[KINDS["white_space"]].sum(), size),
        share(counts[KINDS["sentence_marks"]].sum(), size),
        share(counts[OTHER_MARKS].sum(), size),
        share(counts[MARKS].max(), size),
        share(counts[HIGH].sum(), size),
        float(-(filled * np.log2(filled)).sum()),
        share(packed, size),
        share(distinct, words),
        share(commonest, words),
        share(distinct_triples, triples),
        share(repeated, lines),
        float(np.log1p(share(len(text), lines))),
        share(closed, lines),
        share(ending, words),
        share(marks, words),
        share(single, words),
        share(capital, words),
        float(np.log1p(share(words, stops + 1))),
    ]


def matrix(texts: pa.Array) -> np.ndarray:
    """Statistics of many texts, a row each."""
    rows = [statistics(t.as_py()) for t in texts]
    return np.array(rows, np.float64).reshape(len(rows), len(STATISTICS))


# --- trees ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Forest:
    """All trees in flat arrays. A leaf is its own successor on both sides, so steps past it change nothing."""

    base: float
    depth: int
    roots: np.ndarray
    feature: np.ndarray
    bound: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of class 1 for every row; all rows go through all trees side by side."""
        at = np.broadcast_to(self.roots, (len(rows), len(self.roots)))
        each = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            below = rows[each, self.feature[at]] <= self.bound[at]
            at = np.where(below, self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(axis=1))))


def bin_bounds(column: np.ndarray, bins: int) -> np.ndarray:
    """Boundaries between bins of about equally many rows, halfway between neighbouring values."""
    values = np.unique(column)
    if len(values) > bins:
        values = np.unique(np.quantile(column, np.linspace(0, 1, bins), method="nearest"))
    return (values[1:] + values[:-1]) / 2


def grow_forest(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray, spec: QualitySpec = QualitySpec()) -> Forest:
    """Trees fitted to the weighted logistic loss, level by level, each on what the earlier ones leave."""
    count, features = rows.shape
    bounds = [bin_bounds(rows[:, f], spec.bins) for f in range(features)]
    binned = np.column_stack([np.searchsorted(b, rows[:, f]) for f, b in enumerate(bounds)])
    cells = binned + np.arange(features) * spec.bins
    prior = np.clip((weights * labels).sum() / weights.sum(), 1e-6, 1 - 1e-6)
    base = float(np.log(prior / (1 - prior)))
    margin = np.full(count, base)
    feature, bound, left, right, value, roots = [], [], [], [], [], []

    def new_node() -> int:
        node = len(feature)
        for array, start in ((feature, 0), (bound, 0.0), (left, node), (right, node), (value, 0.0)):
            array.append(start)
        return node

    for _ in range(spec.trees):
        chance = 1 / (1 + np.exp(-margin))
        gradient, curvature = weights * (chance - labels), weights * chance * (1 - chance)
        roots.append(new_node())
        # Per open node its rows; a level's nodes split one after the other, each on its own histogram.
        level = [(roots[-1], np.arange(count))]
        for depth in range(spec.depth + 1):
            following = []
            for node, members in level:
                g, h = gradient[members].sum(), curvature[members].sum()
                split = None
                if depth < spec.depth and len(members) >= 2 * spec.smallest_leaf:
                    split = best_split(cells[members], gradient[members], curvature[members], features, spec)
                if split is None:
                    value[node] = -spec.rate * g / (h + spec.penalty)
                    margin[members] += value[node]
                    continue
                f, b = split
                below = binned[members, f] <= b
                feature[node], bound[node] = f, bounds[f][b]
                left[node], right[node] = new_node(), new_node()
                following += [(left[node], members[below]), (right[node], members[~below])]
            level = following
    arrays = [np.array(a) for a in (roots, feature, bound, left, right, value)]
    return Forest(base, spec.depth, *arrays)


def best_split(cells, gradient, curvature, features: int, spec: QualitySpec) -> tuple[int, int] | None:
    """Feature and bin after which to split a node's rows, from their histograms; none without a gain."""
    shape = (features, spec.bins)
    flat = cells.ravel()
    held = np.bincount(flat, minlength=features * spec.bins).reshape(shape).cumsum(axis=1)
    g = np.bincount(flat, np.repeat(gradient, features), features * spec.bins).reshape(shape).cumsum(axis=1)
    h = np.bincount(flat, np.repeat(curvature, features), features * spec.bins).reshape(shape).cumsum(axis=1)
    total_g, total_h, total = g[:, -1:], h[:, -1:], held[:, -1:]
    gain = g**2 / (h + spec.penalty) + (total_g - g) ** 2 / (total_h - h + spec.penalty)
    gain -= total_g**2 / (total_h + spec.penalty)
    gain[(held < spec.smallest_leaf) | (total - held < spec.smallest_leaf)] = 0.0
    best = int(gain.argmax())
    return divmod(best, spec.bins) if gain.flat[best] > 1e-9 else None


# --- fitting and scoring on tables ---------------------------------------------------------------


def held_out(id_column: str) -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 4 == 2, F.lit(False))


def labelled_sample(labels: DataFrame, spec: QualitySpec, id_column: str, label_column: str) -> tuple[DataFrame, dict]:
    """At most ``sample_rows`` identifiers of each class, those of the smallest hashes, and the sizes of the classes.

    An identifier with both labels is left out, as is one without a label.
    """
    learned = labels.filter(F.col(id_column).isNotNull() & F.col(label_column).isin(0, 1) & ~held_out(id_column))
    each = learned.groupBy(F.col(id_column).alias("_id")).agg(
        F.min(label_column).alias("_label"), F.max(label_column).alias("_other")
    )
    clear = each.filter("_label = _other").select("_id", F.col("_label").cast("int").alias("_label"))
    sizes = {r["_label"]: r["n"] for r in clear.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_hash = [F.xxhash64("_id"), F.col("_id")]
    samples = [clear.filter(F.col("_label") == c).orderBy(*by_hash).limit(spec.sample_rows) for c in (0, 1)]
    return samples[0].unionByName(samples[1]), sizes


def fit(docs: DataFrame, labels: DataFrame, spec: QualitySpec, id_column: str, text_column: str, label_column: str) -> Forest | None:
    """The model of the labelled documents that may be learned from; none where there are none.

    Rows of the sample count so that the classes weigh as much as they do among all labelled rows. Of several
    documents with one identifier the one with the greatest statistics counts, so that copies add nothing.
    """
    sample, sizes = labelled_sample(labels, spec, id_column, label_column)
    # At most twice sample_rows rows of two numbers, whatever the tables hold.
    texts = docs.select(F.col(id_column).alias("_id"), text_of(text_column).alias("_text"))
    chosen = texts.join(F.broadcast(sample), "_id")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = matrix(batch["_text"])
            lists = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), len(STATISTICS))
            yield pa.record_batch(
                {"_label": batch["_label"], "_id": batch["_id"], "values": lists.cast(pa.list_(pa.float64()))}
            )

    kind = docs.schema[id_column].dataType.simpleString()
    rows = chosen.mapInArrow(lambda b: release(measured(b)), f"_label int, _id {kind}, values array<double>")
    learned = rows.groupBy("_label", "_id").agg(F.max("values").alias("values")).orderBy("_label", "_id").toArrow()
    if not learned.num_rows:
        return None
    values = np.array(learned["values"].to_pylist(), np.float64)
    answers = np.array(learned["_label"].to_pylist(), np.float64)
    found = {c: max(1, int((answers == c).sum())) for c in (0, 1)}
    weights = np.where(answers == 1, sizes.get(1, 0) / found[1], sizes.get(0, 0) / found[0])
    return grow_forest(values, answers, weights * len(answers) / weights.sum(), spec)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    spec: QualitySpec = QualitySpec(),
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> DataFrame:
    """Per document: the identifier, ``held_out``, ``score`` (0 to 1) and ``predicted`` (score at or above the threshold).

    Scores depend on the text alone: repeated texts score alike. Null texts count as empty and are scored as
    such. Null identifiers are scored and never learned from. Without labels to learn from the score is 0.5;
    with one class only it is near that class. An empty table gives no rows; other columns are not read.
    """
    ship_package(docs.sparkSession)
    forest = fit(docs, labels, spec, id_column, text_column, label_column)
    kind = docs.schema[id_column].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = forest.score(matrix(batch["_text"])) if forest else np.full(batch.num_rows, 0.5)
            yield pa.record_batch(
                {
                    "_id": batch["_id"],
                    "held_out": batch["_held_out"],
                    "score": score,
                    "predicted": (score >= spec.threshold).astype(np.int32),
                }
            )

    narrow = docs.select(
        F.col(id_column).alias("_id"), held_out(id_column).alias("_held_out"), text_of(text_column).alias("_text")
    )
    schema = f"_id {kind}, held_out boolean, score double, predicted int"
    return narrow.mapInArrow(lambda b: release(scored(b)), schema).withColumnRenamed("_id", id_column)
