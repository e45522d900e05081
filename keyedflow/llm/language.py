"""Language identification by cross-parsing entropy against suffix automata.

For each language a suffix automaton of labelled text holds every substring of that text. A document is parsed
into the longest phrases an automaton knows, one after another; the fewer phrases it takes, the more alike the
text is to the language. All documents of a batch are parsed side by side, one character of each per step.
"""

from __future__ import annotations

import sys
import warnings
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyedflow.llm.common import ROW, drop_rows, freed, numbered_once, release, saved, ship_package, stored, with_row_key

UNDETERMINED = "und"
#: Labelled text a model is fitted on: at most so many rows of a language, and characters taken of a row.
SAMPLE_ROWS, SAMPLE_ROW_CHARS = 256, 2_000
#: Symbols that the automata of one pass hold together, which bounds their tables, and languages of a pass: with
#: fewer languages each has more text, with more there are more passes over the documents.
MODEL_SYMBOLS, PASS_LANGUAGES = 160_000, 32
#: Letters with a symbol of their own; a rarer one is written as ``DIGITS`` digits to the base ``RADIX``.
LETTERS, RADIX, DIGITS = 61, 32, 4
#: Longer texts are parsed in blocks of so many symbols side by side, each from where the one before it ended.
BLOCK = 4_096
#: Characters of a batch that are laid side by side at once.
LANES_CHARS = 1 << 20
#: A text of so many symbols or more is of no known language if its phrases are hardly longer than those of random
#: letters (times this factor) and no language stands out by this score.
LEAST_SYMBOLS, CHANCE_FACTOR, LEAST_SCORE = 100, 1.25, 0.1
#: Marks a step that begins a new phrase.
MISS = np.int32(1 << 30)


class Automaton:
    """The suffix automaton of a sequence of symbols below ``width``, with a complete transition table.

    A step that leaves the automaton begins a new phrase: it goes where the symbol leads from the start, and
    is marked with ``MISS``.
    """

    def __init__(self, symbols: list[int], width: int):
        go: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for symbol in symbols:
            new = len(go)
            go.append({})
            length.append(length[last] + 1)
            link.append(0)
            state = last
            while state >= 0 and symbol not in go[state]:
                go[state][symbol] = new
                state = link[state]
            if state >= 0:
                target = go[state][symbol]
                if length[state] + 1 == length[target]:
                    link[new] = target
                else:
                    copy = len(go)
                    go.append(dict(go[target]))
                    length.append(length[state] + 1)
                    link.append(link[target])
                    while state >= 0 and go[state].get(symbol) == target:
                        go[state][symbol] = copy
                        state = link[state]
                    link[target] = link[new] = copy
            last = new
        # A symbol that the text does not hold is a phrase of its own: it leads where every step is a miss.
        root = np.array([go[0].get(s, len(go)) for s in range(width)], np.int32)
        table = np.tile(root | MISS, (len(go) + 1, 1))
        for state, targets in enumerate(go):
            for symbol, target in targets.items():
                table[state, symbol] = target
        self.width = width
        # States are numbered by the place of their row, which saves a multiplication per step.
        self.table = ((table & ~MISS) * width | (table & MISS)).ravel().astype(np.int32)

    def steps(self, columns: list[np.ndarray], states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases that end in every lane, and the states at its end, from those at its start.

        ``columns[i]`` has the i-th symbols of the lanes that are that long.
        """
        states, counts = states.copy(), np.zeros(len(states), np.int32)
        for column in columns:
            n = len(column)
            found = self.table[states[:n] + column]
            counts[:n] += found >> 30
            states[:n] = found & ~MISS
        return counts, states

    def phrases(self, lanes: list[np.ndarray], owners: np.ndarray) -> np.ndarray:
        """Phrases that end in each lane; a lane goes on where the lane before it of the same owner ended.

        All lanes start afresh first. Those whose predecessor ends elsewhere are parsed again from there, until
        nothing changes; mostly they end as before, since a parse soon falls into step with any other.
        """
        starts = np.zeros(len(lanes), np.int32)
        counts, ends = np.zeros(len(lanes), np.int32), np.zeros(len(lanes), np.int32)
        todo = np.arange(len(lanes))
        later = np.flatnonzero(owners[1:] == owners[:-1]) + 1
        while len(todo):
            order = todo[np.argsort([-len(lanes[i]) for i in todo], kind="stable")]
            counts[order], ends[order] = self.steps(columns_of([lanes[i] for i in order]), starts[order])
            todo = later[ends[later - 1] != starts[later]]
            starts[todo] = ends[todo - 1]
        return counts


def columns_of(lanes: list[np.ndarray]) -> list[np.ndarray]:
    """A column per step: symbols of all lanes that are so long, which are the first, as the longest come first."""
    lengths = np.array([len(x) for x in lanes])
    alive = np.searchsorted(-lengths, -np.arange(1, int(lengths.max()) + 1), side="right")
    flat = np.concatenate(lanes)
    begins = np.cumsum(lengths) - lengths
    return [flat[begins[:n] + i].astype(np.int32) for i, n in enumerate(alive)]


class Alphabet:
    """Symbols of lower-cased characters: letters of ``known`` have one, others digits, runs of all else share one."""

    def __init__(self, known: list[int]):
        self.known = known
        self.width = 1 + len(known) + RADIX

    def table(self) -> np.ndarray:
        """Symbol of every code point: 0 for no letter, ``RARE`` for letters that are written in digits."""
        points = np.arange(sys.maxunicode + 1)
        letter = np.fromiter((chr(p).isalpha() for p in points), bool, len(points))
        symbol = np.where(letter, RARE, 0).astype(np.uint8)
        for i, point in enumerate(self.known, 1):
            symbol[point] = i
        return symbol


RARE = 255


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


_SYMBOLS: dict[tuple, np.ndarray] = {}


class Model:
    """Automata of up to ``PASS_LANGUAGES`` languages over one alphabet."""

    def __init__(self, samples: dict[str, list[str]], known: list[int], languages: int):
        self.languages = sorted(samples)
        self.alphabet = Alphabet(known)
        self.automata: list[Automaton] = []
        symbols = self.symbols()
        share = symbols_of_each(languages)
        for language in self.languages:
            text = np.concatenate([self.squeezed(t, symbols) for t in samples[language]] or [np.zeros(0, np.uint8)])
            self.automata.append(Automaton(text[:share].tolist(), self.alphabet.width))
        self.chance = self.chance_length()

    def chance_length(self) -> float:
        """Mean length of the phrases that random letters take in the automaton that knows most of them."""
        letters = len(self.alphabet.known)
        if not self.automata or not letters:
            return 0.0
        random = np.random.Generator(np.random.PCG64(7)).integers(0, letters + 1, BLOCK, dtype=np.int32)
        return BLOCK / min(int(a.phrases([random], np.zeros(1, int))[0]) + 1 for a in self.automata)

    def symbols(self) -> np.ndarray:
        """Made once per process; a model that is sent carries only its letters."""
        key = tuple(self.alphabet.known)
        if key not in _SYMBOLS:
            _SYMBOLS[key] = self.alphabet.table()
        return _SYMBOLS[key]

    def squeezed(self, text: str, symbols: np.ndarray) -> np.ndarray:
        return squeezed(text, symbols, len(self.alphabet.known) + 1)

    def parsed(self, texts: list[str | None]) -> list[tuple[str, int, int | None, int] | None]:
        """Of every text the language with fewest phrases, their number, that of the next language, and all symbols.

        None for a text without a letter; the next language is None where the model has one language only.
        """
        symbols = self.symbols()
        results: list = [None] * len(texts)
        start = 0
        while start < len(texts):
            lanes: list[np.ndarray] = []
            owners: list[int] = []
            size, stop = 0, start
            while stop < len(texts) and size < LANES_CHARS:
                found = self.squeezed(texts[stop] or "", symbols)
                if found.any():
                    for at in range(0, len(found), BLOCK):
                        lanes.append(found[at : at + BLOCK])
                        owners.append(stop)
                    size += len(found)
                stop += 1
            start = stop
            if lanes:
                self._decide(lanes, np.array(owners), results)
        return results

    def _decide(self, lanes: list[np.ndarray], owners: np.ndarray, results: list) -> None:
        first, place = np.unique(owners, return_inverse=True)
        total = np.bincount(place, [len(x) for x in lanes], len(first)).astype(np.int64)
        if not self.automata:
            for i, document in enumerate(first):
                results[document] = (UNDETERMINED, 0, None, int(total[i]))
            return
        # The last phrase ends with its document.
        taken = np.stack([np.bincount(place, a.phrases(lanes, owners), len(first)).astype(np.int64) + 1 for a in self.automata])
        best = taken.argmin(axis=0)
        ordered = np.sort(taken, axis=0)
        for i, document in enumerate(first):
            after = int(ordered[1, i]) if len(taken) > 1 else None
            results[document] = (self.languages[best[i]], int(ordered[0, i]), after, int(total[i]))


def squeezed(text: str, symbols: np.ndarray, digit: int) -> np.ndarray:
    """Symbols of a text; anything between letters is one symbol zero, also at both ends. ``digit`` is that of digit 0."""
    if not text:
        return np.zeros(0, np.uint8)
    codes = np.concatenate((np.zeros(1, np.uint32), code_points(text.lower()), np.zeros(1, np.uint32)))
    found = symbols[codes]
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != 0) | (found[:-1] != 0)
    found = found[keep]
    rare = np.flatnonzero(found == RARE)
    if not len(rare):
        return found
    copies = np.ones(len(found), np.int64)
    copies[rare] = DIGITS
    at = (np.cumsum(copies) - copies)[rare]
    spelled, codes = np.repeat(found, copies), codes[keep][rare]
    for i in range(DIGITS):
        spelled[at + i] = digit + codes // RADIX ** (DIGITS - 1 - i) % RADIX
    return spelled


def symbols_of_each(languages: int) -> int:
    """Symbols of labelled text that each language's automaton holds."""
    return MODEL_SYMBOLS // max(1, min(languages, PASS_LANGUAGES))


def fit(rows: DataFrame, lang_col: str = "lang", text_col: str = "text", row_id: str = "doc_id") -> list[Model]:
    """Fit models on a bounded sample of rows with a language and a text, one for each ``PASS_LANGUAGES`` languages.

    Of each language the rows with the smallest hashes of their identifiers are taken, ``SAMPLE_ROWS`` at most and
    no more than fill its share of ``MODEL_SYMBOLS``, and of each of these ``SAMPLE_ROW_CHARS`` characters. What
    the driver gets grows with the number of languages only, a pass at a time.
    """
    labelled = rows.filter(F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(
        F.col(lang_col).alias("lang"),
        F.col(row_id).alias("key"),
        F.substring(text_col, 1, SAMPLE_ROW_CHARS).alias("text"),
    )
    ranked = Window.partitionBy("lang").orderBy(F.xxhash64("key"), "text")
    first, first_path = stored(
        labelled.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= SAMPLE_ROWS), "labelled-sample"
    )
    languages = sorted(r["lang"] for r in first.select("lang").distinct().collect())
    share = symbols_of_each(len(languages))
    before = F.coalesce(F.sum(F.length("text")).over(Window.partitionBy("lang").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    enough = first.withColumn("before", before).filter(F.col("before") < share)
    letter = F.explode(F.split(F.lower("text"), ""))
    frequent = enough.select(letter.alias("letter")).filter(F.col("letter").rlike(r"^\p{L}$")).groupBy("letter").count()
    top = frequent.orderBy(F.desc("count"), "letter").limit(LETTERS).collect()
    known = [ord(r["letter"]) for r in top if len(r["letter"]) == 1 and r["letter"].isalpha()]
    models = []
    for start in range(0, len(languages), PASS_LANGUAGES):
        chosen = languages[start : start + PASS_LANGUAGES]
        samples: dict[str, list[str]] = {language: [] for language in chosen}
        for row in enough.filter(F.col("lang").isin(chosen)).orderBy("lang", "rank").select("lang", "text").collect():
            samples[row["lang"]].append(row["text"])
        models.append(Model(samples, known, len(languages)))
    freed(rows.sparkSession, first_path)
    return models or [Model({}, known, 0)]


PARSED = pa.schema(
    [("lang", pa.string()), ("least", pa.int64()), ("next", pa.int64()), ("symbols", pa.int64()), ("letters", pa.bool_())]
)


def predictor(sent):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        for batch in release(batches):
            found = [(*(p or (UNDETERMINED, 0, None, 0)), p is not None) for p in model.parsed(batch["text"].to_pylist())]
            arrays = [pa.array([row[i] for row in found], t) for i, t in enumerate(PARSED.types)]
            yield pa.record_batch([batch[ROW], batch["id"], *arrays], names=[ROW, "id", *PARSED.names])

    return predict


def held_out(id_col: str) -> F.Column:
    """One fifth of the rows by their identifier; rows without one are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def predictions(rows: DataFrame, models: list[Model], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row key, ``id``, ``lang_pred``, ``score`` and ``known`` of a numbered frame.

    Nothing but the text decides. Texts that are null or have no letter are ``und`` with score 0, and so is
    every text if the models know no language; of languages with equally few phrases the first by name wins.
    ``score`` is how much worse the next best language does, from 0 for a tie. ``known`` says that a text has
    letters and is of a known language: it is not, if it has ``LEAST_SYMBOLS`` symbols or more, the predicted
    language takes it in phrases hardly longer than chance, and its score is below ``LEAST_SCORE``. Models that have
    learned no language know nothing against a text with letters.
    """
    spark = rows.sparkSession
    ship_package(spark)
    slim = rows.select(ROW, F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"{ROW} long, id {dict(rows.dtypes)[id_col]}, lang string, least long, next long, symbols long, letters boolean"
    found = None
    for model in models:
        sent = spark.sparkContext.broadcast(model)  # a few tables of a size set by MODEL_SYMBOLS
        part = slim.mapInArrow(predictor(sent), schema)
        if len(models) > 1:
            part = saved(part, "language-pass")
            sent.unpersist()
        found = part if found is None else found.union(part)
    if len(models) > 1:
        merged = found.groupBy(ROW).agg(
            F.first("id").alias("id"),
            F.max("symbols").alias("symbols"),
            F.first("letters").alias("letters"),
            F.array_sort(F.collect_list(F.struct("least", "lang", "next"))).alias("by"),
        )
        best = F.col("by")[0]
        found = merged.select(
            ROW,
            "id",
            "symbols",
            "letters",
            best["lang"].alias("lang"),
            best["least"].alias("least"),
            F.least(best["next"], F.col("by")[1]["least"]).alias("next"),
        )
    after = F.coalesce("next", F.col("symbols") + 1)
    score = F.when(F.col("letters") & (F.col("least") > 0), 1 - F.col("least") / after).otherwise(0.0)
    chance = max(model.chance for model in models)
    by_chance = F.col("symbols") <= F.lit(chance * CHANCE_FACTOR) * F.col("least")
    learned = F.lit(any(model.languages for model in models))
    unknown = learned & (F.col("symbols") >= LEAST_SYMBOLS) & by_chance & (F.col("score") < LEAST_SCORE)
    return found.withColumn("score", score).select(
        ROW, "id", F.col("lang").alias("lang_pred"), "score", (F.col("letters") & ~unknown).alias("known")
    )


def identify(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``, with models of the rows that are not held out."""
    models = fit(rows.filter(~held_out(id_col)), lang_col, text_col, id_col)
    numbered = with_row_key(rows) if len(models) == 1 else numbered_once(rows.select(id_col, text_col))
    return predictions(numbered, models, id_col, text_col).select(
        F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "lang_pred", "score"
    )


def drop_other_languages(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The input without rows whose text is of no language that the model knows.

    These are texts that are null or have no letter, and texts of ``LEAST_SYMBOLS`` or more which the predicted
    language explains no better than random letters while its score is below ``LEAST_SCORE``; shorter texts and
    mixed languages stay. If no row teaches a language, only the former go, with a warning.
    """
    numbered = numbered_once(rows)
    models = fit(rows.filter(~held_out(id_col)), lang_col, text_col, id_col)
    if not models[0].languages:
        warnings.warn("no language was learned: every text with a letter is kept", stacklevel=2)
    found = predictions(numbered, models, id_col, text_col)
    return drop_rows(numbered, saved(found.filter(~F.col("known")).select(ROW), "no-language"))


def crc_held_out(doc_id: int) -> bool:
    """What ``held_out`` says of one identifier, for tests and other readers."""
    return zlib.crc32(str(doc_id).encode()) % 5 == 0
