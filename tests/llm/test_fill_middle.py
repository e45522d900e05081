"""Fill-in-the-middle against plain Python: units, cuts, forms, and the way back."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyedflow.llm import fill_middle
from keyedflow.llm.fill_middle import CHARACTERS, WORDS, Layout, fill_in_middle, restored

TEXTS = [
    "",
    "a",
    "abc",
    "é",
    "éa\U0001f600bcd ef́ ",
    "\U0001f600" * 40,
    "ab1cd2 ..  \n\t€uro ünd So weiter",
    "x" * 5000 + "ß" + "y" * 5000,
    "<P",
    "P><",
    "<<<>>>",
    "a<S>b",
    "<M>",
    "\x00\x01 nul",
]
UNIT = {WORDS: r"(?s)[A-Za-z]+|[^A-Za-z]", CHARACTERS: "(?s)."}


def by_hand(doc_id, text, unit, layout):
    text = text or ""
    units = re.findall(UNIT[unit], text)
    n = len(units)
    digest = hashlib.sha256(f"{layout.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in layout.markers) or h[2] % 100 >= layout.transformed_percent:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < layout.suffix_first_percent:
        return doc_id, n, "spm", len(p), len(m), f"{layout.suffix}{s}{layout.prefix}{p}{layout.middle}{m}"
    return doc_id, n, "psm", len(p), len(m), f"{layout.prefix}{p}{layout.suffix}{s}{layout.middle}{m}"


@pytest.mark.parametrize("unit", [WORDS, CHARACTERS])
@pytest.mark.parametrize("layout", [Layout(), Layout("<|pre|>", "<|suf|>", "<|mid|>", 100, 50, 7)])
def test_cuts_and_forms(spark, corpus, unit, layout):
    listed = [(i, t) for i in range(12) for t in TEXTS] + [(None, "no identifier"), (None, "no identifier"), (3, None)]
    made = spark.createDataFrame(listed, "doc_id long, text string")
    for docs in (made, corpus, made.limit(0)):
        result = fill_in_middle(docs, layout, unit)
        columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        assert result.columns == columns
        rows = docs.select("doc_id", "text").collect()
        assert Counter(map(tuple, result.collect())) == Counter(by_hand(i, t, unit, layout) for i, t in rows)
        back = result.select("doc_id", restored(F.col("output"), F.col("form"), layout).alias("text"))
        assert Counter(map(tuple, back.collect())) == Counter((i, t or "") for i, t in rows)


def test_index_holds_only_what_differs():
    text = "plain text é and \U0001f600 so on " * 3
    data = np.frombuffer(text.encode(), np.uint8)
    characters, units = fill_middle.indexes(data, WORDS)
    assert len(characters.bytes) == 6 and characters.count == len(text)
    starts = np.array([len(text[:i].encode()) for i in range(len(text))])
    assert (characters.to_bytes(np.arange(len(text))) == starts).all()
    assert (characters.to_units(starts) == np.arange(len(text))).all()
    found = re.findall(UNIT[WORDS], text)
    ends = np.cumsum([len(u.encode()) for u in found])
    assert units.count == len(found) and (units.to_bytes(np.arange(1, len(found) + 1)) == ends).all()
    assert not len(fill_middle.indexes(data[:10], CHARACTERS)[0].bytes)


def test_markers_that_could_arise_by_chance_are_refused():
    for markers in (("<P>", "<P>", "<M>"), ("<P>", "S>", "<M>"), ("", "<S>", "<M>"), ("<P", "<P>", "<M>"), ("aXa", "aYb", "aZb")):
        with pytest.raises(ValueError, match="marker"):
            Layout(*markers)


def test_no_shuffle(spark, corpus):
    plan = corpus._sc._jvm.PythonSQLUtils.explainString(fill_in_middle(corpus)._jdf.queryExecution(), "formatted")
    assert "Exchange" not in plan and "ReadSchema: struct<doc_id:bigint,text:string>" in plan
