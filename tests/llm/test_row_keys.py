"""Operators give the same rows when a scan's splits change from one job to the next."""

from __future__ import annotations

from collections import Counter

import pytest

from keyedflow.llm import common, decontaminate, exact, html_text, language, repeats, simhash

BENCH = [(1, "a passage of words that several documents of this table share from its first to its very last letter")]


def main_text(rows, spark):
    return html_text.main_text(rows.selectExpr("doc_id AS page_id", "'http://h.example/' AS url", "text AS html"))


OPERATORS = {
    "repeats": lambda rows, spark: repeats.repeated_passages(rows),
    "main_text": main_text,
    "language": lambda rows, spark: language.drop_other_languages(rows),
    "exact": lambda rows, spark: exact.drop_exact_duplicates(rows, keep="largest"),
    "simhash": lambda rows, spark: simhash.drop_near_duplicates(rows),
    "contamination": lambda rows, spark: decontaminate.contamination(
        rows, spark.createDataFrame([*BENCH, (2, "other words that are never there")], "item_id long, text string"), pass_bytes=30
    ),
    "contaminated": lambda rows, spark: decontaminate.drop_contaminated(rows, spark.createDataFrame(BENCH, "item_id long, text string")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_splits_may_change_between_jobs(spark, corpus, monkeypatch, name):
    settings = {"spark.sql.files.openCostInBytes": ("0", "4194304"), "spark.sql.files.minPartitionNum": ("1", "64")}
    before = {k: spark.conf.get(k, None) for k in settings}
    rows = spark.read.parquet(corpus.inputFiles()[0].rsplit("/", 1)[0])
    wanted = Counter(map(repr, OPERATORS[name](rows, spark).collect()))
    turn = [0]

    def deal() -> None:
        turn[0] ^= 1
        for key, values in settings.items():
            spark.conf.set(key, values[turn[0]])

    def saved(frame, label, save=common.saved):
        found = save(frame, label)
        deal()
        return found

    def stored(frame, label, store=common.stored):
        found = store(frame, label)
        deal()
        return found

    for module in (decontaminate, exact, html_text, language, repeats, simhash):
        for name_of, changed in (("saved", saved), ("stored", stored)):
            if hasattr(module, name_of):
                monkeypatch.setattr(module, name_of, changed)
    try:
        deal()
        found = OPERATORS[name](rows, spark)
        deal()
        turns = [Counter(map(repr, found.collect()))]
        deal()
        turns.append(Counter(map(repr, OPERATORS[name](rows, spark).collect())))
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert turns == [wanted, wanted]
