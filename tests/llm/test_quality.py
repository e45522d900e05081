"""Quality: held-out accuracy, labels that are never read, and the flat trees against node-by-node steps."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyedflow.llm import quality
from keyedflow.llm.quality import QualitySpec, grow_forest, quality_scores, statistics

SF_DIR = "/root/testdata/sf0.01"
SMALL = QualitySpec(trees=10)


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels")]


@pytest.fixture(scope="module")
def scores(tables):
    return {r["doc_id"]: r for r in quality_scores(*tables).collect()}


def test_held_out_documents_are_told_apart(tables, scores):
    docs, labels = tables
    assert len(scores) == docs.count()
    answers = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rest = [i for i in answers if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in scores.items() if r["held_out"]} == {i for i in scores if zlib.crc32(str(i).encode()) % 4 == 2}
    assert len(rest) > 50 and len({answers[i] for i in rest}) == 2
    right = [scores[i]["predicted"] == answers[i] for i in rest]
    assert sum(right) / len(right) >= 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in scores.values())


def test_held_out_labels_change_nothing(tables, scores):
    docs, labels = tables
    turned = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    changed = docs.withColumns({"lang": F.lit("x"), "source": F.lit("y")})
    assert {r["doc_id"]: r["score"] for r in quality_scores(changed, turned).collect()} == {
        i: r["score"] for i, r in scores.items()
    }


def test_awkward_tables(spark, corpus, no_rows, tables):
    _, labels = tables
    assert quality_scores(no_rows, labels, SMALL).count() == 0
    unlabelled = quality_scores(corpus, labels.limit(0), SMALL).collect()
    assert len(unlabelled) == corpus.count() and {r["score"] for r in unlabelled} == {0.5}
    made = [(i, int(i % 2), None) for i in range(100, 213)] + [(None, 1, None), (100, 1, 0), (101, None, 0), (102, 7, 1)]
    labelled = spark.createDataFrame(made * 2, "doc_id long, quality int, text string")
    found = quality_scores(corpus, labelled, SMALL).collect()
    assert len(found) == corpus.count() and all(0 <= r["score"] <= 1 for r in found)
    texts = {(r["doc_id"], r["text"]) for r in corpus.collect()}
    assert len({(r["doc_id"], r["score"]) for r in found}) <= len(texts)
    one_class = quality_scores(corpus, labelled.filter("quality = 1"), SMALL).collect()
    assert min(r["score"] for r in one_class) > 0.9


def test_an_identifier_with_both_labels_is_not_learned(spark):
    rows = [(i, i % 2) for i in range(40)] + [(4, 1), (5, 1), (None, 0)]
    sample, sizes = quality.labelled_sample(spark.createDataFrame(rows, "doc_id long, quality int"), SMALL, "doc_id", "quality")
    learned = {i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2} - {4}
    assert {(r["_id"], r["_label"]) for r in sample.collect()} == {(i, i % 2) for i in learned}
    assert sizes == {c: sum(i % 2 == c for i in learned) for c in (0, 1)}


def test_the_sample_is_bounded_and_the_classes_keep_their_weight(spark, tables):
    docs, labels = tables
    few = QualitySpec(sample_rows=30, trees=20)
    sample, sizes = quality.labelled_sample(labels, few, "doc_id", "quality")
    assert sample.groupBy("_label").count().agg(F.max("count")).first()[0] <= 30 and sum(sizes.values()) > 200
    forest = quality.fit(docs, labels, few, "doc_id", "text", "quality")
    assert abs(1 / (1 + np.exp(-forest.base)) - sizes[1] / sum(sizes.values())) < 1e-9


def test_statistics_of_whole_texts():
    at = {name: i for i, name in enumerate(quality.STATISTICS)}
    assert statistics("") == [0.0] * len(at)
    values = statistics("Ab ab!! 12\nAb ab!! 12\n")
    assert values[at["words"]] == pytest.approx(np.log1p(6)) and values[at["repeated_lines"]] == 0.5
    assert values[at["distinct_words"]] == 0.5 and values[at["words_ending_in_marks"]] == pytest.approx(2 / 6)
    for text in ("x" * 300_000, "word " * 60_000, "\n\n \n", "\x00", "é" * 50_000, "🙂"):
        assert np.isfinite(statistics(text)).all()
    # The end of a long text counts.
    assert statistics("word " * 60_000) != statistics("word " * 50_000 + "a$%&/ " * 10_000)


def test_flat_trees_step_like_single_ones():
    rnd = np.random.default_rng(3)
    rows = rnd.normal(size=(600, 5)).round(1)
    labels = ((rows[:, 0] > 0) ^ (rows[:, 3] > 0.5)).astype(float)
    spec = QualitySpec(trees=15)
    forest = grow_forest(rows, labels, np.ones(600), spec)

    def walk(row):
        total = forest.base
        for node in forest.roots:
            while forest.left[node] != node:
                side = forest.left if row[forest.feature[node]] <= forest.bound[node] else forest.right
                node = side[node]
            total += forest.value[node]
        return 1 / (1 + np.exp(-total))

    found = forest.score(rows)
    assert np.allclose(found, [walk(r) for r in rows])
    assert ((found > 0.5) == labels).mean() > 0.97
    assert forest.score(rows[:0]).shape == (0,)
