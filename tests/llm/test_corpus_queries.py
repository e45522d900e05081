"""The registered corpus queries against SQL where there is some, and the pipeline against its operators."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import corpus_pipeline
import duckdb
import numpy as np
import pytest

import __spark_entry__
from keyedflow.llm import decontaminate, exact, language, simhash
from keyedflow.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    numbers = [int(re.fullmatch(r"op(\d+)_\w+", name)[1]) for name in QUERIES]
    assert numbers == list(range(1, 14))
    registered = __spark_entry__.queries()
    assert set(QUERIES) | {"pipeline"} <= set(registered) and set(ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    cursor = connection.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    frame = QUERIES[name](spark, SF_DIR)
    assert sorted(frame.columns) == sorted(names)
    assert Counter(tuple(r) for r in frame.select(*names).collect()) == Counter(cursor.fetchall())


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The tables between the stages, written and read again as the pipeline does."""
    folder = tmp_path_factory.mktemp("stages")
    found = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, found[-1], SF_DIR).write.parquet(f"{folder}/{name}")
        found.append(spark.read.parquet(f"{folder}/{name}"))
    return found


def test_stages_return_documents(stages):
    for frame in stages[1:-1]:
        assert frame.dtypes == stages[0].dtypes
        assert frame.subtract(stages[0]).count() == 0


def test_stages_take_effect(spark, stages):
    docs, known, single, apart, clean, pieces = stages
    assert known.count() == language.identify(docs).filter("lang_pred <> 'und'").count()
    lowered = {r["text"].translate(str.maketrans({c: c.lower() for c in map(chr, range(65, 91))})) for r in known.collect()}
    assert single.count() == len(lowered)
    assert all(r["kept"] for r in exact.exact_duplicates(single).collect())
    groups = simhash.simhash_duplicates(single).select("component_id").distinct().count()
    assert apart.count() == groups
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    hits = {r["doc_id"]: r["contaminated"] for r in decontaminate.contamination(apart, bench).collect()}
    assert any(hits.values())
    assert {r["doc_id"] for r in clean.collect()} == {i for i, hit in hits.items() if not hit}
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == {i for i, hit in hits.items() if not hit}


def test_run_gives_the_last_stage(spark, stages, tokenizer_path):
    from tokenizers import Tokenizer

    found = corpus_pipeline.run(spark, SF_DIR).collect()
    per_doc = Counter()
    for r in found:
        per_doc[r["doc_id"]] += r["length"]
    encoder = Tokenizer.from_file(tokenizer_path)
    rows = stages[-2].collect()
    assert per_doc == {r["doc_id"]: len(encoder.encode(r["text"], add_special_tokens=False).ids) + 1 for r in rows}
    whole = [r for r in found if r["length"] == r["doc_tokens"]][0]
    text = next(r["text"] for r in rows if r["doc_id"] == whole["doc_id"])
    ids = np.array(encoder.encode(text, add_special_tokens=False).ids + [0], "<u4")
    assert whole["ids_crc32"] == zlib.crc32(ids.tobytes())


def test_near_stage_is_brute_force_simhash(stages):
    from test_duplicates import brute_components, brute_fingerprint

    rows = sorted((r["doc_id"], r["text"]) for r in stages[2].collect())
    first = {}
    for (doc_id, _), label in zip(rows, brute_components([brute_fingerprint(t) for _, t in rows]), strict=True):
        first.setdefault(label, doc_id)
    assert sorted(r["doc_id"] for r in stages[3].collect()) == sorted(first.values())
