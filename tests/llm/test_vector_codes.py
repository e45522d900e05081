"""Vector codes against distances from every entry, and the walk over the trie against a plain loop."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from keyedflow.llm import vector_codes as codes
from keyedflow.llm.vector_codes import CodeSpec

SCHEMA = "vec_id long, embedding array<float>, label int, part int, code string, error long"
SPEC = CodeSpec(parts=4, entries=5, rounds=4, scale=16)


def by_hand(rows, spec):
    """Rows, as the operator gives them, from all distances."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    if not kept:
        return []
    numbers = np.floor(np.array([r[1] for r in kept], np.float64) * spec.scale).astype(np.int64)
    numbers = numbers.reshape(len(kept), spec.parts, -1)
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))
    books = numbers[order[: spec.entries]].transpose(1, 0, 2).copy()

    def nearest():
        far = ((numbers[:, :, None] - books) ** 2).sum(axis=3)
        return far.argmin(axis=2), far.min(axis=2)

    for _ in range(spec.rounds):
        found, _ = nearest()
        for p, e in np.ndindex(*books.shape[:2]):
            mine = found[:, p] == e
            if mine.any():
                books[p, e] = numbers[mine, p].sum(axis=0) // mine.sum()
    found, far = nearest()
    digest = hashlib.sha256(",".join(str(x) for x in books.ravel()).encode()).hexdigest()
    sums = Counter()
    for r, error in zip(kept, far.sum(axis=1), strict=True):
        sums[r[2]] += int(error)
    return [
        (r[0], bytes(c.astype(np.uint8)).hex(), int(e), sums[r[2]], digest)
        for r, c, e in zip(kept, found, far.sum(axis=1), strict=True)
    ]


def awkward_rows(seed, count=400):
    """Copies, ties, shared first components, nulls everywhere, and labels of very different sizes."""
    rnd = random.Random(seed)
    rows = [(None, [0.5] * 12, None), (900, None, 1), (901, [None] + [0.0] * 11, 1), (902, [float("nan")] * 12, 2)]
    rows += [(903, [float("inf")] + [0.0] * 11, 2), (0, [-0.01] * 12, 7), (0, [-0.01] * 12, 7)]
    same = [rnd.uniform(-1, 1) for _ in range(12)]
    for i in range(count):
        vector = same if i % 3 == 0 else [rnd.choice((-1.0, -0.03, 0.0, 0.4, rnd.uniform(-3, 3))) for _ in range(12)]
        rows.append((rnd.randint(1, 300), vector, None if i % 5 == 0 else 1 if i % 2 else i))
    return [(i, v, label, 1, "k", 2) for i, v, label in rows]


@pytest.mark.parametrize(("seed", "leaves", "block"), [(1, 3, 7), (2, 2048, 1 << 14)])
def test_codes_are_those_of_all_distances(spark, monkeypatch, seed, leaves, block):
    monkeypatch.setattr(codes, "LEAVES", leaves)
    monkeypatch.setattr(codes, "BLOCK_ROWS", block)
    rows = awkward_rows(seed)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    result = codes.vector_codes(frame, SPEC)
    assert result.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    stored = [tuple(r)[:3] for r in frame.collect()]
    assert Counter(map(tuple, result.collect())) == Counter(by_hand(stored, SPEC))


def test_few_none_and_unusable_vectors(spark):
    few = [(2, [0.5, 1.0, 0.0, -2.0], None), (1, [0.5, 1.0, 0.1, 2.0], None)]
    frame = spark.createDataFrame(few, "vec_id long, embedding array<float>, label int")
    assert Counter(map(tuple, codes.vector_codes(frame, SPEC).collect())) == Counter(by_hand([tuple(r) for r in frame.collect()], SPEC))
    none = codes.vector_codes(frame.limit(0), SPEC)
    assert none.count() == 0 and none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert codes.vector_codes(frame.selectExpr("vec_id", "cast(null as array<float>) embedding", "label"), SPEC).count() == 0
    for vectors, message in ([[1.0] * 4, [1.0] * 8], "components and"), ([[1.0] * 3], "equal parts"), ([[1e9] * 4], "too large"):
        rows = [(i, v, 0) for i, v in enumerate(vectors)]
        with pytest.raises(Exception, match=message):
            codes.vector_codes(spark.createDataFrame(rows, frame.schema), SPEC).collect()
    with pytest.raises(ValueError, match="256"):
        CodeSpec(entries=300)


def test_walk_shares_paths_and_keeps_exact_distances(monkeypatch):
    rnd = np.random.default_rng(5)
    parts = rnd.integers(-2, 3, (500, 4))
    leaves, weights, place = codes.distinct_parts(parts)
    assert (leaves[place] == parts).all() and weights.sum() == 500
    assert [tuple(r) for r in leaves] == sorted({tuple(r) for r in parts})
    entries = rnd.integers(-5, 6, (7, 4))
    wanted = ((leaves[:, None] - entries) ** 2).sum(axis=2)
    for size in (1, 2, 64, 10_000):
        monkeypatch.setattr(codes, "LEAVES", size)
        found = np.concatenate([d for _, d in codes.walk(leaves, entries)])
        assert (found == wanted).all()


def test_hot_labels_are_broadcast_and_others_shuffled(spark):
    rows = [(i, 5 if i % 3 else i) for i in range(9000)] + [(-1, None), (-2, None)]
    frame = spark.createDataFrame([(i, label, "00", 1) for i, label in rows], "_id long, _label long, code string, error long")
    found = {r["_id"]: r["label_error"] for r in codes.with_label_errors(frame).collect()}
    sizes = Counter(label for _, label in rows)
    assert found == {i: sizes[label] for i, label in rows}
