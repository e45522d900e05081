"""Encoding, counts, files and packing against the tokenizer itself."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from keyedflow.llm import packing, token_counts, token_files, tokens


@pytest.fixture(scope="module")
def tokenizer(tokenizer_path):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokenizer_path)
    found.encode_special_tokens = True
    return found


def ids_of(tokenizer, text, end=True):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0] * end


def test_encoder_equals_whole_texts(tokenizer, tokenizer_path):
    rnd = random.Random(4)
    parts = [" ", " ", "a", "B.", "é", "\n", "\t", "12", "!", "'s", "'ll", "　", "\x1c", "字", "́", "ª", "²", "_", "<|endoftext|>", " "]
    texts = ["", " ", "a ", " a", "  ", "a\n b", "x a\n\nb. c\n", "y" * 3000 + " z"]
    texts += ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(20_000)]
    for text, got in zip(texts, tokens.Encoder(tokenizer_path).encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == ids_of(tokenizer, text, end=False), repr(text)


def test_cache_stays_bounded(tokenizer_path, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 20)
    encoder = tokens.Encoder(tokenizer_path)
    encoder.encode([" ".join(f"w{i}x" for i in range(500))])
    assert len(encoder.words) + len(encoder.words.old) <= 20


def test_words_with_signs_are_looked_up_in_parts(tokenizer, tokenizer_path, monkeypatch):
    """A word costs the model one call, whatever signs, digits or line ends stand around it."""
    encoder = tokens.Encoder(tokenizer_path)
    asked = []
    make = encoder.words.make
    monkeypatch.setattr(encoder.words, "make", lambda piece: asked.append(piece) or make(piece))
    text = " ".join(["häuser", *(f"{sign}häuser{sign}" for sign in ("", ".", ",", ";)", "12")), "häuser\nhäuser!"])
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == ids_of(tokenizer, text, end=False)
    assert sorted(p for p in asked if "häuser" in p) == [" häuser", "häuser"]  # with a space before it and without
    odd = "x'häuser\u0151 \n\nhäuser,\thäuser\xa0.\u00d7 ..'s"
    assert np.frombuffer(encoder.encode([odd])[0], "<u4").tolist() == ids_of(tokenizer, odd, end=False)


def odd_texts(seed, rows):
    rnd = random.Random(seed)
    parts = [*"   \n\ta", "B.", "é", "×", "Ã", "12", "'s", "　", "\xa0", "ª", "ő", "слово", "😀", "don't", "\r\n", "word"]
    return ["", "  ", None, "\n", *("".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(rows))]


def test_columns_are_cut_like_single_texts():
    texts = odd_texts(5, 5_000)
    data, offsets = tokens.bytes_of(pa.array(["left out", *texts])[1:])
    want = []
    for text, at in zip(texts, offsets.tolist(), strict=False):
        for piece in tokens.pieces_of(text or ""):
            want.append(at)
            at += len(piece.encode())
        assert at <= len(data)
    assert tokens.cuts_of(data, offsets).tolist() == want


def test_a_column_asks_once_for_each_piece(tokenizer, tokenizer_path, monkeypatch):
    """Repeats in a batch cost no look-up each, and all new words go to the model in one call."""
    encoder = tokens.Encoder(tokenizer_path)
    asked, calls = [], []
    monkeypatch.setattr(encoder.words, "get", lambda word: asked.append(word) or dict.get(encoder.words, word))
    speller = encoder.speller
    batch = SimpleNamespace(encode_batch_fast=lambda *a, **k: calls.append(a) or speller.encode_batch_fast(*a, **k))
    monkeypatch.setattr(encoder, "speller", batch)
    texts = [" ".join(f"word{i % 26}x häuser," for i in range(200))] * 20 + [None, "", *odd_texts(6, 300)]
    ids, ends = encoder.encode_column(pa.array(texts), close=b"\0\0\0\0")
    assert len(asked) == len(set(asked)) and len(calls) == 1
    got = [np.frombuffer(ids[a:b], "<u4").tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
    assert got == [ids_of(tokenizer, text) for text in texts]


def test_words_come_back_from_the_older_generation():
    words = tokens.Recent(str.encode, 8)
    long = "x" * (tokens.CACHE_LENGTH + 1)
    made = []
    for some in (["a", "b", "c"], ["d", "e", long], ["a", "f", "g", "h", "i", "j"], ["a", "j"]):
        assert words.many(some, made.extend) == [w.encode() for w in some]
        assert len(words) <= 4 and len(words.old) <= 4 and long not in words
    assert made == ["a", "b", "c", "d", "e", long, "f", "g", "h", "i", "j"]


def test_token_counts(corpus, tokenizer, tokenizer_path):
    lengths = np.array([len(ids_of(tokenizer, r["text"], end=False)) for r in corpus.collect()])
    got = token_counts.token_counts(corpus, tokenizer_path).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(set(lengths.tolist()))
    for r in got:
        n = r["n_tokens"]
        long = lengths >= n
        assert (r["n_docs"], r["docs_at_least"], r["tokens_at_least"]) == ((lengths == n).sum(), long.sum(), lengths[long].sum())
        assert r["tokens_truncated"] == np.minimum(lengths, n).sum()
        assert r["quantile"] == pytest.approx((lengths <= n).mean())


def test_limits_of_a_long_tailed_histogram(spark):
    rnd = random.Random(2)
    lengths = {rnd.randint(0, 1 << rnd.randint(1, 40)): rnd.randint(1, 9) for _ in range(500)}
    answers = token_counts.limits(spark.createDataFrame(list(lengths.items()), "n_tokens long, n_docs long"))
    for r in answers.collect():
        assert r["tokens_truncated"] == sum(min(k, r["n_tokens"]) * n for k, n in lengths.items())
    assert token_counts.truncated_total(answers, 1000).first()["tokens"] == sum(min(k, 1000) * n for k, n in lengths.items())


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files_round_trip(spark, corpus, tokenizer, tokenizer_path, tmp_path, encoding):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(corpus, path, tokenizer_path, encoding=encoding)
    rows = token_files.read_tokens(spark, path).orderBy("part", "before").collect()
    assert Counter((r["doc_id"], tuple(r["tokens"])) for r in rows) == Counter(
        (r["doc_id"], tuple(ids_of(tokenizer, r["text"]))) for r in corpus.collect()
    )
    order = [r["doc_id"] for r in rows]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    index = sorted(token_files.token_index(spark, path).collect(), key=lambda r: r["start"])
    at = 0
    for r, row in zip(index, rows, strict=True):
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (row["doc_id"], at, len(row["tokens"]))
        assert r["ids_crc32"] == zlib.crc32(np.array(row["tokens"], "<u4").tobytes())
        at += r["n_tokens"]


def test_selective_read_is_pushed_down(spark, corpus, tokenizer_path, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(corpus, path, tokenizer_path)
    some = token_files.read_tokens(spark, path, 5, 9, ["doc_id", "n_tokens"])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,5)" in plan and "tokens:array" not in plan.split("ReadSchema")[1]
    assert {r["doc_id"] for r in some.collect()} == {5, 6, 7, 8, 9}


def check_pieces(pieces, texts, window):
    """Every id once, in sequences without gaps."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == set(texts)
    for doc_id, found in by_doc.items():
        at, data = 0, texts[doc_id]
        for p in sorted(found, key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(data) // 4)
            assert p["ids_crc32"] == zlib.crc32(data[4 * at : 4 * (at + p["length"])])
            at += p["length"]
        assert at * 4 == len(data)
    fills = []
    for found in by_sequence.values():
        at = 0
        for p in sorted(found, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= window
        fills.append(at)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert sum(f < window for f in fills) <= 1


@pytest.mark.parametrize("window", [16, 64, 1024])
def test_packing(corpus, tokenizer, tokenizer_path, window):
    unique = corpus.filter("doc_id is not null").dropDuplicates(["doc_id"])
    rows = unique.collect()
    texts = {r["doc_id"]: np.array(ids_of(tokenizer, r["text"]), "<u4").tobytes() for r in rows}
    check_pieces(packing.pack(unique, tokenizer_path, window=window).collect(), texts, window)


def test_packing_keeps_more_words_than_usual(tokenizer_path, monkeypatch):
    sizes = []
    monkeypatch.setattr(packing, "encoder", lambda path, words=None: sizes.append(words) or tokens.encoder(path, words))
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    batch = pa.record_batch({"id": pa.array([7]), "text": pa.array(["two words"])})
    cut = list(packing.cutter(tokenizer_path, 8, 0)([batch]))
    assert sizes[0] is not None and sizes[0] > tokens.CACHE_WORDS
    assert cut[0]["n"].to_pylist() == [len(np.frombuffer(tokens.Encoder(tokenizer_path).encode(["two words"])[0], "<u4")) + 1]


def test_packing_asks_once_for_each_word_of_a_batch(tokenizer, tokenizer_path, monkeypatch):
    asked = []
    encoder = tokens.Encoder(tokenizer_path)
    monkeypatch.setattr(encoder.words, "get", lambda word: asked.append(word) or dict.get(encoder.words, word))
    monkeypatch.setattr(packing, "encoder", lambda path, words=None: encoder)
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = ["some words, " * 50, None, "some more words"] * 10
    cut = list(packing.cutter(tokenizer_path, 8, 0)([pa.record_batch({"id": pa.array(range(30)), "text": pa.array(texts)})]))
    assert sorted(asked) == [" ", " more", " some", " words", ",", "some"]
    for text, n, rest in zip(texts, cut[0]["n"].to_pylist(), cut[0]["rest"].to_pylist(), strict=True):
        ids = ids_of(tokenizer, text)
        assert n == len(ids) and np.frombuffer(rest, "<u4").tolist() == ids[n // 8 * 8 :]


def test_packing_of_repeated_and_null_identifiers(corpus, tokenizer, tokenizer_path):
    pieces = packing.pack(corpus, tokenizer_path)
    total = sum(len(ids_of(tokenizer, r["text"])) for r in corpus.collect())
    assert pieces.agg({"length": "sum"}).first()[0] == total
    assert packing.padding(pieces).first()["tokens"] == total


def test_plan_uses_combinations_and_stays_within_the_histogram():
    rnd = random.Random(9)
    histogram = {n: rnd.randint(0, 60) for n in range(0, 65)}
    plan = packing.Plan(histogram, 64)
    assert plan.combined > 0 and all(plan.used[n] <= histogram[n] for n in range(1, 64))
    filled = Counter()
    for n in range(1, 64):
        for rank in range(histogram[n]):
            for _, size, sequence, _ in plan.place(n, rank):
                filled[sequence] += size
    assert sum(v < 64 for v in filled.values()) <= 1 and len(filled) == plan.sequences


def test_solver_reaches_an_exact_cover():
    combos = np.array([[4, 12, 0], [6, 10, 0], [2, 6, 8]])
    wanted = np.array([5.0, 7.0, 3.0])
    histogram = sum(np.bincount(combos[:, k], wanted, 17) for k in range(3))
    histogram[0] = 0
    assert packing.solve(combos, histogram, 2000) == pytest.approx(wanted, abs=0.1)


def test_empty_table(no_rows, tokenizer_path):
    assert token_counts.token_counts(no_rows, tokenizer_path).collect() == []
    assert token_files.token_round_trip(no_rows, tokenizer_path).collect() == []
    assert packing.pack(no_rows, tokenizer_path).collect() == []
