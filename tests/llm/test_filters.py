"""Decontamination, language, personal data and page text against brute force and given cases."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus import SCHEMA, stored

from keyedflow.llm import decontaminate, html_text, language, pii
from keyedflow.llm.common import with_row_key

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_hits(rows, items, window=10):
    owners = defaultdict(set)
    for item, text in items:
        words = words_of(text)
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if words else 0):
            owners[tuple(words[i : i + n])].add(item)
    found = []
    for doc_id, text in rows:
        words, hit, names = words_of(text), set(), set()
        for n in {len(k) for k in owners}:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in owners:
                    hit.update(range(i, i + n))
                    names |= owners[tuple(words[i : i + n])]
        digest = hashlib.sha256(",".join(sorted(str(x) for x in names if x is not None)).encode()).hexdigest()
        found.append((doc_id, len(words), len(hit), len(names - {None}), digest, bool(hit)))
    return Counter(found)


HIT_COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.fixture(scope="module")
def benchmark_rows():
    from corpus import PASSAGE

    return [
        (1, PASSAGE.upper() + "!"),
        (2, "Same Text"),
        (3, "école"),
        (3, "456"),
        (None, "identifier"),
        (4, None),
        (5, ""),
        (6, "words of this table that no document holds in that order of words at all"),
        (7, " ".join(["again"] * 30)),
    ]


@pytest.mark.parametrize(("pass_bytes", "shard"), [(1 << 20, 1 << 20), (60, 1 << 20), (1 << 20, 40)])
def test_contamination(spark, corpus, benchmark_rows, monkeypatch, pass_bytes, shard):
    monkeypatch.setattr(decontaminate, "SHARD_SYMBOLS", shard)
    bench = spark.createDataFrame(benchmark_rows, "item_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    got = decontaminate.contamination(corpus, bench, pass_bytes=pass_bytes).collect()
    assert Counter(tuple(r[c] for c in HIT_COLUMNS) for r in got) == brute_hits(rows, benchmark_rows)
    left = decontaminate.drop_contaminated(corpus, bench)
    assert left.columns == corpus.columns and left.count() == sum(not r["contaminated"] for r in got)


def test_no_benchmark_and_no_documents(spark, corpus, no_rows, benchmark_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r["contaminated"] for r in decontaminate.contamination(corpus, none).collect())
    bench = spark.createDataFrame(benchmark_rows, "item_id long, text string")
    assert decontaminate.contamination(no_rows, bench).collect() == []


def test_fm_index_finds_and_locates_everything():
    rnd = random.Random(3)
    for _ in range(60):
        text = np.array([rnd.randint(1, rnd.choice([2, 5, 40])) for _ in range(rnd.randint(1, 200))])
        index = decontaminate.FMIndex(text, sample=rnd.choice([1, 3, 8]))
        for n in (1, 2, 4):
            windows = np.array([[rnd.randint(1, 41) for _ in range(n)] for _ in range(30)])
            low, high = index.search(windows)
            for w, lo, hi in zip(windows, low, high, strict=True):
                places = sorted(index.locate(np.arange(lo, hi)).tolist())
                assert places == [i for i in range(len(text) - n + 1) if (text[i : i + n] == w).all()]


LANGS = {"xx": "ka ko ku kami kore", "yy": "the of and with thing", "zz": "der die und mit ding"}


@pytest.fixture(scope="module")
def spoken(spark, tmp_path_factory):
    rnd = random.Random(5)
    rows = []
    for i in range(600):
        lang = rnd.choice(list(LANGS))
        text = " ".join(rnd.choice(LANGS[lang].split()) for _ in range(rnd.randint(4, 60)))
        rows.append((i, text, lang if rnd.random() < 0.9 else None, "s"))
    rows += [(1000, None, "xx", "s"), (1001, "", "xx", "s"), (1002, "12 !? 3", "yy", "s"), (None, "the thing and the thing", None, None)]
    rows += [(1003, "the thing of the thing and " * 3000, None, "s")]
    return stored(spark, tmp_path_factory.mktemp("spoken"), [(*r, 1, 1, "k", None) for r in rows], SCHEMA)


def test_language_of_held_out_rows(spoken):
    got = language.identify(spoken).collect()
    truth = {r["doc_id"]: r["lang"] for r in spoken.collect()}
    assert len(got) == len(truth)
    by_id = {r["doc_id"]: r for r in got}
    held = [i for i, r in by_id.items() if r["held_out"] and truth[i] and i < 1000]
    assert held and all(language.crc_held_out(i) for i in held)
    assert np.mean([by_id[i]["lang_pred"] == truth[i] for i in held]) > 0.98
    assert [by_id[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3
    assert by_id[1003]["lang_pred"] == by_id[None]["lang_pred"] == "yy" and not by_id[None]["held_out"]
    assert all(0 <= r["score"] <= 1 for r in got)


def test_labels_of_held_out_rows_teach_nothing(spark, spoken, tmp_path):
    from pyspark.sql import functions as F

    other = spoken.withColumn("lang", F.when(language.held_out("doc_id"), "qq").otherwise(F.col("lang")))
    other.write.parquet(str(tmp_path / "t"))
    key = lambda rows: sorted(map(tuple, rows), key=repr)
    assert key(language.identify(spark.read.parquet(str(tmp_path / "t"))).collect()) == key(language.identify(spoken).collect())


def test_no_labels_no_rows(spark, corpus, no_rows):
    from pyspark.sql import functions as F

    unlabelled = corpus.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify(unlabelled).collect()} == {"und"}
    assert language.identify(no_rows).collect() == []
    left = language.drop_other_languages(corpus)
    assert left.columns == corpus.columns
    assert left.count() == sum(any(c.isalpha() for c in r["text"] or "") for r in corpus.collect())


def test_phrases_are_the_greedy_longest_matches():
    rnd = random.Random(8)
    text = [rnd.randint(0, 3) for _ in range(300)]
    automaton = language.Automaton(text, 5)
    known = {tuple(text[i:j]) for i in range(300) for j in range(i + 1, min(300, i + 40) + 1)}
    for _ in range(50):
        lane = np.array([rnd.randint(0, 4) for _ in range(60)])
        phrases, at = 1, 0
        for i in range(1, 60):
            if tuple(lane[at : i + 1].tolist()) not in known:
                phrases, at = phrases + 1, i
        # A first symbol that the text does not hold counts as a step from nothing, once more than a phrase.
        extra = int(lane[0] == 4)
        assert automaton.phrases([lane], np.zeros(1, int))[0] + 1 == phrases + extra
        # Blocks of a text are parsed as the text is.
        blocks = [lane[i : i + 7] for i in range(0, 60, 7)]
        assert automaton.phrases(blocks, np.zeros(len(blocks), int)).sum() + 1 == phrases + extra


SCRIPTS = {"zh": "我们今天去学校学习中文", "ja": "わたしはきょうがっこうへいきます", "ko": "나는오늘학교에갑니다", "ru": "мысегодняидемвшколу", "ar": "نذهباليومإلىالمدرسة"}


def speech(scripts, per_language, seed=4):
    """Rows of random words over each script's letters; one word in ten is of another language."""
    rnd = random.Random(seed)
    words = {lang: ["".join(rnd.choice(letters) for _ in range(rnd.randint(2, 4))) for _ in range(30)] for lang, letters in scripts.items()}
    names, rows = sorted(scripts), []
    for lang in names:
        for _ in range(per_language):
            text = " ".join(rnd.choice(words[lang if rnd.random() < 0.9 else rnd.choice(names)]) for _ in range(40))
            rows.append((len(rows), text, lang, "s", 1, 1, "k", None))
    return rows


def accuracy(frame):
    truth = {r["doc_id"]: r["lang"] for r in frame.collect()}
    held = [r for r in language.identify(frame).collect() if r["held_out"]]
    return np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held])


def test_scripts_with_many_letters_are_told_apart(spark, tmp_path):
    assert accuracy(stored(spark, tmp_path, speech(SCRIPTS, 40), SCHEMA)) > 0.98


def test_languages_beyond_one_pass(spark, tmp_path, monkeypatch):
    latin = {f"l{i:02}": "abcdefghijklmnoprstuvyz"[i % 12 : i % 12 + 11] for i in range(50)}
    frame = stored(spark, tmp_path, speech(latin, 12), SCHEMA)
    monkeypatch.setattr(language, "MODEL_SYMBOLS", 60_000)
    several = accuracy(frame)
    assert several > 0.95
    key = lambda: sorted(map(tuple, language.identify(frame).collect()))
    monkeypatch.setattr(language, "symbols_of_each", lambda n: 1_500)
    monkeypatch.setattr(language, "PASS_LANGUAGES", 50)
    once = key()
    monkeypatch.setattr(language, "PASS_LANGUAGES", 20)
    assert key() == once


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(text):
    digits = [int(c) for c in re.sub("[^0-9]", "", text)]
    total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
    return 14 <= len(digits) <= 19 and total % 10 == 0


VALID = {
    "email": lambda s: True,
    "ip": lambda s: all(int(x) <= 255 for x in s.split(".")),
    "card": luhn,
    "phone": lambda s: 10 <= len(re.sub("[^0-9]", "", s)) <= 15,
}


def brute_spans(text):
    found = [
        (m.start(), order, f"{kind}:{m.start()}:{m.end()}")
        for order, kind in enumerate(PATTERNS)
        for m in re.finditer(PATTERNS[kind], text or "")
        if VALID[kind](m[0])
    ]
    return ",".join(x[2] for x in sorted(found)), tuple(sum(x[1] == o for x in found) for o in range(4))


def test_personal_data(spark):
    rnd = random.Random(6)
    parts = ["@", ".", "a", "1", "2", "25", "255", "-", " ", "+", "b.c", "(", "x@", "%", "_", "é", "4111", "1111", "\U0001f600", "\u0001"]
    texts = [None, "", "a@b.c_d@e.f", "a@b.c.@d.e", "1.2.3.4.5.6.7.8 0000255.0.0.0 256.1.1.1", "4111 1111 1111 1111"]
    texts += ["aaaa." * 3000 + "@x" + ".y" * 9000, "1" * 20_000, "9 " * 20_000 + "."]
    texts += ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = pii.personal_data(frame.repartition(8)).collect()
    assert len(got) == len(texts)
    for r in got:
        listed, counts = brute_spans(texts[r["doc_id"]])
        assert tuple(r[f"n_{k}"] for k in PATTERNS) == counts, repr(texts[r["doc_id"]])[:200]
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()


def test_validators_and_context(spark):
    rows = [(1, "Bank account GB82 WEST 1234 5698 7654 32."), (2, "GB83 WEST 1234 5698 7654 32"), (3, "call +1 555 123 4567 or 10.0.0.1"), (4, "+1 555 123 4567")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(frame).collect()}
    assert [(s["kind"], s["value"]) for s in spans[1]] == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert spans[2] == []
    assert spans[1][0]["score"] == 1.0 and spans[3][0]["score"] > spans[4][0]["score"]


def test_personal_data_runs_no_python(corpus, no_rows):
    plan = pii.personal_data(corpus)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
    assert pii.personal_data(corpus).count() == corpus.count() and pii.personal_data(no_rows).collect() == []


PAGES = [
    ("<p>one <b>two</b>three<br>four<p>five<ul><li>a<li>b</ul>", "one twothree four five a b"),
    ("<header>Site</header><nav>x</nav><main><article><header><h1>T&eacute;st</h1></header><p>body</article></main><footer>f", "Tést body"),
    ("<article><p>kept</p><div class='share-box'>s</div><aside>side</aside><form>f<input></form><script>if(a<b)'</p>'</script>tail&nbsp;x</article><div>out</div>", "kept tail x"),
    ("<main><p>text</p><section class=comments><article class=comment>nice</article></section></main>", "text"),
    ("<article><p>a</article><section id='comments'><article class='comment'>no</article></section>", "a"),
    ("<div class=ad>ad</div><div id=cookie-notice>c</div><div>plain <i>t</i>ext</div>", "plain text"),
    ("<!-- <p>no</p> --><p>a &lt;b&gt; &amp;amp; &#x41;</p><style>p{}</style>", "a <b> &amp; A"),
    ('<div class="no-sidebar"><article><p>one</p></article></div>', "one"),
    ('<div id="page" class="has-header"><article>two</article></div><p>out</p>', "two"),
    ('<article class="with-comments"><p>three</p><div class="comments"><article>c</article></div></article>', "three"),
    ("<div>" * 210 + "<nav>menu</nav><p>text", "text"),
    ('<form id="all"><div class="widget"><article>long enough to be the text</article></div><div>x</div></form>', "long enough to be the text"),
    ('<div class="plain"><p>the long text of a page</p></div><div class="comments"><article>nice</article></div>', "the long text of a page"),
    ("no markup  at\n all", "no markup at all"),
    ("<p>open <b>and <i>cut", "open and cut"),
    ("a < b <3 <> </> <p class=\"x", "a < b <3 <>"),
    ("", ""),
    (None, ""),
]


def test_page_text(spark, tmp_path):
    rows = [(i, f"http://h{i}.example/p", html, "x") for i, (html, _) in enumerate(PAGES)] + [(50, None, "<p>x", "x"), (50, "http://[", "<p>y", "x"), (None, "u", "<p>z", None)]
    frame = stored(spark, tmp_path, rows, "page_id long, url string, html string, text string")
    got = html_text.main_text(frame).collect()
    texts = {r["page_id"]: r["text"] for r in got}
    assert {i: texts[i] for i in range(len(PAGES))} == {i: t for i, (_, t) in enumerate(PAGES)}
    assert sorted(r["text"] for r in got if r["page_id"] == 50) == ["x", "y"] and texts[None] == "z"
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_text.main_text(frame.limit(0)).collect() == []


def test_site_style_tree_removes_what_all_pages_share(spark, tmp_path):
    rows = []
    for i in range(40):
        own = f"<div class='story'><p>story number {i} of its own</p></div>"
        rows.append((i, "http://same.example/a", f"<div class='intro'><p>Welcome to our site</p></div>{own}", None))
        rows.append((100 + i, "http://copies.example/a", "<div class='story'><p>one page many times</p></div>", None))
    rows.append((200, "http://few.example/a", "<div class='intro'><p>Welcome to our site</p></div>", None))
    got = html_text.main_text(stored(spark, tmp_path, rows, "page_id long, url string, html string, text string"))
    texts = {r["page_id"]: r["text"] for r in got.collect()}
    assert all(texts[i] == f"story number {i} of its own" for i in range(40))
    assert all(texts[100 + i] == "one page many times" for i in range(40))
    # Alone on its host, but known from the other pages with that node; all of a page never goes.
    assert texts[200] == "Welcome to our site"


def test_repeated_notices_inside_articles_go(spark, tmp_path):
    rows = []
    for i in range(30):
        own = f"<p>text {i} of its own</p><p>Read it on paper</p><ul><li>item {i}</li><li>Tell a friend</li></ul>"
        rows.append((i, "http://one.example/a", f"<article><h1>title {i}</h1>{own}</article>", None))
        # Each host has a page, so that only all hosts together show what repeats.
        rows.append((100 + i, f"http://h{i}.example/a", f"<main><h1>title {i}</h1>{own}</main>", None))
    got = html_text.main_text(stored(spark, tmp_path, rows, "page_id long, url string, html string, text string"))
    texts = {r["page_id"]: r["text"] for r in got.collect()}
    assert all(texts[k + i] == f"title {i} text {i} of its own item {i}" for i in range(30) for k in (0, 100))


def test_a_page_on_many_hosts_counts_once(spark, tmp_path):
    page = "<div class='note'><p>shared by all</p></div><div class='story'><p>the same story</p></div>"
    rows = [(i, f"http://h{i}.example/a", page, None) for i in range(30)]
    # Pages of their own on hosts of their own, with a note that all of them repeat.
    for i in range(100, 130):
        own = f"<div class='note'><p>on every page</p></div><div class='story'><p>story {i}</p></div>"
        rows.append((i, f"http://h{i}.example/a", own, None))
    got = html_text.main_text(stored(spark, tmp_path, rows, "page_id long, url string, html string, text string"))
    texts = {r["page_id"]: r["text"] for r in got.collect()}
    # The note's node says the same on 30 of 31 different pages and goes whole; the copied story is one story of 31.
    assert all(texts[i] == "the same story" for i in range(30))
    assert all(texts[i] == f"story {i}" for i in range(100, 130))


def test_texts_of_removed_nodes_go():
    # Nodes 0 (1 (2)) and 3; the text in node 2 goes with node 1.
    texts, at, around = ["a", "b", "c", "d"], [0, 2, 3, -1], [-1, 0, 1, -1]
    assert html_text.kept_text(texts, at, around, None) == "a b c d"
    assert html_text.kept_text(texts, at, around, [1]) == "a c d"
    assert html_text.kept_text(texts[:3], at[:3], around, [0, 3]) == "a b c"


@pytest.mark.parametrize("junk", ["<", "<a ", "<div>", "<!--", "&", "<p><b>", "<a '", "<script>", "</", '<a b="x'])
def test_hostile_pages_take_linear_time(junk):
    began = time.process_time()
    html_text.parse(junk * 50_000)
    assert time.process_time() - began < 10


def test_row_keys_hold_over_readings(corpus):
    first = {tuple(r) for r in with_row_key(corpus).select("__row", "id").collect()}
    assert first == {tuple(r) for r in with_row_key(corpus.select("id", "text")).select("__row", "id").collect()}


def test_texts_of_no_known_language_go_and_clean_ones_stay(spark, spoken, tmp_path):
    rnd = random.Random(9)
    junk = [(2000 + i, "".join(rnd.choice("abcdefghijklmnoprtuvwy ") for _ in range(400)), "yy" if i % 2 else None, "s", 1, 1, "k", None) for i in range(20)]
    junk += [(3000, "אבג ד" * 60, None, "s", 1, 1, "k", None), (3001, "qvw", None, "s", 1, 1, "k", None)]
    rows = stored(spark, tmp_path, [tuple(r) for r in spoken.collect()] + [j for j in junk if not j[2]], SCHEMA)
    left = {r["doc_id"] for r in language.drop_other_languages(rows).collect()}
    clean = {r["doc_id"] for r in spoken.collect()} - {1000, 1001, 1002}
    assert left == clean | {3001}


def test_no_language_learned_drops_no_text(spark, corpus, tmp_path):
    from pyspark.sql import functions as F

    corpus.withColumn("lang", F.lit(None).cast("string")).write.parquet(str(tmp_path / "t"))
    with pytest.warns(UserWarning, match="no language"):
        left = language.drop_other_languages(spark.read.parquet(str(tmp_path / "t")))
    assert left.count() == sum(any(c.isalpha() for c in r["text"] or "") for r in corpus.collect())
