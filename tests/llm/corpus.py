"""Small tables with the cases that operators have to stand: nulls, empties, ties, repeats, long texts."""

from __future__ import annotations

import random

PASSAGE = "a passage of words that several documents of this table share from its first to its very last letter"


def documents() -> list[tuple]:
    """``doc_id, text, lang, source`` and extra columns whose names the operators use inside."""
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 8))) for _ in range(120)]
    prose = [" ".join(rnd.choice(words) for _ in range(rnd.randint(5, 150))) for _ in range(30)]
    rows: list[tuple] = [
        (1, None, None, None),
        (2, "", "en", ""),
        (3, " \n\t ", "en", "s"),
        (None, "text without an identifier", "en", "s"),
        (None, "text without an identifier", "en", "s"),
        (4, "Same Text", "de", "s"),
        (4, "Same Text", "de", "s"),
        (5, "same text", "de", None),
        (6, "SAME TEXT", None, "s"),
        (7, "École \U0001f600 école", "fr", "s"),
        (8, "école \U0001f600 école", "fr", "s"),
        (9, "x" * 200_000, "en", "s"),
        (10, "<|endoftext|> \u0001 ' \"", "en", "s"),
        (11, "123 456 !!", "en", "s"),
        (12, PASSAGE, "en", "s"),
        (13, "before " + PASSAGE, "en", "s"),
        (14, PASSAGE + " after", "en", "s"),
    ]
    for i in range(120):
        text = rnd.choice(prose)
        if rnd.random() < 0.5:
            at = rnd.randint(0, len(text))
            text = text[:at] + rnd.choice([" changed ", PASSAGE, "\n\n", "  "]) + text[at:]
        rows.append((100 + i * 7 % 113, text, rnd.choice(["en", "de", None]), "s"))
    return [(*row, i, i, "k", None) for i, row in enumerate(rows)]


SCHEMA = "doc_id long, text string, lang string, source string, id long, start long, key string, component long"


def stored(spark, folder, rows=None, schema=SCHEMA, files: int = 3):
    """The rows as a table of several files."""
    path = f"{folder}/table"
    spark.createDataFrame(documents() if rows is None else rows, schema).repartition(files).write.parquet(path)
    return spark.read.parquet(path)
