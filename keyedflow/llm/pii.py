"""Personal data by regular expressions, checksum validators and context words, in DataFrame functions only.

A pattern's matches are marked in the text, which is then cut at the marks, so that one pass of the
expression gives matches, their places and the text around them. Validators drop matches that cannot be what
they look like; context words nearby raise the score of the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyedflow.llm.common import text_of

# Patterns of the base kinds. Where no shorter or later start can match, they start at the first
# character of a run (or where the last match ended) and don't step back, so long runs take linear time.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
# Country, check digits, 11 to 30 letters or digits, in groups or not.
IBAN = r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9_])"

#: In the order in which equal starts are listed: a cheap test, the pattern, the score without context, context words.
KINDS = {
    "email": ("@", EMAIL, 0.9, ("mail", "contact", "write")),
    "ip": (r"[0-9]\.[0-9]", IP, 0.6, ("ip", "address", "server", "host")),
    "card": (r"(?:[0-9][ -]?){13}[0-9]", CARD, 0.8, ("card", "credit", "visa", "pay")),
    "phone": (r"\+[0-9]", PHONE, 0.6, ("phone", "call", "tel", "mobile", "fax")),
    "iban": (r"[A-Z]{2}[0-9]{2}", IBAN, 0.9, ("iban", "bank", "account", "konto")),
}
BASE = ("email", "ip", "card", "phone")
#: Characters on either side that are searched for context words, and what a word adds to the score.
CONTEXT, CONTEXT_SCORE = 40, 0.1

MARK, NOT_MARK = "\u0001", "\u0002"
OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)"


def digits_of(text: Column) -> Column:
    return F.translate(text, " -", "")


def luhn(text: Column) -> Column:
    """14 to 19 digits whose weighted sum is a multiple of ten."""
    digits = F.reverse(digits_of(text))
    digit = lambda i: F.substring(digits, i, 1).cast("int")
    doubled = lambda d: d * 2 - F.when(d > 4, 9).otherwise(0)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda s, i: s + F.when(i % 2 == 1, digit(i)).otherwise(doubled(digit(i))),
    )
    # Long runs of digits are refused by their length before any sum is formed.
    return F.when(F.length(digits).between(14, 19), total % 10 == 0).otherwise(False)


def octets(text: Column) -> Column:
    """Four numbers of at most 255, leading zeros allowed."""
    return text.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")


def dialled(text: Column) -> Column:
    return F.length(F.translate(text, "+ ().-", "")).between(10, 15)


def mod97(text: Column) -> Column:
    """The number made of a bank account number, its first four characters last, leaves 1 modulo 97."""
    plain = F.translate(text, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    value = lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
    rest = F.aggregate(
        F.sequence(F.lit(1), F.length(turned)),
        F.lit(0),
        lambda r, i: (
            r * F.when(value_at(turned, i, value) > 9, 100).otherwise(10) + value_at(turned, i, value)
        )
        % 97,
    )
    return rest == 1


def value_at(text: Column, i: Column, value) -> Column:
    return value(F.substring(text, i, 1)).cast("int")


VALID = {"email": lambda x: F.lit(True), "ip": octets, "card": luhn, "phone": dialled, "iban": mod97}

SPANS = "array<struct<start:bigint,end:bigint,value:string>>"


def marked_parts(text: Column, kind: str) -> Column:
    """The text cut before and after each match: odd elements (from zero) are matches."""
    hint, pattern, _, _ = KINDS[kind]
    marked = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)
    return F.when(text.rlike(hint), marked).otherwise(F.array().cast("array<string>"))


def found_spans(parts: str) -> Column:
    """Start, end and text of every match of a column of parts, in code points."""
    return F.expr(
        f"""aggregate(
            {parts},
            struct(0L as at, false as inside, cast(array() as {SPANS}) as spans),
            (acc, x) -> struct(
                acc.at + length(x) as at,
                not acc.inside as inside,
                if(acc.inside, concat(acc.spans, array(struct(acc.at as start, acc.at + length(x) as end, x as value))), acc.spans) as spans
            )
        ).spans"""
    )


def scored_spans(kind: str, parts: str, spans: str) -> Column:
    """Validated spans of a kind with their scores, as structs that sort by start and then by kind."""
    _, _, score, words = KINDS[kind]
    order = list(KINDS).index(kind)
    around = lambda i: F.lower(
        F.concat(
            F.substring(F.element_at(parts, i * 2 + 1), -CONTEXT, CONTEXT),
            F.lit(" "),
            F.substring(F.element_at(parts, i * 2 + 3), 1, CONTEXT),
        )
    )
    context = rf"(?<![a-z])(?:{'|'.join(words)})"
    entries = F.transform(
        F.col(spans),
        lambda s, i: F.struct(
            s["start"].alias("start"),
            F.lit(order).alias("order"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
            s["value"].alias("value"),
            F.round(F.lit(score) + F.when(around(i).rlike(context), CONTEXT_SCORE).otherwise(0.0), 2).alias("score"),
        ),
    )
    return F.filter(entries, lambda s: VALID[kind](s["value"]))


def find_personal_data(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans``: start, order of the kind, end (exclusive), kind, value and score, in order.

    Places are in code points of the whole text. Null and empty texts have no spans; further columns of the
    input are ignored; a row is one row whatever its identifier. Matches of one kind don't overlap; those of
    different kinds may.
    """
    text = text_of(text_col)
    # The mark is in none of the patterns, so another such character in its place changes no match.
    clean = F.when(F.contains(text, F.lit(MARK)), F.translate(text, MARK, NOT_MARK)).otherwise(text)
    cut = rows.select(F.col(id_col).cast("long").alias("doc_id"), clean.alias("text")).select(
        "doc_id", *(marked_parts(F.col("text"), kind).alias(f"{kind}_parts") for kind in KINDS)
    )
    found = cut.select("*", *(found_spans(f"{kind}_parts").alias(f"{kind}_spans") for kind in KINDS))
    each = [scored_spans(kind, f"{kind}_parts", f"{kind}_spans") for kind in KINDS]
    return found.select("doc_id", F.array_sort(F.concat(*each)).alias("spans"))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_data(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and the list of all spans, per row."""
    found = find_personal_data(rows, id_col, text_col)
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *(of(kind).alias(f"n_{kind}") for kind in BASE),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
