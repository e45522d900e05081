"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP10 = f"""
WITH t AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents
)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       text_sha256
FROM t WINDOW same AS (PARTITION BY text_sha256)
"""

WORD = "[0-9a-z\\x{80}-\\x{10FFFF}]+"


def _words(table: str, key: str) -> str:
    return (
        f"SELECT {key} AS k, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w"
        f" FROM {table}"
    )


OP3 = f"""
WITH docs AS ({_words("documents", "doc_id")}),
items AS ({_words("benchmark", "item_id")}),
windows AS (
    SELECT DISTINCT k AS item, least(10, len(w)) AS size,
           array_to_string(w[i + 1 : i + least(10, len(w))], ' ') AS win
    FROM (SELECT k, w, unnest(range(0, len(w) - least(10, len(w)) + 1)) AS i FROM items WHERE len(w) > 0)
),
words AS (SELECT k, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM docs),
grams AS (
    SELECT k, i, list(word) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS g FROM words
),
sized AS (
    SELECT k, i, size, array_to_string(g[1 : size], ' ') AS win
    FROM grams, (SELECT DISTINCT size FROM windows) WHERE len(g) >= size
),
found AS (SELECT s.k, s.i, s.size, w.item FROM sized s JOIN windows w ON s.win = w.win AND s.size = w.size),
hits AS (
    SELECT k, count(*) AS n FROM (SELECT DISTINCT k, unnest(range(i, i + size)) AS i FROM found) GROUP BY k
),
named AS (
    SELECT k, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT k, CAST(item AS VARCHAR) AS item FROM found) GROUP BY k
)
SELECT d.k AS doc_id,
       CAST(len(d.w) AS BIGINT) AS n_words,
       coalesce(h.n, 0) AS n_hit,
       coalesce(n.n, 0) AS n_items,
       sha256(coalesce(n.ids, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h ON h.k = d.k LEFT JOIN named n ON n.k = d.k
"""

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"
CARD = r"[0-9](?:[ -]?[0-9])+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
IBAN = r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b"
KINDS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "iban": IBAN}


def _parts(kind: str) -> str:
    return f"string_split(regexp_replace(t, '({KINDS[kind]})', chr(1) || '\\1' || chr(1), 'g'), chr(1)) AS {kind}"


def _spans(kind: str, order: int) -> str:
    return (
        f"list_transform(range(1, len({kind}) // 2 + 1), lambda i: {{"
        f"'start': CAST(list_sum(list_transform({kind}[1 : 2 * i - 1], lambda x: length(x))) AS BIGINT),"
        f" 'ord': {order}, 'stop': CAST(list_sum(list_transform({kind}[1 : 2 * i], lambda x: length(x))) AS BIGINT),"
        f" 'kind': '{kind}', 'v': {kind}[2 * i]}})"
    )


_DIGITS = "regexp_replace(s.v, '[^0-9]', '', 'g')"
_DOUBLED = "CASE WHEN i % 2 = 1 THEN d ELSE d * 2 - CASE WHEN d > 4 THEN 9 ELSE 0 END END".replace(
    "d ", f"CAST(reverse({_DIGITS})[i] AS INT) "
)
_LUHN = (
    f"(length({_DIGITS}) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: {_DOUBLED})) % 10 = 0)"
)
_OCTETS = r"regexp_full_match(s.v, '0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}')"
_PLAIN = "replace(s.v, ' ', '')"
_NUMBER = (
    f"array_to_string(list_transform(string_split({_PLAIN}[5:] || {_PLAIN}[1:4], ''),"
    " lambda c: CAST(strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', c) - 1 AS VARCHAR)), '')"
)
_MOD97 = (
    f"list_reduce(list_prepend(CAST(0 AS HUGEINT), list_transform(string_split({_NUMBER}, ''), lambda c: CAST(c AS HUGEINT))),"
    " lambda a, b: (a * 10 + b) % 97) = 1"
)
_VALID = {
    "email": "true",
    "ip": _OCTETS,
    "card": _LUHN,
    "phone": f"length({_DIGITS}) BETWEEN 10 AND 15",
    "iban": _MOD97,
}
_LISTED = "array_to_string(list_transform({spans}, lambda s: s.kind || ':' || s.start || ':' || s.stop), ',')"
_BASE = "list_filter(spans, lambda s: s.kind <> 'iban')"

OP9 = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), chr(1), chr(2)) AS t FROM documents),
cut AS (SELECT doc_id, {", ".join(_parts(k) for k in KINDS)} FROM d),
found AS (
    SELECT doc_id, list_sort({" || ".join(f"list_filter({_spans(k, i)}, lambda s: {_VALID[k]})" for i, k in enumerate(KINDS))}) AS spans
    FROM cut
)
SELECT doc_id,
       {", ".join(f"CAST(len(list_filter(spans, lambda s: s.kind = '{k}')) AS BIGINT) AS n_{k}" for k in ("email", "ip", "card", "phone"))},
       sha256({_LISTED.format(spans=_BASE)}) AS base_sha256,
       {_LISTED.format(spans="spans")} AS spans
FROM found
"""

OP11 = """
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
           sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
),
d AS (
    SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                  OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
                WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM t
),
c AS (
    SELECT *, array_to_string(u[1 : least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1 : greatest(a, b)], '') AS m,
           array_to_string(u[greatest(a, b) + 1 :], '') AS s
    FROM d
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM c
"""


def _vector_codes(rounds: int) -> str:
    """Assignment and update, once more per round: ``c0`` to ``c<rounds>`` are the codebooks, ``a0`` on the assignments."""
    steps = [
        """
kept AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pieces AS MATERIALIZED (
    SELECT vec_id, label, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS piece FROM kept, range(8) AS r(p)
),
c0 AS MATERIALIZED (
    SELECT p, dense_rank() OVER (ORDER BY vec_id) - 1 AS e, piece AS entry FROM pieces
    WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 16)
)"""
    ]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
    SELECT vec_id, label, p, any_value(piece) AS piece,
           min(CAST(list_sum(list_transform(list_zip(piece, entry), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)
               * 16 + e) AS found
    FROM pieces JOIN c{i} USING (p) GROUP BY vec_id, label, p
)""")
        if i < rounds:
            steps.append(f"""
s{i} AS (
    SELECT p, found % 16 AS e, j, CAST(sum(piece[j]) AS BIGINT) AS s, count(*) AS n
    FROM a{i}, unnest(range(1, len(piece) + 1)) AS u(j) GROUP BY ALL
),
c{i + 1} AS MATERIALIZED (
    SELECT c.p, c.e, coalesce(moved.entry, c.entry) AS entry
    FROM c{i} c LEFT JOIN (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY j) AS entry FROM s{i} GROUP BY p, e)
         AS moved USING (p, e)
)""")
    return "WITH" + ",".join(steps) + f""",
coded AS (
    SELECT vec_id, label, lower(string_agg(lpad(to_hex(found % 16), 2, '0'), '' ORDER BY p)) AS code,
           CAST(sum(found // 16) AS BIGINT) AS error
    FROM a{rounds} GROUP BY vec_id, label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) FROM c{rounds}) AS codebooks_sha256
FROM coded
"""


OP12 = _vector_codes(rounds=6)

ORACLES = {
    "op3_decontamination": OP3,
    "op9_personal_data": OP9,
    "op10_exact_dedup": OP10,
    "op11_fill_in_middle": OP11,
    "op12_vector_codes": OP12,
}
