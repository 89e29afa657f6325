"""DuckDB SQL that states the queries of this subpackage independently, where SQL can.

Not stated: language ID (fitted machines), mixing (a hash that DuckDB lacks), SimHash (likewise),
token archives (a tokenizer) and context trees (logarithms of gamma functions); tests compare those with brute force.
"""

from __future__ import annotations

from panelcast.llm.licence_digests import LICENCE_DIGESTS
from panelcast.llm.licence_texts import KNOWN_LICENCES
from panelcast.llm.licences import SPELLINGS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = """
WITH RECURSIVE v AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
u AS (
  SELECT * FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.r AS a, b.r AS b FROM u a JOIN u b ON a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (SELECT r, r FROM v UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT reach.a AS r, MIN(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY 1),
n AS (SELECT a AS r, COUNT(*) AS n FROM l GROUP BY 1)
SELECT v.vec_id, CAST(COALESCE(n.n, 0) AS BIGINT) AS n_links, c.component_id,
       v.vec_id IS NOT DISTINCT FROM c.component_id AS kept
FROM v JOIN c USING (r) LEFT JOIN n USING (r)"""

OP2 = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(COALESCE(html, ''))) AS BIGINT) AS payload_bytes, sha1(encode(COALESCE(html, ''))) AS h
  FROM pages),
d AS (
  SELECT *, list_transform(range(0, 40), lambda i: strpos('0123456789abcdef', substr(h, i + 1, 1)) - 1) AS x FROM p),
b AS (
  SELECT *, list_aggregate(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
      ((x[(i * 5) // 4 + 1] * 16 + COALESCE(x[(i * 5) // 4 + 2], 0)) >> (8 - 5 - (i * 5) % 4)) & 31 AS INTEGER), 1)),
    'string_agg', '') AS payload_digest FROM d),
f AS (SELECT *, MIN(page_id) OVER (PARTITION BY payload_digest) AS first FROM b)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to, TRUE AS verified
FROM f"""


def _crc_table() -> list[int]:
    """What four steps of the reversed polynomial make of each 4-bit value."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


OP3 = f"""
WITH t AS (
  SELECT doc_id, COALESCE(text, '') AS text, row_number() OVER () AS r FROM documents),
s AS (SELECT *, CAST(octet_length(encode(text)) + 1 AS BIGINT) AS size FROM t),
-- the two halves of each byte, the low one first
h AS (
  SELECT *, list_transform(string_split(regexp_replace(lower(hex(encode(text))), '(.)(.)', '\\2\\1', 'g'), ''),
                           lambda c: CAST(strpos('0123456789abcdef', c) - 1 AS BIGINT)) AS halves FROM s),
c AS (
  SELECT doc_id, r, size, CASE WHEN text = '' THEN 0 ELSE xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), halves),
    lambda crc, x: xor(crc >> 4, (CAST({_crc_table()} AS BIGINT[]))[(xor(crc, x) & 15) + 1]))) END AS text_crc32 FROM h),
o AS (
  SELECT *, COALESCE(SUM(size) OVER (ORDER BY doc_id NULLS FIRST, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         SUM(size) OVER () AS total FROM c),
p AS (SELECT *, CAST((before * 8) // total AS INTEGER) AS shard FROM o)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY before, doc_id, r) - 1 AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM p"""


# A line that names a holder or a year, as a whole: marks of a comment, then one of four kinds of notice.
_YEAR = "(?:(?:19|20)[0-9]{2}|[<{\\[](?:year|yyyy))"
_HOLDERS = "the[ \\t].*(?:authors|contributors|developers|foundation|project|team)[ \\t.,]*"
_NOTICE = (
    "[ \\t/*#;%!|>''-]*(?:"
    f"(?:portions[ \\t]+)?copyright[ \\t:]*(?:(?:\\(c\\)|©|&copy;|by[ \\t]|{_YEAR}).*|{_HOLDERS})"
    f"|\\(c\\)[ \\t]*(?:copyright|by[ \\t]|{_YEAR}).*"
    "|©.*"
    "|all rights reserved[ \\t.,;!*/#-]*)"
)


def _canonical(text: str) -> str:
    """Line by line: notices go; then words alone, of which equivalent spellings become one."""
    out = f"string_split(translate({text}, '{_UPPER}' || chr(13), '{_LOWER}' || chr(10)), chr(10))"
    out = f"array_to_string(list_transform({out}, lambda x: CASE WHEN regexp_full_match(x, '{_NOTICE}') THEN '' ELSE x END), chr(10))"
    out = f"' ' || regexp_replace({out}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g') || ' '"
    for old, new in SPELLINGS:
        for _ in range(2):
            out = f"replace({out}, ' {old} ', ' {new} ')"
    return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


OP4 = f"""
WITH k AS (
  SELECT d, MIN(licence) AS licence FROM (
    SELECT sha256({_canonical("text")}) AS d, licence
    FROM (VALUES {", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in KNOWN_LICENCES)}) AS x(licence, text)
    UNION ALL
    SELECT * FROM (VALUES {", ".join(f"({_quoted(d)}, {_quoted(n)})" for n, d in LICENCE_DIGESTS)}) AS y(d, licence)) GROUP BY 1),
t AS (SELECT doc_id, sha256({_canonical("text")}) AS canonical_sha256 FROM documents)
SELECT doc_id, canonical_sha256, licence FROM t LEFT JOIN k ON d = canonical_sha256"""

OP5 = """
WITH t AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (
  SELECT r, doc_id, i, array_to_string(w[i : i + 12], ' ') AS k
  FROM (SELECT *, UNNEST(range(1, len(w) - 11)) AS i FROM t WHERE len(w) >= 13)),
m AS (SELECT k, MIN(doc_id) AS least FROM g GROUP BY k),
x AS (SELECT DISTINCT r, i + o AS i FROM g JOIN m USING (k), range(0, 13) AS s(o) WHERE least < doc_id OR (doc_id IS NULL AND least IS NOT NULL)),
e AS (SELECT r, i, w[i] AS word FROM (SELECT r, w, UNNEST(range(1, len(w) + 1)) AS i FROM t)),
z AS (SELECT e.r, string_agg(word, ' ' ORDER BY e.i) AS kept, COUNT(*) AS n FROM e ANTI JOIN x ON e.r = x.r AND e.i = x.i GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - COALESCE(n, 0) AS BIGINT) AS n_removed,
       sha256(COALESCE(kept, '')) AS kept_sha256
FROM t LEFT JOIN z USING (r)"""

_FOLDED = f"regexp_extract_all(translate(COALESCE(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP10 = f"""
WITH b AS (SELECT item_id, {_FOLDED} AS w FROM benchmark),
k AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS k
  FROM (SELECT *, UNNEST(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
t AS (SELECT doc_id, row_number() OVER () AS r, {_FOLDED} AS w FROM documents),
s AS (SELECT DISTINCT n FROM k),
g AS (
  SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS k
  FROM (SELECT r, w, n, UNNEST(range(1, len(w) - n + 2)) AS i FROM t, s WHERE len(w) >= n)),
f AS (SELECT r, i, g.n, item_id FROM g JOIN k ON g.k = k.k AND g.n = k.n),
h AS (SELECT r, COUNT(DISTINCT i + o) AS n_hit FROM f, range(0, 10) AS x(o) WHERE o < n GROUP BY 1),
d AS (
  SELECT r, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM f WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(COALESCE(n_items, 0) AS BIGINT) AS n_items, sha256(COALESCE(items, '')) AS items_sha256,
       COALESCE(n_hit, 0) > 0 AS contaminated
FROM t LEFT JOIN h USING (r) LEFT JOIN d USING (r)"""

OP11 = """
WITH l(letter, i) AS (VALUES ('A', 1), ('B', 2), ('C', 3), ('D', 4), ('E', 5)),
o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS p
  FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
t AS (SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS text FROM documents),
m AS (SELECT text, MIN(doc_id) AS least FROM t GROUP BY text),
b AS (SELECT doc_id, BOOL_OR(quality = 1) AS good, BOOL_OR(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
w AS (SELECT t.*, least, good, toxic, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM t JOIN m USING (text) LEFT JOIN b USING (doc_id)),
f AS (
  SELECT part, COALESCE(good, FALSE) AS good, COALESCE(toxic, FALSE) AS toxic, [
    len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text),
    regexp_matches(text, '[#$%&*|]'), COALESCE(least < doc_id, FALSE)] AS x FROM w),
g AS (SELECT part, good, toxic, x, COUNT(*) AS n FROM f GROUP BY ALL),
s AS (
  SELECT part, filter_order, step, p[step] AS i, good, toxic, n, x[p[step]] AS here,
         COALESCE(list_bool_or(list_transform(p[1 : step - 1], lambda k: x[k])), FALSE) AS before,
         len(list_filter(x, lambda v: v)) AS failed
  FROM g, o, (SELECT UNNEST(range(1, 6)) AS step)),
r AS (
  SELECT part, filter_order, step, i,
         SUM(n) FILTER (WHERE NOT before AND NOT here) AS kept, SUM(n) FILTER (WHERE NOT before AND here) AS removed,
         SUM(n) FILTER (WHERE before AND here) AS redundant, SUM(n) FILTER (WHERE here AND failed = 1) AS unique_fails,
         SUM(n) FILTER (WHERE NOT before AND here AND good) AS good_lost, SUM(n) FILTER (WHERE NOT before AND here AND toxic) AS toxic_lost
  FROM s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(COALESCE(kept, 0) AS BIGINT) AS kept,
       CAST(COALESCE(removed, 0) AS BIGINT) AS removed, CAST(COALESCE(redundant, 0) AS BIGINT) AS redundant,
       CAST(COALESCE(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(COALESCE(good_lost, 0) AS BIGINT) AS good_lost,
       CAST(COALESCE(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(SUM(COALESCE(removed, 0)) OVER (PARTITION BY part, i) AS BIGINT) AS shapley
FROM r"""


def _path(state: str, cost: str, letter: str, message: str | None = None) -> str:
    """A path (nine digits of cost, initials, a mark, messages) after one more edit; null stays null."""
    mark = f"strpos({state}, chr(1))"
    more = f" || substr({state}, {mark} + 1)" + (f" || CASE WHEN length({state}) > {mark} THEN chr(10) ELSE '' END || {message}" if message else "")
    return f"lpad(CAST(CAST(substr({state}, 1, 9) AS BIGINT) + ({cost}) AS VARCHAR), 9, '0') || substr({state}, 10, {mark} - 10) || '{letter}' || chr(1){more}"


def _least(*paths: str) -> str:
    # '~' stands for no path: it comes after all digits
    return f"nullif(least({', '.join(f'coalesce({p}, chr(126))' for p in paths)}), chr(126))"


_ROW, _OPEN = "role || ':' || text", "NOT must AND"
_ONE, _CUT = "1 + cut", "cut"


def _when(condition: str, path: str) -> str:
    return f"CASE WHEN {condition} THEN {path} END"


OP12 = f"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
         COALESCE(CAST(conv_id AS VARCHAR), ' ') || ':' || COALESCE(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
h AS (
  SELECT *, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(
      string_split(regexp_replace(lower(hex(encode(k))), '(.)(.)', '\\2\\1', 'g'), ''), lambda c: CAST(strpos('0123456789abcdef', c) - 1 AS BIGINT))),
    lambda crc, x: xor(crc >> 4, (CAST({_crc_table()} AS BIGINT[]))[(xor(crc, x) & 15) + 1]))) % 20 AS fault FROM c),
d AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM h, range(0, 2) AS x(copy) WHERE fault <> 0 AND (copy = 0 OR fault = 3)),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
e AS (
  SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
         NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS open,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) || substr(role, 1, 1) AS pair FROM n),
r AS (
  SELECT *, blank OR seen AS must, CASE WHEN NOT blank AND NOT seen AND open THEN 5 ELSE 0 END AS cut, substr(role, 1, 1) AS f FROM e),
q AS (
  SELECT conv_id, CAST(COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS BIGINT) AS gaps, COUNT(*) AS n,
         COUNT(*) FILTER (WHERE blank) AS blank, COUNT(*) FILTER (WHERE NOT blank AND seen) AS duplicate,
         COUNT(*) FILTER (WHERE cut > 0) AS truncated, COUNT(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id),
-- the best path to each state: nothing yet, after system, after user, after assistant
v AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '000000000' || chr(1) AS z, CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS u,
         CAST(NULL AS VARCHAR) AS a FROM c
  UNION ALL
  SELECT conv_id, i,
         {_path("z", "2", "D")},
         {_least(_when(f"{_OPEN} f = 's'", _path("z", _CUT, "K", _ROW)), _path("s", "2", "D"))},
         {_least(_path("iu", "2", "D"), *[_when(f"{_OPEN} f = 'u'", _path(x, _CUT, "K", _ROW)) for x in ("z", "s", "ia")],
                 *[_when("NOT must", _path(x, _ONE, "R", "'user:' || text")) for x in ("z", "s", "ia")])},
         {_least(_path("ia", "2", "D"), _when(f"{_OPEN} f = 'a'", _path("iu", _CUT, "K", _ROW)),
                 _when("NOT must", _path("iu", _ONE, "R", "'assistant:' || text")))}
  FROM (
    SELECT r.*, z, s, {_least("u", *[_path(x, "5", "I", "'user:'") for x in ("z", "s", "a")])} AS iu,
           {_least("a", _path("u", "5", "I", "'assistant:'"))} AS ia
    FROM v JOIN r ON r.conv_id IS NOT DISTINCT FROM v.conv_id AND r.i = v.i + 1)),
w AS (
  SELECT v.conv_id, {_least("z", "a", _path("u", "5", "I", "'assistant:'"))} AS p, q.*
  FROM v LEFT JOIN q ON q.conv_id IS NOT DISTINCT FROM v.conv_id WHERE v.i = COALESCE(q.n, 0))
SELECT conv_id, COALESCE(gaps, 0) AS gaps, COALESCE(blank, 0) AS blank, COALESCE(duplicate, 0) AS duplicate,
       COALESCE(truncated, 0) AS truncated, COALESCE(illegal, 0) AS illegal, CAST(substr(p, 1, 9) AS BIGINT) AS cost,
       substr(p, 10, strpos(p, chr(1)) - 10) AS audit, sha256(substr(p, strpos(p, chr(1)) + 1)) AS repaired_sha256
FROM w"""

ORACLE_SQL = {
    "op1_vectors": OP1,
    "op2_warc": OP2,
    "op3_sharding": OP3,
    "op4_licences": OP4,
    "op5_substrings": OP5,
    "op10_decontamination": OP10,
    "op11_filters": OP11,
    "op12_conversations": OP12,
}
