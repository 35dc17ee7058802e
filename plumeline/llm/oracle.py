"""DuckDB statements for the corpus queries that SQL can express: brute force, without the operators' methods."""

from __future__ import annotations

_ESC = r"regexp_replace({x}, '([<\[])(\\*)(\|[A-Za-z0-9_]+\|>|/?INST\]|/?s>)', '\1\\\2\3', 'g')"

OP1 = f"""
WITH raw AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum(23 + length({_ESC.format(x="role")}) + length({_ESC.format(x="text")})) AS BIGINT) AS formatted_chars
FROM raw GROUP BY conv_id
"""

# Word positions of every document and the run of 13 words that starts at each (fewer near the end).
_SPACED = r"""
words AS (
  SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS p
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)),
grams AS (
  SELECT doc_id, w, p, list(w) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS g FROM words)
"""

OP4 = f"""
WITH {_SPACED},
keyed AS (SELECT doc_id, p, array_to_string(g, ' ') AS k FROM grams WHERE len(g) = 13),
least AS (SELECT k, min(doc_id) AS least FROM keyed GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p FROM keyed JOIN least USING (k) WHERE least < doc_id),
marked AS (SELECT words.*, gone.p IS NOT NULL AS gone FROM words LEFT JOIN gone USING (doc_id, p)),
agg AS (
  SELECT doc_id, count(*) AS n_words, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_removed,
         string_agg(CASE WHEN NOT gone THEN w END, ' ' ORDER BY p) AS kept FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN agg USING (doc_id)
"""

_PIECES = r"[^.!?]{1,160}[.!?]{0,8}[ \t]{0,8}|[.!?]{1,8}[ \t]{0,8}"

OP6 = f"""
WITH ordered AS (
  SELECT doc_id, coalesce(text, '') AS text,
         coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id), first_value(coalesce(text, '')) OVER (ORDER BY doc_id)) AS next_text
  FROM documents),
texts AS (
  SELECT *, left(text, length(text) - length(text) // 4) || left(next_text, length(text) // 4) AS edited FROM ordered),
long AS (
  SELECT doc_id, 'text' AS kind, text AS t FROM texts UNION ALL SELECT doc_id, 'edited', edited FROM texts
  UNION ALL SELECT doc_id, 'next', next_text FROM texts),
leaves AS (
  SELECT doc_id, kind, list_transform(string_split(t, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)), lambda p:
           list_transform(CASE WHEN p = '' THEN [''] ELSE regexp_extract_all(p, '{_PIECES}') END, lambda x: sha256(x)))) AS tree FROM long),
hashed AS (
  SELECT doc_id, kind, flatten(flatten(tree)) AS leaf,
         sha256('d' || array_to_string(list_transform(tree, lambda s: sha256('s' || array_to_string(list_transform(s, lambda p:
           sha256('p' || array_to_string(p, ','))), ','))), ',')) AS root FROM leaves),
wide AS (
  SELECT doc_id, max(root) FILTER (kind = 'text') AS fingerprint, max(root) FILTER (kind = 'edited') AS edited_fingerprint,
         max(leaf) FILTER (kind = 'text') AS a, max(leaf) FILTER (kind = 'edited') AS b, max(leaf) FILTER (kind = 'next') AS c
  FROM hashed GROUP BY doc_id)
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, fingerprint, edited_fingerprint,
       CAST(2 * len(list_intersect(a, b)) AS DOUBLE) / (len(list_distinct(a)) + len(list_distinct(b))) AS near_edited,
       CAST(2 * len(list_intersect(a, c)) AS DOUBLE) / (len(list_distinct(a)) + len(list_distinct(c))) AS near_next
FROM texts JOIN wide USING (doc_id)
"""

_ALNUM = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP8 = f"""
WITH item_words AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, array_to_string(list_slice(w, p, p + least(len(w), 13) - 1), ' ') AS k, least(len(w), 13) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM item_words WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
words AS (
  SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS p FROM (SELECT doc_id, {_ALNUM} AS w FROM documents)),
grams AS (
  SELECT doc_id, p, list(w) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS g FROM words),
found AS (
  SELECT doc_id, p, windows.n, item_id FROM grams JOIN lengths ON len(g) >= lengths.n
  JOIN windows ON windows.n = lengths.n AND windows.k = array_to_string(list_slice(g, 1, lengths.n), ' ')),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id),
counted AS (SELECT doc_id, count(*) AS n_words FROM words GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(n_words, 0) AS contaminated
FROM documents d LEFT JOIN counted USING (doc_id) LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

def _op11() -> str:
    """Dynamic programme over each conversation's turns; a state holds cost and audit as one sortable text, and the turns."""
    low = lambda *xs: f"list_sort([{', '.join(xs)}], 'ASC', 'NULLS LAST')[1]"
    cost = lambda x: f"CAST(substr(({x}).k, 1, 9) AS BIGINT)"

    def add(x: str, more: str, letter: str, line: str = "''", when: str = "true") -> str:
        return (f"CASE WHEN {when} AND ({x}) IS NOT NULL THEN {{'k': lpad(CAST({cost(x)} + {more} AS VARCHAR), 9, '0') || "
                f"substr(({x}).k, 10) || '{letter}', 'r': ({x}).r || {line}}} END")

    turn = lambda role, text: f"chr(10) || {role} || ':' || {text}"
    before_user, cut = low("z.e", "z.s", "z.a"), "(CASE WHEN x.c BETWEEN 'A' AND 'Z' THEN 1 ELSE 0 END)"
    put = {"u": "'user'", "a": "'assistant'"}

    def step(state: str, came: str, kinds: str, role: str | None) -> str:
        ways = [add(f"z.{state}", "3", "D"), add(came, cut, "K", turn("x.role", "x.text"), f"x.c IN ({kinds})")]
        if role:
            ways.append(add(came, f"2 + {cut}", "R", turn(role, "x.text"), "x.c <> 'd'"))
        insert = low(f"z.{state}", add(came, "2", "I", turn(role, "''"))) if role else f"z.{state}"
        return f"'{state}': CASE WHEN x.c = 'i' THEN {insert} ELSE {low(*ways)} END"

    move = ", ".join([f"'e': CASE WHEN x.c = 'i' THEN z.e ELSE {add('z.e', '3', 'D')} END", step("s", "z.e", "'s', 'S'", None),
                      step("u", before_user, "'u', 'U'", put["u"]), step("a", "z.u", "'a', 'A'", put["a"])])
    state = "STRUCT(k VARCHAR, r VARCHAR)"
    start = f"CAST({{'e': {{'k': '000000000', 'r': ''}}, 's': NULL, 'u': NULL, 'a': NULL}} AS STRUCT(e {state}, s {state}, u {state}, a {state}))"
    gap = "{'c': 'i', 'role': '', 'text': ''}"
    return f"""
WITH tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
crc AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: CAST(ord(substr(k, i, 1)) AS BIGINT)),
         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS m FROM raw, tab),
damaged AS (
  SELECT conv_id, turn, CASE WHEN m = 4 THEN 'user' ELSE role END AS role,
         CASE m WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN m = 3 THEN 2 ELSE 1 END)) AS copy FROM crc WHERE m <> 0),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
         right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS ends FROM damaged),
marked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again,
         lag(role) OVER (PARTITION BY conv_id ORDER BY n) AS prior FROM ordered),
classed AS (
  SELECT *, CASE WHEN ends = '' OR again THEN 'd' ELSE
              CASE WHEN ends IN ('.', '!', '?') THEN lower(kind) ELSE upper(kind) END END AS c
  FROM (SELECT *, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS kind FROM marked)),
convs AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (ends = '') AS blank,
         count(*) FILTER (ends <> '' AND again) AS duplicate, count(*) FILTER (c BETWEEN 'A' AND 'Z') AS truncated,
         count(*) FILTER (n > 1 AND left(prior, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal,
         list({{'c': c, 'role': role, 'text': text}} ORDER BY n) AS turns FROM classed GROUP BY conv_id),
folded AS (
  SELECT * EXCLUDE turns, list_reduce(list_concat([{gap}, {gap}], flatten(list_transform(turns, lambda y: [y, {gap}, {gap}]))),
         lambda z, x: {{{move}}}, {start}) AS z FROM convs),
best AS (SELECT *, {low("z.e", "z.a")} AS w FROM folded)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce({cost("w")}, 0) AS cost,
       coalesce(substr(w.k, 10), '') AS audit, sha256(coalesce(substr(w.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d LEFT JOIN best ON d.conv_id IS NOT DISTINCT FROM best.conv_id
"""


OP13 = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
occ AS (SELECT lang, source, doc, unnest(w) AS t FROM d),
kept AS (SELECT lang, t FROM occ GROUP BY lang, t HAVING count(DISTINCT doc) >= 30),
counts AS (SELECT lang, source, t, count(*) AS n FROM occ SEMI JOIN kept USING (lang, t) GROUP BY lang, source, t),
groups AS (SELECT DISTINCT lang, source FROM d),
dense AS (
  SELECT g.lang, g.source, k.t, coalesce(c.n, 0) AS n FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, t)),
sized AS (SELECT lang, source, t, n, sum(n) OVER (PARTITION BY lang, source) AS big, count(*) OVER (PARTITION BY lang, source) AS v FROM dense),
own AS (
  SELECT lang, source, t, n, CAST(1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (CAST(big AS HUGEINT) + 5 * v) AS BIGINT) AS p FROM sized),
lang_n AS (SELECT lang, t, sum(n) AS n FROM dense GROUP BY lang, t),
lang_sized AS (SELECT lang, t, n, sum(n) OVER (PARTITION BY lang) AS big, count(*) OVER (PARTITION BY lang) AS v FROM lang_n),
lang_p AS (SELECT lang, t, CAST(1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (CAST(big AS HUGEINT) + 5 * v) AS BIGINT) AS q FROM lang_sized),
distances AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
  FROM own a JOIN own b USING (lang, t) WHERE a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN distances x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, t AS item, p - q AS value FROM own JOIN lang_p USING (lang, t) WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

ORACLE: dict[str, str] = {
    "op1_chat_formatting": OP1,
    "op4_substring_dedup": OP4,
    "op6_document_fingerprints": OP6,
    "op8_benchmark_decontamination": OP8,
    "op11_conversation_repair": _op11(),
    "op13_source_divergence": OP13,
}
