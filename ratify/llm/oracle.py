"""DuckDB SQL of the queries that SQL can express.

Not here: token counts and byte-level BPE (merging by rank), language
identification (compression), secret scans (match offsets), source mixing
(rounding in hash order), alignment of two tokenizers.  Their tests hold them against the libraries or a
brute-force version.
"""

from __future__ import annotations

from ratify.llm.quality_rules import BOILERPLATE, LineRules

_BLANK = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"
_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _escaped(column: str) -> str:
    return rf"replace(replace(replace(coalesce({column}, ''), '\', '\b'), '###', '\h'), '</turn>', '\e')"


CHAT = rf"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
filled AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM rows)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS LAST, role, text)) AS loss_sha256,
  sum(4 + length(replace({_escaped('role')}, ':', '\c')) + 2 + length({_escaped('text')}) + 8)::BIGINT AS formatted_chars
FROM filled GROUP BY conv_id
"""

NEAR = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
sizes AS (SELECT doc_id, len(s)::BIGINT AS n_shingles FROM sets),
flat AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n_both
  FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
  WHERE 100 * n_both >= 75 * (x.n_shingles + y.n_shingles - n_both)),
ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, w.v FROM reach r JOIN ways w ON w.u = r.b),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, n_shingles, component_id, s.doc_id = component_id AS kept FROM sizes s JOIN least l ON l.doc_id = s.doc_id
"""

EXACT = rf"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '{_BLANK}', '', 'g') AS bare FROM documents),
r AS (SELECT doc_id, bare, first_value(doc_id) OVER (PARTITION BY bare ORDER BY n DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY bare)::BIGINT AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256 FROM r
"""


def _quality() -> str:
    rules = LineRules()
    quote = lambda text: text.replace("'", "''")
    one_of = lambda chars: "[" + quote("".join("\\" + c if c in "]\\^-[" else c for c in chars)) + "]"
    phrases = quote("|".join(BOILERPLATE))
    return rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, text, regexp_extract_all(text, '{_WORD}') AS w FROM docs),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM words WHERE len(w) >= 8),
keyed AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS k FROM windows),
twice AS (SELECT doc_id, i FROM keyed QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
repeated AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, place, line, len(regexp_extract_all(line, '{_WORD}')) AS n, trim(line, {_SPACES}) AS bare
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS place
        FROM docs)),
judged AS (SELECT doc_id, n, row_number() OVER (PARTITION BY doc_id, line ORDER BY place) > 1 AS dup,
  (n < {rules.fragment_words} AND NOT regexp_matches(right(bare, 1), '{one_of(rules.ends)}'))
  OR 100 * len(regexp_extract_all(line, '[#*$%&|<>]')) > {rules.symbols_percent} * (length(bare) - n + 1)
  OR (len(regexp_extract_all(line, '{one_of(rules.separators)}')) >= {rules.least_separators}
      AND len(regexp_extract_all(line, '{one_of(rules.separators)}')) * {rules.words_per_separator} >= n)
  OR (n <= {rules.boilerplate_words} AND regexp_matches(lower(bare), '{phrases}')) AS fails
  FROM lines WHERE n > 0),
by_doc AS (SELECT doc_id, sum(dup::INT) AS dups, sum(CASE WHEN fails THEN n ELSE 0 END) AS lost FROM judged GROUP BY doc_id),
figures AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(d.text, '{_BLANK}', '', 'g'))::BIGINT AS word_chars,
  len(regexp_extract_all(d.text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dups, 0)::BIGINT AS n_dup_lines,
  coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM words d LEFT JOIN repeated r ON r.doc_id = d.doc_id LEFT JOIN by_doc b ON b.doc_id = d.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * lost <= {rules.lost_percent} * n_words AS kept FROM figures
"""


LINES = rf"""
WITH lines AS (
  SELECT doc_id, place, line, translate(trim(line, {_SPACES}), '{_UPPER}', '{_LOWER}') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
          unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS place FROM documents)),
owners AS (SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10 GROUP BY key),
judged AS (SELECT l.doc_id, place, line, coalesce(owner < l.doc_id, false) AS lost FROM lines l LEFT JOIN owners o ON o.key = l.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, sum(lost::INT)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

LEAKS = rf"""
WITH docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_LETTERS}') AS w FROM documents),
items AS (SELECT coalesce(item_id::VARCHAR, '') AS item_id,
  regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_LETTERS}') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS k FROM items WHERE len(w) > 0),
asked AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS words
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sized)),
lengths AS (SELECT DISTINCT k FROM sized),
windows AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS words
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, lengths WHERE len(w) >= k)),
found AS (SELECT doc_id, i, k, item_id FROM windows JOIN asked USING (k, words)),
hits AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(f.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h ON h.doc_id = d.doc_id LEFT JOIN named f ON f.doc_id = d.doc_id
"""

MIDDLE = rf"""
WITH units AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
  regexp_extract_all(coalesce(text, ''), '{_BLANK}*{_WORD}|{_BLANK}+') AS w FROM documents),
drawn AS (SELECT *, len(w) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
  ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM units),
cut AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
    WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, array_to_string(w[1:low], '') AS p, array_to_string(w[low + 1:high], '') AS m,
  array_to_string(w[high + 1:], '') AS s FROM cut)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256 FROM parts
"""

ORACLE_SQL: dict[str, str] = {
    "op1_chat_formatting": CHAT,
    "op3_minhash_near_dedup": NEAR,
    "op7_exact_dedup": EXACT,
    "op9_quality_rules": _quality(),
    "op10_line_dedup": LINES,
    "op11_decontamination": LEAKS,
    "op13_fill_in_middle": MIDDLE,
}
