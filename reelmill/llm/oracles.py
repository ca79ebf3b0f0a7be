"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from reelmill.llm.licence_scan import ABOUT, RULES, SENTENCES, UNKNOWN
from reelmill.llm.line_rules import (
    BOILERPLATE, LEAST_WORDS, LONG_LINE, LOSS, MENU_WORDS, NAVIGATION, REPEATED, SHOUTED,
    SYMBOL_SHARE, VARIETY, WINDOW,
)
from reelmill.llm.paragraph_dedup import LEAST_WORDS as PARAGRAPH_WORDS, PERCENT as PARAGRAPH_PERCENT
from reelmill.llm.secret_scan import ALLOWED, ASSIGN_VALUE, CLASSES, WINDOW as SPAN

CHECKS: dict[str, str] = {}

CHECKS["op2_decontaminate"] = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
starts AS (
  SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS k
  FROM item_words WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
         array_to_string(w[k : k + 9], ' ') AS phrase
  FROM starts),
sizes AS (SELECT DISTINCT size FROM windows),
doc_starts AS (
  SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS k
  FROM doc_words, sizes WHERE len(w) >= size),
hits AS (
  SELECT d.doc_id, d.k, d.size, v.item_id
  FROM (SELECT doc_id, k, size, array_to_string(w[k : k + size - 1], ' ') AS phrase
        FROM doc_starts) d
  JOIN windows v ON v.phrase = d.phrase AND v.size = d.size),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words h ON h.doc_id = d.doc_id
LEFT JOIN hit_items i ON i.doc_id = d.doc_id
"""


def licence_sql() -> str:
    """The sentence and rule tables as CASE and replace expressions."""
    ids = "\n".join(
        f"    WHEN regexp_full_match(s, '{pattern}') THEN '{name}'" for name, pattern in SENTENCES
    )
    steps, source = [], "joined"
    for k, (_, run) in enumerate(RULES):
        mark = "," + ",,".join(run) + ","
        steps.append(f"step{k + 1} AS (SELECT *, replace(r{k}, '{mark}', '#') AS r{k + 1} FROM {source})")
        source = f"step{k + 1}"
    return rf"""
WITH cut AS (
  SELECT doc_id, unnest(string_split(regexp_replace(
    lower(coalesce(text, '')), '([.!?])[ \t]+', '\1' || chr(10), 'g'), chr(10))) AS line,
    generate_subscripts(string_split(regexp_replace(
    lower(coalesce(text, '')), '([.!?])[ \t]+', '\1' || chr(10), 'g'), chr(10)), 1) AS n
  FROM documents),
about AS (
  SELECT doc_id, n, trim(regexp_replace(trim(regexp_replace(line, '[^a-z0-9.+-]+', ' ', 'g')),
                                        '[ .]+$', '')) AS s
  FROM cut WHERE regexp_matches(line, '{ABOUT}') OR contains(line, 'spdx-')),
named AS (
  SELECT doc_id, n, CASE
{ids}
    ELSE '{UNKNOWN}' END AS id
  FROM about),
joined AS (
  SELECT d.doc_id, count(id) AS n_sentences, coalesce(string_agg(id, ',' ORDER BY n), '') AS sentence_ids,
         ',' || coalesce(string_agg(id, ',,' ORDER BY n), '') || ',' AS r0
  FROM documents d LEFT JOIN named v ON v.doc_id = d.doc_id GROUP BY d.doc_id),
{", ".join(steps)}
SELECT doc_id, CAST(n_sentences AS BIGINT) AS n_sentences, sentence_ids,
       concat_ws(',', {first_marks()}) AS licences
FROM {source}
"""


def first_marks() -> str:
    """Each licence at its first matching rule, in the rules' order."""
    cases, seen = [], {}
    for k, (licence, run) in enumerate(RULES):
        mark = "," + ",,".join(run) + ","
        hit = f"contains(r{k}, '{mark}')"
        earlier = " OR ".join(seen.get(licence, [])) or "FALSE"
        cases.append(f"CASE WHEN {hit} AND NOT ({earlier}) THEN '{licence}' END")
        seen.setdefault(licence, []).append(hit)
    return ", ".join(cases)


CHECKS["op6_licence_rules"] = licence_sql()

CHECKS["op9_line_rules"] = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM t),
windows AS (
  SELECT doc_id, k, array_to_string(w[k : k + {WINDOW - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS k FROM words WHERE len(w) > {WINDOW})),
repeated AS (
  SELECT doc_id, k FROM (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, s) AS c FROM windows)
  WHERE c > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(k, k + {WINDOW})) AS p FROM repeated) GROUP BY doc_id),
spoken AS (
  SELECT doc_id, line, count(*) AS n, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w,
         length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line),
judged AS (
  SELECT doc_id, n, chars,
    length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) > {SYMBOL_SHARE} * chars
    OR len(regexp_extract_all(line, '[!?]{{2,}}')) > {SHOUTED} * len(w)
    OR (len(w) >= {LONG_LINE} AND len(list_distinct(w)) < {VARIETY} * len(w))
    OR (len(w) <= {MENU_WORDS} AND regexp_matches(line, '{NAVIGATION}'))
    OR regexp_matches(line, '{BOILERPLATE}') AS bad
  FROM spoken),
losses AS (
  SELECT doc_id, sum(n) - count(*) AS n_dup, sum(chars) AS chars, sum(CASE WHEN bad THEN chars ELSE 0 END) AS lost
  FROM judged GROUP BY doc_id),
measured AS (
  SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
    coalesce(lost, 0) <= {LOSS} * coalesce(chars, 0) AS passed
  FROM t JOIN words v ON v.doc_id = t.doc_id
  LEFT JOIN covered c ON c.doc_id = t.doc_id LEFT JOIN losses l ON l.doc_id = t.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEATED} * n_words AS base_failed,
       NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEATED} * n_words) AND passed AS kept
FROM measured
"""


def found_sql(name: str, rank: int, kind: str, pattern: str, check: str = "TRUE") -> str:
    """Matches of one pattern with their positions, from the pieces between them."""
    return rf"""
  {name}_lists AS (SELECT doc_id, regexp_split_to_array(text, '{pattern}') AS pieces,
                          regexp_extract_all(text, '{pattern}') AS hits FROM t),
  {name} AS (
    SELECT doc_id, length(array_to_string(pieces[1 : i], '')) + length(array_to_string(hits[1 : i - 1], '')) AS s,
           {rank} AS r, '{kind}' AS kind, hits[i] AS hit
    FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM {name}_lists) WHERE {check})"""


# The assignment pattern with both cases spelt out and quotes doubled for SQL.
ASSIGN_SQL = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)

ALLOWED_SQL = " OR ".join(f"regexp_matches(hit, '{p}')" for p in ALLOWED if chr(92) + "1" not in p)
ALLOWED_SQL += " OR length(replace(hit, hit[1], '')) = 0"

CHECKS["op8_entropy_secrets"] = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
{found_sql("assign", 0, "assign", ASSIGN_SQL, f"length(regexp_extract(hits[i], '{ASSIGN_SQL}', 2)) >= {ASSIGN_VALUE}")},
{found_sql("access", 1, "access", "AKIA[A-Z0-9]+", "length(hits[i]) >= 20")},
{found_sql("hexes", 2, "hex", "[0-9a-f]+", "length(hits[i]) >= 24")},
{found_sql("runs", 0, "run", "[0-9A-Za-z+/_=-]+", "length(hits[i]) >= 20")},
base AS (SELECT doc_id, s, r, kind, s + length(hit) AS e
         FROM (SELECT * FROM assign UNION ALL SELECT * FROM access UNION ALL SELECT * FROM hexes)),
runs_asked AS (
  SELECT doc_id, s, hit, regexp_full_match(hit, '[0-9A-Fa-f]+') AS is_hex FROM runs WHERE NOT ({ALLOWED_SQL})),
free AS (
  SELECT doc_id, s, hit, is_hex, p FROM (
    SELECT *, unnest(range(s, s + length(hit))) AS p FROM runs_asked) r
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = r.doc_id AND b.s <= r.p AND r.p < b.e)),
islands AS (
  SELECT doc_id, s, hit, is_hex, min(p) AS first, count(*) AS size
  FROM (SELECT *, p - row_number() OVER (PARTITION BY doc_id, s ORDER BY p) AS island FROM free)
  GROUP BY doc_id, s, hit, is_hex, island HAVING count(*) >= {SPAN}),
asked AS (
  SELECT doc_id, s, is_hex, hit FROM (
    SELECT doc_id, first AS s, is_hex, substr(hit, CAST(first - s + 1 AS BIGINT), size) AS hit FROM islands)
  WHERE NOT ({ALLOWED_SQL})),
classed AS (
  SELECT doc_id, s, lower(hit) AS h, 3 AS r, 'entropy_hex' AS kind, {CLASSES["entropy_hex"][2]} AS least
  FROM asked WHERE is_hex
  UNION ALL
  SELECT doc_id, s, hit, 4, 'entropy_base64', {CLASSES["entropy_base64"][2]} FROM asked),
slid AS (SELECT *, unnest(range(0, length(h) - {SPAN - 1})) AS k FROM classed),
letters AS (SELECT doc_id, s, r, kind, least, k, unnest(string_split(substr(h, k + 1, {SPAN}), '')) AS c FROM slid),
counted AS (SELECT doc_id, s, r, kind, least, k, c, count(*) AS n FROM letters GROUP BY ALL),
hot AS (SELECT doc_id, s, r, kind, k FROM counted GROUP BY doc_id, s, r, kind, least, k
        HAVING -sum(n / {SPAN}.0 * log2(n / {SPAN}.0)) >= least - 1e-9),
parts AS (SELECT doc_id, s + min(k) AS s, r, kind, s + max(k) + {SPAN} AS e FROM hot GROUP BY doc_id, hot.s, r, kind),
kept AS (SELECT * FROM parts p WHERE r = 3 OR NOT EXISTS (
  SELECT 1 FROM parts q WHERE q.r = 3 AND q.doc_id = p.doc_id AND q.s < p.e AND p.s < q.e)),
every AS (SELECT doc_id, s, r, kind, e FROM base UNION ALL SELECT doc_id, s, r, kind, e FROM kept),
told AS (
  SELECT doc_id, count(*) FILTER (WHERE r = 0) AS n_assign, count(*) FILTER (WHERE r = 1) AS n_access,
    count(*) FILTER (WHERE r = 2) AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, r) FILTER (WHERE r < 3) AS base_spans,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, r) AS spans
  FROM every GROUP BY doc_id)
SELECT t.doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign,
       CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN told ON told.doc_id = t.doc_id
"""


def components_sql(percent: int) -> str:
    """Classes of ``sets (item, s)``: links by shared shingles, then everything reachable."""
    return rf"""
sizes AS (SELECT item, count(*) AS n FROM sets GROUP BY item),
shared AS (SELECT a.item AS x, b.item AS y, count(*) AS c
           FROM sets a JOIN sets b ON b.s = a.s AND a.item <> b.item GROUP BY a.item, b.item),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.item = x JOIN sizes q ON q.item = y
          WHERE 100 * c >= {percent} * (p.n + q.n - c)),
reach(item, seen) AS (
  SELECT item, item FROM sizes
  UNION
  SELECT r.item, l.y FROM reach r JOIN links l ON l.x = r.seen),
classes AS (SELECT item, min(seen) AS component FROM reach GROUP BY item)"""


def shingles_sql(source: str, item: str, text: str) -> str:
    lowered = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
words AS (SELECT {item} AS item, regexp_extract_all({lowered}, '[^\x20\x09-\x0D]+') AS w FROM {source}),
sets AS (SELECT DISTINCT item, array_to_string(w[k : k + 4], ' ') AS s
         FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM words WHERE len(w) > 0))"""


CHECKS["op3_chosen_path"] = rf"""
WITH RECURSIVE {shingles_sql("documents", "doc_id", "coalesce(text, '')")},
{components_sql(85)}
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
       coalesce(component, d.doc_id) AS component_id, coalesce(component, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes z ON z.item = d.doc_id LEFT JOIN classes c ON c.item = d.doc_id
"""

CHECKS["op10_paragraph_dedup"] = rf"""
WITH RECURSIVE lines AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS k, ls
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
placed AS (
  SELECT doc_id, CAST(k AS INTEGER) AS paragraph, line, doc_id * 1000000 + k AS place,
    CAST(CASE WHEN k = 0 THEN 0 ELSE length(array_to_string(ls[1 : k], chr(10))) + 1 END AS BIGINT) AS start,
    CAST(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS INTEGER) AS n_words
  FROM lines WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= {PARAGRAPH_WORDS}),
{shingles_sql("placed", "place", "line")},
{components_sql(PARAGRAPH_PERCENT)},
grouped AS (
  SELECT p.*, component, count(*) OVER (PARTITION BY component) AS n_copies
  FROM placed p JOIN classes c ON c.item = p.place)
SELECT doc_id, paragraph, start, start + length(line) AS "end", n_words,
       component // 1000000 AS first_doc_id, CAST(component % 1000000 AS INTEGER) AS first_paragraph,
       n_copies, place <> component AS removed
FROM grouped WHERE n_copies > 1
"""

CHECKS["op12_source_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
uses AS (SELECT d, lang, source, unnest(w) AS term FROM docs),
langs AS (
  SELECT lang, term, count(*) AS n FROM uses GROUP BY lang, term HAVING count(DISTINCT d) >= 10),
lang_sizes AS (SELECT lang, count(*) AS v, sum(n)::HUGEINT AS total FROM langs GROUP BY lang),
grps AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM uses GROUP BY ALL),
given AS (
  SELECT g.lang, g.source, l.term, coalesce(c.n, 0) AS n, l.n AS lang_n
  FROM grps g JOIN langs l ON l.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = l.term),
sizes AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM given GROUP BY lang, source),
shares AS (
  SELECT x.lang, x.source, x.term, x.n,
         1 + (1000000000::HUGEINT * (x.n + 2)) // (s.total + 2 * z.v) AS p,
         1 + (1000000000::HUGEINT * (x.lang_n + 2)) // (z.total + 2 * z.v) AS q
  FROM given x JOIN sizes s ON s.lang = x.lang AND s.source = x.source
  JOIN lang_sizes z ON z.lang = x.lang),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source
  GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM grps a JOIN grps b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""

# CRC-32 over the bytes of a text by its table, then near words by equal rests of one deletion.
CHECKS["op11_spelling_variants"] = r"""
WITH RECURSIVE steps AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, k: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END), i) AS c
    FROM range(256) r(i))),
runs AS (
  SELECT doc_id, run, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
    FROM documents) WHERE length(run) >= 5 GROUP BY doc_id, run),
bytes AS (
  SELECT doc_id, run, c, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM runs),
hashed AS (
  SELECT run, c, xor(4294967295, list_reduce(
      list_transform(range(1, length(h) + 1, 2), lambda i: CAST('0x' || substr(h, CAST(i AS BIGINT), 2) AS BIGINT)),
      lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]), CAST(4294967295 AS BIGINT))) AS k
  FROM bytes, steps),
slipped AS (
  SELECT CASE WHEN k % 97 = 0 THEN substr(run, 1, k % length(run)) || substr(run, k % length(run) + 2)
              ELSE run END AS word, c FROM hashed),
words AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
cuts AS (
  SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON b.word = a.rest
  UNION
  SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON b.word = a.rest),
best AS (
  SELECT word, count(*) AS n_near, min(-n) AS down, arg_min(other, (-n, other)) AS form FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -down >= 2 * w.n THEN form END AS form, CASE WHEN -down >= 2 * w.n THEN -down END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
led AS (
  SELECT word, word AS root FROM formed
  UNION ALL
  SELECT l.word, f.form FROM led l JOIN formed f ON f.word = l.root WHERE f.form IS NOT NULL),
roots AS (SELECT word, root FROM led WHERE root IN (SELECT word FROM formed WHERE form IS NULL))
SELECT f.word, f.form, r.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM formed f JOIN roots r ON r.word = f.word
"""
