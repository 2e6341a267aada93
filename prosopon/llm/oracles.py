"""DuckDB SQL for the operators that SQL can express on small tables."""

from __future__ import annotations

from prosopon.llm.licenses import TEMPLATES
from prosopon.llm.quality import BOILERPLATE, CLOSING, NAVIGATION

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = r"[\x20\x09-\x0D]+"


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def ngram_join(k: int, percent: int) -> str:
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_SPACE}'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' '))) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
link AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * a.n >= {percent} * b.n AND 100 * b.n >= {percent} * a.n GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS d, doc_id AS r FROM s UNION SELECT reach.d, link.b FROM reach JOIN link ON reach.r = link.a)
SELECT s.doc_id, len(s) AS n_shingles, (SELECT min(r) FROM reach WHERE d = s.doc_id) AS component_id FROM s
"""


def licenses(percent: int = 80) -> str:
    rows = ", ".join(f"({_quoted(k)}, {_quoted(t)})" for k, t in TEMPLATES.items())
    words = lambda x: f"list_filter(string_split_regex(lower({x}), '[^a-z0-9]+'), lambda y: y <> '')"
    pairs = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    return rf"""
WITH template AS (SELECT k, list_distinct(p) AS s, len(p) AS words FROM (SELECT k, {pairs} AS p FROM (SELECT k, {words("t")} AS w FROM (VALUES {rows}) v(k, t)))),
bigram AS (SELECT k, unnest(s) AS b FROM template),
doc AS (SELECT row_number() OVER () AS r, doc_id, {pairs} AS p FROM (SELECT doc_id, {words("coalesce(text, '')")} AS w FROM documents)),
placed AS (SELECT r, unnest(p) AS b, generate_subscripts(p, 1) AS i FROM doc),
own AS (SELECT r, k, i, b FROM placed JOIN bigram USING (b)),
enough AS (SELECT r, k FROM own JOIN template USING (k) GROUP BY r, k, len(s) HAVING count(DISTINCT b) * {200 - percent} >= len(s) * {percent}),
stretch AS (SELECT r, k, i, s, list_distinct(p[i:i + words - 1]) AS x FROM own JOIN enough USING (r, k) JOIN template USING (k) JOIN doc USING (r)),
unit AS (SELECT r, k, i, len(list_intersect(x, s)) AS shared, len(x) + len(s) AS size FROM stretch WHERE {200 - percent} * least(len(x), len(s)) >= {percent} * greatest(len(x), len(s))),
hit AS (SELECT r, k, 2.0::DOUBLE * shared / size AS d FROM unit WHERE 200 * shared >= {percent} * size QUALIFY row_number() OVER (PARTITION BY r, i ORDER BY shared DESC, size, k) = 1),
best AS (SELECT r, count(DISTINCT k) AS n, string_agg(DISTINCT k, '|' ORDER BY k) AS names, floor(max(d) * 10000 + 0.5) / 10000 AS d FROM hit GROUP BY r),
top AS (SELECT r, min(k) AS k FROM hit h WHERE d = (SELECT max(d) FROM hit x WHERE x.r = h.r) GROUP BY r),
n AS (SELECT r, count(*) AS n FROM unit GROUP BY r)
SELECT doc_id, coalesce(n.n, 0) AS n_units, coalesce(best.n, 0) AS n_hits, top.k AS license, best.d AS dice, coalesce(best.names, '') AS licenses
FROM doc LEFT JOIN n USING (r) LEFT JOIN best USING (r) LEFT JOIN top USING (r)
"""


def quality(min_words: int = 50, max_repeat_percent: int = 50) -> str:
    plain = r"[\p{L}\p{N}_\s\x0b.,;:!?''\"()\-]"
    phrases, nav = ", ".join(map(_quoted, BOILERPLATE)), ", ".join(map(_quoted, NAVIGATION))
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(string_split_regex(t, '{_SPACE}'), lambda x: x <> '') AS w FROM d),
win AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 3),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i:i + 2]) AS c FROM win),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM twice, (VALUES (0), (1), (2)) v(o) WHERE c > 1 GROUP BY doc_id),
line AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS x, generate_subscripts(string_split(t, chr(10)), 1) AS k FROM d),
dup AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id, x ORDER BY k) AS r FROM line WHERE regexp_matches(x, '[^\x20\x09-\x0D]')) WHERE r > 1 GROUP BY doc_id),
bare AS (SELECT doc_id, trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS x FROM line),
m AS (SELECT doc_id, x, length(regexp_replace(x, '[\s\x0b]', '', 'g')) AS seen, length(regexp_replace(x, '{plain}', '', 'g')) AS odd, regexp_matches(x, '[\p{{L}}\p{{N}}]') AS alnum,
    list_filter(string_split_regex(x, '[|»›>•·/]+'), lambda y: trim(y) <> '') AS items, len(list_filter(string_split_regex(x, '[\s\x0b]+'), lambda y: y <> '')) AS n FROM bare WHERE x <> ''),
bad AS (SELECT doc_id, seen, CASE WHEN odd > 0.3 * seen OR NOT alnum THEN true WHEN odd > 0 AND len(items) >= 4 AND n <= 4 * len(items) THEN true
    WHEN odd > 0 AND len(items) > 1 AND len(list_filter(items, lambda y: NOT list_contains([{nav}], lower(trim(y, ' .:'))))) = 0 THEN true
    WHEN length(x) <= 180 AND n <= 15 AND (list_contains([{nav}], trim(lower(x), ' .:')) OR len(list_filter([{phrases}], lambda y: contains(lower(x), y))) > 0 OR NOT contains({_quoted(CLOSING)}, right(x, 1))) THEN true ELSE false END AS bad FROM m),
loss AS (SELECT doc_id, sum(CASE WHEN bad THEN seen ELSE 0 END) / sum(seen) AS l FROM bad GROUP BY doc_id),
o AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '{_SPACE}', '', 'g')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(l, 0) AS l
    FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN loss USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < {min_words} OR 100 * n_repeat_words > {max_repeat_percent} * n_words AS base_failed,
    NOT (n_words < {min_words} OR 100 * n_repeat_words > {max_repeat_percent} * n_words) AND l <= 0.5 AS kept FROM o
"""


def decontamination(size: int = 10) -> str:
    words = lambda x: rf"list_filter(string_split_regex(translate(coalesce({x}, ''), '{_UPPER}', '{_LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    return rf"""
WITH item AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {words("text")} AS w FROM benchmark),
win AS (SELECT DISTINCT item, l, array_to_string(w[i + 1:i + l], ' ') AS g FROM (SELECT item, w, least({size}, len(w)) AS l, unnest(range(0, len(w) - least({size}, len(w)) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT row_number() OVER () AS r, doc_id, {words("text")} AS w FROM documents),
place AS (SELECT r, l, w, unnest(range(0, len(w) - l + 1)) AS i FROM doc, (SELECT DISTINCT l FROM win)),
hit AS (SELECT r, i, win.l, item FROM (SELECT r, l, i, array_to_string(w[i + 1:i + l], ' ') AS g FROM place) p JOIN win ON p.l = win.l AND p.g = win.g),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + l)) AS p FROM (SELECT DISTINCT r, i, l FROM hit)) GROUP BY r),
which AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(which.n, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN which USING (r)
"""


def search(k: int = 50) -> str:
    terms = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return rf"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {terms} AS t FROM documents),
total AS (SELECT count(*) AS n_texts, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM doc WHERE len(t) > 0),
item AS (SELECT DISTINCT r, item_id, unnest(t) AS term FROM (SELECT row_number() OVER () AS r, item_id, {terms} AS t FROM benchmark)),
post AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM doc) GROUP BY ALL),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * n_texts + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM post, total GROUP BY term, n_texts),
score AS (SELECT item.r AS i, item_id, post.r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_texts) // n_terms))))) AS BIGINT) AS score FROM item JOIN post USING (term) JOIN weight USING (term), total GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id, r) AS INTEGER) AS rank FROM score WHERE score > 0) WHERE rank <= {k}
"""


ORACLE_SQL = {
    "op5_ngram_join": ngram_join(3, 90), "op6_quality_rules": quality(), "op8_licenses": licenses(), "op12_decontamination": decontamination(), "op13_search": search(),
}
