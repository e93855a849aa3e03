"""SQL that must give the same rows, run by DuckDB on the same tables."""

from __future__ import annotations

from statloom.llm.license_scan import TEMPLATES
from statloom.llm.url_filter import WORD_RULES

_SPACE = r"[\x20\x09-\x0D]"


def _template_rows() -> str:
    return ", ".join(f"('{name}', '{body}')" for name, body in TEMPLATES.items())


def _phrases() -> str:
    return str([r.name for r in WORD_RULES])

ORACLE: dict[str, str] = {
    "op1_quality_rules": rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '{_SPACE}+'), lambda x: x <> '') AS ws FROM d),
pos AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
win AS (SELECT doc_id, i, word || ' ' || lead(word, 1) OVER p || ' ' || lead(word, 2) OVER p
          || ' ' || lead(word, 3) OVER p || ' ' || lead(word, 4) OVER p AS g
        FROM pos WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win WHERE g IS NOT NULL),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(5) AS r(k) WHERE c > 1 GROUP BY doc_id),
ln AS (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS l FROM d),
dup AS (SELECT doc_id, count(l) - count(DISTINCT l) AS n FROM ln WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
norm AS (SELECT doc_id, source, trim(regexp_replace(lower(l), '[ \t\x0B\f\r]+', ' ', 'g')) AS l FROM ln),
freq AS (SELECT source, l, count(DISTINCT doc_id) AS n, min(doc_id) AS first_id FROM norm WHERE l <> '' GROUP BY ALL),
hosts AS (SELECT source, count(*) AS total FROM documents GROUP BY source),
top AS (SELECT f.source, l, first_id FROM freq f JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source
        WHERE n >= 20 AND 100 * n > 10 * total),
lost AS (SELECT doc_id, sum(len(string_split(n.l, ' '))) AS gone FROM norm n
         JOIN top t ON n.source IS NOT DISTINCT FROM t.source AND n.l = t.l AND n.doc_id <> t.first_id GROUP BY doc_id),
s AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
        coalesce(gone, 0)::BIGINT AS removed_words
      FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s)
SELECT *, NOT base_failed AND NOT (removed_words > 0
  AND (n_words - removed_words < 10 OR 100 * (n_words - removed_words) < 30 * n_words)) AS kept FROM b
""",
    "op3_mix_sources": rf"""
WITH d AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}+'), lambda x: x <> ''))::BIGINT AS size,
             md5('mix:' || doc_id || ':' || md5(coalesce(text, ''))) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, 2 * sum(size)::BIGINT AS cap,
        row_number() OVER (ORDER BY source NULLS LAST) AS i FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(i - 1) % 3 + 1]::BIGINT AS weight FROM s),
r AS (SELECT *, cap / weight AS ratio FROM w),
o AS (SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::BIGINT
            - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
          / ((sum(weight) OVER ())::BIGINT
            - coalesce(sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
            AS level FROM r),
lv AS (SELECT level FROM o WHERE ratio > level ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN (SELECT level FROM lv) IS NULL OR ratio <= (SELECT level FROM lv)
        THEN cap::DOUBLE ELSE weight * (SELECT level FROM lv) END AS target FROM o),
c AS (SELECT d.*, source_size, target, (sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS cum
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT doc_id, key, size, epoch, (epoch * source_size + cum)::DOUBLE / target AS finish
      FROM c, range(2) AS r(epoch) WHERE size > 0),
g AS (SELECT doc_id, size, sum(size) OVER (ORDER BY finish, key, doc_id, epoch
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running FROM e),
k AS (SELECT doc_id, sum(size)::BIGINT AS taken FROM g WHERE running <= (SELECT sum(target) FROM t) GROUP BY doc_id)
SELECT c.doc_id, c.source, c.size, c.source_size, c.target, coalesce(k.taken, 0)::BIGINT AS taken
FROM c LEFT JOIN k USING (doc_id)
""",
    "op10_exact_dedup": rf"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '{_SPACE}+', '', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  doc_id = first_value(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
""",
    "op2_license_scan": rf"""
WITH t AS (SELECT * FROM (VALUES {_template_rows()}) AS t(license, body)),
norm AS (SELECT license, list_filter(regexp_split_to_array(lower(body), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM t),
tg AS (SELECT license, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS tg FROM norm),
d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
parts AS (SELECT doc_id, 0 AS line, body FROM d
  UNION ALL SELECT doc_id, i, string_split(body, chr(10))[i] FROM d, range(1, len(string_split(body, chr(10))) + 1) AS r(i)
  WHERE len(string_split(body, chr(10))) > 1),
pw AS (SELECT doc_id, line, list_filter(regexp_split_to_array(lower(body), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM parts),
pg AS (SELECT doc_id, line, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM pw),
m AS (SELECT doc_id, license, line, len(list_intersect(g, tg)) AS shared, len(g) AS size, len(tg) AS template_size
      FROM pg, tg WHERE len(g) > 0 AND len(tg) > 0 AND len(g) < 1000)
SELECT doc_id, license, line = 0 AS whole, line::BIGINT AS line, shared, size, template_size,
  (2 * shared) / (size + template_size) AS dice
FROM m WHERE 200 * shared >= 80 * (size + template_size)
""",
    "op8_url_filter": rf"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
p AS (SELECT page_id, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM u),
rules AS (SELECT * FROM (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'allow'), ('example.org', '/en/1', 'block'),
            ('com', '/fr/', 'allow'), ('com', '/de/', 'block')) AS r(h, s, v)),
fit AS (SELECT page_id, h || s AS rule, v FROM p, rules
        WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s)),
top AS (SELECT page_id, rule, v FROM fit QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC, rule) = 1),
phrases AS (SELECT unnest({_phrases()}) AS phrase),
word AS (SELECT page_id, phrase FROM p, phrases WHERE regexp_matches(host || path, '(^|[^A-Za-z0-9])' || phrase || '($|[^A-Za-z0-9])')
         QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(phrase) DESC, phrase) = 1)
SELECT page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN v WHEN phrase IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN rule IS NULL THEN phrase END AS pattern
FROM p LEFT JOIN top USING (page_id) LEFT JOIN word USING (page_id)
""",
    "op12_collocations": rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
q AS (SELECT lang, ws, unnest([1, 2, 3, 4]) AS size FROM w),
g AS (SELECT lang, size, unnest(list_transform(range(1, len(ws) - size + 2), lambda i: list_slice(ws, i, i + size - 1))) AS ph FROM q),
f AS (SELECT lang, ph, size, count(*) AS c FROM g GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT lang, ph, size, c AS a FROM f WHERE size > 1 AND c >= 30),
cut AS (SELECT c.*, k, list_slice(ph, 1, k) AS p1, list_slice(ph, k + 1, size) AS p2 FROM c, range(1, 4) AS s(k) WHERE k < size),
k AS (SELECT t.*, x.c AS l, y.c AS r, ((2000000::HUGEINT * a) // (x.c::HUGEINT + y.c))::BIGINT AS score
      FROM cut t JOIN f x ON x.lang = t.lang AND x.ph = p1 JOIN f y ON y.lang = t.lang AND y.ph = p2),
b AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) = 1),
sub AS (SELECT lang, list_slice(ph, i, i + z - 1) AS ph, max(a) AS big FROM c, range(2, 4) AS s(z), range(1, 4) AS r(i)
        WHERE z < size AND i + z - 1 <= size GROUP BY ALL),
o AS (SELECT b.lang, array_to_string(b.ph, ' ') AS phrase, a, l, r, score FROM b
      LEFT JOIN sub ON sub.lang = b.lang AND sub.ph = b.ph WHERE big IS NULL OR 100::HUGEINT * big < 80::HUGEINT * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM o JOIN n USING (lang) QUALIFY rank <= 2000
""",
    "op13_hard_negatives": """
WITH v AS (SELECT vec_id AS id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS a, b.id AS b, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
      FROM v a JOIN v b ON a.id % 50 = 0 AND a.id <> b.id),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id,
  (row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b))::INTEGER AS rank,
  s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
""",
}
