"""DuckDB SQL of the queries that SQL can express."""

# Near duplicates by counting the shared five-word shingles of every pair of distinct texts that
# shares one, then the pairs' transitive closure.
NEAR_DUPS = r"""WITH RECURSIVE
docs AS (SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(text, '')) AS c FROM documents),
word_lists AS (SELECT c, regexp_extract_all(
    translate(any_value(text), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-z0-9\x{80}-\x{10FFFF}]+') AS ws FROM docs GROUP BY c),
shingles AS (SELECT DISTINCT c, hash(array_to_string(ws[i:i + 4], ' ')) AS g
  FROM (SELECT c, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM word_lists WHERE len(ws) > 0) x),
sizes AS (SELECT c, count(*) AS n FROM shingles GROUP BY c),
common AS (SELECT a.c AS a, b.c AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.g = b.g AND a.c < b.c GROUP BY 1, 2),
pairs AS (SELECT a, b FROM common JOIN sizes x ON x.c = a JOIN sizes y ON y.c = b WHERE 10 * k >= 8 * (x.n + y.n - k)),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT a AS c, a AS d FROM links UNION SELECT reach.c, links.b FROM reach JOIN links ON links.a = reach.d),
named AS (SELECT c, min(d) AS class FROM reach GROUP BY c),
members AS (SELECT doc_id, coalesce(class, docs.c) AS class FROM docs LEFT JOIN named ON named.c = docs.c)
SELECT doc_id, min(doc_id) OVER (PARTITION BY class) AS class_id, count(*) OVER (PARTITION BY class) AS class_size
FROM members"""

# All pairs of distinct shingle sets that share a shingle, then their transitive closure.
PARITY_JOIN = r"""WITH RECURSIVE
word_lists AS (SELECT rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t-\r]+') AS ws
  FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents) d),
per_row AS (SELECT rid, doc_id, list_sort(list_distinct(list_transform(
    range(1, CASE WHEN len(ws) = 0 THEN 1 ELSE greatest(len(ws) - 4, 1) + 1 END),
    lambda i: array_to_string(ws[i:i + 4], ' ')))) AS grams FROM word_lists),
sets AS (SELECT md5(array_to_string(grams, chr(10))) AS c, any_value(grams) AS grams, min(doc_id) AS first_id
  FROM per_row WHERE len(grams) > 0 GROUP BY 1),
shingles AS (SELECT c, unnest(grams) AS g, len(grams) AS n FROM sets),
common AS (SELECT a.c AS a, b.c AS b, a.n AS x, b.n AS y, count(*) AS k
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.c < b.c GROUP BY 1, 2, 3, 4),
pairs AS (SELECT a, b FROM common WHERE 100 * k >= 80 * (x + y - k)),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT a AS c, a AS d FROM links UNION SELECT reach.c, links.b FROM reach JOIN links ON links.a = reach.d),
named AS (SELECT c, min(d) AS class FROM reach GROUP BY c),
classes AS (SELECT sets.c, coalesce(class, sets.c) AS class, first_id FROM sets LEFT JOIN named ON named.c = sets.c),
members AS (SELECT rid, doc_id, len(grams) AS n, class, first_id
  FROM per_row LEFT JOIN classes ON len(grams) > 0 AND classes.c = md5(array_to_string(grams, chr(10))))
SELECT doc_id, n::BIGINT AS n_shingles,
  CASE WHEN n = 0 THEN doc_id ELSE min(first_id) OVER (PARTITION BY class) END AS component_id,
  CASE WHEN n = 0 THEN 1 ELSE count(*) OVER (PARTITION BY class) END AS component_size
FROM members"""

FILL_IN_MIDDLE = r"""WITH
drawn AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
    sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
numbers AS (SELECT *, len(lines) AS n, ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2,
    ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4 FROM drawn),
cuts AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS i, greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS j,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
         WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
parts AS (SELECT *, array_to_string(lines[1:i], '') AS p, array_to_string(lines[i + 1:j], '') AS m,
    array_to_string(lines[j + 1:], '') AS s FROM cuts)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                   ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM parts"""

FILTER_AUDIT = r"""WITH
texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
word_lists AS (SELECT *, regexp_extract_all(t, '[^ \t-\r]+') AS ws FROM texts),
firsts AS (SELECT t, min(doc_id) AS first_id FROM texts GROUP BY t),
marks AS (SELECT doc_id, part,
    len(ws) < 200 AS a, 100 * len(list_distinct(ws)) < 50 * len(ws) AS b,
    100 * length(regexp_replace(w.t, '[^A-Z]', '', 'g')) > 2 * length(w.t) AS c,
    regexp_matches(w.t, '[#$%&*|]') AS d, coalesce(doc_id > first_id, false) AS e
  FROM word_lists w JOIN firsts f ON f.t = w.t),
marked AS (SELECT m.*, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic FROM marks m LEFT JOIN
    (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id) l ON l.doc_id = m.doc_id),
cells AS (SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n,
    count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM marked GROUP BY 1, 2),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(f, bit)),
orders AS (SELECT p.f || q.f || r.f || s.f || u.f AS filter_order, [p.bit, q.bit, r.bit, s.bit, u.bit] AS bits
  FROM letters p JOIN letters q ON q.f <> p.f JOIN letters r ON r.f NOT IN (p.f, q.f)
  JOIN letters s ON s.f NOT IN (p.f, q.f, r.f) JOIN letters u ON u.f NOT IN (p.f, q.f, r.f, s.f)),
steps AS (SELECT filter_order, i::INT AS step, bits[i] AS own, coalesce(list_sum(bits[1:i - 1]), 0)::INT AS before
  FROM orders, unnest(range(1, 6)) x(i)),
counted AS (SELECT part, filter_order, step, own,
    sum(CASE WHEN mask & (before | own) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN mask & before <> 0 AND mask & own <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM cells JOIN steps ON true GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM counted"""

SQL: dict[str, str] = {"op1_near_dups": NEAR_DUPS, "op11_parity_join": PARITY_JOIN, "op12_fill_in_middle": FILL_IN_MIDDLE,
                       "op13_filter_audit": FILTER_AUDIT}
