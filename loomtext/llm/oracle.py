"""SQL of the queries that SQL can express on whole tables."""

WORD = r"[^\x20\x09-\x0D]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MIX = rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM s),
o AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) AS all_s, CAST(sum(w) OVER () AS DOUBLE) AS all_w,
  CAST(sum(source_size) OVER q AS DOUBLE) - source_size AS before_s, CAST(sum(w) OVER q AS DOUBLE) - w AS before_w
  FROM r WINDOW q AS (ORDER BY CAST(source_size AS DOUBLE) / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
c AS (SELECT *, (all_s - 3 * before_s) * w > 3.0::DOUBLE * source_size * (all_w - before_w) AS capped FROM o),
n AS (SELECT *, all_s - 3 * sum(CASE WHEN capped THEN source_size ELSE 0 END) OVER () AS num, all_w - sum(CASE WHEN capped THEN w ELSE 0 END) OVER () AS den FROM c),
t AS (SELECT source, source_size, CAST(CASE WHEN capped OR source_size = 0 THEN 3.0::DOUBLE * source_size ELSE least(CAST(w AS DOUBLE) * num / den, 3.0::DOUBLE * source_size) END AS DOUBLE) AS target FROM n),
p AS (SELECT d.doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0::DOUBLE) ELSE 0.0 END AS rate FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CAST(CAST(concat('0x', substr(md5(concat('mix:', coalesce(CAST(doc_id AS VARCHAR), 'null'))), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE < rate - floor(rate) AS INTEGER)) AS BIGINT) AS taken FROM p
"""

_PHRASES = (
    "all rights reserved", "licensed under", "accept cookies", "cookie policy", "privacy policy", "terms of use",
    "terms of service", "click here", "sign up for", "log in to", "share this", "skip to content", "powered by",
    "subscribe to", "tous droits réservés", "politique de confidentialité", "conditions d'utilisation", "cliquez ici",
    "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "hier klicken", "todos los derechos reservados",
    "política de privacidad", "términos de uso", "haga clic aquí",
)
_BOILER = " OR ".join("contains(lower(x), '" + p.replace("'", "''") + "')" for p in _PHRASES)

QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
g AS (SELECT doc_id, i, concat(w[i], chr(1), w[i + 1], chr(1), w[i + 2]) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
f AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM g) WHERE c > 1),
v AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM f) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d),
m AS (SELECT doc_id, x, len(regexp_extract_all(x, '{WORD}')) AS n,
  len(regexp_extract_all(x, '[#*$%&|<>!?^~=_{{}}\[\]\\@+]')) > length(x) * 0.08::DOUBLE OR len(regexp_extract_all(x, '[|»›•·>]')) >= 3 OR {_BOILER} AS bad FROM l),
a AS (SELECT doc_id, count(CASE WHEN n > 0 THEN 1 END) - count(DISTINCT CASE WHEN n > 0 THEN x END) AS dups, sum(CASE WHEN bad THEN n ELSE 0 END) AS lost FROM m GROUP BY doc_id),
b AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
  CAST(dups AS BIGINT) AS n_dup_lines, CAST(coalesce(v.n, 0) AS BIGINT) AS n_repeat_words, lost FROM d JOIN a ON a.doc_id = d.doc_id LEFT JOIN v ON v.doc_id = d.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  (n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words AND 100 * lost <= 30 * n_words) AS kept FROM b
"""

NEAR = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT u, v FROM c JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 85 * (x.n + y.n - k)),
w AS (SELECT u, v FROM e UNION ALL SELECT v, u FROM e),
r(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.id, w.v FROM r JOIN w ON w.u = r.root)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.root AS component_id, m.root = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT id, min(root) AS root FROM r GROUP BY id) m ON m.id = d.doc_id
"""

#: A run is an island of equal lines on one diagonal of two places; every run of three words is removed.
LINES = rf"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
u AS (SELECT doc_id, unnest(ls) AS x, generate_subscripts(ls, 1) AS pos FROM d),
a AS (SELECT doc_id, pos, x, len(regexp_extract_all(x, '{WORD}')) AS w FROM u),
l AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS n, sum(w) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM a WHERE w > 0),
q AS (SELECT a.doc_id AS d, a.n AS i, b.doc_id AS e, b.n AS k FROM l a JOIN l b ON a.x = b.x AND (b.doc_id < a.doc_id OR (b.doc_id = a.doc_id AND b.n < a.n))),
g AS (SELECT d, e, i, i - k AS diagonal, i - row_number() OVER (PARTITION BY d, e, i - k ORDER BY i) AS island FROM q),
r AS (SELECT DISTINCT d, f, t FROM (SELECT d, min(i) AS f, max(i) AS t FROM g GROUP BY d, e, diagonal, island)),
o AS (SELECT r.* FROM r JOIN l x ON x.doc_id = r.d AND x.n = r.f JOIN l y ON y.doc_id = r.d AND y.n = r.t WHERE y.upto - x.upto + x.w >= 3),
m AS (SELECT d, count(*) AS runs FROM o WHERE NOT EXISTS (SELECT 1 FROM o p WHERE p.d = o.d AND p.f <= o.f AND p.t >= o.t AND (p.f < o.f OR p.t > o.t)) GROUP BY d),
z AS (SELECT DISTINCT d, unnest(range(f, t + 1)) AS n FROM o),
y AS (SELECT l.doc_id, l.pos FROM l JOIN z ON z.d = l.doc_id AND z.n = l.n),
c AS (SELECT a.doc_id, count(CASE WHEN a.w > 0 THEN 1 END) AS n_lines, count(y.pos) AS n_removed, string_agg(CASE WHEN y.pos IS NULL THEN a.x END, chr(10) ORDER BY a.pos) AS kept FROM a LEFT JOIN y ON y.doc_id = a.doc_id AND y.pos = a.pos GROUP BY a.doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(runs, 0) AS BIGINT) AS n_runs, md5(coalesce(kept, '')) AS kept_md5
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN m ON m.d = d.doc_id
"""

#: Bytes are handled as pairs of hexadecimal digits.
SUBSTRINGS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, h, unnest(range(0, CAST(len(h) / 2 AS BIGINT) - 99)) AS i FROM d),
k AS (SELECT doc_id, i, md5_number(substr(h, CAST(2 * i + 1 AS BIGINT), 200)) AS x FROM s),
f AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY x ORDER BY doc_id, i) AS r FROM k) WHERE r > 1),
b AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100 THEN 0 ELSE 1 END AS opens FROM f),
g AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM b),
p AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS z FROM g GROUP BY doc_id, span),
o AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM p),
c AS (SELECT o.doc_id, sum(z - a) AS removed, count(*) AS spans, max(z) AS last, string_agg(substr(h, CAST(2 * before + 1 AS BIGINT), CAST(2 * (a - before) AS BIGINT)), '' ORDER BY a) AS kept FROM o JOIN d ON d.doc_id = o.doc_id GROUP BY o.doc_id)
SELECT d.doc_id, CAST(len(h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN c.doc_id IS NULL THEN h ELSE concat(kept, substr(h, CAST(2 * last + 1 AS BIGINT))) END)) AS kept_sha256
FROM d LEFT JOIN c ON c.doc_id = d.doc_id
"""

#: The checksum of a word is worked out byte by byte from the reversed polynomial.
IMPORTANCE = rf"""
WITH t AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab FROM range(256) r(i)),
d AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
f AS (SELECT x, sum(n) AS n FROM (SELECT doc_id, unnest(w) AS x, 1 AS n FROM d) GROUP BY x),
g AS (SELECT x, count(*) AS n FROM (SELECT unnest(w) AS x FROM b) GROUP BY x),
h AS (SELECT x, hex(encode(x)) AS h FROM (SELECT x FROM f UNION SELECT x FROM g)),
c AS (SELECT x, xor(list_reduce(list_concat([4294967295], list_transform(range(CAST(len(h) / 2 AS BIGINT)), lambda i: CAST(concat('0x', substr(h, 2 * i + 1, 2)) AS BIGINT))),
  lambda c, y: xor(c >> 8, tab[(xor(c, y) & 255) + 1])), 4294967295) % 10000 AS bucket FROM h, t),
s AS (SELECT bucket, sum(n) AS n FROM f JOIN c USING (x) GROUP BY bucket),
u AS (SELECT bucket, sum(n) AS n FROM g JOIN c USING (x) GROUP BY bucket),
z AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS S_all, (SELECT coalesce(sum(n), 0) FROM u) AS T_all),
gain AS (SELECT bucket, CAST(floor(1000.0::DOUBLE * ln(((coalesce(u.n, 0) + 1)::DOUBLE * (S_all + 10000)::DOUBLE) / ((coalesce(s.n, 0) + 1)::DOUBLE * (T_all + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM (SELECT i AS bucket FROM range(10000) r(i)) k LEFT JOIN s USING (bucket) LEFT JOIN u USING (bucket), z),
m AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n, sum(gain) AS g FROM (SELECT doc_id, unnest(w) AS x FROM d) JOIN c USING (x) JOIN gain USING (bucket) GROUP BY doc_id),
v AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(CASE WHEN len(w) = 0 THEN 0 ELSE floor(m.g::DOUBLE / m.n) END AS BIGINT) AS weight,
  CAST(concat('0x', substr(sha256(concat('2024:', coalesce(CAST(d.doc_id AS VARCHAR), 'null'))), 1, 8)) AS BIGINT) AS h FROM d LEFT JOIN m ON m.doc_id = d.doc_id),
o AS (SELECT *, weight + CAST(floor(-1000.0::DOUBLE * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM v),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM o WHERE n_features >= 20)
SELECT o.doc_id, n_features, weight, score, CASE WHEN 100 * r.rank <= 10 * r.n THEN CAST(r.rank AS BIGINT) END AS rank FROM o LEFT JOIN r ON r.doc_id = o.doc_id
"""

PHRASES = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang, string_split_regex({LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]') AS ps FROM documents),
p AS (SELECT id, lang, unnest(ps) AS piece, generate_subscripts(ps, 1) AS o FROM d),
w AS (SELECT id, o, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
x AS (SELECT id, o, lang, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
y AS (SELECT lang, word AS w1, lead(word, 1) OVER q AS w2, lead(word, 2) OVER q AS w3, lead(word, 3) OVER q AS w4 FROM x WINDOW q AS (PARTITION BY id, o ORDER BY i)),
g AS (SELECT lang, 1 AS k, w1 AS phrase FROM y UNION ALL SELECT lang, 2, concat(w1, ' ', w2) FROM y WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, concat(w1, ' ', w2, ' ', w3) FROM y WHERE w3 IS NOT NULL UNION ALL SELECT lang, 4, concat(w1, ' ', w2, ' ', w3, ' ', w4) FROM y WHERE w4 IS NOT NULL),
f AS (SELECT lang, k, phrase, CAST(count(*) AS BIGINT) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, CAST(count(*) AS BIGINT) AS n FROM x GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
u AS (SELECT lang, phrase, a, cut, array_to_string(w[1 : cut], ' ') AS head, array_to_string(w[cut + 1 : k], ' ') AS tail FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)),
s AS (SELECT u.lang, u.phrase, u.a, u.cut, l.f AS l, r.f AS r, CAST((2000000::HUGEINT * u.a) // (l.f::HUGEINT + r.f) AS BIGINT) AS score
  FROM u JOIN f l ON l.lang = u.lang AND l.phrase = u.head JOIN f r ON r.lang = u.lang AND r.phrase = u.tail),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
b AS (SELECT lang, array_to_string(w[o : o + j - 1], ' ') AS phrase, max(a) AS longer FROM c, range(2, 4) y(j), range(1, 4) z(o) WHERE j < k AND o + j - 1 <= k GROUP BY ALL),
e AS (SELECT m.* FROM m LEFT JOIN b ON b.lang = m.lang AND b.phrase = m.phrase WHERE b.phrase IS NULL OR 100::HUGEINT * b.longer < 80::HUGEINT * m.a)
SELECT e.lang, CAST(row_number() OVER (PARTITION BY e.lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank, phrase, a, l, r, n, score FROM e JOIN n ON n.lang = e.lang
QUALIFY row_number() OVER (PARTITION BY e.lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
