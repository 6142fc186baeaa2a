"""DuckDB SQL for the queries that SQL can express; the others are held against plain versions in the tests."""

from __future__ import annotations

EXACT = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))"""

VECTORS = """
WITH RECURSIVE good AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
      ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, component_id,
       e.vec_id = component_id AS kept
FROM embeddings e JOIN low USING (vec_id)"""

# Conversation -1 is added as in the query; stars inside control strings are the escapes.
CHATS = """
WITH rows_ AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
shown AS (SELECT *, regexp_replace(text, '<(\\**)\\|(im_start|im_end|nl)\\|>', '<\\1*|\\2|>', 'g') AS safe FROM rows_),
whole AS (
    SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
           coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
           sum(length(role) + length(safe) + 24)::BIGINT AS formatted_chars
    FROM shown GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars
FROM whole"""

# Bytes are pairs of hexadecimal digits.
REPEATS = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
part_ AS (SELECT doc_id, n, p, substr(h, 2 * p + 1, 2398) AS h
          FROM (SELECT doc_id, h, n, unnest(range(0, n - 199, 1000)) AS p FROM b WHERE n >= 200)),
win AS (SELECT doc_id, p + j AS i, md5(substr(h, 2 * j + 1, 400)) AS m
        FROM (SELECT doc_id, h, p, unnest(range(0, least(1000, n - 199 - p))) AS j FROM part_)),
dup AS (SELECT m FROM win GROUP BY m HAVING count(*) > 1),
hit AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 200, true) AS fresh
        FROM win SEMI JOIN dup USING (m)),
run AS (SELECT doc_id, min(i) AS lo, max(i) + 200 AS hi
        FROM (SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM hit) GROUP BY doc_id, r),
part AS (SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS after FROM run),
cut AS (SELECT doc_id, count(*) AS n_spans, sum(hi - lo)::BIGINT AS n_removed, max(hi) AS last,
               string_agg(substr(h, 2 * after + 1, 2 * (lo - after)), '' ORDER BY lo) AS head
        FROM part JOIN b USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM b LEFT JOIN cut USING (doc_id)"""

JACCARD = """
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
          ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
      FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
          FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
          WHERE 100 * common >= 90 * (p.n + q.n - common)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(b) FROM reach WHERE a = d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id)"""


# As in the query, for tables of at most `secret_scan.SAMPLE_ROWS` rows, all of which are then samples.
SECRETS = """
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
rules(kind, pattern, least) AS (VALUES
    (0, '(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|'
        || '[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+', 6),
    (1, 'AKIA[A-Z0-9]+', 20), (2, '[0-9a-f]+', 24), (3, '[A-Za-z0-9+/_-]{20,}', 20)),
hits AS (SELECT row, kind, least, regexp_extract_all(t, pattern) AS h, string_split_regex(t, pattern) AS g FROM d, rules),
places AS (SELECT row, kind, least, h[i] AS m, regexp_extract(h[i], '[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1) AS v,
                  list_sum(list_transform(g[1:i], lambda x: length(x))) + list_sum(list_transform(h[1:i], lambda x: length(x)))
                  - length(h[i]) AS b
           FROM (SELECT *, unnest(range(1, len(h) + 1)) AS i FROM hits WHERE len(h) > 0)),
spans AS (SELECT row, kind, m, v, b::BIGINT AS b, (b + length(m))::BIGINT AS e FROM places
          WHERE length(CASE kind WHEN 0 THEN v ELSE m END) >= least),
base AS (SELECT * FROM spans WHERE kind < 3),
cand AS (SELECT * FROM spans s WHERE kind = 3
         AND NOT EXISTS (SELECT 1 FROM base o WHERE o.row = s.row AND o.b < s.e AND s.b < o.e)),
flat AS (SELECT row, b, max(e) OVER (PARTITION BY row ORDER BY b, kind ROWS UNBOUNDED PRECEDING) AS e,
                row_number() OVER (PARTITION BY row ORDER BY b, kind) AS k FROM base),
gaps AS (SELECT d.row, substr(t, coalesce(p.e, 0)::BIGINT + 1,
                              CASE WHEN f.b IS NULL THEN length(t) ELSE greatest(f.b - coalesce(p.e, 0), 0) END::BIGINT) AS s
         FROM d JOIN (SELECT row, b, k FROM flat UNION ALL
                      SELECT d.row, NULL, coalesce(max(k), 0) + 1 FROM d LEFT JOIN flat USING (row) GROUP BY d.row) f
           ON d.row = f.row LEFT JOIN flat p ON p.row = f.row AND p.k = f.k - 1),
samples AS (SELECT true AS random, CASE kind WHEN 0 THEN v ELSE m END AS s FROM base
            UNION ALL SELECT false, unnest(regexp_extract_all(s, '[A-Za-z0-9+/_-]{6,}')) FROM gaps),
abc AS (SELECT 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-' AS abc),
codes AS (SELECT random, list_transform(string_split(s, ''), lambda c: CASE instr(abc, c) WHEN 0 THEN 67 ELSE instr(abc, c) END) AS c
          FROM samples, abc),
steps AS (SELECT random, c[i] AS x, c[i + 1] AS y, count(*) AS n
          FROM (SELECT random, c, unnest(range(1, len(c))) AS i FROM codes) GROUP BY ALL),
full_ AS (SELECT r.random, x.range AS x, y.range AS y, coalesce(n, 0) + 1 AS n
          FROM (VALUES (true), (false)) r(random), range(1, 68) x, range(1, 68) y
          LEFT JOIN steps ON steps.random = r.random AND steps.x = x.range AND steps.y = y.range),
logs AS (SELECT random, x, y, ln(n / sum(n) OVER (PARTITION BY random, x)) AS l FROM full_),
model AS (SELECT p.x, p.y, CASE WHEN (SELECT count(DISTINCT random) FROM steps) < 2 THEN 0 ELSE round(1000 * (p.l - o.l)) END AS w
          FROM logs p JOIN logs o ON p.x = o.x AND p.y = o.y AND p.random AND NOT o.random),
score AS (SELECT row, b, e FROM (SELECT row, b, e, instr(abc, m[i]) AS x, instr(abc, m[i + 1]) AS y
                                 FROM (SELECT *, unnest(range(1, length(m))) AS i FROM cand), abc)
          JOIN model USING (x, y) GROUP BY ALL HAVING sum(w) > 7000),
named AS (SELECT row, kind, b, ['assign', 'access', 'hex'][kind + 1] || ':' || b || ':' || e AS s FROM base
          UNION ALL SELECT row, 3, b, 'random:' || b || ':' || e FROM score),
per AS (SELECT row, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
               count(*) FILTER (kind = 2) AS n_hex, string_agg(s, ',' ORDER BY b, kind) FILTER (kind < 3) AS base,
               string_agg(s, ',' ORDER BY b, kind) AS spans FROM named GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (row)"""

# The checksum is worked out bit by bit; runs are stretches of words that equal those q further on.
RUNS = """
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
           xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''),
                                                                                      lambda c: ascii(c)::BIGINT)),
               lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
                   lambda r, i: xor(r >> 1, 3988292384 * (r & 1))))) AS h
    FROM documents),
a AS (SELECT *, len(w) AS n, (h // 10) % len(w) AS a, (h // 10) % 8 AS g8 FROM d),
t AS (SELECT row, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
          w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g8)) END]) ELSE w END AS w FROM a),
x AS (SELECT row, n, i, w[i + 1] AS w FROM (SELECT row, n, w, unnest(range(n)) AS i FROM t WHERE n > 0)),
eq AS (SELECT row, p.i, q.i - p.i AS q FROM x p JOIN x q USING (row, w) WHERE q.i > p.i AND 4 * (q.i - p.i) <= p.n),
isl AS (SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS g FROM eq),
long AS (SELECT row, q, min(i) AS s, count(*) + q AS l FROM isl GROUP BY row, q, g
         HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT * FROM long QUALIFY q = min(q) OVER (PARTITION BY row, s, l)),
gone AS (SELECT DISTINCT row, i FROM (SELECT row, unnest(range(s + q, s + l)) AS i FROM runs)),
kept AS (SELECT row, string_agg(w, ' ' ORDER BY i) AS k FROM x ANTI JOIN gone USING (row, i) GROUP BY row),
per AS (SELECT row, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
               arg_min({'s': s, 'l': l, 'q': q}, (-l, s, q)) AS b FROM runs GROUP BY row)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.l AS length, b.q AS period,
       1000 * b.l // b.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(k, '')) AS collapsed_sha256
FROM t LEFT JOIN per USING (row) LEFT JOIN kept USING (row)"""


PHRASES = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')),
               '[^\\x20\\x09]+') AS w FROM documents),
total AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM pieces GROUP BY lang),
f AS (SELECT lang, p, count(*)::HUGEINT AS f FROM (SELECT lang, w[i : i + k - 1] AS p FROM (
          SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 6) r(k))) GROUP BY ALL
      HAVING count(*) >= 100),
big AS (SELECT * FROM f WHERE len(p) > 1),
held AS (SELECT lang, p[i : i + k - 1] AS p, max(f) AS held FROM (
             SELECT lang, p, f, k, unnest(range(1, len(p) - k + 2)) AS i FROM big, range(2, 5) r(k) WHERE k < len(p)) GROUP BY ALL),
cand AS (SELECT b.* FROM big b LEFT JOIN held h ON h.lang = b.lang AND h.p = b.p WHERE h.held IS NULL OR 100 * h.held < 100 * b.f),
cut AS (SELECT c.lang, c.p, c.f AS a, n, k, x.f AS l, y.f AS r, 1000 * c.f * n // (x.f * y.f) AS score
        FROM (SELECT *, unnest(range(1, len(p))) AS k FROM cand) c JOIN total USING (lang)
        JOIN f x ON x.lang = c.lang AND x.p = c.p[1 : k] JOIN f y ON y.lang = c.lang AND y.p = c.p[k + 1 :]),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (SELECT *, array_to_string(p, ' ') AS phrase,
                  row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank FROM best)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": EXACT, "op3_embedding_join": VECTORS, "op6_chat_format": CHATS,
            "op9_suffix_dedup": REPEATS, "op10_ngram_join": JACCARD,
            "op11_secret_scan": SECRETS, "op12_phrase_mining": PHRASES, "op13_periodic_runs": RUNS}
