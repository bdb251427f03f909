"""SQL that gives the same rows as a query, for the queries that SQL can express."""

_WORD = r"[^\x20\x09-\x0D]+"

LINE_DEDUP = rf"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) - 1 AS line_no, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL)),
sets AS (
  SELECT * FROM (SELECT doc_id, line_no,
    list_sort(list_distinct(regexp_extract_all(line, '{_WORD}'))) AS tokens FROM lines)
  WHERE len(tokens) > 0),
classes AS (
  SELECT row_number() OVER (ORDER BY min(doc_id * 1000000 + line_no)) AS cls, tokens,
         min(doc_id * 1000000 + line_no) AS first_at FROM sets GROUP BY tokens),
words AS (SELECT cls, len(tokens) AS n, unnest(tokens) AS token FROM classes),
ranked AS (
  SELECT cls, n, token, row_number() OVER (PARTITION BY cls ORDER BY spread, token) AS place
  FROM (SELECT *, count(*) OVER (PARTITION BY token) AS spread FROM words)),
prefix AS (SELECT * FROM ranked WHERE place <= n - (n * 80 + 99) // 100 + 1),
pairs AS (
  SELECT DISTINCT a.cls AS earlier, b.cls AS later FROM prefix a JOIN prefix b
  ON a.token = b.token AND a.cls < b.cls AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
dropped AS (
  SELECT DISTINCT later AS cls FROM (
    SELECT later, len(x.tokens) AS n, len(y.tokens) AS m,
           len(list_intersect(x.tokens, y.tokens)) AS shared
    FROM pairs JOIN classes x ON x.cls = earlier JOIN classes y ON y.cls = later)
  WHERE 100 * shared >= 80 * (n + m - shared)),
judged AS (
  SELECT doc_id, line_no, doc_id * 1000000 + line_no > first_at OR d.cls IS NOT NULL AS gone
  FROM sets JOIN classes c USING (tokens) LEFT JOIN dropped d ON d.cls = c.cls),
found AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
         string_agg(line_no, ',' ORDER BY line_no) FILTER (WHERE gone) AS removed
  FROM judged GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       coalesce(removed, '') AS removed
FROM documents LEFT JOIN found USING (doc_id)"""

NEAR_DUPS = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1),
           lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) END AS s FROM words),
reps AS (SELECT s, min(doc_id) AS rep, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
each AS (SELECT rep, n, unnest(s) AS shingle FROM reps),
ranked AS (
  SELECT rep, n, shingle, row_number() OVER (PARTITION BY rep ORDER BY spread, shingle) AS place
  FROM (SELECT *, count(*) OVER (PARTITION BY shingle) AS spread FROM each)),
prefix AS (SELECT * FROM ranked WHERE place <= n - (n * 85 + 99) // 100 + 1),
pairs AS (
  SELECT DISTINCT a.rep AS a, b.rep AS b FROM prefix a JOIN prefix b
  ON a.shingle = b.shingle AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)),
links AS (
  SELECT a, b FROM (SELECT a, b, x.n + y.n AS both_n, len(list_intersect(x.s, y.s)) AS shared
    FROM pairs JOIN reps x ON x.rep = a JOIN reps y ON y.rep = b)
  WHERE 100 * shared >= 85 * (both_n - shared)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
labels AS (SELECT a AS rep, min(b) AS label FROM reach GROUP BY a)
SELECT doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles,
       coalesce(least(label, reps.rep), doc_id) AS component_id,
       doc_id = coalesce(least(label, reps.rep), doc_id) AS kept
FROM sets LEFT JOIN reps ON reps.s = sets.s LEFT JOIN labels USING (rep)"""

SUBSTRING_DEDUP = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
each AS (
  SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS word, len(w) AS n, w FROM words),
windows AS (
  SELECT doc_id, i, word,
    CASE WHEN i + 19 <= n THEN array_to_string(w[i : i + 19], ' ') END AS span FROM each),
seen AS (
  SELECT doc_id, i, word, span IS NOT NULL
    AND row_number() OVER (PARTITION BY span ORDER BY doc_id, i) > 1 AS again FROM windows),
covered AS (
  SELECT doc_id, i, word, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i
    ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM seen),
found AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
         string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept
  FROM covered GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN found USING (doc_id)"""

WARC = """
WITH p AS (SELECT page_id, nullif(url, '') AS url, coalesce(html, '') AS payload FROM pages),
b AS (
  SELECT *, CAST(CAST(unhex(sha1(payload)) AS BIT) AS VARCHAR) AS bits,
         min(page_id) OVER (PARTITION BY payload) AS first_id FROM p)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + list_sum(list_transform(range(0, 5),
          lambda k: CAST(substr(bits, 5 * i + k + 1, 1) AS INT) * (16 >> CAST(k AS INT))))::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to, url
FROM b"""

SUFFIX_DEDUP = """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
each AS (
  SELECT doc_id, i, substr(h, 2 * i - 1, 2) AS byte,
    CASE WHEN i + 99 <= len(h) // 2 THEN md5(substr(h, 2 * i - 1, 200)) END AS string
  FROM (SELECT doc_id, h, unnest(range(1, len(h) // 2 + 1)) AS i FROM bytes)),
seen AS (
  SELECT doc_id, i, byte, string IS NOT NULL
    AND row_number() OVER (PARTITION BY string ORDER BY doc_id, i) > 1 AS again FROM each),
covered AS (
  SELECT doc_id, i, byte, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i
    ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM seen),
edges AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens
  FROM covered),
found AS (
  SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (WHERE gone) AS n_removed,
         count(*) FILTER (WHERE opens) AS n_spans,
         string_agg(byte, '' ORDER BY i) FILTER (WHERE NOT gone) AS kept
  FROM edges GROUP BY doc_id)
SELECT doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM documents LEFT JOIN found USING (doc_id)"""

URL_RULES = r"""
WITH parts AS (
  SELECT row_number() OVER () AS row, page_id, lower_url,
    translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, coalesce(url, '') AS u, translate(coalesce(url, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_url FROM pages)),
sites(verdict, host, path) AS (VALUES
  ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
labels_of(verdict, pattern, start) AS (VALUES
  ('block', '||casino-', 'casino-'), ('block', '||cheap-pills.', 'cheap-pills\.'),
  ('block', '||adult-', 'adult-'), ('block', '||ads-*.', 'ads-.*\.'), ('block', '||spam-', 'spam-'),
  ('block', '||free-bets.', 'free-bets\.'), ('allow', '||spam-*/es/', 'spam-.*/es/')),
by_site AS (
  SELECT row, arg_max(s.host || s.path, length(s.host || s.path)) AS rule,
         arg_max(s.verdict, length(s.host || s.path)) AS verdict
  FROM parts p JOIN sites s
    ON (p.host = s.host OR ends_with(p.host, '.' || s.host)) AND starts_with(p.path, s.path) GROUP BY row),
by_pattern AS (
  SELECT row, arg_max(l.verdict, strength) AS verdict, arg_max(l.pattern, strength) AS pattern
  FROM (SELECT row, verdict, pattern,
               CASE WHEN verdict = 'allow' THEN 1000 ELSE 0 END + length(pattern) AS strength
        FROM parts, labels_of
        WHERE regexp_matches(lower_url, '(?s)^[^:/?#]*://([^/?#]*\.)?' || start)) l GROUP BY row)
SELECT page_id, host, path, s.rule AS rule, coalesce(s.verdict, t.verdict, 'allow') AS verdict,
       CASE WHEN s.rule IS NULL THEN t.pattern END AS pattern
FROM parts LEFT JOIN by_site s USING (row) LEFT JOIN by_pattern t USING (row)"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS = f"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')"""

RANKED_SEARCH = f"""
WITH held AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
sizes AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS size, sum(len(terms)) AS total FROM held),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
counts AS (
  SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM held)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(size) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, sizes GROUP BY term),
shares AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * size) // CAST(total AS BIGINT)))) AS share
  FROM counts JOIN weights USING (term), sizes),
scores AS (
  SELECT item_id, doc_id, CAST(sum(share) AS BIGINT) AS score FROM wanted JOIN shares USING (term) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scores WHERE score > 0) WHERE rank <= 50"""

FILTER_AUDIT = rf"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
failed AS (
  SELECT part,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask,
    doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good,
    doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic
  FROM words),
held AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM failed GROUP BY ALL),
letters(l, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS before
  FROM (SELECT filter_order, bits, unnest(range(1, 6)) AS step FROM orders)),
counted AS (
  SELECT part, filter_order, step, bit,
    sum(n) FILTER (WHERE mask & (before | bit) = 0) AS kept,
    sum(n) FILTER (WHERE mask & bit > 0 AND mask & before = 0) AS removed,
    sum(n) FILTER (WHERE mask & bit > 0 AND mask & before > 0) AS redundant,
    sum(n) FILTER (WHERE mask = bit) AS unique_fails,
    sum(good) FILTER (WHERE mask & bit > 0 AND mask & before = 0) AS good_lost,
    sum(toxic) FILTER (WHERE mask & bit > 0 AND mask & before = 0) AS toxic_lost
  FROM steps, held GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
  CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, bit), 0) AS BIGINT) AS shapley
FROM counted"""

SQL = {
    "op1_line_dedup": LINE_DEDUP,
    "op3_near_dups": NEAR_DUPS,
    "op5_substring_dedup": SUBSTRING_DEDUP,
    "op8_warc": WARC,
    "op10_suffix_dedup": SUFFIX_DEDUP,
    "op11_url_rules": URL_RULES,
    "op12_ranked_search": RANKED_SEARCH,
    "op13_filter_audit": FILTER_AUDIT,
}
