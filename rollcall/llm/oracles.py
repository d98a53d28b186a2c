"""SQL for the queries of the operators, where SQL can say the same (DuckDB)."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
escaped AS (SELECT *, length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS text_chars,
  length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) AS role_chars FROM rows)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(text_chars + role_chars + length('<|im_start|>') + length('<|im_end|>') + 2) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""

QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
runs AS (SELECT rid, i, [w[i], w[i + 1], w[i + 2]] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
repeated AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM runs) WHERE c > 1),
covered AS (
  SELECT rid, sum(least(3, step)) AS n FROM (
    SELECT rid, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 3) AS step FROM repeated) GROUP BY rid),
lines AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
m AS (
  SELECT d.rid, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM d JOIN lines USING (rid) LEFT JOIN covered USING (rid)),
f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    1000 * n_symbols // greatest(word_chars, 1) AS symbol_rate, 1000 * n_dup_lines // greatest(n_lines, 1) AS dup_line_rate,
    1000 * n_repeat_words // greatest(n_words, 1) AS repeat_rate, 100 * word_chars // greatest(n_words, 1) AS word_length FROM m),
long AS (
  SELECT lang, source, 'symbol_rate' AS k, 50 AS slack, symbol_rate AS x FROM f WHERE NOT base_failed
  UNION ALL SELECT lang, source, 'dup_line_rate', 300, dup_line_rate FROM f WHERE NOT base_failed
  UNION ALL SELECT lang, source, 'repeat_rate', 100, repeat_rate FROM f WHERE NOT base_failed
  UNION ALL SELECT lang, source, 'word_length', 300, word_length FROM f WHERE NOT base_failed),
shifted AS (SELECT *, greatest(length(bin(x)) - 6, 0) AS s FROM long),
buckets AS (SELECT lang, source, k, slack, (((x >> s) + 1) * (1::BIGINT << s)) - 1 AS edge, count(*) AS n FROM shifted GROUP BY ALL),
run AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, k ORDER BY edge) AS upto, sum(n) OVER (PARTITION BY lang, source, k) AS total FROM buckets),
q AS (
  SELECT lang, source, k, slack, min(edge) FILTER (upto * 100 >= total * 50) AS middle, min(edge) FILTER (upto * 100 >= total * 90) AS high
  FROM run GROUP BY ALL),
limits AS (
  SELECT lang, source, max(high + 3 * (high - middle) + slack) FILTER (k = 'symbol_rate') AS a, max(high + 3 * (high - middle) + slack) FILTER (k = 'dup_line_rate') AS b,
    max(high + 3 * (high - middle) + slack) FILTER (k = 'repeat_rate') AS c, max(high + 3 * (high - middle) + slack) FILTER (k = 'word_length') AS e
  FROM q GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(symbol_rate > a OR dup_line_rate > b OR repeat_rate > c OR word_length > e, false) AS kept
FROM f LEFT JOIN limits ON f.lang IS NOT DISTINCT FROM limits.lang AND f.source IS NOT DISTINCT FROM limits.source
"""

MIX = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size,
    CAST('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 15) AS BIGINT) AS place FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s),
f AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][CAST(rank % 3 + 1 AS INTEGER)] AS weight, 2.0::DOUBLE * source_size AS most FROM w),
o AS (
  SELECT *, most / weight AS full_at, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, rank
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY most / weight, rank
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM f),
v AS (SELECT level FROM o WHERE full_at > level ORDER BY full_at, rank LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN (SELECT level FROM v) IS NULL THEN most ELSE least(most, (SELECT level FROM v) * weight) END AS target FROM o),
b AS (SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS whole FROM t),
c AS (SELECT *, target - whole * source_size AS budget FROM b),
p AS (
  SELECT d.source, place, sum(size) AS width, sum(sum(size)) OVER (PARTITION BY d.source ORDER BY place) AS after
  FROM d WHERE size > 0 GROUP BY d.source, place),
h AS (
  SELECT c.source, arg_min(struct_pack(place := place, before := after - width, width := width), place) AS hit
  FROM c JOIN p ON c.source IS NOT DISTINCT FROM p.source WHERE after > budget GROUP BY c.source),
l AS (
  SELECT c.*, CASE WHEN hit IS NULL THEN 1152921504606846976
    WHEN hit.before + hit.width - budget < budget - hit.before THEN hit.place + 1 ELSE hit.place END AS below
  FROM c LEFT JOIN h ON c.source IS NOT DISTINCT FROM h.source)
SELECT doc_id, size, source_size, target, CAST(least(2, whole + CASE WHEN size > 0 AND place < below THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM d JOIN l ON d.source IS NOT DISTINCT FROM l.source
"""

SUBSTRING = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w FROM documents),
runs AS (SELECT rid, doc_id, i, w[i : i + 12] AS g FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
late AS (SELECT rid, i FROM (SELECT rid, doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM runs) WHERE doc_id > least),
gone AS (SELECT rid, list(DISTINCT k) AS gone FROM (SELECT rid, i + unnest(range(0, 13)) AS k FROM late) GROUP BY rid),
kept AS (
  SELECT doc_id, w, coalesce(len(gone), 0) AS n_removed, CASE WHEN gone IS NULL THEN w ELSE
    list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(gone, x[2])), lambda x: x[1]) END AS left_words
  FROM d LEFT JOIN gone USING (rid))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
  sha256(array_to_string(left_words, ' ')) AS kept_sha256 FROM kept
"""

JACCARD = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, w[i : i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 90 * (x.n + y.n - shared)),
r AS (SELECT a AS doc_id, a AS c FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.c = e.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce((SELECT min(c) FROM r WHERE r.doc_id = d.doc_id), d.doc_id) AS component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id
"""

SUFFIX = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
s AS (SELECT rid, doc_id, i, substr(x, 2 * i + 1, 100) AS g FROM (SELECT rid, doc_id, x, unnest(range(0, len(x) // 2 - 49)) AS i FROM d)),
late AS (SELECT rid, i FROM (SELECT rid, doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM s) WHERE doc_id > least),
runs AS (SELECT rid, min(i) AS a, max(i) + 50 AS b FROM (
  SELECT rid, i, sum(far) OVER (PARTITION BY rid ORDER BY i) AS run FROM (
    SELECT rid, i, CASE WHEN i > lag(i) OVER (PARTITION BY rid ORDER BY i) + 50 THEN 1 ELSE 0 END AS far FROM late)) GROUP BY rid, run),
gaps AS (SELECT rid, a, b, lead(a) OVER (PARTITION BY rid ORDER BY a) AS after FROM runs),
cut AS (
  SELECT d.rid, count(*) AS n_spans, sum(b - a) AS n_removed, min(a) AS front,
    string_agg(substr(x, 2 * b + 1, CASE WHEN after IS NULL THEN len(x) ELSE 2 * (after - b) END), '' ORDER BY a) AS rest
  FROM d JOIN gaps USING (rid) GROUP BY d.rid)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN front IS NULL THEN x ELSE substr(x, 1, 2 * front) || rest END)) AS kept_sha256
FROM d LEFT JOIN cut USING (rid)
"""

CAPTURES = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS t, row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST) AS nth,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS head FROM pages),
h AS (SELECT *, list_transform(range(0, 8), lambda k: CAST('0x' || substr(sha1(t), 5 * k + 1, 5) AS BIGINT)) AS fives FROM p)
SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(fives, lambda v: array_to_string(list_transform([15, 10, 5, 0],
    lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> b) & 31 AS INTEGER) + 1, 1)), '')), '') AS payload_digest,
  CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN nth > 1 THEN head END AS refers_to
FROM h
"""

CODES_START = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS rid, vec_id, label, list_transform(embedding, lambda c: CAST(floor(4096 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
c AS MATERIALIZED (
  SELECT rid, (i - 1) // (len(x) // 8) AS part, (i - 1) % (len(x) // 8) AS place, x[i] AS x FROM (SELECT rid, x, unnest(range(1, len(x) + 1)) AS i FROM v)),
b0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, place, x AS e FROM c WHERE rid <= 16)"""

CODES_ROUND = """,
a{r} AS MATERIALIZED (
  SELECT rid, part, min(struct_pack(d := d, k := entry)) AS best FROM (
    SELECT rid, c.part, entry, sum((x - e) * (x - e)) AS d FROM c JOIN b{r} b ON c.part = b.part AND c.place = b.place GROUP BY ALL) GROUP BY ALL)"""

CODES_NEXT = """,
m{r} AS (SELECT c.part, a.best.k AS entry, place, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM c JOIN a{r} a ON c.rid = a.rid AND c.part = a.part GROUP BY ALL),
b{next} AS MATERIALIZED (
  SELECT b.part, b.entry, b.place, CAST(CASE WHEN n IS NULL THEN e ELSE (s - ((s % n) + n) % n) // n END AS BIGINT) AS e
  FROM b{r} b LEFT JOIN m{r} m ON b.part = m.part AND b.entry = m.entry AND b.place = m.place)"""

CODES_END = """,
o AS (
  SELECT rid, string_agg(printf('%02x', best.k), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a6 GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(e AS VARCHAR), ',' ORDER BY part, entry, place)) FROM b6) AS codebooks_sha256
FROM v JOIN o USING (rid)
"""

#: Six rounds, written out one after another, and the last assignment.
CODES = CODES_START + "".join(CODES_ROUND.format(r=r) + CODES_NEXT.format(r=r, next=r + 1) for r in range(6)) + CODES_ROUND.format(r=6) + CODES_END

ORACLES = {
    "op1_chat_formatting": CHAT,
    "op3_ngram_jaccard": JACCARD,
    "op4_suffix_dedup": SUFFIX,
    "op6_quality_rules": QUALITY,
    "op9_source_mix": MIX,
    "op10_substring_dedup": SUBSTRING,
    "op11_warc_captures": CAPTURES,
    "op13_vector_codes": CODES,
}
