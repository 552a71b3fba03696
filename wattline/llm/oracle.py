"""SQL twins of the corpus queries that SQL can express, for DuckDB."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP9 = f"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '~') || ':' || md5(coalesce(text, ''))) AS k,
         len({_WORDS}) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM d GROUP BY source),
f AS (SELECT *, 2.0::DOUBLE * source_size / weight AS full_at FROM s),
c AS (
  SELECT *, sum(source_size) OVER () AS all_size, sum(weight) OVER () AS all_weight,
         coalesce(sum(source_size) OVER w, 0) AS size_before, coalesce(sum(weight) OVER w, 0) AS weight_before
  FROM f WINDOW w AS (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (
  SELECT (1.5::DOUBLE * all_size::DOUBLE - 2.0::DOUBLE * size_before::DOUBLE)
         / (all_weight::DOUBLE - weight_before::DOUBLE) AS level, full_at, source
  FROM c),
t AS (
  SELECT source, source_size,
         least(2.0::DOUBLE * source_size,
               (SELECT level FROM l WHERE level <= full_at ORDER BY full_at, source NULLS LAST LIMIT 1) * weight) AS target
  FROM f),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST((budget // greatest(source_size, 1)) * size
            + greatest(0, least(size, budget - (budget // greatest(source_size, 1)) * source_size - place)) AS BIGINT) AS taken
FROM p
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BENCH_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP10 = f"""
WITH d AS (SELECT doc_id, {_BENCH_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, w, least(10, len(w)) AS n
      FROM (SELECT item_id, {_BENCH_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, n, array_to_string(w[p : p + n - 1], ' ') AS gram
      FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM i)),
sizes AS (SELECT DISTINCT n FROM g),
o AS (SELECT doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') AS gram
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d JOIN sizes ON len(w) >= n)),
h AS (SELECT doc_id, p, o.n, item_id FROM o JOIN g USING (n, gram)),
c AS (SELECT doc_id, count(DISTINCT place) AS n_hit
      FROM (SELECT doc_id, unnest(range(p, p + n)) AS place FROM (SELECT DISTINCT doc_id, p, n FROM h)) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
      FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN l USING (doc_id)
"""

OP1 = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
l AS (SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l GROUP BY doc_id),
g AS (SELECT doc_id, p, array_to_string(w[p : p + 7], ' ') AS gram
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM d)),
r AS (SELECT doc_id, count(DISTINCT place) AS n_repeat_words
      FROM (SELECT doc_id, unnest(range(p, p + 8)) AS place
            FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1) GROUP BY doc_id),
m AS (SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(text) - length(regexp_replace(text, '[^\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
             coalesce(n_lines, 0) AS n_lines
      FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN r USING (doc_id)),
f AS (SELECT *, n_words < 20 AS short, 100 * n_repeat_words > 30 * n_words AS repeated,
             10 * n_symbols > 5 * n_words AS symbols, 10 * n_dup_lines > 3 * n_lines AS lines,
             NOT (coalesce(word_chars / nullif(n_words, 0), 0) BETWEEN 2 AND 15) AS word_length FROM m),
h AS (UNPIVOT (SELECT source, count(*) AS n, count_if(short) AS short, count_if(repeated) AS repeated,
                      count_if(symbols) AS symbols, count_if(lines) AS lines, count_if(word_length) AS word_length
               FROM f GROUP BY source) ON short, repeated, symbols, lines, word_length INTO NAME rule VALUE failed),
prior AS (SELECT rule, avg(failed / n) AS mean, var_pop(failed / n) AS var FROM h GROUP BY rule),
strength AS (SELECT rule, mean,
                    CASE WHEN var > 0 THEN least(10000, greatest(1, mean * (1 - mean) / var - 1)) ELSE 10000 END AS k
             FROM prior),
v AS (SELECT source, max((failed + mean * k) / (n + k)) > 0.5 AS host_failed FROM h JOIN strength USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeated AS base_failed,
       NOT (short OR repeated) AND NOT host_failed AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""

_RECORD = """'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
  || page_id || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
  || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, ''))
  || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)"""

OP2 = f"""
WITH r AS (SELECT page_id, html, strlen({_RECORD}) AS length, url, sha256({_RECORD}) AS digest FROM pages),
o AS (SELECT *, CAST(sum(length) OVER (ORDER BY page_id NULLS FIRST, url NULLS FIRST, digest) - length AS BIGINT) AS "offset" FROM r)
SELECT page_id, "offset", CAST(length AS BIGINT) AS length, "offset" >> 26 AS file,
       CASE WHEN page_id % 211 = 7 THEN 'missing' ELSE 'corrupt' END AS status
FROM o WHERE page_id % 211 = 7 OR page_id % 97 = 13 AND contains(html, 'e')
"""

_LINE = "CAST('0x' || substr(md5(line), 1, 7) AS BIGINT)"

OP5 = f"""
WITH d AS (SELECT doc_id, md5(coalesce(CAST(doc_id AS VARCHAR), '~') || ':' || md5(coalesce(text, ''))) AS k,
                  string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT doc_id, k, len(l) AS n_lines, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM d),
h AS (SELECT *, {_LINE} AS h, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 50 AS long FROM x),
e AS (SELECT *, long OR coalesce(lead(long) OVER w, false) OR i = n_lines OR (h + 31337 * coalesce(lag(h) OVER w, 0)) % 2147483647 % 3 = 0 AS ends
      FROM h WINDOW w AS (PARTITION BY k, doc_id ORDER BY i)),
c AS (SELECT *, coalesce(sum(CAST(ends AS INT)) OVER (PARTITION BY k, doc_id ORDER BY i
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM e),
b AS (SELECT doc_id, k, chunk, any_value(n_lines) AS n_lines, count(*) AS own, string_agg(line, chr(10) ORDER BY i) AS body,
             count_if(regexp_matches(line, '[^\x20\x09-\x0D]')) AS n_full, bool_or(long) AS long
      FROM c GROUP BY doc_id, k, chunk),
s AS (SELECT *, (n_full >= 2 OR long) AND row_number() OVER (PARTITION BY body ORDER BY doc_id NULLS LAST, k, chunk) > 1 AS gone FROM b)
SELECT doc_id, CAST(any_value(n_lines) AS INT) AS n_lines, CAST(count_if(gone) AS INT) AS n_removed,
       CAST(coalesce(sum(own) FILTER (gone), 0) AS INT) AS lines_removed,
       coalesce(string_agg(body, chr(10) ORDER BY chunk) FILTER (NOT gone), '') AS text
FROM s GROUP BY doc_id, k
"""

OP11 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, {_BENCH_WORDS} AS w FROM documents),
g AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d),
i AS (
  SELECT item_id, no, term, count(*) AS repeats
  FROM (SELECT item_id, no, unnest({_BENCH_WORDS}) AS term
        FROM (SELECT item_id, text, row_number() OVER () AS no FROM (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark)))
  GROUP BY ALL),
t AS (
  SELECT row, doc_id, n, term, count(*) AS tf
  FROM (SELECT row, doc_id, len(w) AS n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY ALL),
h AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM t GROUP BY term), g),
s AS (
  SELECT item_id, no, row, doc_id,
         CAST(sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM t JOIN h USING (term) JOIN i USING (term), g GROUP BY item_id, no, row, doc_id),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY no ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""


def _refined(books: str) -> str:
    """Codebooks after one round."""
    return f"""
  SELECT part, entry, place, coalesce(y, x) AS x
  FROM {books} LEFT JOIN (
    SELECT part, entry, place, CAST(floor(sum(x)::DOUBLE / count(*)::DOUBLE) AS BIGINT) AS y
    FROM c JOIN ({_nearest(books)}) USING (row, part) GROUP BY part, entry, place) USING (part, entry, place)"""


def _nearest(books: str) -> str:
    """The nearest entry of each part and its distance."""
    return f"""
    SELECT row, part, min_by(entry, distance * 64 + entry) AS entry, min(distance) AS distance
    FROM (SELECT row, part, entry, CAST(sum((c.x - b.x) * (c.x - b.x)) AS BIGINT) AS distance
          FROM c JOIN {books} AS b USING (part, place) GROUP BY row, part, entry)
    GROUP BY row, part"""


OP13 = f"""
WITH k AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST) AS row,
         list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c AS MATERIALIZED (
  SELECT row, p // (len(v) // 16) AS part, p % (len(v) // 16) AS place, v[p + 1] AS x
  FROM (SELECT row, v, unnest(range(0, len(v))) AS p FROM k)),
b0 AS MATERIALIZED (SELECT part, row - 1 AS entry, place, x FROM c WHERE row <= 64),
b1 AS MATERIALIZED ({_refined("b0")}),
b2 AS MATERIALIZED ({_refined("b1")}),
e AS (
  SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(distance) AS BIGINT) AS error
  FROM ({_nearest("b2")}) GROUP BY row)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, place)) FROM b2) AS codebooks_sha256
FROM k JOIN e USING (row)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_host_rules": OP1,
        "op2_merkle_fixity": OP2,
        "op5_line_chunks": OP5,
        "op9_source_mixing": OP9,
        "op10_benchmark_winnowing": OP10,
        "op11_lexical_search": OP11,
        "op13_value_codes": OP13,
    }
