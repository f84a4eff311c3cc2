"""The registered queries of this package, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import language_id, line_quality
from millrace.llm.collocations import collocations
from millrace.llm.common import held_out, table
from millrace.llm.decontamination import leaks
from millrace.llm.importance_resampling import resampled
from millrace.llm.license_scan import scan_licenses
from millrace.llm.line_dedup import deduplicated_lines
from millrace.llm.near_duplicates import near_duplicates
from millrace.llm.packing import pack
from millrace.llm.permutation_index import nearest_neighbours
from millrace.llm.repeated_bytes import without_repeats
from millrace.llm.token_counts import count_tokens
from millrace.llm.url_filters import Rule, judge_urls
from millrace.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache, so that every distinct content is encoded."""
    cache = scratch_path(spark, "token-cache")
    return count_tokens(table(spark, sf_dir, "documents"), cache, public_tokenizers.path("word_bpe_49k.json"))


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, ranks = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
    return pack(table(spark, sf_dir, "documents"), path, ranks)


@query("op10_nearest_neighbours")
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), every=50)


RULES = (
    Rule("allow", "com"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

#: Recursion walks the declared edges from every node; the least node reached names the component.
URL_SQL = r"""
WITH RECURSIVE parts AS (
  SELECT page_id, html, url,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
fits AS (
  SELECT page_id, host, path, rule, v FROM parts,
    (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
            ('block', 'net', '/es/'), ('block', 'net', '/fr/')) r(v, h, p), LATERAL (SELECT h || p AS rule)
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)),
own AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(v, length(rule)) AS v FROM fits GROUP BY page_id),
form AS (
  SELECT page_id, html, url, host, path,
    CASE WHEN contains(url, '://') THEN host || regexp_replace(path, '/+$', '') || CASE WHEN len(kept) = 0 THEN ''
      ELSE '?' || array_to_string(kept, '&') END END AS node
  FROM (SELECT *, [x FOR x IN string_split(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), '&')
      IF x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)')] AS kept FROM parts)),
tags AS (SELECT node, url, host, path, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM form),
named AS (
  SELECT node, url, host, path, CASE WHEN regexp_matches(tag, '(?is)http-equiv\s*=\s*["'']?refresh\b')
    THEN regexp_extract(value, '(?is)\burl\s*=\s*["'']?([^"''\s;]+)', 1) ELSE value END AS t
  FROM (SELECT *, trim(replace(regexp_replace(regexp_extract(tag, '(?is)\b(?:href|content)\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1),
      '^["'']|["'']$', '', 'g'), '&amp;', '&')) AS value FROM tags WHERE regexp_matches(tag,
    '(?is)(rel\s*=\s*["'']?canonical\b|property\s*=\s*["'']?og:url\b|http-equiv\s*=\s*["'']?refresh\b)'))),
whole AS (
  SELECT node, CASE WHEN regexp_matches(t, '(?i)^https?://') THEN t WHEN starts_with(t, '//') THEN 'http:' || t
    WHEN regexp_matches(t, '^([A-Za-z][A-Za-z0-9+.-]*:|#)') THEN NULL WHEN starts_with(t, '/') THEN 'http://' || host || t
    WHEN starts_with(t, '?') THEN 'http://' || host || path || t
    ELSE 'http://' || host || CASE WHEN contains(path, '/') THEN regexp_extract(path, '(?s)^(.*/)', 1) ELSE '/' END || t END AS t
  FROM named WHERE t <> '' AND contains(url, '://')),
cut AS (
  SELECT node, lower(regexp_extract(t, '(?s)^.*?://([^/?#]*)', 1)) AS h, regexp_extract(t, '(?s)^[^?#]*\?([^#]*)', 1) AS q,
    list_transform(string_split(regexp_extract(t, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '/'), lambda x: [x]) AS p FROM whole WHERE t IS NOT NULL),
edges AS (
  SELECT node AS a, h || regexp_replace(array_to_string(list_reduce(p, lambda acc, x: CASE WHEN x[1] = '.' THEN acc
      WHEN x[1] = '..' THEN acc[1:greatest(len(acc) - 1, 1)] ELSE list_concat(acc, x) END), '/'), '/+$', '')
    || CASE WHEN len(kept) = 0 THEN '' ELSE '?' || array_to_string(kept, '&') END AS b
  FROM (SELECT *, [x FOR x IN string_split(q, '&') IF x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)')] AS kept FROM cut)),
ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(node, other) AS (
  SELECT node, node FROM form WHERE node IS NOT NULL
  UNION SELECT reach.node, ways.b FROM reach JOIN ways ON reach.other = ways.a),
alias AS (SELECT node, min(other) AS alias_of FROM reach GROUP BY node),
marks AS (SELECT alias_of, bool_or(v = 'block') AND NOT coalesce(bool_or(v = 'allow'), false) AS blocked
  FROM form JOIN alias USING (node) LEFT JOIN own USING (page_id) GROUP BY alias_of)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict, alias_of
FROM form LEFT JOIN own USING (page_id) LEFT JOIN alias USING (node) LEFT JOIN marks USING (alias_of)
"""


@query("op2_url_filters", URL_SQL)
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), RULES)


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.filter(~held_out()))
    return language_id.predict(docs, model, extra=held_out())


@query("op9_line_quality")
def op9_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = line_quality.fit(docs, labels.filter(~held_out()))
    return line_quality.score(docs, model, extra=held_out())


LEAK_SQL = r"""
WITH texts AS (
  SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
words AS (
  SELECT kind, id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
  FROM texts),
grams AS (
  SELECT DISTINCT kind, id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN ['short ' || array_to_string(w, ' ')] ELSE [] END) AS g FROM words),
sizes AS (SELECT id, count(*) AS n FROM grams WHERE kind = 1 GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS shared, count(*) / any_value(n) AS containment
FROM grams d JOIN grams i ON d.g = i.g AND d.kind = 0 AND i.kind = 1 JOIN sizes ON sizes.id = i.id
GROUP BY d.id, i.id HAVING count(*) / any_value(n) >= 0.8
"""


@query("op5_benchmark_leaks", LEAK_SQL)
def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_near_duplicates")
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op1_line_dedup")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated_lines(table(spark, sf_dir, "documents"), counts=True)


@query("op4_license_scan")
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


#: The checksum is worked out byte by byte from its table, which the first two steps derive.
RESAMPLING_SQL = r"""
WITH RECURSIVE steps(i, k, c) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS step FROM steps WHERE k = 8),
texts AS (
  SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
words AS (
  SELECT kind, id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM texts),
runs AS (
  SELECT kind, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], ' ')),
    list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))) AS feature FROM words),
counted AS (SELECT kind, id, feature, count(*) AS n FROM runs GROUP BY ALL),
bytes AS (
  SELECT feature, hex(encode(feature)) AS h, list_transform(range(0, octet_length(encode(feature))), lambda i:
    16 * (ord(h[2 * i + 1]) - CASE WHEN h[2 * i + 1] <= '9' THEN 48 ELSE 55 END)
    + ord(h[2 * i + 2]) - CASE WHEN h[2 * i + 2] <= '9' THEN 48 ELSE 55 END) AS b
  FROM (SELECT DISTINCT feature FROM counted)),
hashed AS (
  SELECT feature, xor(list_reduce(list_prepend(4294967295, list_transform(b, lambda x: CAST(x AS BIGINT))),
    lambda c, x: xor(c >> 8, step[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM bytes, crc),
placed AS (SELECT kind, id, bucket, n FROM counted JOIN hashed USING (feature)),
sides AS (
  SELECT bucket, sum(n) FILTER (kind = 0) AS s, sum(n) FILTER (kind = 1) AS t FROM placed GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE)
    * CAST((SELECT sum(coalesce(s, 0)) FROM sides) + 10000 AS DOUBLE)
    / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * CAST((SELECT sum(coalesce(t, 0)) FROM sides) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM sides),
weights AS (
  SELECT id AS doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight
  FROM placed JOIN gains USING (bucket) WHERE kind = 0 GROUP BY id),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) + 0.5)
      / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
  FROM (SELECT id AS doc_id, w FROM words WHERE kind = 0) LEFT JOIN weights USING (doc_id)),
ordered AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ordered USING (doc_id)
"""


@query("op11_importance_resampling", RESAMPLING_SQL)
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


COLLOCATION_SQL = r"""
WITH lowered AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents),
pieces AS (SELECT lang, unnest(pieces) AS piece FROM lowered),
words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
runs AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM words, (VALUES (1), (2), (3)) s(size)),
freq AS (SELECT lang, size, phrase, count(*) AS a FROM runs GROUP BY ALL),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM freq WHERE size > 1 AND a >= 10),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)),
scores AS (
  SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r,
    CAST((1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a) AS BIGINT) AS score
  FROM cuts c JOIN freq l ON l.lang = c.lang AND l.phrase = head JOIN freq r ON r.lang = c.lang AND r.phrase = tail),
worst AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, a, array_to_string(w[1:2], ' ') AS phrase FROM candidates WHERE size = 3
  UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM candidates WHERE size = 3),
kept AS (
  SELECT * FROM worst x WHERE NOT EXISTS (
    SELECT 1 FROM inner_parts i WHERE i.lang = x.lang AND i.phrase = x.phrase AND 100 * i.a >= 50 * x.a))
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""


@query("op12_collocations", COLLOCATION_SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


#: Bytes as two hexadecimal digits each; the least place of each window, then gaps and islands.
REPEATS_SQL = r"""
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
blocks AS (
  SELECT doc_id, base, substr(h, 2 * base + 1, 1198) AS part FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99, 500)) AS base FROM bytes)),
windows AS (
  SELECT doc_id, base + i AS i, md5_number(substr(part, 2 * i + 1, 200)) AS w
  FROM (SELECT doc_id, base, part, unnest(range(0, len(part) // 2 - 99)) AS i FROM blocks)),
firsts AS (SELECT w, min(doc_id * 4294967296 + i) AS place FROM windows GROUP BY w),
late AS (SELECT doc_id, i FROM windows JOIN firsts USING (w) WHERE doc_id * 4294967296 + i > place),
marked AS (
  SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true) AS fresh FROM late),
numbered AS (SELECT doc_id, i, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
runs AS (SELECT doc_id, min(i) AS lo, max(i) + 100 AS hi FROM numbered GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS a, lo AS b FROM runs
  UNION ALL SELECT doc_id, max(hi), CAST(9223372036854775807 AS BIGINT) FROM runs GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (least(b, len(h) // 2) - a)), '' ORDER BY a) AS h FROM gaps JOIN bytes USING (doc_id) GROUP BY doc_id),
sums AS (SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT doc_id, CAST(len(b.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k.h, b.h))) AS kept_sha256
FROM bytes b LEFT JOIN kept k USING (doc_id) LEFT JOIN sums USING (doc_id)
"""


@query("op13_suffix_array_dedup", REPEATS_SQL)
def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).drop("kept")
