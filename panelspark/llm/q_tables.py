"""Queries on sources, urls and vectors: op4 (mixing), op8 (top-k), op10 (URL filters)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.llm import mixing, url_filter, vector_search
from panelspark.llm.catalog import query
from panelspark.llm.common import table

MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3 * CAST(sum(size) AS BIGINT) AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM d GROUP BY source),
run AS (
  SELECT *, row_number() OVER w AS nth,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM per WINDOW w AS (ORDER BY cap / weight, source NULLS LAST)),
flag AS (SELECT *, level * weight >= cap AS is_full FROM run),
tgt AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap::DOUBLE
         ELSE (SELECT arg_min(level, nth) FROM flag WHERE NOT is_full) * weight END AS target FROM flag),
line AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS want,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(CAST(d.doc_id AS VARCHAR)), d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN tgt t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(greatest(0, least(start + size, want) - start)
          + greatest(0, least(start + source_size + size, want) - (start + source_size))
          + greatest(0, least(start + 2 * source_size + size, want) - (start + 2 * source_size)) AS BIGINT) AS taken
FROM line
"""


@query("op4_source_mix", MIX_SQL)
def op4(spark, sf_dir):
    """Words every document gives to the mix of all sources."""
    got = mixing.taken_words(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "source_size", "target", "taken")


URL_SQL = r"""
WITH u AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
o AS (SELECT doc_id AS page_id, count(*)::DOUBLE AS n, sum(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END)::DOUBLE AS b
      FROM labels GROUP BY doc_id),
h0 AS (SELECT host, coalesce(sum(n), 0)::DOUBLE AS n, coalesce(sum(b), 0)::DOUBLE AS b, string_split(host, '.') AS parts
       FROM p LEFT JOIN o USING (page_id) GROUP BY host),
h1 AS (SELECT *, len(parts) AS k, CASE WHEN len(parts) >= 3 AND length(parts[-1]) = 2
         AND parts[-2] IN ('ac','co','com','edu','gov','net','org') THEN 2 ELSE 1 END AS ns FROM h0),
h AS (SELECT host, n, b, array_to_string(parts[greatest(1, k - ns + 1):k], '.') AS suffix,
             array_to_string(parts[greatest(1, k - ns):k], '.') AS domain FROM h1),
dom AS (SELECT domain, suffix, sum(n) AS n, sum(b) AS b FROM h GROUP BY domain, suffix),
suf AS (SELECT suffix, sum(n) AS n, sum(b) AS b FROM dom GROUP BY suffix),
base AS (SELECT (coalesce(sum(b), 0.0) + 1) / (coalesce(sum(n), 0.0) + 2) AS rate FROM suf),
suf2 AS (SELECT suffix, (b + 20.0 * rate) / (n + 20.0) AS m FROM suf, base),
dom2 AS (SELECT domain, (dom.b + 20.0 * m) / (dom.n + 20.0) AS m FROM dom JOIN suf2 USING (suffix)),
ab AS (SELECT host, h.b + 20.0 * m AS a, h.n - h.b + 20.0 * (1 - m) AS c FROM h JOIN dom2 USING (domain)),
rep AS (SELECT host, a / (a + c) - 1.645 * sqrt(a * c / ((a + c) * (a + c) * (a + c + 1))) AS lower FROM ab),
r AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN lower > 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM r JOIN rep USING (host)
"""


@query("op10_url_filter", URL_SQL)
def op10(spark, sf_dir):
    """List rule or host reputation for every page.  The labelled outcomes are the
    rows of ``labels`` with the page's number: bad if toxic or of low quality."""
    labels = table(spark, sf_dir, "labels")
    bad = ((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), F.coalesce(bad, F.lit(0)).alias("bad"))
    got = url_filter.judge_urls(table(spark, sf_dir, "pages"), outcomes)
    return got.select("page_id", "host", "path", "rule", "verdict")


TOP_SQL = r"""
WITH ok AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM ok q JOIN ok r ON q.vec_id <> r.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rn FROM pairs)
SELECT query_id, CAST(rn AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rn <= 20
"""


@query("op8_top_k", TOP_SQL)
def op8(spark, sf_dir):
    """The 20 best rows of every 20th vector."""
    rows = vector_search.scaled(table(spark, sf_dir, "embeddings"))
    return vector_search.top_k(rows.filter(F.col("vec_id") % 20 == 0), rows)
