"""Queries on units, terms and neighbours: op11 (fill-in-middle), op12 (nearest neighbours), op13 (ranked search)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.llm import fill_middle, hash_search, lexical
from panelspark.llm.catalog import query
from panelspark.llm.common import table

FIM_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n,
         CAST('0x' || substr(x, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(x, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(x, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(x, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substr(t, 1, lo) AS pre, substr(t, lo + 1, hi - lo) AS mid, substr(t, hi + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


@query("op11_fill_middle", FIM_SQL)
def op11(spark, sf_dir):
    """Fill-in-middle form of every document, cut by code points."""
    got = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"),
                      F.col("middle_units").alias("middle_chars"), F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


@query("op12_nearest")
def op12(spark, sf_dir):
    """The 20 nearest rows of every 20th vector, found through binary codes."""
    rows = hash_search.usable(table(spark, sf_dir, "embeddings"))
    return hash_search.nearest(rows.filter(F.col("vec_id") % 20 == 0), rows)


RANK_SQL = r"""
WITH tok AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms,
         row_number() OVER () AS r FROM documents),
d AS (SELECT r, doc_id, CAST(len(terms) AS BIGINT) AS n FROM tok WHERE len(terms) > 0),
s AS (SELECT count(*) AS nd, CAST(coalesce(sum(n), 0) AS BIGINT) AS l FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM tok) GROUP BY r, term),
it AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tf, s WHERE term IN (SELECT term FROM it) GROUP BY term, nd),
m AS (SELECT r, doc_id, 100 - 90 + ((90 * n * nd) // l) AS m FROM d, s),
sc AS (
  SELECT it.item_id, m.doc_id, m.r, CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * m.m))) AS BIGINT) AS score
  FROM it JOIN w USING (term) JOIN tf USING (term) JOIN m ON m.r = tf.r WHERE m.doc_id IS NOT NULL AND it.item_id IS NOT NULL
  GROUP BY it.item_id, m.doc_id, m.r),
k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rk FROM sc WHERE score > 0)
SELECT item_id, CAST(rk AS INTEGER) AS rank, doc_id, score FROM k WHERE rk <= 10
"""


@query("op13_ranked_search", RANK_SQL)
def op13(spark, sf_dir):
    """The ten best documents for every benchmark item."""
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
