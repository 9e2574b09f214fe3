"""The operators of this package over the shared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    ann_vp,
    divergence,
    fingerprints,
    main_text,
    middles,
    mixing,
    orc_ids,
    packing,
    pii,
    quotes,
    simhash_vp,
    toxicity,
    viterbi,
)
from millrace.session import fresh_path
from millrace.sources.tables import table


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(table(spark, folder, "documents"))


def op3_quotes(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.linked(table(spark, folder, "conversations"))


def op4_orc_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "ids-orc")
    orc_ids.write_ids(table(spark, folder, "documents"), path)
    return orc_ids.read_ids(spark, path, checksum=True)


def op5_simhash_vp(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_vp.near_duplicates(table(spark, folder, "documents"), shingle=4, radius=4)
    return found.select("doc_id", simhash_vp.hex_print("fp").alias("fingerprint"), "component_id")


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_ann_vp(spark: SparkSession, folder: str) -> DataFrame:
    asks = F.col("vec_id") % 50 == 0
    return ann_vp.nearest(table(spark, folder, "embeddings"), asks, k=5, factor=1.0)


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.document_fingerprints(table(spark, folder, "documents"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return viterbi.token_counts(table(spark, folder, "documents"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(table(spark, folder, "documents"))


def op11_middles(spark: SparkSession, folder: str) -> DataFrame:
    return middles.digests(table(spark, folder, "documents"))


def op12_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.main_text(table(spark, folder, "pages"))


def op13_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(table(spark, folder, "documents"), least_docs=10, top=10)


MIDDLES = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents
), numbers AS (
  SELECT *, CAST('0x' || substr(digest, 1, 8) AS BIGINT) % (n + 1) AS a,
         CAST('0x' || substr(digest, 9, 8) AS BIGINT) % (n + 1) AS b,
         CAST('0x' || substr(digest, 17, 8) AS BIGINT) % 100 AS plain_draw,
         CAST('0x' || substr(digest, 25, 8) AS BIGINT) % 100 AS order_draw
  FROM drawn
), formed AS (
  SELECT doc_id, text, n, least(a, b) AS first, greatest(a, b) AS second,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                   OR contains(text, '<M>') OR plain_draw >= 90 THEN 'plain'
              WHEN order_draw < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), parts AS (
  SELECT *, substr(text, 1, first) AS prefix, substr(text, first + 1, second - first) AS middle,
         substr(text, second + 1) AS suffix
  FROM formed
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN first END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN second - first END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

# A row for every term and pair of sources, where the operator counts bits.
DIVERGENCE = r"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM docs) GROUP BY ALL
), kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM docs)
  GROUP BY ALL HAVING count(*) >= 10
), languages AS (SELECT DISTINCT lang FROM docs),
sizes AS (SELECT lang, count(term) AS v FROM languages LEFT JOIN kept USING (lang) GROUP BY lang),
cells AS (
  SELECT lang, source, term, coalesce(n, 0) AS n
  FROM (SELECT DISTINCT lang, source FROM docs) JOIN kept USING (lang)
  LEFT JOIN counts USING (lang, source, term)
), shares AS (
  SELECT lang, source, term, n, v,
         1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p
  FROM cells JOIN sizes USING (lang)
), overall AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM cells GROUP BY ALL) JOIN sizes USING (lang)
), groups AS (SELECT DISTINCT lang, source FROM docs),
gaps AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN gaps ON gaps.lang = a.lang AND gaps.source = a.source AND gaps.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q)
  FROM shares JOIN overall USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
WHERE part = 'pair' OR rank <= 10
"""

QUERIES = {
    "op1_packing": (op1_packing, None),
    "op2_pii": (op2_pii, None),
    "op3_quotes": (op3_quotes, None),
    "op4_orc_ids": (op4_orc_ids, None),
    "op5_simhash_vp": (op5_simhash_vp, None),
    "op6_toxicity": (op6_toxicity, None),
    "op7_ann_vp": (op7_ann_vp, None),
    "op8_fingerprints": (op8_fingerprints, None),
    "op9_token_counts": (op9_token_counts, None),
    "op10_mixing": (op10_mixing, None),
    "op11_middles": (op11_middles, MIDDLES),
    "op12_main_text": (op12_main_text, None),
    "op13_divergence": (op13_divergence, DIVERGENCE),
}
