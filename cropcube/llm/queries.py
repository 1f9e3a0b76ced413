"""The registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropcube.llm import (anchors, bpe_codec, decontam, divergence, licenses, lloyd, packing, quality, rpforest, simhash, suffixes,
                          token_counts, topk)
from cropcube.llm.common import table
from cropcube.llm.registry import query
from cropcube.llm.vectors import usable


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(CASE WHEN len(q.v) = 0 THEN 0 ELSE list_inner_product(q.v, c.v) END AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5"""

SUBSTRING_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL),
places AS (SELECT doc_id, w, unnest(range(len(w) - 19)) AS p FROM d WHERE len(w) >= 20),
windows AS (SELECT doc_id, p, array_to_string(w[p + 1:p + 20], ' ') AS k FROM places),
late AS (
  SELECT doc_id, p FROM windows QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, p) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS i FROM late),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i)
         GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


LINKS_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (SELECT DISTINCT vec_id, vec_id AS other FROM embeddings WHERE vec_id IS NOT NULL
          UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.other),
low AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(DISTINCT b) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, low.component_id, e.vec_id = low.component_id AS kept
FROM embeddings e JOIN low USING (vec_id) LEFT JOIN n USING (vec_id)"""

BYTES_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, encode(coalesce(text, '')) AS b FROM documents WHERE doc_id IS NOT NULL),
places AS (SELECT row, unnest(range(octet_length(b) - 399)) AS p, b FROM d WHERE octet_length(b) >= 400),
strings AS (SELECT row, p, md5(b[p + 1:p + 400]) AS h FROM places),
again AS (SELECT row, p FROM strings QUALIFY count(*) OVER (PARTITION BY h) > 1),
steps AS (SELECT row, p, coalesce(p > lag(p) OVER (PARTITION BY row ORDER BY p) + 400, true) AS new FROM again),
runs AS (SELECT row, p, sum(CAST(new AS INTEGER)) OVER (PARTITION BY row ORDER BY p) AS g FROM steps),
spans AS (SELECT row, min(p) AS s, max(p) + 400 AS e FROM runs GROUP BY row, g),
rest AS (
  SELECT row, lag(e, 1, 0) OVER (PARTITION BY row ORDER BY s) AS a, s AS z FROM spans
  UNION ALL SELECT row, max(e), any_value(octet_length(b)) FROM spans JOIN d USING (row) GROUP BY row),
kept AS (SELECT row, unhex(string_agg(hex(b[a + 1:z]), '' ORDER BY a)) AS b FROM rest JOIN d USING (row) WHERE z > a GROUP BY row),
lost AS (SELECT row, sum(e - s) AS n, count(*) AS spans FROM spans GROUP BY row)
SELECT doc_id, CAST(octet_length(d.b) AS BIGINT) AS n_bytes, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(lost.spans, 0) AS BIGINT) AS n_spans,
       sha256(CASE WHEN lost.n IS NULL THEN d.b ELSE coalesce(kept.b, ''::BLOB) END) AS kept_sha256
FROM d LEFT JOIN lost USING (row) LEFT JOIN kept USING (row)"""


@query("op1_exact_top_k", TOP_K_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(F.col("vec_id").isNotNull() & usable("embedding"))
    whole = rows.select("vec_id", F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("double"))
                        .alias("v"))
    return topk.top_k(whole, whole.where(F.col("vec_id") % 50 == 0), k=5)


@query("op2_embedding_near_dedup", LINKS_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rpforest.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)
    return found.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))


@query("op7_bpe_encode_decode")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe_codec.encode(table(spark, sf_dir, "documents"), decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs)


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query("op3_simhash_near_dedup", simhash.oracle())
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.scores(docs, model).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@query("op9_substring_dedup", SUBSTRING_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anchors.dedup(table(spark, sf_dir, "documents"), window=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op5_suffix_array_dedup", BYTES_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.dedup(table(spark, sf_dir, "documents"), length=400)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_license_scan", licenses.oracle())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op11_vector_code_compression", lloyd.oracle())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lloyd.compress(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256)
    code = F.concat_ws("", F.transform("code", lambda x: F.lower(F.lpad(F.hex(x), 2, "0"))))
    return found.rows.select("vec_id", code.alias("code"), "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256"))


@query("op12_benchmark_decontamination", decontam.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))


@query("op13_source_divergence_audit", divergence.oracle())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=30, smoothing=5, top=50)
