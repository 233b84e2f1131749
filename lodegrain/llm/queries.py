"""The queries of this subpackage and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegrain.llm import audio, common, decontamination, language_id, license_scan, near_duplicates, packing, quality, secret_scan, token_counts, token_files


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def in_fold(fold: int, folds: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == fold


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    fold = F.coalesce(in_fold(2, 4), F.lit(False))
    model = language_id.learn(docs.select("doc_id", "text", "lang").filter(~fold))
    return language_id.predict(docs, model, held_out=fold)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(common.table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.describe(common.table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(common.table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no path of their own: source, language and a thousand ids make a directory each."""
    part = lambda c: F.coalesce(c.cast("string"), F.lit("_"))
    path = F.concat_ws("/", part(F.col("source")), part(F.col("lang")), part(F.floor(F.col("doc_id") / 1000)), part(F.col("doc_id")))
    return license_scan.licenses(common.table(spark, sf_dir, "documents"), path)


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.cluster(common.table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(common.table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    fold = F.coalesce(in_fold(0, 5), F.lit(False))
    model = quality.learn(docs, labels.filter(~fold))
    return quality.score(docs, model, held_out=fold)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_language_id, op2_token_counts, op3_decontamination, op4_packing, op5_media_columns, op6_secret_scan, op7_license_scan, op8_near_duplicates, op9_token_files, op10_quality)
}

ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM documents
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM benchmark
), bw AS (
  SELECT item_id, n, w[i:i + n - 1] AS win
  FROM (SELECT item_id, w, least(len(w), 13) AS n, unnest(generate_series(1, len(w) - least(len(w), 13) + 1)) AS i FROM b WHERE len(w) > 0)
), ns AS (SELECT DISTINCT n FROM bw
), dw AS (
  SELECT doc_id, n, i, w[i:i + n - 1] AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, ns WHERE len(w) >= n)
), hit AS (SELECT dw.doc_id, dw.n, dw.i, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win
), cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM hit)) GROUP BY doc_id
), items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN cover ON d.doc_id = cover.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
""",
    "op8_near_duplicates": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, hash(w[i:i + 4]) AS sh FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2
), e AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * n_both >= 85 * (na.n + nb.n - n_both)
), r(doc_id, reach) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.reach = e.a
), c AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
""",
}
