"""The queries of the training-data operators and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm import chat_collapse, decontam, packing, pii_crf, quality_bands, quality_gbdt, secret_battery, simhash, toxicity_pu, url_rules
from lexspark.llm.common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _sha256(c: Column | str) -> Column:
    return F.sha2(c, 256)


def op1_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.url_verdicts(table(spark, sf_dir, "pages")).drop("candidates")


def op3_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_bands.quality_rules(table(spark, sf_dir, "documents"))


def op4_prefix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", _sha256(F.concat_ws(",", "items")).alias("items_sha256"), "contaminated")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_crf.find_personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", _sha256("base").alias("base_sha256"), "spans", "n_added")


def op6_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gbdt.quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_toxicity_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_pu.toxicity_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_secret_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_battery.find_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", _sha256("base").alias("base_sha256"), "spans", "n_random")


def op9_chat_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_collapse.chat_format(table(spark, sf_dir, "conversations"))


def op10_simhash_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


#: Windows of items against windows of documents, each pair by equality of their words.
OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), CAST([] AS VARCHAR[])) AS w
  FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), CAST([] AS VARCHAR[])) AS w
  FROM benchmark
), bp AS (
  SELECT item, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0
), bw AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS win FROM bp
), ks AS (SELECT DISTINCT k FROM bw),
dp AS (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k
), hit AS (
  SELECT dp.doc_id, dp.i, dp.k, bw.item FROM dp JOIN bw ON bw.k = dp.k AND bw.win = array_to_string(dp.w[dp.i:dp.i + dp.k - 1], ' ')
), hw AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id
), hi AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(hw.n_hit, 0) AS n_hit, coalesce(hi.n_items, 0) AS n_items,
  sha256(coalesce(hi.items, '')) AS items_sha256, coalesce(hw.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pattern_packing,
        op2_url_rules,
        op3_compression_bands,
        op4_prefix_decontamination,
        op5_personal_data,
        op6_quality_trees,
        op7_toxicity_pu,
        op8_secret_battery,
        op9_chat_collapse,
        op10_simhash_positions,
    )
}
ORACLES: dict[str, str] = {"op2_url_rules": url_rules.oracle(), "op4_prefix_decontamination": OP4_SQL, "op9_chat_collapse": chat_collapse.ORACLE}
