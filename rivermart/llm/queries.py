"""One query per operator of this subpackage, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivermart.llm import (
    bitpack, common, conversations, fim, jaccard, langid, mixing, neighbours, packing, pii, quality, sketch, suffixes, tokens,
    tries)
from rivermart.sources.storage import work_folder
from rivermart.sources.tables import read_table


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    common.prepare(spark)
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def op1_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get(pii.KEY_SETTING, pii.DEFAULT_KEY)
    return pii.replace_entities(_table(spark, sf_dir, "documents"), key)


def op3_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(_table(spark, sf_dir, "embeddings"))


def op4_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprints(_table(spark, sf_dir, "documents"))


def op5_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_rates(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents"))


def op7_bit_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitpack.encode_and_read(
        _table(spark, sf_dir, "documents"), work_folder(spark, "ids"),
        tokens.vocabulary("word_bpe_49k.json"), end_id=2)


def op8_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_sets(_table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"), tokens.vocabulary("piece_bpe_32k.model"))


def op10_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        _table(spark, sf_dir, "documents"), tokens.vocabulary("byte_bpe_50k.json"), end_id=1)


def op11_trie_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.owners(_table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fim.restore(fim.rearrange(_table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


def op13_repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.damage_and_repair(_table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_site_quality, op2_surrogates, op3_nn_descent, op4_scaled_sketch, op5_soft_mixing,
             op6_suffix_dedup, op7_bit_packed_ids, op8_jaccard_components, op9_language, op10_mixture_packing,
             op11_trie_owners, op12_fill_in_middle, op13_repaired_conversations)
    return {query.__name__: query for query in every}


OP11_SQL = r"""
WITH stripped AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS k FROM documents),
ranked AS (
  SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY k) AS group_size
  FROM stripped WINDOW w AS (PARTITION BY k ORDER BY length(t) DESC, doc_id))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(k) AS text_sha256 FROM ranked"""

OP12_SQL = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tokens,
         sha256('1:' || doc_id) AS h FROM documents),
numbers AS (
  SELECT doc_id, t, tokens, len(tokens) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3,
         CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM drawn),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
pieces AS (
  SELECT *, coalesce(array_to_string(tokens[1:a], ''), '') AS prefix, coalesce(array_to_string(tokens[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(tokens[b + 1:n], ''), '') AS suffix FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM pieces"""


def oracle_sql() -> dict[str, str]:
    return {"op11_trie_owners": OP11_SQL, "op12_fill_in_middle": OP12_SQL}
