"""From raw documents to training sequences: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivermart.llm import common, jaccard, langid, mixing, packing, pii, tokens
from rivermart.sources.tables import read_table

#: Stages learn, cluster and solve by iteration, which SQL cannot express.
ORACLE_SQL = None
#: No document comes more often than this: copies beyond it would undo the near-duplicate stage.
MOST_RATE = 4.0


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: rows without letters or without a likely language go."""
    return langid.keep_identified(docs, tokens.vocabulary("piece_bpe_32k.model"))


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of documents that links connect, the one of the smallest doc_id stays."""
    return jaccard.keep_one(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: surrogates for personal data and secrets; n_chars follows the text."""
    key = spark.conf.get(pii.KEY_SETTING, pii.DEFAULT_KEY)
    return pii.replace_entities(docs, key).select(docs.columns)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: tokens meet the target weights by fewer low and toxic documents and, where that
    is not enough, copies, ``MOST_RATE`` of a document at most, or come as near as these can bring
    them; no document whose likeliest domain is high is lost."""
    labels = read_table(spark, f"{sf_dir}/labels.parquet")
    return mixing.draw(docs, mixing.mixing_rates(docs, labels, keep="high", most=MOST_RATE), snap=0.0)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: pieces of training sequences."""
    return packing.pack_documents(docs, tokens.vocabulary("byte_bpe_50k.json"), end_id=1)


STAGES = [
    ("language ID", identify_language), ("n-gram Jaccard join", join_near_duplicates), ("PII", replace_personal_data),
    ("mixing sources to target weights", mix_domains), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    common.prepare(spark)
    docs = read_table(spark, f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = common.stored(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs
