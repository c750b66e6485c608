"""A training corpus from raw documents: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the
columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from terravane import staging
from terravane.llm import decontaminate, mixing, near_copies, token_files, toxicity

TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under the threshold."""
    return toxicity.without_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies.

    SimHash fingerprints (op6's trie self-join), Jaccard 0.8 checked; bands of minima for the
    pairs that the fingerprints miss.
    """
    return near_copies.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"), action="documents")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights, in one row per document that the mix takes."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixed texts, and what each document has in them."""
    path = staging.fresh_path(spark, "tokens")
    token_files.write_token_files(docs, path, public_tokenizers.path(TOKENIZER))
    return token_files.read_token_digests(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_ids", write_tokens),
]

#: Neither the trained model nor the fingerprints nor the tokenizer can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = staging.fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
