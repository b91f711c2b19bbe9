"""The pipeline over documents: toxicity, quality, near-duplicates, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir), docs being what the stage before it kept, and is written as Parquet in the shared
folder and read again, so a lost executor never costs more than a stage. All stages but the last keep the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from catchlake.llm import byte_bpe, minhash, quality, toxicity, winnowing
from catchlake.llm.common import table
from catchlake.llm.queries import quality_model, toxicity_model
from catchlake.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold of their language."""
    return toxicity.drop_toxic(docs, toxicity_model(spark, sf_dir))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.3 or more."""
    return quality.drop_poor(docs, quality_model(spark, sf_dir), 0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of five-word shingles with a similarity of 0.8 or more hold together."""
    return minhash.drop_near_duplicates(docs, minhash.MinHashSettings(words=5, percent=80))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten words of the benchmark in a row, and no whole item of fewer words."""
    return winnowing.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, packed, with their count and the digests of ids and decoded text.

    Workers that also serve the other stages keep fewer pieces and states.
    """
    return byte_bpe.encode_and_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ids="token_ids",
                                      pieces=50_000, states=40_000)


STAGES = [("toxicity", drop_toxic), ("quality", drop_poor), ("near_duplicates", drop_near_duplicates),
          ("decontamination", drop_contaminated), ("byte_bpe", encode)]

#: Trained models and similarity groups have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
