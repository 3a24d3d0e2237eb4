"""A training corpus from the documents: each stage is written and read again by the next one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from minewright.llm import exact_dedup, jaccard, mixing, packing, toxicity
from minewright.llm.batches import bounded_batches
from minewright.session import cut

#: The vocabulary that the last stage packs with.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, fitted on the labelled documents of ``sf_dir``, rejects go."""
    bounded_batches(spark)
    folder = sf_dir.rstrip("/")
    model = toxicity.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    return toxicity.clean(docs, model)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the document with the largest id stays."""
    bounded_batches(spark)
    return exact_dedup.without_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 or more, that with the smallest id stays."""
    bounded_batches(spark)
    return jaccard.one_of_each(docs, n=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.mixture(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences, with their token ids."""
    bounded_batches(spark)
    return packing.pack(docs, RANKS)


STAGES = [("toxicity", toxicity_stage), ("exact dedup", exact_stage), ("n-gram Jaccard join", near_stage),
          ("mixing sources to target weights", mixing_stage), ("packing", packing_stage)]

#: Fitted models and token ids are beyond SQL; the stages are held against plain Python in tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
