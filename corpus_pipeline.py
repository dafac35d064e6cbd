"""A corpus pipeline in five stages, each by one operator of ``genespark.llm``.

Every stage gets all documents that its predecessor kept, written as Parquet and
read again, and its decisions take effect: quality rules and toxicity reject
documents, near-duplicates keep one document of each class, contaminated
documents go, and what is left is packed into sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from genespark.llm import dartminhash, decontam, packing, quality, storage, toxicity

END_ID = 1


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects; a null or empty text is rejected."""
    return quality.keep(docs)


def no_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain doesn't call toxic; without a label none goes."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")  # labelled rejects teach as well
    return toxicity.keep(docs, toxicity.train_on(source, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class, that with the smallest id."""
    return dartminhash.keep(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; an empty benchmark rejects none."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences; every document gives one at least."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID)


STAGES = [("quality_rules", quality_rules), ("toxicity", no_toxicity), ("near_duplicates", near_duplicates), ("benchmark_decontamination", benchmark_decontamination), ("packing", pack_sequences)]

#: SQL can't express the toxicity model, the signatures or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; the scratch tables of a stage go when its result is written, a result when the next one is."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    since = len(storage.made)
    for name, stage in STAGES:
        found = stage(spark, docs, sf_dir)
        uri = storage.scratch(spark, f"pipeline-{name}")
        docs = storage.stage(found, name, uri)
        storage.tidy(spark, since, uri)
    return docs
