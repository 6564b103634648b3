"""A corpus from raw documents: toxicity, exact copies, near copies, benchmark leaks, source mix.

Each stage takes what its predecessor kept and is written before the next one reads it. All but
the last return the columns of ``documents``; the last adds the tokens and the probability a
document was sampled with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creascope.llm import decontaminate, exact_dedup, minhash_dedup, mixing, toxicity
from creascope.llm.common import stored


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five words and a similarity of 0.8; one document of each group stays."""
    return minhash_dedup.drop_near_duplicates(docs, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample_mix(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("source_mix", mix_sources),
]

# A trained model and an approximate candidate search stand between the input and the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
