"""A training corpus from raw documents: toxic documents and near-copies go,
then documents that hold benchmark items; personal data is masked; sources
are mixed to their target weights.

Every stage takes all that the one before kept, written as Parquet and read
again.  All stages but the last return the columns of ``documents``; the last
adds those of the mixing plan and ``copy_no``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plait.llm import pii, toxicity
from plait.llm.decontaminate import decontaminate as without_benchmark
from plait.llm.mixing import mix
from plait.llm.queries import TOXIC_CHAIN, toxic_labels
from plait.llm.simhash import drop_near_duplicates
from plait.session import scratch_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    chain = toxicity.fit(docs, toxic_labels(read(spark, sf_dir, "labels")), TOXIC_CHAIN)
    return toxicity.drop_flagged(docs, chain, "toxic")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, shingle=3, bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_benchmark(docs, read(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs, pii.fit(docs)).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_copies),
    ("decontamination", decontaminate),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
]

#: The stages are fitted models, components and hashes of spans: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "corpus", name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
