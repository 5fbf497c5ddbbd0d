"""The corpus pipeline: quality rules, near-dedup, benchmark decontamination, PII redaction, packing.

Each stage works on all that the one before kept. run() writes each stage's result to the shared folder and reads it again.

Defined results, the same in every stage: a null text is an empty one; whole texts count, however long; null doc_ids keep their
rows and pass like others; all columns pass through up to the last stage, whatever their names; an empty table gives an
empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm.common import save
from marketlake.llm.decontam import without_leaks
from marketlake.llm.minhash import one_of_each
from marketlake.llm.packing import packed
from marketlake.llm.pii import redact
from marketlake.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null and empty texts go; repeated rows are judged alike."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one with the least doc_id; of rows tied for it one stays."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks. Null and empty texts and items never do; a similarity of exactly 0.8 does."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced in their text; n_chars is still that of the text as it came, and null stays null."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's batch. Null and empty texts have length 0; ties in length go by a hash of the text."""
    return packed(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination), ("pii", pii), ("packing", packing)]

#: Rolling hashes, sampling and SimHash windows have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{k}-{name}")
    return docs
