"""A training corpus from raw documents: language ID, near-dedup, decontamination, mixing, token files.

Each stage takes what its predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lanternflow.llm import decontamination, language_id, mixing, simhash_dedup, token_files
from lanternflow.llm._shared import read_table, workspace


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or like no learned language, go."""
    return language_id.accepted(docs, language_id.fit(docs))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest doc_id.

    The stage keeps to the operator's own shingles (three words, two bits): fingerprints within two bits are texts
    far above a similarity of 0.8."""
    return simhash_dedup.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for; one drawn twice is two rows."""
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixed corpus; a row for each document in them."""
    import public_tokenizers

    manifest = token_files.write_token_files(docs, workspace(spark, "corpus", keep=True), public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_token_files(manifest)


STAGES = [("language_id", identify), ("simhash_dedup", deduplicate), ("decontamination", decontaminate), ("mixing", mix), ("token_files", tokenize)]

#: Fingerprints, profiles and token ids are not SQL; tests/llm holds the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = workspace(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
