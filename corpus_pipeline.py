"""Documents to packed sequences: one stage after another over stored tables.

Toxic documents go, one document of each group of near-duplicates stays,
personal data is masked, sources are mixed to their weights (a document that is
taken twice is two rows from there on), and the texts are packed. A stage's tables
and its input are deleted when its result is stored, so the shared folder holds
two stages at most, and in the end the result alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import mixing, packing, pii, simhash_vp, toxicity
from millrace.llm.common import scratch
from millrace.session import fresh_path, remove_path
from millrace.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents not predicted toxic; null and empty texts are scored like others."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies."""
    return simhash_vp.without_near_duplicates(docs, shingle=4, radius=4)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same rows, spans of personal data replaced by their kind; a null text stays null."""
    return pii.without_personal_data(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, none to two times."""
    return mixing.mixed_documents(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document; a null text has its end id alone."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("personal data", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_documents),
]
# Fingerprints, votes of neighbours and sampling have no SQL form; the tests
# compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that the stages keep.

    Null ids, null texts, repeated rows, columns of any name and an empty table
    pass through as the stages say.
    """
    docs, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        before, path = path, fresh_path(spark, f"pipeline-{name.replace(' ', '-')}")
        with scratch(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before:
            remove_path(spark, before)
    return docs
