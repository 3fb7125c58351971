"""The corpus pipeline: quality rules, near-duplicates, personal data, mixing, packing, one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagelake.llm import mixing, packing, pii, quality, simhash
from pagelake.llm.common import save

#: Words in a shingle, differing bits at most, and similarity from which texts are near-duplicates in the pipeline.
SHINGLE, RADIUS, SIMILARITY = 5, 2, 0.8


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, null and empty texts among them; the others keep all columns."""
    return quality.keep(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest doc_id; null doc_ids come last.

    Null, empty and blank texts are one group. Ties and repeated rows are broken by a hash of the whole row.
    """
    return simhash.one_of_each(docs, SHINGLE, RADIUS, SIMILARITY)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts give way to their kinds; null texts stay null, and no document is added or lost."""
    return pii.mask(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated, twice at most, until sources have their target weights; a null source is one, too."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, each with its place in a sequence; a null or empty text is one piece of one token."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_quality),
    ("near-duplicates", drop_near_duplicates),
    ("personal data", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Fingerprints, compression and the span model are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's result is written and read again before the next. Empty tables stay empty."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = save(docs, f"stage-{name.replace(' ', '-')}")
    return docs
