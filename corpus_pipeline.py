"""The corpus pipeline: language ID, exact dedup, SimHash near-dedup, benchmark decontamination and best-fit packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandlake.llm import decontaminate, exact_dedup, language_id, pack, simhash
from strandlake.llm.common import discard, materialize, table

#: Documents whose best language holds less than this share of their letters are rejected.
LEAST_SHARE = 0.4


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; lang becomes the predicted one. The model is fitted on the documents' own labels."""
    return language_id.keep_identified(docs, language_id.fit(docs), LEAST_SHARE)


def exactly_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def nearly_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.near_deduplicate(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return pack.pack_documents(docs, path("byte_bpe_50k.json"))


STAGES = [
    ("language ID", identified),
    ("exact dedup", exactly_deduplicated),
    ("SimHash near-dedup", nearly_deduplicated),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]

#: The stages can't be expressed in SQL; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each keeps is written and read again, and deleted when the next stage has been written."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
