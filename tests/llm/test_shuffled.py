"""Operators that read their input more than once give the same result on inputs that are shuffled anew each time."""

import pytest
from pyspark.sql import functions as F

from strandlake.llm import context_tree, decontaminate, exact_dedup, simhash
from strandlake.llm.common import is_scan, materialize, numbered

WAYS = {
    "orderBy": lambda d: d.orderBy(F.xxhash64("doc_id", "copy")), "repartition": lambda d: d.repartition("doc_id"), "distinct": lambda d: d.distinct(), "limit": lambda d: d.limit(100_000),
    "sample": lambda d: d.repartition(5, "text").sample(fraction=0.999999, seed=3), "filter": lambda d: d.filter("n_chars >= 0"),
}


@pytest.fixture(scope="module")
def wide(spark):
    """The small documents thrice, with a column that is much wider than the others."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    docs = docs.withColumn("doc_id", F.col("doc_id") + 1000 * F.col("copy")).withColumn("wide", F.sha2(F.concat("text", F.col("copy").cast("string")), 512))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    yield materialize(docs.withColumn("wide", F.repeat("wide", 20)), "wide")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)


def test_only_bare_scans_count_as_written(spark, wide):
    assert is_scan(wide)
    assert not any(is_scan(way(wide)) for way in WAYS.values())
    assert not is_scan(spark.range(3))


@pytest.mark.parametrize("way", WAYS)
def test_numbers_stay(wide, way):
    rows, row = numbered(WAYS[way](wide))
    narrow = {r[0]: r[1] for r in rows.select(row, "doc_id").collect()}
    assert len(narrow) == rows.count()
    assert {r[0]: r[1] for r in rows.select(row, "doc_id", "text", "wide").collect()} == narrow


@pytest.mark.parametrize("way", ["orderBy", "repartition", "distinct", "limit", "sample"])
def test_documents_are_not_lost(spark, wide, way):
    docs = WAYS[way](wide)
    whole = materialize(docs, "whole")
    ids = lambda d: sorted(r[0] for r in d.select("doc_id").collect())
    assert ids(exact_dedup.deduplicate(docs)) == ids(exact_dedup.deduplicate(whole))
    if way not in ("orderBy", "limit"):
        return
    assert ids(simhash.near_deduplicate(docs)) == ids(simhash.near_deduplicate(whole))
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    assert ids(decontaminate.decontaminate(docs, items)) == ids(decontaminate.decontaminate(whole, items))


def test_scores_stay(wide):
    held_out = F.col("doc_id") % 5 == 0
    scores = lambda d: {r["doc_id"]: (r["n_tokens"], round(r["score"], 6)) for r in context_tree.score_documents(d, held_out).collect()}
    assert scores(WAYS["orderBy"](wide)) == scores(wide)
