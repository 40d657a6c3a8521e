"""Consistency of lists and tables: reference lists, expected against observed ids, counts and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.functions.blanks import blank_in_report
from strandlake.operators.shared import dealt

# Kinds of entries of a reference list.
KINDS = ["master", "reference", "exclusion_list"]


def check_reference_list(references: DataFrame, segmented: bool = False) -> None:
    """Fail on unknown kinds and, with segments, on a segment of other than exclusion entries without a master."""
    if bad := references.filter(~F.col("kind").isin(KINDS)).select("kind").distinct().limit(5).collect():
        raise ValueError(f"unknown kinds in the reference list: {sorted(r['kind'] for r in bad)}")
    if segmented:
        if references.filter("segment IS NULL").limit(1).count():
            raise ValueError("a segmented reference list needs three columns")
        lacking = references.groupBy("segment").agg(F.bool_or(F.col("kind") == "master").alias("m"), F.bool_and(F.col("kind") == "exclusion_list").alias("x")).filter("NOT m AND NOT x")
        if bad := lacking.limit(5).collect():
            raise ValueError(f"segments without a master: {sorted(str(r['segment']) for r in bad)}")


def reconcile(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """(id, state) of ids that are 'missing' or 'extra'; both inputs have a column id, of which blank ones don't count."""
    a, b = (d.filter(~blank_in_report(F.col("id"))).select(F.trim("id").alias("id")).distinct() for d in (expected, observed))
    both = a.withColumn("_a", F.lit(True)).join(b.withColumn("_b", F.lit(True)), "id", "full_outer")
    return both.select("id", F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "extra").alias("state")).filter("state IS NOT NULL")


def require_references(records: DataFrame, references: DataFrame) -> None:
    """Fail if records (accession) lack a listed one; exclusion entries may be absent."""
    absent = references.filter("kind != 'exclusion_list'").select("accession").join(records.select("accession"), "accession", "left_anti")
    if bad := absent.limit(5).collect():
        raise ValueError(f"references without a record: {sorted(r['accession'] for r in bad)}")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.trim(column).alias(column)).filter(f"`{column}` != ''").distinct()


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = row if out is None else out.union(row)
    return out


def run_counters(before: DataFrame, after: DataFrame, key: str, column: str) -> DataFrame:
    """(rows, changed, filled, mapped_unknown) between two states of a column."""
    both = after.select(key, F.col(column).alias("_n")).join(before.select(key, F.col(column).alias("_o")), key)
    was, now = F.coalesce("_o", F.lit("")), F.coalesce("_n", F.lit(""))
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(was != now).alias("changed"), F.count_if((was == "") & (now != "")).alias("filled"), F.count_if(now == "unknown").alias("mapped_unknown"))


def filtering_summary(filtered: DataFrame, examples: int = 20) -> DataFrame:
    """(kind, n, examples): sequences that failed and those that can't be projected, with the first names of each as examples."""
    kind = F.when(F.trim(F.coalesce("error", F.lit(""))) != "", "failed").otherwise("unprojectable")
    rows = filtered.select(kind.alias("kind"), "seq_name")
    counts = rows.groupBy("kind").agg(F.count_distinct("seq_name").alias("n"))
    from pyspark.sql import Window

    first = rows.distinct().withColumn("_r", F.row_number().over(Window.partitionBy("kind").orderBy("seq_name"))).filter(F.col("_r") <= examples)
    return counts.join(first.groupBy("kind").agg(F.array_sort(F.collect_list("seq_name")).alias("examples")), "kind")


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one of two sets has, with only_in ('a' or 'b'). Equal rows of both meet once, in one of as many tasks as the rows ask for."""
    columns = a.columns
    both = dealt(a.withColumn("only_in", F.lit("a")).union(b.withColumn("only_in", F.lit("b"))), *columns)
    first, last = F.min("only_in").alias("only_in"), F.max("only_in").alias("_last")
    return both.groupBy(*columns).agg(first, last).filter("only_in = _last").drop("_last")


def union_by_priority(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """All rows of first, and those of second whose key first lacks."""
    return first.unionByName(second.join(first.select(key).distinct(), key, "left_anti").select(*first.columns))
