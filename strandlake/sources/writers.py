"""Writers of the catalogue's file formats. A target is never one that is being read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.functions.sequence import wrapped
from strandlake.functions.text import gene_symbol, product_name


def tsv(df: DataFrame, path: str) -> None:
    df.write.csv(path, sep="\t", header=True, quote="", emptyValue="", nullValue="")


def fasta_text(header: Column, sequence: Column, width: int | None = None) -> Column:
    return F.concat(F.lit(">"), header, F.lit("\n"), wrapped(sequence, width) if width else sequence)


def fasta(df: DataFrame, path: str, width: int | None = None) -> None:
    df.select(fasta_text(F.col("header"), F.col("sequence"), width).alias("value")).write.text(path)


def fasta_by(df: DataFrame, path: str, *by: str, width: int | None = None) -> None:
    """One folder for each value of by. Rows are dealt out by them and a hash of the header, so a large group has many files."""
    out = df.select(*by, fasta_text(F.col("header"), F.col("sequence"), width).alias("value"))
    out.write.partitionBy(*by).text(path)


def software_table(spark: SparkSession) -> DataFrame:
    """(Software, Version) of the engine's own components."""
    import platform

    import pyarrow

    rows = [("spark", spark.version), ("python", platform.python_version()), ("pyarrow", pyarrow.__version__)]
    return spark.createDataFrame(rows, "Software string, Version string")


def submission_features(coordinates: DataFrame) -> DataFrame:
    """Feature-table lines, a header line first, for (id, start_mark, end_mark, product); one row of text for each id."""
    entry = F.concat(F.col("start_mark"), F.lit("\t"), F.col("end_mark"), F.lit("\tCDS\n\t\t\tproduct\t"), product_name(F.col("product")), F.lit("\n\t\t\tgene\t"), gene_symbol(F.col("product")))
    lines = coordinates.select("id", F.struct("start", entry.alias("text")).alias("x")).groupBy("id").agg(F.sort_array(F.collect_set("x")).alias("x"))
    return lines.select("id", F.concat(F.lit(">Feature "), F.col("id"), F.lit("\n"), F.array_join(F.transform("x", lambda e: e["text"]), "\n")).alias("value"))
