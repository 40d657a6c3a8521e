"""Nested XML sequence records, flattened to one row each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.functions.dates import split_dates
from strandlake.functions.sequence import base_counts
from strandlake.functions.text import country_part, locality_part
from strandlake.operators.quality import excluded_records, unverified
from strandlake.operators.ranking import keep_one
from strandlake.operators.shared import written

# The record's scalar elements and the columns that they become.
SCALARS = {
    "locus": "GBSeq_locus", "length": "GBSeq_length", "strandedness": "GBSeq_strandedness", "molecule_type": "GBSeq_moltype",
    "topology": "GBSeq_topology", "division": "GBSeq_division", "update_date": "GBSeq_update-date", "create_date": "GBSeq_create-date",
    "definition": "GBSeq_definition", "primary_accession": "GBSeq_primary-accession", "accession_version": "GBSeq_accession-version",
    "source": "GBSeq_source", "organism": "GBSeq_organism", "taxonomy": "GBSeq_taxonomy", "record_comment": "GBSeq_comment", "sequence": "GBSeq_sequence",
}
# Qualifiers of the source feature that become columns.
QUALIFIERS = ["mol_type", "strain", "isolate", "isolation_source", "db_xref", "country", "geo_loc_name", "host", "collection_date", "segment", "serotype"]
# The columns of the flat table, in order.
COLUMNS = (
    "locus length data_source strandedness molecule_type topology division update_date create_date definition primary_accession accession_version gi_number "
    "source organism taxonomy accession_type exclusion_criteria exclusion_status pubmed_id mol_type strain isolate isolation_source db_xref country geo_loc host "
    "collection_date collection_day collection_mon collection_year segment serotype sequence genes cds_info a t g c n real_length comment reference_number position "
    "authors title journal"
).split()

# A single child must be read as an array too, so the schema is stated.
SCHEMA = ", ".join(f"`{tag}` string" for tag in SCALARS.values()) + """,
`GBSeq_keywords` struct<GBKeyword: array<string>>,
`GBSeq_feature-table` struct<GBFeature: array<struct<GBFeature_key: string, GBFeature_location: string,
  GBFeature_quals: struct<GBQualifier: array<struct<GBQualifier_name: string, GBQualifier_value: string>>>>>>,
`GBSeq_references` struct<GBReference: array<struct<GBReference_reference: string, GBReference_position: string,
  GBReference_authors: struct<GBAuthor: array<string>>, GBReference_title: string, GBReference_journal: string, GBReference_pubmed: string>>>"""


def record_files(spark: SparkSession, path: str, malformed: str = "FAILFAST") -> DataFrame:
    """Nested records of one file or of all XML files in a folder (any case of the suffix). Malformed ones fail, or drop out with DROPMALFORMED."""
    reader = spark.read.format("xml").option("rowTag", "GBSeq").option("mode", malformed).schema(SCHEMA)
    return reader.load(path) if path.lower().endswith(".xml") else reader.option("pathGlobFilter", "*.[xX][mM][lL]").load(path)


def whole_files(spark: SparkSession, path: str, root: str = "GBSet") -> tuple[DataFrame, DataFrame]:
    """(records, skipped) of a file or folder: files with a malformed record, or whose root element isn't closed, are left out as a whole.

    skipped: file, reason. A record that can't be read carries its text up to its file, and an anti join by file takes all its records away.
    """
    pattern = "*" if path.lower().endswith(".xml") else "*.[xX][mM][lL]"
    reader = spark.read.format("xml").option("rowTag", "GBSeq").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
    marked = reader.option("pathGlobFilter", pattern).schema(SCHEMA + ", `_corrupt` string").load(path)
    also = F.length(F.coalesce("GBSeq_locus", F.lit(""))) >= 0  # always so: Spark doesn't read the text of bad records alone
    broken = marked.filter(F.col("_corrupt").isNotNull() & also).select(F.col("_metadata.file_path").alias("file"), F.lit("malformed record").alias("reason"))
    lines = spark.read.option("pathGlobFilter", pattern).text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    counts = lines.groupBy("file").agg(F.sum(F.regexp_count("value", F.lit(rf"<{root}[\s>]"))).alias("opened"), F.sum(F.regexp_count("value", F.lit(rf"</{root}\s*>"))).alias("closed"))
    unclosed = counts.filter("opened != closed").select("file", F.lit("root element not closed").alias("reason"))
    skipped = written(broken.unionByName(unclosed).groupBy("file").agg(F.min("reason").alias("reason")), "skipped-files")
    named = skipped.groupBy(F.col("file").alias("_file")).agg(F.count(F.lit(1)).alias("_n"))  # which, unlike a scan, has no metadata of its own
    records = marked.filter(F.col("_corrupt").isNull() & also).join(named, F.col("_metadata.file_path") == F.col("_file"), "left_anti").drop("_corrupt")
    return records, skipped.select(F.element_at(F.split("file", "/"), -1).alias("file"), "reason")


def files_with(records: DataFrame, wanted: DataFrame) -> DataFrame:
    """(file, accession) of the wanted accessions (accession) that the record files hold."""
    held = records.select(F.col("_metadata.file_name").alias("file"), F.col("GBSeq_primary-accession").alias("accession"))
    return held.join(wanted.select("accession").distinct(), "accession", "left_semi")


def select_files(records: DataFrame, wanted: DataFrame, limit: int) -> list[str]:
    """For a trial run: files that hold wanted accessions first, then others in order, at most limit unless more are wanted."""
    names = records.select(F.col("_metadata.file_name").alias("file")).distinct()
    first = files_with(records, wanted).select("file").distinct().withColumn("first", F.lit(True))
    ranked = names.join(first, "file", "left").orderBy(F.coalesce("first", F.lit(False)).desc(), "file").limit(max(limit, first.count()))
    return [row["file"] for row in ranked.collect()]


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


NO_QUALIFIERS = "array<struct<GBQualifier_name:string,GBQualifier_value:string>>"


def _qualifiers(feature: Column) -> Column:
    return F.coalesce(feature["GBFeature_quals"]["GBQualifier"], F.array().cast(NO_QUALIFIERS))


def flatten(records: DataFrame, references: DataFrame, excluded: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per record with COLUMNS (references: accession, kind; excluded: id; known: accessions to skip, column accession).

    The type of a record is that of its reference entry or 'query'; exclusion overrides it. Of equal accessions the last record counts.
    """
    features, refs = F.col("`GBSeq_feature-table`.GBFeature"), F.col("GBSeq_references.GBReference")
    none_of = lambda c: F.coalesce(c, F.array().cast(records.select(c).schema[0].dataType))
    base = records.select(
        F.struct(F.col("_metadata.file_name"), F.monotonically_increasing_id()).alias("ord"),
        *(_or_empty(F.trim(f"`{tag}`")).alias(name) for name, tag in SCALARS.items()),
        none_of(F.col("GBSeq_keywords.GBKeyword")).alias("keywords"), none_of(features).alias("features"), none_of(refs).alias("refs"),
    )
    base = keep_one(base, ["primary_accession"], "ord", last=True).drop("ord")
    if known is not None:
        base = base.join(known, base["primary_accession"] == known["accession"], "left_anti")
    base = base.join(references.select(F.col("accession").alias("primary_accession"), "kind"), "primary_accession", "left")
    base = base.join(excluded.select(F.col("id").alias("primary_accession"), F.lit(True).alias("listed")), "primary_accession", "left")
    base = excluded_records(base, F.coalesce("listed", F.lit(False)), unverified(F.col("definition"), F.col("keywords"), F.col("record_comment")), F.coalesce("kind", F.lit("query")))
    source = F.filter("features", lambda f: f["GBFeature_key"] == "source")
    quals = F.flatten(F.transform(source, lambda f: _qualifiers(f)))
    base = base.withColumn("_q", quals)
    value = lambda name: _or_empty(F.get(F.reverse(F.filter("_q", lambda q: q["GBQualifier_name"] == name)), F.lit(0))["GBQualifier_value"])
    base = base.withColumns({f"_{name}": value(name) for name in QUALIFIERS})
    place = F.when(F.col("_country") != "", F.col("_country")).otherwise(F.col("_geo_loc_name"))
    of_gene = lambda f, key: F.get(F.filter(_qualifiers(f), lambda q: q["GBQualifier_name"] == key), F.lit(0))["GBQualifier_value"]
    genes = F.transform(F.filter("features", lambda f: f["GBFeature_key"] == "gene"), lambda f: F.concat(_or_empty(of_gene(f, "gene")), F.lit("("), _or_empty(f["GBFeature_location"]), F.lit(")")))
    cds = F.flatten(F.transform(F.filter("features", lambda f: f["GBFeature_key"] == "CDS"), lambda f: F.transform(_qualifiers(f), lambda q: F.concat(q["GBQualifier_name"], F.lit(": "), _or_empty(q["GBQualifier_value"])))))
    of_refs = lambda field: F.array_join(F.filter(F.transform("refs", lambda r: r[field]), lambda x: _or_empty(x) != ""), "; ")
    authors = F.array_join(F.flatten(F.transform("refs", lambda r: F.coalesce(r["GBReference_authors"]["GBAuthor"], F.array().cast("array<string>")))), "; ")
    flat = base.withColumns({
        "data_source": F.lit("ncbi"), "gi_number": F.col("primary_accession"), "pubmed_id": of_refs("GBReference_pubmed"),
        **{name: F.col(f"_{name}") for name in QUALIFIERS if name not in ("country", "geo_loc_name")},
        "country": country_part(place), "geo_loc": locality_part(place), "genes": F.array_join(genes, "; "), "cds_info": F.array_join(cds, "; "),
        **base_counts(F.col("sequence")), "comment": F.lit("NA"), "reference_number": of_refs("GBReference_reference"), "position": of_refs("GBReference_position"),
        "authors": authors, "title": of_refs("GBReference_title"), "journal": of_refs("GBReference_journal"),
    })
    return split_dates(flat, "collection_date").select(*COLUMNS)
