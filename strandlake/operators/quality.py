"""Filters with an audit trail: exclusion of records, quality rules, routing and failed validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.functions.blanks import integer_or
from strandlake.functions.sequence import letter_count
from strandlake.functions.text import appended_reason

# Division lists that the quality filter starts from.
DIVISIONS = ["VRL", "PAT", "SYN", "ENV"]
VALID_DIVISIONS = ["VRL", "ENV"]
# Name classes that count as names of a host.
NAME_CLASSES = ["scientific name", "genbank common name", "common name", "synonym", "equivalent name", "blast name"]


def unverified(definition: Column, keywords: Column, comment: Column) -> Column:
    says = lambda c, word: F.upper(F.coalesce(c, F.lit(""))).contains(word)
    return says(definition, "UNVERIFIED") | F.exists(keywords, lambda k: says(k, "UNVERIFIED")) | says(comment, "UNVERIFIED") | says(comment, "UNABLE TO VERIFY")


def excluded_records(df: DataFrame, listed: Column, unverified_record: Column, kind: Column) -> DataFrame:
    """accession_type, exclusion_criteria and exclusion_status ('0' or '1'): the user's list counts before unverified records, and exclusion before the type."""
    reason = F.when(listed, "excluded by the user").when(unverified_record, "unverified sequence in XML").otherwise("")
    out = df.withColumn("_reason", reason)
    return out.withColumns({
        "accession_type": F.when(F.col("_reason") != "", "excluded").otherwise(kind),
        "exclusion_criteria": F.col("_reason"),
        "exclusion_status": F.when(F.col("_reason") != "", "1").otherwise("0"),
    }).drop("_reason")


def quality_filter(df: DataFrame, min_length: int, min_known: int, divisions: list[str] | None = None, valid: list[str] = VALID_DIVISIONS) -> DataFrame:
    """exclusion_status and exclusion_criteria by the quality rules, of which the last that holds gives the text; rows excluded before stay as they are.

    df has division, length, n, sequence, exclusion_status, exclusion_criteria. divisions (if given) are those that are allowed.
    """
    length = integer_or(F.col("length"), F.length(F.coalesce("sequence", F.lit(""))).cast("bigint"))
    unknown = integer_or(F.col("n"), letter_count(F.col("sequence"), "N").cast("bigint"))
    division = F.coalesce("division", F.lit(""))
    says = lambda what: F.concat(F.lit("GenBank division "), division, F.lit(f" not in {what} list"))
    rule = F.when(length - unknown < min_known, "Real sequence length (length - Ns) less than the threshold").when(length < min_length, "Sequence length less than total length")
    if divisions is not None:
        rule = rule.when(~division.isin(divisions), says("user-defined exclusion"))
    rule = rule.when(~division.isin(valid), says("valid division"))
    before = F.coalesce(F.trim("exclusion_status"), F.lit("")) == "1"
    existing = F.trim(F.coalesce("exclusion_criteria", F.lit("")))
    text = F.when(rule.isNull(), existing).otherwise(appended_reason(existing, rule))
    return df.withColumns({"exclusion_criteria": F.when(before, F.col("exclusion_criteria")).otherwise(text), "exclusion_status": F.when(before, F.col("exclusion_status")).otherwise(F.when(rule.isNull(), "0").otherwise("1"))})


def route(df: DataFrame, references: DataFrame, key: str = "primary_accession") -> DataFrame:
    """df with route: 'reference' or 'query', null where the row is excluded."""
    listed = references.select(F.col("accession").alias("_ref")).distinct()
    kind = F.when(F.coalesce("exclusion_status", F.lit("0")) == "1", F.lit(None)).when(F.col("_ref").isNotNull(), "reference").otherwise("query")
    return df.join(listed, F.col(key) == F.col("_ref"), "left").withColumn("route", kind).drop("_ref")


def drop_excluded_hits(hits: DataFrame, references: DataFrame) -> DataFrame:
    """Best hits whose reference is not on the exclusion list."""
    gone = references.filter("kind = 'exclusion_list'").select(F.col("accession").alias("reference"))
    return hits.join(gone, "reference", "left_anti").select(*hits.columns)


def annotate_hits(matrix: DataFrame, queries: DataFrame, best: DataFrame, references: DataFrame, key: str = "gi_number") -> DataFrame:
    """Exclude queries without a hit, and those whose best hit is on the exclusion list; queries: header; best: query, reference."""
    gone = references.filter("kind = 'exclusion_list'").select(F.col("accession").alias("reference"), F.lit(True).alias("_bad"))
    hit = best.join(gone, "reference", "left").select(F.col("query").alias("_q"), F.coalesce("_bad", F.lit(False)).alias("_bad"))
    asked = queries.select(F.col("header").alias("_h")).distinct()
    out = matrix.join(asked, F.col(key) == F.col("_h"), "left").join(hit, F.col(key) == F.col("_q"), "left")
    reason = F.when(F.col("_bad"), "excluded: best BLAST hit is an exclusion_list reference").when(F.col("_h").isNotNull() & F.col("_q").isNull(), "excluded due to no hit")
    return _excluded_for(out, reason).select(*_columns(matrix))


def annotate_failures(matrix: DataFrame, errors: DataFrame, key: str = "gi_number") -> DataFrame:
    """Exclude accessions that the aligner failed on; errors (accession, errors, ord), only lines that say 'In sequence' count."""
    failed = errors.filter(F.col("errors").contains("In sequence")).groupBy("accession").agg(F.sort_array(F.collect_list(F.struct("ord", "errors"))).alias("_x"))
    failed = failed.select(F.col("accession").alias("_acc"), F.array_join(F.transform("_x", lambda x: F.trim(x["errors"])), "; ").alias("_text"))
    return _excluded_for(matrix.join(failed, F.col(key) == F.col("_acc"), "left"), F.col("_text")).select(*_columns(matrix))


def _columns(matrix: DataFrame) -> list[str]:
    return [*matrix.columns, *(c for c in ("exclusion_status", "exclusion_criteria") if c not in matrix.columns)]


def _excluded_for(df: DataFrame, reason: Column) -> DataFrame:
    for name, default in (("exclusion_status", "0"), ("exclusion_criteria", "")):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(default))
    return df.withColumns({"exclusion_criteria": F.when(reason.isNull(), F.col("exclusion_criteria")).otherwise(appended_reason(F.col("exclusion_criteria"), reason)), "exclusion_status": F.when(reason.isNull(), F.col("exclusion_status")).otherwise("1")})


# The columns of the report of rows that failed validation.
FAILED_COLUMNS = ["primary_accession", "collection_date_validated", "host_validated", "country_validated", "host", "host_scientific_name", "country", "collection_date"]


def failed_report(df: DataFrame) -> DataFrame:
    """The report of rows that failed validation: FAILED_COLUMNS, empty where df lacks one."""
    failed = failed_validation(df)
    return failed.select(*(F.col(c) if c in df.columns else F.lit("").alias(c) for c in FAILED_COLUMNS))


def drop_filtered(df: DataFrame, filtered: DataFrame, key: str = "primary_accession", kind: str = "accession_type") -> DataFrame:
    """Rows not among filtered (seq_name); references and masters always stay."""
    gone = filtered.select(F.col("seq_name").alias("_gone")).distinct()
    joined = df.join(gone, F.col(key) == F.col("_gone"), "left")
    return joined.filter(F.col("_gone").isNull() | F.lower(F.coalesce(kind, F.lit(""))).isin("reference", "master")).drop("_gone")


def split_excluded(df: DataFrame, kind: str = "accession_type") -> tuple[DataFrame, DataFrame]:
    """(rows that stay, audit of (primary_accession, reason)) by a filled exclusion column; references and masters stay, but are in the audit."""
    filled = F.trim(F.coalesce("exclusion", F.lit(""))) != ""
    audit = df.filter(filled).select("primary_accession", F.trim("exclusion").alias("reason"))
    return df.filter(~filled | F.lower(F.coalesce(kind, F.lit(""))).isin("reference", "master")), audit


def not_excluded(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.filter(F.col(column).isNull() | (F.col(column).cast("string") != value)) if column in df.columns else df


def processed(df: DataFrame) -> DataFrame:
    return df.filter(F.coalesce(F.trim("exclusion_status"), F.lit("")) != "1")


def failed_validation(df: DataFrame) -> DataFrame:
    return processed(df).filter((F.col("collection_date_validated") != "Yes") | (F.col("country_validated") == "NA") | (F.col("host_validated") != "Yes"))


def coding_rows(gff: DataFrame) -> DataFrame:
    return gff.filter("type = 'CDS'")


def with_errors(errors: DataFrame) -> DataFrame:
    """Warnings alone don't count."""
    return errors.filter(F.trim(F.coalesce("errors", F.lit(""))) != "")


def host_names(names: DataFrame) -> DataFrame:
    return names.filter(F.col("name_class").isin(NAME_CLASSES))


def segment_exclusion(df: DataFrame, segments: int = 8, overwrite: bool = True) -> DataFrame:
    """exclusion from segment_validated: none found, or not a number from 1 to segments."""
    number = F.col("segment_validated").try_cast("int")
    text = F.when(F.col("segment_validated") == "not found", "not significant BLAST hit").when(number.between(1, segments), "").otherwise("non IAV genomic sequence")
    if overwrite or "exclusion" not in df.columns:
        return df.withColumn("exclusion", text)
    return df.withColumn("exclusion", F.when(F.coalesce("exclusion", F.lit("")) == "", text).otherwise(F.col("exclusion")))
