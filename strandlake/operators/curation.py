"""Lookups and curation: filling, replacing, standardising and overlaying curated values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.functions.blanks import blank_in_curation, empty, empty_after_trim
from strandlake.functions.dates import date_flag
from strandlake.functions.text import append_item, append_unless_inside, clean_remark, clean_separators, country_part, host_name, without_curators
from strandlake.operators.ranking import keep_one

FILLABLE = ["country", "host", "collection_date"]


def cluster_column(identity: float) -> str:
    return f"cluster_{round(identity * 100)}pct"


def with_clusters(df: DataFrame, clusters: DataFrame, identity: float | None = None, key: str = "primary_accession") -> DataFrame:
    """df with its representative; clusters (representative, member, ord), of equal members the last row counts."""
    of = keep_one(clusters, ["member"], "ord", last=True).select(F.col("member").alias("_m"), F.col("representative").alias(cluster_column(identity) if identity else "cluster"))
    return df.join(of, F.col(key) == F.col("_m"), "left").drop("_m")


def with_segments(df: DataFrame, hits: DataFrame, key: str = "primary_accession") -> DataFrame:
    """segment_validated and closest_reference from hits (query, reference, segment), 'not found' without a hit."""
    found = hits.select(F.col("query").alias("_q"), F.col("segment").alias("_s"), F.col("reference").alias("_r"))
    out = df.join(found, F.col(key) == F.col("_q"), "left")
    return out.withColumns({"segment_validated": F.coalesce("_s", F.lit("not found")), "closest_reference": F.coalesce("_r", F.lit("not found"))}).drop("_q", "_s", "_r")


def fill_missing(df: DataFrame, fill: DataFrame, columns: list[str] = FILLABLE, key: str = "primary_accession", order: str = "ord") -> DataFrame:
    """Empty values of columns from fill, where the last row of a key counts. 'NA' is a value."""
    columns = [c for c in columns if c in df.columns and c in fill.columns]
    last = keep_one(fill, [key], order, last=True).select(F.col(key).alias("_k"), F.lit(True).alias("_there"), *(F.col(c).alias(f"_f_{c}") for c in columns))
    out = df.join(last, F.col(key) == F.col("_k"), "left")
    return out.withColumns({c: F.when(F.col("_there") & empty(F.col(c)), F.col(f"_f_{c}")).otherwise(F.col(c)) for c in columns}).select(*df.columns)


def replace_values(df: DataFrame, replacements: DataFrame, column: str = "host", order: str = "ord") -> DataFrame:
    """Exact replacement of a column's values by (column, replaced_by); of equal values the last row counts."""
    last = keep_one(replacements, [column], order, last=True).select(F.col(column).alias("_was"), F.col("replaced_by").alias("_now"))
    return df.join(last, F.col(column) == F.col("_was"), "left").withColumn(column, F.coalesce("_now", column)).select(*df.columns)


def _looked_up(df: DataFrame, key: Column, table: DataFrame, name: str, value: str, into: str) -> DataFrame:
    found = table.select(F.col(name).alias("_key"), F.col(value).alias(into))
    return df.join(found, key == F.col("_key"), "left").drop("_key")


def standard_country(df: DataFrame, countries: DataFrame, mapping: DataFrame) -> DataFrame:
    """country_validated (code of the mapped name, 'NA' if unknown) and _country_note; countries: display_name, m49_code; mapping: original, replacement."""
    out = df.withColumn("_was", F.when(~empty_after_trim(F.col("country")), F.trim(country_part(F.col("country")))))
    out = _looked_up(out, F.col("_was"), mapping, "original", "replacement", "_to").withColumn("_to", F.coalesce("_to", "_was"))
    out = _looked_up(out, F.col("_to"), countries, "display_name", "m49_code", "_code")
    note = F.when(F.col("_to") != F.col("_was"), F.concat(F.lit("Country mapped from mapping file: '"), F.col("_was"), F.lit("' -> '"), F.col("_to"), F.lit("'"))).otherwise("")
    return out.withColumns({"country_validated": F.coalesce(F.col("_code").cast("string"), F.lit("NA")), "_country_note": F.coalesce(note, F.lit(""))}).drop("_was", "_to", "_code")


def standard_host(df: DataFrame, names: DataFrame, scientific: DataFrame, mapping: DataFrame, fix_case: bool = False) -> DataFrame:
    """host_validated, host_taxa_id, host_scientific_name and _host_note.

    names: name (lower case), tax_id; scientific: tax_id, name; mapping: original, replacement. A mapped host is looked up as it is
    written, so names with capitals don't resolve; fix_case looks it up in lower case.
    """
    out = df.withColumn("_was", F.when(~empty_after_trim(F.col("host")), host_name(F.col("host"))))
    out = _looked_up(out, F.lower("_was"), names, "name", "tax_id", "_id1")
    out = _looked_up(out, F.col("_was"), mapping, "original", "replacement", "_to").withColumn("_to", F.when(F.col("_id1").isNull(), F.nullif(F.col("_to"), F.lit(""))))
    out = _looked_up(out, F.lower("_to") if fix_case else F.col("_to"), names, "name", "tax_id", "_id2")
    out = out.withColumn("_id", F.coalesce("_id1", "_id2"))
    out = _looked_up(out, F.col("_id"), scientific, "tax_id", "name", "_sci")
    note = F.when(F.col("_to").isNotNull(), F.concat(F.lit("Host mapped from mapping file: '"), F.col("_was"), F.lit("' -> '"), F.col("_to"), F.lit("'"))).otherwise("")
    return out.withColumns({
        "host_validated": F.when(F.col("_id").isNotNull(), "Yes").otherwise("NA"),
        "host_taxa_id": F.coalesce(F.col("_id").cast("string"), F.lit("NA")),
        "host_scientific_name": F.when(F.col("_id").isNotNull(), F.coalesce("_sci", F.lit("NA"))).otherwise(F.coalesce("_to", F.lit("NA"))),
        "_host_note": note,
    }).drop("_was", "_id1", "_to", "_id2", "_id", "_sci")


VALIDATED = ["collection_date_validated", "country_validated", "host_validated", "host_taxa_id", "host_scientific_name"]


def validate_matrix(df: DataFrame, countries: DataFrame, country_map: DataFrame, names: DataFrame, scientific: DataFrame, host_map: DataFrame, fix_case: bool = False) -> DataFrame:
    """Standardise dates, countries and hosts of the rows that are not excluded; others get empty values. Notes go to comment."""
    out = standard_host(standard_country(df, countries, country_map), names, scientific, host_map, fix_case)
    out = out.withColumn("collection_date_validated", date_flag(F.coalesce("collection_date", F.lit(""))))
    live = F.coalesce(F.trim("exclusion_status"), F.lit("")) != "1"
    comment = clean_remark(append_unless_inside(append_unless_inside(F.coalesce("comment", F.lit("")), F.col("_country_note")), F.col("_host_note")))
    out = out.withColumns({"comment": F.when(live, comment).otherwise(F.col("comment")), **{c: F.when(live, F.col(c)).otherwise("") for c in VALIDATED}})
    return out.drop("_country_note", "_host_note")


def overlay(matrix: DataFrame, curated: DataFrame, key: str = "primary_accession", order: str = "ord", matrix_order: str | None = None) -> DataFrame:
    """Curated values over the matrix, with a change log in comment.

    curated rows of a key apply by order, each on what the ones before it left. A value that is not blank and differs is set;
    only then comment (curator items out, the curated comment and "col: 'old' -> 'new'" in) and curator change. Columns that the
    matrix lacks are ignored. The first matrix row of a key by matrix_order is the target; without an order, which needs unique keys,
    all of its rows are. The rows of a key are folded inside one row's array.
    """
    columns = [c for c in curated.columns if c in matrix.columns and c not in (key, "comment", "curator", order)]
    has = lambda c: c in curated.columns and c in matrix.columns
    noted = [c for c in ("comment", "curator") if c in curated.columns]
    edits = curated.groupBy(F.trim(key).alias("_k")).agg(F.transform(F.sort_array(F.collect_list(F.struct(order, F.struct(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns + noted)).alias("e")))), lambda x: x["e"]).alias("_edits"))
    target = F.trim(key) == F.col("_k")
    if matrix_order:
        first = matrix.groupBy(F.trim(key).alias("_f")).agg(F.min(matrix_order).alias("_first"))
        edits = edits.join(first, F.col("_k") == F.col("_f")).drop("_f")
        target = target & (F.col(matrix_order) == F.col("_first"))
    joined = matrix.join(edits, target, "left")
    state = F.struct(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns), (F.coalesce("comment", F.lit("")) if "comment" in matrix.columns else F.lit("")).alias("comment"), (F.coalesce("curator", F.lit("")) if has("curator") else F.lit("")).alias("curator"), F.lit(False).alias("changed"))

    def apply(row: Column, edit: Column) -> Column:
        differs = {c: ~blank_in_curation(edit[c]) & (F.trim(edit[c]) != F.trim(row[c])) for c in columns}
        any_change = F.lit(False)
        for c in columns:
            any_change = any_change | differs[c]
        changes = F.filter(F.array(*(F.when(differs[c], F.concat(F.lit(f"{c}: '"), row[c], F.lit("' -> '"), F.trim(edit[c]), F.lit("'"))) for c in columns)), lambda x: x.isNotNull())
        comment = without_curators(row["comment"])
        if "comment" in noted:
            comment = append_item(comment, edit["comment"])
        comment = clean_separators(F.concat_ws("; ", comment, F.array_join(changes, "; ")))
        curator = F.when(any_change & ~blank_in_curation(edit["curator"]), F.trim(edit["curator"])).otherwise(row["curator"]) if "curator" in noted else row["curator"]
        return F.struct(*(F.when(differs[c], F.trim(edit[c])).otherwise(row[c]).alias(c) for c in columns), F.when(any_change, comment).otherwise(row["comment"]).alias("comment"), curator.alias("curator"), (row["changed"] | any_change).alias("changed"))

    folded = joined.withColumn("_row", F.when(F.col("_edits").isNotNull(), F.aggregate("_edits", state, apply)))
    set_columns = columns + [c for c in ("comment", "curator") if c in matrix.columns and (c != "curator" or has("curator"))]
    return folded.select(*(F.when(F.coalesce(F.col("_row.changed"), F.lit(False)), F.col(f"_row.{c}").cast(matrix.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in set_columns else F.col(c) for c in matrix.columns))


def overlay_report(matrix: DataFrame, curated: DataFrame, key: str = "primary_accession") -> DataFrame:
    """(known, unknown) curated rows by whether the matrix has their key."""
    held = matrix.select(F.trim(key).alias("_k")).distinct().withColumn("_held", F.lit(True))
    return curated.join(held, F.trim(key) == F.col("_k"), "left").agg(F.count_if("_held").alias("known"), F.count_if(F.col("_held").isNull()).alias("unknown"))


def collect_filtered(errors: DataFrame, unprojectable: DataFrame) -> DataFrame:
    """(seq_name, reference, error, warnings) of failed sequences and of those that can't be projected; failures count first."""
    failed = errors.filter(F.trim(F.coalesce("errors", F.lit(""))) != "").select(F.col("accession").alias("seq_name"), "reference", F.col("errors").alias("error"), "warnings", F.struct(F.lit(0).alias("s"), F.col("ord.file").alias("f"), F.col("ord.line").alias("l")).alias("_o"))
    lost = unprojectable.select("seq_name", "reference", F.lit("").alias("error"), F.lit("").alias("warnings"), F.struct(F.lit(1).alias("s"), F.lit("").alias("f"), F.lit(0).cast("long").alias("l")).alias("_o"))
    return keep_one(failed.union(lost), ["seq_name"], F.struct("_o", "reference")).drop("_o")


def with_placements(df: DataFrame, major: DataFrame, minor: DataFrame, key: str = "primary_accession") -> DataFrame:
    """Clade columns from two tables of alternatives (key, best, names, weights), by accession without version; empty where there is none."""
    out = df
    for kind, found in (("major", major), ("minor", minor)):
        cols = {"best": f"EPA_{kind}_clade", "names": f"EPA_{kind}_all", "weights": f"{kind}_LWR_score"}
        out = out.join(found.select(F.col("key").alias("_p"), *(F.col(a).alias(b) for a, b in cols.items())), F.substring_index(key, ".", 1) == F.col("_p"), "left").drop("_p").fillna("", list(cols.values()))
    return out
