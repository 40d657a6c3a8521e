"""Incremental loading: keyed append with ledgers, upsert and version-aware differences."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlake.functions.blanks import key_value
from strandlake.functions.text import accession_base, accession_version
from strandlake.operators.ranking import keep_one

# The key of each table, by preference; the first whose columns are all there counts.
KEYS = {
    "meta_data": [["primary_accession"]],
    "sequences": [["header"]],
    "sequence_alignment": [["sequence_id", "alignment_name"], ["primary_accession", "alignment_name"], ["sequence_id"]],
    "features": [["accession", "reference_accession", "aln_start", "aln_end", "cds_start", "cds_end", "product"]],
    "genes": [["accession", "category", "start", "end", "gene_name"]],
    "m49_country": [["m49_code"]],
    "host_taxa": [["host_taxa_id"], ["tax_id"], ["id"]],
    "host_children": [["parent_taxa_id", "child_taxa_id"], ["parent", "child"]],
    "host_lineage": [["host_taxa_id", "rank"], ["host_taxa_id"], ["tax_id", "rank"], ["tax_id"]],
    "host_lineage_lookup": [["host_taxa_id"], ["tax_id"], ["query"], ["name"]],
    "trees": [["tree_path"], ["source", "name"], ["tree_name", "tree_model", "segment_number"]],
}
# How many leading columns are the key if none of KEYS fits.
FALLBACK = {"sequence_alignment": 2, "host_children": 2, "host_lineage": 2, "trees": 2}


def table_key(name: str, columns: list[str]) -> list[str]:
    for key in KEYS.get(name, []):
        if set(key) <= set(columns):
            return key
    if name in ("features", "meta_data", "sequences"):
        raise ValueError(f"{name} lacks key columns: {[c for c in KEYS[name][0] if c not in columns]}")
    return columns[: FALLBACK.get(name, 1)]


def with_synonyms(df: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """df with each wanted column, taken from the first of its synonyms that is there if it is not."""
    for name, synonyms in wanted.items():
        if name not in df.columns:
            source = next((c for c in synonyms if c in df.columns), None)
            if source is None:
                raise ValueError(f"neither {name} nor any of {synonyms} is a column")
            df = df.withColumn(name, F.col(source))
    return df


# The alignment table's id under either name.
ALIGNMENT_SYNONYMS = {"sequence_id": ["primary_accession"], "primary_accession": ["sequence_id"]}


def _normal(df: DataFrame, keys: list[str]) -> list[Column]:
    return [key_value(F.col(k), isinstance(df.schema[k].dataType, T.StringType)).alias(f"_k{i}") for i, k in enumerate(keys)]


def _by_key(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    out = F.lit(True)
    for i in range(len(keys)):
        out = out & a[f"_k{i}"].eqNullSafe(b[f"_k{i}"])
    return out


def keyed_append(table: DataFrame, incoming: DataFrame, keys: list[str], order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(new rows, duplicates): incoming rows whose key the table lacks, the first of each key by order; and the keys that it has.

    String keys are compared trimmed, null as empty; other keys null-safely.
    """
    held = table.select(*_normal(table, keys)).distinct()
    rows = incoming.select("*", *_normal(incoming, keys))
    duplicates = rows.join(held, _by_key(rows, held, keys), "left_semi")
    new = rows.join(held, _by_key(rows, held, keys), "left_anti")
    order_by = F.col(order) if order else F.struct(*incoming.columns)
    first = keep_one(new, [f"_k{i}" for i in range(len(keys))], order_by)
    return first.select(*incoming.columns), duplicates.select(*(F.col(f"_k{i}").alias(k) for i, k in enumerate(keys))).distinct()


def duplicate_ledger(duplicates: DataFrame, table: str, keys: list[str], reason: str, now: datetime) -> DataFrame:
    key = F.concat_ws("|", *(F.col(k).cast("string") for k in keys))
    return duplicates.select(F.lit(table).alias("table_name"), key.alias("key"), F.lit(reason).alias("reason"), F.lit(now).cast("timestamp").alias("date"))


def update_ledger(rows: DataFrame, now: datetime, column: str = "primary_accession") -> DataFrame:
    return rows.select(F.trim(column).alias(column)).filter(f"{column} != ''").distinct().withColumn("updated_at", F.lit(now).cast("timestamp"))


def upsert(base: DataFrame, changed: DataFrame, keys: list[str]) -> DataFrame:
    """base with the rows of changed in place of those of equal key; columns that changed lacks keep base's values."""
    shared = [c for c in changed.columns if c in base.columns and c not in keys]
    new = changed.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), *(F.col(c).alias(f"_n_{c}") for c in shared), F.lit(True).alias("_new"))
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & base[k].eqNullSafe(new[f"_k{i}"])
    joined = base.join(new, on, "full_outer")
    pick = lambda c: F.coalesce(c, f"_k{keys.index(c)}") if c in keys else F.when(F.col("_new"), F.col(f"_n_{c}")).otherwise(F.col(c)) if c in shared else F.col(c)
    return joined.select(*(pick(c).alias(c) for c in base.columns))


def upsert_counts(base: DataFrame, changed: DataFrame, keys: list[str]) -> DataFrame:
    """(inserted, updated)"""
    held = base.select(*keys).distinct().withColumn("_held", F.lit(True))
    return changed.join(held, keys, "left").agg(F.count_if(F.col("_held").isNull()).alias("inserted"), F.count_if("_held").alias("updated"))


def version_diff(local: DataFrame, remote: DataFrame, excluded: DataFrame, order: str = "ord") -> DataFrame:
    """(accession, state, old) for remote accessions that are new, or newer than the local version ('updated', old is the local one).

    local and remote: accession (local with order); excluded: accession bases. An exact match, an excluded base, and a base that
    is known without version are skipped. A base whose first local row has no version counts as known without version.
    """
    base, version = accession_base(F.col("accession")), accession_version(F.col("accession"))
    rows = local.select(base.alias("base"), version.alias("version"), F.col(order).alias("_o")).filter("base IS NOT NULL")
    known = rows.groupBy("base").agg(F.max("version").alias("_max"), F.min_by(F.struct(F.col("version").alias("v")), "_o")["v"].alias("_first"))
    known = known.select("base", F.when(F.col("_first").isNotNull(), F.col("_max")).alias("_local"), F.lit(True).alias("_known"))
    asked = remote.select(F.trim("accession").alias("accession")).filter("accession != ''")
    asked = asked.join(local.select(F.trim("accession").alias("accession")).distinct(), "accession", "left_anti")
    asked = asked.withColumns({"base": base, "version": version}).join(excluded.select(F.trim("accession").alias("base")).distinct(), "base", "left_anti")
    both = asked.join(known, "base", "left")
    state = F.when(F.col("_known").isNull(), "new").when(F.col("version") > F.col("_local"), "updated")
    old = F.when(F.col("_local") > 0, F.concat_ws(".", "base", "_local")).otherwise(F.col("base"))
    return both.select("accession", state.alias("state"), F.when(state == "updated", old).alias("old")).filter("state IS NOT NULL")


def update_log(diff: DataFrame) -> DataFrame:
    """(old, new): 'NA' stands for no old version."""
    return diff.select(F.coalesce("old", F.lit("NA")).alias("old"), F.col("accession").alias("new"))
