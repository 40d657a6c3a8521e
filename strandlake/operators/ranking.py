"""One row per group. Ties are settled by an explicit ordinal, never by arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: list[str], order: str | Column, last: bool = False) -> DataFrame:
    """The first (or last) row of each key by order, which must tell the rows of a key apart.

    An aggregate, not a window: rows of a key meet partially in the map tasks, so a hot key costs no more than others.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    order = F.col(order) if isinstance(order, str) else order
    return df.groupBy(*keys).agg(pick(F.struct(*rest), order).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def best_hit(hits: DataFrame, key: str = "query", score: str = "identity", order: str = "ord") -> DataFrame:
    """The hit of the highest score of each query; of equal scores the first one. A hit without a score counts after all others."""
    return keep_one(hits, [key], F.struct(F.col(score).isNull().alias("n"), (-F.col(score)).alias("s"), F.col(order).alias("o")))


def keep_last_record(df: DataFrame, key: str = "primary_accession", order: str = "ord") -> DataFrame:
    return keep_one(df, [key], order, last=True)


def first_of_content(df: DataFrame, content: str = "sequence", order: str = "ord") -> DataFrame:
    """The first row of each content; the content is compared by a 256-bit digest, so that only digests are shuffled as keys."""
    return keep_one(df.withColumn("_digest", F.sha2(content, 256)), ["_digest"], order).drop("_digest")


def first_before_bar(sequences: DataFrame, order: str = "ord") -> DataFrame:
    """The first row of each accession, which is the part of the header before a bar."""
    return keep_one(sequences.withColumn("_accession", F.substring_index("header", "|", 1)), ["_accession"], order).drop("_accession")


def alternatives(placements: DataFrame, key: Column, weight: Column, name: Column, order: str = "ord") -> DataFrame:
    """(key, best, names, weights): the best name and all names and weights by falling weight, joined by ';'; unreadable weights count as -1, empty names as NULL."""
    number = F.coalesce(F.trim(weight).try_cast("double"), F.lit(-1.0))
    shown = F.when(F.coalesce(F.trim(name), F.lit("")) == "", "NULL").otherwise(F.trim(name))
    rows = placements.select(key.alias("key"), F.struct((-number).alias("w"), F.col(order).alias("o"), shown.alias("n"), weight.alias("t")).alias("x"))
    ordered = rows.groupBy("key").agg(F.sort_array(F.collect_list("x")).alias("x"))
    return ordered.select("key", F.col("x")[0]["n"].alias("best"), F.array_join(F.transform("x", lambda e: e["n"]), ";").alias("names"), F.array_join(F.transform("x", lambda e: e["t"]), ";").alias("weights"))


def distinct_in_order(df: DataFrame, key: str, value: str, order: str, separator: str = "; ") -> DataFrame:
    """(key, value): the distinct values of each key by their first occurrence."""
    first = df.groupBy(key, value).agg(F.min(order).alias("_o"))
    ordered = first.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_o", value))).alias("_x"))
    return ordered.select(key, F.array_join(F.transform("_x", lambda x: x[value]), separator).alias(value))


def common_names(names: DataFrame) -> DataFrame:
    """(tax_id, common_name): the last 'genbank common name', else the first 'common name'."""
    official = keep_one(names.filter("name_class = 'genbank common name'"), ["tax_id"], "ord", last=True).select("tax_id", F.col("name").alias("_official"))
    other = keep_one(names.filter("name_class = 'common name'"), ["tax_id"], "ord").select("tax_id", F.col("name").alias("_other"))
    return official.join(other, "tax_id", "full_outer").select("tax_id", F.coalesce("_official", "_other").alias("common_name"))


def canonical_tree(trees: DataFrame) -> DataFrame:
    """One tree: by source (usher, iqtree, others), then by name."""
    rank = F.when(F.col("source") == "usher", 0).when(F.col("source") == "iqtree", 1).otherwise(2)
    return trees.orderBy(rank, "name").limit(1)
