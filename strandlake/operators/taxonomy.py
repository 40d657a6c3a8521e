"""Taxonomy walks: lineages, lineage columns, children and names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.functions.blanks import blank_taxon
from strandlake.operators.ranking import common_names, keep_one
from strandlake.operators.shared import written

# Ranks that become columns of a lineage; 'order' is a word of SQL, so its column is order_category.
RANKS = ["superkingdom", "phylum", "class", "order", "family", "genus", "species"]


def wanted_taxa(df: DataFrame, column: str = "host_taxa_id") -> DataFrame:
    """(tax_id): distinct ids that are not blank; anything else that is not a whole number fails."""
    return df.filter(~blank_taxon(F.col(column))).select(F.trim(column).cast("bigint").alias("tax_id")).distinct()


def ancestors(wanted: DataFrame, nodes: DataFrame) -> DataFrame:
    """(tax_id, ancestor, depth): every ancestor of each wanted id, itself at depth 0; a self-parent or a cycle ends the walk.

    By doubling: each round goes as many steps at once as all rounds before it, so that depth d takes about log2(d) rounds. Steps
    lead from every node, walks from the wanted ids alone. A walk that comes back to an ancestor keeps its first place, and
    rounds end when none finds an ancestor that is new.
    """
    up = nodes.select(F.col("tax_id").cast("bigint").alias("at"), F.col("parent_tax_id").cast("bigint").alias("to"))
    step = written(up.filter("at != to").distinct(), "steps")
    walk = written(wanted.select(F.col("tax_id").cast("bigint").alias("tax_id")).distinct().select("tax_id", F.col("tax_id").alias("ancestor"), F.lit(0).alias("depth")), "walk")
    length, known = 1, walk.count()
    while True:
        further = walk.join(step, F.col("ancestor") == F.col("at")).select("tax_id", F.col("to").alias("ancestor"), (F.col("depth") + length).alias("depth"))
        after = written(walk.unionByName(further).groupBy("tax_id", "ancestor").agg(F.min("depth").alias("depth")), "walk")
        if (n := after.count()) == known:
            return after
        walk, known, length = after, n, 2 * length
        step = written(step.join(step.select(F.col("at").alias("to"), F.col("to").alias("next")), "to").select("at", F.col("next").alias("to")).distinct(), "steps")


def scientific_names(names: DataFrame) -> DataFrame:
    """(tax_id, name): the last scientific name of each id."""
    return keep_one(names.filter("name_class = 'scientific name'"), ["tax_id"], "ord", last=True).select(F.col("tax_id").cast("bigint").alias("tax_id"), "name")


def lineage_columns(walk: DataFrame, nodes: DataFrame, scientific: DataFrame) -> DataFrame:
    """(tax_id, one column for each rank): the nearest ancestor of the rank."""
    named = walk.join(nodes.select(F.col("tax_id").cast("bigint").alias("ancestor"), "rank"), "ancestor").join(scientific.select(F.col("tax_id").alias("ancestor"), "name"), "ancestor", "left")
    named = named.withColumn("name", F.coalesce("name", F.concat(F.lit("taxid_"), F.col("ancestor").cast("string"))))
    columns = [F.min_by(F.when(F.col("rank") == rank, F.col("name")), F.when(F.col("rank") == rank, F.col("depth"))).alias("order_category" if rank == "order" else rank) for rank in RANKS]
    return named.groupBy("tax_id").agg(*columns)


def lineage_lookup(walk: DataFrame, nodes: DataFrame, scientific: DataFrame) -> DataFrame:
    """(lineage_taxa_id, lineage_name, lineage_rank, desc_taxa_id, desc_name, desc_rank) for each ancestor of each id."""
    label = nodes.select(F.col("tax_id").cast("bigint").alias("id"), "rank").join(scientific.select(F.col("tax_id").alias("id"), "name"), "id", "left")
    up = label.select(F.col("id").alias("ancestor"), F.col("name").alias("lineage_name"), F.col("rank").alias("lineage_rank"))
    down = label.select(F.col("id").alias("tax_id"), F.col("name").alias("desc_name"), F.col("rank").alias("desc_rank"))
    out = walk.join(up, "ancestor", "left").join(down, "tax_id", "left")
    return out.select(F.col("ancestor").alias("lineage_taxa_id"), "lineage_name", "lineage_rank", F.col("tax_id").alias("desc_taxa_id"), "desc_name", "desc_rank")


def children(wanted: DataFrame, nodes: DataFrame, scientific: DataFrame) -> DataFrame:
    """(name, child_taxa_id, parent_taxa_id, child_rank, parent_rank) of the direct children of the wanted ids."""
    node = nodes.select(*(F.col(c).cast("bigint").alias(c) for c in ("tax_id", "parent_tax_id")), "rank")
    parents = wanted.join(node.select("tax_id", F.col("rank").alias("parent_rank")), "tax_id", "left").select(F.col("tax_id").alias("parent_taxa_id"), "parent_rank")
    below = node.filter("tax_id != parent_tax_id").join(parents, F.col("parent_tax_id") == F.col("parent_taxa_id"))
    return below.join(scientific.select("tax_id", "name"), "tax_id", "left").select("name", F.col("tax_id").alias("child_taxa_id"), "parent_taxa_id", F.col("rank").alias("child_rank"), "parent_rank")


def taxa_names(wanted: DataFrame, names: DataFrame, nodes: DataFrame) -> DataFrame:
    """(taxa_id, name, name_type, taxonomy_level, common_name); one row 'Unknown' for ids without names."""
    kind = F.when(F.col("name_class") == "scientific name", "scientific").when(F.col("name_class").isin("genbank common name", "common name"), "generic").otherwise("other")
    rows = names.select(F.col("tax_id").cast("bigint").alias("tax_id"), "name", kind.alias("name_type"))
    common = common_names(names).select(F.col("tax_id").cast("bigint").alias("tax_id"), "common_name")
    rank = nodes.select(F.col("tax_id").cast("bigint").alias("tax_id"), "rank")
    out = wanted.join(rows, "tax_id", "left").join(rank, "tax_id", "left").join(common, "tax_id", "left")
    return out.select(F.col("tax_id").alias("taxa_id"), F.coalesce("name", F.lit("Unknown")).alias("name"), F.coalesce("name_type", F.lit("other")).alias("name_type"), F.col("rank").alias("taxonomy_level"), "common_name")
