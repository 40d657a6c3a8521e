"""Trees as text: leaves, splits, distances, re-rooting, and the tree table."""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import datetime
from hashlib import blake2b

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlake.functions.text import segment_number
from strandlake.operators.ranking import keep_one
from strandlake.operators.shared import written

TOKEN = re.compile(r"\s*(?:('(?:[^']|'')*')|([(),;:])|(\[[^\]]*\])|([^\s(),;:\[\]']+))")


class Node:
    def __init__(self, name: str = "", length: float | None = None, children: list[Node] | None = None):
        self.name, self.length, self.children = name, length, children or []

    def leaves(self) -> list[str]:
        todo, found = [self], []
        while todo:
            node = todo.pop()
            todo += reversed(node.children)
            if not node.children:
                found.append(node.name)
        return found


def parse(newick: str) -> Node:
    """The tree of a Newick text; quoted names, comments and branch lengths are read, depth is not bounded."""
    root = Node()
    stack, node, wants_length = [], root, False
    for quoted, mark, _, word in TOKEN.findall(newick):
        if mark == "(":
            child = Node()
            node.children.append(child)
            stack.append(node)
            node = child
        elif mark == ",":
            node = Node()
            stack[-1].children.append(node)
        elif mark == ")":
            node = stack.pop()
        elif mark == ":":
            wants_length = True
        elif mark == ";":
            break
        elif quoted or word:
            if wants_length:
                node.length, wants_length = float(word), False
            else:
                node.name = quoted[1:-1].replace("''", "'") if quoted else word
    return root


def write(node: Node) -> str:
    """Newick text of a tree."""
    out: list[str] = []
    todo: list[Node | str] = [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(item)
            continue
        tail = (item.name if re.fullmatch(r"[^\s(),;:\[\]']*", item.name) else "'" + item.name.replace("'", "''") + "'") + ("" if item.length is None else f":{item.length:g}")
        if item.children:
            todo.append(")" + tail)
            for i, child in enumerate(reversed(item.children)):
                todo += [child] if i == len(item.children) - 1 else [child, ","]
            todo.append("(")
        else:
            out.append(tail)
    return "".join(out) + ";"


def leaves(trees: DataFrame, newick: str = "newick") -> DataFrame:
    """trees without the text, one row for each leaf."""
    rest = [c for c in trees.columns if c != newick]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = batch.assign(leaf=[parse(t or "").leaves() for t in batch[newick]])
            yield found.explode("leaf")[[*rest, "leaf"]].dropna(subset=["leaf"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in trees.schema if f.name != newick), "leaf string"])
    return trees.mapInPandas(run, schema)


def splits(root: Node, taxa: set[str], canonical_halves: bool = False) -> set[int]:
    """Bipartitions of taxa by the branches of a tree, with two taxa or more on either side: each as the sum of its smaller side's leaf hashes.

    Sums of 128-bit hashes stand for sets, so that a branch costs the same however many taxa are below it. Of two halves the side
    below the branch stands for the split, so one split may count twice; canonical_halves takes the side with the first name instead.
    A name counts once, where it stands first.
    """
    whole = sum(map(leaf_hash, taxa)) & MASK
    least = min(taxa, default="")
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += reversed(node.children)
    open_taxa = set(taxa)
    own = {}
    for node in order:
        if not node.children and node.name in open_taxa:
            open_taxa.discard(node.name)
            own[id(node)] = 1, leaf_hash(node.name), node.name == least
    below: dict[int, tuple[int, int, bool]] = {}
    found = set()
    for node in reversed(order):
        sides = [below.pop(id(c)) for c in node.children]
        n, total, first = below[id(node)] = (sum(x[0] for x in sides), sum(x[1] for x in sides) & MASK, any(x[2] for x in sides)) if sides else own.get(id(node), (0, 0, False))
        other = len(taxa) - n
        if node is root or n < 2 or other < 2:
            continue
        take_rest = n > other or (canonical_halves and n == other and not first)
        found.add((whole - total) & MASK if take_rest else total)
    return found


MASK = (1 << 128) - 1


def leaf_hash(name: str) -> int:
    return int.from_bytes(blake2b(name.encode("utf-8", "surrogatepass"), digest_size=16).digest(), "little")


def distance(a: str, b: str, canonical_halves: bool = False) -> dict[str, float]:
    """Robinson-Foulds distance over the taxa that two trees share; zeros if they share fewer than four."""
    one, two = parse(a), parse(b)
    names_a, names_b = set(one.leaves()), set(two.leaves())
    shared = names_a & names_b
    out = {"shared_taxa": len(shared), "splits_a": 0, "splits_b": 0, "rf": 0, "max_rf": 0, "normalized_rf": 0.0, "unique_to_a": len(names_a - shared), "unique_to_b": len(names_b - shared)}
    if len(shared) >= 4:
        x, y = (splits(t, shared, canonical_halves) for t in (one, two))
        most = 2 * (len(shared) - 3)
        out |= {"splits_a": len(x), "splits_b": len(y), "rf": len(x ^ y), "max_rf": most, "normalized_rf": len(x ^ y) / most}
    return out


DISTANCE = T.StructType([T.StructField(name, T.DoubleType() if name == "normalized_rf" else T.IntegerType()) for name in distance("", "")])


@F.pandas_udf(DISTANCE)
def tree_distance(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([distance(x, y) for x, y in zip(a, b, strict=True)])


def tree_nodes(trees: DataFrame) -> DataFrame:
    """(tree, leaf, low, high, root) for each node of trees (tree, newick): its leaves are those of places low to high of its tree, from 1."""
    kind = trees.schema["tree"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for tree, text in zip(batch["tree"], batch["newick"], strict=True):
                root, rows, place = parse(text or ""), [], 0
                opened: dict[int, int] = {}
                todo = [(root, False)]
                while todo:
                    node, done = todo.pop()
                    if done:
                        rows.append((None, opened.pop(id(node)), place, node is root))
                    elif node.children:
                        opened[id(node)] = place + 1
                        todo.append((node, True))
                        todo += [(c, False) for c in reversed(node.children)]
                    else:
                        place += 1
                        rows.append((node.name, place, place, node is root))
                yield pd.DataFrame(rows, columns=["leaf", "low", "high", "root"]).assign(tree=tree)

    return trees.select("tree", "newick").mapInPandas(run, f"leaf string, low int, high int, root boolean, tree {kind}")


def tree_distances(pairs: DataFrame, trees: DataFrame, canonical_halves: bool = False) -> DataFrame:
    """distance() for each of pairs (pair, a, b) of trees (tree, newick), by joins.

    A split is the pair of sums of two 64-bit hashes of its smaller side's leaves. Sums over the leaves in order of their places give
    each branch its sum as a difference of two of them; splits of both trees then meet by their sums.
    """
    nodes = written(tree_nodes(trees.join(pairs.select(F.explode(F.array("a", "b")).alias("tree")).distinct(), "tree", "left_semi")), "tree-nodes")
    sides = pairs.select("pair", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("tree")), F.struct(F.lit(1).alias("side"), F.col("b").alias("tree")))).alias("s")).select("pair", "s.*")
    placed = nodes.filter("leaf IS NOT NULL").groupBy("tree", "leaf").agg(F.min("low").alias("place"))
    own = sides.join(placed, "tree")
    taxa = own.groupBy("pair", "leaf").agg(F.max(1 - F.col("side")).alias("in_a"), F.max("side").alias("in_b"))
    shared = taxa.filter("in_a + in_b = 2").select("pair", "leaf")
    none = lambda c: F.coalesce(c, F.lit(0))
    hashes = [F.xxhash64(F.lit(k), "leaf").cast("decimal(38,0)") for k in (0, 1)]
    least = shared.groupBy("pair").agg(F.min("leaf").alias("leaf")).withColumn("first", F.lit(1))
    weighed = own.join(shared, ["pair", "leaf"]).join(least, ["pair", "leaf"], "left").select("pair", "side", "place", F.lit(1).alias("n"), none(F.col("first")).alias("first"), hashes[0].alias("h0"), hashes[1].alias("h1"))
    places = sides.join(nodes.filter("leaf IS NOT NULL").select("tree", F.col("low").alias("place")), "tree").select("pair", "side", "place")
    order = Window.partitionBy("pair", "side").orderBy("place")
    sums = ["n", "first", "h0", "h1"]
    running = written(places.join(weighed, ["pair", "side", "place"], "left").select("pair", "side", "place", *(F.sum(none(F.col(c))).over(order).alias(c) for c in sums)), "leaf-sums")
    upto = lambda place, mark: running.select("pair", "side", F.col("place").alias(place), *(F.col(c).alias(f"{c}_{mark}") for c in sums))
    branches = sides.join(nodes.filter("NOT root"), "tree").withColumn("before", F.col("low") - 1)
    met = branches.join(upto("high", "high"), ["pair", "side", "high"]).join(upto("before", "low"), ["pair", "side", "before"], "left")
    below = met.select("pair", "side", *((F.col(f"{c}_high") - none(F.col(f"{c}_low"))).alias(c) for c in sums))
    whole = weighed.filter("side = 0").groupBy("pair").agg(F.sum("n").alias("all"), F.sum("h0").alias("all_h0"), F.sum("h1").alias("all_h1"))
    rest = F.col("all") - F.col("n")
    take_rest = (F.col("n") > rest) | (F.lit(canonical_halves) & (F.col("n") == rest) & (F.col("first") == 0))
    sized = below.join(whole, "pair").filter((F.col("all") >= 4) & (F.col("n") >= 2) & (rest >= 2))
    found = sized.select("pair", "side", *(F.when(take_rest, F.col(f"all_{c}") - F.col(c)).otherwise(F.col(c)).alias(c) for c in ("h0", "h1"))).distinct()
    split = found.groupBy("pair", "h0", "h1").agg(F.max(1 - F.col("side")).alias("in_a"), F.max("side").alias("in_b"))
    counts = split.groupBy("pair").agg(F.sum("in_a").alias("splits_a"), F.sum("in_b").alias("splits_b"), F.count_if(F.col("in_a") + F.col("in_b") == 1).alias("rf"))
    names = taxa.groupBy("pair").agg(F.count_if(F.col("in_a") + F.col("in_b") == 2).alias("shared_taxa"), F.count_if(F.col("in_b") == 0).alias("unique_to_a"), F.count_if(F.col("in_a") == 0).alias("unique_to_b"))
    out = pairs.select("pair").join(names, "pair", "left").join(counts, "pair", "left").withColumn("max_rf", F.when(F.col("shared_taxa") >= 4, 2 * (F.col("shared_taxa") - 3)).otherwise(0))
    whole_number = lambda c: none(F.col(c)).cast("int").alias(c)
    normalized = F.when(F.col("max_rf") > 0, none(F.col("rf")) / F.col("max_rf")).otherwise(0.0).alias("normalized_rf")
    return out.select("pair", *map(whole_number, ("shared_taxa", "splits_a", "splits_b", "rf", "max_rf")), normalized, *map(whole_number, ("unique_to_a", "unique_to_b")))


def migrated_trees(old: DataFrame, held: DataFrame, now: datetime, order: str | None = None) -> DataFrame:
    """Rows of an old tree table as rows of the tree table: those with a tree whose source, name and segment held lacks, the first of equal ones.

    Old tables name things in several ways; the first name that has a value counts. One without trees gives no rows.
    """
    text = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    first = lambda names, *default: F.coalesce(*(text(c) for c in names if c in old.columns), *map(F.lit, default), F.lit(None).cast("string"))
    rows = old.select(
        *(first(OLD_NAMES[c], *OLD_DEFAULTS.get(c, [])).alias(c) for c in OLD_NAMES), F.lit(now).cast("timestamp").alias("created_at"), (F.col(order) if order else F.struct(*old.columns)).alias("_ord")
    ).filter("newick IS NOT NULL")
    key = ["source", "name", "segment_key", "segment"]
    known = held.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_{c}") for c in key)).distinct()
    same = [F.coalesce(F.col(c), F.lit("")) == F.col(f"_{c}") for c in key]
    new = rows.join(known, same[0] & same[1] & same[2] & same[3], "left_anti")
    return keep_one(new, key, "_ord").select("name", "source", "tree_type", "tree_model", "segment_key", "segment", "newick", "created_at")


# The names that old tree tables give to columns, by preference, and values for rows without any.
OLD_NAMES = {
    "name": ["name", "tree_name", "tree_path"], "source": ["source"], "tree_type": ["tree_type"], "tree_model": ["tree_model"],
    "segment_key": ["segment_key", "chromosome"], "segment": ["segment", "segment_number"], "newick": ["newick"],
}
OLD_DEFAULTS = {"name": ["tree_dir_tree"], "source": ["tree_dir"]}


def within_limits(found: dict[str, float], most: int | None = None, most_normalized: float | None = None) -> None:
    if most is not None and found["rf"] > most:
        raise ValueError(f"distance {found['rf']} is over {most}")
    if most_normalized is not None and found["normalized_rf"] > most_normalized:
        raise ValueError(f"normalized distance {found['normalized_rf']} is over {most_normalized}")


def tree_table(sources: DataFrame, segments: DataFrame) -> DataFrame:
    """The tree table: segment from the accession that segment_key is, else from the number in it; of equal keys the earliest counts.

    sources: name, source, tree_type, tree_model, segment_key, newick, created_at, description; segments: accession, segment.
    """
    known = segments.select(F.col("accession").alias("_a"), F.col("segment").alias("_s"))
    out = sources.join(known, F.trim("segment_key") == F.col("_a"), "left").withColumn("segment", F.coalesce("_s", segment_number(F.col("segment_key"))))
    key = ["name", "source", "tree_type", "tree_model", "segment_key", "segment"]
    return keep_one(out.select(*key, "newick", "created_at", "description"), key, F.struct("created_at", "newick", "description"))


def check_tree(tree_leaves: DataFrame, metadata: DataFrame, sequences: DataFrame) -> DataFrame:
    """(problem, id): leaves without metadata or sequence, and metadata without a leaf. Inputs: leaf; primary_accession; header."""
    leaf, meta, seq = (d.select(F.col(c).alias("id")).distinct() for d, c in ((tree_leaves, "leaf"), (metadata, "primary_accession"), (sequences, "header")))
    parts = [(leaf.join(meta, "id", "left_anti"), "leaf without metadata"), (leaf.join(seq, "id", "left_anti"), "leaf without sequence"), (meta.join(leaf, "id", "left_anti"), "metadata without leaf")]
    first, *rest = (d.select(F.lit(problem).alias("problem"), "id") for d, problem in parts)
    return first.union(rest[0]).union(rest[1])


def check_centroids(tree_leaves: DataFrame, clusters: DataFrame) -> DataFrame:
    """(id) of cluster representatives that the tree lacks."""
    return clusters.select(F.col("representative").alias("id")).distinct().join(tree_leaves.select(F.col("leaf").alias("id")), "id", "left_anti")


def segment_count(metadata: DataFrame, column: str = "segment") -> DataFrame:
    """(segments): the number of distinct segments that are not blank."""
    return metadata.agg(F.count_distinct(F.when(F.trim(column) != "", F.col(column))).alias("segments"))


def segment_completeness(metadata: DataFrame, tree_leaves: DataFrame) -> DataFrame:
    """(segment, accessions, in_tree, missing) by segment."""
    held = tree_leaves.select(F.col("leaf").alias("primary_accession")).distinct().withColumn("_in", F.lit(True))
    rows = metadata.select("primary_accession", "segment").distinct().join(held, "primary_accession", "left")
    return rows.groupBy("segment").agg(F.count(F.lit(1)).alias("accessions"), F.count_if("_in").alias("in_tree"), F.count_if(F.col("_in").isNull()).alias("missing"))
