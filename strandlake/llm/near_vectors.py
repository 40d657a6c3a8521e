"""Embedding near-dedup on a robust-pruned flat graph built from overlapping cluster shards.

Vectors of one label and length that point the same way form a class, so that copies are compared once. A cell of more than
CAPACITY classes is split by up to FAN centers, fitted on a sample of SAMPLE of its classes; a class goes to its nearest OVERLAP
centers (in deeper splits to as many as its rank before leaves: OVERLAP + 1 - rank), so that shards overlap and a class is in
few of them however deep they lie. Each shard builds a graph of its members, a node's adjacency lists of all its shards are
united, and every class is searched for from the shard's medoid along them. What is found in range widens: a group takes in
all it is linked to among its neighbours, by exact cosines. Neighbours in shards that a query was not searched in are met by
joins, round by round, until no link is new.

A link is counted in the first shard that holds both ends, so links are counted where they are found and not written out; if that
shard's search missed a link of a small group that another one finds, and one end has no other link, it is added. Groups
too large for one shard are certified instead of compared: all classes within half the threshold's angle of a leader are linked
with one another (the triangle inequality), so only their number is needed.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, and those of a null label, link
with nothing, nor do vectors of different lengths; classes are told apart by directions rounded to 12 digits; rows whose ids are
null or repeat are rows like any other and may be in a group, named by its smallest id that isn't null; a row without
links has its own id as component; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm import vector_graph
from strandlake.llm.common import materialize
from strandlake.llm.simhash import components

THRESHOLD = 0.93
#: Classes of a shard that is not split, those aimed at, shards of a class in the first split, and classes that centers are fitted on.
CAPACITY, TARGET, OVERLAP, SAMPLE, FAN = 2048, 1024, 3, 1024, 64
#: Splits after which a cell stays as it is, rows of a cell that one task deals out, and sampled classes that a leader must have near it.
MOST_SPLITS, DEALT, SUPPORT = 40, 65_536, 8
#: Members of a group whose links found in a later shard are written out.
SMALL = 16
#: Queries of the audit; each is compared with all rows.
AUDITED = 256


def directions(rows: DataFrame, id_column: str, vector: str, label: str) -> DataFrame:
    """(id, label, key, unit): unit vectors with a digest of their rounded direction; both null where a row links with nothing."""
    from hashlib import blake2b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, units = [None] * len(batch), [None] * len(batch)
            size = batch.column(2).value_lengths().fill_null(0).to_numpy()
            for d in set(size[size > 0].tolist()):
                rows = np.flatnonzero((size == d) & batch.column(1).is_valid().to_numpy(zero_copy_only=False))
                v = matrix(batch.column(2).take(pa.array(rows))) if len(rows) else np.zeros((0, d))  # a null component becomes nan
                most = np.abs(v).max(1)
                able = (most > 0) & (most < np.inf)
                unit = v[able] / most[able, None]
                unit = np.round(unit / np.linalg.norm(unit, axis=1)[:, None], 12) + 0.0
                for i, u in zip(rows[able].tolist(), unit, strict=True):
                    units[i], keys[i] = u, blake2b(u.tobytes(), digest_size=16).digest()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, "binary"), pa.array(units, pa.list_(pa.float64()))], ["id", "label", "key", "unit"])

    kinds = [rows.schema[c].dataType.simpleString() for c in (id_column, label)]
    picked = rows.select(F.col(id_column).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    return picked.mapInArrow(run, f"id {kinds[0]}, label {kinds[1]}, key binary, unit array<double>")


def matrix(column: pa.Array, dtype: str = "f8") -> np.ndarray:
    """Lists of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(dtype, copy=False)


def sampled(copies: DataFrame, large: DataFrame) -> DataFrame:
    """About SAMPLE rows of each large cell, chosen by a hash of the node."""
    return copies.join(large, "cell").filter(F.pmod(F.xxhash64("node", "cell"), F.ceil(F.col("n") / SAMPLE)) == 0)


def centers(copies: DataFrame, large: DataFrame) -> DataFrame:
    """(cell, table): the flat centers of each large cell, by three rounds of k-means on its sample."""
    def run(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
        found = found.combine_chunks().sort_by("node")
        x = matrix(found.column("unit").chunk(0))
        k = min(FAN, len(x), max(2, -(-OVERLAP * found.column("n")[0].as_py() // TARGET)))
        chosen = x[np.random.default_rng(len(x)).permutation(len(x))[:k]]
        for _ in range(3):
            nearest = ranked(x, chosen, 1)[:, 0]
            for j in range(k):
                mean = x[nearest == j].sum(0)
                if np.linalg.norm(mean) > 0:
                    chosen[j] = mean / np.linalg.norm(mean)
        return pa.table({"cell": pa.array([key[0].as_py()]), "table": [chosen.ravel()]})

    return sampled(copies, large).groupBy("cell").applyInArrow(run, "cell string, table array<double>")


def leaders(copies: DataFrame, large: DataFrame, threshold: float) -> DataFrame:
    """(cell, table): flat leaders of large cells, each with SUPPORT sampled classes within half the angle of threshold."""
    half = np.sqrt((1 + threshold) / 2)

    def run(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
        x = matrix(found.combine_chunks().sort_by("node").column("unit").chunk(0))
        close = x @ x.T >= half
        chosen: list[int] = []
        for i in np.argsort(-close.sum(1), kind="stable").tolist():
            if close[i].sum() < SUPPORT:
                break
            if not close[i, chosen].any():
                chosen.append(i)
        return pa.table({"cell": pa.array([key[0].as_py()] * bool(chosen), "string"), "table": pa.array([x[chosen].ravel()] if chosen else [], pa.list_(pa.float64()))})

    return sampled(copies, large).groupBy("cell").applyInArrow(run, "cell string, table array<double>")


def ranked(x: np.ndarray, table: np.ndarray, k: int) -> np.ndarray:
    """The k nearest rows of table for each row of x, by differences: products would tie where vectors are very near."""
    out = np.empty((len(x), k), "i8")
    for i in range(0, len(x), 256):
        far = ((x[i : i + 256, None] - table[None]) ** 2).sum(2)
        out[i : i + 256] = np.argsort(far, axis=1, kind="stable")[:, :k]
    return out


def met(copies: DataFrame, large: DataFrame, tables: DataFrame, f: Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
    """f of the rows of each cell of tables and the cell's table. Rows are dealt out by cell and salt, behind a copy of the table."""
    salts = F.ceil(F.col("n") / DEALT)
    rows = copies.join(large, "cell").select("cell", F.pmod(F.xxhash64("node"), salts).alias("salt"), F.lit(1).alias("kind"), "node", "budget", "unit")
    heads = tables.join(large, "cell").select("cell", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("node"), F.lit(0).alias("budget"), F.col("table").alias("unit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = table = None
        for batch in batches:
            kinds = batch.column(2).to_numpy()
            cells = np.array(batch.column(0).to_pylist(), object)
            starts = np.concatenate([[0], np.flatnonzero((kinds[1:] == 0) | (cells[1:] != cells[:-1])) + 1, [len(kinds)]])
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                if a < b and kinds[a] == 0:
                    cell, table = cells[a], batch.column(5).slice(a, 1).flatten().to_numpy()
                    a += 1
                if a < b and cells[a] == cell:  # cells without a table have no result
                    part = batch.slice(a, b - a)
                    yield f(part, table.reshape(-1, len(part.column(5)[0])))

    return rows.unionByName(heads).repartition("cell", "salt").sortWithinPartitions("cell", "salt", "kind").mapInArrow(run, schema)


def split(part: pa.RecordBatch, table: np.ndarray) -> pa.RecordBatch:
    """The rows once for each of their nearest centers, as many as their budget has."""
    budget = part.column(4).to_numpy()
    near = ranked(matrix(part.column(5)), table, min(OVERLAP, len(table)))
    row, rank = np.nonzero(np.arange(near.shape[1])[None] < budget[:, None])
    own = part.column(0).to_pylist()
    names = [f"{own[i]}.{near[i, r]}" for i, r in zip(row.tolist(), rank.tolist(), strict=True)]
    take = pa.array(row)
    return pa.RecordBatch.from_arrays([pa.array(names, "string"), part.column(3).take(take), pa.array((budget[row] - rank).astype("i4")), part.column(5).take(take)], ["cell", "node", "budget", "unit"])


def cliques(copies: DataFrame, large: DataFrame, threshold: float) -> DataFrame:
    """(node, clique): classes within half the threshold's angle of their nearest leader, in large cells; those of a clique are all linked."""
    least = np.sqrt((1 + threshold) / 2) + 1e-9

    def near(part: pa.RecordBatch, table: np.ndarray) -> pa.RecordBatch:
        x = matrix(part.column(5))
        best = ranked(x, table, 1)[:, 0]
        keep = np.flatnonzero(np.einsum("nd,nd->n", x, table[best]) >= least)
        cell = part.column(0).to_pylist()
        return pa.RecordBatch.from_arrays([part.column(3).take(pa.array(keep)), pa.array([f"{cell[i]}/{best[i]}" for i in keep.tolist()], "string")], ["node", "clique"])

    return met(copies, large, leaders(copies, large, threshold), near, "node long, clique string")


def shards(nodes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(cell, node, unit) of all shards, and (node, clique)."""
    start = F.concat_ws("|", F.size("unit").cast("string"), F.col("label").cast("string"))
    copies = nodes.select(start.alias("cell"), "node", F.lit(OVERLAP).alias("budget"), "unit")
    placed, known = None, None
    for level in range(MOST_SPLITS + 1):
        large = materialize(copies.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > (CAPACITY if level < MOST_SPLITS else 1 << 62)), "large-cells")
        if not level:
            known = materialize(cliques(copies, large, threshold), "cliques")
        whole = copies.join(large.select("cell"), "cell", "left_anti").select("cell", "node", "unit")
        placed = whole if placed is None else placed.unionByName(whole)
        if large.isEmpty():
            return placed, known
        fitted = materialize(centers(copies, large), "centers")
        copies = materialize(met(copies, large, fitted, split, "cell string, node long, budget int, unit array<double>"), "split-cells")
    return placed, known


NEAR = "array<struct<node: bigint, cosine: double, leaves: array<bigint>, clique: string>>"


def widest(threshold: float) -> float:
    """The least cosine between two vectors that a third may be linked to."""
    return float(np.cos(min(np.pi, 2 * np.arccos(threshold)))) - 1e-9


def built(rows: DataFrame, threshold: float) -> DataFrame:
    """(node, near): its edges in all its shards with their cosines and, where a link may lead on along them, the shards and clique of the other end."""
    least = widest(threshold)

    def run(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
        found = found.combine_chunks().sort_by("node")
        x = matrix(found.column("unit").chunk(0))
        edges = vector_graph.build(x.astype("f4"))
        here = edges >= 0
        source, target = np.nonzero(here)[0], edges[here]
        cosine = np.einsum("nd,nd->n", x[source], x[target])
        on = pa.array(target, mask=cosine < least)
        parts = [found.column("node").chunk(0).take(pa.array(target)), pa.array(cosine), *(found.column(c).chunk(0).take(on) for c in ("leaves", "clique"))]
        entry = pa.StructArray.from_arrays(parts, ["node", "cosine", "leaves", "clique"])
        ends = np.concatenate([[0], np.cumsum(here.sum(1))]).astype("i4")
        return pa.table({"node": found.column("node"), "near": pa.ListArray.from_arrays(pa.array(ends), entry)})

    lists = rows.select("cell", "node", "unit", "leaves", "clique").groupBy("cell").applyInArrow(run, f"node long, near {NEAR}")
    return lists.groupBy("node").agg(F.flatten(F.collect_list("near")).alias("near"))


def searched(rows: DataFrame, threshold: float) -> DataFrame:
    """(a, b, n) for each shard's rows (cell, node, unit, n, clique, leaves, near).

    With b null: a has links to n vectors that are to be counted in this shard. With n null: a and b are in one group. With n -1: a
    and b may be linked, and share no shard; with n -2 they are linked, and an earlier shard should have counted that.
    """
    reach = np.arccos(threshold)

    def run(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
        return in_shard(found.combine_chunks().sort_by("node"), threshold, reach)

    return rows.groupBy("cell").applyInArrow(run, "a long, b long, n long")


def in_shard(found: pa.Table, threshold: float, reach: float) -> pa.Table:
    node, n = (found.column(c).to_numpy() for c in ("node", "n"))
    x = matrix(found.column("unit").chunk(0))
    near = found.column("near").chunk(0)
    size = np.diff(near.offsets.to_numpy())
    entries = near.flatten()
    source, other, cosine = np.repeat(np.arange(len(node)), size), entries.field("node").to_numpy(), entries.field("cosine").to_numpy()
    place = np.minimum(np.searchsorted(node, other), len(node) - 1)
    inside = node[place] == other
    start, end = np.divmod(np.unique(source[inside] * len(node) + place[inside]), len(node))  # an edge may be in the lists of several shards
    degree = np.bincount(start, minlength=len(node))
    edges = np.full((len(node), max(1, int(degree.max(initial=0)))), -1)
    edges[start, np.arange(len(start)) - np.repeat(np.cumsum(degree) - degree, degree)] = end
    group = grouped(x, edges, threshold)
    own_leaf = int(found.column("leaf")[0].as_py())
    leaves = found.column("leaves").to_pylist()
    clique = np.unique(np.array([c or "" for c in found.column("clique").to_pylist()]), return_inverse=True)
    no_clique = np.array([c == "" for c in clique[0]])[clique[1]]
    links, (outside, starts, later) = np.zeros(len(node), "i8"), ([np.zeros((2, 0), "i8")] for _ in range(3))
    beyond = np.flatnonzero(~inside & (cosine >= widest(threshold)))
    if len(beyond):
        far_leaves, far_clique = (entries.field(c).take(pa.array(beyond)).to_pylist() for c in ("leaves", "clique"))
        of = {i: np.flatnonzero(source[beyond] == i) for i in np.unique(source[beyond]).tolist()}
    for members in np.split(np.argsort(group, kind="stable"), np.cumsum(np.unique(group, return_counts=True)[1])[:-1]):
        if len(members) < 2:
            continue
        starts.append(np.stack([np.full(len(members) - 1, node[members[0]]), node[members[1:]]]))
        earlier = sorted({leaf for i in members.tolist() for leaf in leaves[i] if leaf < own_leaf})
        number = {leaf: k for k, leaf in enumerate(earlier)}
        held = np.zeros((len(members), len(earlier)), "f4")
        for row, i in enumerate(members.tolist()):
            held[row, [number[leaf] for leaf in leaves[i] if leaf < own_leaf]] = 1
        for a in range(0, len(members), 512):
            part = members[a : a + 512]
            cosines = x[part] @ x[members].T
            linked = cosines >= threshold
            linked[part[:, None] == members[None]] = False
            linked_apart = linked & ((clique[1][part][:, None] != clique[1][members][None]) | no_clique[part][:, None])
            first = held[a : a + 512] @ held.T == 0
            links[part] += (linked_apart & first) @ n[members]
            if len(members) <= SMALL:
                later.append(node[members[np.stack(np.nonzero(np.triu(linked_apart & ~first)))]])
            for column, i in enumerate(members.tolist()):
                for e in of.get(i, ()) if len(beyond) else ():
                    at = beyond[e]
                    asking = np.flatnonzero(linked[:, column] & (np.arccos(np.clip(cosine[at], -1, 1)) <= reach + np.arccos(np.clip(cosines[:, column], -1, 1))))
                    theirs = set(far_leaves[e])
                    ask = [j for j in part[asking].tolist() if theirs.isdisjoint(leaves[j]) and (no_clique[j] or clique[0][clique[1][j]] != far_clique[e])]
                    outside.append(np.stack([node[ask], np.full(len(ask), other[at])]))
    some = np.flatnonzero(links)
    pairs = np.unique(np.sort(np.concatenate(outside, 1), axis=0), axis=1)
    forest, missed = np.concatenate(starts, 1), np.concatenate(later, 1)
    blank = lambda k: pa.nulls(k, "int64")
    return pa.table({
        "a": pa.concat_arrays([pa.array(node[some]), pa.array(forest[0]), pa.array(pairs[0]), pa.array(missed[0])]),
        "b": pa.concat_arrays([blank(len(some)), pa.array(forest[1]), pa.array(pairs[1]), pa.array(missed[1])]),
        "n": pa.concat_arrays([pa.array(links[some]), blank(forest.shape[1]), pa.array(np.full(pairs.shape[1], -1)), pa.array(np.full(missed.shape[1], -2))]),
    })


def grouped(x: np.ndarray, edges: np.ndarray, threshold: float) -> np.ndarray:
    """The smallest row that each row reaches by links: those that searches find, widened until no neighbour of a group is linked to it."""
    parent = np.arange(len(x))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    def join(a: np.ndarray, b: np.ndarray) -> bool:
        changed = False
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            if (p := find(i)) != (q := find(j)):
                parent[max(p, q)] = min(p, q)
                changed = True
        return changed

    single, start = x.astype("f4"), vector_graph.medoid(x)
    for i in range(0, len(x), vector_graph.BLOCK):
        ids, _ = vector_graph.greedy(single, edges, start, single[i : i + vector_graph.BLOCK])
        cosines = np.einsum("qd,qrd->qr", x[i : i + len(ids)], x[ids])
        q, r = np.nonzero((ids >= 0) & (cosines >= threshold))
        join(q + i, ids[q, r])
    while True:
        roots = np.array([find(i) for i in range(len(x))])
        crowd = np.flatnonzero(np.bincount(roots, minlength=len(x)) > 1)
        widened = False
        for root in crowd.tolist():
            members = np.flatnonzero(roots == root)
            around = np.setdiff1d(edges[members][edges[members] >= 0], members)
            for a in range(0, len(members), 512):
                p, q = np.nonzero(x[members[a : a + 512]] @ x[around].T >= threshold)
                widened |= join(members[a + p], around[q])
        if not widened:
            return roots


def across(links: DataFrame, lists: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(a, b) that new links (a, b, cosine) between shards lead to: neighbours of one end that the other may be linked to and shares no shard with."""
    reach = float(np.arccos(threshold))
    both = links.select(F.col("a").alias("q"), F.col("b").alias("node"), "cosine").unionByName(links.select(F.col("b").alias("q"), F.col("a").alias("node"), "cosine"))
    asked = both.join(lists.select("node", "near"), "node").select("q", F.col("cosine").alias("c"), F.explode("near").alias("e")).filter(F.acos(F.least(F.lit(1.0), "e.cosine")) <= reach + F.acos(F.least(F.lit(1.0), "c")))
    own = nodes.select(F.col("node").alias("q"), "leaves", "clique")
    fresh = asked.join(own, "q").filter(F.col("q") != F.col("e.node")).filter(~F.arrays_overlap("leaves", "e.leaves") & ~F.coalesce(F.col("clique") == F.col("e.clique"), F.lit(False)))
    return fresh.select(F.least("q", "e.node").alias("a"), F.greatest("q", "e.node").alias("b")).distinct()


def verified(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(a, b, cosine, n_a, n_b) of the pairs (a, b) whose cosine is threshold at least."""
    one, other = (nodes.select(F.col("node").alias(s), F.col("unit").alias(f"unit_{s}"), F.col("n").alias(f"n_{s}")) for s in "ab")
    cosine = F.aggregate(F.zip_with("unit_a", "unit_b", lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    return pairs.join(one, "a").join(other, "b").withColumn("cosine", cosine).filter(F.col("cosine") >= threshold).select("a", "b", "cosine", "n_a", "n_b")


def near_vectors(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id, kept) for each row: other rows of the same label linked directly, and the group's smallest id."""
    if not 0 < threshold < 1:
        raise ValueError("the threshold must be between 0 and 1")
    made = materialize(directions(rows, id_column, vector, label), "directions")
    able = made.filter("key IS NOT NULL")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("first")
    classes = able.groupBy("label", "key").agg(F.count(F.lit(1)).alias("n"), first, F.any_value("unit").alias("unit"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    placed, known = shards(classes, threshold)
    placed = materialize(placed, "shards")
    leaf = F.xxhash64("cell")
    where = placed.groupBy("node").agg(F.sort_array(F.collect_set(leaf)).alias("leaves"))
    nodes = materialize(classes.select("node", "unit", "n").join(where, "node").join(known, "node", "left"), "graph-nodes")
    inside = placed.select("cell", leaf.alias("leaf"), "node").join(nodes, "node")
    lists = materialize(built(inside, threshold), "adjacency-lists")
    found = materialize(searched(inside.join(lists, "node"), threshold), "shard-links")
    pairs = found.filter("n = -1").select("a", "b").distinct()
    crossing = fresh = materialize(verified(pairs, nodes, threshold), "crossing-links")
    while not fresh.isEmpty():
        more = across(fresh, lists, nodes, threshold).join(crossing.select("a", "b"), ["a", "b"], "left_anti")
        fresh = materialize(verified(more, nodes, threshold), "new-crossing-links")
        crossing = crossing.unionByName(fresh)
    held = known.join(classes.select("node", "n"), "node")
    cliques_of = held.groupBy("clique").agg(F.sum("n").alias("total"), F.min("node").alias("head"))
    in_clique = held.join(cliques_of, "clique")
    ends = found.filter("n IS NULL").select("a", "b").unionByName(crossing.select("a", "b")).unionByName(in_clique.filter("node != head").select(F.col("head").alias("a"), F.col("node").alias("b")))
    roots = components(ends)
    counts = found.filter("b IS NULL").select(F.col("a").alias("node"), F.col("n").alias("links"))
    counts = counts.unionByName(crossing.select(F.col("a").alias("node"), F.col("n_b").alias("links"))).unionByName(crossing.select(F.col("b").alias("node"), F.col("n_a").alias("links")))
    counts = materialize(counts.unionByName(in_clique.select("node", (F.col("total") - F.col("n")).alias("links"))).groupBy("node").agg(F.sum("links").alias("links")), "link-counts")
    missed = found.filter("n = -2").select("a", "b").distinct()
    for end in "ab":
        known_end = counts.select(F.col("node").alias(end), F.col("links").alias(f"links_{end}"))
        missed = missed.join(known_end, end, "left").join(nodes.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}")), end)
    missed = materialize(missed.filter("links_a IS NULL OR links_b IS NULL"), "missed-links")
    for end, other in ("ab", "ba"):
        counts = counts.unionByName(missed.select(F.col(end).alias("node"), F.col(f"n_{other}").alias("links")))
    counts = counts.groupBy("node").agg(F.sum("links").alias("links"))
    whole = classes.select("label", "key", "node", "n", "first").join(roots.withColumnRenamed("fp", "node"), "node", "left").join(counts, "node", "left")
    whole = whole.withColumn("root", F.coalesce("root", "node"))
    named = whole.groupBy("root").agg(F.min("first").alias("best"))
    whole = whole.join(named, "root").select("label", "key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.col("best.id").alias("component_id"))
    linked = able.select("id", "label", "key").join(whole, ["label", "key"]).select("id", "n_links", "component_id")
    alone = made.filter("key IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(id_column), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def audit_recall(rows: DataFrame, found: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD, queries: int = AUDITED) -> DataFrame:
    """(queries, true_links, found_links, recall): n_links of found against brute force, for the rows of the smallest hashes of their ids.

    The queries are held against all rows in blocks, and only counts are shuffled.
    """
    made = directions(rows, id_column, vector, label).filter("key IS NOT NULL")
    chosen = made.orderBy(F.xxhash64("id"), "id", "key").limit(queries).select("id", F.col("label").cast("string").alias("label"), "unit").collect()
    by: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
    for key in {(r["label"], len(r["unit"])) for r in chosen}:
        own = [i for i, r in enumerate(chosen) if (r["label"], len(r["unit"])) == key]
        by[key] = np.array(own), np.array([chosen[i]["unit"] for i in own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(chosen), "i8")
        for batch in batches:
            labels, units = (batch.column(c).to_pylist() for c in (0, 1))
            for key, (own, x) in by.items():
                y = np.array([u for k, u in zip(labels, units, strict=True) if (k, len(u)) == key])
                if len(y):
                    total[own] += (x @ y.T >= threshold).sum(1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(chosen))), pa.array(total)], ["i", "n"])

    spark = rows.sparkSession
    true = made.select(F.col("label").cast("string"), "unit").mapInArrow(run, "i long, n long").groupBy("i").agg((F.sum("n") - 1).alias("true"))
    ids = spark.createDataFrame([(i, r["id"]) for i, r in enumerate(chosen)], f"i long, id {rows.schema[id_column].dataType.simpleString()}")
    got = ids.join(true, "i").join(found.select(F.col(id_column).alias("id"), "n_links"), "id")
    counts = got.agg(F.count(F.lit(1)).alias("queries"), F.sum("true").alias("true_links"), F.sum(F.least("true", "n_links")).alias("found_links"))
    return counts.withColumn("recall", F.when(F.col("true_links") > 0, F.col("found_links") / F.col("true_links")).otherwise(1.0))
