"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints within RADIUS = 3 bits differ by at most one bit in one of their two 32-bit halves. So every distinct
fingerprint emits, for each half, the variants of that half within radius 1 (half the radius); those of even parity are
enough, because two halves one bit apart differ in parity and two equal ones share it: an even half emits itself, an odd
one its 32 neighbours. Fingerprints meet by a shuffle on (half, variant); colliding pairs are verified on all 64 bits, and
a bucket hands on a spanning forest of its links, never its pairs. Buckets beyond BUCKET fingerprints are first dealt out
again by the four bytes of the other half, one of which is equal in any linked pair whose other half is within 3 bits.
Components then contract by min-label rounds over the forest's edges, each written to the shared folder.

Full-word balls of radius 2 would emit 2,081 variants of each fingerprint (1,041 with the parity rule); halves emit 33 on
average and find the same links.

Defined results: null text is empty text; a text without words has fingerprint zero and links like any other; equal rows
share a fingerprint and so a component; rows with a null doc_id are fingerprinted and their component is named by its
smallest non-null doc_id (null if there is none); an empty table gives no rows; further columns are ignored here and stay
in ``near_deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.llm.common import KeyFilter, discard, filter_bits, materialize, numbered, release, small_batches, text_or_empty, without

RADIUS, SHINGLE, SEED = 3, 3, 42
#: Larger buckets are dealt out again; comparisons of a bucket run in blocks of this many rows.
BUCKET, BLOCK = 4096, 1024


def fingerprint(text: str) -> int:
    """SimHash of the text's word shingles: a bit is set if it is in over half of the shingles' XXH64 values."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxh64_intdigest(joined, SEED)
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[: -SHINGLE])]
    hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :], strict=True)], "<u8")
    total = np.zeros(64, "i8")
    for i in range(0, len(hashes), 1 << 16):
        total += np.unpackbits(hashes[i : i + (1 << 16)].view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="i8")
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) for each row; fp is the fingerprint as a signed 64-bit number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], "u8").view("i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


def emit_variants(fps: DataFrame) -> DataFrame:
    """(half, variant, fp): the even variants of both halves of each fingerprint."""
    low, high = F.col("fp").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("fp", 32)
    halves = fps.select("fp", F.explode(F.array(F.struct(F.lit(0).alias("half"), low.alias("value")), F.struct(F.lit(1).alias("half"), high.alias("value")))).alias("h")).select("fp", "h.half", "h.value")
    flips = F.array(*(F.lit(1 << i) for i in range(32)))
    variants = F.when(F.bit_count("value") % 2 == 0, F.array("value")).otherwise(F.transform(flips, lambda b: F.col("value").bitwiseXOR(b)))
    return halves.select("half", F.explode(variants).alias("variant"), "fp")


def forest(values: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Edges that connect the distinct values linked directly or through others, one for each value but the first of a group."""
    values = np.unique(values.view("u8"))
    parent = np.arange(len(values))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for a in range(0, len(values), BLOCK):
        for b in range(a, len(values), BLOCK):
            x, y = np.nonzero(np.bitwise_count(values[a : a + BLOCK, None] ^ values[None, b : b + BLOCK]) <= radius)
            for i, j in zip((x + a).tolist(), (y + b).tolist(), strict=True):
                if i < j and (p := find(i)) != (q := find(j)):
                    parent[max(p, q)] = min(p, q)
    signed = values.view("i8")
    return [(int(signed[find(i)]), int(signed[i])) for i in range(len(values)) if parent[i] != i]


def _links(emitted: DataFrame, *keys: str) -> DataFrame:
    """(a, b): a spanning forest of the verified links of each bucket of keys. Rows come sorted, so that buckets are runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_key, rest = None, np.zeros(0, "i8")  # the last bucket of a batch may go on in the next
        for batch in batches:
            key, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(key):
                continue
            if rest_key is not None:
                key, fp = np.concatenate([np.full(len(rest), rest_key), key]), np.concatenate([rest, fp])
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1])
            sizes = np.diff(np.append(cuts, len(key)))
            edges = [e for i in np.flatnonzero(sizes[:-1] > 1) for e in forest(fp[cuts[i] : cuts[i] + sizes[i]])]
            rest_key, rest = key[-1], fp[cuts[-1] :].copy()
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], "int64") for k in (0, 1)], ["a", "b"])
        edges = forest(rest) if len(rest) > 1 else []
        yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], "int64") for k in (0, 1)], ["a", "b"])

    bucket = F.xxhash64(*keys)  # a chance clash of two buckets only means more pairs to verify
    rows = emitted.select(bucket.alias("bucket"), "fp").repartition("bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(run, "a long, b long")


def links(fps: DataFrame) -> DataFrame:
    """(a, b) between distinct fingerprints within RADIUS bits: enough of them to connect every component."""
    emitted = emit_variants(fps)
    crowded = materialize(emitted.groupBy("half", "variant").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BUCKET).select("half", "variant"), "crowded-buckets")
    if crowded.isEmpty():
        return _links(emitted, "half", "variant").distinct()
    other = F.when(F.col("half") == 0, F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp").bitwiseAND(0xFFFFFFFF))
    parts = emitted.join(crowded, ["half", "variant"], "left_semi").withColumn("part", F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.shiftright(other, 8 * i).bitwiseAND(255).alias("byte")) for i in range(4)))))
    return _links(emitted.join(crowded, ["half", "variant"], "left_anti"), "half", "variant").union(_links(parts, "half", "variant", "part.i", "part.byte")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(fp, root) for each end of an edge: root is the smallest fingerprint that it reaches.

    Rounds of large-star and small-star: every node links its larger neighbours, then its smaller ones, to the smallest it
    knows. Neighbours' minima are partial aggregates; only edges move.
    """
    edges = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).filter("u != v")
        after = materialize(small.distinct(), "small-star")
        if after.exceptAll(edges).isEmpty() and edges.exceptAll(after).isEmpty():
            return after.select(F.col("u").alias("fp"), F.col("v").alias("root"))
        discard(edges, large)
        edges = after


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs."""
    rows = materialize(fingerprints(docs), "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp")))
    known = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = known.join(known.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# Near copies by similarity, for pipelines.

#: Words of a shingle, least similarity, and BANDS fingerprints of BITS bits of which one must be nearly equal.
NEAR_SHINGLE, SIMILARITY, BANDS, BITS = 5, 0.8, 12, 24
#: A sketch has WORDS words of 64 bits: those of the bands and one more. Two words of a pair may differ in CHECK_RADIUS bits, two
#: sketches in SKETCH_RADIUS; at a similarity of 0.8, at most 9.7 and 58 are expected, with deviations of 2.9 and 7.0.
WORDS = -(-BANDS * BITS // 64) + 1
CHECK_RADIUS, SKETCH_RADIUS = 20, 96
#: Members of one band value that emit its variants, where more than HEAVY share it, and members that are compared at once.
PIVOTS, HEAVY, SHARE = 64, 128, 2048
#: Buckets up to this size are compared in arrays over all buckets; cells of crowded ones are in blocks of MEET, all of whose pairs may go on at once.
SMALL, MEET = 8, 512
#: Bytes of the texts of a family's block (short texts count as LEAST_BYTES), of which two are compared in one task, and shingles that are counted at once.
BLOCK_BYTES, LEAST_BYTES, COLUMNS = 1 << 20, 1 << 10, 8192
#: Hashes of words, and of shingles of texts, that a worker keeps.
KNOWN, KNOWN_SHINGLES = 200_000, 1_000_000


def shingles(text: str, known: dict[bytes, int]) -> np.ndarray:
    """64-bit hashes of the text's distinct and repeated shingles of NEAR_SHINGLE words; all words together if there are fewer."""
    from xxhash import xxh3_64_intdigest

    found = text.encode("utf-8", "surrogatepass").lower().split()
    if len(known) > KNOWN:
        known.clear()
    for word in set(found).difference(known):
        known[word] = xxh3_64_intdigest(word)
    h = np.fromiter(map(known.__getitem__, found), "u8", len(found))
    size = min(NEAR_SHINGLE, len(h))
    out = np.full(max(len(h) - size + 1, 0) if size else 0, len(h) if size < NEAR_SHINGLE else 0, "u8")
    for k in range(size):
        out = mixed_bits(out * np.uint64(31) + h[k : len(h) - size + 1 + k])
    return out


def mixed_bits(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


#: Bit i of a byte, in byte i of a number.
SPREAD = np.unpackbits(np.arange(256, dtype="u1")[:, None], axis=1, bitorder="little").view("<u8")[:, 0]


def sketch(hashes: np.ndarray) -> np.ndarray:
    """WORDS * 64 bits: one is set if it is in over half of the values derived from the shingles' hashes."""
    seeds = (np.arange(1, WORDS + 1, dtype="u8")) * np.uint64(0x9E3779B97F4A7C15)
    total = np.zeros(64 * WORDS, "i8")
    for begin in range(0, len(hashes), 255 * 64):
        part = mixed_bits(hashes[begin : begin + 255 * 64, None] + seeds)
        data = np.zeros((-(-len(part) // 255) * 255, 8 * WORDS), "u1")
        data[: len(part)] = part.astype("<u8").view("u1").reshape(len(part), -1)
        sums = SPREAD[data].reshape(-1, 255, 8 * WORDS).sum(1)  # no byte of the sums can overflow
        total += sums.astype("<u8").view("u1").reshape(len(sums), -1).sum(0, dtype="i8")
    return np.packbits(2 * total > len(hashes), bitorder="little")


def sketches(rows: DataFrame, row: str) -> DataFrame:
    """(row, doc_id, set_key, bands, words) for each row; set_key is a digest of the text's set of shingles, of which the sketch is made."""
    from hashlib import blake2b

    size = BANDS * BITS // 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            keys, made = [], []
            for text in batch.column(2).to_pylist():
                hashes = np.unique(shingles(text, known))
                keys.append(blake2b(hashes.tobytes(), digest_size=16).digest())
                made.append(sketch(hashes))
            data = np.array(made, "u1").reshape(len(made), 8 * WORDS)
            bands = np.zeros((len(made), BANDS, 4), "u1")
            bands[:, :, : BITS // 8] = data[:, :size].reshape(len(made), BANDS, BITS // 8)
            lists = pa.ListArray.from_arrays(np.arange(0, BANDS * len(made) + 1, BANDS, dtype="i4"), bands.view("<i4").ravel())
            words = pa.ListArray.from_arrays(np.arange(0, WORDS * len(made) + 1, WORDS, dtype="i4"), data.view("<i8").ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, "binary"), lists, words], ["row", "doc_id", "set_key", "bands", "words"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select(row, "doc_id", text_or_empty().alias("text")).mapInArrow(run, f"row long, doc_id {kind}, set_key binary, bands array<int>, words array<long>")


def _banded(nodes: DataFrame, *also: str) -> DataFrame:
    """(node, *also, band, value, check) for each band of each node; each band checks by a word of the sketch that has none of its
    own bits, so that an unlucky word is one band's alone."""
    word = F.get("words", (F.floor(F.col("band") * BITS / 64) + 2).cast("int") % WORDS)
    return nodes.select("node", *dict.fromkeys((*also, "words")), F.posexplode("bands").alias("band", "value")).select("node", *also, "band", "value", word.alias("check"))


def _one_bit_off(name: str) -> Column:
    return F.transform(F.array(*(F.lit(1 << i) for i in range(BITS))), lambda b: F.col(name).bitwiseXOR(b))


def _even_variants() -> Column:
    return F.when(F.bit_count("value") % 2 == 0, F.array("value")).otherwise(_one_bit_off("value"))


def _first() -> Column:
    """Whether variant is the first of the value's."""
    return (F.col("variant") == F.col("value")) | (F.col("variant") == F.col("value").bitwiseXOR(F.lit(1)))


def _bucketed(base: DataFrame, heavy: DataFrame) -> DataFrame:
    """(bucket, node, check): band values meet in the buckets of their even variants within one bit, so that all within one bit do.

    Of a heavy value, PIVOTS nodes (by a hash of their shingles) emit its variants, and the others meet these and one
    another in shares of about SHARE; ``joined_families`` compares whom that leaves out. first tells one bucket of each node and band.
    """
    marked = base.join(heavy, ["band", "value"], "left") if not heavy.isEmpty() else base.withColumn("n", F.lit(None).cast("long"))
    pivot = F.pmod(F.xxhash64("set_key", "band"), F.ceil(F.col("n") / PIVOTS)) == 0
    light = marked.filter(F.col("n").isNull() | pivot).select("band", F.explode(_even_variants()).alias("variant"), "value", "node", "check").select(F.xxhash64("band", "variant").alias("bucket"), "node", "check", _first().alias("first"))
    shares = F.ceil(F.col("n") / SHARE)
    share = F.when(pivot, F.sequence(F.lit(0).cast("long"), shares - 1)).otherwise(F.array(F.pmod(F.xxhash64("band", "set_key"), shares)))
    crowd = marked.filter(F.col("n").isNotNull()).select("band", "value", F.explode(share).alias("share"), "node", "check").select(F.xxhash64("band", "value", "share").alias("bucket"), "node", "check", F.lit(True).alias("first"))
    return light.union(crowd)


def _whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of whole buckets; rows come sorted by the first column, and the last bucket of a batch may go on in the next."""
    rest = None
    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        new = new if rest is None else [np.concatenate([old, c]) for old, c in zip(rest, new, strict=True)]
        if not len(new[0]):
            continue
        whole = int(np.searchsorted(new[0], new[0][-1]))
        if whole:
            yield [c[:whole] for c in new]
        rest = [c[whole:].copy() for c in new]
    if rest is not None:
        yield rest


def candidates(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, b, bits): nodes of one bucket whose check words and sketches are near, and in how many bits these differ; and the
    crowded buckets (bucket, band, variant).

    Of a large bucket all pairs go on if they are no more than its nodes. Else go on those of the minimum
    spanning forest by check words of the nodes that have their first bucket here, so that a pair that fails to be similar
    stands in for a similar one only where its word is the nearer one by chance; each band has another word and another forest.
    These connect most of a group cheaply. Crowded are the buckets of which pairs are left out: such large ones, and those of
    values that more than HEAVY nodes share.
    """
    most = SMALL

    def few(check: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        found, n = [], 0
        for begin in range(0, len(check), 64):
            x, y = np.nonzero(np.triu(np.bitwise_count(check[begin : begin + 64, None] ^ check[None, begin:]) <= CHECK_RADIUS, 1))
            found.append((x + begin, y + begin))
            n += len(x)
            if n > len(check):
                return None
        x, y = zip(*found, strict=True)
        return np.concatenate(x), np.concatenate(y)

    def pairs(key: np.ndarray, node: np.ndarray, check: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both nodes of each pair, and the places of one node of each crowded bucket."""
        check = check.view("u8")  # of signed numbers, the bits of the absolute value would be counted
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
        sizes = np.diff(cuts)
        small = np.repeat(sizes <= most, sizes)
        a, b = [np.zeros(0, "i8")], [np.zeros(0, "i8")]
        for k in range(1, most):
            near = np.flatnonzero((key[k:] == key[:-k]) & small[k:])
            near = near[np.bitwise_count(check[near] ^ check[near + k]) <= CHECK_RADIUS]
            a.append(node[near])
            b.append(node[near + k])
        crowded = []
        for i in np.flatnonzero(sizes > most):
            own = np.arange(cuts[i], cuts[i + 1])
            if (near := few(check[own])) is None:
                crowded.append(cuts[i])
                own = own[first[own]]
                near = _forest(check[own])
            a.append(node[own[near[0]]])
            b.append(node[own[near[1]]])
        return np.concatenate(a), np.concatenate(b), np.array(crowded, "i8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, node, *rest in _whole_buckets(batches):
            a, b, crowded = pairs(key, node, *rest)
            columns = [pa.array(np.concatenate([a, key[crowded]])), pa.array(np.concatenate([b, node[crowded]])), pa.array(np.arange(len(a) + len(crowded)) >= len(a))]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "crowded"])

    base = _banded(nodes, "set_key")
    heavy = materialize(base.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HEAVY), "heavy-bands")
    # Sorted by check words as well, so that a forest does not hang on the order in which rows arrive.
    found = _bucketed(base, heavy).repartition("bucket").sortWithinPartitions("bucket", "check", "node").mapInArrow(run, "a long, b long, crowded boolean")
    found = materialize(found, "bucket-pairs")
    edges = materialize(near_sketches(found.filter("NOT crowded AND a != b"), nodes), "candidates")
    of_heavy = heavy.select("band", F.explode(_even_variants()).alias("variant")).select(F.xxhash64("band", "variant").alias("bucket"), "band", "variant")
    # A crowded bucket comes with one of its nodes, which tells its band and variant. Shares have none: their values are heavy ones.
    large = found.filter("crowded").select(F.col("a").alias("bucket"), F.col("b").alias("node")).join(nodes.select("node", "bands"), "node")
    large = large.select("bucket", F.posexplode("bands").alias("band", "value")).select("bucket", "band", F.explode(_even_variants()).alias("variant"))
    crowded = materialize(large.filter(F.xxhash64("band", "variant") == F.col("bucket")).union(of_heavy).distinct(), "crowded-bands")
    discard(found, heavy)
    return edges, crowded


def near_sketches(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b, bits): the distinct pairs (a, b) whose sketches are near, a < b, and in how many bits these differ."""
    pairs_found = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    one, other = (nodes.select(F.col("node").alias(x), F.col("words").alias(f"words_{x}")) for x in "ab")
    bits = sum((F.bit_count(F.get("words_a", F.lit(i)).bitwiseXOR(F.get("words_b", F.lit(i)))) for i in range(WORDS)), F.lit(0))
    return pairs_found.join(one, "a").join(other, "b").select("a", "b", bits.alias("bits")).filter(F.col("bits") <= SKETCH_RADIUS)


def rest_of_crowded(nodes: DataFrame, roots: DataFrame, crowded: DataFrame, edges: DataFrame) -> DataFrame:
    """(a, b, bits): all pairs of crowded buckets whose check words and sketches are near, but for those among edges and those that roots join.

    These are up to all pairs of a group. ``joined_families`` compares them in place, so this is for tests and small tables.
    Nodes of one band value and one root stand as one cell: pairs within it are joined already, so that a group of copies emits
    its distinct values and not its members. Cells of different roots that meet in a bucket are opened into their members.
    Two cells of one value meet in the first of its buckets only.
    """
    block = MEET

    def pairs(key: np.ndarray, root: np.ndarray, value: np.ndarray, first: np.ndarray, n: np.ndarray, band: np.ndarray, node: np.ndarray, check: np.ndarray) -> Iterator[pa.RecordBatch]:
        check, cuts = check.view("u8"), np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1])
        ends = np.append(cuts[1:], len(key))
        for i in np.flatnonzero(np.minimum.reduceat(root, cuts) != np.maximum.reduceat(root, cuts)):
            for s in range(cuts[i], ends[i], block):
                for t in range(s, ends[i], block):
                    u, v = slice(s, min(s + block, ends[i])), slice(t, min(t + block, ends[i]))
                    one = (n[u, None] == 1) & (n[None, v] == 1)
                    meet = (root[u, None] != root[None, v]) & ((value[u, None] != value[None, v]) | first[u, None])
                    meet &= ~one | (np.bitwise_count(check[u, None] ^ check[None, v]) <= CHECK_RADIUS)
                    x, y = np.nonzero(np.triu(meet, 1) if s == t else meet)
                    if len(x):
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (band[s + x], node[s + x], node[t + y], one[x, y])], ["band", "a", "b", "single"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _whole_buckets(batches):
            yield from pairs(*columns)

    own = nodes.join(roots.select(F.col("fp").alias("node"), "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    members = materialize(_banded(own, "root"), "band-members")
    cell = ["band", "value", "root"]
    cells = materialize(members.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("cell"), F.min("check").alias("check")), "band-cells")
    emitted = cells.withColumn("variant", F.explode(_even_variants())).select(F.xxhash64("band", "variant").alias("bucket"), "root", "value", _first().alias("first"), "n", "band", "cell", "check")
    emitted = KeyFilter(crowded, F.col("bucket")).maybe_in(emitted, F.col("bucket"))
    met = emitted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "band int, a long, b long, single boolean")
    met = materialize(met, "cell-pairs")
    opened = members.join(cells.select(*cell, "cell"), cell).select("band", "cell", "node", "check")
    one, other = (opened.select("band", F.col("cell").alias(x), F.col("node").alias(f"node_{x}"), F.col("check").alias(f"check_{x}")) for x in "ab")
    both = met.filter("NOT single").select("band", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(one, ["band", "a"]).join(other, ["band", "b"])
    both = both.filter(F.bit_count(F.col("check_a").bitwiseXOR(F.col("check_b"))) <= CHECK_RADIUS).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    near = near_sketches(met.filter("single").select("a", "b").union(both), nodes)
    found = materialize(near.join(edges, ["a", "b"], "left_anti"), "rest-candidates")
    discard(members, cells, met)
    return found


def _connect(label: np.ndarray, u: np.ndarray, v: np.ndarray, near: np.ndarray) -> list[tuple[int, int]]:
    """Of the pairs of places (u[i], v[j]) for which near[i, j], as few as join all labels that these join; the smaller label stays."""
    edges = []
    while True:
        near &= label[u, None] != label[None, v]
        rows = np.flatnonzero(near.any(1))
        if not len(rows):
            return edges
        for i, j in zip(u[rows].tolist(), v[near[rows].argmax(1)].tolist(), strict=True):
            if (p := label[i]) != (q := label[j]):
                edges.append((i, j))
                label[label == max(p, q)] = min(p, q)


def families(own: DataFrame, crowded: DataFrame) -> DataFrame:
    """(root, family): the roots of own (node, root, bands, words) that may have near members in a crowded bucket, and all that they reach so.

    Nodes with one band value and one root stand as one cell, made before it meets its buckets, so that a group joined already
    emits its distinct values and not its members; values near no crowded bucket are left out before. The bits that all of a
    cell's sketches have, and those that none has, bound from below in how many bits its members differ from another cell's. A
    bucket hands on a spanning forest of the cells that may be near, never its pairs.
    """
    names = [f"{kind}{i}" for kind in ("all", "any") for i in range(WORDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, root, *bits in _whole_buckets(batches):
            every, none = (np.stack(x, 1).view("u8") for x in (bits[:WORDS], [~x for x in bits[WORDS:]]))
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
            label, edges = root.copy(), []
            for i in np.flatnonzero(np.minimum.reduceat(root, cuts[:-1]) != np.maximum.reduceat(root, cuts[:-1])):
                begin, end = cuts[i], cuts[i + 1]
                own, apart = label[begin:end], np.arange(end - begin)
                for s in range(0, len(own), MEET):
                    for t in range(s, len(own), MEET):
                        u, v = apart[s : s + MEET], apart[t : t + MEET]
                        if own[u].min() == own[v].max() and own[v].min() == own[u].max():
                            continue
                        differ = np.zeros((len(u), len(v)), "u2")
                        for w in range(WORDS):
                            all_u, none_u, all_v, none_v = (x[begin:end][at, w] for at in (u, v) for x in (every, none))
                            differ += np.bitwise_count(all_u[:, None] & none_v | none_u[:, None] & all_v)
                        edges += [(begin + a, begin + b) for a, b in _connect(own, u, v, differ <= SKETCH_RADIUS)]
            a, b = np.array(edges, "i8").reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(root[a]), pa.array(root[b])], ["a", "b"])

    value = F.xxhash64("band", "value")
    reached = crowded.select("band", F.explode(F.concat(F.array("variant"), _one_bit_off("variant"))).alias("value"))
    members = KeyFilter(reached, value, bits=filter_bits((BITS + 1) * crowded.count())).maybe_in(_banded(own, "root", "words"), value)
    sums = [f(F.get("words", F.lit(i))).alias(f"{kind}{i}") for kind, f in (("all", F.bit_and), ("any", F.bit_or)) for i in range(WORDS)]
    cells = members.groupBy("band", "value", "root").agg(*sums).withColumn("variant", F.explode(_even_variants()))
    emitted = cells.select(F.xxhash64("band", "variant").alias("bucket"), "root", *names)
    emitted = KeyFilter(crowded, F.col("bucket")).maybe_in(emitted, F.col("bucket"))
    met = emitted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "a long, b long")
    joined = components(met)
    return materialize(joined.select(F.col("fp").alias("root"), F.col("root").alias("family")).union(joined.select("root", "root")).distinct(), "families")


def similar_in_blocks(members: DataFrame, similarity: float) -> DataFrame:
    """(a, b): roots of different members (family, block, node, root, text) of a family whose sets of shingles have at least this
    Jaccard similarity. All pairs of different roots are compared, those of two blocks in one task; enough links to connect them go on."""
    columns_at_once, piece = COLUMNS, MEET

    def held(codes: list[np.ndarray], there: np.ndarray) -> np.ndarray:
        """Which set has which of the shingles there."""
        code, row = np.concatenate(codes), np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        at = np.minimum(np.searchsorted(there, code), len(there) - 1)
        known, out = there[at] == code, np.zeros((len(codes), len(there)), "f4")
        out[row[known], at[known]] = 1
        return out

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        known: dict[bytes, int] = {}
        root = rows.column("root").to_numpy()
        block = rows.column("block").to_numpy()
        sets = [np.unique(shingles(t, known)) for part in rows.column("text").chunks for t in part.to_pylist()]
        size, label, edges = np.fromiter(map(len, sets), "i8", len(sets)), root.copy(), []
        one, other = (np.flatnonzero(block == key[k].as_py()) for k in (1, 2))
        same = key[1].as_py() == key[2].as_py()
        for s in range(0, len(one), piece):
            for t in range(s if same else 0, len(other), piece):
                u, v = one[s : s + piece], other[t : t + piece]
                least, most = (np.minimum, np.maximum)
                fits = least(size[u, None], size[None, v]) >= similarity * most(size[u, None], size[None, v]) * (1 - 1e-9)
                fits &= label[u, None] != label[None, v]
                u, v = u[fits.any(1)], v[fits.any(0)]
                if not len(u):
                    continue
                mine, theirs = [sets[i] for i in u], [sets[i] for i in v]
                shared = np.intersect1d(np.concatenate(mine), np.concatenate(theirs))
                both = np.zeros((len(u), len(v)))
                for begin in range(0, len(shared), columns_at_once):
                    there = shared[begin : begin + columns_at_once]
                    both += held(mine, there) @ held(theirs, there).T
                edges += _connect(label, u, v, both / np.maximum(1, size[u, None] + size[None, v] - both) >= similarity)
        a, b = np.array(edges, "i8").reshape(-1, 2).T
        return pa.table({"a": root[a], "b": root[b]})

    blocks = members.groupBy("family", "block").agg(F.min("root").alias("least"), F.max("root").alias("most"))
    one, other = (blocks.select("family", F.col("block").alias(x), F.col("least").alias(f"least_{x}"), F.col("most").alias(f"most_{x}")) for x in ("one", "other"))
    met = one.join(other, "family").filter("one <= other AND (least_one != most_one OR least_other != most_other OR least_one != least_other)")
    met = met.select("family", "one", "other", F.explode(F.array_distinct(F.array("one", "other"))).alias("block"))
    return members.join(met, ["family", "block"]).select("family", "one", "other", "block", "root", "text").groupBy("family", "one", "other").applyInArrow(run, "a long, b long")


def joined_families(nodes: DataFrame, roots: DataFrame, crowded: DataFrame, rows: DataFrame, row: str, similarity: float) -> DataFrame:
    """(fp, root) as roots, on top of which all similar pairs of the families of crowded buckets are joined.

    The texts of a family are dealt into blocks of bounded size, and each two of its blocks are compared in one task; large roots
    have blocks of their own, so that what is joined already is not compared again.
    """
    own = nodes.join(roots.select(F.col("fp").alias("node"), "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    own = materialize(own.select("node", "root", "bands", "words"), "rooted-nodes")
    family = families(own, crowded)
    if family.isEmpty():
        discard(own, family)
        return roots
    members = materialize(own.select("node", "root").join(family, "root").select("node", "root", "family"), "family-nodes")
    texts = KeyFilter(members, F.col("node")).maybe_in(rows.select(F.col(row).alias("node"), text_or_empty().alias("text")), F.col("node")).join(members, "node")
    texts = materialize(texts.select("family", "root", "node", "text"), "family-texts", compression="zstd")
    sizes = texts.groupBy("family", "root").agg(F.sum(F.greatest(F.octet_length("text"), F.lit(LEAST_BYTES))).alias("bytes"))
    sizes = materialize(sizes.withColumn("home", F.when(F.col("bytes") >= BLOCK_BYTES, F.col("root")).otherwise(-1)), "family-sizes")
    dealt = sizes.groupBy("family", "home").agg(F.ceil(F.sum("bytes") / BLOCK_BYTES).alias("blocks"))
    homes = materialize(sizes.join(dealt, ["family", "home"]).select("root", "home", "blocks"), "family-homes")
    block = F.xxhash64("home", F.pmod(F.xxhash64("node"), "blocks"))
    found = similar_in_blocks(texts.join(homes, "root").select("family", block.alias("block"), "node", "root", "text"), similarity)
    more = components(found).select(F.col("fp").alias("root"), F.col("root").alias("_root"))
    joined = materialize(own.select("node", "root").join(more, "root", "left").select(F.col("node").alias("fp"), F.coalesce("_root", "root").alias("root")), "joined-roots")
    discard(own, family, members, texts, sizes, homes)
    return joined


def _forest(check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of a minimum spanning forest of the check words, by differing bits, of at most CHECK_RADIUS.

    The tree grows by the nearest word outside of it; a bucket's size is bounded, and one row of its distances is held at a time.
    """
    nearest, via = np.full(len(check), 255, "u1"), np.zeros(len(check), "i8")
    outside, at, edges = np.ones(len(check), bool), 0, []
    for _ in range(len(check) - 1):
        outside[at] = False
        bits = np.bitwise_count(check ^ check[at])
        closer = outside & (bits < nearest)
        nearest[closer], via[closer] = bits[closer], at
        nearest[at] = 255
        at = int(np.argmin(nearest))
        if nearest[at] <= CHECK_RADIUS:
            edges.append((via[at], at))
    x, y = np.array(edges, "i8").reshape(-1, 2).T
    return x, y


def similar(pairs: DataFrame, similarity: float) -> DataFrame:
    """(a, b) of pairs (a, b, text_a, text_b) whose sets of shingles have at least this Jaccard similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        sets: dict[int, np.ndarray] = {}
        held = 0

        def set_of(node: int, text: str) -> np.ndarray:
            nonlocal held
            if node not in sets:
                if held > KNOWN_SHINGLES:
                    sets.clear()
                    held = 0
                sets[node] = np.unique(shingles(text, known))
                held += len(sets[node])
            return sets[node]

        for batch in batches:
            keep = []
            for i, (a, b, x, y) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True)):
                one, other = set_of(a, x), set_of(b, y)
                merged = np.sort(np.concatenate([one, other]))
                both = int(np.count_nonzero(merged[1:] == merged[:-1]))
                if both / max(1, len(merged) - both) >= similarity:
                    keep.append(i)
            rows = pa.array(keep, "int64")
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], ["a", "b"])

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def verified_roots(edges: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(fp, root) for each node that similar pairs among edges (a, b, bits; a < b) connect to others, as of ``components``.

    A large group has far more candidates than members. So every node first asks for its nearest one, then, of those that do
    not join what is joined already, for four times as many in each round. texts: node, text.
    """
    one, other = (texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
    remaining, most, roots = edges, 1, None
    while True:
        ranked = remaining.withColumn("_n", F.row_number().over(Window.partitionBy("b").orderBy("bits", "a")))
        asked = materialize(ranked.filter(F.col("_n") <= most).select("a", "b"), "asked-pairs")
        if asked.isEmpty() and roots is not None:
            return roots
        links_found = similar(asked.join(one, "a").join(other, "b"), similarity)
        before, roots = roots, components(links_found if roots is None else links_found.union(roots.select("fp", "root")))
        roots = materialize(roots, "near-roots")
        rest = ranked.filter(F.col("_n") > most).select("a", "b", "bits")
        for x in "ab":
            rest = rest.join(roots.select(F.col("fp").alias(x), F.col("root").alias(f"_{x}")), x, "left")
        rest = rest.filter(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b", "bits")
        after = materialize(rest, "remaining-pairs")
        discard(asked, *([before] if before else []), *([remaining] if remaining is not edges else []))
        remaining, most = after, 4 * most
        del before, rest, ranked, links_found, after
        release(texts.sparkSession)


def _verified(edges: DataFrame, rows: DataFrame, row: str, similarity: float) -> DataFrame:
    """``verified_roots`` of edges, whose texts are fetched from rows."""
    asked = materialize(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct(), "candidate-nodes")
    release(rows.sparkSession)
    texts = KeyFilter(asked, F.col("node")).maybe_in(rows.select(F.col(row).alias("node"), text_or_empty().alias("text")), F.col("node")).join(asked, "node").select("node", "text")
    texts = materialize(texts, "candidate-texts", compression="zstd")
    roots = verified_roots(edges, texts, similarity)
    discard(asked, texts)
    return roots


def near_groups(rows: DataFrame, row: str, similarity: float = SIMILARITY) -> DataFrame:
    """(row, best): for each row (by its number in the column row) the row that stands for its group, that of the smallest doc_id."""
    made = materialize(sketches(rows, row), "sketches")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    nodes = made.groupBy("set_key").agg(best.alias("first"), F.min(F.struct("bands", "words")).alias("s"))
    nodes = materialize(nodes.select("set_key", "first", "s.bands", "s.words", F.col("first.row").alias("node")), "sketch-nodes")
    edges, crowded = candidates(nodes)
    roots = _verified(edges, rows, row, similarity)
    if not crowded.isEmpty():
        roots = joined_families(nodes, roots, crowded, rows, row, similarity)
    known = nodes.join(roots.withColumnRenamed("fp", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    stands = known.groupBy("root").agg(F.min("first").alias("best"))
    named = known.select("set_key", "root").join(stands, "root").select("set_key", F.col("best.row").alias("best"))
    groups = materialize(made.select("row", "set_key").join(named, "set_key").select("row", "best"), "near-groups")
    discard(made, nodes, edges, crowded, roots)
    return groups


def near_deduplicate(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of docs for each group of near copies, that of the smallest doc_id, with all its columns.

    Groups are connected by pairs whose sets of five-word shingles have a Jaccard similarity of at least similarity; every
    link is verified on whole texts. Candidates come from SimHash fingerprints by ball hashing: of two texts of similarity
    0.8, 0.9 or more meet in one of the BANDS; from 0.9 on nearly all do. Rows are told apart by their place, so ids may be
    null (the last in the order of ids) or repeat; texts without words form one group.
    """
    with small_batches(docs.sparkSession):
        rows, row = numbered(docs)
        gone = near_groups(rows, row, similarity).filter("row != best").select(F.col("row").alias(row))
        return without(rows, materialize(gone, "near-copies"), row).select(*docs.columns)
