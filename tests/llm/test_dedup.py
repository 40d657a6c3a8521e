"""Exact, near and substring dedup against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strandlake.llm import common, decontaminate, exact_dedup, repeats, simhash
from strandlake.llm.common import KeyFilter, filter_bits, materialize, shared_filter

WS = re.compile("[\x20\x09-\x0d]+")


def exact_brute(rows):
    norm = [WS.sub(" ", t or "") for _, t in rows]
    ids, size = defaultdict(list), Counter(norm)
    for (i, _), t in zip(rows, norm, strict=True):
        ids[t].append(i)
    keep = {t: min((i for i in x if i is not None), default=None) for t, x in ids.items()}
    return sorted(((i, keep[t], size[t], hashlib.sha256(t.encode()).hexdigest()) for (i, _), t in zip(rows, norm, strict=True)), key=str)


def check_exact(found, rows):
    got = [tuple(r) for r in found.select("doc_id", "keep_id", "group_size", "text_sha256", "kept").collect()]
    assert sorted((r[:4] for r in got), key=str) == exact_brute(rows)
    kept = [r for r in got if r[4]]
    assert len(kept) == len({r[3] for r in got}) == len({r[3] for r in kept})
    assert all(r[0] == r[1] for r in kept)


def test_exact(documents, sample):
    from tests.llm.conftest import ODD

    check_exact(exact_dedup.resolve_duplicates(documents(ODD)), ODD)
    df, texts = sample
    check_exact(exact_dedup.resolve_duplicates(df), list(texts.items()))


def test_exact_with_clashing_digests(documents):
    from tests.llm.conftest import ODD

    check_exact(exact_dedup.resolve_duplicates(documents(ODD), digest=lambda c: F.lpad(F.hex(F.length(c) % 3), 4, "0")), ODD)


def test_exact_keeps_rows_whole(documents):
    df = documents([(5, "a  b"), (2, "a b"), (2, "a b"), (None, "a b"), (3, "c")])
    kept = exact_dedup.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(2, "a b"), (3, "c")]
    assert exact_dedup.deduplicate(df.limit(0)).count() == 0
    assert exact_dedup.resolve_duplicates(df.limit(0)).count() == 0


def fingerprint_brute(text):
    words = [w for w in WS.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_brute(values):
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= 3 and find(i) != find(j):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def check_near(df, rows):
    got = simhash.near_duplicates(df).collect()
    values = [fingerprint_brute(t) for _, t in rows]
    roots = components_brute(values)
    first = {root: min((i for (i, _), r in zip(rows, roots, strict=True) if r == root and i is not None), default=None) for root in roots}
    want = sorted(((i, f"{v:016x}", first[r]) for (i, _), v, r in zip(rows, values, roots, strict=True)), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want


def test_near(documents, sample):
    from tests.llm.conftest import ODD

    check_near(documents(ODD), ODD)
    df, texts = sample
    check_near(df, list(texts.items()))
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def chained(seed, n):
    """Fingerprints in chains and clusters of few changed bits."""
    rng = np.random.default_rng(seed)
    values = [int(rng.integers(0, 2**63))]
    for _ in range(n - 1):
        value = values[rng.integers(0, len(values))] if rng.random() < 0.8 else int(rng.integers(0, 2**63))
        for b in rng.choice(64, rng.integers(0, 6), replace=False):
            value ^= 1 << int(b)
        values.append(value)
    return values


@pytest.mark.parametrize("bucket", [4096, 2])
def test_links_lose_none(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)  # small buckets are all dealt out again
    values = sorted(set(chained(3, 300)))
    signed = np.array(values, "u8").view("i8").tolist()
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = dict(simhash.components(simhash.links(fps)).collect())
    groups = defaultdict(set)
    for v, root in zip(values, components_brute(values), strict=True):
        groups[root].add(v)
    mine = defaultdict(set)
    for v, s in zip(values, signed, strict=True):
        mine[roots.get(s, s)].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_near_keeps_smallest(documents):
    text = " ".join(f"w{i}" for i in range(400))
    df = documents([(9, text), (4, text), (None, text), (5, "other words here"), (None, "alone in the world")])
    kept = simhash.near_deduplicate(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["4", "5", "None"]  # the copy without id goes: one row of each group stays


def test_near_loses_no_row(documents):
    """Ids may repeat or be null: rows are told apart by their place."""
    x, other = " ".join(f"w{i}" for i in range(80)), "another text " * 9 + "of its own"
    kept = simhash.near_deduplicate(documents([(1, x), (2, x), (2, other), (1, x), (None, "clean text without an id")])).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == sorted([("1", x), ("2", other), ("None", "clean text without an id")])


def set_of(text):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text).split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def edited(rng, words, n):
    words = list(words)
    for i in rng.choice(len(words), n, replace=False):
        words[i] = f"e{rng.integers(10**9)}"
    return " ".join(words)


def test_near_recall(documents):
    """Pairs of all similarities from 0.6 on: at least nine in ten of those of 0.8 or more are found, and no other."""
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for i in range(400):
        words = [f"w{x}" for x in rng.integers(0, 400, int(rng.integers(40, 300)))]
        copy = edited(rng, words, max(1, int(rng.uniform(0, 0.09) * len(words))))
        rows += [(2 * i, " ".join(words)), (2 * i + 1, copy)]
        one, two = set_of(rows[-2][1]), set_of(copy)
        want[2 * i + 1] = len(one & two) / len(one | two)
    kept = {r["doc_id"] for r in simhash.near_deduplicate(documents(rows)).select("doc_id").collect()}
    near = [i for i, j in want.items() if j >= 0.8]
    assert len(near) > 100 and sum(i not in kept for i in near) >= 0.9 * len(near)
    assert all(i in kept for i, j in want.items() if j < 0.8) and all(2 * i in kept for i in range(400))


@pytest.mark.parametrize("heavy", [16, 1000])
def test_near_crowded(documents, monkeypatch, heavy):
    """Hundreds of near copies of one text, by shares around pivots and without."""
    for name, value in {"HEAVY": heavy, "PIVOTS": 8, "SHARE": 32}.items():
        monkeypatch.setattr(simhash, name, value)
    rng = np.random.default_rng(6)
    words = [f"w{x}" for x in rng.integers(0, 1000, 300)]
    rows = [(i, edited(rng, words, 2)) for i in range(300)] + [(1000 + i, edited(rng, [f"x{x}" for x in rng.integers(0, 1000, 100)], 1)) for i in range(30)]
    kept = {r["doc_id"] for r in simhash.near_deduplicate(documents(rows)).select("doc_id").collect()}
    assert kept == {0, *(1000 + i for i in range(30))}


def joined_brute(texts, similarity=0.8):
    """Component of each text, by all pairs of sets of shingles."""
    names = {}
    sets = [[names.setdefault(x, len(names)) for x in set_of(t)] for t in texts]
    held = np.zeros((len(sets), len(names)), "f4")
    for i, s in enumerate(sets):
        held[i, s] = 1
    sizes, root = held.sum(1), np.arange(len(sets))
    both = held @ held.T
    linked = both >= similarity * (sizes[:, None] + sizes[None] - both) - 1e-3
    while True:
        least = np.where(linked, root[None], len(sets)).min(1)
        if (least == root).all():
            return root
        root = least


def test_near_recall_in_groups_of_thousands(documents):
    """Copies of one text, and a family in which each text comes of an earlier one: band values are shared by hundreds there, and
    most pairs of the family are no links."""
    rng = np.random.default_rng(8)
    first = [f"w{x}" for x in rng.integers(0, 1000, 120)]
    texts = [edited(rng, first, int(rng.integers(1, 4))) for _ in range(1500)]
    family = [" ".join(f"x{x}" for x in rng.integers(0, 1000, 100))]
    for _ in range(1499):
        family.append(edited(rng, family[rng.integers(len(family))].split(), int(rng.integers(1, 5))))
    texts += family
    want = joined_brute(texts)
    kept = {r["doc_id"] for r in simhash.near_deduplicate(documents(list(enumerate(texts)))).select("doc_id").collect()}
    gone = set(np.flatnonzero(want != np.arange(len(texts))).tolist())
    print(f"copies {len(gone)}, left in {len(gone & kept)}, taken wrongly {len(set(range(len(texts))) - gone - kept)}")
    assert len(gone - kept) >= 0.97 * len(gone) and set(range(len(texts))) - gone <= kept


@pytest.mark.parametrize("joined", [False, True])
def test_near_crowds_are_compared_whole(spark, documents, monkeypatch, joined):
    """What pivots, shares and forests leave out is made up for: all pairs of a bucket are candidates, but for those joined already."""
    rng = np.random.default_rng(12)
    family = [" ".join(f"x{x}" for x in rng.integers(0, 1000, 100))]
    for _ in range(199):
        family.append(edited(rng, family[rng.integers(len(family))].split(), int(rng.integers(1, 4))))
    docs = documents(list(enumerate(family))).withColumn("number", F.col("doc_id"))
    nodes = materialize(simhash.sketches(docs, "number").select("set_key", "bands", "words", F.col("row").alias("node")), "test-nodes")
    found = []
    for small, heavy, pivots, share in [(1000, 10**6, 8, 32), (2, 4, 1, 2)]:
        for name, value in {"SMALL": small, "HEAVY": heavy, "PIVOTS": pivots, "SHARE": share}.items():
            monkeypatch.setattr(simhash, name, value)
        edges, crowded = simhash.candidates(nodes)
        found.append({(r["a"], r["b"]) for r in edges.collect()})
    assert len(found[1]) < len(found[0])
    roots = spark.range(1, 80 if joined else 1).select(F.col("id").alias("fp"), F.lit(0).cast("long").alias("root"))
    more = [(r["a"], r["b"]) for r in simhash.rest_of_crowded(nodes, roots, crowded, edges).collect()]
    assert len(set(more)) == len(more) and not found[1] & set(more)
    assert set(more) == {(a, b) for a, b in found[0] - found[1] if not (joined and b < 80)}


def test_near_pairs_of_a_group_grow_with_it(documents, monkeypatch):
    """A group in which most sketches are near and few texts similar hands on pairs in proportion to it, and loses no link."""
    handed, near_sketches, similar = [], simhash.near_sketches, simhash.similar
    monkeypatch.setattr(simhash, "near_sketches", lambda pairs, nodes: handed.append(pairs.distinct().count()) or near_sketches(pairs, nodes))
    monkeypatch.setattr(simhash, "similar", lambda pairs, least: handed.append(pairs.count()) or similar(pairs, least))
    totals = []
    for n in (200, 400):
        rng = np.random.default_rng(21)
        words, handed[:] = [f"w{x}" for x in rng.integers(0, 1000, 200)], []
        texts = [edited(rng, words, int(rng.integers(2, 7))) for _ in range(n)]
        want = joined_brute(texts)
        kept = {r["doc_id"] for r in simhash.near_deduplicate(documents(list(enumerate(texts)))).select("doc_id").collect()}
        assert 50 < len(kept) < n and kept == set(np.flatnonzero(want == np.arange(n)).tolist())
        totals.append(sum(handed))
    assert totals[1] < 2.8 * totals[0] and totals[1] < n * (n - 1) / 4, totals  # twice the group; all pairs are n * (n - 1) / 2


def test_crowded_buckets_get_values_and_not_members(spark, documents, monkeypatch):
    """Of a group that is joined already, what meets in crowded buckets are its values; all that is near in such a bucket is one family."""
    handed = []

    class Counted(common.KeyFilter):
        def maybe_in(self, df, key):
            out = super().maybe_in(df, key)
            handed.append(out.count())
            return out

    for name, value in {"KeyFilter": Counted, "SMALL": 2, "HEAVY": 8, "PIVOTS": 2, "SHARE": 4}.items():
        monkeypatch.setattr(simhash, name, value)
    rng = np.random.default_rng(31)
    words, apart = ([f"{x}{y}" for y in rng.integers(0, 1000, n)] for x, n in (("w", 300), ("x", 60)))
    texts = [edited(rng, words, 1) for _ in range(300)] + [edited(rng, apart, int(rng.integers(1, 6))) for _ in range(60)]
    docs = documents(list(enumerate(texts))).withColumn("number", F.col("doc_id"))
    nodes = materialize(simhash.sketches(docs, "number").select("set_key", "bands", "words", F.col("row").alias("node")), "test-nodes")
    _, crowded = simhash.candidates(nodes)
    own = materialize(nodes.select("node", F.when(F.col("node") < 290, 0).otherwise(F.col("node")).alias("root"), "bands", "words"), "test-own")
    family = {r["root"]: r["family"] for r in simhash.families(own, crowded).collect()}
    emitted = {}  # (root, words) of each bucket
    for r in own.collect():
        for band, value in enumerate(r["bands"]):
            for v in [value] if value.bit_count() % 2 == 0 else [value ^ 1 << i for i in range(simhash.BITS)]:
                emitted.setdefault((band, v), []).append((r["root"], np.array(r["words"], "i8")))
    met = [emitted[(r["band"], r["variant"])] for r in crowded.collect()]
    assert len({root for bucket in met for root, _ in bucket}) > 30
    for bucket in met:
        for root, x in bucket:
            for other, y in bucket:
                if root < other and np.bitwise_count((x ^ y).view("u8")).sum() <= simhash.SKETCH_RADIUS:
                    assert family[root] == family[other]
    print("rows handed on", handed, "rows of nodes in crowded buckets", sum(map(len, met)))
    assert handed[0] <= 12 * own.count() and 3 * sum(handed) < sum(map(len, met))


@pytest.mark.parametrize("size", [1 << 20, 1 << 12])
def test_similar_in_blocks_compares_all_pairs(spark, monkeypatch, size):
    """Families in one block and in many, some members joined already: every link is found, across blocks too."""
    for name, value in {"MEET": 7, "COLUMNS": 16, "BLOCK_BYTES": size}.items():
        monkeypatch.setattr(simhash, name, value)
    rng = np.random.default_rng(22)
    words = [f"w{x}" for x in rng.integers(0, 1000, 60)]
    texts = [edited(rng, words, int(rng.integers(0, 4))) for _ in range(90)] + ["", "a b", "A  b"]
    want = joined_brute(texts[:90])
    members = [(7, i % (1 if size > 1 << 12 else 9), i, 0 if i < 5 and want[i] == 0 else i, t) for i, t in enumerate(texts)]
    found = simhash.similar_in_blocks(spark.createDataFrame(members, "family long, block long, node long, root long, text string"), 0.8)
    roots = dict(simhash.components(found).collect())
    assert [roots.get(m[3], m[3]) for m in members[:90]] == want.tolist()
    assert roots.get(90, 90) == 90 and roots.get(92, 92) == 91


def test_near_texts_go_to_python_by_bytes(spark, documents, monkeypatch):
    """Every table of the stage is made under the bound, which holds whatever the texts' length and is gone afterwards."""
    bounds, sizes = [], []

    def noted(df, *args, **options):
        bounds.append(spark.conf.get(common.BATCH_BOUND))
        return materialize(df, *args, **options)

    def measured(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["rows", "bytes"])

    monkeypatch.setattr(simhash, "materialize", noted)
    copy = " ".join(f"w{i}" for i in range(90))
    assert [r["doc_id"] for r in simhash.near_deduplicate(documents([(3, copy), (1, copy)])).collect()] == [1]
    assert len(bounds) > 3 and set(bounds) == {str(common.BATCH_BYTES)} and common.BATCH_BOUND not in spark.conf.getAll
    texts = spark.range(0, 600, 1, 1).select(F.repeat(F.lit("abcdefgh"), 8192).alias("text"))  # 64 KB each, 39 MB
    with common.small_batches(spark):
        sizes = texts.mapInArrow(measured, "rows long, bytes long").collect()
    assert sum(r["rows"] for r in sizes) == 600 and max(r["bytes"] for r in sizes) < 1.5 * common.BATCH_BYTES
    spark.conf.set(common.BATCH_BOUND, "1m")
    try:
        with common.small_batches(spark):
            assert spark.conf.get(common.BATCH_BOUND) == "1m"
    finally:
        spark.conf.unset(common.BATCH_BOUND)


def test_slices_keep_all_rows():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(900)), pa.array(["x" * 20_000] * 900)], ["i", "text"])
    parts = list(common.slices(iter([batch, batch.slice(0, 0), batch.slice(0, 1)])))
    assert [i for part in parts for i in part.column(0).to_pylist()] == [*range(900), 0]
    assert max(part.nbytes for part in parts) < 1.5 * common.BATCH_BYTES


def test_rows_without_ids(documents):
    """A leaked row without id takes no other row without id with it."""
    item = "how many of the twelve red apples did the old farmer sell before noon on market day"
    bench = documents([]).sparkSession.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, f"see {item} here"), (None, "a clean row"), (3, "a clean row"), (3, item)]
    kept = decontaminate.decontaminate(documents(rows), bench)
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect()) == [("3", "a clean row"), ("None", "a clean row")]


def test_clashing_helper_names(documents):
    df = documents([(1, "a b"), (2, "a  b"), (3, "c")]).withColumns({n: F.lit(1) for n in ("_row", "_id", "_sha", "_gone", "_leaked", "row_id", "batch", "node")})
    for kept in (exact_dedup.deduplicate(df), simhash.near_deduplicate(df)):
        assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_index_takes_runs(documents, monkeypatch):
    """Any number of batches gives the same rows, whether runs are left on several levels or compacted twice, with filters or without."""
    rows = [(i * 7 % 101, f"t{i % 23}") for i in range(101)]
    df = documents(rows).repartition(7)
    for batches in (1, 3, 6):
        index = exact_dedup.DigestIndex(df, batches=batches)
        assert [len(level) for level in index.levels] == {1: [1], 3: [3], 6: [2, 1]}[batches]
        check_exact(index.resolve(), rows)
    monkeypatch.setattr(exact_dedup, "filter_bits", lambda n: 0)
    check_exact(exact_dedup.DigestIndex(df, batches=5).resolve(), rows)


def test_shared_filter(spark):
    """What two of three filters have is in their shared filter; nearly all else is not."""
    frames = [spark.range(a, a + 1000) for a in (0, 900, 5000)]
    bits = filter_bits(3000)
    shared = KeyFilter.of(shared_filter([KeyFilter(df, F.col("id"), bits=bits).rows for df in frames]), bits)
    maybe = {r["id"] for r in shared.maybe_in(spark.range(6000), F.col("id")).collect()}
    out = {r["id"] for r in shared.surely_out(spark.range(6000), F.col("id")).collect()}
    assert set(range(900, 1000)) <= maybe and len(maybe) < 200
    assert not maybe & out and len(maybe | out) == 6000


def test_hot_cores(documents):
    """Cores with many phrases, split down to single strings, remove the same bytes."""
    rng = np.random.default_rng(7)
    shared = bytes(rng.integers(97, 123, 450, dtype="u1")).decode()
    rows = [(i, bytes(rng.integers(97, 123, 150, dtype="u1")).decode() + shared[: 405 + i % 45] + bytes(rng.integers(97, 123, 150, dtype="u1")).decode()) for i in range(25)]
    one, two = (sorted(map(tuple, repeats.remove_repeats(documents(rows), hot=hot).collect())) for hot in (50_000, 3))
    assert one == two == sorted(repeats_brute(rows))


def repeats_brute(rows, length=400):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(rows, data, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((doc_id, len(t), int(gone.sum()), runs, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=False) if not g)).hexdigest()))
    return sorted(out, key=str)


def texts_with_passages():
    rng = np.random.default_rng(5)
    words = lambda n: " ".join("".join(rng.choice(list("abcdé"), rng.integers(2, 9))) for _ in range(n))
    passages = [words(n) for n in (70, 90, 300)]
    rows = [(i, words(rng.integers(0, 120)) + " " + passages[i % 3][rng.integers(0, 90) :] + words(rng.integers(0, 60))) for i in range(24)]
    return rows + [(100, "z" * 1200), (101, "z" * 399), (102, "ab" * 500), (103, passages[2]), (103, passages[2]), (None, passages[2][:450]), (104, None), (105, "")]


@pytest.mark.parametrize("piece", [2_000_000, 700])
def test_repeats(documents, monkeypatch, piece):
    monkeypatch.setattr(repeats, "SLICE", piece)  # long texts are parsed in slices
    rows = texts_with_passages()
    got = repeats.remove_repeats(documents(rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == repeats_brute(rows)


def test_repeats_of_sample(sample):
    df, texts = sample
    got = repeats.remove_repeats(df, with_bytes=True)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == repeats_brute(list(texts.items()))
    row = got.filter("n_spans > 0").first()
    assert sum(s["end"] - s["start"] for s in row["removed"]) == row["n_removed"] and len(row["kept"]) == row["n_bytes"] - row["n_removed"]
    assert repeats.remove_repeats(df.limit(0)).count() == 0
