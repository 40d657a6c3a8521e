"""Operators on long rows, deep walks, mixed ranges and many trees, against brute force."""

import random
import sqlite3
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strandlake.functions import sequence
from strandlake.operators import alignment, shared, taxonomy, trees, validation
from strandlake.operators import store as stores
from strandlake.sources import readers, records


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_gaps_of_a_long_row(spark):
    df = spark.createDataFrame([("A--" * 100_000,), ("",), (None,), ("é-😀--",), ("-",)], "a string")
    found = [r[0] for r in df.select(sequence.gap_ranges(F.col("a")).alias("r")).collect()]
    assert len(found[0]) == 100_000 and tuple(found[0][-1]) == (299_999, 300_000)
    assert [None if x is None else [tuple(r) for r in x] for x in found[1:]] == [[], None, [(2, 2), (4, 5)], [(1, 1)]]


def coverage_brute(master, query, a, b):
    low, high = sorted((a, b))
    columns = [i for i, c in enumerate(master) if c != "-"][max(low - 1, 0) : max(high, 0)]
    known = sum(i < len(query) and query[i] not in "-Nn" for i in columns)
    return f"{known / len(columns) * 100:.2f}" if columns else "NA"


def test_coverage_and_span_against_brute_force(spark):
    rng = random.Random(1)
    cases = [("".join(rng.choices("ACGT-", k=rng.randint(0, 30))), "".join(rng.choices("ACN-n", k=rng.randint(0, 35))), rng.randint(-5, 40), rng.randint(-5, 40)) for _ in range(200)]
    df = spark.createDataFrame(cases, "m string, q string, a int, b int")
    got = df.select(sequence.coverage(*map(F.col, "mqab")).alias("c"), sequence.covered_span("m", "q").alias("s")).collect()
    for (master, query, a, b), r in zip(cases, got, strict=True):
        assert r["c"] == coverage_brute(master, query, a, b)
        hit = [p for p, i in enumerate((i for i, c in enumerate(master) if c != "-"), 1) if i < len(query) and query[i] != "-"]
        assert tuple(r["s"]) == ((str(hit[0]), str(hit[-1])) if hit else ("NA", "NA"))
    odd = spark.createDataFrame([("ACGT", "ACGT", str(5 * 10**9), "-9999999999"), ("ACGT", None, "1", "2"), (None, "A", "1", "2")], "m string, q string, a string, b string")
    assert [r[0] for r in odd.select(sequence.coverage(*map(F.col, "mqab")).alias("c")).collect()][0] == "100.00"
    assert [r[0] for r in odd.select(sequence.covered_span("m", "q").alias("s")).collect()][1:] == [None, None]


def test_feature_tables_have_no_python(spark):
    master = spark.createDataFrame([("m", "m", "AC-GT"), ("m", "q", "-CGG-"), ("w", "w.1", "AAAA"), ("w", "x", "A-AA"), ("none", "y", "AC")], "master string, header string, sequence string")
    features = spark.createDataFrame([("m", 1, 4, "whole"), ("w", 1, 2, "front"), ("w", 2, 4, "rear"), ("none", 1, 2, "lost")], "master string, feature_start int, feature_end int, product string")
    best = spark.createDataFrame([("x", "r9")], "query string, reference string")
    out = alignment.feature_tables(master, features, best)
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan
    both = alignment.feature_table(master.filter("master = 'm'").drop("master"), "m", features.filter("master = 'm'").drop("master"), best)
    assert rows(out.filter("master_ref_accession = 'm'")) == rows(both)
    shown = ["accession", "reference_accession", "aln_start", "aln_end", "product", "genome_coverage"]
    assert ("x", "r9", "1", "4", "front", "50.00") in rows(out, *shown) and not rows(out.filter("accession = 'y'"))
    with pytest.raises(ValueError, match="no row"):
        alignment.feature_table(master.drop("master"), "zz", features.drop("master"), best)


@pytest.mark.parametrize("bin_width", [1, 16, 1000])
def test_nested_bins_against_brute_force(spark, bin_width):
    rng = random.Random(bin_width)
    span = lambda: rng.choice([rng.randint(0, 5), rng.randint(0, 300), rng.randint(5_000, 200_000), -rng.randint(1, 50)])
    ranges = [(i, s := rng.randint(-500, 50_000), s + span()) for i in range(150)] + [(998, None, 5), (999, 5, None)]
    features = [(s := rng.randint(-500, 50_000), s + span(), str(i)) for i in range(120)]
    want = sorted((i, p, max(s, a), min(e, b)) for i, s, e in ranges if None not in (s, e) for a, b, p in features if e >= a and s <= b)
    left, right = spark.createDataFrame(ranges, "id int, start long, end long"), spark.createDataFrame(features, "feature_start long, feature_end long, product string")
    for fan in (2, 8):
        got = alignment.overlaps(left, right, bin_width, small=0, fan=fan)
        assert sorted(tuple(r) for r in got.select("id", "product", "aln_start", "aln_end").collect()) == want
    assert got.columns == alignment.overlaps(left, right).columns


def test_crowded_bins_are_dealt_out(spark, monkeypatch):
    """Ranges and features of one bin in shares of five rows: no pair is lost or doubled, and there are tasks for all of them."""
    monkeypatch.setattr(alignment, "BIN_ROWS", 5)
    ranges = [(i, 10 + i % 3, 40) for i in range(60)] + [(99, 5000, 5001)]
    features = [(1 + i % 2, 50 + i, str(i % 7)) for i in range(23)] + [(5001, 9000, "far")]
    left, right = spark.createDataFrame(ranges, "id int, start long, end long"), spark.createDataFrame(features, "feature_start long, feature_end long, product string")
    out = alignment.overlaps(left, right, small=0)
    want = sorted((i, p, max(s, a), min(e, b)) for i, s, e in ranges for a, b, p in features if e >= a and s <= b)
    assert sorted(tuple(r) for r in out.select("id", "product", "aln_start", "aln_end").collect()) == want
    assert out.rdd.getNumPartitions() > 20


def test_a_range_makes_few_rows(spark):
    features = spark.createDataFrame([(1, 30_000_000, "long"), (50, 60, "short")], "feature_start long, feature_end long, product string")
    ranges = spark.createDataFrame([(1, 10, 29_000_000), (2, 55, 55)], "id int, start long, end long")
    got = alignment.overlaps(ranges, features, small=0)
    assert rows(got, "id", "product", "aln_start", "aln_end") == [(1, "long", 10, 29_000_000), (1, "short", 50, 60), (2, "long", 55, 55), (2, "short", 55, 55)]


def test_feature_tables_use_as_many_tasks_as_rows_ask_for(spark, monkeypatch):
    alignment_rows = spark.createDataFrame([("m", "m", "AC-GT")] + [("m", f"q{i}", "-CGG-") for i in range(300)], "master string, header string, sequence string")
    features = spark.createDataFrame([("m", 1, 4, "whole")], "master string, feature_start int, feature_end int, product string")
    best = spark.createDataFrame([("q7", "r9")], "query string, reference string")
    whole = rows(alignment.feature_tables(alignment_rows, features, best))
    monkeypatch.setattr(alignment, "ALIGNED_ROWS", 10)
    out = alignment.feature_tables(alignment_rows, features, best)
    assert rows(out) == whole and len(whole) == 301 and out.rdd.getNumPartitions() == 31


def test_gaps_are_found_once_for_all_features(spark):
    features = F.array(*(F.struct(F.lit(a).alias("start"), F.lit(a + 3).alias("end")) for a in range(1, 9)))
    df = spark.createDataFrame([("--AC-GT-ACGT",), ("",), (None,), ("----",)], "a string")
    out = df.select(sequence.cds_coordinates(sequence.gap_ranges(F.col("a")), features).alias("r"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    found = [None if r[0] is None else [tuple(x) for x in r[0]] for r in out.collect()]
    assert found[0][:3] == [(2, 4), (3, 5), (4, 6)] and found[1] == [(a, a + 3) for a in range(1, 9)] and found[2] == []


def test_set_differences_use_as_many_tasks_as_rows_ask_for(spark, monkeypatch):
    monkeypatch.setattr(shared, "TASK_ROWS", 100)
    odd = [(None, "x"), (None, None), (7, None), (7, None)]
    a, b = odd[:3] + [(i % 900, "s") for i in range(2000)], odd[1:] + [(i, "s") for i in range(300, 1200)]
    one, other = (spark.createDataFrame(x, "x int, y string") for x in (a, b))
    out = validation.symmetric_difference(one, other)
    want = [(*r, "a") for r in set(a) - set(b)] + [(*r, "b") for r in set(b) - set(a)]
    assert rows(out) == sorted(want, key=str) and out.columns == ["x", "y", "only_in"]
    assert out.rdd.getNumPartitions() >= 29


def test_deep_walks(spark):
    n = 10_000
    up = spark.range(1, n).select(F.col("id").alias("tax_id"), (F.col("id") - 1).alias("parent_tax_id"))
    ring = spark.range(5).select((F.lit(100_000) + F.col("id")).alias("tax_id"), (F.lit(100_000) + (F.col("id") + 1) % 5).alias("parent_tax_id"))
    tail = spark.createDataFrame([(200_001, 200_000), (200_000, 100_003), (300_000, 300_000), (400_000, None)], "tax_id long, parent_tax_id long")
    wanted = spark.createDataFrame([(n - 1,), (3,), (200_001,), (300_000,), (400_000,), (999_999,), (3,)], "tax_id long")
    walk = taxonomy.ancestors(wanted, up.union(ring).union(tail))
    deep = {r["ancestor"]: r["depth"] for r in walk.filter(f"tax_id = {n - 1}").collect()}
    assert deep == {n - 1 - d: d for d in range(n)}
    assert rows(walk.filter("tax_id < 10")) == [(3, 0, 3), (3, 1, 2), (3, 2, 1), (3, 3, 0)]
    assert [r["ancestor"] for r in walk.filter("tax_id = 200001").orderBy("depth").collect()] == [200_001, 200_000, 100_003, 100_004, 100_000, 100_001, 100_002]
    assert rows(walk.filter("tax_id >= 300000")) == [(300_000, 300_000, 0), (400_000, 400_000, 0), (999_999, 999_999, 0)]


def test_sparse_row_ids_make_few_tasks(spark, tmp_path):
    path = tmp_path / "sparse.db"
    with sqlite3.connect(path) as store:
        store.execute('CREATE TABLE t (k TEXT, "n ""x" INTEGER)')
        store.executemany("INSERT INTO t (rowid, k) VALUES (?, ?)", [(1, "a"), (10**9, "b"), (2 * 10**9, "c"), (5 * 10**12, "d"), (-7, "e")])
        store.execute("CREATE TABLE w (k TEXT PRIMARY KEY) WITHOUT ROWID")
        store.execute("INSERT INTO w VALUES ('x')")
        store.execute("CREATE TABLE empty (k TEXT)")
    found = readers.sqlite_table(spark, str(path), "t", chunk=2)
    assert found.rdd.getNumPartitions() == 3 and rows(found, "k") == [("a",), ("b",), ("c",), ("d",), ("e",)]
    assert readers.sqlite_table(spark, str(path), "t").rdd.getNumPartitions() == 1
    assert readers.sqlite_table(spark, str(path), "t", columns=["k"]).columns == ["k"]
    assert rows(readers.sqlite_table(spark, str(path), "w")) == [("x",)] and readers.sqlite_table(spark, str(path), "empty").count() == 0
    with pytest.raises(ValueError, match="columns"):
        readers.sqlite_table(spark, str(path), "t", columns=["zz"])


RECORD = "<GBSeq><GBSeq_primary-accession>{}</GBSeq_primary-accession><GBSeq_length>5</GBSeq_length></GBSeq>"


def test_malformed_files_are_skipped_whole(spark, tmp_path):
    folder = tmp_path / "xml"
    folder.mkdir()
    texts = {
        "good.xml": f"<GBSet>\n{RECORD.format('G1')}\n{RECORD.format('G2')}</GBSet>", "cut.xml": f"<GBSet>{RECORD.format('C1')}{RECORD.format('C2')[:50]}", "open.xml": f"<GBSet>\n{RECORD.format('D1')}\n{RECORD.format('D2')}\n",
        "BAD.XML": f"<GBSet>{RECORD.format('B1')}{RECORD.format('B2').replace('</GBSeq_length>', '</oops>')}</GBSet>", "none.xml": "<GBSet></GBSet>", "note.txt": "<GBSet>",
    }
    for name, text in texts.items():
        (folder / name).write_text(text)
    found, skipped = records.whole_files(spark, str(folder))
    assert rows(found, "`GBSeq_primary-accession`") == [("G1",), ("G2",)]
    assert rows(skipped) == [("BAD.XML", "malformed record"), ("cut.xml", "malformed record"), ("open.xml", "root element not closed")]
    frame = lambda schema: spark.createDataFrame([], schema)
    flat = records.flatten(found, frame("accession string, kind string"), frame("id string"))
    assert rows(flat, "primary_accession", "length") == [("G1", "5"), ("G2", "5")]
    one, none = records.whole_files(spark, str(folder / "good.xml"))
    assert one.count() == 2 and none.count() == 0


def random_tree(rng, names):
    nodes = list(names)
    while len(nodes) > 1:
        k = min(len(nodes), rng.choice([2, 2, 3]))
        picked = [nodes.pop(rng.randrange(len(nodes))) for _ in range(k)]
        nodes.append("(" + ",".join(picked) + ")")
    return nodes[0] + ";"


@pytest.mark.parametrize("halves", [False, True])
def test_distances_of_many_trees(spark, halves):
    rng = random.Random(3)
    texts = {f"t{i}": random_tree(rng, rng.sample("abcdefghijkl", rng.randint(2, 12))) for i in range(14)}
    texts |= {"empty": "", "twice": "((a,b),(a,c),(d,e),(f,g));", "chain": "(((((((a,b),c),d),e),f),g),h);", "same": "(h,(((((((a,b),c),d),e),f),g)));"}
    pairs = [(f"{a}-{b}", a, b) for a in texts for b in texts]
    got = trees.tree_distances(spark.createDataFrame(pairs, "pair string, a string, b string"), spark.createDataFrame(list(texts.items()), "tree string, newick string"), halves)
    found = {r["pair"]: {k: v for k, v in r.asDict().items() if k != "pair"} for r in got.collect()}
    assert found == {p: trees.distance(texts[a], texts[b], halves) for p, a, b in pairs}


def test_old_trees_move_to_the_new_store(spark, tmp_path):
    path, now = tmp_path / "trees.db", datetime(2024, 1, 2)
    with sqlite3.connect(path) as store:
        store.execute("CREATE TABLE tree (tree_name TEXT, name TEXT, newick TEXT, chromosome TEXT, segment TEXT, tree_model TEXT)")
        store.executemany("INSERT INTO tree VALUES (?, ?, ?, ?, ?, ?)", [("a", " ", "(x);", "c1", None, ""), ("a", None, "(y);", "c1", None, "m"), (None, "b", " ", "", "", ""), (None, None, "(z);", "", "2", "m"), (None, "held", "(w);", None, "1", None)])
        store.execute("CREATE TABLE bare (name TEXT)")
        store.execute("INSERT INTO bare VALUES ('n')")
    new = stores.TableStore(spark, f"file://{tmp_path}/store")
    schema = "name string, source string, tree_type string, tree_model string, segment_key string, segment string, newick string, created_at timestamp"
    new.replace("trees", spark.createDataFrame([("held", "tree_dir", None, None, None, "1", "(q);", now)], schema))
    old = readers.sqlite_table(spark, str(path), "tree").withColumn("ord", F.monotonically_increasing_id())
    for _ in range(2):  # a second run adds nothing
        new.append("trees", trees.migrated_trees(old, new.read("trees"), now, "ord"))
    assert rows(new.read("trees"), "name", "source", "tree_model", "segment_key", "segment", "newick") == [
        ("a", "tree_dir", None, "c1", None, "(x);"), ("held", "tree_dir", None, None, "1", "(q);"), ("tree_dir_tree", "tree_dir", "m", None, "2", "(z);"),
    ]
    assert trees.migrated_trees(readers.sqlite_table(spark, str(path), "bare"), new.read("trees"), now).count() == 0
