"""Worked cases of the catalogue's operators over tables."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strandlake.operators import alignment, curation, merge, quality, ranking, taxonomy, trees, validation
from strandlake.operators import store as stores

NOW = datetime(2024, 1, 2, 3, 4, 5)


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_hits_without_score_come_last(spark):
    hits = spark.createDataFrame([("q", "none", None, 1), ("q", "rB", 99.0, 2), ("only", "rC", None, 3)], "query string, reference string, identity double, ord int")
    assert rows(ranking.best_hit(hits), "query", "reference") == [("only", "rC"), ("q", "rB")]


def test_small_lookups(spark):
    table = lambda schema, *data: spark.createDataFrame(data, schema)
    sequences = table("header string, sequence string, ord int", ("a|x", "AC", 1), ("a|y", "GG", 2), ("b", "TT", 3))
    assert rows(ranking.first_before_bar(sequences), "header") == [("a|x",), ("b",)]
    matrix = table("primary_accession string", ("a|x",), ("c",), ("b",))
    assert rows(alignment.new_accessions(matrix, sequences.filter("ord < 3"), sequences.filter("ord = 3"))) == [("c",)]
    assert rows(alignment.sequences_of(table("accession string", ("b",), ("b",), ("zz",)), sequences)) == [("b", "TT")]
    assert rows(trees.segment_count(table("segment string", ("1",), ("2",), ("2",), (" ",), (None,)))) == [(2,)]
    failed = quality.failed_report(table("primary_accession string, collection_date_validated string, host_validated string, country_validated string, exclusion_status string", ("a", "NA", "Yes", "4", "0"), ("b", "Yes", "Yes", "4", "0")))
    assert failed.columns == quality.FAILED_COLUMNS and rows(failed, "primary_accession", "host") == [("a", "")]


def test_store_appends_parts(spark, tmp_path):
    """Appends leave earlier files as they are, keep new columns and old versions, and one of two writers fails."""
    store = stores.TableStore(spark, f"file://{tmp_path}/store")
    files = lambda: {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    store.append("t", spark.createDataFrame([("a", 1)], "k string, n int"))
    for more in (spark.createDataFrame([("b", 2, "x")], "k string, n int, note string"), spark.createDataFrame([("c", "3")], "k string, n string"), spark.createDataFrame([("d",)], "k string")):
        before = files()
        store.append("t", more)
        assert before.items() <= files().items()
    assert rows(store.read("t"), "k", "n", "note") == [("a", 1, None), ("b", 2, "x"), ("c", 3, None), ("d", None, None)]
    assert [store.read("t", v).count() for v in (1, 2, 3, 4)] == [1, 2, 3, 4]
    store._versions = lambda name: [1]  # a writer that has not seen the later versions
    with pytest.raises(Exception, match="already exists|FileAlreadyExists"):
        store.replace("t", more)


@pytest.mark.parametrize("partitions", [1, 5])
def test_best_hit_first_wins(spark, partitions):
    hits = spark.createDataFrame([("q1", "rA", 90.0, 1), ("q1", "rB", 95.0, 2), ("q1", "rC", 95.0, 3), ("q2", "rA", 80.0, 4)], "query string, reference string, identity double, ord int").repartition(partitions)
    assert rows(ranking.best_hit(hits), "query", "reference") == [("q1", "rB"), ("q2", "rA")]


def test_alternatives(spark):
    df = spark.createDataFrame([("q.1", "0.2", "X", 1), ("q.1", "0.7", "Y", 2), ("q.1", "bad", "", 3)], "name string, w string, path string, ord int")
    got = ranking.alternatives(df, F.substring_index("name", ".", 1), F.col("w"), F.col("path"))
    assert rows(got) == [("q", "Y", "Y;X;NULL", "0.7;0.2;bad")]


def test_quality_filter(spark):
    base = ("PAT", "5", "0", "AAAAA", "0")
    df = spark.createDataFrame([(*base, ""), (*base, "x"), ("VRL", "50", "0", "", "0", ""), ("VRL", "1", "", "", "1", "before"), ("PAT", "", "", "N" * 20, "0", "")], "division string, length string, n string, sequence string, exclusion_status string, exclusion_criteria string")
    text = "Real sequence length (length - Ns) less than the threshold"
    got = [tuple(r) for r in quality.quality_filter(df, 10, 8).select("exclusion_status", "exclusion_criteria").collect()]
    assert got == [("1", text), ("1", f"x; {text}"), ("0", ""), ("1", "before"), ("1", text)]
    only = quality.quality_filter(spark.createDataFrame([("PAT", "50", "0", "", "0", "")], df.schema), 10, 8, ["VRL"])
    assert only.first()["exclusion_criteria"] == "GenBank division PAT not in user-defined exclusion list"


def test_version_diff(spark):
    local = spark.createDataFrame([("A.1", 1), ("B.2", 2), ("C", 3)], "accession string, ord int")
    remote = spark.createDataFrame([(x,) for x in ("A.1", "B.3", "C.5", "D.9", "E.1", " ")], "accession string")
    excluded = spark.createDataFrame([("D",)], "accession string")
    diff = merge.version_diff(local, remote, excluded)
    assert rows(diff) == [("B.3", "updated", "B.2"), ("E.1", "new", None)]
    assert rows(merge.update_log(diff)) == [("B.2", "B.3"), ("NA", "E.1")]
    unversioned_first = spark.createDataFrame([("B", 1), ("B.2", 2)], "accession string, ord int")
    assert rows(merge.version_diff(unversioned_first, remote.filter("accession = 'B.3'"), excluded)) == []


def test_keyed_append(spark):
    table = spark.createDataFrame([("a",), ("b",)], "k string")
    incoming = spark.createDataFrame([("a", 1), ("c", 2), ("c", 3), (" b ", 4)], "k string, ord int")
    new, duplicates = merge.keyed_append(table, incoming, ["k"], "ord")
    assert rows(new) == [("c", 2)]
    assert rows(duplicates) == [("a",), ("b",)]
    assert rows(merge.duplicate_ledger(duplicates, "t", ["k"], "again", NOW), "key") == [("a",), ("b",)]


def test_store_appends_once(spark, tmp_path):
    store = stores.TableStore(spark, f"file://{tmp_path}/store")
    first = spark.createDataFrame([("h1", "AC"), ("h2", "GT")], "header string, sequence string")
    more = spark.createDataFrame([("h2", "xx"), ("h3", "TT")], "header string, sequence string")
    store.append_new("sequences", first, NOW)
    store.append_new("sequences", more, NOW)
    assert rows(store.read("sequences")) == [("h1", "AC"), ("h2", "GT"), ("h3", "TT")]
    store.append_new("sequences", more, NOW)
    assert store.read("sequences").count() == 3
    assert rows(store.read("sequences", 1)) == [("h1", "AC"), ("h2", "GT")]
    assert store.read("update_exclusions").count() == 3
    with pytest.raises(ValueError, match="features"):
        merge.table_key("features", ["accession"])
    assert merge.table_key("unknown", ["x", "y"]) == ["x"]


def test_store_replaces_on_request(spark, tmp_path):
    store = stores.TableStore(spark, f"file://{tmp_path}/store")
    table = lambda *data: spark.createDataFrame(data, "header string, sequence string")
    store.append_new("sequences", table(("h1", "A"), ("h2", "C")), NOW)
    store.append_new("sequences", table(("h2", "new"), ("h3", "G")), NOW, replace_updated=True)
    assert rows(store.read("sequences")) == [("h1", "A"), ("h2", "new"), ("h3", "G")]


def test_synonyms(spark):
    df = spark.createDataFrame([("a", "r")], "primary_accession string, alignment_name string")
    assert rows(merge.with_synonyms(df, merge.ALIGNMENT_SYNONYMS), "sequence_id", "primary_accession") == [("a", "a")]
    with pytest.raises(ValueError, match="neither"):
        merge.with_synonyms(df, {"x": ["y"]})


def test_upsert(spark):
    base = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, n int, s string")
    changed = spark.createDataFrame([("b", 5), ("c", 6)], "k string, n int")
    assert rows(merge.upsert(base, changed, ["k"])) == [("a", 1, "x"), ("b", 5, "y"), ("c", 6, None)]
    assert rows(merge.upsert_counts(base, changed, ["k"])) == [(1, 1)]


def test_overlay(spark):
    matrix = spark.createDataFrame([("p", "X", "NA", ""), ("q", "Z", "curator: me; note", "")], "primary_accession string, country string, comment string, curator string")
    curated = spark.createDataFrame([("p", "Y", "fix", "ann", 1), ("q", "n/a", "unused", "bob", 2), ("p", "W", "", "", 3), ("zz", "V", "", "", 4)], "primary_accession string, country string, comment string, curator string, ord int")
    assert rows(curation.overlay(matrix, curated.filter("ord = 1"))) == [("p", "Y", "fix; country: 'X' -> 'Y'", "ann"), ("q", "Z", "curator: me; note", "")]
    assert rows(curation.overlay(matrix, curated)) == [("p", "W", "fix; country: 'X' -> 'Y'; country: 'Y' -> 'W'", "ann"), ("q", "Z", "curator: me; note", "")]
    assert rows(curation.overlay_report(matrix, curated)) == [(3, 1)]
    twice = matrix.withColumn("n", F.lit(1)).union(matrix.withColumn("n", F.lit(2)))
    assert rows(curation.overlay(twice, curated.filter("ord = 1"), matrix_order="n"), "primary_accession", "country", "n") == [("p", "X", 2), ("p", "Y", 1), ("q", "Z", 1), ("q", "Z", 2)]


def test_hosts(spark):
    names = spark.createDataFrame([("canis lupus", "9612")], "name string, tax_id string")
    scientific = spark.createDataFrame([("9612", "Canis lupus")], "tax_id string, name string")
    mapping = spark.createDataFrame([("Dogg", "Canis lupus")], "original string, replacement string")
    hosts = spark.createDataFrame([("Dogg",), ("CANIS lupus (wolf)",), ("",), ("cat",)], "host string")
    cols = ["host", "host_validated", "host_taxa_id", "host_scientific_name"]
    assert rows(curation.standard_host(hosts, names, scientific, mapping), *cols) == [("", "NA", "NA", "NA"), ("CANIS lupus (wolf)", "Yes", "9612", "Canis lupus"), ("Dogg", "NA", "NA", "Canis lupus"), ("cat", "NA", "NA", "NA")]
    assert rows(curation.standard_host(hosts.filter("host = 'Dogg'"), names, scientific, mapping, fix_case=True), *cols) == [("Dogg", "Yes", "9612", "Canis lupus")]


def test_validate_matrix(spark):
    df = spark.createDataFrame([("a", "14-Sep-2010", "Peru: Lima", "dog", "NA", "0"), ("b", "x", "Perou", "cat", "", "0"), ("c", "2010", "Peru", "dog", "keep", "1")], "primary_accession string, collection_date string, country string, host string, comment string, exclusion_status string")
    table = lambda data, schema: spark.createDataFrame(data, schema)
    got = curation.validate_matrix(df, table([("Peru", "604")], "display_name string, m49_code string"), table([("Perou", "Peru")], "original string, replacement string"), table([("dog", "1")], "name string, tax_id string"), table([("1", "Canis")], "tax_id string, name string"), table([("zz", "y")], "original string, replacement string"))
    assert rows(got, "primary_accession", "comment", *curation.VALIDATED) == [("a", "", "Yes", "604", "Yes", "1", "Canis"), ("b", "Country mapped from mapping file: 'Perou' -> 'Peru'", "NA", "604", "NA", "NA", "NA"), ("c", "keep", "", "", "", "", "")]
    assert rows(quality.failed_validation(got), "primary_accession") == [("b",)]


def test_overlap_both_ways(spark, monkeypatch):
    ranges = spark.createDataFrame([(1, 5, 20), (2, 900, 2500), (3, 2400, 1500), (4, 29, 9), (5, None, 3)], "id int, start int, end int")
    features = spark.createDataFrame([(10, 30, "one"), (25, 40, "two"), (1000, 3000, "long"), (2000, 1200, "back")], "feature_start int, feature_end int, product string")
    want = [(1, "one", 10, 20), (2, "back", 2000, 1200), (2, "long", 1000, 2500), (3, "long", 2400, 1500)]
    cols = ["id", "product", "aln_start", "aln_end"]
    assert rows(alignment.overlaps(ranges, features), *cols) == want
    monkeypatch.setattr(alignment, "SMALL_FEATURES", 1)
    assert rows(alignment.overlaps(ranges, features, 100), *cols) == want


def test_alignment_tables(spark):
    refs = spark.createDataFrame([("r1.1", "A-CG-T", 1)], "header string, sequence string, ord int")
    queries = spark.createDataFrame([("q1", "TTTT", "r1", 2), ("q2", "AA", "zz", 3)], "header string, sequence string, reference string, ord int")
    merged = alignment.merged_alignment(refs, queries)
    assert rows(merged, "header", "sequence") == [("q1", "T-TT-T"), ("r1.1", "A-CG-T")]
    assert rows(alignment.orphans(queries, refs)) == [("q2", "zz")]
    best = spark.createDataFrame([("q1", "r1")], "query string, reference string")
    # The gaps at 2 and 5 move 1..4 to 1..3, which meets both features, and 1..2 to 1..1, which drops out.
    features = spark.createDataFrame([(1, 4, "p"), (1, 2, "q")], "feature_start int, feature_end int, product string")
    table = alignment.feature_table(merged.select("header", "sequence"), "r1.1", features, best)
    shown = ["accession", "reference_accession", "aln_start", "aln_end", "cds_start", "cds_end", "product", "genome_coverage"]
    assert rows(table, *shown) == [(a, r, "1", "4", "1", "3", x, "100.00") for a, r in (("q1", "r1"), ("r1.1", "r1.1")) for x in "pq"]
    bare = alignment.feature_table(merged.select("header", "sequence"), "r1", features.filter("product = 'q'"), best)
    assert rows(bare, *shown) == [("q1", "r1", "1", "4", *["NA"] * 4), ("r1.1", "r1", "1", "4", *["NA"] * 4)]
    short = spark.createDataFrame([("m", "AC-GT"), ("q", "--AG-"), ("n", "-----")], "header string, sequence string")
    table = alignment.feature_table(short, "m", spark.createDataFrame([(1, 4, "whole"), (5, 9, "beyond")], features.schema), best)
    assert ("q", "m", "3", "3", "2", "4", "whole", "25.00") in rows(table, *shown)  # the gap in front moves 1..4 to 2..4
    assert [r for r in rows(table, *shown) if r[0] == "n"] == [("n", "m", "NA", "NA", "5", "9", "beyond", "NA")]
    assert rows(alignment.covered_ranges(refs)) == [("r1.1", 1, 1), ("r1.1", 3, 4), ("r1.1", 6, 6)]


def test_taxonomy(spark):
    nodes = spark.createDataFrame([("4", "3", "species"), ("3", "2", "genus"), ("2", "1", "order"), ("1", "1", "no rank"), ("8", "9", "x"), ("9", "8", "y")], "tax_id string, parent_tax_id string, rank string")
    names = spark.createDataFrame([("4", "Four", "scientific name", 1), ("3", "Three", "scientific name", 2), ("4", "common a", "common name", 3), ("4", "common b", "common name", 4)], "tax_id string, name string, name_class string, ord int")
    wanted = taxonomy.wanted_taxa(spark.createDataFrame([("4",), ("8",), ("NA",), (" ",)], "host_taxa_id string"))
    walk = taxonomy.ancestors(wanted, nodes)
    assert rows(walk) == [(4, 1, 3), (4, 2, 2), (4, 3, 1), (4, 4, 0), (8, 8, 0), (8, 9, 1)]
    science = taxonomy.scientific_names(names)
    assert rows(taxonomy.lineage_columns(walk, nodes, science), "tax_id", "order_category", "genus", "species") == [(4, "taxid_2", "Three", "Four"), (8, None, None, None)]
    assert rows(taxonomy.children(spark.createDataFrame([(3,)], "tax_id long"), nodes, science)) == [("Four", 4, 3, "species", "genus")]
    assert rows(taxonomy.taxa_names(wanted, names, nodes), "taxa_id", "name", "common_name") == [(4, "Four", "common a"), (4, "common a", "common a"), (4, "common b", "common a"), (8, "Unknown", None)]


def test_trees(spark):
    one, two = "((a,b),(c,d),e);", "((a,c),(b,d),e);"
    assert trees.distance(one, two) == {"shared_taxa": 5, "splits_a": 2, "splits_b": 2, "rf": 4, "max_rf": 4, "normalized_rf": 1.0, "unique_to_a": 0, "unique_to_b": 0}
    assert trees.distance(one, one)["rf"] == 0
    assert trees.distance("(a,b);", one)["shared_taxa"] == 2
    assert trees.parse("('it''s':0.1,(b:1e-2,c)x)root;").leaves() == ["it's", "b", "c"]
    assert trees.write(trees.parse("((a:1,b:2)n:0.5,'c d');")) == "((a:1,b:2)n:0.5,'c d');"
    df = spark.createDataFrame([(one, two)], "a string, b string").select(trees.tree_distance("a", "b").alias("x"))
    assert df.first()["x"]["rf"] == 4
    with pytest.raises(ValueError, match="over 1"):
        trees.within_limits(trees.distance(one, two), most=1)
    deep = "(" * 5000 + "a" + ",b)" * 5000 + ";"
    assert len(trees.parse(deep).leaves()) == 5001
    assert trees.splits(trees.parse("((a,b),(c,d));"), set("abcd"), canonical_halves=True) == {(trees.leaf_hash("a") + trees.leaf_hash("b")) & trees.MASK}


def test_validation(spark):
    refs = spark.createDataFrame([("m", "master", "1"), ("x", "exclusion_list", "9")], "accession string, kind string, segment string")
    validation.check_reference_list(refs, segmented=True)
    with pytest.raises(ValueError, match="without a master"):
        validation.check_reference_list(refs.union(spark.createDataFrame([("r", "reference", "2")], refs.schema)), segmented=True)
    with pytest.raises(ValueError, match="unknown kinds"):
        validation.check_reference_list(spark.createDataFrame([("r", "odd", "2")], refs.schema))
    with pytest.raises(ValueError, match="without a record"):
        validation.require_references(spark.createDataFrame([("x",)], "accession string"), refs)
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    assert rows(validation.reconcile(ids("a", "b", "NA", None), ids("b ", "c", "-"))) == [("a", "missing"), ("c", "extra")]
    filtered = spark.createDataFrame([("s2", "bad"), ("s1", "bad"), ("s3", "")], "seq_name string, error string")
    assert rows(validation.filtering_summary(filtered)) == [("failed", 2, ["s1", "s2"]), ("unprojectable", 1, ["s3"])]


def test_audits(spark):
    df = spark.createDataFrame([("a", "query", "bad"), ("b", "reference", "bad"), ("c", "query", "")], "primary_accession string, accession_type string, exclusion string")
    kept, audit = quality.split_excluded(df)
    assert (rows(kept, "primary_accession"), rows(audit, "primary_accession")) == ([("b",), ("c",)], [("a",), ("b",)])
    segments = spark.createDataFrame([("1",), ("9",), ("x",), ("not found",)], "segment_validated string")
    assert [r["exclusion"] for r in quality.segment_exclusion(segments).collect()] == ["", "non IAV genomic sequence", "non IAV genomic sequence", "not significant BLAST hit"]
    assert quality.not_excluded(df, "absent", "1").count() == 3
