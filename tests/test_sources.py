"""Files read and written."""

import pytest
from pyspark.sql import functions as F

from strandlake.sources import readers, records, writers
from strandlake.streaming import batches
from strandlake.operators import store as stores


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_fasta(spark, tmp_path):
    path = put(tmp_path / "a.fa", ">s1 first one\nACGT\nAC\n>s2\n\n>s3|x\nTTT\n")
    assert rows(readers.fasta(spark, path), "header", "sequence") == [("s1 first one", "ACGTAC"), ("s2", ""), ("s3|x", "TTT")]
    assert rows(readers.fasta_headers(spark, path)) == [("s1",), ("s2",), ("s3|x",)]
    writers.fasta(readers.fasta(spark, path, id_only=True), str(tmp_path / "out"), width=4)
    assert rows(readers.fasta(spark, str(tmp_path / "out")), "header", "sequence") == [("s1", "ACGTAC"), ("s2", ""), ("s3|x", "TTT")]
    writers.fasta_by(readers.fasta(spark, path).withColumn("reference", F.lit("r1")), str(tmp_path / "by"), "reference")
    assert spark.read.text(str(tmp_path / "by")).select("reference").distinct().count() == 1


def test_tables(spark, tmp_path):
    path = put(tmp_path / "m.tsv", "a\tb\n1\tx\n2\t\n")
    assert rows(readers.delimited(spark, path, ["a"])) == [("1", "x"), ("2", None)]
    assert rows(readers.sniffed(spark, put(tmp_path / "m.csv", "a;b\n1;x\n"))) == [("1", "x")]
    with pytest.raises(ValueError, match="lacks columns: zz"):
        readers.delimited(spark, path, ["zz"])
    writers.tsv(readers.delimited(spark, path), str(tmp_path / "tsv"))
    assert rows(readers.delimited(spark, str(tmp_path / "tsv"))) == [("1", "x"), ("2", None)]


def test_lists(spark, tmp_path):
    refs = readers.reference_list(spark, put(tmp_path / "r.tsv", "A 1\tmaster\t1\nB\treference\t2\nB\tmaster\t3\nbad\n"))
    assert rows(refs) == [("A 1", "master", "1"), ("B", "reference", "2")]
    assert rows(readers.masters(refs)) == [("A 1",)]
    assert rows(readers.masters(refs.filter("kind != 'master'"))) == [("B",)]
    assert rows(readers.master_segments(refs)) == [("A 1", "1")]
    assert rows(readers.segmented_reference_list(spark, put(tmp_path / "s.tsv", "A\tmaster\nB|x\nC\nA\treference\n"))) == [("A", "reference"), ("B", "reference"), ("C", "reference")]
    assert rows(readers.id_set(spark, put(tmp_path / "i.txt", " x \n\nx\ny1\n"))) == [("x",), ("y1",)]
    assert rows(readers.mapping(spark, put(tmp_path / "map.tsv", "old\tnew\na\tb1\na\tc\n"))) == [("a", "c")]
    with pytest.raises(Exception, match="MALFORMED"):
        readers.mapping(spark, put(tmp_path / "bad.tsv", "old\tnew\na\n")).collect()
    assert rows(readers.serotype_mapping(spark, put(tmp_path / "sero.tsv", "raw_value\tcurated\n#x\ty\nA\tH1\nb\n"))) == [("A", "H1")]


def test_mapping_of_many_parts(spark, tmp_path):
    """Only each file's header is skipped, however many partitions there are."""
    folder = tmp_path / "maps"
    folder.mkdir()
    for k in range(3):
        (folder / f"m{k}.tsv").write_text("original\treplacement\n" + "".join(f"k{k}_{i}\tv{i}\n" for i in range(20_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        assert readers.mapping(spark, str(folder)).count() == 60_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_master_list(spark, tmp_path):
    (tmp_path / "refs.tsv").write_text("M1\tmaster\nR1\treference\n")
    assert sorted(r[0] for r in readers.master_list(spark, "A, B,,A").collect()) == ["A", "B"]
    assert [r[0] for r in readers.master_list(spark, str(tmp_path / "refs.tsv")).collect()] == ["M1"]
    assert [r[0] for r in readers.master_list(spark, "NC_1").collect()] == ["NC_1"]


def test_annotations(spark, tmp_path):
    gff = readers.gff(spark, put(tmp_path / "g.gff3", "##x\nchr\tp\tCDS\t1\t9\t.\t+\t0\tID=a;product=some+thing%20else;note \"q r\";ID=b\nchr\tshort\n"))
    got = gff.first()
    assert (got["start"], got["end"], got["product"]) == (1, 9, "some+thing%20else")
    assert got["attributes"] == {"ID": "b", "product": "some+thing else", "note": "q r"}
    names = readers.taxon_names(spark, put(tmp_path / "names.dmp", "2\t|\tBacteria\t|\tB <b>\t|\tscientific name\t|\n"))
    assert rows(names, "tax_id", "name", "name_class") == [("2", "Bacteria", "scientific name")]
    assert rows(readers.taxon_nodes(spark, put(tmp_path / "nodes.dmp", "2\t|\t1\t|\tsuperkingdom\t|\tx\t|\n"))) == [("2", "1", "superkingdom")]


def test_aligner_files(spark, tmp_path):
    put(tmp_path / "aln/r1/r1.errors.csv", 'seqName,errors,warnings\nq1,"In sequence, bad",w\nq2,,w\n')
    assert rows(readers.aligner_errors(spark, str(tmp_path / "aln")), "accession", "errors", "warnings", "reference") == [("q1", "In sequence, bad", "w", "r1"), ("q2", "", "w", "r1")]
    put(tmp_path / "ins/r1/r1.insertions.csv", "seqName,insertions\nq1,5:AC\nq1,9:T\nq1,5:AC\n")
    assert rows(readers.aligner_insertions(spark, str(tmp_path / "ins"))) == [("q1", "5:AC; 9:T")]
    hits = readers.hits(spark, put(tmp_path / "h.tsv", "q\tr\t98.5\tplus\n"))
    assert rows(hits, "query", "identity") == [("q", 98.5)]
    put(tmp_path / "trees/a.nwk", "(a,b);\n")
    manifest = readers.tree_manifest(spark, put(tmp_path / "t.tsv", "name\tpath\nmine\tx/a.nwk\n"), str(tmp_path / "trees"), ["name", "path"], "path")
    assert rows(manifest, "name", "newick") == [("mine", "(a,b);")]


RECORD = """<GBSet><GBSeq><GBSeq_locus>L</GBSeq_locus><GBSeq_length>6</GBSeq_length><GBSeq_division>VRL</GBSeq_division><GBSeq_definition>{d}</GBSeq_definition>
<GBSeq_primary-accession>{a}</GBSeq_primary-accession><GBSeq_accession-version>{a}.1</GBSeq_accession-version><GBSeq_sequence>acgtnn</GBSeq_sequence>
<GBSeq_references><GBReference><GBReference_reference>1</GBReference_reference><GBReference_authors><GBAuthor>X</GBAuthor></GBReference_authors><GBReference_title>T</GBReference_title></GBReference></GBSeq_references>
<GBSeq_feature-table><GBFeature><GBFeature_key>source</GBFeature_key><GBFeature_quals><GBQualifier><GBQualifier_name>country</GBQualifier_name><GBQualifier_value>Peru: Lima</GBQualifier_value></GBQualifier>
<GBQualifier><GBQualifier_name>collection_date</GBQualifier_name><GBQualifier_value>14-Sep-2010</GBQualifier_value></GBQualifier></GBFeature_quals></GBFeature>
<GBFeature><GBFeature_key>gene</GBFeature_key><GBFeature_location>1..3</GBFeature_location><GBFeature_quals><GBQualifier><GBQualifier_name>gene</GBQualifier_name><GBQualifier_value>G</GBQualifier_value></GBQualifier></GBFeature_quals></GBFeature></GBSeq_feature-table>
</GBSeq></GBSet>"""


def test_records(spark, tmp_path):
    for name, definition in (("A1", "first"), ("A2", "UNVERIFIED: x"), ("A3", "y"), ("A4", "z")):
        put(tmp_path / f"xml/{name}.{'XML' if name == 'A2' else 'xml'}", RECORD.format(a=name, d=definition))
    found = records.record_files(spark, str(tmp_path / "xml"))
    frame = lambda data, schema: spark.createDataFrame(data, schema)
    flat = records.flatten(found, frame([("A1", "master")], "accession string, kind string"), frame([("A3",)], "id string"), frame([("A4",)], "accession string"))
    assert flat.columns == records.COLUMNS
    assert rows(flat, "primary_accession", "accession_type", "exclusion_criteria", "exclusion_status") == [("A1", "master", "", "0"), ("A2", "excluded", "unverified sequence in XML", "1"), ("A3", "excluded", "excluded by the user", "1")]
    assert rows(flat.filter("primary_accession = 'A1'"), "country", "geo_loc", "collection_day", "collection_mon", "collection_year", "genes", "authors", "title", "a", "n", "real_length") == [("Peru", " Lima", 14, 9, 2010, "G(1..3)", "X", "T", 1, 2, 4)]
    wanted = frame([("A3",)], "accession string")
    assert rows(records.files_with(found, wanted), "file") == [("A3.xml",)]
    assert records.select_files(found, wanted, 2) == ["A3.xml", "A1.xml"]


def test_old_store(spark, tmp_path):
    import sqlite3

    path = tmp_path / "old.db"
    with sqlite3.connect(path) as store:
        store.execute("CREATE TABLE t (k TEXT, n INTEGER)")
        store.executemany("INSERT INTO t VALUES (?, ?)", [("a", 1), ("b", None), ("c", 3)])
    assert rows(readers.sqlite_table(spark, str(path), "t", chunk=2)) == [("a", "1"), ("b", None), ("c", "3")]


def test_streams(spark, tmp_path):
    from datetime import datetime

    schema = "header string, sequence string"
    store = stores.TableStore(spark, f"file://{tmp_path}/store")
    for name, data in (("one", [("h1", "A"), ("h2", "C")]), ("two", [("h2", "x"), ("h3", "G")])):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
        batches.append_stream(stream, store, "sequences", str(tmp_path / "ck"), lambda: datetime(2024, 1, 1)).awaitTermination(60)
    assert rows(store.read("sequences")) == [("h1", "A"), ("h2", "C"), ("h3", "G")]


def test_windows_on_a_stream(spark, tmp_path):
    spark.createDataFrame([("2024-01-01 00:10:00", "a", 1.0), ("2024-01-01 00:50:00", "a", 2.0), ("2024-01-01 09:00:00", "b", 4.0)], "t string, event_type string, value double").selectExpr("CAST(t AS timestamp) AS ts", "event_type", "value").write.parquet(str(tmp_path / "ev"))
    stream = spark.readStream.schema("ts timestamp, event_type string, value double").parquet(str(tmp_path / "ev"))
    batches.tumbling_counts(stream).writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start().awaitTermination(60)
    assert rows(spark.table("windows"), "event_type", "n", "total") == [("a", 2, 3.0), ("b", 1, 4.0)]


def test_submission(spark):
    df = spark.createDataFrame([("s1", 2, "<2", "9", "big protein X"), ("s1", 1, "1", ">8", "small Y")], "id string, start int, start_mark string, end_mark string, product string")
    text = writers.submission_features(df).first()["value"]
    assert text == ">Feature s1\n1\t>8\tCDS\n\t\t\tproduct\tsmall\n\t\t\tgene\tY\n<2\t9\tCDS\n\t\t\tproduct\tbig protein\n\t\t\tgene\tX"
    assert writers.software_table(spark).count() == 3
