"""Readers of the catalogue's file formats. Rows carry an explicit ordinal ``ord`` where first or last one matters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlake.functions.text import first_token


def in_order(df: DataFrame, *key: str) -> DataFrame:
    """df with ord: file name, then place in the file."""
    return df.withColumn("ord", F.struct(F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line"))) if not key else df.withColumn("ord", F.struct(*key))


def lines(spark: SparkSession, path: str) -> DataFrame:
    return in_order(spark.read.text(path)).withColumn("value", F.regexp_replace("value", r"\r$", ""))


def fasta(spark: SparkSession, path: str, id_only: bool = False) -> DataFrame:
    """(header, sequence, ord): lines of a sequence are put together; id_only keeps the header's first token."""
    records = in_order(spark.read.option("lineSep", "\n>").text(path))
    body = F.regexp_replace("value", r"^>|\r", "")
    header = F.trim(F.substring_index(body, "\n", 1))
    sequence = F.regexp_replace(F.regexp_replace(body, r"^[^\n]*\n?", ""), r"\s", "")
    return records.filter(F.trim("value") != "").select((first_token(header) if id_only else header).alias("header"), sequence.alias("sequence"), "ord")


def fasta_headers(spark: SparkSession, path: str) -> DataFrame:
    return fasta(spark, path, id_only=True).select("header")


def require_columns(df: DataFrame, required: list[str], what: str = "table") -> DataFrame:
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"{what} lacks columns: {', '.join(missing)}")
    return df


def delimited(spark: SparkSession, path: str, required: list[str] | None = None, sep: str = "\t") -> DataFrame:
    """A table with a header; every column is text."""
    df = spark.read.csv(path, sep=sep, header=True, quote='"', escape='"')
    return require_columns(df, required or [], path)


def sniffed_separator(spark: SparkSession, path: str) -> str:
    """The separator of the first line: the one of tab, comma, semicolon and bar that occurs most."""
    first = spark.read.text(path).limit(1).collect()
    line = first[0]["value"] if first else ""
    return max("\t,;|", key=line.count)


def sniffed(spark: SparkSession, path: str, required: list[str] | None = None) -> DataFrame:
    return delimited(spark, path, required, sniffed_separator(spark, path))


def _pick(df: DataFrame, key: str, last: bool) -> DataFrame:
    from strandlake.operators.ranking import keep_one

    return keep_one(df, [key], "ord", last=last)


def reference_list(spark: SparkSession, path: str) -> DataFrame:
    """(accession, kind, segment) of a list without header; of rows with one accession the first counts; rows of one field drop out."""
    parts = lines(spark, path).select(F.transform(F.split("value", "\t"), lambda x: F.trim(x)).alias("p"), "ord")
    rows = parts.filter((F.size("p") >= 2) & (F.col("p")[0] != ""))
    return _pick(rows.select(F.col("p")[0].alias("accession"), F.col("p")[1].alias("kind"), F.get("p", F.lit(2)).alias("segment"), "ord"), "accession", last=False).drop("ord")


def segmented_reference_list(spark: SparkSession, path: str) -> DataFrame:
    """(accession, kind): tab-separated, or 'accession|...', or a bare accession, which is a reference; the last row counts."""
    rows = lines(spark, path).filter(F.trim("value") != "")
    value = F.trim("value")
    tabbed = F.instr("value", "\t") > 0
    acc = F.when(tabbed, F.split("value", "\t")[0]).otherwise(F.substring_index(value, "|", 1))
    kind = F.when(tabbed, F.trim(F.split("value", "\t")[1])).otherwise("reference")
    return _pick(rows.select(F.trim(acc).alias("accession"), kind.alias("kind"), "ord"), "accession", last=True).drop("ord")


def id_set(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("id")).filter("id != ''").distinct()


def masters(references: DataFrame, drop_excluded: bool = False) -> DataFrame:
    """The masters of a reference list, or all its accessions if it names none (drop_excluded: but no exclusion entries)."""
    named = references.filter("kind = 'master'")
    if named.isEmpty():
        named = references.filter("kind != 'exclusion_list'") if drop_excluded else references
    return named.select("accession").distinct()


def master_list(spark: SparkSession, given: str, drop_excluded: bool = False) -> DataFrame:
    """(accession) of masters given as a reference list's path or as a list with commas."""
    if "," not in given:
        path = spark._jvm.org.apache.hadoop.fs.Path(given)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return masters(reference_list(spark, given), drop_excluded)
    return spark.createDataFrame([(x.strip(),) for x in given.split(",") if x.strip()], "accession string").distinct()


def master_segments(references: DataFrame) -> DataFrame:
    return references.filter("kind = 'master' AND segment IS NOT NULL").select("accession", "segment")


def gff(spark: SparkSession, path: str) -> DataFrame:
    """(seqid, type, start, end, product, attributes, ord); rows of fewer than nine fields drop out."""
    parts = lines(spark, path).filter(~F.col("value").startswith("#")).select(F.split("value", "\t").alias("p"), "ord").filter(F.size("p") >= 9)
    fields = [F.col("p")[i] for i in (0, 2, 3, 4)]
    return parts.select(*(c.alias(n) for c, n in zip(fields, ("seqid", "type", "start", "end"), strict=True)), F.regexp_extract(F.col("p")[8], r"product=([^;]*)", 1).alias("product"), attributes(F.col("p")[8]).alias("attributes"), "ord").withColumns({c: F.col(c).try_cast("int") for c in ("start", "end")})


def attributes(text: Column) -> Column:
    """Map of 'k=v;' and 'k "v";' attributes, URL-decoded; a plus sign stays; of equal keys the last counts."""
    item = F.filter(F.transform(F.split(text, ";"), lambda x: F.trim(x)), lambda x: x.rlike(r"^[^=\s]+(=|\s)"))
    key = lambda x: F.regexp_extract(x, r"^([^=\s]+)", 1)
    value = lambda x: F.try_url_decode(F.replace(F.btrim(F.regexp_extract(x, r"^[^=\s]+(?:=|\s+)(.*)$", 1), F.lit('" ')), F.lit("+"), F.lit("%2B")))
    entries = F.transform(item, lambda x: F.struct(key(x).alias("key"), value(x).alias("value")))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(last)


def taxonomy_dump(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """A bar-separated dump: the first fields, trimmed, with an ordinal. Packed files are unpacked by Spark."""
    parts = lines(spark, path).select(F.transform(F.split("value", r"\|"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")).alias("p"), "ord").filter(F.size("p") >= len(names))
    return parts.select(*(F.col("p")[i].alias(n) for i, n in enumerate(names)), "ord")


def taxon_names(spark: SparkSession, path: str) -> DataFrame:
    return taxonomy_dump(spark, path, ["tax_id", "name", "unique_name", "name_class"])


def taxon_nodes(spark: SparkSession, path: str) -> DataFrame:
    return taxonomy_dump(spark, path, ["tax_id", "parent_tax_id", "rank"]).drop("ord")


HITS = T.StructType([T.StructField("query", T.StringType()), T.StructField("reference", T.StringType()), T.StructField("identity", T.DoubleType()), T.StructField("strand", T.StringType())])


def hits(spark: SparkSession, path: str) -> DataFrame:
    """Tabular hits (query, reference, identity, strand, ord); a row that doesn't fit fails the read."""
    return in_order(spark.read.csv(path, schema=HITS, sep="\t", mode="FAILFAST"))


def _group_files(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").text(root)
    return rows.withColumns({"reference": F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1), "ord": F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"))})


def aligner_errors(spark: SparkSession, root: str) -> DataFrame:
    """(accession, errors, warnings, reference, ord) of all *.errors.csv; the folder names the reference."""
    parts = F.split("value", ",(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)")
    part = lambda i: F.btrim(F.coalesce(F.get(parts, F.lit(i)), F.lit("")), F.lit('" \r'))
    rows = _group_files(spark, root, ".errors.csv").select(part(0).alias("accession"), part(1).alias("errors"), part(2).alias("warnings"), "reference", "ord")
    return rows.filter("accession NOT IN ('', 'seqName')")


def aligner_insertions(spark: SparkSession, root: str) -> DataFrame:
    """(accession, insertion): the distinct insertions of each accession in order, joined by '; '."""
    parts = F.split("value", ",")
    rows = _group_files(spark, root, ".insertions.csv").select(F.trim(parts[0]).alias("accession"), F.btrim(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), F.lit('" \r')).alias("insertion"), "ord")
    rows = rows.filter("accession NOT IN ('', 'seqName') AND insertion != ''")
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("ord", "insertion"))), lambda x: x["insertion"])
    return rows.groupBy("accession").agg(F.array_join(F.array_distinct(ordered), "; ").alias("insertion"))


def tree_manifest(spark: SparkSession, path: str, trees: str, required: list[str], file_column: str) -> DataFrame:
    """Rows of a manifest with the text of the tree file that file_column names, found under trees."""
    rows = sniffed(spark, path, required)
    files = spark.read.text(trees, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_name").alias("_file"), F.btrim("value", F.lit(" \t\r\n")).alias("newick"))
    return rows.join(files, F.substring_index(file_column, "/", -1) == F.col("_file")).drop("_file")


def clusters(spark: SparkSession, path: str) -> DataFrame:
    """(representative, member, ord) of a table without header."""
    return in_order(spark.read.csv(path, sep="\t", schema="representative string, member string"))


def placements(spark: SparkSession, path: str) -> DataFrame:
    return in_order(spark.read.csv(path, sep="\t", header=True, schema="name string, LWR string, taxopath string"))


def mapping(spark: SparkSession, path: str) -> DataFrame:
    """(original, replacement) of a table whose header is skipped; a row without exactly two fields fails; the last of equal originals counts."""
    rows = in_order(spark.read.csv(path, sep="\t", header=True, quote="", mode="FAILFAST", schema="original string, replacement string"))  # the reader skips each file's header
    rows = rows.select(F.trim("original").alias("original"), F.trim("replacement").alias("replacement"), "ord")
    return _pick(rows, "original", last=True).drop("ord")


def serotype_mapping(spark: SparkSession, path: str) -> DataFrame:
    """(raw, curated); comments, a header and rows of fewer than two fields drop out; the last of equal raw values counts."""
    parts = lines(spark, path).filter(~F.col("value").startswith("#")).select(F.split("value", "\t").alias("p"), "ord").filter(F.size("p") >= 2)
    rows = parts.select(F.trim(F.col("p")[0]).alias("raw"), F.trim(F.col("p")[1]).alias("curated"), "ord").filter("raw != '' AND lower(raw) != 'raw_value'")
    return _pick(rows, "raw", last=True).drop("ord")


def submission_metadata(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """Submission rows; a repeated SeqID fails."""
    rows = delimited(spark, path, ["SeqID", *required])
    if twice := rows.groupBy("SeqID").count().filter("count > 1").limit(5).collect():
        raise ValueError(f"SeqID occurs more than once: {', '.join(str(r['SeqID']) for r in twice)}")
    return rows


def sqlite_table(spark: SparkSession, path: str, name: str, chunk: int = 50_000, columns: list[str] | None = None) -> DataFrame:
    """A table of an old single-file store, or some of its columns; every column is text.

    The file goes to the executors, where each task reads a range of row ids. Ranges hold chunk rows each, however far ids lie apart.
    """
    import os
    import sqlite3

    import pyarrow as pa
    from pyspark import SparkFiles

    quoted = lambda n: '"' + n.replace('"', '""') + '"'
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as store:
        held = [row[1] for row in store.execute(f"PRAGMA table_info({quoted(name)})")]
        if not held:
            raise ValueError(f"no table {name} in {path}")
        if missing := [c for c in columns or [] if c not in held]:
            raise ValueError(f"{name} has no columns {missing}")
        columns = columns or held
        try:
            ranked = f"SELECT rowid AS id, (row_number() OVER (ORDER BY rowid) - 1) / {int(chunk)} AS k FROM {quoted(name)}"
            ranges = store.execute(f"SELECT min(id), max(id) FROM ({ranked}) GROUP BY k ORDER BY k").fetchall()
        except sqlite3.OperationalError:  # a table without row ids is read as one range
            ranges = [None]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    if not ranges:
        return spark.createDataFrame([], schema)
    spark.sparkContext.addFile(path)
    file = os.path.basename(path)
    select = f"SELECT {', '.join(map(quoted, columns))} FROM {quoted(name)}"

    def run(batches):
        with sqlite3.connect(f"file:{SparkFiles.get(file)}?mode=ro", uri=True) as store:
            for batch in batches:
                for k in batch.column(0).to_pylist():
                    found = store.execute(select) if ranges[k] is None else store.execute(f"{select} WHERE rowid BETWEEN ? AND ?", ranges[k])
                    while rows := found.fetchmany(10_000):
                        yield pa.RecordBatch.from_arrays([pa.array([None if v is None else str(v) for v in column], "string") for column in zip(*rows, strict=True)], columns)

    return spark.range(0, len(ranges), 1, len(ranges)).mapInArrow(run, schema)
