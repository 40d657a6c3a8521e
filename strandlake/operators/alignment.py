"""Alignments over tables: projection onto reference rows, feature overlap, coordinates and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.functions.sequence import bound, cds_coordinates, coverage_of, gap_ranges, letter_columns, letters, projected, reverse_complement, span_of
from strandlake.functions.text import without_version
from strandlake.operators.ranking import keep_one
from strandlake.operators.shared import tasks_for, written

#: Feature tables of up to this many rows are joined as a broadcast; longer ones by bins.
SMALL_FEATURES = 10_000
#: Sequences of an alignment that one task of feature_tables takes.
ALIGNED_ROWS = 50_000
#: Rows of one share of a bin of overlaps.
BIN_ROWS = 50_000


def oriented(queries: DataFrame, best: DataFrame) -> DataFrame:
    """(header, sequence, reference): queries with a best hit, those on the minus strand turned round."""
    hit = best.select(F.col("query").alias("header"), "reference", "strand")
    return queries.join(hit, "header").withColumn("sequence", F.when(F.col("strand") == "minus", reverse_complement(F.col("sequence"))).otherwise(F.col("sequence"))).drop("strand")


def grouped_queries(best: DataFrame, *by: str) -> DataFrame:
    """Number of queries of each group; their members are kept as rows, not as a list."""
    return best.groupBy(*by).agg(F.count(F.lit(1)).alias("queries"))


def merged_alignment(references: DataFrame, queries: DataFrame) -> DataFrame:
    """(header, sequence, reference, ref_ord, is_query, ord): each reference's row, then its queries laid out in its columns.

    references: header, sequence, ord (aligned to the master); queries: header, sequence, reference, ord.
    """
    refs = references.select(without_version(F.col("header")).alias("reference"), F.col("header").alias("_h"), F.col("sequence").alias("_ref"), F.col("ord").alias("ref_ord"))
    laid = queries.withColumn("reference", without_version(F.col("reference"))).join(refs, "reference")
    laid = laid.select("header", projected(F.col("_ref"), F.col("sequence")).alias("sequence"), "reference", "ref_ord", F.lit(1).alias("is_query"), "ord")
    own = refs.select(F.col("_h").alias("header"), F.col("_ref").alias("sequence"), "reference", "ref_ord", F.lit(0).alias("is_query"), F.col("ref_ord").alias("ord"))
    return own.unionByName(laid)


def orphans(queries: DataFrame, references: DataFrame) -> DataFrame:
    """(seq_name, reference) of queries whose reference has no row to project onto."""
    held = references.select(without_version(F.col("header")).alias("_r")).distinct()
    return queries.join(held, without_version(F.col("reference")) == F.col("_r"), "left_anti").select(F.col("header").alias("seq_name"), "reference")


def overlaps(ranges: DataFrame, features: DataFrame, bin_width: int = 1000, small: int = SMALL_FEATURES, fan: int = 8) -> DataFrame:
    """ranges (…, start, end) with the features (feature_start, feature_end, product) that they meet, clipped to aln_start and aln_end.

    A feature table of up to small rows is broadcast. A longer one meets the ranges in nested bins: those of a level are fan times as
    wide as those of the level below, and each range has the level whose bins are about as long as it, so that it lies in
    two of them at most. A pair meets at the level of the longer one, in the bin of its first common position; the shorter one
    stands there in one or two bins more for each level that the other table has. One rule holds for both ways, and for ranges
    whose start lies behind their end too: these meet what covers them whole, and stand in the bin of their start.
    Bins of more than BIN_ROWS rows are dealt into shares, and there is one task for every few bins' worth of rows.
    """
    meets = (F.col("end") >= F.col("feature_start")) & (F.col("start") <= F.col("feature_end"))
    clipped = {"aln_start": F.greatest("start", "feature_start"), "aln_end": F.least("end", "feature_end")}
    if features.limit(small + 1).count() <= small:
        return ranges.join(F.broadcast(features), meets).withColumns(clipped)

    def levelled(df: DataFrame, a: str, b: str, own: str) -> DataFrame:
        length = F.greatest(F.col(b) - F.col(a) + 1, F.lit(1)).cast("double")
        return df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).withColumn(own, F.greatest(F.ceil(F.log(float(fan), length / bin_width)), F.lit(0)).cast("int"))

    def binned(df: DataFrame, a: str, b: str, levels: Column) -> DataFrame:
        width = F.col("_width")
        df = df.withColumn("_level", F.explode(levels)).withColumn("_width", (F.lit(bin_width) * F.pow(F.lit(float(fan)), F.col("_level"))).cast("long"))
        return df.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(a) / width), F.floor(F.greatest(a, b) / width))))

    left, right = levelled(ranges, "start", "end", "_left"), levelled(features, "feature_start", "feature_end", "_right")
    levels_of = lambda df, own: F.array(*(F.lit(r[0]) for r in df.select(own).distinct().collect())).cast("array<int>")  # noqa: E731  a few, by the logarithm
    above = lambda own, others: F.filter(others, lambda x: x > F.col(own))
    left_levels, right_levels = levels_of(left, "_left"), levels_of(right, "_right")
    key = ["_level", "_width", "_bin"]
    longer = _joined_in_shares(binned(left, "start", "end", F.array("_left")), binned(right, "feature_start", "feature_end", F.concat(F.array("_right"), above("_right", left_levels))), key)
    shorter = _joined_in_shares(binned(left, "start", "end", above("_left", right_levels)), binned(right, "feature_start", "feature_end", F.array("_right")), key)
    met = longer.unionByName(shorter).filter(meets).withColumns(clipped)
    return met.filter(F.floor(F.col("aln_start") / F.col("_width")) == F.col("_bin")).drop(*key, "_left", "_right")


def _joined_in_shares(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """left joined with right by key. Where a key has more than BIN_ROWS rows of one side, these are dealt into shares that each meet all of the other's."""
    n = F.count(F.lit(1))
    counts = left.groupBy(*key).agg(n.alias("_nl"), F.lit(0).cast("long").alias("_nr")).union(right.groupBy(*key).agg(F.lit(0).cast("long"), n))
    counts = written(counts.groupBy(*key).agg(F.sum("_nl").alias("_nl"), F.sum("_nr").alias("_nr")).filter("_nl > 0 AND _nr > 0"), "bin-counts")
    shares = lambda c: F.ceil(F.col(c) / BIN_ROWS)
    total = counts.agg(F.sum(F.col("_nl") * shares("_nr") + F.col("_nr") * shares("_nl"))).first()[0] or 0
    tasks = max(left.sparkSession.sparkContext.defaultParallelism, -(-total // (4 * BIN_ROWS)))
    crowded = counts.filter((F.col("_nl") > BIN_ROWS) | (F.col("_nr") > BIN_ROWS)).select(*key, shares("_nl").alias("_of_l"), shares("_nr").alias("_of_r"))

    def dealt_out(df: DataFrame, own: str, other: str) -> DataFrame:
        mine, theirs = (F.coalesce(F.col(f"_of_{x}"), F.lit(1).cast("long")) for x in (own, other))
        # crowded is short: it has at most one row for every BIN_ROWS rows of the tables
        df = df.join(F.broadcast(crowded), key, "left").withColumn(f"_share_{own}", F.pmod(F.xxhash64(*df.columns), mine)).withColumn(f"_share_{other}", F.explode(F.sequence(F.lit(0).cast("long"), theirs - 1)))
        return df.drop("_of_l", "_of_r").repartition(tasks, *key, "_share_l", "_share_r")

    return dealt_out(left, "l", "r").join(dealt_out(right, "r", "l"), [*key, "_share_l", "_share_r"]).drop("_share_l", "_share_r")


def within_tolerance(coordinates: DataFrame, features: DataFrame, tolerance: int = 10) -> DataFrame:
    """coordinates (id, start, end) with the first feature (ord) whose ends are both within tolerance, marked '<' and '>' where partial."""
    width = 2 * tolerance + 1
    feats = features.withColumn("_bin", F.explode(F.array(*(F.floor(F.col("feature_start") / width) + d for d in (-1, 0, 1)))))
    near = coordinates.withColumn("_bin", F.floor(F.col("start") / width)).join(feats, "_bin").filter((F.abs(F.col("start") - F.col("feature_start")) <= tolerance) & (F.abs(F.col("end") - F.col("feature_end")) <= tolerance)).drop("_bin")
    first = keep_one(near, ["id", "start", "end"], "ord")
    return first.withColumns({"start_mark": F.concat(F.when(F.col("start") > F.col("feature_start"), "<").otherwise(""), F.col("start").cast("string")), "end_mark": F.concat(F.when(F.col("end") < F.col("feature_end"), ">").otherwise(""), F.col("end").cast("string"))})


def covered_ranges(alignment: DataFrame) -> DataFrame:
    """(header, start, end) of the runs of letters between gaps, counted in alignment columns."""
    gaps = gap_ranges(F.col("sequence"))
    rows = alignment.select("header", F.length("sequence").alias("n"), gaps.alias("g"))
    starts = F.concat(F.array(F.lit(1)), F.transform("g", lambda r: r["end"] + 1))
    ends = F.concat(F.transform("g", lambda r: r["start"] - 1), F.array(F.col("n")))
    return rows.select("header", F.explode(F.arrays_zip(starts.alias("start"), ends.alias("end"))).alias("r")).select("header", "r.start", "r.end").filter("start <= end")


def feature_table(alignment: DataFrame, master: str, features: DataFrame, best: DataFrame) -> DataFrame:
    """feature_tables() of one master; it fails if the alignment has no row of the master."""
    if alignment.filter(F.col("header").startswith(master)).isEmpty():
        raise ValueError(f"the alignment has no row of the master {master}")
    return feature_tables(alignment.withColumn("master", F.lit(master)), features.withColumn("master", F.lit(master)), best)


def feature_tables(alignment: DataFrame, features: DataFrame, best: DataFrame) -> DataFrame:
    """Feature coordinates and coverage of every sequence of the masters' alignments; rows without a range or a product have 'NA'.

    alignment: master, header, sequence; features: master, feature_start, feature_end, product, in master positions; best: query,
    reference. A master's row is the one of its name, else the first whose name begins with it; alignments without one are left out.
    Features are moved by the gaps of each sequence (cds_start, cds_end); a moved range gets a row for each feature that it meets,
    with the coverage of that feature's master columns. aln_start and aln_end are the master positions that the sequence covers.

    A master's columns and its annotation, one row, meet each of its sequences in one join; all else is done within the rows.
    There is one task for every ALIGNED_ROWS sequences; those of one master are dealt into shares, each with a copy of that row.
    """
    tasks = tasks_for(alignment, ALIGNED_ROWS)
    own = alignment.filter(F.col("header").startswith(F.col("master"))).groupBy("master").agg(F.min_by("sequence", F.struct(F.col("header") != F.col("master"), "header")).alias("_row"))
    listed = features.filter("feature_start IS NOT NULL AND feature_end IS NOT NULL")
    entry = F.struct(F.col("feature_start").cast("bigint").alias("start"), F.col("feature_end").cast("bigint").alias("end"), F.col("product").cast("string").alias("product"))
    annotation = listed.groupBy("master").agg(F.array_sort(F.collect_set(entry)).alias("_features"))
    known = own.select("master", letter_columns(F.col("_row")).alias("_columns")).join(annotation, "master", "left")
    known = known.withColumn("_features", F.coalesce("_features", F.array().cast("array<struct<start:bigint,end:bigint,product:string>>")))
    shares = F.explode(F.sequence(F.lit(0), F.lit(4 * tasks - 1))).alias("_share")
    known = known.select("*", shares).repartition(tasks, "master", "_share")
    rows = alignment.select("master", "header", "sequence", F.pmod(F.xxhash64("header", "sequence"), F.lit(4 * tasks)).cast("int").alias("_share"))
    rows = rows.repartition(tasks, "master", "_share").join(known, ["master", "_share"])

    def made(chars: Column) -> Column:
        moved = cds_coordinates(gap_ranges(F.col("sequence")), F.array_distinct(F.transform("_features", lambda f: F.struct(f["start"].alias("start"), f["end"].alias("end")))))
        covered = F.transform("_features", lambda f: f.withField("coverage", coverage_of(F.col("_columns"), chars, f["start"], f["end"])))
        none = lambda c: F.lit(None).cast("string").alias(c)
        bare = F.array(F.struct(F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"), none("product"), none("coverage")))

        def met(r: Column, known_ones: Column) -> Column:
            there = F.filter(known_ones, lambda f: (r["end"] >= f["start"]) & (r["start"] <= f["end"]))
            shown = F.transform(there, lambda f: F.struct(r["start"].alias("start"), r["end"].alias("end"), f["product"].alias("product"), f["coverage"].alias("coverage")))
            return F.when(F.size(shown) > 0, shown).otherwise(bare)

        found = bound(covered, lambda f: F.flatten(F.transform(moved, lambda r: met(r, f))))
        return F.struct(span_of(F.col("_columns"), chars).alias("span"), F.array_distinct(found).alias("found"))

    rows = rows.select("master", "header", letters(F.col("sequence"), made).alias("_m")).select("master", "header", "_m.span", F.explode_outer("_m.found").alias("f"))
    hit = best.select(F.col("query").alias("_q"), F.col("reference").alias("_r")).repartition(tasks, "_q")
    out = rows.repartition(tasks, "header").join(hit, F.col("header") == F.col("_q"), "left")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("NA"))
    out = out.select(F.col("header").alias("accession"), F.col("master").alias("master_ref_accession"), F.coalesce("_r", "master").alias("reference_accession"), text("span.first").alias("aln_start"), text("span.last").alias("aln_end"), text("f.start").alias("cds_start"), text("f.end").alias("cds_end"), text("f.product").alias("product"), text("f.coverage").alias("genome_coverage"))
    return out.repartition(tasks, *out.columns).distinct()


def new_accessions(matrix: DataFrame, queries: DataFrame, references: DataFrame) -> DataFrame:
    """Rows of matrix (primary_accession, ...) that neither queries (header) nor references (header) hold yet."""
    held = queries.select("header").union(references.select("header")).distinct()
    return matrix.join(held, F.col("primary_accession") == F.col("header"), "left_anti")


def sequences_of(wanted: DataFrame, sequences: DataFrame) -> DataFrame:
    """(header, sequence) of the accessions wanted (accession); what is not there is left out."""
    return sequences.select("header", "sequence").join(wanted.select(F.col("accession").alias("_a")).distinct(), F.col("header") == F.col("_a"), "left_semi")


def alignment_rows(alignment: DataFrame, best: DataFrame, insertions: DataFrame) -> DataFrame:
    """(sequence_id, primary_accession, alignment_name, alignment, insertion): the name is the best hit, else the reference that the row came with."""
    first = keep_one(alignment, ["header"], "ord")
    hit = best.select(F.col("query").alias("_q"), F.col("reference").alias("_r"))
    out = first.join(hit, F.col("header") == F.col("_q"), "left").join(insertions.select(F.col("accession").alias("_i"), "insertion"), F.col("header") == F.col("_i"), "left")
    return out.select(F.col("header").alias("sequence_id"), F.col("header").alias("primary_accession"), F.coalesce("_r", "reference").alias("alignment_name"), F.col("sequence").alias("alignment"), F.coalesce("insertion", F.lit("")).alias("insertion"))


# Attributes that name a gene product and its symbol, by preference.
PRODUCT_NAMES = ["product", "protein", "protein_name", "Name", "note"]
SYMBOL_NAMES = ["gene", "gene_name", "symbol", "locus_tag", "Name"]


def gene_table(gff: DataFrame) -> DataFrame:
    from strandlake.functions.text import first_attribute, first_token

    coding = gff.filter("type = 'CDS'")
    return coding.select(without_version(first_token(F.col("seqid")), last_dot=True).alias("accession"), F.col("type").alias("category"), "start", "end", first_attribute(F.col("attributes"), PRODUCT_NAMES).alias("gene_name"), first_attribute(F.col("attributes"), SYMBOL_NAMES).alias("symbol")).distinct()
