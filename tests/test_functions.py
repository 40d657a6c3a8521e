"""Worked cases of the catalogue's functions."""

import pytest
from pyspark.sql import functions as F

from strandlake.functions import blanks, dates, sequence, text


def values(spark, rows, expression, names="a"):
    df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], "_i int, " + ", ".join(f"{n} string" for n in names.split()))
    return [r[1] for r in df.select("_i", expression.alias("x")).orderBy("_i").collect()]


A = F.col("a")


@pytest.mark.parametrize("query, laid", [("TTTT", "T-TT-T"), ("TT", "T-T---"), ("TTTTGG", "T-TT-T"), ("", "------")])
def test_projection(spark, query, laid):
    assert values(spark, [("A-CG-T", query)], sequence.projected(A, F.col("b")), "a b") == [laid]


def test_gaps_and_coordinates(spark):
    ranges = sequence.gap_ranges(A)
    got = values(spark, ["--AC-GT---", "", "ACGT", "---"], ranges)
    assert [[tuple(r) for r in x] for x in got] == [[(1, 2), (5, 5), (8, 10)], [], [], [(1, 3)]]
    assert values(spark, ["--AC-GT---"], F.transform(F.array(*map(F.lit, (1, 4, 5, 9))), lambda p: sequence.gaps_before(ranges, p))) == [[1, 2, 3, 5]]
    cds = F.array(F.struct(F.lit(4).alias("start"), F.lit(7).alias("end")), F.struct(F.lit(4).alias("start"), F.lit(7).alias("end")))
    assert [tuple(r) for r in values(spark, ["--AC-GT---"], sequence.cds_coordinates(ranges, cds))[0]] == [(4, 6)]


def test_span_and_coverage(spark):
    assert values(spark, [("AC-GT", "-CAG-")], sequence.covered_span(A, F.col("b")), "a b") == [("2", "3")]
    assert values(spark, [("AC-GT", "-----")], sequence.covered_span(A, F.col("b")), "a b") == [("NA", "NA")]
    rows = [("AC-GT", "-CAG-", "1", "4"), ("ACGT", "ANGT", "4", "1"), ("ACGT", "ACGT", "x", "1"), ("ACGT", "ACGT", "8", "9"), ("ACGT", "AC", "1", "4")]
    assert values(spark, rows, sequence.coverage(A, *map(F.col, "bcd")), "a b c d") == ["50.00", "75.00", "NA", "NA", "50.00"]


def test_sequences(spark):
    turned = sequence.reverse_complement(A)
    assert values(spark, ["ACGTN", "RYSWKM"], turned) == ["NACGT", "KMWSRY"]
    assert values(spark, ["ACGTNRYSWKMBDHV"], sequence.reverse_complement(turned)) == ["ACGTNRYSWKMBDHV"]
    assert values(spark, ["ABCDEF"], sequence.trimmed(A, ":3,5:")) == ["ABCEF"]
    assert values(spark, ["AAAA" * 3], sequence.wrapped(A, 5)) == ["AAAAA\nAAAAA\nAA"]
    assert values(spark, ["aAtgßn", None], F.struct(*(c.alias(n) for n, c in sequence.base_counts(A).items()))) == [(2, 1, 1, 0, 1, 4), (0, 0, 0, 0, 0, 0)]
    found = values(spark, ["CCATGAAATAGCC", "", None], sequence.longest_frame(A))
    assert [tuple(r) for r in found] == [(3, 3, "MK*"), (None, None, ""), (None, None, "")]


def test_dates(spark):
    cases = {
        "14-Sep-2010": (14, 9, 2010), "Aug-2013": (None, 8, 2013), "2013": (None, None, 2013), "2010-09-14": (None, None, 2010), "8/25/2022": (25, None, 2022),
        "5/6/21": (6, 5, 2021), "": (None, None, None), "rubbish": (None, None, None), "31-Feb-2010": (None, None, None),
    }
    assert {k: dates.date_parts(k) for k in cases} == cases
    df = dates.split_dates(spark.createDataFrame([(k,) for k in [*cases, None]], "d string"), "d")
    assert {r["d"]: tuple(r)[1:] for r in df.collect()} == cases | {None: (None, None, None)}
    assert values(spark, ["14-Sep-2010", "4-Sep-2010", "Sep-2010", "2010", "2010-09-14", "31-Feb-2010", "", "20101"], dates.date_flag(A)) == ["Yes"] * 4 + ["NA"] * 4


def test_strains_and_serotypes(spark):
    assert values(spark, ["Virus (A/x/1(H1N1)) gene", "Virus (B/y/2) x", "none"], text.strain_in(A)) == ["A/x/1", "B/y/2", ""]
    assert values(spark, ["A/x 1 (H1N1)/", "a__b!!"], text.clean_strain(A)) == ["A/x_1", "a_b"]
    raw = ["H3N2", "A / H1", "h5 n1", "H?N2", "foo", "", "H1NX"]
    assert values(spark, raw, text.serotype(A)) == ["H3N2", "H1", "H5N1", "N2", "unknown", "", "H1"]
    assert values(spark, ["foo"], text.serotype(A, F.lit("H9N9"))) == ["H9N9"]
    assert values(spark, [(" ", "x (H10N7) y"), ("H1", "")], text.serotype_source(A, F.col("b")), "a b") == ["H10N7", "H1"]


def test_keys(spark):
    assert values(spark, ["7", "refset_4_aln", "seg-2", "abc", "", None], text.segment_number(A)) == ["7", "4", "2", None, None, None]
    assert values(spark, ["  AB1.2 x", "AB2"], text.accession(A)) == ["AB1", "AB2"]
    assert values(spark, ["A.1", "B", "C.x", ""], F.struct(text.accession_base(A), text.accession_version(A))) == [("A", 1), ("B", None), ("C", None), (None, None)]
    assert values(spark, ["a.b.1"], text.without_version(A, last_dot=True)) == ["a.b"]
    assert values(spark, ["Peru: Lima: x"], F.struct(text.country_part(A), text.locality_part(A))) == [("Peru", " Lima")]


def test_comments(spark):
    assert values(spark, [("one; Two", " two "), ("one", "new"), ("one", "NA"), ("", "x")], text.append_item(A, F.col("b")), "a b") == ["one; Two", "one; new", "one", "x"]
    assert values(spark, [("ab cd", "B C"), ("ab", "x"), ("", "x"), ("ab ;", "")], text.append_unless_inside(A, F.col("b")), "a b") == ["ab cd", "ab; x", "x", "ab"]
    assert values(spark, ["NA; x", "Namibia", "x; ; y"], text.clean_separators(A)) == ["x", "mibia", "x; y"]
    assert values(spark, ["x; Curator: me; y"], text.without_curators(A)) == ["x; y"]
    assert values(spark, [("e", "r"), ("", "r"), (None, None)], text.filtering_reason(A, F.col("b")), "a b") == ["alignment_filtering: e", "alignment_filtering: filtered against reference r", "alignment_filtering"]
    assert values(spark, ["Fresh", "updated", "odd", None], text.store_status(A)) == ["new db", "last updated", "odd", None]


def test_blanks(spark):
    rows = ["", " ", "NA", "nan", "n/a", "-", "null", "None", "x", None]
    say = lambda f: [r for r, b in zip(rows, values(spark, rows, f(A)), strict=True) if b]
    assert say(blanks.blank_number) == ["", " ", "NA", "nan", "n/a", "-", "null", "None", None]
    assert say(blanks.blank_in_curation) == ["", " ", "NA", "n/a", "-", None]
    assert say(blanks.empty_after_trim) == ["", " ", None]
    assert say(blanks.empty) == ["", None]
    assert say(blanks.blank_in_report) == ["", " ", "NA", "n/a", "-", "None", None]
    assert say(blanks.blank_taxon) == ["", " ", "NA", None]
    assert values(spark, [" 5 ", "5.0", "1.5", "x", "none", None], blanks.nullable_integer(A)) == [5, 5, None, None, None, None]
