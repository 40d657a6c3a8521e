"""Sequences and alignments: counts, complements, gaps, projections and coordinates."""

from __future__ import annotations

from itertools import product as every

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Nucleotide codes and their complements.
CODES = "ACGTUMRWSYKVHDBNacgtumrwsykvhdbn"
COMPLEMENTS = "TGCAAKYWSRMBDHVNtgcaakywsrmbdhvn"


def letter_count(sequence: Column, letter: str) -> Column:
    upper = F.upper(F.coalesce(sequence, F.lit("")))  # on both sides: upper can change a text's length
    return F.length(upper) - F.length(F.replace(upper, F.lit(letter), F.lit("")))


def base_counts(sequence: Column) -> dict[str, Column]:
    """Columns a, t, g, c, n and real_length."""
    counts = {letter.lower(): letter_count(sequence, letter) for letter in "ATGCN"}
    return counts | {"real_length": counts["a"] + counts["t"] + counts["g"] + counts["c"]}


def reverse_complement(sequence: Column) -> Column:
    return F.reverse(F.translate(sequence, CODES, COMPLEMENTS))


def wrapped(sequence: Column, width: int = 80) -> Column:
    return F.regexp_replace(sequence, f"(.{{{width}}})(?=.)", "$1\n")


def bound(value: Column, f) -> Column:
    """f of value, which is computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def runs_of(text: Column, letters: str) -> Column:
    """Array of (start, end) of the runs of any of letters, counted from 1, both ends included.

    One pass over the letters finds the places where a run begins or has just ended, which then stand in pairs.
    """
    def found(chars: Column) -> Column:
        within = lambda i: F.coalesce(F.get(chars, i).isin(*letters), F.lit(False))
        edges = F.filter(F.sequence(F.lit(0), F.size(chars)), lambda i: within(i) != within(i - 1))
        pairs = lambda e: F.transform(F.filter(e, lambda _, k: k % 2 == 0), lambda start, k: F.struct((start + 1).alias("start"), F.get(e, 2 * k + 1).alias("end")))
        return bound(edges, pairs)

    return F.when(text.isNotNull(), F.when(text == "", F.array().cast("array<struct<start:int,end:int>>")).otherwise(bound(F.split(text, ""), found)))


def gap_ranges(aligned: Column) -> Column:
    """Array of (start, end) of the runs of '-', counted from 1, both ends included."""
    return runs_of(aligned, "-")


def letter_columns(master: Column) -> Column:
    """The columns, from 1, of an aligned row's letters: item p is the column of position p.

    Made once for a master and joined to the rows that are aligned with it, it spares each of them the search.
    """
    held = lambda chars: F.filter(F.sequence(F.lit(1), F.size(chars)), lambda i: F.get(chars, i - 1) != "-")
    return F.when(master.isNotNull(), F.when(master == "", F.array().cast("array<int>")).otherwise(bound(F.split(master, ""), held)))


def span_of(columns: Column, chars: Column) -> Column:
    """(first, last) position, as texts, whose column among columns holds a letter of chars (an array); 'NA' if none does."""
    hit = F.filter(F.transform(columns, lambda c, k: F.when(F.get(chars, c - 1) != "-", k + 1)), lambda p: p.isNotNull())
    text = lambda p: F.coalesce(p.cast("string"), F.lit("NA"))
    return bound(hit, lambda h: F.struct(text(F.get(h, F.lit(0))).alias("first"), text(F.get(h, F.size(h) - 1)).alias("last")))


def coverage_of(columns: Column, chars: Column, start: Column, end: Column) -> Column:
    """Percentage, with two decimals (ties to even), of the columns of positions start to end, in either order, where chars (an array) has a known base."""
    within = lambda p, low, high: F.least(F.greatest(p, F.lit(low)), high).cast("int")
    first, last = within(F.least(start, end), 1, F.size(columns) + 1), within(F.greatest(start, end), 0, F.size(columns))
    own = F.slice(columns, first, F.greatest(last - first + 1, F.lit(0)))
    share = lambda c: F.size(F.filter(c, lambda i: ~F.coalesce(F.get(chars, i - 1), F.lit("-")).isin("-", "N", "n"))) / F.size(c) * 100
    text = bound(own, lambda c: F.when(F.size(c) > 0, F.format_string("%.2f", F.bround(share(c), 2))))
    return F.coalesce(F.when(start.isNotNull() & end.isNotNull(), text), F.lit("NA"))


def gaps_before(ranges: Column, position: Column) -> Column:
    """Gap columns up to position, itself included if it is in a gap."""
    return F.aggregate(ranges, F.lit(0), lambda n, r: n + F.greatest(F.least(r["end"], position.cast("int")) - r["start"] + 1, F.lit(0)))


def leading_offset(ranges: Column) -> Column:
    """The column after a gap that opens the row, else 1."""
    first = F.get(ranges, F.lit(0))
    return F.when(first["start"] == 1, first["end"] + 1).otherwise(F.lit(1))


def cds_coordinates(ranges: Column, features: Column) -> Column:
    """Distinct (start, end) of features (array of start, end) without the gaps before them, shifted by the leading offset; empty ones drop out."""
    def moved(known: Column, offset: Column) -> Column:
        shifted = lambda p: p.cast("int") - gaps_before(known, p) + offset - 1
        return F.transform(features, lambda f: F.struct(shifted(f["start"]).alias("start"), shifted(f["end"]).alias("end")))

    found = bound(ranges, lambda known: bound(leading_offset(known), lambda offset: moved(known, offset)))
    return F.array_distinct(F.filter(found, lambda f: f["start"] != f["end"]))


def trimmed(sequence: Column, ranges: str) -> Column:
    """The ranges 'a:b,c:d' of a sequence, one after another; counted from 1, ends included, either end may be open."""
    parts = []
    for item in filter(None, (x.strip() for x in ranges.split(","))):
        start, _, end = item.partition(":")
        first, last = int(start or 1), end.strip()
        parts.append(F.substring(sequence, first, int(last) - first + 1) if last else F.substring(sequence, F.lit(first), F.length(sequence)))
    return F.concat(*parts) if parts else sequence


@F.pandas_udf(T.StringType())
def projected(reference: pd.Series, query: pd.Series) -> pd.Series:
    """The query laid out in the reference's columns: gaps stay gaps, missing letters become gaps, surplus ones drop out."""
    out = []
    for ref, seq in zip(reference, query, strict=True):
        if ref is None or seq is None:
            out.append(None)
            continue
        row = np.array(list(ref), dtype=object)
        open_columns = np.flatnonzero(row != "-")[: len(seq)]
        laid = np.full(len(row), "-", dtype=object)
        laid[open_columns] = list(seq[: len(open_columns)])
        out.append("".join(laid))
    return pd.Series(out, dtype="object")


def letters(text: Column, f) -> Column:
    """f of the text's letters as an array."""
    return bound(F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "")), f)


def covered_span(master: Column | str, query: Column | str) -> Column:
    """First and last position of the master that the query covers, 'NA' if none. Master columns behind the query's end are not covered."""
    master, query = (F.col(c) if isinstance(c, str) else c for c in (master, query))
    found = bound(letter_columns(master), lambda columns: letters(query, lambda chars: span_of(columns, chars)))
    return F.when(master.isNotNull() & query.isNotNull(), found)


def coverage(master: Column, query: Column, start: Column, end: Column) -> Column:
    """Percentage, with two decimals, of a feature's master columns where the query has a known base; 'NA' if it has no columns."""
    low, high = (F.trim(c.cast("string")).try_cast("bigint") for c in (start, end))
    return bound(letter_columns(master), lambda columns: letters(query, lambda chars: coverage_of(columns, chars, low, high)))


# The standard genetic code, codons in the order TCAG.
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = dict(zip(map("".join, every("TCAG", repeat=3)), AMINO_ACIDS, strict=True))


@F.pandas_udf(T.StructType([T.StructField("frame", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("protein", T.StringType())]))
def longest_frame(sequences: pd.Series) -> pd.DataFrame:
    """The longest open reading frame (M to stop) of six frames; frames 1 to 3 forward, -1 to -3 on the other strand; the first of equals."""
    flip = str.maketrans(CODES, COMPLEMENTS)
    rows = []
    for text in sequences:
        text = (text or "").upper().replace("U", "T")
        best = (None, None, "")
        for strand, letters in ((1, text), (-1, text.translate(flip)[::-1])):
            for shift in range(3):
                protein = "".join(CODONS.get(letters[i : i + 3], "X") for i in range(shift, len(letters) - 2, 3))
                at = protein.find("M")
                while at >= 0 and (stop := protein.find("*", at)) >= 0:
                    if stop - at + 1 > len(best[2]):
                        best = (strand * (shift + 1), shift + 3 * at + 1, protein[at : stop + 1])
                    at = protein.find("M", at + 1)
        rows.append(best)
    return pd.DataFrame(rows, columns=["frame", "start", "protein"]).astype({"frame": "Int32", "start": "Int32"})
