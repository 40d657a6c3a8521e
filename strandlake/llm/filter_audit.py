"""Filter interaction audit: what each of several filters removes in every order of applying them.

Every document is reduced to a mask, one bit for each filter that it fails; a part of the corpus is then at most 2**n mask
cells, whatever its size (partial aggregates, so that a hot part costs no more than another). One task walks a part's n!
orders by adjacent transpositions: a swap changes only the two steps that it touches, whose figures are made anew from the
cells; all others stand as they were. The Shapley sum of each filter, its removals over all orders, accumulates along
the walk.

Defined results: null text is empty text; a null source is the part of the empty string; further columns are ignored;
a document of several labels has any of their marks; one without labels, or without an id, has none; rows without an id are never
copies, but are counted; rows that share an id share its labels; an empty table gives no rows, a part always all orders.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm.common import materialize, text_or_empty, unused

#: Of the text filters below.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, MARKS = 50, 65, 5, "#$%&*|"
SPACE = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: n filters have n! orders; more than these are not enumerated.
MOST_FILTERS = 8


def words(text: Column) -> Column:
    """The text's maximal runs of other than ASCII white space."""
    return F.array_remove(F.split(text, SPACE), "")


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask): bit i of mask is set if the document fails filter i of ABCDE.

    A: too few words; B: too few distinct words; C: too many capitals; D: marks; E: the text of a smaller id.
    """
    text = text_or_empty()
    list_of = words(F.col("_text"))
    facts = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("_text")).select(
        "doc_id", "part", F.sha2("_text", 256).alias("digest"), F.octet_length("_text").alias("bytes"), F.char_length("_text").alias("points"),
        F.char_length(F.translate("_text", CAPITALS, "")).alias("others"), F.col("_text").rlike(f"[{MARKS}]").alias("marked"), list_of.alias("_words"),
    )
    n, distinct = F.size("_words"), F.size(F.array_distinct("_words"))
    tests = [n < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * n, 100 * (F.col("points") - F.col("others")) > MOST_CAPITALS * F.col("points"), F.col("marked")]
    rows = materialize(facts.select("doc_id", "part", F.unhex("digest").alias("digest"), "bytes", mask_of(tests).alias("own")), "filter-masks")
    first = rows.groupBy("digest", "bytes").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = first.select(F.col("digest").alias("_digest"), F.col("bytes").alias("_bytes"), "first_id")
    met = rows.join(first, (F.col("digest") == F.col("_digest")) & (F.col("bytes") == F.col("_bytes")), "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    return met.select("doc_id", "part", (F.col("own") + F.when(copy, 1 << len(tests)).otherwise(0)).alias("mask"))


def mask_of(tests: list[Column]) -> Column:
    """The failed tests as bits; a test that gives null isn't failed."""
    bits = [F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests)]
    return sum(bits[1:], bits[0])


def cells(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, cells): for each part the counts of documents, good and toxic ones of each mask that occurs."""
    mark = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    key = unused(failed, "_labelled")
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(key)).agg(mark("quality").alias("good"), mark("toxic").alias("toxic"))
    counts = failed.join(known, F.col("doc_id") == F.col(key), "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")
    )
    return counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))


def transpositions(n: int) -> Iterator[int]:
    """Places i whose swap with i + 1 leads through all orders of n items: the largest item that can move moves on, and turns the larger ones."""
    order, ahead = list(range(n)), [-1] * n
    while True:
        place = {x: i for i, x in enumerate(order)}
        movable = [x for x in order if 0 <= place[x] + ahead[x] < n and order[place[x] + ahead[x]] < x]
        if not movable:
            return
        x = max(movable)
        i, j = place[x], place[x] + ahead[x]
        order[i], order[j] = order[j], order[i]
        for y in range(x + 1, n):
            ahead[y] = -ahead[y]
        yield min(i, j)


def walk(n: int, mask: np.ndarray, counts: np.ndarray) -> Iterator[tuple[tuple[int, ...], np.ndarray]]:
    """Each order with its steps' (kept, removed, good lost, toxic lost). counts: rows of (n, good, toxic) of the cells in mask."""
    def step(before: int, which: int) -> tuple[int, ...]:
        alive = mask & before == 0
        out = alive & (mask >> which & 1 == 1)
        removed = counts[out].sum(0)
        return int(counts[alive, 0].sum() - removed[0]), *removed.tolist()

    order, steps, before = list(range(n)), np.zeros((n, 4), "i8"), 0
    for i, x in enumerate(order):
        steps[i] = step(before, x)
        before |= 1 << x
    yield tuple(order), steps.copy()
    for i in transpositions(n):
        order[i], order[i + 1] = order[i + 1], order[i]
        before = sum(1 << x for x in order[:i])
        steps[i], steps[i + 1] = step(before, order[i]), step(before | 1 << order[i], order[i + 1])
        yield tuple(order), steps.copy()


def orders(parts: DataFrame, names: str) -> DataFrame:
    """One row for each part, order of the filters and step. parts: those of cells(); names: a letter for each filter."""
    n = len(names)
    if not 0 < n <= MOST_FILTERS:
        raise ValueError(f"the orders of 1 to {MOST_FILTERS} filters can be enumerated")
    figures = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

    def of(part: str, found: list[dict]) -> pa.RecordBatch:
        mask = np.array([c["mask"] for c in found], "i8")
        counts = np.array([[c["n"], c["good"], c["toxic"]] for c in found], "i8")
        fails = np.array([counts[mask >> f & 1 == 1, 0].sum() for f in range(n)], "i8")
        alone = np.array([counts[mask == 1 << f, 0].sum() for f in range(n)], "i8")
        shapley, seen, values = np.zeros(n, "i8"), [], []
        for order, steps in walk(n, mask, counts):
            at = np.array(order)
            shapley[at] += steps[:, 1]
            seen.append(order)
            values.append(np.column_stack([steps[:, 0], steps[:, 1], fails[at] - steps[:, 1], alone[at], steps[:, 2], steps[:, 3]]))
        flat = np.array(seen).ravel()
        table = np.column_stack([np.concatenate(values), shapley[flat]])
        texts = np.repeat(["".join(names[f] for f in order) for order in seen], n)
        rows = factorial(n) * n
        columns = [pa.array([part] * rows), pa.array(texts.tolist()), pa.array(np.tile(np.arange(1, n + 1, dtype="i4"), len(seen))), *(pa.array(c) for c in table.T.copy())]
        return pa.RecordBatch.from_arrays(columns, ["part", "filter_order", "step", *figures])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield of(part, found)

    return parts.select("part", "cells").mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in figures))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five text filters' audit by source."""
    return orders(cells(failures(docs), labels), "ABCDE")
