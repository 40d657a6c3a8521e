"""Exact dedup with a log-structured merge index, in DataFrame operations only.

Every scan task is a memtable: its rows' digests are sorted and flushed as a file. The memtables of a batch make a run on the
first level: its distinct digests, each with the row of the smallest doc_id and the number of rows, and a filter of bounded size
(a bitmap of the digests' hashes) beside it. FANOUT runs of a level are compacted into one run of the next, so that a digest is
written once a level and not once a batch. Compaction intersects the runs' filters: digests that only one run can have are
carried over as they are, the others are shuffled and merged. Digests with several rows are hits: a filter made from them picks
the documents whose whole texts are compared byte for byte, and the rows that are looked up in the index; all other rows are
known to be alone. Only digests (and the texts of hits) are shuffled.

Defined results: null text is empty text; a null doc_id sorts after all others; of repeated rows with one doc_id and one
text exactly one is kept; an empty table gives an empty result; further columns are ignored by the index and stay in
``deduplicate``. Two texts with one digest stay apart, as the byte comparison decides.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm.common import KeyFilter, discard, filter_bits, materialize, numbered, shared_filter, text_or_empty, without

#: Memtables are added to the index in so many batches, each a run of the first level.
BATCHES = 4
#: So many runs of a level are compacted into one of the next.
FANOUT = 4


def normalised(name: str = "text") -> Column:
    """Text with each run of ASCII white space replaced by one space."""
    return F.regexp_replace(text_or_empty(name), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


class Run(NamedTuple):
    """A sorted run (digest, first, group_size) and the written rows of its filter; None without a filter."""

    rows: DataFrame
    bitmaps: DataFrame | None


def _first() -> Column:
    return F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id"))


class DigestIndex:
    """The digests of texts in levels of sorted runs."""

    def __init__(self, docs: DataFrame, digest: Callable[[Column], Column] = sha256, batches: int = BATCHES, row: str | None = None):
        self._digest, self._docs = digest, docs.select("doc_id", normalised().alias("norm"), (F.monotonically_increasing_id() if row is None else F.col(row)).alias("row_id"))
        self.memtables = self._flush(batches)
        self.bits = filter_bits(self.memtables.count())
        self.levels: list[list[Run]] = []
        for batch in range(batches):
            self._add(self._run(self.memtables.filter(F.col("batch") == batch)), 0)

    def _flush(self, batches: int) -> DataFrame:
        """Every scan task is a memtable, flushed in the folder of the batch that its number falls in."""
        rows = self._docs.select("doc_id", F.unhex(self._digest(F.col("norm"))).alias("digest"), F.unhex(sha256(F.col("norm"))).alias("sha"), "row_id", F.pmod(F.spark_partition_id(), F.lit(batches)).alias("batch"))
        return materialize(rows.sortWithinPartitions("batch", "digest"), "digest-memtables", by=["batch"])

    def _run(self, rows: DataFrame) -> Run:
        """The memtables of a batch as a run."""
        merged = rows.groupBy("digest").agg(_first().alias("first"), F.count(F.lit(1)).alias("group_size"))
        run = materialize(merged.sortWithinPartitions("digest"), "digest-run")
        bitmaps = KeyFilter(run, F.col("digest"), bits=self.bits).rows if self.bits else None
        return Run(run, None if bitmaps is None else materialize(bitmaps, "digest-filter"))

    def _add(self, run: Run, level: int) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == FANOUT:
            runs, self.levels[level] = self.levels[level], []
            self._add(self._compacted(runs), level + 1)

    def _compacted(self, runs: list[Run]) -> Run:
        """One run of several. Digests that only one of their filters has are not shuffled."""
        rows, key = runs[0].rows, F.col("digest")
        for run in runs[1:]:
            rows = rows.unionByName(run.rows)
        if self.bits:
            shared = materialize(shared_filter([run.bitmaps for run in runs]), "digest-filter")
            bitmaps = runs[0].bitmaps
            for run in runs[1:]:
                bitmaps = bitmaps.unionByName(run.bitmaps)
            bitmaps = materialize(bitmaps.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap")), "digest-filter")
            several = KeyFilter.of(shared, self.bits)
            alone, rows = several.surely_out(rows, key), several.maybe_in(rows, key)
        merged = rows.groupBy("digest").agg(F.min("first").alias("first"), F.sum("group_size").alias("group_size"))
        whole = materialize((merged.unionByName(alone) if self.bits else merged).sortWithinPartitions("digest"), "digest-run")
        discard(*(run.rows for run in runs))
        if self.bits:
            discard(shared, *(run.bitmaps for run in runs))
        return Run(whole, bitmaps if self.bits else None)

    def level(self) -> DataFrame:
        """All runs as one (digest, first, group_size): what is left on several levels is compacted."""
        runs = [run for level in self.levels for run in level]
        if len(runs) > 1:
            runs = [self._compacted(runs)]
            self.levels = [runs]
        return runs[0].rows

    def _verified(self, hits: KeyFilter) -> DataFrame:
        """Distinct whole texts of hits. Copies meet in the map tasks, before the shuffle."""
        digests = self._docs.select("norm", F.unhex(self._digest(F.col("norm"))).alias("digest"))
        return hits.maybe_in(digests, F.col("digest")).groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("n"))

    def resolve(self) -> DataFrame:
        """One row per document: doc_id, keep_id, group_size, kept, text_sha256, row_id."""
        several = materialize(self.level().filter("group_size > 1"), "digest-hits")
        hits, key = KeyFilter(several, F.col("digest")), F.col("digest")
        clashes = materialize(self._verified(hits).groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("digest"), "digest-clashes")
        rows = self.memtables.drop("batch")
        alone = hits.surely_out(rows, key).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "row_id")
        looked_up = hits.maybe_in(rows, key).join(several, "digest", "left")
        if clashes.isEmpty():
            return alone.unionByName(self._rows(looked_up))
        # The rows of clashing digests are merged once more, by the sha256 of the text that the byte comparison told apart.
        mixed = rows.join(clashes, "digest", "left_semi")
        again = mixed.groupBy("sha").agg(_first().alias("first"), F.count(F.lit(1)).alias("group_size"))
        return alone.unionByName(self._rows(looked_up.join(clashes, "digest", "left_anti"))).unionByName(self._rows(mixed.join(again, "sha")))

    @staticmethod
    def _rows(joined: DataFrame) -> DataFrame:
        """Rows with what the index has of their digest; without it, they are alone."""
        alone = F.col("first").isNull()
        kept = alone | (F.col("row_id") == F.col("first.row_id"))
        return joined.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "row_id")


def resolve_duplicates(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of docs with the row that stays for its text; see the module for the defined results."""
    return DigestIndex(docs, digest).resolve().drop("row_id")


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns: one for each text. Rows are told apart by their place; texts of rows that stay aren't shuffled."""
    rows, row = numbered(docs)
    gone = DigestIndex(rows, row=row).resolve().filter("NOT kept").select(F.col("row_id").alias(row))
    return without(rows, materialize(gone, "exact-copies"), row).select(*docs.columns)
