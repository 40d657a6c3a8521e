"""Merkle fixity audit of WARC replicas.

Pages become WARC records with an address (volume and offset). A replica's tree has the hashes of its records as leaves;
a node of level 0 hashes the records that start in one range of 64 KB, in the order of their offsets, and each node above
hashes up to 64 neighbouring ranges. Two replicas' roots are compared first; only children of nodes that differ are read
on the way down, and the records below the last differing ranges are compared one by one.

Defined results: null url or html is empty text; a null page_id is archived as such; equal rows are one record with a
number of copies; an empty table gives no records and a tree without nodes; further columns are ignored; a record of any
length is one leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.llm.common import materialize

#: A volume holds about this many bytes, so that its offsets are added up in one small task.
VOLUME_BYTES = 4 << 20
RANGE_BITS, FANOUT_BITS = 16, 6


def record(page_id: Column, url: Column, html: Column) -> Column:
    """A page as a WARC response record."""
    url, html = F.coalesce(url, F.lit("")), F.coalesce(html, F.lit(""))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "), url)
    return F.concat(head, F.lit("\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n"))


def records(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))


def addressed(leaves: DataFrame, volume_bytes: int = VOLUME_BYTES) -> DataFrame:
    """leaves (page_id, sha, length, ...) of equal records once, with copies, volume, offset and address."""
    others = [c for c in leaves.columns if c not in ("page_id", "sha", "length")]
    once = materialize(leaves.groupBy("page_id", "sha", "length").agg(F.count(F.lit(1)).alias("copies"), *(F.first(c).alias(c) for c in others)), "records")
    total = once.agg(F.sum("length").alias("n")).first()["n"] or 0
    volumes = max(1, -(-total // volume_bytes))
    volume = F.conv(F.substring("sha", 1, 8), 16, 10).cast("long") % volumes
    before = F.sum("length").over(Window.partitionBy("volume").orderBy("page_id", "sha").rowsBetween(Window.unboundedPreceding, -1))
    placed = once.withColumn("volume", volume).withColumn("offset", F.coalesce(before, F.lit(0)))
    placed = materialize(placed, "addressed")
    largest = placed.agg(F.max("offset").alias("n")).first()["n"] or 0
    return placed.withColumn("address", F.col("volume") * (1 << max(RANGE_BITS, largest.bit_length())) + F.col("offset"))


def tree(leaves: DataFrame) -> list[DataFrame]:
    """Levels of nodes (key, hash) over leaves (address, sha), from the ranges up to the root."""
    def level(children: DataFrame, key: Column, order: str) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct(order, "hash")))  # at most the records of one range, or the fan-out
        joined = F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", x[order].cast("string"), x["hash"])), ",")
        return materialize(children.groupBy(key.alias("key")).agg(F.sha2(joined, 256).alias("hash")), "merkle-level")

    levels = [level(leaves.select("address", F.col("sha").alias("hash")), F.shiftright("address", RANGE_BITS), "address")]
    largest = levels[0].agg(F.max("key").alias("n")).first()["n"] or 0
    while largest:
        levels.append(level(levels[-1].withColumnRenamed("key", "child"), F.shiftright("child", FANOUT_BITS), "child"))
        largest >>= FANOUT_BITS
    return levels


def _differing(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    both = a.select(key, F.col(value).alias("_a")).join(b.select(key, F.col(value).alias("_b")), key, "full_outer")
    return both.filter(~F.col("_a").eqNullSafe(F.col("_b")))


def differing_ranges(left: DataFrame, right: DataFrame) -> DataFrame:
    """(_range): ranges of addresses whose hashes differ between two replicas (address, sha), by descending from the roots."""
    a, b = tree(left), tree(right)
    top = max(len(a), len(b))
    empty = left.select(F.lit(0).cast("long").alias("key"), F.lit("").alias("hash")).limit(0)
    a, b = (x + [empty] * (top - len(x)) for x in (a, b))
    found = _differing(a[-1], b[-1], "key", "hash").select("key")
    for x, y in zip(a[-2::-1], b[-2::-1], strict=True):
        parents = materialize(found.withColumnRenamed("key", "_parent"), "merkle-differing")
        below = [d.join(parents, F.shiftright("key", FANOUT_BITS) == F.col("_parent"), "left_semi") for d in (x, y)]
        found = _differing(*below, "key", "hash").select("key")
    return materialize(found.withColumnRenamed("key", "_range"), "merkle-differing")


def _within(records: DataFrame, ranges: DataFrame) -> DataFrame:
    return records.join(ranges, F.shiftright("address", RANGE_BITS) == F.col("_range"), "left_semi")


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """(address, state) of the records of left (address, sha) that right has changed, lost ('missing') or only right has ('extra'), by address."""
    ranges = differing_ranges(left, right)
    state = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "extra").otherwise("changed")
    return _differing(_within(left, ranges), _within(right, ranges), "address", "sha").select("address", state.alias("state"))


def audit_records(left: DataFrame, right: DataFrame) -> DataFrame:
    """(address, state) of the records of left (page_id, address, sha) that right, with addresses of its own, has changed or lost.

    A lost record moves those behind it in its volume, whose ranges then differ too. Records of differing ranges are matched
    by their hashes, wherever they stand, and those that are left over by their ids.
    """
    ranges = differing_ranges(left.select("address", "sha"), right.select("address", "sha"))
    ours, theirs = (materialize(_within(x.select("page_id", "address", "sha"), ranges), "merkle-records") for x in (left, right))
    lost = ours.join(theirs.select(F.col("sha").alias("_sha")).distinct(), F.col("sha") == F.col("_sha"), "left_anti")
    other = theirs.join(ours.select(F.col("sha").alias("_sha")).distinct(), F.col("sha") == F.col("_sha"), "left_anti").select(F.col("page_id").alias("_id"), F.lit(True).alias("_there")).distinct()
    out = lost.join(other, F.col("page_id").eqNullSafe(F.col("_id")), "left")
    return out.select("address", F.when(F.col("_there"), "changed").otherwise("missing").alias("state"))


def report(pages: DataFrame, replica: Column | None = None) -> DataFrame:
    """Every record with its place and what the audit of a second replica says of it ('ok', 'changed' or 'missing').

    replica gives the replica's bytes of a record from the columns page_id and record (null: it has lost the record). Its
    volumes hold what is left of the same records in the same order, at offsets of their own.
    """
    rows = records(pages).withColumn("other", replica if replica is not None else F.col("record"))
    leaves = rows.select("page_id", F.sha2("record", 256).alias("sha"), F.octet_length("record").cast("long").alias("length"), F.sha2("other", 256).alias("other_sha"), F.octet_length("other").cast("long").alias("other_length"))
    placed = addressed(leaves)
    before = F.sum("other_length").over(Window.partitionBy("volume").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1))
    theirs = placed.filter("other_sha IS NOT NULL").select("page_id", F.col("other_sha").alias("sha"), (F.col("address") - F.col("offset") + F.coalesce(before, F.lit(0))).alias("address"))
    out = placed.join(audit_records(placed.select("page_id", "address", "sha"), materialize(theirs, "replica")), "address", "left")
    return out.select("page_id", "volume", "offset", "length", "copies", F.col("sha").alias("record_sha256"), F.coalesce("state", F.lit("ok")).alias("state"))
