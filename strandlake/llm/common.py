"""Helpers shared by the corpus operators: tables, the shared work folder, row numbers and filters of bounded size."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import cache

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="strandlake-")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share: spark.checkpoint.dir, or on local masters, where it may be unset, an own one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _own_folder()
    return f"{root.rstrip('/')}/strandlake/{name}-{uuid.uuid4().hex}"


#: Bytes of rows that Python works on at once. Spark's own bounds are 10,000 rows and 64 MB, of which an executor holds several copies
#: for each task: the JVM's, grown by doubling, the worker's, that as Python strings, and both sides' of what comes back.
BATCH_BYTES = 4 << 20
BATCH_BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs herein gets its batches of about BATCH_BYTES, unless the session has a bound of its own."""
    if BATCH_BOUND in spark.conf.getAll:
        yield
        return
    spark.conf.set(BATCH_BOUND, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_BOUND)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches cut into parts of about BATCH_BYTES, for plans that run where the caller wants."""
    for batch in batches:
        step = max(1, batch.num_rows * BATCH_BYTES // max(1, batch.nbytes))
        for begin in range(0, batch.num_rows, step):
            yield batch.slice(begin, step)


def materialize(df: DataFrame, name: str, by: Sequence[str] = (), **options: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut and a lost executor costs no recomputation. by: last columns of df that make folders."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.options(**options).partitionBy(*by).parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written.work_path = path
    return written


def discard(*written: DataFrame) -> None:
    """Delete tables of materialize() that nothing will read any more."""
    for df in written:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.work_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more: it learns of them when the driver collects its garbage.

    For loops whose rounds shuffle much; without it their files lie on the executors' disks until the driver happens to collect.
    """
    gc.collect()
    spark._jvm.System.gc()


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


#: A filter never has more than 2**MAX_BITS bits (32 MB). With more than a quarter as many keys it is not made, and lets everything pass.
MAX_BITS = 28


def filter_bits(n: int, max_bits: int = MAX_BITS) -> int:
    """The size (as a power of two) of a filter for n keys; 0 if there should be none."""
    bits = min(max_bits, max(18, (16 * n).bit_length()))
    return bits if 4 * n <= 1 << bits else 0


class KeyFilter:
    """A bitmap of the hashes of keys, 16 bits for each of them, in rows of 4 KB; its size is bounded, so it may be broadcast.

    keys should be a written table, as it is counted first, unless the filter's bits are given. Null keys hash like any value.
    """

    def __init__(self, keys: DataFrame, key: Column, max_bits: int = MAX_BITS, bits: int | None = None):
        self.bits = filter_bits(keys.count(), max_bits) if bits is None else bits
        self.rows = None
        if self.bits:
            slot = self._slot(key)
            self.rows = keys.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap"))

    @classmethod
    def of(cls, rows: DataFrame, bits: int) -> KeyFilter:
        """The filter of the rows (bucket, bitmap) of another filter of that size."""
        made = cls.__new__(cls)
        made.bits, made.rows = bits, rows
        return made

    def _slot(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(1 << self.bits)) + 1

    def _probed(self, df: DataFrame, key: Column, how: str) -> tuple[DataFrame, Column]:
        slot = self._slot(key)
        # coalesce: columns that may be null would give a filter on them, pushed down to the scan, where the key would be made anew for each of them.
        probed = df.withColumns({"_kf_bucket": F.coalesce(F.bitmap_bucket_number(slot), F.lit(0)), "_kf_bit": F.coalesce(F.bitmap_bit_position(slot), F.lit(0))})
        filters = F.broadcast(self.rows.select(F.col("bucket").alias("_kf_own"), F.col("bitmap").alias("_kf_bitmap")))
        byte = F.conv(F.hex(F.expr("substring(_kf_bitmap, CAST(_kf_bit DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
        return probed.join(filters, F.col("_kf_bucket") == F.col("_kf_own"), how), byte.bitwiseAND(F.expr("shiftleft(1, CAST(_kf_bit % 8 AS INT))")) != 0

    def maybe_in(self, df: DataFrame, key: Column) -> DataFrame:
        """Rows of df whose key may be among the keys: all that are, and few others."""
        if self.rows is None:
            return df
        joined, there = self._probed(df, key, "inner")
        return joined.filter(there).drop("_kf_bucket", "_kf_bit", "_kf_own", "_kf_bitmap")

    def surely_out(self, df: DataFrame, key: Column) -> DataFrame:
        """The rows of df that maybe_in leaves out."""
        if self.rows is None:
            return df.limit(0)
        joined, there = self._probed(df, key, "left")
        return joined.filter(~F.coalesce(there, F.lit(False))).drop("_kf_bucket", "_kf_bit", "_kf_own", "_kf_bitmap")


def shared_filter(filters: list[DataFrame]) -> DataFrame:
    """The rows (bucket, bitmap) of a filter of what at least two filters have: the intersections of all pairs, united. All have one size."""
    n, rows = len(filters), None
    for i, bitmaps in enumerate(filters):
        pairs = F.explode(F.array(*(F.lit(min(i, j) * n + max(i, j)) for j in range(n) if j != i)))
        own = bitmaps.select(pairs.alias("pair"), "bucket", "bitmap")
        rows = own if rows is None else rows.unionByName(own)
    both = rows.groupBy("pair", "bucket").agg(F.bitmap_and_agg("bitmap").alias("bitmap"), F.count(F.lit(1)).alias("n")).filter("n = 2")
    return both.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def unused(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def is_scan(docs: DataFrame) -> bool:
    """Whether docs is files as they are read, with no operation upon them.

    Files' metadata alone don't tell: behind a filter, sort or repartition they can still be asked for.
    """
    plan = docs._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() != "LogicalRelation":
        return False
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        return False
    return True


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a number for each row, the same whenever it is read, and that column's name.

    A bare scan of files numbers its rows alike each time; anything else is written down first. How files are cut into
    partitions hangs on the number of cores unless a number is set, and cores go with lost executors, so one is set.
    """
    name, spark = unused(docs, "_row"), docs.sparkSession
    if not is_scan(docs):
        docs = materialize(docs, "numbered", compression="zstd")
    if not spark.conf.get("spark.sql.files.minPartitionNum", None):
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return docs.withColumn(name, F.monotonically_increasing_id()), name


def without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """rows whose key isn't in gone (a written table with the column key). Only rows that may be gone are shuffled."""
    known = KeyFilter(gone, F.col(key))
    away = gone.select(F.col(key).alias("_gone_key"))
    maybe = known.maybe_in(rows, F.col(key))
    return known.surely_out(rows, F.col(key)).unionByName(maybe.join(away, F.col(key) == F.col("_gone_key"), "left_anti"))
