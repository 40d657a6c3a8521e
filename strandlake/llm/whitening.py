"""Embedding whitening by a tall-skinny QR: no covariance is formed.

Entries become whole numbers, so that the sums S over all n rows are exact, and so is n*x - S, the row centred and scaled by n. Each
partition folds its centred rows into one R factor; R factors are merged in a tree, FAN at a time, until one is left. Its
singular values s and right vectors give the eigenvalues s**2 / n and the components. What goes to the driver is of a fixed size:
sums, one R of d x d, and the k x k products that show how far the whitened rows' covariance is from the identity.

Defined results: vectors that are null or empty, or hold null or non-finite entries, are dropped, and so are vectors of
another length than most (of equally frequent lengths the largest counts); scaled entries are held within 2**62; rows are told apart by nothing, so ids may be null or repeat; components without variance are left out, so one
row, equal rows and an empty table give no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.common import discard, materialize

#: x = floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: R factors that one task merges, and rows that are folded at once.
FAN, ROWS = 8, 8192
#: Scaled entries are held within this.
MOST = 1 << 62


def vectors(rows: DataFrame, id_column: str, vector: str) -> tuple[DataFrame, int]:
    """(id, v): the usable vectors of the most frequent length, and that length (0 if there are none)."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    usable = rows.select(F.col(id_column).alias("id"), F.transform(vector, lambda c: c.cast("double")).alias("v"))
    usable = usable.filter(F.col("v").isNotNull() & (F.size("v") > 0)).filter(~F.exists("v", bad))
    most = usable.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    d = most["d"] if most else 0
    return usable.filter(F.size("v") == d), d


def whole_numbers(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """x of the batch's vectors, one row each."""
    values = batch.column(batch.schema.get_field_index("v")).flatten().to_numpy(zero_copy_only=False)
    return np.clip(np.floor(SCALE * values), -MOST, MOST).astype("i8").reshape(-1, d) + SHIFT


def sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of x by dimension. Halves of 32 bits are summed apart, so that no sum overflows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(d, "i8"), np.zeros(d, "i8")
        for batch in batches:
            x = whole_numbers(batch, d)
            n, high, low = n + len(x), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in ([n] * d, np.arange(d), high, low)], ["n", "i", "high", "low"])

    parts = rows.select("v").mapInArrow(run, "n long, i long, high long, low long").groupBy("i")
    found = parts.agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low"))).orderBy("i").collect()
    return int(found[0]["n"]), [(int(r["high"]) << 32) + int(r["low"]) for r in found]


def scaled(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n*x - S exactly: as 64-bit numbers if they fit, as whole numbers of any size otherwise."""
    s = np.array(total, object)
    if n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, total), default=0) < 1 << 62:
        return n * x - s.astype("i8")
    return n * x.astype(object) - s


def r_factors(rows: DataFrame, d: int, n: int, total: list[int]) -> DataFrame:
    """(part, r): for each partition the R factor of its centred rows, flat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        r = np.zeros((0, d))
        for batch in batches:
            x = whole_numbers(batch, d)
            for i in range(0, len(x), ROWS):
                r = np.linalg.qr(np.vstack([r, scaled(x[i : i + ROWS], n, total).astype("f8") / n]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], "int64"), pa.array([r.ravel()])], ["part", "r"])

    return rows.select("v").mapInArrow(run, "part long, r array<double>")


def merged(factors: DataFrame, d: int) -> DataFrame:
    """One R factor for each FAN neighbouring ones."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        stack = np.concatenate([c.flatten().to_numpy() for c in table.column("r").chunks]).reshape(-1, d)
        return pa.table({"part": pa.array([key[0].as_py()], "int64"), "r": [np.linalg.qr(stack, mode="r").ravel()]})

    return factors.withColumn("group", F.floor(F.col("part") / FAN)).groupBy("group").applyInArrow(run, "part long, r array<double>")


def fit(rows: DataFrame, d: int, n: int, total: list[int], k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The k first components (columns), their eigenvalues and the trace; fewer if the rows' rank is lower."""
    written = materialize(r_factors(rows, d, n, total), "r-factors")
    factors, last = written, written.agg(F.max("part")).first()[0]
    while last:
        factors, last = merged(factors, d), last // FAN
    _, s, vt = np.linalg.svd(np.array(factors.first()["r"]).reshape(-1, d), full_matrices=False)
    discard(written)
    rank = int((s > s[0] * max(n, d) * np.finfo(float).eps).sum()) if s[0] > 0 else 0
    e = s**2 / n
    k = min(k, rank)
    return vt[:k].T, e[:k], float(e.sum())


def whiten(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): each usable vector on each of the first k components.

    deviation is decimal(38, 0): for large n it doesn't fit a long.
    """
    kind = rows.schema[id_column].dataType.simpleString()
    schema = f"{id_column} {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    usable, d = vectors(rows, id_column, vector)
    if not d:
        return rows.sparkSession.createDataFrame([], schema)
    n, total = sums(usable, d)
    axes, e, trace = fit(usable, d, n, total, k)
    k = len(e)
    if not k:
        return rows.sparkSession.createDataFrame([], schema)
    projection = axes / np.sqrt(e)

    def project(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        apart = scaled(x, n, total)
        return apart, apart.astype("f8") / n @ projection

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((k + 1, k))
        for batch in batches:
            _, z = project(whole_numbers(batch, d))
            both[:k] += z.T @ z
            both[k] += z.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(both.size)), pa.array(both.ravel())], ["i", "p"])

    got = usable.select("v").mapInArrow(products, "i long, p double").groupBy("i").agg(F.sum("p").alias("p")).orderBy("i").collect()
    both = np.array([r["p"] for r in got]).reshape(k + 1, k) / n
    error = float(np.abs(both[:k] - np.outer(both[k], both[k]) - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Context

        exact = Context(prec=38)
        for batch in batches:
            x = whole_numbers(batch, d)
            apart, z = project(x)
            fits = d * int(np.abs(apart).max(initial=0)) ** 2 < 1 << 63
            squares = (apart**2).sum(1) if fits else (apart.astype(object) ** 2).sum(1)
            deviation = pa.array([exact.create_decimal(int(s)) if int(s) < 10**38 else None for s in squares], pa.decimal128(38, 0))
            take = np.repeat(np.arange(len(x)), k)
            flat = [batch.column(0).take(pa.array(take)), pa.array(np.tile(np.arange(1, k + 1, dtype="i4"), len(x))), pa.array(np.full(len(take), n)), deviation.take(pa.array(take))]
            more = [pa.array(z.ravel()), pa.array(np.tile(e / trace, len(x))), pa.array(np.full(len(take), error))]
            yield pa.RecordBatch.from_arrays(flat + more, [id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return usable.mapInArrow(run, schema)
