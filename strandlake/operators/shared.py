"""The folder that all executors share, and tables written there to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

#: Rows of one task of dealt().
TASK_ROWS = 500_000


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="strandlake-")


def work_path(spark: SparkSession, name: str = "work") -> str:
    """A new path under spark.checkpoint.dir; on local masters, where that may be unset, under a folder of the machine's own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
        root = _own_folder()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/strandlake/{name}-{uuid.uuid4().hex}"


def dealt(df: DataFrame, *by: str, rows: int | None = None) -> DataFrame:
    """df dealt out to as many tasks as its rows ask for, by the values of the columns by or evenly.

    A set number of shuffle partitions, or a file with one row group, would let one task's share grow with the table. Rows are counted first.
    """
    return df.repartition(tasks_for(df, rows), *by)


def tasks_for(df: DataFrame, rows: int | None = None) -> int:
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // (rows or TASK_ROWS)))


def written(df: DataFrame, name: str) -> DataFrame:
    """df written down and read again: what follows doesn't compute it anew, and a lost executor loses nothing of it."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
