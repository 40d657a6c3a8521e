import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def _session() -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="spark-")
    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g", "spark.local.dir": scratch,
        "spark.checkpoint.dir": f"{scratch}/checkpoints", "spark.sql.warehouse.dir": f"{scratch}/warehouse", "spark.ui.showConsoleProgress": "false",
    }
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


SESSION = _session()  # before the tests are collected: some build columns at import


@pytest.fixture(scope="session")
def spark():
    return SESSION
