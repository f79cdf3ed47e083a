"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings this library expects; all are ordinary Spark SQL options.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("dealglass")
    builder = builder.config("spark.driver.memory", memory)
    builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _local_base() -> str:
    """One temporary folder per process, for local sessions only."""
    return tempfile.mkdtemp(prefix="dealglass-")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for ``purpose`` under the session's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster the setting is required, since executors must see the files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_base()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
