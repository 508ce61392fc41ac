"""Session settings, the shared workspace and lineage cuts."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings every operator here relies on; a cluster's own settings may add to them.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_used: set[str] = set()


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("custoria")
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def workspace(spark: SparkSession) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, as in tests, the warehouse serves, which executors share as well. All
    folders of an application lie in one, which is removed when the application's Python ends.
    """
    root = (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    own = f"{root}/custoria-{spark.sparkContext.applicationId}"
    if own not in _used:
        _used.add(own)
        atexit.register(_remove, spark, own)
    return f"{own}/{uuid.uuid4().hex}"


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of stored tables, if the application still runs."""
    with contextlib.suppress(Exception):
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of a query are deleted when it ends, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the workspace once and read it back.

    Used where several later passes need the same intermediate table: each pass then
    scans (and prunes) parquet in place of repeating the upstream shuffles, and a lost
    executor costs a re-read.
    """
    path = workspace(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
