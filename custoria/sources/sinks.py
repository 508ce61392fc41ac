"""Sinks: parquet zones, CSV, JSON reports, tables and saved stages."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Spelling of the write modes.
TABLE_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}
INSERT_BATCH = 10_000


def write_parquet(df: DataFrame, path: str, partition_by: list[str] = ()) -> DataFrame:
    """Snappy parquet, replacing what was there; returns the stored table."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path, compression="snappy")
    return df.sparkSession.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").option("header", True).csv(path)
    return df.sparkSession.read.schema(df.schema).option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").json(path)
    return df.sparkSession.read.schema(df.schema).json(path)


def write_table(df: DataFrame, table: str, if_exists: str = "append", path: str | None = None) -> DataFrame:
    """Write rows to a named table: ``fail``, ``replace`` or ``append`` when it exists."""
    writer = df.write.mode(TABLE_MODES[if_exists])
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def write_jdbc(df: DataFrame, url: str, table: str, if_exists: str = "append", **options) -> None:
    df.write.format("jdbc").mode(TABLE_MODES[if_exists]).options(
        url=url, dbtable=table, batchsize=INSERT_BATCH, **options
    ).save()


MANIFEST = "manifest"


@dataclass(frozen=True)
class Manifest:
    """What a finished stage consists of; it is written after all its tables."""

    id: str
    stage: str
    inputs: list[str]  # the manifests that the stage was built from
    parameters: dict[str, str]
    rows: dict[str, int]


def _removed(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def save_stage(
    tables: dict[str, DataFrame], root: str, stage: str, inputs: list[str] = (), parameters: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """Store each table of a stage, then its manifest, and continue from the stored form.

    An older manifest goes first, so a stage that breaks off in between is never taken for finished. Rows are
    counted while they are written.
    """
    spark = next(iter(tables.values())).sparkSession
    _removed(spark, f"{root}/{stage}/{MANIFEST}")
    stored, rows = {}, {}
    for name, df in tables.items():
        seen = Observation()
        stored[name] = write_parquet(df.observe(seen, F.count(F.lit(1)).alias("rows")), f"{root}/{stage}/{name}")
        rows[name] = seen.get["rows"]
    record = Manifest(uuid.uuid4().hex, stage, list(inputs), dict(parameters or {}), rows)
    line = spark.createDataFrame([(json.dumps(asdict(record)),)], "value string")
    line.coalesce(1).write.text(f"{root}/{stage}/{MANIFEST}")
    return stored


def stage_manifest(spark: SparkSession, root: str, stage: str) -> Manifest | None:
    """The manifest of a stage that was finished; None where there is none or a table has other rows than it says."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{stage}/{MANIFEST}/_SUCCESS")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    found = Manifest(**json.loads(spark.read.text(f"{root}/{stage}/{MANIFEST}").first()[0]))
    try:
        counted = {name: spark.read.parquet(f"{root}/{stage}/{name}").count() for name in found.rows}
    except AnalysisException:  # a table is gone
        return None
    return found if counted == found.rows else None


def load_stage(spark: SparkSession, root: str, stage: str, names: list[str]) -> dict[str, DataFrame]:
    """Tables of an earlier stage, to resume after it."""
    return {name: spark.read.parquet(f"{root}/{stage}/{name}") for name in names}
