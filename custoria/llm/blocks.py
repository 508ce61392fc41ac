"""Documents in blocks of bounded size that exchange packed keys with buckets.

A block is stored once, in a table bucketed by block, so that later steps find its text without
moving it again. What a block asks about its keys travels as compressed arrays, one row per
block and bucket, in place of one row per key; answers come back in the order of the keys.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custoria.llm.common import as_bytes
from custoria.session import workspace

#: Bytes of a block; its last document may go beyond. Buckets of the stored table at most; Spark allows 100,000.
BLOCK, TABLE_BUCKETS = 8 << 20, 50_000


def _forget(spark: SparkSession, name: str) -> None:
    """Take the table out of the catalogue, if the application still runs."""
    with contextlib.suppress(Exception):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def packed(values: np.ndarray) -> bytes:
    """Integers as compressed bytes, equal byte places together."""
    raw = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    return pa.compress(np.ascontiguousarray(raw).tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(raw.T).view("<u8").ravel()


def steps(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as differences; ``cumsum`` restores them."""
    return np.diff(keys, prepend=np.uint64(0))


def dealt(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of sorted ``keys`` by bucket, sorted within each, and where the buckets begin in it."""
    mixed = keys * np.uint64(0x9E3779B97F4A7C15)
    bucket = ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def record(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def stored(df: DataFrame, id_column: str, column: str, body: Callable[[bytes], bytes]) -> tuple[DataFrame, int]:
    """The table (id, block, body) of all rows, a null text as empty, and a number of buckets for its keys.

    The table lies in the workspace and is bucketed by block. A block is filled by one task in
    the order in which it reads; its number names the task's part and the place in it.
    """
    spark = df.sparkSession
    kept = df.select(F.col(id_column).alias("id"), F.col(column).alias("text"))
    total = kept.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(64, ceil(total / BLOCK))
    files = min(buckets, TABLE_BUCKETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 24
        block = size = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                bodies = [body(t or b"") for t in as_bytes(part.column(1))]
                numbers = []
                for data in bodies:
                    if size >= BLOCK:
                        block, size = block + 1, 0
                    numbers.append(first + block)
                    size += len(data) + 1
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(numbers, pa.int64()), pa.array(bodies, pa.binary())], names=["id", "block", "body"])

    filled = kept.mapInArrow(run, f"id {kept.schema['id'].dataType.simpleString()}, block long, body binary")
    name = f"blocks_{uuid.uuid4().hex}"
    filled.write.bucketBy(files, "block").option("path", workspace(spark)).saveAsTable(name)
    atexit.register(_forget, spark, name)
    return spark.table(name), buckets
