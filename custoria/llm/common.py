"""Helpers shared by the text operators: Arrow columns, digests, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custoria.session import materialize

#: Rows per Arrow batch that leaves a task, so that wide results stay small in memory.
ROWS_OUT = 512
#: Narrow rows of a partition where a table is gathered.
ROWS_TOGETHER = 100_000


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column without decoding them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    return column.cast(pa.binary()).to_pylist()


def rows_of(df: DataFrame, text: str, **named: str) -> DataFrame:
    """The column ``text`` and, in the column ``row``, all others, next to single ones under names of the
    caller's choice; so a column of the table never clashes with one that an operator adds."""
    rest = [df[c] for c in df.columns if c != text] or [F.lit(None).alias("none")]
    return df.select(F.struct(*rest).alias("row"), df[text].alias("text"), *[df[c].alias(n) for n, c in named.items()])


def columns_of(columns: list[str], text: str) -> list[Column]:
    """The columns of a table again from what ``rows_of`` made of it."""
    return [(F.col("text") if c == text else F.col("row")[c]).alias(c) for c in columns]


def map_batches(df: DataFrame, columns: list[str], fn: Callable[[pa.RecordBatch], pa.RecordBatch], fields: list[T.StructField]) -> DataFrame:
    """``columns`` of ``df`` followed by what ``fn`` adds to each slice of a batch.

    ``fn`` gets at most ROWS_OUT rows and returns the arrays of ``fields`` in order. Rows
    never change places, so nothing is shuffled.
    """
    kept = df.select(*[df[c] for c in columns])
    schema = T.StructType([*kept.schema.fields, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in schema.fields]
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(start, ROWS_OUT)
                yield pa.RecordBatch.from_arrays([*part.columns, *fn(part)], names=names)

    return kept.mapInArrow(run, schema)


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of ``rows`` narrow rows in as few partitions as hold them: many small steps over it then need few tasks."""
    return df.coalesce(max(1, -(-rows // ROWS_TOGETHER)))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of the links (a, b) as rows (node, component).

    ``component`` is the smallest node that can be reached. Each round points every node
    at the smallest of its neighbours, first among the larger and then among the smaller
    ones (two aggregations and joins); the number of rounds grows with the logarithm of the
    longest chain. A hub's links are joined as rows, never gathered. Nodes without a
    link are not returned; links with a null end are ignored, and so are loops.
    """
    links = materialize(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()

    before = state(links)
    links = gathered(links, before[0])
    for _ in range(rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select("a", F.col("m").alias("b")).unionByName(small.select(F.col("b").alias("a"), F.col("m").alias("b")))
        links = materialize(small.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        now = state(links)
        if now == before:
            break
        before = now
        links = gathered(links, now[0])
    else:
        raise RuntimeError("components did not settle")
    leaves = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.unionByName(roots)
