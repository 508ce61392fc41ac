"""Ranks and running totals over a whole column without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from custoria.functions.quantiles import BOUNDED_ROWS
from custoria.session import materialize


def running_totals(
    df: DataFrame, order: list[str], sums: list[str], segments: list[str] = (), bounded_rows: int = BOUNDED_ROWS
) -> DataFrame:
    """Add ``run_<s>``, the inclusive running sum of each column, along ``order`` per segment.

    ``(segments, order)`` must be unique. A table up to ``bounded_rows`` rows uses a
    plain window. A larger one is range-partitioned and written with its partition number;
    then only one total per (partition, segment) has to travel ahead.
    """
    segments = list(segments)
    small = materialize(df)
    if small.count() <= bounded_rows:
        keyed = small.withColumn("_one", F.lit(1))
        window = W.partitionBy("_one", *segments).orderBy(*order)
        return keyed.select(*small.columns, *[F.sum(s).over(window).alias(f"run_{s}") for s in sums])
    ranged = materialize(
        small.repartitionByRange(*segments, *order).withColumn("_part", F.spark_partition_id())
    )
    totals = ranged.groupBy("_part", *segments).agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    ahead = W.partitionBy(*(segments or [F.lit(1)])).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # only a segment that began in an earlier partition has an offset: at most one per partition
    offsets = totals.select("_part", *segments, *[F.sum(f"_t_{s}").over(ahead).alias(f"_o_{s}") for s in sums])
    offsets = materialize(offsets.where(F.col(f"_o_{sums[0]}").isNotNull()))
    inner = W.partitionBy("_part", *segments).orderBy(*order)
    out = ranged.join(F.broadcast(offsets), ["_part", *segments], "left")
    return out.select(
        *small.columns, *[(F.sum(s).over(inner) + F.coalesce(f"_o_{s}", F.lit(0))).alias(f"run_{s}") for s in sums]
    )


def row_positions(df: DataFrame, order: list[str], bounded_rows: int = BOUNDED_ROWS) -> DataFrame:
    """Add ``position`` 1..n under a total order; ties must be broken by ``order``."""
    stored = materialize(df)
    if stored.count() <= bounded_rows:
        window = W.partitionBy("_one").orderBy(*order)
        return stored.withColumn("_one", F.lit(1)).withColumn("position", F.row_number().over(window).cast("bigint")).drop("_one")
    ranged = materialize(
        stored.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    )
    part, inner = F.shiftright("_m", 33), F.col("_m").bitwiseAND((1 << 33) - 1)
    totals = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    ahead = W.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_o"))
    out = ranged.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return out.select(*stored.columns, (F.col("_o") + inner + 1).alias("position"))


def _places(rows: DataFrame, bounded_rows: int) -> DataFrame:
    """(_key, feature, before, ties) of rows (_key, feature, value): how many values of the feature are smaller, and how many equal.

    A larger table is ranged by value and key, so a value that very many rows share is spread over
    several parts. Only a part's first and last value can go on in others; these are added up apart.
    """
    rows = materialize(rows)
    inside, same = W.partitionBy("feature").orderBy("value"), W.partitionBy("feature", "value")
    if rows.count() <= bounded_rows:
        return rows.select("_key", "feature", (F.rank().over(inside) - 1).cast("long").alias("before"), F.count("*").over(same).alias("ties"))
    ranged = materialize(rows.repartitionByRange("feature", "value", "_key").withColumn("_part", F.spark_partition_id()))
    parts = ranged.groupBy("feature", "_part").agg(F.count("*").alias("_n"), F.min("value").alias("_low"), F.max("value").alias("_high"))
    ahead = W.partitionBy("feature").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # one row per part, and per feature that ends in it
    parts = F.broadcast(materialize(parts.withColumn("_offset", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))))
    joined = ranged.join(parts, ["feature", "_part"])
    edges = joined.where("value = _low OR value = _high").groupBy("feature", "_part", "value").agg(
        F.count("*").alias("_ties"), F.first("_n").alias("_n"), F.first("_low").alias("_low"), F.first("_offset").alias("_offset")
    )
    first = F.col("_offset") + F.when(F.col("value") == F.col("_low"), 0).otherwise(F.col("_n") - F.col("_ties"))
    edges = edges.groupBy("feature", "value").agg(F.sum("_ties").alias("_all"), F.min(first).alias("_first"))
    edges = F.broadcast(materialize(edges))  # at most two rows per part and feature
    inside, same = W.partitionBy("feature", "_part").orderBy("value"), W.partitionBy("feature", "_part", "value")
    placed = joined.select("_key", "feature", "value", (F.col("_offset") + F.rank().over(inside) - 1).alias("_before"), F.count("*").over(same).alias("_same"))
    placed = placed.join(edges, ["feature", "value"], "left")
    return placed.select("_key", "feature", F.coalesce("_first", "_before").alias("before"), F.coalesce("_all", "_same").alias("ties"))


def attach_percent_ranks(df: DataFrame, columns: dict[str, str], bounded_rows: int = BOUNDED_ROWS) -> DataFrame:
    """Add one percent-rank column per entry of {source column: output name}: the average rank of ties over the
    count of values. Null stays null; infinite values and NaN, the largest of all, get their known rank from counts.

    The rows are stored once under a key of their own. Ranks come back by one join on that key.
    """
    stored = materialize(df.withColumn("_key", F.monotonically_increasing_id()))
    value = {c: F.col(c).cast("double") for c in columns}
    counts = stored.agg(*[
        f.alias(f"{i}_{kind}") for i, c in enumerate(columns)
        for kind, f in (("all", F.count(c)), ("inf", F.count_if(value[c] == float("inf"))), ("nan", F.count_if(F.isnan(value[c]))))
    ]).first()
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), value[c].alias("value")) for c in columns])
    finite = stored.select("_key", F.inline(pairs)).where(F.col("value") < float("inf"))
    rank = F.col("before") + (F.col("ties") + 1) / 2
    ranks = _places(finite, bounded_rows).groupBy("_key").agg(*[F.max(F.when(F.col("feature") == c, rank)).alias(n) for c, n in columns.items()])
    out = stored.join(ranks, "_key", "left")
    for i, (c, name) in enumerate(columns.items()):
        size, inf, nan = (counts[f"{i}_{kind}"] for kind in ("all", "inf", "nan"))
        known = F.when(F.isnan(value[c]), F.lit(size - nan + (nan + 1) / 2)).when(value[c] == float("inf"), F.lit(size - nan - inf + (inf + 1) / 2))
        out = out.withColumn(name, known.otherwise(F.col(name)) / max(size, 1))
    return out.drop("_key")
