"""Categorical encoders: parameter tables fitted by aggregation, applied by projection or join.

Tables that are joined back are stored first: the join then knows their real size and
broadcasts them only below Spark's own limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from custoria import constants as K
from custoria.functions.columns import string_columns, to_long
from custoria.functions.ranking import row_positions
from custoria.session import materialize

# Smoothing of the target mean.
TARGET_MIN_SAMPLES = 20.0
TARGET_SMOOTHING = 10.0


def distinct_counts(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """Exact distinct non-null values per column in one job."""
    if not columns:
        return {}
    pairs = to_long(df, columns, "string").where("value is not null").distinct()
    found = {r["feature"]: r["n"] for r in pairs.groupBy("feature").agg(F.count("*").alias("n")).collect()}
    return {c: found.get(c, 0) for c in columns}


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code): 0..k-1 in value order. Any number of values: the order is built in ranges."""
    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("_value")).distinct()
    return row_positions(values, ["_value"]).select("_value", (F.col("position") - 1).cast("int").alias("_code"))


def encode_label(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Position of the value in sorted order; null stays null."""
    codes = materialize(category_codes(df, column)).withColumnRenamed("_code", name or f"{column}_encoded")
    return df.join(codes, F.col(column).cast("string") == F.col("_value"), "left").drop("_value")


def encode_ordinal(df: DataFrame, columns: list[str], suffix: str = "_ordinal") -> DataFrame:
    out = df
    for c in columns:
        out = encode_label(out, c, f"{c}{suffix}")
    return out


def listed_values(df: DataFrame, columns: list[str], limit: int = K.HIGH_CARDINALITY) -> dict[str, list[str]]:
    """Sorted values per column for those with at most ``limit`` of them; one job, k+1 values at most travel."""
    pairs = to_long(df, columns, "string").where("value is not null").distinct()
    rank = F.row_number().over(W.partitionBy("feature").orderBy("value"))
    rows = pairs.withColumn("_r", rank).where(F.col("_r") <= limit + 1).collect()
    out: dict[str, list[str]] = {c: [] for c in columns}
    for r in rows:
        out[r["feature"]].append(r["value"])
    return {c: sorted(v) for c, v in out.items()}


def onehot_columns(column: str, values: list[str]) -> dict[str, Column]:
    """One flag per sorted value but the first; null rows are all false."""
    return {f"{column}_{v}": F.coalesce(F.col(column) == v, F.lit(False)) for v in values[1:]}


def encode_onehot(df: DataFrame, columns: list[str], limit: int = K.HIGH_CARDINALITY) -> DataFrame:
    flags: dict[str, Column] = {}
    for c, values in listed_values(df, columns, limit).items():
        if len(values) > limit:
            raise ValueError(f"{c} has more than {limit} values; use the target or hashing encoder")
        flags |= onehot_columns(c, values)
    return df.withColumns(flags)


def target_means(
    df: DataFrame, column: str, label: str, min_samples: float = TARGET_MIN_SAMPLES, smoothing: float = TARGET_SMOOTHING
) -> tuple[DataFrame, float]:
    """(value, encoding) and the overall mean.

    The category mean counts more the more rows it has, by a sigmoid in the row count;
    a category of one row takes the overall mean.
    """
    prior = df.agg(F.avg(F.col(label).cast("double"))).first()[0]
    stats = df.groupBy(F.col(column).alias("_value")).agg(F.count(label).alias("_n"), F.avg(F.col(label).cast("double")).alias("_m"))
    weight = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("_n") - min_samples) / smoothing))
    blended = F.when(F.col("_n") <= 1, F.lit(prior)).otherwise(F.lit(prior) * (1 - weight) + F.col("_m") * weight)
    return stats.select("_value", blended.alias("_encoding")), prior


def encode_target(df: DataFrame, column: str, label: str, fit_on: DataFrame | None = None, name: str | None = None, **smooth) -> DataFrame:
    """Smoothed label mean per category, fitted on ``fit_on`` (the training rows) when given."""
    means, prior = target_means(fit_on if fit_on is not None else df, column, label, **smooth)
    joined = df.join(materialize(means), F.col(column).eqNullSafe(F.col("_value")), "left")
    return joined.withColumn(name or f"{column}_target_encoded", F.coalesce("_encoding", F.lit(prior))).drop("_value", "_encoding")


def encode_binary(df: DataFrame, column: str) -> DataFrame:
    """1-based category code spread over bit columns, highest bit first; 0 for null."""
    coded = encode_label(df, column, "_code0")
    width = max(1, int(distinct_counts(df, [column])[column]).bit_length())
    code = F.coalesce(F.col("_code0") + 1, F.lit(0))
    bits = {f"{column}_{i}": F.shiftright(code, width - 1 - i).bitwiseAND(F.lit(1)) for i in range(width)}
    return coded.withColumns(bits).drop("_code0")


def hash_bucket(value: Column, buckets: int) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def encode_hashing(df: DataFrame, columns: list[str], buckets: int = K.HASH_COLUMNS) -> DataFrame:
    """How many of the row's values fall into each hash bucket."""
    placed = [F.when(F.col(c).isNotNull(), hash_bucket(F.col(c).cast("string"), buckets)) for c in columns]
    counts = {}
    for b in range(buckets):
        total = F.lit(0)
        for p in placed:
            total = total + F.coalesce((p == b).cast("int"), F.lit(0))
        counts[f"hash_{b}"] = total
    return df.withColumns(counts)


def encode_auto(df: DataFrame, label: str | None = "churned", skip=("customer_id",), limit: int = K.HIGH_CARDINALITY) -> DataFrame:
    """Two values: code; up to ``limit``: one-hot; more: target mean, or code without a label."""
    columns = string_columns(df, skip)
    if not columns:
        return df
    values = listed_values(df, columns, limit)
    out, flags = df, {}
    for c in columns:
        n = len(values[c])
        if n == 2:
            code = F.when(F.col(c) == values[c][0], 0).when(F.col(c) == values[c][1], 1)
            flags[f"{c}_encoded"] = code
        elif n <= limit:
            flags |= onehot_columns(c, values[c])
    out = out.withColumns(flags)
    for c in columns:
        if len(values[c]) > limit:
            has_label = label is not None and label in df.columns
            out = encode_target(out, c, label) if has_label else encode_label(out, c, f"{c}_label_encoded")
    return out
