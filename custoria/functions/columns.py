"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
TEMPORAL = (T.TimestampType, T.TimestampNTZType, T.DateType)


def instant(value: str | date | datetime) -> Column:
    """A zone-free timestamp literal."""
    return F.lit(str(value)).cast("timestamp_ntz")


def days_before(as_of, days: int) -> Column:
    return instant(as_of) - F.expr(f"INTERVAL {days} DAYS")


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole elapsed days; a negative span rounds towards minus infinity."""
    whole = F.timestamp_diff("DAY", start, end)
    return F.when(F.timestamp_add("DAY", whole, start) > end, whole - 1).otherwise(whole)


def is_true(condition: Column) -> Column:
    """Null counts as false, so that negating keeps rows whose value is unknown."""
    return F.coalesce(condition, F.lit(False))


def right_closed(value: Column, edges: list[float], labels: list[str]) -> Column:
    """Label of the (low, high] bin holding ``value``; null outside all bins."""
    out = F.when(value.isNull() | (value <= edges[0]), F.lit(None).cast("string"))
    for high, label in zip(edges[1:], labels):
        out = out.when(F.lit(True) if high == float("inf") else value <= high, label)
    return out


def quantile_bin(value: Column, inner_edges: list[float]) -> Column:
    """1 + number of inner edges below the value: right-closed quantile bins."""
    bin_no = F.lit(1)
    for edge in inner_edges:
        bin_no = bin_no + F.when(value > F.lit(float(edge)), 1).otherwise(0)
    return F.when(value.isNotNull(), bin_no)


def rank_bin(rank: Column, n: Column | int, bins: int) -> Column:
    """Quantile bin of rank 1..n in integer arithmetic: ceil(bins*(r-1)/(n-1)), at least 1."""
    n = F.lit(n) if isinstance(n, int) else n
    steps = (rank - 1) * bins
    ceiling = F.call_function("div", steps + n - 2, F.greatest(n - 1, F.lit(1)))
    return F.greatest(F.lit(1), F.when(n <= 1, F.lit(1)).otherwise(ceiling)).cast("int")


def adjusted_skewness(value: Column | str) -> Column:
    """Bias-adjusted sample skewness; null below three values, 0 for a constant column."""
    value = F.col(value) if isinstance(value, str) else value
    n = F.count(value).cast("double")
    adjusted = F.skewness(value) * F.sqrt(n * (n - 1)) / (n - 2)
    return F.when(n >= 3, F.when(F.max(value) == F.min(value), F.lit(0.0)).otherwise(adjusted))


def adjusted_kurtosis(value: Column | str) -> Column:
    """Bias-adjusted excess kurtosis; null below four values, 0 for a constant column."""
    value = F.col(value) if isinstance(value, str) else value
    n = F.count(value).cast("double")
    adjusted = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(value) + 6)
    return F.when(n >= 4, F.when(F.max(value) == F.min(value), F.lit(0.0)).otherwise(adjusted))


def column_suffix(value: str) -> str:
    return str(value).lower().replace(" ", "_")


def hash_order(*keys: Column | str, seed: int) -> Column:
    """Reproducible pseudo-random sort key: md5 over the key columns and the seed."""
    parts = [F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def hash_unit(*keys: Column | str, seed: int) -> Column:
    """Reproducible number in [0, 1) from the first 32 bits of ``hash_order``."""
    return F.conv(F.substring(hash_order(*keys, seed=seed), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Numeric columns in schema order; flags (booleans) are not numeric."""
    return [f.name for f in df.schema if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def temporal_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, TEMPORAL)]


def to_long(df: DataFrame, columns: list[str], kind: str, keep=()) -> DataFrame:
    """(keep..., feature, value) rows of the given columns cast to one type."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast(kind).alias("value")) for c in columns])
    return df.select(*keep, F.explode(pairs).alias("_p")).select(*keep, "_p.feature", "_p.value")
