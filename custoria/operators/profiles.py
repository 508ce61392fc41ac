"""Shared column statistics: all columns of a frame in one or two aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custoria.functions.columns import adjusted_kurtosis, adjusted_skewness, to_long


def measure(df: DataFrame, measures: dict[str, Column]) -> dict:
    """All named aggregates in one job."""
    if not measures:
        return {}
    row = df.agg(*[c.alias(f"m{i}") for i, c in enumerate(measures.values())]).first()
    return dict(zip(measures, row))


def comparable(df: DataFrame) -> DataFrame:
    """0.0 and -0.0 are one value: make them one text, too."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.col(c) + F.lit(0.0) for c in floats})


def value_frequencies(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value, n) over the non-null values; one shuffle for all columns."""
    long = to_long(comparable(df.select(*columns)), columns, "string").where("value is not null")
    return long.groupBy("feature", "value").agg(F.count("*").alias("n"))


def row_digest(df: DataFrame) -> list[Column]:
    """Two 64-bit digests of a whole row that tell nulls apart by their column."""
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in df.columns])
    cells = [F.col(f"`{c}`") for c in df.columns]
    return [F.xxhash64(nulls, *cells).alias("_a"), F.xxhash64(F.lit("second"), nulls, *cells).alias("_b")]


def duplicate_rows(df: DataFrame) -> int:
    """Rows minus distinct rows. Digests of 128 bits are shuffled, not the rows."""
    digests = comparable(df)
    counted = digests.select(*row_digest(digests)).groupBy("_a", "_b").agg(F.count("*").alias("_n"))
    return counted.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))).first()[0]


def numeric_moments(df: DataFrame, columns: list[str], wanted=("count", "mean", "std", "min", "max"), by: list[str] = ()) -> dict:
    """{column: {moment: value}}, or {(column, *by): ...}: long rows with one narrow aggregation.

    However many columns there are, the generated code stays small, partial sums combine
    before the shuffle and the columns finish in parallel.
    """
    if not columns:
        return {}
    v = F.col("value")
    rules = {
        "count": F.count(v), "mean": F.avg(v), "std": F.stddev_samp(v), "var_pop": F.var_pop(v), "var_samp": F.var_samp(v),
        "min": F.min(v), "max": F.max(v), "skewness": adjusted_skewness(v), "kurtosis": adjusted_kurtosis(v),
        "zeros": F.count_if(v == 0), "max_abs": F.max(F.abs(v)),
    }
    long = to_long(df, columns, "double", by)
    found = long.groupBy("feature", *by).agg(*[rules[w].alias(w) for w in wanted]).collect()
    out = {}
    for r in found:
        key = (r["feature"], *[r[b] for b in by]) if by else r["feature"]
        out[key] = {w: r[w] for w in wanted}
    for c in columns if not by else ():
        out.setdefault(c, {w: 0 if w in ("count", "zeros") else None for w in wanted})
    return out


def pearson(x: Column, y: Column) -> Column:
    """Correlation over the rows where both are known; null when one side is constant."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    spread = F.sqrt(F.var_pop(x)) * F.sqrt(F.var_pop(y))
    return F.when(spread > 0, F.try_divide(F.covar_pop(x, y), spread))


def correlations_with(df: DataFrame, target: str, columns: list[str]) -> dict[str, float | None]:
    """Correlation of every column with one target, from one narrow aggregation."""
    long = to_long(df.withColumn("_y", F.col(target).cast("double")), columns, "double", ["_y"])
    found = long.groupBy("feature").agg(pearson(F.col("value"), F.col("_y")).alias("r")).collect()
    return {c: None for c in columns} | {r["feature"]: r["r"] for r in found}


def correlations(df: DataFrame, columns: list[str]) -> dict[tuple[str, str], float | None]:
    """Correlations of all pairs of columns, each over the rows where both are known (NaN counts as unknown).

    One pass: every task adds up products of its Arrow batches, centred on the column means,
    and one row per pair and task is summed. Null where a side does not vary.
    """
    if len(columns) < 2:
        return {}
    means = df.agg(*[F.avg(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    centres, p = [m or 0.0 for m in means], len(columns)
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])

    def products(batches):
        import numpy as np
        import pyarrow as pa

        total = np.zeros((4, p, p))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) - np.array(centres)
            known = ~np.isnan(x)
            x, m = np.where(known, x, 0.0), known.astype(float)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        names = ["cell", "n", "sx", "sxx", "sxy"]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(p * p)), *[pa.array(t.ravel()) for t in total]], names=names)

    cells = values.mapInArrow(products, "cell bigint, n double, sx double, sxx double, sxy double")
    sums = {r[0]: r[1:] for r in cells.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sxx", "sxy")]).collect()}
    out = {}
    for i, j in ((i, j) for i in range(p) for j in range(i + 1, p)):
        n, sx, sxx, sxy = sums.get(i * p + j, (0.0,) * 4)
        _, sy, syy, _ = sums.get(j * p + i, (0.0,) * 4)
        spread = (n * sxx - sx * sx) * (n * syy - sy * sy) if n else 0.0
        # what rounding leaves of a constant column is no spread
        varies = n and n * sxx - sx * sx > 1e-13 * n * sxx and n * syy - sy * sy > 1e-13 * n * syy
        out[(columns[i], columns[j])] = (n * sxy - sx * sy) / spread**0.5 if varies and spread > 0 else None
    return out


def all_pairs(columns: list[str]) -> list[tuple[str, str]]:
    """Column name pairs in schema order (never rows)."""
    return [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]


def correlation_table(df: DataFrame, columns: list[str]) -> dict[tuple[str, str], float | None]:
    """All pairs of columns, pairwise complete, whatever their number."""
    return correlations(df, columns)


def null_and_distinct_counts(df: DataFrame, columns: list[str]) -> dict[str, tuple[int, int]]:
    """{column: (non-null rows, distinct values)}: one shuffle of (column, value) counts per kind of value."""
    kinds: dict[str, list[str]] = {}
    for f in df.schema:
        if f.name in columns:
            whole, real = isinstance(f.dataType, T.IntegralType), isinstance(f.dataType, T.FractionalType)
            real = real and not isinstance(f.dataType, T.DecimalType)
            kinds.setdefault("bigint" if whole else "double" if real else "string", []).append(f.name)
    out = {c: (0, 0) for c in columns}
    for kind, names in kinds.items():
        counted = to_long(df, names, kind).where("value is not null").groupBy("feature", "value").agg(F.count("*").alias("n"))
        per_column = counted.groupBy("feature").agg(F.sum("n").alias("known"), F.count("*").alias("values"))
        out |= {r["feature"]: (r["known"], r["values"]) for r in per_column.collect()}
    return out


# ---------------------------------------------------------------- sketches of distinct values

#: Binary logarithm of a sketch's registers; the standard error of an estimate is about 1.04 / 2 ** (REGISTERS / 2), here 1.6 %.
REGISTERS = 12


def column_sketches(df: DataFrame, columns: list[str], registers: int = REGISTERS) -> DataFrame:
    """(feature, known, sketch): non-null rows and a HyperLogLog sketch of each column's values, from one pass.

    Every task holds one sketch per column and only these are shuffled. Store the rows with an increment of a
    table and merge them with those of others by ``merged_sketches``.
    """
    plain = comparable(df.select(*[F.col(f"`{c}`") for c in columns]))
    sketches = plain.agg(*[x for i, c in enumerate(columns) for x in (
        F.count(F.col(f"`{c}`")).alias(f"n{i}"), F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), F.lit(registers)).alias(f"s{i}"))])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("known"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(columns)])
    return sketches.select(F.inline(rows))


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """One row per feature from the sketches of several parts; the same as those of the whole."""
    return sketches.groupBy("feature").agg(F.sum("known").alias("known"), F.hll_union_agg("sketch").alias("sketch"))


def sketched_counts(sketches: DataFrame) -> dict[str, tuple[int, int]]:
    """{feature: (non-null rows, estimated distinct values)}."""
    return {r["feature"]: (r["known"], r["values"]) for r in sketches.select("feature", "known", F.hll_sketch_estimate("sketch").alias("values")).collect()}
