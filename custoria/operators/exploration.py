"""Exploratory reports: profiles, correlations, segment rates, tests and the data behind the charts."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from custoria import constants as K
from custoria.functions.columns import numeric_columns, string_columns, to_long
from custoria.functions.distributions import chi_square_tail, t_two_sided
from custoria.functions.quantiles import exact_quantiles
from custoria.operators.profiles import (
    correlation_table, correlations_with, duplicate_rows, measure, null_and_distinct_counts, numeric_moments, value_frequencies,
)
from custoria.operators.scores import top_k_per_group

KEY = "customer_id"
MAX_CLASSES = 50


def overview(df: DataFrame) -> DataFrame:
    """Per column: nulls, their share, distinct values and the two warning lists."""
    texts, spreads = string_columns(df), numeric_moments(df, numeric_columns(df), ("std",))
    counts, n, repeated = null_and_distinct_counts(df, df.columns), df.count(), duplicate_rows(df)
    rows = []
    for c in df.columns:
        std, (known, unique) = spreads.get(c, {}).get("std"), counts[c]
        rows.append((
            c, n, repeated, n - known, 100.0 * (n - known) / n if n else 0.0, unique,
            std is not None and std < K.MIN_STDDEV, c in texts and unique > 0.5 * n,
        ))
    return df.sparkSession.createDataFrame(
        rows, "feature string, rows bigint, duplicate_rows bigint, nulls bigint, missing_pct double, distinct_values bigint, "
        "zero_variance boolean, high_cardinality boolean",
    )


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Class counts and shares; for two classes also the majority ratio and the entropy in bits."""
    counts = df.where(F.col(target).isNotNull()).groupBy(F.col(target).alias("class")).agg(F.count("*").alias("n"))
    whole = W.partitionBy(F.lit(1))  # one row per class
    share, two = F.col("n") / F.sum("n").over(whole), F.count("*").over(whole) == 2
    out = counts.withColumns({
        "percentage": share * 100,
        "class_ratio": F.when(two, F.round(F.max("n").over(whole) / F.min("n").over(whole), 2)),
        "_bits": F.when(two, -share * F.log2(share)),
    })
    return out.withColumn("entropy", F.sum("_bits").over(whole)).drop("_bits")


def numeric_profile(df: DataFrame, columns: list[str] | None = None, target: str | None = None, limit: int | None = None) -> DataFrame:
    """Moments, quartiles, zeros and distinct values of the numeric columns, or of the first ``limit``."""
    columns = (columns or numeric_columns(df, {target}))[:limit]
    moments = numeric_moments(df, columns, ("count", "mean", "std", "min", "max", "skewness", "kurtosis", "zeros"))
    quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns}, counts={c: moments[c]["count"] for c in columns})
    distinct = null_and_distinct_counts(df, columns)
    rows = []
    for c in columns:
        m, (q1, q2, q3) = moments[c], quartiles[c]
        rows.append((c, m["mean"], q2, m["std"], m["min"], m["max"], q1, q3, m["skewness"], m["kurtosis"], m["zeros"], distinct[c][1]))
    return df.sparkSession.createDataFrame(
        rows, "feature string, mean double, median double, std double, min double, max double, q25 double, q75 double, "
        "skewness double, kurtosis double, zeros bigint, distinct_values bigint",
    )


def categorical_profile(df: DataFrame, columns: list[str] | None = None, limit: int | None = None, top: int = 10) -> DataFrame:
    """The ``top`` values of the text columns (or the first ``limit``), with distinct, missing and the mode."""
    columns = (columns or string_columns(df, {KEY}))[:limit]
    counts = value_frequencies(df, columns)
    nulls = measure(df, {c: F.count_if(F.col(c).isNull()) for c in columns})
    missing = df.sparkSession.createDataFrame(list(nulls.items()), "feature string, missing bigint")  # one row per column
    # partial aggregation leaves one row per task and feature before the final sums
    totals = counts.groupBy("feature").agg(
        F.count("*").alias("distinct_values"), F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode")
    )
    best = top_k_per_group(counts, ["feature"], [F.desc("n"), F.col("value")], top)
    return best.join(totals, "feature").join(F.broadcast(missing), "feature")


def correlation_pairs(df: DataFrame, columns: list[str] | None = None, threshold: float = K.REPORT_PAIR_CORRELATION) -> DataFrame:
    """Strongly correlated pairs with the mean and largest absolute entry of the whole matrix."""
    columns = columns or numeric_columns(df)
    table = correlation_table(df, columns)
    known = [abs(v) for v in table.values() if v is not None]
    constant = _constant_columns(df, columns)
    ones = len(columns) - len(constant)
    mean = (2 * sum(known) + ones) / (2 * len(known) + ones) if known or ones else None
    largest = max([1.0] * bool(ones) + known) if known or ones else None
    rows = [(a, b, round(v, 3), mean, largest) for (a, b), v in table.items() if v is not None and abs(v) > threshold]
    return df.sparkSession.createDataFrame(
        rows, "feature1 string, feature2 string, correlation double, mean_correlation double, max_correlation double"
    )


def _constant_columns(df: DataFrame, columns: list[str]) -> list[str]:
    spreads = numeric_moments(df, columns, ("var_pop",))
    return [c for c in columns if not spreads[c]["var_pop"]]


def target_correlations(df: DataFrame, target: str, columns: list[str] | None = None, k: int = 20) -> list[tuple[str, float]]:
    """Columns by absolute correlation with the target, strongest first."""
    columns = [c for c in columns or numeric_columns(df) if c != target]
    known = [(c, abs(v)) for c, v in correlations_with(df, target, columns).items() if v is not None]
    return sorted(known, key=lambda p: (-p[1], p[0]))[:k]


def target_correlation_table(df: DataFrame, target: str, columns: list[str] | None = None, k: int = 20) -> DataFrame:
    rows = target_correlations(df, target, columns, k)
    return df.sparkSession.createDataFrame(rows, "feature string, correlation double")


def correlation_matrix(df: DataFrame, columns: list[str] | None = None, top: int = 30) -> DataFrame:
    """Long-form matrix of the ``top`` columns by variance."""
    columns = columns or numeric_columns(df)
    if len(columns) > top:
        spreads = numeric_moments(df, columns, ("var_samp",))
        columns = sorted(columns, key=lambda c: (-(spreads[c]["var_samp"] or 0.0), c))[:top]
    table = correlation_table(df, columns)
    rows = [(a, b, v) for (a, b), v in table.items()] + [(b, a, v) for (a, b), v in table.items()]
    constant = set(_constant_columns(df, columns))
    rows += [(c, c, None if c in constant else 1.0) for c in columns]
    return df.sparkSession.createDataFrame(rows, "feature1 string, feature2 string, correlation double")


def segment_rates(df: DataFrame, target: str, segments: list[str]) -> DataFrame:
    """Target mean and counts per value of each segment column, all in one aggregation."""
    present = [s for s in segments if s in df.columns]
    grouped = df.groupingSets([[F.col(s)] for s in present], *[F.col(s) for s in present]).agg(
        F.grouping_id().alias("_set"), F.avg(F.col(target).cast("double")).alias("mean"),
        F.count(target).alias("target_count"), F.count(KEY).alias("customers"),
    )
    n = len(present)
    # the grouping id has a 1 bit for every column left out
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, s in enumerate(present):
        mine = F.col("_set") == ((1 << n) - 1) ^ (1 << (n - 1 - i))
        name, value = F.when(mine, s).otherwise(name), F.when(mine, F.col(s)).otherwise(value)
    out = grouped.select(name.alias("segment"), value.alias("value"), F.round("mean", 3).alias("churn_rate"), "target_count", "customers")
    return out.where("value is not null")


def _classes(df: DataFrame, target: str) -> list:
    found = df.where(F.col(target).isNotNull()).select(target).distinct().limit(MAX_CLASSES + 1).collect()
    if len(found) > MAX_CLASSES:
        raise ValueError(f"{target} has more than {MAX_CLASSES} classes")
    return sorted(r[0] for r in found)


def chi_square_tests(df: DataFrame, target: str, columns: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Independence of each text column and the target; 2x2 tables with continuity correction."""
    columns = (columns or string_columns(df, {KEY}))[:limit]
    classes = _classes(df, target)
    long = to_long(df.where(F.col(target).isNotNull()), columns, "string", [target]).where("value is not null")
    cells = long.groupBy("feature", "value").agg(
        *[F.count_if(F.col(target) == c).alias(f"o{i}") for i, c in enumerate(classes)]
    )
    margins = cells.groupBy("feature").agg(
        F.count("*").alias("_values"), *[F.sum(f"o{i}").alias(f"c{i}") for i in range(len(classes))]
    )
    joined = cells.join(F.broadcast(margins), "feature")  # one row per tested column
    whole = sum((F.col(f"c{i}") for i in range(1, len(classes))), F.col("c0"))
    row = sum((F.col(f"o{i}") for i in range(1, len(classes))), F.col("o0"))
    used = sum((F.when(F.col(f"c{i}") > 0, 1).otherwise(0) for i in range(len(classes))), F.lit(0))
    dof = (F.col("_values") - 1) * (used - 1)
    cell_sum = F.lit(0.0)
    for i in range(len(classes)):
        expected = row * F.col(f"c{i}") / whole
        gap = F.abs(F.col(f"o{i}") - expected)
        gap = F.when(dof == 1, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
        cell_sum = cell_sum + F.when(expected > 0, gap * gap / expected).otherwise(0.0)
    tested = joined.groupBy("feature").agg(F.sum(cell_sum).alias("chi2_statistic"), F.first(dof).alias("dof")).collect()
    rows = [(r["feature"], r["chi2_statistic"], r["dof"], chi_square_tail(r["chi2_statistic"], r["dof"]) if r["dof"] else 1.0) for r in tested]
    return df.sparkSession.createDataFrame(
        [(*r, r[3] < 0.05) for r in rows],
        "feature string, chi2_statistic double, degrees_of_freedom bigint, p_value double, significant boolean",
    )


def t_tests(df: DataFrame, target: str, columns: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Pooled-variance t of the two classes for the numeric columns (or the first ``limit``), in one job."""
    columns = [c for c in (columns or numeric_columns(df))[:limit] if c != target]
    seen = numeric_moments(df.where(F.col(target).isin(0, 1)), columns, ("count", "mean", "var_pop"), [target])
    none, rows = {"count": 0, "mean": None, "var_pop": None}, []
    for c in columns:
        a, b = seen.get((c, 0), none), seen.get((c, 1), none)
        n0, n1 = a["count"], b["count"]
        if not n0 or not n1 or n0 + n1 < 3:
            continue
        pooled = (a["var_pop"] * n0 + b["var_pop"] * n1) / (n0 + n1 - 2)
        difference = b["mean"] - a["mean"]
        if pooled <= 0:
            continue
        t = -difference / math.sqrt(pooled * (1 / n0 + 1 / n1))
        p = t_two_sided(t, n0 + n1 - 2)
        rows.append((c, t, p, difference, p < 0.05))
    return df.sparkSession.createDataFrame(
        rows, "feature string, t_statistic double, p_value double, mean_diff double, significant boolean"
    )


def histograms(df: DataFrame, target: str, columns: list[str] | None = None, bins: int = 30, top: int = 12) -> DataFrame:
    """Equal-width bins per class over the class's own range, for the columns closest to the target."""
    columns = columns or [c for c, _ in target_correlations(df, target, k=top)]
    long = to_long(df.where(F.col(target).isNotNull()), columns, "double", [target]).where("value is not null")
    ranges = long.groupBy("feature", target).agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("total"))
    ranges = ranges.withColumns({
        "low": F.when(F.col("low") == F.col("high"), F.col("low") - 0.5).otherwise(F.col("low")),
        "high": F.when(F.col("low") == F.col("high"), F.col("high") + 0.5).otherwise(F.col("high")),
    })
    place = F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * bins)
    # one row per feature and class on the small side
    placed = long.join(F.broadcast(ranges), ["feature", target]).groupBy(
        "feature", target, F.least(F.lit(bins - 1), place).cast("int").alias("bin")
    ).agg(F.count("*").alias("n"))
    grid = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("high") - F.col("low")) / bins
    return grid.join(placed, ["feature", target, "bin"], "left").select(
        "feature", target, "bin", (F.col("low") + F.col("bin") * width).alias("bin_start"),
        F.coalesce("n", F.lit(0)).alias("n"), (F.coalesce("n", F.lit(0)) / (F.col("total") * width)).alias("density"),
    )


def monthly_series(df: DataFrame, target: str | None = "churned", date: str = "registration_date") -> DataFrame:
    aggs = [F.count("*").alias("registrations")]
    if target in df.columns:
        aggs.append(F.avg(F.col(target).cast("double")).alias("churn_rate"))
    month = F.date_trunc("month", date).cast("timestamp_ntz").alias("month")
    return df.where(F.col(date).isNotNull()).groupBy(month).agg(*aggs)


def value_counts(df: DataFrame, columns: list[str], top: int | None = None) -> DataFrame:
    """Rows per value of each column, the ``top`` most frequent when given."""
    counts = value_frequencies(df, columns)
    return counts if top is None else top_k_per_group(counts, ["feature"], [F.desc("n"), F.col("value")], top)


def dataset_totals(transactions: DataFrame, interactions: DataFrame, marketing: DataFrame) -> DataFrame:
    """Headline numbers of the three activity tables, one row."""
    amount = F.col("total_amount")
    median = exact_quantiles(transactions, {"total_amount": [0.5]})["total_amount"][0]
    sales = transactions.agg(
        F.count("*").alias("transactions"), F.count_distinct("customer_id").alias("buyers"), F.sum(amount).alias("revenue"),
        F.avg(amount).alias("mean_amount"), F.max(amount).alias("max_amount"),
    ).withColumn("median_amount", F.lit(median))
    contacts = interactions.agg(
        F.count("*").alias("interactions"), F.avg("satisfaction_score").alias("mean_satisfaction"),
        F.avg("duration_seconds").alias("mean_duration"),
    )
    campaigns = marketing.agg(
        F.count("*").alias("campaigns"), F.avg("opened").alias("open_rate"), F.avg("clicked").alias("click_rate"),
        F.avg("converted").alias("conversion_rate"),
    )
    one = F.lit(1)  # three one-row tables side by side
    return sales.withColumn("_k", one).join(contacts.withColumn("_k", one), "_k").join(campaigns.withColumn("_k", one), "_k").drop("_k")


def before_after(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """Rows, nulls, duplicates and columns added by cleaning, per dataset."""
    rows = []
    for name, raw in before.items():
        clean = after[name]
        counts = []
        for df in (raw, clean):
            seen = measure(df, {"rows": F.count(F.lit(1))} | {("nulls", c): F.count_if(F.col(c).isNull()) for c in df.columns})
            counts.append((seen["rows"], sum(v for k, v in seen.items() if k != "rows"), duplicate_rows(df)))
        (r0, n0, d0), (r1, n1, d1) = counts
        rows.append((name, r0, r1, n0, n1, d0, d1, len(set(clean.columns) - set(raw.columns))))
    spark = next(iter(before.values())).sparkSession
    return spark.createDataFrame(
        rows, "dataset string, rows_before bigint, rows_after bigint, nulls_before bigint, nulls_after bigint, "
        "duplicates_before bigint, duplicates_after bigint, columns_added bigint",
    )
