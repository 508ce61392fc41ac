"""Scalers as small fitted parameter tables that are applied by projection."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from custoria import constants as K
from custoria.functions.columns import numeric_columns, string_columns
from custoria.functions.quantiles import BOUNDED_ROWS, even_quantiles, exact_quantiles, known_counts
from custoria.operators import encoding as N
from custoria.operators.profiles import measure, numeric_moments

GRID_POINTS = 1000
PROBABILITY_EDGE = 1e-7

# ---------------------------------------------------------------- feature types

TYPE_NAMES = ["numeric_normal", "numeric_skewed", "numeric_heavy_tail", "binary", "categorical_low", "categorical_high", "text", "id"]


def detect_feature_types(df: DataFrame) -> dict[str, str]:
    """{column: type} by name, distinct values and skew; flags and dates have no type."""
    ids = [c for c in df.columns if c.lower() == "id" or c.lower().endswith("_id")]
    numbers, texts = numeric_columns(df, ids), string_columns(df, ids)
    moments = numeric_moments(df, numbers, ("count", "skewness", "min", "max", "zeros"))
    ones = measure(df, {c: F.count_if(F.col(c) == 1) for c in numbers if moments[c]["min"] == 0 and moments[c]["max"] == 1})
    distinct = N.distinct_counts(df, texts)
    out = {}
    for c in df.columns:
        if c in ids:
            out[c] = "id"
        elif c in texts:
            n = distinct[c]
            out[c] = "binary" if n == 2 else "categorical_low" if n <= 10 else "categorical_high" if n <= 50 else "text"
        elif c in numbers:
            skew = abs(moments[c]["skewness"] or 0.0)
            if c in ones and ones[c] + moments[c]["zeros"] == moments[c]["count"]:
                out[c] = "binary"
            else:
                out[c] = "numeric_normal" if skew < 0.5 else "numeric_skewed" if skew < 2 else "numeric_heavy_tail"
    return out


# ---------------------------------------------------------------- numeric scalers


def _spread(value: float | None) -> float:
    """A constant column is only shifted."""
    return value if value else 1.0


def fit_standard(df: DataFrame, columns: list[str]) -> dict[str, dict]:
    moments = numeric_moments(df, columns, ("mean", "var_pop"))
    return {c: {"mean": m["mean"] or 0.0, "scale": _spread(math.sqrt(m["var_pop"] or 0.0))} for c, m in moments.items()}


def fit_minmax(df: DataFrame, columns: list[str]) -> dict[str, dict]:
    moments = numeric_moments(df, columns, ("min", "max"))
    return {c: {"mean": m["min"] or 0.0, "scale": _spread((m["max"] or 0.0) - (m["min"] or 0.0))} for c, m in moments.items()}


def fit_maxabs(df: DataFrame, columns: list[str]) -> dict[str, dict]:
    return {c: {"mean": 0.0, "scale": _spread(m["max_abs"])} for c, m in numeric_moments(df, columns, ("max_abs",)).items()}


def fit_robust(df: DataFrame, columns: list[str], bounded_rows: int = BOUNDED_ROWS) -> dict[str, dict]:
    quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns}, bounded_rows)
    out = {}
    for c, (q1, q2, q3) in quartiles.items():
        out[c] = {"mean": q2 or 0.0, "scale": _spread(None if q1 is None else q3 - q1)}
    return out


def fit_quantile(df: DataFrame, columns: list[str], points: int = GRID_POINTS, bounded_rows: int = BOUNDED_ROWS) -> dict[str, dict]:
    """Value grid at up to ``points`` even probabilities, exact at any size."""
    counts = known_counts(df, columns)
    out = {}
    grids = even_quantiles(df, {c: max(2, min(points, counts[c])) for c in columns}, bounded_rows)
    for c in columns:
        out[c] = {"grid": [float(v) for v in grids[c]] if grids[c] and grids[c][0] is not None else [0.0, 0.0]}
    return out


def yeo_johnson(value: Column, power: float) -> Column:
    up = F.log1p(value) if power == 0 else (F.pow(value + 1, F.lit(float(power))) - 1) / power
    rest = 2.0 - power
    down = -F.log1p(-value) if rest == 0 else -(F.pow(1 - value, F.lit(rest)) - 1) / rest
    return F.when(value >= 0, up).otherwise(down)


def fit_power(df: DataFrame, columns: list[str]) -> dict[str, dict]:
    """Power of greatest likelihood: a coarse grid per column, refined three times.

    Every round is one aggregation over (column, power) rows built from the scan.
    """
    centre, step, out = {c: 1.0 for c in columns}, 0.25, {}
    for _ in range(4):
        tried = {c: [centre[c] + step * i for i in range(-12, 13)] for c in columns}
        rows = F.array(*[
            F.struct(F.lit(i).alias("i"), F.lit(p).alias("p"), F.col(c).cast("double").alias("x"), yeo_johnson(F.col(c).cast("double"), p).alias("t"))
            for i, c in enumerate(columns) for p in tried[c]
        ])
        x = F.col("x")
        spread, slope = F.var_pop("t"), F.sum(F.signum(x) * F.log1p(F.abs(x)))
        found = df.select(F.inline(rows)).groupBy("i", "p").agg(
            F.avg("t").alias("mean"), spread.alias("var"), F.count("t").alias("n"), slope.alias("slope")
        ).collect()
        best: dict[int, tuple] = {}
        for r in found:
            usable = r["var"] and math.isfinite(r["var"])
            fit = -r["n"] / 2 * math.log(r["var"]) + (r["p"] - 1) * r["slope"] if usable else -math.inf
            best[r["i"]] = max(best.get(r["i"], (-math.inf, -math.inf, None)), (fit, -r["p"], r), key=lambda t: t[:2])
        for i, c in enumerate(columns):
            _, power, r = best[i]
            centre[c] = -power if r is not None else 1.0
            out[c] = {"power": centre[c], "mean": (r and r["mean"]) or 0.0, "scale": _spread(math.sqrt((r and r["var"]) or 0.0))}
        step /= 8
    return out


# Rational approximation of the normal quantile function (Wichura 1988, AS 241).
_CENTRAL = (
    [2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4, 4.5921953931549871457e4,
     1.3731693765509461125e4, 1.9715909503065514427e3, 1.3314166789178437745e2, 3.3871328727963666080e0],
    [5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4, 2.1213794301586595867e4,
     5.3941960214247511077e3, 6.8718700749205790830e2, 4.2313330701600911252e1, 1.0],
)
_MIDDLE = (
    [7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e0,
     3.64784832476320460504e0, 5.76949722146069140550e0, 4.63033784615654529590e0, 1.42343711074968357734e0],
    [1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
     6.89767334985100004550e-1, 1.67638483018380384940e0, 2.05319162663775882187e0, 1.0],
)
_FAR = (
    [2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
     2.96560571828504891230e-1, 1.78482653991729133580e0, 5.46378491116411436990e0, 6.65790464350110377720e0],
    [2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
     1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0],
)


def normal_quantile(p):
    """Standard normal quantiles of an array of probabilities in (0, 1)."""
    q = p - 0.5
    ratio = lambda parts, x: np.polyval(parts[0], x) / np.polyval(parts[1], x)
    central = q * ratio(_CENTRAL, 0.180625 - q * q)
    r = np.sqrt(-np.log(np.minimum(p, 1 - p)))
    tail = np.where(r <= 5, ratio(_MIDDLE, r - 1.6), ratio(_FAR, r - 5))
    return np.where(np.abs(q) <= 0.425, central, np.sign(q) * tail)


def quantile_normal(value: Column, grid: list[float]) -> Column:
    """Normal score of the value's place in the grid; ties take the middle of their range."""
    points = np.asarray(grid, dtype="float64")

    @pandas_udf("double")
    def score(values: pd.Series) -> pd.Series:
        x, probabilities = values.to_numpy(dtype="float64"), np.linspace(0, 1, len(points))
        upward = np.interp(x, points, probabilities)
        downward = -np.interp(-x, -points[::-1], -probabilities[::-1])
        u = np.clip((upward + downward) / 2, PROBABILITY_EDGE, 1 - PROBABILITY_EDGE)
        return pd.Series(np.where(np.isnan(x), np.nan, normal_quantile(u)))

    scored = score(value.cast("double"))
    return F.when(value.isNotNull(), scored)


FITTERS = {
    "standard": fit_standard, "minmax": fit_minmax, "maxabs": fit_maxabs, "robust": fit_robust,
    "quantile": fit_quantile, "power": fit_power, "normalizer": lambda df, columns: {c: {} for c in columns},
}


def fit(df: DataFrame, columns: list[str], method: str) -> dict[str, dict]:
    return FITTERS[method](df, columns) if columns else {}


def apply(df: DataFrame, params: dict[str, dict], method: str) -> DataFrame:
    """Scale the fitted columns in place."""
    columns = list(params)
    if method == "normalizer":
        total = sum((F.col(c).cast("double") * F.col(c) for c in columns), F.lit(0.0))
        norm = F.when(total == 0, 1.0).otherwise(F.sqrt(total))
        return df.withColumns({c: F.col(c) / norm for c in columns})
    out = {}
    for c, p in params.items():
        value = F.col(c).cast("double")
        if method == "quantile":
            out[c] = quantile_normal(F.col(c), p["grid"])
        elif method == "power":
            out[c] = (yeo_johnson(value, p["power"]) - p["mean"]) / p["scale"]
        else:
            out[c] = (value - p["mean"]) / p["scale"]
    return df.withColumns(out)


# ---------------------------------------------------------------- one method per feature type

DEFAULT_METHODS = {
    "numeric_normal": "standard", "numeric_skewed": "quantile", "numeric_heavy_tail": "robust", "binary": "passthrough",
    "categorical_low": "onehot", "categorical_high": "target", "text": "hashing", "id": "passthrough",
}
STATE_SCHEMA = "feature_type string, column string, method string, name string, place int, number double, text string"


@dataclass
class FittedScaling:
    """Feature types, their methods and all fitted numbers; small whatever the data size."""

    types: dict[str, str]
    methods: dict[str, str]
    params: dict[str, dict] = field(default_factory=dict)

    def columns_of(self, feature_type: str) -> list[str]:
        return [c for c, t in self.types.items() if t == feature_type]

    def method_of(self, column: str) -> str:
        return self.methods.get(self.types[column], "passthrough")

    def output_columns(self, column: str) -> list[str]:
        method = self.method_of(column)
        if method == "onehot":
            return [f"{column}_{v}" for v in self.params[column]["values"][1:]]
        if method == "hashing":
            return []
        if method == "binary":
            width = max(1, len(self.params[column]["values"]).bit_length())
            return [f"{column}_{i}" for i in range(width)]
        return [column]

    def feature_names(self) -> list[str]:
        names = [n for c in self.types for n in self.output_columns(c)]
        hashed = [c for c in self.types if self.method_of(c) == "hashing"]
        return names + ([f"hash_{i}" for i in range(K.HASH_COLUMNS)] if hashed else [])

    def transform(self, df: DataFrame) -> DataFrame:
        """Only the fitted features, scaled and encoded."""
        out = df
        for feature_type, method in self.methods.items():
            columns = [c for c in self.columns_of(feature_type) if c in df.columns]
            if method in FITTERS and columns:
                out = apply(out, {c: self.params[c] for c in columns}, method)
        hashed = [c for c in self.types if self.method_of(c) == "hashing" and c in df.columns]
        for c in self.types:
            if self.method_of(c) == "onehot":
                out = out.withColumns(N.onehot_columns(c, self.params[c]["values"]))
            elif self.method_of(c) == "target":
                means, pairs = self.params[c], []
                for value, mean in zip(means["values"], means["means"]):
                    pairs += [F.lit(value), F.lit(float(mean))]
                known = F.try_element_at(F.create_map(*pairs), F.col(c)) if pairs else F.lit(None).cast("double")
                out = out.withColumn(c, F.coalesce(known, F.lit(float(means["prior"]))))
            elif c in self.params and self.method_of(c) not in FITTERS:
                # a position in sorted order; null and unseen values have none
                known = [F.lit(x) for i, v in enumerate(self.params[c]["values"]) for x in (v, i)]
                code = F.try_element_at(F.create_map(*known), F.col(c)) if known else F.lit(None).cast("int")
                if self.method_of(c) == "binary":
                    bits, code = self.output_columns(c), F.coalesce(code + 1, F.lit(0))
                    out = out.withColumns({b: F.shiftright(code, len(bits) - 1 - i).bitwiseAND(F.lit(1)) for i, b in enumerate(bits)})
                else:
                    out = out.withColumn(c, code)
        if hashed:
            out = N.encode_hashing(out, hashed)
        return out.select(*[F.col(f"`{n}`") for n in self.feature_names() if n in out.columns])

    def rows(self) -> list[tuple]:
        out = []
        for c, feature_type in self.types.items():
            method, params = self.method_of(c), self.params.get(c, {})
            out.append((feature_type, c, method, "", 0, None, None))
            for name, value in params.items():
                for i, v in enumerate(value if isinstance(value, list) else [value]):
                    text = isinstance(v, str)
                    out.append((feature_type, c, method, name, i, None if text else float(v), v if text else None))
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.rows(), STATE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedScaling:
        rows = sorted(spark.read.parquet(path).collect(), key=lambda r: (r["name"], r["place"]))
        order = {r["column"]: r["feature_type"] for r in rows}
        fitted = cls(order, {r["feature_type"]: r["method"] for r in rows})
        lists = {"grid", "values", "means"}
        for r in rows:
            if r["name"]:
                value = r["text"] if r["text"] is not None else r["number"]
                mine = fitted.params.setdefault(r["column"], {})
                if r["name"] in lists:
                    mine.setdefault(r["name"], []).append(value)
                else:
                    mine[r["name"]] = value
        return fitted

    def report(self, spark: SparkSession) -> DataFrame:
        """Per feature: its type, method, number of output columns and, where fitted, centre and scale."""
        rows = []
        for c, feature_type in self.types.items():
            p = self.params.get(c, {})
            rows.append((feature_type, c, self.method_of(c), len(self.output_columns(c)), p.get("mean"), p.get("scale")))
        return spark.createDataFrame(rows, "feature_type string, column string, method string, columns_out int, mean double, scale double")


def fit_auto(df: DataFrame, label: str | None = None, methods: dict[str, str] | None = None) -> FittedScaling:
    """Detect the feature types and fit each type's method."""
    types = detect_feature_types(df.drop(label) if label else df)
    methods = dict(DEFAULT_METHODS if methods is None else methods)
    if label is None and methods.get("categorical_high") == "target":
        methods["categorical_high"] = "label"
    fitted = FittedScaling(types, methods)
    for feature_type, method in methods.items():
        columns = fitted.columns_of(feature_type)
        if method in FITTERS:
            fitted.params |= fit(df, columns, method)
        elif method == "target":
            for c in columns:  # at most 50 categories each
                means, prior = N.target_means(df.where(F.col(c).isNotNull()), c, label)
                found = sorted(means.collect(), key=lambda r: r["_value"])
                fitted.params[c] = {"prior": prior, "values": [r["_value"] for r in found], "means": [r["_encoding"] for r in found]}
        elif method not in ("passthrough", "hashing") and columns:
            # one-hot, binary and ordinal; any other name encodes by position, too
            fitted.params |= {c: {"values": v} for c, v in N.listed_values(df, columns).items()}
    return fitted
