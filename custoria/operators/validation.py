"""Quality checks. All aggregates of the selected checks run in one job per dataset; only
row duplicates, distinct values and quartile bounds need further passes."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custoria import constants as K
from custoria.functions.columns import (
    TEMPORAL, instant, is_true, numeric_columns, string_columns, temporal_columns,
)
from custoria.functions.quantiles import exact_quantiles
from custoria.operators.profiles import (
    column_sketches, duplicate_rows, measure, null_and_distinct_counts, numeric_moments, sketched_counts,
)
from custoria.session import shuffles_removed

CHECK_SCHEMA = (
    "dataset string, check_name string, passed boolean, severity string, message string, value double, "
    "details map<string,string>"
)


# Texts that may read as a whole number, a number or a time.
WHOLE = "^ *[+-]?[0-9]+ *$"
NUMBER = "^ *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)? *$"
TIME = "^ *[0-9]{4}-[0-9]{1,2}(-[0-9]{1,2}.*)?$"


@dataclass
class Subject:
    """The dataset under test and what has been measured of it."""

    df: DataFrame
    name: str
    as_of: object
    seen: dict = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return self.seen["rows"]

    def row(self, check: str, passed: bool, severity: str, message: str, value=None, **details) -> tuple:
        texts = {k: str(v) for k, v in details.items()}
        return (self.name, check, passed, severity, message, None if value is None else float(value), texts)


def id_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.lower() == "id" or c.lower().endswith("_id")]


# ---------------------------------------------------------------- size, types, missing values


def judge_size(s: Subject):
    if s.rows == 0:
        severity = "error" if "customer" in s.name.lower() else "warning"
        return [s.row("empty_dataframe", False, severity, f"{s.name} is empty", 0)]
    n = len(s.df.columns)
    return [s.row("dataframe_size", True, "info", f"{s.rows:,} rows and {n} columns", s.rows, rows=s.rows, columns=n)]


def measure_types(df: DataFrame, _as_of) -> dict:
    out = {}
    for c in string_columns(df):
        out[("known", c)] = F.count(c)
        # shapes first: a cast that fails costs far more than a pattern that does not match
        out[("bigint", c)] = F.count(F.expr(f"CASE WHEN `{c}` RLIKE '{WHOLE}' THEN try_cast(`{c}` AS BIGINT) END"))
        out[("double", c)] = F.count(F.expr(f"CASE WHEN `{c}` RLIKE '{NUMBER}' THEN try_cast(`{c}` AS DOUBLE) END"))
        out[("timestamp_ntz", c)] = F.count(F.expr(f"CASE WHEN `{c}` RLIKE '{TIME}' THEN try_cast(`{c}` AS TIMESTAMP_NTZ) END"))
    return out


def judge_types(s: Subject):
    """Text columns where only a part of the values reads as a number or a time; wrongly typed ids and dates."""
    rows = []
    for c in string_columns(s.df):
        known, kinds = s.seen[("known", c)], {k: s.seen[(k, c)] for k in ("bigint", "double", "timestamp_ntz")}
        mixed = any(0 < n < known for n in (kinds["double"], kinds["timestamp_ntz"]))
        text = f"{c}: of {known:,} texts {kinds['double']:,} read as numbers, {kinds['timestamp_ntz']:,} as times"
        rows.append(s.row(f"mixed_types_{c}", not mixed, "warning" if mixed else "info", text, kinds["double"], **kinds))
    types = {f.name: f.dataType for f in s.df.schema}
    for c in id_columns(s.df):
        if not isinstance(types[c], T.StringType):
            rows.append(s.row(f"id_type_{c}", False, "warning", f"id column {c} is {types[c].simpleString()}, not text"))
    for c in s.df.columns:
        if ("date" in c.lower() or "time" in c.lower()) and not isinstance(types[c], TEMPORAL):
            rows.append(s.row(f"date_type_{c}", False, "warning", f"date column {c} is {types[c].simpleString()}"))
    return rows


def measure_nulls(df: DataFrame, _as_of) -> dict:
    return {("nulls", c): F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns}


def _missing_share(s: Subject) -> float:
    cells = s.rows * len(s.df.columns)
    return sum(s.seen[("nulls", c)] for c in s.df.columns) / cells if cells else 0.0


def judge_missing(s: Subject):
    rows, limit = [], K.MAX_MISSING_SHARE
    share = _missing_share(s)
    if share > limit:
        rows.append(s.row("overall_missing", False, "error", f"{share:.1%} of all cells are missing", share))
    high = [(c, s.seen[("nulls", c)] / s.rows) for c in s.df.columns if s.rows and s.seen[("nulls", c)] / s.rows > limit]
    for c, part in high:
        severity = "error" if part > 0.5 else "warning"
        rows.append(s.row(f"missing_values_{c}", False, severity, f"{c} lacks {part:.1%} of its values", part, missing_count=s.seen[("nulls", c)]))
    if not high:
        rows.append(s.row("missing_values", True, "info", f"no column lacks more than {limit:.0%}", 0))
    return rows


def judge_completeness(s: Subject):
    value = 1 - _missing_share(s)
    good = value >= 0.95
    return [s.row("data_completeness", good, "info" if good else "warning", f"{value:.1%} of the cells are filled", value)]


# ---------------------------------------------------------------- duplicates and keys


def judge_duplicate_rows(s: Subject):
    n = s.seen["duplicates"]
    if n:
        return [s.row("duplicate_rows", False, "warning", f"{n:,} duplicate rows ({n / s.rows:.1%})", n)]
    return [s.row("duplicate_rows", True, "info", "no duplicate rows", 0)]


def primary_keys(df: DataFrame, dataset: str) -> list[str]:
    """Columns that must be unique, read off the dataset's name."""
    name, keys = dataset.lower(), []
    for c in df.columns:
        own = any(part in name and c == f"{part}_id" for part in ("customer", "transaction", "interaction"))
        if "marketing" in name and c == "campaign_id":
            continue
        if own or (c.lower().endswith("_id") and c.lower().replace("_id", "") in name):
            keys.append(c)
    return keys


def judge_primary_key(s: Subject):
    rows = []
    for c in primary_keys(s.df, s.name):
        # all nulls together count as one value
        repeated = s.rows - s.seen[("distinct", c)] - (1 if s.seen[("filled", c)] < s.rows else 0)
        if repeated:
            rows.append(s.row(f"duplicate_primary_key_{c}", False, "error", f"{repeated:,} repeated values in key {c}", repeated))
        else:
            rows.append(s.row(f"unique_primary_key_{c}", True, "info", f"key {c} is unique", 0))
    return rows


def judge_foreign_key(s: Subject):
    rows, own = [], primary_keys(s.df, s.name)
    for c in K.FOREIGN_KEYS:
        if c in s.df.columns and c not in own and s.seen[("distinct", c)] < s.rows:
            n = s.seen[("distinct", c)]
            rows.append(s.row(f"foreign_key_cardinality_{c}", True, "info", f"{n:,} values of {c} in {s.rows:,} rows", n))
    return rows


def judge_cardinality(s: Subject):
    rows = []
    for c in string_columns(s.df):
        n = s.seen[("distinct", c)]
        if s.rows and n / s.rows > 0.5:
            rows.append(s.row(f"high_cardinality_{c}", False, "warning", f"{c} has {n:,} values", n))
    return rows


# ---------------------------------------------------------------- business rules


def measure_age(df: DataFrame, _as_of) -> dict:
    return {"bad_age": F.count_if((F.col("age") < K.MIN_AGE) | (F.col("age") > K.MAX_AGE))} if "age" in df.columns else {}


def judge_age(s: Subject):
    if "bad_age" not in s.seen:
        return []
    n = s.seen["bad_age"]
    return [s.row("age_range", n == 0, "error" if n else "info", f"{n:,} ages outside {K.MIN_AGE}-{K.MAX_AGE}", n)]


def measure_amounts(df: DataFrame, _as_of) -> dict:
    out = {}
    for c in K.AMOUNT_COLUMNS:
        if c in df.columns:
            out |= {("negative", c): F.count_if(F.col(c) < 0), ("max", c): F.max(c)}
    return out


def judge_amounts(s: Subject):
    rows = []
    for c in K.AMOUNT_COLUMNS:
        if ("negative", c) in s.seen:
            if s.seen[("negative", c)]:
                rows.append(s.row(f"negative_{c}", False, "error", f"{s.seen[('negative', c)]:,} negative values of {c}", s.seen[("negative", c)]))
            if (s.seen[("max", c)] or 0) > K.MAX_AMOUNT:
                rows.append(s.row(f"extreme_{c}", False, "warning", f"{c} reaches {s.seen[('max', c)]:,.2f}", s.seen[("max", c)]))
    return rows


def _date_columns(df: DataFrame) -> list[str]:
    return [c for c in temporal_columns(df) if "date" in c.lower()]


def measure_dates(df: DataFrame, as_of) -> dict:
    out = {}
    for c in _date_columns(df):
        out |= {("future", c): F.count_if(F.col(c) > instant(as_of)), ("old", c): F.count_if(F.col(c) < instant("1900-01-01"))}
    return out


def judge_dates(s: Subject):
    rows = []
    for c in _date_columns(s.df):
        if s.seen[("future", c)]:
            severity = "info" if "end" in c.lower() else "warning"
            rows.append(s.row(f"future_dates_{c}", False, severity, f"{s.seen[('future', c)]:,} future dates in {c}", s.seen[("future", c)]))
        if s.seen[("old", c)]:
            rows.append(s.row(f"old_dates_{c}", False, "warning", f"{s.seen[('old', c)]:,} dates before 1900 in {c}", s.seen[("old", c)]))
    return rows


def measure_churned(df: DataFrame, _as_of) -> dict:
    if "churned" not in df.columns:
        return {}
    return {"not_binary": F.count_if(~F.col("churned").isin(0, 1)), "churn_rate": F.avg(F.col("churned").cast("double"))}


def judge_binary(s: Subject):
    n = s.seen.get("not_binary", 0)
    return [s.row("churned_binary", False, "error", f"{n:,} churn flags are neither 0 nor 1", n)] if n else []


def judge_imbalance(s: Subject):
    rate = s.seen.get("churn_rate")
    if rate is None or 0.1 <= rate <= 0.9:
        return []
    severe = rate < 0.05 or rate > 0.95
    text = f"{'severe' if severe else 'moderate'} class imbalance, churn rate {rate:.1%}"
    return [s.row("class_imbalance", False, "warning" if severe else "info", text, rate)]


# ---------------------------------------------------------------- statistics


def judge_zero_variance(s: Subject):
    found = [(c, s.seen["moments"][c]["std"]) for c in numeric_columns(s.df)]
    return [
        s.row(f"zero_variance_{c}", False, "warning", f"{c} hardly varies (std {std:.6f})", std)
        for c, std in found if std is not None and std < K.MIN_STDDEV
    ]


def judge_skew(s: Subject):
    found = [(c, s.seen["moments"][c]["skewness"]) for c in numeric_columns(s.df)]
    return [
        s.row(f"high_skew_{c}", False, "info", f"{c} is skewed ({skew:.2f})", skew)
        for c, skew in found if skew is not None and abs(skew) > K.HIGH_SKEW
    ]


def count_outliers(df: DataFrame, moments: dict) -> dict:
    """Rows outside the quartile fences per numeric column: quartiles first, then one counting pass."""
    columns = numeric_columns(df)
    sizes, counts = {c: moments[c]["count"] for c in columns}, {}
    for c, (q1, q3) in exact_quantiles(df, {c: [0.25, 0.75] for c in columns}, counts=sizes).items():
        if q1 is not None and q3 > q1:
            reach = K.OUTLIER_IQR_FACTOR * (q3 - q1)
            counts[("outliers", c)] = F.count_if(~F.col(c).between(F.lit(q1 - reach), F.lit(q3 + reach)))
    return measure(df, counts)


def judge_outliers(s: Subject):
    rows = []
    for c in numeric_columns(s.df):
        n = s.seen.get(("outliers", c), 0)
        if s.rows and n / s.rows > 0.05:
            rows.append(s.row(f"outliers_{c}", False, "warning", f"{c} has {n:,} outliers ({n / s.rows:.1%})", n, share=n / s.rows))
    return rows


def judge_sample_size(s: Subject):
    if s.rows >= K.MIN_SAMPLE_ROWS:
        return []
    return [s.row("sample_size", False, "warning", f"only {s.rows:,} rows, {K.MIN_SAMPLE_ROWS:,} are advised", s.rows)]


# ---------------------------------------------------------------- relations between columns


def _date_pairs(df: DataFrame) -> list[tuple[str, str]]:
    times = set(temporal_columns(df))
    return [(a, b) for a, b in K.ORDERED_DATE_PAIRS if {a, b} <= times]


def measure_relations(df: DataFrame, _as_of) -> dict:
    out = {("order", a, b): F.count_if(F.col(a) > F.col(b)) for a, b in _date_pairs(df)}
    if {"total_transactions", "total_spent"} <= set(df.columns):
        out["no_spend"] = F.count_if((F.col("total_transactions") > 0) & (F.col("total_spent") <= 0))
    return out


def judge_date_order(s: Subject):
    return [
        s.row(f"date_relationship_{a}_{b}", False, "error", f"{a} is after {b} in {s.seen[('order', a, b)]:,} rows", s.seen[("order", a, b)])
        for a, b in _date_pairs(s.df) if s.seen[("order", a, b)]
    ]


def judge_spend(s: Subject):
    n = s.seen.get("no_spend", 0)
    return [s.row("transaction_amount_consistency", False, "warning", f"{n:,} rows with transactions but no spend", n)] if n else []


# ---------------------------------------------------------------- running them


@dataclass(frozen=True)
class Check:
    judge: Callable
    measures: Callable | None = None
    needs: tuple[str, ...] = ()


CHECKS: dict[str, Check] = {
    "check_size": Check(judge_size),
    "check_type_profile": Check(judge_types, measure_types),
    "check_missing": Check(judge_missing, measure_nulls),
    "check_duplicate_rows": Check(judge_duplicate_rows, needs=("duplicates",)),
    "check_primary_key": Check(judge_primary_key, needs=("keys",)),
    "check_foreign_key_cardinality": Check(judge_foreign_key, needs=("foreign",)),
    "check_age_range": Check(judge_age, measure_age),
    "check_amounts": Check(judge_amounts, measure_amounts),
    "check_dates": Check(judge_dates, measure_dates),
    "check_binary_domain": Check(judge_binary, measure_churned),
    "check_outlier_share": Check(judge_outliers, needs=("moments", "outliers")),
    "check_zero_variance": Check(judge_zero_variance, needs=("moments",)),
    "check_skew": Check(judge_skew, needs=("moments",)),
    "check_sample_size": Check(judge_sample_size),
    "check_class_imbalance": Check(judge_imbalance, measure_churned),
    "check_completeness": Check(judge_completeness, measure_nulls),
    "check_cardinality": Check(judge_cardinality, needs=("texts",)),
    "check_date_order": Check(judge_date_order, measure_relations),
    "check_spend_consistency": Check(judge_spend, measure_relations),
}


def _distinct_wanted(df: DataFrame, name: str, needs: set[str]) -> list[str]:
    wanted = []
    if "keys" in needs:
        wanted += primary_keys(df, name)
    if "foreign" in needs:
        wanted += [c for c in K.FOREIGN_KEYS if c in df.columns]
    if "texts" in needs:
        wanted += string_columns(df)
    return list(dict.fromkeys(wanted))


def _distinct_counts(df: DataFrame, dataset: str, needs: set[str], approximate: bool) -> dict:
    """Known rows and distinct values; with ``approximate`` only those of primary keys are counted exactly."""
    columns = _distinct_wanted(df, dataset, needs)
    keys = [c for c in columns if not approximate or c in primary_keys(df, dataset)]
    rest = [c for c in columns if c not in keys]
    found = null_and_distinct_counts(df, keys) if keys else {}
    if rest:
        found |= sketched_counts(column_sketches(df, rest))
    return {(kind, c): n for c, (filled, values) in found.items() for kind, n in (("filled", filled), ("distinct", values))}


def check_rows(df: DataFrame, dataset: str, as_of, checks: list[str] | None = None, approximate: bool = False, parallelism: int = 4) -> list[tuple]:
    """The results of the checks; passes that do not need each other run side by side."""
    chosen = [CHECKS[c] for c in checks or CHECKS]
    if not df.columns:
        subject = Subject(df, dataset, as_of, {"rows": 0})
        return judge_size(subject)
    subject, needs = Subject(df, dataset, as_of), {n for c in chosen for n in c.needs}
    measures: dict = {"rows": F.count(F.lit(1))}
    for c in chosen:
        measures |= c.measures(df, as_of) if c.measures else {}

    def moments() -> dict:
        found = numeric_moments(df, numeric_columns(df), ("count", "std", "skewness"))
        return {"moments": found} | (count_outliers(df, found) if "outliers" in needs else {})

    passes = [lambda: measure(df, measures)]
    if needs & {"keys", "foreign", "texts"}:
        passes.append(lambda: _distinct_counts(df, dataset, needs, approximate))
    if "duplicates" in needs:
        passes.append(lambda: {"duplicates": duplicate_rows(df)})
    if "moments" in needs:
        passes.append(moments)
    with ThreadPoolExecutor(parallelism) as pool:
        for seen in pool.map(lambda run: run(), passes):
            subject.seen |= seen
    return [row for c in chosen for row in c.judge(subject)]


def validate(datasets: dict[str, DataFrame], as_of, checks: list[str] | None = None, approximate: bool = False, parallelism: int = 4) -> DataFrame:
    """One row per check result of every dataset, ``parallelism`` datasets at a time.

    With ``approximate`` the cardinalities of texts and foreign keys come from sketches with a standard error of 1.6 %.
    """
    def one(item: tuple[str, DataFrame]) -> list[tuple]:
        return check_rows(item[1], item[0], as_of, checks, approximate, parallelism)

    spark = next(iter(datasets.values())).sparkSession
    with shuffles_removed(spark), ThreadPoolExecutor(parallelism) as pool:
        rows = [row for found in pool.map(one, datasets.items()) for row in found]
    return spark.createDataFrame(rows, CHECK_SCHEMA)


def validation_summary(checks: DataFrame) -> DataFrame:
    """Totals and verdict per dataset: valid means no failed error."""
    failed = ~F.col("passed")
    total, passed = F.count("*"), F.count_if("passed")
    errors = F.count_if(failed & (F.col("severity") == "error"))
    return checks.groupBy("dataset").agg(
        total.alias("total_checks"), passed.alias("passed"), (total - passed).alias("failed"), errors.alias("errors"),
        F.count_if(failed & (F.col("severity") == "warning")).alias("warnings"),
        F.count_if(F.col("severity") == "info").alias("info"),
        (passed / total).alias("pass_rate"), (errors == 0).alias("is_valid"),
    )


def validation_gate(summary: DataFrame) -> DataFrame:
    """Which datasets may go on: marketing always may, the others when valid."""
    exempt = is_true(F.lower("dataset").contains("marketing"))
    return summary.select("dataset", "is_valid", exempt.alias("exempt"), (exempt | F.col("is_valid")).alias("accepted"))
