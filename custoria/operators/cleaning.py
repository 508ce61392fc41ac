"""Cleaning rules as DataFrame-to-DataFrame functions and their per-dataset compositions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custoria import constants as K
from custoria.functions.columns import (
    elapsed_days, instant, is_true, numeric_columns, right_closed, string_columns, to_long,
)
from custoria.functions.quantiles import aggregate_with_medians, exact_quantiles
from custoria.session import materialize

# ---------------------------------------------------------------- rows


def dedup_by_key(df: DataFrame, key: list[str], order: list[str] = ()) -> DataFrame:
    """One row per key: the first under ``order``, then under all other columns.

    The rank limit is applied before the shuffle too, so a key holding a large part of the
    table sends one row per task, not its whole group.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    first = F.row_number().over(W.partitionBy(*key).orderBy(*order, *rest))
    return df.withColumn("_first", first).where("_first = 1").drop("_first")


def dedup_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def drop_critical_nulls(df: DataFrame, columns=("customer_id", "registration_date")) -> DataFrame:
    return df.dropna(subset=[c for c in columns if c in df.columns])


def filter_date_window(df: DataFrame, column: str, as_of, earliest: str = K.EARLIEST_TRANSACTION) -> DataFrame:
    return df.where(F.col(column).between(instant(earliest), instant(as_of)))


def filter_status_list(df: DataFrame, column: str = "transaction_status", accepted=None) -> DataFrame:
    return df.where(F.col(column).isin(accepted or K.ACCEPTED_STATUSES))


def invalid_age() -> Column:
    return is_true((F.col("age") < K.MIN_AGE) | (F.col("age") > K.MAX_AGE))


def filter_age_range(df: DataFrame) -> DataFrame:
    """Drop ages outside 18..100; an unknown age stays."""
    return df.where(~invalid_age())


def filter_future_dates(df: DataFrame, as_of, column: str = "registration_date") -> DataFrame:
    return df.where(~is_true(F.col(column) > instant(as_of)))


def filter_valid_amounts(df: DataFrame) -> DataFrame:
    """Completed rows with a positive amount and no missing key, date or amount."""
    amount = F.expr("try_cast(total_amount AS DOUBLE)")
    return (
        df.withColumn("total_amount", amount)
        .where((F.col("total_amount") > 0) & (F.col("transaction_status") == "completed"))
        .dropna(subset=["customer_id", "transaction_date", "total_amount"])
    )


def default_satisfaction(df: DataFrame) -> DataFrame:
    return df.fillna({"satisfaction_score": K.DEFAULT_SATISFACTION}).dropna(subset=["customer_id", "interaction_date"])


# ---------------------------------------------------------------- values


def fix_types(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Cast by map; a value that does not parse becomes null and never fails the job."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS {kind})") for c, kind in mapping.items() if c in df.columns})


def clip_binary(df: DataFrame, column: str = "churned") -> DataFrame:
    value = F.coalesce(F.col(column).cast("int"), F.lit(0))
    return df.withColumn(column, F.greatest(F.lit(0), F.least(F.lit(1), value)))


def fill_constants(df: DataFrame, fills: dict) -> DataFrame:
    return df.fillna({c: v for c, v in fills.items() if c in df.columns})


def fill_customer_constants(df: DataFrame) -> DataFrame:
    """'Unknown' for texts, false for flags, and 0 churn where the column is absent."""
    out = fill_constants(df, {c: "Unknown" for c in K.CUSTOMER_TEXT_FILLS} | {c: False for c in K.CUSTOMER_FLAG_FILLS})
    return out if "churned" in df.columns else out.withColumn("churned", F.lit(0))


def impute_group_median(df: DataFrame, column: str, group: str) -> DataFrame:
    """Fill nulls by the median of the row's group; a null group has no median."""
    # stored, so that the join sees the real size of this side and does not shuffle the rows by a coarse key
    medians = materialize(aggregate_with_medians(
        df.where(F.col(group).isNotNull()).select(group, column), [group], [], {"_median": column}
    ))
    return df.join(medians, group, "left").withColumn(column, F.coalesce(column, "_median")).select(*df.columns)


def impute_global(df: DataFrame) -> DataFrame:
    """Numeric nulls by the column median, text nulls by the smallest most frequent value."""
    missing = df.agg(*_null_counts(df, numeric_columns(df) + string_columns(df))).first().asDict()
    gaps = [c for c in numeric_columns(df) if missing[c]]
    fills = {c: v[0] for c, v in exact_quantiles(df, {c: [0.5] for c in gaps}).items() if v[0] is not None}
    texts = [c for c in string_columns(df) if missing[c]]
    if texts:
        counts = to_long(df, texts, "string").where("value is not null").groupBy("feature", "value").count()
        modes = counts.groupBy("feature").agg(F.min_by("value", F.struct(-F.col("count"), "value")).alias("value"))
        fills |= {c: "Unknown" for c in texts} | {r["feature"]: r["value"] for r in modes.collect()}
    kinds = {f.name: f.dataType for f in df.schema}
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    widened = df.withColumns({
        c: F.col(c).cast("double") for c, v in fills.items() if isinstance(kinds[c], whole) and float(v) != int(v)
    })
    return widened.fillna(fills)


def clip_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    value = F.col(column)
    return df.withColumn(column, F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value))))


def cap_upper(df: DataFrame, column: str, limit: float) -> DataFrame:
    return df.withColumn(column, F.when(F.col(column) > limit, F.lit(float(limit))).otherwise(F.col(column)))


def _null_counts(df: DataFrame, columns: list[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(c) for c in columns if c in df.columns]


def iqr_bounds(df: DataFrame, columns: list[str], factor: float) -> dict[str, tuple[float, float] | None]:
    quartiles = exact_quantiles(df, {c: [0.25, 0.75] for c in columns})
    out = {}
    for c, (q1, q3) in quartiles.items():
        out[c] = None if q1 is None else (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
    return out


def cap_outliers_iqr(df: DataFrame, column: str, factor: float) -> DataFrame:
    """Clip into [Q1 - f*IQR, Q3 + f*IQR] with interpolated quartiles."""
    bounds = iqr_bounds(df, [column], factor)[column]
    return df if bounds is None else clip_range(df.withColumn(column, F.col(column).cast("double")), column, *bounds)


def enforce_consistency(df: DataFrame) -> DataFrame:
    """Unknown flags are 0; nothing unopened was clicked, nothing unclicked converted."""
    flags = ["opened", "clicked", "converted"]
    out = df.withColumns({c: F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in flags if c in df.columns})
    if not set(flags) <= set(df.columns):
        return out
    out = out.withColumn("clicked", F.when(F.col("opened") == 0, 0).otherwise(F.col("clicked")))
    return out.withColumn("converted", F.when((F.col("opened") == 0) | (F.col("clicked") == 0), 0).otherwise(F.col("converted")))


def standardize_categories(df: DataFrame) -> DataFrame:
    out = {}
    if "gender" in df.columns:
        spelled = F.create_map(*[F.lit(x) for pair in K.GENDER_SPELLINGS.items() for x in pair])
        out["gender"] = F.coalesce(F.try_element_at(spelled, F.lower("gender")), F.lit("Unknown"))
    if "customer_segment" in df.columns:
        out["customer_segment"] = F.initcap("customer_segment")
    if "state" in df.columns:
        out["state"] = F.upper("state")
    return df.withColumns(out)


# ---------------------------------------------------------------- derived columns


def date_parts(df: DataFrame, column: str = "transaction_date", prefix: str = "transaction") -> DataFrame:
    date = F.col(column)
    return df.withColumns({
        f"{prefix}_year": F.year(date), f"{prefix}_month": F.month(date), f"{prefix}_day": F.day(date),
        f"{prefix}_hour": F.hour(date), f"{prefix}_weekday": F.weekday(date),
        "is_weekend": F.weekday(date).isin(5, 6).cast("int"),
    })


def business_hours(df: DataFrame, column: str = "interaction_date") -> DataFrame:
    hour = F.hour(column)
    return df.withColumns({"interaction_hour": hour, "is_business_hours": is_true(hour.between(9, 17)).cast("int")})


def account_age(df: DataFrame, as_of) -> DataFrame:
    days = elapsed_days(F.col("registration_date"), instant(as_of))
    return df.withColumn("account_age_days", days).withColumn("account_age_months", F.col("account_age_days") / K.DAYS_PER_MONTH)


def age_group(df: DataFrame) -> DataFrame:
    return df.withColumn("age_group", right_closed(F.col("age"), *K.AGE_BINS))


def verification_flags(df: DataFrame) -> DataFrame:
    email, phone = F.col("email_verified").cast("boolean"), F.col("phone_verified").cast("boolean")
    return df.withColumns({
        "fully_verified": (email & phone).cast("int"), "verification_level": email.cast("int") + phone.cast("int"),
    })


# ---------------------------------------------------------------- compositions


class Tally:
    """Counts of what a cleaning run removes, fills and caps, taken while its rows pass.

    Each ``watch`` puts an observation into the plan; the first action that runs through it fills it. So
    nothing is worked out again for the report.
    """

    def __init__(self):
        self.seen: list[tuple[Observation, list[tuple[str, str | None]]]] = []

    def watch(self, df: DataFrame, counts: dict[tuple[str, str | None], Column]) -> DataFrame:
        if not counts:
            return df
        seen = Observation()
        self.seen.append((seen, list(counts)))
        return df.observe(seen, *[c.alias(f"m{i}") for i, c in enumerate(counts.values())])

    def counts(self) -> dict[tuple[str, str | None], int]:
        """All counts of frames that an action has run through."""
        return {what: seen.get[f"m{i}"] for seen, whats in self.seen for i, what in enumerate(whats)}


class _NoTally(Tally):
    def watch(self, df, counts):
        return df


NO_TALLY = _NoTally()


def _records(stage: str) -> dict:
    return {(stage, None): F.count(F.lit(1))}


def _missing(df: DataFrame, columns) -> dict:
    return {("missing_handled", c): F.count_if(F.col(c).isNull()) for c in columns if c in df.columns}


def _capped(df: DataFrame, column: str, factor: float, tally: Tally) -> DataFrame:
    """``cap_outliers_iqr`` with the capped rows counted; a null is neither inside nor outside the bounds."""
    bounds = iqr_bounds(df, [column], factor)[column]
    if bounds is None:
        return df
    df = tally.watch(df, {("outliers_capped", column): F.count_if(~F.col(column).between(*map(F.lit, bounds)))})
    return clip_range(df.withColumn(column, F.col(column).cast("double")), column, *bounds)


CUSTOMER_TYPES = {"customer_id": "string", "age": "double", "registration_date": "timestamp_ntz", "churned": "int"}


def clean_customers(df: DataFrame, as_of, deep_clean: bool = True, tally: Tally = NO_TALLY) -> DataFrame:
    has = set(df.columns)
    out = dedup_by_key(tally.watch(df, _records("records_before")), ["customer_id"])
    out = fix_types(out, CUSTOMER_TYPES)
    out = tally.watch(out, _records("unique") | _missing(out, ["customer_id", "registration_date"]))
    out = drop_critical_nulls(out)
    out = tally.watch(out, _missing(out, ["age", *K.CUSTOMER_TEXT_FILLS, *K.CUSTOMER_FLAG_FILLS]))
    if "age" in has:
        out = materialize(out)  # medians, quartiles and the result would each repeat the key shuffle
    if {"age", "customer_segment"} <= has:
        out = impute_group_median(out, "age", "customer_segment")
    elif "age" in has and (median := exact_quantiles(out, {"age": [0.5]})["age"][0]) is not None:
        out = out.fillna({"age": median})
    out = fill_constants(out, {c: "Unknown" for c in K.CUSTOMER_TEXT_FILLS} | {c: False for c in K.CUSTOMER_FLAG_FILLS})
    if "age" in has:
        out = filter_age_range(tally.watch(out, {("rule_violations", "age"): F.count_if(invalid_age())}))
    if "registration_date" in has:
        future = is_true(F.col("registration_date") > instant(as_of))
        out = filter_future_dates(tally.watch(out, {("rule_violations", "registration_date"): F.count_if(future)}), as_of)
    out = tally.watch(out, _records("records_after"))
    if "churned" in has:
        out = clip_binary(out)
    if deep_clean and "age" in has:
        out = _capped(out, "age", K.AGE_IQR_FACTOR, tally)
    if "registration_date" in has:
        out = account_age(out, as_of)
    if "age" in has:
        out = age_group(out)
    if {"email_verified", "phone_verified"} <= has:
        out = verification_flags(out)
    return standardize_categories(out)


TRANSACTION_TYPES = {
    "customer_id": "string", "transaction_id": "string", "total_amount": "double", "discount_amount": "double",
    "transaction_date": "timestamp_ntz",
}
INTERACTION_TYPES = {
    "customer_id": "string", "interaction_id": "string", "duration_seconds": "double", "satisfaction_score": "double",
    "interaction_date": "timestamp_ntz",
}


def valid_transactions(df: DataFrame, as_of, earliest: str) -> DataFrame:
    out = df.where("total_amount > 0")
    if "transaction_date" in df.columns:
        out = filter_date_window(out, "transaction_date", as_of, earliest)
    return filter_status_list(out) if "transaction_status" in df.columns else out


def clean_transactions(
    df: DataFrame, as_of, deep_clean: bool = True, earliest: str = K.EARLIEST_TRANSACTION, tally: Tally = NO_TALLY
) -> DataFrame:
    out = fix_types(dedup_by_key(tally.watch(df, _records("records_before")), ["transaction_id"]), TRANSACTION_TYPES)
    out = valid_transactions(tally.watch(out, _records("unique")), as_of, earliest)
    out = tally.watch(out, _records("records_after") | _missing(out, K.TRANSACTION_FILLS))
    out = fill_constants(out, K.TRANSACTION_FILLS)
    if deep_clean and "total_amount" in df.columns:
        # the quartiles and every later reader would repeat the key shuffle
        out = _capped(materialize(out), "total_amount", K.AMOUNT_IQR_FACTOR, tally)
    return date_parts(out) if "transaction_date" in df.columns else out


def impute_satisfaction(df: DataFrame) -> DataFrame:
    if "interaction_type" in df.columns:
        return impute_group_median(df, "satisfaction_score", "interaction_type")
    median = exact_quantiles(df, {"satisfaction_score": [0.5]})["satisfaction_score"][0]
    return df if median is None else df.fillna({"satisfaction_score": median})


def clean_interactions(df: DataFrame, deep_clean: bool = True, tally: Tally = NO_TALLY) -> DataFrame:
    out = fix_types(dedup_by_key(tally.watch(df, _records("records_before")), ["interaction_id"]), INTERACTION_TYPES)
    out = tally.watch(out, _records("unique") | _records("records_after") | _missing(out, ["satisfaction_score"]))
    if "satisfaction_score" in df.columns:
        out = clip_range(impute_satisfaction(materialize(out)), "satisfaction_score", 1.0, 5.0)
    if deep_clean and "duration_seconds" in df.columns:
        over = F.count_if(F.col("duration_seconds") > K.MAX_DURATION_SECONDS)
        out = cap_upper(tally.watch(out, {("outliers_capped", "duration_seconds"): over}), "duration_seconds", K.MAX_DURATION_SECONDS)
    return business_hours(out) if "interaction_date" in df.columns else out


def clean_marketing(df: DataFrame, tally: Tally = NO_TALLY) -> DataFrame:
    unique = dedup_by_key(tally.watch(df, _records("records_before")), ["campaign_id", "customer_id"])
    return enforce_consistency(tally.watch(unique, _records("unique") | _records("records_after")))


def clean_generic(df: DataFrame, tally: Tally = NO_TALLY) -> DataFrame:
    unique = dedup_rows(tally.watch(df, _records("records_before")))
    filled = numeric_columns(df) + string_columns(df)
    return impute_global(materialize(tally.watch(unique, _records("unique") | _records("records_after") | _missing(df, filled))))


# ---------------------------------------------------------------- report

REPORT_SCHEMA = "dataset string, metric string, column string, value bigint"
ALWAYS = ("records_before", "records_after", "duplicates_removed")


def clean_dataset(name: str, df: DataFrame, as_of, deep_clean: bool = True, earliest: str = K.EARLIEST_TRANSACTION, tally: Tally = NO_TALLY) -> DataFrame:
    """A dataset through the rules of its kind."""
    rules = {
        "customers": lambda: clean_customers(df, as_of, deep_clean, tally),
        "transactions": lambda: clean_transactions(df, as_of, deep_clean, earliest, tally),
        "interactions": lambda: clean_interactions(df, deep_clean, tally),
        "marketing": lambda: clean_marketing(df, tally),
    }
    return rules.get(name, lambda: clean_generic(df, tally))()


def clean_with_report(datasets: dict[str, DataFrame], as_of, earliest: str = K.EARLIEST_TRANSACTION) -> tuple[dict[str, DataFrame], DataFrame]:
    """The cleaned datasets, stored, and the long-form counts of what was removed, filled and capped on the way."""
    cleaned, rows = {}, []
    types = {"customers": CUSTOMER_TYPES, "transactions": TRANSACTION_TYPES, "interactions": INTERACTION_TYPES}
    for name, df in datasets.items():
        tally = Tally()
        cleaned[name] = materialize(clean_dataset(name, df, as_of, True, earliest, tally))
        seen = tally.counts()
        seen["duplicates_removed", None] = seen["records_before", None] - seen.pop(("unique", None))
        seen |= {("types_fixed", c): 1 for c in types.get(name, ()) if c in df.columns}
        rows += [(name, metric, column, n) for (metric, column), n in seen.items() if n or metric in ALWAYS]
    spark = next(iter(datasets.values())).sparkSession
    return cleaned, spark.createDataFrame(rows, REPORT_SCHEMA)


def cleaning_report(datasets: dict[str, DataFrame], as_of, earliest: str = K.EARLIEST_TRANSACTION) -> DataFrame:
    """The counts of ``clean_with_report``."""
    return clean_with_report(datasets, as_of, earliest)[1]
