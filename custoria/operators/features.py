"""Per-customer feature blocks: one aggregation per source table, then left joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custoria import constants as K
from custoria.functions.columns import (
    column_suffix, days_before, elapsed_days, instant, is_true, right_closed, to_long,
)
from custoria.functions.quantiles import BOUNDED_ROWS, aggregate_with_medians

KEY = "customer_id"


def distinct_values(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted values per column that become columns; one job, as many as Spark lets a pivot have."""
    if not columns:
        return {}
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    found = to_long(df, columns, "string").where("value is not null").distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"{columns} have more than {limit} values, too many to become columns")
    return {c: sorted(r["value"] for r in found if r["feature"] == c) for c in columns}


def _pivot_values(df: DataFrame, columns: list[str], given: dict | None) -> dict[str, list[str]]:
    """The caller's category lists, completed by a look-up of the present columns not listed."""
    given = given or {}
    return given | distinct_values(df, [c for c in columns if c in df.columns and c not in given])


def value_counts(counted: str, column: str, values: list[str], prefix: str) -> list[Column]:
    """One conditional count per value, 0 where a customer has none."""
    return [
        F.count(F.when(F.col(column) == v, F.col(counted))).alias(f"{prefix}_{column_suffix(v)}") for v in values
    ]


def sum_or_zero(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))


def most_frequent(column: str) -> Column:
    """Mode with the smallest value on ties; the per-customer map is as wide as the category list."""
    return F.coalesce(F.mode(column, True), F.lit("Unknown"))


# ---------------------------------------------------------------- transactions


def transaction_basics() -> list[Column]:
    amount, date = F.col("total_amount"), F.col("transaction_date")
    return [
        sum_or_zero(amount).alias("total_spent"), F.avg(amount).alias("avg_transaction_value"),
        F.stddev_samp(amount).alias("transaction_value_std"), F.min(amount).alias("min_transaction_value"),
        F.max(amount).alias("max_transaction_value"), F.count(amount).alias("transaction_count"),
        F.count("transaction_id").alias("total_transactions"), F.min(date).alias("first_transaction_date"),
        F.max(date).alias("last_transaction_date"),
    ]


TRANSACTION_MEDIANS = {"median_transaction_value": "total_amount"}


def transaction_windows(as_of, windows=None) -> list[Column]:
    out = []
    for days in windows or K.TRANSACTION_WINDOWS:
        recent = F.col("transaction_date") >= days_before(as_of, days)
        amount = F.when(recent, F.col("total_amount"))
        out += [
            sum_or_zero(amount).alias(f"total_amount_sum_last_{days}d"),
            F.count(amount).alias(f"total_amount_count_last_{days}d"),
            F.count(F.when(recent, F.col("transaction_id"))).alias(f"transaction_id_count_last_{days}d"),
        ]
    return out


def transaction_discounts() -> list[Column]:
    discount = F.col("discount_amount")
    return [
        sum_or_zero(discount).alias("total_discount_received"), F.avg(discount).alias("avg_discount_rate"),
        F.max(discount).alias("max_discount_received"),
        F.avg(is_true(discount > 0).cast("double")).alias("discount_usage_rate"),
    ]


def transaction_weekends() -> list[Column]:
    return [
        sum_or_zero(F.col("is_weekend")).alias("weekend_transactions"),
        F.avg("is_weekend").alias("weekend_transaction_rate"),
    ]


def with_lifetime(block: DataFrame, as_of) -> DataFrame:
    """Span, recency, monthly frequency and mean gap; a zero span gives +inf frequency."""
    days, n = F.col("customer_lifetime_days"), F.col("total_transactions")
    return block.withColumns({
        "customer_lifetime_days": elapsed_days(F.col("first_transaction_date"), F.col("last_transaction_date")),
        "days_since_last_transaction": elapsed_days(F.col("last_transaction_date"), instant(as_of)),
    }).withColumns({
        "purchase_frequency": F.when(days == 0, F.when(n > 0, F.lit(float("inf"))).otherwise(0.0)).otherwise(
            F.coalesce(n / (days / K.DAYS_PER_MONTH), F.lit(0.0))
        ),
        "avg_days_between_purchases": F.coalesce(F.try_divide(days, n), F.lit(0.0)),
    })


def transaction_features(
    transactions: DataFrame, as_of, values: dict[str, list[str]] | None = None, bounded_rows: int = BOUNDED_ROWS
) -> DataFrame:
    """All transaction features of each customer in one aggregation.

    ``values`` may name the category lists per column; those not given are looked up.
    """
    has, keyed = set(transactions.columns), transactions.where(F.col(KEY).isNotNull())
    values = _pivot_values(keyed, ["product_category", "payment_method", "channel"], values)
    aggs = transaction_basics() + transaction_windows(as_of)
    for column, prefix in (("product_category", "purchases"), ("payment_method", "payments"), ("channel", "channel")):
        if column in has:
            aggs += value_counts("transaction_id", column, values[column], prefix)
    if "product_category" in has:
        aggs.append(most_frequent("product_category").alias("favorite_category"))
    if "discount_amount" in has:
        aggs += transaction_discounts()
    if "is_weekend" in has:
        aggs += transaction_weekends()
    return with_lifetime(aggregate_with_medians(keyed, [KEY], aggs, TRANSACTION_MEDIANS, bounded_rows), as_of)


# ---------------------------------------------------------------- interactions


def interaction_basics() -> list[Column]:
    score, duration = F.col("satisfaction_score"), F.col("duration_seconds")
    return [
        F.count("interaction_id").alias("total_interactions"), F.avg(score).alias("avg_satisfaction"),
        F.stddev_samp(score).alias("satisfaction_std"), F.min(score).alias("min_satisfaction"),
        F.max(score).alias("max_satisfaction"), F.avg(duration).alias("avg_interaction_duration"),
        sum_or_zero(duration).alias("total_interaction_time"), F.max(duration).alias("max_interaction_duration"),
    ]


INTERACTION_MEDIANS = {"median_satisfaction": "satisfaction_score", "median_interaction_duration": "duration_seconds"}


def resolution_rate() -> Column:
    return F.avg(is_true(F.col("resolution_status") == "Resolved").cast("double")).alias("resolution_rate")


def interaction_windows(as_of, windows=None) -> list[Column]:
    out = []
    for days in windows or K.INTERACTION_WINDOWS:
        recent = F.col("interaction_date") >= days_before(as_of, days)
        out += [
            F.count(F.when(recent, F.col("interaction_id"))).alias(f"interaction_id_last_{days}d"),
            F.avg(F.when(recent, F.col("satisfaction_score"))).alias(f"satisfaction_score_last_{days}d"),
        ]
    return out


def with_support_intensity(block: DataFrame, types: list[str]) -> DataFrame:
    """Share of support and complaint contacts, when both kinds occur at all."""
    names = [f"interactions_{column_suffix(t)}" for t in types]
    parts = ["interactions_support", "interactions_complaint"]
    if not set(parts) <= set(names):
        return block
    total = sum((F.col(n) for n in names), F.lit(0))
    return block.withColumn("support_intensity", (F.col(parts[0]) + F.col(parts[1])) / (total + 1e-10))


def interaction_features(
    interactions: DataFrame, as_of, values: dict[str, list[str]] | None = None, bounded_rows: int = BOUNDED_ROWS
) -> DataFrame:
    has, keyed = set(interactions.columns), interactions.where(F.col(KEY).isNotNull())
    values = _pivot_values(keyed, ["interaction_type", "channel"], values)
    aggs, types = interaction_basics() + interaction_windows(as_of), []
    if "interaction_type" in has:
        types = values["interaction_type"]
        aggs += value_counts("interaction_id", "interaction_type", types, "interactions")
    if "channel" in has:
        aggs += value_counts("interaction_id", "channel", values["channel"], "interaction_channel")
        aggs.append(most_frequent("channel").alias("preferred_interaction_channel"))
    if "resolution_status" in has:
        aggs.append(resolution_rate())
    block = aggregate_with_medians(keyed, [KEY], aggs, INTERACTION_MEDIANS, bounded_rows)
    return with_support_intensity(block, types)


# ---------------------------------------------------------------- marketing


def marketing_basics() -> list[Column]:
    names = {
        "opened": ("total_emails_opened", "email_open_rate"), "clicked": ("total_emails_clicked", "click_through_rate"),
        "converted": ("total_conversions", "conversion_rate"),
    }
    out = [F.count("campaign_id").alias("total_campaigns_received")]
    for flag, (total, rate) in names.items():
        out += [sum_or_zero(F.col(flag)).alias(total), F.avg(flag).alias(rate)]
    return out


def with_marketing_score(block: DataFrame) -> DataFrame:
    score = F.col("email_open_rate") * 0.3 + F.col("click_through_rate") * 0.3 + F.col("conversion_rate") * 0.4
    return block.withColumn("marketing_engagement_score", score)


def marketing_features(marketing: DataFrame, values: dict[str, list[str]] | None = None) -> DataFrame:
    keyed = marketing.where(F.col(KEY).isNotNull())
    values = _pivot_values(keyed, ["campaign_type"], values)
    aggs = marketing_basics()
    if "campaign_type" in marketing.columns:
        aggs += value_counts("campaign_id", "campaign_type", values["campaign_type"], "campaigns")
    return with_marketing_score(keyed.groupBy(KEY).agg(*aggs))


# ---------------------------------------------------------------- joining blocks


def join_features(base: DataFrame, block: DataFrame, key: str = KEY) -> DataFrame:
    """All base rows, with the block's columns where the text-typed keys match."""
    return base.withColumn(key, F.col(key).cast("string")).join(block.withColumn(key, F.col(key).cast("string")), key, "left")


def align_blocks(blocks: list[DataFrame], key: str = KEY) -> DataFrame:
    """Full outer alignment of several per-key blocks."""
    out = blocks[0]
    for block in blocks[1:]:
        out = out.join(block, key, "full_outer")
    return out


# ---------------------------------------------------------------- projections


def time_features(df: DataFrame) -> DataFrame:
    out = df
    if "registration_date" in df.columns:
        date = F.col("registration_date")
        month = F.month(date)
        season = (
            F.when(month.isin(12, 1, 2), "Winter").when(month.isin(3, 4, 5), "Spring").when(month.isin(6, 7, 8), "Summer").otherwise("Fall")
        )
        out = out.withColumns({
            "registration_year": F.year(date), "registration_month": month, "registration_quarter": F.quarter(date),
            "registration_dayofweek": F.weekday(date), "registration_is_weekend": is_true(F.weekday(date).isin(5, 6)).cast("int"),
            "registration_season": season,
        })
    if "account_age_days" in df.columns:
        days = F.col("account_age_days")
        out = out.withColumns({
            "account_age_months": days / K.DAYS_PER_MONTH, "account_age_years": days / K.DAYS_PER_YEAR,
            "lifetime_segment": right_closed(days, *K.LIFETIME_BINS),
        })
    return out


def behavior_ratios(df: DataFrame) -> DataFrame:
    has, out = set(df.columns), {}
    if {"total_transactions", "account_age_months"} <= has:
        out["monthly_transaction_rate"] = F.col("total_transactions") / (F.col("account_age_months") + 1)
    if {"total_spent", "total_transactions"} <= has:
        out["avg_basket_size"] = F.col("total_spent") / (F.col("total_transactions") + 1e-10)
    if {"total_interactions", "total_transactions"} <= has:
        out["interaction_to_transaction_ratio"] = F.col("total_interactions") / (F.col("total_transactions") + 1e-10)
    return df.withColumns(out)


def activity_status(df: DataFrame) -> DataFrame:
    return df.withColumn("activity_status", right_closed(F.col("days_since_last_transaction"), *K.ACTIVITY_BINS))


def fill_feature_nulls(df: DataFrame, untouched=()) -> DataFrame:
    """Numbers: null and infinity become 0; texts: 'Unknown'. Dates, flags and bins stay."""
    out = {}
    for field in df.schema:
        name, kind, value = field.name, field.dataType, F.col(f"`{field.name}`")
        if name in untouched or name == KEY:
            continue
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            odd = value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))
            out[name] = F.when(odd, F.lit(0.0)).otherwise(value)
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            out[name] = F.coalesce(value, F.lit(0))
        elif isinstance(kind, T.StringType):
            out[name] = F.coalesce(value, F.lit("Unknown"))
    return df.withColumns(out)


def churn_label(activity: DataFrame, as_of, date: str = "transaction_date", days: int = K.CHURN_DAYS) -> DataFrame:
    """1 for customers without any activity in the last ``days`` days."""
    last = activity.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.max(date).alias("last_activity"))
    return last.withColumn("churned", (F.col("last_activity") < days_before(as_of, days)).cast("int"))
