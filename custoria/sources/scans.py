"""Source scans. Filters and column lists are declared so that the reader can push them down."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custoria.constants import DEFAULT_LOOKBACK_DAYS, EXCLUDED_ACCOUNT_STATUSES
from custoria.functions.columns import days_before, instant

# The columns each dataset offers to the later stages.
CUSTOMER_COLUMNS = (
    "customer_id registration_date date_of_birth age gender country state city postal_code acquisition_channel "
    "acquisition_campaign customer_segment customer_tier lifetime_value preferred_contact_method email_verified "
    "phone_verified account_status churn_date churned created_at updated_at"
).split()
TRANSACTION_COLUMNS = (
    "transaction_id customer_id transaction_date product_id product_name product_category product_subcategory "
    "quantity unit_price total_amount discount_amount tax_amount payment_method payment_status transaction_status "
    "channel device_type session_id"
).split()
INTERACTION_COLUMNS = (
    "interaction_id customer_id interaction_date interaction_type interaction_subtype channel agent_id "
    "duration_seconds wait_time_seconds resolution_status satisfaction_score nps_score sentiment_score ticket_id tags"
).split()
MARKETING_COLUMNS = (
    "campaign_id customer_id campaign_date campaign_type campaign_name campaign_category channel sent opened clicked "
    "converted unsubscribed bounced cost revenue_attributed"
).split()


def _date_range(date_range, as_of):
    if date_range is not None:
        return instant(date_range[0]), instant(date_range[1])
    return days_before(as_of, DEFAULT_LOOKBACK_DAYS), instant(as_of)


def _present(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select([c for c in columns if c in df.columns])


def scan_customers(customers: DataFrame, date_range=None, as_of=None) -> DataFrame:
    """Customers registered in the inclusive range whose account is known to be real."""
    low, high = _date_range(date_range, as_of)
    kept = customers.where(F.col("registration_date").between(low, high))
    if "account_status" in customers.columns:
        kept = kept.where(~F.col("account_status").isin(EXCLUDED_ACCOUNT_STATUSES))
    return _present(kept, CUSTOMER_COLUMNS)


def join_dimension(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Facts LEFT JOIN a dimension on one equi key.

    No broadcast hint: Spark broadcasts the dimension when its size allows and
    otherwise sort-merges, with skewed keys split at run time.
    """
    return facts.join(dimension, key, "left")


def scan_transactions(transactions: DataFrame, products: DataFrame, date_range=None, as_of=None) -> DataFrame:
    """Completed transactions in the inclusive range, with product attributes."""
    low, high = _date_range(date_range, as_of)
    kept = transactions.where(
        F.col("transaction_date").between(low, high) & (F.col("transaction_status") == "completed")
    )
    return _present(join_dimension(kept, products, "product_id"), TRANSACTION_COLUMNS)


def scan_interactions(interactions: DataFrame, date_range=None, as_of=None) -> DataFrame:
    low, high = _date_range(date_range, as_of)
    return _present(interactions.where(F.col("interaction_date").between(low, high)), INTERACTION_COLUMNS)


def scan_marketing(marketing: DataFrame, date_range=None, as_of=None) -> DataFrame:
    """Campaign rows in the inclusive range that were really sent."""
    low, high = _date_range(date_range, as_of)
    return _present(marketing.where(F.col("campaign_date").between(low, high) & F.col("sent")), MARKETING_COLUMNS)


def sql_query(spark: SparkSession, text: str, params: dict | None = None, **views: DataFrame) -> DataFrame:
    """SQL text with ``:name`` parameters over the given frames; the session's own views stay as they are."""
    body = text.replace("{", "{{").replace("}", "}}")
    if views:
        named = ", ".join(f"{name} AS (SELECT * FROM {{{name}}})" for name in views)
        own = re.match(r"\s*with\b", body, re.IGNORECASE)
        body = f"WITH {named}, {body[own.end():]}" if own else f"WITH {named} {body}"
    return spark.sql(body, args=params or {}, **views)


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int] | None = None,
    partitions: int = 32, fetch_rows: int = 10_000, **options,
) -> DataFrame:
    """Table of a relational source, read by ``partitions`` tasks when a numeric key is named."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize=fetch_rows, **options)
    if key is not None:
        reader = reader.options(
            partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load()
