"""Quantile and rank based scores over whole customer columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from custoria import constants as K
from custoria.functions.columns import elapsed_days, instant, quantile_bin, rank_bin
from custoria.functions.quantiles import BOUNDED_ROWS, exact_quantiles
from custoria.functions.ranking import attach_percent_ranks, row_positions
from custoria.session import materialize

KEY = "customer_id"
QUINTILES = [0.2, 0.4, 0.6, 0.8]
QUARTILES = [0.25, 0.5, 0.75]


def rfm_values(transactions: DataFrame, as_of) -> DataFrame:
    grouped = transactions.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(
        F.max("transaction_date").alias("_last"), F.count("transaction_id").alias("frequency"),
        F.coalesce(F.sum("total_amount"), F.lit(0.0)).alias("monetary"),
    )
    return grouped.select(KEY, elapsed_days(F.col("_last"), instant(as_of)).cast("bigint").alias("recency"), "frequency", "monetary")


def rfm_scores(values: DataFrame, bounded_rows: int = BOUNDED_ROWS) -> DataFrame:
    """Quintile scores: recent, frequent and high-spending customers get 5.

    Recency and spend are cut at value quintiles, frequency by its rank with the
    customer id breaking ties.
    """
    placed = materialize(
        row_positions(values, ["frequency", KEY], bounded_rows).withColumnRenamed("position", "_rank")
    )
    edges = exact_quantiles(placed, {"recency": QUINTILES, "monetary": QUINTILES}, bounded_rows)
    n = placed.count()
    scored = placed.withColumns({
        "r_score": F.lit(6) - quantile_bin(F.col("recency"), edges["recency"]),
        "f_score": rank_bin(F.col("_rank"), n, 5),
        "m_score": quantile_bin(F.col("monetary"), edges["monetary"]),
    })
    code = F.concat(*[F.col(f"{s}_score").cast("string") for s in "rfm"])
    return scored.withColumn("rfm_score", code).drop("_rank")


def rfm_segment(scored: DataFrame) -> DataFrame:
    """Name of the segment listing the customer's score code, else 'Other'."""
    names = F.create_map(*[F.lit(x) for name, codes in K.RFM_SEGMENTS.items() for c in codes.split() for x in (c, name)])
    return scored.withColumn("rfm_segment", F.coalesce(F.try_element_at(names, F.col("rfm_score")), F.lit("Other")))


def rfm_features(transactions: DataFrame, as_of, bounded_rows: int = BOUNDED_ROWS) -> DataFrame:
    return rfm_segment(rfm_scores(rfm_values(transactions, as_of), bounded_rows))


def quartile_label(df: DataFrame, column: str, name: str, labels: list[str], bounded_rows: int = BOUNDED_ROWS) -> DataFrame:
    """Label of the value quartile; null stays null."""
    edges = exact_quantiles(df, {column: QUARTILES}, bounded_rows)[column]
    if edges[0] is None:
        return df.withColumn(name, F.lit(None).cast("string"))
    label = F.when(F.col(column) > edges[-1], labels[-1])
    for edge, text in zip(reversed(edges[:-1]), reversed(labels[1:-1])):
        label = label.when(F.col(column) > edge, text)
    return df.withColumn(name, label.when(F.col(column).isNotNull(), labels[0]))


def value_segment(df: DataFrame, bounded_rows: int = BOUNDED_ROWS) -> DataFrame:
    return quartile_label(df, "total_spent", "value_segment", K.VALUE_LABELS, bounded_rows)


def engagement_score(df: DataFrame, bounded_rows: int = BOUNDED_ROWS) -> DataFrame:
    """Weighted percent ranks plus satisfaction over the columns present; null if a part is null."""
    has = set(df.columns)
    sources = [c for c in ("purchase_frequency", "total_spent", "days_since_last_transaction") if c in has]
    ranked = attach_percent_ranks(df, {c: f"_rank_{c}" for c in sources}, bounded_rows) if sources else df
    parts = {
        "purchase_frequency": F.col("_rank_purchase_frequency") * 0.3,
        "total_spent": F.col("_rank_total_spent") * 0.3,
        "days_since_last_transaction": (F.lit(1) - F.col("_rank_days_since_last_transaction")) * 0.2,
        "avg_satisfaction": F.col("avg_satisfaction") / 5 * 0.2,
    }
    terms = [term for c, term in parts.items() if c in has]
    if not terms:
        return df
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return ranked.withColumn("engagement_score", total).drop(*[f"_rank_{c}" for c in sources])


def engagement_level(df: DataFrame, bounded_rows: int = BOUNDED_ROWS) -> DataFrame:
    return quartile_label(df, "engagement_score", "engagement_level", K.ENGAGEMENT_LABELS, bounded_rows)


def health_score(df: DataFrame) -> DataFrame:
    parts = {
        "resolution_rate": F.col("resolution_rate") * 0.2, "support_intensity": (F.lit(1) - F.col("support_intensity")) * 0.3,
        "email_open_rate": F.col("email_open_rate") * 0.2, "fully_verified": F.col("fully_verified") * 0.3,
    }
    terms = [term for c, term in parts.items() if c in df.columns]
    if not terms:
        return df
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return df.withColumn("health_score", total)


def top_k_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values, the smaller value first on ties."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(k)


def top_k_per_group(df: DataFrame, group: list[str], order: list, k: int) -> DataFrame:
    """Best k rows per group; the rank limit also runs before the shuffle."""
    return df.withColumn("_rank", F.row_number().over(W.partitionBy(*group).orderBy(*order))).where(F.col("_rank") <= k).drop("_rank")
