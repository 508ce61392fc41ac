"""Feature blocks, scores and the master table on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import views as V
from bindings.cleaning import CLEAN_CUSTOMERS, CLEAN_INTERACTIONS, CLEAN_LINES, CLEAN_MARKETING, EARLIEST
from bindings.registry import query
from bindings.views import oracle
from custoria import constants as K
from custoria.functions.columns import column_suffix
from custoria.functions.quantiles import aggregate_with_medians
from custoria.operators import cleaning as C
from custoria.operators import features as X
from custoria.operators import scores as S
from custoria.plans import stages

AS_OF, EVENTS_AS_OF = V.ORDERS_AS_OF, V.EVENTS_AS_OF

# Categories of the test tables, in sorted order.
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
PAYMENTS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
LINE_CHANNELS = ["Mobile App", "Web"]
INTERACTION_TYPES = ["Click", "Complaint", "Purchase", "Support", "View"]
INTERACTION_CHANNELS = ["Email", "Live Chat", "Phone"]
CAMPAIGN_TYPES = ["Email", "Push", "SMS"]
SEGMENTS = ["Automobile", "Building", "Furniture", "Household", "Machinery"]


# a mean of few amounts often ends exactly half-way between two rounded values
NUDGE = 1.3e-7


def rounded(df, digits: int = 4):
    """Doubles rounded for comparison: nudged off exact half-way points, negative zero removed."""
    return df.withColumns({
        f.name: F.round(F.col(f"`{f.name}`") + NUDGE, digits) + 0.0 for f in df.schema if f.dataType.typeName() == "double"
    })


def r4(expr: str, name: str) -> str:
    return f"round({expr} + {NUDGE}, 4) + 0.0 AS {name}"


# ---------------------------------------------------------------- SQL pieces, unrounded

BASIC = """coalesce(sum(total_amount), 0) AS total_spent, avg(total_amount) AS avg_transaction_value,
  stddev_samp(total_amount) AS transaction_value_std, min(total_amount) AS min_transaction_value,
  max(total_amount) AS max_transaction_value, count(total_amount) AS transaction_count,
  count(transaction_id) AS total_transactions, min(transaction_date) AS first_transaction_date,
  max(transaction_date) AS last_transaction_date, median(total_amount) AS median_transaction_value"""
WINDOWS = ", ".join(
    f"coalesce(sum(total_amount) FILTER (transaction_date >= TIMESTAMP '{AS_OF}' - INTERVAL {d} DAY), 0) AS total_amount_sum_last_{d}d, "
    f"count(total_amount) FILTER (transaction_date >= TIMESTAMP '{AS_OF}' - INTERVAL {d} DAY) AS total_amount_count_last_{d}d, "
    f"count(transaction_id) FILTER (transaction_date >= TIMESTAMP '{AS_OF}' - INTERVAL {d} DAY) AS transaction_id_count_last_{d}d"
    for d in K.TRANSACTION_WINDOWS
)


def counts_sql(counted: str, column: str, values: list[str], prefix: str) -> str:
    return ", ".join(f"count({counted}) FILTER ({column} = '{v}') AS \"{prefix}_{column_suffix(v)}\"" for v in values)


def favorite_sql(table: str, column: str, name: str) -> str:
    """Most frequent value per customer, smallest on ties, 'Unknown' without any."""
    return (
        f"SELECT customer_id, coalesce(v, 'Unknown') AS {name} FROM (SELECT DISTINCT customer_id FROM {table}) LEFT JOIN "
        f"(SELECT customer_id, {column} AS v, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, {column}) AS rn "
        f"FROM {table} WHERE {column} IS NOT NULL GROUP BY customer_id, {column}) USING (customer_id) WHERE rn = 1 OR rn IS NULL"
    )


DISCOUNTS = """coalesce(sum(discount_amount), 0) AS total_discount_received, avg(discount_amount) AS avg_discount_rate,
  max(discount_amount) AS max_discount_received, avg(CASE WHEN discount_amount > 0 THEN 1.0 ELSE 0.0 END) AS discount_usage_rate"""
WEEKEND = "CAST(sum(is_weekend) AS BIGINT) AS weekend_transactions, avg(is_weekend) AS weekend_transaction_rate"
LIFETIME = f"""
SELECT *, CASE WHEN customer_lifetime_days = 0 THEN 'infinity'::DOUBLE ELSE total_transactions / (customer_lifetime_days / 30.44) END AS purchase_frequency,
  customer_lifetime_days / total_transactions AS avg_days_between_purchases
FROM (SELECT *, date_sub('day', first_transaction_date, last_transaction_date) AS customer_lifetime_days,
  date_sub('day', last_transaction_date, TIMESTAMP '{AS_OF}') AS days_since_last_transaction FROM {{block}})"""
DOUBLES = (
    "total_spent avg_transaction_value transaction_value_std min_transaction_value max_transaction_value median_transaction_value"
).split()


def round_replace(columns) -> str:
    return "* REPLACE (" + ", ".join(r4(f'"{c}"', f'"{c}"') for c in columns) + ")"


# ---------------------------------------------------------------- transaction block


@query("txn_basic_agg", oracle("transactions", f"SELECT {round_replace(DOUBLES)} FROM (SELECT customer_id, {BASIC} FROM transactions GROUP BY customer_id)"))
def txn_basic_agg(spark, sf):
    return rounded(aggregate_with_medians(V.transactions(spark, sf), ["customer_id"], X.transaction_basics(), X.TRANSACTION_MEDIANS))


@query("txn_lifetime", oracle("transactions", f"""
SELECT customer_id, customer_lifetime_days, days_since_last_transaction, {r4("purchase_frequency", "purchase_frequency")},
  {r4("avg_days_between_purchases", "avg_days_between_purchases")}, purchase_frequency = 'infinity'::DOUBLE AS single_day
FROM l""", b=f"SELECT customer_id, {BASIC} FROM transactions GROUP BY customer_id", l=LIFETIME.format(block="b"))
       .replace("round(purchase_frequency", "round(CASE WHEN isinf(purchase_frequency) THEN 0 ELSE purchase_frequency END"))
def txn_lifetime(spark, sf):
    block = X.with_lifetime(V.transactions(spark, sf).groupBy("customer_id").agg(*X.transaction_basics()), AS_OF)
    once = F.col("purchase_frequency") == float("inf")
    return rounded(
        block.withColumn("single_day", once)
        .withColumn("purchase_frequency", F.when(once, 0.0).otherwise(F.col("purchase_frequency")))
        .select("customer_id", "customer_lifetime_days", "days_since_last_transaction", "purchase_frequency", "avg_days_between_purchases", "single_day")
    )


@query("txn_recent_windows", oracle("transactions", f"""
SELECT {round_replace([f"total_amount_sum_last_{d}d" for d in K.TRANSACTION_WINDOWS])}
FROM (SELECT customer_id, {WINDOWS} FROM transactions GROUP BY customer_id)"""))
def txn_recent_windows(spark, sf):
    return rounded(V.transactions(spark, sf).groupBy("customer_id").agg(*X.transaction_windows(AS_OF)))


def _pivot(name, table, column, values, counted, prefix, view):
    sql = f"SELECT customer_id, {counts_sql(counted, column, values, prefix)} FROM {table} GROUP BY customer_id"

    @query(name, oracle(table, sql))
    def run(spark, sf):
        df = view(spark, sf)
        found = X.distinct_values(df, [column])[column]
        return df.groupBy("customer_id").agg(*X.value_counts(counted, column, found, prefix))

    return run


_pivot("txn_category_pivot", "lines", "product_category", CATEGORIES, "transaction_id", "purchases", V.lines)
_pivot("txn_payment_pivot", "transactions", "payment_method", PAYMENTS, "transaction_id", "payments", V.transactions)
_pivot("txn_channel_pivot", "lines", "channel", LINE_CHANNELS, "transaction_id", "channel", V.lines)
_pivot("int_type_pivot", "interactions", "interaction_type", INTERACTION_TYPES, "interaction_id", "interactions", V.interactions)
_pivot("mkt_type_pivot", "marketing", "campaign_type", CAMPAIGN_TYPES, "campaign_id", "campaigns", V.marketing)
_pivot("int_channel_pivot", "interactions", "channel", INTERACTION_CHANNELS, "interaction_id", "interaction_channel", V.interactions)


@query("txn_favorite_category", oracle("lines", favorite_sql("lines", "product_category", "favorite_category")))
def txn_favorite_category(spark, sf):
    return V.lines(spark, sf).groupBy("customer_id").agg(X.most_frequent("product_category").alias("favorite_category"))


@query("int_preferred_channel", oracle("interactions", favorite_sql("interactions", "channel", "preferred_interaction_channel")))
def int_preferred_channel(spark, sf):
    return V.interactions(spark, sf).groupBy("customer_id").agg(X.most_frequent("channel").alias("preferred_interaction_channel"))


@query("txn_discounts", oracle("lines", f"""
SELECT {round_replace(["total_discount_received", "avg_discount_rate", "max_discount_received", "discount_usage_rate"])}
FROM (SELECT customer_id, {DISCOUNTS} FROM lines GROUP BY customer_id)"""))
def txn_discounts(spark, sf):
    return rounded(V.lines(spark, sf).groupBy("customer_id").agg(*X.transaction_discounts()))


@query("txn_weekend", oracle("transactions", f"""
SELECT {round_replace(["weekend_transaction_rate"])} FROM (SELECT customer_id, {WEEKEND}
FROM (SELECT *, CAST(isodow(transaction_date) IN (6, 7) AS INT) AS is_weekend FROM transactions) GROUP BY customer_id)"""))
def txn_weekend(spark, sf):
    return rounded(C.date_parts(V.transactions(spark, sf)).groupBy("customer_id").agg(*X.transaction_weekends()))


# ---------------------------------------------------------------- interaction block

INT_BASIC = """count(interaction_id) AS total_interactions, avg(satisfaction_score) AS avg_satisfaction,
  stddev_samp(satisfaction_score) AS satisfaction_std, min(satisfaction_score) AS min_satisfaction,
  max(satisfaction_score) AS max_satisfaction, avg(duration_seconds) AS avg_interaction_duration,
  coalesce(sum(duration_seconds), 0) AS total_interaction_time, max(duration_seconds) AS max_interaction_duration,
  median(satisfaction_score) AS median_satisfaction, median(duration_seconds) AS median_interaction_duration"""
INT_DOUBLES = (
    "avg_satisfaction satisfaction_std min_satisfaction max_satisfaction avg_interaction_duration total_interaction_time "
    "max_interaction_duration median_satisfaction median_interaction_duration"
).split()


def int_windows_sql(as_of: str) -> str:
    return ", ".join(
        f"count(interaction_id) FILTER (interaction_date >= TIMESTAMP '{as_of}' - INTERVAL {d} DAY) AS interaction_id_last_{d}d, "
        f"avg(satisfaction_score) FILTER (interaction_date >= TIMESTAMP '{as_of}' - INTERVAL {d} DAY) AS satisfaction_score_last_{d}d"
        for d in K.INTERACTION_WINDOWS
    )


RESOLUTION = "avg(CASE WHEN resolution_status = 'Resolved' THEN 1.0 ELSE 0.0 END) AS resolution_rate"
SUPPORT = (
    "count(interaction_id) FILTER (interaction_type IN ('Support', 'Complaint')) "
    "/ (count(interaction_id) FILTER (interaction_type IS NOT NULL) + 1e-10) AS support_intensity"
)


@query("int_basic_agg", oracle("interactions", f"SELECT {round_replace(INT_DOUBLES)} FROM (SELECT customer_id, {INT_BASIC} FROM interactions GROUP BY customer_id)"))
def int_basic_agg(spark, sf):
    return rounded(aggregate_with_medians(V.interactions(spark, sf), ["customer_id"], X.interaction_basics(), X.INTERACTION_MEDIANS))


@query("int_support_intensity", oracle("interactions", f"""
SELECT {round_replace(["support_intensity"])} FROM (SELECT customer_id, {SUPPORT} FROM interactions GROUP BY customer_id)"""))
def int_support_intensity(spark, sf):
    df = V.interactions(spark, sf)
    types = X.distinct_values(df, ["interaction_type"])["interaction_type"]
    block = df.groupBy("customer_id").agg(*X.value_counts("interaction_id", "interaction_type", types, "interactions"))
    return rounded(X.with_support_intensity(block, types).select("customer_id", "support_intensity"))


@query("int_resolution_rate", oracle("interactions", f"""
SELECT {round_replace(["resolution_rate"])} FROM (SELECT customer_id, {RESOLUTION} FROM interactions GROUP BY customer_id)"""))
def int_resolution_rate(spark, sf):
    return rounded(V.interactions(spark, sf).groupBy("customer_id").agg(X.resolution_rate()))


@query("int_recent_windows", oracle("interactions", f"""
SELECT {round_replace([f"satisfaction_score_last_{d}d" for d in K.INTERACTION_WINDOWS])}
FROM (SELECT customer_id, {int_windows_sql("2024-02-20")} FROM interactions GROUP BY customer_id)"""))
def int_recent_windows(spark, sf):
    return rounded(V.interactions(spark, sf).groupBy("customer_id").agg(*X.interaction_windows("2024-02-20")))


# ---------------------------------------------------------------- marketing block

MKT_BASIC = """count(campaign_id) AS total_campaigns_received,
  CAST(sum(opened) AS BIGINT) AS total_emails_opened, avg(opened) AS email_open_rate,
  CAST(sum(clicked) AS BIGINT) AS total_emails_clicked, avg(clicked) AS click_through_rate,
  CAST(sum(converted) AS BIGINT) AS total_conversions, avg(converted) AS conversion_rate"""
MKT_SCORE = "email_open_rate * 0.3 + click_through_rate * 0.3 + conversion_rate * 0.4 AS marketing_engagement_score"
MKT_RATES = ["email_open_rate", "click_through_rate", "conversion_rate"]


@query("mkt_agg", oracle("marketing", f"""
SELECT {round_replace(MKT_RATES)} FROM (SELECT customer_id, {MKT_BASIC} FROM clean_marketing GROUP BY customer_id)""", **CLEAN_MARKETING))
def mkt_agg(spark, sf):
    return rounded(C.clean_marketing(V.marketing(spark, sf)).groupBy("customer_id").agg(*X.marketing_basics()))


@query("mkt_engagement", oracle("marketing", f"""
SELECT customer_id, {r4("marketing_engagement_score", "marketing_engagement_score")} FROM (SELECT *, {MKT_SCORE}
FROM (SELECT customer_id, {MKT_BASIC} FROM clean_marketing GROUP BY customer_id))""", **CLEAN_MARKETING))
def mkt_engagement(spark, sf):
    block = X.marketing_features(C.clean_marketing(V.marketing(spark, sf)), {"campaign_type": CAMPAIGN_TYPES})
    return rounded(block.select("customer_id", "marketing_engagement_score"))


# ---------------------------------------------------------------- joins


@query("join_left_features", oracle("customers interactions", f"""
SELECT c.customer_id, c.state, total_interactions, {r4("avg_satisfaction", "avg_satisfaction")}
FROM customers c LEFT JOIN (SELECT customer_id, {INT_BASIC} FROM interactions GROUP BY customer_id) i ON c.customer_id = i.customer_id"""))
def join_left_features(spark, sf):
    block = V.interactions(spark, sf).groupBy("customer_id").agg(*X.interaction_basics())
    return rounded(X.join_features(V.customers(spark, sf), block).select("customer_id", "state", "total_interactions", "avg_satisfaction"))


@query("join_align_blocks", oracle("transactions interactions", """
SELECT coalesce(a.customer_id, b.customer_id) AS customer_id, orders, contacts
FROM (SELECT customer_id, count(*) AS orders FROM transactions GROUP BY customer_id) a
FULL JOIN (SELECT customer_id, count(*) AS contacts FROM interactions GROUP BY customer_id) b ON a.customer_id = b.customer_id"""))
def join_align_blocks(spark, sf):
    return X.align_blocks([
        V.transactions(spark, sf).groupBy("customer_id").agg(F.count("*").alias("orders")),
        V.interactions(spark, sf).groupBy("customer_id").agg(F.count("*").alias("contacts")),
    ])


# ---------------------------------------------------------------- ranks and quantiles

RFM_VALUES = f"""
SELECT customer_id, date_sub('day', max(transaction_date), TIMESTAMP '{AS_OF}') AS recency, count(transaction_id) AS frequency,
  sum(total_amount) AS monetary FROM {{table}} GROUP BY customer_id"""


def rfm_ctes(table: str) -> dict[str, str]:
    cut = " + ".join(f"CAST({{c}} > {{c}}_{q} AS INT)" for q in (20, 40, 60, 80))
    edges = ", ".join(f"quantile_cont({c}, 0.{q // 10}) AS {c}_{q}" for c in ("recency", "monetary") for q in (20, 40, 60, 80))
    codes = " ".join(f"WHEN rfm_score IN ({', '.join(repr(c) for c in codes.split())}) THEN '{n}'" for n, codes in K.RFM_SEGMENTS.items())
    return {
        "rfm_values": RFM_VALUES.format(table=table),
        "rfm_edges": f"SELECT {edges} FROM rfm_values",
        "rfm_scored": f"""
SELECT *, r_score::VARCHAR || f_score::VARCHAR || m_score::VARCHAR AS rfm_score FROM (
SELECT customer_id, recency, frequency, monetary, CAST(5 - ({cut.format(c="recency")}) AS INT) AS r_score,
  CAST(greatest(1, (5 * (row_number() OVER (ORDER BY frequency, customer_id) - 1) + (count(*) OVER ()) - 2) // greatest((count(*) OVER ()) - 1, 1)) AS INT) AS f_score,
  CAST(1 + {cut.format(c="monetary")} AS INT) AS m_score FROM rfm_values, rfm_edges)""",
        "rfm": f"SELECT *, CASE {codes} ELSE 'Other' END AS rfm_segment FROM rfm_scored",
    }


@query("rfm_values", oracle("transactions", f"SELECT {round_replace(['monetary'])} FROM ({RFM_VALUES.format(table='transactions')})"))
def rfm_values(spark, sf):
    return rounded(S.rfm_values(V.transactions(spark, sf), AS_OF))


@query("rfm_scores", oracle("transactions", "SELECT customer_id, r_score, f_score, m_score, rfm_score FROM rfm", **rfm_ctes("transactions")))
def rfm_scores(spark, sf):
    scored = S.rfm_scores(S.rfm_values(V.transactions(spark, sf), AS_OF))
    return scored.select("customer_id", "r_score", "f_score", "m_score", "rfm_score")


@query("rfm_segment", oracle("transactions", f"SELECT {round_replace(['monetary'])} FROM rfm", **rfm_ctes("transactions")))
def rfm_segment(spark, sf):
    return rounded(S.rfm_features(V.transactions(spark, sf), AS_OF))


def quartile_case(value: str, low: str, mid: str, high: str, labels: list[str]) -> str:
    return (
        f"CASE WHEN {value} IS NULL THEN NULL WHEN {value} <= {low} THEN '{labels[0]}' WHEN {value} <= {mid} THEN '{labels[1]}' "
        f"WHEN {value} <= {high} THEN '{labels[2]}' ELSE '{labels[3]}' END"
    )


def pct_rank(column: str) -> str:
    """Average rank of ties over the non-null count."""
    return (
        f"CASE WHEN {column} IS NOT NULL THEN (rank() OVER (ORDER BY {column}) + (count(*) OVER (PARTITION BY {column}) - 1) / 2) "
        f"/ (SELECT count({column}) FROM {{table}}) END"
    )


SPENT = "SELECT customer_id, sum(total_amount) AS total_spent FROM transactions GROUP BY customer_id"


@query("value_segment", oracle("transactions", f"""
SELECT customer_id, {quartile_case("total_spent", "a", "b", "c", K.VALUE_LABELS)} AS value_segment FROM spent, e""",
    spent=SPENT, e="SELECT quantile_cont(total_spent, 0.25) AS a, quantile_cont(total_spent, 0.5) AS b, quantile_cont(total_spent, 0.75) AS c FROM spent"))
def value_segment(spark, sf):
    spent = V.transactions(spark, sf).groupBy("customer_id").agg(F.sum("total_amount").alias("total_spent"))
    return S.value_segment(spent).select("customer_id", "value_segment")


ENGAGEMENT_CTES = {
    "t": f"SELECT customer_id, {BASIC} FROM transactions GROUP BY customer_id",
    "life": LIFETIME.format(block="t"),
    "base": """SELECT c.customer_id, purchase_frequency, total_spent, days_since_last_transaction, avg_satisfaction FROM customers c
LEFT JOIN life ON c.customer_id = life.customer_id
LEFT JOIN (SELECT customer_id, avg(satisfaction_score) AS avg_satisfaction FROM interactions GROUP BY customer_id) i ON i.customer_id = c.customer_id""",
    "scored": f"""
SELECT customer_id, ({pct_rank("purchase_frequency")}) * 0.3 + ({pct_rank("total_spent")}) * 0.3
  + (1 - ({pct_rank("days_since_last_transaction")})) * 0.2 + avg_satisfaction / 5 * 0.2 AS engagement_score FROM {{table}}""".format(table="base"),
}


def _engagement_base(spark, sf):
    block = X.with_lifetime(V.transactions(spark, sf).groupBy("customer_id").agg(*X.transaction_basics()), AS_OF)
    satisfaction = V.interactions(spark, sf).groupBy("customer_id").agg(F.avg("satisfaction_score").alias("avg_satisfaction"))
    base = X.join_features(X.join_features(V.customers(spark, sf).select("customer_id"), block), satisfaction)
    return base.select("customer_id", "purchase_frequency", "total_spent", "days_since_last_transaction", "avg_satisfaction")


@query("engagement_score", oracle("customers transactions interactions", f"SELECT customer_id, {r4('engagement_score', 'engagement_score')} FROM scored", **ENGAGEMENT_CTES))
def engagement_score(spark, sf):
    return rounded(S.engagement_score(_engagement_base(spark, sf)).select("customer_id", "engagement_score"))


@query("engagement_level", oracle("customers transactions interactions", f"""
SELECT customer_id, {quartile_case("engagement_score", "a", "b", "c", K.ENGAGEMENT_LABELS)} AS engagement_level FROM scored, e""",
    **ENGAGEMENT_CTES, e="""SELECT quantile_cont(engagement_score, 0.25) AS a, quantile_cont(engagement_score, 0.5) AS b,
    quantile_cont(engagement_score, 0.75) AS c FROM scored"""))
def engagement_level(spark, sf):
    scored = stages.materialize(S.engagement_score(_engagement_base(spark, sf)))
    return S.engagement_level(scored).select("customer_id", "engagement_level")


@query("top_k_values", oracle("interactions", """
SELECT interaction_type, count(*) AS n FROM interactions GROUP BY interaction_type ORDER BY n DESC, interaction_type LIMIT 3"""))
def top_k_values(spark, sf):
    return S.top_k_values(V.interactions(spark, sf), "interaction_type", 3)


# ---------------------------------------------------------------- projections

TIME = """CAST(year(registration_date) AS INT) AS registration_year, CAST(month(registration_date) AS INT) AS registration_month,
  CAST(quarter(registration_date) AS INT) AS registration_quarter, CAST(isodow(registration_date) - 1 AS INT) AS registration_dayofweek,
  CASE WHEN isodow(registration_date) IN (6, 7) THEN 1 ELSE 0 END AS registration_is_weekend,
  CASE WHEN month(registration_date) IN (12, 1, 2) THEN 'Winter' WHEN month(registration_date) IN (3, 4, 5) THEN 'Spring'
    WHEN month(registration_date) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS registration_season,
  account_age_days / 365.25 AS account_age_years,
  CASE WHEN account_age_days <= 0 THEN NULL WHEN account_age_days <= 30 THEN 'New' WHEN account_age_days <= 90 THEN 'Getting Started'
    WHEN account_age_days <= 180 THEN 'Regular' WHEN account_age_days <= 365 THEN 'Established' WHEN account_age_days <= 730 THEN 'Loyal'
    WHEN account_age_days IS NOT NULL THEN 'Veteran' END AS lifetime_segment"""
AGED = f"SELECT *, date_sub('day', registration_date, TIMESTAMP '{AS_OF}') AS account_age_days FROM customers"


@query("time_features", oracle("customers", f"SELECT customer_id, {TIME.replace('account_age_days / 365.25', 'round(account_age_days / 365.25 + 1.3e-7, 4)')} FROM ({AGED})"))
def time_features(spark, sf):
    timed = X.time_features(C.account_age(V.customers(spark, sf), AS_OF))
    names = [f"registration_{n}" for n in ("year", "month", "quarter", "dayofweek", "is_weekend", "season")]
    return rounded(timed.select("customer_id", *names, "account_age_years", "lifetime_segment"))


RATIOS = """total_transactions / (account_age_months + 1) AS monthly_transaction_rate, total_spent / (total_transactions + 1e-10) AS avg_basket_size,
  total_interactions / (total_transactions + 1e-10) AS interaction_to_transaction_ratio"""
ACTIVITY = """CASE WHEN days_since_last_transaction <= 0 THEN NULL WHEN days_since_last_transaction <= 30 THEN 'Very Active'
  WHEN days_since_last_transaction <= 60 THEN 'Active' WHEN days_since_last_transaction <= 90 THEN 'Moderate'
  WHEN days_since_last_transaction <= 180 THEN 'Inactive' WHEN days_since_last_transaction IS NOT NULL THEN 'Dormant' END AS activity_status"""


@query("behavior_ratios", oracle("customers transactions interactions", f"""
SELECT customer_id, {r4("monthly_transaction_rate", "monthly_transaction_rate")}, {r4("avg_basket_size", "avg_basket_size")},
  {r4("interaction_to_transaction_ratio", "interaction_to_transaction_ratio")}, activity_status
FROM (SELECT a.customer_id, {RATIOS}, {ACTIVITY} FROM (SELECT *, account_age_days / 30.44 AS account_age_months FROM ({AGED})) a
LEFT JOIN life ON a.customer_id = life.customer_id
LEFT JOIN (SELECT customer_id, count(*) AS total_interactions FROM interactions GROUP BY customer_id) i ON i.customer_id = a.customer_id)""",
    t=ENGAGEMENT_CTES["t"], life=ENGAGEMENT_CTES["life"]))
def behavior_ratios(spark, sf):
    block = X.with_lifetime(V.transactions(spark, sf).groupBy("customer_id").agg(*X.transaction_basics()), AS_OF)
    contacts = V.interactions(spark, sf).groupBy("customer_id").agg(F.count("*").alias("total_interactions"))
    base = X.join_features(X.join_features(C.account_age(V.customers(spark, sf), AS_OF), block), contacts)
    out = X.activity_status(X.behavior_ratios(base))
    return rounded(out.select("customer_id", "monthly_transaction_rate", "avg_basket_size", "interaction_to_transaction_ratio", "activity_status"))


HEALTH = "resolution_rate * 0.2 + (1 - support_intensity) * 0.3 + email_open_rate * 0.2 + fully_verified * 0.3 AS health_score"


@query("health_score", oracle("customers interactions marketing", f"""
SELECT customer_id, {r4("health_score", "health_score")} FROM (SELECT c.customer_id, {HEALTH} FROM
(SELECT *, CAST(email_verified AND phone_verified AS INT) AS fully_verified FROM customers) c
LEFT JOIN (SELECT customer_id, {RESOLUTION}, {SUPPORT} FROM interactions GROUP BY customer_id) i ON i.customer_id = c.customer_id
LEFT JOIN (SELECT customer_id, avg(opened) AS email_open_rate FROM clean_marketing GROUP BY customer_id) m ON m.customer_id = c.customer_id)""",
    **CLEAN_MARKETING))
def health_score(spark, sf):
    base = C.verification_flags(V.customers(spark, sf))
    contacts = X.interaction_features(V.interactions(spark, sf), EVENTS_AS_OF)
    campaigns = X.marketing_features(C.clean_marketing(V.marketing(spark, sf)))
    return rounded(S.health_score(X.join_features(X.join_features(base, contacts), campaigns)).select("customer_id", "health_score"))


@query("fill_feature_nulls", oracle("customers transactions", f"""
SELECT c.customer_id, registration_date, coalesce(gender, 'Unknown') AS gender, coalesce(account_status, 'Unknown') AS account_status,
  email_verified, round(coalesce(age, 0) + {NUDGE}, 4) AS age, coalesce(total_transactions, 0) AS total_transactions,
  round(CASE WHEN purchase_frequency IS NULL OR isinf(purchase_frequency) THEN 0 ELSE purchase_frequency END + {NUDGE}, 4) AS purchase_frequency
FROM customers c LEFT JOIN life ON life.customer_id = c.customer_id""", t=ENGAGEMENT_CTES["t"], life=ENGAGEMENT_CTES["life"]))
def fill_feature_nulls(spark, sf):
    block = X.with_lifetime(V.transactions(spark, sf).groupBy("customer_id").agg(*X.transaction_basics()), AS_OF)
    joined = X.join_features(V.customers(spark, sf), block).select(
        "customer_id", "registration_date", "gender", "account_status", "email_verified", "age", "total_transactions", "purchase_frequency"
    )
    return rounded(X.fill_feature_nulls(joined))


@query("churn_label", oracle("transactions", f"""
SELECT customer_id, max(transaction_date) AS last_activity,
  CAST(max(transaction_date) < TIMESTAMP '{AS_OF}' - INTERVAL 90 DAY AS INT) AS churned FROM transactions GROUP BY customer_id"""))
def churn_label(spark, sf):
    return X.churn_label(V.transactions(spark, sf), AS_OF)


# ---------------------------------------------------------------- master table

TXN_BLOCK_DOUBLES = DOUBLES + [f"total_amount_sum_last_{d}d" for d in K.TRANSACTION_WINDOWS] + [
    "total_discount_received", "avg_discount_rate", "max_discount_received", "discount_usage_rate", "weekend_transaction_rate",
    "purchase_frequency", "avg_days_between_purchases",
]
MASTER_CTES = CLEAN_CUSTOMERS | CLEAN_LINES | CLEAN_INTERACTIONS | CLEAN_MARKETING | {
    "txn0": f"""SELECT customer_id, {BASIC}, {WINDOWS}, {counts_sql("transaction_id", "product_category", CATEGORIES, "purchases")},
  {counts_sql("transaction_id", "payment_method", PAYMENTS, "payments")},
  {counts_sql("transaction_id", "channel", ["Mobile App", "Unknown", "Web"], "channel")}, {DISCOUNTS}, {WEEKEND}
FROM clean_lines GROUP BY customer_id""",
    "txn": f"SELECT l.*, favorite_category FROM ({LIFETIME.format(block='txn0')}) l JOIN ({favorite_sql('clean_lines', 'product_category', 'favorite_category')}) f ON l.customer_id = f.customer_id",
    **{k: v.replace("sum(total_amount) AS monetary", "coalesce(sum(total_amount), 0) AS monetary") for k, v in rfm_ctes("clean_lines").items()},
    "inter": f"""SELECT b.*, preferred_interaction_channel FROM (SELECT customer_id, {INT_BASIC}, {int_windows_sql(EVENTS_AS_OF)},
  {counts_sql("interaction_id", "interaction_type", INTERACTION_TYPES, "interactions")},
  {counts_sql("interaction_id", "channel", INTERACTION_CHANNELS, "interaction_channel")}, {RESOLUTION}, {SUPPORT}
  FROM clean_interactions GROUP BY customer_id) b
JOIN ({favorite_sql('clean_interactions', 'channel', 'preferred_interaction_channel')}) f ON b.customer_id = f.customer_id""",
    "camp": f"""SELECT *, {MKT_SCORE} FROM (SELECT customer_id, {MKT_BASIC}, {counts_sql("campaign_id", "campaign_type", CAMPAIGN_TYPES, "campaigns")}
FROM clean_marketing GROUP BY customer_id)""",
    "joined": f"""SELECT *, {TIME}, {RATIOS}, {ACTIVITY}, {HEALTH}
FROM clean_customers LEFT JOIN txn USING (customer_id) LEFT JOIN rfm USING (customer_id) LEFT JOIN inter USING (customer_id)
LEFT JOIN camp USING (customer_id)""",
    "value_edges": "SELECT quantile_cont(total_spent, 0.25) AS v1, quantile_cont(total_spent, 0.5) AS v2, quantile_cont(total_spent, 0.75) AS v3 FROM joined",
    "scored": f"""SELECT * EXCLUDE (v1, v2, v3), {quartile_case("total_spent", "v1", "v2", "v3", K.VALUE_LABELS)} AS value_segment,
  ({pct_rank("purchase_frequency")}) * 0.3 + ({pct_rank("total_spent")}) * 0.3 + (1 - ({pct_rank("days_since_last_transaction")})) * 0.2
  + avg_satisfaction / 5 * 0.2 AS engagement_score FROM {{table}}, value_edges""".format(table="joined"),
    "score_edges": "SELECT quantile_cont(engagement_score, 0.25) AS e1, quantile_cont(engagement_score, 0.5) AS e2, quantile_cont(engagement_score, 0.75) AS e3 FROM scored",
    "leveled": f"SELECT * EXCLUDE (e1, e2, e3), {quartile_case('engagement_score', 'e1', 'e2', 'e3', K.ENGAGEMENT_LABELS)} AS engagement_level FROM scored, score_edges",
}
MASTER_DOUBLES = TXN_BLOCK_DOUBLES + ["monetary"] + INT_DOUBLES + [f"satisfaction_score_last_{d}d" for d in K.INTERACTION_WINDOWS] + [
    "resolution_rate", "support_intensity", *MKT_RATES, "marketing_engagement_score", "account_age_months", "account_age_years",
    "monthly_transaction_rate", "avg_basket_size", "interaction_to_transaction_ratio", "engagement_score", "health_score", "age", "lifetime_value",
]
MASTER_INTS = (
    ["transaction_count", "total_transactions", "customer_lifetime_days", "days_since_last_transaction", "weekend_transactions"]
    + [f"{m}_count_last_{d}d" for m in ("total_amount", "transaction_id") for d in K.TRANSACTION_WINDOWS]
    + [f"purchases_{column_suffix(c)}" for c in CATEGORIES] + [f"payments_{column_suffix(p)}" for p in PAYMENTS]
    + ["channel_mobile_app", "channel_unknown", "channel_web", "recency", "frequency", "r_score", "f_score", "m_score", "total_interactions"]
    + [f"interaction_id_last_{d}d" for d in K.INTERACTION_WINDOWS] + [f"interactions_{column_suffix(t)}" for t in INTERACTION_TYPES]
    + [f"interaction_channel_{column_suffix(c)}" for c in INTERACTION_CHANNELS] + ["total_campaigns_received", "total_emails_opened",
    "total_emails_clicked", "total_conversions"] + [f"campaigns_{column_suffix(c)}" for c in CAMPAIGN_TYPES]
)
MASTER_TEXTS = ["favorite_category", "rfm_score", "rfm_segment", "preferred_interaction_channel", "account_status"]
MASTER_CTES["master"] = (
    "SELECT * REPLACE (" + ", ".join(
        [f'round(CASE WHEN isinf("{c}") THEN 0 ELSE coalesce("{c}", 0) END + {NUDGE}, 4) + 0.0 AS "{c}"' for c in MASTER_DOUBLES]
        + [f'coalesce("{c}", 0) AS "{c}"' for c in MASTER_INTS] + [f"coalesce({c}, 'Unknown') AS {c}" for c in MASTER_TEXTS]
    ) + ") FROM leveled"
)
TARGET_BLEND = "1.0 / (1.0 + exp(-(n - 20.0) / 10.0))"
ONEHOT = {
    "customer_segment": SEGMENTS, "account_status": ["Unknown", "active", "deleted"], "favorite_category": CATEGORIES,
    "state": sorted(f"NATION_{i}" for i in range(25)), "rfm_segment": sorted([*K.RFM_SEGMENTS, "Other"]),
    "preferred_interaction_channel": ["Email", "Live Chat", "Phone", "Unknown"], "registration_season": ["Fall", "Spring", "Summer", "Winter"],
    "gender": ["F", "M", "Unknown"],
}
MASTER_VIEWS = "customers lines interactions marketing"


def clean_inputs(spark, sf):
    return stages.clean_all(
        {"customers": V.customers(spark, sf), "transactions": V.lines(spark, sf),
         "interactions": V.interactions(spark, sf), "marketing": V.marketing(spark, sf)},
        AS_OF, earliest=EARLIEST,
    )


def master(spark, sf, encode: bool = False):
    return stages.master_features(clean_inputs(spark, sf), AS_OF, EVENTS_AS_OF, encode=encode)


def _encoded_sql() -> str:
    """Master columns plus one-hot flags of the short lists and the blended label mean of rfm_score."""
    flags = [f"{c} = '{v}' AS \"{c}_{v}\"" for c, values in ONEHOT.items() for v in values[1:]]
    return f"""
SELECT m.*, {', '.join(flags)}, round(CASE WHEN n <= 1 THEN p ELSE p * (1 - {TARGET_BLEND}) + a * {TARGET_BLEND} END + {NUDGE}, 4) + 0.0 AS rfm_score_target_encoded
FROM master m JOIN (SELECT rfm_score, count(*) AS n, avg(churned) AS a FROM master GROUP BY rfm_score) e ON m.rfm_score = e.rfm_score,
  (SELECT avg(churned) AS p FROM master)"""


@query("master_features", oracle(MASTER_VIEWS, _encoded_sql(), **MASTER_CTES))
def master_features(spark, sf):
    return rounded(master(spark, sf, encode=True))
