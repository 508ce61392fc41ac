"""Test tables bound to the customer data model, once for Spark and once as SQL.

orders -> transactions, lineitem + part -> transaction lines, events -> interactions and
marketing, customer + nation + orders -> customers. The SQL texts are the oracle's own
statement of the same binding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDERS_AS_OF = "2001-08-02"
EVENTS_AS_OF = "2024-01-31"
ORDER_RANGE = ("1999-08-03", "2001-08-02")


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def customers(spark: SparkSession, sf: str) -> DataFrame:
    c, n = read(spark, sf, "customer"), read(spark, sf, "nation")
    activity = (
        read(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min("o_orderdate").alias("registration_date"), F.max("o_orderdate").alias("updated_at"))
    )
    balance = F.col("c_acctbal")
    late = F.lit(ORDERS_AS_OF).cast("timestamp_ntz") - F.expr("INTERVAL 90 DAYS")
    return (
        c.join(n, c.c_nationkey == n.n_nationkey, "left")
        .join(activity, "c_custkey", "left")
        .select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            "registration_date",
            F.when(balance >= 0, F.floor(balance / 100).cast("double")).alias("age"),
            F.lower(F.substring("c_mktsegment", 1, 1)).alias("gender"),
            F.lower("n_name").alias("state"),
            F.col("c_mktsegment").alias("customer_segment"),
            balance.alias("lifetime_value"),
            F.when(balance >= -500, balance >= 2000).alias("email_verified"),
            (balance >= 5000).alias("phone_verified"),
            F.when(balance < -900, "deleted").when(balance >= -800, "active").alias("account_status"),
            F.when(F.col("updated_at") < late, 1).otherwise(0).alias("churned"),
            F.col("registration_date").alias("created_at"),
            "updated_at",
        )
    )


CUSTOMERS = """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, registration_date,
  CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal / 100) END AS age,
  lower(substr(c_mktsegment, 1, 1)) AS gender, lower(n_name) AS state, c_mktsegment AS customer_segment,
  c_acctbal AS lifetime_value,
  CASE WHEN c_acctbal >= -500 THEN c_acctbal >= 2000 END AS email_verified, c_acctbal >= 5000 AS phone_verified,
  CASE WHEN c_acctbal < -900 THEN 'deleted' WHEN c_acctbal >= -800 THEN 'active' END AS account_status,
  CASE WHEN updated_at < TIMESTAMP '2001-05-04' THEN 1 ELSE 0 END AS churned,
  registration_date AS created_at, updated_at
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS registration_date, max(o_orderdate) AS updated_at
           FROM orders GROUP BY o_custkey) a ON o_custkey = c_custkey
"""


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderdate").alias("transaction_date"),
        F.col("o_totalprice").alias("total_amount"),
        _status().alias("transaction_status"),
        F.col("o_orderpriority").alias("payment_method"),
    )


def _status():
    status = F.col("o_orderstatus")
    return F.when(status == "F", "completed").when(status == "P", "pending").when(status == "O", "processing")


_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'pending' WHEN 'O' THEN 'processing' END"

TRANSACTIONS = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, CAST(o_custkey AS VARCHAR) AS customer_id,
  o_orderdate AS transaction_date, o_totalprice AS total_amount, {_STATUS} AS transaction_status,
  o_orderpriority AS payment_method
FROM orders
"""


def products(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_category"),
        F.col("p_brand").alias("product_subcategory"),
    )


PRODUCTS = """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS product_category, p_brand AS product_subcategory
FROM part
"""


def raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines before the product lookup; (order, line) repeats, so ids do too."""
    lines, orders = read(spark, sf, "lineitem"), read(spark, sf, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderdate").alias("transaction_date"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("total_amount"),
        (F.col("l_extendedprice") * F.col("l_discount") + 0.0).alias("discount_amount"),
        (F.col("l_extendedprice") * F.col("l_tax") + 0.0).alias("tax_amount"),
        F.col("o_orderpriority").alias("payment_method"),
        _status().alias("transaction_status"),
        F.when(F.col("l_returnflag") == "A", "Web").when(F.col("l_returnflag") == "N", "Mobile App").alias("channel"),
    )


RAW_LINES = f"""
SELECT l_orderkey || '-' || l_linenumber AS transaction_id, CAST(o_custkey AS VARCHAR) AS customer_id,
  o_orderdate AS transaction_date, l_partkey AS product_id, l_quantity AS quantity, l_extendedprice AS total_amount,
  l_extendedprice * l_discount + 0.0 AS discount_amount, l_extendedprice * l_tax + 0.0 AS tax_amount,
  o_orderpriority AS payment_method, {_STATUS} AS transaction_status,
  CASE l_returnflag WHEN 'A' THEN 'Web' WHEN 'N' THEN 'Mobile App' END AS channel
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return raw_lines(spark, sf).join(products(spark, sf), "product_id", "left")


LINES = "SELECT r.*, product_name, product_category, product_subcategory FROM raw_lines r LEFT JOIN products USING (product_id)"


def interactions(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    return read(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("interaction_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("ts").alias("interaction_date"),
        F.when(kind == "error", "Complaint").when(kind == "signup", "Support").otherwise(F.initcap(kind)).alias("interaction_type"),
        F.when(k % 4 == 0, "Email").when(k % 4 == 1, "Phone").when(k % 4 == 2, "Live Chat").alias("channel"),
        (F.col("value") * 100).alias("duration_seconds"),
        F.when(k % 3 == 0, "Resolved").when(k % 3 == 1, "Pending").alias("resolution_status"),
        F.when(k < 90, k % 7).cast("double").alias("satisfaction_score"),
    )


INTERACTIONS = """
SELECT CAST(event_id AS VARCHAR) AS interaction_id, CAST(user_id AS VARCHAR) AS customer_id, ts AS interaction_date,
  CASE event_type WHEN 'error' THEN 'Complaint' WHEN 'signup' THEN 'Support'
    ELSE upper(event_type[1]) || event_type[2:] END AS interaction_type,
  CASE k % 4 WHEN 0 THEN 'Email' WHEN 1 THEN 'Phone' WHEN 2 THEN 'Live Chat' END AS channel,
  value * 100 AS duration_seconds, CASE k % 3 WHEN 0 THEN 'Resolved' WHEN 1 THEN 'Pending' END AS resolution_status,
  CAST(CASE WHEN k < 90 THEN k % 7 END AS DOUBLE) AS satisfaction_score
FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INT) AS k FROM events)
"""


def marketing(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    return read(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("campaign_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("ts").alias("campaign_date"),
        F.when(k % 3 == 0, "Email").when(k % 3 == 1, "SMS").otherwise("Push").alias("campaign_type"),
        (kind != "error").alias("sent"),
        F.when(kind != "signup", (kind.isin("view", "click", "purchase") & (k % 5 != 0)).cast("int")).alias("opened"),
        kind.isin("click", "purchase").cast("int").alias("clicked"),
        (kind == "purchase").cast("int").alias("converted"),
        F.col("value").alias("cost"),
    )


MARKETING = """
SELECT CAST(event_id AS VARCHAR) AS campaign_id, CAST(user_id AS VARCHAR) AS customer_id, ts AS campaign_date,
  CASE k % 3 WHEN 0 THEN 'Email' WHEN 1 THEN 'SMS' ELSE 'Push' END AS campaign_type, event_type <> 'error' AS sent,
  CASE WHEN event_type <> 'signup' THEN CAST(event_type IN ('view', 'click', 'purchase') AND k % 5 <> 0 AS INT) END AS opened,
  CAST(event_type IN ('click', 'purchase') AS INT) AS clicked, CAST(event_type = 'purchase' AS INT) AS converted,
  value AS cost
FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INT) AS k FROM events)
"""


def labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their labels, which only some have: real missing values."""
    return read(spark, sf, "documents").join(read(spark, sf, "labels"), "doc_id", "left").select(
        "doc_id", "lang", "source", "n_chars", "quality", "toxic"
    )


LABELLED_DOCUMENTS = """
SELECT d.doc_id, lang, source, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings with a 9:1 class label: class 1 is the minority."""
    return read(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.transform("embedding", lambda x: x.cast("double")).alias("features"),
        (F.col("label") == 0).cast("int").alias("label"),
    )


VECTORS = """
SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS features, CAST(label = 0 AS INT) AS label
FROM embeddings
"""

_TEXTS = {
    "customers": CUSTOMERS, "transactions": TRANSACTIONS, "products": PRODUCTS, "raw_lines": RAW_LINES, "lines": LINES,
    "interactions": INTERACTIONS, "marketing": MARKETING, "labelled_documents": LABELLED_DOCUMENTS, "vectors": VECTORS,
}
_NEEDS = {"lines": ["raw_lines", "products"]}


def oracle(names: str, body: str, **ctes: str) -> str:
    """WITH the named bindings and further CTEs, then ``body``."""
    wanted = []
    for name in names.split():
        wanted += [n for n in _NEEDS.get(name, []) if n not in wanted] + ([name] if name not in wanted else [])
    # materialised, so that float sums are computed once and agree wherever they are read
    parts = [f"{n} AS MATERIALIZED ({t.strip()})" for n, t in [(w, _TEXTS[w]) for w in wanted] + list(ctes.items())]
    return (f"WITH {', '.join(parts)} " if parts else "") + body.strip()
