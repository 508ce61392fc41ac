"""Scans, sinks and cleaning rules on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import views as V
from bindings.registry import query
from bindings.views import oracle
from custoria.operators import cleaning as C
from custoria.session import workspace
from custoria.sources import scans, sinks

AS_OF = V.ORDERS_AS_OF
LOW, HIGH = V.ORDER_RANGE
EARLIEST = "1997-01-01"
EVENT_RANGE = ("2024-01-05", "2024-01-20")

SCAN_CUSTOMER_COLUMNS = (
    "customer_id, registration_date, age, gender, state, customer_segment, lifetime_value, email_verified, "
    "phone_verified, account_status, churned, created_at, updated_at"
)


@query("scan_customers", oracle("customers", f"""
SELECT {SCAN_CUSTOMER_COLUMNS} FROM customers
WHERE registration_date BETWEEN TIMESTAMP '1995-03-01' AND TIMESTAMP '{HIGH}' AND account_status NOT IN ('test', 'deleted')"""))
def scan_customers(spark, sf):
    return scans.scan_customers(V.customers(spark, sf), ("1995-03-01", HIGH))


@query("scan_transactions", oracle("raw_lines products", f"""
SELECT transaction_id, customer_id, transaction_date, r.product_id, product_name, product_category, product_subcategory,
  quantity, total_amount, discount_amount, tax_amount, payment_method, transaction_status, channel
FROM raw_lines r LEFT JOIN products p ON r.product_id = p.product_id
WHERE transaction_date BETWEEN TIMESTAMP '1999-08-03' AND TIMESTAMP '{AS_OF}' AND transaction_status = 'completed'"""))
def scan_transactions(spark, sf):
    return scans.scan_transactions(V.raw_lines(spark, sf), V.products(spark, sf), as_of=AS_OF)


@query("scan_interactions", oracle("interactions", f"""
SELECT * FROM interactions
WHERE interaction_date BETWEEN TIMESTAMP '{EVENT_RANGE[0]}' AND TIMESTAMP '{EVENT_RANGE[1]}'"""))
def scan_interactions(spark, sf):
    return scans.scan_interactions(V.interactions(spark, sf), EVENT_RANGE)


@query("scan_marketing", oracle("marketing", f"""
SELECT * FROM marketing
WHERE campaign_date BETWEEN TIMESTAMP '{EVENT_RANGE[0]}' AND TIMESTAMP '{EVENT_RANGE[1]}' AND sent"""))
def scan_marketing(spark, sf):
    return scans.scan_marketing(V.marketing(spark, sf), EVENT_RANGE)


@query("sql_query", oracle("transactions", f"""
SELECT transaction_status, count(*) AS n, round(sum(total_amount), 2) AS revenue FROM transactions
WHERE transaction_date >= TIMESTAMP '{LOW}' AND total_amount > 1000 GROUP BY transaction_status"""))
def sql_query(spark, sf):
    return scans.sql_query(
        spark,
        """SELECT transaction_status, count(*) AS n, round(sum(total_amount), 2) AS revenue FROM transactions
           WHERE transaction_date >= cast(:start AS timestamp_ntz) AND total_amount > :floor GROUP BY transaction_status""",
        {"start": LOW, "floor": 1000},
        transactions=V.transactions(spark, sf),
    )


@query("parquet_sink", oracle("interactions", "SELECT * FROM interactions"))
def parquet_sink(spark, sf):
    return sinks.write_parquet(V.interactions(spark, sf), workspace(spark))


@query("csv_sink", oracle("customers", """
SELECT customer_segment, count(*) AS n, round(avg(lifetime_value), 4) AS mean_value FROM customers GROUP BY customer_segment"""))
def csv_sink(spark, sf):
    table = V.customers(spark, sf).groupBy("customer_segment").agg(
        F.count("*").alias("n"), F.round(F.avg("lifetime_value"), 4).alias("mean_value")
    )
    return sinks.write_csv(table, workspace(spark))


@query("json_report_sink", oracle("customers", """
SELECT state, count(*) AS n, round(sum(lifetime_value), 4) AS total_value FROM customers GROUP BY state"""))
def json_report_sink(spark, sf):
    table = V.customers(spark, sf).groupBy("state").agg(
        F.count("*").alias("n"), F.round(F.sum("lifetime_value"), 4).alias("total_value")
    )
    return sinks.write_json(table, workspace(spark))


@query("table_sink", oracle("transactions", """
SELECT transaction_id, total_amount FROM transactions UNION ALL SELECT transaction_id, total_amount FROM transactions"""))
def table_sink(spark, sf):
    """Replace, then append: every row is there twice."""
    rows = V.transactions(spark, sf).select("transaction_id", "total_amount")
    path = workspace(spark)
    name = "sink_" + path.rsplit("/", 1)[-1]
    sinks.write_table(rows, name, "replace", path)
    return sinks.write_table(rows, name, "append", path)


@query("stage_materialize", oracle("transactions", "SELECT * FROM transactions"))
def stage_materialize(spark, sf):
    root = workspace(spark)
    sinks.save_stage({"transactions": V.transactions(spark, sf)}, root, "collected")
    return sinks.load_stage(spark, root, "collected", ["transactions"])["transactions"]


# ---------------------------------------------------------------- cleaning rules


@query("filter_valid_amounts", oracle("lines", """
SELECT transaction_id, customer_id, transaction_date, total_amount FROM lines
WHERE total_amount > 0 AND transaction_status = 'completed' AND customer_id IS NOT NULL AND transaction_date IS NOT NULL"""))
def filter_valid_amounts(spark, sf):
    return C.filter_valid_amounts(V.lines(spark, sf)).select("transaction_id", "customer_id", "transaction_date", "total_amount")


@query("default_satisfaction", oracle("interactions", """
SELECT interaction_id, coalesce(satisfaction_score, 3) AS satisfaction_score FROM interactions
WHERE customer_id IS NOT NULL AND interaction_date IS NOT NULL"""))
def default_satisfaction(spark, sf):
    return C.default_satisfaction(V.interactions(spark, sf)).select("interaction_id", "satisfaction_score")


@query("fix_types", """
SELECT event_id, TRY_CAST(event_type AS DOUBLE) AS event_type, TRY_CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
  strftime(ts, '%Y-%m-%d %H:%M:%S')::TIMESTAMP AS ts, TRY_CAST(props AS TIMESTAMP) AS props FROM events""")
def fix_types(spark, sf):
    raw = V.read(spark, sf, "events").select(
        "event_id", "event_type", F.get_json_object("props", "$.k").alias("k"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "props",
    )
    return C.fix_types(raw, {"event_type": "double", "k": "bigint", "ts": "timestamp_ntz", "props": "timestamp_ntz"})


@query("dedup_by_key", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey,
  l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM
  (SELECT * REPLACE (l_discount + 0.0 AS l_discount, l_tax + 0.0 AS l_tax) FROM lineitem)) WHERE rn = 1""")
def dedup_by_key(spark, sf):
    lines = V.read(spark, sf, "lineitem").withColumns({c: F.col(c) + 0.0 for c in ("l_discount", "l_tax")})
    return C.dedup_by_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("dedup_rows", "SELECT DISTINCT text, lang FROM documents")
def dedup_rows(spark, sf):
    return C.dedup_rows(V.read(spark, sf, "documents").select("text", "lang"))


@query("filter_date_window", oracle("transactions", f"""
SELECT * FROM transactions WHERE transaction_date BETWEEN TIMESTAMP '{EARLIEST}' AND TIMESTAMP '{AS_OF}'"""))
def filter_date_window(spark, sf):
    return C.filter_date_window(V.transactions(spark, sf), "transaction_date", AS_OF, EARLIEST)


@query("filter_status_list", oracle("transactions", """
SELECT * FROM transactions WHERE transaction_status IN ('completed', 'pending')"""))
def filter_status_list(spark, sf):
    return C.filter_status_list(V.transactions(spark, sf), accepted=["completed", "pending"])


@query("drop_critical_nulls", oracle("customers", """
SELECT customer_id, registration_date, state FROM customers WHERE customer_id IS NOT NULL AND registration_date IS NOT NULL"""))
def drop_critical_nulls(spark, sf):
    return C.drop_critical_nulls(V.customers(spark, sf)).select("customer_id", "registration_date", "state")


@query("filter_age_range", oracle("customers", """
SELECT customer_id, age FROM customers WHERE age IS NULL OR age BETWEEN 18 AND 100"""))
def filter_age_range(spark, sf):
    return C.filter_age_range(V.customers(spark, sf)).select("customer_id", "age")


@query("filter_future_dates", oracle("customers", """
SELECT customer_id, registration_date FROM customers
WHERE registration_date IS NULL OR registration_date <= TIMESTAMP '1996-01-01'"""))
def filter_future_dates(spark, sf):
    return C.filter_future_dates(V.customers(spark, sf), "1996-01-01").select("customer_id", "registration_date")


@query("clip_binary", oracle("labelled_documents", """
SELECT doc_id, greatest(0, least(1, coalesce(quality * 3 - 1, 0))) AS quality FROM labelled_documents"""))
def clip_binary(spark, sf):
    docs = V.labelled_documents(spark, sf).select("doc_id", (F.col("quality") * 3 - 1).alias("quality"))
    return C.clip_binary(docs, "quality")


@query("fill_constants", oracle("customers lines", """
SELECT customer_id AS id, coalesce(gender, 'Unknown') AS text, coalesce(email_verified, FALSE) AS flag FROM customers
UNION ALL SELECT transaction_id, coalesce(channel, 'Unknown'), NULL FROM lines"""))
def fill_constants(spark, sf):
    people = C.fill_customer_constants(V.customers(spark, sf))
    sales = C.fill_constants(V.lines(spark, sf), {"channel": "Unknown", "device_type": "Unknown", "discount_amount": 0.0})
    return people.select(F.col("customer_id").alias("id"), F.col("gender").alias("text"), F.col("email_verified").alias("flag")).union(
        sales.select("transaction_id", "channel", F.lit(None).cast("boolean"))
    )


@query("impute_group_median", oracle("customers interactions", """
SELECT 'age' AS column_name, customer_id AS id, coalesce(age, median(age) OVER (PARTITION BY customer_segment)) AS value FROM customers
UNION ALL SELECT 'satisfaction_score', interaction_id,
  coalesce(satisfaction_score, median(satisfaction_score) OVER (PARTITION BY interaction_type)) FROM interactions"""))
def impute_group_median(spark, sf):
    ages = C.impute_group_median(V.customers(spark, sf), "age", "customer_segment")
    scores = C.impute_group_median(V.interactions(spark, sf), "satisfaction_score", "interaction_type")
    return ages.select(F.lit("age").alias("column_name"), F.col("customer_id").alias("id"), F.col("age").alias("value")).union(
        scores.select(F.lit("satisfaction_score"), "interaction_id", "satisfaction_score")
    )


@query("impute_global", oracle("interactions", """
SELECT interaction_id, coalesce(satisfaction_score, (SELECT median(satisfaction_score) FROM interactions)) AS satisfaction_score,
  coalesce(channel, (SELECT channel FROM interactions WHERE channel IS NOT NULL GROUP BY channel ORDER BY count(*) DESC, channel LIMIT 1)) AS channel,
  coalesce(resolution_status, (SELECT resolution_status FROM interactions WHERE resolution_status IS NOT NULL
    GROUP BY resolution_status ORDER BY count(*) DESC, resolution_status LIMIT 1)) AS resolution_status
FROM interactions"""))
def impute_global(spark, sf):
    return C.impute_global(V.interactions(spark, sf).select("interaction_id", "satisfaction_score", "channel", "resolution_status"))


@query("clip_range", oracle("interactions", """
SELECT interaction_id, CASE WHEN satisfaction_score IS NOT NULL THEN greatest(1.0::DOUBLE, least(5.0::DOUBLE, satisfaction_score)) END AS satisfaction_score
FROM interactions"""))
def clip_range(spark, sf):
    return C.clip_range(V.interactions(spark, sf), "satisfaction_score", 1.0, 5.0).select("interaction_id", "satisfaction_score")


@query("cap_upper", oracle("interactions", """
SELECT interaction_id, round(CASE WHEN duration_seconds > 7200 THEN 7200.0::DOUBLE ELSE duration_seconds END, 6) AS duration_seconds FROM interactions"""))
def cap_upper(spark, sf):
    return C.cap_upper(V.interactions(spark, sf), "duration_seconds", 7200).select(
        "interaction_id", F.round("duration_seconds", 6).alias("duration_seconds")
    )


@query("cap_outliers_iqr", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, round(greatest(q1 - 3.0 * (q3 - q1), least(q3 + 3.0 * (q3 - q1), value)), 6) AS value FROM events, q""")
def cap_outliers_iqr(spark, sf):
    events = V.read(spark, sf, "events").select("event_id", "value")
    return C.cap_outliers_iqr(events, "value", 3.0).withColumn("value", F.round("value", 6))


_CONSISTENT = """
SELECT campaign_id, customer_id, campaign_date, campaign_type, sent, cost, opened,
  CASE WHEN opened = 0 THEN 0 ELSE clicked END AS clicked,
  CASE WHEN opened = 0 OR clicked = 0 THEN 0 ELSE converted END AS converted
FROM (SELECT * REPLACE (coalesce(opened, 0) AS opened, coalesce(clicked, 0) AS clicked, coalesce(converted, 0) AS converted) FROM marketing)"""


@query("enforce_consistency", oracle("marketing", _CONSISTENT))
def enforce_consistency(spark, sf):
    return C.enforce_consistency(V.marketing(spark, sf))


@query("standardize_categories", oracle("customers", """
SELECT customer_id, CASE gender WHEN 'm' THEN 'M' WHEN 'f' THEN 'F' ELSE 'Unknown' END AS gender,
  upper(customer_segment[1]) || lower(customer_segment[2:]) AS customer_segment, upper(state) AS state FROM customers"""))
def standardize_categories(spark, sf):
    return C.standardize_categories(V.customers(spark, sf)).select("customer_id", "gender", "customer_segment", "state")


_AGE_GROUP = """CASE WHEN age <= 0 THEN NULL WHEN age <= 25 THEN '18-25' WHEN age <= 35 THEN '26-35' WHEN age <= 45 THEN '36-45'
  WHEN age <= 55 THEN '46-55' WHEN age <= 65 THEN '56-65' WHEN age <= 100 THEN '65+' END"""


@query("bin_fixed", oracle("customers", f"SELECT customer_id, age, {_AGE_GROUP} AS age_group FROM customers"))
def bin_fixed(spark, sf):
    return C.age_group(V.customers(spark, sf)).select("customer_id", "age", "age_group")


_DATE_PARTS = """CAST(year(transaction_date) AS INT) AS transaction_year, CAST(month(transaction_date) AS INT) AS transaction_month,
  CAST(day(transaction_date) AS INT) AS transaction_day, CAST(hour(transaction_date) AS INT) AS transaction_hour,
  CAST(isodow(transaction_date) - 1 AS INT) AS transaction_weekday, CAST(isodow(transaction_date) IN (6, 7) AS INT) AS is_weekend"""


@query("date_parts", oracle("transactions", f"SELECT transaction_id, {_DATE_PARTS} FROM transactions"))
def date_parts(spark, sf):
    parts = C.date_parts(V.transactions(spark, sf))
    return parts.select("transaction_id", *[f"transaction_{p}" for p in ("year", "month", "day", "hour", "weekday")], "is_weekend")


_HOURS = "CAST(hour(interaction_date) AS INT) AS interaction_hour, CAST(hour(interaction_date) BETWEEN 9 AND 17 AS INT) AS is_business_hours"


@query("business_hours", oracle("interactions", f"SELECT interaction_id, {_HOURS} FROM interactions"))
def business_hours(spark, sf):
    return C.business_hours(V.interactions(spark, sf)).select("interaction_id", "interaction_hour", "is_business_hours")


_ACCOUNT_DAYS = f"date_sub('day', registration_date, TIMESTAMP '{AS_OF}')"


@query("account_age", oracle("customers", f"""
SELECT customer_id, {_ACCOUNT_DAYS} AS account_age_days, round({_ACCOUNT_DAYS} / 30.44, 6) AS account_age_months FROM customers"""))
def account_age(spark, sf):
    aged = C.account_age(V.customers(spark, sf), AS_OF)
    return aged.select("customer_id", "account_age_days", F.round("account_age_months", 6).alias("account_age_months"))


@query("verification_flags", oracle("customers", """
SELECT customer_id, CAST(email_verified AND phone_verified AS INT) AS fully_verified,
  CAST(email_verified AS INT) + CAST(phone_verified AS INT) AS verification_level FROM customers"""))
def verification_flags(spark, sf):
    return C.verification_flags(V.customers(spark, sf)).select("customer_id", "fully_verified", "verification_level")


# ---------------------------------------------------------------- whole datasets

# customers -> imputed -> valid -> clean
CLEAN_CUSTOMERS = {
    "imputed_customers": """
SELECT * REPLACE (coalesce(age, median(age) OVER (PARTITION BY customer_segment)) AS age,
  coalesce(email_verified, FALSE) AS email_verified) FROM customers WHERE registration_date IS NOT NULL""",
    "valid_customers": f"""
SELECT * FROM imputed_customers WHERE (age IS NULL OR age BETWEEN 18 AND 100) AND registration_date <= TIMESTAMP '{AS_OF}'""",
    "age_bounds": """
SELECT q1 - 2 * (q3 - q1) AS lo, q3 + 2 * (q3 - q1) AS hi
FROM (SELECT quantile_cont(age, 0.25) AS q1, quantile_cont(age, 0.75) AS q3 FROM valid_customers)""",
    "capped_customers": "SELECT * REPLACE (greatest(lo, least(hi, age)) AS age) FROM valid_customers, age_bounds",
    "clean_customers": f"""
SELECT customer_id, registration_date, age, CASE gender WHEN 'm' THEN 'M' WHEN 'f' THEN 'F' ELSE 'Unknown' END AS gender,
  upper(state) AS state, upper(customer_segment[1]) || lower(customer_segment[2:]) AS customer_segment, lifetime_value,
  email_verified, phone_verified, account_status, churned, created_at, updated_at, {_ACCOUNT_DAYS} AS account_age_days,
  {_ACCOUNT_DAYS} / 30.44 AS account_age_months, {_AGE_GROUP} AS age_group,
  CAST(email_verified AND phone_verified AS INT) AS fully_verified,
  CAST(email_verified AS INT) + CAST(phone_verified AS INT) AS verification_level FROM capped_customers""",
}


@query("clean_customers", oracle("customers", """
SELECT * REPLACE (round(account_age_months, 6) AS account_age_months) FROM clean_customers""", **CLEAN_CUSTOMERS))
def clean_customers(spark, sf):
    cleaned = C.clean_customers(V.customers(spark, sf), AS_OF)
    return cleaned.withColumn("account_age_months", F.round("account_age_months", 6))


# lines -> unique -> valid -> clean; the key repeats, the first row over all other columns stays
CLEAN_LINES = {
    "unique_lines": """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY product_id, customer_id,
  transaction_date, quantity, total_amount, discount_amount, tax_amount, payment_method, transaction_status,
  channel NULLS FIRST, product_name, product_category, product_subcategory) AS rn FROM lines) WHERE rn = 1""",
    "valid_lines": f"""
SELECT * REPLACE (coalesce(channel, 'Unknown') AS channel) FROM unique_lines
WHERE total_amount > 0 AND transaction_date BETWEEN TIMESTAMP '{EARLIEST}' AND TIMESTAMP '{AS_OF}'
  AND transaction_status IN ('completed', 'pending', 'processing')""",
    "amount_bounds": """
SELECT q1 - 3 * (q3 - q1) AS lo, q3 + 3 * (q3 - q1) AS hi
FROM (SELECT quantile_cont(total_amount, 0.25) AS q1, quantile_cont(total_amount, 0.75) AS q3 FROM valid_lines)""",
    "clean_lines": f"""
SELECT * EXCLUDE (lo, hi) REPLACE (greatest(lo, least(hi, total_amount)) AS total_amount), {_DATE_PARTS}
FROM valid_lines, amount_bounds""",
}


@query("clean_transactions", oracle("lines", """
SELECT * REPLACE (round(total_amount, 4) AS total_amount, round(discount_amount, 4) AS discount_amount, round(tax_amount, 4) AS tax_amount)
FROM clean_lines""", **CLEAN_LINES))
def clean_transactions(spark, sf):
    cleaned = C.clean_transactions(V.lines(spark, sf), AS_OF, earliest=EARLIEST)
    return cleaned.withColumns({c: F.round(c, 4) for c in ("total_amount", "discount_amount", "tax_amount")})


CLEAN_INTERACTIONS = {
    "clean_interactions": f"""
SELECT * REPLACE (greatest(1.0::DOUBLE, least(5.0::DOUBLE, coalesce(satisfaction_score,
    median(satisfaction_score) OVER (PARTITION BY interaction_type)))) AS satisfaction_score,
  least(duration_seconds, 7200.0::DOUBLE) AS duration_seconds), {_HOURS} FROM interactions""",
}


@query("clean_interactions", oracle("interactions", """
SELECT * REPLACE (round(duration_seconds, 6) AS duration_seconds) FROM clean_interactions""", **CLEAN_INTERACTIONS))
def clean_interactions(spark, sf):
    return C.clean_interactions(V.interactions(spark, sf)).withColumn("duration_seconds", F.round("duration_seconds", 6))


CLEAN_MARKETING = {"clean_marketing": _CONSISTENT}


@query("clean_marketing", oracle("marketing", "SELECT * FROM clean_marketing", **CLEAN_MARKETING))
def clean_marketing(spark, sf):
    return C.clean_marketing(V.marketing(spark, sf))


@query("clean_generic", oracle("labelled_documents", """
SELECT lang, source, n_chars, coalesce(quality, (SELECT median(quality) FROM d)) AS quality,
  coalesce(toxic, (SELECT median(toxic) FROM d)) AS toxic FROM d""", d="""
SELECT DISTINCT lang, source, n_chars, quality, toxic FROM labelled_documents"""))
def clean_generic(spark, sf):
    docs = C.clean_generic(V.labelled_documents(spark, sf).drop("doc_id"))
    return docs.withColumns({c: F.col(c).cast("double") for c in ("quality", "toxic")})


@query("join_left_dim", """
SELECT l_orderkey, l_linenumber, l_partkey, p_type, p_brand FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""")
def join_left_dim(spark, sf):
    part = V.read(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand")
    lines = V.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return scans.join_dimension(lines, part, "l_partkey")


@query("join_left_dim_all", "SELECT l_orderkey, l_linenumber, l_partkey, p_type, p_brand FROM lineitem LEFT JOIN part ON l_partkey = p_partkey")
def join_left_dim_all(spark, sf):
    """The same; the name stays for those who know it."""
    return join_left_dim(spark, sf)


_REPORT_SQL = f"""
SELECT 'customers' AS dataset, 'records_before' AS metric, NULL AS "column", (SELECT count(*) FROM customers) AS value
UNION ALL SELECT 'customers', 'records_after', NULL, (SELECT count(*) FROM valid_customers)
UNION ALL SELECT 'customers', 'duplicates_removed', NULL, (SELECT count(*) - count(DISTINCT customer_id) FROM customers)
UNION ALL SELECT 'customers', 'missing_handled', 'registration_date', (SELECT count(*) FROM customers WHERE registration_date IS NULL)
UNION ALL SELECT 'customers', 'missing_handled', 'age', (SELECT count(*) FROM customers WHERE registration_date IS NOT NULL AND age IS NULL)
UNION ALL SELECT 'customers', 'missing_handled', 'email_verified', (SELECT count(*) FROM customers WHERE registration_date IS NOT NULL AND email_verified IS NULL)
UNION ALL SELECT 'customers', 'outliers_capped', 'age', (SELECT count(*) FROM valid_customers, age_bounds WHERE age NOT BETWEEN lo AND hi)
UNION ALL SELECT 'customers', 'rule_violations', 'age', (SELECT count(*) FROM imputed_customers WHERE age NOT BETWEEN 18 AND 100)
UNION ALL SELECT 'customers', 'types_fixed', unnest(['customer_id', 'age', 'registration_date', 'churned']), 1
UNION ALL SELECT 'transactions', 'records_before', NULL, (SELECT count(*) FROM lines)
UNION ALL SELECT 'transactions', 'records_after', NULL, (SELECT count(*) FROM valid_lines)
UNION ALL SELECT 'transactions', 'duplicates_removed', NULL, (SELECT count(*) - count(DISTINCT transaction_id) FROM lines)
UNION ALL SELECT 'transactions', 'missing_handled', 'channel', (SELECT count(*) FROM valid_lines WHERE channel = 'Unknown')
UNION ALL SELECT 'transactions', 'outliers_capped', 'total_amount', (SELECT count(*) FROM valid_lines, amount_bounds WHERE total_amount NOT BETWEEN lo AND hi)
UNION ALL SELECT 'transactions', 'types_fixed', unnest(['customer_id', 'transaction_id', 'total_amount', 'discount_amount', 'transaction_date']), 1
UNION ALL SELECT 'interactions', 'records_before', NULL, (SELECT count(*) FROM interactions)
UNION ALL SELECT 'interactions', 'records_after', NULL, (SELECT count(DISTINCT interaction_id) FROM interactions)
UNION ALL SELECT 'interactions', 'duplicates_removed', NULL, (SELECT count(*) - count(DISTINCT interaction_id) FROM interactions)
UNION ALL SELECT 'interactions', 'missing_handled', 'satisfaction_score', (SELECT count(*) FROM interactions WHERE satisfaction_score IS NULL)
UNION ALL SELECT 'interactions', 'outliers_capped', 'duration_seconds', (SELECT count(*) FROM interactions WHERE duration_seconds > 7200)
UNION ALL SELECT 'interactions', 'types_fixed', unnest(['customer_id', 'interaction_id', 'duration_seconds', 'satisfaction_score', 'interaction_date']), 1
UNION ALL SELECT 'marketing', 'records_before', NULL, (SELECT count(*) FROM marketing)
UNION ALL SELECT 'marketing', 'records_after', NULL, (SELECT count(DISTINCT (campaign_id, customer_id)) FROM marketing)
UNION ALL SELECT 'marketing', 'duplicates_removed', NULL, (SELECT count(*) - count(DISTINCT (campaign_id, customer_id)) FROM marketing)
"""


@query("cleaning_report", oracle("customers lines interactions marketing", f"""
SELECT * FROM ({_REPORT_SQL}) WHERE value > 0 OR metric IN ('records_before', 'records_after', 'duplicates_removed')""",
    **{k: v for c in (CLEAN_CUSTOMERS, CLEAN_LINES) for k, v in c.items()}))
def cleaning_report(spark, sf):
    datasets = {
        "customers": V.customers(spark, sf), "transactions": V.lines(spark, sf),
        "interactions": V.interactions(spark, sf), "marketing": V.marketing(spark, sf),
    }
    return C.cleaning_report(datasets, AS_OF, EARLIEST)
