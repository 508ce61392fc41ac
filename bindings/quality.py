"""Validation checks and exploratory reports on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import views as V
from bindings.cleaning import CLEAN_CUSTOMERS, CLEAN_INTERACTIONS, CLEAN_LINES, CLEAN_MARKETING, EARLIEST
from bindings.features import NUDGE, r4, rounded
from bindings.registry import query
from bindings.views import oracle
from custoria.operators import exploration as E
from custoria.operators import features as X
from custoria.operators import validation as Q
from custoria.operators.cleaning import clean_marketing
from custoria.plans.stages import clean_all
from custoria.session import materialize, shuffles_removed

AS_OF = V.ORDERS_AS_OF


def facts(spark, sf):
    """Customers with a few order totals: the frame most reports look at."""
    spent = V.transactions(spark, sf).groupBy("customer_id").agg(
        F.count("*").alias("total_transactions"), F.sum("total_amount").alias("total_spent"),
        F.avg("total_amount").alias("avg_transaction_value"), F.max("total_amount").alias("max_transaction_value"),
        F.min("transaction_date").alias("first_transaction_date"), F.max("transaction_date").alias("last_transaction_date"),
    )
    people = V.customers(spark, sf).select(
        "customer_id", "registration_date", "age", "lifetime_value", "gender", "state", "customer_segment", "account_status", "churned"
    )
    return X.join_features(people, spent)


FACTS = """SELECT c.customer_id, registration_date, age, lifetime_value, gender, state, customer_segment, account_status, churned,
  total_transactions, total_spent, avg_transaction_value, max_transaction_value, first_transaction_date, last_transaction_date
FROM customers c LEFT JOIN (SELECT customer_id, count(*) AS total_transactions, sum(total_amount) AS total_spent,
  avg(total_amount) AS avg_transaction_value, max(total_amount) AS max_transaction_value,
  min(transaction_date) AS first_transaction_date, max(transaction_date) AS last_transaction_date
  FROM transactions GROUP BY customer_id) t ON t.customer_id = c.customer_id"""
FACT_NUMBERS = ["age", "lifetime_value", "churned", "total_transactions", "total_spent", "avg_transaction_value", "max_transaction_value"]
FACT_TEXTS = ["gender", "state", "customer_segment", "account_status"]


def facts_sql(body: str, **ctes: str) -> str:
    return oracle("customers transactions", body, facts=FACTS, **ctes)


def datasets(spark, sf) -> dict:
    return {"customers": facts(spark, sf), "transactions": V.lines(spark, sf), "interactions": V.interactions(spark, sf),
            "events": V.read(spark, sf, "events"), "documents": V.labelled_documents(spark, sf),
            "lineitem": V.read(spark, sf, "lineitem")}


VIEWS = "customers transactions lines interactions labelled_documents"
COLUMNS = {
    "customers": ["customer_id", "registration_date", *["age", "lifetime_value", "gender", "state", "customer_segment", "account_status", "churned",
                  "total_transactions", "total_spent", "avg_transaction_value", "max_transaction_value"], "first_transaction_date", "last_transaction_date"],
    "transactions": ["transaction_id", "customer_id", "transaction_date", "product_id", "quantity", "total_amount", "discount_amount", "tax_amount",
                     "payment_method", "transaction_status", "channel", "product_name", "product_category", "product_subcategory"],
    "interactions": ["interaction_id", "customer_id", "interaction_date", "interaction_type", "channel", "duration_seconds", "resolution_status", "satisfaction_score"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "lang", "source", "n_chars", "quality", "toxic"],
}
TABLES = {"customers": "facts", "transactions": "lines", "interactions": "interactions", "events": "events", "documents": "labelled_documents", "lineitem": "lineitem"}


def checked(check: str, parts: list[str], names: str, **ctes: str):
    """Register one check over the named datasets; every part is a SELECT of the five result columns."""
    union = " UNION ALL ".join(f"({p})" for p in parts)
    sql = f"SELECT dataset, check_name, passed, severity, round(CAST(value AS DOUBLE) + {NUDGE}, 4) AS value FROM ({union})"

    @query(check, oracle(VIEWS, sql, facts=FACTS, **ctes))
    def run(spark, sf):
        chosen = datasets(spark, sf)
        found = Q.validate({n: chosen[n] for n in names.split()}, AS_OF, [check])
        return rounded(found.select("dataset", "check_name", "passed", "severity", "value"))


def row(dataset: str, check: str, passed: str, severity: str, value: str, table: str, where: str = "TRUE") -> str:
    return f"SELECT '{dataset}' AS dataset, '{check}' AS check_name, {passed} AS passed, {severity} AS severity, {value} AS value FROM {table} WHERE {where}"


checked("check_size", [
    row(d, "dataframe_size", "TRUE", "'info'", "n", f"(SELECT count(*) AS n FROM {TABLES[d]})") for d in ("customers", "transactions", "interactions")
], "customers transactions interactions")


@query("check_type_profile", oracle("interactions", " UNION ALL ".join(
    f"SELECT 'mixed_types_{c}' AS check_name, NOT (d > 0 AND d < n) AS passed, CASE WHEN d > 0 AND d < n THEN 'warning' ELSE 'info' END AS severity, "
    f"d AS numbers FROM (SELECT count({c}) AS n, count(TRY_CAST({c} AS DOUBLE)) AS d FROM mixed)" for c in ("kind", "customer_id", "interaction_type")
) + " UNION ALL SELECT 'id_type_doc_id', FALSE, 'warning', NULL", mixed="""
SELECT customer_id, interaction_type, coalesce(CAST(satisfaction_score AS VARCHAR), channel) AS kind FROM interactions"""))
def check_type_profile(spark, sf):
    mixed = V.interactions(spark, sf).select(
        "customer_id", "interaction_type", F.coalesce(F.col("satisfaction_score").cast("string"), "channel").alias("kind")
    )
    docs = V.labelled_documents(spark, sf).select("doc_id", "n_chars")
    found = Q.validate({"mixed": mixed, "documents": docs}, AS_OF, ["check_type_profile"])
    return found.select("check_name", "passed", "severity", F.col("value").cast("bigint").alias("numbers"))


def _missing_parts(dataset: str) -> list[str]:
    table, columns = TABLES[dataset], COLUMNS[dataset]
    share = {c: f"(SELECT count_if({c} IS NULL) / count(*) FROM {table})" for c in columns}
    total = " + ".join(f"count_if({c} IS NULL)" for c in columns)
    overall = f"(SELECT ({total}) / (count(*) * {len(columns)}) AS v FROM {table})"
    parts = [row(dataset, "overall_missing", "FALSE", "'error'", "v", overall, "v > 0.05")]
    parts += [
        row(dataset, f"missing_values_{c}", "FALSE", "CASE WHEN v > 0.5 THEN 'error' ELSE 'warning' END", "v", f"(SELECT {s} AS v)", "v > 0.05")
        for c, s in share.items()
    ]
    return parts + [row(dataset, "missing_values", "TRUE", "'info'", "0", f"(SELECT greatest({', '.join(share.values())}) AS v)", "v <= 0.05")]


checked("check_missing", _missing_parts("documents") + _missing_parts("interactions") + _missing_parts("events"), "documents interactions events")


def _completeness(dataset: str) -> str:
    total = " + ".join(f"count_if({c} IS NULL)" for c in COLUMNS[dataset])
    table = f"(SELECT 1 - ({total}) / (count(*) * {len(COLUMNS[dataset])}) AS v FROM {TABLES[dataset]})"
    return row(dataset, "data_completeness", "v >= 0.95", "CASE WHEN v >= 0.95 THEN 'info' ELSE 'warning' END", "v", table)


checked("check_completeness", [_completeness("documents"), _completeness("customers")], "documents customers")


@query("check_duplicate_rows", oracle("interactions", """
SELECT dataset, 'duplicate_rows' AS check_name, n = 0 AS passed, CASE WHEN n = 0 THEN 'info' ELSE 'warning' END AS severity, CAST(n AS DOUBLE) AS value
FROM (SELECT 'interactions' AS dataset, (SELECT count(*) FROM interactions) - (SELECT count(*) FROM (SELECT DISTINCT * FROM interactions)) AS n
UNION ALL SELECT 'texts', (SELECT count(*) FROM documents) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)))"""))
def check_duplicate_rows(spark, sf):
    texts = V.read(spark, sf, "documents").select("text", "lang")
    found = Q.validate({"interactions": V.interactions(spark, sf), "texts": texts}, AS_OF, ["check_duplicate_rows"])
    return found.select("dataset", "check_name", "passed", "severity", "value")


def _key_part(dataset: str, column: str) -> str:
    table = f"(SELECT count(*) - count(DISTINCT {column}) - CASE WHEN count(*) > count({column}) THEN 1 ELSE 0 END AS n FROM {TABLES[dataset]})"
    name = f"CASE WHEN n > 0 THEN 'duplicate_primary_key_{column}' ELSE 'unique_primary_key_{column}' END"
    return f"SELECT '{dataset}' AS dataset, {name} AS check_name, n = 0 AS passed, CASE WHEN n > 0 THEN 'error' ELSE 'info' END AS severity, n AS value FROM {table}"


checked("check_primary_key", [_key_part("customers", "customer_id"), _key_part("transactions", "transaction_id"),
                              _key_part("interactions", "interaction_id")], "customers transactions interactions")
checked("check_foreign_key_cardinality", [
    row(d, f"foreign_key_cardinality_{c}", "TRUE", "'info'", "n", f"(SELECT count(DISTINCT {c}) AS n, count(*) AS r FROM {TABLES[d]})", "n < r")
    for d, c in (("transactions", "customer_id"), ("transactions", "product_id"), ("interactions", "customer_id"))
], "transactions interactions")
checked("check_age_range", [
    row("customers", "age_range", "n = 0", "CASE WHEN n = 0 THEN 'info' ELSE 'error' END", "n", "(SELECT count_if(age < 18 OR age > 100) AS n FROM facts)")
], "customers interactions")


@query("check_amounts", oracle("customers", f"""
SELECT 'negative_cost' AS check_name, FALSE AS passed, 'error' AS severity, CAST(count_if(lifetime_value < 0) AS DOUBLE) AS value FROM customers
UNION ALL SELECT 'negative_revenue', FALSE, 'error', CAST(count_if(lifetime_value < 0) AS DOUBLE) FROM customers
UNION ALL SELECT 'extreme_revenue', FALSE, 'warning', round(max(lifetime_value) * 1000000 + {NUDGE}, 4) FROM customers HAVING max(lifetime_value) * 1000000 > 1e9"""))
def check_amounts(spark, sf):
    balances = V.customers(spark, sf).select(F.col("lifetime_value").alias("cost"), (F.col("lifetime_value") * 1000000).alias("revenue"))
    found = Q.validate({"balances": balances.where("revenue is not null")}, AS_OF, ["check_amounts"])
    return rounded(found.select("check_name", "passed", "severity", "value"))


checked("check_dates", [
    row("interactions", "future_dates_interaction_date", "FALSE", "'warning'", "n",
        f"(SELECT count_if(interaction_date > TIMESTAMP '{AS_OF}') AS n FROM interactions)", "n > 0"),
    row("customers", "future_dates_registration_date", "FALSE", "'warning'", "n",
        f"(SELECT count_if(registration_date > TIMESTAMP '{AS_OF}') AS n FROM facts)", "n > 0"),
], "customers interactions")


@query("check_binary_domain", oracle("labelled_documents", """
SELECT 'churned_binary' AS check_name, FALSE AS passed, 'error' AS severity, CAST(count_if(quality + toxic NOT IN (0, 1)) AS DOUBLE) AS value
FROM labelled_documents HAVING count_if(quality + toxic NOT IN (0, 1)) > 0"""))
def check_binary_domain(spark, sf):
    docs = V.labelled_documents(spark, sf).select("doc_id", (F.col("quality") + F.col("toxic")).alias("churned"))
    return Q.validate({"documents": docs}, AS_OF, ["check_binary_domain"]).select("check_name", "passed", "severity", "value")


def _numbers(dataset: str) -> list[str]:
    return {"customers": FACT_NUMBERS, "events": ["event_id", "user_id", "value"], "documents": ["doc_id", "n_chars", "quality", "toxic"],
            "interactions": ["duration_seconds", "satisfaction_score"]}[dataset]


def _outlier_parts(dataset: str) -> list[str]:
    table, parts = TABLES[dataset], []
    for c in _numbers(dataset):
        fences = f"(SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {table})"
        counted = f"(SELECT count_if({c} NOT BETWEEN q1 - 3 * (q3 - q1) AND q3 + 3 * (q3 - q1)) AS n, count(*) AS r FROM {table}, {fences} WHERE q3 > q1)"
        parts.append(row(dataset, f"outliers_{c}", "FALSE", "'warning'", "n", counted, "r > 0 AND n / r > 0.05"))
    return parts


checked("check_outlier_share", _outlier_parts("events") + _outlier_parts("documents") + _outlier_parts("customers"), "events documents customers")
@query("check_zero_variance", f"""
SELECT 'zero_variance_tax' AS check_name, FALSE AS passed, 'warning' AS severity, round(s + {NUDGE}, 6) AS value
FROM (SELECT stddev_samp(l_tax / 10) AS s FROM lineitem) WHERE s < 0.01""")
def check_zero_variance(spark, sf):
    taxes = V.read(spark, sf, "lineitem").select((F.col("l_tax") / 10).alias("tax"), "l_quantity")
    found = Q.validate({"taxes": taxes}, AS_OF, ["check_zero_variance"])
    return rounded(found.select("check_name", "passed", "severity", "value"), 6)


checked("check_skew", [
    row(d, f"high_skew_{c}", "FALSE", "'info'", "s", f"(SELECT skewness({c}) AS s FROM {TABLES[d]})", "abs(s) > 3")
    for d in ("events", "documents", "customers") for c in _numbers(d)
], "events documents customers")


@query("check_sample_size", """
SELECT t AS dataset, 'sample_size' AS check_name, FALSE AS passed, 'warning' AS severity, CAST(n AS DOUBLE) AS value FROM
(SELECT 'nation' AS t, count(*) AS n FROM nation UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'orders', count(*) FROM orders)
WHERE n < 1000""")
def check_sample_size(spark, sf):
    tables = {t: V.read(spark, sf, t) for t in ("nation", "supplier", "orders")}
    found = Q.validate(tables, AS_OF, ["check_sample_size"])
    return found.select("dataset", "check_name", "passed", "severity", "value")


@query("check_class_imbalance", f"""
SELECT 'class_imbalance' AS check_name, FALSE AS passed, CASE WHEN r < 0.05 OR r > 0.95 THEN 'warning' ELSE 'info' END AS severity,
  round(r + {NUDGE}, 4) AS value FROM (SELECT avg(CAST(event_type = 'purchase' AS INT)) AS r FROM events) WHERE r < 0.1 OR r > 0.9""")
def check_class_imbalance(spark, sf):
    bought = V.read(spark, sf, "events").select((F.col("event_type") == "purchase").cast("int").alias("churned"))
    found = Q.validate({"events": bought}, AS_OF, ["check_class_imbalance"])
    return rounded(found.select("check_name", "passed", "severity", "value"))


checked("check_cardinality", [
    row(d, f"high_cardinality_{c}", "FALSE", "'warning'", "n", f"(SELECT count(DISTINCT {c}) AS n, count(*) AS r FROM {TABLES[d]})", "n / r > 0.5")
    for d, cs in (("customers", ["customer_id", *FACT_TEXTS]), ("interactions", ["interaction_id", "customer_id", "interaction_type", "channel", "resolution_status"]))
    for c in cs
], "customers interactions")


@query("check_date_order", oracle("customers", """
SELECT 'date_relationship_registration_date_first_transaction_date' AS check_name, FALSE AS passed, 'error' AS severity,
  CAST(count_if(registration_date + INTERVAL 1 DAY > created_at) AS DOUBLE) AS value FROM customers"""))
def check_date_order(spark, sf):
    shifted = V.customers(spark, sf).select(
        (F.col("registration_date") + F.expr("INTERVAL 1 DAY")).alias("registration_date"),
        F.col("created_at").alias("first_transaction_date"), F.col("updated_at").alias("last_transaction_date"),
    )
    return Q.validate({"shifted": shifted}, AS_OF, ["check_date_order"]).select("check_name", "passed", "severity", "value")


@query("check_spend_consistency", oracle("customers transactions", """
SELECT 'transaction_amount_consistency' AS check_name, FALSE AS passed, 'warning' AS severity,
  CAST(count_if(lifetime_value <= 0 AND total_transactions > 0) AS DOUBLE) AS value FROM facts""", facts=FACTS))
def check_spend_consistency(spark, sf):
    swapped = facts(spark, sf).withColumn("total_spent", F.col("lifetime_value"))
    return Q.validate({"customers": swapped}, AS_OF, ["check_spend_consistency"]).select("check_name", "passed", "severity", "value")


_SUMMARY_CHECKS = ["check_size", "check_missing", "check_primary_key", "check_foreign_key_cardinality", "check_age_range", "check_completeness"]


def _summary_sql() -> str:
    parts = [row(d, "dataframe_size", "TRUE", "'info'", "n", f"(SELECT count(*) AS n FROM {TABLES[d]})") for d in ("customers", "interactions")]
    parts += _missing_parts("customers") + _missing_parts("interactions") + [_completeness("customers"), _completeness("interactions")]
    parts += [_key_part("customers", "customer_id"), _key_part("interactions", "interaction_id")]
    parts += [row("interactions", "foreign_key_cardinality_customer_id", "TRUE", "'info'", "n", "(SELECT count(DISTINCT customer_id) AS n FROM interactions)")]
    parts += [row("customers", "age_range", "n = 0", "CASE WHEN n = 0 THEN 'info' ELSE 'error' END", "n", "(SELECT count_if(age < 18 OR age > 100) AS n FROM facts)")]
    return " UNION ALL ".join(f"({p})" for p in parts)


SUMMARY = f"""SELECT dataset, count(*) AS total_checks, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed,
  count(*) FILTER (NOT passed AND severity = 'error') AS errors, count(*) FILTER (NOT passed AND severity = 'warning') AS warnings,
  count(*) FILTER (severity = 'info') AS info, round(count_if(passed) / count(*) + {NUDGE}, 4) AS pass_rate,
  count_if(NOT passed AND severity = 'error') = 0 AS is_valid FROM checks GROUP BY dataset"""


def _summary(spark, sf):
    return Q.validation_summary(Q.validate({"customers": facts(spark, sf), "interactions": V.interactions(spark, sf)}, AS_OF, _SUMMARY_CHECKS))


@query("validation_summary", oracle("customers transactions interactions", SUMMARY, facts=FACTS, checks=_summary_sql()))
def validation_summary(spark, sf):
    return rounded(_summary(spark, sf))


@query("validation_gate", oracle("customers transactions interactions", f"""
SELECT dataset, is_valid, FALSE AS exempt, is_valid AS accepted FROM ({SUMMARY})""", facts=FACTS, checks=_summary_sql()))
def validation_gate(spark, sf):
    return Q.validation_gate(_summary(spark, sf))


def _summary_all(spark, sf):
    """All checks of the four datasets; what is joined is joined once, not for every pass of the checks."""
    with shuffles_removed(spark):
        joined = {"customers": materialize(facts(spark, sf)), "transactions": materialize(V.lines(spark, sf))}
    four = joined | {"interactions": V.interactions(spark, sf), "marketing": V.marketing(spark, sf)}
    return Q.validation_summary(Q.validate(four, AS_OF))


@query("validation_summary_all")
def validation_summary_all(spark, sf):
    return rounded(_summary_all(spark, sf))


@query("validation_gate_all")
def validation_gate_all(spark, sf):
    return Q.validation_gate(_summary_all(spark, sf))


# ---------------------------------------------------------------- exploration


def _overview_sql() -> str:
    parts = []
    for c in COLUMNS["customers"]:
        std = f"coalesce(stddev_samp({c}) < 0.01, FALSE)" if c in FACT_NUMBERS else "FALSE"
        wide = f"count(DISTINCT {c}) > 0.5 * count(*)" if c in ("customer_id", *FACT_TEXTS) else "FALSE"
        parts.append(
            f"SELECT '{c}' AS feature, count(*) AS rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM facts)) AS duplicate_rows, "
            f"count(*) FILTER ({c} IS NULL) AS nulls, round(100.0 * count_if({c} IS NULL) / count(*) + {NUDGE}, 4) AS missing_pct, "
            f"count(DISTINCT {c}) AS distinct_values, {std} AS zero_variance, {wide} AS high_cardinality FROM facts"
        )
    return " UNION ALL ".join(parts)


@query("eda_overview", facts_sql(_overview_sql()))
def eda_overview(spark, sf):
    return rounded(E.overview(facts(spark, sf)))


@query("eda_target", oracle("customers", f"""
SELECT churned AS class, n, {r4("n / sum(n) OVER () * 100", "percentage")}, round(max(n) OVER () / min(n) OVER (), 2) AS class_ratio,
  {r4("sum(-(n / t) * log2(n / t)) OVER ()", "entropy")}
FROM (SELECT churned, count(*) AS n, (SELECT count(*) FROM customers) AS t FROM customers GROUP BY churned)"""))
def eda_target(spark, sf):
    out = E.target_distribution(V.customers(spark, sf), "churned")
    return rounded(out.drop("class_ratio")).join(out.select("class", "class_ratio"), "class")


def _profile_sql(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r4(f'avg({c})', 'mean')}, {r4(f'median({c})', 'median')}, {r4(f'stddev_samp({c})', 'std')}, "
        f"round(CAST(min({c}) AS DOUBLE), 4) AS min, round(CAST(max({c}) AS DOUBLE), 4) AS max, {r4(f'quantile_cont({c}, 0.25)', 'q25')}, "
        f"{r4(f'quantile_cont({c}, 0.75)', 'q75')}, {r4(f'skewness({c})', 'skewness')}, {r4(f'kurtosis({c})', 'kurtosis')}, "
        f"count(*) FILTER ({c} = 0) AS zeros, count(DISTINCT {c}) AS distinct_values FROM facts" for c in columns
    )


@query("eda_numeric_profile", facts_sql(_profile_sql([c for c in FACT_NUMBERS if c != "churned"])))
def eda_numeric_profile(spark, sf):
    return rounded(E.numeric_profile(facts(spark, sf), target="churned"))


def _categorical_sql(columns: list[str], table: str) -> str:
    counts = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value, count(*) AS n FROM {table} WHERE {c} IS NOT NULL GROUP BY {c}" for c in columns)
    missing = " UNION ALL ".join(f"SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS missing FROM {table}" for c in columns)
    return f"""
SELECT feature, value, n, distinct_values, mode, missing FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS r,
  count(*) OVER (PARTITION BY feature) AS distinct_values, first(value) OVER (PARTITION BY feature ORDER BY n DESC, value) AS mode
FROM ({counts})) JOIN ({missing}) USING (feature) WHERE r <= 10"""


@query("eda_categorical_profile", facts_sql(_categorical_sql(FACT_TEXTS, "facts")))
def eda_categorical_profile(spark, sf):
    return E.categorical_profile(facts(spark, sf))


def _corr_rows(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS v FROM facts" for i, a in enumerate(columns) for b in columns[i + 1 :]
    )


@query("eda_correlation_pairs", facts_sql(f"""
SELECT a AS feature1, b AS feature2, round(v, 3) AS correlation, {r4(f"(SELECT (2 * sum(abs(v)) + {len(FACT_NUMBERS)}) / {len(FACT_NUMBERS) ** 2} FROM pairs)", "mean_correlation")},
  1.0::DOUBLE AS max_correlation FROM pairs WHERE abs(v) > 0.5""", pairs=_corr_rows(FACT_NUMBERS)))
def eda_correlation_pairs(spark, sf):
    return rounded(E.correlation_pairs(facts(spark, sf), FACT_NUMBERS, 0.5))


@query("eda_target_correlation", facts_sql(f"""
SELECT feature, {r4("abs(v)", "correlation")} FROM ({" UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, churned) AS v FROM facts" for c in FACT_NUMBERS if c != "churned")})
ORDER BY abs(v) DESC LIMIT 4"""))
def eda_target_correlation(spark, sf):
    return rounded(E.target_correlation_table(facts(spark, sf), "churned", FACT_NUMBERS, 4))


@query("eda_correlation_matrix", facts_sql(f"""
SELECT a AS feature1, b AS feature2, {r4("v", "correlation")} FROM (SELECT a, b, v FROM pairs UNION ALL SELECT b, a, v FROM pairs
  UNION ALL SELECT c, c, 1 FROM chosen) WHERE a IN (SELECT c FROM chosen) AND b IN (SELECT c FROM chosen)""", chosen=f"""SELECT c FROM ({" UNION ALL ".join(f"SELECT '{c}' AS c, var_samp({c}) AS v FROM facts" for c in FACT_NUMBERS)}) ORDER BY v DESC, c LIMIT 4""", pairs=_corr_rows(FACT_NUMBERS)))
def eda_correlation_matrix(spark, sf):
    return rounded(E.correlation_matrix(facts(spark, sf), FACT_NUMBERS, 4))


@query("eda_segments", oracle("customers", " UNION ALL ".join(
    f"SELECT '{s}' AS segment, {s} AS value, round(avg(churned), 3) AS churn_rate, count(churned) AS target_count, count(customer_id) AS customers "
    f"FROM customers WHERE {s} IS NOT NULL GROUP BY {s}" for s in ("customer_segment", "gender", "account_status"))))
def eda_segments(spark, sf):
    return E.segment_rates(V.customers(spark, sf), "churned", ["customer_segment", "gender", "account_status"])


def _chi_sql(column: str) -> str:
    cells = f"SELECT v, y, coalesce(o, 0) AS o FROM (SELECT * FROM (SELECT DISTINCT {column} AS v FROM customers WHERE {column} IS NOT NULL), (SELECT DISTINCT churned AS y FROM customers)) " \
            f"LEFT JOIN (SELECT {column} AS v, churned AS y, count(*) AS o FROM customers GROUP BY ALL) USING (v, y)"
    return f"""
SELECT '{column}' AS feature, {r4("sum(CASE WHEN dof = 1 THEN power(abs(o - e) - least(0.5, abs(o - e)), 2) ELSE power(o - e, 2) END / e)", "chi2_statistic")},
  any_value(dof) AS degrees_of_freedom FROM (SELECT o, sum(o) OVER (PARTITION BY v) * sum(o) OVER (PARTITION BY y) / sum(o) OVER () AS e,
  (SELECT (count(DISTINCT {column}) - 1) * (count(DISTINCT churned) - 1) FROM customers) AS dof FROM ({cells}))"""


@query("eda_chi_square", oracle("customers", " UNION ALL ".join(_chi_sql(c) for c in FACT_TEXTS)))
def eda_chi_square(spark, sf):
    return rounded(E.chi_square_tests(V.customers(spark, sf), "churned", FACT_TEXTS).select("feature", "chi2_statistic", "degrees_of_freedom"))


@query("eda_chi_square_all")
def eda_chi_square_all(spark, sf):
    """With p-values and verdicts, which need the tails of distributions that SQL lacks."""
    return rounded(E.chi_square_tests(V.customers(spark, sf), "churned", FACT_TEXTS))


def _t_sql(c: str) -> str:
    return f"""
SELECT '{c}' AS feature, {r4("(m0 - m1) / sqrt((s0 + s1) / (n0 + n1 - 2) * (1 / n0 + 1 / n1))", "t_statistic")}, {r4("m1 - m0", "mean_diff")} FROM (
SELECT count({c}) FILTER (churned = 0) AS n0, count({c}) FILTER (churned = 1) AS n1, avg({c}) FILTER (churned = 0) AS m0, avg({c}) FILTER (churned = 1) AS m1,
  var_pop({c}) FILTER (churned = 0) * n0 AS s0, var_pop({c}) FILTER (churned = 1) * n1 AS s1 FROM facts)"""


@query("eda_t_test", facts_sql(" UNION ALL ".join(_t_sql(c) for c in FACT_NUMBERS if c != "churned")))
def eda_t_test(spark, sf):
    return rounded(E.t_tests(facts(spark, sf), "churned", FACT_NUMBERS).select("feature", "t_statistic", "mean_diff"))


@query("eda_t_test_all")
def eda_t_test_all(spark, sf):
    """With p-values and verdicts, which need the tails of distributions that SQL lacks."""
    return rounded(E.t_tests(facts(spark, sf), "churned", FACT_NUMBERS))


def _histogram_sql(c: str) -> str:
    return f"""
SELECT '{c}' AS feature, churned, bin, {r4("lo + bin * (hi - lo) / 30", "bin_start")}, coalesce(n, 0) AS n, {r4("coalesce(n, 0) / (t * (hi - lo) / 30) * 1000", "density_per_mille")}
FROM (SELECT * FROM (SELECT churned, min({c}) AS lo, max({c}) AS hi, count({c}) AS t FROM facts GROUP BY churned), (SELECT CAST(unnest(range(30)) AS INT) AS bin))
LEFT JOIN (SELECT f.churned, CAST(least(29, floor(({c} - lo) / (hi - lo) * 30)) AS INT) AS bin, count(*) AS n FROM facts f
  JOIN (SELECT churned, min({c}) AS lo, max({c}) AS hi FROM facts GROUP BY churned) r ON r.churned = f.churned WHERE {c} IS NOT NULL GROUP BY ALL) USING (churned, bin)"""


@query("eda_histograms", facts_sql(" UNION ALL ".join(_histogram_sql(c) for c in ("lifetime_value", "max_transaction_value"))))
def eda_histograms(spark, sf):
    out = E.histograms(facts(spark, sf), "churned", ["lifetime_value", "max_transaction_value"])
    return rounded(out.select("feature", "churned", "bin", "bin_start", "n", (F.col("density") * 1000).alias("density_per_mille")))


@query("eda_monthly_series", oracle("customers", f"""
SELECT CAST(date_trunc('month', registration_date) AS TIMESTAMP) AS month, count(*) AS registrations, {r4("avg(churned)", "churn_rate")}
FROM customers WHERE registration_date IS NOT NULL GROUP BY ALL"""))
def eda_monthly_series(spark, sf):
    return rounded(E.monthly_series(V.customers(spark, sf)))


@query("eda_value_counts", oracle("interactions", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM interactions WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in ("interaction_type", "channel", "resolution_status", "satisfaction_score"))))
def eda_value_counts(spark, sf):
    return E.value_counts(V.interactions(spark, sf), ["interaction_type", "channel", "resolution_status", "satisfaction_score"])


@query("eda_dataset_totals", oracle("transactions interactions marketing", f"""
SELECT transactions, buyers, round(revenue + {NUDGE}, 2) AS revenue, {", ".join(r4(c, c) for c in ("mean_amount", "max_amount", "median_amount"))}, interactions,
  {", ".join(r4(c, c) for c in ("mean_satisfaction", "mean_duration"))}, campaigns, {", ".join(r4(c, c) for c in ("open_rate", "click_rate", "conversion_rate"))}
FROM (SELECT count(*) AS transactions, count(DISTINCT customer_id) AS buyers, sum(total_amount) AS revenue, avg(total_amount) AS mean_amount,
  max(total_amount) AS max_amount, median(total_amount) AS median_amount FROM transactions),
(SELECT count(*) AS interactions, avg(satisfaction_score) AS mean_satisfaction, avg(duration_seconds) AS mean_duration FROM interactions),
(SELECT count(*) AS campaigns, avg(opened) AS open_rate, avg(clicked) AS click_rate, avg(converted) AS conversion_rate FROM clean_marketing)""", **CLEAN_MARKETING))
def eda_dataset_totals(spark, sf):
    totals = E.dataset_totals(V.transactions(spark, sf), V.interactions(spark, sf), clean_marketing(V.marketing(spark, sf)))
    return rounded(totals.withColumn("revenue", F.round(F.col("revenue") + NUDGE, 2)))


def _before_after_sql(name: str, raw: str, clean: str, raw_columns: list[str], clean_columns: list[str]) -> str:
    nulls = lambda t, cs: f"(SELECT CAST({' + '.join(f'count_if({c} IS NULL)' for c in cs)} AS BIGINT) FROM {t})"
    repeats = lambda t: f"(SELECT count(*) FROM {t}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t}))"
    return f"""SELECT '{name}' AS dataset, (SELECT count(*) FROM {raw}) AS rows_before, (SELECT count(*) FROM {clean}) AS rows_after,
  {nulls(raw, raw_columns)} AS nulls_before, {nulls(clean, clean_columns)} AS nulls_after, {repeats(raw)} AS duplicates_before,
  {repeats(clean)} AS duplicates_after, {len(set(clean_columns) - set(raw_columns))}::BIGINT AS columns_added"""


_RAW_CUSTOMERS = ["customer_id", "registration_date", "age", "gender", "state", "customer_segment", "lifetime_value", "email_verified",
                  "phone_verified", "account_status", "churned", "created_at", "updated_at"]
_DERIVED = ["account_age_days", "account_age_months", "age_group", "fully_verified", "verification_level"]


_MARKETING = ["campaign_id", "customer_id", "campaign_date", "campaign_type", "sent", "opened", "clicked", "converted", "cost"]
_PARTS = ["transaction_year", "transaction_month", "transaction_day", "transaction_hour", "transaction_weekday", "is_weekend"]


@query("eda_before_after", oracle("customers lines interactions marketing", " UNION ALL ".join([
    _before_after_sql("customers", "customers", "clean_customers", _RAW_CUSTOMERS, _RAW_CUSTOMERS + _DERIVED),
    _before_after_sql("transactions", "lines", "clean_lines", COLUMNS["transactions"], COLUMNS["transactions"] + _PARTS),
    _before_after_sql("interactions", "interactions", "clean_interactions", COLUMNS["interactions"], COLUMNS["interactions"] + ["interaction_hour", "is_business_hours"]),
    _before_after_sql("marketing", "marketing", "clean_marketing", _MARKETING, _MARKETING),
]), **CLEAN_CUSTOMERS, **CLEAN_LINES, **CLEAN_INTERACTIONS, **CLEAN_MARKETING))
def eda_before_after(spark, sf):
    raw = {"customers": V.customers(spark, sf), "transactions": V.lines(spark, sf), "interactions": V.interactions(spark, sf), "marketing": V.marketing(spark, sf)}
    return E.before_after(raw, clean_all(raw, AS_OF, earliest=EARLIEST))
