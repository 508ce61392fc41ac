"""Splits, scalers, encoders and feature selection on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import views as V
from bindings.features import r4, rounded
from bindings.quality import FACT_NUMBERS, facts, facts_sql
from bindings.registry import query
from bindings.views import oracle
from custoria.operators import encoding as N
from custoria.operators import scaling as Z
from custoria.operators import selection as L
from custoria.operators import split as P
from custoria.session import materialize, workspace

INPUTS = [c for c in FACT_NUMBERS if c != "churned"]

# ---------------------------------------------------------------- splits

SPLIT = """
SELECT customer_id, churned, CASE WHEN r <= floor(n * 0.70 + 0.5) THEN 'train' WHEN r <= floor(n * 0.85 + 0.5) THEN 'val' ELSE 'test' END AS split
FROM (SELECT customer_id, churned, row_number() OVER (PARTITION BY churned ORDER BY md5(customer_id || '|42'), customer_id) AS r,
  count(*) OVER (PARTITION BY churned) AS n FROM customers)"""


def _split(spark, sf):
    return P.split_stratified(V.customers(spark, sf).select("customer_id", "churned"), "churned", "customer_id")


@query("split_stratified", oracle("customers", SPLIT))
def split_stratified(spark, sf):
    return _split(spark, sf)


@query("split_stratified_folds", oracle("customers", """
SELECT customer_id, churned, CASE WHEN r <= n // 5 THEN 0 WHEN r <= 2 * n // 5 THEN 1 WHEN r <= 3 * n // 5 THEN 2 WHEN r <= 4 * n // 5 THEN 3 ELSE 4 END AS fold
FROM (SELECT customer_id, churned, row_number() OVER (PARTITION BY churned ORDER BY md5(customer_id || '|42'), customer_id) AS r,
  count(*) OVER (PARTITION BY churned) AS n FROM customers WHERE churned IS NOT NULL)"""))
def split_stratified_folds(spark, sf):
    return P.with_folds(V.customers(spark, sf).select("customer_id", "churned"), "churned", "customer_id", 5)


@query("split_report", oracle("customers", f"""
SELECT split, churned AS class, n, split_rows, {r4("split_rows / (SELECT count(*) FROM customers)", "split_share")}, {r4("n / split_rows", "class_share")}
FROM (SELECT split, churned, count(*) AS n FROM parts GROUP BY ALL) JOIN (SELECT split, count(*) AS split_rows FROM parts GROUP BY split) USING (split)""", parts=SPLIT))
def split_report(spark, sf):
    return rounded(P.split_report(_split(spark, sf), "churned"))


# ---------------------------------------------------------------- scalers


def _scaled_sql(expression: str) -> str:
    """One expression per input; {c} is the column."""
    return "SELECT customer_id, " + ", ".join(r4(expression.format(c=c), c) for c in INPUTS) + " FROM facts"


def _scaler(name: str, method: str, expression: str):
    @query(name, facts_sql(_scaled_sql(expression)))
    def run(spark, sf):
        data = facts(spark, sf).select("customer_id", *INPUTS)
        return rounded(Z.apply(data, Z.fit(data, INPUTS, method), method))


_scaler("scale_standard", "standard", "({c} - (SELECT avg({c}) FROM facts)) / (SELECT stddev_pop({c}) FROM facts)")
_scaler("scale_minmax", "minmax", "({c} - (SELECT min({c}) FROM facts)) / (SELECT max({c}) - min({c}) FROM facts)")
_scaler("scale_maxabs", "maxabs", "{c} / (SELECT max(abs({c})) FROM facts)")
_scaler("scale_robust", "robust", "({c} - (SELECT median({c}) FROM facts)) / (SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM facts)")


@query("scale_row_norm", facts_sql("SELECT customer_id, " + ", ".join(
    r4(f"{c} / sqrt(lifetime_value * lifetime_value + total_spent * total_spent)", c) for c in ("lifetime_value", "total_spent")
) + " FROM facts"))
def scale_row_norm(spark, sf):
    data = facts(spark, sf).select("customer_id", "lifetime_value", "total_spent")
    return rounded(Z.apply(data, Z.fit(data, ["lifetime_value", "total_spent"], "normalizer"), "normalizer"))


def _normal_sql(u: str) -> str:
    """The published rational approximation of the normal quantile, written out."""

    def ratio(parts, x):
        top, bottom = (" + ".join(f"{v!r} * power({x}, {len(p) - 1 - i})" for i, v in enumerate(p)) for p in parts)
        return f"({top}) / ({bottom})"

    q, r = f"({u} - 0.5)", f"sqrt(-ln(least({u}, 1 - {u})))"
    tail = f"CASE WHEN {r} <= 5 THEN {ratio(Z._MIDDLE, f'({r} - 1.6)')} ELSE {ratio(Z._FAR, f'({r} - 5)')} END"
    return f"CASE WHEN abs({q}) <= 0.425 THEN {q} * {ratio(Z._CENTRAL, f'(0.180625 - {q} * {q})')} ELSE sign({q}) * ({tail}) END"


QUANTILE_INPUTS = ["age", "total_spent", "total_transactions"]


def _place_sql(c: str) -> str:
    """Probability of each value in the 1000-point grid; ties take the middle of their range."""
    return f"""
SELECT v, greatest(1e-7, least(1 - 1e-7, CASE WHEN lo <= hi THEN (lo + hi) / 2.0 / 999 ELSE (hi + (v - gh) / (gl - gh)) / 999 END)) AS u FROM (
SELECT v, min(i) FILTER (g >= v) AS lo, max(i) FILTER (g <= v) AS hi, min(g) FILTER (g >= v) AS gl, max(g) FILTER (g <= v) AS gh
FROM (SELECT DISTINCT {c} AS v FROM facts WHERE {c} IS NOT NULL), (SELECT unnest(range(1000)) AS i,
  unnest((SELECT quantile_cont({c}, [{", ".join(repr(i / 999) for i in range(1000))}]) FROM facts)) AS g) GROUP BY v)"""


@query("scale_quantile_normal", facts_sql(
    "SELECT customer_id, " + ", ".join(r4(_normal_sql(f"p_{c}.u"), c) for c in QUANTILE_INPUTS) + " FROM facts "
    + " ".join(f"LEFT JOIN p_{c} ON p_{c}.v = facts.{c}" for c in QUANTILE_INPUTS), **{f"p_{c}": _place_sql(c) for c in QUANTILE_INPUTS}))
def scale_quantile_normal(spark, sf):
    data = materialize(facts(spark, sf).select("customer_id", *QUANTILE_INPUTS))
    return rounded(Z.apply(data, Z.fit(data, QUANTILE_INPUTS, "quantile"), "quantile"))


POWER_INPUTS = ["lifetime_value", "total_spent", "total_transactions"]


def _power_value(x: str, p: str) -> str:
    return (
        f"CASE WHEN {x} >= 0 THEN CASE WHEN {p} = 0 THEN ln(1 + {x}) ELSE (power({x} + 1, {p}) - 1) / {p} END "
        f"ELSE CASE WHEN {p} = 2 THEN -ln(1 - {x}) ELSE -(power(1 - {x}, 2 - {p}) - 1) / (2 - {p}) END END"
    )


def _power_ctes() -> dict[str, str]:
    """Four rounds per column: 25 powers around the best of the round before, an eighth of the step each time."""
    out = {}
    for c in POWER_INPUTS:
        before, step = "(SELECT 1.0::DOUBLE AS p)", 0.25
        for i in range(4):
            out[f"{c}_{i}"] = f"""SELECT p FROM (SELECT p, -count(x) / 2 * ln(var_pop(t)) + (p - 1) * sum(sign(x) * ln(1 + abs(x))) AS fit
FROM (SELECT x, g.p, {_power_value("x", "g.p")} AS t FROM (SELECT CAST({c} AS DOUBLE) AS x FROM facts WHERE {c} IS NOT NULL),
  (SELECT b.p + {step}::DOUBLE * s.k AS p FROM {before} b, (SELECT unnest(range(-12, 13)) AS k) s) g) GROUP BY p) ORDER BY fit DESC, p LIMIT 1"""
            before, step = f"{c}_{i}", step / 8
        out[f"{c}_t"] = f"SELECT customer_id, {_power_value(f'CAST({c} AS DOUBLE)', 'p')} AS t FROM facts, {c}_3"
    return out


@query("scale_yeo_johnson", facts_sql(
    "SELECT customer_id, " + ", ".join(r4(f"({c}_t.t - (SELECT avg(t) FROM {c}_t)) / (SELECT stddev_pop(t) FROM {c}_t)", c) for c in POWER_INPUTS)
    + " FROM facts " + " ".join(f"JOIN {c}_t USING (customer_id)" for c in POWER_INPUTS), **_power_ctes()))
def scale_yeo_johnson(spark, sf):
    data = materialize(facts(spark, sf).select("customer_id", *POWER_INPUTS))
    return rounded(Z.apply(data, Z.fit(data, POWER_INPUTS, "power"), "power"))


# weight of a category's own mean among n rows
_BLEND = "1 / (1 + exp(-(n - 20) / 10.0))"
MODEL_FRAME = ["customer_id", *INPUTS, "gender", "state", "customer_segment", "account_status", "churned"]


@query("detect_feature_types", facts_sql(" UNION ALL ".join(
    [f"SELECT '{c}' AS feature, CASE WHEN abs(skewness({c})) < 0.5 THEN 'numeric_normal' WHEN abs(skewness({c})) < 2 THEN 'numeric_skewed' ELSE 'numeric_heavy_tail' END AS feature_type FROM facts" for c in INPUTS]
    + [f"SELECT '{c}', CASE WHEN count(DISTINCT {c}) = 2 THEN 'binary' WHEN count(DISTINCT {c}) <= 10 THEN 'categorical_low' WHEN count(DISTINCT {c}) <= 50 THEN 'categorical_high' ELSE 'text' END FROM facts"
       for c in ("gender", "state", "customer_segment", "account_status")]
    + ["SELECT 'churned', 'binary'", "SELECT 'customer_id', 'id'"])))
def detect_feature_types(spark, sf):
    types = Z.detect_feature_types(facts(spark, sf).select(*MODEL_FRAME))
    return spark.createDataFrame(list(types.items()), "feature string, feature_type string")


@query("scale_auto", facts_sql(
    "SELECT customer_id, account_status, " + ", ".join(
        r4(f"({c} - (SELECT avg({c}) FROM facts)) / (SELECT stddev_pop({c}) FROM facts)", c) for c in INPUTS if c != "max_transaction_value"
    ) + ", " + r4("(max_transaction_value - (SELECT median(max_transaction_value) FROM facts)) / "
                  "(SELECT quantile_cont(max_transaction_value, 0.75) - quantile_cont(max_transaction_value, 0.25) FROM facts)", "max_transaction_value")
    + ", " + ", ".join(f"gender = '{g}' AS gender_{g}" for g in "bfhm")
    + ", " + ", ".join(f"customer_segment = '{c}' AS \"customer_segment_{c}\"" for c in ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"))
    + f""", {r4(f"CASE WHEN n <= 1 THEN p ELSE p * (1 - {_BLEND}) + a * {_BLEND} END", "state")} FROM facts
JOIN (SELECT state, count(*) AS n, avg(churned) AS a FROM facts GROUP BY state) USING (state), (SELECT avg(churned) AS p FROM facts)"""))
def scale_auto(spark, sf):
    """Fit, save, load again and transform with the loaded state."""
    data = materialize(facts(spark, sf).select(*MODEL_FRAME))
    path = workspace(spark)
    Z.fit_auto(data, "churned").save(spark, path)
    return rounded(Z.FittedScaling.load(spark, path).transform(data))


@query("scaling_report", facts_sql(f"""
SELECT feature AS "column", 'standard' AS method, 1 AS columns_out, {r4("m", "mean")}, {r4("s", "scale")} FROM ({" UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg({c}) AS m, stddev_pop({c}) AS s FROM facts" for c in INPUTS)})
UNION ALL SELECT 'customer_segment', 'onehot', 4, NULL, NULL UNION ALL SELECT 'customer_id', 'passthrough', 1, NULL, NULL"""))
def scaling_report(spark, sf):
    data = facts(spark, sf).select("customer_id", *INPUTS, "customer_segment")
    methods = Z.DEFAULT_METHODS | {t: "standard" for t in ("numeric_normal", "numeric_skewed", "numeric_heavy_tail")}
    return rounded(Z.fit_auto(data, methods=methods).report(spark).drop("feature_type"))


# ---------------------------------------------------------------- encoders


@query("encode_label", oracle("customers", "SELECT customer_id, state, CAST(dense_rank() OVER (ORDER BY state) - 1 AS INT) AS state_encoded FROM customers"))
def encode_label(spark, sf):
    return N.encode_label(V.customers(spark, sf).select("customer_id", "state"), "state")


@query("encode_ordinal", oracle("interactions", """
SELECT interaction_id, interaction_type_ordinal, channel_ordinal FROM interactions
LEFT JOIN (SELECT interaction_type, CAST(row_number() OVER (ORDER BY interaction_type) - 1 AS INT) AS interaction_type_ordinal FROM (SELECT DISTINCT interaction_type FROM interactions)) USING (interaction_type)
LEFT JOIN (SELECT channel, CAST(row_number() OVER (ORDER BY channel) - 1 AS INT) AS channel_ordinal FROM (SELECT DISTINCT channel FROM interactions WHERE channel IS NOT NULL)) USING (channel)"""))
def encode_ordinal(spark, sf):
    out = N.encode_ordinal(V.interactions(spark, sf), ["interaction_type", "channel"])
    return out.select("interaction_id", "interaction_type_ordinal", "channel_ordinal")


@query("encode_onehot", oracle("interactions", """
SELECT interaction_id, interaction_type = 'Complaint' AS "interaction_type_Complaint", interaction_type = 'Purchase' AS "interaction_type_Purchase",
  interaction_type = 'Support' AS "interaction_type_Support", interaction_type = 'View' AS "interaction_type_View",
  coalesce(channel = 'Live Chat', FALSE) AS "channel_Live Chat", coalesce(channel = 'Phone', FALSE) AS "channel_Phone" FROM interactions"""))
def encode_onehot(spark, sf):
    return N.encode_onehot(V.interactions(spark, sf).select("interaction_id", "interaction_type", "channel"), ["interaction_type", "channel"]).drop("interaction_type", "channel")


@query("encode_target", oracle("customers", f"""
SELECT customer_id, {r4(f"CASE WHEN n <= 1 THEN p ELSE p * (1 - {_BLEND}) + a * {_BLEND} END", "state_target_encoded")} FROM customers
JOIN (SELECT state, count(*) AS n, avg(churned) AS a FROM customers GROUP BY state) USING (state), (SELECT avg(churned) AS p FROM customers)"""))
def encode_target(spark, sf):
    return rounded(N.encode_target(V.customers(spark, sf).select("customer_id", "state", "churned"), "state", "churned").select("customer_id", "state_target_encoded"))


@query("encode_binary", oracle("customers", "SELECT customer_id, " + ", ".join(
    f"CAST((code >> {4 - i}) & 1 AS INT) AS state_{i}" for i in range(5)) + " FROM (SELECT customer_id, dense_rank() OVER (ORDER BY state) AS code FROM customers)"))
def encode_binary(spark, sf):
    return N.encode_binary(V.customers(spark, sf).select("customer_id", "state"), "state").drop("state")


def _bucket(c: str) -> str:
    return f"CAST(('0x' || substr(md5({c}), 1, 8)) AS BIGINT) % 32"


@query("encode_hashing", "SELECT doc_id, " + ", ".join(
    f"CAST({_bucket('lang')} = {i} AS INT) + CAST({_bucket('source')} = {i} AS INT) AS hash_{i}" for i in range(32)) + " FROM documents")
def encode_hashing(spark, sf):
    return N.encode_hashing(V.read(spark, sf, "documents").select("doc_id", "lang", "source"), ["lang", "source"]).drop("lang", "source")


@query("encode_auto", oracle("customers", f"""
SELECT customer_id, churned, account_status, state, CASE account_status WHEN 'active' THEN 0 WHEN 'deleted' THEN 1 END AS account_status_encoded,
  {", ".join(f"state = 'nation_{i}' AS state_nation_{i}" for i in range(1, 25))}, month,
  {r4(f"CASE WHEN n <= 1 THEN p ELSE p * (1 - {_BLEND}) + a * {_BLEND} END", "month_target_encoded")}
FROM (SELECT *, strftime(registration_date, '%Y-%m') AS month FROM customers)
LEFT JOIN (SELECT strftime(registration_date, '%Y-%m') AS m, count(*) AS n, avg(churned) AS a FROM customers GROUP BY ALL) ON m IS NOT DISTINCT FROM month,
  (SELECT avg(churned) AS p FROM customers)"""))
def encode_auto(spark, sf):
    data = V.customers(spark, sf).select(
        "customer_id", "churned", "account_status", "state", F.date_format("registration_date", "yyyy-MM").alias("month")
    )
    return rounded(N.encode_auto(data, "churned"))


# ---------------------------------------------------------------- selection


def _pairs_sql(columns: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {i} AS i, corr({a}, {b}) AS v FROM facts" for i, a in enumerate(columns) for b in columns[i + 1 :])


@query("select_uncorrelated", facts_sql(f"""
SELECT a AS feature1, b AS feature2, {r4("abs(v)", "correlation")}, CASE WHEN wb.w > wa.w THEN a ELSE b END AS dropped, CASE WHEN wb.w > wa.w THEN b ELSE a END AS kept
FROM pairs JOIN weights wa ON wa.c = a JOIN weights wb ON wb.c = b WHERE abs(v) > 0.5""",
    pairs=_pairs_sql(INPUTS), weights=" UNION ALL ".join(f"SELECT '{c}' AS c, abs(corr({c}, churned)) AS w FROM facts" for c in INPUTS)))
def select_uncorrelated(spark, sf):
    return rounded(L.drop_correlated(facts(spark, sf), INPUTS, 0.5, "churned")[1])


@query("select_variance", """
SELECT feature, round(v + 1.3e-7, 4) AS variance, v > 0.01 AS kept FROM (SELECT 'l_quantity' AS feature, var_pop(l_quantity) AS v FROM lineitem
UNION ALL SELECT 'l_discount', var_pop(l_discount) FROM lineitem UNION ALL SELECT 'l_tax', var_pop(l_tax) FROM lineitem)""")
def select_variance(spark, sf):
    lines = V.read(spark, sf, "lineitem")
    found = L.variances(lines, ["l_quantity", "l_discount", "l_tax"])
    return rounded(spark.createDataFrame([(c, v, v > 0.01) for c, v in found.items()], "feature string, variance double, kept boolean"))


def _f_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature, (sum(n * power(m - g, 2)) / (count(*) - 1)) / (sum(ss) / (sum(n) - count(*))) AS f
FROM (SELECT count({c}) AS n, avg({c}) AS m, var_pop({c}) * count({c}) AS ss FROM facts GROUP BY churned), (SELECT avg({c}) AS g FROM facts)"""


F_SCORES = " UNION ALL ".join(_f_sql(c) for c in INPUTS)


@query("select_k_best_f", facts_sql(f"SELECT feature, {r4('f', 'f_score')} FROM ({F_SCORES}) ORDER BY f DESC LIMIT 4"))
def select_k_best_f(spark, sf):
    scores = L.anova_f(facts(spark, sf), "churned", INPUTS)
    return rounded(spark.createDataFrame([(c, scores[c]) for c in L.best_k(scores, 4)], "feature string, f_score double"))


def _mi_sql(c: str) -> str:
    bins = "1 + " + " + ".join(f"CAST({c} > (SELECT quantile_cont({c}, {i / 10}) FROM facts) AS INT)" for i in range(1, 10))
    return f"""SELECT '{c}' AS feature, greatest(sum(n / t * ln(n * t / (nx * ny))), 0) AS importance FROM (SELECT *, sum(n) OVER () AS t,
  sum(n) OVER (PARTITION BY bin) AS nx, sum(n) OVER (PARTITION BY churned) AS ny FROM (SELECT {bins} AS bin, churned, count(*) AS n FROM facts WHERE {c} IS NOT NULL GROUP BY ALL))"""


MI_SCORES = " UNION ALL ".join(_mi_sql(c) for c in INPUTS)


@query("mutual_information", facts_sql(f"SELECT feature, {r4('importance', 'importance')} FROM ({MI_SCORES})"))
def mutual_information(spark, sf):
    return rounded(L.mutual_information(materialize(facts(spark, sf)), "churned", INPUTS))


@query("join_score_reports", facts_sql(f"""
SELECT coalesce(a.feature, b.feature) AS feature, {r4("importance", "mi_score")}, {r4("f", "kbest_score")}, coalesce(a.feature, b.feature) IN ('age', 'total_spent') AS selected
FROM (SELECT * FROM ({MI_SCORES}) WHERE feature <> 'age') a FULL JOIN (SELECT * FROM ({F_SCORES}) WHERE feature <> 'total_spent') b ON a.feature = b.feature"""))
def join_score_reports(spark, sf):
    data = materialize(facts(spark, sf))
    mi = {r["feature"]: r["importance"] for r in L.mutual_information(data, "churned", [c for c in INPUTS if c != "age"]).collect()}
    f = L.anova_f(data, "churned", [c for c in INPUTS if c != "total_spent"])
    return rounded(L.score_report(spark, {"mi": mi, "kbest": f}, ["age", "total_spent"]))


@query("select_rfe_cv")
def select_rfe_cv(spark, sf):
    chosen, ranking, _ = L.select_rfe_cv(facts(spark, sf), "churned", "customer_id", INPUTS, 3)
    return spark.createDataFrame([(c, r, c in chosen) for c, r in ranking.items()], "feature string, ranking int, selected boolean")


@query("select_permutation")
def select_permutation(spark, sf):
    scores = L.permutation_importance(facts(spark, sf), "churned", "customer_id", INPUTS)
    return rounded(spark.createDataFrame(list(scores.items()), "feature string, importance double"))


@query("select_forest_importance")
def select_forest_importance(spark, sf):
    scores = L.forest_importance(facts(spark, sf), "churned", INPUTS)
    return rounded(spark.createDataFrame(list(scores.items()), "feature string, importance double"))


@query("select_ensemble_vote")
def select_ensemble_vote(spark, sf):
    data = materialize(facts(spark, sf))
    return L.select_ensemble_vote(data, "churned", "customer_id", INPUTS, 3)
