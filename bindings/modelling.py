"""Classifiers and metrics on the test tables."""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, NaiveBayes
from pyspark.sql import functions as F

from bindings import views as V
from bindings.features import r4, rounded
from bindings.preparation import INPUTS
from bindings.quality import facts
from bindings.registry import query
from bindings.views import oracle
from custoria.operators import metrics as M
from custoria.operators import models as D
from custoria.operators.scaling import apply, fit
from custoria.operators.split import split_stratified
from custoria.session import materialize, workspace


def frame(spark, sf):
    """All customers with standardised numbers and their part of the split."""
    data = materialize(facts(spark, sf).select("customer_id", "churned", *INPUTS).fillna(0.0))
    scaled = apply(data, fit(data, INPUTS, "standard"), "standard")
    parts = split_stratified(scaled, "churned", "customer_id")
    return materialize(D.training_frame(parts, INPUTS, "churned", "customer_id", ["split"]))


def train_test(spark, sf):
    data = frame(spark, sf)
    return data.where("split = 'train'"), data.where("split = 'test'")


# ---------------------------------------------------------------- metrics, checked against SQL

# a coarse score with many ties across the classes
SCORED = "SELECT customer_segment, churned, floor(lifetime_value / 1000) AS score, CAST(lifetime_value > 3000 AS INT) AS prediction FROM customers"
COUNTS = """SELECT customer_segment, count(*) FILTER (churned = 1 AND prediction = 1) AS tp, count(*) FILTER (churned = 0 AND prediction = 1) AS fp,
  count(*) FILTER (churned = 1 AND prediction = 0) AS fn, count(*) AS n, count(*) FILTER (churned = prediction) AS hits FROM scored GROUP BY customer_segment"""


def scored(spark, sf):
    value = F.col("lifetime_value")
    return V.customers(spark, sf).select(
        "customer_segment", "churned", F.floor(value / 1000).cast("double").alias("score"), (value > 3000).cast("int").alias("prediction")
    )


@query("classification_metrics", oracle("customers", f"""
SELECT customer_segment, {r4("hits / n", "accuracy")}, {r4("p", "precision")}, {r4("r", "recall")}, {r4("CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END", "f1")}
FROM (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS r FROM counts)""", scored=SCORED, counts=COUNTS))
def classification_metrics(spark, sf):
    return rounded(M.classification_metrics(scored(spark, sf), "churned", "prediction", ["customer_segment"]))


@query("f2_score", oracle("customers", f"""
SELECT customer_segment, {r4("CASE WHEN 4 * p + r = 0 THEN 0 ELSE 5 * p * r / (4 * p + r) END", "f2")}
FROM (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS r FROM counts)""", scored=SCORED, counts=COUNTS))
def f2_score(spark, sf):
    return rounded(M.f2_score(scored(spark, sf), "churned", "prediction", ["customer_segment"]))


@query("roc_auc", oracle("customers", f"""
SELECT customer_segment, {r4("(sum(r) FILTER (churned = 1) - p * (p + 1) / 2) / (p * (n - p))", "auc_roc")} FROM (SELECT customer_segment, churned,
  rank() OVER (PARTITION BY customer_segment ORDER BY score) + (count(*) OVER (PARTITION BY customer_segment, score) - 1) / 2 AS r,
  count(*) OVER (PARTITION BY customer_segment) AS n, count(*) FILTER (churned = 1) OVER (PARTITION BY customer_segment) AS p FROM scored)
GROUP BY customer_segment, n, p""", scored=SCORED))
def roc_auc(spark, sf):
    return rounded(M.roc_auc(scored(spark, sf), "churned", "score", ["customer_segment"]))


def _importances(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int") % 3
    table = V.read(spark, sf, "events").select(
        F.col("event_type").alias("feature"), F.when(k == 0, "model_a").when(k == 1, "model_b").otherwise("model_c").alias("model"), "value"
    )
    return table.groupBy("feature", "model").agg(F.avg("value").alias("importance"))


@query("importance_summary", f"""
SELECT feature, {r4("coalesce(a, 0)", "model_a")}, {r4("coalesce(b, 0)", "model_b")}, {r4("coalesce(c, 0)", "model_c")}, {r4("(coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0)) / 3", "avg_importance")}
FROM (SELECT event_type AS feature, avg(value) FILTER (k % 3 = 0) AS a, avg(value) FILTER (k % 3 = 1) AS b, avg(value) FILTER (k % 3 = 2) AS c
FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INT) AS k FROM events) GROUP BY event_type)""")
def importance_summary(spark, sf):
    return rounded(D.importance_summary(_importances(spark, sf)))


@query("importance_summary_all", f"""
SELECT feature, {r4("coalesce(a, 0)", "model_a")}, {r4("coalesce(b, 0)", "model_b")}, {r4("coalesce(c, 0)", "model_c")}, {r4("(coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0)) / 3", "avg_importance")}
FROM (SELECT event_type AS feature, avg(value) FILTER (k % 3 = 0) AS a, avg(value) FILTER (k % 3 = 1) AS b, avg(value) FILTER (k % 3 = 2) AS c
FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INT) AS k FROM events) GROUP BY event_type)""")
def importance_summary_all(spark, sf):
    """The same; the name stays for those who know it."""
    return importance_summary(spark, sf)


# ---------------------------------------------------------------- fitted models: rows and invariants


def _metric_rows(spark, name, metrics):
    return rounded(spark.createDataFrame([(name, k, float(v)) for k, v in metrics.items() if v is not None], "model string, metric string, value double"))


def _trained_rows(spark, trained, test):
    """Metrics on the test customers, and the mean and deviation of the cross-validated AUC."""
    _, mean, deviation, _ = D.cv_summary(trained.name, trained.cv_scores)
    return _metric_rows(spark, trained.name, trained.metrics(test) | {"cv_auc_mean": mean, "cv_auc_std": deviation})


@query("fit_logistic")
def fit_logistic(spark, sf):
    train, _ = train_test(spark, sf)
    trained = D.fit_logistic(train, INPUTS, "customer_id", tune=True)
    return rounded(D.coefficient_table(trained, spark))


@query("fit_decision_tree")
def fit_decision_tree(spark, sf):
    train, test = train_test(spark, sf)
    return _trained_rows(spark, D.fit_decision_tree(train, INPUTS, "customer_id", tune=True), test)


@query("fit_naive_bayes")
def fit_naive_bayes(spark, sf):
    """The three variants, each calibrated; predictions of all test customers."""
    train, test = train_test(spark, sf)
    out = None
    for kind in ("gaussian", "bernoulli", "multinomial"):
        model = D.fit_naive_bayes(D.naive_bayes_frame(train, kind), "customer_id", kind)
        part = model.transform(D.naive_bayes_frame(test, kind)).select("customer_id", F.lit(kind).alias("kind"), "prediction", "score")
        out = part if out is None else out.unionByName(part)
    return rounded(out)


@query("calibrate_sigmoid")
def calibrate_sigmoid(spark, sf):
    train, test = train_test(spark, sf)
    model = D.calibrate_sigmoid(lambda: NaiveBayes(modelType="gaussian"), train, "customer_id")
    return rounded(model.transform(test).select("customer_id", "label", "prediction", "score"))


@query("fit_linear_svm")
def fit_linear_svm(spark, sf):
    train, test = train_test(spark, sf)
    return _trained_rows(spark, D.fit_linear_svm(train, INPUTS, "customer_id", tune=True), test)


@query("fit_random_forest")
def fit_random_forest(spark, sf):
    train, test = train_test(spark, sf)
    return _trained_rows(spark, D.fit_random_forest(train, INPUTS, "customer_id"), test)


@query("fit_gradient_boosting")
def fit_gradient_boosting(spark, sf):
    data = frame(spark, sf)
    train, held, test = (data.where(F.col("split") == s) for s in ("train", "val", "test"))
    return _trained_rows(spark, D.fit_gradient_boosting(train, INPUTS, "customer_id", held), test)


@query("hyperparameter_search")
def hyperparameter_search(spark, sf):
    train, _ = train_test(spark, sf)
    estimator = DecisionTreeClassifier(weightCol="weight", seed=42)
    grid = D.param_grid(estimator, {"maxDepth": [2, 4, 6], "minInstancesPerNode": [1, 10], "impurity": ["gini", "entropy"]})
    return rounded(D.hyperparameter_search(estimator, grid, train, "customer_id")[2])


@query("cross_val_auc")
def cross_val_auc(spark, sf):
    scores = D.cross_val_auc(lambda: LogisticRegression(maxIter=50, weightCol="weight"), frame(spark, sf), "customer_id")
    name, mean, std, each = D.cv_summary("logistic_regression", scores)
    return rounded(spark.createDataFrame([(name, i, s, mean, std) for i, s in enumerate(each)], "model string, fold int, auc double, auc_mean double, auc_std double"))


@query("compare_models")
def compare_models(spark, sf):
    train, test = train_test(spark, sf)
    models = [
        D.fit_logistic(train, INPUTS, "customer_id"), D.fit_decision_tree(train, INPUTS, "customer_id"),
        D.train_naive_bayes(train, INPUTS, "customer_id"), D.fit_neighbours(train, INPUTS, "customer_id"),
    ]
    return rounded(D.compare_models(models, test))


@query("model_save_load")
def model_save_load(spark, sf):
    """Predictions of the stored and reloaded model."""
    train, test = train_test(spark, sf)
    trained = D.fit_logistic(train, INPUTS, "customer_id", cross_validate=False)
    path = workspace(spark)
    D.save_models({trained.name: trained.model}, path)
    loaded = D.load_model(f"{path}/{trained.name}")
    return rounded(D.with_score(loaded.transform(test)).select("customer_id", "prediction", "score"))
