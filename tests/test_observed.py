"""Fitted models in a session that has run an Observation: such a session cannot go to the tasks, nor may a model that holds it."""

import pytest
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as entry
from custoria.operators import balancing as B
from custoria.operators import models as D
from custoria.operators import selection as S
from custoria.operators.fitting import fitted

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).count()
    assert seen.get == {"n": 3}
    rows = [(i, int(i % 3 == 0), float(i % 3 == 0) + i % 7 / 4, float(i * 37 % 101), float(i * 53 % 89)) for i in range(120)]
    return spark.createDataFrame(rows, "id long, label int, a double, b double, c double").coalesce(1).cache()


@pytest.fixture(scope="module")
def data(table):
    return D.training_frame(table, COLUMNS, "label", "id").cache()


def test_rfe_cv_after_an_observation(table):
    chosen, ranking, scores = S.select_rfe_cv(table, "label", "id", COLUMNS, n_features=2, folds=2, trees=3)
    assert "a" in chosen and set(ranking) == set(COLUMNS) and [n for n, _ in scores] == [3, 2]


def test_ensemble_vote_after_an_observation(table):
    votes = S.select_ensemble_vote(table, "label", "id", COLUMNS, 1, trees=3, folds=2).collect()
    assert [(r["feature"], r["votes"]) for r in votes] == [("a", 4)]


def test_permutation_of_a_given_model_after_an_observation(table):
    model = LogisticRegression().fit(S.assemble(table, COLUMNS, "label"))
    got = S.permutation_importance(table, "label", "id", COLUMNS, model)
    assert max(got, key=got.get) == "a"


def test_balance_cv_after_an_observation(table):
    points = table.select("id", "label", F.array(*COLUMNS).alias("features"))
    rows = B.balance_cv(points, ["undersample"], folds=2, trees=3).collect()
    assert [r["best_method"] for r in rows] == ["undersample"] and 0.5 < rows[0]["auc_mean"] <= 1


def test_logistic_after_an_observation(data):
    trained = D.fit_logistic(data, COLUMNS, "id", tune=True, folds=2, strengths=[1.0], mixes=[])
    assert len(trained.cv_scores) == 2 and min(trained.cv_scores) > 0.5
    assert max(trained.importances(), key=lambda c: abs(trained.importances()[c])) == "a"


def test_naive_bayes_after_an_observation(data):
    scores = [r["score"] for r in D.fit_naive_bayes(data, "id", folds=2).transform(data).select("score").collect()]
    assert len(scores) == 120 and all(0 <= s <= 1 for s in scores)


def test_calibration_after_an_observation(data):
    for build in (lambda: NaiveBayes(modelType="gaussian"), lambda: LogisticRegression(weightCol="weight")):
        scores = [r["score"] for r in D.calibrate_sigmoid(build, data, "id", 2).transform(data).select("score").collect()]
        assert len(scores) == 120 and all(0 <= s <= 1 for s in scores)


def test_forest_after_an_observation(data):
    trained = D.fit_random_forest(data, COLUMNS, "id", folds=2, trees=3, depth=3)
    assert len(trained.cv_scores) == 2 and trained.metrics(data)["auc_roc"] > 0.8 and set(trained.importances()) == set(COLUMNS)


def test_cross_validation_after_an_observation(data):
    scores = D.cross_val_auc(lambda: LogisticRegression(weightCol="weight"), data, "id", 2)
    assert len(scores) == 2 and min(scores) > 0.5


def test_comparison_after_an_observation(data):
    svm = D.fit_linear_svm(data, COLUMNS, "id", cross_validate=False)
    models = [D.fit_logistic(data, COLUMNS, "id", folds=2), svm, D.train_naive_bayes(data, COLUMNS, "id", folds=2)]
    rows = D.compare_models(models, data).collect()
    assert {r["model"] for r in rows} == {m.name for m in models} and [r["model"] for r in rows if r["cv_auc_mean"] is None] == [svm.name]


def test_a_fitted_model_predicts_as_before_and_has_no_summary(spark, table):
    rows = VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(table)
    whole = LogisticRegression().fit(rows)
    alone = fitted(LogisticRegression(), rows)
    assert whole.hasSummary and not alone.hasSummary
    assert (alone.coefficients, alone.intercept) == (whole.coefficients, whole.intercept)
    assert alone.transform(rows).select(vector_to_array("probability")[1]).count() == 120


def test_naive_bayes_query_after_an_observation(spark, table, small):
    rows = entry.queries()["fit_naive_bayes"](spark, small).collect()
    kinds = {r["customer_id"]: set() for r in rows}
    for r in rows:
        kinds[r["customer_id"]].add(r["kind"])
        assert 0 <= r["score"] <= 1 and r["prediction"] in (0, 1)
    assert len(rows) == 3 * len(kinds) > 0 and all(k == {"gaussian", "bernoulli", "multinomial"} for k in kinds.values())


def test_cross_validation_query_after_an_observation(spark, table, small):
    rows = sorted(entry.queries()["cross_val_auc"](spark, small).collect(), key=lambda r: r["fold"])
    assert [r["fold"] for r in rows] == list(range(5)) and all(0 <= r["auc"] <= 1 for r in rows)
    assert rows[0]["auc_mean"] == pytest.approx(sum(r["auc"] for r in rows) / 5, abs=1e-4)
