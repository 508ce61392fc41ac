"""Invariants of validation, scaling, selection, balancing and models."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from custoria.operators import balancing as B
from custoria.operators import cleaning as C
from custoria.operators import encoding as N
from custoria.operators import exploration as E
from custoria.operators import metrics as M
from custoria.operators import models as D
from custoria.operators import neighbours as NN
from custoria.operators import scaling as Z
from custoria.operators import selection as L
from custoria.operators import split as P
from custoria.operators import validation as Q
from custoria.plans import stages
from custoria.session import workspace
from custoria.sources import sinks

AS_OF = "2024-06-01"


@pytest.fixture(scope="module")
def people(spark):
    draw = random.Random(1)
    rows = [
        (f"CUST_{i:05d}", 20 + draw.randrange(60), draw.choice("MF"), draw.choice(["CA", "TX", "NY"]), draw.choice(["Premium", "Basic", "Trial"]), int(draw.random() < 0.25))
        for i in range(1200)
    ]
    df = spark.createDataFrame(rows, "customer_id string, age int, gender string, state string, customer_segment string, churned int")
    return df.withColumn("registration_date", F.expr("TIMESTAMP_NTZ '2022-01-01' + make_interval(0, 0, 0, age))"[:-1]))


@pytest.fixture(scope="module")
def clusters(spark):
    """Nine to one, overlapping."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(500):
        y = int(i % 10 == 0)
        rows.append((i, [float(v) for v in rng.normal(1.4 * y, 1.0, 4)], y))
    return spark.createDataFrame(rows, "id bigint, features array<double>, label int").cache()


def names(checks, passed=None):
    return {r["check_name"] for r in checks.collect() if passed is None or r["passed"] == passed}


# ---------------------------------------------------------------- validation


def test_missing_duplicates_and_bad_ages_are_found(spark, people):
    holes = people.withColumn("age", F.when(F.col("customer_id") < "CUST_00100", None).otherwise(F.col("age")))
    assert any("missing" in n for n in names(Q.validate({"customers": holes}, AS_OF), False))
    twice = people.union(people.limit(50))
    found = names(Q.validate({"customers": twice}, AS_OF), False)
    assert {"duplicate_rows", "duplicate_primary_key_customer_id"} <= found
    old = people.withColumn("age", F.when(F.col("customer_id") < "CUST_00010", 150).otherwise(F.col("age")))
    assert "age_range" in names(Q.validate({"customers": old}, AS_OF), False)


def test_empty_frames(spark, people):
    none = people.limit(0)
    rows = {r["dataset"]: r for r in Q.validate({"customers": none, "marketing": none}, AS_OF, ["check_size"]).collect()}
    assert rows["customers"]["severity"] == "error" and rows["marketing"]["severity"] == "warning"
    gate = Q.validation_gate(Q.validation_summary(Q.validate({"customers": none, "marketing": none}, AS_OF, ["check_size"])))
    assert {r["dataset"]: r["accepted"] for r in gate.collect()} == {"customers": False, "marketing": True}


def test_all_checks_pass_clean_data(people):
    summary = Q.validation_summary(Q.validate({"customers": people}, AS_OF)).first()
    assert summary["is_valid"] and summary["errors"] == 0


# ---------------------------------------------------------------- cleaning and stages


def test_global_imputation(spark):
    rows = [(1, 2.0, "b", 1), (2, None, "a", 2), (3, 4.0, None, None), (4, 9.0, "b", 4), (5, 1.0, "a", 3)]
    df = spark.createDataFrame(rows, "id int, x double, c string, n int")
    got = {r["id"]: r for r in C.impute_global(df).collect()}
    assert got[2]["x"] == 3.0 and got[3]["c"] == "a" and got[3]["n"] == 2.5


def test_master_keeps_every_customer(spark, people):
    sales = people.select(
        F.concat("customer_id", F.lit("-1")).alias("transaction_id"), "customer_id", F.col("registration_date").alias("transaction_date"),
        F.col("age").cast("double").alias("total_amount"),
    ).where("age < 50")
    out = stages.master_features({"customers": people, "transactions": sales}, AS_OF)
    assert out.count() == people.count() and len(out.columns) > len(people.columns)
    assert {"engagement_level", "rfm_segment", "value_segment"} <= set(out.columns)


def test_stage_round_trip(spark, people):
    root = workspace(spark)
    sinks.save_stage({"people": people}, root, "raw")
    back = sinks.load_stage(spark, root, "raw", ["people"])["people"]
    assert sorted(back.collect()) == sorted(people.collect())


def test_stages_run_and_resume(spark, people, monkeypatch):
    sales = people.select(
        F.concat("customer_id", F.lit("-1")).alias("transaction_id"), "customer_id", F.col("registration_date").alias("transaction_date"),
        F.col("age").cast("double").alias("total_amount"),
    )
    raw, root = {"customers": people, "transactions": sales}, workspace(spark)
    first = stages.run_stages(raw, AS_OF, root)
    assert list(first) == ["collected", "cleaned", "validated", "features", "explored", "prepared"]
    assert first["prepared"]["train"].count() + first["prepared"]["val"].count() + first["prepared"]["test"].count() == people.count()
    test_rows = sorted(first["prepared"]["test"].select("customer_id").collect())
    best = first["features"]["importance"].orderBy(F.desc("importance"), "feature").first()["feature"]
    assert spark.read.option("header", True).csv(f"{root}/features/importance_csv").first()["feature"] == best
    ids = {s: sinks.stage_manifest(spark, root, s).id for s in first}

    # a stage that breaks midway is not taken for finished
    explore = stages.explore
    monkeypatch.setattr(stages, "explore", lambda master, label: {"overview": explore(master, label)["overview"], "broken": master.select(F.raise_error(F.lit("stop")).alias("x"))})
    with pytest.raises(Exception, match="stop"):
        stages.run_stages(raw, AS_OF, root, resume_from="explored")
    assert sinks.stage_manifest(spark, root, "explored") is None
    monkeypatch.setattr(stages, "explore", explore)
    again = stages.run_stages(raw, AS_OF, root, resume_from="prepared")
    assert sorted(again["prepared"]["test"].select("customer_id").collect()) == test_rows
    now = {s: sinks.stage_manifest(spark, root, s).id for s in first}
    assert {s for s in first if now[s] != ids[s]} == {"explored", "prepared"}

    # other parameters, and a table with other rows, lead to another run of what is built from them
    sinks.write_parquet(first["validated"]["gate"].limit(0), f"{root}/validated/gate")
    stages.run_stages(raw, AS_OF, root, resume_from="prepared", label="no_such_column")
    last = {s: sinks.stage_manifest(spark, root, s).id for s in first}
    assert {s for s in first if last[s] != now[s]} == {"validated", "features", "explored", "prepared"}
    assert sinks.stage_manifest(spark, root, "prepared").rows == {"features": people.count()}


def test_collection_checks_its_tables(spark, people):
    with pytest.raises(ValueError, match="registration_date"):
        stages.collect_all({"customers": people.drop("registration_date")})
    twice = people.drop("churned").unionByName(people.drop("churned"))
    got = stages.collect_all({"customers": twice})["customers"]
    assert got.count() == people.count() and got.where("churned = 0").count() == people.count()
    day = "timestamp_ntz'2024-01-01 00:00:00'"
    sales = spark.sql(f"SELECT * FROM VALUES ('a', {day}, 5.0, 'completed'), ('a', {day}, 0.0, 'completed'), ('b', {day}, 5.0, 'failed'), (null, {day}, 5.0, 'completed') AS t(customer_id, transaction_date, total_amount, transaction_status)")
    assert stages.collect_all({"transactions": sales})["transactions"].count() == 1
    assert stages.collect_all({"transactions": sales}, ("2024-02-01", "2024-03-01"))["transactions"].count() == 0


# ---------------------------------------------------------------- split, scaling, encoding


@pytest.mark.parametrize("bound", [1_000_000, 100])
def test_split_is_exact_disjoint_and_stable(people, bound):
    parts = P.split_stratified(people, "churned", "customer_id", few_rows=bound)
    counts = {(r["split"], r["churned"]): r["count"] for r in parts.groupBy("split", "churned").count().collect()}
    for y in (0, 1):
        n = people.where(F.col("churned") == y).count()
        assert counts[("train", y)] == int(n * 0.7 + 0.5) and sum(counts[(s, y)] for s in ("train", "val", "test")) == n
    again = P.split_stratified(people.repartition(7), "churned", "customer_id")
    assert sorted(parts.select("customer_id", "split").collect()) == sorted(again.select("customer_id", "split").collect())


def test_quantile_scores_are_normal_and_monotone(spark):
    df = spark.createDataFrame([(float(i) ** 3,) for i in range(2000)], "v double")
    out = Z.apply(df.withColumn("raw", F.col("v")), Z.fit(df, ["v"], "quantile"), "quantile").orderBy("raw").toPandas()["v"]
    assert out.is_monotonic_increasing and abs(out.mean()) < 0.01 and abs(out.std() - 1) < 0.05
    assert Z.normal_quantile(np.array([0.025, 0.5, 0.975, 1e-7])) == pytest.approx([-1.959963984540054, 0, 1.959963984540054, -5.199337582192817])


def test_power_of_greatest_likelihood(spark):
    data = np.random.default_rng(2).lognormal(0, 0.7, 800) - 0.5
    df = spark.createDataFrame([(float(v),) for v in data], "v double")
    found = Z.fit(df, ["v"], "power")["v"]

    def likelihood(p):
        t = np.where(data >= 0, np.log1p(np.maximum(data, 0)) if p == 0 else ((np.maximum(data, 0) + 1) ** p - 1) / p,
                     -np.log1p(-np.minimum(data, 0)) if p == 2 else -((1 - np.minimum(data, 0)) ** (2 - p) - 1) / (2 - p))
        return -len(data) / 2 * np.log(t.var()) + (p - 1) * (np.sign(data) * np.log1p(np.abs(data))).sum()

    grid = np.arange(-3, 3, 0.001)
    best = grid[np.argmax([likelihood(p) for p in grid])]
    assert found["power"] == pytest.approx(best, abs=0.01)
    scaled = Z.apply(df, {"v": found}, "power").toPandas()["v"]
    assert abs(scaled.mean()) < 1e-9 and scaled.std(ddof=0) == pytest.approx(1)


def test_scaling_survives_saving(spark, people):
    data = people.drop("registration_date")
    fitted, path = Z.fit_auto(data, "churned"), workspace(spark)
    fitted.save(spark, path)
    loaded = Z.FittedScaling.load(spark, path)
    assert sorted(loaded.transform(data).collect()) == sorted(fitted.transform(data).collect())
    assert set(fitted.transform(data).columns) == set(fitted.feature_names())


def test_target_encoding_fits_on_the_training_rows(spark):
    rows = [("a", 1)] * 30 + [("a", 0)] * 10 + [("b", 1)] + [("c", 0)] * 5
    df = spark.createDataFrame(rows, "c string, y int")
    train = df.where("c <> 'c'")
    got = {r["c"]: r["c_target_encoded"] for r in N.encode_target(df, "c", "y", fit_on=train).distinct().collect()}
    prior = 31 / 41
    weight = 1 / (1 + np.exp(-(40 - 20) / 10))
    assert got["a"] == pytest.approx(prior * (1 - weight) + 0.75 * weight)
    assert got["b"] == pytest.approx(prior) and got["c"] == pytest.approx(prior)


# ---------------------------------------------------------------- statistics


def test_two_by_two_chi_square_uses_the_continuity_correction(spark):
    rows = [("a", 0)] * 10 + [("a", 1)] * 20 + [("b", 0)] * 30 + [("b", 1)] * 15
    row = E.chi_square_tests(spark.createDataFrame(rows, "c string, y int"), "y").first()
    table = np.array([[10, 20], [30, 15]])
    expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / table.sum()
    assert row["chi2_statistic"] == pytest.approx((((abs(table - expected) - 0.5) ** 2) / expected).sum())
    assert row["degrees_of_freedom"] == 1 and row["significant"]


def test_correlations_of_any_width(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(400, 35))
    data[:, 1] = data[:, 0] * 2
    data[:, 2], data[:, 3] = 5.0, data[:, 3] + 1e6
    data[rng.random(400) < 0.1, 4] = np.nan
    pdf = pd.DataFrame(data, columns=[f"c{i}" for i in range(35)])
    from custoria.operators.profiles import correlation_table

    df = spark.createDataFrame(pdf).repartition(5).withColumn("c5", F.when(F.col("c6") > -1, F.col("c5")))
    pdf["c5"] = pdf.c5.where(pdf.c6 > -1)
    want = pdf.corr()
    for columns in (list(pdf.columns), list(pdf.columns)[:8]):
        for (a, b), r in correlation_table(df, columns).items():
            assert r is None if np.isnan(want.loc[a, b]) else r == pytest.approx(want.loc[a, b], abs=1e-9)


def test_auc_with_ties_does_not_depend_on_the_path(spark):
    draw = random.Random(4)
    rows = [(draw.randrange(2), float(draw.randrange(30))) for _ in range(700)]
    df = spark.createDataFrame(rows, "y int, s double")
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert M.roc_auc(df, "y", "s").first()[0] == pytest.approx(want)
    assert M.roc_auc(df, "y", "s", bounded_rows=5).first()[0] == pytest.approx(want)


# ---------------------------------------------------------------- neighbours


def brute(points, k, queries=None):
    queries, out = queries or points, {}
    for i, x in queries.items():
        ranked = sorted((float(np.sqrt(((x - y) ** 2).sum())), j) for j, y in points.items() if j != i)
        out[i] = [j for _, j in ranked[:k]]
    return out


@pytest.mark.parametrize("cell_rows,chunk", [(10_000, 2048), (40, 2048), (25, 16)])
def test_neighbours_equal_brute_force(spark, monkeypatch, cell_rows, chunk):
    """One cell, many cells, and many chunks per cell; a third of the points are copies of one."""
    monkeypatch.setattr(NN, "CHUNK_ROWS", chunk)
    rng = np.random.default_rng(8)
    points = {i: np.array([1.0, 2.0, 3.0]) if i % 3 == 0 else rng.normal(size=3) * 4 for i in range(600)}
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in points.items()], "id bigint, features array<double>")
    found = NN.nearest(df, df, 4, exclude_self=True, cell_rows=cell_rows).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["id"], r["rank"])):
        got.setdefault(r["id"], []).append(r["neighbour"])
    assert got == brute(points, 4)


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_queries_that_ask_many_chunks_are_not_shuffled_to_them(spark, monkeypatch, broadcast):
    """Evenly spread points: copies of the queries for every chunk would fill the disks. Ties go to the smaller id, also across chunks."""
    monkeypatch.setattr(NN, "CHUNK_ROWS", 16)
    monkeypatch.setattr(NN, "FEW_NUMBERS", 0, raising=False)
    rng, rest, ask = np.random.default_rng(4), [], NN._ask
    monkeypatch.setattr(NN, "_ask", lambda *args: (rest.append(args[-1]), ask(*args))[1])
    points = {f"p{i}": rng.integers(0, 3, 9).astype(float) if i % 2 else rng.normal(size=9) + 1 for i in range(500)}
    df = spark.createDataFrame([(i, [float(v) for v in x], int(i[1:]) % 3) for i, x in points.items()], "id string, features array<double>, label int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        found = NN.nearest(df, df, 3, exclude_self=True, cell_rows=25, carry=["label"]).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    got = {}
    for r in sorted(found, key=lambda r: (r["id"], r["rank"])):
        assert r["neighbour_label"] == int(r["neighbour"][1:]) % 3
        got.setdefault(r["id"], []).append(r["neighbour"])
    assert got == brute(points, 3)
    assert rest == [False]


def test_fewer_candidates_than_neighbours(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id bigint, features array<double>")
    assert NN.nearest(df, df, 5, exclude_self=True).count() == 2
    assert NN.nearest(df, df.limit(0), 5).count() == 0


# ---------------------------------------------------------------- balancing


@pytest.mark.parametrize("method", ["smote", "adasyn"])
def test_oversampling_grows_the_minority_between_its_points(clusters, method):
    out = B.METHODS[method](clusters)
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts[0] == 450 and (counts[1] == 450 if method == "smote" else abs(counts[1] - 450) < 50)
    made = np.array([r["features"] for r in out.where("synthetic").collect()])
    real = np.array([r["features"] for r in clusters.where("label = 1").collect()])
    assert (made >= real.min(0) - 1e-9).all() and (made <= real.max(0) + 1e-9).all()
    assert out.select("id").distinct().count() == out.count()


def test_report_of_the_change(clusters):
    rows = {(r["stage"], r["class"]): r for r in B.distribution_change(clusters, B.undersample_random(clusters)).collect()}
    assert rows[("original", 0)]["imbalance_ratio"] == 9 and rows[("balanced", 0)]["imbalance_ratio"] == 1


def test_synthetic_rows_lie_on_a_segment_between_neighbours(clusters):
    real = {r["id"]: np.array(r["features"]) for r in clusters.where("label = 1").collect()}
    near = brute(real, 5)
    for r in B.oversample_smote(clusters).where("synthetic").collect():
        base = int(r["id"].split("#")[0])
        x, point = real[base], np.array(r["features"])
        gaps = [np.linalg.norm(point - x) + np.linalg.norm(point - real[j]) - np.linalg.norm(x - real[j]) for j in near[base]]
        assert min(gaps) < 1e-9


def test_borderline_starts_from_rows_in_danger(clusters):
    points = {r["id"]: (np.array(r["features"]), r["label"]) for r in clusters.collect()}
    near = brute({i: x for i, (x, _) in points.items()}, 10, {i: x for i, (x, y) in points.items() if y})
    foreign = {i: sum(points[j][1] == 0 for j in js) for i, js in near.items()}
    danger = {i for i, n in foreign.items() if 5 <= n < 10}
    bases = {int(r["id"].split("#")[0]) for r in B.oversample_borderline(clusters).where("synthetic").collect()}
    assert bases == danger


def test_mixed_rows_take_the_mode_of_the_neighbours(clusters):
    mixed = clusters.withColumn("kind", F.when(F.col("id") % 20 == 0, "x").otherwise("y"))
    out = B.oversample_smote_mixed(mixed, ["kind"])
    assert out.where("label = 1").count() == 450 and out.where("kind is null").count() == 0


def test_combined_cleaning_leaves_no_links(clusters):
    out = B.balance_combined(clusters)
    assert out.count() <= 900 and B.adaptive_method(9) == "adasyn" and B.adaptive_method(11) == "smote_tomek"
    assert B.adaptive_method(4) == "borderline" and B.adaptive_method(2) == "smote"


# ---------------------------------------------------------------- selection and models


@pytest.fixture(scope="module")
def frame(clusters):
    wide = clusters.select(F.col("id").cast("string").alias("id"), "label", *[F.col("features")[i].alias(f"x{i}") for i in range(4)])
    return wide.withColumn("noise", F.rand(1)).cache()


COLUMNS = ["x0", "x1", "x2", "x3", "noise"]


def test_model_based_selection_ranks_noise_last(frame):
    importance = L.permutation_importance(frame, "label", "id", COLUMNS, trees=15, depth=4)
    assert min(importance, key=importance.get) == "noise" or importance["noise"] < 0.02
    chosen, ranking, scores = L.select_rfe_cv(frame, "label", "id", COLUMNS, 2, folds=2, drop_share=0.3, trees=10)
    assert 2 <= len(chosen) <= 5 and set(ranking) == set(COLUMNS) and all(s > 0.5 for _, s in scores)
    assert "noise" not in L.select_k_best(frame, "label", 3, COLUMNS, "mutual_information")
    voted = [r["feature"] for r in L.select_ensemble_vote(frame, "label", "id", COLUMNS, 2, ("kbest", "forest"), trees=10).collect()]
    assert len(voted) == 2


def test_correlated_partner_goes(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=300)
    pdf = pd.DataFrame({"a": x, "b": 3 * x + rng.normal(size=300) * 0.01, "c": rng.normal(size=300)})
    kept, pairs = L.drop_correlated(spark.createDataFrame(pdf))
    assert kept == ["b", "c"] and pairs.first()["dropped"] == "a"


def test_models_beat_chance_and_survive_saving(spark, frame):
    data = D.training_frame(frame, COLUMNS, "label", "id").cache()
    logistic = D.fit_logistic(data, COLUMNS, "id", folds=2)
    forest = D.fit_random_forest(data, COLUMNS, "id", trees=10, depth=4, cross_validate=False)
    boosted = D.fit_gradient_boosting(data, COLUMNS, "id", data, rounds=5, depth=3, cross_validate=False)
    svm = D.fit_linear_svm(data, COLUMNS, "id", cross_validate=False)
    for model in (logistic, forest, boosted, svm):
        assert model.metrics(data)["auc_roc"] > 0.9
    table = D.compare_models([logistic, forest], data).collect()
    assert [r["auc_roc"] for r in table] == sorted((r["auc_roc"] for r in table), reverse=True)
    path = workspace(spark)
    D.save_models({"logistic": logistic.model}, path)
    again = D.with_score(D.load_model(f"{path}/logistic").transform(data)).select("id", "score")
    assert sorted(again.collect()) == sorted(logistic.predict(data).select("id", "score").collect())


def test_calibrated_scores_are_probabilities(frame):
    data = D.training_frame(frame, COLUMNS, "label", "id").cache()
    for kind in ("gaussian", "bernoulli", "multinomial"):
        ready = D.naive_bayes_frame(data, kind)
        scored = D.fit_naive_bayes(ready, "id", kind).transform(ready)
        row = scored.agg(F.min("score"), F.max("score")).first()
        assert 0 <= row[0] and row[1] <= 1
    assert M.roc_auc(scored, "label", "score").first()[0] > 0.5


def test_search_returns_a_candidate(frame):
    data = D.training_frame(frame, COLUMNS, "label", "id").cache()
    estimator = LogisticRegression(weightCol="weight")
    grid = D.random_grid(estimator, {"regParam": [0.0, 0.1, 1.0], "elasticNetParam": [0.0, 1.0]}, 3)
    model, params, table = D.hyperparameter_search(estimator, grid, data, "id", folds=2)
    assert len(grid) == 3 and table.count() == 3 and set(params) == {"regParam", "elasticNetParam"}
    assert D.random_grid(estimator, {"regParam": [0.0, 0.1, 1.0]}, 2) == D.random_grid(estimator, {"regParam": [0.0, 0.1, 1.0]}, 2)


def test_knn_votes(clusters):
    out = NN.predict_knn(clusters, clusters, 5, exclude_self=True)
    joined = out.join(clusters, "id")
    assert M.classification_metrics(joined, "label", "prediction").first()["accuracy"] > 0.9


def test_candidates_of_logistic_models_are_scored_without_storing_them(spark, monkeypatch):
    """The AUC of every candidate equals that of its models' own predictions, and only the last model is stored."""
    rng, stored, fold = np.random.default_rng(5), [], D.without_summary
    x = rng.normal(size=(120, 2))
    y = (x[:, 0] + rng.normal(size=120) > 0).astype(int)
    data = D.training_frame(spark.createDataFrame([(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y))], "id bigint, a double, b double, y int"), ["a", "b"], "y", "id")
    estimator = D.logistic(rows=120)
    grid = D.logistic_grid(estimator, 120, [0.01, 1.0], [0.5])
    plain = D.hyperparameter_search(estimator, grid, data, "id", folds=3, fit=lambda e, rows: fold(e.fit(rows), spark))[2].collect()
    monkeypatch.setattr("custoria.operators.fitting.without_summary", lambda m, s: (stored.append(m), fold(m, s))[1])
    found = D.hyperparameter_search(estimator, grid, data, "id", folds=3)[2].collect()
    assert len(found) == 6 and len(stored) == 1
    for a, b in zip(plain, found):
        assert a["parameters"] == b["parameters"] and abs(a["auc_mean"] - b["auc_mean"]) < 1e-12 and abs(a["auc_std"] - b["auc_std"]) < 1e-9


def _most_at_a_time(monkeypatch, module, name):
    """Wrap a function so that it says how many of its calls ran at a time."""
    import threading
    import time

    plain, lock, state = getattr(module, name), threading.Lock(), {"now": 0, "most": 0}

    def counted(*args, **kwargs):
        with lock:
            state["now"] += 1
            state["most"] = max(state["most"], state["now"])
        time.sleep(1)
        try:
            return plain(*args, **kwargs)
        finally:
            with lock:
                state["now"] -= 1

    monkeypatch.setattr(module, name, counted)
    return state


def test_methods_and_folds_are_balanced_side_by_side(clusters, monkeypatch):
    state = _most_at_a_time(monkeypatch, B, "fitted")
    out = {r["method"]: r for r in B.balance_cv(clusters, ["none", "undersample"], folds=3, trees=3).collect()}
    assert set(out) == {"none", "undersample"} and all(0.5 < r["auc_mean"] <= 1 and r["best_method"] in out for r in out.values())
    assert state["most"] > 1


@pytest.fixture
def asked_by_shuffle(monkeypatch):
    """Tiny chunks, and whether queries were shuffled to all the chunks that they ask."""
    rest, ask = [], NN._ask
    for name, value in (("CHUNK_ROWS", 16), ("CELL_ROWS", 25), ("FEW_NUMBERS", 0)):
        monkeypatch.setattr(NN, name, value, raising=False)
    monkeypatch.setattr(NN.nearest, "__defaults__", (False, 25, ()))
    monkeypatch.setattr(NN, "_ask", lambda *args: (rest.append(args[-1]), ask(*args))[1])
    return rest


def _even(spark, rows=300):
    """Evenly spread rows of two classes, and their ids by distance."""
    points = np.random.default_rng(6).normal(size=(rows, 9))
    df = spark.createDataFrame([(i, [float(v) for v in x], int(i % 5 == 0)) for i, x in enumerate(points)], "id bigint, features array<double>, label int")
    gap = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1)) + np.diag([np.inf] * rows)
    return df, np.argsort(gap, axis=1, kind="stable")


def test_tomek_links_of_evenly_spread_rows_shuffle_no_copies(spark, asked_by_shuffle):
    df, near = _even(spark)
    left = {r["id"] for r in B.undersample_tomek(df).collect()}
    linked = {i for i in range(300) if i % 5 and near[near[i, 0], 0] == i and near[i, 0] % 5 == 0}
    assert left == set(range(300)) - linked and asked_by_shuffle == [False]


def test_edited_neighbours_of_evenly_spread_rows_shuffle_no_copies(spark, asked_by_shuffle):
    df, near = _even(spark)
    left = {r["id"] for r in B.undersample_enn(df).collect()}
    mixed = {i for i in range(300) if i % 5 and any(j % 5 == 0 for j in near[i, :3])}
    assert left == set(range(300)) - mixed and asked_by_shuffle == [False]


def test_combined_balancing_of_evenly_spread_rows_shuffles_no_copies(spark, asked_by_shuffle):
    df, _ = _even(spark)
    out = B.balance_combined(df).collect()
    assert {r["label"] for r in out} == {0, 1} and 300 < len(out) <= 480
    assert asked_by_shuffle[-1] is False  # the search over the grown rows; the few minority rows may be shuffled
