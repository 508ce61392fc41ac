"""Small hand-made frames for the places where pandas, Spark and SQL differ."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from custoria import constants as K
from custoria.functions import columns as X
from custoria.functions.distributions import chi_square_tail, t_two_sided
from custoria.functions.quantiles import aggregate_with_medians, exact_quantiles
from custoria.functions.ranking import attach_percent_ranks, row_positions, running_totals
from custoria.operators import cleaning as C
from custoria.operators import features as FX
from custoria.operators import scores as S


def values(df, column):
    return [r[column] for r in df.select(column).collect()]


def test_one_purchase_gives_infinite_frequency_until_filled(spark):
    df = spark.sql("SELECT 'a' customer_id, 't' transaction_id, 10.0D total_amount, TIMESTAMP_NTZ '2024-01-05' transaction_date")
    block = FX.transaction_features(df, "2024-02-01")
    row = block.first()
    assert row["purchase_frequency"] == math.inf and row["transaction_value_std"] is None
    filled = FX.fill_feature_nulls(block).first()
    assert filled["purchase_frequency"] == 0.0 and filled["transaction_value_std"] == 0.0


def test_null_keys_are_dropped_by_groups_and_kept_by_left_joins(spark):
    df = spark.createDataFrame([("a", "t1", 1.0), (None, "t2", 2.0)], "customer_id string, transaction_id string, total_amount double")
    df = df.withColumn("transaction_date", X.instant("2024-01-01"))
    assert values(FX.transaction_features(df, "2024-02-01"), "customer_id") == ["a"]
    base = spark.createDataFrame([("a",), (None,), ("b",)], "customer_id string")
    joined = FX.join_features(base, FX.transaction_features(df, "2024-02-01"))
    assert joined.count() == 3 and joined.where("total_spent is not null").count() == 1


def test_tied_quantile_edges_do_not_fail(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 1.0, 1.0, 1.0, 5.0])], "id int, total_spent double")
    got = {r["id"]: r["value_segment"] for r in S.value_segment(df).collect()}
    assert got == {0: "Low Value", 1: "Low Value", 2: "Low Value", 3: "Low Value", 4: "VIP"}


def test_quartile_label_keeps_nulls(spark):
    df = spark.createDataFrame([(None,), (1.0,), (2.0,), (3.0,), (4.0,)], "total_spent double")
    assert {r["total_spent"]: r["value_segment"] for r in S.value_segment(df).collect()}[None] is None


@pytest.mark.parametrize("bins", [4, 5])
def test_rank_bins_equal_pandas_qcut(spark, bins):
    for n in (1, 2, 3, 7, 23, 100):
        got = [r[0] for r in spark.range(1, n + 1).select(X.rank_bin(F.col("id"), n, bins)).collect()]
        want = [1] if n == 1 else list(pd.qcut(pd.Series(range(1, n + 1)), bins, labels=False) + 1)
        assert got == want, n


def test_value_bins_equal_pandas_qcut(spark):
    draw = random.Random(7)
    data = [round(draw.expovariate(1), 3) for _ in range(301)]
    df = spark.createDataFrame([(v,) for v in data], "v double")
    edges = exact_quantiles(df, {"v": S.QUINTILES})["v"]
    got = [r[0] for r in df.orderBy("v").select(X.quantile_bin(F.col("v"), edges)).collect()]
    assert got == list(pd.qcut(pd.Series(sorted(data)), 5, labels=False) + 1)


def test_fixed_bins_are_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 25.0, 26.0, 100.0, 101.0, None)], "age double")
    assert values(C.age_group(df), "age_group") == [None, "18-25", "26-35", "65+", None, None]


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("n", None)], "k string, c string")
    got = {r["k"]: r["m"] for r in df.groupBy("k").agg(FX.most_frequent("c").alias("m")).collect()}
    assert got == {"k": "a", "n": "Unknown"}


def test_days_are_elapsed_days(spark):
    days = lambda a, b: spark.range(1).select(X.elapsed_days(X.instant(a), X.instant(b))).first()[0]
    assert days("2024-01-01 23:00:00", "2024-01-02 01:00:00") == 0
    assert days("2024-01-02 01:00:00", "2024-01-01 23:00:00") == -1
    assert days("2024-01-03 00:00:00", "2024-01-01 00:00:00") == -2
    assert days("2024-01-01", "2024-01-31") == 30


def test_unknown_age_survives_the_range_rule(spark):
    df = spark.createDataFrame([(v,) for v in (17.0, 18.0, 100.0, 101.0, None)], "age double")
    assert values(C.filter_age_range(df), "age") == [18.0, 100.0, None]


def test_sum_of_only_nulls_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0)], "k string, v double")
    assert dict(df.groupBy("k").agg(FX.sum_or_zero(F.col("v"))).collect()) == {"a": 0.0, "b": 1.0}


def test_moments_are_bias_adjusted(spark):
    data = [1.0, 2.0, 3.0, 10.0, 4.5]
    row = spark.createDataFrame([(v,) for v in data], "v double").agg(X.adjusted_skewness("v"), X.adjusted_kurtosis("v")).first()
    assert row[0] == pytest.approx(pd.Series(data).skew()) and row[1] == pytest.approx(pd.Series(data).kurtosis())
    short = spark.createDataFrame([(1.0,), (2.0,)], "v double").agg(X.adjusted_skewness("v"), X.adjusted_kurtosis("v")).first()
    assert tuple(short) == (None, None)


def test_bad_casts_become_null(spark):
    df = spark.createDataFrame([("x", "2024-13-01"), ("5", "2024-02-01")], "a string, d string")
    got = C.fix_types(df, {"a": "double", "d": "timestamp_ntz", "absent": "int"}).orderBy("a").collect()
    assert got[0]["a"] is None and got[0]["d"] is None and got[1]["a"] == 5.0 and got[1]["d"].month == 2


def test_empty_marketing_keeps_its_columns(spark):
    empty = spark.createDataFrame([], "campaign_id string, customer_id string, campaign_date timestamp_ntz, opened int, clicked int, converted int")
    block = FX.marketing_features(C.clean_marketing(empty))
    assert block.count() == 0 and "marketing_engagement_score" in block.columns


def test_percent_ranks_equal_pandas(spark):
    data = [3.0, 1.0, 3.0, None, 2.0, math.inf, 1.0]
    df = spark.createDataFrame(list(enumerate(data)), "id int, v double")
    want = pd.Series(data).rank(pct=True)
    for bound in (1_000_000, 2):
        got = {r["id"]: r["r"] for r in attach_percent_ranks(df, {"v": "r"}, bound).collect()}
        for i, w in enumerate(want):
            assert got[i] is None if math.isnan(w) else got[i] == pytest.approx(w)


def test_gender_spellings(spark):
    df = spark.createDataFrame([(g,) for g in ("Male", "f", "OTHER", "O", None)], "gender string")
    assert values(C.standardize_categories(df), "gender") == ["M", "F", "Other", "Unknown", "Unknown"]


def test_segment_codes():
    codes = [c for codes in K.RFM_SEGMENTS.values() for c in codes.split()]
    assert len(codes) == len(set(codes)) == 70


def test_tail_probabilities():
    assert chi_square_tail(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-10)
    assert chi_square_tail(18.307038053275146, 10) == pytest.approx(0.05, abs=1e-10)
    assert chi_square_tail(0.5, 4) == pytest.approx(math.exp(-0.25) * 1.25, abs=1e-12)
    assert t_two_sided(12.706204736174698, 1) == pytest.approx(0.05, abs=1e-9)
    assert t_two_sided(2.2281388519649385, 10) == pytest.approx(0.05, abs=1e-9)
    assert t_two_sided(0.0, 5) == pytest.approx(1.0)


# ---------------------------------------------------------------- the paths for data beyond the bounds


def skewed(n=6000, seed=3):
    """A third of the rows in one group and a third of the values equal."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{draw.randrange(300)}"
        value = 7.0 if draw.random() < 0.33 else round(draw.gauss(0, 100), 4)
        rows.append((i, key, None if draw.random() < 0.02 else value))
    return rows


@pytest.mark.parametrize("shape", ["mixed", "equal", "spread"])
def test_bracketed_quantiles_equal_numpy(spark, shape):
    data = {"mixed": [r[2] for r in skewed()], "equal": [5.0] * 3000 + [6.0] * 3000, "spread": [float(i * i % 10007) for i in range(6000)]}[shape]
    df = spark.createDataFrame([(v,) for v in data], "v double")
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    want = np.quantile([v for v in data if v is not None], probabilities)
    assert exact_quantiles(df, {"v": probabilities}, bounded_rows=100)["v"] == pytest.approx(list(want))


def test_hot_group_medians_equal_pandas(spark):
    rows = skewed()
    df = spark.createDataFrame(rows, "id int, k string, v double")
    want = pd.DataFrame(rows, columns=["id", "k", "v"]).groupby("k")["v"].median()
    got = aggregate_with_medians(df, ["k"], [F.count("*").alias("n")], {"m": "v"}, bounded_rows=500).collect()
    assert len(got) == len(want) and all(r["m"] == pytest.approx(want[r["k"]]) for r in got)
    assert sum(r["n"] for r in got) == len(rows)


def test_range_partitioned_positions_and_totals(spark):
    df = spark.createDataFrame(skewed(), "id int, k string, v double").where("v is not null")
    got = row_positions(df.repartition(5), ["v", "id"], bounded_rows=100).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(1, len(got) + 1))
    assert [(r["v"], r["id"]) for r in got] == sorted((r["v"], r["id"]) for r in got)
    grouped = df.groupBy("k", "v").agg(F.count("*").alias("n"))
    a = {(r["k"], r["v"]): r["run_n"] for r in running_totals(grouped, ["v"], ["n"], ["k"], bounded_rows=50).collect()}
    b = {(r["k"], r["v"]): r["run_n"] for r in running_totals(grouped, ["v"], ["n"], ["k"]).collect()}
    assert a == b


def test_rfm_scores_do_not_depend_on_the_path(spark):
    rows = [(str(i), i * 7 % 400, 1 + i % 3, float(i * 13 % 1000)) for i in range(900)]
    df = spark.createDataFrame(rows, "customer_id string, recency bigint, frequency bigint, monetary double")
    assert sorted(S.rfm_scores(df, 100).collect()) == sorted(S.rfm_scores(df).collect())


def test_registered_calls_do_the_whole_job(spark, small):
    import inspect
    import re

    import __spark_entry__ as entry

    queries = entry.queries()
    for name in (
        "fit_random_forest", "fit_gradient_boosting", "fit_logistic", "fit_decision_tree", "fit_linear_svm", "hyperparameter_search", "cross_val_auc", "compare_models",
        "select_rfe_cv", "select_permutation", "select_forest_importance", "select_ensemble_vote", "balance_cv",
    ):
        assert not re.search(r"\b(trees|depth|rounds|folds|drop_share|strengths|mixes|methods|cross_validate|trials)=", inspect.getsource(queries[name])), name
    assert queries["validation_summary_all"](spark, small).count() == queries["validation_gate_all"](spark, small).count() == 4
    assert all({"p_value", "significant"} <= set(queries[q](spark, small).columns) for q in ("eda_chi_square_all", "eda_t_test_all"))
