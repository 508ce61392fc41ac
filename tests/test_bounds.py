"""Results do not depend on the size bounds: tiny bounds against the defaults, on data with NaN, nulls and ties."""

import os
import subprocess
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from custoria import session
from custoria.functions.quantiles import aggregate_with_medians, even_quantiles, exact_quantiles
from custoria.operators.balancing import undersample_random
from custoria.operators.exploration import numeric_profile
from custoria.operators.scaling import fit_quantile
from custoria.operators.split import with_folds

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"plain": rng.normal(size=2000), "ties": np.round(rng.normal(size=2000), 1), "flag": (rng.random(2000) > 0.4) * 1.0, "same": 5.0})
    pdf.loc[rng.random(2000) < 0.1, "plain"] = np.nan
    return pdf, spark.createDataFrame(pdf).repartition(5).withColumn("ties", F.when(F.col("ties") < 2, F.col("ties")))


@pytest.mark.parametrize("points", [2, 3, 100, 1000])
def test_even_grid(numbers, points):
    pdf, df = numbers
    want = {c: np.nanquantile(pdf[c].where(pdf[c] < 2) if c == "ties" else pdf[c], np.linspace(0, 1, points)) for c in pdf}
    for bound in (50, 10**6):
        got = even_quantiles(df, dict.fromkeys(pdf, points), bound)
        for c in pdf:
            assert got[c] == pytest.approx(want[c], abs=1e-9)


def test_quantile_scaling_has_one_grid(numbers):
    pdf, df = numbers
    small, large = fit_quantile(df, list(pdf), bounded_rows=10**6), fit_quantile(df, list(pdf), bounded_rows=60)
    for c in pdf:
        assert small[c]["grid"] == pytest.approx(large[c]["grid"], abs=1e-9)


def test_counts_with_nan_do_not_shift_ranks(numbers):
    pdf, df = numbers
    want = np.nanquantile(pdf["plain"], 0.25)
    for bound in (100, 10**6):
        assert exact_quantiles(df, {"plain": [0.25]}, bound, {"plain": 2000})["plain"][0] == pytest.approx(want)


def test_medians_of_hot_keys(spark):
    df = spark.createDataFrame([(k % 3, float(v)) for k in range(40) for v in range(2001 if k == 0 else 30)], "k int, v double")
    plain = {r.k: r.m for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    got = aggregate_with_medians(df, ["k"], [F.count("*").alias("n")], {"m": "v"}, 100).collect()
    assert {r.k: r.m for r in got} == plain


def test_rows_without_a_label_are_no_class(spark):
    df = spark.createDataFrame([(i, [1.0], None if i < 2 else int(i % 3 == 0)) for i in range(300)], "id long, features array<double>, label int")
    assert dict(undersample_random(df).groupBy("label").count().collect()) == {0: 99, 1: 99}
    assert undersample_random(df.where("label IS NULL")).count() == 0


def test_folds_have_every_class(spark):
    df = spark.createDataFrame([(i, int(i < 7)) for i in range(300)], "id long, label int")
    got = with_folds(df, "label", "id", 5).groupBy("fold").agg(F.count("*").alias("n"), F.sum("label").alias("y")).collect()
    assert sorted((r.fold, r.n, r.y) for r in got) == [(0, 59, 1), (1, 60, 1), (2, 60, 2), (3, 60, 1), (4, 61, 2)]
    with pytest.raises(ValueError):
        with_folds(df.where("id < 100 AND id > 3"), "label", "id", 5)


def test_all_columns_are_profiled(spark):
    df = spark.range(20).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(60)])
    assert numeric_profile(df).count() == 60


def test_tasks_need_no_copy_of_the_package():
    script = (
        f"import sys; sys.path.insert(0, {ROOT!r})\n"
        "from custoria.session import local_session\n"
        "spark = local_session(2, 2, '1g')\n"
        "from custoria.operators.neighbours import nearest\n"
        "df = spark.createDataFrame([(i, [float(i), 1.0], i % 2) for i in range(30)], 'id long, features array<double>, label int')\n"
        "print('rows', nearest(df, df, 1, exclude_self=True).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=os.path.expanduser("~"), env=env, capture_output=True, text=True, timeout=300)
    assert "rows 30" in done.stdout, done.stderr[-2000:]


def test_stored_tables_lie_in_one_folder(spark):
    first, second = session.workspace(spark), session.workspace(spark)
    assert os.path.dirname(first) == os.path.dirname(second) and first != second
    assert spark.sparkContext.applicationId in first


def test_sql_leaves_the_session_s_views(spark):
    from custoria.sources.scans import sql_query

    spark.range(3).createOrReplaceTempView("t")
    got = sql_query(spark, "WITH big AS (SELECT * FROM t WHERE id > :low) SELECT count(*) AS n, '{}' AS text FROM big", {"low": 4}, t=spark.range(10))
    assert tuple(got.first()) == (5, "{}")
    assert sql_query(spark, "SELECT max(id) FROM other", other=spark.range(8)).first()[0] == 7
    assert spark.table("t").count() == 3 and not spark.catalog.tableExists("other")


def test_ages_without_segments(spark):
    from custoria.operators.cleaning import clean_customers

    df = spark.createDataFrame([(str(i), None if i == 0 else 20.0 + i) for i in range(12)], "customer_id string, age double")
    assert clean_customers(df, "2024-06-01").where("customer_id = '0'").first()["age"] == 26.0


def test_many_draws_of_one_base(spark, monkeypatch):
    from custoria.operators import balancing

    monkeypatch.setattr(balancing, "DRAWS_PER_ROW", 3)
    points = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id long, features array<double>")
    near = spark.createDataFrame([(1, 1, 2), (2, 1, 1)], "id long, rank int, neighbour long")
    draws = spark.createDataFrame([(1, 10), (2, 0)], "id long, draws int")
    made = balancing._interpolate(draws, points, near, 1).collect()
    assert sorted(r.draw for r in made) == list(range(1, 11)) and all(0 <= r.features[0] <= 1 for r in made)
