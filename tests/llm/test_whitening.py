"""Whitening against exact sums and a plain eigenvalue decomposition."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custoria.llm import whitening

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("x", T.IntegerType()), T.StructField("n", T.IntegerType())])


def grid(vector):
    return [math.floor(1024 * float(np.float32(c))) + 100_000 for c in vector]


def expected(vectors, weights="counts"):
    """n, S and the covariance as fractions."""
    x = [grid(v) for v in vectors]
    if weights == "ones":
        x = [list(v) for v in dict.fromkeys(map(tuple, x))]
    n, s = len(x), [sum(c) for c in zip(*x)]
    d = [[Fraction(n * c - t, n) for c, t in zip(row, s)] for row in x]
    v = [[float(sum(r[i] * r[j] for r in d) / n) for j in range(len(s))] for i in range(len(s))]
    return n, s, np.array(v)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    base = (rng.normal(size=(60, 6)) * [3, 1, 0.5, 0.25, 0.1, 0.05]).astype(np.float32).tolist()
    return base + [base[0]] * 40 + [base[1]] * 3


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in enumerate(rows)], SCHEMA).repartition(5)


@pytest.mark.parametrize("weights", ["counts", "ones"])
def test_equals_brute_force(spark, vectors, weights):
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] + [0.0] * 5, [float("inf")] + [0.0] * 5, [3e38] + [0.0] * 5, [1.0, 2.0]]
    rows = whitening.whiten(frame(spark, vectors + bad), components=4, weights=weights).collect()
    n, s, v = expected(vectors, weights)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    assert len(rows) == 4 * len(vectors)
    seen = {}
    for r in rows:
        x, k = grid(vectors[r["vec_id"]]), r["component"] - 1
        assert r["n"] == n and r["deviation"] == sum((n * a - b) ** 2 for a, b in zip(x, s)) and r["x"] == 1
        z = sum(float(Fraction(n * a - b, n)) * c for a, b, c in zip(x, s, axes[:, k])) / math.sqrt(values[k])
        assert abs(abs(z) - abs(r["whitened"])) < 1e-9 * max(1, abs(z))
        assert abs(r["explained"] - values[k] / np.trace(v)) < 1e-9
        seen.setdefault(k, []).append((z, r["whitened"]))
    for pairs in seen.values():  # one sign for all rows
        assert len({math.copysign(1, a * b) for a, b in pairs if abs(a) > 1e-6}) == 1
    if weights == "counts":
        z = np.array([[w for _, w in sorted((r["vec_id"], r["whitened"]) for r in rows if r["component"] == k)] for k in range(1, 5)])
        error = np.abs(z @ z.T / n - np.outer(z.mean(1), z.mean(1)) - np.eye(4)).max()
        assert error < 1e-9 and rows[0]["identity_error"] < 1e-9


def test_large_entries_stay_exact(spark):
    """Sums beyond 2**53 and deviations beyond a long."""
    vectors = [[1e6, -2e6], [3e6, 1.0], [-5e6, 2.5], [4e12, 1e12]]
    rows = whitening.whiten(frame(spark, vectors), components=2).collect()
    n, s, v = expected(vectors)
    for r in rows:
        want = sum((n * a - b) ** 2 for a, b in zip(grid(vectors[r["vec_id"]]), s))
        assert r["deviation"] == (want if want < 2**63 else None)
        assert abs(r["explained"] - np.linalg.eigvalsh(v)[::-1][r["component"] - 1] / np.trace(v)) < 1e-9
    groups = frame(spark, vectors[:3]).select(F.transform("embedding", lambda c: F.floor(c.cast("double") * 1024).cast("long")).alias("x"), F.lit(1 << 40).alias("weight"))
    x = np.array([[math.floor(1024 * float(np.float32(c))) for c in v] for v in vectors[:3]], object)
    assert whitening.sums(groups, [1, -7], 2, True)[1:] == (((x - np.array([1, -7])).T << 40) @ (x - np.array([1, -7]))).tolist()


def test_no_variance_and_no_rows(spark):
    rows = whitening.whiten(frame(spark, [[0.5, 0.25]] * 5)).collect()
    assert len(rows) == 10 and {(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in rows} == {(0, None, 0.0, 0.0)}
    line = whitening.whiten(frame(spark, [[0.0, 1.0], [1.0, 1.0]])).collect()
    assert {(r["component"], r["whitened"] is None) for r in line} == {(1, False), (2, True)}
    for rows in ([], [None, [float("nan")]]):
        none = whitening.whiten(frame(spark, rows))
        assert none.collect() == [] and none.columns == ["vec_id", "embedding", "x", *whitening.ADDED]


def test_query_over_the_table(spark, small):
    from custoria.llm.queries import QUERIES

    found = QUERIES["op11_whitening"](spark, small)
    total = spark.read.parquet(f"{small}/embeddings.parquet").count()
    row = found.agg(F.count("*"), F.max("identity_error"), F.max("n"), F.max("component")).first()
    assert row[0] == 8 * total and row[1] < 1e-9 and row[2:] == (total, 8)
