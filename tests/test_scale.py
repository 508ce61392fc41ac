"""Means for large tables, held to plain computations with tiny bounds."""

import hashlib
import math
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from custoria.functions import ranking
from custoria.operators import models as D
from custoria.operators import neighbours as NN
from custoria.operators.split import cut_classes


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("few_rows", [1, 10_000])
def test_boundary_rows_equal_those_of_an_ordered_table(spark, few_rows):
    rows = [(f"k{i % 180}", i % 3 if i % 7 else None) for i in range(200)] + [(None, 1)]
    df = spark.createDataFrame(rows, "key string, label int")
    ends = {0: [("a", 10), ("b", 10), ("c", 31)], 1: [("a", 1)], None: [("a", 0), ("b", 7)]}
    got = cut_classes(df, "label", "key", lambda counts: {v: ends.get(v, []) for v in counts}, "rest", seed=3, few_rows=few_rows)
    want = {}
    for value in (0, 1, 2, None):
        own = sorted((hashlib.md5("|".join([*([k] if k else []), "3"]).encode()).hexdigest(), k is not None, k or "") for k, v in rows if v == value)
        edges = [(part, own[end - 1]) for part, end in ends.get(value, []) if end and part != "b" or (value, part) == (None, "b")]
        for row in own:
            part = next((p for p, edge in edges if row <= edge), "rest")
            want[value, row[2], part] = want.get((value, row[2], part), 0) + 1
    found = {(r["label"], r["key"] or "", r["part"]): r["count"] for r in got.groupBy("label", "key", "part").count().collect()}
    assert found == want
    assert not any(word in plan(got) for word in ("Sort", "Join", "Repartition"))


@pytest.mark.parametrize("bound", [5, 10**6])
def test_percent_ranks_of_hot_values(spark, bound):
    """A third of the values are infinite, a third are one number; nothing is joined on a value."""
    rng = np.random.default_rng(1)
    values = [float("inf")] * 100 + [2.5] * 100 + [float(v) for v in rng.integers(0, 40, 90)] + [None] * 7 + [float("nan"), float("-inf"), 0.0, -0.0]
    rows = [(i, v, -v if v is not None else None) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id long, v double, w double").repartition(6)
    out = ranking.attach_percent_ranks(df, {"v": "rv", "w": "rw"}, bounded_rows=bound)
    for source, name in (("v", "rv"), ("w", "rw")):
        pairs = [(r[source], r[name]) for r in out.collect()]
        known = [v for v, _ in pairs if v is not None]
        key = lambda v: (math.isnan(v), 0.0 if math.isnan(v) else v)
        order = sorted(map(key, known))
        for v, rank in pairs:
            places = [i + 1 for i, o in enumerate(order) if v is not None and o == key(v)]
            assert (rank is None) == (v is None) and (v is None or rank == pytest.approx(sum(places) / len(places) / len(known)))
    joins = [line for line in plan(out).splitlines() if "Join" in line]
    assert all("_key" in line or "feature" in line or "_part" in line for line in joins)


def clustered(spark, per=150):
    rng = np.random.default_rng(1)
    points = np.round(np.concatenate([rng.normal(size=(per, 3)) * 0.1 + c for c in rng.normal(size=(6, 3)) * 10]), 2)
    points = np.vstack([points, points[:30]])
    return points, spark.createDataFrame([(i, x.tolist(), i % 3) for i, x in enumerate(points)], "id long, features array<double>, label int").repartition(4)


def test_near_chunks_first_halve_the_visits(spark, monkeypatch):
    monkeypatch.setattr(NN, "CHUNK_ROWS", 5)
    points, df = clustered(spark)
    visits = []
    ask = NN._ask

    def counted(*args):
        out = ask(*args)
        visits.append(out.agg(F.sum(F.size("at")), F.count("*")).first())
        return out

    monkeypatch.setattr(NN, "_ask", counted)
    total = {}
    for near in (NN.NEAR_CHUNKS, 0):
        monkeypatch.setattr(NN, "NEAR_CHUNKS", near)
        found = NN.nearest(df, df, 4, exclude_self=True, cell_rows=300, carry=["label"]).collect()
        total[near] = sum(v[0] or 0 for v in visits)
        rows = sum(v[1] for v in visits)
        assert rows < total[near] / 3  # rows are of chunks and blocks of queries, not of vectors
        visits.clear()
        distance = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
        for r in found:
            own = sorted((d, j) for j, d in enumerate(distance[r["id"]]) if j != r["id"])[r["rank"] - 1]
            assert (r["neighbour"], r["neighbour_label"]) == (own[1], own[1] % 3)
        assert len(found) == 4 * len(points)
    assert total[max(total)] <= total[0] / 2


def test_sketches_of_parts_equal_the_whole(spark):
    from custoria.operators import profiles as PR

    df = spark.range(20_000).select("id", (F.col("id") % 3000).cast("string").alias("text"), F.when(F.col("id") % 2 == 0, F.col("id") % 100 / 4).alias("x"), F.lit(None).cast("string").alias("none"))
    whole = PR.column_sketches(df, df.columns)
    halves = PR.column_sketches(df.where("id < 9000"), df.columns).unionByName(PR.column_sketches(df.where("id >= 9000"), df.columns))
    got = PR.sketched_counts(PR.merged_sketches(halves))
    assert got == PR.sketched_counts(PR.merged_sketches(whole)) == PR.sketched_counts(whole)
    for c, (known, values) in PR.null_and_distinct_counts(df, df.columns).items():
        assert got[c][0] == known and abs(got[c][1] - values) <= 0.05 * values


def test_duplicate_rows_tell_nulls_apart(spark):
    from custoria.operators.profiles import duplicate_rows

    df = spark.createDataFrame([(1, None, 0.0), (None, 1, 0.0), (1, None, -0.0), (None, None, None), (None, None, None)], "a int, b int, c double")
    assert duplicate_rows(df) == 2


def test_approximate_checks_keep_keys_exact(spark):
    from custoria.operators import validation as Q

    df = spark.range(4000).select(F.concat(F.lit("c"), F.greatest(F.col("id"), F.lit(5)).cast("string")).alias("customer_id"), F.concat(F.lit("n"), "id").alias("name"))
    exact, rough = ({r["check_name"]: r for r in Q.validate({"customers": df}, "2024-06-01", approximate=a).collect()} for a in (False, True))
    assert exact.keys() == rough.keys() and rough["duplicate_primary_key_customer_id"]["value"] == 5
    assert abs(rough["high_cardinality_name"]["value"] - 4000) <= 200


def test_cleaning_is_counted_while_it_runs(spark):
    from custoria.operators import cleaning as C

    day = "timestamp_ntz'2024-01-01 00:00:00'"
    rows = f"('a', {day}, 30.0), ('a', {day}, 30.0), ('b', null, 30.0), ('c', {day}, 130.0), ('d', {day}, null), ('e', {day}, 40.0), (null, {day}, 40.0)"
    df = spark.sql(f"SELECT *, 'x' AS customer_segment FROM VALUES {rows} AS t(customer_id, registration_date, age)")
    cleaned, report = C.clean_with_report({"customers": df}, "2024-06-01")
    got = {(r["metric"], r["column"]): r["value"] for r in report.collect()}
    assert got["records_before", None] == 7 and got["duplicates_removed", None] == 1 and got["records_after", None] == cleaned["customers"].count() == 3
    assert got["missing_handled", "customer_id"] == got["missing_handled", "registration_date"] == got["missing_handled", "age"] == got["rule_violations", "age"] == 1


def test_forest_uses_several_tasks_and_ignores_how_rows_are_stored(spark, monkeypatch):
    rows = [(i, i % 2, i % 2 + i % 7 / 4, float(i % 101)) for i in range(5000)]
    plain = spark.createDataFrame(rows, "id long, label int, a double, b double")
    one, many = (D.training_frame(t, ["a", "b"], "label", "id").cache() for t in (plain.coalesce(1), plain.repartition(7)))
    placed = [D.spread(t, "id").select("id").rdd.glom().collect() for t in (one, many)]
    assert placed[0] == placed[1] and len(placed[0]) == 2 and min(map(len, placed[0])) > 0
    seen = []
    monkeypatch.setattr(D, "fitted", lambda estimator, part: seen.append(part.rdd.getNumPartitions()) or estimator.fit(part))
    D.fit_random_forest(one, ["a", "b"], "id", trees=2, depth=2, cross_validate=False)
    assert seen == [2]


def test_forest_statistics_fit_the_memory_of_small_executors():
    conf = {"spark.driver.memory": "1800m"}
    context = SimpleNamespace(getConf=lambda: conf, master="local[6]", defaultParallelism=6)
    assert D._node_memory(SimpleNamespace(sparkContext=context)) == 75


def test_checks_delete_their_shuffle_files_and_restore_the_setting(spark, monkeypatch):
    """Else the files of every pass over a large table stay on disk until the driver collects its garbage."""
    from custoria.operators import validation as Q

    name, seen, counted = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", [], Q.duplicate_rows
    monkeypatch.setattr(Q, "duplicate_rows", lambda df: (seen.append(spark.conf.get(name)), counted(df))[1])
    before = spark.conf.get(name)
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "customer_id bigint, gender string")
    rows = {r["check_name"]: r["value"] for r in Q.validate({"customers": df}, "2024-01-01").collect()}
    assert rows["duplicate_rows"] == 1 and rows["duplicate_primary_key_customer_id"] == 1
    assert seen == ["true"] and spark.conf.get(name) == before


def test_all_checks_join_their_datasets_once(spark, small, monkeypatch):
    """Every pass of the checks over a joined dataset shuffled both tables again."""
    from bindings import quality as BQ
    from custoria.operators import validation as Q

    plans, validate = {}, Q.validate

    def spied(datasets, *args):
        plans.update({n: df._jdf.queryExecution().optimizedPlan().toString() for n, df in datasets.items()})
        return validate(datasets, *args)

    monkeypatch.setattr(Q, "validate", spied)
    assert {r["dataset"] for r in BQ.validation_summary_all(spark, small).collect()} == set(plans)
    assert len(plans) == 4 and not any("Join" in p or "Aggregate" in p for p in plans.values())
