from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from helpers import bag, plan
from roadpulse.functions.hashing import token_bound
from roadpulse.operators.metrics import distinct_values, regression_metrics, silhouette
from roadpulse.operators import sampling
from roadpulse.operators.sampling import preview, random_split, split, take


def numbers(spark, n=2000):
    return spark.range(n).withColumn("v", F.col("id") * 3)


def test_take_is_the_same_on_any_partitioning(spark):
    rows = numbers(spark)
    want = [(i, i * 3) for i in range(25)]
    for parts in (1, 7, 40):
        assert sorted(map(tuple, take(rows.repartition(parts), 25, ["id"]).collect())) == want
    assert take(rows, None, ["id"]) is rows
    assert preview(rows, ["id"]).count() == 10


@pytest.mark.parametrize("n", [10, 1000])
def test_take_neither_sorts_nor_shuffles_the_table(spark, n):
    text = plan(take(numbers(spark), n, ["id"]))
    assert "TakeOrderedAndProject" in text and "Sort" not in text.replace("sortOrder", "") and "Exchange" not in text


@pytest.mark.parametrize("kind", ["bigint", "double", "timestamp", "timestamp_ntz", "date", "decimal(12,2)"])
@pytest.mark.parametrize("n", [40, 150, 299, 300, 1000])
def test_a_large_take_cuts_by_a_sketch_and_stays_exact(spark, monkeypatch, kind, n):
    """Ties at the cut, NULLs first, any ordered type."""
    monkeypatch.setattr(sampling, "HEAP", 20)
    monkeypatch.setattr(sampling, "ACCURACY", 50)
    base = {"timestamp": "TIMESTAMP'2024-01-01' + make_interval(0,0,0,id % 90)", "date": "DATE'2024-01-01' + CAST(id % 90 AS INT)"}
    base["timestamp_ntz"] = f"CAST({base['timestamp']} AS TIMESTAMP_NTZ)"
    value = base.get(kind, f"CAST(id % 90 AS {kind})")
    rows = spark.range(300).selectExpr(f"IF(id % 7 = 0, NULL, {value}) AS k", "id AS v")
    want = rows.orderBy("k", "v").limit(n)
    assert bag(take(rows.repartition(5), n, ["k"])) == bag(want)


def test_a_large_take_leaves_rows_out_before_the_merge(spark, monkeypatch):
    monkeypatch.setattr(sampling, "HEAP", 20)
    left = sampling._below(spark.range(1_000_000).repartition(4), 5000, "id").count()
    assert 5000 <= left < 5100


def test_take_of_tied_keys_is_the_same_on_any_partitioning(spark):
    rows = spark.range(3000).selectExpr("id % 7 AS k", "id AS v", "map('a', id) AS m")
    first = bag(take(rows.repartition(3), 500, ["k"]).select("k", "v"))
    assert first == bag(take(rows.repartition(16), 500, ["k"]).select("k", "v"))
    assert set(first) == {(k, v) for k, v in sorted((v % 7, v) for v in range(3000))[:500]}


def test_split_is_complete_disjoint_and_partitioning_free(spark):
    rows = numbers(spark)
    train, test = split(rows, [0.7, 0.3], ["id"])
    assert bag(train) + bag(test) == bag(rows)
    again, _ = split(rows.repartition(13), [0.7, 0.3], ["id"])
    assert bag(again) == bag(train)
    other, _ = split(rows, [0.7, 0.3], ["id"], seed=43)
    assert bag(other) != bag(train)
    assert abs(train.count() / rows.count() - 0.7) < 0.05
    assert "Exchange" not in plan(train)


def test_split_in_three_and_with_null_keys(spark):
    rows = spark.createDataFrame([(None,), ("a",), ("b",)] * 50, "k STRING")
    parts = split(rows, [1, 1, 2], ["k"])
    assert sum((bag(p) for p in parts[1:]), bag(parts[0])) == bag(rows)
    assert token_bound(0.25) == "40000000"


def test_random_split_is_complete(spark):
    parts = random_split(numbers(spark), [0.7, 0.3], ["id"])
    assert bag(parts[0].unionByName(parts[1])) == bag(numbers(spark).select("id"))


def test_errors_equal_the_evaluator(spark):
    rng = random.Random(5)
    rows = spark.createDataFrame([(rng.gauss(0, 1), rng.gauss(0, 1)) for _ in range(300)], "y DOUBLE, p DOUBLE")
    got = regression_metrics(rows, "y", "p").first()
    for name in ("mse", "rmse", "mae"):
        want = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name).evaluate(rows)
        assert got[name] == pytest.approx(want, rel=1e-12)


def brute_silhouette(points):
    def d(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    scores = []
    for i, (p, c) in enumerate(points):
        groups = {}
        for j, (q, e) in enumerate(points):
            if i != j:
                groups.setdefault(e, []).append(d(p, q))
        if c not in groups:
            scores.append(0.0)
            continue
        a = sum(groups[c]) / len(groups[c])
        b = min(sum(g) / len(g) for e, g in groups.items() if e != c)
        scores.append((b - a) / max(a, b))
    return sum(scores) / len(scores)


@pytest.fixture(scope="module")
def clustered():
    rng = random.Random(11)
    points = [((rng.gauss(c * 2, 1), rng.gauss(-c, 1)), c) for c in range(6) for _ in range(12)]
    points += [points[0], points[0], ((50.0, 50.0), 9)]  # copies, and a cluster of one row
    return points


def both_ways(rows, features=("x", "y")):
    """The expression, and the same features as one array."""
    yield silhouette(rows, list(features), "c")
    yield silhouette(rows.select(F.array(*features).alias("f"), "c"), "f", "c")


def test_silhouette_equals_brute_force(spark, clustered):
    rows = spark.createDataFrame([(*p, c) for p, c in clustered], "x DOUBLE, y DOUBLE, c INT")
    for got in both_ways(rows):
        assert got.first()["silhouette"] == pytest.approx(brute_silhouette(clustered), abs=1e-9)


@pytest.mark.parametrize("k", [5, 40])
def test_silhouette_has_one_contract_at_any_number_of_clusters(spark, k):
    points = [(float(c), 0.0, c) for c in range(k) for _ in range(3)]
    schema = "x DOUBLE, y DOUBLE, c INT"
    for bad in ((None, 0.0, 1), (math.nan, 0.0, 1), (1.0, 0.0, None)):
        for way in range(2):
            with pytest.raises(Exception, match="cannot be scored"):
                list(both_ways(spark.createDataFrame([*points, bad], schema)))[way].collect()
    same = [(1.0, 2.0, c) for c in range(k) for _ in range(3)]
    for got in both_ways(spark.createDataFrame(same, schema)):
        assert got.first()["silhouette"] == 0.0


def test_too_many_clusters_are_refused(spark, monkeypatch):
    from roadpulse.operators import metrics

    monkeypatch.setattr(metrics, "BROADCAST_BYTES", 1000)
    rows = spark.range(3000).selectExpr("CAST(id AS DOUBLE) AS x", "0D AS y", "id % 900 AS c")
    with pytest.raises(ValueError, match="too many"):
        silhouette(rows, ["x", "y"], "c")


def test_many_columns(spark):
    rng = random.Random(2)
    points = [(tuple(rng.gauss(c, 1) for _ in range(30)), c) for c in range(3) for _ in range(8)]
    names = [f"f{i}" for i in range(30)]
    rows = spark.createDataFrame([(*p, c) for p, c in points], [*names, "c"])
    got = silhouette(rows, names, "c").first()["silhouette"]
    assert got == pytest.approx(brute_silhouette(points), abs=1e-9)


def test_silhouette_refuses_unscored_rows_and_single_clusters(spark):
    rows = spark.createDataFrame([(1.0, 0), (2.0, 0), (9.0, 1), (None, 1)], "x DOUBLE, c INT")
    with pytest.raises(Exception, match="cannot be scored"):
        silhouette(rows, ["x"], "c").collect()
    with pytest.raises(ValueError, match="two clusters"):
        silhouette(rows.where("c = 0"), ["x"], "c")


def test_silhouette_of_arrays_and_vectors(spark, clustered):
    want = brute_silhouette(clustered)
    arrays = spark.createDataFrame([(list(p), c) for p, c in clustered], "f ARRAY<DOUBLE>, c INT")
    vectors = spark.createDataFrame([(Vectors.dense(p), c) for p, c in clustered], ["f", "c"])
    for rows in (arrays, vectors):
        assert math.isclose(silhouette(rows, "f", "c").first()["silhouette"], want, abs_tol=1e-9)


def test_distinct_values_are_in_order(spark):
    rows = spark.createDataFrame([(3,), (1,), (3,), (2,)], "c INT")
    assert [r.c for r in distinct_values(rows, "c").collect()] == [1, 2, 3]
