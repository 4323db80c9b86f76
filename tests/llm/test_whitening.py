from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.llm import whitening as w
from tests.llm import odd

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(*r, 0) for r in rows], schema)


def plain(rows, most=32):
    """Whitening by an eigendecomposition of the covariance, from exact whole numbers."""
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows], object)
    n, sums = len(x), x.sum(axis=0)
    scaled = x * n - sums
    centred = scaled.astype(float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    rank = min(most, int((values > 1e-12 * values[0]).sum()))
    white = centred @ axes[:, :rank] / np.sqrt(values[:rank])
    return (scaled * scaled).sum(axis=1), white, values[:rank] / values.sum()


def check(spark, rows, most=32):
    found = w.whitened(vectors(spark, rows).repartition(5), most).collect()
    deviations, white, shares = plain(rows, most)
    by = {(r["vec_id"], r["component"]): r for r in found}
    assert len(by) == len(found) == white.size
    for i, (vec_id, _) in enumerate(rows):
        for k in range(white.shape[1]):
            row = by[vec_id, k + 1]
            assert row["n"] == len(rows) and row["deviation"] == deviations[i]
            assert row["explained"] == pytest.approx(shares[k], rel=1e-9)
            assert abs(row["whitened"]) == pytest.approx(abs(white[i, k]), abs=1e-7)
            assert row["identity_error"] < 1e-9
    # One sign for all rows of a component.
    for k in range(white.shape[1]):
        mine = np.array([by[i, k + 1]["whitened"] for i, _ in rows])
        assert min(np.abs(mine - white[:, k]).max(), np.abs(mine + white[:, k]).max()) < 1e-7
    return found


def spread_rows(n, size, seed=1, scale=1.0):
    rng = np.random.default_rng(seed)
    made = rng.normal(size=(n, size)) * scale * np.linspace(1, 3, size) + rng.normal(size=size)
    return [(k, made[k].tolist()) for k in range(n)]


def test_equals_an_eigendecomposition(spark):
    check(spark, spread_rows(300, 40))
    check(spark, spread_rows(60, 5), most=3)


def test_components_of_very_different_size(spark):
    rng = np.random.default_rng(3)
    made = rng.normal(size=(400, 6)) * np.array([3000.0, 300, 30, 10, 5, 1])
    check(spark, [(k, v.tolist()) for k, v in enumerate(made)])


def test_fewer_rows_than_columns_and_columns_that_add_up(spark):
    found = check(spark, spread_rows(4, 9))
    assert max(r["component"] for r in found) == 3
    rows = [(k, [v[0], v[1], v[0], 0.5]) for k, v in spread_rows(50, 2)]
    assert max(r["component"] for r in check(spark, rows)) == 2


def test_what_is_left_out(spark):
    good = spread_rows(30, 4)
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [math.nan] * 4), (104, [math.inf, 0.0, 0.0, 0.0])]
    found = w.whitened(vectors(spark, good + bad)).collect()
    assert {r["vec_id"] for r in found} == set(range(30)) and {r["n"] for r in found} == {30}


def test_rows_without_variance_and_no_rows(spark):
    assert w.whitened(vectors(spark, [(k, [1.0, 2.0]) for k in range(5)])).count() == 0
    assert w.whitened(vectors(spark, [(1, [1.0, 2.0])])).count() == 0
    none = w.whitened(odd.empty(spark, SCHEMA))
    assert none.count() == 0 and none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_repeated_rows_null_ids_and_other_columns(spark):
    rows = spread_rows(20, 3)
    rows += [rows[0]] * 40 + [(None, rows[1][1])]
    frame = vectors(spark, rows)
    for name in ("component", "n", "whitened", "size", "task", "sums", "place", "deviation"):
        frame = frame.withColumn(name, F.lit("mine"))
    found = w.whitened(frame)
    assert found.count() == 61 * 3
    assert found.where("vec_id = 0").select("whitened").distinct().count() == 3
    assert found.where("vec_id is null").count() == 3 and found.first()["n"] == 61


def test_lengths_are_lists_of_their_own(spark):
    found = w.whitened(vectors(spark, spread_rows(20, 3) + [(k + 50, v) for k, v in spread_rows(10, 2)])).collect()
    assert {r["n"] for r in found if r["vec_id"] < 50} == {20} and {r["n"] for r in found if r["vec_id"] >= 50} == {10}


def test_entries_too_large_for_a_long(spark):
    rows = [(k, [1e30 * (-1) ** k, float(k)]) for k in range(6)]
    found = w.whitened(vectors(spark, rows)).collect()
    assert {r["deviation"] for r in found} == {None}
    big = [(k, [2.0**12 * k, float(k % 2)]) for k in range(40)]
    check(spark, big)


def test_sums_of_many_tasks_in_two_steps(spark):
    rows = spread_rows(500, 4)
    few, many = (w.whitened(vectors(spark, rows).repartition(n, "vec_id")) for n in (1, 40))
    both = few.alias("a").join(many.alias("b"), ["vec_id", "component"])
    worst = both.agg(F.max(F.abs(F.col("a.whitened") - F.col("b.whitened"))).alias("m"), F.count(F.lit(1)).alias("n")).first()
    assert worst["n"] == 2000 and worst["m"] < 1e-9
