from __future__ import annotations

import math
import random

import numpy as np
import pytest

from roadpulse.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, class string, size int, n int"


def brute(rows):
    def able(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    links = [0] * len(rows)
    for a, (_, v) in enumerate(rows):
        for b, (_, w) in enumerate(rows):
            if a != b and able(v) and able(w) and len(v) == len(w):
                x, y = np.array(v, float), np.array(w, float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.95:
                    links[a] += 1
                    parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(map(str, ((i, links[k], least.get(find(k)), i is not None and i == least[find(k)]) for k, (i, _) in enumerate(rows))))


def crowd():
    rng, rows = random.Random(2), []
    for g in range(14):
        base = [rng.gauss(0, 1) for _ in range(6)]
        for k in range(rng.choice([1, 2, 3, 9, 20])):
            rows.append([x + rng.gauss(0, rng.choice([0, 0.1, 0.3])) for x in base])
    return rows


@pytest.mark.parametrize("cell,block", [(4096, 4096), (5, 4096), (12, 3)])
def test_links_equal_brute_force(spark, monkeypatch, cell, block):
    monkeypatch.setattr(embeddings, "CELL", cell)
    monkeypatch.setattr(embeddings, "BLOCK", block)
    odd = [None, [], [0.0] * 6, [math.nan] * 6, [1.0, None, 0.0, 0.0, 0.0, 0.0], [math.inf, *[1.0] * 5], [1e-30] * 6, [1e-30] * 6, [3e30] * 6]
    odd += [[1.0, 2.0], [2.0, 4.0], [-1.0, -2.0], [0.5] * 6]
    vectors = [v and [x if x is None else float(np.float32(x)) for x in v] for v in crowd() + odd]
    rows = [(k if k % 17 else None, v) for k, v in enumerate(vectors)] + [(3, vectors[3]), (3, vectors[3])]
    df = spark.createDataFrame([(i, v, None, "x", 1, 2) for i, v in rows], SCHEMA)
    got = embeddings.near_duplicates(df)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(str, map(tuple, got.collect()))) == brute(rows)


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted(map(str, map(tuple, embeddings.op3_embeddings(spark, sf_dir).collect()))) == brute(rows)


def test_many_copies_of_one_vector(spark):
    df = spark.range(3000).selectExpr("id AS vec_id", "array(1f, IF(id < 2900, 0f, cast(id AS float)), 2f) AS embedding")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect()}
    assert got[0] == (2899, 0, True) and got[2899] == (2899, 0, False) and got[2900] == (99, 2900, True)


def test_no_vectors(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    only = spark.createDataFrame([(1, None, 0, "x", 1, 1)], SCHEMA)
    assert [tuple(r) for r in embeddings.near_duplicates(only).collect()] == [(1, 0, 1, True)]


def test_centres_are_unit_and_serve_all():
    rng = np.random.default_rng(0)
    sample = np.concatenate([rng.normal(c, 0.05, (50, 3)) for c in np.eye(3)]).astype(np.float32)
    found = embeddings.centres(sample, 3)
    assert np.allclose(np.linalg.norm(found, axis=1), 1)
    assert sorted(found.argmax(axis=1)) == [0, 1, 2]
