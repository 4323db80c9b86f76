from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from llm.odd import documents, empty, words
from roadpulse.llm import mixing


def water(sizes: dict, weights) -> dict:
    """Targets by resharing again and again."""
    open_, targets = set(sizes), dict.fromkeys(sizes, 0.0)
    left = float(sum(sizes.values()))
    while left > 1e-9 and open_:
        share = left / sum(weights[s] for s in open_)
        for s in open_:
            targets[s] += share * weights[s]
        left = sum(max(0.0, targets[s] - 3 * sizes[s]) for s in open_)
        full = {s for s in open_ if targets[s] >= 3 * sizes[s] - 1e-9}
        for s in full:
            targets[s] = 3.0 * sizes[s]
        open_ -= full
    return targets


def check(rows, docs):
    sizes = defaultdict(int)
    for d in docs:
        sizes[d.source] += len(words(d.text))
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weights = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(order)}
    targets = water(sizes, weights)
    by_id = defaultdict(list)
    for d in docs:
        by_id[d.doc_id].append(d)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        source = by_id[r.doc_id][0].source if len({d.source for d in by_id[r.doc_id]}) == 1 else None
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        if len({d.source for d in by_id[r.doc_id]}) == 1:
            assert r.source_size == sizes[source]
            assert r.target == pytest.approx(targets[source], abs=1e-6)
    assert sum(r.taken for r in rows) <= sum(sizes.values())
    return targets


def test_targets_and_copies_of_odd_rows(spark):
    docs = documents(spark)
    rows = mixing.plan(docs).rows.selectExpr("doc_id", "size", "source_size", "target", "size * copies AS taken").collect()
    assert len(rows) == docs.count()
    check(rows, docs.collect())


def test_sources_come_near_their_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = mixing.plan(docs)
    rows = plan.rows.groupBy("rank").agg({"target": "max", "size": "max"}).collect()
    taken = {r["rank"]: r["t"] for r in plan.rows.selectExpr("rank", "size * copies AS x").groupBy("rank").agg({"x": "sum"}).withColumnRenamed("sum(x)", "t").collect()}
    for r in rows:
        assert abs(taken[r["rank"]] - r["max(target)"]) <= 2 * r["max(size)"]
    largest = max(r["max(size)"] for r in rows)
    total = plan.rows.agg({"size": "sum"}).first()[0]
    assert total - largest <= sum(taken.values()) <= total


def test_mix_is_the_plan_and_reruns_agree(spark):
    docs = documents(spark, extra=True)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    got = sorted(map(str, mixed.collect()))
    assert got == sorted(map(str, mixing.mixed(docs.repartition(5)).collect()))
    copies = mixing.plan(docs).rows.agg({"copies": "sum"}).first()[0]
    assert len(got) == copies


def test_order_is_by_finish_time(spark, sf_dir):
    """All that is in finishes before all that is out."""
    plan = mixing.plan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for r in plan.rows.where("target > 0").collect():
        for k in range(3):
            finish = (k * r.source_size + r.upto) / r.target
            assert (finish <= plan.cut) == (k < r.copies)


def test_hot_source_and_small_slices(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE", 7)
    docs = spark.range(400).selectExpr("id AS doc_id", "repeat('w ', cast(id % 9 AS int)) AS text", "CASE WHEN id < 300 THEN 'hot' ELSE concat('s', id % 4) END AS source")
    rows = mixing.plan(docs).rows.selectExpr("doc_id", "size", "source_size", "target", "size * copies AS taken").collect()
    check(rows, docs.collect())


def test_empty_table(spark):
    assert mixing.plan(empty(spark)).rows.count() == 0
    assert mixing.mixed(empty(spark)).count() == 0


def test_equal_rows_are_cut_among_themselves(spark):
    """3,000 equal rows: each source is served to within a row of its target, and rows of one place differ in the mix."""
    text, other = " ".join(["w"] * 5), "one two three"
    rows = [(1, text, "a", k) for k in range(3000)] + [(k, f"{other} {k}", "b", k) for k in range(5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, tag long").repartition(7)
    plan = mixing.plan(docs)
    sizes = {r.source: (r.target, r.size) for r in mixing.targets(plan_sizes(docs)).selectExpr("source", "target", "1 AS size").collect()}
    taken = plan.rows.groupBy("rank").agg(F.sum(F.col("size") * F.col("copies")).alias("n")).orderBy("rank").collect()
    for rank, source, size in ((0, "a", 5), (1, "b", 4)):
        assert abs(taken[rank].n - sizes[source][0]) <= size
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns
    count = {r.source: r.n for r in mix.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert count["a"] * 5 == taken[0].n and count["b"] * 4 == taken[1].n
    # Copies of equal rows differ by one at most.
    per_row = mix.where("source = 'a'").groupBy("tag").count().agg(F.min("count").alias("a"), F.max("count").alias("b")).first()
    assert per_row.b - per_row.a <= 1
    assert [tuple(r) for r in taken] == [tuple(r) for r in mixing.plan(docs.repartition(3)).rows.groupBy("rank").agg(
        F.sum(F.col("size") * F.col("copies")).alias("n")).orderBy("rank").collect()]


def plan_sizes(docs):
    words = F.coalesce(F.regexp_count("text", F.lit(mixing.WORD)), F.lit(0)).cast("long")
    return docs.select("source", words.alias("size"), F.lit(1).cast("long").alias("rows"))


def test_columns_named_as_the_helpers_name_theirs(spark):
    docs = documents(spark)
    for name in ("__copy", "__of", "__round", "__last", "row", "last", "draw", "copies", "number", "turn", "task", "border", "rows"):
        docs = docs.withColumn(name, F.lit("kept"))
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns
    plain = mixing.mixed(documents(spark))
    assert sorted(map(str, mix.select("doc_id", "text").collect())) == sorted(map(str, plain.select("doc_id", "text").collect()))
    assert mix.where("row <> 'kept' or draw <> 'kept' or __copy <> 'kept'").count() == 0
