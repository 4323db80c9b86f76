from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm.odd import documents, empty, prose, shingles
from roadpulse.llm import ngram_join
from roadpulse.llm.components import components


def brute(rows) -> Counter:
    sets = [shingles(r.text) for r in rows]
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for k, r in enumerate(rows):
        if r.doc_id is not None:
            least[find(k)] = min(r.doc_id, least.get(find(k), r.doc_id))
    return Counter((r.doc_id, len(sets[k]), least.get(find(k))) for k, r in enumerate(rows))


@pytest.fixture(scope="module")
def crowd(spark):
    """Groups of near copies around some texts, a passage that many share, and texts at the border of a link."""
    rng, rows = random.Random(3), []
    passage = prose(50, 60)
    for g in range(6):
        base = prose(60 + g, 90).split()
        for k in range([40, 12, 5, 3, 2, 1][g]):
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
            rows.append(" ".join(words))
    for k in range(60):
        rows.append(passage + " " + prose(500 + k, rng.choice([5, 15, 18, 20, 22, 60])))
    rows += rows[:9]
    rng.shuffle(rows)
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").cache()


@pytest.mark.parametrize("block", [1000, 3])
def test_components_equal_brute_force(spark, crowd, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    assert Counter(map(tuple, ngram_join.near_duplicates(crowd).collect())) == brute(crowd.collect())


def test_odd_rows(spark):
    docs = documents(spark, extra=True)
    assert Counter(map(tuple, ngram_join.near_duplicates(docs).collect())) == brute(docs.collect())


def test_one_row_of_each_group_stays(spark, crowd):
    docs = crowd.selectExpr("*", "'x' AS class", "'y' AS root", "1 AS copy")
    kept = ngram_join.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, n, c in brute(crowd.collect())})


def test_representatives_of_odd_rows(spark):
    docs = documents(spark)
    kept = ngram_join.representatives(docs).collect()
    groups = brute(docs.collect())
    texts = [r for r in kept if shingles(r.text)]
    ids = {c for _, n, c in groups if n and c is not None}
    assert sorted(r.doc_id for r in texts if r.doc_id is not None) == sorted(ids)
    assert len([r for r in texts if r.doc_id is None]) == len({r.text for r in docs.collect() if r.doc_id is None}) - 1
    assert len(kept) - len(texts) == sum(n for (_, size, _), n in groups.items() if not size)


def test_empty_table(spark):
    assert ngram_join.near_duplicates(empty(spark)).count() == 0
    assert ngram_join.representatives(empty(spark)).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    assert Counter(map(tuple, ngram_join.op10_ngram_join(spark, sf_dir).collect())) == brute(docs.collect())


def test_long_chain_is_one_component(spark):
    edges = spark.range(200).selectExpr("id AS a", "id + 1 AS b").unionByName(spark.sql("SELECT 900L AS a, 901L AS b"))
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    assert len({roots[k] for k in range(201)}) == 1 and roots[900] == roots[901] != roots[0]


def test_voronoi_regions_lose_no_link():
    import numpy as np

    rng = np.random.default_rng(1)
    bases = [rng.integers(0, 2**60, 80).astype(np.uint64) for _ in range(12)]
    sets = []
    for k in range(150):
        s = bases[k % 12].copy()
        s[rng.integers(0, 80, rng.integers(0, 16))] = rng.integers(0, 2**60)
        sets.append(np.unique(np.r_[s, rng.integers(0, 2**60, rng.integers(0, 4)).astype(np.uint64)]))
    points = ngram_join.Points(np.arange(150), sets)
    points.join(np.arange(150))
    want = list(range(150))

    def find(k):
        while want[k] != k:
            k = want[k]
        return k

    for a in range(150):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                want[find(a)] = find(b)
    pairs = {(find(a) == find(b), bool(points.leader[a] == points.leader[b])) for a in range(150) for b in range(a)}
    assert pairs <= {(True, True), (False, False)}


def test_copies_of_a_text_do_not_meet_in_one_bucket(spark, monkeypatch):
    import pyarrow as pa

    whole = ngram_join._bucket

    def sized(part):
        """The rows of a bucket, with how many there are in place of ``copy``."""
        got = whole(part)
        n = pa.compute.sum(pa.compute.is_valid(got["copy"])).as_py() or 0
        return got.set_column(1, "copy", pa.array([n] * got.num_rows, pa.int64()))

    rows = [(k, prose(1, 30) if k % 2 else None) for k in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(ngram_join, "_bucket", sized)
    got = ngram_join.survey(docs).where("n_shingles is not null").collect()
    assert sorted(r.doc_id for r in got) == list(range(4000)) and {r.n_shingles for r in got} == {0, 26}
    assert max(r["copy"] for r in got) < 1000


def test_one_id_may_have_many_texts(spark):
    """Different texts, near copies among them, under one id: as many classes, each read once."""
    import time

    made = [prose(k, 40) for k in range(1500)]
    texts = made + [t + " end" for t in made[:300]] + made[:200]
    one = spark.createDataFrame([(7 if k % 3 else None, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(8)
    each = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    spent = []
    for docs in (each, one, each, one):
        started = time.monotonic()
        rows = ngram_join.grouped(docs).groupBy("root").count().groupBy("count").agg(F.count(F.lit(1)).alias("n")).collect()
        spent.append(time.monotonic() - started)
        groups = {r["count"]: r.n for r in rows}
        assert groups == {3: 200, 2: 100, 1: 1200}
    assert spent[3] < 2 * spent[2] + 2


def test_columns_named_as_the_helpers_name_theirs(spark):
    docs = documents(spark)
    names = ("__id", "__copy", "__text", "row", "id", "copy", "of", "by", "root", "salt")
    for name in names:
        docs = docs.withColumn(name, F.lit("kept"))
    kept = ngram_join.representatives(docs)
    assert kept.columns == docs.columns
    assert all(r[name] == "kept" for r in kept.collect() for name in names)
    plain = ngram_join.representatives(documents(spark))
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(map(str, plain.select("doc_id", "text").collect()))


def test_a_worker_remembers_one_steps_words():
    """Toxicity's words and the join's lay beside each other in workers, also while none of them was needed."""
    import numpy as np
    import pyarrow as pa

    from roadpulse.llm import shingles as sets, toxicity
    from roadpulse.llm.common import takes_over

    toxicity._mean_evidence(toxicity.Models({}), "a", ["one two"])
    assert set(toxicity._remembered["words"]) == {b"one", b"two"}
    takes_over("shingles", sets.forget_words)
    assert not toxicity._remembered
    first = sets.shingle_set("three four").tolist()
    takes_over("shingles", sets.forget_words)
    assert sets._known
    names = ["class", "shingles", "region", "pivot"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.bool_()]
    part = pa.table([pa.array([], k) for k in kinds], names)
    assert ngram_join._join_task(part).num_rows == 0
    assert not sets._known and sets.shingle_set("three four").tolist() == first
    # A step that comes back computes what it forgot.
    got = toxicity._mean_evidence(toxicity.Models({}), "a", ["one", None])
    assert got.tolist() == np.zeros(2).tolist() and set(toxicity._remembered["words"]) == {b"one"}
