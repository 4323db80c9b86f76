from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from helpers import plan
from llm.odd import WORD, documents, empty
from roadpulse.llm import fingerprints as fp


def plain_shingles(text):
    w = WORD.findall(text or "")
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def likeness(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def run(spark, docs, monkeypatch):
    monkeypatch.setattr(fp, "table", lambda s, d, n: docs)
    return fp.op8_fingerprints(spark, "")


def check(rows, docs):
    """``docs``: (doc_id, text) in any order, ids unique."""
    order = sorted(docs, key=lambda d: -d[0])
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs)
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        out = len(text) // 3
        edited = text[: len(text) - out] + after[:out]
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = map(plain_shingles, (text, edited, after))
        sure = 0 if len(a | b) <= fp.SIZE else 0.2
        assert abs(r.near_edited - likeness(a, b)) <= sure + 1e-12
        assert abs(r.near_next - likeness(a, c)) <= (0 if len(a | c) <= fp.SIZE else 0.2) + 1e-12


@pytest.mark.parametrize("size,step", [(2000, 64), (3, 64), (1, 2)])
def test_odd_rows_in_slices(spark, monkeypatch, size, step):
    monkeypatch.setattr(fp, "SLICE", size)
    monkeypatch.setattr(fp, "STEP", step)
    docs = documents(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    check(run(spark, docs, monkeypatch).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_repeated_and_null_ids(spark, monkeypatch):
    docs = documents(spark, extra=True)
    rows = run(spark, docs, monkeypatch).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in docs.collect())
    assert sorted(map(str, rows)) == sorted(map(str, run(spark, docs.repartition(7), monkeypatch).collect()))


def test_one_row_and_none(spark, monkeypatch):
    one = documents(spark).where("doc_id = 5")
    row = run(spark, one, monkeypatch).first()
    text = one.first().text
    out = len(text) // 3
    assert row.edited_sha256 == hashlib.sha256((text[: len(text) - out] + text[:out]).encode()).hexdigest() and row.near_next == 1.0
    assert run(spark, empty(spark), monkeypatch).count() == 0


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    result = fp.op8_fingerprints(spark, sf_dir)
    rows = result.collect()
    check(rows, docs)
    by_text = {}
    for r in rows:
        by_text.setdefault(dict(docs)[r.doc_id], set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    text = plan(result)
    assert "Python" not in text and "Pandas" not in text and "MapInArrow" not in text


def test_sketches_merge_and_estimate(spark):
    a, b = (" ".join(f"w{k}" for k in range(*r)) for r in ((0, 4000), (1000, 5000)))
    both = spark.createDataFrame([(a, b)], "a string, b string")
    rows = fp.with_sketch(fp.with_sketch(both, "a", "x"), "b", "y")
    parts = fp.with_sketch(fp.with_sketch(rows.withColumn("p", F.lit(" ".join(f"w{k}" for k in range(0, 2004)))), "p", "one").withColumn("q", F.lit(" ".join(f"w{k}" for k in range(2000, 4000)))), "q", "two")
    r = parts.select(
        fp.resemblance(F.col("x"), F.col("y")).alias("r"), fp.containment(F.col("x"), F.col("y")).alias("c"), fp.distinct_shingles(F.col("x")).alias("n"),
        (fp.merge(F.col("one"), F.col("two")) == F.col("x")).alias("merged"),
    ).first()
    assert r.merged and abs(r.r - 0.6) < 0.15 and abs(r.c - 0.75) < 0.2 and abs(r.n / 3996 - 1) < 0.3
