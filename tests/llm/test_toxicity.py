from __future__ import annotations

import numpy as np

from llm.odd import documents, empty, prose
from roadpulse.llm import toxicity


def talk(spark, n=240):
    rows = []
    for k in range(n):
        text = prose(100 + k, 30 + k % 60)
        if k % 4 == 0:  # a stem in ever new forms
            words = text.split()
            for at in range(0, len(words), 15):
                words[at] = f"blorg{chr(97 + (k * 7 + at) % 26)}{chr(97 + k % 26)}"
            text = " ".join(words)
        rows.append((k, text, int(k % 4 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_unseen_forms_of_a_stem_are_found(spark):
    rows = talk(spark)
    models = toxicity.train(rows.where("doc_id % 3 <> 0"), rows.select("doc_id", "toxic").where("doc_id % 3 <> 0"))
    got = toxicity.score(rows.where("doc_id % 3 = 0"), models).collect()
    wrong = [r for r in got if (r.score >= 0.5) != (r.toxic == 1)]
    assert len(wrong) <= 0.05 * len(got)


def test_distribution_sums_to_one():
    models = toxicity.Models.fit(["river", "reading", "red", "ridge"], np.array([[9, 1], [4, 4], [7, 0], [2, 9]], float))
    letters = [c for c in models.letters if c]
    for start in ("", "r", "re", "zz"):
        words = [start + c for c in letters]
        codes, place = toxicity.spread(words, models.letters)
        at = np.array([np.flatnonzero(place == k)[len(start)] for k in range(len(words))])
        ends, _ = toxicity.spread([start], models.letters)
        codes = np.r_[codes[at], ends[len(start)]]
        # All letters and the end; what is left is for letters never met.
        total = models._shared(codes).sum()
        assert 0.5 < total <= 1 + 1e-6


def test_every_letter_counts():
    """Words in letters beyond the first thousand, and beyond what a machine word holds, are told apart."""
    for many in (1200, 33_000):
        filler = [chr(0x10000 + k) for k in range(many)]
        words = filler + [chr(0x40000) + chr(0x40001) + chr(0x40002), chr(0x40003) + chr(0x40004) + chr(0x40005)]
        counts = np.array([[1, 1]] * many + [[0, 10**7], [10**7, 0]], float)
        models = toxicity.Models.fit(words, counts)
        bad, good = models.evidence(words[-2:])
        assert len(models.letters) == many + 7 and bad > 0 > good


def test_odd_rows_have_scores(spark):
    rows = talk(spark, 80)
    models = toxicity.train(rows, rows.select("doc_id", "toxic"))
    docs = documents(spark, extra=True)
    got = toxicity.score(docs, models, into="__s")
    assert got.columns == [*docs.columns, "__s"]
    found = got.collect()
    assert len(found) == docs.count() and all(0 <= r["__s"] <= 1 for r in found)
    blank = {r["__s"] for r in found if not (r["text"] or "").strip()}
    assert len(blank) == 1
    assert all(r["size"] == "kept" for r in found)
    # The column asked for takes the place of one of that name.
    assert toxicity.score(docs, models).columns.count("score") == 1


def test_one_class_or_no_rows(spark):
    rows = talk(spark, 40)
    models = toxicity.train(rows, rows.select("doc_id", "toxic").where("toxic = 0"))
    assert {r.score < 0.5 for r in toxicity.score(rows, models).collect()} == {True}
    assert toxicity.score(empty(spark), toxicity.train(empty(spark), rows.select("doc_id", "toxic"))).count() == 0


def test_held_out_accuracy(spark):
    from pyspark.sql import functions as F

    sf_dir = "/root/testdata/sf0.1"
    got = toxicity.op5_toxicity(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = got.where("held_out").join(labels, "doc_id").groupBy("toxic").agg(F.avg("predicted").alias("p"), F.avg("score").alias("s")).collect()
    by = {r["toxic"]: r for r in held}
    assert by[1]["p"] > 0.8 and by[0]["p"] < 0.02 and by[1]["s"] > by[0]["s"] + 0.5
