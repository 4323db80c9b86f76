from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.llm import collocations as c
from tests.llm import odd

SCHEMA = "doc_id long, text string, lang string"


def counted(rows, longest=4):
    """(lang, phrase) -> count and lang -> words, by plain loops."""
    phrases, words = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            found = re.findall("[^\x20\x09]+", piece)
            words[lang] += len(found)
            for i in range(len(found)):
                for k in range(1, min(longest, len(found) - i) + 1):
                    phrases[lang, " ".join(found[i : i + k])] += 1
    return phrases, words


def plain(rows, least, top):
    phrases, words = counted(rows)
    kept = {k: n for k, n in phrases.items() if n >= least and " " in k[1]}
    found = []
    for (lang, phrase), a in kept.items():
        parts = phrase.split(" ")
        cuts = []
        for k in range(1, len(parts)):
            left, right = phrases[lang, " ".join(parts[:k])], phrases[lang, " ".join(parts[k:])]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        held = any(
            other == lang and len(longer.split(" ")) > len(parts) and f" {phrase} " in f" {longer} " and 100 * n >= 80 * a
            for (other, longer), n in kept.items()
        )
        if not held:
            found.append((lang, -score, -a, phrase.encode(), left, right))
    ranked, place = [], Counter()
    for lang, score, a, phrase, left, right in sorted(found):
        place[lang] += 1
        if place[lang] <= top:
            ranked.append((lang, place[lang], phrase.decode(), -a, left, right, words[lang], -score))
    return ranked


def texts(seed, n, words=12, size=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(words)] + ["Ümit", "X", "中文", "new york", "a b"]
    signs = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "! "]
    made = []
    for k in range(n):
        text = "".join(rng.choice(vocabulary) + rng.choice(signs) for _ in range(rng.randrange(size)))
        made.append((text, rng.choice(["en", "de", None])))
    return made


def frame(spark, rows):
    return spark.createDataFrame([(k, t, lang) for k, (t, lang) in enumerate(rows)], SCHEMA)


def answers(result):
    return sorted(tuple(r) for r in result.collect())


def test_equals_plain_loops(spark):
    rows = texts(1, 300)
    assert answers(c.collocations(frame(spark, rows).repartition(7), 5, 40)) == sorted(plain(rows, 5, 40))


def test_tiny_tables_burst_and_spill(spark, monkeypatch):
    """Each limit so low that every path is taken; counts stay exact."""
    rows = texts(2, 200, words=30)
    wanted, _ = counted(rows)
    bits = np.full(c.FILTER >> 6, -1, np.int64)  # everything may be frequent
    for low, high, block in ((1, 1, 50), (2, 2, 50), (3, 4, 50), (3, 4, 10**6)):
        monkeypatch.setattr(c, "BLOCK", block)
        counter = c.Counter(low, high, None if high == 1 else bits, burst=3, entries=20, words=25)
        found, runs = Counter(), 0
        for lang in ("en", "de", None):
            mine = [(t or "").encode() for t, name in rows if name == lang]
            for batch in counter.add("und" if lang is None else lang, mine):
                runs += 1
                run = [(r["lang"], r["phrase"].encode().split(b" ")) for r in batch.to_pylist() if r["phrase"] is not None]
                assert run == sorted(run)
                for r in batch.to_pylist():
                    found[r["lang"], r["phrase"]] += r["n"]
        for batch in counter.flush():
            for r in batch.to_pylist():
                found[r["lang"], r["phrase"]] += r["n"]
        if high > 1:
            assert runs >= 3
        # Windows add up to the phrases they begin with.
        upto = Counter()
        for (lang, phrase), n in found.items():
            if phrase is not None:
                words = phrase.split(" ")
                for k in range(low, len(words) + 1):
                    upto[lang, " ".join(words[:k])] += n
        assert upto == Counter({k: n for k, n in wanted.items() if low <= len(k[1].split(" ")) <= high})


def test_one_long_piece_is_taken_in_blocks(monkeypatch):
    monkeypatch.setattr(c, "BLOCK", 40)
    rng = random.Random(4)
    text = " ".join(rng.choice(["aa", "b", "cccc", "d" * 50]) for _ in range(500))
    blocks = list(c._blocks(text.encode()))
    assert len(blocks) > 10 and b"".join(data for data, _ in blocks) == text.encode()
    bits = np.full(c.FILTER >> 6, -1, np.int64)
    counter = c.Counter(3, 4, bits)
    list(counter.add("en", [text.encode()]))
    found = Counter()
    for batch in counter.flush():
        for r in batch.to_pylist():
            found[r["phrase"]] += r["n"]
    words = text.split(" ")
    assert found == Counter(" ".join(words[i : i + 4]) for i in range(len(words) - 2))


def test_odd_documents(spark):
    rows = [(r[1], r[2]) for r in odd.rows()] * 3
    docs = odd.documents(spark, extra=True)
    docs = docs.unionByName(docs).unionByName(docs)
    assert answers(c.collocations(docs, 3, 50)) == sorted(plain(rows, 3, 50))


def test_nothing(spark):
    assert c.collocations(odd.empty(spark)).count() == 0
    blank = frame(spark, [("", "en"), (None, "de"), (" \n\t. ", None)])
    assert c.collocations(blank, 1).count() == 0


def test_ties_and_drops_by_the_rules(spark):
    rows = [("a b c d", "en")] * 10 + [("a b", "en")] * 2 + [("x y", "en")] * 10 + [("Y Z", "en")] * 10
    found = answers(c.collocations(frame(spark, rows), 5, 10))
    assert found == sorted(plain(rows, 5, 10))
    assert [r[2] for r in sorted(found, key=lambda r: r[1])][0] == "a b c d"
    assert "b c" not in {r[2] for r in found}  # in a longer one with its count
    assert "a b" not in {r[2] for r in found}  # 10 of 12 are in the longer one
    assert {"x y", "y z"} <= {r[2] for r in found}


def test_a_very_frequent_word_and_pair(spark):
    rng = random.Random(5)
    rows = [("the same " + " ".join(f"v{rng.randrange(50)}" for _ in range(5)), "en") for _ in range(3000)]
    assert answers(c.collocations(frame(spark, rows), 8, 100)) == sorted(plain(rows, 8, 100))


def test_scores_beyond_64_bits(spark):
    big = 5 * 10**17
    phrases = spark.createDataFrame(
        [("en", "a", 1, big + 7), ("en", "b", 1, 2 * big), ("en", "a b", 2, big)], "lang string, phrase string, size int, n long"
    )
    (row,) = c.scored(phrases).collect()
    assert row["score"] == 2_000_000 * big // (3 * big + 7)
    assert c.without_parts(phrases.where("size > 1").withColumnRenamed("n", "a")).count() == 1


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    rows = texts(6, 150)
    monkeypatch.setattr(c, "FILTER", 64)
    assert answers(c.collocations(frame(spark, rows), 4, 60)) == sorted(plain(rows, 4, 60))


@pytest.mark.parametrize("extra", ["rank", "phrase", "n", "a", "size", "k", "left", "words"])
def test_columns_with_clashing_names(spark, extra):
    rows = texts(7, 60)
    assert answers(c.collocations(frame(spark, rows).withColumn(extra, F.lit(1)), 4, 20)) == sorted(plain(rows, 4, 20))
