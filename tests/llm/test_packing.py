from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.llm import packing as p
from tests.llm import odd


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_str(p.default_model())


def whole(tokenizer, texts):
    return [x.ids + [p.END] for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


TRICKY = [
    "ΑΣ ΣΑΣ Σ", "á ́b", "İstanbul ŉ", " x  y\x1c z\x85 w\xa0v", "<|endoftext|> <|startoftext|>x", "don't it'll 'S", "ﬀ ½ 12 34",
    "한국어 가 x", "", "  ", "a​b ﻿ c", "e ̧́ f", "Stone, stone. STONE!? _x_ a_b café, CAFÉ.", "x" * 5000, "end…” «fin.» 你好。再见", "K K ſ,",
    "𝐀, 𐐀. é,", "a.̸ b", "\u0958, \u0130_ \u0130.\u0130",
]


def test_ids_are_the_librarys(tokenizer, sf_dir):
    import pyarrow.parquet as pq

    given = pq.read_table(f"{sf_dir}/documents.parquet").column("text").to_pylist()[:60]
    rng = random.Random(1)
    letters = "\u0958\u1100\u1161aAéÉß'’.,!?-_ 　\n\t1२中<|≯́İΣσς"
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts = TRICKY + given + made
    encoder = p.Encoder(p.default_model())
    for _ in range(2):  # with nothing remembered, then with all
        ids, ends, _ = encoder.encode([(t or "").encode() for t in texts], p.END)
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == whole(tokenizer, texts)


def test_where_sentences_end():
    encoder = p.Encoder(p.default_model())
    ids, ends, sentences = encoder.encode([b"One two. Three! \"Four?\" five 3.5 six"], p.END)
    words = ["one", "two", ".", "three", "!", '"', "four", '?"', "five", "3", ".", "5", "six"]
    assert len(ids) == len(words) + 1 and sentences.tolist() == [3, 5, 8]


def best(at, cost, width):
    """The least total over all choices of cuts, by trying each."""
    inner = range(1, len(at) - 1)
    totals = []
    for k in range(len(at) - 1):
        for chosen in itertools.combinations(inner, k):
            marks = [0, *chosen, len(at) - 1]
            if all(at[y] - at[x] <= width for x, y in zip(marks, marks[1:])):
                pad = sum(p.padding(int(at[y] - at[x]), width) for x, y in zip(marks, marks[1:]))
                totals.append(pad + sum(int(cost[m]) for m in chosen))
    return min(totals)


@pytest.mark.parametrize("seed", range(60))
def test_cuts_are_the_best_there_are(seed):
    rng = random.Random(seed)
    width = rng.choice([4, 8, 16])
    total = rng.randrange(2, 40)
    documents = np.array(sorted({total, *(rng.randrange(1, total + 1) for _ in range(3))}))
    sentences = np.array(sorted({rng.randrange(1, total + 1) for _ in range(4)}))
    at, cost = p.places(total, documents, sentences, width)
    assert np.diff(at).max() <= width and at[0] == 0 and at[-1] == total
    at, cost = at[:13], cost[:13]  # as many as can be tried
    found = p.cuts(at, cost, width)
    price = dict(zip(at.tolist(), cost.tolist()))
    spent = sum(p.padding(y - x, width) for x, y in zip(found, found[1:])) + sum(price[m] for m in found[1:-1])
    assert all(y - x <= width for x, y in zip(found, found[1:]))
    assert spent == best(at, cost, width)


def test_padding_of_lengths():
    assert [p.padding(n) for n in (1, 2, 3, 1024, 1500, 2047, 2048)] == [0, 0, 2045, 0, 548, 1, 0]


def check(rows, texts_by_doc, tokenizer, width=p.WIDTH):
    """Pieces hold each document's ids once, in order; sequences are gapless and fit."""
    ids = {doc: whole(tokenizer, [t])[0] for doc, t in texts_by_doc.items()}
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == set(ids)
    for doc, mine in pieces.items():
        mine.sort(key=lambda r: r["start"])
        at = 0
        for r in mine:
            part = ids[doc][r["start"] : r["start"] + r["length"]]
            assert r["start"] == at and r["length"] == len(part) > 0 and r["doc_tokens"] == len(ids[doc])
            assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids[doc])
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
    padded = total = 0
    for mine in sequences.values():
        mine.sort(key=lambda r: r["offset"])
        at = 0
        for r in mine:
            assert r["offset"] == at
            at += r["length"]
        assert at <= width
        padded, total = padded + p.padding(at, width), total + at
    return padded / total, len(sequences)


def test_the_query(spark, sf_dir, tokenizer):
    rows = p.op13_packing(spark, sf_dir).collect()
    given = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    share, _ = check(rows, given, tokenizer)
    assert share < 0.02
    # Order is kept: sequences follow the documents' ids.
    order = sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))
    assert [r["doc_id"] for r in order] == sorted(r["doc_id"] for r in rows)


def packed(frame, width=p.WIDTH):
    return p.pack(frame, p.default_model(), width).withColumn("ids_crc32", F.crc32("ids")).collect()


@pytest.mark.parametrize("stretch", [100, 5000, 10**6])
def test_stretches_settle_alike(tokenizer, stretch, sf_dir):
    import pyarrow.parquet as pq

    given = [(t or "") for t in pq.read_table(f"{sf_dir}/documents.parquet").column("text").to_pylist()]
    encoder, stream, pieces = p.Encoder(p.default_model()), p.Stream(512, stretch), []
    for k in range(0, len(given), 17):
        part = given[k : k + 17]
        pieces += stream.add(list(range(k, k + len(part))), *encoder.encode([t.encode() for t in part], p.END))
    pieces += stream.settle(True)
    rows = [
        {"doc_id": d, "start": s, "length": len(x), "ids_crc32": zlib.crc32(x.tobytes()), "doc_tokens": n, "sequence_id": q, "offset": o}
        for d, s, x, n, q, o in pieces
    ]
    share, _ = check(rows, dict(enumerate(given)), tokenizer, 512)
    assert share < 0.05


def test_odd_documents(spark, tokenizer):
    rows = packed(odd.documents(spark, extra=True), 128)
    tokens = sum(len(x) for x in whole(tokenizer, [r[1] for r in odd.rows()]))
    assert sum(r["length"] for r in rows) == tokens
    assert {r["doc_id"] for r in rows} == {r[0] for r in odd.rows()}
    (null,) = [r for r in rows if r["doc_id"] == 0]
    assert (null["start"], null["length"], null["doc_tokens"]) == (0, 1, 1)
    first = min(rows, key=lambda r: (r["sequence_id"], r["offset"]))
    assert first["doc_id"] is None


def test_nothing(spark):
    assert packed(odd.empty(spark)) == []


def test_equal_rows_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(p, "RANGE_BYTES", 2000)
    text = "one two three. " * 20
    frame = spark.createDataFrame([(7, text)] * 200 + [(None, None)] * 5, "doc_id long, text string").repartition(4)
    rows = packed(frame)
    tasks = {r["sequence_id"] >> 33 for r in rows}
    assert len(tasks) > 10 and sum(r["start"] == 0 for r in rows) == 205
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
