from __future__ import annotations

import hashlib
import random

import pytest
import sentencepiece

from llm.odd import documents, empty, rows
from roadpulse.llm import sentence_pieces


@pytest.fixture(scope="module")
def model():
    return sentence_pieces.default_model()


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def test_odd_rows_equal_the_library(spark, model, library):
    docs = documents(spark, extra=True)
    got = sentence_pieces.encode(docs, model, ids="tokens", decoded="back")
    assert got.columns == [*docs.columns, "tokens", "back"]
    for r in got.collect():
        ids = library.encode(r.text or "")
        assert (r.tokens, r.back) == (ids, library.decode(ids))
    texts = [r.text for r in sentence_pieces.decode(got.drop("text"), model, ids="tokens").collect()]
    assert sorted(texts) == sorted(library.decode(library.encode(t or "")) for _, t, *_ in rows())


def test_random_texts_equal_the_library(model, library):
    import numpy as np

    pieces, rng = sentence_pieces.Pieces(model), random.Random(5)
    letters = "ab e\n\tthin▁  .,0é​①中<>/'\x00ing of the 😀ß"
    for k in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(70)))
        text = " " * rng.randrange(40) + text if k % 5 == 0 else text
        ids = np.frombuffer(pieces.encode(text), "<i4").tolist()
        assert ids == library.encode(text)
        assert pieces.decode(ids) == library.decode(ids)
    for _ in range(500):
        ids = [rng.randrange(3, 32000) for _ in range(20)]
        ids = [k for k in ids if not 130 < k < 259]
        assert pieces.decode(ids) == library.decode(ids)


def test_each_prefix_has_one_last_token(model):
    """The table is that of the encodings of all prefixes."""
    import numpy as np

    pieces = sentence_pieces.Pieces(model)
    for word in ("▁internationalisation", "▁▁▁▁unhappily", "▁Größenordnung"):
        ids = [np.frombuffer(pieces._word(word[:k]), "<i4").tolist() for k in range(1, len(word) + 1)]
        for k, found in enumerate(ids):
            rest = len(word[: k + 1]) - len(pieces.texts[found[-1]])
            assert found[:-1] == (ids[rest - 1] if rest else [])


def test_digests(spark, model, library, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in sentence_pieces.op9_sentence_pieces(spark, sf_dir).collect():
        ids = library.encode(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_empty_table(spark, model):
    assert sentence_pieces.digests(empty(spark), model).count() == 0
