from __future__ import annotations

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from llm.odd import documents, empty
from roadpulse.llm import token_files
from roadpulse.llm.common import fresh_dir


@pytest.fixture(scope="module")
def model():
    return token_files.default_model()


@pytest.fixture(scope="module")
def library(model):
    return Tokenizer.from_str(model)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [token_files.END]


@pytest.fixture(scope="module")
def written(spark, model):
    folder = fresh_dir(spark, "test-tokens")
    token_files.write(documents(spark, extra=True), model, folder)
    token_files.index(spark, folder)
    return folder


def test_files_hold_all_rows_in_order(spark, written, library):
    rows = token_files.read(spark, written).collect()
    want = sorted(((r.doc_id is not None, r.doc_id or 0), ids_of(library, r.text)) for r in documents(spark).collect())
    got = [((r.doc_id is not None, r.doc_id or 0), r.ids) for r in rows]
    assert sorted(got) == want and [k for k, _ in got] == [k for k, _ in want]
    assert [r.start for r in rows] == np.cumsum([0, *(len(r.ids) for r in rows)])[:-1].tolist()


def test_shuffled_reads_are_the_same_rows(spark, written):
    plain = [(r.doc_id, r.start, r.ids) for r in token_files.read(spark, written).collect()]
    one, same, other = ([(r.doc_id, r.start, r.ids) for r in token_files.read(spark, written, s).collect()] for s in (1, 1, 2))
    assert one == same != other and one != plain
    assert sorted(one, key=lambda r: r[1]) == plain


def test_index_matches_records(spark, written, library):
    texts = {r.doc_id: r.text for r in documents(spark).collect() if r.doc_id is not None}
    for r in spark.read.parquet(f"{written}/index").collect():
        if r.doc_id in texts:
            ids = np.array(ids_of(library, texts[r.doc_id]), "<u4")
            assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


def test_damage_is_an_error():
    record = token_files.framed(7, np.array([1, 2, 70000], "<u4")) + b"\n"
    assert token_files.unframed(record, 0)[0] == 7 and token_files.unframed(record, 0)[1].tolist() == [1, 2, 70000]
    assert token_files.unframed(record, 0)[2] == len(record)
    for k in range(len(record) - 1):
        broken = bytearray(record)
        broken[k] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            token_files.unframed(bytes(broken), 0)


def test_records_with_line_feeds_survive(spark, model):
    """Ids and lengths may hold the byte that ends a record."""
    docs = spark.createDataFrame([(10, "\n" * 10), (2570, "a\nb" * 400)], "doc_id long, text string")
    folder = fresh_dir(spark, "test-feeds")
    token_files.write(docs, model, folder)
    assert [r.doc_id for r in token_files.index(spark, folder).orderBy("start").collect()] == [10, 2570]


def test_cut_pieces_encode_as_whole_texts(model, library):
    import random

    encoder, rng = token_files.Encoder(model), random.Random(9)
    letters = ["a", " ", "  ", "\n", " the", "'s", "é", "中", "\t", "\x1c", "\xa0", "\u2003", "<|endoftext|>", " 12", "!?", "x" * 70]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(3000)]
    for k in range(0, 3000, 300):
        for text, ids in zip(texts[k : k + 300], encoder.encode(texts[k : k + 300])):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_pieces_that_the_pattern_leaves_whole_skip_the_tokenizer(model, library):
    """They go to the model alone, which gives the same ids; before, each was a string with offsets in the tokenizer."""
    encoder, sent = token_files.Encoder(model), []
    in_one = encoder._in_one
    encoder._in_one = lambda pieces: sent.extend(pieces) or in_one(pieces)
    whole = ["thonouin", "été", "Straße", "Œuvre", "2048", "x" * 200, "ſ", "ÿ"]
    others = ["it's", "a1", "×", "÷", "ª", "²", "don\nt", "中文", "e\u0301", "a<|endoftext|>", "\x00", "\xad", "."]
    for words in (whole, others, whole + others, others[::-1] + whole):
        text = "a " + " ".join(words)
        assert encoder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert not {w.encode() for w in whole} & set(sent) and {w.encode() for w in others} <= set(sent)


def test_letters_of_all_bytes(model):
    from tokenizers.pre_tokenizers import ByteLevel

    assert sorted(token_files._signs()) == sorted(ByteLevel.alphabet())
    before = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str("é ÿ\t\xad~")
    assert "".join(x for x, _ in before) == "é ÿ\t\xad~".encode().decode("latin-1").translate(token_files._signs())


def test_query(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in token_files.op2_token_files(spark, sf_dir).collect()}
    start = 0
    for d in docs:
        ids = np.array(ids_of(library, d.text), "<u4")
        r = got[d.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_empty_table(spark, model):
    folder = fresh_dir(spark, "test-none")
    token_files.write(empty(spark), model, folder)
    assert token_files.index(spark, folder).count() == 0
    assert token_files.read(spark, folder, 3).count() == 0
