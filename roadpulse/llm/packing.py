"""Documents packed into training sequences of a fixed width, in order, by dynamic programming.

Documents in ascending order of their ids make one stream of tokens, cut into windows of at most ``WIDTH``. Cuts may be
made at the end of a document (free), at the end of a sentence or, where neither is near, inside one; the last two cost
as much as so many tokens of padding. A window that is no power of two long is padded to the width. The least total of
padding and penalties over all choices of cuts is

    cost(i) = penalty(i) + min over j, at most WIDTH tokens back, of cost(j) + padding(i - j)

As padding falls linearly in i - j, the minimum of cost(j) + place(j) over a sliding span is enough, which a monotone queue
keeps; the few j that are just a power of two back are compared beside it. Each place is visited once.

Documents are range-partitioned by id; a task packs its range as one stream, holding a bounded stretch of it: windows are
settled up to shortly before the stretch's end, and the rest is carried on. Only the last window of a range is padded
for want of tokens. Texts are encoded by their white-space separated words, across which the tokenizer never merges;
workers remember a bounded number of them.

Defined results: a null or empty text is its end id alone; rows without an id come first; repeated rows are packed each,
rows of equal ids in the order of a hash of their text, equal rows in that of the input, and however many there are they
spread over tasks; a very long text fills many sequences; an empty table makes none. Columns other than doc_id and text
play no part.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import uuid
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadpulse.llm.common import ready, table
from roadpulse.llm.words import Words, spans

WIDTH = 2048
END = 1
#: What a cut costs, in tokens of padding.
SENTENCE, INSIDE = 4, 48
#: Places inside a sentence where it may be cut are this many tokens apart.
STEP = 128
#: Bytes of text to a task, tokens that a task holds before it settles windows, about.
RANGE_BYTES = 12_000_000
STRETCH = 1_000_000
#: Texts of a stretch that are encoded together, in bytes.
BLOCK = 4_000_000
#: Words remembered per worker, and the longest of them.
REMEMBERED = 500_000
LONGEST = 64
MOST_SIGNS = 10_000
#: ASCII white space, as spaces.
_SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
#: Letters, ASCII signs that are no apostrophe.
_SHAPE = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]{1,8})")
#: What marks the end of a text among its words: no text has this byte.
_END = b"\xff"
_BETWEEN = b" " + _END + b" "
#: One sign behind a letter, before a space.
_BEHIND = r"([a-z])([.,;:!?]) "
#: A word that ends a sentence: a sign, then closing signs. Fixed values.
_ENDS = re.compile(rb"(?:[.!?]|\xe2\x80\xa6|\xe3\x80\x82)(?:[\"')\]]|\xc2\xbb|\xe2\x80[\x99\x9d])*\Z")


def _parted(word: str) -> re.Match | None:
    """The letters of a word and the signs behind them, unless the tokenizer sees a mark between the two: it normalises
    a few letters to a letter and a mark, which signs are joined to."""
    m = _SHAPE.fullmatch(word)
    return m if m and (m[1].isascii() or unicodedata.normalize("NFC", m[1]).lower()[-1].isalpha()) else None


class Encoder:
    """One tokenizer with the words it has met.

    It never joins letters with other signs, so a sign behind a letter is taken as a word of its own; and it ends each run
    of letters with a token of its own kind, so that many runs are encoded as one text."""

    def __init__(self, model: str, most: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.words, self.signs = Words(most, LONGEST), {}
        suffix = json.loads(model)["model"]["end_of_word_suffix"]
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[k for token, k in vocabulary.items() if token.endswith(suffix)]] = True

    def _each(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _joined(self, runs: list[str]) -> list[bytes]:
        """Ids of runs of letters. Should one be more than one run to the tokenizer, each is encoded alone."""
        if not runs:
            return []
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(runs)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(runs) or ends[-1] != len(ids):
            return self._each(runs)
        data, ends = ids.tobytes(), (ends * 4).tolist()
        return [data[x:y] for x, y in zip([0, *ends[:-1]], ends)]

    def _learn(self, words: list[bytes], end: int) -> None:
        named = [w.decode() if w != _END else "" for w in words]
        shapes = [w if w.isalpha() else _parted(w) for w in named]
        runs = iter(self._joined([m if type(m) is str else m[1] for m in shapes if m]))
        others = iter(self._each([w for w, m in zip(named, shapes) if not m]))
        ids = [next(others) if not m else next(runs) if type(m) is str else next(runs) + self._sign(m[2]) for m in shapes]
        # Letters never end a sentence.
        stops = [type(m) is not str and _ENDS.search(w) is not None for w, m in zip(words, shapes)]
        self.words.learn(words, [np.array([end], "<u4").tobytes() if w == _END else x for w, x in zip(words, ids)], stops)

    def _sign(self, signs: str) -> bytes:
        if signs not in self.signs:
            if len(self.signs) > MOST_SIGNS:
                self.signs.clear()
            self.signs[signs] = self._each([signs])[0]
        return self.signs[signs]

    def encode(self, texts: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts one after another, each with its end; where each text ends; where sentences within end."""
        self.words.shrink()
        # A to Z are lower-cased as the tokenizer does.
        data = (_BETWEEN.join(texts) + _BETWEEN).lower().translate(_SPACES)
        data = pc.replace_substring_regex(pa.array([data], pa.large_binary()), _BEHIND, r"\1 \2 ")
        words = pc.split_pattern(data, b" ").flatten().dictionary_encode()
        place, kinds = words.indices.to_numpy(), words.dictionary.to_pylist()
        known = self.words.find(kinds)
        fresh = np.flatnonzero(known < 0)
        if len(fresh):
            self._learn([kinds[k] for k in fresh.tolist()], end)
            known[fresh] = np.arange(len(self.words.size) - len(fresh), len(self.words.size))
        size, stops = self.words.size[known], self.words.stops[known]
        lengths = size[place]
        upto = np.cumsum(lengths)
        ids = self.words.ids[spans(self.words.first[known][place], lengths)]
        return ids, upto[place == kinds.index(_END)], upto[stops[place]]


def padding(length: int, width: int = WIDTH) -> int:
    """What a window of that many tokens is padded by."""
    return 0 if length & (length - 1) == 0 else width - length


def places(total: int, documents: np.ndarray, sentences: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Where a stream of ``total`` tokens may be cut, from 0 on, and what each cut costs. Sentences of more than
    ``STEP`` tokens may be cut inside, at every ``STEP``."""
    step = min(STEP, width)
    least = np.full(total + 1, INSIDE + 1, np.int64)
    known = np.unique(np.concatenate([[0, total], documents, sentences]))
    gaps = np.diff(known)
    inside = (gaps - 1) // step
    start, k = np.repeat(known[:-1], inside), np.arange(inside.sum()) - np.repeat(np.cumsum(inside) - inside, inside)
    least[start + (k + 1) * step] = INSIDE
    least[sentences] = SENTENCE
    least[documents] = 0
    least[[0, total]] = 0
    at = np.flatnonzero(least <= INSIDE)
    return at, least[at]


def cuts(at: np.ndarray, cost: np.ndarray, width: int = WIDTH) -> list[int]:
    """The places of ``at`` (ascending, from 0 to the stream's end, no two more than ``width`` apart) that windows begin
    and end at, by the least total of padding and of ``cost``."""
    n = len(at)
    # Places just a power of two back, by the place they are counted from.
    powers: list[list[int]] = [[] for _ in range(n)]
    p = 1
    while p <= width:
        back = np.searchsorted(at, at - p)
        for i in np.flatnonzero(at[back] == at - p).tolist():
            powers[i].append(int(back[i]))
        p *= 2
    where, price = at.tolist(), cost.tolist()
    total, came = [0] * n, [0] * n
    queue: deque[tuple[int, int]] = deque()
    for i in range(1, n):
        here = where[i]
        # The last place joins the queue, in which cost + place rises.
        key = total[i - 1] + where[i - 1]
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, i - 1))
        while where[queue[0][1]] < here - width:
            queue.popleft()
        key, j = queue[0]
        best = key + width - here
        for other in powers[i]:
            if total[other] <= best:
                best, j = total[other], other
        total[i], came[i] = best + price[i], j
    chain = [n - 1]
    while chain[-1]:
        chain.append(came[chain[-1]])
    return [where[k] for k in reversed(chain)]


class Stream:
    """One task's documents as they come, and the windows made of them."""

    def __init__(self, width: int = WIDTH, stretch: int = STRETCH):
        self.width, self.stretch = width, stretch
        self.ids, self.held = [np.zeros(0, "<u4")], 0
        self.sentences: list[np.ndarray] = []
        # Documents not yet settled: name, tokens in all, tokens before those held, where it ends among those held.
        self.documents: list[tuple[object, int, int, int]] = []
        self.sequence = 0

    def add(self, names: list, ids: np.ndarray, ends: np.ndarray, sentences: np.ndarray) -> Iterator[tuple]:
        base = self.held
        starts = np.r_[0, ends[:-1]]
        self.documents += [(name, y - x, 0, base + y) for name, x, y in zip(names, starts.tolist(), ends.tolist())]
        self.ids.append(ids)
        self.sentences.append(sentences + base)
        self.held += len(ids)
        if self.held >= self.stretch:
            yield from self.settle(False)

    def settle(self, last: bool) -> Iterator[tuple]:
        """Pieces (name, start, ids, tokens of the document, sequence, offset), but for the last windows if more comes."""
        if not self.held:
            return
        ids = np.concatenate(self.ids)
        ends = np.array([d[3] for d in self.documents], np.int64)
        sentences = np.concatenate([np.zeros(0, np.int64), *self.sentences])
        found = cuts(*places(len(ids), ends, sentences, self.width), self.width)
        if not last:
            # What follows may change the choice of cuts near the end, hardly one so far before it.
            while len(found) > 2 and found[-1] > len(ids) - 8 * self.width:
                found.pop()
        done = found[-1]
        marks = np.unique(np.r_[found, ends[ends <= done]])
        owner = np.searchsorted(ends, marks[:-1], "right").tolist()
        window = (np.searchsorted(found, marks[:-1], "right") - 1).tolist()
        for x, y, d, w in zip(marks[:-1].tolist(), marks[1:].tolist(), owner, window):
            name, tokens, before, end = self.documents[d]
            start = tokens - (end - x)
            yield name, start, ids[x:y], tokens, self.sequence + w, x - found[w]
        self.sequence += len(found) - 1
        first = int(np.searchsorted(ends, done, "right"))
        self.documents = [(name, tokens, before, end - done) for name, tokens, before, end in self.documents[first:]]
        self.ids, self.held = [ids[done:].copy()], len(ids) - done
        self.sentences = [sentences[sentences > done] - done]


_encoders: dict[str, Encoder] = {}


def _loaded(name: str, model: str) -> Encoder:
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(model)
    return _encoders[name]


def _batch(pieces: list[tuple], first: int) -> pa.RecordBatch:
    name, start, ids, tokens, sequence, offset = zip(*pieces)
    columns = {
        "doc_id": pa.array(name, pa.int64()),
        "start": pa.array(start, pa.int64()),
        "length": pa.array([len(x) for x in ids], pa.int64()),
        "ids": pa.array([x.tobytes() for x in ids], pa.binary()),
        "doc_tokens": pa.array(tokens, pa.int64()),
        "sequence_id": pa.array([first + s for s in sequence], pa.int64()),
        "offset": pa.array(offset, pa.int64()),
    }
    return pa.RecordBatch.from_pydict(columns)


def pack(documents: DataFrame, model: str, width: int = WIDTH, end: int = END) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): the pieces of ``documents`` (doc_id, text) with their
    ids as little-endian unsigned 32-bit integers. Sequence ids rise with the documents' ids, with gaps between tasks."""
    spark = ready(documents.sparkSession)
    shared, key = spark.sparkContext.broadcast(model), uuid.uuid4().hex
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = rows.withColumn("turn", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("turn")]
    ranges = rows.repartitionByRange(1 + size // RANGE_BYTES, *order).sortWithinPartitions(*order).drop("turn")

    def run(batches):
        encoder, stream = _loaded(key, shared.value), Stream(width)
        first = TaskContext.get().partitionId() << 33
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            k = 0
            while k < len(texts):
                start, taken = k, 0
                while k < len(texts) and taken <= BLOCK:
                    taken += len(texts[k])
                    k += 1
                pieces = list(stream.add(names[start:k], *encoder.encode(texts[start:k], end)))
                for at in range(0, len(pieces), 5000):
                    yield _batch(pieces[at : at + 5000], first)
        pieces = list(stream.settle(True))
        for at in range(0, len(pieces), 5000):
            yield _batch(pieces[at : at + 5000], first)

    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return ranges.mapInArrow(run, schema)


def default_model() -> str:
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), default_model())
    crc = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")


QUERIES = {"op13_packing": op13_packing}
ORACLES: dict[str, str] = {}
