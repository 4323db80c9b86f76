"""SentencePiece encoding and decoding by a merge-type prefix table.

Every prefix of a text has one last token in its byte-pair encoding. So the encoding needs no merging: an automaton
finds the pieces that end at each place, left to right, and a piece is the last token there if it is compatible with
the last token of the prefix before it. From the table of last tokens the ids are recovered backwards. Two tokens are
compatible if no merge crosses their border: on either side of it the letters grow into the two tokens through a fixed
series of merges, so it is enough to compare the ranks of these with the ranks of merges across.

No piece has the space mark after another letter, so a text is encoded word by word and words are remembered with
their ids, a bounded number on each worker. Letters without a piece become bytes, as the model says.

Results are those of the sentencepiece library for models of the kind BPE with identity normalisation, dummy prefix and
byte fallback; other models are refused. Defined results: a null or empty text has no ids and decodes to the empty
text; repeated rows are encoded alike; other columns are carried through untouched.
"""

from __future__ import annotations

import re
import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from roadpulse.llm.common import Remembered, ready, table, takes_over

MARK = "▁"
#: Words remembered per worker and generation; longer words are encoded each time.
REMEMBERED = 200_000
LONGEST = 64
#: Pairs of tokens remembered, then forgotten together.
PAIRS = 1_000_000
_CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class Pieces:
    """Vocabulary and merge ranks of one model."""

    def __init__(self, model: bytes):
        lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        every = range(lib.vocab_size())
        self.texts = [lib.id_to_piece(k) for k in every]
        plain = [k for k in every if not (lib.is_control(k) or lib.is_unknown(k) or lib.is_byte(k) or lib.is_unused(k))]
        self.bytes = {int(self.texts[k][3:5], 16): k for k in every if lib.is_byte(k)}
        self.byte_of = {k: b for b, k in self.bytes.items()}
        self.ids = {self.texts[k]: k for k in plain}
        # What each id shows: a byte below 128 is a letter of its own, the others are letters only together.
        self.shown = ["" if lib.is_control(k) else " ⁇ " if lib.is_unknown(k) else p for k, p in enumerate(self.texts)]
        for b, k in self.bytes.items():
            self.shown[k] = chr(b)
        self.special = {k for b, k in self.bytes.items() if b > 127}
        self.letters = {p for p in self.ids if len(p) == 1}
        scores = sorted({lib.get_score(k) for k in plain if len(self.texts[k]) > 1}, reverse=True)
        order = {s: r for r, s in enumerate(scores)}
        self.rank = {p: order[lib.get_score(k)] if len(p) > 1 else -1 for p, k in self.ids.items()}
        self._check(lib)
        # How each piece is made: its last merge. Pieces that merging never makes are no candidates.
        self.halves: dict[str, tuple[str, str]] = {}
        finder = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for p in self.ids:
            series = self.merged(list(p), halves := {})
            if series == [p]:
                self.halves |= {p: halves[p]} if len(p) > 1 else {}
                finder.add_word(p, self.ids[p])
        finder.make_automaton()
        self.finder = finder
        self.lengths = [*map(len, self.texts)]
        #: By the two ids in one number.
        self.compatible: dict[int, bool] = {}
        self.words = Remembered(REMEMBERED, LONGEST)

    def _check(self, lib) -> None:
        fits = (
            len(self.bytes) == 256
            and all(set(p) <= self.letters for p in self.ids)
            and not any(MARK in p.lstrip(MARK) for p in self.ids)
            and [lib.id_to_piece(k) for k in lib.encode(" ﬁ ")] == [lib.id_to_piece(k) for k in self._probe(lib)]
        )
        if not fits:
            raise ValueError("the model isn't BPE with byte fallback, dummy prefix and identity normalisation")

    @staticmethod
    def _probe(lib) -> list[int]:
        back = lib.encode(lib.decode(lib.encode(" ﬁ ")))
        return back if lib.decode(back) == " ﬁ " else []

    def merged(self, parts: list[str], halves: dict) -> list[str]:
        """Merging by rank, leftmost first; ``halves`` gets the two parts of each piece made."""
        while True:
            best = min(((self.rank[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.rank), default=None)
            if best is None:
                return parts
            k = best[1]
            halves[parts[k] + parts[k + 1]] = (parts[k], parts[k + 1])
            parts = [*parts[:k], parts[k] + parts[k + 1], *parts[k + 2 :]]

    def fits(self, a: str, b: str) -> bool:
        """Whether the border of two adjacent tokens outlasts all merges."""
        if a[-1] == MARK == b[0]:  # runs of the mark all have one rank: order decides
            return self.merged([*a, *b], {}) == [a, b]
        rank, halves = self.rank, self.halves
        left, above_left = a, 1 << 60
        while True:
            right, above_right = b, 1 << 60
            while True:
                r = rank.get(left + right)
                if r is not None and rank[left] < r < above_left and rank[right] < r <= above_right:
                    return False
                if len(right) == 1:
                    break
                above_right, right = rank[right], halves[right][0]
            if len(left) == 1:
                return True
            above_left, left = rank[left], halves[left][1]

    def _known(self, text: str) -> list[int]:
        """Ids of a text all of whose letters have pieces."""
        last = [-1] * (len(text) + 1)
        compatible, lengths = self.compatible, self.lengths
        for end, piece in self.finder.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            start = end - lengths[piece]
            if start:
                pair = last[start] << 20 | piece
                fits = compatible.get(pair)
                if fits is None:
                    fits = compatible[pair] = self.fits(self.texts[last[start]], self.texts[piece])
                if not fits:
                    continue
            last[end] = piece
        found, at = [], len(text)
        while at:
            found.append(last[at])
            at -= lengths[last[at]]
        found.reverse()
        return found

    def _word(self, word: str) -> bytes:
        if self.letters.issuperset(word):
            return np.array(self._known(word), "<i4").tobytes()
        found, run = [], ""
        for c in word:
            if c in self.letters:
                run += c
            else:
                found += self._known(run) + [self.bytes[b] for b in c.encode("utf-8", "surrogatepass")]
                run = ""
        return np.array(found + self._known(run), "<i4").tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if not text:
            return b""
        if len(self.compatible) > PAIRS:
            self.compatible.clear()
        parts = _CHUNK.findall(MARK + text.replace(" ", MARK))
        fresh = self.words.missing(set(parts))
        if fresh:
            self.words.learn(fresh, [*map(self._word, fresh)])
        return b"".join(map(self.words.now.__getitem__, parts))

    def decode(self, ids: list[int]) -> str:
        if self.special.isdisjoint(ids):
            text = "".join(map(self.shown.__getitem__, ids))
        else:
            parts, run = [], bytearray()
            for k in ids:
                if k in self.byte_of:
                    run.append(self.byte_of[k])
                else:
                    parts += [run.decode("utf-8", "replace"), self.shown[k]]
                    run = bytearray()
            text = "".join(parts) + run.decode("utf-8", "replace")
        return text.replace(MARK, " ").removeprefix(" ")


_models: dict[str, Pieces] = {}


def _loaded(name: str, model: bytes) -> Pieces:
    takes_over("sentence_pieces", _models.clear)
    if name not in _models:
        _models.clear()
        _models[name] = Pieces(model)
    return _models[name]


def _lists(parts: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)]) // 4
    values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def encode(documents: DataFrame, model: bytes, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``documents`` with the column ``ids`` (array of int) and, if named, the text that these ids decode to."""
    ready(documents.sparkSession)
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType()))] + [T.StructField(decoded, T.StringType())] * bool(decoded)
    fresh = [f.name for f in fields]
    schema = T.StructType([f for f in documents.schema.fields if f.name not in fresh] + fields)
    shared, name = documents.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches):
        pieces = _loaded(name, shared.value)
        for whole in batches:
            # Ids of a slice together stay well below Arrow's 32-bit offsets, and memory below a slice's share.
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                found = [pieces.encode(t) for t in batch.column(text).to_pylist()]
                columns = [batch.column(f.name) for f in schema.fields[: -len(fields)]] + [_lists(found)]
                if decoded:
                    columns.append(pa.array([pieces.decode(np.frombuffer(x, "<i4").tolist()) for x in found], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return documents.mapInArrow(run, schema)


def decode(rows: DataFrame, model: bytes, ids: str = "ids", text: str = "text") -> DataFrame:
    """``rows`` with the column ``text`` that the ids decode to; null ids decode to the empty text."""
    ready(rows.sparkSession)
    schema = T.StructType([f for f in rows.schema.fields if f.name != text] + [T.StructField(text, T.StringType())])
    shared, name = rows.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches):
        pieces = _loaded(name, shared.value)
        for batch in batches:
            columns = [batch.column(f.name) for f in schema.fields[:-1]]
            texts = [pieces.decode(x or []) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], schema.names)

    return rows.mapInArrow(run, schema)


def digests(documents: DataFrame, model: bytes, keep_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of ``documents`` (doc_id, text), with the ids as one text of
    decimal numbers and commas if asked for."""
    found = encode(documents.select("doc_id", "text"), model, decoded="decoded").select("doc_id", "ids", "decoded")
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *[listed.alias("ids")] * keep_ids,
    )


def default_model() -> bytes:
    import public_tokenizers

    return model_bytes(public_tokenizers.path("piece_bpe_32k.model"))


def op9_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), default_model())


QUERIES = {"op9_sentence_pieces": op9_sentence_pieces}
ORACLES: dict[str, str] = {}
