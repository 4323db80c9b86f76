"""Token ids in length-delimited binary records, with a separate offset index for shuffled reads.

A record frames one document's sequence::

    8 bytes  length of the payload, unsigned      1 byte   flags: 1 has an id, 2 four bytes to a token
    4 bytes  masked crc32 of those 8 bytes        8 bytes  doc_id, signed
    n bytes  payload, to the right                2 or 4 bytes for each token, unsigned
    4 bytes  masked crc32 of the payload
    1 byte   line feed

All numbers are little-endian. A crc is masked by turning it 15 bits to the right and adding ``MASK``, so that a
checksum of data that holds checksums stays meaningful. Files are cut at ranges of doc_id and named in that order; the
line feed is what Spark's writer of lines puts after a record, so its commit protocol, retries and stores apply. The
index is a Parquet table with file, offset, length, doc_id, tokens and the number of tokens before each record.

Texts are cut before single spaces that a word follows; the tokenizer never joins across those, so the library encodes
each distinct piece once and workers remember a bounded number of them.

Defined results: a null or empty text is the end id alone; rows without an id come first; repeated rows are records of
their own, rows of equal ids in order of a hash of their text; an empty table makes no records.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array
from itertools import count
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from roadpulse.llm.common import fresh_dir, landed, ready, table
from roadpulse.llm.words import Words, blocks, spans

END = 2
MASK = 0xA282EAD8
#: Bytes of text to a file, about.
FILE_BYTES = 12_000_000
#: Texts that are encoded together, in bytes, about.
BLOCK = 2_500_000
#: Pieces remembered per worker, and the longest of them.
REMEMBERED = 300_000
LONGEST = 64
_LISTS = pa.large_list(pa.large_string())
_CUT = re.compile(r" (?=\S)")
#: A space that no word follows. Unicode's white space.
_ODD = r" (?:\z|[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}])"
#: One sign behind a letter, before a space.
_BEHIND = r"(\p{L})([.,;:!?]) "
#: Pieces of letters alone, or of digits alone: the tokenizer's pattern never cuts them. Letters of every version of Unicode.
_WHOLE = re.compile(r"[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u017f]+|[0-9]+")
#: The steps before the model that ``_WHOLE`` knows.
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_id = attrgetter("id")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def framed(doc_id: int | None, ids: np.ndarray) -> bytes:
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    head = struct.pack("<Bq", (doc_id is not None) + 2 * wide, doc_id or 0)
    payload = head + ids.astype("<u4" if wide else "<u2").tobytes()
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def unframed(data: memoryview | bytes, offset: int) -> tuple[int | None, np.ndarray, int]:
    """The record at ``offset``: its id, its tokens, and where the next record is. Damage is an error."""
    length = bytes(data[offset : offset + 8])
    (size,) = struct.unpack("<Q", length)
    if struct.unpack("<I", data[offset + 8 : offset + 12])[0] != masked(length):
        raise ValueError(f"damaged length at {offset}")
    payload = bytes(data[offset + 12 : offset + 12 + size])
    end = offset + 12 + size
    if len(payload) != size or struct.unpack("<I", data[end : end + 4])[0] != masked(payload):
        raise ValueError(f"damaged record at {offset}")
    flags, doc_id = struct.unpack_from("<Bq", payload)
    ids = np.frombuffer(payload, "<u4" if flags & 2 else "<u2", offset=9).astype("<u4")
    return doc_id if flags & 1 else None, ids, end + 5


def _signs() -> str:
    """The letter that stands for each byte in the tokenizer's vocabulary: itself if it can be printed, else one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = count(256)
    return "".join(chr(b if b in shown else next(others)) for b in range(256))


class Encoder:
    """One tokenizer with the pieces it has met."""

    def __init__(self, model: str, most: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        # Pieces behind a space, and those without one.
        self.pieces, self.firsts = Words(most, LONGEST), Words(most // 8, LONGEST)

        # Bytes of each token: its letters stand for one byte each, but for those of added tokens.
        special = {k: len(t.content.encode()) for k, t in self.tokenizer.get_added_tokens_decoder().items()}
        vocabulary = self.tokenizer.get_vocab()
        self.widths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, k in vocabulary.items():
            self.widths[k] = special.get(k, len(token))
        self.tokenizer.post_processor = None  # it would only trim offsets
        self.model, self.signs = self.tokenizer.model, _signs()
        before = json.loads(model)
        self.by_bytes = not before["normalizer"] and before["pre_tokenizer"] == _BYTES

    def _each(self, pieces: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _behind_a_space(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece with a space before it. What the pattern leaves whole goes to the model at once, which spares the
        tokenizer's strings and offsets."""
        texts = [p.decode() for p in pieces] if self.by_bytes else []
        whole = [m is not None for m in map(_WHOLE.fullmatch, texts)]
        if not any(whole):
            return self._in_one(pieces)
        space, tokenize, found = self.signs[0x20], self.model.tokenize, []
        others = iter(self._in_one([p for p, w in zip(pieces, whole) if not w]))
        for t, w in zip(texts, whole):
            if w:
                t = t if t.isascii() else t.encode().decode("latin-1").translate(self.signs)
                found.append(array("I", map(_id, tokenize(space + t))).tobytes())
            else:
                found.append(next(others))
        return found

    def _in_one(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece with a space before it. All are encoded as one text, told apart by the bytes of the tokens."""
        if not pieces:
            return []
        text = b" " + b" ".join(pieces)
        ids = np.array(self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1)
        reached = np.cumsum(self.widths[ids])
        stops = np.minimum(np.searchsorted(reached, ends), len(ids) - 1)
        if stops[-1] + 1 != len(ids) or (reached[stops] != ends).any():
            return self._each([b" " + p for p in pieces])
        data, stops = ids.tobytes(), ((stops + 1) * 4).tolist()
        return [data[x:y] for x, y in zip([0, *stops[:-1]], stops)]

    def _numbers(self, memory: Words, kinds: list[bytes], make) -> np.ndarray:
        """The number of each kind in ``memory``, which learns those it hasn't."""
        known = memory.find(kinds)
        fresh = np.flatnonzero(known < 0)
        if len(fresh):
            new = [kinds[k] for k in fresh.tolist()]
            memory.learn(new, make(new))
            known[fresh] = np.arange(len(memory.size) - len(new), len(memory.size))
        return known

    def encode(self, texts: list[str | None] | pa.Array) -> list[np.ndarray]:
        """Ids of each text, without an end."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        if not len(texts):
            return []
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        self.pieces.shrink()
        self.firsts.shrink()
        # Where every space has a word after it, all spaces are cuts, and a sign behind a letter is cut off by two; Arrow
        # then splits and numbers the pieces.
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        plain = texts.filter(pa.array(~odd))
        cuts = pc.split_pattern(pc.replace_substring_regex(plain, _BEHIND, r"\1  \2 "), " ").cast(_LISTS)
        if odd.any():
            others = [_CUT.split(t) for t in texts.filter(pa.array(odd)).to_pylist()]
            cuts = pa.concat_arrays([cuts, pa.array(others, _LISTS)])
        order = np.argsort(odd, kind="stable")
        pieces = cuts.flatten().cast(pa.large_binary()).dictionary_encode()
        # Through numpy, as to_pylist() makes a scalar of each.
        place, kinds = pieces.indices.to_numpy(), pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        ends = np.cumsum(np.asarray(cuts.value_lengths()))
        starts = np.r_[0, ends[:-1]]

        # A text's first piece has no space before it, nor has a sign that was cut off: it is behind an empty piece, which
        # stands for nothing itself.
        number = self._numbers(self.pieces, kinds, self._behind_a_space)
        sizes, at = self.pieces.size[number][place], self.pieces.first[number][place]
        empty = kinds.index(b"") if b"" in kinds else -1
        behind = np.flatnonzero(place == empty) + 1
        first = np.zeros(len(place) + 1, bool)
        first[starts] = True
        bare = behind[~first[behind - 1] & ~first[behind]]
        bare = np.concatenate([starts, bare[bare < len(place)]])
        sizes[behind - 1] = 0
        used, which = np.unique(place[bare], return_inverse=True)
        number = self._numbers(self.firsts, [kinds[k] for k in used.tolist()], self._each)
        sizes[bare] = self.firsts.size[number][which]
        at[bare] = self.firsts.first[number][which] + len(self.pieces.ids)
        flat = np.concatenate([self.pieces.ids, self.firsts.ids])[spans(at, sizes)]
        found = [flat] * len(texts)
        stops = np.cumsum(sizes)[ends - 1]
        for k, x, y in zip(order.tolist(), [0, *stops[:-1].tolist()], stops.tolist()):
            found[k] = flat[x:y]
        return found


_encoders: dict[str, Encoder] = {}


def _loaded(name: str, model: str) -> Encoder:
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(model)
    return _encoders[name]


def write(documents: DataFrame, model: str, folder: str, end: int = END) -> None:
    """Records of ``documents`` (doc_id, text) in ascending order of doc_id, under ``folder``/records."""
    spark = ready(documents.sparkSession)
    shared, name = spark.sparkContext.broadcast(model), uuid.uuid4().hex
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranges = rows.repartitionByRange(1 + size // FILE_BYTES, *order).sortWithinPartitions(*order)

    def run(batches):
        encoder = _loaded(name, shared.value)
        for batch in blocks(batches, "text", BLOCK):
            found = encoder.encode(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            frames = [framed(i, np.append(x, np.uint32(end))) for i, x in zip(ids, found)]
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["record"])

    # A binary value cast to string keeps its bytes, and the writer of lines writes them as they are.
    records = ranges.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
    records.write.text(f"{folder}/records")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    # One file is a value of its own here; write() bounds its size.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/records")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def index(spark: SparkSession, folder: str) -> DataFrame:
    """Scans the records once and writes ``folder``/index: file, offset, length, doc_id, n_tokens, ids_crc32, start."""

    def run(batches):
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content")):
                data, at, before, rows = memoryview(content.as_buffer()), 0, 0, []
                while at < len(data):
                    doc_id, ids, following = unframed(data, at)
                    rows.append((file, at, following - at, doc_id, len(ids), zlib.crc32(ids.tobytes()), before))
                    at, before = following, before + len(ids)
                columns = zip(*rows) if rows else [[]] * 7
                kinds = [pa.string()] + [pa.int64()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    names = ["file", "offset", "length", "doc_id", "n_tokens", "ids_crc32", "before"]
    schema = ", ".join([f"{names[0]} string"] + [f"{n} long" for n in names[1:]])
    places = landed(_files(spark, folder).mapInArrow(run, schema), "places")
    sums = places.groupBy("file").agg(F.sum("n_tokens").alias("sum"))
    # One row per file.
    running = Window.partitionBy(F.lit(0)).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("file", F.coalesce(F.sum("sum").over(running), F.lit(0)).alias("files_before"))
    rows = places.join(sums, "file").withColumn("start", F.col("files_before") + F.col("before"))
    rows.drop("before", "files_before").write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def read(spark: SparkSession, folder: str, seed: int | None = None) -> DataFrame:
    """(doc_id, start, ids), each record found by its offset in the index and checked; with a ``seed`` in a shuffled
    order, else in that of the files."""
    places = spark.read.parquet(f"{folder}/index").groupBy("file").agg(F.collect_list(F.struct("offset", "start")).alias("places"))
    files = _files(spark, folder).join(places, "file")

    def run(batches):
        for batch in batches:
            for content, places in zip(batch.column("content"), batch.column("places").to_pylist()):
                data = memoryview(content.as_buffer())
                for k in range(0, len(places), 500):
                    part = sorted((p["offset"], p["start"]) for p in places[k : k + 500])
                    found = [unframed(data, at) for at, _ in part]
                    columns = [[x[0] for x in found], [s for _, s in part], [x[1] for x in found]]
                    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "start", "ids"])

    rows = files.mapInArrow(run, "doc_id long, start long, ids array<long>")
    order = F.col("start") if seed is None else F.xxhash64(F.lit(seed), "start")
    return rows.orderBy(order)


def default_model() -> str:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_dir(spark, "token-files")
    write(table(spark, sf_dir, "documents"), default_model(), folder)
    return index(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES = {"op2_token_files": op2_token_files}
ORACLES: dict[str, str] = {}
