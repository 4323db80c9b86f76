"""Phrases whose words go together, counted exactly per language in burstable tries.

A task gives words ids of its own and keeps windows of up to four ids in a trie: shallow nodes by word id, below them
hash tables of the remaining ids. A table that grows too large bursts into a node with smaller tables; a trie that grows
too large spills its largest subtrees whole, as runs of phrases in the order of their words with their counts. The shuffle brings the
runs of a window together by its whole prefix path, so that a frequent word's or pair's subtree is spread over all tasks,
and adds their counts; shorter phrases are sums over the windows they begin.

Counting goes by length. A phrase met ``least`` times holds only words and pairs met as often, so a filter of those (of a
fixed size; one that fills up costs shuffle, never a result) cuts the windows of the next length. Nothing else is left
out: every count that is returned is exact, in 64 bits, and products are decimals.

Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends into pieces and those at spaces and tabs into words. Defined
results: a null language is ``und``; null, empty and blank texts have no words; repeated rows count as often as they are
there; ties go by count, then by the phrase's bytes; an empty table, or one without a frequent phrase, has no rows. Other
columns play no part. A text is taken in blocks, and so is a long piece.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from roadpulse.llm.common import landed, ready, table

LEAST = 30
LONGEST = 4
TOP = 2000
NO_LANG = "und"
#: A phrase goes if a longer one that holds it has this share of its count, in percent.
SHARE = 80
#: What a score is a multiple of.
SCALE = 2_000_000

#: Bits of the filter.
FILTER = 1 << 27
#: Entries of a hash table before it bursts, of a trie before it spills, and words that have an id at a time.
BURST = 4096
ENTRIES = 600_000
WORDS = 400_000
#: Bytes of text taken at once, about.
BLOCK = 2_000_000

_BITS = 21
_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_SEPARATORS + b"\t", b"\n" * len(_SEPARATORS) + b" ")
_GAP = re.compile(rb"[ \n]")
_AHEAD = re.compile(rb" *(?:[^ \n]+ *){0,%d}" % (LONGEST - 1))
_EMPTY, _BREAK = -1, 0
_RUN = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hashes of pairs from those of their words."""
    return _mixed(first * np.uint64(0x9E3779B97F4A7C15) + second)


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh3_64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _places(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    other = _mixed(hashes ^ np.uint64(0x5851F42D4C957F2D))
    return (hashes % np.uint64(size)).astype(np.int64), (other % np.uint64(size)).astype(np.int64)


def _maybe(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the filter; False only for those that are not."""
    first, second = ((bits[p >> 6] >> (p & 63)) & 1 == 1 for p in _places(hashes, len(bits) << 6))
    return first & second


def filter_of(phrases: DataFrame, size: int | None = None) -> np.ndarray:
    """The filter of (lang, phrase), phrases of one or two words: ``size`` bits, whatever the number of rows."""
    size = size or FILTER

    def run(batches):
        for batch in batches:
            found = []
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()):
                found.append(_hashes(lang, phrase.encode().split(b" ")))
            single = np.array([h[0] for h in found if len(h) == 1], np.uint64)
            double = np.array([h for h in found if len(h) == 2], np.uint64).reshape(-1, 2)
            at = np.unique(np.concatenate([*_places(single, size), *_places(_pairs(double[:, 0], double[:, 1]), size)]))
            words, where = np.unique(at >> 6, return_inverse=True)
            bits = np.zeros(len(words), np.int64)
            np.bitwise_or.at(bits, where, np.int64(1) << (at & 63))
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(bits)], ["at", "bits"])

    set_bits = phrases.select("lang", "phrase").mapInArrow(run, "at long, bits long")
    # At most size / 64 rows.
    found = set_bits.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(size >> 6, np.int64)
    bits[found["at"].to_numpy()] = found["bits"].to_numpy()
    return bits


class Node:
    """A burst table: smaller ones (or nodes) by the next word."""

    __slots__ = ("children",)

    def __init__(self):
        self.children: dict[int, dict | Node] = {}


def _entries(node: dict | Node) -> int:
    return sum(map(_entries, node.children.values())) if type(node) is Node else len(node)


class Trie:
    """Counts of windows. A window is its first id and the up to three others, 21 bits each and 0 for none, in one int."""

    def __init__(self, width: int, burst: int = BURST):
        self.roots: dict[int, dict | Node] = {}
        self.size, self.burst = 0, burst
        # A table keyed by the last word only has nothing to burst by.
        self.last = (LONGEST - width) * _BITS

    def add(self, first: np.ndarray, rest: np.ndarray, counts: np.ndarray) -> None:
        roots, most, last, grown = self.roots, self.burst, self.last, 0
        for a, r, n in zip(first.tolist(), rest.tolist(), counts.tolist()):
            shift, under, key = (LONGEST - 2) * _BITS, roots, a
            node = roots.get(a)
            while type(node) is Node:
                under, key = node.children, r >> shift
                r &= (1 << shift) - 1
                shift -= _BITS
                node = under.get(key)
            if node is None:
                node = under[key] = {}
            if r in node:
                node[r] += n
            else:
                node[r] = n
                grown += 1
                if len(node) > most and shift > last:
                    under[key] = self._burst(node, shift)
        self.size += grown

    @staticmethod
    def _burst(container: dict, shift: int) -> Node:
        node, low = Node(), (1 << shift) - 1
        for r, n in container.items():
            node.children.setdefault(r >> shift, {})[r & low] = n
        return node

    def _walk(self, node: dict | Node, above: int, shift: int) -> Iterator[tuple[int, dict]]:
        if type(node) is Node:
            for key, child in node.children.items():
                yield from self._walk(child, above | key << shift, shift - _BITS)
        else:
            yield above, node

    def spill(self, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Takes the largest subtrees out until at most ``keep`` entries stay; their windows and counts."""
        heavy = sorted(self.roots, key=lambda a: -_entries(self.roots[a])) if keep else list(self.roots)
        # Per table: its first id, the bits of the nodes above it, its size; then all entries one after another.
        tables: list[tuple[int, int, int]] = []
        rest: list[int] = []
        counts: list[int] = []
        for a in heavy:
            if self.size <= keep:
                break
            for above, container in self._walk(self.roots.pop(a), 0, (LONGEST - 2) * _BITS):
                tables.append((a, above, len(container)))
                self.size -= len(container)
                rest.extend(container.keys())
                counts.extend(container.values())
        first, above, sizes = np.array(tables, np.int64).reshape(-1, 3).T
        return np.repeat(first, sizes), np.array(rest, np.int64) | np.repeat(above, sizes), np.array(counts, np.int64)


def _blocks(text: bytes) -> Iterator[tuple[bytes, bytes]]:
    """A text in parts of about ``BLOCK`` bytes, each with the words that windows from it reach into."""
    at = 0
    while len(text) - at > BLOCK:
        cut = text.rfind(b"\n", at + 1, at + BLOCK)
        if cut < 0:
            cut = text.rfind(b" ", at + 1, at + BLOCK)
        if cut < 0:
            end = _GAP.search(text, at + BLOCK)
            if end is None:
                break
            cut = end.start()
        yield text[at:cut], _AHEAD.match(text, cut)[0]
        at = cut
    yield text[at:], b""


class Counter:
    """One task's windows of ``low`` to ``high`` words."""

    def __init__(self, low: int, high: int, bits: np.ndarray | None, burst: int = BURST, entries: int = ENTRIES, words: int = WORDS):
        self.low, self.high, self.bits, self.entries, self.most = low, high, bits, entries, words
        self.trie = Trie(high, burst)
        self.totals: dict[str, int] = {}
        self._reset()

    def _reset(self) -> None:
        #: Per language, word -> id; words that the filter hasn't are breaks.
        self.ids: dict[str, dict[bytes, int]] = {}
        # Places by id; 0 is a break.
        self.words, self.langs, self.hashes = [b""], [""], np.zeros(1, np.uint64)
        self.met, self.singles = 0, np.zeros(1, np.int64)

    def _learn(self, lang: str, fresh: list[bytes]) -> None:
        self.met += len(fresh)
        ids = self.ids[lang]
        if self.bits is not None:
            hashes = _hashes(lang, fresh)
            known = _maybe(self.bits, hashes)
            ids.update(dict.fromkeys(compress(fresh, (~known).tolist()), _BREAK))
            fresh = list(compress(fresh, known.tolist()))
            self.hashes = np.r_[self.hashes, hashes[known]]
        ids.update(zip(fresh, range(len(self.words), len(self.words) + len(fresh))))
        self.words += fresh
        self.langs += [lang] * len(fresh)

    def add(self, lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        """Counts texts of one language; yields runs whenever the trie or the words are too many."""
        held, size = [], 0
        for text in texts:
            for data, ahead in _blocks(text.lower().translate(_TABLE)):
                if ahead:
                    yield from self._block(lang, data, ahead)
                    continue
                held.append(data)
                size += len(data)
                if size > BLOCK:
                    yield from self._block(lang, b"\n".join(held))
                    held, size = [], 0
        yield from self._block(lang, b"\n".join(held))

    def _block(self, lang: str, data: bytes, ahead: bytes = b"") -> Iterator[pa.RecordBatch]:
        ids = self.ids.setdefault(lang, {b"": _EMPTY, b"\n": _BREAK})
        words = pc.split_pattern(pa.array([data.replace(b"\n", b" \n ")], pa.large_binary()), b" ").flatten().dictionary_encode()
        kinds, more = words.dictionary.to_pylist(), ahead.split(b" ") if self.high > 1 else []
        self._learn(lang, list({*kinds, *more}.difference(ids)))
        found = np.fromiter(map(ids.__getitem__, kinds), np.int64, len(kinds))[words.indices.to_numpy()]
        found = found[found != _EMPTY]
        if self.high == 1:
            counts = np.bincount(found, minlength=len(self.words))
            counts[: len(self.singles)] += self.singles
            self.totals[lang] = self.totals.get(lang, 0) + int((found != _BREAK).sum())
            counts[_BREAK] = 0
            self.singles = counts
        else:
            after = [ids[w] for w in more if w] + [_BREAK] * LONGEST
            self._windows(np.concatenate([found, np.array(after, np.int64)]), len(found))
        if self.met > self.most:
            yield from self._forget()
        if self.trie.size > self.entries:
            yield from self._run(*self.trie.spill(self.entries // 2))

    def _forget(self) -> Iterator[pa.RecordBatch]:
        """Drops words without an id; if there are many with one, spills all that is held."""
        if len(self.words) > self.most // 2:
            yield from self.flush()
            return
        for lang, ids in self.ids.items():
            kept = {w: k for w, k in ids.items() if k != _BREAK}
            self.ids[lang] = kept | {b"\n": _BREAK}
        self.met = len(self.words)

    def _windows(self, ids: np.ndarray, n: int) -> None:
        """Counts the windows that begin at the first ``n`` ids."""
        linked = (ids[:-1] != _BREAK) & (ids[1:] != _BREAK)
        if self.low > 2:
            at = np.flatnonzero(linked)
            linked[at] = _maybe(self.bits, _pairs(self.hashes[ids[at]], self.hashes[ids[at + 1]]))
        whole = np.ones(n, bool)
        rest = np.zeros(n, np.int64)
        chosen = whole
        for k in range(1, self.high):
            whole = whole & linked[k - 1 : k - 1 + n]
            rest |= np.where(whole, ids[k : k + n], 0) << ((LONGEST - 1 - k) * _BITS)
            if k + 1 == self.low:
                chosen = whole
        first, rest = ids[:n][chosen], rest[chosen]
        if not len(first):
            return
        if self.high == 2:
            # Both ids fit in one number, which sorts faster.
            pairs, counts = np.unique(first << 2 * _BITS | rest >> _BITS, return_counts=True)
            self.trie.add(pairs >> 2 * _BITS, (pairs & ((1 << 2 * _BITS) - 1)) << _BITS, counts)
            return
        order = np.lexsort((rest, first))
        first, rest = first[order], rest[order]
        starts = np.flatnonzero(np.r_[True, (first[1:] != first[:-1]) | (rest[1:] != rest[:-1])])
        self.trie.add(first[starts], rest[starts], np.diff(np.r_[starts, len(first)]))

    def flush(self) -> Iterator[pa.RecordBatch]:
        """All that is held, and the words' ids are forgotten."""
        yield from self._run(*self.trie.spill(0))
        if self.high == 1:
            first = np.flatnonzero(self.singles)
            yield from self._run(first, np.zeros(len(first), np.int64), self.singles[first])
            for lang, n in self.totals.items():
                yield pa.RecordBatch.from_pylist([{"lang": lang, "phrase": None, "n": n}], _RUN)
            self.totals = {}
        self._reset()

    def _run(self, first: np.ndarray, rest: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(first):
            return
        words = pa.array([None, *self.words[1:]], pa.binary())
        langs = pa.array(self.langs)
        # Words in order of language and bytes; a run is sorted by those of its words.
        sorted_words = pc.sort_indices(pa.table({"lang": langs, "word": words}), [("lang", "ascending"), ("word", "ascending")])
        rank = np.empty(len(words), np.int64)
        rank[sorted_words.to_numpy()] = np.arange(len(words))
        rank[_BREAK] = -1
        parts = [first, *((rest >> ((LONGEST - 1 - k) * _BITS)) & ((1 << _BITS) - 1) for k in range(1, self.high))]
        order = np.lexsort([rank[p] for p in reversed(parts)])
        for at in range(0, len(order), 50_000):
            here = order[at : at + 50_000]
            columns = [words.take(pa.array(p[here])) for p in parts]
            phrase = columns[0]
            if len(columns) > 1:
                phrase = pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.binary()), null_handling="skip")
            lang = langs.take(pa.array(first[here]))
            yield pa.RecordBatch.from_arrays([lang, phrase.cast(pa.string()), pa.array(counts[here])], schema=_RUN)


def _counted(texts: DataFrame, low: int, high: int, shared: Callable[[], np.ndarray] | None) -> DataFrame:
    """(lang, phrase, n): the windows of ``texts`` (lang, text) with their counts; without a phrase, all words."""

    def run(batches):
        counter = Counter(low, high, shared() if shared else None)
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            data, place = batch.column("text").cast(pa.binary()), langs.indices.to_numpy()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                yield from counter.add(lang, data.take(pa.array(np.flatnonzero(place == k))).to_pylist())
        yield from counter.flush()

    runs = texts.mapInArrow(run, "lang string, phrase string, n long")
    return runs.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def frequent(documents: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, n): each phrase of one to four words met ``least`` times; (lang, n): all words."""
    spark = ready(documents.sparkSession)
    lang, text = F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), F.col("text")
    texts = documents.select(lang, text).where("text is not null")
    sized = lambda rows, size: rows.where(F.col("n") >= least).select("lang", "phrase", F.lit(size).alias("size"), "n")

    words = landed(_counted(texts, 1, 1, None).where(F.col("phrase").isNull() | (F.col("n") >= least)), "words")
    totals, found = words.where("phrase is null").select("lang", "n"), sized(words.where("phrase is not null"), 1)
    bits = spark.sparkContext.broadcast(filter_of(found))
    pairs = landed(sized(_counted(texts, 2, 2, lambda: bits.value), 2), "pairs")
    found = found.unionByName(pairs)
    both = spark.sparkContext.broadcast(filter_of(found))
    windows = landed(_counted(texts, 3, LONGEST, lambda: both.value), "windows")
    for size in range(3, LONGEST + 1):
        begun = windows.where(F.size(F.split("phrase", " ")) >= size)
        begun = begun.groupBy("lang", F.substring_index("phrase", " ", size).alias("phrase")).agg(F.sum("n").alias("n"))
        found = found.unionByName(sized(begun, size))
    return landed(found, "phrases"), totals


def _product(number: int, column: str):
    return F.lit(number).cast("decimal(7,0)") * F.col(column).cast("decimal(19,0)")


def scored(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, score) of the phrases of two words or more, each by its weakest cut."""
    candidates = phrases.where("size > 1").withColumnRenamed("n", "a")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', k)"))
    cuts = cuts.withColumn("right", F.expr("substring_index(phrase, ' ', k - size)"))
    part = lambda name, count: phrases.select("lang", F.col("phrase").alias(name), F.col("n").alias(count))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    both = F.col("l").cast("decimal(19,0)") + F.col("r").cast("decimal(19,0)")
    cuts = cuts.withColumns({"top": _product(SCALE, "a"), "both": both}).withColumn("score", F.expr("top div both"))
    weakest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "size", "a").agg(weakest).select(
        "lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score"
    )


def without_parts(candidates: DataFrame, share: int = SHARE) -> DataFrame:
    """Candidates (lang, phrase, size, a) that lie in no longer one with ``share`` percent of their count."""
    longer = candidates.where("size > 2").select("lang", "size", F.col("a").alias("longer"), F.split("phrase", " ").alias("words"))
    inner = longer.withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
    inner = inner.select("lang", F.array_join(F.slice("words", F.col("i"), F.col("m")), " ").alias("phrase"), "longer")
    most = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    held = candidates.join(most, ["lang", "phrase"], "left")
    return held.where(F.col("longer").isNull() | (_product(100, "longer") < _product(share, "a"))).drop("longer")


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language of ``documents`` (text, lang)."""
    phrases, totals = frequent(documents, least)
    kept = without_parts(landed(scored(phrases), "scored"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    ranked = ranked.join(totals, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {"op12_collocations": op12_collocations}

ORACLES = {
    "op12_collocations": rf"""
        WITH pieces AS (
          SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(string_split_regex(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents
        ),
        worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
        sized AS (SELECT lang, w, i, unnest(range(1, least({LONGEST}, len(w) - i + 1) + 1)) AS size FROM placed),
        totals AS (SELECT lang, count(*) AS n FROM placed GROUP BY lang),
        phrases AS (
          SELECT lang, array_to_string(w[i : i + size - 1], ' ') AS phrase, size, count(*) AS f
          FROM sized GROUP BY ALL HAVING count(*) >= {LEAST}
        ),
        candidates AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM phrases WHERE size > 1),
        cuts AS (
          SELECT c.*, k, x.f AS l, y.f AS r, {SCALE}::HUGEINT * c.a // (x.f::HUGEINT + y.f) AS score
          FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
          JOIN phrases x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : k], ' ')
          JOIN phrases y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1 : c.size], ' ')
        ),
        weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        starts AS (SELECT lang, size, a, w, unnest(range(1, size)) AS i FROM candidates WHERE size > 2),
        parts AS (SELECT lang, a, size, w, i, unnest(range(2, least(size - 1, size - i + 1) + 1)) AS m FROM starts),
        inner_parts AS (
          SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS longer FROM parts GROUP BY ALL
        ),
        kept AS (
          SELECT k.* FROM weakest k LEFT JOIN inner_parts p ON p.lang = k.lang AND p.phrase = k.phrase
          WHERE p.longer IS NULL OR 100::HUGEINT * p.longer < {SHARE}::HUGEINT * k.a
        ),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
        )
        SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, CAST(r.score AS BIGINT) AS score
        FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= {TOP}
    """
}
