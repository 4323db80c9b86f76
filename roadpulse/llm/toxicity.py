"""Toxicity: class-conditional Kneser-Ney models over the letters of words.

Each class has its own counts of letters after the three before them. Both back off to the same tables: the counts of
both classes together and, below, continuation counts of ever shorter contexts. So an expression that neither class
shows often scores alike under both, while a stem that one class uses in many forms stands out even in a form never
met. A word's evidence is its log-likelihood as toxic less that as ordinary, moved ``FLOOR`` nats towards 0: less than
that is the noise of small counts and would add up over long texts and rarer languages. A text's evidence is the sum
divided by its number of words; a logistic curve, fitted on training rows that the counts have not seen, makes it a
score.

Training reads a bounded sample of labelled rows: at most ``toxic_rows`` documents that are toxic and twice as many
that are not, those with the smallest hash of id and text, and of their words the ``max_types`` that most documents
hold. Scoring covers every row and whole texts.

Defined results: a null or empty text has no evidence and gets the score of evidence 0; repeated rows get equal scores;
with no usable training rows of one class every score is 0. Columns beside the text are carried through untouched.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadpulse.llm.common import fold, landed, ready, table, takes_over, words_of

#: Letters of a context and the letter after it; ids of letters take 10 bits, or more if there are more letters.
ORDER = 4
BITS = 10
#: Taken off each count, for the shared tables and for those of one class.
DISCOUNT = 0.9
OWN_DISCOUNT = 4.0
#: Nats of a word's evidence that count as noise.
FLOOR = 3.0
#: Nats a word below which the score's curve is straight, and above which it takes their logarithm; evidence below 0
#: is hardly less than none: that a text is unlike ordinary rows doesn't make it ordinary.
UNIT = 0.002
#: Words remembered per worker with their evidence, then forgotten together.
REMEMBERED = 300_000
#: Bytes of the longest word that is remembered.
LONGEST = 64


def _bits(letters: dict[str, int]) -> int:
    return max(BITS, (len(letters) + 2).bit_length())


def spread(words: list[str], letters: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """One code per letter (and one for the end of the word): the letter with the three before it, and its word's place."""
    ends = np.fromiter(map(len, words), np.int64, len(words)) + 1
    flat = np.fromiter((letters.get(c, 3) for w in words for c in (*w, "")), np.int64, int(ends.sum()))
    place = np.repeat(np.arange(len(words)), ends)
    offset = np.arange(len(flat)) - np.repeat(np.cumsum(ends) - ends, ends)
    bits = _bits(letters)
    if ORDER * bits > 63:
        # More letters than fit a machine word: whole numbers of any size.
        flat = flat.astype(object)
    codes = flat.copy()
    for back in range(1, ORDER):
        before = np.where(offset >= back, np.roll(flat, back), 1)
        codes |= before << (bits * back)
    return codes, place


def _sums(keys: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and each weight summed by key."""
    kinds, where = np.unique(keys, return_inverse=True)
    return (kinds, *(np.bincount(where, w, len(kinds)).astype(np.float32) for w in weights))


def _at(kinds: np.ndarray, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The value of each key, 0 for keys that are not there."""
    if not len(kinds):
        return np.zeros(len(keys), np.float32)
    where = np.minimum(np.searchsorted(kinds, keys), len(kinds) - 1)
    return np.where(kinds[where] == keys, values[where], np.float32(0))


def _scale(mean: np.ndarray) -> np.ndarray:
    return np.log1p(np.maximum(mean, 0) / UNIT) - 0.01 * np.log1p(np.maximum(-mean, 0) / UNIT)


@dataclass
class Models:
    """Tables of one fit; ``shared[n]`` has the continuation counts of n letters, ``own`` the counts by class."""

    letters: dict[str, int]
    shared: list[tuple] = field(default_factory=list)
    own: list[tuple] = field(default_factory=list)
    slope: float = 0.0
    offset: float = -30.0

    @classmethod
    def fit(cls, words: list[str], counts: np.ndarray) -> Models:
        """``counts``: one row per word, occurrences in ordinary and in toxic rows."""
        kinds = sorted({c for w in words for c in w})
        models = cls({"": 2} | {c: k + 4 for k, c in enumerate(kinds)})
        codes, place = spread(words, models.letters)
        bits = _bits(models.letters)
        grams, ordinary, toxic = _sums(codes, counts[place, 0], counts[place, 1])
        for n in (ordinary, toxic):
            seen = n > 0
            of, total, kept = _sums(grams[seen] >> bits, n[seen], np.minimum(n[seen], OWN_DISCOUNT))
            models.own.append((grams, n, of, total, kept))
        longer, forms = grams, ordinary + toxic
        for size in range(ORDER, 0, -1):
            if size < ORDER:
                longer, forms = _sums(longer & ((1 << (bits * size)) - 1), np.ones(len(longer)))
            of, total, kept = _sums(longer >> bits, forms, np.minimum(forms, DISCOUNT))
            models.shared.insert(0, (longer, forms, of, total, kept))
        return models

    def _shared(self, codes: np.ndarray) -> np.ndarray:
        p, bits = np.full(len(codes), 1.0 / (len(self.letters) + 1)), _bits(self.letters)
        for size, (grams, forms, of, total, kept) in enumerate(self.shared, 1):
            mine = codes & ((1 << (bits * size)) - 1)
            n, t, k = _at(grams, forms, mine), _at(of, total, mine >> bits), _at(of, kept, mine >> bits)
            p = np.where(t > 0, (np.maximum(n - DISCOUNT, 0) + k * p) / np.maximum(t, 1e-9), p)
        return p

    def evidence(self, words: list[str]) -> np.ndarray:
        """Per word, its log-likelihood as toxic less that as ordinary."""
        if not words or not self.own:
            return np.zeros(len(words))
        codes, place = spread(words, self.letters)
        low, logs, bits = self._shared(codes), [], _bits(self.letters)
        for grams, n, of, total, kept in self.own:
            c, t, k = _at(grams, n, codes), _at(of, total, codes >> bits), _at(of, kept, codes >> bits)
            logs.append(np.log(np.where(t > 0, (np.maximum(c - OWN_DISCOUNT, 0) + k * low) / np.maximum(t, 1e-9), low)))
        raw = np.bincount(place, logs[1] - logs[0], len(words))
        return np.sign(raw) * np.maximum(np.abs(raw) - FLOOR, 0)

    def calibrate(self, mean: np.ndarray, toxic: np.ndarray, rate: float) -> None:
        """Logistic curve by Newton steps, both classes weighed to the corpus' own shares."""
        y = toxic.astype(float)
        share = y.mean() if len(y) else 0.0
        if not 0 < share < 1:
            return
        weight = np.where(toxic, rate / share, (1 - rate) / (1 - share))
        x = np.column_stack([_scale(mean), np.ones(len(mean))])
        beta = np.zeros(2)
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            slope = x.T @ (weight * (p - y)) + 1e-2 * beta
            curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
            step = np.linalg.solve(curve, slope)
            beta -= np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        self.slope, self.offset = float(beta[0]), float(beta[1])

    def score(self, mean: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * _scale(mean) + self.offset, -30, 30)))


_remembered: dict = {}


def _mean_evidence(models: Models, key: str, texts: list[str | None]) -> np.ndarray:
    """Evidence per word of each text; words met before on this worker are not computed again."""
    takes_over("toxicity", _remembered.clear)
    if _remembered.get("of") != key or len(_remembered["words"]) > REMEMBERED:
        _remembered.update(of=key, words={})
    known = _remembered["words"]
    means = np.zeros(len(texts))
    for start in range(0, len(texts), 256):
        part = [words_of(t) for t in texts[start : start + 256]]
        fresh = list({w for words in part for w in words if w not in known})
        known.update(zip(fresh, models.evidence([w.decode("utf-8", "replace") for w in fresh]).tolist()))
        for k, words in enumerate(part, start):
            if words:
                means[k] = sum(map(known.__getitem__, words)) / len(words)
        for w in fresh:
            if len(w) > LONGEST:
                del known[w]
    return means


def train(documents: DataFrame, labels: DataFrame, toxic_rows: int = 4000, max_types: int = 300_000) -> Models:
    """Models from the texts of ``documents`` (doc_id, text) and ``labels`` (doc_id, toxic; one row per id)."""
    texts = documents.select("doc_id", "text").where("text is not null")
    # Ids alone choose the sample; texts are read for it only.
    drawn = labels.where("toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    drawn = drawn.join(texts.select("doc_id").distinct(), "doc_id").withColumn("draw", F.xxhash64("doc_id"))
    sizes = {r["toxic"]: r["n"] for r in drawn.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Models({})
    few = None
    for c, most in ((0, 2 * toxic_rows), (1, toxic_rows)):
        cut = -(2**63) + int(2**64 * min(1.0, 1.25 * most / sizes[c]))
        part = drawn.where((F.col("toxic") == c) & (F.col("draw") <= min(cut, 2**63 - 1))).orderBy("draw").limit(most)
        few = part if few is None else few.unionByName(part)
    # At most 3 x toxic_rows ids: their size is bounded, so they are sent to the texts.
    sample = texts.join(F.broadcast(few), "doc_id").orderBy("draw", F.xxhash64("text")).limit(3 * toxic_rows)
    sample = landed(sample.select("toxic", "text", F.crc32(F.col("draw").cast("string")).alias("draw")), "toxic-sample")

    def counted(batches):
        for batch in batches:
            seen: dict[bytes, list[int]] = {}
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                for w in set(words_of(text)):
                    seen.setdefault(w, [0, 0])[toxic] += 1
            n = np.array(list(seen.values()) or np.zeros((0, 2)), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array([w.decode("utf-8", "replace") for w in seen], pa.string()), pa.array(n[:, 0]), pa.array(n[:, 1])],
                ["word", "ordinary", "toxic"],
            )

    # Two halves, so that the curve is fitted on documents the counts have not seen.
    def fitted(half: DataFrame) -> Models:
        kinds = (
            half.mapInArrow(counted, "word string, ordinary long, toxic long")
            .groupBy("word")
            .agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
            .orderBy(F.desc(F.col("ordinary") + F.col("toxic")), "word")
            .limit(max_types)
            .toArrow()
        )
        counts = np.column_stack([kinds["ordinary"].to_numpy(), kinds["toxic"].to_numpy()])
        return Models.fit(kinds["word"].to_pylist(), counts)

    spark = sample.sparkSession
    part = fitted(sample.where("draw % 3 <> 0"))
    shared, name = spark.sparkContext.broadcast(part), uuid.uuid4().hex

    def means(batches):
        for batch in batches:
            got = _mean_evidence(shared.value, name, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.int32()), pa.array(got)], ["toxic", "mean"])

    held = sample.where("draw % 3 = 0").mapInArrow(means, "toxic int, mean double").toArrow()
    rate = sizes[1] / (sizes[0] + sizes[1])
    whole = fitted(sample)
    whole.calibrate(held["mean"].to_numpy(), held["toxic"].to_numpy() == 1, rate)
    return whole


def score(documents: DataFrame, models: Models, text: str = "text", into: str = "score") -> DataFrame:
    """``documents`` with the column ``into``: 0 to 1, higher for texts likelier to be toxic."""
    spark = ready(documents.sparkSession)
    shared, name = spark.sparkContext.broadcast(models), uuid.uuid4().hex
    schema = documents.withColumn(into, F.lit(0.0)).schema
    at = schema.fieldNames().index(into)

    def run(batches):
        for batch in batches:
            got = pa.array(shared.value.score(_mean_evidence(shared.value, name, batch.column(text).to_pylist())))
            columns = list(batch.columns)
            columns[at : at + 1] = [got]
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return documents.mapInArrow(run, schema)


def labels_to_learn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One label per document that is not held out; a document whose labels disagree has none."""
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    labels = labels.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
    return labels.where("toxic = most").select("doc_id", "toxic")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(documents, train(documents, labels_to_learn(spark, sf_dir)))
    return scored.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


QUERIES = {"op5_toxicity": op5_toxicity}
ORACLES: dict[str, str] = {}
