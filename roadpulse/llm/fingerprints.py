"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only.

A sketch is the sorted array of the ``SIZE`` smallest distinct hashes of a text's five-word shingles (all of them, if
there are fewer). Sketches of parts merge into the sketch of the whole; from two of them follow estimates of
resemblance, containment and the number of distinct shingles.

Words are code points other than the ASCII white space, as they are. Defined results: fewer than five words are one
shingle; null and empty texts and texts of white space have the empty sketch, which resembles the empty sketch with 1
and any other with 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from roadpulse.llm.common import WORD, landed, table

SIZE = 128
WIDTH = 5
#: Documents to a slice of the order by id, and slices at most.
SLICE = 2000
SLICES = 4096
STEP = 64


def with_sketch(rows: DataFrame, text: str, into: str) -> DataFrame:
    """``rows`` with the sketch of ``text`` as the array column ``into``."""
    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"({WORD})"), F.lit(1))
    rows = rows.withColumn("__words", F.transform(words, lambda w: F.xxhash64(w)))
    hashes, n = F.col("__words"), F.size("__words")
    # The lambda names the column of word hashes, so words are split and hashed once.
    rolling = F.transform(F.sequence(F.lit(0), n - WIDTH), lambda k: F.xxhash64(*(F.get(hashes, k + j) for j in range(WIDTH))))
    shingles = F.when(n >= WIDTH, rolling).when(n > 0, F.array(F.xxhash64(hashes))).otherwise(F.array().cast("array<bigint>"))
    return rows.withColumn(into, F.slice(F.sort_array(F.array_distinct(shingles)), 1, SIZE)).drop("__words")


def merge(a: Column, b: Column) -> Column:
    """The sketch of both texts' shingles together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, SIZE)


def resemblance(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of the shingle sets."""
    union = merge(a, b)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b))) / F.size(union)
    return F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(both)


def distinct_shingles(a: Column) -> Column:
    """Estimated number of distinct shingles: exact below ``SIZE``."""
    share = F.element_at(a, -1) / F.lit(2.0**64) + 0.5
    return F.when(F.size(a) < SIZE, F.size(a).cast("double")).otherwise((SIZE - 1) / share)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first text's shingles that the second has."""
    shared = resemblance(a, b) * distinct_shingles(merge(a, b))
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a)))


def as_string(a: Column) -> Column:
    return F.array_join(a.cast("array<string>"), ",")


def _slice_of(bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are larger than doc_id, found among every STEP-th first."""
    if not bounds:
        return F.lit(0)
    above = lambda b: b > F.col("doc_id")
    every, coarse = (F.array(*map(F.lit, x)) for x in (bounds, bounds[STEP - 1 :: STEP] or bounds[:0]))
    if len(bounds) < STEP:
        return F.size(F.filter(every, above))
    whole = F.size(F.filter(coarse, above)) * STEP
    return whole + F.size(F.filter(F.slice(every, whole + 1, F.lit(STEP)), above))


def with_next(documents: DataFrame) -> DataFrame:
    """(doc_id, text, sketch, next_text, next_sketch): next is the document with the next lower id, after the lowest the
    highest; rows without an id come last, rows of equal ids in order of a hash of their text.

    Ids are sliced at quantiles, so that a slice is a window of its own. Each slice also gets the first row of the
    slice after it, a few rows in all.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = rows.count()
    slices = min(SLICES, n // SLICE + 1)
    shares = [k / slices for k in range(1, slices)]
    bounds = []
    if shares:
        quantiles = F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), F.lit(20 * slices))
        bounds = sorted(set(rows.agg(quantiles).first()[0] or []), reverse=True)
    order = F.xxhash64("text")
    place = F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(_slice_of(bounds))
    placed = rows.withColumns({"slice": place, "tie": order})

    # One row per slice, SLICES + 1 at most: small by construction, and so are the rows they stand for.
    first = F.min(F.struct((-F.col("doc_id")).alias("order"), F.col("tie").alias("tie")))
    heads = placed.select("slice", "doc_id", "tie").groupBy("slice").agg(first.alias("first"))
    round_ = Window.partitionBy(F.lit(0)).orderBy("slice")
    before = F.coalesce(F.lag("slice").over(round_), F.max("slice").over(Window.partitionBy(F.lit(0))))
    heads = heads.select(before.alias("into"), (-F.col("first.order")).alias("id"), F.col("first.tie").alias("id_tie"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tie") == F.col("id_tie"))
    guests = placed.join(F.broadcast(landed(heads, "heads")), same).dropDuplicates(["into"])
    guests = guests.select("doc_id", "text", F.col("into").alias("slice"), "tie")

    everyone = placed.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))
    everyone = with_sketch(everyone, "text", "sketch")
    inside = Window.partitionBy("slice").orderBy("guest", F.col("doc_id").desc_nulls_last(), "tie")
    following = everyone.withColumns({"next_text": F.lead("text").over(inside), "next_sketch": F.lead("sketch").over(inside)})
    return following.where("not guest").select("doc_id", "text", "sketch", "next_text", "next_sketch")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n, out = F.length("text"), F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - out), F.substring("next_text", F.lit(1), out))
    rows = rows.select(
        "doc_id", n.cast("long").alias("n_chars"), "sketch", edited.alias("edited"), resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next")
    )
    rows = with_sketch(rows, "edited", "edited_sketch")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_string(F.col("sketch")).alias("fingerprint"),
        as_string(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        "near_next",
    )


QUERIES = {"op8_fingerprints": op8_fingerprints}
ORACLES: dict[str, str] = {}
