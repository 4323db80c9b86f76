"""Embedding near-duplicates: spherical k-means cells, blocked cosine products inside them, one row kept per group.

Centres are fitted on a bounded sample, at most ``FIT_NUMBERS`` components in all; every vector is then assigned. Two
vectors with cosine ``LEAST`` or more are at most ``CHORD`` apart, so a vector whose own centre is nearer by no more
than that, measured across the border of two cells, also goes to the other cell as a guest: no link across a border
is lost. In a cell members meet members and guests in blocks of ``BLOCK``, as many tiles as the cell needs; a tile gives
counts and a tree of links, never pairs. Equal vectors are one class, compared once and counted by their number.

Cosines are products of unit vectors in double precision. Defined results: vectors that are null, empty or zero, or hold
null, NaN or infinite components, link with nothing; vectors of unequal length don't link; repeated rows are equal
vectors; a row without an id counts as a link and has no part in the smallest id. The label is not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadpulse.llm.common import components_sql, landed, ready, table
from roadpulse.llm.components import components

LEAST = 0.95
CHORD = math.sqrt(2 - 2 * LEAST)
#: Vectors to a cell, about; cells at most; numbers of the sample that fits them; rounds of the fit.
CELL = 4096
CELLS = 1024
FIT_NUMBERS = 2_000_000
ROUNDS = 12
BLOCK = 4096


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def centres(sample: np.ndarray, cells: int, seed: int = 7) -> np.ndarray:
    """Spherical k-means: unit centres that maximise the sum of cosines; a cell left empty takes the worst vector."""
    sample = unit(sample)
    cells = max(1, min(cells, len(sample)))
    found = sample[np.random.default_rng(seed).choice(len(sample), cells, replace=False)]
    for _ in range(ROUNDS):
        near = sample @ found.T
        own = near.argmax(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, own, sample)
        empty = np.flatnonzero(np.bincount(own, minlength=cells) == 0)
        sums[empty] = sample[np.argsort(near.max(axis=1))[: len(empty)]]
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        found = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), found)
    return found


def _valid(vector):
    """As expressions: a vector that can link."""
    finite = F.forall(vector, lambda x: F.coalesce((x == x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _numbers(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _assign(classes: DataFrame, size: int, found: np.ndarray | None) -> DataFrame:
    """(class, n, vector, cell, home): a row for each cell a class belongs to or visits."""

    def run(batches):
        if found is not None:
            apart = np.sqrt(np.maximum(2 - 2 * found @ found.T, 0))
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                batch = whole.slice(start, 2000)
                rows = unit(_numbers(batch.column("embedding")))
                near = rows @ found.T if found is not None else np.ones((len(rows), 1))
                own = near.argmax(axis=1)
                best = near[np.arange(len(rows)), own]
                reach = CHORD * apart[own] if found is not None else 1.0
                row, cell = np.nonzero(best[:, None] - near <= reach + 1e-9)
                data = [x.tobytes() for x in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("class").take(pa.array(row)),
                        batch.column("n").take(pa.array(row)),
                        pa.array([data[r] for r in row], pa.binary()),
                        pa.array(cell.astype(np.int64)),
                        pa.array(cell == own[row]),
                    ],
                    ["class", "n", "vector", "cell", "home"],
                )

    kind = classes.where(F.size("embedding") == size)
    named = kind.mapInArrow(run, "class long, n long, vector binary, cell long, home boolean")
    return named.withColumn("size", F.lit(size))


def _tile(part: pa.Table) -> pa.Table:
    """Members (left) against visitors of one tile: (class, links, to): summed links of each visitor, and a class that
    it is connected with."""
    left = part.column("left").to_numpy(zero_copy_only=False)
    vectors = np.frombuffer(b"".join(part.column("vector").to_pylist()), np.float64).reshape(part.num_rows, -1)
    ids, n = part.column("class").to_numpy(), part.column("n").to_numpy()
    members, visitors = np.flatnonzero(left), np.flatnonzero(~left)
    hit = np.zeros((len(visitors), len(members)), bool)
    links = np.zeros(len(visitors), np.int64)
    for k in range(0, len(visitors), 512):
        rows = visitors[k : k + 512]
        linked = vectors[rows] @ vectors[members].T >= LEAST
        linked &= ids[rows][:, None] != ids[members]
        hit[k : k + 512] = linked
        links[k : k + 512] = linked @ n[members]
    to = np.full(len(visitors), -1)
    tree = []
    open_ = links > 0
    for first in np.flatnonzero(open_):
        if not open_[first]:
            continue
        # All that this visitor reaches, by turns members and visitors.
        seen = np.zeros(len(members), bool)
        front = np.array([first])
        while len(front):
            open_[front] = False
            to[front] = first
            fresh = hit[front].any(axis=0) & ~seen
            seen |= fresh
            front = np.flatnonzero(open_ & hit[:, np.flatnonzero(fresh)].any(axis=1)) if fresh.any() else front[:0]
        tree += [(int(ids[members[m]]), int(ids[visitors[first]])) for m in np.flatnonzero(seen)]
    kept = np.flatnonzero(links > 0)
    classes = np.r_[ids[visitors[kept]], np.array([a for a, _ in tree], np.int64)]
    target = np.r_[ids[visitors[to[kept]]], np.array([b for _, b in tree], np.int64)]
    return pa.table({"class": classes, "links": np.r_[links[kept], np.zeros(len(tree), np.int64)], "to": target})


def near_duplicates(rows: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each row of ``rows`` (vec_id, embedding)."""
    ready(rows.sparkSession)
    rows = rows.select("vec_id", "embedding").withColumn("class", F.when(_valid(F.col("embedding")), F.xxhash64("embedding")))
    whole = rows.where("class is not null")
    same = whole.groupBy("class").agg(
        F.count("*").alias("n"), F.min("vec_id").alias("least"), F.any_value("embedding").alias("embedding")
    )
    classes = landed(same, "vectors")
    kinds = [(r["size"], r["n"]) for r in classes.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n")).collect()]
    assigned = None
    for size, n in kinds:
        sample = classes.where(F.size("embedding") == size).select("embedding", F.xxhash64("class").alias("draw"))
        sample = sample.orderBy("draw").limit(max(1, FIT_NUMBERS // size)).select("embedding").toArrow()
        found = centres(_numbers(sample.column("embedding")), min(CELLS, -(-n // CELL)))
        part = _assign(classes.select("class", "n", "embedding"), size, found)
        assigned = part if assigned is None else assigned.unionByName(part)
    plain = rows.where("class is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if assigned is None:
        return _kept(plain)
    assigned = landed(assigned, "cells")

    counts = assigned.groupBy("size", "cell").agg(
        F.ceil(F.sum(F.col("home").cast("int")) / BLOCK).cast("int").alias("lefts"), F.ceil(F.count("*") / BLOCK).cast("int").alias("rights")
    )
    dealt = assigned.join(counts.where("lefts > 0"), ["size", "cell"])
    block = lambda seed, parts: F.pmod(F.xxhash64("class", F.lit(seed)), F.col(parts).cast("long")).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    members = dealt.where("home").withColumns({"left": F.lit(True), "i": block(1, "lefts")}).withColumn("j", every("rights"))
    visitors = dealt.withColumns({"left": F.lit(False), "j": block(2, "rights")}).withColumn("i", every("lefts"))
    columns = ["size", "cell", "i", "j", "left", "class", "n", "vector"]
    tiles = members.select(columns).unionByName(visitors.select(columns)).groupBy("size", "cell", "i", "j")
    links = landed(tiles.applyInArrow(lambda t: _tile(t), "class long, links long, to long"), "vector-links")

    roots = components(links.select(F.col("class").alias("a"), F.col("to").alias("b"))).withColumnRenamed("node", "class")
    degrees = links.groupBy("class").agg(F.sum("links").alias("links"))
    named = classes.select("class", "n", "least").join(degrees, "class", "left").join(roots, "class", "left")
    named = landed(named.withColumn("root", F.coalesce("root", "class")), "classes")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    links_ = (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
    named = named.join(smallest, "root").select("class", links_, "component_id")
    full = whole.select("vec_id", "class").join(named, "class").select("vec_id", "n_links", "component_id")
    return _kept(full.unionByName(plain))


def _kept(rows: DataFrame) -> DataFrame:
    return rows.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES = {"op3_embeddings": op3_embeddings}

ORACLES = {
    "op3_embeddings": f"""
        WITH vectors AS (
          SELECT vec_id AS id, embedding::DOUBLE[] AS v, coalesce(len(embedding), 0) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS able
          FROM embeddings
        ),
        linked AS (
          SELECT a.id AS a, b.id AS b FROM vectors a JOIN vectors b
          ON a.able AND b.able AND a.id <> b.id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= {LEAST}
        ),
        degrees AS (SELECT a, count(*) AS n FROM linked GROUP BY a)
        SELECT v.id AS vec_id, coalesce(d.n, 0) AS n_links, c.component_id, v.id = c.component_id AS kept
        FROM vectors v JOIN ({components_sql("vectors", "linked")}) c ON c.id = v.id LEFT JOIN degrees d ON d.a = v.id
    """
}
