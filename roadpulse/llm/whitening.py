"""Whitening of embeddings by shifted CholeskyQR.

Rows are centred and orthogonalised by distributed passes: each pass adds up the Gram matrix of the rows behind the
triangular solves so far, and its Cholesky factor is one more solve. The first passes add a small multiple of the
identity, so that a Gram matrix of rounded numbers always has a factor. The factors compose to R of the centred rows; the
singular values and right vectors of R are those of the rows, at the precision of the rows instead of their squares.

Entries are turned into whole numbers floor(64 c) + 1000000 first (``SCALE``, ``OFFSET``), so that sums and deviations
are exact. A centred entry is the exact difference n x - S, divided by n once. Tasks send one matrix each; matrices are
added up in two steps of about equally many, in the order of the tasks, so that reruns agree. The driver holds matrices
of ``MOST_DIMENSIONS`` columns at most and never a row.

Defined results: null vectors, and those with null or non-finite entries, are left out and in no sum; so are empty ones,
which have no component. Vectors of another length than others are a list of their own, with sums, covariance and
components of their own. Repeated vectors and ids count as often as they are there. A direction without variance (a
constant column, one that others add up to, a single row), or with less than 1e-14 of the largest, has no component. Entries beyond 2^40 units of 1/64 are held to
that; a deviation that no long holds is null. The sign of a component makes its largest entry positive; components of
equal eigenvalues are any basis of their space. An empty table has no rows. Other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadpulse.llm.common import landed, ready, table

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Widest rows; matrices of their width go to the driver.
MOST_DIMENSIONS = 4096
#: Passes of the factorisation: a shifted one and at least two more, until rows are this near to orthonormal.
PASSES, NEAR = 6, 1e-13
#: A direction with less than this share of the largest deviation counts as one without: rounding leaves less.
RANK = 1e-7
_MOST = 2**40
_EPSILON = np.finfo(np.float64).eps


def usable(vector: Column) -> Column:
    """A vector without null or non-finite entries, of one entry at least."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return vector.isNotNull() & (F.size(vector) > 0) & finite


def whole_numbers(column: pa.Array, size: int) -> np.ndarray:
    values = np.asarray(column.flatten()).astype(np.float64).reshape(-1, size)
    return np.clip(np.floor(values * SCALE), -_MOST, _MOST).astype(np.int64) + OFFSET


class Centre:
    """The exact mean of n rows of whole numbers."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.near = np.array([round(s / n) if s < 2**52 else s // n for s in sums], np.int64)
        #: What is left of the sums about ``near``; less than a few n in size.
        self.left = [s - n * int(m) for s, m in zip(sums, self.near)]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly: in longs where they hold it, else in Python's integers."""
        about = x - self.near
        reach = (int(np.abs(about).max(initial=0)) + 2) * self.n
        if reach**2 * x.shape[1] >= 2**63:
            return about.astype(object) * self.n - np.array(self.left, object)
        return about * np.int64(self.n) - np.array(self.left, np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(np.float64) / self.n


def _task_sums(rows: DataFrame, size: int, work: Callable[[], Callable[[pa.RecordBatch], np.ndarray]]) -> DataFrame:
    """(task, sums): for each task the sum of what ``work`` makes of its batches, doubles as bytes."""

    def run(batches):
        one, total = work(), None
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                made = one(whole.slice(start, 4096))
                total = made if total is None else total + made
        if total is not None:
            task = pa.array([TaskContext.get().partitionId()], pa.int32())
            yield pa.RecordBatch.from_pydict({"task": task, "sums": [total.tobytes()]})

    return rows.where(F.size("embedding") == size).mapInArrow(run, "task int, sums binary")


def _added(part: pa.Table) -> pa.Table:
    part = part.sort_by("task")
    total = None
    for data in part.column("sums"):
        made = np.frombuffer(data.as_buffer(), np.float64)
        total = made.copy() if total is None else total + made
    return pa.table({"task": pa.array([part.column("task")[0].as_py()], pa.int32()), "sums": [total.tobytes()]})


def _total(sums: DataFrame) -> np.ndarray:
    """All tasks' sums in two steps: no task of either has more than about the root of their number."""
    tasks = max(1, sums.rdd.getNumPartitions())
    groups = math.isqrt(tasks - 1) + 1
    for group in (F.floor(F.col("task") / groups), F.lit(0)):
        sums = sums.groupBy(group.alias("group")).applyInArrow(lambda part: _added(part), "task int, sums binary")
    (row,) = sums.select("sums").collect()  # one matrix
    return np.frombuffer(row["sums"], np.float64)


def column_sums(rows: DataFrame, size: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of each column."""

    def run(batches):
        count, total = 0, [0] * size
        for batch in batches:
            x = whole_numbers(batch.column("embedding"), size)
            count += len(x)
            total = [a + b for a, b in zip(total, x.sum(axis=0).tolist())]
        if count:
            yield pa.RecordBatch.from_pydict(
                {"column": pa.array([-1, *range(size)], pa.int32()), "total": [str(t) for t in (count, *total)]}
            )

    parts = rows.where(F.size("embedding") == size).mapInArrow(run, "column int, total string")
    exact = F.sum(F.col("total").cast("decimal(28,0)"))
    found = {r["column"]: int(r["total"]) for r in parts.groupBy("column").agg(exact.alias("total")).collect()}
    return found[-1], [found[k] for k in range(size)]


def gram(rows: DataFrame, size: int, centre: Centre, solve: np.ndarray) -> np.ndarray:
    """Gram matrix of the centred rows times ``solve``, an upper triangular matrix."""

    def work():
        def one(batch: pa.RecordBatch) -> np.ndarray:
            q = centre.centred(whole_numbers(batch.column("embedding"), size)) @ solve
            return q.T @ q

        return one

    return _total(_task_sums(rows, size, work)).reshape(size, size)


def _factor(matrix: np.ndarray, first: bool, n: int) -> np.ndarray:
    """Upper Cholesky factor of the matrix. The first pass is shifted as the method's analysis asks; later ones are near
    the identity wherever rows have variance, and shifted only where they have none."""
    size = len(matrix)
    least = 11 * _EPSILON * size * (size + 1 + (n if first else 0))
    reach = max(np.linalg.norm(matrix, 2), np.finfo(np.float64).tiny)
    shift = min(least, 1e-3) if first else 0.0
    while True:
        try:
            return np.linalg.cholesky(matrix + shift * reach * np.eye(size)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, least)


def triangular(rows: DataFrame, size: int, n: int, centre: Centre) -> np.ndarray:
    """R of the QR decomposition of the centred rows."""
    r = np.eye(size)
    for k in range(PASSES):
        found = gram(rows, size, centre, np.linalg.inv(r))
        found = (found + found.T) / 2
        if not found.any():
            return found  # rows that are all equal
        r = _factor(found, k == 0, n) @ r
        # Directions without variance never come near the identity; more passes would add up rounding there.
        near = np.abs(found - np.eye(size)).max() < NEAR * max(1.0, math.sqrt(n))
        if k >= 2 and (near or np.linalg.cond(r) > 1 / RANK):
            break
    return r


class Whitener:
    """The components of one list of rows."""

    def __init__(self, size: int, n: int, centre: Centre, r: np.ndarray, most: int):
        self.size, self.n, self.centre = size, n, centre
        _, singular, right = np.linalg.svd(r)
        values = singular**2 / n
        able = int((singular > RANK * singular[0]).sum()) if values[0] > 0 else 0
        rank = min(able, size, most)
        axes = right[:rank]
        peak = np.abs(axes).argmax(axis=1)
        axes *= np.sign(axes[np.arange(rank), peak])[:, None]
        self.values, self.trace = values[:rank], float(values.sum())
        self.axes = axes
        self.map = axes.T / np.sqrt(self.values)

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.map

    def deviations(self, x: np.ndarray) -> list[int | None]:
        scaled = self.centre.scaled(x)
        found = (scaled * scaled).sum(axis=1).tolist()
        return [d if d < 2**63 else None for d in found] if scaled.dtype == object else found


def fitted(rows: DataFrame, size: int, most: int = COMPONENTS) -> Whitener:
    """Components of the rows (embedding) of one length."""
    if size > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {size} entries are wider than {MOST_DIMENSIONS}")
    n, sums = column_sums(rows, size)
    centre = Centre(n, sums)
    return Whitener(size, n, centre, triangular(rows, size, n, centre), most)


def applied(rows: DataFrame, whitener: Whitener) -> DataFrame:
    """(vec_id, deviation, whitened), whitened an array of doubles, for the rows (vec_id, embedding) of its length."""

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                x = whole_numbers(batch.column("embedding"), whitener.size)
                made = whitener.apply(x)
                ends = np.arange(len(x) + 1, dtype=np.int32) * made.shape[1]
                white = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(made).ravel()))
                columns = [batch.column("vec_id"), pa.array(whitener.deviations(x), pa.int64()), white]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "deviation", "whitened"])

    kind = rows.where(F.size("embedding") == whitener.size).select("vec_id", "embedding")
    vec_id = kind.schema["vec_id"].dataType.simpleString()
    return kind.mapInArrow(run, f"vec_id {vec_id}, deviation long, whitened array<double>")


def identity_error(white: DataFrame, whitener: Whitener) -> float:
    """How far the covariance of the whitened rows, added up anew, is from the identity at worst."""
    rank = len(whitener.values)
    if not rank:
        return 0.0

    def sums_of(mean: np.ndarray | None):
        def one(batch: pa.RecordBatch) -> np.ndarray:
            y = np.asarray(batch.column("embedding").flatten()).reshape(-1, rank)
            return y.sum(axis=0) if mean is None else (y - mean).T @ (y - mean)

        return lambda: one

    rows = white.select(F.col("whitened").alias("embedding"))
    mean = _total(_task_sums(rows, rank, sums_of(None))) / whitener.n
    covariance = _total(_task_sums(rows, rank, sums_of(mean))).reshape(rank, rank) / whitener.n
    return float(np.abs(covariance - np.eye(rank)).max())


def whitened(rows: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): up to ``most`` components of each of
    ``rows`` (vec_id, embedding)."""
    ready(rows.sparkSession)
    rows = rows.select("vec_id", "embedding").where(usable(F.col("embedding")))
    found = None
    for row in rows.groupBy(F.size("embedding").alias("size")).count().orderBy("size").collect():  # lengths of vectors
        whitener = fitted(rows, row["size"], most)
        white = landed(applied(rows, whitener), "whitened")
        error, shares = identity_error(white, whitener), (whitener.values / whitener.trace).tolist()
        part = white.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
            "vec_id",
            (F.col("place") + 1).alias("component"),
            F.lit(whitener.n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(F.lit(shares).cast("array<double>"), F.col("place")).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
        found = part if found is None else found.unionByName(part)
    if found is None:
        vec_id = rows.schema["vec_id"].dataType.simpleString()
        schema = f"vec_id {vec_id}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return rows.sparkSession.createDataFrame([], schema)
    return found


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


QUERIES = {"op11_whitening": op11_whitening}
ORACLES: dict[str, str] = {}
