"""Small helpers the operators share: table reads, task iteration, token patterns, sessions."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadpulse.workspace import fresh_dir, landed

__all__ = ["Remembered", "fold", "fresh_dir", "landed", "map_batches", "ready", "table", "takes_over", "words_of", "WORD"]

#: A word: code points other than the ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers find this package where the driver found it, and sends them rows in small batches: texts may
    be long, and a session's default of 10,000 rows is made for numbers."""
    if spark.conf.get(_ROWS) == "10000":
        spark.conf.set(_ROWS, "1000")
    environment = spark.sparkContext.environment
    if ROOT not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, environment.get("PYTHONPATH", "")) if p)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fold(ids: Column | str, parts: int) -> Column:
    """crc32 of an id written as text, modulo ``parts``; a null id counts as fold 0."""
    return F.coalesce(F.pmod(F.crc32((F.col(ids) if isinstance(ids, str) else ids).cast("string")), F.lit(parts)), F.lit(0))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8 with A-Z in lower case: bytes split at just the ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with set-up once per task: ``make`` returns the function for one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                yield work(batch)

    return df.mapInArrow(run, schema)


_owner: list = ["", None]


def takes_over(owner: str, forget: Callable[[], None] | None = None) -> None:
    """Says in a task that this worker now runs ``owner``'s step. Workers outlive their tasks: what the last owner remembers
    is forgotten (it would be computed again), so that steps' memories don't add up. ``forget`` does that for ``owner``."""
    if _owner[0] != owner:
        if _owner[1]:
            _owner[1]()
        pa.default_memory_pool().release_unused()
    _owner[:] = owner, forget


class Remembered:
    """What a worker remembers, in two generations: once ``most`` are new, those not used since the last turn are
    forgotten. At most ``2 * most`` entries; values of keys over ``longest`` are for one use only."""

    def __init__(self, most: int, longest: int):
        self.now, self.older, self.once = {}, {}, []
        self.most, self.longest = most, longest

    def missing(self, keys: set) -> list:
        """Which of ``keys`` are not in ``now`` and must be made; those of the older generation come back."""
        for k in self.once:
            self.now.pop(k, None)
        self.once = []
        if len(self.now) > self.most:
            self.now, self.older = {}, self.now
        now, older, found = self.now, self.older, []
        for k in keys.difference(now):
            if k in older:
                now[k] = older[k]
            else:
                found.append(k)
        return found

    def learn(self, keys: list, values: list) -> None:
        self.now.update(zip(keys, values))
        self.once = [k for k in keys if len(k) > self.longest]


def components_sql(nodes: str, links: str) -> str:
    """SQL for (id, component_id): the smallest id that each of ``nodes`` (id) reaches by ``links`` (a, b, both ways)."""
    return f"""
        SELECT id, min(reached) AS component_id FROM (
          WITH RECURSIVE reach(id, reached) AS (
            SELECT id, id FROM {nodes} UNION SELECT r.id, l.b FROM reach r JOIN {links} l ON l.a = r.reached
          )
          SELECT * FROM reach
        ) GROUP BY id
    """
