"""One large GeoJSON document read by many tasks.

A JSON document can't be cut just anywhere, as what a brace means depends on all that comes before it. So it is read
twice. Both times the scan cuts files into blocks and blocks into records at closing braces, and every task reads its own
blocks. The first pass tells of each block how it changes the state (within a text or not, how deep in objects and
arrays) for both states it may begin in, whether within a text or not; running sums over these few numbers give the
state that each block does begin in. In the second pass a task knows which braces begin and end features and gives out
their texts. Features that cross a border between blocks come in fragments, which alone are shuffled to be joined.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from roadpulse.schemas import GEOJSON_FEATURE
from roadpulse.sources.geojson import flatten_features

#: Blocks that the driver holds the states of; at the usual 128 MB a block, documents of 120 TB in all.
MOST_BLOCKS = 1_000_000
_SIGN = re.compile(r'\\.|["{}\[\]]', re.DOTALL)
_WHOLE, _BEGINS, _GOES_ON, _ENDS = range(4)
_ROWS = 1000


class _State:
    """Where in a document a reader is."""

    __slots__ = ("inside", "objects", "arrays")

    def __init__(self, inside: bool, objects: int, arrays: int):
        self.inside, self.objects, self.arrays = inside, objects, arrays

    def read(self, record: str) -> Iterator[tuple[int, bool]]:
        """Follows a record; where features begin (place, True) and where the place behind their end is (place, False).

        A feature is an object in an array of a document's outermost object."""
        for sign in _SIGN.finditer(record):
            mark = sign[0]
            if mark == '"':
                self.inside = not self.inside
            elif self.inside or len(mark) > 1:
                continue
            elif mark == "{":
                self.objects += 1
                if self.objects == 2 and self.arrays == 1:
                    yield sign.start(), True
            elif mark == "}":
                self.objects -= 1
                if self.objects == 1 and self.arrays == 1:
                    yield sign.end(), False
            else:
                self.arrays += 1 if mark == "[" else -1


def _records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _blocks(batches) -> Iterator[tuple[tuple[str, int], str]]:
    """(file and block, record) of a task's rows."""
    for batch in batches:
        files, blocks, values = (batch.column(c).to_pylist() for c in ("file", "block", "value"))
        for file, block, value in zip(files, blocks, values):
            yield (file, block), value + "}"


def _changes(batches) -> Iterator[pa.RecordBatch]:
    """(file, block, flips, and by how much objects and arrays grow if the block begins outside or within a text)."""
    states: dict[tuple[str, int], tuple[_State, _State]] = {}
    for key, record in _blocks(batches):
        if key not in states:
            states[key] = _State(False, 0, 0), _State(True, 0, 0)
        for state in states[key]:
            for _ in state.read(record):
                pass
    rows = [
        {"file": f, "block": b, "flips": int(x.inside), "objects": x.objects, "arrays": x.arrays, "objects_in": y.objects, "arrays_in": y.arrays}
        for (f, b), (x, y) in states.items()
    ]
    if rows:
        yield pa.RecordBatch.from_pylist(rows)


def _begins(records: DataFrame) -> dict[tuple[str, int], tuple[bool, int, int]]:
    """The state that each block begins in."""
    columns = ["flips", "objects", "arrays", "objects_in", "arrays_in"]
    schema = "file string, block long, " + ", ".join(f"{c} long" for c in columns)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda column: F.coalesce(F.sum(column).over(earlier), F.lit(0))
    blocks = records.mapInArrow(_changes, schema).withColumn("inside", before("flips") % 2 == 1)
    grown = [F.when(F.col("inside"), F.col(f"{c}_in")).otherwise(F.col(c)).alias(c) for c in ("objects", "arrays")]
    states = blocks.select("file", "block", "inside", *grown)
    states = states.select("file", "block", "inside", before("objects").alias("objects"), before("arrays").alias("arrays"))
    found = states.limit(MOST_BLOCKS + 1).collect()  # one row a block
    if len(found) > MOST_BLOCKS:
        raise ValueError(f"more than {MOST_BLOCKS} blocks: read fewer documents at a time, or larger blocks")
    return {(r["file"], r["block"]): (r["inside"], r["objects"], r["arrays"]) for r in found}


def _texts(records: DataFrame, begins) -> DataFrame:
    """(file, block, kind, text): features that lie in one block, and the fragments of others."""

    def run(batches):
        rows: list[tuple[str, int, int, str]] = []
        at, state, held, kind = None, None, [], _WHOLE

        def close():
            """What is open at the end of a block is a fragment."""
            if at is not None and held:
                rows.append((*at, _BEGINS if kind == _WHOLE else _GOES_ON, "".join(held)))

        for key, record in _blocks(batches):
            if key != at:
                close()
                if key not in begins.value:
                    raise RuntimeError("the files or the session's file settings changed while they were read")
                at, state = key, _State(*begins.value[key])
                # Within a feature: this block has another part of it.
                kind = _ENDS if state.objects >= 2 and state.arrays >= 1 else _WHOLE
                held = [""] if kind == _ENDS else []
            start = 0
            for place, first in state.read(record):
                if first:
                    start, held, kind = place, [""], _WHOLE
                elif held:
                    rows.append((*key, kind, "".join(held) + record[start:place]))
                    held, kind = [], _WHOLE
            if held:
                held.append(record[start:])
            if len(rows) >= _ROWS:
                yield _batch(rows)
                rows = []
        close()
        if rows:
            yield _batch(rows)

    return records.mapInArrow(run, "file string, block long, kind int, text string")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["file", "block", "kind", "text"])


def _joined(fragments: DataFrame) -> DataFrame:
    """Features (text) from fragments; a block has at most the end of one and the begin of another."""
    place = Window.partitionBy("file").orderBy("block", F.col("kind") == _BEGINS)
    numbered = fragments.withColumn("feature", F.sum((F.col("kind") == _BEGINS).cast("int")).over(place))
    pieces = F.sort_array(F.collect_list(F.struct("block", "text")))
    whole = numbered.groupBy("file", "feature").agg(F.array_join(F.transform(pieces, lambda p: p["text"]), "").alias("text"))
    return whole.select("text")


def read_collection_ranges(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Features of FeatureCollection documents of any size, in the columns of ``read_collections``.

    Blocks are as large as ``spark.sql.files.maxPartitionBytes`` says, and a task
    holds one feature at a time. Objects in other arrays of a document's outermost
    object are left out unless they call themselves features. Text that is no JSON
    gives no features, or features of NULLs, like the other readers.
    """
    records = _records(spark, path)
    begins = spark.sparkContext.broadcast(_begins(records))
    texts = _texts(records, begins)
    whole = texts.where(F.col("kind") == _WHOLE).select("text")
    features = whole.unionByName(_joined(texts.where(F.col("kind") != _WHOLE)))
    parsed = features.select(F.from_json("text", GEOJSON_FEATURE).alias("feature")).select("feature.*")
    return flatten_features(parsed.where("type = 'Feature'"))
