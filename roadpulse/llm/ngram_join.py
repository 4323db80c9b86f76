"""N-gram Jaccard join: documents are points of the Jaccard metric over their sets of five-word shingles.

Equal sets are one class, and only classes are compared. ``1 - J`` is a metric, so a pair at distance ``REACH`` or less
obeys the triangle inequality at every pivot. The join is exact and runs in these steps:

1. *Screen.* Every class lists its shingles with the lowest hashes, 3/8 of its set. Two linked classes hold more than
   3/32 of either set in common in those lists, so a class with fewer listed shingles seen elsewhere has no partner.
2. *Pivots and regions.* Of the classes left, those that hold one listed shingle in common belong to the region of
   the smallest of them, its pivot; a class stays away from the pivots it shares least with. Linked classes always
   meet in some region.
3. *Large regions* are dealt in pieces, each with a copy of the pivot: members within reach of the pivot are linked to
   it. The rest is compared block by block with the members that the window ``|d(x,p) - d(y,p)| <= REACH`` allows.
4. *Small regions, and pieces*, join recursively: a few pivots create Voronoi regions, every point also goes to each
   region whose pivot is at most ``2 * REACH`` farther than its own, and regions that would not save comparisons
   compare pivot by pivot. Points that are already connected are not compared again, and points that share too little of
   their set with all others of a region are left out of it.

Links within a class and between classes then give components. Classes, shingles: 64-bit hashes.

Defined results: null and empty texts, and texts of white space, have an empty set and their own id as component;
repeated rows each get a row; rows whose id is null take part and get the smallest id of their component, null if it
has none. Columns beside doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from roadpulse.llm.common import WORD, components_sql, landed, map_batches, ready, table, takes_over
from roadpulse.llm.components import components
from roadpulse.llm.shingles import WIDTH, forget_words, shingle_set

#: Linked: 100 * shared >= PERCENT * united; REACH is the same as a distance, PIVOTS the pivots of one recursion.
PERCENT = 75
REACH = 1 - PERCENT / 100
PIVOTS = 8
#: Classes that one task compares at once, and list entries that one task sorts at once.
BLOCK = 1000
ENTRIES = 1_000_000
#: Tasks that the members of one region are dealt to where regions are looked up.
SALTS = 16


def _class_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - 2**63


def _listed(size: int) -> int:
    return min(size, 3 * size // 8 + 1)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], list(columns))


def _copy():
    return F.xxhash64("text")


_LISTS = ("hashes", "classes", "known", "counted", "n", "row_id", "row_blank", "row_copy", "row_size", "row_class")


def survey(documents: DataFrame) -> DataFrame:
    """One pass over the texts, written: a row for each row of ``documents``, with doc_id, copy (a hash of the text),
    n_shingles and class (null for an empty set); and rows with a class and ``common``, how many of its listed shingles
    it holds in common with other classes, in parts to be summed.

    Rows go to buckets in turn, listed shingles to buckets of their hash, as packed arrays. A shingle that two classes of
    one task's share hold is sent once, marked as known, and counted for those classes at once; so no list grows with the
    copies in a task.
    """
    octets, n = documents.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # About 17 bytes of text to a listed shingle.
    buckets = max(parts, 1 + (octets or 0) // (17 * ENTRIES), 1 + n // ENTRIES)

    def packed(first_row: int, rows: list[tuple], sets: dict[int, np.ndarray]) -> pa.RecordBatch:
        row_id, row_copy, row_size, row_class = (np.array(x, np.int64) for x in zip(*((r[0] or 0, *r[1:]) for r in rows)))
        row_blank = np.array([r[0] is None for r in rows])
        lengths = np.fromiter(map(len, sets.values()), np.int64, len(sets))
        hashes = np.concatenate([*sets.values(), np.zeros(0, np.uint64)])
        classes = np.repeat(np.fromiter(sets, np.int64, len(sets)), lengths)
        order = np.argsort(hashes, kind="stable")
        hashes, classes = hashes[order], classes[order]
        first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)])
        held = np.diff(np.r_[first, len(hashes)])
        counted, n = np.unique(classes[np.repeat(held, held) > 1], return_counts=True)
        groups = [
            (hashes[first] % np.uint64(buckets), (hashes[first], classes[first], held > 1)),
            (counted % buckets, (counted, n.astype(np.int64))),
            ((first_row + np.arange(len(rows))) % buckets, (row_id, row_blank, row_copy, row_size, row_class)),
        ]
        columns = []
        for place, arrays in groups:
            place = place.astype(np.int64)
            order = np.argsort(place, kind="stable")
            ends = np.cumsum(np.bincount(place, minlength=buckets))
            parts_ = [order[a:b] for a, b in zip(np.r_[0, ends[:-1]], ends)]
            columns += [[x[p].tobytes() for p in parts_] for x in arrays]
        return _batch(bucket=pa.array(range(buckets), pa.int32()), **dict(zip(_LISTS, columns)))

    def run(batches):
        from pyspark import TaskContext

        takes_over("shingles", forget_words)
        # Rows go to buckets in turn: those of one text are as many as the table has.
        rows, sets, entries, first_row = [], {}, 0, TaskContext.get().partitionId()
        for batch in batches:
            for doc_id, text, copy in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "copy"))):
                shingles = shingle_set(text)
                kind = _class_of(shingles) if len(shingles) else 0
                rows.append((doc_id, copy, len(shingles), kind))
                if len(shingles) and kind not in sets:
                    sets[kind] = shingles[: _listed(len(shingles))].copy()
                    entries += len(sets[kind])
            if max(entries, len(rows)) > ENTRIES:
                yield packed(first_row, rows, sets)
                rows, sets, entries, first_row = [], {}, 0, first_row + len(rows)
        if rows:
            yield packed(first_row, rows, sets)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _copy().alias("copy"))
    lists = rows.mapInArrow(run, "bucket int, " + ", ".join(f"{c} binary" for c in _LISTS))
    found = lists.repartition(buckets, "bucket").groupBy("bucket")
    return landed(found.applyInArrow(_bucket, "doc_id long, copy long, n_shingles long, class long, common long"), "survey")


def _bucket(part: pa.Table) -> pa.Table:
    """The rows of one bucket, and how many of its shingles each class holds in common with another class."""
    takes_over("ngram_join")  # no words from here on
    join = lambda name, kind: np.frombuffer(b"".join(part.column(name).to_pylist()), kind)
    hashes, kinds, known = join("hashes", np.uint64), join("classes", np.int64), join("known", np.bool_)
    order = np.lexsort((kinds, hashes))
    hashes, kinds, known = hashes[order], kinds[order], known[order]
    new = np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)]
    group = np.cumsum(new) - 1
    apart = np.r_[True, (kinds[1:] != kinds[:-1]) | new[1:]][: len(hashes)]
    several = (np.bincount(group, apart) > 1) | (np.bincount(group, known) > 0) if len(group) else np.zeros(0, bool)
    # What a task has marked as known it has also counted.
    found = kinds[several[group] & ~known & apart]
    classes, where = np.unique(np.r_[found, join("counted", np.int64)], return_inverse=True)
    common = np.bincount(where, np.r_[np.ones(len(found), np.int64), join("n", np.int64)], len(classes)).astype(np.int64)
    sizes, blank = join("row_size", np.int64), join("row_blank", np.bool_)
    nothing = lambda n: pa.nulls(n, pa.int64())
    heads = {
        "doc_id": pa.array(join("row_id", np.int64), mask=blank),
        "copy": pa.array(join("row_copy", np.int64)),
        "n_shingles": pa.array(sizes),
        "class": pa.array(join("row_class", np.int64), mask=sizes == 0),
        "common": nothing(len(sizes)),
    }
    n = len(classes)
    counts = {"doc_id": nothing(n), "copy": nothing(n), "n_shingles": nothing(n), "class": pa.array(classes), "common": pa.array(common)}
    return pa.concat_tables([pa.table(heads), pa.table(counts)])


class Points:
    """Sets of one task, with distances between them and the links found."""

    def __init__(self, ids: np.ndarray, sets: list[np.ndarray]):
        self.ids, self.sizes = ids, np.fromiter(map(len, sets), np.int64, len(sets))
        self.starts = np.r_[0, np.cumsum(self.sizes)]
        kinds, self.codes = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_inverse=True)
        self.lengths = self.sizes.copy()
        self.mark = np.zeros(len(kinds), bool)
        self.leader = np.arange(len(ids))
        self.links: list[tuple[int, int]] = []

    def _flat(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The codes of several points one after another, and where each one's end."""
        lengths = self.lengths[points]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[points] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        return self.codes[at], ends

    def _sums(self, values: np.ndarray, ends: np.ndarray) -> np.ndarray:
        totals = np.r_[0, np.cumsum(values)]
        return totals[ends] - totals[np.r_[0, ends[:-1]]] if len(ends) else np.zeros(0, np.int64)

    def narrowed(self, points: np.ndarray) -> tuple[Points, np.ndarray]:
        """The points that may have a link here, with the codes that two of them share; the rest of a set only counts
        in its size. A point that shares less than PERCENT of its set with all others together has no link."""
        while True:
            codes, ends = self._flat(points)
            shared = np.bincount(codes, minlength=1)[codes] > 1
            stay = 100 * self._sums(shared, ends) >= PERCENT * self.sizes[points]
            if stay.all():
                break
            points = points[stay]
        local = Points.__new__(Points)
        local.ids, local.sizes, local.links = self.ids[points], self.sizes[points], self.links
        local.lengths = self._sums(shared, ends)
        local.starts = np.r_[0, np.cumsum(local.lengths)]
        kinds, local.codes = np.unique(codes[shared], return_inverse=True)
        local.mark = np.zeros(len(kinds), bool)
        local.leader = np.arange(len(points))
        return local, points

    def distances(self, pivot: int, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances, and whether linked; compared as whole numbers."""
        own = self.codes[self.starts[pivot] : self.starts[pivot] + self.lengths[pivot]]
        self.mark[own] = True
        codes, ends = self._flat(to)
        shared = self._sums(self.mark[codes], ends)
        self.mark[own] = False
        united = self.sizes[to] + self.sizes[pivot] - shared
        return 1 - shared / united, 100 * shared >= PERCENT * united

    def link(self, pivot: int, others: np.ndarray) -> None:
        for k in others:
            mine, its = self.leader[pivot], self.leader[k]
            if mine != its:
                self.links.append((int(self.ids[pivot]), int(self.ids[k])))
                self.leader[self.leader == its] = mine

    def join(self, points: np.ndarray) -> None:
        """Connects all linked pairs among ``points``."""
        todo = [points]
        while todo:
            points = todo.pop()
            if len(points) < 2 or (self.leader[points] == self.leader[points[0]]).all():
                continue
            if len(points) > 4 * PIVOTS:
                pivots = points[np.linspace(0, len(points) - 1, PIVOTS).astype(int)]
                far = np.empty((PIVOTS, len(points)))
                for row, p in zip(far, pivots):
                    row[:], near = self.distances(p, points)
                    self.link(p, points[near])
                # Voronoi regions; a point near a border also goes to the regions across it.
                regions = far <= far.min(axis=0) + 2 * REACH + 1e-9
                if (regions.sum(axis=1) ** 2.0).sum() < 0.8 * len(points) ** 2:
                    todo += [points[r] for r in regions]
                    continue
            for k, p in enumerate(points[:-1]):
                # A window by sizes, and nothing that is connected already.
                rest = points[k + 1 :]
                rest = rest[self.leader[rest] != self.leader[p]]
                fits = 100 * np.minimum(self.sizes[rest], self.sizes[p]) >= PERCENT * np.maximum(self.sizes[rest], self.sizes[p])
                self.link(p, rest[fits][self.distances(p, rest[fits])[1]])


def _points(part: pa.Table) -> Points:
    return Points(part.column("class").to_numpy(), [np.frombuffer(s, np.uint64) for s in part.column("shingles").to_pylist()])


def _edges(links: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def _join_task(part: pa.Table) -> pa.Table:
    """Links inside whole regions, several at once; and for pieces of large regions the distance of each member to the
    pivot. As (a, b, far, linked), without far for links of the first kind."""
    takes_over("ngram_join")  # no words from here on
    kind = part.column("pivot")
    whole = part.filter(pc.is_null(kind))
    points, regions = _points(whole), whole.column("region").to_numpy()
    order = np.argsort(regions, kind="stable")
    for members in np.split(order, np.flatnonzero(np.diff(regions[order])) + 1):
        local, _ = points.narrowed(members)
        local.join(np.arange(len(local.ids)))
    n = len(points.links)
    found = [_edges(points.links).append_column("far", pa.nulls(n, pa.float64())).append_column("linked", pa.array([True] * n, pa.bool_()))]
    rest = part.filter(pc.is_valid(kind))
    for region in pc.unique(rest.column("region")):
        piece = rest.filter(pc.equal(rest.column("region"), region))
        points, pivot = _points(piece), np.flatnonzero(piece.column("pivot").to_numpy(zero_copy_only=False))
        others = np.setdiff1d(np.arange(piece.num_rows), pivot)
        far, near = points.distances(pivot[0], others)
        found.append(pa.table({"a": np.full(len(others), region.as_py(), np.int64), "b": points.ids[others], "far": far, "linked": near}))
    return pa.concat_tables(found)


def _across(part: pa.Table) -> pa.Table:
    """A block of members not linked to their pivot, and a block of others: links between the two within windows."""
    takes_over("ngram_join")  # no words from here on
    points, kept = _points(part).narrowed(np.arange(part.num_rows))
    left, far = part.column("left").to_numpy(zero_copy_only=False)[kept], part.column("far").to_numpy()[kept]
    others = np.flatnonzero(~left)
    if not (~part.column("left").to_numpy(zero_copy_only=False)).any():
        points.join(np.flatnonzero(left))
        return _edges(points.links)
    for p in np.flatnonzero(left):
        open_ = others[(np.abs(far[others] - far[p]) <= REACH + 1e-9) & (points.leader[others] != points.leader[p])]
        points.link(p, open_[points.distances(p, open_)[1]])
    return _edges(points.links)


def links(documents: DataFrame, found: DataFrame) -> DataFrame:
    """(a, b): pairs of linked classes that connect all linked classes; ``found`` as :func:`survey` has it."""
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = found.where("class is not null").groupBy("class")
    # One row stands for its class: ids repeat with other texts, so its text's hash names it as well.
    place = F.struct(F.col("doc_id").isNull().alias("blank"), "doc_id", "copy")
    stands = F.min(F.when(F.col("common").isNull(), place)).alias("stands")
    by = by.agg(F.max("n_shingles").alias("n_shingles"), F.sum("common").alias("common"), stands)
    left = by.where("common > 3 * n_shingles div 32").select("class", "stands.doc_id", "stands.copy")
    left = landed(left, "screened")

    def make():
        takes_over("shingles", forget_words)

        def work(batch):
            sets = [shingle_set(t) for t in batch.column("text").to_pylist()]
            want = batch.column("class").to_pylist()
            kept = [k for k, s in enumerate(sets) if len(s) and _class_of(s) == want[k]]
            return _batch(
                **{"class": pa.array([want[k] for k in kept], pa.int64())},
                size=pa.array([len(sets[k]) for k in kept], pa.int64()),
                shingles=pa.array([sets[k].tobytes() for k in kept], pa.binary()),
                listed=pa.array([sets[k][: _listed(len(sets[k]))].view(np.int64) for k in kept], pa.list_(pa.int64())),
            )

        return work

    # One document of each class is read again. Its id may be null, its row repeated.
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _copy().alias("copy"))
    left = left.select("class", F.col("doc_id").alias("of"), F.col("copy").alias("by")).hint("merge")
    texts = texts.join(left, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("copy") == F.col("by")))
    texts = texts.dropDuplicates(["class"]).select("text", "class")
    sets = landed(map_batches(texts, make, "class long, size long, shingles binary, listed array<long>"), "sets")
    return _joined(_regions(sets), sets.select("class", "shingles"), parts)


def _regions(sets: DataFrame) -> DataFrame:
    """(region, class, members): regions by the id of their pivot, the smallest class in each.

    A class need not go to every pivot that it shares a listed shingle with. Linked classes share more than 3/32 of
    either set in their lists, so each may stay away from the pivots it shares least with, as long as that is less than
    3/64 of its set in all; they still meet at one. A region all of whose members also meet in one other region is
    left out.
    """
    entries = sets.select("class", "size", F.explode("listed").alias("shingle"))
    pivots = entries.groupBy("shingle").agg(F.min("class").alias("region"), F.count("*").alias("n")).where("n > 1")
    shared = entries.join(pivots.select("shingle", "region"), "shingle").groupBy("class", "size", "region").agg(F.count("*").alias("n"))
    least_first = Window.partitionBy("class").orderBy("n", "region")
    members = shared.withColumn("away", F.sum("n").over(least_first)).where("64 * away >= 3 * size").select("region", "class")
    members = landed(members, "members")
    # Relabelled by the smallest class that is still in it.
    smallest = members.groupBy("region").agg(F.min("class").alias("pivot"))
    members = _dealt(members, smallest).select(F.col("pivot").alias("region"), "class").distinct()
    members = landed(members, "members")
    homes = members.groupBy("class").agg(F.min("region").alias("home"))
    homes = members.join(homes, "class").groupBy("region").agg(F.min("home").alias("a"), F.max("home").alias("b"), F.count("*").alias("members"))
    own = homes.where("(a <> b or a = region) and members > 1").select("region", "members")
    return landed(_dealt(members, own), "regions")


def _dealt(members: DataFrame, regions: DataFrame) -> DataFrame:
    """``members`` (region, class) joined with a row of each region: a large region is dealt to ``SALTS`` tasks."""
    salted = regions.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    members = members.withColumn("salt", F.pmod(F.xxhash64("class"), F.lit(SALTS)).cast("int"))
    return members.join(salted, ["region", "salt"]).drop("salt")


_FOUND = "a long, b long, far double, linked boolean"


def _joined(members: DataFrame, held: DataFrame, parts: int) -> DataFrame:
    """(a, b): links inside all regions. Small regions, about BLOCK members to a task, join whole; large ones are dealt
    in pieces, each with the pivot."""
    groups = max(parts, 1 + members.count() // BLOCK)
    small = members.where(F.col("members") <= BLOCK)
    small = small.select("region", "class", F.pmod(F.xxhash64("region"), F.lit(groups)).alias("task"), F.lit(None).cast("boolean").alias("pivot"))
    large = members.where(F.col("members") > BLOCK)
    pieces = F.ceil(F.col("members") / BLOCK).cast("int")
    piece = F.pmod(F.xxhash64("class"), pieces.cast("long")).cast("int")
    task = lambda p: F.xxhash64("region", p).alias("task")
    dealt = large.where("class <> region").select("region", "class", task(piece), F.lit(False).alias("pivot"))
    heads = large.where("class = region").withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    heads = heads.select("region", "class", task(F.col("piece")), F.lit(True).alias("pivot"))
    tasks = small.unionByName(dealt).unionByName(heads).join(held, "class").repartition(groups, "task").groupBy("task")
    found = landed(tasks.applyInArrow(lambda t: _join_task(t), _FOUND), "links")
    links_ = found.where("linked").select("a", "b")
    measured = found.where("far is not null")
    if measured.where("not linked").isEmpty():
        return links_
    measured = measured.select(F.col("a").alias("region"), F.col("b").alias("class"), "far", "linked")
    return links_.unionByName(_rest(measured, held, groups))


def _rest(measured: DataFrame, held: DataFrame, groups: int) -> DataFrame:
    """Members beyond the pivot's reach, against each other and against those whose window they share."""
    open_ = measured.where("not linked").groupBy("region").agg(F.count("*").alias("rest"), F.min("far").alias("nearest"))
    blocks = F.ceil(F.col("rest") / BLOCK).cast("int")
    rows = measured.join(open_, "region").withColumn("blocks", blocks)
    left = rows.where("not linked").withColumn("block", F.pmod(F.xxhash64("class", F.lit(1)), F.col("blocks").cast("long")).cast("int"))
    # Tiles of the rest: block i with block j >= i. A block meets itself in tile (i, i).
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    tiles = left.withColumn("other", F.explode(others))
    tiles = tiles.select(
        "region", "class", "far", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") <= F.col("other")).alias("left")
    )
    # Linked members near the border, in pieces of their own numbered from -1 down.
    near = rows.where(F.col("linked") & (F.col("far") >= F.col("nearest") - REACH - 1e-9))
    near_n = near.groupBy("region").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("pieces"))
    across = left.join(near_n, "region").withColumn("j", F.explode(F.sequence(F.lit(1), F.col("pieces"))))
    across = across.select("region", "class", "far", F.col("block").alias("i"), (-F.col("j")).alias("j"), F.lit(True).alias("left"))
    piece = -1 - F.pmod(F.xxhash64("class", F.lit(2)), F.col("pieces").cast("long")).cast("int")
    border = near.join(near_n, "region").withColumn("i", F.explode(others))
    border = border.select("region", "class", "far", "i", piece.alias("j"), F.lit(False).alias("left"))
    tiles = tiles.unionByName(across).unionByName(border)
    dealt = tiles.join(held, "class").repartition(groups, "region", "i", "j").groupBy("region", "i", "j")
    return dealt.applyInArrow(lambda t: _across(t), "a long, b long")


def grouped(documents: DataFrame) -> DataFrame:
    """A row for each row of ``documents`` (doc_id, text): doc_id, copy, n_shingles, class, root, component_id. Rows of
    one root are one group; class and root are null for empty sets."""
    ready(documents.sparkSession)
    found = survey(documents)
    sizes = found.where("common is null").drop("common")
    edges = landed(links(documents, found), "class-links")
    roots = components(edges).select(F.col("node").alias("class"), F.col("root"))
    some = sizes.where("class is not null")
    classes = some.groupBy("class").agg(F.min("doc_id").alias("least"))
    named = classes.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    full = some.join(named.join(smallest, "root").select("class", "root", "component_id"), "class")
    empty = sizes.where("class is null").withColumns({"root": F.lit(None).cast("long"), "component_id": F.col("doc_id")})
    columns = ["doc_id", "copy", "n_shingles", "class", "root", "component_id"]
    return full.select(columns).unionByName(empty.select(columns))


def representatives(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each group, that with the smallest id; rows without words all stay."""
    rows = grouped(documents.select("doc_id", "text")).where("root is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("blank"), F.col("doc_id").alias("id"), F.col("copy").alias("copy")))
    kept = landed(rows.groupBy("root").agg(first.alias("first")).select("first.id", "first.copy").distinct(), "kept")
    # The caller's row is one column here, whatever its columns are called.
    whole = documents.select(F.struct("*").alias("row"))
    wordy = F.coalesce(F.col("row.text").rlike(WORD), F.lit(False))
    found = whole.where(wordy).withColumns({"of": F.col("row.doc_id").cast("long"), "by": F.xxhash64("row.text")})
    found = found.join(kept, F.col("of").eqNullSafe(F.col("id")) & (F.col("by") == F.col("copy"))).dropDuplicates(["id", "copy"])
    return found.select("row.*").unionByName(whole.where(~wordy).select("row.*"))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row for each row of ``documents`` (doc_id, text)."""
    return grouped(documents).select("doc_id", "n_shingles", "component_id")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op10_ngram_join": op10_ngram_join}

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLES = {
    "op10_ngram_join": f"""
        WITH split AS (
          SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{CAPITALS.lower()}'), '{WORD}') AS w
          FROM documents
        ),
        sets AS (
          SELECT id, CASE WHEN len(w) >= {WIDTH}
            THEN list_distinct(list_transform(range(1, len(w) - {WIDTH - 2}), lambda k: array_to_string(w[k:k + {WIDTH - 1}], ' ')))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS shingles
          FROM split
        ),
        listed AS (SELECT id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
        linked AS (
          SELECT a.id AS a, b.id AS b FROM listed a JOIN listed b ON a.shingle = b.shingle AND a.id <> b.id
          GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))
        )
        SELECT s.id AS doc_id, len(shingles) AS n_shingles, c.component_id
        FROM sets s JOIN ({components_sql("sets", "linked")}) c ON c.id = s.id
    """
}
