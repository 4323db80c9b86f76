"""Mixing sources to target weights by weighted fair queueing.

Documents of each source are shuffled by a hash and queue up one after another, three rounds of the source at most. A
copy's virtual finish time is the number of its source's words up to its end divided by the source's target. All copies
in order of finish time, cut where their words reach the budget, are the mix: at any time every source has been served
in proportion to its target, and the cut falls near time 1, where each has just reached it.

Prefix sums never gather a source or the whole table: sums by slice of the hash first, then sums inside each slice; the
same for slices of the finish time. A slice holds about ``SLICE`` rows at any table size. The order is a hash of id and
text, so reruns agree. Rows that are equal in both are counted first, queue up as one and are numbered behind that, so
that however many they are, they meet in no task and the cut may fall between them.

Defined results: null text has size 0; null sources form a source of their own, the last; rows of size 0 take no words
and, like any row, are in the mix once for each round that gets as far; a source without words has target 0 and none of
its rows is in the mix. An empty table gives an empty mix. Other columns are carried through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from roadpulse.llm.common import WORD, landed, table

#: Weights of sources in order of code points, repeating.
WEIGHTS = (5, 2, 1)
#: Times its source's size a target may reach, and rounds of a source at most.
MOST = 3
SLICE = 4_000
#: Sources up to which the places of their last copies are sent to all workers; beyond, they are joined.
SENT = 100_000


def order_of(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A place in the shuffled order: hex digits, compared as text."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (doc_id, text)]
    return F.substring(F.md5(F.concat_ws(":", *cells)), 1, 16)


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """A row per source: rank, source, docs, source_size, target. Targets share all words by weight; what a capped
    target can't take goes to the others by weight. One row per source meets in one task."""
    by = sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    by = by.withColumn("rank", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("double")
    by = by.withColumn("weight", weight).withColumn("cap", most * F.col("source_size").cast("double"))
    # With the sources in order of cap / weight, those up to some place are at their caps and the rest share evenly.
    lowest = everything.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = lowest.rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    shares = F.sum("weight").over(lowest.rowsBetween(0, Window.unboundedFollowing))
    by = by.withColumn("level", (F.sum("source_size").over(everything) - taken) / shares)
    # It rises as long as the next source is at its cap as well, and falls from then on.
    by = by.withColumn("level", F.max("level").over(everything))
    target = F.least("cap", F.col("level") * F.col("weight"))
    return by.select("rank", "source", "docs", "source_size", target.alias("target"))


def _finish(round_: Column | int) -> Column:
    r = F.lit(round_) if isinstance(round_, int) else round_
    return ((r - 1) * F.col("source_size") + F.col("upto")) / F.col("target")


@dataclass
class Mix:
    """``rows``: rank, doc_id, size, source_size, target, draw, number (among equal rows, from 1), upto (words of the source
    up to this row) and copies; ``sources``: source, target and the place of the last copy, round, draw and number;
    ``cut``: the last finish time."""

    rows: DataFrame
    sources: DataFrame
    cut: float | None


def plan(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> Mix:
    """The mix of ``documents`` (doc_id, text, source)."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = documents.select("doc_id", "source", words.alias("size"), order_of().alias("draw"))
    sized = landed(sized.groupBy("doc_id", "source", "size", "draw").agg(F.count(F.lit(1)).alias("rows")), "sized")
    sources = landed(targets(sized, weights, most), "targets")
    ranked = sized.join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    slices = F.ceil(F.col("docs") / SLICE)
    share = F.conv(F.substring("draw", 1, 8), 16, 10).cast("double") / 2.0**32
    ranked = ranked.select(
        "rank", "doc_id", "size", "rows", "source_size", "target", "draw", F.least(F.floor(share * slices), slices - 1).alias("slice")
    ).withColumn("words", F.col("size") * F.col("rows"))
    sums = ranked.groupBy("rank", "slice").agg(F.sum("words").alias("sum"))
    earlier = Window.partitionBy("rank").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("rank", "slice", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("start"))
    # Different rows of one hash, if there are any, follow each other by id and size.
    inside = Window.partitionBy("rank", "slice").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    begun = ranked.withColumn("inside", F.coalesce(F.sum("words").over(inside), F.lit(0))).join(sums, ["rank", "slice"])
    begun = begun.withColumn("begin", F.col("start") + F.col("inside")).drop("slice", "inside", "start", "words")
    rows = landed(_numbered(landed(begun, "groups")), "queues")

    cut = _cut(rows, most)
    copies = F.lit(0)
    for r in range(1, most + 1):
        copies = copies + F.coalesce((_finish(r) <= F.lit(cut)).cast("int"), F.lit(0))
    rows = rows.withColumn("copies", F.when(F.col("target") > 0, copies).otherwise(0))
    place = F.struct(F.col("copies").alias("round"), "draw", "number")
    last = rows.where("copies > 0").groupBy("rank").agg(F.max(place).alias("last"))
    return Mix(rows, sources.join(last, "rank", "left").select("source", "target", "last"), cut)


def _numbered(groups: DataFrame) -> DataFrame:
    """A row for each row that was counted. Large counts are dealt out in chunks over all tasks before."""
    one = groups.where("rows = 1").withColumn("number", F.lit(1).cast("long"))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / SLICE)))
    many = groups.where("rows > 1").withColumn("chunk", chunk)
    tasks = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = many.repartition(tasks, "draw", "chunk")
    first, last = F.col("chunk") * SLICE + 1, F.least((F.col("chunk") + 1) * SLICE, F.col("rows"))
    many = many.withColumn("number", F.explode(F.sequence(first, last))).drop("chunk")
    rows = one.unionByName(many)
    return rows.withColumn("upto", F.col("begin") + F.col("number") * F.col("size")).drop("begin", "rows")


def _cut(rows: DataFrame, most: int) -> float | None:
    """The finish time of the last copy within the budget."""
    total = rows.agg(F.count("*").alias("n"), F.sum("size").alias("words")).first()
    if not total["words"]:
        return None
    rounds = F.explode(F.array(*map(F.lit, range(1, most + 1))))
    copies = rows.where("target > 0").withColumn("round", rounds).select("size", _finish(F.col("round")).alias("finish"))
    slices = -(-total["n"] // SLICE)
    copies = copies.withColumn("slice", F.floor(F.col("finish") * slices))
    bins = copies.groupBy("slice").agg(F.sum("size").alias("words"), F.max("finish").alias("finish"))
    running = Window.partitionBy(F.lit(0)).orderBy("slice")
    bins = bins.withColumn("upto", F.sum("words").over(running))
    full = bins.where(F.col("upto") <= total["words"]).agg(F.max("slice").alias("slice"), F.max("upto").alias("upto"), F.max("finish").alias("finish")).first()
    ahead = bins.where(F.col("upto") > total["words"]).agg(F.min("slice")).first()[0]
    if ahead is None:
        return full["finish"]
    inside = Window.partitionBy("slice").orderBy("finish").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    part = copies.where(F.col("slice") == ahead).withColumn("upto", F.sum("size").over(inside) + (full["upto"] or 0))
    cut = part.where(F.col("upto") <= total["words"]).agg(F.max("finish")).first()[0]
    return cut if cut is not None else full["finish"]


def mixed(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``documents`` as the mix has them: a row for each copy. Each source's last place says what is in, so texts
    stay where they are; only rows equal to the last one of their source are written, to be numbered."""
    cuts = landed(plan(documents, weights, most).sources.where("last is not null").select("source", "last"), "cuts")
    cuts = F.broadcast(cuts) if cuts.count() <= SENT else cuts
    # The caller's row is one column here, whatever its columns are called.
    found = documents.select(F.struct("*").alias("row")).join(cuts, F.col("row.source").eqNullSafe(F.col("source")))
    found = found.select("row", "source", "last", order_of("row.doc_id", "row.text").alias("draw"))
    copies = F.col("last.round") - (F.col("draw") > F.col("last.draw")).cast("int")
    plain = found.where(F.col("draw") != F.col("last.draw")).select("row", copies.alias("copies"))
    border = found.where(F.col("draw") == F.col("last.draw")).withColumn("turn", F.monotonically_increasing_id())
    border = _places(landed(border, "border"))
    beyond = (F.col("number") > F.col("last.number")).cast("int")
    rows = plain.unionByName(border.select("row", (F.col("last.round") - beyond).alias("copies")))
    return rows.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy")).select("row.*")


def _places(border: DataFrame) -> DataFrame:
    """Equal rows (source, turn) with their ``number`` from 1 on, counted by the task that read them first."""
    border = border.withColumn("task", F.shiftright("turn", 33))
    counts = border.groupBy("source", "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("source").alias("of"), F.col("task").alias("by"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("source", "task").orderBy("turn"))
    numbered = border.withColumn("inside", inside)
    numbered = numbered.join(counts, F.col("source").eqNullSafe(F.col("of")) & (F.col("task") == F.col("by")))
    return numbered.withColumn("number", F.col("before") + F.col("inside"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).rows
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


QUERIES = {"op1_mixing": op1_mixing}

_WEIGHT = "CASE (rank % 3) " + " ".join(f"WHEN {k} THEN {w}" for k, w in enumerate(WEIGHTS)) + " END::DOUBLE"
ORACLES = {
    "op1_mixing": f"""
        WITH sized AS (
          SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS size,
            substr(md5(concat(coalesce(doc_id::VARCHAR, ''), ':', coalesce(text, ''))), 1, 16) AS draw
          FROM documents
        ),
        sources AS (
          SELECT *, {_WEIGHT} AS weight, {MOST} * source_size::DOUBLE AS cap
          FROM (
            SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
            FROM sized GROUP BY source
          )
        ),
        levels AS (
          SELECT *, ((sum(source_size) OVER ())::DOUBLE
            - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
          FROM sources
        ),
        targets AS (SELECT source, source_size, least(cap, max(level) OVER () * weight) AS target FROM levels),
        queued AS (
          SELECT s.*, t.source_size, t.target, sum(size) OVER (PARTITION BY s.source ORDER BY draw ROWS UNBOUNDED PRECEDING) AS upto
          FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
        ),
        copies AS (
          SELECT size, ((r - 1) * source_size + upto)::DOUBLE / target AS finish
          FROM queued CROSS JOIN range(1, {MOST} + 1) AS rounds(r) WHERE target > 0
        ),
        served AS (SELECT finish, sum(size) OVER (ORDER BY finish) AS upto FROM copies),
        cut AS (SELECT max(finish) AS cut FROM served WHERE upto <= (SELECT sum(size) FROM sized))
        SELECT doc_id, size::BIGINT AS size, source_size, target, (size * copies)::BIGINT AS taken, copies FROM (
          SELECT *, CASE WHEN target > 0 THEN
            {" + ".join(f"((({r} * source_size + upto)::DOUBLE / target) <= cut)::INTEGER" for r in range(MOST))}
            ELSE 0 END AS copies
          FROM queued CROSS JOIN cut
        )
    """
}
