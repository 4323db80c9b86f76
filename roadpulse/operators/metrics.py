"""How good predictions are."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from roadpulse.functions.distance import EXPRESSION_TERMS

# Cluster sums travel to every task; more clusters than that are refused.
BROADCAST_BYTES = 64 << 20
# Distances below this share of what they are the difference of are 0.
ROUNDING = 1e-13
FEW_CLUSTERS = "a silhouette needs at least two clusters"


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Mean squared, root mean squared and mean absolute error in one pass."""
    error = F.col(prediction) - F.col(label)
    mse = F.avg(error * error)
    return df.agg(mse.alias("mse"), F.sqrt(mse).alias("rmse"), F.avg(F.abs(error)).alias("mae"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Each value once, in value order."""
    return df.select(column).distinct().orderBy(column)


def silhouette(df: DataFrame, features: str | Sequence[str], cluster: str) -> DataFrame:
    """Mean silhouette (squared Euclidean) of a clustering, as one row.

    ``features`` names one vector or array column, or several numeric columns.
    The work is linear in the rows: one pass sums up each cluster, a second
    compares every row with those sums. A handful of clusters becomes an
    expression in generated code; of more, the size of the sums is checked and
    one array of them goes to every task. Beyond
    ``BROADCAST_BYTES`` the clustering is refused. The contract is the same
    either way: a row without a cluster or with a missing or NaN feature fails
    the job, a row alone in its cluster scores 0, and so does a row as near to
    another cluster as to its own.
    """
    if not isinstance(features, str):
        most = EXPRESSION_TERMS // len(features)
        known = _sums(df, features, cluster).limit(most + 1).collect()  # at most EXPRESSION_TERMS rows
        if len(known) <= most:
            return _silhouette_by_expression(df, features, cluster, known)
    return _silhouette_by_array(df, features, cluster)


def _refused(bad: Column, value: Column) -> Column:
    refusal = F.raise_error(F.lit("a row without features or cluster cannot be scored"))
    return F.when(bad, refusal.cast("double")).otherwise(value)


def _score(own: Column, other: Column, n: Column) -> Column:
    """One row's score from its mean distance to all of its cluster, itself included."""
    to_own = own * n / F.nullif(n - 1, F.lit(0))
    farther = F.greatest(to_own, other)
    return F.when((n == 1) | (farther <= 0), F.lit(0.0)).otherwise((other - to_own) / F.nullif(farther, F.lit(0.0)))


def _distance(norm: Column, squares: Column, dot: Column) -> Column:
    """Mean squared distance to a cluster, from sums; what rounding leaves of 0 is 0."""
    reach = norm + squares
    return F.when(reach - 2 * dot <= ROUNDING * reach, F.lit(0.0)).otherwise(reach - 2 * dot)


def _sums(df: DataFrame, features: Sequence[str], cluster: str) -> DataFrame:
    point, label = [F.col(name).cast("double") for name in features], F.col(cluster)
    norm = reduce(lambda left, right: left + right, [value * value for value in point])
    sums = [F.sum(value).alias(f"s{i}") for i, value in enumerate(point)]
    return df.groupBy(label.alias("c")).agg(F.count(F.lit(1)).alias("n"), F.sum(norm).alias("q"), *sums)


def _silhouette_by_expression(df: DataFrame, features: Sequence[str], cluster: str, known: list) -> DataFrame:
    point, label = [F.col(name).cast("double") for name in features], F.col(cluster)
    norm = reduce(lambda left, right: left + right, [value * value for value in point])
    unusable = [value.isNull() | F.isnan(value) for value in (*point, label.cast("double"))]
    bad = reduce(lambda left, right: left | right, unusable)
    rows = [row for row in known if row["c"] is not None]
    if len(known) < 2 or not rows:
        raise ValueError(FEW_CLUSTERS)

    # In steps, each of which names what it has computed: generated code then does so once and stays small.
    dots = [reduce(lambda left, right: left + right, [v * ((r[f"s{i}"] or 0) / r["n"]) for i, v in enumerate(point)]) for r in rows]
    steps = df.select(label.alias("c"), bad.alias("bad"), norm.alias("norm"), *[dot.alias(f"dot{k}") for k, dot in enumerate(dots)])
    far = [_distance(F.col("norm"), F.lit((r["q"] or 0) / r["n"]), F.col(f"dot{k}")) for k, r in enumerate(rows)]
    steps = steps.select("c", "bad", *[d.alias(f"far{k}") for k, d in enumerate(far)])
    own, size = F.lit(None).cast("double"), F.lit(None).cast("bigint")
    others = []
    for k, row in enumerate(rows):
        mine = F.col("c") == row["c"]
        own = F.when(mine, F.col(f"far{k}")).otherwise(own)
        size = F.when(mine, F.lit(row["n"])).otherwise(size)
        others.append(F.when(~mine, F.col(f"far{k}")))
    nearest = F.least(*others) if len(others) > 1 else others[0]
    steps = steps.select("bad", own.alias("own"), nearest.alias("other"), size.alias("n"))
    return steps.agg(F.avg(_refused(F.col("bad"), _score(F.col("own"), F.col("other"), F.col("n")))).alias("silhouette"))


def _array(df: DataFrame, features: str | Sequence[str]) -> Column:
    if not isinstance(features, str):
        return F.array(*[F.col(name).cast("double") for name in features])
    if df.schema[features].dataType.typeName() == "array":
        return F.col(features).cast("array<double>")
    return vector_to_array(F.col(features))


def _dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, term: total + term)


def _silhouette_by_array(df: DataFrame, features: str | Sequence[str], cluster: str) -> DataFrame:
    label = F.col(cluster).cast("double")
    points = df.select(_array(df, features).alias("point"), label.alias("c"))
    missing = F.exists("point", lambda value: value.isNull() | F.isnan(value))
    bad = F.col("point").isNull() | missing | F.col("c").isNull() | F.isnan("c")
    points = points.withColumn("c", _refused(bad, F.col("c")))
    points = points.withColumn("norm", _dot(F.col("point"), F.col("point")))
    first = points.select("point").first()
    if first is None:
        raise ValueError(FEW_CLUSTERS)
    width = len(first["point"])
    totals = F.array(*[F.sum(F.col("point")[i]) for i in range(width)])
    sums = points.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.sum("norm").alias("q"), totals.alias("s"))
    most = BROADCAST_BYTES // ((width + 3) * 8)
    known = sums.limit(most + 1).toArrow()  # BROADCAST_BYTES at most, and a row
    if known.num_rows < 2:
        raise ValueError(FEW_CLUSTERS)
    if known.num_rows > most:
        raise ValueError(f"more than {most} clusters are too many for a silhouette")
    members = df.sparkSession.createDataFrame(known).agg(F.collect_list(F.struct("c", "n", "q", "s"))).scalar()

    def distance(member: Column) -> Column:
        return _distance(F.col("norm"), member["q"] / member["n"], _dot(F.col("point"), member["s"]) / member["n"])

    met = points.withColumn("members", members)
    mine = F.filter("members", lambda m: m["c"] == F.col("c"))
    others = F.filter("members", lambda m: m["c"] != F.col("c"))
    met = met.select(mine[0].alias("own"), F.array_min(F.transform(others, distance)).alias("other"), "point", "norm")
    score = _score(distance(F.col("own")), F.col("other"), F.col("own")["n"])
    return met.agg(F.avg(score).alias("silhouette"))
