"""Caps, splits, distinct values and evaluation metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.files import scored_positions
from catalog.tables import FCD_SQL, POSITION_CENTRES, fcd_records, nearest_sql, table
from roadpulse import config
from roadpulse.operators.metrics import distinct_values, regression_metrics, silhouette
from roadpulse.operators.sampling import preview, random_split, split, take

SHARES = [config.TRAIN_SHARE, 1 - config.TRAIN_SHARE]


def capped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return take(table(spark, sf_dir, "events"), config.ROW_CAP, ["event_id"])


def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(table(spark, sf_dir, "events"), ["event_id"])


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which part every event belongs to."""
    train, test = split(table(spark, sf_dir, "events").select("event_id"), SHARES, ["event_id"])
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def random_split_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark's own split: the parts are disjoint and complete, and sized about 70/30."""
    events = table(spark, sf_dir, "events")
    train, test = random_split(events, SHARES, ["event_id", "value"])
    marked = train.withColumn("t", F.lit(1)).unionByName(test.withColumn("t", F.lit(0)))
    per_event = marked.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("t"))
    return per_event.agg(
        F.count(F.lit(1)).alias("covered"),
        F.count_if(F.col("n") > 1).alias("in_both"),
        (F.abs(F.avg("t") - config.TRAIN_SHARE) < 0.1).alias("share_fits"),
    )


def regression_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    guessed = table(spark, sf_dir, "lineitem").select(
        "l_extendedprice", (F.col("l_quantity") * 1500).alias("prediction")
    )
    metrics = regression_metrics(guessed, "l_extendedprice", "prediction")
    return metrics.select(F.round("mse", 1).alias("mse"), F.round("rmse", 5).alias("rmse"), F.round("mae", 5).alias("mae"))


def silhouette_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-element vectors, clustered by their label."""
    result = silhouette(table(spark, sf_dir, "embeddings"), "embedding", "label")
    return result.select(F.round("silhouette", 6).alias("silhouette"))


def silhouette_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle positions, clustered by the nearest of the given centres."""
    scored = scored_positions(fcd_records(spark, sf_dir))
    result = silhouette(scored, ["vehicle_x", "vehicle_y"], "congestion_cluster")
    return result.select(F.round("silhouette", 6).alias("silhouette"))


def silhouette_coincident(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every position in two clusters at once, beside a third: coincident rows score 0, by the expression
    and from arrays."""
    scored = scored_positions(fcd_records(spark, sf_dir))
    near = scored.where("congestion_cluster = 0").select(F.lit(1.0).alias("x"), F.lit(2.0).alias("y"))
    far = scored.where("congestion_cluster <> 0").select(F.lit(9.0).alias("x"), F.lit(2.0).alias("y"))
    rows = near.withColumn("c", F.lit(0)).unionByName(near.withColumn("c", F.lit(1)))
    rows = rows.unionByName(far.withColumn("c", F.lit(2)))
    ways = {"expression": silhouette(rows, ["x", "y"], "c"), "vectors": silhouette(rows.select(F.array("x", "y").alias("f"), "c"), "f", "c")}
    found = [way.select(F.lit(name).alias("way"), F.round("silhouette", 6).alias("silhouette")) for name, way in ways.items()]
    return found[0].unionByName(found[1])


def distinct_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(table(spark, sf_dir, "embeddings"), "label")


QUERIES = {
    "capped_rows": capped_rows,
    "preview_rows": preview_rows,
    "hash_split": hash_split,
    "random_split_check": random_split_check,
    "regression_errors": regression_errors,
    "silhouette_vectors": silhouette_vectors,
    "silhouette_positions": silhouette_positions,
    "silhouette_coincident": silhouette_coincident,
    "distinct_clusters": distinct_clusters,
}

# Per cluster: rows, sum per dimension, sum of squares; then one pass over the points.
_SILHOUETTE = """
WITH cells AS ({cells}),
norms AS (SELECT id, c, sum(v * v) AS norm FROM cells GROUP BY id, c),
sizes AS (SELECT c, count(*) AS n, sum(norm) AS q FROM norms GROUP BY c),
sums AS (SELECT c, dim, sum(v) AS s FROM cells GROUP BY c, dim),
dots AS (
  SELECT p.id, s.c AS other, sum(p.v * s.s) AS dot
  FROM cells AS p JOIN sums AS s ON p.dim = s.dim GROUP BY p.id, s.c
),
distances AS (
  SELECT p.id, p.c, z.c AS other, z.n, p.norm + z.q / z.n - 2 * d.dot / z.n AS d
  FROM norms AS p JOIN dots AS d ON p.id = d.id JOIN sizes AS z ON z.c = d.other
),
scores AS (
  SELECT id,
    max(CASE WHEN c = other THEN n END) AS n,
    max(CASE WHEN c = other THEN d * n / NULLIF(n - 1, 0) END) AS a,
    min(CASE WHEN c <> other THEN d END) AS b
  FROM distances GROUP BY id
)
SELECT round(avg(CASE WHEN n = 1 OR greatest(a, b) <= 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
FROM scores
"""
_POSITIONS = nearest_sql(FCD_SQL, "vehicle_x", "vehicle_y", "event_id", POSITION_CENTRES)
_POSITION_SILHOUETTE = _SILHOUETTE.format(
    cells=f"""
      WITH placed AS ({_POSITIONS})
      SELECT event_id AS id, cluster AS c, 1 AS dim, vehicle_x AS v FROM placed
      UNION ALL
      SELECT event_id, cluster, 2, vehicle_y FROM placed
    """
)

ORACLES = {
    "capped_rows": "SELECT * FROM events ORDER BY event_id LIMIT 1000",
    "preview_rows": "SELECT * FROM events ORDER BY event_id LIMIT 10",
    "hash_split": """
        SELECT event_id,
          CASE WHEN substr(md5('42:' || CAST(event_id AS VARCHAR)), 1, 8) < 'b3333333' THEN 'train' ELSE 'test' END
            AS part
        FROM events
    """,
    "random_split_check": "SELECT count(*) AS covered, CAST(0 AS BIGINT) AS in_both, TRUE AS share_fits FROM events",
    "regression_errors": """
        SELECT round(avg(power(l_quantity * 1500 - l_extendedprice, 2)), 1) AS mse,
          round(sqrt(avg(power(l_quantity * 1500 - l_extendedprice, 2))), 5) AS rmse,
          round(avg(abs(l_quantity * 1500 - l_extendedprice)), 5) AS mae
        FROM lineitem
    """,
    "silhouette_vectors": _SILHOUETTE.format(
        cells="""
          SELECT vec_id AS id, label AS c, unnest(range(len(embedding))) AS dim,
            CAST(unnest(embedding) AS DOUBLE) AS v
          FROM embeddings
        """
    ),
    "silhouette_positions": _POSITION_SILHOUETTE,
    "silhouette_coincident": f"""
        WITH sizes AS (
          SELECT count(*) FILTER (cluster = 0) AS near, count(*) FILTER (cluster <> 0) AS far FROM ({_POSITIONS})
        )
        SELECT way, round(far / (2 * near + far), 6) AS silhouette
        FROM sizes CROSS JOIN (VALUES ('expression'), ('vectors')) AS w(way)
    """,
    "distinct_clusters": "SELECT DISTINCT label FROM embeddings",
}
