"""Features, fitted models and their invariants. Fitted values depend on the
partitioning, so these queries return facts that hold for every good fit."""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.feeds import EMISSION_ZERO_SQL, FCD_ZERO_SQL, blanked_emission, blanked_fcd
from catalog.tables import (
    EMISSION_SQL,
    FCD_SQL,
    bag_difference,
    emission_records,
    fcd_records,
    nearest_sql,
    table,
    tasks,
)
from roadpulse import config
from roadpulse.config import EMISSION_FEED, FCD_FEED, TYPED_EMISSION_FEED, Feed
from roadpulse.functions.distance import nearest_centre, squared_distance
from roadpulse.operators import learning
from roadpulse.operators.partitioning import tasks_for
from roadpulse.operators.records import as_envelopes
from roadpulse.plans.training import train, train_clusters, train_regressor, with_part
from roadpulse.streaming.scoring import scored_messages
from roadpulse.workspace import fresh_dir

ITEM_CENTRES = [(5.0, 10.0), (15.0, 40.0), (25.0, 25.0), (35.0, 45.0), (45.0, 12.0)]


def assemble_fcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position vector, element by element."""
    vectors = learning.assemble(fcd_records(spark, sf_dir, "event_id"), FCD_FEED)
    return vectors.select("event_id", *learning.elements(FCD_FEED.vector, ["f0", "f1"]))


def assemble_emission(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = learning.assemble(emission_records(spark, sf_dir), EMISSION_FEED)
    return vectors.select(*learning.elements(EMISSION_FEED.vector, ["f0", "f1", "f2"]))


def nearest_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's closest of five given centres."""
    placed = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_totalprice") / 10000).alias("x"), (F.col("o_custkey") % 50).cast("double").alias("y")
    )
    return placed.withColumn("cluster", nearest_centre([F.col("x"), F.col("y")], ITEM_CENTRES))


def kmeans_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k centres, and no row has a centre closer than the one it was given."""
    records = fcd_records(spark, sf_dir)
    model = learning.fit(learning.cluster_pipeline(), records, FCD_FEED, tasks(records))
    centres = learning.centres(model)
    features = [F.col(name) for name in FCD_FEED.features]
    distances = F.array(*[squared_distance(features, centre) for centre in centres])
    scored = learning.score(model, records)
    given = F.get(distances, F.col(FCD_FEED.prediction))
    return scored.agg(
        F.lit(len(centres)).alias("centres"),
        F.count(F.lit(1)).alias("scored"),
        F.count_if(given > F.array_min(distances) * (1 + 1e-6) + 1e-6).alias("misplaced"),
    )


def forest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions stay within the labels' range and beat the mean as a guess."""
    records = emission_records(spark, sf_dir)
    model = learning.fit(learning.regression_pipeline(), records, EMISSION_FEED, tasks(records))
    scored = learning.score(model, records, EMISSION_FEED.scored.names)
    label, guess = F.col(EMISSION_FEED.label), F.col(EMISSION_FEED.prediction)
    return scored.agg(
        F.lit(model.stages[-1].getNumTrees).alias("trees"),
        F.count(F.lit(1)).alias("scored"),
        ((F.min(guess) >= F.min(label)) & (F.max(guess) <= F.max(label))).alias("within_range"),
        (F.avg((guess - label) * (guess - label)) < F.var_pop(label) / 4).alias("beats_mean"),
    )


def scores_apart(model: PipelineModel, other: PipelineModel, records: DataFrame, feed: Feed) -> DataFrame:
    """``bag_difference`` of what two models make of the same records, in one pass. A record that both score alike adds
    the same row to both sides, so it is only counted; rows of the others are shuffled and compared."""
    first = learning.score(model, records).withColumnRenamed(feed.prediction, "_first").drop(feed.vector)
    both = learning.score(other, first)
    known = [name for name in feed.scored.names if name != feed.prediction]
    side = lambda sign, guess: F.struct(F.lit(sign).alias("side"), F.struct(*known, F.col(guess).alias("_guess")).alias("row"))
    left, right = side(1, "_first"), side(-1, feed.prediction)
    alike = F.struct(F.lit(0).alias("side"), F.when(F.lit(False), left["row"]).alias("row"))
    sides = F.when(F.col("_first").eqNullSafe(F.col(feed.prediction)), F.array(alike)).otherwise(F.array(left, right))
    per_row = both.select(F.explode(sides).alias("x")).groupBy("x.row").agg(
        F.sum("x.side").alias("_surplus"), F.count_if(F.col("x.side") >= 0).alias("_left")
    )
    return per_row.agg(
        F.coalesce(F.sum("_left"), F.lit(0)).alias("compared"),
        F.count_if(F.col("_surplus") != 0).alias("differences"),
    )


def model_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored and loaded models score exactly like the fitted ones."""
    positions, emissions = fcd_records(spark, sf_dir), emission_records(spark, sf_dir)
    fitted = {
        FCD_FEED: (learning.fit(learning.cluster_pipeline(), positions, FCD_FEED, tasks(positions)), positions),
        EMISSION_FEED: (
            learning.fit(learning.regression_pipeline(), emissions, EMISSION_FEED, tasks(emissions)),
            emissions,
        ),
    }
    outcomes = []
    for feed, (model, records) in fitted.items():
        path = fresh_dir(spark, f"model-{feed.name}")
        learning.save(model, path)
        learning.save(model, path)  # storing again replaces the first copy
        again = learning.load(path)
        uneven = scores_apart(model, again, records, feed)
        outcomes.append(uneven.select(F.lit(feed.name).alias("feed"), "compared", "differences"))
    return outcomes[0].unionByName(outcomes[1])


def training_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole training job on recorded feeds: text files in, stored models out."""
    clusters, regressor = fresh_dir(spark, "cmodel"), fresh_dir(spark, "rmodel")
    sources = blanked_fcd(spark, sf_dir), blanked_emission(spark, sf_dir)
    metrics = train(spark, *sources, clusters, regressor, tasks=tasks(emission_records(spark, sf_dir)))
    stored = [len(learning.centres(learning.load(clusters))), learning.load(regressor).stages[-1].getNumTrees]
    facts = [
        ("centres_stored", stored[0] == config.CLUSTERS),
        ("trees_stored", stored[1] == config.TREE_COUNT),
        ("rmse_is_root_of_mse", abs(metrics["rmse"] ** 2 - metrics["mse"]) < 1e-9),
        ("mae_at_most_rmse", 0 < metrics["mae"] <= metrics["rmse"]),
        ("silhouette_positive", 0 < metrics["silhouette"] <= 1),
    ]
    rows = [metrics[f"{feed}_{part}_rows"] for feed in ("fcd", "emission") for part in ("train", "test")]
    counts = spark.createDataFrame([tuple(rows)], "fcd_train LONG, fcd_test LONG, emission_train LONG, emission_test LONG")
    return counts.select("*", *[F.lit(bool(value)).alias(name) for name, value in facts])


def held_out_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows of each feed each part has after training on one of them."""
    tables = {FCD_FEED: fcd_records(spark, sf_dir), EMISSION_FEED: emission_records(spark, sf_dir)}
    merged = None
    for (feed, records), fit in zip(tables.items(), (train_clusters, train_regressor)):
        trained = fit(with_part(records, feed), feed, tasks(records))
        for name, part in (("train", trained.train), ("test", trained.test)):
            counted = part.agg(F.lit(feed.name).alias("feed"), F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"))
            merged = counted if merged is None else merged.unionByName(counted)
    return merged


TYPED_FCD = replace(FCD_FEED, features=("vehicle_speed",), vector="typed_features", categories=("vehicle_type",))
#: The kind of event that the dictionary doesn't know.
UNSEEN = "error"


def type_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number and the kind of event as one vector; the dictionary is fitted without one of the kinds."""
    records = fcd_records(spark, sf_dir, "event_id")
    vectors = learning.type_vectors(records.where(F.col("vehicle_type") != UNSEEN), records, TYPED_FCD)
    return vectors.select("event_id", F.posexplode(vector_to_array("typed_features")).alias("place", "value"))


def typed_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored forest with the kind of vehicle as a feature scores a stream that has a kind it has never met."""
    feed = TYPED_EMISSION_FEED
    records = emission_records(spark, sf_dir)
    odd = F.when(F.col("vehicle_speed") > 10, F.lit("tram")).otherwise(F.col("vehicle_type"))
    path = fresh_dir(spark, "typed-model")
    learning.save(learning.fit(learning.regression_pipeline(feed, depth=3, trees=3), records, feed, tasks(records)), path)
    model, seen = learning.load(path), records.withColumn("vehicle_type", odd)
    topic = fresh_dir(spark, "topic")
    as_envelopes(seen, feed, F.lit("2024-01-01").cast("timestamp")).write.parquet(topic)
    streamed = scored_messages(spark.read.parquet(topic), feed, model, event_time=False)
    direct = learning.score(model, seen, list(feed.scored.names))
    counts = bag_difference(streamed, direct)
    known = len(learning.dictionaries(model, feed)["vehicle_type"])
    trams = seen.where("vehicle_type = 'tram'").agg(F.count(F.lit(1))).scalar()
    return counts.select("compared", "differences", F.lit(known).alias("known"), trams.alias("unseen"))


def same_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both models fitted from 3 and from 16 input partitions, of a larger table from as many times more, dealt by their
    own values: centres and predictions are the same. The fits add up in the order that tasks end in, hence the rounding."""
    fcd, emission = fcd_records(spark, sf_dir), emission_records(spark, sf_dir)
    found = []
    more, times = (-(-tasks_for(records, 3) // 3) for records in (fcd, emission))
    for n in (3, 16):
        clusters = learning.fit(learning.cluster_pipeline(), fcd.repartition(n * more), FCD_FEED, parts=8 * more)
        forest = learning.fit(
            learning.regression_pipeline(depth=4, trees=4), emission.repartition(n * times), EMISSION_FEED, parts=8 * times
        )
        rounded = [tuple(round(v, 6) for v in c) for c in learning.centres(clusters)]
        trees = [re.sub(r"-?\d+\.\d+(E-?\d+)?", lambda m: f"{float(m[0]):.6g}", t.toDebugString) for t in forest.stages[-1].trees]
        # The first line of a tree names the run it was made in.
        found.append((rounded, [t.split("\n", 1)[1] for t in trees]))
    same = [found[0][0] == found[1][0], found[0][1] == found[1][1]]
    kinds = spark.createDataFrame([("centres", len(found[0][0]), same[0]), ("trees", len(found[0][1]), same[1])], "kind STRING, n INT, same BOOLEAN")
    return kinds


QUERIES = {
    "assemble_fcd": assemble_fcd,
    "assemble_emission": assemble_emission,
    "nearest_centres": nearest_centres,
    "kmeans_check": kmeans_check,
    "forest_check": forest_check,
    "model_round_trip": model_round_trip,
    "training_report": training_report,
    "held_out_parts": held_out_parts,
    "type_vectors": type_vectors,
    "typed_scoring": typed_scoring,
    "same_model": same_model,
}

# The split as SQL: the record's time and vehicle behind the seed, as Spark writes numbers below ten million.
_PART = """
    CASE WHEN substr(md5('42:' || CAST(timestep_time AS VARCHAR) || ':' || CAST(vehicle_id AS VARCHAR)), 1, 8)
      < 'b3333333' THEN 'train' ELSE 'test' END
"""
_ITEMS = "SELECT o_orderkey, o_totalprice / 10000 AS x, CAST(o_custkey % 50 AS DOUBLE) AS y FROM orders"

ORACLES = {
    "assemble_fcd": f"SELECT event_id, vehicle_x AS f0, vehicle_y AS f1 FROM ({FCD_SQL})",
    "assemble_emission": f"""
        SELECT vehicle_fuel AS f0, vehicle_speed AS f1, vehicle_noise AS f2 FROM ({EMISSION_SQL})
    """,
    "nearest_centres": f"""
        SELECT o_orderkey, x, y, CAST(cluster AS INTEGER) AS cluster
        FROM ({nearest_sql(_ITEMS, "x", "y", "o_orderkey", ITEM_CENTRES)})
    """,
    "kmeans_check": "SELECT 5 AS centres, count(*) AS scored, CAST(0 AS BIGINT) AS misplaced FROM events",
    "forest_check": """
        SELECT 20 AS trees, count(*) AS scored, TRUE AS within_range, TRUE AS beats_mean FROM lineitem
    """,
    "model_round_trip": """
        SELECT 'fcd' AS feed, count(*) AS compared, CAST(0 AS BIGINT) AS differences FROM events
        UNION ALL
        SELECT 'emission', count(*), CAST(0 AS BIGINT) FROM lineitem
    """,
    "training_report": f"""
        WITH f AS (SELECT {_PART} AS part FROM ({FCD_ZERO_SQL})), e AS (SELECT {_PART} AS part FROM ({EMISSION_ZERO_SQL}))
        SELECT (SELECT count(*) FROM f WHERE part = 'train') AS fcd_train, (SELECT count(*) FROM f WHERE part = 'test') AS fcd_test,
          (SELECT count(*) FROM e WHERE part = 'train') AS emission_train,
          (SELECT count(*) FROM e WHERE part = 'test') AS emission_test,
          TRUE AS centres_stored, TRUE AS trees_stored, TRUE AS rmse_is_root_of_mse,
          TRUE AS mae_at_most_rmse, TRUE AS silhouette_positive
    """,
    "held_out_parts": f"""
        SELECT 'fcd' AS feed, {_PART} AS part, count(*) AS n FROM ({FCD_SQL}) GROUP BY ALL
        UNION ALL
        SELECT 'emission', {_PART}, count(*) FROM ({EMISSION_SQL}) GROUP BY ALL
    """,
    "type_vectors": f"""
        WITH known AS (
          SELECT event_type, row_number() OVER (ORDER BY event_type) AS slot
          FROM (SELECT DISTINCT event_type FROM events WHERE event_type <> '{UNSEEN}')
        ),
        slots AS (SELECT unnest(range(1, (SELECT count(*) + 2 FROM known))) AS place),
        placed AS (
          SELECT r.event_id, coalesce(k.slot, (SELECT count(*) + 1 FROM known)) AS slot
          FROM ({FCD_SQL}) r LEFT JOIN known k ON k.event_type = r.vehicle_type
        )
        SELECT event_id, CAST(0 AS INTEGER) AS place, vehicle_speed AS value FROM ({FCD_SQL})
        UNION ALL
        SELECT event_id, CAST(place AS INTEGER), CAST(CAST(place = slot AS INTEGER) AS DOUBLE) FROM placed CROSS JOIN slots
    """,
    "typed_scoring": f"""
        SELECT count(*) AS compared, CAST(0 AS BIGINT) AS differences, 2 AS known,
          count(*) FILTER (vehicle_speed > 10) AS unseen FROM ({EMISSION_SQL})
    """,
    "same_model": "SELECT * FROM (VALUES ('centres', 5, TRUE), ('trees', 4, TRUE)) AS kinds(kind, n, same)",
}
