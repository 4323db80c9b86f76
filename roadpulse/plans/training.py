"""Train, evaluate and store both models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadpulse import config
from roadpulse.config import EMISSION_FEED, FCD_FEED, TYPED_EMISSION_FEED, Feed
from roadpulse.functions.hashing import row_token, token_bound
from roadpulse.operators import learning
from roadpulse.operators.metrics import regression_metrics, silhouette
from roadpulse.operators.records import normalise
from roadpulse.operators.sampling import take
from roadpulse.sources.delimited import read_cells
from roadpulse.workspace import discard, fresh_dir


TRAINING, HELD_OUT = "train", "test"


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    train: DataFrame
    test: DataFrame
    metrics: dict[str, float]


def with_part(records: DataFrame, feed: Feed) -> DataFrame:
    """The records with their part, drawn by the record's identity: the parts that ``split`` makes, as a column."""
    token = row_token(list(feed.identity), config.SPLIT_SEED)
    part = F.when(token < token_bound(config.TRAIN_SHARE), TRAINING).otherwise(HELD_OUT)
    return records.withColumn("part", part)


def land(spark: SparkSession, source: str | list[str], feed: Feed, missing: str = "zero", max_rows: int | None = None) -> str:
    """The feed's training columns as a Parquet table in the shared folder, in a folder for each part; its path.

    Text is parsed and the split drawn once here; the many passes of training and
    evaluation then read a few columns of their part only, and a lost executor
    costs a re-read.
    """
    cells = read_cells(spark, source)
    records = normalise(cells, feed.schema, fields=feed.training_columns, missing=missing)
    path = fresh_dir(spark, f"land-{feed.name}")
    with_part(take(records, max_rows, list(feed.identity)), feed).write.partitionBy("part").parquet(path)
    return path


def parts(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training and held-out rows of a table with the column ``part``."""
    return tuple(table.where(F.col("part") == name).drop("part") for name in (TRAINING, HELD_OUT))


def train_clusters(
    table: DataFrame, feed: Feed = FCD_FEED, tasks: int | None = None, parts_of_fit: int | None = None, **settings
) -> Trained:
    """K-means on the larger part; the held-out part gives the silhouette. ``table`` has the column ``part``."""
    train, test = parts(table)
    model = learning.fit(learning.cluster_pipeline(feed, **settings), train, feed, tasks, parts_of_fit)
    scored = learning.score_feed(model, test, feed, feed.scored.names)
    metrics = silhouette(scored, feed.features, feed.prediction).first().asDict()
    return Trained(model, train, test, metrics)


def train_regressor(
    table: DataFrame, feed: Feed = EMISSION_FEED, tasks: int | None = None, parts_of_fit: int | None = None, **settings
) -> Trained:
    """A forest on the larger part; the held-out part gives the errors. ``table`` has the column ``part``."""
    train, test = parts(table)
    model = learning.fit(learning.regression_pipeline(feed, **settings), train, feed, tasks, parts_of_fit)
    scored = learning.score(model, test, [feed.label, feed.prediction])
    metrics = regression_metrics(scored, feed.label, feed.prediction).first().asDict()
    return Trained(model, train, test, metrics)


def train(
    spark: SparkSession,
    fcd_source: str | list[str],
    emission_source: str | list[str],
    cluster_model: str,
    regression_model: str,
    *,
    max_rows: int | None = None,
    missing: str = "zero",
    tasks: int | None = None,
    parts: int | None = None,
    with_type: bool = False,
) -> dict[str, float]:
    """Both models from two recorded feeds, stored; returns the held-out metrics and the rows of each part.

    ``max_rows`` caps the labelled rows of the forest (``config.ROW_CAP`` is the
    classic cap); by default all rows count, and for K-means they always do.
    ``tasks`` is the number of partitions to fit over, by default the scan's own;
    fitted models depend on how rows lie in them. With ``parts`` rows are dealt by
    their values into that many, and models depend on the rows and that number only.
    ``with_type`` makes the kind of vehicle a further feature of the forest.
    """
    folders = []
    metrics: dict[str, float] = {}
    try:
        for feed, source, cap, path, fit in (
            (FCD_FEED, fcd_source, None, cluster_model, train_clusters),
            (TYPED_EMISSION_FEED if with_type else EMISSION_FEED, emission_source, max_rows, regression_model, train_regressor),
        ):
            folders.append(land(spark, source, feed, missing, cap))
            trained = fit(spark.read.parquet(folders[-1]), feed, tasks, parts)
            learning.save(trained.model, path)
            rows = {f"{feed.name}_train_rows": trained.train.count(), f"{feed.name}_test_rows": trained.test.count()}
            metrics |= trained.metrics | rows
    finally:
        for folder in folders:
            discard(spark, folder)
    return metrics
