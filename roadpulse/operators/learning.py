"""Feature assembly, model fitting, storage and scoring with Spark MLlib."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import OneHotEncoder, QuantileDiscretizer, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from roadpulse import config
from roadpulse.config import Feed
from roadpulse.functions.distance import EXPRESSION_TERMS, nearest_centre
from roadpulse.operators.partitioning import canonical

#: Ranges of a feature that rows are ordered by, as many as MLlib's trees tell apart.
ALIKE = 32


def assembler(feed: Feed, on_invalid: str = "error") -> VectorAssembler:
    inputs = [*feed.features, *map(_one_hot, feed.categories)]
    return VectorAssembler(inputCols=inputs, outputCol=feed.vector, handleInvalid=on_invalid)


def _text(category: str) -> str:
    return f"_{category}_text"


def _index(category: str) -> str:
    return f"_{category}_index"


def _one_hot(category: str) -> str:
    return f"_{category}_one_hot"


def category_stages(feed: Feed) -> list:
    """Text features as one-hot vectors: a place for each value met in training, in the order of the alphabet, and a last
    one for all else: other values, empty and missing ones. So a stream's new value is scored as unknown, never refused
    and never taken for a known one."""
    if not feed.categories:
        return []
    names = list(feed.categories)
    texts, indices, vectors = [_text(n) for n in names], [_index(n) for n in names], [_one_hot(n) for n in names]
    shown = ", ".join(f"nullif(`{name}`, '') AS `{text}`" for name, text in zip(names, texts))
    # By the alphabet, not by frequency: the places then don't change with the counts.
    known = StringIndexer(inputCols=texts, outputCols=indices, handleInvalid="keep", stringOrderType="alphabetAsc")
    encoder = OneHotEncoder(inputCols=indices, outputCols=vectors, handleInvalid="error", dropLast=False)
    return [SQLTransformer(statement=f"SELECT *, {shown} FROM __THIS__"), known, encoder]


def check_categories(df: DataFrame, feed: Feed, most: int = config.MOST_CATEGORY_VALUES) -> None:
    """A dictionary goes to the driver and to every task: an error if a feature has more than ``most`` values."""
    for name in feed.categories:
        if df.select(name).distinct().limit(most + 1).count() > most:
            raise ValueError(f"{name} has more than {most} values")


def dictionaries(model: PipelineModel, feed: Feed) -> dict[str, list[str]]:
    """The values each text feature has a place for, in order."""
    return dict(zip(feed.categories, [list(labels) for labels in model.stages[1].labelsArray])) if feed.categories else {}


def assemble(df: DataFrame, feed: Feed, on_invalid: str = "error") -> DataFrame:
    """The feed's numeric features as one vector column."""
    return assembler(replace(feed, categories=()), on_invalid).transform(df)


def type_vectors(known: DataFrame, df: DataFrame, feed: Feed) -> DataFrame:
    """The feed's features, text ones included, as one vector column; places of values are those of ``known``."""
    check_categories(known, feed)
    return Pipeline(stages=[*category_stages(feed), assembler(feed)]).fit(known).transform(df)


def cluster_pipeline(feed: Feed = config.FCD_FEED, k: int = config.CLUSTERS, seed: int = config.CLUSTER_SEED) -> Pipeline:
    """Congestion zones: K-means over the position."""
    estimator = KMeans(k=k, seed=seed, featuresCol=feed.vector, predictionCol=feed.prediction)
    return Pipeline(stages=[*category_stages(feed), assembler(feed), estimator])


def regression_pipeline(
    feed: Feed = config.EMISSION_FEED,
    depth: int = config.TREE_DEPTH,
    trees: int = config.TREE_COUNT,
    seed: int = config.FOREST_SEED,
) -> Pipeline:
    """Pollutant output: a random forest over fuel, speed and noise."""
    estimator = RandomForestRegressor(
        featuresCol=feed.vector,
        labelCol=feed.label,
        predictionCol=feed.prediction,
        maxDepth=depth,
        numTrees=trees,
        seed=seed,
    )
    return Pipeline(stages=[*category_stages(feed), assembler(feed), estimator])


def side_by_side(df: DataFrame, dealt: DataFrame, feed: Feed) -> DataFrame:
    """``dealt``, rows of ``df``, with those side by side in each partition whose features are alike: in the same of
    ``ALIKE`` ranges of each, which hold about equally many rows.

    Rows next to each other then take the same way down a tree and add to the same
    sums, which are in the processor's cache. All rows are kept, and the draws of
    a forest don't depend on where a row lies.
    """
    ranges = [f"_{name}_range" for name in feed.features]
    cuts = QuantileDiscretizer(
        numBuckets=ALIKE, inputCols=list(feed.features), outputCols=ranges, relativeError=0.25 / ALIKE, handleInvalid="keep"
    )
    return cuts.fit(df).transform(dealt).sortWithinPartitions(*ranges).drop(*ranges)


def fit(pipeline: Pipeline, df: DataFrame, feed: Feed, tasks: int | None = None, parts: int | None = None) -> PipelineModel:
    """Fit on the feed's own columns only, over the scan's partitions or ``tasks`` of them.

    MLlib draws and adds up partition by partition, so a model depends on how its
    rows are dealt. With ``parts`` they are dealt by their own values into that many
    partitions, and the model depends on the rows and that number alone.
    With ``tasks``, the rows of a forest are ordered by ``side_by_side``.
    MLlib keeps its vectors in memory and on disk by itself during the iterations.
    """
    check_categories(df, feed)
    columns = list(dict.fromkeys([*feed.features, *feed.categories, *([feed.label] if feed.label else [])]))
    if parts:
        return pipeline.fit(canonical(df, columns, parts))
    chosen = df.select(*columns)
    if not tasks:
        return pipeline.fit(chosen)
    dealt = chosen.repartition(tasks)
    forest = isinstance(pipeline.getStages()[-1], RandomForestRegressor)
    return pipeline.fit(side_by_side(chosen, dealt, feed) if forest else dealt)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Predictions row by row, for tables and streams alike."""
    scored = model.transform(df)
    return scored.select(*columns) if columns else scored


def score_feed(model: PipelineModel, df: DataFrame, feed: Feed, columns: Sequence[str]) -> DataFrame:
    """Like ``score``: a missing or NaN feature fails the job whatever the model.

    A handful of Euclidean centres becomes a plain expression inside generated
    code, about ten times faster than building a vector per row for MLlib. More
    centres than that, and every other model, go through MLlib.
    """
    fitted = model.stages[-1]
    if isinstance(fitted, KMeansModel) and not feed.categories and fitted.getDistanceMeasure() == "euclidean":
        known = centres(model)
        if len(known) * len(feed.features) <= EXPRESSION_TERMS:
            features = [F.col(name) for name in feed.features]
            bad = reduce(lambda left, right: left | right, [f.isNull() | F.isnan(f) for f in features])
            refusal = F.raise_error(F.lit("a row with a missing or NaN feature cannot be scored")).cast("int")
            cluster = F.when(bad, refusal).otherwise(nearest_centre(features, known))
            return df.withColumn(feed.prediction, cluster).select(*columns)
    return score(model, df, columns)


def scored_columns(feed: Feed, event_time: bool = False) -> list[str]:
    return [*feed.scored.names, *(["event_time"] if event_time else [])]


def centres(model: PipelineModel) -> list[list[float]]:
    """The fitted centres: k of them, held on the driver by the model itself."""
    return [[float(v) for v in centre] for centre in model.stages[-1].clusterCenters()]


def elements(vector: str, names: Sequence[str]):
    """A vector column's elements as named columns."""
    array = vector_to_array(F.col(vector))
    return [array[i].alias(name) for i, name in enumerate(names)]
