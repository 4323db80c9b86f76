"""Feeds, fixed values and job settings."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql.types import StructType

from roadpulse import schemas

# Topics, the constant message key and the delivery text.
FCD_TOPIC = "stockholm-fcd"
EMISSION_TOPIC = "stockholm-emission"
CONSTANT_KEY = "stockholm"
DELIVERY_TEXT = "Produces message on topic %s:%s"

# Model and sampling settings.
CLUSTERS = 5
CLUSTER_SEED = 1
TREE_DEPTH = 10
TREE_COUNT = 20
SPLIT_SEED = 42
TRAIN_SHARE = 0.7
ROW_CAP = 1000
PREVIEW_ROWS = 10

# Marker text and colours per cluster.
MARKER_TEXT = "Cluster"
COLOURS = {1: "blue", 2: "green", 3: "red", 4: "purple"}
OTHER_COLOUR = "gray"

# Ours: a fixed forest seed, because Spark's default seed changes per process.
FOREST_SEED = 17
# Ours: values a text feature may have, and partitions that rows are dealt into for a fit.
MOST_CATEGORY_VALUES = 1000
FIT_PARTS = 64


@dataclass(frozen=True)
class Feed:
    """One message feed: its layout, its topic and what is predicted from it."""

    name: str
    topic: str
    schema: StructType
    features: tuple[str, ...]
    vector: str
    prediction: str
    scored: StructType
    label: str | None = None
    # What makes a record one of its kind: the split is drawn by it, and it is the
    # message key. One constant key would put a whole topic into one Kafka
    # partition, and the vehicle alone would do so for all rows without a number.
    identity: tuple[str, ...] = ("timestep_time", "vehicle_id")
    # Text features, turned into one-hot vectors.
    categories: tuple[str, ...] = ()

    @property
    def training_columns(self) -> list[str]:
        names = [*self.identity, *self.features, *self.categories, *([self.label] if self.label else [])]
        return list(dict.fromkeys(names))


FCD_FEED = Feed(
    name="fcd",
    topic=FCD_TOPIC,
    schema=schemas.FCD,
    features=("vehicle_x", "vehicle_y"),
    vector="fcd_features",
    prediction="congestion_cluster",
    scored=schemas.SCORED_FCD,
)
EMISSION_FEED = Feed(
    name="emission",
    topic=EMISSION_TOPIC,
    schema=schemas.EMISSION,
    features=("vehicle_fuel", "vehicle_speed", "vehicle_noise"),
    vector="emission_features",
    prediction="prediction",
    scored=schemas.SCORED_EMISSION,
    label="vehicle_NOx",
)
FEEDS = {feed.name: feed for feed in (FCD_FEED, EMISSION_FEED)}
#: The emission feed with the kind of vehicle as a fourth feature.
TYPED_EMISSION_FEED = replace(EMISSION_FEED, categories=("vehicle_type",))


@dataclass(frozen=True)
class ControlPoint:
    x: float
    y: float
    lat: float
    lon: float


# The two points that tie the local grid to the globe.
CONTROL_POINTS = (
    ControlPoint(x=0.26, y=14.01, lat=59.321926, lon=18.067417),
    ControlPoint(x=116.30, y=109.42, lat=59.322828, lon=18.069380),
)


@dataclass(frozen=True)
class Settings:
    """Where the jobs read and write; every path is explicit."""

    kafka_url: str | None = None
    cluster_model: str | None = None
    regression_model: str | None = None
    window_duration: str | None = None

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> Settings:
        # The environment names a deployment already sets.
        return cls(
            kafka_url=env.get("KAFKA_URL"),
            cluster_model=env.get("CLUSTER_MODEL_LOCATION"),
            regression_model=env.get("REGRESSION_MODEL_LOCATION"),
            window_duration=env.get("WINDOW_DURATION"),
        )
