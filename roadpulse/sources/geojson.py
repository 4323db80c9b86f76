"""GeoJSON layers as one row per feature."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadpulse.schemas import GEOJSON, GEOJSON_FEATURE


def flatten_features(features: DataFrame) -> DataFrame:
    """Parsed features in the columns that every reader here gives."""
    return features.select(
        "type",
        "properties",
        F.col("geometry.type").alias("geometry_type"),
        F.col("geometry.coordinates").alias("coordinates"),
    )


def read_collections(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files that each hold one FeatureCollection document.

    A task reads a whole file, in one pass: right for many files of ordinary size.
    ``read_collection_ranges`` reads huge documents by many tasks in two passes.
    """
    documents = spark.read.schema(GEOJSON).option("multiLine", True).json(path)
    return flatten_features(documents.select(F.inline("features")))


def read_feature_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One feature per line (newline-delimited GeoJSON): splittable at any size."""
    return flatten_features(spark.read.schema(GEOJSON_FEATURE).json(path))
