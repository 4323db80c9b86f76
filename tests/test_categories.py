"""Text features, and fits that don't depend on how rows were dealt."""

from __future__ import annotations

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog.tables import emission_records
from helpers import bag
from roadpulse.config import EMISSION_FEED, FCD_FEED, TYPED_EMISSION_FEED
from roadpulse.operators import learning, partitioning
from roadpulse.operators.partitioning import canonical
from roadpulse.operators.records import as_envelopes
from roadpulse.streaming.scoring import fields_needed, scored_messages

SCHEMA = "vehicle_fuel DOUBLE, vehicle_speed DOUBLE, vehicle_noise DOUBLE, vehicle_type STRING, vehicle_NOx DOUBLE"


def rows(spark, *types):
    return spark.createDataFrame([(1.0, 2.0, 3.0, t, float(k)) for k, t in enumerate(types)], SCHEMA)


def vectors(known, df):
    made = learning.type_vectors(known, df, TYPED_EMISSION_FEED)
    return [(r.vehicle_type, r.v[3:]) for r in made.select("vehicle_type", vector_to_array(TYPED_EMISSION_FEED.vector).alias("v")).collect()]


def test_a_place_for_each_value_and_one_for_all_others(spark):
    known = rows(spark, "van", "car", "car", "bus")
    found = vectors(known, rows(spark, "bus", "car", "van", "tram", None, ""))
    assert found == [
        ("bus", [1.0, 0.0, 0.0, 0.0]),
        ("car", [0.0, 1.0, 0.0, 0.0]),
        ("van", [0.0, 0.0, 1.0, 0.0]),
        ("tram", [0.0, 0.0, 0.0, 1.0]),
        (None, [0.0, 0.0, 0.0, 1.0]),
        ("", [0.0, 0.0, 0.0, 1.0]),
    ]


def test_empty_and_missing_text_is_no_value(spark):
    assert vectors(rows(spark, "", "car", None), rows(spark, "", "car", None)) == [("", [0.0, 1.0]), ("car", [1.0, 0.0]), (None, [0.0, 1.0])]


def test_without_any_value_all_are_unknown(spark):
    assert vectors(rows(spark, "", None), rows(spark, "car")) == [("car", [1.0])]


def test_places_do_not_depend_on_counts(spark):
    few, many = rows(spark, "a", "b", "b"), rows(spark, "a", "a", "a", "b")
    assert vectors(few, rows(spark, "a", "b")) == vectors(many, rows(spark, "a", "b"))


def test_too_many_values_are_refused(spark):
    many = rows(spark, *[f"t{k}" for k in range(30)])
    learning.check_categories(many, TYPED_EMISSION_FEED, most=30)
    with pytest.raises(ValueError, match="vehicle_type has more than 29 values"):
        learning.check_categories(many, TYPED_EMISSION_FEED, most=29)


def test_a_stored_model_uses_the_type_and_scores_new_ones(spark, tmp_path):
    known = rows(spark, *["car", "van"] * 50).withColumn("vehicle_NOx", F.when(F.col("vehicle_type") == "van", 9.0).otherwise(1.0))
    pipeline = learning.regression_pipeline(TYPED_EMISSION_FEED, depth=3, trees=5)
    learning.save(learning.fit(pipeline, known, TYPED_EMISSION_FEED), str(tmp_path / "m"))
    model = learning.load(str(tmp_path / "m"))
    assert learning.dictionaries(model, TYPED_EMISSION_FEED) == {"vehicle_type": ["car", "van"]}
    feed = TYPED_EMISSION_FEED
    assert fields_needed(feed) == ["vehicle_fuel", "vehicle_speed", "vehicle_noise", "vehicle_NOx", "vehicle_type"]
    some = rows(spark, "car", "van", "tram")
    rest = {f.name: F.lit(None).cast(f.dataType) for f in feed.schema if f.name not in some.columns}
    sent = as_envelopes(some.withColumns(rest), feed, F.lit("2024-01-01").cast("timestamp"))
    found = [r.prediction for r in scored_messages(sent, feed, model).orderBy("vehicle_NOx").collect()]
    assert found[0] < 3 < 7 < found[1] and 0.9 < found[2] < 9.1


@pytest.fixture(scope="module")
def emission(spark):
    return emission_records(spark, "/root/testdata/sf0.001").cache()


def dealt(df):
    return [[tuple(r) for r in part] for part in df.rdd.glom().collect()]


def test_canonical_partitions_depend_on_the_rows_alone(spark, emission, monkeypatch):
    monkeypatch.setattr(partitioning, "CHUNK", 5)
    columns = ["vehicle_fuel", "vehicle_speed"]
    zeros = spark.range(403).select(F.lit(0.0).alias("vehicle_fuel"), F.lit(-0.0).alias("vehicle_speed"), F.lit("x").alias("other"))
    odd = spark.createDataFrame([(None, 1.0), (None, 1.0), (float("nan"), 2.0)], "vehicle_fuel DOUBLE, vehicle_speed DOUBLE")
    table = emission.select(*columns).unionByName(zeros.select(*columns)).unionByName(odd)
    first, second = (dealt(canonical(table.repartition(n).orderBy(F.rand(n)), columns, 6)) for n in (3, 16))
    assert str(first) == str(second) and len(first) == 6
    assert sum(map(len, first)) == emission.count() + 406
    # Equal rows are spread.
    assert all(sum(r == (0.0, 0.0) for r in part) > 20 for part in first)
    counted = bag(table.where("vehicle_fuel between 1e-9 and 1e9"))
    assert counted == {k: n for k, n in counted.items() if sum(part.count(k) for part in first) == n}


def test_fits_from_other_partitionings_are_the_same(emission, spark):
    positions = emission.select("vehicle_x", "vehicle_y")
    centres = [learning.centres(learning.fit(learning.cluster_pipeline(), positions.repartition(n), FCD_FEED, parts=5)) for n in (3, 16)]
    for a, b in zip(*centres, strict=True):
        assert a == pytest.approx(b, rel=1e-9)
    pipeline = learning.regression_pipeline(depth=4, trees=3)
    models = [learning.fit(pipeline, emission.repartition(n), EMISSION_FEED, parts=5) for n in (3, 16)]
    both = [learning.score(m, emission).agg(F.sum("prediction")).first()[0] for m in models]
    assert both[0] == pytest.approx(both[1], rel=1e-9)


def test_canonical_of_no_rows(spark, emission):
    assert canonical(emission.limit(0), ["vehicle_fuel"], 3).count() == 0
