"""Every checked query against its SQL twin, and the shape of its plan."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
import catalog
from helpers import plan
from verify import TABLES, rows

QUERIES = catalog.queries()
TWINS = catalog.oracles()
UNWANTED = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def db(sf_dir_module):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir_module}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def sf_dir_module():
    return "/root/testdata/sf0.001"


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(TWINS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, db, sf_dir_module, name):
    result = QUERIES[name](spark, sf_dir_module)
    text = plan(result)
    assert not [node for node in UNWANTED if node in text]
    got = rows(result.columns, result.collect())
    answer = db.execute(TWINS[name])
    columns = [column[0] for column in answer.description]
    assert sorted(columns) == sorted(result.columns)
    assert rows(columns, answer.fetchall()) == got


def test_entry_has_rows(spark):
    result = contract.entry(spark)
    assert result.columns == [
        "event_time", "vehicle_x", "vehicle_y", "congestion_cluster", "lat", "lon", "popup", "colour"
    ]
    assert result.count() > 0
