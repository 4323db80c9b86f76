from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from roadpulse.llm import contracts
from roadpulse.llm.common import Remembered
from verify import TABLES, rows

COLUMNS = {
    1: ["doc_id", "size", "source_size", "target", "taken"],
    2: ["doc_id", "start", "n_tokens", "ids_crc32"],
    3: ["vec_id", "n_links", "component_id", "kept"],
    4: ["page_id", "host", "path", "rule", "verdict"],
    5: ["doc_id", "held_out", "score", "predicted"],
    6: ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    7: ["page_id", "url", "text", "n_chars"],
    8: ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    9: ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    10: ["doc_id", "n_shingles", "component_id"],
    11: ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    12: ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
    13: ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
}


def test_one_query_for_each_operator_and_the_pipeline():
    names = contracts.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(contract.queries())
    assert contracts.oracles().items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(contracts.oracles()))
def test_query_equals_its_twin(spark, sf_dir, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = contracts.queries()[name](spark, sf_dir)
    answer = db.execute(contracts.oracles()[name])
    columns = [c[0] for c in answer.description]
    assert rows(columns, answer.fetchall()) == rows(result.columns, result.collect())


@pytest.mark.parametrize("number", sorted(COLUMNS))
def test_columns_of_the_contract(spark, sf_dir, number):
    name = next(n for n in contracts.queries() if n.startswith(f"op{number}_"))
    result = contracts.queries()[name](spark, sf_dir)
    assert result.columns[: len(COLUMNS[number])] == COLUMNS[number]


def test_two_generations_are_remembered():
    memory = Remembered(most=3, longest=5)
    for key in "abcd":
        assert memory.missing({key}) == [key]
        memory.learn([key], [key * 2])
    assert memory.missing({"a", "e"}) == ["e"]  # a comes back from the older generation
    memory.learn(["e"], ["ee"])
    assert memory.now["a"] == "aa" and "b" not in memory.now
    memory.learn(memory.missing({"longer than five"}), [1])
    assert memory.now["longer than five"] == 1
    assert memory.missing({"longer than five"}) == ["longer than five"]
