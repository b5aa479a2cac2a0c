"""Every registered query against its SQL answer, with ordinary and with tiny size limits."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest
from conftest import TESTDATA

from tidemark.plans.catalog import QUERIES
from tidemark.plans.oracles import ORACLES

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(TESTDATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def compare(spark, duck, name):
    answer = duck.execute(ORACLES[name])
    kinds = {column[0]: str(column[1]) for column in answer.description}
    expected = [dict(zip(kinds, row)) for row in answer.fetchall()]
    df = QUERIES[name](spark, TESTDATA)
    columns = sorted(df.columns)
    assert columns == sorted(kinds)
    assert {c: KINDS[kind] for c, kind in df.dtypes} == {
        c: "BIGINT" if kind == "HUGEINT" else kind for c, kind in kinds.items()
    }
    found = Counter(tuple(row[c] for c in columns) for row in df.collect())
    assert found == Counter(tuple(row[c] for c in columns) for row in expected)


def test_every_query_has_an_answer():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    compare(spark, duck, name)


SPLIT = [
    "dq_duplicate_event", "dq_single_pass", "dlq_new_only", "timeline_rebuild", "scd2_incremental", "scd2_new_rows",
    "delete_by_key", "surrogate_key_dense", "fact_sales", "temporal_join_overlap", "chk_scd2_contiguous", "medallion_end_to_end",
]


@pytest.mark.parametrize("name", SPLIT)
def test_query_with_hot_keys_split(tight, duck, name):
    compare(tight, duck, name)
