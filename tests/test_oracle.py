"""Every registered query against its SQL, on all rows of the given tables."""

from __future__ import annotations

import pytest
from compare import connect, spark_rows, sql_rows

from registry.oracle import ORACLE
from registry.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf, con, name):
    columns, rows = spark_rows(QUERIES[name](spark, sf))
    expected_columns, expected = sql_rows(con, ORACLE[name])
    assert columns == expected_columns
    assert len(rows) == len(expected) > 0
    assert rows == expected


def test_entry_runs(spark):
    import __spark_entry__

    labels = {r["classification"]: r["n_series"] for r in __spark_entry__.entry(spark).collect()}
    assert labels == {"Intermittent": 73, "Lumpy": 20}
