"""Every query with a SQL statement gives the same values in DuckDB."""

from __future__ import annotations

import pytest
from oracle import connect, duck_rows, spark_rows

from logloom.plans.oracles import ORACLES
from logloom.plans.queries import QUERIES

# Iterative jobs without a SQL form; they have tests of their own.
ROWS_ONLY = {
    "cv_logistic",
    "cv_forest",
    "cv_scores",
    "feature_importance",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_statement_or_its_own_test():
    assert set(QUERIES) == set(ORACLES) | ROWS_ONLY


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(name, spark, duck, sf_dir):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected = duck_rows(duck, ORACLES[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
