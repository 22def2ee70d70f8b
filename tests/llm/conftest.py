"""Helpers shared by the tests of the optional subpackage."""

from __future__ import annotations

import pytest


@pytest.fixture(scope="session", autouse=True)
def few_partitions(spark):
    """Small fixtures need few tasks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
