"""Every query with an SQL twin equals DuckDB's answer."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402

from textstyle.catalog import ORACLES, QUERIES  # noqa: E402

# Each fits the whole search of all models; test_learning covers them with a smaller one.
LONG = ("ml6_", "ml15_evaluate_models", "ml18_")


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if not n.startswith(LONG)))
def test_equals_sql(spark, duck, sf_dir, name):
    assert oracle.compare(spark, duck, sf_dir, QUERIES[name], ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 8
    assert set(entry.oracle_sql()) <= set(entry.queries())
