from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from textstyle.session import get_session

    session = get_session(
        "tests",
        "8g",
        "local[*]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture()
def one(spark):
    """Evaluate an expression for one text."""

    def evaluate(text, expression):
        rows = spark.createDataFrame([(text,)], "text string")
        return rows.select(expression.alias("value")).first()["value"]

    return evaluate
