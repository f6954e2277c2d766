"""Registered queries against SQL, held-out labels or brute force on small tables."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import oracle  # noqa: E402

from textstyle.llm import ORACLES, QUERIES  # noqa: E402

SF_001 = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf_dir, name):
    con = oracle.connect(sf_dir)
    assert oracle.compare(spark, con, sf_dir, QUERIES[name], ORACLES[name]) is None


def test_entry_has_all_queries():
    import __spark_entry__ as entry

    names = entry.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(entry.oracle_sql()) <= set(names)


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_001}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op9_language"](spark, SF_001).join(docs, "doc_id").toPandas()
    held = rows[rows.held_out]
    assert len(rows) == 1000 and (held.lang == held.lang_pred).mean() > 0.98
    assert rows.score.between(0, 1).all()


def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF_001}/labels.parquet")
    rows = QUERIES["op3_quality"](spark, SF_001).join(labels, "doc_id", "left").toPandas()
    held = rows[rows.held_out & rows.quality.notna()]
    assert len(rows) == 1000 and (held.predicted == held.quality).mean() > 0.93
    assert rows.score.between(0, 1).all()
    assert (rows.predicted == (rows.score >= 0.7)).all()


def test_licences_of_documents(spark, sf_dir):
    rows = {r["doc_id"]: r for r in QUERIES["op2_licences"](spark, sf_dir).collect()}
    lines = {
        "apache": "Licensed under the Apache License, Version 2.0.",
        "cc-by-nc": "Licensed under CC BY-NC 4.0.",
        "gpl": "This work is licensed under the GNU General Public License, version 3.",
        "mit": "Released under the MIT License.",
    }
    for doc in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        want = ",".join(f for f, line in lines.items() if line in doc["text"])
        assert rows[doc["doc_id"]]["licences"] == want
    assert len(rows) == 200


def test_native_queries_run_no_python(spark, sf_dir):
    for name in ("op2_licences", "op7_chat"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
