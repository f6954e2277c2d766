from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from textstyle.llm import neighbours as N
from textstyle.llm import QUERIES


@pytest.mark.parametrize("dimensions, bits", [(2, 3), (3, 2), (4, 2)])
def test_curve_steps_to_a_neighbouring_cell(dimensions, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    keys = N.hilbert(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def _exact(rows, asked, k):
    rows = [(i, np.array(v, np.float64)) for i, v in rows]
    out = {}
    for q, v in rows:
        if asked(q):
            near = sorted((-(w * v).sum(), i) for i, w in rows if i != q and len(w) == len(v))[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def test_whole_window_is_exact(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(120)]
    rows += [(200 + i, rows[7][1]) for i in range(60)]  # copies, of a query too
    rows += [(300, [1.0, 2.0]), (310, [2.0, 1.0]), (320, [-1.0, 0.0])]  # another width
    bad = [(400, None), (401, [0.0] * 8), (402, [1.0] * 7 + [float("nan")]), (403, [None] + [1.0] * 7), (404, [float("inf")] * 8), (None, [1.0] * 8)]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows + bad + rows[:1]], "vec_id bigint, embedding array<float>, score int")
    got = {}
    for r in N.search(table, F.col("vec_id") % 10 == 0, nearest=6, window=1000).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = _exact(rows, lambda q: q % 10 == 0, 6)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert all(math.isclose(a, b, rel_tol=1e-12) for (_, a), (_, b) in zip(got[q], want[q]))
    assert N.search(table.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_measured_recall(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = {}
    for r in QUERIES["op4_neighbours"](spark, sf_dir).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], np.float64)
    hits = []
    for q in found:
        scores = x @ x[ids == q][0]
        scores[ids == q] = -9
        hits.append(len(found[q] & set(ids[np.lexsort((ids, -scores))[:20]].tolist())) / 20)
    assert len(found) == (ids % 20 == 0).sum() and np.mean(hits) >= 0.9


def test_wide_window_sends_a_query_to_few_blocks(spark, monkeypatch):
    """A window over many least blocks makes the blocks larger, and copies no query to each."""
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(1500)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    monkeypatch.setattr(N, "BLOCK", 32)
    lists, compared = [], N._compared

    def counted(*a):
        found = compared(*a)
        lists.append(found.groupBy("entry").count().agg(F.max("count")).first()[0])
        return found

    monkeypatch.setattr(N, "_compared", counted)
    got = {}
    for r in N.search(table, F.col("vec_id") % 50 == 0, nearest=5, window=1500).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {q: [i for i, _ in near] for q, near in _exact(rows, lambda q: q % 50 == 0, 5).items()}
    assert lists[0] <= 3 * N.CURVES


@pytest.mark.parametrize("spread", [1e-9, 0.0, 1.0])
@pytest.mark.parametrize("lengths", [1, 1e5])
def test_rounding_loses_no_pair(spread, lengths):
    """Items closer than single precision tells apart, equal ones, and short ones beside long ones."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=16) + spread * rng.normal(size=(3000, 16))
    x[::7] *= -lengths
    near, q = np.sort(rng.integers(0, 4000, 3000)), rng.normal(size=(300, 16))
    at = np.sort(rng.integers(0, 4000, 300))
    for window in (3, 700, 5000):
        got = {}
        for row, item, scores in N._near(near, x, at, q, window, 10):
            assert len(set(zip(row.tolist(), item.tolist()))) == len(row)
            for r, t, s in zip(row.tolist(), item.tolist(), scores.tolist()):
                got.setdefault(r, []).append((-s, t))
        for r in range(300):
            inside = np.flatnonzero(np.abs(near - at[r]) <= window)
            want = sorted((-s, t) for s, t in zip((x[inside] * q[r]).sum(axis=1).tolist(), inside.tolist()))
            assert sorted(got.get(r, []))[:10] == want[:10]


def test_best_rows_of_each_group():
    group, scores, ids = np.array([2, 1, 2, 2, 1, 2]), np.array([1.0, 5, 3, 3, 5, 3]), np.array([9, 4, 8, 7, 4, 8])
    got = [a.tolist() for a in N._best(group, scores, ids, 2)]
    assert got == [[1, 2, 2], [5, 3, 3], [4, 7, 8]]
    assert [len(a) for a in N._best(*(a[:0] for a in (group, scores, ids)), 2)] == [0, 0, 0]
