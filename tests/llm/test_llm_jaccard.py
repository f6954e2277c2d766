from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textstyle.llm import jaccard as J
from textstyle.llm.components import components


def _roots(n, links):
    label = list(range(n))
    for _ in range(n):
        for u, v in links:
            label[u] = label[v] = min(label[u], label[v])
    return label


@pytest.mark.parametrize("task_links", [0, 1 << 20])
def test_components(spark, task_links):
    rng = random.Random(task_links)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(3, 3), (100, 101), (101, 102)]
    edges = spark.createDataFrame(links, "u bigint, v bigint")
    got = {r["node"]: r["root"] for r in components(edges, task_links).collect()}
    want = _roots(103, links)
    assert got == {n: want[n] for u, v in links if u != v for n in (u, v)}
    assert components(edges.limit(0), task_links).count() == 0


def _shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    size = min(3, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def _expected(rows, percent=90):
    sets = [_shingles(t) for _, t in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    group = _roots(len(rows), links)
    least = {}
    for (key, _), g in zip(rows, group):
        least[g] = min(least.get(g, key), key)
    return sorted((key, len(s), least[g]) for (key, _), s, g in zip(rows, sets, group))


def _texts(seed, n):
    """Families of near copies, some in chains, and texts that share passages."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    passage, texts = [word() for _ in range(30)], []
    while len(texts) < n:
        base = [word() for _ in range(rng.choice([2, 5, 11, 12, 20, 40, 80, 160]))]
        if rng.random() < 0.5:
            base += passage
        for _ in range(rng.choice([1, 1, 2, 6])):
            texts.append(" ".join(base))
            base = list(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                base[rng.randrange(len(base))] = word()
    return texts[:n]


@pytest.mark.parametrize("block_sets", [1024, 4])
def test_links_equal_brute_force(spark, block_sets):
    texts = _texts(block_sets, 140) + [None, "", " \n", "A b", "a B", "one", "One"]
    rows = [(k * 7 % 1000, t) for k, t in enumerate(texts)] + [(5000, texts[0]), (5000, texts[0])]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, h int").repartition(4)
    got = J.near_classes(docs, block_sets=block_sets).collect()
    assert sorted(tuple(r) for r in got) == _expected(rows)


def test_one_large_cluster_in_blocks(spark):
    """A chain of small changes: ends are far apart, neighbours link."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(60):
        rows.append((k, " ".join(base)))
        base = list(base)
        base[rng.randrange(120)] = f"n{k}"
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = J.near_classes(docs, block_sets=8).collect()
    assert sorted(tuple(r) for r in got) == _expected(rows)


def test_no_search_holds_more_than_two_blocks(spark, monkeypatch):
    """One large cluster of texts of which few link."""
    rng, rows, held = random.Random(6), [], []
    for k in range(160):
        rows.append((k, " ".join(f"r{rng.randrange(10**6)}" for _ in range(40))))
    rows += [(1000 + k, rows[k][1] + " more") for k in range(0, 160, 16)]

    def one_star(sets):
        h = sets.where("n > 0").select("h")
        return h.crossJoin(h.agg(F.min("h").alias("v"))).select(F.col("h").alias("u"), "v")

    def counted(search):
        def run(found, percent):
            keys = [c for c in ("cluster", "block") if c in found.columns]
            held.extend(r["count"] for r in found.groupBy(*keys).count().collect())
            return search(found, percent)

        return run

    def across(held_sets, asked, block_sets, percent):
        asks.append(asked.count())
        return real(held_sets, asked, block_sets, percent)

    monkeypatch.setattr(J, "_stars", one_star)
    real, asks = J._search_across, []
    monkeypatch.setattr(J, "_search", counted(J._search))
    monkeypatch.setattr(J, "_search_across", across)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = J.near_classes(docs, block_sets=16).collect()
    assert sorted(tuple(r) for r in got) == _expected(rows)
    assert len(held) > 10 and max(held) < 80  # of 170, blocks being dealt by hash
    assert asks[0] < 60  # of 170 sets that could each ask ten blocks


def test_prefixes_of_linked_sets_meet():
    """For all sizes, overlaps and orders that link, the first shingles share one."""
    rng = np.random.default_rng(2)
    for percent in (80, 90):
        for _ in range(1500):
            n = int(rng.integers(1, 40))
            m = int(rng.integers(max(1, percent * n // 100), 100 * n // percent + 2))
            shared = int(J.required(n, m, percent))
            if shared > min(n, m):
                continue
            pool = rng.integers(0, 1 << 63, n + m - shared, dtype=np.uint64)
            a, b = pool[:n], pool[n - shared :]
            counts = rng.integers(0, 3, J.SLOTS)
            assert len(a) == n and len(b) == m
            assert np.intersect1d(J.prefix(a, counts, percent), J.prefix(b, counts, percent)).size


def test_scratch_tables_are_deleted(spark):
    import pathlib

    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir"))
    before = {p.name for p in shared.iterdir()}
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(_texts(3, 60))], "doc_id bigint, text string")
    paths: list[str] = []
    near = J.near_classes(docs, block_sets=4, paths=paths).collect()
    assert sorted(tuple(r) for r in near) == _expected([(k, t) for k, t in enumerate(_texts(3, 60))])
    left = {p.name for p in shared.iterdir()} - before
    assert left == {p.rsplit("/", 1)[1] for p in paths} and len(left) == 3


def test_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (2, "a b c d"), (None, "x y z")], "doc_id bigint, text string")
    got = sorted(((r[0] or 0, r[2] or 0) for r in J.near_classes(docs).collect()))
    assert got == [(0, 0), (0, 2), (2, 2)]
    assert J.near_classes(docs.limit(0)).count() == 0


def test_links_run_through_rows_without_id(spark):
    """Texts 1 and 3 link with the one between them, not with each other."""
    words = [f"w{k}" for k in range(60)]
    rows = [(1, words[:60]), (None, words[4:60] + ["x"]), (3, words[8:60] + ["x", "y"]), (None, ["z"] * 9)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string")
    got = sorted(((r[0] or 0, r[2] or 0) for r in J.near_classes(docs).collect()))
    assert got == [(0, 0), (0, 1), (1, 1), (3, 1)]


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(0)
    for n in [9, 10, 11, 19, 20, 40, 100, 300, 700] * 6:
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        m = int(rng.integers(0, n // 8 + 2))
        b = np.unique(np.concatenate([a[m // 2 :], rng.integers(0, 1 << 62, m - m // 2).astype(np.uint64)]))
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= 90 * (len(a) + len(b) - shared) and not np.array_equal(a, b):
            assert set(J.signatures(a)) & set(J.signatures(b))


@pytest.mark.parametrize("percent, sizes", [(90, 60), (80, 30)])
def test_all_linked_sizes_share_a_signature_in_one_part(percent, sizes):
    """All shingles in one part: the others are empty, and that one differs."""
    pool = np.random.default_rng(2).integers(0, 1 << 62, 5_000_000).astype(np.uint64)
    pool = np.unique(pool[(J._mix(pool) >> np.uint64(8)) % np.uint64(27720) == 0])  # of 1 to 12 parts
    assert len(pool) > 2 * sizes
    for b in range(1, sizes):
        for a in range(-(-percent * b // 100), b + 1):
            for shared in range(J.required(a, b, percent), a + (a < b)):
                one, other = pool[:a], pool[a - shared : a - shared + b]
                assert set(J.signatures(one, percent)) & set(J.signatures(other, percent)), (a, b, shared)


def test_search_equals_counting():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 62, 200).astype(np.uint64)
    sets = []
    for k in range(60):
        s = base.copy()
        s[rng.integers(0, 200, k % 25)] = rng.integers(0, 1 << 62, k % 25).astype(np.uint64)
        sets.append(np.unique(s))
    index = J.SkipIndex(sets)
    for i, s in enumerate(sets):
        want = [j for j, t in enumerate(sets) if 100 * (c := len(np.intersect1d(s, t))) >= 90 * (len(s) + len(t) - c)]
        assert index.search(s, np.ones(60, bool)).tolist() == want, i


def test_few_texts_are_held_at_a_time():
    import pyarrow as pa

    from textstyle.llm.tables import in_slices

    batch = pa.RecordBatch.from_arrays([pa.array(["x"] * 1200)], ["text"])
    assert [b.num_rows for b in in_slices([batch, batch.slice(0, 0)])] == [512, 512, 176]


def test_a_common_line_does_not_join_unlike_texts(spark, monkeypatch):
    """Texts that share nothing but a line stay in clusters of their own."""
    rng, line, rows = random.Random(8), " ".join(f"c{k}" for k in range(14)), []
    for k in range(300):
        own = " ".join(f"r{rng.randrange(10**9)}" for _ in range(rng.randrange(20, 60)))
        rows.append((k, f"{own} {line}"))
    rows += [(1000 + k, rows[k][1] + " more") for k in range(0, 300, 30)]
    sizes, real = [], J._links

    def links(docs, classes, clusters, *rest):
        sizes.extend(r["count"] for r in clusters.groupBy("root").count().collect())
        return real(docs, classes, clusters, *rest)

    monkeypatch.setattr(J, "_links", links)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = J.near_classes(docs, words=5, percent=80).collect()
    assert sorted((r[0], r[2]) for r in got) == sorted((k, k % 1000) for k, _ in rows)
    assert len(sizes) >= 8 and max(sizes) < 20


def test_linked_sets_share_a_signature_whatever_is_common():
    rng = np.random.default_rng(3)
    for n in [9, 10, 19, 20, 40, 100, 300] * 8:
        common = rng.random(J.SLOTS) < rng.choice([0.1, 0.5, 0.9, 1])
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.append(a[n // 12 :], rng.integers(0, 1 << 62, n // 12).astype(np.uint64)))
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= 80 * (len(a) + len(b) - shared):
            assert set(J.signatures(a, 80, common)) & set(J.signatures(b, 80, common))
