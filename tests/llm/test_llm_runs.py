from __future__ import annotations

import hashlib
import re
import zlib
from math import isqrt

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textstyle.llm import QUERIES, runs


def plain_runs(words: list) -> list[tuple[int, int, int]]:
    """Every run by trying every period; the smallest period of a stretch wins."""
    n, found = len(words), {}
    for q in range(1, n // runs.LEAST_PERIODS + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(runs.LEAST_WORDS, runs.LEAST_PERIODS * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words: list[str], found) -> str:
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def found_in(texts: list[str]) -> list:
    searched = runs._searched([t.encode().split() for t in texts])
    return [(n, [tuple(r.values()) for r in rs], text) for n, rs, text in searched]


def check(texts: list[str]) -> None:
    for text, (n, got, rest) in zip(texts, found_in(texts)):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        assert n == len(words) and got == plain_runs(words)
        assert rest == collapsed(words, got)


@given(st.lists(st.text(alphabet="ab", max_size=70), min_size=1, max_size=6))
@settings(max_examples=300, deadline=None)
def test_two_letters(texts):
    check([" ".join(t) for t in texts])


@given(
    st.lists(
        st.tuples(st.text(alphabet="abc", min_size=1, max_size=9), st.integers(1, 9)), max_size=8
    )
)
@settings(max_examples=300, deadline=None)
def test_repeated_parts(parts):
    check([" ".join("".join(p * k for p, k in parts))])


def test_shapes():
    inner = " ".join("a a a a a b".split() * 9)
    rng = np.random.default_rng(3)
    noise = [" ".join(map(str, rng.integers(0, k, 900))) for k in (2, 3, 30, 900)]
    long = " ".join(str(k % 37) for k in range(300))
    check(["", "x", "a a a a a", "a a a a a a", "a b a b a b a b", "a b a b a b a", inner,
           f"{inner} c {inner}", long, f"{long} x {long} x {long} x {long}", *noise])


def test_one_word_very_often_is_fast():
    n = 60_000
    assert found_in(["a " * n])[0] == (n, [(0, n, 1)], "a")
    text = ("a " * 50 + "b ") * 900
    spans = [(51 * k, 50, 1) for k in range(900)]
    assert found_in([text])[0][1] == sorted([(0, 51 * 900, 51), *spans])


def test_transforms_are_exact():
    rng = np.random.default_rng(1)
    for size in (1, 2, 8, 64):
        words = rng.integers(0, 1 << 30, 40 * size)
        words[4 * size : 5 * size] = words[3 * size : 4 * size]
        starts = np.arange(0, 30 * size, size)
        got = runs.occurrences(words, starts, size)
        for b, s in enumerate(starts):
            for d in range(size):
                same = (words[s : s + size] == words[s + size + d : s + 2 * size + d]).all()
                assert got[b, d] == same
        assert got[3, 0]
    for prime, generator in runs.PRIMES:
        rows = rng.integers(0, prime, (3, 16)).astype(np.uint64)
        mixed = runs.transform(rows, prime, generator)
        assert (runs.restore(mixed, prime, generator) == rows).all()
        # One of the mixed values is the plain sum.
        assert (mixed[:, 0] == rows.sum(axis=1) % prime).all()


def test_sums_that_one_prime_cannot_tell(monkeypatch):
    """A sum of squares that is a multiple of the first prime is no occurrence."""
    prime = runs.PRIMES[0][0]
    pairs = ((a, isqrt(prime - a * a)) for a in range(1, isqrt(prime)))
    a, b = next((a, b) for a, b in pairs if a * a + b * b == prime)
    words = np.array([0, 0, a, b, 1, 1])
    assert a * a + b * b == prime
    assert not runs.occurrences(words, np.array([0]), 2)[0, 0]
    monkeypatch.setattr(runs, "PRIMES", runs.PRIMES[:1])
    with pytest.raises(ValueError):
        runs.occurrences(words, np.array([0]), 2)


def test_table(spark):
    rows = [(1, "a b " * 5, 7), (1, "a b " * 5, 7), (None, "x", 0), (2, None, 1), (3, "", 1),
            (4, "é é é é é é é", 2), (5, "w " * 40_000, 3), (6, "z" * 1_000_000, 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, length int")
    got = sorted(runs.find(docs).collect(), key=lambda r: r["doc_id"] or 0)
    spans = [[tuple(x) for x in r["runs"]] for r in got]
    assert spans == [[], [(0, 10, 2)], [(0, 10, 2)], [], [], [], [(0, 40_000, 1)], []]
    assert [r["collapsed"] for r in got][:6] == ["x", "a b", "a b", "", "", rows[5][1]]
    assert got[1]["length"] == 7 and runs.find(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.find(docs.withColumnRenamed("length", "runs"))


def test_query(spark, sf_dir):
    got = {r["doc_id"]: r for r in QUERIES["op12_periodic_runs"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", doc["text"] or "")
        h, n = zlib.crc32(str(doc["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        found = plain_runs(words)
        row = got[doc["doc_id"]]
        assert row["n_runs"] == len(found)
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        assert (row["start"], row["length"], row["period"]) == best
        if found:
            assert row["exponent_milli"] == 1000 * best[1] // best[2]
        lines = "".join(f"{s},{k},{q}\n" for s, k, q in found)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        rest = collapsed(words, found).encode()
        assert row["collapsed_sha256"] == hashlib.sha256(rest).hexdigest()
    assert sum(r["n_runs"] > 0 for r in got.values()) > 5
