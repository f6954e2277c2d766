from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from textstyle.llm import curve_packing as C
from textstyle.llm.neighbours import hilbert

FILE = public_tokenizers.path("byte_bpe_50k.json")


@given(st.lists(st.integers(0, 90), max_size=25))
@settings(max_examples=200, deadline=None)
def test_cuts_leave_no_padding(lengths):
    total, at, filled = sum(lengths), 0, {}
    edges = C.sequence_edges(total, 32)
    for n in lengths:
        pieces = list(C.cut(at, n, edges, 32))
        assert [p[0] for p in pieces] == list(np.cumsum([0] + [p[1] for p in pieces])[:-1])
        assert sum(p[1] for p in pieces) == n and all(p[1] > 0 for p in pieces)
        for _, k, sequence, offset in pieces:
            filled.setdefault(sequence, []).append((offset, k))
        at += n
    assert sorted(filled) == list(range(len(filled)))
    for parts in filled.values():
        end = 0
        for offset, k in sorted(parts):
            assert offset == end
            end += k
        assert end <= 32 and end & (end - 1) == 0


def test_every_id_once(spark):
    tokenizer = Tokenizer.from_file(FILE)
    texts = ["some words " * k for k in range(40)] + ["<|endoftext|> x", "<|endoftext|>"]
    rows = [(k, t, "x") for k, t in enumerate(texts)]
    rows += [(None, "no id", "x"), (5, "some words " * 5, "x"), (900, None, "x"), (901, "", "x")]
    rows += [(1000 + k, "the very same text", "x") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, start string").repartition(7)
    got = C.pack(docs, FILE, end_id=1, capacity=64, keep_ids=True).collect()
    want = Counter()
    for key, text, _ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want[(key, np.array(ids, "<u4").tobytes())] += 1
    own, filled = {}, {}
    for r in got:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        if r["doc_id"] != 5:
            own.setdefault(r["doc_id"], []).append(r)
    for key, pieces in own.items():
        pieces.sort(key=lambda r: r["start"])
        assert want[(key, b"".join(bytes(r["ids"]) for r in pieces))] == 1
        assert {r["doc_tokens"] for r in pieces} == {sum(r["length"] for r in pieces)}
    five = sum(r["length"] for r in got if r["doc_id"] == 5)
    assert five == 2 * (len(tokenizer.encode("some words " * 5, add_special_tokens=False)) + 1)
    for sequence, parts in filled.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 64 or (at < 64 and at & (at - 1) == 0 and sequence > max(filled) - 7)


def test_edge_tables(spark):
    docs = spark.createDataFrame([(None, None)], "doc_id bigint, text string")
    row = C.pack(docs, FILE, capacity=64).first()
    assert (row["start"], row["length"], row["doc_tokens"], row["offset"]) == (0, 1, 1, 0)
    assert C.pack(docs.limit(0), FILE).count() == 0
    with pytest.raises(ValueError):
        C.pack(docs, FILE, capacity=100)


def test_neighbours_on_the_curve_are_alike(spark):
    """Documents of one kind share more sequences than chance would give."""
    kinds = ["red green blue yellow colour paint", "bread butter milk cheese honey oats"]
    rows = [(k, f"{kinds[k % 2]} {k % 5} " * (3 + k % 4)) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    packed = C.pack(docs, FILE, capacity=256).select("sequence_id", "doc_id").distinct().collect()
    kinds_in = {}
    for r in packed:
        kinds_in.setdefault(r["sequence_id"], set()).add(r["doc_id"] % 2)
    assert sum(len(k) == 1 for k in kinds_in.values()) > 0.8 * len(kinds_in)


def test_curve_visits_every_cell_once():
    grid = np.stack(np.meshgrid(*[np.arange(4)] * 3), -1).reshape(-1, 3)
    keys = hilbert(grid, 2)
    order = grid[np.argsort(keys)]
    assert sorted(keys) == list(range(64))
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()
    lengths = np.array([3, 0, 2])
    keys = C.curve_keys(np.array([7, 8, 9, 7, 8]), lengths)
    assert (keys >= 0).all() and keys.max() < 1 << (C.DIMENSIONS * C.BITS)


def test_directions_are_made_once(monkeypatch):
    """Not for every group of documents; and ids beyond two bytes count too."""
    calls, real = [], np.linalg.qr
    monkeypatch.setattr(C, "COUNTED_TOKENS", 2)
    monkeypatch.setattr(np.linalg, "qr", lambda x: calls.append(1) or real(x))
    for first, last in C._groups(np.array([2, 1, 2, 3])):
        C.curve_keys(np.arange(2 * (last - first)), np.full(last - first, 2))
    assert len(calls) <= 1
    ids, lengths = np.array([5, 5, 70_000, 9, 5], np.uint32), np.array([3, 0, 2])
    cells = C._hashed(ids)
    want = np.zeros((3, C.BUCKETS))
    for row, cell in zip([0, 0, 0, 2, 2], cells):
        want[row, cell // 2] += 1 if cell % 2 else -1
    want = np.sign(want) * np.log1p(np.abs(want))
    want[[0, 2]] /= np.linalg.norm(want[[0, 2]], axis=1, keepdims=True)
    assert np.allclose(C.vectors(ids, lengths), want)
