from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textstyle.llm import decontaminate as D

WORDS = st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40)


@given(WORDS, st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=6), max_size=6))
@settings(max_examples=200, deadline=None)
def test_finds_every_occurrence(words, windows):
    patterns = [(tuple(w), [str(k)]) for k, w in enumerate(windows)]
    found = {(s, e, i) for s, e, ids in D.WuManber(patterns).find(words) for i in ids}
    want = {
        (s, s + len(w), str(k))
        for k, w in enumerate(windows)
        for s in range(len(words) - len(w) + 1)
        if words[s : s + len(w)] == w
    }
    assert found == want


def test_words():
    assert D.words_of("Ab, c_D-é9—x".encode()) == [b"ab", b"c", b"d", "é9—x".encode()]


def _tables(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = [
        (1, f"x y {item.upper()}! z", "k"), (1, f"x y {item.upper()}! z", "k"),
        (2, "two three four five six seven eight nine ten", "k"), (3, None, None), (4, "", ""),
        (None, "short ITEM here", "k"), (5, "nothing", "k"),
    ]
    items = [(10, item), (9, "short item"), (9, "short item"), (None, "nothing"), (7, None), (8, "!")]
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, item_id string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )


@pytest.mark.parametrize("pass_bytes", [1 << 20, 100])
def test_nulls_repeats_and_passes(spark, pass_bytes):
    docs, items = _tables(spark)
    rows = D.scan(docs, items, pass_bytes=pass_bytes).collect()
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_hit"], r["items"]) for r in rows)
    assert got == [
        (0, 3, 2, ["9"]), (1, 14, 11, ["10"]), (1, 14, 11, ["10"]), (2, 9, 0, []), (3, 0, 0, []),
        (4, 0, 0, []), (5, 1, 1, []),
    ]
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in rows}
    assert spans[1] == [(2, 13)] and spans[2] == []
    assert rows[0]["item_id"] in ("k", "", None)  # a column of the documents, passed through


def test_empty_tables_and_clashes(spark):
    docs, items = _tables(spark)
    assert D.scan(docs.limit(0), items).count() == 0
    assert D.scan(docs, items.limit(0)).where("n_hit > 0").count() == 0
    with pytest.raises(ValueError):
        D.scan(docs.withColumnRenamed("item_id", "n_hit"), items)
