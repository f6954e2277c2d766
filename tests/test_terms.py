from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import IDF, CountVectorizerModel
from pyspark.sql import functions as F

from textstyle.functions import text as T
from textstyle.operators import terms as V

DOCS = [(1, "b a b"), (2, "a c c c"), (3, ""), (4, None), (5, "a b d")]


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id int, text string")


def test_term_counts(docs):
    rows = V.term_counts(docs, T.tokenize("text"), "doc_id").collect()
    want = {
        (i, term): n for i, text in DOCS for term, n in Counter((text or "").split()).items()
    }
    assert {(r["doc_id"], r["term"]): r["tf"] for r in rows} == want


def test_term_counts_sorts_each_text_once(docs):
    """The sort must not be copied into a filter or into the per-token function."""
    frame = V.term_counts(docs, T.tokenize("text"), "doc_id")
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array") == 1 and "Exchange" not in plan


def test_vocabulary_breaks_ties_by_term(docs):
    rows = V.vocabulary(docs, T.tokenize("text"), vocab_size=2, min_df=2).collect()
    assert [tuple(r) for r in sorted(rows)] == [(1, "a", 3, 3), (2, "b", 3, 2)]


def test_min_df_counts_documents(docs):
    terms = {r["term"] for r in V.term_statistics(docs, T.tokenize("text")).collect()}
    assert terms == {"a", "b"}  # c occurs three times, in one document


def test_top_ngrams(docs):
    rows = V.top_ngrams(docs, T.tokenize("text"), 2, 2).collect()
    assert [tuple(r) for r in rows] == [("a b", 2), ("c c", 2)]


def test_idf_agrees_with_mllib(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.withColumn("w", T.tokenize("text"))
    vocab = V.vocabulary(docs, F.col("w"), 10_000)
    ours = V.with_idf(vocab, docs.agg(F.count(F.lit(1))).scalar()).orderBy("rank").collect()
    model = CountVectorizerModel.from_vocabulary(
        [r["term"] for r in ours], inputCol="w", outputCol="tf"
    )
    idf = IDF(inputCol="tf", outputCol="x").fit(model.transform(docs))
    assert [r["idf"] for r in ours] == pytest.approx(list(idf.idf), abs=1e-9)
    assert [r["df"] for r in ours] == list(idf.docFreq)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_join_small_either_way(spark, limit):
    hot = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("k"))
    table = spark.createDataFrame([("x", 1), ("z", 2)], "k string, v int")
    joined = V.join_small(hot, table, "k", how="left", limit=limit)
    assert joined.count() == 3000 and joined.filter("v = 1").count() == 1000


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_stem_dictionary(spark, limit):
    docs = spark.createDataFrame(
        [(1, ["b", "a", "b", "zz"]), (2, []), (3, None), (4, ["a"]), (4, ["y"])],
        "doc_id int, w array<string>",
    ).repartition(3)
    # Two stems for a token, and two rows with one id: the same result either way.
    listed = [("a", "A"), ("b", "C"), ("b", "B"), ("zz", None), (None, "N")]
    stems = spark.createDataFrame(listed, "token string, stem string")
    done = V.stem_with_dictionary(docs, "w", stems, "s", limit)
    rows = sorted((r["doc_id"], r["s"]) for r in done.collect())
    assert rows == [(1, ["B", "A", "B", "zz"]), (2, []), (3, []), (4, ["A"]), (4, ["y"])]


def test_empty_dictionary(spark):
    docs = spark.createDataFrame([(1, ["b"])], "doc_id int, w array<string>")
    none = spark.createDataFrame([], "token string, stem string")
    assert V.stem_with_dictionary(docs, "w", none, "s").first()["s"] == ["b"]


def test_broadcast_limit_counts_bytes(spark):
    small = spark.createDataFrame([("x" * 100,)], "k string")
    assert V.fits_broadcast(small, 200) and not V.fits_broadcast(small, 100)


def test_tfidf_long_does_not_shuffle_the_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    frame = V.tfidf_long(docs, "doc_id", T.tokenize("text"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_rule_dictionary(spark):
    docs = spark.createDataFrame([(["مكتوب", "كاتب", "مكتوب"],)], "w array<string>")
    rows = V.rule_dictionary(docs, F.col("w")).collect()
    assert {tuple(r) for r in rows} == {("مكتوب", "كتب"), ("كاتب", "كتب")}


@given(
    st.lists(
        st.tuples(st.sampled_from([None, "x", "y"]), st.lists(st.sampled_from("abcdefghij"), max_size=12)),
        max_size=12,
    ),
    st.integers(1, 6),
)
@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_top_items_are_exact(spark, rows, k):
    """Few slots and one to start with, so that the second count is needed too."""
    df = spark.createDataFrame([(g, w) for g, w in rows], "g string, w array<string>").repartition(3)
    for by in ([], ["g"]):
        found = V.top_items(df, F.col("w"), "item", k, by, slots=5, first_slots=1)
        want = Counter((g if by else 0, t) for g, w in rows for t in w)
        got = {(r["g"] if by else 0, r["item"]): r["count"] for r in found.collect()}
        assert all(want[key] == n for key, n in got.items())
        for group in {g for g, _ in want}:
            own = sorted((n for (g, _), n in want.items() if g == group), reverse=True)
            least = own[min(k, len(own)) - 1]
            assert all(key in got for key, n in want.items() if key[0] == group and n >= least)


def test_top_items_leave_most_of_the_tail_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pairs = T.ngrams(T.tokenize("text"), 2)
    few = V.top_items(docs, pairs, "ngram", 10, slots=1 << 14, first_slots=1 << 8)
    distinct = docs.select(F.explode(pairs).alias("n")).distinct().count()
    assert few.count() < 0.05 * distinct
    plain = docs.select(F.explode(pairs).alias("ngram")).groupBy("ngram").count()
    top = plain.orderBy(F.desc("count"), "ngram").limit(10).collect()
    assert [tuple(r) for r in V.top_ngrams(docs, T.tokenize("text")).collect()] == [tuple(r) for r in top]


@given(
    st.lists(st.none() | st.lists(st.none() | st.text(max_size=3), max_size=5), max_size=8),
    st.dictionaries(st.text(max_size=3), st.text(max_size=2), max_size=20),
    st.integers(0, 3),
)
@settings(max_examples=200, deadline=None)
def test_sorted_dictionary(lists, listed, skipped):
    table = V.SortedDictionary(
        pa.array(list(listed), pa.string()), pa.array(list(listed.values()), pa.string())
    )
    # A slice has offsets that do not start at zero.
    column = pa.array(lists, pa.list_(pa.string())).slice(min(skipped, len(lists)))
    want = [[listed.get(t, t) for t in row or []] for row in lists[skipped:]]
    assert table.stemmed(column).to_pylist() == want


def test_no_two_tokens_share_a_hash(monkeypatch):
    """A salt under which two tokens collide is passed over."""
    real = V.hash_array
    clash = lambda values, hash_key: (
        np.zeros(len(values), np.uint64) if hash_key.endswith("0") else real(values, hash_key=hash_key)
    )
    monkeypatch.setattr(V, "hash_array", clash)
    table = V.SortedDictionary(pa.array(["a", "b"]), pa.array(["A", "B"]))
    assert table.salt.endswith("1")
    assert table.stemmed(pa.array([["b", "c", "a"]])).to_pylist() == [["B", "c", "A"]]
    with pytest.raises(ValueError):
        V.SortedDictionary(pa.array(["a", "a"]), pa.array(["A", "B"]))


def test_a_large_dictionary_is_cut_to_what_occurs(spark):
    docs = spark.createDataFrame([(["a", "b"],), (["c"],)], "w array<string>")
    listed = spark.range(5000).select(F.concat(F.lit("t"), "id").alias("token"), F.lit("s").alias("stem"))
    listed = listed.union(spark.createDataFrame([("a", "A")], "token string, stem string"))
    done = V.stem_with_dictionary(docs, "w", listed, "s", 200)
    assert "Join" not in done._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["s"] for r in done.collect()) == [["A", "b"], ["c"]]


@pytest.mark.parametrize("limit", [0, 150, 1 << 20])
def test_stems_by_lookup_and_join_together(spark, limit):
    """Frequent entries are looked up, others joined; a stem is not stemmed again."""
    listed = {"a": "b", "b": "c", "c": "c", "\x00": "zero", "": "none", "x\x01": "one", "rare": "a"}
    rows = [["a", "b", None, "a"], None, [], ["", "\x00", "x\x01", "x\x00"], [None], ["rare", "new", "c"]]
    rows += [["a", "b"]] * 20
    docs = spark.createDataFrame(list(enumerate(rows)), "id int, w array<string>").repartition(3)
    stems = spark.createDataFrame(list(listed.items()), "token string, stem string")
    done = V.stem_with_dictionary(docs, "w", stems, "s", limit)
    assert done.columns == ["id", "w", "s"]
    got = {r["id"]: (r["w"], r["s"]) for r in done.collect()}
    assert got == {k: (w, [listed.get(t, t) for t in w or []]) for k, w in enumerate(rows)}


def test_the_frequent_part_fits(spark):
    known = spark.createDataFrame([(f"t{k}", "s", k) for k in range(1, 65)], "token string, stem string, count bigint")
    for limit in (0, 100, 1200, 1 << 20):
        head, tail = V._split_by_count(known, limit)
        assert V.fits_broadcast(head, limit) and head.count() + tail.count() == 64
        least = min([int(r["token"][1:]) for r in head.collect()], default=65)
        assert all(int(r["token"][1:]) < least for r in tail.collect())
    assert V._split_by_count(known, 1200)[0].count() == 33  # 32 to 64


def test_only_tokens_that_may_be_listed_are_joined(spark):
    entries = spark.range(5000).select(F.concat(F.lit("t"), "id").alias("token"))
    places = V._may_be_listed(entries)
    docs = spark.range(20000).select(F.array(F.lit("no"), F.concat(F.lit("t"), "id")).alias("w"))
    found = docs.select("w", places("w").alias("p")).collect()
    assert all(1 in r["p"] for r in found if int(r["w"][1][1:]) < 5000)
    assert sum(len(r["p"]) for r in found) < 5000 + 0.1 * 35000
