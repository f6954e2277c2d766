from __future__ import annotations

import corpus_pipeline as P
from pyspark.sql import functions as F


def test_stages_keep_clean_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = docs
    for _, stage in P.STAGES[:-1]:
        after = stage(spark, kept, sf_dir).cache()
        assert after.columns == docs.columns
        assert after.join(kept, "doc_id", "left_anti").count() == 0
        kept = after
    packed = P.STAGES[-1][1](spark, kept, sf_dir)
    ids = {r["doc_id"] for r in kept.collect()}
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == ids
    assert {r["doc_id"] for r in P.run(spark, sf_dir).select("doc_id").collect()} == ids
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").count()
    assert kept.count() > 0.5 * docs.count() and good > 0


def test_near_copies_keep_clashing_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)
    for name in ("key", "_near_key", "h", "component_id", "n_shingles"):
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    kept = P.one_of_each(spark, docs, sf_dir)
    assert kept.columns == docs.columns and kept.count() > 20
    assert kept.where("key <> concat('key', doc_id) OR h <> concat('h', doc_id)").isEmpty()
    assert kept.where("_near_key <> concat('_near_key', doc_id)").isEmpty()


def test_each_stage_decides(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = docs.where(F.col("doc_id") < 100)
    odd = [(9001, None), (9002, ""), (9003, "12 34 !!"), (None, "12")]
    odd = spark.createDataFrame([(i, t, None, "s", 0) for i, t in odd], docs.schema)
    spoken = P.known_language(spark, first.unionByName(odd), sf_dir)
    assert spoken.where("doc_id > 9000 or doc_id is null").count() == 0
    assert spoken.count() >= 0.97 * first.count()
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    clean = "Thas wore of the inging and tonder. " * 6
    rows = [(1, clean), (2, clean), (2, clean), (3, clean + "x"), (4, f"So {item} it is"), (None, "a b c d e")]
    small = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], docs.schema)
    one = {r["doc_id"]: r["text"] for r in P.one_of_each(spark, small, sf_dir).collect()}
    assert set(one) == {1, 4, None} or set(one) == {1, 3, 4, None}
    assert P.one_of_each(spark, small, sf_dir).count() == len(one)
    left = {r["doc_id"] for r in P.uncontaminated(spark, small, sf_dir).collect()}
    assert left == {1, 2, 3, None}
    for _, stage in P.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_near_copies_of_five_word_shingles(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    words = [[f"{name}{k}" for k in range(100)] for name in "abcd"]
    edited, appended, less = list(words[0]), words[1] + [f"e{k}" for k in range(20)], words[2] + [f"f{k}" for k in range(26)]
    edited[30], edited[70] = "x", "y"
    texts = [words[0], edited, words[1], appended, words[2], less, words[3]]  # 86/106, 96/116, 96/122
    docs = spark.createDataFrame([(k, " ".join(w), "en", "s", 0) for k, w in enumerate(texts)], schema)
    assert {r["doc_id"] for r in P.one_of_each(spark, docs, sf_dir).collect()} == {0, 2, 4, 5, 6}


def test_near_copies_without_id_or_with_one_id(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    words = [" ".join(f"{name}{k}" for k in range(100)) for name in "abcd"]
    rows = [(1, words[0]), (None, words[0] + " x"), (None, words[1]), (None, words[1] + " x"), (None, words[2])]
    rows += [(7, words[0] + " y"), (7, words[3]), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], schema)
    got = [(r["doc_id"], (r["text"] or "-")[:1]) for r in P.one_of_each(spark, docs, sf_dir).collect()]
    assert sorted(got, key=str) == sorted([(1, "a"), (None, "b"), (None, "c"), (7, "d"), (None, "-")], key=str)
