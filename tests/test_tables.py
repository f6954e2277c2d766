"""Sources, reshaping, quality, sampling, splitting, numbering."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textstyle.operators import ordering as O
from textstyle.operators import quality as Q
from textstyle.operators import reshape as R
from textstyle.session import shared_folder, write_through
from textstyle.sources import tables as IO


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError, match="Unsupported format: xml"):
        IO.read_table(spark, str(tmp_path), "xml")
    with pytest.raises(ValueError, match="Unsupported format: xml"):
        IO.write_table(spark.range(1), str(tmp_path), "xml")


@pytest.mark.parametrize("fmt", IO.FORMATS)
def test_round_trip(spark, tmp_path, fmt):
    rows = [("a, \"b\"", "1"), ("س", "2"), (" x ", None)]
    df = spark.createDataFrame(rows, "text string, n string")
    path = str(tmp_path / fmt)
    IO.write_table(df, path, fmt)
    back = IO.read_table(spark, path, fmt, df.schema).select("text", "n")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_single_file_report(spark, tmp_path):
    path = str(tmp_path / "report")
    IO.write_table(spark.range(100).repartition(5), path, "csv", single_file=True)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1


def test_malformed_json_is_kept(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"text": "a"}\nnot json\n')
    schema = StructType.fromDDL("text string")
    rows = IO.read_json_lines(spark, str(tmp_path), schema).collect()
    assert sorted((r["text"], r["_corrupt_record"]) for r in rows if r["text"]) == [("a", None)]
    assert [r["_corrupt_record"] for r in rows if not r["text"]] == ["not json"]


def test_shared_folder_is_the_configured_one(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark, "x").startswith(f"{base}/x-")
    assert shared_folder(spark, "x") != shared_folder(spark, "x")
    assert write_through(spark.range(3), "y").count() == 3


def test_splits_are_tagged_and_verified(spark, tmp_path):
    splits = {"one": spark.range(2), "two": spark.range(3)}
    paths = IO.ingest_splits(splits, str(tmp_path))
    back = {name: IO.read_table(spark, path) for name, path in paths.items()}
    rows = {tuple(r) for r in IO.verify_splits(back).collect()}
    assert rows == {("one", 2, 1), ("two", 3, 1)}
    assert R.combine_splits(back).filter("source = 'two'").count() == 3
    assert IO.read_splits(spark, str(tmp_path)).groupBy("source").count().count() == 2


def test_wide_to_long_keeps_missing_texts_in_one_scan(spark, tmp_path):
    wide = spark.createDataFrame(
        [(1, "h", "a", None)], "id int, human string, m1 string, m2 string"
    )
    path = str(tmp_path / "wide")
    IO.write_table(wide, path)
    long = R.wide_to_long(IO.read_table(spark, path), "human", ["m1", "m2"], ["id"])
    rows = {(r["generator"], r["text"], r["label"]) for r in long.collect()}
    assert rows == {("human", "h", 0), ("m1", "a", 1), ("m2", None, 1)}
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_quality_report(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [tuple(r) for r in Q.quality_report(df).collect()] == [
        ("a", "int", 0, 2),
        ("b", "string", 1, 2),
    ]
    assert tuple(Q.table_shape(df).first()) == (2, 2)


def test_explode_drops_empty_and_null(spark):
    df = spark.createDataFrame([(1, ["a", "a"]), (2, []), (3, None)], "id int, w array<string>")
    rows = R.explode_tokens(df, F.col("w"), "word", "id").collect()
    assert [tuple(r) for r in rows] == [(1, "a"), (1, "a")]


def test_hash_split_is_a_stable_partition_of_groups(spark):
    df = spark.range(5000).withColumn("family", (F.col("id") / 5).cast("long"))
    tagged = O.assign_split(df, "family")
    counts = {r["split"]: r["count"] for r in tagged.groupBy("split").count().collect()}
    assert sum(counts.values()) == 5000 and set(counts) == {"train", "validation", "test"}
    assert 3200 < counts["train"] < 3800
    spread = tagged.groupBy("family").agg(F.countDistinct("split").alias("n"))
    assert spread.filter("n > 1").count() == 0
    again = O.assign_split(df.repartition(7), "family")
    assert tagged.exceptAll(again).count() == 0
    with pytest.raises(ValueError):
        O.assign_split(df, "family", {"train": 70, "test": 20})


def test_sample_per_class_with_a_hot_class(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 10 < 9, 0).otherwise(1).alias("label"))
    got = O.sample_per_class(df, 300, "id", [0, 1])
    want = []
    for label in (0, 1):
        rows = df.filter(F.col("label") == label)
        want += [r["id"] for r in rows.orderBy(F.md5(F.col("id").cast("string"))).limit(300).collect()]
    assert sorted(r["id"] for r in got.collect()) == sorted(want)
    assert got.columns == ["label", "id"] or set(got.columns) == {"label", "id"}


def test_sample_beyond_the_group_limit(spark):
    df = spark.range(20_000).withColumn("label", F.lit(1))
    want = df.orderBy(F.md5(F.col("id").cast("string"))).limit(1500)
    got = O.sample_per_class(df, 1500, "id", [1]).select("id")
    assert got.exceptAll(want.select("id")).count() == 0 and got.count() == 1500


def test_sample_smaller_class_is_whole(spark):
    df = spark.range(50).withColumn("label", F.lit(1))
    assert O.sample_per_class(df, 300, "id", [0, 1]).count() == 50


def test_sample_of_copies_under_one_key(spark):
    df = spark.range(1000).select(F.lit("same").alias("key"), F.lit(0).alias("label"))
    assert O.sample_per_class(df, 10, "key", [0]).count() == 10


def test_first_rows(spark):
    df = spark.range(1000).withColumn("text", F.lit("x")).repartition(5)
    assert [r["id"] for r in O.first_rows(df, 7, "id").collect()] == list(range(7))


@pytest.mark.parametrize("ways", [None, (), (4096, 64)])
def test_top_per_group(spark, ways):
    df = spark.range(10_000).select((F.col("id") % 2).alias("g"), "id")
    top = O.top_per_group(df, ["g"], [F.desc("id")], 3, spread=F.col("id"), ways=ways)
    rows = sorted((r["g"], r["rank"], r["id"]) for r in top.collect())
    assert rows == [(0, 1, 9998), (0, 2, 9996), (0, 3, 9994), (1, 1, 9999), (1, 2, 9997), (1, 3, 9995)]


def test_null_keys_come_first(spark):
    rows = spark.createDataFrame([(None, "a"), (1, "b"), (2, "c"), (None, "d")], "id int, t string")
    for n in range(1, 5):
        got = [r["id"] for r in O.first_rows(rows, n, "id").collect()]
        assert got == [r["id"] for r in rows.orderBy("id").limit(n).collect()]
    tagged = rows.withColumn("label", F.lit(0))
    for n in range(1, 5):
        assert O.sample_per_class(tagged, n, "id", [0]).count() == n
    keyed = spark.createDataFrame([(None,), (5,), (1,)], "k int")
    numbers = {r["k"]: r["row_number"] for r in O.number_rows(keyed, ["k"], F.col("k")).collect()}
    assert numbers == {None: 1, 1: 2, 5: 3}


def test_ranges_follow_the_rows():
    assert O.range_count(0) == 8 and O.range_count(50_000_000) == 100
    assert O.range_count(10**12) == 2000


def test_number_rows_matches_a_global_window(spark):
    df = spark.range(3000).select((F.col("id") % 7).alias("a"), F.col("id").alias("b")).repartition(6)
    numbered = O.number_rows(df, ["a", "b"], F.expr("a + b / (b + 1)"), ranges=11)
    rows = sorted((r["a"], r["b"], r["row_number"]) for r in numbered.collect())
    assert [r[2] for r in rows] == list(range(1, 3001))


def test_ranked_and_best(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.9)], "model string, f1 double")
    ranks = {r["model"]: r["rank"] for r in O.ranked(df, "f1", "model").collect()}
    assert ranks == {"c": 1, "a": 2, "b": 3}
    assert O.best(df, "f1", "model").first()["model"] == "c"
    assert [r["model"] for r in O.leaderboard(df, "f1", "model").collect()] == ["c", "a", "b"]
