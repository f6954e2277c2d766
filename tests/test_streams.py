"""Progress, restarts and numbered batch files of streams."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

import textstyle.streaming as X
from textstyle.operators.ordering import aligned_ranges


def files_of(folder) -> list[list[dict]]:
    found = [[json.loads(x) for x in p.read_text().splitlines()] for p in folder.glob("*.json")]
    return sorted(found, key=lambda rows: rows[0]["batch_id"])


@pytest.mark.parametrize("n,size,ranges", [(105, 50, 4), (103, 7, 9), (40, 100, 3), (60, 1, 8), (3, 2, 8)])
def test_every_file_is_one_batch(spark, tmp_path, n, size, ranges):
    # Many rows share a spread, and some have none.
    rows = spark.range(n).select(
        F.when(F.col("id") > 2, F.floor(F.col("id") / 11)).alias("a"), F.col("id").alias("b")
    )
    X.write_micro_batches(rows.repartition(5), str(tmp_path / "b"), ["a", "b"], F.col("a"), size, ranges)
    files = files_of(tmp_path / "b")
    assert [r["b"] for rows in files for r in rows] == list(range(n))
    assert [len(rows) for rows in files] == [size] * (n // size) + [n % size] * (n % size > 0)
    assert [{r["batch_id"] for r in rows} for rows in files] == [{k + 1} for k in range(len(files))]
    assert not [p for p in (tmp_path / "b").iterdir() if p.is_dir()]


def test_no_rows_no_batches(spark, tmp_path):
    X.write_micro_batches(spark.range(0), str(tmp_path / "b"), ["id"], F.col("id"), 50)
    assert not any(p.read_text() for p in (tmp_path / "b").glob("part-*.json"))


def test_wide_rows_are_shuffled_once(spark):
    rows = spark.range(1000).select("id", F.lit("wide").alias("text"))
    plan = aligned_ranges(rows, ["id"], F.col("id"), 50, 4)
    assert "Exchange hashpartitioning" not in plan._jdf.queryExecution().executedPlan().toString()
    sizes = plan.groupBy("_range", "_first").count().orderBy("_first").collect()
    assert [r["_first"] for r in sizes] == [1 + sum(s["count"] for s in sizes[:k]) for k in range(len(sizes))]
    assert all(r["count"] % 50 == 0 for r in sizes[:-1]) and len(sizes) > 1


def feed(folder, k: int, n: int = 3) -> None:
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"text": f"{k}-{i}"}) for i in range(n)]
    (folder / f"{k}.json").write_text("\n".join(lines) + "\n")


def start(spark, tmp_path, change=lambda s: s, every=None):
    stream = X.read_json_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    return X.write_json_stream(change(stream), str(tmp_path / "out"), str(tmp_path / "m"), every=every)


def texts(spark, tmp_path) -> list[str]:
    return sorted(r["text"] for r in spark.read.schema("text string").json(str(tmp_path / "out")).collect())


def test_progress_of_every_trigger(spark, tmp_path):
    for k in range(4):
        feed(tmp_path / "in", k, k + 1)
    table = X.ProgressTable(spark, str(tmp_path / "progress"))
    query = start(spark, tmp_path)
    assert X.follow(query, table) is True
    done = X.batches(table.read())
    assert sorted(r["input_rows"] for r in done.collect()) == [1, 2, 3, 4]
    assert done.filter("trigger_ms <= 0 or processed_rows_per_second <= 0").isEmpty()
    total = X.progress_summary(table.read()).first()
    assert (total["batches"], total["rows"], total["largest_batch"]) == (4, 10, 4)
    assert total["slowest_ms"] >= total["median_ms"] > 0 and total["rows_per_second"] > 0
    assert [r["missed"] for r in X.missed_batches(table.read()).collect()] == [0]
    assert table.record(query) == 0  # nothing twice
    # A batch left out is noticed.
    gap = table.read().filter("batch_id <> 1")
    assert [r["missed"] for r in X.missed_batches(gap).collect()] == [1]


@pytest.mark.parametrize("n,size,files", [(103, 7, 4), (20, 5, 2), (0, 5, 2)])
def test_folders_hold_whole_batches_in_order(spark, tmp_path, n, size, files):
    rows = spark.range(n).select(F.floor(F.col("id") / 11).alias("a"), F.col("id").alias("b"))
    X.write_micro_batches(
        rows.repartition(5), str(tmp_path / "b"), ["a", "b"], F.col("a"), size, 4, files_per_folder=files
    )
    folders = X.sub_folders(spark, str(tmp_path / "b"))
    parts = {int(f.rsplit("=", 1)[1]): files_of(tmp_path / "b" / f.rsplit("/", 1)[1]) for f in folders}
    batches = -(-n // size)
    assert {k: len(p) for k, p in parts.items()} == {
        k: min(files, batches - k * files) for k in range(-(-batches // files))
    }
    flat = [rows for k in sorted(parts) for rows in parts[k]]
    assert [r["b"] for rows in flat for r in rows] == list(range(n))
    assert all(len(rows) == size for rows in flat[: n // size])


def test_queries_next_to_each_other(spark, tmp_path):
    """Two run at a time, a third follows; every trigger of each is recorded once."""
    running, most = [], []

    def starter(name):
        def run():
            stream = X.read_json_stream(spark, str(tmp_path / name), files_per_trigger=1)
            query = X.write_json_stream(stream, str(tmp_path / f"o{name}"), str(tmp_path / f"m{name}"), every=None)
            running.append(query)
            most.append(sum(q.isActive for q in running))
            return query

        return run

    for name, files in (("a", 4), ("b", 3), ("c", 2)):
        for k in range(files):
            feed(tmp_path / name, k, k + 1)
    table = X.ProgressTable(spark, str(tmp_path / "progress"))
    X.follow_all([starter(n) for n in "abc"], table, at_a_time=2, every=0.5)
    done = X.batches(table.read()).groupBy("query_id").agg(F.sort_array(F.collect_list("input_rows")).alias("n"))
    assert sorted(r["n"] for r in done.collect()) == [[1, 2], [1, 2, 3], [1, 2, 3, 4]]
    assert {r["missed"] for r in X.missed_batches(table.read()).collect()} == {0}
    assert most[:2] == [1, 2] and max(most) == 2


def test_the_next_query_starts_before_the_last_is_recorded(spark, tmp_path):
    """Recording takes a job, and its cores should not wait for it."""
    happened = []

    class Noted(X.ProgressTable):
        def record(self, *queries):
            happened.append(("recorded", len(queries)))
            return super().record(*queries)

    def starter(name):
        def run():
            happened.append(("started", name))
            stream = X.read_json_stream(spark, str(tmp_path / name), files_per_trigger=1)
            return X.write_json_stream(stream, str(tmp_path / f"o{name}"), str(tmp_path / f"m{name}"), every=None)

        return run

    for name, files in (("a", 2), ("b", 3)):
        for k in range(files):
            feed(tmp_path / name, k, k + 1)
    table = Noted(spark, str(tmp_path / "progress"))
    X.follow_all([starter(n) for n in "ab"], table, at_a_time=1, every=600)
    assert happened == [("started", "a"), ("started", "b"), ("recorded", 1), ("recorded", 1)]
    done = X.batches(table.read()).groupBy("query_id").agg(F.sort_array(F.collect_list("input_rows")).alias("n"))
    assert sorted(r["n"] for r in done.collect()) == [[1, 2], [1, 2, 3]]


def test_quick_local_logs(spark, tmp_path):
    """Logs go through FileSystem meanwhile, rows come once, and the setting is put back."""
    package = spark._jvm.org.apache.spark.sql.execution.streaming.checkpointing
    at = spark._jvm.org.apache.hadoop.fs.Path(str(tmp_path))

    def manager():
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        return package.CheckpointFileManager.create(at, conf).getClass().getName().rsplit(".", 1)[1]

    before = manager()
    assert before != "FileSystemBasedCheckpointFileManager"
    for k in range(3):
        feed(tmp_path / "in", k)
    with X.quick_local_logs(spark, str(tmp_path)):
        assert manager() == "FileSystemBasedCheckpointFileManager"
        X.drain(start(spark, tmp_path))
    assert manager() == before
    # A restart, with Spark's own choice, goes on with the same logs.
    assert X.lose_commit(spark, str(tmp_path / "m")) == 2
    feed(tmp_path / "in", 3)
    X.drain(start(spark, tmp_path))
    assert texts(spark, tmp_path) == sorted(f"{k}-{i}" for k in range(4) for i in range(3))
    key = "spark.sql.streaming.checkpointFileManagerClass"
    spark.conf.set(key, "chosen")
    try:
        with X.quick_local_logs(spark, str(tmp_path)):
            assert spark.conf.get(key) == "chosen"
        assert spark.conf.get(key) == "chosen"
    finally:
        spark.conf.unset(key)
    with pytest.raises(ZeroDivisionError), X.quick_local_logs(spark, str(tmp_path)):
        1 / 0
    assert manager() == before


def test_a_failure_among_others_is_raised(spark, tmp_path):
    for name in "ab":
        feed(tmp_path / name, 0)
    bad = lambda s: s.withColumn("x", F.raise_error(F.lit("drill")).cast("int"))

    def run(name, change):
        stream = change(X.read_json_stream(spark, str(tmp_path / name), files_per_trigger=1))
        return X.write_json_stream(stream, str(tmp_path / f"o{name}"), str(tmp_path / f"m{name}"), every=None)

    table = X.ProgressTable(spark, str(tmp_path / "progress"))
    with pytest.raises(StreamingQueryException):
        X.follow_all([lambda: run("a", lambda s: s), lambda: run("b", bad)], table)
    assert X.batches(table.read()).count() <= 1 and not spark.streams.active


def test_timed_triggers_wait_and_a_stop_is_told_from_an_end(spark, tmp_path):
    for k in range(3):
        feed(tmp_path / "in", k)
    table = X.ProgressTable(spark, str(tmp_path / "progress"))
    query = start(spark, tmp_path, every="2 seconds")
    assert X.follow(query, table, seconds=9) is False and not query.isActive
    started = table.read().select(F.to_timestamp("started").cast("double").alias("t")).orderBy("t")
    at = [r["t"] for r in started.collect()]
    assert len(at) >= 3 and all(b - a > 1.5 for a, b in zip(at[1:], at[2:]))
    assert X.batches(table.read()).count() == 3


def test_failure_is_recorded_and_raised(spark, tmp_path):
    feed(tmp_path / "in", 0)
    table = X.ProgressTable(spark, str(tmp_path / "progress"))
    bad = lambda s: s.withColumn("x", F.raise_error(F.lit("drill")).cast("int"))
    with pytest.raises(StreamingQueryException):
        X.follow(start(spark, tmp_path, bad), table)
    assert X.unfinished_batches(spark, str(tmp_path / "m")) == [0]
    assert X.batches(table.read()).isEmpty()


@pytest.mark.parametrize("sink_knows", [True, False])
def test_every_row_once_after_a_crash(spark, tmp_path, sink_knows):
    """The batch is done again whether or not the sink had committed it."""
    marks = str(tmp_path / "m")
    for k in range(3):
        feed(tmp_path / "in", k)
    X.drain(start(spark, tmp_path))
    assert X.unfinished_batches(spark, marks) == []
    assert X.lose_commit(spark, marks) == 2
    assert X.unfinished_batches(spark, marks) == [2]
    if not sink_knows:  # its files are there, but not in its log: orphans
        for path in (tmp_path / "out" / "_spark_metadata").glob("*2*"):
            path.unlink()
        assert len(texts(spark, tmp_path)) == 6
    feed(tmp_path / "in", 3)  # arrives before the restart
    X.drain(start(spark, tmp_path))
    assert texts(spark, tmp_path) == sorted(f"{k}-{i}" for k in range(4) for i in range(3))
    assert X.unfinished_batches(spark, marks) == []


def test_nothing_to_lose(spark, tmp_path):
    assert X.lose_commit(spark, str(tmp_path / "none")) is None
    assert X.unfinished_batches(spark, str(tmp_path / "none")) == []
