"""Training, saving, scoring and streaming on the small conversations."""

from __future__ import annotations

import json
import pathlib

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textstyle import streaming as X
from textstyle.catalog.learning import turns
from textstyle.functions import profiles as P
from textstyle.operators.features import stylometric_features
from textstyle.plans import learning as L
from textstyle.plans.preprocess import load_and_preprocess, preprocess
from textstyle.sources.models import load_model, model_path, save_models
from textstyle.sources.tables import write_table

SMALL = L.Grid(max_iter=5, trees=(3, 5), depths=(2,), svm_regs=(0.01, 0.1))


@pytest.fixture(scope="module")
def chats(spark, sf_dir):
    return turns(spark, sf_dir)


@pytest.fixture(scope="module")
def run(chats):
    return L.train_all(chats, "conv_id", grid=SMALL)


def test_report_has_every_model_and_split(run):
    rows = {(r["model"], r["split"]) for r in run.metrics.collect()}
    assert rows == {(m, s) for m in L.TRAINERS for s in ("validation", "test")}
    board = L.model_leaderboard(run.metrics).collect()
    assert board[0]["model"] == run.best_name
    for row in run.metrics.collect():
        assert row["recall"] == pytest.approx(row["accuracy"])


def test_split_keeps_conversations_together(run):
    seen = [
        {r["conv_id"] for r in part.select("conv_id").distinct().collect()}
        for part in run.splits.values()
    ]
    assert not (seen[0] & seen[1] or seen[0] & seen[2] or seen[1] & seen[2])


def test_vocabulary_comes_from_training_rows_only(run, spark):
    train_words = set()
    for row in run.splits["train"].select("abstract_clean").collect():
        train_words.update(row["abstract_clean"].split())
    assert set(run.models[L.LOGISTIC].stages[1].vocabulary) <= train_words


def test_scores_exist_without_probability(run, chats):
    svm = L.score(chats, run.models[L.SVM])
    assert "probability" not in svm.columns and svm.filter("score is null").count() == 0
    logistic = L.score(chats, run.models[L.LOGISTIC])
    assert dict(logistic.dtypes)["probability"] == "array<double>"
    assert len(L.sample_predictions(logistic, ["conv_id", "turn"], 3).collect()) == 3


def test_save_and_load(run, chats, tmp_path):
    assert model_path("m", "Linear SVM") == "m/linear_svm"
    for _ in range(2):  # saving again replaces
        save_models(run.models, str(tmp_path))
    loaded = load_model(str(tmp_path), L.FOREST)
    ours = L.score(chats, run.models[L.FOREST]).select("conv_id", "turn", "prediction", "score")
    theirs = L.score(chats, loaded).select("conv_id", "turn", "prediction", "score")
    assert ours.exceptAll(theirs).count() == 0


def test_null_text_scores(run, spark):
    rows = spark.createDataFrame([(None,), ("x",)], "abstract_clean string")
    assert L.score(rows, run.best_model).count() == 2
    guarded = rows
    for stage in L.mllib_token_stages():
        guarded = stage.transform(guarded)
    assert guarded.select(F.size("words_tfidf")).count() == 2


def test_hashing_features_have_the_asked_width(chats):
    vectors = L.fit_hashing_tfidf(chats, buckets=64).transform(chats)
    assert vectors.select(F.size(vector_to_array(L.TFIDF)).alias("n")).first()["n"] == 64


def test_throughput(run, chats):
    runs = L.scoring_throughput(chats, run.best_model, runs=2)
    assert [r["run"] for r in runs.collect()] == [1, 2]
    row = L.throughput_summary(runs).first()
    assert row["min_seconds"] <= row["mean_seconds"] <= row["max_seconds"]


# --- preprocessing jobs --------------------------------------------------------------


def test_preprocess_columns_and_null(spark):
    rows = spark.createDataFrame([("والمدرسة في http://a.b مكتوب",), (None,)], "text string")
    for profile in P.PROFILES.values():
        done = preprocess(rows, profile=profile, stopwords=["في"])
        assert done.columns == [
            "text", "text_clean", "words", "words_no_stopwords", "words_stemmed",
            "abstract_clean",
        ]
        values = [r["abstract_clean"] for r in done.collect()]
        assert values[1] == ""
        assert values[0] == ("درس كتب" if profile is P.WEB else "درس http://a.b كتب")


def test_stopwords_as_listed_cannot_match_normalised_text(spark):
    rows = spark.createDataFrame([("إلى مكتوب",)], "text string")
    for folded, expected in ((True, "كتب"), (False, "الي كتب")):
        done = preprocess(rows, stopwords=["إلى"], normalize_stopwords=folded)
        assert done.first()["abstract_clean"] == expected


def test_supplied_dictionary(spark):
    rows = spark.createDataFrame([(1, "مكتوب غريب")], "id int, text string")
    stems = spark.createDataFrame([("مكتوب", "جذر")], "token string, stem string")
    done = preprocess(rows, stopwords=[], dictionary=stems)
    assert done.first()["abstract_clean"] == "جذر غريب"
    with pytest.raises(TypeError):
        preprocess(rows)  # the list of stopwords is the caller's


def test_load_and_preprocess(spark, tmp_path):
    rows = spark.createDataFrame([("مكتوب", 1)], "text string, label int")
    write_table(rows, str(tmp_path / "in"))
    done = load_and_preprocess(spark, str(tmp_path / "in"), str(tmp_path / "out"), stopwords=[])
    assert done.select("text", "abstract_clean", "label").first() == ("مكتوب", "كتب", 1)


def test_no_python_and_no_shuffle_in_the_hot_path(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    frame = stylometric_features(preprocess(docs, profile=P.WEB, stopwords=["the"]))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Exchange", "ScalaUDF"):
        assert word not in plan


# --- streams ---------------------------------------------------------------------------


def _write_lines(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


OUT = "text string, label int, prediction double, score double, raw_line string, status string"


def test_bad_lines_are_quarantined_and_restart_adds_nothing(spark, run, tmp_path):
    good = json.dumps({"text": "t", "abstract_clean": "a b", "label": 1})
    _write_lines(tmp_path / "in", "1.json", [good, "not json", '{"text": "u"}'])
    out, marks = str(tmp_path / "out"), str(tmp_path / "marks")

    def run_once():
        stream = X.read_json_stream(spark, str(tmp_path / "in"))
        scored = X.score_stream(stream, run.models[L.LOGISTIC])
        query = X.write_json_stream(scored, out, marks, every=None, partition_by=["status"])
        X.drain(query)
        return spark.read.schema(OUT).json(out)

    rows = run_once()
    kept = {(r["status"], r["text"]): r for r in rows.collect()}
    assert set(kept) == {("scored", "t"), ("quarantined", "u"), ("quarantined", None)}
    assert kept[("quarantined", None)]["raw_line"] == "not json"
    assert kept[("quarantined", "u")]["prediction"] is None
    assert kept[("scored", "t")]["prediction"] is not None
    assert run_once().count() == 3
    _write_lines(tmp_path / "in", "2.json", [good])
    assert run_once().count() == 4


def test_stream_equals_batch(spark, run, chats, tmp_path):
    path = str(tmp_path / "in")
    X.write_micro_batches(chats, path, ["conv_id", "turn"], F.expr("conv_id + turn / (turn + 1)"), 20)
    stream = X.read_json_stream(spark, path, chats.schema, files_per_trigger=3)
    scored = X.score_stream(stream, run.best_model).select("text", "label", "prediction")
    query = X.write_json_stream(scored, str(tmp_path / "out"), str(tmp_path / "m"), every=None)
    X.drain(query)
    back = spark.read.schema("text string, label int, prediction double").json(str(tmp_path / "out"))
    batch = L.score(chats, run.best_model).select("text", "label", "prediction")
    assert back.exceptAll(batch).count() == 0 and back.count() == batch.count()


def test_stream_preprocesses_raw_text(spark, run, tmp_path):
    _write_lines(tmp_path / "in", "1.json", ['{"text": "مكتوب", "label": 0}'])
    schema = StructType.fromDDL("text string, label int")
    stream = X.read_json_stream(spark, str(tmp_path / "in"), schema)
    scored = X.score_stream(stream, run.best_model, lambda df: preprocess(df, stopwords=[]))
    query = X.write_json_stream(scored, str(tmp_path / "out"), str(tmp_path / "m"), every=None)
    X.drain(query)
    assert spark.read.json(str(tmp_path / "out")).first()["status"] == "scored"


def test_timed_trigger_stops(spark, tmp_path):
    _write_lines(tmp_path / "in", "1.json", ['{"text": "t"}'])
    stream = X.read_json_stream(spark, str(tmp_path / "in"))
    query = X.write_json_stream(stream, str(tmp_path / "out"), str(tmp_path / "m"), every="1 second")
    assert X.run_for(query, 4) is False and not query.isActive


def test_a_sink_that_is_not_complete_is_never_read(spark, tmp_path):
    for k in range(20):
        _write_lines(tmp_path / "in", f"{k}.json", ['{"text": "t"}'])
    slow = X.read_json_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    query = X.write_json_stream(slow, str(tmp_path / "out"), str(tmp_path / "m"), every=None)
    with pytest.raises(TimeoutError):
        X.drain(query, 0.01)
    assert not query.isActive
    query = X.write_json_stream(slow, str(tmp_path / "out"), str(tmp_path / "m"), every=None)
    X.drain(query)
    assert spark.read.json(str(tmp_path / "out")).count() == 20


def test_search_keeps_groups_whole(spark):
    rows = spark.range(300).withColumn("g", F.col("id") % 20)
    parts = rows.withColumn("inner", L.inner_split(F.col("g"), L.Grid()))
    sides = parts.groupBy("g").agg(F.countDistinct("inner").alias("n"))
    assert sides.filter("n > 1").count() == 0
    assert parts.select("inner").distinct().count() == 2


def test_training_reads_its_source_once(spark, chats, tmp_path):
    counted = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    source = chats.mapInArrow(seen, chats.schema)
    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    trained = L.train_all(source, "conv_id", names=[L.LOGISTIC], grid=L.Grid(max_iter=2))
    assert counted.value == chats.count()
    left = {p.name.rsplit("-", 1)[0] for p in set(shared.iterdir()) - before}
    assert left == {"split-rows", "metrics"}
    trained.close()
    assert set(shared.iterdir()) == before


def test_scoring_all_models_at_once_equals_one_by_one(run, chats):
    keys = ("conv_id", "turn")
    together = L.score_models(chats, run.models, *keys)
    for name, model in run.models.items():
        alone = L.score(chats, model).select(*keys, "prediction", "score")
        mine = together.filter(F.col("model") == name).drop("model")
        assert mine.exceptAll(alone).count() == 0 and mine.count() == alone.count()
    plan = together._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


@pytest.mark.parametrize("storage, side_by_side", [(1 << 40, 3), (10, 1)])
def test_forests_side_by_side_fit_in_memory(spark, monkeypatch, storage, side_by_side):
    """Each fit keeps a bin of every feature of every row: 4 * 3 * 4 bytes here."""
    monkeypatch.setattr(L, "storage_bytes", lambda context: storage)
    pools, pool = [], L.ThreadPoolExecutor
    monkeypatch.setattr(L, "ThreadPoolExecutor", lambda n: pools.append(n) or pool(n))
    rows = [(Vectors.dense(i, 1.0, 0.0), i % 2, i < 2) for i in range(4)]
    train = spark.createDataFrame(rows, [L.TFIDF, "label", L.INNER])
    grid = L.Grid(trees=(2, 3), depths=(1,), parallelism=3)
    tried = []
    L.train_random_forest(train, grid, tried=tried)
    assert pools == [side_by_side] and len(tried) == 2


def test_storage_of_executors(spark):
    heap = spark._jvm.java.lang.Runtime.getRuntime().maxMemory()
    assert 0 < L.storage_bytes(spark.sparkContext) < heap
    assert L.fits_at_a_time(4, 0, 0) == 4  # nothing is kept
    assert L.fits_at_a_time(4, 40, 100) == 2 and L.fits_at_a_time(4, 200, 100) == 1
