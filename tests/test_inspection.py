"""Fitted models by relational means, the search beside, and saved versions."""

from __future__ import annotations

import json
import pathlib
import subprocess
import sys
import threading

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from textstyle.catalog.learning import turns
from textstyle.plans import inspection as I
from textstyle.plans import learning as L
from textstyle.sources import models as M

KEYS = ["conv_id", "turn"]
SMALL = L.Grid(max_iter=40, trees=(2, 3), depths=(2, 4), svm_regs=(0.01, 0.1))


@pytest.fixture(scope="module")
def chats(spark, sf_dir):
    return turns(spark, sf_dir).cache()


@pytest.fixture(scope="module")
def run(chats):
    return L.train_all(chats, "conv_id", grid=SMALL)


def test_forest_walk_is_the_forest(spark, run, chats):
    model = run.models[L.FOREST]
    nodes = I.forest_nodes(spark, model.stages[-1]).cache()
    odd = spark.createDataFrame([(-1, 0, ""), (-2, 0, None), (-3, 0, "zzz unknown")], "conv_id bigint, turn bigint, abstract_clean string")
    rows = chats.select(*KEYS, "abstract_clean").unionByName(odd)
    ours = I.forest_probabilities(rows, KEYS, model, nodes)
    theirs = L.score(rows, model).select(*KEYS, F.col("probability").alias("p"))
    both = ours.join(theirs, KEYS).collect()
    assert len(both) == rows.count()
    assert max(abs(r["p"][1] - r["probability"][1]) for r in both) < 1e-12
    leaves = I.forest_leaves(rows, KEYS, model, nodes)
    trees = len(model.stages[-1].trees)
    assert leaves.count() == trees * rows.count()
    inner = nodes.filter("threshold IS NOT NULL").select("tree", "node")
    assert leaves.join(inner, ["tree", "node"]).isEmpty()
    used = I.feature_use(nodes, I.vocabulary_table(spark, model), 3).collect()
    assert len(used) == 3 and all(1 <= r["trees"] <= trees for r in used)


def test_large_node_tables_are_merged(spark, run, chats, monkeypatch):
    model = run.models[L.FOREST]
    nodes = I.forest_nodes(spark, model.stages[-1]).cache()
    few = chats.filter("conv_id < 5")
    small = I.forest_probabilities(few, KEYS, model, nodes).collect()
    monkeypatch.setattr(I, "fits_broadcast", lambda df: False)
    large = I.forest_probabilities(few, KEYS, model, nodes)
    assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
    assert {(r[0], r[1], round(r[2][1], 12)) for r in large.collect()} == {
        (r[0], r[1], round(r[2][1], 12)) for r in small
    }


@pytest.mark.parametrize("name,loss", [(L.LOGISTIC, "logistic"), (L.SVM, "hinge")])
def test_optimality_is_the_gradient(run, name, loss):
    """The norms against dense arithmetic, and worse ones for weights moved away."""
    model, train = run.models[name], run.splits["train"]
    found = I.optimality(train, KEYS, model, loss).first()
    linear = model.stages[-1]
    rows = model.transform(train).select("label", L.TFIDF).collect()
    x = np.array([r[L.TFIDF].toArray() for r in rows])
    y = np.array([r["label"] for r in rows], float)
    deviation = x.std(axis=0, ddof=1)
    x, w = x[:, deviation > 0], linear.coefficients.toArray()[deviation > 0]
    deviation = deviation[deviation > 0]

    def norm(weights):
        margin = x @ weights + linear.intercept
        side = 2 * y - 1
        slope = 1 / (1 + np.exp(-margin)) - y if loss == "logistic" else np.where(side * margin < 1, -side, 0)
        pull = x.T @ slope / len(y) / deviation + linear.getRegParam() * weights * deviation
        return np.sqrt((pull**2).sum() + slope.mean() ** 2)

    assert (found["n_rows"], found["n_features"]) == x.shape
    assert found["gradient"] == pytest.approx(norm(w), rel=1e-6, abs=1e-9)
    assert found["start"] == pytest.approx(norm(0 * w), rel=1e-9)
    # Rows on the hinge's kink keep its subgradient from vanishing.
    assert found["gradient"] < {"logistic": 1e-5, "hinge": 0.1}[loss] * found["start"]


def test_optimality_of_no_rows(run, chats):
    found = I.optimality(chats.filter("false"), KEYS, run.models[L.LOGISTIC], "logistic").first()
    assert (found["n_rows"], found["n_features"], found["gradient"]) == (0, 0, 0.0)


def test_every_grid_point_is_kept(run):
    tried = run.searches()
    assert tried.groupBy("model").count().orderBy("model").collect() == [(L.SVM, 2), (L.FOREST, 4)]
    for name in (L.SVM, L.FOREST):
        own = run.tried[name]
        assert [t.chosen for t in own] == [k == [t.f1 for t in own].index(max(t.f1 for t in own)) for k in range(len(own))]
        assert len({t.params for t in own}) == len(own) and all(t.seconds > 0 for t in own)
    assert run.tried[L.LOGISTIC] == []


def test_winner_does_not_depend_on_parallelism(spark, chats):
    features = L.fit_tfidf(chats)
    found = {}
    for n in (1, 4):
        tried: dict = {}
        grid = L.Grid(max_iter=3, svm_regs=(0.01, 0.1, 1.0), parallelism=n)
        model = L.train_models(chats, features, [L.SVM], grid, group_key="conv_id", tried=tried)[L.SVM]
        found[n] = ([(t.params, t.f1, t.chosen) for t in tried[L.SVM]], model.stages[-1].getRegParam())
    assert found[1] == found[4]


OVERLAP = """
import sys
sys.path.insert(0, sys.argv[1])
from textstyle.catalog.learning import turns
from textstyle.plans import learning as L
from textstyle.session import get_session
spark = get_session("overlap", "2g", "local[4]", spark__ui__enabled="false",
                    spark__sql__shuffle__partitions="4", spark__eventLog__enabled="true",
                    spark__eventLog__dir=sys.argv[2], spark__eventLog__rolling__enabled="false",
                    spark__eventLog__compress="false")
rows = turns(spark, "/root/testdata/sf0.001")
L.train_models(rows, L.fit_tfidf(rows), [L.SVM], L.Grid(max_iter=8), group_key="conv_id")
spark.stop()
"""


def test_grid_points_run_next_to_each_other(tmp_path):
    """Jobs of two pools overlap in time, by Spark's event log."""
    root = str(pathlib.Path(L.__file__).parents[2])
    script = [sys.executable, "-c", OVERLAP, root, str(tmp_path)]
    subprocess.run(script, check=True, timeout=240, capture_output=True)
    spans: dict[str, list[float]] = {}
    jobs: dict[int, str] = {}
    for line in next(p for p in tmp_path.iterdir() if p.is_file() and not p.name.startswith(".")).read_text().splitlines():
        event = json.loads(line)
        if event["Event"] == "SparkListenerJobStart":
            pool = event["Properties"].get("spark.scheduler.pool", "")
            if pool.startswith("grid-"):
                jobs[event["Job ID"]] = pool
                spans.setdefault(pool, []).append(event["Submission Time"])
        elif event["Event"] == "SparkListenerJobEnd" and event["Job ID"] in jobs:
            spans[jobs[event["Job ID"]]].append(event["Completion Time"])
    assert set(spans) == {"grid-0", "grid-1"}
    (a, b), (c, d) = [(min(x), max(x)) for x in spans.values()]
    assert max(a, c) < min(b, d)


def test_report_is_one_file(spark, chats, tmp_path):
    path = tmp_path / "report"
    run = L.train_all(chats, "conv_id", names=[L.LOGISTIC], grid=L.Grid(max_iter=2), report=str(path))
    files = list(path.glob("*.csv"))
    assert len(files) == 1
    lines = files[0].read_text().splitlines()
    assert lines[0] == "model,split,n,accuracy,f1,precision,recall,roc_auc"
    assert [x.split(",")[1] for x in lines[1:]] == ["test", "validation"]
    run.close()


# --- versions -----------------------------------------------------------------------


def test_versions(run, tmp_path):
    path = M.model_path(str(tmp_path), L.LOGISTIC)
    with pytest.raises(FileNotFoundError):
        M.current_version(path)
    saved = [M.save_model(run.models[L.LOGISTIC], path) for _ in range(4)]
    assert M.current_version(path) == saved[-1]
    left = {p.name for p in pathlib.Path(path, "versions").iterdir()}
    assert left == {s.rsplit("/", 1)[1] for s in saved[-2:]}
    # What a save that died left behind changes nothing.
    pathlib.Path(path, "versions", "half").mkdir()
    assert M.current_version(path) == saved[-1]
    assert M.load_model(str(tmp_path), L.LOGISTIC).stages[-1].intercept == run.models[L.LOGISTIC].stages[-1].intercept


def test_readers_never_see_half_a_model(run, tmp_path):
    """A reader beside a writer gets one of the two models, whole, every time."""
    two = [run.models[L.LOGISTIC], run.models[L.SVM]]
    path, stop, failed = M.model_path(str(tmp_path), "either"), threading.Event(), []
    M.save_model(two[0], path)

    def write():
        for k in range(6):
            M.save_model(two[(k + 1) % 2], path)
        stop.set()

    writer = threading.Thread(target=write)
    writer.start()
    seen = set()
    while not stop.is_set() or not seen:
        model = M.load_model(str(tmp_path), "either")
        assert isinstance(model, PipelineModel)
        seen.add(round(model.stages[-1].intercept, 9))
        failed += [model] if len(model.stages) != len(two[0].stages) else []
    writer.join()
    assert not failed and seen <= {round(m.stages[-1].intercept, 9) for m in two}
