"""Training, tuning, evaluating and applying the three classifiers."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass, field

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    HashingTF,
    SQLTransformer,
    Tokenizer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textstyle.functions import text as T
from textstyle.operators.metrics import calculate_metrics
from textstyle.operators.ordering import assign_split, best, hash_slot, leaderboard
from textstyle.operators.terms import vocabulary
from textstyle.session import delete_folders, write_through
from textstyle.sources.tables import write_table

# Seed, column names and model names.
SEED = 42
CLEAN, WORDS, TF, TFIDF = "abstract_clean", "words_tfidf", "tf_features", "tfidf_features"
LOGISTIC, FOREST, SVM = "Logistic Regression", "Random Forest", "Linear SVM"


# --- text to vectors ------------------------------------------------------------------


def token_stage(clean_col: str = CLEAN) -> SQLTransformer:
    """Native tokenising as a pipeline stage; NULL text gives no tokens."""
    split = rf"split(lower(coalesce({clean_col}, '')), r'[\t-\r\x20]+')"
    return SQLTransformer(
        statement=f"SELECT *, array_remove({split}, '') AS {WORDS} FROM __THIS__"
    )


def mllib_token_stages(clean_col: str = CLEAN) -> list[Transformer]:
    """MLlib's own tokenizer behind a guard, since it fails on NULL text."""
    guard = SQLTransformer(
        statement=f"SELECT *, coalesce({clean_col}, '') AS _guarded FROM __THIS__"
    )
    return [guard, Tokenizer(inputCol="_guarded", outputCol=WORDS)]


def fit_tfidf(
    train: DataFrame,
    clean_col: str = CLEAN,
    vocab_size: int = 10_000,
    min_df: int = 2,
) -> PipelineModel:
    """Tokens, counts and IDF learned from training rows only.

    The vocabulary is built relationally with ties broken by term; at most
    ``vocab_size`` terms reach the driver.
    """
    tokens = token_stage(clean_col)
    vocab = vocabulary(train, T.tokenize(clean_col), vocab_size, min_df)
    terms = [row["term"] for row in vocab.orderBy("rank").collect()]
    counts = CountVectorizerModel.from_vocabulary(terms, inputCol=WORDS, outputCol=TF)
    idf = IDF(inputCol=TF, outputCol=TFIDF).fit(counts.transform(tokens.transform(train)))
    return PipelineModel([tokens, counts, idf])


def fit_hashing_tfidf(
    train: DataFrame, clean_col: str = CLEAN, buckets: int = 10_000
) -> PipelineModel:
    """Hashed term counts and IDF: no vocabulary to learn."""
    tokens = token_stage(clean_col)
    hashed = HashingTF(inputCol=WORDS, outputCol="raw_features", numFeatures=buckets)
    counted = hashed.transform(tokens.transform(train))
    idf = IDF(inputCol="raw_features", outputCol=TFIDF).fit(counted)
    return PipelineModel([tokens, hashed, idf])


# --- classifiers ------------------------------------------------------------------------


@dataclass(frozen=True)
class Grid:
    """Fixed values of the search; smaller ones are for trying things out."""

    max_iter: int = 30
    logistic_reg: float = 0.01
    trees: Sequence[int] = (50, 100)
    depths: Sequence[int] = (8, 12)
    svm_regs: Sequence[float] = (0.01, 0.1)
    train_ratio: float = 0.80
    parallelism: int = 4
    """Grid points fitted at a time, at most; the winner does not depend on it."""
    weight_col: str | None = None
    """Row weights for unbalanced classes, off by default."""

    def columns(self, label: str) -> dict:
        weights = {"weightCol": self.weight_col} if self.weight_col else {}
        return {"featuresCol": TFIDF, "labelCol": label, **weights}


def train_logistic_regression(
    train: DataFrame, grid: Grid = Grid(), label: str = "label", tried: list[Tried] | None = None
):
    """One fit; there is nothing to search for."""
    return LogisticRegression(
        maxIter=grid.max_iter,
        regParam=grid.logistic_reg,
        elasticNetParam=0.0,
        **grid.columns(label),
    ).fit(train)


#: Marks the training rows that the search fits on; it judges by the others.
INNER = "_inner"


@dataclass(frozen=True)
class Tried:
    """One grid point: its parameters, F1 on the rows not fitted on, and time."""

    params: str
    f1: float
    seconds: float
    chosen: bool


#: Share of the executors' storage that the rows of fits side by side may take.
FIT_STORAGE = 0.8


def storage_bytes(context: SparkContext) -> int:
    """Memory for stored blocks on all executors; the driver's counts if there are none."""
    status = context._jsc.sc().getExecutorMemoryStatus().values().iterator()
    sizes = []
    while status.hasNext():
        sizes.append(status.next()._1())
    sizes.sort()  # one is the driver's: the largest is left out
    return sum(sizes[:-1] or sizes)


def fits_at_a_time(most: int, kept_bytes: int, storage: int) -> int:
    """How many fits, each keeping ``kept_bytes``, run side by side: one at least."""
    fitting = int(FIT_STORAGE * storage) // kept_bytes if kept_bytes else most
    return max(1, min(most, fitting))


def _search(
    estimator,
    params,
    train: DataFrame,
    grid: Grid,
    label: str,
    tried: list[Tried] | None = None,
    kept_bytes: int = 0,
):
    """The parameters with the best F1 on whole groups not fitted on; ties to the first.

    Grid points are fitted next to each other, each in a scheduler pool of its
    own, so that small stages of one fill what another leaves idle; only as
    many as the executors hold, if a fit keeps ``kept_bytes`` of its own. What
    was tried is added to ``tried``.
    """
    fitted, judged = train.filter(INNER), train.filter(~F.col(INNER))
    if judged.isEmpty() or fitted.isEmpty():
        return estimator.fit(train, params[0])
    context = train.sparkSession.sparkContext

    def point(k: int) -> tuple[float, float]:
        context.setLocalProperty("spark.scheduler.pool", f"grid-{k}")
        f1 = MulticlassClassificationEvaluator(labelCol=label, metricName="f1")
        start = time.perf_counter()
        score = f1.evaluate(estimator.copy().fit(fitted, params[k]).transform(judged))
        return score, time.perf_counter() - start

    session = train.sparkSession
    at_a_time = fits_at_a_time(grid.parallelism, kept_bytes, storage_bytes(context))
    with ThreadPoolExecutor(at_a_time) as pool:
        # Each call copies this thread's properties; points must not share a copy.
        points = [
            pool.submit(inheritable_thread_target(session)(point), k) for k in range(len(params))
        ]
        results = [p.result() for p in points]
    scores = [score for score, _ in results]
    best_ = scores.index(max(scores))
    if tried is not None:
        for k, (score, seconds) in enumerate(results):
            shown = ", ".join(f"{p.name}={v}" for p, v in params[k].items())
            tried.append(Tried(shown, score, seconds, k == best_))
    return estimator.fit(train, params[best_])


def inner_split(group: Column, grid: Grid) -> Column:
    """Another hash than that of the outer split, so the two are unrelated."""
    slot = hash_slot(F.concat(F.lit("inner "), group.cast("string"))) % 100
    return F.coalesce(slot, F.lit(0)) < round(100 * grid.train_ratio)


def train_random_forest(
    train: DataFrame, grid: Grid = Grid(), label: str = "label", tried: list[Tried] | None = None
):
    forest = RandomForestClassifier(seed=SEED, **grid.columns(label))
    params = (
        ParamGridBuilder()
        .addGrid(forest.numTrees, list(grid.trees))
        .addGrid(forest.maxDepth, list(grid.depths))
        .build()
    )
    first = train.select(TFIDF).first()
    # Each fit keeps a bin, 4 bytes, of every feature of every row.
    kept = 4 * first[TFIDF].size * train.count() if first else 0
    return _search(forest, params, train, grid, label, tried, kept)


def train_linear_svm(
    train: DataFrame, grid: Grid = Grid(), label: str = "label", tried: list[Tried] | None = None
):
    svm = LinearSVC(maxIter=grid.max_iter, **grid.columns(label))
    params = ParamGridBuilder().addGrid(svm.regParam, list(grid.svm_regs)).build()
    return _search(svm, params, train, grid, label, tried)


TRAINERS = {
    LOGISTIC: train_logistic_regression,
    FOREST: train_random_forest,
    SVM: train_linear_svm,
}


def train_models(
    train: DataFrame,
    features: PipelineModel,
    names: Sequence[str] = tuple(TRAINERS),
    grid: Grid = Grid(),
    label: str = "label",
    group_key: Column | str = CLEAN,
    paths: list[str] | None = None,
    tried: dict[str, list[Tried]] | None = None,
) -> dict[str, PipelineModel]:
    """Fit each classifier; every result goes from clean text to prediction.

    The grid points of each model are added to ``tried``.

    The vectors are written once and read by all iterations, so neither text
    work nor a lost executor makes them be computed again. The search of
    parameters keeps rows that share ``group_key`` on one side, by default
    equal texts. Rows without label are left out.
    """
    group = F.col(group_key) if isinstance(group_key, str) else group_key
    kept = [TFIDF, label, *([grid.weight_col] if grid.weight_col else [])]
    rows = train.filter(F.col(label).isNotNull()).withColumn(INNER, inner_split(group, grid))
    vectors = write_through(features.transform(rows).select(*kept, INNER), "vectors", paths)
    tried = {} if tried is None else tried
    return {
        name: PipelineModel(
            [*features.stages, TRAINERS[name](vectors, grid, label, tried.setdefault(name, []))]
        )
        for name in names
    }


# --- scoring ------------------------------------------------------------------------------


def score(df: DataFrame, model: Transformer) -> DataFrame:
    """``prediction``, ``score`` and, if the model has one, ``probability``.

    ``score`` is the ranking value of class 1 and exists for every classifier;
    vectors come out as plain arrays, fit for any file format.
    """
    scored = model.transform(df)
    raw = vector_to_array("rawPrediction")
    kept = [c for c in df.columns if c not in ("prediction", "score", "probability")]
    made = [F.col("prediction"), F.get(raw, F.lit(1)).alias("score")]
    if "probability" in scored.columns:
        made.append(vector_to_array("probability").alias("probability"))
    return scored.select(*kept, *made)


def sample_predictions(scored: DataFrame, key: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``key``, so that every run shows the same."""
    wanted = [*key, "text", "label", "prediction", "probability"]
    return scored.select(*[c for c in wanted if c in scored.columns]).orderBy(*key).limit(n)


def _shared_stages(models: Sequence[PipelineModel]) -> int:
    """How many leading stages all models have in common."""
    n = 0
    for stages in zip(*(m.stages for m in models)):
        if len({stage.uid for stage in stages}) > 1:
            break
        n += 1
    return n


def score_models(
    df: DataFrame, models: Mapping[str, PipelineModel], *keep: str
) -> DataFrame:
    """Every model on every row: ``(keep…, model, prediction, score)``.

    One pass: stages that the models share, such as TF-IDF, run once per row.
    """
    shared = _shared_stages(list(models.values()))
    first = next(iter(models.values()))
    df = PipelineModel(first.stages[:shared]).transform(df)
    kept = [c for c in df.columns if c not in ("prediction", "probability")]
    results = []
    for i, (name, model) in enumerate(models.items()):
        scored = score(df, PipelineModel(model.stages[shared:]))
        result = F.struct(F.lit(name).alias("model"), "prediction", "score")
        results.append(f"_result_{i}")
        df = scored.select(*kept, *results[:-1], result.alias(results[-1]))
    return df.select(*keep, F.inline(F.array(*results)))


def evaluate_models(
    models: Mapping[str, PipelineModel],
    df: DataFrame,
    split_col: str = "split",
    paths: list[str] | None = None,
) -> DataFrame:
    """The metric table, one row per model and split, from one grouped job.

    The scores are written first: the metrics read them more than once.
    """
    scored = write_through(score_models(df, models, split_col, "label"), "scores", paths)
    return calculate_metrics(scored, by=["model", split_col])


def model_leaderboard(metrics: DataFrame) -> DataFrame:
    """One row per model, best validation F1 first, test metrics beside it."""
    validation = metrics.filter(F.col("split") == "validation").select(
        "model",
        F.col("accuracy").alias("validation_accuracy"),
        F.col("f1").alias("validation_f1"),
    )
    test = metrics.filter(F.col("split") == "test").select(
        "model",
        *[
            F.col(m).alias(f"test_{m}")
            for m in ("accuracy", "f1", "precision", "recall", "roc_auc")
        ],
    )
    return leaderboard(validation.join(test, "model", "left"), "validation_f1", "model")


@dataclass
class TrainingRun:
    models: dict[str, PipelineModel]
    metrics: DataFrame
    best_name: str
    splits: dict[str, DataFrame] = field(default_factory=dict)
    paths: list[str] = field(default_factory=list)
    tried: dict[str, list[Tried]] = field(default_factory=dict)

    def searches(self) -> DataFrame:
        """``(model, params, f1, seconds, chosen)``, a row for each grid point."""
        rows = [(name, *astuple(t)) for name, found in self.tried.items() for t in found]
        schema = "model string, params string, f1 double, seconds double, chosen boolean"
        return self.metrics.sparkSession.createDataFrame(rows, schema)

    @property
    def best_model(self) -> PipelineModel:
        return self.models[self.best_name]

    def close(self) -> None:
        """Delete the split rows and the metrics; the models stay usable."""
        delete_folders(self.metrics.sparkSession, self.paths)


def train_all(
    df: DataFrame,
    group_key,
    *,
    clean_col: str = CLEAN,
    names: Sequence[str] = tuple(TRAINERS),
    grid: Grid = Grid(),
    vocab_size: int = 10_000,
    min_df: int = 2,
    report: str | None = None,
) -> TrainingRun:
    """Split by group, learn on train, choose on validation, report on test.

    ``report`` names a folder for the metrics of validation and test as one
    CSV file.

    The split rows are written once: text work is not repeated for the
    vocabulary, the weights, the vectors and the evaluation. Rows without label
    are in no split.
    """
    group = F.col(group_key) if isinstance(group_key, str) else group_key
    rows = df.filter(F.col("label").isNotNull()).withColumn("_group", group.cast("string"))
    kept_paths, scratch = [], []
    tagged = write_through(assign_split(rows, "_group"), "split-rows", kept_paths)
    parts = {
        name: tagged.filter(F.col("split") == name).drop("split")
        for name in ("train", "validation", "test")
    }
    features = fit_tfidf(parts["train"], clean_col, vocab_size, min_df)
    tried: dict[str, list[Tried]] = {}
    models = train_models(
        parts["train"], features, names, grid, group_key="_group", paths=scratch, tried=tried
    )
    held_out = tagged.filter(F.col("split") != "train")
    # A report of a few rows: written, so that reading it trains nothing again.
    measured = evaluate_models(models, held_out, paths=scratch)
    metrics = write_through(measured, "metrics", kept_paths)
    delete_folders(df.sparkSession, scratch)  # vectors and scores
    top = best(model_leaderboard(metrics), "validation_f1", "model").first()
    if report:
        write_table(metrics.orderBy("split", "model"), report, "csv", single_file=True)
    return TrainingRun(models, metrics, top["model"], parts, kept_paths, tried)


# --- throughput -----------------------------------------------------------------------------


def scoring_throughput(df: DataFrame, model: Transformer, runs: int = 3) -> DataFrame:
    """``(run, seconds, n, rec_per_s)``, timed on the ``noop`` sink.

    The sink asks for every column: a bare count lets the optimiser drop the
    prediction that is to be timed.
    """
    n = df.count()
    rows = []
    for run in range(1, runs + 1):
        start = time.perf_counter()
        score(df, model).write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - start
        rows.append((run, seconds, n, n / seconds))
    schema = "run int, seconds double, n bigint, rec_per_s double"
    return df.sparkSession.createDataFrame(rows, schema)


def throughput_summary(runs: DataFrame) -> DataFrame:
    return runs.agg(
        F.avg("seconds").alias("mean_seconds"),
        F.min("seconds").alias("min_seconds"),
        F.max("seconds").alias("max_seconds"),
        (F.max("n") / F.avg("seconds")).alias("rec_per_s"),
    )
