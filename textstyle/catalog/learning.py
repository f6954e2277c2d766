"""Metrics over rule-based scores, and models trained on the conversations."""

from __future__ import annotations

from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textstyle.catalog.registry import digest, digest_sql, query, table, tokens_sql
from textstyle.functions import stylometry as S
from textstyle.functions import text as T
from textstyle.operators import metrics as M
from textstyle.operators.ordering import assign_split, best, leaderboard, ranked
from textstyle.operators.terms import term_counts
from textstyle.plans import inspection as I
from textstyle.plans import learning as L
from textstyle.plans.learning import TrainingRun
from textstyle.session import shared_folder, write_through
from textstyle.sources.models import load_model, save_models
from textstyle.sources.tables import read_table

# --- metrics: two rules scored on every labelled document, checked by SQL ----------

SCORES_SQL = f"""
    WITH d AS (SELECT d.doc_id, l.quality AS label, d.n_chars, {tokens_sql('d.text')} AS w,
                      ('0x' || substr(md5(d.doc_id::VARCHAR), 1, 8))::BIGINT % 100 AS slot
               FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
    r AS (SELECT *, len(list_distinct(w)) / len(w) AS diversity,
                 1000 / (1000 + n_chars) AS brevity,
                 CASE WHEN slot < 70 THEN 'train' WHEN slot < 85 THEN 'validation'
                      ELSE 'test' END AS split FROM d),
    s AS (SELECT 'diversity' AS model, split, label, diversity AS score,
                 CASE WHEN diversity > 0.6 THEN 1 ELSE 0 END AS prediction FROM r
          UNION ALL
          SELECT 'brevity', split, label, brevity,
                 CASE WHEN brevity > 0.4 THEN 1 ELSE 0 END FROM r)
"""


def metrics_sql(by: str) -> str:
    """Common tables ``m`` (counted metrics) and ``a`` (area) per ``by`` group."""
    return f"""{SCORES_SQL},
    k AS (SELECT {by}, c.label AS class, count(*) AS n,
                 count(*) FILTER (WHERE s.label = c.label) AS n_true,
                 count(*) FILTER (WHERE s.prediction = c.label) AS n_predicted,
                 count(*) FILTER (WHERE s.label = c.label AND s.prediction = c.label) AS n_hit
          FROM s, (VALUES (0), (1)) c(label) GROUP BY {by}, c.label),
    p AS (SELECT *, CASE WHEN n_predicted > 0 THEN n_hit / n_predicted ELSE 0 END AS pr,
                 CASE WHEN n_true > 0 THEN n_hit / n_true ELSE 0 END AS re FROM k),
    m AS (SELECT {by}, sum(n_true)::BIGINT AS n, sum(n_hit) / sum(n_true) AS accuracy,
                 sum(n_true * CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END)
                     / sum(n_true) AS f1,
                 sum(n_true * pr) / sum(n_true) AS precision,
                 sum(n_true * re) / sum(n_true) AS recall
          FROM p GROUP BY {by}),
    t AS (SELECT {by}, score, sum(label) AS pos, sum(1 - label) AS neg
          FROM s GROUP BY {by}, score),
    b AS (SELECT *, sum(neg) OVER (PARTITION BY {by} ORDER BY score) - neg AS below FROM t),
    a AS (SELECT {by}, sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) AS roc_auc
          FROM b GROUP BY {by})
    """


def rule_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(model, split, label, prediction, score)`` of the two rules."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = table(spark, sf_dir, "documents").join(labels, "doc_id")
    docs = docs.withColumn("w", T.tokenize("text"))
    docs = assign_split(docs, "doc_id").select(
        "split",
        "label",
        S.lexical_diversity(F.col("w")).alias("diversity"),
        (F.lit(1000) / (F.col("n_chars") + 1000)).alias("brevity"),
    )
    scores = docs.unpivot(["split", "label"], ["diversity", "brevity"], "model", "score")
    limit = F.when(F.col("model") == "diversity", 0.6).otherwise(0.4)
    return scores.withColumn("prediction", (F.col("score") > limit).cast("double"))


def _one_rule(spark, sf_dir) -> DataFrame:
    return rule_scores(spark, sf_dir).filter(F.col("model") == "diversity")


def _single_metric(name: str, metric: str):
    @query(
        name,
        f"{metrics_sql('model')} SELECT round({metric}, 6) AS {metric} "
        "FROM m WHERE model = 'diversity'",
    )
    def run(spark, sf_dir):
        measured = M.classification_metrics(_one_rule(spark, sf_dir))
        return measured.select(F.round(metric, 6).alias(metric))


_single_metric("ml8_accuracy", "accuracy")
_single_metric("ml9_weighted_f1", "f1")
_single_metric("ml10_weighted_precision", "precision")
_single_metric("ml11_weighted_recall", "recall")


@query(
    "ml12_roc_auc",
    f"{metrics_sql('model')} SELECT model, round(roc_auc, 6) AS roc_auc FROM a",
)
def roc_auc(spark, sf_dir):
    area = M.roc_auc(rule_scores(spark, sf_dir), by=["model"])
    return area.select("model", F.round("roc_auc", 6).alias("roc_auc"))


METRICS = ("accuracy", "f1", "precision", "recall", "roc_auc")
_ROUNDED_SQL = ", ".join(f"round({m}, 6) AS {m}" for m in METRICS)


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({m: F.round(m, 6) for m in METRICS})


@query(
    "ml13_all_metrics",
    f"{metrics_sql('model')} SELECT n, {_ROUNDED_SQL} FROM m JOIN a USING (model) "
    "WHERE model = 'diversity'",
)
def all_metrics(spark, sf_dir):
    scored = write_through(_one_rule(spark, sf_dir), "scores")
    return _rounded(M.calculate_metrics(scored))


@query(
    "ml14_confusion_matrix",
    f"""{SCORES_SQL}
    SELECT model, label, count(*) FILTER (WHERE prediction = 0) AS predicted_0,
           count(*) FILTER (WHERE prediction = 1) AS predicted_1,
           count(*) FILTER (WHERE prediction NOT IN (0, 1)) AS predicted_other
    FROM s GROUP BY model, label
    """,
)
def confusion_matrix(spark, sf_dir):
    return M.confusion_matrix(rule_scores(spark, sf_dir), by=["model"])


@query(
    "ml14_confusion_counts",
    f"""{SCORES_SQL}
    SELECT model, label, prediction, count(*) AS count FROM s
    GROUP BY model, label, prediction
    """,
)
def confusion_counts(spark, sf_dir):
    return M.confusion_counts(rule_scores(spark, sf_dir), by=["model"])


@query(
    "ml15_evaluate_rules",
    f"{metrics_sql('model, split')} SELECT model, split, n, {_ROUNDED_SQL} "
    "FROM m JOIN a USING (model, split)",
)
def evaluate_rules(spark, sf_dir):
    by = ["model", "split"]
    scored = write_through(rule_scores(spark, sf_dir), "scores")
    return _rounded(M.calculate_metrics(scored, by=by))


def _rule_metrics(spark, sf_dir) -> DataFrame:
    counted = M.classification_metrics(rule_scores(spark, sf_dir), by=["model"])
    return counted.select("model", F.round("f1", 6).alias("f1"))


@query(
    "so3_best_model",
    f"{metrics_sql('model')} SELECT model, round(f1, 6) AS f1 FROM m "
    "ORDER BY f1 DESC, model LIMIT 1",
)
def best_rule(spark, sf_dir):
    return best(_rule_metrics(spark, sf_dir), "f1", "model")


@query(
    "so3_leaderboard",
    f"{metrics_sql('model')} SELECT model, round(f1, 6) AS f1 FROM m ORDER BY f1 DESC, model",
)
def rule_leaderboard(spark, sf_dir):
    return leaderboard(_rule_metrics(spark, sf_dir), "f1", "model")


@query(
    "so4_ranked_models",
    f"{metrics_sql('model')} SELECT model, round(f1, 6) AS f1, "
    "row_number() OVER (ORDER BY f1 DESC, model)::INTEGER AS rank FROM m",
)
def ranked_rules(spark, sf_dir):
    return ranked(_rule_metrics(spark, sf_dir), "f1", "model")


# --- trained models -----------------------------------------------------------------


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn: user (0), assistant (1), and others without label."""
    label = F.when(F.col("role") == "assistant", 1).when(F.col("role") == "user", 0)
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        "text",
        T.join_tokens(T.tokenize("text")).alias("abstract_clean"),
        label.alias("label"),
    )


TURNS_SQL = f"""
    SELECT conv_id, turn, text, {tokens_sql('text')} AS w,
           CASE role WHEN 'assistant' THEN 1 WHEN 'user' THEN 0 END AS label,
           CASE WHEN slot < 70 THEN 'train' WHEN slot < 85 THEN 'validation' ELSE 'test' END
               AS split
    FROM (SELECT *, ('0x' || substr(md5(conv_id::VARCHAR), 1, 8))::BIGINT % 100 AS slot
          FROM conversations)
"""


def trained(spark: SparkSession, sf_dir: str, *names: str) -> TrainingRun:
    """The named models with the full search grid, fitted for this query."""
    return L.train_all(turns(spark, sf_dir), "conv_id", names=names or tuple(L.TRAINERS))


# The constants of 32-bit MurmurHash3.
_MASK = 2**32 - 1


def _times(x: str, factor: int) -> str:
    return f"(({x}) * {factor}::UBIGINT & {_MASK})"


def _turned(x: str, bits: int) -> str:
    return f"((({x}) << {bits} & {_MASK}) | (({x}) >> {32 - bits}))"


def murmur3_buckets_sql(terms: str, buckets: int) -> str:
    """``(term, bucket)`` for the ``term`` column of a query, hashed step by step.

    Blocks of four bytes, low byte first, are mixed one after another, then the
    rest, then the length; the result is taken as a signed number.
    """
    byte = "x[2 * {0} + 1:2 * {0} + 2]"
    word = " || ".join(byte.format(f"(4 * j + {k})") for k in (3, 2, 1, 0))
    rest = " || ".join(byte.format(f"(n - n % 4 + {k})") for k in (2, 1, 0))
    return f"""
        SELECT term, (((g - CASE WHEN g >= {2**31} THEN {2**32} ELSE 0 END) % {buckets})
                      + {buckets}) % {buckets} AS bucket
        FROM (SELECT term, xor(h, h >> 16)::BIGINT AS g FROM (
        SELECT term, {_times('xor(h, h >> 13)', 0xC2B2AE35)} AS h FROM (
        SELECT term, {_times('xor(h, h >> 16)', 0x85EBCA6B)} AS h FROM (
        SELECT term, xor(xor(h, {_times('r', 0x1B873593)}), n::UBIGINT) AS h FROM (
        SELECT term, n, {_turned('r', 15)} AS r, list_reduce(list_prepend(42::UBIGINT, w),
               lambda h, k: ({_turned('xor(h, k)', 13)} * 5::UBIGINT + {0xE6546B64}::UBIGINT)
                            & {_MASK}) AS h FROM (
        SELECT term, n, {_times('r', 0xCC9E2D51)} AS r,
               list_transform(w, lambda k: {_times('k', 0x1B873593)}) AS w FROM (
        SELECT term, n, r, list_transform(w, lambda k: {_turned('k', 15)}) AS w FROM (
        SELECT term, n, ('0x0' || {rest})::UBIGINT AS r,
               list_transform(range(n // 4),
                   lambda j: {_times(f"('0x' || {word})::UBIGINT", 0xCC9E2D51)}) AS w
        FROM (SELECT term, hex(encode(term)) AS x, strlen(term) AS n FROM ({terms}))))))))))
    """


@query(
    "ml1_hashing_tf",
    f"""
    WITH e AS (SELECT conv_id, turn, unnest(w) AS term FROM ({TURNS_SQL})),
         b AS ({murmur3_buckets_sql('SELECT DISTINCT term FROM e', 10_000)})
    SELECT conv_id, turn, bucket::INTEGER AS bucket, count(*)::DOUBLE AS tf
    FROM e JOIN b USING (term) GROUP BY ALL
    """,
)
def hashing_tf(spark, sf_dir):
    """The count in each bucket; SQL finds a term's bucket by its own hash."""
    rows = turns(spark, sf_dir)
    hashed = L.fit_hashing_tfidf(rows).transform(rows)
    counts = F.transform(vector_to_array("raw_features"), lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    filled = F.explode(F.filter(counts, lambda c: c["x"] != 0)).alias("c")
    return hashed.select("conv_id", "turn", filled).select(
        "conv_id", "turn", F.col("c.i").alias("bucket"), F.col("c.x").alias("tf")
    )


@query(
    "ml3_tfidf_vectors",
    f"""
    WITH t AS ({TURNS_SQL}),
         e AS (SELECT conv_id, turn, unnest(w) AS term FROM t),
         tf AS (SELECT conv_id, turn, term, count(*) AS tf FROM e GROUP BY ALL),
         v AS (SELECT term, count(*) AS df FROM tf GROUP BY term HAVING count(*) >= 2
               ORDER BY sum(tf) DESC, term LIMIT 10000),
         n AS (SELECT count(*) AS m FROM t),
         s AS (SELECT conv_id, turn, sum(tf * ln((m + 1) / (df + 1))) AS total
               FROM tf JOIN v USING (term), n GROUP BY conv_id, turn)
    SELECT t.conv_id, t.turn, round(coalesce(s.total, 0.0), 4) AS total
    FROM t LEFT JOIN s ON t.conv_id = s.conv_id AND t.turn = s.turn
    """,
)
def tfidf_vectors(spark, sf_dir):
    """MLlib's vectors carry the same weights as the relational form."""
    rows = turns(spark, sf_dir)
    weighted = L.fit_tfidf(rows).transform(rows)
    weights = vector_to_array(L.TFIDF)
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    return weighted.select("conv_id", "turn", F.round(total, 4).alias("total"))


# Fitted weights have no SQL twin. These queries compare what MLlib says of
# every turn with the same from tables of terms, weights and nodes, and measure
# how near the fitted weights are to the best; SQL counts what they cover.

KEYS = ["conv_id", "turn"]
_SAME_SQL = f"SELECT conv_id, turn, label, true AS same FROM ({TURNS_SQL})"


def _linear_query(name: str, model: str):
    @query(name, _SAME_SQL)
    def run(spark, sf_dir):
        """A score is a sum over terms, a prediction its sign."""
        fitted, rows = trained(spark, sf_dir, model).models[model], turns(spark, sf_dir)
        ours = I.linear_scores(rows, KEYS, fitted)
        both = L.score(rows, fitted).join(ours, KEYS)
        margin = F.col("margin")
        same = (F.abs(F.col("score") - margin) < 1e-9) & (
            (F.col("prediction") == (margin > 0).cast("double")) | (F.abs(margin) < 1e-9)
        )
        return both.select(*KEYS, "label", same.alias("same"))


_linear_query("ml5_logistic_regression", L.LOGISTIC)
_linear_query("ml7_linear_svm", L.SVM)


@query("ml6_random_forest", _SAME_SQL)
def random_forest(spark, sf_dir):
    """The probability of every turn, by walking the table of nodes."""
    fitted, rows = trained(spark, sf_dir, L.FOREST).models[L.FOREST], turns(spark, sf_dir)
    nodes = write_through(I.forest_nodes(spark, fitted.stages[-1]), "nodes")
    ours = I.forest_probabilities(rows, KEYS, fitted, nodes)
    theirs = L.score(rows, fitted).select(*KEYS, "label", F.col("probability").alias("theirs"))
    both = theirs.join(ours, KEYS)
    far = F.exists(F.zip_with("probability", "theirs", lambda a, b: F.abs(a - b)), lambda d: d > 1e-9)
    return both.select(*KEYS, "label", (~far).alias("same"))


#: The norm of the objective's gradient, as a share of that at weights of zero.
#: The hinge loss has a kink: rows near it keep the subgradient from vanishing.
NEAR_OPTIMUM = {L.LOGISTIC: ("logistic", 1e-5), L.SVM: ("hinge", 0.1)}

TRAINED_TERMS_SQL = f"""
    WITH t AS (SELECT * FROM ({TURNS_SQL}) WHERE split = 'train' AND label IS NOT NULL),
         e AS (SELECT conv_id, turn, unnest(w) AS term FROM t),
         tf AS (SELECT conv_id, turn, term, count(*) AS tf FROM e GROUP BY ALL),
         n AS (SELECT count(*) AS m FROM t),
         v AS (SELECT term, count(*) AS df, sum(tf) AS count FROM tf GROUP BY term
               HAVING count(*) >= 2 ORDER BY count DESC, term LIMIT 10000)
"""


def _optimality_query(name: str, model: str):
    @query(
        name,
        f"""{TRAINED_TERMS_SQL}
        SELECT m AS n_rows, count(*) FILTER (WHERE df < m) AS n_features, true AS near_optimum
        FROM n LEFT JOIN v ON true GROUP BY m
        """,
    )
    def run(spark, sf_dir):
        """How far the fit is from the minimum; terms of all rows weigh nothing."""
        fitted = trained(spark, sf_dir, model)
        loss, share = NEAR_OPTIMUM[model]
        found = I.optimality(fitted.splits["train"], KEYS, fitted.models[model], loss)
        near = F.col("gradient") <= share * F.col("start")
        return found.select("n_rows", "n_features", near.alias("near_optimum"))


_optimality_query("ml5_optimality", L.LOGISTIC)
_optimality_query("ml7_optimality", L.SVM)

_MODELS_SQL = "(VALUES ('Logistic Regression'), ('Random Forest'), ('Linear SVM')) m(model)"


@query(
    "ml15_evaluate_models",
    f"""
    SELECT model, split, count(*) AS n, true AS same
    FROM ({TURNS_SQL}) t, {_MODELS_SQL}
    WHERE split <> 'train' AND label IS NOT NULL GROUP BY model, split
    """,
)
def evaluate_models(spark, sf_dir):
    """Our metrics of each model and split beside those of MLlib's evaluators."""
    run = trained(spark, sf_dir)
    theirs = []
    for name, model in run.models.items():
        for split in ("validation", "test"):
            rows = L.score(run.splits[split], model).withColumn("label", F.col("label").cast("double"))
            rows = rows.select("label", "prediction", F.col("score").alias("rawPrediction"))
            values = [
                MulticlassClassificationEvaluator(metricName=m).evaluate(rows)
                for m in ("accuracy", "f1", "weightedPrecision", "weightedRecall")
            ]
            values.append(BinaryClassificationEvaluator(numBins=0).evaluate(rows))
            theirs.append((name, split, *values))
    columns = [f"mllib_{m}" for m in METRICS]
    report = spark.createDataFrame(
        theirs, "model string, split string, " + ", ".join(f"{c} double" for c in columns)
    )
    same = F.lit(True)
    for m in METRICS:
        same = same & (F.abs(F.col(m) - F.col(f"mllib_{m}")) < 1e-6)
    return run.metrics.join(report, ["model", "split"]).select("model", "split", "n", same.alias("same"))


@query("ml16_batch_scoring", f"SELECT conv_id, turn, true AS same FROM ({TURNS_SQL})")
def batch_scoring(spark, sf_dir):
    """A score is the dot product of coefficients and long-form TF-IDF weights."""
    run = trained(spark, sf_dir, L.LOGISTIC)
    model, rows = run.best_model, turns(spark, sf_dir)
    counts, idf, linear = model.stages[1:]
    weights = spark.createDataFrame(
        [
            (term, float(w * c))
            for term, w, c in zip(counts.vocabulary, idf.idf, linear.coefficients)
        ],
        "term string, weight double",
    )
    terms = term_counts(rows, T.tokenize("abstract_clean"), "conv_id", "turn")
    dots = terms.join(F.broadcast(weights), "term").groupBy("conv_id", "turn")
    dots = dots.agg(F.sum(F.col("tf") * F.col("weight")).alias("dot"))
    scored = L.score(rows, model).join(dots, ["conv_id", "turn"], "left")
    expected = F.coalesce("dot", F.lit(0.0)) + float(linear.intercept)
    return scored.select(
        "conv_id", "turn", (F.abs(F.col("score") - expected) < 1e-6).alias("same")
    )


@query(
    "ml17_sample_predictions",
    f"""
    SELECT conv_id, turn, label, {digest_sql('text')}, true AS predicted FROM ({TURNS_SQL})
    WHERE split = 'test' AND label IS NOT NULL ORDER BY conv_id, turn LIMIT 5
    """,
)
def sample_predictions(spark, sf_dir):
    run = trained(spark, sf_dir, L.LOGISTIC)
    scored = L.score(run.splits["test"], run.best_model)
    sample = L.sample_predictions(scored, ["conv_id", "turn"])
    predicted = F.col("prediction").isin(0.0, 1.0) & (F.size("probability") == 2)
    return sample.select("conv_id", "turn", "label", *digest(F.col("text")), predicted.alias("predicted"))


@query(
    "ml18_train_all",
    f"""
    SELECT model, split, count(*) AS n, points, true AS best_chosen
    FROM ({TURNS_SQL}) t, (VALUES ('{L.LOGISTIC}', 0::BIGINT), ('{L.FOREST}', 4), ('{L.SVM}', 2))
         m(model, points)
    WHERE split <> 'train' AND label IS NOT NULL GROUP BY ALL
    """,
)
def train_all(spark, sf_dir):
    """The report as written, and how many grid points led to each model."""
    path = shared_folder(spark, "report")
    run = L.train_all(turns(spark, sf_dir), "conv_id", report=path)
    report = read_table(spark, path, "csv", "model string, split string, n bigint, accuracy double, "
                        "f1 double, precision double, recall double, roc_auc double")  # fmt: skip
    top = F.max_by("chosen", F.struct("f1", "chosen")).alias("best_chosen")
    tried = run.searches().groupBy("model").agg(F.count("*").alias("points"), top)
    both = report.join(tried, "model", "left")
    return both.select(
        "model",
        "split",
        "n",
        F.coalesce("points", F.lit(0)).alias("points"),
        F.coalesce("best_chosen", F.lit(True)).alias("best_chosen"),
    )


def _throughput(spark, sf_dir) -> DataFrame:
    model = trained(spark, sf_dir, L.LOGISTIC).best_model
    return L.scoring_throughput(turns(spark, sf_dir), model)


@query(
    "ml19_scoring_throughput",
    "SELECT run::INTEGER AS run, (SELECT count(*) FROM conversations) AS n, true AS timed "
    "FROM range(1, 4) t(run)",
)
def scoring_throughput(spark, sf_dir):
    runs = _throughput(spark, sf_dir)
    return runs.select("run", "n", (F.col("rec_per_s") > 0).alias("timed"))


@query("ml19_throughput_summary", "SELECT count(*) > 0 AS ordered FROM conversations")
def throughput_summary(spark, sf_dir):
    summary = L.throughput_summary(_throughput(spark, sf_dir))
    ordered = F.col("mean_seconds").between(F.col("min_seconds"), F.col("max_seconds"))
    return summary.select((ordered & (F.col("rec_per_s") > 0)).alias("ordered"))


@query("io11_saved_model_scoring", f"SELECT conv_id, turn, true AS same FROM ({TURNS_SQL})")
def saved_model_scoring(spark, sf_dir):
    """A saved model, loaded back, scores every turn as the one in memory does."""
    run, rows = trained(spark, sf_dir, L.LOGISTIC), turns(spark, sf_dir)
    root = shared_folder(spark, "models")
    save_models(run.models, root)
    loaded = L.score(rows, load_model(root, run.best_name))
    loaded = loaded.select("conv_id", "turn", F.struct("prediction", "score").alias("loaded"))
    both = L.score(rows, run.best_model).join(loaded, ["conv_id", "turn"])
    same = (F.struct("prediction", "score") == F.col("loaded")).alias("same")
    return both.select("conv_id", "turn", same)


@query(
    "io10_saved_vocabulary",
    f"""{TRAINED_TERMS_SQL}
    SELECT term, (row_number() OVER (ORDER BY count DESC, term) - 1)::INTEGER AS feature,
           round(ln((m + 1) / (df + 1)), 6) AS idf
    FROM v, n
    """,
)
def saved_vocabulary(spark, sf_dir):
    """Terms and weights from the files of the current version of a model."""
    run = trained(spark, sf_dir, L.LOGISTIC)
    root = shared_folder(spark, "models")
    for _ in range(2):  # the second version replaces the first
        save_models(run.models, root)
    table_ = I.vocabulary_table(spark, load_model(root, run.best_name))
    return table_.withColumn("idf", F.round("idf", 6))
