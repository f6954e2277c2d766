"""Fitted models checked and read by relational means.

Nothing here calls the model's own ``transform``: features are the long table
of terms, weights and nodes are tables, and scores are joins and sums. So the
results are a second opinion on MLlib's, and scoring can be had where only SQL
runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textstyle.functions import text as T
from textstyle.operators.terms import fits_broadcast, join_small, term_counts
from textstyle.plans.learning import CLEAN
from textstyle.session import shared_folder


def vocabulary_table(spark, model: PipelineModel) -> DataFrame:
    """``(term, feature, idf)`` of a fitted pipeline's second and third stage."""
    counts, idf = model.stages[1:3]
    rows = [(t, k, float(w)) for k, (t, w) in enumerate(zip(counts.vocabulary, idf.idf))]
    return spark.createDataFrame(rows, "term string, feature int, idf double")


def long_features(
    df: DataFrame, keys: Sequence[str], model: PipelineModel, clean_col: str = CLEAN
) -> DataFrame:
    """``(keys…, feature, value)``: the TF-IDF weights that are not zero."""
    terms = term_counts(df, T.tokenize(clean_col), *keys)
    known = join_small(terms, vocabulary_table(df.sparkSession, model), "term")
    return known.select(*keys, "feature", (F.col("tf") * F.col("idf")).alias("value"))


# --- linear models ------------------------------------------------------------------


def weight_table(spark, model: PipelineModel) -> DataFrame:
    """``(feature, weight)`` of a fitted linear model."""
    weights = enumerate(model.stages[-1].coefficients.toArray().tolist())
    return spark.createDataFrame(list(weights), "feature int, weight double")


def linear_scores(df: DataFrame, keys: Sequence[str], model: PipelineModel) -> DataFrame:
    """``(keys…, margin)``: dot product and intercept, for every row of ``df``.

    ``keys`` are unique and not NULL.
    """
    features = long_features(df, keys, model)
    weighted = join_small(features, weight_table(df.sparkSession, model), "feature")
    dots = weighted.groupBy(*keys).agg(F.sum(F.col("value") * F.col("weight")).alias("_dot"))
    margin = F.coalesce("_dot", F.lit(0.0)) + float(model.stages[-1].intercept)
    return df.select(*keys).join(dots, list(keys), "left").select(*keys, margin.alias("margin"))


def _logistic(margin, label):
    return 1 / (1 + F.exp(-margin)) - label


def _hinge(margin, label):
    side = 2 * label - 1
    return F.when(side * margin < 1, -side).otherwise(F.lit(0.0))


#: The derivative of each loss by the margin.
SLOPES = {"logistic": _logistic, "hinge": _hinge}


def optimality(
    train: DataFrame,
    keys: Sequence[str],
    model: PipelineModel,
    loss: str,
    label_col: str = "label",
) -> DataFrame:
    """One row: how far a linear model is from the minimum of its objective.

    The objective is the mean loss plus half the regularisation times the
    squared weights, both for features scaled to unit deviation, as MLlib
    fits it. ``gradient`` is the norm of its (sub)gradient at the fitted
    weights, ``start`` that at weights of zero, with the same intercept: the
    best weights have 0. ``n_rows`` and ``n_features`` say what it was summed
    over; features that never vary have no weight and are left out.

    The sums over rows are one aggregation by feature; ``train`` must be the
    rows that the model was fitted on.
    """
    linear = model.stages[-1]
    reg, intercept = float(linear.getRegParam()), float(linear.intercept)
    slope, label = SLOPES[loss], F.col(label_col).cast("double")
    rows = linear_scores(train, keys, model).join(train.select(*keys, label_col), list(keys))
    rows = rows.select(
        *keys,
        slope(F.col("margin"), label).alias("_slope"),
        slope(F.lit(intercept), label).alias("_start"),
    )
    totals = rows.agg(
        F.count("*").alias("n"), F.avg("_slope").alias("slope"), F.avg("_start").alias("start")
    ).first()
    n = max(totals["n"], 1)
    x = F.col("value")
    sums = long_features(train, keys, model).join(rows, list(keys)).groupBy("feature").agg(
        (F.sum(x * F.col("_slope")) / n).alias("pull"),
        (F.sum(x * F.col("_start")) / n).alias("pull_at_start"),
        F.sqrt((F.sum(x * x) - F.sum(x) ** 2 / n) / max(n - 1, 1)).alias("deviation"),
    )
    sums = sums.filter(F.col("deviation") > 0)
    weighted = join_small(sums, weight_table(train.sparkSession, model), "feature")
    scaled = F.col("pull") / F.col("deviation") + reg * F.col("weight") * F.col("deviation")
    first = F.col("pull_at_start") / F.col("deviation")
    none = F.lit(0.0)
    return weighted.agg(
        F.lit(totals["n"]).cast("bigint").alias("n_rows"),
        F.count("*").alias("n_features"),
        F.sqrt(F.coalesce(F.sum(scaled * scaled), none) + (totals["slope"] or 0) ** 2).alias("gradient"),
        F.sqrt(F.coalesce(F.sum(first * first), none) + (totals["start"] or 0) ** 2).alias("start"),
    )


# --- forests ------------------------------------------------------------------------


def forest_nodes(spark, forest: RandomForestClassificationModel) -> DataFrame:
    """``(tree, node, feature, threshold, left, right, votes)``, as MLlib saves it.

    Leaves have no threshold. ``votes`` are the shares of the classes among
    the training rows that reached a node. Splits are numeric, as those of
    TF-IDF weights are.
    """
    path = shared_folder(spark, "forest")
    forest.write().save(path)
    node = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    inner = F.col("leftChild") >= 0
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, v: a + v)
    return node.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        F.transform("impurityStats", lambda v: v / total).alias("votes"),
    )


def forest_leaves(
    df: DataFrame, keys: Sequence[str], model: PipelineModel, nodes: DataFrame
) -> DataFrame:
    """``(keys…, tree, node, votes)``: the leaf that each row reaches in each tree.

    Rows walk down all trees level by level. A row's sparse features travel
    with it as a map, and each level joins the table of nodes, which is
    broadcast where it is small: then nothing is shuffled on the way.
    """
    pairs = F.collect_list(F.struct("feature", "value"))
    features = long_features(df, keys, model).groupBy(*keys).agg(
        F.map_from_entries(pairs).alias("_features")
    )
    trees = list(range(len(model.stages[-1].trees)))
    at = df.select(*keys).join(features, list(keys), "left").select(
        *keys, "_features", F.explode(F.lit(trees)).alias("tree"), F.lit(0).alias("node")
    )
    small = fits_broadcast(nodes)
    table = F.broadcast(nodes) if small else nodes.hint("merge")
    splits = nodes.filter("threshold IS NOT NULL").drop("votes")
    splits = F.broadcast(splits) if small else splits.hint("merge")
    for _ in range(max(tree.depth for tree in model.stages[-1].trees)):
        value = F.coalesce(F.element_at("_features", F.col("feature")), F.lit(0.0))
        below = F.when(value <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        node = F.when(F.col("threshold").isNull(), F.col("node")).otherwise(below)
        at = at.join(splits, ["tree", "node"], "left").select(
            *keys, "_features", "tree", node.alias("node")
        )
    return at.join(table.select("tree", "node", "votes"), ["tree", "node"]).select(
        *keys, "tree", "node", "votes"
    )


def forest_probabilities(
    df: DataFrame, keys: Sequence[str], model: PipelineModel, nodes: DataFrame
) -> DataFrame:
    """``(keys…, probability)``: the mean of the votes that a row's leaves cast."""
    classes = model.stages[-1].numClasses
    leaves = forest_leaves(df, keys, model, nodes)
    means = [F.avg(F.get("votes", F.lit(c))) for c in range(classes)]
    return leaves.groupBy(*keys).agg(F.array(*means).alias("probability"))


def feature_use(nodes: DataFrame, vocabulary: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` terms that most splits of a forest ask about."""
    splits = nodes.filter("feature IS NOT NULL").groupBy("feature").agg(
        F.count("*").alias("splits"), F.count_distinct("tree").alias("trees")
    )
    named = splits.join(vocabulary.select("feature", "term"), "feature")
    return named.orderBy(F.desc("splits"), "term").limit(k).select("term", "splits", "trees")
