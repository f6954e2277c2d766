"""Classification metrics as aggregations of one scored table.

Every function takes ``by``: columns such as model and split whose values are
measured side by side in the same job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textstyle.operators.ordering import range_count, range_slot


def confusion_counts(
    scored: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """``(by…, label, prediction, count)``, one row per cell that occurs."""
    return scored.groupBy(
        *by,
        F.col(label).cast("int").alias("label"),
        F.col(prediction).cast("int").alias("prediction"),
    ).agg(F.count(F.lit(1)).alias("count"))


def confusion_matrix(
    scored: DataFrame,
    classes: Sequence[int] = (0, 1),
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per true class, one column ``predicted_<class>`` per prediction.

    Predictions outside ``classes``, missing ones included, are counted in
    ``predicted_other``.
    """
    cells = confusion_counts(scored, label, prediction, by)
    return cells.groupBy(*by, "label").agg(
        *[
            F.sum(F.when(F.col("prediction") == c, F.col("count")).otherwise(0)).alias(
                f"predicted_{c}"
            )
            for c in classes
        ],
        F.sum(
            F.when(F.col("prediction").isin(list(classes)), 0).otherwise(F.col("count"))
        ).alias("predicted_other"),
    )


def class_metrics(
    scored: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """Support, precision, recall and F1 of every true class.

    Each confusion cell is counted once as its label and once as its
    prediction, so one aggregation gives all three totals of a class.
    """
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)
    none = F.lit(0).cast("bigint")
    roles = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.col("count").alias("n_true"),
            none.alias("n_predicted"),
            hit.alias("n_hit"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            none.alias("n_true"),
            F.col("count").alias("n_predicted"),
            none.alias("n_hit"),
        ),
    )
    totals = (
        confusion_counts(scored, label, prediction, by)
        .select(*by, F.inline(roles))
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("n_true", "n_predicted", "n_hit")])
        .filter(F.col("n_true") > 0)
    )
    precision = F.when(
        F.col("n_predicted") > 0, F.col("n_hit") / F.col("n_predicted")
    ).otherwise(0.0)
    total = F.col("precision") + F.col("recall")
    return (
        totals.withColumn("precision", precision)
        .withColumn("recall", F.col("n_hit") / F.col("n_true"))
        .withColumn(
            "f1",
            F.when(total > 0, 2 * F.col("precision") * F.col("recall") / total).otherwise(
                0.0
            ),
        )
    )


def classification_metrics(
    scored: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""
    n = F.sum("n_true")
    classes = class_metrics(scored, label, prediction, by)
    return classes.groupBy(*by).agg(
        n.alias("n"),
        (F.sum("n_hit") / n).alias("accuracy"),
        *[
            (F.sum(F.col("n_true") * F.col(m)) / n).alias(m)
            for m in ("f1", "precision", "recall")
        ],
    )


def roc_auc(
    scored: DataFrame,
    label: str = "label",
    score: str = "score",
    by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Exact area under the ROC curve, ``(by…, roc_auc)``.

    The area is the share of (positive, negative) pairs in the right order,
    ties counting half. Equal scores are folded first; then each score range
    counts its own pairs, and a handful of range totals supplies the pairs
    across ranges. The approximate quantiles behind the ranges balance the
    work and cannot change the result.
    """
    scored = scored.withColumn("score", F.col(score).cast("double"))
    is_positive = F.col(label) == 1
    points = scored.groupBy(*by, "score").agg(
        F.count_if(is_positive).cast("double").alias("pos"),
        F.count_if(~is_positive).cast("double").alias("neg"),
    )
    # Scores of different models differ in scale, so each group has its cuts.
    slot = F.lit(0)
    for row in score_cuts(points, by, ranges):
        here = reduce(lambda a, c: a & F.col(c).eqNullSafe(F.lit(row[c])), by, F.lit(True))
        slot = F.when(here, range_slot(F.col("score"), row["cuts"])).otherwise(slot)
    points = points.withColumn("_range", slot)
    inside = Window.partitionBy(*by, "_range").orderBy("score")
    points = points.withColumn("_below", F.sum("neg").over(inside) - F.col("neg"))
    totals = points.groupBy(*by, "_range").agg(
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
        F.sum(F.col("pos") * (F.col("_below") + F.col("neg") / 2)).alias("pairs"),
    )
    groups = list(by) or [F.lit(0)]
    across = Window.partitionBy(*groups).orderBy("_range")
    totals = totals.withColumn("_below", F.sum("neg").over(across) - F.col("neg"))
    won = F.sum(F.col("pairs") + F.col("pos") * F.col("_below"))
    return totals.groupBy(*by).agg(
        F.try_divide(won, F.sum("pos") * F.sum("neg")).alias("roc_auc")
    )


def score_cuts(
    points: DataFrame, by: Sequence[str], ranges: int | None, rows_each: int = 500_000
) -> list:
    """Approximate quantiles of each group's scores, ``(by…, cuts)``.

    Their number follows the group's points unless ``ranges`` is given; the
    driver holds at most 2,000 a group, and groups are models and splits.
    """
    sizes = points.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    most = ranges or range_count(sizes.agg(F.max("n")).first()[0] or 0, rows_each)
    steps = [i / most for i in range(1, most)] or [0.5]
    cuts = F.percentile_approx("score", steps, 4 * most)
    return points.groupBy(*by).agg(F.array_sort(F.array_distinct(cuts)).alias("cuts")).collect()


def calculate_metrics(
    scored: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    score: str = "score",
    by: Sequence[str] = (),
) -> DataFrame:
    """All five metrics, one row per ``by`` group."""
    counted = classification_metrics(scored, label, prediction, by)
    area = roc_auc(scored, label, score, by)
    if not by:
        return counted.withColumn("roc_auc", area.scalar())
    return counted.join(area, list(by), "left")
