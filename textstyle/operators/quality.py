"""Counts, class balance, NULL counts and the quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns))
    )


def class_distribution(df: DataFrame, label_col: str = "label") -> DataFrame:
    return (
        df.groupBy(label_col)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(label_col)
    )


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column: ``(column, nulls)``, from one scan."""
    return quality_report(df).select("column", "nulls")


def quality_report(df: DataFrame) -> DataFrame:
    """One row per column: ``(column, type, nulls, n_rows)``, from one scan.

    ``count(c)`` skips NULLs, so one aggregate of plain counts is enough.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.col(c)).alias(f"present_{i}") for i, c in enumerate(df.columns)],
    )
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(dtype).alias("type"),
            (F.col("n_rows") - F.col(f"present_{i}")).alias("nulls"),
            F.col("n_rows"),
        )
        for i, (name, dtype) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*rows)))
