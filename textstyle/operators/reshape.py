"""Tagging, union and wide-to-long reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HUMAN, MACHINE = 0, 1


def tag_source(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("source", F.lit(name))


def combine_splits(splits: Mapping[str, DataFrame]) -> DataFrame:
    """Union named splits by column name, each tagged with its name."""
    tagged = [tag_source(df, name) for name, df in splits.items()]
    return reduce(DataFrame.unionByName, tagged)


def stack_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by position, duplicates kept."""
    return reduce(DataFrame.union, tables)


def wide_to_long(
    df: DataFrame,
    human: str,
    machine: Sequence[str],
    ids: Sequence[str] = (),
) -> DataFrame:
    """One row per author: ``(ids…, generator, text, label)``.

    A single pass over the input; a missing text stays as a NULL row.
    """
    long = df.unpivot(list(ids), [human, *machine], "generator", "text")
    label = F.when(F.col("generator") == human, HUMAN).otherwise(MACHINE)
    return long.withColumn("label", label)


def of_class(df: DataFrame, label: int, label_col: str = "label") -> DataFrame:
    return df.filter(F.col(label_col) == label)


def explode_tokens(
    df: DataFrame, tokens: Column, alias: str, *keep: str
) -> DataFrame:
    """One row per token; rows without tokens give none.

    An inner explode would add a filter on the array's size and so compute
    ``tokens`` twice. The outer one computes them once; its NULL row for an
    empty array is dropped instead.
    """
    rows = df.select(*keep, F.explode_outer(tokens).alias(alias))
    return rows.filter(F.col(alias).isNotNull())
