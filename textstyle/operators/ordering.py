"""Deterministic samples, splits, limits, ranks and row numbers at scale.

Nothing here gathers a whole class, or the whole table, in one task: text
columns are read only for rows already known to be near the cut.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType


def _as_column(key: Column | str) -> Column:
    return F.col(key) if isinstance(key, str) else key


def hash_slot(key: Column | str, hex_digits: int = 8) -> Column:
    """A stable pseudo-random integer from the first hex digits of an MD5."""
    digest = F.md5(_as_column(key).cast("string"))
    return F.conv(F.substring(digest, 1, hex_digits), 16, 10).cast("bigint")


# --- split -----------------------------------------------------------------------


def assign_split(
    df: DataFrame,
    key: Column | str,
    weights: Mapping[str, int] | None = None,
    split_col: str = "split",
) -> DataFrame:
    """Label each row train/validation/test by a hash of ``key``.

    Rows that share a key (siblings, exact copies) share a split, and the
    result does not depend on partitioning. Needs no shuffle. Weights are
    percentages in order and add up to 100.
    """
    weights = dict(weights or {"train": 70, "validation": 15, "test": 15})
    if sum(weights.values()) != 100:
        raise ValueError("split weights are percentages and must add up to 100")
    slot = hash_slot(key) % 100
    bounds, low = [], 0
    for name, width in weights.items():
        bounds.append((name, low + width))
        low += width
    first, *rest = bounds
    label = F.when(slot < first[1], first[0])
    for name, high in rest:
        label = label.when(slot < high, name)
    return df.withColumn(split_col, label)


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.7, 0.15, 0.15), seed: int = 42
) -> list[DataFrame]:
    """Spark's own row-wise split; its outcome depends on partitioning."""
    return df.randomSplit(list(weights), seed=seed)


# --- limit and sample --------------------------------------------------------------


def first_rows(df: DataFrame, n: int, key: str) -> DataFrame:
    """The ``n`` rows with the smallest keys, NULL keys first.

    The cut is found on the key column alone, then pushed to the scan as a
    filter, so wide columns are read only for rows that pass it. Without a
    cut only NULL keys are near enough.
    """
    nearest = df.select(key).orderBy(key).limit(n)
    cut = nearest.agg(F.max(key)).scalar()
    return df.filter(F.col(key).isNull() | (F.col(key) <= cut)).orderBy(key).limit(n)


def sample_per_class(
    df: DataFrame,
    n: int,
    key: Column | str,
    classes: Sequence,
    label_col: str = "label",
) -> DataFrame:
    """``n`` pseudo-random rows of each listed class, ordered by MD5 of ``key``.

    A NULL key counts as ''.

    A histogram over the first 16 hash bits gives, per class, the last slot
    that the sample can reach; only rows up to it are ranked. The cut table
    has one row per listed class, which is what makes it safe to broadcast.
    """
    key = F.coalesce(_as_column(key).cast("string"), F.lit(""))
    rows = df.filter(F.col(label_col).isin(list(classes)))
    slot = hash_slot(key, hex_digits=4)
    running = Window.partitionBy(label_col).orderBy("_slot")
    cut = (
        rows.groupBy(label_col, slot.alias("_slot"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(running) - F.col("_n"))
        .filter(F.col("_before") < n)
        .groupBy(label_col)
        .agg(F.max("_slot").alias("_last"))
    )
    near = (
        rows.withColumn("_slot", slot)
        .join(F.broadcast(cut), label_col)
        .filter(F.col("_slot") <= F.col("_last"))
        .drop("_slot", "_last")
        .withColumn("_hash", F.md5(key))
        .withColumn("_key", key)
    )
    # Slices go by the whole row, so that a row is in the same slice when its
    # partition is computed again; only exact copies share one.
    order = [F.col("_hash"), F.col("_key")]
    kept = top_per_group(
        near, [label_col], order, n, spread=F.struct(*[F.col(c) for c in df.columns])
    )
    return kept.drop("_hash", "_key", "rank")


def top_per_group(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    k: int,
    *,
    spread: Column,
    ways: Sequence[int] | None = None,
) -> DataFrame:
    """The first ``k`` rows of each group, ranked from 1 in ``rank``.

    A group may hold a third of the table, so it is first cut to ``k`` rows in
    each of many slices (hashed from ``spread``), then of fewer; at most
    ``64 * k`` rows of a group meet in one task. Up to its own threshold Spark
    already drops rows beyond ``k`` before a shuffle, and one cut is enough.
    """
    if ways is None:
        threshold = df.sparkSession.conf.get(
            "spark.sql.optimizer.windowGroupLimitThreshold", "1000"
        )
        ways = (64,) if k <= int(threshold) else (4096, 64)
    df = df.withColumn("_hash_slice", F.xxhash64(spread))
    for n in ways:
        sliced = Window.partitionBy(*groups, "_slice").orderBy(*order)
        df = (
            df.withColumn("_slice", F.pmod("_hash_slice", F.lit(n)))
            .withColumn("rank", F.row_number().over(sliced))
            .filter(F.col("rank") <= k)
            .drop("_slice", "rank")
        )
    whole = Window.partitionBy(*groups).orderBy(*order)
    return (
        df.drop("_hash_slice")
        .withColumn("rank", F.row_number().over(whole))
        .filter(F.col("rank") <= k)
    )


# --- ranks of report-sized tables -----------------------------------------------------


def leaderboard(df: DataFrame, score: str, name: str) -> DataFrame:
    """Best first; ties in name order."""
    return df.orderBy(F.desc(score), F.asc(name))


def ranked(df: DataFrame, score: str, name: str) -> DataFrame:
    """A report table (one row per model) numbered from 1."""
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc(score), F.asc(name))
    return df.withColumn("rank", F.row_number().over(order))


def best(df: DataFrame, score: str, name: str) -> DataFrame:
    return leaderboard(df, score, name).limit(1)


# --- global row numbers ------------------------------------------------------------


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    spread: Column,
    col: str = "row_number",
    ranges: int | None = None,
) -> DataFrame:
    """Number all rows from 1 by the unique key ``order``, NULLs first.

    ``spread`` is a number that never falls along ``order``, NULL where that
    starts with NULL. Without ``ranges`` their number follows that of the
    rows. The approximate
    quantiles of it cut the rows into ranges; each range is numbered on its own and
    shifted by the rows before it. The quantiles only balance the work: any
    cut points give the same numbers.
    """
    lowest = F.lit(float("-inf"))
    keyed = df.withColumn("_spread", F.coalesce(spread.cast("double"), lowest))
    ranges = ranges or range_count(df.count())
    cuts = range_cuts(keyed, "_spread", ranges)
    slot = range_slot(F.col("_spread"), cuts)
    sliced = keyed.withColumn("_range", slot).drop("_spread")
    before = Window.partitionBy(F.lit(0)).orderBy("_range")
    shift = (
        sliced.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", (F.sum("_n").over(before) - F.col("_n")).alias("_shift"))
    )
    within = Window.partitionBy("_range").orderBy(*order)
    return (
        sliced.withColumn("_row", F.row_number().over(within))
        .join(F.broadcast(shift), "_range")  # at most ``ranges`` rows
        .withColumn(col, F.col("_row") + F.col("_shift"))
        .drop("_range", "_row", "_shift")
    )


def aligned_ranges(
    df: DataFrame,
    order: Sequence[str],
    spread: Column,
    multiple: int,
    ranges: int | None = None,
) -> DataFrame:
    """Adds ``_range`` and ``_first``: ranges along ``order`` that hold whole batches.

    Rows are numbered from 1 by the unique key ``order``, NULLs first; every
    range but the last holds a multiple of ``multiple`` rows, and ``_first`` is
    the number of its first row. ``spread`` as in :func:`number_rows`.

    Keys alone are sorted to find, in each rough range, the key at which the
    first batch starts; rows before it belong to the range before. So a wide
    table needs one shuffle by ``_range``. The driver holds a row a range.
    """
    spark, lowest = df.sparkSession, F.lit(float("-inf"))
    keyed = df.withColumn("_spread", F.coalesce(spread.cast("double"), lowest))
    ranges = ranges or range_count(df.count())
    slot = range_slot(F.col("_spread"), range_cuts(keyed, "_spread", ranges))
    keyed = keyed.withColumn("_slot", slot).drop("_spread")
    keys = keyed.select("_slot", F.struct(*order).alias("_key"))
    sizes = {r["_slot"]: r["n"] for r in keys.groupBy("_slot").agg(F.count("*").alias("n")).collect()}
    skipped, before, wanted = {}, 0, []
    for k in sorted(sizes):
        skipped[k] = -before % multiple
        if skipped[k] < sizes[k]:
            wanted.append((k, skipped[k] + 1))
        before += sizes[k]
    heads_at = spark.createDataFrame(wanted, "_slot int, _at int")
    within = Window.partitionBy("_slot").orderBy("_key")
    heads = keys.withColumn("_row", F.row_number().over(within))
    heads = heads.join(F.broadcast(heads_at), "_slot").filter(F.col("_row") == F.col("_at"))
    found = {r["_slot"]: r["_key"] for r in heads.select("_slot", "_key").collect()}
    rows, own, first, number = [], None, None, 1
    for k in sorted(sizes):
        last, last_first = own, first
        if k in found:
            own, first = k, number + skipped[k]
        rows.append((k, found.get(k), own, first, last, last_first))
        number += sizes[k]
    schema = StructType(
        [
            StructField("_slot", IntegerType()),
            StructField("_head", keys.schema["_key"].dataType),
            *StructType.fromDDL("_own int, _own_first bigint, _last int, _last_first bigint").fields,
        ]
    )
    table = spark.createDataFrame(rows, schema)
    starts_here = F.col("_head").isNotNull() & (F.struct(*order) >= F.col("_head"))
    joined = keyed.join(F.broadcast(table), "_slot")  # at most ``ranges`` rows
    # Without a head of its own a slot lies in the range before, which is ``_own`` too.
    here = starts_here | F.col("_head").isNull()
    return (
        joined.withColumn("_range", F.when(here, F.col("_own")).otherwise(F.col("_last")))
        .withColumn("_first", F.when(here, F.col("_own_first")).otherwise(F.col("_last_first")))
        .drop("_slot", "_head", "_own", "_own_first", "_last", "_last_first")
    )


def range_count(rows: int, rows_each: int = 500_000, most: int = 2000) -> int:
    """How many ranges to cut so many rows into; the driver holds the cuts."""
    return min(most, max(8, -(-rows // rows_each)))


def range_cuts(df: DataFrame, col: str, ranges: int) -> list[float]:
    """Ascending approximate quantiles: at most ``ranges`` numbers."""
    steps = [i / ranges for i in range(1, ranges)]
    if not steps:
        return []
    return sorted(set(df.approxQuantile(col, steps, 1 / (4 * ranges))))


def range_slot(value: Column, cuts: Sequence[float]) -> Column:
    """How many of the ascending ``cuts`` are below or equal to ``value``.

    A search tree of comparisons, so it takes few steps and stays in
    generated code.
    """

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < cuts[middle], search(low, middle)).otherwise(
            search(middle + 1, high)
        )

    return search(0, len(cuts))
