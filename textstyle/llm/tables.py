"""Registration of this subpackage's queries, and helpers its operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bits of a hash that tell the slots of a sample's histogram apart.
SLOT_BITS = 20
#: Rows whose texts a task holds as Python objects.
HELD_ROWS = 512

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds


def raw_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column, undecoded; null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def in_slices(batches: Iterable[pa.RecordBatch], rows: int = HELD_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces, so that few of their texts are Python objects at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def check_names(df: DataFrame, made: list[str]) -> None:
    """Columns passed through may not carry the name of one that is made."""
    clash = sorted(set(df.columns) & set(made))
    if clash:
        raise ValueError(f"input columns would hide results: {clash}; rename them")


def take_per_class(df: DataFrame, label: str, key: list[str], n: int) -> DataFrame:
    """At most ``n`` rows of each class, the first by a hash of ``key``.

    A histogram of hashes over labels and keys alone gives each class the last
    slot that its sample can reach; only rows up to it are shuffled, however
    many partitions there are. The cuts have one row a class.
    """
    hashed = F.xxhash64(*key)
    slot = F.shiftrightunsigned(hashed, 64 - SLOT_BITS).alias("_slot")
    running = F.sum("_n").over(Window.partitionBy(label).orderBy("_slot"))
    counts = df.groupBy(label, slot).agg(F.count("*").alias("_n"))
    reached = counts.withColumn("_before", running - F.col("_n")).where(F.col("_before") < n)
    cuts = reached.groupBy(F.col(label).alias("_label")).agg(F.max("_slot").alias("_last"))
    near = df.withColumn("_hash", hashed).join(F.broadcast(cuts), F.col(label) == F.col("_label"))
    near = near.where(F.shiftrightunsigned("_hash", 64 - SLOT_BITS) <= F.col("_last"))
    # Negative hashes have the highest slots.
    order = [F.shiftrightunsigned("_hash", 64 - SLOT_BITS), F.col("_hash"), *map(F.col, key)]
    rank = F.row_number().over(Window.partitionBy(label).orderBy(*order))
    return near.withColumn("_rank", rank).where(F.col("_rank") <= n).select(df.columns)


def fit_in_task(sample: DataFrame, fit: Callable[[list[tuple]], bytes]) -> bytes:
    """``fit`` over all rows of a bounded sample, in one task; its model's bytes."""

    def run(batches):
        rows = []
        for batch in batches:
            rows += zip(*(c.to_pylist() for c in batch.columns))
        yield pa.RecordBatch.from_arrays([pa.array([fit(rows)], pa.binary())], ["model"])

    # Sorted, so that the order of the rows does not hang on their way there.
    ready = sample.repartition(1).sortWithinPartitions(*sample.columns)
    row = ready.mapInArrow(run, "model binary").first()
    return bytes(row["model"]) if row else fit([])  # an empty table may have no task
