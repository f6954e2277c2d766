"""Reading, writing, ingesting and verifying tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

FORMATS = ("parquet", "csv", "json")
CORRUPT = "_corrupt_record"


def _check_format(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported format: {fmt}")


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    *,
    multiline: bool = False,
) -> DataFrame:
    """Read Parquet, CSV with a header, or JSON lines.

    Give ``schema`` for JSON: inference costs a full pass over the input. CSV
    columns are strings without one. ``multiline`` allows line breaks inside
    quoted CSV values, at the price of files that cannot be split.
    """
    _check_format(fmt)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
        reader = reader.option("multiLine", multiline)
    return reader.format(fmt).load(path)


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines with malformed lines kept in a ``_corrupt_record`` column."""
    return (
        spark.read.schema(with_corrupt_record(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def with_corrupt_record(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(CORRUPT, StringType())])


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    *,
    partition_by: str | None = None,
    single_file: bool = False,
) -> None:
    """Write in parallel; ``single_file`` is meant for report-sized tables."""
    _check_format(fmt)
    writer = (df.coalesce(1) if single_file else df).write.mode(mode)
    if fmt == "csv":
        # By default the writer trims values, so texts would not come back whole.
        writer = (
            writer.option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.format(fmt).save(path)


def ingest_splits(splits: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """Write each named split to its own ``source=<name>`` folder of one table."""
    paths = {name: f"{root}/source={name}" for name in splits}
    for name, df in splits.items():
        write_table(df, paths[name])
    return paths


def ingest_table(df: DataFrame, root: str, source_col: str) -> None:
    """Write every source of ``df`` to its own ``source=<name>`` folder, in one pass.

    Rows without source get the folder that Spark names for NULL.
    """
    df.withColumnRenamed(source_col, "source").write.partitionBy("source").parquet(root)


def verify_table(rows: DataFrame) -> DataFrame:
    """Rows and columns of each source of an ingested table."""
    n_cols = len(rows.columns) - 1
    counts = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("n_cols", F.lit(n_cols))


def read_splits(
    spark: SparkSession, root: str, schema: StructType | str | None = None
) -> DataFrame:
    """All ingested splits as one table; ``source`` comes from the folder name."""
    return read_table(spark, root, schema=schema)


def verify_splits(splits: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each named split."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("source"),
            "n_rows",
            F.lit(len(df.columns)).alias("n_cols"),
        )
        for name, df in splits.items()
    ]
    return reduce(DataFrame.unionByName, parts)
