"""Structured Streaming: JSON folder in, scored JSON folder out.

All steps are stateless, so a stream runs the same expressions and models as
a batch and needs no state store.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from textstyle.operators.ordering import aligned_ranges
from textstyle.plans.learning import CLEAN, score
from textstyle.sources.tables import CORRUPT, with_corrupt_record

STREAM_SCHEMA = StructType(
    [
        StructField("text", StringType()),
        StructField("abstract_clean", StringType()),
        StructField("label", IntegerType()),
    ]
)
SCORED, QUARANTINED = "scored", "quarantined"
LOG_FILES = "spark.sql.streaming.checkpointFileManagerClass"
LOCAL_LOG_FILES = (
    "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"
)


def read_json_stream(
    spark: SparkSession,
    path: str,
    schema: StructType = STREAM_SCHEMA,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """JSON lines below ``path``, sub-folders included.

    ``files_per_trigger`` limits a batch where its latency matters.

    A line that is not JSON arrives with NULL fields and its raw text in
    ``_corrupt_record``.
    """
    reader = (
        spark.readStream.schema(with_corrupt_record(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", True)
    )
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def sub_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders ``part=…`` that :func:`write_micro_batches` made below ``path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return sorted(s.getPath().toString() for s in found if s.isDirectory())


def score_stream(
    stream: DataFrame,
    model: Transformer,
    preprocess: Callable[[DataFrame], DataFrame] | None = None,
    clean_col: str = CLEAN,
) -> DataFrame:
    """Predictions for good rows; bad rows pass through as ``quarantined``.

    ``preprocess`` makes the clean text from raw text; without it the input
    must bring ``clean_col``. Malformed lines (kept in ``raw_line``) and rows
    without clean text get no prediction.
    """
    needed = "text" if preprocess else clean_col
    bad = F.col(needed).isNull()
    if CORRUPT in stream.columns:
        bad = bad | F.col(CORRUPT).isNotNull()
    stream = stream.withColumn("status", F.when(bad, QUARANTINED).otherwise(SCORED))
    scored = score(preprocess(stream) if preprocess else stream, model)
    made = [c for c in ("prediction", "score", "probability") if c in scored.columns]
    is_good = F.col("status") == SCORED
    kept = [F.col(c) for c in ("text", "label") if c in stream.columns]
    if CORRUPT in stream.columns:
        # Under its own name the column would be filled anew by any JSON reader.
        kept.append(F.col(CORRUPT).alias("raw_line"))
    return scored.select(*kept, *[F.when(is_good, F.col(c)).alias(c) for c in made], "status")


def write_json_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    every: str | None = "10 seconds",
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append to a JSON folder; ``every=None`` drains what is there and stops.

    The folder's own log together with the checkpoint gives each input row
    exactly once, also across restarts. Partitioning by ``status`` puts bad
    rows in a folder of their own within the same commit.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.outputMode("append")
        .format("json")
        .partitionBy(*partition_by)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


@contextmanager
def quick_local_logs(spark: SparkSession, path: str) -> Iterator[None]:
    """Streams that start and end meanwhile write their logs with fewer processes.

    Spark names and renames log files through ``FileContext``, which runs
    several commands of the system for a file on a local disk, most of the time
    of a small trigger. ``FileSystem`` renames a file itself and runs one for its
    permissions. A stream names its source's log in its own thread, a while after
    it has been started, so the setting holds until the end. Elsewhere than on
    a local disk, judged by ``path``, and where a manager of log files has been
    chosen, nothing changes.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    scheme = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()
    if scheme != "file" or spark.conf.get(LOG_FILES, None):
        yield
        return
    spark.conf.set(LOG_FILES, LOCAL_LOG_FILES)
    try:
        yield
    finally:
        spark.conf.unset(LOG_FILES)


def run_for(query: StreamingQuery, seconds: float = 300) -> bool:
    """Wait up to ``seconds``, then stop; whether the query ended by itself."""
    try:
        return bool(query.awaitTermination(seconds))
    finally:
        query.stop()


def drain(query: StreamingQuery, seconds: float | None = None) -> None:
    """Wait for a query that ends by itself, as ``every=None`` does.

    A sink is complete only after that, so a query that has not ended within
    ``seconds`` (by default there is no limit) is stopped and raises.
    """
    try:
        ended = query.awaitTermination(seconds) if seconds else query.awaitTermination() or True
    finally:
        query.stop()
    if not ended:
        raise TimeoutError(f"the stream has not ended in {seconds} seconds; its sink is not complete")


def write_micro_batches(
    df: DataFrame,
    path: str,
    order: Sequence[str],
    spread: Column,
    batch_size: int = 50,
    ranges: int | None = None,
    files_per_folder: int | None = None,
) -> None:
    """Rows in ``order`` as JSON files of ``batch_size``, numbered by ``batch_id``.

    Every file is one batch; only the last may be smaller. All lie in one
    folder, or in folders ``part=…`` of ``files_per_folder`` batches each. Ranges of whole batches are shuffled once and written in order, so
    that a file is full exactly where a batch ends. Spark's committer publishes
    finished files only, so a watching stream never sees half a batch.
    ``spread`` as in :func:`textstyle.operators.ordering.number_rows`.
    """
    ranged = aligned_ranges(df, order, spread, batch_size, ranges)
    along = Window.partitionBy("_range").orderBy(*order)
    number = F.col("_first") + F.row_number().over(along) - 1
    batch = F.floor((number - 1) / batch_size).cast("bigint") + 1
    # The window leaves each task's rows sorted by range and order, the last
    # range at the end.
    numbered = ranged.withColumn("batch_id", batch).drop("_range", "_first")
    if files_per_folder is None:
        numbered.write.option("maxRecordsPerFile", batch_size).json(path)
        return
    part = F.floor((F.col("batch_id") - 1) / files_per_folder)
    # Sorted by folder as well, or the writer would sort by it alone.
    parted = numbered.withColumn("part", part).sortWithinPartitions("part", *order)
    parted.write.option("maxRecordsPerFile", batch_size).partitionBy("part").json(path)
