"""What a restart will do again, and a fault to try it with.

A query logs a batch's offsets before it runs and a commit after its sink has
committed. A batch with offsets but no commit is done again by a restart; a
sink with a log of its own, as the file sink, then knows whether it already has
the batch.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _batches(spark: SparkSession, folder: str) -> set[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return set()
    names = (s.getPath().getName() for s in system.listStatus(path))
    return {int(n) for n in names if n.isdigit()}


def unfinished_batches(spark: SparkSession, checkpoint: str) -> list[int]:
    """Batches of a stopped query that its restart will run again."""
    logged = _batches(spark, f"{checkpoint}/offsets")
    return sorted(logged - _batches(spark, f"{checkpoint}/commits"))


def lose_commit(spark: SparkSession, checkpoint: str) -> int | None:
    """Drop the last commit of a stopped query; the batch, if there is one.

    The checkpoint is then as if the driver had died after the sink committed
    the batch and before the query did. For drills, on a checkpoint of their own.
    """
    done = _batches(spark, f"{checkpoint}/commits")
    if not done:
        return None
    last = max(done)
    for name in (f"{last}", f".{last}.crc"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    return last
