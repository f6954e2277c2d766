"""What running streams have done, trigger by trigger, as a table.

Figures come from the query's own recent progress, asked for at intervals, so
no callback into Python is needed. A query keeps the last hundred of them
(``spark.sql.streaming.numRecentProgressUpdates``); :func:`missed_batches` says
whether the intervals were short enough.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SCHEMA = (
    "query_id string, run_id string, name string, batch_id bigint, started string, "
    "input_rows bigint, input_rows_per_second double, processed_rows_per_second double, "
    "trigger_ms bigint"
)


class ProgressTable:
    """A folder of JSON lines, one for each trigger of the queries recorded."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._last: dict[str, str] = {}
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)

    def record(self, *queries: StreamingQuery) -> int:
        """Append the triggers that are new since the last call; their number."""
        rows, last = [], {}
        for query in queries:
            run = str(query.runId)
            since = self._last.get(run, "")
            new = [p for p in query.recentProgress if p.timestamp > since]
            if new:
                rows += [_row(p) for p in new]
                last[run] = max(p.timestamp for p in new)
        if rows:
            # As one literal, since rows would go through a Python worker.
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            text = json.dumps([dict(zip(names, row)) for row in rows])
            parsed = F.from_json(F.lit(text), f"array<struct<{SCHEMA}>>")
            frame = self.spark.range(0, 1, 1, 1).select(F.inline(parsed))
            frame.write.mode("append").json(self.path)
            self._last.update(last)
        return len(rows)

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).json(self.path)


def _row(p) -> tuple:
    return (
        str(p.id),
        str(p.runId),
        p.name,
        p.batchId,
        p.timestamp,
        p.numInputRows,
        p.inputRowsPerSecond,
        p.processedRowsPerSecond,
        p.durationMs.get("triggerExecution", 0),
    )


def follow(
    query: StreamingQuery,
    table: ProgressTable,
    seconds: float | None = None,
    every: float = 1.0,
    clock: Callable[[], float] = time.monotonic,
) -> bool:
    """Wait for a query and record its triggers; whether it ended by itself.

    After ``seconds`` it is stopped. A query that failed raises, after its
    triggers have been recorded.
    """
    end = None if seconds is None else clock() + seconds
    ended = False
    try:
        while not ended and (end is None or clock() < end):
            left = every if end is None else min(every, max(end - clock(), 0.01))
            ended = bool(query.awaitTermination(left))
            table.record(query)
    finally:
        query.stop()
        table.record(query)
    return ended


def follow_all(
    starts: Iterable[Callable[[], StreamingQuery]],
    table: ProgressTable,
    at_a_time: int = 16,
    every: float = 5.0,
) -> None:
    """Run queries that end by themselves next to each other and record their triggers.

    Each of ``starts`` starts one, as soon as fewer than ``at_a_time`` run. A
    trigger mostly waits for its logs, so queries next to each other fill the
    cores. Those that run are recorded every so many seconds, one that has ended
    once more, after the next has been started. A query that failed raises,
    after all triggers have been recorded; the others are then stopped.
    """
    waiting = iter(starts)
    running = [start() for start in islice(waiting, at_a_time)]
    end = time.monotonic() + every
    try:
        while running:
            while all(q.isActive for q in running) and time.monotonic() < end:
                time.sleep(0.05)
            ended = [q for q in running if not q.isActive]
            if any(q.exception() for q in ended):
                table.record(*running)
                for query in ended:
                    query.awaitTermination()  # raises what made it fail
            running = [q for q in running if q not in ended]
            running += [start() for start in islice(waiting, len(ended))]
            if time.monotonic() >= end:
                table.record(*ended, *running)
                end = time.monotonic() + every
            else:
                table.record(*ended)
    finally:
        for query in running:
            query.stop()


def batches(progress: DataFrame) -> DataFrame:
    """The triggers that had input: one row for each query and batch.

    A batch that a restart did again counts once, as the last time.
    """
    worked = progress.filter(F.col("input_rows") > 0)
    kept = [c for c in progress.columns if c not in ("query_id", "batch_id")]
    last = F.max(F.struct("started", *[c for c in kept if c != "started"])).alias("last")
    return worked.groupBy("query_id", "batch_id").agg(last).select("query_id", "batch_id", "last.*")


def progress_summary(progress: DataFrame) -> DataFrame:
    """Per query: batches and rows, and how fast and how late they were."""
    return batches(progress).groupBy("query_id").agg(
        F.count("*").alias("batches"),
        F.sum("input_rows").alias("rows"),
        F.max("input_rows").alias("largest_batch"),
        (F.sum("input_rows") * 1000 / F.sum("trigger_ms")).alias("rows_per_second"),
        F.median("trigger_ms").alias("median_ms"),
        F.max("trigger_ms").alias("slowest_ms"),
    )


def missed_batches(progress: DataFrame) -> DataFrame:
    """Per query, how many batches up to the last one have no record."""
    seen = F.count_distinct("batch_id")
    return progress.groupBy("query_id").agg((F.max("batch_id") + 1 - seen).alias("missed"))
