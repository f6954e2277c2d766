"""Session factory and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(
    app_name: str = "textstyle",
    driver_memory: str = "4g",
    master: str | None = None,
    **conf: str,
) -> SparkSession:
    """A session with adaptive execution on; shuffle width is left to Spark.

    Pools share the cores fairly, for jobs that run next to each other.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder.

    Written tables must outlive any executor, so the folder is the one named
    by ``spark.checkpoint.dir`` (or already set on the context). Only a local
    master may fall back to a temporary folder of its own machine.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = tempfile.mkdtemp(prefix="textstyle-")
        context.setCheckpointDir(base)
        base = context.getCheckpointDir()
    return f"{base}/{purpose}-{uuid.uuid4().hex}"


def write_through(df: DataFrame, purpose: str, paths: list[str] | None = None) -> DataFrame:
    """Cut lineage: write ``df`` once to the shared folder and read it back.

    Unlike a checkpoint this computes ``df`` once, and the table read back has
    a size that the optimiser knows. Its folder is added to ``paths``, for
    callers that delete it with :func:`delete_folders`.
    """
    path = shared_folder(df.sparkSession, purpose)
    if paths is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_folders(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that :func:`write_through` made; ``paths`` is emptied."""
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
