"""Streams over the conversations, drained and read back."""

from __future__ import annotations

from functools import partial

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from textstyle.catalog.learning import TURNS_SQL, trained, turns
from textstyle.catalog.registry import digest, digest_sql, query, table, tokens_sql
from textstyle.catalog.text import (
    BRUNET_SQL,
    DIVERSITY_SQL,
    WORD_LENGTH_SQL,
    words_sql,
)
from textstyle.functions import text as T
from textstyle.operators.features import stylometric_features
from textstyle.plans.learning import LOGISTIC, score
from textstyle.session import shared_folder
from textstyle.streaming import (
    ProgressTable,
    batches,
    drain,
    follow_all,
    lose_commit,
    missed_batches,
    quick_local_logs,
    read_json_stream,
    score_stream,
    sub_folders,
    unfinished_batches,
    write_json_stream,
    write_micro_batches,
)

BATCH_SCHEMA = StructType(
    [
        StructField("conv_id", LongType()),
        StructField("turn", LongType()),
        StructField("role", StringType()),
        StructField("text", StringType()),
        StructField("batch_id", LongType()),
    ]
)
SCORED_COLUMNS = ("prediction", "score", "probability")
#: Rises along (conv_id, turn) and stays below the next conv_id.
SPREAD_EXPRESSION = "conv_id + turn / (turn + 1)"
#: Less than the triggers that a query remembers, so none can be missed.
FILES_PER_STREAM = 50
#: More only wait for the one thread of Spark's scheduler, and take the driver's memory.
STREAMS_AT_A_TIME = 8


def _feed(df: DataFrame, files_per_folder: int | None = None) -> str:
    """Write ``df`` as numbered 50-row JSON batches; the folder they are in."""
    path = shared_folder(df.sparkSession, "stream-input")
    spread = F.expr(SPREAD_EXPRESSION)
    write_micro_batches(df, path, ["conv_id", "turn"], spread, files_per_folder=files_per_folder)
    return path


def _drain(stream: DataFrame, schema: StructType | str, partition_by=()) -> DataFrame:
    """Run a stream over what is there and read its sink back."""
    spark = stream.sparkSession
    out, marks = shared_folder(spark, "stream-output"), shared_folder(spark, "stream-log")
    drain(write_json_stream(stream, out, marks, every=None, partition_by=partition_by))
    return spark.read.schema(schema).json(out)


def _stream(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``rows`` by way of an ordinary folder of JSON lines."""
    path = shared_folder(spark, "stream-input")
    rows.write.json(path)
    return read_json_stream(spark, path, rows.schema)


@query(
    "ss8_micro_batches",
    f"""
    WITH n AS (SELECT *, row_number() OVER (ORDER BY conv_id, turn) AS n FROM conversations)
    SELECT (n - 1) // 50 + 1 AS batch_id, conv_id, turn, role, {digest_sql('text')} FROM n
    """,
)
def micro_batches(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    numbered = spark.read.schema(BATCH_SCHEMA).json(_feed(rows))
    return numbered.select("batch_id", "conv_id", "turn", "role", *digest(F.col("text")))


BATCH_SIZES_SQL = """
    SELECT (n - 1) // 50 + 1 AS batch_id, count(*) AS n FROM (
        SELECT row_number() OVER (ORDER BY conv_id, turn) AS n FROM conversations)
    GROUP BY batch_id
"""


@query(
    "ss8_batch_files",
    f"SELECT batch_id, n AS n_rows, 1::BIGINT AS n_files FROM ({BATCH_SIZES_SQL})",
)
def batch_files(spark, sf_dir):
    """Every file is one whole batch."""
    numbered = spark.read.schema(BATCH_SCHEMA).json(_feed(table(spark, sf_dir, "conversations")))
    files = numbered.groupBy("batch_id", F.input_file_name().alias("file")).count()
    return files.groupBy("batch_id").agg(
        F.sum("count").alias("n_rows"), F.count("*").alias("n_files")
    )


@query(
    "ss6_trigger_progress",
    f"""
    SELECT n AS input_rows, count(*) AS batches, true AS timed, 0::BIGINT AS missed
    FROM ({BATCH_SIZES_SQL}) GROUP BY n
    """,
)
def trigger_progress(spark, sf_dir):
    """One file a trigger: how many rows each took in, from the progress table.

    Streams of a folder each run next to each other, so that neither their
    number of triggers nor the logs of their sinks grow with the input.
    """
    source = _feed(table(spark, sf_dir, "conversations"), FILES_PER_STREAM)
    progress = ProgressTable(spark, shared_folder(spark, "stream-progress"))

    def start(folder: str):
        stream = read_json_stream(spark, folder, BATCH_SCHEMA, files_per_trigger=1)
        out, marks = shared_folder(spark, "stream-output"), shared_folder(spark, "stream-log")
        return write_json_stream(stream, out, marks, every=None)

    with quick_local_logs(spark, source):
        starts = [partial(start, folder) for folder in sub_folders(spark, source)]
        follow_all(starts, progress, STREAMS_AT_A_TIME)
    done = batches(progress.read()).join(missed_batches(progress.read()), "query_id")
    timed = (F.col("trigger_ms") > 0) & (F.col("processed_rows_per_second") > 0)
    return done.groupBy("input_rows").agg(
        F.count("*").alias("batches"),
        F.min(timed).alias("timed"),
        F.max("missed").alias("missed"),
    )


@query(
    "ss1_json_stream",
    f"SELECT conv_id, turn, role, {digest_sql('text')} FROM conversations",
)
def json_stream(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    back = _drain(_stream(spark, rows), rows.schema)
    return back.select("conv_id", "turn", "role", *digest(F.col("text")))


@query(
    "ss2_stream_tokens",
    f"""
    SELECT conv_id, turn, len({tokens_sql('text')})::INTEGER AS n_tokens,
           md5(array_to_string({tokens_sql('text')}, ' ')) AS clean_md5
    FROM conversations
    """,
)
def stream_tokens(spark, sf_dir):
    stream = _stream(spark, table(spark, sf_dir, "conversations"))
    stream = stream.withColumn("words", T.tokenize("text")).select(
        "conv_id",
        "turn",
        F.size("words").alias("n_tokens"),
        F.md5(T.join_tokens("words")).alias("clean_md5"),
    )
    return _drain(stream, "conv_id bigint, turn bigint, n_tokens int, clean_md5 string")


@query(
    "ss5_stream_stylometry",
    f"""
    WITH c AS (SELECT conv_id, turn, array_to_string({tokens_sql('text')}, ' ') AS c
               FROM conversations),
         w AS (SELECT conv_id, turn, {words_sql('c')} AS w FROM c)
    SELECT conv_id, turn, round({BRUNET_SQL}, 6) AS f_brunets_w,
           round({DIVERSITY_SQL}, 6) AS f_lexical_diversity,
           round({WORD_LENGTH_SQL}, 6) AS f_avg_word_length
    FROM w
    """,
)
def stream_stylometry(spark, sf_dir):
    stream = _stream(spark, table(spark, sf_dir, "conversations"))
    clean = stream.withColumn("abstract_clean", T.join_tokens(T.tokenize("text")))
    measures = ["f_brunets_w", "f_lexical_diversity", "f_avg_word_length"]
    features = stylometric_features(clean).select("conv_id", "turn", *measures)
    schema = "conv_id bigint, turn bigint, " + ", ".join(f"{m} double" for m in measures)
    back = _drain(features, schema)
    return back.withColumns({m: F.round(m, 6) for m in measures})


@query(
    "ss3_stream_scoring",
    f"SELECT {digest_sql('text')}, label, 'scored' AS status, true AS same FROM ({TURNS_SQL})",
)
def stream_scoring(spark, sf_dir):
    """The stream's output, probability included, beside a batch over the same turns."""
    model, rows = trained(spark, sf_dir, LOGISTIC).best_model, turns(spark, sf_dir)
    schema = (
        "text string, label int, prediction double, score double, "
        "probability array<double>, status string"
    )
    live = _drain(score_stream(_stream(spark, rows), model), schema, ["status"])
    batch = score(rows, model).select("text", *[F.col(c).alias(f"batch_{c}") for c in SCORED_COLUMNS])
    both = live.join(batch.dropDuplicates(["text"]), "text", "left")
    same = F.lit(True)
    for c in SCORED_COLUMNS:
        same = same & F.col(c).eqNullSafe(F.col(f"batch_{c}"))
    return both.select(*digest(F.col("text")), "label", "status", same.alias("same"))


def _failing(stream: DataFrame) -> DataFrame:
    """The stream with an expression that fails on every third conversation."""
    fault = F.raise_error(F.lit("drill")).cast("boolean")
    return stream.filter(F.coalesce(F.when(F.pmod("conv_id", F.lit(3)) == 1, fault), F.lit(True)))


@query("ss7_restart", f"SELECT conv_id, turn, {digest_sql('text')} FROM conversations")
def restart(spark, sf_dir):
    """Every row once, whatever happens between restarts over the same log.

    The first run's last commit is lost after its sink has committed. The
    second has a batch to do again and fails in the files that came since. The
    third finds more files yet, and finishes.
    """
    rows = table(spark, sf_dir, "conversations")
    part = F.coalesce(F.pmod("conv_id", F.lit(3)), F.lit(0))
    source = shared_folder(spark, "stream-input")
    out, marks = shared_folder(spark, "stream-output"), shared_folder(spark, "stream-log")

    def arrive(k: int) -> bool:
        some = rows.filter(part == k)
        some.write.mode("append").json(source)
        return not some.isEmpty()

    def run(change=lambda stream: stream) -> None:
        stream = read_json_stream(spark, source, rows.schema, files_per_trigger=2)
        drain(write_json_stream(change(stream), out, marks, every=None))

    arrive(0)
    run()
    lost = lose_commit(spark, marks)
    if unfinished_batches(spark, marks) != ([] if lost is None else [lost]):
        raise RuntimeError("the drill lost no commit")
    if arrive(1):
        try:
            run(_failing)
        except StreamingQueryException:
            pass
        if not unfinished_batches(spark, marks):
            raise RuntimeError("the drill failed no batch")
    arrive(2)
    run()
    return spark.read.schema(rows.schema).json(out).select("conv_id", "turn", *digest(F.col("text")))
