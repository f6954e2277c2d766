"""Sources, sinks, reshaping, quality, sampling and splitting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textstyle.catalog.registry import (
    WIDE_SQL,
    digest,
    digest_sql,
    labelled_documents,
    query,
    table,
    tokens_sql,
    wide_conversations,
)
from textstyle.functions import text as T
from textstyle.operators import ordering as O
from textstyle.operators import quality as Q
from textstyle.operators import reshape as R
from textstyle.session import shared_folder
from textstyle.sources import tables as IO

def _ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, written with a folder for each language and read back."""
    root = shared_folder(spark, "splits")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    IO.ingest_table(docs, root, "lang")
    return IO.read_splits(spark, root, "doc_id bigint, text string, source string")


def _round_trip(df: DataFrame, fmt: str, schema=None, **options) -> DataFrame:
    spark, path = df.sparkSession, shared_folder(df.sparkSession, f"table-{fmt}")
    IO.write_table(df, path, fmt)
    return IO.read_table(spark, path, fmt, schema, **options)


DOCUMENTS_SQL = f"""
    SELECT doc_id, lang, source, n_chars, {digest_sql('text')} FROM documents
"""
LABELLED_SQL = """
    SELECT d.doc_id, d.text, l.quality AS label
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""


def _summary(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", "lang", "source", "n_chars", *digest(F.col("text"))
    )


@query("io1_parquet_scan", DOCUMENTS_SQL)
def parquet_scan(spark, sf_dir):
    return _summary(IO.read_table(spark, f"{sf_dir}/documents.parquet"))


@query("io2_parquet_write", DOCUMENTS_SQL)
def parquet_write(spark, sf_dir):
    return _summary(_round_trip(table(spark, sf_dir, "documents"), "parquet"))


@query(
    "io3_csv_read",
    f"""
    SELECT doc_id::VARCHAR AS doc_id, lang, source, n_chars::VARCHAR AS n_chars,
           {digest_sql('text')} FROM documents
    """,
)
def csv_read(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return _summary(_round_trip(docs, "csv", multiline=True))


@query(
    "io4_csv_report",
    """
    SELECT quality::VARCHAR AS label, count(*)::VARCHAR AS count
    FROM labels GROUP BY quality
    """,
)
def csv_report(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    path = shared_folder(spark, "report")
    counts = Q.class_distribution(labels.withColumnRenamed("quality", "label"))
    IO.write_table(counts, path, "csv", single_file=True)
    return IO.read_table(spark, path, "csv")


@query(
    "io5_json_read",
    f"""
    SELECT doc_id, lang, source, n_chars, {digest_sql('text')}, false AS malformed
    FROM documents
    """,
)
def json_read(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = shared_folder(spark, "table-json")
    IO.write_table(docs, path, "json")
    lines = IO.read_json_lines(spark, path, docs.schema)
    return lines.select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        *digest(F.col("text")),
        F.col(IO.CORRUPT).isNotNull().alias("malformed"),
    )


@query(
    "io6_json_write",
    f"SELECT conv_id, turn, role, {digest_sql('text')} FROM conversations",
)
def json_write(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    back = _round_trip(turns, "json", turns.schema)
    return back.select("conv_id", "turn", "role", *digest(F.col("text")))


@query(
    "io7_format_dispatch",
    f"""
    SELECT fmt, item_id, {digest_sql('text')}
    FROM benchmark, (VALUES ('parquet'), ('csv'), ('json')) f(fmt)
    """,
)
def format_dispatch(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark")
    schema = "item_id bigint, text string"
    parts = [
        _round_trip(items, fmt, schema, **({"multiline": True} if fmt == "csv" else {})).select(
            F.lit(fmt).alias("fmt"), "item_id", *digest(F.col("text"))
        )
        for fmt in ("parquet", "csv", "json")
    ]
    return R.stack_tables(parts)


@query(
    "io8_ingest_splits",
    f"SELECT lang AS source, doc_id, {digest_sql('text')} FROM documents",
)
def ingest_splits(spark, sf_dir):
    return _ingested(spark, sf_dir).select("source", "doc_id", *digest(F.col("text")))


@query(
    "io9_verify_splits",
    """
    SELECT lang AS source, count(*) AS n_rows, 2 AS n_cols
    FROM documents GROUP BY lang
    """,
)
def verify_splits(spark, sf_dir):
    return IO.verify_table(_ingested(spark, sf_dir))


# --- projection, reshaping, set operations ---------------------------------------


@query(
    "pr1_tag_source",
    "SELECT item_id, length(text)::INTEGER AS n, 'benchmark' AS source FROM benchmark",
)
def tag_source(spark, sf_dir):
    items = R.tag_source(table(spark, sf_dir, "benchmark"), "benchmark")
    return items.select("item_id", F.length("text").alias("n"), "source")


@query("pr2_project", f"SELECT doc_id AS id, lang AS language, {digest_sql('text')} FROM documents")
def project(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.col("doc_id").alias("id"),
        F.col("lang").alias("language"),
        *digest(F.col("text")),
    )


@query("pr3_filter_class", "SELECT doc_id, quality AS label FROM labels WHERE quality = 0")
def filter_class(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return R.of_class(labels.select("doc_id", F.col("quality").alias("label")), 0)


@query(
    "pr4_wide_to_long",
    f"""
    WITH w AS ({WIDE_SQL}),
         l AS (SELECT conv_id, k, 'user' AS generator, "user" AS text, 0 AS label FROM w
               UNION ALL SELECT conv_id, k, 'assistant', assistant, 1 FROM w
               UNION ALL SELECT conv_id, k, 'system', system, 1 FROM w)
    SELECT conv_id, k, generator, label, text IS NULL AS missing, {digest_sql('text')} FROM l
    """,
)
def wide_to_long(spark, sf_dir):
    wide = wide_conversations(spark, sf_dir)
    long = R.wide_to_long(wide, "user", ["assistant", "system"], ["conv_id", "k"])
    return long.select(
        "conv_id",
        "k",
        "generator",
        "label",
        F.col("text").isNull().alias("missing"),
        *digest(F.col("text")),
    )


@query(
    "st1_union_by_name",
    f"""
    WITH u AS (SELECT 'documents' AS source, doc_id AS id, text FROM documents
               UNION ALL SELECT 'benchmark', item_id, text FROM benchmark
               UNION ALL SELECT 'pages', page_id, html FROM pages)
    SELECT source, id, {digest_sql('text')} FROM u
    """,
)
def union_by_name(spark, sf_dir):
    names = {"documents": ("doc_id", "text"), "benchmark": ("item_id", "text"), "pages": ("page_id", "html")}
    splits = {
        name: table(spark, sf_dir, name).select(F.col(text).alias("text"), F.col(key).alias("id"))
        for name, (key, text) in names.items()
    }
    return R.combine_splits(splits).select("source", "id", *digest(F.col("text")))


@query(
    "st2_union_all",
    f"""
    WITH u AS (SELECT text, 0 AS label FROM documents
               UNION ALL SELECT text, 0 FROM benchmark
               UNION ALL SELECT text, 1 FROM conversations)
    SELECT label, {digest_sql('text')} FROM u
    """,
)
def union_all(spark, sf_dir):
    parts = [
        table(spark, sf_dir, name).select(F.col("text"), F.lit(label).alias("label"))
        for name, label in (("documents", 0), ("benchmark", 0), ("conversations", 1))
    ]
    return R.stack_tables(parts).select("label", *digest(F.col("text")))


@query(
    "pr5_lower_trim",
    f"""
    WITH p AS (SELECT doc_id, trim(lower('  ' || text || ' ')) AS t FROM documents)
    SELECT doc_id, {digest_sql('t')} FROM p
    """,
)
def lower_trim(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    padded = F.concat(F.lit("  "), F.col("text"), F.lit(" "))
    return docs.select("doc_id", *digest(F.trim(F.lower(padded))))


@query(
    "pr6_join_tokens",
    f"""
    WITH p AS (SELECT doc_id, array_to_string({tokens_sql('text')}, ' ') AS t
               FROM documents)
    SELECT doc_id, {digest_sql('t')} FROM p
    """,
)
def join_tokens(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", *digest(T.join_tokens(T.tokenize("text"))))


@query(
    "pr7_chars_per_part",
    """
    SELECT doc_id, round(length(text) / len(string_split(text, ' ')), 6) AS chars_per_part
    FROM documents
    """,
)
def chars_per_part(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.round(T.chars_per_part("text"), 6).alias("chars_per_part"))


@query(
    "pr8_explode_tokens",
    f"""
    WITH e AS (SELECT lang, unnest({tokens_sql('text')}) AS token FROM documents)
    SELECT lang, count(*) AS n_tokens, sum(length(token))::BIGINT AS n_letters
    FROM e GROUP BY lang
    """,
)
def explode_tokens(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    tokens = R.explode_tokens(docs, T.tokenize("text"), "token", "lang")
    return tokens.groupBy("lang").agg(
        F.count("token").alias("n_tokens"), F.sum(F.length("token")).alias("n_letters")
    )


# --- quality ------------------------------------------------------------------------


@query("ag1_table_shape", "SELECT count(*) AS n_rows, 5 AS n_cols FROM documents")
def table_shape(spark, sf_dir):
    return Q.table_shape(table(spark, sf_dir, "documents"))


@query(
    "ag2_class_distribution",
    f"SELECT label, count(*) AS count FROM ({LABELLED_SQL}) GROUP BY label",
)
def class_distribution(spark, sf_dir):
    return Q.class_distribution(labelled_documents(spark, sf_dir))


@query(
    "ag3_null_counts",
    f"""
    WITH w AS ({WIDE_SQL})
    SELECT 'conv_id' AS "column", count(*) - count(conv_id) AS nulls FROM w
    UNION ALL SELECT 'user', count(*) - count("user") FROM w
    UNION ALL SELECT 'assistant', count(*) - count(assistant) FROM w
    UNION ALL SELECT 'system', count(*) - count(system) FROM w
    UNION ALL SELECT 'k', 0
    """,
)
def null_counts(spark, sf_dir):
    return Q.null_counts(wide_conversations(spark, sf_dir))


@query(
    "ag4_null_counts_by_sum",
    """
    SELECT 'doc_id' AS "column", sum((doc_id IS NULL)::INT)::BIGINT AS nulls FROM j
    UNION ALL SELECT 'text', sum((text IS NULL)::INT)::BIGINT FROM j
    UNION ALL SELECT 'quality', sum((quality IS NULL)::INT)::BIGINT FROM j
    """.replace(
        "FROM j",
        "FROM (SELECT d.doc_id, d.text, l.quality FROM documents d "
        "LEFT JOIN labels l ON d.doc_id = l.doc_id)",
    ),
)
def null_counts_by_sum(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return Q.null_counts(docs.join(labels, "doc_id", "left"))


@query(
    "ag5_quality_report",
    """
    WITH n AS (SELECT count(*) AS n, count(conv_id) AS a, count(turn) AS b,
                      count(role) AS c, count(text) AS d FROM conversations)
    SELECT 'conv_id' AS "column", 'bigint' AS "type", n - a AS nulls, n AS n_rows FROM n
    UNION ALL SELECT 'turn', 'bigint', n - b, n FROM n
    UNION ALL SELECT 'role', 'string', n - c, n FROM n
    UNION ALL SELECT 'text', 'string', n - d, n FROM n
    """,
)
def quality_report(spark, sf_dir):
    return Q.quality_report(table(spark, sf_dir, "conversations"))


# --- samples, limits, splits ------------------------------------------------------


@query(
    "so1_class_sample",
    f"""
    WITH r AS (SELECT doc_id, label, text, row_number() OVER (
                   PARTITION BY label ORDER BY md5(doc_id::VARCHAR), doc_id::VARCHAR) AS n
               FROM ({LABELLED_SQL}))
    SELECT doc_id, label, {digest_sql('text')} FROM r WHERE n <= 50
    """,
)
def class_sample(spark, sf_dir):
    docs = labelled_documents(spark, sf_dir).select("doc_id", "label", "text")
    sample = O.sample_per_class(docs, 50, "doc_id", [0, 1])
    return sample.select("doc_id", "label", *digest(F.col("text")))


@query(
    "so2_first_rows",
    f"SELECT doc_id, {digest_sql('text')} FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 100)",
)
def first_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return O.first_rows(docs, 100, "doc_id").select("doc_id", *digest(F.col("text")))


SPLIT_SLOT_SQL = "(('0x' || substr(md5({key}), 1, 8))::BIGINT % 100)"


@query(
    "sa1_hash_split",
    f"""
    WITH s AS (SELECT doc_id, {SPLIT_SLOT_SQL.format(key='md5(text)')} AS slot FROM documents)
    SELECT doc_id, CASE WHEN slot < 70 THEN 'train' WHEN slot < 85 THEN 'validation'
                        ELSE 'test' END AS split
    FROM s
    """,
)
def hash_split(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return O.assign_split(docs, F.md5("text")).select("doc_id", "split")


@query("sa1_random_split", "SELECT doc_id, lang, 1::BIGINT AS n_parts FROM documents")
def random_split(spark, sf_dir):
    """Every document is in one part; which one hangs on Spark's seed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    parts = O.random_split(docs)
    rows = R.combine_splits(dict(zip(("train", "validation", "test"), parts)))
    return rows.groupBy("doc_id", "lang").agg(F.count("source").alias("n_parts"))


# Keys of which every seventh is missing, in the query and in its twin.
@query(
    "so2_first_rows_null_keys",
    """
    SELECT key FROM (SELECT nullif(doc_id, doc_id // 7 * 7) AS key FROM documents)
    ORDER BY key NULLS FIRST LIMIT 300
    """,
)
def first_rows_null_keys(spark, sf_dir):
    key = F.expr("nullif(doc_id, doc_id div 7 * 7)").alias("key")
    return O.first_rows(table(spark, sf_dir, "documents").select(key, "text"), 300, "key").select("key")
