"""Query registration and the inputs that queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

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


# --- Arabic-script text from the Latin test documents --------------------------

# A letter-for-letter rewriting, diacritics included.
LATIN = "aeioubcdfghklmnprstwyqjvxz"
ARABIC = "أإآىةبجدفغهكلمنگرستويؤئًْؗ"
# Frequent words that become names and titles.
NAMES = {
    " the ": " محمد ",
    " of ": " مصر ",
    " with ": " الرياض ",
    " le ": " إبراهيم ",
    " la ": " تونس ",
    " der ": " دبي ",
    "e. ": "أ. د. ",
    "n. ": "د. ",
}
# A few words that the documents use often.
STOPWORDS = [
    "the", "and", "of", "to", "in", "on", "with", "by", "for", "that",
    "le", "la", "un", "de", "der", "die", "el", "los", "A", "Is",
]


def arabic_script(col: str = "text") -> Column:
    return F.translate(F.lower(col), LATIN, ARABIC)


def arabic_script_sql(col: str = "text") -> str:
    return f"translate(lower({col}), '{LATIN}', '{ARABIC}')"


def with_names(col: str = "text") -> Column:
    text = F.col(col)
    for word, name in NAMES.items():
        text = F.replace(text, F.lit(word), F.lit(name))
    return text


def with_names_sql(col: str = "text") -> str:
    for word, name in NAMES.items():
        col = f"replace({col}, '{word}', '{name}')"
    return col


def arabic_stopwords() -> list[str]:
    return [w.lower().translate(str.maketrans(LATIN, ARABIC)) for w in STOPWORDS]


def arabic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", arabic_script().alias("text"))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text, label)``: documents that carry a quality label."""
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").alias("label")
    )
    return table(spark, sf_dir, "documents").join(labels, "doc_id")


def wide_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation's exchanges: ``conv_id, k, user, assistant, system``.

    Beside each other stand the ``k``-th texts of each role.
    """
    turns = table(spark, sf_dir, "conversations")
    along = Window.partitionBy("conv_id", "role").orderBy("turn")
    return (
        turns.withColumn("k", F.row_number().over(along))
        .groupBy("conv_id", "k")
        .pivot("role", ["user", "assistant", "system"])
        .agg(F.min("text"))
    )


WIDE_SQL = """
    SELECT conv_id, k, min(text) FILTER (WHERE role = 'user') AS "user",
           min(text) FILTER (WHERE role = 'assistant') AS assistant,
           min(text) FILTER (WHERE role = 'system') AS system
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn)::INTEGER AS k
          FROM conversations)
    GROUP BY conv_id, k
"""


def tokens_sql(text: str) -> str:
    return (
        f"list_filter(regexp_split_to_array(lower({text}), '[\\t-\\r ]+'), "
        "lambda x: x <> '')"
    )


def digest(col: Column, name: str = "text") -> list[Column]:
    """A whole text as its length and MD5, so that results stay small."""
    return [F.length(col).alias(f"{name}_length"), F.md5(col).alias(f"{name}_md5")]


def digest_sql(expr: str, name: str = "text") -> str:
    return f"length({expr})::INTEGER AS {name}_length, md5({expr}) AS {name}_md5"


def document_text(expression: Callable[[Column], Column]):
    """A query giving the digest of an expression over every Arabic-script text."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = arabic_documents(spark, sf_dir)
        return docs.select("doc_id", *digest(expression(F.col("text"))))

    return run


def document_text_sql(expression: str) -> str:
    """The SQL twin; ``expression`` refers to the text as ``t``."""
    return f"""
        WITH d AS (SELECT doc_id, {arabic_script_sql()} AS t FROM documents),
             r AS (SELECT doc_id, {expression} AS t FROM d)
        SELECT doc_id, {digest_sql('t')} FROM r
    """
