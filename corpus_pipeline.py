"""From raw documents to packed sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from textstyle.llm import decontaminate, jaccard, language, packing, quality
from textstyle.llm.tables import fold_of, table
from textstyle.session import delete_folders, write_through

#: Below it the language model knows no language for a text.
MIN_LANGUAGE = 0.3
#: Below it a text is of low quality.
MIN_QUALITY = 0.5
#: Near copies: Jaccard similarity in percent, of shingles of so many words.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts in one of the languages that the documents name.

    The model learns from the documents outside its held-out third. Texts
    that are null or have no letter go; where no document names a language,
    nothing else does.
    """
    model = language.train(docs.where(fold_of("doc_id", 3) != 1), key=["doc_id"])
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language.identify(docs, model)
    good = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE)
    return found.where(good).select(docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts that the byte network, fitted on the labels, finds good."""
    labels = table(spark, sf_dir, "labels").where(fold_of("doc_id", 4) != 2)
    rated = quality.rate(docs, quality.train(docs, labels))
    return rated.where(F.col("score") >= MIN_QUALITY).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group of near copies.

    Rows that repeat an id and text are one document. Those without id come
    after all others, and texts with one id in the order of their hashes.
    """
    key = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", F.xxhash64("text").alias("h"))
    name = "_near_key"
    while name in docs.columns:
        name += "_"
    keyed, paths = docs.withColumn(name, key), []
    near = jaccard.near_classes(
        keyed, id_col=name, words=NEAR_WORDS, percent=NEAR_PERCENT, paths=paths
    )
    kept = near.where(F.col(name).eqNullSafe(F.col("component_id"))).select(name).distinct()
    kept = write_through(kept, "kept-of-near")
    delete_folders(spark, paths)
    return keyed.join(kept, name, "left_semi").drop(name).dropDuplicates(["doc_id", "text"])


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents without any window of a benchmark item."""
    hits = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"))
    return hits.where("n_hit = 0").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token piece's place in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language ID", known_language),
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", uncontaminated),
    ("best-fit packing", packed),
]

#: Trained models and packing have no SQL twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_through(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
