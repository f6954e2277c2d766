"""Raw text to clean text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textstyle.functions import profiles as P
from textstyle.functions import text as T
from textstyle.functions.profiles import Profile
from textstyle.functions.stemming import stem_repeated, stem_tokens
from textstyle.operators.terms import stem_with_dictionary
from textstyle.sources.tables import read_table, write_table


def preprocess(
    df: DataFrame,
    text_col: str = "text",
    profile: Profile = P.CORPUS,
    *,
    stopwords: Iterable[str],
    normalize_stopwords: bool = True,
    keep_empty_tokens: bool = False,
    stem_depth: str = "root",
    stem_once: bool = False,
    dictionary: DataFrame | None = None,
) -> DataFrame:
    """Add ``text_clean``, ``words``, ``words_no_stopwords``, ``words_stemmed``
    and ``abstract_clean``.

    ``stopwords`` is the caller's whole list. Rules stem in place, in native
    expressions or, with ``stem_once``, each distinct word of an Arrow batch
    once; a ``dictionary`` of ``(token, stem)`` replaces them.
    """
    clean = T.normalize(text_col, profile)
    if profile.strip_web:
        clean = T.clean_text(clean, profile.script)
        clean = F.trim(F.lower(clean))
    tokenize = T.tokenize_keep_empty if keep_empty_tokens else T.tokenize
    if normalize_stopwords:
        stopwords = T.fold_stopwords(stopwords, profile)
    kept = T.remove_stopwords(
        "words",
        stopwords,
        min_length=profile.min_token_length,
        case_sensitive=profile.case_sensitive_stopwords,
    )
    df = (
        df.withColumn("text_clean", clean)
        .withColumn("words", tokenize("text_clean"))
        .withColumn("words_no_stopwords", kept)
    )
    if dictionary is not None:
        df = stem_with_dictionary(df, "words_no_stopwords", dictionary, "words_stemmed")
    else:
        stem = stem_repeated if stem_once else stem_tokens
        stems = stem(F.col("words_no_stopwords"), depth=stem_depth, has_vowels=False)
        df = df.withColumn("words_stemmed", stems)
    return df.withColumn("abstract_clean", T.join_tokens("words_stemmed"))


def load_and_preprocess(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    profile: Profile = P.CORPUS,
    **options,
) -> DataFrame:
    """Read Parquet, preprocess, write; the result reads the written table.

    ``options`` are those of :func:`preprocess`, ``stopwords`` among them;
    each distinct word of a batch is stemmed once if they do not say otherwise.
    """
    options = {"stem_once": True} | options
    clean = preprocess(read_table(spark, input_path), "text", profile, **options)
    write_table(clean, output_path)
    return read_table(spark, output_path, schema=clean.schema)
