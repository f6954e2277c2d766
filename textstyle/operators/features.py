"""The stylometric feature table and its summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textstyle.functions import profiles as P
from textstyle.functions import stylometry as S
from textstyle.functions import text as T

FEATURES = (
    "f_brunets_w",
    "f_named_entities",
    "f_lexical_diversity",
    "f_avg_word_length",
)


def stylometric_features(
    df: DataFrame,
    clean_col: str = "abstract_clean",
    raw_col: str = "text",
    gazetteer: Mapping[str, Sequence[str]] = P.LARGE_GAZETTEER,
) -> DataFrame:
    """Add the four features; the clean text is split into words once.

    Entities are counted on the raw text, whose spelling the gazetteer keeps.
    """
    words, types = F.col("_words"), F.col("_types")
    return (
        df.withColumn("_words", T.words(clean_col))
        .withColumn("_types", S.n_types(words))
        .withColumn("f_brunets_w", S.brunets_w(words, types))
        .withColumn("f_named_entities", S.entity_count(raw_col, gazetteer))
        .withColumn("f_lexical_diversity", S.lexical_diversity(words, types))
        .withColumn("f_avg_word_length", S.avg_word_length(words))
        .drop("_words", "_types")
    )


def feature_summary(
    df: DataFrame, features: Sequence[str] = FEATURES, by: Sequence[str] = ()
) -> DataFrame:
    """``(by…, feature, count, mean, stddev, min, max)`` from one aggregation."""
    stats = {
        "count": F.count,
        "mean": F.avg,
        "stddev": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    values = {f: F.col(f).cast("double") for f in features}
    wide = df.groupBy(*by).agg(
        *[fn(values[f]).alias(f"{f}__{s}") for f in features for s, fn in stats.items()]
    )
    rows = [
        F.struct(
            F.lit(f).alias("feature"), *[F.col(f"{f}__{s}").alias(s) for s in stats]
        )
        for f in features
    ]
    return wide.select(*by, F.inline(F.array(*rows)))
