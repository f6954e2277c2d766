"""Stylometric measures of one text, each a native expression."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from textstyle.functions import profiles as P


def n_types(words: Column) -> Column:
    return F.size(F.array_distinct(words))


def brunets_w(words: Column, types: Column | None = None) -> Column:
    """N ** (V ** -0.165) for N tokens of V types; 0 below two tokens.

    ``types`` is V where it is a column already.
    """
    n, v = F.size(words), n_types(words) if types is None else types
    w = F.pow(n.cast("double"), F.pow(v.cast("double"), F.lit(P.BRUNET_EXPONENT)))
    return F.when(n > 1, w).otherwise(F.lit(0.0))


def lexical_diversity(words: Column, types: Column | None = None) -> Column:
    n, v = F.size(words), n_types(words) if types is None else types
    return F.when(n > 0, v / n).otherwise(F.lit(0.0))


def avg_word_length(words: Column) -> Column:
    n = F.size(words)
    letters = F.length(F.array_join(words, ""))
    return F.when(n > 0, letters / n).otherwise(F.lit(0.0))


def entity_count(
    text: Column | str,
    gazetteer: Mapping[str, Sequence[str]] = P.LARGE_GAZETTEER,
    patterns: Sequence[str] = P.ENTITY_PATTERNS,
) -> Column:
    """Matches of each pattern plus whole-word hits of each listed name."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    total = F.lit(0)
    for pattern in patterns:
        total = total + F.regexp_count(text, F.lit(pattern))
    return (total + _listed_words(text, gazetteer)).cast("int")


def _listed_words(text: Column, gazetteer: Mapping[str, Sequence[str]]) -> Column:
    """Hits of all lists; a name in two lists counts twice.

    One-word names are looked up in a hash set after a single split at
    non-word characters, which costs the same for any number of names. Names
    of several words need a regular expression.
    """
    times = Counter(name for names in gazetteer.values() for name in names)
    one_word = re.compile(r"\w+")
    total = F.lit(0)
    for n in sorted(set(times.values())):
        names = [name for name, count in times.items() if count == n]
        single = [name for name in names if one_word.fullmatch(name)]
        several = [name for name in names if not one_word.fullmatch(name)]
        if single:
            words = F.split(text, f"[^{P.WORD_CHARS}]+")
            total = total + n * F.size(F.filter(words, lambda w: w.isin(single)))
        for name in several:
            total = total + n * F.regexp_count(text, F.lit(_whole(name)))
    return total


def _whole(name: str) -> str:
    return f"(?<![{P.WORD_CHARS}]){re.escape(name)}(?![{P.WORD_CHARS}])"
