"""Text expressions: normalise, clean, tokenise, stopwords, n-grams.

NULL text is an empty text and a NULL token array is an empty array, so none
of these can fail a job on a bad row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from textstyle.functions import profiles as P
from textstyle.functions.profiles import Profile

_SPACE = f"[{P.SPACE}]"
_NON_SPACE = f"[^{P.SPACE}]"


def _text(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def _tokens(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col, F.array().cast("array<string>"))


# --- normalisation -----------------------------------------------------------


def normalize_letters(col: Column | str, profile: Profile = P.CORPUS) -> Column:
    """Fold letter variants in one pass over the text."""
    letters = profile.letters
    return F.translate(_text(col), "".join(letters), "".join(letters.values()))


def remove_diacritics(col: Column | str) -> Column:
    return F.regexp_replace(_text(col), f"[{P.DIACRITICS}]+", "")


def normalize(col: Column | str, profile: Profile = P.CORPUS) -> Column:
    """Letters folded and diacritics removed, together in one pass.

    ``translate`` deletes the characters that have no counterpart.
    """
    letters = profile.letters
    source = "".join(letters) + P.DIACRITICS
    return F.translate(_text(col), source, "".join(letters.values()))


# --- cleaning ------------------------------------------------------------------


def remove_urls(col: Column | str) -> Column:
    return F.regexp_replace(_text(col), f"{P.UNICODE}(?:http|www){_NON_SPACE}++", "")


def remove_emails(col: Column | str) -> Column:
    """Drop each whitespace-delimited run that holds an inner ``@``.

    Anchored at the start of the run and possessive up to the first ``@``: the
    plain form retries from every character and is quadratic on long junk runs.
    Texts without any ``@`` skip the search.
    """
    text = _text(col)
    pattern = (
        f"{P.UNICODE}(?<!{_NON_SPACE}){_NON_SPACE}[^@{P.SPACE}]*+@{_NON_SPACE}++"
    )
    return F.when(
        F.contains(text, F.lit("@")), F.regexp_replace(text, pattern, "")
    ).otherwise(text)


def remove_mentions(col: Column | str) -> Column:
    return F.regexp_replace(_text(col), f"@[{P.WORD_CHARS}]+", "")


def keep_script(col: Column | str, script: str = P.ARABIC_SCRIPT) -> Column:
    """Blank out every character outside script, digits and basic punctuation."""
    kept = f"{script}{P.SPACE}{P.DIGITS}{P.KEPT_PUNCTUATION}"
    return F.regexp_replace(_text(col), f"{P.UNICODE}[^{kept}]", " ")


def squeeze_whitespace(col: Column | str) -> Column:
    return F.trim(F.regexp_replace(_text(col), f"{P.UNICODE}{_SPACE}+", " "))


def clean_text(col: Column | str, script: str = P.ARABIC_SCRIPT) -> Column:
    """Links, addresses, mentions, foreign script and extra spaces removed.

    Blanking foreign characters and squeezing spaces are one regex here: any
    run of characters that are not kept ends up as a single space.
    """
    bare = remove_mentions(remove_emails(remove_urls(col)))
    kept = f"{script}{P.DIGITS}{P.KEPT_PUNCTUATION}"
    return F.trim(F.regexp_replace(bare, f"[^{kept}]+", " "))


# --- tokens ----------------------------------------------------------------------


def tokenize(col: Column | str) -> Column:
    """Lower-cased tokens between ASCII whitespace, without empty tokens."""
    parts = F.split(F.lower(_text(col)), f"[{P.ASCII_SPACE}]+")
    return F.array_remove(parts, "")


def tokenize_keep_empty(col: Column | str) -> Column:
    """As MLlib's ``Tokenizer``: one split per space, only trailing empties go."""
    lowered = F.lower(_text(col))
    body = F.regexp_replace(lowered, f"[{P.ASCII_SPACE}]++$", "")
    nothing_left = (body == "") & (lowered != "")
    return F.when(nothing_left, F.array().cast("array<string>")).otherwise(
        F.split(body, f"[{P.ASCII_SPACE}]")
    )


def words(col: Column | str) -> Column:
    """Case-preserving words between any Unicode whitespace."""
    return F.array_remove(F.split(_text(col), f"{P.UNICODE}{_SPACE}+"), "")


def remove_stopwords(
    tokens: Column | str,
    stopwords: Iterable[str],
    *,
    min_length: int = 1,
    case_sensitive: bool = True,
) -> Column:
    """Keep tokens that are not listed and have at least ``min_length`` letters."""
    listed = sorted(set(stopwords))
    if not case_sensitive:
        listed = sorted({w.lower() for w in listed})

    def keep(token: Column) -> Column:
        probe = token if case_sensitive else F.lower(token)
        kept = ~probe.isin(listed) if listed else F.lit(True)
        return kept & (F.length(token) >= min_length) if min_length > 1 else kept

    return F.filter(_tokens(tokens), keep)


def fold_stopwords(stopwords: Iterable[str], profile: Profile) -> list[str]:
    """Stopwords written as the normalised text writes them.

    Lists usually keep hamza and final-letter forms that normalised text no
    longer has; without folding such words can never match.
    """
    table = str.maketrans(
        {**profile.letters, **{mark: None for mark in P.DIACRITICS}}
    )
    return sorted({word.translate(table) for word in stopwords})


def join_tokens(tokens: Column | str) -> Column:
    return F.concat_ws(" ", F.col(tokens) if isinstance(tokens, str) else tokens)


def ngrams(tokens: Column | str, n: int = 2) -> Column:
    """Space-joined runs of ``n`` tokens; fewer than ``n`` tokens give none.

    Shifted copies of the array are glued pairwise, so that an expression
    given as ``tokens`` is evaluated per row and not per element.
    """
    tokens = _tokens(tokens)
    runs = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
    joined = F.slice(tokens, 1, runs)
    for shift in range(2, n + 1):
        joined = F.zip_with(
            joined, F.slice(tokens, shift, runs), lambda a, b: F.concat_ws(" ", a, b)
        )
    return joined


def chars_per_part(col: Column | str) -> Column:
    """Characters, spaces included, per space-separated part."""
    text = _text(col)
    return F.length(text) / F.size(F.split(text, " "))
