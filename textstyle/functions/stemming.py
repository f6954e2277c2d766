"""Arabic root extraction, word by word, in native expressions.

After Taghva, Elkhoury and Coombs, "Arabic stemming without a root dictionary"
(2005): strip long affixes, then match the word against morphological patterns
of its own length, shortening it by one short affix where no pattern fits.

Patterns are written in the usual grammarian's notation, where the letters
fa, ain and lam stand for root letters. Each word length becomes one regular
expression whose alternatives are tried in the written order. The steps run
inside the row as a chain of array transforms; a step looks at the length
first, so a word meets only the few expressions made for it. Where words come
again and again, :func:`stem_repeated` applies the same steps once to each
distinct word of a batch.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: affixes --------------------------------------------------
LONG_PREFIXES = ["كال", "بال", "ولل", "وال", "ال", "لل"]
LONG_SUFFIXES = [
    "تمل", "همل", "تان", "تين", "كمل",
    "ون", "ات", "ان", "ين", "تن", "كم", "هن", "نا",
    "يا", "ها", "تم", "كن", "ني", "وا", "ما", "هم",
]
SHORT_SUFFIXES = "ةهيكتان"
SHORT_PREFIXES = "لبفسويتنا"

# --- Fixed values: patterns by word length, in order of precedence ------------
PATTERNS_4 = ["مفعل", "فاعل", "فعال", "فعول", "فعيل", "فعلة"]
PATTERNS_5 = [
    "افتعل", "افاعل", "مفعول", "مفعال", "مفعيل", "مفعلة", "تفعلة", "افعلة",
    "مفتعل", "يفتعل", "تفتعل", "مفاعل", "تفاعل", "فعولة", "فعالة",
    "انفعل", "منفعل", "افعال", "فعلان", "تفعيل", "فاعول", "فواعل",
    "فعائل", "فاعلة", "فعالي",
]
PATTERNS_6 = ["استفعل", "مستفعل", "مفعالة", "افتعال", "افعوعل", "تفاعيل"]
FOUR_LETTER_ROOTS = ["تفعلل", "افعلل", "مفعلل", "فعللة", "فعالل", "متفعلل"]

# --- Fixed values: function words that are left whole -------------------------
WHOLE_WORDS = [
    "يكون", "وليس", "وكان", "كذلك", "التي", "وبين", "عليها", "مساء", "الذي",
    "وكانت", "ولكن", "والتي", "تكون", "اليوم", "اللذين", "عليه", "كانت",
    "لذلك", "أمام", "هناك", "منها", "مازال", "لازال", "لايزال", "مايزال",
    "اصبح", "أصبح", "أمسى", "امسى", "أضحى", "اضحى", "مابرح", "مافتئ",
    "ماانفك", "لاسيما", "ولايزال", "الحالي", "اليها", "الذين", "فانه",
    "والذي", "وهذا", "لهذا", "فكان", "ستكون", "اليه", "يمكن", "بهذا", "الذى",
]

_SHORT_VOWELS = "".join(chr(c) for c in range(0x064B, 0x0653))
_ROOT_LETTERS = "فعل"

Step = Callable[[Column], Column]


def _pattern_regexes(patterns: Sequence[str]) -> list[str]:
    """Capture root letters in a run; ain written twice must be one letter.

    Lam written twice is two root letters, as four-letter roots have no
    further letter of their own in the notation.
    """
    regexes = []
    for pattern in patterns:
        body, ain = "", False
        for letter in pattern:
            if letter == "ع" and ain:
                body += r"\k<ain>"
            elif letter == "ع" and pattern.count("ع") > 1:
                body, ain = body + "(?<ain>.)", True
            elif letter in _ROOT_LETTERS:
                body += "(.)"
            else:
                body += letter
        regexes.append(body)
    return regexes


def _short_affixes(length: int) -> list[str]:
    rest = f"(.{{{length - 1}}})"
    return [f"{rest}[{SHORT_SUFFIXES}]", f"[{SHORT_PREFIXES}]{rest}"]


def _fits(length: int, alternatives: Sequence[str]) -> Step:
    """Reduce words of one length to the letters an alternative captures."""
    body = "|".join(alternatives)
    groups = re.findall(r"\((?!\?)|\(\?<ain>", body)
    kept = "".join(f"${i}" for i in range(1, len(groups) + 1))
    return lambda word: F.when(
        F.length(word) == length, F.regexp_replace(word, f"(?s)^(?:{body})\\z", kept)
    ).otherwise(word)


#: Word length and alternatives of each step to the root, in order.
_ROOT_STEPS = [
    (7, _short_affixes(7)),
    (6, _pattern_regexes(PATTERNS_6) + _short_affixes(6)),
    (5, _pattern_regexes(PATTERNS_5) + _short_affixes(5)),
    (4, _pattern_regexes(PATTERNS_4) + _short_affixes(4)),
    # What still has five or six letters fitted nothing above.
    (6, _pattern_regexes([p for p in FOUR_LETTER_ROOTS if len(p) == 6])),
    (5, _pattern_regexes([p for p in FOUR_LETTER_ROOTS if len(p) == 5])),
]


def _sized(affixes: Sequence[str], size: int) -> list[str]:
    return [affix for affix in affixes if len(affix) == size]


def _strip_long_prefix(word: Column) -> Column:
    """Off with a prefix if at least three letters stay."""
    return (
        F.when(
            (F.length(word) >= 6) & F.left(word, F.lit(3)).isin(_sized(LONG_PREFIXES, 3)),
            F.substr(word, F.lit(4)),
        )
        .when(
            (F.length(word) >= 5) & F.left(word, F.lit(2)).isin(_sized(LONG_PREFIXES, 2)),
            F.substr(word, F.lit(3)),
        )
        .otherwise(word)
    )


def _strip_long_suffix(word: Column) -> Column:
    n = F.length(word)
    return (
        F.when(
            (n >= 6) & F.right(word, F.lit(3)).isin(_sized(LONG_SUFFIXES, 3)),
            F.left(word, n - 3),
        )
        .when(
            (n >= 5) & F.right(word, F.lit(2)).isin(_sized(LONG_SUFFIXES, 2)),
            F.left(word, n - 2),
        )
        .otherwise(word)
    )


def _plain_start(word: Column) -> Column:
    """One connective waw instead of two; a bare alif for an initial hamza."""
    hamza = word.startswith("آ") | word.startswith("أ") | word.startswith("إ")
    return (
        F.when(word.startswith("وو") & (F.length(word) >= 4), F.substr(word, F.lit(2)))
        .when(hamza, F.concat(F.lit("ا"), F.substr(word, F.lit(2))))
        .otherwise(word)
    )


def _check_depth(depth: str) -> None:
    if depth not in ("root", "light"):
        raise ValueError(f"unknown stemming depth: {depth}")


def stem_tokens(
    tokens: Column,
    *,
    depth: str = "root",
    whole_words: Sequence[str] = WHOLE_WORDS,
    has_vowels: bool = True,
) -> Column:
    """Stem an array of tokens in place, keeping order and count.

    ``depth`` is ``root`` or ``light`` (long affixes only). Text that went
    through ``normalize`` has no vowel marks left: say so to save a step.
    """
    _check_depth(depth)
    if has_vowels:
        tokens = F.transform(tokens, lambda w: F.translate(w, _SHORT_VOWELS, ""))
    steps: list[Step] = [_strip_long_prefix, _strip_long_suffix, _plain_start]
    if depth == "root":
        steps += [_fits(length, alternatives) for length, alternatives in _ROOT_STEPS]
    stems = tokens
    for step in steps:
        stems = F.transform(stems, step)
    if not whole_words:
        return stems
    listed = list(whole_words)
    return F.zip_with(
        tokens, stems, lambda token, stem: F.when(token.isin(listed), token).otherwise(stem)
    )


# --- the same for words that come again -------------------------------------------

#: Stems that a worker keeps; only speed depends on it.
KEPT_STEMS = 200_000


class _Stems(dict):
    """Word -> stem, by the steps of :func:`stem_tokens`; a full table is emptied."""

    def __init__(self, depth: str, whole_words: Sequence[str], has_vowels: bool):
        self.whole = frozenset(whole_words)
        self.dropped = dict.fromkeys(map(ord, _SHORT_VOWELS)) if has_vowels else None
        self.steps = [
            (length, re.compile("|".join(alternatives).replace("?<", "?P<").replace(r"\k<ain>", "(?P=ain)"), re.S))
            for length, alternatives in (_ROOT_STEPS if depth == "root" else [])
        ]

    def __missing__(self, word: str) -> str:
        if len(self) >= KEPT_STEMS:
            self.clear()
        bare = word.translate(self.dropped) if self.dropped else word
        stem = self[word] = bare if bare in self.whole else self._stem(bare)
        return stem

    def _stem(self, word: str) -> str:
        if len(word) >= 6 and word[:3] in LONG_PREFIXES:
            word = word[3:]
        elif len(word) >= 5 and word[:2] in LONG_PREFIXES:
            word = word[2:]
        if len(word) >= 6 and word[-3:] in LONG_SUFFIXES:
            word = word[:-3]
        elif len(word) >= 5 and word[-2:] in LONG_SUFFIXES:
            word = word[:-2]
        if word.startswith("وو") and len(word) >= 4:
            word = word[1:]
        elif word.startswith(("آ", "أ", "إ")):
            word = "ا" + word[1:]
        for length, pattern in self.steps:
            if len(word) == length and (found := pattern.fullmatch(word)):
                word = "".join(g for g in found.groups() if g is not None)
        return word


@lru_cache
def _stems(depth: str, whole_words: tuple[str, ...], has_vowels: bool) -> _Stems:
    """A worker's table, kept from task to task."""
    return _Stems(depth, whole_words, has_vowels)


def stem_repeated(
    tokens: Column,
    *,
    depth: str = "root",
    whole_words: Sequence[str] = WHOLE_WORDS,
    has_vowels: bool = True,
) -> Column:
    """As :func:`stem_tokens`, but each distinct token of a batch is stemmed once.

    An Arrow function: running text repeats most of its words.
    """
    _check_depth(depth)
    options = depth, tuple(whole_words), has_vowels

    @F.arrow_udf("array<string>")
    def stemmed(lists: pa.Array) -> pa.Array:
        stems = _stems(*options)
        encoded = pc.cast(lists.flatten(), pa.string()).dictionary_encode()
        words = pa.array([stems[word] for word in encoded.dictionary.to_pylist()], pa.string())
        lengths = pc.fill_null(lists.value_lengths(), 0).to_numpy()
        offsets = pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, words.take(encoded.indices), mask=lists.is_null())

    return stemmed(tokens)
