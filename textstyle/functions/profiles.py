"""Language data: letter maps, character classes, gazetteers, stopwords.

Everything here is a fixed value that decides results, so it is kept as plain
text in one place. Behaviour lives in the sibling modules.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: character classes -------------------------------------
# Whitespace in the Unicode sense plus the four separators that Python also
# counts; to be used inside brackets of a regex that starts with UNICODE.
UNICODE = "(?U)"
SPACE = r"\s\x1c-\x1f"
ASCII_SPACE = r"\t-\r\x20"
WORD_CHARS = r"\p{L}\p{N}_"
DIGITS = r"\p{Nd}"
ARABIC_SCRIPT = r"\x{0600}-\x{06FF}"
ANY_LETTER = r"\p{L}"
KEPT_PUNCTUATION = ".,!?;:"

# --- Fixed values: vowel and Quranic marks removed from text --------------
DIACRITICS = "".join(
    chr(c) for c in [*range(0x0617, 0x061B), *range(0x064B, 0x0653)]
)

# --- Fixed values: letter maps ---------------------------------------------
CORPUS_LETTERS = {
    "إ": "ا",
    "أ": "ا",
    "آ": "ا",
    "ى": "ي",
    "ؤ": "و",
    "ئ": "ي",
    "ة": "ه",
}
WEB_LETTERS = {
    "إ": "ا",
    "أ": "ا",
    "آ": "ا",
    "ى": "ي",
    "ة": "ه",
    "گ": "ك",
}

# --- Fixed values: entity patterns and gazetteers --------------------------
LATIN_NAMES = rf"{UNICODE}[A-Z][a-z]+(?:[{SPACE}]+[A-Z][a-z]+)*"
DOCTOR_TITLES = rf"{UNICODE}د\.[{SPACE}]*[{WORD_CHARS}]+"
PROFESSOR_TITLES = rf"{UNICODE}أ\.[{SPACE}]*د\.[{SPACE}]*[{WORD_CHARS}]+"
ENTITY_PATTERNS = (LATIN_NAMES, DOCTOR_TITLES, PROFESSOR_TITLES)

SMALL_GAZETTEER = {
    "person": ["محمد", "أحمد", "علي", "فاطمة", "عائشة", "خديجة"],
    "country": ["مصر", "السعودية", "الأردن", "لبنان", "سوريا", "العراق"],
    "city": ["القاهرة", "الرياض", "عمان", "بيروت", "دمشق", "بغداد"],
}
LARGE_GAZETTEER = {
    "person": [
        "محمد", "أحمد", "علي", "فاطمة", "عائشة", "خديجة",
        "يوسف", "إبراهيم", "عمر", "عثمان",
    ],
    "country": [
        "مصر", "السعودية", "الأردن", "لبنان", "سوريا", "العراق",
        "فلسطين", "المغرب", "الجزائر", "تونس",
    ],
    "city": [
        "القاهرة", "الرياض", "جدة", "عمان", "بيروت", "دمشق",
        "بغداد", "الدوحة", "دبي", "أبوظبي",
    ],
}

# --- Fixed values: exponent of Brunet's W -----------------------------------
BRUNET_EXPONENT = -0.165


@dataclass(frozen=True)
class Profile:
    """How one flavour of input is turned into clean tokens."""

    name: str
    letters: dict[str, str] = field(hash=False)
    strip_web: bool
    """Remove links, addresses, mentions and foreign script."""
    min_token_length: int
    case_sensitive_stopwords: bool
    script: str = ARABIC_SCRIPT


#: Edited prose such as abstracts: letters are folded, markup is left alone.
CORPUS = Profile("corpus", CORPUS_LETTERS, False, 1, False)
#: Text copied from the web: links and foreign script go, short tokens go.
WEB = Profile("web", WEB_LETTERS, True, 3, True)
PROFILES = {p.name: p for p in (CORPUS, WEB)}
