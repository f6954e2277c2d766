from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from textstyle.functions import profiles as P
from textstyle.functions import stylometry as S
from textstyle.functions import text as T
from textstyle.functions import stemming
from textstyle.functions.stemming import stem_repeated, stem_tokens
from textstyle.operators.features import feature_summary, stylometric_features
from textstyle.plans.preprocess import preprocess

WORDS = "text"


@pytest.mark.parametrize(
    "text, w, diversity, length",
    [
        ("a b a", 3 ** (2**-0.165), 2 / 3, 1.0),
        ("a", 0.0, 1.0, 1.0),
        ("", 0.0, 0.0, 0.0),
        ("  ", 0.0, 0.0, 0.0),
        (None, 0.0, 0.0, 0.0),
        ("aa bbbb", 2 ** (2**-0.165), 1.0, 3.0),
    ],
)
def test_measures(one, text, w, diversity, length):
    words = T.words("text")
    assert one(text, S.brunets_w(words)) == pytest.approx(w)
    assert one(text, S.lexical_diversity(words)) == pytest.approx(diversity)
    assert one(text, S.avg_word_length(words)) == pytest.approx(length)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("محمد في الرياض", 2),
        ("أ. د. علي", 3),
        ("محمد. ثم", 2),
        ("John Smith met Ann", 2),
        ("محمدي", 0),
        ("مُحمد محمد", 1),
        (None, 0),
    ],
)
def test_entities(one, text, expected):
    assert one(text, S.entity_count("text")) == expected


def test_names_of_several_words_and_repeated_names(one):
    lists = {"city": ["New York", "Paris"], "brand": ["Paris"]}
    count = S.entity_count("text", lists, patterns=())
    assert one("New York, Paris; NewYork Parisian", count) == 3


def test_whole_words_agree_with_python(spark):
    names = P.LARGE_GAZETTEER["person"]
    texts = ["علي،علي-علي_", "عليٌّ علي", "(عمر)عمر7", "x علي"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    count = S.entity_count("text", {"person": names}, patterns=())
    pattern = rf"\b({'|'.join(names)})\b"
    for row in rows.select("text", count.alias("n")).collect():
        assert row["n"] == len(re.findall(pattern, row["text"])), row


ROOTS = {
    "المدرسة": "درس",
    "مكتوب": "كتب",
    "كاتب": "كتب",
    "استخدام": "خدم",
    "يستخدمون": "خدم",
    "والمكتبات": "كتب",
    "اعشوشب": "عشب",
    "مفتاح": "فتح",
    "متدحرج": "دحرج",
    "مترجم": "ترجم",
    "الذي": "الذي",
    "أحمد": "حمد",
    "وولد": "ولد",
    "من": "من",
    "مُدَرِّس": "درس",
}


def test_roots(spark):
    rows = spark.createDataFrame([(list(ROOTS),), ([],), (None,)], "w array<string>")
    got = [r[0] for r in rows.select(stem_tokens(F.col("w"))).collect()]
    assert got == [list(ROOTS.values()), [], None]


def test_light_stems_keep_patterns(one):
    stems = stem_tokens(T.tokenize("text"), depth="light")
    assert one("والمكتبات يستخدمون الذي", stems) == ["مكتب", "يستخدم", "الذي"]
    with pytest.raises(ValueError):
        stem_tokens(T.tokenize("text"), depth="deep")


@pytest.mark.parametrize("depth", ["root", "light"])
@pytest.mark.parametrize("has_vowels", [True, False])
def test_repeated_words_have_the_same_stems(spark, depth, has_vowels):
    draw = random.Random(0)
    affixes = stemming.LONG_PREFIXES + stemming.LONG_SUFFIXES + stemming.WHOLE_WORDS + [""]
    patterns = [w for _, found in stemming._ROOT_STEPS for p in found for w in re.split(r"[^ء-ي]+", p)]
    letters = "فعلدرسكتبأإآوايةتنمستُِّ x\n\U0001f600\x00"
    words = [
        draw.choice(affixes) + draw.choice(patterns) + "".join(draw.choices(letters, k=draw.randrange(7)))
        + draw.choice(affixes)
        for _ in range(6000)
    ]
    lists = [(words[k : k + 40] + [None, ""],) for k in range(0, len(words), 40)]
    lists += [(list(ROOTS),), ([],), (None,), ([None],)]
    rows = spark.createDataFrame(lists, "w array<string>")
    options = {"depth": depth, "has_vowels": has_vowels}
    both = rows.select(stem_tokens(F.col("w"), **options), stem_repeated(F.col("w"), **options)).collect()
    assert [r[0] for r in both] == [r[1] for r in both]
    with pytest.raises(ValueError):
        stem_repeated(F.col("w"), depth="deep")


def test_preprocessing_stems_each_distinct_word_once(spark, monkeypatch):
    rows = spark.createDataFrame([("كاتب مكتوب كاتب",)] * 3, "text string")
    plan = preprocess(rows, stopwords=[], stem_once=True)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan  # and no pattern is tried on every token
    stems, met = stemming._Stems("root", [], False), []
    monkeypatch.setattr(stems, "_stem", lambda w: met.append(w) or w, raising=False)
    assert [stems[w] for w in "abab"] == list("abab") and met == ["a", "b"]


def test_feature_table_and_summary(spark):
    rows = spark.createDataFrame(
        [("محمد", "a b a", 0), ("x", "aa bbbb", 1), (None, None, 1)],
        "text string, abstract_clean string, label int",
    )
    features = stylometric_features(rows)
    assert features.columns == [
        "text", "abstract_clean", "label", "f_brunets_w", "f_named_entities",
        "f_lexical_diversity", "f_avg_word_length",
    ]
    by_label = {
        (r["label"], r["feature"]): r
        for r in feature_summary(features, by=["label"]).collect()
    }
    assert by_label[(0, "f_named_entities")]["mean"] == 1.0
    assert by_label[(1, "f_avg_word_length")]["max"] == 3.0
    assert by_label[(1, "f_avg_word_length")]["count"] == 2
