"""Hand-made rows; expected values were worked out by hand."""

from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import NGram, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from textstyle.functions import profiles as P
from textstyle.functions import text as T


@pytest.mark.parametrize(
    "text, profile, expected",
    [
        ("إلى المدرسة", P.CORPUS, "الي المدرسه"),
        ("مؤمن", P.CORPUS, "مومن"),
        ("گتاب", P.CORPUS, "گتاب"),
        ("مؤمن", P.WEB, "مؤمن"),
        ("گتاب", P.WEB, "كتاب"),
        (None, P.WEB, ""),
        (None, P.CORPUS, ""),
    ],
)
def test_letters(one, text, profile, expected):
    assert one(text, T.normalize_letters("text", profile)) == expected


def test_diacritics(one):
    assert one("مُحَمَّد", T.remove_diacritics("text")) == "محمد"
    assert one(None, T.remove_diacritics("text")) == ""
    assert one("إِلَى", T.normalize("text")) == "الي"


@pytest.mark.parametrize(
    "text, expected",
    [
        ("نص http://a.b/c x@y.z @u  ABC ٣!", "نص ٣!"),
        ("", ""),
        (None, ""),
        ("  نص \n نص ", "نص نص"),
        ("@", ""),
        ("نص@", "نص"),
        ("www http نص", "نص"),
        ("@علي نص", "نص"),
    ],
)
def test_clean(one, text, expected):
    assert one(text, T.clean_text("text")) == expected


ALPHABET = "abhtpw@.س٣! \t\n  \x1c\x85:/"


def _clean_in_python(text: str) -> str:
    text = re.sub(r"(?:http|www)\S+", "", text)
    text = re.sub(r"\S+@\S+", "", text)
    text = re.sub(r"@\w+", "", text)
    text = re.sub(r"[^؀-ۿ\s\d.,!?;:]", " ", text)
    return re.sub(r"\s+", " ", text).strip(" ")


def test_clean_agrees_with_plain_regexes(spark):
    texts: list[str] = []

    @settings(max_examples=400, database=None, suppress_health_check=list(HealthCheck))
    @given(st.text(ALPHABET, max_size=40))
    def gather(text):
        texts.append(text)

    gather()
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = rows.select(
        "text",
        T.clean_text("text").alias("clean"),
        T.words("text").alias("words"),
        T.squeeze_whitespace("text").alias("squeezed"),
        T.clean_text(T.clean_text("text")).alias("again"),
    )
    for row in rows.collect():
        assert row["clean"] == _clean_in_python(row["text"]), row
        assert row["again"] == row["clean"]
        assert row["words"] == row["text"].split()
        assert row["squeezed"] == " ".join(row["text"].split())


def test_long_run_without_spaces_is_linear(one):
    junk = "a" * 200_000
    assert one(junk + " @", T.remove_emails("text")) == junk + " @"
    assert one("x " + "a@" * 100_000 + "b y", T.remove_emails("text")) == "x  y"


TOKEN_ROWS = ["a  b", "", " ", "A b ", "a b c", None, "\tx"]


def test_tokenize_drops_empty_tokens(spark):
    rows = spark.createDataFrame([(t,) for t in TOKEN_ROWS], "text string")
    got = [r["t"] for r in rows.select(T.tokenize("text").alias("t")).collect()]
    assert got == [["a", "b"], [], [], ["a", "b"], ["a b", "c"], [], ["x"]]


def test_tokenize_keep_empty_is_mllib_tokenizer(spark):
    rows = spark.createDataFrame([(t,) for t in TOKEN_ROWS], "text string").fillna("")
    rows = Tokenizer(inputCol="text", outputCol="mllib").transform(rows)
    for row in rows.withColumn("ours", T.tokenize_keep_empty("text")).collect():
        assert row["ours"] == row["mllib"], row


def test_stopwords(spark):
    rows = spark.createDataFrame([(["من", "في", "كتاب"],), (None,)], "w array<string>")
    exact = T.remove_stopwords("w", ["كتاب"], min_length=3)
    loose = T.remove_stopwords("w", ["كتاب"], case_sensitive=False)
    got = rows.select(exact.alias("exact"), loose.alias("loose")).collect()
    assert [tuple(r) for r in got] == [([], ["من", "في"]), ([], [])]


def test_stopwords_agree_with_mllib(spark):
    listed = ["The", "of"]
    rows = spark.createDataFrame([(["the", "OF", "", "x", "x"],)], "w array<string>")
    mllib = StopWordsRemover(inputCol="w", outputCol="mllib", stopWords=listed)
    ours = T.remove_stopwords("w", listed, case_sensitive=False)
    row = mllib.transform(rows).withColumn("ours", ours).first()
    assert row["ours"] == row["mllib"] == ["", "x", "x"]


def test_stopwords_need_folding_to_match():
    assert T.fold_stopwords(["إلى", "التي"], P.CORPUS) == ["التي", "الي"]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_ngrams_agree_with_mllib(spark, n):
    rows = [(["a", "b", "c", "a"],), (["a"],), ([],)]
    frame = spark.createDataFrame(rows, "w array<string>")
    frame = NGram(n=n, inputCol="w", outputCol="mllib").transform(frame)
    for row in frame.withColumn("ours", T.ngrams("w", n)).collect():
        assert row["ours"] == row["mllib"]


def test_join_skips_null_and_keeps_empty(spark):
    rows = spark.createDataFrame([(["a", None, "", "b"],), (None,)], "w array<string>")
    assert [r[0] for r in rows.select(T.join_tokens("w")).collect()] == ["a  b", ""]


def test_chars_per_part(one):
    assert one("aa bbbb", T.chars_per_part("text")) == 3.5


def test_normalize_is_idempotent(one):
    text = "إلى مُؤمنٍ گتابة"
    for profile in P.PROFILES.values():
        once = T.normalize("text", profile)
        assert one(text, once) == one(text, T.normalize(once, profile))


def test_letters_use_unicode_lengths(one):
    assert one("ab", F.length("text")) == 2
