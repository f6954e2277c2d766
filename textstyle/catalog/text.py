"""Text operators and stylometric features over every document."""

from __future__ import annotations

from pyspark.sql import functions as F

from textstyle.catalog.registry import (
    STOPWORDS,
    arabic_documents,
    arabic_script_sql,
    arabic_stopwords,
    digest,
    digest_sql,
    document_text,
    document_text_sql,
    labelled_documents,
    query,
    table,
    tokens_sql,
    with_names,
    with_names_sql,
)
from textstyle.functions import profiles as P
from textstyle.functions import stylometry as S
from textstyle.functions import text as T
from textstyle.operators.features import feature_summary, stylometric_features
from textstyle.plans.preprocess import load_and_preprocess, preprocess
from textstyle.session import shared_folder
from textstyle.sources.tables import write_table

# Fixed values, as plain SQL text: the same character classes in RE2 notation.
SPACE_SQL = (
    r"\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WORD_SQL = r"\p{L}\p{N}_"


def list_sql(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def sub_sql(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, '{pattern}', '{by}', 'g')"


def normalize_sql(text: str, source: str, target: str) -> str:
    return sub_sql(
        f"translate({text}, '{source}', '{target}')",
        "[\\x{0617}-\\x{061A}\\x{064B}-\\x{0652}]",
        "",
    )


def clean_sql(text: str) -> str:
    """Step by step, as the separate operators would do it."""
    text = sub_sql(text, f"(http[^{SPACE_SQL}]+|www[^{SPACE_SQL}]+)", "")
    text = sub_sql(text, f"[^{SPACE_SQL}]+@[^{SPACE_SQL}]+", "")
    text = sub_sql(text, f"@[{WORD_SQL}]+", "")
    text = sub_sql(text, rf"[^\x{{0600}}-\x{{06FF}}{SPACE_SQL}\p{{Nd}}.,!?;:]", " ")
    return f"trim({sub_sql(text, f'[{SPACE_SQL}]+', ' ')})"


def words_sql(text: str) -> str:
    return (
        f"list_filter(regexp_split_to_array({text}, '[{SPACE_SQL}]+'), "
        "lambda x: x <> '')"
    )


# Letters and those that replace them, in the same order.
CORPUS_SQL = ("إأآىؤئة", "ااايويه")
WEB_SQL = ("إأآىةگ", "ااايهك")


# --- normalise and clean ----------------------------------------------------------


query("tx1_normalize_corpus", document_text_sql(f"translate(t, '{CORPUS_SQL[0]}', '{CORPUS_SQL[1]}')"))(
    document_text(lambda t: T.normalize_letters(t, P.CORPUS))
)
query("tx2_normalize_web", document_text_sql(f"translate(t, '{WEB_SQL[0]}', '{WEB_SQL[1]}')"))(
    document_text(lambda t: T.normalize_letters(t, P.WEB))
)
query(
    "tx3_remove_diacritics",
    document_text_sql(sub_sql("t", "[\\x{0617}-\\x{061A}\\x{064B}-\\x{0652}]", "")),
)(document_text(T.remove_diacritics))
query(
    "tx7_keep_script",
    document_text_sql(
        sub_sql("t", rf"[^\x{{0600}}-\x{{06FF}}{SPACE_SQL}\p{{Nd}}.,!?;:]", " ")
    ),
)(document_text(T.keep_script))
query(
    "tx8_squeeze_whitespace",
    document_text_sql(f"trim({sub_sql('t', f'[{SPACE_SQL}]+', ' ')})"),
)(document_text(T.squeeze_whitespace))
query("tx9_clean_text", document_text_sql(clean_sql("t")))(document_text(T.clean_text))


def _page_query(name: str, pattern: str, expression):
    sql = f"""
        WITH r AS (SELECT page_id, {sub_sql('html', pattern, '')} AS t FROM pages)
        SELECT page_id, {digest_sql('t')} FROM r
    """

    @query(name, sql)
    def run(spark, sf_dir):
        pages = table(spark, sf_dir, "pages")
        return pages.select("page_id", *digest(expression("html")))


_page_query(
    "tx4_remove_urls", f"(http[^{SPACE_SQL}]+|www[^{SPACE_SQL}]+)", T.remove_urls
)
_page_query("tx5_remove_emails", f"[^{SPACE_SQL}]+@[^{SPACE_SQL}]+", T.remove_emails)
_page_query("tx6_remove_mentions", f"@[{WORD_SQL}]+", T.remove_mentions)


# --- tokens ---------------------------------------------------------------------------


def _tokens_query(name: str, text_sql: str, expression):
    @query(
        name,
        f"""
        WITH w AS (SELECT doc_id, {text_sql} AS w FROM documents)
        SELECT doc_id, len(w)::INTEGER AS n_tokens,
               md5(array_to_string(w, '|')) AS tokens_md5 FROM w
        """,
    )
    def run(spark, sf_dir):
        docs = table(spark, sf_dir, "documents").select("doc_id", "text")
        docs = docs.withColumn("w", expression("text"))
        return docs.select(
            "doc_id",
            F.size("w").alias("n_tokens"),
            F.md5(F.array_join("w", "|")).alias("tokens_md5"),
        )


_tokens_query("tx10_tokenize", tokens_sql("text"), T.tokenize)
_tokens_query(
    "tx10_tokenize_keep_empty",
    "regexp_split_to_array(lower(regexp_replace(text, '[\\t-\\r ]+$', '')), '[\\t-\\r ]')",
    T.tokenize_keep_empty,
)
_tokens_query(
    "tx11_stopwords_exact",
    f"list_filter({tokens_sql('text')}, lambda x: x NOT IN {list_sql(STOPWORDS)} "
    "AND length(x) > 2)",
    lambda c: T.remove_stopwords(T.tokenize(c), STOPWORDS, min_length=3),
)
_tokens_query(
    "tx12_stopwords_ignore_case",
    f"list_filter({words_sql('text')}, lambda x: lower(x) NOT IN "
    f"{list_sql([w.lower() for w in STOPWORDS])})",
    lambda c: T.remove_stopwords(T.words(c), STOPWORDS, case_sensitive=False),
)
_tokens_query(
    "tx16_bigrams",
    f"""list_transform(list_zip(({tokens_sql('text')})[:-2], ({tokens_sql('text')})[2:]),
        lambda p: p[1] || ' ' || p[2])""",
    lambda c: T.ngrams(T.tokenize(c), 2),
)


# --- stemming and the whole of preprocessing -------------------------------------------

# Root extraction over distinct tokens, one step per common table. ``r`` rows
# carry the word ``w`` and whether it is left whole.
_WHOLE = [
    "يكون", "وليس", "وكان", "كذلك", "التي", "وبين", "عليها", "مساء", "الذي",
    "وكانت", "ولكن", "والتي", "تكون", "اليوم", "اللذين", "عليه", "كانت",
    "لذلك", "أمام", "هناك", "منها", "مازال", "لازال", "لايزال", "مايزال",
    "اصبح", "أصبح", "أمسى", "امسى", "أضحى", "اضحى", "مابرح", "مافتئ",
    "ماانفك", "لاسيما", "ولايزال", "الحالي", "اليها", "الذين", "فانه",
    "والذي", "وهذا", "لهذا", "فكان", "ستكون", "اليه", "يمكن", "بهذا", "الذى",
]


def _pattern_cases(patterns: list[tuple[str, str]]) -> str:
    """``CASE`` branches: an anchored pattern and the 1-based root positions."""
    return " ".join(
        f"WHEN regexp_full_match(w, '{regex}') THEN "
        + " || ".join(f"w[{i}]" for i in keep)
        for regex, keep in patterns
    )


def _step(name: str, source: str, cases: str) -> str:
    return (
        f"{name} AS (SELECT token, whole, CASE WHEN whole THEN w {cases} ELSE w END "
        f"AS w FROM {source})"
    )


def _short(length: int) -> str:
    return (
        f"WHEN length(w) = {length} AND w[-1] IN ('ة','ه','ي','ك','ت','ا','ن') "
        f"THEN w[:-2] "
        f"WHEN length(w) = {length} AND w[1] IN ('ل','ب','ف','س','و','ي','ت','ن','ا') "
        f"THEN w[2:] "
    )


_SIX = [
    ("است...", "456"), ("مست...", "456"), ("م..ا.ة", "235"), ("ا.ت.ا.", "246"),
    ("ت.ا.ي.", "246"),
]
_FIVE = [
    ("ا.[تا]..", "245"), ("م..[ويا].", "235"), ("[متا]...ة", "234"),
    ("[ميت].ت..", "245"), ("[مت].ا..", "245"), ("..[وا].ة", "124"),
    ("[ام]ن...", "345"), ("ا..ا.", "235"), ("...ان", "123"), ("ت..ي.", "235"),
    (".ا.و.", "135"), (".وا..", "145"), ("..ائ.", "125"), (".ا..ة", "134"),
    ("..ا.ي", "124"),
]
_FOUR = [
    ("م...", "234"), (".ا..", "134"), ("..ا.", "124"), ("..و.", "124"),
    ("..ي.", "124"), ("...ة", "123"),
]
_LONGER_ROOTS = [
    ("[تام]....", "2345"), ("....ة", "1234"), ("..ا..", "1245"), ("مت....", "3456"),
]
_TWO_ROOT_WORDS = "WHEN regexp_full_match(w, 'ا..و..') AND w[3] = w[5] THEN w[2] || w[5:]"

_STEM_STEPS = ", ".join(
    [
        _step(
            "s1",
            "s0",
            "WHEN length(w) >= 6 AND w[1:3] IN ('كال','بال','ولل','وال') THEN w[4:] "
            "WHEN length(w) >= 5 AND w[1:2] IN ('ال','لل') THEN w[3:]",
        ),
        _step(
            "s2",
            "s1",
            "WHEN length(w) >= 6 AND w[-3:] IN ('تمل','همل','تان','تين','كمل') THEN w[:-4] "
            "WHEN length(w) >= 5 AND w[-2:] IN ('ون','ات','ان','ين','تن','كم','هن','نا',"
            "'يا','ها','تم','كن','ني','وا','ما','هم') THEN w[:-3]",
        ),
        _step("s3", "s2", "WHEN length(w) >= 4 AND w[1:2] = 'وو' THEN w[2:]"),
        _step("s4", "s3", "WHEN w[1] IN ('آ','أ','إ') THEN 'ا' || w[2:]"),
    ]
)
_ROOT_STEPS = ", ".join(
    [
        _step("s5", "s4", _short(7)),
        # The doubled-letter pattern stands before the last pattern of its length.
        _step("s6", "s5", f"{_pattern_cases(_SIX[:4])} {_TWO_ROOT_WORDS} {_pattern_cases(_SIX[4:])} {_short(6)}"),
        _step("s7", "s6", f"{_pattern_cases(_FIVE)} {_short(5)}"),
        _step("s8", "s7", f"{_pattern_cases(_FOUR)} {_short(4)}"),
        _step("s9", "s8", _pattern_cases(_LONGER_ROOTS)),
    ]
)


def stemmed_sql(tokens: str, last: str, steps: str) -> str:
    """``tokens`` is SQL for ``(doc_id, w)``; gives ``(doc_id, t)``."""
    return f"""
        WITH tok AS ({tokens}),
        e AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM tok),
        d AS (SELECT DISTINCT token FROM e),
        b AS (SELECT token, {sub_sql('token', '[\\x{064B}-\\x{0652}]', '')} AS w FROM d),
        s0 AS (SELECT token, w, w IN {list_sql(_WHOLE)} AS whole FROM b),
        {steps},
        j AS (SELECT e.doc_id, string_agg(r.w, ' ' ORDER BY pos) AS t
              FROM e JOIN {last} r ON e.token = r.token GROUP BY e.doc_id)
        SELECT tok.doc_id, {digest_sql("coalesce(j.t, '')")}
        FROM tok LEFT JOIN j ON tok.doc_id = j.doc_id
    """


_ARABIC_TOKENS_SQL = f"""
    SELECT doc_id, {tokens_sql(arabic_script_sql())} AS w FROM documents
"""


def _stem_query(depth: str):
    from textstyle.functions.stemming import stem_repeated

    def run(spark, sf_dir):
        docs = arabic_documents(spark, sf_dir).withColumn("w", T.tokenize("text"))
        stems = stem_repeated(F.col("w"), depth=depth)
        return docs.select("doc_id", *digest(T.join_tokens(stems)))

    return run


query("tx13_stem_root", stemmed_sql(_ARABIC_TOKENS_SQL, "s9", f"{_STEM_STEPS}, {_ROOT_STEPS}"))(
    _stem_query("root")
)
query("tx13_stem_light", stemmed_sql(_ARABIC_TOKENS_SQL, "s4", _STEM_STEPS))(
    _stem_query("light")
)


def _folded(words: list[str], source: str, target: str) -> list[str]:
    table_ = {ord(a): b for a, b in zip(source, target)}
    marks = dict.fromkeys([*range(0x617, 0x61B), *range(0x64B, 0x653)])
    return sorted({w.translate({**table_, **marks}) for w in words})


_WEB_TOKENS_SQL = f"""
    SELECT doc_id, list_filter({tokens_sql(clean_sql(normalize_sql(arabic_script_sql(), *WEB_SQL)))},
        lambda x: x NOT IN {list_sql(_folded(arabic_stopwords(), *WEB_SQL))}
                  AND length(x) > 2) AS w
    FROM documents
"""
_CORPUS_TOKENS_SQL = f"""
    SELECT doc_id, list_filter({tokens_sql(normalize_sql(arabic_script_sql(), *CORPUS_SQL))},
        lambda x: x NOT IN {list_sql(_folded(arabic_stopwords(), *CORPUS_SQL))}) AS w
    FROM documents
"""
_ALL_STEPS = f"{_STEM_STEPS}, {_ROOT_STEPS}"


@query("tx14_preprocess_web", stemmed_sql(_WEB_TOKENS_SQL, "s9", _ALL_STEPS))
def preprocess_web(spark, sf_dir):
    docs = arabic_documents(spark, sf_dir)
    clean = preprocess(docs, profile=P.WEB, stopwords=arabic_stopwords(), stem_once=True)
    return clean.select("doc_id", *digest(F.col("abstract_clean")))


@query("tx14_preprocess_corpus", stemmed_sql(_CORPUS_TOKENS_SQL, "s9", _ALL_STEPS))
def preprocess_corpus(spark, sf_dir):
    docs = arabic_documents(spark, sf_dir)
    clean = preprocess(docs, profile=P.CORPUS, stopwords=arabic_stopwords(), stem_once=True)
    return clean.select("doc_id", *digest(F.col("abstract_clean")))


@query("tx15_load_and_preprocess", stemmed_sql(_WEB_TOKENS_SQL, "s9", _ALL_STEPS))
def load_preprocess_write(spark, sf_dir):
    raw, out = shared_folder(spark, "raw"), shared_folder(spark, "clean")
    write_table(arabic_documents(spark, sf_dir), raw)
    clean = load_and_preprocess(
        spark, raw, out, P.WEB, stopwords=arabic_stopwords()
    )
    return clean.select("doc_id", *digest(F.col("abstract_clean")))


# --- stylometry ----------------------------------------------------------------------------


def _measure_query(name: str, column: str, sql: str, expression):
    @query(
        name,
        f"""
        WITH w AS (SELECT doc_id, text, {words_sql('text')} AS w FROM documents)
        SELECT doc_id, round({sql}, 6) AS {column} FROM w
        """,
    )
    def run(spark, sf_dir):
        docs = table(spark, sf_dir, "documents").select("doc_id", "text")
        docs = docs.withColumn("w", T.words("text"))
        return docs.select("doc_id", F.round(expression(F.col("w")), 6).alias(column))


BRUNET_SQL = (
    "CASE WHEN len(w) > 1 THEN pow(len(w), pow(len(list_distinct(w)), -0.165)) ELSE 0.0 END"
)
DIVERSITY_SQL = "CASE WHEN len(w) > 0 THEN len(list_distinct(w)) / len(w) ELSE 0.0 END"
WORD_LENGTH_SQL = (
    "CASE WHEN len(w) > 0 THEN length(array_to_string(w, '')) / len(w) ELSE 0.0 END"
)

_measure_query("sf1_brunets_w", "f_brunets_w", BRUNET_SQL, S.brunets_w)
_measure_query("sf4_lexical_diversity", "f_lexical_diversity", DIVERSITY_SQL, S.lexical_diversity)
_measure_query("sf6_avg_word_length", "f_avg_word_length", WORD_LENGTH_SQL, S.avg_word_length)


@query(
    "sf5_chars_per_part",
    f"""
    WITH t AS (SELECT doc_id, array_to_string({tokens_sql('text')}, ' ') AS t FROM documents)
    SELECT doc_id, round(length(t) / len(string_split(t, ' ')), 6) AS avg_word_length FROM t
    """,
)
def avg_word_length_with_spaces(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    clean = docs.select("doc_id", T.join_tokens(T.tokenize("text")).alias("abstract_clean"))
    measure = T.chars_per_part("abstract_clean")
    return clean.select("doc_id", F.round(measure, 6).alias("avg_word_length"))


def entities_sql(text: str, gazetteer: dict[str, list[str]]) -> str:
    """Listed names are counted over split words here, not by look-around."""
    words = f"regexp_split_to_array({text}, '[^{WORD_SQL}]+')"
    lists = " + ".join(
        f"len(list_filter({words}, lambda x: x IN {list_sql(names)}))"
        for names in gazetteer.values()
    )
    patterns = " + ".join(
        f"len(regexp_extract_all({text}, '{p}'))"
        for p in (
            f"[A-Z][a-z]+([{SPACE_SQL}]+[A-Z][a-z]+)*",
            f"د\\.[{SPACE_SQL}]*[{WORD_SQL}]+",
            f"أ\\.[{SPACE_SQL}]*د\\.[{SPACE_SQL}]*[{WORD_SQL}]+",
        )
    )
    return f"({patterns} + {lists})::INTEGER"


def _entity_query(name: str, gazetteer):
    @query(
        name,
        f"""
        WITH d AS (SELECT doc_id, {with_names_sql()} AS t FROM documents)
        SELECT doc_id, {entities_sql('t', gazetteer)} AS f_named_entities FROM d
        """,
    )
    def run(spark, sf_dir):
        docs = table(spark, sf_dir, "documents")
        docs = docs.select("doc_id", with_names().alias("text"))
        return docs.select(
            "doc_id", S.entity_count("text", gazetteer).alias("f_named_entities")
        )


_entity_query("sf2_entity_count_small", P.SMALL_GAZETTEER)
_entity_query("sf3_entity_count", P.LARGE_GAZETTEER)


FEATURES_SQL = f"""
    WITH d AS (SELECT doc_id, label, {with_names_sql()} AS t,
                      array_to_string({tokens_sql('text')}, ' ') AS c
               FROM (SELECT d.doc_id, d.text, l.quality AS label
                     FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)),
         w AS (SELECT doc_id, label, t, {words_sql('c')} AS w FROM d),
         f AS (SELECT doc_id, label, {BRUNET_SQL} AS f_brunets_w,
                      {entities_sql('t', P.LARGE_GAZETTEER)} AS f_named_entities,
                      {DIVERSITY_SQL} AS f_lexical_diversity,
                      {WORD_LENGTH_SQL} AS f_avg_word_length FROM w)
"""


def _features(docs, *keep: str):
    docs = docs.select(
        "doc_id",
        *keep,
        with_names().alias("text"),
        T.join_tokens(T.tokenize("text")).alias("abstract_clean"),
    )
    return stylometric_features(docs)


@query(
    "sf7_all_features",
    f"""{FEATURES_SQL}
    SELECT doc_id, round(f_brunets_w, 6) AS f_brunets_w, f_named_entities,
           round(f_lexical_diversity, 6) AS f_lexical_diversity,
           round(f_avg_word_length, 6) AS f_avg_word_length FROM f
    """,
)
def all_features(spark, sf_dir):
    out = shared_folder(spark, "features")
    write_table(_features(table(spark, sf_dir, "documents")), out)
    saved = spark.read.parquet(out)
    return saved.select(
        "doc_id",
        "f_named_entities",
        *[
            F.round(c, 6).alias(c)
            for c in ("f_brunets_w", "f_lexical_diversity", "f_avg_word_length")
        ],
    )


def _summary_sql(by: str = "") -> str:
    keys = f"{by}, " if by else ""
    group = f"WHERE {by} IS NOT NULL GROUP BY {by}" if by else ""
    parts = [
        f"""SELECT {keys}'{f}' AS feature, count({f}) AS count, round(avg({f}), 6) AS mean,
        round(stddev_samp({f}), 6) AS stddev, round(min({f})::DOUBLE, 6) AS min,
        round(max({f})::DOUBLE, 6) AS max FROM f {group}"""
        for f in (
            "f_brunets_w",
            "f_named_entities",
            "f_lexical_diversity",
            "f_avg_word_length",
        )
    ]
    return FEATURES_SQL + " UNION ALL ".join(parts)


def _rounded(summary):
    stats = [F.round(c, 6).alias(c) for c in ("mean", "stddev", "min", "max")]
    others = [c for c in summary.columns if c not in ("mean", "stddev", "min", "max")]
    return summary.select(*others, *stats)


@query("sf8_feature_summary", _summary_sql())
def summary(spark, sf_dir):
    return _rounded(feature_summary(_features(table(spark, sf_dir, "documents"))))


@query("stylometric_profile_by_class", _summary_sql("label"))
def profile_by_class(spark, sf_dir):
    """The flagship: how human and machine style differ, feature by feature."""
    labelled = _features(labelled_documents(spark, sf_dir), "label")
    return _rounded(feature_summary(labelled, by=["label"]))
