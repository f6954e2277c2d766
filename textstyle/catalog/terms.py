"""Frequencies, vocabulary, TF-IDF and stem dictionaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from textstyle.catalog import text as _text_queries  # noqa: F401  (registers first)
from textstyle.catalog.registry import (
    ORACLES,
    arabic_documents,
    arabic_script_sql,
    digest,
    digest_sql,
    labelled_documents,
    query,
    table,
    tokens_sql,
)
from textstyle.functions import text as T
from textstyle.operators import terms as V
from textstyle.session import write_through

def _tokens():
    return T.tokenize("text")


FREQUENCY_SQL = f"""
    WITH tok AS (SELECT doc_id, unnest({tokens_sql('text')}) AS term FROM documents),
         tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY doc_id, term),
         v AS (SELECT term, sum(tf)::BIGINT AS count, count(*) AS df FROM tf
               GROUP BY term HAVING count(*) >= 2),
         n AS (SELECT count(*) AS m FROM documents)
"""


@query(
    "tx17_top_bigrams",
    f"""
    WITH w AS (SELECT {tokens_sql('text')} AS w FROM documents),
         b AS (SELECT unnest(list_transform(list_zip(w[:-2], w[2:]),
                      lambda p: p[1] || ' ' || p[2])) AS ngram FROM w)
    SELECT ngram, count(*) AS count FROM b GROUP BY ngram
    ORDER BY count DESC, ngram LIMIT 10
    """,
)
def top_bigrams(spark, sf_dir):
    return V.top_ngrams(table(spark, sf_dir, "documents"), _tokens())


@query(
    "tx18_top_words_per_class",
    f"""
    WITH e AS (SELECT l.quality AS label, unnest({tokens_sql('text')}) AS word
               FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
         c AS (SELECT label, word, count(*) AS count FROM e GROUP BY label, word),
         r AS (SELECT *, row_number() OVER (PARTITION BY label
                   ORDER BY count DESC, word)::INTEGER AS rank FROM c)
    SELECT label, word, count, rank FROM r WHERE rank <= 100
    """,
)
def top_words_per_class(spark, sf_dir):
    return V.top_words_per_class(labelled_documents(spark, sf_dir), _tokens())


@query(
    "ml2_vocabulary",
    f"""{FREQUENCY_SQL}
    SELECT row_number() OVER (ORDER BY count DESC, term)::INTEGER AS rank, term, count, df
    FROM v ORDER BY rank LIMIT 10000
    """,
)
def vocabulary(spark, sf_dir):
    """The vocabulary of vectors, whose length is a parameter."""
    return V.vocabulary(table(spark, sf_dir, "documents"), _tokens(), vocab_size=10_000)


@query("ml2_term_statistics", f"{FREQUENCY_SQL} SELECT term, count, df FROM v")
def term_statistics(spark, sf_dir):
    return V.term_statistics(table(spark, sf_dir, "documents"), _tokens())


@query(
    "ml3_tfidf_long",
    f"""{FREQUENCY_SQL}
    SELECT doc_id, tf.term, tf, df, round(ln((m + 1) / (df + 1)), 6) AS idf,
           round(tf * ln((m + 1) / (df + 1)), 6) AS tfidf
    FROM tf JOIN v ON tf.term = v.term, n
    """,
)
def tfidf_long(spark, sf_dir):
    weights = V.tfidf_long(table(spark, sf_dir, "documents"), "doc_id", _tokens())
    rounded = {c: F.round(c, 6) for c in ("idf", "tfidf")}
    return weights.withColumns(rounded)


@query(
    "ml4_vocabulary_sample",
    f"""{FREQUENCY_SQL}
    SELECT row_number() OVER (ORDER BY count DESC, term)::INTEGER AS rank, term, count, df,
           (SELECT count(*) FROM v) AS vocab_size
    FROM v ORDER BY rank LIMIT 20
    """,
)
def vocabulary_sample(spark, sf_dir):
    terms = V.term_statistics(table(spark, sf_dir, "documents"), _tokens())
    return V.vocabulary_sample(write_through(terms, "terms"))


# The dictionary here is made from the documents: each token without its first
# letter, for the tokens that start with the letter written for "a".
DICTIONARY_SQL = f"""
    WITH tok AS (SELECT doc_id, {tokens_sql(arabic_script_sql())} AS w FROM documents),
    r AS (SELECT doc_id, array_to_string(list_transform(w,
              lambda x: CASE WHEN x[1] = 'أ' AND length(x) > 1 THEN x[2:] ELSE x END), ' ')
              AS t FROM tok)
    SELECT doc_id, {digest_sql('t')} FROM r
"""


def _dictionary_query(limit: int):
    def run(spark, sf_dir):
        docs = arabic_documents(spark, sf_dir).select("doc_id", _tokens().alias("w"))
        known = V.distinct_tokens(docs, F.col("w")).filter(
            F.col("token").startswith("أ") & (F.length("token") > 1)
        )
        stems = known.withColumn("stem", F.expr("substring(token, 2)"))
        done = V.stem_with_dictionary(docs, "w", stems, "stems", limit)
        return done.select("doc_id", *digest(T.join_tokens("stems")))

    return run


query("tx13_stem_dictionary", DICTIONARY_SQL)(_dictionary_query(V.BROADCAST_BYTES))
query("tx13_stem_large_dictionary", DICTIONARY_SQL)(_dictionary_query(0))


@query("tx13_stem_rule_dictionary", ORACLES["tx13_stem_root"])
def stem_by_rule_dictionary(spark, sf_dir):
    """Roots looked up in a table of all distinct tokens, not computed in place."""
    docs = arabic_documents(spark, sf_dir).select("doc_id", _tokens().alias("w"))
    stems = write_through(V.rule_dictionary(docs, F.col("w")), "dictionary")
    done = V.stem_with_dictionary(docs, "w", stems, "stems")
    return done.select("doc_id", *digest(T.join_tokens("stems")))
