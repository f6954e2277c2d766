"""Time the headline jobs and print one JSON line.

Every job computes all its columns into the ``noop`` sink; each is run twice
and the faster run counts, so that JVM start-up is left out. Reads
``BENCH_SF_DIR`` and ``BENCH_CPUS``.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textstyle.catalog import QUERIES
from textstyle.catalog.learning import rule_scores, turns
from textstyle.catalog.registry import arabic_script, arabic_stopwords, table
from textstyle.catalog.streams import stream_tokens
from textstyle.functions import profiles as P
from textstyle.functions import text as T
from textstyle.operators.features import stylometric_features
from textstyle.operators.metrics import roc_auc
from textstyle.operators.terms import (
    rule_dictionary,
    stem_with_dictionary,
    term_statistics,
    tfidf_long,
    top_ngrams,
)
from textstyle.plans import learning as L
from textstyle.plans.preprocess import preprocess
from textstyle.session import get_session

RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        "12g",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")

    # Each test table is one file with one row group, that is one task: spread
    # it. The shuffle is part of every timing. Real inputs have many files.
    width = int(cpus)
    latin = table(spark, sf_dir, "documents").select("doc_id", "text").repartition(width)
    docs = latin.select("doc_id", arabic_script().alias("text"))
    chats = turns(spark, sf_dir).repartition(width)
    features = L.fit_tfidf(chats)
    model = L.train_models(chats, features, [L.LOGISTIC])[L.LOGISTIC]
    words = arabic_stopwords()
    labelled = table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels").select("doc_id"), "doc_id"
    )
    tokens = docs.withColumn("w", T.tokenize("text"))

    jobs: dict[str, tuple] = {
        "preprocess_web": (docs, lambda: preprocess(docs, profile=P.WEB, stopwords=words)),
        "preprocess_corpus": (
            docs,
            lambda: preprocess(docs, profile=P.CORPUS, stopwords=words),
        ),
        "stylometric_features": (
            latin,
            lambda: stylometric_features(latin.withColumn("abstract_clean", F.col("text"))),
        ),
        "term_statistics": (latin, lambda: term_statistics(latin, T.tokenize("text"))),
        "tfidf_long": (latin, lambda: tfidf_long(latin, "doc_id", T.tokenize("text"))),
        "top_bigrams": (latin, lambda: top_ngrams(latin, T.tokenize("text"))),
        "score_batch": (chats, lambda: L.score(chats, model)),
        "train_logistic": (
            chats,
            lambda: L.train_all(chats, "conv_id", names=[L.LOGISTIC]).metrics,
        ),
        "stem_dictionary": (
            docs,
            lambda: stem_with_dictionary(
                tokens, "w", rule_dictionary(tokens, F.col("w"), "light"), "stems"
            ),
        ),
        "roc_auc": (labelled, lambda: roc_auc(rule_scores(spark, sf_dir), by=["model"])),
        "stream_tokens": (chats, lambda: stream_tokens(spark, sf_dir)),
    }
    # These read the documents that have a label.
    for name in ("stylometric_profile_by_class", "so1_class_sample", "ml13_all_metrics"):
        jobs[name] = (labelled, lambda name=name: QUERIES[name](spark, sf_dir))

    seconds, rates = {}, {}
    for name, (rows, job) in jobs.items():
        seconds[name] = min(_timed(job) for _ in range(RUNS))
        rates[name] = round(rows.count() / seconds[name], 1)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "rows_per_sec": rates,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


def _timed(job) -> float:
    start = time.perf_counter()
    result: DataFrame = job()
    result.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


if __name__ == "__main__":
    main()
