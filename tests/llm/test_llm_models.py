"""Language, quality, licences and the suffix tree on small tables."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from textstyle.llm import language, licences, quality, suffix_tree
from textstyle.llm.tables import fold_of

EN, FR = "the house of the garden and the tree with birds", "le jardin de la maison et les oiseaux du bois"


@pytest.fixture(scope="module")
def lines(spark):
    rows = [(k, EN if k % 2 else FR, "en" if k % 2 else "fr", 1.0) for k in range(40)]
    rows += [(100, None, "en", 1.0), (101, "", "fr", 1.0), (102, "123 !?", "en", 1.0), (103, EN * 2000, None, 1.0), (None, FR, None, 1.0)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, p double")


def test_language(spark, lines):
    model = language.train(lines, key=["doc_id"], sample_rows=15)
    rows = language.identify(lines, model).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == 45
    assert all(got[k]["lang_pred"] == ("en" if k % 2 else "fr") for k in range(40))
    assert [got[k]["lang_pred"] for k in (100, 101, 102, 103, None)] == ["und", "und", "und", "en", "fr"]
    assert got[100]["score"] == 0 and all(0 <= r["score"] <= 1 for r in rows)
    again = language.train(lines.repartition(7), key=["doc_id"], sample_rows=15)
    assert np.array_equal(model.weights, again.weights)
    nothing = language.train(lines.limit(0), key=["doc_id"])
    assert language.identify(lines, nothing).where("lang_pred <> 'und'").count() == 0
    assert language.identify(lines.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        language.identify(lines.withColumnRenamed("p", "score"), model)


def test_letters_make_ngrams():
    found, counts = language.counts_of("ab")
    assert counts.sum() == 4 + 3 + 2  # blank a b blank
    assert language.counts_of("12 - 3") is None and language.counts_of(None) is None
    assert np.array_equal(language.counts_of("A  b!")[0], language.counts_of("a b")[0])


def test_quality_network(spark):
    good, bad = b"Some plain words stand here. " * 9, b"$$$ ### &&& *** "
    rows = [(k % 2, 1.0, (good if k % 2 else bad) * (1 + k % 3)) for k in range(60)]
    net = quality.fit(rows)
    assert net.score(good) > 0.7 > 0.3 > net.score(bad)
    assert 0 <= net.score(b"") <= 1
    # Chunks cover the whole text: the best place of a filter anywhere is found.
    text = bytes(np.random.default_rng(0).integers(0, 256, 3 * quality.CHUNK * quality.SLAB + 7, np.uint8))
    raw = np.frombuffer(text + bytes(quality.WIDTH), np.uint8)
    plain = sum(net.tables[k][raw[k : k + len(text)]] for k in range(quality.WIDTH))
    best = np.maximum(plain.max(0) + net.bias, 0)
    assert np.allclose(net.pool(text).max(0), best, atol=1e-5)


def test_quality_tables(spark):
    texts = ["Some plain words stand here. " * 5, "$$$ ### &&& *** " * 5]
    rows = [(k, texts[k % 2], 9) for k in range(30)] + [(50, None, 9), (51, "", 9), (None, texts[0], 9), (3, texts[1], 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    labels = [(k, 1 - k % 2, 7) for k in range(20)] + [(None, 1, 7), (25, None, 7), (2, 1, 7)]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, text int")
    net = quality.train(docs, labels, sample_rows=8)
    got = {r["doc_id"]: r["score"] for r in quality.rate(docs, net).where("doc_id <> 3").collect()}
    assert got[50] == got[51] and len(got) == 31
    assert quality.rate(docs, net).count() == 34
    untrained = quality.train(docs, labels.limit(0))
    assert quality.rate(docs, untrained).where("score between 0 and 1").count() == 34
    assert quality.rate(docs.limit(0), net).count() == 0
    with pytest.raises(ValueError):
        quality.rate(docs.withColumnRenamed("quality", "score"), net)


def test_licences(spark):
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software)"
    rows = [
        (1, f"Some words.\n\n{notice}\nmore words", "x"), (2, "Plain words only.", "x"), (3, None, "x"), (4, "", "x"), (5, " \n ", "x"),
        (6, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.", "x"),
        (7, "Long before " * 3000 + "Released under the BSD 3-Clause License. " + "and after " * 3000, "x"),
        (8, "Licensed under the GNU Affero General Public License.", "x"), (8, "Licensed under CC BY-SA 4.0.", "x"), (None, "no id", "x"),
        (9, "The driver license was released to the general public.", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, family string")
    scanner = licences.train(docs, key=["doc_id"])
    got = {r["doc_id"]: r for r in licences.by_document(docs, scanner).collect()}
    assert {k: r["licences"] for k, r in got.items()} == {
        1: "mit", 2: "", 3: "", 4: "", 5: "", 6: "apache,mit", 7: "bsd", 8: "agpl,cc-by-sa", None: "", 9: "",
    }
    assert [got[k]["n_paragraphs"] for k in (1, 2, 3, 4, 5, 8)] == [3, 1, 0, 0, 0, 2]
    found = licences.scan(docs, scanner).where("doc_id = 6").orderBy("paragraph").collect()
    assert [(r["paragraph"], r["family"]) for r in found] == [(0, "apache"), (1, "mit")]
    assert licences.by_document(docs.limit(0), scanner).count() == 0


def test_licences_outside_the_list_are_unknown(spark, sf_dir):
    """None of these is among the written notices, listed or not."""
    outside = [
        "Licensed under the Eclipse Public License 2.0.", "ISC License", "Released under the ISC License.",
        "Artistic License 2.0", "Boost Software License", "zlib License", "Apache License, Version 1.1",
        "European Union Public Licence", "Licensed under the Acme Licence.",
    ]
    inside = {"Licensed under the Apache Licence, Version 2.0": "apache", "This is the MIT licence": "mit",
              "You may use it under the GNU Lesser General Public License, version 3": "lgpl"}
    plain = "the and of under any you may with by 2.0"
    texts = [*outside, *inside, plain]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    corpus = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scanner = licences.train(corpus, key=["doc_id"])
    got = {texts[r["doc_id"]]: r["family"] for r in licences.scan(docs, scanner).collect()}
    assert got == {t: "unknown" for t in outside} | inside
    assert {"the", "and", "of"}.isdisjoint(scanner.triggers) and 0.5 <= scanner.sure < 1


def test_lookup_drops_no_paragraph_that_the_model_would_name(spark, sf_dir):
    """Without any trigger the model finds no licence, whatever other terms there are."""
    corpus = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scanner = licences.train(corpus, key=["doc_id"])
    known = {w for t in scanner.vectorizer.vocabulary for w in t.split(" ")}
    rest = sorted(known - set(scanner.triggers))
    text = " ".join(rest * 2 + rest[::-1]) + " " + " ".join(f"{a} {b}" for a in rest for b in rest)
    rows = spark.createDataFrame([(text,)], "text string")
    rows = rows.withColumn("terms", licences.terms(licences.words("text")))
    assert licences._logits(scanner, rows).where(licences._some_licence()).isEmpty()


def test_wrapped_licences(spark):
    import textwrap

    headers = {
        "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "lgpl": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
    }
    rows, want = [], {}
    for width in (30, 60, 70, 80):
        for family, header in headers.items():
            for mark in ("", " * "):
                key = len(rows)
                wrapped = "\n".join(mark + line for line in textwrap.wrap(header, width))
                rows.append((key, f"Some words stand here.\n{wrapped}\nAnd some others follow."))
                want[key] = family
    both = "\n".join(textwrap.wrap(headers["gpl"], 70) + ["Released under the MIT License."] + textwrap.wrap(headers["bsd"], 70))
    rows += [(900, both), (901, "He renewed his driver license\nat the office of general\npublic services."), (902, "Released under the MIT License.\nPlain words.\nMore words.")]
    want |= {900: "bsd,gpl,mit", 901: "", 902: "mit"}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    scanner = licences.train(docs, key=["doc_id"])
    got = {r["doc_id"]: r for r in licences.by_document(docs, scanner).collect()}
    assert {k: r["licences"] for k, r in got.items()} == want
    assert got[902]["n_found"] == 1


# --- The suffix tree against counting in dictionaries ------------------------------


def _tree_scores(rows, S=suffix_tree):
    docs = [(h, [w.lower() for w in (t or "").encode().split()] + [None]) for _, t, h in rows]
    one = Counter(w for h, ws in docs if not h for w in ws)
    total, kinds = sum(one.values()), len(one)
    after = [None, defaultdict(Counter), defaultdict(Counter)]
    for h, ws in docs:
        for k in (1, 2):
            for j in range(k, len(ws)):
                if not h:
                    after[k][tuple(ws[j - k : j])][ws[j]] += 1

    def root(w):
        return (one[w] + 0.1) / (total + 0.1 * (kinds + 1))

    def kept(level, suffix, frequent):
        out = {}
        for context, following in after[level].items():
            words, n = list(following), sum(following.values())
            share = [2 ** (-min(255, round(-math.log2(suffix(context, w)) * 8)) / 8) for w in words]
            count = np.array([following[w] for w in words])
            worth = S.gain(count, np.full(len(words), n), np.full(len(words), len(words)), np.array(share))
            if frequent(context) and n >= S.MIN_COUNT and worth.sum() > S.MIN_GAIN:
                out[context] = following
        return out

    def smooth(following, w, p):
        return float(S.smoothed(following[w], sum(following.values()), len(following), p))

    first = kept(1, lambda c, w: root(w), lambda c: one[c[0]] >= S.MIN_COUNT)

    def p1(context, w):
        following = first.get(context[-1:])
        return smooth(following, w, root(w)) if following else root(w)

    second = kept(2, p1, lambda c: one[c[0]] >= S.MIN_COUNT and after[1][c[:1]][c[1]] >= S.MIN_COUNT_LONG)
    out = []
    for h, ws in docs:
        base = score = 0.0
        for j, w in enumerate(ws):
            base += math.log10(root(w))
            p = p1(tuple(ws[j - 1 : j]), w) if j else root(w)
            following = second.get(tuple(ws[j - 2 : j])) if j > 1 else None
            score += math.log10(smooth(following, w, p) if following else p)
        out.append((len(ws), sum(one[w] > 0 for w in ws), total, base, score, h))
    return out, first, second


def test_suffix_tree_equals_counting(spark):
    rng = np.random.default_rng(3)
    phrases = ["the cat sat on the mat", "a dog ran to the old house", "x y z", "the cat ate a fish"]
    rows = [(k, " ".join(rng.choice(phrases, 1 + k % 5)).replace("ran", f"ran{k % 9}"), k % 5 == 0) for k in range(60)]
    rows += [(100, None, False), (101, "", True), (102, "unseen words Only", True), (None, "the CAT sat", False), (3, rows[3][1], False)]
    want, first, second = _tree_scores(rows)
    assert first and second
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id bigint, text string, out boolean, score double")
    got = suffix_tree.score(docs.repartition(3), held_out=F.col("out")).collect()
    key = lambda r: (r[0] or -1, round(r[1], 6))
    flat = sorted(((r[0], w[3], w[4], *w[:3], w[5]) for r, w in zip(rows, want)), key=key)
    mine = sorted(
        ((r["doc_id"], r["base_score"], r["score"], r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) for r in got), key=key
    )
    for a, b in zip(flat, mine, strict=True):
        assert a[0] == b[0] and a[3:] == b[3:]
        assert math.isclose(a[1], b[1], rel_tol=1e-9) and math.isclose(a[2], b[2], rel_tol=1e-9)


def test_suffix_tree_in_many_blocks(spark):
    """Pairs that one block has alone, and words whose pairs go to several buckets."""
    rng = np.random.default_rng(5)
    common = ["the", "of", "a", "cat", "dog", "house"]
    rows = []
    for k in range(80):
        names = [f"n{k}x{j}" for j in range(3)]  # words of this document only, some often
        words = rng.choice(common + names, 60, p=[0.3, 0.14, 0.14, 0.1, 0.1, 0.07, 0.05, 0.05, 0.05])
        own = f" n{k}x0 n{k}x1 n{k}x2 {'cat' if k % 2 else 'dog'} sat on" * 6
        rows.append((k, " ".join(words) + own, k % 5 == 0))
    rows += [(200, " ".join(f"n{k}x0 n{k}x1 the" for k in range(40)), True), (201, rows[1][1], False)]
    want, first, second = _tree_scores(rows)
    assert first and second
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, out boolean").repartition(2)
    for hot, bucket in ((1 << 18, 1 << 21), (64, 128), (20, 1 << 21)):
        scored = suffix_tree.score(
            docs, held_out=F.col("out"), block_bytes=900, bucket_tokens=bucket, hot=hot
        )
        got = {r["doc_id"]: r for r in scored.collect()}
        assert len(got) == len(rows)
        worst = max(abs(got[r[0]]["score"] / w[4] - 1) for r, w in zip(rows, want))
        assert worst < 1e-9, (hot, worst)
    # One block that holds everything has nothing to exchange beyond single words.
    got = {r["doc_id"]: r for r in suffix_tree.score(docs.coalesce(1), held_out=F.col("out")).collect()}
    assert all(math.isclose(got[r[0]]["score"], w[4], rel_tol=1e-9) for r, w in zip(rows, want))


def test_suffix_tree_leaves_no_table(spark):
    before = spark.sql("SHOW TABLES").count()
    docs = spark.createDataFrame([(1, "a b a b"), (2, "a b")], "doc_id bigint, text string")
    assert suffix_tree.score(docs, held_out=F.lit(False)).count() == 2
    assert spark.sql("SHOW TABLES").count() == before


def test_suffix_tree_edges(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    assert suffix_tree.score(docs.limit(0), held_out=F.lit(True)).count() == 0
    rows = suffix_tree.score(docs, held_out=F.lit(True)).collect()
    assert all(r["train_tokens"] == 0 and math.isclose(r["score"], r["base_score"], abs_tol=1e-12) for r in rows)


def test_folds(spark):
    rows = spark.createDataFrame([(12,), (None,)], "doc_id bigint").select(fold_of("doc_id", 1000)).collect()
    import zlib

    assert [r[0] for r in rows] == [zlib.crc32(b"12") % 1000, 0]
