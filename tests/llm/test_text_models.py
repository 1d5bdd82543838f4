"""Quality classifier, language identification, licence scans: held-out accuracy,
brute force and edge cases."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import language, licenses, quality
from ledgerloom.llm.codes import Codes, ngrams, words
from ledgerloom.llm.queries import QUERIES
from ledgerloom.sources.scratch import Scratch

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"
EDGES = [
    (1, None, None, None, None, "x"),
    (2, "", "en", "s", 0, "x"),
    (3, " \n\t", "en", "s", 3, None),
    (4, "a", "en", "s", 1, "x"),
    (4, "a", "en", "s", 1, "x"),
    (None, "Word " * 60_000, None, "s", None, "x"),
    (7, "12 34 -- !!", "de", "s", 11, "x"),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, DOCS)


def test_words_and_ngrams_of_codes():
    laid = Codes.of(["ab c", "", "ab"])
    assert laid.starts.tolist() == [1, 6, 7] and laid.ends.tolist() == [5, 6, 9]
    inside = laid.codes != 32
    begin, end, h = words(laid.codes, inside)
    assert [laid.joined[a:b] for a, b in zip(begin, end, strict=True)] == ["ab", "c", "ab"]
    assert h[0] == h[2] != h[1]
    _, ok = ngrams(laid.codes, 3, inside)
    assert [laid.joined[i : i + 3] for i in np.flatnonzero(ok)] == [" ab", "ab ", " c ", " ab", "ab "]


def test_quality_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality is not null")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in QUERIES["op2_quality"](spark, SF).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    known = [r for r in rows if r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in known]) > 0.93
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)


def test_quality_score_is_the_softmax_of_the_mean(spark):
    """The table of products gives what the vectors and the softmax give."""
    rng = np.random.default_rng(1)
    vectors, softmax = rng.normal(size=(1 << quality.BITS, 3)), rng.normal(size=(3, 2))
    model = quality.Model((vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), 0.1)
    texts = ["Some words here, some words there", "", "The The The", "  é ü  "]
    for text, score in zip(texts, model.score(texts), strict=True):
        ids, counts = quality.counted([text])[0]
        mean = counts @ vectors[ids] / max(counts.sum(), 1)
        logits = mean @ softmax + [0, 0.1]
        assert score == pytest.approx(np.exp(logits[1]) / np.exp(logits).sum(), abs=1e-5)


def test_quality_edges(spark, edges):
    empty = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(edges, empty)
    assert {r.score for r in quality.score(edges, model).collect()} == {0.5}
    one = spark.createDataFrame([(4, 1), (None, 1), (4, None)], "doc_id long, quality int")
    rows = quality.score(edges, quality.fit(edges, one)).collect()
    assert len(rows) == len(EDGES) and all(r.predicted == 1 for r in rows)
    assert quality.score(edges, model).columns == [*edges.columns[:-1], "score", "predicted"]
    assert quality.score(edges.limit(0), model).count() == 0


def test_language_held_out(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op8_language"](spark, SF).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows]) > 0.97


def test_forward_backward_is_exact():
    """Marginals and expected transitions against all label sequences."""
    from itertools import product

    rng = np.random.default_rng(2)
    emission, move = rng.normal(size=(7, 3)), rng.normal(size=(3, 3))
    chains = language.Chains(np.array([0, 4, 6]), np.array([4, 2, 1]))
    share, expected = language.forward_backward(emission, move, chains, pairs=True)
    total = np.zeros((3, 3))
    for first, length in ((0, 4), (4, 2), (6, 1)):
        weight, sums, pairs = 0.0, np.zeros((length, 3)), np.zeros((3, 3))
        for labels in product(range(3), repeat=length):
            score = sum(emission[first + i, k] for i, k in enumerate(labels))
            score += sum(move[a, b] for a, b in zip(labels, labels[1:], strict=False))
            weight += (w := np.exp(score))
            for i, k in enumerate(labels):
                sums[i, k] += w
            for a, b in zip(labels, labels[1:], strict=False):
                pairs[a, b] += w
        assert np.allclose(share[first : first + length], sums / weight)
        total += pairs / weight
    assert np.allclose(expected, total)


@pytest.mark.parametrize("most", [1, 2, 5, 64])
def test_messages_cross_the_ends_of_stretches(most):
    """A text is one chain, however it is cut for the work."""
    rng = np.random.default_rng(4)
    sizes = [1, 200, 64, 3, 129, 128]
    owner = np.repeat(np.arange(len(sizes)) * 2, sizes)  # some texts have no word
    emission, move = 2 * rng.normal(size=(len(owner), 4)), 2 * rng.normal(size=(4, 4))
    ends = np.cumsum(sizes)
    whole, _ = language.forward_backward(
        emission, move, language.Chains(ends - np.array(sizes), np.array(sizes))
    )
    first, length = language.cut(owner, most)
    chains = language.Chains(first, length)
    share, _ = language.forward_backward(emission, move, chains, text=owner[first])
    assert np.allclose(share, whole, rtol=1e-9, atol=1e-12)
    if most < 64:
        alone, _ = language.forward_backward(emission, move, chains)
        assert not np.allclose(alone, whole, atol=1e-3)


def test_language_of_switching_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs, F.lit(True))
    picked = {r.lang: r.text for r in docs.where("n_chars > 1500").collect()}
    first, second = sorted(picked)[:2]
    text = picked[first][:600] + " " + picked[second][:600]
    _, share = model.marginals([text])
    labels = [model.labels[k] for k in share.argmax(1)]
    half = len(labels) // 2
    assert np.mean([x == first for x in labels[: half - 10]]) > 0.8
    assert np.mean([x == second for x in labels[half + 10 :]]) > 0.8


def test_language_edges(spark, edges):
    model = language.fit(edges, F.lit(True))
    rows = language.predict(edges, model).collect()
    assert len(rows) == len(EDGES)
    by = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in rows}
    for key in ((1, None), (2, ""), (3, " \n\t"), (7, "12 34 -- !!")):
        assert by[key] == ("und", 0.0)
    nothing = language.predict(edges, language.fit(edges, F.lit(False))).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert language.predict(edges.limit(0), model).count() == 0


@pytest.fixture(scope="module")
def license_model(spark):
    return licenses.fit(spark.read.parquet(f"{SF}/documents.parquet"))


def test_licenses_against_brute_force(spark, license_model):
    lines = [
        "Released under the MIT License.",
        "this project is released under the mit license, see there",
        "All rights reserved.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this",
        "the of and to in a the of and",
        "This work is licensed under the GNU General Public License, version 3.",
        "License, version 3. General GNU the under is licensed work This",
        "one",
        "",
    ]
    docs = spark.createDataFrame(
        [(1, "\n".join(lines), "x"), (1, "\n".join(lines), "x"), (2, None, "x"), (None, lines[5], "y")],
        "doc_id long, text string, place string",
    )
    found = {
        (r.doc_id, r.place): (r.family, r.probability, r.similarity)
        for r in licenses.scan(docs, license_model, Scratch(spark)).collect()
    }
    expected = {}
    for doc, texts in ((1, lines), (None, [lines[5]])):
        for place, text in enumerate(texts):
            p = license_model.probabilities(text)
            best = int(p[:-1].argmax())
            own = licenses.grams_here(licenses.words_here(text))
            if p[best] < license_model.least or not own & set(license_model.vocabulary):
                continue
            near = 0.0
            for template in licenses.TEMPLATES[license_model.classes[best]]:
                other = licenses.grams_here(licenses.words_here(template))
                shared = len(own & other)
                if shared >= licenses.LEAST_SHARED:
                    near = max(near, shared / len(own), shared / len(other))
            if own:
                expected[doc, place] = (license_model.classes[best], p[best], near)
    expected = {k: v for k, v in expected.items() if v[2] > 0 or k in found}
    assert found.keys() == expected.keys()
    for key, (family, share, near) in expected.items():
        assert found[key][0] == family
        assert found[key][1] == pytest.approx(share, abs=1e-5)
        assert found[key][2] == pytest.approx(near)
    assert {(1, 0), (1, 5), (None, 0)} <= found.keys()
    per = licenses.of_documents(docs, license_model, Scratch(spark)).collect()
    assert sorted((r.doc_id or 0, r.families) for r in per if r.families)[0] == (0, ["GPL-3.0"])
    assert len(per) == 4 and sum(r.doc_id == 1 and "MIT" in r.families for r in per) == 2


def test_licenses_of_the_tables(spark):
    """Every licence line of the tables, and nothing else, is found."""
    known = {
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
        "CC-BY-NC": "Licensed under CC BY-NC 4.0.",
        "MIT": "Released under the MIT License.",
        "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    }
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op7_licenses"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        expected = sorted(f for f, line in known.items() if line in texts[r.doc_id])
        assert r.families == ",".join(expected)


def test_licenses_edges(spark, edges, license_model):
    rows = licenses.of_documents(edges, license_model, Scratch(spark)).collect()
    assert len(rows) == len(EDGES) and all(r.n_licenses == 0 for r in rows)
    assert licenses.of_documents(edges.limit(0), license_model, Scratch(spark)).count() == 0


def test_licenses_run_without_python(spark, license_model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    df = licenses.of_documents(docs, license_model, Scratch(spark))
    assert not any(x in df._jdf.queryExecution().toString() for x in ("Python", "InPandas", "InArrow"))
