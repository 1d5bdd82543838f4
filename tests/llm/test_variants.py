"""Spelling variants against all pairs, in one leaf and in many."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import letter_tree, variants
from ledgerloom.sources.scratch import Scratch

KIND = "doc_id long, text string, word string, n int"


def edits(x, y):
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    if len(x) > len(y):
        x, y = y, x
    return len(y) == len(x) + 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def brute(docs):
    n = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= 2}
    near = {w: [o for o in n if abs(len(o) - len(w)) < 2 and edits(w, o)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n.get(form[w]) or 0) for w in n)


def found(spark, docs, block=variants.BLOCK, parts=3):
    df = spark.createDataFrame([(d, t, "clash", 1) for d, t in docs], KIND).repartition(parts)
    rows = variants.variants(df, Scratch(spark), block).collect()
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in rows)


def invented(words, copies, letters="abcé", seed=3):
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(7, 10))) for _ in range(words)]
    text = []
    for w in base:
        at, c = rng.randrange(len(w)), rng.choice(letters)
        for other in (w, w[:at] + c + w[at + 1 :], w[:at] + w[at + 1 :], w[:at] + c + w[at:]):
            text += [other] * (rng.choice(copies) if other == w else rng.choice([1, 2, 3]))
    rng.shuffle(text)
    return [(i, " ".join(text[i::40])) for i in range(40)]


@pytest.mark.parametrize("block", [variants.BLOCK, 60, 8])
def test_equals_all_pairs(spark, block):
    docs = invented(150, [2, 30, 300])
    assert found(spark, docs, block) == brute(docs)


def test_leaves_that_counts_cannot_split(spark):
    """Permutations of the same letters, cut by halves."""
    rng = random.Random(5)
    base = {"".join(rng.sample("abcdabcd", 8)) for _ in range(150)}
    more = {w[:i] + c + w[i + 1 :] for w in sorted(base)[:40] for i, c in ((0, "b"), (5, "d"))}
    longer = {w[:i] + "a" + w[i:] for w in sorted(base)[:60] for i in (0, 3, 4, 8)}
    shorter = {w[:i] + w[i + 1 :] for w in sorted(base)[:60] for i in (0, 3, 4, 7)}
    docs = [(i, " ".join(sorted(base | more | longer | shorter))) for i in range(2)]
    whole = brute(docs)
    assert sum(r[4] for r in whole) > 300
    assert found(spark, docs, 20) == whole
    words = variants._counted(variants.word_counts(spark.createDataFrame(docs, "doc_id long, text string")))
    leaves = variants.fit_leaves(Scratch(spark).stage(words, "words"), Scratch(spark), 20)
    assert leaves.halved and leaves.trees


def test_chains_of_forms(spark):
    counts = {"abcdefg": 2, "abcdefgh": 40, "abcdefghi": 500, "abcdefghij": 6000, "zzzzzzz": 9}
    docs = [(1, " ".join(w for w, n in counts.items() for _ in range(n)))]
    got = {r[0]: r for r in found(spark, docs)}
    assert found(spark, docs) == brute(docs)
    assert got["abcdefg"][2] == "abcdefghij"


def test_odd_texts(spark):
    long = "ab" * 30_000
    docs = [
        (1, None), (2, ""), (3, "×÷×÷×÷× ×÷×÷×÷×"), (None, "ÀÉÎÕÜßÿ ÀÉÎÕÜßÿ àéîõüßÿ"), (None, "Straße-Straßen Straßen"),
        (4, f"{long} {long} {long}a"), (5, f"{long}a {long}b {long}b"), (5, f"{long}a {long}b {long}b"),
        (6, "ABCDEFG abcdefg İstanbul ſabcdefgh ſabcdefgh"),
    ]
    assert found(spark, docs) == brute(docs)
    assert found(spark, [(1, None), (2, "short words")]) == []
    assert found(spark, [], parts=1) == []


def test_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(variants, "PIECE", 5)
    text = "aaaaaaaaaaaa bb, cccccccc\nd eeeeeeeeeee"
    assert "".join(variants._pieces(text)) == text
    assert [r for p in variants._pieces(text) for r in variants.RUN.findall(p)] == variants.RUN.findall(text)


def test_near_vectors_equal_all_pairs():
    rng = np.random.default_rng(1)
    points = np.unique(rng.integers(0, 3, (500, letter_tree.LETTERS)) * (rng.random(letter_tree.LETTERS) < 0.06), axis=0)
    points = points.astype(np.uint8)
    apart = points[None].astype(int) - points[:, None]
    more, less = np.maximum(apart, 0).sum(2), np.maximum(-apart, 0).sum(2)
    for gain, lose in ((1, 1), (1, 0)):
        wanted = np.argwhere((more <= gain) & (less <= lose) & (more + less > 0)).tolist()
        assert wanted
        assert sorted(letter_tree.near_vectors(points, points, gain, lose, leaf=4).tolist()) == wanted


def test_many_words_of_the_same_counts_meet_by_what_is_left():
    rng = random.Random(2)
    xs = sorted({"".join(rng.sample("aabbccd", 7)) for _ in range(60)})
    ys = sorted({"".join(rng.sample("aabbccc", 7)) for _ in range(60)})
    zs = sorted({"".join(rng.sample("aabbccdd", 8)) for _ in range(90)})
    for other in (ys, zs):
        assert len(xs) * len(other) > variants.PAIRS
        wanted = [(i, j) for i, x in enumerate(xs) for j, y in enumerate(other) if edits(x, y)]
        assert wanted and variants.linked(xs, other) == wanted
