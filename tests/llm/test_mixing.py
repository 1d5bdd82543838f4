"""Mixing: targets against brute force, the cube method's balance, reruns."""

from __future__ import annotations

import os
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import cube, mixing
from ledgerloom.llm.queries import QUERIES
from ledgerloom.sources.scratch import Scratch

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def simple_targets(totals):
    """Reshare what is above, until nothing is."""
    names = sorted((s for s in totals if s is not None), key=lambda s: s.encode()) + [None] * (None in totals)
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    target, free, left = {}, set(names), sum(totals.values())
    while free:
        share = left / sum(weight[s] for s in free)
        above = {s for s in free if share * weight[s] > 3 * totals[s]}
        if not above:
            target |= {s: share * weight[s] for s in free}
            break
        for s in above:
            target[s] = 3.0 * totals[s]
            left -= target[s]
        free -= above
    return target


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text").collect()
    size, source = {r.doc_id: words(r.text) for r in docs}, {r.doc_id: r.source for r in docs}
    totals = defaultdict(int)
    for doc, name in source.items():
        totals[name] += size[doc]
    target = simple_targets(totals)
    taken = defaultdict(int)
    got = QUERIES["op12_mixing"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(size)
    for r in got:
        name = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], totals[name])
        assert r.target == pytest.approx(target[name], rel=1e-12)
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 3
        taken[name] += r.taken
    most = defaultdict(int)
    for doc, name in source.items():
        most[name] = max(most[name], size[doc])
    assert all(abs(taken[s] - target[s]) <= most[s] for s in totals)
    assert abs(sum(taken.values()) - sum(target.values())) < 0.02 * sum(target.values())


KIND = "doc_id long, source string, size long, text_hash long"


def mixed(spark, rows, parts=4):
    df = spark.createDataFrame(rows, KIND).repartition(parts)
    return mixing.mix(df, Scratch(spark)).collect()


def many(sources=4, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    size = np.maximum(1, rng.lognormal(5, 1.5, n)).astype(int).tolist()
    which = np.minimum(rng.integers(0, sources + 3, n), sources - 1).tolist()
    return [(i, f"s{w}", s, i) for i, (w, s) in enumerate(zip(which, size, strict=True))]


def test_balance_and_reruns(spark, monkeypatch):
    monkeypatch.setattr(mixing, "HEADS", 64)
    monkeypatch.setattr(mixing, "CHUNK", 32)  # several levels of groups
    rows = many()
    got = mixed(spark, rows)
    totals, docs = defaultdict(int), Counter()
    for _, s, size, _ in rows:
        totals[s] += size
        docs[s] += 1
    target = simple_targets(totals)
    words_taken, docs_taken = defaultdict(int), defaultdict(int)
    for r in got:
        words_taken[r.source] += r.taken
        docs_taken[r.source] += r.copies
        ratio = target[r.source] / totals[r.source]
        assert np.floor(ratio) <= r.copies <= np.ceil(ratio)
    for s in totals:
        assert words_taken[s] == pytest.approx(target[s], rel=1 / 64)
        assert docs_taken[s] == pytest.approx(docs[s] * target[s] / totals[s], rel=0.1)
    again = mixed(spark, rows[::-1], parts=13)
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_sources_are_many(spark):
    rows = [(i, f"{i % 400:04x}", 1 + (i * 7919) % 90, i) for i in range(2400)]
    totals = defaultdict(int)
    for _, s, size, _ in rows:
        totals[s] += size
    target = simple_targets(totals)
    for r in mixed(spark, rows):
        assert r.target == pytest.approx(target[r.source], rel=1e-12)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PIECE", 10)
    rows = [(1, "a", 10, 5)] * 40 + [(None, "a", 10, 6)] * 25 + [(None, None, 0, None), (7, None, 4, 1), (7, None, 0, 2)]
    rows += [(i, "é", 3, 1) for i in range(50)] + [(99, "empty", 0, 0)]
    got = mixed(spark, rows)
    kept = Counter((r.doc_id, r.source, r.size) for r in got)
    assert kept == Counter((d, s, z) for d, s, z, _ in rows)
    totals = defaultdict(int)
    for _, s, size, _ in rows:
        totals[s] += size
    target, taken = simple_targets(totals), defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
        assert r.taken <= 3 * r.size and r.target == pytest.approx(target[r.source])
    assert target["empty"] == 0 and target[None] == 12
    assert all(abs(taken[s] - target[s]) <= 10 for s in totals)
    assert mixed(spark, []) == []


def test_documents_and_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(1, "a b  c\n", "x", 1, 2), (1, "a b  c\n", "x", 1, 2), (2, None, "x", 3, 4), (3, " ", None, 5, 6), (4, "z " * 5, "y", 7, 8)],
        "doc_id long, text string, source string, size int, mixed_row int",
    )
    assert sorted(r["size"] for r in mixing.sizes(docs).collect()) == [0, 0, 3, 3, 5]
    out = mixing.mixture(docs, Scratch(spark))
    assert set(out.columns) == set(docs.columns)
    decided = mixing.mix(mixing.sizes(docs), Scratch(spark)).collect()
    assert Counter(r.doc_id for r in out.collect()) == Counter(
        r.doc_id for r in decided for _ in range(r.copies)
    )
    empty = mixing.mixture(docs.limit(0), Scratch(spark))
    assert empty.collect() == []


def test_size_of_long_text(spark):
    text = "wört x \x0b" * 200_000
    df = spark.createDataFrame([(text,)], "text string").select(mixing.size_of(F.col("text")).alias("n"))
    assert df.first().n == words(text) == 200_000


@pytest.mark.parametrize("share", [0.05, 0.4, 0.9])
def test_cube_keeps_its_totals(share):
    for seed in range(20):
        rng = np.random.default_rng(seed)
        s = np.sort(np.maximum(0, rng.lognormal(5, 1, 80)).astype(int))[::-1].astype(float)
        p, _ = cube.settle(s, np.full(80, share), rng)
        assert ((p > 0) & (p < 1)).sum() <= 2
        assert p.sum() == pytest.approx(80 * share, abs=1e-6)
        assert p @ s == pytest.approx(share * s.sum(), rel=1e-7)
        landed, _ = cube.settle(s, np.full(80, share), rng, land=True)
        assert set(landed.tolist()) <= {0.0, 1.0}


def test_cube_is_unbiased():
    s = np.array([50.0, 40, 30, 20, 10, 10, 10, 5])
    runs = [cube.settle(s, np.full(8, 0.3), np.random.default_rng([9, i]), land=True)[0] for i in range(3000)]
    np.testing.assert_allclose(np.mean(runs, 0), 0.3, atol=0.04)


def test_a_tail_makes_up_for_the_heads():
    heads, tail_sizes = np.array([900.0, 700, 650]), np.arange(1.0, 400)
    tail = cube.Tail(len(tail_sizes), tail_sizes.sum(), (tail_sizes**2).sum(), tail_sizes.max(), 0.4)
    p, after = cube.settle(heads, np.full(3, 0.4), np.random.default_rng(2), tail=tail)
    assert set(p.tolist()) <= {0.0, 1.0}
    line = after.share + after.slope * tail_sizes
    assert line.min() >= -1e-9 and line.max() <= 1 + 1e-9
    assert p @ heads + line @ tail_sizes == pytest.approx(0.4 * (heads.sum() + tail_sizes.sum()))
    assert p.sum() + line.sum() == pytest.approx(0.4 * (3 + len(tail_sizes)))
