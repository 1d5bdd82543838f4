"""Near-duplicates, components and decontamination against brute force."""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import cover_tree, decontaminate, embeddings, simhash
from ledgerloom.llm.components import components
from ledgerloom.llm.queries import QUERIES
from ledgerloom.sources.scratch import Scratch

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def components_of(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("shape", ["chain", "hub", "random", "none"])
def test_components(spark, shape):
    rng = np.random.default_rng(5)
    links = {
        "chain": [(i + 1, i) for i in range(40)] + [(100, 101)],
        "hub": [(0, i) for i in range(1, 60)] + [(7, 7), (61, 60)],
        "random": [tuple(map(int, p)) for p in rng.integers(0, 80, (50, 2))],
        "none": [],
    }[shape]
    df = spark.createDataFrame([*links, *links[:3], (None, 1)], "a long, b long")
    got = {r.node: r.root for r in components(df, Scratch(spark)).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == components_of(nodes, [p for p in links if p[0] != p[1]])


# -- SimHash -------------------------------------------------------------------


def simple_fingerprint(text):
    from xxhash import xxh64_intdigest

    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("radius", [1, 2, 3, 5])
def test_bit_sliced_pairs(radius):
    rng = np.random.default_rng(radius)
    some = rng.integers(0, 2**64, 150, np.uint64, endpoint=False)
    near = [v ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False))) for v in some[:60] for k in range(7)]
    values = rng.permutation(np.concatenate([some, np.array(near, np.uint64)]))
    buckets = np.sort(rng.integers(0, 30, len(values)))
    got = {tuple(p) for p in simhash.near_pairs(values, buckets, radius).tolist()}
    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    same = buckets[:, None] == buckets[None, :]
    assert got == {tuple(p) for p in np.argwhere(np.triu((apart <= radius) & same, 1)).tolist()}


def brute_simhash(rows, radius=3):
    prints = {}
    for doc, text in rows:
        prints.setdefault(simple_fingerprint(text), []).append(doc)
    values = sorted(prints)
    links = [(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= radius]
    roots = components_of(values, links)
    least = {}
    for v in values:
        known = [d for d in prints[v] if d is not None]
        least[roots[v]] = min([*known, least.get(roots[v], 1 << 62)])
    return {(doc, simple_fingerprint(t)): least[roots[simple_fingerprint(t)]] for doc, t in rows}


@pytest.mark.parametrize("most", [2, simhash.MOST])
def test_simhash_of_the_tables(spark, most):
    """Also with buckets that are split at every level, down to pairs of chunks."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    # near copies: one word changed in a long text
    more = [(10**6 + i, t.replace(" ", " x ", 1)) for i, (_, t) in enumerate(rows[:80])]
    rows += more + [(None, ""), (5 * 10**6, None), (5 * 10**6 + 1, " \n"), (5 * 10**6 + 1, " \n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit("x"))
    got = simhash.near_duplicates(df, Scratch(spark), most=most).collect()
    assert len(got) == len(rows)
    expected = brute_simhash(rows)
    for r in got:
        assert r.component_id == expected[r.doc_id, r.fingerprint & 2**64 - 1]


def test_simhash_query_and_empty(spark):
    rows = QUERIES["op6_simhash"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.fingerprint == f"{simple_fingerprint(texts[r.doc_id]):016x}" for r in rows)
    assert simhash.near_duplicates(docs.limit(0), Scratch(spark)).count() == 0


# -- embeddings ----------------------------------------------------------------


def test_cover_tree_of_random_points():
    rng = np.random.default_rng(9)
    for _ in range(40):
        size, dims = int(rng.integers(1, 90)), int(rng.integers(1, 6))
        vectors = rng.normal(size=(size, dims))
        vectors /= np.linalg.norm(vectors, axis=1)[:, None]
        cosine, split = float(rng.uniform(0.2, 0.99)), int(rng.integers(1, size + 1))
        weight = rng.integers(1, 4, size)
        near = vectors @ vectors.T >= cosine
        np.fill_diagonal(near, False)
        if split < size:
            near[:split, :split] = near[split:, split:] = False
        links = cover_tree.threshold_links(vectors, split, weight, cosine)
        assert (links.count == near @ weight).all()
        roots = components_of(range(size), np.argwhere(near).tolist())
        assert [links.root(i) for i in range(size)] == [roots[i] for i in range(size)]


@pytest.mark.parametrize("block", [40, embeddings.BLOCK])
def test_embeddings_of_the_tables(spark, block):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    rng = np.random.default_rng(4)
    base = rows[0][1]
    near = [(2000 + i, (np.array(base) + rng.normal(0, 0.01, len(base))).tolist()) for i in range(120)]
    odd = [None, [], [0.0] * 64, [float("nan")] * 64, [None, *base[1:]], [float("inf")] * 64]
    rows += near + [(3000 + i, v) for i, v in enumerate(odd)]
    rows += [(4000, base), (4001, [4 * x for x in base]), (4002, base[:5]), (4003, base[:5]), (4003, base[:5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("node", F.lit(1))
    got = embeddings.near_duplicates(df, Scratch(spark), block=block).collect()
    good = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and any(v) for _, v in rows]
    links, count = [], [0] * len(rows)
    for size in (5, 64):
        at = [i for i, ok in enumerate(good) if ok and len(rows[i][1]) == size]
        vectors = np.array([rows[i][1] for i in at], np.float32).astype(float)
        vectors /= np.linalg.norm(vectors, axis=1)[:, None]
        for a, b in np.argwhere(np.triu(vectors @ vectors.T >= 0.95, 1)).tolist():
            links.append((at[a], at[b]))
            count[at[a]] += 1
            count[at[b]] += 1
    roots = components_of(range(len(rows)), links)
    least = {}
    for i, (vec, _) in enumerate(rows):
        least[roots[i]] = min(vec, least.get(roots[i], vec))
    expected = sorted((vec, count[i], least[roots[i]]) for i, (vec, _) in enumerate(rows))
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == expected
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert embeddings.near_duplicates(df.limit(0), Scratch(spark)).count() == 0


# -- decontamination -----------------------------------------------------------


def words(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_hits(docs, items):
    windows = {}
    for item, text in items:
        own = words(text)
        size = min(10, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            windows.setdefault(tuple(own[i : i + size]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for size in lengths:
            for i in range(len(own) - size + 1):
                if ids := windows.get(tuple(own[i : i + size])):
                    hit.update(range(i, i + size))
                    found |= ids
        named = sorted(str(i) for i in found if i is not None)
        sha = hashlib.sha256(",".join(named).encode()).hexdigest()
        out.append((doc, len(own), len(hit), len(named), sha, bool(hit)))
    return sorted(out, key=str)


def hits(df, items, spark):
    rows = decontaminate.decontaminate(df, items, Scratch(spark))
    sha = F.sha2(F.array_join("items", ","), 256)
    columns = ["doc_id", "n_words", "n_hit", "n_items", sha, "contaminated"]
    return sorted((tuple(r) for r in rows.select(*columns).collect()), key=str)


def test_hits_of_the_tables(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    expected = brute_hits(
        [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]
    )
    got = sorted((tuple(r) for r in QUERIES["op1_decontaminate"](spark, SF).collect()), key=str)
    assert got == expected and any(r[-1] for r in got)


def test_hits_of_odd_rows(spark):
    """Short, repeated, empty and null items; runs of one word; equal rows."""
    a = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    items = [(1, a), (2, a.upper()), (2, a), (3, "über alles"), (4, "x x x x x x x x x x x x"), (5, None),
             (6, " .,"), (7, "solo"), (None, "null item words"), (8, "one two three four five six seven")]
    docs = [(1, "pre " + a + " post"), (1, "pre " + a + " post"), (2, None), (3, ""), (None, "x " * 40),
            (5, "Über-Alles; solo! null item words"), (6, " ".join(a.split()[1:])), (7, "one two three four five six"),
            (8, "zero one two three four five six seven eight"), (9, " ".join(a.split()[:9])), (10, "q " * 30_000 + a)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("words", F.lit(0))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("length", F.lit("y"))
    assert hits(df, bench, spark) == brute_hits(docs, items)
    assert hits(df.limit(0), bench, spark) == []
    assert all(not r[-1] for r in hits(df, bench.limit(0), spark))


def test_random_texts_of_few_words(spark):
    rng = np.random.default_rng(8)
    make = lambda n: " ".join(rng.choice(["a", "b", "c"], n))
    items = [(i, make(int(rng.integers(1, 25)))) for i in range(40)]
    docs = [(i, make(int(rng.integers(0, 80)))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert hits(df, bench, spark) == brute_hits(docs, items)


def test_decontamination_runs_without_python(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    df = decontaminate.decontaminate(docs, items, Scratch(spark))
    plan = df._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "InPandas", "InArrow", "CartesianProduct"))


def test_many_separate_hits_in_one_text(spark):
    """10 MB with over 100,000 hits: no row holds the text, spans merge in order."""
    import time

    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    text = f"{item} some other words in between the passages " * 103_000
    docs = spark.createDataFrame([(1, text), (2, "nothing of it"), (3, f"x {item} {item} y")], "doc_id long, text string")
    items = spark.createDataFrame([("a", item)], "item_id string, text string")
    begin = time.perf_counter()
    got = {r.doc_id: r for r in decontaminate.decontaminate(docs, items, Scratch(spark)).collect()}
    assert len(text) > 10_000_000 and time.perf_counter() - begin < 60
    assert (got[1].n_hit, len(got[1].spans), got[1].n_words) == (1_030_000, 103_000, 1_751_000)
    assert [tuple(s) for s in got[1].spans[:2]] == [(0, 10), (17, 27)]
    assert got[2].n_hit == 0 and got[2].spans == []
    assert [tuple(s) for s in got[3].spans] == [(1, 21)] and got[3].items == ["a"]


def test_cosines_are_of_doubles(spark):
    """Vectors that only differ beyond a float, and values no float holds."""
    near, far = 0.95 + 1e-12, 0.95 - 1e-12
    rows = [(i, [c, float(np.sqrt(1 - c * c))]) for i, c in ((2, near), (3, far))]
    rows += [(1, [1.0, 0.0]), (4, [1e300, 1e300]), (5, [1e299, 1e299])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embeddings.near_duplicates(df, Scratch(spark)).collect()}
    assert got[4].component_id == got[5].component_id == 4
    assert got[1].n_links == 1 and got[2].component_id == 1
    assert got[3].n_links == 1 and got[3].component_id == 1  # by way of 2
