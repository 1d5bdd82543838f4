"""Quality classifier: supervised subword embeddings.

A document is the mean of the vectors of its words, pairs of words and the
character n-grams of its words, all hashed into one table; a softmax over that mean
gives the class.  Vectors and softmax are trained together by stochastic
gradient descent in numpy, on a sample of ``SAMPLE`` labelled documents per
class at most, whole texts of up to ``SAMPLE_CHARS`` characters.  Scoring needs
only each vector's product with the softmax, one number per bucket, and runs
over whole texts wherever they lie.

Defined cases: a null or empty text, and one of white space only, has the mean
0 and so the score of the bias; documents without label are not trained on;
without a labelled document of either class every score is 0.5, with one class
only its share; a doc_id labelled twice trains twice; repeated rows score
alike; an empty table gives an empty table; columns named like the added ones
are replaced, others kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.arrow import adding, int_lists, map_arrow, slices, texts_of, with_columns
from ledgerloom.llm.codes import Codes, is_space, mixed, ngrams, words

BITS = 16
NGRAMS = (2, 3, 4)
SAMPLE = 1_500
SAMPLE_CHARS = 200_000
THRESHOLD = 0.3
PAIR = np.uint32(0x5BD1E995)


def features(texts: list[str]):
    """For each kind of feature: bucket, whether it counts, and its place."""
    laid = Codes.of(texts)
    space = is_space()[laid.codes]
    codes = np.where(space, np.uint32(32), laid.codes)
    shift = np.uint32(32 - BITS)

    def kinds():
        begin, _, h = words(codes, ~space)
        yield h >> shift, None, begin
        # a pair's hash is the same for every word that is repeated at once
        yield mixed(h[:-1] ^ h[1:] ^ PAIR) >> shift, _same(laid, begin), begin[:-1]
        for n in NGRAMS:
            h, ok = ngrams(codes, n, ~space)
            yield h >> shift, ok, None

    return laid, kinds()


def _same(laid: Codes, begin: np.ndarray) -> np.ndarray:
    """Whether each word and the next lie in one text."""
    owner = laid.owner(begin)
    return owner[:-1] == owner[1:]


def mean_of(texts: list[str], table: np.ndarray) -> np.ndarray:
    """Mean of ``table`` over each text's features; 0 where there are none."""
    laid, kinds = features(texts)
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for bucket, ok, places in kinds:
        if places is not None:
            if ok is not None:
                bucket, places = bucket[ok], places[ok]
            value = table[bucket]
            owner = laid.owner(places)
            total += np.bincount(owner, value, len(texts))
            count += np.bincount(owner, minlength=len(texts))
        else:
            total += laid.sums(np.where(ok, table[bucket], np.float32(0)))
            count += laid.sums(ok)
    return total / np.maximum(count, 1)


def counted(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's distinct buckets and how often they occur."""
    out = []
    for text in texts:
        _, kinds = features([text])
        found = np.concatenate([b if ok is None else b[ok] for b, ok, _ in kinds])
        out.append(np.unique(found, return_counts=True))
    return out


@dataclass
class Model:
    """``table``: a vector's product with the softmax's class difference."""

    table: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-(mean_of(texts, self.table) + self.bias)))


def train(
    rows: list[tuple[int, np.ndarray, np.ndarray]],
    prior: float,
    *,
    size: int = 12,
    epochs: int = 8,
    rate: float = 0.5,
    seed: int = 7,
) -> Model:
    """Fit on (label, buckets, counts); ``prior`` is label 1's share."""
    share = [y for y, _, _ in rows]
    if not rows or min(share) == max(share):
        return Model(np.zeros(1 << BITS, np.float32), 0.0 if not rows else 20.0 * (2 * share[0] - 1))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / size, 1 / size, (1 << BITS, size)).astype(np.float32)
    softmax, bias = np.zeros((size, 2), np.float32), np.zeros(2, np.float32)
    rows = [(y, ids, (n / n.sum()).astype(np.float32)) for y, ids, n in rows if len(ids)]
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            y, ids, weight = rows[i]
            step = rate * (1 - done / steps)
            done += 1
            taken = vectors[ids]
            mean = weight @ taken
            logits = mean @ softmax + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y] -= 1
            back = softmax @ p
            softmax -= step * np.outer(mean, p)
            bias -= step * p
            vectors[ids] = taken - step * back
    difference = softmax[:, 1] - softmax[:, 0]
    balance = sum(share) / len(share)
    shift = np.log(prior / (1 - prior)) - np.log(balance / (1 - balance))
    return Model(vectors @ difference, float(bias[1] - bias[0] + shift))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Train on a bounded sample per class, chosen by the hash of ``doc_id``.

    ``labels`` holds ``doc_id`` and ``quality``; only its rows are learned from.
    """
    known = labels.select("doc_id", F.col("quality").cast("int")).where("quality in (0, 1)")
    count = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    if not count:
        return train([], 0.5)
    chosen = [
        known.where(F.col("quality") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        for y in sorted(count)
    ]
    ids = [r for part in chosen for r in part.collect()]  # 2 * sample rows at most
    picked = docs.sparkSession.createDataFrame(ids, known.schema)
    texts = docs.select("doc_id", "text").where(F.length("text") <= SAMPLE_CHARS)

    def run(batches):
        for batch in slices(batches, "text"):
            found = counted(texts_of(batch, "text"))
            lengths = [len(b) for b, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("quality"),
                    int_lists(np.concatenate([b for b, _ in found]).astype(np.int32), lengths),
                    int_lists(np.concatenate([n for _, n in found]).astype(np.int32), lengths),
                ],
                names=["quality", "buckets", "counts"],
            )

    labelled = texts.join(F.broadcast(picked), "doc_id").select("quality", "text")  # the sample
    rows = map_arrow(labelled, run, "quality int, buckets array<int>, counts array<int>")
    return train(_rows_of(rows.toArrow()), count.get(1, 0) / sum(count.values()))


def _rows_of(rows: pa.Table) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """The sample in an order that does not depend on its partitions."""
    out = [
        (y.as_py(), np.asarray(b.values), np.asarray(n.values))
        for y, b, n in zip(rows["quality"], rows["buckets"], rows["counts"], strict=True)
    ]
    return sorted(out, key=lambda r: (r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score`` and ``predicted`` (1 from ``threshold`` on)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches, "text", 2 << 20):
            value = held.value.score(texts_of(batch, "text"))
            yield with_columns(
                batch,
                {"score": pa.array(value), "predicted": pa.array((value >= threshold).astype(np.int32))},
            )

    return adding(docs, run, {"score": T.DoubleType(), "predicted": T.IntegerType()})
