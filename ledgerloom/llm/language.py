"""Language identification with a linear-chain conditional random field.

Every word (a run of letters) gets a label, so that texts which switch between
languages are told apart word by word.  A word's features are its hashed form
(lexicon), its first and last one to three letters (affixes) and its character
n-grams with word edges; label transitions are learned with them by gradient
ascent of the sequence likelihood, computed by forward-backward.  A text is one
chain, whatever its length: stretches of ``CHAIN`` words are worked on side by
side, with the messages that cross their ends, which follow from each stretch's
product of transitions and emissions.  A text's language is the label with the
largest mean marginal over its words, and that mean is its score.

Training uses a sample of ``SAMPLE`` documents per language at most, whole
texts of up to ``SAMPLE_CHARS`` characters, and chains of up to ``CHAIN`` words
that are put together from stretches of several documents, which is how
switching is learned.

Defined cases: a text that is null or has no letter is ``und`` with score 0,
and so is any text where nothing could be learned; with one language every
other text has it with score 1; equal marginals go to the label first in
alphabetical order; repeated rows score alike; an empty table gives an empty
table; columns named like the added ones are replaced, others kept.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.arrow import adding, slices, texts_of, with_columns
from ledgerloom.llm.codes import MULTIPLIERS, Codes, is_letter, lower, mixed, ngrams, words

BITS = 16
NGRAMS = (2, 3, 4)
AFFIXES = (1, 2, 3)
CHAIN = 64
SAMPLE = 250
SAMPLE_CHARS = 100_000
UNKNOWN = "und"


@dataclass
class Words:
    """The words of several texts: where they lie, and their features."""

    laid: Codes
    codes: np.ndarray
    inside: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    hashes: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> "Words":
        laid = Codes.of(texts)
        inside = is_letter()[laid.codes]
        codes = np.where(inside, lower()[laid.codes], np.uint32(32))
        return cls(laid, codes, inside, *words(codes, inside))

    def __len__(self) -> int:
        return len(self.begin)

    def of_words(self):
        """Kinds with one bucket a word: (buckets, whether the word has it)."""
        shift = np.uint32(32 - BITS)
        yield self.hashes >> shift, np.ones(len(self), bool)
        length = self.end - self.begin
        for side, seed in (("first", 101), ("last", 211)):
            h = np.full(len(self), seed, np.uint32)
            for n in AFFIXES:
                has = length >= n
                place = self.begin + n - 1 if side == "first" else self.end - n
                h = h + self.codes[np.where(has, place, self.begin)] * MULTIPLIERS[n]
                yield mixed(h + np.uint32(n)) >> shift, has

    def of_places(self):
        """Kinds with a bucket for each place of a word or its edge."""
        for n in NGRAMS:
            h, ok = ngrams(self.codes, n, self.inside)
            yield h >> np.uint32(32 - BITS), ok

    def emissions(self, table: np.ndarray) -> np.ndarray:
        """Sum of ``table`` over each word's features: a row per word."""
        total = np.zeros((len(self), table.shape[1]), np.float32)
        if not len(self):
            return total
        # a feature that is absent takes the row of zeros after the last bucket
        table = np.vstack([table, np.zeros_like(table[:1])])
        absent = np.uint32(len(table) - 1)
        for bucket, has in self.of_words():
            total += table[np.where(has, bucket, absent)]
        for bucket, ok in self.of_places():
            total += np.add.reduceat(table[np.where(ok, bucket, absent)], self.begin - 1, axis=0)
        return total

    def listed(self) -> tuple[np.ndarray, np.ndarray]:
        """All features as buckets ordered by word, and where each word's begin."""
        bucket, word = [], []
        for b, has in self.of_words():
            bucket.append(b[has])
            word.append(np.flatnonzero(has))
        for b, ok in self.of_places():
            place = np.flatnonzero(ok)
            bucket.append(b[place])
            word.append(np.searchsorted(self.begin, place + 1, "right") - 1)
        bucket, word = np.concatenate(bucket), np.concatenate(word)
        order = np.argsort(word, kind="stable")
        return bucket[order], np.searchsorted(word[order], np.arange(len(self) + 1))


class Chains:
    """Chains laid side by side, longest first: step ``t`` is the first
    ``active[t]`` of them, and ``place[t, i]`` the word there."""

    def __init__(self, first: np.ndarray, length: np.ndarray):
        self.order = np.argsort(-length, kind="stable")
        self.first, self.length = first[self.order], length[self.order]
        steps = int(self.length[0]) if len(length) else 0
        self.active = np.searchsorted(-self.length, -np.arange(steps), "left")

    def word(self, t: int) -> np.ndarray:
        return self.first[: self.active[t]] + t


def cut(owner: np.ndarray, most: int = CHAIN) -> tuple[np.ndarray, np.ndarray]:
    """First word and length of each stretch, given each word's text."""
    if not len(owner):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = np.flatnonzero(np.diff(owner, prepend=-1))
    place = np.arange(len(owner)) - np.repeat(begin, np.diff(np.append(begin, len(owner))))
    first = np.flatnonzero(place % most == 0)
    return first, np.diff(np.append(first, len(owner)))


def _normal(messages: np.ndarray) -> np.ndarray:
    return messages / messages.sum(-1, keepdims=True)


def crossing(local: np.ndarray, step: np.ndarray, chains: Chains, text: np.ndarray):
    """The messages into each stretch from what is before and after it in its text.

    ``text`` is each stretch's text, in the order they were given, which is that of
    the words; the messages are in the order of ``chains``.
    """
    count, size = len(text), local.shape[1]
    enter, leave = np.ones((count, size)), np.ones((count, size))
    starts = np.flatnonzero(np.diff(text, prepend=-1))
    if len(starts) == count:
        return enter, leave
    # what a stretch makes of a message: emissions, with transitions between them
    made = np.zeros((count, size, size))
    for t, n in enumerate(chains.active):
        now = local[chains.word(t)][:, None, :]
        made[:n] = now * (made[:n] @ step if t else np.eye(size))
        made[:n] /= made[:n].max((1, 2), keepdims=True)
    whole = np.empty_like(made)
    whole[chains.order] = made
    texts = Chains(starts, np.diff(np.append(starts, count)))
    for t, n in enumerate(texts.active):
        now = texts.word(t)
        if t:
            enter[now] = _normal(np.einsum("ij,ijk->ik", enter[now - 1], whole[now - 1]) @ step)
    for t in range(len(texts.active) - 1, 0, -1):
        now = texts.word(t)
        leave[now - 1] = _normal(np.einsum("ijk,ik->ij", whole[now], leave[now]) @ step.T)
    return enter[chains.order], leave[chains.order]


def forward_backward(
    emission: np.ndarray,
    move: np.ndarray,
    chains: Chains,
    pairs: bool = False,
    text: np.ndarray | None = None,
):
    """Marginals of each word's label, and the expected transitions if asked.

    ``emission`` are scores, ``move`` the transitions' scores.  Messages are
    normalised at each step, so no chain under- or overflows.  With ``text`` (see
    :func:`crossing`) the chains of one text are one chain.
    """
    local = np.exp(emission - emission.max(1, keepdims=True)).astype(np.float64)
    step = np.exp(move - move.max())
    out = np.empty_like(local)
    enter = back = np.ones((len(chains.first), local.shape[1]))
    if text is not None:
        enter, back = crossing(local, step, chains, text)
    back = back.copy()
    ahead = []
    for t, n in enumerate(chains.active):
        coming = ahead[-1][:n] @ step if t else enter
        ahead.append(_normal(local[chains.word(t)] * coming))
    expected = np.zeros_like(step)
    for t in range(len(ahead) - 1, -1, -1):
        n = chains.active[t]
        if t + 1 < len(ahead):
            m = chains.active[t + 1]
            coming = local[chains.word(t + 1)] * back[:m]
            if pairs:
                both = ahead[t][:m, :, None] * step * coming[:, None, :]
                expected += (both / both.sum((1, 2), keepdims=True)).sum(0)
            back[:m] = _normal(coming @ step.T)
        out[chains.word(t)] = _normal(ahead[t] * back[:n])
    return out, expected


@dataclass
class Model:
    labels: list[str]
    table: np.ndarray
    move: np.ndarray

    def marginals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Each word's text and its label's distribution."""
        found = Words.of(texts)
        owner = found.laid.owner(found.begin)
        if not len(found):
            return owner, np.zeros((0, len(self.labels)))
        first, length = cut(owner)
        emission = found.emissions(self.table)
        chains = Chains(first, length)
        return owner, forward_backward(emission, self.move, chains, text=owner[first])[0]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        size = len(self.labels)
        if not size:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        owner, share = self.marginals(texts)
        count = np.bincount(owner, minlength=len(texts))
        sums = [np.bincount(owner, share[:, k], len(texts)) for k in range(size)]
        mean = np.stack(sums, 1).astype(np.float64)
        mean /= np.maximum(count, 1)[:, None]
        best = mean.argmax(1)
        return (
            [self.labels[k] if n else UNKNOWN for k, n in zip(best, count, strict=True)],
            np.minimum(mean[np.arange(len(texts)), best], 1.0),
        )


def train(
    rows: list[tuple[str, str]], *, epochs: int = 3, rate: float = 0.3, seed: int = 7
) -> Model:
    """Fit on (language, text)."""
    labels = sorted({lang for lang, _ in rows})
    size = len(labels)
    table = np.zeros((1 << BITS, size), np.float32)
    move = np.zeros((size, size))
    found = Words.of([text for _, text in rows])
    if size < 2 or not len(found):
        return Model(labels, table, move)
    truth = np.array([labels.index(lang) for lang, _ in rows])[found.laid.owner(found.begin)]
    bucket, at = found.listed()
    first, length = cut(found.laid.owner(found.begin), CHAIN // 4)
    rng = np.random.default_rng(seed)
    seen, moved = np.full(1 << BITS, 1e-2, np.float32), np.full((size, size), 1e-2)
    for _ in range(epochs):
        order = rng.permutation(len(first))
        for some in np.array_split(order, max(1, len(order) // 128)):
            word = np.concatenate([np.arange(first[i], first[i] + length[i]) for i in some])
            sizes = at[word + 1] - at[word]
            starts = np.cumsum(sizes) - sizes
            listed = bucket[np.repeat(at[word] - starts, sizes) + np.arange(sizes.sum())]
            emission = np.add.reduceat(table[listed], starts, axis=0)
            # a chain is one to four stretches, mostly of different documents
            whole, total, begins = [], 0, []
            for i in some:
                if not whole or whole[-1] + length[i] > CHAIN or rng.random() < 0.4:
                    begins.append(total)
                    whole.append(0)
                whole[-1] += length[i]
                total += length[i]
            chains = Chains(np.array(begins), np.array(whole))
            share, expected = forward_backward(emission, move, chains, pairs=True)
            error = -share
            error[np.arange(len(word)), truth[word]] += 1
            slope = np.zeros((1 << BITS, size), np.float32)
            np.add.at(slope, listed, np.repeat(error.astype(np.float32), sizes, axis=0))
            slope /= len(some)
            seen += (slope**2).sum(1)
            table += rate * slope / np.sqrt(seen)[:, None]
            counted = np.zeros_like(move)
            for b, n in zip(begins, whole, strict=True):
                label = truth[word[b : b + n]]
                np.add.at(counted, (label[:-1], label[1:]), 1)
            slope = (counted - expected) / len(some)
            moved += slope**2
            move += rate * slope / np.sqrt(moved)
    return Model(labels, table, move)


def fit(docs: DataFrame, learn: Column, sample: int = SAMPLE) -> Model:
    """Train on the documents where ``learn`` holds and ``lang`` is known.

    Per language, the ``sample`` documents whose hash is least: one pass keeps
    the few that can be among them.
    """
    order = F.xxhash64("doc_id", "text")
    known = (
        docs.where(learn & F.col("lang").isNotNull() & (F.length("text") <= SAMPLE_CHARS))
        .select("lang", "text", order.alias("place"))
    )
    counts = known.groupBy("lang").count().collect()  # a row per language
    if not counts:
        return train([])
    # places are spread evenly: twice the share that is wanted holds enough
    below = [
        (r["lang"], min(2**63 - 1, int(2 * sample / r["count"] * 2**64) - 2**63)) for r in counts
    ]
    limits = docs.sparkSession.createDataFrame(below, "lang string, below long")
    near = known.join(F.broadcast(limits), "lang").where("place <= below").drop("below")
    rows, taken = [], Counter()
    for r in near.orderBy("place", "lang", "text").limit(4 * sample * len(below)).collect():
        taken[r["lang"]] += 1
        if taken[r["lang"]] <= sample:
            rows.append((r["lang"], r["text"]))
    return train(rows)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Add ``lang_pred`` and ``score``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches, "text", 2 << 20):
            lang, value = held.value.predict(texts_of(batch, "text"))
            yield with_columns(
                batch, {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(value)}
            )

    return adding(docs, run, {"lang_pred": T.StringType(), "score": T.DoubleType()})
