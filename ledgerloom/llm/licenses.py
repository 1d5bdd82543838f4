"""Licence scans: a trained paragraph classifier, in DataFrame operations only.

What is judged is each line, each paragraph (lines between two blank ones, so
comment marks and wrapping do not matter) of no more words than the templates
allow, and overlapping stretches of the words of any paragraph in lengths that fit the templates (``STRETCHES``): a notice lies whole in
one with few other words, however much text shares its line.  Features are the
word pairs and triples that occur in a licence template, each weighted by one
over the root of how many the line or stretch has in all.  A logistic
regression over licence families and ``unknown`` is trained in numpy on the
templates, parts of them, and lines of a bounded sample of documents
(``SAMPLE``, texts of up to ``SAMPLE_CHARS``).  Its temperature and the probability
below which a family becomes ``unknown`` are set on examples held out.  A
prediction counts once a template of the family confirms it: what is judged
holds ``CONFIRMED`` of the template, or the template of the line or paragraph.  Of
overlapping findings those stay that share most with their template, so that a
wrapped or repeated reading of one notice counts once (see ``_settled``).

Scoring is a join of hashed pairs and triples with the weights, whose number is
bounded by the templates (a constant of the program), and a sum per line and
stretch; the comparison needs only the grams found, so no text is read again.

Defined cases: words are runs of letters a-z (A-Z lowered), digits and anything
beyond ASCII, so a comment mark made of letters is a word; null and empty texts,
and paragraphs of one word, have no licence; a blank line is one without words;
equal notices of one family side by side in one paragraph may count once;
stretches and paragraphs of several lines count only if confirmed; a document row is told from others by its id
and its text's hash, so equal rows give equal results, each its own row; other
columns are ignored, whatever their names; an empty table gives an empty table,
and trains on templates alone.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh64

from ledgerloom.llm.decontaminate import _lower, same_row, words
from ledgerloom.llm.license_texts import TEMPLATES, UNNAMED
from ledgerloom.sources.scratch import Scratch

UNKNOWN = "unknown"
SIZES = (2, 3)
SAMPLE = 200
SAMPLE_CHARS = 50_000
CONFIRMED = 0.8
LEAST_SHARED = 3
LINE = "\n"
#: Stands for a line's end among words; in a text itself it is a sign like others.
BREAK = "\x01"
NOT_WORD_NOR_BREAK = r"[\x00\x02-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: What is judged.
IS_STRETCH, IS_PARAGRAPH, IS_LINE = 0, 1, 2
FOUND = ["kind", "first", "last", "place", "n", "family", "probability"]

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_here(text: str) -> list[str]:
    """The same words as in Spark, for training."""
    lowered = text.translate({c: c + 32 for c in range(65, 91)})
    return WORD.findall(lowered)


def grams_here(tokens: list[str]) -> set[str]:
    return {" ".join(tokens[i : i + n]) for n in SIZES for i in range(len(tokens) - n + 1)}


def _of_longs(first: int, second: int) -> int:
    """As Spark hashes two longs: the first's hash seeds the second's."""
    seed = xxh64(first.to_bytes(8, "little"), seed=42).intdigest()
    return xxh64(second.to_bytes(8, "little"), seed=seed).intdigest()


def hash_here(gram: str) -> int:
    """The hash of a run of words that :func:`runs` gives."""
    value = reduce(_of_longs, [xxh64(w.encode(), seed=42).intdigest() for w in gram.split(" ")])
    return value - (1 << 64) if value >> 63 else value


def runs(shorter: Column, hashes: Column, n: int) -> Column:
    """Hashes of all runs of ``n`` words, by the place of their first, from those of
    runs of one word less and of the words."""
    last = F.slice(hashes, n, F.greatest(F.size(hashes) - n + 1, F.lit(0)))
    # both are as long as there are runs, but for the last of the shorter ones
    heads = F.slice(shorter, 1, F.size(last))
    return F.zip_with(heads, last, lambda a, b: F.xxhash64(a, b))


def _stretches() -> list[tuple[int, int, int]]:
    """Length, step and least number of template grams.  Any run of ``length -
    step`` words lies whole in a stretch, with not much else; the last kind holds
    the longest template.  What fits the kind before is left to it, so a stretch
    needs the share of grams that confirms a longer template."""
    sizes = [(len(t), len(grams_here(t))) for ts in TEMPLATES.values() for t in map(words_here, ts)]
    out: list[tuple[int, int, int]] = []
    kinds, fits = [(6, 2), (9, 3)], 0
    while fits < max(sizes)[0]:
        step = min(kinds[len(out)][1], (max(sizes)[0] + 1) // 2)
        length = 3 * step
        least = min(n for long, n in sizes if long > fits)
        out.append((length, step, max(LEAST_SHARED, math.ceil(CONFIRMED * least))))
        kinds.append((2 * length, 2 * step))
        fits = length - step
    return out


STRETCHES = _stretches()


@dataclass
class Model:
    """``weights`` by gram: one per class; the last class is ``unknown``."""

    classes: list[str]
    vocabulary: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float

    def probabilities(self, text: str) -> np.ndarray:
        """For one paragraph, as the DataFrame path does it."""
        found = grams_here(words_here(text))
        index = {g: i for i, g in enumerate(self.vocabulary)}
        rows = [index[g] for g in found if g in index]
        logits = self.bias + self.weights[rows].sum(0) / np.sqrt(max(len(found), 1))
        e = np.exp((logits - logits.max()) / self.temperature)
        return e / e.sum()


def _examples(rng, negatives: list[str]) -> list[tuple[str, str]]:
    """Templates, stretches of them, templates among other words; and none."""
    some = negatives or UNNAMED
    out = []

    def stretch(tokens):
        size = int(rng.integers(min(6, len(tokens)), min(len(tokens), 24) + 1))
        start = int(rng.integers(0, len(tokens) - size + 1))
        return tokens[start : start + size]

    shared: dict[str, set[str]] = {}
    for family, texts in TEMPLATES.items():
        for text in texts:
            for gram in grams_here(words_here(text)):
                shared.setdefault(gram, set()).add(family)
    for family, texts in TEMPLATES.items():
        for text in texts:
            tokens = words_here(text)
            out += [(family, text)] * 6
            for _ in range(12):
                around = words_here(some[int(rng.integers(len(some)))])[: int(rng.integers(0, 8))]
                out.append((family, " ".join(around + tokens)))
                # and as a stretch holds them, with words on both sides
                most = max(7, len(tokens))
                near = [w for _ in range(most) for w in words_here(some[int(rng.integers(len(some)))])][:most]
                before = int(rng.integers(0, len(near) + 1))
                out.append((family, " ".join(near[:before] + tokens + near[before:])))
                part = stretch(tokens)
                # what several licences say alike names none of them
                own = any(shared[g] == {family} for g in grams_here(part))
                out.append((family if own else UNKNOWN, " ".join(part)))
                out.append((UNKNOWN, " ".join(rng.permutation(tokens))))
    out += [(UNKNOWN, text) for text in negatives]
    out += [(UNKNOWN, text) for text in UNNAMED * 10]
    return out


def train(negatives: list[str], seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    classes = [*TEMPLATES, UNKNOWN]
    vocabulary = sorted({g for texts in TEMPLATES.values() for t in texts for g in grams_here(words_here(t))})
    index = {g: i for i, g in enumerate(vocabulary)}
    rows = _examples(rng, negatives)
    order = rng.permutation(len(rows))
    x = np.zeros((len(rows), len(vocabulary)), np.float32)
    y = np.zeros(len(rows), np.int64)
    for place, i in enumerate(order):
        family, text = rows[i]
        found = grams_here(words_here(text))
        for g in found:
            if g in index:
                x[place, index[g]] = 1 / np.sqrt(len(found))
        y[place] = classes.index(family)
    held = np.arange(len(rows)) % 5 == 0
    weights, bias = np.zeros((len(vocabulary), len(classes)), np.float32), np.zeros(len(classes), np.float32)
    weights, bias = _descend(x[~held], y[~held], weights, bias)
    logits = x[held] @ weights + bias
    truth = y[held]

    def shares(t):
        e = np.exp((logits - logits.max(1, keepdims=True)) / t)
        return e / e.sum(1, keepdims=True)

    def loss(t):
        return -np.log(shares(t)[np.arange(len(truth)), truth] + 1e-12).mean()

    temperature = min(np.geomspace(0.25, 4, 33), key=loss)
    p = shares(temperature)
    best, sure = p[:, :-1].argmax(1), p[:, :-1].max(1)
    # the least probability that keeps the most held-out predictions right
    def right(least):
        return (np.where(sure >= least, best, len(classes) - 1) == truth).sum()

    least = max(np.linspace(0.3, 0.9, 25), key=lambda t: (right(t), t))
    return Model(classes, vocabulary, weights, bias, float(temperature), float(least))


def _descend(x, y, weights, bias, steps: int = 150, rate: float = 0.3, decay: float = 1e-5):
    """Full gradient steps, each weight at its own pace."""
    target = np.eye(weights.shape[1], dtype=np.float32)[y]
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(bias), np.zeros_like(bias)]
    for step in range(1, steps + 1):
        logits = x @ weights + bias
        e = np.exp(logits - logits.max(1, keepdims=True))
        error = (e / e.sum(1, keepdims=True) - target) / len(x)
        for i, (value, slope) in enumerate(((weights, x.T @ error + decay * weights), (bias, error.sum(0)))):
            m, v = moments[2 * i], moments[2 * i + 1]
            m += 0.1 * (slope - m)
            v += 0.01 * (slope**2 - v)
            value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return weights, bias


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Train with paragraphs of ``sample`` documents, least by hash, as unknown."""
    place = F.xxhash64("doc_id", "text")
    some = docs.where(F.length("text") <= SAMPLE_CHARS).select("text", place.alias("place"))
    # places are spread evenly: twice the share that is wanted holds enough
    share = 2 * sample / max(docs.count(), 1)
    near = some.where(F.col("place") <= min(2**63 - 1, int(share * 2**64) - 2**63))
    rows = near.orderBy("place", "text").select("text").limit(sample).collect()
    known = [grams_here(words_here(t)) for texts in TEMPLATES.values() for t in texts]
    lines = [line for r in rows for line in r["text"].split(LINE)[:20]]
    negatives = []
    for line in lines:
        found = grams_here(words_here(line))
        # licences that stand in the sample are no examples of none
        if found and all(len(found & k) < 0.5 * min(len(found), len(k)) for k in known):
            negatives.append(line)
    return train(negatives[: 10 * sample])


def _table(spark: SparkSession, rows: list[str], columns: str) -> DataFrame:
    """A constant of the program as an inline table."""
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({columns})")


def _lines(docs: DataFrame, own: list[str]) -> DataFrame:
    """A row per line with words: its ``line`` number, ``first`` and ``last`` word
    (exclusive) in the text, its paragraph's (``top``, ``bottom``), number ``n`` of
    its distinct grams, and the ``grams`` that begin in it and end in its paragraph,
    ``pairs`` of which are pairs."""
    nothing = F.array().cast("array<int>")
    marked = F.replace(F.replace("text", F.lit(BREAK), F.lit(" ")), F.lit(LINE), F.lit(f" {BREAK} "))
    tokens = docs.select(*own, F.array_remove(F.split(marked, NOT_WORD_NOR_BREAK), "").alias("marked"))
    laid = tokens.select(
        *own,
        F.transform(F.array_remove("marked", BREAK), lambda w: F.xxhash64(_lower(w))).alias("words"),
        F.filter(
            F.transform("marked", lambda w, i: F.when(w == BREAK, i)), lambda i: i.isNotNull()
        ).alias("breaks"),
    ).select(
        *own, "words", "breaks", runs(F.col("words"), F.col("words"), 2).alias("runs2")
    ).select(
        *own, "runs2", runs(F.col("runs2"), F.col("words"), 3).alias("runs3"),
        # where each line begins, and the end of the last
        F.concat(
            F.array(F.lit(0)), F.transform("breaks", lambda at, i: at - i), F.array(F.size("words"))
        ).alias("starts"),
    )
    blank = F.filter(
        F.transform("starts", lambda at, i: F.when(at == F.get("starts", i + 1), i)),
        lambda i: i.isNotNull(),
    )
    lines = (
        laid.select(*own, "runs2", "runs3", "starts", blank.alias("blank"))
        # paragraphs lie between blank lines
        .select(
            *own, "runs2", "runs3", "starts",
            F.transform(
                F.concat(F.array(F.lit(-1)), "blank"),
                lambda at, i: F.struct(
                    (at + 1).alias("from"),
                    F.coalesce(F.get("blank", i), F.size("starts") - 1).alias("to"),
                ),
            ).alias("parts"),
        )
        .select(
            *own, "runs2", "runs3", "starts",
            F.flatten(
                F.transform(
                    F.filter("parts", lambda p: p["from"] < p["to"]),
                    lambda p: F.transform(
                        F.sequence(p["from"], p["to"] - 1),
                        lambda i: F.struct(
                            i.alias("line"),
                            F.get("starts", i).alias("first"),
                            F.get("starts", i + 1).alias("last"),
                            F.get("starts", p["from"]).alias("top"),
                            F.get("starts", p["to"]).alias("bottom"),
                        ),
                    ),
                )
            ).alias("lines"),
        )
    )

    def part(line, end, n: int):
        size = F.least(line["last"], end - n + 1) - line["first"]
        return F.slice(f"runs{n}", line["first"] + 1, F.greatest(size, F.lit(0)))

    return lines.select(
        *own,
        F.inline(
            F.transform(
                "lines",
                lambda x: F.struct(
                    x["line"].alias("line"), x["first"].alias("first"), x["last"].alias("last"),
                    x["top"].alias("top"), x["bottom"].alias("bottom"),
                    F.size(F.array_distinct(F.concat(*[part(x, x["last"], n) for n in SIZES]))).alias("n"),
                    F.size(part(x, x["bottom"], 2)).alias("pairs"),
                    F.concat(*[part(x, x["bottom"], n) for n in SIZES]).alias("grams"),
                ),
            )
        ),
    )


def _units() -> Column:
    """The line of a gram found, if it ends there, its paragraph of several lines
    if no template is longer, and the stretches that hold it where enough others
    are ``near``."""
    end = F.col("at") + F.col("length")

    def unit(kind, first, last, n, least):
        return F.struct(
            F.lit(kind).alias("kind"), first.alias("first"), last.alias("last"), n.alias("n"), least.alias("least")
        )

    listed = [
        F.when(
            end <= F.col("last"),
            unit(IS_LINE, F.col("first"), F.col("last"), F.col("n"), F.lit(0)),
        ),
        F.when(
            (F.col("bottom") - F.col("top") <= STRETCHES[-1][0])
            & ((F.col("top") < F.col("first")) | (F.col("last") < F.col("bottom"))),
            unit(IS_PARAGRAPH, F.col("top"), F.col("bottom"), 2 * (F.col("bottom") - F.col("top")) - 3, F.lit(LEAST_SHARED)),
        ),
    ]
    for length, step, least in STRETCHES:
        for back in range(length // step):
            first = F.col("at") - (F.col("at") - F.col("top")) % step - back * step
            last = F.least(first + length, F.col("bottom"))
            # one that begins and ends with a line is that line
            same = (first == F.col("first")) & (last == F.col("last"))
            listed.append(
                F.when(
                    (F.col(f"near{length}") >= least) & (first >= F.col("top")) & (end <= last) & ~same,
                    unit(IS_STRETCH, first, last, 2 * (last - first) - 3, F.lit(least)),
                )
            )
    return F.filter(F.array(*listed), lambda u: u.isNotNull())


def scan(docs: DataFrame, model: Model, scratch: Scratch) -> DataFrame:
    """Notices: ``doc_id``, ``row_hash``, ``place`` (line where the line or stretch
    has its first template gram), ``family``, ``probability``, ``similarity`` and
    ``confirmed``."""
    spark = docs.sparkSession
    keys = ["doc_id", "row_hash"]
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("row_hash")).where("text is not null")
    size = len(model.classes)
    weights = _table(
        spark,
        [
            f"(bigint('{hash_here(g)}'), '{' '.join(f'{v:.9g}' for v in w)}')"
            for g, w in zip(model.vocabulary, model.weights.tolist(), strict=True)
        ],
        "gram, listed",
    ).select("gram", F.split("listed", " ").cast("array<double>").alias("w"))
    # equal rows are summed up apart: their place in the scan tells them from each other
    own = [*keys, "row"]
    listed = _lines(rows.withColumn("row", F.monotonically_increasing_id()), own)
    place = ["line", "first", "last", "top", "bottom", "n"]
    i, pairs = F.col("i"), F.col("pairs")
    hits = (
        # not explode: the filter that Spark infers for it would repeat the grams'
        # expressions below, down to the words once for each of them
        listed.select(*own, *place, "pairs", F.posexplode_outer("grams").alias("i", "gram"))
        .join(F.broadcast(weights.select("gram")), "gram")  # as many as the templates have
        .select(
            *own, *place, "gram",
            F.when(i < pairs, 2).otherwise(3).alias("length"),
            (F.col("first") + i - F.when(i < pairs, 0).otherwise(pairs)).alias("at"),
        )
    )
    around = Window.partitionBy(*own).orderBy("at")
    near = [
        F.count(F.lit(1)).over(around.rangeBetween(-length, length)).alias(f"near{length}")
        for length, _, _ in STRETCHES
    ]
    unit = ["kind", "first", "last", "n"]
    units = (
        hits.select("*", *near)
        .select(
            *own, F.col("line").alias("place"),
            F.struct("gram", (2 * F.col("at") + F.col("length") - 2).alias("mark")).alias("hit"),
            F.inline(_units()),
        )
        .groupBy(*own, *unit, "least")
        .agg(F.min("place").alias("place"), F.collect_list("hit").alias("hits"))
        .withColumn("grams", F.array_distinct("hits.gram"))
        .where(F.size("grams") >= F.col("least"))
    )
    sums = (
        units.select(*own, *unit, "place", "hits", F.explode_outer("grams").alias("gram"))
        .join(F.broadcast(weights), "gram")
        .groupBy(*own, *unit, "place")
        .agg(F.first("hits").alias("hits"), *[F.sum(F.get("w", F.lit(i))).alias(f"s{i}") for i in range(size)])
    )
    logits = F.array(
        *[
            (F.lit(float(model.bias[i])) + F.col(f"s{i}") / F.sqrt("n")) / F.lit(model.temperature)
            for i in range(size)
        ]
    )
    top = F.array_max("logits")
    shares = F.transform("logits", lambda v: F.exp(v - top))
    best = F.slice("shares", 1, size - 1)
    predicted = (
        sums.select(*keys, *unit, "place", "hits", logits.alias("logits"))
        .select(*keys, *unit, "place", "hits", shares.alias("shares"))
        .select(
            *keys,
            *unit,
            "place",
            "hits",
            (F.array_max(best) / F.aggregate("shares", F.lit(0.0), lambda a, v: a + v)).alias("probability"),
            F.get(
                F.array(*[F.lit(c) for c in model.classes]),
                F.array_position(best, F.array_max(best)).cast("int") - 1,
            ).alias("family"),
        )
        .where(F.col("probability") >= model.least)
        .groupBy(*keys, *unit, "place", "family")
        .agg(F.max("probability").alias("probability"), F.first("hits").alias("hits"))
    )
    predicted = scratch.stage(predicted, "predicted")
    return _settled(_confirmed(predicted, keys), keys)


def _confirmed(predicted: DataFrame, keys: list[str]) -> DataFrame:
    """Adds what lines and stretches have in common with their family's nearest template."""
    listed = []
    for family, texts in TEMPLATES.items():
        for i, text in enumerate(texts):
            found = grams_here(words_here(text))
            listed += [
                f"('{family}', {i}, {len(found)}, bigint('{hash_here(g)}'))"
                for g in sorted(found)
            ]
    templates = _table(predicted.sparkSession, listed, "family, template, size, gram")
    own = [*keys, *FOUND]
    shared = (
        predicted.select(*own, F.inline("hits"))
        .join(F.broadcast(templates), ["family", "gram"])
        .groupBy(*own, "template", "size")
        .agg(F.size(F.collect_set("gram")).alias("shared"), F.collect_list("mark").alias("marks"))
    )
    near = F.when(
        F.col("shared") >= LEAST_SHARED,
        F.greatest(
            # a cut through a text may lie in a template by chance, a line does not
            F.when(F.col("kind") != IS_STRETCH, F.col("shared") / F.col("n")),
            F.col("shared") / F.col("size"),
        ),
    ).otherwise(F.lit(0.0))
    return (
        shared.withColumn("similarity", near)
        .withColumn("confirmed", F.col("similarity") >= CONFIRMED)
        .groupBy(*own)
        .agg(F.max(F.struct("confirmed", "shared", "similarity", "marks")).alias("best"))
        .select(*own, "best.*")
    )


def _settled(found: DataFrame, keys: list[str]) -> DataFrame:
    """Notices told apart: a gram in the text belongs to the finding that shares most
    with its template, and a finding stays with half of its grams or more.  So the
    lines of a wrapped notice give way to the stretch that holds it, and stretches to
    the line, or the better stretch, with the same notice."""
    # a line of usual length is one paragraph; in a longer one, its stretches are
    line = (F.col("kind") == IS_LINE) & (F.col("last") - F.col("first") <= STRETCHES[-1][0])
    rank = F.struct(
        "confirmed", "shared", F.round("similarity", 9).alias("similarity"), line.alias("line"),
        (F.col("first") - F.col("last")).alias("short"), (-F.col("first")).alias("early"), "family", "probability",
    )
    own = [*keys, *FOUND]
    marks = (
        found.where((F.col("kind") == IS_LINE) | F.col("confirmed"))
        .select(*own, "similarity", "confirmed", rank.alias("rank"), F.explode("marks").alias("mark"))
        .withColumn("won", F.col("rank") == F.max("rank").over(Window.partitionBy(*keys, "mark")))
    )
    return (
        marks.groupBy(*own, "similarity", "confirmed")
        .agg(F.count_if("won").alias("won"), F.count(F.lit(1)).alias("all"))
        .where(2 * F.col("won") >= F.col("all"))
        .select(*keys, "place", "family", "probability", "similarity", "confirmed")
    )


def of_documents(docs: DataFrame, model: Model, scratch: Scratch) -> DataFrame:
    """Per document row: number of confirmed and other licence notices, and the
    confirmed families, sorted."""
    keys = ["doc_id", "row_hash"]
    found = (
        scan(docs, model, scratch)
        .groupBy(*keys)
        .agg(
            F.count_if("confirmed").alias("n_licenses"),
            F.count_if(~F.col("confirmed")).alias("n_unconfirmed"),
            F.sort_array(F.collect_set(F.when(F.col("confirmed"), F.col("family")))).alias("families"),
        )
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("row_hash"))
    zero = F.lit(0).cast("long")
    return same_row(rows, found, keys, "left").select(
        "doc_id",
        F.coalesce("n_licenses", zero).alias("n_licenses"),
        F.coalesce("n_unconfirmed", zero).alias("n_unconfirmed"),
        F.coalesce("families", F.array().cast("array<string>")).alias("families"),
    )
