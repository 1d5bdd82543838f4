"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

An edit changes a word's letter counts little: a replaced letter is one lost and
one gained, an inserted one is one gained.  Words of a length lie in the leaves
of a tree over letter counts, whose splits come from samples of ``SAMPLE`` words
a leaf that is to be split and are repeated until a leaf holds ``BLOCK`` words at
most.  Each word is a point of its own leaf and a query in all leaves that its
counts can reach, of its length and of the next one.  A leaf is one group: there
a k-d tree of the distinct counts is searched, and pairs of near counts are
verified letter by letter.

A leaf whose words cannot be told apart by their counts is cut by the words'
halves: words one edit apart share the first half or what follows it.

Splits change the work, not the result.  What the driver and the broadcast hold
of them grows as words / ``BLOCK``.

Defined cases: null and empty texts have no words; a null ``doc_id`` is the empty
text in the checksum; repeated rows count as often as they are there; words of
any length are compared; equal counts of near words are told apart by code-point
order; other columns are ignored, whatever their names; an empty table gives an
empty table.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.arrow import map_arrow, slices
from ledgerloom.llm.letter_tree import LETTERS, Tree, letter_counts, near_vectors
from ledgerloom.llm.ship import ship
from ledgerloom.sources.scratch import Scratch

LEAST_LENGTH, LEAST_COUNT, RATIO, DIVISOR = 7, 2, 10, 31
BLOCK = 16_384
SAMPLE = 16
HELD_WORDS, HELD_CHARS, PIECE = 200_000, 1 << 24, 1 << 20
PAIRS = 64
SHORT = 64

# fixed values: the contract's letters
RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST_LENGTH)
OTHER = re.compile("[^A-Za-zÀ-ÿ]")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


# -- words ---------------------------------------------------------------------


def _pieces(text: str):
    """The text in parts of about ``PIECE`` letters; no run is cut."""
    at = 0
    while at < len(text):
        end = OTHER.search(text, at + PIECE)
        last = end.start() if end else len(text)
        yield text[at:last]
        at = last


def changed(doc_id: str, run: str) -> str:
    """The run (lowered), less one code point where the checksum says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % DIVISOR:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` of all words that are long and frequent enough."""

    def run(batches):
        held: Counter[str] = Counter()
        chars = 0

        def sent():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
            )

        for batch in slices(batches, "text"):
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for piece in _pieces(text or ""):
                    for found, n in Counter(RUN.findall(piece.translate(LOWER))).items():
                        word = changed(doc, found)
                        if len(word) >= LEAST_LENGTH:
                            chars += len(word) if word not in held else 0
                            held[word] += n
                    if len(held) >= HELD_WORDS or chars >= HELD_CHARS:
                        yield sent()
                        held, chars = Counter(), 0
        if held:
            yield sent()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), "text")
    counted = map_arrow(rows, run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# -- leaves --------------------------------------------------------------------


def _counted(words: DataFrame) -> DataFrame:
    """Adds ``length`` and ``letters``, the letter counts as bytes."""

    def run(batches):
        for batch in slices(batches, "word"):
            words = batch.column("word").to_pylist()
            counts = letter_counts(words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("word"),
                    batch.column("n"),
                    pa.array([len(w) for w in words], pa.int32()),
                    pa.array([row.tobytes() for row in counts], pa.binary()),
                ],
                names=["word", "n", "length", "letters"],
            )

    return map_arrow(words, run, "word string, n long, length int, letters binary")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, LETTERS)


class Leaves:
    """Names of leaves (a length and the leaves of trees below it), and of those
    that are cut by halves."""

    def __init__(self):
        self.trees: dict[str, Tree] = {}
        self.halved: set[str] = set()

    def reached(self, name: str, counts: np.ndarray, at: np.ndarray, gain: int, lose: int):
        """Leaves below ``name``, and which of the rows ``at`` of ``counts`` reach them.

        A tree below another one counts gained and lost letters anew, which
        reaches more leaves, never fewer.
        """
        tree = self.trees.get(name)
        if tree is None:
            yield name, at
            return
        for leaf, some in tree.search(counts[at], gain, lose):
            yield from self.reached(f"{name}.{leaf}", counts, at[some], gain, lose)


def _placed(rows: DataFrame, leaves: Leaves) -> DataFrame:
    """``rows`` in the leaves below their present ones."""
    held = ship(rows.sparkSession).sparkContext.broadcast(leaves)

    def run(batches):
        for batch in batches:
            names, counts = np.array(batch.column("leaf").to_pylist(), object), _matrix(batch.column("letters"))
            out = names.copy()
            for name in set(names.tolist()):
                for leaf, at in held.value.reached(name, counts, np.flatnonzero(names == name), 0, 0):
                    out[at] = leaf
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("letters"), pa.array(out, pa.string())],
                names=["key", "letters", "leaf"],
            )

    return map_arrow(rows.select("key", "letters", "leaf"), run, "key long, letters binary, leaf string")


def fit_leaves(words: DataFrame, scratch: Scratch, block: int = BLOCK) -> Leaves:
    """Split leaves until none holds over ``block`` words but those cut by halves."""
    leaves, spark = Leaves(), words.sparkSession
    rows = words.select(F.xxhash64("word").alias("key"), "letters", F.col("length").cast("string").alias("leaf"))
    share = F.lit(int(min(2 * SAMPLE / block, 1.0) * (1 << 32)))
    while True:
        counts = rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
        large = [r["leaf"] for r in counts.collect()]  # words / block at most
        if not large:
            return leaves
        names = F.broadcast(spark.createDataFrame([(name,) for name in large], "leaf string"))
        rows = rows.join(names, "leaf")
        sample = rows.where(F.pmod("key", F.lit(1 << 32)) < share).select("leaf", "letters")
        points: dict[str, list[bytes]] = {}
        for r in sample.collect():  # about 2 * SAMPLE a block
            points.setdefault(r["leaf"], []).append(bytes(r["letters"]))
        split = Leaves()
        for name in large:
            found = np.frombuffer(b"".join(sorted(points.get(name, []))), np.uint8).reshape(-1, LETTERS)
            tree = Tree(found, SAMPLE)
            if len(tree.leaves) > 1:
                split.trees[name] = tree
            else:
                leaves.halved.add(name)
        leaves.trees |= split.trees
        going = F.broadcast(spark.createDataFrame([(name,) for name in split.trees], "leaf string"))
        rows = scratch.stage(_placed(rows.join(going, "leaf"), split), "leaves")


def _groups(name: str, word: str, role: int, halved: bool) -> list[str]:
    """The groups of a word in a leaf: one, or one per half and length met there.

    For words of two lengths the halves are those of the shorter one, and the
    longer one's second half starts one letter later.
    """
    if not halved:
        return [name]
    out = []
    if role < 2:
        half = len(word) // 2
        out += [f"{name}/=1{word[:half]}", f"{name}/=2{word[half:]}"]
    if role != 1:
        half = (len(word) if role == 2 else len(word) - 1) // 2
        out += [f"{name}/+1{word[:half]}", f"{name}/+2{word[half + (role != 2):]}"]
    return out


def _dealt(words: DataFrame, leaves: Leaves) -> DataFrame:
    """Every word in its own leaf (``role`` 0), as a query of its length (1) in the
    leaves after its own, and as a shorter query (2) in those of the next length."""
    held = ship(words.sparkSession).sparkContext.broadcast(leaves)

    def run(batches):
        known: Leaves = held.value
        for batch in slices(batches, "word", PIECE >> 2):
            counts, texts = _matrix(batch.column("letters")), batch.column("word").to_pylist()
            lengths = batch.column("length").to_numpy()
            rows, names, roles = [], [], []

            def put(name, at, role):
                for i in at.tolist():
                    for group in _groups(name, texts[i], role, name in known.halved):
                        rows.append(i)
                        names.append(group)
                        roles.append(role)

            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                own = np.empty(len(lengths), object)
                for name, some in known.reached(str(length), counts, at, 0, 0):
                    own[some] = name
                    put(name, some, 0)
                for name, some in known.reached(str(length), counts, at, 1, 1):
                    put(name, some[own[some] < name], 1)
                for name, some in known.reached(str(length + 1), counts, at, 1, 0):
                    put(name, some, 2)
            taken = batch.select(["word", "n"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(roles, pa.int8()), *taken.columns],
                names=["place", "role", "word", "n"],
            )

    return map_arrow(words, run, "place string, role byte, word string, n long")


# -- comparison in a group -----------------------------------------------------


def first_difference(x: str, y: str) -> int:
    """The first place where the words differ, or the length of the shorter one."""
    low, high = 0, min(len(x), len(y))
    if x[:high] == y[:high]:
        return high
    while high - low > 1:  # x[:low] is equal, x[:high] is not
        middle = (low + high) // 2
        low, high = (middle, high) if x[low:middle] == y[low:middle] else (low, middle)
    return low


def one_edit(x: str, y: str) -> bool:
    """``y`` is ``x`` with one letter replaced, or one more."""
    at = first_difference(x, y)
    if len(x) == len(y):
        return at < len(x) and x[at + 1 :] == y[at + 1 :]
    return x[at:] == y[at + 1 :]


def linked(xs: list[str], ys: list[str]) -> list[tuple[int, int]]:
    """Places of words one edit apart; all ``xs`` have one length, and all ``ys``
    the same or one more.  Many short words are met by what is left of them
    without a letter."""
    longer = len(ys[0]) > len(xs[0])
    if len(xs) * len(ys) <= PAIRS or len(xs[0]) > SHORT:
        half = len(xs[0]) // 2
        # the edit leaves one half as it is
        halves = [(y[:half], y[half + longer :]) for y in ys]
        out = []
        for i, x in enumerate(xs):
            first, second = x[:half], x[half:]
            for j, (a, b) in enumerate(halves):
                if (a == first or b == second) and one_edit(x, ys[j]):
                    out.append((i, j))
        return out
    out = set()
    left: dict = {}
    for i, x in enumerate(xs):
        for key in [x] if longer else [(at, x[:at] + x[at + 1 :]) for at in range(len(x))]:
            left.setdefault(key, []).append(i)
    for j, y in enumerate(ys):
        for at in range(len(y)):
            rest = y[:at] + y[at + 1 :]
            for i in left.get(rest if longer else (at, rest), ()):
                if longer or xs[i] != y:
                    out.add((i, j))
    return sorted(out)


def _links(place: str, role: np.ndarray, words: list[str]) -> np.ndarray:
    """Pairs of places of near words in one group."""
    counts = letter_counts(words)

    def distinct(wanted):
        groups: dict[bytes, list[int]] = {}
        for i in np.flatnonzero(role == wanted).tolist():
            groups.setdefault(counts[i].tobytes(), []).append(i)
        return counts[[same[0] for same in groups.values()]], list(groups.values())

    (points, held), found = distinct(0), []
    second = "/+2" in place
    for wanted, gain, lose in ((0, 1, 1), (1, 1, 1), (2, 1, 0)):
        if "/" in place and ("/=" in place) != (wanted < 2):
            continue
        queries, asked = (points, held) if wanted == 0 else distinct(wanted)
        for q, p in near_vectors(points, queries, gain, lose).tolist():
            if wanted == 0 and q > p:
                continue
            a, b = asked[q], held[p]
            xs, ys = [words[i] for i in a], [words[i] for i in b]
            for i, j in linked(xs, ys):
                if wanted == 0 and q == p and i >= j:
                    continue
                half = len(xs[i]) // 2
                if second and xs[i][:half] == ys[j][:half]:
                    continue  # found by the first half
                found.append((a[i], b[j]))
    return np.array(found, np.int64).reshape(-1, 2)


def _near(dealt: DataFrame) -> DataFrame:
    """``word``, ``other`` and its ``n`` for near words, each way."""

    def run(key, table):
        words, n = table["word"].to_pylist(), table["n"].to_numpy()
        pairs = _links(key[0].as_py(), table["role"].to_numpy(), words)
        ends = np.concatenate([pairs, pairs[:, ::-1]])
        return pa.table(
            {
                "word": pa.array([words[i] for i in ends[:, 0]], pa.string()),
                "other": pa.array([words[i] for i in ends[:, 1]], pa.string()),
                "n": pa.array(n[ends[:, 1]], pa.int64()),
            }
        )

    return dealt.groupBy("place").applyInArrow(run, "word string, other string, n long")


# -- forms ---------------------------------------------------------------------


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word`` and ``root`` of the words that have a form: steps are doubled until
    no word moves.  A form is ten times as frequent, so chains are short."""
    roots = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        roots = scratch.stage(roots, "roots")
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = roots.join(on, "root", "left")
        if moved.where("next IS NOT NULL").isEmpty():
            return roots
        roots = moved.select("word", F.coalesce("next", "root").alias("root"))


def variants(docs: DataFrame, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every word."""
    words = scratch.stage(_counted(scratch.stage(word_counts(docs), "counts")), "words")
    near = _near(_dealt(words, fit_leaves(words, scratch, block)))
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("n"), F.col("other"))).alias("best")
    )
    much = -F.col("best.col1") >= RATIO * F.col("n")
    forms = scratch.stage(
        words.select("word", "n")
        .join(best, "word", "left")
        .select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(much, F.col("best.other")).alias("form"),
            F.when(much, -F.col("best.col1")).alias("form_n"),
        ),
        "forms",
    )
    return forms.join(_roots(forms, scratch), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
