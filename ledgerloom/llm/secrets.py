"""Secret scans: fixed patterns, and strings that tokenise badly.

Three patterns find assignments, access keys and long hexadecimal runs.  Beside
them, any run of ``LEAST`` or more key characters is split by a public byte-pair
vocabulary: text that was written has several characters a token, a random
string hardly more than one.  What the patterns found is cut out of a run; the
rest, or else its parts between signs, is reported as ``random`` if it is below
the ratio for its alphabet, unless it is a digest of a known size and alphabet,
an identifier (a UUID, a plain number, words joined by signs) or made of few
different characters.

Defined cases: a null or empty text has no spans; spans are places of code
points, the end exclusive, in order of begin and then of kind as in ``KINDS``;
spans of different kinds may overlap; repeated rows give repeated results; an
empty table gives an empty table; other columns are kept, whatever their names,
except that ``spans`` replaces a column of that name.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.arrow import adding, slices, texts_of, with_columns

KINDS = ("assign", "access", "hex", "random")
BASE = KINDS[:3]
PATTERNS = {
    "assign": re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE | re.ASCII,
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}
LEAST_BASE = {"assign": 6, "access": 20, "hex": 24}
SIGN = re.compile("[:=]")
#: Any match of access or hex that is long enough lies in such a run.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
LONG_HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = 20
#: Characters a token below which a run is random: with several kinds of
#: characters, and with letters of one case alone, where words come close.
MIXED_RATIO, LETTERS_RATIO = 1.9, 1.6
DIGEST_SIZES = frozenset((32, 40, 48, 56, 64, 96, 128))
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
NAMED_DIGEST = re.compile(r"(md5|sha1|sha224|sha256|sha384|sha512)[-_=/](.*)\Z", re.IGNORECASE)
#: Bytes of the digests.
DIGEST_BYTES = {"md5": 16, "sha1": 20, "sha224": 28, "sha256": 32, "sha384": 48, "sha512": 64}
BASE64 = re.compile(r"[A-Za-z0-9+/_-]+\Z")
SIGNS = "+/_=-"
PART = re.compile(r"[A-Za-z0-9]+")
#: Different characters that a random string of ``LEAST`` has at least.
VARIETY = 7
#: Runs are tokenised in stretches of so many characters.
STRETCH = 4096
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\Z")
NUMBER = re.compile(r"[0-9+/_=-]+\Z")
#: Words (lower, upper or capitalised, perhaps numbered) joined by signs or case.
WORDS = re.compile(r"[+/_=-]*(?:(?:[A-Z]?[a-z]{2,}|[A-Z]{2,12}|[0-9]{1,4})[+/_=-]+)+"
                   r"(?:[A-Z]?[a-z]{2,}|[A-Z]{2,12}|[0-9]{1,4})?\Z")  # fmt: skip
SECRET = "[SECRET]"

SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("begin", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
        ]
    )
)
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())]))


def vocabulary(path: str, pattern: str):
    """A tiktoken encoding from a file of tokens and ranks."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in file)}
    return tiktoken.Encoding(
        "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    )


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(begin, place of the kind, end) by the patterns."""
    found = []
    if SIGN.search(text):
        for m in PATTERNS["assign"].finditer(text):
            if len(m[2]) >= LEAST_BASE["assign"]:
                found.append((m.start(), 0, m.end()))
    if RUN.search(text):
        if "AKIA" in text:
            for m in PATTERNS["access"].finditer(text):
                if len(m[0]) >= LEAST_BASE["access"]:
                    found.append((m.start(), 1, m.end()))
        # runs are maximal, so those that are too short can be left out at once
        found += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(found)


def is_named_digest(run: str) -> bool:
    """``sha256-`` or the like with a digest of that size, hexadecimal or base 64."""
    named = NAMED_DIGEST.match(run)
    if not named:
        return False
    size, value = DIGEST_BYTES[named[1].lower()], named[2].rstrip("=")
    if len(value) == 2 * size:
        return bool(DIGEST.match(value))
    return len(value) == -(-size * 4 // 3) and bool(BASE64.match(value))


def is_known(run: str) -> bool:
    """A digest of a usual size, or an identifier."""
    return bool(
        (len(run) in DIGEST_SIZES and DIGEST.match(run))
        or is_named_digest(run)
        or UUID.match(run)
        or NUMBER.match(run)
        or WORDS.match(run)
    )


def is_random(run: str, encoding) -> bool:
    if len(set(run)) < VARIETY:
        return False
    kinds = sum(bool(re.search(k, run)) for k in ("[a-z]", "[A-Z]", "[0-9]"))
    words = kinds == 1 or re.match("[A-Z]?[a-z]+\\Z", run)
    tokens = sum(len(encoding.encode_ordinary(run[i : i + STRETCH])) for i in range(0, len(run), STRETCH))
    return len(run) / tokens < (LETTERS_RATIO if words else MIXED_RATIO) and not is_known(run)


def _random_in(text: str, begin: int, end: int, encoding) -> list[tuple[int, int, int]]:
    """The stretch, without signs at its ends, if it is random, or else its parts that are."""
    while begin < end and text[begin] in SIGNS:
        begin += 1
    while begin < end and text[end - 1] in SIGNS:
        end -= 1
    if end - begin < LEAST:
        return []
    run = text[begin:end]
    if is_random(run, encoding):
        return [(begin, 3, end)]
    if is_known(run):
        return []
    return [
        (begin + m.start(), 3, begin + m.end())
        for m in PART.finditer(run)
        if LEAST <= m.end() - m.start() < len(run) and is_random(m[0], encoding)
    ]


def spans_of(text: str, encoding) -> list[tuple[int, int, int]]:
    """All spans; both lists of runs and of base spans are walked once."""
    found = base_spans(text)
    more, at, reached = [], 0, 0
    for m in RUN.finditer(text):
        begin, end = m.span()
        # ends of the base spans that begin before the run's end
        while at < len(found) and found[at][0] < end:
            b, _, e = found[at]
            if begin < b:
                more += _random_in(text, max(begin, reached), b, encoding)
            reached, at = max(reached, e), at + 1
            begin = max(begin, min(reached, end))
        more += _random_in(text, max(begin, reached), end, encoding)
    return sorted(found + more)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = SECRET) -> str:
    """``text`` with each stretch of sorted spans replaced by ``mark``."""
    parts, at = [], 0
    for begin, _, end in spans:
        if begin >= at:
            parts += [text[at:begin], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]]) if parts else text


class Scanner:
    _made: dict[str, object] = {}

    @classmethod
    def of(cls, path: str, pattern: str):
        if path not in cls._made:
            cls._made[path] = vocabulary(path, pattern)
        return cls._made[path]


def scan(
    docs: DataFrame, ranks: str, pattern: str, column: str = "text", *, redacted: str | None = None
) -> DataFrame:
    """Add ``spans``: kind, begin and end of each.

    ``ranks`` is the vocabulary's file, ``pattern`` its rule for words.
    ``redacted`` names a column (that of the text, or another one) that takes the
    text with its spans replaced; null stays null.
    """

    def run(batches):
        encoding = Scanner.of(ranks, pattern)
        for batch in slices(batches, column):
            texts = texts_of(batch, column)
            spans = [spans_of(t, encoding) for t in texts]
            flat = [s for some in spans for s in some]
            items = pa.StructArray.from_arrays(
                [
                    pa.array([KINDS[k] for _, k, _ in flat], pa.string()),
                    pa.array([b for b, _, _ in flat], pa.int32()),
                    pa.array([e for _, _, e in flat], pa.int32()),
                ],
                ["kind", "begin", "end"],
            )
            ends = np.cumsum([0] + [len(s) for s in spans], dtype=np.int32)
            made = pa.ListArray.from_arrays(pa.array(ends), items).cast(_SPANS)
            added = {"spans": made}
            if redacted:
                clean = [redact(t, some) for t, some in zip(texts, spans, strict=True)]
                missing = batch.column(column).is_null().to_numpy(zero_copy_only=False)
                added[redacted] = pa.array(clean, pa.string(), mask=missing)
            yield with_columns(batch, added)

    return adding(docs, run, {"spans": SPANS} | ({redacted: T.StringType()} if redacted else {}))


def written(spans: Column) -> Column:
    """kind:begin:end of each span, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
