"""Token files and pieces: against the libraries, round trips and edge cases."""

from __future__ import annotations

import hashlib
import os
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import pieces, token_files
from ledgerloom.llm.parts import PartStore
from ledgerloom.llm.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a b", "a  b ", "\n", "a▁b", "ﬁ 日本 \x00", " ▁ ", "🙂 é", "it's 'S !'s", "<|endoftext|> a"]


def random_texts(n: int, seed: int = 3) -> list[str]:
    rng = random.Random(seed)
    signs = " ▁ab1.\n\té'日s🙂\x1c!<|_–½ß"
    return ODD + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 20))) for _ in range(n)]


def test_encoder_is_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    texts = [*random_texts(3000), "x" * 6000, "word " * 5000]
    made = token_files.Encoder.of(BYTES).batch(texts)
    for text, ids in zip(texts, made, strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text
    for text in texts[:60]:
        alone = token_files.Encoder.of(BYTES).batch([text])[0]
        assert alone.tolist() == library.encode(text, add_special_tokens=False).ids


def test_store_forgets_but_stays_right():
    store = PartStore(lambda parts: [[len(p), ord(p[0])] for p in parts], limit=3)
    for _ in range(20):
        text = "".join(random.choice("abc ") for _ in range(30))
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
        begin = np.unique([0, *[i for i, c in enumerate(text) if c == " "]])
        ids, after = store.encode(codes, text, begin)
        ends = [*begin[1:], len(text)]
        for i, (a, b) in enumerate(zip(begin, ends, strict=True)):
            assert ids[after[i] : after[i + 1]].tolist() == [b - a, ord(text[a])]


def test_store_is_bounded_whatever_the_parts():
    """Long parts are encoded each time; ids in store are bounded besides the parts."""
    calls = []

    def each(parts):
        calls.append([len(p) for p in parts])
        return [[ord(c) for c in p] for p in parts]

    store = PartStore(each, room=50_000)
    rng = random.Random(1)
    for turn in range(60):
        parts = [chr(97 + turn % 26) * 3, *["".join(rng.choices("abcdef", k=rng.choice([3, 900, 5000]))) for _ in range(9)]]
        rng.shuffle(parts)
        text = "".join(parts)
        begin = np.cumsum([0, *map(len, parts[:-1])])
        ids, after = store.encode(np.frombuffer(text.encode("utf-32-le"), "<u4"), text, begin)
        assert ids.tolist() == [ord(c) for c in text] and after.tolist() == [*begin, len(text)]
        assert store.used <= 50_000 + 10_000 and len(store.ids) <= 4 * 60_000
    assert sum(n for sizes in calls for n in sizes if n > 4096) % 5000 == 0
    # only long parts: nothing stays
    store = PartStore(each)
    for _ in range(20):
        store.encode(np.full(1_000_000, 97, np.uint32), "a" * 1_000_000, np.array([0]))
    assert store.used == 0 and not store.runs and store.ids.nbytes < 1 << 20


def test_whole_texts_leave_nothing_in_the_store():
    encoder = token_files.Encoder(BYTES)
    odd = [f"日本{i} it's {i}" for i in range(50)]
    made = encoder.batch(odd)
    assert not encoder.store.runs and all(len(x) for x in made)
    mixed = encoder.batch(["plain words", odd[0], "", "more"])
    assert mixed[1].tolist() == made[0].tolist() and len(mixed[2]) == 0
    assert encoder.store.runs


def test_token_files_of_the_tables(spark):
    from tokenizers import Tokenizer

    library, place = Tokenizer.from_file(BYTES), 0
    rows = {r.doc_id: r for r in QUERIES["op10_token_files"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        ids = [*library.encode(doc.text or "", add_special_tokens=False).ids, 0]
        own = rows[doc.doc_id]
        crc = zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        assert (own.start, own.n_tokens, own.ids_crc32) == (place, len(ids), crc)
        place += len(ids)


def test_token_files_layout_and_edges(spark, tmp_path):
    docs = spark.createDataFrame(
        [(2, "b b", 9), (None, "n", 9), (1, None, 9), (2, "b b", 9), (2, "a", 9), (3, "z " * 50_000, 9)],
        "doc_id long, text string, ids int",
    )
    path = str(tmp_path / "files")
    token_files.write(docs.repartition(3), path, BYTES)
    rows = token_files.read(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 2, 2, 3]
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows[:-1]]]).tolist()
    assert rows[1].ids == [0] and all(r.ids[-1] == 0 and len(r.ids) == r.n_tokens for r in rows)
    found = token_files.read_span(spark, path, rows[2].start, rows[2].start + 1)
    assert [r.start for r in found.collect()] == [rows[2].start]
    file = next(p for p in sorted((tmp_path / "files").glob("*.parquet")) if pq.read_metadata(p).num_rows)
    column = pq.read_metadata(file).row_group(0).column(4)
    assert {"RLE_DICTIONARY", "DELTA_BINARY_PACKED"} & set(column.encodings)
    assert column.has_offset_index and column.has_column_index
    # counts alone can be read
    counts = spark.read.parquet(path).select("n_tokens")
    assert "ids" not in counts._jdf.queryExecution().executedPlan().toString()
    token_files.write(docs.limit(0), str(tmp_path / "none"), BYTES)
    assert token_files.read(spark, str(tmp_path / "none")).count() == 0


def test_pieces_are_the_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [*random_texts(2000), "x" * 6000]
    made = pieces.Pieces.of(MODEL).batch(texts)
    for text, (ids, offsets) in zip(texts, made, strict=True):
        assert ids.tolist() == library.encode(text, add_eos=True), text
        data = text.encode()
        assert len(offsets) == len(ids) + 1 and offsets[-1] == len(data)
        assert (np.diff(offsets) >= 0).all() and (offsets[0] == 0)
        proto = library.encode(text, return_type="proto").pieces
        if not any(p.piece.startswith("<0x") for p in proto):
            spans = [data[a:b].decode() for a, b in zip(offsets[:-2], offsets[1:-1], strict=True)]
            assert spans == [p.surface for p in proto]


def trie(rules: dict[bytes, bytes]) -> bytes:
    """A compiled map of few rules, built by hand: a double array of blocks of 256."""
    texts, places = b"", {}
    for key, value in rules.items():
        places[key] = len(texts)
        texts += value + b"\0"
    prefixes = sorted({k[:i] for k in rules for i in range(len(k) + 1)})
    base = {p: 256 * (i + 1) for i, p in enumerate(prefixes)}
    units = [0] * (256 * (len(prefixes) + 2))

    def unit(prefix: bytes, node: int, label: int):
        offset = node ^ base[prefix]
        shift = offset >> 8 << 10 | 1 << 9 if offset >> 21 else offset << 10
        units[node] = label | shift | (prefix in rules) << 8
        if prefix in rules:
            units[base[prefix]] = 1 << 31 | places[prefix]
        for p in prefixes:
            if len(p) == len(prefix) + 1 and p.startswith(prefix):
                unit(p, base[prefix] ^ p[-1], p[-1])

    unit(b"", 0, 0)
    return struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + texts


RULES = {"ﬁ".encode(): b"fi", b"a": b"A", b"ab": b"X Y", b"abc": b"", " ".encode(): b" "}


def brute_normal(text: bytes) -> tuple[bytes, list[int]]:
    out, at = [], 0
    while at < len(text):
        keys = [k for k in RULES if text.startswith(k, at)]
        if keys:
            key = max(keys, key=len)
            out += [(b, at) for b in RULES[key]]
            at += len(key)
        else:
            out.append((text[at], at))
            at += 1
    return bytes(b for b, _ in out), [p for _, p in out]


@pytest.mark.parametrize("squeeze", [False, True])
def test_longest_prefix_normalisation(squeeze):
    made = object.__new__(pieces.Pieces)
    made.map = pieces.CharacterMap(trie(RULES))
    made.prefix, made.squeeze, made.escape, made.suffix = True, squeeze, True, False
    for text in ["xaby", "abcab a", "ﬁn  z", "abc", " a  b ", "é日", "aab abcd"]:
        data = text.encode()
        normal, places = brute_normal(data)
        if squeeze:
            kept, blank = [], True
            for byte, place in zip(normal, places, strict=True):
                if byte != 32 or not blank:
                    kept.append((byte, place))
                blank = byte == 32
            while kept and kept[-1][0] == 32:
                kept.pop()
            normal, places = bytes(b for b, _ in kept), [p for _, p in kept]
        got, at = made.normalise(text)
        if not normal:
            assert got == "" or got == pieces.SPACE
            continue
        assert got == pieces.SPACE + normal.decode().replace(" ", pieces.SPACE)
        expected = [places[0] if squeeze else 0] * 3
        for byte, place in zip(normal, places, strict=True):
            expected += [place] * (3 if byte == 32 else 1)
        assert at[:-1].tolist() == expected, text


def test_spaces_only_is_the_general_way():
    fast = pieces.Pieces.of(MODEL)
    for text in random_texts(300):
        slow, places = fast._by_rules(text.encode()) if text else ("", np.zeros(1, int))
        quick, at = fast.normalise(text)
        assert quick == slow
        # a mark made of a space: all its bytes begin at the space, or after it
        assert at[-1] == places[-1] and len(at) == len(places)


def test_pieces_query_and_edges(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    rows = {r.doc_id: r for r in QUERIES["op5_pieces"](spark, SF).collect()}
    for doc in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids, own = library.encode(doc.text or "", add_eos=True), rows[doc.doc_id]
        assert own.n_tokens == len(ids) and own.ids_sha256 == digest(" ".join(map(str, ids)))
        assert own.decoded_sha256 == digest(library.decode(ids))
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (None, "a b", None), (2, "é" * 200_000, "x")],
        "doc_id long, text string, ids string",
    )
    made = pieces.encode(docs, MODEL)
    assert made.columns == ["doc_id", "text", "ids", "offsets"]
    by = {(r.doc_id, r.text): r for r in pieces.decode(made, MODEL).collect()}
    assert by[1, None].ids == [2] == by[2, ""].ids and by[1, None].offsets == [0, 0]
    assert all((r.text or "") == r.decoded for r in by.values())
    twice = pieces.encode(docs, MODEL, decoded="decoded").where(F.col("decoded") == F.col("text"))
    assert twice.count() == 3
    assert pieces.encode(docs.limit(0), MODEL).count() == 0


def test_reads_by_place_filter_at_the_scan(spark, tmp_path):
    """Any range of ids gives the documents that hold one of them, and no more."""
    import random

    docs = spark.range(300).selectExpr("id AS doc_id", "repeat('some words ', cast(id % 17 AS int)) AS text")
    path = str(tmp_path / "tokens")
    token_files.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    rows = token_files.read(spark, path).select("doc_id", "start", "n_tokens").collect()
    total, rng = max(r.start + r.n_tokens for r in rows), random.Random(4)
    ranges = [(0, 1), (total - 1, total), (0, total), (total, total + 5), (7, 7)]
    for begin, end in ranges + [tuple(sorted(rng.sample(range(total), 2))) for _ in range(4)]:
        got = token_files.read_span(spark, path, begin, end)
        assert {r.doc_id for r in got.collect()} == {
            r.doc_id for r in rows if begin < end and r.start < end and r.start + r.n_tokens > begin
        }
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        plan = token_files.read_span(spark, path, 5, 9)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "ids" in line)
    assert "GreaterThanOrEqual(offset," in scan and "LessThan(offset," in scan
