"""SentencePiece encoding that keeps source offsets, and decoding.

A text is normalised by the model's compiled character map: at each position
the longest rule that matches is replaced, any other character copied, and
for every byte made the position in the source is recorded.  The normalised
text is cut where no piece can span, each distinct part segmented by the model
once, and every piece projected to its bytes in the original text.

Defined cases: a null or empty text has only the end id, with an empty span;
other columns, ids included, are passed through as they are, whatever their
names, except that ``ids`` and ``offsets`` replace columns of those names;
repeated rows give repeated results; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerloom.llm.arrow import adding, int_lists, slices, texts_of, with_columns
from ledgerloom.llm.codes import Codes
from ledgerloom.llm.parts import PartStore

SPACE = "▁"


class CharacterMap:
    """A compiled map: a double-array trie over bytes and its replacements.

    The blob holds the trie's size in bytes, the trie's 32-bit units and the
    zero-terminated replacements; a unit's value is the replacement's place.
    """

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest rule that matches at ``at``."""
        if not self.units:
            return None
        found, node = None, self._children(self.units[0])
        for place in range(at, len(data)):
            byte = data[place]
            node ^= byte
            unit = self.units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= self._children(unit)
            if unit >> 8 & 1:
                start = self.units[node] & 0x7FFFFFFF
                found = place + 1 - at, self.texts[start : self.texts.index(0, start)]
        return found

    @staticmethod
    def _children(unit: int) -> int:
        return (unit >> 10) << ((unit & 1 << 9) >> 6)


class Pieces:
    """One model: normalisation, segmentation, projection, decoding."""

    _made: dict[str, "Pieces"] = {}

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            model = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        rules = model.normalizer_spec
        self.map = CharacterMap(rules.precompiled_charsmap)
        self.prefix, self.squeeze = rules.add_dummy_prefix, rules.remove_extra_whitespaces
        self.escape = rules.escape_whitespaces
        self.suffix = model.trainer_spec.treat_whitespace_as_suffix
        self.decoder = sentencepiece.SentencePieceProcessor(model_file=path)
        # the segmenter takes text that is normalised already
        rules.name, rules.precompiled_charsmap = "identity", b""
        rules.add_dummy_prefix = rules.remove_extra_whitespaces = False
        rules.escape_whitespaces = False
        self.segmenter = sentencepiece.SentencePieceProcessor(
            model_proto=model.SerializeToString()
        )
        self.end = self.decoder.eos_id()
        pieces = [p.piece for p in model.pieces]
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        self.size = np.array(
            [
                1 if p.type == kinds.BYTE else 0 if p.type == kinds.CONTROL else len(p.piece.encode())
                for p in model.pieces
            ],
            np.int32,
        )
        self.unknown = self.decoder.unk_id()
        self.bytes_back = model.trainer_spec.byte_fallback
        self.cut = not self.suffix and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        self.store = PartStore(lambda parts: self.segmenter.encode(parts, num_threads=1))

    @classmethod
    def of(cls, path: str) -> "Pieces":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    # -- normalisation -------------------------------------------------------

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes (and for its end) the
        place in the source's bytes."""
        if not text:
            return "", np.zeros(1, np.int32)
        if not self.map.units and not self.squeeze and self.escape and not self.suffix:
            return self._spaces_only(text)
        return self._by_rules(text.encode())

    def _spaces_only(self, text: str) -> tuple[str, np.ndarray]:
        """An empty map: only spaces change, from one byte to three."""
        lead = SPACE if self.prefix else ""
        made = lead + text.replace(" ", SPACE)
        source = np.frombuffer(text.encode(), np.uint8)
        spaces = np.flatnonzero(source == 32)
        start = len(lead.encode())
        marks = start + spaces + 2 * np.arange(len(spaces))
        # each byte made is one on in the source, but the last two of a mark
        step = np.ones(start + len(source) + 2 * len(spaces) + 1, np.int32)
        step[: start + 1] = 0
        step[marks + 2] = step[marks + 3] = 0
        return made, np.cumsum(step, dtype=np.int32)

    def _by_rules(self, data: bytes) -> tuple[str, np.ndarray]:
        chars: list[tuple[bytes, int, int]] = []  # made, source begin, source end
        at = 0
        while at < len(data):
            rule = self.map.longest(data, at)
            if rule:
                length, made = rule
            else:
                length = 1
                while at + length < len(data) and data[at + length] & 0xC0 == 0x80:
                    length += 1
                made = data[at : at + length]
            chars.append((made, at, at + length))
            at += length
        if self.squeeze:
            while chars and not chars[0][0].strip(b" "):
                chars.pop(0)
            while chars and not chars[-1][0].strip(b" "):
                chars.pop()
        space = SPACE.encode() if self.escape else b" "
        out, places, blank = bytearray(), [], self.squeeze
        if not chars:
            return "", np.array([len(data)], np.int32)

        def lead(place):
            out.extend(space)
            places.extend([place] * len(space))

        if self.prefix and not self.suffix:
            lead(chars[0][1])
        for made, begin, end in chars:
            if self.squeeze and blank:
                made = made.lstrip(b" ")
            for byte in made:
                if byte == 32:
                    out.extend(space)
                    places.extend([begin] * len(space))
                else:
                    out.append(byte)
                    places.append(begin)
            if made == data[begin:end] and b" " not in made:
                places[len(places) - len(made) :] = range(begin, end)
            if made:
                blank = made.endswith(b" ")
        if self.squeeze:
            while out.endswith(space):
                del out[-len(space) :]
                del places[-len(space) :]
        closing = chars[-1][2]
        if self.prefix and self.suffix:
            lead(closing)
        return out.decode(), np.array([*places, closing], np.int32)

    # -- segmentation --------------------------------------------------------

    def batch(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each text's ids with the end id, and the places where pieces begin
        and the last one ends."""
        made = [self.normalise(t) for t in texts]
        laid = Codes.of([text for text, _ in made])
        cut = np.zeros(len(laid.codes), bool)
        if self.cut:
            # no piece spans the place before a run of word marks
            mark = laid.codes == ord(SPACE)
            cut[1:] = mark[1:] & ~mark[:-1]
        cut[0] = cut[laid.starts] = cut[laid.ends] = True
        begin = np.flatnonzero(cut)
        ids, after = self.store.encode(laid.codes, laid.joined, begin)
        # what lies between texts is a part of its own, left out here
        low = after[np.searchsorted(begin, laid.starts)]
        high = after[np.searchsorted(begin, laid.ends)]
        end, out = np.int32(self.end), []
        for (text, places), a, b in zip(made, low, high, strict=True):
            out.append((np.append(ids[a:b], end), self._project(text, places, ids[a:b])))
        return out

    def _project(self, text: str, places: np.ndarray, ids: np.ndarray) -> np.ndarray:
        bounds = np.zeros(len(ids) + 2, np.int64)
        if len(ids):
            sizes = self.size[ids]
            if not self.bytes_back and (ids == self.unknown).any():
                sizes = self._with_unknown(text, ids, sizes)
            np.cumsum(sizes, out=bounds[1:-1])
        bounds[-1] = bounds[-2]
        return places[bounds]

    def _with_unknown(self, text: str, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """An unknown piece is a run of characters: take their size from the text."""
        proto = self.segmenter.encode(text, out_type="immutable_proto")
        return np.array([len(p.surface.encode()) for p in proto.pieces], sizes.dtype)


def encode(docs: DataFrame, model: str, column: str = "text", decoded: str | None = None) -> DataFrame:
    """Add ``ids`` (closed by the end id) and ``offsets``: piece ``i`` is bytes
    ``offsets[i]`` to ``offsets[i + 1]`` of the text in UTF-8.

    With ``decoded``, a column of that name has what the ids decode to, as
    :func:`decode` gives it, without a second pass over the rows.
    """

    def run(batches):
        pieces = Pieces.of(model)
        for batch in slices(batches, column):
            made = pieces.batch(texts_of(batch, column))
            ids, offsets = zip(*made, strict=True)
            added = {
                "ids": int_lists(np.concatenate(ids), [len(x) for x in ids]),
                "offsets": int_lists(np.concatenate(offsets), [len(x) for x in offsets]),
            }
            if decoded:
                texts = [pieces.decoder.decode(x.tolist()) for x in ids]
                added[decoded] = pa.array(texts, pa.string())
            yield with_columns(batch, added)

    added = {"ids": _INTS, "offsets": _INTS} | ({decoded: T.StringType()} if decoded else {})
    return adding(docs, run, added)


def decode(rows: DataFrame, model: str, column: str = "ids", to: str = "decoded") -> DataFrame:
    """Add the text of each row's ids; null ids give the empty text."""

    def run(batches):
        decoder = Pieces.of(model).decoder
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                some = batch.slice(row, 256)
                texts = [decoder.decode(x or []) for x in some.column(column).to_pylist()]
                yield with_columns(some, {to: pa.array(texts, pa.string())})

    return adding(rows, run, {to: T.StringType()})


_INTS = T.ArrayType(T.IntegerType(), False)
