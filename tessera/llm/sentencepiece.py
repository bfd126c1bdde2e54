"""Offset-preserving SentencePiece encoding, and decoding.

The text is normalised here, by longest-prefix matches in the model's compiled character map (a
double-array trie), and every normalised byte keeps the byte of the original that it came from.
The library then segments the normalised text with its own normaliser switched off, and piece
lengths, summed, project each piece to the bytes [begin, end) of the original text.

Cases: a null text counts as empty; an empty text gives empty arrays; a text of any length is
encoded whole; repeated rows and ids are encoded each; an empty table gives an empty result; columns
other than the id columns and the text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, strings

SPACE = "▁".encode()
WIDTH = len(SPACE)
#: Piece types of the model format: fixed values.
UNKNOWN, CONTROL, USER_DEFINED, BYTE = 2, 3, 4, 6


class CharacterMap:
    """The compiled map of a model: longest prefix to replacement."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size :] if blob else b""
        self.first = frozenset(c for c in range(256) if self._step(self._root(), c) is not None) if self.units else frozenset()

    @staticmethod
    def _jump(unit: int) -> int:
        return (unit >> 10) << ((unit >> 6) & 8)

    def _root(self) -> int:
        return self._jump(self.units[0])

    def _step(self, at: int, c: int) -> int | None:
        """The unit's place after byte c, None where no key goes on."""
        at ^= c
        if at >= len(self.units) or self.units[at] & 0x800000FF != c:
            return None
        return at

    def longest(self, data: bytes, i: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest key at data[i:]."""
        at, found, n = self._root(), None, len(data)
        j = i
        while j < n:
            place = self._step(at, data[j])
            if place is None:
                break
            unit = self.units[place]
            at = place ^ self._jump(unit)
            j += 1
            if unit >> 8 & 1:
                found = (self.units[at] & 0x7FFFFFFF, j - i)
        if found is None:
            return None
        start = found[0]
        return self.texts[start : self.texts.index(b"\0", start)], found[1]


class Normaliser:
    """A model's normalisation with, for each byte of the result, the original byte offset."""

    def __init__(self, spec, symbols: list[str], suffix: bool):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze, self.escape, self.suffix = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces, suffix
        keys = sorted((s.encode() for s in symbols), key=len, reverse=True)
        self.symbols = re.compile(b"|".join(map(re.escape, keys))) if keys else None
        self.plain = not self.map.units and not self.squeeze and not keys and not suffix

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and their original offsets with one more at the end."""
        return self._identity(data) if self.plain else self._mapped(data)

    def _identity(self, data: bytes) -> tuple[bytes, np.ndarray]:
        raw = np.frombuffer(data, np.uint8)
        n = len(raw)
        if not n:
            return b"", np.zeros(1, np.int64)
        at = np.arange(n, dtype=np.int64)
        if not data.isascii():
            at = np.maximum.accumulate(np.where((raw & 0xC0) != 0x80, at, 0))
        if self.escape:
            at = np.repeat(at, np.where(raw == 0x20, WIDTH, 1))
            data = data.replace(b" ", SPACE)
        lead = (SPACE if self.escape else b" ") if self.dummy else b""
        return lead + data, np.concatenate([np.zeros(len(lead), np.int64), at, [n]])

    def _prefix(self, data: bytes, i: int) -> tuple[bytes, int]:
        if self.symbols and (m := self.symbols.match(data, i)):
            return m.group(), m.end() - i
        if data[i] in self.map.first and (hit := self.map.longest(data, i)):
            return hit
        c = data[i]
        size = 1 if c < 0x80 else 2 if c < 0xE0 else 3 if c < 0xF0 else 4
        return data[i : i + size], size

    def _mapped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        n, i = len(data), 0
        out, at = bytearray(), []
        blank = SPACE if self.escape else b" "
        if self.squeeze:
            while i < n and (hit := self._prefix(data, i))[0] == b" ":
                i += hit[1]
        if i >= n:
            return b"", np.zeros(1, np.int64)
        if self.dummy and not self.suffix:
            out += blank
            at += [i] * len(blank)
        spaced = self.squeeze
        while i < n:
            text, size = self._prefix(data, i)
            if spaced:
                text = text.lstrip(b" ")
            if text:
                shown = text.replace(b" ", SPACE) if self.escape else text
                out += shown
                at += [i] * len(shown)
                spaced = text.endswith(b" ")
            i += size
            spaced = spaced and self.squeeze
        if self.squeeze:
            while out.endswith(blank):
                i = at[len(out) - len(blank)]
                del out[-len(blank) :], at[-len(blank) :]
        if self.dummy and self.suffix:
            out += blank
            at += [i] * len(blank)
        return bytes(out), np.array([*at, i], np.int64)


@lru_cache(2)
def encoder(model_path: str) -> Encoder:
    """One Encoder for all tasks of a worker."""
    return Encoder(model_path)


class Encoder:
    """Ids and original byte spans by a model file."""

    def __init__(self, model_path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_path, "rb") as f:
            model.ParseFromString(f.read())
        pieces = model.pieces
        self.normalise = Normaliser(model.normalizer_spec, [p.piece for p in pieces if p.type == USER_DEFINED], model.trainer_spec.treat_whitespace_as_suffix)
        self.sizes = np.array([1 if p.type == BYTE else -1 if p.type == UNKNOWN else len(p.piece.encode()) for p in pieces], np.int64)
        self.whole = SentencePieceProcessor(model_file=model_path)
        spec = model.normalizer_spec
        spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces = b"", False, False
        self.inner = SentencePieceProcessor(model_proto=model.SerializeToString())

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text: ids, begins and ends."""
        normal = [self.normalise(t.encode()) for t in texts]
        plain = [x.decode() for x, _ in normal]
        for text, ids, (_, at) in zip(plain, self.inner.encode(plain, num_threads=1), normal, strict=True):
            ids = np.array(ids, np.int32)
            sizes = self.sizes[ids]
            if (sizes < 0).any():
                sizes = np.array([len(p.encode()) if s < 0 else s for p, s in zip(self.inner.encode(text, out_type=str), sizes, strict=True)], np.int64)
            ends = np.cumsum(sizes)
            yield ids, at[ends - sizes].astype(np.int32), at[ends].astype(np.int32)

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return [self.whole.decode(x.tolist()) if len(x) else "" for x in ids]


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *(len(v) for v in values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*values, np.empty(0, np.int32)]).astype(np.int32)))


def encode(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(id, ids, begins, ends[, decoded]) of each row: arrays of one int a piece.

    begins and ends are byte offsets in the text's UTF-8; a piece made of no original byte has
    begin = end. decoded: also decode(ids), while the worker has them.
    """

    def start():
        codec = encoder(model_path)

        def work(batch):
            ids, begins, ends = zip(*codec.encode(strings(batch.column(1))), strict=True)
            columns = [batch.column(0), _lists(ids), _lists(begins), _lists(ends)]
            names = ["id", "ids", "begins", "ends"]
            if decoded:
                columns.append(pa.array(codec.decode(ids), pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names=names)

        return work

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_texts(rows, start, "id long, ids array<int>, begins array<int>, ends array<int>" + ", decoded string" * decoded)


def decode(df: DataFrame, model_path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded) of rows that hold id arrays; null counts as empty."""

    def start():
        codec = encoder(model_path)

        def work(batch):
            ids = [np.array(x or [], np.int32) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codec.decode(ids), pa.string())], names=["id", "decoded"])

        return work

    return map_texts(df.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids")), start, "id long, decoded string")
