"""SentencePiece encoding that keeps, for every piece, the span of the original text it stands for.

The normaliser replaces the longest prefix that the model's compiled character map knows, and
records for each byte it writes the source byte it comes from. Merging is done by the library on
the units between blanks, whose pieces no merge can join, and remembered by unit.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyspark.llm.batches import ChainedWords, slices

BLANK = "▁".encode()
_UNIT = re.compile(rb" *[^ ]+| +$")


class CharacterMap:
    """A compiled character map: a double-array trie over UTF-8 keys, then its replacements.

    The blob holds the size of the trie in bytes, the trie's 32-bit units and the zero-terminated
    replacements; a leaf's value is where its replacement starts.
    """

    def __init__(self, blob: bytes):
        size = struct.unpack("<I", blob[:4])[0] if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], dtype="<u4").tolist() if blob else []
        self.replacements = blob[4 + size:]

    def __bool__(self) -> bool:
        return bool(self.units)

    def longest(self, data: bytes, start: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that ``data`` has at ``start``."""
        units, found = self.units, None
        node = _child_base(units[0])
        for at in range(start, len(data)):
            node ^= data[at]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[at]:
                break
            node ^= _child_base(unit)
            if unit >> 8 & 1:
                value = units[node] & 0x7FFFFFFF
                found = at + 1 - start, value
        if not found:
            return None
        end = self.replacements.index(b"\0", found[1])
        return found[0], self.replacements[found[1]:end]


def _child_base(unit: int) -> int:
    return (unit >> 10) << ((unit & 0x200) >> 6)


def _step(first: int) -> int:
    return 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


class Normalizer:
    """Text to the form that pieces are cut from, with blanks as single bytes (see ``BLANK``)."""

    def __init__(self, chars: CharacterMap, dummy_prefix: bool, squeeze: bool):
        self.chars, self.dummy_prefix, self.squeeze = chars, dummy_prefix, squeeze

    def _prefixes(self, data: bytes) -> tuple[bytes, np.ndarray]:
        out, source = bytearray(), []
        at = 0
        while at < len(data):
            found = self.chars.longest(data, at)
            if found:
                length, text = found
            else:
                length = _step(data[at])
                text = data[at:at + length]
            out += text
            source += [at] * len(text) if found else range(at, at + length)
            at += length
        return bytes(out), np.asarray(source + [len(data)], dtype=np.int64)

    def apply(self, data: bytes) -> tuple[bytes, np.ndarray | None, int]:
        """The normal form, each of its bytes' source offset (None: the same), and whether a blank
        was put before it."""
        source = None
        if self.chars:
            data, source = self._prefixes(data)
        if BLANK in data:
            keep = np.ones(len(data), dtype=bool)
            for m in re.finditer(BLANK, data):
                keep[m.start() + 1:m.end()] = False
            source = np.append((np.arange(len(data)) if source is None else source[:-1])[keep],
                               len(data) if source is None else source[-1])
            data = data.replace(BLANK, b" ")
        if self.squeeze:
            raw = np.frombuffer(data, dtype=np.uint8) == 32
            keep = ~(raw & np.append(True, raw[:-1]))
            if len(keep) and raw[-1]:
                keep[len(data.rstrip(b" ")):] = False
            source = np.append((np.arange(len(data)) if source is None else source[:-1])[keep],
                               len(data) if source is None else source[-1])
            data = np.frombuffer(data, dtype=np.uint8)[keep].tobytes()
        if data and self.dummy_prefix:
            return b" " + data, source, 1
        return data, source, 0


class PieceCoder:
    """Encodes with one model; remembers the pieces of the units it met."""

    def __init__(self, path: str, remembered: int = 300_000):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto
        self.library = SentencePieceProcessor(model_file=path)
        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if model.trainer_spec.treat_whitespace_as_suffix or not spec.escape_whitespaces or any(
                "▁" in p.piece.lstrip("▁") for p in model.pieces):
            raise ValueError("pieces of this model cross blanks")
        self.normalizer = Normalizer(CharacterMap(spec.precompiled_charsmap),
                                     spec.add_dummy_prefix, spec.remove_extra_whitespaces)
        self.dummy_prefix = spec.add_dummy_prefix
        self.surface = [
            bytes([int(p.piece[3:5], 16)]) if p.type == p.BYTE else
            b"" if p.type == p.CONTROL else p.piece.replace("▁", " ").encode()
            for p in model.pieces]
        self.remembered = remembered
        #: unit -> (its ids as decimal text, its decoded bytes, length in bytes of each piece)
        self.known: dict[bytes, tuple[bytes, bytes, bytes]] = {}

    def _learn(self, new: list[bytes], into: dict) -> None:
        cut = 1 if self.dummy_prefix else 0
        for i in range(0, len(new), 20_000):
            part = new[i:i + 20_000]
            coded = self.library.encode([u[cut:].decode() for u in part], num_threads=1)
            for unit, ids in zip(part, coded):
                if cut and unit == b" ":
                    ids = [self.library.piece_to_id("▁")]
                texts = [self.surface[x] for x in ids]
                into[unit] = (",".join(map(str, ids)).encode(), b"".join(texts),
                              array("I", map(len, texts)).tobytes())

    def units(self, texts: list[bytes]) -> list[list[tuple[bytes, bytes, bytes]]]:
        cut = [_UNIT.findall(t) for t in texts]
        known = self.known
        new = list({u for doc in cut for u in doc} - known.keys())
        if new:
            if len(known) + len(new) > self.remembered:  # units met early are the frequent ones
                known = ChainedWords(known)
            self._learn(new, known)
        get = known.__getitem__
        return [list(map(get, doc)) for doc in cut]

    def encode(self, texts: list[str | None]) -> Iterator["Encoded"]:
        forms = [self.normalizer.apply((t or "").encode()) for t in texts]
        for units, (_, source, added) in zip(self.units([f[0] for f in forms]), forms):
            yield Encoded(units, source, added)


class Encoded:
    """The pieces of one text."""

    def __init__(self, units: list[tuple[bytes, bytes, bytes]], source: np.ndarray | None,
                 added: int):
        self.ids_text = b",".join([u[0] for u in units])
        self.decoded = b"".join([u[1] for u in units])[added:]
        self._lengths = b"".join([u[2] for u in units])
        self._source, self._added = source, added

    @property
    def ids(self) -> list[int]:
        return [int(x) for x in self.ids_text.split(b",")] if self.ids_text else []

    def ends(self) -> np.ndarray:
        """Where each piece ends in the original text, in bytes; it starts where the last ended."""
        ends = np.cumsum(np.frombuffer(self._lengths, dtype="<u4"), dtype=np.int64)
        ends = np.maximum(ends - self._added, 0)
        return ends if self._source is None else self._source[ends]

    def spans(self) -> list[tuple[int, int]]:
        ends = self.ends().tolist()
        return list(zip([0] + ends[:-1], ends))


_coders: dict[str, PieceCoder] = {}


def _coder(model: str) -> PieceCoder:
    """The worker process's own coder, so that tasks share what it remembers."""
    if model not in _coders:
        _coders[model] = PieceCoder(model)
    return _coders[model]


def encode_texts(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids, starts and ends (in bytes of the original text) of each piece, decoded text.

    A null text is an empty one: no pieces, an empty text. A null id stays null; rows that repeat
    an id are encoded each on its own. Long texts are encoded whole. Other columns are not read.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model)
        for batch in batches:
            for part in slices(batch, limit=1 << 18):
                coded = list(coder.encode(part.column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([c.ids for c in coded], pa.list_(pa.int32())),
                    pa.array([[s for s, _ in c.spans()] for c in coded], pa.list_(pa.int64())),
                    pa.array([e for e in (c.ends() for c in coded)], pa.list_(pa.int64())),
                    pa.array([c.decoded.decode() for c in coded], pa.string()),
                ], names=["doc_id", "ids", "starts", "ends", "decoded"])

    return docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text").mapInArrow(
        task, "doc_id long, ids array<int>, starts array<long>, ends array<long>, decoded string")


def digest_texts(docs: DataFrame, model: str) -> DataFrame:
    """As ``encode_texts``, with digests in place of the ids, spans and text.

    ``spans_crc32`` is over the pieces' ends as little-endian 64-bit numbers.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model)
        for batch in batches:
            for part in slices(batch):
                rows = []
                for c in coder.encode(part.column("text").to_pylist()):
                    rows.append((c.ids_text.count(b",") + 1 if c.ids_text else 0,
                                 hashlib.sha256(c.ids_text).hexdigest(),
                                 hashlib.sha256(c.decoded).hexdigest(),
                                 zlib.crc32(c.ends().astype("<i8").tobytes())))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string()),
                    pa.array(columns[3], pa.int64()),
                ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"])

    return docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text").mapInArrow(
        task, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, "
              "spans_crc32 long")
