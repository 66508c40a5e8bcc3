"""Bounded-space online packing of tokenised documents into sequences of a fixed length.

Each task keeps a fixed number of open sequences. A document's tokens are cut at the sequence
length; what remains goes whole to the open sequence that it fills best. Where it fits none, the
fullest is topped up with its head, emitted, and replaced by an empty one, and its tail is placed
anew. What is open when a task ends is merged with what other tasks left.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.alignment import _byte_of
from tallyspark.llm.batches import ChainedWords, slices
from tallyspark.session import stage_table

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
MERGED = 1 << 62
LEFTOVER_TASKS = 64


#: How the tokeniser at hand cuts lower-cased words; and words for which no version of Unicode
#: disputes normal form, small letters and classes. A 1 stands for the end of a cut part.
_CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN_CUTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]"
                         "|[^ a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_END = "\x01"


class RankedWords:
    """Ids of plain words by merging bytes by rank; the ends of parts are a byte of their own, which
    merges first. ``of`` gives None where a tokeniser does more than that."""

    def __init__(self, spec: dict):
        from tiktoken import Encoding
        byte_of, vocab = _byte_of(), spec["model"]["vocab"]
        names = list(byte_of) + [c + "</w>" for c in byte_of]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        names += ["".join(m) for m in pairs]
        ranks = {}
        for rank, name in enumerate(names):
            plain = name.removesuffix("</w>")
            ranks[bytes(byte_of[c] for c in plain) + _END.encode() * (plain != name)] = rank
        if len(ranks) != len(names):
            raise ValueError("tokens are not told apart by their bytes")
        self.ids = np.array([vocab[n] for n in names], dtype="<u4")
        self.blank = ranks[b" "]
        self.special = [t["content"][:2].lower() for t in spec["added_tokens"]]
        self.fast = Encoding("words", pat_str=f"[^{_END} ]+{_END}| ", special_tokens={},
                             mergeable_ranks=ranks)

    @classmethod
    def of(cls, path: str) -> "RankedWords | None":
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        steps = [(x["type"], x.get("pattern")) for x in (spec["normalizer"] or {}).get(
            "normalizers", [])]
        cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if (model["type"] != "BPE" or model.get("end_of_word_suffix") != "</w>"
                or model.get("continuing_subword_prefix") or model.get("dropout")
                or model.get("ignore_merges")
                or steps != [("NFC", None), ("Replace", {"Regex": r"\s+"}), ("Lowercase", None)]
                or [x["type"] for x in cuts] != ["Split", "ByteLevel"]
                or cuts[0]["pattern"] != {"Regex": _CUTS} or not cuts[0]["invert"]
                or cuts[1]["add_prefix_space"] or cuts[1]["use_regex"]):
            return None
        try:
            return cls(spec)
        except (KeyError, ValueError):
            return None

    def takes(self, word: str) -> bool:
        return _PLAIN.fullmatch(word) is not None and not any(x in word for x in self.special)

    def encode(self, words: list[str]) -> list[bytes]:
        text = _PLAIN_CUTS.sub(rf"\g<0>{_END}", " ".join(words).lower())
        ranks = np.array(self.fast.encode_ordinary(text + " "), dtype=np.int64)
        blank = ranks == self.blank
        ends = (4 * (np.flatnonzero(blank) - np.arange(len(words)))).tolist()
        data = self.ids[ranks[~blank]].tobytes()
        return [data[i:j] for i, j in zip([0] + ends, ends)]


class WordTokens:
    """Token ids of a text as little-endian 32-bit numbers, remembered by word.

    Holds for tokenisers that never join or look across ASCII white space.
    """

    def __init__(self, path: str, remembered: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.ranked = RankedWords.of(path)
        self.remembered = remembered
        self.known: dict[bytes, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        words = [(t or "").encode().split() for t in texts]
        known = self.known
        new = list({w for doc in words for w in doc} - known.keys())
        if new:
            if len(known) + len(new) > self.remembered:  # words met early are the frequent ones
                known = ChainedWords(known)
            for i in range(0, len(new), 20_000):
                part, plain = [], []
                for word in new[i:i + 20_000]:
                    text = word.decode()
                    (plain if self.ranked and self.ranked.takes(text) else part).append(text)
                if plain:
                    known.update(zip([w.encode() for w in plain], self.ranked.encode(plain)))
                coded = self.tokenizer.encode_batch_fast(part,
                                                         add_special_tokens=False)
                for word, ids in zip(part, coded):
                    known[word.encode()] = array("I", ids.ids).tobytes()
        get = known.__getitem__
        return [b"".join(map(get, doc)) for doc in words]


class OpenSequences:
    """The open sequences of one task. ``emit`` receives (number, pieces) of each finished one."""

    def __init__(self, length: int, count: int, emit: Callable[[list], None]):
        self.length, self.emit = length, emit
        self.pieces: list[list] = [[] for _ in range(count)]
        self.used = [0] * count

    def _put(self, slot: int, piece: tuple) -> None:
        self.pieces[slot].append(piece)
        self.used[slot] += piece[2]
        if self.used[slot] == self.length:
            self.emit(self.pieces[slot])
            self.pieces[slot], self.used[slot] = [], 0

    def add(self, doc_id: int | None, ids: bytes, total: int, start: int = 0) -> None:
        left = len(ids) // 4
        done = 0
        while left:
            if left >= self.length:
                take = self.length
                self.emit([(doc_id, start + done, take, total, ids[4 * done:4 * (done + take)])])
            else:
                fits = [(u, i) for i, u in enumerate(self.used) if u + left <= self.length]
                used, slot = max(fits, default=(0, 0)) if fits else max(
                    (u, i) for i, u in enumerate(self.used))
                take = min(left, self.length - used)
                self._put(slot, (doc_id, start + done, take, total,
                                 ids[4 * done:4 * (done + take)]))
            done += take
            left -= take

    def rest(self) -> list[list]:
        return [p for p in self.pieces if p]


_coders: dict[str, WordTokens] = {}


def _coder(tokenizer: str) -> WordTokens:
    """The worker process's own coder, so that tasks share what it remembers."""
    if tokenizer not in _coders:
        _coders[tokenizer] = WordTokens(tokenizer)
    return _coders[tokenizer]


def _rows(pieces: list[tuple], sequence: int, keep: bool) -> Iterator[tuple]:
    at = 0
    for doc_id, start, length, total, ids in pieces:
        yield (doc_id, start, length, None if keep else zlib.crc32(ids), total, sequence,
               None if keep else at, ids if keep else None)
        at += length


_ARROW = pa.schema([(n, pa.int64()) for n in (
    "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    + [("ids", pa.binary())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, open_sequences: int = 8,
         end_id: int = 1) -> DataFrame:
    """Pack all rows of ``docs`` (doc_id, text) into sequences of ``length`` tokens.

    ``tokenizer`` is a file that every executor can read. A document is its ids and ``end_id``;
    returns one row per piece (see ``SCHEMA``). The pieces of a sequence follow each other without
    a gap; only the last sequence of each group of tasks is not full.

    A null text is an empty one and holds ``end_id`` alone; a null id stays null. Rows that repeat
    an id are packed each on its own. Texts of any length are cut. Other columns are not read. An
    empty table gives no rows.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(tokenizer)
        tail = np.asarray([end_id], dtype="<u4").tobytes()
        context = TaskContext.get()
        base = context.partitionId() << 36
        out: list[tuple] = []
        number = [0]

        def emit(pieces):
            out.extend(_rows(pieces, base + number[0], keep=False))
            number[0] += 1

        packer = OpenSequences(length, open_sequences, emit)
        for batch in batches:
            for part in slices(batch):
                ids = part.column("doc_id").to_pylist()
                for doc_id, coded in zip(ids, coder.encode(part.column("text").to_pylist())):
                    coded += tail
                    packer.add(doc_id, coded, len(coded) // 4)
                if out:
                    yield _batch(out)
                    out.clear()
        for pieces in packer.rest():
            out.extend(_rows(pieces, base + number[0], keep=True))
            number[0] += 1
        if out:
            yield _batch(out)

    def merge(table):
        rows = sorted(table.to_pylist(), key=lambda r: r["sequence_id"])
        base = MERGED + ((rows[0]["sequence_id"] >> 36) // LEFTOVER_TASKS << 32)
        out: list[tuple] = []
        number = [0]

        def emit(pieces):
            out.extend(_rows(pieces, base + number[0], keep=False))
            number[0] += 1

        packer = OpenSequences(length, 1, emit)
        for r in rows:
            packer.add(r["doc_id"], r["ids"], r["doc_tokens"], r["start"])
        for pieces in packer.rest():
            emit(pieces)
        return pa.Table.from_batches([_batch(out)]).select(SCHEMA.replace(" long", "").split(", "))

    pieces = stage_table(
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, f"{SCHEMA}, ids binary"),
        "packed")
    done = pieces.filter("ids IS NULL").drop("ids")
    open_ones = pieces.filter("ids IS NOT NULL")
    groups = F.shiftright("sequence_id", 36) / LEFTOVER_TASKS
    merged = (open_ones.groupBy(F.floor(groups).alias("tasks")).applyInArrow(merge, SCHEMA))
    return done.unionByName(merged)
