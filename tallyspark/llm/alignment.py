"""Alignment of two tokenizers' tokens, with corpus-wide counts of the pairs that overlap.

Both tokenizers cut a text only inside the units that blanks begin, so the tokens, groups and links
of a unit are found once and remembered. The first pass counts, in each task, how many documents
hold each pair. The distinct pairs are dealt into segments, each with a minimal perfect hash of its
own; the tasks' counts become dense vectors indexed by it, which are summed in a tree. The second
pass aligns the documents again and looks the counts up, checking the key stored at each place.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.batches import ChainedWords, slices
from tallyspark.llm.perfecthash import PerfectHash
from tallyspark.session import stage_table

#: Pairs in a segment of the perfect hash.
SEGMENT = 1 << 16
#: Tasks that make dense vectors, and how many vectors one step of the tree sums.
SUMMERS, FAN = 32, 8
#: The table is sent to every task while it has at most this many pairs (12 bytes each); beyond
#: that, the documents' pairs meet their counts in a join.
SENT_PAIRS = 12_000_000
_KEPT = 4_000_000

# How a byte-level tokenizer cuts a text before merging.
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Characters whose class no version of Unicode disputes.
_PLAIN = re.compile("[ -~\\t\\n\\r\u00c0-\u024f]*")
_LOOSE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")

DIGESTS = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
           "count_sum long, groups_sha256 string")


def segment_of(pair, segments: int):
    """The segment of a pair, alike for a column and an array."""
    if isinstance(pair, Column):
        return F.shiftright((pair * F.lit(2654435761)) % F.lit(1 << 32), 8) % F.lit(segments)
    return ((pair.astype(np.uint64) * np.uint64(2654435761)) % np.uint64(1 << 32)
            >> np.uint64(8)).astype(np.int64) % segments


def _byte_of() -> dict[str, int]:
    """The bytes that stand behind the characters of a byte-level vocabulary."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class TokenPair:
    """Both tokenizers, with the bytes of every token."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto
        from tiktoken import Encoding
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or before.get("type") != "ByteLevel" or not before["use_regex"] \
                or before["add_prefix_space"]:
            raise ValueError("the first tokenizer is not plain byte-level")
        byte_of = _byte_of()
        self.bytes_a = [b""] * (max(self.a.get_vocab().values()) + 1)
        for piece, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(byte_of[c] for c in piece) if all(
                c in byte_of for c in piece) else piece.encode()

        # Where each merge makes the next id, ids are the ranks that a faster encoder merges by.
        self.fast = None
        merges, vocab = spec["model"]["merges"], spec["model"]["vocab"]
        if all(vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] == 256 + i
               for i, m in enumerate(merges)):
            self.fast = Encoding(path_a, pat_str=_BYTE_LEVEL, special_tokens={}, mergeable_ranks={
                self.bytes_a[i]: i for i in vocab.values()})

        self.b = SentencePieceProcessor(model_file=path_b)
        model = proto.ModelProto()
        with open(path_b, "rb") as f:
            model.ParseFromString(f.read())
        n = model.normalizer_spec
        if n.precompiled_charsmap or n.remove_extra_whitespaces or not n.add_dummy_prefix \
                or not n.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix \
                or any("▁" in p.piece.lstrip("▁") for p in model.pieces):
            raise ValueError("the second tokenizer changes its text or joins across blanks")
        self.bytes_b = [bytes([int(p.piece[3:5], 16)]) if p.type == p.BYTE
                        else p.piece.replace("▁", " ").encode() for p in model.pieces]
        self.blank = self.b.piece_to_id("▁")
        self.lengths_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.lengths_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        self.radix = len(self.bytes_b)

    def encode(self, units: list[str]) -> tuple[list[int], list[int]]:
        """Ids of the units in sequence, a blank before each, by both.

        Units that end in white space would run into the blank of the next one: pass these alone.
        """
        text = " ".join(units)
        if self.fast and self.is_plain(text):
            a = self.fast.encode_ordinary(" " + text)
        else:
            a = self.a.encode(" " + text, add_special_tokens=False).ids
        return a, self.b.encode(text, num_threads=1) if text else [self.blank]

    @staticmethod
    def is_plain(text: str) -> bool:
        return _PLAIN.fullmatch(text) is not None


def units_of(text: str) -> list[str]:
    """The parts of " " + text that its blanks begin, each without that blank.

    A blank begins a part where what stands before it is not white space: there no token of either
    kind goes across.
    """
    if _LOOSE.search(text) or text[:1].isspace():
        return [u[1:] for u in _CUT.split(" " + text)]
    return text.split(" ")


class Aligner:
    """The alignment of units, remembered; ``table`` gives the counts of their links.

    The first ``remembered`` units stay, for these are the frequent ones; later ones are forgotten
    after the texts that brought them.
    """

    def __init__(self, tokens: TokenPair, table: "PairCounts | None" = None,
                 remembered: int = 500_000):
        self.tokens, self.table, self.remembered = tokens, table, remembered
        self.known: dict[str, int] = {}
        self.characters = 0
        self.groups: list[bytes] = []
        #: A row a unit: tokens of A, of B, groups, links, best links, sum of counts, and as flags
        #: that its bytes are false and that the table misses pairs
        self.figures = np.zeros((1024, 8), dtype=np.int64)
        self.pairs = array("q")
        self.pair_at = array("q", [0])

    def attach(self, table: "PairCounts") -> None:
        """Take the counts from a table, for what is known already too."""
        self._forget()
        self.table = table
        links = self.figures[:len(self.groups), 3]
        self.figures[:len(links)][links > 0, 4:8] = self._counted(
            np.asarray(self.pairs, np.int64), links[links > 0])

    def _counted(self, pairs: np.ndarray, links: np.ndarray) -> np.ndarray:
        """Columns 4 to 7 of units with so many links each; 6 is left at zero."""
        out = np.zeros((len(links), 4), dtype=np.int64)
        if self.table is not None and len(links):
            found, best = self.table.of(pairs)
            starts = np.cumsum(links) - links
            for column, values in ((0, found == best), (1, np.maximum(found, 0)), (3, found < 0)):
                out[:, column] = np.add.reduceat(values.astype(np.int64), starts)
        return out

    def _learn(self, units: list[str], into: dict[str, int], grouped: bool) -> None:
        """Align units: in long runs where nothing stops it, else one by one."""
        runs: dict[bool, list[str]] = {True: [], False: []}
        alone = []
        for u in units:
            if u and not u[-1].isspace():
                runs[self.tokens.is_plain(u)].append(u)
            else:
                alone.append(u)
        for run in runs.values():
            for i in range(0, len(run), 2000):
                part = run[i:i + 2000]
                if not self._add(part, into, grouped):
                    alone += part
        for u in alone:
            if not self._add([u], into, grouped):
                self._keep([u], np.array([[0, 0, 0, 0, 0, 0, 1, 0]]), [b""],
                           np.zeros(0, np.int64), into)

    def _keep(self, units, rows, texts, pairs, into) -> None:
        start = len(self.groups)
        while start + len(units) > len(self.figures):
            self.figures = np.concatenate([self.figures, np.zeros_like(self.figures)])
        self.figures[start:start + len(units)] = rows
        self.groups += texts
        into.update(zip(units, range(start, start + len(units))))
        self.pair_at.extend((self.pair_at[-1] + np.cumsum(rows[:, 3])).tolist())
        self.pairs.frombytes(pairs.astype(np.int64).tobytes())

    def _add(self, units: list[str], into: dict[str, int], grouped: bool) -> bool:
        """Align some units; False, and nothing kept, if a token's bytes are not the text's."""
        t = self.tokens
        ids_a, ids_b = t.encode(units)
        whole = (" " + " ".join(units)).encode()
        if not b"".join([t.bytes_a[x] for x in ids_a]) == whole == b"".join(
                [t.bytes_b[x] for x in ids_b]):
            return False
        a, b = np.array(ids_a, dtype=np.int64), np.array(ids_b, dtype=np.int64)
        ends_a, ends_b = np.cumsum(t.lengths_a[a]), np.cumsum(t.lengths_b[b])
        unit_ends = np.cumsum([len(u.encode()) + 1 for u in units])
        # Between two neighbouring ends lies one token of each kind: every link once.
        ends = np.union1d(ends_a, ends_b)
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        if not np.isin(unit_ends, both).all():
            raise AssertionError("a token goes across units")
        pairs = a[np.searchsorted(ends_a, ends)] * t.radix + b[np.searchsorted(ends_b, ends)]

        def per_unit(places):
            return np.bincount(np.searchsorted(unit_ends, places), minlength=len(units))

        rows = np.zeros((len(units), 8), dtype=np.int64)
        rows[:, 3] = links = per_unit(ends)
        rows[:, 0], rows[:, 1], rows[:, 2] = per_unit(ends_a), per_unit(ends_b), per_unit(both)
        rows[:, 4:8] = self._counted(pairs, links)
        texts = self._group_texts(a, b, ends_a, ends_b, both, unit_ends) if grouped else [
            b""] * len(units)
        self._keep(units, rows, texts, pairs, into)
        return True

    @staticmethod
    def _group_texts(a, b, ends_a, ends_b, both, unit_ends) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each unit."""
        group = np.concatenate([np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)])
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.lexsort((np.arange(len(group)), side, group))
        group, side = group[order], side[order]
        marks = np.full(len(order), ",", dtype=object)
        marks[:-1][side[1:] != side[:-1]] = "|"
        last = np.append(group[1:] != group[:-1], True)
        marks[last] = ";"
        stops = np.flatnonzero(last)[np.searchsorted(both, unit_ends)] + 1
        marks[stops - 1] = ""
        ids = np.concatenate([a, b])[order].tolist()
        texts = [f"{i}{m}" for i, m in zip(ids, marks.tolist())]
        starts = np.append(0, stops[:-1])
        return ["".join(texts[x:y]).encode() for x, y in zip(starts.tolist(), stops.tolist())]

    def _forget(self) -> None:
        """Drop what was learnt beyond the units that stay."""
        del self.groups[len(self.known):]
        del self.pair_at[len(self.known) + 1:]
        del self.pairs[self.pair_at[-1]:]

    def places(self, texts: list[str | None],
               grouped: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all texts' units in sequence, and where each text's start.

        They hold until the next call. Units that will be forgotten go without the text of their
        groups unless ``grouped``.
        """
        self._forget()
        cut = [units_of(t) if t else [] for t in texts]
        known = self.known
        new = list({u for doc in cut for u in doc} - known.keys())
        if new:
            size = sum(map(len, new))
            if len(known) + len(new) > self.remembered or (
                    self.characters + size > 32 * self.remembered):
                known = ChainedWords(known)
            else:
                self.characters += size
                grouped = True
            self._learn(new, known, grouped)
        get = known.__getitem__
        flat = np.fromiter((i for doc in cut for i in map(get, doc)), dtype=np.int64,
                           count=sum(map(len, cut)))
        return flat, np.append(0, np.cumsum([len(doc) for doc in cut]))

    def _whole(self, flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the figures by text, and which texts have tokens at all."""
        sums = np.zeros((len(flat) + 1, 8), dtype=np.int64)
        np.cumsum(self.figures[flat], axis=0, out=sums[1:])
        total = sums[at[1:]] - sums[at[:-1]]
        right = (total[:, 6] == 0) & (at[1:] > at[:-1])
        if total[right, 7].any():
            raise ValueError("a text holds pairs that the first pass did not see")
        return total * right[:, None], right

    def figures_of(self, texts: list[str | None]) -> tuple[np.ndarray, list[str]]:
        flat, at = self.places(texts)
        total, right = self._whole(flat, at)
        groups, hashes = self.groups, []
        for ok, x, y in zip(right.tolist(), at[:-1].tolist(), at[1:].tolist()):
            hashes.append(hashlib.sha256(b";".join([groups[i] for i in flat[x:y].tolist()]))
                          .hexdigest() if ok else "")
        return total, hashes

    def pairs_of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, pair and how often the pair is linked there, for each text's distinct pairs."""
        flat, at = self.places(texts, grouped=False)
        _, right = self._whole(flat, at)
        text = np.repeat(np.arange(len(texts)), np.diff(at))
        keep = right[text]
        size = max(len(self.groups), 1)
        key, times = np.unique(text[keep] * size + flat[keep], return_counts=True)
        text, unit = key // size, key % size
        pair_at, pairs = np.frombuffer(self.pair_at, np.int64), np.asarray(self.pairs, np.int64)
        counts = pair_at[unit + 1] - pair_at[unit]
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        linked = pairs[np.repeat(pair_at[unit], counts) + inner]
        key = (np.repeat(text, counts) << 40) | linked
        key, where = np.unique(key, return_inverse=True)
        n = np.bincount(where, weights=np.repeat(times, counts), minlength=len(key))
        return key >> 40, key & ((1 << 40) - 1), n.astype(np.int64)


class PairCounts:
    """Dense counts of all pairs, found by the segments' perfect hashes, with keys to verify."""

    def __init__(self, rows: list[tuple[int, bytes, bytes, bytes]], segments: int, radix: int):
        self.segments, self.radix = segments, radix
        self.parts: dict[int, tuple] = {}
        self.best = np.zeros(0, dtype=np.int64)
        for segment, places, keys, counts in rows:
            keys, counts = np.frombuffer(keys, "<i8"), np.frombuffer(counts, "<i8")
            self.parts[segment] = PerfectHash.from_bytes(places), keys, counts
            a = keys // radix
            if a.max() >= len(self.best):
                self.best = np.append(self.best, np.zeros(a.max() + 1 - len(self.best), np.int64))
            np.maximum.at(self.best, a, counts)

    def of(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each pair's count and the highest count of its first token; -1 for an unknown pair."""
        where, found = segment_of(pairs, self.segments), np.full(len(pairs), -1, dtype=np.int64)
        order = np.argsort(where, kind="stable")
        cuts = np.flatnonzero(np.diff(where[order], prepend=-1))
        for mine in np.split(order, cuts)[1:]:
            if (part := self.parts.get(int(where[mine[0]]))) is None:
                continue
            places, keys, counts = part
            at = places.numbers(pairs[mine])
            right = (at >= 0) & (keys[at] == pairs[mine])
            found[mine[right]] = counts[at[right]]
        first = pairs // self.radix
        known = first < len(self.best)
        return found, np.where(known, self.best[np.where(known, first, 0)], 0)


_aligners: dict[tuple, tuple[Aligner, int | None]] = {}


def _aligner(path_a: str, path_b: str, sent=None) -> Aligner:
    """The worker process's own. What it learnt in a first pass serves the second one too."""
    aligner, table = _aligners.get((path_a, path_b), (None, None))
    if aligner is None:
        aligner = Aligner(TokenPair(path_a, path_b))
    if sent and sent[0] != table:
        aligner.attach(PairCounts(*sent[1].value, aligner.tokens.radix))
    elif not sent and table is not None:
        aligner = Aligner(aligner.tokens)
    _aligners[path_a, path_b] = aligner, sent and sent[0]
    return aligner


def _documents_holding(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """pair, n: how many of a task's documents hold each pair; a pair comes from several tasks."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        size, least = 0, _KEPT

        def merged():
            pair, where = np.unique(np.concatenate([p for p, _ in waiting]), return_inverse=True)
            n = np.bincount(where, weights=np.concatenate([n for _, n in waiting]))
            return pair, n.astype(np.int64)

        for batch in batches:
            for part in slices(batch):
                _, pair, _ = aligner.pairs_of(part.column("text").to_pylist())
                waiting.append(np.unique(pair, return_counts=True))
                size += len(waiting[-1][0])
                if size > least:
                    waiting = [merged()]
                    size = len(waiting[0][0])
                    least = max(_KEPT, 2 * size)
                    if size > _KEPT:
                        yield from _rows(*waiting[0])
                        waiting, size, least = [], 0, _KEPT
        if waiting:
            yield from _rows(*merged())

    def _rows(pair, n):
        for i in range(0, len(pair), 100_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair[i:i + 100_000]), pa.array(n[i:i + 100_000])], names=["pair", "n"])

    return docs.select(F.col("text").cast("string")).mapInArrow(task, "pair long, n long")


def _hashes(pairs: DataFrame, segments: int) -> DataFrame:
    """segment, places, keys: the perfect hash of each segment and its pairs in their order."""
    def build(table: pa.Table) -> pa.Table:
        keys = table.column("pair").to_numpy()
        places = PerfectHash.build(keys)
        ordered = np.empty(len(keys), dtype="<i8")
        ordered[places.numbers(keys)] = keys
        return pa.table({"segment": table.column("segment")[:1],
                         "places": pa.array([places.to_bytes()], pa.binary()),
                         "keys": pa.array([ordered.tobytes()], pa.binary())})

    return pairs.withColumn("segment", segment_of(F.col("pair"), segments)).groupBy(
        "segment").applyInArrow(build, "segment long, places binary, keys binary")


def _dense(partials: DataFrame, hashes: DataFrame, segments: int) -> DataFrame:
    """segment, counts: the sum of all partial counts as a vector in the order of the hash."""
    context = partials.sparkSession.sparkContext
    sent = context.broadcast([(r.segment, bytes(r.places))
                              for r in hashes.select("segment", "places").toLocalIterator()])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        places = {s: PerfectHash.from_bytes(p) for s, p in sent.value}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            pair, n = (batch.column(c).to_numpy() for c in ("pair", "n"))
            where = segment_of(pair, segments)
            order = np.argsort(where, kind="stable")
            cuts = np.flatnonzero(np.diff(where[order], prepend=-1))
            for mine in np.split(order, cuts[1:]):
                if len(mine):
                    s = int(where[mine[0]])
                    at = places[s].numbers(pair[mine])
                    if s not in sums:
                        sums[s] = np.zeros(int(sum(np.bitwise_count(b).sum()
                                                   for b in places[s].bits)), dtype="<i8")
                    np.add.at(sums[s], at, n[mine])
        task = TaskContext.get().partitionId()
        for s, vector in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int64()), pa.array([task], pa.int64()),
                 pa.array([vector.tobytes()], pa.binary())], names=["segment", "task", "counts"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = None, None
        for batch in batches:
            first = first if first is not None else batch.slice(0, 1)
            for vector in batch.column("counts"):
                vector = np.frombuffer(vector.as_buffer(), "<i8")
                total = vector.copy() if total is None else total + vector
        yield pa.RecordBatch.from_arrays(
            [first.column("segment"), first.column("task"),
             pa.array([total.tobytes()], pa.binary())], names=["segment", "task", "counts"])

    ddl = "segment long, task long, counts binary"
    rows = partials.coalesce(SUMMERS).mapInArrow(vectors, ddl)
    width = SUMMERS
    while width > 1:
        width = -(-width // FAN)
        rows = rows.withColumn("task", F.floor(F.col("task") / FAN).cast("long"))
        rows = rows.groupBy("segment", "task").applyInArrow(added, ddl)
    return rows.select("segment", "counts")


def _looked_up(docs: DataFrame, path_a: str, path_b: str, table: DataFrame,
               segments: int) -> DataFrame:
    spark = docs.sparkSession
    rows = [(r.segment, bytes(r.places), bytes(r["keys"]), bytes(r.counts))
            for r in table.toLocalIterator()]
    sent = spark.sparkContext.broadcast((rows, segments))
    name = sent._jbroadcast.id()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b, (name, sent))
        for batch in batches:
            for part in slices(batch):
                total, hashes = aligner.figures_of(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(total[:, i]) for i in range(6)],
                     pa.array(hashes, pa.string())], names=_NAMES)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        task, DIGESTS)


_NAMES = [c.split()[0] for c in DIGESTS.split(", ")]


def _joined(docs: DataFrame, path_a: str, path_b: str, counts: DataFrame, radix: int) -> DataFrame:
    """As ``_looked_up``, with the counts as a table of any size in a join."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").to_pylist()
                text, pair, times = aligner.pairs_of(texts)
                total, hashes = aligner.figures_of(texts)
                at = pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(total[:, i]) for i in range(4)],
                     pa.array(hashes, pa.string()), pa.ListArray.from_arrays(at, pa.array(pair)),
                     pa.ListArray.from_arrays(at, pa.array(times))],
                    names=[*_NAMES[:5], "groups_sha256", "pairs", "times"])

    aligned = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        task, "doc_id long, n_a long, n_b long, n_groups long, n_links long, "
              "groups_sha256 string, pairs array<long>, times array<long>")
    aligned = stage_table(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    first = F.floor(F.col("pair") / radix)
    best = counts.groupBy(first.alias("a")).agg(F.max("n").alias("best"))
    ranked = counts.withColumn("a", first).join(best, "a").select("pair", "n", "best")
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select(
        "row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    sums = links.join(ranked, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("times")).alias("count_sum"))
    return aligned.drop("pairs", "times").join(sums, "row", "left").fillna(
        0, ["n_best", "count_sum"]).select(*_NAMES)


def align(docs: DataFrame, path_a: str, path_b: str, sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """Both tokenizers' tokens of each text, aligned; see ``DIGESTS``.

    A null, empty or not faithfully tokenised text has no tokens: zeros and an empty string. A null
    id stays null; rows that repeat an id are documents of their own. Whole texts of any length are
    read, other columns are not. An empty table gives no rows. ``path_a`` is a byte-level tokenizer
    file, ``path_b`` a piece model that prefixes a blank and changes nothing else; others are an
    error. Both must be readable on every executor. ``sent_pairs`` bounds the table of counts that
    every task receives.
    """
    partials = stage_table(_documents_holding(docs, path_a, path_b), "pair_counts")
    pairs = stage_table(partials.select("pair").distinct(), "pairs")
    found = pairs.count()
    if not found or found > sent_pairs:
        counts = partials.groupBy("pair").agg(F.sum("n").alias("n"))
        return _joined(docs, path_a, path_b, counts, TokenPair(path_a, path_b).radix)
    segments = -(-found // SEGMENT)
    hashes = stage_table(_hashes(pairs, segments), "hashes")
    table = hashes.join(_dense(partials, hashes, segments), "segment")
    return _looked_up(docs, path_a, path_b, stage_table(table, "dense_counts"), segments)
