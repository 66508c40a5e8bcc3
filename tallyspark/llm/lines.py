"""Fuzzy line dedup: MinHash over character shingles, exact Jaccard, one line kept per component."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.batches import (
    code_points, flat, mix, slices, span_hashes, visible, window_hashes,
)
from tallyspark.llm.candidates import (
    in_blocks, small_enough, unresolved, with_component,
)
from tallyspark.llm.components import components
from tallyspark.session import stage_table

#: Characters of a shingle; small and capital A-Z count as the same. Shingles reach over both ends
#: of a line, so that an edit costs the same everywhere: one substitution in a line of n characters
#: leaves n - 1 of n + 7 shingles.
SHINGLE = 4
#: A line goes to this many groups, one for each of its first pairs of minima.
TABLES = 9
#: Minima of a line, of which half a byte each is kept to compare the lines of a group.
MINIMA = 64
#: Lines of a group are candidates if one of so many bands of so many minima is the same in both,
#: and so many minima in all. Each of the tables has bands of its own.
BANDS = 20
BAND = 5
LEAST = 38
#: Candidates of up to so many lines are compared by their sketches pair by pair; of more, each
#: meets one of the first so many leaders.
SMALL, LEADERS = 2048, 16
#: Lines that agree in so many minima are taken to be joined, unless their part shows less.
SAFE = 60
#: Pairs that are compared at a time.
PAIRS = 1 << 20
#: Sketches in a block, where those of large buckets are compared in full.
FULL = 1 << 10
#: Shingles that are hashed at a time.
BLOCK = 1 << 16
#: Bytes of sketches that a task holds before it deals them, and that are read at a time.
DEALT_BYTES = 8 << 20
READ_BYTES = 4 << 20
#: Every line with a character other than blanks counts, whatever its length.
MIN_BYTES = 1

_FACTORS = (mix(np.arange(1, MINIMA + 1, dtype=np.uint64)) >> np.uint64(32)).astype(
    np.uint32) | np.uint32(1)
_PLACES = (mix(np.arange(1001, 1001 + SHINGLE, dtype=np.uint64)) >> np.uint64(32)).astype(
    np.uint32) | np.uint32(1)
#: The minima of each band of each table: none of those by which the table has dealt.
_CHOICE = np.array([[[m for m in np.argsort(mix(np.arange(MINIMA, dtype=np.uint64) + np.uint64(
    MINIMA * (1 + t * BANDS + i)))) if m // 2 != t][:BAND] for i in range(BANDS)]
    for t in range(TABLES)])
#: A sketch as it is dealt: the group (its remainder by ``TABLES`` is the table), the node (a hash)
#: and half a byte of each of the minima.
_SKETCH = np.dtype([("group", "<u4"), ("node", "<u8"), ("minima", "u1", (MINIMA // 2,))])


def line_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every line, and the text it belongs to; a text has a line more than
    breaks."""
    breaks = np.flatnonzero(data == 10)
    owner = np.searchsorted(at, breaks, side="right") - 1
    texts = np.arange(len(at) - 1)
    heads = np.concatenate([at[:-1], breaks + 1])
    tails = np.concatenate([at[1:], breaks])
    by_head = np.lexsort((heads, np.concatenate([texts, owner])))
    by_tail = np.lexsort((tails, np.concatenate([texts, owner])))
    return heads[by_head], tails[by_tail], np.concatenate([texts, owner])[by_head]


def _padded(data: np.ndarray, starts: np.ndarray,
            ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The characters of each line between its ends, in sequence; where each line begins there;
    and how many shingles it has. The spans are in order and not empty."""
    chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
    chars = np.where((chars >= 65) & (chars <= 90), chars + np.uint32(32), chars)
    first, last, edge = starts, ends, SHINGLE - 1
    if len(chars) < len(data):
        heads = np.flatnonzero(code_points(data))
        first, last = np.searchsorted(heads, starts), np.searchsorted(heads, ends)
    sizes = last - first
    wide = sizes + 2 * edge
    head = np.cumsum(wide) - wide
    at = np.repeat(first - edge - head, wide)
    at += np.arange(len(at))
    padded = chars.take(at, mode="clip")
    for i in range(edge):
        padded[head + i] = 10
        padded[head + edge + sizes + i] = 10
    return padded, head, sizes + edge


def _whole(size: int, head: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which windows of ``size`` characters lie in one line."""
    whole = np.ones(size, dtype=bool)
    for i in range(SHINGLE - 1):
        whole[head + sizes + i] = False
    return whole[:size - SHINGLE + 1]


def shingle_hashes(data: np.ndarray, starts: np.ndarray,
                   ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every shingle of each line, line by line, and how many each line has. The spans
    are in order and not empty."""
    padded, head, sizes = _padded(data, starts, ends)
    return window_hashes(padded.astype(np.uint64), SHINGLE)[
        _whole(len(padded), head, sizes)], sizes


def _scrambled(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 32-bit numbers."""
    x = x * np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA77)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE3D)
    x ^= x >> np.uint32(16)
    return x


def signatures(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The minima of each line's shingles (rows) under every permutation (columns). Lines are in
    order, not empty."""
    padded, head, sizes = _padded(data, starts, ends)
    stops = np.append(head[1:], len(padded))
    least = np.empty((len(_FACTORS), len(starts)), dtype=np.uint32)
    done = 0
    while done < len(starts):
        # Some lines at a time, whose values stay in the processor's cache.
        stop = max(done + 1, int(np.searchsorted(stops, head[done] + BLOCK)))
        chars = _scrambled(padded[head[done]:stops[stop - 1]])
        windows = len(chars) - SHINGLE + 1
        values = chars[:windows] * _PLACES[0]
        for i in range(1, SHINGLE):
            values += chars[i:i + windows] * _PLACES[i]
        here = head[done:stop] - head[done]
        values = _scrambled(values[_whole(len(chars), here, sizes[done:stop])])
        here = np.cumsum(sizes[done:stop]) - sizes[done:stop]
        scaled = np.empty_like(values)
        for j, factor in enumerate(_FACTORS):
            np.minimum.reduceat(np.multiply(values, factor, out=scaled), here,
                                out=least[j, done:stop])
        done = stop
    return least.T


def sketched(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The sketches of each different line of the spans, one for each group it goes to."""
    nodes, some = np.unique(span_hashes(data, starts, ends), return_index=True)
    order = np.argsort(some)
    nodes, some = nodes[order], some[order]
    least = signatures(data, starts[some], ends[some])
    out = np.empty((TABLES, len(some)), dtype=_SKETCH)
    out["node"] = nodes
    half = (_scrambled(least) >> np.uint32(28)).astype(np.uint8)
    out["minima"] = half[:, ::2] | half[:, 1::2] << 4
    for t in range(TABLES):
        pair = least[:, 2 * t].astype(np.uint64) << np.uint64(32) | least[:, 2 * t + 1]
        group = mix(pair) >> np.uint64(32)
        out[t]["group"] = group - group % np.uint64(TABLES) + np.uint64(t)
    return out.reshape(-1)


def _text_hash(texts: pa.Array) -> pa.Array:
    data, at = flat(texts)
    filled = np.flatnonzero(np.diff(at))
    out = np.zeros(len(texts), dtype=np.uint64)
    out[filled] = span_hashes(data, at[filled], at[filled + 1])
    return out.view(np.int64)


def _line_starts(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """The bytes of a batch's texts, and start, end, text and number of each line with a character
    other than blanks."""
    data, at = flat(part.column("text"))
    starts, ends, owner = line_spans(data, at)
    number = np.arange(len(owner)) - np.searchsorted(owner, owner)
    some = np.flatnonzero(ends > starts)
    shown = np.logical_or.reduceat(np.append(visible(data), False), np.stack(
        [starts[some], ends[some]], axis=1).reshape(-1))[::2] if len(some) else np.zeros(0, bool)
    some = some[shown]
    return data, starts[some], ends[some], owner[some], number[some]


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, h (a hash of the text), line, node (a hash of the line): one row for each line with
    a character other than blanks."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, starts, ends, owner, number = _line_starts(part)
                if not len(starts):
                    continue
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(owner)),
                    pa.array(_text_hash(part.column("text"))[owner]),
                    pa.array(number, pa.int32()),
                    pa.array(span_hashes(data, starts, ends).view(np.int64)),
                ], names=["doc_id", "h", "line", "node"])

    return docs.mapInArrow(task, "doc_id long, h long, line int, node long")


def _dealt(docs: DataFrame, parts: int) -> DataFrame:
    """part, sketches: the sketches of all lines, dealt by their groups into ``parts``; a row holds
    many of one part."""
    def deal(held: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(held)
        part = mix(rows["group"].astype(np.uint64)) % np.uint64(parts)
        rows = rows[np.argsort(part, kind="stable")]
        numbers, counts = np.unique(part, return_counts=True)
        cuts = np.split(rows, np.cumsum(counts)[:-1])
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers.astype(np.int32)), pa.array([c.tobytes() for c in cuts],
                                                          pa.binary())],
            names=["part", "sketches"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for part in slices(batch):
                data, starts, ends, _, _ = _line_starts(part)
                if len(starts):
                    held.append(sketched(data, starts, ends))
                if sum(x.nbytes for x in held) >= DEALT_BYTES:
                    yield deal(held)
                    held.clear()
        if held:
            yield deal(held)

    return docs.select("text").mapInArrow(task, "part int, sketches binary")


_ONES = np.uint64(0x1111111111111111)


def _agree(minima: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """In how many minima rows i and j agree."""
    words = minima.view("<u8")
    out = np.empty(len(i), dtype=np.int64)
    for k in range(0, len(i), BLOCK):
        unlike = words[i[k:k + BLOCK]] ^ words[j[k:k + BLOCK]]
        unlike |= unlike >> np.uint64(2)
        unlike |= unlike >> np.uint64(1)
        out[k:k + BLOCK] = MINIMA - np.bitwise_count(unlike & _ONES).sum(axis=1)
    return out


def _forest(i: np.ndarray, j: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the pairs (i, j) make a spanning forest of greatest weight, and which of them are
    needed: those of the forest, and those not joined by its links of ``SAFE`` and more."""
    at, root = np.unique(np.concatenate([i, j]), return_inverse=True)
    parent = list(range(len(at)))
    chosen = np.zeros(len(i), dtype=bool)

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def join(pairs: np.ndarray) -> None:
        for n, x, y in zip(pairs.tolist(), root[:len(i)][pairs].tolist(),
                           root[len(i):][pairs].tolist()):
            x, y = top(x), top(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
                chosen[n] = True

    order = np.argsort(-weight, kind="stable")
    safe = int(np.count_nonzero(weight >= SAFE))
    join(order[:safe])
    joined = np.array([top(x) for x in range(len(at))], dtype=np.int64)
    apart = joined[root[:len(i)]] != joined[root[len(i):]] if len(i) else chosen.copy()
    join(order[safe:][apart[order[safe:]]])
    return chosen, chosen | apart


def _band_keys(group: np.ndarray, minima: np.ndarray, low: int) -> Iterator[tuple]:
    """For each table and band: the rows of the table, and their keys above ``low`` free bits, alike
    where the group and the band's minima are. Groups are in order."""
    table = group % TABLES
    number = np.cumsum(np.append(False, group[1:] != group[:-1])[:len(group)]).astype(np.uint64)
    for t in range(TABLES):
        rows = np.flatnonzero(table == t)
        if not len(rows):
            continue
        own = np.ascontiguousarray(minima[rows].T)
        high = number[rows] << np.uint64(4 * BAND + low)
        for band in _CHOICE[t]:
            word = np.zeros(len(rows), dtype=np.uint32)
            for m in band.tolist():
                word <<= np.uint32(4)
                word |= own[m // 2] >> 4 * (m % 2) & 15
            yield rows, high | word.astype(np.uint64) << np.uint64(low)


def _counted(sizes: np.ndarray) -> np.ndarray:
    """0, 1, 2 and so on up to each size, one run after the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def alike_sketches(rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """The candidate pairs among sketches that are needed (a, b, and whether they are of a spanning
    forest of the most alike), and the members of buckets with more than ``SMALL`` of them (bucket, node).

    Members of such a bucket meet leaders alone: a leader is the first member that agrees with no
    leader before it. ``unresolved`` finds what that may leave open."""
    rows = rows[np.lexsort((rows["node"], rows["group"]))]
    group, node = rows["group"].copy(), rows["node"].copy()
    same = group[1:] == group[:-1]
    fresh = np.append(True, ~same | (node[1:] != node[:-1]))[:len(rows)]
    rows, group = rows[fresh], group[fresh]
    # A group of one line has no pair.
    same = group[1:] == group[:-1]
    several = (np.append(same, False) | np.append(False, same))[:len(rows)]
    rows, group = rows[several], group[several]
    node, minima = rows["node"].copy(), np.ascontiguousarray(rows["minima"])
    # The place of a row stands in the low bits of its key, so that keys alone are sorted.
    bits = np.uint64(len(rows).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    width = max(len(rows), 1)
    codes, known, members = [np.zeros(0, np.int64)], set(), []
    for places, key in _band_keys(group, minima, int(bits)):
        key |= places.astype(np.uint64)
        key.sort()
        same = np.append(key[1:] >> bits == key[:-1] >> bits, False)
        before = np.append(False, same[:-1])
        starts = np.flatnonzero(same & ~before)
        sizes = np.flatnonzero(before & ~same) - starts + 1
        order = (key & low).astype(np.int64)
        few = sizes <= SMALL
        # Each member of a small bucket meets those before it.
        at, place = np.repeat(starts[few], sizes[few]), _counted(sizes[few])
        ends, left, right = np.cumsum(place), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for cut in np.split(np.arange(len(at)), np.searchsorted(
                ends, np.arange(PAIRS, ends[-1], PAIRS)) if len(at) else []):
            i = order[np.repeat(at[cut], place[cut]) + _counted(place[cut])]
            j = order[np.repeat(at[cut] + place[cut], place[cut])]
            on = _agree(minima, i, j) >= LEAST
            left.append(i[on])
            right.append(j[on])
        for start, size in zip(starts[~few], sizes[~few]):
            here = np.sort(order[start:start + size])
            bucket = int(mix(node[here]).sum())
            if bucket in known:
                continue
            known.add(bucket)
            members.append((np.full(size, bucket, dtype=np.uint64), here))
            for _ in range(LEADERS):
                alike = _agree(minima, np.full(len(here), here[0]), here) >= LEAST
                left.append(np.full(int(alike.sum()), here[0]))
                right.append(here[alike])
                here = here[~alike]
                if not len(here):
                    break
        i, j = np.concatenate(left), np.concatenate(right)
        codes.append((np.minimum(i, j) * width + np.maximum(i, j))[i != j])
        if sum(len(x) for x in codes) > 4 * PAIRS + 2 * len(codes[0]):
            codes = [np.unique(np.concatenate(codes))]
    pair = np.unique(np.concatenate(codes))
    i, j = pair // width, pair % width
    weight, a, b = _agree(minima, i, j), node[i].view(np.int64), node[j].view(np.int64)
    a, b = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((b, a))
    a, b, weight = a[order], b[order], weight[order]
    fresh = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[:len(a)]
    a, b, weight = a[fresh], b[fresh], weight[fresh]
    none = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    bucket, member = (np.concatenate(x) for x in zip(*none + members))
    first, needed = _forest(a, b, weight)
    return (a[needed], b[needed], first[needed], bucket.view(np.int64),
            node[member].view(np.int64))


def candidates(docs: DataFrame, count: int) -> tuple[DataFrame, DataFrame]:
    """a, b, first: candidate pairs of nodes, and whether one part has them in its forest; and
    bucket, key, items: the members of large buckets and their sketches. There are about ``count``
    lines."""
    def task(table):
        rows = np.frombuffer(b"".join(table.column("sketches").to_pylist()), dtype=_SKETCH)
        a, b, first, bucket, member = alike_sketches(rows)
        items = pa.nulls(len(a) + len(member), pa.binary())
        if len(member):
            nodes, at = np.unique(rows["node"].view(np.int64), return_index=True)
            items = pa.array([None] * len(a) + [
                x.tobytes() for x in rows["minima"][at[np.searchsorted(nodes, member)]]],
                pa.binary())
        return pa.table({
            "a": np.append(a, bucket), "b": np.append(b, member),
            "first": pa.array(np.append(first, np.zeros(len(member), bool)), pa.bool_()),
            "items": items})

    parts = 1 + count * TABLES * _SKETCH.itemsize // READ_BYTES
    found = stage_table(_dealt(docs, parts).groupBy("part").applyInArrow(
        task, "a long, b long, first boolean, items binary"), "candidates")
    large = found.filter("items IS NOT NULL").select(
        F.col("a").alias("bucket"), F.col("b").alias("key"), "items")
    pairs = found.filter("items IS NULL").groupBy("a", "b").agg(F.max("first").alias("first"))
    return pairs, large.distinct()


def candidates_within(sketches: DataFrame, cluster: DataFrame, joined: DataFrame) -> DataFrame:
    """a, b: every two of ``sketches`` (key, items) of one bucket (key, cluster) that are candidates and
    not joined yet (node, component). Each two blocks of a bucket meet in a task."""
    def task(table):
        if not table.num_rows:
            return table.select(["key", "key"]).rename_columns(["a", "b"])
        key, component, own = (table.column(c).to_numpy() for c in ("key", "component", "own"))
        minima = np.frombuffer(b"".join(table.column("items").to_pylist()), np.uint8).reshape(
            -1, MINIMA // 2)
        left = np.flatnonzero(own == table.column("low")[0].as_py())
        right = np.flatnonzero(own == table.column("high")[0].as_py())
        out = [np.zeros((2, 0), np.int64)]
        for i in left.tolist():
            apart = right[component[right] != component[i]]
            j = apart[_agree(minima, np.full(len(apart), i), apart) >= LEAST]
            out.append(np.sort(np.stack([np.full(len(j), key[i]), key[j]]), axis=0))
        one, two = np.concatenate(out, axis=1)
        return pa.table({"a": one, "b": two})

    return in_blocks(sketches, cluster, joined, FULL).groupBy("cluster", "low", "high").applyInArrow(
        task, "a long, b long").distinct()


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, text of the lines in ``wanted`` (key, doc_id, h, line: where each can be read)."""
    places = stage_table(wanted.groupBy("doc_id", "h").agg(
        F.collect_list("line").alias("lines"), F.collect_list("key").alias("keys")), "places")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                keys, found = [], []
                for text, numbers, nodes, right in zip(
                        part.column("text").to_pylist(), part.column("lines").to_pylist(),
                        part.column("keys").to_pylist(),
                        part.column("h").to_numpy() == _text_hash(part.column("text"))):
                    if right:
                        cut = (text or "").split("\n")
                        keys += nodes
                        found += [cut[i] for i in numbers]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(found, pa.string())],
                    names=["key", "text"])

    ids = places.withColumnRenamed("doc_id", "id")
    near = docs.join(small_enough(ids), docs["doc_id"].eqNullSafe(ids["id"]))
    found = stage_table(near.select("text", "h", "lines", "keys").mapInArrow(
        task, "key long, text string"), "texts")
    # Only rows with the same id and text give a line more than once.
    if found.groupBy("key").count().filter("count > 1").isEmpty():
        return found
    return stage_table(found.dropDuplicates(["key"]), "texts")


_SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(line: str) -> set[str]:
    edge = "\n" * (SHINGLE - 1)
    text = edge + line.translate(_SMALL) + edge
    return {text[i:i + SHINGLE] for i in range(len(line) + SHINGLE - 1)}


def _shingle_codes(line: str) -> np.ndarray | None:
    """The line's shingles as numbers in order, each once; none if a character takes over 16 bits."""
    edge = "\n" * (SHINGLE - 1)
    chars = np.frombuffer(f"{edge}{line}{edge}".encode("utf-32-le"), dtype="<u4")
    if chars.max() > 0xFFFF:
        return None
    codes = np.where((chars >= 65) & (chars <= 90), chars + np.uint32(32), chars).astype(np.uint64)
    pairs = codes[:-1] << np.uint64(16) | codes[1:]
    codes = pairs[:-2] << np.uint64(32) | pairs[2:]
    codes.sort()
    return codes[np.append(True, codes[1:] != codes[:-1])]


def _shared(one: str, two: str, known: dict[str, np.ndarray | None]) -> tuple[int, int]:
    """How many shingles two lines share, and how many they have in all."""
    for x in (one, two):
        if x not in known:
            known[x] = _shingle_codes(x)
    left, right = known[one], known[two]
    if left is None or right is None:
        left, right = shingles(one), shingles(two)
        return len(left & right), len(left | right)
    codes = np.concatenate([left, right])
    codes.sort()
    both = int(np.count_nonzero(codes[1:] == codes[:-1]))
    return both, len(codes) - both


def _alike(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` whose lines' sets of shingles are alike."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str, np.ndarray | None] = {}
            keep = []
            for one, two in zip(batch.column("text_a").to_pylist(),
                                batch.column("text_b").to_pylist()):
                if len(known) > 2_000:
                    known.clear()
                both, either = _shared(one, two, known)
                keep.append(100 * both >= percent * either)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = (texts.select(F.col("key").alias(k), F.col("text").alias(f"text_{k}"))
                   for k in "ab")
    return pairs.join(left, "a").join(right, "b").mapInArrow(task, "a long, b long")


def duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, h, line of every line to be removed; see ``dedup_lines``."""
    found = stage_table(lines(docs), "lines")
    place = F.struct("doc_id", "h", "line")
    pairs, large = candidates(docs, found.count())
    pairs = stage_table(pairs, "pairs")

    def texts_of(nodes: DataFrame) -> DataFrame:
        at = found.join(small_enough(nodes), "node", "left_semi").groupBy(
            F.col("node").alias("key")).agg(F.min(place).alias("place"))
        return _texts(docs, at.select("key", "place.*"))

    def texts_of_ends(some: DataFrame) -> DataFrame:
        ends = some.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        return texts_of(stage_table(ends, "ends"))

    texts = texts_of_ends(pairs)
    links = stage_table(_alike(pairs.filter("first").select("a", "b"), texts, percent), "links")
    joined = stage_table(components(links), "components")
    # Pairs that the forest's links have joined already can add nothing.
    apart = pairs.filter("NOT first")
    for end in ("a", "b"):
        apart = apart.join(small_enough(joined.select(
            F.col("node").alias(end), F.col("component").alias(f"of_{end}"))), end, "left")
    apart = stage_table(apart.filter(F.coalesce("of_a", "a") != F.coalesce("of_b", "b"))
                        .select("a", "b"), "pairs")
    more = stage_table(_alike(apart, texts, percent), "links")
    if not more.isEmpty():
        links = links.unionByName(more)
        joined = stage_table(components(links), "components")
    left = stage_table(unresolved(with_component(large.drop("items"), joined)), "unresolved")
    if not left.isEmpty():
        sketches = large.select("key", "items").join(
            small_enough(left.select("key").distinct()), "key", "left_semi").distinct()
        # What was compared before is not compared again.
        near = candidates_within(sketches, left.withColumnRenamed("bucket", "cluster"),
                                 joined).join(pairs, ["a", "b"], "left_anti")
        near = stage_table(near, "pairs")
        more = stage_table(_alike(near, texts_of_ends(near), percent), "links")
        if not more.isEmpty():
            joined = stage_table(components(links.unionByName(more)), "components")
    of_line = found.join(small_enough(joined), "node", "left").select(
        "doc_id", "h", "line", F.coalesce("component", "node").alias("component"))
    several = stage_table(of_line.groupBy("component").count().filter("count > 1").select(
        "component"), "several")
    of_line = stage_table(of_line.join(small_enough(several), "component"), "repeated")
    first = stage_table(of_line.groupBy("component").agg(F.min(place).alias("first")), "first")
    return of_line.join(small_enough(first), "component").filter(place != F.col("first")).select(
        "doc_id", "h", "line")


def dedup_lines(docs: DataFrame, percent: int = 75) -> DataFrame:
    """``docs`` with every line removed that repeats an earlier one, exactly or nearly.

    Lines are alike if the Jaccard similarity of their sets of shingles of four characters (small
    letters, the ends of the line included) is at least ``percent`` per cent; of all lines that
    links join, the one of the least doc_id and line stays. One substituted character anywhere is
    within 75 % from 25 characters on, an inserted or lost one from 21; shorter lines are alike if
    they are equal but for capitals, or nearly so by repeated characters. Candidates share one of
    nine pairs of minima, one of that pair's twenty bands of five others, and 38 of 64 in all, the
    last two by half a byte each: two lines right at the limit are missed with a probability of
    about 0.002, at 0.8 with 2e-4. Lines of blanks alone stay. Very long lines over a handful of letters
    have nearly all shingles of these letters in common, whatever their order. Adds
    n_lines and n_removed (replacing columns of these names).

    A null text stays null with no lines, an empty one has one line. A null id comes first. Rows
    with the same id and text are one document: what goes from one goes from each. Long texts and
    lines are compared whole. A text that loses all its lines becomes empty.
    """
    names = [n for n in docs.columns if n not in ("n_lines", "n_removed")]
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    gone = duplicates(slim, percent).groupBy("doc_id", "h").agg(
        F.collect_list("line").alias("gone"))
    gone = stage_table(gone, "removed").select(
        F.col("doc_id").alias("__id"), F.col("h").alias("__h"), F.col("gone").alias("__gone"))
    # One row for each id, with what goes from each of its texts.
    gone = gone.groupBy("__id").agg(F.collect_list(F.struct("__h", "__gone")).alias("__gone"))
    fields = docs.select(*[F.col(f"`{n}`") for n in names]).schema.fields

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts, counts, removed = [], [], []
                for text, own, choices in zip(part.column("text").to_pylist(),
                                              _text_hash(part.column("text")).tolist(),
                                              part.column("__gone").to_pylist()):
                    cut = [] if text is None else text.split("\n")
                    drop = {i for c in choices or () if c["__h"] == own for i in c["__gone"]}
                    texts.append(None if text is None else "\n".join(
                        [x for i, x in enumerate(cut) if i not in drop]) if drop else text)
                    counts.append(len(cut))
                    removed.append(len(drop))
                columns = [pa.array(texts, pa.string()) if n == "text" else part.column(f"c{i}")
                           for i, n in enumerate(names)]
                yield pa.RecordBatch.from_arrays(
                    columns + [pa.array(counts, pa.int64()), pa.array(removed, pa.int64())],
                    names=names + ["n_lines", "n_removed"])

    out = T.StructType(fields + [T.StructField(n, T.LongType()) for n in ("n_lines", "n_removed")])
    joined = docs.join(small_enough(gone), docs["doc_id"].eqNullSafe(F.col("__id")), "left")
    # Python functions take no column whose name has a dot: names give way to places.
    return joined.select("text", "__gone", *[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(
        names) if n != "text"]).mapInArrow(task, out)
