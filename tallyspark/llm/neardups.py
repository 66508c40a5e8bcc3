"""Near-duplicate documents by SetSketch registers, with every link confirmed on the full sets.

A document is the set of its distinct shingles of five words. Each shingle is a Poisson process of
points, each at a time and in one register; a register keeps the earliest time of the set, on an
exponential scale and truncated to 16 bits, so that the registers of a union are the larger ones.
Documents that agree in a band of registers are candidates. Two documents' registers together give
the likelihood of their Jaccard similarity, which rejects the rest before sets are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.batches import (
    LOWER, flat, mix, slices, span_hashes, window_hashes, word_spans,
)
from tallyspark.llm.candidates import (
    alike_within, bucket_pairs, clusters, small_enough, unresolved, with_component,
)
from tallyspark.llm.components import components
from tallyspark.session import stage_table

WORDS = 5
REGISTERS = 160
BAND = 4
#: The registers' scale: values are steps of this factor in time, from an offset.
BASE = 1.001
OFFSET = 4000
#: A register stays empty with a probability of about exp(-REACH) for a whole document.
REACH = 7.0
#: Nats by which the similarity may fall behind the most likely one before a pair is rejected.
SLACK = 14.0

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts' distinct shingles, by text and then by value; how many each text has."""
    starts, ends, doc = word_spans(data, at)
    words = span_hashes(LOWER[data], starts, ends)
    texts = len(at) - 1
    count = np.bincount(doc, minlength=texts)
    hashes = window_hashes(words, WORDS)
    whole = doc[:len(hashes)] == doc[WORDS - 1:] if len(hashes) else np.zeros(0, dtype=bool)
    value, owner = hashes[whole], doc[:len(hashes)][whole]
    first = np.cumsum(count) - count
    few = np.flatnonzero((count > 0) & (count < WORDS))
    if len(few):
        short = [window_hashes(words[first[i]:first[i] + count[i]], int(count[i]))[0] for i in few]
        value = np.append(value, np.asarray(short, dtype=np.uint64))
        owner = np.append(owner, few)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), dtype=bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[fresh], np.bincount(owner[fresh], minlength=texts)


def registers(value: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The registers of each set, as 16-bit numbers. Larger means earlier."""
    sets = len(sizes)
    earliest = np.full(sets * REGISTERS, np.inf)
    owner = np.repeat(np.arange(sets), sizes)
    until = (np.log(REGISTERS) + REACH) / np.maximum(sizes, 1)
    seed, time, limit = value, np.zeros(len(value)), until[owner]
    while len(seed):
        seed = mix(seed + _GOLD)
        time = time - np.log1p((seed >> np.uint64(11)) * -2.0 ** -53) / REGISTERS
        on = time <= limit
        seed, time, limit, owner = seed[on], time[on], limit[on], owner[on]
        place = (mix(seed ^ _GOLD) >> np.uint64(32)) * np.uint64(REGISTERS) >> np.uint64(32)
        np.minimum.at(earliest, owner * REGISTERS + place.astype(np.int64), time)
    with np.errstate(divide="ignore"):
        level = np.floor(1 - np.log(earliest) / np.log(BASE)) + OFFSET
    return np.clip(level, 0, 65535).astype("<u2").reshape(sets, REGISTERS)


def log_likelihood(up: np.ndarray, down: np.ndarray, n_a: np.ndarray, n_b: np.ndarray,
                   similarity: np.ndarray) -> np.ndarray:
    """Of each similarity (columns) for each pair (rows), from how many registers are larger in
    the first set and in the second, and the sets' sizes."""
    share = (n_a / (n_a + n_b))[:, None]
    most = np.minimum(share / (1 - share), (1 - share) / share)
    j = np.minimum(similarity[None, :], most)

    def chance(x):
        x = np.maximum(x, 1e-12)
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    more, less = chance(share - (1 - share) * j), chance(1 - share - share * j)
    same = np.maximum(1 - more - less, 1e-12)
    equal = REGISTERS - up - down
    return (up[:, None] * np.log(more) + down[:, None] * np.log(less)
            + equal[:, None] * np.log(same))


def plausible(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray,
              least: float) -> np.ndarray:
    """Whether a similarity of at least ``least`` is not ruled out by two sets' registers."""
    up, down = (a > b).sum(1), (a < b).sum(1)
    low = np.linspace(0, least, 31)[:-1]
    high = np.linspace(least, 1, 11)
    below = log_likelihood(up, down, n_a, n_b, low).max(1)
    above = log_likelihood(up, down, n_a, n_b, high).max(1)
    sizes = np.minimum(n_a, n_b) >= least * np.maximum(n_a, n_b) - 1e-9
    return sizes & (above >= below - SLACK)


def _keys(value: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """A 128-bit key of each set."""
    ends = np.append(0, np.cumsum(sizes))
    sums = []
    for salt in (np.uint64(1), np.uint64(0x5851F42D4C957F2D)):
        total = np.append(np.uint64(0), np.cumsum(mix(value + salt)))
        sums.append(total[ends[1:]] - total[ends[:-1]])
    sums[0] += mix(sizes.astype(np.uint64))
    return [a.tobytes() + b.tobytes() for a, b in zip(*sums)]


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, h (of the text), n, key, sketch of each row of doc_id, h, text; the key and sketch
    of an empty set are null."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                value, sizes = shingle_sets(*flat(part.column("text")))
                keys, rows = _keys(value, sizes), registers(value, sizes)
                some = sizes > 0
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("h"), pa.array(sizes),
                    pa.array([k if s else None for k, s in zip(keys, some)], pa.binary()),
                    pa.array([r.tobytes() if s else None for r, s in zip(rows, some)],
                             pa.binary()),
                ], names=["doc_id", "h", "n", "key", "sketch"])

    return docs.mapInArrow(task, "doc_id long, h long, n long, key binary, sketch binary")


def _sets(docs: DataFrame) -> DataFrame:
    """set, items of each row."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                value, sizes = shingle_sets(*flat(part.column("text")))
                offsets = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_keys(value, sizes), pa.binary()),
                     pa.ListArray.from_arrays(offsets, pa.array(value.view(np.int64)))],
                    names=["set", "items"])

    return docs.select("text").mapInArrow(task, "set binary, items array<long>")


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, items of the sets in ``wanted`` (key, set, doc_id of a document that has it)."""
    ids = wanted.select(F.col("doc_id").alias("id")).distinct()
    texts = docs.join(small_enough(ids), docs["doc_id"].eqNullSafe(ids["id"]), "left_semi")
    named = wanted.select("key", "set")
    return _sets(texts).join(small_enough(named), "set").select("key", "items").dropDuplicates(
        ["key"])


def _linked(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` whose registers do not rule them out and whose full sets are alike."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = [np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u2").reshape(
                    -1, REGISTERS).astype(np.int32) for c in ("sketch_a", "sketch_b")]
                n_a, n_b = [batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b")]
                yield batch.filter(pa.array(plausible(a, b, n_a, n_b, percent / 100))).select(
                    ["a", "b"])

    def side(name):
        return nodes.select(F.col("key").alias(name), F.col("n").alias(f"n_{name}"),
                            F.col("sketch").alias(f"sketch_{name}"))

    near = stage_table(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(
        task, "a long, b long"), "plausible")
    ends = near.select(F.col("a").alias("key")).unionByName(near.select(F.col("b").alias("key")))
    named = nodes.select("key", "set", "doc_id").join(ends.distinct(), "key", "left_semi")
    sets = stage_table(sets_of(docs, named), "sets")
    left, right = [sets.select(F.col("key").alias(k), F.col("items").alias(f"items_{k}"))
                   for k in ("a", "b")]
    both = F.size(F.array_intersect("items_a", "items_b"))
    return near.join(left, "a").join(right, "b").filter(
        100 * both >= percent * (F.size("items_a") + F.size("items_b") - both)).select("a", "b")


def groups(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, h (a hash of the text), n, component, component_id of each row of ``docs``; see
    ``near_duplicates``. The component of an empty set is null. Two groups can have the same
    component_id, if an id comes with several texts, but not the same component."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stage_table(sketches(docs.select("doc_id", F.xxhash64("text").alias("h"), "text")),
                       "sketches")
    nodes = stage_table(rows.filter("n > 0").groupBy(F.col("key").alias("set")).agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
        .withColumn("key", F.monotonically_increasing_id()), "nodes")

    def part(place: Column, length: int) -> Column:
        start = place % (2 * REGISTERS)
        return F.xxhash64(F.substring("sketch", start + 1, F.lit(length)))

    count = REGISTERS // BAND

    def banded(some: DataFrame) -> DataFrame:
        return some.withColumn("band", F.explode(F.sequence(
            F.lit(0), F.lit(count - 1)))).withColumn(
                "bucket", F.xxhash64("band", part(F.col("band") * 2 * BAND, 2 * BAND)))

    bands = banded(nodes.select("key", "sketch")).select(
        "key", "bucket", part((F.col("band") + 1) * 2 * BAND, 2).alias("next_one"),
        part((F.col("band") + 2) * 2 * BAND, 2).alias("next_two"))
    links = stage_table(_linked(bucket_pairs(bands), nodes, docs, percent), "links")
    joined = stage_table(components(links), "components")

    left = stage_table(unresolved(banded(with_component(
        nodes.select("key", "sketch"), joined))), "unresolved")
    if not left.isEmpty():
        cluster = stage_table(clusters(left), "clusters")
        rest = stage_table(sets_of(docs, nodes.join(cluster, "key", "left_semi")), "sets")
        more = stage_table(alike_within(rest, cluster, joined, percent), "links")
        joined = stage_table(components(links.unionByName(more)), "components")

    of_node = nodes.join(joined, nodes["key"] == joined["node"], "left").select(
        "set", "doc_id", F.coalesce("component", "key").alias("component"))
    least = of_node.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = of_node.join(least, "component").select("set", "component", "component_id")
    out = rows.join(named, rows["key"] == named["set"], "left")
    return out.select("doc_id", "h", "n", "component", "component_id")


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row of ``docs`` (doc_id, text).

    Documents are linked if 100 times the shared shingles are at least ``percent`` times all of
    both; ``component_id`` is the least doc_id that links reach, and the document that has it is
    kept. Equal sets are one node, whatever their number. Candidates come from bands of registers:
    two documents right at the limit are missed with a probability of 3e-7. Where a bucket is too
    large for all its pairs and its members end up in several components, its sets are compared in
    full, block by block, which misses nothing.

    Under five words the whole sequence is one shingle. A text without words, empty or null has no
    shingles, is linked with nothing and kept. A null id counts as the largest: it is kept only in
    a component without any other id. Rows that repeat an id are kept or not together. Other
    columns are not read.
    """
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return groups(docs, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"))


def first_of_each(docs: DataFrame, percent: int = 75) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates.

    Each row is judged by its own text, also where an id is null or comes several times. Of a group
    the row of the least doc_id stays (a null one is the largest); of rows with this id, the one of
    the least hash of its text, and of rows equal in both the least by all columns. Rows without
    shingles all stay.
    """
    found = stage_table(groups(docs, percent).filter("n > 0").groupBy(
        "doc_id", "h", "component").agg(F.count("*").alias("copies")), "groups")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    first = found.groupBy("component").agg(F.min(place).alias("first"), F.count("*").alias(
        "size")).filter("size > 1").select("component", "first")
    judged = found.join(small_enough(stage_table(first, "first")), "component", "left").select(
        F.col("doc_id").alias("__id"), F.col("h").alias("__h"), "copies",
        F.coalesce(place != F.col("first"), F.lit(False)).alias("__goes"))
    marked = stage_table(judged.filter("__goes OR copies > 1").drop("copies"), "marked")
    rows = docs.join(small_enough(marked), docs["doc_id"].cast("long").eqNullSafe(F.col("__id"))
                     & (F.xxhash64(docs["text"]) == F.col("__h")), "left")
    columns = [F.col(f"`{n}`") for n in docs.columns]
    out = rows.filter("__goes IS NULL").select(*columns)
    if marked.filter("NOT __goes").isEmpty():
        return out
    repeated = rows.filter("NOT __goes").groupBy("__id", "__h").agg(
        F.min(F.struct(*columns)).alias("row"))
    return out.unionByName(repeated.select("row.*"))
