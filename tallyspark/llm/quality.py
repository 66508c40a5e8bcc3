"""Quality rules: counts per document, and how far its histograms lie from those of a language.

References are histograms over all documents of a language: of character classes, and of the
language's most common short words with one bin for all other words. A document is compared to
each reference by Jensen-Shannon distance (base 2, 0 to 1) and judged by the nearest, for each of
the two histograms that it is long enough for.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.batches import (
    LOWER, code_points, flat, mix, per_text, slices, span_hashes, window_hashes, word_spans,
)

SYMBOLS = b"#*$%&|<>"
#: Character classes: small letter, capital, digit, blank, line break, stop, other mark, symbol,
#: letter beyond ASCII, other.
CLASSES = 10
WINDOW = 5
SHORT = 8


def _class_table() -> np.ndarray:
    out = np.full(256, 9, dtype=np.uint8)
    for i, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                               b"0123456789", b" \t", b"\n\r", b".,", b";:!?'\"()-", SYMBOLS)):
        out[list(chars)] = i
    out[0xC3:0xE0] = 8
    return out


_CLASS = _class_table()
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_STOP = np.isin(np.arange(256), list(b".,;:!?"))


def short_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Each word in small letters without a closing mark, as a number; 0 where over eight bytes."""
    ends = ends - (_STOP[data[ends - 1]] & (ends - starts > 1))
    size = ends - starts
    out = np.zeros(len(starts), dtype=np.uint64)
    for i in range(SHORT):
        has = np.flatnonzero((size > i) & (size <= SHORT))
        out[has] |= LOWER[data[starts[has] + i]].astype(np.uint64) << np.uint64(8 * i)
    return out


def class_counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points of each class in each text."""
    texts = len(at) - 1
    marks = code_points(data)
    owner = np.repeat(np.arange(texts), np.diff(at))[marks]
    return np.bincount(owner * CLASSES + _CLASS[data[marks]],
                       minlength=texts * CLASSES).reshape(texts, CLASSES)


@dataclass
class References:
    """Histograms of each language; ``words`` and ``word_counts`` have a row for each language, and
    the last count of a row is of all other words."""

    langs: list[str]
    classes: np.ndarray
    words: np.ndarray
    word_counts: np.ndarray


@dataclass(frozen=True)
class Limits:
    """When the method drops a document. A histogram of fewer counts than its guard is not judged."""

    class_distance: float = 0.33
    word_distance: float = 0.40
    min_chars: int = 200
    min_words: int = 40


def reference_counts(docs: DataFrame) -> DataFrame:
    """lang, kind (0: class, 1: short word), item, n over all documents with a language."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, at = flat(part.column("text"))
                langs = part.column("lang").dictionary_encode()
                code = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                starts, ends, doc = word_spans(data, at)
                words = short_words(data, starts, ends)
                classes = class_counts(data, at)
                for i, lang in enumerate(langs.dictionary.to_pylist()):
                    mine, n = np.unique(words[code[doc] == i], return_counts=True)
                    total = classes[code == i].sum(axis=0)
                    items = np.concatenate([np.arange(CLASSES), mine.view(np.int64)])
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(items), pa.string()),
                        pa.array([0] * CLASSES + [1] * len(mine), pa.int32()),
                        pa.array(items, pa.int64()),
                        pa.array(np.concatenate([total, n]), pa.int64()),
                    ], names=["lang", "kind", "item", "n"])

    return (docs.select("text", F.col("lang").cast("string")).filter("lang IS NOT NULL")
            .mapInArrow(task, "lang string, kind int, item long, n long")
            .groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")))


def references(docs: DataFrame, common: int = 50, max_langs: int = 256) -> References:
    """The references of the ``max_langs`` languages with the most text, ``common`` words each.

    What reaches the driver is bounded by these two numbers.
    """
    counts = reference_counts(docs)
    short = (F.col("kind") == 0) | (F.col("item") != 0)
    # Ranked within shares of the words first, so that no task ranks all words of a language.
    share = Window.partitionBy("lang", "kind", "share").orderBy(F.desc("weight"), "item")
    best = Window.partitionBy("lang", "kind").orderBy(F.desc("weight"), "item")
    top = (counts.withColumn("share", F.pmod(F.xxhash64("item"), F.lit(64)))
           .withColumn("weight", F.when(short, F.col("n")).otherwise(-1))
           .withColumn("item", F.when(F.row_number().over(share) <= common, F.col("item")))
           .withColumn("weight", F.when(F.col("item").isNotNull(), F.col("weight")).otherwise(-1))
           .groupBy("lang", "kind", "share", "item")
           .agg(F.sum("n").alias("n"), F.max("weight").alias("weight")))
    rows = (top.withColumn("total", F.sum("n").over(Window.partitionBy("lang", "kind")))
            .filter("item IS NOT NULL").withColumn("rank", F.row_number().over(best))
            .filter((F.col("weight") > 0) & (F.col("rank") <= common))
            .groupBy("lang").agg(F.collect_list(F.struct("kind", "item", "n", "total")).alias("r"),
                                 F.max("total").alias("size"))
            .orderBy(F.desc("size"), "lang").limit(max_langs).collect())
    classes = np.zeros((len(rows), CLASSES))
    words = np.zeros((len(rows), common), dtype=np.uint64)
    word_counts = np.zeros((len(rows), common + 1))
    for i, row in enumerate(rows):
        at = 0
        for r in sorted(row.r, key=lambda r: (-r.n, r.item or 0)):
            if r.kind == 0:
                classes[i, r.item] = r.n
            elif r.item:
                words[i, at], word_counts[i, at] = np.uint64(r.item & (2**64 - 1)), r.n
                at += 1
        total = next((r.total for r in row.r if r.kind == 1), 0)
        word_counts[i, -1] = total - word_counts[i].sum()
    return References([r.lang for r in rows], classes, words, word_counts)


def distances(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts to a histogram; 1 for an empty row."""
    p = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    q = (reference / max(reference.sum(), 1))[None, :]
    m = (p + q) / 2

    def entropy(x):
        return -(x * np.log2(np.where(x > 0, x, 1))).sum(axis=1)

    out = np.sqrt(np.clip(entropy(m) - (entropy(p) + entropy(q)) / 2, 0, 1))
    return np.where(counts.sum(axis=1) > 0, out, 1.0)


def _repeat_words(words: np.ndarray, doc: np.ndarray, texts: int) -> np.ndarray:
    """Words of each text that lie in a window of five words found more than once in that text."""
    hashes = window_hashes(words, WINDOW)
    whole = doc[:len(hashes)] == doc[WINDOW - 1:] if len(hashes) else np.zeros(0, dtype=bool)
    where = np.flatnonzero(whole)
    keys = hashes[where] ^ mix(doc[where].astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    cover[where[twice]] += 1
    np.subtract.at(cover, where[twice] + WINDOW, 1)
    return np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=texts)


def _dup_lines(data: np.ndarray, at: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Lines of each text that hold a word and equal an earlier line of it."""
    texts = len(at) - 1
    breaks = np.flatnonzero(data == 10)
    heads = np.sort(np.concatenate([at[:-1], breaks + 1]), kind="stable")
    owner = np.searchsorted(at, heads, side="right") - 1
    tails = np.sort(np.concatenate([at[1:], breaks]), kind="stable")
    filled = np.searchsorted(starts, tails) > np.searchsorted(starts, heads)
    heads, tails, owner = heads[filled], tails[filled], owner[filled]
    keys = span_hashes(data, heads, tails) ^ mix(owner.astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys, kind="stable")
    repeat = order[1:][keys[order][1:] == keys[order][:-1]]
    return np.bincount(owner[repeat], minlength=texts)


OUTPUT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, class_distance double, "
          "word_distance double")


def _judge(part: pa.RecordBatch, refs: References, limits: Limits) -> pa.RecordBatch:
    data, at = flat(part.column("text"))
    texts = len(at) - 1
    starts, ends, doc = word_spans(data, at)
    n_words = np.bincount(doc, minlength=texts)
    marks = code_points(data)
    space = np.isin(data, (9, 10, 11, 12, 13, 32))
    word_chars = per_text(marks & ~space, at)
    n_symbols = per_text(_SYMBOL[data], at)
    n_dup = _dup_lines(data, at, starts)
    n_repeat = _repeat_words(span_hashes(data, starts, ends), doc, texts)
    failed = (n_words < 10) | (100 * n_repeat > 20 * n_words)

    classes = class_counts(data, at)
    words = short_words(data, starts, ends)
    near_class = np.ones(texts)
    near_words = np.ones(texts)
    for i in range(len(refs.langs)):
        near_class = np.minimum(near_class, distances(classes, refs.classes[i]))
        order = np.argsort(refs.words[i])
        place = np.searchsorted(refs.words[i][order], words).clip(max=len(order) - 1)
        column = np.where((refs.words[i][order][place] == words) & (words > 0),
                          order[place], len(order))
        width = len(order) + 1
        counts = np.bincount(doc * width + column, minlength=texts * width).reshape(texts, width)
        near_words = np.minimum(near_words, distances(counts, refs.word_counts[i]))
    chars = classes.sum(axis=1)
    bad = np.zeros(texts, dtype=bool)
    if refs.langs:
        bad |= (chars >= limits.min_chars) & (near_class > limits.class_distance)
        bad |= (n_words >= limits.min_words) & (near_words > limits.word_distance)
    columns = [n_words, word_chars, n_symbols, n_dup, n_repeat]
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id")] + [pa.array(c.astype(np.int64)) for c in columns]
        + [pa.array(failed), pa.array(~failed & ~bad), pa.array(near_class), pa.array(near_words)],
        names=[c.split()[0] for c in OUTPUT.split(", ")])


def judge(docs: DataFrame, refs: References | None = None, limits: Limits = Limits()) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, lang): see ``OUTPUT``.

    Without ``refs`` the references are made from ``docs`` itself. ``base_failed`` is true under
    ten words or where over a fifth of the words repeat; ``kept`` also needs the nearest reference
    of either histogram within its limit.

    A null or empty text has no words and fails. A null language takes no part in the references;
    without any reference no document is judged by distance. A null id stays null, repeated rows
    are judged each on its own, texts are read whole. Other columns are not read.
    """
    refs = refs or references(docs)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield _judge(part, refs, limits)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, OUTPUT)
