"""Quality scores by logistic regression on hashed word n-grams.

Tokens are runs of letters, digits and bytes beyond ASCII, and runs of other visible characters, as
written. Single tokens and pairs of neighbours are hashed into 2^BITS places; a token that follows its
like makes the same pair whatever it is, so that stuttering is learnt once for all words. A text is
the vector of 1 + log(count) at its places, of length one, with a constant beside it. The weights are
trained with follow-the-regularised-leader updates, which leave most of them at zero.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.batches import flat, slices, span_hashes, window_hashes
from tallyspark.session import stage_table

BITS = 20
#: The weights are learnt from about this many labelled texts, chosen by hash.
EXAMPLES = 8192
#: Updates of the weights, in rounds over all examples.
STEPS = 32_768
_AGAIN = np.uint64(0x5851F42D4C957F2D)

_CLASS = np.full(256, 2, dtype=np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
for _low, _high in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _CLASS[_low:_high] = 1

SCORES = "doc_id long, held_out boolean, score double, predicted int"


def _tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each token."""
    kind = _CLASS[data]
    cut = np.ones(len(data) + 1, dtype=bool)
    cut[1:-1] = kind[1:] != kind[:-1]
    cut[at] = True
    edges = np.flatnonzero(cut)
    starts, ends = edges[:-1], edges[1:]
    seen = kind[starts] > 0
    starts, ends = starts[seen], ends[seen]
    return starts, ends, np.searchsorted(at, starts, side="right") - 1


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place and value of each text's vector, by text and place; the constant is left out."""
    data, at = flat(column)
    starts, ends, text = _tokens(data, at)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    words = span_hashes(data, starts, ends)
    pairs = np.where(words[1:] == words[:-1], _AGAIN, window_hashes(words, 2))
    pairs = pairs[text[1:] == text[:-1]]
    owner = np.concatenate([text, text[1:][text[1:] == text[:-1]]])
    place = (np.concatenate([words, pairs]) >> np.uint64(64 - BITS)).astype(np.int64)
    key, count = np.unique(owner << BITS | place, return_counts=True)
    owner, place = key >> BITS, key & ((1 << BITS) - 1)
    value = 1 + np.log(count)
    norm = np.sqrt(np.bincount(owner, weights=value * value, minlength=len(at) - 1))
    return owner, place, value / norm[owner]


class Leader:
    """Weights by follow-the-regularised-leader; the last weight belongs to the constant."""

    def __init__(self, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, places: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[places], self.n[places]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) > self.l1, w, 0.0)

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(places)
        slope = (1 / (1 + np.exp(-np.clip(w @ values, -35, 35))) - label) * values
        n = self.n[places]
        rate = (np.sqrt(n + slope * slope) - np.sqrt(n)) / self.alpha
        self.z[places] += slope - rate * w
        self.n[places] = n + slope * slope


def _examples(docs: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """Distinct labelled texts as vectors: about ``size`` of them, by hash."""
    labels = stage_table(labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int")).distinct(), "labels")
    share = min(1.0, size / max(labels.count(), 1))

    def chosen(name: str, share: float) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(1 << 30)) < int(share * (1 << 30))

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(
        F.broadcast(labels.filter(chosen("id", share))), F.col("doc_id") == F.col("id")).select(
            "quality", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                owner, place, value = features(part.column("text"))
                cuts = np.searchsorted(owner, np.arange(1, part.num_rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column("digest"), part.column("quality"),
                     pa.array([p.astype("<i4").tobytes() for p in np.split(place, cuts)],
                              pa.binary()),
                     pa.array([v.astype("<f4").tobytes() for v in np.split(value, cuts)],
                              pa.binary())], names=["digest", "quality", "places", "values"])

    found = stage_table(texts.dropDuplicates(["digest", "quality"]).mapInArrow(
        vectors, "digest string, quality int, places binary, values binary"), "examples")
    # One id may stand for many texts, so what was found is counted again.
    return found.filter(chosen("digest", min(1.0, size / max(found.count(), 1))))


def fit(docs: DataFrame, labels: DataFrame, size: int = EXAMPLES, steps: int = STEPS) -> np.ndarray:
    """The weights for ``labels`` (doc_id, quality 0 or 1) of ``docs``.

    Other labels, labels without a document and null ids teach nothing; a text counts once for each
    label it has. Without any example all weights are zero, which scores every text 0.5.
    """
    rows = [(r.digest, r.quality, np.append(np.frombuffer(r.places, "<i4"), 1 << BITS),
             np.append(np.frombuffer(r["values"], "<f4"), 1.0))
            for r in _examples(docs, labels, size).toLocalIterator()]
    rows.sort(key=lambda r: r[:2])
    leader, order = Leader(), np.random.default_rng(1)
    for _ in range(-(-steps // max(len(rows), 1))):
        for i in order.permutation(len(rows)):
            _, label, places, values = rows[i]
            leader.learn(places, values, label)
    return leader.weights().astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray, held_out: Column) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    A null text is an empty one, whose score is the constant's; a null id stays null and is not held
    out; rows that repeat an id are scored each on its own. Whole texts of any length are read, other
    columns are not. An empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        for batch in batches:
            for part in slices(batch):
                owner, place, value = features(part.column("text"))
                total = np.bincount(owner, weights=w[place] * value, minlength=part.num_rows)
                p = 1 / (1 + np.exp(-np.clip(total + float(w[-1]), -35, 35)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(p),
                     pa.array((p >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       F.col("text").cast("string")).mapInArrow(task, SCORES)


def learn_and_score(docs: DataFrame, labels: DataFrame, held_out: Column,
                    size: int = EXAMPLES) -> DataFrame:
    """``score`` with weights from the labels of the rows that are not held out."""
    learnt = docs.filter(~F.coalesce(held_out, F.lit(False)))
    return score(docs, fit(learnt, labels, size), held_out)
