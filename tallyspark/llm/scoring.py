"""Language-model scores from a log-bilinear neural model trained with noise-contrastive estimation.

The model predicts a word's class from the classes of the two words before it and the word from
its class by counts. The most frequent words are classes of their own, all others are classed by
their last two characters, so that a word's class follows from its characters alone. What training
needs are the corpus's counts of words and of three classes in a row, both summed over all training
texts by Spark; the latter are bounded by the cube of the number of classes whatever the corpus.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.batches import LOWER, slices
from tallyspark.session import stage_table

_LOWER = bytes(LOWER.tolist())
#: Class 0 is the end of a text, and what comes before its first word.
END = 0


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_LOWER).split()


@dataclass
class Settings:
    """Sizes of the model. ``head`` bounds the words whose counts are sent to every executor;
    every step of the training takes all counts, those of ``batch`` contexts at a time."""

    frequent: int = 62
    suffixes: int = 63
    head: int = 1 << 18
    dimensions: int = 32
    steps: int = 1000
    batch: int = 2048
    noise: int = 48
    rate: float = 0.02

    @property
    def classes(self) -> int:
        return 1 + self.frequent + self.suffixes + 2


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n over all texts: words in small letters (A-Z only)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()).cast(pa.string()),
                 pa.array(list(found.values()), pa.int64())], names=["word", "n"])

        found: Counter = Counter()
        for batch in batches:
            for part in slices(batch):
                for text in part.column("text").to_pylist():
                    found.update(words_of(text))
                if len(found) > 200_000:
                    yield rows()
                    found.clear()
        if found:
            yield rows()

    return docs.select("text").mapInArrow(task, "word string, n long").groupBy("word").agg(
        F.sum("n").alias("n"))


def head_of(counts: DataFrame, limit: int) -> list[tuple[str, int]]:
    """The most frequent words, as many whole steps of frequency as fit the limit."""
    step = F.floor(F.log2("n") * 16)
    total, least = 0, None
    for r in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        total += r["count"]
        if total > limit:
            break
        least = r.step
    if least is None:
        return []
    rows = counts.filter(step >= least).collect()
    return sorted(((r.word, r.n) for r in rows), key=lambda r: (-r[1], r[0]))


class Classes:
    """The class of each word."""

    def __init__(self, frequent: list[str], suffixes: list[str], settings: Settings):
        self.frequent, self.suffixes = frequent, suffixes
        self.other = settings.classes - 2
        self._frequent = {w.encode(): i + 1 for i, w in enumerate(self.frequent)}
        self.first = 1 + settings.frequent
        self._suffix = {s: i + self.first for i, s in enumerate(self.suffixes)}

    def of(self, word: bytes) -> int:
        found = self._frequent.get(word)
        if found is None:
            found = self._suffix.get(word[-8:].decode(errors="ignore")[-2:])
        return self.other + (not word.isascii()) if found is None else found

    def column(self, word: Column) -> Column:
        """The same in SQL, for words that are not classes of their own."""
        place = F.array_position(F.lit(self.suffixes) if self.suffixes else F.array(F.lit("")),
                                 F.substring(word, -2, 2))
        known = F.when(F.lit(bool(self.suffixes)) & (place > 0), self.first + place - 1)
        return F.coalesce(known, self.other + (F.octet_length(word) != F.length(word)).cast("int"))


def classes_of(counts: DataFrame, head: list[tuple[str, int]], settings: Settings) -> Classes:
    """The most frequent words, and the endings that most of all other words' occurrences have."""
    frequent = [w for w, _ in head[:settings.frequent]]
    ends = counts.filter(~F.col("word").isin(frequent)).groupBy(
        F.substring("word", -2, 2).alias("end")).agg(F.sum("n").alias("n")).orderBy(
            F.desc("n"), "end").limit(settings.suffixes).collect()
    return Classes(frequent, [r.end for r in ends], settings)


class WordNumbers(dict):
    """The number of a head word, or the count of head words plus the class of another word."""

    def __init__(self, head: list[tuple[str, int]], classes: Classes):
        super().__init__({w.encode(): i for i, (w, _) in enumerate(head)})
        self.size, self.classes = len(head), classes

    def __missing__(self, word: bytes) -> int:
        return self.size + self.classes.of(word)


def _stream(texts: list[str | None], numbers: WordNumbers, table: np.ndarray):
    """All texts' classes in sequence, each after two ends and before one; the words' numbers."""
    docs = [words_of(t) for t in texts]
    sizes = np.asarray([len(d) for d in docs], dtype=np.int64)
    found = np.fromiter((numbers[w] for d in docs for w in d), dtype=np.int64, count=sizes.sum())
    heads = np.cumsum(sizes + 3) - sizes - 3
    stream = np.full(int((sizes + 3).sum()), END, dtype=np.int64)
    place = np.arange(len(found)) + np.repeat(heads + 2 - (np.cumsum(sizes) - sizes), sizes)
    stream[place] = table[found]
    target = np.ones(len(stream), dtype=bool)
    target[heads] = target[heads + 1] = False
    return docs, sizes, found, stream, np.flatnonzero(target)


def triple_counts(docs: DataFrame, numbers, table: np.ndarray, classes: int) -> DataFrame:
    """code, n of each three classes in a row over all texts."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes ** 3, dtype=np.int64)
        for batch in batches:
            for part in slices(batch):
                _, _, _, s, at = _stream(part.column("text").to_pylist(), numbers.value, table)
                code = (s[at - 2] * classes + s[at - 1]) * classes + s[at]
                seen, n = np.unique(code, return_counts=True)
                total[seen] += n
        seen = np.flatnonzero(total)
        for i in range(0, len(seen), 100_000):
            some = seen[i:i + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array(total[some])], names=["code", "n"])

    return docs.select("text").mapInArrow(task, "code long, n long").groupBy("code").agg(
        F.sum("n").alias("n"))


def train(code: np.ndarray, n: np.ndarray, settings: Settings, seed: int = 7) -> np.ndarray:
    """log10 P(class | two classes before), from counts of three classes in a row.

    A context's vector is the sum of its two words' vectors, each scaled by its position; a class
    scores by its inner product with that vector and a bias. Noise-contrastive estimation tells
    the corpus's triples from classes drawn by their frequency. Nothing is drawn for it: every step
    takes all triples by their counts, and the noise by its expectation. The scores of every
    context are then normalised over all classes.
    """
    k, d = settings.classes, settings.dimensions
    rng = np.random.default_rng(seed)
    by_class = np.bincount(code % k, weights=n, minlength=k) + 0.5
    noise = by_class / by_class.sum()
    params = {
        "context": rng.normal(0, 0.3, (k, d)), "position": np.ones((2, d)),
        "target": rng.normal(0, 0.1, (k, d)), "bias": np.log(noise),
    }
    params = {p: v.astype(np.float32) for p, v in params.items()}
    if len(code):
        moment = {p: (np.zeros_like(v), np.zeros_like(v)) for p, v in params.items()}
        share = np.zeros(k ** 3, dtype=np.float32)
        share[code] = n / n.sum()
        share = share.reshape(k * k, k)
        # Contexts by their far and near class; those that never occur have no part in anything.
        seen = np.flatnonzero(share.any(1))
        drawn = (settings.noise * noise).astype(np.float32)
        log_noise = np.log(settings.noise * noise).astype(np.float32)
        blocks = []
        for i in range(0, len(seen), settings.batch):
            some = seen[i:i + settings.batch]
            blocks.append((share[some], share[some].sum(1, keepdims=True) * drawn, some // k,
                           some % k, _one_hot(some // k, k).T, _one_hot(some % k, k).T))
        for step in range(1, settings.steps + 1):
            context, position = params["context"], params["position"]
            grads = {p: np.zeros_like(v) for p, v in params.items()}
            for real, false, far, near, is_far, is_near in blocks:
                vector = context[near] * position[0] + context[far] * position[1]
                score = vector @ params["target"].T + (params["bias"] - log_noise)
                # Of each triple, what it pulls as one of the corpus less what it pushes as noise.
                weight = real - (real + false) / (1 + np.exp(np.minimum(-score, 80)))
                back = weight @ params["target"]
                by_near, by_far = is_near @ back, is_far @ back
                grads["target"] += weight.T @ vector
                grads["bias"] += weight.sum(0)
                grads["position"] += np.stack([(by_near * context).sum(0),
                                               (by_far * context).sum(0)])
                grads["context"] += by_near * position[0] + by_far * position[1]
            rate = settings.rate * (1 - 0.95 * step / settings.steps)
            for p, g in grads.items():
                first, second = moment[p]
                first *= 0.9
                first += 0.1 * g
                second *= 0.99
                second += 0.01 * g * g
                params[p] += rate * (first / (1 - 0.9 ** step)) / (
                    np.sqrt(second / (1 - 0.99 ** step)) + 1e-12)
    near, far = (params["context"] * p for p in params["position"])
    out = np.empty((k, k, k), dtype=np.float32)
    for a in range(k):
        scores = (far[a] + near) @ params["target"].T + params["bias"]
        top = scores.max(1, keepdims=True)
        out[a] = (scores - top - np.log(np.exp(scores - top).sum(1, keepdims=True))) / np.log(10)
    return out


def _one_hot(values: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros((len(values), size), dtype=np.float32)
    out[np.arange(len(values)), values] = 1
    return out


def score(docs: DataFrame, held_out: Column, settings: Settings = Settings()) -> DataFrame:
    """Scores of all rows of ``docs`` (doc_id, text), learnt from those where ``held_out`` is false.

    Returns doc_id, held_out, n_tokens (words and one end), n_known, train_tokens, base_score (the
    words by their counts alone, one added to each) and score, as sums of log10.

    A null or empty text has one token, its end. Where ``held_out`` is null it counts as false.
    Rows that repeat an id are scored each on its own; a null id stays null. With no training rows
    all classes are as likely. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    learn = rows.filter("NOT held_out")
    counts = stage_table(word_counts(learn), "words")
    head = head_of(counts, settings.head)
    classes = classes_of(counts, head, settings)
    k = settings.classes
    table = np.concatenate([np.asarray([classes.of(w.encode()) for w, _ in head], dtype=np.int64),
                            np.arange(k)])
    # Both broadcasts are bounded by the settings.
    numbers = spark.sparkContext.broadcast(WordNumbers(head, classes))
    triples = triple_counts(learn, numbers, table, k).toArrow()
    model = spark.sparkContext.broadcast(
        train(triples["code"].to_numpy(), triples["n"].to_numpy(), settings))

    own = F.lit(classes.frequent) if classes.frequent else F.array().cast("array<string>")
    by_class = counts.groupBy(
        F.when(F.array_contains(own, F.col("word")), -1).otherwise(classes.column(F.col("word")))
        .alias("class")).agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect()
    ends = learn.count()
    tokens = sum(r.n for r in by_class) + ends
    types = sum(r.types for r in by_class) + (ends > 0)
    inside = np.zeros(k)
    for r in by_class:
        if r["class"] >= 0:
            inside[r["class"]] = r.n + r.types
    inside = np.log10(inside + 1)
    inside[:1 + len(classes.frequent)] = np.nan
    log_count = np.log10(np.asarray([n for _, n in head], dtype=float) + 1)
    head_part = np.concatenate([log_count, np.zeros(k)])
    #: log10 P(word | class) without the count of a word that is not in the head
    word_part = np.concatenate([log_count, np.zeros(k)]) - np.nan_to_num(inside[table])
    word_part[:len(classes.frequent)] = 0.0
    base_total = float(np.log10(tokens + types + 1))
    end_part = float(np.log10(ends + 1))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        known, logs = numbers.value, model.value.ravel()
        for batch in batches:
            for part in slices(batch):
                words, sizes, found, s, at = _stream(part.column("text").to_pylist(), known, table)
                by_token = logs[(s[at - 2] * k + s[at - 1]) * k + s[at]].astype(np.float64)
                starts = np.cumsum(sizes + 1) - sizes - 1
                neural = np.add.reduceat(by_token, starts)
                bounds = np.append(0, np.cumsum(sizes))

                def per_doc(values):
                    sums = np.append(0, np.cumsum(values))
                    return sums[bounds[1:]] - sums[bounds[:-1]]

                out_of_head = found >= known.size
                base = per_doc(head_part[found]) + end_part - (sizes + 1) * base_total
                total = neural + per_doc(word_part[found])
                rest = []
                for i, doc in enumerate(words):
                    places = np.flatnonzero(out_of_head[bounds[i]:bounds[i + 1]])
                    rest.append([doc[j].decode() for j in places.tolist()])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(row, row + len(sizes))), part.column("doc_id"),
                    part.column("held_out"), pa.array(sizes + 1),
                    pa.array(per_doc(~out_of_head) + (ends > 0)), pa.array(base), pa.array(total),
                    pa.array(rest, pa.list_(pa.string())),
                ], names=["row", "doc_id", "held_out", "n_tokens", "n_head", "base", "neural",
                          "rest"])
                row += len(sizes)

    local = stage_table(rows.mapInArrow(
        task, "row long, doc_id long, held_out boolean, n_tokens long, n_head long, base double, "
              "neural double, rest array<string>"), "scores")
    # The counts of words outside the head meet them by a join; each is one row.
    rest = (local.select("row", F.explode("rest").alias("word"))
            .join(counts, "word").groupBy("row")
            .agg(F.sum(F.log10(F.col("n") + 1)).alias("more"), F.count("*").alias("n_rest")))
    more = F.coalesce("more", F.lit(0.0))
    return local.join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_head") + F.coalesce("n_rest", F.lit(0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"), (F.col("neural") + more).alias("score"))
