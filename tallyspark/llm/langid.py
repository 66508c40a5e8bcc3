"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text's bytes in stretches of a fixed length, forwards and backwards, and gives
every position the probabilities of the languages. A document's probabilities are the means over
all its positions that belong to letters. Training is backpropagation through time in numpy on a
bounded sample of stretches; prediction reads every byte of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.batches import flat, slices

UNKNOWN = "und"
STRETCH = 64
#: Stretches that the network reads at a time.
ROWS = 2048

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


@dataclass
class Settings:
    """Bounds of the sample and of training, which do not depend on the size of the corpus."""

    docs_per_lang: int = 300
    stretches_per_doc: int = 4
    hidden: int = 8
    steps: int = 260
    batch: int = 192
    rate: float = 0.03


@dataclass
class Model:
    """For each direction a byte's input to the three gates (gates x bytes), the recurrent weights
    (gates x hidden), and the output weights (langs x both directions) and bias. The first two
    gates are halved, so that tanh serves for both functions. All arrays run over the rows of a
    batch last, so that each operation works on long contiguous stretches of memory."""

    langs: list[str]
    inputs: list[np.ndarray]
    recurrent: list[np.ndarray]
    output: np.ndarray
    bias: np.ndarray


def _step(model: Model, way: int, state: np.ndarray, byte: np.ndarray):
    """The next states from the states and a byte for each row; and the gates."""
    h = state.shape[0]
    given = np.take(model.inputs[way], byte, axis=1)
    past = model.recurrent[way] @ state
    gates = given[:2 * h]
    gates += past[:2 * h]
    np.tanh(gates, out=gates)
    gates *= 0.5
    gates += 0.5
    keep, reset = gates[:h], gates[h:]
    fresh = given[2 * h:]
    fresh += past[2 * h:] * reset
    np.tanh(fresh, out=fresh)
    out = state - fresh
    out *= keep
    out += fresh
    return out, keep, reset, fresh, past


def _softmax(scores: np.ndarray) -> np.ndarray:
    """Over the first axis."""
    scores -= scores.max(0)
    np.exp(scores, out=scores)
    scores /= scores.sum(0)
    return scores


def position_sums(model: Model, stretches: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """Of each stretch (column) the sum of the probabilities at its counted positions."""
    length, rows = stretches.shape
    h = model.recurrent[0].shape[1]
    ahead = np.empty((length, h, rows), dtype=np.float32)
    state = np.zeros((h, rows), dtype=np.float32)
    for t in range(length):
        state = ahead[t] = _step(model, 0, state, stretches[t])[0]
    total = np.zeros((len(model.langs), rows), dtype=np.float32)
    state = np.zeros((h, rows), dtype=np.float32)
    for t in range(length - 1, -1, -1):
        state = _step(model, 1, state, stretches[t])[0]
        scores = model.output[:, :h] @ ahead[t]
        scores += model.output[:, h:] @ state
        scores += model.bias
        scores = _softmax(scores)
        scores *= counted[t]
        total += scores
    return total


def _initial(langs: list[str], settings: Settings, rng: np.random.Generator) -> Model:
    h = settings.hidden

    def draw(scale, *shape):
        return rng.normal(0, scale, shape).astype(np.float32)

    return Model(langs, [draw(0.3, 3 * h, 256) for _ in range(2)],
                 [draw(0.25, 3 * h, h) for _ in range(2)], draw(0.2, len(langs), 2 * h),
                 np.zeros((len(langs), 1), dtype=np.float32))


def gradients(model: Model, stretches: np.ndarray, counted: np.ndarray, right: np.ndarray):
    """Loss and its gradients, by backpropagation through time over both directions."""
    length, rows = stretches.shape
    h = model.recurrent[0].shape[1]
    each = np.arange(rows)
    tape: list[list] = [[None] * length, [None] * length]
    both = np.empty((length, 2 * h, rows), dtype=model.output.dtype)
    order = [range(length), range(length - 1, -1, -1)]
    for way in (0, 1):
        state = np.zeros((h, rows), dtype=model.output.dtype)
        for t in order[way]:
            new, *gates = _step(model, way, state, stretches[t])
            tape[way][t] = (state, *gates)
            both[t, way * h:(way + 1) * h] = state = new
    on_output, on_bias = np.zeros_like(model.output), np.zeros_like(model.bias)
    back = np.empty_like(both)
    weight = counted / max(1, counted.sum())
    loss = 0.0
    for t in range(length):
        error = _softmax(model.output @ both[t] + model.bias)
        loss -= (np.log(error[right, each] + 1e-9) * weight[t]).sum()
        error[right, each] -= 1
        error *= weight[t]
        on_output += error @ both[t].T
        on_bias += error.sum(1, keepdims=True)
        back[t] = model.output.T @ error
    grads = {"output": on_output, "bias": on_bias}
    for way in (0, 1):
        on_input = np.zeros_like(model.inputs[way])
        on_past = np.zeros_like(model.recurrent[way])
        carried = np.zeros((h, rows), dtype=model.output.dtype)
        for t in reversed(order[way]):
            state, keep, reset, fresh, past = tape[way][t]
            d_out = back[t, way * h:(way + 1) * h] + carried
            d_keep = d_out * (state - fresh) * keep * (1 - keep) * 2
            d_fresh = d_out * (1 - keep) * (1 - fresh * fresh)
            d_reset = d_fresh * past[2 * h:] * reset * (1 - reset) * 2
            d_past = np.concatenate([d_keep, d_reset, d_fresh * reset])
            seen = np.zeros((rows, 256), dtype=d_past.dtype)
            seen[each, stretches[t]] = 1
            on_input += np.concatenate([d_keep, d_reset, d_fresh]) @ seen
            on_past += d_past @ state.T
            carried = d_out * keep + model.recurrent[way].T @ d_past
        grads[f"inputs{way}"], grads[f"recurrent{way}"] = on_input, on_past
    return loss, grads


def train(stretches: np.ndarray, right: np.ndarray, langs: list[str],
          settings: Settings = Settings(), seed: int = 5) -> Model:
    """A network for stretches of bytes (rows; 0 after the end) and the numbers of their langs."""
    rng = np.random.default_rng(seed)
    model = _initial(langs, settings, rng)
    params = {"output": model.output, "bias": model.bias}
    for way in (0, 1):
        params |= {f"inputs{way}": model.inputs[way], f"recurrent{way}": model.recurrent[way]}
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    by_lang = [np.flatnonzero(right == i) for i in range(len(langs))]
    by_lang = [x for x in by_lang if len(x)]
    each = max(1, settings.batch // max(1, len(by_lang)))
    for step in range(1, settings.steps + 1 if by_lang else 1):
        some = np.concatenate([rng.choice(x, each) for x in by_lang])
        part = np.ascontiguousarray(stretches[some].T)
        _, grads = gradients(model, part, _LETTER[part].astype(np.float32), right[some])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = settings.rate * (1 - 0.9 * step / settings.steps) * min(1, 1 / max(norm, 1e-6))
        for k, g in grads.items():
            first, second = moment[k]
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            params[k] -= rate * (first / (1 - 0.9 ** step)) / (
                np.sqrt(second / (1 - 0.99 ** step)) + 1e-6)
    return model


def fit(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """A network from ``docs`` (text, lang).

    All languages of labelled rows are learnt. The sample holds about ``docs_per_lang`` distinct
    texts of each, chosen by a hash of the text, and ``stretches_per_doc`` stretches at hashed
    places of each: copies of a text count once, and only these stretches reach the driver.
    """
    known = docs.select("text", F.col("lang").cast("string")).filter(
        "lang IS NOT NULL AND text IS NOT NULL AND length(text) > 0")
    counts = known.select("lang", F.xxhash64("text").alias("h")).distinct().groupBy(
        "lang").count().collect()
    langs = sorted(r.lang for r in counts)
    if not langs:
        return Model([], [], [], np.zeros((0, 0)), np.zeros(0))
    share = docs.sparkSession.createDataFrame(
        [(r.lang, min(1.0, settings.docs_per_lang / r["count"])) for r in counts],
        "lang string, share double")
    places = F.transform(
        F.sequence(F.lit(1), F.lit(settings.stretches_per_doc)), lambda i: F.substring(
            "text", (F.pmod(F.xxhash64("text", i), F.greatest(
                F.lit(1), F.length("text") - STRETCH + 1)) + 1).cast("int"), F.lit(STRETCH)))
    rows = (known.join(F.broadcast(share), "lang")
            .filter(F.pmod(F.xxhash64("text", F.lit(0)), F.lit(1 << 40)) < F.col("share")
                    * (1 << 40))
            .select("lang", places.alias("places")).distinct().collect())
    found = sorted({(r.lang, p) for r in rows for p in r.places})
    data = np.zeros((len(found), STRETCH), dtype=np.uint8)
    for i, (_, text) in enumerate(found):
        raw = np.frombuffer(text.encode()[:STRETCH], dtype=np.uint8)
        data[i, :len(raw)] = raw
    return train(data, np.asarray([langs.index(x) for x, _ in found], dtype=int), langs, settings)


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _predict(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    count = len(texts)
    if not model.langs:
        return [UNKNOWN] * count, np.zeros(count)
    data, at = flat(texts)
    pieces = -(-np.diff(at) // STRETCH)
    owner = np.repeat(np.arange(count), pieces)
    start = at[:-1][owner] + STRETCH * (np.arange(len(owner))
                                        - np.repeat(np.cumsum(pieces) - pieces, pieces))
    total = np.zeros((count, len(model.langs)))
    padded = np.append(data, np.zeros(STRETCH, dtype=np.uint8))
    for i in range(0, len(owner), ROWS):
        rows = slice(i, i + ROWS)
        place = start[rows, None] + np.arange(STRETCH)
        part = np.where(place < at[1:][owner[rows], None], padded[place], 0).astype(np.uint8)
        part = np.ascontiguousarray(part.T)
        sums = position_sums(model, part, _LETTER[part].astype(np.float32))
        np.add.at(total, owner[rows], sums.T)
    sums = total.sum(1)
    score = total.max(1, initial=0) / np.maximum(sums, 1e-9)
    best = total.argmax(1)
    out = []
    for i, text in enumerate(texts.to_pylist()):
        if sums[i] > 0 and _has_letter(text):
            out.append(model.langs[best[i]])
        else:
            out.append(UNKNOWN)
            score[i] = 0.0
    return out, score.clip(0, 1)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score, which replace columns of these names.

    A null text, or one without a letter, is of the language ``und`` with a score of 0; so is every
    text where no language was learnt. Only the text counts; every row is judged on its own.
    """
    names = [n for n in docs.columns if n not in ("lang_pred", "score")]
    fields = docs.select(*[F.col(f"`{n}`") for n in names]).schema.fields
    # Python functions take no column whose name has a dot: names give way to places.
    slim = docs.select("text", *[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)
                                 if n != "text"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                langs, score = _predict(model, part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("text" if n == "text" else f"c{i}")
                     for i, n in enumerate(names)]
                    + [pa.array(langs, pa.string()), pa.array(score, pa.float64())],
                    names=names + ["lang_pred", "score"])

    return slim.mapInArrow(task, T.StructType(fields + [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def learn_and_identify(docs: DataFrame, held_out: Column,
                       settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, lang_pred, score of all rows; learnt where ``held_out`` is not true."""
    rows = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    model = fit(rows.filter("NOT held_out"), settings)
    return identify(rows.select("doc_id", "held_out", "text"), model).drop("text")
