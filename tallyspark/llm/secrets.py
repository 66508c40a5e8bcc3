"""Secret scans: fixed patterns, and Markov models of random strings against ordinary identifiers.

Everything is built from SQL functions. Positions count code points from 0 and ends are exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns, their order and the least lengths.
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE = 8

#: What the models look at: whole runs of these characters, of at least this length.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"
#: The models' alphabet: each of these characters, then all others as one; 0 starts a string.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
STATES = len(ALPHABET) + 2
_BLOCK = 128

SPAN = "array<struct<start:int,kind:int,end:int>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, fold: Callable[[Column, Column], Column]) -> Column:
    """For each element of an array of integers the fold of all before it, 0 for the first.

    Folds whole blocks first: a fold over everything before each element would take the square of
    the array's length.
    """
    def over(array, start, length):
        return F.aggregate(F.slice(array, start, length), F.lit(0), fold)

    def block(i):
        return F.floor(i / _BLOCK).cast("int")

    def blocks(array):
        return F.transform(F.sequence(F.lit(0), block(F.size(array) - 1)),
                           lambda k: over(array, k * _BLOCK + 1, F.lit(_BLOCK)))

    def heads(array):
        return let(blocks(array), lambda b: F.transform(b, lambda _, k: over(b, F.lit(1), k)))

    def each(array):
        return let(heads(array), lambda h: F.transform(array, lambda _, i: fold(
            F.get(h, block(i)), over(array, block(i) * _BLOCK + 1, i % _BLOCK))))

    return let(values, lambda a: F.when(F.size(a) > 0, each(a)).otherwise(
        F.array().cast("array<int>")))


def _found(text: Column, pattern: str, kind: int, keep: Callable[[Column], Column] | None = None,
           group: int = 0) -> Column:
    """Spans of all matches of a pattern; ``keep`` is asked with the matched ``group``.

    What lies between the matches is measured only where a match is kept.
    """
    keep = keep or (lambda _: F.lit(True))

    def spans(groups):
        matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)) if group else groups
        lengths = F.transform(matches, F.length)
        gaps = F.transform(F.split(text, pattern, -1), F.length)
        rows = let(F.struct(groups.alias("g"), lengths.alias("m"), gaps.alias("p")), lambda x: let(
            running(F.zip_with(x["p"], x["m"], lambda p, m: p + F.coalesce(m, F.lit(0))),
                    lambda a, b: a + b),
            lambda before: F.transform(x["g"], lambda g, i: F.struct(
                (F.get(before, i) + F.get(x["p"], i)).alias("start"), F.lit(kind).alias("kind"),
                (F.get(before, i) + F.get(x["p"], i) + F.get(x["m"], i)).alias("end"),
                g.alias("value")))))
        return F.transform(F.filter(rows, lambda r: keep(r["value"])),
                           lambda r: F.struct(r["start"], r["kind"], r["end"])).cast(SPAN)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda groups: F.when(
        F.exists(groups, keep), spans(groups)).otherwise(F.array().cast(SPAN)))


def base_spans(text: Column) -> Column:
    """The spans of the fixed patterns, by start and then by kind."""
    assign = _found(text, ASSIGN, 0, lambda v: F.length(v) >= LEAST_VALUE, group=1)
    return F.sort_array(F.concat(assign, _found(text, ACCESS, 1), _found(text, HEX, 2)))


def _numbers(values: list) -> Column:
    """A constant array, folded by the optimiser into one literal."""
    kind = "int" if all(isinstance(v, int) for v in values) else "double"
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _states(word: Column) -> Column:
    """The state of each character of a string."""
    index = {ord(c): i + 1 for i, c in enumerate(ALPHABET)}
    table = _numbers([index.get(i, STATES - 1) for i in range(128)])
    chars = F.filter(F.split(word, ""), lambda c: c != "")
    return F.transform(chars, lambda c: F.coalesce(
        F.get(table, F.least(F.ascii(c), F.lit(128))), F.lit(STATES - 1)))


def log_ratio(word: Column, table: list[float]) -> Column:
    """Bits by which the model of random strings prefers a string to the one of identifiers."""
    bits = _numbers(table)
    return F.aggregate(
        _states(word), F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("last")),
        lambda a, s: F.struct((a["sum"] + F.get(bits, a["last"] * STATES + s)).alias("sum"),
                              s.alias("last")),
        lambda a: a["sum"])


def labelled_samples(docs: DataFrame, max_docs: int = 5_000, generated: int = 2_000) -> DataFrame:
    """word, is_random: what the models are trained on.

    From about ``max_docs`` documents, chosen by a hash of their text: the values that the fixed
    patterns find, as random, and all other words of eight characters or more. To these come
    ``generated`` digests each in hexadecimal and in base 64, so that a corpus without secrets
    still has random samples.
    """
    share = min(1.0, max_docs / max(1, docs.count()))
    text = F.coalesce(F.col("text"), F.lit(""))
    some = docs.select(text.alias("text")).filter(
        F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    values = F.concat(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(1)),
                      F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
                      F.regexp_extract_all("text", F.lit(HEX), F.lit(0)))
    secret = some.select(F.explode(values).alias("word"), F.lit(True).alias("is_random"))
    without = F.regexp_replace("text", f"{ASSIGN}|{ACCESS}|{HEX}", " ")
    words = some.select(F.explode(F.regexp_extract_all(
        without, F.lit(r"[A-Za-z0-9+/_=.-]{8,}"), F.lit(0))).alias("word"),
        F.lit(False).alias("is_random"))
    digest = F.sha2(F.col("id").cast("string"), 256)
    made = docs.sparkSession.range(generated).select(F.explode(F.array(
        digest, F.base64(F.unhex(digest)))).alias("word"), F.lit(True).alias("is_random"))
    return secret.unionByName(words).unionByName(made).filter(F.length("word") >= LEAST_VALUE)


def train(samples: DataFrame, smoothing: float = 0.5, prior: float = 20.0) -> list[float]:
    """The table for ``log_ratio``: log2 of the ratio of both models' transitions.

    ``samples`` has word and is_random. A transition's probability leans on how frequent its end is
    in all of its model's samples, as if seen ``prior`` times; ``smoothing`` is added to each state.
    Only the counts of pairs of states reach the driver.
    """
    pairs = let(_states(F.col("word")), lambda states: F.transform(
        states, lambda s, i: F.when(i == 0, s).otherwise(F.get(states, i - 1) * STATES + s)))
    counts = {(r.is_random, r.pair): r.n for r in samples.select(
        "is_random", F.explode(pairs).alias("pair")).groupBy("is_random", "pair")
        .agg(F.count("*").alias("n")).collect()}
    seen = {k: [[counts.get((k, last * STATES + s), 0) for s in range(STATES)]
                for last in range(STATES)] for k in (False, True)}
    overall = {}
    for k, rows in seen.items():
        total = sum(map(sum, rows)) + smoothing * STATES
        overall[k] = [(sum(column) + smoothing) / total for column in zip(*rows)]

    def chance(k, last, s):
        return (seen[k][last][s] + prior * overall[k][s]) / (sum(seen[k][last]) + prior)

    return [math.log2(chance(True, last, s) / chance(False, last, s))
            for last in range(STATES) for s in range(STATES)]


def find(docs: DataFrame, table: list[float], least_bits: float = 12.0) -> DataFrame:
    """Adds ``base`` and ``added`` to ``docs``: spans as (start, kind, end), sorted.

    ``added`` holds the candidates with a letter whose log-likelihood ratio is at least
    ``least_bits`` and that touch no base span. Columns of ``docs`` with these names are replaced.

    A null or empty text has no spans. Rows are scanned each on its own, whatever their ids.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    more = _found(text, CANDIDATE, 3, lambda v: v.rlike("[A-Za-z]") & (
        log_ratio(v, table) >= least_bits))
    apart = F.filter("more", lambda a: ~F.exists("base", lambda b: (
        b["start"] < a["end"]) & (a["start"] < b["end"])))
    found = docs.withColumn("__both", F.struct(base_spans(text).alias("base"), more.alias("more")))
    return (found.withColumns({"base": F.col("__both.base"), "more": F.col("__both.more")})
            .withColumn("added", apart).drop("__both", "more"))


def spell(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def scan(docs: DataFrame, table: list[float] | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_random of each row of ``docs``.

    Without ``table`` the models are trained on samples from ``docs``. See ``find`` for odd rows.
    """
    table = table or train(labelled_samples(docs))
    found = find(docs.select(F.col("doc_id").cast("long"), "text"), table)

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(spell(F.col("base")), 256).alias("base_sha256"),
        spell(F.sort_array(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_random"))


def redact(docs: DataFrame, table: list[float] | None = None, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``; overlapping spans by one.

    A text without spans stays as it is, null included.
    """
    names = docs.columns
    table = table or train(labelled_samples(docs))
    found = find(docs.withColumn("__text", F.col("text")), table).withColumn(
        "__spans", F.sort_array(F.concat("base", "added")))
    def parts(chars, spans):
        past = running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        kept = F.zip_with(spans, past, lambda s, p: F.when(s["start"] < p, F.lit("")).otherwise(
            F.concat(F.array_join(F.slice(chars, p + 1, s["start"] - p), ""), F.lit(mark))))
        return F.concat(F.array_join(kept, ""), F.array_join(
            F.slice(chars, last + 1, F.size(chars)), ""))

    text = let(F.filter(F.split("text", ""), lambda c: c != ""),
               lambda chars: parts(chars, F.col("__spans")))
    return found.withColumn("text", F.when(F.size("__spans") > 0, text).otherwise(
        F.col("text"))).select(*[F.col(f"`{n}`") for n in names])
