"""Order MinHash fingerprints of documents, from SQL functions alone.

A text is a sequence of tokens (runs of at most 16 characters without white space); equal k-mers of
tokens are told apart by their occurrence number. Each of the fingerprint's functions is one
rotation of a common random order: it selects the smallest k-mers at or after its place on the ring
of hashes. Their hashes, put back into text order, are hashed together. Two texts agree in a
position if the same k-mers were selected and stand in the same order, which ties the share of
equal positions to the edit distance and not to the sets alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.ordering import successors
from tallyspark.llm.secrets import let
from tallyspark.session import stage_table

TOKEN = r"[^\s]{1,16}"
#: Hexadecimal digits of one position of a fingerprint.
DIGITS = 4
EMPTY = "-" * DIGITS


def _kmers(text: Column, k: int) -> Column:
    """Hash of each k-mer in text order; a text with fewer tokens has one of all its tokens."""
    tokens = F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)),
                         lambda t: F.xxhash64(t))

    def shingles(t):
        long = F.transform(F.slice(t, k, F.size(t)), lambda last, i: F.xxhash64(
            *[F.get(t, i + j) for j in range(k - 1)], last))
        return F.when(F.size(t) >= k, long).when(F.size(t) > 0, F.array(F.xxhash64(t))).otherwise(
            F.array().cast("array<bigint>"))

    return let(tokens, shingles)


def _numbered(kmers: Column) -> Column:
    """(hash of k-mer and occurrence number, place in the text), by hash."""
    def runs(ordered):
        starts = F.filter(
            F.transform(ordered, lambda x, i: F.when(
                (i == 0) | (x["h"] != F.get(ordered, i - 1)["h"]), i)), lambda i: i.isNotNull())
        number = let(starts, lambda s: F.flatten(F.transform(s, lambda a, r: F.transform(
            F.slice(ordered, a + 1, F.coalesce(F.get(s, r + 1), F.size(ordered)) - a),
            lambda x, o: F.struct(F.xxhash64(x["h"], o).alias("h"), x["p"])))))
        return number

    def repeated(hashes):
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
        return let(F.sort_array(placed), runs)

    def distinct(hashes):
        return F.transform(hashes, lambda h, i: F.struct(F.xxhash64(h, F.lit(0)).alias("h"),
                                                         i.alias("p")))

    return let(kmers, lambda hashes: F.sort_array(F.when(
        F.size(F.array_distinct(hashes)) == F.size(hashes), distinct(hashes)).otherwise(
            repeated(hashes))))


def fingerprint(text: Column, functions: int = 32, tuple_size: int = 2, k: int = 3) -> Column:
    """``functions`` positions of four hexadecimal digits each; a fixed string without tokens.

    ``functions`` is a power of two. Texts with the same tokens have the same fingerprint.
    """
    shift = 64 - functions.bit_length() + 1
    half = functions // 2

    def place(h):
        return F.shiftright(h, shift) + half

    def picks(ordered):
        # Only the first few of each arc can be selected.
        kept = F.filter(ordered, lambda x, i: (i < tuple_size) | (
            place(x["h"]) != place(F.get(ordered, i - tuple_size)["h"])))
        return let(kept, signature)

    def signature(kept):
        arcs = F.transform(kept, lambda x: place(x["h"]).cast("int"))

        def position(arcs_, j):
            # array_position finds the first k-mer of the arc; an empty arc goes on to the next.
            first = F.aggregate(F.sequence(j, F.lit(functions - 1)), F.lit(0), lambda at, a: F.when(
                at > 0, at).otherwise(F.array_position(arcs_, a).cast("int")))
            start = F.greatest(first - 1, F.lit(0))
            chosen = F.sort_array(F.transform(
                F.sequence(F.lit(0), F.least(F.lit(tuple_size), F.size(kept)) - 1),
                lambda t: let(F.get(kept, (start + t) % F.size(kept)), lambda x: F.struct(
                    x["p"].alias("p"), x["h"].alias("h")))))
            whole = F.hex(F.xxhash64(F.transform(chosen, lambda c: c["h"])))
            return F.substring(F.lpad(whole, 16, "0"), 1, DIGITS)

        return let(arcs, lambda a: F.array_join(F.transform(
            F.sequence(F.lit(0), F.lit(functions - 1)), lambda j: position(a, j)), ""))

    return let(_numbered(_kmers(text, k)), lambda ordered: F.when(
        F.size(ordered) == 0, F.lit(EMPTY * functions)).otherwise(picks(ordered)))


def likeness(a: Column, b: Column, functions: int = 32) -> Column:
    """The share of positions in which two fingerprints agree, 0 to 1."""
    same = F.filter(F.sequence(F.lit(0), F.lit(functions - 1)), lambda j: F.substring(
        a, j * DIGITS + 1, F.lit(DIGITS)) == F.substring(b, j * DIGITS + 1, F.lit(DIGITS)))
    return F.size(same) / F.lit(float(functions))


def fingerprint_documents(docs: DataFrame, functions: int = 32, tuple_size: int = 2,
                          k: int = 3) -> DataFrame:
    """Fingerprints of all texts, of their edited texts, and how like they are.

    The edited text has the last quarter of its code points (rounded down) replaced by as many
    first ones of the next document (or all it has). Next is by ascending doc_id, after the last
    the first; documents with one id follow each other by a hash of their text. Returns doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    A null text is an empty one, whose fingerprint agrees with that of any text without tokens in
    every position and with no other. A null id comes first and stays null. Rows with the same id
    and text are one document in the order; each of them gets its row. A single document is its
    own next. Other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", F.xxhash64("text").alias("h"), "text")
    keys = whole.select("doc_id", "h", F.length("text").alias("n"))
    pairs = stage_table(successors(keys), "successors")
    quarter = F.floor(F.col("n") / 4).cast("int")
    # A document's head goes to the one before it, which knows how much of it to take.
    wanted = pairs.select(F.col("next_doc_id").alias("k_id"), F.col("next_h").alias("k_h"),
                          F.col("doc_id").alias("to_id"), F.col("h").alias("to_h"),
                          quarter.alias("take"))
    same = whole["doc_id"].eqNullSafe(wanted["k_id"]) & (whole["h"] == wanted["k_h"])
    heads = (whole.join(wanted, same)
             .groupBy("to_id", "to_h")
             .agg(F.max(F.expr("left(text, take)")).alias("head")))
    mine = whole["doc_id"].eqNullSafe(heads["to_id"]) & (whole["h"] == heads["to_h"])
    size = F.length("text")
    cut = F.floor(size / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - cut), "head")
    coded = stage_table(
        whole.join(heads, mine).select("doc_id", "h", "text", edited.alias("edited")).select(
            "doc_id", "h", size.cast("long").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            fingerprint(F.col("text"), functions, tuple_size, k).alias("fingerprint"),
            fingerprint(F.col("edited"), functions, tuple_size, k).alias("edited_fingerprint")),
        "fingerprints")
    follow = (pairs.select(F.col("doc_id").alias("to_id"), F.col("h").alias("to_h"),
                           F.col("next_doc_id").alias("k_id"), F.col("next_h").alias("k_h")))
    one = (coded.join(follow, coded["doc_id"].eqNullSafe(follow["k_id"])
                      & (coded["h"] == follow["k_h"]))
           .groupBy("to_id", "to_h").agg(F.max("fingerprint").alias("next_fingerprint")))
    return (coded.join(one, coded["doc_id"].eqNullSafe(one["to_id"]) & (coded["h"] == one["to_h"]))
            .select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint"),
                             functions).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("next_fingerprint"),
                             functions).alias("near_next")))
