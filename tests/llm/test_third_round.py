"""The conversation trie, the quality classifier and the alignment of two tokenizers."""

import json
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402

from tallyspark.llm import alignment, classifier, prefixes, queries  # noqa: E402
from tallyspark.llm.perfecthash import PerfectHash  # noqa: E402
from tallyspark.llm.shipping import ship  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, pair long, n long, "
        "quality int, score double, row long, `a.b` string")
TURNS = "conv_id long, turn long, role string, text string, path string, n long, `a.b` string"


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def documents(spark, rows):
    return ship(spark).createDataFrame([(*r, *[None] * 9) for r in rows], DOCS)


# -- 11 conversation trie --------------------------------------------------------------------------
def talk(spark, rows):
    return ship(spark).createDataFrame([(*r, None, None, None) for r in rows], TURNS)


@pytest.mark.parametrize("block", [prefixes.BLOCK, 8])
def test_trie_of_the_table(spark, block):
    df = ship(spark).read.parquet(f"{FOLDER}/conversations.parquet")
    turns = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    out = prefixes.prefix_trie(df, block)
    assert out.columns == list(prefixes.COLUMNS)
    assert in_order(out.collect()) == in_order(brute.prefix_nodes(turns))


@pytest.mark.parametrize("block", [prefixes.BLOCK, 8])
def test_trie_of_odd_rows(spark, block):
    turns = [(None, 0, "user", "nobody's"), (None, None, None, None),
             (0, None, None, None), (0, 0, "user", ""), (0, 1, "bot", "one two"), (0, 2, "user", "x"),
             (1, 0, "user", ""), (1, 0, "user", ""), (1, 5, None, "three"),
             (2, 0, "user", "a b\n c"), (7, 3, "user", "late"), (7, 1, "user", "early"),
             (25, 0, "u", "alone"), (26, 0, "u", "alone"), (27, None, "u", "alone"),
             (-3, 0, "u", "minus"), (40, 0, "user", "word " * 20_000)]
    for c in range(100, 160):
        turns += [(c, d, "user", f"turn {d if d < 30 else c % 3}") for d in range(40 if c % 2 else 3)]
    out = prefixes.prefix_trie(talk(spark, turns), block).collect()
    # A remainder keeps the sign of the number, in Spark as in SQL.
    want = brute.prefix_nodes(turns)
    assert in_order(out) == in_order(want)


def test_trie_of_copies(spark):
    rows = [(c, d, "user", f"turn {d}") for c in range(0, 3000, 20) for d in range(3)]
    out = in_order(prefixes.prefix_trie(talk(spark, rows)).collect())
    assert out == in_order(brute.prefix_nodes(rows)) and len(out) == 4


def test_trie_of_nothing(spark):
    assert prefixes.prefix_trie(talk(spark, [])).collect() == []
    with pytest.raises(ValueError):
        prefixes.prefix_trie(talk(spark, []), 7)
    assert prefixes.prefix_trie(talk(spark, [(None, 0, "user", "x")])).collect() == []


def test_blocks_bound_what_a_task_holds(spark):
    """However the sorted sequences are cut, two rows leave a block."""
    rows = [(c, d, "user", f"{c % (d + 2)}") for c in range(60) for d in range(5)]
    whole = prefixes.sequences(talk(spark, rows)).orderBy("path").toArrow()
    for low in range(0, whole.num_rows, 7):
        out = prefixes.peel(whole.slice(low, 7), False, False)
        assert len(out.column("path").drop_null()) <= 2


# -- 12 quality classifier -------------------------------------------------------------------------
def test_quality_of_held_out_documents(spark):
    df = queries.op12_quality_classifier(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = df.join(labels, "doc_id").filter("held_out").collect()
    for label in (0, 1):
        right = [r.predicted == label for r in rows if r.quality == label]
        assert len(right) >= 10 and np.mean(right) >= 0.9
    every = df.collect()
    assert len(every) == 1000 and df.columns == ["doc_id", "held_out", "score", "predicted"]
    for r in every:
        assert r.held_out == (brute.remainder(r.doc_id, 3) == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)


def plain_vector(text):
    """The same hashing, token by token."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    kinds = classifier._CLASS[data].tolist()
    cuts = [i for i in range(len(data)) if i == 0 or kinds[i] != kinds[i - 1]] + [len(data)]
    tokens = [data[a:b].tobytes() for a, b in zip(cuts, cuts[1:]) if kinds[a]]
    return tokens


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aB1 \n*é!", max_size=30)), min_size=1, max_size=6))
def test_features_do_not_depend_on_neighbours(texts):
    owner, place, value = classifier.features(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        _, alone, values = classifier.features(pa.array([t], pa.string()))
        assert place[owner == i].tolist() == alone.tolist()
        assert np.allclose(value[owner == i], values)
        tokens = plain_vector(t)
        pairs = {("again",) if a == b else (a, b) for a, b in zip(tokens, tokens[1:])}
        assert len(alone) == len(set(tokens)) + len(pairs)
        assert not tokens or np.isclose((values ** 2).sum(), 1)


def test_updates_lower_the_loss():
    """The closed form against the same updates on dense vectors."""
    rng = np.random.default_rng(0)
    leader = classifier.Leader()
    z, n = np.zeros(5), np.zeros(5)
    for _ in range(40):
        x, label = rng.normal(size=5), int(rng.integers(2))
        w = np.array([0.0 if abs(z[i]) <= leader.l1 else
                      -(z[i] - np.sign(z[i]) * leader.l1)
                      / ((leader.beta + n[i] ** 0.5) / leader.alpha + leader.l2) for i in range(5)])
        assert np.allclose(leader.weights(np.arange(5)), w)
        g = (1 / (1 + np.exp(-x @ w)) - label) * x
        z += g - ((n + g * g) ** 0.5 - n ** 0.5) / leader.alpha * w
        n += g * g
        leader.learn(np.arange(5), x, label)


def test_quality_of_odd_rows(spark):
    good, bad = "plain words in a row of their own", "BAD!! BAD!! BAD!! "
    docs = documents(spark, [(i, f"{good} number{i} and more") for i in range(30)] + [
        (100 + i, bad * (i + 2)) for i in range(30)] + [
        (None, None), (None, good), (500, None), (501, ""), (502, bad * 5000), (502, good), (502, good)])
    labels = spark.createDataFrame(
        [(i, 1, None) for i in range(30)] + [(100 + i, 0, "x") for i in range(30)] + [
            (0, 1, "again"), (None, 0, None), (500, None, None), (501, 7, None), (9999, 0, None)],
        "doc_id long, quality int, text string")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    rows = classifier.learn_and_score(docs, labels, held).collect()
    assert len(rows) == 67 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.doc_id < 100) for r in rows if r.doc_id is not None
               and r.doc_id < 500)
    assert [r.held_out for r in rows if r.doc_id is None] == [False, False]
    empty = [r.score for r in rows if r.doc_id in (500, 501)]
    assert len(set(empty)) == 1
    none = classifier.learn_and_score(docs, labels.limit(0), held).collect()
    assert {r.score for r in none} == {0.5}
    assert classifier.learn_and_score(docs.limit(0), labels, held).collect() == []


def test_the_sample_is_bounded_by_ids_and_by_texts(spark):
    docs = documents(spark, [(i % 40, f"text {i}") for i in range(400)])
    labels = spark.createDataFrame([(i % 40, i % 2) for i in range(4000)], "doc_id long, quality int")
    assert classifier._examples(docs, labels, 10).count() <= 40


# -- 13 alignment ----------------------------------------------------------------------------------
def encoders():
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    with open(A, encoding="utf-8") as f:
        pieces = {i: p for p, i in json.load(f)["model"]["vocab"].items()}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in plain} | {
        chr(256 + i): x for i, x in enumerate(sorted(set(range(256)) - set(plain)))}

    def with_a(text):
        return [(i, bytes(byte[c] for c in pieces[i]))
                for i in a.encode(text, add_special_tokens=False).ids]

    def with_b(text):
        return [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                 else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    return with_a, with_b


ODD = [(None, None), (None, "x y"), (1, ""), (2, " "), (3, "  a\n  b "), (4, "<|endoftext|> <s> hi"),
       (5, "a▁b and more"), (6, "naïve 🙂　x  y\x00 \x1c z"), (7, "word " * 3000),
       (7, "word " * 3000), (8, "x" * 5000), (9, "it's 1234 we'll\t\t go\n\n\nnow  "),
       (10, "中文文本 без пробелов"), (11, "\n"), (12, "a \n b\n c \r\n"), (13, "  q"), (14, "\u2581")]


@pytest.mark.parametrize("sent", [alignment.SENT_PAIRS, 10])
def test_alignment(spark, sent):
    docs = ship(spark).read.parquet(f"{FOLDER}/documents.parquet")
    for df in (docs, documents(spark, ODD)):
        out = alignment.align(df, A, B, sent).collect()
        want = brute.aligned([(r.doc_id, r.text) for r in df.collect()], *encoders())
        assert in_order(out) == in_order(want)
    assert alignment.align(docs.limit(0), A, B, sent).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.text("ab'1 \n\t\u3000é中▁.", max_size=25))
def test_units_are_encoded_on_their_own(text):
    with_a, with_b = encoders_once()
    units = alignment.units_of(text)
    assert "".join(" " + u for u in units) == " " + text
    if text and "▁" not in text:
        assert [x for u in units for x in with_a(" " + u)] == with_a(" " + text)
        blank = [(SentencePieceProcessor(model_file=B).piece_to_id("▁"), b" ")]
        assert [x for u in units for x in (with_b(u) if u else blank)] == with_b(text)


_once = []


def encoders_once():
    if not _once:
        _once.append(encoders())
    return _once[0]


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2**40), min_size=0, max_size=3000))
def test_perfect_hash(keys):
    keys = np.array(sorted(keys), dtype=np.int64)
    places = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
    assert sorted(places.numbers(keys).tolist()) == list(range(len(keys)))
    others = places.numbers(keys + (1 << 41))
    assert ((others >= -1) & (others < max(len(keys), 1))).all()


def test_segments_alike_for_column_and_array(spark):
    codes = np.random.default_rng(3).integers(0, 50257 * 32000, 2000)
    df = spark.createDataFrame([(int(c),) for c in codes], "pair long")
    there = [r[0] for r in df.select(alignment.segment_of(F.col("pair"), 7)).collect()]
    assert there == alignment.segment_of(codes, 7).tolist()
    assert min(np.bincount(there)) > 200


def test_memory_of_units_is_bounded():
    aligner = alignment.Aligner(alignment.TokenPair(A, B), remembered=50)
    many = " ".join(f"w{i}" for i in range(200))
    aligner.figures_of(["w1 w2"])
    first, _ = aligner.figures_of([many])
    again, _ = aligner.figures_of(["w1 w2", many])
    assert len(aligner.known) == 2 and (first[0] == again[1]).all()
    aligner.places([])
    assert len(aligner.groups) == 2 and len(aligner.pair_at) == 3
    assert aligner.pair_at[-1] == len(aligner.pairs)


def test_other_tokenizers_are_refused(tmp_path):
    with pytest.raises(ValueError):
        alignment.TokenPair(public_tokenizers.path("word_bpe_49k.json"), B)
