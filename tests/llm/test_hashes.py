"""Hashes of spans and windows: what must differ differs, wherever it stands."""

import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402

from tallyspark.llm import batches, neardups, quality  # noqa: E402
from tallyspark.llm.shipping import ship  # noqa: E402


def thue_morse(size):
    """Two strings over two letters that agree in every polynomial hash modulo a power of two."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(size))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_regular_strings_differ():
    for size in (64, 512, 1024, 2048, 4096):
        data = np.frombuffer("".join(thue_morse(size)).encode(), np.uint8)
        first, second = batches.span_hashes(data, np.array([0, size]), np.array([size, 2 * size]))
        assert first != second


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=600), min_size=1, max_size=30), st.integers(0, 9))
def test_equal_spans_and_only_they_have_equal_hashes(spans, shift):
    data = np.frombuffer(b"?" * shift + b"".join(spans) + b"?", np.uint8)
    ends = np.cumsum([len(s) for s in spans]) + shift
    hashes = batches.span_hashes(data, ends - np.array([len(s) for s in spans]), ends)
    known = {}
    for s, h in zip(spans, hashes.tolist()):
        assert known.setdefault(h, s) == s
    assert len(known) == len(set(spans))


def test_windows_depend_on_order():
    words = np.arange(40, dtype=np.uint64) % 7
    hashes = batches.window_hashes(words, 5)
    windows = [tuple(words[i:i + 5].tolist()) for i in range(36)]
    assert len(set(hashes.tolist())) == len(set(windows))
    assert batches.window_hashes(words[:3], 5).tolist() == []


def test_two_long_lines_are_no_repetition():
    text = "\n".join(thue_morse(2048))
    batch = pa.record_batch([pa.array([text])], names=["text"])
    assert brute.quality(text)[3] == 0
    data, at = batches.flat(batch.column("text"))
    heads = np.array([0, 2049])
    assert len(set(batches.span_hashes(data, heads, np.array([2048, 4097])).tolist())) == 2


def test_documents_of_long_words_are_not_linked(spark):
    one, other = thue_morse(2048)
    docs = ship(spark).createDataFrame(
        [(1, f"a b c d {one}"), (2, f"a b c d {other}"), (3, f"a b c d {one}")],
        "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in neardups.near_duplicates(docs).collect()}
    assert found == {1: 1, 2: 2, 3: 1}
    judged = {r.doc_id: r.n_dup_lines for r in quality.judge(ship(spark).createDataFrame(
        [(1, f"{one}\n{other}", "en"), (2, f"{one}\n{one}", "en")],
        "doc_id long, text string, lang string")).collect()}
    assert judged == {1: 0, 2: 1}
