"""Findings of the third review."""

import numpy as np
from pyspark.sql import functions as F

from tallyspark.llm import candidates, scoring


def test_training_takes_every_triple_however_rare():
    """One context is a millionth of the corpus: draws by frequency would hardly ever meet it."""
    s = scoring.Settings(frequent=4, suffixes=1, steps=300)
    k = s.classes
    far, near, right, n = [], [], [], []
    for a in range(3):
        for b in range(3):
            far, near, right, n = far + [a], near + [b], right + [(a + b) % 3], n + [10 ** 8]
    far, near, right, n = far + [5], near + [6], right + [4], n + [900]
    code = (np.asarray(far) * k + np.asarray(near)) * k + np.asarray(right)
    order = np.argsort(code)
    table = scoring.train(code[order], np.asarray(n)[order], s)
    assert table[5, 6, 4] > -1
    assert np.array_equal(table, scoring.train(code[order], np.asarray(n)[order], s))


def test_endings_are_counted_over_all_words(spark):
    """Many rare words share an ending that no word of the head has."""
    counts = spark.createDataFrame(
        [("the", 100), ("lo", 9), ("hello", 8)] + [(f"w{i}xy", 1) for i in range(50)],
        "word string, n long")
    s = scoring.Settings(frequent=1, suffixes=1, head=3)
    head = scoring.head_of(counts, s.head)
    classes = scoring.classes_of(counts, head, s)
    assert classes.frequent == ["the"] and classes.suffixes == ["xy"]
    numbers = scoring.WordNumbers(head, classes)
    got = counts.select("word", classes.column(F.col("word")).alias("c")).collect()
    assert all(classes.of(r.word.encode()) == r.c for r in got if r.word != "the")
    assert numbers[b"w7xy"] == len(head) + classes.first


def test_members_of_resolved_buckets_meet_no_join(spark):
    """Two large buckets and a small one: only the bucket of two components is read again."""
    n = candidates.SMALL + 4
    nodes = spark.range(2 * n).withColumnRenamed("id", "key")
    joined = spark.range(2 * n - 1).selectExpr("id AS node", f"IF(id < {n}, 0L, {n}L) AS component")
    bands = candidates.with_component(nodes, joined).withColumn(
        "bucket", F.floor(F.col("key") / n)).unionByName(spark.createDataFrame(
            [(0, 0, 7), (n, n, 7)], "key long, component long, bucket long"))
    got = candidates.unresolved(bands)
    assert sorted(map(tuple, got.select("bucket", "key").collect())) == [
        (1, k) for k in range(n, 2 * n)]
