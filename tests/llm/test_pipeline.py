"""The pipeline's stages, the registered queries, and the library without this subpackage."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tallyspark.llm import queries
from verify import normal

FOLDER = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stage_table(stage(spark, before, FOLDER), name)
        assert after.columns == columns and after.dtypes == docs.dtypes
        assert after.join(before, "doc_id", "left_anti").isEmpty()
        assert after.filter(F.length("text") != F.col("n_chars")).isEmpty()
        if name == "language_id":
            assert after.count() >= 0.98 * before.count()
        before = after
    texts = {r.doc_id: r.text for r in before.collect()}
    lines = [x for t in texts.values() for x in t.split("\n") if len(x.encode()) >= 24]
    assert len(lines) == len(set(lines))
    packed = corpus_pipeline.pack(spark, before, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(texts)


def test_stages_take_odd_rows(spark):
    text = "Some words that anybody would want to keep, and a token = abcdefgh12345678 too."
    docs = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", None, "s", 0), (2, text, "en", None, 5),
         (3, text, "en", "s", 5), (4, "12 34", "en", "s", 5), (5, "x" * 50_000, "en", "s", 5)],
        "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage_table(stage(spark, docs, FOLDER), name)
    left = {r.doc_id: r.text for r in docs.collect()}
    assert set(left) == {2, 5} and left[2].endswith("a [secret] too.")
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, FOLDER)
        assert empty.count() == 0


def test_near_dedup_judges_each_row(spark):
    same = " ".join(f"word{i}" for i in range(60))
    near, other = same + " end", " ".join(f"other{i}" for i in range(60))
    alone = " ".join(f"alone{i}" for i in range(60))
    rows = [(1, same, "b"), (1, same, "a"), (1, near, "a"), (2, near, "a"), (2, other, "a"),
            (None, same, "a"), (None, other + " end", "a"), (None, alone, "a"),
            (None, alone, "a"), (None, alone + " end", "a"), (3, "", "a"), (3, "", "a")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_dedup(spark, docs, FOLDER)
    assert out.columns == docs.columns
    left = [(r.doc_id, r.text, r.source) for r in out.collect()]
    ones = [x for x in left if x[0] == 1]
    assert len(left) == 5 and ones in ([(1, same, "a")], [(1, near, "a")])
    assert (2, other, "a") in left and left.count((3, "", "a")) == 2
    assert [x[1] for x in left if x[0] is None][0] in (alone, alone + " end")


def test_each_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for table in ("pages", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = queries.QUERIES[name](spark, FOLDER)
    cursor = db.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in cursor.description]
    found = cursor.fetchall()
    assert sorted(names) == sorted(df.columns) and found
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(found, names)


def test_the_rest_works_without_this_subpackage(tmp_path):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(
        "llm", "corpus_pipeline.py", ".git", "__pycache__", "spark-warehouse"))
    out = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), "
         "any(n.startswith('op') for n in e.queries()), 'pipeline' in e.queries())"],
        cwd=copy, capture_output=True, text=True, timeout=120)
    assert out.stdout.split()[1:] == ["False", "False"], out.stderr
