"""Candidate pairs from buckets, and the exact way for buckets too large to be paired."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.components import components
from tallyspark.session import stage_table

#: Buckets up to this size are compared pair by pair.
SMALL = 16
#: Sets in a block, and distinct items in a matrix, where blocks are compared in full.
BLOCK = 256
COLUMNS = 1 << 15
#: The most rows of a small table that is broadcast; beyond it, the join is shuffled.
BROADCAST_ROWS = 500_000


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, to be broadcast if it has at most ``rows`` rows. Its rows are counted first."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def bucket_pairs(bands: DataFrame) -> DataFrame:
    """a, b: pairs of keys that share a bucket (bucket, key, next_one, next_two).

    All pairs of a small bucket. Members of a large one meet its least member, and the least of
    those that agree with them in ``next_one`` too and in both; ``unresolved`` finds what that may
    leave open.
    """
    sizes = stage_table(bands.groupBy("bucket").agg(
        F.count("*").alias("size"), F.min("key").alias("hub"), F.max("key").alias("last"))
        .filter("size > 1"), "buckets")
    two = sizes.filter("size = 2").select(F.col("hub").alias("a"), F.col("last").alias("b"))
    more = sizes.filter("size > 2").select("bucket", "size", "hub")
    members = stage_table(bands.join(small_enough(more), "bucket"), "members")
    small = members.filter(F.col("size") <= SMALL).select("bucket", "key")
    out = two.unionByName(small.select("bucket", F.col("key").alias("a")).join(
        small.select("bucket", F.col("key").alias("b")), "bucket").filter("a < b")
        .select("a", "b"))
    large = members.filter(F.col("size") > SMALL)
    out = out.unionByName(large.select(F.col("hub").alias("a"), F.col("key").alias("b")))
    for extra in (["next_one"], ["next_one", "next_two"]):
        hubs = large.groupBy("bucket", *extra).agg(F.min("key").alias("a"))
        out = out.unionByName(large.select("bucket", *extra, F.col("key").alias("b")).join(
            hubs, ["bucket", *extra]).select("a", "b"))
    return out.filter("a <> b").distinct()


def with_component(nodes: DataFrame, joined: DataFrame) -> DataFrame:
    """``nodes`` (key and more) with their component in ``joined``; a node of none is its own."""
    return nodes.join(joined, nodes["key"] == joined["node"], "left").select(
        *[nodes[c] for c in nodes.columns], F.coalesce("component", "key").alias("component"))


def unresolved(bands: DataFrame) -> DataFrame:
    """bucket, key: members of the large buckets whose members lie in several components, from
    ``bands`` (bucket, key, component). Members of resolved buckets are met by no join."""
    several = bands.groupBy("bucket").agg(
        F.count("*").alias("size"), F.min("component").alias("x"),
        F.max("component").alias("y")).filter((F.col("size") > SMALL) & (F.col("x") != F.col("y")))
    several = stage_table(several.select("bucket"), "several")
    return bands.select("bucket", "key").join(small_enough(several), "bucket", "left_semi")


def clusters(members: DataFrame) -> DataFrame:
    """key, cluster of ``members`` (bucket, key): buckets that share a key are of one cluster."""
    hubs = members.groupBy("bucket").agg(F.min("key").alias("a"))
    links = members.join(small_enough(hubs), "bucket").select("a", F.col("key").alias("b"))
    return components(links).select(F.col("node").alias("key"),
                                    F.col("component").alias("cluster"))


def _shared(items: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many items each set of ``left`` shares with each of ``right`` (numbers of sets)."""
    owner = np.repeat(np.arange(len(items)), [len(x) for x in items])
    _, number = np.unique(np.concatenate(items), return_inverse=True)
    order = np.argsort(number, kind="stable")
    number, owner = number[order], owner[order]
    total = np.zeros((len(left), len(right)), dtype=np.float32)
    for start in range(0, int(number[-1]) + 1, COLUMNS):
        here = slice(*np.searchsorted(number, (start, start + COLUMNS)))
        has = np.zeros((len(items), COLUMNS), dtype=np.float32)
        has[owner[here], number[here] - start] = 1
        total += has[left] @ has[right].T
    return total


def in_blocks(sets: DataFrame, cluster: DataFrame, joined: DataFrame, block: int) -> DataFrame:
    """key, cluster, items, component, own, low, high: ``sets`` (key, items) dealt into blocks (own)
    of about ``block`` of a cluster, once for each two blocks (low, high) that are to meet."""
    sizes = cluster.groupBy("cluster").agg(
        F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    placed = sets.join(cluster.join(small_enough(sizes), "cluster"), "key")
    placed = placed.join(joined, placed["key"] == joined["node"], "left").select(
        "key", "cluster", "items", "blocks", F.coalesce("component", "key").alias("component"),
        F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("own"))
    return placed.select("*", F.explode(F.sequence(
        F.lit(0), F.col("blocks") - 1)).alias("other")).select(
            "key", "cluster", "items", "component", "own",
            F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))


def alike_within(sets: DataFrame, cluster: DataFrame, joined: DataFrame,
                 percent: int) -> DataFrame:
    """a, b: every two of ``sets`` (key, items) of one cluster (key, cluster) that are alike and
    not joined yet (node, component).

    A cluster is cut into blocks of about ``BLOCK`` sets, and each two blocks meet in a task that
    compares all their full sets as matrices and returns the links alone.
    """
    def task(table):
        if not table.num_rows:
            return table.select(["key", "key"]).rename_columns(["a", "b"])
        key, component, own = (table.column(c).to_numpy() for c in ("key", "component", "own"))
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        items = [np.asarray(x, dtype=np.int64) for x in table.column("items").to_pylist()]
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        size = np.asarray([len(x) for x in items], dtype=float)
        both = _shared(items, left, right)
        alike = 100 * both >= percent * (size[left][:, None] + size[right][None, :] - both)
        alike &= component[left][:, None] != component[right][None, :]
        i, j = np.nonzero(alike)
        one, two = key[left[i]], key[right[j]]
        return pa.table({"a": np.minimum(one, two), "b": np.maximum(one, two)})

    return in_blocks(sets, cluster, joined, BLOCK).groupBy("cluster", "low", "high").applyInArrow(
        task, "a long, b long").distinct()
