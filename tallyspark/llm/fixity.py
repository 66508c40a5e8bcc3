"""Merkle fixity audit of WARC replicas.

Records lie in files at offsets. Their hashes, in offset order, make the hash of a range of
offsets, ranges that of a file, files that of a group of files, up to one root. An audit compares
two replicas' roots and then only the children of nodes that differ, down to the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.candidates import small_enough
from tallyspark.llm.ordering import ordinals
from tallyspark.session import stage_table

RANGE_BYTES = 1 << 16
FILES_BITS = 6


def warc_record(page_id: Column, url: Column, payload: Column) -> Column:
    """The text of a resource record. Nulls count as empty."""
    payload = F.coalesce(payload, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"), payload, F.lit("\r\n\r\n"))


def layout(records: DataFrame, *by: str, per_file: int = 1000) -> DataFrame:
    """``records`` (with length) with file and offset: ``per_file`` records to a file, in order.

    Rows that tie in all columns of ``by`` take places in an order of no account.
    """
    placed = ordinals(records, *by).withColumn(
        "file", F.floor(F.col("ordinal") / per_file).cast("long"))
    earlier = Window.partitionBy("file").orderBy("ordinal").rowsBetween(
        Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).drop(
        "ordinal")


def _node(children: DataFrame, key: list[str], order: str) -> DataFrame:
    """The hash of each parent over its children's places and hashes, in order. A parent has few
    children: a range what fits its bytes, a file its records, a group its files."""
    parts = F.transform(F.sort_array(F.collect_list(F.struct(order, "hash"))),
                        lambda c: F.concat_ws(":", c[order].cast("string"), c["hash"]))
    return children.groupBy(*key).agg(F.sha2(F.array_join(parts, "\n"), 256).alias("hash"))


def tree(records: DataFrame, groupings: int) -> list[tuple[list[str], DataFrame]]:
    """The tree's levels from the records (file, offset, length, digest) up, each as its key and a
    written table with ``hash``; the last has the root alone."""
    base = records.select("file", "offset", F.concat_ws(":", F.col("length").cast("string"),
                                                        "digest").alias("hash"),
                          F.floor(F.col("offset") / RANGE_BYTES).cast("long").alias("range"))
    levels = [(["file", "range", "offset"], stage_table(base, "records"))]
    levels.append((["file", "range"], stage_table(
        _node(levels[0][1], ["file", "range"], "offset"), "ranges")))
    level = stage_table(_node(levels[1][1], ["file"], "range"), "files")
    levels.append((["file"], level))
    for i in range(groupings):
        parent, child = f"group{i + 1}", f"group{i}" if i else "file"
        level = level.withColumn(parent, F.shiftright(child, FILES_BITS))
        levels[-1] = (levels[-1][0], level)
        level = stage_table(_node(level, [parent], child), "groups")
        levels.append(([parent], level))
    return levels


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Where two replicas differ: file, offset, state and both records' length and digest.

    ``primary`` and ``replica`` have a row for each record: file, offset, length, digest. State is
    changed, lost (the replica has no record there) or extra (only the replica has). Of equal
    replicas, or two empty ones, the roots are compared and nothing else; the result is empty. An
    offset in a file is a place of its own, so that one lost record moves no other.
    """
    files = [df.agg(F.max("file")).first()[0] for df in (primary, replica)]
    top = max((f for f in files if f is not None), default=0)
    groupings = 1
    while top >> (FILES_BITS * groupings):
        groupings += 1
    ours, theirs = tree(primary, groupings), tree(replica, groupings)
    differing = None
    for depth in range(len(ours) - 1, -1, -1):
        key, parent = ours[depth][0], ours[depth + 1][0] if depth + 1 < len(ours) else None
        sides = []
        for (_, df), name in ((ours[depth], "hash"), (theirs[depth], "replica_hash")):
            if parent:
                df = df.join(small_enough(differing.select(*parent)), parent, "left_semi")
            sides.append(df.select(*key, F.col("hash").alias(name)))
        differing = stage_table(sides[0].join(sides[1], key, "full").filter(
            ~F.col("hash").eqNullSafe(F.col("replica_hash"))), "differing")
        if depth and differing.isEmpty():
            break
    else:
        return _faults(differing)
    empty = ours[0][1].limit(0).select("file", "range", "offset", "hash").withColumn(
        "replica_hash", F.col("hash"))
    return _faults(empty)


def _faults(records: DataFrame) -> DataFrame:
    state = F.when(F.col("replica_hash").isNull(), "lost").when(
        F.col("hash").isNull(), "extra").otherwise("changed")

    def half(name, part):
        return F.substring_index(name, ":", part)

    return records.select(
        "file", "offset", state.alias("state"),
        half("hash", 1).cast("long").alias("length"), half("hash", -1).alias("digest"),
        half("replica_hash", 1).cast("long").alias("replica_length"),
        half("replica_hash", -1).alias("replica_digest"))
