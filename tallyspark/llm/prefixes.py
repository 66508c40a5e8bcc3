"""The trie of conversation prefixes, by truncation peeling.

Each distinct sequence of turns is a row whose path is one fixed-width digest a turn, sorted by path
in ranges. A task peels a block of rows from the greatest depth up: the nodes left over from the
depth below lose their last turn, join the sequences that end here, and are regrouped; a depth's
nodes are found and aggregated in the same step. Only the nodes on a block's first and last path can
have members in other blocks. They leave the block as two rows of partial aggregates, which the next
round peels again, until one block holds them all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.session import stage_table

WIDTH = 32
WORD = r"[^\x20\x09-\x0D]+"
#: Every conversation of a family of this many opens with turns of the family's first one.
FAMILY = 20
#: Sequences that one step peels together.
BLOCK = 4096
NOTHING = hashlib.sha256(b"").hexdigest()
_JOINED = 1 << 16

_NODE = pa.struct([(n, pa.int64()) for n in (
    "depth", "n", "conv_id", "children", "leaves", "saved")] + [("ends", pa.string())])
_OUT = pa.schema([(n, pa.int64()) for n in (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")] + [
        ("ends_sha256", pa.string()), ("key", pa.string()), ("parent_key", pa.string()),
        ("path", pa.string()), ("words", pa.list_(pa.int32())), ("nodes", pa.list_(_NODE))])
OUT_DDL = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
           "n_leaves long, saved_tokens long, ends_sha256 string, key string, parent_key string, "
           "path string, words array<int>, nodes array<struct<depth: long, n: long, conv_id: long, "
           "children: long, leaves: long, saved: long, ends: string>>")


def own_turns(conversations: DataFrame) -> DataFrame:
    """conv_id and its ``turns`` (digest of role and text, words) by turn, null first.

    Turns that share a number are ordered by their digest, so repeated rows follow each other.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
                                .cast("binary"), 256), 1, WIDTH)
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.struct(
            F.col("turn").cast("long").alias("turn"), digest.alias("digest"),
            F.regexp_count(text, F.lit(WORD)).alias("words")).alias("t"))
    return turns.groupBy("conv_id").agg(F.transform(
        F.sort_array(F.collect_list("t")),
        lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))


def opening(conv_id: Column) -> Column:
    """How many turns of its family's first conversation a conversation opens with: 0 to 3."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 4).cast("int")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, path, words: the turns with the opening taken from conversation c - c % FAMILY."""
    own = stage_table(own_turns(conversations), "turns")
    bases = own.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("base_id"), F.slice("turns", 1, 3).alias("base"))
    h = opening(F.col("conv_id"))
    both = own.join(bases, F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("base_id"), "left")
    turns = F.when(h == 0, F.col("turns")).otherwise(F.concat(
        F.coalesce(F.slice("base", F.lit(1), F.greatest(h, F.lit(1))), F.slice("turns", 1, 0)),
        F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))))
    return both.select("conv_id", turns.alias("turns")).select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t["digest"]), "").alias("path"),
        F.transform("turns", lambda t: t["words"]).alias("words"))


def _joined(rows: DataFrame) -> DataFrame:
    """path_id and the SHA-256 of its conv_ids, ascending, joined by commas.

    Ids are sorted in ranges, so that no task holds all of one path; the pieces of text that a range
    makes of them are hashed in order as they stream by.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path_id").to_pylist()
            ids = batch.column("conv_id").to_pylist()
            cuts = [i for i in range(len(ids)) if i == 0 or paths[i] != paths[i - 1]
                    or i % _JOINED == 0] + [len(ids)]
            parts = list(zip(cuts, cuts[1:]))
            yield pa.RecordBatch.from_arrays([
                pa.array([paths[a] for a, _ in parts], pa.string()),
                pa.array([ids[a] for a, _ in parts], pa.int64()),
                pa.array([",".join(map(str, ids[a:b])) for a, b in parts], pa.string())],
                names=["path_id", "conv_id", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, done = None, None, []
        for batch in batches:
            for path, ids in zip(batch.column("path_id").to_pylist(),
                                 batch.column("ids").to_pylist()):
                if path == at:
                    state.update(b"," + ids.encode())
                    continue
                if state:
                    done.append((at, state.hexdigest()))
                at, state = path, hashlib.sha256(ids.encode())
            if done:
                yield _pairs(done)
                done = []
        if state:
            yield _pairs([(at, state.hexdigest())])

    def _pairs(found):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.string()) for c in zip(*found)], names=["path_id", "ends"])

    texts = rows.repartitionByRange("path_id", "conv_id").sortWithinPartitions(
        "path_id", "conv_id").mapInArrow(pieces, "path_id string, conv_id long, ids string")
    return texts.repartition("path_id").sortWithinPartitions("path_id", "conv_id").mapInArrow(
        digests, "path_id string, ends string")


def sequences(conversations: DataFrame) -> DataFrame:
    """Each distinct rebuilt sequence once: path, words, and its end as a partial node."""
    whole = stage_table(rebuilt(conversations), "rebuilt").withColumn(
        "path_id", F.sha2(F.col("path"), 256))
    ended = whole.groupBy("path_id").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("first_id"))
    ends = _joined(whole.select("path_id", "conv_id"))
    # A conversation has one path, so its id alone finds the row, however many share the path.
    ones = whole.drop("path_id").join(ended.join(ends, "path_id"),
                                      F.col("conv_id") == F.col("first_id"))
    zero = F.lit(0).cast("long")
    node = F.struct(
        (F.length("path") / WIDTH).cast("long").alias("depth"), F.col("n"), F.col("conv_id"),
        zero.alias("children"), zero.alias("leaves"), zero.alias("saved"),
        F.col("ends"))
    return ones.select("path", "words", F.array(node).alias("nodes"))


def _shared_turns(paths: list[bytes]) -> np.ndarray:
    """How many turns each path shares with the one before it; -1 for the first."""
    out = np.full(len(paths), -1, dtype=np.int64)
    for i in range(1, len(paths)):
        a, b = paths[i - 1], paths[i]
        least = min(len(a), len(b))
        if a[:least] == b[:least]:
            out[i] = least // WIDTH
        else:
            x, y = (np.frombuffer(p, np.uint8, least) for p in (a, b))
            out[i] = int(np.argmax(x != y)) // WIDTH
    return out


def _keys(path: bytes, wanted: set[int]) -> dict[int, str]:
    """A digest of the path's first d turns, for each wanted d."""
    out, state = {}, hashlib.sha256()
    for d in range(len(path) // WIDTH + 1):
        if d:
            state.update(path[(d - 1) * WIDTH:d * WIDTH])
        if d in wanted:
            out[d] = state.hexdigest()
    return out


def peel(table: pa.Table, last: bool, keyed: bool) -> pa.RecordBatch:
    """Peel one block of rows sorted by path; see the module's head.

    Without ``last``, the nodes on the first and last path stay open. ``keyed`` gives closed nodes
    the key by which children closed in an earlier round find them.
    """
    paths = [p.encode() for p in table.column("path").to_pylist()]
    words = table.column("words").combine_chunks()
    word_at, word_of = words.offsets.to_numpy(), words.values.to_numpy(zero_copy_only=False)
    nodes = table.column("nodes").combine_chunks()
    counts = np.diff(nodes.offsets.to_numpy())
    first = nodes.offsets.to_numpy()[0]
    fields = nodes.values.slice(first, int(counts.sum()))
    row = np.repeat(np.arange(len(paths)), counts)
    field = {f.name: fields.field(f.name) for f in _NODE}
    ends = np.array(field.pop("ends").to_pylist(), dtype=object)
    part = {k: v.to_numpy(zero_copy_only=False).astype(np.int64) for k, v in field.items()}
    by_depth = np.argsort(part["depth"], kind="stable")
    shared = _shared_turns(paths)

    closed: list[tuple] = []
    open_nodes: dict[int, list[dict]] = {0: [], len(paths) - 1: []}
    carry = {k: np.zeros(0, np.int64) for k in ("rep", "n", "conv_id", "leaves", "saved")}
    held: list[tuple] = []
    wanted: dict[int, set[int]] = {}
    high = len(by_depth)
    for depth in range(int(part["depth"].max(initial=0)), -1, -1):
        low = int(np.searchsorted(part["depth"][by_depth], depth))
        here, high = by_depth[low:high], low
        rep = np.concatenate([carry["rep"], row[here]])
        order = np.argsort(rep, kind="stable")
        group = np.cumsum(shared < depth)
        at = group[rep[order]]
        starts = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else at
        place = np.searchsorted(at[starts], group[rep])

        def total(name, above, how=np.add):
            return how.reduceat(np.concatenate([above, part[name][here]])[order], starts)

        n, conv = total("n", carry["n"]), total("conv_id", carry["conv_id"], np.minimum)
        children = total("children", np.ones(len(carry["rep"]), np.int64))
        leaves, saved = total("leaves", carry["leaves"]), total("saved", carry["saved"])
        ended: list[str | None] = [None] * len(starts)
        for p, e in zip(place[len(carry["rep"]):], ends[here]):
            if e is not None:
                ended[p] = e
        reps = rep[order][starts]
        edge = (at[starts] == group[0]) | (at[starts] == group[-1])
        opened = np.zeros(len(starts), bool) if last else edge

        for child, p in zip(held, place[:len(carry["rep"])]):
            up = int(reps[p])
            if opened[p]:
                wanted.setdefault(up, set()).add(depth)
                closed.append((*child, None, (up, depth)))
            else:
                closed.append((*child, int(conv[p]), None))
        held = []
        for i in np.flatnonzero(opened):
            side = 0 if at[starts[i]] == group[0] else len(paths) - 1
            open_nodes[side].append({
                "depth": depth, "n": int(n[i]), "conv_id": int(conv[i]),
                "children": int(children[i]), "leaves": int(leaves[i]), "saved": int(saved[i]),
                "ends": ended[i]})
        shut = np.flatnonzero(~opened)
        leaves = np.where(children == 0, 1, leaves)
        if depth:
            saved = saved + (n - 1) * word_of[word_at[reps] + depth - 1].astype(np.int64)
        for i in shut:
            up = int(reps[i])
            if keyed:
                wanted.setdefault(up, set()).add(depth)
            held.append((int(conv[i]), depth, int(n[i]), int(children[i]), int(leaves[i]),
                         int(saved[i]), ended[i] or NOTHING, (up, depth) if keyed else None))
        carry = {"rep": reps[shut], "n": n[shut], "conv_id": conv[shut], "leaves": leaves[shut],
                 "saved": saved[shut]}
    closed += [(*root, None, None) for root in held]

    keys = {r: _keys(paths[r], ds) for r, ds in wanted.items()}
    out = [{"conv_id": c, "depth": d, "parent_conv_id": up, "n_convs": n, "n_children": k,
            "n_leaves": v, "saved_tokens": s, "ends_sha256": e,
            "key": keys[own[0]][own[1]] if own else None,
            "parent_key": keys[over[0]][over[1]] if over else None}
           for c, d, n, k, v, s, e, own, up, over in closed]
    for side, found in open_nodes.items():
        if found:
            out.append({"path": paths[side].decode(), "nodes": found,
                        "words": word_of[word_at[side]:word_at[side + 1]].tolist()})
    return pa.RecordBatch.from_pylist(out, schema=_OUT)


def _peeled(rows: DataFrame, block: int, last: bool, keyed: bool) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            for i in range(0, batch.num_rows, block):
                piece = batch.slice(i, block)
                if not last and waiting and size + piece.num_rows > block:
                    yield peel(pa.Table.from_batches(waiting), last, keyed)
                    waiting, size = [], 0
                waiting.append(piece)
                size += piece.num_rows
        if size:
            yield peel(pa.Table.from_batches(waiting), last, keyed)

    return rows.sortWithinPartitions("path").mapInArrow(task, OUT_DDL)


def prefix_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each distinct sequence of first turns of the rebuilt conversations.

    Takes conv_id, turn, role and text; other columns are not read. Rows without a conv_id belong to
    no conversation. A null turn comes first, a null role or text is empty, texts of any length are
    hashed whole; turns that share a number are ordered by their hash, repeated rows are turns of
    their own. A conversation without turns ends at the root. An empty table has no conversation and
    gives no rows. A conversation's path takes some 40 bytes a turn in one row; all else is bounded
    by ``block`` and the depth. Returns the columns of ``COLUMNS``. ``block`` is at least 8, so that
    every round leaves fewer rows.
    """
    if block < 8:
        raise ValueError("a block has at least 8 rows")
    rows = sequences(conversations).repartitionByRange("path")
    done, keyed = None, False
    while True:
        found = stage_table(_peeled(rows, block, False, keyed), "peeled")
        nodes = found.filter("path IS NULL").drop("path", "words", "nodes")
        done = nodes if done is None else done.unionByName(nodes)
        rest = found.filter("path IS NOT NULL").select("path", "words", "nodes")
        left, keyed = rest.count(), True
        if left <= block:
            break
        rows = rest.repartitionByRange(left // block + 1, "path")
    top = stage_table(_peeled(rest.coalesce(1), block, True, True), "peeled").drop(
        "path", "words", "nodes")
    done = done.unionByName(top)
    parents = done.filter("key IS NOT NULL").select(
        F.col("key").alias("up_key"), F.col("conv_id").alias("up"))
    settled = done.filter("parent_key IS NULL")
    waiting = done.filter("parent_key IS NOT NULL").join(
        parents, F.col("parent_key") == F.col("up_key"), "left").withColumn("parent_conv_id",
                                                                            F.col("up"))
    return settled.select(*COLUMNS).unionByName(waiting.select(*COLUMNS))


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256")
