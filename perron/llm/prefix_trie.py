"""Trie of conversation prefixes from sorted shards, with the trie of the splitter paths as skeleton.

A conversation's path is the row of its turns' codes. Paths are range-partitioned by
(path, conv_id) at splitters that are conversations themselves. A node whose members
lie on both sides of a splitter is a prefix of that splitter's path, so the trie of the
splitter paths (the skeleton, broadcast with a checked size) holds every node that more
than one shard sees. A shard, sorted, finishes all its other nodes with one stack and
gives partial aggregates of the skeleton's; those are summed by node, and carried up
the skeleton once.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perron.llm.tables import saved, task_count

CODE_BYTES = 16
# A shard's nodes are held by one task: some 300 bytes a turn.
SHARD_TURNS = 100_000
# Splitter paths that every task gets, and the part of one path that may serve as splitter.
SKELETON_BYTES = 16_000_000
SPLITTER_CODES = 4096

NODE_SCHEMA = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, "
    "ends_sha256 string, skeleton int, above int, shard int, bytes bigint, piece binary"
)
NAMES = [field.split()[0] for field in NODE_SCHEMA.split(", ")]


def conversation_paths(rows: DataFrame) -> DataFrame:
    """(conv_id, codes, sizes): per conversation its turns in order, as codes and as UTF-8 bytes of their texts.

    ``rows`` has conv_id, turn, role, text. Turns go by turn (null first), ties by role,
    then by code; null roles and texts are empty; repeated rows are turns of their own.
    A code is 128 bits of the SHA-256 of role and text, as 32 hex digits: among 10**12
    different turns, two share one with a probability below 10**-14. Texts are not shuffled.
    Rows without a conv_id belong to no conversation and are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    code = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turn = F.struct("turn", role.alias("role"), F.substring(code, 1, 2 * CODE_BYTES).alias("code"), F.octet_length(text).cast("long").alias("bytes"))
    turns = rows.filter("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("t"))
    turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return turns.select("conv_id", F.transform("ts", lambda t: t["code"]).alias("codes"), F.transform("ts", lambda t: t["bytes"]).alias("sizes"))


def with_borrowed_heads(paths: DataFrame, base: Column, head: Column, longest: int) -> DataFrame:
    """Paths whose first ``head`` turns come from the conversation ``base``, followed by the own turns after ``head``.

    ``head`` is at most ``longest``. A base that is shorter gives all it has, one that
    does not exist gives nothing. A base's turns are joined to those that name it, not collected.
    """
    own = saved(paths.withColumns({"base": base, "head": head.cast("int")}), "trie-paths")
    heads = own.select(F.col("conv_id").alias("base"), F.slice("codes", 1, longest).alias("head_codes"), F.slice("sizes", 1, longest).alias("head_sizes"))

    def rebuilt(name: str) -> Column:
        borrowed = F.slice(f"head_{name}", 1, F.col("head"))
        rest = F.slice(name, F.col("head") + 1, F.greatest(F.size(name) - F.col("head"), F.lit(0)))
        return F.when(F.col("head_codes").isNull(), rest).otherwise(F.concat(borrowed, rest)).alias(name)

    return own.join(heads, "base", "left").select("conv_id", rebuilt("codes"), rebuilt("sizes"))


def _splitters(paths: DataFrame, shard_turns: int) -> list[tuple[bytes, int]]:
    """Sorted (path, conv_id) of conversations drawn by a hash of their id, with a chance in proportion to their turns.

    About one per ``shard_turns``; fewer if their paths exceed ``SKELETON_BYTES``. Each path
    is cut behind the first code that tells it from both neighbours.
    """
    chance = F.pmod(F.xxhash64("conv_id"), F.lit(1 << 30)) / (1 << 30)
    while True:
        drawn = paths.filter(chance * shard_turns < F.size("sizes")).select(F.substring("path", 1, CODE_BYTES * SPLITTER_CODES).alias("path"), "conv_id")
        if (drawn.agg(F.sum(F.length("path") + 8)).first()[0] or 0) <= SKELETON_BYTES:
            break
        shard_turns *= 2
    rows = sorted((bytes(r["path"]), r["conv_id"]) for r in drawn.collect())
    shared = [0] + [_common(a[0], b[0]) for a, b in zip(rows, rows[1:])] + [0]
    out = []
    for (path, conv), before, after in zip(rows, shared, shared[1:]):
        needed = CODE_BYTES * (max(before, after) + 1)
        # a cut path stands before all that begin with it
        out.append((path[:needed], conv if len(path) <= needed else -(1 << 63)))
    return out


def _common(a: bytes, b: bytes) -> int:
    """The number of codes that two paths begin with alike."""
    most = min(len(a), len(b)) // CODE_BYTES
    if a[: most * CODE_BYTES] == b[: most * CODE_BYTES]:
        return most
    depth = 0
    while a[depth * CODE_BYTES : (depth + 1) * CODE_BYTES] == b[depth * CODE_BYTES : (depth + 1) * CODE_BYTES]:
        depth += 1
    return depth


class Skeleton:
    """The trie of the splitter paths; nodes are numbered in preorder, the root is 0."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent, self.depth = [-1], [0]
        for path, _ in splitters:
            node = 0
            for at in range(0, len(path), CODE_BYTES):
                key = (node, path[at : at + CODE_BYTES])
                if key not in self.child:
                    self.child[key] = len(self.parent)
                    self.parent.append(node)
                    self.depth.append(at // CODE_BYTES + 1)
                node = self.child[key]


class _Open:
    """A node on the way from the root to the current path."""

    __slots__ = ("skeleton", "conv", "convs", "children", "leaves", "saved", "bytes", "ends", "rows")

    def __init__(self, skeleton: int, size: int):
        self.skeleton, self.bytes = skeleton, size
        self.conv: int | None = None
        self.convs = self.children = self.leaves = self.saved = 0
        self.ends: list[int] = []
        self.rows: list[list] = []  # its finished children, which still lack the parent's conv_id


class _Shard:
    """One shard's stack and finished nodes; paths come sorted."""

    def __init__(self, shard: int, child: dict[tuple[int, bytes], int]):
        self.shard, self.child = shard, child
        self.path = b""
        self.stack = [_Open(0, 0)]
        self.out: list[list] = []

    def add(self, path: bytes, conv: int, sizes: list[int]) -> None:
        common = _common(self.path, path)
        while len(self.stack) > common + 1:
            self._close()
        for depth in range(common, len(path) // CODE_BYTES):
            above = self.stack[-1].skeleton
            code = path[depth * CODE_BYTES : (depth + 1) * CODE_BYTES]
            self.stack.append(_Open(self.child.get((above, code), -1) if above >= 0 else -1, sizes[depth]))
        top = self.stack[-1]
        top.ends.append(conv)
        top.convs += 1
        top.conv = conv if top.conv is None else min(top.conv, conv)
        self.path = path

    def _close(self) -> None:
        node = self.stack.pop()
        depth = len(self.stack)
        ends = ",".join(map(str, node.ends)).encode()
        for row in node.rows:
            if node.skeleton >= 0:
                row[9] = node.skeleton
            else:
                row[2] = node.conv
        if node.skeleton >= 0:
            self.out.append([node.conv, depth, None, node.convs, node.children, node.leaves, node.saved, None, node.skeleton, None, self.shard, node.bytes, ends or None])
        else:
            leaves = node.leaves if node.children else 1
            spared = node.saved + (node.convs - 1) * node.bytes
            row = [node.conv, depth, None, node.convs, node.children, leaves, spared, hashlib.sha256(ends).hexdigest(), None, None, self.shard, node.bytes, None]
            self.out.append(row)
        if not self.stack:
            return
        above = self.stack[-1]
        above.convs += node.convs
        above.conv = node.conv if above.conv is None else min(above.conv, node.conv)
        if node.skeleton < 0:
            above.children += 1
            above.leaves += leaves
            above.saved += spared
            above.rows.append(row)

    def finished(self) -> Iterator[pa.RecordBatch]:
        while self.stack:
            self._close()
        schema = pa.schema([(n, {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t]) for n, t in (f.split() for f in NODE_SCHEMA.split(", "))])
        for at in range(0, len(self.out), 10_000):
            columns = zip(*self.out[at : at + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def _local_nodes(placed: DataFrame, child: dict[tuple[int, bytes], int]) -> DataFrame:
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for batch in batches:
            for shard, path, conv, sizes in zip(*(batch.column(n).to_pylist() for n in ("shard", "path", "conv_id", "sizes"))):
                if current is None or current.shard != shard:
                    if current:
                        yield from current.finished()
                    current = _Shard(shard, child)
                current.add(path, conv, sizes)
        if current:
            yield from current.finished()

    return placed.mapInArrow(shards, NODE_SCHEMA)


def _joined_digests(pieces: DataFrame) -> DataFrame:
    """(skeleton, ends_sha256) of the pieces of each node, in the order of shards; a task streams them and holds one."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, hashlib.sha256()
        for batch in batches:
            for now, piece in zip(batch.column("skeleton").to_pylist(), batch.column("piece").to_pylist()):
                if now != node:
                    if node is not None:
                        yield one(node, digest)
                    node, digest = now, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(piece)
        if node is not None:
            yield one(node, digest)

    def one(node: int, digest) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.int32()), pa.array([digest.hexdigest()])], names=["skeleton", "ends_sha256"])

    dealt = pieces.repartition(task_count(pieces.sparkSession), "skeleton").sortWithinPartitions("skeleton", "shard")
    return dealt.select("skeleton", "piece").mapInArrow(digests, "skeleton int, ends_sha256 string")


def _reduced(partials: DataFrame, skeleton: Skeleton) -> DataFrame:
    """The skeleton's nodes from the shards' partial aggregates: summed by node, then carried up by preorder ranges.

    At most SKELETON_BYTES / CODE_BYTES rows reach the driver.
    """
    sums = partials.groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("bytes").alias("bytes"),
    )
    got = sums.toArrow().sort_by("skeleton")
    number = got.column("skeleton").to_numpy()
    conv, convs, children, leaves, spared, size = (got.column(c).to_numpy().astype(np.int64) for c in ("conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "bytes"))
    # a prefix of a conversation's path has that conversation as member, so every number is there
    assert len(number) == len(skeleton.parent) and (number == np.arange(len(number))).all()
    parent, depth = np.array(skeleton.parent), np.array(skeleton.depth)
    inner = np.bincount(parent[1:], minlength=len(parent))
    leaves += (children + inner) == 0
    spared += (convs - 1) * size
    # preorder: a subtree is the run of deeper nodes behind its top
    last = np.arange(1, len(parent) + 1)
    for node in range(len(parent) - 1, 0, -1):
        last[parent[node]] = max(last[parent[node]], last[node])
    below = [np.concatenate([[0], np.cumsum(x)]) for x in (leaves, spared)]
    leaves, spared = (b[last] - b[:-1] for b in below)
    above = np.where(parent >= 0, conv[np.maximum(parent, 0)], -1)
    table = pa.table(
        {
            "skeleton": pa.array(number, pa.int32()),
            "conv_id": conv,
            "depth": depth,
            "parent_conv_id": pa.array(above, pa.int64(), mask=parent < 0),
            "n_convs": convs,
            "n_children": children + inner,
            "n_leaves": leaves,
            "saved_tokens": spared,
        }
    )
    return partials.sparkSession.createDataFrame(table)


def prefix_nodes(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per distinct prefix of the ``paths`` (conv_id, codes, sizes), the empty one included.

    conv_id is the smallest member (a conversation that begins with the prefix), depth its
    length, parent_conv_id the parent's conv_id (null for the root), n_convs the members,
    n_children the longer prefixes by one turn, n_leaves the childless nodes of the subtree,
    saved_tokens the sum over the subtree of (n_convs - 1) times the bytes of the last turn,
    ends_sha256 the SHA-256 of the conv_ids that end here, ascending and comma-joined.
    Paths may be empty; those end at the root. conv_ids should be unique and not null, as
    :func:`conversation_paths` gives them. No paths, no rows. Results do not depend on ``shard_turns``.

    A group of equal paths is split by conv_id like any other. One conversation's path must fit a
    row (16 bytes a turn); a splitter uses its first 4096 turns.
    """
    stored = saved(paths.select(F.unhex(F.array_join("codes", "")).alias("path"), "conv_id", "sizes"), "trie-rebuilt")
    if not stored.head(1):
        return stored.sparkSession.createDataFrame([], ", ".join(NODE_SCHEMA.split(", ")[:8]))
    splitters = _splitters(stored, shard_turns)
    skeleton = Skeleton(splitters)
    child = skeleton.child

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())
            shard = pa.array([bisect_right(splitters, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([shard, *batch.columns], names=["shard", *batch.schema.names])

    dealt = stored.mapInArrow(placed, "shard int, path binary, conv_id bigint, sizes array<bigint>")
    dealt = dealt.repartition(task_count(stored.sparkSession), "shard").sortWithinPartitions("shard", "path", "conv_id")
    nodes = saved(_local_nodes(dealt, child), "trie-nodes")
    partials = nodes.filter("skeleton is not null")
    tops = saved(_reduced(partials, skeleton), "trie-skeleton")
    digests = _joined_digests(partials.filter("piece is not null"))
    whole = tops.join(digests, "skeleton", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    # at most SKELETON_BYTES / CODE_BYTES rows of 12 bytes
    above = F.broadcast(tops.select(F.col("skeleton").alias("above"), F.col("conv_id").alias("above_conv_id")))
    rest = nodes.filter("skeleton is null").join(above, "above", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above_conv_id"))
    return rest.select(*NAMES[:8]).unionByName(whole.select(*NAMES[:8]))
