"""Prefix trie of conversations, screened by a count-min sketch of prefix digests.

A node of the trie is a distinct sequence of first turns, known by a chained
digest of 128 bits. Every prefix of every conversation is counted in a
count-min sketch. A count-min estimate is never too low, so an estimate of one
proves that a prefix belongs to one conversation: these tails need no grouping
and are emitted where they are. Only prefixes with an estimate of two or more
are shuffled by digest and grouped exactly; a sketch with many collisions
costs shuffled rows, never a wrong node.

Sums over subtrees need no walk through the levels. The conversation with the
smallest id of a node stands for it. It stands for a contiguous range of its
own prefixes, down to its end, because members only get fewer with depth. With
``behind`` the number of a conversation's prefixes that others stand for::

    children of v     = members of v that go on and have behind <= depth(v)
    leaves under v    = members of v that stand for the node they end in, if
                        no other member of that node goes on
    saved under v     = bytes of the members' turns from depth(v) to behind

so every figure is a sum over the members of a node, which collapses in the
tasks before it is shuffled.

Texts are never shuffled, only their digests and lengths.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicstat.llm.common import cut, prepare

#: Conversations of one block share the turns of the block's first one.
BLOCK = 5
MOST_SHARED = 9
ROOT = bytes(16)

#: The sketch: rows of counters, each a power of two wide. A counter stops at 2.
SKETCH_ROWS = 4
MOST_WIDTH = 1 << 24
PIECE = 1 << 16
#: Ends of a node are joined to text in pieces of ids with equal higher bits.
ID_BITS = 12

_PREFIX = "conv_id long, depth long, node binary, up binary, bytes long, upto long, ends boolean"
_ARROW = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("up", pa.binary()),
                    ("bytes", pa.int64()), ("upto", pa.int64()), ("ends", pa.bool_())])


def shared_turns(conv_id: int) -> int:
    """How many first turns a conversation takes from the first one of its block."""
    return zlib.crc32(str(conv_id).encode()) % MOST_SHARED


class _Chain:
    """Follows one conversation after another and collects their prefixes."""

    def __init__(self) -> None:
        self.rows: list[list] = []
        self.last: list | None = None

    def open(self, conv_id: int) -> None:
        self.close()
        self.last = [conv_id, 0, ROOT, None, 0, 0, False]

    def add(self, digest: bytes, size: int) -> None:
        conv_id, depth, node, _, _, upto, _ = last = self.last
        if depth:
            self.rows.append(last)
        below = hashlib.sha256(node + digest).digest()[:16]
        self.last = [conv_id, depth + 1, below, node, size, upto + size, False]

    def close(self) -> None:
        """A conversation without a turn leaves one row of depth 0."""
        if self.last:
            self.last[-1] = True
            self.rows.append(self.last)
            self.last = None

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows)) if rows else [()] * len(_ARROW)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def rebuilt_prefixes(conversations: DataFrame) -> DataFrame:
    """Every prefix of every rebuilt conversation: conv_id, depth, node, up (the
    node above), bytes (of the last text), upto (bytes so far), ends.

    Digests of turns are dealt by block and pass through a task in order, the
    block's first conversation ahead; the task keeps its first eight digests
    and one turn at a time.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    c = F.col("conv_id").cast("long")
    turns = conversations.where(c.isNotNull()).select(
        (c - c % BLOCK).alias("base"), c.alias("conv_id"), "turn",
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    dealt = turns.repartition("base").sortWithinPartitions(
        "base", F.col("conv_id") != F.col("base"), "conv_id", "turn", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, of, first, now, nth, skip = _Chain(), None, [], None, 0, 0
        for batch in batches:
            for base, conv_id, digest, size in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if conv_id != now:
                    if base != of:
                        of, first = base, []
                    now, nth = conv_id, 0
                    chain.open(conv_id)
                    skip = 0 if conv_id == base else shared_turns(conv_id)
                    for turn in first[:skip]:
                        chain.add(*turn)
                if conv_id == base and nth < MOST_SHARED - 1:
                    first.append((digest, size))
                if nth >= skip:
                    chain.add(digest, size)
                nth += 1
            yield chain.take()
        chain.close()
        yield chain.take()

    return dealt.select("base", "conv_id", "digest", "bytes").mapInArrow(run, _PREFIX)


def _words(nodes: pa.Array) -> np.ndarray:
    """The four 32-bit words of each digest."""
    return np.frombuffer(b"".join(nodes.to_pylist()), np.uint32).reshape(-1, SKETCH_ROWS)


def _pack(cells: np.ndarray) -> bytes:
    return zlib.compress(cells.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.uint8)


def sketch_width(prefixes: int, most: int = MOST_WIDTH) -> int:
    """Four counters for each prefix in each row, as far as ``most`` allows."""
    return min(most, max(1 << 12, 1 << (4 * max(prefixes, 1) - 1).bit_length()))


def sketch(prefixes: DataFrame, width: int) -> list[tuple[int, bytes]]:
    """The count-min sketch of column ``node``, in packed pieces.

    Every task counts its own rows and sends the pieces that it touched; they
    are added up piece by piece. The driver gets SKETCH_ROWS * width bytes at
    most, before packing.
    """
    size = min(PIECE, width)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(SKETCH_ROWS * width, np.uint8)
        for batch in batches:
            if batch.num_rows:
                at = (_words(batch.column(0)) & np.uint32(width - 1)) + np.arange(SKETCH_ROWS) * width
                at, n = np.unique(at, return_counts=True)
                cells[at] = np.minimum(cells[at] + np.minimum(n, 2), 2)
        used = cells.reshape(-1, size)
        for i in np.flatnonzero(used.any(axis=1)).tolist():
            yield pa.RecordBatch.from_pydict({"piece": pa.array([i], pa.int32()), "cells": pa.array([_pack(used[i])], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"piece": pa.array([now], pa.int32()), "cells": pa.array([_pack(total)], pa.binary())})

        now, total = None, None
        for batch in batches:
            for piece, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if piece != now:
                    if now is not None:
                        yield done()
                    now, total = piece, np.zeros(size, np.uint8)
                total = np.minimum(total + _unpack(cells), 2)
        if now is not None:
            yield done()

    parts = prefixes.where("depth > 0").select("node").mapInArrow(count, "piece int, cells binary")
    sums = parts.repartition("piece").sortWithinPartitions("piece").mapInArrow(add, "piece int, cells binary")
    return [(r["piece"], bytes(r["cells"])) for r in sums.collect()]


@lru_cache(maxsize=1)
def _table(pieces: tuple[tuple[int, bytes], ...], width: int) -> np.ndarray:
    """Once in each worker."""
    out = np.zeros((SKETCH_ROWS * width // min(PIECE, width), min(PIECE, width)), np.uint8)
    for i, data in pieces:
        out[i] = _unpack(data)
    return out.reshape(SKETCH_ROWS, width)


def screen(prefixes: DataFrame, most_width: int = MOST_WIDTH) -> DataFrame:
    """``prefixes`` with ``shared`` (the estimate is two or more) and ``head``
    (proven single below a prefix that may be shared)."""
    width = sketch_width(prefixes.count(), most_width)
    pieces = prefixes.sparkSession.sparkContext.broadcast(tuple(sketch(prefixes, width)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(pieces.value, width)

        def often(nodes: pa.Array) -> np.ndarray:
            at = _words(nodes) & np.uint32(width - 1)
            return np.min([table[i, at[:, i]] for i in range(SKETCH_ROWS)], axis=0) > 1

        for b in batches:
            if b.num_rows:
                depth = b.column(1).to_numpy()
                own = (depth > 0) & often(b.column(2))
                above = (depth > 1) & often(b.column(3).fill_null(ROOT))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own), pa.array(above & ~own)],
                                                 [*b.schema.names, "shared", "head"])

    return prefixes.mapInArrow(run, f"{_PREFIX}, shared boolean, head boolean")


def ends_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of rows (node, conv_id): the digest of the ids in
    numerical order, joined by commas.

    Ids are joined in pieces of at most 2 ** ID_BITS; then one pass over a
    node's pieces in order takes the digest, which by its definition reads them
    one after another, and keeps nothing but its state.
    """
    pieces = (ends.groupBy("node", F.shiftright("conv_id", ID_BITS).alias("piece"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(found: list[tuple[bytes, str]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.string())],
                                              ["node", "ends_sha256"])

        now, state = None, None
        for b in batches:
            found = []
            for node, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if node == now:
                    state.update(b"," + ids.encode())
                else:
                    if now is not None:
                        found.append((now, state.hexdigest()))
                    now, state = node, hashlib.sha256(ids.encode())
            yield batch(found)
        if now is not None:
            yield batch([(now, state.hexdigest())])

    return (pieces.repartition("node").sortWithinPartitions("node", "piece").select("node", "ids")
            .mapInArrow(run, "node binary, ends_sha256 string"))


_NONE = hashlib.sha256(b"").hexdigest()


def _digest_of(conv_id: Column, ends: Column) -> Column:
    return F.when(ends, F.sha2(conv_id.cast("string").cast("binary"), 256)).otherwise(F.lit(_NONE))


def prefix_trie(conversations: DataFrame, most_width: int = MOST_WIDTH) -> DataFrame:
    """One row per node of the trie of the rebuilt ``conversations`` (conv_id,
    turn, role, text): conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    Turns go by ``turn``, null first, and equal turns by the digest of role and
    text; repeated rows are repeated turns. Null roles and texts count as empty
    and are turns all the same. Rows without conv_id belong to no conversation
    and are left out; an empty table gives no row, not even a root. A
    conversation that keeps no turn is a member of the root only. Other
    columns are ignored. Very long texts count with their digest; the turns of
    one conversation pass through one task as digests, one at a time.
    """
    spark = conversations.sparkSession
    prepare(spark)
    turns = conversations.select("conv_id", "turn", "role", "text")
    rows = cut(screen(cut(rebuilt_prefixes(turns)), most_width))
    every = rows.agg(F.min("conv_id").alias("least"), F.count_if("ends").alias("n"),
                     F.count_if(F.col("depth") == 0).alias("turnless")).head()

    shared = rows.where("shared")
    groups = shared.groupBy("node").agg(F.min("conv_id").alias("least"), F.count("*").alias("n"), F.count_if("ends").alias("n_ends"))
    known = shared.join(groups, "node").withColumn("mine", F.col("least") == F.col("conv_id"))
    heads = rows.where("head").withColumns({"least": F.col("conv_id"), "n": F.lit(1).cast("long"),
                                            "n_ends": F.col("ends").cast("long"), "mine": F.lit(True)})
    own = Window.partitionBy("conv_id")
    other = ~F.col("mine")
    leaf = F.col("mine") & (F.col("n") == F.col("n_ends"))
    told = known.unionByName(heads).withColumns({
        "behind": F.count_if(other).over(own),
        "attach": F.max(F.when(other, F.col("least"))).over(own),
        "covered": F.max(F.when(other, F.col("upto"))).over(own),
        # the end is a leaf of its own unless it may be shared
        "leaf": F.coalesce(F.max(F.when(F.col("shared") & F.col("ends"), leaf.cast("int"))).over(own), F.lit(1))})
    parent = (F.when(F.col("depth") == 1, F.lit(every["least"]))
              .when(F.col("behind") == F.col("depth") - 1, F.col("attach")).otherwise(F.col("conv_id")))
    told = cut(told.withColumn("parent", parent))
    d = F.col("depth")
    sums = told.where("shared").groupBy("node").agg(
        F.min("least").alias("conv_id"), F.min(d).alias("depth"),
        F.max(F.when(F.col("mine"), F.col("parent"))).alias("parent_conv_id"),
        F.count("*").alias("n_convs"),
        F.count_if(~F.col("ends") & (F.col("behind") <= d)).alias("n_children"),
        F.sum(F.col("leaf").cast("long")).alias("n_leaves"),
        F.sum(F.when(d <= F.col("behind"), F.col("covered") - F.col("upto") + F.col("bytes")).otherwise(F.lit(0))).alias("saved_tokens"))
    ended = ends_digests(rows.where("ends AND shared").select("node", "conv_id"))
    digest = F.coalesce("ends_sha256", F.lit(_NONE)).alias("ends_sha256")
    figures = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    nodes = cut(sums.join(ended, "node", "left").select(*figures, digest))

    def single(of: DataFrame, above: Column) -> DataFrame:
        return of.select("conv_id", "depth", above.alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
                         (~F.col("ends")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
                         F.lit(0).cast("long").alias("saved_tokens"), _digest_of(F.col("conv_id"), F.col("ends")).alias("ends_sha256"))

    tails = single(rows.where("NOT shared AND NOT head AND depth > 0"),
                   F.when(d == 1, F.lit(every["least"])).otherwise(F.col("conv_id")))
    below = nodes.unionByName(single(told.where("NOT shared"), F.col("parent"))).unionByName(tails)
    # the root sums up the nodes of depth 1
    top = nodes.unionByName(tails).where("depth = 1").agg(
        F.count("*").alias("n_children"), F.coalesce(F.sum("n_leaves"), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum("saved_tokens"), F.lit(0)).cast("long").alias("saved_tokens"))
    if not every["n"]:
        return below
    here = ends_digests(rows.where("depth = 0").select("node", "conv_id")).head() if every["turnless"] else None
    root = top.select(
        F.lit(every["least"]).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"), F.lit(every["n"]).cast("long").alias("n_convs"),
        "n_children", "n_leaves", "saved_tokens", F.lit(here["ends_sha256"] if here else _NONE).alias("ends_sha256"))
    return below.unionByName(root)


def trie_digest(conversations: DataFrame) -> DataFrame:
    return prefix_trie(conversations)


SQL = r"""
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS c, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x,
    strlen(coalesce(text, '')) AS b FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, x) AS p FROM t),
ids AS (
  SELECT c, c - c % 5 AS base, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(8 * length(c::VARCHAR)),
        lambda i: CASE WHEN i % 8 = 0 THEN ascii(substr(c::VARCHAR, CAST(i // 8 AS INTEGER) + 1, 1)) ELSE 0 END::BIGINT)),
      lambda a, y: xor(xor(a, y) >> 1, (xor(a, y) & 1) * 3988292384)), 4294967295::BIGINT) % 9 AS h
  FROM (SELECT DISTINCT c FROM t)),
r AS (
  SELECT ids.c, o.p, o.x, o.b FROM ids JOIN o ON o.c = ids.base AND o.p <= ids.h
  UNION ALL SELECT ids.c, o.p, o.x, o.b FROM ids JOIN o ON o.c = ids.c AND o.p > ids.h),
s AS (
  SELECT c, b, row_number() OVER w AS d, string_agg(x, '') OVER w AS path,
    row_number() OVER w = count(*) OVER (PARTITION BY c) AS ends
  FROM r WINDOW w AS (PARTITION BY c ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
m AS (
  SELECT c, 0 AS b, 0 AS d, '' AS path, c NOT IN (SELECT c FROM s) AS ends FROM ids
  UNION ALL SELECT * FROM s),
n AS (
  SELECT path, d, min(c) AS conv_id, any_value(b) AS b, count(*) AS n_convs,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM m GROUP BY path, d),
k AS (SELECT substr(path, 1, 64 * (CAST(d AS INTEGER) - 1)) AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON n.path = k.path),
u AS (
  SELECT substr(path, 1, 64 * CAST(up AS INTEGER)) AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
    sum((n_convs - 1) * b) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM f) GROUP BY 1)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, a.conv_id AS parent_conv_id, f.n_convs, f.n_children,
  u.n_leaves, CAST(u.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN u ON f.path = u.path
LEFT JOIN n AS a ON f.d > 0 AND a.path = substr(f.path, 1, 64 * (CAST(f.d AS INTEGER) - 1))
"""
