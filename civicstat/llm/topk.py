"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has one bit per dimension: 1 if the coordinate is above 0.
A code is cut into segments of about log2(n) bits, so that a value of a segment
belongs to a few codes at any size; no segment is more than a bit shorter than
another. If two codes differ in r = m * a + b bits (b < m, m segments), one of
the first b + 1 segments differs in at most a bits or else some segment in at
most a - 1. So after the search has probed all segments up to radius a, every
code within distance m * (a + 1) - 1 has been met. Radii grow from 0: a query is
done when its k-th neighbour lies within the covered distance, and asks a
segment only if that can still bring a code as near as the k-th.

Equal codes are one entry of the index with the ``k`` smallest ids, which
suffice, since ties go to the smaller id. Entries travel in packed blocks: a
cell holds those with the same high bits in a segment, in the order of the low
ones. Every round is a join of blocks of open queries with the cells that their
probes can reach; the probes and the codes they meet exist only inside a task,
which returns the nearest ones of each query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from civicstat.llm.common import brief_files, cut, prepare
from civicstat.llm.gramblocks import pack, unpack

K = 10
#: The queries are the rows whose id is a multiple of this.
EVERY = 100
#: Entries of a cell, about; a segment has at least 2^TILE_BITS cells.
CELL = 1 << 18
TILE_BITS = 3
#: Entries and queries packed at once, probes and codes met held at once by a task.
ENTRIES = 1 << 16
QUERIES = 1 << 16
HELD = 1 << 20
FOUND = "own binary, code binary, distance int, least bigint, copies int"


def packed_code(embedding: Column, dims: int) -> Column:
    """The code as bytes, eight for every 64 dimensions; missing, null and NaN
    coordinates count as 0 bits."""
    def bit(i: int) -> Column:
        x = F.get(embedding, F.lit(i))
        one = 1 << i % 64 if i % 64 < 63 else -1 << 63
        return F.when((x > 0) & ~F.isnan(x), F.lit(one).cast("long")).otherwise(F.lit(0).cast("long"))

    words = []
    for s in range(0, dims, 64):
        word = bit(s)
        for i in range(s + 1, min(s + 64, dims)):
            word = word.bitwiseOR(bit(i))
        words.append(F.unhex(F.lpad(F.hex(word), 16, "0")))
    return F.concat(*words)


def segment_bits(n: int) -> int:
    return min(30, max(8, (n - 1).bit_length()))


def masks(bits: int, radius: int) -> list[int]:
    """All ways to flip exactly ``radius`` of ``bits`` bits."""
    return [sum(1 << i for i in some) for some in combinations(range(bits), radius)]


@lru_cache(64)
def _flips(bits: int, radius: int) -> np.ndarray:
    return np.array(masks(bits, radius), np.int64)


def _words(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """(rows, words) of a column of codes."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, ">u8").astype(np.uint64).reshape(len(column), -(-dims // 64))


def _binary(words: np.ndarray) -> pa.Array:
    size = 8 * words.shape[1]
    offsets = np.arange(len(words) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(words.astype(">u8").tobytes())])


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of each run of equal values."""
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    return zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)]) if len(values) else iter(())


@dataclass
class Layout:
    """Segment s has the bits ends[s] to ends[s + 1]; its highest bits[s] bits
    name a tile, the rest are low bits. tiles[s]: the tiles with entries, their
    first cells and how many cells they are dealt to."""

    dims: int
    ends: list[int]
    bits: list[int]
    tiles: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    @property
    def m(self) -> int:
        return len(self.bits)

    def low(self, s: int) -> int:
        return self.ends[s + 1] - self.ends[s] - self.bits[s]

    def values(self, words: np.ndarray, s: int) -> np.ndarray:
        a, size = self.ends[s], self.ends[s + 1] - self.ends[s]
        w, shift = a // 64, a % 64
        out = words[:, w] >> np.uint64(shift)
        if shift + size > 64:
            out = out | words[:, w + 1] << np.uint64(64 - shift)
        return (out & np.uint64((1 << size) - 1)).astype(np.int64)

    def masked(self, words: np.ndarray, s: int) -> np.ndarray:
        """How many bits are set in the segment."""
        return np.bitwise_count(self.values(words, s))

    def cells(self, words: np.ndarray, s: int) -> np.ndarray:
        tile, first, parts = self.tiles[s]
        at = np.searchsorted(tile, self.values(words, s) >> self.low(s))
        mixed = (words * np.uint64(0x9E3779B97F4A7C15)).sum(axis=1, dtype=np.uint64) >> np.uint64(33)
        return first[at] + (mixed % parts[at].astype(np.uint64)).astype(np.int64)

    def place(self, cell: int) -> tuple[int, int]:
        """Segment and tile of a cell."""
        s = max(s for s in range(self.m) if self.tiles[s][1][0] <= cell)
        tile, first, _ = self.tiles[s]
        return s, int(tile[np.searchsorted(first, cell, side="right") - 1])


def layout(dims: int, n: int) -> Layout:
    """For ``n`` entries, still without tiles."""
    m = -(-dims // min(dims, segment_bits(n)))
    ends = [i * dims // m for i in range(m + 1)]
    tile = max(TILE_BITS, (n // CELL).bit_length())
    return Layout(dims, ends, [min(b - a, tile) for a, b in zip(ends, ends[1:])], [])


def tiled(entries: DataFrame, plan: Layout, n: int) -> Layout:
    """``plan`` with its tiles. A tile with far more than its share of the
    entries is dealt to several cells."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(1 << b, np.int64) for b in plan.bits]
        for b in batches:
            words = _words(b.column(0), plan.dims)
            for s in range(plan.m):
                sums[s] += np.bincount(plan.values(words, s) >> plan.low(s), minlength=len(sums[s]))
        for s, x in enumerate(sums):
            tile = np.flatnonzero(x)
            yield pa.RecordBatch.from_pydict({"segment": pa.array(np.full(len(tile), s, np.int32)), "tile": pa.array(tile), "n": pa.array(x[tile])})

    rows = (entries.select("code").mapInArrow(count, "segment int, tile bigint, n bigint")
            .groupBy("segment", "tile").agg(F.sum("n").alias("n")).orderBy("segment", "tile").collect())
    most, tiles, cells = 2 * min(CELL, max(1 << 12, n >> TILE_BITS)), [], 0
    for s in range(plan.m):
        own = [r for r in rows if r["segment"] == s]
        parts = np.array([-(-r["n"] // most) for r in own], np.int64)
        first = cells + np.cumsum(parts) - parts
        tiles.append((np.array([r["tile"] for r in own], np.int64), first, parts))
        cells += int(parts.sum())
    return Layout(plan.dims, plan.ends, plan.bits, tiles)


def index(entries: DataFrame, plan: Layout) -> DataFrame:
    """(cell, entries): one packed block for each cell, every entry in a cell of
    each segment."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _gathered(batches, ENTRIES):
            words = _words(t.column("code"), plan.dims)
            least, copies = (t.column(c).to_numpy() for c in ("least", "copies"))
            for s in range(plan.m):
                cell = plan.cells(words, s)
                order = np.argsort(cell, kind="stable")
                for a, b in _runs(cell[order]):
                    at = order[a:b]
                    yield pa.RecordBatch.from_pydict({"cell": pa.array([cell[at[0]]], pa.int32()), "entries": pa.array([pack(words[at], least[at], copies[at])], pa.binary())})

    def whole(cell: int, pieces: list[bytes]) -> pa.RecordBatch:
        words, least, copies = (np.concatenate(x) for x in zip(*map(unpack, pieces)))
        order = np.argsort(plan.values(words, plan.place(cell)[0]), kind="stable")
        return pa.RecordBatch.from_pydict({"cell": pa.array([cell], pa.int32()), "entries": pa.array([pack(words[order], least[order], copies[order])], pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for b in batches:
            for cell, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if held and cell != last:
                    yield whole(last, held)
                    held = []
                last = cell
                held.append(piece)
        if held:
            yield whole(last, held)

    block = "cell int, entries binary"
    pieces = entries.select("code", "least", "copies").mapInArrow(deal, block)
    return cut(pieces.repartition("cell").sortWithinPartitions("cell").mapInArrow(merge, block))


def probes(queries: DataFrame, plan: Layout, radius: int) -> DataFrame:
    """(cell, queries): the ``queries`` (own, bound) for whom a cell can hold
    codes that differ in ``radius`` bits of its segment, packed."""
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _gathered(batches, QUERIES):
            words, bound = _words(t.column("own"), plan.dims), t.column("bound").to_numpy()
            for s in range(plan.m):
                asks = np.flatnonzero(bound >= plan.m * radius + s)
                mine = plan.values(words[asks], s) >> plan.low(s)
                for tile, first, parts in zip(*(x.tolist() for x in plan.tiles[s])):
                    off = np.bitwise_count(mine ^ tile)
                    at = asks[(off <= radius) & (off >= radius - plan.low(s))]
                    if len(at):
                        block = pack(words[at], bound[at])
                        for cell in range(first, first + parts):
                            yield pa.RecordBatch.from_pydict({"cell": pa.array([cell], pa.int32()), "queries": pa.array([block], pa.binary())})

    return queries.mapInArrow(route, "cell int, queries binary")


class Cell:
    """The entries of a cell and where each value of the low bits begins."""

    def __init__(self, plan: Layout, cell: int, block: bytes) -> None:
        self.plan = plan
        self.segment, self.tile = plan.place(cell)
        self.words, self.least, self.copies = unpack(block)
        self.columns = [np.ascontiguousarray(c) for c in self.words.T]
        bits = plan.low(self.segment)
        low = plan.values(self.words, self.segment) & ((1 << bits) - 1)
        self.begin = np.searchsorted(low, np.arange((1 << bits) + 1))

    def search(self, words: np.ndarray, bound: np.ndarray, radius: int, k: int) -> Iterator[pa.RecordBatch]:
        """The ``k`` nearest entries of each query among those that differ in
        ``radius`` bits of the segment and are not farther than its bound,
        without those that another segment has shown before."""
        bits = self.plan.low(self.segment)
        value = self.plan.values(words, self.segment)
        rest = radius - np.bitwise_count((value >> bits) ^ self.tile).astype(int)
        low = value & ((1 << bits) - 1)
        for r in np.unique(rest).tolist():
            flips, rows = _flips(bits, r), np.flatnonzero(rest == r)
            step = max(1, HELD // len(flips))
            for i in range(0, len(rows), step):
                some = rows[i:i + step]
                at = low[some][:, None] ^ flips
                begin = self.begin[at]
                n = self.begin[at + 1] - begin
                ends, j = np.cumsum(n.sum(axis=1)), 0
                while j < len(some):
                    upto = max(j + 1, int(np.searchsorted(ends, (ends[j - 1] if j else 0) + HELD, side="right")))
                    yield from self.nearest(words, bound, some[j:upto], begin[j:upto], n[j:upto], radius, k)
                    j = upto

    def nearest(self, words: np.ndarray, bound: np.ndarray, rows: np.ndarray, begin: np.ndarray, n: np.ndarray,
                radius: int, k: int) -> Iterator[pa.RecordBatch]:
        """Of the queries ``rows``, which have met ``n`` entries from each of ``begin`` on."""
        who = np.repeat(rows, n.sum(axis=1))
        if not len(who):
            return
        n = n.ravel()
        at = np.repeat(begin.ravel() - (np.cumsum(n) - n), n)
        at += np.arange(len(at))
        distance = np.zeros(len(at), np.uint8 if self.plan.dims < 256 else np.int32)
        for w, column in enumerate(self.columns):
            distance += np.bitwise_count(column[at] ^ words[:, w][who])
        near = np.flatnonzero(distance <= bound[who])
        who, at, distance = who[near], at[near], distance[near]
        differ, first = words[who] ^ self.words[at], np.ones(len(at), bool)
        for s in range(self.plan.m):
            if s != self.segment:
                first &= self.plan.masked(differ, s) >= radius + (s < self.segment)
        who, at, distance = who[first], at[first], distance[first]
        order = np.lexsort((self.least[at], distance, who))
        who = who[order]
        starts = np.flatnonzero(np.diff(who, prepend=-1))
        kept = np.arange(len(who)) - np.repeat(starts, np.diff(starts, append=len(who))) < k
        who, order = who[kept], order[kept]
        if len(order):
            at = at[order]
            yield pa.RecordBatch.from_pydict({
                "own": _binary(words[who]), "code": _binary(self.words[at]), "distance": pa.array(distance[order].astype(np.int32)),
                "least": pa.array(self.least[at]), "copies": pa.array(self.copies[at])})


def met(asked: DataFrame, cells: DataFrame, plan: Layout, radius: int, k: int) -> DataFrame:
    """The ``k`` nearest entries of a cell for each query that asks it."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, cell = None, None
        for b in batches:
            for at, queries, entries in zip(b.column("cell").to_pylist(), b.column("queries"), b.column("entries")):
                if at != last:
                    last, cell = at, Cell(plan, at, entries.as_py())
                words, bound = unpack(queries.as_py())
                yield from cell.search(words, bound, radius, k)

    # both sides grow with the data, and a plan cannot tell how large the blocks are
    return asked.hint("merge").join(cells, "cell").select("cell", "queries", "entries").mapInArrow(search, FOUND)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, distance): the ``k`` rows of ``vectors`` (vec_id,
    embedding) nearest to each row of ``queries`` (vec_id, embedding) by Hamming
    distance of codes, ties to the smaller id. A query's own id is left out.

    Rows without id or embedding are in no result; the number of dimensions is
    that of the longest embedding. Repeated ids are one vector if their codes
    agree and otherwise one for each code. Fewer than k other vectors: all of
    them. Empty tables give no row; other columns are ignored.
    """
    spark = vectors.sparkSession
    prepare(spark)
    with brief_files(spark):
        known = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL")
        dims = known.agg(F.max(F.size("embedding"))).head()[0] or 1
        rows = known.select("vec_id", packed_code(F.col("embedding"), dims).alias("code")).distinct()
        asked = cut(queries.where("vec_id IS NOT NULL AND embedding IS NOT NULL")
                    .select(F.col("vec_id").alias("query_id"), packed_code(F.col("embedding"), dims).alias("own")).distinct())
        # k + 1 ids of a code, as one of them may be the query itself
        nth = F.row_number().over(Window.partitionBy("code").orderBy("vec_id"))
        entries = (rows.withColumn("nth", nth).where(F.col("nth") <= k + 1)
                   .groupBy("code").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("copies", F.size("ids")))
        least = F.get("ids", F.lit(0))
        if isinstance(vectors.schema["vec_id"].dataType, IntegralType):
            entries = cut(entries.withColumn("least", least.cast("long")))
        else:  # numbers in the order of the ids
            entries = cut(cut(entries).orderBy(least).withColumn("least", F.monotonically_increasing_id()))
        n = entries.count()
        plan = tiled(entries, layout(dims, n), n)
        cells = index(entries, plan)

        # a row of distance -1 stands for the query itself
        owns = asked.select("own").distinct()
        found = owns.select("own", F.lit(None).cast("binary").alias("code"), F.lit(-1).alias("distance"),
                            F.lit(None).cast("long").alias("least"), F.lit(1).alias("copies"))
        open_queries, radius, done = owns.withColumn("bound", F.lit(dims)), 0, found.where("distance >= 0")
        while left := open_queries.count():
            some = open_queries.repartition(max(4, -(-left // QUERIES)))
            new = met(probes(some, plan, radius), cells, plan, radius, k + 1)
            # k + 1 entries in the order of their smallest ids hold the k nearest vectors
            near = Window.partitionBy("own").orderBy("distance", "least", "code")
            state = found.unionByName(new).withColumn("r", F.row_number().over(near)).where(F.col("r") <= k + 2)
            # that far are k + 1 entries, or k ids even if every entry has the query's own
            others = F.sum(F.col("copies") - 1).over(near.rowsBetween(Window.unboundedPreceding, Window.currentRow))
            bound = F.min(F.when((F.col("r") > k + 1) | (F.col("others") >= k), F.col("distance"))).over(Window.partitionBy("own"))
            state = cut(state.withColumn("others", others).withColumn("bound", F.coalesce(bound, F.lit(dims))).drop("r", "others"))
            radius += 1
            open_ = F.col("bound") >= plan.m * radius
            done = done.unionByName(state.where(~open_ & (F.col("distance") >= 0)).drop("bound"))
            found = state.where(open_).drop("bound")
            open_queries = state.where(open_ & (F.col("distance") < 0)).select("own", "bound")

        best = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "least", "code"))
        nearest = (asked.join(done, "own").select("query_id", "code", "distance", "least").distinct()
                   .withColumn("r", best).where(F.col("r") <= k + 1))
        ids = (nearest.hint("merge").join(entries.select("code", "ids"), "code")
               .select("query_id", "distance", F.explode("ids").alias("vec_id")).where(F.col("vec_id") != F.col("query_id")))
        place = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id"))
        return cut(ids.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "distance"))


def topk_digest(embeddings: DataFrame) -> DataFrame:
    rows = embeddings.select("vec_id", "embedding")
    return top_k(rows, rows.where(F.col("vec_id") % EVERY == 0))


SQL = r"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 AND NOT isnan(x) THEN 1 ELSE 0 END) AS code
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
p AS (
  SELECT q.vec_id AS query_id, v.vec_id,
    CAST(list_sum(list_transform(list_zip(q.code, v.code), lambda z: CASE WHEN z[1] = z[2] THEN 0 ELSE 1 END)) AS INTEGER) AS distance
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank,
    vec_id, distance FROM p)
SELECT * FROM r WHERE rank <= 10
"""
