"""Byte-level BPE by overlapping chunks.

A text longer than ``chunk`` code points is cut into chunks that overlap by
``2 * overlap``. All chunks are pre-tokenised in parallel, each from its own
first character. Two neighbours may disagree where a chunk begins inside a
pre-token, but from the first boundary that both have, and while neither
looks beyond its end, matching the pattern goes on alike. The stitch step
takes the earlier chunk's boundaries up to such a common boundary and the
later chunk's from there. Without a common boundary (one pre-token longer
than the overlap) it matches on from the last boundary that holds until it
meets the later chunk. The pieces between the boundaries are then merged by
rank; decoding joins the bytes of the ids.
"""

from __future__ import annotations

import base64
import heapq
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicstat.llm.common import fresh, prepare, small_batches

CHUNK = 32_768
OVERLAP = 512
#: Pieces that one worker keeps with their ids.
CACHE = 1 << 18
#: Bytes of text whose pieces are held at once.
SLICE = 1 << 20
#: Bytes above which a piece is merged by a heap.
LONG_PIECE = 128


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def long_merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank merges first, the
    leftmost of equals; by a heap of pairs over linked parts."""
    n = len(piece)
    end, prev, following, alive = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, e = heapq.heappop(heap)
        j = following[i] if alive[i] else n
        if j >= n or end[j] != e:
            continue  # one of the two parts has changed since
        end[i], alive[j], following[i] = e, False, following[j]
        if following[i] < n:
            prev[following[i]] = i
            if (r := ranks.get(piece[i:end[following[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[following[i]]))
        if (h := prev[i]) >= 0 and (r := ranks.get(piece[h:e])) is not None:
            heapq.heappush(heap, (r, h, e))
    return [ranks[piece[i:end[i]]] for i in range(n) if alive[i]]


class Merger:
    """Merges many short pre-tokens in step: each round every piece merges its
    leftmost pair of lowest rank, until no pair has a rank."""

    def __init__(self, ranks: dict[bytes, int]):
        found = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                if (a := ranks.get(token[:i])) is not None and (b := ranks.get(token[i:])) is not None:
                    found[a << 32 | b] = rank
        self.none = 1 << 30
        self.keys = np.array(sorted(found), np.int64)
        self.merged = np.array([found[k] for k in self.keys.tolist()], np.int32)
        self.of_byte = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        a, b = np.divmod(np.arange(1 << 16), 256)
        self.of_two = self.rank(self.of_byte[a], self.of_byte[b])

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], self.none).astype(np.int32)

    def __call__(self, pieces: list[bytes]) -> list[np.ndarray]:
        width = max(map(len, pieces)) + 1  # the last column of a row is never part of a pair
        inside = np.arange(width) < np.array([len(p) for p in pieces])[:, None]
        raw = np.zeros(inside.shape, np.int64)
        raw[inside] = np.frombuffer(b"".join(pieces), np.uint8)
        low = np.full(inside.shape, self.none, np.int32)  # rank of each part with the next
        pair = inside[:, :-1] & inside[:, 1:]
        low[:, :-1][pair] = self.of_two[(raw[:, :-1] << 8 | raw[:, 1:])[pair]]
        part = np.where(inside, self.of_byte[raw], -1)
        after = np.tile(np.arange(1, width + 1, dtype=np.int32), (len(pieces), 1))
        before = after - 2
        rows = np.arange(len(pieces))
        while True:
            j = low[rows].argmin(axis=1)
            best = low[rows, j]
            some = best < self.none
            rows, j, best = rows[some], j[some], best[some].astype(np.int64)
            if not len(rows):
                return [row[row >= 0] for row in part]
            gone = after[rows, j]
            nxt = after[rows, gone]
            part[rows, j], part[rows, gone], low[rows, gone] = best, -1, self.none
            after[rows, j] = nxt
            before[rows, nxt] = j
            right = part[rows, nxt]
            low[rows, j] = np.where(right >= 0, self.rank(best, np.maximum(right, 0)), self.none)
            has = before[rows, j] >= 0
            r, p = rows[has], before[rows[has], j[has]]
            low[r, p] = self.rank(part[r, p], best[has])


class _Numbers(dict):
    """A number for each piece, given when it is first asked for."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        self.new.append(piece)
        return n


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Codec:
    """Encoding by a rank file and a pattern; keeps the ids of the pieces it met last."""

    def __init__(self, path: str, pattern: str):
        self.ranks, self.pattern = read_ranks(path), regex.compile(pattern)
        self.merger = Merger(self.ranks)
        tokens = sorted(self.ranks.items(), key=lambda x: x[1])
        sizes = np.zeros(tokens[-1][1] + 1, np.int64)
        sizes[[r for _, r in tokens]] = [len(t) for t, _ in tokens]
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.bytes = np.frombuffer(b"".join(t for t, _ in tokens), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.known = _Numbers()
        self.ids = np.zeros(0, np.int32)
        self.at = np.zeros(1, np.int64)  # where each piece's ids begin, and the end

    def bounds(self, text: str, start: int = 0) -> list[int]:
        """Ends of the matches from ``start``; the pattern matches every character."""
        return [m.end() for m in self.pattern.finditer(text, start)]

    def _learn(self) -> None:
        new, self.known.new = [p.encode("utf-8") for p in self.known.new], []
        found: list = [None] * len(new)
        by_size: dict[int, list[int]] = {}
        for i, p in enumerate(new):
            if (whole := self.ranks.get(p)) is not None:
                found[i] = [whole]
            elif len(p) > LONG_PIECE:
                found[i] = long_merge(p, self.ranks)
            else:
                by_size.setdefault((len(p) + 3) // 4, []).append(i)
        for some in by_size.values():
            for i in range(0, len(some), 20_000):
                for k, ids in zip(some[i:i + 20_000], self.merger([new[k] for k in some[i:i + 20_000]])):
                    found[k] = ids
        if found:
            self.ids = np.concatenate([self.ids, *found]).astype(np.int32)
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum([len(x) for x in found])])

    def encode(self, pieces: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many lists of pieces, one after another, and their count for each list."""
        if len(self.known) > CACHE:
            self._forget()
        counts = np.fromiter(map(len, pieces), np.int64, len(pieces))
        which = np.fromiter(map(self.known.__getitem__, chain.from_iterable(pieces)), np.int64, int(counts.sum()))
        self._learn()
        sizes = self.at[which + 1] - self.at[which]
        ids = self.ids[_runs(self.at[which], sizes)]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.cumsum(counts)
        return ids, upto[ends] - upto[ends - counts]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids, one after another, and their count for each id."""
        sizes = self.sizes[ids]
        return self.bytes[_runs(self.starts[ids], sizes)], sizes


def stitch(codec: Codec, text: str, chunks: list[tuple[int, int, list[int]]]) -> list[int]:
    """Boundaries of the whole text from those of its chunks.

    ``chunks``: (start, end, boundaries inside the text), by start. Near its
    end a chunk's boundaries may differ from the whole text's, because the
    pattern looks ahead; its last two are not used unless the text ends there.
    """
    out: list[int] = []
    for k, (_, end, ends) in enumerate(chunks):
        sure = ends if end >= len(text) else ends[:-2]
        if k == 0:
            out = list(sure)
            continue
        have = set(sure)
        at = len(out) - 1
        while at >= 0 and out[at] >= (sure[0] if sure else len(text)) and out[at] not in have:
            at -= 1
        if at >= 0 and out[at] in have:
            del out[at + 1:]
            out += sure[bisect_left(sure, out[at]) + 1:]
            continue
        for m in codec.pattern.finditer(text, out[-1] if out else 0):
            out.append(m.end())
            if m.end() in have:
                out += sure[bisect_left(sure, m.end()) + 1:]
                break
    if len(text) and (not out or out[-1] != len(text)):
        out += codec.bounds(text, out[-1] if out else 0)
    return out


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec for each worker."""
    return Codec(path, pattern)


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))


def _cut_at(text: str, ends: list[int]) -> list[str]:
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def _chunk_bounds(texts: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(key, chunks: array of start, end, ends) of ``texts`` (key, text), every
    chunk pre-tokenised as a row of its own."""
    n = F.length("text")
    starts = F.sequence(F.lit(0), n - 1, F.lit(chunk))
    rows = texts.withColumn("n", n).select("key", "n", "text", F.explode(starts).alias("at"))
    first = F.greatest(F.col("at") - overlap, F.lit(0))
    last = F.least(F.col("at") + chunk + overlap, F.col("n"))
    rows = rows.select("key", first.alias("start"), last.alias("stop"),
                       F.substring("text", first + 1, last - first).alias("part")).repartition("key", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            at = batch.column(1).to_pylist()
            ends = [[a + e for e in c.bounds(t)] for a, t in zip(at, batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(ends, pa.list_(pa.int32()))],
                                             ["key", "start", "stop", "ends"])

    found = rows.mapInArrow(run, "key binary, start int, stop int, ends array<int>")
    return found.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "stop", "ends"))).alias("chunks"))


def _bytes_of(c: Codec, lists: pa.Array) -> pa.Array:
    """The bytes of each list of ids, joined; a null list has none."""
    data, sizes = c.decode(lists.flatten().to_numpy(zero_copy_only=False))
    upto = np.concatenate([[0], np.cumsum(sizes)])
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    ends = upto[np.concatenate([[0], np.cumsum(counts)])].astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _encoded(docs: DataFrame, path: str, pattern: str, chunk: int, overlap: int, keep: list[str], out: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with the ids of its texts and, if ``out``
    has a second name, the bytes that the ids decode to, from one worker."""
    if not 0 < 2 * overlap <= chunk:
        raise ValueError("chunks must be longer than two overlaps")
    prepare(docs.sparkSession)
    key, chunks = fresh(docs, "text_key", "chunks")
    at, width = docs.columns.index("text"), len(docs.columns)
    kept = [docs.columns.index(c) for c in keep]
    schema = T.StructType([*[docs.schema[c] for c in keep],
                           *[T.StructField(c, t) for c, t in zip(out, (T.ArrayType(T.IntegerType()), T.BinaryType()))]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in small_batches(batches, at, SLICE):
            stitched = batch.column(width).to_pylist() if batch.num_columns > width else [None] * batch.num_rows
            pieces = [
                _cut_at(t, stitch(c, t, [(x["start"], x["stop"], x["ends"]) for x in parts])) if parts
                else c.pattern.findall(t or "") for t, parts in zip(batch.column(at).to_pylist(), stitched)]
            ids, counts = c.encode(pieces)
            lists = pa.ListArray.from_arrays(_offsets(counts), pa.array(ids))
            found = [lists, _bytes_of(c, lists)] if len(out) > 1 else [lists]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], *found], schema.names)

    long = F.coalesce(F.length("text"), F.lit(0)) > chunk
    keyed = docs.where(long).withColumn(key, F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    texts = keyed.groupBy(F.col(key).alias("key")).agg(F.first("text").alias("text"))
    bounds = _chunk_bounds(texts, path, pattern, chunk, overlap).withColumnsRenamed({"key": key, "chunks": chunks})
    joined = keyed.join(bounds, key).drop(key)
    return docs.where(~long).mapInArrow(run, schema).unionByName(joined.mapInArrow(run, schema))


def encode(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[DataFrame, str]:
    """``docs`` (text, any others) with an array<int> column of ids.

    Returns the frame and the column's name, which avoids any column ``docs``
    has. ``path`` is a rank file that driver and executors can read. Null and
    empty texts have no ids. Repeated rows stay; copies of one long text are
    pre-tokenised once. An empty table gives no row.
    """
    out = fresh(docs, "ids")
    return _encoded(docs, path, pattern, chunk, overlap, docs.columns, out), out[0]


def round_trip(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK,
               overlap: int = OVERLAP) -> tuple[DataFrame, str, str]:
    """``encode`` and ``decode`` by one worker for each task instead of two:
    ``docs`` without its texts, with a column of ids and one of the bytes that
    the ids decode to."""
    ids, raw = out = fresh(docs, "ids", "decoded")
    return _encoded(docs, path, pattern, chunk, overlap, [c for c in docs.columns if c != "text"], out), ids, raw


def decode(encoded: DataFrame, ids: str, path: str, pattern: str) -> tuple[DataFrame, str]:
    """``encoded`` with a binary column of the bytes of ``ids``, joined; null ids have none."""
    out, = fresh(encoded, "decoded")
    at = encoded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            raw = _bytes_of(c, batch.column(at))
            yield pa.RecordBatch.from_arrays([*batch.columns, raw], [*batch.schema.names, out])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(out, T.BinaryType())])), out


def bpe_digest(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    both, ids, raw = round_trip(documents.select("doc_id", "text"), path, pattern)
    return both.select(
        "doc_id", F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col(ids).cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col(raw), 256).alias("decoded_sha256"))
