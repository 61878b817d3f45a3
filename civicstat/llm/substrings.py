"""Substring dedup by an FM-index per shard.

Passages meet in shards by content. Among the hashes of the 8-word shingles
of a window the smallest is the window's key, so equal windows have equal
keys, and neighbours mostly share theirs: a stretch of neighbours with one
key travels as one piece. Pieces whose key occurs in one document only are
done. The others are indexed: every shard holds whole keys, each distinct
piece once with its smallest document, and backward search over the shard's
index finds for every window of a piece the smallest document that has it.

A key with many different pieces (a passage in very many documents, each
piece with other words around it) would fill a shard. Its pieces are cut again
by the keys of longer shingles, which other words reach sooner, and at last
into single windows keyed by all their words. Each time, what occurs in one
document only is done. So no key holds more than ``most_pieces`` pieces in a
shard, however common a passage is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicstat.llm.common import cut, fresh, prepare
from civicstat.llm.fmindex import Index

WINDOW = 50
#: Words of the shingles that give the keys, one after another for crowded keys.
SHINGLES = (8, 25, WINDOW)
#: Windows of one piece; longer stretches are split.
PIECE = 64
MOST_PIECES = 256
#: Words of one shard's index.
SHARD_WORDS = 500_000
_LAST = (1 << 63) - 1
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD
    return h ^ (h >> np.uint64(29))


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _stretches(h: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of each stretch of words, wherever it stands."""
    power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(h), _ODD)]))
    back = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(h), _INVERSE)]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(h * power[:-1], dtype=np.uint64)])
    return _mix((sums[stops] - sums[starts]) * back[starts] + (stops - starts).astype(np.uint64))


def _windows(h: np.ndarray, size: int) -> np.ndarray:
    starts = np.arange(len(h) - size + 1)
    return _stretches(h, starts, starts + size)


def _smallest(x: np.ndarray, size: int) -> np.ndarray:
    """The minimum of every stretch of ``size`` numbers."""
    h = 1
    while 2 * h <= size:
        x = np.minimum(x[:-h], x[h:])
        h *= 2
    return x if h == size else np.minimum(x[:len(x) - size + h], x[size - h:])


def pieces_of(words: list[bytes], window: int = WINDOW, shingle: int = SHINGLES[0]) -> tuple[np.ndarray, ...]:
    """Key, hash of the words, first word and number of windows of each piece."""
    if len(words) < window:
        return tuple(np.zeros(0, k) for k in (np.uint64, np.uint64, np.int64, np.int64))
    shingle = min(shingle, window)
    h = _hashes(words)
    key = _smallest(_windows(h, shingle), window - shingle + 1)
    new = np.concatenate([[True], key[1:] != key[:-1]])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(key)))
    parts = -(-sizes // PIECE)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    starts = np.repeat(starts, parts) + nth * PIECE
    sizes = np.minimum(np.repeat(sizes, parts) - nth * PIECE, PIECE)
    return key[starts], _stretches(h, starts, starts + sizes + window - 1), starts, sizes


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").split()


def _order(doc_id: Column) -> Column:
    """Ids as numbers; null comes after all others."""
    return F.coalesce(doc_id.cast("long"), F.lit(_LAST))


def _find(docs: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, marks = b.column(0).to_numpy(), b.column(1).to_numpy()
            found = [pieces_of(_words(t), window) for t in b.column(2).to_pylist()]
            sizes = [len(f[0]) for f in found]
            if not sum(sizes):
                continue
            key, piece, start, n = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_pydict({
                "key": key.view(np.int64), "piece": piece.view(np.int64), "id": np.repeat(ids, sizes),
                "mark": np.repeat(marks, sizes), "start": start.astype(np.int32), "n": n.astype(np.int32)})

    return docs.mapInArrow(run, "key bigint, piece bigint, id bigint, mark bigint, start int, n int")


def _extract(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(key, piece, id, hi, words) of the ``wanted`` pieces."""
    lists = wanted.groupBy("id", "mark").agg(F.collect_list(F.struct("key", "piece", "start", "n", "hi")).alias("ps"))
    rows = docs.join(lists, ["id", "mark"]).select("id", "text", "ps")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for i, text, ps in zip(*(b.column(k).to_pylist() for k in range(3))):
                words = _words(text)
                out += [(p["key"], p["piece"], i, p["hi"], b" ".join(words[p["start"]:p["start"] + p["n"] + window - 1]))
                        for p in ps]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.int64()] * 4 + [pa.binary()])],
                                                 ["key", "piece", "id", "hi", "words"])

    return rows.mapInArrow(run, "key bigint, piece bigint, id bigint, hi bigint, words binary")


def _cut_again(pieces: DataFrame, window: int, shingle: int) -> DataFrame:
    """``pieces`` (key, piece, id, hi, words) as smaller pieces with keys of
    longer shingles: key, piece, id, hi, at, key2, piece2, words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            rows = [w.split() for w in b.column(4).to_pylist()]
            found = [pieces_of(w, window, shingle) for w in rows]
            sizes = [len(f[0]) for f in found]
            key, piece, start, n = (np.concatenate(x) for x in zip(*found))
            words = [b" ".join(w[a:a + k + window - 1]) for w, f in zip(rows, found) for a, k in zip(f[2].tolist(), f[3].tolist())]
            own = [np.repeat(b.column(k).to_numpy(), sizes) for k in range(4)]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, own), pa.array(start.astype(np.int32)), pa.array(key.view(np.int64)),
                 pa.array(piece.view(np.int64)), pa.array(words, pa.binary())],
                ["key", "piece", "id", "hi", "at", "key2", "piece2", "words"])

    return pieces.mapInArrow(run, "key bigint, piece bigint, id bigint, hi bigint, at int, key2 bigint, piece2 bigint, words binary")


def _search(pieces: DataFrame, window: int, shard_words: int) -> DataFrame:
    """(key, piece, owners: array of first window, windows, smallest id) of the
    distinct ``pieces`` (key, piece, id, words)."""
    rows = pieces.select("key", "piece", "id", "words").repartition("key").sortWithinPartitions("key")
    span = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32()), ("first", pa.int64())]))

    def shard(cols: list[list]) -> pa.RecordBatch:
        index = Index([w.split() for w in cols[3]], np.array(cols[2], np.int64), window)
        first, counts = index.least_owners()
        begin = np.cumsum(counts) - counts
        new = np.ones(len(first), bool)
        new[1:] = first[1:] != first[:-1]
        new[begin[counts > 0]] = True
        heads = np.flatnonzero(new)
        of = np.repeat(np.arange(len(counts)), counts)[heads]
        runs = pa.StructArray.from_arrays(
            [pa.array((heads - begin[of]).astype(np.int32)),
             pa.array(np.diff(np.append(heads, len(first))).astype(np.int32)), pa.array(first[heads])],
            ["at", "n", "first"])
        offsets = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(counts)))]).astype(np.int32)
        owners = pa.ListArray.from_arrays(pa.array(offsets), runs).cast(span)
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), owners],
                                          ["key", "piece", "owners"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], []]
        size = 0
        for b in batches:
            for key, piece, i, words in zip(*(b.column(k).to_pylist() for k in range(4))):
                if size >= shard_words and held[0][-1] != key:
                    yield shard(held)
                    held, size = [[], [], [], []], 0
                for column, value in zip(held, (key, piece, i, words)):
                    column.append(value)
                size += words.count(b" ") + 1
        if held[0]:
            yield shard(held)

    return rows.mapInArrow(run, "key bigint, piece bigint, owners array<struct<at:int,n:int,first:bigint>>")


def _owners(pieces: DataFrame, window: int, most_pieces: int, shard_words: int, shingles: tuple) -> DataFrame:
    """(key, piece, owners) of the distinct ``pieces`` (key, piece, id, hi,
    words); id and hi are the smallest and largest document of a piece."""
    crowded = pieces.groupBy("key").agg(F.count("*").alias("many")).where(F.col("many") > most_pieces).select("key")
    if not shingles or crowded.isEmpty():
        return _search(pieces, window, shard_words)
    crowded = cut(crowded)
    found = _search(pieces.join(crowded, "key", "left_anti"), window, shard_words)
    again = cut(_cut_again(pieces.join(crowded, "key"), window, shingles[0]))
    shared = (again.groupBy("key2").agg(F.min("id").alias("lo"), F.max("hi").alias("top"))
              .where(F.col("lo") < F.col("top")).select("key2"))
    smaller = (again.join(shared, "key2").groupBy(F.col("key2").alias("key"), F.col("piece2").alias("piece"))
               .agg(F.min("id").alias("id"), F.max("hi").alias("hi"), F.first("words").alias("words")))
    below = _owners(cut(smaller), window, most_pieces, shard_words, shingles[1:]).select(
        F.col("key").alias("key2"), F.col("piece").alias("piece2"), "owners")
    moved = F.expr("transform(owners, o -> struct(o.at + at AS at, o.n AS n, o.first AS first))")
    back = (again.join(below, ["key2", "piece2"]).select("key", "piece", moved.alias("owners"))
            .groupBy("key", "piece").agg(F.flatten(F.collect_list("owners")).alias("owners")))
    return found.unionByName(back)


def repeated_spans(docs: DataFrame, window: int = WINDOW, most_pieces: int = MOST_PIECES,
                   shard_words: int = SHARD_WORDS) -> DataFrame:
    """(id, mark, spans: array of start, stop in words) of the documents of
    ``docs`` (id, mark, text) with windows that also start in a document of
    smaller id; ``mark`` tells texts of one id apart. Spans are sorted and may
    overlap."""
    found = cut(_find(docs, window))
    shared = (found.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
              .where(F.col("lo") < F.col("hi")).select("key"))
    some = cut(found.join(shared, "key"))
    each = (some.groupBy("key", "piece").agg(F.min(F.struct("id", "mark", "start", "n")).alias("w"), F.max("id").alias("hi"))
            .select("key", "piece", "hi", "w.*"))
    taken = cut(_extract(docs, each, window).dropDuplicates(["key", "piece"]))
    owners = cut(_owners(taken, window, most_pieces, shard_words, tuple(x for x in SHINGLES[1:] if x < window) + (window,)))
    hits = (some.join(owners, ["key", "piece"])
            .select("id", "mark", "start", F.expr("filter(owners, o -> o.first < id)").alias("o")).where(F.size("o") > 0)
            .select("id", "mark", F.expr("transform(o, x -> struct(start + x.at AS start, "
                                         f"start + x.at + x.n + {window - 1} AS stop))").alias("spans")))
    return hits.groupBy("id", "mark").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))


def dedup(docs: DataFrame, window: int = WINDOW, most_pieces: int = MOST_PIECES,
          shard_words: int = SHARD_WORDS) -> tuple[DataFrame, str]:
    """``docs`` (doc_id, text, any others) with a struct column of n_words,
    n_removed and kept (the words that stay, joined by one space).

    Returns the frame and the struct's name, which avoids any column ``docs``
    has. A word goes if it lies in a window whose words also start in a
    document of smaller id; a null id counts as larger than all others and
    equal ids as one document. Ids are whole numbers; text that does not read
    as one raises. Null and empty texts have no words; texts shorter than a
    window lose none; very long texts are cut into pieces, and all their windows
    count. An empty table gives no row.
    """
    prepare(docs.sparkSession)
    out, own, mark, spans = fresh(docs, "dedup", "own_id", "mark", "spans")
    numbered = docs.withColumns({own: _order(F.col("doc_id")), mark: F.xxhash64("text")})
    found = repeated_spans(numbered.select(F.col(own).alias("id"), F.col(mark).alias("mark"), "text"),
                           window, most_pieces, shard_words)
    found = found.withColumnsRenamed({"id": own, "mark": mark, "spans": spans})
    rows = numbered.join(found, [own, mark], "left").select(*docs.columns, spans)
    at, width = docs.columns.index("text"), len(docs.columns)
    kind = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                         T.StructField("kept", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, gone in zip(b.column(at).to_pylist(), b.column(width).to_pylist()):
                words, kept, upto = _words(text), [], 0
                for s in gone or ():
                    kept += words[upto:max(upto, s["start"])]
                    upto = max(upto, s["stop"])
                kept += words[upto:]
                rows.append((len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8")))
            n, gone, kept = zip(*rows) if rows else ((), (), ())
            found = pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                                               ["n_words", "n_removed", "kept"])
            yield pa.RecordBatch.from_arrays([*b.columns[:width], found], [*b.schema.names[:width], out])

    return rows.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, kind)])), out


def substring_digest(documents: DataFrame) -> DataFrame:
    found, d = dedup(documents.select("doc_id", "text"))
    return found.select("doc_id", f"{d}.n_words", f"{d}.n_removed",
                        F.sha2(F.col(f"{d}.kept").cast("binary"), 256).alias("kept_sha256"))
