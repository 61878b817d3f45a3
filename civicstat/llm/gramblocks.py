"""Word n-gram sums of documents by blocks of counts.

What ``wordgrams`` gives with a row for each gram, with little on disk. A block
is one binary value: sorted hashes as differences beside small numbers, all
compressed. Grams are dealt to buckets by their hash; a trigram lies with its
first two words.

``learn`` makes a table that is bucketed in storage: counts of each trigram, of
each word pair as context (kinds of words after it) and as gram (kinds before
it), and of each word. It goes over the labelled rows once for each part of the
word pairs. ``sums`` goes over parts of the documents: a chunk of them asks each
bucket for the counts of its distinct grams, and weighs the grams once the
answers are back. Counts travel, not weights: most are 0 or 1. Every gram of
every row counts, whatever the number of parts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicstat.llm.common import cut, discard, written
from civicstat.llm.wordgrams import DISCOUNT, MODELS, PARTS, hashes, keys, trigrams
from civicstat.session import checkpoint_dir

#: Bytes of text for one bucket, and parts that labelled rows and documents are
#: taken in; more parts need less disk and more time.
BUCKET_BYTES = 32 << 20
SLICES = 8
DOC_SLICES = 14
#: Words held at once by a task.
CHUNK_WORDS = 500_000
BEGIN, END = trigrams(None)[0][0], int(trigrams(None)[2][0])
GRAMS, WORDS, TOTALS, ASKED, TEXTS = range(5)
#: Columns of a word: kinds before it, in either class, kinds after it, trigrams around it.
_N1, _B, _K2, _T2 = slice(0, 6), slice(6, 9), slice(9, 15), slice(15, 21)
SCHEMA = "bucket int, kind int, chunk bigint, data binary"


def pack(*arrays: np.ndarray) -> bytes:
    codec, heads, bodies = pa.Codec("zstd", 1), [], []
    for a in arrays:
        raw = np.ascontiguousarray(a).view(np.uint8).reshape(a.size, a.itemsize).T.tobytes()
        bodies.append(codec.compress(raw, asbytes=True))
        heads.append([a.dtype.str, a.shape, len(bodies[-1])])
    head = json.dumps(heads).encode()
    return len(head).to_bytes(4, "little") + head + b"".join(bodies)


def unpack(data: bytes) -> list[np.ndarray]:
    codec, at, out = pa.Codec("zstd"), 4 + int.from_bytes(data[:4], "little"), []
    for dtype, shape, n in json.loads(data[4:at]):
        size, count = np.dtype(dtype).itemsize, int(np.prod(shape))
        raw = np.frombuffer(codec.decompress(data[at:at + n], count * size, asbytes=True), np.uint8) if count else np.zeros(0, np.uint8)
        out.append(raw.reshape(size, count).T.copy().view(dtype).reshape(shape))
        at += n
    return out


def _steps(x: np.ndarray) -> np.ndarray:
    """Differences of sorted numbers; ``_summed`` gives the numbers back."""
    return np.diff(x, prepend=np.zeros(1, x.dtype))


def _summed(x: np.ndarray) -> np.ndarray:
    return np.cumsum(x, dtype=x.dtype)


def _bucket(key: np.ndarray, n: int) -> np.ndarray:
    """Ranges of hashes, so what is sorted by hash is sorted by bucket."""
    return (((key >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int32)


def _slice(key: np.ndarray) -> np.ndarray:
    return key % np.uint64(SLICES)


def _rows(found: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*found)) or [(), (), (), ()]
    return pa.RecordBatch.from_pydict({"bucket": pa.array(cols[0], pa.int32()), "kind": pa.array(cols[1], pa.int32()),
                                       "chunk": pa.array(cols[2], pa.int64()), "data": pa.array(cols[3], pa.binary())})


def _starts(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    new = np.zeros(len(sorted_columns[0]), bool)
    new[:1] = True
    for c in sorted_columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _six(four: np.ndarray) -> np.ndarray:
    """Counts of all rows, half 1 and half 0 of either class, from those of (class 0, half 0) ... (class 1, half 1)."""
    a, b, c, d = four.T
    return np.stack([a + b, b, a, c + d, d, c], axis=1)


def _four(at: np.ndarray, group: np.ndarray, n: np.ndarray | None, size: int) -> np.ndarray:
    return np.bincount(at * 4 + group, n, size * 4).astype(np.int64).reshape(size, 4)


def _small(x: np.ndarray) -> np.ndarray:
    """The same counts in the fewest bytes; most are small."""
    return x.astype(np.min_scalar_type(int(x.max()))) if x.size else x.astype(np.uint8)


def _gathered(sorted_at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(sorted_at, c, size) for c in values.T], axis=1).astype(np.int64)


def _chunks(batches: Iterator[tuple]) -> Iterator[tuple[np.ndarray, ...]]:
    """Of (two columns, texts): both columns, words in each text with the end,
    distinct words and the number of each word, about CHUNK_WORDS at a time."""
    firsts, seconds, lengths, found = [], [], [], []

    def chunk() -> tuple[np.ndarray, ...]:
        words, ids = np.unique(np.array(found, np.uint64), return_inverse=True)
        out = np.array(firsts), np.array(seconds), np.array(lengths, np.int64), words, ids.astype(np.int32)
        for x in (firsts, seconds, lengths, found):
            x.clear()
        return out

    for a, b, texts in batches:
        for k, text in enumerate(texts.to_pylist()):
            own = hashes(text)
            found += own
            found.append(END)
            lengths.append(len(own) + 1)
            firsts.append(a[k])
            seconds.append(None if b is None else b[k])
            if len(found) >= CHUNK_WORDS:
                yield chunk()
    if lengths:
        yield chunk()


def _contexts(ids: np.ndarray, lengths: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First, second and third word of the trigram that ends at each word."""
    at = np.arange(len(ids))
    since = at - np.repeat(np.cumsum(lengths) - lengths, lengths)
    w = words[ids]
    v, u = (np.where(since >= k, w[np.maximum(at - k, 0)], BEGIN) for k in (1, 2))
    return u, v, w


def encode(rows: DataFrame) -> DataFrame:
    """Blocks of the words of ``rows`` (text, label, half), in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, _, lengths, words, ids in _chunks(([b.column(1).to_numpy() * 2 + b.column(2).to_numpy(), None, b.column(0)] for b in batches)):
            yield _rows([(0, TEXTS, 0, pack(group.astype(np.uint8), lengths, ids, _steps(words)))])

    return rows.mapInArrow(run, SCHEMA)


def _ask_model(encoded: DataFrame, part: int, n_buckets: int) -> DataFrame:
    """Blocks of the distinct trigrams of texts whose first or last two words
    are in the part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data in (x for b in batches for x in b.column(0).to_pylist()):
            group, lengths, ids, words = unpack(data)
            u, v, w = _contexts(ids, lengths, _summed(words))
            group = np.repeat(group.astype(np.int64), lengths)
            before = keys(v, u, v)[1]
            after, three = keys(u, v, w)[1:]
            out = []
            use = np.flatnonzero(_slice(before) == part)
            use = use[np.lexsort((group[use], three[use], before[use], _bucket(before[use], n_buckets)))]
            first = _starts(three[use], group[use], before[use])
            n = np.diff(np.append(first, len(use)))
            use = use[first]
            where = _bucket(before[use], n_buckets)
            gram = np.flatnonzero(_slice(after) == part)
            gram = gram[np.lexsort((group[gram], three[gram], after[gram], _bucket(after[gram], n_buckets)))]
            gram = gram[_starts(three[gram], group[gram], after[gram])]
            there = _bucket(after[gram], n_buckets)
            for k in np.union1d(where, there).tolist():
                i = slice(*np.searchsorted(where, [k, k + 1]))
                g = gram[slice(*np.searchsorted(there, [k, k + 1]))]
                s = _starts(after[g])
                out.append((k, GRAMS, 0, pack(
                    _steps(before[use[i]]), three[use[i]], group[use[i]].astype(np.uint8), n[i],
                    v[g[s]], w[g[s]], np.diff(np.append(s, len(g))), three[g], group[g].astype(np.uint8))))
            yield _rows(out)

    return encoded.select("data").mapInArrow(run, SCHEMA)


def _count(n_buckets: int):
    """Of one bucket and part: a block of counts, and blocks of what its word pairs add to words."""
    def run(group: pa.Table) -> pa.Table:
        parts = [unpack(x) for x in group.column("data").to_pylist()]
        for p in parts:
            p[0] = _summed(p[0])
            p[4:7] = [np.repeat(p[4], p[6]), np.repeat(p[5], p[6])]
        before, three, label, n, v, w, three_of, label_of = (np.concatenate(x) for x in zip(*parts))
        del parts
        order = np.lexsort((three, before))
        before, three, label, n = before[order], three[order], label[order].astype(np.int64), n[order]
        new = _starts(before, three)
        at = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(three))))
        four = _four(at, label, n, len(new))
        before, three = before[new], three[new]
        context = _starts(before)
        after = keys(v, v, w)[1]
        order = np.lexsort((three_of, after))
        after, v, w, three_of, label_of = (x[order] for x in (after, v, w, three_of, label_of.astype(np.int64)))
        new = _starts(after, three_of)
        at = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(after))))
        seen = (_six(_four(at, label_of, None, len(new))) > 0).astype(np.int64)
        after, v, w = after[new], v[new], w[new]
        gram = _starts(after)
        kinds = np.add.reduceat(seen, gram) if len(gram) else np.zeros((0, 6), np.int64)
        v, w, after = v[gram], w[gram], after[gram]
        two = np.union1d(before[context], after)
        counts = np.zeros((len(two), 12), np.int64)
        if len(context):
            counts[np.searchsorted(two, before[context]), :6] = np.add.reduceat((_six(four) > 0).astype(np.int64), context)
        counts[np.searchsorted(two, after), 6:] = kinds
        order = np.argsort(three)
        home = group.column("bucket")[0].as_py()
        out = [(home, GRAMS, 0, pack(_steps(three[order]), _small(four[order].T), _steps(two), _small(counts.T)))]
        words, at = np.unique(np.concatenate([v, w]), return_inverse=True)
        first, last = at[:len(v)], at[len(v):]
        some = (kinds > 0).astype(np.int64)
        sums = np.concatenate([_gathered(last, some, len(words)), _gathered(last, some[:, :3] | some[:, 3:], len(words)),
                               _gathered(first, some, len(words)), _gathered(first, kinds, len(words))], axis=1)
        to = _bucket(words, n_buckets)
        for k in np.unique(to).tolist():
            out.append((k, WORDS, 0, pack(_steps(words[to == k]), _small(sums[to == k].T))))
        return pa.Table.from_batches([_rows(out)])

    return run


def _count_words(group: pa.Table) -> pa.Table:
    parts = [unpack(x) for x in group.column("data").to_pylist()]
    words, at = np.unique(np.concatenate([_summed(p[0]) for p in parts]), return_inverse=True)
    sums = _gathered(at, np.concatenate([p[1].T for p in parts]), len(words))
    n, b = sums[:, _N1], sums[:, _B]
    totals = np.concatenate([(n > 0).sum(axis=0), n.sum(axis=0), b.sum(axis=0), (b > 0).sum(axis=0)]).astype(np.int64)
    home = group.column("bucket")[0].as_py()
    return pa.Table.from_batches([_rows([(home, WORDS, 0, pack(_steps(words), _small(sums.T))), (home, TOTALS, 0, pack(totals))])])


class Model:
    """A bucketed table of counts and the sums over all words; ``drop`` it after use."""

    def __init__(self, spark, n_buckets: int):
        self.spark, self.n_buckets = spark, n_buckets
        self.name = f"grams_{uuid.uuid4().hex}"
        self.path = f"{checkpoint_dir(spark).rstrip('/')}/{self.name}"
        self.totals = np.zeros(18, np.int64)

    def add(self, rows: DataFrame) -> None:
        rows.write.format("parquet").mode("append").option("path", self.path).bucketBy(self.n_buckets, "bucket").saveAsTable(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        discard(self.spark, self.path)


def learn(encoded: DataFrame, text_bytes: int) -> Model:
    """Counts of all word grams of texts that ``encode`` gave."""
    model = Model(encoded.sparkSession, max(1, -(-text_bytes // BUCKET_BYTES)))
    words, paths = [], []
    for part in range(SLICES):
        found, path = written(_ask_model(encoded, part, model.n_buckets).groupBy("bucket").applyInArrow(_count(model.n_buckets), SCHEMA))
        model.add(found.where(F.col("kind") == GRAMS))
        own, own_path = written(found.where(F.col("kind") == WORDS))
        discard(model.spark, path)
        words.append(own)
        paths.append(own_path)
    every = words[0]
    for w in words[1:]:
        every = every.union(w)
    known, path = written(every.groupBy("bucket").applyInArrow(_count_words, SCHEMA))
    for p in paths:
        discard(model.spark, p)
    model.add(known.where(F.col("kind") == WORDS))
    for r in known.where(F.col("kind") == TOTALS).select("data").collect():
        model.totals += unpack(bytes(r["data"]))[0]
    discard(model.spark, path)
    return model


def _distinct(ids: np.ndarray, lengths: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of a chunk's texts: its words with the boundary before texts; distinct
    word pairs, where the pair that begins and the one that ends each trigram
    are among them and where each pair ends; distinct trigrams, which is at
    each word and where each ends."""
    u, v, w = _contexts(ids, lengths, words)
    _, two, three = keys(u, v, w)
    # the pair before is the one that ended a word earlier, two boundaries at the first
    start = BEGIN.reshape(1)
    pairs, place = np.unique(np.append(two, keys(start, start, start)[1]), return_inverse=True)
    place = place.astype(np.int32)
    before = np.append(place[-1:], place[:-2])
    before[np.cumsum(lengths) - lengths] = place[-1]
    pair_at = np.full(len(pairs), -1)
    pair_at[place[:-1]] = np.arange(len(ids))
    trios, trio = np.unique(three, return_inverse=True)
    trio_at = np.empty(len(trios), np.int64)
    trio_at[trio] = np.arange(len(ids))
    return np.union1d(words, start), pairs, before, place[:-1], pair_at, trios, trio, trio_at


def _ask(docs: DataFrame, n_buckets: int) -> DataFrame:
    """Blocks of chunks of ``docs`` (row, half, text): their words, and for each bucket their distinct grams there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        own = ([b.column(0).to_numpy(), b.column(1).fill_null(0).to_numpy(), b.column(2)] for b in batches)
        for k, (row, half, lengths, words, ids) in enumerate(_chunks(own)):
            chunk = base + k
            vocabulary, pairs, before, _, _, trios, _, trio_at = _distinct(ids, lengths, words)
            asked = _asked(vocabulary, pairs, trios, pairs[before[trio_at]], n_buckets)
            out = [(chunk % n_buckets, TEXTS, chunk, pack(row, half.astype(np.int8), lengths, ids, _steps(words)))]
            for b in range(n_buckets):
                if any(len(x) for x, _ in (a[b] for a in asked)):
                    out.append((b, ASKED, chunk, pack(*[_steps(a[b][0]) for a in asked])))
            yield _rows(out)

    return docs.select("row", "half", "text").mapInArrow(run, SCHEMA)


def _asked(words: np.ndarray, pairs: np.ndarray, trios: np.ndarray, before: np.ndarray,
           n_buckets: int) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """For words, pairs and trigrams (``before``: their first two words): hashes and places of those in each bucket."""
    out = []
    for x, home in ((words, words), (pairs, pairs), (trios, before)):
        where = _bucket(home, n_buckets)
        order = np.argsort(where, kind="stable") if x is not home else np.arange(len(x))
        ends = np.searchsorted(where[order], np.arange(n_buckets + 1))
        out.append([(x[order[a:b]], order[a:b]) for a, b in zip(ends, ends[1:])])
    return out


def _answer(model: pa.Table, asked: pa.Table) -> pa.Table:
    out, grams, words = [], [], []
    if asked.num_rows and model.num_rows:
        for kind, data in zip(model.column("kind").to_pylist(), model.column("data").to_pylist()):
            (grams if kind == GRAMS else words).append(unpack(data))
    tables = []
    for parts, x, y in ((words, 0, 1), (grams, 2, 3), (grams, 0, 1)):
        if parts:
            key = np.concatenate([_summed(p[x]) for p in parts])
            order = np.argsort(key, kind="stable")  # sorted runs
            tables.append((key[order], np.concatenate([p[y].T for p in parts])[order]))
        else:
            tables.append((np.zeros(0, np.uint64), np.zeros((0, (21, 12, 4)[len(tables)]), np.uint8)))
    for bucket, kind, chunk, data in zip(*(asked.column(c).to_pylist() for c in ("bucket", "kind", "chunk", "data"))) if asked.num_rows else ():
        if kind == TEXTS:
            out.append((bucket, kind, chunk, data))
            continue
        reply = []
        for own, (key, value) in zip(unpack(data), tables):
            own = _summed(own)
            at = np.searchsorted(key, own)
            hit = np.flatnonzero(key[np.minimum(at, len(key) - 1)] == own) if len(key) else np.zeros(0, np.int64)
            reply += [_steps(hit.astype(np.int32)), value[at[hit]].T]
        out.append((bucket, ASKED, chunk, pack(*reply)))
    return pa.Table.from_batches([_rows(out)])


def _more(n: np.ndarray, k: np.ndarray, q: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(k > 0, 1 + np.maximum(n - DISCOUNT, 0) / (DISCOUNT * k * q), 1.0)


def _chance(more: np.ndarray, k: np.ndarray, t: np.ndarray, q: np.ndarray) -> np.ndarray:
    return np.where(k > 0, DISCOUNT * k / np.maximum(t, 1), 1.0) * q * more


def _weight(more: np.ndarray) -> np.ndarray:
    return np.log(more[:, MODELS:]) - np.log(more[:, :MODELS])


def _sum(n_buckets: int, totals: np.ndarray):
    k0, t0, s0, v0 = totals[:6], totals[6:12], totals[12:15], totals[15:]

    def run(group: pa.Table) -> pa.Table:
        kinds, datas = group.column("kind").to_pylist(), group.column("data").to_pylist()
        row, half, lengths, ids, words = unpack(datas[kinds.index(TEXTS)])
        words = _summed(words)
        vocabulary, pairs, before, place, pair_at, trios, trio, trio_at = _distinct(ids, lengths, words)
        asked = _asked(vocabulary, pairs, trios, pairs[before[trio_at]], n_buckets)
        counts = [np.zeros((len(x), c), np.int32) for x, c in ((vocabulary, 21), (pairs, 12), (trios, 4))]
        for bucket, kind, data in zip(group.column("bucket").to_pylist(), kinds, datas):
            if kind == ASKED:
                reply = unpack(data)
                for i, own in enumerate(asked):
                    counts[i][own[bucket][1][_summed(reply[2 * i])]] = reply[2 * i + 1].T
        one, two, three = counts
        # words
        base = (np.maximum(one[:, _B] - DISCOUNT, 0) + DISCOUNT * v0 / (v0 + 1)) / np.maximum(s0, 1)
        q = np.maximum(np.tile(base, 2), 1e-12)
        more = _more(one[:, _N1], k0, q)
        d1, p1 = _weight(more), _chance(more, k0, t0, q)
        # grams without a count weigh nothing; two boundaries are no gram
        start = np.cumsum(lengths) - lengths
        last = np.searchsorted(vocabulary, words)[ids]
        second = np.append(last[:1], last[:-1])
        second[start] = np.searchsorted(vocabulary, BEGIN)
        use = np.flatnonzero(two[:, 6:].any(axis=1) & (pair_at >= 0))
        a, b = second[pair_at[use]], last[pair_at[use]]
        more = _more(two[use, 6:], one[a, _K2], p1[b])
        d2, p2 = np.zeros((len(pairs), MODELS)), np.zeros((len(pairs), 6))
        d2[use], p2[use] = _weight(more), _chance(more, one[a, _K2], one[a, _T2], p1[b])
        use = np.flatnonzero(three.any(axis=1))
        d3 = np.zeros((len(trios), MODELS))
        d3[use] = _weight(_more(_six(three[use]), two[before[trio_at[use]], :6], p2[place[trio_at[use]]]))
        side = np.repeat(np.where(half == 0, 1, 2), lengths)
        out = {"row": pa.array(row), "words": pa.array(lengths.astype(np.float64))}
        for suffix, model in (("", 0), ("x", side)):
            for size, (d, at) in enumerate(((d1, last), (d2, place), (d3, trio)), 1):
                x = d.ravel()[at * MODELS + model]
                for kind, sign in (("more", 1), ("less", -1)):
                    out[f"{kind}{size}{suffix}"] = pa.array(np.add.reduceat(np.maximum(x * sign, 0.0), start))
        return pa.table(out)

    return run


def sums(docs: DataFrame, model: Model) -> DataFrame:
    """(row, words, PARTS, PARTS with an x) of ``docs`` (row, half, text), like
    ``wordgrams.sums``; rows without a known gram have zeros. Words count the
    end of each text."""
    names = [*PARTS, *[f"{c}x" for c in PARTS]]
    schema = "row bigint, words double, " + ", ".join(f"{c} double" for c in names)
    every = None
    for part in range(DOC_SLICES):
        own = docs.where(F.pmod("row", F.lit(DOC_SLICES)) == part)
        known = model.spark.table(model.name).groupBy("bucket")
        answers = known.cogroup(_ask(own, model.n_buckets).groupBy("bucket")).applyInArrow(_answer, SCHEMA)
        found = cut(answers.groupBy("chunk").applyInArrow(_sum(model.n_buckets, model.totals), schema))
        every = found if every is None else every.union(found)
    return every.groupBy("row").agg(*[F.sum(c).alias(c) for c in ["words", *names]])
