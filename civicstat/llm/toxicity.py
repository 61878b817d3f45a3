"""Toxicity by class-conditional Kneser-Ney models.

Texts become strings over 32 symbols: a word boundary, the letters a to z,
four groups of accented letters and one of other letters; other scripts are
spread over a to z. A symbol is predicted from up to four before it in its
own word. Orders three to five have counts of the class; below them both
classes back off to the same continuation counts, gathered from the distinct
n-grams of both. A text has two raw scores, both divided by its symbols: how
much the toxic model's log likelihood gains on the ordinary model's where it is
above it, and how much it loses where it is below. Toxic expressions show in
the gain; the loss also measures how far the smaller class's model is trained.

The letters tell misspelt words; what whole words and expressions tell, in any
script, comes from the word trigrams of ``wordgrams``, whose tables grow with
the labelled rows. A text gets the gain and the loss of each order from them.

All labelled rows are counted. A logistic curve turns the gains and losses of
letters and words into a probability. It is fitted to those that each half of
the labelled rows gets from the other half's model, and no gain lowers the
score and no loss raises it. Of the letters, a table over all 32^5 possible
five-grams reaches the driver and every worker.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicstat.llm import gramblocks, wordgrams
from civicstat.llm.common import brief_files, cut, discard, one_label, prepare, remainder, written

SYMBOLS = 32
ORDER = 5
#: The highest order whose counts both classes share.
SHARED = 2
DISCOUNT = 0.75
#: Log ratios are kept in steps of 1 / STEPS, at most 127 steps from 0.
STEPS = 8
THRESHOLD = 0.7
#: Five-grams that a task holds before it counts them.
HELD_GRAMS = 2_000_000


@lru_cache(maxsize=1)
def _symbol_of() -> np.ndarray:
    """The symbol of each code point."""
    out = np.zeros(0x110000, np.uint8)
    groups = {"a": 27, "o": 27, "e": 28, "i": 29, "u": 29}
    for c in range(0x3000):
        ch = chr(c).lower()[0]
        if ch.isalpha():
            base = unicodedata.normalize("NFKD", ch)
            if base[0] in "abcdefghijklmnopqrstuvwxyz":
                out[c] = ord(base[0]) - 96 if len(base) == 1 else groups.get(base[0], 30)
            else:
                out[c] = 31 if c < 0x250 else 1 + c % 26
    out[0x3000:] = 1 + np.arange(0x3000, 0x110000) % 26
    return out


def grams(text: str | None) -> np.ndarray:
    """The five-gram that ends at each symbol of a whole text, as a number;
    symbols before a word's boundary count as boundaries. A text without a
    letter is one boundary."""
    s = _symbol_of()[np.frombuffer(f"{text or ''} ".encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int32)
    s = s[(s > 0) | (np.concatenate([[0], s[:-1]]) > 0)]
    if not len(s):
        return np.zeros(1, np.int32)
    out, inside = s.copy(), np.ones(len(s), bool)
    for i in range(1, min(ORDER, len(s) + 1)):
        before = np.concatenate([np.zeros(i, np.int32), s[:-i]])
        inside &= before > 0
        out += np.where(inside, before, 0) * SYMBOLS ** i
    return out


def _level(counts: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Interpolated probabilities of one order from those of the order below."""
    c = counts.reshape(-1, SYMBOLS)
    total, kinds = c.sum(axis=1, keepdims=True), (c > 0).sum(axis=1, keepdims=True)
    below = np.resize(low, c.size).reshape(c.shape)
    found = (np.maximum(c - DISCOUNT, 0) + DISCOUNT * kinds * below) / np.maximum(total, 1)
    return np.where(total > 0, found, below).astype(np.float32).ravel()


def _continuations(counts: np.ndarray) -> np.ndarray:
    """How many symbols were seen before each n-gram one shorter."""
    return (counts > 0).reshape(SYMBOLS, -1).sum(axis=0).astype(np.float32)


def log_ratios(tables: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Log ratio of class 1 to class 0 for every five-gram, in steps.

    ``tables`` has the distinct five-grams of each class, sorted, with counts.
    """
    width = SYMBOLS ** (ORDER - 1)

    def part(k: int, first: int) -> np.ndarray:
        g, n = tables[k]
        a, b = np.searchsorted(g, [first * width, (first + 1) * width])
        out = np.zeros(width, np.float32)
        out[g[a:b] - first * width] = n[a:b]
        return out

    high = [sum((part(k, i) > 0).astype(np.float32) for i in range(SYMBOLS)) for k in (0, 1)]
    both = sum(((part(0, i) + part(1, i)) > 0).astype(np.float32) for i in range(SYMBOLS))
    shared = {ORDER - 1: both}
    for o in range(ORDER - 2, 0, -1):
        shared[o] = _continuations(shared[o + 1])
    low = np.full(1, 1 / SYMBOLS, np.float32)
    for o in range(1, SHARED + 1):
        low = _level(shared[o], low)
    lows = []
    for c in high:
        own = {ORDER - 1: c}
        for o in range(ORDER - 2, SHARED, -1):
            own[o] = _continuations(own[o + 1])
        p = low
        for o in range(SHARED + 1, ORDER):
            p = _level(own[o], p)
        lows.append(p)
    out = np.empty(SYMBOLS * width, np.int8)
    for i in range(SYMBOLS):
        ratio = np.log(_level(part(1, i), lows[1])) - np.log(_level(part(0, i), lows[0]))
        out[i * width:(i + 1) * width] = np.clip(np.rint(ratio * STEPS), -127, 127)
    return out


@lru_cache(maxsize=3)
def _unpacked(packed: bytes) -> np.ndarray:
    """Once in each worker."""
    return np.frombuffer(zlib.decompress(packed), np.int8)


def count_grams(rows: DataFrame) -> DataFrame:
    """(label, half, gram, n) of ``rows`` (text, label, half)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [(np.zeros(0, np.int32), np.zeros(0, np.int64))] * 4
        held: list[list[np.ndarray]] = [[], [], [], []]

        def merge() -> None:
            for k, own in enumerate(held):
                g, n = np.unique(np.concatenate([np.zeros(0, np.int32), *own]), return_counts=True)
                own.clear()
                every, at = np.unique(np.concatenate([known[k][0], g]), return_inverse=True)
                known[k] = every, np.bincount(at, np.concatenate([known[k][1], n]), len(every)).astype(np.int64)

        for b in batches:
            for t, k in zip(b.column(0).to_pylist(), (b.column(1).to_numpy() * 2 + b.column(2).to_numpy()).tolist()):
                held[k].append(grams(t))
            if sum(len(g) for own in held for g in own) >= HELD_GRAMS:
                merge()
        merge()
        for k, (g, n) in enumerate(known):
            yield pa.RecordBatch.from_pydict({
                "label": pa.array(np.full(len(g), k // 2, np.int32)), "half": pa.array(np.full(len(g), k % 2, np.int32)),
                "gram": pa.array(g), "n": pa.array(n)})

    return (rows.mapInArrow(run, "label int, half int, gram int, n bigint")
            .groupBy("label", "half", "gram").agg(F.sum("n").alias("n")))


def fit_curve(rows: DataFrame, names: list[str], signs: list[int]) -> np.ndarray:
    """Weights and offset of a logistic curve over the columns ``names`` of
    ``rows`` (label, names) by Newton's method (a weak ridge keeps the weights
    finite when the classes separate). Each step adds up slopes and curvatures
    in the tasks. A weight of the wrong sign becomes 0, so the score never
    falls with a gain or rises with a loss."""
    d = len(names)

    def sums(of: Callable[[np.ndarray, np.ndarray], np.ndarray], n: int) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(n)
            for b in batches:
                cols = [b.column(i).to_numpy().astype(float) for i in range(d + 1)]
                out += of(np.stack([*cols[1:], np.ones(len(cols[0]))], axis=1), cols[0])
            yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(n, dtype=np.int32)), "x": pa.array(out)})

        total = np.zeros(n)
        for r in rows.select("label", *names).mapInArrow(run, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect():
            total[r.i] = r.x
        return total

    squares = sums(lambda x, _: (x ** 2).sum(axis=0), d + 1)
    scale = np.sqrt(squares / max(squares[-1], 1))
    scale[scale == 0] = 1.0
    ridge = np.diag([0.01] * d + [1e-6])
    keep, w = np.ones(d + 1, bool), np.zeros(d + 1)
    while True:
        last, best, move = w, np.inf, np.zeros(d + 1)
        for _ in range(60):
            def at(x: np.ndarray, label: np.ndarray, w: np.ndarray = w) -> np.ndarray:
                z = x / scale
                p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
                return np.concatenate([[(np.logaddexp(0, z @ w) - label * (z @ w)).sum()], z.T @ (p - label),
                                       ((z * (p * (1 - p))[:, None]).T @ z).ravel()])

            got = sums(at, 1 + (d + 1) * (d + 2))
            if (now := got[0] + w @ ridge @ w / 2) > best + 1e-9 * abs(best):
                move = move / 2  # too far
            else:
                slope, curve = got[1:d + 2] + ridge @ w, got[d + 2:].reshape(d + 1, d + 1) + ridge
                last, best, move = w, now, np.zeros(d + 1)
                move[keep] = np.linalg.solve(curve[np.ix_(keep, keep)], slope[keep])
            if np.abs(move).max() < 1e-3:
                break
            w = last - move
        w = last
        wrong = np.append(w[:-1] * signs < 0, False)
        if not wrong.any():
            return w / scale
        keep &= ~wrong
        w = np.where(keep, w, 0.0)


def classify(docs: DataFrame, labels: DataFrame, half: Column) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text).

    ``labels``: (id, label), one row per id; ``half``: 0 or 1 from ``id``,
    which splits the labelled rows for the curve. Null and empty texts are one
    boundary and score like any other text; very long texts count with all their
    n-grams; repeated rows get equal scores, and ties stand as they are; other
    columns are ignored. If a label is missing all scores are that of
    the other one (0.0 without any). An empty table gives no row.
    """
    prepare(docs.sparkSession)
    with brief_files(docs.sparkSession):
        return _classify(docs, labels, half)


def _classify(docs: DataFrame, labels: DataFrame, half: Column) -> DataFrame:
    spark = docs.sparkSession
    known = labels.withColumn("half", half.cast("int"))
    # labels grow with the corpus: a shuffle at every size, never a broadcast
    own = docs.select("doc_id", "text")
    labelled, labelled_path = written(own.join(known.hint("merge"), own["doc_id"] == known["id"]).select("text", "label", "half"))
    counted, counted_path = written(count_grams(labelled))
    seen = counted.toArrow()
    discard(spark, counted_path)
    label, side, gram, n = (seen.column(i).to_numpy() for i in range(4))
    if not {0, 1} <= set(np.unique(label).tolist()):
        only = float(label.max()) if len(label) else 0.0
        return docs.select("doc_id", F.lit(only).alias("score"))

    def ratios(keep: np.ndarray) -> np.ndarray:
        tables = []
        for k in (0, 1):
            own = keep & (label == k)
            g, at = np.unique(gram[own], return_inverse=True)
            tables.append((g.astype(np.int64), np.bincount(at, n[own], len(g)).astype(np.float32)))
        return log_ratios(tables)

    models = spark.sparkContext.broadcast([zlib.compress(ratios(keep), 1) for keep in (
        np.ones(len(gram), bool), side == 1, side == 0)])  # from all rows, for half 0, for half 1
    del seen, label, side, gram, n
    text_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    encoded, encoded_path = written(gramblocks.encode(labelled))
    discard(spark, labelled_path)
    model = gramblocks.learn(encoded, text_bytes)
    discard(spark, encoded_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            g = [grams(t) for t in b.column(1).to_pylist()]
            sizes = np.fromiter(map(len, g), np.int64, len(g))
            flat, starts = np.concatenate(g), np.cumsum(sizes) - sizes
            raw = []
            for m in models.value:
                steps = _unpacked(m)[flat]
                gain = np.add.reduceat(np.maximum(steps, 0), starts, dtype=np.int64)
                loss = gain - np.add.reduceat(steps, starts, dtype=np.int64)
                raw += [gain / (sizes * STEPS), loss / (sizes * STEPS)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), *map(pa.array, raw)],
                                             ["doc_id", "row", "half", *names])

    rows = docs.select("doc_id", "text", F.col("doc_id").alias("id")).withColumn("half", half.cast("int")).select(
        "doc_id", "text", F.xxhash64("doc_id", "text").alias("row"), "half")
    names = ["gain", "loss", "gain0", "loss0", "gain1", "loss1"]
    schema = T.StructType([rows.schema["doc_id"], T.StructField("row", T.LongType()), T.StructField("half", T.IntegerType()),
                           *[T.StructField(c, T.DoubleType()) for c in names]])
    # repeated rows add up under one number, their words too
    parts = cut(gramblocks.sums(rows, model))
    model.drop()
    letters = cut(rows.mapInArrow(run, schema))

    def other(name: str) -> Column:
        return F.when(F.col("half") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1")).alias(f"{name}x")

    def each(name: str) -> Column:
        return (F.col(name) / F.col("words")).alias(name)

    scored = cut(letters.join(parts, "row").select(
        "doc_id", "gain", "loss", other("gain"), other("loss"), *[each(f"{c}{x}") for c in wordgrams.PARTS for x in ("", "x")]))
    used = ["gain", "loss", *wordgrams.PARTS]
    fitted = cut(scored.join(known, scored["doc_id"] == known["id"]).select("label", *[F.col(f"{c}x").alias(c) for c in used]))
    *w, c = fit_curve(fitted, used, [1, -1] * (len(used) // 2)).tolist()
    score = 1 / (1 + F.exp(-(sum((F.col(x) * a for x, a in zip(used, w)), F.lit(c)))))
    return scored.select("doc_id", score.alias("score"))


def toxicity_digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    known = one_label(labels, "toxic").where(remainder(F.col("id"), 3) != 1)
    crc = F.crc32(F.col("id").cast("string").cast("binary"))
    found = classify(documents, known, F.floor(crc / 3) % 2)
    return found.select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
