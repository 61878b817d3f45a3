"""Word trigrams of two classes as Spark tables.

Words are runs between white space without punctuation at their ends, in one
case; digits and signs inside stay, and scripts that put no spaces are taken
by the character. A word is its 64-bit hash, and a text begins with two
boundaries and ends with another.

Kneser-Ney: orders one to three have counts of the class (below three: how
many words were seen before), and order one of both classes backs off to the
same continuation counts, gathered from the bigrams of either. With n the
count of a gram in a class, K the kinds of words after its context and q the
probability of the gram one shorter, the gram's probability is x + 1 times
what backing off gives, x = max(n - D, 0) / (D K q). A gram's weight is
log(x + 1) of class 1 less that of class 0; grams that neither class has weigh
nothing. So a text's weights are sums over a join of its grams with one table.

Nothing here has a bound: the tables have a row for every distinct gram of the
labelled rows. The driver gets one row of sums.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicstat.llm.common import cut

ORDER = 3
DISCOUNT = 0.75
#: Counts are kept for both classes of three models: all rows, and those of
#: half 1 (scores half 0) and half 0 (scores half 1).
MODELS = 3
_EDGE = string.punctuation + "«»“”„‘’‚…–—¡¿·、。，！？：；（）「」"
_ALONE = "฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff"
_PARTS = re.compile(f"[{_ALONE}]|[^{_ALONE}]+")
_BEGIN, _END = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b"\0begin", b"\0end"))


def _words_of(token: str) -> list[str]:
    w = token.strip(_EDGE) or token
    return [w] if w.isascii() else _PARTS.findall(w)


def words(text: str | None) -> list[str]:
    return [w for token in (text or "").casefold().split() for w in _words_of(token)]


#: Hashes of tokens met by this process; emptied when it has so many.
_HASHES: dict[str, tuple[int, ...]] = {}
_MOST_HASHES = 50_000


def hashes(text: str | None) -> list[int]:
    """Of the words of a text."""
    out: list[int] = []
    for token in (text or "").casefold().split():
        own = _HASHES.get(token)
        if own is None:
            if len(_HASHES) >= _MOST_HASHES:
                _HASHES.clear()
            own = _HASHES[token] = tuple(xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in _words_of(token))
        out += own
    return out


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First, second and third word of the trigram that ends at each word of a
    text and at its end."""
    s = np.concatenate([[_BEGIN, _BEGIN], np.array(hashes(text), np.uint64), [_END]])
    return s[:-2], s[1:-1], s[2:]


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _turned_column(x: str, bits: int) -> Column:
    return F.shiftleft(x, bits).bitwiseOR(F.shiftrightunsigned(x, 64 - bits))


def keys(u: np.ndarray, v: np.ndarray, w: np.ndarray) -> list[np.ndarray]:
    """Of the one, two and three last words."""
    two = _turned(v, 21) ^ w
    return [w, two, _turned(u, 42) ^ two]


def count_trigrams(rows: DataFrame) -> DataFrame:
    """(u, v, w, n0 .. n5) of ``rows`` (text, label, half): counts of class 0
    in all rows, half 1, half 0, then those of class 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            group = b.column(1).to_numpy() * 2 + b.column(2).to_numpy()
            found = [trigrams(t) for t in b.column(0).to_pylist()]
            for k in range(4):
                own = [f for f, g in zip(found, group) if g == k]
                if own:
                    u, v, w = (np.concatenate(x) for x in zip(*own))
                    _, at, n = np.unique(keys(u, v, w)[2], return_index=True, return_counts=True)
                    yield pa.RecordBatch.from_pydict({
                        "label": pa.array(np.full(len(at), k // 2, np.int32)), "half": pa.array(np.full(len(at), k % 2, np.int32)),
                        **{c: pa.array(x[at].view(np.int64)) for c, x in (("u", u), ("v", v), ("w", w))}, "n": pa.array(n.astype(np.int64))})

    found = rows.mapInArrow(run, "label int, half int, u bigint, v bigint, w bigint, n bigint")
    sums = []
    for label in (0, 1):
        for model in range(MODELS):
            use = F.col("label") == label
            use = use & (F.col("half") == 2 - model) if model else use
            sums.append(F.sum(F.when(use, F.col("n")).otherwise(0)).alias(f"n{label * MODELS + model}"))
    return found.groupBy("u", "v", "w").agg(*sums)


_SIX = range(2 * MODELS)


def _kinds(grams: DataFrame, by: list[str], name: str) -> DataFrame:
    return grams.groupBy(*by).agg(*[F.count_if(F.col(f"n{i}") > 0).alias(f"{name}{i}") for i in _SIX],
                                  *([F.sum(f"n{i}").alias(f"t{i}") for i in _SIX] if name == "k" else []))


def _more(i: int) -> Column:
    """x + 1 of a gram, from n, k and q."""
    return F.when(F.col(f"k{i}") > 0, 1 + F.greatest(F.col(f"n{i}") - DISCOUNT, F.lit(0.0)) / (DISCOUNT * F.col(f"k{i}") * F.col(f"q{i}"))).otherwise(1.0)


def _chance(i: int) -> Column:
    back = F.when(F.col(f"k{i}") > 0, DISCOUNT * F.col(f"k{i}") / F.col(f"t{i}")).otherwise(1.0)
    return (back * F.col(f"q{i}") * _more(i)).alias(f"p{i}")


def _weights() -> list[Column]:
    return [(F.log(_more(MODELS + m)) - F.log(_more(m))).alias(f"d{m}") for m in range(MODELS)]


def weigh(counts: DataFrame) -> DataFrame:
    """(key, size, d0, d1, d2): the weight of every gram of ``counts``, of
    ``size`` words, in each model."""
    three = cut(counts)
    two = cut(_kinds(three, ["v", "w"], "n"))
    either = [F.count_if((F.col(f"n{m}") > 0) | (F.col(f"n{MODELS + m}") > 0)).alias(f"b{m}") for m in range(MODELS)]
    one = cut(two.groupBy("w").agg(*[F.count_if(F.col(f"n{i}") > 0).alias(f"n{i}") for i in _SIX], *either))
    total = one.agg(*[F.count_if(F.col(f"n{i}") > 0).alias(f"k{i}") for i in _SIX], *[F.sum(f"n{i}").alias(f"t{i}") for i in _SIX],
                    *[F.sum(f"b{m}").alias(f"s{m}") for m in range(MODELS)],
                    *[F.count_if(F.col(f"b{m}") > 0).alias(f"v{m}") for m in range(MODELS)]).first()
    base = [(F.greatest(F.col(f"b{m}") - DISCOUNT, F.lit(0.0)) + DISCOUNT * (total[f"v{m}"] or 0) / ((total[f"v{m}"] or 0) + 1))
            / max(total[f"s{m}"] or 0, 1) for m in range(MODELS)]
    full = one.select("w", *[f"n{i}" for i in _SIX], *[F.greatest(base[i % MODELS], F.lit(1e-12)).alias(f"q{i}") for i in _SIX],
                      *[F.lit(total[f"{c}{i}"] or 0).alias(f"{c}{i}") for c in "kt" for i in _SIX])
    out = [full.select(F.col("w").alias("key"), F.lit(1).alias("size"), *_weights())]
    below = full.select("w", *[_chance(i) for i in _SIX])
    for size, grams, context, low in ((2, two, ["v"], ["w"]), (3, three, ["u", "v"], ["v", "w"])):
        q = below.withColumnsRenamed({f"p{i}": f"q{i}" for i in _SIX})
        full = grams.join(_kinds(grams, context, "k").hint("merge"), context).join(q.hint("merge"), low)
        key = _turned_column("v", 21).bitwiseXOR(F.col("w"))
        key = key.bitwiseXOR(_turned_column("u", 42)) if size == 3 else key
        out.append(full.select(key.alias("key"), F.lit(size).alias("size"), *_weights()))
        if size < ORDER:
            below = cut(full.select("v", "w", *[_chance(i) for i in _SIX]))
    return out[0].union(out[1]).union(out[2])


#: Gain and loss of each order.
PARTS = [f"{kind}{size}" for size in range(1, ORDER + 1) for kind in ("more", "less")]


def sums(docs: DataFrame, weights: DataFrame) -> DataFrame:
    """(row, PARTS, PARTS with an x) of ``docs`` (row, half, text): sums of the
    weights above 0 and of those below, of all rows' model and of the model
    of the other half. Rows without a known gram are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, half, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                key, n = np.unique(np.concatenate(keys(*trigrams(text))), return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array(np.full(len(key), row, np.int64)), "half": pa.array(np.full(len(key), half or 0, np.int32)),
                    "key": pa.array(key.view(np.int64)), "n": pa.array(n.astype(np.int32))})

    found = docs.select("row", "half", "text").mapInArrow(run, "row bigint, half int, key bigint, n int")
    # one row for each gram of a document; common grams are split by the skew join
    both = found.join(weights.hint("merge"), "key").select(
        "row", "n", "size", F.col("d0").alias("d"), F.when(F.col("half") == 0, F.col("d1")).otherwise(F.col("d2")).alias("dx"))
    out = []
    for x in ("", "x"):
        for size in range(1, ORDER + 1):
            for kind, sign in (("more", 1), ("less", -1)):
                part = F.greatest(F.col(f"d{x}") * sign, F.lit(0.0)) * F.col("n")
                out.append(F.sum(F.when(F.col("size") == size, part).otherwise(0.0)).alias(f"{kind}{size}{x}"))
    return both.groupBy("row").agg(*out)
