"""Secret scan: patterns, and a battery of randomness tests with false-discovery control.

Three fixed patterns find the base spans. Beside them every long run of token
characters is a candidate. Its encoding is the smallest known alphabet that
holds all its symbols, and three tests ask whether it may be a uniform draw
from that alphabet: chi-squared over equal cells of the alphabet (as many cells
as the length can fill), runs above and below the alphabet's middle, and serial
correlation of neighbouring symbols. Symbols are ranked by how common they are
in writing, so that words fill few cells, stay in the lower half and fail.
A candidate's p-value is three times its smallest one, at most 1.

Machine-made secrets have p-values spread evenly from 0 to 1, whatever the
length; words have small ones, the smaller the longer they are. So each class
of lengths gets a threshold of its own. Twice the number of candidates with p
above 1/2 estimates how many random ones there are; a threshold t should then
let (1 - t) of these pass, and what passes beyond are false discoveries. The
smallest t at which they are at most ``LEVEL`` of what passes is taken, but none
below ``LEVEL`` over the number of random tokens, where hardly any is left to
find. Short classes, in which words pass more easily, end up with higher
thresholds or none. Distinct tokens of all documents count, so copies of a
text add nothing.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicstat.llm.common import cut, prepare

# The base patterns, on UTF-8 bytes (their classes are ASCII).
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ASSIGN_WORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
ASSIGN_LENGTH = 12
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 18
HEX_LENGTH = 16
BASE = ("assign", "access", "hex")

# Letters by how common they are in writing.
COMMON = "etaoinsrhldcumfpgwybvkxjqz"
DIGITS = "0123456789"
#: Encodings, smaller alphabets first; the symbols in order of rank.
ENCODINGS = {
    "random_hex": "eadcfb" + DIGITS,
    "random_hex_upper": "EADCFB" + DIGITS,
    "random_base32": COMMON.upper() + "234567",
    "random_base36": COMMON + DIGITS,
    "random_base62": COMMON + COMMON.upper() + DIGITS,
    "random_base64": COMMON + COMMON.upper() + DIGITS + "+/",
    "random_base64url": COMMON + COMMON.upper() + DIGITS + "-_",
    "random_token": COMMON + COMMON.upper() + DIGITS + "+/-_",
}
KINDS = (*BASE, *ENCODINGS)

#: Candidates have so many symbols at least; classes of lengths begin here.
LENGTHS = (20, 24, 32, 48, 96)
#: Expected symbols in a cell of the chi-squared test.
PER_CELL = 5
MOST_CELLS = 16
LEVEL = 0.05
#: Bytes of text that are looked at together.
SLICE = 1 << 20
#: p-values are counted in steps of 1 / STEPS of a power of ten.
STEPS, MOST_STEP = 10, 300


def _class(symbols: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in symbols]] = True
    return out


_HEX, _TOKEN = _class("abcdef" + DIGITS), _class(ENCODINGS["random_token"])


def _ranks() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rank of each byte in each encoding (-1: not of it), sizes, and the
    symbols of each cell by encoding and number of cells."""
    rank = np.full((len(ENCODINGS), 256), -1)
    for i, symbols in enumerate(ENCODINGS.values()):
        rank[i, [ord(c) for c in symbols]] = np.arange(len(symbols))
    sizes = np.array([len(s) for s in ENCODINGS.values()])
    cells = np.zeros((len(ENCODINGS), MOST_CELLS + 1, MOST_CELLS))
    for i, size in enumerate(sizes.tolist()):
        for m in range(2, MOST_CELLS + 1):
            cells[i, m] = np.bincount(np.arange(size) * m // size, minlength=MOST_CELLS)
    return rank, sizes, cells


_RANK, _SIZE, _CELLS = _ranks()


def runs(mask: np.ndarray, breaks: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the runs of ``mask`` of at least ``least``, which
    also end at ``breaks``."""
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    inner = breaks[(breaks > 0) & (breaks < len(mask))]
    inner = np.unique(inner[mask[inner] & mask[inner - 1]])
    start, stop = np.sort(np.concatenate([start, inner])), np.sort(np.concatenate([stop, inner]))
    keep = stop - start >= least
    return start[keep], stop[keep]


_erfc = np.frompyfunc(math.erfc, 1, 1)


def _upper(z: np.ndarray) -> np.ndarray:
    """How likely a standard normal number is above z."""
    return _erfc(z / math.sqrt(2)).astype(float) / 2


@dataclass
class Battery:
    """Tests of many tokens at once."""

    encoding: np.ndarray
    chi: np.ndarray
    runs: np.ndarray
    serial: np.ndarray

    @property
    def p(self) -> np.ndarray:
        return np.minimum(1.0, 3 * np.min([self.chi, self.runs, self.serial], axis=0))


def battery(symbols: np.ndarray, sizes: np.ndarray) -> Battery:
    """p-values of tokens given as their bytes one after another; every token
    has two symbols at least, all of them of the largest alphabet."""
    n, first = sizes.astype(float), np.cumsum(sizes) - sizes
    fits = np.array([np.minimum.reduceat(r[symbols], first) >= 0 for r in _RANK])
    encoding = fits.argmax(axis=0)
    of = np.repeat(np.arange(len(sizes)), sizes)
    rank, size = _RANK[encoding[of], symbols], _SIZE[encoding]

    # Wilson and Hilferty: the cube root of chi-squared over its degrees is nearly normal
    m = np.clip(sizes // PER_CELL, 2, MOST_CELLS)
    seen = np.bincount(of * MOST_CELLS + rank * m[of] // size[of], minlength=len(sizes) * MOST_CELLS).reshape(-1, MOST_CELLS)
    expected = _CELLS[encoding, m] * (n / size)[:, None]
    chi2 = np.where(expected > 0, (seen - expected) ** 2 / np.maximum(expected, 1e-9), 0.0).sum(axis=1)
    spread = 2 / (9 * (m - 1.0))
    chi = _upper(((chi2 / (m - 1)) ** (1 / 3) - (1 - spread)) / np.sqrt(spread))

    # runs of the upper and the lower half, as many as fair draws give
    high = rank * 2 >= size[of]
    same = np.ones(len(rank), bool)
    same[first] = False
    turn = np.zeros(len(rank))
    turn[1:] = high[1:] != high[:-1]
    share = ((size + 1) // 2) / size  # of the lower half
    odds = 2 * share * (1 - share)
    turns = np.add.reduceat(turn * same, first)
    spread = np.sqrt((n - 1) * odds * (1 - odds) + 2 * (n - 2) * (share * (1 - share) - odds ** 2))
    by_runs = 2 * _upper(np.abs(turns - (n - 1) * odds) / spread)

    x = (rank - (size[of] - 1) / 2) / np.sqrt((size[of] ** 2 - 1) / 12)
    product = np.zeros(len(rank))
    product[1:] = x[1:] * x[:-1]
    serial = 2 * _upper(np.abs(np.add.reduceat(product * same, first)) / np.sqrt(n - 1))
    return Battery(encoding, chi, by_runs, serial)


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts of about SLICE bytes; a longer text is alone."""
    texts = texts.fill_null("").cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    first = 0
    while first < len(texts):
        after = max(first + 1, int(np.searchsorted(at, at[first] + SLICE, side="right")) - 1)
        yield texts[first:after]
        first = after


def _spans(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Base spans and candidates of each text."""
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    found = []  # (kind, start, stop) in bytes of the batch
    for start, stop in zip(at[:-1].tolist(), at[1:].tolist()):
        text = whole[start:stop].tobytes()
        low = text.lower()
        if any(w in low for w in ASSIGN_WORDS):
            found += [(0, start + x.start(), start + x.end()) for x in ASSIGN.finditer(text) if len(x.group(2)) >= ASSIGN_LENGTH]
        if b"AKIA" in text:
            found += [(1, start + x.start(), start + x.end()) for x in ACCESS.finditer(text) if len(x.group()) >= ACCESS_LENGTH]
    found += [(2, a, b) for a, b in zip(*(x.tolist() for x in runs(_HEX[whole], at, HEX_LENGTH)))]
    base = np.array(found, np.int64).reshape(-1, 3)
    base = base[np.lexsort((base[:, 0], base[:, 1]))]

    start, stop = runs(_TOKEN[whole], at, LENGTHS[0])
    if len(base) and len(start):
        # those that touch no base span
        reach = np.maximum.accumulate(base[:, 2])
        before = np.searchsorted(base[:, 1], stop) - 1
        free = (before < 0) | (reach[np.maximum(before, 0)] <= start)
        start, stop = start[free], stop[free]
    sizes = stop - start
    if len(start):
        inside = np.repeat(start - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        tests = battery(whole[inside], sizes)
        encoding, p = tests.encoding + len(BASE), tests.p
    else:
        encoding, p = np.zeros(0, int), np.zeros(0)
    token = np.array([xxhash.xxh3_64_intdigest(whole[a:b].tobytes()) for a, b in zip(start.tolist(), stop.tolist())], np.uint64).view(np.int64)

    rest = np.flatnonzero((whole & 0xC0) == 0x80)  # bytes that begin no code point

    def spans(kind: np.ndarray, a: np.ndarray, b: np.ndarray, **more: np.ndarray) -> pa.Array:
        text = np.searchsorted(at, a, side="right") - 1
        skipped = np.searchsorted(rest, at[text])
        cols = {"kind": pa.array(kind, pa.int32()),
                **{name: pa.array(x - at[text] - (np.searchsorted(rest, x) - skipped), pa.int64()) for name, x in (("start", a), ("end", b))},
                **{name: pa.array(x) for name, x in more.items()}}
        offsets = np.searchsorted(text, np.arange(len(texts) + 1))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(list(cols.values()), list(cols)))

    return (spans(base[:, 0], base[:, 1], base[:, 2]),
            spans(encoding, start, stop, p=p, length=np.asarray(sizes, np.int64), token=token))


_SPAN = "kind: int, start: long, end: long"
_FOUND = f"base array<struct<{_SPAN}>>, more array<struct<{_SPAN}, p: double, length: long, token: long>>"


def _length_class(length: Column) -> Column:
    out = F.lit(0)
    for i, least in enumerate(LENGTHS[1:], 1):
        out = F.when(length >= least, i).otherwise(out)
    return out


def threshold(counts: dict[int, int], level: float = LEVEL) -> float:
    """The smallest p-value to pass, from the number of tokens by step (step s
    holds p from 10 ** (-(s + 1) / STEPS) to 10 ** (-s / STEPS)); 1 if none."""
    half = sum(n for s, n in counts.items() if 10 ** (-(s + 1) / STEPS) >= 0.5)
    edge = max((s for s in range(MOST_STEP) if 10 ** (-(s + 1) / STEPS) >= 0.5), default=0)
    random = half / (1 - 10 ** (-(edge + 1) / STEPS))
    best, passed = 1.0, 0
    for s in range(MOST_STEP):
        passed += counts.get(s, 0)
        least = 10 ** (-(s + 1) / STEPS)
        if least * random >= level and passed and 1 - random * (1 - least) / passed <= level:
            best = least
    return best


def scan(docs: DataFrame, level: float = LEVEL) -> DataFrame:
    """(doc_id, base, spans) of every row of ``docs`` (doc_id, text): arrays of
    kind, start, end (code points, end exclusive), in order of start, then of
    the kind in ``KINDS``. ``base`` has the patterns' spans, ``spans`` also the
    tokens that pass as random with their p-value.

    Tokens that touch a base span are not tested. Null and empty texts have no
    span; repeated rows get equal spans; a whole text is looked at, and it must
    fit a task's memory. Equal p-values pass together. Without candidates of a
    length class nothing of it passes. An empty table gives no row; other
    columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = 0
            for texts in _slices(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0)[done:done + len(texts)], *_spans(texts)], ["doc_id", "base", "more"])
                done += len(texts)

    found = cut(rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL(_FOUND).fields])))
    tokens = found.select(F.explode("more").alias("t")).select("t.*")
    step = F.least(F.floor(-F.log10(F.greatest("p", F.lit(1e-300))) * STEPS), F.lit(MOST_STEP - 1)).cast("int")
    counts: dict[int, dict[int, int]] = {}
    # at most LENGTHS * MOST_STEP rows
    for r in tokens.groupBy(_length_class(F.col("length")).alias("c"), step.alias("s")).agg(F.countDistinct("token").alias("n")).collect():
        counts.setdefault(r["c"], {})[r["s"]] = r["n"]
    least = F.array(*[F.lit(threshold(counts.get(c, {}), level)) for c in range(len(LENGTHS))])

    def named(span: Column, p: Column) -> Column:
        return F.struct(span["start"].alias("start"), span["kind"].alias("nth"), span["end"].alias("end"), p.alias("p"))

    base = F.transform("base", lambda s: named(s, F.lit(None).cast("double")))
    more = F.transform(F.filter("more", lambda s: s["p"] > F.get(least, _length_class(s["length"]))), lambda s: named(s, s["p"]))
    kinds = F.array(*map(F.lit, KINDS))

    def told(spans: Column) -> Column:
        return F.transform(F.array_sort(spans), lambda s: F.struct(
            F.get(kinds, s["nth"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["p"].alias("p")))

    return found.select("doc_id", told(base).alias("base"), told(F.concat(base, more)).alias("spans"))


def _text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets_digest(documents: DataFrame) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scan(documents).select(
        "doc_id", *map(count, BASE),
        F.sha2(_text(F.col("base")).cast("binary"), 256).alias("base_sha256"), _text(F.col("spans")).alias("spans"))
