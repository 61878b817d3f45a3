"""SimHash near-duplicates with pivot distance tables.

A fingerprint has a bit set if more than half of a text's shingle hashes have
it. Copies collapse to one row per distinct fingerprint before anything is
compared.

Candidates: with r = ``max_bits`` the 64 bits are cut into r + t parts. Two
fingerprints that differ in r bits at most agree on t of the parts, whichever
they are, so every choice of t parts is a key and all linked pairs meet under
a key. t grows with the number of fingerprints, so that a random bucket stays
small at any size; results do not depend on it. A bucket of more than
``tile`` fingerprints is cut into chunks, and each two chunks meet in one
tile, so no task holds more than two chunks of a bucket.

Inside a tile each fingerprint has a row of its Hamming distances to many
reference fingerprints. Distances obey the triangle inequality, so a pair
with a coordinate that differs by more than r cannot be linked; rows are
sorted by the first coordinate, which ends the search early, the other
coordinates discard most of the rest, and survivors are verified on all bits.
A tile passes on only the links that join two of its groups; components
follow from them by smallest labels and pointer jumping.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicstat.llm.common import cut, fresh, prepare

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Reference fingerprints: hashes of their numbers.
PIVOTS = np.array([xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(16)], np.uint64)
TILE = 512
#: Fingerprints that a random bucket should hold at most.
BUCKET = 64


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Of a whole text with A-Z in lower case; 0 without words."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:n - 1].tolist()]
    stops = (ends[-n:] - 1).tolist()
    h = np.fromiter((xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, n)
    votes = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        votes += np.unpackbits(h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> tuple[DataFrame, str]:
    """``docs`` (text, any others) with a bigint column of fingerprints (the
    bits as a signed number) whose name avoids any column ``docs`` has."""
    prepare(docs.sparkSession)
    out, = fresh(docs, "fingerprint")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = np.array([fingerprint(t, shingle) for t in b.column(at).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(f.view(np.int64))], [*b.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())])), out


def _keys(f: Column, max_bits: int, agree: int) -> Column:
    """Array of (number of the choice, bits of the chosen parts)."""
    edges = [round(i * 64 / (max_bits + agree)) for i in range(max_bits + agree + 1)]
    out = []
    for k, parts in enumerate(combinations(range(max_bits + agree), agree)):
        mask = sum(((1 << edges[i + 1]) - (1 << edges[i])) for i in parts)
        mask -= (1 << 64) if mask >> 63 else 0
        out.append(F.struct(F.lit(k).alias("choice"), f.bitwiseAND(F.lit(mask).cast("long")).alias("bits")))
    return F.array(*out)


def parts_to_agree(n: int, max_bits: int, bucket: int = BUCKET) -> int:
    """The fewest parts whose bits leave random buckets of ``bucket`` at most."""
    t = 1
    while n > bucket << (64 * t // (max_bits + t)) and comb(max_bits + t + 1, t + 1) <= 128:
        t += 1
    return t


def linked(f: np.ndarray, tile: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links (as positions) that join the groups of each tile. Rows of a tile
    stand together."""
    table = np.bitwise_count(f[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    order = np.lexsort((table[:, 0], tile))
    f, tile, table = f[order], tile[order], np.ascontiguousarray(table[order].T)
    group, out = np.arange(len(f)), []

    def top(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    a, d = np.arange(len(f)), 0
    while len(a):
        d += 1
        a = a[a + d < len(f)]
        a = a[(tile[a] == tile[a + d]) & (table[0][a + d] - table[0][a] <= max_bits)]
        x = a
        for row in table[1:]:
            x = x[np.abs(row[x] - row[x + d]) <= max_bits]
        x = x[np.bitwise_count(f[x] ^ f[x + d]) <= max_bits]
        for i in x[group[x] != group[x + d]].tolist():
            if (p := top(i)) != (q := top(i + d)):
                group[max(p, q)] = min(p, q)
                out.append((int(order[i]), int(order[i + d])))
        while len(x) and not np.array_equal(group, up := group[group]):
            group = up
    return out


def links(prints: DataFrame, max_bits: int, tile: int = TILE) -> DataFrame:
    """(a, b): links between the distinct fingerprints of ``prints`` (f) that
    leave all components as all links would."""
    t = parts_to_agree(prints.count(), max_bits)
    keyed = prints.select("f", F.explode(_keys(F.col("f"), max_bits, t)).alias("k")).select("k.choice", "k.bits", "f")
    sizes = keyed.groupBy("choice", "bits").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    rows = keyed.join(sizes, ["choice", "bits"])
    chunks = F.ceil(F.col("n") / tile).cast("int")
    own = F.pmod(F.xxhash64("f"), F.col("chunks")).cast("int")
    rows = rows.withColumn("chunks", chunks).withColumn("own", own)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("choice", "bits", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "f")
    by = ["choice", "bits", "lo", "hi"]
    rows = rows.repartition(*by).sortWithinPartitions(*by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined(part: list[np.ndarray]) -> pa.RecordBatch:
            new = np.zeros(len(part[0]), bool)
            for c in part[:4]:
                new[1:] |= c[1:] != c[:-1]
            f = part[4].view(np.uint64)
            found = np.array(linked(f, np.cumsum(new), max_bits), np.int64).reshape(-1, 2)
            signed = f.view(np.int64)
            return pa.RecordBatch.from_pydict({"a": signed[found[:, 0]], "b": signed[found[:, 1]]})

        held: list[np.ndarray] | None = None
        for b in batches:
            cols = [b.column(i).to_numpy() for i in range(5)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            last = np.ones(len(cols[0]), bool)
            for c in cols[:4]:
                last &= c == c[-1]
            at = int(np.flatnonzero(last)[0]) if len(last) else 0
            if at:
                yield joined([c[:at] for c in cols])
            held = [c[at:] for c in cols]
        if held is not None and len(held[0]):
            yield joined(held)

    return rows.mapInArrow(run, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of the nodes of ``edges`` (a, b): the smallest node reachable."""
    both = cut(edges.select(F.col("a").alias("node"), F.col("b").alias("near"))
               .union(edges.select(F.col("b").alias("node"), F.col("a").alias("near"))))
    labels = cut(both.groupBy("node").agg(F.least(F.col("node"), F.min("near")).alias("label")))
    while True:
        reach = both.join(labels.withColumnRenamed("node", "near"), "near").groupBy("node").agg(F.min("label").alias("seen"))
        hooked = labels.join(reach, "node").select("node", "label", F.least("label", "seen").alias("next"))
        step = labels.select(F.col("node").alias("next"), F.col("label").alias("beyond"))
        new = cut(hooked.join(step, "next").select(
            "node", F.least("next", "beyond").alias("label"), (F.least("next", "beyond") != F.col("label")).alias("moved")))
        labels = new.select("node", "label")
        if new.where("moved").isEmpty():
            return labels


def groups(prints: DataFrame, max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """(f, first, root, component_id) of every distinct fingerprint of ``prints``
    (doc_id, f).

    Fingerprints link at ``max_bits`` or fewer differing bits; first is the
    smallest doc_id of a fingerprint, root the smallest fingerprint that links
    lead to, and component_id the smallest doc_id of those, null only if all of
    them are null. Components that do not link can share a component_id, but
    never a root.
    """
    each = cut(prints.groupBy("f").agg(F.min("doc_id").alias("first")))
    found = components(links(each.select("f"), max_bits, tile))
    rooted = cut(each.join(found.withColumnRenamed("node", "f"), "f", "left")
                 .select("f", "first", F.coalesce("label", "f").alias("root")))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(least, "root").select("f", "first", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """(doc_id, f, component_id) of every row of ``docs`` (doc_id, text).

    Null and empty texts have fingerprint 0, which links like any other.
    Very long texts are hashed whole, one at a time; a bit set in exactly half
    of the hashes is 0. Repeated rows stay and share a component; other columns
    are ignored; an empty table gives no row.
    """
    prints, name = with_fingerprints(docs.select("doc_id", "text"), shingle)
    prints = cut(prints.select("doc_id", F.col(name).alias("f")))
    return prints.join(groups(prints, max_bits, tile), "f").select("doc_id", "f", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` (doc_id, text, any others) with one row of each component: the
    one with the smallest doc_id, null last, and of these the one with the
    smallest fingerprint; of equal rows of that id and fingerprint one stays.
    Null and empty texts are one component, which leaves a row like any other.
    An empty table gives no row."""
    prints, name = with_fingerprints(docs, shingle)
    prints = cut(prints)
    found = groups(prints.select("doc_id", F.col(name).alias("f")), max_bits)
    keep = found.groupBy("root").agg(F.min(F.struct(F.isnull("first"), "first", "f")).alias("k")).select("k.first", "k.f")
    one = prints.join(keep, prints["doc_id"].eqNullSafe(keep["first"]) & (prints[name] == keep["f"]), "left_semi")
    return one.dropDuplicates(["doc_id", name]).drop(name)


def simhash_digest(documents: DataFrame) -> DataFrame:
    found = near_duplicates(documents)
    return found.select("doc_id", F.lpad(F.lower(F.hex("f")), 16, "0").alias("fingerprint"), "component_id")
