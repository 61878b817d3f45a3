"""Centroid clustering of whole-number vectors with ns-bounds.

Every vector keeps its squared distance to each centroid as of the round in
which it was last measured, and that round. The history of all centroids is
kept, so a stored distance is loosened by the norm of the centroid's total
displacement since then (the norm of a sum), not by the sum of the norms of
its moves. A vector whose own centroid's upper bound stays below all other
lower bounds keeps its cluster unseen. If not, the distance to its own
centroid is measured again, and then those to the centroids whose bounds still
fail; these are compared exactly, in whole numbers, ties to the smaller number.

Sums of clusters are whole numbers that follow the vectors that moved. The
driver gets one row of sums for each cluster and dimension a round. Each
round's table is written to the shared folder and the one before is deleted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicstat.llm.common import cut, discard, prepare, written

CLUSTERS, ROUNDS, DIMS, SCALE = 8, 10, 64, 1024
#: Components are below this, so that squared distances fit 64 bits.
REACH = 1 << 27
#: Bounds are floating-point numbers; they must differ by more than their error.
MARGIN = 1e-9


def whole_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, x) of the rows of ``vectors`` (vec_id, embedding) that have
    ``dims`` finite components, as whole numbers floor(scale * component)."""
    top = float(REACH // scale)
    fits = (F.size("embedding") == dims) & F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < top))
    return vectors.where(F.coalesce(fits, F.lit(False))).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("x"))


def first_centroids(kept: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors with the smallest digests of salt and id; equal ids by
    their components, null ids last."""
    key = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = kept.select(key.alias("key"), "x").orderBy(F.asc_nulls_last("key"), "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    return np.einsum("...i,...i->...", d, d)


@dataclass
class Bounds:
    """Of a batch: vectors, clusters (-1: none yet), squared distances as last
    measured and the rounds in which that was."""

    x: np.ndarray
    cluster: np.ndarray
    d2: np.ndarray
    at: np.ndarray

    def assign(self, history: np.ndarray, exact: bool) -> int:
        """Assigns all vectors to the last centroids of ``history`` (rounds,
        clusters, dims) and returns how many distances that took. ``exact``:
        the distances to the own centroids are measured in any case."""
        now, k = len(history) - 1, history.shape[1]
        every = np.arange(len(self.x))
        new = np.flatnonzero(self.cluster < 0)
        for j in range(k):
            self.d2[new, j] = squared(self.x[new], history[now, j])
        self.at[new] = now
        self.cluster[new] = self.d2[new].argmin(axis=1)
        spent = len(new) * k
        # displacement of each centroid since each round
        moved = np.sqrt(squared(history.astype(float), history[now].astype(float)))
        slack = moved[self.at, np.arange(k)]
        low, own = np.sqrt(self.d2) - slack, self.cluster
        high = np.sqrt(self.d2[every, own]) + slack[every, own]
        low[every, own] = np.inf

        def fails(rows: np.ndarray) -> np.ndarray:
            return low[rows] <= (high[rows] * (1 + MARGIN) + MARGIN)[:, None]

        def measure(rows: np.ndarray, j: np.ndarray) -> None:
            self.d2[rows, j] = squared(self.x[rows], history[now, j])
            self.at[rows, j] = now

        again = every if exact else np.flatnonzero(fails(every).any(axis=1))
        stale = again[self.at[again, own[again]] < now]
        measure(stale, own[stale])
        high[again] = np.sqrt(self.d2[again, own[again]])
        open_ = fails(again)
        rows, j = again[np.nonzero(open_)[0]], np.nonzero(open_)[1]
        due = self.at[rows, j] < now
        measure(rows[due], j[due])
        # exactly, among the own centroid and those whose bounds fail
        rest = np.unique(rows)
        near = np.full((len(self.x), k), np.iinfo(np.int64).max)
        near[rows, j] = self.d2[rows, j]
        near[rest, own[rest]] = self.d2[rest, own[rest]]
        self.cluster[rest] = near[rest].argmin(axis=1)
        return spent + len(stale) + int(due.sum())


def _lists(a: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(a) + 1, dtype=np.int32) * a.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(a.ravel(), kind))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width).astype(np.int64)


def assigned(state: DataFrame, history: np.ndarray, exact: bool = False) -> DataFrame:
    """``state`` with every vector at the nearest of the last centroids;
    ``was`` is the cluster before, ``moved`` whether it changed, ``spent`` the
    distances measured (counted at the first row of a batch)."""
    k, dims = history.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            if n:
                was = b.column(2).to_numpy().astype(np.int64)
                s = Bounds(_matrix(b.column(1), dims), was.copy(), _matrix(b.column(3), k), _matrix(b.column(4), k))
                spent = np.zeros(n, np.int64)
                spent[0] = s.assign(history, exact)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(s.cluster, pa.int32()), _lists(s.d2, pa.int64()), _lists(s.at, pa.int32()),
                     pa.array(was, pa.int32()), pa.array(was != s.cluster), pa.array(spent)], names)

    names = ["vec_id", "x", "cluster", "d2", "at", "was", "moved", "spent"]
    kinds = [T.ArrayType(T.IntegerType()), T.IntegerType(), T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType()),
             T.IntegerType(), T.BooleanType(), T.LongType()]
    schema = T.StructType([state.schema["vec_id"], *map(T.StructField, names[1:], kinds)])
    return state.select(*names[:5]).mapInArrow(run, schema)


def changes(state: DataFrame, k: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """How counts and sums of the clusters change by the vectors that moved,
    as arrays of Python's unbounded whole numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), np.int64)
        for b in batches:
            if b.num_rows:
                x = np.concatenate([_matrix(b.column(0), dims), np.ones((b.num_rows, 1), np.int64)], axis=1)
                now, was = (b.column(i).to_numpy() for i in (1, 2))
                np.add.at(total, now, x)
                np.subtract.at(total, was[was >= 0], x[was >= 0])
        at = np.indices(total.shape).reshape(2, -1).astype(np.int32)
        yield pa.RecordBatch.from_pydict({"j": pa.array(at[0]), "i": pa.array(at[1]), "s": pa.array(total.ravel())})

    out = np.zeros((k, dims + 1), object)
    sums = state.where("moved").select("x", "cluster", "was").mapInArrow(run, "j int, i int, s long")
    for r in sums.groupBy("j", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        out[r["j"], r["i"]] = int(r["s"])
    return out[:, dims], out[:, :dims]


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE,
            salt: str = "3:") -> tuple[DataFrame, np.ndarray, list[int]]:
    """(vec_id, cluster, distance) of the kept rows of ``vectors`` (vec_id,
    embedding), the final centroids, and the distances measured each round.

    Kept are rows with exactly ``dims`` components, all of them finite numbers
    below 2**27 / scale (beyond, squared distances do not fit 64 bits); null
    embeddings, null components and NaN leave a row out. Null ids are kept and
    start no cluster before the others. Repeated rows are vectors of their own.
    Ties go to the smaller cluster. Fewer than k vectors: as many clusters. An
    empty table, or none kept, gives no row and no centroid. Other columns are
    ignored. ``distance`` is the square.
    """
    spark = vectors.sparkSession
    prepare(spark)
    kept = cut(whole_vectors(vectors, dims, scale))
    start = first_centroids(kept, k, salt)
    k = len(start)
    if not k:
        return spark.createDataFrame([], T.StructType([
            kept.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])), start, []
    history, measured = start[None], []
    counts, sums = np.zeros(k, object), np.zeros((k, dims), object)
    zeros = F.array_repeat(F.lit(0), k)
    state, last = kept.select("vec_id", "x", F.lit(-1).alias("cluster"), zeros.cast("array<long>").alias("d2"), zeros.alias("at")), ""
    for nth in range(rounds + 1):
        state, path = written(assigned(state, history, exact=nth == rounds))
        discard(spark, last)
        last = path
        measured.append(state.agg(F.sum("spent")).head()[0])
        if nth < rounds:
            n, s = changes(state, k, dims)
            counts, sums = counts + n, sums + s
            centroids = history[-1].copy()
            for j in np.flatnonzero(counts > 0):
                centroids[j] = [int(v) // int(counts[j]) for v in sums[j]]
            history = np.concatenate([history, centroids[None]])
    own = F.element_at("d2", F.col("cluster") + 1)
    return state.select("vec_id", "cluster", own.alias("distance")), history[-1], measured


def cluster_digest(embeddings: DataFrame) -> DataFrame:
    rows, centroids, _ = cluster(embeddings.select("vec_id", "embedding"))
    whole = T.DecimalType(38, 0)
    own = {r["cluster"]: int(r["s"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast(whole)).alias("s")).collect()}

    def per_cluster(values: dict) -> Column:
        """One of at most CLUSTERS values."""
        return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("cluster")) if values else F.lit(None)

    text = {j: ",".join(map(str, c)) for j, c in enumerate(centroids.tolist())}
    return rows.select(
        "vec_id", "cluster", "distance", per_cluster(own).cast("long").alias("cluster_inertia"),
        F.lit(sum(own.values())).cast("long").alias("inertia"),
        F.sha2(per_cluster(text).cast("string").cast("binary"), 256).alias("centroid_sha256"))


def _sql() -> str:
    near = """
a{t} AS MATERIALIZED (
  SELECT r, arg_min(j, (d, j)) AS j, min(d) AS d FROM (
    SELECT v.r, c.j, list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM v, c{t} AS c) GROUP BY r),"""
    step = """
c{n} AS MATERIALIZED (
  SELECT c.j, coalesce(m.x, c.x) AS x FROM c{t} AS c LEFT JOIN (
    SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM (
      SELECT a.j, u.i, sum(u.x) AS s, count(*) AS n FROM a{t} AS a JOIN u ON u.r = a.r GROUP BY a.j, u.i) GROUP BY j) AS m ON m.j = c.j),"""
    body = "".join(near.format(t=t) + step.format(t=t, n=t + 1) for t in range(ROUNDS)) + near.format(t=ROUNDS)
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * x::DOUBLE) AS HUGEINT)) AS x
  FROM embeddings WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS}),
u AS MATERIALIZED (SELECT r, unnest(x) AS x, unnest(range({DIMS})) AS i FROM v),
c0 AS (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, x) - 1 AS j, x FROM (
    SELECT sha256('3:' || vec_id::VARCHAR) AS h, x FROM v) ORDER BY h NULLS LAST, x LIMIT {CLUSTERS}),{body}
s AS (SELECT j, sum(d) AS w FROM a{ROUNDS} GROUP BY j)
SELECT v.vec_id, CAST(a.j AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(s.w AS BIGINT) AS cluster_inertia,
  CAST((SELECT sum(w) FROM s) AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM v JOIN a{ROUNDS} AS a ON a.r = v.r JOIN s ON s.j = a.j JOIN c{ROUNDS} AS c ON c.j = a.j
"""


SQL = _sql()
