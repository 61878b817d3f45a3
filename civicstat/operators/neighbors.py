"""Exact k-nearest-neighbour search that visits few cells of an index.

The index is cut into cells around pivots, a bounded sample of its vectors: a
vector belongs to its nearest pivot and keeps its distance to it. A large cell
is cut into rings by that distance, and a ring that is still large (many equal
distances) into parts by id, so a unit of the index holds about ``tile_rows``
vectors at any size. With d the distance of a query to a pivot, no vector of a
ring from r to R is nearer than max(r - d, d - R): the triangle inequality.

A query first visits the one unit that promises the nearest vectors, which
bounds the distance of its k-th neighbour. Then it visits units in growing
rounds of cells, nearest bound first, and only those whose bound is not above
the k-th distance so far; it is done when no unit is left. Visits are rows,
pairs never are: a unit and the queries that visit it meet in one group, many
queries of a unit in several, and numpy keeps the k best of each query. Cells of
one unit that are near each other share a bin, and a query travels once to a bin
with the list of the cells it visits there, not once to each cell.

An index can be stored, partitioned by cell, and new rows added to it; a search
then reads the cells that are visited. An index of one unit needs one round.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicstat.session import materialize, ship_package

# Vectors of a unit of the index. A group holds at most about BIN times as many
# of each side plus a QUERY_CHUNK x tile_rows distance block (256 x 32768
# doubles = 64 MiB).
DEFAULT_TILE_ROWS = 32768
BIN = 2
MOST_PIVOTS = 1024
QUERY_CHUNK = 256
GROW = 4   # each round looks at so many times the cells of the one before
SPARE = 4  # extra fast-formula candidates re-checked exactly
# Candidates within the rounding error of the fast formula around the k-th
# distance are re-checked with the exact one. The error grows with the squared
# norms, so vectors are centred first and the margin is a multiple of those.
TIE_MARGIN = 1e-13
# Bounds are widened by this share of the distances they come from.
SLACK = 1e-9


def _exact_rows(q_raw, i_raw, cand_idx, valid):
    """Exact distances of candidate columns, invalid ones → inf. They come from
    the vectors as they are, so equal vectors tie in whatever unit they lie."""
    diff = i_raw[cand_idx] - q_raw[:, None, :]
    exact = np.sqrt(np.einsum("qmd,qmd->qm", diff, diff))
    return np.where(valid, exact, np.inf)


def _top_k_block(q_ids, q_vecs, i_ids, i_vecs, k, exclude_self, q_at=None, i_at=None):
    """Top-k per query of one tile pair, vectorised per chunk of queries.

    The fast formula |q|² + |i|² − 2 q·i picks ``k + SPARE`` candidates;
    their distances are recomputed exactly and sorted by (distance, id).
    Only a row whose fast distances tie beyond the spare candidates falls
    back to checking every index row within the tie margin.
    """
    out_q, out_n, out_d = [], [], []
    if len(q_ids) == 0 or len(i_ids) == 0:
        return out_q, out_n, out_d
    i_raw = np.asarray(i_vecs, dtype=np.float64)
    centre = i_raw.mean(axis=0)
    iq = i_raw - centre
    i_norm = np.einsum("ij,ij->i", iq, iq)
    i_ids = np.asarray(i_ids)
    n_i = len(i_ids)
    for start in range(0, len(q_ids), QUERY_CHUNK):
        q_raw = np.asarray(q_vecs[start:start + QUERY_CHUNK], dtype=np.float64)
        qb = q_raw - centre
        qid = np.asarray(q_ids[start:start + QUERY_CHUNK])
        q_norm = np.einsum("ij,ij->i", qb, qb)
        d2 = q_norm[:, None] + i_norm[None, :] - 2.0 * qb @ iq.T
        if exclude_self:
            d2[qid[:, None] == i_ids[None, :]] = np.inf
        if q_at is not None:
            d2[np.asarray(q_at[start:start + QUERY_CHUNK], str)[:, None] <= np.asarray(i_at, str)[None, :]] = np.inf
        m = min(n_i, k + SPARE)
        cand = np.argpartition(d2, m - 1, axis=1)[:, :m] if m < n_i else np.tile(np.arange(n_i), (len(qid), 1))
        cd2 = np.take_along_axis(d2, cand, axis=1)
        kth = np.sort(cd2, axis=1)[:, min(k, m) - 1]
        limit = kth + TIE_MARGIN * iq.shape[1] * (q_norm + i_norm.max())
        # rows whose ties may reach beyond the m candidates
        overflow = (m < n_i) & np.isfinite(kth) & ((d2 <= limit[:, None]).sum(axis=1) > m)
        exact = _exact_rows(q_raw, i_raw, cand, np.isfinite(cd2))
        ids = i_ids[cand]
        order = np.lexsort((ids, exact), axis=1)[:, :k]
        nid = np.take_along_axis(ids, order, axis=1)
        dist = np.take_along_axis(exact, order, axis=1)
        qrep = np.repeat(qid[:, None], order.shape[1], axis=1)
        keep = np.isfinite(dist) & ~overflow[:, None]
        out_q.extend(qrep[keep].tolist())
        out_n.extend(nid[keep].tolist())
        out_d.extend(dist[keep].tolist())
        for r in np.flatnonzero(overflow):  # rare: ties beyond the spare candidates
            c = np.flatnonzero(d2[r] <= limit[r])
            e = _exact_rows(q_raw[r:r + 1], i_raw, c[None, :], np.isfinite(d2[r, c])[None, :])[0]
            o = np.lexsort((i_ids[c], e))[:k]
            o = o[np.isfinite(e[o])]
            out_q.extend([qid[r]] * len(o))
            out_n.extend(i_ids[c][o].tolist())
            out_d.extend(e[o].tolist())
    return out_q, out_n, out_d


def _to_pivots(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((v - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def _vectors(column) -> np.ndarray:
    return np.array([np.asarray(x, float) for x in column])


@dataclass
class CellIndex:
    """Rows (cell, r, iid, v, at) and the pivots of the cells."""

    rows: DataFrame
    pivots: np.ndarray

    @staticmethod
    def build(index: DataFrame, index_id: str = "id", vec: str = "vec", before: str | None = None,
              tile_rows: int = DEFAULT_TILE_ROWS) -> CellIndex:
        """Pivots are the vectors with the smallest hashes of their ids, one for
        every ``tile_rows`` / 4 rows and MOST_PIVOTS at most. Rows without a vector are in
        no cell."""
        rows = _columns(index, index_id, vec, before)
        n = rows.count()
        some = max(1, min(MOST_PIVOTS, math.ceil(4 * n / tile_rows))) if n > tile_rows else 1
        found = rows.orderBy(F.xxhash64("iid"), "iid").limit(some).select("v").collect() if some > 1 else []
        # one cell needs no pivot to tell it from others
        if not found:
            return CellIndex.around(rows, np.zeros((1, 0)))
        cells = CellIndex.around(rows, _vectors([r["v"] for r in found]))
        return CellIndex(materialize(cells.rows), cells.pivots)

    @staticmethod
    def around(rows: DataFrame, pivots: np.ndarray) -> CellIndex:
        """The cells of rows (iid, v, at) around given pivots."""
        if len(pivots) == 1:
            return CellIndex(rows.select(F.lit(0).alias("cell"), F.lit(0.0).alias("r"), "iid", "v", "at"), pivots)

        def assign(batches):
            for b in batches:
                if len(b):
                    d = _to_pivots(_vectors(b["v"]), pivots)
                    cell = d.argmin(axis=1)
                    yield b.assign(cell=cell.astype(np.int32), r=d[np.arange(len(b)), cell])[["cell", "r", "iid", "v", "at"]]

        ship_package(rows.sparkSession)
        schema = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("r", T.DoubleType()),
                               *[rows.schema[c] for c in ("iid", "v", "at")]])
        return CellIndex(rows.mapInPandas(assign, schema), pivots)

    def write(self, path: str) -> None:
        """The rows by cell, in order of their distance, and the pivots."""
        pivots = self.rows.sparkSession.createDataFrame(
            [(i, [float(x) for x in p]) for i, p in enumerate(self.pivots)], "cell int, v array<double>")
        pivots.coalesce(1).write.mode("overwrite").parquet(f"{path}/pivots")
        _write_cells(self.rows, f"{path}/rows", "overwrite")

    @staticmethod
    def read(spark: SparkSession, path: str) -> CellIndex:
        found = spark.read.parquet(f"{path}/pivots").orderBy("cell").collect()  # MOST_PIVOTS rows at most
        return CellIndex(spark.read.parquet(f"{path}/rows").select("cell", "r", "iid", "v", "at"), _vectors([r["v"] for r in found]))

    @staticmethod
    def append(spark: SparkSession, path: str, index: DataFrame, index_id: str = "id", vec: str = "vec",
               before: str | None = None) -> None:
        """Adds the rows whose ids the index lacks, so adding rows twice adds
        them once. Only ids of the cells they fall into are read."""
        old = CellIndex.read(spark, path)
        new = materialize(CellIndex.around(_columns(index, index_id, vec, before), old.pivots).rows)
        cells = [r["cell"] for r in new.select("cell").distinct().collect()]
        known = old.rows.where(F.col("cell").isin(cells)).select("iid")
        fresh = materialize(new.join(known, new["iid"].eqNullSafe(known["iid"]), "left_anti").dropDuplicates(["iid"]))
        _write_cells(fresh, f"{path}/rows", "append")


def _write_cells(rows: DataFrame, path: str, mode: str) -> None:
    rows = rows.withColumn("v", F.col("v").cast("array<double>"))
    (rows.repartitionByRange("cell", "r").sortWithinPartitions("cell", "r")
     .write.mode(mode).partitionBy("cell").parquet(path))


def _columns(df: DataFrame, row_id: str, vec: str, before: str | None, name: str = "iid") -> DataFrame:
    at = F.col(before).cast("string") if before else F.lit("")
    # single precision travels as it is; numpy computes in double
    single = isinstance(df.schema[vec].dataType, T.ArrayType) and isinstance(df.schema[vec].dataType.elementType, T.FloatType)
    v = F.col(vec) if single else F.col(vec).cast("array<double>")
    return (df.select(F.col(row_id).alias(name), v.alias("v"), at.alias("at"))
            .where("v IS NOT NULL AND at IS NOT NULL"))


def _units(rows: DataFrame, tile_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their unit, and one row for each unit: cell, unit, low and
    high (the ring), n, since (its earliest ``at``)."""
    size = rows.groupBy("cell").agg(F.count("*").alias("n"))
    big = size.where(F.col("n") > tile_rows)
    cut = F.sequence(F.lit(1), F.ceil(F.col("n") / tile_rows) - 1)
    # upper ends of the rings but the last, about tile_rows apart
    ends = (rows.join(big, "cell").groupBy("cell", "n").agg(F.percentile_approx("r", F.lit([i / 64 for i in range(1, 64)]), 10000).alias("q"))
            .select("cell", F.array_distinct(F.transform(cut, lambda i: F.element_at("q", F.greatest(F.lit(1), F.least(
                F.lit(63), F.rint(i * 64 * tile_rows / F.col("n")).cast("int")))))).alias("ends")))
    ring = F.coalesce(F.size(F.filter("ends", lambda e: e < F.col("r"))), F.lit(0))
    # ends has a row for a cell at most, parts one for a ring
    rows = rows.join(F.broadcast(ends), "cell", "left").withColumn("ring", F.when(F.col("ends").isNull(), 0).otherwise(ring)).drop("ends")
    parts = (rows.groupBy("cell", "ring").agg(F.count("*").alias("in_ring"))
             .select("cell", "ring", F.ceil(F.col("in_ring") / tile_rows).cast("int").alias("parts")))
    unit = F.concat_ws("-", "cell", "ring", F.pmod(F.xxhash64("iid"), "parts"))
    rows = rows.join(F.broadcast(parts), ["cell", "ring"]).select("cell", unit.alias("unit"), "r", "iid", "v", "at")
    units = rows.groupBy("cell", "unit").agg(F.min("r").alias("low"), F.max("r").alias("high"), F.count("*").alias("n"), F.min("at").alias("since"))
    return rows, units


def _bins(pivots: np.ndarray, spans: list, size: int) -> np.ndarray:
    """The bin of each of the cells ``spans``: neighbours with about ``size`` rows
    in all; -1 for cells of several units, which are visited by the unit."""
    p = pivots[[s["cell"] for s in spans]]
    out, left = np.full(len(spans), -1), np.array([s["units"] == 1 for s in spans])
    at, used, number = 0, 0, -1
    while left.any():
        at = int(np.where(left, ((p - p[at]) ** 2).sum(axis=1), np.inf).argmin())
        left[at] = False
        if number < 0 or used + spans[at]["n"] > size:
            number, used = number + 1, 0
        out[at], used = number, used + spans[at]["n"]
    return out


def _visited(rows: DataFrame, visits: DataFrame, k: int, exclude_self: bool, ordered: bool, tile_rows: int, id_type,
             places: int = 1) -> DataFrame:
    """(query_id, neighbor_id, distance): the k nearest of each visit (unit,
    qid, v, at, cells) to one of ``places`` units or bins, of a bin in the
    ``cells`` named. Queries of a unit are dealt to as many groups as their number
    needs, and the unit's rows go to each."""
    cores = visits.sparkSession.sparkContext.defaultParallelism
    # small inputs still make a group for every core
    deal = F.ceil(F.greatest(F.col("m") / (BIN * tile_rows), F.least(F.lit(cores / places), F.col("m") / QUERY_CHUNK))).cast("int")
    asked = visits.groupBy("unit").agg(F.count("*").alias("m")).select("unit", deal.alias("groups"))
    q = (visits.join(asked, "unit").withColumn("part", F.pmod(F.xxhash64("qid"), "groups").cast("int"))
         .select("unit", "part", "qid", "v", "at", "cells"))
    i = (rows.join(asked, "unit").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
         .select("unit", "part", "iid", "v", "at", "cell"))
    schema = T.StructType([T.StructField("query_id", id_type), T.StructField("neighbor_id", rows.schema["iid"].dataType),
                           T.StructField("distance", T.DoubleType())])

    def near(qp, ip):
        qid, nid, dist = _top_k_block(qp["qid"].tolist(), list(qp["v"]), ip["iid"].tolist(), list(ip["v"]), k, exclude_self,
                                      *((qp["at"].tolist(), ip["at"].tolist()) if ordered else ()))
        return pd.DataFrame({"query_id": qid, "neighbor_id": nid, "distance": dist})

    def block(qp, ip):
        if not len(qp) or qp["cells"].iloc[0] is None:
            return near(qp, ip)
        at = np.repeat(np.arange(len(qp)), [len(c) for c in qp["cells"]])
        cell = np.concatenate(list(qp["cells"]))
        found = [near(qp.iloc[at[cell == c]], own) for c, own in ip.groupby("cell") if (cell == c).any()]
        if len(found) < 2:
            return found[0] if found else near(qp.iloc[:0], ip)
        # the k best of each query in all cells of the bin
        return (pd.concat([f for f in found if len(f)] or found[:1]).sort_values(["distance", "neighbor_id"])
                .groupby("query_id", sort=False, dropna=False).head(k))

    ship_package(visits.sparkSession)
    return q.groupBy("unit", "part").cogroup(i.groupBy("unit", "part")).applyInPandas(block, schema)


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return found.withColumn("nn_rank", F.row_number().over(w)).filter(F.col("nn_rank") <= k)


def _cells_of(queries: DataFrame, index: CellIndex, spans: list, bins: np.ndarray, ordered: bool, first: int, last: int) -> DataFrame:
    """The cells number ``first`` to ``last`` of each open query (qid, v, at,
    best, done) in order of their bounds, as far as the bounds are not above its
    ``best``. Cells in bins make a row for each bin: its name as the unit, the
    list of the cells and their number of rows; others one for each cell, with
    the distance to the pivot."""
    pivots = index.pivots
    cell, low, high, n = (np.array([s[c] for s in spans]) for c in ("cell", "low", "high", "n"))
    since = np.array([s["since"] for s in spans], object)
    unit = np.array([f"{c}-0-0" for c in cell], object)
    names = ["qid", "v", "at", "best", "done", "cell", "d", "unit", "cells", "n"]

    def run(batches):
        for b in batches:
            if not len(b):
                continue
            d = _to_pivots(_vectors(b["v"]), pivots)[:, cell]
            bound = np.maximum(np.maximum(low - d, d - high) - SLACK * (d + high), 0)
            order = np.lexsort((d, bound), axis=1)[:, first:last]
            near = np.take_along_axis(bound, order, 1) <= b["best"].to_numpy()[:, None]
            q, j = np.nonzero(near)
            c = order[q, j]
            done, at = b["done"].to_numpy(object)[q], b["at"].to_numpy(object)[q]
            open_ = (bins[c] < 0) | (unit[c] != done)
            if ordered:
                open_ &= (bins[c] < 0) | (since[c] < at).astype(bool)
            q, c = q[open_], c[open_]
            alone = bins[c] < 0
            out = b.iloc[q[alone]][["qid", "v", "at", "best", "done"]].copy()
            out["cell"], out["d"], out["n"] = cell[c[alone]].astype(np.int32), d[q[alone], c[alone]], 0
            out["unit"] = out["cells"] = pd.Series([None] * len(out), out.index, object)
            yield out[names]
            q, c = q[~alone], c[~alone]
            by = np.lexsort((bins[c], q))
            q, c = q[by], c[by]
            new = np.flatnonzero(np.r_[True, (q[1:] != q[:-1]) | (bins[c[1:]] != bins[c[:-1]])]) if len(q) else np.zeros(0, int)
            out = b.iloc[q[new]][["qid", "v", "at", "best", "done"]].copy()
            out["cell"], out["d"] = np.int32(-1), 0.0
            out["n"] = np.add.reduceat(n[c], new) if len(new) else 0
            out["unit"] = pd.Series([f"bin-{x}" for x in bins[c[new]]], out.index, object)
            out["cells"] = pd.Series([cell[x].tolist() for x in np.split(c, new[1:])] if len(new) else [], out.index, object)
            yield out[names]

    schema = T.StructType([*[queries.schema[c] for c in ("qid", "v", "at", "best", "done")],
                           T.StructField("cell", T.IntegerType()), T.StructField("d", T.DoubleType()), T.StructField("unit", T.StringType()),
                           T.StructField("cells", T.ArrayType(T.IntegerType())), T.StructField("n", T.LongType())])
    return queries.select("qid", "v", "at", "best", "done").mapInPandas(run, schema)


def search(queries: DataFrame, index: CellIndex, k: int = 3, query_id: str = "id", vec: str = "vec", exclude_self: bool = False,
           before: str | None = None, tile_rows: int = DEFAULT_TILE_ROWS, compared: list[int] | None = None) -> DataFrame:
    """Top-k index rows by Euclidean distance for every row of ``queries``:
    query_id, neighbor_id, distance, nn_rank (1 = nearest), ties to the smaller
    id. ``exclude_self`` drops pairs with equal ids; with ``before`` only index
    rows of a smaller value count. ``compared`` gets the number of pairs that
    each round compares.
    """
    asked = _columns(queries, query_id, vec, before, "qid")
    id_type = queries.schema[query_id].dataType

    def block(rows: DataFrame, visits: DataFrame, places: int = 1) -> DataFrame:
        return _visited(rows, visits, k, exclude_self, before is not None, tile_rows, id_type, places)

    whole = F.lit(None).cast("array<int>").alias("cells")
    if len(index.pivots) == 1 and (n := index.rows.count()) <= tile_rows:
        if compared is not None:
            compared.append(n * asked.count())
        return _best(block(index.rows.withColumn("unit", F.lit("all")), asked.select("*", F.lit("all").alias("unit"), whole)), k)

    rows, units = _units(index.rows, tile_rows)
    units = materialize(units)
    # one row for each cell: MOST_PIVOTS at most
    spans = units.groupBy("cell").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"),
                                      F.count("*").alias("units"), F.min("since").alias("since")).collect()
    bins = _bins(index.pivots, spans, BIN * tile_rows)
    bin_of = dict(zip([s["cell"] for s in spans], bins.tolist()))
    several = [c for c, x in bin_of.items() if x < 0]
    bin_ = F.element_at(F.array(*[F.lit(bin_of.get(c, -1)) for c in range(len(index.pivots))]), F.col("cell") + 1)
    rows = rows.withColumn("unit", F.when(bin_ >= 0, F.concat(F.lit("bin-"), bin_)).otherwise(F.col("unit")))
    big = units.where(F.col("cell").isin(several)).withColumnsRenamed({"unit": "one", "n": "in_one"})
    state = asked.withColumns({"best": F.lit(float("inf")), "done": F.lit("")})
    found, first, last = None, 0, 1
    while first < len(spans):
        near = _cells_of(state, index, spans, bins, before is not None, first, last)
        if several:
            bound = F.greatest(F.col("low") - F.col("d"), F.col("d") - F.col("high")) - SLACK * (F.col("d") + F.col("high"))
            visit = (bound <= F.col("best")) & (F.col("one") != F.col("done"))
            if before:
                visit = visit & (F.col("since") < F.col("at"))
            near = (near.join(big, "cell", "left").where(F.col("unit").isNotNull() | visit).withColumn("bound", bound)
                    .withColumns({"unit": F.coalesce("unit", "one"), "n": F.coalesce("in_one", "n")}))
            if found is None:
                # the most promising unit alone bounds the k-th distance
                nth = Window.partitionBy("qid").orderBy(F.greatest("bound", F.lit(0.0)), F.desc("n"), "unit")
                near = near.withColumn("nth", F.row_number().over(nth)).where("nth = 1").drop("nth")
        visits = materialize(near.select("qid", "v", "at", "unit", "cells", "n"))
        pairs, places = visits.agg(F.sum("n"), F.count_distinct("unit")).head()
        if compared is not None:
            compared.append(pairs or 0)
        own = F.coalesce("cells", F.array(F.split("unit", "-")[0].try_cast("int")))
        cells = [r["cell"] for r in visits.select(F.explode(own).alias("cell")).distinct().collect()]
        new = block(rows.where(F.col("cell").isin(cells)), visits.drop("n"), max(places, 1))
        initial = found is None
        found = materialize(_best(new if initial else found.drop("nn_rank").unionByName(new), k))
        kth = found.where(F.col("nn_rank") == k).select(F.col("query_id").alias("qid"), F.col("distance").alias("best"))
        state = state.drop("best").join(kth, "qid", "left").withColumn("best", F.coalesce("best", F.lit(float("inf"))))
        if initial:
            # the rest of the first cell is still to be visited, if it has several units
            done = F.coalesce(F.concat(F.col("cells")[0].cast("string"), F.lit("-0-0")), F.col("unit"))
            state = state.drop("done").join(visits.select("qid", done.alias("done")), "qid", "left").withColumn(
                "done", F.coalesce("done", F.lit("")))
            if not several:
                first, last = 1, min(len(spans), GROW)
        else:
            first, last = last, min(len(spans), last * GROW)
        state = materialize(state.select("qid", "v", "at", "best", "done"))
    return found if found is not None else _best(
        block(index.rows.withColumn("unit", F.lit("all")), asked.select("*", F.lit("all").alias("unit"), whole)), k)


def nearest(queries: DataFrame, index: DataFrame, k: int = 3, query_id: str = "id",
            index_id: str = "id", vec: str = "vec", exclude_self: bool = False,
            tile_rows: int = DEFAULT_TILE_ROWS, before: str | None = None, compared: list[int] | None = None) -> DataFrame:
    """``search`` in an index built for this one use."""
    return search(queries, CellIndex.build(index, index_id, vec, before, tile_rows), k, query_id, vec, exclude_self, before,
                  tile_rows, compared)
