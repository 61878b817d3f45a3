import numpy as np
import pytest

from civicstat.operators.neighbors import CellIndex, nearest, search


def frame(spark, vecs, ids=None):
    ids = range(len(vecs)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(x) for x in v], f"d{int(i) % 7}") for i, v in zip(ids, vecs)],
                                 "id long, vec array<double>, day string")


def ranked(rows):
    out = {}
    for r in rows:
        out.setdefault(r.query_id, []).append((r.nn_rank, r.neighbor_id))
    return {q: [n for _, n in sorted(x)] for q, x in out.items()}


def plain(vecs, k, allowed):
    d = np.sqrt(((vecs[:, None, :] - vecs[None, :, :]) ** 2).sum(-1))
    out = {}
    for q in range(len(vecs)):
        ids = np.array([i for i in range(len(vecs)) if allowed(q, i)], int)
        if len(ids):
            out[q] = ids[np.lexsort((ids, d[q, ids]))[:k]].tolist()
    return out


def clustered(n, seed=3, dims=8):
    rng = np.random.default_rng(seed)
    vecs = (rng.normal(size=(30, dims)) * 20)[rng.integers(0, 30, n)] + rng.normal(size=(n, dims))
    vecs = vecs.round(3)
    vecs[10] = vecs[20]  # exact tie
    vecs[50:90] = vecs[50]  # a group of copies larger than a tile
    return vecs


@pytest.mark.parametrize("tile", [16, 64, 32768])
def test_equals_brute_force_at_any_unit_size(spark, tile):
    vecs = clustered(300)
    df = frame(spark, vecs)
    got = ranked(nearest(df, df, k=3, exclude_self=True, tile_rows=tile).collect())
    assert got == plain(vecs, 3, lambda q, i: q != i)
    got = ranked(nearest(df, df, k=3, tile_rows=tile, before="day").collect())
    assert got == plain(vecs, 3, lambda q, i: i % 7 < q % 7)


def test_few_pairs_are_compared(spark):
    vecs = clustered(1500, seed=5)
    df, compared = frame(spark, vecs), []
    got = ranked(nearest(df, df, k=3, exclude_self=True, tile_rows=64, compared=compared).collect())
    assert got == plain(vecs, 3, lambda q, i: q != i)
    assert sum(compared) < 0.25 * len(vecs) ** 2


def test_queries_travel_once_to_a_bin_of_cells(spark, monkeypatch):
    # no bound holds here, so every query visits every cell
    from civicstat.operators import neighbors
    vecs = np.random.default_rng(8).normal(size=(600, 24)).astype(np.float32).astype(float)
    df = frame(spark, vecs).selectExpr("id", "cast(vec as array<float>) vec", "day")
    sent, kinds, visited = [], set(), neighbors._visited

    def counted(rows, visits, *args):
        sent.append(visits.count())
        kinds.update((rows.schema["v"].dataType.elementType.typeName(), visits.schema["v"].dataType.elementType.typeName()))
        return visited(rows, visits, *args)

    monkeypatch.setattr(neighbors, "_visited", counted)
    compared = []
    got = ranked(nearest(df, df, k=3, exclude_self=True, tile_rows=32, compared=compared).collect())
    assert got == plain(vecs, 3, lambda q, i: q != i)
    cells = 4 * len(vecs) / 32
    assert sum(compared) > 0.9 * len(vecs) ** 2 and sum(sent) < 0.5 * len(vecs) * cells
    assert kinds == {"float"}


def test_stored_index_takes_new_rows_once(spark, scratch):
    vecs = clustered(240)
    ids = np.arange(len(vecs))
    index = CellIndex.build(frame(spark, vecs[:150]), tile_rows=32)
    index.write(f"{scratch}/index")
    for part in (slice(100, 240), slice(140, 240)):  # overlaps what is there
        CellIndex.append(spark, f"{scratch}/index", frame(spark, vecs[part], ids[part]))
    stored = CellIndex.read(spark, f"{scratch}/index")
    assert stored.rows.count() == 240
    got = ranked(search(frame(spark, vecs), stored, k=4, tile_rows=32).collect())
    assert got == plain(vecs, 4, lambda q, i: True)


def test_many_exact_ties_fall_back_correctly(spark):
    # 20 identical vectors: every query has 19 tied neighbours (beyond the spare candidates)
    vecs = [[1.0, 2.0]] * 20 + [[5.0, 5.0], [6.0, 6.0]]
    df = frame(spark, vecs)
    got = ranked(nearest(df, df, k=3, exclude_self=True).collect())
    assert got[0] == [1, 2, 3] and got[5] == [0, 1, 2] and got[21][0] == 20


def test_empty_sides_and_missing_vectors(spark):
    df = frame(spark, clustered(100))
    none = df.where("id < 0")
    for tile in (16, 32768):
        assert nearest(none, df, tile_rows=tile).count() == 0
        assert nearest(df, none, tile_rows=tile).count() == 0
        odd = df.unionByName(spark.createDataFrame([(900, None, "d0")], df.schema))
        assert 900 not in ranked(nearest(odd, odd, tile_rows=tile).collect())
