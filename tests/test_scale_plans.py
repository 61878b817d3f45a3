"""Results are unchanged under the physical plans a large cluster would use:
no automatic broadcast (sort-merge joins everywhere but the checked
dimension), many shuffle partitions, and AQE skew splitting forced on."""

import duckdb
import pytest

import __spark_entry__ as entry_mod
from civicstat.sources.tables import TABLES

from conftest import SF

AT_SCALE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
}


@pytest.fixture()
def scaled(spark):
    old = {k: spark.conf.get(k, None) for k in AT_SCALE}
    for k, v in AT_SCALE.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["success_rates", "training_set", "growth_by_scope_rollup",
                                  "anomaly_report", "explanation_requests"])
def test_same_results_with_shuffle_joins(scaled, name):
    df = entry_mod.queries()[name](scaled, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if name in ("success_rates", "training_set"):
        assert "SortMergeJoin" in plan
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cols = sorted(df.columns)
    cur = con.execute(entry_mod.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]

    def key(rows, names):
        return sorted(tuple(str(r[names.index(c)]) for c in cols) for r in rows)
    assert key([tuple(r) for r in df.collect()], df.columns) == key(cur.fetchall(), dcols)
