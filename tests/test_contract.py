import duckdb
import pytest

import __spark_entry__ as entry_mod
from civicstat.plans.oracle import SQL
from civicstat.sources.tables import TABLES

from conftest import SF

ROWS_ONLY = {"saturation", "forecast", "forecast_backtest", "risk_scores"}


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["state", "district", "success_rate", "gap", "priority_score"]


def test_every_query_has_oracle_or_is_rows_only():
    q, sql = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(q) - set(sql) - set(entry_mod.EXTRA) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = entry_mod.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    cur = con.execute(entry_mod.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols

    def key(rows, names):
        # rows in one order on both sides: doubles only to six digits here
        return sorted((tuple(r[names.index(c)] for c in cols) for r in rows),
                      key=lambda r: [format(v, ".6g") if isinstance(v, float) else str(v) for v in r])

    def same(a, b):
        if isinstance(a, float) and isinstance(b, float):
            # whole numbers exactly; averages of two engines differ in the last
            # bits, which a tie can turn into the last of six decimals
            return a == b or (a != round(a) or b != round(b)) and abs(a - b) <= 1e-6 + 1e-9 * abs(b)
        return str(a) == str(b)
    got, want = key([tuple(r) for r in sdf.collect()], sdf.columns), key(cur.fetchall(), dcols)
    assert len(got) == len(want)
    assert [(a, b) for a, b in zip(got, want) if not all(map(same, a, b))] == []


def test_python_stages_run_outside_repo_dir(scratch):
    # workers must import the package even when the driver runs elsewhere
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled','false').getOrCreate()\n"
        "import __spark_entry__ as e\n"
        "print('ROWS', e.queries()['forecast_backtest'](s, %r).count())\n" % (root, SF))
    out = subprocess.run([sys.executable, "-c", code], cwd=scratch, capture_output=True, text=True, timeout=600)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
    assert int(out.stdout.split("ROWS")[1].split()[0]) > 0
