"""Writes and reads that must not lose, duplicate or mix up rows."""

import gzip
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicstat.functions.scalar import nonneg_number, strip_ws
from civicstat.operators import anomaly, forecast, risk
from civicstat.operators.tsmodels import _select_arma
from civicstat.sources import ingest, sinks


@pytest.fixture()
def static_overwrite(spark):
    """A session as Spark starts it: overwriting replaces the whole table."""
    was = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    yield
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", was)


def test_alerts_of_other_days_stay(spark, scratch, static_overwrite):
    for day in ("2024-01-02", "2024-01-03", "2024-01-03"):
        sinks.append_alerts(spark.createDataFrame([(day,)], "d string"), f"{scratch}/alerts", day)
    assert sorted(r.d for r in spark.read.parquet(f"{scratch}/alerts").collect()) == ["2024-01-02", "2024-01-03"]


def test_unreadable_target_is_not_an_empty_one(spark, scratch):
    assert not sinks.table_exists(spark, f"{scratch}/none")
    os.makedirs(f"{scratch}/empty")
    assert not sinks.table_exists(spark, f"{scratch}/empty")
    os.makedirs(f"{scratch}/bad")
    with open(f"{scratch}/bad/part-0.parquet", "w") as f:
        f.write("no parquet")
    spark.range(3).write.parquet(f"{scratch}/source")
    with pytest.raises(Exception):
        sinks.load_parquet(spark, f"{scratch}/source", f"{scratch}/bad")


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_each_file_is_read_by_its_own_header(spark, scratch):
    write(f"{scratch}/in/a.csv", "date,state,district,pincode,age_0_5,age_5_17\n01-02-2024,up,agra,110001,1,2\n")
    write(f"{scratch}/in/b.csv", "district,state,age_5_17,date,age_0_5,pincode\nagra,up,2,01-02-2024,1,110001\n")
    rows = ingest.clean_rows(ingest.classify(ingest.read_raw_csv(spark, f"{scratch}/in"), "enrollment")).collect()
    assert [(r.state, r.district, r.age_0_5, r.age_5_17) for r in rows] == [("Up", "Agra", 1.0, 2.0)] * 2


def test_long_rows_are_rejected_and_short_ones_filled(spark, scratch):
    write(f"{scratch}/in/a.csv", 'date,state,age_0_5\n01-02-2024,up,1,9\n01-02-2024,"two\nlines",1\n01-02-2024,up\n')
    got = {r.raw.state: r.reasons for r in ingest.classify(ingest.read_raw_csv(spark, f"{scratch}/in"), "enrollment").collect()
           if r.raw.age_0_5 is not None}
    assert got == {"up": ["malformed_row"], "two\nlines": []}


def test_broken_files_are_named_in_the_report(spark, scratch):
    write(f"{scratch}/in/a.csv", "date,state,age_0_5\n01-02-2024,up,1\n")
    data = gzip.compress(b"date,state,age_0_5\n" + b"01-02-2024,up,1\n" * 10000)
    with open(f"{scratch}/in/b.csv.gz", "wb") as f:
        f.write(data[:len(data) // 2])
    report = ingest.run_etl(spark, {"enrollment": [f"{scratch}/in"]}, f"{scratch}/out").head()
    assert report.total_rows == 1 and [k.rsplit("/", 1)[1] for k in report.failed_files] == ["b.csv.gz"]


def test_numbers_and_spaces_as_python_reads_them(spark):
    texts = ["5", " 5.5 ", "5d", "5f", "0x1p3", "1_000", "1__0", "_1", "1e3", ".5", "5.", "-0", "-1", "inf", "nan", "", None]

    def python(t):
        try:
            v = float(t)
        except (TypeError, ValueError):
            return None
        return v if np.isfinite(v) and v >= 0 else None

    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", nonneg_number("t").alias("v")).collect()
    assert [(r.t, r.v) for r in rows] == [(t, python(t)) for t in texts]
    odd = spark.createDataFrame([(" 　 a b \x1c",)], "t string").select(strip_ws("t").alias("t")).head().t
    assert odd == " 　 a b \x1c".strip()


def test_null_state_is_a_scope_of_its_own(spark):
    rows = [(f"2024-{m:02d}-01", s, 1, 2, 3) for m in (1, 3) for s in ("A", None)]
    enr = spark.createDataFrame(rows, "date string, state string, age_0_5 int, age_5_17 int, age_18_greater int") \
        .withColumn("date", F.to_date("date"))
    got = {(r.state, str(r.ds)): r.y for r in forecast.monthly_interpolated(enr).collect()}
    assert len(got) == 9 and got[None, "2024-02-01"] == 6.0 and got["All India", "2024-01-01"] == 12.0


def test_null_day_leaves_no_z_score(spark):
    rows = [("S", "D", f"2024-01-{i + 1:02d}", 100.0 + i % 2) for i in range(28)]
    rows[14] = (*rows[14][:3], 900.0)
    schema = "state string, district string, date string, daily_enrollments double"
    flags = lambda r: anomaly.with_detectors(spark.createDataFrame(r, schema)).where("is_z").count()
    assert flags(rows) == 1
    rows[0] = (*rows[0][:3], None)
    assert flags(rows) == 0


def test_category_goes_by_the_raw_probability(spark):
    class Fake:
        stages = [type("S", (), {"featureImportances": type("I", (), {"toArray": lambda self: np.zeros(len(risk.FEATURES))})()})()]

        def transform(self, df):
            return df

    from pyspark.ml.functions import array_to_vector
    rows = spark.createDataFrame([("S", str(p), p) for p in (0.7049, 0.7, 0.4049, 0.4, 0.3)], "state string, district string, p double")
    got = {r.district: (r.risk_score, r.risk_category) for r in risk.predict_risk(
        Fake(), rows.withColumn("probability", array_to_vector(F.array(1 - F.col("p"), "p")))).collect()}
    assert got == {"0.7049": (0.7, "High"), "0.7": (0.7, "Medium"), "0.4049": (0.4, "Medium"), "0.4": (0.4, "Low"), "0.3": (0.3, "Low")}


def test_arima_order_does_not_depend_on_the_unit():
    rng = np.random.default_rng(4)
    chosen = []
    for _ in range(20):
        x = rng.normal(size=60)
        orders = {_select_arma(x * u, True, 5, 2)["order"] for u in (0.001, 1.0, 1000.0)}
        assert len(orders) == 1
        chosen.append(orders.pop())
    assert sum(o == (0, 0) for o in chosen) >= 10
    ar = np.zeros(200)
    for i in range(1, 200):
        ar[i] = 0.8 * ar[i - 1] + rng.normal()
    best = _select_arma(ar, True, 5, 2)
    assert best["order"][0] >= 1 and 0.5 < best["phi"].sum() < 1


def test_small_districts_get_a_saturation_row_without_figures(spark):
    from civicstat.operators.saturation import saturation
    rows = [(f"2024-01-{d:02d}", "S", "small", 1, 1, 1) for d in range(1, 6)]
    enr = spark.createDataFrame(rows, "date string, state string, district string, age_0_5 int, age_5_17 int, age_18_greater int") \
        .withColumn("date", F.to_date("date"))
    got = saturation(enr).collect()
    assert [(r.district, r.current_penetration, r.error) for r in got] == [("small", None, "suppressed: fewer than 100 enrollments")]
