import datetime as dt

import numpy as np

from civicstat.operators import anomaly

ENR = "date date, state string, district string, pincode string, age_0_5 int, age_5_17 int, age_18_greater int"


def _series(spark):
    rng = np.random.default_rng(42)
    vals = rng.normal(100, 5, 90)
    vals[50], vals[70] = 200, 50
    start = dt.date(2024, 1, 1)
    rows = [(start + dt.timedelta(days=i), "S1", "D1", None, int(round(v)), 0, 0) for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, ENR), start


def test_each_method_finds_the_spike(spark):
    df, start = _series(spark)
    spike = start + dt.timedelta(days=50)
    for method in ("z_score", "iqr", "rolling_deviation"):
        dates = {r.date for r in anomaly.flagged(df, method).collect()}
        assert spike in dates, method


def test_report_spike_confirmed(spark):
    df, start = _series(spark)
    rows = {r.date: r for r in anomaly.anomaly_report(df).collect()}
    r = rows[start + dt.timedelta(days=50)]
    assert r.anomaly_type == "spike"
    assert len(r.detection_methods) >= 2
    assert r.severity_score > 5
    assert r.detection_methods == [m for m in ("z_score", "iqr", "rolling_deviation") if m in r.detection_methods]
    drop = rows.get(start + dt.timedelta(days=70))
    if drop is not None:
        assert drop.anomaly_type == "drop"


def test_series_is_daily_totals_latest_first(spark):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), "S", "D", str(p), 1, 1, 1)
            for i in range(200) for p in (1, 2)]
    s = anomaly.anomaly_series(spark.createDataFrame(rows, ENR), days=90).collect()
    assert len(s) == 150
    assert all(r.daily_enrollments == 6.0 for r in s)
    assert min(r.date for r in s) == dt.date(2024, 1, 1) + dt.timedelta(days=50)


def test_short_series_flags_nothing(spark):
    rows = [(dt.date(2024, 1, 1), "S", "D", None, 1, 1, 1), (dt.date(2024, 1, 2), "S", "D", None, 100, 1, 1)]
    assert anomaly.anomaly_report(spark.createDataFrame(rows, ENR)).count() == 0


def test_daily_scan_appends(spark, scratch):
    df, _ = _series(spark)
    path = scratch + "/alerts"
    n = anomaly.daily_scan(df, path, "2024-04-01").count()
    anomaly.daily_scan(df, path, "2024-04-01")
    assert spark.read.parquet(path).count() == n > 0
