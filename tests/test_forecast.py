import datetime as dt

import numpy as np
import pandas as pd

from civicstat.operators import forecast, tsmodels

ENR = "date date, state string, district string, pincode string, age_0_5 int, age_5_17 int, age_18_greater int"


def test_daily_to_monthly_24_months(spark):
    start = dt.date(2024, 1, 1)
    rows = [(start + dt.timedelta(days=i), "S", "D", None, 10, 0, 0) for i in range(720)]
    s = forecast.monthly_interpolated(spark.createDataFrame(rows, ENR), national=False).collect()
    assert len(s) == 24


def test_month_gap_interpolated(spark):
    rows = [(dt.date(2024, 1, 1), "S", "D", None, 100, 0, 0), (dt.date(2024, 3, 1), "S", "D", None, 300, 0, 0)]
    s = forecast.monthly_interpolated(spark.createDataFrame(rows, ENR), national=False).orderBy("ds").collect()
    assert [r.y for r in s] == [100.0, 200.0, 300.0]


def test_trailing_gap_carried_forward(spark):
    df = spark.createDataFrame([("S", dt.date(2024, m, 1), v) for m, v in [(1, 1.0), (2, None), (3, 5.0), (4, None)]],
                               "state string, ds date, y double")
    out = [r.y for r in forecast.interpolate(df, ["state"]).orderBy("ds").collect()]
    assert out == [1.0, 3.0, 5.0, 5.0]


def test_backtest_split_last_three(spark):
    df = spark.createDataFrame([("S", (pd.Timestamp("2024-01-01") + pd.DateOffset(months=i)).date(), float(i)) for i in range(14)],
                               "state string, ds date, y double")
    rows = forecast.backtest_split(df).collect()
    assert sum(r.split == "test" for r in rows) == 3
    short = spark.createDataFrame([("T", dt.date(2024, 1, 1), 1.0)], "state string, ds date, y double")
    assert forecast.backtest_split(short).count() == 0


def test_mape_exact_prediction_is_zero():
    assert forecast._mape(np.array([1.0, 2.0, 3.0]), np.array([1.0, 2.0, 3.0])) == 0.0
    assert forecast._mape(np.array([0.0, 0.0]), np.array([1.0, 2.0])) == float("inf")


def test_linear_trend_forecast_six_months(spark):
    rows = [("S", (pd.Timestamp("2022-01-01") + pd.DateOffset(months=i)).date(), 1000.0 + 10 * i) for i in range(24)]
    df = spark.createDataFrame(rows, "state string, ds date, y double")
    out = forecast.forecast(df).orderBy("month").collect()
    assert len(out) == 6
    assert [r.month for r in out] == ["2024-01", "2024-02", "2024-03", "2024-04", "2024-05", "2024-06"]
    for r in out:
        assert r.lower <= r.predicted <= r.upper
        assert r.model_used in ("ARIMA", "Additive")
    assert abs(out[0].predicted - 1240) <= 5
    assert out[0].mape < 1.0


def test_short_series_reports_error(spark):
    df = spark.createDataFrame([("S", dt.date(2024, 1, 1), 1.0)], "state string, ds date, y double")
    r = forecast.forecast(df).first()
    assert r.error.startswith("Insufficient data")


def test_models_recover_trend_directly():
    y = 1000.0 + 10 * np.arange(30)
    f, lo, hi = tsmodels.arima_forecast(y, 3)
    assert np.allclose(f, [1300, 1310, 1320], atol=2)
    ds = pd.Series(pd.date_range("2020-01-01", periods=30, freq="MS"))
    p, lo, hi = tsmodels.additive_forecast(y, ds, 3)
    assert np.allclose(p, [1300, 1310, 1320], atol=15)
    assert np.all(lo <= p) and np.all(p <= hi)


def test_mape_aggregate(spark):
    df = spark.createDataFrame([("S", 100.0, 90.0), ("S", 0.0, 5.0), ("S", 50.0, 55.0), ("T", 0.0, 1.0)],
                               "state string, y double, yhat double")
    out = {r.state: r.mape for r in forecast.mape(df, keys=["state"]).collect()}
    assert abs(out["S"] - 0.1) < 1e-12 and out["T"] is None


def test_forecast_nested_contract(spark):
    rows = [("S", (pd.Timestamp("2022-01-01") + pd.DateOffset(months=i)).date(), 500.0 + 5 * i) for i in range(20)]
    df = spark.createDataFrame(rows, "state string, ds date, y double")
    nested = forecast.forecast_nested(forecast.forecast(df)).collect()
    assert len(nested) == 1
    months = [f.month for f in nested[0].forecast]
    assert months == sorted(months) and len(months) == 6


def test_constant_and_zero_series_do_not_fail(spark):
    rows = [("Z", (pd.Timestamp("2022-01-01") + pd.DateOffset(months=i)).date(), 0.0) for i in range(15)]
    rows += [("C", (pd.Timestamp("2022-01-01") + pd.DateOffset(months=i)).date(), 7.0) for i in range(15)]
    out = forecast.forecast(spark.createDataFrame(rows, "state string, ds date, y double")).collect()
    by = {}
    for r in out:
        by.setdefault(r.state, []).append(r)
    assert set(by) == {"Z", "C"}
    c = [r for r in by["C"] if r.error is None]
    assert len(c) == 6 and all(r.predicted == 7 for r in c)


def test_holiday_regressor(spark):
    # December has 3 holidays and a dip of 300; the regressor lets the additive model see it
    months = [(pd.Timestamp("2020-01-01") + pd.DateOffset(months=i)) for i in range(48)]
    rows = [("S", m.date(), 1000.0 + 5 * i - (300.0 if m.month == 12 else 0.0)) for i, m in enumerate(months)]
    cal = [((pd.Timestamp("2020-01-01") + pd.DateOffset(months=i)).date(),
            3 if (pd.Timestamp("2020-01-01") + pd.DateOffset(months=i)).month == 12 else 0) for i in range(60)]
    df = spark.createDataFrame(rows, "state string, ds date, y double")
    hol = spark.createDataFrame(cal, "ds date, holidays int")
    out = forecast.forecast(df, holidays=hol).orderBy("month").collect()
    assert len(out) == 6 and all(r.error is None for r in out)
    assert all(r.lower <= r.predicted <= r.upper for r in out)
