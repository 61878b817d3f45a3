import datetime as dt

import numpy as np

from civicstat.operators import growth, saturation

ENR = "date date, state string, district string, pincode string, age_0_5 int, age_5_17 int, age_18_greater int"


def _daily(spark, n=730, seed=7):
    rng = np.random.default_rng(seed)
    start = dt.date(2024, 1, 1)
    rows = []
    for i in range(n):
        d = start + dt.timedelta(days=i)
        base = 10 + 90 * i / n + rng.normal(0, 5) + (20 if d.month == 6 else 0)
        v = max(int(base), 0)
        rows.append((d, "S", "D", None, v, v, v))
    return spark.createDataFrame(rows, ENR)


def test_growth_has_all_periods_and_june(spark):
    out = growth.growth_rates(_daily(spark)).collect()
    periods = {r.period for r in out}
    assert periods == {"Monthly_MoM", "Quarterly_QoQ", "Yearly_YoY"}
    monthly = [r for r in out if r.period == "Monthly_MoM"]
    # 24 months, first dropped, three age groups
    assert len(monthly) == 23 * 3
    assert any(r.date == "2024-06-30" for r in monthly)
    assert {r.date for r in out if r.period == "Yearly_YoY"} == {"2025-12-31"}


def test_growth_zero_fill_and_infinite_change_dropped(spark):
    rows = [(dt.date(2024, 1, 5), "S", "D", None, 100, 100, 100),
            (dt.date(2024, 3, 5), "S", "D", None, 300, 300, 300)]
    out = growth.growth_rates(spark.createDataFrame(rows, ENR), periods=["month"]).collect()
    # Feb is a zero-filled bin: Jan→Feb is −100 %, Feb→Mar (x/0) is dropped
    assert sorted({(r.date, r.growth_rate_pct, r.absolute_change) for r in out}) == [("2024-02-29", -100, -100)]


def test_privacy_gate_suppresses_small_scope(spark):
    rows = [(dt.date(2024, 1, 1), "S", "D", None, 10, 10, 10)]
    df = spark.createDataFrame(rows, ENR)
    assert growth.growth_rates(df).count() == 0
    assert growth.privacy_gate(df).first().status == "suppressed"
    assert growth.seasonality(df, scope=()).count() == 0


def test_seasonality_june_peak(spark):
    out = {r.month: r.seasonal_index for r in growth.seasonality(_daily(spark), scope=()).collect()}
    assert set(out) == set(range(1, 13))
    assert out[6] > out[5]


def test_growth_rollup_levels(spark):
    df = _daily(spark, 120)
    out = growth.growth_rollup(df, periods=["month"]).select("level").distinct().collect()
    assert {r.level for r in out} == {"district", "state", "national"}


def test_daily_cumulative_zero_fills(spark):
    rows = [(dt.date(2024, 1, 1), "S", "D", None, 1, 1, 1), (dt.date(2024, 1, 4), "S", "D", None, 2, 2, 2)]
    out = growth.daily_cumulative(spark.createDataFrame(rows, ENR)).orderBy("date").collect()
    assert [r.daily_total for r in out] == [3, 0, 0, 6]
    assert [r.cumulative_total for r in out] == [3, 3, 3, 9]


def test_saturation_recovers_logistic(spark):
    # per-day increments of 1000/(1+e^-x), x in -6..6 over 100 days, split over 3 columns
    x = np.linspace(-6, 6, 100)
    cum = 1000 / (1 + np.exp(-x))
    inc = np.diff(np.concatenate([[0.0], cum]))
    start = dt.date(2024, 1, 1)
    rows = [(start + dt.timedelta(days=i), "S", "D", None, int(v / 3), int(v / 3), int(v / 3))
            for i, v in enumerate(inc)]
    r = saturation.saturation(spark.createDataFrame(rows, ENR)).first()
    assert r.error is None
    total = sum(3 * int(v / 3) for v in inc)
    assert r.estimated_saturation_count >= total * 0.99
    assert 80 <= r.current_penetration <= 100
    assert r.months_to_90_percent >= 0


def test_parameterised_sql_scan(spark):
    from civicstat.sources.tables import scan_sql
    rows = [(dt.date(2024, 1, d), "S1" if d % 2 else "S2", "D", None, 1, 1, 1) for d in range(1, 11)]
    spark.createDataFrame(rows, ENR).createOrReplaceTempView("enr_scan_test")
    out = scan_sql(spark, "enr_scan_test", state="S1", start="2024-01-03", end="2024-01-07").collect()
    assert sorted(r.date.day for r in out) == [3, 5, 7]
    assert scan_sql(spark, "enr_scan_test", state="x' OR '1'='1").count() == 0
