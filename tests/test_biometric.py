import datetime as dt

from civicstat.operators import biometric

ENR = "date date, state string, district string, pincode string, age_0_5 int, age_5_17 int, age_18_greater int"
BIO = "date date, state string, district string, pincode string, bio_age_5_17 int, bio_age_17_ int"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def _facts(spark, rows):
    enr = spark.createDataFrame([(d, s, di, None, 0, a, b) for d, s, di, a, b, _, _ in rows], ENR)
    bio = spark.createDataFrame([(d, s, di, None, x, y) for d, s, di, _, _, x, y in rows], BIO)
    return enr, bio


def test_success_rates_exact(spark):
    enr, bio = _facts(spark, [(D1, "S1", "D1", 100, 100, 80, 90), (D2, "S1", "D2", 100, 100, 40, 50)])
    rows = {r.district: r for r in biometric.success_rates(enr, bio).collect()}
    assert (rows["D1"].success_rate_5_17, rows["D1"].success_rate_17_plus) == (80.0, 90.0)
    assert rows["D1"].date == "2024-01-01"


def test_low_performers_only_d2(spark):
    enr, bio = _facts(spark, [(D1, "S1", "D1", 100, 100, 80, 90), (D2, "S1", "D2", 100, 100, 40, 50)])
    low = biometric.low_performers(biometric.success_rates(enr, bio), threshold=60).collect()
    assert [(r.district, r.success_rate) for r in low] == [("D2", 45.0)]
    assert low[0].gap == 15.0 and low[0].priority_score == 150.0


def test_low_performers_state_filter(spark):
    enr, bio = _facts(spark, [(D1, "S1", "D1", 100, 100, 10, 10), (D2, "S2", "D2", 100, 100, 10, 10)])
    low = biometric.low_performers(biometric.success_rates(enr, bio), threshold=60, state="S2").collect()
    assert [r.district for r in low] == ["D2"]


def test_zero_enrollments_give_zero_rate(spark):
    enr, bio = _facts(spark, [(D1, "S1", "D1", 0, 0, 5, 5)])
    r = biometric.success_rates(enr, bio).first()
    assert (r.success_rate_5_17, r.success_rate_17_plus) == (0.0, 0.0)


def test_repeat_attempts_rate(spark):
    enr, bio = _facts(spark, [(D1, "S1", "D3", 10, 10, 30, 20), (D2, "S1", "D4", 10, 10, 10, 10)])
    rows = biometric.repeat_attempts(enr, bio).collect()
    assert [(r.district, r.repeat_rate) for r in rows] == [("D3", 2.5)]


def test_keys_are_pre_aggregated_not_fanned_out(spark):
    # two enrollment rows and two attempt rows on one key: one joined row,
    # rates are ratios of the sums (no 2 × 2 fan-out)
    enr, _ = _facts(spark, [(D1, "S1", "D1", 50, 50, 0, 0), (D1, "S1", "D1", 50, 50, 0, 0)])
    _, bio = _facts(spark, [(D1, "S1", "D1", 0, 0, 40, 45), (D1, "S1", "D1", 0, 0, 40, 45)])
    rows = biometric.success_rates(enr, bio).collect()
    assert len(rows) == 1 and rows[0].success_rate_5_17 == 80.0 and rows[0].success_rate_17_plus == 90.0
