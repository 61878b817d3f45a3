import datetime as dt
import os

import numpy as np
import pandas as pd
import pytest

from civicstat.operators import risk


@pytest.fixture(scope="module")
def history(spark):
    rng = np.random.default_rng(42)
    rows = []
    for s in ("S1", "S2"):
        for d in range(5):
            for m in range(24):
                month = (pd.Timestamp("2022-01-01") + pd.DateOffset(months=m)).date()
                enr = int(rng.integers(100, 1000))
                rate = rng.uniform(0.4, 0.9)
                rows.append((month, s, f"{s}-D{d}", enr, int(enr * rate), int(enr * 0.1)))
    return spark.createDataFrame(rows, "month date, state string, district string, enrollments long, "
                                       "biometric_attempts long, demo_updates long")


def test_features_shape(history):
    f = risk.risk_features(history).collect()
    assert len(f) == 10 * 21  # last 3 months of each district have no target
    r = f[0]
    assert r.is_high_risk in (0, 1)
    latest = risk.latest_features(history).collect()
    assert len(latest) == 10 and all(x.month == dt.date(2023, 12, 1) for x in latest)


def test_growth_rate_zero_division(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "S", "D", 0, 0, 0), (dt.date(2024, 2, 1), "S", "D", 10, 5, 1)],
                               "month date, state string, district string, enrollments long, "
                               "biometric_attempts long, demo_updates long")
    rows = risk.risk_features(df, with_target=False).orderBy("month").collect()
    assert [r.growth_rate for r in rows] == [0.0, 0.0]
    assert rows[0].success_rate == 0.0 and rows[1].success_rate == 50.0


def test_train_predict_and_persist(spark, history, scratch):
    model, info = risk.train_model(risk.risk_features(history))
    assert model is not None and info["model"] in ("RF", "GBM")
    out = risk.predict_risk(model, risk.latest_features(history)).collect()
    assert len(out) == 10
    for r in out:
        assert 0.0 <= r.risk_score <= 1.0
        expect = "High" if r.risk_score > 0.7 else "Medium" if r.risk_score > 0.4 else "Low"
        assert r.risk_category == expect
        assert len(r.top_factors) == 3 and set(r.top_factors) <= set(risk.FEATURES)
    path = os.path.join(scratch, "model")
    risk.save_model(model, path)
    again = risk.predict_risk(risk.load_model(path), risk.latest_features(history)).collect()
    assert sorted((r.district, r.risk_score) for r in again) == sorted((r.district, r.risk_score) for r in out)


def test_insufficient_data(spark, history):
    small = history.limit(20)
    model, info = risk.train_model(risk.risk_features(small))
    assert model is None and "Insufficient" in info["error"]


def test_split_is_exact_in_every_class(spark):
    import datetime as dt
    rows = [(f"S{i % 3}", f"D{i}", dt.date(2024, 1 + i % 12, 1), int(i < 4)) for i in range(100)]
    df = spark.createDataFrame(rows, "state string, district string, month date, label int")
    got = risk.stratified_split(df).groupBy("label", "fold", "is_test").count().collect()
    # 4 positives: one in the hold-out and one in each fold
    assert {(r.label, r.fold, r.is_test): r["count"] for r in got} == {
        (1, 0, True): 1, (1, 1, False): 1, (1, 2, False): 1, (1, 3, False): 1,
        (0, 0, True): 19, (0, 1, False): 25, (0, 2, False): 26, (0, 3, False): 26}
    assert risk.stratified_split(df.where("label = 0 OR district IN ('D0', 'D1', 'D2')")) is None
    again = {(r.district, r.fold) for r in risk.stratified_split(df.repartition(7)).collect()}
    assert again == {(r.district, r.fold) for r in risk.stratified_split(df).collect()}


def test_rank_cuts_refine_bins_that_hold_many_hashes(spark):
    # all hashes share their first 48 bits but for a few
    hashes = [(1 << 50) + i for i in range(500)] + [1, 2, (1 << 59) + 5]
    df = spark.createDataFrame([(0, h) for h in hashes], "label int, h long")
    ordered = sorted(hashes)
    ranks = [1, 2, 250, 501, 502, 503]
    cuts = risk.rank_cuts(df, {0: ranks})[0]
    for rank, cut in zip(ranks, cuts):
        assert sum(h < cut for h in hashes) == rank and (rank == 503 or cut == ordered[rank])


def test_asked_districts_without_model_or_data(spark):
    asked = spark.createDataFrame([("S", "D"), ("S", "none"), ("S", "D")], "state string, district string")
    rows = risk.risk_rows(None, None, asked).collect()
    assert {(r.district, r.risk_score, r.error) for r in rows} == {("D", None, risk.NOT_TRAINED), ("none", None, risk.NOT_TRAINED)}


def test_known_and_unknown_districts(spark, history):
    model, _ = risk.train_model(risk.risk_features(history))
    asked = spark.createDataFrame([("S1", "S1-D0"), ("S1", "nowhere")], "state string, district string")
    rows = {r.district: r for r in risk.risk_rows(model, risk.latest_features(history), asked).collect()}
    assert rows["S1-D0"].error is None and 0 <= rows["S1-D0"].risk_score <= 1
    assert rows["nowhere"].error == risk.NO_DATA and rows["nowhere"].risk_score is None


def test_first_rounds_of_a_longer_fit_are_the_shorter_fit(spark, history):
    f = risk.risk_features(history).select(*risk.FEATURES, risk.F.col("is_high_risk").cast("double").alias("label"))
    ready = risk._preparation().fit(f).transform(f).select("label", "features").coalesce(1).cache()
    long, short = (risk._boosted(n, 0.1).fit(ready) for n in (12, 5))
    cut = risk.first_rounds(long, 5)
    a, b = ([tuple(r.probability) for r in m.transform(ready).collect()] for m in (cut, short))
    assert a == b and a != [tuple(r.probability) for r in long.transform(ready).collect()]
