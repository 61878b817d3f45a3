from civicstat.operators import anomaly
from civicstat.plans import jobs
from civicstat.sources.tables import Facts

from conftest import SF


def test_nightly_and_weekly(spark, scratch):
    out = jobs.nightly(spark, SF, scratch, "2024-05-01", risk_threshold=250.0)
    assert out["alerts"] == anomaly.anomaly_report(Facts(spark, SF).enrollments).count() > 0
    assert out["model"]["model"] in ("RF", "GBM")
    assert spark.read.parquet(f"{scratch}/risk_scores").count() > 0
    assert jobs.weekly_policy(spark, SF, scratch, "2024-05-01", threshold=600.0) > 0
