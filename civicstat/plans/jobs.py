"""Batch jobs composed from the operators (what a scheduler would launch).

``nightly``: the anomaly scan of every district appended to the alert table
(S11) and the risk model retrained and saved (S13). ``weekly_policy``:
problem districts → policy request rows written for the external service.
Paths are folders on shared storage; every write replaces only its own
partition or path, so a re-run after a failure is safe.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from civicstat.operators import anomaly, biometric, cases, risk
from civicstat.session import apply_conf, materialize
from civicstat.sources.tables import Facts


def nightly(spark: SparkSession, sf_dir: str, out_dir: str, run_date: str,
            risk_threshold: float = risk.DEFAULT_RISK_THRESHOLD) -> dict:
    apply_conf(spark)
    f = Facts(spark, sf_dir)
    enr, _ = f.daily  # both facts are read once, into the day table
    alerts = anomaly.daily_scan(enr, f"{out_dir}/anomaly_alerts", run_date)
    train = materialize(risk.training_set_from_days(f.days, f.demographic))
    model, info = risk.train_model(risk.risk_features(train, risk_threshold=risk_threshold))
    if model is not None:
        risk.save_model(model, f"{out_dir}/risk_model")
        (risk.predict_risk(model, risk.latest_features(train))
         .write.mode("overwrite").parquet(f"{out_dir}/risk_scores/run_date={run_date}"))
    n_alerts = spark.read.parquet(f"{out_dir}/anomaly_alerts").filter(f"detected_on = '{run_date}'").count()
    return {"alerts": n_alerts, "model": info, "columns": alerts.columns}


def weekly_policy(spark: SparkSession, sf_dir: str, out_dir: str, run_date: str,
                  threshold: float = 60.0) -> int:
    apply_conf(spark)
    f = Facts(spark, sf_dir)
    enr, bio = f.daily
    low = biometric.low_performers(biometric.success_rates(enr, bio), threshold)
    req = cases.policy_requests(cases.problem_districts(low, anomaly.anomaly_report(enr)))
    req.write.mode("overwrite").json(f"{out_dir}/policy_requests/run_date={run_date}")
    return spark.read.json(f"{out_dir}/policy_requests/run_date={run_date}").count()
