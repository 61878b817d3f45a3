"""Registered queries: name → fn(spark, sf_dir) → DataFrame.

Each entry runs one operator over the whole driver tables (through the
fact roles). Double outputs go through ``stable`` so the DuckDB oracle can
compare value hashes exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicstat.functions.scalar import round_half_even
from civicstat.operators import anomaly, biometric, cases, daytable, forecast, growth, rawjoin, risk, saturation
from civicstat.schemas import CONSTRAINED
from civicstat.session import checkpoint_dir, materialize
from civicstat.sources import ingest, sinks
from civicstat.sources.tables import Facts, biometric_lines, raw_exports

# Registered low-performer threshold. Rates here are ratios of daily sums
# (both facts pre-aggregated to the key grain, see operators/biometric.py),
# which puts district averages at about 290..2200 on the driver tables; the
# reference default 60, and the 160 chosen for fan-out sums, select nothing.
# 600 selects 17 / 10 / 25 of 25 districts at sf0.001 / 0.01 / 0.1.
LOW_PERFORMER_THRESHOLD = 600.0

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def stable(df: DataFrame, digits: int = 6, keep: tuple[str, ...] = ()) -> DataFrame:
    """Round every double column (ties to even) except ``keep``."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType) and f.name not in keep:
            cols.append(round_half_even(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


@register("success_rates")
def q_success_rates(spark, sf_dir):
    return biometric.daily_rates(biometric.joined_from_days(Facts(spark, sf_dir).days))


@register("low_performers")
def q_low_performers(spark, sf_dir):
    rates = biometric.daily_rates(biometric.joined_from_days(Facts(spark, sf_dir).days))
    return stable(biometric.low_performers(rates, threshold=LOW_PERFORMER_THRESHOLD))


@register("repeat_attempts")
def q_repeat_attempts(spark, sf_dir):
    return biometric.daily_repeats(biometric.joined_from_days(Facts(spark, sf_dir).days))


@register("enrollments_base")
def q_enrollments_base(spark, sf_dir):
    """The enrollments role with the derived total."""
    e = Facts(spark, sf_dir).enrollments
    return e.withColumn("total", F.col("age_0_5") + F.col("age_5_17") + F.col("age_18_greater"))


# ---------------------------------------------------------------- growth
@register("growth_monthly")
def q_growth_monthly(spark, sf_dir):
    return growth.growth_rates(Facts(spark, sf_dir).enrollments, periods=["month"])


@register("growth_quarterly")
def q_growth_quarterly(spark, sf_dir):
    return growth.growth_rates(Facts(spark, sf_dir).enrollments, periods=["quarter"])


@register("growth_yearly")
def q_growth_yearly(spark, sf_dir):
    return growth.growth_rates(Facts(spark, sf_dir).enrollments, periods=["year"])


@register("growth_by_scope_rollup")
def q_growth_rollup(spark, sf_dir):
    return growth.growth_rollup(Facts(spark, sf_dir).enrollments)


@register("seasonality")
def q_seasonality(spark, sf_dir):
    return growth.seasonality(Facts(spark, sf_dir).enrollments, scope=("state",))


@register("privacy_gate")
def q_privacy_gate(spark, sf_dir):
    return growth.privacy_gate(Facts(spark, sf_dir).enrollments, scope=("state", "district"))


PINCODE_SCOPE = ("state", "district", "pincode")
# Some pincodes of every scale factor have fewer enrollments, most have more.
PINCODE_MIN = 500


@register("privacy_gate_pincode")
def q_privacy_gate_pincode(spark, sf_dir):
    """Pincodes on both sides of the threshold."""
    return growth.privacy_gate(Facts(spark, sf_dir).enrollments, scope=PINCODE_SCOPE, min_count=PINCODE_MIN)


@register("growth_pincode_yearly")
def q_growth_pincode_yearly(spark, sf_dir):
    """Growth of every pincode, with a row for each that is suppressed."""
    enr = Facts(spark, sf_dir).enrollments
    rows = growth.growth_rates(enr, scope=PINCODE_SCOPE, periods=["year"], min_count=PINCODE_MIN)
    return growth.with_suppressed(rows, enr, PINCODE_SCOPE, PINCODE_MIN)


@register("daily_cumulative")
def q_daily_cumulative(spark, sf_dir):
    return growth.daily_cumulative(Facts(spark, sf_dir).enrollments)


# ---------------------------------------------------------------- anomalies
@register("anomaly_series")
def q_anomaly_series(spark, sf_dir):
    return anomaly.anomaly_series(Facts(spark, sf_dir).enrollments)


@register("anomaly_zscore")
def q_anomaly_zscore(spark, sf_dir):
    return stable(anomaly.flagged(Facts(spark, sf_dir).enrollments, "z_score"))


@register("anomaly_iqr")
def q_anomaly_iqr(spark, sf_dir):
    return stable(anomaly.flagged(Facts(spark, sf_dir).enrollments, "iqr"))


@register("anomaly_rolling")
def q_anomaly_rolling(spark, sf_dir):
    return stable(anomaly.flagged(Facts(spark, sf_dir).enrollments, "rolling_deviation"))


@register("anomaly_report")
def q_anomaly_report(spark, sf_dir):
    rep = anomaly.anomaly_report(Facts(spark, sf_dir).enrollments)
    return rep.withColumn("detection_methods", F.array_join("detection_methods", ","))


@register("anomaly_incremental")
def q_anomaly_incremental(spark, sf_dir):
    """The report from the day table: all but the last 40 days are loaded first,
    then these, and only their months are summed again."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/days-{uuid.uuid4().hex}"
    enr = materialize(Facts(spark, sf_dir).enrollments)
    last = enr.agg(F.max("date").alias("d")).head()["d"]
    late = F.date_add("date", 40) > F.lit(last)
    daytable.append_rows(enr.where(~late), f"{base}/fact")
    daytable.refresh_days(spark, f"{base}/fact", f"{base}/days")
    months = daytable.append_rows(enr.where(late), f"{base}/fact")
    daytable.refresh_days(spark, f"{base}/fact", f"{base}/days", months)
    rep = anomaly.anomaly_report(daytable.read_days(spark, f"{base}/days"))
    return rep.withColumn("detection_methods", F.array_join("detection_methods", ","))


@register("anomaly_details")
def q_anomaly_details(spark, sf_dir):
    return stable(anomaly.report_details(Facts(spark, sf_dir).enrollments)).withColumn("methods", F.array_join("methods", ","))


@register("distinct_scopes")
def q_distinct_scopes(spark, sf_dir):
    return anomaly.distinct_scopes(Facts(spark, sf_dir).enrollments)


# ---------------------------------------------------------------- forecasting
@register("monthly_series")
def q_monthly_series(spark, sf_dir):
    return forecast.monthly_series(Facts(spark, sf_dir).enrollments)


@register("monthly_interpolated")
def q_monthly_interpolated(spark, sf_dir):
    # district scope: the level where months can be missing
    return stable(forecast.monthly_interpolated(Facts(spark, sf_dir).enrollments,
                                                scope="district", national=False))


@register("backtest_split")
def q_backtest_split(spark, sf_dir):
    s = forecast.monthly_interpolated(Facts(spark, sf_dir).enrollments)
    return forecast.backtest_split(s)


@register("forecast")
def q_forecast(spark, sf_dir):
    s = forecast.monthly_interpolated(Facts(spark, sf_dir).enrollments)
    return forecast.forecast(s)


@register("forecast_backtest")
def q_forecast_backtest(spark, sf_dir):
    s = forecast.monthly_interpolated(Facts(spark, sf_dir).enrollments)
    return forecast.forecast_backtest(s)


# ---------------------------------------------------------------- risk
# Registered risk-label threshold. The reference labels a month high-risk
# when the rate three months later is below 60; monthly rates here are
# ratios of sums with a median near 245, and 60 leaves 34 / 3 / 0 positive
# rows at sf0.001 / 0.01 / 0.1 (one class: no model can be trained). 250
# splits the labels about evenly at every scale.
RISK_THRESHOLD = 250.0
# Means of pair rates on the driver tables have medians of 133 to 166.
RAW_JOIN_THRESHOLD = 160.0


def _training(spark, sf_dir):
    f = Facts(spark, sf_dir)
    return risk.training_set_from_days(f.days, f.demographic)


@register("training_set")
def q_training_set(spark, sf_dir):
    return _training(spark, sf_dir)


@register("risk_features")
def q_risk_features(spark, sf_dir):
    return stable(risk.risk_features(_training(spark, sf_dir), risk_threshold=RISK_THRESHOLD))


@register("risk_features_latest")
def q_risk_features_latest(spark, sf_dir):
    return stable(risk.latest_features(_training(spark, sf_dir)))


@register("low_performers_raw_join")
def q_low_performers_raw_join(spark, sf_dir):
    """Means over all pairs of raw rows (threshold of their own size)."""
    g = Facts(spark, sf_dir)
    return stable(rawjoin.low_performers(g.enrollments, biometric_lines(spark, sf_dir, g.geo), RAW_JOIN_THRESHOLD))


@register("training_set_raw_join")
def q_training_set_raw_join(spark, sf_dir):
    f = Facts(spark, sf_dir)
    t = rawjoin.training_set(f.enrollments, biometric_lines(spark, sf_dir, f.geo), f.demographic)
    return t.select("month", "state", "district", *[F.col(c).cast("long").alias(c) for c in ("enrollments", "biometric_attempts", "demo_updates")])


@register("risk_split")
def q_risk_split(spark, sf_dir):
    """The exact hold-out and folds of the labelled months."""
    rows = risk.risk_features(_training(spark, sf_dir), risk_threshold=RISK_THRESHOLD).select("state", "district", "month", "is_high_risk")
    split = risk.stratified_split(materialize(rows), "is_high_risk")
    if split is None:
        return rows.withColumns({"fold": F.lit(None).cast("int"), "is_test": F.lit(None).cast("boolean")}).limit(0)
    return split


@register("risk_scores")
def q_risk_scores(spark, sf_dir):
    checkpoint_dir(spark)
    train = _training(spark, sf_dir).checkpoint(eager=True)  # counted, fitted and scored from one copy
    model, info = risk.train_model(risk.risk_features(train, risk_threshold=RISK_THRESHOLD), raw_rows=train.count())
    if model is None:
        return spark.createDataFrame([], "state string, district string, risk_score double, "
                                         "risk_category string, top_factors string")
    return risk.predict_risk(model, risk.latest_features(train)) \
        .withColumn("top_factors", F.array_join("top_factors", ","))


@register("saturation")
def q_saturation(spark, sf_dir):
    return saturation.saturation(Facts(spark, sf_dir).enrollments)


# ---------------------------------------------------------------- ETL
def _classified_enrollments(spark, sf_dir):
    """The enrollments role rendered as the raw CSV text the ETL reads."""
    raw = ingest.raw_text_view(Facts(spark, sf_dir).enrollments)
    return ingest.classify(raw, "enrollment")


@register("clean_enrollments")
def q_clean_enrollments(spark, sf_dir):
    return ingest.clean_rows(_classified_enrollments(spark, sf_dir))


@register("quality_report")
def q_quality_report(spark, sf_dir):
    c = _classified_enrollments(spark, sf_dir)
    rules = ingest.rule_names(["date", "state", "district", "pincode", *growth.AGE_COLS], "enrollment")
    rep = ingest.quality_report(c, "enrollment", rules)
    return rep.withColumn("errors", ingest.errors_text("errors"))


@register("quarantine")
def q_quarantine(spark, sf_dir):
    q = ingest.quarantine_rows(_classified_enrollments(spark, sf_dir))
    return q.select(F.to_json("raw").alias("raw"), F.array_join("reasons", ",").alias("reasons"))


def _clean_raw(dataset: str):
    def run(spark, sf_dir):
        return ingest.clean_rows(ingest.classify(raw_exports(spark, sf_dir)[dataset], dataset))
    return run


for _dataset in ("enrollment", "biometric", "demographic"):
    register(f"etl_clean_{_dataset}")(_clean_raw(_dataset))


@register("etl_reports")
def q_etl_reports(spark, sf_dir):
    reports = [ingest.quality_report(ingest.classify(raw, name), name, ingest.rule_names(raw.columns, name))
               for name, raw in raw_exports(spark, sf_dir).items()]
    return reduce(DataFrame.unionByName, reports).withColumn("errors", ingest.errors_text("errors"))


@register("etl_quarantine")
def q_etl_quarantine(spark, sf_dir):
    parts = [ingest.quarantine_rows(ingest.classify(raw, name)).select(
        F.lit(name).alias("dataset"), F.to_json("raw").alias("raw"), F.array_join("reasons", ",").alias("reasons"))
        for name, raw in raw_exports(spark, sf_dir).items()]
    return reduce(DataFrame.unionByName, parts)


@register("dedupe_load")
def q_dedupe_load(spark, sf_dir):
    """The older enrollments are loaded first, then all: every row is there once."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/load-{uuid.uuid4().hex}"
    enr = Facts(spark, sf_dir).enrollments
    enr.where("date < DATE'1998-01-01'").write.parquet(f"{base}/older")
    enr.write.parquet(f"{base}/all")
    for part in ("older", "all"):
        sinks.load_parquet(spark, f"{base}/{part}", f"{base}/target")
    return spark.read.parquet(f"{base}/target")


@register("ledger_load")
def q_ledger_load(spark, sf_dir):
    """Two loads with constraints: households without a district or with a
    negative balance are errors, rows loaded before are skipped."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/ledger-{uuid.uuid4().hex}"
    raw = raw_exports(spark, sf_dir)["enrollment"]
    rows = raw.select(
        F.try_to_date("date", "dd-MM-yyyy").alias("date"), "state", "district", "pincode",
        F.col("age_0_5").try_cast("int").alias("age_0_5"), F.col("age_5_17").try_cast("int").alias("age_5_17"),
        F.col("age_18_greater").try_cast("int").alias("age_18_greater"))
    rows = materialize(rows)
    rows.where("date < DATE'1996-01-01'").write.parquet(f"{base}/older")
    rows.write.parquet(f"{base}/all")
    out = []
    for load in ("older", "all"):
        s = sinks.load_with_ledger(spark, f"{base}/{load}", f"{base}/target", load, CONSTRAINED["enrollment"], batches=4)
        out.append(s.select(F.lit(load).alias("load"), "total_rows", "inserted", "errors", "status"))
    there = sinks.loaded_rows(spark, f"{base}/target").agg(F.count("*").alias("total_rows"))
    out.append(there.select(F.lit("target").alias("load"), "total_rows", F.col("total_rows").alias("inserted"),
                            F.lit(0).cast("long").alias("errors"), F.lit("Completed").alias("status")))
    return reduce(DataFrame.unionByName, out)


@register("etl_csv_files")
def q_etl_csv_files(spark, sf_dir):
    """The enrollment exports written as CSV files, quoted line breaks in the
    districts of one state, and read back through the whole ETL."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    raw = raw_exports(spark, sf_dir)["enrollment"]
    for name, rows in (("plain", raw.where("state <> 'ASIA'")),
                       ("breaks", raw.where("state = 'ASIA'").withColumn("district", F.concat("district", F.lit("\nzone"))))):
        rows.write.option("header", True).csv(f"{base}/{name}")
    ingest.run_etl(spark, {"enrollment": [f"{base}/plain", f"{base}/breaks"]}, f"{base}/out")
    return spark.read.parquet(f"{base}/out/enrollment_clean.parquet")


# ---------------------------------------------------------------- cases and text rows
def _alerts(spark, sf_dir):
    return anomaly.anomaly_report(Facts(spark, sf_dir).enrollments)


def _low_and_alerts(f: Facts):
    """Both from the day table, so the facts are read once."""
    enr, bio = f.daily
    low = biometric.low_performers(biometric.success_rates(enr, bio), threshold=LOW_PERFORMER_THRESHOLD)
    return low, anomaly.anomaly_report(enr)


@register("case_text")
def q_case_text(spark, sf_dir):
    c = cases.alert_cases(_alerts(spark, sf_dir))
    return c.select("case_id", "text", F.col("metadata")["type"].alias("meta_type"),
                    F.col("metadata")["severity"].alias("meta_severity"),
                    F.col("metadata")["date"].alias("meta_date"))


@register("similar_cases_exact")
def q_similar_cases_exact(spark, sf_dir):
    emb = Facts(spark, sf_dir).table("embeddings", "vec_id", "embedding")
    nn = cases.similar_cases(emb, emb, self_search=True, query_id="vec_id", index_id="vec_id", vec="embedding")
    return stable(nn.select(F.col("query_id").alias("vec_id"), "nn_rank", "neighbor_id", "distance"))


@register("explanation_requests")
def q_explanation_requests(spark, sf_dir):
    return cases.explanation_requests(cases.alert_cases(_alerts(spark, sf_dir)))


@register("new_cases_against_index")
def q_new_cases_against_index(spark, sf_dir):
    """Alerts of the last 30 days against the index of the earlier ones, which
    is stored in two overlapping parts."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/index-{uuid.uuid4().hex}"
    c = materialize(cases.alert_cases(_alerts(spark, sf_dir)))
    day = F.to_date("date")
    last = c.agg(F.max(day).alias("d")).head()["d"]
    old = c.where(F.date_add(day, 30) <= F.lit(last))
    cases.store_cases(old.where(F.date_add(day, 60) <= F.lit(last)), path)
    cases.store_cases(old, path)
    found = cases.explain_new_cases(c.where(F.date_add(day, 30) > F.lit(last)), path)
    return found.select("case_id", F.array_join("similar_cases", ",").alias("similar_cases"), "context", "note")


@register("insight_requests")
def q_insight_requests(spark, sf_dir):
    f = Facts(spark, sf_dir)
    day, _ = f.daily
    low, alerts = _low_and_alerts(f)
    enr = growth.scope_totals(day, ("state",)).withColumnRenamed("total", "total_enrollments")
    g = growth.growth_rates(day, scope=("state",), periods=["month"])
    latest = (g.withColumn("_rn", F.row_number().over(
        Window.partitionBy("state", "age_group").orderBy(F.desc("date")))).filter("_rn = 1")
        .groupBy("state").pivot("age_group", growth.AGE_COLS).agg(F.first("growth_rate_pct"))
        .select("state", *[F.col(c).alias(f"mom_growth_pct_{c}") for c in growth.AGE_COLS]))
    low = low.groupBy("state").agg(F.count(F.lit(1)).alias("low_performing_districts"))
    al = alerts.groupBy("state").agg(
        F.count(F.lit(1)).alias("anomaly_alerts"),
        F.count_if(F.col("anomaly_type") == "spike").alias("spikes"),
        F.count_if(F.col("anomaly_type") == "drop").alias("drops"))
    m = (enr.join(latest, "state", "left").join(low, "state", "left").join(al, "state", "left")
         .fillna(0, ["low_performing_districts", "anomaly_alerts", "spikes", "drops"])
         .select("state", "total_enrollments", *[f"mom_growth_pct_{c}" for c in growth.AGE_COLS],
                 "low_performing_districts", "anomaly_alerts", "spikes", "drops"))
    return cases.insight_requests(m)


@register("insight_parse")
def q_insight_parse(spark, sf_dir):
    conv = Facts(spark, sf_dir).table("conversations", "conv_id", "turn", "role", "text") \
        .filter(F.col("role") == "assistant")
    p = cases.parse_insights(conv)
    return p.select("conv_id", "turn", "parsed_ok", "executive_summary",
                    F.array_join("key_findings", "|").alias("key_findings"),
                    F.array_join("risk_alerts", "|").alias("risk_alerts"),
                    F.array_join("recommendations", "|").alias("recommendations"))


def _responses(spark, sf_dir, record):
    """A response text per district, made from its totals: a third plain JSON,
    a third inside a code fence, a third cut off."""
    totals = growth.scope_totals(Facts(spark, sf_dir).enrollments, ("state", "district"))
    body = F.to_json(record)
    kind = F.length("district") % 3
    text = (F.when(kind == 0, body).when(kind == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
            .otherwise(F.substring(body, F.lit(1), F.length(body) - 5)))
    return totals.select("state", "district", text.alias("text"))


@register("insight_responses")
def q_insight_responses(spark, sf_dir):
    record = F.struct(
        F.concat(F.lit("Total "), F.col("total").cast("string")).alias("executive_summary"),
        F.array("district", "state").alias("key_findings"), F.array(F.concat(F.lit("In "), F.col("state"))).alias("risk_alerts"),
        F.array(F.lit("Visit"), F.lit("Report")).alias("recommendations"))
    p = cases.parse_insights(_responses(spark, sf_dir, record))
    return p.select("state", "district", "parsed_ok", "executive_summary",
                    *[F.array_join(c, "|").alias(c) for c in ("key_findings", "risk_alerts", "recommendations")])


@register("policy_explode")
def q_policy_explode(spark, sf_dir):
    def advice(what):
        return F.struct(F.col("district"), F.lit(what).alias("recommendation"), F.col("state").alias("rationale"),
                        F.col("total").cast("string").alias("impact_estimate"), F.lit("high").alias("priority"))
    record = F.struct(F.array(advice("mobile unit"), advice("longer hours")).alias("recommendations"))
    return cases.explode_policy(_responses(spark, sf_dir, record)).select(
        "district", "recommendation", "rationale", "impact_estimate", "priority")


@register("problem_districts")
def q_problem_districts(spark, sf_dir):
    p = cases.problem_districts(*_low_and_alerts(Facts(spark, sf_dir)))
    return p.withColumn("issues", F.array_join("issues", "|"))


@register("policy_requests")
def q_policy_requests(spark, sf_dir):
    return cases.policy_requests(cases.problem_districts(*_low_and_alerts(Facts(spark, sf_dir))))
