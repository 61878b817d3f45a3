"""Three-method anomaly detection with cross-validation, for all districts at once.

The series of a scope is its daily totals (deviation D4: the raw rows are
summed per day first, so several pincodes on one day make one value),
limited to the latest ``days + 60`` days. All three detectors are window
columns over that series, partitioned by the scope, so the whole scan of
every district is one plan with one shuffle of the fact (the daily
aggregate) and one of the small aggregate (the windows). A hot district
cannot overload a task: after the daily aggregate each partition holds at
most ``days + 60`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicstat.functions.scalar import optional_filter, round_half_even, total

AGE_COLS = ["age_0_5", "age_5_17", "age_18_greater"]
SCOPE = ("state", "district")
METRIC = "daily_enrollments"
# Fixed detector parameters (reference defaults).
Z_THRESHOLD = 3.0
Z_MIN_ROWS = 3
IQR_MIN_ROWS = 5
IQR_K = 1.5
ROLL_WINDOW = 30
ROLL_DEVIATION = 0.5
EXTRA_HISTORY_DAYS = 60
MAX_SEVERITY = 10.0
DEFAULT_SEVERITY = 5.0
METHOD_ORDER = ("z_score", "iqr", "rolling_deviation")


def anomaly_series(enr: DataFrame, scope=SCOPE, days: int = 90, state=None,
                   district=None) -> DataFrame:
    """Q8: latest ``days + 60`` daily totals per scope."""
    scope = list(scope)
    enr = optional_filter(enr, state=state, district=district)
    daily = enr.groupBy(*scope, "date").agg(F.sum(total(*AGE_COLS)).cast("double").alias(METRIC))
    w = (Window.partitionBy(*scope) if scope else Window.partitionBy()).orderBy(F.desc("date"))
    return (daily.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= days + EXTRA_HISTORY_DAYS).drop("_rn"))


def with_detectors(series: DataFrame, scope=SCOPE, value: str = METRIC,
                   z_threshold: float = Z_THRESHOLD, window: int = ROLL_WINDOW) -> DataFrame:
    """Q9–Q11 as columns: z, IQR fences, rolling mean/deviation and a flag each."""
    scope = list(scope)
    v = F.col(value)
    whole = Window.partitionBy(*scope) if scope else Window.partitionBy()
    ordered = whole.orderBy("date")
    n = F.count(F.lit(1)).over(whole)
    mean = F.avg(v).over(whole)
    std = F.stddev_pop(v).over(whole)
    q1 = F.percentile(v, 0.25).over(whole)
    q3 = F.percentile(v, 0.75).over(whole)
    # three projections (window stats, derived values, flags) instead of a
    # chain of single-column steps
    out = series.withColumns({
        "_n": n, "_known": F.count(v).over(whole), "series_mean": mean, "_std": std, "_q1": q1, "_q3": q3,
        "rolling_mean": F.avg(v).over(ordered.rowsBetween(-(window - 1), 0)),
        "_pos": F.row_number().over(ordered)})
    iqr = F.col("_q3") - F.col("_q1")
    out = out.withColumns({
        # std 0 → NULL z (scipy gives NaN), never flagged
        "z_score": F.try_divide(F.abs(v - F.col("series_mean")), F.col("_std")),
        "lower_bound": F.col("_q1") - IQR_K * iqr,
        "upper_bound": F.col("_q3") + IQR_K * iqr,
        "deviation_pct": F.abs(F.try_divide(v - F.col("rolling_mean"), F.col("rolling_mean")))})
    return out.withColumns({
        "is_z": F.coalesce((F.col("_n") >= Z_MIN_ROWS) & (F.col("_known") == F.col("_n"))  # a NULL day leaves no z-score
                           & (F.col("z_score") > z_threshold), F.lit(False)),
        "is_iqr": F.coalesce((F.col("_n") >= IQR_MIN_ROWS)
                             & ((v < F.col("lower_bound")) | (v > F.col("upper_bound"))), F.lit(False)),
        # the first `window` rows are skipped, the first full window included
        "is_roll": F.coalesce((F.col("_n") >= window) & (F.col("_pos") > window)
                              & (F.col("deviation_pct") > ROLL_DEVIATION), F.lit(False)),
    }).drop("_q1", "_q3", "_pos", "_std", "_known")


def detection_methods(is_z: Column, is_iqr: Column, is_roll: Column) -> Column:
    """Names of the methods that flagged the day, in method order (no lambda)."""
    flags = [is_z, is_iqr, is_roll]
    named = F.array(*[F.when(f, F.lit(m)) for f, m in zip(flags, METHOD_ORDER)])
    return F.array_except(named, F.array(F.lit(None).cast("string")))


def n_methods(is_z: Column, is_iqr: Column, is_roll: Column) -> Column:
    return is_z.cast("int") + is_iqr.cast("int") + is_roll.cast("int")


def anomaly_report(enr: DataFrame, scope=SCOPE, days: int = 90, state=None,
                   district=None) -> DataFrame:
    """Q12/Q13: days flagged by at least two methods, typed and scored.

    Output follows the alert table: date, *scope, metric_name,
    anomaly_value, severity_score, anomaly_type, detection_methods.
    """
    scope = list(scope)
    d = with_detectors(anomaly_series(enr, scope, days, state, district), scope)
    methods = detection_methods(F.col("is_z"), F.col("is_iqr"), F.col("is_roll"))
    is_drop = F.when(F.col("is_roll"), F.col(METRIC) < F.col("rolling_mean")) \
        .otherwise(F.col(METRIC) < F.col("series_mean"))
    severity = F.when(F.col("is_z"), F.least(F.lit(MAX_SEVERITY), F.col("z_score"))) \
        .otherwise(F.lit(DEFAULT_SEVERITY))
    return (d.filter(n_methods(F.col("is_z"), F.col("is_iqr"), F.col("is_roll")) >= 2)
            .withColumn("detection_methods", methods)
            .select("date", *scope,
                    F.lit(METRIC).alias("metric_name"),
                    F.col(METRIC).alias("anomaly_value"),
                    round_half_even(severity, 2).alias("severity_score"),
                    F.when(is_drop, "drop").otherwise("spike").alias("anomaly_type"),
                    "detection_methods"))


def report_details(enr: DataFrame, scope=SCOPE, days: int = 90) -> DataFrame:
    """The confirmed days with what each method found, NULL where it did
    not flag the day."""
    scope = list(scope)
    d = with_detectors(anomaly_series(enr, scope, days), scope)
    found = {"is_z": ["z_score"], "is_iqr": ["lower_bound", "upper_bound"], "is_roll": ["rolling_mean", "deviation_pct"]}
    details = [F.when(F.col(flag), F.col(c)).alias(c) for flag, cols in found.items() for c in cols]
    flags = [F.col(f) for f in found]
    return d.filter(n_methods(*flags) >= 2).select(
        "date", *scope, F.col(METRIC).alias("value"), detection_methods(*flags).alias("methods"), *details)


def flagged(enr: DataFrame, method: str, scope=SCOPE, days: int = 90) -> DataFrame:
    """Rows one detector flags, with that detector's details."""
    scope = list(scope)
    d = with_detectors(anomaly_series(enr, scope, days), scope)
    detail = {
        "z_score": ("is_z", ["z_score"]),
        "iqr": ("is_iqr", ["lower_bound", "upper_bound"]),
        "rolling_deviation": ("is_roll", ["rolling_mean", "deviation_pct"]),
    }[method]
    return d.filter(F.col(detail[0])).select(
        *scope, "date", F.col(METRIC).alias("value"), *detail[1], F.lit(method).alias("method"))


def distinct_scopes(enr: DataFrame, scope=SCOPE, limit: int | None = None) -> DataFrame:
    """The contexts a daily scan covers — all of them by default
    (deviation D7); ``limit`` keeps the first n in key order."""
    d = enr.select(*scope).distinct()
    return d.orderBy(*scope).limit(limit) if limit else d


def daily_scan(enr: DataFrame, alerts_path: str, run_date: str | None = None, days: int = 90) -> DataFrame:
    """Q13: the report for every district in one job, appended to the alert
    table (S11, the run date's partition is replaced on re-run)."""
    from civicstat.session import materialize
    from civicstat.sources.sinks import append_alerts
    report = materialize(anomaly_report(enr, SCOPE, days))  # written, returned and read again from one copy
    append_alerts(report, alerts_path, run_date)
    return report
