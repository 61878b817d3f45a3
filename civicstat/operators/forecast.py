"""Monthly series, backtest split and model competition forecasts.

The fact is aggregated once to (scope, month) with GROUPING SETS, which
gives every state and the national series ("All India") in one pass.
Calendar densification and interpolation are windows over that small
aggregate. The model fits run per series in ``applyInPandas``; a group is
one monthly series (bounded by the calendar, not by the data volume).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicstat.functions.calendar import densify
from civicstat.functions.scalar import total
from civicstat.operators import tsmodels
from civicstat.session import ship_package

AGE_COLS = ["age_0_5", "age_5_17", "age_18_greater"]
NATIONAL = "All India"
TEST_MONTHS = 3
MIN_MONTHS = 12
HORIZON = 6


def monthly_sums(enr: DataFrame, scope: str = "state", national: bool = True) -> DataFrame:
    """A5: Σ total per (scope, month start); an all-NULL month sums to 0."""
    src = enr.select(scope, F.trunc("date", "MM").alias("ds"), total(*AGE_COLS).alias("y"))
    if national:
        agg = (src.groupingSets([[F.col(scope), F.col("ds")], [F.col("ds")]], scope, "ds")
               .agg(F.coalesce(F.sum("y"), F.lit(0)).cast("double").alias("y"), F.grouping(scope).alias("_all")))
        # a NULL scope is a scope of its own, not the national total
        return agg.select(F.when(F.col("_all") == 1, F.lit(NATIONAL)).otherwise(F.col(scope)).alias(scope), "ds", "y")
    return src.groupBy(scope, "ds").agg(F.coalesce(F.sum("y"), F.lit(0)).cast("double").alias("y"))


def monthly_series(enr: DataFrame, scope: str = "state", national: bool = True) -> DataFrame:
    """Q14 before interpolation: full month calendar, missing months NULL."""
    return densify(monthly_sums(enr, scope, national), [scope], "ds", "1 month")


def interpolate(series: DataFrame, keys, t: str = "ds", y: str = "y") -> DataFrame:
    """Linear interpolation by row position, trailing gaps carried forward,
    leading gaps 0 (pandas ``interpolate(method='linear').fillna(0)``)."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(t)
    back = w.rowsBetween(Window.unboundedPreceding, 0)
    ahead = w.rowsBetween(0, Window.unboundedFollowing)
    pos = F.row_number().over(w)
    s = series.withColumn("_pos", pos)
    known_pos = F.when(F.col(y).isNotNull(), F.col("_pos"))
    s = (s.withColumn("_py", F.last(y, ignorenulls=True).over(back))
         .withColumn("_pp", F.last(known_pos, ignorenulls=True).over(back))
         .withColumn("_ny", F.first(y, ignorenulls=True).over(ahead))
         .withColumn("_np", F.first(known_pos, ignorenulls=True).over(ahead)))
    lin = F.col("_py") + (F.col("_ny") - F.col("_py")) * (F.col("_pos") - F.col("_pp")) / (F.col("_np") - F.col("_pp"))
    filled = (F.when(F.col(y).isNotNull(), F.col(y))
              .when(F.col("_py").isNotNull() & F.col("_ny").isNotNull(), lin)
              .when(F.col("_py").isNotNull(), F.col("_py"))
              .otherwise(F.lit(0.0)))
    return s.withColumn(y, filled).drop("_pos", "_py", "_pp", "_ny", "_np")


def monthly_interpolated(enr: DataFrame, scope: str = "state", national: bool = True) -> DataFrame:
    """Q14: the forecasting input."""
    return interpolate(monthly_series(enr, scope, national), [scope])


def backtest_split(series: DataFrame, scope: str = "state", test_months: int = TEST_MONTHS,
                   min_months: int = MIN_MONTHS) -> DataFrame:
    """Q17: last ``test_months`` rows are the holdout; series under ``min_months`` drop out."""
    w = Window.partitionBy(scope).orderBy(F.desc("ds"))
    n = F.count(F.lit(1)).over(Window.partitionBy(scope))
    return (series.withColumn("_rn", F.row_number().over(w)).withColumn("_n", n)
            .filter(F.col("_n") >= min_months)
            .withColumn("split", F.when(F.col("_rn") <= test_months, "test").otherwise("train"))
            .drop("_rn", "_n"))


FORECAST_SCHEMA = T.StructType([
    T.StructField("state", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("predicted", T.LongType()),
    T.StructField("lower", T.LongType()),
    T.StructField("upper", T.LongType()),
    T.StructField("model_used", T.StringType()),
    T.StructField("mape", T.DoubleType()),
    T.StructField("error", T.StringType()),
])

BACKTEST_SCHEMA = T.StructType([
    T.StructField("state", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("mape", T.DoubleType()),
])


def mape(df: DataFrame, actual: str = "y", predicted: str = "yhat", keys=()) -> DataFrame:
    """A14 as a Spark aggregate: mean |(y − ŷ)/y| over rows with y ≠ 0 (D8);
    no usable row → NULL."""
    err = F.abs(F.try_divide(F.col(actual) - F.col(predicted), F.col(actual)))
    return df.groupBy(*keys).agg(F.avg(F.when(F.col(actual) != 0, err)).alias("mape"))


def _mape(actual: np.ndarray, pred) -> float:
    """A14 with D8: months whose actual is 0 are left out; none left → inf."""
    if pred is None:
        return float("inf")
    pred = np.asarray(pred, dtype=float)
    ok = actual != 0
    if not ok.any() or not np.all(np.isfinite(pred)):
        return float("inf")
    return float(np.mean(np.abs((actual[ok] - pred[ok]) / actual[ok])))


def _fit(model: str, y: np.ndarray, ds: pd.Series, steps: int, reg: np.ndarray | None = None):
    """A failed fit of either model is a missing candidate (MAPE = inf), as
    in the reference, never a failed task. ``reg`` covers history + steps."""
    try:
        if model == "ARIMA":
            return tsmodels.arima_forecast(y, steps)
        return tsmodels.additive_forecast(y, ds, steps, regressor=reg)
    except Exception:  # noqa: BLE001
        return None


def _backtest(y: np.ndarray, ds: pd.Series, test: int, reg: np.ndarray | None = None):
    train_y, test_y = y[:-test], y[-test:]
    out = {}
    for model in ("ARIMA", "Additive"):
        f = _fit(model, train_y, ds.iloc[:-test], test, None if reg is None else reg[:len(y)])
        out[model] = _mape(test_y, None if f is None else f[0])
    return out


def _split_regressor(pdf):
    """History rows (y present) and, when a holiday column came along, the
    regressor over history + the future rows (y NULL)."""
    pdf = pdf.sort_values("ds")
    hist = pdf[pdf["_future"] == 0] if "_future" in pdf else pdf
    reg = pdf["holidays"].fillna(0).to_numpy(dtype=float) if "holidays" in pdf else None
    return hist, reg


def _forecast_group(key, pdf):
    state = key[0]
    pdf, reg = _split_regressor(pdf)
    y = pdf["y"].to_numpy(dtype=float)
    ds = pd.to_datetime(pdf["ds"])
    if len(y) < MIN_MONTHS:
        return pd.DataFrame([{"state": state, "month": None, "predicted": None, "lower": None,
                              "upper": None, "model_used": None, "mape": None,
                              "error": "Insufficient data (need at least 12 months)"}])
    if reg is not None and len(reg) < len(y) + HORIZON:
        reg = None  # calendar does not cover the horizon: no regressor
    scores = _backtest(y, ds, TEST_MONTHS, reg)
    # the additive model wins only when strictly better (ties → ARIMA)
    best = "Additive" if scores["Additive"] < scores["ARIMA"] else "ARIMA"
    final = _fit(best, y, ds, HORIZON, reg)
    if final is None:
        return pd.DataFrame([{"state": state, "month": None, "predicted": None, "lower": None,
                              "upper": None, "model_used": None, "mape": None,
                              "error": "Model training failed"}])
    pred, lo, hi = final
    last = ds.iloc[-1]
    months = [(last + pd.DateOffset(months=i + 1)).strftime("%Y-%m") for i in range(HORIZON)]
    mape = scores[best]
    return pd.DataFrame({
        "state": state, "month": months,
        "predicted": np.trunc(pred).astype("int64"), "lower": np.trunc(lo).astype("int64"),
        "upper": np.trunc(hi).astype("int64"), "model_used": best,
        "mape": round(mape * 100, 2) if np.isfinite(mape) else float("inf"),
        "error": None})


def _backtest_group(key, pdf):
    pdf, reg = _split_regressor(pdf)
    y = pdf["y"].to_numpy(dtype=float)
    if len(y) < MIN_MONTHS:
        return pd.DataFrame(columns=["state", "model", "mape"])
    scores = _backtest(y, pd.to_datetime(pdf["ds"]), TEST_MONTHS, reg)
    return pd.DataFrame({"state": key[0], "model": list(scores), "mape": list(scores.values())})


def with_holidays(series: DataFrame, holidays: DataFrame, scope: str = "state",
                  horizon: int = HORIZON) -> DataFrame:
    """Attach a national holiday count per month (``holidays``: ds, holidays)
    and append the ``horizon`` future months of each series (y NULL) so the
    additive model can use the regressor ahead. The calendar is small
    (months) and joined by month."""
    last = series.groupBy(scope).agg(F.max("ds").alias("_last"))
    fut = last.select(scope, F.explode(F.sequence(F.add_months("_last", 1), F.add_months("_last", horizon),
                                                  F.expr("interval 1 month"))).alias("ds"))
    rows = (series.select(scope, "ds", "y", F.lit(0).alias("_future"))
            .unionByName(fut.select(scope, "ds", F.lit(None).cast("double").alias("y"), F.lit(1).alias("_future"))))
    return rows.join(holidays.select("ds", F.col("holidays").cast("double")), "ds", "left")


def forecast(series: DataFrame, scope: str = "state", holidays: DataFrame | None = None) -> DataFrame:
    """Q15–Q18: backtest both models, keep the better, refit, forecast 6 months.

    ``holidays`` (optional calendar: ds month start, holidays count) adds a
    holiday-count regressor to the additive model.
    """
    ship_package(series.sparkSession)
    s = series.select(F.col(scope).alias("state"), "ds", "y")
    if holidays is not None:
        s = with_holidays(s, holidays, "state")
    return s.groupBy("state").applyInPandas(_forecast_group, FORECAST_SCHEMA)


def forecast_backtest(series: DataFrame, scope: str = "state") -> DataFrame:
    """Q17: holdout MAPE of each candidate model per series."""
    ship_package(series.sparkSession)
    s = series.select(F.col(scope).alias("state"), "ds", "y")
    return s.groupBy("state").applyInPandas(_backtest_group, BACKTEST_SCHEMA)


def forecast_nested(fc: DataFrame) -> DataFrame:
    """Result contract of the reference: one row per state with a forecast list."""
    return (fc.filter(F.col("error").isNull())
            .groupBy("state", "model_used", "mape")
            .agg(F.sort_array(F.collect_list(F.struct("month", "predicted", "lower", "upper")))
                 .alias("forecast")))
