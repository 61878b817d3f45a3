"""Saturation estimate: logistic fit of cumulative daily totals (Q4).

The daily zero-filled cumulative series comes from Spark windows
(``growth.daily_cumulative``); only the curve fit runs in Python, one
``applyInPandas`` group per scope, each bounded by the number of days.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicstat.functions.calendar import densify
from civicstat.functions.scalar import optional_filter, total
from civicstat.operators import growth, tsmodels
from civicstat.session import ship_package

# t90 = t0 − ln(1/0.9 − 1)/k; remaining days → months of 30 days
TARGET_SHARE = 0.9
DAYS_PER_MONTH = 30

SCHEMA = T.StructType([
    T.StructField("state", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("current_penetration", T.LongType()),
    T.StructField("months_to_90_percent", T.LongType()),
    T.StructField("estimated_saturation_count", T.LongType()),
    T.StructField("error", T.StringType()),
])


def estimate(y: np.ndarray) -> dict:
    """Fit and derive the three figures; failures give an error text."""
    try:
        L, k, t0 = tsmodels.logistic_fit(y)
        if not (k > 0 and math.isfinite(L) and L > 0):
            raise ValueError("growth rate is 0: pattern looks linear")
        penetration = y[-1] / L * 100
        t90 = t0 - math.log(1 / TARGET_SHARE - 1) / k
        months = max(0, int((t90 - len(y)) / DAYS_PER_MONTH))
        return {"current_penetration": int(round(penetration)), "months_to_90_percent": months,
                "estimated_saturation_count": int(L), "error": None}
    except (ValueError, FloatingPointError, np.linalg.LinAlgError, OverflowError) as e:
        return {"current_penetration": None, "months_to_90_percent": None,
                "estimated_saturation_count": None,
                "error": f"Cannot estimate saturation (Pattern may be linear or insufficient): {e}"}


def _fit_group(key, pdf):
    y = pdf.sort_values("date")["cumulative_total"].to_numpy(dtype=float)
    return pd.DataFrame([{"state": key[0], "district": key[1], **estimate(y)}])


def saturation(enr: DataFrame, state=None, district=None,
               min_count: int = growth.DEFAULT_MIN_COUNT) -> DataFrame:
    """Q4 for every district (or the one asked for).

    One aggregate of the fact gives both the daily totals and the privacy
    gate (P14, Σ of the age columns per district, as a window over the
    daily rows; a district below it gets a row with an error text and no
    figures); then zero-fill, running sum and one fit per district.
    """
    keys = ["state", "district"]
    enr = optional_filter(enr, state=state, district=district)
    daily = enr.groupBy(*keys, "date").agg(
        F.coalesce(F.sum(total(*growth.AGE_COLS)), F.lit(0)).cast("long").alias("daily_total"),
        reduce(lambda a, b: a + b, [F.coalesce(F.sum(c), F.lit(0)) for c in growth.AGE_COLS]).alias("_gate"))
    daily = daily.withColumn("_gate", F.sum("_gate").over(Window.partitionBy(*keys)))
    hidden = (daily.filter(F.col("_gate") < min_count).select(*keys).distinct()
              .withColumn("error", F.lit(f"suppressed: fewer than {min_count} enrollments")))
    daily = daily.filter(F.col("_gate") >= min_count).drop("_gate")
    dense = densify(daily, keys, "date", "1 day", fill={"daily_total": 0})
    run = Window.partitionBy(*keys).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    cum = dense.withColumn("cumulative_total", F.sum("daily_total").over(run))
    ship_package(enr.sparkSession)
    return cum.groupBy(*keys).applyInPandas(_fit_group, SCHEMA).unionByName(hidden, allowMissingColumns=True)
