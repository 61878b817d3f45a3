"""Success rates, low performers and repeat attempts (enrollments ⋈ biometric).

Join semantics. The key (date, state, district) is not unique in either
fact, so joining raw rows multiplies every enrollment row with every
attempt row of the same key. That blows up quadratically on a hot key and
inflates every sum. Both facts are therefore first summed to the key
grain (map-side partial aggregation collapses hot keys before the
shuffle) and joined 1:1. Rates are ratios of these daily sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicstat.functions.scalar import (iso_date, optional_filter, pct_ratio,
                                        round_half_even, safe_ratio)
from civicstat.schemas import KEYS


def daily_sums(df: DataFrame, *measures: str) -> DataFrame:
    """Sum each measure to (date, state, district)."""
    return df.groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in measures])


def joined_daily(enr: DataFrame, bio: DataFrame, state=None, district=None) -> DataFrame:
    """J1 at key grain: one row per (date, state, district) present in both."""
    enr = optional_filter(enr, state=state, district=district)
    bio = optional_filter(bio, state=state, district=district)
    e = daily_sums(enr, "age_5_17", "age_18_greater")
    b = daily_sums(bio, "bio_age_5_17", "bio_age_17_")
    return e.join(b, on=KEYS, how="inner")


def joined_from_days(days: DataFrame, state=None, district=None) -> DataFrame:
    """J1 from a day table that already has both facts side by side
    (``sources.tables.daily_totals``): no join, days without an attempt go."""
    days = optional_filter(days, state=state, district=district)
    sums = [F.sum(c).alias(c) for c in ("age_5_17", "age_18_greater", "bio_age_5_17", "bio_age_17_", "attended")]
    return days.groupBy(*KEYS).agg(*sums).where("attended > 0").drop("attended")


def success_rates(enr: DataFrame, bio: DataFrame, state=None, district=None) -> DataFrame:
    """Q5: attempts / enrollments × 100 per group, zero enrollments → 0, 1 decimal."""
    return daily_rates(joined_daily(enr, bio, state, district))


def daily_rates(j: DataFrame) -> DataFrame:
    """The rates of joined days."""

    def rate(num, den):
        # zero → NULL before dividing, NULL result → 0
        return round_half_even(F.coalesce(safe_ratio(num, den) * 100, F.lit(0.0)), 1)

    return j.select(
        "state", "district", iso_date("date").alias("date"),
        rate("bio_age_5_17", "age_5_17").alias("success_rate_5_17"),
        rate("bio_age_17_", "age_18_greater").alias("success_rate_17_plus"),
    )


def district_rates(rates: DataFrame) -> DataFrame:
    """Mean of the daily rates per district and their average."""
    g = rates.groupBy("state", "district").agg(
        F.avg("success_rate_5_17").alias("success_rate_5_17"),
        F.avg("success_rate_17_plus").alias("success_rate_17_plus"))
    return g.withColumn("avg_rate", (F.col("success_rate_5_17") + F.col("success_rate_17_plus")) / 2)


def low_performers(rates: DataFrame, threshold: float = 60.0, state=None) -> DataFrame:
    """Q6: districts with avg_rate < threshold, most urgent first."""
    rates = optional_filter(rates, state=state)
    d = district_rates(rates).filter(F.col("avg_rate") < F.lit(float(threshold)))
    gap = F.lit(float(threshold)) - F.col("avg_rate")
    return (d.select("state", "district",
                     F.col("avg_rate").alias("success_rate"),
                     gap.alias("gap"),
                     (gap * 10).alias("priority_score"))
            .orderBy(F.desc("priority_score")))


def repeat_attempts(enr: DataFrame, bio: DataFrame, min_rate: float = 2.0) -> DataFrame:
    """Q7: attempts / enrollments > 2 per group; zero enrollments → 0."""
    return daily_repeats(joined_daily(enr, bio), min_rate)


def daily_repeats(j: DataFrame, min_rate: float = 2.0) -> DataFrame:
    attempts = F.col("bio_age_5_17") + F.col("bio_age_17_")
    enrolled = F.col("age_5_17") + F.col("age_18_greater")
    rr = pct_ratio(attempts, enrolled, scale=1.0)
    return (j.select("state", "district", "date", rr.alias("repeat_rate"))
            .filter(F.col("repeat_rate") > F.lit(min_rate))
            .select("state", "district", iso_date("date").alias("date"),
                    round_half_even("repeat_rate", 2).alias("repeat_rate")))
