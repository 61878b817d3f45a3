"""Figures of the raw joins J1 and J2, without a row for any pair.

The key (date, state, district) is not unique in the facts. Joining raw rows
pairs every enrollment with every attempt of its key, and each pair counts.
Nothing of that needs the pairs themselves: a sum over pairs is a sum over one
side times the number of rows of the other, and a figure of a pair depends on
its two values only, so pairs of equal values are one row with a count. Both
sides are brought to (key, value, count) before they are joined, which
collapses a hot key in the tasks. Counts and weighted sums are decimals of 38
digits, since the number of pairs of a key grows with its square.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicstat.functions.scalar import optional_filter, round_half_even, safe_ratio
from civicstat.schemas import KEYS

WIDE = "decimal(38,0)"
# (rate, attempts, enrollments) of the age groups
GROUPS = (("success_rate_5_17", "bio_age_5_17", "age_5_17"), ("success_rate_17_plus", "bio_age_17_", "age_18_greater"))


def _known(df: DataFrame) -> DataFrame:
    return df.where(" AND ".join(f"{k} IS NOT NULL" for k in KEYS))


def _counted(df: DataFrame, value: str) -> DataFrame:
    return _known(df).groupBy(*KEYS, F.col(value).alias(value)).agg(F.count("*").alias(f"n_{value}"))


def pair_rates(enr: DataFrame, bio: DataFrame, state=None, district=None) -> DataFrame:
    """Q5 over raw pairs: state, district, date, rate (its name), value and
    pairs, one row for each two different values of a day. A NULL or zero
    enrollment figure gives the rate 0, and so does a NULL attempt figure."""
    enr = optional_filter(enr, state=state, district=district)
    bio = optional_filter(bio, state=state, district=district)
    out = None
    for rate, attempts, enrolled in GROUPS:
        both = _counted(enr, enrolled).join(_counted(bio, attempts), KEYS)
        value = round_half_even(F.coalesce(safe_ratio(attempts, enrolled) * 100, F.lit(0.0)), 1)
        part = both.select("state", "district", "date", F.lit(rate).alias("rate"), value.alias("value"),
                           (F.col(f"n_{enrolled}").cast(WIDE) * F.col(f"n_{attempts}")).cast(WIDE).alias("pairs"))
        out = part if out is None else out.unionByName(part)
    return out


def district_means(rates: DataFrame) -> DataFrame:
    """A7 over raw pairs: the mean rate of each age group and their mean."""
    weighted = F.sum((F.col("value") * 10).cast(WIDE) * F.col("pairs").cast("decimal(20,0)"))
    per = rates.groupBy("state", "district", "rate").agg((weighted.cast("double") / 10 / F.sum("pairs").cast("double")).alias("mean"))

    def of(rate: str) -> Column:
        return F.max(F.when(F.col("rate") == rate, F.col("mean"))).alias(rate)

    g = per.groupBy("state", "district").agg(*[of(rate) for rate, _, _ in GROUPS])
    return g.withColumn("avg_rate", (F.col(GROUPS[0][0]) + F.col(GROUPS[1][0])) / 2)


def low_performers(enr: DataFrame, bio: DataFrame, threshold: float = 60.0, state=None) -> DataFrame:
    """Q6 over raw pairs, most urgent first."""
    d = district_means(pair_rates(enr, bio, state)).where(F.col("avg_rate") < float(threshold))
    gap = F.lit(float(threshold)) - F.col("avg_rate")
    return (d.select("state", "district", F.col("avg_rate").alias("success_rate"), gap.alias("gap"), (gap * 10).alias("priority_score"))
            .orderBy(F.desc("priority_score")))


def training_set(enr: DataFrame, bio: DataFrame, demo: DataFrame) -> DataFrame:
    """Q19 over raw triples: every enrollment row counts once for each attempt
    and each update of its day (once if there is none), and so on round."""
    def side(df: DataFrame, value: Column, name: str) -> DataFrame:
        return df.groupBy(*KEYS).agg(F.sum(value).cast(WIDE).alias(name), F.count("*").cast("decimal(18,0)").alias(f"n_{name}"))

    e = side(enr, F.col("age_5_17") + F.col("age_18_greater"), "e")
    b = side(_known(bio), F.col("bio_age_5_17") + F.col("bio_age_17_"), "b")
    d = side(_known(demo), F.col("demo_age_5_17") + F.col("demo_age_17_"), "d")
    j = e.join(b, KEYS, "left").join(d, KEYS, "left")
    n = {c: F.coalesce(f"n_{c}", F.lit(1).cast("decimal(18,0)")) for c in "ebd"}

    def times(value: str, *others: str) -> Column:
        out = F.col(value)
        for o in others:
            out = (out * n[o]).cast(WIDE)
        return F.sum(out).cast(WIDE)

    return j.groupBy(F.trunc("date", "MM").alias("month"), "state", "district").agg(
        times("e", "b", "d").alias("enrollments"), times("b", "e", "d").alias("biometric_attempts"),
        times("d", "e", "b").alias("demo_updates"))
