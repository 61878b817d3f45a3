"""A day table that follows the facts (Q8/Q13 without reading them all).

The scans and series sum the enrollments to days. This table keeps the sums,
partitioned by month like the fact. When rows arrive, only the months that got
any are summed again, from the fact's partitions of these months, and only
their partitions are replaced. Late rows of an old day change their month like
any other, and a refresh that is repeated gives the same table. Months rather
than days are the unit, so that years of history are some hundred files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicstat.operators.growth import AGE_COLS
from civicstat.sources.sinks import table_exists

KEYS = ("date", "state", "district")


def day_sums(enr: DataFrame) -> DataFrame:
    """Sums of (date, state, district); a row for each pattern of NULL ages, so
    that whatever skips NULLs skips the same as over the rows."""
    patterns = [F.col(c).isNull().alias(f"no_{c}") for c in AGE_COLS]
    return (enr.groupBy(*KEYS, *patterns).agg(*[F.sum(c).alias(c) for c in AGE_COLS])
            .drop(*[f"no_{c}" for c in AGE_COLS]))


def _monthly(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.trunc("date", "MM"))


def append_rows(enr: DataFrame, path: str) -> list:
    """Adds rows to a fact that is partitioned by month; returns the months
    (one value each reaches the driver)."""
    rows = _monthly(enr)
    rows.repartition("month").write.mode("append").partitionBy("month").parquet(path)
    return sorted((r["month"] for r in rows.select("month").distinct().collect()), key=str)


def refresh_days(spark: SparkSession, fact_path: str, path: str, months=None) -> None:
    """Sums the given months of the fact again (all of them if None). The
    filter prunes the fact's partitions, so nothing else is read."""
    fact = spark.read.parquet(fact_path)
    if months is not None:
        fact = fact.where(F.col("month").isin(list(months)))
    (_monthly(day_sums(fact)).repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("month").parquet(path))


def read_days(spark: SparkSession, path: str, newest: int | None = None) -> DataFrame:
    """The table as enrollments; ``newest``: only the last days that it has.
    The newest month is known from the names of the partitions, so only the
    months that can hold these days are read."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], "date date, state string, district string, " + ", ".join(f"{c} long" for c in AGE_COLS))
    days = spark.read.parquet(path)
    if newest is not None:
        for months in (newest // 28 + 2, None):
            near = days
            if months is not None:
                top = days.select("month").distinct().orderBy(F.desc("month")).limit(months).agg(F.min("month")).head()[0]
                near = days.where(F.col("month") >= F.lit(top))
            last = near.select("date").distinct().orderBy(F.desc("date")).limit(newest)
            n, first = last.agg(F.count("*"), F.min("date")).head()
            if n == newest:
                break  # else days are missing: look at all months
        days = near.where(F.col("date") >= F.lit(first))
    return days.select(*KEYS, *AGE_COLS)
