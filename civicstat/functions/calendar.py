"""Calendar helpers: period starts/labels and per-scope densification.

Calendars are generated with ``sequence`` + ``explode`` over aggregates
(scopes × periods), so they never depend on the size of the fact table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# months per period kind
PERIOD_MONTHS = {"month": 1, "quarter": 3, "year": 12}
TRUNC_UNIT = {"month": "MM", "quarter": "QUARTER", "year": "YEAR"}


def period_start(c: Column, kind: str) -> Column:
    return F.trunc(c, TRUNC_UNIT[kind])


def period_end(start: Column, kind: str) -> Column:
    """Label of a period: its last day (pandas 'M'/'Q'/'A' bins)."""
    return F.date_sub(F.add_months(start, PERIOD_MONTHS[kind]), 1)


def densify(agg: DataFrame, keys: list[str], time_col: str, step: str,
            fill: dict | None = None) -> DataFrame:
    """Fill the missing steps between each scope's first and last ``time_col``.

    One window pass, no self-join: every row is expanded to the steps up to
    (not including) the next present row of its scope, so the aggregate is
    read once. Generated rows get NULL measures, or the values in ``fill``.
    A scope partition holds one row per present period, never raw facts.
    """
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(time_col)
    nxt = F.lead(time_col).over(w)
    span = F.when(F.col("_next").isNull(), F.array(F.col(time_col))).otherwise(
        F.expr(f"sequence({time_col}, _next - interval {step}, interval {step})"))
    measures = [c for c in agg.columns if c not in (*keys, time_col)]
    x = (agg.withColumn("_next", nxt)
         .select(*keys, *measures, F.posexplode(span.alias("_span")).alias("_pos", "_t")))
    gen = F.col("_pos") > 0
    cols = []
    for m in measures:
        dflt = F.lit((fill or {}).get(m)) if fill and m in fill else F.lit(None)
        cols.append(F.when(gen, dflt.cast(agg.schema[m].dataType)).otherwise(F.col(m)).alias(m))
    return x.select(*keys, F.col("_t").alias(time_col), *cols)
