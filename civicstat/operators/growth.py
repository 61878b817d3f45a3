"""Growth rates (MoM/QoQ/YoY), seasonality, privacy gate, daily cumulative.

Scopes: every function takes ``scope`` — the key columns results are
computed for (``()`` national, ``("state",)``, ``("state", "district")``)
— so all districts are handled in one job instead of a loop of queries.
The raw fact is shuffled once (monthly or daily partial+final aggregate);
calendars, roll-ups and windows then run on the small aggregate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicstat.functions.calendar import densify, period_end, period_start
from civicstat.functions.scalar import (date_range_filter, iso_date, optional_filter,
                                        round_half_even, safe_ratio, total)

AGE_COLS = ["age_0_5", "age_5_17", "age_18_greater"]
# (result label, period kind) in output order
PERIOD_LABELS = [("Monthly_MoM", "month"), ("Quarterly_QoQ", "quarter"), ("Yearly_YoY", "year")]
DEFAULT_MIN_COUNT = 100


def scoped_input(enr: DataFrame, state=None, district=None, start=None, end=None) -> DataFrame:
    """Optional equality and date-range filters (pushed to the scan)."""
    return date_range_filter(optional_filter(enr, state=state, district=district), start, end)


def scope_totals(enr: DataFrame, scope=()) -> DataFrame:
    """A13 per scope: Σ of the three age columns (NULLs skipped per column)."""
    return enr.groupBy(*scope).agg(
        reduce(lambda a, b: a + b, [F.coalesce(F.sum(c), F.lit(0)) for c in AGE_COLS]).alias("total"))


def privacy_gate(enr: DataFrame, scope=(), min_count: int = DEFAULT_MIN_COUNT) -> DataFrame:
    """A scope is reported only when its total reaches ``min_count``."""
    t = scope_totals(enr, scope)
    return t.withColumn("status", F.when(F.col("total") >= min_count, "compliant").otherwise("suppressed"))


# Fixed texts of suppressed scopes.
SUPPRESSED = "Insufficient data for analysis (DPDP Suppression)"
SUPPRESSED_SEASONS = "Insufficient data (DPDP)"


def with_suppressed(rows: DataFrame, enr: DataFrame, scope, min_count: int = DEFAULT_MIN_COUNT, text: str = SUPPRESSED) -> DataFrame:
    """Rows of an operator with one more for every scope that its privacy gate
    leaves out: no figures, the reason in ``error`` (NULL on the others)."""
    gone = privacy_gate(enr, scope, min_count).where("status = 'suppressed'").select(*scope, F.lit(text).alias("error"))
    return rows.withColumn("error", F.lit(None).cast("string")).unionByName(gone, allowMissingColumns=True)


def _compliant(agg: DataFrame, scope, min_count: int) -> DataFrame:
    """Keep scopes of an aggregate whose grand total reaches min_count."""
    if not min_count:
        return agg
    tot = reduce(lambda a, b: a + b, [F.col(c) for c in AGE_COLS])
    w = Window.partitionBy(*scope) if scope else Window.partitionBy()
    return (agg.withColumn("_scope_total", F.sum(tot).over(w))
            .filter(F.col("_scope_total") >= min_count).drop("_scope_total"))


def monthly_age_sums(enr: DataFrame, scope=()) -> DataFrame:
    """Raw rows → (scope, month start) sums; the one shuffle of the fact."""
    return enr.groupBy(*scope, period_start(F.col("date"), "month").alias("pstart")).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in AGE_COLS])


def _all_periods(monthly: DataFrame, scope, kinds) -> DataFrame:
    """A1 for every period kind in one pass.

    The monthly sums are zero-filled once (``densify``), then each month row
    is fanned out to the periods it belongs to and summed. Quarter and year
    bins of a gap-free month calendar are exactly the zero-filled quarter
    and year calendars, so no further densification is needed.
    """
    dense = densify(monthly, list(scope), "pstart", "1 month", fill={c: 0 for c in AGE_COLS})
    tags = F.array(*[F.struct(F.lit(label).alias("period"), F.lit(kind).alias("kind"),
                              period_start(F.col("pstart"), kind).alias("p"),
                              period_end(period_start(F.col("pstart"), kind), kind).alias("pend"))
                     for label, kind in kinds])
    fanned = dense.select(*scope, *AGE_COLS, F.explode(tags).alias("_t"))
    return fanned.groupBy(*scope, F.col("_t.period").alias("period"), F.col("_t.pend").alias("pend")) \
        .agg(*[F.sum(c).alias(c) for c in AGE_COLS])


def _growth_rows(monthly: DataFrame, scope, kinds) -> DataFrame:
    allp = _all_periods(monthly, scope, kinds)
    long = allp.unpivot([*scope, "period", "pend"], AGE_COLS, "age_group", "value")
    w = Window.partitionBy(*scope, "period", "age_group").orderBy("pend")
    out = (long.withColumn("prev", F.lag("value", 1).over(w))
           .withColumn("pct", safe_ratio(F.col("value") - F.col("prev"), F.col("prev")) * 100)
           .filter(F.col("pct").isNotNull()))
    return out.select(
        *scope, "period", iso_date("pend").alias("date"), "age_group",
        round_half_even("pct").cast("long").alias("growth_rate_pct"),
        (F.col("value") - F.col("prev")).cast("long").alias("absolute_change"))


def _kinds(periods):
    return [(lab, k) for lab, k in PERIOD_LABELS if periods is None or lab in periods or k in periods]


def growth_rates(enr: DataFrame, scope=(), state=None, district=None, start=None, end=None,
                 min_count: int = DEFAULT_MIN_COUNT, periods=None) -> DataFrame:
    """Q2: period % change and difference per age group.

    Output: *scope, period, date (period end), age_group, growth_rate_pct,
    absolute_change. The first period, 0→0 changes and x→0 changes
    (infinite growth; deviation D1, only that row is dropped) have no row.
    """
    scope = list(scope)
    enr = scoped_input(enr, state, district, start, end)
    monthly = _compliant(monthly_age_sums(enr, scope), scope, min_count)
    return _growth_rows(monthly, scope, _kinds(periods))


def growth_rollup(enr: DataFrame, min_count: int = DEFAULT_MIN_COUNT, periods=None) -> DataFrame:
    """Growth for national, every state and every district in one plan.

    One ``GROUPING SETS`` aggregate reads the fact once for all three
    levels; the rolled-up keys are labelled ``*``.
    """
    src = enr.withColumn("pstart", period_start(F.col("date"), "month"))
    sets = [[F.col("state"), F.col("district"), F.col("pstart")],
            [F.col("state"), F.col("pstart")], [F.col("pstart")]]
    agg = (src.groupingSets(sets, "state", "district", "pstart")
           .agg(F.grouping_id().alias("_gid"),
                *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in AGE_COLS]))
    level = (F.when(F.col("_gid") == 0, "district").when(F.col("_gid") == 2, "state")
             .otherwise("national"))
    monthly = agg.select(level.alias("level"),
                         F.coalesce("state", F.lit("*")).alias("state"),
                         F.coalesce("district", F.lit("*")).alias("district"),
                         "pstart", *AGE_COLS)
    scope = ["level", "state", "district"]
    return _growth_rows(_compliant(monthly, scope, min_count), scope, _kinds(periods))


def seasonality(enr: DataFrame, scope=("state",), state=None,
                min_count: int = DEFAULT_MIN_COUNT) -> DataFrame:
    """Q3: mean row total per calendar month / overall mean row total, 2 decimals.

    Means are over raw rows (A3/A4). A scope whose overall mean is 0 has no
    rows; months without data are absent.
    """
    scope = list(scope)
    enr = optional_filter(enr, state=state)
    t = enr.select(*scope, "date", *AGE_COLS, total(*AGE_COLS).alias("total"))
    by_month = t.groupBy(*scope, F.month("date").alias("month")).agg(
        F.sum("total").alias("_s"), F.count("total").alias("_n"),
        *[F.sum(c).alias(c) for c in AGE_COLS])
    w = Window.partitionBy(*scope) if scope else Window.partitionBy()
    overall = F.sum("_s").over(w) / F.sum("_n").over(w)
    gate = reduce(lambda a, b: a + b, [F.coalesce(F.sum(c).over(w), F.lit(0)) for c in AGE_COLS])
    out = (by_month.withColumn("_overall", overall).withColumn("_gate", gate)
           .filter((F.col("_gate") >= min_count) & (F.col("_overall") != 0) & (F.col("_n") > 0)))
    return out.select(*scope, "month",
                      round_half_even((F.col("_s") / F.col("_n")) / F.col("_overall"), 2)
                      .alias("seasonal_index"))


def daily_cumulative(enr: DataFrame, scope=("state", "district"), state=None,
                     district=None) -> DataFrame:
    """A2 + W3: zero-filled daily totals over each scope's date range and running sum."""
    scope = list(scope)
    enr = optional_filter(enr, state=state, district=district)
    daily = enr.groupBy(*scope, "date").agg(
        F.coalesce(F.sum(total(*AGE_COLS)), F.lit(0)).cast("long").alias("daily_total"))
    dense = densify(daily, scope, "date", "1 day", fill={"daily_total": 0})
    w = (Window.partitionBy(*scope) if scope else Window.partitionBy()).orderBy("date") \
        .rowsBetween(Window.unboundedPreceding, 0)
    return dense.withColumn("cumulative_total", F.sum("daily_total").over(w))
