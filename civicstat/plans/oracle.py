"""DuckDB SQL equivalents of the registered queries (correctness oracle).

The driver registers every driver table as a view; the fact roles are
rebuilt here as CTEs with the same mapping as ``sources/tables.py``.
Doubles are rounded the same way on both sides (ties to even on the
scaled value) so value hashes compare exactly.
"""

from __future__ import annotations

from civicstat.operators import cases

ROLES = """
geo AS (
  SELECT n.n_nationkey AS nationkey, r.r_name AS state, n.n_name AS district
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
enrollments AS (
  SELECT CAST(o.o_orderdate AS DATE) AS date, g.state, g.district,
         CAST(100000 + c.c_custkey AS VARCHAR) AS pincode,
         CAST(floor(o.o_totalprice / 10000) AS INTEGER) AS age_0_5,
         CAST(o.o_custkey % 50 AS INTEGER) AS age_5_17,
         CAST(o.o_orderkey % 100 AS INTEGER) AS age_18_greater
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN geo g ON c.c_nationkey = g.nationkey),
biometric AS (
  SELECT CAST(o.o_orderdate AS DATE) AS date, g.state, g.district,
         CAST(100000 + c.c_custkey AS VARCHAR) AS pincode,
         CAST(trunc(l.l_quantity) AS INTEGER) AS bio_age_5_17,
         CAST(l.l_linenumber * 5 AS INTEGER) AS bio_age_17_
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN geo g ON c.c_nationkey = g.nationkey),
demographic AS (
  SELECT CAST(l.l_shipdate AS DATE) AS date, g.state, g.district,
         CAST(100000 + s.s_suppkey AS VARCHAR) AS pincode,
         CAST(trunc(l.l_quantity) AS INTEGER) AS demo_age_5_17,
         CAST(l.l_linenumber AS INTEGER) AS demo_age_17_
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN geo g ON s.s_nationkey = g.nationkey)
"""


def r6(x: str) -> str:
    """Round a double to 6 decimals, ties to even (matches ``stable``)."""
    return f"(round_even(({x}) * 1e6, 0) / 1e6)"


def with_roles(body: str, extra_ctes: str = "") -> str:
    ctes = ROLES + ("," + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{body}"


JOINED_DAILY = """
e_day AS (SELECT date, state, district,
                 SUM(age_5_17) AS age_5_17, SUM(age_18_greater) AS age_18_greater
          FROM enrollments GROUP BY 1, 2, 3),
b_day AS (SELECT date, state, district,
                 SUM(bio_age_5_17) AS bio_age_5_17, SUM(bio_age_17_) AS bio_age_17_
          FROM biometric GROUP BY 1, 2, 3),
joined AS (SELECT e.*, b.bio_age_5_17, b.bio_age_17_
           FROM e_day e JOIN b_day b USING (date, state, district)),
rates AS (
  SELECT state, district, strftime(date, '%Y-%m-%d') AS date,
    round_even(coalesce(bio_age_5_17 / nullif(age_5_17, 0) * 100, 0.0) * 10, 0) / 10 AS success_rate_5_17,
    round_even(coalesce(bio_age_17_ / nullif(age_18_greater, 0) * 100, 0.0) * 10, 0) / 10 AS success_rate_17_plus
  FROM joined)
"""

def _quoted(text: str) -> str:
    """Inside an ``e''`` string."""
    return text.replace("\\", "\\\\").replace("'", "''").replace("\n", "\\n")


SQL: dict[str, str] = {}

SQL["success_rates"] = with_roles(
    "SELECT state, district, date, success_rate_5_17, success_rate_17_plus FROM rates",
    JOINED_DAILY)

SQL["low_performers"] = with_roles(f"""
SELECT state, district, {r6('avg_rate')} AS success_rate,
       {r6('600.0 - avg_rate')} AS gap, {r6('(600.0 - avg_rate) * 10')} AS priority_score
FROM (SELECT state, district,
             (AVG(success_rate_5_17) + AVG(success_rate_17_plus)) / 2 AS avg_rate
      FROM rates GROUP BY 1, 2) d
WHERE avg_rate < 600.0
ORDER BY priority_score DESC""", JOINED_DAILY)

SQL["repeat_attempts"] = with_roles("""
SELECT state, district, strftime(date, '%Y-%m-%d') AS date,
       round_even(rr * 100, 0) / 100 AS repeat_rate
FROM (SELECT *, CASE WHEN age_5_17 + age_18_greater > 0
                     THEN (bio_age_5_17 + bio_age_17_) / (age_5_17 + age_18_greater)
                     ELSE 0.0 END AS rr FROM joined) t
WHERE rr > 2.0""", JOINED_DAILY)

SQL["enrollments_base"] = with_roles(
    "SELECT *, age_0_5 + age_5_17 + age_18_greater AS total FROM enrollments")

# ---------------------------------------------------------------- growth
PERIOD_SQL = {"month": (1, "Monthly_MoM"), "quarter": (3, "Quarterly_QoQ"), "year": (12, "Yearly_YoY")}
AGE_SUMS = ("CAST(coalesce(SUM(age_0_5), 0) AS BIGINT) AS age_0_5, "
            "CAST(coalesce(SUM(age_5_17), 0) AS BIGINT) AS age_5_17, "
            "CAST(coalesce(SUM(age_18_greater), 0) AS BIGINT) AS age_18_greater")


def growth_sql(kinds, scope=(), monthly_cte=None, min_count=100) -> str:
    """Growth rows for the given period kinds; ``scope`` are key columns."""
    keys = ", ".join(scope)
    kc = keys + ", " if scope else ""
    part = f"PARTITION BY {keys}" if scope else ""
    on = " AND ".join(f"c.{k} = p.{k}" for k in scope)
    on = (on + " AND ") if on else ""
    ctes = []
    if monthly_cte is None:
        ctes.append(f"m0 AS (SELECT {kc}CAST(date_trunc('month', date) AS DATE) AS pstart, {AGE_SUMS} "
                    f"FROM enrollments GROUP BY ALL)")
    else:
        ctes.append(monthly_cte)
    ctes.append(f"m AS (SELECT * EXCLUDE (_t) FROM (SELECT *, SUM(age_0_5 + age_5_17 + age_18_greater) "
                f"OVER ({part}) AS _t FROM m0) WHERE _t >= {min_count or 0})")
    selects = []
    for kind in kinds:
        n, label = PERIOD_SQL[kind]
        src = "m" if kind == "month" else f"k_{kind}"
        if kind != "month":
            ctes.append(f"k_{kind} AS (SELECT {kc}CAST(date_trunc('{kind}', pstart) AS DATE) AS pstart, "
                        f"SUM(age_0_5) AS age_0_5, SUM(age_5_17) AS age_5_17, "
                        f"SUM(age_18_greater) AS age_18_greater FROM m GROUP BY ALL)")
        ctes.append(f"b_{kind} AS (SELECT {kc}min(pstart) AS lo, max(pstart) AS hi FROM {src} GROUP BY ALL)")
        ctes.append(f"c_{kind} AS (SELECT {kc}CAST(unnest(generate_series(lo, hi, INTERVAL {n} MONTH)) AS DATE) "
                    f"AS pstart FROM b_{kind})")
        pk = ", ".join(f"c.{k}" for k in scope)
        pk = pk + ", " if scope else ""
        ctes.append(f"d_{kind} AS (SELECT {pk}c.pstart, coalesce(p.age_0_5, 0) AS age_0_5, "
                    f"coalesce(p.age_5_17, 0) AS age_5_17, coalesce(p.age_18_greater, 0) AS age_18_greater "
                    f"FROM c_{kind} c LEFT JOIN {src} p ON {on}c.pstart = p.pstart)")
        selects.append(f"SELECT {kc}'{label}' AS period, pstart + INTERVAL {n} MONTH - INTERVAL 1 DAY AS pend, "
                       f"age_0_5, age_5_17, age_18_greater FROM d_{kind}")
    ctes.append("u AS (" + " UNION ALL ".join(selects) + ")")
    ctes.append("l AS (UNPIVOT u ON age_0_5, age_5_17, age_18_greater INTO NAME age_group VALUE value)")
    wpart = ", ".join([*scope, "period", "age_group"])
    ctes.append(f"w AS (SELECT *, lag(value) OVER (PARTITION BY {wpart} ORDER BY pend) AS prev FROM l)")
    body = (f"SELECT {kc}period, strftime(pend, '%Y-%m-%d') AS date, age_group, "
            f"CAST(round_even((value - prev) / prev * 100, 0) AS BIGINT) AS growth_rate_pct, "
            f"CAST(value - prev AS BIGINT) AS absolute_change FROM w WHERE prev IS NOT NULL AND prev <> 0")
    return with_roles(body, ",\n".join(ctes))


SQL["growth_monthly"] = growth_sql(["month"])
SQL["growth_quarterly"] = growth_sql(["quarter"])
SQL["growth_yearly"] = growth_sql(["year"])
SQL["growth_by_scope_rollup"] = growth_sql(
    ["month", "quarter", "year"], scope=("level", "state", "district"),
    monthly_cte=(
        "m0 AS (SELECT CASE grouping(state, district) WHEN 0 THEN 'district' WHEN 1 THEN 'state' "
        "ELSE 'national' END AS level, coalesce(state, '*') AS state, coalesce(district, '*') AS district, "
        f"pstart, {AGE_SUMS} FROM (SELECT *, CAST(date_trunc('month', date) AS DATE) AS pstart "
        "FROM enrollments) GROUP BY GROUPING SETS ((state, district, pstart), (state, pstart), (pstart)))"))

SQL["seasonality"] = with_roles("""
SELECT state, month, round_even((s / n) / overall * 100, 0) / 100 AS seasonal_index
FROM (SELECT *, SUM(s) OVER (PARTITION BY state) / SUM(n) OVER (PARTITION BY state) AS overall,
             coalesce(SUM(a) OVER (PARTITION BY state), 0) + coalesce(SUM(b) OVER (PARTITION BY state), 0)
             + coalesce(SUM(c) OVER (PARTITION BY state), 0) AS gate
      FROM (SELECT state, CAST(month(date) AS INTEGER) AS month,
                   SUM(age_0_5 + age_5_17 + age_18_greater) AS s,
                   COUNT(age_0_5 + age_5_17 + age_18_greater) AS n,
                   SUM(age_0_5) AS a, SUM(age_5_17) AS b, SUM(age_18_greater) AS c
            FROM enrollments GROUP BY 1, 2) bm) x
WHERE gate >= 100 AND overall <> 0 AND n > 0""")

SQL["privacy_gate"] = with_roles("""
SELECT state, district, CAST(total AS BIGINT) AS total,
       CASE WHEN total >= 500 THEN 'compliant' ELSE 'suppressed' END AS status
FROM (SELECT state, district, coalesce(SUM(age_0_5), 0) + coalesce(SUM(age_5_17), 0)
             + coalesce(SUM(age_18_greater), 0) AS total FROM enrollments GROUP BY 1, 2) t""")

SQL["daily_cumulative"] = with_roles("""
SELECT c.state, c.district, c.date, coalesce(d.daily_total, 0) AS daily_total,
       CAST(SUM(coalesce(d.daily_total, 0)) OVER (PARTITION BY c.state, c.district ORDER BY c.date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_total
FROM (SELECT state, district, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
      FROM (SELECT state, district, min(date) AS lo, max(date) AS hi FROM enrollments GROUP BY 1, 2) b) c
LEFT JOIN (SELECT state, district, date,
                  CAST(coalesce(SUM(age_0_5 + age_5_17 + age_18_greater), 0) AS BIGINT) AS daily_total
           FROM enrollments GROUP BY 1, 2, 3) d USING (state, district, date)""")

# ---------------------------------------------------------------- anomalies
ANOMALY = """
daily AS (SELECT state, district, date,
                 CAST(SUM(age_0_5 + age_5_17 + age_18_greater) AS DOUBLE) AS daily_enrollments
          FROM enrollments GROUP BY 1, 2, 3),
series AS (SELECT state, district, date, daily_enrollments FROM (
             SELECT *, row_number() OVER (PARTITION BY state, district ORDER BY date DESC) AS rn FROM daily)
           WHERE rn <= 150),
st AS (SELECT *, count(*) OVER p AS n, avg(daily_enrollments) OVER p AS mu,
              stddev_pop(daily_enrollments) OVER p AS sd,
              quantile_cont(daily_enrollments, 0.25) OVER p AS q1,
              quantile_cont(daily_enrollments, 0.75) OVER p AS q3,
              avg(daily_enrollments) OVER (PARTITION BY state, district ORDER BY date
                                           ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS rolling_mean,
              row_number() OVER (PARTITION BY state, district ORDER BY date) AS pos
       FROM series WINDOW p AS (PARTITION BY state, district)),
det AS (SELECT *, abs(daily_enrollments - mu) / nullif(sd, 0) AS z_score,
               q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound,
               abs((daily_enrollments - rolling_mean) / nullif(rolling_mean, 0)) AS deviation_pct
        FROM st),
flags AS (SELECT *, coalesce(n >= 3 AND z_score > 3.0, false) AS is_z,
                 coalesce(n >= 5 AND (daily_enrollments < lower_bound OR daily_enrollments > upper_bound), false) AS is_iqr,
                 coalesce(n >= 30 AND pos > 30 AND deviation_pct > 0.5, false) AS is_roll
          FROM det)
"""

SQL["anomaly_series"] = with_roles("SELECT * FROM series", ANOMALY)

SQL["anomaly_zscore"] = with_roles(f"""
SELECT state, district, date, daily_enrollments AS value, {r6('z_score')} AS z_score, 'z_score' AS method
FROM flags WHERE is_z""", ANOMALY)

SQL["anomaly_iqr"] = with_roles(f"""
SELECT state, district, date, daily_enrollments AS value, {r6('lower_bound')} AS lower_bound,
       {r6('upper_bound')} AS upper_bound, 'iqr' AS method
FROM flags WHERE is_iqr""", ANOMALY)

SQL["anomaly_rolling"] = with_roles(f"""
SELECT state, district, date, daily_enrollments AS value, {r6('rolling_mean')} AS rolling_mean,
       {r6('deviation_pct')} AS deviation_pct, 'rolling_deviation' AS method
FROM flags WHERE is_roll""", ANOMALY)

ANOMALY_REPORT = ANOMALY + """,
report AS (
  SELECT date, state, district, 'daily_enrollments' AS metric_name, daily_enrollments AS anomaly_value,
         round_even(CASE WHEN is_z THEN least(10.0, z_score) ELSE 5.0 END * 100, 0) / 100 AS severity_score,
         CASE WHEN (CASE WHEN is_roll THEN daily_enrollments < rolling_mean ELSE daily_enrollments < mu END)
              THEN 'drop' ELSE 'spike' END AS anomaly_type,
         concat_ws(',', CASE WHEN is_z THEN 'z_score' END, CASE WHEN is_iqr THEN 'iqr' END,
                   CASE WHEN is_roll THEN 'rolling_deviation' END) AS detection_methods
  FROM flags WHERE CAST(is_z AS INTEGER) + CAST(is_iqr AS INTEGER) + CAST(is_roll AS INTEGER) >= 2)
"""

SQL["anomaly_report"] = with_roles("SELECT * FROM report", ANOMALY_REPORT)

SQL["anomaly_incremental"] = SQL["anomaly_report"]

SQL["distinct_scopes"] = with_roles("SELECT DISTINCT state, district FROM enrollments")

# ---------------------------------------------------------------- forecasting
MONTHLY = """
msum AS (SELECT CASE WHEN GROUPING(state) = 1 THEN 'All India' ELSE state END AS state, ds,
                CAST(coalesce(SUM(y), 0) AS DOUBLE) AS y
         FROM (SELECT state, CAST(date_trunc('month', date) AS DATE) AS ds,
                      age_0_5 + age_5_17 + age_18_greater AS y FROM enrollments)
         GROUP BY GROUPING SETS ((state, ds), (ds))),
mcal AS (SELECT state, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS ds
         FROM (SELECT state, min(ds) AS lo, max(ds) AS hi FROM msum GROUP BY 1)),
mser AS (SELECT c.state, c.ds, s.y FROM mcal c LEFT JOIN msum s ON c.state IS NOT DISTINCT FROM s.state AND c.ds = s.ds)
"""


def interp_sql(src: str, key: str) -> str:
    return f"""
ip AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY ds) AS pos FROM {src}),
iq AS (SELECT *,
        last_value(y IGNORE NULLS) OVER (PARTITION BY {key} ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS py,
        last_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY {key} ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
        first_value(y IGNORE NULLS) OVER (PARTITION BY {key} ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ny,
        first_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY {key} ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np
       FROM ip),
interp AS (SELECT {key}, ds, CASE WHEN y IS NOT NULL THEN y
                                  WHEN py IS NOT NULL AND ny IS NOT NULL THEN py + (ny - py) * (pos - pp) / (np - pp)
                                  WHEN py IS NOT NULL THEN py ELSE 0.0 END AS y FROM iq)
"""


SQL["monthly_series"] = with_roles("SELECT state, ds, y FROM mser", MONTHLY)

SQL["monthly_interpolated"] = with_roles(f"SELECT district, ds, {r6('y')} AS y FROM interp", """
dsum AS (SELECT district, CAST(date_trunc('month', date) AS DATE) AS ds,
                CAST(coalesce(SUM(age_0_5 + age_5_17 + age_18_greater), 0) AS DOUBLE) AS y
         FROM enrollments GROUP BY 1, 2),
dcal AS (SELECT district, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS ds
         FROM (SELECT district, min(ds) AS lo, max(ds) AS hi FROM dsum GROUP BY 1)),
dser AS (SELECT c.district, c.ds, s.y FROM dcal c LEFT JOIN dsum s USING (district, ds)),""" + interp_sql("dser", "district"))

SQL["backtest_split"] = with_roles("""
SELECT state, ds, y, CASE WHEN rn <= 3 THEN 'test' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY state ORDER BY ds DESC) AS rn,
             count(*) OVER (PARTITION BY state) AS n FROM interp) t
WHERE n >= 12""", MONTHLY + "," + interp_sql("mser", "state"))

# ---------------------------------------------------------------- risk
TRAINING = """
tr AS (SELECT CAST(date_trunc('month', e.date) AS DATE) AS month, e.state, e.district,
              CAST(SUM(e.v) AS BIGINT) AS enrollments, CAST(SUM(b.v) AS BIGINT) AS biometric_attempts,
              CAST(SUM(d.v) AS BIGINT) AS demo_updates
       FROM (SELECT date, state, district, SUM(age_5_17 + age_18_greater) AS v FROM enrollments GROUP BY ALL) e
       LEFT JOIN (SELECT date, state, district, SUM(bio_age_5_17 + bio_age_17_) AS v FROM biometric GROUP BY ALL) b
         USING (date, state, district)
       LEFT JOIN (SELECT date, state, district, SUM(demo_age_5_17 + demo_age_17_) AS v FROM demographic GROUP BY ALL) d
         USING (date, state, district)
       GROUP BY ALL),
fb AS (SELECT *, CASE WHEN enrollments > 0 THEN biometric_attempts / enrollments * 100 ELSE 0.0 END AS success_rate,
              CASE WHEN enrollments > 0 THEN demo_updates / enrollments ELSE 0.0 END AS update_freq,
              CAST(enrollments AS DOUBLE) AS density FROM tr),
feat AS (SELECT *,
  avg(success_rate) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS roll_success_3m,
  avg(update_freq) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS roll_update_3m,
  avg(success_rate) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS roll_success_6m,
  avg(update_freq) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS roll_update_6m,
  avg(success_rate) OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS roll_success_12m,
  avg(update_freq) OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS roll_update_12m,
  coalesce(CAST(enrollments AS DOUBLE) / nullif(lag(enrollments) OVER w, 0) - 1, 0.0) AS growth_rate,
  lead(success_rate, 3) OVER w AS target_rate,
  row_number() OVER (PARTITION BY state, district ORDER BY month DESC) AS newest
  FROM fb WINDOW w AS (PARTITION BY state, district ORDER BY month))
"""

FEATURE_COLS = ["success_rate", "update_freq", "density", "growth_rate", "roll_success_3m", "roll_success_6m",
                "roll_success_12m", "roll_update_3m", "roll_update_6m", "roll_update_12m"]
_F = ", ".join(f"{r6(c)} AS {c}" for c in FEATURE_COLS)

SQL["training_set"] = with_roles("SELECT * FROM tr", TRAINING)

SQL["risk_features"] = with_roles(f"""
SELECT month, state, district, enrollments, biometric_attempts, demo_updates, {_F},
       {r6('target_rate')} AS target_rate, CAST(target_rate < 250.0 AS INTEGER) AS is_high_risk
FROM feat WHERE target_rate IS NOT NULL""", TRAINING)

SQL["risk_features_latest"] = with_roles(f"""
SELECT month, state, district, enrollments, biometric_attempts, demo_updates, {_F}
FROM feat WHERE newest = 1""", TRAINING)

# ---------------------------------------------------------------- ETL
# Title case as Python's str.title(): every run of letters gets an upper-case
# first letter (tokens = optional non-letters followed by letters).
def title_sql(x: str) -> str:
    s = f"lower(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'))"
    pre = "regexp_extract(t, '^[^\\p{L}]*')"
    return (f"array_to_string(list_transform(regexp_extract_all({s}, '[^\\p{{L}}]*\\p{{L}}+|[^\\p{{L}}]+'), "
            f"lambda t: {pre} || upper(substr(t, length({pre}) + 1, 1)) || substr(t, length({pre}) + 2)), '')")


RAW_TEXT = """
raw AS (SELECT strftime(date, '%d-%m-%Y') AS date, state, district, pincode,
               CAST(age_0_5 AS VARCHAR) AS age_0_5, CAST(age_5_17 AS VARCHAR) AS age_5_17,
               CAST(age_18_greater AS VARCHAR) AS age_18_greater FROM enrollments),
parsed AS (SELECT try_strptime(date, '%d-%m-%Y')::DATE AS p_date, """ + title_sql("state") + """ AS p_state,
          """ + title_sql("district") + """ AS p_district,
          CASE WHEN regexp_full_match(split_part(pincode, '.', 1), '[0-9]{6}')
               THEN CAST(split_part(pincode, '.', 1) AS INTEGER) END AS p_pincode,
          pincode AS r_pincode,
          CASE WHEN TRY_CAST(age_0_5 AS DOUBLE) >= 0 AND isfinite(TRY_CAST(age_0_5 AS DOUBLE)) THEN TRY_CAST(age_0_5 AS DOUBLE) END AS p_a,
          CASE WHEN TRY_CAST(age_5_17 AS DOUBLE) >= 0 AND isfinite(TRY_CAST(age_5_17 AS DOUBLE)) THEN TRY_CAST(age_5_17 AS DOUBLE) END AS p_b,
          CASE WHEN TRY_CAST(age_18_greater AS DOUBLE) >= 0 AND isfinite(TRY_CAST(age_18_greater AS DOUBLE)) THEN TRY_CAST(age_18_greater AS DOUBLE) END AS p_c,
          date AS r_date, state AS r_state, district AS r_district, age_0_5 AS r_a, age_5_17 AS r_b, age_18_greater AS r_c
   FROM raw),
cls AS (SELECT *, (p_date IS NULL) AS bad_date, (r_pincode IS NOT NULL AND p_pincode IS NULL) AS bad_pin,
               (p_a IS NULL) AS bad_a, (p_b IS NULL) AS bad_b, (p_c IS NULL) AS bad_c FROM parsed)
"""

SQL["clean_enrollments"] = with_roles("""
SELECT p_date AS date, p_state AS state, p_district AS district, p_pincode AS pincode,
       p_a AS age_0_5, p_b AS age_5_17, p_c AS age_18_greater
FROM cls WHERE NOT (bad_date OR bad_pin OR bad_a OR bad_b OR bad_c)""", RAW_TEXT)

SQL["quality_report"] = with_roles("""
SELECT 'enrollment' AS dataset, count(*) AS total_rows,
       count(*) FILTER (WHERE NOT (bad_date OR bad_pin OR bad_a OR bad_b OR bad_c)) AS valid_rows,
       concat_ws(';',
         CASE WHEN count(*) FILTER (WHERE bad_a) > 0 THEN 'invalid_numeric_age_0_5=' || count(*) FILTER (WHERE bad_a) END,
         CASE WHEN count(*) FILTER (WHERE bad_c) > 0 THEN 'invalid_numeric_age_18_greater=' || count(*) FILTER (WHERE bad_c) END,
         CASE WHEN count(*) FILTER (WHERE bad_b) > 0 THEN 'invalid_numeric_age_5_17=' || count(*) FILTER (WHERE bad_b) END,
         CASE WHEN count(*) FILTER (WHERE bad_date) > 0 THEN 'invalid_date=' || count(*) FILTER (WHERE bad_date) END,
         CASE WHEN count(*) FILTER (WHERE bad_pin) > 0 THEN 'invalid_pincode=' || count(*) FILTER (WHERE bad_pin) END
       ) AS errors
FROM cls""", RAW_TEXT)

SQL["quarantine"] = with_roles("""
SELECT to_json({'date': r_date, 'state': r_state, 'district': r_district, 'pincode': r_pincode,
                'age_0_5': r_a, 'age_5_17': r_b, 'age_18_greater': r_c}) AS raw,
       concat_ws(',', CASE WHEN bad_date THEN 'invalid_date' END, CASE WHEN bad_pin THEN 'invalid_pincode' END,
                 CASE WHEN bad_a THEN 'invalid_numeric_age_0_5' END, CASE WHEN bad_b THEN 'invalid_numeric_age_5_17' END,
                 CASE WHEN bad_c THEN 'invalid_numeric_age_18_greater' END) AS reasons
FROM cls WHERE bad_date OR bad_pin OR bad_a OR bad_b OR bad_c""", RAW_TEXT)

_HOME = """
  CASE WHEN o.o_orderstatus = 'P' THEN strftime(o.o_orderdate, '%Y-%m-%d') ELSE strftime(o.o_orderdate, '%d-%m-%Y') END AS date,
  g.state, g.district,
  CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN c.c_name ELSE CAST(100000 + c.c_custkey AS VARCHAR) END AS pincode,
  CAST(CAST(floor(c.c_acctbal) AS BIGINT) AS VARCHAR)"""
_SOLD = "orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN geo g ON c.c_nationkey = g.nationkey"
EXPORTS = {
    "enrollment": (("age_0_5", "age_5_17", "age_18_greater"), f"""SELECT {_HOME} AS age_0_5,
  CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN o.o_orderpriority ELSE CAST(o.o_custkey % 50 AS VARCHAR) END AS age_5_17,
  CAST(o.o_orderkey % 100 AS VARCHAR) AS age_18_greater FROM {_SOLD}"""),
    "biometric": (("bio_age_5_17", "bio_age_17_"), f"""SELECT {_HOME} AS bio_age_5_17,
  CAST(l.l_linenumber * 5 AS VARCHAR) AS bio_age_17_ FROM lineitem l JOIN {_SOLD.replace(' JOIN customer', ' ON l.l_orderkey = o.o_orderkey JOIN customer', 1)}"""),
    "demographic": (("demo_age_5_17", "demo_age_17_"), """SELECT
  CASE WHEN l.l_linestatus = 'F' THEN strftime(l.l_shipdate, '%Y-%m-%d') ELSE strftime(l.l_shipdate, '%d-%m-%Y') END AS date,
  g.state, g.district, CASE WHEN l.l_returnflag = 'R' THEN s.s_name ELSE CAST(100000 + s.s_suppkey AS VARCHAR) END AS pincode,
  CAST(CAST(floor(s.s_acctbal) AS BIGINT) AS VARCHAR) AS demo_age_5_17, CAST(l.l_linenumber AS VARCHAR) AS demo_age_17_
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN geo g ON s.s_nationkey = g.nationkey"""),
}


def _export_ctes(name: str) -> str:
    """raw_<name> (texts) and cls_<name> (parsed values as p_, reasons as a list)."""
    metrics, raw = EXPORTS[name]
    parsed = ", ".join(f"CASE WHEN TRY_CAST({m} AS DOUBLE) >= 0 THEN TRY_CAST({m} AS DOUBLE) END AS p_{m}" for m in metrics)
    bad = ", ".join(f"CASE WHEN p_{m} IS NULL THEN 'invalid_numeric_{m}' END" for m in metrics)
    return f"""
raw_{name} AS ({raw}),
cls_{name} AS (SELECT *, list_filter(
    [CASE WHEN p_date IS NULL THEN 'invalid_date' END,
     CASE WHEN pincode IS NOT NULL AND p_pincode IS NULL THEN 'invalid_pincode' END, {bad}],
    lambda x: x IS NOT NULL) AS reasons
  FROM (SELECT *, try_strptime(date, '%d-%m-%Y')::DATE AS p_date, {title_sql('state')} AS p_state,
          {title_sql('district')} AS p_district,
          CASE WHEN regexp_full_match(split_part(pincode, '.', 1), '[0-9]{{6}}')
               THEN CAST(split_part(pincode, '.', 1) AS INTEGER) END AS p_pincode, {parsed} FROM raw_{name}))"""


_ALL_EXPORTS = ",".join(map(_export_ctes, EXPORTS))
for _name, (_metrics, _) in EXPORTS.items():
    SQL[f"etl_clean_{_name}"] = with_roles(
        "SELECT p_date AS date, p_state AS state, p_district AS district, p_pincode AS pincode, "
        + ", ".join(f"p_{m} AS {m}" for m in _metrics) + f" FROM cls_{_name} WHERE len(reasons) = 0", _export_ctes(_name))

SQL["etl_reports"] = with_roles(" UNION ALL ".join(f"""
SELECT '{n}' AS dataset, count(*) AS total_rows, count(*) FILTER (WHERE len(reasons) = 0) AS valid_rows,
  (SELECT coalesce(string_agg(r || '=' || c, ';' ORDER BY r), '') FROM
     (SELECT r, count(*) AS c FROM (SELECT unnest(reasons) AS r FROM cls_{n}) GROUP BY r)) AS errors
FROM cls_{n}""" for n in EXPORTS), _ALL_EXPORTS)

SQL["etl_quarantine"] = with_roles(" UNION ALL ".join(
    f"SELECT '{n}' AS dataset, to_json({{" + ", ".join(f"'{c}': {c}" for c in ("date", "state", "district", "pincode", *m))
    + f"}})::VARCHAR AS raw, array_to_string(reasons, ',') AS reasons FROM cls_{n} WHERE len(reasons) > 0"
    for n, (m, _) in EXPORTS.items()), _ALL_EXPORTS)

SQL["dedupe_load"] = with_roles("SELECT * FROM enrollments")

_TOTALS = """
totals AS (SELECT state, district, CAST(coalesce(SUM(age_0_5), 0) + coalesce(SUM(age_5_17), 0) + coalesce(SUM(age_18_greater), 0)
             AS BIGINT) AS total FROM enrollments GROUP BY 1, 2)"""

SQL["insight_responses"] = with_roles("""
SELECT state, district, length(district) % 3 < 2 AS parsed_ok,
  CASE WHEN length(district) % 3 < 2 THEN 'Total ' || total
       ELSE 'Automated insight generation failed. Please review the raw data.' END AS executive_summary,
  CASE WHEN length(district) % 3 < 2 THEN district || '|' || state ELSE 'Error processing data for insights.' END AS key_findings,
  CASE WHEN length(district) % 3 < 2 THEN 'In ' || state ELSE 'System error in AI module.' END AS risk_alerts,
  CASE WHEN length(district) % 3 < 2 THEN 'Visit|Report' ELSE 'Check Ollama service status.|Verify data format.' END AS recommendations
FROM totals""", _TOTALS)

SQL["policy_explode"] = with_roles("""
SELECT district, unnest(['mobile unit', 'longer hours']) AS recommendation, state AS rationale,
  CAST(total AS VARCHAR) AS impact_estimate, 'high' AS priority
FROM totals WHERE length(district) % 3 < 2""", _TOTALS)

# ---------------------------------------------------------------- cases and text rows
CASES = ANOMALY_REPORT + """,
cases AS (
  SELECT state || '|' || district || '|' || strftime(date, '%Y-%m-%d') AS case_id, state, district,
         strftime(date, '%Y-%m-%d') AS d, anomaly_type, anomaly_value, severity_score,
         'Anomaly in ' || district || ', ' || state || ': ' || anomaly_type || ' in ' || metric_name
           || ' confirmed by ' || replace(detection_methods, ',', ', ') || '. Severity: '
           || CAST(severity_score AS VARCHAR) AS text,
         [severity_score / 10.0, ln(1.0 + anomaly_value) / 10.0,
          CASE WHEN anomaly_type = 'spike' THEN 1.0 ELSE 0.0 END,
          len(string_split(detection_methods, ',')) / 3.0] AS vec
  FROM report)
"""

SQL["case_text"] = with_roles("""
SELECT case_id, text, anomaly_type AS meta_type, CAST(severity_score AS VARCHAR) AS meta_severity, d AS meta_date
FROM cases""", CASES)

SQL["similar_cases_exact"] = with_roles(f"""
SELECT vec_id, nn_rank, neighbor_id, {r6('dist')} AS distance FROM (
  SELECT a.vec_id, b.vec_id AS neighbor_id,
         list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS dist,
         CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY
           list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), b.vec_id) AS INTEGER) AS nn_rank
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) t
WHERE nn_rank <= 3""")

_EXPLAIN = _quoted(cases.EXPLAIN_TEMPLATE)

SQL["explanation_requests"] = with_roles(f"""
SELECT q.case_id, q.state, q.district, q.d AS date, q.query, coalesce(c.context, '') AS context,
       CASE WHEN c.context IS NULL THEN 'No knowledge base available yet. Please index historical anomalies.' END AS note,
       replace(replace(e'{_EXPLAIN}', '{{context}}', coalesce(c.context, '')), '{{query}}', q.query) AS prompt
FROM (SELECT case_id, state, district, d,
             'Anomaly: ' || anomaly_type || ' in ' || district || ' with value ' || CAST(anomaly_value AS VARCHAR) || '.' AS query
      FROM cases) q
LEFT JOIN (
  SELECT query_id, string_agg('- ' || text, e'\\n' ORDER BY nn_rank) AS context FROM (
    SELECT a.case_id AS query_id, b.text,
           row_number() OVER (PARTITION BY a.case_id ORDER BY list_distance(a.vec, b.vec), b.case_id) AS nn_rank
    FROM cases a JOIN cases b ON b.d < a.d) t
  WHERE nn_rank <= 3 GROUP BY 1) c ON q.case_id = c.query_id""", CASES)

_INSIGHT = _quoted(cases.INSIGHT_TEMPLATE)

LOW_600 = JOINED_DAILY + """,
low AS (SELECT state, district, avg_rate AS success_rate FROM (
          SELECT state, district, (AVG(success_rate_5_17) + AVG(success_rate_17_plus)) / 2 AS avg_rate
          FROM rates GROUP BY 1, 2) WHERE avg_rate < 600.0)
"""

_MOM = growth_sql(["month"], scope=("state",))
_MOM_CTES = _MOM[len("WITH "):_MOM.index("\nSELECT ")].replace(ROLES, "", 1).lstrip(",\n")
_MOM_BODY = _MOM[_MOM.index("\nSELECT ") + 1:]

SQL["insight_requests"] = with_roles(f"""
SELECT state, metrics_data, replace(e'{_INSIGHT}', '{{metrics_data}}', metrics_data) AS prompt FROM (
  SELECT t.state, to_json({{'state': t.state, 'total_enrollments': CAST(t.total AS BIGINT),
           'mom_growth_pct_age_0_5': g.a, 'mom_growth_pct_age_5_17': g.b, 'mom_growth_pct_age_18_greater': g.c,
           'low_performing_districts': CAST(coalesce(l.n, 0) AS BIGINT), 'anomaly_alerts': CAST(coalesce(a.n, 0) AS BIGINT),
           'spikes': CAST(coalesce(a.spikes, 0) AS BIGINT), 'drops': CAST(coalesce(a.drops, 0) AS BIGINT)}})::VARCHAR AS metrics_data
  FROM (SELECT state, coalesce(SUM(age_0_5), 0) + coalesce(SUM(age_5_17), 0) + coalesce(SUM(age_18_greater), 0) AS total
        FROM enrollments GROUP BY 1) t
  LEFT JOIN (SELECT state, max(CASE WHEN age_group = 'age_0_5' THEN growth_rate_pct END) AS a,
                    max(CASE WHEN age_group = 'age_5_17' THEN growth_rate_pct END) AS b,
                    max(CASE WHEN age_group = 'age_18_greater' THEN growth_rate_pct END) AS c
             FROM (SELECT *, row_number() OVER (PARTITION BY state, age_group ORDER BY date DESC) AS rn FROM mom)
             WHERE rn = 1 GROUP BY 1) g USING (state)
  LEFT JOIN (SELECT state, count(*) AS n FROM low GROUP BY 1) l USING (state)
  LEFT JOIN (SELECT state, count(*) AS n, count(*) FILTER (WHERE anomaly_type = 'spike') AS spikes,
                    count(*) FILTER (WHERE anomaly_type = 'drop') AS drops FROM report GROUP BY 1) a USING (state)) x
""", ANOMALY_REPORT + "," + LOW_600 + "," + _MOM_CTES + ",\nmom AS (" + _MOM_BODY + ")")

SQL["insight_parse"] = with_roles("""
SELECT conv_id, turn, false AS parsed_ok,
       'Automated insight generation failed. Please review the raw data.' AS executive_summary,
       'Error processing data for insights.' AS key_findings, 'System error in AI module.' AS risk_alerts,
       'Check Ollama service status.|Verify data format.' AS recommendations
FROM conversations WHERE role = 'assistant' AND NOT coalesce(json_valid(text), false)""")

PROBLEMS = ANOMALY_REPORT + "," + LOW_600 + """,
issues AS (
  SELECT state, district, printf('Low biometric success (%.0f%%)', success_rate) AS issue FROM low
  UNION ALL
  SELECT state, district, 'Unusual spike in anomalies (' || n || ')' FROM
    (SELECT state, district, count(*) FILTER (WHERE anomaly_type = 'spike') AS n FROM report GROUP BY 1, 2) WHERE n > 0
  UNION ALL
  SELECT state, district, 'High drop in enrollments (' || n || ')' FROM
    (SELECT state, district, count(*) FILTER (WHERE anomaly_type = 'drop') AS n FROM report GROUP BY 1, 2) WHERE n > 0),
problems AS (SELECT state, district, list(issue ORDER BY issue) AS issues FROM issues GROUP BY 1, 2)
"""

SQL["problem_districts"] = with_roles(
    "SELECT state, district, array_to_string(issues, '|') AS issues FROM problems", PROBLEMS)

_POLICY = _quoted(cases.POLICY_TEMPLATE)

SQL["policy_requests"] = with_roles(f"""
SELECT state, problem_districts, n_districts,
       replace(e'{_POLICY}', '{{problem_districts}}', problem_districts) AS prompt FROM (
  SELECT state, to_json(list({{'district': district, 'state': state, 'issues': issues}} ORDER BY district))::VARCHAR
           AS problem_districts, count(*) AS n_districts
  FROM problems GROUP BY 1) t""", PROBLEMS)

# ---------------------------------------------------------------- raw joins, split, loads, stored index
SQL["low_performers_raw_join"] = with_roles(f"""
SELECT state, district, {r6('avg_rate')} AS success_rate, {r6('160.0 - avg_rate')} AS gap, {r6('(160.0 - avg_rate) * 10')} AS priority_score
FROM (SELECT state, district,
        (avg(round_even(coalesce(bio_age_5_17 / nullif(age_5_17, 0) * 100, 0.0) * 10, 0) / 10)
         + avg(round_even(coalesce(bio_age_17_ / nullif(age_18_greater, 0) * 100, 0.0) * 10, 0) / 10)) / 2 AS avg_rate
      FROM enrollments JOIN biometric USING (date, state, district) GROUP BY 1, 2)
WHERE avg_rate < 160.0""")

SQL["training_set_raw_join"] = with_roles("""
SELECT CAST(date_trunc('month', e.date) AS DATE) AS month, e.state, e.district,
  CAST(SUM(e.age_5_17 + e.age_18_greater) AS BIGINT) AS enrollments,
  CAST(SUM(b.bio_age_5_17 + b.bio_age_17_) AS BIGINT) AS biometric_attempts,
  CAST(SUM(d.demo_age_5_17 + d.demo_age_17_) AS BIGINT) AS demo_updates
FROM enrollments e
LEFT JOIN biometric b ON e.date = b.date AND e.state = b.state AND e.district = b.district
LEFT JOIN demographic d ON e.date = d.date AND e.state = d.state AND e.district = d.district
GROUP BY ALL""")

SQL["risk_split"] = with_roles("""
SELECT state, district, month, is_high_risk,
  CAST((rk >= test) AS INTEGER) + CAST((rk >= test + rest // 3) AS INTEGER) + CAST((rk >= test + rest * 2 // 3) AS INTEGER) AS fold,
  rk < test AS is_test
FROM (SELECT *, n - test AS rest FROM (
  SELECT *, CAST(greatest(1, round(n * 0.2)) AS BIGINT) AS test FROM (
    SELECT *, count(*) OVER (PARTITION BY is_high_risk) AS n, row_number() OVER (PARTITION BY is_high_risk ORDER BY h) - 1 AS rk FROM (
      SELECT state, district, month, CAST(target_rate < 250.0 AS INTEGER) AS is_high_risk,
        CAST('0x' || substr(md5(state || '|' || district || '|' || strftime(month, '%Y-%m-%d')), 1, 15) AS BIGINT) AS h
      FROM feat WHERE target_rate IS NOT NULL))))""", TRAINING)

SQL["anomaly_details"] = with_roles(f"""
SELECT date, state, district, daily_enrollments AS value,
  concat_ws(',', CASE WHEN is_z THEN 'z_score' END, CASE WHEN is_iqr THEN 'iqr' END, CASE WHEN is_roll THEN 'rolling_deviation' END) AS methods,
  CASE WHEN is_z THEN {r6('z_score')} END AS z_score,
  CASE WHEN is_iqr THEN {r6('lower_bound')} END AS lower_bound, CASE WHEN is_iqr THEN {r6('upper_bound')} END AS upper_bound,
  CASE WHEN is_roll THEN {r6('rolling_mean')} END AS rolling_mean, CASE WHEN is_roll THEN {r6('deviation_pct')} END AS deviation_pct
FROM flags WHERE CAST(is_z AS INTEGER) + CAST(is_iqr AS INTEGER) + CAST(is_roll AS INTEGER) >= 2""", ANOMALY)

_PIN_TOTALS = """
pins AS (SELECT state, district, pincode,
           CAST(coalesce(SUM(age_0_5), 0) + coalesce(SUM(age_5_17), 0) + coalesce(SUM(age_18_greater), 0) AS BIGINT) AS total
         FROM enrollments GROUP BY ALL)"""

SQL["privacy_gate_pincode"] = with_roles("""
SELECT state, district, pincode, total, CASE WHEN total >= 500 THEN 'compliant' ELSE 'suppressed' END AS status FROM pins""", _PIN_TOTALS)

_PIN_GROWTH = growth_sql(["year"], scope=("state", "district", "pincode"), min_count=500)
SQL["growth_pincode_yearly"] = f"""
SELECT *, NULL AS error FROM ({_PIN_GROWTH}) g
UNION ALL BY NAME
SELECT state, district, pincode, 'Insufficient data for analysis (DPDP Suppression)' AS error
FROM (WITH {ROLES}, {_PIN_TOTALS} SELECT * FROM pins) p WHERE total < 500"""

_TYPED = """
typed AS (SELECT try_strptime(date, '%d-%m-%Y')::DATE AS date, state, district, pincode, TRY_CAST(age_0_5 AS INTEGER) AS a,
            TRY_CAST(age_5_17 AS INTEGER) AS b, TRY_CAST(age_18_greater AS INTEGER) AS c FROM raw_enrollment),
checked AS (SELECT *, date IS NULL OR state IS NULL OR district IS NULL OR coalesce(a < 0, false) OR coalesce(b < 0, false)
              OR coalesce(c < 0, false) AS bad FROM typed)"""

SQL["ledger_load"] = with_roles("""
SELECT 'older' AS load, count(*) AS total_rows, count(*) FILTER (WHERE NOT bad) AS inserted, count(*) FILTER (WHERE bad) AS errors, 'Completed' AS status
FROM checked WHERE date < DATE '1996-01-01'
UNION ALL
SELECT 'all', count(*), count(*) FILTER (WHERE NOT bad AND NOT coalesce(date < DATE '1996-01-01', false)), count(*) FILTER (WHERE bad), 'Completed' FROM checked
UNION ALL
SELECT 'target', count(*) FILTER (WHERE NOT bad), count(*) FILTER (WHERE NOT bad), 0, 'Completed' FROM checked""",
                                _export_ctes("enrollment") + "," + _TYPED)

SQL["etl_csv_files"] = SQL["etl_clean_enrollment"].replace(
    "p_district AS district", "CASE WHEN p_state = 'Asia' THEN p_district || chr(10) || 'Zone' ELSE p_district END AS district")

SQL["new_cases_against_index"] = with_roles("""
SELECT q.case_id, coalesce(c.ids, '') AS similar_cases, coalesce(c.context, '') AS context,
       CASE WHEN c.context IS NULL THEN 'No knowledge base available yet. Please index historical anomalies.' END AS note
FROM (SELECT case_id FROM cases, newest WHERE CAST(d AS DATE) + 30 > top) q
LEFT JOIN (
  SELECT query_id, string_agg('- ' || text, e'\\n' ORDER BY nn_rank) AS context, string_agg(near_id, ',' ORDER BY nn_rank) AS ids FROM (
    SELECT a.case_id AS query_id, b.case_id AS near_id, b.text,
           row_number() OVER (PARTITION BY a.case_id ORDER BY list_distance(a.vec, b.vec), b.case_id) AS nn_rank
    FROM cases a JOIN cases b ON b.d < a.d JOIN newest ON CAST(a.d AS DATE) + 30 > top AND CAST(b.d AS DATE) + 30 <= top) t
  WHERE nn_rank <= 3 GROUP BY 1) c ON q.case_id = c.query_id""", CASES.rstrip() + """,
newest AS (SELECT max(CAST(d AS DATE)) AS top FROM cases)""")
