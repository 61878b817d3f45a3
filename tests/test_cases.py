import datetime as dt

from civicstat.operators import cases


def test_parse_insights_fallback_and_ok(spark):
    good = ('{"executive_summary": "s", "key_findings": ["a"], "risk_alerts": ["r"], '
            '"recommendations": ["x", "y"]}')
    df = spark.createDataFrame([(1, good), (2, "not json"), (3, '{"executive_summary": "only"}')], "id int, text string")
    rows = {r.id: r for r in cases.parse_insights(df).collect()}
    assert rows[1].parsed_ok and rows[1].recommendations == ["x", "y"]
    assert not rows[2].parsed_ok and rows[2].executive_summary == cases.FALLBACK_SUMMARY
    assert not rows[3].parsed_ok and rows[3].recommendations == cases.FALLBACK_RECOMMENDATIONS


def test_explode_policy(spark):
    text = ('{"recommendations": [{"district": "A", "recommendation": "r", "rationale": "q", '
            '"impact_estimate": "i", "cost_category": "Low", "priority": "High"}, '
            '{"district": "B", "recommendation": "r2", "rationale": "q2", "impact_estimate": "i2", '
            '"cost_category": "High", "priority": "Low"}]}')
    df = spark.createDataFrame([(text,), ("broken",)], "text string")
    rows = cases.explode_policy(df).collect()
    assert [r.district for r in rows] == ["A", "B"]


def test_case_text_defaults(spark):
    df = spark.createDataFrame([("spike",)], "anomaly_type string")
    r = df.select(cases.case_text(df).alias("t"), cases.query_text(df).alias("q")).first()
    assert r.t == "Anomaly in Unknown, Unknown: . Severity: Unknown"
    assert r.q == "Anomaly: spike in Unknown with value ."


def test_explanation_requests_context(spark):
    alerts = spark.createDataFrame(
        [(dt.date(2024, 1, d), "S", "D", "daily_enrollments", float(v), sev, "spike", ["z_score", "iqr"])
         for d, v, sev in [(1, 100.0, 5.0), (2, 110.0, 5.5), (3, 500.0, 9.0), (4, 120.0, 6.0)]],
        "date date, state string, district string, metric_name string, anomaly_value double, "
        "severity_score double, anomaly_type string, detection_methods array<string>")
    out = {r.date: r for r in cases.explanation_requests(cases.alert_cases(alerts)).collect()}
    r = out["2024-01-04"]
    assert r.context.count("\n") == 2 and r.context.startswith("- Anomaly in D, S")
    assert "New alert\nAnomaly: spike in D with value 120.0." in r.prompt
    # only earlier cases are past cases
    assert out["2024-01-02"].context.count("\n") == 0 and out["2024-01-02"].note is None
    assert out["2024-01-01"].context == "" and out["2024-01-01"].note == cases.NO_INDEX_MESSAGE


def test_new_cases_search_a_stored_index(spark, scratch):
    from civicstat.sources import sinks
    schema = ("date date, state string, district string, metric_name string, anomaly_value double, "
              "severity_score double, anomaly_type string, detection_methods array<string>")
    rows = [(dt.date(2024, 1, d), "S", "D", "daily_enrollments", 100.0 + d, 5.0, "spike", ["iqr"]) for d in (1, 2, 3, 4)]
    sinks.append_cases(cases.alert_cases(spark.createDataFrame(rows[:3], schema)), f"{scratch}/index")
    out = cases.explanation_requests(cases.alert_cases(spark.createDataFrame(rows[3:], schema)),
                                     index=spark.read.parquet(f"{scratch}/index")).collect()
    assert len(out) == 1 and out[0].context.count("- Anomaly") == 3


def test_insight_and_policy_requests(spark):
    import json
    m = spark.createDataFrame([("S1", 10, 2), ("S2", 5, 0)], "state string, total bigint, alerts bigint")
    req = {r.state: r for r in cases.insight_requests(m).collect()}
    assert json.loads(req["S1"].metrics_data) == {"state": "S1", "total": 10, "alerts": 2}
    assert req["S1"].metrics_data in req["S1"].prompt and "{metrics_data}" not in req["S1"].prompt
    probs = spark.createDataFrame([("S1", "B", ["x"]), ("S1", "A", ["y", "z"]), ("S2", "C", ["w"])],
                                  "state string, district string, issues array<string>")
    pol = {r.state: r for r in cases.policy_requests(probs).collect()}
    items = json.loads(pol["S1"].problem_districts)
    assert [i["district"] for i in items] == ["A", "B"] and pol["S1"].n_districts == 2
    assert pol["S2"].n_districts == 1


def test_fenced_json_responses(spark):
    body = ('{"executive_summary": "s", "key_findings": ["a"], "risk_alerts": ["r"], '
            '"recommendations": ["x"]}')
    df = spark.createDataFrame([(1, "Here you go:\n```json\n" + body + "\n```\nThanks"), (2, "```\nnot json\n```")],
                               "id int, text string")
    rows = {r.id: r for r in cases.parse_insights(df).collect()}
    assert rows[1].parsed_ok and rows[1].executive_summary == "s"
    assert not rows[2].parsed_ok
