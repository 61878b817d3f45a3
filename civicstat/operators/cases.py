"""Case index, similar cases and text request/response rows (Q24–Q30).

Text generation and the embedding model are external (not built). This
module prepares the rows such a service consumes — case texts, similar
cases, prompt texts — and parses the rows it returns, all as DataFrame
transforms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicstat.functions.scalar import iso_date
from civicstat.operators.neighbors import CellIndex, nearest, search
from civicstat.schemas import INSIGHT_RECORD, POLICY_RESPONSE
from civicstat.session import checkpoint_dir, materialize
from civicstat.sources.sinks import table_exists

UNKNOWN = "Unknown"
K_SIMILAR = 3

# Request texts; the part in braces is filled in per row.
EXPLAIN_TEMPLATE = (
    "New alert\n{query}\n\nEarlier alerts with the closest features\n{context}\n\n"
    "Say what may lie behind the new alert and which step should follow. Refer to the earlier alerts where they help.")
INSIGHT_TEMPLATE = (
    "Figures of one state, as JSON\n{metrics_data}\n\n"
    "Answer with a JSON object: executive_summary is a text, key_findings, risk_alerts and recommendations are "
    "lists of texts. Use these figures only.")
POLICY_TEMPLATE = (
    "Districts of one state with their open issues, as JSON\n{problem_districts}\n\n"
    "Answer with a JSON object whose list recommendations has an entry per district with the keys district, "
    "recommendation, rationale, impact_estimate and priority.")

# Fixed values of the fallback record and of the note for an empty index.
FALLBACK_SUMMARY = "Automated insight generation failed. Please review the raw data."
FALLBACK_FINDINGS = ["Error processing data for insights."]
FALLBACK_RISKS = ["System error in AI module."]
FALLBACK_RECOMMENDATIONS = ["Check Ollama service status.", "Verify data format."]
NO_INDEX_MESSAGE = "No knowledge base available yet. Please index historical anomalies."


def _opt(df: DataFrame, name: str, default: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(default)) if name in df.columns else F.lit(default)


def case_text(df: DataFrame) -> Column:
    """'Anomaly in {district}, {state}: {description}. Severity: {severity}'."""
    return F.format_string("Anomaly in %s, %s: %s. Severity: %s",
                           _opt(df, "district", UNKNOWN), _opt(df, "state", UNKNOWN),
                           _opt(df, "description", ""), _opt(df, "severity", UNKNOWN))


def query_text(df: DataFrame) -> Column:
    """'Anomaly: {anomaly_type} in {district} with value {anomaly_value}.'"""
    return F.format_string("Anomaly: %s in %s with value %s.",
                           _opt(df, "anomaly_type", UNKNOWN), _opt(df, "district", UNKNOWN),
                           _opt(df, "anomaly_value", ""))


def alert_cases(alerts: DataFrame) -> DataFrame:
    """Q24 on detected alerts: case id, text, metadata map and feature vector.

    The vector stands in for the external embedding: severity, log value,
    direction and number of confirming methods, each scaled to about 0..1.
    """
    a = alerts.select(
        F.concat_ws("|", "state", "district", iso_date("date")).alias("case_id"),
        "state", "district", iso_date("date").alias("date"), "anomaly_type", "anomaly_value",
        F.col("severity_score").alias("severity"),
        F.concat(F.col("anomaly_type"), F.lit(" in "), F.col("metric_name"), F.lit(" confirmed by "),
                 F.array_join("detection_methods", ", ")).alias("description"),
        F.array(F.col("severity_score") / 10.0, F.log(F.lit(1.0) + F.col("anomaly_value")) / 10.0,
                F.when(F.col("anomaly_type") == "spike", 1.0).otherwise(0.0),
                F.size("detection_methods") / 3.0).alias("vec"))
    return a.select("case_id", "state", "district", "date", "anomaly_type", "anomaly_value",
                    case_text(a).alias("text"),
                    F.create_map(F.lit("type"), F.col("anomaly_type"),
                                 F.lit("severity"), F.col("severity").cast("string"),
                                 F.lit("date"), F.col("date")).alias("metadata"),
                    "vec")


def similar_cases(queries: DataFrame, index: DataFrame, k: int = K_SIMILAR, self_search: bool = False,
                  query_id: str = "case_id", index_id: str = "case_id", vec: str = "vec",
                  before: str | None = None) -> DataFrame:
    """Q25: exact top-k nearest cases (see ``neighbors.nearest``)."""
    return nearest(queries, index, k, query_id, index_id, vec, exclude_self=self_search, before=before)


def explanation_requests(cases: DataFrame, k: int = K_SIMILAR, index: DataFrame | None = None) -> DataFrame:
    """Q26: per case, its k most similar past cases as context + prompt text.

    ``index`` is a table of earlier cases; without one the cases themselves are
    the index. Only cases of an earlier date count as past. Each table is read
    several times, so it is checkpointed once to the shared checkpoint folder.
    """
    checkpoint_dir(cases.sparkSession)
    cases = cases.checkpoint(eager=True)
    index = cases if index is None else index.checkpoint(eager=True)
    return _requests(cases, similar_cases(cases, index, k, before="date"), index)


def store_cases(cases: DataFrame, path: str) -> None:
    """Adds cases to the stored index: their texts and, by cell, their
    vectors. A case that is there already is not added again."""
    spark = cases.sparkSession
    cases = materialize(cases)
    if not table_exists(spark, f"{path}/cells/pivots"):
        CellIndex.build(cases, "case_id", before="date").write(f"{path}/cells")
    else:
        CellIndex.append(spark, f"{path}/cells", cases, "case_id", before="date")
    if table_exists(spark, f"{path}/texts"):
        # written once more: the rows to add are fixed before the table changes
        cases = materialize(cases.join(spark.read.parquet(f"{path}/texts").select("case_id"), "case_id", "left_anti"))
    cases.drop("vec").write.mode("append").parquet(f"{path}/texts")


def explain_new_cases(cases: DataFrame, path: str, k: int = K_SIMILAR) -> DataFrame:
    """Q26 against the stored index, with the list ``similar_cases`` of the
    cases found. A search reads the vectors of the cells it visits."""
    spark = cases.sparkSession
    cases = materialize(cases)
    if not table_exists(spark, f"{path}/texts"):
        none = cases.limit(0).select(F.col("case_id").alias("query_id"), F.col("case_id").alias("neighbor_id"), F.lit(1).alias("nn_rank"))
        return _requests(cases, none, cases.limit(0), listed=True)
    nn = materialize(search(cases, CellIndex.read(spark, f"{path}/cells"), k, "case_id", before="date"))
    return _requests(cases, nn, spark.read.parquet(f"{path}/texts"), listed=True)


def _requests(cases: DataFrame, nn: DataFrame, texts: DataFrame, listed: bool = False) -> DataFrame:
    texts = texts.select(F.col("case_id").alias("neighbor_id"), F.col("text").alias("_nt"))
    found = (nn.join(texts, "neighbor_id").groupBy("query_id")
             .agg(F.array_sort(F.collect_list(F.struct("nn_rank", "_nt", "neighbor_id"))).alias("_c")))
    ctx = found.select(F.col("query_id").alias("case_id"),
                       F.array_join(F.transform("_c", lambda x: F.concat(F.lit("- "), x["_nt"])), "\n").alias("context"),
                       *([F.transform("_c", lambda x: x["neighbor_id"]).alias("similar_cases")] if listed else []))
    q = cases.select("case_id", "state", "district", "date", query_text(cases).alias("query"))
    out = q.join(ctx, "case_id", "left").withColumns({
        # no similar case (empty index): the reference's message, empty context
        "note": F.when(F.col("context").isNull(), F.lit(NO_INDEX_MESSAGE)),
        "context": F.coalesce("context", F.lit(""))})
    if listed:
        out = out.withColumn("similar_cases", F.coalesce("similar_cases", F.array().cast("array<string>")))
    prompt = F.replace(F.replace(F.lit(EXPLAIN_TEMPLATE), F.lit("{context}"), F.col("context")),
                       F.lit("{query}"), F.col("query"))
    return out.withColumn("prompt", prompt)


def insight_requests(metrics: DataFrame, scope=("state",)) -> DataFrame:
    """Q27: per scope, all metric columns → JSON text → prompt text."""
    scope = list(scope)
    # unknown metrics are sent as JSON null rather than left out
    payload = F.to_json(F.struct(*[F.col(c) for c in metrics.columns]), {"ignoreNullFields": "false"})
    return metrics.select(*scope, payload.alias("metrics_data")).withColumn(
        "prompt", F.replace(F.lit(INSIGHT_TEMPLATE), F.lit("{metrics_data}"), F.col("metrics_data")))


def json_payload(c: Column) -> Column:
    """The JSON inside a markdown code fence (```json … ```) when there is
    one, else the whole text — responses are often wrapped that way."""
    fenced = F.regexp_extract(c, r"(?s)```(?:json)?\s*(.*?)\s*```", 1)
    return F.when(fenced != "", fenced).otherwise(c)


def parse_insights(responses: DataFrame, text_col: str = "text") -> DataFrame:
    """Q28: typed parse of response texts; anything unusable → fallback record."""
    parsed = F.from_json(json_payload(F.col(text_col)), INSIGHT_RECORD)
    ok = (parsed.isNotNull() & parsed["executive_summary"].isNotNull() & parsed["key_findings"].isNotNull()
          & parsed["risk_alerts"].isNotNull() & parsed["recommendations"].isNotNull())
    fallback = F.struct(F.lit(FALLBACK_SUMMARY).alias("executive_summary"),
                        F.array(*[F.lit(x) for x in FALLBACK_FINDINGS]).alias("key_findings"),
                        F.array(*[F.lit(x) for x in FALLBACK_RISKS]).alias("risk_alerts"),
                        F.array(*[F.lit(x) for x in FALLBACK_RECOMMENDATIONS]).alias("recommendations"))
    return responses.withColumn("_p", F.when(ok, parsed).otherwise(fallback)) \
        .withColumn("parsed_ok", ok).select("*", "_p.*").drop("_p")


def problem_districts(low: DataFrame, alerts: DataFrame) -> DataFrame:
    """Q29: issue lines from low performers and from alert counts per district."""
    lp = low.select("state", "district",
                    F.format_string("Low biometric success (%.0f%%)", F.col("success_rate")).alias("issue"))
    counts = alerts.groupBy("state", "district").agg(
        F.count_if(F.col("anomaly_type") == "spike").alias("spikes"),
        F.count_if(F.col("anomaly_type") == "drop").alias("drops"))
    sp = counts.filter("spikes > 0").select("state", "district",
                                            F.format_string("Unusual spike in anomalies (%d)", "spikes").alias("issue"))
    dr = counts.filter("drops > 0").select("state", "district",
                                           F.format_string("High drop in enrollments (%d)", "drops").alias("issue"))
    issues = lp.unionByName(sp).unionByName(dr)
    return issues.groupBy("state", "district").agg(F.sort_array(F.collect_list("issue")).alias("issues"))


def policy_requests(problems: DataFrame) -> DataFrame:
    """Request rows for policy recommendations: one request per state, its
    problem districts as a JSON list sorted by district (a group is one
    state's districts, never the whole table)."""
    items = F.to_json(F.sort_array(F.collect_list(F.struct("district", "state", "issues"))))
    req = problems.groupBy("state").agg(items.alias("problem_districts"), F.count(F.lit(1)).alias("n_districts"))
    return req.filter("n_districts > 0").withColumn(
        "prompt", F.replace(F.lit(POLICY_TEMPLATE), F.lit("{problem_districts}"), F.col("problem_districts")))


def explode_policy(responses: DataFrame, text_col: str = "text") -> DataFrame:
    """Q30: recommendations[] of each response → one row each; bad JSON → none."""
    parsed = F.from_json(json_payload(F.col(text_col)), POLICY_RESPONSE)
    return (responses.select(F.explode_outer(parsed["recommendations"]).alias("r"))
            .filter(F.col("r").isNotNull()).select("r.*"))
