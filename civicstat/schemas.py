"""Fixed table and result schemas."""

from pyspark.sql import types as T

KEYS = ["date", "state", "district"]

ENROLLMENTS = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("state", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("pincode", T.StringType()),
    T.StructField("age_0_5", T.IntegerType()),
    T.StructField("age_5_17", T.IntegerType()),
    T.StructField("age_18_greater", T.IntegerType()),
])

BIOMETRIC = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("state", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("pincode", T.StringType()),
    T.StructField("bio_age_5_17", T.IntegerType()),
    T.StructField("bio_age_17_", T.IntegerType()),
])

DEMOGRAPHIC = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("state", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("pincode", T.StringType()),
    T.StructField("demo_age_5_17", T.IntegerType()),
    T.StructField("demo_age_17_", T.IntegerType()),
])

ANOMALY_ALERTS = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("state", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("metric_name", T.StringType()),
    T.StructField("anomaly_value", T.DoubleType()),
    T.StructField("severity_score", T.DoubleType()),
    T.StructField("anomaly_type", T.StringType()),
    T.StructField("detection_methods", T.ArrayType(T.StringType())),
])

POLICY_RECOMMENDATION = T.StructType([
    T.StructField("district", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("issue_type", T.StringType()),
    T.StructField("recommendation", T.StringType()),
    T.StructField("rationale", T.StringType()),
    T.StructField("impact_estimate", T.StringType()),
    T.StructField("priority", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

# Response record of an insight request (parsed with from_json).
INSIGHT_RECORD = T.StructType([
    T.StructField("executive_summary", T.StringType()),
    T.StructField("key_findings", T.ArrayType(T.StringType())),
    T.StructField("risk_alerts", T.ArrayType(T.StringType())),
    T.StructField("recommendations", T.ArrayType(T.StringType())),
])

RECOMMENDATION = T.StructType([
    T.StructField("district", T.StringType()),
    T.StructField("recommendation", T.StringType()),
    T.StructField("rationale", T.StringType()),
    T.StructField("impact_estimate", T.StringType()),
    T.StructField("cost_category", T.StringType()),
    T.StructField("priority", T.StringType()),
])

POLICY_RESPONSE = T.StructType([
    T.StructField("recommendations", T.ArrayType(RECOMMENDATION)),
])

# Metric columns per dataset are found by name (substring), as the ETL does.
METRIC_PATTERN = {
    "biometric": "bio_age",
    "demographic": "demo_age",
    "enrollment": "age",
}

# The input tables. Reading them by a known schema needs no job over their footers.
INPUT_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def constrained(schema: T.StructType, not_null=(), not_negative=()) -> T.StructType:
    """The schema with constraints kept in the metadata of its fields."""
    fields = []
    for f in schema.fields:
        rules = [r for r, names in (("not_null", not_null), ("not_negative", not_negative)) if f.name in names]
        fields.append(T.StructField(f.name, f.dataType, f.nullable, {**f.metadata, "rules": rules}))
    return T.StructType(fields)


_FACT = ("date", "state", "district")
CONSTRAINED = {
    "enrollment": constrained(ENROLLMENTS, _FACT, ("age_0_5", "age_5_17", "age_18_greater")),
    "biometric": constrained(BIOMETRIC, _FACT, ("bio_age_5_17", "bio_age_17_")),
    "demographic": constrained(DEMOGRAPHIC, _FACT, ("demo_age_5_17", "demo_age_17_")),
}
