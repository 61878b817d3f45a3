"""Sinks: idempotent fact load, alert append, recommendation table, case index.

Every write is a whole-partition or append write of a DataFrame; nothing
passes through the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicstat.schemas import POLICY_RECOMMENDATION
from civicstat.session import materialize

LOAD_BATCH_ROWS = 10_000  # JDBC batch size of the reference loader


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds data files. Only a missing or empty folder is
    "no table"; one that cannot be read fails when it is read."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return False
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return any(not n.startswith(("_", ".")) for n in names)


def new_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source rows not already in the target, compared on all source
    columns NULL-safely. Equal rows inside the source are all kept (D9)."""
    cols = source.columns
    cond = reduce(lambda a, b: a & b, [source[c].eqNullSafe(target[c]) for c in cols])
    return source.join(target.select(*cols), cond, "left_anti")


def load_parquet(spark: SparkSession, source_path: str, target_path: str) -> DataFrame:
    """Append the rows of a Parquet file that the target lacks.

    Returns a one-row summary (file, total_rows, inserted, errors, status).
    The rows to insert are written once to the shared folder so that counting
    and appending them do not repeat the anti-join. A failure leaves the target
    as it was and raises; ``load_with_ledger`` counts failed rows and continues
    a broken load.
    """
    src = spark.read.parquet(source_path)
    total = src.count()
    todo = new_rows(src, spark.read.parquet(target_path)) if table_exists(spark, target_path) else src
    todo = materialize(todo)
    inserted = todo.count()
    todo.write.mode("append").parquet(target_path)
    return spark.createDataFrame(
        [(source_path, total, inserted, 0, "Completed")],
        "file string, total_rows long, inserted long, errors long, status string")


LEDGER = "source string, batch int, rows long, inserted long, errors long, status string"
LOAD_BATCHES = 16


def violations(schema: T.StructType) -> Column:
    """Names of the constraints that a row breaks, from the rules in the
    schema's metadata; an empty array if none."""
    checks = []
    for f in schema.fields:
        for rule in f.metadata.get("rules", ()):
            broken = F.col(f.name).isNull() if rule == "not_null" else F.col(f.name) < 0
            checks.append(F.when(broken, F.lit(f"{f.name}_{rule}")))
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def row_digest(columns) -> Column:
    """128 bits of a row, NULLs told from values."""
    parts = [x for c in sorted(columns) for x in (F.col(c).isNull(), F.col(c).cast("string"))]
    return F.concat_ws("-", F.xxhash64(*parts).cast("string"), F.xxhash64(F.lit(1), *parts).cast("string"))


def load_with_ledger(spark: SparkSession, source_path: str, target_path: str, load_id: str, schema: T.StructType | None = None,
                     batches: int = LOAD_BATCHES) -> DataFrame:
    """Loads a Parquet file in batches and returns one summary row:
    file, total_rows, inserted, errors, status.

    Rows are dealt to batches by their digest, and the target (``rows``) is
    partitioned in the same way, so a batch is held only against its own
    partition. Rows that break a constraint of ``schema`` are errors; they go to
    ``rejected`` with the constraints' names. After each batch the ledger gets a
    row. A load that breaks off is continued under the same ``load_id``: staged
    rows are not dealt again, finished batches are skipped, and of a batch that
    was written but not entered no row is inserted twice. Rows that the target
    has are skipped; equal rows of one load are all kept (D9).
    """
    staged, ledger = f"{target_path}/staged/{load_id}", f"{target_path}/ledger/load={load_id}"
    columns = spark.read.parquet(source_path).columns
    if not table_exists(spark, f"{staged}/done"):
        digest = row_digest(columns)
        (spark.read.parquet(source_path).withColumns({"_digest": digest, "_broken": violations(schema) if schema else F.array().cast("array<string>")})
         .withColumn("_batch", F.pmod(F.xxhash64("_digest"), F.lit(batches)).cast("int"))
         .write.mode("overwrite").partitionBy("_batch").parquet(f"{staged}/rows"))
        spark.range(1).write.mode("overwrite").parquet(f"{staged}/done")
    done = {r["batch"] for r in _ledger(spark, ledger).where("status = 'Completed'").collect()}
    rows = spark.read.parquet(f"{staged}/rows")
    for batch in range(batches):
        if batch not in done:
            n = _load_batch(spark, rows.where(F.col("_batch") == batch).drop("_batch"), target_path, load_id, batch)
            _enter(spark, ledger, (source_path, batch, *n, "Completed"))
    s = _ledger(spark, ledger).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows", "inserted", "errors")]).head()
    return spark.createDataFrame([(source_path, s["rows"], s["inserted"], s["errors"], "Completed")],
                                 "file string, total_rows long, inserted long, errors long, status string")


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).json(path) if table_exists(spark, path) else spark.createDataFrame([], LEDGER)


def _enter(spark: SparkSession, path: str, row: tuple) -> None:
    spark.createDataFrame([row], LEDGER).coalesce(1).write.mode("append").json(path)


def _load_batch(spark: SparkSession, rows: DataFrame, target_path: str, load_id: str, batch: int) -> tuple[int, int, int]:
    """(rows, inserted, errors) of one batch."""
    broken, own = F.size("_broken") > 0, f"{target_path}/rows/batch={batch}"
    n, errors = rows.agg(F.count("*"), F.count_if(broken)).head()
    if errors:
        (rows.where(broken).drop("_digest").withColumnRenamed("_broken", "broken").write.mode("overwrite")
         .parquet(f"{target_path}/rejected/load={load_id}/batch={batch}"))
    good = rows.where(~broken).drop("_broken")
    if table_exists(spark, own):
        there = spark.read.parquet(own).select("_digest")
        good = good.join(there, "_digest", "left_anti")
    new = materialize(good)
    inserted = new.count()
    if inserted:
        new.write.mode("append").parquet(own)
    return n, inserted, errors


def loaded_rows(spark: SparkSession, target_path: str) -> DataFrame:
    """The rows of a target that ``load_with_ledger`` fills."""
    return spark.read.parquet(f"{target_path}/rows").drop("_digest", "batch")


def jdbc_append(df: DataFrame, url: str, table: str, props: dict | None = None) -> None:
    """JDBC form of the load with the reference batch size (needs a driver jar)."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table) \
        .option("batchsize", LOAD_BATCH_ROWS).mode("append")
    for k, v in (props or {}).items():
        w = w.option(k, v)
    w.save()


def write_fact(df: DataFrame, path: str) -> None:
    """Physical layout of a fact table: Parquet partitioned by year (date
    range filters prune partitions), rows sorted by state, district, date
    inside each file (row-group min/max statistics then skip most groups
    for a state/district filter, as the reference's indexes did).

    Range partitioning on (year, state, district, date) splits a district
    that holds a large share of the rows into date ranges over many tasks
    instead of one writer."""
    (df.withColumn("year", F.year("date"))
     .repartitionByRange("year", "state", "district", "date")
     .sortWithinPartitions("state", "district", "date")
     .write.mode("overwrite").partitionBy("year").parquet(path))


def append_alerts(alerts: DataFrame, path: str, run_date: str | None = None) -> None:
    """Alerts partitioned by detection date; re-running a day replaces
    only that day's partition (dynamic partition overwrite)."""
    d = F.to_date(F.lit(run_date)) if run_date else F.current_date()
    (alerts.withColumn("detected_on", d).withColumn("created_at", F.current_timestamp())
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("detected_on").parquet(path))


def store_recommendations(recs: DataFrame, path: str, run_date: str | None = None) -> None:
    """One row per recommendation (state 'Unknown', 'Combined Issues').
    With ``run_date`` a repeated run replaces its own rows."""
    out = recs.select(
        "district",
        F.coalesce(F.col("state") if "state" in recs.columns else F.lit(None), F.lit("Unknown")).alias("state"),
        F.lit("Combined Issues").alias("issue_type"),
        "recommendation", "rationale", "impact_estimate", "priority",
        F.current_timestamp().alias("created_at"))
    out = out.select([f.name for f in POLICY_RECOMMENDATION.fields])
    if run_date is None:
        out.write.mode("append").parquet(path)
    else:
        (out.withColumn("run_date", F.to_date(F.lit(run_date))).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(path))


def list_recommendations(spark: SparkSession, path: str) -> DataFrame:
    """Newest first."""
    return spark.read.parquet(path).orderBy(F.desc("created_at"))


def append_cases(cases: DataFrame, path: str) -> None:
    """The case index is an append-only Parquet table."""
    cases.write.mode("append").parquet(path)
