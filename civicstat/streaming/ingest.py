"""Incremental ingest of newly arriving CSV files through the Q1 rules.

The stream is one of file notices: path, time and length of files not seen
before (tracked in the checkpoint), never their content. Every micro-batch
reads its files as the batch ETL does, each by its own header, and writes clean
rows, quarantined rows and the report. A ledger keeps a row for every file with
a digest of its content and its status; a file whose content was processed
before, under whatever name, is a duplicate and adds no row.

Each micro-batch writes into its own ``batch_id`` partition with dynamic
overwrite, so a batch replayed after a failure replaces its earlier output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from civicstat.session import checkpoint_dir
from civicstat.sources.ingest import clean_rows, plain_path, quality_report, quarantine_rows, stage_files, unreadable
from civicstat.sources.sinks import table_exists

#: Files of one micro-batch; their paths reach the driver.
FILES_PER_BATCH = 1000
LEDGER = ("file string, digest string, status string, reason string, total_rows long, valid_rows long")
PROCESSED, DUPLICATE, FAILED = "processed", "duplicate", "failed"


def content_digests(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file, digest): number of lines and two sums of their hashes, taken in
    all tasks that read a part of the file. The order of lines does not count."""
    lines = spark.read.text(files).select("value", F.col("_metadata.file_path").alias("file"))
    whole = "decimal(38,0)"
    return lines.groupBy("file").agg(F.concat_ws(
        "-", F.count("*").cast("string"), F.sum(F.xxhash64("value").cast(whole)).cast("string"),
        F.sum(F.xxhash64(F.lit(1), "value").cast(whole)).cast("string")).alias("digest"))


def _digests(spark: SparkSession, files: list[str]) -> dict[str, str]:
    return {plain_path(r["file"]): r["digest"] for r in content_digests(spark, files).collect()}


def read_ledger(spark: SparkSession, out_dir: str, dataset: str) -> DataFrame:
    """A row for every file that arrived: status, digest, rows, batch_id."""
    path = f"{out_dir}/{dataset}_files"
    if not table_exists(spark, path):
        return spark.createDataFrame([], f"{LEDGER}, batch_id long")
    return spark.read.schema(f"{LEDGER}, batch_id long").json(path)


def ingest_files(spark: SparkSession, files: list[str], out_dir: str, dataset: str, batch_id: int, staged: str) -> None:
    """One micro-batch: the files that are new by content go through the rules."""
    def write(df: DataFrame, name: str, kind: str = "parquet") -> None:
        (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").format(kind).save(f"{out_dir}/{dataset}_{name}"))

    files = sorted(map(plain_path, files))
    try:
        digests = _digests(spark, files)
        bad = {}
    except Exception:  # noqa: BLE001 - raised again unless a file is to blame
        bad = unreadable(spark, files)
        if not bad:
            raise
        good = [f for f in files if f not in bad]
        digests = _digests(spark, good) if good else {}
    # only the batch's own digests are looked up; rows of a batch that is replayed do not count
    seen = {r["digest"] for r in read_ledger(spark, out_dir, dataset).where(
        (F.col("status") == PROCESSED) & (F.col("batch_id") != batch_id) & F.col("digest").isin(sorted(set(digests.values()))))
        .select("digest").collect()}
    fresh, twice = [], []
    for f, digest in sorted(digests.items()):
        (twice if digest in seen else fresh).append(f)
        seen.add(digest)
    rows = {}
    if fresh:
        classified, rules, broken = stage_files(spark, dataset, fresh, staged)
        bad |= broken
        if classified is not None:
            write(clean_rows(classified), "clean")
            write(quarantine_rows(classified), "quarantine")
            write(quality_report(classified, dataset, rules), "report", "json")
            rows = {plain_path(r["source_file"]): (r["n"], r["good"]) for r in classified.groupBy("source_file").agg(
                F.count("*").alias("n"), F.count_if("valid").alias("good")).collect()}
    told = [(f, digests.get(f), FAILED, bad[f], 0, 0) for f in sorted(bad)]
    told += [(f, digests[f], DUPLICATE, None, 0, 0) for f in twice if f not in bad]
    told += [(f, digests[f], PROCESSED, None, *rows.get(f, (0, 0))) for f in fresh if f not in bad]
    # a file without a line has no digest and no row
    told += [(f, None, PROCESSED, None, 0, 0) for f in files if f not in bad and f not in digests]
    write(spark.createDataFrame(told, LEDGER).coalesce(1), "files", "json")


def start_ingest(spark: SparkSession, in_dir: str, out_dir: str, dataset: str, columns=None,
                 checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Starts the stream over ``in_dir``. ``columns`` is not needed: every file
    is read by its own header."""
    notices = (spark.readStream.format("binaryFile").option("maxFilesPerTrigger", FILES_PER_BATCH)
               .schema("path string, modificationTime timestamp, length long, content binary").load(in_dir).select("path", "modificationTime", "length"))
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/ingest-{dataset}"

    def write_batch(df: DataFrame, batch_id: int) -> None:
        files = [r["path"] for r in df.select("path").collect()]
        if files:
            ingest_files(df.sparkSession, files, out_dir, dataset, batch_id, f"{ckpt}-staged/{batch_id}")

    writer = notices.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
