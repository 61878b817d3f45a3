"""What the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicstat.session import checkpoint_dir

#: A word is a run of anything but space, tab, line feed, VT, FF and CR. On
#: UTF-8 bytes this is what ``bytes.split()`` without arguments finds.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of one Arrow batch. Texts can be long, so batches are small.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> None:
    """Bounds the Arrow batches that reach the Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def small_batches(batches: Iterator[pa.RecordBatch], at: int, size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts (column ``at``) have about ``size``
    bytes; a longer text is alone."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            after = max(first + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(first, after - first)
            first = after


@contextmanager
def brief_files(spark: SparkSession) -> Iterator[None]:
    """Within it, shuffle files go when the job that wrote them ends, and
    written frames are packed closely. For frames that are each run once."""
    own = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` written as Parquet into the shared checkpoint folder and read
    back, and the folder, which ``discard`` may delete before the end."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path), path


def cut(df: DataFrame) -> DataFrame:
    """Writes ``df`` as Parquet into the shared checkpoint folder and reads it back.

    Cuts the lineage: a lost executor costs no recomputation before this
    point. The files go when the application ends.
    """
    return written(df)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder made by ``written`` that no frame in use reads."""
    if path:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text modulo n; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def one_label(labels: DataFrame, name: str) -> DataFrame:
    """(id, label) with one row per id: repeated rows of an id count once, and
    an id with contradicting labels or a null one is left out."""
    return (labels.select(F.col("doc_id").alias("id"), F.col(name).cast("int").alias("label"))
            .where(F.col("id").isNotNull() & F.col("label").isin(0, 1))
            .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("top"))
            .where(F.col("label") == F.col("top")).drop("top"))
