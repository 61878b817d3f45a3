"""Session settings shared by tests, bench and library code."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: dates are DATE, so the session runs in UTC;
# ANSI stays on, so operators use try_* functions where input can be bad.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # the JVM compiles no method above 8000 bytes; long projections (the ETL's
    # parsing rules) are split by operator rather than interpreted as one
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "civicstat") -> SparkSession:
    """Local/test session. On a cluster use the session the platform gives."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("CIVICSTAT_DRIVER_MEM", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Pin the runtime settings the operators depend on (safe on any session)
    and make the package importable by the Python workers."""
    for k in ("spark.sql.session.timeZone",
              "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(k, BASE_CONF[k])
    ship_package(spark)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers (once per app).

    Grouped pandas functions are pickled by module reference, so every
    worker must be able to import ``civicstat``; ``addPyFile`` distributes a
    zip of the package with the job, as on any cluster.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="civicstat-pyfiles-"), "civicstat.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Without one a local session (tests, trial runs) gets a private scratch
    folder; on a cluster that is an error, because a machine-local folder is
    not visible to the other executors.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="civicstat-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() if not spark.conf.get("spark.checkpoint.dir", None) else d


def materialize(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet into the shared checkpoint folder and
    read back, for a result that several branches of a query use. The files
    go when the application ends."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def cluster_conf(input_bytes: int, executor_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle/scan sizing for a cluster run (a starting point; AQE coalesces).

    Shuffle partitions are sized so the largest stage — the partial
    aggregate of the biggest fact, which is at most the scanned volume —
    gets about ``target_partition_bytes`` per task, and never fewer than
    two waves of tasks over all executor cores.
    """
    parts = max(2 * executor_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
