"""Rows read vs rows shuffled per registered query, from Spark's event log.

Usage: python scripts/shuffle_report.py [sf_dir] [scratch_dir]
Runs every registered query (noop sink) with the event log written to a
fresh scratch folder, then sums the task metrics of each query's jobs:
rows read from files, rows and bytes written to shuffle files. A small
rows-shuffled / rows-read ratio means the plan aggregates before it
shuffles (broadcast jobs run outside the query's job description and are
not counted; they carry only the small dimension sides).
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from civicstat.plans.catalog import QUERIES  # noqa: E402
from civicstat.session import BASE_CONF, apply_conf  # noqa: E402

SKIP = {"risk_scores"}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="run-")
    logs = os.path.join(scratch, "eventlog")
    os.makedirs(logs, exist_ok=True)
    b = SparkSession.builder.master("local[8]").appName("civicstat-shuffle-report")
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    spark = (b.config("spark.sql.shuffle.partitions", "16").config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", logs).config("spark.eventLog.rolling.enabled", "false")
             .config("spark.eventLog.compress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    for name, fn in QUERIES.items():
        if name in SKIP:
            continue
        spark.sparkContext.setJobDescription(name)
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    spark.stop()

    stage_query, read, shuffled, srows = {}, {}, {}, {}
    for path in glob.glob(os.path.join(logs, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    q = (ev.get("Properties") or {}).get("spark.job.description")
                    for sid in ev.get("Stage IDs", []):
                        stage_query[sid] = q
                elif kind == "SparkListenerTaskEnd":
                    q = stage_query.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if q is None:
                        continue
                    read[q] = read.get(q, 0) + (m.get("Input Metrics") or {}).get("Records Read", 0)
                    w = m.get("Shuffle Write Metrics") or {}
                    shuffled[q] = shuffled.get(q, 0) + w.get("Shuffle Bytes Written", 0)
                    srows[q] = srows.get(q, 0) + w.get("Shuffle Records Written", 0)
    print("| query | rows read | rows shuffled | shuffled / read | shuffle MB |")
    print("|---|---|---|---|---|")
    for name in QUERIES:
        if name in read:
            r, n = read[name], srows.get(name, 0)
            print(f"| {name} | {r:,} | {n:,} | {n / r if r else 0:.3f} | {shuffled.get(name, 0) / 1e6:.2f} |")


if __name__ == "__main__":
    main()
