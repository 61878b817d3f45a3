import datetime as dt
import os

from civicstat.sources import ingest, sinks
from civicstat.streaming.ingest import start_ingest

HEADER = "date,state,district,pincode,age_0_5,age_5_17,age_18_greater"
# FIXTURES edge rows: input → expected reasons
EDGE = [
    ("1-2-2024,s,d,110001,1,1,1", []),
    ("31-02-2024,s,d,110001,1,1,1", ["invalid_date"]),
    ("2024-01-01,s,d,110001,1,1,1", ["invalid_date"]),
    ("01-02-24,s,d,110001,1,1,1", ["invalid_date"]),
    ("01-02-2024,s,d,110001.0,1,1,1", []),
    ("01-02-2024,s,d,11000,1,1,1", ["invalid_pincode"]),
    ("01-02-2024,s,d,abcdef,1,1,1", ["invalid_pincode"]),
    ("01-02-2024,s,d,,1,1,1", []),
    ("01-02-2024,s,d,110001,-1,1,1", ["invalid_numeric_age_0_5"]),
    ("01-02-2024,s,d,110001,1,inf,1", ["invalid_numeric_age_5_17"]),
    ("01-02-2024,s,d,110001,1,1,nan", ["invalid_numeric_age_18_greater"]),
    ("01-02-2024,s,d,110001,x,1,1", ["invalid_numeric_age_0_5"]),
    ("01-02-2024,s,d,110001,,1,1", ["invalid_numeric_age_0_5"]),
    ('01-02-2024,"\t24-parganas ",d,110001,1,1,1', []),
    ("01-02-2024,,d,110001,1,1,1", []),
]


def _write(dirname, name, lines):
    os.makedirs(dirname, exist_ok=True)
    with open(os.path.join(dirname, name), "w") as f:
        f.write(HEADER + "\n" + "\n".join(lines) + "\n")


def test_edge_rows(spark, scratch):
    _write(scratch, "a.csv", [line for line, _ in EDGE])
    c = ingest.classify(ingest.read_raw_csv(spark, os.path.join(scratch, "a.csv")), "enrollment").collect()
    assert [sorted(r.reasons) for r in c] == [sorted(x) for _, x in EDGE]
    assert c[0].date == dt.date(2024, 2, 1)
    assert c[4].pincode == 110001
    assert c[7].pincode is None
    assert c[13].state == "24-Parganas"
    assert c[14].state is None


def test_report_and_sinks(spark, scratch):
    _write(os.path.join(scratch, "in"), "a.csv", [line for line, _ in EDGE])
    _write(os.path.join(scratch, "in"), "b.csv", ["02-02-2024,s,d,110002,1,2,3"])
    out = os.path.join(scratch, "out")
    rep = ingest.run_etl(spark, {"enrollment": [os.path.join(scratch, "in")]}, out).first()
    assert rep.total_rows == len(EDGE) + 1
    bad = sum(1 for _, x in EDGE if x)
    assert rep.valid_rows == len(EDGE) + 1 - bad
    assert rep.errors["invalid_date"] == 3 and rep.errors["invalid_pincode"] == 2
    assert "invalid_numeric_age_5_17" in rep.errors
    clean = spark.read.parquet(f"{out}/enrollment_clean.parquet")
    assert clean.count() == rep.valid_rows
    q = spark.read.parquet(f"{out}/enrollment_quarantine.parquet")
    assert q.count() == bad and q.filter("source_file is null").count() == 0
    sample = ingest.quarantine_sample(ingest.quarantine_rows(
        ingest.classify(ingest.read_raw_csv(spark, os.path.join(scratch, "in")), "enrollment")), per_rule=1)
    assert sample.filter("rule = 'invalid_date'").count() == 1


def test_corrupt_file_is_set_aside(spark, scratch):
    # An unreadable file does not fail the run; the other files are kept
    _write(scratch, "ok.csv", ["02-02-2024,s,d,110002,1,2,3"])
    with open(os.path.join(scratch, "broken.csv.gz"), "wb") as f:
        f.write(b"this is not gzip data" * 10)
    report = ingest.run_etl(spark, {"enrollment": [scratch]}, os.path.join(scratch, "out")).first()
    assert report.total_rows == 1 and len(report.failed_files) == 1


def test_idempotent_load(spark, scratch):
    src = os.path.join(scratch, "src.parquet")
    rows = [(i, f"row{i}" if i % 7 else None) for i in range(100)]
    spark.createDataFrame(rows, "id long, data string").write.parquet(src)
    target = os.path.join(scratch, "target")
    first = sinks.load_parquet(spark, src, target).first()
    assert (first.total_rows, first.inserted, first.errors) == (100, 100, 0)
    again = sinks.load_parquet(spark, src, target).first()
    assert again.inserted == 0
    assert spark.read.parquet(target).count() == 100


def test_alert_sink_replaces_same_day(spark, scratch):
    alerts = spark.createDataFrame([(dt.date(2024, 1, 1), "S", "D", "daily_enrollments", 1.0, 5.0, "spike", ["iqr", "z_score"])],
                                   "date date, state string, district string, metric_name string, anomaly_value double, "
                                   "severity_score double, anomaly_type string, detection_methods array<string>")
    path = os.path.join(scratch, "alerts")
    sinks.append_alerts(alerts, path, "2024-01-02")
    sinks.append_alerts(alerts, path, "2024-01-02")
    sinks.append_alerts(alerts, path, "2024-01-03")
    assert spark.read.parquet(path).count() == 2


def test_incremental_stream(spark, scratch):
    inbox = os.path.join(scratch, "inbox")
    out = os.path.join(scratch, "out")
    cols = HEADER.split(",")
    _write(inbox, "a.csv", [line for line, _ in EDGE])
    q = start_ingest(spark, inbox, out, "enrollment", cols, checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination(120)
    _write(inbox, "b.csv", ["02-02-2024,s,d,110002,1,2,3"])
    q = start_ingest(spark, inbox, out, "enrollment", cols, checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination(120)
    clean = spark.read.parquet(f"{out}/enrollment_clean")
    bad = sum(1 for _, x in EDGE if x)
    assert clean.count() == len(EDGE) - bad + 1
    assert spark.read.parquet(f"{out}/enrollment_quarantine").count() == bad


def test_fact_layout_and_recommendations(spark, scratch):
    rows = [(dt.date(2023 + i % 2, 1 + i % 12, 1), "S", f"D{i % 3}", None, 1, 2, 3) for i in range(40)]
    df = spark.createDataFrame(rows, "date date, state string, district string, pincode string, "
                                     "age_0_5 int, age_5_17 int, age_18_greater int")
    path = os.path.join(scratch, "fact")
    sinks.write_fact(df, path)
    back = spark.read.parquet(path)
    assert back.count() == 40 and set(r.year for r in back.select("year").distinct().collect()) == {2023, 2024}
    recs = spark.createDataFrame([("A", "r", "q", "i", "High"), ("B", "r2", "q2", "i2", "Low")],
                                 "district string, recommendation string, rationale string, "
                                 "impact_estimate string, priority string")
    rp = os.path.join(scratch, "recs")
    sinks.store_recommendations(recs, rp)
    out = sinks.list_recommendations(spark, rp).collect()
    assert {r.district for r in out} == {"A", "B"}
    assert all(r.state == "Unknown" and r.issue_type == "Combined Issues" for r in out)


def test_plain_files_split_and_keep_their_block(spark, scratch):
    # Only files with quoted line breaks are read whole
    lines = [f"0{1 + i % 9}-02-2024,s,d,1100{i % 90 + 10},{i},1,1" for i in range(20_000)]
    _write(scratch, "plain.csv", lines)
    with open(os.path.join(scratch, "breaks.csv"), "w") as f:
        f.write(HEADER + "\n" + "".join(f'01-02-2024,"two\nlines {i}",d,110001,{i},1,1\n' for i in range(300)))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        files = {r.source_file.rsplit("/", 1)[1]: r for r in ingest.survey_files(spark, ingest.list_files(spark, scratch)).collect()}
        assert not files["plain.csv"].quoted_breaks and files["breaks.csv"].quoted_breaks
        assert {r.header for r in files.values()} == {HEADER}
        raw = ingest.read_raw_csv(spark, scratch)
        rows = raw.selectExpr("age_0_5", "state", "source_block", "split(source_file, '/')[size(split(source_file, '/')) - 1] AS f").collect()
        partitions = raw.rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    plain = [r for r in rows if r.f == "plain.csv"]
    assert sorted(int(r.age_0_5) for r in plain) == list(range(20_000))
    assert len({r.source_block for r in plain}) >= 5 and partitions >= 6
    broken = [r for r in rows if r.f == "breaks.csv"]
    assert sorted(r.state for r in broken) == sorted(f"two\nlines {i}" for i in range(300))


def test_names_of_columns():
    assert ingest.column_names('a,"b,c",,a, d') == ("a0", "b,c", "_c2", "a3", " d")
    assert ingest.column_names("﻿date") == ("date",)


def test_rows_before_the_break_can_be_kept(spark, scratch):
    import gzip
    _write(os.path.join(scratch, "in"), "a.csv", ["02-02-2024,s,d,110002,1,2,3"])
    data = gzip.compress((HEADER + "\n" + "".join(f"02-02-2024,s,d,110002,{i * i % 9973},2,{i}\n" for i in range(50_000))).encode())
    for name, part in (("b.csv.gz", data[:len(data) // 2]), ("c.csv.gz", b"no gzip at all")):
        with open(os.path.join(scratch, "in", name), "wb") as f:
            f.write(part)
    out = os.path.join(scratch, "out")
    report = ingest.run_etl(spark, {"enrollment": [os.path.join(scratch, "in")]}, out, salvage=True).head()
    assert {k.rsplit("/", 1)[1] for k in report.failed_files} == {"b.csv.gz", "c.csv.gz"}
    assert 1000 < report.total_rows < 50_000
    kept = spark.read.parquet(f"{out}/enrollment_clean.parquet")
    assert kept.count() == report.valid_rows and kept.where("age_18_greater = 0").count() == 1


def test_stream_and_batch_agree_file_by_file(spark, scratch):
    # A row too long, another order of columns, a broken file, the same content again
    from civicstat.streaming.ingest import read_ledger
    inbox, out, ck = (os.path.join(scratch, x) for x in ("inbox", "out", "ck"))

    def run():
        start_ingest(spark, inbox, out, "enrollment", checkpoint=ck).awaitTermination(180)
        return {r.file.rsplit("/", 1)[1]: (r.status, r.total_rows, r.valid_rows) for r in read_ledger(spark, out, "enrollment").collect()}

    _write(inbox, "a.csv", ["02-02-2024,s,d,110002,1,2,3", "02-02-2024,s,d,110002,1,2,3,9"])
    with open(os.path.join(inbox, "b.csv"), "w") as f:
        f.write("age_0_5,district,state,date,pincode,age_5_17,age_18_greater\n7,d,s,03-02-2024,110002,2,3\n")
    with open(os.path.join(inbox, "c.csv.gz"), "wb") as f:
        f.write(b"no gzip at all")
    first = run()
    assert first == {"a.csv": ("processed", 2, 1), "b.csv": ("processed", 1, 1), "c.csv.gz": ("failed", 0, 0)}
    _write(inbox, "again.csv", ["02-02-2024,s,d,110002,1,2,3", "02-02-2024,s,d,110002,1,2,3,9"])
    _write(inbox, "new one.csv", ["04-02-2024,s,d,110002,1,2,3"])
    second = run()
    assert second["again.csv"] == ("duplicate", 0, 0) and second["new one.csv"] == ("processed", 1, 1)
    clean = spark.read.parquet(f"{out}/enrollment_clean")
    assert sorted((str(r.date), r.age_0_5) for r in clean.collect()) == [("2024-02-02", 1.0), ("2024-02-03", 7.0), ("2024-02-04", 1.0)]
    assert [r.reasons for r in spark.read.parquet(f"{out}/enrollment_quarantine").collect()] == [["malformed_row"]]
    batch = ingest.run_etl(spark, {"enrollment": [f"{inbox}/a.csv", f"{inbox}/b.csv", f"{inbox}/new one.csv"]}, os.path.join(scratch, "batch"))
    assert (batch.head().total_rows, batch.head().valid_rows) == (4, 3)


def test_replayed_batch_replaces_itself(spark, scratch):
    from civicstat.streaming.ingest import ingest_files, read_ledger
    _write(scratch, "a.csv", ["02-02-2024,s,d,110002,1,2,3"])
    out, file = os.path.join(scratch, "out"), f"file:{scratch}/a.csv"
    for batch_id in (0, 0, 1):
        ingest_files(spark, [file], out, "enrollment", batch_id, os.path.join(scratch, f"staged{batch_id}"))
    assert spark.read.parquet(f"{out}/enrollment_clean").count() == 1
    assert sorted((r.batch_id, r.status) for r in read_ledger(spark, out, "enrollment").collect()) == [(0, "processed"), (1, "duplicate")]


def test_broken_load_continues(spark, scratch, monkeypatch):
    from pyspark.sql import types as T

    from civicstat.schemas import constrained
    schema = constrained(T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.IntegerType())]), ["id"], ["n"])
    rows = [(i % 90, i % 7 - 1) for i in range(200)] + [(None, 1)]
    spark.createDataFrame(rows, schema).write.parquet(f"{scratch}/src")
    bad = sum(1 for i, n in rows if i is None or n < 0)
    load, calls = sinks._load_batch, []

    def breaks(*args):
        calls.append(args[-1])
        out = load(*args)
        if len(calls) == 3:
            raise RuntimeError("lost")  # written, not entered
        return out

    monkeypatch.setattr(sinks, "_load_batch", breaks)
    try:
        sinks.load_with_ledger(spark, f"{scratch}/src", f"{scratch}/t", "one", schema, batches=5)
    except RuntimeError:
        pass
    done = sinks.load_with_ledger(spark, f"{scratch}/src", f"{scratch}/t", "one", schema, batches=5).head()
    assert calls == [0, 1, 2, 2, 3, 4]
    assert (done.total_rows, done.errors) == (201, bad)
    assert sorted(map(tuple, sinks.loaded_rows(spark, f"{scratch}/t").collect())) == sorted(r for r in rows if r[0] is not None and r[1] >= 0)
    again = sinks.load_with_ledger(spark, f"{scratch}/src", f"{scratch}/t", "two", schema, batches=5).head()
    assert (again.inserted, again.errors) == (0, bad)
    broken = spark.read.parquet(f"{scratch}/t/rejected/load=one")
    assert {tuple(r.broken) for r in broken.collect()} == {("id_not_null",), ("n_not_negative",)}


def test_repeated_recommendations_of_a_day_replace_themselves(spark, scratch):
    recs = spark.createDataFrame([("A", "r", "q", "i", "High")], "district string, recommendation string, rationale string, "
                                                                 "impact_estimate string, priority string")
    for day in ("2024-01-01", "2024-01-01", "2024-01-02"):
        sinks.store_recommendations(recs, f"{scratch}/recs", day)
    assert sinks.list_recommendations(spark, f"{scratch}/recs").count() == 2


def test_texts_without_a_year_do_not_reach_the_date_parser(spark):
    from pyspark.sql import functions as F

    from civicstat.functions import scalar
    texts = ["1-2-2024", "01-02-2024", "31-02-2024", "2024-01-01", "01-02-24", "1-2-12024", "1-2-+12024", "1-2--0044", " 1-2-2024",
             "1-2-2024 ", "1-2-2024\n", "", "x", "1234", "0001-02-2024", "1-2-0000", "\u0661-\u0662-\u0662\u0660\u0662\u0664", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", scalar.parse_date("t").cast("string").alias("d"),
                    F.try_to_date("t", scalar.DATE_PATTERN).cast("string").alias("plain"))
    rows = got.collect()
    assert [r.d for r in rows] == [r.plain for r in rows] and sum(r.d is not None for r in rows) >= 2
    # each exception of the parser costs more than the rest of the row
    assert scalar.ENDS_IN_YEAR in df.select(scalar.parse_date("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert [r[0] for r in df.limit(18).select(scalar.number("t")).collect()].count(None) == len(texts) - 1
