import datetime as dt
import os

from civicstat.operators import anomaly, daytable


def enrollments(spark, days, n=6):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=d), "S", f"D{i % 2}", 1 + d % 5, None if i == 3 else 2 + (90 if d == 45 else 0), i)
            for d in days for i in range(n)]
    return spark.createDataFrame(rows, "date date, state string, district string, age_0_5 int, age_5_17 int, age_18_greater int")


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_new_rows_read_and_write_their_months_only(spark, scratch):
    fact, table = f"{scratch}/fact", f"{scratch}/days"
    daytable.append_rows(enrollments(spark, range(60)), fact)
    daytable.refresh_days(spark, fact, table)
    before = files(table)
    days = daytable.append_rows(enrollments(spark, [60, 10]), fact)  # a new day and late rows of an old one
    assert days == [dt.date(2024, 1, 1), dt.date(2024, 3, 1)]
    daytable.refresh_days(spark, fact, table, days)
    changed = {p.split("month=")[1][:10] for p, _ in files(table).items() ^ before.items()}
    assert changed == {"2024-01-01", "2024-03-01"}
    # a fact without the other months' files gives the same: they are not read
    import shutil
    shutil.copytree(fact, f"{scratch}/few/fact", ignore=lambda d, names: [n for n in names if n == "month=2024-02-01"])
    shutil.copytree(table, f"{scratch}/few/days")
    daytable.refresh_days(spark, f"{scratch}/few/fact", f"{scratch}/few/days", days)
    assert sorted(map(str, daytable.read_days(spark, f"{scratch}/few/days").collect())) == sorted(map(str, daytable.read_days(spark, table).collect()))
    daytable.refresh_days(spark, fact, table, days)  # once more
    whole = enrollments(spark, range(61)).unionByName(enrollments(spark, [10]))
    for key in (lambda e: anomaly.anomaly_series(e), lambda e: anomaly.anomaly_report(e)):
        got, want = (sorted(map(str, key(e).collect())) for e in (daytable.read_days(spark, table), whole))
        assert got == want and got


def test_newest_days_and_no_table(spark, scratch):
    assert daytable.read_days(spark, f"{scratch}/none").count() == 0
    daytable.append_rows(enrollments(spark, range(20)), f"{scratch}/fact")
    daytable.refresh_days(spark, f"{scratch}/fact", f"{scratch}/days")
    got = daytable.read_days(spark, f"{scratch}/days", newest=3).select("date").distinct().collect()
    assert sorted(r.date.day for r in got) == [18, 19, 20]
