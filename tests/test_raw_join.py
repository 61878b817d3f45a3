import datetime as dt
import random
from collections import defaultdict

import numpy as np

from civicstat.operators import rawjoin

DAY = dt.date(2024, 1, 1)


def facts(spark, hot=0):
    rng = random.Random(4)

    def rows(n, *tops):
        out = [(DAY + dt.timedelta(days=rng.randrange(4)), f"S{rng.randrange(2)}", "D", *[rng.choice([None, *range(t)]) for t in tops]) for _ in range(n)]
        return out + [(DAY, "S0", "D", *[7 for _ in tops])] * hot + [(None, "S0", "D", *[1 for _ in tops])]

    e, b, d = rows(60, 4, 5), rows(50, 6, 7), rows(10, 3, 3)
    names = "date date, state string, district string, "
    return (e, b, d), (spark.createDataFrame(e, names + "age_5_17 int, age_18_greater int"),
                       spark.createDataFrame(b, names + "bio_age_5_17 int, bio_age_17_ int"),
                       spark.createDataFrame(d, names + "demo_age_5_17 int, demo_age_17_ int"))


def test_means_over_pairs(spark):
    (e, b, _), (enr, bio, _) = facts(spark)
    rates = defaultdict(lambda: ([], []))
    for x in e:
        for y in b:
            if x[:3] == y[:3] and x[0] is not None:
                for g in (0, 1):
                    v = y[3 + g] / x[3 + g] * 100 if x[3 + g] and y[3 + g] is not None else 0.0
                    rates[x[1], x[2]][g].append(np.rint(v * 10) / 10)
    want = {k: (np.mean(a) + np.mean(c)) / 2 for k, (a, c) in rates.items()}
    got = {(r.state, r.district): r.success_rate for r in rawjoin.low_performers(enr, bio, 1e9).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_sums_over_triples(spark):
    (e, b, d), (enr, bio, demo) = facts(spark)

    def both(x):
        return None if x[3] is None or x[4] is None else x[3] + x[4]

    sums = defaultdict(lambda: [None, None, None])
    for x in e:
        own = lambda rows: [y for y in rows if y[:3] == x[:3] and x[0] is not None] or [None]  # noqa: E731, B023
        for y in own(b):
            for z in own(d):
                key = (x[0] and x[0].replace(day=1), x[1], x[2])
                for i, v in enumerate((both(x), y and both(y), z and both(z))):
                    if v is not None:
                        sums[key][i] = (sums[key][i] or 0) + v
                sums[key]
    got = {(r.month, r.state, r.district): [None if v is None else int(v) for v in (r.enrollments, r.biometric_attempts, r.demo_updates)]
           for r in rawjoin.training_set(enr, bio, demo).collect()}
    assert got == {k: v for k, v in sums.items()}


def test_a_hot_key_makes_no_pairs(spark):
    _, (enr, bio, _) = facts(spark, hot=20_000)  # 400 million pairs
    rates = rawjoin.pair_rates(enr, bio)
    assert rates.count() < 1000
    assert rates.agg({"pairs": "max"}).head()[0] >= 20_000 ** 2
