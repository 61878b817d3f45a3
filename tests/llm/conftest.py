import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "labels", "conversations", "embeddings")


@pytest.fixture(scope="session")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, repeated rows and columns
    whose names the operators use inside."""
    prose = " ".join(f"word{i % 97}x{i} and" for i in range(200))
    rows = [
        (1, prose, "en", "b"), (2, prose, "fr", None), (2, prose, "fr", None), (None, prose, None, "a"),
        (None, None, None, None), (3, "", "en", "a"), (4, None, "en", "b"), (5, " \t\n", "en", "a"),
        (6, "one", "de", "c"), (7, "# $ % & | < >", "en", "c"), (8, prose + " tail of its own", "en", "b"),
        (9, " ".join(f"long{i}" for i in range(30_000)), "en", "d"), (10, "é 中文 😀 <|im_end|> a b", "fr", "d"),
        (11, "x" * 40_000, "en", "d"), (12, "same " * 300, "en", "a"), (4, "another text of the same id", "en", "b"),
    ]
    names = ("size", "key", "mix", "screen", "ids", "decoded", "fingerprint", "f", "dedup", "mark", "spans", "score",
             "label", "id", "x", "half", "n", "hash")
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit(-1).alias(c) for c in names]).repartition(3)


def plain(rows, names):
    return sorted([tuple(r[c] for c in names) for r in rows], key=lambda r: [(x is not None, str(x)) for x in r])


@pytest.fixture(scope="session")
def same_as_sql(spark, oracle):
    def check(name):
        from civicstat.llm.queries import QUERIES, SQL
        df = QUERIES[name](spark, SF)
        cur = oracle.execute(SQL[name])
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(df.columns)
        want = [dict(zip(names, r)) for r in cur.fetchall()]
        assert plain(df.collect(), names) == plain(want, names)
    return check
