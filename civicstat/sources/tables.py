"""Parquet scans of the driver tables and the three fact roles built from them.

Roles (see FIXTURES.md, part B):

* enrollments        one row per order: orders ⋈ customer ⋈ nation ⋈ region
* biometric_attempts one row per order: Σ lineitem ⋈ orders ⋈ customer ⋈ geo
* demographic_updates one row per line: lineitem ⋈ supplier ⋈ geo

Each scan selects only the columns it needs, so ``ReadSchema`` is pruned.
Joins are left to Catalyst/AQE (sort-merge at scale).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicstat.schemas import INPUT_TABLES
from civicstat.session import materialize

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Fixed role mapping constants (FIXTURES.md part B).
PINCODE_BASE = 100000
AGE_0_5_PRICE_UNIT = 10000
AGE_5_17_MOD = 50
AGE_18_MOD = 100
BIO_17_FACTOR = 5


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    reader = spark.read.schema(INPUT_TABLES[name]) if name in INPUT_TABLES else spark.read
    df = reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation ⋈ region → (nationkey, state, district). Catalyst broadcasts it
    by its size; a larger dimension joins like any other table."""
    nation = read(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = read(spark, sf_dir, "region", "r_regionkey", "r_name")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey").alias("nationkey"),
                    F.col("r_name").alias("state"),
                    F.col("n_name").alias("district")))


def _orders_geo(spark: SparkSession, sf_dir: str, g: DataFrame | None = None) -> DataFrame:
    orders = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    cust = read(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    g = geo(spark, sf_dir) if g is None else g
    return (orders.join(cust, orders.o_custkey == cust.c_custkey)
            .join(g, F.col("c_nationkey") == F.col("nationkey")))


# what enrollments_columns reads
ORDER_COLUMNS = ("o_orderdate", "state", "district", "c_custkey", "o_totalprice", "o_custkey")


def enrollments(spark: SparkSession, sf_dir: str, g: DataFrame | None = None) -> DataFrame:
    return enrollments_columns(_orders_geo(spark, sf_dir, g))


def enrollments_columns(o: DataFrame, *keep: str) -> DataFrame:
    return o.select(
        *keep,
        F.to_date("o_orderdate").alias("date"),
        "state", "district",
        (F.lit(PINCODE_BASE) + F.col("c_custkey")).cast("string").alias("pincode"),
        F.floor(F.col("o_totalprice") / AGE_0_5_PRICE_UNIT).cast("int").alias("age_0_5"),
        (F.col("o_custkey") % AGE_5_17_MOD).cast("int").alias("age_5_17"),
        (F.col("o_orderkey") % AGE_18_MOD).cast("int").alias("age_18_greater"),
    )


def biometric_attempts(spark: SparkSession, sf_dir: str, g: DataFrame | None = None) -> DataFrame:
    """Order grain: the lines of an order share date, state, district and
    pincode, so their counts are summed per order before the join (eager
    aggregation). Every consumer only sums these columns, so the results
    are those of the line grain, while the largest join input shrinks by
    the lines per order and the partial aggregate collapses the lines that
    the file stores together before any shuffle."""
    li = (read(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity", "l_linenumber")
          .groupBy("l_orderkey")
          .agg(F.sum(F.col("l_quantity").cast("int")).alias("q"),
               F.sum(F.col("l_linenumber") * BIO_17_FACTOR).alias("n")))
    o = _orders_geo(spark, sf_dir, g).select("o_orderkey", "o_orderdate", "c_custkey", "state", "district")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.to_date("o_orderdate").alias("date"),
        "state", "district",
        (F.lit(PINCODE_BASE) + F.col("c_custkey")).cast("string").alias("pincode"),
        F.col("q").cast("int").alias("bio_age_5_17"),
        F.col("n").cast("int").alias("bio_age_17_"),
    )


def biometric_lines(spark: SparkSession, sf_dir: str, g: DataFrame | None = None) -> DataFrame:
    """Line grain, for figures that count raw rows."""
    li = read(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity", "l_linenumber")
    o = _orders_geo(spark, sf_dir, g).select("o_orderkey", "o_orderdate", "state", "district")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.to_date("o_orderdate").alias("date"), "state", "district", F.col("l_quantity").cast("int").alias("bio_age_5_17"),
        (F.col("l_linenumber") * BIO_17_FACTOR).cast("int").alias("bio_age_17_"))


def demographic_updates(spark: SparkSession, sf_dir: str, g: DataFrame | None = None) -> DataFrame:
    li = read(spark, sf_dir, "lineitem", "l_suppkey", "l_quantity", "l_linenumber", "l_shipdate")
    supp = read(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    g = geo(spark, sf_dir) if g is None else g
    return (li.join(supp, li.l_suppkey == supp.s_suppkey)
            .join(g, F.col("s_nationkey") == F.col("nationkey"))
            .select(
                F.to_date("l_shipdate").alias("date"),
                "state", "district",
                (F.lit(PINCODE_BASE) + F.col("s_suppkey")).cast("string").alias("pincode"),
                F.col("l_quantity").cast("int").alias("demo_age_5_17"),
                F.col("l_linenumber").cast("int").alias("demo_age_17_"),
            ))


def daily_totals(spark: SparkSession, sf_dir: str, g: DataFrame | None = None) -> DataFrame:
    """Enrollments and attempts summed to (date, state, district) in one pass
    over orders and lines. A key has a row for each pattern of NULL age
    columns, so that sums over it skip the same rows as sums over the fact."""
    e = enrollments_columns(_orders_geo(spark, sf_dir, g).select("o_orderkey", *ORDER_COLUMNS), "o_orderkey")
    li = (read(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity", "l_linenumber")
          .groupBy("l_orderkey")
          .agg(F.sum(F.col("l_quantity").cast("int")).alias("bio_age_5_17"),
               F.sum(F.col("l_linenumber") * BIO_17_FACTOR).alias("bio_age_17_")))
    ages = ["age_0_5", "age_5_17", "age_18_greater"]
    return (e.join(li, e["o_orderkey"] == li["l_orderkey"], "left")
            .groupBy("date", "state", "district", *[F.col(c).isNull().alias(f"no_{c}") for c in ages])
            .agg(*[F.sum(c).alias(c) for c in (*ages, "bio_age_5_17", "bio_age_17_")], F.count("l_orderkey").alias("attended"))
            .drop(*[f"no_{c}" for c in ages]))


class Facts:
    """Lazily built role DataFrames for one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._geo = self._daily = self._days = None

    @property
    def geo(self) -> DataFrame:
        if self._geo is None:
            self._geo = geo(self.spark, self.sf_dir)
        return self._geo

    @property
    def enrollments(self) -> DataFrame:
        return enrollments(self.spark, self.sf_dir, self.geo)

    @property
    def biometric(self) -> DataFrame:
        return biometric_attempts(self.spark, self.sf_dir, self.geo)

    @property
    def days(self) -> DataFrame:
        """Enrollments and attempts at day grain, from one pass over orders
        (or from the written table, if there is one)."""
        if self._daily is not None:
            return self._daily
        if self._days is None:
            self._days = daily_totals(self.spark, self.sf_dir, self.geo)
        return self._days

    @property
    def daily(self) -> tuple[DataFrame, DataFrame]:
        """(enrollments, attempts) at day grain, from one written table."""
        if self._daily is None:
            self._daily = materialize(self.days)
        keys = ["date", "state", "district"]
        return (self._daily.select(*keys, "age_0_5", "age_5_17", "age_18_greater"),
                self._daily.where("attended > 0").select(*keys, "bio_age_5_17", "bio_age_17_"))

    @property
    def demographic(self) -> DataFrame:
        return demographic_updates(self.spark, self.sf_dir, self.geo)

    def table(self, name: str, *cols: str) -> DataFrame:
        return read(self.spark, self.sf_dir, name, *cols)


def scan_sql(spark: SparkSession, view: str, state=None, district=None, start=None, end=None) -> DataFrame:
    """S10 as SQL with bound parameters (no values pasted into the text):
    the enrollments columns of ``view`` for an optional scope and date range."""
    where, args = ["1 = 1"], {}
    if state:
        where.append("state = :state")
        args["state"] = state
    if district:
        where.append("district = :district")
        args["district"] = district
    if start:
        where.append("date >= CAST(:start AS DATE)")
        args["start"] = str(start)
    if end:
        where.append("date <= CAST(:end AS DATE)")
        args["end"] = str(end)
    q = (f"SELECT date, state, district, age_0_5, age_5_17, age_18_greater FROM {view} "
         f"WHERE {' AND '.join(where)}")
    return spark.sql(q, args=args)


def raw_exports(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three datasets as text, with the values that offices would get
    wrong left as the tables have them: account balances (some negative) as
    the first metric, ISO dates on pending orders and finished lines, names
    where the pincode belongs, and a priority text in a number column.
    """
    def text(c) -> Column:
        return c.cast("string")

    def day(c, iso) -> Column:
        return F.when(iso, F.date_format(c, "yyyy-MM-dd")).otherwise(F.date_format(c, "dd-MM-yyyy"))

    g = geo(spark, sf_dir)
    cust = read(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    orders = (read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
              .join(cust, F.col("o_custkey") == F.col("c_custkey")).join(g, F.col("c_nationkey") == F.col("nationkey")))
    home = [day(F.col("o_orderdate"), F.col("o_orderstatus") == "P").alias("date"), F.col("state"), F.col("district"),
            F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.col("c_name"))
            .otherwise(text(F.lit(PINCODE_BASE) + F.col("c_custkey"))).alias("pincode")]
    balance = text(F.floor("c_acctbal").cast("long"))
    lines = read(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate")
    supp = read(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    shipped = (lines.join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
               .join(g, F.col("s_nationkey") == F.col("nationkey")))
    return {
        "enrollment": orders.select(
            *home, balance.alias("age_0_5"),
            F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.col("o_orderpriority"))
            .otherwise(text(F.col("o_custkey") % AGE_5_17_MOD)).alias("age_5_17"),
            text(F.col("o_orderkey") % AGE_18_MOD).alias("age_18_greater")),
        "biometric": lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            *home, balance.alias("bio_age_5_17"), text(F.col("l_linenumber") * BIO_17_FACTOR).alias("bio_age_17_")),
        "demographic": shipped.select(
            day(F.col("l_shipdate"), F.col("l_linestatus") == "F").alias("date"), "state", "district",
            F.when(F.col("l_returnflag") == "R", F.col("s_name"))
            .otherwise(text(F.lit(PINCODE_BASE) + F.col("s_suppkey"))).alias("pincode"),
            text(F.floor("s_acctbal").cast("long")).alias("demo_age_5_17"), text(F.col("l_linenumber")).alias("demo_age_17_")),
    }
