"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Each document gets the key ``-ln(u) / w``: u is a uniform number made from a
digest of its id, w its quality weight. Within a source the smallest keys
form a weighted sample without replacement. A source first takes all its
documents for each complete epoch of its target; for the rest, documents go
by key while the sum of sizes before them plus half their own stays below
the rest, so a source misses its target by half a document at most.

The order within a source is not found by sorting a source in one task. Keys
are cut into ``bins`` by a fixed increasing function; sizes are summed by
(source, bin), which collapses a hot source before the shuffle; the bin where
the budget ends is cut again in the same way, and once more; only the few
documents of the last bin are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicstat.llm.common import WORD, cut, fresh

#: Weights of the sources in code point order, repeating; null comes last.
SOURCE_WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
#: Bins of a level and levels: a bin of the last one is 2 ** -36 of all keys.
BINS, LEVELS = 4096, 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _weight(chars: Column, size: Column) -> Column:
    mean = chars.cast("double") / F.greatest(size, F.lit(1)).cast("double")
    return F.lit(1.0) + F.least(F.coalesce(mean, F.lit(0.0)), F.lit(10.0)) / 10.0


def quality_weight(text: Column, size: Column) -> Column:
    """Between 1 and 2, growing with the code points a word takes up to ten:
    strings of single marks and digits weigh less than prose. Empty texts weigh 1."""
    return _weight(F.length(text), size)


def exponential_key(doc_id: Column, weight: Column) -> Column:
    """-ln(u) / weight, with u in (0, 1) from 52 bits of the id's MD5."""
    hexa = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")), 1, 13)
    u = (F.conv(hexa, 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / weight


def _bins(key: Column, bins: int) -> list[Column]:
    """The bin of a key on each level: a level cuts each bin of the one before."""
    at, out = F.least(1.0 - F.exp(-key), F.lit(1 - 2.0 ** -53)), []
    for _ in range(LEVELS):
        at = at * bins
        out.append(F.floor(at).cast("int"))
        at = at - F.floor(at)
    return out


def source_targets(sizes: DataFrame, share: float = SHARE, weights: tuple = SOURCE_WEIGHTS,
                   most: int = MOST_EPOCHS) -> DataFrame:
    """``sizes`` (source, source_size: one row per source) with weight and target.

    Sharing the excess of full sources by weight until none is above its
    limit ends where every source has min(level * weight, limit). Sources
    reach their limit in the order of limit / weight, so the level follows
    from running sums over one row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    k = (F.row_number().over(by_name) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (k + 1).cast("int"))
    s = sizes.withColumn("weight", w).withColumn("limit", (F.col("source_size") * most).cast("double"))
    every = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = Window.partitionBy(F.lit(0)).orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    up = filled.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "all": F.sum("source_size").over(every).cast("double") * share,
        "used": F.coalesce(F.sum("limit").over(up), F.lit(0.0)),
        "open": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(up), F.lit(0.0))})
    # the level if the sources before this one are full; the first source that
    # stays below its limit at that level fixes the level
    s = s.withColumn("level", (F.col("all") - F.col("used")) / F.col("open"))
    below = F.when(F.col("level") * F.col("weight") < F.col("limit"),
                   F.struct((F.col("limit") / F.col("weight")).alias("at"), "level"))
    s = s.withColumn("final", F.min(below).over(every)["level"])
    target = F.when(F.col("final").isNull(), F.col("limit")).otherwise(
        F.least(F.col("final") * F.col("weight"), F.col("limit")))
    return s.select("source", "source_size", "weight", target.alias("target"))


def cut_points(sizes: DataFrame, share: float = SHARE, weights: tuple = SOURCE_WEIGHTS, bins: int = BINS) -> DataFrame:
    """Where the budget of each source ends, from ``sizes`` (source, size, key):
    of, source_size, target, epochs, rest, edges (the bin of each level) and
    start (the sizes before the last of these bins).

    A level sums sizes by (source, bin) inside the bin where the level before
    ended, so after the last one the bin holds a row or two of any source.
    """
    levels = [f"b{i}" for i in range(LEVELS)]
    rows = sizes.withColumns(dict(zip(levels, _bins(F.col("key"), bins))))
    plan = None
    for i, level in enumerate(levels):
        inside = rows
        if plan is not None:
            own = plan.select("of", *[F.col(f"edges.{x}").alias(f"e{x}") for x in levels[:i]])
            inside = rows.join(own, rows["source"].eqNullSafe(own["of"])).where(
                " AND ".join(f"{x} = e{x}" for x in levels[:i]))
        sums = cut(inside.groupBy(F.col("source").alias("source"), F.col(level).alias("bin")).agg(F.sum("size").alias("words")))
        if plan is None:
            targets = source_targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), share, weights)
            whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
            plan = targets.select(F.col("source").alias("of"), "source_size", "target", whole.alias("epochs"),
                                  (F.col("target") - whole * F.col("source_size")).alias("rest"),
                                  F.struct().alias("edges"), F.lit(0).cast("long").alias("start"))
        run = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        before = sums.withColumn("before", F.coalesce(F.sum("words").over(run), F.lit(0)))
        # the last bin that begins below the rest is where the budget ends
        edge = (before.join(plan, before["source"].eqNullSafe(plan["of"])).where(F.col("start") + F.col("before") < F.col("rest"))
                .groupBy("source").agg(F.max(F.struct("bin", "before")).alias("edge")))
        names = levels[:i]
        plan = cut(plan.join(edge, plan["of"].eqNullSafe(edge["source"]), "left").select(
            "of", "source_size", "target", "epochs", "rest",
            F.struct(*[F.col(f"edges.{x}").alias(x) for x in names], F.coalesce("edge.bin", F.lit(-1)).alias(level)).alias("edges"),
            (F.col("start") + F.coalesce("edge.before", F.lit(0))).alias("start")))
    return plan


def mix(docs: DataFrame, size: Column | None = None, weight: Column | None = None, share: float = SHARE,
        weights: tuple = SOURCE_WEIGHTS, bins: int = BINS, key: Column | None = None) -> tuple[DataFrame, str]:
    """``docs`` (doc_id, text, source, any others) with a struct column of
    size, source_size, target and copies: how often the mix takes each row.

    Returns the frame and the name of the struct column, which avoids any
    column ``docs`` has. Null texts have size 0; very long texts count with all
    their words; a null source is a source; a null doc_id is sampled under one
    fixed key. Equal keys go by doc_id; rows that are equal in id share one key
    and one is taken before the other (if the budget ends among them, one task
    orders them). Empty texts take nothing. An empty table gives no row.

    Texts are read twice: once for sizes and keys, which are written without
    the text, and once for the result. ``size`` and ``key`` may be columns that
    ``docs`` already has.
    """
    size = word_count(F.col("text")) if size is None else size
    z, k, *levels = fresh(docs, "size", "key", *[f"bin{i}" for i in range(LEVELS)])
    rows = docs.withColumn(z, size)
    if key is None:
        weight = quality_weight(F.col("text"), F.col(z)) if weight is None else weight
        key = exponential_key(F.col("doc_id"), weight)
    rows = rows.withColumn(k, key)
    plan = cut_points(cut(rows.select("source", F.col(z).alias("size"), F.col(k).alias("key"))), share, weights, bins)

    plan_name, take, out = fresh(rows, "plan", "take", "mix")
    plan = plan.select(F.col("of").alias(plan_name + "_of"), F.struct(*[c for c in plan.columns if c != "of"]).alias(plan_name))
    joined = rows.withColumns(dict(zip(levels, _bins(F.col(k), bins))))
    joined = joined.join(plan, joined["source"].eqNullSafe(plan[plan_name + "_of"])).drop(plan_name + "_of")
    p = F.col(plan_name)
    here, edge = F.struct(*levels), F.struct(*[p["edges"][f"b{i}"] for i in range(LEVELS)])
    clear = joined.where(here != edge).withColumn(take, (here < edge).cast("int"))
    order = (Window.partitionBy("source").orderBy(k, "doc_id")
             .rowsBetween(Window.unboundedPreceding, -1))
    before = F.coalesce(F.sum(z).over(order), F.lit(0)) + p["start"]
    last = joined.where(here == edge)
    last = last.withColumn(take, (before + F.col(z) / 2 < p["rest"]).cast("int"))
    both = clear.unionByName(last)
    found = F.struct(F.col(z).alias("size"), p["source_size"].alias("source_size"), p["target"].alias("target"),
                     (p["epochs"] + F.col(take)).alias("copies"))
    return both.select(*[F.col(f"`{c}`") for c in docs.columns], found.alias(out)), out


def mix_digest(documents: DataFrame) -> DataFrame:
    # sizes and keys once, without the texts
    slim = cut(documents.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.length("text").alias("chars"))
               .select("doc_id", "source", "size", exponential_key(F.col("doc_id"), _weight(F.col("chars"), F.col("size"))).alias("key")))
    mixed, m = mix(slim, size=F.col("size"), key=F.col("key"))
    m = F.col(m)
    return mixed.select("doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"),
                        m["target"].alias("target"), (m["size"] * m["copies"]).cast("long").alias("taken"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, text,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
k AS (
  SELECT doc_id, source, size,
    -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)::DOUBLE + 0.5)
        / 4503599627370496.0)
    / (1.0 + least(coalesce(length(text), 0)::DOUBLE / greatest(size, 1)::DOUBLE, 10.0) / 10.0) AS key FROM d),
s AS (
  SELECT source, sum(size)::DOUBLE AS source_size,
    list_extract([3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE],
      (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1) AS w
  FROM d GROUP BY source),
l AS (
  SELECT *, 2 * source_size AS lim,
    ((SELECT sum(source_size) FROM s) * 1.5
       - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / w, source NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / ((SELECT sum(w) FROM s)
       - coalesce(sum(w) OVER (ORDER BY 2 * source_size / w, source NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS level FROM s),
f AS (SELECT arg_min(level, lim / w) AS final FROM l WHERE level * w < lim),
t AS (
  SELECT source, source_size, CASE WHEN final IS NULL THEN lim ELSE least(final * w, lim) END AS target
  FROM l, f),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
o AS (
  SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
    coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(size * (epochs + CASE WHEN before + size / 2.0 < rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM o
"""
