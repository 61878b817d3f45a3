"""Risk features, classifier training and scoring with Spark ML.

Training set (J2): each fact is summed to (date, state, district) first,
then enrollments ⟕ biometric ⟕ demographic 1:1 on that key, then summed to
months. The three aggregates share the same hash partitioning, so the two
left joins need no further shuffle; sums are not inflated by the
many-to-many fan-out of raw rows.
"""

from __future__ import annotations

import math
import time
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicstat.functions.scalar import optional_filter, round_half_even
from civicstat.schemas import KEYS
from civicstat.session import checkpoint_dir, materialize

# Fixed values of the reference model.
FEATURES = ["success_rate", "update_freq", "density", "growth_rate",
            "roll_success_3m", "roll_success_6m", "roll_success_12m",
            "roll_update_3m", "roll_update_6m", "roll_update_12m"]
WINDOWS = (3, 6, 12)
TARGET_SHIFT = 3
DEFAULT_RISK_THRESHOLD = 60.0
MIN_TRAIN_ROWS = 50
TREES, DEPTHS = (50, 100), (5, 10)
ROUNDS, STEPS = (50, 100), (0.05, 0.1)
FOLDS = 3
SEED = 42
HIGH_CUT, MEDIUM_CUT = 0.7, 0.4
# Fixed texts.
INSUFFICIENT = "Insufficient data for training."
NOT_TRAINED = "Model not trained yet."
NO_DATA = "No data for district"
ROWS_PER_PARTITION = 200_000


def training_set(enr: DataFrame, bio: DataFrame, demo: DataFrame) -> DataFrame:
    """Q19: monthly enrollments / biometric attempts / demographic updates per district."""
    e = enr.groupBy(*KEYS).agg(F.sum(F.col("age_5_17") + F.col("age_18_greater")).alias("e"))
    b = bio.groupBy(*KEYS).agg(F.sum(F.col("bio_age_5_17") + F.col("bio_age_17_")).alias("b"))
    d = demo.groupBy(*KEYS).agg(F.sum(F.col("demo_age_5_17") + F.col("demo_age_17_")).alias("d"))
    return monthly(e.join(b, KEYS, "left").join(d, KEYS, "left"))


def training_set_from_days(days: DataFrame, demo: DataFrame) -> DataFrame:
    """Q19 from a day table that has enrollments and attempts side by side
    (``sources.tables.daily_totals``)."""
    eb = days.groupBy(*KEYS).agg(F.sum(F.col("age_5_17") + F.col("age_18_greater")).alias("e"),
                                 F.sum(F.col("bio_age_5_17") + F.col("bio_age_17_")).alias("b"))
    d = demo.groupBy(*KEYS).agg(F.sum(F.col("demo_age_5_17") + F.col("demo_age_17_")).alias("d"))
    return monthly(eb.join(d, KEYS, "left"))


def monthly(j: DataFrame) -> DataFrame:
    """Days of the three facts (e, b, d) summed to months."""
    return j.groupBy(F.trunc("date", "MM").alias("month"), "state", "district").agg(
        F.sum("e").alias("enrollments"), F.sum("b").alias("biometric_attempts"),
        F.sum("d").alias("demo_updates"))


def risk_features(train: DataFrame, with_target: bool = True,
                  risk_threshold: float = DEFAULT_RISK_THRESHOLD) -> DataFrame:
    """Q20/Q21: rates, rolling means (rows, min_periods=1), growth, target.

    Growth x/0 is 0 instead of infinity (D2). With the target, the last
    three months of each district have none and are dropped (P12).
    """
    w = Window.partitionBy("state", "district").orderBy("month")
    enr = F.col("enrollments")
    out = train.withColumns({
        "success_rate": F.when(enr > 0, F.col("biometric_attempts") / enr * 100).otherwise(F.lit(0.0)),
        "update_freq": F.when(enr > 0, F.col("demo_updates") / enr).otherwise(F.lit(0.0)),
        "density": enr.cast("double")})
    cols = {}
    for n in WINDOWS:
        frame = w.rowsBetween(-(n - 1), 0)
        cols[f"roll_success_{n}m"] = F.avg("success_rate").over(frame)
        cols[f"roll_update_{n}m"] = F.avg("update_freq").over(frame)
    cols["growth_rate"] = F.coalesce(F.try_divide(enr.cast("double"), F.lag(enr, 1).over(w)) - 1, F.lit(0.0))
    out = out.withColumns(cols)
    if with_target:
        out = (out.withColumn("target_rate", F.lead("success_rate", TARGET_SHIFT).over(w))
               .filter(F.col("target_rate").isNotNull())
               .withColumn("is_high_risk", (F.col("target_rate") < F.lit(risk_threshold)).cast("int")))
    return out


def latest_features(train: DataFrame) -> DataFrame:
    """The newest month of each district, features without target."""
    f = risk_features(train, with_target=False)
    w = Window.partitionBy("state", "district").orderBy(F.desc("month"))
    return f.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def split_hash() -> Column:
    """60 bits of the digest of a row's keys, which any engine computes alike."""
    key = F.concat_ws("|", F.coalesce("state", F.lit("")), F.coalesce("district", F.lit("")), F.date_format("month", "yyyy-MM-dd"))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def rank_cuts(rows: DataFrame, ranks: dict[int, list[int]], bits: int = 12, total: int = 60) -> dict[int, list[int]]:
    """For each class of ``rows`` (label, h) the hashes below which exactly the
    asked numbers of rows lie (repeated hashes stay on one side).

    Rows are counted by the highest bits of their hash; a bin in which a cut
    falls is counted again by the next bits, and so on. The driver gets at most
    2 ** bits counts for each cut and level.
    """
    open_ = {(c, i): (0, r) for c, rs in ranks.items() for i, r in enumerate(rs)}  # prefix, rank inside it
    for level in range(0, total, bits):
        left = total - level - bits
        wanted = sorted({(c, p) for (c, _), (p, _) in open_.items()})
        inside = F.lit(False)
        for c, p in wanted:
            inside = inside | ((F.col("label") == c) & (F.shiftright("h", left + bits) == p))
        counts: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for r in (rows.where(inside).groupBy("label", F.shiftright("h", left).alias("bin")).count().collect()):
            counts.setdefault((int(r["label"]), r["bin"] >> bits), []).append((r["bin"], r["count"]))
        for at, (prefix, rank) in open_.items():
            here, past = (prefix + 1) << bits, 0
            for bin_, n in sorted(counts.get((at[0], prefix), [])):
                if past + n > rank:
                    here = bin_
                    break
                past += n
            open_[at] = (here, rank - past)
    return {c: [open_[c, i][0] for i in range(len(rs))] for c, rs in ranks.items()}


def stratified_split(rows: DataFrame, label: str = "label", test_fraction: float = 0.2, folds: int = 3) -> DataFrame | None:
    """M2/M7: ``rows`` (state, district, month, label, any others) with is_test
    and fold (1 to ``folds``; 0 for the hold-out): within each class the rows
    with the smallest hashes are the hold-out, the rest is dealt to folds in
    equal numbers, to within one row. No class is gathered or sorted anywhere.
    None if a class is too small for a row in the hold-out and every fold.
    """
    hashed = rows.withColumn("_h", split_hash())
    keyed = hashed.select(F.col(label).cast("int").alias("label"), F.col("_h").alias("h"))
    sizes = {r["label"]: r["count"] for r in keyed.groupBy("label").count().collect()}
    ranks = {}
    for c, n in sizes.items():
        test = max(1, int(round(n * test_fraction)))
        rest = n - test
        if rest < folds:
            return None
        ranks[c] = [test + rest * i // folds for i in range(folds)]
    # one row for each class
    cuts = rank_cuts(keyed, ranks)
    fold = F.lit(None).cast("int")
    for c, edges in cuts.items():
        # the number of cuts at or below the row's hash
        own = reduce(lambda a, b: a + b, [(F.col("_h") >= e).cast("int") for e in edges])
        fold = F.when(F.col(label) == c, own).otherwise(fold)
    return hashed.withColumn("fold", fold).withColumn("is_test", F.col("fold") == 0).drop("_h")


def _preparation() -> Pipeline:
    imputer = Imputer(strategy="mean", inputCols=FEATURES, outputCols=[f"{c}_i" for c in FEATURES])
    assembler = VectorAssembler(inputCols=[f"{c}_i" for c in FEATURES], outputCol="raw_features",
                                handleInvalid="keep")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    return Pipeline(stages=[imputer, assembler, scaler])


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The boosted model after its first rounds: boosting adds a tree to those
    it has, so a longer fit holds the shorter one."""
    trees, weights = model._java_obj.trees(), model.treeWeights
    sc = SparkSession.active().sparkContext
    jvm = sc._jvm.org.apache.spark.ml
    some = sc._gateway.new_array(jvm.regression.DecisionTreeRegressionModel, rounds)
    shares = sc._gateway.new_array(sc._gateway.jvm.double, rounds)
    for i in range(rounds):
        some[i], shares[i] = trees[i], float(weights[i])
    return GBTClassificationModel(jvm.classification.GBTClassificationModel(f"{model.uid}_{rounds}", some, shares))


def _forest(trees: int, depth: int) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol="label", featuresCol="features", seed=SEED, numTrees=trees, maxDepth=depth)


def _boosted(rounds: int, step: float) -> GBTClassifier:
    return GBTClassifier(labelCol="label", featuresCol="features", seed=SEED, maxDepth=3, maxIter=rounds, stepSize=step)


def search_models(train: DataFrame, folds: int, parallelism: int) -> tuple[dict, dict]:
    """Mean F1 over the folds of every setting of both families, and the
    seconds spent on each family's fits.

    The preparation is fitted once per fold, and its result is written and read
    by all fits of the fold. Boosted trees of 50 rounds are read off the fit of
    100. Fits of all folds run side by side, as each is many small jobs.
    """
    evaluator = _evaluator()
    sides = {}
    for k in range(1, folds + 1):
        rest, own = train.where(F.col("fold") != k), train.where(F.col("fold") == k)
        ready = _preparation().fit(rest)
        sides[k] = tuple(materialize(ready.transform(x).select("label", "features")) for x in (rest, own))
    found: dict[tuple, list[float]] = {}
    seconds = {"RF": 0.0, "GBM": 0.0}

    def forest(k: int, trees: int, depth: int) -> None:
        t0 = time.perf_counter()
        rest, own = sides[k]
        score = evaluator.evaluate(_forest(trees, depth).fit(rest).transform(own))
        found.setdefault(("RF", trees, depth), []).append(score)
        seconds["RF"] += time.perf_counter() - t0

    def boosted(k: int, step: float) -> None:
        t0 = time.perf_counter()
        rest, own = sides[k]
        model = _boosted(max(ROUNDS), step).fit(rest)
        for rounds in ROUNDS:
            score = evaluator.evaluate(first_rounds(model, rounds).transform(own))
            found.setdefault(("GBM", rounds, step), []).append(score)
        seconds["GBM"] += time.perf_counter() - t0

    # the longest first
    work = [(boosted, (k, step)) for step in STEPS for k in sides]
    work += [(forest, (k, trees, depth)) for depth in reversed(DEPTHS) for trees in reversed(TREES) for k in sides]
    with ThreadPool(parallelism) as pool:
        pool.map(inheritable_thread_target(lambda w: w[0](*w[1])), work, chunksize=1)
    return {s: sum(v) / len(v) for s, v in found.items()}, seconds


def _evaluator() -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(metricName="fMeasureByLabel", metricLabel=1.0, labelCol="label", predictionCol="prediction")


def train_model(features: DataFrame, parallelism: int = 8, raw_rows: int | None = None):
    """Q22: RF and boosted trees, 3-fold CV on F1 of the positive class.

    Returns (PipelineModel, summary dict) or (None, reason) when the data
    has too few rows, only one class, or a class too small for the split.
    """
    checkpoint_dir(features.sparkSession)
    data = features.select("state", "district", "month", *FEATURES,
                           F.col("is_high_risk").cast("double").alias("label"))
    stats = data.groupBy().agg(F.count(F.lit(1)).alias("n"),
                               F.countDistinct("label").alias("classes")).first()
    # the gate counts raw training rows; features lose the last months of each district
    if (stats["n"] if raw_rows is None else raw_rows) < MIN_TRAIN_ROWS or stats["classes"] < 2:
        return None, {"error": INSUFFICIENT}
    # Cut the lineage once and size the partitions to the row count: every
    # boosting iteration is a job, and empty or tiny partitions only add
    # scheduling work. How rows lie in partitions decides which sample the
    # split candidates of the trees come from, so a fitted model may differ in
    # details between sizes on either side of ROWS_PER_PARTITION.
    parts = max(1, math.ceil(stats["n"] / ROWS_PER_PARTITION))
    keys = ["state", "district", "month"]
    data = data.repartition(parts, *keys).sortWithinPartitions(*keys).checkpoint(eager=True)
    split = stratified_split(data)
    if split is None:
        return None, {"error": INSUFFICIENT}
    train, test = split.filter(~F.col("is_test")), split.filter(F.col("is_test"))
    t0 = time.perf_counter()
    means, seconds = search_models(train, FOLDS, parallelism)
    settings = [("RF", n, d) for n in TREES for d in DEPTHS] + [("GBM", n, s) for n in ROUNDS for s in STEPS]
    best = {}
    for setting in settings:  # the first of equal settings of a family
        if setting[0] not in best or means[setting] > means[best[setting[0]]]:
            best[setting[0]] = setting
    scores = {name: means[setting] for name, setting in best.items()}
    name = "GBM" if scores["GBM"] >= scores["RF"] else "RF"  # ties go to the later family (M8)
    ready = _preparation().fit(train)
    classifier = (_forest if name == "RF" else _boosted)(*best[name][1:])
    model = PipelineModel([*ready.stages, classifier.fit(materialize(ready.transform(train).select("label", "features")))])
    holdout = _evaluator().evaluate(model.transform(test))
    return model, {"model": name, "setting": best[name][1:], "cv_f1": scores[name], "holdout_f1": holdout, "scores": scores,
                   "fit_seconds": {k: round(v, 1) for k, v in seconds.items()}, "seconds": round(time.perf_counter() - t0, 1)}


def top_factors(model: PipelineModel, k: int = 3) -> list[str]:
    """T5: names of the k largest global feature importances."""
    imp = model.stages[-1].featureImportances.toArray()
    return [FEATURES[i] for i in sorted(range(len(FEATURES)), key=lambda i: -imp[i])[:k]]


def predict_risk(model: PipelineModel, latest: DataFrame, state=None, district=None) -> DataFrame:
    """Q23: P(high risk) for the newest month of every (or one) district."""
    latest = optional_filter(latest, state=state, district=district)
    scored = model.transform(latest)
    # the category goes by the raw probability, only the reported score is rounded
    p = vector_to_array("probability")[1]
    category = F.when(p > HIGH_CUT, "High").when(p > MEDIUM_CUT, "Medium").otherwise("Low")
    factors = F.array(*[F.lit(f) for f in top_factors(model)])
    return (scored.select("state", "district", round_half_even(p, 2).alias("risk_score"), category.alias("risk_category"))
            .withColumn("top_factors", factors))


def risk_rows(model: PipelineModel | None, latest: DataFrame, asked: DataFrame) -> DataFrame:
    """Q23 for a list of districts: a row for every row of ``asked`` (state,
    district) with the score, or with ``error`` and no score: there is no model,
    or no data of that district."""
    asked = asked.select("state", "district").distinct()
    if model is None:
        return asked.select("state", "district", F.lit(None).cast("double").alias("risk_score"), F.lit(None).cast("string").alias("risk_category"),
                            F.lit(None).cast("array<string>").alias("top_factors"), F.lit(NOT_TRAINED).alias("error"))
    scored = predict_risk(model, latest).withColumnsRenamed({"state": "_s", "district": "_d"})
    same = F.col("state").eqNullSafe(F.col("_s")) & F.col("district").eqNullSafe(F.col("_d"))
    return asked.join(scored, same, "left").drop("_s", "_d").withColumn(
        "error", F.when(F.col("risk_score").isNull(), F.lit(NO_DATA)))


def save_model(model: PipelineModel, path: str) -> None:
    """Persist the fitted pipeline (overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
