import numpy as np
import pytest
from pyspark.sql import functions as F

from civicstat.llm import common, language, quality, toxicity
from civicstat.llm.queries import QUERIES

SF01 = "/root/testdata/sf0.01"


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(len(order))
    n1 = label.sum()
    return (rank[label == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * (len(label) - n1))


@pytest.mark.parametrize("name,label,least", [("op2_quality_classifier", "quality", 0.98), ("op5_toxicity", "toxic", 0.85)])
def test_held_out_ranking(spark, name, label, least):
    rows = QUERIES[name](spark, SF01).join(common.table(spark, SF01, "labels"), "doc_id").where("held_out").collect()
    assert auc(np.array([r.score for r in rows]), np.array([r[label] for r in rows])) >= least
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_languages(spark):
    rows = QUERIES["op7_language_id"](spark, SF01).join(common.table(spark, SF01, "documents"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) >= 0.97


@pytest.mark.parametrize("digest,label", [(quality.quality_digest, "quality"), (toxicity.toxicity_digest, "toxic")])
def test_odd_rows_and_missing_labels(spark, odd, digest, label):
    schema = f"doc_id long, {label} int"
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 13)] + [(1, 1), (6, 1), (None, 1), (3, None)], schema)
    rows = digest(odd, labels).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    same = [r.score for r in rows if r.doc_id == 2]
    assert len(same) == 2 and same[0] == same[1]
    for few in (spark.createDataFrame([], schema), spark.createDataFrame([(1, 1), (8, 1)], schema)):
        assert {r.score for r in digest(odd, few).collect()} in ({0.0}, {1.0})
    assert digest(odd.limit(0), labels).count() == 0


def test_contradicting_labels_are_left_out(spark):
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (2, 1), (3, None)], "doc_id long, quality int")
    assert [tuple(r) for r in common.one_label(labels, "quality").collect()] == [(2, 1)]


def test_quality_model_is_the_gaussian_ratio():
    rng = np.random.default_rng(1)
    d = len(quality.NAMES)
    means, a = rng.normal(size=(2, d)), rng.normal(size=(2, d, d))
    covs = a @ a.transpose(0, 2, 1) + np.eye(d)
    factors = np.linalg.cholesky(covs)
    model = quality.Model(means, factors, np.log(np.diagonal(factors, axis1=1, axis2=2)).sum(axis=1), 0.3)
    x = rng.normal(size=(5, d))
    logs = [-0.5 * np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m) - 0.5 * np.linalg.slogdet(c)[1] for m, c in zip(means, covs)]
    assert np.allclose(model.score(x), 1 / (1 + np.exp(-(logs[1] - logs[0] + 0.3))))


def test_probabilities_of_each_context_sum_to_one():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 3, toxicity.SYMBOLS ** 2).astype(np.float32)
    p = toxicity._level(counts, np.full(toxicity.SYMBOLS, 1 / toxicity.SYMBOLS, np.float32)).reshape(-1, toxicity.SYMBOLS)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)


def test_grams_stay_inside_words():
    n = toxicity.SYMBOLS
    assert toxicity.grams("ab  c").tolist() == [1, n + 2, (n + 2) * n, 3, 3 * n]
    assert toxicity.grams(None).tolist() == [0] == toxicity.grams(" 12 ").tolist()


def test_messages_are_exact():
    rng = np.random.default_rng(0)
    e, moves, counts = rng.normal(size=(200, 3)), np.exp(rng.normal(size=(3, 3))), np.array([1, 100, 0, 33, 66])
    alpha, beta = language.messages(e, moves, counts)
    got, at = language._scaled(alpha * beta), 0
    for n in counts[counts > 0]:
        x, f, b = np.exp(e[at:at + n]), np.zeros((n, 3)), np.ones((n, 3))
        f[0] = x[0]
        for t in range(1, n):
            f[t] = language._scaled((f[t - 1] @ moves) * x[t])
        for t in range(n - 2, -1, -1):
            b[t] = language._scaled(moves @ (x[t + 1] * b[t + 1]))
        assert np.allclose(language._scaled(f * b), got[at:at + n])
        at += n


def test_languages_of_odd_rows(spark, odd):
    rows = language.language_digest(odd).collect()
    assert len(rows) == odd.count()
    got = {(r.doc_id, r.lang_pred) for r in rows}
    assert {(3, "und"), (5, "und"), (7, "und")} <= got
    assert all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in language.language_digest(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.language_digest(odd.limit(0)).count() == 0


def test_expressions_of_ordinary_words_in_any_script(spark):
    # both classes have the same words equally often, only their order differs
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for script, (a, b) in enumerate((("green", "paper"), ("зелёный", "бумага"), ("s4", "p9"))):
        for k in range(60):
            fill = [f"{chr(97 + script)}{x}" for x in rng.integers(0, 40, 12)]
            pair, i = ([a, b] if k % 2 else [b, a]), len(rows)
            rows.append((i, " ".join([*fill[:6], *pair, *fill[6:], *pair])))
            labels.append((i, k % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([x for x in labels if x[0] % 3], "id long, label int")
    got = {r.doc_id: r.score for r in toxicity.classify(docs, known, F.floor(F.col("id") / 2) % 2).collect()}
    held = [x for x in labels if x[0] % 3 == 0]
    assert auc(np.array([got[i] for i, _ in held]), np.array([y for _, y in held])) > 0.95
