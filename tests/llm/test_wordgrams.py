"""The weights of word n-grams against a plain version."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from civicstat.llm import gramblocks, wordgrams

D = wordgrams.DISCOUNT


def plain_weights(rows, model):
    """rows: (text, label, half) -> {gram of 1 to 3 words: weight}."""
    counts = [Counter(), Counter()]
    for text, label, half in rows:
        if model == 0 or half == 2 - model:
            s = ["<", "<", *wordgrams.words(text), ">"]
            counts[label].update(zip(s, s[1:], s[2:]))
    grams = {3: counts}
    for size in (2, 1):  # below three a gram counts the kinds before it
        grams[size] = [Counter(g[1:] for g in c) for c in grams[size + 1]]
    either = Counter(g[1:] for g in set(grams[2][0]) | set(grams[2][1]))
    every = {g for size in grams for c in grams[size] for g in c}
    kinds, total = Counter(), Counter()
    for size in grams:
        for y in (0, 1):
            for g, n in grams[size][y].items():
                kinds[size, y, g[:-1]] += 1
                total[size, y, g[:-1]] += n

    def lower(y, g):
        """Probability of the gram one shorter."""
        if len(g) == 1:
            share = D * len(either) / (len(either) + 1)
            return max((max(either[g] - D, 0) + share) / max(sum(either.values()), 1), 1e-12)
        return chance(y, g[1:])

    def more(y, g):
        k = kinds[len(g), y, g[:-1]]
        return 1 + max(grams[len(g)][y][g] - D, 0) / (D * k * lower(y, g)) if k else 1.0

    def chance(y, g):
        k, t = kinds[len(g), y, g[:-1]], total[len(g), y, g[:-1]]
        return (D * k / t if k else 1.0) * lower(y, g) * more(y, g)

    return {g: math.log(more(1, g)) - math.log(more(0, g)) for g in every}


def key(gram):
    of = {"<": wordgrams._BEGIN, ">": wordgrams._END}
    w = [np.array([of[x] if x in of else np.uint64(xxhash.xxh3_64_intdigest(x.encode()))]) for x in gram]
    pad = [np.zeros(1, np.uint64)] * (3 - len(w))
    return int(wordgrams.keys(*pad, *w)[len(gram) - 1].view(np.int64)[0])


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    words = ["a", "b", "c", "dd", "зло", "s4", "Ä", "x.y"]
    return [(" ".join(rng.choice(words[:4] if label else words) for _ in range(rng.randrange(0, 9))), label, rng.randrange(2))
            for label in (0, 1, 0) for _ in range(12)]


def test_weights_equal_the_plain_model(spark, rows):
    df = spark.createDataFrame(rows, "text string, label int, half int").repartition(3)
    got = {(r["size"], r.key): r for r in wordgrams.weigh(wordgrams.count_trigrams(df)).collect()}
    for model in range(wordgrams.MODELS):
        want = plain_weights(rows, model)
        for g, weight in want.items():
            assert got[len(g), key(g)][f"d{model}"] == pytest.approx(weight, abs=1e-9)
    assert len(got) == len(plain_weights(rows, 0))


def test_sums_of_documents(spark, rows):
    df = spark.createDataFrame(rows, "text string, label int, half int")
    weights = wordgrams.weigh(wordgrams.count_trigrams(df))
    docs = [(1, 0, "a b b c"), (2, 1, "b зло a b"), (3, 0, "nothing known here"), (4, 1, "")]
    got = {r.row: r for r in wordgrams.sums(spark.createDataFrame(docs, "row long, half int, text string"), weights).collect()}
    for row, half, text in docs:
        s = ["<", "<", *wordgrams.words(text), ">"]
        for suffix, model in (("", 0), ("x", 1 if half == 0 else 2)):
            weight = plain_weights(rows, model)
            for size in (1, 2, 3):
                all_ = plain_weights(rows, 0)
                own = [weight.get(tuple(s[j - size + 1:j + 1]), 0.0) for j in range(2, len(s)) if tuple(s[j - size + 1:j + 1]) in all_]
                for kind, sign in (("more", 1), ("less", -1)):
                    want = sum(max(sign * x, 0.0) for x in own)
                    assert (got[row][f"{kind}{size}{suffix}"] if row in got else 0.0) == pytest.approx(want, abs=1e-9)


def test_blocks_give_the_sums_of_rows(spark, rows):
    df = spark.createDataFrame(rows, "text string, label int, half int").repartition(3)
    weights = wordgrams.weigh(wordgrams.count_trigrams(df))
    texts = ["a b b c", "b зло a b", "nothing known here", "", None, *[t for t, _, _ in rows[:8]], "a b b c"]
    docs = spark.createDataFrame([(i % 13 * 7 - 5, i % 2, t) for i, t in enumerate(texts)], "row long, half int, text string").repartition(2)
    want = {r.row: r for r in wordgrams.sums(docs, weights).collect()}
    for size in (0, 3 * gramblocks.BUCKET_BYTES):  # one bucket and three
        model = gramblocks.learn(gramblocks.encode(df), size)
        got = {r.row: r for r in gramblocks.sums(docs, model).collect()}
        model.drop()
        assert len(got) == len({i % 13 for i in range(len(texts))})
        for row, r in got.items():
            for c in wordgrams.PARTS:
                for x in ("", "x"):
                    assert r[c + x] == pytest.approx(want[row][c + x] if row in want else 0.0, abs=1e-9)


def test_blocks_of_a_tiny_chunk_and_no_labels(spark, rows):
    a, b = (np.array(x, np.uint64) for x in ([3, 2**63, 2**64 - 1], []))
    got = gramblocks.unpack(gramblocks.pack(gramblocks._steps(a), b, np.arange(6).reshape(2, 3)))
    assert gramblocks._summed(got[0]).tolist() == a.tolist() and got[1].size == 0 and got[2].tolist() == [[0, 1, 2], [3, 4, 5]]
    docs = spark.createDataFrame([(1, 0, "a b"), (2, None, None)], "row long, half int, text string")
    model = gramblocks.learn(gramblocks.encode(spark.createDataFrame(rows[:1], "text string, label int, half int").limit(0)), 10)
    assert {r.row: sum(r[c] for c in wordgrams.PARTS) for r in gramblocks.sums(docs, model).collect()} == {1: 0.0, 2: 0.0}
    model.drop()
