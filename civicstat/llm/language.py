"""Language identification by a linear-chain conditional random field.

Every word (a run of letters, in lower case) gets a label; a label's weight
at a word is the sum of the weights of the word's features: character pairs
and triples with the word's edges, prefix and suffix up to three letters, and
the word itself if the lexicon has it. Transitions between the labels of
neighbouring words are learned too. Forward-backward gives each word's label
probabilities in its whole text; a text's language is the label with the
largest sum of probabilities, each word counting by its letters.

Training uses the whole texts of at most ``DOCS_PER_LANGUAGE`` documents of
each language, those whose ids have the smallest hashes. Their words are cut
into stretches that alternate between languages at random, so that switches
occur in training as they do in mixed texts. Everything else covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicstat.llm.common import prepare, remainder

#: Bound of the training sample, in documents of each language.
DOCS_PER_LANGUAGE = 150
#: Languages that are learned: those with the most documents.
MOST_LANGUAGES = 500
#: Weights are kept by hashed feature.
BUCKETS = 1 << 16
#: Words that occur so often in one language's sample are in the lexicon.
LEXICON_COUNT = 5
BLOCK = 32
UNKNOWN = "und"
_PRIMES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


@lru_cache(maxsize=1)
def _letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _hash(kind: int, *symbols: np.ndarray) -> np.ndarray:
    h = np.full(len(symbols[0]), kind * 0x165667B1 & 0xFFFFFFFF, np.uint32)
    for s, p in zip(symbols, _PRIMES):
        h = (h ^ s) * p
        h ^= h >> np.uint32(15)
    return (h & np.uint32(BUCKETS - 1)).astype(np.int32)


@dataclass
class Words:
    """The words of many texts, one after another."""

    counts: np.ndarray  # words of each text
    sizes: np.ndarray  # letters of each word
    grams: np.ndarray  # features of the character pairs and triples, two for each symbol
    starts: np.ndarray  # first of each word's grams
    others: np.ndarray  # further features, three columns: prefix, suffix and first letter
    hashes: np.ndarray  # of the whole words


def read_words(texts: list[str | None]) -> Words:
    lower = [(t or "").lower() for t in texts]
    s = np.frombuffer(f"\n{chr(10).join(lower)}\n".encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, lower), np.int64, len(lower)) + 1)
    letter = _letter()[s]
    begin = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    stop = np.flatnonzero(~letter[1:] & letter[:-1]) + 1
    counts = np.diff(np.searchsorted(begin, np.concatenate([[0], ends + 1])))
    sizes = stop - begin
    s = np.where(letter, s, 0).astype(np.uint32)
    # every letter gives the pair and the triple that end just after it
    last = np.flatnonzero(letter) + 1
    a, b, c = s[last - 2], s[last - 1], s[last]
    grams = np.stack([_hash(1, b, c), _hash(2, a, b, c)], axis=1).ravel()
    at = np.cumsum(sizes) - sizes

    def inside(i: np.ndarray, ok: np.ndarray) -> np.ndarray:
        return np.where(ok, s[np.clip(i, 0, len(s) - 1)], 0).astype(np.uint32)

    prefix = _hash(3, s[begin], inside(begin + 1, sizes > 1), inside(begin + 2, sizes > 2))
    suffix = _hash(4, s[stop - 1], inside(stop - 2, sizes > 1), inside(stop - 3, sizes > 2))
    first = _hash(5, s[begin])
    mixed = (s[last - 1].astype(np.uint64) + np.uint64(0x51ED)) * np.uint64(0x9E3779B97F4A7C15)
    place = (np.arange(len(last)) - np.repeat(at, sizes)).astype(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * (2 * place + np.uint64(0xBF58476D1CE4E5B9))
    whole = np.add.reduceat(mixed ^ (mixed >> np.uint64(32)), at) if len(at) else np.zeros(0, np.uint64)
    return Words(counts, sizes, grams, at * 2, np.stack([prefix, suffix, first], axis=1), whole)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # (BUCKETS + lexicon + 1, labels); the last row is 0
    lexicon: np.ndarray  # sorted hashes of words
    moves: np.ndarray  # (labels, labels)

    def features(self, w: Words) -> np.ndarray:
        """Four features of each word beside its grams."""
        at = np.minimum(np.searchsorted(self.lexicon, w.hashes), len(self.lexicon) - 1)
        own = np.where(self.lexicon[at] == w.hashes, BUCKETS + at, BUCKETS + len(self.lexicon))
        return np.concatenate([w.others, own[:, None]], axis=1)

    def marginals(self, w: Words) -> np.ndarray:
        """Label probabilities of every word in its whole text."""
        if not len(w.sizes):
            return np.zeros((0, len(self.labels)))
        e = np.add.reduceat(self.weights[w.grams], w.starts, axis=0) + self.weights[self.features(w)].sum(axis=1)
        alpha, beta = messages(e, np.exp(self.moves), w.counts)
        return _scaled(alpha * beta)


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def messages(emissions: np.ndarray, moves: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward messages of many chains of ``counts`` words at once.

    Chains are cut into blocks. The product of each block's matrices carries
    messages from block to block; then all blocks are worked through in step.
    """
    k = len(moves)
    blocks = -(-counts // BLOCK)
    first = np.cumsum(blocks) - blocks
    n = int(blocks.sum())
    alpha, beta = np.zeros((2, *emissions.shape))
    chain = np.repeat(np.arange(len(counts)), blocks)
    nth = np.arange(n) - first[chain]
    begin = (np.cumsum(counts) - counts)[chain] + nth * BLOCK
    size = np.minimum(counts[chain] - nth * BLOCK, BLOCK)
    e = np.exp(emissions - emissions.max(axis=1, keepdims=True)).astype(np.float64)
    opens = nth == 0

    def word(t: int) -> tuple[np.ndarray, np.ndarray]:
        live = np.flatnonzero(size > t)
        return live, e[begin[live] + t]

    eye = np.eye(k)
    through = np.broadcast_to(eye, (n, k, k)).copy()
    for t in range(BLOCK):
        live, x = word(t)
        m = through[live]
        m = np.where(opens[live, None, None], m, m @ moves) if t == 0 else m @ moves
        m *= x[:, None, :]
        through[live] = m / m.sum(axis=(1, 2), keepdims=True)
    into, after = np.full((n, k), 1 / k), np.full((n, k), 1 / k)
    for j in range(int(blocks.max()) - 1):
        b = first[blocks > j + 1] + j
        into[b + 1] = _scaled((into[b, None, :] @ through[b])[:, 0])
    for j in range(int(blocks.max()) - 1):
        b = (first + blocks - 1 - j)[blocks > j + 1]
        after[b - 1] = _scaled((through[b] @ after[b, :, None])[:, :, 0])
    a = into
    for t in range(BLOCK):
        live, x = word(t)
        step = a[live]
        step = np.where(opens[live, None], step, step @ moves) if t == 0 else step @ moves
        a[live] = alpha[begin[live] + t] = _scaled(step * x)
    b = after
    for t in range(BLOCK - 1, -1, -1):
        live, x = word(t)
        beta[begin[live] + t] = b[live]
        b[live] = _scaled((x * b[live]) @ moves.T)
    return alpha, beta


def train(texts: list[str], langs: list[str], epochs: int = 4, seed: int = 7) -> Model | None:
    """A model of the languages of ``texts``; None without a word. Equal input
    gives an equal model."""
    names = sorted(set(langs))
    rng = np.random.default_rng(seed)
    w = read_words(texts)
    if not len(w.sizes):
        return None
    k = len(names)
    label = np.repeat(np.searchsorted(names, langs), w.counts)
    lexicon = []
    for i in range(k):
        found, n = np.unique(w.hashes[label == i], return_counts=True)
        lexicon.append(found[n >= LEXICON_COUNT])
    lexicon = np.unique(np.concatenate(lexicon))
    if not len(lexicon):
        lexicon = np.zeros(1, np.uint64)
    model = Model(names, np.zeros((BUCKETS + len(lexicon) + 1, k), np.float32), lexicon, np.zeros((k, k)))
    others = model.features(w)
    # stretches of 4 to 40 words, in random order, make chains that switch
    text_of = np.repeat(np.arange(len(texts)), w.counts)
    cut = np.cumsum(rng.integers(4, 41, len(label)))
    edges = np.unique(np.concatenate([cut[cut < len(label)], np.flatnonzero(np.diff(text_of)) + 1, [0]]))
    stops = np.append(edges[1:], len(label))
    seen, seen_moves = np.full(model.weights.shape, 1e-6), np.full((k, k), 1e-6)
    chain_words = 64
    for _ in range(epochs):
        order = rng.permutation(len(edges))
        sizes = (stops - edges)[order]
        words = np.repeat(edges[order] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(label))
        for i in range(0, len(words), 256 * chain_words):
            own = words[i:i + 256 * chain_words]
            counts = np.full(-(-len(own) // chain_words), chain_words)
            counts[-1] = len(own) - chain_words * (len(counts) - 1)
            n = 2 * w.sizes[own]
            grams = w.grams[np.repeat(w.starts[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            more = others[own]
            e = np.add.reduceat(model.weights[grams], np.cumsum(n) - n, axis=0) + model.weights[more].sum(axis=1)
            moves = np.exp(model.moves)
            alpha, beta = messages(e, moves, counts)
            p = _scaled(alpha * beta)
            slope = p.copy()
            slope[np.arange(len(own)), label[own]] -= 1
            ids = np.concatenate([grams, more.ravel()])
            of = np.concatenate([np.repeat(np.arange(len(own)), n), np.repeat(np.arange(len(own)), 4)])
            g = np.stack([np.bincount(ids, slope[of, j], len(model.weights)) for j in range(k)], axis=1) / len(own)
            g += 1e-6 * model.weights
            g[-1] = 0
            seen += g * g
            model.weights -= (0.2 * g / np.sqrt(seen)).astype(np.float32)
            inner = np.ones(len(own), bool)
            inner[np.cumsum(counts) - 1] = False
            left = np.flatnonzero(inner)
            x = np.exp(e - e.max(axis=1, keepdims=True))
            pair = alpha[left][:, :, None] * moves * (x[left + 1] * beta[left + 1])[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            real = np.bincount(label[own[left]] * k + label[own[left + 1]], minlength=k * k).reshape(k, k)
            gm = (pair.sum(axis=0) - real) / len(own) + 1e-4 * model.moves
            seen_moves += gm * gm
            model.moves -= 0.1 * gm / np.sqrt(seen_moves)
    return model


def predict(model: Model | None, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text: the largest share of letters and its label."""
    score = np.zeros(len(texts))
    if model is None:
        return [UNKNOWN] * len(texts), score
    w = read_words(texts)
    some = np.flatnonzero(w.counts)
    best = np.full(len(texts), -1)
    if len(some):
        starts = (np.cumsum(w.counts) - w.counts)[some]
        mass = np.add.reduceat(model.marginals(w) * w.sizes[:, None], starts, axis=0)
        best[some] = mass.argmax(axis=1)
        score[some] = np.minimum(mass.max(axis=1) / mass.sum(axis=1), 1.0)
    return [model.labels[i] if i >= 0 else UNKNOWN for i in best.tolist()], score


def training_sample(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE, most: int = MOST_LANGUAGES) -> DataFrame:
    """(text, lang) of at most ``per_language`` documents of ``docs`` (doc_id,
    text, lang) for each of the ``most`` languages with the most rows: those
    with the smallest hashes of ids.

    Ids are chosen before any text is moved. The counts say below which hash
    three times as many ids as needed are expected; only those are ranked. A
    language with few rows has all of them ranked.
    """
    known = docs.where("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL")
    top = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most)
    share = F.least(F.lit(1.0), F.lit(3.0 * per_language) / F.col("n"))
    below = F.when(share < 1, (share * 2.0 ** 64 - 2.0 ** 63).cast("long")).otherwise(F.lit((1 << 63) - 1))
    top = top.select(F.col("lang").alias("of"), below.alias("below"))
    h = F.xxhash64("doc_id")
    # ``most`` rows
    ids = (known.select("lang", "doc_id", h.alias("h")).join(F.broadcast(top), (F.col("lang") == F.col("of")) & (F.col("h") <= F.col("below")))
           .groupBy("lang", "h", "doc_id").agg(F.lit(1).alias("one")))
    by = Window.partitionBy("lang").orderBy("h", "doc_id")
    chosen = (ids.withColumn("nth", F.row_number().over(by)).where(F.col("nth") <= per_language)
              .select(F.col("lang").alias("of"), F.col("doc_id").alias("id")))
    # ``most`` * ``per_language`` rows; one text for each id and language
    texts = known.join(F.broadcast(chosen), (F.col("lang") == F.col("of")) & (F.col("doc_id") == F.col("id")))
    return texts.groupBy("of", "id").agg(F.min("text").alias("text")).select("text", F.col("of").alias("lang"))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs`` (doc_id, text).

    Null texts and texts without a letter are ``und`` with score 0, and so is
    every text without a model. Very long texts are worked through in blocks as
    a whole. Ties go to the first label by code point;
    repeated rows get equal results; other columns are ignored; an empty table
    gives no row.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score = predict(shared.value, b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score)],
                                             ["doc_id", "lang_pred", "score"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("lang_pred", T.StringType()),
                                              T.StructField("score", T.DoubleType())]))


def language_digest(documents: DataFrame) -> DataFrame:
    known = documents.select("doc_id", "text", "lang").where(remainder(F.col("doc_id"), 3) != 1)
    sample = sorted((r["lang"], r["text"]) for r in training_sample(known).collect())
    model = train([t for _, t in sample], [n for n, _ in sample])
    found = identify(documents, model)
    return found.select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
