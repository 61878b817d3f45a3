import random
from collections import Counter

import numpy as np
import pytest

import brute
from civicstat.llm import bpe, fmindex, rules, simhash, substrings
from civicstat.llm.common import WORD
from conftest import SF  # noqa: F401

DOCS = "/root/testdata/sf0.001/documents.parquet"


def test_rules_measure_like_brute_force(odd):
    import re
    found, s = rules.screen(odd, order=[r.name for r in rules.RULES], measures=True)
    assert s == "_screen"
    for r in found.collect():
        words, v = re.findall(WORD, r.text or ""), r[s]
        lines = [x for x in (r.text or "").split("\n") if re.search(WORD, x)]
        assert v.n_words == len(words) and v.word_chars == sum(map(len, words))
        assert v.n_dup_lines == len(lines) - len(set(lines)) and v.n_repeat_words == brute.repeated_words(words)
        assert v.base_failed == (len(words) < 50 or 100 * v.n_repeat_words > 50 * len(words))
        assert v.kept == (v.rejected_by is None) and not (v.kept and v.base_failed)


def test_order_of_rules_never_changes_verdicts(spark):
    docs = spark.read.parquet(DOCS)
    ranked = rules.rank_rules(docs, 100)
    assert sorted(ranked) == sorted(r.name for r in rules.RULES)
    got = []
    for order in (ranked, ranked[::-1]):
        found, s = rules.screen(docs, order)
        got.append(sorted((r.doc_id, r[s].kept, r[s].base_failed) for r in found.collect()))
    assert got[0] == got[1]
    assert rules.screen(docs.limit(0))[0].count() == 0


@pytest.mark.parametrize("chunk,overlap", [(bpe.CHUNK, bpe.OVERLAP), (64, 8)])
def test_bpe_equals_the_library(odd, chunk, overlap):
    import public_tokenizers
    docs = odd.drop("ids", "decoded") if chunk == 64 else odd
    encoded, ids = bpe.encode(docs, brute.VOCABULARY, public_tokenizers.PATTERN, chunk, overlap)
    both, raw = bpe.decode(encoded, ids, brute.VOCABULARY, public_tokenizers.PATTERN)
    rows = both.collect()
    assert len(rows) == 16
    for r in rows:
        assert list(r[ids]) == brute.TOKENIZER.encode_ordinary(r.text or "")
        assert bytes(r[raw]) == (r.text or "").encode()
    assert bpe.encode(docs.limit(0), brute.VOCABULARY, public_tokenizers.PATTERN)[0].count() == 0


def test_one_worker_encodes_and_decodes(odd):
    import public_tokenizers
    docs = odd.drop("ids", "decoded")
    both, ids, raw = bpe.round_trip(docs, brute.VOCABULARY, public_tokenizers.PATTERN, 64, 8)
    assert both.columns == [*[c for c in docs.columns if c != "text"], ids, raw]
    got = sorted((str(r.doc_id), list(r[ids]), bytes(r[raw])) for r in both.collect())
    assert got == sorted((str(r.doc_id), brute.TOKENIZER.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in docs.collect())
    # short texts, parts of long texts, long texts: no second worker for each task
    plan = bpe.bpe_digest(docs, brute.VOCABULARY, public_tokenizers.PATTERN)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 3


def test_stitching_resynchronises():
    import public_tokenizers
    c, rng = bpe.codec(brute.VOCABULARY, public_tokenizers.PATTERN), random.Random(1)
    parts = ["a", "b", " ", "\n", "'", "'re", "é", "😀", "1", "ab", "  ", "中", "x" * 50, "!"]
    for _ in range(200):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 400)))
        chunk, overlap = rng.choice([(8, 2), (16, 4), (40, 8)])
        spans = [(max(0, i - overlap), min(len(text), i + chunk + overlap)) for i in range(0, len(text), chunk)]
        chunks = [(a, b, [a + e for e in c.bounds(text[a:b])]) for a, b in spans]
        assert bpe.stitch(c, text, chunks) == c.bounds(text)
        assert c.encode([c.pattern.findall(text)])[0].tolist() == brute.TOKENIZER.encode_ordinary(text)
    for text in ("a" * 3000, "é" * 999):
        assert bpe.long_merge(text.encode(), c.ranks) == brute.TOKENIZER.encode_ordinary(text)


@pytest.mark.parametrize("tile", [512, 8])
def test_simhash_components(spark, tile):
    docs = spark.read.parquet(DOCS)
    got = simhash.near_duplicates(docs, tile=tile).collect()
    rows = [(r.doc_id, brute.fingerprint(r.text)) for r in docs.collect()]
    assert Counter((r.doc_id, r.f & (1 << 64) - 1) for r in got) == Counter(rows)
    assert Counter((r.doc_id, r.component_id) for r in got) == brute.components(rows)


def test_simhash_of_odd_rows(odd):
    rows = [(r.doc_id, brute.fingerprint(r.text)) for r in odd.collect()]
    got = simhash.near_duplicates(odd).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == brute.components(rows)
    one = simhash.one_of_each(odd)
    assert one.columns == odd.columns
    assert Counter(r.doc_id for r in one.collect()) == Counter({c for _, c in brute.components(rows)})
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


def test_components_of_one_id_all_leave_a_row(spark):
    a, b, c, x, y = (" ".join(f"{k}{i * i}" for i in range(300)) for k in "abcxy")
    rows = [(None, a), (None, b), (None, c), (4, x), (4, y), (9, y.upper()), (None, x)]
    got = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows[:5])


def test_more_parts_lose_no_link():
    assert [simhash.parts_to_agree(n, 4) for n in (10, 10 ** 6, 10 ** 9)] == [1, 2, 3]
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40).astype(np.uint64)
    f = np.concatenate([base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) for _ in range(5)])
    links = simhash.linked(f, np.zeros(len(f), np.int64), 4)
    want = brute.components(list(enumerate(f.tolist())))
    group = list(range(len(f)))
    for a, b in links:
        x, y = group[a], group[b]
        group = [min(x, y) if g in (x, y) else g for g in group]
    assert Counter(enumerate(group)) == want


def test_long_chain_is_one_component(spark):
    # neighbours differ in 4 bits, the ends in many
    f = [sum(1 << k for k in range(4 * i)) for i in range(16)]
    prints = spark.createDataFrame([(100 - i, x - (1 << 64) if x >> 63 else x) for i, x in enumerate(f)], "doc_id long, f long")
    assert {r.component_id for r in simhash.groups(prints).collect()} == {85}


@pytest.mark.parametrize("limits", [{}, {"most_pieces": 0}, {"most_pieces": 1, "shard_words": 500}])
def test_substring_dedup(spark, odd, limits):
    for docs in (spark.read.parquet(DOCS), odd):
        found, d = substrings.dedup(docs, **limits)
        assert found.columns == [*docs.columns, d]
        got = Counter((r.doc_id, r[d].n_words, r[d].n_removed, brute.sha(r[d].kept.encode())) for r in found.collect())
        assert got == brute.substrings([(r.doc_id, r.text) for r in docs.collect()])
    assert substrings.dedup(odd.limit(0), **limits)[0].count() == 0


def test_index_finds_the_smallest_owner():
    rng = random.Random(5)
    for window in (1, 3, 4, 7):
        sequences = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(window, 30))] for _ in range(20)]
        owners = np.array([rng.randrange(50) for _ in sequences])
        first = {}
        for s, o in zip(sequences, owners.tolist()):
            for i in range(len(s) - window + 1):
                x = tuple(s[i:i + window])
                first[x] = min(first.get(x, 99), o)
        got, counts = fmindex.Index(sequences, owners, window).least_owners()
        want = [first[tuple(s[i:i + window])] for s in sequences for i in range(len(s) - window + 1)]
        assert got.tolist() == want and counts.tolist() == [len(s) - window + 1 for s in sequences]
