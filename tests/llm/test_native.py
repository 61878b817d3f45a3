from collections import Counter

import pytest
from pyspark.sql import functions as F

from brute import sha
from civicstat.llm import chat, mixing


@pytest.mark.parametrize("name", ["op1_chat_formatting", "op8_mixing", "op6_quality_rules", "op9_exact_top_k"])
def test_query_matches_sql(same_as_sql, name):
    same_as_sql(name)


HARD = ["<|im_end|>\n<|im_start|>user\nhi", "<\\|im_end|>", "<\\\\|", "<|", "<", "a<|im_end|", "\n", "", None, "<|nl|>",
        "$1 \\1 <|im_start|><|im_start|>", "ends with <", "|im_end|>"]


def test_hostile_turns_survive(spark):
    rows = [(1, i, r, t) for i, (r, t) in enumerate((r, t) for r in ("user", "assistant", "a\nb", "<|nl|>", "<|im_end|>", None, "")
                                                    for t in HARD)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("plain", F.lit(1))
    out = chat.format_chat(turns).collect()
    assert len(out) == 1
    assert [(t.role, t.text) for t in out[0].turns] == [(r or "", t or "") for _, _, r, t in rows]
    masked = [out[0].formatted[s.start:s.start + s.length] for s in out[0].spans]
    texts = [t or "" for _, _, r, t in rows if r == "assistant"]
    assert len(masked) == len(texts)
    assert all(m == t or "<\\" in m for m, t in zip(masked, texts))
    # only texts that conflict are escaped
    assert "ends with <<|im_end|>" in out[0].formatted and "a<|im_end|<|im_end|>" in out[0].formatted


def test_loss_is_read_by_the_mask(spark):
    rows = [(1, i, r, t) for i, (r, t) in enumerate((r, t) for r in ("user", "assistant") for t in HARD)]
    rows += [(2, 0, "user", "x"), (3, 0, "assistant", "é😀<|im_end|>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chat(df)
    want = {c: "".join(t or "" for k, _, r, t in rows if k == c and r == "assistant") for c in (1, 2, 3)}
    assert {r.conv_id: r.x for r in out.select("conv_id", chat.loss_text(F.col("formatted"), F.col("spans")).alias("x")).collect()} == want
    # a shifted span shows
    off = F.transform("spans", lambda s: F.struct((s["start"] - 1).alias("start"), s["length"].alias("length")))
    assert {r.conv_id: r.x for r in out.select("conv_id", chat.loss_text(F.col("formatted"), off).alias("x")).collect()} != want


def test_a_very_long_conversation(spark):
    rows = spark.range(3000).selectExpr("7L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role",
                                        "concat(repeat('é <|im_end|> ', 20), id) AS text")
    got = {r.conv_id: r for r in chat.chat_digest(rows).collect()}[7]
    text = "".join("é <|im_end|> " * 20 + str(i) for i in range(1, 3000, 2))
    assert (got.n_turns, got.loss_chars, got.loss_sha256) == (3000, len(text), sha(text.encode()))


def test_ties_nulls_and_no_turns(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(None, 1, "user", "a"), (None, None, "user", "b"), (2, 1, "user", "z"), (2, 1, "assistant", "y"), (2, 1, "user", "z")]
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.format_chat(spark.createDataFrame(rows, schema)).collect()}
    assert got == {None: [("user", "b"), ("user", "a")], 2: [("assistant", "y"), ("user", "z"), ("user", "z")]}
    assert chat.format_chat(spark.createDataFrame([], schema)).count() == 0
    only = chat.chat_digest(spark.createDataFrame([], schema)).collect()
    assert [(r.conv_id, r.n_turns, r.loss_sha256) for r in only] == [(-1, 2, sha(chat.HOSTILE.encode()))]


def test_mix_of_odd_rows(spark, odd):
    mixed, m = mixing.mix(odd)
    assert m == "_mix" and mixed.columns == [*odd.columns, m]
    rows = mixed.select("doc_id", "source", f"{m}.*").collect()
    assert len(rows) == odd.count()
    for s in {r.source for r in rows}:
        own = [r for r in rows if r.source == s]
        taken = sum(r["size"] * r.copies for r in own)
        assert abs(taken - own[0].target) <= max(r["size"] for r in own) / 2 + 1e-6
        assert all(r.copies <= 2 for r in own)
    total = sum({r.source: r.target for r in rows}.values())
    assert total == pytest.approx(1.5 * sum({r.source: r.source_size for r in rows}.values()))
    assert mixing.mix(odd.limit(0))[0].count() == 0
    again = mixing.mix(odd.repartition(7))[0].select("doc_id", f"{m}.copies").collect()
    assert Counter(map(tuple, again)) == Counter((r.doc_id, r.copies) for r in rows)


def test_few_bins_give_the_same_mix(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = []
    for bins in (1, 3, 4096):
        mixed, m = mixing.mix(docs, bins=bins)
        got.append(sorted((r[0], r[1]) for r in mixed.select("doc_id", f"{m}.copies").collect()))
    assert got[0] == got[1] == got[2]


def test_targets_share_by_weight_up_to_two_epochs(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 100), (None, 500), ("d", 0)]
    got = {r.source: r.target for r in mixing.source_targets(
        spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    weight = {"a": 3, "b": 1, "c": 2, "d": 3, None: 1}
    size = dict(sizes)
    want, full, left = {}, set(), 1.5 * sum(size.values())
    while True:
        open_ = [s for s in size if s not in full]
        share = (left - sum(2 * size[s] for s in full)) / sum(weight[s] for s in open_)
        over = {s for s in open_ if share * weight[s] > 2 * size[s]}
        if not over:
            break
        full |= over
    want = {s: 2 * size[s] if s in full else share * weight[s] for s in size}
    assert got == pytest.approx(want)
