"""Quality rules as a short-circuit cascade.

Every rule reads measures of a text; each measure is computed at most once
per text and only when a rule asks for it. ``rank_rules`` runs all rules on a
bounded sample and orders them by rejections per second, so the cascade
usually rejects a bad text with its cheapest rule. The order never changes a
verdict, which is that no rule rejects; it only changes the cost.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicstat.llm.common import fresh, prepare

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Documents of the sample that orders the rules, on average.
SAMPLE_DOCS = 1000


class Measures:
    """Measures of one whole text, each computed when first read."""

    def __init__(self, text: str | None):
        self.text = text or ""

    def __getattr__(self, name: str):
        value = getattr(Measures, f"_{name}")(self)
        setattr(self, name, value)
        return value

    def _words(self) -> list[bytes]:
        return self.text.encode("utf-8", "surrogatepass").split()

    def _n_words(self) -> int:
        return len(self.words)

    def _word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACE))

    def _n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    def _n_shouts(self) -> int:
        return self.text.count("!!")

    def _lines(self) -> list[str]:
        return [x for x in self.text.split("\n") if x.strip(SPACE)]

    def _n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    def _n_repeat_words(self) -> int:
        """Words inside a 3-word window that the text has twice or more."""
        w = self.words
        windows = list(zip(w, w[1:], w[2:]))
        counts = Counter(windows)
        if len(counts) == len(windows):
            return 0
        covered, upto = 0, 0
        for i, x in enumerate(windows):
            if counts[x] > 1:
                covered += i + 3 - max(i, upto)
                upto = i + 3
        return covered


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], bool]


#: Texts that a base rule rejects fail whatever the other rules say.
BASE = (
    Rule("too_short", lambda m: m.n_words < 50),
    Rule("repeats", lambda m: 100 * m.n_repeat_words > 50 * m.n_words),
)
#: All limits in whole numbers, so that SQL gives the same verdicts.
OWN = (
    Rule("symbols", lambda m: 2 * m.n_symbols > m.n_words),
    Rule("dup_lines", lambda m: 2 * m.n_dup_lines > len(m.lines)),
    Rule("shouts", lambda m: 10 * m.n_shouts > m.n_words),
    Rule("short_words", lambda m: m.word_chars < 2 * m.n_words),
    Rule("long_words", lambda m: m.word_chars > 30 * m.n_words),
)
RULES = BASE + OWN


def _by_name(names: list[str]) -> list[Rule]:
    known = {r.name: r for r in RULES}
    return [known[n] for n in names]


def first_rejection(m: Measures, rules: list[Rule]) -> str | None:
    return next((r.name for r in rules if r.rejects(m)), None)


def rank_rules(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> list[str]:
    """Names of the rules, the most rejections per second of cost first.

    Looks at about ``sample_docs`` documents: every row is drawn by itself, so
    no texts are moved; equal ranks keep their order.
    """
    n = docs.count()
    share = min(1.0, sample_docs / max(n, 1))
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost, hits = [0.0] * len(RULES), [0] * len(RULES)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for i, rule in enumerate(RULES):
                    m = Measures(text)  # no rule gains from another's measures
                    t = time.perf_counter()
                    hits[i] += rule.rejects(m)
                    cost[i] += time.perf_counter() - t
        yield pa.RecordBatch.from_pydict({"i": list(range(len(RULES))), "cost": cost, "hits": hits},
                                         pa.schema([("i", pa.int32()), ("cost", pa.float64()), ("hits", pa.int64())]))

    seen = (docs.select("text").sample(share, seed=6).mapInArrow(run, "i int, cost double, hits bigint")
            .groupBy("i").agg(F.sum("cost").alias("cost"), F.sum("hits").alias("hits")).collect())
    gain = {r["i"]: r["hits"] / max(r["cost"], 1e-9) for r in seen}
    return [RULES[i].name for i in sorted(range(len(RULES)), key=lambda i: (-gain.get(i, 0.0), i))]


_FULL = T.StructType([T.StructField(n, T.LongType()) for n in
                      ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")])


def screen(docs: DataFrame, order: list[str] | None = None, measures: bool = False) -> tuple[DataFrame, str]:
    """``docs`` (text, any others) with a struct column: kept, base_failed and
    rejected_by (the first rule of the cascade to reject, else null), with
    ``measures`` also the five measures of every text.

    Returns the frame and the struct's name, which avoids any column ``docs``
    has. Null and empty texts have no words and fail ``too_short``. Very long
    texts are measured whole, one at a time. Repeated rows get equal verdicts;
    rules that would reject a text together go by the cascade's order; an empty
    table gives no row.
    """
    prepare(docs.sparkSession)
    order = order or rank_rules(docs)
    base = {r.name for r in BASE}
    out, = fresh(docs, "screen")
    verdict = T.StructType([T.StructField("kept", T.BooleanType()), T.StructField("base_failed", T.BooleanType()),
                            T.StructField("rejected_by", T.StringType())]
                           + (_FULL.fields if measures else []))
    at = docs.columns.index("text")
    kinds = pa.struct([(f.name, {"boolean": pa.bool_(), "string": pa.string(), "bigint": pa.int64()}
                        [f.dataType.simpleString()]) for f in verdict.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = _by_name(order)
        firm = [r for r in rules if r.name in base]
        for batch in batches:
            found = []
            for text in batch.column(at).to_pylist():
                m = Measures(text)
                by = first_rejection(m, rules)
                row = {"kept": by is None, "rejected_by": by,
                       "base_failed": by is not None and (by in base or first_rejection(m, firm) is not None)}
                if measures:
                    row |= {f.name: getattr(m, f.name) for f in _FULL.fields}
                found.append(row)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kinds)], [*batch.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, verdict)])), out


def rules_digest(documents: DataFrame) -> DataFrame:
    found, s = screen(documents.select("doc_id", "text"), measures=True)
    return found.select("doc_id", *[F.col(f"{s}.{n}") for n in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t FROM win),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS n FROM g),
rep AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM c WHERE n > 1) GROUP BY r),
ln AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, len(string_split(text, '!!')) - 1 AS n_shouts
  FROM d LEFT JOIN rep ON d.r = rep.r LEFT JOIN ln ON d.r = ln.r),
v AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND NOT (2 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
    OR 10 * n_shouts > n_words OR word_chars < 2 * n_words OR word_chars > 30 * n_words) AS kept
FROM v
"""
