"""Quality rules: base statistics of whole texts and a learned decision list.

The list is learned by sequential covering. On two thirds of the labelled sample a rule grows
by the threshold condition of highest information gain until it covers next to no good
document; on the other third its last conditions are dropped again while that does not make
it worse, and the rule stays only if it is precise there. What it covers is taken out and the
next rule is grown. The rules become one ordered conditional expression over statistics
columns, so the verdict itself is plain Spark.

The sample is the documented bound `SAMPLE` of labelled documents, those with the smallest
hash; statistics and verdicts cover every document and every whole text.

Defined results: null text has no words and fails the base rule; labels that are null, neither
0 nor 1 or contradictory are not learned from; with labels of one class only the list is empty
and the base rule alone decides; repeated rows are separate rows; an empty table gives an empty
table; other columns are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from seriesforge.llm.common import fresh, in_batches, table, utf8

SAMPLE = 12_000
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_upper long, n_distinct long, n_lines long"
STAT_NAMES = [part.split()[0] for part in STATS.split(", ")]
SYMBOLS = b"#*$%&|<>"
#: Bytes that begin a code point are all but the continuation bytes.
CONTINUES = bytes(range(0x80, 0xC0))
UPPER = bytes(range(ord("A"), ord("Z") + 1))


def repeat_words(words: list[bytes], width: int = 5) -> int:
    """Words that lie in a window of `width` words found at least twice in the text."""
    n = len(words)
    if n <= width:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) == n:
        return 0
    windows = ids
    for k in range(1, width):
        # Numbers of the windows so far stay below n, so the product fits in 64 bits.
        pairs = windows[: n - k] * np.int64(len(number)) + ids[k:]
        windows = np.unique(pairs, return_inverse=True)[1] if k in (2, width - 1) else pairs
    twice = (np.bincount(windows) >= 2)[windows]
    if not twice.any():
        return 0
    edge = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def text_stats(text: bytes) -> tuple[int, ...]:
    words = text.split()
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    joined = b"".join(words)
    return (
        len(words),
        len(joined.translate(None, CONTINUES)),
        len(joined) - len(joined.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(joined) - len(joined.translate(None, UPPER)),
        len(set(words)),
        len(lines),
    )


def with_stats(docs: DataFrame, into: str = "stats") -> DataFrame:
    @pandas_udf(STATS)
    def stats_of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_stats(t) for t in texts], columns=STAT_NAMES, dtype="int64")

    return in_batches(docs).withColumn(into, stats_of(utf8("text")))


def ratios(stats: str = "stats") -> dict[str, Column]:
    """The statistics that conditions speak of, as columns of the statistics struct."""
    s = lambda name: F.col(f"{stats}.{name}").cast("double")
    per = lambda a, b: F.when(s(b) > 0, s(a) / s(b)).otherwise(F.lit(0.0))
    return {
        "words": s("n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "mean_word_chars": per("word_chars", "n_words"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "upper_share": per("n_upper", "word_chars"),
        "distinct_share": per("n_distinct", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "words_per_line": per("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return values[self.name] > self.threshold if self.above else values[self.name] <= self.threshold

    def column(self, columns: dict[str, Column]) -> Column:
        c = columns[self.name]
        return c > F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, values: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(values)
    return out


def _best_condition(values, bad, inside, steps):
    p0, n0 = int((inside & bad).sum()), int((inside & ~bad).sum())
    best, gain0 = None, 1e-9
    base = np.log2(p0 / (p0 + n0))
    for name, v in values.items():
        order = np.sort(v[inside])
        for t in np.unique(order[np.linspace(0, len(order) - 1, steps).astype(int)]):
            over = v > t
            for above in (True, False):
                hit = inside & (over if above else ~over)
                p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
                if p and p + n < p0 + n0:
                    gain = p * (np.log2(p / (p + n)) - base)
                    if gain > gain0:
                        best, gain0 = Condition(name, above, float(t)), gain
    return best


def learn(values: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.9, least: int = 3, steps: int = 64) -> list[Rule]:
    """Sequential covering: ordered rules whose documents are bad."""
    n = len(bad)
    third = np.arange(n) % 3 == 2
    left, rules = np.ones(n, bool), []
    open_to = dict(values)  # statistics that may begin the next rule
    while open_to and (left & bad & ~third).any() and (left & ~bad & ~third).any():
        rule: Rule = ()
        inside = left & ~third
        while (inside & ~bad).any() and len(rule) < 4:
            c = _best_condition(values if rule else open_to, bad, inside, steps)
            if c is None:
                break
            rule, inside = (*rule, c), inside & c.holds(values)
        if not rule:
            break
        first = rule[0].name

        def worth(r):
            hit = left & third & covers(r, values, n)
            p, q = int((hit & bad).sum()), int((hit & ~bad).sum())
            return (p - q) / (p + q) if p + q else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        hit = left & covers(rule, values, n)
        held = hit & third
        if int((hit & bad).sum()) >= least and held.any() and (held & bad).sum() >= precision * held.sum():
            rules.append(rule)
            left &= ~hit
            open_to = dict(values)
        else:  # it does not hold on the other third: begin with another statistic
            del open_to[first]
    return rules


def verdict(rules: Sequence[Rule], columns: dict[str, Column]) -> Column:
    """True for documents that no rule rejects; the first rule that holds decides."""
    if not rules:
        return F.lit(True)
    out = None
    for rule in rules:
        held = rule[0].column(columns)
        for c in rule[1:]:
            held = held & c.column(columns)
        out = F.when(held, F.lit(False)) if out is None else out.when(held, F.lit(False))
    return out.otherwise(F.lit(True))


def labelled_sample(labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """At most `most` (doc_id, quality): the labelled documents of smallest hash, contradictions left out."""
    one = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_other"))
        .filter(F.col("quality") == F.col("_other"))
    )
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id", "quality")


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> list[Rule]:
    """The decision list, from statistics of the labelled sample. The sample is bounded, so its join may be broadcast."""
    sample = labelled_sample(labels, most)
    told = with_stats(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"))
    columns = ratios()
    got = told.select("doc_id", "quality", *[c.alias(k) for k, c in columns.items()]).toPandas()
    # In hash order, so that the thirds are the same whatever order the rows came in.
    got = got.assign(_h=pd.util.hash_array(got["doc_id"].to_numpy())).sort_values(["_h", "doc_id"])
    return learn({k: got[k].to_numpy(float) for k in columns}, got["quality"].to_numpy() == 0)


def base_failed(stats: str = "stats") -> Column:
    s = lambda name: F.col(f"{stats}.{name}")
    return (s("n_words") < 10) | (F.lit(100) * s("n_repeat_words") > F.lit(20) * s("n_words"))


def judged(docs: DataFrame, rules: Sequence[Rule], into: str = "stats") -> DataFrame:
    """`docs` with the statistics, `base_failed` and `kept`."""
    told = with_stats(docs, into).withColumn("base_failed", base_failed(into))
    return told.withColumn("kept", ~F.col("base_failed") & verdict(rules, ratios(into)))


def kept_only(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The documents that are kept, in the columns of `docs`."""
    n = fresh(docs, "stats")
    told = with_stats(docs, n["stats"])
    return told.filter(~base_failed(n["stats"]) & verdict(rules, ratios(n["stats"]))).select(*docs.columns)


def query(spark, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = judged(docs, fit(docs, table(spark, sf, "labels")))
    return out.select("doc_id", *[F.col(f"stats.{c}") for c in STAT_NAMES[:5]], "base_failed", "kept")
