"""Line dedup by a log-template tree.

Lines are parsed by a tree of fixed depth: the first level is the number of tokens, the next
`LEADING` levels are the leading tokens, with tokens that hold a digit generalised. In a leaf a
token stays part of a line's template if it recurs at its place in enough documents, every other
one becomes a variable field. A template whose places behind the leading ones are mostly constant,
and which recurs in enough documents, is boilerplate: all its lines are dropped.

Documents are counted by their texts, and copies of one document are not many documents: a
template recurs if enough of the texts that hold it differ, which are texts of less than the
Jaccard join's likeness to each other. They are found greedily in parts of the texts and then
among what the parts have found, so every group of linked near copies counts at least once and no
two that count are near. A template of near copies alone is left for a step that compares
documents; its copies are taken out of the counts, and what is left of its leaves is parsed again.

Lines meet only by leaf and by line, counted before they are dealt; a leaf's lines are never
gathered in one place. Only lines of leaves with enough documents are looked at token by token.
The decision for a line depends on its content alone, so equal texts lose the same lines.

Defined results: null text stays null; empty lines, lines of fewer than `LEAST` tokens and all
line breaks between kept lines stay; a text of which every line is dropped becomes empty; repeated
rows are separate rows; an empty table gives an empty table; other columns are carried along,
whatever their names, n_chars with the new length where it is there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import bounded, fresh, release, table, utf8, written
from seriesforge.llm.jaccard import SIMILAR, shingles

LEADING = 3
LEAST = 3
DOCUMENTS = 8
CONSTANT = 0.6
PART = 512  # texts that are compared at first
DIGIT = re.compile(rb"[0-9]")
FIELD = b"<*>"


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _hash(b: bytes) -> int:
    return _signed(xxhash.xxh64_intdigest(b))


def parsed(text: bytes, leading: int = LEADING, least: int = LEAST) -> list[tuple[int, int, int, list[bytes]]]:
    """For each line (number, leaf, line, tokens with variable ones generalised)."""
    found = []
    for k, line in enumerate(text.split(b"\n")):
        tokens = line.split()
        if len(tokens) < least:
            continue
        if DIGIT.search(line):
            tokens = [FIELD if DIGIT.search(t) else t for t in tokens]
        found.append((k, _hash(b"%d " % len(tokens) + b" ".join(tokens[:leading])), _hash(b" ".join(tokens)), tokens))
    return found


def _doc() -> Column:
    """64 bits of a text's md5 key."""
    return F.xxhash64(F.md5(utf8("text"))).alias("doc")


def _lines(docs: DataFrame, with_tokens: bool) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows, seen = [], set()
            for key, doc, text in zip(b["key"], b["doc"], b["text"]):
                if key in seen:  # a copy in the same batch says nothing new
                    continue
                seen.add(key)
                for k, leaf, line, tokens in parsed(text):
                    rows.append((leaf, line, doc, b" ".join(tokens)) if with_tokens else (key, k, leaf, line, doc))
            yield pd.DataFrame(rows, columns=["leaf", "line", "doc", "tokens"] if with_tokens else ["key", "nth", "leaf", "line", "doc"])

    schema = "leaf long, line long, doc long, tokens binary" if with_tokens else "key string, nth int, leaf long, line long, doc long"
    return bounded(docs.select(F.md5(utf8("text")).alias("key"), _doc(), utf8("text").alias("text"))).mapInPandas(run, schema)


def near(a: np.ndarray, b: np.ndarray, similar: int = SIMILAR) -> bool:
    if 100 * min(len(a), len(b)) < similar * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= similar * (len(a) + len(b) - both)


class Differing:
    """For each template texts that are not near each other, until there are enough."""

    def __init__(self, documents: int):
        self.documents = documents
        self.kept: dict[int, list[tuple[int, np.ndarray]]] = {}

    def add(self, doc: int, templates, read) -> None:
        own, told = None, {}
        for t in templates:
            kept = self.kept.setdefault(t, [])
            if len(kept) >= self.documents:
                continue
            if own is None:
                own = read()
            for other, its in kept:
                if other not in told:
                    told[other] = near(own, its)
                if told[other]:
                    break
            else:
                kept.append((doc, own))


def differing(docs: DataFrame, held: DataFrame, documents: int) -> DataFrame:
    """(template, doc, enough) from (template, doc): whether enough differing texts hold a template; if not, these texts."""
    held = written(held, "held")
    parts = max(1, held.select("doc").distinct().count() // PART)
    texts = docs.select(_doc(), utf8("text").alias("text")).dropDuplicates(["doc"])
    told = held.groupBy("doc").agg(F.collect_set("template").alias("templates")).join(texts, "doc")
    dealt = told.withColumn("part", F.pmod(F.xxhash64("doc"), F.lit(parts))).repartition("part").sortWithinPartitions("part", "doc")
    schema = "template long, doc long, enough boolean, shingles binary"

    def out(found: Differing) -> pd.DataFrame:
        rows = []
        for t, kept in found.kept.items():
            if len(kept) >= documents:
                rows.append((t, None, True, None))
            else:
                rows.extend((t, doc, False, s.tobytes()) for doc, s in kept)
        return pd.DataFrame(rows, columns=["template", "doc", "enough", "shingles"]).astype({"doc": "Int64"})

    def in_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, now = Differing(documents), None
        for b in batches:
            for part, doc, templates, text in zip(b["part"], b["doc"], b["templates"], b["text"]):
                if part != now:
                    yield out(found)
                    found, now = Differing(documents), part
                found.add(doc, templates, lambda text=text: shingles(text))
        yield out(found)
        found = None
        release()

    def together(rows: pd.DataFrame) -> pd.DataFrame:
        found, t = Differing(documents), rows["template"].iloc[0]
        for doc, packed in rows.sort_values("doc")[["doc", "shingles"]].itertuples(index=False):
            found.add(doc, [t], lambda packed=packed: np.frombuffer(packed, np.uint64))
        return out(found)[["template", "doc", "enough"]]

    first = written(bounded(dealt).mapInPandas(in_parts, schema), "differing")
    sure = first.filter("enough").select("template").distinct()
    rest = first.filter("NOT enough").join(sure, "template", "left_anti").groupBy("template").applyInPandas(together, "template long, doc long, enough boolean")
    return written(sure.select("template", F.lit(None).cast("long").alias("doc"), F.lit(True).alias("enough")).unionByName(rest), "told")


def templates(found: DataFrame, documents: int, constant: float) -> DataFrame:
    """(leaf, line, template): lines of templates that are mostly constant; `found` has rows with counts = false that only name a line."""
    one = found.groupBy("leaf", "line").agg(F.first("tokens").alias("tokens"), F.count_if("counts").alias("texts"))
    placed = one.select("leaf", "line", "texts", F.posexplode("tokens").alias("place", "token"))
    fixed = placed.groupBy("leaf", "place", "token").agg(F.sum("texts").alias("times")).filter(F.col("times") >= documents).drop("times")
    told = placed.join(fixed.withColumn("fixed", F.lit(True)), ["leaf", "place", "token"], "left")
    shape = told.groupBy("leaf", "line").agg(
        F.sort_array(F.collect_list(F.struct("place", F.when(F.col("fixed"), F.col("token")).alias("token")))).alias("template"),
        F.sum(F.when((F.col("place") >= LEADING) & F.col("fixed"), 1).otherwise(0)).alias("held"),
        F.sum(F.when(F.col("place") >= LEADING, 1).otherwise(0)).alias("places"),
    )
    return shape.filter(F.col("held") >= F.lit(constant) * F.col("places")).select("leaf", "line", F.xxhash64("leaf", "template").alias("template"))


def recurring(docs: DataFrame, lines: DataFrame, documents: int = DOCUMENTS, constant: float = CONSTANT) -> DataFrame:
    """(line): lines of templates that recur in at least so many documents."""
    busy = written(lines.groupBy("leaf").agg(F.countDistinct("doc").alias("texts")).filter(F.col("texts") >= documents).select("leaf"), "leaves")
    found = _lines(docs, True).join(busy, "leaf").groupBy("leaf", "line", "doc").agg(F.first("tokens").alias("tokens"))
    words = F.transform(F.split(F.col("tokens").cast("string"), " "), lambda t: F.xxhash64(t))
    found = written(found.withColumn("tokens", words).withColumn("counts", F.lit(True)), "busy")
    gone = None
    while True:
        named = written(templates(found, documents, constant), "templates")
        holds = found.filter("counts").join(named, ["leaf", "line"]).select("template", "doc").distinct()
        often = holds.groupBy("template").agg(F.count(F.lit(1)).alias("texts")).filter(F.col("texts") >= documents).select("template")
        told = differing(docs, holds.join(often, "template"), documents)
        lost = named.join(told.filter("enough").select("template"), "template").select("line")
        gone = lost if gone is None else gone.unionByName(lost)
        copied = told.filter("NOT enough")
        if copied.isEmpty():
            return gone.distinct()
        # A template of near copies: of these only the differing ones count when its leaves are parsed again.
        theirs = named.join(copied.select("template").distinct(), "template")
        again = found.join(theirs.select("leaf").distinct(), "leaf").join(theirs, ["leaf", "line"], "left")
        stays = copied.select("template", "doc", F.lit(True).alias("stays"))
        counts = F.col("counts") & (F.col("template").isNull() | F.col("stays").isNotNull())
        found = written(again.join(stays, ["template", "doc"], "left").select("leaf", "line", "doc", "tokens", counts.alias("counts")), "again")


def without_boilerplate(docs: DataFrame, documents: int = DOCUMENTS, constant: float = CONSTANT) -> DataFrame:
    """`docs` without the lines of recurring templates."""
    n = fresh(docs, "key", "drop")
    key, drop = n["key"], n["drop"]
    lines = written(_lines(docs, False), "lines")
    gone = lines.join(recurring(docs, lines, documents, constant), "line").groupBy("key").agg(F.collect_set("nth").alias(drop)).withColumnRenamed("key", key)
    told = docs.withColumn(key, F.md5(utf8("text"))).join(gone, key, "left")
    rest = F.array_join(F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains(drop, i)), "\n")
    out = told.withColumn("text", F.when(F.col(drop).isNotNull(), rest).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(drop).isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def query(spark, sf: str) -> DataFrame:
    """Every document with its text without boilerplate."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return without_boilerplate(docs)
