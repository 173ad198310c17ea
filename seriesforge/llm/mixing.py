"""Mixing sources to target weights by systematic sampling.

Within a source every document expects the same number of copies, target / size of the
source. The documents stand in the order (size, a hash part, doc_id); the expected copies
are summed along it, one offset per source is added, and a document is emitted once for
every whole number that its stretch of the sum crosses. Because neighbours in the order
have nearly equal sizes, the words taken differ from the target by little more than one
document.

The running sum never puts a source into one task. Its rows are counted by (source, size,
hash part); the counts are summed along sizes and along hash parts, and only the rows of one
such cell, a 4096th of the source's documents of one size, are numbered together.

Defined results: null or empty text has size 0; a null source is a source of its own, last in
order; repeated rows are separate rows and share the copies of their cell; a source without
words has target 0 and its documents are taken 0 times; an empty table gives an empty table;
other columns, whatever their names, are carried along. A null doc_id sorts first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.llm.common import WORD, fresh, table, written

WEIGHTS = (5, 2, 1)


def targets(totals: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) to the words each source shall give; one row per source.

    A source stops at `most` times its size. Sources sorted by size over weight fill up in
    that order, so the ones that stop are a prefix of it and running sums find them.
    """
    every = Window.partitionBy(F.lit(0))
    by_name = every.orderBy(F.col("source").asc_nulls_last())
    before = every.orderBy("_fill", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    nth = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))).cast("int")
    free = F.lit(share) * F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    weight_left = F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0))
    stopped = F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(F.lit(0.0))).over(every)
    open_weight = F.sum(F.when(F.col("_full"), F.lit(0)).otherwise(F.col("_w"))).over(every)
    level = (F.lit(share) * F.sum("source_size").over(every) - stopped) / open_weight
    return (
        totals.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), nth + 1))
        .withColumn("_cap", F.lit(most) * F.col("source_size"))
        .withColumn("_fill", F.col("_cap") / F.col("_w"))
        .withColumn("_full", F.col("_cap") * weight_left <= F.col("_w") * free)
        .withColumn("target", F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("_w") * level))
        .select("source", "source_size", "target")
    )


def copies(docs: DataFrame, seed: str = "mix", weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """`docs` (doc_id, source, size, ...) with source_size, target and the number of copies to emit."""
    n = fresh(docs, "src", "part", "nth", "rows", "below", "inside", "rate")
    src, part = n["src"], n["part"]
    keyed = docs.withColumn(src, F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))).withColumn(
        part, F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 3)
    )
    narrow = written(keyed.select(src, "source", "size", part), "sizes")
    cells = narrow.groupBy(src, "source", "size", part).agg(F.count(F.lit(1)).alias(n["rows"]))
    goals = targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    goals = goals.withColumn(src, F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))).drop("source")
    up_to = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sizes = narrow.groupBy(src, "size").agg(F.count(F.lit(1)).alias(n["rows"]))
    below = sizes.select(
        src, "size", F.coalesce(F.sum(n["rows"]).over(up_to(Window.partitionBy(src).orderBy("size"))), F.lit(0)).alias(n["below"])
    )
    starts = (
        cells.withColumn(
            n["inside"], F.coalesce(F.sum(n["rows"]).over(up_to(Window.partitionBy(src, "size").orderBy(part))), F.lit(0))
        )
        .join(below, [src, "size"])
        .join(goals, src)
        .select(src, "size", part, (F.col(n["below"]) + F.col(n["inside"])).alias(n["below"]), "source_size", "target")
    )
    order = Window.partitionBy(src, "size", part).orderBy("doc_id")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(src)).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(
        4294967296.0
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at = F.col(n["below"]) + F.col(n["nth"])
    crossed = F.floor(F.col(n["rate"]) * at + offset) - F.floor(F.col(n["rate"]) * (at - 1) + offset)
    return (
        keyed.withColumn(n["nth"], F.row_number().over(order))
        .join(starts, [src, "size", part])
        .withColumn(n["rate"], rate)
        .withColumn("copies", crossed)
        .drop(*n.values())
    )


def sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("size", F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix: each row as often as it is taken, in the columns of `docs`."""
    kept = fresh(docs, *docs.columns)
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    told = sized(inner.select(F.col("row.doc_id"), F.col("row.source"), F.col("row.text"), "row")).drop("text")
    out = copies(told, **options).filter(F.col("copies") > 0)
    again = out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return again.select(*[F.col(f"row.`{c}`").alias(c) for c in kept])


def query(spark, sf: str) -> DataFrame:
    docs = sized(table(spark, sf, "documents").select("doc_id", "source", "text")).drop("text")
    out = copies(written(docs, "sized"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), named AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS w, 2.0::DOUBLE * source_size AS cap FROM totals
), filled AS (
  SELECT *,
    1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS free,
    sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_w
  FROM named
), marked AS (
  SELECT *, cap * left_w <= w * free AS is_full FROM filled
), goals AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap ELSE w * ((1.5::DOUBLE * sum(source_size) OVER () - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ())
    / sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ()) END AS target
  FROM marked
), placed AS (
  SELECT s.*, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
    coalesce('=' || s.source, '') AS src,
    row_number() OVER (PARTITION BY s.source ORDER BY s.size, substr(md5(coalesce(s.doc_id::VARCHAR, '')), 1, 3), s.doc_id NULLS FIRST) AS place
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
), shifted AS (
  SELECT *, ('0x' || substr(md5('mix:' || src), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS u FROM placed
)
SELECT doc_id, size, source_size, target::DOUBLE AS target,
  ((floor(rate * place + u) - floor(rate * (place - 1) + u))::BIGINT * size)::BIGINT AS taken
FROM shifted
"""
