"""Views over the series index: headline tables, topics, siblings, snapshots, series views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesforge.functions import ids, reading
from seriesforge.operators import summary
from seriesforge.operators.asof import nearest
from seriesforge.operators.ranges import apply_range
from seriesforge.operators.spread import top_per_group

SIBLINGS = 40


def with_place(index: DataFrame) -> DataFrame:
    """Adds table, line and topic."""
    dataset = F.col("dataset") if "dataset" in index.columns else F.lit(None).cast("string")
    return (
        index.withColumn("table", reading.table_of(F.col("title_en"), dataset))
        .withColumn("line", reading.line_of(F.col("title_en"), F.col("series_id")))
        .withColumn("topic", reading.topic_of(F.col("family")))
    )


def headline(summaries: DataFrame, groups: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Chosen ids in declared groups with latest, change, record and gauge."""
    where = {sid: (g, pos) for g, (_, sids) in enumerate(groups) for pos, sid in enumerate(sids)}
    label = ids.literal_map({sid: groups[g][0] for sid, (g, _) in where.items()})
    place = ids.literal_map({sid: f"{g:03d}.{p:03d}" for sid, (g, p) in where.items()})
    chosen = summaries.filter(F.col("series_id").isin(list(where)))
    return summary.gauge(chosen).select(
        label[F.col("series_id")].alias("group"),
        place[F.col("series_id")].alias("place"),
        "series_id",
        F.col("last").alias("latest"),
        (F.col("last") - F.col("previous")).alias("change"),
        "lowest", "highest", "gauge", "gauge_median",
        F.col("last_period").alias("as_of"),
    )


def topic_page(placed: DataFrame, topic: str | None = None) -> DataFrame:
    """Tables of a topic with their number of series and earliest coverage."""
    mine = placed if topic is None else placed.filter(F.col("topic") == topic)
    return mine.groupBy("topic", "table").agg(
        F.count(F.lit(1)).alias("series"), F.min("first_period").alias("covers_from")
    )


def siblings(placed: DataFrame, k: int = SIBLINGS) -> DataFrame:
    """Up to k other series of the same table and topic, by id.

    Every series of a group sees the same first k + 1 members, so those are found
    once per group (a salted top-k) and each series drops itself: work is linear in
    the series, never a pair per pair.
    """
    group = ["topic", "table"]
    first = (
        top_per_group(placed.select(*group, "series_id"), group, [F.col("series_id")], k + 1)
        .groupBy(*group)
        .agg(F.array_sort(F.collect_list("series_id")).alias("_first"))
    )
    others = F.slice(F.filter("_first", lambda x: x != F.col("series_id")), 1, k)
    return (
        placed.select(*group, "series_id")
        .join(first, group)
        .select("series_id", F.posexplode(others).alias("_pos", "sibling_id"))
        .select("series_id", "sibling_id", (F.col("_pos") + 1).alias("rank"))
    )


def topic_counts(placed: DataFrame) -> DataFrame:
    return placed.groupBy("topic").agg(F.count(F.lit(1)).alias("series"), F.sum("n").alias("observations"))


def snapshot(summaries: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The chosen series as a desk sheet."""
    return summaries.filter(F.col("series_id").isin(list(wanted))).select(
        "series_id",
        F.col("title_en").alias("title"),
        "unit",
        F.col("last_period").alias("period"),
        F.col("last").alias("value"),
        "previous",
        (F.col("last") - F.col("previous")).alias("change"),
    )


def desk_groups(wanted: DataFrame, placed: DataFrame) -> DataFrame:
    """Wanted ids by topic, with the ids the index does not know counted apart."""
    known = placed.select("series_id", "topic")
    return (
        wanted.select("series_id").distinct()
        .join(known, "series_id", "left")
        .groupBy(F.coalesce("topic", F.lit("(unknown)")).alias("topic"))
        .agg(F.count(F.lit(1)).alias("series"), F.count_if(F.col("topic").isNull()).alias("missing"))
    )


def quality_notice(summaries: DataFrame) -> DataFrame:
    """Series with something a reader must be told."""
    return (
        summaries.select(
            "series_id", "last_period", "stale_days", "zero_values", "duplicate_periods",
            F.array_compact(
                F.array(
                    F.when(F.col("stale_days").isNotNull(), F.lit("discontinued")),
                    F.when(F.col("zero_values").isNotNull(), F.lit("zeros")),
                    F.when(F.col("duplicate_periods") > 0, F.lit("duplicates")),
                )
            ).alias("notices"),
        )
        .filter(F.size("notices") > 0)
    )


def compare(obs: DataFrame, first: str, second: str) -> DataFrame:
    """Two series rebased to 100 with their gap at matched dates.

    Each reading of the first series meets the second's nearest in time.
    """
    two = summary.rebase(obs.filter(F.col("series_id").isin(first, second)))
    a = two.filter(F.col("series_id") == first).select(F.lit("pair").alias("pair"), "period", F.col("value").alias("first_value"))
    b = two.filter(F.col("series_id") == second).select(F.lit("pair").alias("pair"), "period", "value")
    return (
        nearest(a, b, ["pair"], "period", "period", ["value"], ["second_value"], "second_period", daily=True)
        .withColumn("gap", F.col("second_value") - F.col("first_value"))
        .drop("pair")
    )


def series_view(
    obs: DataFrame,
    series_id: str,
    range_rule: str | int | None = None,
    transform: str = "level",
    compare_to: str | None = None,
    as_of: Column | None = None,
    compat: bool = False,
) -> DataFrame:
    """One series in a window, as published, year on year, rebased, or against another.

    The id reaches the scan as a pushed filter; a comparison rebases both series at
    the start of the window.
    """
    day = as_of if as_of is not None else F.current_date()
    ids_wanted = [series_id] if compare_to is None else [series_id, compare_to]
    cut = apply_range(obs.filter(F.col("series_id").isin(ids_wanted)), range_rule, day)
    if compare_to is not None:
        return compare(cut, series_id, compare_to)
    if transform == "level":
        return cut.select("series_id", "period", "value")
    if transform == "yoy":
        return summary.year_on_year(cut, compat).select("series_id", "period", "value")
    if transform == "index":
        return summary.rebase(cut)
    raise ValueError(f"unknown transform {transform!r}")


def facet_counts(docs: DataFrame, *facets: str, name: str = "documents") -> DataFrame:
    """Documents by each combination of these facets."""
    return docs.groupBy(*facets).agg(F.count(F.lit(1)).alias(name))


def distinct_counts(df: DataFrame, **columns: str) -> DataFrame:
    """One row: how many different values each named column has."""
    return df.agg(*[F.count_distinct(c).alias(name) for name, c in columns.items()])
