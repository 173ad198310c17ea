"""Breaks, statement events and the event timeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.operators.summary import changes

BREAK_PCT = 4.0
DISPLAY_PCT = 8.0
RATES = ("deposit_rate", "lending_rate", "main_operation_rate", "discount_rate")


def detect_breaks(obs: DataFrame, threshold: float = BREAK_PCT, kind: str = "fx_move", daily: bool = False) -> DataFrame:
    """Single-step percent moves at or over the threshold, with their evidence."""
    return (
        changes(obs, daily)
        .filter(F.abs("pct_change") >= threshold)
        .select(
            F.col("period").alias("date"),
            F.lit(kind).alias("type"),
            F.lit(None).cast("string").alias("label"),
            F.when(F.col("pct_change") > 0, F.lit("devaluation")).otherwise(F.lit("appreciation")).alias("direction"),
            F.struct(
                F.col("series_id").alias("series"),
                F.col("previous").alias("from"),
                F.col("value").alias("to"),
                F.bround("pct_change", 2).alias("pct_change"),
                F.col("previous_period").alias("previous_date"),
            ).alias("evidence"),
        )
    )


def statement_events(statements: DataFrame) -> DataFrame:
    """One event per statement, with the rates it states."""
    rates = F.map_from_arrays(
        F.array(*[F.lit(r) for r in RATES]), F.array(*[F.col(r).cast("double") for r in RATES])
    )
    return statements.select(
        "date", F.lit("mpc").alias("type"), F.col("title").alias("label"), "decision",
        F.map_filter(rates, lambda _k, v: v.isNotNull()).alias("rates"), "url",
    )


def with_decision(statements: DataFrame, *decisions: str) -> DataFrame:
    """Statements with one of these decisions."""
    return statements.filter(F.col("decision").isin(*decisions))


def neighbour_meetings(statements: DataFrame, keys: Sequence[str] = ("series_id",), date: str = "date") -> DataFrame:
    """Each meeting with the dates of the one before and the one behind; an archive has at most a meeting a day."""
    w = Window.partitionBy(*keys).orderBy(date)
    return statements.withColumns({f"previous_{date}": F.lag(date).over(w), f"next_{date}": F.lead(date).over(w)})


def timeline(breaks: DataFrame, statements: DataFrame) -> DataFrame:
    return breaks.unionByName(statement_events(statements), allowMissingColumns=True)


def top_breaks(breaks: DataFrame, n: int = 10) -> DataFrame:
    """The largest breaks; a bounded top-n, never a full sort."""
    return breaks.orderBy(
        F.abs("evidence.pct_change").desc(), "date", "evidence.series"
    ).limit(n)


def shown_breaks(breaks: DataFrame, pct: float = DISPLAY_PCT) -> DataFrame:
    """Breaks worth a mark on a chart, with their caption."""
    p = F.col("evidence.pct_change")
    sign = F.when(p > 0, F.lit("+")).otherwise(F.lit(""))
    caption = F.concat(sign, F.floor(p + 0.5).cast("string"), F.lit("%"))
    return breaks.filter((F.col("type") == "fx_move") & (F.abs(p) >= pct)).select(
        "date", F.coalesce(F.nullif("label", F.lit("")), caption).alias("label")
    )
