"""As-of, nearest and interval joins.

All of them reduce both sides to one row per (keys, date) before the window, so a
window holds at most two rows per calendar day of its key; the answer is then
looked up by equality for the probe rows; adaptive execution splits a hot date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.operators.spread import one_per_day


def _timeline(
    probe: DataFrame, obs: DataFrame, on: Sequence[str], at: str, obs_at: str, cols: Sequence[str], daily: bool
) -> DataFrame:
    """Probe and observation dates on one line: (on, _at, _side, _row, _probe)."""
    row = F.struct(F.col(obs_at).alias("_obs_at"), *[F.col(c) for c in cols])
    points = obs.select(*on, F.col(obs_at).alias("_at"), row.alias("_row"))
    asks = probe.select(*on, F.col(at).alias("_at"), F.struct(*probe.columns).alias("_probe"))
    if not daily:
        points = points.groupBy(*on, "_at").agg(F.max("_row").alias("_row"))
        asks = asks.select(*on, "_at").distinct().withColumn("_probe", F.lit(None).cast("boolean"))
    kind = asks.schema["_probe"].dataType
    return points.select("*", F.lit(0).alias("_side"), F.lit(None).cast(kind).alias("_probe")).unionByName(
        asks.select("*", F.lit(1).alias("_side"), F.lit(None).cast(points.schema["_row"].dataType).alias("_row"))
    )


def _answer(
    probe: DataFrame, line: DataFrame, on: Sequence[str], at: str, picked: Sequence[Column], daily: bool
) -> DataFrame:
    """Answers (struct `_hit` on the probe dates of the line) beside every probe row."""
    asked = line.filter("_side = 1")
    if daily:
        return asked.select("_probe.*", *picked)
    if "_ask" in probe.columns:
        raise ValueError("probe already has a column _ask")
    found = asked.select(*on, F.col("_at").alias("_ask"), *picked)
    return probe.withColumn("_ask", F.col(at)).join(found, [*on, "_ask"], "left").drop("_ask")


def _picked(cols: Sequence[str], names: Sequence[str] | None, obs_at_name: str | None) -> list[Column]:
    out = [F.col(f"_hit.{c}").alias(n) for c, n in zip(cols, names or cols, strict=True)]
    if obs_at_name:
        out.append(F.col("_hit._obs_at").alias(obs_at_name))
    return out


def asof_backward(
    probe: DataFrame,
    obs: DataFrame,
    on: Sequence[str],
    at: str,
    obs_at: str,
    cols: Sequence[str],
    names: Sequence[str] | None = None,
    obs_at_name: str | None = None,
    daily: bool = False,
) -> DataFrame:
    """For each probe row the last observation dated on or before it.

    `daily` states that both sides hold one row per (on, date): the probe rows then
    ride along the window themselves, one shuffle in all.
    """
    w = (
        Window.partitionBy(*on)
        .orderBy("_at", "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    line = _timeline(probe, obs, on, at, obs_at, cols, daily)
    hit = line.withColumn("_hit", F.last("_row", ignorenulls=True).over(w))
    return _answer(probe, hit, on, at, _picked(cols, names, obs_at_name), daily)


def nearest(
    probe: DataFrame,
    obs: DataFrame,
    on: Sequence[str],
    at: str,
    obs_at: str,
    cols: Sequence[str],
    names: Sequence[str] | None = None,
    obs_at_name: str | None = None,
    daily: bool = False,
) -> DataFrame:
    """For each probe row the observation closest in time; the earlier one on a tie."""
    back = (
        Window.partitionBy(*on)
        .orderBy("_at", "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # Backward in time, so the frame only grows; on equal dates the observation has
    # already answered in `back`.
    ahead = (
        Window.partitionBy(*on)
        .orderBy(F.col("_at").desc(), "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    line = (
        _timeline(probe, obs, on, at, obs_at, cols, daily)
        .withColumn("_b", F.last("_row", ignorenulls=True).over(back))
        .withColumn("_f", F.last("_row", ignorenulls=True).over(ahead))
    )
    before = F.datediff(F.col("_at"), F.col("_b._obs_at"))
    after = F.datediff(F.col("_f._obs_at"), F.col("_at"))
    hit = line.withColumn(
        "_hit", F.when(after.isNull() | (before <= after), F.col("_b")).otherwise(F.col("_f"))
    )
    return _answer(probe, hit, on, at, _picked(cols, names, obs_at_name), daily)


def clip_with_carry(obs: DataFrame, start: Column) -> DataFrame:
    """Readings from `start` on, led by the last earlier one re-dated to `start`.

    `start` is a literal or a column of `obs` that is constant inside a series.
    """
    cut = obs.withColumn("_start", start.cast("date"))
    later = cut.filter(F.col("period") >= F.col("_start"))
    carried = (
        cut.filter(F.col("period") < F.col("_start"))
        .groupBy("series_id", "_start")
        .agg(F.max_by("value", "period").alias("value"))
        .withColumn("period", F.col("_start"))
    )
    cols = ["series_id", "period", "value"]
    return later.select(*cols).unionByName(carried.select(*cols))


def label_regime(df: DataFrame, at: Column, regimes: Sequence[tuple[str, str | None, str]], name: str = "regime") -> DataFrame:
    """Label rows by a declared list of intervals, the last one open.

    The list is configuration (a handful of entries), so it is compiled into the
    expression: no join, no shuffle.
    """
    expr = F.lit(None).cast("string")
    for lo, hi, label in reversed(list(regimes)):
        inside = at >= F.lit(lo).cast("date")
        if hi is not None:
            inside = inside & (at <= F.lit(hi).cast("date"))
        expr = F.when(inside, F.lit(label)).otherwise(expr)
    return df.withColumn(name, expr)


def interval_join(
    df: DataFrame, at: str, intervals: DataFrame, lo: str, hi: str, cols: Sequence[str], last_day: Column
) -> DataFrame:
    """Rows to every interval that covers their date, for interval tables of any size.

    Intervals are cut at month edges and joined by (month), an equality, with the
    exact bounds checked after; an open end stops at `last_day`. Only the distinct dates
    of the rows meet the intervals, at most 31 a month; the rows join their date's
    intervals by equality, where adaptive execution splits a hot date.
    """
    if "_day" in df.columns:
        raise ValueError("rows already have a column _day")
    days = df.select(F.col(at).alias("_day")).distinct().withColumn("_month", F.trunc("_day", "month"))
    spans = (
        intervals.withColumn("_hi", F.coalesce(F.col(hi), last_day.cast("date")))
        .filter(F.col(lo) <= F.col("_hi"))
        .withColumn(
            "_month",
            F.explode(
                F.sequence(
                    F.trunc(F.col(lo), "month"), F.trunc(F.col("_hi"), "month"), F.expr("interval 1 month")
                )
            ),
        )
        .select("_month", F.col(lo).alias("_lo"), "_hi", *cols)
    )
    covered = days.join(spans, "_month").filter((F.col("_day") >= F.col("_lo")) & (F.col("_day") <= F.col("_hi"))).select("_day", *cols)
    return df.withColumn("_day", F.col(at)).join(covered, "_day").drop("_day")


def interval_totals(daily: DataFrame, at: str, value: str, intervals: DataFrame, lo: str, hi: str, last_day: Column, name: str) -> DataFrame:
    """The intervals that hold a day of `daily`, each with the sum of the whole numbers `value` over its days.

    Running totals along the calendar, at most a row a day, are looked up at both ends of an interval by
    equality: an interval costs two lookups, however long it is. An open end stops at `last_day`.
    """
    days = daily.filter(F.col(at).isNotNull()).groupBy(F.col(at).alias("_day")).agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_seen"))
    first, last = days.agg(F.min("_day")).scalar(), days.agg(F.max("_day")).scalar()
    edges = days.agg(F.min("_day").alias("_a"), F.max("_day").alias("_b")).filter("_a is not null")
    along = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    calendar = edges.select(F.explode(F.sequence("_a", "_b")).alias("_day"))
    totals = calendar.join(days, "_day", "left").select(
        "_day", F.coalesce(F.sum("_sum").over(along), F.lit(0)).alias("_total"), F.sum(F.coalesce("_seen", F.lit(0))).over(along).alias("_days")
    )
    end = F.coalesce(F.col(hi), last_day.cast("date"))
    asked = intervals.filter((F.col(lo) <= end) & (F.col(lo) <= last) & (end >= first)).withColumns({"_from": F.date_sub(lo, 1), "_to": F.least(end, last)})
    upto = totals.select(F.col("_day").alias("_to"), F.col("_total").alias("_t2"), F.col("_days").alias("_d2"))
    before = totals.select(F.col("_day").alias("_from"), F.col("_total").alias("_t1"), F.col("_days").alias("_d1"))
    met = asked.join(upto, "_to").join(before, "_from", "left")
    zero = F.lit(0).cast("bigint")
    return met.filter(F.col("_d2") > F.coalesce("_d1", zero)).select(*intervals.columns, (F.col("_t2") - F.coalesce("_t1", zero)).alias(name))


def step_daily(obs: DataFrame, until: Column, daily: bool = False) -> DataFrame:
    """A value that holds until changed, as one row per day up to `until`."""
    obs = obs if daily else one_per_day(obs)
    w = Window.partitionBy("series_id").orderBy("period")
    stop = F.coalesce(F.date_sub(F.lead("period").over(w), 1), F.greatest(until.cast("date"), F.col("period")))
    return obs.withColumn("_stop", stop).select(
        "series_id",
        F.explode(F.sequence(F.col("period"), F.col("_stop"), F.expr("interval 1 day"))).alias("period"),
        "value",
    )


def meeting_effect(meetings: DataFrame, rates: DataFrame, on: Sequence[str], date: str = "date") -> DataFrame:
    """The rate a meeting set and the rate before it.

    A rate takes effect some days after its meeting: the one set is the rate a week
    later, but never later than the day before the next meeting. `meetings` and
    `rates` have one row per (on, date).
    """
    w = Window.partitionBy(*on).orderBy(date)
    capped = (
        meetings.withColumn("next_date", F.lead(date).over(w))
        .withColumn(
            "look_at",
            F.least(F.date_add(F.col(date), 7), F.coalesce(F.date_sub("next_date", 1), F.date_add(F.col(date), 7))),
        )
        .withColumn("day_before", F.date_sub(F.col(date), 1))
    )
    after = asof_backward(capped, rates, on, "look_at", "period", ["value"], ["rate_after"], daily=True)
    return asof_backward(after, rates, on, "day_before", "period", ["value"], ["rate_before"], daily=True)


def corridor_position(benchmark: DataFrame, floor: DataFrame, ceiling: DataFrame, on: Sequence[str]) -> DataFrame:
    """Benchmark against the corridor midpoint, reading the corridor backward only.

    Each of the three has one row per (on, period).
    """
    a = asof_backward(benchmark, floor, on, "period", "period", ["value"], ["floor"], daily=True)
    b = asof_backward(a, ceiling, on, "period", "period", ["value"], ["ceiling"], daily=True)
    off = F.col("value") - (F.col("floor") + F.col("ceiling")) / 2
    return (
        b.filter(F.col("floor").isNotNull() & F.col("ceiling").isNotNull())
        .withColumn("off_mid", off)
        .withColumn(
            "position",
            F.when(F.abs(off) < 0.005, F.lit("on midpoint")).when(off > 0, F.lit("above")).otherwise(F.lit("below")),
        )
    )
