"""Per-series summaries, flags, and the windows behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.functions.dates import day_number
from seriesforge.functions.reading import stale_limit
from seriesforge.operators.spread import one_per_day


def by_series():
    return Window.partitionBy("series_id").orderBy("period")


def changes(obs: DataFrame, daily: bool = False) -> DataFrame:
    """Previous reading, change and percent; a previous zero gives no percent.

    Several prints of a day count as the largest; `daily` says that there are none.
    """
    obs = obs if daily else one_per_day(obs)
    prev = F.lag("value").over(by_series())
    return (
        obs.withColumn("previous_period", F.lag("period").over(by_series()))
        .withColumn("previous", prev)
        .withColumn("change", F.col("value") - F.col("previous"))
        .withColumn(
            "pct_change",
            F.when(F.col("previous") != 0, (F.col("value") - F.col("previous")) / F.col("previous") * 100),
        )
    )


def summarise(obs: DataFrame, catalog: DataFrame | None = None, as_of: Column | None = None, annual_stale: bool = False, daily: bool = False) -> DataFrame:
    """One row per series: coverage, latest, extremes, median, biggest move, flags.

    Two shuffles: (series_id, period) with partial aggregation, which bounds a series
    to one row per day and counts duplicate prints, then series_id for the window
    and the aggregation together. A repeated period counts once, by its largest
    print, and is reported in the flags. `daily` says that no period is repeated:
    then a task does not hold its days a second time to count them.
    """
    zero = F.col("value") == 0
    if daily:
        days = obs.select("series_id", "period", "value", F.lit(1).cast("bigint").alias("times"), F.when(zero, 1).otherwise(0).cast("bigint").alias("_zeros"))
    else:
        days = obs.groupBy("series_id", "period").agg(F.max("value").alias("value"), F.count(F.lit(1)).alias("times"), F.count_if(zero).alias("_zeros"))
    day = day_number("period")
    moved = days.withColumn("_prev", F.lag("value").over(by_series())).withColumn(
        "_move",
        F.when(
            F.col("_prev") != 0,
            F.struct(
                F.abs((F.col("value") - F.col("_prev")) / F.col("_prev")).alias("pct"),
                F.col("period").alias("period"),
                (F.col("value") - F.col("_prev")).alias("delta"),
            ),
        ),
    )
    out = moved.groupBy("series_id").agg(
        F.sum("times").alias("n"),
        F.min("period").alias("first_period"),
        F.max("period").alias("last_period"),
        F.max_by("value", "period").alias("last"),
        F.max_by("_prev", "period").alias("previous"),
        F.max("value").alias("highest"),
        F.max_by("period", F.struct("value", -day)).alias("highest_period"),
        F.min("value").alias("lowest"),
        F.min_by("period", F.struct("value", day)).alias("lowest_period"),
        F.bround(F.percentile("value", F.lit(0.5)), 6).alias("median"),
        F.max("_move").alias("_big"),
        F.count_if(F.col("times") > 1).alias("duplicate_periods"),
        F.min(F.when(F.col("times") > 1, F.col("period"))).alias("duplicate_example"),
        F.sum("_zeros").alias("_zeros"),
    )
    out = (
        out.withColumn("move_period", F.col("_big.period"))
        .withColumn("move_change", F.bround(F.col("_big.delta"), 6))
        .withColumn("move_abs_pct", F.bround(F.col("_big.pct") * 100, 2))
        .withColumn("move_pct", F.col("move_abs_pct") * F.signum(F.col("_big.delta")) * F.signum(F.col("_big.pct")))
        .withColumn("zero_values", F.when((F.col("_zeros") > 0) & (F.col("_zeros") < F.col("n") * 0.5), F.col("_zeros")))
        .drop("_big", "_zeros")
    )
    if catalog is not None:
        meta = ["series_id"] + [c for c in ("title_en", "title_ar", "family", "freq", "unit") if c in catalog.columns]
        out = out.join(catalog.select(*meta), "series_id", "left")
    if as_of is not None and "freq" in out.columns:
        age = F.datediff(as_of.cast("date"), F.col("last_period"))
        out = out.withColumn("stale_days", F.when(age > stale_limit(F.col("freq"), annual_stale), age))
    return out


def flag_sentences(summary: DataFrame) -> DataFrame:
    """The typed flags as report sentences, in an array column `flags`."""
    dup = F.when(
        F.col("duplicate_periods") > 0,
        F.format_string("duplicate periods: %d (e.g. %s)", F.col("duplicate_periods"), F.col("duplicate_example").cast("string")),
    )
    zero = F.format_string("%d zero values", F.col("zero_values"))
    stale = F.format_string("no new value in %d days (discontinued?)", F.col("stale_days"))
    return summary.withColumn(
        "flags",
        F.array_compact(
            F.array(
                dup,
                F.when(F.col("zero_values").isNotNull(), zero),
                F.when(F.col("stale_days").isNotNull(), stale) if "stale_days" in summary.columns else F.lit(None),
            )
        ),
    )


def flag_numbers(df: DataFrame, flags: str = "flags") -> DataFrame:
    """Numbers read back out of older prose flags: stale_days, zero_values, the rest."""
    stale, zero = r"no new value in (\d+) days", r"^(\d+) zero values"

    def first(pattern: str) -> Column:
        hits = F.filter(F.col(flags), lambda f: f.rlike(pattern))
        return F.regexp_extract(F.get(hits, F.lit(0)), pattern, 1).try_cast("int")

    return (
        df.withColumn("stale_days", first(stale))
        .withColumn("zero_values", first(zero))
        .withColumn(flags, F.filter(F.col(flags), lambda f: ~f.rlike(stale) & ~f.rlike(zero)))
    )


def newest_readings(obs: DataFrame, cap: int | None = None, daily: bool = False) -> DataFrame:
    """Readings newest first with the change from the one before; only the newest `cap` where it is given."""
    newest = Window.partitionBy("series_id").orderBy(F.col("period").desc())
    return (
        changes(obs, daily)
        .withColumn("rank", F.row_number().over(newest))
        .filter(F.lit(True) if cap is None else F.col("rank") <= cap)
        .withColumn("_oldest_shown", F.max("rank").over(Window.partitionBy("series_id")))
        # The oldest reading shown has nothing under it to compare with.
        .withColumn("change", F.when(F.col("rank") < F.col("_oldest_shown"), F.col("change")))
        .select("series_id", "period", "value", "change", "rank")
    )


def year_on_year(obs: DataFrame, compat: bool = False, daily: bool = False) -> DataFrame:
    """Percent change on the reading nearest to a year earlier.

    The base lies less than 45 days from 365 days ago; ties go to the later one.
    `compat` also accepts any later candidate up to the reading itself.
    """
    day = (obs if daily else one_per_day(obs)).withColumn("_day", day_number("period"))
    by_day = Window.partitionBy("series_id").orderBy("_day")
    point = F.struct("_day", "period", "value")
    near = 0 if compat else -321
    before = F.last(point).over(by_day.rangeBetween(-409, -365))
    after = F.first(point).over(by_day.rangeBetween(-364, near))
    aim = F.col("_day") - 365
    based = (
        day.withColumn("_b", before)
        .withColumn("_a", after)
        .withColumn(
            "_base",
            F.when(F.col("_b").isNull(), F.col("_a"))
            .when(F.col("_a").isNull(), F.col("_b"))
            .when(F.col("_a._day") - aim <= aim - F.col("_b._day"), F.col("_a"))
            .otherwise(F.col("_b")),
        )
    )
    base = F.col("_base.value")
    return based.filter(base != 0).select(
        "series_id", "period",
        F.col("_base.period").alias("base_period"),
        ((F.col("value") - base) / F.abs(base) * 100).alias("value"),
    )


def rebase(obs: DataFrame, daily: bool = False) -> DataFrame:
    """First reading = 100; unchanged where the first reading is zero."""
    obs = obs if daily else one_per_day(obs)
    w = by_series().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.first("value").over(w)
    return obs.withColumn("_first", first).select(
        "series_id", "period",
        F.when(F.col("_first") != 0, F.col("value") / F.col("_first") * 100).otherwise(F.col("value")).alias("value"),
    )


def even_sample(obs: DataFrame, points: int = 48, digits: int | None = 4, min_points: int = 2, pos: str = "pos", daily: bool = False) -> DataFrame:
    """`points` readings at an even stride plus the last; short series whole.

    The stride test is arithmetic on the row's own position, so there is no join.
    """
    obs = obs if daily else one_per_day(obs)
    n = F.count(F.lit(1)).over(Window.partitionBy("series_id"))
    at = (F.row_number().over(by_series()) - 1).cast("bigint")
    ranked = obs.withColumn("_n", n).withColumn(pos, at).filter(F.col("_n") >= min_points)
    step = F.col("_n") / F.lit(float(points))
    guess = F.floor(F.col(pos) / step)
    picked = F.exists(
        F.sequence(guess - 1, guess + 1),
        lambda k: (k >= 0) & (k < points) & (F.floor(k * step) == F.col(pos)),
    )
    keep = (F.col("_n") <= points) | picked | (F.col(pos) == F.col("_n") - 1)
    value = F.col("value") if digits is None else F.bround("value", digits)
    return ranked.filter(keep).select("series_id", "period", pos, value.alias("value"))


def first_k(df: DataFrame, keys: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    from seriesforge.operators.spread import top_per_group

    return top_per_group(df, keys, order, k, rank=name)


def long_run_multiple(obs: DataFrame) -> DataFrame:
    """Last value over first value."""
    return obs.groupBy("series_id").agg(
        F.bround(F.max_by("value", "period") / F.nullif(F.min_by("value", "period"), F.lit(0.0)), 1).alias("multiple")
    )


def density(obs: DataFrame) -> DataFrame:
    """Readings per year over the span actually covered."""
    days = F.datediff(F.max("period"), F.min("period"))
    return obs.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.when(days > 0, F.count(F.lit(1)) / (days / F.lit(365.0))).otherwise(F.lit(0.0)).alias("per_year"),
    )


def gauge(summary: DataFrame, latest: str = "last", low: str = "lowest", high: str = "highest", median: str = "median") -> DataFrame:
    """Position of the latest reading, and of the median, between the record low and high."""
    span = F.col(high) - F.col(low)

    def place(c: Column) -> Column:
        return F.when(span != 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (c - F.col(low)) / span)))

    return summary.withColumn("gauge", place(F.col(latest))).withColumn("gauge_median", place(F.col(median)))


def readable_move(summary: DataFrame) -> DataFrame:
    """The biggest move's percent, shown only where it says something."""
    pct_unit = F.lower(F.coalesce(F.col("unit"), F.lit(""))).contains("percent")
    return summary.withColumn(
        "shown_pct", F.when((F.col("move_abs_pct") <= 500) & ~pct_unit, F.col("move_pct"))
    )
