"""Date windows offered for, and applied to, a series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.operators.spread import one_per_day

# The two float dates and the families they mean something to.
FLOAT_DATES = [("since_2016_float", "2016-11-03"), ("since_march_2024", "2024-03-06")]
FLOAT_FAMILIES = ["fx", "rates", "govt", "policy", "interest_rates"]


def range_start(rule: str | int | None, as_of: Column) -> Column | None:
    """First day of a window: years back, `ytd`, a fixed date, or everything."""
    if rule is None:
        return None
    day = as_of.cast("date")
    if rule == "ytd":
        return F.trunc(day, "year")
    if isinstance(rule, int):
        return F.date_sub(day, 365 * rule)
    return F.lit(rule).cast("date")


def apply_range(obs: DataFrame, rule: str | int | None, as_of: Column, daily: bool = False) -> DataFrame:
    """Readings inside the window; the whole series where one or none would be left."""
    obs = obs if daily else one_per_day(obs)
    start = range_start(rule, as_of)
    if start is None:
        return obs
    inside = F.col("period") >= start
    left = F.count_if(inside).over(Window.partitionBy("series_id"))
    return obs.withColumn("_left", left).filter(inside | (F.col("_left") <= 1)).drop("_left")


def offered_ranges(index: DataFrame, as_of: Column, name: str = "ranges") -> DataFrame:
    """Windows worth a button, from the index's n, first, last and family."""
    years = F.datediff("last_period", "first_period") / F.lit(365.0)
    per_year = F.when(years > 0, F.col("n") / years).otherwise(F.lit(0.0))

    def worth(y: int) -> Column:
        return (F.lit(y) < years) & (per_year * y >= 4)

    offers = [F.when(worth(y), F.lit(label)) for y, label in ((1, "1y"), (5, "5y"), (10, "10y"))]
    offers.append(F.lit("all"))
    offers.append(
        F.when((F.year("last_period") >= F.year(as_of.cast("date"))) & (per_year >= 4), F.lit("ytd"))
    )
    money = F.col("family").isin(FLOAT_FAMILIES) if "family" in index.columns else F.lit(False)
    for label, day in FLOAT_DATES:
        d = F.lit(day).cast("date")
        offers.append(F.when(money & (F.col("last_period") >= d) & (F.col("first_period") < d), F.lit(label)))
    return index.withColumn(name, F.array_compact(F.array(*offers)))
