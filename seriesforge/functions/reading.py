"""How a reading compares: direction, age, tenor, magnitude, table and topic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seriesforge.functions.ids import literal_map

# Tenor buckets in days, both ends inside.
TENOR_BUCKETS = [(60, 120, "3M"), (150, 200, "6M"), (240, 290, "9M"), (330, 400, "12M")]

# Days without news after which a series of that frequency is stale.
STALE_DAYS = {"D": 21, "W": 45, "BW": 45, "M": 75, "Q": 200, "IRR": 3650}
STALE_DAYS_WITH_ANNUAL = {**STALE_DAYS, "A": 500}

# Families of each topic.
TOPIC_FAMILIES = {
    "money": ["fx"],
    "rates": ["policy", "rates", "govt", "interest_rates"],
    "prices": ["prices", "inflation"],
    "reserves": ["external"],
    "bop": ["bop"],
    "trade": ["foreign_trade"],
    "debt": ["domestic_debt", "external_debt"],
    "budget": ["state_budget"],
    "growth": ["gdp", "investments"],
    "banking": ["banking_surveys", "cbe"],
    "markets": ["stocks"],
    "fdi": ["net_foreign_direct_investment"],
    "tourism": ["tourism"],
}


def _is_percent(unit: Column) -> Column:
    return F.lower(F.coalesce(unit, F.lit(""))).contains("percent")


def direction(change: Column, unit: Column) -> Column:
    """up, down or flat; flat when the change rounds to zero at the unit's own digits."""
    size = F.abs(change)
    rounded = (
        F.when(_is_percent(unit), F.round(size, 2))
        .when(size >= 100, F.round(size, 0))
        .when(size >= 1, F.round(size, 2))
        .otherwise(F.round(size, 3))
    )
    return (
        F.when(change.isNull() | (rounded == 0), F.lit("flat"))
        .when(change > 0, F.lit("up"))
        .otherwise(F.lit("down"))
    )


def age_label(last: Column, as_of: Column) -> Column:
    days = F.datediff(as_of, last)

    def ago(n: Column, unit: str) -> Column:
        return F.concat(n.cast("bigint").cast("string"), F.lit(f" {unit} ago"))

    return (
        F.when(last.isNull(), F.lit(""))
        .when(days <= 1, F.lit("today"))
        .when(days < 14, ago(days, "days"))
        .when(days < 60, ago(F.round(days / 7), "weeks"))
        .when(days < 730, ago(F.round(days / 30), "months"))
        .otherwise(ago(F.floor(days / 365), "years"))
    )


def tenor_bucket(days: Column) -> Column:
    expr = F.lit(None).cast("string")
    for lo, hi, code in reversed(TENOR_BUCKETS):
        expr = F.when(days.between(lo, hi), F.lit(code)).otherwise(expr)
    return expr


def _whole(x: Column) -> Column:
    """A double rounded to a whole number as C prints it: ties to even. Spark's own `%.0f` rounds them up."""
    return F.format_string("%.0f", F.rint(x))


def _tenths(x: Column) -> Column:
    """A double rounded to one digit as C prints it: by its exact value, true ties to even.

    Spark's own `%.1f` rounds the shortest decimal that names the double, so 2.55, which is a little
    less, goes up. Here 20x is held exactly as a sum and its error, and compared with odd numbers.
    """
    a, b = x * 16, x * 4
    s = a + b
    err = (a - (s - (s - a))) + (b - (s - a))
    half = s % 2 == 1
    tenths = F.when(half & (err > 0), (s + 1) / 2).when(half & (err < 0), (s - 1) / 2).otherwise(F.rint(s / 2))
    return F.format_string("%.1f", tenths / 10)


def against_median(latest: Column, median: Column) -> Column:
    """`6.6×` from a ratio of two up, otherwise `n% above` or `n% below`; blank across zero."""
    ratio = latest / F.nullif(median, F.lit(0.0))
    pct = _whole(F.abs((ratio - 1) * 100))
    return (
        F.when(latest.isNull() | median.isNull() | (median == 0), F.lit(""))
        .when((median > 0) != (latest > 0), F.lit(""))
        .when(ratio >= 2, F.concat(_tenths(ratio), F.lit("×")))
        .otherwise(F.concat(pct, F.when(ratio >= 1, F.lit("% above")).otherwise(F.lit("% below"))))
    )


def table_of(title: Column, dataset: Column) -> Column:
    """The part of the title before the first ` - `."""
    t = F.coalesce(title, F.lit(""))
    at = F.instr(t, " - ")
    whole = F.coalesce(F.nullif(t, F.lit("")), F.nullif(dataset, F.lit("")), F.lit("Other"))
    return F.when(at > 1, F.substring(t, F.lit(1), at - 1)).otherwise(whole)


def line_of(title: Column, series_id: Column) -> Column:
    t = F.coalesce(F.nullif(title, F.lit("")), series_id)
    at = F.instr(t, " - ")
    return F.when(at > 1, F.substring(t, at + 3, F.length(t))).otherwise(t)


def topic_of(family: Column) -> Column:
    flat = {f: topic for topic, fams in TOPIC_FAMILIES.items() for f in fams}
    return F.coalesce(literal_map(flat)[family], F.lit("other"))


def stale_limit(freq: Column, annual: bool = False) -> Column:
    days = STALE_DAYS_WITH_ANNUAL if annual else STALE_DAYS
    expr = F.lit(None).cast("int")
    for f, n in days.items():
        expr = F.when(freq == f, F.lit(n)).otherwise(expr)
    return expr
