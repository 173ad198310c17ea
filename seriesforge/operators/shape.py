"""Wide, keyed and nested inputs to tidy observations, and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesforge.functions import ids
from seriesforge.functions.reading import tenor_bucket
from seriesforge.operators.spread import one_per_day


@dataclass(frozen=True)
class Measure:
    """One declared measure column."""

    suffix: str
    unit: str | None = None
    zero_ok: bool = False

    def __post_init__(self) -> None:
        if not isinstance(self.suffix, str):
            raise TypeError(f"suffix must be text, got {self.suffix!r}")


def wide_to_long(
    rows: DataFrame,
    period: Column,
    measures: Mapping[str, Measure],
    pattern: str,
    number=None,
    zero_is_missing: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Date column plus measures to (series_id, period, value, unit, label).

    One pass: each row explodes to its measures, so the scan is read once and
    nothing is shuffled. Measures absent from `rows` are skipped.
    """
    present = {c: m for c, m in measures.items() if c in rows.columns}
    read = number or (lambda c: c.cast("double"))
    lines = F.array(
        *[
            F.struct(
                ids.from_pattern(pattern, suffix=F.lit(m.suffix)).alias("series_id"),
                read(F.col(f"`{c}`")).alias("value"),
                F.lit(m.unit).cast("string").alias("unit"),
                F.lit(c).alias("label"),
                F.lit(m.zero_ok).alias("zero_ok"),
            )
            for c, m in present.items()
        ]
    )
    out = (
        rows.select(period.alias("period"), *keep, F.explode(lines).alias("_m"))
        .select("period", *keep, "_m.*")
        .filter(F.col("period").isNotNull() & F.col("value").isNotNull())
    )
    if zero_is_missing:
        out = out.filter(F.col("zero_ok") | (F.col("value") != 0))
    return out.select("series_id", "period", "value", "unit", "label", *keep)


def keyed_to_long(
    rows: DataFrame,
    period: Column,
    key: str,
    value_cols: Sequence[str],
    key_map: Mapping[str, str],
    pattern: str,
    number=None,
    zero_is_missing: bool = False,
) -> DataFrame:
    """Date, key and value columns; each (key, value column) is a series.

    The key map is declared configuration, compiled into the expression; keys not
    in it fall back to their slug.
    """
    read = number or (lambda c: c.cast("double"))
    name = F.trim(F.col(key))
    code = F.coalesce(ids.literal_map(dict(key_map))[name] if key_map else F.lit(None), ids.key_slug(F.col(key)))
    lines = F.array(
        *[
            F.struct(
                ids.from_pattern(pattern, key=code, col=F.lit(v.upper())).alias("series_id"),
                read(F.col(f"`{v}`")).alias("value"),
                F.concat(name, F.lit(f" {v}")).alias("label"),
            )
            for v in value_cols
        ]
    )
    out = (
        rows.select(period.alias("period"), F.explode(lines).alias("_m"))
        .select("_m.series_id", "period", "_m.value", "_m.label")
        .filter(F.col("period").isNotNull() & F.col("value").isNotNull())
    )
    return out.filter(F.col("value") != 0) if zero_is_missing else out


# Record-table columns behind each auction measure.
AUCTION_MEASURES = {
    "Weighted Avg. Yield (%)": ("YLD.WAVG", "percent per annum"),
    "Min. Yield (%)": ("YLD.MIN", "percent per annum"),
    "Max. Yield (%)": ("YLD.MAX", "percent per annum"),
    "Accepted Amount": ("AMT.ACC", None),
    "Submitted Amount": ("AMT.SUB", None),
}


def auction_series(
    auctions: DataFrame,
    prefix: Column,
    tenor_days: Column,
    period: Column,
    measures: Mapping[str, Column],
    submitted: Column,
    accepted: Column,
    currency: Column | None = None,
) -> DataFrame:
    """Bill auctions to tenor-bucketed measure series plus bid-to-cover.

    Amount measures carry the currency of the auction as their unit.
    """
    money = F.lit("EGP") if currency is None else currency
    lines = [
        F.struct(
            F.lit(suffix).alias("measure"),
            value.alias("value"),
            (money if suffix.startswith("AMT.") else F.lit("percent per annum")).alias("unit"),
        )
        for suffix, value in measures.items()
    ]
    cover = F.when((submitted != 0) & (accepted != 0), F.bround(submitted / accepted, 4))
    lines.append(F.struct(F.lit("BIDCOVER").alias("measure"), cover.alias("value"), F.lit("ratio").alias("unit")))
    return (
        auctions.select(
            prefix.alias("_prefix"), tenor_bucket(tenor_days).alias("tenor"), period.alias("period"),
            F.explode(F.array(*lines)).alias("_m"),
        )
        .filter(F.col("tenor").isNotNull() & F.col("period").isNotNull() & F.col("_m.value").isNotNull())
        .select(
            F.concat_ws(".", "_prefix", "tenor", "_m.measure").alias("series_id"),
            "period",
            F.col("_m.value").alias("value"),
            F.col("_m.unit").alias("unit"),
            "tenor",
        )
    )


def tenor_panel(index: DataFrame, tenors: Sequence[str] = ("3M", "6M", "9M", "12M")) -> DataFrame:
    """One row per (prefix, tenor) with the latest of each measure side by side.

    `index` has prefix, tenor, measure, latest, change.
    """
    first = {m: F.max(F.when(F.col("measure") == m, F.col("latest"))) for m in
             ("YLD.WAVG", "YLD.MIN", "YLD.MAX", "BIDCOVER", "AMT.SUB", "AMT.ACC")}
    return (
        index.filter(F.col("tenor").isin(list(tenors)))
        .groupBy("prefix", "tenor")
        .agg(
            first["YLD.WAVG"].alias("yield_latest"),
            F.max(F.when(F.col("measure") == "YLD.WAVG", F.col("change"))).alias("yield_change"),
            first["YLD.MIN"].alias("yield_min"),
            first["YLD.MAX"].alias("yield_max"),
            first["BIDCOVER"].alias("cover"),
            first["AMT.SUB"].alias("submitted"),
            first["AMT.ACC"].alias("accepted"),
        )
    )


def curve_slope(obs: DataFrame, prefix: str = "prefix", tenor: str = "tenor", short: str = "3M", long: str = "12M") -> DataFrame:
    """Long minus short tenor on the dates both have; negative is inverted.

    One conditional aggregation instead of a self join: one row per (prefix, period).
    """
    pick = lambda t: F.max(F.when(F.col(tenor) == t, F.col("value")))
    return (
        obs.filter(F.col(tenor).isin(short, long))
        .groupBy(prefix, "period")
        .agg(pick(short).alias("short_value"), pick(long).alias("long_value"))
        .filter(F.col("short_value").isNotNull() & F.col("long_value").isNotNull())
        .withColumn("slope", F.col("long_value") - F.col("short_value"))
        .withColumn("inverted", F.col("slope") < 0)
    )


def split_pages(docs: DataFrame, text: str = "text", doc: str = "doc_id", mark: str = "\n", keep: Sequence[str] = ()) -> DataFrame:
    """Document text to pages, numbered from one."""
    return docs.select(doc, *keep, F.posexplode(F.split(F.col(text), mark)).alias("_p", "text")).select(
        doc, *keep, (F.col("_p") + 1).alias("page"), "text", F.length("text").alias("chars")
    )


def series_documents(obs: DataFrame, daily: bool = False) -> DataFrame:
    """Ordered [period, value] array and count per series.

    One point a day, so an array is bounded by the calendar; `daily` says that there are no more.
    """
    obs = obs if daily else one_per_day(obs)
    points = F.array_sort(F.collect_list(F.struct("period", "value")))
    return obs.groupBy("series_id").agg(points.alias("observations")).withColumn("count", F.size("observations"))
