"""Filters and rules that decide what counts as a reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesforge.functions.reading import stale_limit

# Thresholds of the document checks.
SCAN_THRESHOLD = 90
NEAR_EMPTY_CHARS = 25
MIN_STATEMENT_CHARS = 200
FRESH_HOURS = 36
DEAD_LINK_MARKERS = ["Page not found", "that's an error"]


def drop_missing_zeros(obs: DataFrame, zero_is_missing: Column | bool = True, zero_ok: Column | bool = False) -> DataFrame:
    """A printed zero is not a reading where the dataset says so, unless its column opts out."""
    missing = zero_is_missing if isinstance(zero_is_missing, Column) else F.lit(zero_is_missing)
    ok = zero_ok if isinstance(zero_ok, Column) else F.lit(zero_ok)
    return obs.filter(~(missing & ~ok & (F.col("value") == 0)))


def drop_unreadable(obs: DataFrame) -> DataFrame:
    return obs.dropna(subset=["period", "value"])


def statement_texts(texts: DataFrame, text: str = "text", least: int = MIN_STATEMENT_CHARS) -> DataFrame:
    """Texts long enough to be a statement."""
    return texts.filter(F.length(text) >= least)


def reason_counts(rejects: DataFrame, reason: str = "reason", most: int | None = None) -> DataFrame:
    """(reason, n): how often each reason refused something; only the `most` frequent where it is given, equal ones by name."""
    counted = rejects.groupBy(reason).agg(F.count(F.lit(1)).alias("n"))
    return counted if most is None else counted.orderBy(F.col("n").desc(), reason).limit(most)


def row_floor(rows: DataFrame, specs: DataFrame, key: str = "dataset") -> DataFrame:
    """Rows landed per declared dataset against its floor: status ok or short."""
    landed = rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return (
        specs.select(key, "expect_min_rows")
        .join(landed, key, "left")
        .withColumn("rows", F.coalesce("rows", F.lit(0).cast("bigint")))
        .withColumn(
            "status",
            F.when(F.col("rows") < F.coalesce("expect_min_rows", F.lit(0)), F.lit("short")).otherwise(F.lit("ok")),
        )
    )


class ShortDataset(RuntimeError):
    """A landed dataset has fewer rows than its declared floor."""


def require_floor(status: DataFrame) -> None:
    """Write-audit gate: raise naming the short datasets. One row per declared dataset."""
    short = [r[0] for r in status.filter("status = 'short'").select(status.columns[0]).collect()]
    if short:
        raise ShortDataset(", ".join(sorted(short)))


def panel_guard(tables: DataFrame, specs: DataFrame, key: str = "dataset") -> DataFrame:
    """Documents with several tables and no declared panels: refused, not guessed."""
    counted = tables.groupBy(key, "doc_id").agg(F.count(F.lit(1)).alias("tables"))
    return (
        counted.filter(F.col("tables") > 1)
        .join(specs.select(key, "panels"), key, "left")
        .filter(F.coalesce("panels", F.lit(0)) == 0)
        .select(key, "doc_id", "tables", F.lit("several tables, no declared panels").alias("reason"))
    )


def layout_guard(tables: DataFrame) -> DataFrame:
    """Documents whose tables differ in column layout."""
    layout = F.xxhash64("columns")
    return (
        tables.groupBy("doc_id")
        .agg(F.min(layout).alias("_lo"), F.max(layout).alias("_hi"))
        .filter(F.col("_lo") != F.col("_hi"))
        .select("doc_id", F.lit("tables differ in columns").alias("reason"))
    )


def missing_columns(tables: DataFrame, required: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """Tables lacking a required column; optional ones may be absent."""
    gap = F.array_except(F.array(*[F.lit(c) for c in required if c not in set(optional)]), F.col("columns"))
    return tables.withColumn("missing", gap).filter(F.size("missing") > 0)


def duplicate_periods(obs: DataFrame) -> DataFrame:
    """Per series: how many periods are printed more than once, and the earliest."""
    return (
        obs.groupBy("series_id", "period")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .groupBy("series_id")
        .agg(F.count(F.lit(1)).alias("duplicate_periods"), F.min("period").alias("example"))
    )


def zero_flag(obs: DataFrame) -> DataFrame:
    """Series with some zeros but fewer than half."""
    return (
        obs.groupBy("series_id")
        .agg(F.count_if(F.col("value") == 0).alias("zero_values"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("zero_values") > 0) & (F.col("zero_values") < F.col("n") * 0.5))
    )


def stale_series(index: DataFrame, as_of: Column, annual: bool = False) -> DataFrame:
    age = F.datediff(as_of.cast("date"), F.col("last_period"))
    return index.withColumn("stale_days", age).filter(age > stale_limit(F.col("freq"), annual))


def uncatalogued(obs: DataFrame, catalog: DataFrame) -> DataFrame:
    return obs.select("series_id").distinct().join(catalog, "series_id", "left_anti")


def hard_failures(obs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Series that must stop a publication: repeated periods or no catalog entry."""
    return (
        duplicate_periods(obs)
        .select("series_id", F.lit("duplicate periods").alias("reason"))
        .unionByName(uncatalogued(obs, catalog).select("series_id", F.lit("uncatalogued").alias("reason")))
    )


def link_state(text: Column) -> Column:
    """dead for a page the publisher took down, live otherwise."""
    dead = F.lit(False)
    for marker in DEAD_LINK_MARKERS:
        dead = dead | text.contains(marker)
    return F.when(dead, F.lit("dead")).otherwise(F.lit("live"))


def relevant(items: DataFrame, wanted: Sequence[str], prefix: str = "/en/") -> DataFrame:
    """Listing items in any wanted category, of one language."""
    any_of = F.exists("categories", lambda c: c["value"].isin(list(wanted)))
    return items.filter(F.coalesce(any_of, F.lit(False)) & F.col("url").startswith(prefix))


def scanned(pages: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Per document: pages, mean characters, and whether it is a scan."""
    return (
        pages.groupBy(doc)
        .agg(F.count(F.lit(1)).alias("pages"), F.sum("chars").alias("chars"))
        .withColumn("needs_ocr", F.col("chars") < F.col("pages") * SCAN_THRESHOLD)
    )


def near_empty(pages: DataFrame, doc: str = "doc_id", per_page: int = NEAR_EMPTY_CHARS) -> DataFrame:
    """Documents with fewer than `per_page` characters a page."""
    return (
        pages.groupBy(doc)
        .agg(F.count(F.lit(1)).alias("pages"), F.sum("chars").alias("chars"))
        .filter(F.col("chars") < F.col("pages") * per_page)
    )


def passes_facets(source: str | None = None, category: str | None = None, year: str | None = None) -> Column:
    cond = F.lit(True)
    if source is not None:
        cond = cond & (F.col("source") == source)
    if category is not None:
        cond = cond & F.array_contains("categories", category)
    if year is not None:
        cond = cond & F.col("date").cast("string").startswith(year)
    return cond


def topic_filter(index: DataFrame, text: str = "", freq: str = "") -> DataFrame:
    out = index
    if text:
        hay = F.lower(F.concat_ws(" ", F.coalesce("title_en", F.lit("")), "series_id"))
        out = out.filter(hay.contains(text.strip().lower()))
    if freq:
        out = out.filter(F.col("freq") == freq)
    return out


def build_is_stale(built_at: Column, now: Column, hours: int = FRESH_HOURS) -> Column:
    return F.unix_timestamp(now) - F.unix_timestamp(built_at) > hours * 3600


def integrity_rejects(fetched: DataFrame, manifest: DataFrame, key: str = "id", content: str = "content") -> DataFrame:
    """Fetched rows whose content does not have the recorded hash."""
    return (
        fetched.select(key, F.sha2(F.col(content).cast("binary"), 256).alias("found_sha256"))
        .join(manifest.select(key, F.col("sha256").alias("recorded_sha256")), key)
        .filter(F.col("found_sha256") != F.col("recorded_sha256"))
    )
