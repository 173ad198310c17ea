"""Running a declared dataset: landed responses to observations, anomalies, records, catalog and status.

A `Dataset` is compiled into one plan over all its responses: tables, then panels or variants, then
the declared shape, the zero rule, the first print of each (series_id, period), what the later
prints said, one catalog entry a series, and what was left out and why. Nothing is guessed: tables
beyond the declared panels, responses of several tables without panels, tables without a header or
without a declared column, and datasets below their floor are rows of the status.

Rows are served in the order of variant, response, table and row; the first print counts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesforge.functions import dates, ids
from seriesforge.functions.numbers import number
from seriesforge.operators.merge import anomalies, keep_first
from seriesforge.operators.shape import Measure
from seriesforge.operators.spread import settle
from seriesforge.sources.registry import Dataset
from seriesforge.sources.tables import html_tables, table_rows

READ = "read"
NO_HEADER = "no header row found"
LEFT_OVER = "past the declared panels"
REFUSED = "several tables and no panels"
NO_DATE = "no date column"
NO_KEY = "no key column"
UNKNOWN_VARIANT = "undeclared variant"
SHORT = "short"
OK = "ok"


@dataclass(frozen=True)
class Run:
    """What one dataset gave.

    `observations` has series_id, period, value; `anomalies` dataset, series_id, period, kept,
    discarded; `records` dataset, doc_id, table_ix, row_ix and the row as printed, name to text;
    `catalog` one entry a series; `tables` dataset, doc_id, variant, table_ix, rows, status;
    `status` one row: dataset, rows, series, status.
    """

    observations: DataFrame
    anomalies: DataFrame
    records: DataFrame
    catalog: DataFrame
    tables: DataFrame
    status: DataFrame


def _panels(d: Dataset) -> list[Mapping]:
    return list(d.tables) or [{}]


def _variants(d: Dataset) -> list[Mapping]:
    """Declared variants, each with the name of its responses; a dataset without any has one of no name."""
    return [{"name": x.get("radio", x.get("name")), **x} for x in d.variants] or [{"name": None}]


def parsed_tables(landed: DataFrame, keep: Sequence[str] = (), unescape: bool = True) -> DataFrame:
    """Every table of the responses (doc_id, variant, html), with `_tables`, how many its response has."""
    counted = landed.withColumn("_tables", F.regexp_count("html", F.lit(r"(?s)<table[^>]*>.*?</table>")))
    return html_tables(counted, keep=["variant", *keep, "_tables"], unescape=unescape)


def _verdict(d: Dataset) -> Column:
    """read, or why a parsed table is left out."""
    status = F.when(~F.col("has_header"), F.lit(NO_HEADER))
    if d.shape != "records":
        if d.variants:
            status = F.when(~F.col("variant").isin([x["name"] for x in _variants(d)]) | F.col("variant").isNull(), F.lit(UNKNOWN_VARIANT)).otherwise(status)
        status = F.coalesce(status, F.when(F.col("table_ix") >= len(_panels(d)), F.lit(LEFT_OVER if d.tables else REFUSED)))
        if not d.tables:
            status = F.coalesce(status, F.when(F.col("_tables") > 1, F.lit(REFUSED)))
        status = F.coalesce(status, F.when(~F.array_contains("columns", d.date_col or ""), F.lit(NO_DATE)))
        if d.shape == "long_by_key":
            status = F.coalesce(status, F.when(~F.array_contains("columns", d.key_col or ""), F.lit(NO_KEY)))
    return F.coalesce(status, F.lit(READ))


def judged_tables(landed: DataFrame, d: Dataset, unescape: bool = True) -> DataFrame:
    """Every table of the responses with `status`: read, or why it is left out.

    `landed` has doc_id, variant and html.
    """
    return parsed_tables(landed, unescape=unescape).withColumn("status", _verdict(d)).drop("_tables")


def _columns(d: Dataset, panel: Mapping) -> Mapping[str, Measure]:
    return panel.get("columns") or d.columns


def _measured(d: Dataset) -> list[str]:
    """Names of the columns that hold figures, in any panel."""
    if d.shape == "records":
        return []
    return list(d.value_cols) if d.shape == "long_by_key" else list(dict.fromkeys(name for panel in _panels(d) for name in _columns(d, panel)))


def _rows_read(tables: DataFrame, datasets: Sequence[Dataset], keep: Sequence[str]) -> DataFrame:
    """Rows of the tables that are read, with `period`, `_key` (text under the key column) and `_figures`.

    Columns are looked up once a table, and dates and figures read once a row, so that the lines
    made of them are short expressions. Rows without a period are left out.
    """
    shaped = [d for d in datasets if d.shape != "records"]
    measured = list(dict.fromkeys(name for d in shaped for name in _measured(d)))
    names = list(dict.fromkeys([*measured, *[n for d in shaped for n in (d.date_col, d.key_col) if n]]))
    at = F.array(*[F.array_position("columns", F.lit(n)).cast("int") - 1 for n in names]).cast("array<int>")
    placed = settle(tables.filter(F.col("status") == READ), _at=at)
    # Before the first cell there is none: a name the table lacks reads null.
    cell = lambda name: F.get("cells", F.get("_at", F.lit(names.index(name)))) if name in names else F.lit(None).cast("string")
    period, key = F.lit(None).cast("date"), F.lit(None).cast("string")
    for d in shaped:
        mine = F.col("dataset") == d.key if "dataset" in keep else F.lit(True)
        period = F.when(mine, dates.period(cell(d.date_col), d.date_kind)).otherwise(period)
        key = F.when(mine, F.trim(cell(d.key_col))).otherwise(key) if d.key_col else key
    figures = F.transform(F.array(*[cell(name) for name in measured]).cast("array<string>"), lambda c: number(c))
    rows = placed.select("doc_id", *keep, "table_ix", "_at", F.posexplode("rows").alias("row_ix", "cells"))
    return settle(rows, period=period, _key=key, _figures=figures).drop("_at", "cells").filter(F.col("period").isNotNull())


def _wide_lines(d: Dataset, panel: Mapping, pattern: str, figure: Callable[[str], Column]) -> list[Column]:
    unit = panel.get("unit", d.unit)
    return [
        F.struct(
            ids.from_pattern(pattern, suffix=F.lit(m.suffix)).alias("series_id"), figure(name).alias("value"),
            F.lit(m.unit or unit).cast("string").alias("unit"), F.lit(name).alias("label"), F.lit(m.zero_ok).alias("zero_ok"), F.lit(k).alias("column_ix"),
        )
        for k, (name, m) in enumerate(_columns(d, panel).items())
    ]


def _keyed_lines(d: Dataset, pattern: str, figure: Callable[[str], Column]) -> list[Column]:
    name = F.col("_key")
    mapped = ids.literal_map(dict(d.key_map))[name] if d.key_map else F.lit(None).cast("string")
    key = F.coalesce(mapped, ids.key_slug(name))
    return [
        F.struct(
            ids.from_pattern(pattern, key=key, col=F.lit(v.upper())).alias("series_id"), figure(v).alias("value"),
            F.lit(d.unit).cast("string").alias("unit"), F.concat(name, F.lit(f" {v}")).alias("label"), F.lit(False).alias("zero_ok"), F.lit(k).alias("column_ix"),
        )
        for k, v in enumerate(d.value_cols)
    ]


def _lines(d: Dataset, datasets: Sequence[Dataset]) -> tuple[Column, Column]:
    """(rank of the variant, array of the lines) of a row of `_rows_read(datasets)` under its own variant and panel."""
    measured = list(dict.fromkeys(name for x in datasets for name in _measured(x)))
    figure = lambda name: F.get("_figures", F.lit(measured.index(name)))
    lines, rank = F.array(), F.lit(0)
    for n, variant in enumerate(_variants(d)):
        mine = F.lit(True) if variant["name"] is None else F.col("variant") == variant["name"]
        rank = F.when(mine, n).otherwise(rank)
        for i, panel in enumerate(_panels(d)):
            pattern = panel.get("id_pattern") or variant.get("id_pattern") or d.id_pattern
            made = _wide_lines(d, panel, pattern, figure) if d.shape == "wide" else _keyed_lines(d, pattern, figure)
            if made:
                lines = F.when(mine & (F.col("table_ix") == i), F.array(*made)).otherwise(lines)
    return rank, lines


def readings(tables: DataFrame, d: Dataset) -> DataFrame:
    """(series_id, period, value, ord, unit, label) of every print in the tables that are read.

    One pass: a row explodes to the lines of its own variant and panel, nothing is shuffled.
    """
    rank, lines = _lines(d, [d])
    out = (
        _rows_read(tables, [d], ["variant"])
        .select("period", F.struct(rank.alias("variant_ix"), "doc_id", "table_ix", "row_ix").alias("ord"), F.explode(lines).alias("_m"))
        .select("_m.series_id", "period", "_m.value", "ord", "_m.unit", "_m.label", "_m.zero_ok")
        .filter(F.col("value").isNotNull() & F.col("series_id").isNotNull())
    )
    if d.zero_is_missing:
        out = out.filter(F.col("zero_ok") | (F.col("value") != 0))
    return out.drop("zero_ok")


def _counts(zero: Column):
    """Whether a line is a reading: it has a series and a value, and zeros count where they may."""
    return lambda m: m["value"].isNotNull() & m["series_id"].isNotNull() & (zero | m["zero_ok"] | (m["value"] != 0))


def _series_of(tables: DataFrame, datasets: Sequence[Dataset]) -> DataFrame:
    """(dataset, series): how many series the read tables of each dataset give, all datasets in one pass."""
    found = F.array().cast("array<string>")
    for d in datasets:
        if d.shape == "records":
            continue
        _, lines = _lines(d, datasets)
        told = F.filter(lines, _counts(F.lit(not d.zero_is_missing)))
        found = F.when(F.col("dataset") == d.key, F.transform(told, lambda m: m["series_id"])).otherwise(found)
    rows = _rows_read(tables, datasets, ["variant", "dataset"])
    return rows.select("dataset", F.explode(found).alias("series_id")).distinct().groupBy("dataset").agg(F.count(F.lit(1)).alias("series"))


EMPTY = {
    "observations": "series_id string, period date, value double",
    "anomalies": "series_id string, period date, kept double, discarded double, dataset string",
    "records": "dataset string, doc_id long, table_ix int, row_ix int, record map<string,string>",
    "catalog": "series_id string, title_en string, dataset string, family string, freq string, unit string, source_url string",
}


def run_dataset(landed: DataFrame, d: Dataset, site: str = "", unescape: bool = True) -> Run:
    """One declared dataset over its landed responses (doc_id, variant, html)."""
    spark = landed.sparkSession
    found = judged_tables(landed.select("doc_id", "variant", "html"), d, unescape)
    empty = {name: spark.createDataFrame([], schema) for name, schema in EMPTY.items()}
    used = found.filter(F.col("status") == READ)
    if d.shape == "records":
        named = F.map_from_arrays(F.array_distinct("columns"), F.transform(F.array_distinct("columns"), lambda c: F.get("cells", F.array_position("columns", c).cast("int") - 1)))
        made = {"records": table_rows(used).select(F.lit(d.key).alias("dataset"), "doc_id", "table_ix", "row_ix", named.alias("record"))}
    else:
        prints = readings(found, d)
        entry = F.min_by(F.struct("label", "unit"), F.struct("ord", "label"))
        catalog = prints.groupBy("series_id").agg(entry.alias("_e")).select(
            "series_id", F.concat(F.lit(d.title_en + " - "), "_e.label").alias("title_en"), F.lit(d.key).alias("dataset"), F.lit(d.family).alias("family"),
            F.lit(d.freq).cast("string").alias("freq"), "_e.unit", F.lit(site + d.path).alias("source_url"),
        )
        made = {"observations": keep_first(prints), "anomalies": anomalies(prints, "ord", d.key), "catalog": catalog}
    rows = F.coalesce(F.sum(F.when(F.col("status") == READ, F.size("rows"))), F.lit(0)).cast("bigint")
    status = found.groupBy().agg(rows.alias("rows")).select(
        F.lit(d.key).alias("dataset"), "rows", F.when(F.col("rows") < d.expect_min_rows, F.lit(SHORT)).otherwise(F.lit(OK)).alias("status")
    )
    if "catalog" in made:
        status = status.join(made["catalog"].groupBy("dataset").agg(F.count(F.lit(1)).alias("series")), "dataset", "left")
    else:
        status = status.withColumn("series", F.lit(0).cast("bigint"))
    status = status.select("dataset", "rows", F.coalesce("series", F.lit(0).cast("bigint")).alias("series"), "status")
    told = found.select(F.lit(d.key).alias("dataset"), "doc_id", "variant", "table_ix", F.size("rows").alias("rows"), "status")
    return Run(**{**empty, **made}, tables=told, status=status)


def judged_registry(landed: DataFrame, datasets: Sequence[Dataset], unescape: bool = True) -> DataFrame:
    """Every table of every dataset's responses with `dataset` and `status`: each response is parsed once.

    `dataset` is a key, or an array of the keys of all datasets a response belongs to.
    """
    found = parsed_tables(landed.select("dataset", "doc_id", "variant", "html"), ["dataset"], unescape)
    if found.schema["dataset"].dataType.typeName() == "array":
        found = found.withColumn("dataset", F.explode("dataset"))
    status = F.lit(None).cast("string")
    for d in datasets:
        status = F.when(F.col("dataset") == d.key, _verdict(d)).otherwise(status)
    return found.withColumn("status", status).filter(F.col("status").isNotNull()).drop("_tables")


def run_registry(landed: DataFrame, datasets: Sequence[Dataset], site: str = "", unescape: bool = True) -> Run:
    """Every declared dataset over its own responses; `landed` has dataset beside doc_id, variant and html.

    `dataset` is a key, or an array of the keys of all datasets a response belongs to. What was
    read and why not, and the status, come from one parse of each response for all datasets.
    """
    many = landed.schema["dataset"].dataType.typeName() == "array"
    mine = lambda d: F.array_contains("dataset", d.key) if many else F.col("dataset") == d.key
    runs = [run_dataset(landed.filter(mine(d)), d, site, unescape) for d in datasets]
    both = lambda name: reduce(lambda a, b: a.unionByName(b), [getattr(r, name) for r in runs])
    found = judged_registry(landed, datasets, unescape)
    told = found.select("dataset", "doc_id", "variant", "table_ix", F.size("rows").alias("rows"), "status")
    declared = landed.sparkSession.createDataFrame([(d.key, d.expect_min_rows or 0) for d in datasets], "dataset string, _floor long")
    read = told.groupBy("dataset").agg(F.coalesce(F.sum(F.when(F.col("status") == READ, F.col("rows"))), F.lit(0)).cast("bigint").alias("rows"))
    zero = lambda n: F.coalesce(n, F.lit(0).cast("bigint"))
    status = declared.join(read, "dataset", "left").join(_series_of(found, datasets), "dataset", "left").select(
        "dataset", zero("rows").alias("rows"), zero("series").alias("series"), F.when(zero("rows") < F.col("_floor"), F.lit(SHORT)).otherwise(F.lit(OK)).alias("status")
    )
    return Run(**{name: both(name) for name in ("observations", "anomalies", "records", "catalog")}, tables=told, status=status)
