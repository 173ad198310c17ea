"""Spreadsheet cell tables to observations.

Input: cells (file_id, r, c, v, is_text) and merges (file_id, r0, c0, r1, c1), both
zero based. All files are read at once, whole, and a header may stand in any row and labels in any
column left of the periods. Steps are keyed by (file, row) or (file, column); only a header, one
row of a sheet, is ever gathered by file. Each header layout is its own expression over the header
cells; a file has exactly one layout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.functions import dates, ids, units
from seriesforge.functions.numbers import number
from seriesforge.functions.text import script_arabic
from seriesforge.session import stored

# Bounds of a sheet and of a merge that a caller may pass.
MAX_ROWS = 1500
MAX_COLS = 120
MAX_MERGE_CELLS = 400

LAYOUTS = ("quarter", "fiscal_year", "month", "year")


def within_caps(cells: DataFrame, rows: int | None = None, cols: int | None = None) -> DataFrame:
    """The sheet without blank cells, cut only to the caps that are given."""
    kept = cells.filter(F.col("v").isNotNull() & (F.trim("v") != ""))
    kept = kept if rows is None else kept.filter(F.col("r") < rows)
    return kept if cols is None else kept.filter(F.col("c") < cols)


def fill_merges(cells: DataFrame, merges: DataFrame, most: int | None = None) -> DataFrame:
    """Top-left value spread over its rectangle; merges of more than `most` cells stay as they are where it is given."""
    size = (F.col("r1") - F.col("r0") + 1) * (F.col("c1") - F.col("c0") + 1)
    box = merges if most is None else merges.filter(size <= most)
    corner = cells.select("file_id", F.col("r").alias("r0"), F.col("c").alias("c0"), "v", "is_text")
    spread = (
        box.join(corner, ["file_id", "r0", "c0"])
        .withColumn("r", F.explode(F.sequence("r0", "r1")))
        .withColumn("c", F.explode(F.sequence("c0", "c1")))
        .select("file_id", "r", "c", "v", "is_text", F.lit(1).alias("_p"))
    )
    both = cells.select("file_id", "r", "c", "v", "is_text", F.lit(0).alias("_p")).unionByName(spread)
    return (
        both.groupBy("file_id", "r", "c")
        .agg(F.max_by(F.struct("v", "is_text"), "_p").alias("_x"))
        .select("file_id", "r", "c", "_x.v", "_x.is_text")
    )


def _tokens(compat: bool) -> dict[str, Column]:
    return {
        "month": dates.month_token("v"),
        "quarter": dates.quarter_token("v"),
        "fiscal_year": dates.fiscal_token("v"),
        "year": dates.year_token("v", compat),
    }


def with_tokens(cells: DataFrame, compat: bool = False) -> DataFrame:
    """Cells with what each says as a header, `month`, `quarter`, `fiscal_year` and `year`, unless they hold it already."""
    return cells if set(LAYOUTS) <= set(cells.columns) else cells.withColumns(_tokens(compat))


def _choose(hits: dict[str, Column], rows: dict[str, Column]) -> tuple[Column, Column, Column]:
    """(strategy, row, reason) from the best row of each detector.

    Two hits are asked for first, then one; quarters and fiscal years are
    unambiguous, months come next, bare years last.
    """
    strategy, row = F.lit(None).cast("string"), F.lit(None).cast("int")
    for threshold in (1, 2):
        for name in reversed(LAYOUTS):
            ok = hits[name] >= threshold
            strategy = F.when(ok, F.lit(name)).otherwise(strategy)
            row = F.when(ok, rows[name]).otherwise(row)
    scores = F.format_string(
        "no period row found (best scores: month=%d, quarter=%d, fiscal_year=%d, year=%d)",
        *[F.coalesce(hits[n], F.lit(0).cast("bigint")) for n in ("month", "quarter", "fiscal_year", "year")],
    )
    return strategy, row, F.when(strategy.isNull(), scores)


def header_rows(cells: DataFrame, compat: bool = False) -> DataFrame:
    """(file_id, strategy, period_row, reason); strategy null and a reason where none was found.

    A sheet of any height: tokens are counted by row, and the best row of each kind is taken by
    file, both with partial aggregation. Most hits win; the earliest row on a tie.
    """
    by_row = with_tokens(cells, compat).groupBy("file_id", "r").agg(*[F.count(n).alias(n) for n in LAYOUTS])
    best = by_row.groupBy("file_id").agg(
        *[F.max(F.struct(F.col(n).alias("hits"), (-F.col("r")).alias("up"))).alias(n) for n in LAYOUTS]
    )
    strategy, row, reason = _choose(
        {n: F.col(f"{n}.hits") for n in LAYOUTS}, {n: -F.col(f"{n}.up") for n in LAYOUTS}
    )
    return best.select("file_id", strategy.alias("strategy"), row.alias("period_row"), reason.alias("reason"))


def _fy(y: Column) -> Column:
    """FY label of the fiscal year that ends in calendar year y."""
    return F.concat(F.lit("FY"), y - 1, F.lit("/"), F.substring(y.cast("string"), 3, 2))


def _month_layout(annual: Column) -> tuple[Column, Column]:
    """Months under a year row: month end, and the fiscal year the month falls in."""
    y, m = F.col("_year"), F.col("month")
    opens = (m >= 7) & ~annual
    return dates.month_end(y, m), F.when(opens, _fy(y + 1)).otherwise(_fy(y))


def _quarter_layout() -> tuple[Column, Column]:
    """Fiscal quarters end in September, December, March, June; the first two open a year."""
    y, q = F.col("_year"), F.col("quarter")
    end_month = F.when(q <= 2, q * 3 + 6).otherwise(q * 3 - 6)
    return dates.month_end(y, end_month), F.when(q <= 2, _fy(y + 1)).otherwise(_fy(y))


def _fiscal_year_layout() -> tuple[Column, Column]:
    t = F.col("fiscal_year")
    return F.make_date(t["end_year"], F.lit(6), F.lit(30)), t["label"]


def _year_layout(annual: Column) -> tuple[Column, Column]:
    """Bare years; the closing month is named near the header, else June for annual files."""
    y = F.col("year")
    m = F.when(F.col("_june"), 6).when(F.col("_december"), 12).when(annual, 6).otherwise(12)
    return dates.month_end(y, m), F.when(m == 6, _fy(y)).otherwise(y.cast("string"))


def _month_years(head: DataFrame, years: DataFrame) -> DataFrame:
    """(file_id, c, year_row, printed): the year row of a month header, and its years above or below the months.

    The nearest row upward that has years in a third of the month columns, else up to three rows down.
    """
    months = head.filter("strategy = 'month'").select("file_id", "c", "period_row", F.count(F.lit(1)).over(Window.partitionBy("file_id")).alias("_months"))
    off = F.col("r") - F.col("period_row")
    met = years.join(months, ["file_id", "c"]).withColumn("_rank", F.when(off < 0, -off).when(off.between(1, 3), off + (1 << 30))).filter(F.col("_rank").isNotNull())
    enough = F.greatest(F.lit(1), F.floor(F.col("_months") / 3))
    rows = met.groupBy("file_id", "r", "_rank", "_months").agg(F.count(F.lit(1)).alias("_years")).filter(F.col("_years") >= enough)
    row = rows.groupBy("file_id").agg(F.min_by("r", "_rank").alias("year_row"))
    at = met.select("file_id", "c", F.col("r").alias("year_row"), F.col("year").alias("printed"))
    return months.select("file_id", "c").join(row, "file_id").join(at, ["file_id", "c", "year_row"], "left").select("file_id", "c", "year_row", "printed")


def _quarter_years(head: DataFrame, years: DataFrame) -> DataFrame:
    """(file_id, c, year_row, printed): years of a quarter header, one and two rows down, then up to three rows up."""
    quarters = head.filter("strategy = 'quarter'").select("file_id", "c", "period_row")
    off = F.col("r") - F.col("period_row")
    rank = F.when(off.isin(1, 2), off).when(off.between(-3, -1), F.lit(2) - off)
    met = years.join(quarters, ["file_id", "c"]).withColumn("_rank", rank).filter(F.col("_rank").isNotNull())
    return met.groupBy("file_id", "c").agg(F.min_by("year", "_rank").alias("printed")).select("file_id", "c", F.lit(None).cast("int").alias("year_row"), "printed")


def column_periods(cells: DataFrame, found: DataFrame, compat: bool = False) -> DataFrame:
    """(file_id, c, period, fy, data_start) of the period columns of every sheet.

    `found` is `header_rows` with `frequency`. Header cells are looked up by (file, row), years by
    (file, column); the only window runs along the columns of a header.
    """
    marked = with_tokens(cells, compat).select("file_id", "r", "c", *LAYOUTS)
    usable = found.filter("strategy is not null").select("file_id", "strategy", "frequency", "period_row", F.col("period_row").alias("r"))
    own = F.coalesce(*[F.when((F.col("strategy") == n) & F.col(n).isNotNull(), F.lit(True)) for n in LAYOUTS])
    head = marked.join(usable, ["file_id", "r"]).filter(own).drop("r")
    years = marked.filter("year is not null").select("file_id", "r", "c", "year")
    printed = _month_years(head, years).unionByName(_quarter_years(head, years)).groupBy("file_id", "c").agg(F.max("year_row").alias("year_row"), F.max("printed").alias("printed"))
    near = cells.filter((F.col("c") < 3) & F.col("is_text") & F.lower("v").rlike("june|december"))
    words = near.join(usable.filter("strategy = 'year'").select("file_id", "period_row"), "file_id").filter(F.col("r") < F.col("period_row") + 2).groupBy("file_id").agg(
        F.max(F.lower("v").contains("june")).alias("_june"), F.max(F.lower("v").contains("december")).alias("_december")
    )
    # A column without a printed year inherits the one to its left.
    leftward = Window.partitionBy("file_id").orderBy("c").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    told = (
        head.join(printed, ["file_id", "c"], "left").join(words, "file_id", "left")
        .withColumn("_year", F.last("printed", ignorenulls=True).over(leftward))
        .withColumns({w: F.coalesce(w, F.lit(False)) for w in ("_june", "_december")})
    )
    annual = F.coalesce(F.col("frequency") == "Annual", F.lit(False))
    layouts = {
        "month": _month_layout(annual),
        "quarter": _quarter_layout(),
        "fiscal_year": _fiscal_year_layout(),
        "year": _year_layout(annual),
    }
    period, fy = F.lit(None).cast("date"), F.lit(None).cast("string")
    for name, (p, label) in layouts.items():
        mine = F.col("strategy") == name
        period, fy = F.when(mine, p).otherwise(period), F.when(mine, label).otherwise(fy)
    start = F.greatest("period_row", F.max("year_row").over(Window.partitionBy("file_id")))
    return told.select("file_id", "c", period.alias("period"), fy.alias("fy"), start.alias("data_start")).filter("period is not null")


def label_columns(cells: DataFrame, starts: DataFrame) -> DataFrame:
    """(file_id, en_col, ar_col): the first columns left of the periods with text on data lines, told apart by script.

    `starts` has file_id, data_start and first_col.
    """
    told = (
        cells.filter("is_text").join(starts, "file_id").filter((F.col("c") < F.col("first_col")) & (F.col("r") > F.col("data_start")))
        .groupBy("file_id", "c").agg(F.max(script_arabic(F.col("v"))).alias("_arabic"))
    )
    return told.groupBy("file_id").agg(F.min(F.when(~F.col("_arabic"), F.col("c"))).alias("en_col"), F.min(F.when(F.col("_arabic"), F.col("c"))).alias("ar_col"))


def caption_units(cells: DataFrame, starts: DataFrame) -> DataFrame:
    """(file_id, caption_unit): what the rows down to the header say, row by row; money before percent before counts, then the upper row."""
    above = cells.join(starts.select("file_id", "data_start"), "file_id").filter(F.col("r") <= F.col("data_start"))
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c", "v"))), lambda x: x["v"]), " ")
    rows = above.groupBy("file_id", "r").agg(units.caption_unit(line).alias("unit")).filter("unit is not null")
    rank = F.array_position(F.lit(["percent", *(unit for unit, _ in units.CAPTION_WORDS)]), F.col("unit"))
    return rows.groupBy("file_id").agg(F.min_by("unit", F.struct(rank, "r")).alias("caption_unit"))


FREQUENCIES = {"Annual": "A", "Quarterly": "Q", "Monthly": "M"}
FISCAL_BASIS = "Egypt, 1 July to 30 June"


def melt(cells: DataFrame, files: DataFrame, prefix: str = "EG.XL", compat: bool = False) -> tuple[DataFrame, DataFrame]:
    """(observations, quarantine) of all files.

    `files` has file_id, category, subcategory, frequency, url and file_ord. An
    observation carries file_ord and row_ord, so `keep_last` merges files and
    collisions inside one file stay visible. Periods meet their cells by (file, column) and
    labels by (file, row), so a cell carries its own two facts only. The quarantine has one row a
    file without observations, with the facts of the file and the reason.
    """
    # What a cell says as a header is read in several steps, so it is worked out once and kept beside the cell.
    cells = stored(with_tokens(cells.select("file_id", "r", "c", "v", "is_text"), compat), "cells")
    known = files.withColumn("frequency", F.coalesce("frequency", F.lit("Monthly")))
    found = stored(header_rows(cells, compat).join(known.select("file_id", "frequency"), "file_id"), "headers")
    periods = stored(column_periods(cells, found, compat), "periods")
    starts = periods.groupBy("file_id").agg(F.min("c").alias("first_col"), F.max("data_start").alias("data_start"))
    info = stored(starts.join(label_columns(cells, starts), "file_id", "left").join(caption_units(cells, starts), "file_id", "left"), "sheets")

    name = F.trim("v")
    label = F.struct(name.alias("label"), ids.label_tail(name).alias("tail"), units.label_unit(name).alias("unit"), units.indent_level(F.col("v")).alias("level"))
    lines = (
        cells.join(info.select("file_id", "data_start", "en_col", "ar_col"), "file_id")
        .filter((F.col("r") > F.col("data_start")) & ((F.col("c") == F.col("en_col")) | (F.col("c") == F.col("ar_col"))) & (name != ""))
        .groupBy("file_id", "r").agg(
            F.max(F.when(F.col("c") == F.col("en_col"), label)).alias("_en"), F.max(F.when(F.col("c") == F.col("ar_col"), label)).alias("_ar")
        )
        .select("file_id", "r", F.coalesce("_en", "_ar").alias("_line"), F.col("_ar.label").alias("label_ar"))
    )
    about = known.select("file_id", "file_ord", "category", "subcategory", "frequency", F.col("url").alias("source_file")).join(info.select("file_id", "caption_unit"), "file_id")
    obs = (
        cells.join(periods, ["file_id", "c"])
        .filter(F.col("r") > F.col("data_start"))
        .select("file_id", "r", "c", "period", "fy", number("v", "sheet").alias("value"))
        .filter("value is not null")
        .join(lines, ["file_id", "r"])
        .join(about, "file_id")
        .select(
            F.concat_ws(
                ".", F.lit(prefix), ids.category_code(F.col("category")),
                ids.label_slug(F.col("subcategory"), 30), F.col("_line.tail"),
            ).alias("series_id"),
            "period", "value", "fy", F.lit("end").alias("basis"),
            "file_id", "file_ord", F.col("r").alias("row_ord"), F.col("c").alias("col_ord"),
            F.col("_line.label").alias("label"), "label_ar", F.col("_line.level").alias("level"),
            F.coalesce("_line.unit", "caption_unit").alias("unit"),
            ids.category_family(F.col("category")).alias("family"),
            F.element_at(F.create_map(*[F.lit(x) for kv in FREQUENCIES.items() for x in kv]), F.col("frequency")).alias("freq"),
            F.concat_ws(" - ", "subcategory", "_line.label").alias("title_en"), "source_file",
        )
    )
    problem = (
        F.when(F.col("_seen").isNull(), F.lit("empty sheet"))
        .when(F.col("reason").isNotNull(), F.col("reason"))
        .when(F.col("first_col").isNull(), F.lit("no periods resolved"))
        .when(F.col("en_col").isNull() & F.col("ar_col").isNull(), F.lit("no label column found"))
        .when(F.col("_read").isNull(), F.lit("parsed but produced no observations"))
    )
    told = known.join(found.select("file_id", "reason", F.lit(True).alias("_seen")), "file_id", "left")
    told = told.join(info.select("file_id", "first_col", "en_col", "ar_col"), "file_id", "left")
    told = told.join(obs.select("file_id").distinct().withColumn("_read", F.lit(True)), "file_id", "left")
    quarantine = told.select("file_id", "url", "category", "subcategory", "frequency", problem.alias("reason")).filter("reason is not null")
    return obs, quarantine


def collisions(obs: DataFrame) -> DataFrame:
    """Different values one file gives the same series and period: equal labels under different parents."""
    return (
        obs.groupBy("file_id", "series_id", "period")
        .agg(
            F.max_by("value", F.struct("row_ord", "col_ord")).alias("kept"),
            F.min_by("value", F.struct("row_ord", "col_ord")).alias("discarded"),
            F.count_distinct("value").alias("values"),
        )
        .filter("values > 1")
    )


def catalog_entries(obs: DataFrame) -> DataFrame:
    """One catalog entry per series: the first row of a file, the last file."""
    entry = F.struct("title_en", "label_ar", "family", "freq", "unit", "level", "source_file")
    at = F.struct(F.col("file_ord"), -F.col("row_ord"), -F.col("col_ord"))
    return (
        obs.groupBy("series_id")
        .agg(F.max_by(entry, at).alias("_e"))
        .select(
            "series_id", "_e.title_en", F.col("_e.label_ar").alias("title_ar"), F.lit("excel_archive").alias("dataset"),
            "_e.family", "_e.freq", "_e.unit", "_e.level", F.lit("end").alias("period_basis"),
            F.lit(FISCAL_BASIS).alias("fiscal_year_basis"), "_e.source_file",
        )
    )
