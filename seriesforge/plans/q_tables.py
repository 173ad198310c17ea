"""Printed tables, spreadsheet grids, listings and releases, read back into figures.

Spark prints the fragments, cells and sentences from the driver tables; the
operators read them back; the check states the figures straight from the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesforge.functions import dates
from seriesforge.functions.numbers import number
from seriesforge.operators import events, press, quality, statements
from seriesforge.plans import views as v
from seriesforge.plans.catalog import query
from seriesforge.sources import datasets, grids, registry, tables


def _wrap(tag, *parts):
    return F.concat(F.lit(f"<{tag}>"), *parts, F.lit(f"</{tag}>"))


def order_fragments(spark, sf):
    """One HTML fragment per order: a price panel with a grouped header, then a tax panel.

    Headers repeat after each row, some rows are short, some orders have no second
    panel, some say there is nothing. An order has a handful of lines.
    """
    day = F.date_format(F.col("l_shipdate").cast("date"), "d/M/yyyy")
    head = '<tr class="h"><th>Issue Date</th><th colspan="2">Line&nbsp;item</th></tr><tr><th></th><th> Price </th><th>Qty</th></tr>'
    qty = F.when(F.col("l_linenumber") == 2, F.lit("")).otherwise(_wrap("td", F.col("l_quantity").cast("int").cast("string")))
    price_row = F.concat(_wrap("tr", _wrap("td", day), _wrap("td", F.lit("<b>"), F.format_number("l_extendedprice", 2), F.lit("</b>")), qty), F.lit("<tr><th>Issue Date</th><th>x</th><th>y</th></tr>"))
    tax_row = _wrap("tr", _wrap("td", day), _wrap("td", (F.col("l_tax") * 100).cast("int").cast("string"), F.lit(" %")))
    lines = v.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.array_join(F.array_sort(F.collect_list(price_row)), "").alias("_p"),
        F.array_join(F.array_sort(F.collect_list(tax_row)), "").alias("_t"),
    )
    first = F.concat(F.lit('<div><table border="1">' + head), "_p", F.lit("</table>"))
    other = F.when(F.col("l_orderkey") % 10 == 0, F.lit("Date")).otherwise(F.lit("Issue Date"))
    second = F.concat(F.lit("<table><tr><th>"), other, F.lit("</th><th>Tax</th></tr>"), "_t", F.lit("</table>"))
    body = (
        F.when(F.col("l_orderkey") % 17 == 0, F.lit("<p>There are no matching results.</p><table><tr><th>a</th></tr></table>"))
        .when(F.col("l_orderkey") % 5 == 0, F.concat(first, second))
        .otherwise(first)
    )
    # Landed responses come as many files; a shuffled stand-in this small would come as one piece.
    return lines.select(F.col("l_orderkey").alias("doc_id"), body.alias("html"))


@query(
    "a3_table_records", "A3 A5 A6 A7 C1 C3",
    v.dated("""SELECT l_orderkey AS doc_id, CAST(l_shipdate AS DATE) AS issued, l_extendedprice AS price,
  CASE WHEN l_linenumber <> 2 THEN l_quantity END AS qty FROM lineitem WHERE l_orderkey % 17 <> 0""", "issued"),
)
def table_records(spark, sf):
    rows = tables.table_rows(tables.html_tables(order_fragments(spark, sf))).filter("table_ix = 0")
    rec = tables.records(rows, ["Issue Date", "Line item - Price", "Line item - Qty"])
    return v.iso(rec.select(
        "doc_id", dates.dmy("Issue Date").alias("issued"), number("Line item - Price").alias("price"), number("Line item - Qty").alias("qty")
    ))


@query(
    "a6_table_headers", "A6 A7",
    """WITH d AS (SELECT DISTINCT l_orderkey AS doc_id FROM lineitem WHERE l_orderkey % 17 <> 0),
w AS (SELECT l_orderkey AS doc_id, max(CASE WHEN l_linenumber <> 2 THEN 3 ELSE 2 END) AS width FROM lineitem GROUP BY 1)
SELECT doc_id, 0 AS table_ix, CASE WHEN width = 3 THEN 'Issue Date|Line item - Price|Line item - Qty' ELSE 'Issue Date|Line item - Price' END AS columns FROM d JOIN w USING (doc_id)
UNION ALL SELECT doc_id, 1, CASE WHEN doc_id % 10 = 0 THEN 'Date|Tax' ELSE 'Issue Date|Tax' END FROM d WHERE doc_id % 5 = 0""",
)
def table_headers(spark, sf):
    h = tables.html_tables(order_fragments(spark, sf))
    return h.select("doc_id", "table_ix", F.array_join("columns", "|").alias("columns"))


@query(
    "e3_panels", "E3 D4",
    v.dated("""WITH l AS (SELECT l_orderkey, CAST(l_shipdate AS DATE) AS period, l_extendedprice, l_tax FROM lineitem WHERE l_orderkey % 17 <> 0)
SELECT l_orderkey AS doc_id, 'P.PRICE' AS series_id, period, l_extendedprice AS value FROM l
UNION ALL SELECT l_orderkey, 'P.TAX', period, CAST(CAST(trunc(l_tax * 100) AS INT) AS DOUBLE) FROM l WHERE l_orderkey % 5 = 0""", "period"),
)
def panels(spark, sf):
    rows = tables.table_rows(tables.html_tables(order_fragments(spark, sf)))
    p = tables.panel_rows(rows, [{"id_pattern": "P.PRICE"}, {"id_pattern": "P.TAX"}])
    return v.iso(p.select(
        "doc_id", F.col("pattern").alias("series_id"), dates.dmy(F.get("cells", F.lit(0))).alias("period"),
        number(F.get("cells", F.lit(1))).alias("value"),
    ))


PRICE_MEASURES = {"Line item - Price": {"suffix": "PRICE", "unit": "EGP"}, "Line item - Qty": {"suffix": "QTY", "unit": "number"}}
DECLARED = registry.load([
    {"key": "lines", "shape": "wide", "title_en": "Order lines", "family": "govt", "freq": "D", "path": "/lines", "date_col": "Issue Date", "expect_min_rows": 10,
     "zero_is_missing": True, "variants": [{"radio": "even", "id_pattern": "E.{suffix}"}, {"radio": "odd", "id_pattern": "O.{suffix}"}],
     "tables": [{"columns": PRICE_MEASURES}, {"columns": {"Tax": {"suffix": "TAX", "unit": "percent", "zero_ok": True}}}]},
    {"key": "prices", "shape": "long_by_key", "title_en": "Prices by quantity", "family": "misc", "date_col": "Issue Date", "key_col": "Line item - Qty", "key_map": {"1": "ONE", "2": "TWO"},
     "value_cols": ["Line item - Price"], "id_pattern": "K.{key}", "unit": "EGP", "path": "/prices", "expect_min_rows": 1000000000},
    {"key": "printed", "shape": "records", "title_en": "As printed", "path": "/printed"},
])


def _landed(spark, sf):
    """Each order's fragment as a landed response of all declared datasets, in two variants."""
    f = order_fragments(spark, sf).withColumn("variant", F.when(F.col("doc_id") % 2 == 0, F.lit("even")).otherwise(F.lit("odd")))
    return f.withColumn("variant", F.when(F.col("doc_id") % 23 != 0, F.col("variant")))


# Printed lines: table 0 has price and quantity (none on line 2), table 1 the tax; both in the order of the printed rows.
LINES_SQL = """l AS (SELECT l_orderkey AS doc_id, CASE WHEN l_orderkey % 23 <> 0 THEN CASE WHEN l_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END END AS variant, CAST(l_shipdate AS DATE) AS period,
  l_extendedprice AS price, CASE WHEN l_linenumber <> 2 THEN CAST(CAST(l_quantity AS INT) AS DOUBLE) END AS qty, CAST(CAST(trunc(l_tax * 100) AS INT) AS DOUBLE) AS tax,
  '<tr><td>' || day(l_shipdate) || '/' || month(l_shipdate) || '/' || year(l_shipdate) || '</td><td><b>' || format('{:,.2f}', l_extendedprice) || '</b></td>' || CASE WHEN l_linenumber = 2 THEN '' ELSE '<td>' || CAST(l_quantity AS INT) || '</td>' END || '</tr>' AS price_row,
  '<tr><td>' || day(l_shipdate) || '/' || month(l_shipdate) || '/' || year(l_shipdate) || '</td><td>' || CAST(trunc(l_tax * 100) AS INT) || ' %</td></tr>' AS tax_row
  FROM lineitem WHERE l_orderkey % 17 <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY price_row) AS pr, row_number() OVER (PARTITION BY doc_id ORDER BY tax_row) AS tr FROM l)"""
WIDE_SQL = f"""WITH {LINES_SQL}, x AS (
  SELECT 'PRICE' AS suffix, variant, doc_id, 0 AS t, pr AS n, period, price AS value, 'EGP' AS unit, 'Line item - Price' AS label FROM r WHERE price <> 0
  UNION ALL SELECT 'QTY', variant, doc_id, 0, pr, period, qty, 'number', 'Line item - Qty' FROM r WHERE qty <> 0
  UNION ALL SELECT 'TAX', variant, doc_id, 1, tr, period, tax, 'percent', 'Tax' FROM r WHERE doc_id % 5 = 0 AND doc_id % 10 <> 0),
p AS (SELECT upper(left(variant, 1)) || '.' || suffix AS series_id, * FROM x WHERE variant IS NOT NULL),
f AS (SELECT series_id, period, arg_min(value, (doc_id, t, n)) AS value FROM p GROUP BY 1, 2)"""


@query("a1_wide_dataset", "A1 E1 E3 E4 E5 F1 D1", v.dated(WIDE_SQL + "SELECT series_id, period, value FROM f", "period"))
def wide_dataset(spark, sf):
    return v.iso(datasets.run_dataset(_landed(spark, sf), DECLARED[0]).observations)


@query(
    "a1_dataset_anomalies", "A1 F1 D6",
    v.dated(WIDE_SQL + "SELECT series_id, period, f.value AS kept, p.value AS discarded, 'lines' AS dataset FROM p JOIN f USING (series_id, period) WHERE p.value <> f.value", "period"),
)
def dataset_anomalies(spark, sf):
    return v.iso(datasets.run_dataset(_landed(spark, sf), DECLARED[0]).anomalies)


@query(
    "a1_dataset_catalog", "A1 F6",
    WIDE_SQL + """SELECT series_id, 'Order lines - ' || any_value(label) AS title_en, 'lines' AS dataset, 'govt' AS family, 'D' AS freq, any_value(unit) AS unit, 'https://example.org/lines' AS source_url FROM p GROUP BY 1""",
)
def dataset_catalog(spark, sf):
    return datasets.run_dataset(_landed(spark, sf), DECLARED[0], "https://example.org").catalog


@query(
    "a1_keyed_dataset", "A1 E2 F1 C10",
    v.dated(f"""WITH {LINES_SQL}, p AS (SELECT 'K.' || CASE qty WHEN 1 THEN 'ONE' WHEN 2 THEN 'TWO' ELSE CAST(CAST(qty AS INT) AS VARCHAR) END AS series_id, * FROM r WHERE doc_id % 5 <> 0 AND qty IS NOT NULL)
SELECT series_id, period, arg_min(price, (doc_id, pr)) AS value FROM p GROUP BY 1, 2 UNION ALL
SELECT 'K.' AS series_id, period, arg_min(price, (doc_id, pr)) AS value FROM r WHERE doc_id % 5 <> 0 AND qty IS NULL AND doc_id IN (SELECT doc_id FROM r WHERE qty IS NOT NULL) GROUP BY 1, 2""", "period"),
)
def keyed_dataset(spark, sf):
    return v.iso(datasets.run_dataset(_landed(spark, sf), DECLARED[1]).observations)


@query(
    "a1_record_dataset", "A1 E5 A3",
    f"""WITH {LINES_SQL}, d AS (SELECT doc_id, max(qty IS NOT NULL) AS wide FROM r GROUP BY 1)
SELECT doc_id, 0 AS table_ix, CAST(pr - 1 AS INT) AS row_ix, 'Issue Date=' || day(period) || '/' || month(period) || '/' || year(period) || ';Line item - Price=' || format('{{:,.2f}}', price) ||
  CASE WHEN wide THEN ';Line item - Qty=' || coalesce(CAST(CAST(qty AS INT) AS VARCHAR), '') ELSE '' END AS record FROM r JOIN d USING (doc_id)
UNION ALL SELECT doc_id, 1, CAST(tr - 1 AS INT), CASE WHEN doc_id % 10 = 0 THEN 'Date=' ELSE 'Issue Date=' END || day(period) || '/' || month(period) || '/' || year(period) || ';Tax=' || CAST(tax AS INT) || ' %' FROM r WHERE doc_id % 5 = 0""",
)
def record_dataset(spark, sf):
    rec = datasets.run_dataset(_landed(spark, sf), DECLARED[2]).records
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("record")), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return rec.select("doc_id", "table_ix", "row_ix", shown.alias("record"))


@query(
    "a1_dataset_tables", "A1 E3 D3 D4",
    f"""WITH {LINES_SQL}, t AS (SELECT doc_id, any_value(variant) AS variant, count(*) AS rows, max(qty IS NOT NULL) AS wide FROM r GROUP BY 1),
a AS (SELECT * FROM t, (SELECT unnest([0, 1]) AS table_ix) WHERE table_ix = 0 OR doc_id % 5 = 0),
j AS (SELECT 'lines' AS dataset, table_ix, rows, CASE WHEN variant IS NULL THEN 'undeclared variant' WHEN table_ix = 1 AND doc_id % 10 = 0 THEN 'no date column' ELSE 'read' END AS status FROM a
  UNION ALL SELECT 'prices', table_ix, rows, CASE WHEN doc_id % 5 = 0 THEN 'several tables and no panels' WHEN NOT wide THEN 'no key column' ELSE 'read' END FROM a
  UNION ALL SELECT 'printed', table_ix, rows, 'read' FROM a)
SELECT dataset, table_ix, status, count(*) AS tables, CAST(sum(rows) AS BIGINT) AS rows FROM j GROUP BY 1, 2, 3""",
)
def dataset_tables(spark, sf):
    told = datasets.run_registry(_all_landed(spark, sf), DECLARED).tables
    return told.groupBy("dataset", "table_ix", "status").agg(F.count(F.lit(1)).alias("tables"), F.sum("rows").alias("rows"))


def _all_landed(spark, sf):
    return _landed(spark, sf).withColumn("dataset", F.array(*[F.lit(d.key) for d in DECLARED]))


@query(
    "a1_dataset_status", "A1 D3",
    WIDE_SQL + """, k AS (SELECT count(*) AS rows, count(DISTINCT coalesce(qty, -1)) AS series FROM r WHERE doc_id % 5 <> 0 AND doc_id IN (SELECT doc_id FROM r WHERE qty IS NOT NULL))
SELECT 'lines' AS dataset, (SELECT count(*) FROM r WHERE variant IS NOT NULL) + (SELECT count(*) FROM r WHERE variant IS NOT NULL AND doc_id % 5 = 0 AND doc_id % 10 <> 0) AS rows, (SELECT count(DISTINCT series_id) FROM p) AS series, 'ok' AS status
UNION ALL SELECT 'prices', rows, series, 'short' FROM k UNION ALL SELECT 'printed', count(*) + count(*) FILTER (doc_id % 5 = 0), 0, 'ok' FROM r""",
)
def dataset_status(spark, sf):
    return datasets.run_registry(_all_landed(spark, sf), DECLARED).status


@query(
    "d4_panel_guard", "D4",
    "SELECT DISTINCT l_orderkey AS doc_id FROM lineitem WHERE l_orderkey % 5 = 0 AND l_orderkey % 17 <> 0 AND l_orderkey % 2 = 1",
)
def panel_guard(spark, sf):
    found = tables.html_tables(order_fragments(spark, sf)).withColumn(
        "dataset", F.when(F.col("doc_id") % 2 == 0, F.lit("declared")).otherwise(F.lit("undeclared"))
    )
    specs = spark.createDataFrame([("declared", 2), ("undeclared", 0)], "dataset string, panels int")
    return quality.panel_guard(found, specs).select("doc_id")


@query(
    "d5_layout_guard", "D5 D6",
    """SELECT DISTINCT l_orderkey AS doc_id FROM lineitem WHERE l_orderkey % 5 = 0 AND l_orderkey % 17 <> 0""",
)
def layout_guard(spark, sf):
    h = tables.html_tables(order_fragments(spark, sf))
    return quality.layout_guard(h).select("doc_id")


@query(
    "d6_missing_columns", "D6",
    """SELECT DISTINCT l_orderkey AS doc_id, 1 AS table_ix, 'Issue Date' AS missing FROM lineitem WHERE l_orderkey % 10 = 0 AND l_orderkey % 17 <> 0""",
)
def missing_columns(spark, sf):
    h = tables.html_tables(order_fragments(spark, sf))
    return quality.missing_columns(h, ["Issue Date", "Tax"], optional=["Tax"]).select("doc_id", "table_ix", F.array_join("missing", ",").alias("missing"))


@query(
    "a14_archive_cards", "A14",
    """SELECT p_partkey, CAST(i AS INT) AS link_ix, '/-/media/' || p_partkey || '/' || i || '.xlsx' AS url, 'Jul ' || i || ' & on' AS period_label,
  p_type AS frequency, p_name AS subcategory FROM part, (VALUES (0), (1)) t(i)""",
)
def archive_cards(spark, sf):
    link = lambda i: F.concat(
        F.lit('<a href="/-/media/'), F.col("p_partkey"), F.lit(f'/{i}.xlsx" target="_blank" class="uploaded-doc"> <i>Jul</i> {i} &amp; on</a>')
    )
    card = F.concat(
        F.lit('<div class="data-list dlList-item"><span class="tag"> '), "p_type", F.lit('\n</span><h2 class="title">'), "p_name",
        F.lit("</h2>"), link(0), link(1), F.lit("</div>"),
    )
    frag = v.table(spark, sf, "part").select("p_partkey", F.concat(F.lit("<section>"), card, F.lit("</section>")).alias("html"))
    return tables.archive_cards(frag, keep=["p_partkey"]).drop("card_ix")


@query(
    "a15_sheet_caps", "A15",
    """SELECT l_suppkey AS file_id, count(*) AS cells FROM lineitem WHERE l_orderkey % 2000 < 1500 AND l_linenumber * 20 < 120 GROUP BY 1""",
)
def sheet_caps(spark, sf):
    c = v.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("file_id"), (F.col("l_orderkey") % 2000).cast("int").alias("r"), (F.col("l_linenumber") * 20).alias("c"),
        F.col("l_quantity").cast("string").alias("v"), F.lit(False).alias("is_text"),
    )
    return grids.within_caps(c, grids.MAX_ROWS, grids.MAX_COLS).groupBy("file_id").agg(F.count(F.lit(1)).alias("cells"))


FLAGS = ["A", "N", "R"]


def sheets(spark, sf):
    """(cells, merges, files): one sheet per supplier and fiscal year, in four header layouts.

    The supplier number picks the layout: months under merged years, quarters with
    the year printed below, fiscal years in the header, bare years. A fifth kind has
    no period row at all.
    """
    d = F.col("l_shipdate").cast("date")
    month, year = F.month(d), F.year(d)
    fy = F.when(month >= 7, year).otherwise(year - 1)
    kind = F.col("l_suppkey") % 5
    c = (
        F.when(kind == 0, F.lit(2) + (month + 5) % 12)
        .when(kind == 1, F.lit(2) + F.floor(((month + 5) % 12) / 3))
        .when(kind == 2, F.lit(2) + fy - 1990)
        .when(kind == 3, F.lit(2) + year - 1990)
        .otherwise(F.lit(2))
    ).cast("int")
    sheet = F.when(kind <= 1, fy).otherwise(F.lit(0))
    base = (
        v.table(spark, sf, "lineitem")
        .groupBy(
            F.col("l_suppkey").alias("supp"), kind.alias("kind"), sheet.alias("fy"), c.alias("c"),
            F.when(kind <= 2, fy).otherwise(year).alias("y"), "l_returnflag",
        )
        .agg(F.max("l_extendedprice").alias("price"))
    )
    fid = F.concat_ws("-", "supp", "fy")
    row = F.array_position(F.array(*[F.lit(f) for f in FLAGS]), F.col("l_returnflag")).cast("int") + 3
    names = F.array(*[F.lit(n) for n in "Jul. Aug. Sept. Oct. Nov. Dec. Jan. Feb. Mar. Apr. May. June".split()])
    windows = F.array(*[F.lit(n) for n in ("July/Sep", "Oct/Dec", "Jan/Mar", "Apr/June")])

    def cell(r, c_, text, is_text=True):
        at = lambda x: (F.lit(x) if isinstance(x, int) else x).cast("int")
        return F.struct(at(r).alias("r"), at(c_).alias("c"), text.cast("string").alias("v"), F.lit(is_text).alias("is_text"))

    def across(n, make):
        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), make)

    fy_, y = F.col("fy"), F.col("y")
    heads = (
        F.when(F.col("kind") == 0, F.concat(
            across(12, lambda i: cell(2, i + 2, F.get(names, i))),
            F.array(cell(1, 2, fy_, False), cell(1, 8, fy_ + 1, False)),
        ))
        .when(F.col("kind") == 1, F.concat(
            across(4, lambda i: cell(1, i + 2, F.concat(F.lit("Q"), i + 1))),
            across(4, lambda i: cell(2, i + 2, F.concat_ws(" ", F.get(windows, i), (fy_ + F.floor(i / 2)).cast("string")))),
        ))
        .when(F.col("kind") == 2, F.array(cell(2, F.col("c"), F.concat_ws("/", y.cast("string"), (y + 1).cast("string")))))
        .when(F.col("kind") == 3, F.array(cell(2, F.col("c"), y, False), cell(2, 0, F.lit("End of December"))))
        .otherwise(F.array(cell(0, 1, F.lit("no header"))))
    )
    body = F.array(
        cell(row, F.col("c"), F.format_number("price", 2), False),
        cell(row, 0, F.concat(F.lit("    Flag "), "l_returnflag")),
        cell(row, 1, F.concat(F.lit("بند "), "l_returnflag")),
        cell(0, 0, F.lit("Flows of the year (LE mn)")),
    )
    # Shared headers and labels come once per reading; one aggregation keeps one of each.
    cells = (
        base.select(fid.alias("file_id"), F.inline(F.concat(body, heads)))
        .groupBy("file_id", "r", "c")
        .agg(F.max(F.struct("v", "is_text")).alias("_x"))
        .select("file_id", "r", "c", "_x.v", "_x.is_text")
    )
    sheets_ = base.select(fid.alias("file_id"), "kind", "fy").distinct()
    tops = sheets_.filter("kind = 0")
    box = lambda c0, c1: tops.select("file_id", *[F.lit(x).alias(n) for n, x in (("r0", 1), ("c0", c0), ("r1", 1), ("c1", c1))])
    files = sheets_.select(
        "file_id", F.lit("GDP").alias("category"), F.concat(F.lit("Supplier "), F.split_part("file_id", F.lit("-"), F.lit(1))).alias("subcategory"),
        F.when(F.col("kind") == 1, F.lit("Quarterly")).when(F.col("kind") >= 2, F.lit("Annual")).otherwise(F.lit("Monthly")).alias("frequency"),
        F.concat(F.lit("/-/media/"), "file_id").alias("url"), F.col("fy").alias("file_ord"),
    )
    return cells, box(2, 7).unionByName(box(8, 13)), files


SHEET_SQL = """WITH d AS (SELECT l_suppkey AS supp, l_suppkey % 5 AS kind, l_returnflag AS flag, CAST(l_shipdate AS DATE) AS day, l_extendedprice AS price FROM lineitem),
p AS (SELECT *, year(day) - CASE WHEN month(day) >= 7 THEN 0 ELSE 1 END AS fy FROM d WHERE kind < 4),
q AS (SELECT 'EG.XL.GDP.SUPPLIER_' || supp || '.FLAG_' || flag AS series_id,
  CASE kind WHEN 0 THEN last_day(day) WHEN 1 THEN last_day(CAST(date_trunc('quarter', day) AS DATE) + INTERVAL 2 MONTH)
    WHEN 2 THEN make_date(fy + 1, 6, 30) ELSE make_date(year(day), 12, 31) END AS period,
  CASE WHEN kind = 3 THEN CAST(year(day) AS VARCHAR) ELSE 'FY' || fy || '/' || right(CAST(fy + 1 AS VARCHAR), 2) END AS fy, price FROM p)
SELECT series_id, period, fy, max(price) AS value, 'EGP million' AS unit, 2 AS level FROM q GROUP BY 1, 2, 3"""


@query("e13_grid_observations", "E6 E7 E8 E9 E10 E11 E12 E13 C15 C16 F2 I5", v.dated(SHEET_SQL, "period"))
def grid_observations(spark, sf):
    cells, merged, files = sheets(spark, sf)
    obs, _ = grids.melt(grids.fill_merges(grids.within_caps(cells), merged), files)
    return v.iso(obs.select("series_id", "period", "fy", "value", "unit", "level"))


@query(
    "e7_grid_layouts", "E7",
    """WITH s AS (SELECT DISTINCT l_suppkey AS supp, l_suppkey % 5 AS kind, CASE WHEN l_suppkey % 5 <= 1
  THEN year(l_shipdate) - CASE WHEN month(l_shipdate) >= 7 THEN 0 ELSE 1 END ELSE 0 END AS fy FROM lineitem WHERE l_suppkey % 5 < 4)
SELECT supp || '-' || fy AS file_id, list_extract(['month', 'quarter', 'fiscal_year', 'year'], CAST(kind AS INT) + 1) AS strategy, CASE WHEN kind = 1 THEN 1 ELSE 2 END AS period_row FROM s""",
)
def grid_layouts(spark, sf):
    cells, merged, _ = sheets(spark, sf)
    found = grids.header_rows(grids.fill_merges(grids.within_caps(cells), merged))
    return found.filter("strategy is not null").select("file_id", "strategy", "period_row")


@query(
    "e6_merged_cells", "E6",
    """WITH s AS (SELECT DISTINCT l_suppkey AS supp, year(l_shipdate) - CASE WHEN month(l_shipdate) >= 7 THEN 0 ELSE 1 END AS fy FROM lineitem WHERE l_suppkey % 5 = 0)
SELECT supp || '-' || fy AS file_id, CAST(c AS INT) AS c, CAST(CASE WHEN c < 8 THEN fy ELSE fy + 1 END AS VARCHAR) AS year FROM s, range(2, 14) t(c)""",
)
def merged_cells(spark, sf):
    cells, merged, _ = sheets(spark, sf)
    filled = grids.fill_merges(grids.within_caps(cells), merged)
    monthly = F.split_part("file_id", F.lit("-"), F.lit(1)).cast("int") % 5 == 0
    return filled.filter((F.col("r") == 1) & monthly).select("file_id", "c", F.col("v").alias("year"))


@query(
    "e13_grid_quarantine", "E7 E13 H10",
    """SELECT DISTINCT l_suppkey || '-0' AS file_id, '/-/media/' || l_suppkey || '-0' AS url, 'GDP' AS category, 'Supplier ' || l_suppkey AS subcategory, 'Annual' AS frequency, 'no period row found (best scores: month=0, quarter=0, fiscal_year=0, year=0)' AS reason FROM lineitem WHERE l_suppkey % 5 = 4""",
)
def grid_quarantine(spark, sf):
    cells, merged, files = sheets(spark, sf)
    _, bad = grids.melt(grids.fill_merges(grids.within_caps(cells), merged), files)
    return bad


@query(
    "e13_grid_catalog", "F6 E13",
    """SELECT DISTINCT 'EG.XL.GDP.SUPPLIER_' || l_suppkey || '.FLAG_' || l_returnflag AS series_id, 'Supplier ' || l_suppkey || ' - Flag ' || l_returnflag AS title_en,
  'بند ' || l_returnflag AS title_ar, 'gdp' AS family, 'EGP million' AS unit, CASE l_suppkey % 5 WHEN 0 THEN 'M' WHEN 1 THEN 'Q' ELSE 'A' END AS freq,
  'Egypt, 1 July to 30 June' AS fiscal_year_basis, 2 AS level FROM lineitem WHERE l_suppkey % 5 < 4""",
)
def grid_catalog(spark, sf):
    cells, merged, files = sheets(spark, sf)
    obs, _ = grids.melt(grids.fill_merges(grids.within_caps(cells), merged), files)
    return grids.catalog_entries(obs).select("series_id", "title_en", "title_ar", "family", "unit", "freq", "fiscal_year_basis", "level")


@query("e12_tall_sheets", "E7 E8 E9 E10 E11 E12 E13", v.dated(SHEET_SQL, "period"))
def tall_sheets(spark, sf):
    """The same sheets with every header below row 20, labels from column 5 on, and notes above."""
    cells, merged, files = sheets(spark, sf)
    down = lambda df, *names: df.withColumns({n: F.col(n) + (20 if n.startswith("r") else 5) for n in names})
    # A bare-year sheet names its month within the first three columns, so that cell stays at the left.
    lower = down(cells, "r", "c").withColumn("c", F.when(F.col("v") == "End of December", 0).otherwise(F.col("c")))
    notes = files.select("file_id", F.explode(F.sequence(F.lit(0), F.lit(19))).alias("r"), F.lit(0).alias("c"), F.lit("Note on the table").alias("v"), F.lit(True).alias("is_text"))
    obs, _ = grids.melt(grids.fill_merges(grids.within_caps(lower.unionByName(notes)), down(merged, "r0", "r1", "c0", "c1")), files)
    return v.iso(obs.select("series_id", "period", "fy", "value", "unit", "level"))


VERBS = ["keep", "maintain", "raise", "cut", "lower", "reduce", "increase"]


def releases(spark, sf):
    """One release per order: reserves, remittances, a policy statement, or nothing to read."""
    o = v.text_table(spark, sf, "orders")
    day = F.col("o_orderdate").cast("date")
    kind = F.col("o_orderkey") % 5
    fy = F.year(day) - F.when(F.month(day) >= 7, 0).otherwise(1)
    bn = F.format_string("%d.%d", F.floor(F.col("o_totalprice") / 1000), F.col("o_orderkey") % 10)
    window = F.concat(F.lit("July/"), F.date_format(day, "MMMM"), F.lit(" of FY "), fy, F.lit("/"), fy + 1)
    verb = F.element_at(F.array(*[F.lit(x) for x in VERBS]), (F.col("o_orderkey") % 7).cast("int") + 1)
    rate = F.format_string("%d.%02d", F.floor(F.col("o_totalprice") / 10000), F.col("o_orderkey") % 100)
    lend = F.format_string("%d.%02d", F.floor(F.col("o_totalprice") / 10000) + 1, F.col("o_orderkey") % 100)
    text = (
        F.when(kind == 0, F.concat(F.lit("Net International Reserves reached US$ "), F.format_number("o_totalprice", 2), F.lit(" mn at the end of the month.")))
        .when(kind == 1, F.concat(F.lit("Transfers surged during "), window, F.lit(", to register about USD "), bn, F.lit(" billion.")))
        .when(kind == 2, F.concat(F.lit("Transfers recorded USD "), bn, F.lit(" billion during "), window, F.lit(". Remittances rose by 3 percent in "), F.date_format(day, "MMMM yyyy"), F.lit(" to USD "), bn, F.lit(" billion.")))
        .when(kind == 3, F.concat(F.lit("The Committee decided to "), verb, F.lit(" the overnight deposit rate, overnight lending rate, and the rate of the main operation by 1,050 basis points at "), rate, F.lit(" percent, "), lend, F.lit(" percent, and "), rate, F.lit(" percent, respectively. The discount rate stands at "), rate, F.lit(" percent.")))
        .otherwise(F.lit("Page not found"))
    )
    cats = (
        F.when(kind == 0, F.array(F.lit(press.RESERVES_CATEGORY), F.lit(press.REMIT_CATEGORY)))
        .when(kind.isin(1, 2), F.array(F.lit(press.REMIT_CATEGORY)))
        .when(kind == 3, F.array(F.lit(press.POLICY_CATEGORY), F.lit(press.RESERVES_CATEGORY)))
        .otherwise(F.array(F.lit(press.POLICY_CATEGORY)))
    )
    return o.select(
        F.col("o_orderkey").cast("string").alias("url"), day.alias("date"), F.concat(F.lit("Release "), "o_orderkey").alias("title"),
        cats.alias("categories"), text.alias("text"),
    )


@query(
    "m1_release_figures", "M1 M2 M13 C9",
    v.dated("""WITH o AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day, o_totalprice AS p, CAST(printf('%d.%d', CAST(floor(o_totalprice / 1000) AS BIGINT), o_orderkey % 10) AS DOUBLE) * 1000 AS mn FROM orders)
SELECT 'EG.RES.NIR' AS series_id, day AS period, p AS value FROM o WHERE k % 5 = 0
UNION ALL SELECT 'EG.EXT.REMIT.FYTD', last_day(day), mn FROM o WHERE k % 5 IN (1, 2)
UNION ALL SELECT 'EG.EXT.REMIT.M', CAST(date_trunc('month', day) AS DATE), mn FROM o WHERE k % 5 = 2""", "period"),
)
def release_figures(spark, sf):
    obs, _, _, _ = press.route_releases(releases(spark, sf))
    return v.iso(obs.select("series_id", "period", "value"))


@query(
    "m3_policy_statements", "M3 M4 M10",
    v.dated("""SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS date, CAST(printf('%d.%02d', CAST(floor(o_totalprice / 10000) AS BIGINT), o_orderkey % 100) AS DOUBLE) AS deposit_rate,
  CAST(printf('%d.%02d', CAST(floor(o_totalprice / 10000) AS BIGINT) + 1, o_orderkey % 100) AS DOUBLE) AS lending_rate,
  CAST(printf('%d.%02d', CAST(floor(o_totalprice / 10000) AS BIGINT), o_orderkey % 100) AS DOUBLE) AS main_operation_rate, CAST(printf('%d.%02d', CAST(floor(o_totalprice / 10000) AS BIGINT), o_orderkey % 100) AS DOUBLE) AS discount_rate, 1050 AS basis_points,
  list_extract(['hold', 'hold', 'hike', 'cut', 'cut', 'cut', 'hike'], CAST(o_orderkey % 7 AS INT) + 1) AS decision FROM orders WHERE o_orderkey % 5 = 3""", "date"),
)
def policy_statements(spark, sf):
    _, st, _, _ = press.route_releases(releases(spark, sf))
    a = statements.archive(st)
    return v.iso(a.select(F.col("url").cast("bigint").alias("k"), "date", "deposit_rate", "lending_rate", "main_operation_rate", "discount_rate", "basis_points", "decision"))


@query(
    "m13_release_misses", "M13 D12",
    """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'remittances' WHEN o_orderkey % 5 = 3 THEN 'NIR' ELSE 'dead' END AS kind FROM orders WHERE o_orderkey % 5 IN (0, 3, 4)""",
)
def release_misses(spark, sf):
    _, _, misses, dead = press.route_releases(releases(spark, sf))
    return misses.select(F.col("url").cast("bigint").alias("k"), "kind").unionByName(dead.select(F.col("url").cast("bigint").alias("k"), F.lit("dead").alias("kind")))


@query(
    "d19_decision_filter", "D19 H5",
    """SELECT list_extract(['hold', 'hold', 'hike', 'cut', 'cut', 'cut', 'hike'], CAST(o_orderkey % 7 AS INT) + 1) AS decision, count(*) AS statements
FROM orders WHERE o_orderkey % 5 = 3 GROUP BY 1 HAVING decision <> 'hold'""",
)
def decision_filter(spark, sf):
    _, st, _, _ = press.route_releases(releases(spark, sf))
    return events.with_decision(st, "hike", "cut").groupBy("decision").agg(F.count(F.lit(1)).alias("statements"))


@query(
    "l2_statement_events", "L2 L3",
    v.dated("""SELECT CAST(o_orderdate AS DATE) AS date, 'mpc' AS type, 'Release ' || o_orderkey AS label, CAST(o_orderkey AS VARCHAR) AS url,
  list_extract(['hold', 'hold', 'hike', 'cut', 'cut', 'cut', 'hike'], CAST(o_orderkey % 7 AS INT) + 1) AS decision, 4 AS stated,
  CAST(printf('%d.%02d', CAST(floor(o_totalprice / 10000) AS BIGINT), o_orderkey % 100) AS DOUBLE) AS deposit_rate,
  CAST(printf('%d.%02d', CAST(floor(o_totalprice / 10000) AS BIGINT) + 1, o_orderkey % 100) AS DOUBLE) AS lending_rate FROM orders WHERE o_orderkey % 5 = 3""", "date"),
)
def statement_events(spark, sf):
    """Statements as events, with their decision, address and rates."""
    _, st, _, _ = press.route_releases(releases(spark, sf))
    e = events.statement_events(st)
    rate = lambda n: F.col("rates")[n].alias(n)
    return v.iso(e.select("date", "type", "label", "url", "decision", F.size("rates").alias("stated"), rate("deposit_rate"), rate("lending_rate")))


@query(
    "m5_breadcrumb", "M5",
    "SELECT conv_id, turn, md5(trim(text)) AS body FROM conversations",
)
def breadcrumb(spark, sf):
    lead = F.concat(F.lit("Home > News & Publications News  Rates of the year kept Rates of the year kept 18 Aug 2026 "), "text")
    return v.text_table(spark, sf, "conversations").select("conv_id", "turn", F.md5(statements.strip_breadcrumb(lead).cast("binary")).alias("body"))
