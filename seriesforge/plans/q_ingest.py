"""Filters, gates and reshaping of landed rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesforge.functions.numbers import number
from seriesforge.operators import merge, quality, shape, summary
from seriesforge.plans import views as v
from seriesforge.plans.catalog import query
from seriesforge.sources import landed

WIDE = {
    "l_quantity": shape.Measure("QTY", "number"),
    "l_extendedprice": shape.Measure("PRICE", "EGP"),
    "l_discount": shape.Measure("DISC", "percent"),
    "l_tax": shape.Measure("TAX", "percent", zero_ok=True),
}


@query(
    "a9_readable_observations", "A9 D2",
    v.dated("""SELECT 'ORD.' || substr(o_orderpriority, 1, 1) AS series_id, CAST(o_orderdate AS DATE) AS period, o_totalprice AS value
  FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 10 <> 3""", "period"),
)
def readable_observations(spark, sf):
    o = v.table(spark, sf, "orders")
    raw = o.select(
        F.concat(F.lit("ORD."), F.substring("o_orderpriority", 1, 1)).alias("series_id"),
        F.when(F.col("o_orderkey") % 10 == 3, F.lit("not a date")).otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("period"),
        F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("value"),
    )
    return v.iso(landed.readable_observations(raw))


@query(
    "e1_wide_to_long", "E1 D1 D2 C12",
    v.dated(v.with_ctes("wide", """SELECT * FROM (
  SELECT 'LI.QTY' AS series_id, period, l_quantity AS value, 'number' AS unit FROM wide WHERE l_quantity <> 0
  UNION ALL SELECT 'LI.PRICE', period, l_extendedprice, 'EGP' FROM wide WHERE l_extendedprice <> 0
  UNION ALL SELECT 'LI.DISC', period, l_discount, 'percent' FROM wide WHERE l_discount <> 0
  UNION ALL SELECT 'LI.TAX', period, l_tax, 'percent' FROM wide)"""), "period"),
)
def wide_to_long(spark, sf):
    out = shape.wide_to_long(v.wide(spark, sf), F.col("period"), WIDE, "LI.{suffix}", zero_is_missing=True)
    return v.iso(out.select("series_id", "period", "value", "unit"))


@query(
    "d1_missing_zeros", "D1",
    v.dated(v.with_ctes("wide", """SELECT period, count(*) AS n FROM wide WHERE l_discount <> 0 GROUP BY 1"""), "period"),
)
def missing_zeros(spark, sf):
    obs = v.wide(spark, sf).select("period", F.col("l_discount").alias("value"))
    return v.iso(quality.drop_missing_zeros(obs).groupBy("period").agg(F.count(F.lit(1)).alias("n")))


@query(
    "d2_unreadable_rows", "D2",
    "SELECT count(*) AS kept FROM events WHERE value IS NOT NULL AND event_id % 4 <> 0",
)
def unreadable_rows(spark, sf):
    obs = v.obs_events(spark, sf).withColumn("value", F.when(F.col("ord") % 4 != 0, F.col("value")))
    return quality.drop_unreadable(obs).agg(F.count(F.lit(1)).alias("kept"))


@query(
    "d3_row_floor", "D3",
    """WITH s AS (SELECT DISTINCT source AS dataset FROM documents UNION ALL SELECT 'nothing landed'),
r AS (SELECT source AS dataset, count(*) AS rows FROM documents GROUP BY 1)
SELECT dataset, coalesce(rows, 0) AS rows, CASE WHEN coalesce(rows, 0) < 50 THEN 'short' ELSE 'ok' END AS status FROM s LEFT JOIN r USING (dataset)""",
)
def row_floor(spark, sf):
    docs = v.table(spark, sf, "documents").select(F.col("source").alias("dataset"))
    specs = docs.distinct().unionByName(spark.createDataFrame([("nothing landed",)], "dataset string")).withColumn("expect_min_rows", F.lit(50))
    return quality.row_floor(docs, specs).select("dataset", "rows", "status")


@query(
    "d9_zero_flag", "D9",
    v.with_ctes("wide", """SELECT series_id, count(*) FILTER (value = 0) AS zero_values, count(*) AS n FROM (
  SELECT 'LI.QTY' AS series_id, l_quantity AS value FROM wide UNION ALL SELECT 'LI.DISC', l_discount FROM wide
  UNION ALL SELECT 'LI.TAX', l_tax FROM wide UNION ALL SELECT 'LI.PRICE', l_extendedprice FROM wide) GROUP BY 1
HAVING count(*) FILTER (value = 0) > 0 AND count(*) FILTER (value = 0) < count(*) * 0.5"""),
)
def zero_flag(spark, sf):
    return quality.zero_flag(shape.wide_to_long(v.wide(spark, sf), F.col("period"), WIDE, "LI.{suffix}"))


@query(
    "d10_duplicate_periods", "D10",
    v.dated(v.with_ctes("obs_events", """SELECT series_id, count(*) AS duplicate_periods, min(period) AS example
  FROM (SELECT series_id, period FROM obs_events GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1"""), "example"),
)
def duplicate_periods(spark, sf):
    return v.iso(quality.duplicate_periods(v.obs_events(spark, sf)))


@query(
    "d11_hard_failures", "D11 G3",
    v.with_ctes("obs_parts obs_events", """, o AS (SELECT series_id, period FROM obs_parts UNION ALL SELECT series_id, period FROM obs_events),
cat AS (SELECT 'PART.' || p_partkey AS series_id FROM part WHERE p_partkey % 5 <> 0)
SELECT series_id, 'duplicate periods' AS reason FROM (SELECT series_id, period FROM o GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1
UNION ALL SELECT DISTINCT series_id, 'uncatalogued' FROM o WHERE series_id NOT IN (SELECT series_id FROM cat)"""),
)
def hard_failures(spark, sf):
    obs = v.obs_parts(spark, sf).unionByName(v.obs_events(spark, sf).drop("ord"))
    cat = v.table(spark, sf, "part").filter("p_partkey % 5 <> 0").select(F.concat(F.lit("PART."), "p_partkey").alias("series_id"))
    return quality.hard_failures(obs, cat)


@query(
    "d12_dead_links", "D12",
    """SELECT CASE WHEN page_id % 6 = 0 THEN 'dead' ELSE 'live' END AS state, count(*) AS pages FROM pages GROUP BY 1""",
)
def dead_links(spark, sf):
    body = F.when(F.col("page_id") % 6 == 0, F.concat("html", F.lit(" Page not found "))).otherwise(F.col("html"))
    return v.table(spark, sf, "pages").groupBy(quality.link_state(body).alias("state")).agg(F.count(F.lit(1)).alias("pages"))


@query(
    "d13_relevant_items", "D13",
    """SELECT doc_id FROM documents WHERE (source IN ('src1', 'src2') OR lang = 'fr') AND doc_id % 2 = 0""",
)
def relevant_items(spark, sf):
    cats = F.transform(F.array("source", "lang"), lambda c: F.struct(F.lit("").alias("key"), c.alias("value")))
    head = F.when(F.col("doc_id") % 2 == 0, F.lit("/en/")).otherwise(F.lit("/ar/"))
    items = v.table(spark, sf, "documents").select("doc_id", cats.alias("categories"), F.concat(head, "doc_id").alias("url"))
    return quality.relevant(items, ["src1", "src2", "fr"]).select("doc_id")


@query(
    "d14_scanned_documents", "D14 D15",
    v.with_ctes("doc_pages", """SELECT doc_id, count(*) AS pages, CAST(sum(chars) AS BIGINT) AS chars, sum(chars) < count(*) * 90 AS needs_ocr, sum(chars) < count(*) * 25 AS near_empty
  FROM doc_pages GROUP BY 1"""),
)
def scanned_documents(spark, sf):
    s = quality.scanned(v.doc_pages(spark, sf))
    return s.withColumn("near_empty", F.col("chars") < F.col("pages") * quality.NEAR_EMPTY_CHARS)


@query(
    "d16_statement_length", "D16",
    """SELECT conv_id, count(*) AS statements FROM conversations WHERE length(text) >= 200 GROUP BY 1""",
)
def statement_length(spark, sf):
    return (
        quality.statement_texts(v.table(spark, sf, "conversations"))
        .groupBy("conv_id").agg(F.count(F.lit(1)).alias("statements"))
    )


@query(
    "d17_facets", "D17 N11",
    """SELECT doc_id FROM documents WHERE source = 'src3' AND lang = 'en' AND (2000 + doc_id % 25) = 2013""",
)
def facets(spark, sf):
    docs = v.table(spark, sf, "documents").select(
        "doc_id", "source", F.array("lang").alias("categories"),
        F.make_date((F.lit(2000) + F.col("doc_id") % 25).cast("int"), F.lit(5), F.lit(1)).alias("date"),
    )
    return docs.filter(quality.passes_facets("src3", "en", "2013")).select("doc_id")


@query(
    "d21_build_freshness", "D21",
    """SELECT event_type, count(*) FILTER (ts < TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 36 HOUR - INTERVAL 0 SECOND) AS stale FROM events GROUP BY 1""",
)
def build_freshness(spark, sf):
    now = F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")
    old = F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col("ts").cast("timestamp"))
    del old
    return v.table(spark, sf, "events").groupBy("event_type").agg(
        F.count_if(quality.build_is_stale(F.col("ts"), now)).alias("stale")
    )


@query(
    "d22_integrity_rejects", "D22",
    """SELECT doc_id AS id FROM documents WHERE doc_id % 9 = 0""",
)
def integrity_rejects(spark, sf):
    docs = v.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    manifest = docs.select("id", F.sha2(F.when(F.col("id") % 9 == 0, F.concat("content", F.lit("x"))).otherwise(F.col("content")).cast("binary"), 256).alias("sha256"))
    return quality.integrity_rejects(docs, manifest).select("id")


KEYS = {"NATION_0": "USD", "NATION_1": "EUR", "NATION_2": "GBP"}


@query(
    "e2_keyed_to_long", "E2 C10 D1",
    v.dated("""WITH k AS (SELECT CASE n_name WHEN 'NATION_0' THEN 'USD' WHEN 'NATION_1' THEN 'EUR' WHEN 'NATION_2' THEN 'GBP'
  ELSE upper(regexp_replace(n_name, '[^A-Za-z0-9]+', '', 'g')) END AS key, CAST(l_shipdate AS DATE) AS period, l_extendedprice AS buy, l_discount AS sell
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
SELECT 'FX.' || key || '.BUY' AS series_id, period, buy AS value FROM k WHERE buy <> 0
UNION ALL SELECT 'FX.' || key || '.SELL', period, sell FROM k WHERE sell <> 0""", "period"),
)
def keyed_to_long(spark, sf):
    rows = (
        v.table(spark, sf, "lineitem").select("l_suppkey", F.col("l_shipdate").cast("date").alias("day"), F.col("l_extendedprice").alias("Buy"), F.col("l_discount").alias("Sell"))
        .join(v.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(v.table(spark, sf, "nation").select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    out = shape.keyed_to_long(rows, F.col("day"), "n_name", ["Buy", "Sell"], KEYS, "FX.{key}.{col}", zero_is_missing=True)
    return v.iso(out.select("series_id", "period", "value"))


@query(
    "e4_variants", "E4 K1",
    v.with_ctes("wide", """SELECT series_id, count(*) AS n FROM (SELECT 'CPI.DISC.YOY' AS series_id FROM wide UNION ALL SELECT 'CPI.TAX.YOY' FROM wide
  UNION ALL SELECT 'CPI.DISC.MOM' FROM wide WHERE l_discount > 0.05 UNION ALL SELECT 'CPI.TAX.MOM' FROM wide WHERE l_discount > 0.05) GROUP BY 1"""),
)
def variants(spark, sf):
    w = v.wide(spark, sf)
    two = {k: WIDE[k] for k in ("l_discount", "l_tax")}
    parts = [
        shape.wide_to_long(rows, F.col("period"), two, pattern)
        for rows, pattern in ((w, "CPI.{suffix}.YOY"), (w.filter("l_discount > 0.05"), "CPI.{suffix}.MOM"))
    ]
    return merge.union_all(parts).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "e15_document_pages", "E15 A11",
    v.with_ctes("doc_pages", "SELECT doc_id, page, chars, md5(text) AS digest FROM doc_pages"),
)
def document_pages(spark, sf):
    nested = v.table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        F.transform(F.split("text", "\n"), lambda t, i: F.struct((i + 1).alias("page"), F.length(t).alias("chars"), t.alias("text"))).alias("pages"),
    )
    return landed.explode_pages(nested).select("doc_id", "page", "chars", F.md5(F.col("text").cast("binary")).alias("digest"))


AUCTION_SQL = """, lines AS (
  SELECT prefix, tenor, period, 'AMT.SUB' AS measure, submitted AS value FROM bucketed WHERE tenor IS NOT NULL
  UNION ALL SELECT prefix, tenor, period, 'AMT.ACC', accepted FROM bucketed WHERE tenor IS NOT NULL
  UNION ALL SELECT prefix, tenor, period, 'YLD.WAVG', yld FROM bucketed WHERE tenor IS NOT NULL
  UNION ALL SELECT prefix, tenor, period, 'BIDCOVER', round_even(submitted / accepted, 4) FROM bucketed WHERE tenor IS NOT NULL AND submitted <> 0 AND accepted <> 0),
daily AS (SELECT prefix || '.' || tenor || '.' || measure AS series_id, prefix, tenor, measure, period,
  CAST(sum(CAST(value AS DECIMAL(18, 4))) AS DOUBLE) / count(*) AS value FROM lines GROUP BY ALL)
"""


def _auction_obs(spark, sf):
    a = v.auctions(spark, sf)
    return shape.auction_series(
        a, F.col("prefix"), F.col("tenor_days"), F.col("period"),
        {"AMT.SUB": F.col("submitted"), "AMT.ACC": F.col("accepted"), "YLD.WAVG": F.col("yld")},
        F.col("submitted"), F.col("accepted"),
    )


@query(
    "h4_auction_series", "H3 H4 F3 C29",
    v.dated(v.with_ctes("auctions bucketed", AUCTION_SQL + "SELECT series_id, period, value FROM daily"), "period"),
)
def auction_series(spark, sf):
    return v.iso(merge.daily_mean(_auction_obs(spark, sf), digits=None, exact=True))


@query(
    "h3_bid_to_cover", "H3",
    v.dated(v.with_ctes("auctions bucketed", AUCTION_SQL + "SELECT series_id, period, count(*) AS auctions, min(value) AS lowest FROM (SELECT prefix || '.' || tenor || '.' || measure AS series_id, period, value FROM lines WHERE measure = 'BIDCOVER') GROUP BY 1, 2"), "period"),
)
def bid_to_cover(spark, sf):
    o = _auction_obs(spark, sf).filter(F.col("series_id").endswith(".BIDCOVER"))
    return v.iso(o.groupBy("series_id", "period").agg(F.count(F.lit(1)).alias("auctions"), F.min("value").alias("lowest")))


def _latest_by_series(spark, sf):
    obs = merge.daily_mean(_auction_obs(spark, sf), digits=None, exact=True)
    s = summary.summarise(obs)
    return s.select(
        F.regexp_extract("series_id", r"^(TB\.[A-Z])", 1).alias("prefix"),
        F.regexp_extract("series_id", r"^TB\.[A-Z]\.(\d+M)", 1).alias("tenor"),
        F.regexp_extract("series_id", r"^TB\.[A-Z]\.\d+M\.(.*)$", 1).alias("measure"),
        F.col("last").alias("latest"), (F.col("last") - F.col("previous")).alias("change"),
    )


@query(
    "e14_tenor_panel", "E14",
    v.with_ctes("auctions bucketed", AUCTION_SQL + """, r AS (SELECT *, value - lag(value) OVER (PARTITION BY series_id ORDER BY period) AS change,
  row_number() OVER (PARTITION BY series_id ORDER BY period DESC) AS k FROM daily),
l AS (SELECT prefix, tenor, measure, value AS latest, change FROM r WHERE k = 1)
SELECT prefix, tenor, max(latest) FILTER (measure = 'YLD.WAVG') AS yield_latest, max(change) FILTER (measure = 'YLD.WAVG') AS yield_change,
  max(latest) FILTER (measure = 'BIDCOVER') AS cover, max(latest) FILTER (measure = 'AMT.SUB') AS submitted, max(latest) FILTER (measure = 'AMT.ACC') AS accepted
FROM l GROUP BY 1, 2"""),
)
def tenor_panel(spark, sf):
    return shape.tenor_panel(_latest_by_series(spark, sf)).drop("yield_min", "yield_max")


@query(
    "l7_curve_slope", "L7",
    v.dated(v.with_ctes("auctions bucketed", AUCTION_SQL + """, y AS (SELECT * FROM daily WHERE measure = 'YLD.WAVG')
SELECT a.prefix, a.period, a.value AS short_value, b.value AS long_value, b.value - a.value AS slope, b.value - a.value < 0 AS inverted
FROM y a JOIN y b ON a.prefix = b.prefix AND a.period = b.period AND a.tenor = '3M' AND b.tenor = '12M'"""), "period"),
)
def curve_slope(spark, sf):
    y = _auction_obs(spark, sf).filter(F.col("series_id").endswith(".YLD.WAVG"))
    daily = merge.daily_mean(y, digits=None, exact=True).select(
        F.regexp_extract("series_id", r"^(TB\.[A-Z])", 1).alias("prefix"),
        F.regexp_extract("series_id", r"^TB\.[A-Z]\.(\d+M)", 1).alias("tenor"), "period", "value",
    )
    return v.iso(shape.curve_slope(daily))


@query(
    "a12_record_numbers", "C1",
    "SELECT l_orderkey, l_linenumber, CAST(l_quantity * 8 AS DOUBLE) AS tenor, l_extendedprice AS submitted FROM lineitem",
)
def record_numbers(spark, sf):
    rec = v.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_quantity").cast("int") * 8).cast("string").alias("Tenor (days)"),
        F.format_number("l_extendedprice", 2).alias("Submitted Amount"),
    )
    return rec.select(
        "l_orderkey", "l_linenumber", number("Tenor (days)").alias("tenor"), number("Submitted Amount").alias("submitted")
    )
