"""Observation, auction, page and catalog views over the driver tables.

Each view has a DataFrame form and the same thing as a SQL common table expression,
so a query and its check start from one definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.operators.shape import split_pages

REGIMES = [("1995-01-01", "1997-06-30", "A"), ("1997-07-01", "1999-12-31", "B"), ("2000-01-01", None, "C")]
AS_OF = "2001-12-31"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table read for its text."""
    return table(spark, sf, name)


def obs_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Largest order a day for each priority: one row per (series_id, period)."""
    return (
        table(spark, sf, "orders")
        .groupBy(
            F.concat(F.lit("ORD."), F.substring("o_orderpriority", 1, 1)).alias("series_id"),
            F.col("o_orderdate").cast("date").alias("period"),
        )
        .agg(F.max("o_totalprice").alias("value"))
    )


def obs_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Largest line price a day for each part: very many series."""
    return (
        table(spark, sf, "lineitem")
        .groupBy(
            F.concat(F.lit("PART."), F.col("l_partkey")).alias("series_id"),
            F.col("l_shipdate").cast("date").alias("period"),
        )
        .agg(F.max("l_extendedprice").alias("value"))
    )


def obs_events(spark: SparkSession, sf: str) -> DataFrame:
    """Raw readings with many prints per (series_id, period), in served order `ord`."""
    return table(spark, sf, "events").select(
        F.concat(F.lit("EV."), F.upper("event_type")).alias("series_id"),
        F.col("ts").cast("date").alias("period"),
        "value",
        F.col("event_id").alias("ord"),
    )


def auctions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("TB."), F.col("l_linestatus")).alias("prefix"),
        (F.col("l_quantity").cast("int") * 8).alias("tenor_days"),
        F.col("l_shipdate").cast("date").alias("period"),
        F.col("l_extendedprice").alias("submitted"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("accepted"),
        (F.col("l_tax") * 100).alias("yld"),
    )


def wide(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("period"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    )


def doc_pages(spark: SparkSession, sf: str) -> DataFrame:
    return split_pages(text_table(spark, sf, "documents"))


def parts(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog: title "<type> - <name>", family and frequency from the part's own fields."""
    return table(spark, sf, "part").select(
        F.concat(F.lit("PART."), F.col("p_partkey")).alias("series_id"),
        F.concat_ws(" - ", "p_type", "p_name").alias("title_en"),
        F.lit(None).cast("string").alias("title_ar"),
        F.col("p_brand").alias("dataset"),
        F.element_at(F.array(*[F.lit(f) for f in FAMILIES]), F.col("p_size") % 5 + 1).alias("family"),
        F.element_at(F.array(*[F.lit(f) for f in FREQS]), F.col("p_size") % 4 + 1).alias("freq"),
        F.when(F.col("p_size") % 3 == 0, F.lit("percent")).otherwise(F.lit("EGP million")).alias("unit"),
    )


FAMILIES = ["fx", "govt", "gdp", "bop", "misc"]
FREQS = ["D", "M", "Q", "A"]


def meetings(spark: SparkSession, sf: str) -> DataFrame:
    """First order date of each quarter 1996-2000, per order priority as committee."""
    d = F.col("o_orderdate").cast("date")
    return (
        table(spark, sf, "orders")
        .filter((d >= F.lit("1996-01-01").cast("date")) & (d < F.lit("2001-01-01").cast("date")))
        .groupBy(
            F.concat(F.lit("ORD."), F.substring("o_orderpriority", 1, 1)).alias("series_id"),
            F.trunc(d, "quarter").alias("_q"),
        )
        .agg(F.min(d).alias("date"))
        .select("series_id", "date")
    )


CTES = {
    "obs_orders": """obs_orders AS (SELECT 'ORD.' || substr(o_orderpriority, 1, 1) AS series_id,
  CAST(o_orderdate AS DATE) AS period, max(o_totalprice) AS value FROM orders GROUP BY 1, 2)""",
    "obs_parts": """obs_parts AS (SELECT 'PART.' || l_partkey AS series_id,
  CAST(l_shipdate AS DATE) AS period, max(l_extendedprice) AS value FROM lineitem GROUP BY 1, 2)""",
    "obs_events": """obs_events AS (SELECT 'EV.' || upper(event_type) AS series_id,
  CAST(ts AS DATE) AS period, value, event_id AS ord FROM events)""",
    "auctions": """auctions AS (SELECT 'TB.' || l_linestatus AS prefix, CAST(l_quantity AS INT) * 8 AS tenor_days,
  CAST(l_shipdate AS DATE) AS period, l_extendedprice AS submitted,
  l_extendedprice * (1 - l_discount) AS accepted, l_tax * 100 AS yld FROM lineitem)""",
    "bucketed": """bucketed AS (SELECT *, CASE WHEN tenor_days BETWEEN 60 AND 120 THEN '3M'
  WHEN tenor_days BETWEEN 150 AND 200 THEN '6M' WHEN tenor_days BETWEEN 240 AND 290 THEN '9M'
  WHEN tenor_days BETWEEN 330 AND 400 THEN '12M' END AS tenor FROM auctions)""",
    "wide": """wide AS (SELECT CAST(l_shipdate AS DATE) AS period, l_quantity, l_extendedprice, l_discount, l_tax
  FROM lineitem)""",
    "doc_pages": """doc_pages AS (SELECT doc_id, CAST(page AS INT) AS page, text, CAST(length(text) AS INT) AS chars FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS text,
  generate_subscripts(string_split(text, chr(10)), 1) AS page FROM documents))""",
    "parts": """parts AS (SELECT 'PART.' || p_partkey AS series_id, p_type || ' - ' || p_name AS title_en,
  CAST(NULL AS VARCHAR) AS title_ar, p_brand AS dataset,
  list_extract(['fx', 'govt', 'gdp', 'bop', 'misc'], p_size % 5 + 1) AS family,
  list_extract(['D', 'M', 'Q', 'A'], p_size % 4 + 1) AS freq,
  CASE WHEN p_size % 3 = 0 THEN 'percent' ELSE 'EGP million' END AS unit FROM part)""",
    "meetings": """meetings AS (SELECT 'ORD.' || substr(o_orderpriority, 1, 1) AS series_id,
  min(CAST(o_orderdate AS DATE)) AS date FROM orders
  WHERE CAST(o_orderdate AS DATE) >= DATE '1996-01-01' AND CAST(o_orderdate AS DATE) < DATE '2001-01-01'
  GROUP BY 1, date_trunc('quarter', o_orderdate))""",
}


def with_ctes(names: str, body: str) -> str:
    """`WITH` the named views, then the body; a body of its own CTEs starts with a comma."""
    head = ",\n".join(CTES[n] for n in names.split())
    return f"WITH {head}{body}" if body.lstrip().startswith(",") else f"WITH {head}\n{body}"


def dated(sql: str, *cols: str) -> str:
    """The same result with dates written as text."""
    casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({casts}) FROM ({sql})"


def iso(df: DataFrame) -> DataFrame:
    """Dates written as text, so a result compares the same in any client."""
    return df.select(
        *[F.col(f.name).cast("string").alias(f.name) if f.dataType.typeName() == "date" else F.col(f.name) for f in df.schema]
    )
