"""Registered queries on texts that the small tables lack, against their SQL."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from check import compare
from pyspark.sql import functions as F

from seriesforge.functions import text
from seriesforge.plans.catalog import load_all

PAGES = [
    "<h1>token = &quot</h1><p>token = &quot</p><footer>&copy; x</footer>",
    "<title>a &quo</title><h1>a &quo</h1> <a>Rates &amp; prices</a> &amp",
    "<h1>&quot;all&quot; &copy; &middot; &amp;</h1>",
    "<h1>&ampx &amp;quot; &copy=1 &middot 5</h1>",
    "<h1></h1>",
    "",
    None,
]


def check_on(spark, folder, name, table, columns):
    pq.write_table(pa.table(columns), f"{folder}/{table}.parquet")
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
        return compare(spark, con, str(folder), load_all()[name])


@pytest.mark.parametrize("name", ["a5_clean_cells", "a8_page_text"])
def test_an_entity_cut_off_stays_as_printed(spark, tmp_path, name):
    columns = {"page_id": pa.array(range(len(PAGES)), pa.int64()), "html": pa.array(PAGES, pa.string())}
    assert check_on(spark, tmp_path, name, "pages", columns)[:2] == ("ok", len(PAGES))


def test_entities_with_and_without_their_semicolon(spark):
    shown = "&lt;b&gt; &#39;x&#x27; &nosuch; &notit; &quot &lt &amp &ampx"
    r = spark.range(1).select(
        text.clean_markup(F.lit(shown), cut_off=False).alias("closed"), text.clean_markup(F.lit(shown)).alias("all")
    ).first()
    assert r["closed"] == "<b> 'x' &nosuch; &notit; &quot &lt & &x"
    assert r["all"] == "<b> 'x' &nosuch; ¬it; \" < & &x"


@pytest.mark.parametrize("texts", [[""], [None], ["A.", "", "e", " \n", None, "Éaux e."]])
def test_a_share_of_no_text_is_as_in_sql(spark, tmp_path, texts):
    columns = {"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())}
    assert check_on(spark, tmp_path, "c20_readable_text", "documents", columns)[:2] == ("ok", len(texts))


def test_no_text_has_no_lost_share(spark):
    r = spark.range(1).select(text.readable(F.lit(None).cast("string")).alias("none"), text.readable(F.lit("")).alias("empty")).first()
    assert tuple(r["none"]) == (None, None) and tuple(r["empty"]) == ("", 0.0)
