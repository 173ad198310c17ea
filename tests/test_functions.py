import datetime as dt
import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seriesforge.functions import dates, ids, numbers, reading, text, units

D = dt.date


def one(spark, expr, **cols):
    df = spark.range(1)
    for k, v in cols.items():
        df = df.withColumn(k, F.lit(v))
    return df.select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw,html,sheet",
    [
        ("1,234.5", 1234.5, 1234.5), ("12.5%", 12.5, 12.5), ("١٢٣٫٤", None, None), ("٣٥", 35.0, 35.0),
        ("(1,234)", None, -1234.0), ("-", None, None), ("..", None, None), ("...", None, None), ("N/A", None, None),
        ("1 234", 1234.0, 1234.0), ("1 234", None, 1234.0), ("*", None, None), ("-3.25", -3.25, -3.25), ("1d", None, None), ("", None, None),
    ],
)
def test_numbers(spark, raw, html, sheet):
    assert one(spark, numbers.number(F.col("v")), v=raw) == html
    assert one(spark, numbers.number(F.col("v"), "sheet"), v=raw) == sheet


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.decimals(min_value=-10**9, max_value=10**9, places=3), min_size=1, max_size=20))
def test_printed_number_round_trip(spark, values):
    df = spark.createDataFrame([(f"{x:,.3f}", float(x)) for x in values], "raw string, v double")
    assert df.filter(numbers.number("raw") != F.col("v")).count() == 0


@pytest.mark.parametrize(
    "raw,kind,want",
    [
        ("18/8/2026", None, D(2026, 8, 18)), ("31/02/2020", None, None), ("04/08/2026 - 17/08/2026", "period_range", D(2026, 8, 17)),
        ("Jun - 2026", "mon_year", D(2026, 6, 1)), ("July 2026", "mon_year_text", D(2026, 7, 1)), ("18 Aug 2026", "dmy_text", D(2026, 8, 18)),
        ("Xyz 2026", "mon_year_text", None), ("", None, None), ("31 Feb 2026", "dmy_text", None),
    ],
)
def test_periods(spark, raw, kind, want):
    assert one(spark, dates.period(F.col("v"), kind), v=raw) == want


def test_header_tokens(spark):
    for raw, want in [("Sept.", 9), ("JUNE", 6), ("June 30", 6), ("maybe", None)]:
        assert one(spark, dates.month_token("v"), v=raw) == want
    assert one(spark, dates.year_token("v"), v="End of 2005*") == 2005
    assert one(spark, dates.year_token("v"), v="120055") is None
    assert one(spark, dates.year_token("v", compat=True), v="120055") == 2005
    t = one(spark, dates.fiscal_token("v"), v="2005/06")
    assert (t["end_year"], t["label"]) == (2006, "FY2005/06")
    assert one(spark, dates.fiscal_token("v"), v="2005/2008") is None
    assert one(spark, dates.quarter_token("v"), v=" q 3 ") == 3
    assert one(spark, dates.quarter_token("v"), v="Q3 2020") is None


def test_fiscal_year_and_window(spark):
    assert one(spark, dates.fiscal_year(F.col("d")), d=D(2024, 7, 1)) == "FY2024/25"
    assert one(spark, dates.fiscal_year(F.col("d")), d=D(1999, 6, 30)) == "FY1998/99"
    assert one(spark, dates.fiscal_year(F.col("d")), d=D(1999, 12, 30)) == "FY1999/00"
    end = dates.fiscal_window_end(F.lit("February"), F.lit(2023), F.lit(2024))
    assert one(spark, end) == D(2024, 2, 29)


def test_ids(spark):
    assert one(spark, ids.key_slug(F.lit("Japanese Yen 100"))) == "JAPANESEYEN100"
    assert one(spark, ids.label_slug(F.lit("  (Net) foreign-assets, total!"), 12)) == "NET_FOREIGN"
    assert one(spark, ids.url_slug(F.lit("/en/News & More/A.html/"))) == "en-news-more-a-html"
    assert one(spark, ids.from_pattern("EG.FX.{key}.{col}", key=F.lit("USD"), col=F.lit("BUY"))) == "EG.FX.USD.BUY"
    assert one(spark, ids.part_family(F.lit("EG.CONIA.ON.RATE"))) == "rates" == ids.part_family_of("EG.CONIA.ON.RATE")
    assert one(spark, ids.part_family(F.lit("X"))) == "other" == ids.part_family_of("X")
    assert one(spark, ids.file_extension(F.lit("/-/media/a.PDF?rev=2"))) == ".pdf"
    assert one(spark, ids.file_extension(F.lit("/en/page.aspx"))) == ".html"
    for term in ("inflation", "تضخم", "m2"):
        assert one(spark, ids.shard(F.lit(term))) == ids.shard_of_text(term)


@pytest.mark.parametrize(
    "caption,label,want",
    [
        ("(LE mn)", "Total", "EGP million"), ("( US.$m. )", "Total", "USD million"), ("EGP billion", "x", "EGP billion"),
        ("(بالمليون جنيه)", "x", "EGP million"), ("مليار جنيه", "x", "EGP billion"), ("EUR mn", "x", "EUR million"),
        ("(LE mn)", "Growth (%)", "percent"), ("Index, 2010=100", "x", "index"), ("plain", "Price index", None),
        ("Number of nights", "x", "number"), ("(000)", "x", "thousand"), ("US dollars mn", "x", "USD million"),
    ],
)
def test_units(spark, caption, label, want):
    assert one(spark, units.sniff_unit(F.lit(caption), F.lit(label))) == want


def test_search_folding(spark):
    pairs = [("إجمالى", "اجمالي"), ("مُؤَسَّسة", "موسسه"), ("ﷲ", "الله"), ("عـــام ٢٠٢٤", "عام 2024"), ("A  B", "a b"), ("①", "1")]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", text.search_form(F.col("a")).alias("x"), "b").collect():
        assert r["x"] == r["b"] == text.fold_text(r["a"])


def test_text_forms(spark):
    assert one(spark, text.display_form(F.lit("  a \t b\n\n\n\nc \n"))) == "a b\n\nc"
    assert one(spark, text.language(F.lit("نص عربي a"))) == "ar"
    assert one(spark, text.language(F.lit("abc نص"))) == "mixed"
    assert one(spark, text.language(F.lit("12 %"))) == "unknown"
    r = one(spark, text.readable(F.lit("ab\x00 c�")))
    assert r["text"] == "ab c" and abs(r["lost"] - 2 / 6) < 1e-12
    assert one(spark, text.tokens(F.lit("the m2 of 2024 inflation a"))) == ["m2", "of", "inflation"]
    assert "علي" in text.stop_words()


def test_page_text(spark):
    page = (
        "<html><header>menu</header><style>p{}</style><p>Rates &amp; prices<script>x<y</script>\n kept</p>"
        "This page was last updated today<footer>foot</footer></html>"
    )
    assert one(spark, text.page_text(F.col("v")), v=page) == "Rates & prices kept"
    assert one(spark, text.page_text(F.col("v")), v="<p>no chrome</p>") == "no chrome"


def test_readings(spark):
    assert one(spark, reading.direction(F.lit(0.001), F.lit("percent"))) == "flat"
    assert one(spark, reading.direction(F.lit(-0.01), F.lit("percent"))) == "down"
    assert one(spark, reading.direction(F.lit(0.4), F.lit("EGP"))) == "up"
    day = F.lit("2024-03-10").cast("date")
    for back, want in [(0, "today"), (5, "5 days ago"), (21, "3 weeks ago"), (90, "3 months ago"), (800, "2 years ago")]:
        assert one(spark, reading.age_label(F.date_sub(day, back), day)) == want
    for days, want in [(59, None), (60, "3M"), (120, "3M"), (121, None), (330, "12M"), (400, "12M"), (401, None)]:
        assert one(spark, reading.tenor_bucket(F.lit(days))) == want
    assert one(spark, reading.against_median(F.lit(6.6), F.lit(1.0))) == "6.6×"
    assert one(spark, reading.against_median(F.lit(0.5), F.lit(1.0))) == "50% below"
    assert one(spark, reading.against_median(F.lit(-1.0), F.lit(1.0))) == ""
    assert one(spark, reading.table_of(F.lit("A - b - c"), F.lit("d"))) == "A"
    assert one(spark, reading.line_of(F.lit("A - b - c"), F.lit("d"))) == "b - c"
    assert one(spark, reading.topic_of(F.lit("govt"))) == "rates"


def test_ratios_round_by_their_exact_value(spark):
    """F1: 2.25 and 12.5% are ties and go to even, 2.55 lies below its tie, 2.35 above."""
    ratios = [2 + i / 20 for i in range(600)] + [1 + i / 200 for i in range(1, 200)]
    df = spark.createDataFrame([(x,) for x in ratios], "v double").select("v", reading.against_median(F.col("v"), F.lit(1.0)).alias("said"))
    for x, said in df.collect():
        assert said == (f"{x:.1f}×" if x >= 2 else f"{abs((x - 1) * 100):.0f}% above"), x


def test_against_median_says_what_its_sql_says_of_ties_and_nulls(spark, tmp_path):
    """F1: tops 2.25 times, 2.55 times and 12.5% above the median, a null part and a part without prices."""
    import duckdb

    from seriesforge.plans import catalog

    lines = [(k, p) for k, top in ((1, 225.0), (2, 255.0), (3, 112.5), (4, 113.5), (None, 150.0)) for p in (50.0, 100.0, top)] + [(5, None)]
    spark.createDataFrame(lines, "l_partkey long, l_extendedprice double").coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    reg = catalog.load_all()["c32_against_median"]
    assert sorted(map(str, map(tuple, reg.plan(spark, str(tmp_path)).collect()))) == sorted(map(str, con.execute(reg.sql).fetchall()))


def test_sql_functions_say_what_column_functions_say(spark):
    from seriesforge.functions import sql

    given = {
        "string": ["1,234.5", "(3.5)", "٣٫٥", "12/3/2020", "1/1/2020 - 31/1/2020", "Jan - 2020", "Jan 2020", "3 Feb 2021", "Sept.", "Q 2", "a-b, c'd \\ \"e\"", "  Deposits", "EG.FX.USD", "/-/media/a.pdf?x=1", "/en/b", "M", "percent", "fx", "", None],
        "int": [0, 6, 91, 364, 2020, None], "double": [1.0, -2.5, 0.0, None], "date": [dt.date(2020, 8, 1), dt.date(2021, 2, 3), None],
    }
    made = sql.register(spark)
    assert made == ["sf_" + name for name in sql.FUNCTIONS]
    for name, (arguments, function) in sql.FUNCTIONS.items():
        kinds = [a.split()[1] for a in arguments.split(", ")]
        rows_ = list(itertools.product(*[given[k] for k in kinds]))
        df = spark.createDataFrame(rows_, arguments)
        got = df.selectExpr("*", f"sf_{name}({', '.join(df.columns)}) AS got").withColumn("want", function(*[F.col(c) for c in df.columns]))
        assert got.filter("NOT (got <=> want)").count() == 0, name
