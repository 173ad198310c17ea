import datetime as dt
import gzip
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from seriesforge import schema
from seriesforge.functions.numbers import number
from seriesforge.operators import quality
from seriesforge.sources import datasets, grids, landed, registry, tables

D = dt.date

GROUPED = """
<table class="t"><tr><th>Date</th><th colspan="2">1 Month</th></tr><tr><th></th><th>Yield&nbsp;%</th><th>Volume</th></tr>
<tr><td>1/2/2020</td><td>12.5</td><td>1,000</td></tr>
<tr><th>Date</th><th>x</th><th>y</th></tr>
<tr><td>2/2/2020</td><td>A &amp; B</td></tr></table>
<table><tr><th>Date</th><th>Other</th></tr><tr><td>1/2/2020</td><td><b>7</b></td><td>extra</td></tr></table>
"""


def html(spark, *docs):
    return spark.createDataFrame([(f"d{i}", h) for i, h in enumerate(docs)], "doc_id string, html string")


def test_grouped_headers_repeats_and_padding(spark):
    t = tables.html_tables(html(spark, GROUPED)).orderBy("table_ix").collect()
    assert t[0]["columns"] == ["Date", "1 Month - Yield %", "1 Month - Volume"]
    assert t[0]["rows"] == [["1/2/2020", "12.5", "1,000"], ["2/2/2020", "A & B", ""]]
    assert t[1]["columns"] == ["Date", "Other", "col2"]
    assert t[1]["rows"] == [["1/2/2020", "7", "extra"]]


def test_no_results_and_headerless(spark):
    docs = html(spark, "There are no matching results <table><tr><th>a</th></tr></table>", "<table><tr><td>1</td></tr></table>", "<p/>",
                "<table><tr><th>a</th><th>b</th></tr></table>")
    t = tables.html_tables(docs)
    assert rows(tables.unparsed(t), "doc_id") == [("d1",)]
    only_head = t.filter("doc_id = 'd3'").first()
    assert only_head["columns"] == ["a", "b"] and only_head["rows"] == []


def test_guards(spark):
    same = "<table><tr><th>a</th></tr><tr><td>1</td></tr></table>"
    t = tables.html_tables(html(spark, same + same, GROUPED, same)).withColumn("dataset", F.lit("x"))
    assert rows(quality.layout_guard(t), "doc_id") == [("d1",)]
    specs = spark.createDataFrame([("x", 0)], "dataset string, panels int")
    assert rows(quality.panel_guard(t, specs), "doc_id") == [("d0",), ("d1",)]
    assert rows(quality.missing_columns(t, ["a", "Date"], optional=["Date"]).select("doc_id").distinct()) == [("d1",)]
    both = tables.records(tables.table_rows(t.filter("doc_id = 'd0'")), ["a", "zz"])
    assert rows(both, "a", "zz") == [("1", None), ("1", None)]


def test_archive_cards(spark):
    frag = (
        '<div class="data-list dlList-item"><span class="tag"> Monthly </span><h2 class="title">M2 &amp; co</h2>'
        '<a href="/-/media/a.xlsx?x=1&amp;y=2" target="_blank" class="uploaded-doc">Jul <b>20</b></a><a href="/-/media/b.xls" class="uploaded-doc">Aug</a></div>'
        '<div class="data-list dlList-item"><a href="/-/media/c.xls" class="uploaded-doc">Sep</a></div>'
    )
    got = rows(tables.archive_cards(html(spark, frag)), "url", "period_label", "frequency", "subcategory")
    assert got == [
        ("/-/media/a.xlsx?x=1&y=2", "Jul 20", "Monthly", "M2 & co"), ("/-/media/b.xls", "Aug", "Monthly", "M2 & co"), ("/-/media/c.xls", "Sep", None, None),
    ]


def grid(spark, **sheets):
    out = []
    for fid, lines in sheets.items():
        for r, line in enumerate(lines):
            for c, x in enumerate(line):
                if x is not None:
                    out.append((fid, r, c, str(x), isinstance(x, str)))
    return spark.createDataFrame(out, schema.CELL)


def files(spark, **freq):
    rows_ = [(f, "Banking Surveys", f"Table {f}", q, f"/m/{f}", i) for i, (f, q) in enumerate(freq.items())]
    return spark.createDataFrame(rows_, "file_id string, category string, subcategory string, frequency string, url string, file_ord int")


SHEETS = {
    "month": [
        ["Survey (LE mn)", "المسح", 2017, None, None],
        [None, None, "Nov.", "Dec.", "Jan."],
        ["Total", "إجمالى", 10, "(1,5)", 30],
        [None, None, None, None, None],
        ["  Deposits", "ودائع", 1, "..", 3],
    ],
    "quarter": [[None, "Q1", "Q2", "Q3"], [None, "July/Sep 2023", "Oct/Dec 2023", "Jan/Mar 2024"], ["Exports", 1, 2, 3]],
    "fy": [["US$ mn", "2004/2005", "2005/06"], ["Balance", 5, 6]],
    "year": [["End of June", 2005, 2006], ["Debt %", 7, 8]],
    "single": [[None, "Q4"], [None, "Apr/June 2020"], ["Trade", 9]],
    "bad": [["nothing", "here"], ["x", "y"]],
    "nolabel": [[None, "2004/2005"], [None, 5]],
}


def test_grid_layouts(spark):
    cells = grid(spark, **SHEETS)
    merges = spark.createDataFrame([("month", 0, 2, 0, 3)], schema.MERGE)
    fs = files(spark, month="Monthly", quarter="Quarterly", fy="Annual", year=None, single="Quarterly", bad="Monthly", nolabel="Annual")
    filled = grids.fill_merges(grids.within_caps(cells), merges)
    # January has no year of its own here: it inherits the one to its left.
    obs, bad = grids.melt(filled, fs)
    got = rows(obs, "file_id", "period", "value", "fy")
    assert got == sorted(
        [
            ("month", D(2017, 11, 30), 10.0, "FY2017/18"), ("month", D(2017, 12, 31), -15.0, "FY2017/18"), ("month", D(2017, 1, 31), 30.0, "FY2016/17"),
            ("month", D(2017, 11, 30), 1.0, "FY2017/18"), ("month", D(2017, 1, 31), 3.0, "FY2016/17"),
            ("quarter", D(2023, 9, 30), 1.0, "FY2023/24"), ("quarter", D(2023, 12, 31), 2.0, "FY2023/24"), ("quarter", D(2024, 3, 31), 3.0, "FY2023/24"),
            ("fy", D(2005, 6, 30), 5.0, "FY2004/05"), ("fy", D(2006, 6, 30), 6.0, "FY2005/06"),
            ("year", D(2005, 6, 30), 7.0, "FY2004/05"), ("year", D(2006, 6, 30), 8.0, "FY2005/06"),
            ("single", D(2020, 6, 30), 9.0, "FY2019/20"),
        ],
        key=lambda r: tuple(str(x) for x in r),
    )
    meta = {(r["file_id"], r["label"]): (r["series_id"], r["unit"], r["level"], r["label_ar"]) for r in obs.collect()}
    assert meta[("month", "Deposits")] == ("EG.XL.BANK.TABLE_MONTH.DEPOSITS", "EGP million", 1, "ودائع")
    assert meta[("year", "Debt %")][1] == "percent"
    reasons = dict(rows(bad, "file_id", "reason"))
    assert reasons["bad"].startswith("no period row found") and reasons["nolabel"] == "no label column found"
    assert set(reasons) == {"bad", "nolabel"}


def test_years_below_months_and_large_merge(spark):
    cells = grid(spark, a=[["End of", "June", "June"], [None, 2005, 2006], ["Debt", 1, 2]])
    big = spark.createDataFrame([("a", 0, 0, 30, 30)], schema.MERGE)
    filled = grids.fill_merges(grids.within_caps(cells), big, grids.MAX_MERGE_CELLS)
    assert filled.count() == cells.count()
    obs, _ = grids.melt(filled, files(spark, a="Annual"))
    assert rows(obs, "period", "value", "fy") == [(D(2005, 6, 30), 1.0, "FY2004/05"), (D(2006, 6, 30), 2.0, "FY2005/06")]


def test_header_and_labels_anywhere_in_a_tall_sheet(spark):
    def tall(rows_, down, right):
        notes = [["Note %d" % k] + [None] * 3 + ["remark"] for k in range(down)]
        return notes + [[None] * right + list(r) for r in rows_]

    fs = files(spark, month="Monthly", quarter="Quarterly", fy="Annual", year=None, single="Quarterly")
    shapes = {k: SHEETS[k] for k in ("month", "quarter", "fy", "year", "single")}
    plain = spark.createDataFrame([("month", 0, 2, 0, 3)], schema.MERGE)
    want, _ = grids.melt(grids.fill_merges(grids.within_caps(grid(spark, **shapes)), plain), fs)
    deep = spark.createDataFrame([("month", 40, 7, 40, 8)], schema.MERGE)
    cells = grid(spark, **{k: tall(x, 40, 5) for k, x in shapes.items()})
    # A bare-year sheet names its month within the first three columns.
    cells = cells.unionByName(spark.createDataFrame([("year", 40, 1, "End of June", True)], cells.schema))
    obs, bad = grids.melt(grids.fill_merges(grids.within_caps(cells), deep), fs)
    columns = ["file_id", "series_id", "period", "value", "fy", "label", "label_ar", "unit", "level", "freq"]
    assert rows(obs, *columns) == rows(want, *columns) and obs.count() == 13
    assert bad.count() == 0


def test_header_words_of_a_cell_are_worked_out_once(spark, monkeypatch):
    worked, tokens = [], grids._tokens
    monkeypatch.setattr(grids, "_tokens", lambda compat: worked.append(compat) or tokens(compat))
    obs, _ = grids.melt(grid(spark, fy=SHEETS["fy"]), files(spark, fy="Annual"))
    assert obs.count() == 2 and worked == [False]
    said = ["Sept.", "٢٠٠٤/٢٠٠٥", "2004/05", "12,345.67", "q ٣", "Q5", "1999.5", "السنة", "é", "FY 2010", "1 999", "", None]
    got = grids.with_tokens(spark.createDataFrame([(v,) for v in said], "v string")).select("month", "quarter", "fiscal_year.label", "year").collect()
    assert [tuple(r) for r in got] == [
        (9, None, None, None), (None, None, "FY2004/05", 2004), (None, None, "FY2004/05", 2004), (None, None, None, None), (None, 3, None, None), (None, None, None, None),
        (None, None, None, 1999), (None,) * 4, (None,) * 4, (None, None, None, 2010), (None,) * 4, (None,) * 4, (None,) * 4,
    ]


@pytest.mark.parametrize("partitions", ["4", "16"])
def test_quarantine_has_the_facts_of_one_bad_sheet(spark, partitions):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        cells = grid(spark, bad=[["nothing", "here"]], silent=[[None, "2004/2005"], ["Loans", "n/a"]])
        _, bad = grids.melt(cells, files(spark, bad="Monthly", silent="Annual", gone=None))
        assert rows(bad, "file_id", "category", "subcategory", "frequency", "reason") == [
            ("bad", "Banking Surveys", "Table bad", "Monthly", "no period row found (best scores: month=0, quarter=0, fiscal_year=0, year=0)"),
            ("gone", "Banking Surveys", "Table gone", "Monthly", "empty sheet"),
            ("silent", "Banking Surveys", "Table silent", "Annual", "parsed but produced no observations"),
        ]
        _, only = grids.melt(cells.filter("file_id = 'bad'"), files(spark, bad="Monthly"))
        assert only.count() == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_arabic_only_labels_and_collisions(spark):
    cells = grid(spark, a=[[None, "2004/2005"], ["دين", 5], ["دين اخر", 6]], b=[[None, "2004/2005"], ["Loans", 5], ["Loans", 6]])
    obs, _ = grids.melt(cells, files(spark, a="Annual", b="Annual"))
    ids_ = [r[0] for r in rows(obs.filter("file_id = 'a'"), "series_id")]
    assert len(set(ids_)) == 2 and all(".R" in i for i in ids_)
    assert rows(grids.collisions(obs), "file_id", "kept", "discarded") == [("b", 6.0, 5.0)]
    cat = grids.catalog_entries(obs)
    assert cat.count() == 3 and cat.filter("period_basis = 'end' and freq = 'A' and fiscal_year_basis like 'Egypt%'").count() == 3


def test_landed_files(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "fx.html.gz").write_bytes(gzip.compress(GROUPED.encode()))
    (raw / "cpi.yy.html.gz").write_bytes(gzip.compress(b"<p>x</p>"))
    assert rows(landed.raw_snapshots(spark, str(raw)), "dataset", "variant") == [("cpi", "yy"), ("fx", None)]
    csvs = tmp_path / "series"
    csvs.mkdir()
    (csvs / "a.csv").write_text("series_id,period,value\nA,2020-01-01,1.5\nA,2020-01-02,n/a\n,2020-01-03,2\nA,bad,2\n")
    assert rows(landed.series_csv(spark, str(csvs / "*.csv"))) == [("A", D(2020, 1, 1), 1.5)]
    (tmp_path / "cat.json").write_text(json.dumps([{"series_id": "A", "title_en": "T", "derived": True}]))
    assert landed.catalog_json(spark, str(tmp_path / "cat.json")).first()["derived"] is True
    (tmp_path / "man.json").write_text(json.dumps({"documents": [{"id": "x", "url": "/u", "categories": ["a"], "is_file": True}]}))
    assert rows(landed.manifest_json(spark, str(tmp_path / "man.json")), "id", "is_file") == [("x", True)]
    pages = tmp_path / "pages"
    pages.mkdir()
    doc = {"id": "x", "title": "t", "page_count": 2, "pages": [{"page": 1, "chars": 2, "lang": "en", "text": "ab"}, {"page": 2, "chars": 0, "text": ""}]}
    (pages / "x.json.gz").write_bytes(gzip.compress(json.dumps(doc).encode()))
    assert rows(landed.explode_pages(landed.page_documents(spark, str(pages))), "doc_id", "page", "text") == [("x", 1, "ab"), ("x", 2, "")]
    rec = tmp_path / "rec.csv"
    rec.write_text("Tenor (days),Accepted amount\n91,\"1,000.5\"\n")
    r = landed.record_tables(spark, str(rec))
    assert r.columns == ["Tenor (days)", "Accepted amount"]
    assert r.select(number("Accepted amount")).first()[0] == 1000.5


def test_listings(spark, tmp_path):
    def page(name, *items):
        d = tmp_path / name
        d.mkdir()
        (d / "0.json").write_text(json.dumps({"totalResultsCount": len(items), "results": list(items)}))
        return str(d)

    item = lambda url, *cats: {"url": url, "title": " T ", "customDate": "2020-05-01T00", "categories": [{"key": c, "value": c} for c in cats]}
    paths = {
        "publications": page("p", item("/-/media/a.pdf", "Z"), item("/en/b", "B")),
        "News": page("n", item("/-/media/a.pdf", "A"), item("", "gone")),
    }
    m = landed.manifest_from_items(landed.listing_items(spark, paths))
    got = {r["url"]: (r["source"], r["is_file"], r["categories"], r["title"], r["date"]) for r in m.collect()}
    assert got == {
        "/-/media/a.pdf": ("publications", True, ["A", "Z"], "T", "2020-05-01"), "/en/b": ("publications", False, ["B"], "T", "2020-05-01"),
    }


def test_registry(spark, tmp_path):
    entries = [
        {"key": "fx", "shape": "long_by_key", "family": "fx", "freq": "D", "date_col": "Date", "key_col": "Currency", "key_map": "currencies",
         "value_cols": ["Buy"], "id_pattern": "EG.FX.{key}.{col}", "expect_min_rows": 3, "title_en": "FX", "path": "/fx"},
        {"key": "ibk", "shape": "wide", "tables": [{"id_pattern": "EG.IBK.{suffix}", "columns": {"ON": {"suffix": "ON"}}}]},
    ]
    path = tmp_path / "r.json"
    path.write_text(json.dumps(entries))
    assert [d.key for d in registry.load(str(path), only=["fx"])] == ["fx"]
    ds = registry.load(entries)
    assert ds[0].key_map["US Dollar"] == "USD" and ds[1].tables[0]["columns"]["ON"].suffix == "ON"
    specs = registry.specs_frame(spark, ds)
    landed_rows = spark.createDataFrame([("fx",)] * 2, "dataset string")
    status = quality.row_floor(landed_rows, specs)
    assert rows(status, "dataset", "rows", "status") == [("fx", 2, "short"), ("ibk", 0, "ok")]
    try:
        quality.require_floor(status)
        raise AssertionError("a short dataset must stop the run")
    except quality.ShortDataset as exc:
        assert "fx" in str(exc)
    for bad in ({"key": "x", "shape": "odd"}, {"key": "x", "shape": "wide", "date_kind": "odd"}):
        try:
            registry.dataset(bad)
            raise AssertionError("refused")
        except ValueError:
            pass


TWO_PANELS = """<table><tr><th>Date</th><th>ON</th><th>1W</th></tr><tr><td>1/2/2020</td><td>10.5</td><td>0.000%</td></tr>
<tr><td>1/2/2020</td><td>11.5</td><td>12</td></tr><tr><td>bad</td><td>1</td><td>1</td></tr></table>
<table><tr><th>Date</th><th>ON</th></tr><tr><td>2/2/2020</td><td>0</td></tr></table><table><tr><th>Date</th><th>x</th></tr><tr><td>3/2/2020</td><td>5</td></tr></table>"""
KEYED = "<table><tr><th>Date</th><th>Currency</th><th>Buy</th></tr><tr><td>1/2/2020</td><td> US Dollar </td><td>15.5</td></tr><tr><td>1/2/2020</td><td>New Pound</td><td>7</td></tr></table>"


def test_a_declared_dataset_runs(spark):
    wide = registry.dataset(
        {"key": "ibk", "shape": "wide", "title_en": "Interbank", "family": "rates", "freq": "D", "unit": "percent", "date_col": "Date", "path": "/ibk", "zero_is_missing": True, "expect_min_rows": 9,
         "tables": [{"id_pattern": "R.{suffix}", "columns": {"ON": {"suffix": "ON"}, "1W": {"suffix": "W1"}, "gone": {"suffix": "X"}}},
                    {"id_pattern": "V.{suffix}", "unit": "EGP million", "columns": {"ON": {"suffix": "ON", "zero_ok": True}}}]}
    )
    landed_rows = spark.createDataFrame([(1, None, TWO_PANELS), (2, None, "<table><tr><td>x</td></tr></table>"), (3, None, "nothing"), (4, None, KEYED.replace("Date", "Day"))], "doc_id long, variant string, html string")
    run = datasets.run_dataset(landed_rows, wide, "https://x.org")
    assert rows(run.observations) == [("R.ON", D(2020, 2, 1), 10.5), ("R.W1", D(2020, 2, 1), 12.0), ("V.ON", D(2020, 2, 2), 0.0)]
    assert rows(run.anomalies) == [("R.ON", D(2020, 2, 1), 10.5, 11.5, "ibk")]
    assert rows(run.catalog, "series_id", "title_en", "unit", "freq", "source_url") == [
        ("R.ON", "Interbank - ON", "percent", "D", "https://x.org/ibk"), ("R.W1", "Interbank - 1W", "percent", "D", "https://x.org/ibk"), ("V.ON", "Interbank - ON", "EGP million", "D", "https://x.org/ibk"),
    ]
    assert rows(run.tables, "doc_id", "table_ix", "status") == [(1, 0, "read"), (1, 1, "read"), (1, 2, "past the declared panels"), (2, 0, "no header row found"), (4, 0, "no date column")]
    assert rows(run.status) == [("ibk", 4, 3, "short")]
    assert run.records.count() == 0


def test_variants_keys_records_and_guards(spark):
    landed_rows = spark.createDataFrame([(1, "yy", KEYED), (2, "mm", KEYED.replace("15.5", "16")), (3, "odd", KEYED), (4, "yy", KEYED + KEYED)], "doc_id long, variant string, html string")
    keyed = registry.dataset({"key": "fx", "shape": "long_by_key", "date_col": "Date", "key_col": "Currency", "key_map": "currencies", "value_cols": ["Buy", "Sell"], "id_pattern": "FX.{key}.{col}",
                              "variants": [{"radio": "mm"}, {"radio": "yy", "id_pattern": "Y.{key}.{col}"}]})
    run = datasets.run_dataset(landed_rows, keyed)
    assert rows(run.observations) == [("FX.NEWPOUND.BUY", D(2020, 2, 1), 7.0), ("FX.USD.BUY", D(2020, 2, 1), 16.0), ("Y.NEWPOUND.BUY", D(2020, 2, 1), 7.0), ("Y.USD.BUY", D(2020, 2, 1), 15.5)]
    assert rows(run.tables, "doc_id", "table_ix", "status") == [(1, 0, "read"), (2, 0, "read"), (3, 0, "undeclared variant"), (4, 0, "several tables and no panels"), (4, 1, "several tables and no panels")]
    printed = registry.dataset({"key": "p", "shape": "records"})
    both = datasets.run_registry(landed_rows.withColumn("dataset", F.lit("p")), [printed, keyed])
    first = both.records.filter("doc_id = 4 and table_ix = 1 and row_ix = 0").first()
    assert first["record"] == {"Date": "1/2/2020", "Currency": "US Dollar", "Buy": "15.5"} and both.records.count() == 10
    assert rows(both.status) == [("fx", 0, 0, "ok"), ("p", 10, 0, "ok")]
    assert both.observations.count() == 0


def test_registry_parses_a_response_once_for_all_datasets(spark):
    """a response of three datasets is one parse in the plans of what was read and of the status."""
    from seriesforge.plans import q_tables

    html = "<table><tr><th>Issue Date</th><th>Line item - Price</th><th>Line item - Qty</th></tr><tr><td>1/2/2020</td><td>5</td><td>1</td></tr><tr><td>1/2/2020</td><td>0</td><td></td></tr></table>"
    one = spark.createDataFrame([(1, "even", html), (2, None, html), (3, "odd", html + html)], "doc_id long, variant string, html string")
    keys = F.array(*[F.lit(d.key) for d in q_tables.DECLARED])
    run = datasets.run_registry(one.withColumn("dataset", keys), q_tables.DECLARED)
    apart = datasets.run_registry(one.withColumn("dataset", F.explode(keys)), q_tables.DECLARED)
    single = [datasets.run_dataset(one, d) for d in q_tables.DECLARED]
    for name in ("tables", "status", "observations"):
        want = rows(single[0].__dict__[name].unionByName(single[1].__dict__[name]).unionByName(single[2].__dict__[name]))
        assert rows(getattr(run, name)) == rows(getattr(apart, name)) == want, name
    assert run.tables._jdf.queryExecution().optimizedPlan().toString().count("Generate posexplode(regexp_extract_all") == 1


def test_spaces_of_every_script_collapse_and_marks_go(spark):
    """the cheaper class of spaces is the same set, and a text with the marks of cells is read as before."""
    import re

    from seriesforge.functions import text

    spaces = [c for c in map(chr, [*range(0xD800), *range(0xE000, 0x10000)]) if c in " \t\n\x0b\f\r\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" or "\u2000" <= c <= "\u200a"]
    every = [(i, chr(i)) for i in [*range(0xD800), *range(0xE000, 0x10000)]]
    df = spark.createDataFrame([("".join(c for _, c in every),)], "v string").select(text.collapse_space(F.col("v")))
    assert df.first()[0] == re.sub("[" + "".join(map(re.escape, spaces)) + "]+", " ", "".join(c for _, c in every))
    docs = spark.createDataFrame([(1, "<table><tr><th>a\x01</th><th>b</th></tr><tr><td>1\x02</td></tr><tr><td>2</td><td>3</td><td>4</td></tr></table>")], "doc_id long, html string")
    got = tables.html_tables(docs).first()
    assert (got["columns"], got["rows"]) == (["a", "b", "col2"], [["1", "", ""], ["2", "3", "4"]])


def test_dataset_readings_stay_within_compiled_method_size(spark):
    # The JVM leaves methods of more than 8,000 bytes of code to its interpreter.
    import re

    from seriesforge.plans.q_tables import DECLARED

    landed = spark.createDataFrame([(1, "even", "<table><tr><th>Issue Date</th></tr><tr><td>1/2/2001</td></tr></table>")], "doc_id long, variant string, html string")
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = datasets.readings(datasets.judged_tables(landed, DECLARED[0]), DECLARED[0])._jdf.queryExecution().executedPlan()
        code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(plan)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000
