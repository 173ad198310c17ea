import datetime as dt
import statistics

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seriesforge.operators import asof, events, index, merge, quality, ranges, shape, spread, summary

D = dt.date
SCHEMA = "series_id string, period date, value double"
QUICK = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def obs(spark, **series):
    return spark.createDataFrame(
        [(s, D(2020, 1, 1) + dt.timedelta(days=d), float(v)) for s, pts in series.items() for d, v in pts], SCHEMA
    )


def test_summary_ties_zeros_and_single_points(spark):
    o = obs(spark, A=[(0, 1), (1, 5), (2, 5), (3, 0), (4, 2)], B=[(0, 7)], C=[(0, 0), (1, 0), (2, 3)], N=[(0, -4), (1, -2)])
    s = {r["series_id"]: r for r in summary.summarise(o).collect()}
    a = s["A"]
    assert (a["n"], a["last"], a["previous"], a["highest"], a["highest_period"]) == (5, 2.0, 0.0, 5.0, D(2020, 1, 2))
    assert (a["lowest"], a["lowest_period"], a["median"], a["zero_values"]) == (0.0, D(2020, 1, 4), 2.0, 1)
    assert (a["move_period"], a["move_abs_pct"], a["move_pct"], a["move_change"]) == (D(2020, 1, 2), 400.0, 400.0, 4.0)
    assert s["B"]["previous"] is None and s["B"]["move_period"] is None
    assert s["C"]["zero_values"] is None  # half or more are zero
    assert (s["N"]["move_abs_pct"], s["N"]["move_change"]) == (50.0, 2.0)


def test_summary_of_days_does_not_group_them_again(spark):
    o = obs(spark, A=[(0, 1), (1, 5), (2, 5), (3, 0), (4, 2)], B=[(0, 7)], C=[(0, 0), (1, 0), (2, 3)]).unionByName(spark.createDataFrame([("A", D(2021, 1, 1), None), ("Z", D(2021, 1, 1), None)], SCHEMA))
    plain, once = summary.summarise(o), summary.summarise(o, daily=True)
    assert once.dtypes == plain.dtypes and rows(once) == rows(plain)
    grouped = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [series_id")
    assert (grouped(plain), grouped(once)) == (2, 1)


def test_summary_duplicates_staleness_and_prose(spark):
    o = obs(spark, A=[(0, 1), (0, 2), (1, 3), (2, 0), (3, 4)])
    cat = spark.createDataFrame([("A", "T", "D", "percent")], "series_id string, title_en string, freq string, unit string")
    s = summary.summarise(o, cat, F.lit("2020-03-01"))
    r = s.first()
    assert (r["n"], r["duplicate_periods"], r["duplicate_example"], r["stale_days"]) == (5, 1, D(2020, 1, 1), 57)
    flags = summary.flag_sentences(s)
    assert flags.first()["flags"] == [
        "duplicate periods: 1 (e.g. 2020-01-01)", "1 zero values", "no new value in 57 days (discontinued?)",
    ]
    back = summary.flag_numbers(flags.select("series_id", "flags")).first()
    assert (back["stale_days"], back["zero_values"], len(back["flags"])) == (57, 1, 1)


@QUICK
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=40))
def test_summary_invariants(spark, values):
    r = summary.summarise(obs(spark, A=list(enumerate(values)))).first()
    assert r["lowest"] <= r["median"] + 1e-6 and r["median"] <= r["highest"] + 1e-6
    assert r["n"] == len(values) and abs(r["median"] - statistics.median(values)) < 1e-5


def test_keep_first_and_anomalies(spark):
    raw = spark.createDataFrame(
        [("A", D(2020, 1, 1), 1.0, 3), ("A", D(2020, 1, 1), 2.0, 1), ("A", D(2020, 1, 1), 2.0, 2), ("A", D(2020, 1, 1), 1.0, 4), ("B", D(2020, 1, 1), 9.0, 5)],
        SCHEMA + ", ord int",
    )
    assert rows(merge.keep_first(raw), "series_id", "value") == [("A", 2.0), ("B", 9.0)]
    assert rows(merge.anomalies(raw, dataset="d")) == [("A", D(2020, 1, 1), 2.0, 1.0, "d")] * 2
    again = merge.keep_first(raw).withColumn("ord", F.lit(1))
    assert rows(merge.keep_first(again)) == rows(merge.keep_first(raw))
    assert merge.anomalies(again).count() == 0
    assert rows(merge.keep_last(raw, ["ord"]), "series_id", "value") == [("A", 1.0), ("B", 9.0)]


def test_daily_mean_rounds_to_six(spark):
    o = obs(spark, A=[(0, 1.0), (0, 2.0), (0, 2.0)])
    assert merge.daily_mean(o).first()["value"] == 1.666667


POINTS = st.dictionaries(st.integers(0, 60), st.integers(0, 9), min_size=1, max_size=12)


@QUICK
@given(POINTS, st.lists(st.integers(-5, 70), min_size=1, max_size=15))
def test_asof_and_nearest_match_brute_force(spark, points, asks):
    o = obs(spark, A=sorted(points.items()))
    base = D(2020, 1, 1)
    probe = spark.createDataFrame([("A", base + dt.timedelta(days=a), i) for i, a in enumerate(asks)], "series_id string, day date, i int")
    back = {r["i"]: r["v"] for r in asof.asof_backward(probe, o, ["series_id"], "day", "period", ["value"], ["v"]).collect()}
    near = {r["i"]: r["v"] for r in asof.nearest(probe, o, ["series_id"], "day", "period", ["value"], ["v"]).collect()}
    for i, a in enumerate(asks):
        earlier = [d for d in points if d <= a]
        assert back[i] == (float(points[max(earlier)]) if earlier else None)
        best = min(points, key=lambda d: (abs(d - a), d))
        assert near[i] == float(points[best])


@QUICK
@given(st.dictionaries(st.integers(0, 900), st.integers(-9, 9), min_size=1, max_size=25))
def test_year_on_year_matches_brute_force(spark, points):
    got = {r["period"]: r["value"] for r in summary.year_on_year(obs(spark, A=sorted(points.items()))).collect()}
    want = {}
    for d, v in points.items():
        near = [(abs(e - (d - 365)), -e) for e in points if abs(e - (d - 365)) < 45 and e <= d]
        if near:
            base = points[-min(near)[1]]
            if base:
                want[D(2020, 1, 1) + dt.timedelta(days=d)] = (v - base) / abs(base) * 100
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


@QUICK
@given(st.sets(st.integers(0, 400), min_size=1, max_size=60), st.integers(1, 9))
def test_neighbour_row_crosses_stretches(spark, keys, width):
    df = spark.createDataFrame([("k", i, float(i)) for i in keys], "k string, i int, v double")
    order = sorted(keys)
    prev = {r["i"]: r["p"] and r["p"]["v"] for r in spread.neighbour_row(df, ["k"], "i", ["v"], width, "p").collect()}
    nxt = {r["i"]: r["p"] and r["p"]["v"] for r in spread.neighbour_row(df, ["k"], "i", ["v"], width, "p", step=1).collect()}
    for a, b in zip([None, *order], order):
        assert prev[b] == (None if a is None else float(a))
        if a is not None:
            assert nxt[a] == float(b)
    assert nxt[order[-1]] is None


@QUICK
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 20)), max_size=60), st.integers(1, 6))
def test_top_per_group_matches_brute_force(spark, pairs, k):
    df = spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(pairs)], "g int, v int, i int")
    got = rows(spread.top_per_group(df, ["g"], [F.desc("v"), F.asc("i")], k, "rank"), "g", "i", "rank")
    want = []
    for g in {g for g, _ in pairs}:
        mine = sorted([(-v, i) for i, (h, v) in enumerate(pairs) if h == g])[:k]
        want += [(g, i, n + 1) for n, (_, i) in enumerate(mine)]
    assert got == sorted(want, key=lambda r: tuple((False, str(x)) for x in r))


def test_even_sample_follows_the_stride(spark):
    for n in (1, 2, 5, 48, 49, 50, 97, 1000):
        o = obs(spark, A=[(i, i) for i in range(n)])
        got = [r[0] for r in rows(summary.even_sample(o, 48), "value")]
        want = list(range(n)) if n <= 48 else [int(i * (n / 48)) for i in range(48)] + [n - 1]
        assert sorted(got) == sorted(float(x) for x in (want if n >= 2 else []))


def test_clip_interval_step_and_regime(spark):
    o = obs(spark, A=[(0, 1), (10, 2), (20, 3)])
    clip = rows(asof.clip_with_carry(o, F.lit("2020-01-15")), "period", "value")
    assert clip == [(D(2020, 1, 15), 2.0), (D(2020, 1, 21), 3.0)]
    daily = asof.step_daily(o, F.lit("2020-01-22"))
    assert daily.count() == 22 and daily.filter("period = '2020-01-10'").first()["value"] == 1.0
    iv = spark.createDataFrame([(D(2020, 1, 5), D(2020, 1, 12), "x"), (D(2020, 1, 11), None, "y")], "lo date, hi date, label string")
    got = rows(asof.interval_join(o, "period", iv, "lo", "hi", ["label"], F.lit("2020-12-31")), "value", "label")
    assert got == [(2.0, "x"), (2.0, "y"), (3.0, "y")]
    lab = asof.label_regime(o, F.col("period"), [("2020-01-05", "2020-01-15", "a"), ("2020-01-16", None, "b")])
    assert [r[0] for r in lab.orderBy("period").select("regime").collect()] == [None, "a", "b"]


def test_breaks_and_labels(spark):
    o = obs(spark, A=[(0, 100), (1, 103), (2, 120), (3, 60), (4, 0), (5, 9)])
    b = events.detect_breaks(o)
    got = {r["date"]: (r["direction"], r["evidence"]["pct_change"]) for r in b.collect()}
    assert got == {
        D(2020, 1, 3): ("devaluation", 16.5), D(2020, 1, 4): ("appreciation", -50.0), D(2020, 1, 5): ("appreciation", -100.0),
    }
    old = spark.createDataFrame([(D(2020, 1, 3), "fx_move", "Float", "by hand"), (D(2020, 1, 4), "fx_move", "", None)], "date date, type string, label string, note string")
    kept = merge.preserve_labels(b, old, ["date", "type"], ["label", "note"])
    assert rows(kept, "date", "label", "note")[0] == (D(2020, 1, 3), "Float", "by hand")
    assert rows(events.shown_breaks(kept))[:2] == [(D(2020, 1, 3), "Float"), (D(2020, 1, 4), "-50%")]
    assert events.top_breaks(b, 1).first()["date"] == D(2020, 1, 5)


def test_ranges(spark):
    o = obs(spark, A=[(0, 1), (400, 2), (500, 3)], B=[(0, 1), (1, 2)])
    cut = ranges.apply_range(o, 1, F.lit("2021-05-20"))
    assert rows(cut, "series_id", "value") == [("A", 2.0), ("A", 3.0), ("B", 1.0), ("B", 2.0)]
    idx = spark.createDataFrame(
        [("A", 5000, D(2005, 1, 1), D(2026, 8, 1), "fx"), ("B", 30, D(2020, 1, 1), D(2026, 8, 1), "fx"), ("C", 900, D(2005, 1, 1), D(2018, 1, 1), "tourism")],
        "series_id string, n int, first_period date, last_period date, family string",
    )
    got = {r["series_id"]: r["ranges"] for r in ranges.offered_ranges(idx, F.lit("2026-08-22")).collect()}
    assert got["A"] == ["1y", "5y", "10y", "all", "ytd", "since_2016_float", "since_march_2024"]
    assert got["B"] == ["1y", "5y", "all", "ytd", "since_march_2024"]
    assert got["C"] == ["1y", "5y", "10y", "all"]


def test_auctions(spark):
    a = spark.createDataFrame(
        [("TB", 91, D(2020, 1, 1), 10.0, 200.0, 100.0), ("TB", 90, D(2020, 1, 1), 12.0, 300.0, 100.0), ("TB", 364, D(2020, 1, 1), 11.0, 50.0, 0.0), ("TB", 130, D(2020, 1, 1), 9.0, 1.0, 1.0)],
        "prefix string, tenor int, day date, y double, sub double, acc double",
    )
    s = shape.auction_series(a, F.col("prefix"), F.col("tenor"), F.col("day"), {"YLD.WAVG": F.col("y"), "AMT.ACC": F.col("acc")}, F.col("sub"), F.col("acc"), F.lit("USD"))
    got = {r["series_id"]: r["value"] for r in merge.daily_mean(s).collect()}
    assert got == {"TB.3M.YLD.WAVG": 11.0, "TB.3M.AMT.ACC": 100.0, "TB.3M.BIDCOVER": 2.5, "TB.12M.YLD.WAVG": 11.0, "TB.12M.AMT.ACC": 0.0}
    assert {r["unit"] for r in s.filter("series_id like '%AMT%'").collect()} == {"USD"}


def test_catalog_merges(spark):
    old = spark.createDataFrame([("A", "old"), ("EG.XL.1", "gone"), ("B", "kept")], "series_id string, title string")
    new = spark.createDataFrame([("A", None), ("C", "new")], "series_id string, title string")
    assert rows(merge.upsert(old, new, "series_id")) == [("A", None), ("B", "kept"), ("C", "new"), ("EG.XL.1", "gone")]
    assert rows(merge.replace_namespace(old, new.filter("series_id = 'C'"), "EG.XL."), "series_id") == [("A",), ("B",), ("C",)]
    o = obs(spark, B=[(0, 1)])
    assert rows(merge.advertise(old, o, ["A", "B"]), "series_id") == [("B",), ("EG.XL.1",)]
    assert rows(quality.hard_failures(o, old.filter("series_id = 'A'"))) == [("B", "uncatalogued")]


def test_vintages(spark):
    l = spark.createDataFrame(
        [("A", D(2020, 1, 1), 1.0, D(2020, 2, 1)), ("A", D(2020, 1, 1), 1.0, D(2020, 3, 1)), ("A", D(2020, 1, 1), 2.0, D(2020, 4, 1)), ("A", D(2020, 1, 2), 5.0, D(2020, 4, 1))],
        SCHEMA + ", seen_on date",
    )
    v = merge.vintages(l)
    assert rows(v, "value", "seen_from", "seen_to") == [(1.0, D(2020, 2, 1), D(2020, 4, 1)), (2.0, D(2020, 4, 1), None), (5.0, D(2020, 4, 1), None)]
    assert rows(merge.as_published(v, F.lit("2020-03-15").cast("date")), "value") == [(1.0,)]
    assert rows(merge.revisions(v), "old_value", "new_value", "revised_on") == [(1.0, 2.0, D(2020, 4, 1))]


def test_corridor_reads_backward_only(spark):
    side = lambda *p: obs(spark, m=list(p)).withColumnRenamed("series_id", "market")
    c = asof.corridor_position(side((5, 10.0), (9, 12.0)), side((0, 9.0), (8, 11.0)), side((0, 11.0), (8, 12.0)), ["market"])
    assert rows(c, "value", "floor", "ceiling", "position") == [(10.0, 9.0, 11.0, "on midpoint"), (12.0, 11.0, 12.0, "above")]


def test_siblings_and_views(spark):
    n = 45
    placed = spark.createDataFrame([(f"S{i:02d}", "t", "a") for i in range(n)] + [("X", "t", "b")], "series_id string, topic string, `table` string")
    got = index.siblings(placed)
    assert got.count() == n * 40
    first = [r[1] for r in sorted((r["rank"], r["sibling_id"]) for r in got.filter("series_id = 'S00'").collect())]
    assert first == [f"S{i:02d}" for i in range(1, 41)]
    o = obs(spark, A=[(0, 2), (10, 4)], B=[(1, 5), (12, 20)])
    assert rows(index.series_view(o, "A", transform="index"), "value") == [(100.0,), (200.0,)]
    pair = index.series_view(o, "A", compare_to="B")
    assert rows(pair, "first_value", "second_value", "gap") == [(100.0, 100.0, 0.0), (200.0, 400.0, 200.0)]


def test_wide_and_keyed(spark):
    w = spark.createDataFrame([("1/2/2020", "0", "5"), ("bad", "1", "1"), ("2/2/2020", "..", "0")], "Date string, ON string, Vol string")
    from seriesforge.functions.dates import period
    from seriesforge.functions.numbers import number

    out = shape.wide_to_long(w, period("Date"), {"ON": shape.Measure("ON"), "Vol": shape.Measure("VOL", zero_ok=True), "Gone": shape.Measure("G")}, "EG.{suffix}", number, zero_is_missing=True)
    assert rows(out, "series_id", "period", "value") == [("EG.VOL", D(2020, 2, 1), 5.0), ("EG.VOL", D(2020, 2, 2), 0.0)]
    k = spark.createDataFrame([("1/2/2020", " US Dollar ", "1.5"), ("1/2/2020", "Cowrie Shell", "0")], "Date string, Currency string, Buy string")
    out = shape.keyed_to_long(k, period("Date"), "Currency", ["Buy"], {"US Dollar": "USD"}, "FX.{key}.{col}", number)
    assert rows(out, "series_id", "value") == [("FX.COWRIESHELL.BUY", 0.0), ("FX.USD.BUY", 1.5)]
    try:
        shape.Measure(True)
        raise AssertionError("refused")
    except TypeError:
        pass


def _page_folder(spark, tmp_path, pages):
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    return str(tmp_path)


def test_bilingual_labels_of_pages_that_share_an_address(spark, tmp_path):
    """a label per page, none twice."""
    from seriesforge.plans import q_merge

    folder = _page_folder(spark, tmp_path, [(1, "u", "a"), (2, "u", "b"), (4, "u", "c"), (6, None, "d")])
    assert rows(q_merge.bilingual(spark, folder)) == [("u", "Q1", None), ("u", "Q2", "ق2"), ("u", "Q4", "ق4"), (None, "Q6", "ق6")]
    en = spark.createDataFrame([("k", "e")], "key string, f string")
    ar = spark.createDataFrame([("k", "a"), ("k", "b")], "key string, f string")
    assert rows(merge.bilingual(en, ar, "key", ["f"])) == [("k", "e", "b")]


def test_work_list_of_pages_that_share_an_address(spark, tmp_path):
    """a new page stays on the list though its address was seen; a read page without text is read."""
    from seriesforge.plans import q_merge

    folder = _page_folder(spark, tmp_path, [(4, "u", "a"), (5, "u", "b"), (8, "u", "c"), (9, "v", None), (None, "w", "d")])
    assert rows(q_merge.work_list(spark, folder)) == [("u",), ("u",)]
    manifest = spark.createDataFrame([("k",)], "key string")
    previous = spark.createDataFrame([("k", "a"), ("k", "b")], "key string, sha256 string")
    assert rows(merge.carry_forward(manifest, previous, "key", ["sha256"])) == [("k", "b")]


def test_interval_totals_are_those_of_the_join(spark):
    """sums by running totals, with open, empty, early and late intervals; no row a day of an interval."""
    days = [(D(2020, 1, 3), 5), (D(2020, 1, 4), 0), (D(2020, 1, 9), 2), (D(2020, 2, 1), 7), (None, 9)]
    daily = spark.createDataFrame(days, "period date, n long")
    ends = [None, D(2019, 1, 1), D(2020, 1, 2), D(2020, 1, 3), D(2020, 1, 4), D(2020, 1, 5), D(2020, 1, 31), D(2020, 2, 1), D(2020, 3, 1)]
    spans = [(i * 10 + j, a, b) for i, a in enumerate(ends) for j, b in enumerate(ends)]
    iv = spark.createDataFrame(spans, "span long, lo date, hi date")
    want = []
    for span, a, b in spans:
        met = [n for day, n in days if day and a and a <= day <= (b or D(2020, 1, 15))]
        want += [(span, sum(met))] if met else []
    got = asof.interval_totals(daily, "period", "n", iv, "lo", "hi", F.lit("2020-01-15"), "total")
    assert rows(got, "span", "total") == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))
    none = asof.interval_totals(daily.filter("false"), "period", "n", iv, "lo", "hi", F.lit("2020-01-15"), "total")
    assert none.count() == 0


def test_anomalies_read_their_prints_once(spark):
    read = spark.sparkContext.accumulator(0)

    def told(parts):
        for p in parts:
            read.add(len(p))
            yield p

    schema = "series_id string, period date, value double, ord int"
    prints = [("A", D(2001, 1, 1), 1.0, 1), ("A", D(2001, 1, 1), 2.0, 2), ("A", D(2001, 1, 1), 2.0, 3), ("A", D(2001, 1, 1), 1.0, 4), ("A", D(2001, 1, 1), 3.0, None), ("B", D(2001, 1, 2), 5.0, 9)]
    obs = spark.createDataFrame(prints, schema).mapInPandas(told, schema)
    got = merge.anomalies(obs).collect()
    assert sorted((r["kept"], r["discarded"]) for r in got) == [(1.0, 2.0), (1.0, 2.0), (1.0, 3.0)]
    assert read.value == len(prints)


def test_first_print_of_several_is_kept_by_order_then_value(spark):
    prints = [("A", D(2001, 1, 1), 2.0, 1), ("A", D(2001, 1, 1), 1.0, 1), ("A", D(2001, 1, 1), 4.0, 0)]
    got = merge.anomalies(spark.createDataFrame(prints, "series_id string, period date, value double, ord int"), dataset="x").collect()
    assert sorted((r["kept"], r["discarded"], r["dataset"]) for r in got) == [(4.0, 1.0, "x"), (4.0, 2.0, "x")]
