"""Summaries, windows, ranges, breaks and index views over observation tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesforge.operators import events, index, ordering, quality, ranges, shape, summary
from seriesforge.operators.spread import top_per_group
from seriesforge.plans import views as v
from seriesforge.plans.catalog import query
from seriesforge.sinks import publish



def as_of():
    return F.lit(v.AS_OF).cast("date")


SUMMARY_SQL = """
, prevs AS (SELECT *, lag(value) OVER w AS prev FROM {obs} WINDOW w AS (PARTITION BY series_id ORDER BY period)),
moves AS (SELECT *, CASE WHEN prev <> 0 THEN abs((value - prev) / prev) END AS pct, value - prev AS delta FROM prevs),
big AS (SELECT series_id, period AS move_period, round_even(delta, 6) AS move_change,
  round_even(pct * 100, 2) AS move_abs_pct,
  round_even(pct * 100, 2) * sign(delta) AS move_pct
  FROM moves WHERE pct IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY pct DESC, period DESC, delta DESC) = 1),
agg AS (SELECT series_id, count(*) AS n, min(period) AS first_period, max(period) AS last_period,
  arg_max(value, period) AS last, max(value) AS highest, min(value) AS lowest,
  round_even(median(value), 6) AS median,
  count(*) FILTER (value = 0) AS zeros FROM {obs} GROUP BY 1),
prv AS (SELECT series_id, prev AS previous FROM prevs
  QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY period DESC) = 1),
hi AS (SELECT o.series_id, min(o.period) AS highest_period FROM {obs} o JOIN agg a ON o.series_id = a.series_id AND o.value = a.highest GROUP BY 1),
lo AS (SELECT o.series_id, min(o.period) AS lowest_period FROM {obs} o JOIN agg a ON o.series_id = a.series_id AND o.value = a.lowest GROUP BY 1),
summary AS (SELECT agg.series_id, n, first_period, last_period, last, previous, highest, highest_period, lowest, lowest_period,
  median, move_period, move_change, move_abs_pct, move_pct,
  CASE WHEN zeros > 0 AND zeros < n * 0.5 THEN zeros END AS zero_values
  FROM agg LEFT JOIN prv USING (series_id) LEFT JOIN hi USING (series_id) LEFT JOIN lo USING (series_id) LEFT JOIN big USING (series_id))
"""
SUMMARY_COLS = [
    "series_id", "n", "first_period", "last_period", "last", "previous", "highest", "highest_period",
    "lowest", "lowest_period", "median", "move_period", "move_change", "move_abs_pct", "move_pct", "zero_values",
]
SUMMARY_DATES = ("first_period", "last_period", "highest_period", "lowest_period", "move_period")


def with_summary(obs: str, tail: str, extra: str = "") -> str:
    return v.with_ctes(f"{obs} {extra}".strip(), SUMMARY_SQL.format(obs=obs) + tail)


@query("h1_series_summary", "H1 H2 A9 D9", v.dated(with_summary("obs_orders", f"SELECT {', '.join(SUMMARY_COLS)} FROM summary"), *SUMMARY_DATES))
def series_summary(spark, sf):
    return v.iso(summary.summarise(v.obs_orders(spark, sf), daily=True).select(*SUMMARY_COLS))


@query("h1_many_series_summary", "H1 H2", v.dated(with_summary("obs_parts", f"SELECT {', '.join(SUMMARY_COLS)} FROM summary"), *SUMMARY_DATES))
def many_series_summary(spark, sf):
    return v.iso(summary.summarise(v.obs_parts(spark, sf), daily=True).select(*SUMMARY_COLS))


@query(
    "h2_biggest_move", "H2 I1",
    v.dated(with_summary("obs_orders", "SELECT series_id, move_period, move_change, move_abs_pct, move_pct FROM big"), "move_period"),
)
def biggest_move(spark, sf):
    out = summary.summarise(v.obs_orders(spark, sf), daily=True)
    return v.iso(out.select("series_id", "move_period", "move_change", "move_abs_pct", "move_pct"))


@query(
    "h6_long_run_multiple", "H6",
    v.with_ctes("obs_orders", "SELECT series_id, round_even(arg_max(value, period) / arg_min(value, period), 1) AS multiple FROM obs_orders GROUP BY 1"),
)
def long_run_multiple(spark, sf):
    return summary.long_run_multiple(v.obs_orders(spark, sf))


@query(
    "h8_density", "H8",
    v.with_ctes("obs_parts", """SELECT series_id, count(*) AS n, CASE WHEN max(period) > min(period)
  THEN count(*) / (date_diff('day', min(period), max(period)) / 365.0::DOUBLE) ELSE 0.0::DOUBLE END AS per_year
  FROM obs_parts GROUP BY 1"""),
)
def density(spark, sf):
    return summary.density(v.obs_parts(spark, sf))


@query(
    "h5_topic_counts", "H5 C24",
    with_summary("obs_parts", """, placed AS (SELECT s.n, CASE p.family WHEN 'fx' THEN 'money' WHEN 'govt' THEN 'rates'
  WHEN 'gdp' THEN 'growth' WHEN 'bop' THEN 'bop' ELSE 'other' END AS topic FROM summary s LEFT JOIN parts p USING (series_id))
SELECT topic, count(*) AS series, CAST(sum(n) AS BIGINT) AS observations FROM placed GROUP BY 1""", "parts"),
)
def topic_counts(spark, sf):
    s = summary.summarise(v.obs_parts(spark, sf), v.parts(spark, sf), daily=True)
    return index.topic_counts(index.with_place(s))


@query(
    "h5_facet_counts", "H5 N10 D17",
    "SELECT source, lang, count(*) AS documents FROM documents GROUP BY 1, 2",
)
def facet_counts(spark, sf):
    return index.facet_counts(v.table(spark, sf, "documents"), "source", "lang")


@query(
    "h12_distinct_counts", "H12",
    v.with_ctes("obs_events", "SELECT count(DISTINCT series_id) AS series, count(DISTINCT period) AS periods FROM obs_events"),
)
def distinct_counts(spark, sf):
    return index.distinct_counts(v.obs_events(spark, sf), series="series_id", periods="period")


CHANGES_SQL = """SELECT series_id, period, value, lag(period) OVER w AS previous_period, lag(value) OVER w AS previous,
  value - lag(value) OVER w AS change,
  CASE WHEN lag(value) OVER w <> 0 THEN (value - lag(value) OVER w) / lag(value) OVER w * 100 END AS pct_change
  FROM obs_orders WINDOW w AS (PARTITION BY series_id ORDER BY period)"""


@query(
    "i1_changes_of_raw_prints", "I1 L1",
    v.dated(v.with_ctes("obs_events", ", obs_orders AS (SELECT series_id, period, max(value) AS value FROM obs_events GROUP BY 1, 2) " + CHANGES_SQL), "period", "previous_period"),
)
def changes_of_raw_prints(spark, sf):
    return v.iso(summary.changes(v.obs_events(spark, sf).select("series_id", "period", "value")))


@query(
    "i4_rebase_raw_prints", "I4",
    v.dated(v.with_ctes("obs_events", """, d AS (SELECT series_id, period, max(value) AS value FROM obs_events GROUP BY 1, 2)
SELECT series_id, period, CASE WHEN first_value(value) OVER w <> 0 THEN value / first_value(value) OVER w * 100 ELSE value END AS value FROM d WINDOW w AS (PARTITION BY series_id ORDER BY period)"""), "period"),
)
def rebase_raw_prints(spark, sf):
    return v.iso(summary.rebase(v.obs_events(spark, sf)))


@query(
    "b7_series_documents_raw", "B7 E16",
    v.with_ctes("obs_events", """, d AS (SELECT series_id, period, max(value) AS value FROM obs_events GROUP BY 1, 2)
SELECT series_id, count(*) AS points, CAST(min(period) AS VARCHAR) AS first, CAST(max(period) AS VARCHAR) AS last FROM d GROUP BY 1"""),
)
def series_documents_raw(spark, sf):
    d = shape.series_documents(v.obs_events(spark, sf))
    day = lambda k: F.element_at("observations", k)["period"].cast("string")
    return d.select("series_id", F.col("count").cast("bigint").alias("points"), day(1).alias("first"), day(-1).alias("last"))


@query("i1_changes", "I1", v.dated(v.with_ctes("obs_orders", CHANGES_SQL), "period", "previous_period"))
def changes(spark, sf):
    return v.iso(summary.changes(v.obs_orders(spark, sf)))


@query(
    "i2_newest_readings", "I2",
    v.dated(v.with_ctes("obs_orders", """, r AS (SELECT series_id, period, value, value - lag(value) OVER w AS change,
  row_number() OVER (PARTITION BY series_id ORDER BY period DESC) AS rank, count(*) OVER (PARTITION BY series_id) AS n
  FROM obs_orders WINDOW w AS (PARTITION BY series_id ORDER BY period))
SELECT series_id, period, value, CASE WHEN rank < least(n, 500) THEN change END AS change, CAST(rank AS INT) AS rank FROM r WHERE rank <= 500"""), "period"),
)
def newest_readings(spark, sf):
    return v.iso(summary.newest_readings(v.obs_orders(spark, sf), 500))


def _yoy_sql(near: int) -> str:
    return v.dated(v.with_ctes("obs_orders", f""", c AS (SELECT a.series_id, a.period, a.value,
  b.period AS base_period, b.value AS base, abs(date_diff('day', b.period, a.period) - 365) AS d
  FROM obs_orders a JOIN obs_orders b ON a.series_id = b.series_id
  AND date_diff('day', b.period, a.period) BETWEEN {near} AND 409),
best AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY series_id, period ORDER BY d, base_period DESC) = 1)
SELECT series_id, period, base_period, (value - base) / abs(base) * 100 AS value FROM best WHERE base <> 0"""), "period", "base_period")


@query("i3_year_on_year", "I3", _yoy_sql(321))
def year_on_year(spark, sf):
    return v.iso(summary.year_on_year(v.obs_orders(spark, sf)))


@query("i3_year_on_year_compat", "I3", _yoy_sql(0))
def year_on_year_compat(spark, sf):
    return v.iso(summary.year_on_year(v.obs_orders(spark, sf), compat=True))


@query(
    "i4_rebase", "I4",
    v.dated(v.with_ctes("obs_orders", """SELECT series_id, period, value / first_value(value) OVER (PARTITION BY series_id ORDER BY period) * 100 AS value
  FROM obs_orders"""), "period"),
)
def rebase(spark, sf):
    return v.iso(summary.rebase(v.obs_orders(spark, sf)))


SPARK_SQL = """, r AS (SELECT series_id, period, value, row_number() OVER (PARTITION BY series_id ORDER BY period) - 1 AS pos,
  count(*) OVER (PARTITION BY series_id) AS n FROM {obs}),
picked AS (SELECT DISTINCT series_id, pos, value FROM r WHERE n >= {least} AND (n <= {k} OR pos = n - 1
  OR pos IN (SELECT CAST(floor(i * (n / {k}.0::DOUBLE)) AS BIGINT) FROM range({k}) t(i))))
"""


@query(
    "i6_sparkline_points", "I6 B10",
    v.with_ctes("obs_orders", SPARK_SQL.format(obs="obs_orders", k=48, least=2) + "SELECT series_id, pos, round_even(value, 4) AS value FROM picked"),
)
def sparkline_points(spark, sf):
    return summary.even_sample(v.obs_orders(spark, sf), 48).select("series_id", "pos", "value")


@query(
    "i6_chart_decimation", "I6",
    v.with_ctes("obs_orders", SPARK_SQL.format(obs="obs_orders", k=900, least=1) + "SELECT series_id, pos, value FROM picked"),
)
def chart_decimation(spark, sf):
    return summary.even_sample(v.obs_orders(spark, sf), 900, None, 1).select("series_id", "pos", "value")


@query(
    "b10_sparklines", "B10",
    v.with_ctes("obs_parts", SPARK_SQL.format(obs="obs_parts", k=48, least=2) + """SELECT series_id, count(*) AS points,
  string_agg(CAST(CAST(value * 100 AS BIGINT) AS VARCHAR), ',' ORDER BY pos) AS cents FROM picked GROUP BY 1"""),
)
def sparklines(spark, sf):
    s = publish.sparklines(v.obs_parts(spark, sf))
    cents = F.transform("values", lambda x: F.round(x * 100).cast("bigint").cast("string"))
    return s.select("series_id", F.size("values").cast("bigint").alias("points"), F.array_join(cents, ",").alias("cents"))


@query(
    "i7_first_k", "I7",
    v.with_ctes("parts", """SELECT dataset, series_id, CAST(rank AS INT) AS rank FROM (SELECT dataset, series_id,
  row_number() OVER (PARTITION BY dataset ORDER BY title_en, series_id) AS rank FROM parts) WHERE rank <= 10"""),
)
def first_k(spark, sf):
    return summary.first_k(v.parts(spark, sf), ["dataset"], [F.col("title_en"), F.col("series_id")], 10).select(
        "dataset", "series_id", "rank"
    )


@query(
    "i8_next_meeting", "I8",
    v.dated(v.with_ctes("meetings", """SELECT series_id, date, lag(date) OVER w AS previous_date, lead(date) OVER w AS next_date
  FROM meetings WINDOW w AS (PARTITION BY series_id ORDER BY date)"""), "date", "previous_date", "next_date"),
)
def next_meeting(spark, sf):
    return v.iso(events.neighbour_meetings(v.meetings(spark, sf)))


@query(
    "l1_breaks", "L1",
    v.dated(v.with_ctes("obs_orders", f""", c AS ({CHANGES_SQL})
SELECT period AS date, 'fx_move' AS type, CASE WHEN pct_change > 0 THEN 'devaluation' ELSE 'appreciation' END AS direction,
  series_id AS series, previous AS "from", value AS "to", round_even(pct_change, 2) AS pct_change, previous_period AS previous_date
FROM c WHERE abs(pct_change) >= 4"""), "date", "previous_date"),
)
def breaks(spark, sf):
    return v.iso(events.detect_breaks(v.obs_orders(spark, sf)).select("date", "type", "direction", "evidence.*"))


@query(
    "l1_large_breaks", "L1",
    v.dated(v.with_ctes("obs_parts", """, c AS (SELECT *, lag(value) OVER w AS previous FROM obs_parts
  WINDOW w AS (PARTITION BY series_id ORDER BY period)),
p AS (SELECT period AS date, round_even((value - previous) / previous * 100, 2) AS pct FROM c WHERE previous <> 0 AND abs((value - previous) / previous * 100) >= 1000)
SELECT date, (CASE WHEN pct > 0 THEN '+' ELSE '' END) || CAST(floor(pct + 0.5) AS BIGINT) || '%' AS label FROM p WHERE abs(pct) >= 8"""), "date"),
)
def large_breaks(spark, sf):
    return v.iso(events.shown_breaks(events.detect_breaks(v.obs_parts(spark, sf), 1000.0)))


@query(
    "j3_top_breaks", "J3",
    v.dated(v.with_ctes("obs_parts", """, c AS (SELECT *, lag(value) OVER w AS previous FROM obs_parts
  WINDOW w AS (PARTITION BY series_id ORDER BY period)),
p AS (SELECT period AS date, series_id AS series, round_even((value - previous) / previous * 100, 2) AS pct_change
  FROM c WHERE previous <> 0 AND abs((value - previous) / previous * 100) >= 4)
SELECT * FROM p ORDER BY abs(pct_change) DESC, date, series LIMIT 10"""), "date"),
)
def top_breaks(spark, sf):
    top = events.top_breaks(events.detect_breaks(v.obs_parts(spark, sf)))
    return v.iso(top.select("date", "evidence.series", "evidence.pct_change"))


@query(
    "l3_timeline", "L2 L3 G8",
    v.dated(v.with_ctes("obs_orders meetings", """, c AS (SELECT *, lag(value) OVER w AS previous FROM obs_orders
  WINDOW w AS (PARTITION BY series_id ORDER BY period)),
e AS (SELECT period AS date, 'fx_move' AS type, CAST(NULL AS VARCHAR) AS label FROM c
  WHERE previous <> 0 AND abs((value - previous) / previous * 100) >= 100
  UNION ALL SELECT date, 'mpc', series_id FROM meetings)
SELECT date, type, label, CASE WHEN date <= DATE '1997-06-30' THEN 'A' WHEN date <= DATE '1999-12-31' THEN 'B' ELSE 'C' END AS regime FROM e"""), "date"),
)
def timeline(spark, sf):
    from seriesforge.operators.asof import label_regime

    st = v.meetings(spark, sf).select(
        "date", F.col("series_id").alias("title"), F.lit(None).cast("string").alias("decision"), F.lit(None).cast("string").alias("url"),
        *[F.lit(None).cast("double").alias(r) for r in events.RATES],
    )
    t = events.timeline(events.detect_breaks(v.obs_orders(spark, sf), 100.0), st)
    return v.iso(label_regime(t, F.col("date"), v.REGIMES).select("date", "type", "label", "regime"))


def _range_sql(start: str) -> str:
    return v.dated(v.with_ctes("obs_parts", f""", c AS (SELECT *, count(*) FILTER (period >= {start}) OVER (PARTITION BY series_id) AS k FROM obs_parts)
SELECT series_id, period, value FROM c WHERE period >= {start} OR k <= 1"""), "period")


@query("l4_range_one_year", "L4", _range_sql(f"(DATE '{v.AS_OF}' - 365)"))
def range_one_year(spark, sf):
    return v.iso(ranges.apply_range(v.obs_parts(spark, sf), 1, as_of()))


@query("l4_range_ytd", "L4", _range_sql("DATE '2001-01-01'"))
def range_ytd(spark, sf):
    return v.iso(ranges.apply_range(v.obs_parts(spark, sf), "ytd", as_of()))


@query("l4_range_since", "L4", _range_sql("DATE '1999-06-01'"))
def range_since(spark, sf):
    return v.iso(ranges.apply_range(v.obs_parts(spark, sf), "1999-06-01", as_of()))


@query(
    "l5_offered_ranges", "L5",
    with_summary("obs_parts", """, y AS (SELECT s.series_id, s.n, s.last_period, date_diff('day', first_period, last_period) / 365.0::DOUBLE AS years FROM summary s),
p AS (SELECT *, CASE WHEN years > 0 THEN n / years ELSE 0 END AS per_year FROM y)
SELECT series_id, concat_ws(',', CASE WHEN 1 < years AND per_year >= 4 THEN '1y' END,
  CASE WHEN 5 < years AND per_year * 5 >= 4 THEN '5y' END, CASE WHEN 10 < years AND per_year * 10 >= 4 THEN '10y' END,
  'all', CASE WHEN year(last_period) >= 2001 AND per_year >= 4 THEN 'ytd' END) AS ranges FROM p"""),
)
def offered_ranges(spark, sf):
    s = summary.summarise(v.obs_parts(spark, sf), v.parts(spark, sf), daily=True)
    return ranges.offered_ranges(s, as_of()).select("series_id", F.array_join("ranges", ",").alias("ranges"))


GAUGE_SQL = "CASE WHEN highest <> lowest THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, ({x} - lowest) / (highest - lowest))) END"


@query(
    "l8_gauge", "L8 C32",
    with_summary("obs_parts", f"""SELECT series_id, {GAUGE_SQL.format(x='last')} AS gauge, {GAUGE_SQL.format(x='median')} AS gauge_median,
  CASE WHEN median = 0 OR (median > 0) <> (last > 0) THEN '' WHEN last / median >= 2 THEN 'many times'
  WHEN last / median >= 1 THEN 'above' ELSE 'below' END AS side FROM summary"""),
)
def gauge(spark, sf):
    from seriesforge.functions.reading import against_median

    s = summary.gauge(summary.summarise(v.obs_parts(spark, sf), daily=True))
    text = against_median(F.col("last"), F.col("median"))
    side = F.when(text.endswith("×"), "many times").when(text.endswith("above"), "above").when(text.endswith("below"), "below").otherwise("")
    return s.select("series_id", "gauge", "gauge_median", side.alias("side"))


@query(
    "l9_readable_move", "L9",
    with_summary("obs_parts", """SELECT s.series_id, move_change, CASE WHEN move_abs_pct <= 500 AND NOT contains(lower(p.unit), 'percent') THEN move_pct END AS shown_pct
FROM summary s LEFT JOIN parts p USING (series_id)""", "parts"),
)
def readable_move(spark, sf):
    s = summary.summarise(v.obs_parts(spark, sf), v.parts(spark, sf), daily=True)
    return summary.readable_move(s).select("series_id", "move_change", "shown_pct")


HEADLINES = [("Urgent", ["ORD.1", "ORD.2"]), ("Rest", ["ORD.3", "ORD.5"])]


@query(
    "l10_headline_table", "L10",
    v.dated(with_summary("obs_orders", f"""SELECT CASE WHEN series_id IN ('ORD.1', 'ORD.2') THEN 'Urgent' ELSE 'Rest' END AS "group",
  CASE series_id WHEN 'ORD.1' THEN '000.000' WHEN 'ORD.2' THEN '000.001' WHEN 'ORD.3' THEN '001.000' ELSE '001.001' END AS place,
  series_id, last AS latest, last - previous AS change, lowest, highest, {GAUGE_SQL.format(x='last')} AS gauge,
  {GAUGE_SQL.format(x='median')} AS gauge_median, last_period AS as_of FROM summary WHERE series_id IN ('ORD.1', 'ORD.2', 'ORD.3', 'ORD.5')"""), "as_of"),
)
def headline_table(spark, sf):
    return v.iso(index.headline(summary.summarise(v.obs_orders(spark, sf), daily=True), HEADLINES))


PLACED_SQL = """, placed AS (SELECT s.*, p.title_en, p.freq, p.unit, p.family, substr(p.title_en, 1, instr(p.title_en, ' - ') - 1) AS "table",
  substr(p.title_en, instr(p.title_en, ' - ') + 3) AS line, CASE p.family WHEN 'fx' THEN 'money' WHEN 'govt' THEN 'rates'
  WHEN 'gdp' THEN 'growth' WHEN 'bop' THEN 'bop' ELSE 'other' END AS topic FROM summary s LEFT JOIN parts p USING (series_id))
"""


def _placed(spark, sf):
    return index.with_place(summary.summarise(v.obs_parts(spark, sf), v.parts(spark, sf), as_of(), daily=True))


@query(
    "l11_topic_page", "L11 C23 C24",
    v.dated(with_summary("obs_parts", PLACED_SQL + 'SELECT topic, "table", count(*) AS series, min(first_period) AS covers_from FROM placed GROUP BY 1, 2', "parts"), "covers_from"),
)
def topic_page(spark, sf):
    return v.iso(index.topic_page(_placed(spark, sf)))


@query(
    "l13_quality_notice", "L13 D8 D9 D13",
    v.dated(with_summary("obs_parts", PLACED_SQL + f"""SELECT series_id, last_period, CAST(date_diff('day', last_period, DATE '{v.AS_OF}') AS INT) AS stale_days
FROM placed WHERE date_diff('day', last_period, DATE '{v.AS_OF}') > CASE freq WHEN 'D' THEN 21 WHEN 'M' THEN 75 WHEN 'Q' THEN 200 END""", "parts"), "last_period"),
)
def quality_notice(spark, sf):
    notices = index.quality_notice(_placed(spark, sf))
    return v.iso(notices.filter(F.array_contains("notices", "discontinued")).select("series_id", "last_period", "stale_days"))


@query(
    "g11_siblings", "G11 I7",
    with_summary("obs_parts", PLACED_SQL + """, m AS (SELECT series_id, topic, "table", row_number() OVER (PARTITION BY topic, "table" ORDER BY series_id) AS pos FROM placed),
few AS (SELECT * FROM m WHERE pos <= 41)
SELECT a.series_id, b.series_id AS sibling_id, CAST(row_number() OVER (PARTITION BY a.series_id ORDER BY b.series_id) AS INT) AS rank
FROM m a JOIN few b ON a.topic = b.topic AND a."table" = b."table" AND a.series_id <> b.series_id
QUALIFY row_number() OVER (PARTITION BY a.series_id ORDER BY b.series_id) <= 40""", "parts"),
)
def siblings(spark, sf):
    return index.siblings(_placed(spark, sf))


@query(
    "g14_desk_groups", "G14",
    with_summary("obs_parts", PLACED_SQL + """, want AS (SELECT DISTINCT 'PART.' || (p_partkey * 2) AS series_id FROM part)
SELECT coalesce(topic, '(unknown)') AS topic, count(*) AS series, count(*) FILTER (topic IS NULL) AS missing
FROM want LEFT JOIN placed USING (series_id) GROUP BY 1""", "parts"),
)
def desk_groups(spark, sf):
    wanted = v.table(spark, sf, "part").select(F.concat(F.lit("PART."), F.col("p_partkey") * 2).alias("series_id"))
    return index.desk_groups(wanted, _placed(spark, sf))


@query(
    "b21_snapshot", "B21 G1",
    v.dated(with_summary("obs_parts", PLACED_SQL + """SELECT series_id, title_en AS title, unit, last_period AS period, last AS value, previous, last - previous AS change
FROM placed WHERE series_id IN ('PART.1', 'PART.7', 'PART.42', 'PART.nowhere')""", "parts"), "period"),
)
def snapshot(spark, sf):
    return v.iso(index.snapshot(_placed(spark, sf), ["PART.1", "PART.7", "PART.42", "PART.nowhere"]))


@query(
    "b8_catalog_index", "B8 G1",
    v.dated(with_summary("obs_parts", PLACED_SQL + f"""SELECT series_id, title_en, family, freq, unit, n, first_period AS first, last_period AS last, last AS latest_value,
  highest, lowest, previous, median, move_pct AS biggest_pct,
  CASE WHEN date_diff('day', last_period, DATE '{v.AS_OF}') > CASE freq WHEN 'D' THEN 21 WHEN 'M' THEN 75 WHEN 'Q' THEN 200 END
  THEN CAST(date_diff('day', last_period, DATE '{v.AS_OF}') AS INT) END AS stale_days FROM placed""", "parts"), "first", "last"),
)
def catalog_index(spark, sf):
    i = publish.catalog_index(_placed(spark, sf))
    return v.iso(i.select(
        "series_id", "title_en", "family", "freq", "unit", "n", "first", "last", "latest_value",
        F.col("highest.value").alias("highest"), F.col("lowest.value").alias("lowest"),
        "previous", "median", F.col("biggest_move.pct_change").alias("biggest_pct"), "stale_days",
    ))


@query(
    "b9_flag_numbers", "B9 D8",
    with_summary("obs_parts", PLACED_SQL + f"""SELECT series_id, CAST(date_diff('day', last_period, DATE '{v.AS_OF}') AS INT) AS stale_days,
  CAST(zero_values AS INT) AS zero_values FROM placed
WHERE date_diff('day', last_period, DATE '{v.AS_OF}') > CASE freq WHEN 'D' THEN 21 WHEN 'M' THEN 75 WHEN 'Q' THEN 200 END""", "parts"),
)
def flag_numbers(spark, sf):
    prose = summary.flag_sentences(_placed(spark, sf)).select("series_id", "flags").filter(F.size("flags") > 0)
    return summary.flag_numbers(prose).select("series_id", "stale_days", "zero_values")


@query(
    "b18_coverage_report", "B18",
    with_summary("obs_orders", """SELECT 0 AS section, '' AS series_id, printf('**%d series, %s observations.**', count(*), format('{:,}', CAST(sum(n) AS BIGINT))) AS line FROM summary
UNION ALL SELECT 1, series_id, '| `' || series_id || '` | ' || first_period || ' to ' || last_period || ' | ' || format('{:,}', n) FROM summary"""),
)
def coverage_report(spark, sf):
    rows = publish.coverage_rows(summary.summarise(v.obs_orders(spark, sf), daily=True))
    short = F.when(F.col("section") == 1, F.regexp_extract("line", r"^(\|[^|]*\|[^|]*\|[^|]*?) \|", 1)).otherwise(F.col("line"))
    return rows.select("section", "series_id", short.alias("line"))


@query(
    "b19_status", "B19",
    v.with_ctes("obs_parts", """SELECT '2001-12-31' AS built_at, (SELECT count(DISTINCT series_id) FROM obs_parts) AS series,
  (SELECT count(*) FROM obs_parts) AS observations, (SELECT count(*) FROM documents) AS documents"""),
)
def status(spark, sf):
    s = summary.summarise(v.obs_parts(spark, sf), daily=True)
    return publish.status_row(s, v.table(spark, sf, "documents"), F.lit(v.AS_OF), F.lit(None)).drop("last_scrape")


@query(
    "b5_family_counts", "B5 C13",
    """WITH o AS (SELECT list_extract(['EG.FX.', 'EG.IBK.', 'EG.TB.', 'EG.CPI.', 'EG.RES.', 'EG.XL.', 'EG.NEW.'], CAST(l_orderkey % 7 AS INT) + 1) || l_suppkey AS series_id FROM lineitem)
SELECT CASE WHEN series_id LIKE 'EG.FX.%' THEN 'fx' WHEN series_id LIKE 'EG.IBK.%' THEN 'rates' WHEN series_id LIKE 'EG.TB.%' THEN 'govt'
  WHEN series_id LIKE 'EG.CPI.%' THEN 'prices' WHEN series_id LIKE 'EG.RES.%' THEN 'external' WHEN series_id LIKE 'EG.XL.%' THEN 'excel' ELSE 'other' END AS part_family,
  count(*) AS rows, count(DISTINCT series_id) AS series FROM o GROUP BY 1""",
)
def family_counts(spark, sf):
    heads = F.array(*[F.lit(h) for h in ("EG.FX.", "EG.IBK.", "EG.TB.", "EG.CPI.", "EG.RES.", "EG.XL.", "EG.NEW.")])
    o = v.table(spark, sf, "lineitem").select(
        F.concat(F.element_at(heads, (F.col("l_orderkey") % 7).cast("int") + 1), F.col("l_suppkey")).alias("series_id")
    )
    return publish.family_counts(o)


@query(
    "b7_series_documents", "B7 E16",
    v.with_ctes("obs_parts", """SELECT series_id, count(*) AS "count", string_agg(CAST(period AS VARCHAR) || '=' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR), ' ' ORDER BY period) AS observations
FROM obs_parts GROUP BY 1"""),
)
def series_documents(spark, sf):
    from seriesforge.operators.shape import series_documents as docs

    d = docs(v.obs_parts(spark, sf))
    flat = F.transform("observations", lambda o: F.concat(o["period"].cast("string"), F.lit("="), F.round(o["value"] * 100).cast("bigint").cast("string")))
    return d.select("series_id", F.col("count").cast("bigint").alias("count"), F.array_join(flat, " ").alias("observations"))


@query(
    "j1_series_order", "J1 B1",
    v.dated(v.with_ctes("obs_orders", "SELECT series_id, period, value FROM obs_orders ORDER BY 1, 2"), "period"),
)
def series_order(spark, sf):
    return v.iso(publish.tidy_layout(v.obs_orders(spark, sf)).select("series_id", "period", "value"))


@query(
    "j2_newest_documents", "J2",
    "SELECT doc_id, source, n_chars FROM documents ORDER BY n_chars DESC, doc_id DESC LIMIT 60",
)
def newest_documents(spark, sf):
    return ordering.newest(v.table(spark, sf, "documents").select("doc_id", "source", "n_chars"), 60, F.desc("n_chars"), F.desc("doc_id"))


def _manifest(spark, sf):
    """Documents as a manifest with few dates, so that titles and ids settle most places."""
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("doc_id") % 20).cast("int"))
    d = v.table(spark, sf, "documents")
    return d.select(F.col("doc_id").cast("string").alias("id"), F.when(F.col("doc_id") % 7 != 0, day).alias("date"), "lang", "source")


MANIFEST_SQL = "m AS (SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 7 <> 0 THEN DATE '2020-01-01' + CAST(doc_id % 20 AS INT) END AS date, lang, source FROM documents)"


@query(
    "j7_manifest_order", "J7 J1",
    v.dated(f"WITH {MANIFEST_SQL} SELECT id, date, lang AS title, row_number() OVER (ORDER BY date DESC NULLS LAST, lang DESC NULLS LAST, id) - 1 AS position FROM m", "date"),
)
def manifest_order(spark, sf):
    return v.iso(ordering.newest_first(_manifest(spark, sf).select("id", "date", F.col("lang").alias("title"))))


@query("j7_category_order", "J7", f"WITH {MANIFEST_SQL} SELECT source AS category, id AS url, row_number() OVER (ORDER BY source NULLS FIRST, id) - 1 AS position FROM m")
def category_order(spark, sf):
    return ordering.by_category(_manifest(spark, sf).select(F.col("source").alias("category"), F.col("id").alias("url")))


@query(
    "j1_observation_order", "J1",
    v.dated(v.with_ctes("obs_parts", "SELECT series_id, period, value, row_number() OVER (ORDER BY series_id, period) - 1 AS position FROM obs_parts"), "period"),
)
def observation_order(spark, sf):
    return v.iso(ordering.positions(v.obs_parts(spark, sf), [F.col("series_id").asc(), F.col("period").asc()]))


@query(
    "j6_group_positions", "J6",
    v.with_ctes("parts", """SELECT "table", series, row_number() OVER (ORDER BY series DESC, "table") - 1 AS position FROM
  (SELECT substr(title_en, 1, instr(title_en, ' - ') - 1) AS "table", count(*) AS series FROM parts GROUP BY 1)"""),
)
def group_positions(spark, sf):
    from seriesforge.functions.reading import table_of

    return ordering.groups_by_size(v.parts(spark, sf), table_of(F.col("title_en"), F.col("dataset")), "table", "series")


@query(
    "c32_hot_median", "C32 H1",
    """SELECT CASE WHEN l_orderkey % 3 <> 0 THEN l_suppkey END AS key, round(median(l_extendedprice), 6) AS median FROM lineitem GROUP BY 1""",
)
def hot_median(spark, sf):
    """Median price by supplier, a third of all lines under one key of none."""
    rows = v.table(spark, sf, "lineitem").select(F.when(F.col("l_orderkey") % 3 != 0, F.col("l_suppkey")).alias("key"), "l_extendedprice")
    return ordering.medians(rows, "key", "l_extendedprice").select("key", F.round("median", 6).alias("median"))


@query(
    "d20_shown_breaks", "D20 L1",
    v.dated(v.with_ctes("obs_events", """, o AS (SELECT series_id, period, max(value) + 200 AS value FROM obs_events GROUP BY 1, 2),
c AS (SELECT *, lag(value) OVER w AS previous FROM o WINDOW w AS (PARTITION BY series_id ORDER BY period)),
p AS (SELECT period AS date, round_even((value - previous) / previous * 100, 2) AS pct FROM c WHERE previous <> 0 AND abs((value - previous) / previous * 100) >= 4)
SELECT date, (CASE WHEN pct > 0 THEN '+' ELSE '' END) || CAST(floor(pct + 0.5) AS BIGINT) || '%' AS label FROM p WHERE abs(pct) >= 8"""), "date"),
)
def shown_breaks(spark, sf):
    """Breaks of 4 % and more, of which only those of 8 % and more are shown."""
    obs = v.obs_events(spark, sf).select("series_id", "period", (F.col("value") + 200).alias("value"))
    return v.iso(events.shown_breaks(events.detect_breaks(obs)))


NOTICE_SQL = """SELECT 'S' || l_suppkey AS series_id, CAST(max(l_shipdate) AS DATE) AS last_period, CASE WHEN l_suppkey % 3 = 0 THEN CAST(l_suppkey AS INT) END AS stale_days,
  CASE WHEN l_suppkey % 4 = 0 THEN count(*) FILTER (l_discount = 0) END AS zero_values, CASE WHEN l_suppkey % 5 = 0 THEN count(*) - count(DISTINCT CAST(l_shipdate AS DATE)) ELSE 0 END AS duplicate_periods FROM lineitem GROUP BY l_suppkey"""


@query(
    "l13_all_notices", "L13",
    v.dated(f"""WITH s AS ({NOTICE_SQL}) SELECT *, concat_ws(',', CASE WHEN stale_days IS NOT NULL THEN 'discontinued' END, CASE WHEN zero_values IS NOT NULL THEN 'zeros' END, CASE WHEN duplicate_periods > 0 THEN 'duplicates' END) AS notices
FROM s WHERE stale_days IS NOT NULL OR zero_values IS NOT NULL OR duplicate_periods > 0""", "last_period"),
)
def all_notices(spark, sf):
    key, day = F.col("l_suppkey"), F.col("l_shipdate").cast("date")
    s = v.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.max(day).alias("last_period"), F.count_if(F.col("l_discount") == 0).alias("_z"), (F.count(F.lit(1)) - F.count_distinct(day)).alias("_d")
    )
    s = s.select(
        F.concat(F.lit("S"), key).alias("series_id"), "last_period", F.when(key % 3 == 0, key.cast("int")).alias("stale_days"),
        F.when(key % 4 == 0, F.col("_z")).alias("zero_values"), F.when(key % 5 == 0, F.col("_d")).otherwise(F.lit(0)).alias("duplicate_periods"),
    )
    return v.iso(index.quality_notice(s).withColumn("notices", F.array_join("notices", ",")))


@query(
    "e14_whole_panel", "E14",
    """WITH m AS (SELECT l_linestatus AS prefix, list_extract(['3M', '6M', '9M', '12M', '24M'], CAST(l_linenumber % 5 AS INT) + 1) AS tenor, l_extendedprice AS p, l_quantity AS q, l_tax AS t, l_discount AS d FROM lineitem)
SELECT prefix, tenor, max(p) AS yield_latest, max(q) AS yield_change, max(t) AS yield_min, max(d) AS yield_max, max(p + q) AS cover, max(q + t) AS submitted, max(q + d) AS accepted FROM m WHERE tenor <> '24M' GROUP BY 1, 2""",
)
def whole_panel(spark, sf):
    """Every column of the panel, from an index with all six measures."""
    tenor = F.element_at(F.array(*[F.lit(t) for t in ("3M", "6M", "9M", "12M", "24M")]), (F.col("l_linenumber") % 5 + 1).cast("int"))
    p, q, t, d = (F.col(c) for c in ("l_extendedprice", "l_quantity", "l_tax", "l_discount"))
    measures = {"YLD.WAVG": p, "YLD.MIN": t, "YLD.MAX": d, "BIDCOVER": p + q, "AMT.SUB": q + t, "AMT.ACC": q + d}
    lines = F.array(*[F.struct(F.lit(n).alias("measure"), c.cast("double").alias("latest"), q.cast("double").alias("change")) for n, c in measures.items()])
    return shape.tenor_panel(v.table(spark, sf, "lineitem").select(F.col("l_linestatus").alias("prefix"), tenor.alias("tenor"), F.inline(lines)))


@query(
    "b18_whole_lines", "B18",
    v.with_ctes("parts", """, o AS (SELECT 'PART.' || l_partkey AS series_id, CAST(l_shipdate AS DATE) AS period, max(l_quantity) AS value FROM lineitem GROUP BY 1, 2),
s AS (SELECT series_id, count(*) AS n, min(period) AS a, max(period) AS b, arg_max(value, period) AS last FROM o GROUP BY 1)
SELECT series_id, '| `' || series_id || '` | ' || a || ' to ' || b || ' | ' || format('{:,}', n) || ' | ' || CASE WHEN last >= 10 THEN printf('%.4f', last) ELSE printf('%.5f', last) END || ' | ' || coalesce(unit, '') || ' |' AS line FROM s LEFT JOIN parts USING (series_id)"""),
)
def whole_lines(spark, sf):
    """The lines of the report as a reader gets them, with the latest value and the unit."""
    obs = v.table(spark, sf, "lineitem").groupBy(F.concat(F.lit("PART."), "l_partkey").alias("series_id"), F.col("l_shipdate").cast("date").alias("period")).agg(F.max("l_quantity").alias("value"))
    lines = publish.coverage_rows(summary.summarise(obs, v.parts(spark, sf)))
    return lines.filter("section = 1").select("series_id", "line")


@query(
    "j6_groups_by_size", "J6",
    v.with_ctes("parts", """SELECT "table", series FROM (SELECT substr(title_en, 1, instr(title_en, ' - ') - 1) AS "table", count(*) AS series FROM parts GROUP BY 1)
ORDER BY series DESC, "table" LIMIT 100"""),
)
def groups_by_size(spark, sf):
    from seriesforge.functions.reading import table_of

    return (
        v.parts(spark, sf).groupBy(table_of(F.col("title_en"), F.col("dataset")).alias("table"))
        .agg(F.count(F.lit(1)).alias("series")).orderBy(F.desc("series"), "table").limit(100)
    )


@query(
    "d18_topic_filter", "D18",
    v.with_ctes("parts", "SELECT series_id, title_en FROM parts WHERE contains(lower(title_en || ' ' || series_id), 'ring') AND freq = 'M'"),
)
def topic_filter(spark, sf):
    return quality.topic_filter(v.parts(spark, sf), " RING ", "M").select("series_id", "title_en")


@query(
    "d8_stale_series", "D8",
    with_summary("obs_parts", PLACED_SQL + f"""SELECT series_id, freq, CAST(date_diff('day', last_period, DATE '{v.AS_OF}') AS INT) AS stale_days FROM placed
WHERE date_diff('day', last_period, DATE '{v.AS_OF}') > CASE freq WHEN 'D' THEN 21 WHEN 'M' THEN 75 WHEN 'Q' THEN 200 WHEN 'A' THEN 500 END""", "parts"),
)
def stale_series(spark, sf):
    s = summary.summarise(v.obs_parts(spark, sf), v.parts(spark, sf), daily=True)
    return quality.stale_series(s, as_of(), annual=True).select("series_id", "freq", "stale_days")


@query(
    "series_view_year_on_year", "I3 I4 L4",
    v.dated(v.with_ctes("obs_orders", """, cut AS (SELECT * FROM obs_orders WHERE series_id = 'ORD.1' AND period >= DATE '1998-01-01'),
c AS (SELECT a.series_id, a.period, a.value, b.period AS bp, b.value AS base, abs(date_diff('day', b.period, a.period) - 365) AS d
  FROM cut a JOIN cut b ON date_diff('day', b.period, a.period) BETWEEN 321 AND 409),
best AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY period ORDER BY d, bp DESC) = 1)
SELECT series_id, period, (value - base) / abs(base) * 100 AS value FROM best"""), "period"),
)
def series_view_yoy(spark, sf):
    return v.iso(index.series_view(v.obs_orders(spark, sf), "ORD.1", "1998-01-01", "yoy", as_of=as_of()))


@query(
    "g12_compare_two", "G12 G6 I4",
    v.dated(v.with_ctes("obs_orders", """, r AS (SELECT series_id, period, value / first_value(value) OVER (PARTITION BY series_id ORDER BY period) * 100 AS value FROM obs_orders WHERE series_id IN ('ORD.1', 'ORD.5')),
a AS (SELECT * FROM r WHERE series_id = 'ORD.1'), b AS (SELECT * FROM r WHERE series_id = 'ORD.5'),
m AS (SELECT a.period, a.value AS first_value, b.value AS second_value, b.period AS second_period,
  row_number() OVER (PARTITION BY a.period ORDER BY abs(date_diff('day', a.period, b.period)), b.period) AS k
  FROM a JOIN b ON abs(date_diff('day', a.period, b.period)) < 60)
SELECT period, first_value, second_value, second_period, second_value - first_value AS gap FROM m WHERE k = 1"""), "period", "second_period"),
)
def compare_two(spark, sf):
    return v.iso(index.series_view(v.obs_orders(spark, sf), "ORD.1", None, compare_to="ORD.5", as_of=as_of()))


@query(
    "j5_top_series", "J5",
    with_summary("obs_parts", "SELECT series_id, n, last FROM summary ORDER BY n DESC, series_id LIMIT 100"),
)
def top_series(spark, sf):
    s = summary.summarise(v.obs_parts(spark, sf), daily=True)
    return s.select("series_id", "n", "last").orderBy(F.desc("n"), "series_id").limit(100)


@query(
    "j4_top_readings_per_series", "J4 I7",
    v.dated(v.with_ctes("obs_orders", """SELECT series_id, period, value, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY value DESC, period) AS rank
FROM obs_orders) WHERE rank <= 25"""), "period"),
)
def top_readings(spark, sf):
    return v.iso(top_per_group(v.obs_orders(spark, sf), ["series_id"], [F.desc("value"), F.asc("period")], 25, "rank"))
