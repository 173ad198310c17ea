"""Lookups, as-of and nearest joins, intervals, the corridor and recovered decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesforge.operators import asof, merge, statements
from seriesforge.plans import views as v
from seriesforge.plans.catalog import query


@query(
    "g1_catalog_lookup", "G1",
    v.dated(v.with_ctes("obs_parts parts", """, c AS (SELECT * FROM parts WHERE CAST(substr(series_id, 6) AS BIGINT) % 4 <> 0)
SELECT o.series_id, o.period, o.value, c.title_en, c.unit FROM obs_parts o LEFT JOIN c USING (series_id)"""), "period"),
)
def catalog_lookup(spark, sf):
    cat = v.parts(spark, sf).filter(F.substring("series_id", 6, 20).cast("bigint") % 4 != 0).select("series_id", "title_en", "unit")
    return v.iso(v.obs_parts(spark, sf).join(cat, ["series_id"], "left"))


@query(
    "g2_work_list", "G2",
    "SELECT p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)",
)
def on_disk(spark, sf):
    disk = v.table(spark, sf, "lineitem").filter("l_returnflag = 'R' and l_quantity > 45").select(F.col("l_partkey").alias("p_partkey")).distinct()
    return merge.present_only(v.table(spark, sf, "part").select("p_partkey"), disk, "p_partkey")


@query(
    "g3_uncatalogued", "G3",
    v.with_ctes("obs_parts", "SELECT DISTINCT series_id FROM obs_parts WHERE CAST(substr(series_id, 6) AS BIGINT) % 3 = 0"),
)
def uncatalogued(spark, sf):
    from seriesforge.operators.quality import uncatalogued as op

    cat = v.parts(spark, sf).filter(F.substring("series_id", 6, 20).cast("bigint") % 3 != 0).select("series_id")
    return op(v.obs_parts(spark, sf), cat)


ASOF_SQL = """, probe AS (SELECT l_orderkey, l_linenumber, 'ORD.' || (1 + l_linenumber % 5) AS series_id, CAST(l_shipdate AS DATE) AS day FROM lineitem)
"""


def _probe(spark, sf):
    return v.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat(F.lit("ORD."), 1 + F.col("l_linenumber") % 5).alias("series_id"),
        F.col("l_shipdate").cast("date").alias("day"),
    )


@query(
    "g4_asof_backward", "G4",
    v.dated(v.with_ctes("obs_orders", ASOF_SQL + """SELECT p.*, o.value AS rate, o.period AS rate_date FROM probe p
ASOF LEFT JOIN obs_orders o ON p.series_id = o.series_id AND p.day >= o.period"""), "day", "rate_date"),
)
def asof_backward(spark, sf):
    return v.iso(asof.asof_backward(
        _probe(spark, sf), v.obs_orders(spark, sf), ["series_id"], "day", "period", ["value"], ["rate"], "rate_date"
    ))


@query(
    "g6_nearest", "G6",
    v.dated(v.with_ctes("obs_orders", ASOF_SQL + """, b AS (SELECT p.*, o.value AS bv, o.period AS bd FROM probe p ASOF LEFT JOIN obs_orders o ON p.series_id = o.series_id AND p.day >= o.period),
f AS (SELECT b.*, o.value AS fv, o.period AS fd FROM b ASOF LEFT JOIN obs_orders o ON b.series_id = o.series_id AND b.day <= o.period)
SELECT l_orderkey, l_linenumber, series_id, day, CASE WHEN fd IS NULL OR date_diff('day', bd, day) <= date_diff('day', day, fd) THEN bv ELSE fv END AS rate FROM f"""), "day"),
)
def nearest(spark, sf):
    return v.iso(asof.nearest(_probe(spark, sf), v.obs_orders(spark, sf), ["series_id"], "day", "period", ["value"], ["rate"]))


EFFECT_SQL = """, m AS (SELECT *, lead(date) OVER (PARTITION BY series_id ORDER BY date) AS next_date FROM meetings),
c AS (SELECT *, least(date + 7, coalesce(next_date - 1, date + 7)) AS look_at, date - 1 AS day_before FROM m),
a AS (SELECT c.*, o.value AS rate_after FROM c ASOF LEFT JOIN obs_orders o ON c.series_id = o.series_id AND c.look_at >= o.period),
e AS (SELECT a.*, o.value AS rate_before FROM a ASOF LEFT JOIN obs_orders o ON a.series_id = o.series_id AND a.day_before >= o.period)
"""


@query(
    "g5_meeting_effect", "G5 I8",
    v.dated(v.with_ctes("obs_orders meetings", EFFECT_SQL + "SELECT series_id, date, look_at, rate_after, rate_before FROM e"), "date", "look_at"),
)
def meeting_effect(spark, sf):
    e = asof.meeting_effect(v.meetings(spark, sf), v.obs_orders(spark, sf), ["series_id"])
    return v.iso(e.select("series_id", "date", "look_at", "rate_after", "rate_before"))


@query(
    "g7_clip_with_carry", "G7",
    v.dated(v.with_ctes("obs_parts", """SELECT series_id, period, value FROM obs_parts WHERE period >= DATE '1998-06-15'
UNION ALL SELECT series_id, DATE '1998-06-15', arg_max(value, period) FROM obs_parts WHERE period < DATE '1998-06-15' GROUP BY 1"""), "period"),
)
def clip_with_carry(spark, sf):
    return v.iso(asof.clip_with_carry(v.obs_parts(spark, sf), F.lit("1998-06-15")))


@query(
    "g8_regimes", "G8",
    v.dated(v.with_ctes("obs_orders", """, r AS (SELECT * FROM (VALUES (DATE '1995-01-01', DATE '1997-06-30', 'A'), (DATE '1997-07-01', DATE '1999-12-31', 'B'), (DATE '2000-01-01', NULL, 'C')) t(lo, hi, regime))
SELECT series_id, period, value, regime FROM obs_orders LEFT JOIN r ON period >= lo AND period <= coalesce(hi, DATE '9999-12-31')"""), "period"),
)
def regimes(spark, sf):
    return v.iso(asof.label_regime(v.obs_orders(spark, sf), F.col("period"), v.REGIMES))


@query(
    "g8_interval_join", "G8",
    v.with_ctes("obs_parts", """, spans AS (SELECT o_orderkey AS span, CAST(o_orderdate AS DATE) AS lo,
  CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 45 AS INT) END AS hi FROM orders),
d AS (SELECT period, count(*) AS n FROM obs_parts GROUP BY 1)
SELECT span, CAST(sum(n) AS BIGINT) AS readings FROM d JOIN spans ON period >= lo AND period <= coalesce(hi, DATE '2001-12-31') GROUP BY 1"""),
)
def interval_join(spark, sf):
    day = F.col("o_orderdate").cast("date")
    spans = (
        v.table(spark, sf, "orders")
        .select(F.col("o_orderkey").alias("span"), day.alias("lo"),
                F.when(F.col("o_orderkey") % 10 != 0, F.date_add(day, (F.col("o_orderkey") % 45).cast("int"))).alias("hi"))
    )
    d = v.obs_parts(spark, sf).select("series_id", "period")
    # Readings of a day count together before they meet the intervals.
    daily = d.groupBy("period").agg(F.count(F.lit(1)).alias("_n"))
    j = asof.interval_totals(daily, "period", "_n", spans, "lo", "hi", F.lit("2001-12-31"), "_readings")
    return j.groupBy("span").agg(F.sum("_readings").alias("readings"))


@query(
    "l6_corridor_position", "L6 G4",
    v.dated(v.with_ctes("obs_orders", """, x AS (SELECT period, value FROM obs_orders WHERE series_id = 'ORD.1'),
f AS (SELECT x.*, o.value AS floor FROM x ASOF JOIN (SELECT * FROM obs_orders WHERE series_id = 'ORD.2') o ON x.period >= o.period),
c AS (SELECT f.*, o.value AS ceiling FROM f ASOF JOIN (SELECT * FROM obs_orders WHERE series_id = 'ORD.3') o ON f.period >= o.period)
SELECT period, value, floor, ceiling, value - (floor + ceiling) / 2 AS off_mid,
  CASE WHEN abs(value - (floor + ceiling) / 2) < 0.005 THEN 'on midpoint' WHEN value - (floor + ceiling) / 2 > 0 THEN 'above' ELSE 'below' END AS position FROM c"""), "period"),
)
def corridor_position(spark, sf):
    o = v.obs_orders(spark, sf)
    side = lambda sid: o.filter(F.col("series_id") == sid).select(F.lit("mm").alias("market"), "period", "value")
    return v.iso(asof.corridor_position(side("ORD.1"), side("ORD.2"), side("ORD.3"), ["market"]).drop("market"))


@query(
    "l12_step_daily", "L12",
    v.dated(v.with_ctes("obs_orders", f""", n AS (SELECT *, coalesce(lead(period) OVER (PARTITION BY series_id ORDER BY period) - 1, greatest(DATE '{v.AS_OF}', period)) AS stop FROM obs_orders)
SELECT series_id, CAST(unnest(generate_series(period, stop, INTERVAL 1 DAY)) AS DATE) AS period, value FROM n"""), "period"),
)
def step_daily(spark, sf):
    return v.iso(asof.step_daily(v.obs_orders(spark, sf), F.lit(v.AS_OF)))


@query(
    "m11_recovered_decisions", "M11 G5",
    v.dated(v.with_ctes("obs_orders meetings", EFFECT_SQL.replace("FROM meetings)", "FROM meetings WHERE series_id = 'ORD.1')") + """, l AS (SELECT e.*, o.value AS lend FROM e ASOF LEFT JOIN (SELECT period, value FROM obs_orders WHERE series_id = 'ORD.2') o ON e.look_at >= o.period)
SELECT series_id, date, CASE WHEN rate_after > rate_before THEN 'hike' WHEN rate_after < rate_before THEN 'cut' WHEN rate_after = rate_before THEN 'hold' END AS decision,
  CASE WHEN rate_before IS NOT NULL THEN rate_after END AS deposit_rate, CASE WHEN rate_before IS NOT NULL AND rate_after IS NOT NULL THEN lend END AS lending_rate,
  CAST(CASE WHEN rate_after <> rate_before THEN floor((rate_after - rate_before) * 100 + 0.5) END AS INT) AS basis_points,
  rate_after IS NOT NULL AND rate_before IS NOT NULL AS inferred FROM l"""), "date"),
)
def recovered_decisions(spark, sf):
    o = v.obs_orders(spark, sf)
    m = v.meetings(spark, sf).filter("series_id = 'ORD.1'")
    st = m.select(
        "series_id", "date", F.lit(None).cast("string").alias("decision"),
        F.lit(None).cast("double").alias("deposit_rate"), F.lit(None).cast("double").alias("lending_rate"),
    )
    lending = o.filter("series_id = 'ORD.2'").withColumn("series_id", F.lit("ORD.1"))
    return v.iso(statements.recover_decisions(st, o, lending, ["series_id"]))
