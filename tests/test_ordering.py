import datetime as dt
import random
import statistics

import pytest
from conftest import rows
from pyspark.sql import functions as F

from seriesforge.operators import ordering


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_positions_are_places_in_the_order(spark, partitions):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rng = random.Random(3)
        data = [(k, rng.choice([None, "a", "b"]), rng.randrange(50)) for k in range(500)]
        df = spark.createDataFrame(data, "id long, name string, n int")
        got = ordering.positions(df, [F.col("name").desc_nulls_last(), F.col("n").asc(), F.col("id").desc()])
        want = sorted(data, key=lambda r: (r[1] is None, -ord(r[1] or "a"), r[2], -r[0]))
        assert [r[:3] for r in sorted((tuple(r) for r in got.collect()), key=lambda r: r[3])] == want
        assert sorted(r["position"] for r in got.select("position").collect()) == list(range(500))
        assert ordering.positions(df.limit(0), [F.col("id").asc()]).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_manifest_orders_and_groups(spark):
    d = dt.date
    m = spark.createDataFrame([("x", d(2020, 1, 1), "A"), ("y", d(2021, 1, 1), "A"), ("z", d(2021, 1, 1), "B"), ("w", None, "C"), ("v", d(2021, 1, 1), "B")], "id string, date date, title string")
    assert [r[0] for r in ordering.newest_first(m).orderBy("position").collect()] == ["v", "z", "y", "x", "w"]
    f = spark.createDataFrame([("b", "/1"), ("a", "/2"), ("a", "/1"), (None, "/9")], "category string, url string")
    assert [tuple(r)[:2] for r in ordering.by_category(f).orderBy("position").collect()] == [(None, "/9"), ("a", "/1"), ("a", "/2"), ("b", "/1")]
    assert rows(ordering.groups_by_size(m, F.col("title"), "title")) == [("A", 2, 0), ("B", 2, 1), ("C", 1, 2)]
    assert [r[0] for r in ordering.newest(m, 2, F.desc("date"), F.asc("id")).collect()] == ["v", "y"]


def test_medians_of_hot_and_small_keys(spark):
    rng = random.Random(8)
    inf = float("inf")
    groups = {
        "hot": [rng.gauss(0, 1) for _ in range(3000)],
        "far": [10.0 ** rng.randint(-300, 300) * rng.choice([1, -1]) for _ in range(801)],
        "same": [5.0] * 700,
        "two": [1.0] * 400 + [2.0] * 400,
        "edge": [1.7e308, -1.7e308] * 300 + [0.0, 3.0],
        "wide": [inf] * 350 + [1.0, 2.0, 3.0] + [-inf] * 349,
        "small": [3.0, 1.0, 2.0, 10.0],
        "one": [4.0],
        "tiny": [k * 5e-324 for k in range(601)],
        None: [float(k) for k in range(1000)],
    }
    data = [(k, v) for k, vs in groups.items() for v in vs] + [("hot", None), ("none", None)]
    df = spark.createDataFrame(data, "key string, value double").repartition(5)
    want = {k: statistics.median(vs) for k, vs in groups.items()} | {"none": None}
    for cuts in (8, 64):
        got = {r["key"]: r["median"] for r in ordering.medians(df, "key", "value", small=100, cuts=cuts).collect()}
        assert got == want
    whole = {r["key"]: r["median"] for r in df.groupBy("key").agg(F.percentile("value", F.lit(0.5)).alias("median")).collect()}
    assert got == whole
    nan = spark.createDataFrame([("n", float("nan"))] * 300 + [("n", float(k)) for k in range(299)], "key string, value double")
    assert str(ordering.medians(nan, "key", "value", small=10).first()["median"]) == "nan"
