import datetime as dt
import hashlib
import json
import random

from conftest import rows
from pyspark.sql import functions as F

from seriesforge.operators import merge, summary
from seriesforge.sinks import publish
from seriesforge.sources import landed
from seriesforge.streaming import landing

D = dt.date


def obs(spark):
    return spark.createDataFrame(
        [(s, D(2020, 1, 1) + dt.timedelta(days=i), float(i)) for s in ("EG.FX.USD", "EG.TB.3M", "NEW") for i in range(60)],
        "series_id string, period date, value double",
    )


def test_series_round_trip_and_pruning(spark, tmp_path):
    path = str(tmp_path / "series")
    publish.write_series(obs(spark), path, files=4)
    assert rows(spark.read.parquet(path).select("series_id", "period", "value")) == rows(obs(spark))
    one = landed.published_series(spark, path, "EG.TB.3M")
    assert one.count() == 60
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_family" in plan and "EqualTo(series_id,EG.TB.3M)" in plan
    publish.write_series_csv(obs(spark), str(tmp_path / "csv"))
    assert landed.series_csv(spark, str(tmp_path / "csv")).count() == 180
    assert rows(publish.family_counts(obs(spark)), "part_family", "rows") == [("fx", 60), ("govt", 60), ("other", 60)]


def test_records_catalog_and_anomalies(spark, tmp_path):
    rec = spark.createDataFrame([("91", "1,000")], "`Tenor (days)` string, `Accepted amount` string")
    publish.write_records(rec, str(tmp_path / "records"), "bills")
    back = spark.read.parquet(str(tmp_path / "records"))
    assert set(back.columns) == {"Tenor (days)", "Accepted amount", "dataset"}
    publish.write_catalog(rec, str(tmp_path / "cat"))
    publish.write_anomalies(rec, str(tmp_path / "anom"))
    assert spark.read.parquet(str(tmp_path / "cat")).count() == spark.read.parquet(str(tmp_path / "anom")).count() == 1


def test_series_and_index_json(spark, tmp_path):
    cat = spark.createDataFrame([("NEW", "Title", None)], "series_id string, title_en string, unit string")
    docs = publish.series_json(obs(spark).filter("period < '2020-01-03'"), cat, "cited")
    new = json.loads(docs.filter("series_id = 'NEW'").first()["json"])
    assert new["observations"] == [["2020-01-01", 0.0], ["2020-01-02", 1.0]] and new["count"] == 2 and new["title_en"] == "Title"
    publish.write_series_json(docs, str(tmp_path / "api"))
    assert spark.read.text(str(tmp_path / "api")).count() == 3
    index = publish.index_json(publish.catalog_index(summary.summarise(obs(spark), cat)))
    entry = json.loads(index.filter("series_id = 'NEW'").first()["json"])
    assert entry["latest_value"] == 59.0 and "unit" not in entry and entry["highest"]["value"] == 59.0
    lines = publish.coverage_rows(summary.summarise(obs(spark), cat))
    publish.write_report(lines, str(tmp_path / "report"))
    assert spark.read.text(str(tmp_path / "report")).filter("value like '**3 series, 180 obs%'").count() == 1
    sp = publish.sparklines(obs(spark)).filter("series_id = 'NEW'").first()["values"]
    assert len(sp) == 49 and sp[-1] == 59.0


def test_manifest(spark, tmp_path):
    root = tmp_path / "dist"
    (root / "sub").mkdir(parents=True)
    (root / "sub" / "a.txt").write_text("hello")
    m = publish.integrity_manifest(spark, str(root))
    assert rows(m, "path", "bytes") == [("sub/a.txt", 5)]
    old = spark.createDataFrame([("gone.txt", 1, "x")], "path string, bytes bigint, sha256 string")
    assert rows(publish.manifest_changes(old, m)) == [("gone.txt", "vanished"), ("sub/a.txt", "new")]
    assert rows(publish.refresh_manifest(old, m), "path") == [("sub/a.txt",)]


def test_search_index_and_pages(spark, tmp_path):
    from seriesforge.functions import text
    from seriesforge.operators import search

    p = spark.createDataFrame([(1, 1, "alpha beta"), (1, 2, "  "), (2, 1, "beta " * 6000)], "doc_id int, page int, text string")
    assert rows(publish.published_pages(p), "doc_id", "page", "truncated") == [(1, 1, False), (2, 1, False)]
    assert rows(publish.published_pages(p, limit=20_000), "doc_id", "page", "truncated") == [(1, 1, False), (2, 1, True)]
    path = str(tmp_path / "search")
    publish.build_search_index(p, text.search_form(F.col("text")), path, p.select("doc_id").distinct(), fraction=1.0)
    stored = spark.read.parquet(path + "/postings")
    hits = search.full_text(stored, "beta")
    assert rows(hits) == [(1, 1, 1), (2, 1, 6000)]
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan and "PushedFilters: [IsNotNull(term), EqualTo(term,beta)]" in plan
    assert spark.read.json(path + "/meta").first()["documents"] == 2


def test_changed_only_landing(spark, tmp_path):
    path = str(tmp_path / "raw")
    first = spark.createDataFrame([("a", "1", 1), ("b", "1", 1)], "key string, body string, seen int")
    hashed = lambda df: df.select("key", F.sha2(F.col("body").cast("binary"), 256).alias("content_hash"), "seen")
    publish.write_landed(hashed(first), path)
    again = spark.createDataFrame([("a", "1", 2), ("b", "2", 2), ("c", "1", 2)], "key string, body string, seen int")
    changed = merge.changed_only(again, spark.read.parquet(path), "key", "body", "seen")
    assert rows(changed, "key") == [("b",), ("c",)]


LANDED = "key string, content string, seen int"


def landing_of(path, **kw):
    def to_obs(raw):
        parts = F.split("content", ",")
        return raw.select(parts[0].alias("series_id"), parts[1].cast("date").alias("period"), parts[2].cast("double").alias("value"), F.col("key").alias("ord"))

    return landing.Landing(path, to_obs, parts=4, **kw)


def content(*readings):
    return [(k, f"{s},{d},{v}", n) for k, s, d, v, n in readings]


def test_landing_streams_restarts_and_revises(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    land_ = landing_of(out)
    d = D(2020, 1, 1)

    def land(*rows_):
        spark.createDataFrame(list(rows_), LANDED).coalesce(1).write.mode("append").parquet(src)

    def run():
        q = land_.start(landing.landed_stream(spark, src, spark.createDataFrame([], LANDED).schema), ck)
        q.awaitTermination(120)
        assert q.exception() is None

    land(*content(("k1", "A", d, 1.0, 1), ("k2", "A", d, 2.0, 1), ("k3", "B", d, 5.0, 1)), (None, "A,2020-01-01,7", 1))
    run()
    assert rows(land_.current(spark)) == [("A", d, 1.0), ("B", d, 5.0)]
    run()  # nothing new: nothing changes
    land(*content(("k1", "A", d, 1.0, 2), ("k1", "A", d, 9.0, 2), ("k3", "B", d, 5.0, 2)))
    run()
    assert rows(land_.current(spark)) == [("A", d, 9.0), ("B", d, 5.0)]
    assert rows(land_.revisions(spark)) == [("A", d, 1.0, 9.0, 1)]
    assert rows(spark.read.parquet(out + "/anomalies"), "series_id", "kept", "discarded") == [("A", 1.0, 2.0)]
    assert rows(land_.summaries(spark), "series_id", "n", "last") == [("A", 1, 9.0), ("B", 1, 5.0)]
    # only series A was summarised again
    assert [r[0] for r in spark.read.parquet(out + "/summaries/batch=000000001").select("series_id").collect()] == ["A"]


def test_landing_equals_one_batch_whatever_its_cuts(spark, tmp_path):
    rng = random.Random(4)
    landed_rows, latest = [], {}
    for n in range(9):
        batch = [(f"k{rng.randrange(30):02d}", f"S{rng.randrange(4)},2021-01-{rng.randrange(1, 9):02d},{rng.randrange(6)}", n) for _ in range(25)]
        landed_rows.append(batch)
    plain = landing_of(str(tmp_path / "plain"))
    snaps = landing_of(str(tmp_path / "snaps"), compact_after=3)
    seen = {}
    for n, batch in enumerate(landed_rows):
        df = spark.createDataFrame(batch, LANDED)
        plain.land(df, n)
        snaps.land(df, n)
        if n in (3, 6):
            snaps.land(df, n)  # a repeat after a failure
        new = sorted({(k, c) for k, c, _ in batch if seen.get(k) != c})
        first = {}
        for k, c in new:
            s, p, v = c.split(",")
            first.setdefault((s, p), {}).setdefault(k, []).append(float(v))
        latest.update({at: min(prints.items())[1] for at, prints in first.items()})
        for k in {k for k, _ in new}:  # of equal `seen` the larger hash stands
            seen[k] = max((hashlib.sha256(c.encode()).hexdigest(), c) for k2, c in new if k2 == k)[1]
    got = {(s, str(p)): v for s, p, v in rows(plain.current(spark))}
    assert got.keys() == latest.keys() and all(v in latest[k] for k, v in got.items())
    assert rows(snaps.current(spark)) == rows(plain.current(spark))
    columns = ["series_id", "n", "last", "record_high"] if "record_high" in plain.summaries(spark).columns else ["series_id", "n", "last"]
    whole = summary.summarise(plain.current(spark))
    for one in (plain, snaps):
        assert rows(one.summaries(spark), *columns) == rows(whole, *columns)
    assert landing.complete_versions(spark, str(tmp_path / "snaps/snapshot/values"), "upto") == [2, 5, 8]


def test_landing_reads_only_the_parts_it_touches(spark, tmp_path):
    land_ = landing_of(str(tmp_path / "one"))
    land_.land(spark.createDataFrame(content(*((f"k{n}", f"S{n}", D(2020, 1, 1), 1.0, 1) for n in range(40))), LANDED), 0)
    state = land_.state(spark, "values", ["series_id", "period"], land_.value_schema, parts=[2])
    assert 0 < state.count() < 40
    assert "PartitionFilters: [" in (plan := state._jdf.queryExecution().executedPlan().toString()) and "(part" in plan
    land_.land(spark.createDataFrame([], LANDED), 1)
    assert land_.current(spark).count() == 40
