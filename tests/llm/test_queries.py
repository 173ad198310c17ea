"""Registered queries against their SQL, and the pipeline stage by stage."""

import os
import random
import re
from collections import Counter

import duckdb
import pytest
from check import rows_of

import __spark_entry__
import corpus_pipeline
from seriesforge.llm import jaccard, lines, mixing, queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_its_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    cur = duck.execute(queries.SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_covers_its_table(spark, name):
    df = queries.QUERIES[name](spark, SF)
    source, key = ("pages", "page_id") if name.startswith("op10") else ("documents", "doc_id")
    want = spark.read.parquet(f"{SF}/{source}.parquet").select(key).distinct().count()
    assert df.select(key).distinct().count() == want


def test_everything_is_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert [n for k in range(1, 14) for n in names if n.startswith(f"op{k}_")] == sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))


def test_pipeline_stages_one_by_one(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        ids_before = {r[0] for r in docs.select("doc_id").distinct().collect()}
        if k < 4:
            assert after.columns == columns
            assert {r[0] for r in after.select("doc_id").distinct().collect()} <= ids_before
        if name == "quality_rules":
            assert 0.7 * docs.count() < after.count() < docs.count()
        elif name == "line_dedup":
            assert after.count() == docs.count()
            seen = Counter(line for r in after.select("text").distinct().collect() for line in set(r["text"].split("\n")) if len(line.split()) >= lines.LEAST)
            many = {line for line, n in seen.items() if n >= 4 * lines.DOCUMENTS}
            assert not many
        elif name == "jaccard_join":
            groups = jaccard.joined(docs).collect()
            want = {r["component_id"] for r in groups if r["n_shingles"]} | {r["doc_id"] for r in groups if not r["n_shingles"]}
            assert sorted(r[0] for r in after.select("doc_id").collect()) == sorted(want)
        elif name == "mix_sources":
            took = Counter(r[0] for r in after.select("doc_id").collect())
            want = {r["doc_id"]: r["copies"] for r in mixing.copies(mixing.sized(docs)).collect()}
            assert took == {k: v for k, v in want.items() if v}
        else:
            rows = after.collect()
            assert {r["doc_id"] for r in rows} == ids_before
        docs = after


def near_classes(texts):
    """Text to its class of linked near copies, from every pair's 5-word shingles."""
    sets = []
    for t in texts:
        words = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t))
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and 4 * min(len(sets[a]), len(sets[b])) >= 3 * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 4 * both >= 3 * (len(sets[a]) + len(sets[b]) - both) and label[a] != label[b]:
                    label = [label[a] if x == label[b] else x for x in label]
    return dict(zip(texts, label, strict=True))


def brute_dedup(texts):
    """Text to what is left of it, with classes of near copies counted for every line, place and template."""
    label = near_classes(texts)
    shown = {}
    for t in texts:
        for line in t.split("\n"):
            tokens = tuple("<*>" if re.search("[0-9]", w) else w for w in re.findall(r"[^ \t-\r]+", line))
            if len(tokens) >= 3:
                shown.setdefault(tokens, set()).add(label[t])
    placed, held = {}, {}
    for tokens, classes in shown.items():
        for k, w in enumerate(tokens):
            placed.setdefault((len(tokens), tokens[:3], k, w), []).extend(classes)
    template = {tokens: (tokens[:3], *(w if len(placed[len(tokens), tokens[:3], k, w]) >= 8 else None for k, w in enumerate(tokens))) for tokens in shown}
    for tokens, shape in template.items():
        if 10 * sum(w is not None for w in shape[4:]) >= 6 * len(shape[4:]):
            held.setdefault(shape, set()).update(shown[tokens])

    def gone(line):
        tokens = tuple("<*>" if re.search("[0-9]", w) else w for w in re.findall(r"[^ \t-\r]+", line))
        return len(held.get(template.get(tokens), ())) >= 8

    return {t: "\n".join(line for line in t.split("\n") if not gone(line)) for t in texts}


def test_line_dedup_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    site = "\nSee https://www.example.org/terms-and-conditions-of-use for terms\nWrite to editorial-desk-and-letters@news.example.org now\nAll rights reserved by us"
    rng = random.Random(2)
    planted = [(10**9 + k, " ".join("".join(rng.choices("aeioust", k=5)) for _ in range(60)) + site, "en", "web", 0) for k in range(12)]
    some = docs.filter("doc_id % 4 <> 1").unionByName(spark.createDataFrame(planted, "doc_id long, text string, lang string, source string, n_chars long"))
    for given, got in ((docs, queries.QUERIES["op4_line_dedup"](spark, SF)), (some, corpus_pipeline.line_dedup(spark, some, SF))):
        rows = given.select("doc_id", "text").collect()
        left = brute_dedup(sorted({r["text"] for r in rows if r["text"] is not None}))
        assert any(k != v for k, v in left.items())
        assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter((r["doc_id"], left.get(r["text"])) for r in rows)


def test_jaccard_stage_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    label = near_classes(sorted({t for _, t in rows}))
    first = {}
    for i, t in sorted(rows):
        first.setdefault(label[t], i)
    want = sorted([*(i for k, i in first.items() if any(t.split() for t in label if label[t] == k)), *(i for i, t in rows if not t.split())])
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()) == want
