import datetime as dt
import itertools
import random
import re
import time
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from seriesforge.functions import text
from seriesforge.operators import events, press, search, statements
from seriesforge.sinks import publish

D = dt.date


def one(spark, expr, t):
    return spark.createDataFrame([(t,)], "t string").select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "t,want",
    [
        ("Net International Reserves reached US$ 56,293. More", 56293.0), ("reserves stood at about US $ 16,564.4 mn at the end", 16564.4),
        ("Reserves fell to USD 33.5 billion after having reached USD 34 billion.", 33500.0), ("Reserves rose by USD 200 mn to reach USD 34 bn.", 34000.0),
        ("Reserves were high", None), ("Gold reserves rose to US$ 5", None),
    ],
)
def test_reserves(spark, t, want):
    assert one(spark, press.reserves(F.col("t")), t) == want


def test_remittances(spark):
    a = "Remittances surged by 31.2% during July/May of FY 2025/2026, to register about USD 43.1 billion (against USD 32)."
    b = "Egyptians abroad sent USD 20.5 billion during the period July/February FY 2023/2024."
    c = "Monthly remittances increased by 5% in August 2024 to about USD 2.6 billion."
    got = one(spark, press.remittances_to_date(F.col("t")), a)
    assert (got["period"], got["value"]) == (D(2026, 5, 31), 43100.0)
    got = one(spark, press.remittances_to_date(F.col("t")), b)
    assert (got["period"], got["value"]) == (D(2024, 2, 29), 20500.0)
    got = one(spark, press.remittances_month(F.col("t")), c)
    assert (got["period"], got["value"]) == (D(2024, 8, 1), 2600.0)
    for text_, month, want in (
        ("Remittances increased by 10 percent to USD 2.5 billion in May 2023.", 5, 2500.0),
        ("Remittances increased to USD 2.5 billion in May 2023, from USD 2.1 billion in May 2022.", 5, 2500.0),
        ("Remittances rose in May 2023 to USD 2.5 billion, from USD 2.1 billion in May 2022.", 5, 2500.0),
        ("With USD 2.5 billion sent home, remittances grew in May 2023.", 5, 2500.0),
    ):
        got = one(spark, press.remittances_month(F.col("t")), text_)
        assert (got["period"], got["value"]) == (D(2023, month, 1), want), text_
    assert one(spark, press.remittances_to_date(F.col("t")), "calendar year 2024: USD 29 billion") is None
    far = "Transfers rose during July/May of FY 2025/2026, " + "as the bank has said in many words before, " * 5 + "to USD 43.1 billion."
    assert one(spark, press.remittances_to_date(F.col("t")), far)["value"] == 43100.0


def test_policy(spark):
    t = (
        "The Committee decided to raise the overnight deposit rate, the overnight lending rate, and the rate of the main operation "
        "by 1,600 basis points to be set at 27.25 percent, 28.25 percent, and 27.75 percent, respectively. The discount rate was also set at 27.75 percent. "
        "It had earlier decided to keep rates."
    )
    p = one(spark, press.policy(F.col("t")), t)
    assert tuple(p) == (27.25, 28.25, 27.75, 27.75, 1600, "hike")
    assert tuple(one(spark, press.policy(F.col("t")), "No news.")) == (None,) * 6


def test_routing(spark):
    rel = spark.createDataFrame(
        [
            ("u1", D(2024, 1, 5), "a", ["International Reserves"], "Reserves reached US$ 35,250."),
            ("u2", D(2024, 1, 6), "b", ["International Reserves", "Remittances"], "nothing here"),
            ("u3", D(2024, 1, 7), "c", ["MPC Press Release"], "decided to keep rates"),
            ("u4", D(2024, 1, 8), "d", ["Remittances"], "Page not found"),
        ],
        "url string, date date, title string, categories array<string>, text string",
    )
    obs, st, miss, dead = press.route_releases(rel)
    assert rows(obs, "series_id", "period", "value") == [("EG.RES.NIR", D(2024, 1, 5), 35250.0)]
    assert rows(st, "date", "decision") == [(D(2024, 1, 7), "hold")]
    assert rows(miss, "kind", "url") == [("NIR", "u2"), ("remittances", "u2")]
    assert rows(dead, "url") == [("u4",)]
    ev = events.statement_events(st)
    assert ev.first()["rates"] == {} and ev.first()["label"] == "c"


A = "The committee met in Cairo and reviewed the outlook in detail. Headline inflation declined to twelve percent in the period. Policy rates were therefore kept unchanged this time."
B = "The committee met in Cairo and reviewed the outlook in detail. Headline inflation accelerated to fifteen percent in the period. Policy rates were therefore kept unchanged this time. Liquidity conditions remain under continuous close review."


def test_sentences_and_breadcrumb(spark):
    assert one(spark, statements.sentences(F.col("t")), A + " Short. (See the annex for further details on the decision.)") == [
        *re.split(r"(?<=\.) ", A), "(See the annex for further details on the decision.)",
    ]
    t = "Home News & Publications News Monetary decision of the day Monetary decision of the day 18 Aug 2026 The body stays."
    assert one(spark, statements.strip_breadcrumb(F.col("t")), t) == "The body stays."
    assert one(spark, statements.strip_breadcrumb(F.col("t")), "The body stays.") == "The body stays."
    long = "Home > " + "Part of the trail > " * 40 + "News & Publications News " + "Title of the day " * 20 + "18 Aug 2026 The body stays."
    assert one(spark, statements.strip_breadcrumb(F.col("t")), long) == "The body stays."
    late = "A first sentence. It speaks of News & Publications News only here."
    assert one(spark, statements.strip_breadcrumb(F.col("t")), late) == late


def align(spark, *texts):
    return spark.range(1).select(statements.aligned(*[F.array(*[F.lit(c) for c in x]).cast("array<string>") for x in texts]).alias("d")).first()["d"]


@pytest.mark.parametrize(
    "a,b,want",
    [
        ("ABC", "ABC", ("", "", [])), ("ABC", "AXC", ("", "", [("B", "X")])), ("ABC", "ABXC", ("X", "", [])), ("ABXC", "ABC", ("", "X", [])),
        ("ABCDE", "BCDEA", ("A", "A", [])), ("EABCD", "ABCDE", ("E", "E", [])), ("ABC", "CBA", ("BA", "AB", [])),
        ("AABC", "ABBC", ("", "", [("A", "B")])), ("", "AB", ("AB", "", [])), ("AB", "", ("", "AB", [])), ("", "", ("", "", [])),
        # X is found twice in each text, but once between the anchors M and N
        ("XMPXN", "XMXQN", ("Q", "P", [])), ("AAAA", "AAA", ("", "A", [])),
    ],
)
def test_alignment_by_anchors(spark, a, b, want):
    got = align(spark, a, b)
    assert ("".join(got["added"]), "".join(got["removed"]), [tuple(p) for p in got["changed"]]) == want


def test_longest_chain_is_longest_and_latest():
    rng = random.Random(6)
    for _ in range(300):
        p = rng.sample(range(12), rng.randint(0, 8))
        chains = [c for n in range(len(p) + 1) for c in itertools.combinations(range(len(p)), n) if all(p[x] < p[y] for x, y in zip(c, c[1:]))]
        longest = max(map(len, chains))
        got = statements.longest_chain(p)
        assert tuple(got) in chains and len(got) == longest
        assert got == list(max((c for c in chains if len(c) == longest), key=lambda c: c[::-1]))


def test_alignment_of_long_texts_stays_fast(spark):
    rng = random.Random(7)
    a = [rng.getrandbits(62) for _ in range(60_000)]
    moved = a[1:30_000] + a[30_500:] + a[:1] + a[30_000:30_500]
    start = time.time()
    pairs = statements.anchor_pairs(a, moved)
    assert time.time() - start < 5
    assert len(pairs) == 60_000 - 501


def test_statement_diffs(spark):
    st = spark.createDataFrame(
        [("x", D(2024, 1, 1), A, 20.0, 21.0, None), ("x", D(2024, 2, 1), B, 20.5, None, None), ("x", D(2024, 3, 1), B, 21.25, 22.0, 1.0)],
        "archive string, date date, text string, deposit_rate double, lending_rate double, main_operation_rate double",
    )
    d = {r["to_date"]: r for r in statements.statement_diffs(st).collect()}
    one_ = d[D(2024, 2, 1)]
    assert one_["from_date"] == D(2024, 1, 1)
    a, b = (set(re.findall(r"\w+", t.lower())) for t in (A, B))
    assert one_["similarity"] == 2 * len(a & b) / (len(a) + len(b))
    assert [c["after"] for c in one_["changed"]] == ["Headline inflation accelerated to fifteen percent in the period."]
    assert one_["added"] == ["Liquidity conditions remain under continuous close review."] and one_["removed"] == []
    assert {k: v["change"] for k, v in one_["rate_move"].items()} == {"deposit_rate": 0.5}
    assert d[D(2024, 3, 1)]["similarity"] == 1.0
    slim = statements.slim_diffs(statements.statement_diffs(st)).filter("to_date = '2024-02-01'").first()
    assert (slim["added"], slim["removed"], slim["changed"]) == (1, 0, 1)
    assert slim["wording_changed_pct"] == int((1 - one_["similarity"]) * 100 + 0.5)
    tot = statements.diff_totals(statements.statement_diffs(st)).first()
    assert tot["pairs"] == 2 and tot["most_changed"]["to_date"] == D(2024, 2, 1) and tot["pairs_with_rates"] == 2


def test_recovered_decisions(spark):
    st = spark.createDataFrame(
        [("x", D(2024, 2, 1), None, None, None), ("x", D(2024, 3, 6), "hike", 27.25, None), ("x", D(2013, 1, 1), "cut", 9.0, None), ("x", D(2013, 2, 1), "cut", 8.5, None)],
        "series_id string, date date, decision string, deposit_rate double, lending_rate double",
    )
    dep = spark.createDataFrame([("x", D(2023, 8, 1), 19.25), ("x", D(2024, 2, 4), 21.25), ("x", D(2024, 3, 6), 27.25)], "series_id string, period date, value double")
    lend = spark.createDataFrame([("x", D(2023, 8, 1), 20.25), ("x", D(2024, 2, 4), 22.25)], "series_id string, period date, value double")
    got = {r["date"]: r for r in statements.recover_decisions(st, dep, lend, ["series_id"]).collect()}
    feb = got[D(2024, 2, 1)]
    assert (feb["decision"], feb["deposit_rate"], feb["lending_rate"], feb["basis_points"], feb["inferred"]) == ("hike", 21.25, 22.25, 200, True)
    assert got[D(2024, 3, 6)]["basis_points"] == 600
    old = got[D(2013, 2, 1)]
    assert (old["decision"], old["basis_points"], old["inferred"]) == ("cut", -50, False)


def pages(spark):
    return spark.createDataFrame(
        [(1, 1, "Reserve ratio up. reserve RESERVE"), (1, 2, "nothing of note"), (2, 1, "the ratio of reserve requirement 2024"), (3, 1, "إجمالى الودائع"), (3, 2, "bank bank"), (4, 1, "bank"), (5, 1, "bank note"), (6, 1, "ratio")],
        "doc_id int, page int, text string",
    )


def test_index_and_full_text_match_a_scan(spark):
    p = pages(spark)
    folded = text.search_form(F.col("text"))
    idx = search.index_postings(p, folded, fraction=0.4)
    assert not idx.filter("term in ('the', '2024')").count()
    for q in ("reserve ratio", "الودائع إجمالي", "BANK", "non-ratio reserve", "the ratio"):
        terms, _ = search.query_terms(q)
        want = []
        for r in p.collect():
            words = re.findall(text.TOKEN, text.fold_text(r["text"]))
            if all(t in words for t in terms):
                want.append((r["doc_id"], r["page"], sum(words.count(t) for t in terms)))
        assert rows(search.full_text(idx, q), "doc_id", "page", "score") == sorted(want, key=str)
    tight = search.index_postings(p, folded, fraction=0.3)
    assert tight.filter("term = 'bank'").count() == 0
    common = search.term_table(search.term_counts(p, folded), p, 0.3).filter("common")
    assert rows(search.full_text(tight, "bank note", common), "doc_id", "page") == [(1, 2), (5, 1)]
    capped = search.index_postings(p, folded, fraction=0.9, cap=2)
    assert rows(capped.filter("term = 'reserve'"), "doc_id", "page", "tf") == [(1, 1, 3), (2, 1, 1)]
    assert capped.filter("term = 'bank'").count() == 2 and rows(capped.filter("term = 'bank'"), "tf")[1] == (2,)


def test_snippets(spark):
    body = "x" * 300 + " reserve text " + "y" * 300 + " the إجمالى reserve ratio requirement " + "z" * 300
    p = spark.createDataFrame([(1, 1, body)], "doc_id int, page int, text string")
    hits = spark.createDataFrame([(1, 1, 3)], "doc_id int, page int, score int")
    s = search.snippets(hits, p, "reserve ratio اجمالي").first()["snippet"]
    assert [x["text"] for x in s if x["mark"]] == ["إجمالى", "reserve", "ratio"]
    assert s[0]["text"] == "…" and s[-1]["text"] == "…"
    assert "".join(x["text"] for x in s[1:-1]) in body and sum(len(x["text"]) for x in s[1:-1]) == search.SNIPPET_WIDTH
    none = search.snippets(hits, p, "absent").first()["snippet"]
    assert [x["mark"] for x in none] == [False, False] and none[1]["text"] == "…"
    a = search.best_anchor(hits, p, "reserve ratio اجمالي").first()
    assert a["terms_in_window"] == 3 and a["anchor"] == text.fold_text(body).index("اجمالي")


def test_ranked_and_title_search(spark):
    pool = spark.createDataFrame(
        [("Series", "Inflation", "inflation"), ("Series", "Core", "core inflation"), ("Topic", "Prices", "disinflation"), ("Page", "None", "nothing")],
        "kind string, label string, hay string",
    )
    got = [(r["label"], round(r["score"], 3)) for r in search.ranked_search(pool, "Inflation", 10).collect()]
    assert got == [("Inflation", 98.5), ("Prices", 62.0), ("Core", 57.667)]
    docs = spark.createDataFrame([(1, "Économie  Review", ["A b"]), (2, None, ["review"])], "id int, title string, categories array<string>")
    assert rows(search.title_search(docs, "review a"), "id") == [(1,)]
    assert rows(search.collections(docs, [("review", "R")]), "category", "name", "documents") == [("review", "R", 1)]


def test_blocks_give_the_pages_of_a_full_scan_and_stay_closed(spark, tmp_path):
    rng = random.Random(5)
    words = [f"w{k}x" for k in range(30)]
    rows_ = []
    for doc in range(400):
        heavy = 30 if doc % 40 == 0 else 1  # a few documents say the words often
        rows_ += [(doc, p, " ".join(rng.choices(words, k=40) + ["alpha", "beta"] * rng.randint(1, heavy))) for p in (1, 2)]
    pages = spark.createDataFrame(rows_, "doc_id long, page int, text string")
    postings = search.index_postings(pages, text.search_form(F.col("text")))
    blocks = publish.write_posting_blocks(postings, str(tmp_path / "blocks"), 400, per_stretch=4)
    assert blocks.agg(F.max("n")).first()[0] <= 60
    for q, k in (("alpha beta", 5), ("beta w3x", 10), ("alpha", 1), ("alpha nowhere", 5), ("", 5), ("w1x w2x w3x", 5000)):
        found = search.top_pages(blocks, q, k, probes=4)
        want = search.full_text(postings, q, limit=k)
        assert [tuple(r) for r in found.pages.collect()] == [tuple(r) for r in want.select("doc_id", "page", "score").collect()]
    found = search.top_pages(blocks, "alpha beta", 5, probes=4)
    assert 0 < found.read < 0.3 * found.named
    plan = found.pages._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "In(term, [alpha,beta])" in plan


def test_pages_are_counted_inside_their_rows(spark, tmp_path):
    """A page may come in several rows, of any key; texts are shuffled by page, tokens are not, and blocks need no sample of their keys."""
    said = [
        (1, 1, "Bank bank 2024 a2024 ٢٠٢٤ ۱۲ x"), (1, 1, "bank إجمالى"), (2, 1, None), (2, 2, ""), (2, 3, "the a 12"), (None, 1, "note note"), (None, 1, "note"),
        (3, None, "ﬁne ﬁne fine"), (4, 1, "é" * 28 + " " + "z" * 28 + " " + "z" * 29), (5, 1, "İSTANBUL ratio\u2003Ratio"), (5, 2, "إِجمالى اجمالي أجمالى"),
    ]
    p = spark.createDataFrame(said, "doc_id long, page int, text string")
    want = Counter()
    for doc, page, t in said:
        for w in re.findall(text.TOKEN, text.fold_text(t or "")):
            if 2 <= len(w) <= 28 and w not in text.stop_words() and not w.isdecimal():
                want[w, doc, page] += 1
    counted = search.term_counts(p, text.search_form(F.col("text")))
    assert Counter({(r["term"], r["doc_id"], r["page"]): r["tf"] for r in counted.collect()}) == want and counted.count() == len(want)
    assert rows(search.term_counts(p, text.search_form(F.col("text")), tf_cap=2).filter("term = 'note'"), "tf") == [(2,)]
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" in plan
    assert plan.split("Initial Plan")[0].count("hashpartitioning(term") == 1  # of pages in several rows alone
    blocks = search.posting_blocks(search.index_postings(p, text.search_form(F.col("text"))), 4)
    grouped = blocks._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [term" in grouped and "Aggregate [shard" not in grouped


def test_trigrams_find_what_a_scan_finds(spark, tmp_path):
    rng = random.Random(6)
    texts = ["".join(rng.choices("abc ", k=rng.randint(0, 40))) for _ in range(300)] + ["بنك مصر المركزى", "", None, "ab"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, hay string")
    stored, pieces = publish.write_trigrams(docs, "id", str(tmp_path / "t"))
    for q in ("abc", "abca", "bca abb", "cab ab", "ab", "", "مصر", "abcabcabcabc", "zzz"):
        want = docs.filter(search.all_terms(F.col("hay"), q))
        got = search.indexed_substrings(stored, pieces, q, "id")
        assert rows(got, "id") == rows(want, "id"), q
    assert search.substring_candidates(pieces, "abcab", "id").count() < 150


def test_page_blocks_are_those_of_the_postings_with_one_shuffle(spark, tmp_path):
    words = ["rate", "note", "bank", "gold", "oil"]
    told = [(i % 40, i % 3, " ".join(words[j % 5] for j in range(i % 7 + 1))) for i in range(300)] + [(None, 1, "gold"), (None, 1, "gold oil"), (41, 0, ""), (42, 0, None)]
    p = spark.createDataFrame(told, "doc_id long, page int, text string")
    folded = text.search_form(F.col("text"))
    got = search.page_blocks(p, folded, 8, 4)
    want = search.posting_blocks(search.index_postings(p, folded), 8)
    assert got.columns == want.columns and rows(got) == rows(want)
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(stretch" in plan
    stored = publish.write_page_blocks(p, folded, str(tmp_path / "blocks"), 43, per_stretch=6)
    assert rows(stored.select(*want.columns)) == rows(want)
