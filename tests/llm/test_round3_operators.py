"""SuperMinHash groups, dual-tree search and mean-variance clustering against brute force on small rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from seriesforge.llm import centroids, dualtree, superminhash

SYLLABLES = "an er th in on re ti es or te ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce".split()


def prose(rng, words):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words))


# ---- centroid clustering

EMBEDDINGS = "vec_id long, embedding array<float>"


def brute_clusters(rows, k=16, rounds=3, width=64, scale=64):
    points = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    hashed = sorted(points, key=lambda p: (p[0] is None, hashlib.sha256(f"1:{p[0]}".encode()).hexdigest(), p[1]))
    cents = [list(v) for _, v in hashed[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))

    for _ in range(rounds):
        groups = {}
        for _, v in points:
            groups.setdefault(near(v)[1], []).append(v)
        for n, vs in groups.items():
            cents[n] = [sum(col) // len(vs) for col in zip(*vs)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in points), key=str), cents


def vectors(rng, n):
    base = [[rng.uniform(-2, 2) for _ in range(64)] for _ in range(9)]
    rows = [(k, [float(np.float32(x + rng.gauss(0, 0.4))) for x in base[k % 9]]) for k in range(n)]
    same = rows[0][1]
    rows += [(1000 + k, same) for k in range(40)]  # ties and a hot vector
    rows += [(1100 + k, [float(k)] * 64) for k in range(12)]  # without deviation
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1])]  # repeated and null ids
    rows += [(2000, None), (2001, []), (2002, same[:63]), (2003, [*same, 1.0]), (2004, [None, *same[1:]]), (2005, [float("nan"), *same[1:]]), (2006, [float("inf"), *same[1:]])]
    return rows


def test_clusters_match_full_search(spark):
    rows = vectors(random.Random(3), 150)
    df = spark.createDataFrame(rows, EMBEDDINGS)
    found, cents = centroids.clustered(df.selectExpr("*", "1 AS cluster", "2L AS distance", "'x' AS vector"))
    want, want_cents = brute_clusters(rows)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want
    assert cents.tolist() == want_cents


def test_few_equal_and_no_vectors(spark):
    rows = vectors(random.Random(4), 3)[:3]
    found, cents = centroids.clustered(spark.createDataFrame(rows, EMBEDDINGS))
    assert sorted(tuple(r) for r in found.collect()) == brute_clusters(rows)[0] and len(cents) == 3
    same = [(k, rows[0][1]) for k in range(30)]
    assert [r[1:] for r in centroids.clustered(spark.createDataFrame(same, EMBEDDINGS))[0].collect()] == [(0, 0)] * 30
    for none in ([], [(1, None), (2, [1.0])]):
        found, cents = centroids.clustered(spark.createDataFrame(none, EMBEDDINGS))
        assert found.collect() == [] and len(cents) == 0


def test_search_rejects_most_centroids():
    rng = np.random.default_rng(5)
    cents = rng.integers(-500, 500, (300, 16))
    x = cents[rng.integers(0, 300, 2000)] + rng.integers(-20, 20, (2000, 16))
    who, d, computed = centroids.Centroids(cents).nearest(x)
    full = ((x[:, None, :] - cents[None]) ** 2).sum(2)
    assert (who == full.argmin(1)).all() and (d == full.min(1)).all()
    assert computed < 0.1 * full.size


def test_extreme_components_fit(spark):
    rows = [(k, [(-1) ** k * 3e38] * 64) for k in range(40)] + [(k, [float(k)] * 64) for k in range(40, 50)]
    found, _ = centroids.clustered(spark.createDataFrame(rows, EMBEDDINGS), k=2)
    assert {r["distance"] >= 0 for r in found.collect()} == {True} and found.count() == 50


# ---- dual-tree search

DOCUMENTS = "doc_id long, text string"
ITEMS = "item_id long, text string"


def terms_of(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute_ranks(docs, items, k=10):
    split = [(i, terms_of(t)) for i, t in docs]
    split = [(i, t) for i, t in split if t]
    whole, total = len(split), sum(len(t) for _, t in split)
    df = Counter(x for _, t in split for x in set(t))
    out = []
    for item, text in items:
        scored = []
        for i, t in split:
            tf = Counter(t)
            m = 100 - 90 + (90 * len(t) * whole) // total
            score = sum(math.floor(1000 * math.log((2 * whole + 2) / (2 * df[x] + 1))) * ((1000000000 * tf[x]) // (1000 * tf[x] + 8 * m)) for x in set(terms_of(text)) if x in tf)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def searched(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, DOCUMENTS).selectExpr("*", "1 AS score", "2 AS n", "'x' AS terms").repartition(3)
    i = spark.createDataFrame(items, ITEMS).selectExpr("*", "3 AS rank", "4L AS doc_id")
    return sorted((tuple(r) for r in dualtree.ranked(d, i, **kw).collect()), key=str)


def test_search_matches_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    docs = [(k, prose(rng, rng.randint(1, 60))) for k in range(400)]
    docs += [(500 + k, docs[3][1]) for k in range(30)]  # ties
    docs += [(7, docs[7][1]), (None, docs[8][1]), (None, docs[3][1]), (900, None), (901, ""), (902, " --- \t"), (903, "é_É ÄÖ x" * 3), (904, prose(rng, 20000))]
    items = [(k, " ".join(rng.sample(docs[k][1].split(), min(6, len(docs[k][1].split()))))) for k in range(40)]
    items += [(3, docs[3][1]), (3, docs[3][1]), (None, "an er"), (50, None), (51, "..."), (52, "nowhere zzzz"), (53, "é Ä"), (54, "an"), (55, docs[-1][1])]
    want = brute_ranks(docs, items)
    assert len(want) > 300
    assert searched(spark, docs, items) == want
    monkeypatch.setattr(dualtree, "BLOCK", 50)
    assert searched(spark, docs, items, group_terms=40) == want


def test_search_of_nothing(spark):
    assert searched(spark, [], [(1, "a b")]) == [] == searched(spark, [(1, "a b")], []) == searched(spark, [(1, None)], [(1, None)])
    assert searched(spark, [(1, "a b")], [(4, "B")]) == brute_ranks([(1, "a b")], [(4, "B")])


def test_node_pairs_are_pruned():
    rng = random.Random(9)
    topics = [prose(rng, 30).split() for _ in range(40)]
    texts = [[rng.choice(topics[k % 40]) for _ in range(40)] for k in range(4000)]
    items = dualtree.Items([(n, n, sorted({w.encode() for w in topics[n]})) for n in range(40)])
    held = [sorted((items.vocabulary[w.encode()], c) for w, c in Counter(t).items()) for t in texts]
    terms, times = np.array([t for h in held for t, _ in h]), np.array([c for h in held for _, c in h])
    sizes = np.array([len(h) for h in held])
    search = dualtree.Search(items, 10, leaf=16, item_leaf=2)
    search.block(np.arange(4000), np.concatenate([[0], np.cumsum(sizes)]), terms, times)
    for n in range(40):
        score = sorted((-sum(c for t, c in h if t in set(items.terms[n])), i) for i, h in enumerate(held))[:10]
        assert list(zip(search.best.held[n][0], search.best.held[n][1])) == [(-s, i) for s, i in score]
    assert search.pairs < 0.5 * 40 * 4000


# ---- SuperMinHash groups


def brute_groups(rows, width=4, similar=80):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if label[a] != label[b] and sets[a] and sets[b] and 100 * min(len(sets[a]), len(sets[b])) >= similar * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= similar * (len(sets[a]) + len(sets[b]) - both):
                    label = [label[a] if x == label[b] else x for x in label]
    low = {}
    for n, (i, _) in zip(label, rows):
        if i is not None:
            low[n] = min(low.get(n, i), i)
    out = [(i, len(s), low.get(n) if s else i) for (i, _), s, n in zip(rows, sets, label)]
    return sorted(((i, n, c, i == c) for i, n, c in out), key=str)


def edited(rng, words, share):
    return " ".join(prose(rng, 1) if rng.random() < share else w for w in words)


@pytest.fixture(scope="module")
def copies():
    """Copies of every likeness about the threshold, chains of copies of copies, a shared passage, and odd rows."""
    rng = random.Random(11)
    rows = [(k, prose(rng, rng.randint(1, 80))) for k in range(60)]
    for group in range(6):
        words = prose(rng, 120).split()
        rows += [(100 + 50 * group + k, edited(rng, words, 0.005 * (k % 13))) for k in range(40)]
    chain = prose(rng, 150).split()
    for k in range(30):
        chain = edited(rng, chain, 0.03).split()
        rows.append((500 + k, " ".join(chain)))
    shared = prose(rng, 60)
    rows += [(600 + k, prose(rng, 50) + " " + shared) for k in range(25)]
    rows += [(700 + k, "the same text in many rows") for k in range(40)] + [(760, "THE same\ttext\nin many  rows ")]
    rows += [(800, None), (801, ""), (802, " \n\t"), (803, "one"), (803, "one"), (804, "One"), (None, "one"), (None, "of no id"), (None, None), (805, "a b c"), (806, "a b c d"), (807, "é ß 漢字 😀 x")]
    long = prose(rng, 20000).split()
    return [*rows, (900, " ".join(long)), (901, edited(rng, long, 0.01))]


@pytest.mark.parametrize("block", [1024, 7])
def test_groups_match_brute_force(spark, copies, monkeypatch, block):
    monkeypatch.setattr(superminhash, "BLOCK", block)
    if block == 7:
        monkeypatch.setattr(superminhash, "BROADCAST_ROWS", 0)
    docs = spark.createDataFrame(copies, DOCUMENTS).selectExpr("*", "1 AS point", "'x' AS signature", "2 AS n", "false AS kept").repartition(5)
    assert sorted((tuple(r) for r in superminhash.grouped(docs).collect()), key=str) == brute_groups(copies)


def test_groups_of_nothing_and_of_one_text(spark):
    assert superminhash.grouped(spark.createDataFrame([], DOCUMENTS)).collect() == []
    for rows in ([(1, None)], [(k, "all rows are this text") for k in range(200)], [(3, "alone here")]):
        assert sorted((tuple(r) for r in superminhash.grouped(spark.createDataFrame(rows, DOCUMENTS)).collect()), key=str) == brute_groups(rows)


def brute_signature(elements, places):
    """The shuffle one element after the other, each to its last rank."""
    out = [1 << 32] * places
    for e in elements:
        order = list(range(places))
        for rank in range(places):
            drawn = int(superminhash.scrambled(np.array([(int(e) + (rank + 1) * int(superminhash.MULTIPLIER)) % 2**64], np.uint64))[0])
            other = rank + ((drawn & 0xFFFFFFFF) * (places - rank) >> 32)
            order[rank], order[other] = order[other], order[rank]
            out[order[rank]] = min(out[order[rank]], rank << superminhash.FRACTION | drawn >> 64 - superminhash.FRACTION)
    return out


def test_early_stopping_changes_nothing(monkeypatch):
    rng = np.random.default_rng(12)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (0, 1, 2, 7, 50, 400)]
    got = superminhash.signatures(sets)
    assert (got[0] == 0xFFFFFFFF).all()
    assert got[1:].tolist() == [brute_signature(s, superminhash.PLACES) for s in sets[1:]]
    monkeypatch.setattr(superminhash, "CHUNK", 60)  # a long text in several pieces
    assert (superminhash.signatures(sets) == got).all()


def test_signatures_vary_less_than_minhash():
    rng = np.random.default_rng(13)
    told = []
    for _ in range(400):
        x = rng.integers(0, 2**63, 60, dtype=np.uint64)
        a, b = superminhash.signatures([np.unique(x[:48]), np.unique(x[12:])])
        told.append((a == b).mean())
    assert abs(np.mean(told) - 0.6) < 0.006
    assert np.std(told) < 0.85 * (0.6 * 0.4 / superminhash.PLACES) ** 0.5
