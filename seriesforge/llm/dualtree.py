"""Ranked lexical search by dual trees.

Documents and items are sparse vectors over the items' terms: a document's coordinate is the
impact of a term in it, an item's is 1 for each of its terms, so a score is their inner product.
Each task reads its documents in blocks and builds a tree over a block: a node is divided at the
coordinate that varies most among its documents, and holds for every coordinate the maximum below
it. The items have a tree of the same kind. For a pair of nodes the sum of the document node's
maxima over the terms of the item node bounds every score of the pair. If it is below the weakest
kth score of the item node's items, the whole batch of pairs is dropped; otherwise the larger node
is opened, best bound first. Leaves are scored in 64-bit integers. Only what is strictly weaker is
dropped, so the result is exact, equal scores included. The kth scores live through all blocks of
a task; tasks return k documents an item, which Spark merges.

Items are taken in groups of at most `GROUP_TERMS` different terms, so what tasks get with their
code is bounded; documents are read once for each group, 1 pass for a benchmark of usual size.

Defined results: null and term-free texts are no documents and match nothing; an item without
terms, or with no document above 0, has no rows; repeated item rows are ranked each on their own;
repeated document rows are separate documents; documents with null doc_id rank after the others of
the same score; empty tables give empty results; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import in_batches, table, utf8, written
from seriesforge.operators.spread import top_per_group

TOP = 10
LEAF = 128  # documents of a leaf
ITEM_LEAF = 8
BLOCK = 4096  # documents of a tree, at most
BLOCK_POSTINGS = 500_000  # of a tree, about
GROUP_TERMS = 20_000  # different terms of the items that are searched together
NULL_ID = np.iinfo(np.int64).max
#: ASCII letters and digits and all bytes of other characters belong to terms; only A-Z is lower-cased.
FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Items:
    """A group of items as lists of term numbers."""

    def __init__(self, rows: list[tuple[int, int | None, list[bytes]]]):
        self.number = [r[0] for r in rows]
        self.ids = [r[1] for r in rows]
        self.vocabulary = {t: k for k, t in enumerate(sorted({t for r in rows for t in r[2]}))}
        self.terms = [np.array(sorted(self.vocabulary[t] for t in r[2]), np.int64) for r in rows]


def item_groups(items: DataFrame, group_terms: int) -> Iterator[Items]:
    """The items in groups; their texts are read one by one, so the driver holds the terms of one group."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), utf8("text").alias("text")).orderBy("item_id", "text")
    now, seen = [], set()
    for n, (item_id, text) in enumerate(rows.toLocalIterator()):
        terms = set(terms_of(bytes(text)))
        if now and len(seen | terms) > group_terms:
            yield Items(now)
            now, seen = [], set()
        if terms:
            now.append((n, item_id, sorted(terms)))
            seen |= terms
    if now:
        yield Items(now)


def vectors(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, n, terms, times): each document's number of terms, and the item terms in it."""
    vocabulary = items.vocabulary

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"], b["text"]):
                words = terms_of(text)
                if words:
                    held = sorted((vocabulary[t], c) for t, c in Counter(words).items() if t in vocabulary)
                    rows.append((doc_id, len(words), np.array([k for k, _ in held], "<i4").tobytes(), np.array([c for _, c in held], "<i8").tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "terms", "times"]).astype({"doc_id": "Int64"})

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    return in_batches(narrow).mapInPandas(run, "doc_id long, n long, terms binary, times binary")


def document_counts(found: DataFrame, size: int) -> np.ndarray:
    """For each term the number of documents that hold it; counted in tasks, summed in Spark."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(size, np.int64)
        for b in batches:
            held = np.frombuffer(b"".join(b["terms"]), "<i4")
            counts += np.bincount(held, minlength=size)
        here = np.flatnonzero(counts)
        yield pd.DataFrame({"term": here, "documents": counts[here]})

    out = np.zeros(size, np.int64)
    for term, documents in found.select("terms").mapInPandas(run, "term int, documents long").groupBy("term").agg(F.sum("documents")).collect():
        out[term] = documents  # at most `GROUP_TERMS` rows
    return out


class Tree:
    """A binary tree over sparse rows; `top` holds each node's maxima, `low` its first child (-1 at a leaf), `rows` a node's rows, `leaves` what a leaf is scored from."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, values: np.ndarray, size: int, leaf: int):
        self.starts, self.terms, self.values, self.size = starts, terms, values, size
        self.low: list[int] = []
        self.rows: list[np.ndarray] = []
        self.leaves: dict[int, tuple[np.ndarray, ...]] = {}
        todo = [np.arange(len(starts) - 1)]
        while len(self.rows) < len(todo):
            rows = todo[len(self.rows)]
            halves = self.halves(rows) if len(rows) > leaf else None
            self.rows.append(rows)
            self.low.append(-1 if halves is None else len(todo))
            if halves is not None:
                todo += halves
        self.top: list[np.ndarray | None] = [None] * len(todo)
        for node in range(len(todo) - 1, -1, -1):
            if self.low[node] < 0:
                rows = self.rows[node]
                at = self.entries(rows)
                top = np.zeros(size, np.int64)
                np.maximum.at(top, terms[at], values[at])
                self.top[node] = top
                self.leaves[node] = rows, np.concatenate([[0], np.cumsum(starts[rows + 1] - starts[rows])]), terms[at], values[at]
            else:
                self.top[node] = np.maximum(self.top[self.low[node]], self.top[self.low[node] + 1])

    def entries(self, rows: np.ndarray) -> np.ndarray:
        """Places of the entries of these rows."""
        lengths = self.starts[rows + 1] - self.starts[rows]
        ends = np.cumsum(lengths)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[rows] - ends + lengths, lengths)

    def halves(self, rows: np.ndarray) -> list[np.ndarray]:
        """Rows with much and rows with little of the coordinate that varies most among them."""
        at = self.entries(rows)
        t, v = self.terms[at], self.values[at].astype(float)
        total = np.bincount(t, v, self.size)
        vary = np.bincount(t, v * v, self.size) - total**2 / len(rows)
        owner = np.repeat(np.arange(len(rows)), self.starts[rows + 1] - self.starts[rows])
        term = int(vary.argmax()) if len(t) else 0
        value = np.zeros(len(rows))
        value[owner[t == term]] = v[t == term]
        much = value > value.mean()
        if not much.any() or much.all():
            much = np.arange(len(rows)) < len(rows) // 2
        return [rows[much], rows[~much]]


class Best:
    """The k best documents of each item so far; `kth` is the score that a further one must reach."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.held = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(items)]
        self.kth = np.ones(items, np.int64)

    def offer(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.kth[item]
        if good.any():
            scores, ids = np.concatenate([self.held[item][0], scores[good]]), np.concatenate([self.held[item][1], ids[good]])
            first = np.lexsort((ids, -scores))[: self.k]
            self.held[item] = scores[first], ids[first]
            if len(first) == self.k:
                self.kth[item] = max(1, scores[first[-1]])


class Search:
    """One task's search: an item tree that stays, and a document tree for each block."""

    def __init__(self, items: Items, k: int, leaf: int = LEAF, item_leaf: int = ITEM_LEAF, weights: np.ndarray | None = None):
        self.items, self.leaf, self.size = items, leaf, len(items.vocabulary)
        starts = np.concatenate([[0], np.cumsum([len(t) for t in items.terms])])
        terms = np.concatenate([*items.terms, np.zeros(0, np.int64)])
        self.tree = Tree(starts, terms, weights[terms] if weights is not None else np.ones(len(terms), np.int64), self.size, item_leaf)
        self.has = np.zeros((len(items.terms), self.size), bool)
        self.has[np.repeat(np.arange(len(items.terms)), np.diff(starts)), terms] = True
        self.united = [np.unique(terms[self.tree.entries(rows)]) for rows in self.tree.rows]
        self.best = Best(len(items.terms), k)
        self.pairs = 0  # scored one by one

    def block(self, ids: np.ndarray, starts: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> None:
        docs = Tree(starts, terms, impacts, self.size, self.leaf)
        todo = [(-int(docs.top[0][self.united[0]].sum()), 0, 0)]
        while todo:
            bound, q, d = heapq.heappop(todo)
            weakest = int(self.best.kth[self.tree.rows[q]].min())
            if -bound < weakest:
                continue
            q_low, d_low = self.tree.low[q], docs.low[d]
            if q_low < 0 and d_low < 0:
                self.finish(q, d, docs, ids)
                continue
            open_items = d_low < 0 or q_low >= 0 and len(self.tree.rows[q]) * self.leaf > len(docs.rows[d])
            for a, b in ((q_low, d), (q_low + 1, d)) if open_items else ((q, d_low), (q, d_low + 1)):
                bound = int(docs.top[b][self.united[a]].sum())
                if bound >= int(self.best.kth[self.tree.rows[a]].min()):
                    heapq.heappush(todo, (-bound, a, b))

    def finish(self, q: int, d: int, docs: Tree, ids: np.ndarray) -> None:
        """Scores of the items and documents of two leaves."""
        top, asked = docs.top[d], self.tree.rows[q]
        asked = asked[self.has[asked] @ top >= self.best.kth[asked]]
        if not len(asked):
            return
        rows, starts, terms, values = docs.leaves[d]
        along = np.zeros((len(asked), len(terms) + 1), np.int64)
        np.cumsum(self.has[np.ix_(asked, terms)] * values, axis=1, out=along[:, 1:])
        scores = along[:, starts[1:]] - along[:, starts[:-1]]
        self.pairs += scores.size
        for i, s in zip(asked, scores):
            self.best.offer(i, s, ids[rows])


def impacts(n: np.ndarray, terms: np.ndarray, times: np.ndarray, owner: np.ndarray, weights: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What each term adds to the score of its document, in whole numbers."""
    m = np.array([100 - 90 + (90 * int(x) * documents) // total for x in n], np.int64)  # as Python numbers, which do not overflow
    return weights[terms] * ((1_000_000_000 * times) // (1000 * times + 8 * m[owner]))


def ranked_group(docs: DataFrame, items: Items, k: int) -> DataFrame:
    """(item, doc_id, score): each task's k best documents of each item."""
    found = written(vectors(docs, items), "vectors")
    documents, total = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    counts = document_counts(found, len(items.vocabulary))
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in counts], np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        search = Search(items, k, weights=weights)
        held: list[pd.DataFrame] = []
        rows = postings = 0

        def flush():
            b = pd.concat(held)
            sizes = b["terms"].map(len).to_numpy() // 4
            terms = np.frombuffer(b"".join(b["terms"]), "<i4").astype(np.int64)
            times = np.frombuffer(b"".join(b["times"]), "<i8")
            owner = np.repeat(np.arange(len(b)), sizes)
            value = impacts(b["n"].to_numpy(np.int64), terms, times, owner, weights, documents, total)
            ids = b["doc_id"].astype("Int64").fillna(NULL_ID).to_numpy(np.int64)
            search.block(ids, np.concatenate([[0], np.cumsum(sizes)]), terms, value)

        for b in batches:
            held.append(b)
            rows += len(b)
            postings += int(b["terms"].map(len).sum()) // 4
            if rows >= BLOCK or postings >= BLOCK_POSTINGS:
                flush()
                held, rows, postings = [], 0, 0
        if rows:
            flush()
        out = [(items.number[i], items.ids[i], ids[j] if ids[j] != NULL_ID else None, scores[j]) for i, (scores, ids) in enumerate(search.best.held) for j in range(len(ids))]
        yield pd.DataFrame(out, columns=["item", "item_id", "doc_id", "score"]).astype({"item_id": "Int64", "doc_id": "Int64"})

    held = found.filter(F.length("terms") > 0)
    return in_batches(held).mapInPandas(run, "item long, item_id long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP, group_terms: int = GROUP_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents, equal scores by doc_id."""
    parts = [written(ranked_group(docs, group, k), "best") for group in item_groups(items, group_terms)]
    if not parts:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    best = top_per_group(whole, ["item"], [F.desc("score"), F.asc_nulls_last("doc_id")], k, rank="rank")
    return best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def query(spark, sf: str) -> DataFrame:
    """Each benchmark item's ten best documents."""
    return ranked(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


SQL = r"""
WITH terms AS (
  SELECT doc_id, row_number() OVER () AS d, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents WHERE text IS NOT NULL
), docs AS (
  SELECT doc_id, d, t, len(t)::BIGINT AS n FROM terms WHERE len(t) > 0
), whole AS (
  SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM docs
), asked AS (
  SELECT DISTINCT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS i FROM benchmark)
), counted AS (
  SELECT d, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*)::BIGINT AS tf
  FROM (SELECT d, doc_id, n, unnest(t) AS term FROM docs) WHERE term IN (SELECT term FROM asked) GROUP BY d, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM counted, whole GROUP BY term, n_docs
), impact AS (
  SELECT d, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))) AS x FROM counted JOIN weights USING (term), whole
), scored AS (
  SELECT i, item_id, d, doc_id, sum(x)::BIGINT AS score FROM asked JOIN impact USING (term) GROUP BY i, item_id, d, doc_id HAVING sum(x) > 0
)
SELECT item_id, (row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) <= 10
"""
