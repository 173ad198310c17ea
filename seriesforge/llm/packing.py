"""Packing by lexical retrieval: a sharded BM25 index fills each window with neighbours of its seed.

Documents are dealt evenly over shards. A shard holds an inverted index of its documents' token
ids; document frequencies and the mean length count the whole table. A window begins with what
was cut off the last document, or with the next unused document, its seed. The index ranks all
unused documents of the shard that score for the seed's most telling terms; they fill the window
one after another, and the one that does not fit is cut, its rest being the next seed. If they end
before the window is full, the last of them is the seed of what follows. So every
window but a shard's last is full, and that one is divided into sequences of powers of two, which
need no padding.

Texts are tokenised once, into a table in the shared folder. Of it the driver gets one count for
each vocabulary entry, a bound set by the tokenizer file. A shard is about `SHARD` rows, dealt by a
row number of that table and not by any key, so that no key's or copy's weight gathers in one.
That is a cut by input size: of N documents a seed can meet only about SHARD, chosen at random.

Defined results: null or empty text is a document of the end id alone; repeated rows are separate
documents; ties in score go to the earlier document; a document longer than the window is cut into
several; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import bounded, release, table, written
from seriesforge.llm.tokens import ids_of

WINDOW = 4096
END_ID = 2
SHARD = 1_500
TERMS = 24
K1, B = 1.2, 0.75
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def tokenised(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids): each whole text as packed 16-bit ids with the end id behind."""
    end = np.array([end_id], "<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ids_of(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), ids.of_all(b.column(1), end)], ["doc_id", "ids"])
        release()

    whole = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return bounded(whole, 1000, 4 << 20).mapInArrow(run, "doc_id long, ids binary")


def document_frequencies(ids: DataFrame) -> np.ndarray:
    """For each id the number of documents that have it; the last entry counts documents, the one before all ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, slot = np.zeros(65_538, np.int64), np.empty(65_536, np.int32)
        for b in batches:
            for packed in b["ids"]:
                one = np.frombuffer(packed, "<u2")
                places = np.arange(len(one), dtype=np.int32)
                slot[one] = places
                counts[one[slot[one] == places]] += 1  # of an id's places one is left in its slot
                counts[65_536] += len(one)
                counts[65_537] += 1
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"id": at, "n": counts[at]})

    got = ids.select("ids").mapInPandas(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(65_538, np.int64)
    out[got["id"]] = got["n"]
    return out


class Index:
    """BM25 over the documents of one shard."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float):
        found = [np.unique(d, return_counts=True) for d in docs]
        self.n = len(docs)
        sizes = np.array([len(t) for t, _ in found])
        terms = np.concatenate([t for t, _ in found]).astype(np.int64)
        tf = np.concatenate([c for _, c in found]).astype(float)
        owner = np.repeat(np.arange(self.n), sizes)
        longness = np.array([len(d) for d in docs])[owner] / mean_length
        weight = idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * longness))
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        order = np.argsort(terms, kind="stable")
        self.owner, self.weight = owner[order], weight[order]
        self.bounds = np.searchsorted(terms[order], np.arange(len(idf) + 1))
        self.terms, self.own_weight = terms, weight

    def telling(self, d: int, most: int = TERMS) -> np.ndarray:
        """The terms that weigh most in document d."""
        lo, hi = self.first[d], self.first[d + 1]
        if hi - lo <= most:
            return self.terms[lo:hi]
        w = self.own_weight[lo:hi]
        return self.terms[lo:hi][np.argpartition(-w, most)[:most]]

    def scores(self, d: int) -> np.ndarray:
        spans = [slice(self.bounds[t], self.bounds[t + 1]) for t in self.telling(d)]
        return np.bincount(np.concatenate([self.owner[s] for s in spans]), np.concatenate([self.weight[s] for s in spans]), self.n)


def pack_shard(docs: list[np.ndarray], idf: np.ndarray, mean_length: float, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length): every id of every document once."""
    index = Index(docs, idf, mean_length)
    unused = np.ones(len(docs), bool)
    sequences: list[list[tuple[int, int, int]]] = []
    now: list[tuple[int, int, int]] = []
    room, next_seed = window, 0
    seed, waiting = -1, []

    def put(d: int, start: int) -> int:
        """Puts what fits of a document into the window; returns where the rest starts."""
        nonlocal room, now
        take = min(room, len(docs[d]) - start)
        now.append((d, start, take))
        room -= take
        if room == 0:
            sequences.append(now)
            now, room = [], window
        return start + take

    while True:
        if waiting:
            d = waiting.pop()
        else:
            if seed >= 0 and now:
                score = np.where(unused, index.scores(seed), 0.0)
                scored = np.flatnonzero(score > 0)
                waiting = scored[np.argsort(-score[scored], kind="stable")][::-1].tolist()
                seed = -1
                if waiting:
                    continue
            while next_seed < len(docs) and not unused[next_seed]:
                next_seed += 1
            if next_seed == len(docs):
                break
            d = next_seed
        if not unused[d]:
            continue
        unused[d] = False
        at, before = 0, len(sequences)
        while at < len(docs[d]):
            at = put(d, at)
        if len(sequences) > before or seed < 0 and not waiting:
            # The document closed a window or opened one: what comes next is retrieved for it.
            seed, waiting = d, []
    if now:
        sequences.extend(halves(now, window))
    return sequences


def halves(pieces: list[tuple[int, int, int]], window: int) -> list[list[tuple[int, int, int]]]:
    """The last window of a shard, divided into sequences whose lengths are powers of two."""
    total = sum(n for _, _, n in pieces)
    out: list[list[tuple[int, int, int]]] = []
    size = window
    left = list(reversed(pieces))
    while size:
        if total & size:
            one, room = [], size
            while room:
                d, start, n = left.pop()
                take = min(n, room)
                one.append((d, start, take))
                room -= take
                if take < n:
                    left.append((d, start + take, n - take))
            out.append(one)
        size //= 2
    return out


def packed(docs: DataFrame, tokenizer: str, window: int = WINDOW, shard: int = SHARD) -> DataFrame:
    """One row per piece of a document in a sequence."""
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    ids = written(tokenised(docs, tokenizer).withColumn("row", F.monotonically_increasing_id()), "ids")
    df = document_frequencies(ids)
    n_docs, mean_length = int(df[-1]), df[-2] / max(1, df[-1])
    idf = np.log1p((n_docs - df[:-2] + 0.5) / (df[:-2] + 0.5))
    shards = max(1, -(-n_docs // shard))
    sent = docs.sparkSession.sparkContext.broadcast(idf)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "row"], kind="stable")
        arrays = [np.frombuffer(b, "<u2") for b in rows["ids"]]
        names = [None if pd.isna(x) else int(x) for x in rows["doc_id"]]
        first = int(rows["shard"].iloc[0]) << 32
        out = []
        for k, sequence in enumerate(pack_shard(arrays, sent.value, mean_length, window)):
            at = 0
            for d, start, n in sequence:
                crc = zlib.crc32(arrays[d][start : start + n].astype("<u4").tobytes())
                out.append((names[d], start, n, crc, len(arrays[d]), first + k, at))
                at += n
        return pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")]).astype({"doc_id": "Int64"})

    dealt = ids.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(run, SCHEMA)


def query(spark, sf: str) -> DataFrame:
    return packed(table(spark, sf, "documents").select("doc_id", "text"), default_tokenizer())
