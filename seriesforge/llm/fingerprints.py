"""Document fingerprints by I-Match with randomised lexicon subsets.

The lexicon is the terms whose inverse document frequency, ln(documents / documents with the
term), lies in a band. Of a text its distinct terms in the lexicon are kept, sorted, and hashed
once for each of `SLOTS` random subsets of the lexicon; the fingerprint is the list of these
hashes. A subset holds each lexicon term with probability 2^-level. Many edits leave a subset
untouched only if it is small beside the text, so a text takes the level at which about a third
of its subsets have a term, and the next two finer ones for comparison with texts of up to four
times as many terms. Likeness is the share of equal hashes among the subsets that either text has a
term in, an estimate of the share of kept terms that both texts have.

Since every lexicon term occurs in at least exp(-highest idf) of the documents, the lexicon has at
most mean distinct terms / that share entries, whatever the size of the corpus; that is the bound
of what is broadcast. It is found in two passes over all documents: terms that are frequent enough
somewhere, then the exact counts of those.

A document's edited text needs its neighbour by doc_id. Documents are dealt by stretches of ids, a
stretch is read in order, and only the first and last document of each meet in a second, small
join; no task holds more than one text and its neighbour.

Defined results: null text is empty; the empty text's fingerprint is a fixed string; a text with
fewer than `LEAST` lexicon terms uses all its terms; equal texts have equal fingerprints; a null
doc_id comes first; rows of equal doc_id stand in the order of their packed text; the only
document of a table is its own neighbour; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import in_batches, table, utf8, written
from seriesforge.operators.spread import neighbour_row

IDF_BAND = (math.log(5), math.log(1000))
SLOTS = 96
LEAST = 4
STRETCH = 512
FLUSH = 2_000_000
LEVELS = 3  # of each text, so that texts with up to four times as many terms share one
HEX = [f"{v:03x}" for v in range(4096)]
EMPTY = "0" * (2 + 3 * LEVELS * SLOTS)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


SEEDS = _mix(np.arange(1, SLOTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
FACTORS = (SEEDS >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def terms(text: bytes) -> np.ndarray:
    """Sorted hashes of the distinct terms, A-Z lower-cased."""
    words = set(text.lower().split())
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))


def lexicon(docs: DataFrame, band: tuple[float, float] = IDF_BAND) -> np.ndarray:
    """Sorted hashes of the terms in the band, counted over all documents."""
    spark = docs.sparkSession
    least, most = math.exp(-band[1]), math.exp(-band[0])
    whole = in_batches(docs.select(utf8("text").alias("text")))

    def somewhere(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # A term below half the least share in a stretch of documents is left out there. One that reaches the
        # least share of all documents then still counts at least half of it.
        held, size, rows = [], 0, 0

        def flush():
            t, n = np.unique(np.concatenate(held), return_counts=True)
            keep = n >= rows * least / 2
            return pd.DataFrame({"term": t[keep].view(np.int64), "n": n[keep]})

        for b in batches:
            for text in b["text"]:
                held.append(terms(text))
                size, rows = size + len(held[-1]), rows + 1
            if size >= FLUSH:
                yield flush()
                held, size, rows = [], 0, 0
        if held:
            yield flush()

    n_docs = whole.count()
    found = whole.mapInPandas(somewhere, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    maybe = found.filter(F.col("n") >= n_docs * least / 2).select("term").toPandas()["term"].to_numpy(np.int64)
    sent = spark.sparkContext.broadcast(np.sort(maybe.view(np.uint64)))

    def exactly(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = sent.value
        counts = np.zeros(len(wanted), np.int64)
        for b in batches:
            for text in b["text"]:
                t = terms(text)
                if len(t) and len(wanted):
                    at = np.searchsorted(wanted, t)
                    at = at[at < len(wanted)] if at[-1] == len(wanted) else at
                    counts[at[wanted[at] == t[: len(at)]]] += 1
        k = np.flatnonzero(counts)
        yield pd.DataFrame({"term": k, "n": counts[k]})

    counted = whole.mapInPandas(exactly, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    kept = counted.filter((F.col("n") >= n_docs * least) & (F.col("n") <= n_docs * most)).select("term").toPandas()["term"].to_numpy(np.int64)
    return np.sort(sent.value[np.sort(kept)])


def fingerprint(text: bytes, lex: np.ndarray) -> str:
    """Two hex digits of the level, then three for each slot at that level and the next ones; 000 where a subset has no term."""
    t = terms(text)
    if not len(t):
        return EMPTY
    if len(lex):
        at = np.minimum(np.searchsorted(lex, t), len(lex) - 1)
        inside = t[lex[at] == t]
        t = inside if len(inside) >= LEAST else t
    level = min((len(t) - 1).bit_length() + 1, 29)
    # Terms are hashes already, so one odd factor a slot scatters them anew: 32 bits say whether a term is in a
    # subset. Members come slot by slot.
    h = FACTORS[:, None] * (t >> np.uint64(32)).astype(np.uint32)[None, :]
    at = np.flatnonzero(h.ravel() < np.uint32(1 << (32 - level)))
    slot, h = at // len(t), h.ravel()[at]
    value = _mix(t[at % len(t)] ^ SEEDS[slot])
    out = [f"{level:02x}"]
    for k in range(level, level + LEVELS):
        if k > level:
            inside = h < np.uint32(1 << (32 - k))
            slot, h, value = slot[inside], h[inside], value[inside]
        shown = ["000"] * SLOTS
        if len(slot):
            first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
            sums = (_mix(np.add.reduceat(value, first)) % np.uint64(4095)).tolist()
            for s, v in zip(slot[first].tolist(), sums):
                shown[s] = HEX[v + 1]
        out += shown
    return "".join(out)


def likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if EMPTY in (a, b):
        return 0.0
    la, lb = int(a[:2], 16), int(b[:2], 16)
    k = max(la, lb)
    if abs(la - lb) >= LEVELS:
        return 0.0
    width = 3 * SLOTS
    x, y = (s[2 + width * (k - lev) : 2 + width * (k - lev + 1)] for s, lev in ((a, la), (b, lb)))
    both = [(x[i : i + 3], y[i : i + 3]) for i in range(0, width, 3)]
    told = [p for p in both if p != ("000", "000")]
    return sum(p == q for p, q in told) / len(told) if told else 0.0


def edited(text: str, following: str) -> str:
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]
IN_STRETCH = f"kind string, bucket long, packed binary, {COLUMNS}"


def _row(doc_id, text: str, own: str, following: str, following_own: str, lex: np.ndarray) -> tuple:
    changed = edited(text, following).encode()
    other = fingerprint(changed, lex)
    return doc_id, len(text), hashlib.sha256(changed).hexdigest(), own, other, likeness(own, other), likeness(own, following_own)


def fingerprinted(docs: DataFrame, lex: np.ndarray) -> DataFrame:
    """One row per document: its fingerprint, its edited text's, and how near they and the next document's are."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(lex)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    lo = ids["lo"] or 0
    width = max(1, ((ids["hi"] or 0) - lo + 1) * STRETCH // max(1, ids["n"]))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = zstandard.ZstdCompressor(level=1)
        for b in batches:
            yield pd.DataFrame({"bucket": b["bucket"], "doc_id": b["doc_id"].astype("Int64"), "packed": [packer.compress(t) for t in b["text"]]})

    def stretch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack, lex_ = zstandard.ZstdDecompressor(), sent.value
        last = None  # bucket, id, text, fingerprint, packed
        for b in batches:
            out = []
            for bucket, doc_id, packed in zip(b["bucket"], b["doc_id"], b["packed"]):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                raw = unpack.decompress(packed)
                now = (bucket, doc_id, raw.decode(), fingerprint(raw, lex_), packed)
                if last is not None and last[0] == bucket:
                    out.append(("whole", bucket, None, *_row(last[1], last[2], last[3], now[2], now[3], lex_)))
                else:
                    if last is not None:
                        out.append(("tail", last[0], last[4], last[1], len(last[2]), None, last[3], None, None, None))
                    out.append(("head", bucket, packed, doc_id, None, None, now[3], None, None, None))
                last = now
            yield pd.DataFrame(out, columns=["kind", "bucket", "packed", *NAMES]).astype({"doc_id": "Int64", "n_chars": "Int64"})
        if last is not None:
            out = [("tail", last[0], last[4], last[1], len(last[2]), None, last[3], None, None, None)]
            yield pd.DataFrame(out, columns=["kind", "bucket", "packed", *NAMES]).astype({"doc_id": "Int64", "n_chars": "Int64"})

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack, lex_ = zstandard.ZstdDecompressor(), sent.value
        for b in batches:
            out = []
            for doc_id, packed, own, after, after_own in zip(b["doc_id"], b["packed"], b["fingerprint"], b["after"], b["after_own"]):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                out.append(_row(doc_id, unpack.decompress(packed).decode(), own, unpack.decompress(after).decode(), after_own, lex_))
            yield pd.DataFrame(out, columns=NAMES).astype({"doc_id": "Int64"})

    keyed = docs.select(
        F.coalesce(F.floor((F.col("doc_id").cast("long") - F.lit(lo)) / F.lit(width)), F.lit(-1)).cast("long").alias("bucket"), F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text")
    )
    dealt = in_batches(keyed).mapInPandas(pack, "bucket long, doc_id long, packed binary")
    ordered = dealt.repartition("bucket").sortWithinPartitions("bucket", "doc_id", "packed")
    told = written(ordered.mapInPandas(stretch, IN_STRETCH), "stretches")
    heads = told.filter("kind = 'head'")
    starts = neighbour_row(heads.select("bucket"), [], "bucket", ["bucket"], alias="following", step=1)
    first = heads.agg(F.min("bucket")).first()[0]
    order = starts.select("bucket", F.coalesce("following.bucket", F.lit(first)).alias("next_bucket"))
    after = heads.select(F.col("bucket").alias("next_bucket"), F.col("packed").alias("after"), F.col("fingerprint").alias("after_own"))
    tails = told.filter("kind = 'tail'").join(order, "bucket").join(after, "next_bucket")
    return told.filter("kind = 'whole'").select(*NAMES).unionByName(tails.select("doc_id", "packed", "fingerprint", "after", "after_own").mapInPandas(meet, COLUMNS))


def query(spark, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return fingerprinted(docs, lexicon(docs))
