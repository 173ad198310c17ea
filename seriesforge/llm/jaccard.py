"""Exact n-gram Jaccard join in metric space, as connected components of near-duplicates.

Jaccard distance is a metric. The join works on distinct shingle sets (documents of equal sets
are one point) and never lists the pairs of a group:

1. One shingle in `SAMPLE`, chosen by its hash, goes through a packed index that tells which of them
   another row has. A linked point lacks at most a quarter of its shingles in its partner, so a point
   with more sampled shingles of its own than that has no partner and is done. The index names a
   point by its place in a stretch of the input, about a byte for a posting however many buckets
   there are; equal sets of different stretches keep each other, which the next step mends.
   The points that are left have their texts read again. An inverted index of all their shingles
   finds for each those that another point has, and drops it if they are less than the wanted share.
2. The rest is ordered rarest shingle first. Two points within the radius share a shingle among
   the first few of either, so each such shingle opens a region; regions of equal membership are
   one region.
3. In a region pivots are chosen, the most central points of its parts, and exact distances to
   them are computed. Each pivot opens a Voronoi region of the points near it. By the triangle
   inequality a partner of a point within twice the radius of a pivot lies within three times the
   radius: such boundary points are replicated into the pivot's region, all other points go to
   the region of those far from every pivot. Regions whose points are already connected are
   done, the others are divided again with more pivots. What is left after `DIVISIONS` divisions is
   joined in blocks of `BLOCK` points. Counts of shingles in `CELLS` cells bound what two sets can
   share; only points that have a possible partner by that bound meet with their shingles, each pair
   of a region's blocks through an index of its own.

Shingles that a large share of documents has are found first, a list whose length is bounded by
the mean set size over that share; they come last in the order and are not sent through the
index. Shingles are 64-bit hashes; 40 bits and more of them order the index, and the sets that
distances are computed from.

Defined results: null text and text without words have an empty set, linked with nothing, and
their own doc_id as component; fewer words than a shingle are one shingle; repeated rows link
like any equal texts; rows with null doc_id count as documents, but the smallest id is taken of
the others; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.llm.common import WORD, bounded, fresh, release, table, utf8, written

WIDTH = 5
SIMILAR = 75  # per cent
HOT_SHARE = 0.0025
HOT_LEAST = 8
SAMPLE = 3  # one shingle in so many goes through the first index
CELLS = 256  # that bound the overlap of two sets
BROADCAST_ROWS = 2_000_000  # of two 64-bit numbers, 32 MB
FLUSH = 2_000_000  # postings gathered before they are sent
BUCKET = 1_000_000  # postings of an index bucket, about
DIVISIONS = 2  # of every region by pivots, before what is left of them is joined by blocks
BLOCK = 1024  # points
LARGE = 24  # rows of a group, packed or single, after which a worker gives its memory back
LOW = np.uint64((1 << 40) - 1)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; only A-Z is lower-cased."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    if len(words) < width:
        h = np.array([len(words)], np.uint64)
        for x in w:
            h = h * MULTIPLIER + x
        return _mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    n = len(words) - width + 1
    h = w[:n].copy()
    for k in range(1, width):
        h = h * MULTIPLIER + w[k : k + n]
    return np.unique(_mix(h))


def point_of(s: np.ndarray) -> int:
    """64 bits for a whole set, order-free, as a signed number."""
    with np.errstate(over="ignore"):
        a = _mix(s * MULTIPLIER).sum(dtype=np.uint64) + np.uint64(len(s))
        b = np.bitwise_xor.reduce(_mix(s + MULTIPLIER))
        return int(_mix(np.array([a * MULTIPLIER + b]))[0].astype(np.int64))


def points(docs: DataFrame, width: int) -> DataFrame:
    """kind 0: (doc_id, key, point, n), key telling rows of different id or text apart; kind 1: point is a shingle that is frequent among n documents' points of one stretch of the input."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        count = 0

        def frequent():
            points_, whole = len(held), np.concatenate([*held.values(), np.zeros(0, np.uint64)])
            held.clear()  # before the sort takes as much again
            keys, n = np.unique(whole, return_counts=True)
            many = n >= max(2, HOT_SHARE * points_)
            k = int(many.sum())
            return pd.DataFrame({"kind": np.ones(k, int), "doc_id": pd.array([None] * k, dtype="Int64"), "key": np.zeros(k, int), "point": keys[many].view(np.int64), "n": n[many]})

        for b in batches:
            sets = [shingles(t, width) for t in b["text"]]
            ids = [point_of(s) for s in sets]
            for p, s in zip(ids, sets):
                if p not in held:
                    held[p] = s
                    count += len(s)
            yield pd.DataFrame({"kind": 0, "doc_id": b["doc_id"].astype("Int64"), "key": b["key"], "point": ids, "n": [len(s) for s in sets]})
            if count >= FLUSH:
                yield frequent()
                held, count = {}, 0
        if len(held) >= HOT_LEAST:
            yield frequent()
        held.clear()
        release()

    whole = docs.select(F.col("doc_id").cast("long"), row_key(docs).alias("key"), utf8("text").alias("text"))
    return bounded(whole).mapInPandas(run, "kind int, doc_id long, key long, point long, n long")


def row_key(docs: DataFrame) -> Column:
    return F.xxhash64(docs["doc_id"].cast("long"), utf8("text"))


def _released(work: Callable[[pd.DataFrame], pd.DataFrame]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """`work`, and after a large group its memory given back."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = work(rows)
        if len(rows) >= LARGE:
            release()
        return out

    return run


def _five(h: np.ndarray) -> bytes:
    return np.ascontiguousarray((h & LOW).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _from_five(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(b, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def _steps(ascending: np.ndarray) -> bytes:
    """Ascending numbers as the bytes of their differences; a byte of 255 says that the difference goes on in the next."""
    more, rest = np.divmod(np.diff(ascending, prepend=0), 255)
    ends = np.cumsum(more + 1)
    out = np.full(ends[-1] if len(ends) else 0, 255, np.uint8)
    out[ends - 1] = rest
    return out.tobytes()


def _from_steps(b: bytes) -> np.ndarray:
    step = np.frombuffer(b, np.uint8)
    return np.cumsum(step, dtype=np.int64)[step < 255]


def bucket_bits(count: int) -> int:
    return min(22, max(4, count // BUCKET).bit_length())


def sampled_postings(docs: DataFrame, width: int, similar: int, bits: int, hot) -> DataFrame:
    """(bucket, stretch, owners, keys, sent, ids, least): sampled shingles of a stretch of the input by bucket, 32 bits of each, frequent ones left out.

    A row of a bucket below 0 is the list of a stretch: its points, and of each how many sampled shingles others must have.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent = hot.value
        held: dict[int, np.ndarray] = {}
        spare: list[int] = []
        count = 0

        def flush():
            ids = np.fromiter(held, "<i8", len(held))
            # The same wherever and whenever it is computed.
            stretch = int.from_bytes(hashlib.blake2b(ids.tobytes(), digest_size=8).digest(), "little", signed=True)
            h = np.concatenate(list(held.values()))
            owner = np.repeat(np.arange(len(ids)), [len(s) for s in held.values()])
            rare = ~np.isin(h, frequent)
            h, owner = h[rare], owner[rare]
            least = np.maximum(0, np.bincount(owner, minlength=len(ids)) - np.array(spare))
            out = [(-1 - stretch % (1 << bits), stretch, b"", b"", -len(h), ids.tobytes(), least.astype("<u4").tobytes())]
            bucket = (h >> np.uint64(64 - bits)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            h, owner, bucket = h[order], owner[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
            for lo, hi in zip(cuts, cuts[1:]):
                out.append((int(bucket[lo]), stretch, _steps(owner[lo:hi]), h[lo:hi].astype("<u4").tobytes(), int(hi - lo), None, None))
            return pd.DataFrame(out, columns=["bucket", "stretch", "owners", "keys", "sent", "ids", "least"])

        for b in batches:
            for t in b["text"]:
                s = shingles(t, width)
                if len(s):
                    p = point_of(s)
                    if p not in held:
                        held[p] = s[s % np.uint64(SAMPLE) == 0]
                        spare.append(len(s) - -(-similar * len(s) // 100))
                        count += len(held[p])
            if count >= FLUSH:
                yield flush()
                held, spare, count = {}, [], 0
        if held:
            yield flush()
        held.clear()
        release()

    whole = docs.select(utf8("text").alias("text"))
    return bounded(whole).mapInPandas(run, "bucket int, stretch long, owners binary, keys binary, sent long, ids binary, least binary")


def candidates(docs: DataFrame, width: int, similar: int, bits: int, hot) -> DataFrame:
    """(point): those with so few sampled shingles of their own that they may have a partner."""

    def met(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["bucket"].iloc[0] < 0:
            return pdf[["stretch", "owners", "sent", "ids", "least"]]
        owners = [_from_steps(x) for x in pdf["owners"]]
        key = np.concatenate([np.frombuffer(x, "<u4") for x in pdf["keys"]])
        _, inverse, n = np.unique(key, return_inverse=True, return_counts=True)
        parts = np.split(n[inverse] > 1, np.cumsum([len(o) for o in owners])[:-1])
        told = pdf[["stretch", "sent"]].copy()
        told["owners"] = [_steps(o[m]) for o, m in zip(owners, parts)]
        told["ids"] = told["least"] = None
        return told[["stretch", "owners", "sent", "ids", "least"]]

    def enough(pdf: pd.DataFrame) -> pd.DataFrame:
        lists = pdf[pdf["ids"].notna()]
        if not len(lists):
            return pd.DataFrame({"point": np.zeros(0, np.int64)})
        ids, least = np.frombuffer(lists["ids"].iloc[0], "<i8"), np.frombuffer(lists["least"].iloc[0], "<u4")
        shared = np.bincount(np.concatenate([_from_steps(x) for x in pdf["owners"]]), minlength=len(ids))
        # A list counts what it sent below 0. Should a task that ran again have cut its input otherwise, no point of it is dropped.
        return pd.DataFrame({"point": ids[(shared >= least) | (pdf["sent"].sum() != 0)]})

    schema = "stretch long, owners binary, sent long, ids binary, least binary"
    told = sampled_postings(docs, width, similar, bits, hot).groupBy("bucket").applyInPandas(_released(met), schema)
    return told.groupBy("stretch").applyInPandas(_released(enough), "point long").distinct()


def postings(docs: DataFrame, width: int, bits: int, hot) -> DataFrame:
    """Packed index: rows of a bucket hold points, their set sizes, numbers of postings, and 40 bits of each shingle.

    Buckets below 0 hold the frequent shingles of each point, whole.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent = hot.value
        held: dict[int, np.ndarray] = {}
        count = 0

        def flush():
            ids = np.fromiter(held, np.int64, len(held))
            sizes = np.array([len(s) for s in held.values()], np.int64)
            h = np.concatenate(list(held.values()))
            owner = np.repeat(np.arange(len(ids)), sizes)
            common = np.isin(h, frequent)
            out = []

            def row(bucket, o, keys):
                at, n = np.unique(o, return_counts=True)
                out.append((bucket, ids[at].astype("<i8").tobytes(), sizes[at].astype("<u4").tobytes(), n.astype("<u4").tobytes(), keys))

            row(-1 - int(ids[0]) % (1 << bits), owner[common], h[common].astype("<u8").tobytes())
            h, owner = h[~common], owner[~common]
            bucket = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
            order = np.argsort(bucket, kind="stable")
            h, owner, bucket = h[order], owner[order], bucket[order]
            for b in np.unique(bucket):
                lo, hi = np.searchsorted(bucket, [b, b + 1])
                row(int(b), owner[lo:hi], _five(h[lo:hi]))
            return pd.DataFrame(out, columns=["bucket", "ids", "sizes", "counts", "keys"])

        for b in batches:
            for t in b["text"]:
                s = shingles(t, width)
                if len(s):
                    p = point_of(s)
                    if p not in held:
                        held[p] = s
                        count += len(s)
            if count >= FLUSH:
                yield flush()
                held, count = {}, 0
        if held:
            yield flush()
        held.clear()
        release()

    whole = docs.select(utf8("text").alias("text"))
    return bounded(whole).mapInPandas(run, "bucket int, ids binary, sizes binary, counts binary, keys binary")


def _rows(pdf: pd.DataFrame):
    """Flat arrays of a bucket: distinct points with sizes, and for each posting its point and key."""
    ids = np.concatenate([np.frombuffer(x, "<i8") for x in pdf["ids"]])
    sizes = np.concatenate([np.frombuffer(x, "<u4") for x in pdf["sizes"]])
    counts = np.concatenate([np.frombuffer(x, "<u4") for x in pdf["counts"]])
    distinct, first, inverse = np.unique(ids, return_index=True, return_inverse=True)
    return distinct, sizes[first], np.repeat(inverse, counts)


def shared_shingles(index: DataFrame, parts: int) -> DataFrame:
    """(part, points, sizes, counts, keys, df): of each point the shingles that some other point has."""

    def deal(bucket, points_, sizes, owner, keys, df):
        part = (points_.view(np.uint64) % np.uint64(parts)).astype(np.int64)
        to = part[owner]
        order = np.lexsort((owner, to))
        owner, keys, df, to = owner[order], keys[order], df[order], to[order]
        out = []
        for k in np.unique(to):
            lo, hi = np.searchsorted(to, [k, k + 1])
            at, n = np.unique(owner[lo:hi], return_counts=True)
            out.append(
                (int(k), points_[at].astype("<i8").tobytes(), sizes[at].astype("<u4").tobytes(), n.astype("<u4").tobytes(), keys[lo:hi].astype("<u8").tobytes(), df[lo:hi].astype("<u4").tobytes())
            )
        return pd.DataFrame(out, columns=["part", "ids", "sizes", "counts", "keys", "df"])

    schema = "part int, ids binary, sizes binary, counts binary, keys binary, df binary"

    def found(pdf: pd.DataFrame) -> pd.DataFrame:
        bucket = int(pdf["bucket"].iloc[0])
        if bucket < 0:
            return pd.concat([frequent(pdf.iloc[k : k + 1]) for k in range(len(pdf))])
        points_, sizes, owner = _rows(pdf)
        keys = np.concatenate([_from_five(x) for x in pdf["keys"]])
        order = np.lexsort((owner, keys))
        keys, owner = keys[order], owner[order]
        new = np.ones(len(keys), bool)  # the same point may come from several stretches of the input
        new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        keys, owner = keys[new], owner[new]
        _, inverse, n = np.unique(keys, return_inverse=True, return_counts=True)
        df = n[inverse]
        many = df > 1
        # A shingle's number in all buckets: the bucket above its 40 bits.
        keys = (keys | (np.uint64(bucket) << np.uint64(40)))[many]
        return deal(bucket, points_, sizes, owner[many], keys, df[many])

    def frequent(row: pd.DataFrame) -> pd.DataFrame:
        points_, sizes, owner = _rows(row)
        keys = np.frombuffer(row["keys"].iloc[0], "<u8")
        # The top bit sets frequent shingles apart, and no df makes them the last in order.
        return deal(-1, points_, sizes, owner, keys | np.uint64(1 << 63), np.full(len(keys), 0xFFFFFFFF, np.uint64))

    return index.groupBy("bucket").applyInPandas(_released(found), schema)


def survivors(shared: DataFrame, similar: int) -> DataFrame:
    """(point, n, own, central, keys, cells): points with enough shared shingles, keys rarest first; own counts the others."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        points_, sizes, owner = _rows(pdf)
        keys = np.concatenate([np.frombuffer(x, "<u8") for x in pdf["keys"]])
        df = np.concatenate([np.frombuffer(x, "<u4") for x in pdf["df"]])
        order = np.lexsort((keys, df, owner))
        owner, keys, df = owner[order], keys[order], df[order]
        new = np.ones(len(keys), bool)  # frequent shingles may repeat
        new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        owner, keys, df = owner[new], keys[new], df[new]
        bounds = np.searchsorted(owner, np.arange(len(points_) + 1))
        out = []
        for i, (p, n) in enumerate(zip(points_, sizes)):
            c = bounds[i + 1] - bounds[i]
            if 100 * c >= similar * n:
                own = keys[bounds[i] : bounds[i + 1]]
                central = c / n + np.log2(df[bounds[i] : bounds[i + 1]].astype(float)).mean() / 64
                cells = np.bincount((own * MULTIPLIER >> np.uint64(56)).astype(np.int64), minlength=CELLS)
                out.append((int(p), int(n), int(n - c), float(central), own.astype("<u8").tobytes(), np.minimum(cells, 255).astype(np.uint8).tobytes()))
        return pd.DataFrame(out, columns=["point", "n", "own", "central", "keys", "cells"])

    return shared.groupBy("part").applyInPandas(_released(run), "point long, n long, own long, central double, keys binary, cells binary")


def regions(kept: DataFrame, similar: int) -> DataFrame:
    """(region, point, central): a region for each shingle that may be the first shared one of a pair."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            took = []
            for p, n, own, central, keys in zip(b["point"], b["n"], b["own"], b["central"], b["keys"]):
                prefix = n - -(-similar * n // 100) + 1
                first = np.frombuffer(keys, "<i8")[: prefix - own]
                took.append((np.full(len(first), p), first, np.full(len(first), central)))
            p, k, c = (np.concatenate(x) for x in zip(*took))
            yield pd.DataFrame({"region": k, "point": p, "central": c})

    return kept.select("point", "n", "own", "central", "keys").mapInPandas(run, "region long, point long, central double")


def distances(pairs: DataFrame, kept: DataFrame) -> DataFrame:
    """(point, pivot, near, distance) of the pairs, exactly."""
    a = kept.select("point", F.col("n").alias("n_a"), F.col("keys").alias("keys_a"))
    b = kept.select(F.col("point").alias("pivot"), F.col("n").alias("n_b"), F.col("keys").alias("keys_b"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            both = np.array(
                [len(np.intersect1d(np.frombuffer(s, "<u8"), np.frombuffer(t, "<u8"), assume_unique=True)) for s, t in zip(x["keys_a"], x["keys_b"])], np.int64
            )
            union = x["n_a"].to_numpy(np.int64) + x["n_b"].to_numpy(np.int64) - both
            yield pd.DataFrame({"point": x["point"], "pivot": x["pivot"], "shared": both, "united": union})

    joined = bounded(pairs.join(a, "point").join(b, "pivot"), 2000)
    return joined.mapInPandas(run, "point long, pivot long, shared long, united long")


def components(links: DataFrame) -> DataFrame:
    """(point, label): the smallest point reachable by links (point, pivot), by label passing with pointer jumping."""
    edges = written(links.select("point", F.col("pivot").alias("to")).unionByName(links.select(F.col("pivot").alias("point"), F.col("point").alias("to"))).distinct(), "edges")
    labels = written(edges.groupBy("point").agg(F.least(F.col("point"), F.min("to")).alias("label")), "labels")
    while True:
        told = edges.join(labels.select(F.col("point").alias("to"), "label"), "to").groupBy("point").agg(F.min("label").alias("heard"))
        passed = labels.join(told, "point").select("point", F.least("label", "heard").alias("label"), F.col("label").alias("old"))
        jump = passed.select(F.col("point").alias("label"), F.col("label").alias("further"))
        after = written(passed.join(jump, "label").select("point", F.least("label", "further").alias("label"), "old"), "labels")
        labels = after.select("point", "label")
        if after.filter("label <> old").isEmpty():
            return labels


def unfinished(members: DataFrame) -> DataFrame:
    """(region, point, central, label, rows) of regions with points of different components, one region for each membership."""
    told = members.groupBy("region").agg(
        F.count(F.lit(1)).alias("rows"), F.min("label").alias("lo"), F.max("label").alias("hi"),
        F.sum(F.hash("point").cast("long")).alias("sum_a"), F.sum(F.xxhash64("point").cast("decimal(20,0)")).alias("sum_b"),
    )
    one = told.filter("lo <> hi").groupBy("rows", "sum_a", "sum_b").agg(F.min("region").alias("region"))
    return members.join(one.select("region", "rows"), "region").select("region", "point", "central", "label", "rows")


def hopeful(blocks: DataFrame, kept: DataFrame, similar: int) -> DataFrame:
    """Those rows of pairs of blocks that have a possible partner there: one of another component, of a fitting size, with enough in common by cells."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("n", kind="stable")
        cells = np.frombuffer(b"".join(rows["cells"]), np.uint8).reshape(-1, CELLS)
        n, label, block, full = rows["n"].to_numpy(), rows["label"].to_numpy(), rows["block"].to_numpy(), (cells == 255).any(1)
        same = bool((rows["low"] == rows["high"]).iloc[0])
        hope = np.zeros(len(rows), bool)
        upto = np.searchsorted(n, 100 * n // similar, side="right")
        for i in range(len(rows) - 1):
            j = np.arange(i + 1, upto[i])
            j = j[(label[j] != label[i]) & (same | (block[j] != block[i]))]
            if len(j):
                both = np.minimum(cells[j], cells[i]).sum(1, dtype=np.uint16)
                j = j[full[j] | full[i] | (100 * both.astype(np.int64) >= similar * (n[j] + n[i] - both))]
                hope[j] = True
                hope[i] |= len(j) > 0
        return rows.loc[hope, ["region", "low", "high", "block", "point", "label"]]

    whole = blocks.join(kept.select("point", "n", "cells"), "point")
    return whole.groupBy("region", "low", "high").applyInPandas(_released(run), "region long, low int, high int, block int, point long, label long")


def block_joins(members: DataFrame, kept: DataFrame, similar: int) -> DataFrame:
    """(point, pivot): links between points of different components of a region.

    A region is cut into blocks of about `BLOCK` points; each pair of blocks meets once and joins
    through a local index. A link inside a component found so far is not listed.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        m = len(rows)
        sets = [np.frombuffer(k, "<u8") for k in rows["keys"]]
        sizes, label, n, points_ = np.array([len(x) for x in sets]), rows["label"].to_numpy().copy(), rows["n"].to_numpy(), rows["point"].to_numpy()
        block, same = rows["block"].to_numpy(), bool((rows["low"] == rows["high"]).iloc[0])
        key = np.unique(np.concatenate(sets), return_inverse=True)[1]
        owner = np.repeat(np.arange(m), sizes)
        order = np.argsort(key, kind="stable")
        holders, first = owner[order], np.concatenate([[0], np.cumsum(np.bincount(key))])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        out = []
        for i in range(m - 1):
            apart = (label != label[i]) & (np.arange(m) > i)
            if not same:
                apart &= block != block[i]
            if not apart.any():
                continue
            keys = key[ends[i] : ends[i + 1]]
            spans = first[keys + 1] - first[keys]
            upto = np.cumsum(spans)
            both = np.bincount(holders[np.arange(upto[-1]) + np.repeat(first[keys] - upto + spans, spans)], minlength=m)
            for j in np.flatnonzero(apart & (100 * both >= similar * (n + n[i] - both))):
                if label[j] != label[i]:
                    out.append((points_[i], points_[j]))
                    label[label == label[j]] = label[i]
        return pd.DataFrame(out, columns=["point", "pivot"], dtype="int64")

    blocks = F.ceil(F.col("rows") / BLOCK).cast("int")
    dealt = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("point", F.lit(1)), F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "region", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "point", "label"
    )
    whole = written(hopeful(met, kept, similar), "hopeful").join(kept.select("point", "n", "keys"), "point")
    return whole.groupBy("region", "low", "high").applyInPandas(_released(run), "point long, pivot long")


def linked(kept: DataFrame, similar: int) -> DataFrame:
    """(point, label) of all points that have a link."""
    radius = 1 - similar / 100
    members = regions(kept, similar).withColumn("label", F.col("point"))
    links = kept.select("point", F.col("point").alias("pivot")).limit(0)
    labels = kept.select("point", F.col("point").alias("label")).limit(0)
    for turn in range(DIVISIONS):
        members = written(unfinished(members), "regions")
        if members.isEmpty():
            return labels
        part = F.pmod(F.xxhash64("point", "region"), F.lit(8**turn))
        # Once points are connected, those outside the component of the most central one are the open question.
        main = members.groupBy("region").agg(F.max_by("label", F.struct("central", "point")).alias("main"))
        able = members if turn == 0 else members.join(main, "region").filter("label <> main")
        pivots = able.groupBy("region", part.alias("part")).agg(F.max(F.struct("central", "point")).alias("top")).select("region", F.col("top.point").alias("pivot"))
        near = members.join(pivots, "region")
        pairs = near.filter("point <> pivot").select(F.least("point", "pivot").alias("point"), F.greatest("point", "pivot").alias("pivot")).distinct()
        told = written(distances(pairs, kept).withColumn("distance", 1 - F.col("shared") / F.col("united")), "distances")
        found = told.filter(F.col("shared") * 100 >= F.col("united") * similar).select("point", "pivot")
        if not found.isEmpty():
            links = links.unionByName(found)
            labels = components(links)
        either = told.select("point", "pivot", "distance").unionByName(told.select(F.col("pivot").alias("point"), F.col("point").alias("pivot"), "distance"))
        left = near.join(pivots.select("region", F.col("pivot").alias("point")), ["region", "point"], "left_anti").join(either, ["point", "pivot"])
        cells = left.filter(F.col("distance") <= 3 * radius + 1e-9).select(F.xxhash64("region", "pivot").alias("region"), "point", "central")
        far = (
            left.groupBy("region", "point", "central").agg(F.min("distance").alias("nearest")).filter(F.col("nearest") > 2 * radius - 1e-9)
            .select(F.xxhash64("region", F.lit("far")).alias("region"), "point", "central")
        )
        members = cells.unionByName(far).join(labels, "point", "left").withColumn("label", F.coalesce("label", "point"))
    members = written(unfinished(members), "regions")
    if members.isEmpty():
        return labels
    return components(links.unionByName(written(block_joins(members, kept, similar), "links")))


def grouped(docs: DataFrame, width: int = WIDTH, similar: int = SIMILAR) -> DataFrame:
    """(doc_id, key, n_shingles, label): rows of one label are linked, directly or through others."""
    spark = docs.sparkSession
    told = written(points(docs, width), "points")
    narrow = told.filter("kind = 0").select("doc_id", "key", "point", "n")
    sizes = narrow.agg(F.sum("n").alias("postings"), F.count(F.lit(1)).alias("rows")).first()
    often = told.filter("kind = 1").groupBy("point").agg(F.sum("n").alias("n")).filter(F.col("n") >= max(HOT_LEAST, HOT_SHARE * sizes["rows"]))
    # At most mean set size / HOT_SHARE rows.
    hot = spark.sparkContext.broadcast(np.sort(np.array([r[0] for r in often.select("point").collect()], np.int64).view(np.uint64)))
    able = candidates(docs, width, similar, bucket_bits(int(sizes["postings"] or 0) // SAMPLE), hot)
    wanted = written(narrow.join(able, "point", "left_semi").groupBy("point").agg(F.min("key").alias("key"), F.first("n").alias("n")), "wanted")
    left = wanted.agg(F.sum("n").alias("postings"), F.count(F.lit(1)).alias("rows")).first()
    keys = wanted.select("key")
    if left["rows"] <= BROADCAST_ROWS:  # then the texts stay where they are; else they are shuffled to their keys
        keys = F.broadcast(keys)
    texts = docs.select(row_key(docs).alias("key"), "text").join(keys, "key", "left_semi")
    bits = bucket_bits(int(left["postings"] or 0))
    kept = written(survivors(shared_shingles(postings(texts, width, bits, hot), 1 << bits), similar), "shared")
    labels = linked(kept, similar)
    return narrow.join(labels, "point", "left").select("doc_id", "key", F.col("n").alias("n_shingles"), F.coalesce("label", "point").alias("label"))


def joined(docs: DataFrame, width: int = WIDTH, similar: int = SIMILAR) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per document."""
    rows = grouped(docs.select("doc_id", "text"), width, similar)
    smallest = rows.filter("n_shingles > 0").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    full = rows.filter("n_shingles > 0").join(smallest, "label").select("doc_id", "n_shingles", "component_id")
    return full.unionByName(rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, width: int = WIDTH, similar: int = SIMILAR) -> DataFrame:
    """`docs` with one row of each group, that of the smallest doc_id; texts without words all stay."""
    n = fresh(docs, "key", "stays", "nth")
    rows = written(grouped(docs.select("doc_id", "text"), width, similar), "grouped")
    first = rows.filter("n_shingles > 0").groupBy("label").agg(F.min_by("key", F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first"))
    gone = rows.filter("n_shingles > 0").join(first, "label").filter("key <> first").select(F.col("key").alias(n["key"])).distinct()
    single = Window.partitionBy(n["key"]).orderBy(n["key"])
    return (
        docs.withColumn(n["key"], row_key(docs))
        .join(gone, n["key"], "left_anti")
        .withColumn(n["nth"], F.row_number().over(single))
        .filter((F.col(n["nth"]) == 1) | ~F.coalesce(F.col("text"), F.lit("")).rlike(WORD))
        .select(*docs.columns)
    )


def query(spark, sf: str) -> DataFrame:
    return joined(table(spark, sf, "documents"))


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s FROM words
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), pairs AS (
  SELECT a.doc_id AS p, b.doc_id AS q FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), edges AS (
  SELECT p, q FROM pairs UNION ALL SELECT q, p FROM pairs
), reach(doc_id, low) AS (
  SELECT DISTINCT p, p FROM edges UNION SELECT e.q, r.low FROM reach r JOIN edges e ON e.p = r.doc_id WHERE r.low < e.q
), lowest AS (
  SELECT doc_id, min(low) AS low FROM reach GROUP BY doc_id
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(least(l.low, s.doc_id), s.doc_id) AS component_id
FROM sets s LEFT JOIN lowest l ON l.doc_id = s.doc_id
"""
