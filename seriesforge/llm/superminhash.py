"""Near-duplicate groups by SuperMinHash signatures, banding, exact verification and union-find.

Each shingle deals its ranks 0, 1, 2, ... to the places of the signature in an order of its own, a
Fisher-Yates shuffle that its hash drives, and a place keeps the least rank (with a random
fraction) that it is dealt. Ranks of one shingle are all different, so places are not independent
and the share of equal places varies less than with MinHash. A text stops as soon as no place can
fall further: the next rank is above the largest that is held. Shingles of many texts are worked
off side by side, rank by rank.

1. Places are cut into bands; texts of equal bands share a bucket. Two sets of the wanted
   likeness miss each other with a chance of (1 - 0.8^4)^32, 5 in 10^8 at the very threshold.
2. Only points that share a bucket have their texts read again, for full sets. In each bucket all
   points meet its most central one. What the signatures do not rule out by six standard errors is
   compared by full sets. The links are grouped.
3. Buckets with points of different groups are worked off once more: the points outside the
   bucket's main group meet all others in blocks of `BLOCK`; each pair in the first band that it
   shares. Points with an open pair get their full sets and are joined by union-find in the task,
   which compares no two that are already linked. So no bucket is capped, none comes to one task,
   and no pair of a group of linked copies is listed.

Documents of equal sets are one point (64-bit hashes of sets and shingles).

Defined results: null text and text without words have an empty set, linked with nothing and
their own component; fewer words than a shingle are one shingle; repeated rows link like any equal
texts; rows with null doc_id count as documents, but the smallest id is taken of the others, and
they are kept only in a component of their own; an empty table gives an empty table; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import bounded, table, utf8, written
from seriesforge.llm.jaccard import components, point_of, row_key, shingles

WIDTH = 4
SIMILAR = 80  # per cent
PLACES = 128  # of a signature; a rank takes 7 bits
BANDS = 32
FRACTION = 25  # bits
ERRORS = 6  # standard errors of the signatures' estimate that rule a pair out
BLOCK = 1024  # points
CHUNK = 1 << 15  # shingles worked off side by side
SEEN = 1_000_000  # points that a task remembers
BROADCAST_ROWS = 2_000_000  # of two 64-bit numbers, 32 MB
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def signatures(sets: list[np.ndarray], places: int = PLACES) -> np.ndarray:
    """A row of `places` numbers for each set: rank and fraction of what each place was dealt; all ones for an empty set."""
    out = np.full((len(sets), places), 0xFFFFFFFF, np.uint32)
    sizes = np.array([len(s) for s in sets], np.int64)
    shingle = np.concatenate([*sets, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(len(sets)), sizes)
    for at in range(0, len(shingle), CHUNK):
        _deal(out, shingle[at : at + CHUNK], owner[at : at + CHUNK])
    return out


def _deal(out: np.ndarray, shingle: np.ndarray, owner: np.ndarray) -> None:
    places = out.shape[1]
    flat = out.reshape(-1)
    order = np.tile(np.arange(places, dtype=np.uint8), (len(shingle), 1))
    row = np.arange(len(shingle))
    for rank in range(places):
        texts = np.unique(owner[row])
        open_ = np.zeros(len(out), bool)
        open_[texts] = (out[texts] >> np.uint32(FRACTION)).max(1) >= rank
        row = row[open_[owner[row]]]
        if not len(row):
            return
        drawn = scrambled(shingle[row] + np.uint64((rank + 1) * int(MULTIPLIER) & 0xFFFFFFFFFFFFFFFF))
        other = rank + (((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(places - rank)) >> np.uint64(32)).astype(np.int64)
        place = order[row, other]
        order[row, other] = order[row, rank]
        value = np.uint32(rank << FRACTION) | (drawn >> np.uint64(64 - FRACTION)).astype(np.uint32)
        np.minimum.at(flat, owner[row] * places + place, value)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A 64-bit bucket for each row and band; its last bits are the band's number."""
    parts = signature.reshape(len(signature), bands, -1).astype(np.uint64)
    h = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), 1))
    for k in range(parts.shape[2]):
        h = scrambled(h * MULTIPLIER + parts[:, :, k])
    return (h - h % np.uint64(bands) + np.arange(bands, dtype=np.uint64)).view(np.int64)


def short(signature: np.ndarray) -> list[bytes]:
    """Each row with the upper half of its numbers: all of a rank and 9 bits of the fraction, which can only make places equal, never different."""
    return [x.tobytes() for x in (signature >> np.uint32(16)).astype("<u2")]


def read_sets(docs: DataFrame, width: int) -> DataFrame:
    """kind 0: a document's (doc_id, key, point, n); kind 1: (key, point, signature) of a point, at least once. The key tells rows apart."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for b in batches:
            sets = [shingles(t, width) for t in b["text"]]
            points = [point_of(s) for s in sets]
            yield pd.DataFrame({"kind": 0, "doc_id": b["doc_id"].astype("Int64"), "key": b["key"], "point": points, "n": [len(s) for s in sets], "signature": None})
            new = {p: (k, s) for p, k, s in zip(points, b["key"], sets) if len(s) and p not in seen}
            if len(seen) > SEEN:
                seen.clear()
            seen.update(new)
            signs = short(signatures([s for _, s in new.values()]))
            yield pd.DataFrame({"kind": 1, "doc_id": pd.array([None] * len(new), dtype="Int64"), "key": [k for k, _ in new.values()], "point": list(new), "n": 0, "signature": signs})

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(docs).alias("key"), utf8("text").alias("text"))
    return bounded(narrow).mapInPandas(run, "kind int, doc_id long, key long, point long, n long, signature binary")


def brought(few: DataFrame) -> DataFrame:
    """A written table of numbers, sent to the texts or sets that it is joined with if it is short; else those are shuffled to its keys."""
    return F.broadcast(few) if few.count() <= BROADCAST_ROWS else few


def full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(point, n, signature, shingles) of the points in `wanted` (point, key), from the text of one row each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = [shingles(t, width) for t in b["text"]]
            yield pd.DataFrame({"point": b["point"], "n": [len(s) for s in sets], "signature": short(signatures(sets)), "shingles": [s.astype("<u8").tobytes() for s in sets]})

    wanted = written(wanted, "wanted")
    texts = docs.select(row_key(docs).alias("key"), utf8("text").alias("text")).join(brought(wanted), "key").groupBy("point").agg(F.first("text").alias("text"))
    return bounded(texts).mapInPandas(run, "point long, n long, signature binary, shingles binary")


def bucketed(points: DataFrame) -> DataFrame:
    """(bucket, point) for each band of each point."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"bucket": band_keys(_matrix(b["signature"])).ravel(), "point": np.repeat(b["point"].to_numpy(), BANDS)})

    return points.select("point", "signature").mapInPandas(run, "bucket long, point long")


def _matrix(packed) -> np.ndarray:
    return np.frombuffer(b"".join(packed), "<u2").reshape(-1, PLACES)


def least_equal(similar: int) -> float:
    """Equal places that a pair of the wanted likeness has but for a chance of six standard errors."""
    j = similar / 100
    return PLACES * (j - ERRORS * np.sqrt(j * (1 - j) / PLACES))


def alike(a: bytes, b: bytes, similar: int) -> bool:
    """Whether two full sets have the wanted likeness."""
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    if 100 * min(len(x), len(y)) < similar * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= similar * (len(x) + len(y) - both)


def possible(pairs: DataFrame, points: DataFrame, similar: int) -> DataFrame:
    """Those pairs (point, pivot) that sizes and signatures do not rule out."""
    least = least_equal(similar)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            good = (_matrix(b["sign_a"]) == _matrix(b["sign_b"])).sum(1) >= least
            yield b.loc[good, ["point", "pivot"]]

    a = points.select("point", F.col("n").alias("n_a"), F.col("signature").alias("sign_a"))
    b = points.select(F.col("point").alias("pivot"), F.col("n").alias("n_b"), F.col("signature").alias("sign_b"))
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * similar
    return bounded(pairs.join(a, "point").join(b, "pivot").filter(fits)).mapInPandas(run, "point long, pivot long")


def verified(pairs: DataFrame, points: DataFrame, similar: int) -> DataFrame:
    """Those of the written pairs whose full sets have the wanted likeness. Only sets of points in a pair travel, and to the pivot's place alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.loc[[alike(x, y, similar) for x, y in zip(b["a"], b["b"])], ["point", "pivot"]]

    pivots = written(pairs.select("pivot").distinct(), "pivots")
    a = points.select("point", F.col("shingles").alias("a")).join(brought(pairs), "point")
    b = points.select(F.col("point").alias("pivot"), F.col("shingles").alias("b")).join(brought(pivots), "pivot", "left_semi")
    return bounded(a.join(b, "pivot"), 128).mapInPandas(run, "point long, pivot long")


def in_runs(df: DataFrame, keys: list[str], work: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """`work` on the rows of each value of `keys`, many small groups a task without a call for each from the JVM."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for b in batches:
            b = b if rest is None else pd.concat([rest, b], ignore_index=True)
            k = b[keys].to_numpy()
            cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1)] if len(b) else [0]
            done = [work(b.iloc[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]
            if done:
                yield pd.concat(done)
            rest = b.iloc[cuts[-1] :]
        if rest is not None and len(rest):
            yield work(rest)

    return bounded(df.repartition(*keys).sortWithinPartitions(*keys), 256).mapInPandas(run, schema)


def open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, point, label, main, rows, others) of buckets of more than one group; main is the group of most points."""
    named = members.join(labels, "point", "left").withColumn("label", F.coalesce("label", "point"))
    groups = named.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("rows"))
    told = groups.groupBy("bucket").agg(F.count(F.lit(1)).alias("groups"), F.max_by("label", F.struct("rows", "label")).alias("main"), F.sum("rows").alias("rows"), F.max("rows").alias("most"))
    return named.join(told.filter("groups > 1").select("bucket", "main", "rows", (F.col("rows") - F.col("most")).alias("others")), "bucket")


def in_blocks(members: DataFrame) -> DataFrame:
    """The members once for each pair of blocks they belong to: points outside the main group by all points of the bucket."""
    count = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / BLOCK)).cast("int")
    block = lambda seed, n: F.pmod(F.xxhash64("point", F.lit(seed)), F.col(n)).cast("int")
    cut = members.withColumn("outer_blocks", count("others")).withColumn("blocks", count("rows"))
    one = F.col("outer_blocks") * F.col("blocks") == 1
    all_rows = cut.withColumn("outer", F.explode(F.sequence(F.lit(0), F.col("outer_blocks") - 1))).withColumn("inner", block(2, "blocks")).withColumn("asks", one & (F.col("label") != F.col("main")))
    asking = cut.filter(~one & (F.col("label") != F.col("main"))).withColumn("outer", block(1, "outer_blocks")).withColumn("inner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("asks", F.lit(True))
    columns = ["bucket", "outer", "inner", "asks", "point", "label"]
    # A row that asks stands among the others too, where a bucket is one block.
    return all_rows.select(*columns, one.alias("single")).unionByName(asking.select(*columns, F.lit(False).alias("single")))


def _equal_places(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many places each row of a has in common with each row of b; a byte counts to 128."""
    out = np.zeros((len(a), len(b)), np.uint8)
    across, along = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    for x, y in zip(across, along):
        out += (x[:, None] == y[None, :]).view(np.uint8)
    return out


def _crossing(rows: pd.DataFrame, least: float, similar: int) -> tuple[np.ndarray, np.ndarray]:
    """(asking rows, other rows) of the pairs of different groups that are not ruled out and share no earlier band."""
    asks = np.flatnonzero(rows["asks"].to_numpy())
    others = np.flatnonzero(~rows["asks"].to_numpy() | rows["single"].to_numpy())
    sign, label, n, point = _matrix(rows["signature"]), rows["label"].to_numpy(), rows["n"].to_numpy(), rows["point"].to_numpy()
    band = int(rows["bucket"].iloc[0]) % BANDS
    # By size, so that a slice of the asking rows meets only others of a size that can fit.
    asks, others = asks[np.argsort(n[asks], kind="stable")], others[np.argsort(n[others], kind="stable")]
    found = [(np.zeros(0, int), np.zeros(0, int))]
    for at in range(0, len(asks), 128):
        a = asks[at : at + 128]
        lo = np.searchsorted(n[others], -(-similar * n[a[0]] // 100))
        hi = np.searchsorted(n[others], 100 * n[a[-1]] // similar, side="right")
        o = others[lo:hi]
        small, large = np.minimum(n[a][:, None], n[o]), np.maximum(n[a][:, None], n[o])
        i, j = np.nonzero((label[a][:, None] != label[o][None, :]) & (_equal_places(sign[a], sign[o]) >= least) & (100 * small >= similar * large))
        i, j = a[i], o[j]
        shared = (sign[i] == sign[j]).reshape(len(i), BANDS, PLACES // BANDS).all(2)
        first = (point[i] != point[j]) & (shared.argmax(1) == band)
        found.append((i[first], j[first]))
    i, j = (np.concatenate(x) for x in zip(*found))
    return i, j


def hopeful(members: DataFrame, points: DataFrame, similar: int) -> DataFrame:
    """(bucket, point): members that have a possible partner of another group in the bucket."""
    least = least_equal(similar)

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        at = np.unique(np.concatenate(_crossing(rows, least, similar)))
        return pd.DataFrame({"bucket": rows["bucket"].to_numpy()[at], "point": rows["point"].to_numpy()[at]})

    whole = in_blocks(members).join(points.select("point", "n", "signature"), "point")
    return in_runs(whole, ["bucket", "outer", "inner"], work, "bucket long, point long")


class Overlaps:
    """Sizes of the intersections of one set of a block with all of them, through the block's own inverted index."""

    def __init__(self, packed):
        sets = [np.frombuffer(x, "<u8") for x in packed]
        self.sizes = np.array([len(x) for x in sets])
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.key = np.unique(np.concatenate(sets), return_inverse=True)[1]
        self.holders = np.repeat(np.arange(len(sets)), self.sizes)[np.argsort(self.key, kind="stable")]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(self.key))])

    def of(self, row: int) -> np.ndarray:
        keys = self.key[self.starts[row] : self.starts[row + 1]]
        lengths = self.first[keys + 1] - self.first[keys]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(self.first[keys] - ends + lengths, lengths)
        return np.bincount(self.holders[at], minlength=len(self.sizes))


def block_links(members: DataFrame, points: DataFrame, similar: int) -> DataFrame:
    """(point, pivot): links between different groups of a bucket, each pair of blocks joined exactly but for what is linked already."""
    least = least_equal(similar)

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        i, j = _crossing(rows, least, similar)
        if not len(i):
            return pd.DataFrame({"point": [], "pivot": []}, dtype="int64")
        met, at = np.unique(np.concatenate([i, j]), return_inverse=True)
        i, j = at[: len(i)], at[len(i) :]
        label, point, out = rows["label"].to_numpy()[met], rows["point"].to_numpy()[met], []
        overlaps = Overlaps(rows["shingles"].to_numpy()[met])
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        asks, cuts = np.unique(i, return_index=True)
        for a, others in zip(asks, np.split(j, cuts[1:])):
            others = others[label[others] != label[a]]
            if not len(others):
                continue
            both = overlaps.of(a)[others]
            for x in others[100 * both >= similar * (overlaps.sizes[a] + overlaps.sizes[others] - both)]:
                if label[x] != label[a]:
                    out.append((point[a], point[x]))
                    label[label == label[x]] = label[a]
        return pd.DataFrame(out, columns=["point", "pivot"], dtype="int64")

    asked = written(members.select("point").distinct(), "asked")
    sets = points.select("point", "n", "signature", "shingles").join(brought(asked), "point", "left_semi")
    whole = in_blocks(members).join(sets, "point")
    return in_runs(whole, ["bucket", "outer", "inner"], work, "point long, pivot long")


def linked(docs: DataFrame, points: DataFrame, width: int, similar: int) -> DataFrame:
    """(point, label) of all points that have a link; `points` has (key, point, signature)."""
    seen = bucketed(points)
    shared = seen.groupBy("bucket").agg(F.min("point").alias("low"), F.max("point").alias("high"), F.count(F.lit(1)).alias("rows")).filter("low <> high")
    members = written(seen.join(shared.select("bucket", "rows"), "bucket").distinct(), "members")
    # The text that others were copied from shares more and larger buckets than its copies do.
    central = members.groupBy("point").agg(F.sum("rows").alias("central"))
    pivots = members.join(central, "point").groupBy("bucket").agg(F.max_by("point", F.struct("central", "point")).alias("pivot"))
    wanted = points.join(members.select("point").distinct(), "point", "left_semi").groupBy("point").agg(F.min("key").alias("key"))
    able = written(full_sets(docs, wanted, width), "able")
    pairs = written(possible(members.join(pivots, "bucket").filter("point <> pivot").select("point", "pivot").distinct(), able, similar), "possible")
    links = written(verified(pairs, able, similar), "links")
    near = links.groupBy("point").agg(F.min("pivot").alias("label"))  # linked to the same pivot: surely of one group
    left = written(open_members(members.drop("rows"), near), "open")
    hope = written(hopeful(left, able, similar).distinct(), "hopeful")
    left = written(open_members(left.join(hope, ["bucket", "point"], "left_semi").select("bucket", "point"), near), "open")
    return components(links.unionByName(written(block_links(left, able, similar), "more")))


def grouped(docs: DataFrame, width: int = WIDTH, similar: int = SIMILAR) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per document."""
    docs = docs.select("doc_id", "text")
    told = written(read_sets(docs, width), "sets")
    rows = told.filter("kind = 0").select("doc_id", "point", F.col("n").alias("n_shingles"))
    labels = linked(docs, told.filter("kind = 1").select("key", "point", "signature"), width, similar)
    full = rows.filter("n_shingles > 0").join(labels, "point", "left").withColumn("label", F.coalesce("label", "point"))
    smallest = full.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    out = full.join(smallest, "label").select("doc_id", "n_shingles", "component_id")
    out = out.unionByName(rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def query(spark, sf: str) -> DataFrame:
    """Every document with its group, the first of each marked as kept."""
    return grouped(table(spark, sf, "documents"))


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END) AS s FROM words
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), pairs AS (
  SELECT a.doc_id AS p, b.doc_id AS q FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), edges AS (
  SELECT p, q FROM pairs UNION ALL SELECT q, p FROM pairs
), reach(doc_id, low) AS (
  SELECT DISTINCT p, p FROM edges UNION SELECT e.q, r.low FROM reach r JOIN edges e ON e.p = r.doc_id WHERE r.low < e.q
), lowest AS (
  SELECT doc_id, min(low) AS low FROM reach GROUP BY doc_id
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(least(l.low, s.doc_id), s.doc_id) AS component_id,
  s.doc_id = coalesce(least(l.low, s.doc_id), s.doc_id) AS kept
FROM sets s LEFT JOIN lowest l ON l.doc_id = s.doc_id
"""
