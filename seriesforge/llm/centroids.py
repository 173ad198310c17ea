"""Centroid clustering with equal-average equal-variance nearest-centroid search.

Lloyd's rounds over whole-number vectors. Centroids are sorted by component sum (their mean, up to
a constant) and a vector is searched outward from its own place in that order:

* mean inequality: 64 d^2 >= (S_x - S_c)^2 for 64 components of sums S; the scan goes to the nearer
  side first, so once this bound is above the best distance no further centroid can win;
* deviation inequality: with V^2 = 64 (sum of squares) - S^2 also
  64 d^2 >= (S_x - S_c)^2 + (V_x - V_c)^2; a centroid that fails it is passed over;
* a centroid that passes both gets its exact distance in 64-bit integers.

Bounds carry a margin above the rounding of doubles and only reject what is strictly worse, so ties
go to the smaller number, exactly as in a full search. Tasks return one partial sum for each
centroid; only the k centroids come to the driver, and every task gets them with its code.

Defined results: a vector of another length, null, or with a null or non-finite component is left
out, as the rest of its row is; components are floored after scaling and held within `BOUND`, so
that squared distances fit 64 bits; repeated rows are separate vectors, and equal seed hashes are
ordered by vector; rows with null vec_id are clustered but seed only if too few others are there;
with fewer vectors than k each vector seeds; an empty table gives an empty table; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import table, written

WIDTH = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
BOUND = 1 << 27
MARGIN = 1 + 1e-9


class Centroids:
    """Centroids in the order of their sums, with what the inequalities need."""

    def __init__(self, rows: np.ndarray):
        sums = rows.sum(1)
        self.number = np.lexsort((np.arange(len(rows)), sums))
        self.rows = rows[self.number]
        self.sums = sums[self.number].astype(float)
        self.spread = spread(self.rows, self.sums)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number, squared distance) for each row of x, and how many distances were computed."""
        n, k, width = len(x), len(self.rows), x.shape[1]
        sums = x.sum(1).astype(float)
        deviation = spread(x, sums)
        best = np.full(n, np.iinfo(np.int64).max)
        limit = np.full(n, np.inf)  # width * best, with the margin
        who = np.full(n, k)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        alive, computed = np.arange(n), 0
        while len(alive):
            lo, hi, s = left[alive], right[alive], sums[alive]
            down = np.where(lo >= 0, s - self.sums[lo], np.inf)
            up = np.where(hi < k, self.sums[np.minimum(hi, k - 1)] - s, np.inf)
            lower = down <= up
            gap = np.minimum(down, up) ** 2
            on = np.isfinite(gap) & (gap <= limit[alive])
            alive, lower, gap = alive[on], lower[on], gap[on]
            at = np.where(lower, left[alive], right[alive])
            left[alive[lower]] -= 1
            right[alive[~lower]] += 1
            able = gap + (deviation[alive] - self.spread[at]) ** 2 <= limit[alive]
            rows, at = alive[able], at[able]
            if len(rows):
                apart = x[rows] - self.rows[at]
                d = np.einsum("ij,ij->i", apart, apart)
                computed += len(rows)
                number = self.number[at]
                won = (d < best[rows]) | ((d == best[rows]) & (number < who[rows]))
                rows, d = rows[won], d[won]
                best[rows], who[rows] = d, number[won]
                limit[rows] = d.astype(float) * width * MARGIN + 1
        return who, best, computed


def spread(x: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """sqrt(width * sum of squares - square of the sum): width times the standard deviation."""
    mean = sums / x.shape[1]
    return np.sqrt(((x - mean[:, None]) ** 2).sum(1) * x.shape[1])


def integers(batch: pa.RecordBatch, width: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in the batch, whole-number rows) of the vectors that are kept."""
    column = batch.column("vector")
    right = np.flatnonzero(np.asarray(pc.fill_null(pc.equal(pc.list_value_length(column), width), False)))
    flat = pc.list_flatten(column.take(pa.array(right)))
    x = np.asarray(pc.fill_null(flat, float("nan"))).astype(float).reshape(-1, width)
    good = np.isfinite(x).all(1)
    return right[good], np.clip(np.floor(x[good] * scale), -BOUND, BOUND).astype(np.int64)


def kept(vectors: DataFrame, width: int = WIDTH, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the vectors that are clustered."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    narrow = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    return narrow.filter((F.size(v) == width) & finite)


def seeds(points: DataFrame, k: int, scale: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest hashes of seed and id, as whole numbers."""
    hashed: Column = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = points.orderBy(hashed.asc_nulls_last(), "vector").limit(k).select("vector").collect()
    return np.clip(np.floor(np.array([r[0] for r in first], float) * scale), -BOUND, BOUND).astype(np.int64)


def assigned(points: DataFrame, centroids: np.ndarray, width: int, scale: int) -> DataFrame:
    """(vec_id, cluster, distance) for every vector."""
    search = Centroids(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, x = integers(b, width, scale)
            who, d, _ = search.nearest(x)
            yield pa.RecordBatch.from_arrays([b.column("vec_id").take(pa.array(at)), pa.array(who, pa.int32()), pa.array(d, pa.int64())], ["vec_id", "cluster", "distance"])

    return points.mapInArrow(run, "vec_id long, cluster int, distance long")


def moved(points: DataFrame, centroids: np.ndarray, width: int, scale: int) -> np.ndarray:
    """Centroids after one round: each the floored mean of its vectors, or as it was without any."""
    search = Centroids(centroids)
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for b in batches:
            _, x = integers(b, width, scale)
            who, _, _ = search.nearest(x)
            order = np.argsort(who, kind="stable")
            here, first = np.unique(who[order], return_index=True)
            if len(here):
                sums[here] += np.add.reduceat(x[order], first)
                counts += np.bincount(who, minlength=k)
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(range(k), pa.int32()), "counted": pa.array(counts), "sums": pa.array(list(sums), pa.list_(pa.int64()))})

    parts = points.mapInArrow(run, "cluster int, counted long, sums array<long>").filter("counted > 0")
    whole = parts.groupBy("cluster").agg(F.sum("counted"), *[F.sum(F.col("sums")[i]) for i in range(width)])
    out = centroids.copy()
    for cluster, counted, *sums in whole.collect():  # at most k rows
        out[cluster] = np.array(sums, np.int64) // counted
    return out


def clustered(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: int = 1,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance), centroids) after so many rounds and one more assignment."""
    points = kept(vectors, width, id_column, vector_column)
    centroids = seeds(points, k, scale, seed).reshape(-1, width)
    if not len(centroids):
        return points.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for _ in range(rounds):
        centroids = moved(points, centroids, width, scale)
    return assigned(points, centroids, width, scale), centroids


def query(spark, sf: str) -> DataFrame:
    """Every kept vector with its cluster, and the sums and digests of the clusters."""
    found, centroids = clustered(table(spark, sf, "embeddings"))
    found = written(found, "clusters")
    parts = {r[0]: int(r[1]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}  # at most k rows
    digest = {c: hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for c, row in enumerate(centroids.tolist())}
    told = [(c, part, sum(parts.values()), digest[c]) for c, part in parts.items()]
    of_cluster = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(of_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(k: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """Full search in plain SQL, one pair of tables a round."""
    near = (
        "SELECT key, vec_id, v, cluster, distance FROM (SELECT p.*, c.cluster, list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance "
        "FROM kept p CROSS JOIN c{r} c) QUALIFY row_number() OVER (PARTITION BY key ORDER BY distance, cluster) = 1"
    )
    step = (
        "SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (SELECT cluster, list(m ORDER BY i) AS v FROM "
        "(SELECT cluster, i, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m FROM "
        "(SELECT cluster, unnest(v) AS x, unnest(range(64)) AS i FROM a{r}) GROUP BY cluster, i) GROUP BY cluster) m ON m.cluster = c.cluster"
    )
    parts = [
        "kept AS (SELECT row_number() OVER () AS key, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings "
        "WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)",
        f"c0 AS (SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1)::INTEGER AS cluster, v FROM kept QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id), v) <= {k})",
    ]
    for r in range(rounds):
        parts += [f"a{r} AS ({near.format(r=r)})", f"c{r + 1} AS ({step.format(r=r)})"]
    parts.append(f"final AS ({near.format(r=rounds)})")
    return (
        "WITH " + ", ".join(parts) + " SELECT f.vec_id, f.cluster, f.distance, (sum(f.distance) OVER (PARTITION BY f.cluster))::BIGINT AS cluster_inertia, "
        f"(sum(f.distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM final f JOIN c{rounds} c ON c.cluster = f.cluster"
    )


SQL = _sql()
