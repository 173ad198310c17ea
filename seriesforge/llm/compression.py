"""Quality classifier by compression.

Two zstandard dictionaries are trained from blocks of good and of bad labelled text. A text is
cut into blocks of `BLOCK` bytes, each compressed with either dictionary; whole texts are read.
The difference of the two total sizes over their sum says which kind the text resembles. A
logistic curve, fitted on labelled documents that trained neither dictionary, turns that
difference, together with how far the better dictionary and no dictionary compress the text,
into a score between 0 and 1.

Labels are read only of documents whose crc32(doc_id as text) mod 5 is not 0. The sample is the
documented bound of `PER_CLASS` documents a class for the dictionaries and as many for the
curve, those with the smallest hash; of each at most `BLOCKS` blocks, spread evenly over the
text, train a dictionary. lang, source and doc_id are no input of a score.

Defined results: a null or empty text gets the share of good documents in the sample; equal
texts get equal scores; with labels of one class only every score is that share, without labels
0.5; labels that are null or contradictory are not learned from; repeated rows are separate
rows; an empty table gives an empty table; other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from seriesforge.llm.common import in_batches, table, utf8

PER_CLASS = 1_500
BLOCK = 2_048
BLOCKS = 4
DICTIONARY = 64 * 1024
LEVEL = 3
THRESHOLD = 0.3


def blocks(text: bytes) -> list[bytes]:
    return [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]


class Sizes:
    """Compressed sizes of a text under the good, the bad and no dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        self.packers = [zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False)]
        for d in (good, bad):
            kept = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_AUTO)
            kept.precompute_compress(level=LEVEL)
            self.packers.append(zstandard.ZstdCompressor(dict_data=kept, write_checksum=False, write_content_size=False, write_dict_id=False))

    def features(self, text: bytes) -> tuple[float, float, float, float]:
        if not text:
            return 0.0, 0.0, 0.0, 0.0
        cut = blocks(text)
        none, good, bad = (sum(len(p.compress(b)) for b in cut) for p in self.packers)
        return (bad - good) / (bad + good), min(good, bad) / len(text), none / len(text), good / none


def train_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; text itself as raw content where there is too little to train from."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:] or b"\n" * 8


def _basis(x: np.ndarray) -> np.ndarray:
    """The features with their squares and products, so that the curve may bend."""
    n, k = x.shape
    more = [x[:, i] * x[:, j] for i in range(k) for j in range(i, k)]
    return np.column_stack([np.ones(n), x, *more])


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Logistic weights by Newton's method with a small penalty."""
    w = np.zeros(x.shape[1])
    keep = ridge * np.eye(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    centre: tuple[float, ...]
    spread: tuple[float, ...]
    weights: tuple[float, ...]
    prior: float

    def scores(self, texts) -> np.ndarray:
        if not self.weights:
            return np.full(len(texts), self.prior)
        sizes = Sizes(self.good, self.bad)
        x = np.array([sizes.features(t) for t in texts], float).reshape(-1, 4)
        z = (x - np.array(self.centre)) / np.array(self.spread)
        p = 1 / (1 + np.exp(-np.clip(_basis(np.clip(z, -6, 6)) @ np.array(self.weights), -30, 30)))
        empty = np.fromiter((not t for t in texts), bool, len(texts))
        return np.where(empty, self.prior, p)


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, per_class: int) -> pd.DataFrame:
    """(doc_id, quality, text, rank in class) of the bounded sample that may be learned from."""
    one = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_other"))
        .filter(F.col("quality") == F.col("_other"))
    )
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    parts = [one.filter(F.col("quality") == k).orderBy(*order).limit(2 * per_class) for k in (0, 1)]
    sample = parts[0].unionByName(parts[1]).select("doc_id", "quality")
    whole = docs.select("doc_id", utf8("text").alias("text")).join(F.broadcast(sample), "doc_id")
    # A block is cut out of the text in the executors: what reaches the driver is bounded.
    @pandas_udf("array<binary>")
    def some_blocks(texts: pd.Series) -> pd.Series:
        def pick(t):
            cut = blocks(t)
            return [cut[i] for i in sorted({int(x) for x in np.linspace(0, len(cut) - 1, BLOCKS)})] if cut else []

        return texts.map(pick)

    return whole.select("doc_id", "quality", some_blocks("text").alias("blocks"), F.xxhash64("doc_id").alias("h")).toPandas().sort_values(["h", "doc_id"])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    in_batches(docs)
    got = labelled(docs, labels, per_class)
    y = got["quality"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return Model(b"", b"", (), (), (), float(y.mean()) if len(y) else 0.5)
    samples: dict[int, list[bytes]] = {0: [], 1: []}
    curve_x, curve_y, seen = [], [], {0: 0, 1: 0}
    for q, cut in zip(got["quality"], got["blocks"]):
        seen[q] += 1
        if seen[q] % 2:
            samples[q].extend(bytes(b) for b in cut)
        elif len(cut):
            curve_x.append(b"".join(map(bytes, cut)))
            curve_y.append(q)
    good, bad = train_dictionary(samples[1]), train_dictionary(samples[0])
    sizes = Sizes(good, bad)
    x = np.array([sizes.features(t) for t in curve_x], float).reshape(-1, 4)
    yy = np.array(curve_y, float)
    # The classes are sampled alike; the weights bring them back to their shares among the labels.
    prior = float(labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).agg(F.avg("quality")).first()[0])
    if not len(yy) or yy.min() == yy.max():
        return Model(b"", b"", (), (), (), prior)
    centre, spread = x.mean(0), x.std(0) + 1e-9
    w = fit_curve(_basis(np.clip((x - centre) / spread, -6, 6)), yy)
    share = float(yy.mean())
    w[0] += np.log(prior / (1 - prior)) - np.log(share / (1 - share)) if 0 < prior < 1 else 0.0
    return Model(good, bad, tuple(centre), tuple(spread), tuple(w), prior)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with `score`."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(sent.value.scores(list(texts)))

    return in_batches(docs).withColumn("score", score(utf8("text")))


def query(spark, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf, "labels"))
    out = scored(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
