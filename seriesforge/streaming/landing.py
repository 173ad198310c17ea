"""Incremental landing with Structured Streaming.

Landed rows (key, content, seen) grow by files. A run processes what is new and stops
(`availableNow`); every micro-batch is one version of the landing's tables:

* `raw`: the rows whose content differs from the last landed content of their key;
* `content`: (key, content_hash) of these keys, the table later batches are compared with;
* `anomalies`: later prints of a (series_id, period) inside the batch that differ from the first;
* `values`: (series_id, period, value, previous) where the current value changed;
* `summaries`: the summary of every series that changed, and of no other.

Versions are folders `batch=N`, cut by a hash of the key into parts, so a batch reads only the
parts that it touches, and of these a snapshot and the versions behind it; raw rows of older
batches are never read again. `compact` writes the next snapshot. A batch that is repeated after
a failure reads what was there before it and replaces its own folders, so it gives the same again.

Defined results: rows without key are dropped; null content is content of its own; of equal rows
in one batch the earliest counts; a key that comes back to an older content has changed; within a
batch the first print of a (series_id, period) counts, between batches the later one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from seriesforge.operators.merge import anomalies, keep_first
from seriesforge.operators.summary import summarise

PARTS = 64  # of the key and series hashes
COMPACT_AFTER = 32  # versions behind the last snapshot


def landed_stream(spark: SparkSession, path: str, schema: StructType | str, max_files: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def complete_versions(spark: SparkSession, path: str, column: str) -> list[int]:
    """Numbers of the folders `column=N` that a finished job wrote, ascending."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop.Path(f"{path}/{column}=*/_SUCCESS"))
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])


@dataclass(frozen=True)
class Landing:
    """One landing: where its tables are and how a landed row becomes observations.

    `to_obs` maps rows of (key, content, content_hash, seen, ...) to (series_id, period, value, ord).
    """

    out: str
    to_obs: Callable[[DataFrame], DataFrame]
    key: str = "key"
    content: str = "content"
    seen: str = "seen"
    parts: int = PARTS
    compact_after: int = COMPACT_AFTER

    def _part(self, *columns: str) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(self.parts)).cast("int").alias("part")

    def _write(self, df: DataFrame, name: str, batch: int, parted: bool = True) -> None:
        w = df.write.mode("overwrite")
        (w.partitionBy("part") if parted else w).parquet(f"{self.out}/{name}/batch={batch:09d}")

    def _read(self, spark: SparkSession, root: str, column: str, versions: Sequence[int], schema: StructType) -> DataFrame:
        whole = StructType([*schema.fields, StructField("part", LongType()), StructField(column, LongType())])
        paths = [f"{root}/{column}={n:09d}" for n in versions]
        return spark.read.schema(whole).option("basePath", root).parquet(*paths)

    def state(self, spark: SparkSession, name: str, keys: Sequence[str], schema: StructType, before: int | None = None, parts: Sequence[int] | None = None) -> DataFrame:
        """The current row of every key of `name`, as of the batches before `before`; only of these parts, where they are given."""
        below = lambda found: [n for n in found if before is None or n < before]
        snapshots = below(complete_versions(spark, f"{self.out}/snapshot/{name}", "upto"))[-1:]
        later = [n for n in below(complete_versions(spark, f"{self.out}/{name}", "batch")) if not snapshots or n > snapshots[0]]
        found = []
        if snapshots:
            found.append(self._read(spark, f"{self.out}/snapshot/{name}", "upto", snapshots, schema).withColumnRenamed("upto", "batch"))
        if later:
            found.append(self._read(spark, f"{self.out}/{name}", "batch", later, schema))
        if not found:
            return spark.createDataFrame([], schema)
        found = [f if parts is None else f.filter(F.col("part").isin(list(parts))) for f in found]
        both = found[0] if len(found) == 1 else found[0].unionByName(found[1])
        rest = [f.name for f in schema.fields if f.name not in keys]
        if len(snapshots) + len(later) == 1:
            return both.select(*schema.names)
        return both.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_row")).select(*keys, "_row.*").select(*schema.names)

    def _content_schema(self, raw: DataFrame) -> StructType:
        return StructType([raw.schema[self.key], raw.schema["content_hash"]])

    def land(self, batch: DataFrame, number: int) -> None:
        """One version: what `batch` changes."""
        spark = batch.sparkSession
        self._land_content(spark, batch, number)
        raw = spark.read.parquet(f"{self.out}/raw/batch={number:09d}")
        obs = self.to_obs(raw)
        self._write(anomalies(obs), "anomalies", number, parted=False)
        self._land_values(spark, keep_first(obs), number)
        self._land_summaries(spark, number)
        if len(complete_versions(spark, f"{self.out}/values", "batch")) % self.compact_after == 0:
            self.compact(spark, number)

    def _land_content(self, spark: SparkSession, batch: DataFrame, number: int) -> None:
        hashed = batch.filter(F.col(self.key).isNotNull()).withColumn("content_hash", F.coalesce(F.sha2(F.col(self.content).cast("binary"), 256), F.lit("")))
        rest = [c for c in hashed.columns if c not in (self.key, "content_hash")]
        once = hashed.groupBy(self.key, "content_hash").agg(F.min_by(F.struct(*rest), self.seen).alias("_row")).select(self.key, "content_hash", "_row.*")
        parts = [r[0] for r in once.select(self._part(self.key)).distinct().collect()]  # at most `parts`
        known = self.state(spark, "content", [self.key], self._content_schema(hashed), number, parts)
        self._write(once.join(known, [self.key, "content_hash"], "left_anti"), "raw", number, parted=False)
        last = spark.read.parquet(f"{self.out}/raw/batch={number:09d}").groupBy(self.key).agg(F.max_by("content_hash", F.struct(self.seen, "content_hash")).alias("content_hash"))
        self._write(last.withColumn("part", self._part(self.key)), "content", number)

    @property
    def value_schema(self) -> StructType:
        return StructType.fromDDL("series_id string, period date, value double")

    def _land_values(self, spark: SparkSession, first: DataFrame, number: int) -> None:
        parts = [r[0] for r in first.select(self._part("series_id")).distinct().collect()]
        was = self.state(spark, "values", ["series_id", "period"], self.value_schema, number, parts).withColumnRenamed("value", "previous").withColumn("_was", F.lit(True))
        changed = first.join(was, ["series_id", "period"], "left").filter(F.col("_was").isNull() | ~F.col("value").eqNullSafe(F.col("previous")))
        self._write(changed.select("series_id", "period", F.col("value").cast("double").alias("value"), "previous", self._part("series_id")), "values", number)

    def _land_summaries(self, spark: SparkSession, number: int) -> None:
        touched = self._read(spark, f"{self.out}/values", "batch", [number], self.value_schema).select("series_id", "part").distinct()
        parts = [r[0] for r in touched.select("part").distinct().collect()]
        now = self.state(spark, "values", ["series_id", "period"], self.value_schema, number + 1, parts).join(touched.select("series_id"), "series_id", "left_semi")
        self._write(summarise(now).withColumn("part", self._part("series_id")), "summaries", number)

    def compact(self, spark: SparkSession, number: int) -> None:
        """Snapshots of all state up to and with batch `number`, which later reads start from."""
        for name, keys in (("content", [self.key]), ("values", ["series_id", "period"]), ("summaries", ["series_id"])):
            schema = self._stored_schema(spark, name)
            now = self.state(spark, name, keys, schema, number + 1).withColumn("part", self._part(keys[0]))
            now.repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{self.out}/snapshot/{name}/upto={number:09d}")

    def _stored_schema(self, spark: SparkSession, name: str) -> StructType:
        if name == "values":
            return self.value_schema
        stored = spark.read.parquet(f"{self.out}/{name}").schema
        return StructType([f for f in stored.fields if f.name not in ("part", "batch")])

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Land all that is new in `stream`, one version a micro-batch, then stop."""
        return stream.writeStream.foreachBatch(self.land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def current(self, spark: SparkSession) -> DataFrame:
        """(series_id, period, value) as of the last batch."""
        return self.state(spark, "values", ["series_id", "period"], self.value_schema)

    def summaries(self, spark: SparkSession) -> DataFrame:
        """The summary of every series as of the last batch that changed it."""
        return self.state(spark, "summaries", ["series_id"], self._stored_schema(spark, "summaries"))

    def revisions(self, spark: SparkSession) -> DataFrame:
        """(series_id, period, old_value, new_value, batch) of each change of a published value."""
        kept = spark.read.option("basePath", f"{self.out}/values").parquet(f"{self.out}/values")
        changed = kept.filter(F.col("previous").isNotNull())
        return changed.select("series_id", "period", F.col("previous").alias("old_value"), F.col("value").alias("new_value"), F.col("batch").cast("long").alias("batch"))


def merge_batches(batches: DataFrame) -> DataFrame:
    """Batch form of the landing: first print inside a batch, last batch wins.

    `batches` has series_id, period, value, ord, batch.
    """
    inside = batches.groupBy("series_id", "period", "batch").agg(F.min_by("value", "ord").alias("value"))
    return inside.groupBy("series_id", "period").agg(F.max_by("value", "batch").alias("value"))
