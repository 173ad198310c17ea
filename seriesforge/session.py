"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Parquet files that are already sorted by (series_id, period) prune best when
    # a scan task stays close to one row-group run.
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    # A union that keeps its branches' partitioning breaks where one branch is found empty at run time.
    "spark.sql.unionOutputPartitioning": "false",
}


def build(app: str = "seriesforge", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; `conf` keys use `__` for dots."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(DEFAULTS)
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, as the session names it.

    A folder of our own is made only where none is named and the master is local,
    which happens in tests.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
            named = tempfile.mkdtemp(prefix="spark-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` computed once into the cluster's shared folder and read from there: safe against lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/stored-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
