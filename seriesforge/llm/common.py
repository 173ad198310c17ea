"""Words, shared tables and batch sizes used by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.session import checkpoint_dir

#: A word is a run of anything but these six white-space characters; `bytes.split()` cuts at the same ones.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` as a table in the cluster's shared folder: computed once, safe against lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """Whole texts cross to Python in batches of so many rows, which bounds a worker's memory."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df


def bounded(df: DataFrame, rows: int = 500, size: int = 8 << 20) -> DataFrame:
    """Rows cross to Python in batches of so many, and of so many bytes whatever their number."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    return in_batches(df, rows)


def release() -> None:
    """Give a worker's free memory back to the system: between stages it stays alive beside the JVM, holding what it once needed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def utf8(column: str) -> Column:
    """The text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(column).cast("string").cast("binary"), F.lit(b""))


def fresh(df: DataFrame, *names: str) -> dict[str, str]:
    """For each name one that no column of `df` has, so that helper columns never clash."""
    taken, out = {c.lower() for c in df.columns}, {}
    for name in names:
        free = f"_{name}"
        while free.lower() in taken:
            free = f"_{free}"
        taken.add(free.lower())
        out[name] = free
    return out
