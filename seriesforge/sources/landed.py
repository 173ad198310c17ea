"""Scans of landed files."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge import schema
from seriesforge.functions import ids


def raw_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Landed responses, one file each: (dataset, variant, path, html).

    Files are `<key>.html[.gz]` or `<key>.<variant>.html[.gz]`; gzip is transparent.
    """
    name = F.element_at(F.split("path", "/"), -1)
    parts = F.split(F.regexp_replace(name, r"\.html(\.gz)?$", ""), r"\.")
    return (
        spark.read.text(path, wholetext=True)
        .select(F.col("value").alias("html"), F.col("_metadata.file_path").alias("path"))
        .withColumn("dataset", F.get(parts, F.lit(0)))
        .withColumn("variant", F.get(parts, F.lit(1)))
        .select("dataset", "variant", "path", "html")
    )


def series_csv(spark: SparkSession, path: str) -> DataFrame:
    """Tidy series files; rows with a missing key or an unreadable value are skipped."""
    raw = spark.read.schema(schema.OBSERVATION_RAW).option("header", True).option("escape", '"').csv(path)
    return readable_observations(raw)


def readable_observations(raw: DataFrame) -> DataFrame:
    return (
        raw.select(
            "series_id",
            F.col("period").try_cast("date").alias("period"),
            F.col("value").try_cast("double").alias("value"),
        )
        .filter(F.col("series_id").isNotNull() & F.col("period").isNotNull() & F.col("value").isNotNull())
    )


def published_series(spark: SparkSession, path: str, series_id: str) -> DataFrame:
    """One series of the published table: the family prunes partitions, the id row groups."""
    name = ids.part_family_of(series_id)
    return spark.read.parquet(path).filter((F.col("part_family") == name) & (F.col("series_id") == series_id))


def catalog_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.CATALOG).option("multiLine", True).json(path)


def manifest_json(spark: SparkSession, path: str) -> DataFrame:
    """Document manifest: either a bare list or `{"documents": [...]}`."""
    from pyspark.sql import types as T

    wrapped = T.StructType([T.StructField("documents", T.ArrayType(schema.MANIFEST_DOCUMENT))])
    return (
        spark.read.schema(wrapped).option("multiLine", True).json(path)
        .select(F.explode("documents").alias("d"))
        .select("d.*")
    )


def page_documents(spark: SparkSession, path: str) -> DataFrame:
    """Page documents, one JSON object a file or line, gzip transparent."""
    return spark.read.schema(schema.PAGE_DOCUMENT).option("multiLine", True).json(path)


def explode_pages(docs: DataFrame) -> DataFrame:
    """Nested pages to one row per page."""
    head = [c for c in docs.columns if c not in ("pages", "page_count")]
    return docs.select(*head, F.explode("pages").alias("_p")).select(
        F.col("id").alias("doc_id"), *[c for c in head if c != "id"], "_p.*"
    )


def record_tables(spark: SparkSession, path: str) -> DataFrame:
    """Record tables as printed: header names and strings, nothing inferred."""
    return spark.read.option("header", True).option("inferSchema", False).option("escape", '"').csv(path)


def listing_items(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Landed listing pages of several sources as one stream of items in walk order."""
    parts = []
    for rank, (kind, path) in enumerate(paths.items()):
        pages = spark.read.schema(schema.LISTING_PAGE).option("multiLine", True).json(path)
        items = pages.select(
            F.col("_metadata.file_path").alias("_file"), F.posexplode("results").alias("_pos", "item")
        )
        parts.append(
            items.select(
                F.lit(kind).alias("source"),
                F.struct(F.lit(rank).alias("source_rank"), "_file", "_pos").alias("ord"),
                "item.*",
            )
        )
    return reduce(lambda a, b: a.unionByName(b), parts).filter(F.coalesce("url", F.lit("")) != "")


def manifest_from_items(items: DataFrame) -> DataFrame:
    """Items to manifest rows: one per url, categories of every listing united."""
    from seriesforge.operators.merge import merge_items

    named = items.select(
        ids.document_id(F.col("url")).alias("id"), "ord", "source",
        F.trim(F.coalesce("title", F.lit(""))).alias("title"),
        F.substring(F.coalesce("customDate", F.lit("")), 1, 10).alias("date"),
        "url",
        ids.is_file_url(F.col("url")).alias("is_file"),
        F.explode_outer(F.transform("categories", lambda c: c["value"])).alias("category"),
    )
    return merge_items(named, "id", "ord", ["source", "title", "date", "url", "is_file"])


def cells(spark: SparkSession, path: str) -> DataFrame:
    """Landed spreadsheet cells, without blank ones."""
    from seriesforge.sources.grids import within_caps

    return within_caps(spark.read.schema(schema.CELL).parquet(path))


def merges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.MERGE).parquet(path)

