"""Published tables.

Files are written by range of (part_family, series_id, period), so a family or a
series that holds a third of the rows is split over as many files as its share,
and every file has tight min/max statistics for row-group skipping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.functions import ids
from seriesforge.functions.text import readable
from seriesforge.operators import search
from seriesforge.operators import summary as summary_ops
from seriesforge.operators.quality import SCAN_THRESHOLD
from seriesforge.operators.shape import series_documents

# Rows of (series_id, period, value) that make up about 100k-row groups under ZSTD.
ROW_GROUP_BYTES = 4 * 1024 * 1024


def tidy_layout(obs: DataFrame, files: int | None = None) -> DataFrame:
    """Range-partitioned and sorted (part_family, series_id, period, value)."""
    keyed = obs.select("series_id", "period", "value", ids.part_family(F.col("series_id")).alias("part_family"))
    by = ["part_family", "series_id", "period"]
    ranged = keyed.repartitionByRange(files, *by) if files else keyed.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by)


def write_series(obs: DataFrame, path: str, files: int | None = None) -> None:
    (
        tidy_layout(obs, files)
        .write.mode("overwrite")
        .partitionBy("part_family")
        .option("compression", "zstd")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .parquet(path)
    )


def write_series_csv(obs: DataFrame, path: str) -> None:
    by = ["series_id", "period"]
    obs.select("series_id", "period", "value").repartitionByRange(*by).sortWithinPartitions(*by).write.mode(
        "overwrite"
    ).option("header", True).csv(path)


def write_records(rows: DataFrame, path: str, dataset: str) -> None:
    """A record table as printed. Every column stays text."""
    text = rows.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in rows.columns])
    text.write.mode("overwrite").parquet(f"{path}/dataset={dataset}")


def write_catalog(catalog: DataFrame, path: str) -> None:
    catalog.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_landed(changed: DataFrame, path: str) -> None:
    """Append only: what was served before stays readable."""
    changed.write.mode("append").parquet(path)


def write_anomalies(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def family_counts(obs: DataFrame) -> DataFrame:
    return obs.groupBy(ids.part_family(F.col("series_id")).alias("part_family")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("series_id").alias("series")
    )


def series_json(obs: DataFrame, catalog: DataFrame, attribution: str = "") -> DataFrame:
    """(part_family, series_id, json): metadata, ordered observations and count per series."""
    docs = series_documents(obs).join(catalog, "series_id", "left")
    meta = [c for c in catalog.columns if c != "series_id"]
    pairs = F.transform(
        "observations", lambda o: F.array(F.concat(F.lit('"'), o["period"].cast("string"), F.lit('"')), o["value"].cast("string"))
    )
    body = F.to_json(F.struct("series_id", *meta, "count", F.lit(attribution).alias("attribution")))
    points = F.concat(
        F.lit('"observations":['),
        F.array_join(F.transform(pairs, lambda p: F.concat(F.lit("["), F.array_join(p, ","), F.lit("]"))), ","),
        F.lit("]"),
    )
    return docs.select(
        ids.part_family(F.col("series_id")).alias("part_family"),
        "series_id",
        F.concat(F.regexp_replace(body, r"\}$", ","), points, F.lit("}")).alias("json"),
    )


def write_series_json(docs: DataFrame, path: str) -> None:
    """One JSON dataset partitioned by family, not a file per series."""
    (
        docs.repartitionByRange("part_family", "series_id")
        .select("part_family", F.col("json").alias("value"))
        .write.mode("overwrite").partitionBy("part_family").option("compression", "gzip").text(path)
    )


def catalog_index(summaries: DataFrame) -> DataFrame:
    """Index rows; nulls are left out of the JSON by `to_json`."""
    move = F.when(
        F.col("move_period").isNotNull(),
        F.struct(F.col("move_period").alias("period"), F.col("move_pct").alias("pct_change"),
                 F.col("move_abs_pct").alias("abs_pct"), F.col("move_change").alias("change")),
    )
    keep = [c for c in ("title_en", "title_ar", "family", "freq", "unit") if c in summaries.columns]
    stale = F.col("stale_days") if "stale_days" in summaries.columns else F.lit(None).cast("int")
    return summaries.select(
        "series_id", *keep, "n",
        F.col("first_period").alias("first"), F.col("last_period").alias("last"),
        F.col("last").alias("latest_value"),
        F.struct(F.col("highest").alias("value"), F.col("highest_period").alias("period")).alias("highest"),
        F.struct(F.col("lowest").alias("value"), F.col("lowest_period").alias("period")).alias("lowest"),
        "previous", "median", move.alias("biggest_move"),
        stale.alias("stale_days"), "zero_values",
        F.nullif("duplicate_periods", F.lit(0)).alias("duplicate_periods"),
    )


def index_json(index: DataFrame) -> DataFrame:
    return index.select("series_id", F.to_json(F.struct("*")).alias("json"))


def sparklines(obs: DataFrame, points: int = 48) -> DataFrame:
    """Sampled readings of each series, at most points + 1 values."""
    sampled = summary_ops.even_sample(obs, points)
    ordered = F.array_sort(F.collect_list(F.struct("pos", "value")))
    return sampled.groupBy("series_id").agg(F.transform(ordered, lambda s: s["value"]).alias("values"))


def coverage_rows(summaries: DataFrame) -> DataFrame:
    """Report rows: the count line, then one line per series, then one per flagged series."""
    flagged = summary_ops.flag_sentences(summaries)
    total = summaries.agg(F.count(F.lit(1)).alias("_s"), F.sum("n").alias("_n")).select(
        F.lit(0).alias("section"), F.lit("").alias("series_id"),
        F.format_string("**%d series, %s observations.**", F.col("_s"), F.format_number("_n", 0)).alias("line"),
    )
    unit = F.coalesce("unit", F.lit("")) if "unit" in summaries.columns else F.lit("")
    table = summaries.select(
        F.lit(1).alias("section"), "series_id",
        F.concat(
            F.lit("| `"), "series_id", F.lit("` | "), F.col("first_period").cast("string"), F.lit(" to "),
            F.col("last_period").cast("string"), F.lit(" | "), F.format_number("n", 0), F.lit(" | "),
            F.format_string("%.6g", "last"), F.lit(" | "), unit, F.lit(" |"),
        ).alias("line"),
    )
    notes = flagged.filter(F.size("flags") > 0).select(
        F.lit(2).alias("section"), "series_id",
        F.concat(F.lit("- `"), "series_id", F.lit("` -- "), F.array_join("flags", "; ")).alias("line"),
    )
    return total.unionByName(table).unionByName(notes)


def write_report(rows: DataFrame, path: str) -> None:
    """The report as text: one line a series, range-sorted into as many files as it needs."""
    rows.repartitionByRange("section", "series_id").sortWithinPartitions("section", "series_id").select("line").write.mode(
        "overwrite"
    ).text(path)


def status_row(summaries: DataFrame, documents: DataFrame, built_at: Column, last_scrape: Column) -> DataFrame:
    """Counts of everything published, as one row; the parts are united, not crossed."""
    parts = summaries.agg(F.count(F.lit(1)).alias("series"), F.sum("n").alias("observations")).unionByName(
        documents.agg(F.count(F.lit(1)).alias("documents")), allowMissingColumns=True
    )
    return parts.agg(*[F.max(c).alias(c) for c in ("series", "observations", "documents")]).select(
        built_at.alias("built_at"), last_scrape.alias("last_scrape"), "series", "observations", "documents"
    )


def published_pages(pages: DataFrame, compose: bool = True, doc: str = "doc_id", limit: int | None = None) -> DataFrame:
    """Publishable page text, one row a page; empty pages are left out. Cut only where a `limit` is given."""
    text = F.col("_r.text") if limit is None else F.substring("_r.text", 1, limit)
    cut = F.lit(False) if limit is None else F.length("_r.text") > limit
    return (
        pages.withColumn("_r", readable(F.col("text"), compose))
        .select(doc, "page", text.alias("text"), F.col("_r.lost").alias("lost"), cut.alias("truncated"))
        .filter(F.length("text") > 0)
    )


def write_search_index(postings: DataFrame, docs: DataFrame, meta: DataFrame, path: str) -> None:
    """Postings by shard, sorted by term; documents and metadata beside them."""
    (
        postings.repartitionByRange("shard", "term", "doc_id")
        .sortWithinPartitions("shard", "term", "doc_id", "page")
        .write.mode("overwrite").partitionBy("shard").option("compression", "zstd").parquet(f"{path}/postings")
    )
    docs.write.mode("overwrite").parquet(f"{path}/documents")
    meta.write.mode("overwrite").json(f"{path}/meta")


def build_search_index(
    pages: DataFrame, folded: Column, path: str, docs: DataFrame, doc: str = "doc_id",
    fraction: float | None = None, cap: int | None = None,
) -> None:
    """Build and publish an index in steps.

    Counted postings and the term table are written first: they feed the capped terms
    and the published postings, and a table on shared storage survives lost executors
    where recounting the text three times would not pay.
    """
    spark = pages.sparkSession
    counted = f"{path}/counted"
    search.term_counts(pages, folded, doc).write.mode("overwrite").parquet(counted)
    postings = spark.read.parquet(counted)
    search.term_table(postings, pages, fraction).write.mode("overwrite").parquet(f"{path}/terms")
    terms = spark.read.parquet(f"{path}/terms")
    write_search_index(
        search.published_postings(postings, terms, cap), docs, search.index_metadata(pages, terms, doc), path
    )


def write_posting_blocks(postings: DataFrame, path: str, documents: int, per_stretch: int = search.STRETCH_DOCUMENTS) -> DataFrame:
    """Postings (term, doc_id, page, tf, shard) as blocks, partitioned by shard and sorted by term; read back from `path`."""
    stretches = search.stretch_count(documents, per_stretch)
    return _write_blocks(search.posting_blocks(postings, stretches), path, documents, stretches)


def write_page_blocks(pages: DataFrame, folded: Column, path: str, documents: int, per_stretch: int = search.STRETCH_DOCUMENTS, doc: str = "doc_id") -> DataFrame:
    """The blocks of all terms of the pages, written as `write_posting_blocks` does, without a shuffle of their postings."""
    stretches = search.stretch_count(documents, per_stretch)
    return _write_blocks(search.page_blocks(pages, folded, stretches, _tasks(pages, documents), doc), path, documents, stretches)


def _tasks(df: DataFrame, documents: int) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-documents // search.TASK_DOCUMENTS))


def _write_blocks(blocks: DataFrame, path: str, documents: int, stretches: int) -> DataFrame:
    # Dealt by shard and part of the stretches: no sample of the keys, which would work the blocks out twice.
    part = F.pmod(F.col("stretch"), F.lit(-(-stretches // search.FILE_STRETCHES)))
    dealt = blocks.repartition(_tasks(blocks, documents), "shard", part)
    dealt.sortWithinPartitions("shard", "term", "stretch").write.mode("overwrite").partitionBy("shard").option("compression", "zstd").parquet(path)
    return blocks.sparkSession.read.parquet(path)


def write_trigrams(rows: DataFrame, key: str, path: str, hay: str = "hay") -> tuple[DataFrame, DataFrame]:
    """(rows, postings) read back from `path`: the folded texts by key, and their trigrams by shard, sorted."""
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(f"{path}/texts")
    texts = spark.read.parquet(f"{path}/texts")
    postings = search.trigram_postings(texts, key, hay)
    postings.repartitionByRange("shard", "piece", key).sortWithinPartitions("shard", "piece", key).write.mode("overwrite").partitionBy("shard").parquet(f"{path}/trigrams")
    return texts, spark.read.parquet(f"{path}/trigrams")


def integrity_manifest(spark: SparkSession, root: str) -> DataFrame:
    """path, bytes and sha256 of every published file."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*").load(root)
    )
    prefix = root if "://" in root or root.startswith("file:") else "file:" + root
    return files.select(
        F.regexp_replace(F.col("path"), "^" + prefix.rstrip("/").replace(".", r"\.") + "/?", "").alias("path"),
        F.col("length").alias("bytes"),
        F.sha2("content", 256).alias("sha256"),
    )


def refresh_manifest(old: DataFrame, present: DataFrame) -> DataFrame:
    """Old entries of files still present, plus files the old manifest did not have."""
    kept = old.join(present.select("path"), "path", "left_semi")
    return kept.unionByName(present.join(old.select("path"), "path", "left_anti"))


def manifest_changes(old: DataFrame, present: DataFrame) -> DataFrame:
    gone = old.join(present.select("path"), "path", "left_anti").select("path", F.lit("vanished").alias("change"))
    new = present.join(old.select("path"), "path", "left_anti").select("path", F.lit("new").alias("change"))
    return gone.unionByName(new)


def dominant_language(pages: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Most frequent page language of each document; the first seen on a tie."""
    by_lang = pages.groupBy(doc, "lang").agg(
        F.count(F.lit(1)).alias("_n"), F.min("page").alias("_first"), F.sum("chars").alias("_chars")
    )
    return by_lang.groupBy(doc).agg(
        F.max_by("lang", F.struct(F.col("_n"), -F.col("_first"))).alias("lang"),
        F.sum("_n").alias("pages"),
        F.sum("_chars").alias("chars"),
    )


def extraction_report(pages: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Documents and pages by dominant language, and how many need recognition."""
    docs = dominant_language(pages, doc)
    return docs.groupBy("lang").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("pages").alias("pages"),
        F.count_if(F.col("chars") < F.col("pages") * SCAN_THRESHOLD).alias("needs_ocr"),
    )


def extraction_status(manifest: DataFrame, pages: DataFrame, failures: DataFrame, doc: str = "doc_id") -> DataFrame:
    """One row a document of the manifest: what its extraction gave, and why nothing where it gave nothing.

    `failures` has the document and a reason. A document is failed, missing (no page, no failure),
    empty (pages without a character), needs_ocr, or read.
    """
    told = manifest.select(doc).join(dominant_language(pages, doc), doc, "left").join(failures.groupBy(doc).agg(F.min("reason").alias("reason")), doc, "left")
    status = (
        F.when(F.col("reason").isNotNull(), F.lit("failed"))
        .when(F.col("pages").isNull(), F.lit("missing"))
        .when(F.coalesce("chars", F.lit(0)) == 0, F.lit("empty"))
        .when(F.col("chars") < F.col("pages") * SCAN_THRESHOLD, F.lit("needs_ocr"))
        .otherwise(F.lit("read"))
    )
    return told.select(doc, status.alias("status"), "lang", "pages", "chars", "reason")
