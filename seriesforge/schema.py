"""Struct types of the published tables."""

from __future__ import annotations

from pyspark.sql import types as T

OBSERVATION = T.StructType(
    [
        T.StructField("series_id", T.StringType(), False),
        T.StructField("period", T.DateType(), False),
        T.StructField("value", T.DoubleType(), False),
    ]
)

OBSERVATION_RAW = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("period", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

CATALOG = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("title_en", T.StringType()),
        T.StructField("title_ar", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("family", T.StringType()),
        T.StructField("freq", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("derived", T.BooleanType()),
        T.StructField("method", T.StringType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("period_basis", T.StringType()),
        T.StructField("fiscal_year_basis", T.StringType()),
    ]
)

PAGE = T.StructType(
    [
        T.StructField("page", T.IntegerType()),
        T.StructField("chars", T.IntegerType()),
        T.StructField("lang", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("text_norm", T.StringType()),
    ]
)

PAGE_DOCUMENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField("url", T.StringType()),
        T.StructField("needs_ocr", T.BooleanType()),
        T.StructField("ocr", T.BooleanType()),
        T.StructField("page_count", T.IntegerType()),
        T.StructField("pages", T.ArrayType(PAGE)),
    ]
)

MANIFEST_DOCUMENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("is_file", T.BooleanType()),
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField("local", T.StringType()),
        T.StructField("sha256", T.StringType()),
        T.StructField("bytes", T.LongType()),
    ]
)

CELL = T.StructType(
    [
        T.StructField("file_id", T.StringType()),
        T.StructField("r", T.IntegerType()),
        T.StructField("c", T.IntegerType()),
        T.StructField("v", T.StringType()),
        T.StructField("is_text", T.BooleanType()),
    ]
)

MERGE = T.StructType(
    [
        T.StructField("file_id", T.StringType()),
        T.StructField("r0", T.IntegerType()),
        T.StructField("c0", T.IntegerType()),
        T.StructField("r1", T.IntegerType()),
        T.StructField("c1", T.IntegerType()),
    ]
)

LISTING_ITEM = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("customDate", T.StringType()),
        T.StructField(
            "categories",
            T.ArrayType(
                T.StructType(
                    [T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
                )
            ),
        ),
    ]
)

LISTING_PAGE = T.StructType(
    [
        T.StructField("totalResultsCount", T.LongType()),
        T.StructField("results", T.ArrayType(LISTING_ITEM)),
    ]
)
