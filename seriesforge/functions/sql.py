"""The column functions as SQL functions of a session.

Each is registered with the expression that its column form has, so a `SELECT` and a DataFrame
compute the same thing, inside Catalyst and without Python. Functions whose expression holds an
array lambda have no SQL body and are left to the DataFrame side: `shard`, `label_unit`,
`caption_unit`, `sentences` and the HTML readers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from seriesforge.functions import dates, ids, numbers, reading, text, units

#: Name to (typed arguments, column function of them).
FUNCTIONS: dict[str, tuple[str, Callable[..., Column]]] = {
    "number": ("x string", numbers.number),
    "sheet_number": ("x string", lambda x: numbers.number(x, "sheet")),
    "period": ("x string", dates.period),
    "period_range": ("x string", lambda x: dates.period(x, "period_range")),
    "period_mon_year": ("x string", lambda x: dates.period(x, "mon_year")),
    "period_mon_year_text": ("x string", lambda x: dates.period(x, "mon_year_text")),
    "period_dmy_text": ("x string", lambda x: dates.period(x, "dmy_text")),
    "month_token": ("x string", dates.month_token),
    "year_token": ("x string", dates.year_token),
    "quarter_token": ("x string", dates.quarter_token),
    "fiscal_year": ("d date", dates.fiscal_year),
    "month_end": ("y int, m int", dates.month_end),
    "key_slug": ("x string", ids.key_slug),
    "label_slug": ("x string", ids.label_slug),
    "document_id": ("url string", ids.document_id),
    "part_family": ("series_id string", ids.part_family),
    "file_extension": ("url string", ids.file_extension),
    "is_file_url": ("url string", ids.is_file_url),
    "tenor_bucket": ("days int", reading.tenor_bucket),
    "against_median": ("latest double, median double", reading.against_median),
    "age_label": ("last date, as_of date", reading.age_label),
    "direction": ("change double, unit string", reading.direction),
    "table_of": ("title string, dataset string", reading.table_of),
    "topic_of": ("family string", reading.topic_of),
    "stale_limit": ("freq string", reading.stale_limit),
    "indent_level": ("label string", units.indent_level),
    "fold": ("x string", text.fold),
}


def body_of(spark: SparkSession, arguments: str, function: Callable[..., Column]) -> tuple[str, str]:
    """(expression in SQL, type) of a column function over arguments of these names."""
    frame = spark.createDataFrame([], arguments)
    told = frame.select(function(*[F.col(c) for c in frame.columns]).alias("out"))
    return told._jdf.queryExecution().analyzed().projectList().head().child().sql(), told.schema["out"].dataType.simpleString()


def register(spark: SparkSession, prefix: str = "sf_", only: Sequence[str] | None = None) -> list[str]:
    """Temporary SQL functions `<prefix><name>` in this session; their names."""
    made = []
    for name in only or FUNCTIONS:
        arguments, function = FUNCTIONS[name]
        body, kind = body_of(spark, arguments, function)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({arguments}) RETURNS {kind} RETURN {body}")
        made.append(prefix + name)
    return made
