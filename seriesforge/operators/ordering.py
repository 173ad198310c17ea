"""Places in an order, newest rows, groups by size, and exact medians of hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.session import stored

CUTS = 64  # value ranges of one round, about
SMALL = 10_000  # rows of a key whose median is read off directly
ROW_BITS = 33  # Spark's row numbers: the partition above, the row of it below


def positions(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """`df` in `order`, each row with its place from 0 on.

    The rows are dealt by ranges of the order and sorted inside them; a range's rows begin behind
    the sum of the counts before it. Only the counts, a row a partition, are ever brought together.
    Rows that `order` does not tell apart are equal in it; add columns to settle their places.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    kept = stored(ranged, "ranged").withColumn("_range", F.shiftright("_id", ROW_BITS))
    counts = kept.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return kept.join(starts, "_range").withColumn(name, place.cast("bigint")).select(*df.columns, name)


def newest_first(manifest: DataFrame) -> DataFrame:
    """Documents by (date, title) descending, with `position`; equal ones by id."""
    return positions(manifest, [F.col("date").desc_nulls_last(), F.col("title").desc_nulls_last(), F.col("id").asc()])


def by_category(files: DataFrame) -> DataFrame:
    """Archive files by (category, url) ascending, with `position`."""
    return positions(files, [F.col("category").asc_nulls_first(), F.col("url").asc()])


def newest(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows of an order, gathered from each partition's own first n."""
    return df.orderBy(*order).limit(n)


def groups_by_size(df: DataFrame, group: Column, name: str = "group", counted: str = "members") -> DataFrame:
    """(group, members, position): groups by size, equal ones by name."""
    sizes = df.groupBy(group.alias(name)).agg(F.count(F.lit(1)).alias(counted))
    return positions(sizes, [F.col(counted).desc(), F.col(name).asc_nulls_first()])


def _between_cuts(v: Column, cuts: Column) -> Column:
    """2i for a value between the cuts i-1 and i, 2i + 1 for the cut i itself."""
    return (F.size(F.filter(cuts, lambda c: c < v)) * 2 + F.array_contains(cuts, v).cast("int")).cast("int")


def medians(df: DataFrame, key: str, value: str, small: int = SMALL, cuts: int = CUTS) -> DataFrame:
    """(key, median): what `percentile(value, 0.5)` gives, whatever share of the rows one key holds.

    Keys of few rows are read off directly. For the others an approximate sketch, merged from all
    tasks, gives `cuts` values to cut by; the values between two cuts and at each cut are counted
    exactly, and the range that holds the middle is cut again, until it is one value or the middle
    lies between two ranges. A range is about a `cuts`th of the one before, whatever the values
    look like, and never holds its own cut. No task gets the rows of such a key together, only its
    counts. Null values do not count, and a key without others has a null median; a null key is a
    key of its own; NaN is larger than any other value.
    """
    rows = df.select(F.col(key).alias("_key"), F.col(value).cast("double").alias("_v"))
    sizes = stored(rows.groupBy("_key").agg(F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")), "sizes")
    few = rows.join(sizes.filter(F.col("_n") <= small).select(F.col("_key").alias("_k")), F.col("_key").eqNullSafe(F.col("_k")))
    done = few.groupBy("_key").agg(F.percentile("_v", F.lit(0.5)).alias("median"))
    open_ = sizes.filter(F.col("_n") > small).select("_key", "_lo", "_hi", F.floor((F.col("_n") - 1) / 2).alias("_r1"), F.floor(F.col("_n") / 2).alias("_r2"))
    shares = [k / cuts for k in range(cuts + 1)]
    while not open_.isEmpty():
        told = open_.withColumnRenamed("_key", "_k")
        met = rows.join(told, F.col("_key").eqNullSafe(F.col("_k")) & F.col("_v").between(F.col("_lo"), F.col("_hi"))).drop("_k")
        sketch = met.groupBy("_key").agg(F.array_distinct(F.percentile_approx("_v", shares, 20 * cuts)).alias("_cuts")).withColumnRenamed("_key", "_k")
        cut = met.join(sketch, F.col("_key").eqNullSafe(F.col("_k")))
        counts = cut.groupBy("_key", _between_cuts(F.col("_v"), F.col("_cuts")).alias("_bin")).agg(
            F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_min"), F.max("_v").alias("_max"), F.first("_r1").alias("_r1"), F.first("_r2").alias("_r2")
        )
        along = Window.partitionBy("_key").orderBy("_bin")  # at most 2 * cuts + 3 rows
        placed = counts.withColumn("_upto", F.sum("_c").over(along)).withColumn("_next", F.lead("_min").over(along)).withColumn("_from", F.col("_upto") - F.col("_c"))
        middle = stored(placed.filter((F.col("_from") <= F.col("_r1")) & (F.col("_r1") < F.col("_upto"))), "middle")
        single = (F.col("_r2") < F.col("_upto")) & (F.col("_min") == F.col("_max"))
        between = F.col("_r2") >= F.col("_upto")
        ended = middle.filter(single | between)
        done = done.unionByName(ended.select("_key", F.when(between, F.col("_max") * 0.5 + F.col("_next") * 0.5).otherwise(F.col("_min")).alias("median")))
        open_ = middle.filter(~(single | between)).select("_key", F.col("_min").alias("_lo"), F.col("_max").alias("_hi"), (F.col("_r1") - F.col("_from")).alias("_r1"), (F.col("_r2") - F.col("_from")).alias("_r2"))
    return done.select(F.col("_key").alias(key), "median")
