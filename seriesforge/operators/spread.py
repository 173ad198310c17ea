"""Keeping hot groups apart.

One series, source, term or conversation may hold a third of all rows. The helpers
here give the same answer as a plain window or join without ever sending a whole
unbounded group to one task.

Observation tables need none of this once they hold one row per (series_id, DATE):
a group then has at most one row per calendar day, about 36,500 a century, and a
plain window per series is bounded. `one_per_day` establishes that bound with a
partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def default_salts(df: DataFrame) -> int:
    """Salts that cut a key with a third of all rows down to one partition's share."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(1024, max(4, partitions // 3))


def _salt_of(df: DataFrame, salts: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts)).cast("int")


def top_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank: str | None = None,
    salts: int | None = None,
) -> DataFrame:
    """The first k rows of each group in `order`, ranked within salted parts first.

    The final window sees at most `k * salts` rows of a group, whatever its size.
    """
    salts = salts or default_salts(df)
    part = Window.partitionBy(*keys, "_salt").orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(*order)
    name = rank or "_rank"
    out = (
        df.withColumn("_salt", _salt_of(df, salts))
        .withColumn("_part_rank", F.row_number().over(part))
        .filter(F.col("_part_rank") <= k)
        .drop("_salt", "_part_rank")
        .withColumn(name, F.row_number().over(whole))
        .filter(F.col(name) <= k)
    )
    return out if rank else out.drop(name)


def neighbour_row(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    cols: Sequence[str],
    width: int = 1024,
    alias: str = "previous",
    step: int = -1,
) -> DataFrame:
    """Add struct(`cols`) of the previous (step -1) or next (step 1) row of each group.

    `order` is a whole number unique inside the group. The group is cut into
    stretches of `width`; a stretch takes its first neighbour from the edge row of
    the nearest stretch that has rows, so no task holds a whole group.
    """
    row = F.struct(*[F.col(c) for c in cols])
    cut = df.withColumn("_stretch", F.floor(F.col(order) / F.lit(width)).cast("bigint"))
    inside = Window.partitionBy(*keys, "_stretch").orderBy(F.col(order).asc() if step < 0 else F.col(order).desc())
    edge = (F.max_by if step < 0 else F.min_by)(row, F.col(order))
    along = Window.partitionBy(*keys).orderBy(F.col("_stretch").asc() if step < 0 else F.col("_stretch").desc())
    edges = (
        cut.groupBy(*keys, "_stretch")
        .agg(edge.alias("_edge"))
        .withColumn("_before", F.lag("_edge").over(along))
        .drop("_edge")
    )
    return (
        cut.withColumn("_near", F.lag(row).over(inside))
        .join(edges, [*keys, "_stretch"], "left")
        .withColumn(alias, F.coalesce("_near", "_before"))
        .drop("_near", "_before", "_stretch")
    )


def one_per_day(obs: DataFrame) -> DataFrame:
    """One row per (series_id, period) in the columns of `obs`: of several prints the largest value stands.

    A partial aggregation, so a day with very many prints is no hot group. Windows by
    series behind it hold at most one row a calendar day.
    """
    rest = [c for c in obs.columns if c not in ("series_id", "period")]
    first = ["value", *[c for c in rest if c != "value"]]
    top = obs.groupBy("series_id", "period").agg(F.max(F.struct(*first)).alias("_top"))
    return top.select(*[F.col(c) if c in ("series_id", "period") else F.col(f"_top.{c}").alias(c) for c in obs.columns])


def settle(df: DataFrame, **cols: Column) -> DataFrame:
    """Work columns out once, so that array lambdas further up read them as plain values.

    A one-row generator: expressions are not folded through it, and it moves no data.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))
