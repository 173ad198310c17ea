"""Dedupe, merge, upsert and vintages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(obs: DataFrame, ord_col: str = "ord") -> DataFrame:
    """One value per (series_id, period): the first as served."""
    return obs.groupBy("series_id", "period").agg(F.min_by("value", ord_col).alias("value"))


def anomalies(obs: DataFrame, ord_col: str = "ord", dataset: str | None = None) -> DataFrame:
    """Later prints that differ from the one kept, one row per print.

    Equal repeats collapse before the shuffle; the kept value is looked up by a plain join,
    whose hot keys adaptive execution splits. Both sides of the join read all columns of the
    collapsed prints, so that they are worked out and shuffled once for both.
    """
    prints = obs.groupBy("series_id", "period", "value").agg(
        F.min(ord_col).alias("_ord"), F.count(F.lit(1)).alias("_times")
    )
    first = F.min(F.when(F.col("_ord").isNotNull(), F.struct("_ord", "value", "_times")))
    kept = prints.groupBy("series_id", "period").agg(first.alias("_first"))
    out = (
        prints.join(kept, ["series_id", "period"])
        # `coalesce` keeps the comparison here: pushed below one side of the join it would make the two sides differ.
        .filter(F.coalesce(F.col("value") != F.col("_first.value"), F.lit(False)))
        .filter(F.col("_ord").isNull() | (F.col("_ord") >= F.col("_first._ord")))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times"))))
        .select("series_id", "period", F.col("_first.value").alias("kept"), F.col("value").alias("discarded"))
    )
    return out if dataset is None else out.withColumn("dataset", F.lit(dataset))


def keep_last(obs: DataFrame, order: Sequence[str]) -> DataFrame:
    """One value per (series_id, period): the last in `order`. How a revision arrives."""
    at = F.struct(*[F.col(c) for c in order])
    return obs.groupBy("series_id", "period").agg(F.max_by("value", at).alias("value"))


def daily_mean(obs: DataFrame, digits: int | None = 6, exact: bool = False) -> DataFrame:
    """Same-day values averaged. `exact` sums 4-digit decimals, free of rounding order."""
    if exact:
        mean = F.sum(F.col("value").cast("decimal(18,4)")).cast("double") / F.count("value")
    else:
        mean = F.avg("value")
    if digits is not None:
        mean = F.bround(mean, digits)
    return obs.groupBy("series_id", "period").agg(mean.alias("value"))


def merge_items(items: DataFrame, key: str, ord_col: str, keep: Sequence[str], categories: str = "category") -> DataFrame:
    """Items seen in several listings: first listing's fields, union of categories.

    `items` has one row per (item, category). The set is built map-side, so a key
    with very many copies shuffles one small set per task.
    """
    first = F.min_by(F.struct(*[F.col(c) for c in keep]), ord_col)
    return (
        items.groupBy(key)
        .agg(
            first.alias("_first"),
            F.array_sort(F.collect_set(categories)).alias("categories"),
        )
        .select(key, "_first.*", "categories")
    )


def first_category(items: DataFrame, key: str, ord_col: str, category: str = "category") -> DataFrame:
    """A link filed under several categories keeps the first."""
    return items.groupBy(key).agg(F.min_by(category, ord_col).alias(category))


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Catalog merge: new entries replace whole old ones, everything else stays."""
    both = old.withColumn("_p", F.lit(0)).unionByName(
        new.withColumn("_p", F.lit(1)), allowMissingColumns=True
    )
    return _latest(both, [key], F.col("_p"))


def _latest(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c != "_p"]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("_row"))
        .select(*keys, "_row.*")
    )


def replace_namespace(old: DataFrame, new: DataFrame, prefix: str, key: str = "series_id") -> DataFrame:
    """Drop everything the owner of `prefix` wrote before, then add what it has now."""
    return old.filter(~F.col(key).startswith(prefix)).unionByName(new, allowMissingColumns=True)


def advertise(catalog: DataFrame, obs: DataFrame, owned: DataFrame | str | Sequence[str]) -> DataFrame:
    """Of the owned entries keep those with observations; leave all other entries alone.

    `owned` is a table of series_id, a prefix of ids, or a short list of them; a table of any size
    is joined, nothing of it enters the plan.
    """
    seen = obs.select("series_id").distinct().withColumn("_seen", F.lit(True))
    told = catalog.join(seen, "series_id", "left")
    if isinstance(owned, DataFrame):
        told = told.join(owned.select("series_id").distinct().withColumn("_mine", F.lit(True)), "series_id", "left")
    else:
        mine = F.col("series_id").startswith(owned) if isinstance(owned, str) else F.col("series_id").isin(list(owned))
        told = told.withColumn("_mine", mine)
    return told.filter(F.col("_seen").isNotNull() | ~F.coalesce("_mine", F.lit(False))).select(*catalog.columns)


def present_only(manifest: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """The work list: manifest entries whose file is there."""
    return manifest.join(files.select(key).distinct(), key, "left_semi")


def preserve_labels(new: DataFrame, old: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Keep hand-written fields of the previous run where they are not empty."""
    was = old.groupBy(*keys).agg(*[F.max(f).alias(f"_old_{f}") for f in fields])
    out = new.join(was, list(keys), "left")
    for f in fields:
        hand = F.nullif(F.col(f"_old_{f}"), F.lit(""))
        out = out.withColumn(f, F.coalesce(hand, F.col(f)) if f in new.columns else hand)
    return out.drop(*[f"_old_{f}" for f in fields])


def carry_forward(manifest: DataFrame, previous: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Fields known from the last run filled in by key; of several earlier rows of a key the largest stands."""
    last = previous.groupBy(key).agg(F.max(F.struct(*[F.col(f) for f in fields])).alias("_was"))
    was = last.select(key, *[F.col(f"_was.{f}").alias(f"_old_{f}") for f in fields])
    out = manifest.join(was, key, "left")
    for f in fields:
        now = F.col(f) if f in manifest.columns else F.lit(None)
        out = out.withColumn(f, F.coalesce(F.col(f"_old_{f}"), now))
    return out.drop(*[f"_old_{f}" for f in fields])


def work_list(manifest: DataFrame, done: str = "sha256") -> DataFrame:
    return manifest.filter(F.col(done).isNull())


def prefer_source(items: DataFrame, keys: Sequence[str], preference: Sequence[str], source: str = "format") -> DataFrame:
    """One row per key, from the most preferred source that has it."""
    rank = F.array_position(F.lit(list(preference)), F.col(source))
    rest = [c for c in items.columns if c not in keys]
    return (
        items.groupBy(*keys)
        .agg(F.min_by(F.struct(*[F.col(c) for c in rest]), rank).alias("_row"))
        .select(*keys, "_row.*")
    )


def bilingual(english: DataFrame, other: DataFrame, key: str, fields: Sequence[str], suffix: str = "_ar") -> DataFrame:
    """The second language's labels beside the first's; of several rows of a key the largest stands."""
    one = other.groupBy(key).agg(F.max(F.struct(*[F.col(f) for f in fields])).alias("_one"))
    add = one.select(key, *[F.col(f"_one.{f}").alias(f + suffix) for f in fields])
    return english.join(add, key, "left")


def changed_only(landed: DataFrame, stored: DataFrame, key: str, content: str, seen: str) -> DataFrame:
    """Rows whose content differs from the last stored hash of their key."""
    last = (
        stored.groupBy(key)
        .agg(F.max_by("content_hash", seen).alias("content_hash"))
    )
    return landed.withColumn("content_hash", F.sha2(F.col(content).cast("binary"), 256)).join(
        last, [key, "content_hash"], "left_anti"
    )


def vintages(landings: DataFrame, seen: str = "seen_on") -> DataFrame:
    """Append-only landings to intervals: (series_id, period, value, seen_from, seen_to).

    Landings are cut to one value per (series_id, period, day) first, so the window
    of one observation has at most one row per landing day.
    """
    daily = landings.groupBy("series_id", "period", seen).agg(F.max("value").alias("value"))
    w = Window.partitionBy("series_id", "period").orderBy(seen)
    starts = (
        daily.withColumn("_was", F.lag("value").over(w))
        .filter(F.col("_was").isNull() | (F.col("_was") != F.col("value")))
        .withColumn("seen_to", F.lead(seen).over(w))
    )
    return starts.select(
        "series_id", "period", "value",
        F.col(seen).alias("seen_from"), "seen_to",
        F.col("_was").alias("replaced"),
    )


def as_published(vint: DataFrame, on: Column) -> DataFrame:
    """What the table said on a date."""
    return vint.filter(
        (F.col("seen_from") <= on) & (F.col("seen_to").isNull() | (F.col("seen_to") > on))
    ).select("series_id", "period", "value")


def revisions(vint: DataFrame) -> DataFrame:
    """Each change of an already published value."""
    return vint.filter(F.col("replaced").isNotNull()).select(
        "series_id", "period",
        F.col("replaced").alias("old_value"),
        F.col("value").alias("new_value"),
        F.col("seen_from").alias("revised_on"),
    )


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
