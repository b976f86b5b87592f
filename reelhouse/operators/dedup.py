"""Deduplication, surrogate keys and upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reelhouse.sources.shared import written


def dedup_group_min(df: DataFrame, keys: dict[str, Column], min_cols: list[str]) -> DataFrame:
    """One row per key, each listed column represented by its own minimum."""
    grouped = df.groupBy(*[expr.alias(name) for name, expr in keys.items()])
    return grouped.agg(*[F.min(c).alias(c) for c in min_cols])


def dedup_distinct(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct rows of a projection."""
    return df.select(*cols).distinct()


def dedup_keep_first(
    df: DataFrame, keys: list[Column], order_by: list[Column], cols: list[str] | None = None,
) -> DataFrame:
    """First whole row per key in the stated order.

    The first row is the minimum of (order, row) as a struct, so each task reduces its rows
    before the shuffle and a key with very many copies never sits whole in one task. A
    missing order value sorts first, as in an ascending sort; ties fall to the row itself.
    """
    cols = list(cols or df.columns)
    ranked = F.struct(
        *[expr.alias(f"_o{i}") for i, expr in enumerate(order_by)], F.struct(*cols).alias("row")
    )
    groups = df.groupBy(*[expr.alias(f"_k{i}") for i, expr in enumerate(keys)])
    return groups.agg(F.min(ranked).alias("first")).select("first.row.*")


def limit_one(df: DataFrame, key: list[str] | None = None, order_by: list[Column] = ()) -> DataFrame:
    """At most one row, overall or per key."""
    if not key:
        return df.orderBy(*order_by).limit(1) if order_by else df.limit(1)
    return dedup_keep_first(df, [F.col(k) for k in key], list(order_by))


def natural_key_text(cols: list[str]) -> Column:
    """One text per natural key: each part with its length in front, so that different keys, also with NULL, differ."""
    parts = [F.col(c).cast("string") for c in cols]
    return F.concat(*[F.coalesce(F.concat(F.length(p), F.lit(":"), p), F.lit("-")) for p in parts])


def surrogate_keys(
    df: DataFrame, natural_key: list[str], id_name: str, known: DataFrame | None = None, hex_digits: int = 3,
) -> DataFrame:
    """Unique integer keys for rows that are unique on ``natural_key``; a key once given stays.

    Rows are spread over 16**hex_digits buckets by a hash of the natural key and numbered inside their bucket, in the
    order of the key's columns; key = number * buckets + bucket + 1. One shuffle, no global ordering, and
    the keys depend on the data alone. That is also the most tasks that number rows: choose
    ``hex_digits`` so that a bucket fits a task, and keep it from load to load.

    ``known`` is the stored table of an earlier load, with ``id_name`` and the natural key: its keys are
    kept, and only new natural keys are numbered, from their bucket's largest number on.
    """
    buckets = 16**hex_digits
    text = natural_key_text(natural_key)
    keyed = df.withColumn("_key", text).withColumn(
        "_bucket", F.conv(F.substring(F.md5(F.col("_key")), 1, hex_digits), 16, 10).cast("bigint")
    )
    order = Window.partitionBy("_bucket").orderBy(*[F.col(c).asc_nulls_first() for c in natural_key])
    if known is None:
        number = F.row_number().over(order) - 1
        return keyed.withColumn(id_name, number * F.lit(buckets) + F.col("_bucket") + 1).select(id_name, *df.columns)
    stored = known.select(text.alias("_key"), F.col(id_name))
    taken = stored.select(F.pmod(F.col(id_name) - 1, F.lit(buckets)).alias("_bucket"), F.floor((F.col(id_name) - 1) / F.lit(buckets)).alias("_n"))
    taken = taken.groupBy("_bucket").agg((F.max("_n") + 1).alias("_taken"))
    looked_up = keyed.join(stored, "_key", "left")
    fresh = looked_up.where(F.col(id_name).isNull()).drop(id_name)
    number = F.row_number().over(order) - 1 + F.coalesce("_taken", F.lit(0))
    numbered = fresh.join(taken, "_bucket", "left").withColumn(id_name, (number * F.lit(buckets) + F.col("_bucket") + 1).cast("bigint"))
    kept = looked_up.where(F.col(id_name).isNotNull())
    return kept.select(id_name, *df.columns).unionByName(numbered.select(id_name, *df.columns))


def dense_keys(df: DataFrame, natural_key: list[str], id_name: str, known: DataFrame | None = None) -> DataFrame:
    """Keys 1 to n without gaps, in the order of the natural key (NULLs first), for rows that are unique on it.

    Rows are sorted inside ranges of the natural key and written with their range and their place in it; a range's first number is the sum of
    the sizes of those before it. Only one row per range meets in one place, so any number of rows is numbered by as many tasks
    as there are ranges. The rows are stored before they are numbered: range borders are sampled, and a second reading could
    draw them elsewhere.

    ``known`` is the stored table of an earlier load, with ``id_name`` and the natural key: its keys stay, and new natural keys follow the largest.
    """
    order = [F.col(c).asc_nulls_first() for c in natural_key]
    fresh, first, kept = df, F.lit(0).cast("bigint"), None
    if known is not None:
        text = natural_key_text(natural_key)
        looked_up = df.withColumn("_key", text).join(known.select(text.alias("_key"), F.col(id_name)), "_key", "left")
        kept = looked_up.where(F.col(id_name).isNotNull()).select(id_name, *df.columns)
        fresh = looked_up.where(F.col(id_name).isNull()).select(*df.columns)
        first = F.coalesce(known.agg(F.max(id_name)).scalar(), first)
    ranges = fresh.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = written(ranges.withColumns({"_range": F.spark_partition_id(), "_place": place}), "dense-keys")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = placed.join(F.broadcast(starts), "_range").withColumn(id_name, (first + F.col("_start") + F.col("_place") + 1).cast("bigint"))
    numbered = numbered.select(id_name, *df.columns)
    return numbered if kept is None else kept.unionByName(numbered)


def upsert_by_key(
    target: DataFrame, updates: DataFrame, keys: list[str], update_cols: list[str] | None = None,
) -> DataFrame:
    """Target after inserting or updating by key; keys are unique on each side.

    Columns outside ``update_cols`` keep the stored value of an existing row. A small batch of
    updates is broadcast by Spark, so the stored table is then not shuffled.
    """
    fresh = updates.select(*target.columns)
    others = [c for c in target.columns if c not in keys]
    if update_cols is None or set(update_cols) >= set(others):
        return fresh.unionByName(target.join(fresh.select(*keys), keys, "left_anti"))
    new_values = fresh.select(
        *keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in update_cols]
    )
    merged = target.join(new_values, keys, "left").select([
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in update_cols else F.col(c)
        for c in target.columns
    ])
    return merged.unionByName(fresh.join(target.select(*keys), keys, "left_anti"))
