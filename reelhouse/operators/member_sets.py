"""Exact distinct counts that roll up: the members of a group as bitmaps that merge.

A set is kept in one row per group and stretch of 32,768 ids that has a member, as a bitmap of 4 KB. Sets of coarser groups are unions of
finer ones, so one stored table of monthly sets answers every level above it without the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reelhouse.operators.cube import TIME_PATH, path_totals, without


def member_sets(rows: DataFrame, keys: list[str], member: str = "client_id") -> DataFrame:
    """(keys, stretch, members) of every group; a NULL member belongs to no set."""
    known = rows.where(F.col(member).isNotNull())
    groups = known.groupBy(*keys, F.bitmap_bucket_number(F.col(member)).alias("stretch"))
    return groups.agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(member))).alias("members"))


def merged_sets(sets: DataFrame, keys: list[str]) -> DataFrame:
    """Unions of the sets of each coarser group."""
    return sets.groupBy(*keys, "stretch").agg(F.bitmap_or_agg("members").alias("members"))


def set_sizes(sets: DataFrame, keys: list[str], out: str = "n") -> DataFrame:
    """Distinct members per group."""
    return sets.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("members")), F.lit(0)).cast("bigint").alias(out))


def monthly_client_sets(sales: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """Sets of clients by year, quarter, month, store and product type, one pass over the fact.

    The type is joined to the distinct (month, store, product, client) rows, so sales that repeat one are reduced where they are read.
    """
    months = F.broadcast(dates.select("temps_id", "annee", "trimestre", "mois"))  # one row per day
    bought = sales.drop("annee").join(months, "temps_id").select("annee", "trimestre", "mois", "magasin_id", "produit_id", "client_id").distinct()
    typed = bought.join(products.select("produit_id", "type"), "produit_id")
    return member_sets(typed, ["annee", "trimestre", "mois", "magasin_id", "type"])


def rollup_distinct(sets: DataFrame, keys: list[str] = ()) -> DataFrame:
    """(keys, annee, trimestre, mois, grouping_id, n): distinct members at all levels of time down to months, per group of ``keys``.

    The sets are read once; a level's sets are unions of the level below.
    """
    path = list(TIME_PATH[:-1])
    finest = merged_sets(sets, [*path, *keys]).withColumn("grouping_id", F.lit(0).cast("bigint"))
    levels = path_totals(finest, path, {"members": F.bitmap_or_agg("members")}, (*keys, "stretch"))
    return set_sizes(levels, [*keys, *path, "grouping_id"])


def rollup_distinct_stores(sets: DataFrame) -> DataFrame:
    """Distinct members at all levels of time, per store and over all stores (``magasin_id`` NULL, 8 added to grouping_id)."""
    path = ["magasin_id", *TIME_PATH[:-1]]
    merges = {"members": F.bitmap_or_agg("members")}
    finest = merged_sets(sets, path).withColumn("grouping_id", F.lit(0).cast("bigint"))
    both = finest.unionByName(without(finest, path, "magasin_id", merges, ("stretch",)))
    levels = path_totals(both, path[1:], merges, ("magasin_id", "stretch"))
    return set_sizes(levels, [*path, "grouping_id"])
