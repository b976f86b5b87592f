"""Projection, filter, routing and set operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from reelhouse.functions.measures import margin


def coerce_decimals(df: DataFrame) -> DataFrame:
    """Replace every decimal column by a double."""
    return df.select([
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ])


def required_fields_filter(df: DataFrame, required: list[str], non_blank: list[str] = ()) -> DataFrame:
    """Keep rows whose required fields are set and whose text fields are not blank."""
    for name in required:
        df = df.where(F.col(name).isNotNull())
    for name in non_blank:
        df = df.where(F.trim(F.col(name)) != "")
    return df


def select_rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep the mapped fields under their new names."""
    return df.select([F.col(old).alias(new) for old, new in mapping.items()])


def tag_source(df: DataFrame, store_id: int, source: str) -> DataFrame:
    """Add the constant store id and source code."""
    return df.withColumns({"magasin_id": F.lit(store_id), "source": F.lit(source)})


def valid_interval_filter(df: DataFrame, start: str, end: str) -> DataFrame:
    """Keep rows whose end lies after the start; full values are compared, not dates."""
    return df.where(F.col(end) > F.col(start))


def rental_measures(df: DataFrame, start: str, end: str, price: str, min_days: int = 1) -> DataFrame:
    """Days (at least ``min_days``), revenue and the constant count of a rental."""
    plain = F.date_diff(F.to_date(end), F.to_date(start))
    days = F.when(plain.isNotNull(), F.greatest(F.lit(min_days), plain))
    revenue = (F.col(price).cast("decimal(10,2)") * days).cast("decimal(12,2)")
    return df.withColumns({"nb_jours_total": days, "ca_locations": revenue, "nb_locations": F.lit(1)})


def sale_flags(df: DataFrame, date: str, flag: str | None = None) -> DataFrame:
    """Year, constant count and the new/used flag (0 when absent)."""
    is_new = F.coalesce(F.col(flag).cast("int"), F.lit(0)) if flag else F.lit(0)
    return df.withColumns({"annee": F.year(F.to_date(date)), "nb_ventes": F.lit(1), "est_neuf": is_new})


def stored_margin(df: DataFrame, revenue: str, cost: str) -> DataFrame:
    """Add ``marge`` as a real column, since Parquet tables have no generated columns."""
    return df.withColumn("marge", margin(F.col(revenue), F.col(cost)))


def route_rows(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Split rows by a predicate; a NULL predicate goes to the false branch."""
    holds = F.coalesce(predicate, F.lit(False))
    return df.where(holds), df.where(~holds)


def stock_vs_sale_split(df: DataFrame, price: str) -> tuple[DataFrame, DataFrame]:
    """Items with a price are sales, those without are unsold stock."""
    return route_rows(df, F.col(price).isNotNull())


def union_all(*dfs: DataFrame) -> DataFrame:
    """Rows of all frames, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """Distinct rows of all frames."""
    return union_all(*dfs).distinct()


def append_streams(*dfs: DataFrame) -> DataFrame:
    """Concatenate frames, padding the columns a frame lacks with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def sort_ci(df: DataFrame, text_cols: list[str], then: list[str] = ()) -> DataFrame:
    """Sort on text without regard to case, then on the remaining columns."""
    return df.orderBy(*[F.lower(F.col(c)) for c in text_cols], *[F.col(c) for c in then])
