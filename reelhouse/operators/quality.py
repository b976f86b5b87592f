"""Data-quality measurements, each in one pass over the measured table."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from reelhouse.functions.measures import ratio_measures

def _rows():
    return F.count(F.lit(1))


def _percent(part, whole):
    return F.round(ratio_measures(part, whole) * 100, 6)


def row_count_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(tbl, nb) for each table."""
    counts = [df.agg(_rows().alias("nb")).select(F.lit(name).alias("tbl"), "nb") for name, df in tables.items()]
    return reduce(DataFrame.unionAll, counts)


def watched(df: DataFrame) -> dict[str, Column]:
    """Row count and missing values per column, as metrics that a write of ``df`` can measure on its way."""
    return {"nb": _rows(), **{f"null_{c}": F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns}}


def metrics_of(seen: Observation, names: list[str]) -> dict[str, int]:
    """What a write measured; zero under every name where Spark found the plan to be empty and so measured nothing."""
    try:
        return seen.get
    except Py4JError:
        return dict.fromkeys(names, 0)


def measured_counts(spark: SparkSession, measured: dict[str, dict[str, int]]) -> DataFrame:
    """(tbl, nb) from what was measured while the tables were written; no table is read."""
    return spark.createDataFrame([(name, found["nb"]) for name, found in measured.items()], "tbl string, nb bigint")


def measured_nulls(spark: SparkSession, measured: dict[str, dict[str, int]]) -> DataFrame:
    """(table, col, n_null, n, pct) per table and column, from what was measured while the tables were written."""
    rows = [(name, key.removeprefix("null_"), value, found["nb"]) for name, found in measured.items() for key, value in found.items() if key != "nb"]
    counted = spark.createDataFrame(rows, "`table` string, col string, n_null bigint, n bigint")
    return counted.withColumn("pct", _percent(F.col("n_null"), F.col("n")))


def row_text(cols: list[str]) -> Column:
    """One text per row: values in their SQL spelling, a missing one as ``-``."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in cols])


def table_fingerprint(df: DataFrame, name: str, cols: list[str]) -> DataFrame:
    """(tbl, nb, total, mixed): row count, and the sum and the exclusive or of 60-bit row hashes over ``cols``.

    The same rows give the same fingerprint in any order and split; a row that is missing, changed or repeated shows in the sum.
    """
    hashed = F.conv(F.substring(F.md5(row_text(cols)), 1, 15), 16, 10).cast("bigint")
    return df.select(hashed.alias("h")).agg(
        F.lit(name).alias("tbl"), _rows().alias("nb"), F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")).cast("string"), F.lit("0")).alias("total"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).alias("mixed"),
    )


def count_by_source(sales: DataFrame) -> DataFrame:
    """Rows per source code."""
    return sales.groupBy("source").agg(_rows().alias("nb"))


def director_coverage(films: DataFrame) -> DataFrame:
    """Films with and without a director."""
    return films.agg(
        F.count("realisateur").alias("avec_realisateur"),
        F.count_if(F.col("realisateur").isNull()).alias("sans_realisateur"),
    )


def null_rate_profile(df: DataFrame, table: str, cols: list[str]) -> DataFrame:
    """(table, col, n_null, n, pct) per column."""
    missing = [F.struct(F.lit(c).alias("col"), F.count_if(F.col(c).isNull()).alias("n_null")) for c in cols]
    long = df.agg(_rows().alias("n"), F.array(*missing).alias("missing")).select("n", F.inline("missing"))
    return long.select(
        F.lit(table).alias("table"), "col", "n_null", "n", _percent(F.col("n_null"), F.col("n")).alias("pct")
    )


def duplicate_rate(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of their key: (n_dup, n, pct)."""
    groups = df.groupBy(*keys).agg(_rows().alias("_copies"))
    totals = groups.agg(
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("n_dup"), F.coalesce(F.sum("_copies"), F.lit(0)).alias("n")
    )
    return totals.withColumn("pct", _percent(F.col("n_dup"), F.col("n")))


def orphan_count(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent: (n_orphan, n).

    Rows are counted per key before the join, so a busy key is one row there. NULL keys are
    orphans.
    """
    per_key = child.groupBy(F.col(child_key).alias("k")).agg(_rows().alias("c"))
    known = parent.select(F.col(parent_key).alias("k")).distinct().withColumn("hit", F.lit(True))
    return per_key.join(known, "k", "left").agg(
        F.coalesce(F.sum(F.when(F.col("hit").isNull(), F.col("c"))), F.lit(0)).alias("n_orphan"),
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
    )


def prefix_rate(df: DataFrame, col: str, prefix: str = "T") -> DataFrame:
    """(n, pct): values bearing the prefix, and their share of the set values."""
    return df.agg(
        F.count_if(F.col(col).startswith(prefix)).alias("n"),
        _percent(F.count_if(F.col(col).startswith(prefix)), F.count(col)).alias("pct"),
    )
