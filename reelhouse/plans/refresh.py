"""Monthly summaries kept up to date from the rows of a fact that changed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from reelhouse.plans.layered import dated_sales, load_fact_sales
from reelhouse.sources.shared import written
from reelhouse.sources.tables import delete_rows, overwrite_partitions, replace_table, upsert_table


def _in_months(months: list[tuple[int, int]]) -> Column:
    return (F.col("annee") * 12 + F.col("mois")).isin([year * 12 + month for year, month in months])


def images(target: DataFrame, updates: DataFrame | None, keys: list[str], gone: DataFrame | None = None) -> DataFrame:
    """(temps_id): the days of rows as they are before an upsert or a removal, and of the updates. Read before the fact is changed."""
    days = []
    if updates is not None:
        days += [target.join(updates.select(*keys), keys, "left_semi").select("temps_id"), updates.select("temps_id")]
    if gone is not None:
        days.append(target.join(gone.select(*keys), keys, "left_semi").select("temps_id"))
    found = days[0]
    for more in days[1:]:
        found = found.unionByName(more)
    return found.distinct()


def change_fact(fact: str, keys: list[str], updates: DataFrame | None = None, gone: DataFrame | None = None, partition: str = "annee") -> DataFrame:
    """Upsert and remove rows of a stored fact; returns the days whose rows changed, stored before the first change."""
    spark = (updates if updates is not None else gone).sparkSession
    days = written(images(spark.table(fact), updates, keys, gone), "changed-days")
    if updates is not None:
        upsert_table(fact, updates, keys, partition=partition)
    if gone is not None:
        delete_rows(fact, gone, keys, partition)
    return days


def touched_months(days: DataFrame, dates: DataFrame) -> list[tuple[int, int]]:
    """(annee, mois) of changed days; at most twelve a year come to the driver."""
    return sorted(tuple(row) for row in dates.join(days.distinct(), "temps_id", "left_semi").select("annee", "mois").distinct().collect())


def refreshed(fact: DataFrame, dates: DataFrame, months: list[tuple[int, int]], build: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """A summary's rows of the given months, from the fact's folders of their years alone."""
    years = sorted({year for year, _ in months})
    return build(fact.where(F.col("annee").isin(years)), dates.where(_in_months(months)))


def refresh_aggregates(fact: str, summaries: dict[str, Callable[[DataFrame, DataFrame], DataFrame]], days: DataFrame, dates: DataFrame) -> list[tuple[int, int]]:
    """Rebuild the months of the stored ``summaries`` {table: its builder from fact and calendar} whose fact rows changed; returns them.

    ``days`` holds the temps_id of every changed row before and after the change, as ``change_fact`` gives them. Only the year folders
    of touched months are read from the fact. Summaries are stored by year: a touched year is rewritten from its untouched months,
    taken from the summary as it is, and the rebuilt ones, in one committed job per summary. Repeating a refresh changes nothing.
    """
    spark = days.sparkSession
    months = touched_months(days, dates)
    if not months:
        return months
    years = sorted({year for year, _ in months})
    for table, build in summaries.items():
        summary = spark.table(table)
        kept = summary.where(F.col("annee").isin(years) & ~_in_months(months))
        fresh = refreshed(spark.table(fact), dates, months, build).select(*summary.columns)
        overwrite_partitions(kept.unionByName(fresh), table, "annee", years)
    return months


def replay_rejects(fact: str, rejected: str, products: DataFrame, calendar: DataFrame) -> DataFrame:
    """Take up the sales of a stored table of rejects whose day or product has arrived; returns the days of the sales taken, for a refresh.

    The rejects are looked up again by themselves, whatever the size of the sales. Those that are facts now are upserted by their id and the others stay, each with
    its present reason. The fact is written first: cut off between the two, the next replay finds the same sales and writes them over themselves.
    """
    spark = products.sparkSession
    left = spark.table(rejected)
    found = written(dated_sales(left.drop("prix_inventaire_total", "reason"), products, calendar), "replayed")
    taken, missing = load_fact_sales(found)
    days = change_fact(fact, ["vente_id"], taken)
    replace_table(missing.select(*left.columns), rejected)
    return days
