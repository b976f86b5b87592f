"""Period comparison and top-N over monthly frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reelhouse.functions.measures import change


def reaggregate_monthly(agg: DataFrame, keys: list[str], sums: list[str], non_additive: tuple[str, ...] = ("nb_clients",)) -> DataFrame:
    """Roll a finer summary up to coarser keys; distinct counts cannot be added and are refused."""
    wrong = [c for c in sums if c in non_additive]
    if wrong:
        raise ValueError(f"not additive, compute from the fact: {wrong}")
    return agg.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def lag_previous_row(monthly: DataFrame, value: str, out: str = "prev") -> DataFrame:
    """Value of the previous existing month. The input has one row per month."""
    return monthly.withColumn(out, F.lag(value).over(Window.orderBy("annee", "mois")))


def mom_change_pct(monthly: DataFrame, value: str, out: str = "pct") -> DataFrame:
    """Percent change on the previous existing month, first month dropped."""
    compared = lag_previous_row(monthly, value, "_prev").where(F.col("_prev").isNotNull())
    return compared.withColumn(out, F.round(change(F.col(value), F.col("_prev")) * 100, 1)).drop("_prev")


def previous_calendar_month(monthly: DataFrame, value: str, by: list[str] = (), out: str = "prev") -> DataFrame:
    """Value of the calendar month before, NULL when that month has no row. The input has one row per month (and ``by``).

    Months are ordered by their running number and the frame is the one number before, so a gap gives NULL
    rather than an older month, and the frame's input is read once.
    """
    before = Window.partitionBy(*by).orderBy(F.col("annee") * 12 + F.col("mois")).rangeBetween(-1, -1)
    return monthly.withColumn(out, F.first(value).over(before))


def change_on_calendar_month(monthly: DataFrame, value: str) -> DataFrame:
    """Add ``pct``, the relative change on the calendar month before."""
    compared = previous_calendar_month(monthly, value)
    return compared.withColumn("pct", change(F.col(value), F.col("prev")))


def mom_drop_filter(monthly_by_product: DataFrame, value: str, threshold: float = -0.15) -> DataFrame:
    """Product rows of the months whose total fell below the threshold.

    Input is one row per (annee, mois, produit_id); the month totals are far smaller than it.
    """
    totals = reaggregate_monthly(monthly_by_product, ["annee", "mois"], [value])
    drops = change_on_calendar_month(totals, value).where(F.col("pct") < threshold)
    months = F.broadcast(drops.select("annee", "mois", "pct"))  # one row per calendar month
    return monthly_by_product.join(months, ["annee", "mois"])


def mom_drop_flag(monthly: DataFrame, value: str, threshold: float = -0.15, out: str = "flagged") -> DataFrame:
    """All months, with the value repeated in ``out`` for the months that fell."""
    compared = change_on_calendar_month(monthly, value)
    return compared.withColumn(out, F.when(F.col("pct") < threshold, F.col(value)))


def topn_per_group(df: DataFrame, group: list[str], measure: Column, tiebreak: list[str], n: int = 5, out: str = "rank") -> DataFrame:
    """The n best rows of each group. Spark limits every task to n rows per group before the shuffle."""
    order = Window.partitionBy(*group).orderBy(measure.desc(), *tiebreak)
    return df.withColumn(out, F.row_number().over(order)).where(F.col(out) <= n)


def top_members(df: DataFrame, member: str, measure: str, n: int) -> DataFrame:
    """The n members with the largest total; a top-N sort, so at most n rows per task."""
    totals = df.groupBy(member).agg(F.sum(measure).alias("_total"))
    return totals.orderBy(F.col("_total").desc(), member).limit(n).select(member)
