"""Monthly summary tables and the warehouse's reporting order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reelhouse.operators.quality import measured_counts, row_count_report

# Totals are wider than one fact value so that a sum over any number of rows fits.
TOTAL = "decimal(22,2)"


def _monthly(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Fact rows with their calendar year and month."""
    months = F.broadcast(dates.select("temps_id", "annee", "mois"))  # one row per day
    return fact.drop("annee").join(months, "temps_id")


def _total(col: str):
    return F.sum(col).cast(TOTAL)


def agg_sales_month_store(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """Revenue, margin, sales and distinct clients by year, month and store."""
    return _monthly(sales, dates).groupBy("annee", "mois", "magasin_id").agg(
        _total("ca_ventes").alias("ca_total"), _total("marge").alias("marge_totale"),
        F.sum("nb_ventes").alias("nb_ventes"), F.count_distinct("client_id").alias("nb_clients"),
    )


def agg_sales_month_product(sales: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue and sales by year, month and product; the product type joins the finished sums."""
    sums = _monthly(sales, dates).groupBy("annee", "mois", "produit_id").agg(
        _total("ca_ventes").alias("ca_total"), F.sum("nb_ventes").alias("nb_ventes")
    )
    types = products.select("produit_id", F.col("type").alias("type_produit"))
    return sums.join(types, "produit_id").select("annee", "mois", "produit_id", "type_produit", "ca_total", "nb_ventes")


def agg_rentals_month_product_store(rentals: DataFrame, dates: DataFrame) -> DataFrame:
    """Revenue, rentals and days by year, month, product and store."""
    return _monthly(rentals, dates).groupBy("annee", "mois", "produit_id", "magasin_id").agg(
        _total("ca_locations").alias("ca_total"), F.sum("nb_locations").alias("nb_locations"),
        F.sum("nb_jours_total").alias("nb_jours_total"),
    )


BUILDERS = {
    "agg_ventes_mois_magasin": lambda s: agg_sales_month_store(s["fait_ventes"], s["dim_temps"]),
    "agg_ventes_mois_produit": lambda s: agg_sales_month_product(s["fait_ventes"], s["dim_temps"], s["dim_produit"]),
    "agg_locations_mois_produit_magasin": lambda s: agg_rentals_month_product_store(s["fait_locations"], s["dim_temps"]),
}
# Load order: dimensions, facts, summaries. The calendar and the stores are not counted.
REPORTED = ("dim_produit", "dim_client", "fait_ventes", "fait_locations", *BUILDERS)


def load_and_report(stage, names: tuple[str, ...] = REPORTED) -> DataFrame:
    """Build the named tables and count their rows, while they are written if they are stored."""
    frames = stage.load(names)
    if stage.stored:
        return measured_counts(stage.spark, {n: stage.measured[n] for n in names})
    return row_count_report(frames)
