"""The five business questions and the registry they are run from."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from reelhouse.functions.people import gender_label
from reelhouse.functions.text import period_label
from reelhouse.operators.joins import label_join
from reelhouse.operators.measures import renters_by_gender
from reelhouse.operators.periods import mom_change_pct, reaggregate_monthly, topn_per_group, top_members

def _period():
    return period_label(F.col("annee"), F.col("mois")).alias("Periode")


def _store_names(stores: DataFrame) -> DataFrame:
    return stores.select("magasin_id", F.col("nom").alias("Magasin"))


def _titles(products: DataFrame) -> DataFrame:
    return products.select("produit_id", F.col("titre").alias("Film"))


def q1_movies_by_month(agg_sales_product: DataFrame, products: DataFrame) -> DataFrame:
    """Film revenue per month, best first inside the month."""
    films = label_join(agg_sales_product.where(F.col("type_produit") == "film"), {"produit_id": _titles(products)})
    ordered = films.orderBy("annee", "mois", F.col("ca_total").desc())
    return ordered.select(_period(), "Film", F.col("ca_total").alias("CA_EUR"), F.col("nb_ventes").alias("Nb_Ventes"))


def q2_revenue_by_store(agg_sales_store: DataFrame, stores: DataFrame) -> DataFrame:
    """Month by store."""
    named = label_join(agg_sales_store, {"magasin_id": _store_names(stores)})
    return named.orderBy("annee", "mois", "Magasin").select(
        _period(), "Magasin", F.col("ca_total").alias("CA_EUR"), F.col("nb_ventes").alias("Nb_Ventes"),
        F.col("nb_clients").alias("Nb_Clients"),
    )


def q3_renter_profile(rentals: DataFrame, clients: DataFrame) -> DataFrame:
    """Mean age weighted by rental, distinct renters and rentals per gender."""
    profile = renters_by_gender(rentals, clients).orderBy(F.col("genre").desc())
    return profile.select(
        gender_label(F.col("genre")).alias("Genre"), F.col("age_moyen").alias("Age_Moyen"),
        F.col("nb_clients").alias("Nb_Clients_Distincts"), F.col("nb_locations").alias("Nb_Locations"),
    )


def q4_rentals_by_store(agg_rentals: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """Film by store and month, most rented first."""
    named = label_join(agg_rentals, {"produit_id": _titles(products), "magasin_id": _store_names(stores)})
    ordered = named.orderBy("annee", "mois", "Magasin", F.col("nb_locations").desc())
    return ordered.select(
        "Magasin", _period(), "Film", F.col("nb_locations").alias("Nb_Locations"), F.col("ca_total").alias("CA_EUR")
    )


def monthly_rentals(agg_rentals: DataFrame) -> DataFrame:
    """Rentals and revenue per calendar month."""
    return reaggregate_monthly(agg_rentals, ["annee", "mois"], ["nb_locations", "ca_total"])


def q5_rental_trends(agg_rentals: DataFrame) -> DataFrame:
    """Monthly rentals with the percent change on the previous existing month."""
    trend = mom_change_pct(monthly_rentals(agg_rentals), "nb_locations", "Variation_Pct").orderBy("annee", "mois")
    return trend.select(
        _period(), F.col("nb_locations").alias("Nb_Locations"), F.col("ca_total").cast("decimal(22,2)").alias("CA_EUR"),
        "Variation_Pct",
    )


def top_films_per_year(agg_sales_product: DataFrame, n: int = 5) -> DataFrame:
    """The n best films by revenue of each year."""
    yearly = reaggregate_monthly(
        agg_sales_product.where(F.col("type_produit") == "film"), ["annee", "produit_id"], ["ca_total", "nb_ventes"]
    )
    return topn_per_group(yearly, ["annee"], F.col("ca_total"), ["produit_id"], n)


def top20_series(agg_sales_product: DataFrame, n: int = 20) -> DataFrame:
    """Monthly revenue of the n products with the largest total revenue."""
    best = F.broadcast(top_members(agg_sales_product, "produit_id", "ca_total", n))  # n rows
    return agg_sales_product.join(best, "produit_id", "left_semi").select(
        "annee", "mois", "produit_id", "type_produit", F.col("ca_total").alias("ca")
    )


@dataclass(frozen=True)
class Question:
    """A named question, how its result is meant to be shown, and its builder over a warehouse."""

    name: str
    display: str
    build: Callable[..., DataFrame]


QUESTIONS = {
    q.name: q for q in (
        Question("Q1 — Top Movies by Monthly Revenue", "bar",
                 lambda w: q1_movies_by_month(w["agg_ventes_mois_produit"], w["dim_produit"])),
        Question("Q2 — Monthly Revenue by Store", "line",
                 lambda w: q2_revenue_by_store(w["agg_ventes_mois_magasin"], w["dim_magasin"])),
        Question("Q3 — Renter Profile (Average Age M/F)", "bar",
                 lambda w: q3_renter_profile(w["fait_locations"], w["dim_client"])),
        Question("Q4 — Most Rented Movies by Store", "table",
                 lambda w: q4_rentals_by_store(w["agg_locations_mois_produit_magasin"], w["dim_produit"], w["dim_magasin"])),
        Question("Q5 — Monthly Rental Trends", "line",
                 lambda w: q5_rental_trends(w["agg_locations_mois_produit_magasin"])),
    )
}


def ask(warehouse, name: str) -> DataFrame:
    """Answer a registered question from a warehouse."""
    return QUESTIONS[name].build(warehouse)
