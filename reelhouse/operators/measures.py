"""Measures of renters by gender."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reelhouse.functions.measures import ratio_measures


def _per_client(rentals: DataFrame, clients: DataFrame) -> DataFrame:
    """Rentals and days per client with gender and age; counted before the join with the clients."""
    counts = rentals.groupBy("client_id").agg(
        F.count(F.lit(1)).alias("nb"), F.sum("nb_jours_total").alias("jours"), F.sum("nb_locations").alias("locations")
    )
    return counts.join(clients.select("client_id", "genre", "age"), "client_id")


def renters_by_gender(rentals: DataFrame, clients: DataFrame) -> DataFrame:
    """Per gender: mean age weighted by rental, distinct renters, rentals. NULL is its own group.

    One row per client reaches the join, so the distinct count is a plain count there.
    """
    known = F.col("age").isNotNull()
    weight = F.sum(F.when(known, F.col("nb")))
    return _per_client(rentals, clients).groupBy("genre").agg(
        F.round(ratio_measures(F.sum(F.col("age") * F.col("nb")), weight), 1).alias("age_moyen"),
        F.count(F.lit(1)).alias("nb_clients"), F.sum("nb").alias("nb_locations"),
    )


def avg_age_distinct_renters(rentals: DataFrame, clients: DataFrame) -> DataFrame:
    """Per gender: mean age over clients with a rental, each counted once."""
    renters = _per_client(rentals, clients).where(F.col("locations") > 0)
    return renters.groupBy("genre").agg(F.avg("age").alias("age_moyen"))


def rental_duration_by_gender(rentals: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    """Per gender: mean rental days over films."""
    films = products.where(F.col("type") == "film").select("produit_id")
    days = rentals.groupBy("client_id", "produit_id").agg(
        F.sum("nb_jours_total").alias("nb_jours_total"), F.sum("nb_locations").alias("nb_locations")
    ).join(films, "produit_id", "left_semi")
    per_client = _per_client(days, clients)
    return per_client.groupBy("genre").agg(
        ratio_measures(F.sum("jours"), F.sum("locations")).alias("duree_moyenne")
    )
