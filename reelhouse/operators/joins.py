"""Matching and lookup joins. Every condition is an equality on columns computed beforehand."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from reelhouse.functions.text import match_key
from reelhouse.operators.dedup import dedup_keep_first
from reelhouse.operators.shape import route_rows
from reelhouse.operators.skew import join_all


def with_keys(df: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Compute key columns once, before the join reads them."""
    return df.withColumns(keys)


def prenormalised_join(left: DataFrame, right: DataFrame, keys: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Join on named key expressions, each computed once per row of its side."""
    known = with_keys(right, {name: pair[1] for name, pair in keys.items()})
    return with_keys(left, {name: pair[0] for name, pair in keys.items()}).join(known, list(keys))


def star_join_inner(src: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Inner join of a fact source with dimensions given as {shared key: dimension}.

    Unmatched rows drop; a dimension with several rows per key multiplies the source rows.
    """
    return join_all(src, [(dim, [key]) for key, dim in dims.items()])


def join_on_title_key(left: DataFrame, right: DataFrame, left_title: str, right_title: str) -> DataFrame:
    """Equi-join on the normalised title."""
    return prenormalised_join(
        left, right, {"title_key": (match_key(F.col(left_title)), match_key(F.col(right_title)))}
    )


def person_keys(first: Column, last: Column, dob: Column | None = None) -> dict[str, Column]:
    """Case-insensitive person key columns, with the birth date when there is one."""
    keys = {"first_key": F.lower(first), "last_key": F.lower(last)}
    return keys if dob is None else {**keys, "dob_key": dob}


def join_on_person_key(src: DataFrame, clients: DataFrame, store_id: int) -> DataFrame:
    """Attach ``client_id`` by first name, last name and birth date within one store.

    ``src`` has prenom, nom and date_naissance; a NULL birth date never matches.
    """
    return _join_clients(src, clients, store_id, ["prenom", "nom", "date_naissance"])


def join_on_name_only(src: DataFrame, clients: DataFrame, store_id: int) -> DataFrame:
    """Attach ``client_id`` by name alone; namesakes multiply rows."""
    return _join_clients(src, clients, store_id, ["prenom", "nom"])


def _join_clients(src: DataFrame, clients: DataFrame, store_id: int, parts: list[str]) -> DataFrame:
    keys = person_keys(*[F.col(p) for p in parts])
    known = with_keys(clients.where(F.col("magasin_id") == store_id), keys).select("client_id", *keys)
    return with_keys(src, keys).join(known, list(keys)).drop(*keys)


def anti_join_title(new: DataFrame, existing: DataFrame, new_title: str, existing_title: str) -> DataFrame:
    """Rows of ``new`` whose normalised title is not among the existing ones."""
    known = existing.select(match_key(F.col(existing_title)).alias("title_key")).distinct()
    keyed = new.withColumn("title_key", match_key(F.col(new_title)))
    return keyed.join(known, ["title_key"], "left_anti").drop("title_key")


def anti_join_lower(
    new: DataFrame, existing: DataFrame, new_title: str, existing_title: str, key: Callable[[Column], Column] = F.lower,
) -> DataFrame:
    """Rows of ``new`` whose title is not among the existing ones, compared by ``key``: lower case, or ``collated``."""
    known = existing.select(key(F.col(existing_title)).alias("_title")).distinct()
    keyed = new.withColumn("_title", key(F.col(new_title)))
    return keyed.join(known, ["_title"], "left_anti").drop("_title")


def lookup_left(
    df: DataFrame, ref: DataFrame, key: str, values: list[str], order_by: list[Column] = (),
) -> DataFrame:
    """Keep every row and add the first matching values, NULL without a match."""
    first = dedup_keep_first(ref.select("*"), [F.col(key)], list(order_by)).select(key, *values)
    return df.join(first, [key], "left")


def lookup_first_match(
    df: DataFrame, ref: DataFrame, key: str, id_name: str,
) -> tuple[DataFrame, DataFrame]:
    """Look up the smallest matching id, then route: (matched rows, rows without a match)."""
    found = ref.groupBy(key).agg(F.min(id_name).alias(id_name))
    return route_rows(df.join(found, [key], "left"), F.col(id_name).isNotNull())


def copy_chain_join(rentals: DataFrame, copies: DataFrame, movies: DataFrame, products: DataFrame) -> DataFrame:
    """Rental -> rental copy -> movie -> product.

    The three small hops are resolved to (copy_id, produit_id) first, so the rentals are
    joined once.
    """
    copy_movies = copies.select(F.col("id").alias("copy_id"), F.col("movie_id").alias("movieid"))
    films = products.where(F.col("type") == "film").select("produit_id", F.col("film_id").alias("movieid"))
    film_products = movies.select("movieid").join(films, "movieid")
    copy_products = copy_movies.join(film_products, ["movieid"]).select("copy_id", "produit_id")
    return rentals.join(copy_products, ["copy_id"])


def resolve_bridge_keys(pairs: DataFrame, films: DataFrame, actors: DataFrame) -> DataFrame:
    """Distinct (film_id, acteur_id) of pairs given as (film_source_id, acteur_source_id).

    The pairs are reduced to distinct ones before the joins, which bounds a busy actor's rows
    by the number of films.
    """
    wanted = pairs.select("film_source_id", "acteur_source_id").distinct()
    film_ids = films.select(F.col("source_id").alias("film_source_id"), "film_id")
    actor_ids = actors.select(F.col("source_id").alias("acteur_source_id"), "acteur_id")
    resolved = join_all(wanted, [(film_ids, ["film_source_id"]), (actor_ids, ["acteur_source_id"])])
    return resolved.select("film_id", "acteur_id").distinct()


def cost_enrichment(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Attach the product's inventory price to each sale."""
    costs = products.select("produit_id", F.col("prix_inventaire").alias("prix_inventaire_total"))
    return sales.join(costs, ["produit_id"])


def cross_source_film_ref(df: DataFrame, films: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Resolve ``film_ref_id`` (the other source's movie id) to the integrated film."""
    known = films.select(F.col("source_id").alias("film_ref_id"), "film_id", *extra)
    return df.join(known, ["film_ref_id"])


def label_join(agg: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Add display names to an aggregate table: {shared key: dimension}."""
    return star_join_inner(agg, dims)


def store_rental_counts(fact: DataFrame, stores: DataFrame) -> DataFrame:
    """Rows per store name; a store without rows is absent. Counted before the join."""
    counts = fact.groupBy("magasin_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(F.broadcast(stores.select("magasin_id", "nom")), "magasin_id").select("nom", "n")


def quarantine_unmatched(df: DataFrame, dim: DataFrame, key: str, reason: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a dimension match, rows without one plus ``reason``), from one lookup. Store it to read ``df`` once."""
    keys = dim.select(key).distinct().withColumn("_known", F.lit(True))
    matched, rejected = route_rows(df.join(keys, key, "left").select(*df.columns, "_known"), F.col("_known").isNotNull())
    return matched.drop("_known"), rejected.drop("_known").withColumn("reason", F.lit(reason))
