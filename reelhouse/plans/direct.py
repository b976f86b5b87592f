"""Direct path: raw source tables to warehouse tables.

Product and client references are resolved once per catalogue and customer row. The sales (and
rental) branches are brought to one shape and united before any join, so the fact rows meet the
calendar, the products and the clients in one join each instead of one per branch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reelhouse.functions.dates import parse_birth_date, parse_iso_date_guarded
from reelhouse.functions.people import (
    age_at_ref, age_band, gender_from_flag, gender_from_label, gender_whitelist,
)
from reelhouse.functions.text import split_name_first_last, strip_one_prefix
from reelhouse.operators.dedup import dedup_group_min, surrogate_keys
from reelhouse.operators.joins import anti_join_lower, anti_join_title, join_on_title_key, person_keys
from reelhouse.operators.shape import (
    rental_measures, required_fields_filter, sale_flags, stored_margin, union_all, union_distinct,
    valid_interval_filter,
)
from reelhouse.operators.skew import frequent_keys, join_all, pieces_of, spread_join
from reelhouse.plans import groups
from reelhouse.plans.stage import Stage
from reelhouse.plans.summaries import BUILDERS as SUMMARIES
from reelhouse.sources.tables import mapped

_KINDS = ("film", "gadget")
_PRODUCT_REF = ["ref_kind", "produit_ref"]
_CLIENT_REF = ["magasin_id", "client_ref"]


def _stripped(name: str) -> Column:
    return strip_one_prefix(F.col(name))


# --- products -----------------------------------------------------------------------------

def _film_branch(movies: DataFrame, film_id: Column) -> DataFrame:
    titled = movies.select(
        _stripped("movie_title").alias("titre"), F.lit("film").alias("type"), F.lit("movie").alias("sous_type"),
        film_id.cast("bigint").alias("film_id"),
    )
    return required_fields_filter(titled, ["titre"], ["titre"]).distinct()


def _gadget_branch(gadgets: DataFrame, title: str, kind: str) -> DataFrame:
    return gadgets.where(F.col(title).isNotNull()).select(
        _stripped(title).alias("titre"), F.lit("gadget").alias("type"), _stripped(kind).alias("sous_type"),
        F.lit(None).cast("bigint").alias("film_id"),
    ).distinct()


def dim_product(src) -> DataFrame:
    """Films of MS, then BB films not known by title; gadgets of BB, then of MMM."""
    ms_films = _film_branch(src.ms_movie, F.col("movieid"))
    bb_films = anti_join_title(_film_branch(src.bb_movie, F.lit(None)), ms_films, "titre", "titre")
    bb_gadgets = _gadget_branch(src.bb_gadget, "title", "type")
    mmm_gadgets = anti_join_lower(
        _gadget_branch(src.mmm_gadgetsales, "gadget_title", "gadget_type"), bb_gadgets, "titre", "titre"
    )
    products = union_all(ms_films, bb_films, bb_gadgets, mmm_gadgets)
    return surrogate_keys(products, ["titre", "type", "sous_type", "film_id"], "produit_id")


# --- clients ------------------------------------------------------------------------------

def bb_clients(customers: DataFrame, gender_default: str | None = None) -> DataFrame:
    """One client per (first name, last name, birth date) without regard to case."""
    known = required_fields_filter(customers, ["dob", "firstname", "lastname"])
    keys = {
        **person_keys(_stripped("firstname"), _stripped("lastname")),
        "date_naissance": parse_birth_date(F.col("dob")),
    }
    merged = dedup_group_min(known, keys, ["firstname", "lastname", "sex"])
    return mapped({
        "prenom": _stripped("firstname"), "nom": _stripped("lastname"), "date_naissance": F.col("date_naissance"),
        "genre": gender_from_label(F.col("sex"), gender_default), "magasin_id": F.lit(1),
        "code": F.lit(None).cast("string"),
    }, merged)


def ms_clients(customers: DataFrame) -> DataFrame:
    """One client per customer row with a name."""
    return mapped({
        "prenom": _stripped("name"), "nom": _stripped("surname"),
        "date_naissance": parse_iso_date_guarded(F.col("birthday")),
        "genre": gender_whitelist(F.col("gender")), "magasin_id": F.lit(2), "code": F.col("code").cast("string"),
    }, customers.where(F.col("name").isNotNull()))


def mmm_clients(*transactions: DataFrame, gender_default: str | None = None) -> DataFrame:
    """Clients rebuilt from the distinct buyers and renters of the transaction tables."""
    buyers = union_distinct(*[
        required_fields_filter(t, ["cust_name", "birthdate"]).select("cust_name", "sex_male", "birthdate")
        for t in transactions
    ])
    first, last = split_name_first_last(_stripped("cust_name"))
    return mapped({
        "prenom": first, "nom": last, "date_naissance": F.to_date("birthdate"),
        "genre": gender_from_flag(F.col("sex_male"), gender_default), "magasin_id": F.lit(3),
        "code": F.lit(None).cast("string"),
    }, buyers).distinct()


def dim_client(src, unknown: str = "Unknown") -> DataFrame:
    """Clients of the three stores, never merged across stores, with age and age band."""
    clients = union_all(
        bb_clients(src.bb_customer), ms_clients(src.ms_customer),
        mmm_clients(src.mmm_movierentals, src.mmm_moviesales, src.mmm_gadgetsales),
    )
    keyed = surrogate_keys(clients, ["magasin_id", "code", "prenom", "nom", "date_naissance", "genre"], "client_id")
    aged = keyed.withColumn("age", age_at_ref(F.col("date_naissance")))
    return aged.select(
        "client_id", "prenom", "nom", "date_naissance", "age",
        age_band(F.col("age"), unknown).alias("tranche_age"), "genre", "magasin_id",
    )


# --- references: what a raw row says -> surrogate key -------------------------------------

def _person_text(first: Column, last: Column, dob: Column) -> Column:
    """One text per person; NULL when a part is NULL, so it never matches."""
    return F.concat(F.lower(first), F.lit("|"), F.lower(last), F.lit("|"), dob.cast("string"))


def product_refs(src, products: DataFrame) -> DataFrame:
    """(ref_kind, produit_ref, produit_id); a title shared by several products gives several rows."""
    films, gadgets = (products.where(F.col("type") == kind) for kind in _KINDS)
    bb_titles = src.bb_movie.select("movie_id", _stripped("movie_title").alias("bb_titre"))
    by_title = join_on_title_key(bb_titles, films.select("produit_id", "titre"), "bb_titre", "titre")
    by_movie = films.where(F.col("film_id").isNotNull())
    copies = src.ms_copy_for_rent.select(F.col("id").alias("copy_id"), F.col("movie_id").alias("film_id"))
    by_copy = copies.join(by_movie.select("film_id", "produit_id"), ["film_id"])

    def refs(df: DataFrame, kind: str, ref: Column) -> DataFrame:
        return df.select(F.lit(kind).alias("ref_kind"), ref.cast("string").alias("produit_ref"), "produit_id")

    return union_all(
        refs(by_title, "bb_movie", F.col("movie_id")),
        refs(by_movie, "ms_movie", F.col("film_id")),
        refs(by_copy, "ms_copy", F.col("copy_id")),
        refs(gadgets, "gadget", F.lower("titre")),
    )


def client_refs(src, clients: DataFrame) -> DataFrame:
    """(magasin_id, client_ref, client_id): BB by person, MS by name alone (namesakes multiply), MMM by person."""
    known = clients.select("client_id", "magasin_id", "date_naissance", *[
        expr.alias(name) for name, expr in person_keys(F.col("prenom"), F.col("nom")).items()
    ])
    stores = {i: known.where(F.col("magasin_id") == i).drop("magasin_id") for i in (1, 2, 3)}
    bb = src.bb_customer.select(F.col("code").alias("client_ref"), *[
        expr.alias(name) for name, expr in person_keys(_stripped("firstname"), _stripped("lastname")).items()
    ], parse_birth_date(F.col("dob")).alias("date_naissance"))
    ms = src.ms_customer.select(F.col("code").cast("string").alias("client_ref"), *[
        expr.alias(name) for name, expr in person_keys(_stripped("name"), _stripped("surname")).items()
    ])

    def refs(df: DataFrame, store: int) -> DataFrame:
        return df.select(F.lit(store).alias("magasin_id"), "client_ref", "client_id")

    mmm_ref = _person_text(F.col("first_key"), F.col("last_key"), F.col("date_naissance"))
    return union_all(
        refs(bb.join(stores[1], ["first_key", "last_key", "date_naissance"]), 1),
        refs(ms.join(stores[2], ["first_key", "last_key"]), 2),
        refs(stores[3].withColumn("client_ref", mmm_ref), 3),
    )


def _mmm_client_ref() -> Column:
    return _person_text(*split_name_first_last(_stripped("cust_name")), F.to_date("birthdate"))


# --- facts --------------------------------------------------------------------------------

def _sale(df: DataFrame, store: int, kind: str, ref: Column, client: Column, price: str, cost: Column, flag: str | None = None) -> DataFrame:
    dated = sale_flags(df.where(F.col("sale_date").isNotNull()), "sale_date", flag)
    return mapped({
        "magasin_id": F.lit(store), "date_complete": F.to_date("sale_date"), "annee": F.col("annee"),
        "ca_ventes": F.col(price).cast("decimal(12,2)"), "prix_inventaire_total": cost.cast("decimal(12,2)"),
        "nb_ventes": F.col("nb_ventes"), "est_neuf": F.col("est_neuf"),
        "ref_kind": F.lit(kind), "produit_ref": ref.cast("string"), "client_ref": client.cast("string"),
    }, dated)


def sale_events(src, keep_unpriced_gadgets: bool = False) -> DataFrame:
    """The five kinds of sales in one shape, before keys are resolved."""
    none = F.lit(None)
    gadget_ref = lambda col: F.lower(_stripped(col))
    mmm_gadgets = src.mmm_gadgetsales
    if not keep_unpriced_gadgets:
        mmm_gadgets = mmm_gadgets.where(F.col("price_sale").isNotNull())
    priced = lambda df, price: df.where(F.col(price).isNotNull())
    return union_all(
        _sale(priced(src.bb_sale_item, "sale_price"), 1, "bb_movie", F.col("refers_to"), F.col("cust_id"), "sale_price", F.col("inventory_price")),
        _sale(priced(src.bb_gadget, "sale_price"), 1, "gadget", gadget_ref("title"), F.col("cust_id"), "sale_price", F.col("price")),
        _sale(priced(src.ms_copy_for_sale, "sale_price"), 2, "ms_movie", F.col("movie_id"), F.col("soldto"), "sale_price", none, "is_new"),
        _sale(priced(src.mmm_moviesales, "price_sale"), 3, "ms_movie", F.col("movie_id"), _mmm_client_ref(), "price_sale", none),
        _sale(mmm_gadgets, 3, "gadget", gadget_ref("gadget_title"), _mmm_client_ref(), "price_sale", F.col("inv_price")),
    )


def rental_events(src, min_days: int = 1) -> DataFrame:
    """The two kinds of rentals in one shape, before keys are resolved."""
    ms = src.ms_copy_rented_to.select(
        F.lit(2).alias("magasin_id"), F.lit("ms_copy").alias("ref_kind"), F.col("copy_id").cast("string").alias("produit_ref"),
        F.col("cust_id").cast("string").alias("client_ref"), F.col("from_date").alias("start"),
        F.col("to_date").alias("end"), F.col("price_day").alias("price"),
    )
    mmm = src.mmm_movierentals.select(
        F.lit(3).alias("magasin_id"), F.lit("ms_movie").alias("ref_kind"), F.col("movie_id").cast("string").alias("produit_ref"),
        _mmm_client_ref().alias("client_ref"), F.col("date_from").alias("start"),
        F.col("date_to").alias("end"), F.col("price_rent").alias("price"),
    )
    rented = rental_measures(valid_interval_filter(union_all(ms, mmm), "start", "end"), "start", "end", "price", min_days)
    return rented.withColumns({"date_complete": F.to_date("start"), "annee": F.year("start")}).drop("start", "end", "price")


# Reasons an event is not in its fact.
NO_DATE, NO_PRODUCT, NO_CLIENT = "no calendar day", "no product", "no client"


# A reference that holds a larger share of the events is split; the list of such references is shorter than 1 / share.
HOT_SHARE = 1e-2
_REFERENCES = {"produit": (_PRODUCT_REF, "ref_kind string, produit_ref string"), "client": (_CLIENT_REF, "magasin_id int, client_ref string")}


def reference_frequencies(events: DataFrame) -> DataFrame:
    """Product and client references that hold much of the events, both estimated in one pass over them."""
    return frequent_keys(events, {side: on for side, (on, _) in _REFERENCES.items()}, HOT_SHARE)


def _looked_up(found: DataFrame, refs: DataFrame, side: str, frequencies: DataFrame | None) -> DataFrame:
    """Left join of events with what their references lead to; frequent references are dealt out over several tasks."""
    on, schema = _REFERENCES[side]
    if frequencies is not None:
        hot = pieces_of(frequencies, side, schema, HOT_SHARE)
        if not hot.isEmpty():
            # The pieces are chosen by the event itself: events equal in all columns may share one.
            dealt = found.withColumn("_event", F.xxhash64(*[F.col(c) for c in found.columns if c not in on]))
            return spread_join(dealt, refs, on, "_event", hot, "left").drop("_event")
    return found.join(refs, on, "left")


def resolved(
    events: DataFrame, calendar: DataFrame, products: DataFrame, clients: DataFrame, frequencies: DataFrame | None = None, who: str = "client_id",
) -> DataFrame:
    """Events with day, product and client, and the reason of those that lack one; ``products`` and ``clients`` are references.

    One lookup each; stored, it gives the fact and its rejects. An event meets every product and client its reference leads to.
    ``frequencies`` is the stored result of ``reference_frequencies``, by which frequent references are split. ``who`` is the key that
    client references lead to.
    """
    days = F.broadcast(calendar.select("date_complete", "temps_id"))  # one row per day
    dated = events.join(days, "date_complete", "left")
    found = _looked_up(_looked_up(dated, products, "produit", frequencies), clients, "client", frequencies)
    return found.withColumn("reason", F.when(F.col("temps_id").isNull(), NO_DATE).when(F.col("produit_id").isNull(), NO_PRODUCT)
                            .when(F.col(who).isNull(), NO_CLIENT))


def rejects(found: DataFrame) -> DataFrame:
    """Resolved events that are not facts: what they said, and the first reason."""
    return found.where(F.col("reason").isNotNull()).select("magasin_id", "date_complete", *_PRODUCT_REF, "client_ref", "reason")


def sales_facts(found: DataFrame, who: str = "client_id") -> DataFrame:
    """Sales fact of resolved sales."""
    facts = found.where(F.col("reason").isNull())
    return stored_margin(facts, "ca_ventes", "prix_inventaire_total").select(
        "temps_id", "magasin_id", who, "produit_id", "annee", "ca_ventes", "prix_inventaire_total",
        "marge", "nb_ventes", "est_neuf",
    )


def rental_facts(found: DataFrame, who: str = "client_id") -> DataFrame:
    """Rentals fact of resolved rentals."""
    return found.where(F.col("reason").isNull()).select(
        "temps_id", "magasin_id", who, "produit_id", "annee", "ca_locations", "nb_locations", "nb_jours_total"
    )


def union_sales(
    src, calendar: DataFrame, products: DataFrame, clients: DataFrame, keep_unpriced_gadgets: bool = False, frequencies: DataFrame | None = None,
) -> DataFrame:
    """Sales fact of all stores in one plan."""
    events = sale_events(src, keep_unpriced_gadgets)
    return sales_facts(resolved(events, calendar, product_refs(src, products), client_refs(src, clients), frequencies))


def union_rentals(
    src, calendar: DataFrame, products: DataFrame, clients: DataFrame, min_days: int = 1, frequencies: DataFrame | None = None,
) -> DataFrame:
    """Rentals fact of the two renting stores in one plan."""
    return rental_facts(resolved(rental_events(src, min_days), calendar, product_refs(src, products), client_refs(src, clients), frequencies))


def direct_builders(calendar: DataFrame, stores: DataFrame) -> dict:
    """Builders of the warehouse tables over raw sources."""
    def by_group(s: Stage, events: DataFrame, frequencies: str) -> DataFrame:
        return resolved(events, s["dim_temps"], s["ref_produit"], s["ref_groupe"], s[frequencies] if s.stored else None, "groupe_id")

    return {
        "dim_temps": lambda s: calendar,
        "dim_magasin": lambda s: stores,
        "dim_produit": lambda s: dim_product(s.src),
        "dim_client": lambda s: dim_client(s.src),
        "ref_produit": lambda s: product_refs(s.src, s["dim_produit"]),
        "ref_client": lambda s: client_refs(s.src, s["dim_client"]),
        "freq_ventes": lambda s: reference_frequencies(sale_events(s.src)),
        "freq_locations": lambda s: reference_frequencies(rental_events(s.src)),
        "ventes_resolues": lambda s: resolved(sale_events(s.src), s["dim_temps"], s["ref_produit"], s["ref_client"], s["freq_ventes"] if s.stored else None),
        "locations_resolues": lambda s: resolved(rental_events(s.src), s["dim_temps"], s["ref_produit"], s["ref_client"], s["freq_locations"] if s.stored else None),
        "fait_ventes": lambda s: sales_facts(s["ventes_resolues"]),
        "fait_locations": lambda s: rental_facts(s["locations_resolues"]),
        "ventes_rejetees": lambda s: rejects(s["ventes_resolues"]),
        "locations_rejetees": lambda s: rejects(s["locations_resolues"]),
        "dim_groupe": lambda s: groups.client_groups(s["dim_client"]),
        "pont_groupe_client": lambda s: groups.group_members(s["dim_client"], s["dim_groupe"]),
        "ref_groupe": lambda s: groups.group_refs(s.src, s["dim_groupe"]),
        "ventes_groupes": lambda s: sales_facts(by_group(s, sale_events(s.src), "freq_ventes"), "groupe_id"),
        "locations_groupes": lambda s: rental_facts(by_group(s, rental_events(s.src), "freq_locations"), "groupe_id"),
        **SUMMARIES,
    }


FACTS = ("fait_ventes", "fait_locations")


def direct_warehouse(spark, src, calendar: DataFrame, stores: DataFrame, database: str | None = None) -> Stage:
    """All warehouse tables, lazily or stored in ``database``."""
    return Stage(spark, src, direct_builders(calendar, stores), database, by_year=(*FACTS, "ventes_groupes", "locations_groupes", *SUMMARIES))
