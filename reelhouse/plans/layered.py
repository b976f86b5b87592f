"""Layered path: raw tables to cleaned source tables, integrated tables and the warehouse.

Each function builds one table from the tables it names. Source tables keep ``source_id`` (or
``source_code``) so that later stages resolve references by equality.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reelhouse.functions.dates import parse_birth_date, parse_iso_date_guarded
from reelhouse.functions.people import age_at_ref, age_band, gender_from_flag, gender_from_label
from reelhouse.functions.text import parse_name_initial, match_key, strip_one_prefix
from reelhouse.operators.dedup import dedup_group_min, dedup_keep_first, surrogate_keys, upsert_by_key
from reelhouse.operators.joins import (
    anti_join_title, cross_source_film_ref, resolve_bridge_keys,
)
from reelhouse.operators.shape import (
    append_streams, rental_measures, route_rows, sale_flags, stock_vs_sale_split, stored_margin, tag_source,
    union_all, valid_interval_filter,
)
from reelhouse.operators.skew import join_all
from reelhouse.plans import summaries
from reelhouse.plans.stage import Stage
from reelhouse.sources.tables import mapped

_MONEY = "decimal(10,2)"


def _stripped(name: str) -> Column:
    return strip_one_prefix(F.col(name))


def _money(name: str) -> Column:
    return F.col(name).cast(_MONEY)


def _lookup(df: DataFrame, *refs: tuple[str, DataFrame, str, str]) -> DataFrame:
    """Replace each key by a value of the reference row that has it, NULL without one.

    Lookups are (key, reference, key there, value there); keys are unique in the reference.
    """
    joins = [(ref.select(F.col(ref_key).alias(key), value), [key]) for key, ref, ref_key, value in refs]
    return join_all(df, joins, "left").drop(*[key for key, *_ in refs])


# --- first source -------------------------------------------------------------------------

def bb_film(src) -> DataFrame:
    films = mapped({
        "source_id": _stripped("movie_id"), "titre": _stripped("movie_title"),
        "annee": _stripped("movie_year").try_cast("int"),
    }, src.bb_movie)
    return surrogate_keys(films, ["source_id"], "film_id")


def bb_acteur(src) -> DataFrame:
    actors = mapped({"source_id": _stripped("actor_id"), "nom": _stripped("actor_name")}, src.bb_actor)
    return surrogate_keys(actors, ["source_id"], "acteur_id")


def bb_joue_dans(src, films: DataFrame, actors: DataFrame) -> DataFrame:
    pairs = mapped({"film_source_id": _stripped("movieid"), "acteur_source_id": _stripped("actorid")}, src.bb_actsin)
    return resolve_bridge_keys(pairs, films, actors)


def _bb_people(src) -> DataFrame:
    return mapped({
        "source_code": _stripped("code"), "prenom": _stripped("firstname"), "nom": _stripped("lastname"),
        "date_naissance": parse_birth_date(F.col("dob")), "genre": gender_from_label(F.col("sex")),
    }, src.bb_customer)


def _bb_person() -> list[Column]:
    return [F.lower("prenom"), F.lower("nom"), F.col("date_naissance")]


def bb_client(src, existing: DataFrame | None = None) -> DataFrame:
    """Customers with the smallest source code of each person; codes are text, so '10' precedes '9'."""
    kept = dedup_keep_first(_bb_people(src), _bb_person(), [F.col("source_code")])
    return surrogate_keys(kept, ["source_code"], "client_id", existing)


def bb_client_codes(src, clients: DataFrame) -> DataFrame:
    """(source_code, client_id) for every raw code, duplicates leading to the kept client."""
    names = ["k_prenom", "k_nom", "k_date"]
    # a person without a birth date is still one group, so missing parts count as equal here
    keyed = lambda df: df.withColumns({
        n: F.coalesce(e.cast("string"), F.lit("")) for n, e in zip(names, _bb_person())
    })
    known = keyed(clients).select("client_id", *names)
    return keyed(_bb_people(src)).select("source_code", *names).join(known, names).select("source_code", "client_id")


def bb_vente_film(src, films: DataFrame, client_codes: DataFrame) -> DataFrame:
    """Items with a price; client and film resolved, NULL when unknown."""
    sold, _stock = stock_vs_sale_split(src.bb_sale_item, "sale_price")
    sales = mapped({
        "source_id": F.col("id"), "date_vente": F.to_date("sale_date"), "prix_vente": _money("sale_price"),
        "prix_inventaire": _money("inventory_price"), "type_produit": _stripped("type"),
        "client_code": _stripped("cust_id"), "film_code": _stripped("refers_to"),
    }, sold)
    return _lookup(
        sales, ("client_code", client_codes, "source_code", "client_id"), ("film_code", films, "source_id", "film_id")
    )


def bb_vente_gadget(src, client_codes: DataFrame) -> DataFrame:
    sales = mapped({
        "source_id": F.col("id"), "titre": _stripped("title"), "type_gadget": _stripped("type"),
        "date_vente": F.to_date("sale_date"), "prix_vente": _money("sale_price"), "prix_inventaire": _money("price"),
        "client_code": _stripped("cust_id"),
    }, src.bb_gadget)
    return _lookup(sales, ("client_code", client_codes, "source_code", "client_id"))


# --- second source ------------------------------------------------------------------------

def ms_film(src) -> DataFrame:
    films = mapped({
        "source_id": F.col("movieid"), "titre": _stripped("movie_title"), "annee_production": F.col("production_year"),
        "date_sortie": F.to_date("release_date"), "prix_sortie": _money("release_price"),
        "realisateur": _stripped("director"), "scenariste": _stripped("writer"),
    }, src.ms_movie)
    return surrogate_keys(films, ["source_id"], "film_id")


def ms_acteur(src) -> DataFrame:
    actors = mapped({"source_id": F.col("actor_id"), "nom": _stripped("actor_name")}, src.ms_actor)
    return surrogate_keys(actors, ["source_id"], "acteur_id")


def ms_joue_dans(src, films: DataFrame, actors: DataFrame) -> DataFrame:
    pairs = mapped({"film_source_id": F.col("movie_id"), "acteur_source_id": F.col("actor_id")}, src.ms_acts_in)
    return resolve_bridge_keys(pairs, films, actors)


def ms_client(src, existing: DataFrame | None = None) -> DataFrame:
    """Customers upserted on their source code."""
    clients = surrogate_keys(mapped({
        "source_code": F.col("code"), "prenom": _stripped("name"), "initiale": _stripped("middlename"),
        "nom": _stripped("surname"), "genre": F.col("gender"),
        "date_naissance": parse_iso_date_guarded(F.col("birthday")), "adresse": _stripped("address"),
    }, src.ms_customer), ["source_code"], "client_id", existing)
    if existing is None:
        return clients
    changed = [c for c in clients.columns if c not in ("source_code", "client_id")]
    return upsert_by_key(existing, clients, ["source_code"], changed)


def ms_copie_location(src, films: DataFrame) -> DataFrame:
    copies = mapped({
        "source_id": F.col("id"), "type_copie": _stripped("copy_type"), "disposed": F.col("disposed"),
        "film_code": F.col("movie_id"),
    }, src.ms_copy_for_rent)
    return surrogate_keys(_lookup(copies, ("film_code", films, "source_id", "film_id")), ["source_id"], "copie_id")


def ms_copie_vente(src, films: DataFrame, clients: DataFrame) -> DataFrame:
    copies = mapped({
        "source_id": F.col("id"), "type_copie": _stripped("copy_type"), "est_neuf": F.col("is_new"),
        "prix_vente": _money("sale_price"), "date_vente": F.to_date("sale_date"),
        "film_code": F.col("movie_id"), "client_code": F.col("soldto"),
    }, src.ms_copy_for_sale)
    return _lookup(
        copies, ("film_code", films, "source_id", "film_id"), ("client_code", clients, "source_code", "client_id")
    )


def ms_location(src, copies: DataFrame, clients: DataFrame) -> DataFrame:
    rentals = mapped({
        "date_debut": F.to_date("from_date"), "date_fin": F.to_date("to_date"), "prix_jour": _money("price_day"),
        "copy_code": F.col("copy_id"), "client_code": F.col("cust_id"),
    }, src.ms_copy_rented_to)
    return _lookup(
        rentals, ("copy_code", copies, "source_id", "copie_id"), ("client_code", clients, "source_code", "client_id")
    )


# --- third source -------------------------------------------------------------------------

def rebuild_clients(rentals: DataFrame, sales: DataFrame, gadgets: DataFrame, gender_default: str | None = None) -> DataFrame:
    """Clients of the three transaction tables, one per (full name, birth date).

    Only rentals carry an address. Of a client's rows the first in (full name, gender) order is
    kept, with the largest address any row has.
    """
    buyers = append_streams(*[
        t.where(F.col("cust_name").isNotNull()).select(
            "cust_name", "sex_male", "birthdate", *[c for c in ("address",) if c in t.columns]
        ) for t in (rentals, sales, gadgets)
    ])
    # a hash aggregate leaves about one row per client and task before anything is sorted
    cleaned = mapped({
        "nom_complet": _stripped("cust_name"), "genre": gender_from_flag(F.col("sex_male"), gender_default),
        "date_naissance": F.to_date("birthdate"), "adresse": _stripped("address"),
    }, buyers.distinct())
    kept = cleaned.groupBy(F.lower("nom_complet").alias("k"), "date_naissance").agg(
        F.min(F.struct("nom_complet", "genre")).alias("first"), F.max("adresse").alias("adresse")
    )
    first, initial, last = parse_name_initial(F.col("first.nom_complet"))
    return mapped({
        "prenom": first, "initiale": initial, "nom": last, "nom_complet": F.col("first.nom_complet"),
        "genre": F.col("first.genre"), "date_naissance": F.col("date_naissance"), "adresse": F.col("adresse"),
    }, kept)


def mmm_client(src, existing: DataFrame | None = None) -> DataFrame:
    clients = rebuild_clients(src.mmm_movierentals, src.mmm_moviesales, src.mmm_gadgetsales)
    return surrogate_keys(clients, ["nom_complet", "date_naissance"], "client_id", existing)


def _mmm_person(name: Column, dob: str) -> Column:
    return F.concat(F.lower(name), F.lit("|"), F.to_date(dob).cast("string"))


def _with_mmm_client(df: DataFrame, clients: DataFrame) -> DataFrame:
    known = clients.withColumn("person", _mmm_person(F.col("nom_complet"), "date_naissance"))
    return _lookup(df, ("person", known, "person", "client_id"))


def mmm_location_film(src, clients: DataFrame) -> DataFrame:
    rentals = mapped({
        "source_id": F.col("ref_no"), "film_ref_id": F.col("movie_id"), "date_debut": F.to_date("date_from"),
        "date_fin": F.to_date("date_to"), "prix_jour": _money("price_rent"), "person": _mmm_person(_stripped("cust_name"), "birthdate"),
    }, src.mmm_movierentals)
    return _with_mmm_client(rentals, clients)


def mmm_vente_film(src, clients: DataFrame) -> DataFrame:
    """Film sales; a missing price is kept as NULL."""
    sales = mapped({
        "source_id": F.col("ref_no"), "film_ref_id": F.col("movie_id"), "date_vente": F.to_date("sale_date"),
        "prix_vente": _money("price_sale"), "person": _mmm_person(_stripped("cust_name"), "birthdate"),
    }, src.mmm_moviesales)
    return _with_mmm_client(sales, clients)


def mmm_vente_gadget(src, clients: DataFrame) -> DataFrame:
    sales = mapped({
        "source_id": F.col("ref_no"), "type_gadget": _stripped("gadget_type"), "titre_gadget": _stripped("gadget_title"),
        "date_vente": F.to_date("sale_date"), "prix_vente": _money("price_sale"), "prix_inventaire": _money("inv_price"),
        "date_inventaire": F.to_date("inv_date"), "person": _mmm_person(_stripped("cust_name"), "birthdate"),
    }, src.mmm_gadgetsales)
    return _with_mmm_client(sales, clients)


# --- integration --------------------------------------------------------------------------

def int_film(bb_films: DataFrame, ms_films: DataFrame) -> DataFrame:
    """MS films first, then BB films whose normalised title is not among them."""
    ms = ms_films.select(
        F.lit("MS").alias("source"), F.col("source_id").cast("string").alias("source_id"), "titre", "annee_production",
        "date_sortie", "prix_sortie", "realisateur", "scenariste",
    )
    bb = anti_join_title(
        bb_films.select(F.lit("BB").alias("source"), "source_id", "titre", F.col("annee").alias("annee_production")),
        ms_films, "titre", "titre",
    )
    films = surrogate_keys(append_streams(ms, bb), ["source", "source_id"], "film_id")
    return films.withColumn("type_film", F.lit(None).cast("string"))


def film_xref(films: DataFrame, bb_films: DataFrame, ms_films: DataFrame) -> DataFrame:
    """(source, source_film_id, film_id): a BB film leads to its own row or to the first MS match."""
    own = lambda source, df, cast: df.select(
        F.col("film_id").alias("source_film_id"), cast.alias("source_id")
    ).join(films.where(F.col("source") == source).select("source_id", "film_id"), "source_id").select(
        F.lit(source).alias("source"), "source_film_id", "film_id"
    )
    by_title = films.where(F.col("source") == "MS").groupBy(match_key(F.col("titre")).alias("k")).agg(
        F.min("film_id").alias("film_id")
    )
    matched = bb_films.select(F.col("film_id").alias("source_film_id"), match_key(F.col("titre")).alias("k"))
    return union_all(
        own("MS", ms_films, F.col("source_id").cast("string")), own("BB", bb_films, F.col("source_id")),
        matched.join(by_title, ["k"]).select(F.lit("BB").alias("source"), "source_film_id", "film_id"),
    )


def actor_key(name: Column) -> Column:
    """The normalised name; a name without Latin letters or digits stands for itself."""
    return F.coalesce(match_key(name), F.concat(F.lit("="), F.lower(name)))


def merge_actors(bb: DataFrame, ms: DataFrame) -> DataFrame:
    """Actors merged on their normalised name, the MS spelling first."""
    named = union_all(
        ms.select("nom", F.lit(0).alias("rank")), bb.select("nom", F.lit(1).alias("rank"))
    ).where(F.col("nom").isNotNull())
    kept = dedup_keep_first(named, [actor_key(F.col("nom"))], [F.col("rank"), F.col("nom")], ["nom"])
    return surrogate_keys(kept, ["nom"], "acteur_id")


def actor_xref(actors: DataFrame, bb: DataFrame, ms: DataFrame) -> DataFrame:
    """(source, source_acteur_id, acteur_id)."""
    keyed = actors.select("acteur_id", actor_key(F.col("nom")).alias("k"))
    each = union_all(*[
        df.select(F.lit(s).alias("source"), F.col("acteur_id").alias("source_acteur_id"), actor_key(F.col("nom")).alias("k"))
        for s, df in (("BB", bb), ("MS", ms))
    ])
    return each.join(keyed, ["k"]).drop("k")


def int_joue_dans(bb: DataFrame, ms: DataFrame, films: DataFrame, actors: DataFrame) -> DataFrame:
    """Links of both sources on integrated ids (cross references of films and actors given)."""
    links = union_all(*[
        df.select(F.lit(s).alias("source"), F.col("film_id").alias("source_film_id"), F.col("acteur_id").alias("source_acteur_id"))
        for s, df in (("BB", bb), ("MS", ms))
    ])
    joined = join_all(links, [(films, ["source", "source_film_id"]), (actors, ["source", "source_acteur_id"])])
    return joined.select("film_id", "acteur_id").distinct()


def int_client(bb: DataFrame, ms: DataFrame, mmm: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Clients of the three sources, tagged and not merged; ``source_client_id`` leads back."""
    tagged = append_streams(
        tag_source(bb, 1, "BB"), tag_source(ms.withColumn("source_code", F.col("source_code").cast("string")), 2, "MS"),
        tag_source(mmm.drop("nom_complet"), 3, "MMM"),
    ).withColumnRenamed("client_id", "source_client_id")
    keyed = surrogate_keys(tagged, ["source", "source_client_id"], "client_id", existing)
    return keyed.select(
        "client_id", "prenom", "initiale", "nom", "date_naissance", "genre", "adresse", "magasin_id", "source",
        "source_code", "source_client_id",
    )


_PRODUCT_KEY = ["titre", "type", "magasin_id"]


def _as_product(df: DataFrame, store: int, kind: str, title: Column, **cols: Column) -> DataFrame:
    none = {"sous_type": "string", "prix_inventaire": _MONEY, "date_inventaire": "date", "film_id": "bigint"}
    return mapped({
        "titre": title, "type": F.lit(kind), "magasin_id": F.lit(store),
        **{name: cols.get(name, F.lit(None)).cast(t) for name, t in none.items()},
    }, df)


def build_products(branches: list[DataFrame]) -> DataFrame:
    """One product per (title, type, store); each other column is its minimum over the copies."""
    copies = union_all(*branches).where(F.col("titre").isNotNull())
    # texts are keys here and only numbers are reduced: a hash aggregate over the many copies
    kinds = dedup_group_min(copies, {k: F.col(k) for k in (*_PRODUCT_KEY, "sous_type")}, ["prix_inventaire", "date_inventaire", "film_id"])
    merged = dedup_group_min(kinds, {k: F.col(k) for k in _PRODUCT_KEY}, ["sous_type", "prix_inventaire", "date_inventaire", "film_id"])
    return surrogate_keys(merged, _PRODUCT_KEY, "produit_id")


def _with_film(df: DataFrame, source: str, xref: DataFrame, films: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Replace the source's film id by the integrated one and add its title and ``extra`` columns."""
    own = xref.where(F.col("source") == source).join(films.select("film_id", "titre", *extra), "film_id").select(
        F.col("source_film_id").alias("_film"), "film_id", "titre", *extra
    )
    return df.withColumnRenamed("film_id", "_film").join(own, ["_film"], "left").drop("_film")


def _mmm_film(df: DataFrame, films: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Resolve a film reference, which is the MS movie id; references without a film drop."""
    ms = films.where(F.col("source") == "MS").select(F.col("source_id").cast("bigint").alias("source_id"), "film_id", "titre", *extra)
    return cross_source_film_ref(df, ms, ("titre", *extra)).drop("film_ref_id")


def int_produit(s: Stage) -> DataFrame:
    """Products of the six kinds of copies, gadgets and rentals."""
    xref, films = s["film_xref"], s["int_film"]
    film_title = F.col("titre")
    bb_films = s["bb_vente_film"].groupBy("film_id", F.col("type_produit").alias("sous_type")).agg(
        F.min("prix_inventaire").alias("prix_inventaire")
    )
    ms_copies = [
        s[name].select("film_id", F.col("type_copie").alias("sous_type")).distinct()
        for name in ("ms_copie_location", "ms_copie_vente")
    ]
    mmm_films = s["mmm_location_film"].select("film_ref_id").distinct()
    named = lambda df, **kw: {**{c: F.col(c) for c in ("sous_type", "prix_inventaire", "film_id") if c in df.columns}, **kw}
    bb = _with_film(bb_films, "BB", xref, films)
    branches = [_as_product(bb, 1, "film", film_title, **named(bb))]
    for copies in ms_copies:
        ms = _with_film(copies, "MS", xref, films)
        branches.append(_as_product(ms, 2, "film", film_title, **named(ms)))
    mmm = _mmm_film(mmm_films, films)
    branches.append(_as_product(mmm, 3, "film", film_title, **named(mmm)))
    branches.append(_as_product(
        s["bb_vente_gadget"], 1, "gadget", film_title, sous_type=F.col("type_gadget"), prix_inventaire=F.col("prix_inventaire")
    ))
    branches.append(_as_product(
        s["mmm_vente_gadget"], 3, "gadget", F.col("titre_gadget"), sous_type=F.col("type_gadget"),
        prix_inventaire=F.col("prix_inventaire"), date_inventaire=F.col("date_inventaire"),
    ))
    return build_products(branches)


def _products_of(s: Stage, kind: str, store: int) -> DataFrame:
    """(titre, produit_id) of one kind of products in one store; titles are unique there."""
    products = s["int_produit"].where((F.col("type") == kind) & (F.col("magasin_id") == store))
    return products.select("titre", "produit_id")


def _store_films(s: Stage, store: int) -> DataFrame:
    """Integrated films with the store's product, NULL without one: products are looked up per film, not per sale."""
    return s["int_film"].join(_products_of(s, "film", store), ["titre"], "left")


def row_id(key: list[Column], number: Column) -> Column:
    """128-bit id of a source row, so that a reload finds the same row: its ``key``, and a number among rows that repeat the key."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("-")) for c in key], number))


def _integrated(rows: DataFrame, s: Stage, id_name: str, key: list[Column], rest: list[str]) -> DataFrame:
    """Attach ids and integrated clients to rows with ``_client``, the client's id in the source.

    Rows of one key are numbered in the order of ``rest``; rows equal in everything are interchangeable. They meet the clients
    with that number alone: titles end at the numbering and ids are made after the last shuffle, so none carries both.
    """
    numbered = rows.withColumn("_number", F.row_number().over(Window.partitionBy(*key).orderBy(*rest))).drop("titre")
    clients = s["int_client"].select("source", F.col("source_client_id").alias("_client"), "client_id")
    return join_all(numbered, [(clients, ["source", "_client"])], "left").withColumn(id_name, row_id(key, F.col("_number")))


def int_vente(s: Stage) -> DataFrame:
    """Sales of the five kinds."""
    xref, product = s["film_xref"], ("produit_id",)
    none = F.lit(0)

    def branch(df: DataFrame, store: int, source: str, kind: str, is_new: Column = none) -> DataFrame:
        return tag_source(df, store, source).select(
            "source_id", "date_vente", "prix_vente", F.coalesce(is_new.cast("int"), none).alias("est_neuf"), F.col("client_id").alias("_client"),
            "titre", "produit_id", F.lit(kind).alias("type"), "magasin_id", "source",
        )

    def gadgets(df: DataFrame, store: int) -> DataFrame:
        return df.join(_products_of(s, "gadget", store), ["titre"], "left")

    rows = union_all(
        branch(_with_film(s["bb_vente_film"], "BB", xref, _store_films(s, 1), product), 1, "BB", "film"),
        branch(gadgets(s["bb_vente_gadget"], 1), 1, "BB", "gadget"),
        branch(_with_film(s["ms_copie_vente"], "MS", xref, _store_films(s, 2), product), 2, "MS", "film", is_new=F.col("est_neuf")),
        branch(_mmm_film(s["mmm_vente_film"], _store_films(s, 3), product), 3, "MMM", "film"),
        branch(gadgets(s["mmm_vente_gadget"].withColumnRenamed("titre_gadget", "titre"), 3), 3, "MMM", "gadget"),
    )
    key = [F.col(c) for c in ("source", "type", "source_id")]
    return _integrated(rows, s, "vente_id", key, ["date_vente", "prix_vente", "titre", "_client", "est_neuf"]).select(
        "vente_id", "date_vente", "prix_vente", "est_neuf", "client_id",
        "produit_id", "magasin_id", "source",
    )


def int_location(s: Stage) -> DataFrame:
    """Rentals of the two renting sources.

    One source gives its rentals no number: there the id is made of all columns.
    """
    product = ("produit_id",)
    copies = _with_film(s["ms_copie_location"].select("copie_id", "film_id"), "MS", s["film_xref"], _store_films(s, 2), product)
    ms = s["ms_location"].join(copies, ["copie_id"], "left")
    mmm = _mmm_film(s["mmm_location_film"], _store_films(s, 3), product)
    rows = union_all(*[
        tag_source(df, store, source).select(
            F.col(ref).alias("_ref"), "date_debut", "date_fin", "prix_jour", F.col("client_id").alias("_client"), "titre", "produit_id",
            "magasin_id", "source",
        ) for df, store, source, ref in ((ms, 2, "MS", "copie_id"), (mmm, 3, "MMM", "source_id"))
    ])
    ref = F.col("_ref").cast("string")
    source_id = F.when(F.col("source") == "MMM", ref).otherwise(F.concat_ws("|", ref, F.col("_client").cast("string"), F.col("date_debut").cast("string")))
    key = [F.col("source"), source_id]
    return _integrated(rows, s, "location_id", key, ["date_debut", "date_fin", "prix_jour", "titre", "_client"]).select(
        "location_id", "date_debut", "date_fin", "prix_jour", "client_id",
        "produit_id", "magasin_id", "source",
    )


# --- warehouse ----------------------------------------------------------------------------

def load_dim_product(products: DataFrame) -> DataFrame:
    return products.select("produit_id", "titre", "type", "sous_type", "film_id")


def load_dim_client(clients: DataFrame, existing: DataFrame | None = None, unknown: str = "Unknown") -> DataFrame:
    """Clients with and without a birth date, aged, banded and upserted on ``client_id``."""
    base = clients.select("client_id", "prenom", "nom", "date_naissance", "genre", "magasin_id")
    dated, undated = route_rows(base, F.col("date_naissance").isNotNull())
    aged = union_all(
        dated.withColumn("age", age_at_ref(F.col("date_naissance"), clamp=False)),
        undated.withColumn("age", F.lit(None).cast("int")),
    )
    rows = aged.select(
        "client_id", "prenom", "nom", "date_naissance", "age", age_band(F.col("age"), unknown).alias("tranche_age"),
        "genre", "magasin_id",
    )
    return rows if existing is None else upsert_by_key(existing, rows, ["client_id"])


# Reasons a sale is not in the fact.
NO_DATE, NO_PRODUCT = "no calendar day", "no product"


def dated_sales(sales: DataFrame, products: DataFrame, calendar: DataFrame) -> DataFrame:
    """Priced sales with cost, calendar day and the reason they can't be facts, from one lookup each; store it."""
    priced = sales.where(F.col("date_vente").isNotNull() & F.col("prix_vente").isNotNull())
    costs = products.select("produit_id", F.col("prix_inventaire").alias("prix_inventaire_total"), F.lit(True).alias("_product"))
    days = F.broadcast(calendar.select("temps_id", F.col("date_complete").alias("date_vente")))  # one row per day
    found = priced.join(costs, "produit_id", "left").join(days, "date_vente", "left")
    reason = F.when(F.col("temps_id").isNull(), NO_DATE).when(F.col("_product").isNull(), NO_PRODUCT)
    return found.withColumn("reason", reason).drop("_product")


def load_fact_sales(dated: DataFrame, existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(sales fact, sales left out with the reason) of ``dated_sales``, the fact upserted on ``vente_id``."""
    found, missing = route_rows(dated, F.col("reason").isNull())
    fact = sale_flags(found, "date_vente", "est_neuf").withColumns({
        "ca_ventes": F.col("prix_vente").cast("decimal(12,2)"),
        "prix_inventaire_total": F.col("prix_inventaire_total").cast("decimal(12,2)"),
    })
    fact = stored_margin(fact, "ca_ventes", "prix_inventaire_total").select(
        "vente_id", "temps_id", "magasin_id", "client_id", "produit_id", "annee", "ca_ventes", "prix_inventaire_total",
        "marge", "nb_ventes", "est_neuf",
    )
    return (fact if existing is None else upsert_by_key(existing, fact, ["vente_id"])), missing.drop("temps_id")


def load_fact_rentals(rentals: DataFrame, calendar: DataFrame, min_days: int = 1) -> DataFrame:
    """Rentals with both dates and the end after the start, on calendar days."""
    valid = rental_measures(valid_interval_filter(rentals, "date_debut", "date_fin"), "date_debut", "date_fin", "prix_jour", min_days)
    days = F.broadcast(calendar.select("temps_id", F.col("date_complete").alias("date_debut")))  # one row per day
    return valid.join(days, "date_debut").select(
        "location_id", "temps_id", "magasin_id", "client_id", "produit_id", F.year("date_debut").alias("annee"),
        "ca_locations", "nb_locations", "nb_jours_total",
    )


def layered_builders(calendar: DataFrame, stores: DataFrame) -> dict:
    """Builders of every cleaned, integrated and warehouse table, in load order."""
    return {
        "bb_film": lambda s: bb_film(s.src),
        "bb_acteur": lambda s: bb_acteur(s.src),
        "bb_joue_dans": lambda s: bb_joue_dans(s.src, s["bb_film"], s["bb_acteur"]),
        "bb_client": lambda s: bb_client(s.src),
        "bb_client_codes": lambda s: bb_client_codes(s.src, s["bb_client"]),
        "bb_vente_film": lambda s: bb_vente_film(s.src, s["bb_film"], s["bb_client_codes"]),
        "bb_vente_gadget": lambda s: bb_vente_gadget(s.src, s["bb_client_codes"]),
        "ms_film": lambda s: ms_film(s.src),
        "ms_acteur": lambda s: ms_acteur(s.src),
        "ms_joue_dans": lambda s: ms_joue_dans(s.src, s["ms_film"], s["ms_acteur"]),
        "ms_client": lambda s: ms_client(s.src),
        "ms_copie_location": lambda s: ms_copie_location(s.src, s["ms_film"]),
        "ms_copie_vente": lambda s: ms_copie_vente(s.src, s["ms_film"], s["ms_client"]),
        "ms_location": lambda s: ms_location(s.src, s["ms_copie_location"], s["ms_client"]),
        "mmm_client": lambda s: mmm_client(s.src),
        "mmm_location_film": lambda s: mmm_location_film(s.src, s["mmm_client"]),
        "mmm_vente_film": lambda s: mmm_vente_film(s.src, s["mmm_client"]),
        "mmm_vente_gadget": lambda s: mmm_vente_gadget(s.src, s["mmm_client"]),
        "int_film": lambda s: int_film(s["bb_film"], s["ms_film"]),
        "film_xref": lambda s: film_xref(s["int_film"], s["bb_film"], s["ms_film"]),
        "int_acteur": lambda s: merge_actors(s["bb_acteur"], s["ms_acteur"]),
        "actor_xref": lambda s: actor_xref(s["int_acteur"], s["bb_acteur"], s["ms_acteur"]),
        "int_joue_dans": lambda s: int_joue_dans(s["bb_joue_dans"], s["ms_joue_dans"], s["film_xref"], s["actor_xref"]),
        "int_client": lambda s: int_client(s["bb_client"], s["ms_client"], s["mmm_client"]),
        "int_produit": int_produit,
        "int_vente": int_vente,
        "int_location": int_location,
        "dim_temps": lambda s: calendar,
        "dim_magasin": lambda s: stores,
        "dim_produit": lambda s: load_dim_product(s["int_produit"]),
        "dim_client": lambda s: load_dim_client(s["int_client"]),
        "ventes_datees": lambda s: dated_sales(s["int_vente"], s["int_produit"], s["dim_temps"]),
        "fait_ventes": lambda s: load_fact_sales(s["ventes_datees"])[0],
        "ventes_rejetees": lambda s: load_fact_sales(s["ventes_datees"])[1],
        "fait_locations": lambda s: load_fact_rentals(s["int_location"], s["dim_temps"]),
        **summaries.BUILDERS,
    }


# Tables built from the rows of sales and rentals.
LARGE = (
    "bb_joue_dans", "bb_vente_film", "bb_vente_gadget", "ms_joue_dans", "ms_copie_vente", "ms_location", "mmm_client", "mmm_location_film",
    "mmm_vente_film", "mmm_vente_gadget", "int_joue_dans", "int_produit", "int_vente", "int_location", "ventes_datees", "fait_ventes",
    "ventes_rejetees", "fait_locations", *summaries.BUILDERS,
)


def layered_warehouse(spark, src, calendar: DataFrame, stores: DataFrame, database: str | None = None) -> Stage:
    """All layered tables, lazily or stored in ``database``."""
    by_year = ("fait_ventes", "fait_locations", *summaries.BUILDERS)
    return Stage(spark, src, layered_builders(calendar, stores), database, by_year, LARGE)


def run_layered(stage: Stage) -> DataFrame:
    """Extract, integrate and load every table; the result counts the rows of each."""
    return summaries.load_and_report(stage, stage.names)
