"""Registered queries: joins, deduplication and data quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from reelhouse.functions import dates, people, text
from reelhouse.operators import dedup, joins, quality
from reelhouse.plans import layered
from reelhouse.registry import oracle as o
from reelhouse.registry.workspace import query

strip = text.strip_one_prefix


# --- joins --------------------------------------------------------------------------------

@query("star_join_inner", """SELECT o_orderkey, t.annee, t.mois, n_name, c_mktsegment FROM orders
    JOIN dim_temps t ON t.date_complete = CAST(o_orderdate AS DATE) JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""")
def star_join_inner(k):
    src = k.src.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("date_complete"), F.col("o_custkey").alias("c_custkey"))
    joined = joins.star_join_inner(src, {
        "date_complete": k.calendar.select("date_complete", "annee", "mois"),
        "c_custkey": k.src.table("customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment"),
        "n_nationkey": k.src.table("nation").select("n_nationkey", "n_name"),
    })
    return joined.select("o_orderkey", "annee", "mois", "n_name", "c_mktsegment")


@query("join_on_title_key", f"""SELECT b.movie_id, m.movieid FROM bb_movie b JOIN ms_movie m
    ON {o.tkey(o.strip('b.movie_title'))} = {o.tkey(o.strip('m.movie_title'))}""")
def join_on_title_key(k):
    bb = k.src.bb_movie.select("movie_id", strip(F.col("movie_title")).alias("bb_titre"))
    ms = k.src.ms_movie.select("movieid", strip(F.col("movie_title")).alias("ms_titre"))
    return joins.join_on_title_key(bb, ms, "bb_titre", "ms_titre").select("movie_id", "movieid")


@query("join_on_person_key", f"""SELECT b.code, c.client_id FROM bb_customer b JOIN dim_client c ON c.magasin_id = 1
    AND lower(c.prenom) = lower({o.strip('b.firstname')}) AND lower(c.nom) = lower({o.strip('b.lastname')}) AND c.date_naissance = {o.us_date('b.dob')}""")
def join_on_person_key(k):
    people_ = k.src.bb_customer.select(
        "code", strip(F.col("firstname")).alias("prenom"), strip(F.col("lastname")).alias("nom"),
        dates.parse_us_date(F.col("dob")).alias("date_naissance"),
    )
    return joins.join_on_person_key(people_, k.direct["dim_client"], 1).select("code", "client_id")


@query("join_on_name_only", f"""SELECT m.code, c.client_id FROM ms_customer m JOIN dim_client c ON c.magasin_id = 2
    AND lower(c.prenom) = lower({o.strip('m.name')}) AND lower(c.nom) = lower({o.strip('m.surname')})""")
def join_on_name_only(k):
    named = k.src.ms_customer.select("code", strip(F.col("name")).alias("prenom"), strip(F.col("surname")).alias("nom"))
    return joins.join_on_name_only(named, k.direct["dim_client"], 2).select("code", "client_id")


@query("anti_join_title", f"""SELECT movie_id, {o.strip('movie_title')} AS titre FROM bb_movie b WHERE NOT EXISTS
    (SELECT 1 FROM ms_movie m WHERE {o.tkey(o.strip('m.movie_title'))} = {o.tkey(o.strip('b.movie_title'))})""")
def anti_join_title(k):
    bb = k.src.bb_movie.select("movie_id", strip(F.col("movie_title")).alias("titre"))
    ms = k.src.ms_movie.select(strip(F.col("movie_title")).alias("connu"))
    return joins.anti_join_title(bb, ms, "titre", "connu")


@query("anti_join_lower", """SELECT DISTINCT gadget_title FROM mmm_gadgetsales g WHERE NOT EXISTS
    (SELECT 1 FROM bb_gadget b WHERE lower(b.title) = lower(g.gadget_title))""")
def anti_join_lower(k):
    known = k.src.bb_gadget.select("title")
    return joins.anti_join_lower(k.src.mmm_gadgetsales.select("gadget_title").distinct(), known, "gadget_title", "title")


@query("lookup_left", """SELECT s.id, s.refers_to, f.movie_year FROM bb_sale_item s LEFT JOIN bb_movie f ON f.movie_id = s.refers_to""")
def lookup_left(k):
    sales = k.src.bb_sale_item.select("id", F.col("refers_to").alias("movie_id"))
    found = joins.lookup_left(sales, k.src.bb_movie, "movie_id", ["movie_year"], [F.col("movie_title")])
    return found.withColumnRenamed("movie_id", "refers_to")


@query("lookup_first_match", f"""SELECT b.movie_id, (SELECT min(m.movieid) FROM ms_movie m
    WHERE {o.tkey(o.strip('m.movie_title'))} = {o.tkey(o.strip('b.movie_title'))}) AS film_id FROM bb_movie b""")
def lookup_first_match(k):
    key = lambda df: df.withColumn("title_key", text.title_key(strip(F.col("movie_title"))))
    ref = key(k.src.ms_movie).select("title_key", F.col("movieid").alias("film_id"))
    matched, unmatched = joins.lookup_first_match(key(k.src.bb_movie), ref, "title_key", "film_id")
    return matched.unionByName(unmatched).select("movie_id", "film_id")


@query("copy_chain_join", """SELECT r.cust_id, r.price_day, p.produit_id FROM ms_copy_rented_to r JOIN ms_copy_for_rent c ON c.id = r.copy_id
    JOIN ms_movie m ON m.movieid = c.movie_id JOIN dim_produit p ON p.type = 'film' AND p.film_id = m.movieid""")
def copy_chain_join(k):
    chained = joins.copy_chain_join(k.src.ms_copy_rented_to, k.src.ms_copy_for_rent, k.src.ms_movie, k.direct["dim_produit"])
    return chained.select("cust_id", "price_day", "produit_id")


@query("resolve_bridge_keys", "SELECT film_id, acteur_id FROM bb_joue_dans")
def resolve_bridge_keys(k):
    pairs = k.src.bb_actsin.select(strip(F.col("movieid")).alias("film_source_id"), strip(F.col("actorid")).alias("acteur_source_id"))
    return joins.resolve_bridge_keys(pairs, k.layered["bb_film"], k.layered["bb_acteur"])


@query("cost_enrichment", """SELECT v.date_vente, v.prix_vente, v.produit_id, p.prix_inventaire AS prix_inventaire_total
    FROM int_vente v JOIN int_produit p USING (produit_id)""")
def cost_enrichment(k):
    sales = k.layered["int_vente"].select("date_vente", "prix_vente", "produit_id")
    return joins.cost_enrichment(sales, k.layered["int_produit"])


@query("cross_source_film_ref", "SELECT v.source_id, f.film_id FROM mmm_vente_film v JOIN ms_film f ON f.source_id = v.film_ref_id")
def cross_source_film_ref(k):
    sales = k.layered["mmm_vente_film"].select("source_id", "film_ref_id")
    return joins.cross_source_film_ref(sales, k.layered["ms_film"]).select("source_id", "film_id")


@query("label_join", """SELECT annee, mois, nom, titre, nb_locations FROM agg_locations_mois_produit_magasin
    JOIN dim_magasin USING (magasin_id) JOIN dim_produit USING (produit_id)""")
def label_join(k):
    labelled = joins.label_join(k.direct["agg_locations_mois_produit_magasin"], {
        "magasin_id": k.stores.select("magasin_id", "nom"), "produit_id": k.direct["dim_produit"].select("produit_id", "titre"),
    })
    return labelled.select("annee", "mois", "nom", "titre", "nb_locations")


@query("prenormalised_join", f"""SELECT m.ref_no, c.client_id FROM mmm_movierentals m JOIN dim_client c ON c.magasin_id = 3
    AND lower(c.prenom) = lower({o.MMM_FIRST}) AND lower(c.nom) = lower({o.MMM_LAST}) AND c.date_naissance = m.birthdate""")
def prenormalised_join(k):
    first, last = text.split_name_first_last(strip(F.col("cust_name")))
    clients = k.direct["dim_client"].where(F.col("magasin_id") == 3)
    return joins.prenormalised_join(k.src.mmm_movierentals, clients, {
        "prenom_n": (F.lower(first), F.lower("prenom")), "nom_n": (F.lower(last), F.lower("nom")),
        "dob": (F.to_date("birthdate"), F.col("date_naissance")),
    }).select("ref_no", "client_id")


@query("store_rental_counts", "SELECT m.nom, count(*) AS n FROM fait_locations JOIN dim_magasin m USING (magasin_id) GROUP BY m.nom")
def store_rental_counts(k):
    return joins.store_rental_counts(k.direct["fait_locations"], k.stores)


# --- deduplication ------------------------------------------------------------------------

@query("dedup_group_min", """SELECT lower(firstname) AS prenom_k, lower(lastname) AS nom_k, min(firstname) AS firstname,
    min(code) AS code, min(sex) AS sex FROM bb_customer GROUP BY ALL""")
def dedup_group_min(k):
    keys = {"prenom_k": F.lower("firstname"), "nom_k": F.lower("lastname")}
    return dedup.dedup_group_min(k.src.bb_customer, keys, ["firstname", "code", "sex"])


@query("dedup_distinct", "SELECT DISTINCT gadget_title, gadget_type FROM mmm_gadgetsales")
def dedup_distinct(k):
    return dedup.dedup_distinct(k.src.mmm_gadgetsales, ["gadget_title", "gadget_type"])


@query("dedup_keep_first", "SELECT * FROM bb_kept")
def dedup_keep_first(k):
    cleaned = k.src.bb_customer.select(
        strip(F.col("code")).alias("source_code"), strip(F.col("firstname")).alias("prenom"), strip(F.col("lastname")).alias("nom"),
        dates.parse_us_date(F.col("dob")).alias("date_naissance"), people.gender_from_label(F.col("sex")).alias("genre"),
    )
    keys = [F.lower("prenom"), F.lower("nom"), F.col("date_naissance")]
    return dedup.dedup_keep_first(cleaned, keys, [F.col("source_code")])


@query("rebuild_clients", "SELECT * FROM mmm_named")
def rebuild_clients(k):
    return layered.rebuild_clients(k.src.mmm_movierentals, k.src.mmm_moviesales, k.src.mmm_gadgetsales)


@query("merge_actors", "SELECT acteur_id, nom FROM int_acteur")
def merge_actors(k):
    return layered.merge_actors(k.layered["bb_acteur"], k.layered["ms_acteur"])


@query("build_products", """SELECT titre, type, magasin_id, min(sous_type) AS sous_type, CAST(min(prix_inventaire) AS DECIMAL(10,2)) AS prix_inventaire,
    min(date_inventaire) AS date_inventaire, min(film_id) AS film_id FROM copies GROUP BY titre, type, magasin_id""")
def build_products(k):
    return layered.int_produit(k.layered).drop("produit_id")


@query("limit_one", "SELECT title, min(id) AS id FROM bb_gadget GROUP BY title")
def limit_one(k):
    return dedup.limit_one(k.src.bb_gadget.select("title", "id"), ["title"], [F.col("id")])


# --- data quality -------------------------------------------------------------------------

@query("row_count_report", """SELECT 'dim_produit' AS tbl, count(*) AS nb FROM dim_produit UNION ALL SELECT 'dim_client', count(*) FROM dim_client
    UNION ALL SELECT 'fait_ventes', count(*) FROM fait_ventes UNION ALL SELECT 'fait_locations', count(*) FROM fait_locations""")
def row_count_report(k):
    return quality.row_count_report({n: k.direct[n] for n in ("dim_produit", "dim_client", "fait_ventes", "fait_locations")})


@query("count_by_source", """SELECT source, nb, avec_realisateur, sans_realisateur FROM (SELECT source, count(*) AS nb FROM int_vente GROUP BY source)
    JOIN (SELECT count(realisateur) AS avec_realisateur, count(*) - count(realisateur) AS sans_realisateur FROM int_film) ON true""")
def count_by_source(k):
    by_source = quality.count_by_source(k.layered["int_vente"])
    films = quality.director_coverage(k.layered["int_film"])
    return by_source.select(
        "source", "nb", *[films.select(c).scalar().alias(c) for c in ("avec_realisateur", "sans_realisateur")]
    )


_PROFILED = ("cust_id", "sale_date", "sale_price", "inventory_price")


@query("null_rate_profile", " UNION ALL ".join(
    f"""SELECT 'sale_item' AS "table", '{c}' AS col, count(*) - count({c}) AS n_null, count(*) AS n,
    round(100.0 * (count(*) - count({c})) / count(*), 6) AS pct FROM bb_sale_item""" for c in _PROFILED
))
def null_rate_profile(k):
    return quality.null_rate_profile(k.src.bb_sale_item, "sale_item", list(_PROFILED))


@query("duplicate_rate", """SELECT CAST(sum(c - 1) AS BIGINT) AS n_dup, CAST(sum(c) AS BIGINT) AS n, round(100.0 * sum(c - 1) / sum(c), 6) AS pct
    FROM (SELECT count(*) AS c FROM bb_people GROUP BY lower(prenom), lower(nom), date_naissance)""")
def duplicate_rate(k):
    keyed = k.src.bb_customer.select(
        F.lower("firstname").alias("p"), F.lower("lastname").alias("n"), dates.parse_us_date(F.col("dob")).alias("d")
    )
    return quality.duplicate_rate(keyed, ["p", "n", "d"])


@query("orphan_count", """SELECT count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM ms_movie m WHERE m.movieid = c.movie_id)) AS n_orphan,
    count(*) AS n FROM ms_copy_for_sale c""")
def orphan_count(k):
    return quality.orphan_count(k.src.ms_copy_for_sale, k.src.ms_movie, "movie_id", "movieid")


@query("prefix_rate", " UNION ALL ".join(
    f"""SELECT '{c}' AS col, count(*) FILTER (WHERE starts_with({c}, 'T')) AS n,
    round(100.0 * count(*) FILTER (WHERE starts_with({c}, 'T')) / count({c}), 6) AS pct FROM ms_customer""" for c in ("birthday", "middlename")
))
def prefix_rate(k):
    rates = [
        quality.prefix_rate(k.src.ms_customer, c).select(F.lit(c).alias("col"), "n", "pct") for c in ("birthday", "middlename")
    ]
    return reduce(DataFrame.unionAll, rates)
