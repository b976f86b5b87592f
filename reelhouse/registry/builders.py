"""Registered queries: the table builders of both load paths."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

from pyspark.sql import functions as F

from reelhouse.operators import quality
from reelhouse.operators.shape import append_streams
from reelhouse.plans import layered, summaries
from reelhouse.plans.direct import direct_warehouse
from reelhouse.plans.layered import layered_warehouse
from reelhouse.registry import oracle as o
from reelhouse.registry.workspace import query, settled
from reelhouse.sources.tables import new_database

# Generated row ids are left out of the comparison: their values carry no meaning.
_SAME = (
    "bb_film", "bb_acteur", "bb_joue_dans", "bb_client", "bb_vente_film", "bb_vente_gadget",
    "ms_film", "ms_acteur", "ms_joue_dans", "ms_client", "ms_copie_location", "ms_copie_vente", "ms_location",
    "mmm_client", "mmm_location_film", "mmm_vente_film", "mmm_vente_gadget",
    "int_film", "int_acteur", "int_joue_dans", "int_client", "int_produit",
)


def _register(name: str) -> None:
    @query(name, f"SELECT * FROM {name}")
    def build(k):
        return k.layered.plan(name)


for _name in _SAME:
    _register(_name)


@query("int_vente", "SELECT * FROM int_vente")
def int_vente(k):
    return k.layered.plan("int_vente").drop("vente_id")


@query("int_location", "SELECT * FROM int_location")
def int_location(k):
    return k.layered.plan("int_location").drop("location_id")


@query("load_dim_store", """SELECT magasin_id, nom, CAST(NULL AS VARCHAR) AS adresse, n FROM dim_magasin
    JOIN (SELECT magasin_id, count(*) AS n FROM int_client GROUP BY magasin_id) USING (magasin_id)""")
def load_dim_store(k):
    clients = k.layered["int_client"].groupBy("magasin_id").agg(F.count(F.lit(1)).alias("n"))
    return k.layered.plan("dim_magasin").join(clients, "magasin_id")


@query("load_dim_product", "SELECT produit_id, titre, type, sous_type, film_id FROM int_produit")
def load_dim_product(k):
    return k.layered.plan("dim_produit")


@query("dim_product_direct", "SELECT * FROM dim_produit")
def dim_product_direct(k):
    return k.direct.plan("dim_produit")


@query("load_dim_client", "SELECT * FROM lw_dim_client")
def load_dim_client(k):
    clients = k.layered["int_client"]
    stored = layered.load_dim_client(clients.where("source <> 'MMM'"))
    return layered.load_dim_client(clients, existing=stored)


@query("dim_client_direct", "SELECT * FROM dim_client")
def dim_client_direct(k):
    return k.direct.plan("dim_client")


@query("load_fact_sales", """SELECT temps_id, magasin_id, client_id, produit_id, annee, ca_ventes, prix_inventaire_total, marge, nb_ventes, est_neuf,
    NULL AS reason FROM lw_fait_ventes UNION ALL
    SELECT NULL, magasin_id, client_id, produit_id, NULL, NULL, NULL, NULL, NULL, NULL, reason FROM lw_rejets""")
def load_fact_sales(k):
    fact, rejects = layered.load_fact_sales(k.layered["ventes_datees"])
    return append_streams(fact.drop("vente_id"), rejects.select("magasin_id", "client_id", "produit_id", "reason"))


@query("reload_sales", "SELECT temps_id, magasin_id, client_id, produit_id, ca_ventes, est_neuf FROM lw_fait_ventes")
def reload_sales(k):
    """Sales loaded without one source and with other prices of the new copies, then loaded again as they are."""
    dated = k.layered["ventes_datees"]
    other = F.when(F.col("est_neuf") == 1, F.col("prix_vente") + 1).otherwise(F.col("prix_vente")).cast("decimal(10,2)")
    stored, _ = layered.load_fact_sales(dated.where("source <> 'MMM'").withColumn("prix_vente", other))
    again, _ = layered.load_fact_sales(dated, existing=stored)
    return again.select("temps_id", "magasin_id", "client_id", "produit_id", "ca_ventes", "est_neuf")


_CODED = f"SELECT code, gender, {o.key_bucket('code')} AS bucket FROM ms_customer"


@query("incremental_clients", f"""WITH coded AS ({_CODED}), numbered AS (
    SELECT code, bucket, gender = 'F' AS early, row_number() OVER (PARTITION BY bucket, gender = 'F' ORDER BY code) - 1 AS n,
      count(*) FILTER (gender = 'F') OVER (PARTITION BY bucket) AS before FROM coded)
    SELECT code AS source_code, CAST((n + CASE WHEN early THEN 0 ELSE before END) * 4096 + CAST('0x'||bucket AS INTEGER) + 1 AS BIGINT) AS client_id
    FROM numbered""")
def incremental_clients(k):
    """Women loaded first, then everybody: keys given by the first load stay, the others are numbered after them."""
    women = layered.ms_client(SimpleNamespace(ms_customer=k.src.ms_customer.where("gender = 'F'")))
    return layered.ms_client(k.src, existing=women).select("source_code", "client_id")


@query("load_fact_rentals", "SELECT * FROM lw_fait_locations")
def load_fact_rentals(k):
    return layered.load_fact_rentals(k.layered["int_location"], k.calendar).drop("location_id")


@query("load_aggregates", """SELECT 'store' AS summary, annee, mois, magasin_id, NULL AS produit_id, ca_total, nb_ventes AS n FROM agg_ventes_mois_magasin UNION ALL
    SELECT 'product', annee, mois, NULL, produit_id, ca_total, nb_ventes FROM agg_ventes_mois_produit UNION ALL
    SELECT 'rentals', annee, mois, magasin_id, produit_id, ca_total, nb_locations FROM agg_locations_mois_produit_magasin""")
def load_aggregates(k):
    keys = ("annee", "mois", "magasin_id", "produit_id", "ca_total")
    parts = []
    for label, name, count in zip(("store", "product", "rentals"), summaries.BUILDERS, ("nb_ventes", "nb_ventes", "nb_locations")):
        df = k.direct.plan(name)
        parts.append(df.select(F.lit(label).alias("summary"), *[c for c in keys if c in df.columns], F.col(count).alias("n")))
    return append_streams(*parts)


# Columns that fingerprints of loaded tables cover: all but generated row ids, whose values carry no meaning.
_SUMMARIES = {
    "agg_ventes_mois_magasin": "annee mois magasin_id ca_total marge_totale nb_ventes nb_clients",
    "agg_ventes_mois_produit": "annee mois produit_id type_produit ca_total nb_ventes",
    "agg_locations_mois_produit_magasin": "annee mois produit_id magasin_id ca_total nb_locations nb_jours_total",
}
_WAREHOUSE = {
    "dim_produit": "produit_id titre type sous_type film_id",
    "dim_client": "client_id prenom nom date_naissance age tranche_age genre magasin_id",
    "fait_ventes": "temps_id magasin_id client_id produit_id annee ca_ventes prix_inventaire_total marge nb_ventes est_neuf",
    "fait_locations": "temps_id magasin_id client_id produit_id annee ca_locations nb_locations nb_jours_total",
    **_SUMMARIES,
}
_LAYERED_COLUMNS = {
    "bb_film": "film_id source_id titre annee",
    "bb_acteur": "acteur_id source_id nom",
    "bb_joue_dans": "film_id acteur_id",
    "bb_client": "client_id source_code prenom nom date_naissance genre",
    "bb_client_codes": "source_code client_id",
    "bb_vente_film": "source_id date_vente prix_vente prix_inventaire type_produit client_id film_id",
    "bb_vente_gadget": "source_id titre type_gadget date_vente prix_vente prix_inventaire client_id",
    "ms_film": "film_id source_id titre annee_production date_sortie prix_sortie realisateur scenariste",
    "ms_acteur": "acteur_id source_id nom",
    "ms_joue_dans": "film_id acteur_id",
    "ms_client": "client_id source_code prenom initiale nom genre date_naissance adresse",
    "ms_copie_location": "copie_id source_id type_copie disposed film_id",
    "ms_copie_vente": "source_id type_copie est_neuf prix_vente date_vente film_id client_id",
    "ms_location": "date_debut date_fin prix_jour copie_id client_id",
    "mmm_client": "client_id prenom initiale nom nom_complet genre date_naissance adresse",
    "mmm_location_film": "source_id film_ref_id date_debut date_fin prix_jour client_id",
    "mmm_vente_film": "source_id film_ref_id date_vente prix_vente client_id",
    "mmm_vente_gadget": "source_id type_gadget titre_gadget date_vente prix_vente prix_inventaire date_inventaire client_id",
    "int_film": "film_id source source_id titre annee_production date_sortie prix_sortie realisateur scenariste type_film",
    "film_xref": "source source_film_id film_id",
    "int_acteur": "acteur_id nom",
    "actor_xref": "source source_acteur_id acteur_id",
    "int_joue_dans": "film_id acteur_id",
    "int_client": "client_id prenom initiale nom date_naissance genre adresse magasin_id source source_code source_client_id",
    "int_produit": "produit_id titre type magasin_id sous_type prix_inventaire date_inventaire film_id",
    "int_vente": "date_vente prix_vente est_neuf client_id produit_id magasin_id source",
    "int_location": "date_debut date_fin prix_jour client_id produit_id magasin_id source",
    "dim_temps": "temps_id date_complete jour mois nom_mois trimestre annee",
    "dim_magasin": "magasin_id nom",
    "dim_produit": "produit_id titre type sous_type film_id",
    "dim_client": "client_id prenom nom date_naissance age tranche_age genre magasin_id",
    "ventes_datees": "date_vente produit_id prix_vente est_neuf client_id magasin_id source temps_id reason",
    "fait_ventes": "temps_id magasin_id client_id produit_id annee ca_ventes prix_inventaire_total marge nb_ventes est_neuf",
    "ventes_rejetees": "date_vente produit_id prix_vente est_neuf client_id magasin_id source reason",
    "fait_locations": "temps_id magasin_id client_id produit_id annee ca_locations nb_locations nb_jours_total",
    **_SUMMARIES,
}
# The check's names of the layered tables that differ from the tables' own.
_LAYERED = {
    "dim_produit": "int_produit", "dim_client": "lw_dim_client", "ventes_datees": "lw_dated", "fait_ventes": "lw_fait_ventes",
    "ventes_rejetees": "lw_rejets", "fait_locations": "lw_fait_locations", **{n: f"lw_{n}" for n in summaries.BUILDERS},
}


def _fingerprints(columns: dict[str, str], tables: dict[str, str]) -> str:
    def one(name: str, cols: str) -> str:
        text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in cols.split())
        return (
            f"SELECT '{name}' AS tbl, count(*) AS nb, CAST(coalesce(sum(h), 0) AS VARCHAR) AS total, coalesce(bit_xor(h), 0) AS mixed "
            f"FROM (SELECT CAST('0x'||substr(md5(concat_ws('|', {text})), 1, 15) AS BIGINT) AS h FROM {tables.get(name, name)})"
        )

    return " UNION ALL ".join(one(name, cols) for name, cols in columns.items())


def _loaded(k, build, label: str, columns: dict[str, str]):
    """Fingerprints of the tables of a warehouse loaded for them alone and dropped again; one row per table.

    Row counts are those measured while the tables were written, contents are read from the stored tables.
    """
    database = new_database(k.spark, label)
    stage = build(k.spark, k.src, k.calendar, k.stores, database)
    counted = {r.tbl: r.nb for r in summaries.load_and_report(stage, tuple(columns)).collect()}
    # table by table: of one plan over all tables the driver would hold and report the whole after each stage
    with ThreadPoolExecutor(4) as pool:
        prints = [*pool.map(lambda name: quality.table_fingerprint(stage[name], name, columns[name].split()).collect()[0], columns)]
    k.spark.sql(f"DROP DATABASE {database} CASCADE")
    return k.spark.createDataFrame([(r.tbl, counted[r.tbl], r.total, r.mixed) for r in prints], "tbl string, nb bigint, total string, mixed bigint")


@query("direct_load", _fingerprints(_WAREHOUSE, {}))
def direct_load(k):
    return _loaded(k, direct_warehouse, "direct", _WAREHOUSE)


@query("run_layered", _fingerprints(_LAYERED_COLUMNS, _LAYERED))
def run_layered(k):
    return _loaded(k, layered_warehouse, "layered", _LAYERED_COLUMNS)


_RESOLVED = """SELECT magasin_id, date_complete, reason, count(*) AS nb FROM (
    SELECT e.magasin_id, CAST(quand AS DATE) AS date_complete, CASE WHEN t.temps_id IS NULL THEN 'no calendar day' WHEN p.said IS NULL THEN 'no product'
      WHEN k.said IS NULL THEN 'no client' END AS reason FROM sold e LEFT JOIN dim_temps t ON t.date_complete = CAST(quand AS DATE)
    LEFT JOIN product_of p ON p.way = e.way AND p.said = e.produit LEFT JOIN client_of k ON k.magasin_id = e.magasin_id AND k.said = e.client
    WHERE ca IS NOT NULL AND quand IS NOT NULL) WHERE reason IS NOT NULL GROUP BY ALL"""


@query("direct_rejects", _RESOLVED)
def direct_rejects(k):
    """Sales the direct path leaves out, with the reason."""
    return k.direct["ventes_rejetees"].groupBy("magasin_id", "date_complete", "reason").agg(F.count(F.lit(1)).alias("nb"))


@query("direct_load_plan", """SELECT 'fait_ventes' AS tbl, annee, magasin_id, count(*) AS nb, CAST(sum(ca_ventes) AS DECIMAL(22,2)) AS ca, CAST(sum(marge) AS DECIMAL(22,2)) AS marge,
      CAST(sum(est_neuf) AS BIGINT) AS n, count(DISTINCT client_id) AS clients, count(DISTINCT produit_id) AS produits FROM fait_ventes GROUP BY ALL
    UNION ALL SELECT 'fait_locations', annee, magasin_id, count(*), CAST(sum(ca_locations) AS DECIMAL(22,2)), NULL, CAST(sum(nb_jours_total) AS BIGINT),
      count(DISTINCT client_id), count(DISTINCT produit_id) FROM fait_locations GROUP BY ALL""")
def direct_load_plan(k):
    """Both facts straight from the raw tables in one plan, nothing stored on the way."""
    def totals(name, money, other, n):
        groups = k.lazy[name].groupBy(F.lit(name).alias("tbl"), "annee", "magasin_id")
        return settled(groups.agg(
            F.count(F.lit(1)).alias("nb"), F.sum(money).alias("ca"), *[F.sum(c).alias("marge") for c in other], F.sum(n).alias("n"),
            F.count_distinct("client_id").alias("clients"), F.count_distinct("produit_id").alias("produits")))

    return append_streams(totals("fait_ventes", "ca_ventes", ["marge"], "est_neuf"), totals("fait_locations", "ca_locations", [], "nb_jours_total"))
