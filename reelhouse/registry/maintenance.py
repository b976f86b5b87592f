"""Registered queries: keeping the warehouse up to date, client sets and groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelhouse.operators import dedup, member_sets, quality
from reelhouse.operators.shape import append_streams
from reelhouse.plans import groups, layered, refresh, summaries
from reelhouse.plans.dimensions import dim_date
from reelhouse.plans.direct import reference_frequencies, sale_events
from reelhouse.registry.workspace import query
from reelhouse.sources import tables
from reelhouse.sources.binding import BENCHMARK_CALENDAR
from reelhouse.sources.shared import shared_folder, written

# --- distinct clients at every level -------------------------------------------------------

_LEVELS = (("", 7), ("annee", 3), ("annee, trimestre", 1), ("annee, trimestre, mois", 0))


def _distinct(columns: str, grouping: int, store: bool) -> str:
    own = [c for c in columns.split(", ") if c]
    shown = ", ".join(c if c in own else f"NULL AS {c}" for c in ("annee", "trimestre", "mois"))
    keys = ", ".join([*(["magasin_id"] if store else []), *[f"t.{c}" for c in own]])
    shown = shown.replace("annee", "t.annee", 1) if "annee" in own else shown
    return (
        f"SELECT {'magasin_id' if store else 'NULL AS magasin_id'}, {shown}, CAST({grouping + (0 if store else 8)} AS BIGINT) AS grouping_id, "
        f"count(DISTINCT client_id) AS n FROM fait_ventes f JOIN dim_temps t USING (temps_id) {f'GROUP BY {keys}' if keys else ''}"
    )


@query("rollup_distinct_clients", " UNION ALL ".join(_distinct(columns, g, store) for columns, g in _LEVELS for store in (True, False)))
def rollup_distinct_clients(k):
    """Distinct clients by all, year, quarter and month, per store and over all, from monthly sets."""
    sets = member_sets.monthly_client_sets(k.direct["fait_ventes"], k.direct["dim_temps"], k.direct["dim_produit"])
    return member_sets.rollup_distinct_stores(sets)


@query("distinct_clients_by_type", """SELECT p.type, t.annee, count(DISTINCT client_id) AS n FROM fait_ventes f JOIN dim_temps t USING (temps_id)
    JOIN dim_produit p ON p.produit_id = f.produit_id GROUP BY ALL""")
def distinct_clients_by_type(k):
    """Distinct clients by product type and year, rolled up from the stored monthly sets."""
    rolled = member_sets.rollup_distinct(k.client_sets, ["type"])
    return rolled.where("grouping_id = 3").select("type", "annee", "n")


# --- client groups ------------------------------------------------------------------------

@query("client_groups", "SELECT groupe_id, magasin_id, cle, nb_clients FROM dim_groupe")
def client_groups(k):
    return groups.client_groups(k.direct["dim_client"])


@query("group_members", "SELECT groupe_id, client_id FROM pont_groupe_client")
def group_members(k):
    return k.direct.plan("pont_groupe_client")


@query("sales_by_group", "SELECT * FROM ventes_groupes")
def sales_by_group(k):
    """The sales fact with one row per sale and product, whatever the number of namesakes."""
    return k.direct.plan("ventes_groupes")


@query("expanded_sales", "SELECT * FROM fait_ventes")
def expanded_sales(k):
    return groups.expanded(k.direct["ventes_groupes"], k.direct["pont_groupe_client"])


@query("group_totals", """SELECT annee, mois, magasin_id, CAST(ca_total AS DECIMAL(22,2)) AS ca_total, nb_ventes, nb_clients FROM agg_ventes_mois_magasin""")
def group_totals(k):
    """Monthly totals and distinct clients of the sales fact from the fact by group."""
    keys, sums = ["annee", "mois", "magasin_id"], {"ca_total": "ca_ventes", "nb_ventes": "nb_ventes"}
    return groups.totals(k.direct["ventes_groupes"], k.direct["dim_groupe"], k.direct["dim_temps"], keys, sums)


@query("frequent_references", """SELECT 'produit' AS side, way, produit AS said, count(*) AS n FROM sold WHERE ca IS NOT NULL AND quand IS NOT NULL AND produit IS NOT NULL
    GROUP BY ALL HAVING count(*) > 0.05 * (SELECT count(*) FROM sold WHERE ca IS NOT NULL AND quand IS NOT NULL)""")
def frequent_references(k):
    """References that hold over a twentieth of all sales, found in one pass, with their exact number of sales."""
    events = sale_events(k.src)
    hot = reference_frequencies(events).where("side = 'produit' AND n > 0.04 * total")
    named = hot.select(F.from_json("key", "ref_kind string, produit_ref string").alias("r")).select("r.*")
    counted = events.join(F.broadcast(named), ["ref_kind", "produit_ref"], "left_semi").groupBy("ref_kind", "produit_ref").agg(F.count(F.lit(1)).alias("n"))
    way = F.when(F.col("ref_kind") == "bb_movie", "bb").when(F.col("ref_kind") == "ms_movie", "movie").otherwise("gadget")
    total = events.agg(F.count(F.lit(1))).scalar()
    return counted.where(F.col("n") > F.lit(0.05) * total).select(F.lit("produit").alias("side"), way.alias("way"), F.col("produit_ref").alias("said"), "n")


# --- changes of a stored fact --------------------------------------------------------------

_CHANGED = """changed AS (SELECT CASE WHEN t.mois = 5 AND t.annee = 1996 AND f.est_neuf = 0 AND f.magasin_id = 2 THEN f.temps_id + 366 ELSE f.temps_id END AS temps_id,
      f.magasin_id, f.client_id, f.produit_id, f.nb_ventes, f.est_neuf,
      CAST(f.ca_ventes + CASE WHEN t.mois = 3 AND t.annee = 1997 AND f.est_neuf = 1 THEN 1 ELSE 0 END AS DECIMAL(12,2)) AS ca_ventes, f.marge
    FROM lw_fait_ventes f JOIN dim_temps t USING (temps_id) WHERE NOT (t.annee = 1999 AND t.mois = 11 AND f.magasin_id = 3)
      AND t.annee <> 1995)"""


def _changes(k, fact):
    """(updates, gone): dearer new copies of one month, sales of one month moved a year on, one store's month and one whole year removed."""
    dated = fact.join(F.broadcast(k.calendar.select("temps_id", F.col("annee").alias("y"), F.col("mois").alias("m"))), "temps_id")
    dearer = dated.where("m = 3 AND y = 1997 AND est_neuf = 1").withColumn("ca_ventes", (F.col("ca_ventes") + 1).cast("decimal(12,2)"))
    moved = dated.where("m = 5 AND y = 1996 AND est_neuf = 0 AND magasin_id = 2").withColumns({"temps_id": F.col("temps_id") + 366, "annee": F.col("annee") + 1})
    gone = dated.where("(y = 1999 AND m = 11 AND magasin_id = 3) OR y = 1995")
    return dearer.unionByName(moved).select(*fact.columns), gone.select(*fact.columns)


def _changed_fact(k, name):
    fact = f"{tables.new_database(k.spark, name)}.fait_ventes"
    tables.fact_partition_by_year(k.layered["fait_ventes"], fact)
    return fact, *_changes(k, k.layered["fait_ventes"])


@query("upsert_partitions", f"""WITH {_CHANGED} SELECT t.annee, t.mois, c.magasin_id, count(*) AS nb, CAST(sum(ca_ventes) AS DECIMAL(22,2)) AS ca
    FROM changed c JOIN dim_temps t USING (temps_id) GROUP BY ALL""")
def upsert_partitions(k):
    """A stored fact after an upsert that touches two years and moves rows between them, and a removal that empties a third."""
    fact, updates, gone = _changed_fact(k, "upsert")
    refresh.change_fact(fact, ["vente_id"], updates, gone)
    dated = k.spark.table(fact).drop("annee").join(F.broadcast(k.calendar.select("temps_id", "annee", "mois")), "temps_id")
    return dated.groupBy("annee", "mois", "magasin_id").agg(F.count(F.lit(1)).alias("nb"), F.sum("ca_ventes").cast("decimal(22,2)").alias("ca"))


@query("refresh_aggregates", f"""WITH {_CHANGED} SELECT 'store' AS summary, t.annee, t.mois, magasin_id, NULL AS produit_id, CAST(sum(ca_ventes) AS DECIMAL(22,2)) AS ca_total,
      CAST(sum(nb_ventes) AS BIGINT) AS nb_ventes, count(DISTINCT client_id) AS nb_clients FROM changed JOIN dim_temps t USING (temps_id) GROUP BY t.annee, t.mois, magasin_id
    UNION ALL SELECT 'product', t.annee, t.mois, NULL, produit_id, CAST(sum(ca_ventes) AS DECIMAL(22,2)), CAST(sum(nb_ventes) AS BIGINT), NULL
    FROM changed JOIN dim_temps t USING (temps_id) GROUP BY t.annee, t.mois, produit_id""")
def refresh_aggregates(k):
    """Stored summaries after their fact changed: only touched months are built again."""
    fact, updates, gone = _changed_fact(k, "refresh")
    database = fact.split(".")[0]
    build = {
        f"{database}.by_store": summaries.agg_sales_month_store,
        f"{database}.by_product": lambda sales, dates: summaries.agg_sales_month_product(sales, dates, k.layered["dim_produit"]),
    }
    for table, make in build.items():
        tables.fact_partition_by_year(make(k.spark.table(fact), k.calendar), table)
    days = refresh.change_fact(fact, ["vente_id"], updates, gone)
    refresh.refresh_aggregates(fact, build, days, k.calendar)
    by_store, by_product = [k.spark.table(t) for t in build]
    return append_streams(
        by_store.select(F.lit("store").alias("summary"), "annee", "mois", "magasin_id", "ca_total", "nb_ventes", "nb_clients"),
        by_product.select(F.lit("product").alias("summary"), "annee", "mois", "produit_id", "ca_total", "nb_ventes"))


@query("replayed_rejects", """SELECT temps_id, magasin_id, client_id, produit_id, annee, ca_ventes, NULL AS reason FROM lw_fait_ventes UNION ALL
    SELECT NULL, magasin_id, client_id, produit_id, NULL, NULL, reason FROM lw_rejets""")
def replayed_rejects(k):
    """Sales loaded while the calendar ended in 1998 and without the gadgets, then the rejects replayed with all days and products."""
    database = tables.new_database(k.spark, "replay")
    short, films = dim_date(k.spark, BENCHMARK_CALENDAR[0], "1998-12-31"), k.layered["int_produit"].where("type = 'film'")
    fact, missing = layered.load_fact_sales(written(layered.dated_sales(k.layered["int_vente"], films, short), "dated"))
    tables.fact_partition_by_year(fact, f"{database}.fait_ventes")
    tables.truncate_reload(missing, f"{database}.rejets")
    refresh.replay_rejects(f"{database}.fait_ventes", f"{database}.rejets", k.layered["int_produit"], k.calendar)
    facts, rejected = k.spark.table(f"{database}.fait_ventes"), k.spark.table(f"{database}.rejets")
    return append_streams(
        facts.select("temps_id", "magasin_id", "client_id", "produit_id", "annee", "ca_ventes"), rejected.select("magasin_id", "client_id", "produit_id", "reason"))


# --- ingest, keys, measurements -------------------------------------------------------------

@query("incremental_ingest", """SELECT 1 AS pass, 1 AS files, count(*) FILTER (c_nationkey < 12) AS n_rows FROM customer
    UNION ALL SELECT 2, 1, count(*) FROM customer UNION ALL SELECT 3, 0, count(*) FROM customer""")
def incremental_ingest(k):
    """Two exports taken one after the other, and a third call that finds nothing new: files taken and rows held after each."""
    table, folder = f"{tables.new_database(k.spark, 'ingest')}.customer", f"{shared_folder(k.spark)}/export-{tables.new_name()}"
    customers, found = k.src.table("customer"), []
    for number, part in enumerate((customers.where("c_nationkey < 12"), customers.where("c_nationkey >= 12"), None), 1):
        if part is not None:
            part.coalesce(1).write.parquet(f"{folder}/export{number}")
        taken = tables.ingest_new_files(k.spark, folder, table, customers.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))
        found.append((number, taken.count(), k.spark.table(table).count()))
    return k.spark.createDataFrame(found, "pass int, files bigint, n_rows bigint")


@query("dense_keys", "SELECT row_number() OVER (ORDER BY l_orderkey, l_partkey, l_linenumber) AS id, * FROM (SELECT DISTINCT l_orderkey, l_partkey, l_linenumber FROM lineitem)")
def dense_keys(k):
    natural = ["l_orderkey", "l_partkey", "l_linenumber"]
    return dedup.dense_keys(k.src.table("lineitem").select(*natural).distinct(), natural, "id")


_MORE = "SELECT DISTINCT p_name, p_brand, p_size, p_size < 20 AS early FROM part"


@query("dense_keys_again", f"""SELECT p_name, p_brand, p_size, CASE WHEN early THEN row_number() OVER (PARTITION BY early ORDER BY p_name, p_brand, p_size)
    ELSE (SELECT count(*) FROM ({_MORE}) WHERE early) + row_number() OVER (PARTITION BY early ORDER BY p_name, p_brand, p_size) END AS id FROM ({_MORE})""")
def dense_keys_again(k):
    """Keys given by a first load stay, later rows are numbered after them."""
    natural = ["p_name", "p_brand", "p_size"]
    parts = k.src.table("part").select(*natural).distinct()
    first = dedup.dense_keys(parts.where("p_size < 20"), natural, "id")
    return dedup.dense_keys(parts, natural, "id", known=first)


_PROFILE = {"dim_client": ("date_naissance", "genre", "age"), "fait_ventes": ("marge", "client_id"), "ref_produit": ("produit_id",)}
_PROFILED = {"ref_produit": "product_of"}


@query("measured_nulls", " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", '{c}' AS col, count(*) - count({c}) AS n_null, count(*) AS n, round(100.0 * (count(*) - count({c})) / count(*), 6) AS pct
    FROM {_PROFILED.get(t, t)}""" for t, cols in _PROFILE.items() for c in cols))
def measured_nulls(k):
    """Missing values of warehouse tables as measured while they were written."""
    for name in _PROFILE:
        k.direct[name]
    found = quality.measured_nulls(k.spark, {n: k.direct.measured[n] for n in _PROFILE})
    wanted = [F.struct(F.lit(t), F.lit(c)) for t, cols in _PROFILE.items() for c in cols]
    return found.where(F.struct("table", "col").isin(wanted))


_COUNTED = ("dim_produit", "dim_client", "fait_ventes", "fait_locations", "agg_ventes_mois_magasin")


@query("load_report", " UNION ALL ".join(f"SELECT '{name}' AS tbl, count(*) AS nb FROM {name}" for name in _COUNTED))
def load_report(k):
    """Rows of loaded tables as measured while they were written; no table is read."""
    return summaries.load_and_report(k.direct, _COUNTED)
