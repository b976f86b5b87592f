"""Registered queries: table lifecycle, projection and cleaning."""

from __future__ import annotations


from pyspark.sql import functions as F

from reelhouse.functions import dates, measures, people, text
from reelhouse.operators import dedup, joins, shape
from reelhouse.plans import direct, dimensions
from reelhouse.registry import oracle as o
from reelhouse.registry.workspace import query
from reelhouse.sources import tables

RAW_TABLES = {
    "bb": ("movie", "actor", "actsin", "customer", "sale_item", "gadget"),
    "ms": ("movie", "actor", "acts_in", "customer", "copy_for_rent", "copy_for_sale", "copy_rented_to"),
    "mmm": ("movierentals", "moviesales", "gadgetsales"),
}


# --- sources, sinks, table lifecycle ------------------------------------------------------

@query("raw_ingest", " UNION ALL ".join(
    f'SELECT \'{p}_{t}\' AS "table", count(*) AS n_rows FROM {p}_{t}' for p, names in RAW_TABLES.items() for t in names
))
def raw_ingest(k):
    bundles = {p: {t: getattr(k.src, f"{p}_{t}") for t in names} for p, names in RAW_TABLES.items()}
    return tables.raw_ingest(bundles, k.spark, tables.new_database(k.spark, "raw"))


@query("skip_if_loaded", "SELECT false AS skipped_first, true AS skipped_again, count(*) AS n_rows FROM ms_customer")
def skip_if_loaded(k):
    target = f"{tables.new_database(k.spark, 'skip')}.ms_customer"
    first = tables.skip_if_loaded(k.src.ms_customer, target)
    again = tables.skip_if_loaded(k.src.ms_customer, target)
    return k.spark.table(target).agg(
        F.lit(first).alias("skipped_first"), F.lit(again).alias("skipped_again"), F.count(F.lit(1)).alias("n_rows")
    )


@query("coerce_decimals", """SELECT magasin_id, produit_id, annee, CAST(ca_ventes AS DOUBLE) AS ca_ventes,
    CAST(marge AS DOUBLE) AS marge FROM fait_ventes""")
def coerce_decimals(k):
    fact = k.direct["fait_ventes"].select("magasin_id", "produit_id", "annee", "ca_ventes", "marge")
    return shape.coerce_decimals(fact)


@query("dim_store", """SELECT magasin_id, nom, CAST(NULL AS VARCHAR) AS adresse, n FROM dim_magasin
    JOIN (SELECT CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS magasin_id, count(*) AS n FROM lineitem GROUP BY 1) USING (magasin_id)""")
def dim_store(k):
    code = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
    lines = k.src.table("lineitem").groupBy(code.alias("magasin_id")).agg(F.count(F.lit(1)).alias("n"))
    return dimensions.dim_store(k.spark).join(lines, "magasin_id")


@query("dim_date", """SELECT CAST(row_number() OVER (ORDER BY d) AS INTEGER) AS temps_id, CAST(d AS DATE) AS date_complete,
    CAST(day(d) AS INTEGER) AS jour, CAST(month(d) AS INTEGER) AS mois, monthname(d) AS nom_mois,
    CAST(quarter(d) AS INTEGER) AS trimestre, CAST(year(d) AS INTEGER) AS annee
    FROM (SELECT unnest(generate_series(date_trunc('year', min(o_orderdate)),
      date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM orders)""")
def dim_date(k):
    return dimensions.dim_date_of(k.src.table("orders"), "o_orderdate")


@query("truncate_reload", "SELECT * FROM agg_ventes_mois_magasin")
def truncate_reload(k):
    target = f"{tables.new_database(k.spark, 'reload')}.agg_ventes_mois_magasin"
    for _ in range(2):
        tables.truncate_reload(k.direct["agg_ventes_mois_magasin"], target)
    return k.spark.table(target)


@query("append_rows", """SELECT CAST(code AS VARCHAR) AS source_code, regexp_replace(surname, '^T', '') AS nom,
    CAST(NULL AS VARCHAR) AS adresse FROM ms_customer UNION ALL SELECT regexp_replace(code, '^T', ''), regexp_replace(lastname, '^T', ''), NULL FROM bb_customer""")
def append_rows(k):
    target = f"{tables.new_database(k.spark, 'append')}.client"
    k.spark.sql(f"CREATE TABLE {target} (source_code STRING, nom STRING, adresse STRING) USING parquet")
    for customers, code, name in ((k.src.ms_customer, "code", "surname"), (k.src.bb_customer, "code", "lastname")):
        cleaned = customers.select(
            text.strip_one_prefix(F.col(code).cast("string")).alias("c"), text.strip_one_prefix(F.col(name)).alias("n")
        )
        tables.append_rows(cleaned, target, {"source_code": "c", "nom": "n"})
    return k.spark.table(target)


@query("upsert_by_key", """SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey, coalesce(a.nom, b.nom) AS nom,
    coalesce(b.solde, a.solde) AS solde FROM (SELECT c_custkey, c_name AS nom, c_acctbal AS solde FROM customer WHERE c_acctbal < 6000) a
    FULL JOIN (SELECT c_custkey, upper(c_name) AS nom, c_acctbal + 1 AS solde FROM customer WHERE c_acctbal > 3000) b ON a.c_custkey = b.c_custkey""")
def upsert_by_key(k):
    customers = k.src.table("customer")
    stored = customers.where("c_acctbal < 6000").selectExpr("c_custkey", "c_name AS nom", "c_acctbal AS solde")
    fresh = customers.where("c_acctbal > 3000").selectExpr("c_custkey", "upper(c_name) AS nom", "c_acctbal + 1 AS solde")
    return dedup.upsert_by_key(stored, fresh, ["c_custkey"], ["solde"])


@query("fact_partition_by_year", """SELECT annee, count(*) AS n, CAST(sum(ca_ventes) AS DECIMAL(22,2)) AS ca FROM fait_ventes GROUP BY annee""")
def fact_partition_by_year(k):
    target = f"{tables.new_database(k.spark, 'yearly')}.fait_ventes"
    tables.fact_partition_by_year(k.direct["fait_ventes"], target)
    return k.spark.table(target).groupBy("annee").agg(F.count(F.lit(1)).alias("n"), F.sum("ca_ventes").alias("ca"))


@query("stored_margin", """SELECT magasin_id, CAST(ca AS DECIMAL(12,2)) AS ca_ventes, CAST(cout AS DECIMAL(12,2)) AS prix_inventaire_total,
    CAST(CAST(ca AS DECIMAL(12,2)) - CAST(cout AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS marge FROM s_sales""")
def stored_margin(k):
    facts = k.direct["fait_ventes"].select("magasin_id", "ca_ventes", "prix_inventaire_total")
    return shape.stored_margin(facts, "ca_ventes", "prix_inventaire_total")


@query("quarantine_unmatched", """SELECT CAST(o_orderdate AS DATE) AS date_complete, o_orderkey,
    CASE WHEN NOT EXISTS (SELECT 1 FROM dim_temps t WHERE t.date_complete = CAST(o_orderdate AS DATE)) THEN 'date not in calendar' END AS reason FROM orders""")
def quarantine_unmatched(k):
    days = k.src.table("orders").select(F.to_date("o_orderdate").alias("date_complete"), "o_orderkey")
    matched, rejected = joins.quarantine_unmatched(days, k.calendar, "date_complete", "date not in calendar")
    return shape.append_streams(rejected, matched)


@query("surrogate_keys", f"SELECT {o.key_id('p_name', 'p_brand', 'p_size')} AS id, * FROM (SELECT DISTINCT p_name, p_brand, p_size FROM part)")
def surrogate_keys(k):
    natural = ["p_name", "p_brand", "p_size"]
    return dedup.surrogate_keys(k.src.table("part").select(*natural).distinct(), natural, "id")


@query("reporting_views", """SELECT t.annee, p.type, c.tranche_age, CAST(sum(f.ca_ventes) AS DECIMAL(22,2)) AS ca FROM fait_ventes f
    JOIN dim_temps t USING (temps_id) JOIN dim_produit p ON p.produit_id = f.produit_id JOIN dim_client c ON c.client_id = f.client_id GROUP BY ALL""")
def reporting_views(k):
    names = ("dim_temps", "dim_magasin", "dim_produit", "dim_client", "fait_ventes", "fait_locations",
             "agg_ventes_mois_magasin", "agg_ventes_mois_produit", "agg_locations_mois_produit_magasin")
    tables.reporting_views({f"rapport_{n}": k.direct[n] for n in names})
    return k.spark.sql("""SELECT t.annee, p.type, c.tranche_age, sum(f.ca_ventes) AS ca FROM rapport_fait_ventes f
        JOIN rapport_dim_temps t ON t.temps_id = f.temps_id JOIN rapport_dim_produit p ON p.produit_id = f.produit_id
        JOIN rapport_dim_client c ON c.client_id = f.client_id GROUP BY t.annee, p.type, c.tranche_age""")


# --- projection, filter, cleaning ---------------------------------------------------------

@query("strip_one_prefix", "SELECT movieid, regexp_replace(movie_title, '^T', '') AS titre, regexp_replace(director, '^T', '') AS realisateur FROM ms_movie")
def strip_one_prefix(k):
    return k.src.ms_movie.select(
        "movieid", text.strip_one_prefix(F.col("movie_title")).alias("titre"), text.strip_one_prefix(F.col("director")).alias("realisateur")
    )


@query("strip_all_prefix", "SELECT movieid, ltrim(movie_title, 'T') AS titre FROM ms_movie")
def strip_all_prefix(k):
    return k.src.ms_movie.select("movieid", text.strip_all_prefix(F.col("movie_title")).alias("titre"))


@query("title_key", f"SELECT movie_id, {o.tkey(o.strip('movie_title'))} AS title_key FROM bb_movie")
def title_key(k):
    return k.src.bb_movie.select("movie_id", text.title_key(text.strip_one_prefix(F.col("movie_title"))).alias("title_key"))


@query("gender_from_label", f"SELECT code, {o.LABEL} AS genre, coalesce({o.LABEL}, 'M') AS genre_direct FROM bb_customer")
def gender_from_label(k):
    return k.src.bb_customer.select(
        "code", people.gender_from_label(F.col("sex")).alias("genre"), people.gender_from_label(F.col("sex"), "M").alias("genre_direct")
    )


@query("gender_from_flag", f"SELECT ref_no, {o.FLAG} AS genre, coalesce({o.FLAG}, 'F') AS genre_direct FROM mmm_moviesales")
def gender_from_flag(k):
    return k.src.mmm_moviesales.select(
        "ref_no", people.gender_from_flag(F.col("sex_male")).alias("genre"), people.gender_from_flag(F.col("sex_male"), "F").alias("genre_direct")
    )


@query("gender_whitelist", "SELECT code, CASE WHEN gender IN ('M','F') THEN gender END AS genre FROM ms_customer")
def gender_whitelist(k):
    return k.src.ms_customer.select("code", people.gender_whitelist(F.col("gender")).alias("genre"))


@query("parse_us_date", f"SELECT code, {o.us_date('dob')} AS date_naissance FROM bb_customer")
def parse_us_date(k):
    return k.src.bb_customer.select("code", dates.parse_us_date(F.col("dob")).alias("date_naissance"))


@query("parse_iso_date_guarded", f"SELECT code, {o.iso_date('birthday')} AS date_naissance FROM ms_customer")
def parse_iso_date_guarded(k):
    return k.src.ms_customer.select("code", dates.parse_iso_date_guarded(F.col("birthday")).alias("date_naissance"))


@query("split_name_first_last", f"SELECT ref_no, {o.MMM_FIRST} AS prenom, {o.MMM_LAST} AS nom FROM mmm_moviesales")
def split_name_first_last(k):
    first, last = text.split_name_first_last(text.strip_one_prefix(F.col("cust_name")))
    return k.src.mmm_moviesales.select("ref_no", first.alias("prenom"), last.alias("nom"))


@query("parse_name_initial", f"""SELECT ref_no, t[1] AS prenom, CASE WHEN len(t) >= 3 THEN t[2] END AS initiale,
    CASE WHEN len(t) >= 2 THEN t[-1] END AS nom FROM (SELECT ref_no, string_split({o.strip('cust_name')}, ' ') AS t FROM mmm_moviesales)""")
def parse_name_initial(k):
    first, initial, last = text.parse_name_initial(text.strip_one_prefix(F.col("cust_name")))
    return k.src.mmm_moviesales.select("ref_no", first.alias("prenom"), initial.alias("initiale"), last.alias("nom"))


@query("age_at_ref", f"SELECT code, {o.clamped_age('d')} AS age FROM (SELECT code, {o.iso_date('birthday')} AS d FROM ms_customer)")
def age_at_ref(k):
    return k.src.ms_customer.select("code", people.age_at_ref(dates.parse_iso_date_guarded(F.col("birthday"))).alias("age"))


@query("age_band", f"SELECT code, {o.band(o.clamped_age('d'))} AS tranche_age FROM (SELECT code, {o.iso_date('birthday')} AS d FROM ms_customer)")
def age_band(k):
    age = people.age_at_ref(dates.parse_iso_date_guarded(F.col("birthday")))
    return k.src.ms_customer.select("code", people.age_band(age).alias("tranche_age"))


@query("required_fields_filter", "SELECT id, sale_price, type FROM bb_sale_item WHERE sale_price IS NOT NULL AND sale_date IS NOT NULL AND trim(type) <> ''")
def required_fields_filter(k):
    return shape.required_fields_filter(k.src.bb_sale_item, ["sale_price", "sale_date"], ["type"]).select("id", "sale_price", "type")


@query("select_rename", "SELECT code AS source_code, surname AS nom, gender AS genre FROM ms_customer")
def select_rename(k):
    return shape.select_rename(k.src.ms_customer, {"code": "source_code", "surname": "nom", "gender": "genre"})


@query("tag_source", "SELECT code, 2 AS magasin_id, 'MS' AS source FROM ms_customer")
def tag_source(k):
    return shape.tag_source(k.src.ms_customer.select("code"), 2, "MS")


@query("rental_measures", f"""SELECT copy_id, cust_id, CAST({o.DAYS.format('from_date', 'to_date')} AS INTEGER) AS nb_jours_total,
    CAST(CAST(price_day AS DECIMAL(10,2)) * {o.DAYS.format('from_date', 'to_date')} AS DECIMAL(12,2)) AS ca_locations, 1 AS nb_locations FROM ms_copy_rented_to""")
def rental_measures(k):
    rented = shape.rental_measures(k.src.ms_copy_rented_to, "from_date", "to_date", "price_day")
    return rented.select("copy_id", "cust_id", "nb_jours_total", "ca_locations", "nb_locations")


@query("valid_interval_filter", "SELECT copy_id, cust_id, price_day FROM ms_copy_rented_to WHERE to_date > from_date")
def valid_interval_filter(k):
    return shape.valid_interval_filter(k.src.ms_copy_rented_to, "from_date", "to_date").select("copy_id", "cust_id", "price_day")


@query("period_label", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS periode FROM orders")
def period_label(k):
    label = text.period_label(F.year("o_orderdate"), F.month("o_orderdate"))
    return k.src.table("orders").select("o_orderkey", label.alias("periode"))


@query("gender_label", f"SELECT code, CASE WHEN {o.LABEL} = 'F' THEN 'Femme' ELSE 'Homme' END AS libelle FROM bb_customer")
def gender_label(k):
    return k.src.bb_customer.select("code", people.gender_label(people.gender_from_label(F.col("sex"))).alias("libelle"))


@query("route_rows", "SELECT id, coalesce(sale_price > 20000, false) AS vrai FROM bb_sale_item")
def route_rows(k):
    kept, rest = shape.route_rows(k.src.bb_sale_item.select("id", "sale_price"), F.col("sale_price") > 20000)
    return kept.select("id", F.lit(True).alias("vrai")).unionByName(rest.select("id", F.lit(False).alias("vrai")))


@query("calendar_parts", """SELECT o_orderkey, CAST(day(o_orderdate) AS INTEGER) AS jour, CAST(month(o_orderdate) AS INTEGER) AS mois,
    monthname(o_orderdate) AS nom_mois, CAST(quarter(o_orderdate) AS INTEGER) AS trimestre, CAST(year(o_orderdate) AS INTEGER) AS annee,
    'Q'||quarter(o_orderdate) AS libelle_trimestre FROM orders""")
def calendar_parts(k):
    parts = dates.calendar_parts(F.to_date("o_orderdate"))
    return k.src.table("orders").select("o_orderkey", *[e.alias(n) for n, e in parts.items()])


@query("client_caption", "SELECT code, regexp_replace(middlename, '^T', '')||' '||regexp_replace(surname, '^T', '') AS caption FROM ms_customer")
def client_caption(k):
    strip = text.strip_one_prefix
    return k.src.ms_customer.select("code", text.client_caption(strip(F.col("middlename")), strip(F.col("surname"))).alias("caption"))


@query("sale_flags", """SELECT id, CAST(year(sale_date) AS INTEGER) AS annee, 1 AS nb_ventes, CAST(coalesce(is_new, 0) AS INTEGER) AS est_neuf FROM ms_copy_for_sale""")
def sale_flags(k):
    return shape.sale_flags(k.src.ms_copy_for_sale, "sale_date", "is_new").select("id", "annee", "nb_ventes", "est_neuf")


@query("stock_vs_sale_split", "SELECT CASE WHEN sale_price IS NULL THEN 'stock' ELSE 'vente' END AS nature, count(*) AS n FROM bb_sale_item GROUP BY 1")
def stock_vs_sale_split(k):
    sold, stock = shape.stock_vs_sale_split(k.src.bb_sale_item, "sale_price")
    count = lambda df, name: df.agg(F.lit(name).alias("nature"), F.count(F.lit(1)).alias("n"))
    return count(sold, "vente").unionAll(count(stock, "stock"))


@query("ratio_measures", """SELECT magasin_id, round(CAST(sum(ca_ventes) AS DOUBLE) / sum(nb_ventes), 6) AS ca_moyen,
    round(CAST(sum(marge) AS DOUBLE) / nullif(CAST(sum(ca_ventes) AS DOUBLE), 0), 6) AS taux_marge,
    round(CAST(sum(nb_ventes) AS DOUBLE) / count(DISTINCT client_id), 6) AS ventes_par_client FROM fait_ventes GROUP BY magasin_id""")
def ratio_measures(k):
    sums = k.direct["fait_ventes"].groupBy("magasin_id").agg(
        F.sum("ca_ventes").alias("ca"), F.sum("marge").alias("marge"), F.sum("nb_ventes").alias("nb"),
        F.count_distinct("client_id").alias("clients"),
    )
    ratio = lambda a, b: F.round(measures.ratio_measures(F.col(a), F.col(b)), 6)
    return sums.select(
        "magasin_id", ratio("ca", "nb").alias("ca_moyen"), ratio("marge", "ca").alias("taux_marge"),
        ratio("nb", "clients").alias("ventes_par_client"),
    )


# --- set operations -----------------------------------------------------------------------

_BUYER = "cust_name, sex_male, birthdate"


def _buyers(k):
    cols = _BUYER.split(", ")
    return [t.select(*cols) for t in (k.src.mmm_movierentals, k.src.mmm_moviesales, k.src.mmm_gadgetsales)]


@query("union_distinct", f"""SELECT {_BUYER} FROM mmm_movierentals UNION SELECT {_BUYER} FROM mmm_moviesales
    UNION SELECT {_BUYER} FROM mmm_gadgetsales""")
def union_distinct(k):
    return shape.union_distinct(*_buyers(k))


@query("union_all", f"SELECT code, {o.iso_date('birthday')} AS d, CASE WHEN {o.iso_date('birthday')} IS NULL THEN 'undated' ELSE 'dated' END AS branch FROM ms_customer")
def union_all(k):
    day = k.src.ms_customer.select("code", dates.parse_iso_date_guarded(F.col("birthday")).alias("d"))
    dated, undated = shape.route_rows(day, F.col("d").isNotNull())
    return shape.union_all(dated.withColumn("branch", F.lit("dated")), undated.withColumn("branch", F.lit("undated")))


@query("append_streams", f"""SELECT cust_name, birthdate, address FROM mmm_movierentals UNION ALL SELECT cust_name, birthdate, NULL FROM mmm_moviesales
    UNION ALL SELECT cust_name, birthdate, NULL FROM mmm_gadgetsales""")
def append_streams(k):
    return shape.append_streams(
        k.src.mmm_movierentals.select("cust_name", "birthdate", "address"), k.src.mmm_moviesales.select("cust_name", "birthdate"),
        k.src.mmm_gadgetsales.select("cust_name", "birthdate"),
    )


@query("union_sales", "SELECT * FROM fait_ventes")
def union_sales(k):
    return direct.union_sales(k.src, k.calendar, k.direct["dim_produit"], k.direct["dim_client"], frequencies=k.direct["freq_ventes"])


@query("union_rentals", "SELECT * FROM fait_locations")
def union_rentals(k):
    return direct.union_rentals(k.src, k.calendar, k.direct["dim_produit"], k.direct["dim_client"], frequencies=k.direct["freq_locations"])
