"""Registered queries: summaries, cube, periods, rankings and the five questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelhouse.functions.measures import ratio_measures
from reelhouse.operators import cube as cb, measures, periods, shape
from reelhouse.plans import questions as qs
from reelhouse.registry.workspace import query, settled

_SALES = """fait_ventes f JOIN dim_temps t USING (temps_id) JOIN dim_produit p ON p.produit_id = f.produit_id
    JOIN dim_magasin m ON m.magasin_id = f.magasin_id JOIN dim_client c ON c.client_id = f.client_id"""
_RENTALS = _SALES.replace("fait_ventes", "fait_locations")
_CA = "CAST(sum(f.ca_ventes) AS DECIMAL(22,2))"
_NB = "CAST(sum(f.nb_ventes) AS BIGINT)"
_LOC = "CAST(sum(f.nb_locations) AS BIGINT)"
_YEARS = list(range(1995, 2001))


# --- summaries ----------------------------------------------------------------------------

@query("agg_sales_month_store", "SELECT * FROM agg_ventes_mois_magasin")
def agg_sales_month_store(k):
    return k.direct.plan("agg_ventes_mois_magasin")


@query("agg_sales_month_product", "SELECT * FROM agg_ventes_mois_produit")
def agg_sales_month_product(k):
    return k.direct.plan("agg_ventes_mois_produit")


@query("agg_rentals_month_product_store", "SELECT * FROM agg_locations_mois_produit_magasin")
def agg_rentals_month_product_store(k):
    return k.direct.plan("agg_locations_mois_produit_magasin")


@query("reaggregate_monthly", "SELECT * FROM mensuel")
def reaggregate_monthly(k):
    return settled(qs.monthly_rentals(k.direct["agg_locations_mois_produit_magasin"]))


@query("renter_profile", """SELECT c.genre, round(avg(c.age), 1) AS age_moyen, count(DISTINCT f.client_id) AS nb_clients, count(*) AS nb_locations
    FROM fait_locations f JOIN dim_client c ON c.client_id = f.client_id GROUP BY c.genre""")
def renter_profile(k):
    return measures.renters_by_gender(k.direct["fait_locations"], k.direct["dim_client"])


@query("avg_age_distinct_renters", """SELECT genre, round(avg(age), 6) AS age_moyen FROM dim_client
    WHERE client_id IN (SELECT client_id FROM fait_locations) GROUP BY genre""")
def avg_age_distinct_renters(k):
    ages = measures.avg_age_distinct_renters(k.direct["fait_locations"], k.direct["dim_client"])
    return ages.withColumn("age_moyen", F.round("age_moyen", 6))


@query("rental_duration_by_gender", """SELECT c.genre, round(CAST(sum(nb_jours_total) AS DOUBLE) / sum(nb_locations), 6) AS duree_moyenne
    FROM fait_locations f JOIN dim_client c ON c.client_id = f.client_id JOIN dim_produit p ON p.produit_id = f.produit_id WHERE p.type = 'film' GROUP BY c.genre""")
def rental_duration_by_gender(k):
    days = measures.rental_duration_by_gender(k.direct["fait_locations"], k.direct["dim_client"], k.direct["dim_produit"])
    return days.withColumn("duree_moyenne", F.round("duree_moyenne", 6))


# --- cube ---------------------------------------------------------------------------------

@query("measure_at_level", f"""SELECT t.annee, t.trimestre, p.type, p.sous_type, c.tranche_age, {_CA} AS "Sales Revenue",
    CAST(sum(f.prix_inventaire_total) AS DECIMAL(22,2)) AS "Inventory Cost", {_NB} AS "Number of Sales" FROM {_SALES} GROUP BY ALL""")
def measure_at_level(k):
    return settled(cb.measure_at_level(k.sales, ["Sales Revenue", "Inventory Cost", "Number of Sales"], ["Quarter", "Subtype", "Age Group"]))


@query("calculated_members", """SELECT t.annee, m.magasin_id, round(CAST(sum(ca_ventes) AS DOUBLE) / sum(nb_ventes), 6) AS "Avg Revenue per Sale",
    round(CAST(sum(marge) AS DOUBLE) / CAST(sum(ca_ventes) AS DOUBLE), 6) AS "Margin Rate"
    FROM fait_ventes f JOIN dim_temps t USING (temps_id) JOIN dim_magasin m USING (magasin_id) GROUP BY ALL""")
def calculated_members(k):
    names = ["Avg Revenue per Sale", "Margin Rate"]
    sums = cb.measure_at_level(k.sales, ["Sales Revenue", "Gross Margin", "Number of Sales"], ["Year", "Store"])
    ratios = cb.calculated_members(sums, names)
    return ratios.select("annee", "magasin_id", *[F.round(F.col(f"`{n}`"), 6).alias(n) for n in names])


@query("rollup_time", f"""SELECT t.annee, t.trimestre, t.mois, t.jour, CAST(grouping_id(t.annee, t.trimestre, t.mois, t.jour) AS BIGINT) AS grouping_id,
    {_CA} AS "Sales Revenue", {_NB} AS "Number of Sales" FROM fait_ventes f JOIN dim_temps t USING (temps_id) GROUP BY ROLLUP (t.annee, t.trimestre, t.mois, t.jour)""")
def rollup_time(k):
    return settled(cb.rollup_time(k.sales, ["Sales Revenue", "Number of Sales"]))


@query("rollup_product", f"""SELECT p.type, p.sous_type, p.produit_id, CAST(grouping_id(p.type, p.sous_type, p.produit_id) AS BIGINT) AS grouping_id,
    {_CA} AS "Sales Revenue" FROM fait_ventes f JOIN dim_produit p ON p.produit_id = f.produit_id GROUP BY ROLLUP (p.type, p.sous_type, p.produit_id)""")
def rollup_product(k):
    return settled(cb.rollup_product(k.sales, ["Sales Revenue"]))


@query("rollup_client", f"""SELECT 'age' AS hierarchie, c.tranche_age AS groupe, c.client_id, CAST(grouping_id(c.tranche_age, c.client_id) AS BIGINT) AS grouping_id,
    {_LOC} AS "Number of Rentals" FROM fait_locations f JOIN dim_client c ON c.client_id = f.client_id GROUP BY ROLLUP (c.tranche_age, c.client_id)
    UNION ALL SELECT 'gender', c.genre, c.client_id, CAST(grouping_id(c.genre, c.client_id) AS BIGINT), {_LOC}
    FROM fait_locations f JOIN dim_client c ON c.client_id = f.client_id GROUP BY ROLLUP (c.genre, c.client_id)""")
def rollup_client(k):
    return shape.union_all(*[
        cb.rollup_client(k.rentals, ["Number of Rentals"], name)
        .withColumnRenamed(cb.CLIENT_PATHS[name][0], "groupe").withColumn("hierarchie", F.lit(name))
        for name in ("age", "gender")
    ])


@query("cube_cross_dims", f"""SELECT t.annee, p.type, m.magasin_id, c.genre, CAST(grouping_id(t.annee, p.type, m.magasin_id, c.genre) AS BIGINT) AS grouping_id,
    {_CA} AS "Sales Revenue", {_NB} AS "Number of Sales" FROM {_SALES} GROUP BY CUBE (t.annee, p.type, m.magasin_id, c.genre)""")
def cube_cross_dims(k):
    return settled(cb.cube_cross_dims(k.sales, ["Sales Revenue", "Number of Sales"], ["annee", "type", "magasin_id", "genre"]))


@query("cube_of_products", f"""SELECT t.annee, f.produit_id, c.tranche_age, CAST(grouping_id(t.annee, f.produit_id, c.tranche_age) AS BIGINT) AS grouping_id,
    {_CA} AS "Sales Revenue", {_NB} AS "Number of Sales" FROM {_SALES} GROUP BY CUBE (t.annee, f.produit_id, c.tranche_age)""")
def cube_of_products(k):
    """A cube with a dimension that grows with the data, summed column by column."""
    return settled(cb.cube_cross_dims(k.sales, ["Sales Revenue", "Number of Sales"], ["annee", "produit_id", "tranche_age"], chained=True))


@query("pivot_matrix", "SELECT magasin_id, mois, " + ", ".join(
    f'CAST(sum(CASE WHEN annee = {y} THEN nb_locations END) AS BIGINT) AS "{y}"' for y in _YEARS
) + " FROM agg_locations_mois_produit_magasin GROUP BY magasin_id, mois")
def pivot_matrix(k):
    return cb.pivot_matrix(k.direct["agg_locations_mois_produit_magasin"], ["magasin_id", "mois"], "annee", _YEARS, "nb_locations")


@query("slice_dice", f"""SELECT t.annee, t.trimestre, t.mois, m.magasin_id, {_CA} AS "Sales Revenue" FROM {_SALES}
    WHERE p.type = 'film' AND t.annee IN (1996, 1997) AND m.magasin_id IN (1, 2) AND c.genre = 'F' GROUP BY ALL""")
def slice_dice(k):
    sliced = cb.slice_dice(k.sales, {"Type": ["film"], "Year": [1996, 1997], "Store": [1, 2], "Gender": ["F"]})
    return settled(cb.measure_at_level(sliced, ["Sales Revenue"], ["Month", "Store"]))


@query("summary_router", f"""SELECT 'agg_ventes_mois_magasin' AS route, t.annee, NULL AS trimestre, NULL AS mois, f.magasin_id, NULL AS type, NULL AS sous_type, {_CA} AS "Sales Revenue"
    FROM fait_ventes f JOIN dim_temps t USING (temps_id) GROUP BY ALL
    UNION ALL SELECT 'agg_ventes_mois_magasin', t.annee, t.trimestre, t.mois, NULL, NULL, NULL, {_CA} FROM fait_ventes f JOIN dim_temps t USING (temps_id) GROUP BY ALL
    UNION ALL SELECT 'agg_ventes_mois_produit', t.annee, t.trimestre, NULL, NULL, p.type, NULL, {_CA}
    FROM fait_ventes f JOIN dim_temps t USING (temps_id) JOIN dim_produit p ON p.produit_id = f.produit_id GROUP BY ALL
    UNION ALL SELECT 'fact', NULL, NULL, NULL, NULL, p.type, p.sous_type, {_CA} FROM fait_ventes f JOIN dim_produit p ON p.produit_id = f.produit_id GROUP BY ALL""")
def summary_router(k):
    asked = (["Year", "Store"], ["Month"], ["Quarter", "Type"], ["Subtype"])
    answers = [cb.summary_router(k.sales, levels, ["Sales Revenue"]) for levels in asked]
    return settled(shape.append_streams(*[df.withColumn("route", F.lit(route)) for df, route in answers]))


@query("distinct_buyers", "SELECT annee, magasin_id, count(DISTINCT client_id) AS n FROM fait_ventes GROUP BY ALL")
def distinct_buyers(k):
    return cb.distinct_buyers(k.direct["fait_ventes"], ["annee", "magasin_id"])


@query("year_filtered_total", "SELECT CAST(sum(ca_ventes) AS DECIMAL(22,2)) AS total FROM fait_ventes WHERE annee = 1998 AND magasin_id = 1")
def year_filtered_total(k):
    return cb.year_filtered_total(k.direct["fait_ventes"], "ca_ventes", 1998, 1)


@query("level_members", f"""SELECT c.client_id, c.prenom||' '||c.nom AS caption, coalesce(n, 0) AS n FROM dim_client c
    LEFT JOIN (SELECT client_id, count(*) AS n FROM fait_ventes GROUP BY client_id) f ON f.client_id = c.client_id""")
def level_members(k):
    counts = k.direct["fait_ventes"].groupBy("client_id").agg(F.count(F.lit(1)).alias("n"))
    members = cb.level_members(k.direct["dim_client"], "Client").join(counts, "client_id", "left")
    return members.withColumn("n", F.coalesce("n", F.lit(0)))


# --- periods ------------------------------------------------------------------------------

def _monthly(k):
    return settled(qs.monthly_rentals(k.direct["agg_locations_mois_produit_magasin"]))


@query("lag_previous_row", "SELECT b.*, a.nb_locations AS prev FROM mensuel b LEFT JOIN (SELECT annee, mois, nb_locations FROM mensuel) a "
       "ON a.annee * 12 + a.mois = (SELECT max(annee * 12 + mois) FROM mensuel c WHERE c.annee * 12 + c.mois < b.annee * 12 + b.mois)")
def lag_previous_row(k):
    return periods.lag_previous_row(_monthly(k), "nb_locations")


_NUMBERED = "(SELECT *, dense_rank() OVER (ORDER BY annee * 12 + mois) AS i FROM mensuel)"
_MOM = f"""(SELECT b.annee, b.mois, b.nb_locations, b.ca_total, round(CAST(b.nb_locations - a.nb_locations AS DOUBLE) / a.nb_locations * 100, 1) AS pct
    FROM {_NUMBERED} a JOIN {_NUMBERED} b ON b.i = a.i + 1)"""


@query("mom_change_pct", f"SELECT annee, mois, nb_locations, ca_total, pct FROM {_MOM}")
def mom_change_pct(k):
    return periods.mom_change_pct(_monthly(k), "nb_locations")


@query("previous_calendar_month", "SELECT annee, mois, nb_locations, ca_total, prev FROM mois_compare")
def previous_calendar_month(k):
    return periods.previous_calendar_month(_monthly(k), "nb_locations")


@query("mom_drop_filter", """SELECT a.annee, a.mois, a.produit_id, CAST(sum(a.nb_locations) AS BIGINT) AS nb_locations, round(any_value(d.pct), 6) AS pct
    FROM agg_locations_mois_produit_magasin a JOIN mois_compare d ON d.annee = a.annee AND d.mois = a.mois WHERE d.pct < -0.15 GROUP BY a.annee, a.mois, a.produit_id""")
def mom_drop_filter(k):
    summary = k.direct["agg_locations_mois_produit_magasin"]
    by_product = periods.reaggregate_monthly(summary, ["annee", "mois", "produit_id"], ["nb_locations"])
    return periods.mom_drop_filter(by_product, "nb_locations").withColumn("pct", F.round("pct", 6))


@query("mom_drop_flag", """SELECT annee, mois, nb_locations, ca_total, prev, round(pct, 6) AS pct, CASE WHEN pct < -0.15 THEN nb_locations END AS flagged FROM mois_compare""")
def mom_drop_flag(k):
    return periods.mom_drop_flag(_monthly(k), "nb_locations").withColumn("pct", F.round("pct", 6))


_YEARLY = """(SELECT annee, produit_id, CAST(sum(ca_total) AS DECIMAL(22,2)) AS ca_total, CAST(sum(nb_ventes) AS BIGINT) AS nb_ventes
    FROM agg_ventes_mois_produit WHERE type_produit = 'film' GROUP BY ALL)"""


@query("topn_per_group", f"""SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY annee ORDER BY ca_total DESC, produit_id) AS INTEGER) AS rank
    FROM {_YEARLY}) WHERE rank <= 5""")
def topn_per_group(k):
    return settled(qs.top_films_per_year(k.direct["agg_ventes_mois_produit"]))


# --- sorts, limits, top-k -----------------------------------------------------------------

_PERIODE = "annee||'-'||lpad(CAST(mois AS VARCHAR), 2, '0') AS Periode"


_MONTH = "strftime(date_complete, '%Y-%m') AS Periode"
_Q1 = f"""SELECT Periode, any_value(titre) AS Film, {_CA} AS CA_EUR, {_NB} AS Nb_Ventes
    FROM (SELECT {_MONTH}, produit_id, ca_ventes, nb_ventes FROM fait_ventes JOIN dim_temps USING (temps_id)) f
    JOIN dim_produit p ON p.produit_id = f.produit_id AND p.type = 'film' GROUP BY Periode, f.produit_id"""


@query("q1_movies_by_month", _Q1)
def q1_movies_by_month(k):
    return qs.q1_movies_by_month(k.direct["agg_ventes_mois_produit"], k.direct["dim_produit"])


_Q2 = f"""SELECT {_MONTH}, nom AS Magasin, {_CA} AS CA_EUR, {_NB} AS Nb_Ventes, count(DISTINCT f.client_id) AS Nb_Clients
    FROM fait_ventes f JOIN dim_temps t ON t.temps_id = f.temps_id JOIN dim_magasin m ON m.magasin_id = f.magasin_id GROUP BY Periode, nom"""


@query("q2_revenue_by_store", _Q2)
def q2_revenue_by_store(k):
    return qs.q2_revenue_by_store(k.direct["agg_ventes_mois_magasin"], k.stores)


_Q3 = """SELECT if(g = 'F', 'Femme', 'Homme') AS Genre, round(years / aged, 1) AS Age_Moyen, Nb_Clients_Distincts, Nb_Locations FROM (
    SELECT coalesce(genre, '?') AS g, CAST(sum(age * n) AS DOUBLE) AS years, sum(n) FILTER (age IS NOT NULL) AS aged,
      count(*) AS Nb_Clients_Distincts, CAST(sum(n) AS BIGINT) AS Nb_Locations
    FROM dim_client JOIN (SELECT client_id AS renter, count(*) AS n FROM fait_locations GROUP BY ALL) ON renter = client_id GROUP BY g)"""


@query("q3_renter_profile", _Q3)
def q3_renter_profile(k):
    return qs.q3_renter_profile(k.direct["fait_locations"], k.direct["dim_client"])


_Q4 = f"""SELECT any_value(nom) AS Magasin, {_MONTH}, any_value(titre) AS Film, {_LOC} AS Nb_Locations, CAST(sum(ca_locations) AS DECIMAL(22,2)) AS CA_EUR
    FROM fait_locations f JOIN dim_temps t ON t.temps_id = f.temps_id JOIN dim_magasin m ON m.magasin_id = f.magasin_id
    JOIN dim_produit p ON p.produit_id = f.produit_id GROUP BY f.magasin_id, Periode, f.produit_id"""


@query("q4_rentals_by_store", _Q4)
def q4_rentals_by_store(k):
    return qs.q4_rentals_by_store(k.direct["agg_locations_mois_produit_magasin"], k.direct["dim_produit"], k.stores)


_Q5 = f"SELECT {_PERIODE}, nb_locations AS Nb_Locations, ca_total AS CA_EUR, pct AS Variation_Pct FROM {_MOM}"


@query("q5_rental_trends", _Q5)
def q5_rental_trends(k):
    return qs.q5_rental_trends(k.direct["agg_locations_mois_produit_magasin"])


_ANSWERS = {  # fixed values: how each question's result is meant to be shown
    "Q1 — Top Movies by Monthly Revenue": ("bar", _Q1, ("Periode", "Film", "CA_EUR", "Nb_Ventes")),
    "Q2 — Monthly Revenue by Store": ("line", _Q2, ("Periode", "Magasin", "CA_EUR", "Nb_Ventes", "Nb_Clients")),
    "Q3 — Renter Profile (Average Age M/F)": ("bar", _Q3, ("Genre", "Age_Moyen", "Nb_Clients_Distincts", "Nb_Locations")),
    "Q4 — Most Rented Movies by Store": ("table", _Q4, ("Magasin", "Periode", "Film", "Nb_Locations", "CA_EUR")),
    "Q5 — Monthly Rental Trends": ("line", _Q5, ("Periode", "Nb_Locations", "CA_EUR", "Variation_Pct")),
}


@query("question_registry", " UNION ALL ".join(
    f"SELECT '{name}' AS question, '{display}' AS display, concat_ws('|', {', '.join(cols)}) AS answer FROM ({sql})"
    for name, (display, sql, cols) in _ANSWERS.items()
))
def question_registry(k):
    """The rows of every registered question, as text."""
    return shape.union_all(*[
        qs.ask(k.direct, q.name).select(
            F.lit(q.name).alias("question"), F.lit(q.display).alias("display"), F.concat_ws("|", *_ANSWERS[q.name][2]).alias("answer"))
        for q in qs.QUESTIONS.values()
    ])


_TOP = "SELECT produit_id FROM agg_ventes_mois_produit {} GROUP BY produit_id ORDER BY sum(ca_total) DESC, produit_id LIMIT {}"


@query("top_count", f"""SELECT annee, produit_id, CAST(sum(ca_total) AS DECIMAL(22,2)) AS value FROM agg_ventes_mois_produit
    WHERE produit_id IN ({_TOP.format("WHERE type_produit = 'film'", 5)}) GROUP BY annee, produit_id""")
def top_count(k):
    films = cb.slice_dice(k.sales, {"Type": ["film"]})
    return settled(cb.top_count(films, "Product", 5, "Sales Revenue")).withColumnRenamed("member", "produit_id")


@query("top20_series", f"""SELECT annee, mois, produit_id, type_produit, ca_total AS ca FROM agg_ventes_mois_produit
    WHERE produit_id IN ({_TOP.format('', 20)})""")
def top20_series(k):
    return qs.top20_series(k.direct["agg_ventes_mois_produit"])


@query("sort_ci", "SELECT code, firstname, lastname FROM bb_customer")
def sort_ci(k):
    return shape.sort_ci(k.src.bb_customer.select("code", "firstname", "lastname"), ["firstname", "lastname"], ["code"])


@query("member_sort", f"""SELECT t.annee, t.trimestre, t.nom_mois, {_LOC} AS "Number of Rentals" FROM fait_locations f
    JOIN dim_temps t USING (temps_id) GROUP BY ALL""")
def member_sort(k):
    months = cb.measure_at_level(k.rentals, ["Number of Rentals"], ["Month"])
    names = k.calendar.select("annee", "mois", "nom_mois").distinct()
    return cb.member_sort(months.join(names, ["annee", "mois"]))


@query("rental_ratios", """SELECT annee, magasin_id, round(CAST(sum(ca_locations) AS DOUBLE) / sum(nb_locations), 6) AS ca_moyen,
    round(CAST(sum(nb_jours_total) AS DOUBLE) / sum(nb_locations), 6) AS duree_moyenne,
    round(CAST(sum(nb_locations) AS DOUBLE) / count(DISTINCT client_id), 6) AS locations_par_client FROM fait_locations GROUP BY ALL""")
def rental_ratios(k):
    sums = k.direct["fait_locations"].groupBy("annee", "magasin_id").agg(
        F.sum("ca_locations").alias("ca"), F.sum("nb_locations").alias("nb"), F.sum("nb_jours_total").alias("jours"),
        F.count_distinct("client_id").alias("clients"),
    )
    ratio = lambda a, b: F.round(ratio_measures(F.col(a), F.col(b)), 6)
    return sums.select(
        "annee", "magasin_id", ratio("ca", "nb").alias("ca_moyen"), ratio("jours", "nb").alias("duree_moyenne"),
        ratio("nb", "clients").alias("locations_par_client"),
    )
