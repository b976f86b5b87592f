"""Invariants of the two load paths and of cube answers on the smallest benchmark folder."""

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import cube as cb, shape
from reelhouse.operators.dedup import upsert_by_key
from reelhouse.plans import direct, layered
from reelhouse.plans.questions import QUESTIONS, ask


def _sum(df, col):
    return df.agg(F.sum(col)).collect()[0][0]


def test_keys_are_unique(ws):
    for table, key in (("dim_produit", "produit_id"), ("dim_client", "client_id"), ("dim_temps", "temps_id")):
        df = ws.direct[table]
        assert df.count() == df.select(key).distinct().count()


def test_stored_and_lazy_facts_agree(ws, rows):
    for name in ("fait_ventes", "fait_locations"):
        cols = ws.direct[name].columns
        assert rows(ws.lazy[name], *cols) == rows(ws.direct[name], *cols)


def test_summaries_add_up_to_the_facts(ws):
    sales, rentals = ws.direct["fait_ventes"], ws.direct["fait_locations"]
    for summary in ("agg_ventes_mois_magasin", "agg_ventes_mois_produit"):
        assert _sum(ws.direct[summary], "ca_total") == _sum(sales, "ca_ventes")
        assert _sum(ws.direct[summary], "nb_ventes") == sales.count()
    by_month = ws.direct["agg_locations_mois_produit_magasin"]
    assert _sum(by_month, "nb_jours_total") == _sum(rentals, "nb_jours_total")
    assert rentals.where("nb_jours_total < 1").count() == 0


def test_facts_and_rejects_are_the_priced_sales(ws):
    sales = ws.layered["int_vente"]
    fact, rejects = layered.load_fact_sales(ws.layered["ventes_datees"])
    priced = sales.where("date_vente IS NOT NULL AND prix_vente IS NOT NULL")
    assert fact.count() + rejects.count() == priced.count()
    assert {r.reason for r in rejects.select("reason").distinct().collect()} == {layered.NO_DATE, layered.NO_PRODUCT}


def test_direct_rejects_have_reasons(ws):
    found, out = ws.direct["ventes_resolues"], ws.direct["ventes_rejetees"]
    assert out.count() + ws.direct["fait_ventes"].count() == found.count() and out.count() > 0
    assert out.where("reason IS NULL").count() == 0
    assert out.where(F.col("reason") == direct.NO_DATE).where("date_complete <= '2000-12-31'").count() == 0


def test_reloading_facts_changes_nothing(ws, rows):
    fact, _ = layered.load_fact_sales(ws.layered["ventes_datees"])
    again, _ = layered.load_fact_sales(ws.layered["ventes_datees"], existing=fact)
    assert rows(again) == rows(fact)
    clients = ws.layered["ms_client"]
    assert rows(layered.ms_client(ws.src, existing=clients)) == rows(clients)


def test_sale_and_rental_ids_do_not_depend_on_partitions(ws, spark, rows):
    stored = {n: rows(ws.layered[n]) for n in ("int_vente", "int_location")}
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        for name, key in (("int_vente", "vente_id"), ("int_location", "location_id")):
            again = ws.layered.plan(name)
            assert rows(again) == stored[name]
            assert again.select(key).distinct().count() == len(stored[name])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_changed_sales_are_updated_and_new_ones_added(ws):
    dated = ws.layered["ventes_datees"]
    tenth = F.expr("pmod(xxhash64(vente_id), 10)")
    old, _ = layered.load_fact_sales(dated.where(tenth != 3))
    changed = dated.withColumn("prix_vente", F.when(tenth == 4, F.lit(1).cast("decimal(10,2)")).otherwise(F.col("prix_vente")))
    fact, _ = layered.load_fact_sales(changed, existing=old)
    assert fact.count() == fact.select("vente_id").distinct().count() == layered.load_fact_sales(dated)[0].count()
    assert fact.where((tenth == 4) & (F.col("ca_ventes") != 1)).count() == 0


def test_unpriced_gadgets_can_be_kept(ws):
    without = direct.sale_events(ws.src)
    with_them = direct.sale_events(ws.src, keep_unpriced_gadgets=True)
    assert without.where("ca_ventes IS NULL").count() == 0
    assert with_them.count() - without.count() == ws.src.mmm_gadgetsales.where("price_sale IS NULL").count() > 0


def test_unknown_band_and_gender_defaults(ws):
    clients = direct.dim_client(ws.src, unknown="Inconnu")
    assert clients.where("date_naissance IS NULL AND tranche_age <> 'Inconnu'").count() == 0
    assert clients.where("age IS NULL AND tranche_age = 'Inconnu'").count() > 0
    assert direct.bb_clients(ws.src.bb_customer, "M").where("genre IS NULL").count() == 0


def test_clients_of_different_stores_stay_apart(ws):
    per_store = ws.direct["dim_client"].groupBy("magasin_id").count().collect()
    assert {r[0] for r in per_store} == {1, 2, 3}
    assert ws.direct["fait_locations"].where("magasin_id = 1").count() == 0


@pytest.mark.parametrize("levels, slices, route", [
    (["Year", "Store"], {}, "agg_ventes_mois_magasin"),
    (["Year", "Month"], {"Store": [1]}, "agg_ventes_mois_magasin"),
    (["Year", "Type"], {}, "agg_ventes_mois_produit"),
    (["Month"], {}, "agg_ventes_mois_magasin"),
    (["Quarter"], {"Store": [2]}, "agg_ventes_mois_magasin"),
    (["Month", "Type"], {"Quarter": [(1996, 2), (1997, 1)]}, "agg_ventes_mois_produit"),
    (["Store"], {"Month": [(1996, 2, 5)]}, "agg_ventes_mois_magasin"),
    (["Store"], {"Month": [5]}, "agg_ventes_mois_magasin"),
    (["Year", "Quarter"], {}, "agg_ventes_mois_magasin"),
    (["Product"], {"Year": [1996]}, "fact"),
    (["Subtype"], {}, "fact"),
    (["Store", "Type"], {}, "fact"),
    (["Year"], {"Gender": ["F"]}, "fact"),
])
def test_router_answers_like_the_fact(ws, rows, levels, slices, route):
    cube = cb.slice_dice(ws.sales, slices)
    asked = ["Sales Revenue", "Number of Sales"]
    answer, used = cb.summary_router(cube, levels, asked)
    plain = cb.measure_at_level(cube, asked, levels)
    assert used == route and answer.columns == plain.columns
    assert rows(answer) == rows(plain)


def test_router_sends_undeclared_measures_to_the_fact(ws):
    assert cb.summary_router(ws.sales, ["Year", "Store"], ["Inventory Cost"])[1] == "fact"
    assert cb.summary_router(ws.rentals, ["Month", "Store"], ["Total Rental Days"])[1] == "agg_locations_mois_produit_magasin"


def test_rollup_totals_match_the_levels(ws):
    rolled = cb.rollup_time(ws.sales, ["Number of Sales"])
    total = ws.direct["fait_ventes"].count()
    for grouping in (0, 1, 3, 7, 15):
        assert _sum(rolled.where(f"grouping_id = {grouping}"), "`Number of Sales`") == total


def test_slices_narrow_each_other(ws):
    cube = cb.slice_dice(cb.slice_dice(ws.sales, {"Year": [1996, 1997]}), {"Year": [1997, 1998]})
    years = cb.measure_at_level(cube, ["Sales Revenue"], ["Year"]).collect()
    assert [r.annee for r in years] == [1997]


def test_members_without_facts_are_listed(ws):
    assert cb.level_members(ws.direct["dim_temps"], "Month").count() == 72
    captions = {r.caption for r in cb.level_members(ws.direct["dim_temps"], "Quarter").collect()}
    assert captions == {"Q1", "Q2", "Q3", "Q4"}


def test_approximate_buyers_are_close(ws):
    exact = cb.distinct_buyers(ws.direct["fait_ventes"], ["magasin_id"]).collect()
    near = {r[0]: r[1] for r in cb.distinct_buyers(ws.direct["fait_ventes"], ["magasin_id"], approximate=True).collect()}
    assert all(abs(near[r[0]] - r[1]) <= 0.15 * r[1] for r in exact)


def test_questions_are_sorted(ws):
    assert len(QUESTIONS) == 5 and {q.display for q in QUESTIONS.values()} == {"bar", "line", "table"}
    answer = ask(ws.direct, "Q2 — Monthly Revenue by Store").collect()
    assert [(r.Periode, r.Magasin) for r in answer] == sorted((r.Periode, r.Magasin) for r in answer)
    films = ask(ws.direct, "Q1 — Top Movies by Monthly Revenue").collect()
    assert [(r.Periode, -r.CA_EUR) for r in films] == sorted((r.Periode, -r.CA_EUR) for r in films)


def test_other_answers_are_sorted(ws):
    named = lambda text: ask(ws.direct, next(q for q in QUESTIONS if q.startswith(text))).collect()
    assert [r.Genre for r in named("Q3")] == ["Homme", "Femme", "Homme"]  # men, women, then the unknown, who are shown as men
    rented = [(r.Periode, r.Magasin, -r.Nb_Locations) for r in named("Q4")]
    assert rented == sorted(rented)
    assert [r.Periode for r in named("Q5")] == sorted(r.Periode for r in named("Q5"))
    people = shape.sort_ci(ws.src.bb_customer.select("code", "firstname", "lastname"), ["firstname", "lastname"], ["code"]).collect()
    keys = [(r.firstname.lower(), r.lastname.lower(), r.code) for r in people]
    assert keys == sorted(keys)
    months = ws.calendar.select("annee", "mois", "nom_mois").distinct().orderBy("nom_mois")
    assert [r.nom_mois for r in cb.member_sort(months.where("annee = 1996")).collect()][:3] == ["January", "February", "March"]


def test_upsert_keeps_unflagged_columns(ws):
    clients = ws.direct["dim_client"].select("client_id", "nom", "age")
    aged = clients.withColumn("age", F.col("age") + 1).withColumn("nom", F.lit("x"))
    merged = upsert_by_key(clients, aged, ["client_id"], ["age"])
    assert merged.where("nom = 'x'").count() == 0 and merged.count() == clients.count()
