"""Physical plans: what reaches the scan, what is broadcast, what stays in the JVM."""

import re

from pyspark.sql import functions as F

from reelhouse.plans import direct
from reelhouse.plans.questions import q1_movies_by_month, top_films_per_year


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_raw_sales_push_the_store_and_prune_columns(ws):
    plan = _plan(direct.sale_events(ws.src))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)", plan)
    lines = [(cols, pushed) for cols, pushed in scans if "l_orderkey" in cols]
    assert len(lines) == 5 and all("l_returnflag" in pushed for _, pushed in lines)
    assert all("l_suppkey" not in cols and "l_shipdate" not in cols for cols, _ in lines)


def test_no_python_no_cartesian_in_the_fact_load(ws):
    plan = _plan(ws.lazy["agg_ventes_mois_magasin"])
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_question_reads_the_summary_only(ws):
    plan = _plan(q1_movies_by_month(ws.direct["agg_ventes_mois_produit"], ws.direct["dim_produit"]))
    assert "fait_ventes" not in plan and "EqualTo(type_produit,film)" in plan


def test_topn_is_limited_before_the_shuffle(ws):
    plan = _plan(top_films_per_year(ws.direct["agg_ventes_mois_produit"]))
    assert plan.count("WindowGroupLimit") == 2


def test_year_slice_prunes_partitions(ws):
    from reelhouse.operators import cube as cb

    sliced = cb.slice_dice(ws.sales, {"Year": [1997]})
    plan = _plan(cb.measure_at_level(sliced, ["Sales Revenue"], ["Month"]))
    assert re.search(r"PartitionFilters: \[[^\]]*annee", plan)


def test_distinct_counts_shuffle_by_client_first(ws):
    plan = _plan(ws.direct.plan("agg_ventes_mois_magasin"))
    assert re.search(r"hashpartitioning\(annee#\d+, mois#\d+, magasin_id#\d+, client_id", plan)


def test_calendar_is_the_only_forced_broadcast_of_a_fact(ws, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fact = direct.union_sales(ws.src, ws.calendar, ws.direct["dim_produit"], ws.direct["dim_client"])
        plan = _plan(fact.select(F.col("temps_id"), F.col("client_id")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("BroadcastHashJoin") <= 1
