"""Changes of stored tables, summaries kept up to date, measurements on the way, sets and groups of clients, hot keys."""

import statistics

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from reelhouse.operators import cube as cb, dedup, member_sets, periods, quality, skew
from reelhouse.plans import direct, groups, refresh, summaries
from reelhouse.plans.stage import Stage
from reelhouse.sources import tables


@pytest.fixture
def database(spark):
    return tables.new_database(spark, "test")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- changes of a stored table -----------------------------------------------------------------

def _failing(df, column, bad):
    return df.withColumn(column, F.when(F.col("id") == bad, F.raise_error(F.lit("lost half-way")).cast("int")).otherwise(F.col(column)))


def test_a_failed_upsert_leaves_the_table_whole(spark, database, rows):
    table = f"{database}.fact"
    before = [(i, i * 10, 2007 + i % 3) for i in range(60)]
    tables.fact_partition_by_year(spark.createDataFrame(before, "id int, v int, annee int"), table)
    updates = spark.createDataFrame([(i, 0, 2007 + i % 2) for i in range(40)], "id int, v int, annee int").repartition(4)
    with pytest.raises(PySparkException):
        tables.upsert_table(table, _failing(updates, "v", 31), ["id"], partition="annee")
    spark.catalog.refreshTable(table)
    assert rows(spark.table(table)) == rows(spark.createDataFrame(before, "id int, v int, annee int"))
    tables.upsert_table(table, updates, ["id"], partition="annee")
    after = {r.id: (r.v, r.annee) for r in spark.table(table).collect()}
    assert after == {i: ((0, 2007 + i % 2) if i < 40 else (i * 10, 2007 + i % 3)) for i in range(60)}


def test_a_failed_replacement_leaves_the_table_whole(spark, database, rows):
    table = f"{database}.t"
    tables.truncate_reload(spark.createDataFrame([(1, 1), (2, 2)], "id int, v int"), table)
    with pytest.raises(PySparkException):
        tables.upsert_table(table, _failing(spark.createDataFrame([(2, 3), (3, 3)], "id int, v int"), "v", 3), ["id"])
    assert rows(spark.table(table)) == [(1, 1), (2, 2)]
    for _ in range(2):
        tables.upsert_table(table, spark.createDataFrame([(2, 3)], "id int, v int"), ["id"])
        assert rows(spark.table(table)) == [(1, 1), (2, 3)]


def test_an_upsert_cut_off_before_its_last_step_is_set_right_by_the_next(spark, database, rows):
    """The row moved from 2008 to 2009, but the emptied folder of 2008 was not dropped."""
    table = f"{database}.fact"
    tables.fact_partition_by_year(spark.createDataFrame([(1, 10, 2008), (1, 11, 2009)], "id int, v int, annee int"), table)
    tables.upsert_table(table, spark.createDataFrame([(1, 11, 2009)], "id int, v int, annee int"), ["id"], partition="annee")
    assert rows(spark.table(table)) == [(1, 11, 2009)]


def test_removed_rows_and_emptied_partitions(spark, database, rows):
    table = f"{database}.fact"
    tables.fact_partition_by_year(spark.createDataFrame([(1, 1, 2007), (2, 2, 2008), (3, 3, 2008)], "id int, v int, annee int"), table)
    gone = spark.createDataFrame([(1,), (3,), (9,)], "id int")
    for _ in range(2):
        tables.delete_rows(table, gone, ["id"], "annee")
        assert rows(spark.table(table)) == [(2, 2, 2008)]
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()] == ["annee=2008"]


# --- summaries ------------------------------------------------------------------------------------

@pytest.fixture
def stored_fact(ws, spark, database):
    fact = f"{database}.fait_ventes"
    tables.fact_partition_by_year(ws.layered["fait_ventes"], fact)
    build = {f"{database}.by_store": summaries.agg_sales_month_store}
    for table, make in build.items():
        tables.fact_partition_by_year(make(spark.table(fact), ws.calendar), table)
    return fact, build


def test_refresh_equals_a_full_rebuild(ws, spark, stored_fact, rows):
    fact, build = stored_fact
    table, make = next(iter(build.items()))
    sales = ws.layered["fait_ventes"]
    changed = sales.where("annee = 1996 AND pmod(xxhash64(vente_id), 40) = 0").withColumn("ca_ventes", F.lit(1).cast("decimal(12,2)"))
    gone = sales.where("annee IN (1995, 1998) AND pmod(xxhash64(vente_id), 30) = 1")
    days = refresh.change_fact(fact, ["vente_id"], changed, gone)
    columns = spark.table(table).columns
    for _ in range(2):
        months = refresh.refresh_aggregates(fact, build, days, ws.calendar)
        assert rows(spark.table(table), *columns) == rows(make(spark.table(fact), ws.calendar), *columns)
    assert {year for year, _ in months} == {1995, 1996, 1998}
    assert refresh.refresh_aggregates(fact, build, days.limit(0), ws.calendar) == []


def test_refresh_reads_touched_years_only(ws, spark, stored_fact):
    fact, build = stored_fact
    fresh = refresh.refreshed(spark.table(fact), ws.calendar, [(1996, 2), (1996, 7)], summaries.agg_sales_month_store)
    assert {f.split("annee=")[1][:4] for f in spark.table(fact).where("annee IN (1996)").inputFiles()} == {"1996"}
    plan = _plan(fresh)
    assert "PartitionFilters" in plan and "annee" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {(r.annee, r.mois) for r in fresh.collect()} == {(1996, 2), (1996, 7)}


def test_reports_of_loaded_tables_read_none(ws, spark, database, rows):
    stage = Stage(spark, None, {"a": lambda s: spark.range(7), "b": lambda s: s["a"].withColumn("x", F.when(F.col("id") > 4, F.col("id")))}, database)
    report = summaries.load_and_report(stage, ("a", "b"))
    assert "Scan parquet" not in _plan(report) and rows(report) == [("a", 7), ("b", 7)]
    assert rows(quality.measured_nulls(spark, stage.measured)) == [("a", "id", 0, 7, 0.0), ("b", "id", 0, 7, 0.0), ("b", "x", 5, 7, 71.428571)]
    for name in ("dim_client", "fait_ventes"):
        ws.direct[name]
        assert ws.direct.measured[name]["nb"] == ws.direct[name].count()


def test_previous_month_reads_its_input_once(spark, rows):
    monthly = spark.createDataFrame([(1, 1999, 11, 5), (1, 1999, 12, 6), (1, 2000, 1, 7), (1, 2000, 3, 8), (2, 2000, 1, 9)], "k int, annee int, mois int, n int")
    found = periods.previous_calendar_month(monthly, "n", ["k"])
    assert rows(found.select("k", "annee", "mois", "prev")) == [(1, 1999, 11, None), (1, 1999, 12, 5), (1, 2000, 1, 6), (1, 2000, 3, None), (2, 2000, 1, None)]
    assert "Join" not in _plan(found)


def _shuffled_rows(spark, df):
    context = spark.sparkContext
    context.setJobGroup("shuffled", "rows")
    before = set(context.statusTracker().getJobIdsForGroup("shuffled"))
    df.write.format("noop").mode("overwrite").save()
    stages = {s for j in set(context.statusTracker().getJobIdsForGroup("shuffled")) - before for s in context.statusTracker().getJobInfo(j).stageIds}
    context.setLocalProperty("spark.jobGroup.id", None)
    total = 0
    for stage in stages:
        try:
            total += context._jsc.sc().statusStore().lastStageAttempt(stage).shuffleWriteRecords()
        except Exception:  # noqa: BLE001, S112: a skipped stage has no attempt
            continue
    return total


def test_cube_totals_group_the_finest_rows_once(ws, spark, rows):
    """Neither form groups the finest rows again, which a plain cube does beside all others; all give the same rows."""
    columns = ["annee", "produit_id", "tranche_age"]
    sums, shown = {"Number of Sales": F.sum("`Number of Sales`")}, [*columns, "grouping_id", "`Number of Sales`"]
    finest = cb.written(cb._finest(ws.sales, columns, ["Number of Sales"]), "test")
    plain = finest.cube(*columns).agg(F.grouping_id().alias("grouping_id"), F.sum("`Number of Sales`").alias("Number of Sales"))
    before = _shuffled_rows(spark, plain)
    kept = [["annee", "produit_id"], ["annee", "tranche_age"], ["produit_id", "tranche_age"], ["annee"], ["produit_id"], ["tranche_age"], []]
    for found in (cb.every_total(finest, columns, cb.by_members(ws.sales, columns), sums), cb.coarser_totals(finest, columns, kept, sums)):
        assert rows(found, *shown) == rows(plain, *shown)
        assert _shuffled_rows(spark, found) <= before - finest.count()


def test_years_can_be_sliced_by_tuple(ws, rows):
    one, other = (cb.measure_at_level(cb.slice_dice(ws.sales, {"Year": [y]}), ["Number of Sales"], ["Month"]) for y in (1996, (1996,)))
    assert rows(one) == rows(other)


def test_router_takes_the_smallest_summary_by_measured_rows(ws):
    d = ws.direct
    summaries = d["agg_ventes_mois_magasin"], d["agg_ventes_mois_produit"]
    asked = (["Year"], ["Sales Revenue"])
    for rows, route in (({"agg_ventes_mois_magasin": 9, "agg_ventes_mois_produit": 5}, "agg_ventes_mois_produit"), ({"agg_ventes_mois_produit": 5}, "agg_ventes_mois_produit"),
                        ({"agg_ventes_mois_magasin": 4, "agg_ventes_mois_produit": 5}, "agg_ventes_mois_magasin"), ({}, "agg_ventes_mois_magasin")):
        assert cb.summary_router(cb.sales_cube(d["fait_ventes"], ws.dims, *summaries, rows), *asked)[1] == route
    assert all(s.rows == s.frame.count() for s in ws.sales.summaries)


def test_replayed_rejects_need_no_second_load(ws, spark, database, rows):
    from reelhouse.plans import layered

    dated = ws.layered["ventes_datees"]
    fact, missing = layered.load_fact_sales(dated)
    tables.fact_partition_by_year(fact, f"{database}.fact")
    tables.truncate_reload(missing, f"{database}.rejects")
    for _ in range(2):
        days = refresh.replay_rejects(f"{database}.fact", f"{database}.rejects", ws.layered["int_produit"], ws.calendar)
        assert days.count() == 0 and rows(spark.table(f"{database}.rejects"), *missing.columns) == rows(missing)
        assert rows(spark.table(f"{database}.fact"), *fact.columns) == rows(fact)


def test_fingerprints_see_any_change(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 1.5), (2, "b", 1.5)], "id int, t string, v double")
    cols = df.columns
    one = quality.table_fingerprint(df, "t", cols).collect()
    assert quality.table_fingerprint(df.repartition(5).orderBy(F.rand(3)), "t", cols).collect() == one
    for other in (df.union(df.limit(1)), df.distinct(), df.withColumn("v", F.coalesce("v", F.lit(0.0))), df.limit(0)):
        assert quality.table_fingerprint(other, "t", cols).collect() != one
    assert tuple(quality.table_fingerprint(df.limit(0), "t", cols).collect()[0]) == ("t", 0, "0", 0)


# --- sets and groups of clients --------------------------------------------------------------------

def test_sets_of_any_ids_merge(spark, rows):
    ids = [None, -5, -1, 0, 1, 32767, 32768, 10**12, 10**12 + 32768]
    data = spark.createDataFrame([(i % 3, i % 2, v) for i in range(30) for v in ids[i % 5:]], "a int, b int, client_id long")
    sets = member_sets.member_sets(data, ["a", "b"])
    for keys in (["a", "b"], ["a"], ["b"], []):
        expected = data.groupBy(*keys).agg(F.count_distinct("client_id").alias("n"))
        assert rows(member_sets.set_sizes(member_sets.merged_sets(sets, keys), keys)) == rows(expected)


def test_rollup_reads_the_sets_once(ws):
    plan = _plan(member_sets.rollup_distinct_stores(ws.client_sets))
    assert "Expand" not in plan and "fait_ventes" not in plan


def test_namesakes_stay_beside_the_fact(ws, spark, rows):
    fact, sales = ws.direct["ventes_groupes"], ws.direct["fait_ventes"]
    assert fact.count() < sales.count()
    d, cols = ws.direct, ws.direct["fait_locations"].columns
    assert rows(groups.expanded(d["locations_groupes"], d["pont_groupe_client"]), *cols) == rows(d["fait_locations"])
    by_type = groups.totals(fact, d["dim_groupe"], d["dim_temps"], ["magasin_id", "annee"], {"n": "nb_ventes"})
    plain = sales.groupBy("magasin_id", "annee").agg(F.sum("nb_ventes").alias("n"), F.count_distinct("client_id").alias("nb_clients"))
    assert rows(by_type) == rows(plain)
    assert d["ref_groupe"].count() == d["ref_groupe"].select("magasin_id", "client_ref").distinct().count()


# --- hot keys -------------------------------------------------------------------------------------------

def test_fact_join_is_split_at_the_hot_product(ws, spark):
    """With plain shuffled joins, one task would hold all lines of the product that has an eighth of them."""
    kept = {key: spark.conf.get(key) for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    sales, products, frequencies = (ws.direct[n] for n in ("fait_ventes", "ref_produit", "freq_ventes"))
    assert sales.count() and not skew.pieces_of(frequencies, "produit", "ref_kind string, produit_ref string", direct.HOT_SHARE).isEmpty()
    events = direct.sale_events(ws.src).where("magasin_id = 2")
    for key, value in zip(kept, ("-1", "false", "16")):
        spark.conf.set(key, value)
    try:
        def largest(hot):
            found = direct._looked_up(events, products, "produit", hot).groupBy(F.spark_partition_id().alias("task")).count().collect()
            counts = [r["count"] for r in found]
            return max(counts) / statistics.median(counts)

        assert largest(frequencies) < 2 < largest(None)
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)


def test_frequent_keys_in_one_pass(spark, rows):
    df = spark.createDataFrame([(i % 7 if i % 2 else 100, None if i % 3 == 0 else f"k{i % 50 if i % 5 else 0}", i) for i in range(4000)], "a int, b string, n int")
    found = skew.frequent_keys(df, {"one": ["a"], "two": ["a", "b"]}, share=0.04)
    assert "Exchange hashpartitioning" not in _plan(found)
    hot = skew.pieces_of(found, "one", "a int", 0.04)
    assert hot.where("a = 100").collect()[0].pieces == 13
    for side, cols, schema in (("one", ["a"], "a int"), ("two", ["a", "b"], "a int, b string")):
        exact = df.dropna(subset=cols).groupBy(*cols).count().where(F.col("count") > 0.04 * 4000)
        assert rows(skew.pieces_of(found, side, schema, 0.04), *cols) == rows(exact, *cols)
    assert skew.frequent_keys(df.limit(0), {"one": ["a"]}).count() == 0


# --- keys and files ----------------------------------------------------------------------------------------

@pytest.mark.parametrize("partitions", ["1", "7"])
def test_dense_keys_have_no_gaps(spark, partitions, rows):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        data = spark.createDataFrame([(None if i == 3 else i * 37 % 101, f"n{i % 4}") for i in range(101)], "k int, t string").repartition(5)
        found = {(r.k, r.t): r.id for r in dedup.dense_keys(data, ["t", "k"], "id").collect()}
        ordered = sorted(found, key=lambda r: (r[1], r[0] is not None, r[0] or 0))
        assert [found[r] for r in ordered] == list(range(1, 102))
        assert dedup.dense_keys(data.limit(0), ["t", "k"], "id").count() == 0
        known = dedup.dense_keys(data.where("t = 'n2'"), ["t", "k"], "id")
        again = {(r.k, r.t): r.id for r in dedup.dense_keys(data, ["t", "k"], "id", known=known).collect()}
        assert sorted(again.values()) == list(range(1, 102))
        assert {key: again[key] for key in again if key[1] == "n2"} == {(r.k, r.t): r.id for r in known.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_new_and_changed_files_are_taken_once(spark, database, tmp_path, rows):
    table, schema = f"{database}.raw", "id int, p decimal(8,2)"
    write = lambda name, ids: spark.createDataFrame([(i,) for i in ids], "id int").selectExpr("id", "cast(id AS decimal(8,2)) AS p").coalesce(1).toPandas().to_parquet(f"{tmp_path}/{name}")
    take = lambda: tables.ingest_new_files(spark, str(tmp_path), table, schema).count()
    ids = lambda: sorted(r.id for r in spark.table(table).collect())
    write("a.parquet", [1, 2])
    assert take() == 1 and ids() == [1, 2] and take() == 0
    write("b.parquet", [3])
    write("c.parquet", [4, 5])
    assert take() == 2 and ids() == [1, 2, 3, 4, 5]
    write("b.parquet", [30, 31, 32])
    assert take() == 1 and ids() == [1, 2, 4, 5, 30, 31, 32] and take() == 0
    write("a.parquet", [7])
    assert take() == 1 and ids() == [4, 5, 7, 30, 31, 32]
    assert dict(spark.table(table).dtypes)["p"] == "double"
    assert {r.path.split("/")[-1]: r.lot for r in tables.ingested_files(spark, table).collect()}.keys() == {"a.parquet", "b.parquet", "c.parquet"}


def test_a_lot_without_a_ledger_entry_is_dropped(spark, database, tmp_path):
    table, schema = f"{database}.raw", "id int"
    spark.range(3).selectExpr("cast(id AS int) AS id").toPandas().to_parquet(f"{tmp_path}/a.parquet")
    tables.ingest_new_files(spark, str(tmp_path), table, schema)
    left = spark.table(table).where("id = 1").withColumn("lot", F.lit("half"))
    left.write.mode("append").partitionBy("lot").option("partitionOverwriteMode", "dynamic").saveAsTable(table)
    assert spark.table(table).count() == 4
    assert tables.ingest_new_files(spark, str(tmp_path), table, schema).count() == 0
    assert spark.table(table).count() == 3
